"""How texts end: whether a text stops inside a word or sentence.

A corpus shows how whole lines and sentences end, as only a text's last line can be cut. A text that ends without terminal punctuation
is judged by rates: of all places where its last words stand in other texts' lines, in how many a line or sentence ends there, and in how
many it goes on or the last word is a longer one. Keys are 64-bit hashes of word sequences, so that every place of every text can be
looked up in whole arrays; which keys are asked for is known to the tasks as a bitmap of fixed size, so only places of asked keys are
put out (``evidence``). Whole short last lines are counted too (``vote_counts``), copies and near copies as one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.splits import connected
from corpusloom.session import cut

_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
#: Words, line ends and sentence ends.
_PIECE = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|\n|[.!?]['\"’”»)]*\s")
_DIGITS = re.compile(r"\d+")
_SENTENCE_END = re.compile(r"[.!?]['\"’”»)]*\s+")
#: A mark of omission in brackets.
_BRACKETED = re.compile(r"(?:\[\s?(?:…|\.\.\.)\s?\]|\(\s?(?:…|\.\.\.)\s?\))$")
_CLOSERS = "'\"’”“»)]*_"
_TAG = re.compile(r"</\w+>")
_SMILEY = re.compile(r"\s[:;][-']?[()DP/|]$")
_PICTURE = re.compile(r"[\U0001F300-\U0001FAFF☀-➿️]$")
#: Whole last lines without a full stop: sign-offs, links, tags, paths, list marks of a form.
SIGN_OFF = re.compile(r"(?i)^(?:[—–-]\s?[^\W\d_]+|(?:kind|best|warm) regards|yours (?:sincerely|truly)|mit freundlichen grüßen|viele grüße|cordialement|bien à vous|(?:un )?saludos?(?: cordial(?:es)?)?|https?://\S+|(?:#\w+\s*)+|see also \[\[.*\]\])$")
#: Articles and conjunctions that end no sentence.
DANGLING = frozenset("the a an and or der ein eine einen und oder le les un une des du et ou el los las una y".split())

#: Words of an end key, and of a remark key.
END_WORDS, REMARK_WORDS = 3, 5
#: A text's last words are a whole ending if a line or sentence of another text ends so, in at least this share of the texts that have them.
END_SHARE = 0.01
#: So many texts beside the judged one and its near copies must share a short last line, and such a share of the texts with these words must end there.
OTHER_LINES, LINE_SHARE = 2, 0.05
#: The same for the last word of a casual remark, and for its last five words.
OTHER_WORDS, WORD_SHARE = 1, 0.05

_M = (1 << 64) - 1
_PRIME, _SEED = 0x100000001B3, 0xCBF29CE484222325
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = 0xD6E8FEB86659FD93
#: Salts of the kinds of keys.
END, LINE, REMARK = 0x1F123BB5159A55E5, 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D
_SLOT_BITS = 22


def prefix_hashes(word: str) -> list[int]:
    """Hash of each prefix of a word; the last is that of the word."""
    out, h = [], _SEED
    for c in word:
        h = ((h ^ ord(c)) * _PRIME) & _M
        out.append(h)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def words_key(words: list[str], kind: int) -> tuple[int, int]:
    """Key of a word sequence, a polynomial hash of all words but the last mixed with the last and the kind, and the slot of the first part alone."""
    p, power = 0, 1
    for w in words[:-1]:
        p = (p + prefix_hashes(w)[-1] * power) & _M
        power = (power * _BASE) & _M
    y = ((p ^ kind) * _MIX) & _M
    x = (y + prefix_hashes(words[-1])[-1]) & _M
    x = ((x ^ x >> 32) * _MIX) & _M
    return _signed(x ^ x >> 29), y >> 64 - _SLOT_BITS


def _last_line(body: str) -> str:
    return body[body.rfind("\n") + 1 :]


def _masked_words(text: str) -> list[str]:
    return _TOKEN.findall(_DIGITS.sub("0", text.lower()))


def split_mark(text: str) -> tuple[str, bool]:
    """The text without trailing white space and without a mark of omission that the source may have set, and whether it had one."""
    t = text.rstrip()
    if t.endswith("…"):
        return t[:-1].rstrip(), True
    if t.endswith("..."):
        return t.rstrip(".").rstrip(), True
    m = _BRACKETED.search(t[-8:])  # no such mark is longer
    return (t[: len(t) - len(m.group())].rstrip(), True) if m else (t, False)


def terminal(body: str) -> bool:
    """Whether a text ends with terminal punctuation, a closing mark of its form, a link, a smiley or a picture."""
    bare = body.rstrip(_CLOSERS)
    if bare[-1:] in tuple(".!?。！？") or (bare[-1:].isspace() and bare[-2:-1] in tuple(".!?。！？")):
        return True
    if body.endswith(("<|im_end|>", "```", "}", "]")) or _PICTURE.search(body[-1:]) or _SMILEY.search(body[-4:]):
        return True
    if body.endswith(">") and _TAG.fullmatch(body, max(0, body.rfind("<"))):
        return True
    return bool(re.match(r"https?://\S", body.rsplit(None, 1)[-1])) if body.strip() else False


def last_part(body: str) -> str:
    """The last sentence, or the last line if it holds none before."""
    return _SENTENCE_END.split(_last_line(body))[-1]


def end_key(body: str) -> tuple[int, int] | None:
    """Key and slot of the last three words of the last line, of fewer if it has fewer."""
    words = _masked_words(_last_line(body))
    return words_key(words[-END_WORDS:], END) if words else None


def line_key(body: str) -> tuple[int, int] | None:
    """Key and slot of the whole last line."""
    words = _masked_words(_last_line(body))
    return words_key(words, LINE) if words else None


def last_word(body: str) -> str | None:
    """The last word if the last sentence or line begins in lower case, as casual remarks do."""
    words = _TOKEN.findall(last_part(body))
    return words[-1].lower() if words and words[0][0].islower() else None


def remark_key(body: str) -> tuple[int, int] | None:
    """Key and slot of the last five words of the last sentence or line, of all if it has fewer; null for a single word."""
    words = _masked_words(last_part(body))
    return words_key(words[-REMARK_WORDS:], REMARK) if len(words) > 1 else None


def ending(text: str) -> tuple[str, bool, str]:
    """``(kind, marked, body)``; kind is ``whole`` (terminal or sign-off), ``open`` (left to the rates) or ``inside`` (an open turn or object, an article, a comma or dash)."""
    body, marked = split_mark(text)
    line = _last_line(body).strip()
    if not body or terminal(body) or SIGN_OFF.match(line):
        return "whole", marked, body
    if body.rfind("<|im_start|>") > body.rfind("<|im_end|>") or (line.startswith("{") and not line.endswith("}")):
        return "inside", marked, body  # an open turn or object
    words = _TOKEN.findall(line.lower())
    return "inside" if len(words) > 3 and (body[-1] in ",;(–—-" or words[-1] in DANGLING) else "open", marked, body


#: Odd multipliers and offsets of a multiply-shift hash family.
_HASHES = np.random.default_rng(10).integers(1, 1 << 63, (2, 128, 1)).astype(np.uint64) | np.array([1, 0], np.uint64).reshape(2, 1, 1)


def sketch(body: str) -> list[int]:
    """Sixteen bands of eight minima over hashes of the three-word shingles before the last sentence or line (of all, if nothing is before it): near copies share a band, texts that only end alike none."""
    head = body[: len(body) - len(last_part(body))]
    ws = (head if head.strip() else body).lower().split()
    h = np.array(list({zlib.crc32(" ".join(ws[i : i + 3]).encode("utf-8", "surrogatepass")) for i in range(max(1, len(ws) - 2))}), np.uint64)
    with np.errstate(over="ignore"):
        low = ((_HASHES[0] * h + _HASHES[1]) >> np.uint64(32)).min(axis=1)
    return [zlib.crc32(band.tobytes()) for band in low.reshape(16, 8)]


def vote_counts(voters: DataFrame, key: str, others: int) -> DataFrame:
    """``key, votes`` of keys with more than ``others`` votes: texts by end key, near copies (equal in a band of their ``sketch``, also by way of others) as one.

    Near copies are the components of a graph that ties each text to the smallest with the same band, so a key or a band with a third of all texts is
    only counted and joined, never gathered. Keys that cannot have enough votes are left out first.
    """
    v = voters.select(key, "sketch").distinct()
    many = v.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > others).select(key)
    v = cut(v.join(many, key, "left_semi").withColumn("id", F.xxhash64(key, "sketch")))
    banded = v.select(key, "id", F.posexplode("sketch").alias("band", "value"))
    lows = banded.groupBy(key, "band", "value").agg(F.min("id").alias("low"))
    roots = connected(banded.join(lows, [key, "band", "value"]).select(F.col("id").alias("a"), F.col("low").alias("b")))
    label = v.join(roots, F.col("id") == F.col("node"), "left").select(key, F.coalesce("root", "id").alias("cls"))
    return label.groupBy(key).agg(F.count_distinct("cls").alias("votes")).where(F.col("votes") > others)


class Places:
    """Keys of all word places of batches of texts, as arrays."""

    def __init__(self) -> None:
        self.hashes: dict[str, list[int]] = {}

    def __call__(self, texts: list[str | None], parents: np.ndarray, asked: np.ndarray, kinds: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, key, whether it goes on)`` of each place whose key may be asked for, by the slots of what stands before the last word and of the whole.

        A text's last word shows nothing and is left out.
        """
        pieces, size = [], []
        for t in texts:
            own = _PIECE.findall(_DIGITS.sub("0", t.lower())) if t else ()
            pieces += own
            size.append(len(own))
        number = {p: k for k, p in enumerate(dict.fromkeys(pieces))}
        ids = np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
        # of each distinct piece: word, end of a sentence, end of a line
        kind_of = np.array([0 if p[0].isalnum() else 2 if "\n" in p else 1 for p in number] or [0])
        row, mark = np.repeat(np.arange(len(texts)), size), kind_of[ids] if len(ids) else ids
        line, sentence = np.cumsum(mark == 2) + row, np.cumsum(mark > 0) + row
        word = np.flatnonzero(mark == 0)
        n = len(word)
        none = np.empty(0, np.int64)
        if not n:
            return none, none, none.astype(bool)
        ids, row, line, sentence, i = ids[word], row[word], line[word], sentence[word], np.arange(n)
        if len(self.hashes) > 300_000:  # bounds the memory of a task, not the result
            self.hashes = {}
        hashes = [[] if k else self.hashes.get(p) or self.hashes.setdefault(p, prefix_hashes(p)) for p, k in zip(number, kind_of)]
        length = np.array([len(h) for h in hashes], np.int64)
        flat = np.fromiter((x for h in hashes for x in h), np.uint64, int(length.sum()))
        first = np.append(0, np.cumsum(length))
        whole = flat[first[ids + 1] - 1]
        starts = lambda a: np.maximum.accumulate(np.where(np.append(True, a[1:] != a[:-1]), i, 0))
        line_at, sentence_at = starts(line), starts(sentence)
        goes = np.append(sentence[1:] == sentence[:-1], False)
        last = np.append(row[1:] != row[:-1], True)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.append(np.uint64(1), np.full(n, _BASE, np.uint64)))
            inverse = np.cumprod(np.append(np.uint64(1), np.full(n, _BASE_INVERSE, np.uint64)))
            sums = np.append(np.uint64(0), np.cumsum(whole * power[:-1]))
            out = []
            for kind in kinds:
                start = line_at if kind == LINE else np.maximum(line_at, i - END_WORDS + 1) if kind == END else np.maximum(sentence_at, i - REMARK_WORDS + 1)
                y = (((sums[:-1] - sums[start]) * inverse[start]) ^ np.uint64(kind)) * np.uint64(_MIX)
                keep = np.flatnonzero(parents[(y >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)] & ~last)
                per = length[ids[keep]]
                place = np.repeat(keep, per)
                nth = np.arange(len(place)) - np.repeat(np.cumsum(per) - per, per)
                x = y[place] + flat[np.repeat(first[ids[keep]], per) + nth]
                x = (x ^ x >> np.uint64(32)) * np.uint64(_MIX)
                x ^= x >> np.uint64(29)
                hit = np.flatnonzero(asked[(x >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)])
                longer = nth < np.repeat(per, per) - 1
                out.append((row[place[hit]], x[hit].view(np.int64), longer[hit] | goes[place[hit]]))
        return tuple(np.concatenate(c) for c in zip(*out))


def _bitmap(slots: DataFrame) -> np.ndarray:
    """The slots (one int column) as a packed bitmap of 2**22 bits; at most 128 rows of 4 KB reach the driver."""
    s = slots.select((F.col(slots.columns[0]).cast("bigint") + 1).alias("s")).groupBy(F.bitmap_bucket_number("s").alias("bucket"))
    bits = np.zeros(1 << _SLOT_BITS, bool)
    for p in s.agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits")).collect():
        own = np.unpackbits(np.frombuffer(bytes(p["bits"]), np.uint8), bitorder="little")
        bits[(p["bucket"] - 1) * len(own) : p["bucket"] * len(own)] = own
    return np.packbits(bits)


def evidence(texts: DataFrame, asked: DataFrame, kinds: tuple[int, ...], repeated: DataFrame) -> DataFrame:
    """``key, n_ends, n_goes_on`` of asked keys (``key, slot``): in how many distinct ``text`` a line or sentence that is not the last ends so, and in how many it goes on or the last word is longer.

    ``repeated`` holds the hashes (one column) of the texts that occur more than once: only those come back one by one, to be told apart; all others are
    counted where they are read. The asked keys and the repeated hashes go to the tasks as bitmaps of 2**22 slots (512 KB each, whatever their number), the only
    things the driver collects; a text that only shares a slot with a repeated one comes back one by one too, so the counts are exact.
    """
    keys = cut(asked.where("key is not null").distinct())
    top = 64 - _SLOT_BITS
    slots = [_bitmap(keys.select("slot")), _bitmap(keys.select(F.shiftrightunsigned("key", top))), _bitmap(repeated.select(F.shiftrightunsigned(repeated.columns[0], top)))]
    packed = texts.sparkSession.sparkContext.broadcast(slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parents, wanted, twice = (np.unpackbits(b).astype(bool) for b in packed.value)
        places = Places()
        for whole in batches:
            for b in (whole.slice(k, 500) for k in range(0, whole.num_rows, 500)):
                h = b.column("h").to_numpy(zero_copy_only=False)
                row, key, goes = places(b.column("text").to_pylist(), parents, wanted, kinds)
                if len(row):
                    order = np.lexsort((goes, key, row))
                    row, key, goes = row[order], key[order], goes[order]
                    new = np.append(True, (row[1:] != row[:-1]) | (key[1:] != key[:-1]) | (goes[1:] != goes[:-1]))
                    own, key, goes = h[row[new]], key[new], goes[new]
                    alone = ~twice[(own.view(np.uint64) >> np.uint64(top)).astype(np.int64)]
                    met, n = np.unique(np.stack([key[alone], goes[alone].astype(np.int64)]), axis=1, return_counts=True)
                    one = np.count_nonzero(~alone)
                    columns = [
                        pa.array(np.append(own[~alone], np.zeros(len(n), np.int64)), mask=np.append(np.zeros(one, bool), np.ones(len(n), bool))),
                        pa.array(np.append(key[~alone], met[0])),
                        pa.array(np.append(goes[~alone], met[1] > 0)),
                        pa.array(np.append(np.ones(one, np.int64), n)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["h", "key", "goes", "n"])

    found = texts.where("text is not null").select(F.xxhash64("text").alias("h"), "text").mapInArrow(run, "h bigint, key bigint, goes boolean, n bigint")
    # one row for each repeated text, and the sum of the counts of all others
    once = found.groupBy("h", "key", "goes").agg(F.when(F.col("h").isNull(), F.sum("n")).otherwise(F.lit(1)).alias("n"))
    counts = once.groupBy("key").agg(F.sum(F.when(F.col("goes"), 0).otherwise(F.col("n"))).alias("n_ends"), F.sum(F.when(F.col("goes"), F.col("n")).otherwise(0)).alias("n_goes_on"))
    return counts.join(keys.select("key").distinct(), "key", "left_semi")


def enough(votes, goes_on, others: int, share: float):
    """Whether so many votes (columns) beside the judged text, against the texts that go on, show a whole ending."""
    v = F.coalesce(votes, F.lit(0))
    return (v > others) & (v >= share * (v + F.coalesce(goes_on, F.lit(0))))
