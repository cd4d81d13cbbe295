"""Repeated content inside each text (problem 5).

One operator looks at a text's make-up in two ways. Distribution: over all texts of a language the histograms of character classes and of
the most common words are counted; a text's Jensen-Shannon distances from those references tell how far its own histograms lie from
its language, and texts under the minimum length have none. Repetition: a loop draws most of its words from few, and its word histogram bounds what can
repeat: a text with fewer than five words that are no first occurrence has no window twice, and is settled by its histogram alone. For all
others the exact part of the words in five consecutive words that occurred earlier is computed; the words of many texts are numbered
together and their windows sorted in numpy, so no text is ever compared with another and nothing is shuffled but the references' counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.languages import LANGUAGES_OF, NAMES, by_script

WINDOW = 5
MIN_WORDS = 12
#: Runs of letters: word characters but digits, numbers of other kinds and the low line.
_LETTERS = re.compile(r"[^\W\d_]+")


def word_lists(texts: list[str | None]) -> list[list[str]]:
    """Words of each text: runs of letters in lower case. Signs such as the superscript two are no letters."""
    out = []
    for t in texts:
        found = _LETTERS.findall(t.lower()) if t else []
        if t and not t.isascii() and not all(map(str.isalpha, found)):
            found = [p for w in found for p in ("".join(c if c.isalpha() else " " for c in w)).split()]
        out.append(found)
    return out


def repeated_share(lists: list[list[str]], window: int = WINDOW, min_words: int = MIN_WORDS) -> np.ndarray:
    """Share of each word list that lies in a window that started earlier in the same list; 0 under ``min_words`` words."""
    sizes = np.array([len(ws) for ws in lists], np.int64)
    total = int(sizes.sum())
    share = np.zeros(len(lists))
    if total < window:
        return share
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for ws in lists for w in ws), np.int64, total)
    row = np.repeat(np.arange(len(lists)), sizes)
    # windows are named exactly, by doubling: (name of the first part, next word) is numbered anew
    name = ids
    for k in range(1, window):
        pair = name[: total - k] * (len(number) + 1) + ids[k:]
        _, name = np.unique(pair, return_inverse=True)
    starts = total - window + 1
    inside = row[:starts] == row[window - 1 :]
    order = np.lexsort((np.arange(starts), name[:starts], row[:starts]))
    same = np.zeros(starts, bool)
    same[order[1:]] = (name[order[1:]] == name[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    again = np.flatnonzero(same & inside)
    # an earlier window that leaves its text does not count: such windows never equal an inside one of the same text and row
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + window, -1)
    hit = np.cumsum(cover)[:total] > 0
    counts = np.bincount(row[hit], minlength=len(lists))
    ok = sizes >= min_words
    share[ok] = counts[ok] / sizes[ok]
    return share


#: Character classes of a histogram, and number of common words of a language in it.
CLASSES = ("lower", "upper", "digit", "space", "mark", "other")
COMMON_WORDS = 200


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """Number of the class of every code point."""

    def of(c: str) -> int:
        return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c.isspace() else 5 if c.isalnum() else 4

    return np.fromiter((of(chr(k)) for k in range(0x110000)), np.uint8, 0x110000)


def class_counts(texts: list[str | None]) -> np.ndarray:
    """Characters of each class of each text, ``(texts, classes)``."""
    size = np.array([len(t) if t else 0 for t in texts], np.int64)
    points = np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.repeat(np.arange(len(texts)) * len(CLASSES), size) + _class_table()[points]
    return np.bincount(at, minlength=len(texts) * len(CLASSES)).reshape(len(texts), len(CLASSES))


def js_distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row of two tables of counts; 1 where one is empty."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p, q = p / p.sum(axis=1, keepdims=True), q / q.sum(axis=1, keepdims=True)
        m = (p + q) / 2
        part = lambda a: np.where(a > 0, a * np.log2(a / m), 0.0).sum(axis=1)
        d = np.sqrt(np.maximum(0.0, (part(p) + part(q)) / 2))
    return np.where(np.isnan(p).any(axis=1) | np.isnan(q).any(axis=1), 1.0, d)


class Batch:
    """The words of many texts as one array of numbers, and the language of each text."""

    def __init__(self, texts: list[str | None]):
        self.texts, self.lists = texts, word_lists(texts)
        words = [w for ws in self.lists for w in ws]
        self.number = {w: k for k, w in enumerate(dict.fromkeys(words))}
        self.ids = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self.size = np.array([len(ws) for ws in self.lists], np.int64)
        self.row = np.repeat(np.arange(len(texts)), self.size)
        self.langs = self._languages()

    def _languages(self) -> list[str]:
        """By script, else by the most function words; empty without any."""
        share = np.zeros((len(self.number) or 1, len(NAMES)))
        for w, k in self.number.items():
            if w in LANGUAGES_OF:
                share[k, LANGUAGES_OF[w]] = 1 / len(LANGUAGES_OF[w])
        score = np.stack([np.bincount(self.row, share[self.ids, k], len(self.texts)) for k in range(len(NAMES))], axis=1) if self.texts else np.zeros((0, len(NAMES)))
        best, known = score.argmax(axis=1), score.max(axis=1) > 0 if len(score) else []
        return [(by_script(t) if t else None) or (NAMES[b] if k else "") for t, b, k in zip(self.texts, best, known)]


def references(texts: DataFrame, text: str = "text", common: int = COMMON_WORDS) -> dict[str, tuple[np.ndarray, list[str], np.ndarray]]:
    """By language: character classes, the most common words, and their counts with that of all other words last, counted over all texts.

    What reaches the driver is at most (classes + ``common`` + 1) numbers a language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = Batch([t for t in whole.column(0).slice(at, 2000).to_pylist() if t])
                known = list(dict.fromkeys(b.langs))
                code = np.array([known.index(x) for x in b.langs], np.int64)
                if not known:
                    continue
                words = np.array(list(b.number) or [""], object)
                key, n = np.unique(code[b.row] * len(words) + b.ids, return_counts=True)
                classes = np.zeros((len(known), len(CLASSES)), np.int64)
                np.add.at(classes, code, class_counts(b.texts))
                every = np.bincount(code, b.size, len(known)).astype(np.int64)
                lang = [known[k] for k in key // len(words)] + [k for k in known for _ in CLASSES] + known
                kind = ["word"] * len(key) + ["class"] * classes.size + ["all"] * len(known)
                item = [*words[key % len(words)], *[c for _ in known for c in CLASSES], *[""] * len(known)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in (lang, kind, item)), pa.array(np.concatenate([n, classes.reshape(-1), every]))], names=["lang", "kind", "item", "n"])

    counts = texts.select(F.col(text)).mapInArrow(run, "lang string, kind string, item string, n bigint").groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))
    top = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item"))).where(F.col("r") <= common)
    found: dict[str, dict[str, dict[str, int]]] = {}
    for r in top.collect():
        found.setdefault(r["lang"], {"class": {}, "word": {}, "all": {"": 0}})[r["kind"]][r["item"]] = r["n"]
    out = {}
    for lang, f in found.items():
        words = sorted(f["word"], key=lambda w: (-f["word"][w], w))
        n = [f["word"][w] for w in words]
        out[lang] = np.array([f["class"].get(c, 0) for c in CLASSES], float), words, np.array([*n, f["all"][""] - sum(n)], float)
    return out


def _word_histograms(b: Batch, ref: dict, common: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common words of its language (and all others, last) in each text, the same of the language, and the number of words that are no first occurrence."""
    known, v, n = list(ref), len(b.number) or 1, len(b.texts)
    column = np.full((len(known) + 1, v), common, np.int64)
    theirs = np.zeros((len(known) + 1, common + 1))
    for k, lang in enumerate(known):
        _, words, counts = ref[lang]
        theirs[k, : len(words)], theirs[k, common] = counts[:-1], counts[-1]
        for j, w in enumerate(words):
            if w in b.number:
                column[k, b.number[w]] = j
    of = np.array([known.index(x) if x in ref else len(known) for x in b.langs], np.int64)
    mine = np.bincount(b.row * (common + 1) + column[of[b.row], b.ids], minlength=n * (common + 1)).reshape(n, common + 1)
    distinct = np.bincount(np.unique(b.row * v + b.ids) // v, minlength=n)
    return mine, theirs[of], b.size - distinct


def repeated_content(texts: DataFrame, keys: list[str], text: str = "text", window: int = WINDOW, min_words: int = MIN_WORDS, common: int = COMMON_WORDS) -> DataFrame:
    """``keys, lang, n_words, class_distance, word_distance, share`` of each row.

    Null, empty and short texts have share 0 and null distances. Repeated rows are measured each for itself; texts of any length are read whole;
    an empty table gives no rows; other columns are ignored.
    """
    schema = ", ".join(f"`{k}` {texts.schema[k].dataType.simpleString()}" for k in keys)
    ref = references(texts, text, common)
    known = texts.sparkSession.sparkContext.broadcast(ref)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ref = known.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                part = whole.slice(at, 2000)
                b = Batch(part.column("_text").to_pylist())
                mine, theirs, again = _word_histograms(b, ref, common)
                classes = np.array([ref[x][0] if x in ref else np.zeros(len(CLASSES)) for x in b.langs])
                short = b.size < min_words
                share = np.zeros(len(b.texts))
                may = np.flatnonzero(~short & (again >= window))
                if len(may):
                    share[may] = repeated_share([b.lists[k] for k in may], window, min_words)
                distances = [pa.array(js_distances(*pair), pa.float64(), mask=short) for pair in ((class_counts(b.texts), classes), (mine, theirs))]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), pa.array(b.langs, pa.string()), pa.array(b.size), *distances, pa.array(share)], names=[*keys, "lang", "n_words", "class_distance", "word_distance", "share"])

    return texts.select(*keys, F.col(text).alias("_text")).mapInArrow(run, f"{schema}, lang string, n_words bigint, class_distance double, word_distance double, share double")


def record_texts(records: DataFrame) -> DataFrame:
    """``rec_no, msg_no, field, text`` of every message's content and thought; nulls and empty texts are left out."""
    m = records.select("rec_no", F.posexplode("messages").alias("msg_no", "m"))
    both = F.explode(F.array(F.struct(F.lit("content").alias("field"), F.col("m.content").alias("text")), F.struct(F.lit("thought").alias("field"), F.col("m.thought").alias("text"))))
    return m.select("rec_no", F.col("msg_no").cast("bigint").alias("msg_no"), both.alias("t")).select("rec_no", "msg_no", "t.field", "t.text").where("text <> ''")
