"""Encoding of whole corpora by a public byte-level BPE vocabulary (problem 8).

A text falls into chunks at single blanks between visible characters, where no token can cross.
Chunks repeat, so each task encodes a distinct chunk once: the pattern splits it into words, and all new words
of a batch are merged together in numpy rounds: the symbols of all words lie in one flat array, the pairs are looked
up by binary search over sorted pair keys, and each round merges the lowest-rank pair of every word.
The vocabulary (50 thousand tokens, a few MB as arrays: a fixed size) is broadcast once.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of the public vocabulary files.
TOKENIZER_DIR = "/opt/tokenizers"
#: Distinct chunks that a task remembers before it starts afresh; bounds its memory, not the result.
CACHE_CHUNKS = 400_000
#: A longer chunk is encoded but not remembered.
CACHE_CHARS = 64

_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PLAIN = re.compile(rf"[{_SPACE}] [^ ]| [{_SPACE}]|^ | \Z", re.DOTALL)
_BLANK = re.compile(rf"(?<=[^{_SPACE}]) (?=[^{_SPACE}])")


def word_pattern():
    """The public pre-tokenizer pattern: contractions, letters, digits, other signs, white space."""
    import regex

    s = _SPACE
    return regex.compile(rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{s}\p{{L}}\p{{N}}]+|[{s}]+(?![^{s}])|[{s}]+")


def merge_table(path: str) -> dict[str, np.ndarray]:
    """Sorted pair keys with the merged id of each, and the id of each byte, from a rank file."""
    rank = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, n = line.split()
                rank[base64.b64decode(token)] = int(n)
    keys, merged = [], []
    for token, n in rank.items():
        for i in range(1, len(token)):
            a, b = rank.get(token[:i]), rank.get(token[i:])
            if a is not None and b is not None:
                keys.append(a << 32 | b)
                merged.append(n)
    keys, merged = np.array(keys, np.int64), np.array(merged, np.int32)
    order = np.argsort(keys)
    return {"keys": keys[order], "merged": merged[order], "byte": np.array([rank[bytes([b])] for b in range(256)], np.int32)}


_NONE = np.iinfo(np.int32).max


def merge_words(words: list[bytes], table: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and the number of ids of each word."""
    lengths = np.array([len(w) for w in words], np.int64)
    sym = table["byte"][np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), lengths)
    done_sym, done_word = [], []
    keys, merged = table["keys"], table["merged"]
    while len(sym):
        pair = sym[:-1].astype(np.int64) << 32 | sym[1:]
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        rank = np.where((keys[at] == pair) & (word[:-1] == word[1:]), merged[at], _NONE)
        rank = np.append(rank, _NONE).astype(np.int32)
        start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        size = np.diff(np.append(start, len(sym)))
        least = np.repeat(np.minimum.reduceat(rank, start), size)
        ended = least == _NONE
        if ended.any():
            done_sym.append(sym[ended])
            done_word.append(word[ended])
            go = ~ended
            sym, word, rank, least = sym[go], word[go], rank[go], least[go]
            if not len(sym):
                break
        hit = rank == least
        # of hits that overlap in a chain only every other merges, from the left
        chain = np.flatnonzero(hit)
        fresh = np.append(True, np.diff(chain) > 1)
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(chain)), 0))
        take = chain[(np.arange(len(chain)) - head) % 2 == 0]
        sym = sym.copy()
        sym[take] = rank[take]
        keep = np.ones(len(sym), bool)
        keep[take + 1] = False
        sym, word = sym[keep], word[keep]
    sym = np.concatenate(done_sym) if done_sym else np.empty(0, np.int32)
    word = np.concatenate(done_word) if done_word else np.empty(0, np.int64)
    order = np.argsort(word, kind="stable")
    return sym[order], np.bincount(word, minlength=len(words))


class Encoder:
    """Encodes batches of texts; one for each Python worker."""

    def __init__(self, table: dict[str, np.ndarray]):
        self.table, self.find = table, word_pattern().findall
        self.fresh()

    def fresh(self) -> None:
        self.index: dict[str, int] = {}
        self.ids: list[np.ndarray] = []
        self.sizes: list[int] = []

    def chunks(self, text: str) -> list[str]:
        parts = text.split(" ") if _PLAIN.search(text) is None and "  " not in text else _BLANK.split(text)
        head, rest = parts[0], parts[1:]
        return [head, *[" " + p for p in rest]] if rest else [head]

    def learn(self, new: list[str]) -> None:
        found = [self.find(c) for c in new]
        words: dict[str, int] = {}
        order = [[words.setdefault(w, len(words)) for w in ws] for ws in found]
        ids, n = merge_words([w.encode("utf-8", "surrogatepass") for w in words], self.table)
        ends = np.cumsum(n)
        for c, ws in zip(new, order):
            self.index[c] = len(self.ids)
            got = np.concatenate([ids[ends[w] - n[w] : ends[w]] for w in ws]) if len(ws) != 1 else ids[ends[ws[0]] - n[ws[0]] : ends[ws[0]]]
            self.ids.append(got)
            self.sizes.append(len(got))

    def encode(self, texts: list[str | None], count_only: bool = False):
        """Number of ids of each text and, unless ``count_only``, all ids in one array. Null and empty texts have none."""
        if len(self.index) > CACHE_CHUNKS:
            self.fresh()
        split = [self.chunks(t) if t else [] for t in texts]
        new = list(dict.fromkeys(c for cs in split for c in cs if c not in self.index))
        if new:
            self.learn(new)
        index = self.index
        codes = np.fromiter((index[c] for cs in split for c in cs), np.int64)
        per = np.array([len(cs) for cs in split], np.int64)
        sizes = np.array(self.sizes, np.int64)
        begin = np.append(0, np.cumsum(sizes))
        ends = np.append(0, np.cumsum(sizes[codes]))
        bounds = np.append(0, np.cumsum(per))
        counts = ends[bounds[1:]] - ends[bounds[:-1]]
        flat = None
        if not count_only:
            pool = np.concatenate(self.ids) if self.ids else np.empty(0, np.int32)
            n = sizes[codes]
            flat = pool[np.repeat(begin[codes] - ends[:-1], n) + np.arange(ends[-1])] if len(codes) else np.empty(0, np.int32)
        long = [c for c in new if len(c) > CACHE_CHARS]
        if sum(map(len, long)) > 1_000_000:
            self.fresh()
        return counts, flat


_ENCODERS: dict[str, Encoder] = {}


def _encoder(table, name: str) -> Encoder:
    """The encoder of a vocabulary, by the hash of its file; a worker that is used again keeps only the last one."""
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(table.value)
    return _ENCODERS[name]


def _slices(batches: Iterator[pa.RecordBatch], max_chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of batches with about so many bytes of text each."""
    for b in batches:
        text = b.column("text")
        size = np.cumsum(np.append(0, np.nan_to_num(pc.binary_length(text).to_numpy(zero_copy_only=False)).astype(np.int64)))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(size, size[at] + max_chars, "right")) - 1)
            yield b.slice(at, to - at)
            at = to


def encode_texts(docs: DataFrame, key: str, text: str = "text", path: str | None = None) -> DataFrame:
    """``key, ids``: the ids of each text without special tokens; strings of special tokens are ordinary text.

    Null and empty texts give an empty list. Repeated rows stay; other columns are ignored; no shuffle.
    """
    table, name = vocabulary(docs.sparkSession, path)

    def run(batches):
        enc = _encoder(table, name)
        for b in _slices(batches):
            counts, flat = enc.encode(b.column("text").to_pylist())
            ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("key"), ids], names=["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def count_tokens(docs: DataFrame, key: str, text: str = "text", path: str | None = None) -> DataFrame:
    """``key, n_tokens`` of each text; 0 for null and empty texts."""
    table, name = vocabulary(docs.sparkSession, path)

    def run(batches):
        enc = _encoder(table, name)
        for b in _slices(batches):
            counts, _ = enc.encode(b.column("text").to_pylist(), count_only=True)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(counts)], names=["key", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, n_tokens bigint").withColumnRenamed("key", key)


def vocabulary(spark: SparkSession, path: str | None = None):
    """Broadcast of the merge table (a fixed few MB, whatever the data) and the hash of its file."""
    path = path or f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken"
    with open(path, "rb") as f:
        name = hashlib.sha256(f.read()).hexdigest()
    return spark.sparkContext.broadcast(merge_table(path)), name
