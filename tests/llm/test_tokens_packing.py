"""Tokenizer and containers."""

import os
import random

import numpy as np
import pytest

from corpusloom.llm import packing, tokenizer

PATH = f"{tokenizer.TOKENIZER_DIR}/byte_bpe_50k.tiktoken"
needs_files = pytest.mark.skipif(not os.path.exists(PATH), reason="vocabulary files missing")
ALPHABET = ["a", "aa", " ", "  ", "\n", "\n\n", "\t", "é", "日", "'s", "'ll", "1", "22", "½", "-", "====", "…", "​", "\xa0", "\r\n", "😀", "<|im_end|>", "<|endoftext|>", "\x1c", "\x85", " the", "　", "é", "_", "..."]


@pytest.fixture(scope="module")
def oracle():
    import base64

    import tiktoken

    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@needs_files
def test_encoder_equals_public_library(oracle):
    enc = tokenizer.Encoder(tokenizer.merge_table(PATH))
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30))) for _ in range(3000)] + ["a" * 3000, "ab" * 2000, "=" * 5000, "日本語" * 900, " ", ""]
    counts, flat = enc.encode(texts)
    got = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    assert got == [oracle.encode_ordinary(t) for t in texts]


@needs_files
def test_cache_bound_does_not_change_ids(oracle, monkeypatch):
    monkeypatch.setattr(tokenizer, "CACHE_CHUNKS", 5)
    enc = tokenizer.Encoder(tokenizer.merge_table(PATH))
    for i in range(20):
        text = f"some text number {i} with words{i} and more"
        assert enc.encode([text])[1].tolist() == oracle.encode_ordinary(text)


@needs_files
def test_encode_texts(spark, oracle):
    rows = [(1, "hello world"), (2, None), (3, ""), (4, "<|endoftext|>"), (4, "<|endoftext|>"), (5, "  \n ")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 as ids", "2 as key")
    got = sorted((r["doc_id"], list(r["ids"])) for r in tokenizer.encode_texts(df, "doc_id").collect())
    assert got == sorted((i, oracle.encode_ordinary(t) if t else []) for i, t in rows)
    n = {r["doc_id"]: r["n_tokens"] for r in tokenizer.count_tokens(df, "doc_id").collect()}
    assert n == {i: len(oracle.encode_ordinary(t)) if t else 0 for i, t in rows}
    assert tokenizer.encode_texts(df.limit(0), "doc_id").count() == 0


def check_packing(rows, sizes, capacity):
    by, room = {}, {}
    for k, no, start, size, box, at in rows:
        by.setdefault(k, []).append((no, start, size, box))
        if box is not None:
            room.setdefault(box, []).append((at, size))
    for box, parts in room.items():
        parts.sort()
        assert sum(s for _, s in parts) <= capacity
        assert all(a + s == b for (a, s), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0
    assert sorted(room) == list(range(len(room)))
    for k, n in sizes.items():
        pieces = sorted(by[k])
        assert sum(p[2] for p in pieces) == max(n or 0, 0) and [p[0] for p in pieces] == list(range(len(pieces)))
        assert len(pieces) == max(1, -(-max(n or 0, 0) // capacity)) and (len(pieces) == 1 or n > capacity)
    return len(room)


@pytest.mark.parametrize("seed", range(4))
def test_containers(spark, seed):
    rng = random.Random(seed)
    cap = rng.choice([7, 50, 2048])
    sizes = {i: rng.choice([None, 0, rng.randrange(cap + 1), rng.randrange(3 * cap), 3]) for i in range(400)}
    df = spark.createDataFrame(list(sizes.items()), "id bigint, n bigint").selectExpr("id", "n", "'x' as key", "1 as rest")
    rows = [tuple(r) for r in packing.fill_containers(df, "id", "n", cap).collect()]
    used = check_packing(rows, sizes, cap)
    least = -(-sum(max(n or 0, 0) for n in sizes.values()) // cap)
    assert least <= used <= least * 11 / 9 + 2


def test_containers_edge_cases(spark):
    cap = 10
    assert packing.fill_containers(spark.createDataFrame([], "id bigint, n bigint"), "id", "n", cap).count() == 0
    hot = {i: 4 for i in range(1000)}
    rows = [tuple(r) for r in packing.fill_containers(spark.createDataFrame(list(hot.items()), "id bigint, n bigint"), "id", "n", cap).collect()]
    assert check_packing(rows, hot, cap) == 500
    full = {1: 10, 2: 20, 3: 25, 4: 5}
    rows = [tuple(r) for r in packing.fill_containers(spark.createDataFrame(list(full.items()), "id bigint, n bigint"), "id", "n", cap).collect()]
    assert check_packing(rows, full, cap) == 6


def test_plan_is_best_fit():
    plan, n = packing.best_fit_plan({6: 1, 5: 1, 4: 1, 3: 1}, 10)
    assert n == 2 and {p[0]: p[3] for p in plan} == {6: 0, 5: 1, 4: 0, 3: 1}
    counts = {s: 1_000_000 for s in range(1, 2049)}
    plan, n = packing.best_fit_plan(counts, 2048)
    assert len(plan) < 60_000 and n == -(-sum(s * c for s, c in counts.items()) // 2048)


def test_second_vocabulary_in_a_session(spark, tmp_path):
    """Workers that are used again must not answer with the vocabulary of the query before."""
    import base64

    lines = [base64.b64encode(bytes([b])) + b" " + str(b).encode() for b in range(256)] + [base64.b64encode(b"ab") + b" 256"]
    (tmp_path / "tiny").write_bytes(b"\n".join(lines))
    df = spark.createDataFrame([(1, "abc"), (2, None)], "id bigint, text string")
    ids = lambda path=None: {r["id"]: r["ids"] for r in tokenizer.encode_texts(df, "id", path=path).collect()}
    first = ids()
    assert ids(str(tmp_path / "tiny")) == {1: [256, 99], 2: []} and ids() == first and first[1] != [256, 99]


def test_hot_size_class_over_partitions(spark):
    """One class with nearly all items spreads over range partitions; ranks stay dense."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = {i: (7 if i % 10 else 25 + i % 3) for i in range(1500)}
        rows = [tuple(r) for r in packing.fill_containers(spark.createDataFrame(list(sizes.items()), "id bigint, n bigint"), "id", "n", 10).collect()]
        check_packing(rows, sizes, 10)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
