"""Conversations against a plain rebuild."""

import random
import re

import pytest

from corpusloom.llm import conversations as C

CHAT = "row_id bigint, source string, conversation_id string, ts string, sender string, text string, role string"
SOURCES = "source string, parser string, owner_sender string, assistant_sender string"


def plain(rows, sources):
    anchors = {s: ((o or "").strip().lower() or None, (a or "").strip().lower() or None) for s, _, o, a in sources}
    seen, kept = {}, []
    for r in sorted(rows):
        row_id, source, conv, ts, sender, text, _ = r
        key = (sender or "").strip().lower() or None
        if key and ts:
            k = (conv, key, ts, text)
            if k in seen:
                continue
            seen[k] = row_id
        kept.append((row_id, source, conv, ts, key, text))
    out = []
    for conv in {k[2] for k in kept if k[2] is not None}:
        ms = [m for m in kept if m[2] == conv and m[5] and m[5].strip(" \t\n\xa0​﻿￼")]
        if not ms or any(m[3] is None or m[4] is None for m in ms):
            continue
        turns = []
        for m in sorted(ms, key=lambda m: (m[3], m[0])):
            o, a = anchors.get(m[1], (None, None))
            turns.append((m[0], None if not (o or a) else ("user" if m[4] == o else "assistant") if o else ("assistant" if m[4] == a else "user")))
        roles = [t[1] for t in turns]
        if None in roles or set(roles) != {"user", "assistant"} or roles[-1] == "user":
            continue
        out += [(conv, i, t[0], t[1]) for i, t in enumerate(turns, 1)]
    return sorted(out)


def test_like_plain_rebuild(spark):
    rng = random.Random(2)
    sources = [("s1", "p", "Me", None), ("s2", "p", None, " Bot "), ("s3", "p", None, None)]
    rows = []
    for i in range(900):
        rows.append((i, rng.choice(["s1", "s1", "s2", "s3"]), f"c{rng.randrange(90)}", rng.choice([f"2024-01-01T{rng.randrange(24):02d}:{rng.randrange(60):02d}:00Z"] * 30 + [None]), rng.choice(["me", " ME", "bot", "x"] * 20 + [None, " "]), rng.choice(["hello bot", "yes", "what about me", "long words here again", " ​", None]), "clash"))
    rows = [(i, f"s{int(c[1:]) % 3 + 1}", c, t, s, x, z) for i, _, c, t, s, x, z in rows]
    rows += [(1000 + i, *r[1:]) for i, r in enumerate(rng.sample(rows, 60))]
    got = C.rebuilt_conversations(spark.createDataFrame(rows, CHAT), spark.createDataFrame(sources, SOURCES))
    assert sorted(tuple(r) for r in got.drop("thread").collect()) == plain(rows, sources) != [] and got.where("thread <> 1").isEmpty()


def test_empty(spark):
    assert C.rebuilt_conversations(spark.createDataFrame([], CHAT), spark.createDataFrame([], SOURCES)).count() == 0


def messages(spark, rows):
    return spark.createDataFrame(rows, "conversation_id string, row_id bigint, ts_us bigint, sender_key string, text string")


def test_links_follow_mentions_and_words(spark):
    minute = 60_000_000
    rows = [("c", 1, 0, "ann", "the violin needs strings"), ("c", 2, minute, "bob", "who took the ladder"), ("c", 3, 2 * minute, "cy", "violin strings are in the drawer"), ("c", 4, 3 * minute, "dee", "bob the ladder is outside")]
    got = {r["row_id"]: r["parent_turn"] for r in C.reply_links(messages(spark, rows)).collect()}
    assert got == {1: None, 2: 1, 3: 1, 4: 2}


def brute_force(rows, window, break_below=None):
    """Links of one channel by the plain definition."""
    order = sorted(rows, key=lambda r: (r[2], r[1]))
    words = [{w for w in re.split(r"[^\w]+", r[4].lower()) if len(w) > 2} for r in order]
    out = {}
    for i, r in enumerate(order):
        best, parent = -1.0, None
        for k in range(max(0, i - window), i):
            p = order[k]
            score = 1 / (1 + (r[2] - p[2]) / 900e6) + (2.0 if p[3] in r[4].lower().split() else 0.0) + len(words[i] & words[k]) / max(1, min(len(words[i]), len(words[k]))) + 0.25 * (r[3] != p[3])
            if score >= best:
                best, parent = score, k
        keep = parent is not None and (break_below is None or best >= break_below)
        root = out[order[parent][1]][2] if keep else i + 1
        out[r[1]] = (i + 1, parent + 1 if keep else None, root)
    return out


def talk(n, seed, times):
    rng = random.Random(seed)
    return [("hot", i, rng.randrange(times), rng.choice(["ann", "bob", "cy", "dee"]), " ".join(rng.choice(["red", "green", "blue", "grey", "ann", "bob"]) for _ in range(4))) for i in range(n)]


@pytest.mark.parametrize("window,least,times", [(6, None, 10**10), (16, 1.2, 10**10), (3, 1.4, 1), (40, None, 5)])
def test_links_and_roots_like_brute_force_over_partitions(spark, window, least, times):
    rows = talk(240, 4, times)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        other = [("a", 900 + i, i, "x", "one two three") for i in range(5)] + [("zz", 950, 0, "x", "")]
        got = C.reply_links(messages(spark, rows + other), window=window, break_below=least)
        links = {r["row_id"]: (r["turn_no"], r["parent_turn"], r["root_turn"]) for r in got.where("conversation_id = 'hot'").collect()}
        assert links == brute_force(rows, window, least)
        assert got.where("conversation_id <> 'hot'").count() == 6
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_interleaved_conversations_under_one_id(spark):
    """Two talks at once in one channel: by time alone the turns would alternate, and the talk that ends with the user would be lost in the other's reply."""
    said = [("me", "violin strings snap again"), ("me", "compost heap smells odd"), ("bot", "which violin strings snap"), ("bot", "turn the compost heap"), ("me", "violin strings of steel snap"), ("bot", "compost heap needs leaves"), ("bot", "steel strings snap when cold violin"), ("me", "compost heap leaves where")]
    rows = [(i, "s", "c", f"2024-01-01T10:{i:02d}:00Z", who, text, "x") for i, (who, text) in enumerate(said)]
    chat, sources = spark.createDataFrame(rows, CHAT), spark.createDataFrame([("s", "p", "me", None)], SOURCES)
    got = C.rebuilt_conversations(chat, sources, break_below=1.3).orderBy("thread", "turn_no").collect()
    assert [(r["thread"], r["turn_no"], r["row_id"], r["role"]) for r in got] == [(1, 1, 0, "user"), (1, 2, 2, "assistant"), (1, 3, 4, "user"), (1, 4, 6, "assistant")]
    assert C.rebuilt_conversations(chat, sources).count() == 0  # taken as one conversation, it lacks a reply


def test_channel_may_be_the_source(spark):
    rows = [(1, "s", None, "2024-01-01T10:00:00Z", "me", "violin strings", "x"), (2, "s", None, "2024-01-01T10:01:00Z", "bot", "violin strings it is", "x"), (3, None, "c", "2024-01-01T10:01:00Z", "bot", "no channel", "x")]
    got = C.rebuilt_conversations(spark.createDataFrame(rows, CHAT), spark.createDataFrame([("s", "p", "me", None)], SOURCES), channel="source", break_below=0.5).collect()
    assert sorted((r["conversation_id"], r["thread"], r["turn_no"], r["row_id"]) for r in got) == [(None, 1, 1, 1), (None, 1, 2, 2)]
