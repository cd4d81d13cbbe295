"""Times, text and hashing expressions."""

import hashlib
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import hashing, spans
from corpusloom.functions import text as T
from corpusloom.functions.timestamps import apple_epoch_us, instant_us


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    "text",
    ["2023-02-02T09:55:25Z", "2023-02-02 09:55:25Z", "2023-02-02T09:55:25.123Z", "2023-02-02T16:42:50-05:00", "2023-02-02T16:42:50.5+05:30", "2023-02-02T09:55:25.123456+00:00", "2023-02-02T09:55:25+0130", " 2023-02-02T09:55:25z "],
)
def test_instants(spark, text):
    t = datetime.fromisoformat(text.strip().upper().replace("Z", "+00:00"))
    delta = t - datetime(1970, 1, 1, tzinfo=timezone.utc)
    assert one(spark, text, instant_us) == (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds


@pytest.mark.parametrize("text", [None, "", "pending", "??", "n/a", "2023-13-02T09:55:25Z", "2023-02-30T09:55:25Z", "12:00", "2023"])
def test_unreadable_instants(spark, text):
    assert one(spark, text, instant_us) is None


def test_no_zone_is_utc(spark):
    assert one(spark, "1970-01-01T00:00:01", instant_us) == 1_000_000


def test_apple_epoch(spark):
    assert one(spark, 1_500, apple_epoch_us, "bigint") == 978307200000001


def test_strip_is_unicode(spark):
    for s in [" a b ", "\x1c x\t", "", "​x"]:
        assert one(spark, s, T.strip) == s.strip()
    assert one(spark, "   Me\t", T.sender_key) == "me"
    assert one(spark, " 　", T.sender_key) is None
    assert one(spark, "​ ﻿￼", T.visible) is False
    assert one(spark, None, T.visible) is False


def test_normalise(spark):
    assert one(spark, "  Ä B\n\nc ", T.normalise) == "ä b c"


def test_slugs(spark):
    assert one(spark, "  The Étoile: of (sea)!  ", lambda c: T.slugify(c, 80)) == "the-étoile-of-sea"
    assert one(spark, "!!", lambda c: T.slugify(c, 80)) == "untitled"
    assert one(spark, None, lambda c: T.slugify(c, 80)) == "untitled"
    assert one(spark, "Ab -- Cd" * 9, T.slug_ascii) == "ab-cdab-cdab-cdab-cdab-cdab-cdab"
    assert one(spark, "%%", T.slug_ascii) == "item"


def test_author_flip(spark):
    assert one(spark, "Last, First", T.author_flip) == "First Last"
    assert one(spark, "First Last", T.author_flip) == "First Last"


def test_ngrams(spark):
    grams = lambda s, n=3: one(spark, s, lambda c: T.ngrams(T.words(c), n))
    assert grams("a b c a b c") == ["a b c", "b c a", "c a b"]
    assert grams("a b") == ["a b"]
    assert grams("") == []


def test_shorten_and_summary(spark):
    assert one(spark, "one two  three", lambda c: T.shorten(c, 8)) == "one two…"
    assert one(spark, "short", lambda c: T.shorten(c, 8)) == "short"
    assert one(spark, "line one\nline two", lambda c: T.summary_lines(c, 12)) == "line one\n…"


def test_canonical_json(spark):
    v = {"b": [1, {"y": "é", "x": None}], "a": True}
    assert one(spark, json.dumps(v), hashing.canonical_json_of) == '{"a":true,"b":[1,{"x":null,"y":"é"}]}'
    assert one(spark, "{", hashing.canonical_json_of) is None
    assert one(spark, json.dumps(v), hashing.record_id_of) == hashlib.sha256(json.dumps(v, sort_keys=True).encode()).hexdigest()[:16]
    assert one(spark, "holdout:x", lambda c: hashing.hash_int(c, 8)) == int(hashlib.sha256(b"holdout:x").hexdigest()[:8], 16)


def test_tree_and_prompt_hash(tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b/x.yaml").write_text("1")
    a = hashing.tree_hash(tmp_path)
    (tmp_path / ".DS_Store").write_text("junk")
    assert hashing.tree_hash(tmp_path) == a
    (tmp_path / "b/x.yaml").write_text("2")
    assert hashing.tree_hash(tmp_path) != a
    assert hashing.prompt_set_hash({"a": "1", "b": "2"}) == hashing.prompt_set_hash({"b": "2", "a": "1"})


def test_spans_priority_and_round_trip():
    text = 'Run `pip_install x` in /usr/local/bin, see https://a.example/b?c=1 and "quoted words" or snake_case 42.5% here'
    found = [(k, t) for _, _, k, t in spans.protected_spans(text)]
    assert ("inline_code", "`pip_install x`") in found and ("abs_path", "/usr/local/bin") in found and ("quoted", '"quoted words"') in found
    assert ("identifier", "snake_case") in found and ("number", "42.5%") in found
    masked, originals = spans.mask(text)
    assert spans.restore(masked, originals) == text
    assert spans.restore(masked.replace("⟦S0⟧", ""), originals) is None
    assert spans.restore(masked + " ⟦S9⟧", originals) is None
    assert spans.restore(masked + " ⟦", originals) is None


def test_surface_rows():
    assert spans.surface_rows('Sure!\n```json\n[{"a": 1}, 2]\n```') == [{"a": 1}]
    assert spans.surface_rows("no list") == [] and spans.surface_rows("[broken") == []


def test_list_items_and_count(spark):
    block = "Head\n1. a #x\n2) b\n 3. c #x\n"
    assert one(spark, block, spans.list_items) == ["a #x", "b", "c #x"]
    assert one(spark, block, lambda c: spans.tagged_count(c, F.lit("#x"))) == 2
    assert one(spark, block, lambda c: spans.tagged_count(c, F.lit("#none"))) is None


def test_typos_are_seeded(spark):
    t = "please don't touch http://a.example or `code` words here"
    slips = lambda rate, seed: spark.createDataFrame([(t, seed)], "t string, s int").select(spans.with_typos(F.col("t"), rate, F.col("s"))).first()[0]
    assert slips(0.9, 3) == slips(0.9, 3) != t and slips(0.9, 3) != slips(0.9, 4)
    assert "http://a.example" in slips(1.0, 5) and slips(0.0, 5) == t and len(slips(1.0, 5).split(" ")) == len(t.split(" "))


def test_think_and_placeholders(spark):
    r = one(spark, "<think>\nplan\n</think>\nhello", spans.split_think)
    assert (r["thought"], r["rest"]) == ("plan", "hello")
    r = one(spark, "hello <think>late</think>", spans.split_think)
    assert r["thought"] is None and r["rest"] == "hello <think>late</think>"
    filled = one(spark, "Hi {{user}}, {{user}}!", lambda c: spans.fill_placeholders(c, F.lit("row-1")))
    assert "{{" not in filled and len(set(filled[3:-1].split(", "))) == 1
    assert one(spark, "Hi {{char}}", lambda c: spans.fill_placeholders(c, F.lit("row-1"))) is None
    assert one(spark, "Hello World!!", spans.sloppy) == "hello World"
