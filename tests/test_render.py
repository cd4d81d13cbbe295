"""Rendering against hand-written turns."""

import pytest
from pyspark.sql import functions as F

from corpusloom.plans import render
from corpusloom.schema import RECORD_DDL, record_is_sound


def msg(role, content=None, speaker=None, thought=None, calls=None, call_id=None):
    return (role, speaker, content, thought, calls, call_id, None)


def rec(messages, system=None, tools=None, rid="r", group=None, overall=None, reason=None, verified=True):
    judge = None if overall is None else ({"q": overall}, overall, overall >= 3.5, "j-20250101")
    return (3, system, tools, messages, (rid, "a", "run", "fam", None, False, {"assistant": "t"}, group, None, None, ("rollout", "{}")), (verified, None, None, judge, [], None, False, reason is not None, reason))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), RECORD_DDL)


def test_plain_chat_and_spans(spark):
    r = render.rendered(frame(spark, rec([msg("user", " hi "), msg("assistant", "hello", "Q")], "You are Q."))).first()
    assert r["text"] == "<|im_start|>system\nYou are Q.<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\nhello<|im_end|>\n"
    s = r["train_spans"][0]
    assert r["text"][s["start"] : s["end"]] == "<think>\n\n</think>\n\nhello<|im_end|>"


def test_tools_runs_and_thoughts(spark):
    call = [("c1", "f", [("x", "True", "true"), ("y", '{"a": 1}', '{"a": 1}')])]
    m = [msg("user", "go"), msg("assistant", "early", thought="gone"), msg("user", "again"), msg("assistant", "", thought="why", calls=call), msg("tool", "r1", call_id="c1"), msg("tool", "r2", call_id="c2"), msg("assistant", "done")]
    text = render.rendered(frame(spark, rec(m, tools='[{"name": "f"}, {"type": "function", "function": {"name": "g"}}]'))).first()["text"]
    assert '\n{"type": "function", "function": {"name": "f"}}\n{"type": "function", "function": {"name": "g"}}\n</tools>' in text
    assert "<|im_start|>assistant\nearly<|im_end|>" in text
    assert "<think>\nwhy\n</think>\n\n<tool_call>\n<function=f>\n<parameter=x>\nTrue\n</parameter>\n<parameter=y>\n{\"a\": 1}\n</parameter>\n</function>\n</tool_call><|im_end|>" in text
    assert "<|im_start|>user\n<tool_response>\nr1\n</tool_response>\n<tool_response>\nr2\n</tool_response><|im_end|>\n" in text


def test_no_thoughts_keeps_empty_blocks(spark):
    df = frame(spark, rec([msg("assistant", "a", "X", "t1"), msg("assistant", "b", "Y", "t2")]))
    text = render.rendered(df, render.NO_THOUGHTS).first()["text"]
    assert text == "<|im_start|>assistant\n<think>\n\n</think>\n\nX: a<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\nY: b<|im_end|>\n"
    samples = render.next_speaker_samples(df).collect()
    assert len(samples) == 1 and samples[0]["text"].endswith("</think>\n\nY:")
    assert samples[0]["text"][samples[0]["span_start"] : samples[0]["span_end"]] == "Y:"


def test_empty_and_system_messages(spark):
    assert render.rendered(frame(spark, rec([]))).first()["text"] == ""
    assert render.rendered(frame(spark, rec(None, "s"))).first()["train_spans"] == []
    with pytest.raises(Exception, match="system prompt belongs"):
        render.rendered(frame(spark, rec([msg("system", "x")]))).collect()


def test_pairs(spark):
    prompt = [msg("user", "q")]
    kept = frame(spark, rec([*prompt, msg("assistant", "good")], rid="k", group="g", overall=4.5), rec([msg("user", "other"), msg("assistant", "x")], rid="k2", group="g", overall=4.9))
    lost = frame(spark, rec([*prompt, msg("assistant", "bad")], rid="l", group="g", overall=2.0, reason="judge"), rec([*prompt, msg("assistant", "worse")], rid="l2", group="g", overall=1.0, reason="verify"), rec([*prompt, msg("assistant", "close")], rid="l3", group="g", overall=4.0, reason="judge"))
    p = render.preference_pairs(kept, lost, 1.0).collect()
    assert len(p) == 1 and p[0]["meta"]["chosen_id"] == "k" and p[0]["meta"]["rejected_id"] == "l" and p[0]["meta"]["margin"] == "2.500"
    assert p[0]["prompt_text"].endswith("q<|im_end|>\n") and p[0]["chosen_text"].startswith("<|im_start|>assistant\n")
    assert render.preference_pairs(kept, lost, 5.0).count() == 0


def test_transcript_and_flip(spark):
    df = frame(spark, rec([msg("user", "q"), msg("assistant", "a", "Q", "hm", [("1", "f", [("x", "1", "1")])]), msg("tool", "z" * 3000, call_id="1")], "sys"))
    t = df.select(render.judge_transcript(F.col("system"), F.col("messages"))).first()[0]
    assert t.startswith("[system]\nsys\n\n[user]\nq\n\n[Q]\n(inner thought: hm)\na\n[calls tools: f(x=1)]\n") and t.count("z") == 2000
    flipped = df.select(render.flip_history(F.col("messages"))).first()[0]
    assert [(m["role"], m["content"]) for m in flipped] == [("assistant", "q"), ("user", "a")]


def test_shape_rules(spark):
    df = frame(spark, rec([msg("tool", "x")], rid="1"), rec([msg("user", "x", thought="t")], rid="2"), rec([msg("user", "x"), msg("assistant", "y", thought="t"), msg("tool", "z", call_id="1")], rid="3"), rec(None, rid="4"))
    got = {r[0]: r[1] for r in df.select("provenance.record_id", record_is_sound(F.col("messages"))).collect()}
    assert got == {"1": False, "2": False, "3": True, "4": False}
