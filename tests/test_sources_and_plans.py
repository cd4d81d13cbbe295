"""Parsers on synthetic exports, the funnel, model calls and streams."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.trajectories import ingest
from corpusloom.plans import gate, models
from corpusloom.sources import books, chats, config, jsonl, vault
from corpusloom.streaming import sessions
from tests.test_render import frame, msg, rec

LIMITS = chats.ChatLimits()


def dump(path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def test_generic_chat(spark, tmp_path):
    dump(tmp_path / "c.jsonl", [{"conversation_id": "x", "ts": f"2024-01-0{d}T10:00:00Z", "sender": s, "text": f"m{i}"} for i, (d, s) in enumerate([(1, "me"), (1, "you"), (3, "me"), (5, "me"), (5, "you")])])
    src = chats.ChatSource("s", "generic_jsonl", str(tmp_path / "c.jsonl"), owner_sender="me")
    r = chats.parse_all(spark, [src], chats.ChatLimits(holdout_families=("s/2024-01",))).orderBy("segment").collect()
    assert [(x["segment"], [m["content"] for m in x["messages"]], x["family"], x["holdout"]) for x in r] == [(0, ["m0", "m1"], "s/2024-01", True), (2, ["m3", "m4"], "s/2024-01", True)]
    dump(tmp_path / "bad.jsonl", [{"conversation_id": "x", "ts": "2024-01-01T10:00:00Z", "sender": "me"}])
    with pytest.raises(Exception, match="bad.jsonl:1"):
        chats.generic(spark, chats.ChatSource("s", "generic_jsonl", str(tmp_path / "bad.jsonl"), owner_sender="me"), LIMITS).collect()
    with pytest.raises(ValueError):
        chats.ChatSource("s", "generic_jsonl", "x")


def test_line_numbers_over_splits(spark, tmp_path):
    p = tmp_path / "big.jsonl"
    p.write_text("\n".join(f"line {i} " + "x" * (i % 90) if i % 7 else "" for i in range(3000)))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = jsonl.read_ordered(spark, str(p)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert sorted((r["line_no"], int(r["raw"].split()[1])) for r in rows) == [(i, i) for i in range(3000) if i % 7]


def test_imessage(spark, tmp_path):
    parts = [{"type": "text", "text": "￼ hi "}, {"type": "url", "url": "https://a.example/x?y=1"}, {"type": "edited", "history": [{"text": "old"}, {"text": "new"}]}, {"type": "segments"}]
    dump(tmp_path / "t1.jsonl", [{"timestamp": 10**9, "sender": "Me", "type": "message", "parts": parts}, {"timestamp": 2 * 10**9, "sender": "Me", "type": "announcement", "parts": parts}, {"timestamp": 3 * 10**9, "sender": "Me", "type": "message", "parts": [{"type": "segments"}]}])
    rows = chats.imessage(spark, chats.ChatSource("s", "imessage", str(tmp_path), owner_sender="Me"), LIMITS).collect()
    assert [(r["thread"], r["text"], r["ts_us"]) for r in rows] == [("t1", "hi\nhttps://a.example/x\nnew", 978307200000000 + 1_000_000)]


def test_instagram_teams_reddit(spark, tmp_path):
    for t, friend in (("a", "Zoë"), ("b", "Bob")):
        (tmp_path / "ig" / t).mkdir(parents=True)
        garbled = friend.encode().decode("latin-1")
        m = [{"sender_name": "Own", "timestamp_ms": 2000, "content": "two"}, {"sender_name": garbled, "timestamp_ms": 1000, "content": "cafÃ©"}, {"sender_name": "Own", "timestamp_ms": 3000, "content": "Own sent an attachment."}]
        (tmp_path / "ig" / t / "message_1.json").write_text(json.dumps({"participants": [{"name": "Own"}, {"name": garbled}], "messages": m}))
    rows = chats.instagram(spark, chats.ChatSource("s", "instagram", str(tmp_path / "ig")), LIMITS).where("thread = 'a'").orderBy("ts_us").collect()
    assert [(r["sender"], r["text"], r["role"]) for r in rows] == [("Zoë", "café", "assistant"), ("Own", "two", "user")]
    (tmp_path / "teams").mkdir()
    (tmp_path / "teams/x.json").write_text(json.dumps({"me": {"name": "Own"}, "messages": [{"from": "Own", "sent": "2024-01-01T00:00:00Z", "text": " hi "}, {"from": "B", "sent": "2024-01-01T00:01:00Z", "text": " "}]}))
    rows = chats.teams(spark, chats.ChatSource("s", "teams", str(tmp_path / "teams")), LIMITS).collect()
    assert [(r["thread"], r["text"], r["role"]) for r in rows] == [("x", "hi", "user")]
    (tmp_path / "reddit").mkdir()
    c = [{"sent": "2024-01-02T00:00:00Z", "text": "reply", "subreddit": "s", "in_reply_to": {"author": "", "title": "T", "text": "body"}}, {"sent": "2024-01-01T00:00:00Z", "text": "[deleted]"}, {"sent": "2024-01-03T00:00:00Z", "text": "x", "in_reply_to": {"text": "[removed]"}}]
    (tmp_path / "reddit/acc.json").write_text(json.dumps({"account": "acc", "comments": c}))
    rows = chats.reddit(spark, chats.ChatSource("s", "reddit", str(tmp_path / "reddit")), LIMITS).orderBy("pos").collect()
    assert [(r["sender"], r["text"], r["role"]) for r in rows] == [("reddit", "T\n\nbody", "user"), ("acc", "reply", "assistant")]
    assert chats.interests(spark, str(tmp_path / "reddit"), 1).count() == 1
    with pytest.raises(NotImplementedError):
        chats.PARSERS["discord"](spark, None, None)


def test_books(spark, tmp_path):
    (tmp_path / "src--1--ann-lee--the-tale.txt").write_text("junk *** START OF THE PROJECT GUTENBERG EBOOK X *** body *** END OF THE PROJECT GUTENBERG EBOOK X *** tail")
    (tmp_path / "p.html").write_text("<html><head><title>no</title></head><body><h1>One</h1><script>x</script><p>two&amp;three</p></body></html>")
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("b.xhtml", "<p>" + "second " * 60 + "</p>")
        f.writestr("a.xhtml", "<p>" + "first " * 60 + "</p>")
        f.writestr("nav.xhtml", "<p>" + "skip " * 60 + "</p>")
        f.writestr("c.xhtml", "<p>stub</p>")
    (tmp_path / "e.epub").write_bytes(z.getvalue())
    got = {r["stem"]: r["text"] for r in books.read_books(spark, str(tmp_path)).collect()}
    assert got["src--1--ann-lee--the-tale"] == "body" and got["p"] == "One\n\ntwo&three"
    assert got["e"].startswith("first") and "\n\nsecond" in got["e"] and "skip" not in got["e"] and "stub" not in got["e"]
    title, author = books.book_metadata(F.lit("src--1--ann-lee--the-tale"), F.lit("body"))
    assert spark.range(1).select(title, author).first()[:] == ("the tale", "ann lee")
    (tmp_path / "x.pdf").write_text("x")
    with pytest.raises(Exception, match="unsupported"):
        books.read_books(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("paras,target", [(["a" * 5, "b" * 5, "c" * 5, "d" * 9], 10), (["x" * 50], 10), (["a", "b"], 100), ([], 10), (["a" * 3] * 9, 7)])
def test_chunks(spark, paras, target):
    chunks, cur, size = [], [], 0
    for p in paras:
        cur.append(p)
        size += len(p)
        if size >= target:
            chunks.append("\n\n".join(cur))
            cur = cur[-1:]
            size = sum(map(len, cur))
    if cur and (not chunks or size > target // 4):
        chunks.append("\n\n".join(cur))
    assert spark.createDataFrame([("\n\n".join(paras),)], "t string").select(books.chunk_windows(F.col("t"), target)).first()[0] == chunks


def test_works(spark, tmp_path):
    w = [{"id": i, "title": f"T{i}", "metadata": {"Fandom": "X, Y" if i % 2 else " ", "Additional Tags": "Underage" if i == 1 else ""}, "text": "word " * 400} for i in range(8)]
    p = tmp_path / "ao3_works_1.jsonl"
    p.write_text("\n".join([json.dumps(x) for x in w] + ["{broken"]))
    works = books.read_works(spark, str(p))
    got = books.select_works(works, 4, cap=2, existing=spark.createDataFrame([("t3",)], "key string"))
    assert sorted(r["id"] for r in got.collect()) == [0, 2, 5, 7]
    assert {r["group_name"] for r in got.collect()} == {"X", "unknown"}
    assert [r["id"] for r in jsonl.read_lenient(spark, str(p), "id bigint").where("_corrupt_record is not null").collect()] == [None]


def test_scenes(spark):
    prof = spark.createDataFrame([("w", 0, "Ann Lee", ["Ann"]), ("w", 1, "Bo", ["Ann"])], "work_id string, pos int, name string, aliases array<string>")
    al = books.resolved(prof)
    sc = spark.createDataFrame([("w", 1, [" ann", "bo"]), ("w", 2, ["ann", "nobody"]), ("w", 3, ["bo"])], "work_id string, scene int, participants array<string>")
    ok = books.usable_scenes(sc, al)
    assert [(r["scene"], r["participants"]) for r in ok.collect()] == [(1, ["Ann Lee", "Bo"])]
    turns = spark.createDataFrame([("w", 1, "ANN" if i % 2 else "Bo", "t" if i < 3 else None) for i in range(6)], "work_id string, scene int, speaker string, thought string")
    assert books.sound_dialogue(turns, ok, al).count() == 1 and books.sound_dialogue(turns.limit(5), ok, al).count() == 0


def test_vault(spark, tmp_path):
    (tmp_path / "KB/People").mkdir(parents=True)
    (tmp_path / "KB/People/x.md").write_text("---\nname: Xena\nyear: 2020\n---\n# H\n\n- **Jan 1:** It happened\n- " + "long bullet " * 5 + "\n\n## S\nbody\n")
    (tmp_path / "KB/top.md").write_text("plain")
    (tmp_path / "n.md").write_text("note")
    rows = {r["rel"]: r for r in vault.read_vault(spark, str(tmp_path), "KB").withColumn("b", vault.bullets(F.col("body"))).withColumn("d", vault.dated_bullets(F.col("body"))).withColumn("s", vault.sections("body")).collect()}
    x = rows["KB/People/x.md"]
    assert (x["section"], x["title"], x["front"]["year"], len(x["b"]), x["d"][0]["when"], x["s"]["S"]) == ("People", "Xena", "2020", 1, "Jan 1", "body")
    assert rows["KB/top.md"]["section"] == "Index" and rows["n.md"]["section"] == "notes" and x["family_key"].startswith("people-")


def test_trajectories(spark):
    call = lambda n, a: f'<tool_call>{{"name": "{n}", "arguments": {a}}}</tool_call>'
    resp = lambda n, i: f'<tool_response>{{"tool_call_id": "{i}", "name": "{n}", "content": {{"ok": true}}}}</tool_response>'
    good = [("system", '<tools>[{"name": "f"}]</tools>'), ("human", "do"), ("gpt", "<think>hm</think>I will" + call("f", '{"b": true, "a": {"k": [1]}}') + call("f", "{}")), ("tool", resp("f", "x1") + resp("f", "x2")), ("gpt", "done")]
    bad = [("human", "do"), ("tool", resp("f", "x1"))]
    rows = [(0, True, False, good), (1, True, False, bad), (2, False, False, good), (3, True, False, [("alien", "x")]), (9, True, False, good)]
    t = spark.createDataFrame(rows, "prompt_index bigint, completed boolean, partial boolean, conversations array<struct<`from` string, value string>>")
    ro = spark.createDataFrame([(i, "f.x", "f", False, "k") for i in range(4)], "prompt_index bigint, template_id string, family string, holdout boolean, instance_key string")
    got = {r["prompt_index"]: r for r in ingest(t, ro, "P").collect()}
    assert set(got) == {0, 1, 3, 9} and got[1]["error"] == "no open call of f" and got[3]["error"] == "unknown role" and "outside" in got[9]["error"]
    m = got[0]["messages"]
    assert [x["role"] for x in m] == ["user", "assistant", "tool", "tool", "assistant"] and m[1]["thought"] == "hm" and m[1]["content"] == "I will"
    assert [c["id"] for c in m[1]["tool_calls"]] == ["x1", "x2"] and [(a["name"], a["rendered"]) for a in m[1]["tool_calls"][0]["arguments"]] == [("b", "True"), ("a", '{"k": [1]}')]
    assert m[2]["tool_call_id"] == "x1" and m[2]["content"] == '{"ok": true}' and got[0]["tools_schema_json"] == '[{"name": "f"}]'


def test_funnel(spark):
    talk = lambda t: [x for i in range(3) for x in (msg("user", f"q{i}{t}"), msg("assistant", f"some reply number {i} about {t}", "P"))]
    rows = [rec(talk("a"), rid="1"), rec(talk("a"), rid="2"), rec(talk("openai x"), rid="3"), rec(talk("c")[:2], rid="4"), rec(talk("d"), rid="5"), rec(talk("e"), rid="6")]
    df = frame(spark, *rows).withColumn("pos", F.col("provenance.record_id").cast("int")).withColumn("provenance", F.col("provenance").withField("lane", F.lit("c")))
    verdicts = spark.createDataFrame([("1", 4.0, True), ("2", 4.0, True), ("3", 4.0, True), ("5", 2.0, False)], "record_id string, overall double, passed boolean")
    kept, rejected = gate.run_gates(df, verdicts, "pos")
    assert [r["provenance"]["record_id"] for r in kept.collect()] == ["1"]
    assert {r["provenance"]["record_id"]: r["drop_reason"] for r in rejected.collect()} == {"2": "dedupe", "3": "scrub", "4": "verify", "5": "judge", "6": "error"}


def test_harmonise(spark):
    long = "This sentence is plainly long enough to be rewritten by somebody, see `code_x` there."
    df = frame(spark, rec([msg("user", long), msg("assistant", long, "P"), msg("assistant", "short", "P")], rid="1"), rec([msg("assistant", long, "Other")], rid="2")).withColumn("pos", F.col("provenance.record_id").cast("int")).withColumn("drop_reason", F.lit(None).cast("string"))
    df = df.withColumn("provenance", F.col("provenance").withField("lane", F.lit("c")))
    out = {r["pos"]: r for r in gate.harmonise_stage(df, F.upper, "P").collect()}
    assert out[1]["messages"][0]["content"] == long and out[1]["messages"][1]["content"].startswith("THIS SENTENCE") and "`code_x`" in out[1]["messages"][1]["content"] and out[1]["messages"][2]["content"] == "short"
    assert out[1]["harmonized"] and not out[2]["harmonized"] and out[2]["messages"][0]["content"] == long
    bent = gate.harmonise_stage(df, lambda c: F.replace(c, F.lit("⟦"), F.lit("(")), "P").where("pos = 1").first()
    assert bent["drop_reason"] == "span_violation" and bent["messages"][1]["content"] == long


def test_external_reasons(spark):
    think = "<think>\nSCENE: x\nCHARACTERS: y\nPLAN: z\n</think>\n"
    rows = {
        "ok": [("system", "s"), ("human", "a"), ("gpt", think + "hi")],
        "minor_coded": [("human", "a 12-year-old"), ("gpt", think + "hi")],
        "leaked_meta": [("human", "a"), ("gpt", think + "I have read the <rules> now")],
        "think_incomplete": [("human", "a"), ("gpt", "prose\n" + think)],
        "consecutive_assistant_turns": [("human", "a"), ("gpt", think + "x"), ("gpt", think + "y")],
        "think_offschema": [("human", "a"), ("gpt", "<think>mus</think> hi")],
        "empty_turn": [("human", "  "), ("gpt", think + "hi")],
    }
    df = spark.createDataFrame(list(rows.items()), "id string, c array<struct<`from` string, value string>>")
    got = {r["id"]: r["r"] for r in df.select("id", gate.external_reason(F.col("c")).alias("r")).collect()}
    assert got == {k: None if k == "ok" else k for k in rows}


def test_model_calls(spark, tmp_path):
    req = spark.createDataFrame([("m-20250101", None, p, "{}") for p in ("a", "b", "a", "boom")], "model string, system string, prompt string, options string")
    path = str(tmp_path / "cache")

    def call(batch):
        if any(r["prompt"] == "boom" for r in batch):
            raise ValueError("boom")
        return [r["prompt"].upper() for r in batch]

    out = models.complete(req, jsonl.cached_replies(spark, path), call, 2)
    rows = out.collect()
    assert sorted((r["text"], bool(r["error"])) for r in rows if r["text"]) == [("A", False), ("B", False)] and sum(bool(r["error"]) for r in rows) == 1
    jsonl.put_replies(out.where("text is not null").select("request_key", "text").unionByName(spark.createDataFrame([("k", "  ")], "request_key string, text string")), path)
    assert spark.read.parquet(path).count() == 2
    again = models.complete(req.where("prompt <> 'boom'"), jsonl.cached_replies(spark, path), lambda b: 1 / 0, 2).collect()
    assert sorted(r["text"] for r in again) == ["A", "B"]


def test_retry_json_and_selfplay(spark):
    seen = []

    def flaky(batch):
        seen.append(1)
        if len(seen) < 3:
            raise models.ModelError("busy", 429, 0.0)
        return ["fine"]

    assert models.with_retry(flaky, sleep=lambda s: None)([{}]) == ["fine"]
    with pytest.raises(models.ModelError):
        models.with_retry(lambda b: (_ for _ in ()).throw(models.ModelError("bad", 400)), sleep=lambda s: None)([{}])
    replies = iter(["nope", '```json\n{"a": 1}\n```'])
    assert models.call_json(lambda b: [next(replies)], {"prompt": "p"}, lambda v: v["a"]) == 1
    seeds = spark.createDataFrame([("s1", "card")], "seed_id string, card string")
    r = models.self_play_all(seeds, lambda b: ["the very same reply once more today"], lambda b: ["ok"], 1).first()
    assert r["stop"] == "degenerate"


def test_routing(spark):
    pool = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(p).alias("provider")) for i, p in (("a", "x"), ("b", "y"))])
    r = spark.range(1).select(models.rotate(F.lit("k"), pool, F.lit("x")), models.judge_for(F.lit(""), pool, F.lit("x")), models.judge_for(F.lit("k"), F.slice(pool, 1, 1), F.lit("x")), models.generator_id(F.create_map(F.lit("z"), F.lit("t1"), F.lit("dialogue"), F.lit("t2")))).first()
    assert tuple(r) == ("b", "b", None, "t2")


def test_config(tmp_path, spark):
    (tmp_path / "a.task.yaml").write_text("id: f.a\nfamily: f\nprompt: 'x {p}'\nparams: {p: [1]}\nverifier: v\n")
    (tmp_path / "TEMPLATE.task.yaml").write_text("bad")
    assert [t["id"] for t in config.load_tasks(tmp_path)] == ["f.a"]
    config.write_manifest({"run": "r", "teachers": [{"id": "m-20250101"}]}, tmp_path / "m.yaml")
    assert config.read_manifest(tmp_path / "m.yaml")["run"] == "r"
    config.write_manifest({"teachers": [{"id": "m-latest"}]}, tmp_path / "m.yaml")
    with pytest.raises(ValueError):
        config.read_manifest(tmp_path / "m.yaml")
    assert config.narrowed_lanes(["b", "c"], ["c"]) == ["c"]
    with pytest.raises(ValueError):
        config.narrowed_lanes(["b"], ["z"])
    assert config.lane_policies(tmp_path / "none.yaml") == {}
    assert "lane d" in config.ship_plan({"d"}, {"d"}, {"train": 1})[0]
    assert "| verify |" not in config.dataset_card("t", {"train": 1}, [], [])
    assert '\\"' in config.book_entry("w", "p", 'a"b', "t")


def test_streams(spark, tmp_path):
    dump(tmp_path / "e.jsonl", [{"k": "a", "ts": f"2024-01-01T{h:02d}:00:00Z", "id": i} for i, h in enumerate([0, 4, 9])] + [{"k": "a", "ts": "2024-01-01T00:00:00Z", "id": 0}, {"k": "z", "ts": "2024-02-01T00:00:00Z", "id": 9}])
    (tmp_path / "in").mkdir()
    (tmp_path / "e.jsonl").rename(tmp_path / "in/e.json")
    s = sessions.message_stream(spark, str(tmp_path / "in"), "k string, ts timestamp, id bigint")
    q = sessions.write_once(sessions.first_deliveries(s, ["k", "id"], "ts"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    q = sessions.write_once(sessions.session_stream(s, "k", "ts"), str(tmp_path / "out2"), str(tmp_path / "ck2"))
    q.awaitTermination(60)
    assert sorted(r["n_events"] for r in spark.read.parquet(str(tmp_path / "out2")).where("k = 'a'").collect()) == [1, 3]


def test_jsonl_round_trip(spark, tmp_path):
    df = frame(spark, rec([msg("user", "x"), msg("assistant", "y")]))
    store = jsonl.RunStore(str(tmp_path), "r1")
    assert jsonl.write_jsonl(df, store.gated("kept")) == 1
    assert jsonl.read_typed(spark, store.gated("kept")).first()["messages"][1]["content"] == "y"
    with pytest.raises(FileExistsError):
        store.fresh()
    (tmp_path / "bad.json").write_text('{"schema_version": "x"}\n')
    with pytest.raises(Exception):
        jsonl.read_typed(spark, str(tmp_path / "bad.json")).collect()


def test_stage_asks_only_for_what_changed(spark, tmp_path):
    """New and changed keys are built, old ones are read; a key without rows is not asked again, and a run that broke off leaves nothing."""
    asked = []

    def build(missing):
        asked.append(sorted(r["k"] for r in missing.collect()))
        return missing.where("fingerprint <> 'none'").select("k", F.col("fingerprint").alias("v"))

    def got(*rows):
        return sorted(tuple(r) for r in jsonl.stage(spark, str(tmp_path / "st"), spark.createDataFrame(rows, "k string, fingerprint string"), "k", build).collect())

    assert got(("a", "1"), ("b", "none")) == [("a", "1")] and got(("a", "1"), ("b", "none")) == [("a", "1")]
    assert got(("a", "2"), ("b", "none"), ("c", "1")) == [("a", "2"), ("c", "1")] and got(("a", "1")) == [("a", "1")]
    assert asked == [["a", "b"], ["a", "c"]]


def test_cache_errors_are_not_an_empty_cache(spark, tmp_path):
    assert jsonl.cached_replies(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/part.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        jsonl.cached_replies(spark, str(tmp_path / "bad")).collect()
