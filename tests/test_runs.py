"""Records from segments, scenes and trajectories; fiction stages; a whole run."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import expand, order, records, scrub, split, trajectories
from corpusloom.plans import fiction, gate, models, run
from corpusloom.sources import chats, files
from tests.test_render import frame, msg, rec


def test_stream_and_scene_records(spark):
    seg = spark.createDataFrame([("s", 'a"b', 0, "s/2024-01", False, [("user", "me", "hi", "t1"), ("assistant", "you", "yo", "t2")])], "source string, thread string, segment int, family string, holdout boolean, messages array<struct<role string, speaker string, content string, ts string>>")
    r = records.stream_records(seg, "run").first()
    assert json.loads(r["provenance"]["source"]["detail_json"]) == {"source": "s", "conversation_id": 'a"b', "segment": 0}
    assert r["provenance"]["record_id"].startswith("d-") and len(r["provenance"]["record_id"]) == 18 and r["messages"][1]["ts"] == "t2"
    sc = spark.createDataFrame([("w", 0, 1, True, "sys", [("A", "x", None)])], "work_id string, chunk int, scene int, holdout boolean, system string, turns array<struct<speaker string, content string, thought string>>")
    r = records.scene_records(sc, "run", {"dialogue": "m"}).first()
    assert r["provenance"]["family"] == "w" and r["provenance"]["teachers"] == {"dialogue": "m"} and r["messages"][0]["role"] == "assistant"


def test_books_and_bands(spark):
    b = records.book_entries(spark.createDataFrame([(7, "p", None, " ")], "ident int, path string, author string, title string"), "lib").first()
    assert tuple(b) == ("lib-7", "p", "", "untitled")
    scored = spark.createDataFrame([("a", "T1", 9.0), ("b", "T2", 9.0), ("c", "T3", 1.0), ("d", "T4", 8.0)], "work_id string, title string, score double")
    known = spark.createDataFrame([("a", "x"), ("z", "t2")], "work_id string, title string")
    assert [r["work_id"] for r in records.chosen_books(scored, known, 7).collect()] == ["d"]
    assert records.latest(scored, "score", F.col("work_id") > "b").first()["work_id"] == "d"
    bad = records.out_of_band(spark.createDataFrame([("a", 0.5), ("b", 0.1)], "lane string, rate double"), spark.createDataFrame([("a", 0.2, 0.8), ("b", 0.2, 0.8)], "lane string, low double, high double"), ["a", "b", "c"])
    assert sorted(r["lane"] for r in bad.collect()) == ["b", "c"]


def test_fiction_stages(spark, tmp_path):
    asked = tmp_path / "asked"

    def reply(r):
        with asked.open("a") as f:
            f.write("x")
        p = r["prompt"]
        if p.startswith("P"):
            return json.dumps({"characters": [{"name": "Ann", "aliases": ["Annie"]}, {"name": "Bo"}]}) if "good" in p else "no json"
        if p.startswith("S"):
            return json.dumps({"scenes": [{"setting": "s", "context": "c", "participants": ["annie", "Bo"]}, {"participants": ["Bo"]}]})
        return json.dumps({"turns": [{"speaker": "Ann" if i % 2 else "Bo", "content": "x", "thought": "t"} for i in range(6)]})

    works = spark.createDataFrame([("w1", "good text\n\nmore"), ("w2", "bad")], "work_id string, text string")
    prompts = {"profiles": "P", "scenes": "S", "dialogue": "D"}
    out = fiction.extract_scenes(spark, works, models.scripted(reply), str(tmp_path / "st"), prompts)
    assert [(r["work_id"], r["scene"]) for r in out["usable"].collect()] == [("w1", "0/0")]
    assert out["profiles"].where("error is not null").count() == 1
    n = len(asked.read_text())
    fiction.extract_scenes(spark, works, models.scripted(reply), str(tmp_path / "st"), prompts)["usable"].collect()
    assert len(asked.read_text()) == n
    fiction.extract_scenes(spark, works, models.scripted(reply), str(tmp_path / "st"), prompts | {"dialogue": "D2"})["usable"].collect()
    assert len(asked.read_text()) > n


def test_run_renders_once_and_guards(spark):
    talk = lambda t: [msg("user", f"question about {t} please now"), msg("assistant", f"an answer that speaks of {t} at some length", "P")]
    rows = [rec(talk(f"t{i} w{i * 7}"), rid=f"r{i}", group=f"g{i}") for i in range(12)] + [rec(talk("t0 w0"), rid="dup", group="gd")]
    df = frame(spark, *rows).withColumn("pos", F.monotonically_increasing_id()).withColumn("provenance", F.col("provenance").withField("family", F.col("provenance.record_id")))
    prior = frame(spark, rec(talk("t1 w7"), rid="old", group="go")).withColumn("pos", F.lit(0).cast("bigint")).withColumn("provenance", F.col("provenance").withField("family", F.lit("old")))
    got = run.render_run(df, df.limit(0), prior, "pos", run.RunConfig(eval_fraction=0.25))
    n = run.render_counts(got)
    assert n["train"] + n["eval"] == 12 and n["eval"] == 3 and n["train_no_thoughts"] == n["train"] and n["pairs"] == 0
    ids = {r["provenance"]["record_id"] for k in ("train", "eval") for r in got[k].select("provenance").collect()}
    assert "old" in ids and "r1" not in ids and "dup" not in ids
    mixed = df.withColumn("provenance", F.col("provenance").withField("family", F.lit("one")).withField("holdout", F.col("provenance.record_id") == "r3"))
    with pytest.raises(split.HoldoutViolation):
        run.render_run(mixed, df.limit(0), None, "pos", run.RunConfig())


def test_control(tmp_path, monkeypatch):
    monkeypatch.setenv("CORPUSLOOM_TARGET", "x")
    assert run.target_name("y") == "x"
    (tmp_path / "burn.x.yaml").write_text("")
    assert run.config_file(tmp_path, "burn", "x").name == "burn.x.yaml" and run.config_file(tmp_path, "burn", "z").name == "burn.yaml"
    assert run.pool_width([{"provider": "a"}, {"provider": "b"}], {"a": 8, "b": 2}) == 2


def test_seeds(spark):
    notes = spark.createDataFrame([("r1", "people-1", "Ann", "about ann"), ("r2", "people-2", "Bo", "about bo")], "rel string, family_key string, title string, summary string")
    assert [r["seed_id"] for r in expand.person_seeds(notes, "Q", 1).collect()] == ["companion-person-people-1"]
    assert expand.obsession_seeds(notes, "Q", 5, ["f1", "f2"]).count() == 2
    events = spark.createDataFrame([("r1", "t-1", "2020", "sum", 0, "Jan 1", "it happened " * 60)], "rel string, family_key string, year string, summary string, i int, when string, what string")
    e = expand.event_seeds(events, "Q", 5).first()
    assert e["family"] == "companion/t-1" and e["scenario"].endswith("…") and "## This particular thing\nJan 1" in e["grounding"]
    bullets = spark.createDataFrame([("r1", "t-1", 0, "a bullet", "sum")], "rel string, family_key string, i int, bullet string, summary string")
    assert expand.topic_seeds(bullets, "Q", 5).count() == 1
    c = spark.createDataFrame([("C", 9, "a", ["x"]), ("D", 10, "b", ["y"])], "community string, n bigint, first_seen string, texts array<string>")
    assert expand.interest_seeds(c, "Q", 1).first()["scenario"].startswith("The user explains something from D")
    grid = expand.job_grid(spark.createDataFrame([("s1", []), ("s2", ["p9"])], "seed_id string, user_sim_personas array<string>"), spark.createDataFrame([("p1",), ("p2",)], "persona_id string"), 2)
    assert sorted((r["seed_id"], r["persona_id"], r["repeat"]) for r in grid.collect()) == [("s1", "p1", 0), ("s1", "p1", 1), ("s1", "p2", 0), ("s1", "p2", 1), ("s2", "p9", 0), ("s2", "p9", 1)]
    k = spark.range(1).select(expand.hash_sample_personas(F.lit("s"), F.array(*[F.lit(x) for x in "abcd"]), 2)).first()[0]
    assert len(k) == 2 and set(k) < set("abcd")


def test_evolve(spark, tmp_path):
    from corpusloom.plans import evolve
    from corpusloom.sources import jsonl

    rows = [[{"name": "Bird List", "entries_block": "1. a #x\n2. b\n3. c #x", "tag": "#x"}, {"name": "all", "entries_block": "1. a #x\n2. b #x\n3. c #x", "tag": "#x"}], [{"name": "Bird List", "entries_block": "1. a #x\n2. b\n3. c #x", "tag": "#x"}, {"name": "Two", "entries_block": "1. q\n2. r #y\n3. s", "tag": "#y"}]]
    call = models.scripted(lambda r: "Here:\n```json\n" + json.dumps(rows[int(r["prompt"]) % 2]) + "\n```")
    known = spark.createDataFrame([], "identity string")
    got = evolve.evolve("count.tagged_count", known, jsonl.cached_replies(spark, str(tmp_path / "none")), call, str, 2).collect()
    assert sorted((r["params"]["destination"], r["params"]["true_count"]) for r in got) == [("lists/bird-list-log.txt", "2"), ("lists/two-log.txt", "1")]
    again = evolve.evolve("count.tagged_count", spark.createDataFrame([(r["identity"],) for r in got], "identity string"), jsonl.cached_replies(spark, str(tmp_path / "none")), call, str, 2)
    assert again.count() == 0


def test_owner_of_an_export_is_not_set_twice():
    for parser in ("instagram", "teams", "reddit"):
        with pytest.raises(ValueError, match="names its owner"):
            chats.ChatSource("x", parser, "p", owner_sender="me")
    for parser in ("generic_jsonl", "imessage"):
        with pytest.raises(ValueError, match="exactly one"):
            chats.ChatSource("x", parser, "p")


def test_stride_cap_follows_the_export(spark, tmp_path):
    """Threads count in the order in which the export begins them, not by name."""
    rows = [(c, f"2024-01-0{d}T00:0{i}:00Z", "me" if i else "you", "hello") for d, c in enumerate(["z", "a", "m"], 1) for i in (0, 1)]
    (tmp_path / "x.jsonl").write_text("\n".join(json.dumps(dict(zip(("conversation_id", "ts", "sender", "text"), r))) for r in rows) + "\n")
    source = chats.ChatSource("g", "generic_jsonl", str(tmp_path / "x.jsonl"), owner_sender="me", max_records=1)
    assert [r["thread"] for r in chats.parse_all(spark, [source], chats.ChatLimits()).collect()] == ["z"]


def test_capped_records_are_those_of_the_whole(spark, tmp_path):
    """With a cap the texts are read after the choice: the same records as without one, over several files, and the strided ones of them."""
    rows = [(f"c{i % 7}", f"2024-01-{1 + i // 50:02d}T00:{i % 50:02d}:00Z", ("me", "you", "they")[i * i % 3], f"text {i}") for i in range(400)]
    lines = [json.dumps(dict(zip(("conversation_id", "ts", "sender", "text"), r))) for r in rows]
    for k in (0, 1, 2):
        (tmp_path / f"x{k}.jsonl").write_text("\n".join(lines[k * 150 : (k + 1) * 150]) + "\n")
    limits = chats.ChatLimits(max_messages=5, min_chars=20, min_mean_chars=6.5)
    made = lambda k: {(r["thread"], r["segment"]): r.asDict(True) for r in chats.parse_all(spark, [chats.ChatSource("g", "generic_jsonl", str(tmp_path), owner_sender="me", max_records=k)], limits).collect()}
    whole = made(0)
    assert len(whole) > 20 and made(10**6) == whole
    some = made(9)
    assert len(some) == 9 and all(whole[k] == r for k, r in some.items())


def test_an_export_is_written_by_many_tasks(spark, tmp_path):
    """Sessions of an export whose lines no single row, task or file holds: files of ranges in the order of their names."""
    import glob
    import gzip

    from corpusloom import queries_io
    from corpusloom.session import ensure_checkpoint_dir

    rows = [(i * 7919 % 2000, "s", f"c{i * 7919 % 2000 // 4}", f"2024-01-01T00:00:{i % 60:02d}Z", "anna" if i % 2 else "bob", f"text {i * 7919 % 2000}") for i in range(2000)]
    spark.createDataFrame(rows, "row_id bigint, source string, conversation_id string, ts string, sender string, text string").write.parquet(f"{tmp_path}/chat_messages.parquet")
    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    known, was = set(glob.glob(f"{folder}/sessions-*")), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted((int(r["thread"][1:]), r["segment"], r["n_messages"]) for r in queries_io.chat_records(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    (export,) = set(glob.glob(f"{folder}/sessions-*")) - known
    parts = [[json.loads(x)["text"] for x in (gzip.open if p.endswith(".gz") else open)(p)] for p in sorted(glob.glob(f"{export}/*")) if not p.endswith("_SUCCESS")]
    assert [t for p in parts for t in p] == [f"text {i}" for i in range(2000)] and max(map(len, parts)) < 1500
    assert got == [(5 * i, 0, 4) for i in range(100)]


def test_a_thousand_calls_in_a_turn(spark):
    """Positions are pairs of turn and call, so the calls of a long turn keep apart from the next turn's."""
    n = 1200
    call = '<tool_call>{"name": "f", "arguments": {}}</tool_call>'
    answer = lambda i: f'<tool_response>{{"tool_call_id": "x{i}", "name": "f", "content": "{i}"}}</tool_response>'
    said = [("human", "go"), ("gpt", call * n), ("tool", "".join(answer(i) for i in range(n))), ("gpt", call), ("tool", answer(n)), ("gpt", "done")]
    t = spark.createDataFrame([(0, True, False, said)], "prompt_index bigint, completed boolean, partial boolean, conversations array<struct<`from` string, value string>>")
    ro = spark.createDataFrame([(0, "f.x", "f", False, "k")], "prompt_index bigint, template_id string, family string, holdout boolean, instance_key string")
    m = trajectories.ingest(t, ro, "P").first()["messages"]
    assert len(m) == 2 + n + 2 + 1 and [x["id"] for x in m[1]["tool_calls"]] == [f"x{i}" for i in range(n)] and m[2 + n]["tool_calls"][0]["id"] == f"x{n}"


def test_pseudonyms_in_the_funnel(spark):
    """Names in contents, thoughts and whole speakers of personal records; preserved names, other lanes and dropped records stay."""
    rows = [rec([msg("user", "Ann met Bo and Cy", "Ann"), msg("assistant", "Bo? Hannah said so", "Bo Lee", "ask Ann")], rid="1"), rec([msg("user", "Cy", "Cy")], rid="2")]
    df = frame(spark, *rows).withColumn("pos", F.col("provenance.record_id").cast("int")).withColumn("drop_reason", F.lit(None).cast("string")).withColumn("scrub_flags", F.lit(None).cast("array<string>"))
    df = df.withColumn("provenance", F.col("provenance").withField("lane", F.when(F.col("pos") == 1, "d").otherwise("a")))
    got = {r["pos"]: r for r in gate.pseudonym_stage(df, "pos", ["Ann", "Bo", "Cy"], preserve=["cy"]).collect()}
    m = got[1]["messages"]
    assert [x["content"] for x in m] == ["Person-1 met Person-2 and Cy", "Person-2? Hannah said so"] and m[1]["thought"] == "ask Person-1"
    assert [x["speaker"] for x in m] == ["Person-1", "Bo Lee"] and got[1]["scrub_flags"] == ["transform:pseudonymised"]
    assert got[2]["messages"][0]["content"] == "Cy" and got[2]["scrub_flags"] is None


def test_pseudonyms_in_texts(spark):
    df = spark.createDataFrame([(1, "Ann and Bo"), (2, "Ann and Bo"), (3, None), (4, "Annabel")], "k int, text string")
    mapping = spark.createDataFrame([("ann", "P-1"), ("bo", "P-2")], "name string, pseudonym string")
    got = {r["k"]: r["text"] for r in scrub.pseudonymise(df, "text", mapping, ["Ann", "Bo"]).collect()}
    assert got == {1: "P-1 and P-2", 2: "P-1 and P-2", 3: None, 4: "Annabel"}
    assert scrub.pseudonymise(df.limit(0), "text", mapping, ["Ann"]).count() == 0


def test_first_rows_and_seeds_by_stride(spark):
    df = spark.range(50).select((F.col("id") * 7 % 50).alias("id"))
    assert sorted(r["id"] for r in order.first_rows(df, ["id"], 9).collect()) == list(range(9)) and order.first_rows(df, ["id"], 0).count() == 0


def test_files_are_written_whole(spark, tmp_path):
    df = spark.createDataFrame([("a/b.txt", "ü"), ("c.txt", "")], "path string, body string")
    assert files.write_named(df, f"file://{tmp_path}/out") == 2 and (tmp_path / "out/a/b.txt").read_text() == "ü" and sorted(p.name for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["b.txt", "c.txt"]
    assert files.write_named(df.limit(0), f"file://{tmp_path}/out") == 0
