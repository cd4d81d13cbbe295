"""Order, dedupe, scrub, split, stats, expansion, verifiers against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import dedupe, expand, order, scrub, split, stats, verifiers
from corpusloom.operators.deliveries import drop_repeated, keyed_messages, rank_in_group
from corpusloom.sources import config
from tests.test_render import frame, msg, rec

CHAT = "row_id bigint, source string, conversation_id string, ts string, sender string, text string"


def test_deliveries(spark):
    t = "2023-01-01T00:00:00Z"
    rows = [(5, "s", "c", t, " Me", "x"), (3, "s", "c", "2023-01-01T01:00:00+01:00", "me", "x"), (4, "s", "c", t, "me", None), (6, "s", "c", t, "ME ", None), (7, "s", "c", None, "me", "x"), (8, "s", "c", None, "me", "x"), (9, "s", "c", t, None, "x"), (10, "s", "c", t, "", "x"), (11, "s", "d", t, "me", "x"), (12, "s", "c", t, "me", "")]
    kept = sorted(r["row_id"] for r in drop_repeated(keyed_messages(spark.createDataFrame(rows, CHAT))).collect())
    assert kept == [3, 4, 7, 8, 9, 10, 11, 12]


def test_rank_in_group(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(5)}", rng.randrange(50), i) for i in range(800)]
    df = spark.createDataFrame(rows, "g string, t int, i int")
    got = {(r["g"], r["i"]): r["n"] for r in rank_in_group(df, ["g"], F.floor(F.col("t") / 7), ["t", "i"], "n").collect()}
    want = {}
    for g in {r[0] for r in rows}:
        for k, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2])), 1):
            want[g, r[2]] = k
    assert got == want


@pytest.mark.parametrize("seed", range(2))
def test_sessionize_like_a_fold(spark, seed):
    rng = random.Random(seed)
    rows, pos = [], 0
    for u in range(6):
        t = 0
        for _ in range(40):
            t += rng.choice([1, 10, 11, 30, -3])
            rows.append((f"u{u}", pos, t))
            pos += 1
    got = {r["pos"]: r["segment"] for r in order.sessionize(spark.createDataFrame(rows, "u string, pos int, t bigint"), ["u"], "t", ["pos"], 10, 4).collect()}
    want = {}
    for u in {r[0] for r in rows}:
        seg, size, last = 0, 0, None
        for _, p, t in sorted((r for r in rows if r[0] == u), key=lambda r: r[1]):
            if size and (t - last > 10 or size >= 4):
                seg, size = seg + 1, 0
            want[p], size, last = seg, size + 1, t
    assert got == want


@pytest.mark.parametrize("n,k", [(10, 3), (7, 7), (5, 9), (100, 33), (97, 96), (1, 1), (12, 0)])
def test_stride(spark, n, k):
    got = sorted(r["x"] for r in order.stride_all(spark.createDataFrame([(i,) for i in range(n)], "x int"), ["x"], k).collect())
    assert got == (list(range(n)) if k <= 0 or k >= n else [int(i * (n / k)) for i in range(k)])


@pytest.mark.parametrize("n,h,k", [(40, 8, 10), (40, 0, 10), (20, 19, 5), (10, 3, 10)])
def test_stratified(spark, n, h, k):
    df = spark.createDataFrame([(i, i % (n // h) == 0 and i // (n // h) < h if h else False) for i in range(n)], "x int, held boolean")
    rows = order.stratified_stride(df, ["x"], F.col("held"), k).collect()
    held, free = [i for i, f in df.collect() if f], [i for i, f in df.collect() if not f]
    take = min(max(1, round(k * len(held) / n)), max(k - 1, 1), len(held)) if held else 0
    pick = lambda xs, m: xs if m >= len(xs) else [xs[int(i * (len(xs) / m))] for i in range(m)]
    assert sorted(r["x"] for r in rows) == sorted(pick(held, take) + pick(free, k - take))


def test_numbered(spark):
    rows = [(i * 7919 % 1000,) for i in range(1000)]
    got = sorted((r["pos"], r["x"]) for r in order.numbered(spark.createDataFrame(rows, "x int").repartition(7), ["x"]).collect())
    assert got == [(i, i) for i in range(1000)]


def test_dominance_cap(spark):
    counts = {"a": 100, "b": 30, "c": 5, "d": 1}
    got = {r["t"]: r["cap"] for r in order.dominance_cap(spark.createDataFrame(list(counts.items()), "t string, n bigint"), 0.4).collect()}
    now = dict(counts)
    while True:
        limit = max(1, int(sum(now.values()) * 0.4))
        over = [k for k, v in now.items() if v > limit]
        if not over:
            break
        now |= dict.fromkeys(over, limit)
    assert got == now


def test_group_cap_and_keep_first(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(10)], "x int, g string")
    assert [r["x"] for r in order.group_cap(df, "g", ["x"], 2, 3).orderBy("x").collect()] == [0, 1, 2]
    assert sorted(r["x"] for r in order.keep_first(df, "g", "x").collect()) == [0, 1]


def test_near_duplicates(spark):
    base = [f"word{i}" for i in range(60)]
    near, far = base[:58] + ["other", "end"], base[:30] + [f"x{i}" for i in range(30)]
    texts = [" ".join(base), " ".join(near), " ".join(far), " ".join(base), "short text", "short text", "", None, " ".join(near)]
    got = {r["id"]: (r["duplicate_of"], r["kind"]) for r in dedupe.duplicates(spark.createDataFrame(list(enumerate(texts)), "id bigint, t string"), "id", "id", "t").collect()}
    assert got == {1: (0, "near"), 3: (0, "exact"), 5: (4, "exact"), 7: (6, "exact"), 8: (1, "exact")}
    assert dedupe.duplicates(spark.createDataFrame([], "id bigint, t string"), "id", "id", "t").count() == 0


def test_near_duplicates_like_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for i in range(60):
        w = texts[rng.randrange(len(texts))].split() if texts and rng.random() < 0.5 else [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(3, 80))]
        w = [f"n{rng.randrange(9999)}" if rng.random() < rng.choice([0, 0.005, 0.02]) else x for x in w]
        texts.append(" ".join(w))
    a, b = dedupe.permutations()

    def sig(t):
        w = t.split(" ")
        if len(w) < 5:
            return None
        hs = {int(hashlib.md5(" ".join(w[i : i + 5]).encode()).hexdigest()[:8], 16) % dedupe.PRIME for i in range(len(w) - 4)}
        return [min((x * h + y) % dedupe.PRIME for h in hs) for x, y in zip(a, b)]

    sigs, want, seen = [sig(t) for t in texts], {}, {}
    for i, t in enumerate(texts):
        if t in seen:
            want[i] = "exact"
            continue
        seen[t] = i
        for j in seen.values():
            if j < i and sigs[i] and sigs[j] and any(sigs[i][k : k + 8] == sigs[j][k : k + 8] for k in range(0, 128, 8)) and sum(x == y for x, y in zip(sigs[i], sigs[j])) / 128 >= 0.8:
                want[i] = "near"
                break
    got = {r["id"]: r["kind"] for r in dedupe.duplicates(spark.createDataFrame(list(enumerate(texts)), "id bigint, t string"), "id", "id", "t").collect()}
    assert got == want and "near" in want.values()


def test_scrub(spark):
    df = frame(spark, rec([msg("user", "mail me: a.b@c.example"), msg("assistant", "As an AI I delve", thought="claude says"), msg("tool", "deepseek 123-45-6789", call_id="1")]))
    hits = df.select(scrub.record_hits(F.col("messages"))).first()[0]
    assert hits == ["drop:ai_selfid", "drop:pii_email", "drop:teacher_anthropic", "drop:teacher_deepseek", "flag:boilerplate_delve"]
    d = df.select(scrub.lane_hits(F.lit(["drop:pii_email", "flag:pii_phone", "drop:pii_ssn"]), F.lit("d")), scrub.lane_hits(F.lit(["drop:pii_email"]), F.lit("a"))).first()
    assert d[0] == ["drop:pii_ssn"] and d[1] == ["drop:pii_email"]


def test_pseudonyms(spark):
    df = spark.createDataFrame([(2, "Bo met Al"), (1, "Al and al; Cy"), (3, None)], "pos int, t string")
    m = scrub.pseudonym_table(df, ["pos"], "t", ["Al", "Bo", "Cy"], preserve=["cy"])
    assert {r["name"]: r["pseudonym"] for r in m.collect()} == {"al": "Person-1", "bo": "Person-2"}
    out = {r["pos"]: r["t"] for r in scrub.pseudonymise(df, "t", m, ["Al", "Bo", "Cy"]).collect()}
    assert out == {1: "Person-1 and al; Cy", 2: "Person-2 met Person-1", 3: None}
    more = scrub.pseudonym_table(spark.createDataFrame([(1, "Di")], "pos int, t string"), ["pos"], "t", ["Di"], known=m)
    assert {r["name"]: r["pseudonym"] for r in more.collect()}["di"] == "Person-3"


def test_split_is_exact_and_guarded(spark):
    df = spark.createDataFrame([(i, f"k{i % 37}", i % 37 == 5) for i in range(200)], "id int, k string, h boolean")
    out = split.split_train_eval(df, "k", "h", 0.25, 9)
    keys = sorted({f"k{i}" for i in range(37)} - {"k5"}, key=lambda k: (hashlib.sha256(f"9:{k}".encode()).hexdigest(), k))
    want = set(keys[: int(36 * 0.25)]) | {"k5"}
    assert {r["k"] for r in out.where("is_eval").collect()} == want
    split.guard(out, "k", "h")
    with pytest.raises(split.HoldoutViolation):
        split.guard(out.withColumn("is_eval", F.lit(False)), "k", "h")
    with pytest.raises(split.HoldoutViolation):
        split.guard(spark.createDataFrame([("f", True, True), ("f", False, False)], "k string, h boolean, is_eval boolean"), "k", "h")


def test_percentiles_and_interiority(spark):
    vals = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]
    got = {r["p"]: r["value"] for r in stats.percentiles_nearest(spark.createDataFrame([(v,) for v in vals], "v int"), "v").collect()}
    s = sorted(vals)
    assert got == {p: s[min(len(s) - 1, p * len(s) // 100)] for p in (10, 25, 50, 75, 90)}
    text = "she wondered and " * 300
    assert spark.createDataFrame([(text,), ("short",)], "t string").select(stats.interiority(F.col("t"))).collect()[0][0] == pytest.approx(1000 / 3)


def test_weighted_judge(spark):
    scores = [("a", "x", 5.0), ("a", "y", 4.0), ("a", "z", 4.0), ("a", "w", 4.0), ("b", "x", 5.0), ("c", "x", 9.0), ("c", "y", 0.0), ("c", "z", 5.0), ("c", "w", 5.0), ("a", "extra", 1.0)]
    rubric = spark.createDataFrame([("x", 2.0, 3.0), ("y", 1.0, 3.0), ("z", 1.0, None), ("w", 1.0, None)], "axis string, weight double, minimum double")
    got = {r["id"]: (r["overall"], r["passed"], r["n_missing"]) for r in stats.weighted_judge(spark.createDataFrame(scores, "id string, axis string, score double"), rubric, 3.5).collect()}
    assert got["a"] == (4.4, True, 0) and got["b"][1:] == (False, 3) and got["c"] == (4.2, False, 0)


def test_owner_and_groups(spark):
    t = spark.createDataFrame([("1", "me"), ("1", "x"), ("2", "me"), ("2", "y")], "thread string, m string")
    assert stats.most_common_member(t, "thread", "m").first()["m"] == "me"
    with pytest.raises(Exception, match="tied"):
        stats.most_common_member(t.where("thread = '1'"), "thread", "m").collect()
    rows = spark.createDataFrame([("g", "a" * i, i) for i in range(1, 8)] + [("h", "b", 9)], "g string, t string, pos int")
    got = stats.longest_of_groups(rows, "g", "t", "pos", 5, 2, 6).collect()
    assert len(got) == 1 and got[0]["n"] == 7 and got[0]["texts"] == ["aaaaaa", "aaaaaa"]


def test_expansion(spark):
    t = {"id": "f.x", "family": "f", "params": {"b": [1, 2], "a": ["p", "q"]}, "prompt": "{a}{b}", "n_rollouts": 2, "verifier": "v"}
    rows = expand.expand_tasks(config.tasks_table(spark, [t]), "P").orderBy("combo").collect()
    assert [r["prompt"] for r in rows] == ["p1", "p2", "q1", "q2"]
    payload = '{"params":{"a":"p","b":"1"},"template":"f.x"}'
    assert rows[0]["instance_key"] == hashlib.sha256(payload.encode()).hexdigest()[:12]
    r = expand.rollout_order(spark.createDataFrame([(0, 2), (1, 1), (2, 3)], "i int, n_rollouts int"), ["i"]).orderBy("prompt_index").collect()
    assert [(x["prompt_index"], x["i"]) for x in r] == [(0, 0), (1, 1), (2, 2), (3, 0), (4, 2), (5, 2)]
    with pytest.raises(ValueError):
        config.check_task(t | {"id": "other"})
    with pytest.raises(ValueError):
        config.check_task(t | {"param_mode": "zip", "params": {"a": [1], "b": [1, 2]}})
    with pytest.raises(ValueError):
        config.check_task(t | {"prompt": "{missing}"})


def write(cid, path, content):
    return (cid, "write_file", [("path", path, f'"{path}"'), ("content", content, '""')])


def outcome(spark, check, params, *turns, end="all done"):
    df = frame(spark, rec([msg("user", "go"), *turns, msg("assistant", end)]))
    p = F.create_map(*[F.lit(x) for kv in params.items() for x in kv]) if params else F.lit(None).cast("map<string,string>")
    r = df.select(check(F.col("messages"), p).alias("r")).first()["r"]
    return r["passed"], set(r["failed"])


def did(cid, call, result='{"bytes_written": 3}'):
    return [msg("assistant", "", calls=[call]), msg("tool", result, call_id=cid)]


def test_save_note(spark):
    p = {"destination": "notes/a.txt", "index": "notes/index.md"}
    good = [*did("1", write("1", "/work/notes/a.txt", "hello")), *did("2", write("2", "notes/index.md", "- a.txt"))]
    assert outcome(spark, verifiers.save_note, p, *good) == (True, set())
    assert outcome(spark, verifiers.save_note, p, *did("1", write("1", "notes/a.txt", "x"), '{"error": "disk"}'), *good)[0]
    assert outcome(spark, verifiers.save_note, p, *good, *did("3", write("3", "notes/a.txt", "x"), '{"error": "disk"}'))[1] == {"wrote_requested_path"}
    assert outcome(spark, verifiers.save_note, p, *did("1", write("1", "evil-notes/a.txt", "hello")))[0] is False
    assert outcome(spark, verifiers.save_note, p, *good, end=" ")[1] == {"confirmed_to_user"}
    assert outcome(spark, verifiers.save_note, {}, *good)[0] is False


def test_batch_and_count(spark):
    p = {"prefix_dir": "d", "count": "2", "required_line": "TOP"}
    both = [*did("1", write("1", "d/note-1.txt", "TOP\nx")), *did("2", write("2", "d/note-2.txt", "TOP"))]
    assert outcome(spark, verifiers.batch_consistency, p, *both) == (True, set())
    assert outcome(spark, verifiers.batch_consistency, p, *both[:2])[1] == {"notes_written"}
    c = {"destination": "l.txt", "count_destination": "c.txt", "entries_block": "1. a \n2. b\n", "true_count": "7"}
    assert outcome(spark, verifiers.tagged_count, c, *did("1", write("1", "l.txt", "1. a\n2. b\n\n")), *did("2", write("2", "c.txt", "count: 7")))[0]
    assert outcome(spark, verifiers.tagged_count, c, *did("1", write("1", "l.txt", "1. a")), *did("2", write("2", "c.txt", "count: 17")))[1] == {"wrote_log_verbatim", "wrote_correct_count"}


def test_rename_lines_payment(spark):
    p = {"destination": "f.py", "old_term": "foo", "new_term": "bar"}
    patch = ("2", "patch", [("path", "f.py", '"f.py"'), ("old_string", "foo", '"foo"'), ("new_string", "bar", '"bar"'), ("replace_all", "True", "true")])
    assert outcome(spark, verifiers.rename_patch, p, *did("1", write("1", "f.py", "foo foo")), *did("2", patch))[0]
    once = ("2", "patch", patch[2][:3])
    assert outcome(spark, verifiers.rename_patch, p, *did("1", write("1", "f.py", "foo foo")), *did("2", once))[1] == {"old_term_gone"}
    q = {"destination": "l.txt", "n_lines": "3"}
    assert outcome(spark, verifiers.exact_lines, q, *did("1", write("1", "l.txt", "Ann\nbob\nCy\n")))[0]
    assert outcome(spark, verifiers.exact_lines, q, *did("1", write("1", "l.txt", "1. b\na")))[1] == {"exact_line_count", "no_list_markers"}
    r = {"destination": "p.txt", "principal": "250000", "rate_pct": "6", "years": "30"}
    assert outcome(spark, verifiers.calc_note, r, *did("1", write("1", "p.txt", "You pay $1,498.88 a month")))[0]
    assert outcome(spark, verifiers.calc_note, r, *did("1", write("1", "p.txt", "1500")))[1] == {"correct_amount"}


def test_notes_and_sources(spark):
    p = {"destination": "notes/bird.md", "hub": "Hub.md"}
    good = [*did("1", write("1", "notes/bird.md", "---\ntags: [a]\n---\nsee [[Hub]]")), *did("2", write("2", "Hub.md", "- [[notes/bird|Bird]]"))]
    assert outcome(spark, verifiers.linked_note, p, *good) == (True, set())
    assert outcome(spark, verifiers.linked_note, p, *did("1", write("1", "notes/bird.md", "no")), *good[2:])[1] == {"note_has_frontmatter_tags", "note_backlinks_hub"}
    u = [f"https://s{i}.example/x" for i in range(3)]
    search = did("0", ("0", "search", []), " ".join(u))
    text = "One says so. " + " ".join(x + "/." for x in u)
    assert outcome(spark, verifiers.compare_sources, {"destination": "r.md"}, *search, *did("1", write("1", "r.md", text)))[0]
    assert outcome(spark, verifiers.compare_sources, {"destination": "r.md"}, *did("1", write("1", "r.md", text)))[1] == {"cited_three_grounded_sources"}
    assert outcome(spark, verifiers.fact_ratio, {"destination": "r.md"}, *search, *did("1", write("1", "r.md", f"A is 300, B 100, ratio 3.0. {u[0]} {u[1]}")))[0]
    assert outcome(spark, verifiers.fact_ratio, {"destination": "r.md"}, *search, *did("1", write("1", "r.md", f"A is 300, B 100, ratio 7. {u[0]} {u[1]}")))[1] == {"ratio_internally_consistent"}


def test_lane_verifiers(spark):
    scene = [msg("assistant", f"t{i}", "AB"[i % 2], "th") for i in range(6)]
    df = frame(spark, rec(scene, "## Scene x"), rec([msg("user", "a"), msg("assistant", "User: I say"), msg("user", "b"), msg("assistant", "x")]))
    a, b = df.select(verifiers.scene_wellformed(F.col("messages"), F.col("system"))["passed"].alias("s"), verifiers.no_impersonation(F.col("messages"))["passed"].alias("n"), verifiers.turn_dynamics(F.col("messages"))["failed"].alias("t")).collect()
    assert a["s"] and a["n"] and not b["s"] and not b["n"] and b["t"] == ["enough_exchanges"]


def test_hot_buckets_lose_no_pair(spark):
    """Signatures that all share a band: split buckets give what pairing everything gives."""
    rng = random.Random(3)
    base = [rng.randrange(1000) for _ in range(128)]
    rows = []
    for i in range(60):
        changed = set(rng.sample(range(8, 128), rng.choice([0, 5, 12, 13, 25, 26, 60])))
        rows.append((i, [rng.randrange(1000, 2000) if k in changed else v for k, v in enumerate(base)]))
    signed = spark.createDataFrame(rows, "pos bigint, sig array<bigint>")
    agree = lambda x, y: sum(p == q for p, q in zip(x, y)) / 128
    want = {i: min((j for j in range(i) if agree(rows[j][1], rows[i][1]) >= 0.8), default=None) for i in range(60)}
    for hot in (1, 1000):
        got = {r["pos"]: r["earlier"] for r in dedupe.near_pairs(signed, "pos", 0.8, hot=hot).collect()}
        assert got == {k: v for k, v in want.items() if v is not None}
