"""Queries of text and time functions, seeds, grids, model calls with scripted models, trajectories, verifiers on planted records, and configuration files."""

from __future__ import annotations

import json
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import hashing, spans
from corpusloom.functions import text as T
from corpusloom.functions.timestamps import days_between, instant_us
from corpusloom.operators import dedupe, expand, records, scrub, stats, trajectories, verifiers
from corpusloom.plans import gate, models
from corpusloom.queries import SQL, SQL_MESSAGES, SQL_WS, query
from corpusloom.session import table
from corpusloom.sources import config


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')"


# --- functions -----------------------------------------------------------------------------------------


@query(
    "text_functions",
    f"""with d as (select doc_id, replace(text, chr(13), '') as t from documents where text is not null),
s as (select *, trim(regexp_replace(t, '{SQL_WS}+', ' ', 'g')) as one, {_strip('t')} as bare from d),
h as (select *, substr(one, 1, 80) as head, substr(bare, 1, 120) as lines from s)
select doc_id,
  sha256(case when length(one) <= 80 then one else rtrim(case when contains(head, ' ') and regexp_extract(head, '(?s)^(.*)\\s', 1) <> '' then regexp_extract(head, '(?s)^(.*)\\s', 1) else head end) || '…' end) as shortened,
  sha256(case when length(bare) <= 120 then bare else case when regexp_extract(lines, '(?s)^(.*)\\n', 1) = '' then lines else regexp_extract(lines, '(?s)^(.*)\\n', 1) end || chr(10) || '…' end) as summary,
  sha256({_strip("regexp_replace(t, '(?m)^```[A-Za-z0-9]*[ \\t]*$\\n?', '', 'g')")}) as unfenced,
  sha256(regexp_replace(t, '(?s)[?#].*', '')) as cleaned,
  sha256(regexp_replace(lower(substr(t, 1, 1)) || substr(t, 2), '[.!]+$', '')) as sloppy,
  len(regexp_extract_all(t, '(?m)^[ \\t]*\\d+[.)][ \\t]+(.*\\S)[ \\t]*$', 1)) as n_items
from h""",
)
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short forms, summaries, texts without fences and query strings, casual spelling and numbered items of every document."""
    d = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.replace("text", F.lit("\r"), F.lit("")).alias("t"))
    t = F.col("t")
    named = {"shortened": T.shorten(t, 80), "summary": T.summary_lines(t, 120), "unfenced": T.fence_strip(t), "cleaned": T.clean_url(t), "sloppy": spans.sloppy(t)}
    return d.select("doc_id", *[F.sha2(c, 256).alias(k) for k, c in named.items()], F.size(spans.list_items(t)).cast("bigint").alias("n_items"))


@query(
    "think_blocks",
    """select rec_no, case when rec_no % 2 = 0 then 'plan ' || rec_no end as thought, coalesce(prompt, '') as rest, '{"a": ' || rec_no || '}' is not null as ok from task_instances""",
)
def think_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thoughts lifted off replies, where there are any."""
    p = F.coalesce("prompt", F.lit(""))
    reply = F.when(F.col("rec_no") % 2 == 0, F.concat(F.lit("<think>\nplan "), F.col("rec_no").cast("string"), F.lit("\n</think>\n"), p)).otherwise(p)
    t = table(spark, sf_dir, "task_instances").select("rec_no", spans.split_think(reply).alias("s"))
    return t.select("rec_no", "s.thought", "s.rest", F.lit(True).alias("ok"))


@query("card_placeholders", "select rec_no, case when rec_no % 3 = 2 then null else true end as filled from seeds")
def card_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards in which the user's name is filled in; one with another placeholder left is null."""
    s = table(spark, sf_dir, "seeds")
    card = F.concat(F.lit("Hello {{user}}, "), F.coalesce(F.regexp_replace("card", r"[{}]", ""), F.lit("")), F.when(F.col("rec_no") % 3 == 2, " {{char}}").otherwise(""))
    filled = spans.fill_placeholders(card, F.col("rec_no"))
    name = F.regexp_extract(filled, r"^Hello (\w+), ", 1).isin(*spans.USER_NAMES)
    return s.select("rec_no", F.when(filled.isNotNull(), name).alias("filled"))


@query("message_days", f"with {SQL_MESSAGES} select row_id, datediff('day', date '2020-02-29', cast(make_timestamp(ts_us) as date)) as days from keyed where ts_us is not null")
def message_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole days from a fixed date to every message."""
    c = table(spark, sf_dir, "chat_messages").select("row_id", instant_us(F.col("ts")).alias("us")).where("us is not null")
    leap = F.lit(1_582_934_400_000_000)
    return c.select("row_id", days_between(F.col("us"), leap).cast("bigint").alias("days"))


@query("loan_payments", "select o_orderkey, case when o_orderkey % 31 > 0 then round(o_totalprice * (o_orderkey % 9 + 1) / 1200.0 / (1 - pow(1 + (o_orderkey % 9 + 1) / 1200.0, -12 * (o_orderkey % 31))), 4) end as payment from orders")
def loan_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly payments of amortised loans; a loan without a term has none."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(verifiers.monthly_payment(F.col("o_totalprice").cast("double"), (k % 9 + 1).cast("double"), k % 31), 4).alias("payment"))


@query("record_ids", """select rec_no, 'a-' || substr(sha256('{"lane": "a", "run_id": "r1", "salt": "' || n_rollouts || '", "source": {"detail": {"prompt_index": ' || rec_no || '}, "kind": "task_instance"}}'), 1, 16) as record_id from task_instances where n_rollouts is not null""")
def record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of records by their run, source and salt."""
    detail = records.source_detail({"prompt_index": F.col("rec_no").cast("string")})
    return table(spark, sf_dir, "task_instances").where("n_rollouts is not null").select("rec_no", records.record_id("a", "r1", "task_instance", detail, F.col("n_rollouts").cast("string")).alias("record_id"))


@query("canonical_forms", """select rec_no, '{"a":[1,2],"b":{"n":' || rec_no || ',"z":null}}' as canonical from seeds""")
def canonical_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON with sorted keys and no blanks."""
    loose = F.concat(F.lit('{ "b": {"z": null, "n": '), F.col("rec_no").cast("string"), F.lit('}, "a": [1,  2] }'))
    return table(spark, sf_dir, "seeds").select("rec_no", hashing.canonical_json_of(loose).alias("canonical"))


@query("request_keys", """select rec_no, sha256('{"messages":"p' || rec_no || '","model":"m","options":null,"system":"s"}') as request_key from seeds""")
def request_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache keys of model requests."""
    null = F.lit(None).cast("string")
    return table(spark, sf_dir, "seeds").select("rec_no", hashing.request_key(F.lit("m"), F.lit("s"), F.concat(F.lit("p"), F.col("rec_no").cast("string")), null).alias("request_key"))


# --- seeds and grids -----------------------------------------------------------------------------------


def _sql_stride(source: str, order: str, k: int) -> str:
    picks = f"(select cast(floor(i * (m::double / {k})) as bigint) from (select count(*) as m from {source}), (select unnest(range(0, {k})) as i))"
    numbered = f"(select *, row_number() over (order by {order}) - 1 as pos, count(*) over () as total from {source})"
    return f"(select * from {numbered} where total <= {k} or pos in {picks})"


def _sql_seed(kind: str, source: str, scenario: str, grounding: str, with_i: bool = False) -> str:
    own = " || '-' || i" if with_i else ""
    return f"select 'companion-{kind}-' || fk{own} as seed_id, 'companion/' || fk as family, ('0x' || substr(sha256('holdout:' || fk), 1, 8))::bigint % 1000 < 100 as holdout, sha256({scenario}) as scenario, sha256({grounding}) as grounding from {source}"


_FRAMINGS = ["It began lately.", "It never ends."]
_SQL_WHICH = f"case ('0x' || substr(sha256('variant:companion-obsession-' || fk), 1, 8))::bigint % 2 when 0 then '{_FRAMINGS[0]}' else '{_FRAMINGS[1]}' end"


@query(
    "companion_seeds",
    f"""with n as (select doc_id, 'kb/' || doc_id || '.md' as rel, 'kb-' || substr(sha256('kb/' || doc_id || '.md'), 1, 8) as fk, 'N' || doc_id as title, 'sum ' || doc_id as s, 'what ' || doc_id as w, 0 as i from documents where doc_kind = 'note'),
g as (select source, count(*) as n, min(doc_id) as first_seen from documents where text is not null group by source having count(*) >= 5),
l as (select source, substr(text, 1, 600) as t, row_number() over (partition by source order by length(text) desc, doc_id) as k from documents where text is not null),
c as (select g.source, -g.n as rank, g.first_seen, 'reddit-' || substr(sha256(lower(g.source)), 1, 8) as fk, string_agg(l.t, chr(10) || chr(10) order by l.k) as texts from g join l on g.source = l.source and l.k <= 4 group by g.source, g.n, g.first_seen)
{_sql_seed('event', _sql_stride('n', 'rel, i', 20), "'The user brings up something from May 1 (2020): ' || w", "'## What you remember about 2020' || chr(10) || s || chr(10) || chr(10) || '## This particular thing' || chr(10) || 'May 1: ' || w", True)}
union all {_sql_seed('person', 'n', "'The user talks about ' || title || '.'", "'## What you know about ' || title || chr(10) || s")}
union all {_sql_seed('topic', _sql_stride('n', 'rel, i', 15), "'The user comes back to this: ' || w", "s || chr(10) || chr(10) || w", True)}
union all {_sql_seed('obsession', _sql_stride('n', 'rel', 10), f"'The user is full of ' || title || '. ' || {_SQL_WHICH}", 's')}
union all {_sql_seed('interest', _sql_stride('c', 'rank, first_seen', 7), "'The user explains something from ' || source || ' unprompted.'", 'texts')}""",
)
def companion_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds of all kinds from notes and from the most active communities, each kind capped by stride."""
    number = F.col("doc_id").cast("string")
    rel = F.concat(F.lit("kb/"), number, F.lit(".md"))
    d = table(spark, sf_dir, "documents")
    n = d.where("doc_kind = 'note'").select(rel.alias("rel"), hashing.note_family(F.lit("kb"), rel).alias("family_key"), F.concat(F.lit("N"), number).alias("title"), F.concat(F.lit("sum "), number).alias("summary"), F.concat(F.lit("what "), number).alias("what"), F.lit(0).alias("i"))
    c = stats.longest_of_groups(d.select("source", "text", "doc_id"), "source", "text", "doc_id").withColumnRenamed("source", "community")
    kinds = [
        expand.event_seeds(n.withColumn("year", F.lit("2020")).withColumn("when", F.lit("May 1")), "Quill", 20),
        expand.person_seeds(n.drop("i"), "Quill", 0),
        expand.topic_seeds(n.withColumnRenamed("what", "bullet"), "Quill", 15),
        expand.obsession_seeds(n.drop("i"), "Quill", 10, _FRAMINGS),
        expand.interest_seeds(c, "Quill", 7),
    ]
    return expand.seeds_of_all_kinds(kinds).select("seed_id", "family", "holdout", F.sha2("scenario", 256).alias("scenario"), F.sha2("grounding", 256).alias("grounding"))


@query(
    "job_grid",
    """select rec_no, unnest(case when len(user_sim_personas) > 0 then user_sim_personas else ['critic', 'fan', 'rival'] end) as persona_id, r as repeat from seeds, (select unnest([0, 1]) as r)""",
)
def job_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seed with its simulated users and repeats."""
    personas = spark.createDataFrame([(p,) for p in ("rival", "fan", "critic")], "persona_id string")
    return expand.job_grid(table(spark, sf_dir, "seeds"), personas, 2).select("rec_no", "persona_id", F.col("repeat").cast("bigint").alias("repeat"))


@query("batch_inputs", """with r as (select rec_no, coalesce(prompt, '') as prompt, unnest(range(0, n_rollouts)) as round from task_instances where n_rollouts > 0) select row_number() over (order by round, rec_no) - 1 as prompt_index, '{"prompt": ' || to_json(prompt) || '}' as line from r""")
def batch_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prompts of all rollouts as numbered lines for an external runner."""
    t = table(spark, sf_dir, "task_instances").select("rec_no", "prompt", "n_rollouts")
    return expand.batch_inputs(expand.rollout_order(t, ["rec_no"]))


@query("few_shots", "select * from (values ('files.copy', 0, 'a', '1'), ('files.copy', 1, 'b', '2')) t(template_id, n, name, size)")
def few_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first instances of a template as examples."""
    task = {"id": "files.copy", "family": "files", "params": {"name": ["a", "b", "c"], "size": [1, 2], "mood": ["x"]}, "prompt": "{name} {size} {mood}", "verifier": "v"}
    e = expand.few_shots(config.tasks_table(spark, [task]), ["name", "size"], 3)
    return e.select("template_id", F.col("n").cast("bigint").alias("n"), F.col("example")["name"].alias("name"), F.col("example")["size"].alias("size"))


@query("spend_totals", "with u as (select l_returnflag as teacher, cast(l_quantity as bigint) as tin, cast(l_extendedprice as bigint) as tout from lineitem), p as (select * from (values ('A', 1.0, 2.0), ('N', 0.5, 1.5)) t(teacher, a, b)) select teacher, cast(sum(tin) as bigint) as tokens_in, cast(sum(tout) as bigint) as tokens_out, round_even(sum((tin * coalesce(a, 0) + tout * coalesce(b, 0)) / 1e6), 4) as cost from u left join p using (teacher) group by teacher")
def spend_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and rounded cost of each teacher over all lanes."""
    u = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("teacher"), F.col("l_linestatus").alias("lane"), F.round("l_quantity").cast("bigint").alias("tokens_in"), F.bround("l_extendedprice").cast("bigint").alias("tokens_out"))
    prices = spark.createDataFrame([("A", 1.0, 2.0), ("N", 0.5, 1.5)], "teacher string, price_in double, price_out double")
    return stats.spend_totals(stats.usage_totals(u, prices))


@query(
    "persona_samples",
    """with p as (select rec_no, p, row_number() over (partition by rec_no order by sha256(seed_id || ':' || p), p) as k from seeds, (select unnest(['a', 'b', 'c', 'd', 'e']) as p) where seed_id is not null)
select rec_no, string_agg(p, ',' order by k) as personas from p where k <= 2 group by rec_no""",
)
def persona_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of five simulated users for each seed, by hash."""
    pool = F.array(*[F.lit(x) for x in "abcde"])
    s = table(spark, sf_dir, "seeds").where("seed_id is not null")
    return s.select("rec_no", F.array_join(expand.hash_sample_personas(F.col("seed_id"), pool, 2), ",").alias("personas"))


@query("scene_seeds", "with r as (select doc_id, row_number() over (partition by source order by doc_id) as k from documents where doc_id % 4 >= 2) select doc_id from r where k <= 3")
def scene_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three scenes of each work with two speakers or more."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("work_id"), (F.col("doc_id") % 4).alias("n_speakers"))
    return expand.scene_seeds(d, 3, ["doc_id"]).select("doc_id")


# --- scripted models -----------------------------------------------------------------------------------


def _user(batch: list[dict]) -> list[str]:
    def one(r: dict) -> str:
        n = len(json.loads(r["prompt"]))
        return "[END]" if int(r["seed_id"]) % 4 == 0 and n >= 8 else f"ask{n}a ask{n}b ask{n}c ask{n}d ask{n}e"

    return [one(r) for r in batch]


def _character(batch: list[dict]) -> list[str]:
    def one(r: dict) -> str:
        n, kind = len(json.loads(r["prompt"])), int(r["seed_id"]) % 4
        return "again the very same words" if kind == 1 else " " if kind == 2 else f"say{n}a say{n}b say{n}c say{n}d say{n}e"

    return [one(r) for r in batch]


@query("self_play", "select rec_no, case rec_no % 4 when 0 then 8 when 1 then 2 when 2 then 1 else 24 end as n_messages, case rec_no % 4 when 0 then 'user_ended' when 1 then 'degenerate' when 2 then 'empty_turn' else 'max_turns' end as stop from seeds")
def self_play(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations between two scripted models, and why each ended."""
    s = table(spark, sf_dir, "seeds").select(F.col("rec_no").cast("string").alias("seed_id"), "card")
    r = models.self_play_all(s, _character, _user, 4)
    return r.select(F.col("seed_id").cast("bigint").alias("rec_no"), F.size("messages").cast("bigint").alias("n_messages"), "stop")


def _scores(batch: list[dict]) -> list[str]:
    """Scores by the length of what is read; some replies are fenced, some leave out an axis, some mend when asked again."""

    def one(r: dict) -> str:
        text = r["prompt"].split("\n\nYour reply was invalid")[0]
        n, again = len(text), text != r["prompt"]
        scores = {"voice": 1 + n % 5} if n % 7 == 0 else {"voice": 1 + n % 5, "substance": 1 + n % 3}
        reply = json.dumps({"scores": scores})
        return "no json" if n % 5 == 1 and not again else f"```json\n{reply}\n```" if n % 2 else reply

    return [one(r) for r in batch]


@query(
    "judged_by_model",
    f"""with t as (select rec_no, length(transcript) as n from ({SQL['judge_transcripts']})),
s as (select rec_no, n, 1 + n % 5 as voice, 1 + n % 3 as substance from t)
select rec_no, case when n % 7 <> 0 then round((2.0 * voice + substance) / 3, 3) end as overall, case when n % 7 <> 0 then voice >= 3 and (2.0 * voice + substance) / 3 >= 2.5 end as passed, n % 7 = 0 as failed from s""",
)
def judged_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record read by a scripted judge under a rubric of two axes; an omitted axis is an error."""
    own = F.col("provenance").withField("record_id", F.col("rec_no").cast("string"))
    r = table(spark, sf_dir, "conv_records").withColumn("provenance", own).withColumn("drop_reason", F.lit(None).cast("string"))
    rubric = spark.createDataFrame([("voice", 2.0, 3.0), ("substance", 1.0, None)], "axis string, weight double, minimum double")
    v = gate.model_verdicts(r, rubric, {"voice": "keeps the voice", "substance": "says something"}, 2.5, "Read this.\n{axes}", _scores, "judge-20250101", 4)
    return v.select(F.col("record_id").cast("bigint").alias("rec_no"), "overall", "passed", F.col("error").isNotNull().alias("failed"))


@query("reply_items", """select rec_no, k as pos, 'item ' || k || ' of ' || rec_no as item from task_instances, (select unnest([0, 1]) as k) where rec_no % 3 <> 2""")
def reply_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of the JSON array in each reply; a reply without one gives none."""
    n = F.col("rec_no").cast("string")
    array = F.concat(F.lit('[{"t": "item 0 of '), n, F.lit('"}, 7, {"t": "item 1 of '), n, F.lit('"}]'))
    reply = F.when(F.col("rec_no") % 3 == 0, F.concat(F.lit("See [1], here:\n```json\n"), array, F.lit("\n```"))).when(F.col("rec_no") % 3 == 1, array).otherwise(F.lit("[broken"))
    t = table(spark, sf_dir, "task_instances").select("rec_no", F.posexplode(spans.surface_rows_of(reply)).alias("pos", "item"))
    return t.select("rec_no", F.col("pos").cast("bigint").alias("pos"), F.get_json_object("item", "$.t").alias("item"))


# --- trajectories and verifiers ------------------------------------------------------------------------


@query(
    "tool_turns",
    """with r as (select rec_no as prompt_index, coalesce(prompt, '') as prompt from task_instances),
m as (select * from (values (0, 'user'), (1, 'assistant'), (2, 'tool'), (3, 'tool'), (4, 'assistant')) t(pos, role))
select prompt_index, pos, role, case pos when 0 then prompt when 1 then 'I look.' when 2 then 'first' when 3 then '{"ok": true}' else 'Done.' end as content, case pos when 1 then 'plan' end as thought,
  case pos when 1 then 'x1:find(path=a b,deep={"k": [1, 2]});x2:find()' end as calls, case pos when 2 then 'x1' when 3 then 'x2' end as tool_call_id, '[{"name": "find"}]' as tools from r, m""",
)
def tool_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of trajectories with two calls of one tool, its responses, thoughts and tools."""
    call = lambda a: '<tool_call>\n{"name": "find", "arguments": ' + a + "}\n</tool_call>"
    response = lambda i, c: f'<tool_response>\n{{"tool_call_id": "{i}", "name": "find", "content": {c}}}\n</tool_response>'
    said = [
        ("system", F.lit('Use <tools>[{"name": "find"}]</tools> well.')),
        ("human", F.coalesce("prompt", F.lit(""))),
        ("gpt", F.lit("<think>\nplan\n</think>\nI look.\n" + call('{"path": "a b", "deep": {"k": [1, 2]}}') + call("{}"))),
        ("tool", F.lit(response("x1", '"first"') + response("x2", '{"ok": true}'))),
        ("gpt", F.lit("Done.")),
    ]
    turns = F.array(*[F.struct(F.lit(who).alias("from"), text.alias("value")) for who, text in said])
    t = table(spark, sf_dir, "task_instances").withColumn("prompt_index", F.col("rec_no"))
    tr = t.select("prompt_index", F.lit(True).alias("completed"), F.lit(False).alias("partial"), turns.alias("conversations"))
    ro = t.select("prompt_index", F.lit("find.it").alias("template_id"), F.lit("find").alias("family"), F.lit(False).alias("holdout"), F.lit("k").alias("instance_key"))
    m = trajectories.ingest(tr, ro, "Quill").select("prompt_index", F.col("tools_schema_json").alias("tools"), F.posexplode("messages").alias("pos", "m"))
    shown = F.transform("m.tool_calls", lambda c: F.concat(c["id"], F.lit(":"), c["name"], F.lit("("), F.array_join(F.transform(c["arguments"], lambda a: F.concat(a["name"], F.lit("="), a["rendered"])), ","), F.lit(")")))
    return m.select("prompt_index", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content", "m.thought", F.nullif(F.array_join(shown, ";"), F.lit("")).alias("calls"), "m.tool_call_id", "tools")


#: For each task template: parameters, and what a run that succeeds writes where.
_PLANTED: dict[str, tuple[dict[str, str], dict[str, str]]] = {
    "audit.batch_consistency": ({"count": "2", "prefix_dir": "notes", "required_line": "Checked"}, {"notes/note-1.txt": "Checked\none", "notes/note-2.txt": "Checked\ntwo"}),
    "count.tagged_count": ({"entries_block": "1. a #x\n2. b\n3. c #x\n", "true_count": "2", "destination": "l/log.txt", "count_destination": "l/n.txt"}, {"l/log.txt": "1. a #x\n2. b\n3. c #x", "l/n.txt": "There are 2."}),
    "files.save_note": ({"destination": "n/a.md", "index": "n/index.md"}, {"n/a.md": "A note.", "n/index.md": "- a.md"}),
    "refactor.rename_patch": ({"destination": "d.txt", "old_term": "cat", "new_term": "dog"}, {"d.txt": "The dog sat."}),
    "revise.exact_lines": ({"destination": "p.txt", "n_lines": "3"}, {"p.txt": "Alpha\nbeta\nGamma\n"}),
    "terminal.calc_note": ({"destination": "c.txt", "principal": "200000", "rate_pct": "6", "years": "30"}, {"c.txt": "You pay $1,199.10 a month."}),
    "vault.linked_note": ({"destination": "v/leaf.md", "hub": "v/hub.md"}, {"v/leaf.md": "---\ntags: [x]\n---\nSee [[hub]].", "v/hub.md": "- [[leaf|a leaf]]"}),
    "web.compare_sources": ({"destination": "w.md"}, {"w.md": "Compare https://a.example/1, https://b.example/2 and https://c.example/3 here."}),
    "webmath.fact_ratio": ({"destination": "f.md"}, {"f.md": "100 is 4 times 25, say https://a.example/1 and https://b.example/2."}),
}
_SEEN = '{"ok": true, "links": "https://a.example/1 https://b.example/2 https://c.example/3"}'


def _planted_runs() -> list[tuple[int, str, dict[str, str], list[tuple]]]:
    """For each template a run that succeeds, one whose writes all fail, and one that fails first and recovers."""
    runs = []
    for name, (params, writes) in _PLANTED.items():
        for kind in range(3):
            messages = [("user", "Please do it.", [], None), ("assistant", "", [("s", "search", [])], None), ("tool", _SEEN, [], "s")]
            for path, content in writes.items():
                for k, ok in enumerate({0: [True], 1: [False], 2: [False, True]}[kind]):
                    i = f"{path}-{k}"
                    messages.append(("assistant", "", [(i, "write_file", [("path", f"/home/me/{path}", None), ("content", content, None)])], None))
                    messages.append(("tool", '{"ok": true}' if ok else '{"error": "disk full"}', [], i))
            messages.append(("assistant", "All done.", [], None))
            runs.append((kind, name, params, messages))
    return runs


@query(
    "task_verifiers",
    f"""select rec_no, t as template_id, rec_no % 3 <> 1 as passed, rec_no % 3 = 1 as has_failures, 'tasks/' || replace(t, '.', '/') as verifier_id
from task_instances, (select unnest([{", ".join(f"'{t}'" for t in sorted(_PLANTED))}]) as t)""",
)
def task_verifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every task verifier on planted runs that succeed, fail, or fail and recover, one of these for each task."""
    ddl = "kind int, template_id string, params map<string,string>, m array<struct<role string, content string, calls array<struct<id string, name string, arguments array<struct<name string, rendered string, raw_json string>>>>, tool_call_id string>>"
    planted = spark.createDataFrame(_planted_runs(), ddl)
    null = F.lit(None).cast("string")
    messages = F.transform("m", lambda x: F.struct(x["role"].alias("role"), null.alias("speaker"), x["content"].alias("content"), null.alias("thought"), x["calls"].alias("tool_calls"), x["tool_call_id"].alias("tool_call_id"), null.alias("ts")))
    source = F.struct(F.lit("task_instance").alias("kind"), F.to_json(F.struct("params")).alias("detail_json"))
    provenance = F.struct(F.lit("a").alias("lane"), F.col("template_id"), F.lit("f").alias("family"), source.alias("source"))
    runs = planted.select("kind", "template_id", messages.alias("messages"), F.lit("").alias("system"), provenance.alias("provenance"))
    v = verifiers.verified(runs, "v").select("kind", "template_id", "v.passed", (F.size("v.failed") > 0).alias("has_failures"), "v.verifier_id")
    t = table(spark, sf_dir, "task_instances").select("rec_no", (F.col("rec_no") % 3).cast("int").alias("kind"))
    return t.join(F.broadcast(v), "kind").drop("kind")


@query("names_in_records", """with m as (select rec_no, unnest(messages) as m, generate_subscripts(messages, 1) as i from conv_records),
f as (select rec_no, i, 0 as k, m.content as t from m union all select rec_no, i, 1, m.thought from m union all select rec_no, i, 2, m.speaker from m where regexp_full_match(m.speaker, 'Halvard|Tamsin|Ysolt')),
x as (select rec_no, i, k, regexp_extract_all(t, '\\b(?:Halvard|Tamsin|Ysolt)\\b') as ns from f where t is not null),
n as (select lower(n) as name, min(struct_pack(r := rec_no, i := i, k := k, a := a)) as at_first from (select rec_no, i, k, unnest(ns) as n, generate_subscripts(ns, 1) as a from x) group by 1),
p as (select name, 'Person-' || row_number() over (order by at_first) as p from n),
s as (select list(struct_pack(n := upper(substr(name, 1, 1)) || substr(name, 2), p := p)) as ps from p),
y as (select rec_no, i, list_reduce(list_prepend(coalesce(m.content, chr(30)), list_transform(ps, lambda e: e.n || chr(31) || e.p)), lambda a, e: regexp_replace(a, '\\b' || split_part(e, chr(31), 1) || '\\b', split_part(e, chr(31), 2), 'g')) as c,
  list_reduce(list_prepend(coalesce(m.speaker, chr(30)), list_transform(ps, lambda e: e.n || chr(31) || e.p)), lambda a, e: case when a = split_part(e, chr(31), 1) then split_part(e, chr(31), 2) else a end) as w from m, s)
select rec_no, sha256(string_agg(w || ':' || c, chr(29) order by i)) as said from y group by rec_no""")
def names_in_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in contents, thoughts and speakers of all records become numbered pseudonyms."""
    r = table(spark, sf_dir, "conv_records").select("rec_no", "messages")
    out, _ = scrub.pseudonymise_records(r, "rec_no", ["Halvard", "Tamsin", "Ysolt"])
    mark = F.lit("\x1e")
    said = F.transform("messages", lambda m: F.concat(F.coalesce(m["speaker"], mark), F.lit(":"), F.coalesce(m["content"], mark)))
    return out.where(F.size("messages") > 0).select("rec_no", F.sha2(F.array_join(said, "\x1d"), 256).alias("said"))


# --- configuration -------------------------------------------------------------------------------------


@query(
    "config_files",
    """select * from (values ('task', 'files.copy', 'name=a,b;size=1,2'), ('tools', 'files', 'find,save'), ('persona', 'critic', 'rp'), ('persona', 'quiet', 'chat'), ('rp', 'critic', ''), ('pattern', 'code', 'drop:[0-9]{4}'), ('pattern', 'word', 'flag:x'),
('policy', 'd', 'code'), ('axis', 'voice', '2.0/3.0'), ('axis', 'substance', '1.0/None'), ('threshold', 'c', '3.5'), ('names', 'patterns', 'Ann|Bo'), ('names', 'preserve', 'Bo'), ('seed', 's1', 'Meet Quill.'), ('manifest', 'run', 'r1'), ('unpinned', 'm-latest', 'refused'),
('lanes', 'b,c', 'c'), ('lanes', 'b', 'refused'), ('frozen', 'same', 'ok'), ('frozen', 'changed', 'refused'), ('book', 'w', '- work_id: w\n  path: "p"\n  author: "a\\"b"\n  title: "t"\n'), ('ship', 'd', 'lane d is exempt from publishing'), ('ship', 'train', 'train is missing or empty'), ('external', 'share', '| empty | 2 | 0.2500 |'), ('card', 'rows', '| train | 3 |')) t(kind, name, value)""",
)
def config_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task banks, tools, personas, rubrics, patterns, policies, names, seeds and manifests as YAML files, read and refused as they should be."""
    rows: list[tuple[str, str, str]] = []

    def refused(kind: str, name: str, run) -> None:
        try:
            value = run()
        except ValueError:
            value = "refused"
        rows.append((kind, name, value))

    with tempfile.TemporaryDirectory() as folder:
        root = Path(folder)

        def put(path: str, text: str) -> Path:
            (root / path).parent.mkdir(parents=True, exist_ok=True)
            (root / path).write_text(text)
            return root / path

        put("tasks/a.task.yaml", "id: files.copy\nfamily: files\nprompt: '{persona}, {name} {size}'\nparams: {size: [1, 2], name: [a, b]}\nverifier: v\n")
        put("tasks/TEMPLATE.task.yaml", "none")
        for t in config.tasks_table(spark, config.load_tasks(root / "tasks")).collect():
            rows.append(("task", t["template_id"], ";".join(f"{p['name']}={','.join(p['options'])}" for p in t["params"])))
        put("tools/files.yaml", "- {name: save}\n- {function: {name: find}}\n")
        rows += [("tools", k, ",".join(sorted(v))) for k, v in config.allowed_tools(root / "tools").items()]
        put("personas/critic.yaml", "kind: rp\n")
        put("personas/quiet.yaml", "kind: chat\n")
        people = config.personas(root / "personas")
        rows += [("persona", k, v["kind"]) for k, v in people.items()] + [("rp", k, "") for k in config.personas_of_kind(people)]
        rows += [("pattern", n, f"{a}:{p}") for n, p, a in config.scrub_patterns(put("p.yaml", "- {label: code, pattern: '[0-9]{4}'}\n- {label: word, pattern: x, action: flag}\n"))]
        rows += [("policy", k, ",".join(v)) for k, v in config.lane_policies(put("l.yaml", "d: {exempt_labels: [code]}\n")).items()]
        axes, threshold = config.rubric(spark, put("r.yaml", "threshold: 3.5\naxes: {voice: {weight: 2, min: 3.0}, substance: {}}\n"))
        rows += [("axis", a["axis"], f"{a['weight']}/{a['minimum']}") for a in axes.collect()] + [("threshold", "c", str(threshold))]
        patterns, preserve = config.pseudonym_rules(put("n.yaml", "name_patterns: [Ann, Bo]\npreserve: [Bo]\n"))
        rows += [("names", "patterns", "|".join(patterns)), ("names", "preserve", "|".join(preserve))]
        rows += [("seed", s["id"], s["scenario"]) for s in config.inline_seeds([{"id": "s1", "scenario": "Meet {persona}."}], "Quill")]
        config.write_manifest({"run": "r1", "teachers": [{"id": "m-20250101"}]}, root / "m.yaml")
        rows.append(("manifest", "run", config.read_manifest(root / "m.yaml")["run"]))
        config.write_manifest({"run": "r2", "teachers": [{"id": "m-latest"}]}, root / "m.yaml")
        refused("unpinned", "m-latest", lambda: config.read_manifest(root / "m.yaml")["run"])
    refused("lanes", "b,c", lambda: ",".join(config.narrowed_lanes(["b", "c"], ["c"])))
    refused("lanes", "b", lambda: ",".join(config.narrowed_lanes(["b"], ["z"])))
    refused("frozen", "same", lambda: config.same_prompts("x", "x") or "ok")
    refused("frozen", "changed", lambda: config.same_prompts("x", "y") or "ok")
    rows.append(("book", "w", config.book_entry("w", "p", 'a"b', "t")))
    rows.append(("ship", "d", config.ship_plan({"d"}, {"d", "a"}, {"train": 1})[0]))
    rows.append(("ship", "train", config.ship_plan(set(), {"a"}, {"train": 0})[0]))
    rows.append(("external", "share", [x for x in config.external_card("t", 8, {"empty": 2}).split("\n") if x.startswith("| empty")][0]))
    rows.append(("card", "rows", [x for x in config.dataset_card("t", {"train": 3}, [], []).split("\n") if x.startswith("| train")][0]))
    return spark.createDataFrame(rows, "kind string, name string, value string")


# --- near duplicates in SQL ----------------------------------------------------------------------------


def _sql_near(position: str) -> str:
    a, b = dedupe.permutations()
    return f"""with docs as (select doc_id, {position} as pos, trim(regexp_replace(lower(coalesce(text, '')), '{SQL_WS}+', ' ', 'g')) as t from documents),
firsts as (select t, min(pos) as p0, arg_min(doc_id, pos) as d0 from docs group by t),
ws as (select p0 as pos, string_split(t, ' ') as w from firsts where t <> ''),
sh as (select distinct pos, array_to_string(w[k:k+4], ' ') as s from (select *, unnest(range(1, len(w) - 3)) as k from ws where len(w) >= 5)),
hs as (select pos, ('0x' || substr(md5(s), 1, 8))::bigint % {dedupe.PRIME} as h from sh),
ab as (select unnest({a}) as a, unnest({b}) as b, unnest(range(0, {dedupe.PERMS})) as k),
mins as (select pos, k, min((a * h + b) % {dedupe.PRIME}) as v from hs, ab group by pos, k),
sigs as (select pos, list(v order by k) as sig from mins group by pos),
classes as (select sig, min(pos) as rep from sigs group by sig),
bands as (select rep, sig, j, sig[8 * j + 1:8 * j + 8] as v from classes, (select unnest(range(0, 16)) as j)),
pairs as (select distinct x.rep as a, y.rep as b, x.sig as sa, y.sig as sb from bands x join bands y on x.j = y.j and x.v = y.v and x.rep < y.rep),
best as (select b, min(a) as a from pairs where list_sum(list_transform(range(1, {dedupe.PERMS + 1}), lambda i: case when sa[i] = sb[i] then 1 else 0 end)) / {dedupe.PERMS}.0 >= 0.8 group by b),
near as (select s.pos, least(case when s.pos <> c.rep then c.rep end, best.a) as earlier from sigs s join classes c using (sig) left join best on best.b = c.rep)
select doc_id, d0 as duplicate_of, 'exact' as kind from docs join firsts using (t) where pos > p0
union all select f.d0, g.d0, 'near' from near n join firsts f on f.p0 = n.pos join firsts g on g.p0 = n.earlier"""


SQL["near_duplicates"] = _sql_near("doc_id")
SQL["prior_corpus_dedupe"] = _sql_near("case when lane in ('a', 'b') then doc_id else doc_id + 1000000000000 end")
