"""Queries of the core package on the test tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schema
from corpusloom.functions import spans
from corpusloom.functions import text as T
from corpusloom.functions.timestamps import instant_us, month_family
from corpusloom.operators import dedupe, expand, order, scrub, split, stats, trajectories, verifiers
from corpusloom.operators.activity import activity_sessions
from corpusloom.operators.deliveries import drop_repeated, keyed_messages
from corpusloom.plans import gate, models, render
from corpusloom.session import table
from corpusloom.sources import books, chats, config, vault

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL, if SQL can express it."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


#: White space of any kind, as a DuckDB (RE2) class.
SQL_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Messages with sender key and instant, repeated deliveries removed; the instant as micros.
SQL_MESSAGES = f"""
keyed as (
  select row_id, source, conversation_id, text,
    nullif(lower(regexp_replace(sender, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')), '') as sender_key,
    case when regexp_matches(ts, '^\\d{{4}}-\\d\\d-\\d\\d[T ]\\d\\d:\\d\\d:\\d\\d') then epoch_us(try_cast(ts as timestamptz)) end as ts_us
  from chat_messages),
messages as (
  select * from keyed where sender_key is null or ts_us is null
  union all by name
  select arg_min(row_id, row_id) as row_id, arg_min(source, row_id) as source, conversation_id, text, sender_key, ts_us
  from keyed where sender_key is not null and ts_us is not null group by conversation_id, text, sender_key, ts_us)"""


@query(
    "p2_found",
    f"""with {SQL_MESSAGES},
gaps as (select sender_key, ts_us, case when ts_us - lag(ts_us) over (partition by sender_key order by ts_us) <= 14400000000 then 0 else 1 end as new
  from messages where sender_key is not null and ts_us is not null),
numbered as (select *, sum(new) over (partition by sender_key order by ts_us rows unbounded preceding) as k from gaps)
select sender_key as sender, min(ts_us) as start_us, max(ts_us) as end_us, count(*) as n_events from numbered group by sender_key, k""",
)
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each sender over all conversations: a gap of more than 240 minutes splits."""
    chat = table(spark, sf_dir, "chat_messages")
    keyed = keyed_messages(chat.select("row_id", "source", "conversation_id", "sender", "ts", "text")).drop("row_id", "source", "text")
    once = keyed.where("sender_key is not null and ts_us is not null").distinct()
    return activity_sessions(once, "sender_key", "ts_us", 240 * 60_000_000).withColumnRenamed("entity", "sender")


@query(
    "p2_session_lengths",
    f"""with {SQL_MESSAGES},
gaps as (select sender_key, ts_us, case when ts_us - lag(ts_us) over (partition by sender_key order by ts_us) <= 14400000000 then 0 else 1 end as new
  from messages where sender_key is not null and ts_us is not null),
numbered as (select *, sum(new) over (partition by sender_key order by ts_us rows unbounded preceding) as k from gaps)
select sender_key as sender, min(ts_us) as start_us, max(ts_us) as end_us, max(ts_us) - min(ts_us) as duration_us, count(*) as n_events
from numbered group by sender_key, k""",
)
def p2_session_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions with their duration."""
    return p2_found(spark, sf_dir).select("sender", "start_us", "end_us", (F.col("end_us") - F.col("start_us")).alias("duration_us"), "n_events")


# --- records: rendering and the operators of the funnel -----------------------------------------------

#: Messages of conv_records with position (1-based) and the record's system, tools and provenance.
SQL_RECORDS = f"""
msgs as (
  select rec_no, system, tools_schema_json, provenance as p, gate_state as g, unnest(messages) as m, generate_subscripts(messages, 1) as i from conv_records),
said as (
  select *, trim(regexp_replace(coalesce(m.content, ''), '^{SQL_WS}+|{SQL_WS}+$', '', 'g')) as content, trim(regexp_replace(coalesce(m.thought, ''), '^{SQL_WS}+|{SQL_WS}+$', '', 'g')) as thought,
    max(case when m.role = 'user' then i else 0 end) over (partition by rec_no) as last_user,
    lag(m.role) over (partition by rec_no order by i) as before, lead(m.role) over (partition by rec_no order by i) as after,
    count(distinct case when m.role = 'assistant' then nullif(m.speaker, '') end) over (partition by rec_no) as n_speakers
  from msgs)"""


def _sql_rendered(thoughts: bool) -> str:
    from corpusloom.plans.render import TOOLS_FOOTER, TOOLS_HEADER

    lit = lambda s: "'" + s.replace("'", "''") + "'"
    thought = "thought" if thoughts else "''"
    return f"""{SQL_RECORDS},
bodies as (
  select *, case when n_speakers > 1 and coalesce(m.speaker, '') <> '' then m.speaker || ':' || case when content = '' then '' else ' ' || content end else content end as spoken,
    array_to_string(list_transform(m.tool_calls, lambda c: '<tool_call>' || chr(10) || '<function=' || c.name || '>' || chr(10) ||
      array_to_string(list_transform(coalesce(c.arguments, []), lambda a: '<parameter=' || a.name || '>' || chr(10) || coalesce(a.rendered, 'None') || chr(10) || '</parameter>' || chr(10)), '') || '</function>' || chr(10) || '</tool_call>'), chr(10)) as calls
  from said),
frags as (
  select rec_no, i, system, tools_schema_json, p, m.role as role, case m.role
    when 'tool' then case when before = 'tool' then '' else '<|im_start|>user' end || chr(10) || '<tool_response>' || chr(10) || content || chr(10) || '</tool_response>' || case when after = 'tool' then '' else '<|im_end|>' || chr(10) end
    when 'assistant' then '<|im_start|>assistant' || chr(10) || case when i > last_user then '<think>' || chr(10) || {thought} || chr(10) || '</think>' || chr(10) || chr(10) else '' end || spoken ||
      case when coalesce(calls, '') = '' then '' else case when spoken = '' then '' else chr(10) || chr(10) end || calls end || '<|im_end|>' || chr(10)
    else '<|im_start|>user' || chr(10) || content || '<|im_end|>' || chr(10) end as f from bodies),
heads as (
  select rec_no, case when tools_schema_json is not null then '<|im_start|>system' || chr(10) || {lit(TOOLS_HEADER)} ||
      array_to_string(list_transform(cast(tools_schema_json as json[]), lambda t: chr(10) || '{{"type": "function", "function": {{"name": "' || (t->>'$.name') || '"}}}}'), '') || {lit(TOOLS_FOOTER)} || case when s = '' then '' else chr(10) || chr(10) || s end || '<|im_end|>' || chr(10)
    when s = '' then '' else '<|im_start|>system' || chr(10) || s || '<|im_end|>' || chr(10) end as head
  from (select rec_no, tools_schema_json, regexp_replace(coalesce(system, ''), '^{SQL_WS}+|{SQL_WS}+$', '', 'g') as s from conv_records)),
placed as (
  select f.*, head, length(head) + coalesce(sum(length(f)) over (partition by rec_no order by i rows between unbounded preceding and 1 preceding), 0) as start_at from frags f join heads using (rec_no))"""


@query("render_chatml", f"with {_sql_rendered(True)} select rec_no, any_value(h.head) || coalesce(string_agg(f, '' order by i), '') as text from heads h left join placed using (rec_no) group by rec_no")
def render_chatml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as training text with thoughts."""
    return render.rendered(table(spark, sf_dir, "conv_records")).select("rec_no", "text")


@query("render_no_thoughts", f"with {_sql_rendered(False)} select rec_no, any_value(h.head) || coalesce(string_agg(f, '' order by i), '') as text from heads h left join placed using (rec_no) group by rec_no")
def render_no_thoughts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as training text with empty think blocks."""
    return render.rendered(table(spark, sf_dir, "conv_records"), render.NO_THOUGHTS).select("rec_no", "text")


@query("train_spans", f"with {_sql_rendered(True)} select rec_no, cast(start_at + 22 as bigint) as span_start, cast(start_at + length(f) - 1 as bigint) as span_end from placed where role = 'assistant'")
def train_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss-bearing spans of every record."""
    r = T.explode_once(render.rendered(table(spark, sf_dir, "conv_records")).select("rec_no", "train_spans"), F.col("train_spans"), "s")
    return r.select("rec_no", F.col("s.start").cast("bigint").alias("span_start"), F.col("s.end").cast("bigint").alias("span_end"))


@query(
    "next_speaker_samples",
    f"""with {_sql_rendered(False)},
prefixed as (select *, head || coalesce(string_agg(f, '' order by i) over (partition by rec_no order by i rows between unbounded preceding and 1 preceding), '') as prefix from placed)
select s.rec_no, cast(s.i - 1 as bigint) as turn_index,
  x.prefix || '<|im_start|>assistant' || chr(10) || case when s.i > s.last_user then '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) else '' end || s.m.speaker || ':' as text
from said s join prefixed x on s.rec_no = x.rec_no and s.i = x.i where s.n_speakers > 1 and s.i > 1 and s.m.role = 'assistant' and coalesce(s.m.speaker, '') <> ''""",
)
def next_speaker_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who speaks next, for every labelled turn of multi-speaker records."""
    s = render.next_speaker_samples(table(spark, sf_dir, "conv_records"))
    return s.select("rec_no", F.col("turn_index").cast("bigint").alias("turn_index"), "text")


@query("think_positions", f"with {SQL_RECORDS} select rec_no, cast(i - 1 as bigint) as msg_no from said where m.role = 'assistant' and i > last_user")
def think_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant messages that keep their reasoning."""
    r = table(spark, sf_dir, "conv_records").select("rec_no", render.last_user_position(F.col("messages")).alias("u"), F.posexplode("messages").alias("msg_no", "m"))
    return r.where("m.role = 'assistant' and msg_no > u").select("rec_no", F.col("msg_no").cast("bigint").alias("msg_no"))


@query("speaker_sets", "with msgs as (select rec_no, unnest(messages) as m from conv_records) select rec_no, count(distinct m.speaker) as n_speakers from msgs where m.role = 'assistant' and coalesce(m.speaker, '') <> '' group by rec_no")
def speaker_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of distinct assistant speakers."""
    return table(spark, sf_dir, "conv_records").select("rec_no", F.size(schema.speakers(F.col("messages"))).cast("bigint").alias("n_speakers")).where("n_speakers > 0")


@query(
    "judge_transcripts",
    """with msgs as (select rec_no, unnest(messages) as m, generate_subscripts(messages, 1) as i from conv_records),
lines as (select rec_no, i, coalesce(m.content, '') as body, case when coalesce(m.speaker, '') <> '' then m.speaker else m.role end as who, m.role as role, coalesce(m.thought, '') as thought,
  array_to_string(list_transform(coalesce(m.tool_calls, []), lambda c: c.name || '(' || array_to_string(list_transform(coalesce(c.arguments, []), lambda a: a.name || '=' || coalesce(a.rendered, 'None')), ', ') || ')'), '; ') as calls, coalesce(len(m.tool_calls), 0) as n from msgs),
shown as (select rec_no, i, case when role = 'tool' then '[tool result]' || chr(10) || substr(body, 1, 2000) || chr(10) else '[' || who || ']' || chr(10) || case when thought = '' then '' else '(inner thought: ' || thought || ')' || chr(10) end
  || case when n = 0 then body else case when body = '' then '' else body || chr(10) end || '[calls tools: ' || calls || ']' end || chr(10) end as line from lines)
select r.rec_no, '[system]' || chr(10) || coalesce(any_value(r.system), '') || chr(10) || chr(10) || coalesce(string_agg(line, chr(10) order by i), '') as transcript from conv_records r left join shown s using (rec_no) group by r.rec_no""",
)
def judge_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts as a judge reads them."""
    return table(spark, sf_dir, "conv_records").select("rec_no", render.judge_transcript(F.col("system"), F.col("messages")).alias("transcript"))


@query(
    "flipped_history",
    "with msgs as (select rec_no, unnest(messages) as m, generate_subscripts(messages, 1) as i from conv_records) select rec_no, sha256(string_agg(case m.role when 'user' then 'assistant' else 'user' end || chr(31) || coalesce(m.content, chr(30)), chr(29) order by i)) as history from msgs where m.role in ('user', 'assistant') group by rec_no",
)
def flipped_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles as the simulated user sees them."""
    r = table(spark, sf_dir, "conv_records").select("rec_no", render.flip_history(F.col("messages")).alias("h")).where(F.size("h") > 0)
    one = F.transform("h", lambda m: F.concat(m["role"], F.lit("\x1f"), F.coalesce(m["content"], F.lit("\x1e"))))
    return r.select("rec_no", F.sha2(F.array_join(one, "\x1d"), 256).alias("history"))


@query(
    "message_shapes",
    """with msgs as (select rec_no, unnest(messages) as m from conv_records)
select rec_no, bool_and(coalesce((m.role in ('user', 'assistant', 'tool')) and ((m.role = 'tool') = (m.tool_call_id is not null)) and (m.role = 'assistant' or (coalesce(len(m.tool_calls), 0) = 0 and m.thought is null)), false)) as sound
from msgs group by rec_no union all select rec_no, messages is not null from conv_records where coalesce(len(messages), 0) = 0""",
)
def message_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a record obeys the message shape rules."""
    return table(spark, sf_dir, "conv_records").select("rec_no", schema.record_is_sound(F.col("messages")).alias("sound"))


#: Normalised conversational text of each record.
SQL_TALK = f"""
said_by as (select rec_no, trim(regexp_replace(lower(string_agg(coalesce(m.thought, '') || ' ' || coalesce(m.content, ''), ' ' order by i)), '{SQL_WS}+', ' ', 'g')) as t
  from (select rec_no, unnest(messages) as m, generate_subscripts(messages, 1) as i from conv_records) where m.role in ('user', 'assistant') group by rec_no),
talk as (select rec_no, coalesce(t, '') as t from conv_records left join said_by using (rec_no))"""


def _talk() -> Column:
    return F.coalesce(dedupe.conversational_text(F.col("messages")), F.lit(""))


@query("conversational_text", f"with {SQL_TALK} select rec_no, sha256(t) as exact_key, length(t) as n_chars from talk")
def conversational_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact key of each record's conversation."""
    t = _talk()
    return table(spark, sf_dir, "conv_records").select("rec_no", dedupe.exact_key(t).alias("exact_key"), F.length(t).cast("bigint").alias("n_chars"))


@query("exact_duplicates", f"with {SQL_TALK} select * from (select rec_no, min(rec_no) over (partition by t) as duplicate_of from talk) where rec_no > duplicate_of")
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose conversation repeats an earlier one."""
    r = table(spark, sf_dir, "conv_records").select("rec_no", _talk().alias("t"))
    return dedupe.exact_duplicates(r, "rec_no", "rec_no", "t")


def _sql_minhash(perms: int) -> str:
    a, b = dedupe.permutations(perms)
    return f"""docs as (select doc_id, trim(regexp_replace(lower(text), '{SQL_WS}+', ' ', 'g')) as t from documents where text is not null),
ws as (select doc_id, string_split(t, ' ') as w from docs where t <> ''),
sh as (select distinct doc_id, array_to_string(w[k:k+4], ' ') as s from (select *, unnest(range(1, len(w) - 3)) as k from ws where len(w) >= 5)),
hs as (select doc_id, ('0x' || substr(md5(s), 1, 8))::bigint % {dedupe.PRIME} as h from sh),
ab as (select unnest({a}) as a, unnest({b}) as b, unnest(range(0, {perms})) as k)"""


@query("minhash_signatures", f"with {_sql_minhash(dedupe.PERMS)} select doc_id, k as perm, min((a * h + b) % {dedupe.PRIME}) as value from hs, ab group by doc_id, k")
def minhash_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash of every document, with all permutations of the operator."""
    d = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", T.normalise(F.col("text")).alias("t"))
    s = dedupe.signatures(d, "doc_id", "t").where("sig is not null")
    return s.select("doc_id", F.posexplode("sig").alias("perm", "value")).select("doc_id", F.col("perm").cast("bigint").alias("perm"), "value")


@query("near_duplicates")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that repeat an earlier one exactly or nearly (five-word shingles, agreement of 0.8)."""
    d = table(spark, sf_dir, "documents").select("doc_id", T.normalise(F.coalesce("text", F.lit(""))).alias("t"))
    return dedupe.duplicates(d, "doc_id", "doc_id", "t")


@query(
    "shingle_counts",
    f"""with docs as (select doc_id, trim(regexp_replace(lower(text), '{SQL_WS}+', ' ', 'g')) as t from documents where text is not null),
ws as (select doc_id, list_filter(string_split(t, ' '), lambda x: x <> '') as w from docs)
select doc_id, case when len(w) = 0 then 0 when len(w) < 5 then 1 else len(list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k+4], ' ')))) end as n_shingles from ws""",
)
def shingle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct five-word shingles of every document."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    return d.select("doc_id", F.size(T.ngrams(T.words(F.col("text")), 5)).cast("bigint").alias("n_shingles"))


@query("text_normalise", f"select doc_id, sha256(trim(regexp_replace(lower(text), '{SQL_WS}+', ' ', 'g'))) as key from documents where text is not null")
def text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash of every normalised document."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", dedupe.exact_key(T.normalise(F.col("text"))).alias("key"))


@query("prior_corpus_dedupe")
def prior_corpus_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of lanes a and b as the prior corpus, the others as new: duplicates among both, prior first."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lane", T.normalise(F.coalesce("text", F.lit(""))).alias("t"))
    both = dedupe.corpus_union(d.where("lane in ('a', 'b')"), d.where("coalesce(lane, '') not in ('a', 'b')"), "doc_id")
    return dedupe.duplicates(both, "doc_id", "order_key", "t")


# --- scrub, verify, judge, count ----------------------------------------------------------------------

def _sql_hits() -> str:
    ascii_word = lambda p: p.replace("'", "''")
    one = lambda label, p, action, text: f"case when regexp_matches({text}, '(?i){ascii_word(p)}') then '{action}:{label}' end"
    prose = ", ".join(one(*x, "prose") for x in scrub.PATTERNS)
    tools = ", ".join(one(*x, "tools") for x in scrub.PATTERNS if x[0].startswith("teacher_"))
    return f"""
talk as (select rec_no, any_value(p.lane) as lane, coalesce(string_agg(case when m.role in ('user', 'assistant') then coalesce(m.content, '') || ' | ' || coalesce(m.thought, '') end, ' | '), '') as prose,
  coalesce(string_agg(case when m.role = 'tool' then coalesce(m.content, '') end, ' | '), '') as tools from (select rec_no, provenance as p, unnest(messages) as m from conv_records) group by rec_no),
hits as (select rec_no, lane, unnest(list_distinct(list_filter([{prose}, {tools}], lambda x: x is not null))) as hit from talk)"""


@query("scrub_hits", f"with {_sql_hits()} select rec_no, hit from hits")
def scrub_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity, boilerplate and PII patterns of every record."""
    return T.explode_once(table(spark, sf_dir, "conv_records"), scrub.record_hits(F.col("messages")), "hit").select("rec_no", "hit")


@query("scrub_lane_policy", f"with {_sql_hits()} select rec_no, hit from hits where not (coalesce(lane, '') = 'd' and split_part(hit, ':', 2) in ('pii_email', 'pii_phone'))")
def scrub_lane_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hits without those from which a record's lane is exempt."""
    r = table(spark, sf_dir, "conv_records")
    hits = T.let(scrub.record_hits(F.col("messages")), lambda h: scrub.lane_hits(h, F.col("provenance.lane")))
    return T.explode_once(r, hits, "hit").select("rec_no", "hit")


@query("scrub_keep", f"with {_sql_hits()} select rec_no from conv_records where rec_no not in (select rec_no from hits where hit like 'drop:%')")
def scrub_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without a hit that drops them."""
    return table(spark, sf_dir, "conv_records").where(~F.coalesce(scrub.drops(scrub.record_hits(F.col("messages"))), F.lit(False))).select("rec_no")


@query(
    "pseudonyms",
    """with found as (select row_id, regexp_extract_all(text, '\\b(Halvard|Tamsin|Ysolt|Ottoline|Lysander)\\b') as ns from chat_messages where text is not null),
hits as (select row_id, unnest(ns) as n, generate_subscripts(ns, 1) as k from found),
firsts as (select lower(n) as name, min(struct_pack(r := row_id, k := k)) as f from hits group by 1)
select name, 'Person-' || row_number() over (order by f, name) as pseudonym from firsts""",
)
def pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names numbered in order of first appearance."""
    names = ["Halvard", "Tamsin", "Ysolt", "Ottoline", "Lysander"]
    chat = table(spark, sf_dir, "chat_messages").where("text is not null").select("row_id", "text")
    return scrub.pseudonym_table(chat, ["row_id"], "text", names)


@query(
    "scene_wellformed",
    """with msgs as (select rec_no, system, unnest(messages) as m from conv_records where provenance.lane = 'b')
select rec_no, count(*) filter (m.role = 'assistant') >= 6 and count(distinct nullif(m.speaker, '')) filter (m.role = 'assistant') >= 2
  and coalesce(bool_and(coalesce(m.speaker, '') <> '') filter (m.role = 'assistant'), true)
  and count(*) filter (m.role = 'assistant') > 0 and count(*) filter (m.role = 'assistant' and coalesce(m.thought, '') <> '') >= 0.5 * count(*) filter (m.role = 'assistant')
  and not coalesce(bool_or(contains(coalesce(m.content, ''), '[') and contains(coalesce(m.content, ''), ']')) filter (m.role = 'assistant'), false)
  and contains(coalesce(any_value(system), ''), '## Scene') as passed
from msgs group by rec_no union all select rec_no, false from conv_records where provenance.lane = 'b' and coalesce(len(messages), 0) = 0""",
)
def scene_wellformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene records that are well-formed."""
    r = table(spark, sf_dir, "conv_records").where("provenance.lane = 'b'")
    return r.select("rec_no", verifiers.scene_wellformed(F.col("messages"), F.col("system"))["passed"].alias("passed"))


@query(
    "no_impersonation",
    """with msgs as (select rec_no, unnest(messages) as m from conv_records)
select rec_no, not coalesce(bool_or(regexp_matches(coalesce(m.content, ''), '(?im)^\\s*(?:\\{\\{user\\}\\}|user|you)\\s*:') or regexp_matches(coalesce(m.content, ''), '(?i)\\byou\\s+(?:say|reply|respond|answer)\\b[,:]?\\s*["“]')) filter (m.role = 'assistant'), false) as passed
from msgs group by rec_no union all select rec_no, messages is not null from conv_records where coalesce(len(messages), 0) = 0""",
)
def no_impersonation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose assistant never writes the user's turns."""
    return table(spark, sf_dir, "conv_records").select("rec_no", verifiers.no_impersonation(F.col("messages"))["passed"].alias("passed"))


@query(
    "turn_dynamics",
    f"""with msgs as (select rec_no, unnest(messages) as m, generate_subscripts(messages, 1) as i from conv_records),
talk as (select *, lag(m.role) over (partition by rec_no order by i) as before from msgs where m.role in ('user', 'assistant'))
select rec_no, count(*) filter (m.role = 'user') >= 3 and bool_and(before is null or before <> m.role) and count(*) filter (m.role = 'assistant') > 0
  and count(distinct trim(regexp_replace(lower(coalesce(m.content, '')), '{SQL_WS}+', ' ', 'g'))) filter (m.role = 'assistant') > 0.5 * count(*) filter (m.role = 'assistant') as passed
from talk group by rec_no union all select rec_no, false from conv_records where rec_no not in (select rec_no from talk)""",
)
def turn_dynamics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with real turn-taking."""
    r = table(spark, sf_dir, "conv_records")
    return r.select("rec_no", verifiers.turn_dynamics(F.col("messages"))["passed"].alias("passed"))


@query(
    "stream_wellformed",
    f"""with msgs as (select rec_no, provenance.family as family, try_cast(provenance.source.detail_json as json)->>'$.source' as src, unnest(messages) as m, generate_subscripts(messages, 1) as i from conv_records where provenance.lane = 'd'),
t as (select *, case when regexp_matches(m.ts, '^\\d{{4}}-\\d\\d-\\d\\d[T ]\\d\\d:\\d\\d:\\d\\d') then epoch_us(try_cast(m.ts as timestamptz)) end as us from msgs),
o as (select *, lag(us) over (partition by rec_no order by i) as before from t),
g as (select rec_no, count(distinct m.role) >= 2 as two, bool_and(regexp_replace(coalesce(m.content, ''), '^{SQL_WS}+|{SQL_WS}+$', '', 'g') <> '') as full_, bool_and(coalesce(m.speaker, '') <> '') as named, bool_and(us is not null) as timed,
  bool_and(us is not null) and bool_and(i = 1 or coalesce(before <= us, false)) as ordered, bool_and(m.role in ('user', 'assistant') and coalesce(len(m.tool_calls), 0) = 0) as plain,
  bool_and(us is not null) and coalesce(any_value(family) = coalesce(any_value(src), '') || '/' || strftime(make_timestamp(min(case when i = 1 then us end)), '%Y-%m'), false) as fits from o group by rec_no),
f as (select rec_no, list_filter([case when not two then 'two_sided_conversation' end, case when not full_ then 'content_non_empty' end, case when not named then 'speakers_present' end, case when not timed then 'all_messages_timestamped' end,
  case when not ordered then 'timestamps_ordered' end, case when not plain then 'no_tool_machinery' end, case when not fits then 'family_matches_first_month' end], lambda x: x is not null) as failed from g)
select rec_no, len(failed) = 0 as passed, array_to_string(failed, ',') as failed from f union all select rec_no, false, 'two_sided_conversation,family_matches_first_month' from conv_records where provenance.lane = 'd' and len(messages) = 0""",
)
def stream_wellformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal streams in order, with the checks that failed."""
    r = table(spark, sf_dir, "conv_records").where("provenance.lane = 'd'")
    v = verifiers.stream_wellformed(F.col("messages"), F.col("provenance.family"), F.get_json_object("provenance.source.detail_json", "$.source"))
    return r.select("rec_no", v["passed"].alias("passed"), F.array_join(v["failed"], ",").alias("failed"))


@query(
    "final_writes",
    """with msgs as (select rec_no, unnest(messages) as m, generate_subscripts(messages, 1) as i from conv_records),
calls as (select rec_no, c.id as id, list_filter(c.arguments, lambda a: a.name = 'path')[1].rendered as path from (select rec_no, unnest(m.tool_calls) as c from msgs where m.role = 'assistant') where c.name = 'write_file'),
results as (select rec_no, i, m.tool_call_id as id, m.content as content from msgs where m.role = 'tool'),
answered as (select r.rec_no, r.i, r.content from results r where exists (select 1 from calls c where c.rec_no = r.rec_no and c.id = r.id and c.path = 'todo.md'))
select rec_no, coalesce(try_cast(arg_max(content, i) as json)->>'$.ok', 'true') is not null and json_valid(arg_max(content, i)) and json_type(try_cast(arg_max(content, i) as json)) = 'OBJECT'
  and coalesce(try_cast(arg_max(content, i) as json)->>'$.error', '') in ('', 'false', 'null', '0') as ok from answered where content is not null group by rec_no""",
)
def final_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the last answered write to ``todo.md`` succeeded."""
    r = table(spark, sf_dir, "conv_records").where("exists(messages, m -> m.role = 'tool')")
    w = verifiers.final_write(F.col("messages"), F.lit("todo.md"))
    seen = F.exists("messages", lambda m: F.exists(F.coalesce(m["tool_calls"], F.array().cast("array<struct<id:string,name:string,arguments:array<struct<name:string,rendered:string,raw_json:string>>>>")), lambda c: (c["name"] == "write_file") & (verifiers.argument(c, "path") == "todo.md") & F.exists("messages", lambda x: (x["role"] == "tool") & (x["tool_call_id"] == c["id"]) & x["content"].isNotNull())))
    return r.where(seen).select("rec_no", w["ok"].alias("ok"))


_SQL_FAILED_B = """select rec_no, list_filter([case when coalesce(count(*) filter (a), 0) < 6 then 'enough_turns' end, case when count(distinct nullif(m.speaker, '')) filter (a) < 2 then 'multi_speaker' end,
    case when not coalesce(bool_and(coalesce(m.speaker, '') <> '') filter (a), true) then 'speakers_labeled' end, case when count(*) filter (a) = 0 or count(*) filter (a and coalesce(m.thought, '') <> '') < 0.5 * count(*) filter (a) then 'thought_coverage' end,
    case when coalesce(bool_or(contains(coalesce(m.content, ''), '[') and contains(coalesce(m.content, ''), ']')) filter (a), false) then 'no_bracket_thoughts' end,
    case when not contains(coalesce(any_value(system), ''), '## Scene') then 'system_has_scene' end], lambda x: x is not null) as failed from msgs where lane = 'b' group by rec_no"""
_SQL_FAILED_C = f"""select rec_no, list_filter([case when coalesce(bool_or(regexp_matches(coalesce(m.content, ''), '(?im)^\\s*(?:\\{{\\{{user\\}}\\}}|user|you)\\s*:') or regexp_matches(coalesce(m.content, ''), '(?i)\\byou\\s+(?:say|reply|respond|answer)\\b[,:]?\\s*["“]')) filter (a), false) then 'no_impersonation' end,
    case when count(*) filter (m.role = 'user') < 3 then 'enough_exchanges' end, case when bool_or(coalesce(m.role = before, false)) then 'alternating' end,
    case when count(*) filter (a) = 0 or count(distinct trim(regexp_replace(lower(coalesce(m.content, '')), '{SQL_WS}+', ' ', 'g'))) filter (a) <= 0.5 * count(*) filter (a) then 'not_degenerate' end], lambda x: x is not null) as failed
  from (select *, lag(m.role) over (partition by rec_no order by i) as before from msgs where lane = 'c' and m.role in ('user', 'assistant')) group by rec_no"""


@query(
    "verify_records",
    f"""with msgs as (select rec_no, lane, system, m, i, coalesce(m.role = 'assistant', false) as a from (select rec_no, provenance.lane as lane, system, unnest(messages) as m, generate_subscripts(messages, 1) as i from conv_records)),
f as ({_SQL_FAILED_B} union all {_SQL_FAILED_C})
select rec_no, len(failed) = 0 as passed, array_to_string(failed, ',') as failed from f union all select rec_no, passed, failed from ({SQL['stream_wellformed']}) union all select rec_no, null, null from conv_records where provenance.lane = 'a'""",
)
def verify_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verifiers by lane and template, with the checks that failed."""
    r = table(spark, sf_dir, "conv_records")
    v = verifiers.verified(r.select("rec_no", "messages", "system", "provenance"), "v")
    return v.select("rec_no", "v.passed", F.array_join("v.failed", ",").alias("failed"))


@query(
    "degenerate_loops",
    f"""with msgs as (select rec_no, coalesce(m.content, '') as c, row_number() over (partition by rec_no order by i desc) as k from (select rec_no, unnest(messages) as m, generate_subscripts(messages, 1) as i from conv_records) where m.role = 'assistant'),
ws as (select rec_no, k, list_filter(string_split(trim(regexp_replace(lower(c), '{SQL_WS}+', ' ', 'g')), ' '), lambda x: x <> '') as w from msgs where k <= 2),
gs as (select rec_no, k, list_distinct(list_transform(range(1, len(w) - 2), lambda j: array_to_string(w[j:j+3], ' '))) as g from ws where len(w) >= 4)
select x.rec_no from gs x join gs y on x.rec_no = y.rec_no and x.k = 1 and y.k = 2 where len(list_intersect(x.g, y.g)) / least(len(x.g), len(y.g)) >= 0.6""",
)
def degenerate_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose last two assistant turns repeat each other."""
    return table(spark, sf_dir, "conv_records").where(order.degenerate_loop(F.col("messages"))).select("rec_no")


_FLAGS = "select provenance.lane as lane, coalesce(gate_state.verified, false) as v, coalesce(gate_state.judge.passed, false) as j, coalesce(gate_state.dropped, false) as d from conv_records"


@query("gate_counts", f"select lane, count(*) as total, count(*) filter (v) as verified, count(*) filter (v and j) as judged, count(*) filter (not d) as kept, count(*) filter (d) as dropped from ({_FLAGS}) group by rollup (lane)")
def gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters by lane and over all lanes."""
    return stats.gate_counts(table(spark, sf_dir, "conv_records"))


@query("keep_rates", f"select lane, coalesce(count(*) filter (v) / nullif(count(*), 0), 0) as verify_rate, coalesce(count(*) filter (v and j) / nullif(count(*) filter (v), 0), 0) as judge_rate from ({_FLAGS}) group by rollup (lane)")
def keep_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verify and judge rates by lane."""
    return stats.keep_rates(stats.gate_counts(table(spark, sf_dir, "conv_records")))


@query("drop_reasons", "select provenance.lane as lane, coalesce(gate_state.drop_reason, 'error') as drop_reason, count(*) as n from conv_records where gate_state.dropped group by 1, 2")
def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropped records by lane and reason."""
    return stats.drop_reasons(table(spark, sf_dir, "conv_records"))


_TEMPLATE_STATS = """last as (select arg_max(provenance, rec_no) as p, arg_max(gate_state, rec_no) as g from conv_records group by provenance.record_id),
stats as (select coalesce(p.template_id, 'lane_' || p.lane || ':' || p.family) as template, count(*) as rollouts, count(*) filter (coalesce(g.verified, false)) as verified, count(*) filter (not coalesce(g.dropped, false)) as kept from last group by 1)"""


@query("template_stats", f"with {_TEMPLATE_STATS} select * from stats")
def template_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollouts, verified and kept by template; the last row of a record id counts."""
    return stats.template_stats(table(spark, sf_dir, "conv_records"), "rec_no")


@query("band_violations", f"with {_TEMPLATE_STATS} select template, rollouts, verified, kept, verified / rollouts as pass_rate from stats where not verified / rollouts between 0.3 and 0.8")
def band_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates, and lanes without one, outside the difficulty band of 0.3 to 0.8."""
    s = stats.template_stats(table(spark, sf_dir, "conv_records"), "rec_no")
    bands = s.select("template", F.lit(0.3).alias("low"), F.lit(0.8).alias("high"))
    return stats.band_violations(s, bands).select("template", "rollouts", "verified", "kept", "pass_rate")


@query(
    "weighted_judge",
    """with axes as (select rec_no as id, unnest(map_entries(gate_state.judge.axes)) as e from conv_records where gate_state.judge.axes is not null),
rubric as (select * from (values ('voice', 2.0, 3.0), ('substance', 1.0, null)) r(axis, weight, minimum)),
j as (select id, sum(greatest(1.0, least(5.0, e.value)) * weight) / sum(weight) as mean, bool_and(minimum is null or greatest(1.0, least(5.0, e.value)) >= minimum) as floors, count(*) as n from axes join rubric on e.key = axis group by id)
select id, round(mean, 3) as overall, coalesce(n = 2 and floors and mean >= 3.5, false) as passed, 2 - coalesce(n, 0) as n_missing from (select distinct id from axes) left join j using (id)""",
)
def weighted_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge scores under a rubric of two axes."""
    s = table(spark, sf_dir, "conv_records").where("gate_state.judge.axes is not null").select(F.col("rec_no").alias("id"), F.explode("gate_state.judge.axes").alias("axis", "score"))
    rubric = spark.createDataFrame([("voice", 2.0, 3.0), ("substance", 1.0, None)], "axis string, weight double, minimum double")
    return stats.weighted_judge(s, rubric, 3.5)


# --- order, splits, text ------------------------------------------------------------------------------

@query("slugs", f"""with s as (select rec_no, lower(regexp_replace(substr(regexp_replace(regexp_replace(regexp_replace(title, '[^\\p{{L}}\\p{{M}}\\p{{N}}\\p{{Pc}}\\s-]', '', 'g'), '^{SQL_WS}+|{SQL_WS}+$', '', 'g'), '[\\s-]+', '-', 'g'), 1, 20), '^-+|-+$', '', 'g')) as s,
  trim(regexp_replace(substr(trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-'), 1, 12), '-+$', ''), '-') as a from book_configs)
select rec_no, case when coalesce(s, '') = '' then 'untitled' else s end as slug, case when coalesce(a, '') = '' then 'item' else a end as short_slug from s""")
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs of book titles in two forms."""
    b = table(spark, sf_dir, "book_configs")
    return b.select("rec_no", T.slugify(F.col("title"), 20).alias("slug"), T.slug_ascii(F.col("title"), 12).alias("short_slug"))


@query("author_names", "with a as (select rec_no, unnest(string_split(author, ';')) as a, generate_subscripts(string_split(author, ';'), 1) - 1 as n from book_configs where author is not null) select rec_no, n, case when contains(a, ',') then trim(trim(regexp_extract(a, '^([^,]*),\\s*(.*)$', 2)) || ' ' || trim(regexp_extract(a, '^([^,]*),\\s*(.*)$', 1))) else trim(a) end as author from a")
def author_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every author named in a field, surname-first forms turned."""
    b = table(spark, sf_dir, "book_configs").where("author is not null").select("rec_no", F.posexplode(F.split("author", ";")).alias("n", "a"))
    return b.select("rec_no", F.col("n").cast("bigint").alias("n"), T.author_flip(F.col("a")).alias("author"))


@query("yaml_quotes", """select doc_id, sha256('"' || replace(replace(text, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || '"') as quoted from documents where text is not null""")
def yaml_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash of every document as a quoted YAML scalar."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.sha2(T.yaml_quote(F.col("text")), 256).alias("quoted"))


@query("message_instants", f"with {SQL_MESSAGES} select row_id, ts_us, 'chat/' || strftime(make_timestamp(ts_us), '%Y-%m') as family from keyed where ts_us is not null")
def message_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instant and month family of every message with a readable time."""
    c = table(spark, sf_dir, "chat_messages").select("row_id", instant_us(F.col("ts")).alias("ts_us")).where("ts_us is not null")
    return c.select("row_id", "ts_us", month_family(F.lit("chat"), F.col("ts_us")).alias("family"))


@query("repeated_deliveries", f"with {SQL_MESSAGES} select row_id from keyed where row_id not in (select row_id from messages)")
def repeated_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of messages that were delivered again."""
    chat = table(spark, sf_dir, "chat_messages")
    return chat.select("row_id").join(drop_repeated(keyed_messages(chat)).select("row_id"), "row_id", "left_anti")


#: Events by user in order of time and id.
_SQL_SEGMENTS = """gaps as (select user_id, event_id, ts, case when ts - lag(ts) over w <= interval 240 minute then 0 else 1 end as new from events window w as (partition by user_id order by ts, event_id)),
runs as (select *, sum(new) over (partition by user_id order by ts, event_id rows unbounded preceding) as s from gaps),
capped as (select *, (row_number() over (partition by user_id, s order by ts, event_id) - 1) // 3 as c from runs),
segs as (select user_id, event_id, ts, dense_rank() over (partition by user_id order by s, c) - 1 as segment from capped)"""


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return order.sessionize(e, ["user_id"], "us", ["us", "event_id"], 240 * 60_000_000, 3)


@query("sessionize", f"with {_SQL_SEGMENTS} select event_id, user_id, segment from segs")
def sessionize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments at gaps over 240 minutes and at three events."""
    return _segments(spark, sf_dir).select("event_id", "user_id", F.col("segment").cast("bigint").alias("segment"))


@query("segment_filter", f"with {_SQL_SEGMENTS}, e as (select s.*, e.event_type, e.props from segs s join events e using (event_id)) select user_id, segment, count(*) as n_messages, cast(sum(length(props)) as bigint) as n_chars from e group by user_id, segment having count(*) >= 2 and count(distinct case when event_type in ('click', 'view') then 'user' else 'assistant' end) >= 2 and sum(length(props)) >= 10")
def segment_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-sided segments of enough events and characters."""
    role = F.when(F.col("event_type").isin("click", "view"), "user").otherwise("assistant")
    g = order.segment_filter(_segments(spark, sf_dir), ["user_id", "segment"], role, "props", 2, 10)
    return g.select("user_id", F.col("segment").cast("bigint").alias("segment"), "n_messages", "n_chars")


@query("stride_sample", "with p as (select doc_id, row_number() over (order by doc_id) - 1 as pos, count(*) over () as n from documents) select doc_id from p where pos in (select cast(floor(i * (n::double / 100)) as bigint) from (select max(n) as n from p), (select unnest(range(0, 100)) as i))")
def stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred documents evenly spread over all."""
    return order.stride_all(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 100).select("doc_id")


@query(
    "stratified_stride",
    """with p as (select rec_no, holdout, row_number() over (partition by holdout order by rec_no) - 1 as r, count(*) over (partition by holdout) as size, count(*) over () as n, count(*) filter (holdout) over () as h from task_instances),
w as (select *, case when h = 0 then 0 else least(greatest(1, round_even(50 * h / n, 0)), 49, h) end as want from p),
t as (select *, case when holdout then want else 50 - want end as take from w)
select rec_no from t where size <= take or r in (select cast(floor(i * (t.size::double / t.take)) as bigint) from (select unnest(range(0, 50)) as i) where i < t.take)""",
)
def stratified_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty tasks with the held-out ones in proportion."""
    return order.stratified_stride(table(spark, sf_dir, "task_instances").select("rec_no", "holdout"), ["rec_no"], F.col("holdout"), 50).select("rec_no")


@query("group_cap_limit", "with r as (select doc_id, source, row_number() over (partition by source order by doc_id) as k from documents) select doc_id from r where k <= 5 order by doc_id limit 150")
def group_cap_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five documents of each source, then the first 150 of all."""
    return order.group_cap(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", ["doc_id"], 5, 150).select("doc_id")


@query("keep_first", "select source, min(doc_id) as doc_id from documents group by source")
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document of each source."""
    return order.keep_first(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id")


@query(
    "thread_cap",
    """with recursive counts as (select source, count(*) as n from chat_messages group by source),
steps(k, ns, lim) as (select 0, (select list(n) from counts), (select max(n) from counts)
  union all select k + 1, ns, greatest(1, cast(floor(list_sum(list_transform(ns, lambda x: least(x, lim))) * 0.1) as bigint)) from steps
  where list_max(list_transform(ns, lambda x: least(x, lim))) > greatest(1, cast(floor(list_sum(list_transform(ns, lambda x: least(x, lim))) * 0.1) as bigint)) and k < 10000)
select source, n, least(n, (select arg_max(lim, k) from steps)) as cap from counts""",
)
def thread_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat sources clamped to a tenth of what is left, until nothing changes."""
    return order.dominance_cap(table(spark, sf_dir, "chat_messages").groupBy("source").agg(F.count(F.lit(1)).alias("n")), 0.1)


@query("holdout_bucket", "select distinct family, ('0x' || substr(sha256('holdout:' || family), 1, 8))::bigint % 1000 < 100 as held from task_instances where family is not null")
def holdout_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic holdout of task families by hash."""
    return table(spark, sf_dir, "task_instances").where("family is not null").select("family").distinct().withColumn("held", split.hash_holdout(F.col("family")))


@query("variant_picks", "select rec_no, ('0x' || substr(sha256('variant:' || seed_id), 1, 8))::bigint % 8 as variant from seeds where seed_id is not null")
def variant_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of eight variants for each seed."""
    return table(spark, sf_dir, "seeds").where("seed_id is not null").select("rec_no", split.hash_pick("variant:", F.col("seed_id"), 8).alias("variant"))


_SQL_SPLIT = """keyed as (select rec_no, coalesce(provenance.holdout, false) as holdout, provenance.family as family, provenance.family as k from conv_records),
ranked as (select k, row_number() over (order by sha256('7:' || k), k) as r, count(*) over () as n from (select distinct k from keyed where not holdout and k is not null)),
parts as (select rec_no, family, holdout, holdout or k in (select k from ranked where r <= floor(n * 0.15)) as is_eval from keyed)"""


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "conv_records").select("rec_no", F.col("provenance.holdout").alias("holdout"), F.col("provenance.family").alias("family"))
    return split.split_train_eval(r, "family", "holdout", 0.15, 7)


@query("split_train_eval", f"with {_SQL_SPLIT} select rec_no, is_eval from parts")
def split_train_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly 15 per cent of the free families, and all held-out records, go to eval."""
    return _split(spark, sf_dir).select("rec_no", "is_eval")


@query("mixed_families", "select provenance.family as family, count(*) filter (coalesce(provenance.holdout, false)) as n_holdout, count(*) filter (not coalesce(provenance.holdout, false)) as n_train from conv_records group by 1 having n_holdout > 0 and n_train > 0")
def mixed_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families that are only partly held out."""
    r = table(spark, sf_dir, "conv_records").select(F.col("provenance.family").alias("family"), F.col("provenance.holdout").alias("holdout"))
    return split.mixed_families(r, "family", "holdout")


@query("holdout_leaks", f"with {_SQL_SPLIT} select rec_no from parts where holdout and (not is_eval or rec_no % 2 = 0)")
def holdout_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out records in train, after every second record was put there by mistake; before, there are none."""
    wrong = _split(spark, sf_dir).withColumn("is_eval", F.when(F.col("rec_no") % 2 == 0, False).otherwise(F.col("is_eval")))
    return split.leaked(wrong, "holdout").select("rec_no")


@query(
    "preference_pairs",
    f"""with {_sql_rendered(True)},
firsts as (select rec_no, min(i) filter (role = 'user') as n from placed group by rec_no),
alone as (select f.rec_no, f.n from firsts f where f.n is not null),
prompts as (select a.rec_no, sum(case when d.i <= a.n then length(d.f) else 0 end) as z, sha256(any_value(d.head) || string_agg(d.f, '' order by d.i) filter (d.i <= a.n)) as prompt from alone a join placed d using (rec_no) group by a.rec_no),
c as (select rec_no, provenance.record_id as id, provenance.sibling_group as grp, gate_state.judge.overall as overall, gate_state.drop_reason as reason, gate_state.verified as verified, coalesce(gate_state.dropped, false) as dropped, prompt from conv_records join prompts using (rec_no) where coalesce(provenance.sibling_group, '') <> '' and gate_state.judge is not null)
select x.id as chosen_id, y.id as rejected_id, x.grp as sibling_group, printf('%.3f', x.overall - y.overall) as margin
from c x join c y on x.grp = y.grp and x.prompt = y.prompt where not x.dropped and y.dropped and y.reason = 'judge' and y.verified and x.overall - y.overall >= 0.1
union all select x.id, y.id || '-lost', x.grp, printf('%.3f', x.overall - (y.overall - 1.5)) from c x join c y on x.grp = y.grp and x.prompt = y.prompt where not x.dropped and x.overall - (y.overall - 1.5) >= 0.1""",
)
def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept records and their siblings that lost at the judge; every judged record has a planted one that scored 1.5 less."""
    r = table(spark, sf_dir, "conv_records")
    lost = F.col("gate_state").withField("dropped", F.lit(True)).withField("drop_reason", F.lit("judge")).withField("verified", F.lit(True)).withField("judge.overall", F.col("gate_state.judge.overall") - 1.5)
    planted = r.where("gate_state.judge is not null").withColumn("provenance", F.col("provenance").withField("record_id", F.concat("provenance.record_id", F.lit("-lost")))).withColumn("gate_state", lost)
    p = render.preference_pairs(r.where("not coalesce(gate_state.dropped, false)"), r.where("gate_state.dropped").unionByName(planted), 0.1)
    return p.select(*[F.col("meta")[k].alias(k) for k in ("chosen_id", "rejected_id", "sibling_group", "margin")])


@query("percentiles_nearest", "with v as (select list(length(text) order by length(text)) as s, count(*) as n from documents where text is not null) select p, cast(s[least(n - 1, p * n // 100) + 1] as bigint) as value from v, (values (10), (25), (50), (75), (90)) t(p)")
def percentiles_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of document lengths by nearest rank."""
    d = table(spark, sf_dir, "documents").select(F.length("text").alias("n"))
    return stats.percentiles_nearest(d, "n").select("p", F.col("value").cast("bigint").alias("value"))


@query("interiority", rf"""with c as (select doc_id, text as t from documents where text is not null),
n as (select doc_id, len(regexp_extract_all(t, '[A-Za-z'']+')) as n, len(regexp_extract_all(t, '(?i){stats.MENTAL_WORDS}')) as k from c)
select doc_id, case when n < 100 then 0.0 else k * 1000.0 / n end as score from n""")
def interiority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of inner life per thousand words of documents of at least a hundred words."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", stats.interiority(F.col("text"), least=100).alias("score"))


@query("cost_ledger", "with u as (select l_returnflag as teacher, l_linestatus as lane, cast(l_quantity as bigint) as tin, cast(l_extendedprice as bigint) as tout from lineitem), p as (select * from (values ('A', 1.0, 2.0), ('N', 0.5, 1.5)) t(teacher, a, b)) select teacher, lane, cast(sum(tin) as bigint) as tokens_in, cast(sum(tout) as bigint) as tokens_out, sum((tin * coalesce(a, 0) + tout * coalesce(b, 0)) / 1e6) as cost from u left join p using (teacher) group by teacher, lane")
def cost_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage and cost by teacher and lane; one teacher has no price."""
    u = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("teacher"), F.col("l_linestatus").alias("lane"), F.round("l_quantity").cast("bigint").alias("tokens_in"), F.bround("l_extendedprice").cast("bigint").alias("tokens_out"))
    prices = spark.createDataFrame([("A", 1.0, 2.0), ("N", 0.5, 1.5)], "teacher string, price_in double, price_out double")
    return stats.usage_totals(u, prices)


@query("mix_report", "with g as (select coalesce(doc_kind, '') as corpus, count(*) as records, cast(sum(length(coalesce(text, ''))) as double) / 4 as tokens from documents group by 1) select *, tokens / sum(tokens) over () as share from g")
def mix_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records, tokens and shares by kind of document."""
    return stats.mix_report(table(spark, sf_dir, "documents").select(F.coalesce("doc_kind", F.lit("")).alias("corpus"), "text"), "corpus", "text")


@query("judge_routing", "select o_orderkey, case ('0x' || substr(sha256(cast(o_orderkey as varchar)), 1, 8))::bigint % 2 when 0 then 'judge-1' else 'judge-2' end as judge from orders")
def judge_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judge of another provider for each key."""
    judges = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(p).alias("provider")) for i, p in (("judge-0", "x"), ("judge-1", "y"), ("judge-2", "z"))])
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", models.judge_for(F.col("o_orderkey").cast("string"), judges, F.lit("x")).alias("judge"))


@query("rotate_picks", "select o_orderkey, case ('0x' || substr(sha256('rotate:' || o_orderkey), 1, 8))::bigint % 2 when 0 then 'a' else 'c' end as teacher from orders")
def rotate_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A teacher of another provider for each key."""
    pool = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(p).alias("provider")) for i, p in (("a", "x"), ("b", "y"), ("c", "z"))])
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", models.rotate(F.col("o_orderkey").cast("string"), pool, F.lit("y")).alias("teacher"))


@query("rollout_order", "with r as (select rec_no, unnest(range(0, n_rollouts)) as round from task_instances where n_rollouts > 0) select rec_no, round, row_number() over (order by round, rec_no) - 1 as prompt_index from r")
def rollout_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task rollouts round-robin, numbered."""
    t = table(spark, sf_dir, "task_instances").where("n_rollouts > 0").select("rec_no", "n_rollouts")
    return expand.rollout_order(t, ["rec_no"]).select("rec_no", F.col("round").cast("bigint").alias("round"), "prompt_index")


_TASK = {"id": "files.copy", "family": "files", "params": {"name": ["a", "b", "c"], "size": [1, 2]}, "prompt": "{persona}, write {name} of {size}.", "n_rollouts": 3, "verifier": "v"}


@query("task_expand_product", "select 'Quill, write ' || n || ' of ' || s || '.' as prompt, n as name, s as size from (values ('a'), ('b'), ('c')) a(n), (values ('1'), ('2')) b(s)")
def task_expand_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every combination of a template's parameters."""
    t = expand.expand_tasks(config.tasks_table(spark, [_TASK]), "Quill")
    return t.select("prompt", F.col("params")["name"].alias("name"), F.col("params")["size"].alias("size"))


@query("task_expand_zip", "select 'Quill, write ' || n || ' of ' || s || '.' as prompt from (values ('a', '1'), ('b', '2')) a(n, s)")
def task_expand_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k-th values of a template's parameters together."""
    zipped = _TASK | {"param_mode": "zip", "params": {"name": ["a", "b"], "size": [1, 2]}}
    return expand.expand_tasks(config.tasks_table(spark, [zipped]), "Quill").select("prompt")


@query(
    "chunk_windows",
    f"""with p as (select doc_id, list_filter(string_split_regex(text, '\\n[\\s\\x0b]*\\n'), lambda x: regexp_replace(x, '^{SQL_WS}+|{SQL_WS}+$', '', 'g') <> '') as ps from documents where text is not null),
e as (select doc_id, list_prepend({{'done': []::varchar[], 'now': []::varchar[], 'size': 0}}, list_transform(ps, lambda x: {{'done': []::varchar[], 'now': [x], 'size': length(x)}})) as es from p),
f as (select doc_id, list_reduce(es, lambda a, x: case when a.size + x.size >= 1000
  then {{'done': list_append(a.done, array_to_string(a.now || x.now, chr(10) || chr(10))), 'now': x.now, 'size': length(x.now[1])}} else {{'done': a.done, 'now': a.now || x.now, 'size': a.size + x.size}} end) as s from e),
c as (select doc_id, case when len(s.now) > 0 and (len(s.done) = 0 or s.size > 250) then list_append(s.done, array_to_string(s.now, chr(10) || chr(10))) else s.done end as cs from f)
select doc_id, unnest(cs) as text, generate_subscripts(cs, 1) - 1 as chunk from c""",
)
def chunk_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in overlapping windows of paragraphs of about a thousand characters."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    return T.explode_once(d.select("doc_id", F.col("text").alias("body")), books.chunk_windows(F.col("body"), 1000), "text", "chunk").select("doc_id", "text", F.col("chunk").cast("bigint").alias("chunk"))


@query("protected_spans")
def protected_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of documents that a rewrite must not touch."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    return T.explode_once(d, spans.protected_spans_of("text"), "s").select("doc_id", "s.*")


@query("span_round_trip", "select doc_id from documents where text is not null and not contains(text, '⟦')")
def span_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that come back unchanged from masking and restoring: all but those that hold the placeholder's own bracket."""
    d = table(spark, sf_dir, "documents").where("text is not null").withColumn("k", spans.mask_of("text"))
    return d.where(spans.restore_of("k.masked", "k.originals") == F.col("text")).select("doc_id")


def _sql_draw(salt: str, sides: str) -> str:
    return f"('0x' || substr(sha256('{salt}:' || doc_id || ':' || i), 1, 8))::bigint % {sides}"


@query(
    "typo_injection",
    f"""with w as (select doc_id, unnest(string_split(text, ' ')) as w, generate_subscripts(string_split(text, ' '), 1) - 1 as i from documents where text is not null),
d as (select *, case when length(w) > 2 then {_sql_draw('at', '1000003')} % (length(w) - 2) + 2 else 1 end as spot, {_sql_draw('kind', '4')} as kind, case when {_sql_draw('side', '2')} = 0 then -1 else 1 end as side, {_sql_draw('whether', '1000000')} as p from w),
k as (select *, substr(w, spot, 1) as here, instr('{spans.KEY_ROWS}', lower(substr(w, spot, 1))) as key from d),
n as (select *, case when substr('{spans.KEY_ROWS}', key + side, 1) <> ' ' then substr('{spans.KEY_ROWS}', key + side, 1) else substr('{spans.KEY_ROWS}', key - side, 1) end as near from k),
s as (select doc_id, i, case when length(w) < 3 or regexp_matches(w, '^[`/]|^https?:') or p >= 200000 then w
  when kind = 0 then case when regexp_full_match(here, '[A-Za-z]') then substr(w, 1, spot - 1) || near || substr(w, spot + 1) else w end
  when kind = 1 then substr(w, 1, spot - 1) || substr(w, spot + 1) when kind = 2 then substr(w, 1, spot) || substr(w, spot) else replace(w, chr(39), '') end as w from n)
select doc_id, sha256(string_agg(w, ' ' order by i)) as text from s group by doc_id""",
)
def typo_injection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with seeded slips (their hashes)."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    return d.select("doc_id", F.sha2(spans.with_typos(F.col("text"), 0.2, F.col("doc_id")), 256).alias("text"))


@query(
    "mojibake_repair",
    """with c as (select row_id, text, list_transform(string_split(text, ''), lambda x: unicode(x)) as u from chat_messages where text <> ''),
d as (select row_id, text, try(decode(unhex(array_to_string(list_transform(u, lambda x: format('{:02x}', x)), '')))) as repaired from c where list_max(u) < 256)
select row_id, repaired from d where repaired is not null and repaired <> text""",
)
def mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that undo cleanly from Latin-1."""
    c = table(spark, sf_dir, "chat_messages").where("text is not null").select("row_id", "text", chats.latin1_repair("text").alias("repaired"))
    return c.where("text <> repaired").select("row_id", "repaired")


@query("note_bullets", f"""with b as (select doc_id, unnest(list_transform(regexp_extract_all(regexp_replace(text, '\\r\\n|[\\r\\x{{85}}\\x{{2028}}\\x{{2029}}]', chr(10), 'g'), '(?m)^[-*]\\s+(.*)$', 1), lambda x: regexp_replace(x, '^{SQL_WS}+|{SQL_WS}+$', '', 'g'))) as b from documents where doc_kind = 'note' and text is not null)
select doc_id, count(*) as n from b where length(b) > 40 group by doc_id""")
def note_bullets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bullets of more than forty characters in notes, whatever their line ends."""
    d = table(spark, sf_dir, "documents").where("doc_kind = 'note' and text is not null")
    return d.select("doc_id", F.size(vault.bullets(F.col("text"))).cast("bigint").alias("n")).where("n > 0")


@query("gate_run")
def gate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole funnel over the records, with the recorded judge scores as verdicts: every record and why it fell."""
    r = table(spark, sf_dir, "conv_records")
    v = r.where("gate_state.judge is not null").groupBy(F.col("provenance.record_id").alias("record_id")).agg(F.max_by("gate_state.judge.overall", "rec_no").alias("overall"), F.max_by("gate_state.judge.passed", "rec_no").alias("passed"))
    kept, rejected = gate.run_gates(r, v, "rec_no")
    return kept.select("rec_no", F.lit(None).cast("string").alias("drop_reason")).unionByName(rejected.select("rec_no", "drop_reason"))


@query(
    "external_filter",
    """with msgs as (select rec_no, unnest(messages) as m, generate_subscripts(messages, 1) as i from conv_records),
t as (select rec_no, i, coalesce(m.content, '') as v, m.role = 'assistant' as a, lag(m.role = 'assistant') over (partition by rec_no order by i) as b from msgs),
p as (select *, regexp_matches(v, '^\\s*<think>[\\s\\S]*?</think>') as th, regexp_replace(v, '^\\s*<think>[\\s\\S]*?</think>', '') as rest from t),
g as (select rec_no, string_agg(v, chr(10) order by i) as text, bool_and(not a or th) as complete, bool_or(coalesce(a and b, false)) as twice,
  bool_and(not a or (th and contains(v, 'SCENE:') and contains(v, 'CHARACTERS:') and contains(v, 'PLAN:'))) as onschema, bool_or(trim(rest) = '') as hollow from p group by rec_no)
select r.rec_no, case when regexp_matches(text, '(?i)\\b(?:[1-9]|1[0-7])[- ]years?[- ]old\\b|\\b(?:one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen)[- ]years?[- ]old\\b|\\bage:\\s*(?:[1-9]|1[0-7])\\b|\\b(?:lolicon|loli|shota|underage|preteen|jailbait)\\b|\\bchild.s body\\b') then 'minor_coded'
  when regexp_matches(text, '(?i)\\bi have read the <rules>') then 'leaked_meta' when not complete then 'think_incomplete' when twice then 'consecutive_assistant_turns' when not onschema then 'think_offschema' when hollow then 'empty_turn' end as reason
from conv_records r left join g using (rec_no) where r.messages is not null""",
)
def external_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First reason to drop each record's conversation, read as a third-party row."""
    r = table(spark, sf_dir, "conv_records").where("messages is not null")
    turns = F.transform("messages", lambda m: F.struct(F.when(m["role"] == "assistant", "gpt").otherwise("human").alias("from"), m["content"].alias("value")))
    return r.select("rec_no", gate.external_reason(turns).alias("reason"))


@query("revenue_by_region", "select r_name, n_name, sum(l_extendedprice * (1 - l_discount)) as revenue, count(distinct o_orderkey) as n_orders from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by r_name, n_name")
def revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain relational query over the star schema."""
    t = lambda n: table(spark, sf_dir, n)
    j = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"), F.count_distinct("o_orderkey").alias("n_orders"))


@query("stats_lines", f"with {_TEMPLATE_STATS} select template, printf('%-40s %8d %8d %8d %6.2f', template, rollouts, verified, kept, verified / rollouts) as line from stats")
def stats_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template statistics as report lines."""
    return stats.stats_lines(stats.template_stats(table(spark, sf_dir, "conv_records"), "rec_no"))


@query(
    "call_pairing",
    """with t as (select * from (values (0, 'f', 1, 'c'), (0, 'f', 2, 'c'), (0, 'f', 3, 'r'), (0, 'g', 4, 'r'), (0, 'f', 5, 'r'), (1, 'g', 1, 'c'), (1, 'g', 2, 'r'), (1, 'g', 3, 'r')) t(rec, name, pos, kind)),
n as (select *, row_number() over (partition by rec, name, kind order by pos) as k from t)
select r.rec, r.name, r.pos as resp_pos, coalesce(case when c.pos < r.pos then c.pos end, -1) as call_pos from n r left join n c on r.rec = c.rec and r.name = c.name and r.k = c.k and c.kind = 'c' where r.kind = 'r'""",
)
def call_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k-th response of a name answers its k-th call; a response without an open call has -1."""
    rows = [(0, "f", 1, "c"), (0, "f", 2, "c"), (0, "f", 3, "r"), (0, "g", 4, "r"), (0, "f", 5, "r"), (1, "g", 1, "c"), (1, "g", 2, "r"), (1, "g", 3, "r")]
    t = spark.createDataFrame(rows, "rec int, name string, pos int, kind string")
    calls, responses = (t.where(f"kind = '{k}'").select("rec", "name", F.col("pos").alias(n)) for k, n in (("c", "call_pos"), ("r", "resp_pos")))
    return trajectories.pair_calls(calls, responses).select("rec", "name", "resp_pos", F.coalesce("call_pos", F.lit(-1)).alias("call_pos"))


@query("owner_detection", "with n as (select sender, count(distinct conversation_id) as n_threads from chat_messages where sender is not null group by 1) select sender, n_threads from n where n_threads = (select max(n_threads) from n)")
def owner_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sender who takes part in most conversations."""
    c = table(spark, sf_dir, "chat_messages")
    return stats.most_common_member(c, "conversation_id", "sender")


@query("interest_ranking", "with r as (select source, doc_id, substr(text, 1, 600) as t, row_number() over (partition by source order by length(text) desc, doc_id) as k from documents where text is not null), n as (select source, count(*) as n, min(doc_id) as first_seen from documents where text is not null group by source having count(*) >= 5) select n.source, n.n, n.first_seen, sha256(string_agg(t, '|' order by k)) as texts from n join r on n.source = r.source and r.k <= 4 group by n.source, n.n, n.first_seen")
def interest_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with at least five texts, and their four longest ones cut at 600 characters."""
    g = stats.longest_of_groups(table(spark, sf_dir, "documents").select("source", "text", "doc_id"), "source", "text", "doc_id")
    return g.select("source", "n", "first_seen", F.sha2(F.array_join("texts", "|"), 256).alias("texts"))


@query("seed_mix", "select split_part(seed_id, '-', 1) as part, count(*) as n from seeds where seed_id is not null group by 1")
def seed_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds by kind."""
    return stats.prefix_counts(table(spark, sf_dir, "seeds").where("seed_id is not null"), "seed_id", 0)


@query("drop_shares", "with d as (select coalesce(gate_state.drop_reason, 'error') as drop_reason, count(*) as n from conv_records where gate_state.dropped group by 1) select drop_reason, n, n / (select count(*) from conv_records) as share from d")
def drop_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop reasons with their share of all records."""
    r = table(spark, sf_dir, "conv_records")
    d = stats.drop_reasons(r).groupBy("drop_reason").agg(F.sum("n").alias("n"))
    return stats.shares_of(d.join(F.broadcast(r.agg(F.count(F.lit(1)).alias("total")))), "n", F.col("total")).drop("total")


@query(
    "instance_keys",
    """with p as (select rec_no, template_id, list_sort(map_entries(params)) as e from task_instances where template_id is not null and params is not null)
select rec_no, substr(sha256('{"params":{' || array_to_string(list_transform(e, lambda x: '"' || replace(replace(x.key, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || '":"' || replace(replace(x.value, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || '"'), ',') || '},"template":"' || template_id || '"}'), 1, 12) as instance_key from p""",
)
def instance_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content key of every task instance."""
    t = table(spark, sf_dir, "task_instances").where("template_id is not null and params is not null").withColumn("e", F.array_sort(F.map_entries("params")))
    return t.select("rec_no", expand.instance_key(F.col("template_id"), F.col("e.key"), F.col("e.value")).alias("instance_key"))


@query("cache_misses", "select o_custkey, case when bool_or(o_orderstatus = 'F') then 'known ' || o_custkey when o_custkey % 10 = 3 then null else 'asked ' || o_custkey end as text, not bool_or(o_orderstatus = 'F') and o_custkey % 10 = 3 as failed from orders group by o_custkey")
def cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for each order's customer: answered from the cache where it is there, else by a scripted model that fails for some."""
    o = table(spark, sf_dir, "orders").select("o_orderstatus", F.col("o_custkey").cast("bigint").alias("o_custkey"))
    asked = o.select("o_custkey", F.lit("m").alias("model"), F.lit(None).cast("string").alias("system"), F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("prompt"), F.lit("{}").alias("options"))
    keyed = models.keyed_requests(asked).select("o_custkey", "request_key").distinct()
    known = o.where("o_orderstatus = 'F'").select("o_custkey").distinct().join(keyed, "o_custkey").select("request_key", F.concat(F.lit("known "), F.col("o_custkey").cast("string")).alias("text"))
    got = models.complete(asked.drop("o_custkey"), known, models.scripted(_customer_reply), 4)
    return keyed.join(got, "request_key").select("o_custkey", "text", F.col("error").isNotNull().alias("failed"))


def _customer_reply(request: dict) -> str:
    number = request["prompt"].split(" ")[1]
    if number.endswith("3"):
        raise models.ModelError("overloaded", 503)
    return f"asked {number}"


@query("trajectory_ingest", "with r as (select rec_no, template_id, unnest(range(0, n_rollouts)) as round from task_instances where n_rollouts > 0) select row_number() over (order by round, rec_no) - 1 as prompt_index, template_id, case when template_id is not null then 2 end as n_messages, case when template_id is null then 'prompt index outside the emitted inputs' end as error from r")
def trajectory_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task instances as one-turn trajectories, ingested against their rollout numbers."""
    t = table(spark, sf_dir, "task_instances").where("n_rollouts > 0")
    ro = expand.rollout_order(t.select("rec_no", "template_id", "family", "holdout", "prompt", "n_rollouts"), ["rec_no"]).withColumn("instance_key", F.col("rec_no").cast("string"))
    said = F.array(F.struct(F.lit("human").alias("from"), F.col("prompt").alias("value")), F.struct(F.lit("gpt").alias("from"), F.lit("<think>\nplan\n</think>\nDone.").alias("value")))
    tr = ro.select("prompt_index", F.lit(True).alias("completed"), F.lit(False).alias("partial"), said.alias("conversations"))
    return trajectories.ingest(tr, ro, "Quill").select("prompt_index", "template_id", F.size("messages").cast("bigint").alias("n_messages"), "error")
