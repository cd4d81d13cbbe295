"""Queries of sources and sinks: exports are written from the test tables into the shared folder and read back."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from corpusloom.functions import text as T
from corpusloom.functions.timestamps import instant_us
from corpusloom.operators import records
from corpusloom.queries import SQL_MESSAGES, SQL_WS, query
from corpusloom.session import cut, table
from corpusloom.sources import books, chats, jsonl, vault
from corpusloom.sources.files import json_lines, scratch_folder, write_named, write_ordered

def _strip(text: str) -> str:
    """SQL of a text without outer white space."""
    return f"regexp_replace({text}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')"


def _hash(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("\x1e")), 256)


# --- JSON lines ----------------------------------------------------------------------------------------


@query(
    "jsonl_round_trip",
    """with msgs as (select rec_no, unnest(messages) as m, generate_subscripts(messages, 1) as i from conv_records),
said as (select rec_no, count(*) as n, sha256(string_agg(m.role || chr(31) || coalesce(m.content, chr(30)) || chr(31) || coalesce(m.thought, chr(30)), chr(29) order by i)) as h from msgs group by rec_no)
select provenance.record_id as record_id, coalesce(n, 0) as n_messages, coalesce(h, sha256('')) as said from conv_records left join said using (rec_no)""",
)
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON lines and read with their schema."""
    root = scratch_folder(spark, "records")
    jsonl.write_jsonl(table(spark, sf_dir, "conv_records").drop("rec_no"), root)
    said = F.transform("messages", lambda m: F.concat_ws("\x1f", m["role"], F.coalesce(m["content"], F.lit("\x1e")), F.coalesce(m["thought"], F.lit("\x1e"))))
    return jsonl.read_typed(spark, root).select(F.col("provenance.record_id").alias("record_id"), F.size("messages").cast("bigint").alias("n_messages"), F.sha2(F.array_join(said, "\x1d"), 256).alias("said"))


@query("jsonl_lenient", "select doc_id, sha256(coalesce(text, chr(30))) as text, false as broken from documents where doc_id % 7 <> 0 union all select null, sha256(chr(30)), true from documents where doc_id % 7 = 0")
def jsonl_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which every seventh is broken: the good ones are read, the broken ones are kept apart."""
    root = scratch_folder(spark, "lenient")
    whole = F.to_json(F.struct("doc_id", "text"), {"ignoreNullFields": "false"})
    line = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit('{"doc_id": '), F.col("doc_id").cast("string"))).otherwise(whole)
    table(spark, sf_dir, "documents").select(line.alias("value")).write.text(root)
    got = cut(jsonl.read_lenient(spark, root, "doc_id bigint, text string"))
    broken = got.where("_corrupt_record is not null").select(F.lit(None).cast("bigint").alias("doc_id"), _hash(F.lit(None).cast("string")).alias("text"), F.lit(True).alias("broken"))
    return jsonl.good_rows(got).select("doc_id", _hash(F.col("text")).alias("text"), F.lit(False).alias("broken")).unionByName(broken)


@query("jsonl_positions", "select row_number() over (order by rec_no desc) - 1 as line_no, rec_no from task_instances")
def jsonl_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of the lines of a file, read in splits."""
    root = scratch_folder(spark, "lines")
    line = F.to_json(F.struct("rec_no", "prompt"))
    write_named(json_lines(table(spark, sf_dir, "task_instances").withColumn("_rank", -F.col("rec_no")).withColumn("path", F.lit("all.jsonl")), "path", ["_rank"], line), root)
    return jsonl.read_ordered(spark, root).select("line_no", F.get_json_object("raw", "$.rec_no").cast("bigint").alias("rec_no"))


@query("run_files", "select dense_rank() over (order by rec_no % 3) - 1 as file_rank, row_number() over (partition by rec_no % 3 order by rec_no) - 1 as line_no, rec_no from seeds")
def run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of several files of a run, in the order of the files' names."""
    root = scratch_folder(spark, "run")
    s = table(spark, sf_dir, "seeds").withColumn("path", F.concat(F.lit("lane_"), (F.col("rec_no") % 3).cast("string"), F.lit(".jsonl")))
    write_named(json_lines(s, "path", ["rec_no"], F.to_json(F.struct("rec_no", "scenario"))), root)
    return jsonl.read_run(spark, root).select("file_rank", "line_no", F.get_json_object("raw", "$.rec_no").cast("bigint").alias("rec_no"))


@query("jsonl_appended", "select rec_no, prompt from task_instances union all select rec_no, scenario from seeds")
def jsonl_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables appended to the same lines and read raw."""
    root = scratch_folder(spark, "appended")
    for name, text in (("task_instances", "prompt"), ("seeds", "scenario")):
        jsonl.append_jsonl(table(spark, sf_dir, name).select("rec_no", F.col(text).alias("prompt")), root)
    raw = jsonl.read_raw(spark, root)
    return raw.select(F.get_json_object("raw", "$.rec_no").cast("bigint").alias("rec_no"), F.from_json("raw", "prompt string")["prompt"].alias("prompt"))


@query("reply_store", "select doc_id, sha256(text) as text from documents where trim(text) <> ''")
def reply_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies put into the response table in two runs; blank ones are never stored, and before the first run it is empty."""
    root = scratch_folder(spark, "replies")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("request_key"), "text")
    empty = jsonl.cached_replies(spark, root)
    for k in (0, 1):
        jsonl.put_replies(d.where(F.col("request_key").cast("bigint") % 2 == k), root)
    stored = jsonl.cached_replies(spark, root).unionByName(empty)
    return stored.select(F.col("request_key").cast("bigint").alias("doc_id"), _hash(F.col("text")).alias("text"))


# --- chat exports --------------------------------------------------------------------------------------


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that every export can hold: conversation (as a file name), time, sender and text known."""
    c = table(spark, sf_dir, "chat_messages").withColumn("us", instant_us(F.col("ts"))).withColumn("thread", F.replace("conversation_id", F.lit("/"), F.lit("_")))
    return c.where("us is not null and coalesce(sender, '') <> '' and text is not null and thread is not null")


_SQL_EXPORT = f"""{SQL_MESSAGES},
export as (select k.*, c.sender, replace(k.conversation_id, '/', '_') as thread, {_strip("k.text")} as stripped from keyed k join chat_messages c using (row_id)
  where k.ts_us is not null and coalesce(c.sender, '') <> '' and k.text is not null and k.conversation_id is not null)"""


def _rows(df: DataFrame) -> DataFrame:
    return df.select("thread", "ts_us", "sender", _hash(F.col("text")).alias("text"), "role")


@query("export_generic", f"with {_SQL_EXPORT} select conversation_id as thread, ts_us, sender, sha256(text) as text, cast(null as varchar) as role from export")
def export_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generic export, one message a line."""
    root = scratch_folder(spark, "generic")
    _export(spark, sf_dir).select(F.to_json(F.struct("conversation_id", "ts", "sender", "text")).alias("value")).write.text(root)
    return _rows(chats.generic(spark, chats.ChatSource("g", "generic_jsonl", root, owner_sender="me"), chats.ChatLimits()))


@query(
    "export_imessage",
    f"""with {_SQL_EXPORT}, s as (select *, {_strip("replace(text, chr(65532), '')")} as shown from export where row_id % 11 <> 0)
select thread, ts_us, sender, sha256(shown) as text, cast(null as varchar) as role from s where shown <> ''""",
)
def export_imessage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of threads with parts and nanoseconds since 2001; announcements and texts of attachments alone fall away."""
    root = scratch_folder(spark, "imessage")
    part = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    ns = ((F.col("us") - F.lit(978307200000000)) * 1000).alias("timestamp")
    line = F.to_json(F.struct(ns, "sender", F.when(F.col("row_id") % 11 == 0, "announcement").otherwise("message").alias("type"), F.array(part("attachment", F.lit("gone")), part("text", F.col("text"))).alias("parts")))
    lines = json_lines(_export(spark, sf_dir), "thread", ["row_id"], line)
    write_named(lines.select(F.concat("thread", F.lit(".jsonl")).alias("path"), "body"), root)
    return _rows(chats.imessage(spark, chats.ChatSource("i", "imessage", root, owner_sender="me"), chats.ChatLimits()))


@query("export_instagram", f"with {_SQL_EXPORT} select thread, ts_us // 1000 * 1000 as ts_us, sender, sha256(stripped) as text, 'assistant' as role from export where stripped <> '' and not regexp_matches(text, '{chats.AUTO_EVENTS.replace(chr(39), chr(39) * 2)}')")
def export_instagram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of message shards in Latin-1 disguise; the member of all threads is the owner, event lines fall away."""
    root = scratch_folder(spark, "instagram")
    disguised = lambda c: F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
    e = _export(spark, sf_dir)
    m = e.groupBy("thread").agg(
        F.collect_list(F.struct(disguised(F.col("sender")).alias("sender_name"), F.floor(F.col("us") / 1000).alias("timestamp_ms"), disguised(F.col("text")).alias("content"))).alias("messages"),
        F.array_append(F.collect_set(F.struct(disguised(F.col("sender")).alias("name"))), F.struct(F.lit("Owner of all").alias("name"))).alias("participants"),
    )
    write_named(m.select(F.concat("thread", F.lit("/message_1.json")).alias("path"), F.to_json(F.struct("participants", "messages")).alias("body")), root)
    return _rows(chats.instagram(spark, chats.ChatSource("n", "instagram", root), chats.ChatLimits()))


@query("export_teams", f"with {_SQL_EXPORT}, o as (select thread, min(sender) as owner from export group by thread) select thread, ts_us, sender, sha256(stripped) as text, case when sender = owner then 'user' else 'assistant' end as role from export join o using (thread) where stripped <> ''")
def export_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file for each chat, which names its owner."""
    root = scratch_folder(spark, "teams")
    said = F.struct(F.col("sender").alias("from"), F.col("ts").alias("sent"), F.col("text").alias("text"))
    m = _export(spark, sf_dir).groupBy("thread").agg(F.collect_list(said).alias("messages"), F.struct(F.min("sender").alias("name")).alias("me"))
    write_named(m.select(F.concat("thread", F.lit(".json")).alias("path"), F.to_json(F.struct("me", "messages")).alias("body")), root)
    return _rows(chats.teams(spark, chats.ChatSource("t", "teams", root), chats.ChatLimits()))


@query(
    "export_reddit",
    f"""with {_SQL_EXPORT}, c as (select * from export where stripped not in ('', '[deleted]', '[removed]'))
select 'link-' || row_id as thread, ts_us, case k when 0 then sender else 'me' end as sender, sha256(case k when 0 then 'About ' || conversation_id else stripped end) as text, case k when 0 then 'user' else 'assistant' end as role
from (select row_id, ts_us, conversation_id, stripped, coalesce(nullif({_strip('sender')}, ''), 'reddit') as sender from c), (select unnest([0, 1]) as k)""",
)
def export_reddit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of an account with what they answer: threads of two messages."""
    root = scratch_folder(spark, "reddit")
    parent = F.struct(F.col("sender").alias("author"), F.concat(F.lit("About "), F.col("conversation_id")).alias("title"), F.lit("").alias("text"))
    comment = F.struct(F.col("ts").alias("sent"), F.col("text").alias("text"), F.col("source").alias("subreddit"), F.concat(F.lit("link-"), F.col("row_id").cast("string")).alias("permalink"), parent.alias("in_reply_to"))
    m = _export(spark, sf_dir).groupBy("source").agg(F.collect_list(comment).alias("comments")).withColumn("account", F.lit("me"))
    write_named(m.select(F.concat("source", F.lit(".json")).alias("path"), F.to_json(F.struct("account", "comments")).alias("body")), root)
    return _rows(chats.reddit(spark, chats.ChatSource("r", "reddit", root), chats.ChatLimits()))


# --- books, works, notes -------------------------------------------------------------------------------


@F.pandas_udf(BinaryType())
def _zipped(texts: pd.Series) -> pd.Series:
    """An archive with one page, and a cover that is no text."""

    def one(t: str) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("OEBPS/cover.xhtml", "<p>cover</p>")
            z.writestr("OEBPS/page1.xhtml", t)
        return out.getvalue()

    return texts.map(one)


_SQL_VISIBLE = _strip("regexp_replace(regexp_replace(text, '[ \\t]+', ' ', 'g'), '\\n\\n\\n+', chr(10) || chr(10), 'g')")


@query(
    "book_files",
    f"""with d as (select doc_id, case doc_id % 3 when 0 then {_strip('text')} else {_SQL_VISIBLE} end as t from documents where text is not null)
select 'doc_' || doc_id as stem, sha256(case when doc_id % 3 = 2 and length(t) <= 200 then '' else t end) as text from d""",
)
def book_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as plain books with boilerplate, web pages and archives, read by suffix."""
    root = scratch_folder(spark, "books")
    d = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text")
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(F.lit("<html><head><title>no text</title><style>p {color: red}</style></head><body><!-- no text --><p>"), escaped, F.lit("</p><script>no_text()</script></body></html>"))
    plain = F.concat(F.lit("A header\n*** START OF THE PROJECT GUTENBERG EBOOK ***\n"), F.col("text"), F.lit("\n*** END OF THE PROJECT GUTENBERG EBOOK ***\nA licence"))
    kind = F.col("doc_id") % 3
    suffix = F.when(kind == 0, ".txt").when(kind == 1, ".html").otherwise(".epub")
    body = F.when(kind == 0, F.encode(plain, "UTF-8")).when(kind == 1, F.encode(page, "UTF-8")).otherwise(_zipped(page))
    write_named(d.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), suffix).alias("path"), body.alias("body")), root)
    return books.read_books(spark, root).select("stem", _hash(F.col("text")).alias("text"))


@query(
    "archive_works",
    f"""with w as (select doc_id, source, row_number() over (order by doc_id desc) as pos, {_strip("coalesce(text, '')")} as t from documents),
ok as (select * from w where doc_id % 13 <> 0 and doc_id % 17 <> 0 and len(string_split_regex(t, '{SQL_WS}+')) >= 50),
r as (select *, row_number() over (partition by source order by pos) as k from ok)
select 'ao3-' || doc_id as work_id, coalesce(source, 'unknown') as group_name, sha256(t) as text from r where k <= 5 order by pos limit 200""",
)
def archive_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works of an archive in stream order, without excluded and known ones, at most five of a group and two hundred in all."""
    root = scratch_folder(spark, "works")
    d = table(spark, sf_dir, "documents").withColumn("_rank", -F.col("doc_id")).withColumn("path", F.lit("all.jsonl"))
    tags = F.create_map(F.lit("Fandom"), F.concat(F.coalesce("source", F.lit("")), F.lit(", Another")), F.lit("Additional Tags"), F.when(F.col("doc_id") % 13 == 0, "Fluff, Underage").otherwise("Fluff"))
    line = F.to_json(F.struct(F.col("doc_id").alias("id"), F.concat(F.lit("Title "), F.col("doc_id").cast("string")).alias("title"), tags.alias("metadata"), "text"))
    write_named(json_lines(d, "path", ["_rank"], line), root)
    known = d.where("doc_id % 17 = 0").select(F.concat(F.lit("title "), F.col("doc_id").cast("string")).alias("key"))
    w = books.select_works(books.read_works(spark, root), 200, 50, 5, known)
    return w.select("work_id", "group_name", _hash(F.col("text")).alias("text"))


@query("vault_folders", "select 'kb' as folder, count(*) as n from documents where doc_kind = 'note' and text is not null and doc_id % 3 < 2 union all select 'diary', count(*) from documents where doc_kind = 'note' and text is not null and doc_id % 6 = 2 union all select 'voice', length('Speak plainly.')")
def vault_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of the named folders alone, and the owner's voice."""
    root = scratch_folder(spark, "folders")
    d = table(spark, sf_dir, "documents").where("doc_kind = 'note' and text is not null")
    folder = F.when(F.col("doc_id") % 3 < 2, "kb/n").when(F.col("doc_id") % 6 == 2, "diary/n").otherwise("other/n")
    write_named(d.select(F.concat(folder, F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), F.col("text").alias("body")), root)
    write_named(spark.createDataFrame([("kb/voice.txt", " Speak plainly.\n")], "path string, body string"), root)
    base = root.removeprefix("file:")
    n = vault.read_vault(spark, base, "kb", ["diary"]).groupBy(F.substring_index("rel", "/", 1).alias("folder")).agg(F.count(F.lit(1)).alias("n"))
    voice = vault.voice_note(spark, base, "kb", "voice.txt") + vault.voice_note(spark, base, "kb", "none.txt")
    return n.unionByName(spark.createDataFrame([("voice", len(voice))], "folder string, n bigint"))


@query(
    "vault_notes",
    f"""with n as (select doc_id, case doc_id % 3 when 0 then 'kb/People/n' when 1 then 'kb/n' else 'notes/n' end || doc_id || '.md' as rel, case doc_id % 3 when 0 then 'People' when 1 then 'Index' else 'notes' end as section, text from documents where doc_kind = 'note' and text is not null)
select rel, section, case when doc_id % 2 = 0 then 'Note ' || doc_id else 'n' || doc_id end as title, lower(section) || '-' || substr(sha256(rel), 1, 8) as family_key, sha256({_strip('text')}) as body from n""",
)
def vault_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of a vault with their section, title, family and body."""
    root = scratch_folder(spark, "vault")
    d = table(spark, sf_dir, "documents").where("doc_kind = 'note' and text is not null")
    folder = F.when(F.col("doc_id") % 3 == 0, "kb/People/n").when(F.col("doc_id") % 3 == 1, "kb/n").otherwise("notes/n")
    named = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("name: Note "), F.col("doc_id").cast("string"), F.lit("\n"))).otherwise(F.lit(""))
    front = F.concat(F.lit("---\n"), named, F.lit("mood: calm\n---\n"))
    write_named(d.select(F.concat(folder, F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), F.concat(front, "text").alias("body")), root)
    n = vault.read_vault(spark, root.removeprefix("file:"), "kb")
    return n.select("rel", "section", "title", "family_key", _hash(F.col("body")).alias("body"))


# --- records from segments -----------------------------------------------------------------------------


@query(
    "chat_records",
    f"""with {_SQL_EXPORT}, e as (select *, row_number() over (partition by conversation_id order by row_id) as k from export),
g as (select *, case when ts_us - lag(ts_us) over w <= 14400000000 then 0 else 1 end as new from e window w as (partition by conversation_id order by row_id)),
s as (select *, sum(new) over (partition by conversation_id order by row_id rows unbounded preceding) as s from g),
c as (select *, (row_number() over (partition by conversation_id, s order by row_id) - 1) // 20 as c from s),
x as (select *, dense_rank() over (partition by conversation_id order by s, c) - 1 as segment from c),
r as (select conversation_id as thread, segment, count(*) as n_messages, 'x/' || strftime(make_timestamp(arg_min(ts_us, row_id)), '%Y-%m') as family, min(row_id) as f from x
  group by 1, 2 having count(*) >= 2 and count(distinct sender like '%a%') >= 2),
o as (select r.*, row_number() over (order by t0, segment) - 1 as pos, count(*) over () as n from r join (select thread, min(f) as t0 from r group by 1) using (thread))
select thread, segment, n_messages, family from o where n <= 100 or pos in (select cast(floor(i * (m::double / 100)) as bigint) from (select max(n) as m from o), (select unnest(range(0, 100)) as i))""",
)
def chat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a generic export as records, a hundred of them by stride in the order in which the export gives them."""
    root = scratch_folder(spark, "sessions")
    e = _export(spark, sf_dir).withColumn("who", F.when(F.contains("sender", F.lit("a")), "a").otherwise("b"))
    line = F.to_json(F.struct("conversation_id", "ts", F.col("who").alias("sender"), "text"))
    write_ordered(e, ["row_id"], line, root)
    r = chats.parse_all(spark, [chats.ChatSource("x", "generic_jsonl", root, owner_sender="a", max_records=100)], chats.ChatLimits(max_messages=20))
    made = records.stream_records(r, "run")
    detail = F.get_json_object("provenance.source.detail_json", "$.conversation_id")
    segment = F.get_json_object("provenance.source.detail_json", "$.segment").cast("bigint")
    return made.select(detail.alias("thread"), segment.alias("segment"), F.size("messages").cast("bigint").alias("n_messages"), F.col("provenance.family").alias("family"))
