"""Queries of the training-text operators on the test tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.conversations import BREAK_BELOW, rebuilt_conversations, reply_links
from corpusloom.llm.mojibake import garbled_texts
from corpusloom.llm.packing import fill_containers
from corpusloom.llm.personal import personal_data
from corpusloom.llm.pairs import broken_sides
from corpusloom.llm.repetition import record_texts, repeated_content
from corpusloom.llm.splits import STAND_INS, assign_splits, record_groups, record_keys
from corpusloom.llm.tokenizer import count_tokens, encode_texts
from corpusloom.llm.truncation import truncated_texts
from corpusloom.operators.deliveries import drop_repeated, keyed_messages
from corpusloom.queries import SQL_MESSAGES, SQL_WS
from corpusloom.session import cut, table

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


@query(
    "p6_found",
    f"""with {SQL_MESSAGES},
shown as (
  select m.*, case
    when s.owner is not null then case when m.sender_key = s.owner then 'user' else 'assistant' end
    when s.named is not null then case when m.sender_key = s.named then 'assistant' else 'user' end end as role
  from messages m left join (select source,
      nullif(lower(regexp_replace(owner_sender, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')), '') as owner,
      nullif(lower(regexp_replace(assistant_sender, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')), '') as named from chat_sources) s using (source)
  where regexp_replace(replace(replace(replace(text, chr(8203), ''), chr(65279), ''), chr(65532), ''), '{SQL_WS}+', '', 'g') <> '' and conversation_id is not null),
sound as (
  select conversation_id from shown group by conversation_id
  having bool_and(sender_key is not null and ts_us is not null and role is not null) and bool_or(role = 'user')
    and arg_max(role, struct_pack(a := ts_us, b := row_id)) = 'assistant')
select conversation_id, row_number() over (partition by conversation_id order by ts_us, row_id) as turn_no, row_id, role
from shown where conversation_id in (select conversation_id from sound)""",
)
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered messages of the whole conversations with their roles."""
    return rebuilt_conversations(table(spark, sf_dir, "chat_messages"), table(spark, sf_dir, "chat_sources")).drop("thread")


@query(
    "p5_found",
    r"""with msgs as (select rec_no, unnest(messages) as m, generate_subscripts(messages, 1) - 1 as msg_no from conv_records),
texts as (select rec_no, msg_no, 'content' as field, m.content as text from msgs union all select rec_no, msg_no, 'thought', m.thought from msgs),
lists as (select rec_no, msg_no, field, regexp_extract_all(lower(text), '\p{L}+') as ws from texts where text <> ''),
wins as (select rec_no, msg_no, field, len(ws) as n, i, list_aggregate(ws[i:i+4], 'string_agg', ' ') as g
  from (select *, unnest(range(1, len(ws) - 3)) as i from lists where len(ws) >= 12)),
again as (select * from (select *, row_number() over (partition by rec_no, msg_no, field, g order by i) as k from wins) where k > 1),
hit as (select distinct rec_no, msg_no, field, n, i + d as w from again, (select unnest(range(0, 5)) as d))
select rec_no, cast(msg_no as bigint) as msg_no, field from hit group by rec_no, msg_no, field, n having count(*) / n >= 0.3""",
)
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents and thoughts of which at least 0.3 repeats what they have already said."""
    return repeated_content(record_texts(table(spark, sf_dir, "conv_records")), ["rec_no", "msg_no", "field"]).where("share >= 0.3").select("rec_no", "msg_no", "field")


@query("p8_ids")
def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document by the byte-level BPE vocabulary of 50 thousand tokens."""
    return encode_texts(table(spark, sf_dir, "documents"), "doc_id")


@query("p9_containers")
def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the documents and the containers of 2,048 tokens that hold them."""
    return fill_containers(count_tokens(table(spark, sf_dir, "documents"), "doc_id"), "doc_id", "n_tokens", 2048)


def _beside(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two tables of one row each as one row."""
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one")


@query("p9_checks", "select count(*) as n_texts, 0 as n_missing, 0 as n_overfull, 0 as n_overlaps, 0 as n_split_though_small, 0 as n_holes, true as near_least from documents")
def p9_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the containers: every text is there and whole, none is overfull, no pieces overlap, no small text is split, and they are within 11/9 of the least number."""
    sizes = count_tokens(table(spark, sf_dir, "documents"), "doc_id")
    p = cut(fill_containers(sizes, "doc_id", "n_tokens", 2048))
    texts = p.groupBy("doc_id").agg(F.sum("piece_size").alias("size"), F.count(F.lit(1)).alias("pieces")).join(sizes, "doc_id", "full")
    t = texts.agg(F.count(F.lit(1)).alias("n_texts"), F.count_if(~F.coalesce(F.col("size") == F.col("n_tokens"), F.lit(False))).alias("n_missing"), F.count_if((F.col("pieces") > 1) & (F.col("n_tokens") <= 2048)).alias("n_split_though_small"), F.sum("n_tokens").alias("tokens"))
    boxes = p.where("container_no is not null").groupBy("container_no").agg(F.sum("piece_size").alias("size"), F.max(F.col("container_start") + F.col("piece_size")).alias("end"), F.count_distinct("container_start").alias("starts"), F.count(F.lit(1)).alias("pieces"))
    b = boxes.agg(F.count(F.lit(1)).alias("boxes"), F.count_if(F.col("end") > 2048).alias("n_overfull"), F.count_if((F.col("starts") < F.col("pieces")) | (F.col("end") < F.col("size"))).alias("n_overlaps"), (F.max("container_no") + 1 - F.count(F.lit(1))).alias("n_holes"))
    near = F.col("boxes") <= F.ceil(F.col("tokens") / 2048) * 11 / 9 + 2
    return _beside(t, b).select("n_texts", "n_missing", "n_overfull", "n_overlaps", "n_split_though_small", "n_holes", near.alias("near_least"))


@query("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose text is garbled in whole or in part."""
    return garbled_texts(table(spark, sf_dir, "chat_messages"), "row_id").select("row_id")


@query("p4_restored")
def p4_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The garbled messages with their restored text."""
    return garbled_texts(table(spark, sf_dir, "chat_messages"), "row_id")


@query("p4_checks", "select 0 as n_not_finished, 0 as n_unknown, 0 as n_ascii")
def p4_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of restored texts: nothing garbled is found in those without loss, and each belongs to a message beyond ASCII."""
    chat = table(spark, sf_dir, "chat_messages")
    found = cut(garbled_texts(chat, "row_id"))
    again = garbled_texts(found.where("not lossy"), "row_id", "restored").agg(F.count(F.lit(1)).alias("n_not_finished"))
    texts = found.select("row_id").join(chat.select("row_id", "text"), "row_id", "left").agg(F.count_if(F.col("text").isNull()).alias("n_unknown"), F.count_if(~F.col("text").rlike(r"[^\x00-\x7f]")).alias("n_ascii"))
    return _beside(again, texts).drop("_one")


def _personal_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = table(spark, sf_dir, "chat_messages").select(F.lit("chat_messages").alias("tab"), F.col("row_id").alias("row_key"), F.lit(0).cast("bigint").alias("msg_no"), "text")
    m = table(spark, sf_dir, "conv_records").select("rec_no", F.posexplode("messages.content").alias("msg_no", "text"))
    return chat.unionByName(m.select(F.lit("conv_records").alias("tab"), F.col("rec_no").alias("row_key"), F.col("msg_no").cast("bigint").alias("msg_no"), "text"))


@query("p7_found")
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of personal data in chat messages and in the contents of conversation records."""
    found = personal_data(_personal_texts(spark, sf_dir), ["tab", "row_key", "msg_no"], given_names=table(spark, sf_dir, "given_names"))
    return found.select("tab", "row_key", "msg_no", F.explode("kinds").alias("pii_kind"))


@query("p7_redacted")
def p7_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts with personal data, with typed placeholders in its place."""
    return personal_data(_personal_texts(spark, sf_dir), ["tab", "row_key", "msg_no"], given_names=table(spark, sf_dir, "given_names"), redacted=True).drop("kinds")


@query("p10_found")
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text was cut off."""
    return truncated_texts(table(spark, sf_dir, "documents")).where("cut").select("doc_id")


@query("p10_sources")
def p10_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source cuts its texts."""
    t = truncated_texts(table(spark, sf_dir, "documents"))
    n = F.count(F.lit(1))
    return t.groupBy("source").agg(n.alias("n_texts"), F.count_if("cut").alias("n_cut"), F.count_if(F.col("cut") & F.col("at_limit")).alias("n_at_limit"), (F.count_if("cut") / n).alias("share"))


@query("p1_found")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective sides of the preference pairs and the name of their defect."""
    return broken_sides(table(spark, sf_dir, "dpo_pairs"))


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_groups(record_keys(table(spark, sf_dir, "task_instances"), table(spark, sf_dir, "seeds"), table(spark, sf_dir, "book_configs")))


_SLUG = r"trim(regexp_replace(lower({}), '[^a-z0-9]+', '-', 'g'), '-')"
_STAND_INS = ", ".join(f"'{s}'" for s in sorted(STAND_INS))


@query(
    "p3_found",
    f"""with recursive fam as (select rec_no, {_SLUG.format('family')} as k from task_instances union all select rec_no, {_SLUG.format('family')} from seeds),
works as (select rec_no, {_SLUG.format('work_id')} as k from book_configs),
keys as (
  select distinct rec_no, 'w:' || k as key from fam where k <> '' and k not in ({_STAND_INS}) and k not in (select k from works where regexp_full_match(k, '[a-z]+'))
  union select rec_no, 'w:' || k from works where k <> '' and k not in ({_STAND_INS}) and regexp_matches(k, '[-0-9]')
  union select rec_no, 'a:' || k from (select rec_no, {_SLUG.format("case when contains(a, ',') then regexp_replace(a, '^([^,]*),(.*)$', '\\2 \\1', 's') else a end")} as k
    from (select rec_no, unnest(string_split(author, ';')) as a from book_configs)) where k <> '' and k not in ({_STAND_INS})),
anchors as (select key, min(rec_no) as m from keys group by key),
anchored as (select distinct rec_no, m from keys join anchors using (key)),
edges as (select distinct x.m as a, y.m as b from anchored x join anchored y using (rec_no)),
reach(a, b) as (select a, b from edges union select r.a, e.b from reach r join edges e on r.b = e.a),
roots as (select a, min(b) as root from reach group by a)
select distinct r.root as group_no, x.rec_no from anchored x join roots r on r.a = x.m where x.rec_no <> r.root""",
)
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records tied to a smaller record number, with the smallest of their group."""
    return _groups(spark, sf_dir).where("rec_no <> group_no").select("group_no", "rec_no")


@query("p3_splits")
def p3_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, validation and test for every record, whole groups together."""
    return assign_splits(cut(_groups(spark, sf_dir)), {"train": 0.8, "validation": 0.1, "test": 0.1}).select("rec_no", "split")


@query(
    "p3_split_checks",
    """select split, 0 as n_torn_groups, true as near_share from (select unnest(['train', 'validation', 'test']) as split)""",
)
def p3_split_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the splits: no group is in two of them, and each has its share of the rows within a bin's width or the largest group."""
    shares = {"train": 0.8, "validation": 0.1, "test": 0.1}
    s = cut(assign_splits(cut(_groups(spark, sf_dir)), shares))
    groups = s.groupBy("group_no").agg(F.count_distinct("split").alias("k"), F.min("split").alias("split"), F.count(F.lit(1)).alias("n"))
    torn = groups.groupBy("split").agg(F.count_if(F.col("k") > 1).alias("n_torn_groups"), F.sum("n").alias("n"))
    total = groups.agg(F.sum("n").alias("total"), F.max("n").alias("most"))
    want = F.coalesce(*[F.when(F.col("split") == k, F.lit(v)) for k, v in shares.items()])
    near = F.abs(F.col("n") / F.col("total") - want) <= F.greatest(F.lit(2 / 240), F.col("most") / F.col("total"))
    return torn.join(F.broadcast(total)).select("split", "n_torn_groups", near.alias("near_share"))


@query("p6_threads")
def p6_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads of each source by reply links alone, as if the conversation ids were not known: for every message its thread, the turn in its source at which it begins."""
    m = drop_repeated(keyed_messages(table(spark, sf_dir, "chat_messages"))).where("sender_key is not null and ts_us is not null and source is not null")
    return reply_links(m, "source", break_below=BREAK_BELOW).select("source", "row_id", "turn_no", "parent_turn", "root_turn")


@query("p5_divergence")
def p5_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of every content and thought from its language's character classes and common words, with its share of repeated words."""
    return repeated_content(record_texts(table(spark, sf_dir, "conv_records")), ["rec_no", "msg_no", "field"])
