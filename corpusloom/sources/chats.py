"""Chat exports to message rows ``thread, pos, ts_us, sender, text, role``; ``role`` is null where the sources' anchors give it."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.functions.text import clean_url, strip
from corpusloom.functions.timestamps import apple_epoch_us, instant_us, month_family
from corpusloom.operators.order import segment_filter, sessionize, stride
from corpusloom.schema import IMESSAGE_DDL, INSTAGRAM_DDL, REDDIT_DDL, TEAMS_DDL
from corpusloom.session import cut, stored
from corpusloom.sources.jsonl import parsed, read_ordered

#: Texts that an export writes for events, not turns.
AUTO_EVENTS = (
    r"(?i)sent an attachment\.?\s*$|\bliked a message\b|\bshared (?:a|an) (?:reel|post|story|link)\b|^Reacted .+ to your message\s*$"
    r"|\b(?:named the group|changed the (?:theme|group name|nickname)|set (?:the|your) nickname|added|left the group|created the group|removed)\b"
)
DELETED = ("", "[deleted]", "[removed]")
#: Parsers whose ``pos`` no two messages share.
PLACED = ("generic_jsonl", "imessage")


@dataclass(frozen=True)
class ChatSource:
    """One export. Exactly one of the two anchors is set where the export itself does not name its owner."""

    id: str
    parser: str
    path: str
    owner_sender: str | None = None
    assistant_sender: str | None = None
    include_threads: tuple[str, ...] = ()
    exclude_threads: tuple[str, ...] = ()
    min_thread_messages: int = 1
    max_participants: int = 0
    max_records: int = 0

    def __post_init__(self):
        if self.parser in ("generic_jsonl", "imessage") and (self.owner_sender is None) == (self.assistant_sender is None):
            raise ValueError(f"{self.id}: set exactly one of owner_sender and assistant_sender")
        if self.parser in ("instagram", "teams", "reddit") and (self.owner_sender is not None or self.assistant_sender is not None):
            raise ValueError(f"{self.id}: a {self.parser} export names its owner; owner_sender and assistant_sender must not be set")


@dataclass(frozen=True)
class ChatLimits:
    """Session gap, caps and substance floors."""

    session_gap_minutes: int = 240
    max_messages: int = 200
    min_messages: int = 2
    min_chars: int = 0
    min_mean_chars: float = 0.0
    keep_url_query: bool = False
    thread_share: float = 0.0
    holdout_families: tuple[str, ...] = field(default=())


def role_of(sender: Column, source: ChatSource) -> Column:
    """The owner sits in the user's seat, or the named sender in the assistant's."""
    if source.assistant_sender is not None:
        return F.when(sender == source.assistant_sender, "assistant").otherwise("user")
    return F.when(sender == F.lit(source.owner_sender), "user").otherwise("assistant")


@F.pandas_udf(StringType())
def latin1_repair(texts: pd.Series) -> pd.Series:
    """UTF-8 that was read as Latin-1, undone where it undoes cleanly; other texts unchanged."""

    def one(t: str | None) -> str | None:
        try:
            return None if t is None else t.encode("latin-1").decode("utf-8")
        except UnicodeError:
            return t

    return texts.map(one)


def _stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)\.[^./]+$", 1)


def _chosen(df: DataFrame, source: ChatSource) -> DataFrame:
    """Thread filters: include and exclude lists, then the minimum size."""
    if source.include_threads:
        df = df.where(F.col("thread").isin(*source.include_threads))
    if source.exclude_threads:
        df = df.where(~F.col("thread").isin(*source.exclude_threads))
    if source.min_thread_messages > 1:
        big = df.groupBy("thread").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= source.min_thread_messages)
        df = df.join(big.select("thread"), "thread", "left_semi")
    return df


def generic(spark: SparkSession, source: ChatSource, limits: ChatLimits) -> DataFrame:
    """One message a line: ``conversation_id, ts, sender, text``; a missing field fails with file and line."""
    fields = ["conversation_id", "ts", "sender", "text"]
    p = parsed(read_ordered(spark, source.path, "pos"), ", ".join(f"{f} string" for f in fields), fields)
    return p.select(F.col("conversation_id").alias("thread"), "pos", instant_us(F.col("ts")).alias("ts_us"), "sender", "text", F.lit(None).cast("string").alias("role"))


def part_text(part: Column, keep_query: bool) -> Column:
    """Text of a message part: its text, its last revision, or its cleaned link; attachments have none."""
    url = F.coalesce(part["url"], F.lit(""))
    return (
        F.when(part["type"] == "text", strip(F.replace(F.coalesce(part["text"], F.lit("")), F.lit("￼"))))
        .when(part["type"] == "edited", strip(F.coalesce(F.try_element_at(part["history"], F.lit(-1))["text"], F.lit(""))))
        .when(part["type"] == "url", url if keep_query else clean_url(url))
        .otherwise(F.lit(""))
    )


def imessage(spark: SparkSession, source: ChatSource, limits: ChatLimits) -> DataFrame:
    """A folder of ``<thread>.jsonl``; nanoseconds since 2001; announcements and rows without text fall away."""
    p = parsed(read_ordered(spark, source.path), IMESSAGE_DDL)
    text = F.array_join(F.filter(F.transform("parts", lambda x: part_text(x, limits.keep_url_query)), lambda t: t != ""), "\n")
    rows = p.where("type = 'message' and coalesce(sender, '') <> '' and timestamp is not null")
    rows = rows.select(_stem(F.col("file")).alias("thread"), F.struct("file", "line_no").alias("pos"), apple_epoch_us(F.col("timestamp")).alias("ts_us"), "sender", text.alias("text"), F.lit(None).cast("string").alias("role"))
    return _chosen(rows.where("text <> ''"), source)


def instagram(spark: SparkSession, source: ChatSource, limits: ChatLimits) -> DataFrame:
    """``<thread>/message_*.json`` shards, newest first, Latin-1 garbled; the owner is the member of most threads."""
    raw = spark.read.schema(INSTAGRAM_DDL).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "message_*.json").json(source.path)
    raw = raw.select(F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1).alias("thread"), F.col("_metadata.file_name").alias("file"), "participants", "messages")
    members = raw.select("thread", F.explode("participants.name").alias("m")).select("thread", latin1_repair("m").alias("m")).distinct()
    if source.max_participants:
        small = members.groupBy("thread").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") <= source.max_participants)
        raw, members = raw.join(small.select("thread"), "thread", "left_semi"), members.join(small.select("thread"), "thread", "left_semi")
    if source.include_threads:
        raw, members = raw.where(F.col("thread").isin(*source.include_threads)), members.where(F.col("thread").isin(*source.include_threads))
    if source.exclude_threads:
        raw, members = raw.where(~F.col("thread").isin(*source.exclude_threads)), members.where(~F.col("thread").isin(*source.exclude_threads))
    from corpusloom.operators.stats import most_common_member

    owner = most_common_member(members, "thread", "m").select(F.col("m").alias("owner"))
    m = raw.select("thread", "file", F.posexplode("messages").alias("i", "m")).where("coalesce(m.content, '') <> '' and m.sender_name is not null and m.timestamp_ms is not null")
    m = m.select("thread", F.struct(F.col("m.timestamp_ms").alias("t"), "file", "i").alias("pos"), (F.col("m.timestamp_ms") * 1000).alias("ts_us"), latin1_repair("m.sender_name").alias("sender"), latin1_repair("m.content").alias("content"))
    m = m.where(~F.col("content").rlike(AUTO_EVENTS)).withColumn("text", strip(F.col("content"))).where("text <> ''")
    m = m.join(F.broadcast(owner)).withColumn("role", F.when(F.col("sender") == F.col("owner"), "user").otherwise("assistant"))
    return _chosen(m.select("thread", "pos", "ts_us", "sender", "text", "role"), source)


def teams(spark: SparkSession, source: ChatSource, limits: ChatLimits) -> DataFrame:
    """One JSON for each chat; it names its owner."""
    raw = spark.read.schema(TEAMS_DDL).option("multiLine", True).json(source.path).select(_stem(F.col("_metadata.file_path")).alias("thread"), F.coalesce("me.name", F.lit("")).alias("owner"), F.posexplode("messages").alias("i", "m"))
    rows = raw.select("thread", F.struct("i").alias("pos"), instant_us(F.col("m.sent")).alias("ts_us"), F.col("m.from").alias("sender"), strip(F.coalesce("m.text", F.lit(""))).alias("text"), F.when(F.col("m.from") == F.col("owner"), "user").otherwise("assistant").alias("role"), F.col("m.sent").alias("_s"))
    return _chosen(rows.where("coalesce(sender, '') <> '' and coalesce(_s, '') <> '' and text <> ''").drop("_s"), source)


def _comments(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(REDDIT_DDL).option("multiLine", True).json(path)
    owner = F.coalesce(F.nullif("me.name", F.lit("")), F.nullif("account", F.lit("")), F.lit("me"))
    return raw.select(_stem(F.col("_metadata.file_path")).alias("file"), owner.alias("owner"), F.posexplode("comments").alias("i", "c"))


def reddit(spark: SparkSession, source: ChatSource, limits: ChatLimits) -> DataFrame:
    """Each comment and what it answers: a thread of two messages, the parent as user and the owner as assistant."""
    c = _comments(spark, source.path)
    title, body = strip(F.coalesce("c.in_reply_to.title", F.lit(""))), strip(F.coalesce("c.in_reply_to.text", F.lit("")))
    c = c.select("file", "owner", "i", F.col("c.sent").alias("sent"), strip(F.coalesce("c.text", F.lit(""))).alias("reply"), F.array_join(F.filter(F.array(title, body), lambda t: t != ""), "\n\n").alias("parent"), F.coalesce(F.nullif(strip(F.col("c.in_reply_to.author")), F.lit("")), F.lit("reddit")).alias("author"), F.coalesce(F.nullif("c.permalink", F.lit("")), F.concat("file", F.lit("#"), F.col("i").cast("string"))).alias("thread"))
    c = c.where(F.coalesce("sent", F.lit("")) != "").where(~F.col("reply").isin(*DELETED)).where(~F.col("parent").isin(*DELETED))
    turns = F.array(F.struct(F.lit(0).alias("k"), F.col("author").alias("sender"), F.col("parent").alias("text"), F.lit("user").alias("role")), F.struct(F.lit(1).alias("k"), F.col("owner").alias("sender"), F.col("reply").alias("text"), F.lit("assistant").alias("role")))
    return c.select("thread", "sent", "file", "i", F.explode(turns).alias("t")).select("thread", F.struct("sent", "file", "i", "t.k").alias("pos"), instant_us(F.col("sent")).alias("ts_us"), "t.sender", "t.text", "t.role")


def _stub(name: str) -> Callable:
    def parse(spark: SparkSession, source: ChatSource, limits: ChatLimits) -> DataFrame:
        raise NotImplementedError(f"{name}: no parser yet")

    return parse


PARSERS: dict[str, Callable[[SparkSession, ChatSource, ChatLimits], DataFrame]] = {
    "generic_jsonl": generic,
    "imessage": imessage,
    "instagram": instagram,
    "teams": teams,
    "reddit": reddit,
    "discord": _stub("discord"),
    "journal": _stub("journal"),
}


def interests(spark: SparkSession, path: str, at_least: int = 5) -> DataFrame:
    """Communities with at least so many own comments, with their four longest ones cut at 600 characters."""
    from corpusloom.operators.stats import longest_of_groups

    c = _comments(spark, path).select(strip(F.coalesce("c.subreddit", F.lit(""))).alias("community"), strip(F.coalesce("c.text", F.lit(""))).alias("text"), F.struct("file", "i").alias("pos"))
    return longest_of_groups(c.where("community <> ''").where(~F.col("text").isin(*DELETED)), "community", "text", "pos", at_least)


def _with_role(rows: DataFrame, source: ChatSource) -> DataFrame:
    return rows.withColumn("role", F.coalesce(F.col("role"), role_of(F.col("sender"), source))) if source.owner_sender or source.assistant_sender else rows


def messages_to_records(rows: DataFrame, source: ChatSource, limits: ChatLimits) -> DataFrame:
    """Sessions of each thread that are conversations: ``thread, segment, family, holdout, messages`` (a record's message array), and ``first_pos``, where the session begins.

    A thread's order is ``pos``. Segments end at a gap or at the message cap; too short, one-sided or thin ones fall away.
    """
    s = sessionize(_with_role(rows, source), ["thread"], "ts_us", ["pos"], limits.session_gap_minutes * 60_000_000, limits.max_messages)
    good = segment_filter(s, ["thread", "segment"], F.col("role"), "text", limits.min_messages, limits.min_chars, limits.min_mean_chars).select("thread", "segment")
    return _records(s.join(good, ["thread", "segment"], "left_semi"), source, limits)


def _records(s: DataFrame, source: ChatSource, limits: ChatLimits) -> DataFrame:
    msg = F.struct("pos", F.struct("role", F.col("sender").alias("speaker"), F.col("text").alias("content"), F.date_format(F.timestamp_micros("ts_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("ts")).alias("m"))
    # a segment is bounded by the message cap
    g = s.groupBy("thread", "segment").agg(F.transform(F.sort_array(F.collect_list(msg)), lambda x: x["m"]).alias("messages"), F.min_by("ts_us", "pos").alias("first_us"), F.min("pos").alias("first_pos"))
    fam = month_family(F.lit(source.id), F.col("first_us"))
    return g.select("thread", "segment", fam.alias("family"), fam.isin(*limits.holdout_families).alias("holdout") if limits.holdout_families else F.lit(False).alias("holdout"), "messages", "first_pos")


def conversations(rows: DataFrame, source: ChatSource, limits: ChatLimits) -> DataFrame:
    """The sessions of ``messages_to_records`` by their places alone: ``thread, segment, first_pos, last_pos``. No text is moved or kept for them."""
    lean = _with_role(rows, source).select("thread", "pos", "ts_us", (F.col("role") == "user").alias("user"), F.length(F.coalesce("text", F.lit(""))).alias("size"))
    s = sessionize(lean, ["thread"], "ts_us", ["pos"], limits.session_gap_minutes * 60_000_000, limits.max_messages, stored)
    n, seats = F.count(F.lit(1)), F.count_if("user") * F.count_if(~F.col("user"))
    g = s.groupBy("thread", "segment").agg(n.alias("n"), seats.alias("seats"), F.sum("size").alias("chars"), F.avg("size").alias("mean"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))
    good = (F.col("n") >= limits.min_messages) & (F.col("seats") > 0) & (F.col("chars") >= limits.min_chars) & (F.col("mean") >= limits.min_mean_chars)
    return cut(g.where(good).select("thread", "segment", "first_pos", "last_pos"))


def _told(rows: DataFrame, chosen: DataFrame, source: ChatSource, limits: ChatLimits) -> DataFrame:
    """Records of the chosen conversations (at most ``max_records``): a session is what its thread has from its first place to its last."""
    c = chosen.select(F.col("thread").alias("_t"), "segment", "first_pos", "last_pos")
    s = _with_role(rows, source).join(F.broadcast(c), (F.col("thread") == F.col("_t")) & F.col("pos").between(F.col("first_pos"), F.col("last_pos")))
    return _records(s.select(*rows.columns, "segment"), source, limits)


def yield_order(records: DataFrame, source: ChatSource) -> DataFrame:
    """``thread, _from``: what orders the threads of an export. Where one stream holds them all it is where each begins (for comments: when they
    were sent, over all accounts), else the name of the thread's own file or folder."""
    begins = F.min("first_pos") if source.parser in ("generic_jsonl", "reddit") else F.lit(0)
    return records.groupBy("thread").agg(begins.alias("_from"))


def parse_all(spark: SparkSession, sources: list[ChatSource], limits: ChatLimits) -> DataFrame:
    """Records of all sources: parsed, capped by thread share and by stride, concatenated. An unknown parser is an error."""
    from corpusloom.operators.order import dominance_cap, numbered

    out = []
    for src in sources:
        rows = PARSERS[src.parser](spark, src, limits)
        lean = src.max_records > 0 and src.parser in PLACED
        r = conversations(rows, src, limits) if lean else messages_to_records(rows, src, limits)
        if limits.thread_share > 0 and src.parser in ("imessage", "instagram", "teams"):
            counts = dominance_cap(r.groupBy("thread").agg(F.count(F.lit(1)).alias("n")), limits.thread_share)
            r = r.withColumn("_p", F.row_number().over(Window.partitionBy("thread").orderBy("segment")) - 1).join(counts, "thread")
            step = F.col("n").cast("double") / F.col("cap")
            i = F.ceil(F.col("_p") / step)
            hit = lambda j, step=step: (j >= 0) & (j < F.col("cap")) & (F.floor(j * step) == F.col("_p"))
            r = r.where((F.col("cap") >= F.col("n")) | hit(i) | hit(i - 1) | hit(i + 1)).drop("_p", "n", "cap")
        if src.max_records > 0:
            p = numbered(r.join(yield_order(r, src), "thread"), ["_from", "thread", "segment"])
            r = stride(p.join(F.broadcast(p.agg(F.count(F.lit(1)).alias("_n")))), "pos", F.col("_n"), src.max_records)
            r = _told(rows, r, src, limits) if lean else r.drop("pos", "_n", "_from")
        out.append(r.drop("first_pos").withColumn("source", F.lit(src.id)))
    return reduce(DataFrame.unionByName, out)


def is_auto_event(text: str) -> bool:
    """Whether a text is an export's event line."""
    return re.search(AUTO_EVENTS, text) is not None
