"""Identity and PII patterns over records, lane exemptions and pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import explode_once
from corpusloom.operators.order import numbered
from corpusloom.session import cut

#: Label, pattern, action of the identity and boilerplate deny list and of the PII shapes.
PATTERNS: list[tuple[str, str, str]] = [
    ("teacher_deepseek", r"\bdeepseek\b", "drop"),
    ("teacher_kimi", r"\bkimi\b|\bmoonshot\s*ai\b", "drop"),
    ("teacher_glm", r"\bglm[-\s]?\d+(?:\.\d+)?\b|\bzhipu\b|\bz\.ai\b", "drop"),
    ("teacher_openai", r"\bchatgpt\b|\bopenai\b|\bgpt-?[45]\b", "drop"),
    ("teacher_anthropic", r"\banthropic\b|\bclaude\b", "drop"),
    ("ai_selfid", r"\bas an ai\b|\bas a language model\b|\bi am an? (?:ai|artificial|language model)\b", "drop"),
    ("knowledge_cutoff", r"\bknowledge cutoff\b|\btraining data\b|\bi don't have real-?time\b", "drop"),
    ("boilerplate_delve", r"\bdelve\b|\btapestry of\b|\bit's important to note\b", "flag"),
    ("harness_hermes", r"\bhermes[-\s]?agent\b", "drop"),
    ("pii_email", r"\b[\w.+-]+@[\w-]+\.[a-z]{2,}\b", "drop"),
    ("pii_api_key", r"\b(?:sk|pk|api|key)[-_][A-Za-z0-9_-]{20,}\b", "drop"),
    ("pii_phone", r"\b(?:\+?1[-. ]?)?\(?\d{3}\)?[-. ]\d{3}[-. ]\d{4}\b", "flag"),
    ("pii_ssn", r"\b\d{3}-\d{2}-\d{4}\b", "drop"),
]
#: Labels that do not apply to a lane.
LANE_EXEMPTIONS = {"d": ["pii_email", "pii_phone"]}


def text_hits(text: Column, patterns: list[tuple[str, str, str]] = PATTERNS) -> Column:
    """Sorted ``action:label`` of the patterns that a text matches; a null text matches none."""
    found = [F.when(text.rlike(f"(?iu)(?U){p}"), F.lit(f"{action}:{label}")) for label, p, action in patterns]
    return F.array_sort(F.array_compact(F.array(*found)))


def record_hits(messages: Column, patterns: list[tuple[str, str, str]] = PATTERNS) -> Column:
    """Sorted distinct hits of a record: all patterns over contents and thoughts of user and assistant, only ``teacher_`` labels over tool results."""
    talk = F.filter(messages, lambda m: m["role"].isin("user", "assistant"))
    prose = F.array_join(F.flatten(F.transform(talk, lambda m: F.array(F.coalesce(m["content"], F.lit("")), F.coalesce(m["thought"], F.lit(""))))), "\n\x00\n")
    tools = F.array_join(F.transform(F.filter(messages, lambda m: m["role"] == "tool"), lambda m: F.coalesce(m["content"], F.lit(""))), "\n\x00\n")
    teachers = [p for p in patterns if p[0].startswith("teacher_")]
    return F.array_sort(F.array_distinct(F.concat(text_hits(prose, patterns), text_hits(tools, teachers))))


def _without(hits: Column, labels: list[str]) -> Column:
    return F.filter(hits, lambda h: ~F.substring_index(h, ":", -1).isin(*labels))


def lane_hits(hits: Column, lane: Column, exemptions: dict[str, list[str]] = LANE_EXEMPTIONS) -> Column:
    """Hits without the labels from which the lane is exempt."""
    out = hits
    for name, labels in exemptions.items():
        out = F.when(lane == name, _without(hits, labels)).otherwise(out)
    return out


def drops(hits: Column) -> Column:
    """Whether any hit kills the record."""
    return F.exists(hits, lambda h: h.startswith("drop:"))


def pseudonym_table(texts: DataFrame, order: list[str], text: str, name_patterns: list[str], preserve: list[str] = (), known: DataFrame | None = None) -> DataFrame:
    """``name, pseudonym``: every distinct matched name (lower case) numbered ``Person-n`` in first-seen order, after those already known.

    ``order`` columns give the reading order. Names are first reduced to one row each with their first occurrence; only
    that table, one row for each distinct name, is numbered, over range partitions.
    """
    pattern = "|".join(f"(?:{p})" for p in name_patterns)
    hits = explode_once(texts.select(*order, F.col(text).alias("_text")), F.regexp_extract_all("_text", F.lit(rf"(?U)\b({pattern})\b"), 1), "_name", "_at")
    hits = hits.select(F.struct(*order, "_at").alias("_first"), F.lower("_name").alias("name"))
    if preserve:
        hits = hits.where(~F.col("name").isin(*[p.lower() for p in preserve]))
    names = hits.groupBy("name").agg(F.min("_first").alias("_first"))
    base = F.lit(0)
    if known is not None:
        names = names.join(known.select("name"), "name", "left_anti")
        base = F.lit(known.count())
    fresh = numbered(names, ["_first", "name"]).select("name", F.concat(F.lit("Person-"), (base + F.col("pos") + 1).cast("string")).alias("pseudonym"))
    return fresh if known is None else known.select("name", "pseudonym").unionByName(fresh)


def _pattern(name_patterns: list[str]) -> str:
    return r"(?U)\b(?:" + "|".join(f"(?:{p})" for p in name_patterns) + r")\b"


def _swapped(text: Column, own: Column) -> Column:
    """``text`` with each name of ``own`` (``array<struct<n, spelled, pseudonym>>``, longest first) replaced as a whole word."""
    return F.aggregate(own, text, lambda t, e: F.regexp_replace(t, F.concat(F.lit(r"(?U)\b\Q"), e["spelled"], F.lit(r"\E\b")), e["pseudonym"]))


def _own_names(found: DataFrame, keys: list[str], mapping: DataFrame) -> DataFrame:
    """``keys, _own``: the mapped names of each row of ``found`` (``keys, spelled``), longest first."""
    named = found.withColumn("name", F.lower("spelled")).join(mapping.select("name", "pseudonym"), "name")
    return named.groupBy(*keys).agg(F.sort_array(F.collect_set(F.struct((-F.length("spelled")).alias("n"), "spelled", "pseudonym"))).alias("_own"))


def pseudonymise(texts: DataFrame, text: str, mapping: DataFrame, name_patterns: list[str]) -> DataFrame:
    """Replaces mapped names in ``text``. Every distinct text is joined with the names that it holds, so the mapping may be of any size; null texts stay."""
    keys = ["_h1", "_h2"]
    keyed = texts.withColumn("_h1", F.xxhash64(text)).withColumn("_h2", F.xxhash64(F.lit(7), F.col(text)))
    held = keyed.select(*keys, F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(_pattern(name_patterns)), 0)).alias("_held")).where(F.size("_held") > 0).dropDuplicates(keys)
    own = _own_names(held.select(*keys, F.explode("_held").alias("spelled")), keys, mapping)
    swapped = F.when(F.col("_own").isNull(), F.col(text)).otherwise(_swapped(F.col(text), F.col("_own")))
    return keyed.join(own, keys, "left").withColumn(text, swapped).select(*texts.columns)


def pseudonymise_records(records: DataFrame, order: str, name_patterns: list[str], preserve: list[str] = (), known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Records whose contents, thoughts and speakers (those that are a name as a whole) carry pseudonyms instead of names, and the mapping.

    Adds ``pseudonymised``, whether a record changed. ``order`` must be unique; names are numbered in reading order after the ``known`` ones. System texts and
    tool payloads are not touched.
    """
    pattern = _pattern(name_patterns)
    m = records.select(order, F.posexplode("messages").alias("_i", "m"))
    whole = F.when(F.col("m.speaker").rlike(f"^(?:{pattern})$"), F.col("m.speaker"))
    fields = m.select(order, "_i", F.posexplode(F.array(F.col("m.content"), F.col("m.thought"), whole)).alias("_f", "_text")).where("_text is not null")
    mapping = cut(pseudonym_table(fields, [order, "_i", "_f"], "_text", name_patterns, preserve, known))
    found = fields.select(order, F.explode(F.array_distinct(F.regexp_extract_all("_text", F.lit(pattern), 0))).alias("spelled")).distinct()
    own = F.col("_own")
    spoken = lambda s: F.coalesce(F.try_element_at(F.filter(own, lambda e: e["spelled"] == s), F.lit(1))["pseudonym"], s)
    changed = F.transform("messages", lambda x: x.withField("content", _swapped(x["content"], own)).withField("thought", _swapped(x["thought"], own)).withField("speaker", spoken(x["speaker"])))
    j = records.join(_own_names(found, [order], mapping), order, "left").withColumn("pseudonymised", own.isNotNull())
    return j.withColumn("messages", F.when(own.isNotNull(), changed).otherwise(F.col("messages"))).drop("_own"), mapping
