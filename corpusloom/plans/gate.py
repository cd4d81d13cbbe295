"""The funnel: verify, judge, scrub, deduplicate, harmonise.

One wide table goes through; every stage adds columns and marks drops, and only rows not yet dropped count in the next stage. Nothing is removed
before the end, where rows split into kept and rejected with their gate state. The result of the judge (external cost) and of deduplication
(shuffle) is cut by a reliable checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.spans import mask_of, prose_length, restore_of
from corpusloom.operators.dedupe import conversational_text, duplicates
from corpusloom.operators.scrub import LANE_EXEMPTIONS, PATTERNS, drops, lane_hits, pseudonymise_records, record_hits
from corpusloom.operators.stats import weighted_judge
from corpusloom.operators.verifiers import verified
from corpusloom.plans.models import Batch, ModelError, call_json
from corpusloom.plans.render import judge_transcript
from corpusloom.session import cut

#: Roles that may be rewritten, by lane; an empty map means nothing may.
HARMONISE = {"a": ("assistant",), "c": ("assistant",)}


def alive(df: DataFrame) -> Column:
    """Rows that no stage has dropped yet."""
    return F.col("drop_reason").isNull()


def verify_stage(records: DataFrame) -> DataFrame:
    """Adds ``verified``, ``verifier_id`` and failed checks; unknown templates drop with ``error``, failed checks with ``verify``."""
    v = verified(records, "_v")
    v = v.withColumn("verified", F.coalesce("_v.passed", F.lit(False))).withColumn("verifier_id", F.col("_v.verifier_id")).withColumn("failed_checks", F.coalesce("_v.failed", F.array().cast("array<string>")))
    return v.withColumn("drop_reason", F.when(F.col("_v").isNull(), "error").when(~F.col("verified"), "verify")).drop("_v")


def rubric_name(lane: Column, messages: Column, persona: str) -> Column:
    """Lane c records that are not in the persona's voice have a rubric of their own."""
    voiced = is_persona_voiced(lane, messages, persona)
    return F.when((lane == "c") & ~voiced, F.lit("c_character")).otherwise(lane)


def is_persona_voiced(lane: Column, messages: Column, persona: str) -> Column:
    """Lane a by construction; else only if the persona speaks every assistant turn."""
    said = F.array_distinct(F.transform(F.filter(messages, lambda m: m["role"] == "assistant"), lambda m: F.coalesce(m["speaker"], F.lit(""))))
    return (lane == "a") | (said == F.array(F.lit(persona)))


def judge_stage(df: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Joins verdicts (``record_id, overall, passed``); failing or missing ones drop with ``judge``, errors with ``error``."""
    j = df.join(verdicts.select("record_id", "overall", "passed"), df["provenance.record_id"] == verdicts["record_id"], "left").drop("record_id")
    reason = F.when(F.col("passed").isNull(), "error").when(~F.col("passed"), "judge")
    return j.withColumn("drop_reason", F.coalesce("drop_reason", reason))


def model_verdicts(df: DataFrame, rubric: DataFrame, axes: dict[str, str], threshold: float, prompt: str, call: Batch, model: str, width: int = 8) -> DataFrame:
    """``record_id, overall, passed, axes, judge_model, error``: each distinct record read by a model under a rubric.

    ``prompt`` holds ``{axes}`` for the list of axes with their descriptions. The model answers ``{"scores": {axis: 1..5}}``; an answer that leaves out an axis, or stays no
    JSON, is an error of its record. Records are sent on ``width`` partitions.
    """
    listed = prompt.format(axes="\n".join(f"- {name}: {text} (1-5)" for name, text in axes.items()))
    texts = df.where(alive(df)).select(F.col("provenance.record_id").alias("record_id"), judge_transcript(F.col("system"), F.col("messages")).alias("transcript")).dropDuplicates(["record_id"])

    def check(v: object) -> dict[str, float]:
        missing = set(axes) - set(v["scores"])
        if missing:
            raise ValueError(f"left out axes: {sorted(missing)}")
        return {k: float(v["scores"][k]) for k in axes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, errors = [], []
            for text in b.column("transcript").to_pylist():
                try:
                    scores.append(list(call_json(call, {"model": model, "system": listed, "prompt": text}, check).items()))
                    errors.append(None)
                except ModelError as e:
                    scores.append(None)
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([b.column("record_id"), pa.array(scores, pa.map_(pa.string(), pa.float64())), pa.array(errors, pa.string())], names=["record_id", "axes", "error"])

    said = cut(texts.repartition(width).mapInArrow(run, "record_id string, axes map<string,double>, error string"))
    scored = weighted_judge(said.where("axes is not null").select(F.col("record_id").alias("id"), F.explode("axes").alias("axis", "score")), rubric, threshold)
    j = said.join(scored.select(F.col("id").alias("record_id"), "overall", "passed"), "record_id", "left")
    return j.select("record_id", "overall", "passed", F.transform_values("axes", lambda k, v: F.greatest(F.lit(1.0), F.least(F.lit(5.0), v))).alias("axes"), F.lit(model).alias("judge_model"), "error")


def pseudonym_stage(df: DataFrame, order: str, name_patterns: list[str], preserve: list[str] = (), lanes: tuple[str, ...] = ("d",), known: DataFrame | None = None) -> DataFrame:
    """Names in living records of the lanes become pseudonyms; a record that changed is flagged ``transform:pseudonymised``."""
    mine = F.coalesce(F.col("provenance.lane").isin(*lanes), F.lit(False)) & alive(df)
    changed, _ = pseudonymise_records(df.where(mine).select(order, "messages"), order, name_patterns, preserve, known)
    j = df.join(changed.where("pseudonymised").select(order, F.col("messages").alias("_m")), order, "left")
    flags = F.array_append(F.coalesce("scrub_flags", F.array().cast("array<string>")), F.lit("transform:pseudonymised"))
    return j.withColumn("scrub_flags", F.when(F.col("_m").isNotNull(), flags).otherwise(F.col("scrub_flags"))).withColumn("messages", F.coalesce("_m", "messages")).drop("_m")


def scrub_stage(df: DataFrame, patterns: list[tuple[str, str, str]] = PATTERNS, exemptions: dict[str, list[str]] = LANE_EXEMPTIONS) -> DataFrame:
    """Adds ``scrub_flags``; any ``drop:`` hit drops the record."""
    hits = lane_hits(record_hits(F.col("messages"), patterns), F.col("provenance.lane"), exemptions)
    s = df.withColumn("scrub_flags", F.when(alive(df), hits))
    return s.withColumn("drop_reason", F.coalesce("drop_reason", F.when(drops(F.col("scrub_flags")), F.lit("scrub"))))


def dedupe_stage(df: DataFrame, order: str, threshold: float = 0.8) -> DataFrame:
    """Later duplicates of rows alive so far drop with ``dedupe`` and name the row that they repeat. ``order`` must be unique."""
    text = df.where(alive(df)).select(F.col("provenance.record_id").alias("_id"), F.col(order).alias("_pos"), conversational_text(F.col("messages")).alias("_t"))
    found = duplicates(text.withColumn("_row", F.struct("_pos", "_id")), "_row", "_pos", "_t", threshold).select(F.col("_row._pos").alias("_pos"), F.col("duplicate_of._id").alias("deduped_against"))
    return df.join(found, df[order] == found["_pos"], "left").drop("_pos").withColumn("drop_reason", F.coalesce("drop_reason", F.when(F.col("deduped_against").isNotNull(), F.lit("dedupe"))))


def harmonise_stage(df: DataFrame, rewrite: Callable[[Column], Column] | list[Callable[[Column], Column]], persona: str, policy: dict[str, tuple[str, ...]] | None = None, order: str = "pos", min_prose: int = 60) -> DataFrame:
    """Rewrites the prose of eligible messages around their protected spans; a bent placeholder drops the record with ``span_violation``.

    ``rewrite`` maps a column of masked texts to rewritten ones; of several (rising temperatures, say) the first that keeps all placeholders counts. Texts with
    under 60 characters of prose stay as they are.
    """
    attempts = rewrite if isinstance(rewrite, list) else [rewrite]
    allowed = HARMONISE if policy is None else policy
    may = F.lit(False)
    for lane, roles in allowed.items():
        may = may | ((F.col("provenance.lane") == lane) & F.col("m.role").isin(*roles))
    eligible = df.where(alive(df)).where(is_persona_voiced(F.col("provenance.lane"), F.col("messages"), persona))
    m = eligible.select(order, "provenance", F.posexplode("messages").alias("i", "m")).where(may)
    fields = F.explode(F.array(F.struct(F.lit("content").alias("field"), F.col("m.content").alias("text")), F.struct(F.lit("thought").alias("field"), F.col("m.thought").alias("text"))))
    t = m.select(order, "i", fields.alias("f")).select(order, "i", "f.field", "f.text").where("coalesce(text, '') <> ''").withColumn("k", mask_of("text"))
    thin = prose_length(F.col("k.masked")) < min_prose
    t = t.withColumn("new", F.when(thin, F.col("text")).otherwise(F.coalesce(*[restore_of(a(F.col("k.masked")), F.col("k.originals")) for a in attempts])))
    g = t.groupBy(order).agg(F.bool_or(F.col("new").isNull()).alias("_bent"), F.map_from_entries(F.collect_list(F.when(F.col("new") != F.col("text"), F.struct(F.concat_ws(":", F.col("i").cast("string"), F.col("field")), F.col("new"))))).alias("_new"))
    j = df.join(g, order, "left")
    key = lambda i, f: F.concat(i.cast("string"), F.lit(f":{f}"))
    changed = F.transform("messages", lambda x, i: x.withField("content", F.coalesce(F.try_element_at(F.col("_new"), key(i, "content")), x["content"])).withField("thought", F.coalesce(F.try_element_at(F.col("_new"), key(i, "thought")), x["thought"])))
    j = j.withColumn("messages", F.when(F.col("_new").isNotNull() & ~F.coalesce("_bent", F.lit(False)), changed).otherwise(F.col("messages")))
    j = j.withColumn("harmonized", F.coalesce(~F.col("_bent"), F.lit(False)))
    return j.withColumn("drop_reason", F.coalesce("drop_reason", F.when(F.col("_bent"), F.lit("span_violation")))).drop("_bent", "_new")


def run_gates(records: DataFrame, verdicts: DataFrame, order: str, rewrite: Callable[[Column], Column] | None = None, persona: str = "", threshold: float = 0.8, name_patterns: list[str] = (), preserve: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Kept and rejected rows after all stages; with ``name_patterns`` names in personal lanes become pseudonyms before duplicates are sought."""
    df = cut(scrub_stage(judge_stage(verify_stage(records), verdicts)))
    if name_patterns:
        df = pseudonym_stage(df, order, list(name_patterns), preserve)
    df = cut(dedupe_stage(df, order, threshold))
    if rewrite is not None:
        df = harmonise_stage(df, rewrite, persona, order=order)
    return df.where(alive(df)).drop("drop_reason"), df.where(~alive(df))


def external_reason(conversations: Column, strict_minor: bool = False, drop_named: bool = False) -> Column:
    """The first reason to drop a row of a third-party corpus (``array<struct<from, value>>``); null keeps it."""
    text = F.array_join(F.transform(conversations, lambda t: F.coalesce(t["value"], F.lit(""))), "\n")
    # Signals of minors, of school settings, of leaked instructions, of a complete reasoning block.
    minor = r"(?i)\b(?:[1-9]|1[0-7])[- ]years?[- ]old\b|\b(?:one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen)[- ]years?[- ]old\b|\bage:\s*(?:[1-9]|1[0-7])\b|\b(?:lolicon|loli|shota|underage|preteen|jailbait)\b|\bchild's body\b"
    school = r"(?i)\b(?:middle|elementary|primary|high) school\b"
    named = r"(?i)\bderivative of claude\b|\bclaud3\b"
    leaked = r"(?i)\bi have read the <rules>"
    think = r"(?s)^\s*<think>.*?</think>"
    schema = r"(?s)^\s*<think>(?=.*?SCENE:)(?=.*?CHARACTERS:)(?=.*?PLAN:).*?</think>"
    said = F.filter(conversations, lambda t: t["from"].isin("gpt", "assistant"))
    talk = F.filter(conversations, lambda t: t["from"] != "system")
    roles = F.transform(talk, lambda t: t["from"].isin("gpt", "assistant"))
    n = F.greatest(F.size(roles) - 1, F.lit(0))
    twice = F.exists(F.zip_with(F.slice(roles, 1, n), F.slice(roles, 2, n), lambda a, b: a & b), lambda x: x)
    value = lambda t: F.coalesce(t["value"], F.lit(""))
    reason = F.when(text.rlike(minor), "minor_coded")
    if strict_minor:
        reason = reason.when(text.rlike(school), "minor_school_setting")
    if drop_named:
        reason = reason.when(text.rlike(named), "claude_derived")
    return (
        reason.when(text.rlike(leaked), "leaked_meta")
        .when(~F.forall(said, lambda t: value(t).rlike(think)), "think_incomplete")
        .when(twice, "consecutive_assistant_turns")
        .when(~F.forall(said, lambda t: value(t).rlike(schema)), "think_offschema")
        .when(F.exists(talk, lambda t: F.trim(F.regexp_replace(value(t), think, "")) == ""), "empty_turn")
    )

