"""Segments, scenes and works as records and book entries; small lookups around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.hashing import short_hash
from corpusloom.functions.text import slugify, strip

_CALLS = "array<struct<id:string,name:string,arguments:array<struct<name:string,rendered:string,raw_json:string>>>>"


def json_text(c: Column) -> Column:
    """A string as JSON with default escapes for quotes, backslashes and control characters."""
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


def source_detail(pairs: dict[str, Column]) -> Column:
    """A JSON object of strings and numbers with default separators, keys sorted."""
    parts = [F.concat(F.lit(f'"{k}": '), pairs[k]) for k in sorted(pairs)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def record_id(lane: str, run_id: str, kind: str, detail: Column, salt: Column | None = None) -> Column:
    """``<lane>-`` and 16 hex digits over the sorted payload of run, source and salt."""
    payload = F.concat(F.lit(f'{{"lane": "{lane}", "run_id": "{run_id}", "salt": "'), salt if salt is not None else F.lit(""), F.lit(f'", "source": {{"detail": '), detail, F.lit(f', "kind": "{kind}"}}}}'))
    return F.concat(F.lit(f"{lane}-"), short_hash(payload, 16))


def provenance(lane: str, run_id: str, family: Column, holdout: Column, kind: str, detail: Column, template: Column | None = None, group: Column | None = None, teachers: Column | None = None, salt: Column | None = None) -> Column:
    """Provenance of a fresh record."""
    null = F.lit(None).cast("string")
    return F.struct(
        record_id(lane, run_id, kind, detail, salt).alias("record_id"),
        F.lit(lane).alias("lane"),
        F.lit(run_id).alias("run_id"),
        family.alias("family"),
        (null if template is None else template).alias("template_id"),
        holdout.alias("holdout"),
        (F.lit(None).cast("map<string,string>") if teachers is None else teachers).alias("teachers"),
        (null if group is None else group).alias("sibling_group"),
        null.alias("hermes_commit"),
        null.alias("prompt_set_hash"),
        F.struct(F.lit(kind).alias("kind"), detail.alias("detail_json")).alias("source"),
    )


def fresh_gate_state() -> Column:
    """A gate state that no stage has touched."""
    null = F.lit(None)
    return F.struct(
        null.cast("boolean").alias("verified"),
        null.cast("string").alias("verifier_id"),
        null.cast("string").alias("verifier_details_json"),
        null.cast("struct<axes:map<string,double>,overall:double,passed:boolean,judge_model:string>").alias("judge"),
        F.array().cast("array<string>").alias("scrub_flags"),
        null.cast("string").alias("deduped_against"),
        F.lit(False).alias("harmonized"),
        F.lit(False).alias("dropped"),
        null.cast("string").alias("drop_reason"),
    )


def _message(role: Column, speaker: Column, content: Column, thought: Column, ts: Column) -> Column:
    return F.struct(role.alias("role"), speaker.alias("speaker"), content.alias("content"), thought.alias("thought"), F.array().cast(_CALLS).alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"), ts.alias("ts"))


def stream_records(segments: DataFrame, run_id: str) -> DataFrame:
    """Chat segments (``source, thread, segment, family, holdout, messages``) as records of lane d."""
    null = F.lit(None).cast("string")
    detail = source_detail({"source": json_text(F.col("source")), "conversation_id": json_text(F.col("thread")), "segment": F.col("segment").cast("string")})
    messages = F.transform("messages", lambda m: _message(m["role"], m["speaker"], m["content"], null, m["ts"]))
    return segments.select(F.lit(3).alias("schema_version"), F.lit("").alias("system"), null.alias("tools_schema_json"), messages.alias("messages"), provenance("d", run_id, F.col("family"), F.col("holdout"), "personal_stream", detail).alias("provenance"), fresh_gate_state().alias("gate_state"))


def scene_records(scenes: DataFrame, run_id: str, teachers: dict[str, str]) -> DataFrame:
    """Scenes (``work_id, chunk, scene, holdout, system, turns array<struct<speaker, content, thought>>``) as records of lane b, every turn an assistant's."""
    null = F.lit(None).cast("string")
    detail = source_detail({"work_id": json_text(F.col("work_id")), "chunk_idx": F.col("chunk").cast("string"), "scene_idx": F.col("scene").cast("string")})
    messages = F.transform("turns", lambda t: _message(F.lit("assistant"), t["speaker"], t["content"], t["thought"], null))
    who = F.create_map(*[F.lit(x) for kv in teachers.items() for x in kv]) if teachers else None
    return scenes.select(F.lit(3).alias("schema_version"), "system", null.alias("tools_schema_json"), messages.alias("messages"), provenance("b", run_id, F.col("work_id"), F.col("holdout"), "book_scene", detail, teachers=who).alias("provenance"), fresh_gate_state().alias("gate_state"))


def task_records(ingested: DataFrame, system: str, run_id: str, teacher: str) -> DataFrame:
    """Ingested trajectories without error as records of lane a; the id is salted with the prompt index."""
    salt = F.col("prompt_index").cast("string")
    detail = source_detail({"template_id": json_text(F.col("template_id")), "prompt_index": salt})
    p = provenance("a", run_id, F.col("family"), F.col("holdout"), "task_instance", detail, F.col("template_id"), F.col("instance_key"), F.create_map(F.lit("assistant"), F.lit(teacher)), salt)
    return ingested.where("error is null").select(F.lit(3).alias("schema_version"), F.lit(system).alias("system"), "tools_schema_json", "messages", p.alias("provenance"), fresh_gate_state().alias("gate_state"))


def book_entries(books: DataFrame, source: str) -> DataFrame:
    """``work_id, path, author, title`` of books (``ident, path, author, title``)."""
    return books.select(slugify(F.concat(F.lit(f"{source}-"), F.col("ident").cast("string")), 80).alias("work_id"), "path", strip(F.coalesce("author", F.lit(""))).alias("author"), F.coalesce(F.nullif(strip(F.col("title")), F.lit("")), F.lit("untitled")).alias("title"))


def chosen_books(scored: DataFrame, existing: DataFrame, least: float) -> DataFrame:
    """Scored books (``work_id, title, score``) over a threshold that are known neither by id nor by title."""
    fresh = scored.join(existing.select("work_id"), "work_id", "left_anti")
    fresh = fresh.withColumn("_t", F.lower("title")).join(existing.select(F.lower("title").alias("_t")), "_t", "left_anti").drop("_t")
    return fresh.where(F.col("score") >= least)


def latest(rows: DataFrame, order: str, where: Column | None = None) -> DataFrame:
    """The row with the largest ``order``, as a map-side combined maximum."""
    r = rows if where is None else rows.where(where)
    return r.agg(F.max_by(F.struct(*[F.col(c) for c in rows.columns]), order).alias("r")).where("r is not null").select("r.*")


def out_of_band(rates: DataFrame, bands: DataFrame, lanes: list[str]) -> DataFrame:
    """Lanes whose measured rate (``lane, rate``) is missing or outside its band (``lane, low, high``), or that have no band."""
    wanted = rates.sparkSession.createDataFrame([(x,) for x in lanes], "lane string")
    j = wanted.join(bands, "lane", "left").join(rates, "lane", "left")
    return j.where(F.col("low").isNull() | F.col("rate").isNull() | ~F.col("rate").between(F.col("low"), F.col("high")))
