"""Books to scenes: profiles, scenes and dialogues by a model, each a stage table that is reused while its fingerprint holds."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.hashing import canonical_json, prompt_set_hash
from corpusloom.plans.models import Batch, ModelError, call_json
from corpusloom.sources import books
from corpusloom.sources.jsonl import stage


def ask_rows(rows: DataFrame, keys: list[str], prompt: str, call: Batch, check: Callable[[object], list[dict]], width: int = 8) -> DataFrame:
    """``keys, pos, item`` (JSON) of the items that the model gives for each row's ``prompt`` column; a row without valid JSON gives one error row."""
    head = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, text in enumerate(b.column(prompt).to_pylist()):
                try:
                    out += [(i, n, json.dumps(x, ensure_ascii=False), None) for n, x in enumerate(call_json(call, {"prompt": text}, check))]
                except ModelError as e:
                    out.append((i, -1, None, str(e)))
            at = pa.array([o[0] for o in out], pa.int64())
            cols = [b.column(k).take(at) for k in keys] + [pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.string()), pa.array([o[3] for o in out], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keys, "pos", "item", "error"])

    return rows.select(*keys, prompt).repartition(width).mapInArrow(run, f"{head}, pos int, item string, error string")


def _list_of(field: str, needs: tuple[str, ...]) -> Callable[[object], list[dict]]:
    def check(v: object) -> list[dict]:
        return [x for x in v[field] if all(n in x for n in needs)]

    return check


def _fingerprint(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x00", *(F.coalesce(p, F.lit("")) for p in parts)), 256)


def extract_scenes(spark: SparkSession, works: DataFrame, call: Batch, root: str, prompts: dict[str, str], sample: int = 60_000, target: int = 16_000, model: str = "") -> dict[str, DataFrame]:
    """Stages ``profiles``, ``scenes`` and ``dialogues`` of works (``work_id, text``), and the ``usable`` scene keys.

    A stage remembers each work by a fingerprint of all that decides its rows: the text, the model, the prompts, the settings, and what the stage before
    gave. Only works that are new or changed are asked. A work whose reply stays invalid falls out of its stage with an error row; all others go on.
    """
    settings = F.lit(canonical_json({"prompts": prompt_set_hash(prompts), "sample": sample, "target": target, "model": model}))
    works = works.select("work_id", "text", _fingerprint(settings, F.col("text")).alias("fingerprint"))

    def profiles(missing: DataFrame) -> DataFrame:
        asked = missing.select("work_id", F.concat(F.lit(prompts["profiles"] + "\n\n"), F.substring("text", 1, sample)).alias("prompt"))
        rows = ask_rows(asked, ["work_id"], "prompt", call, _list_of("characters", ("name",)))
        p = rows.withColumn("j", F.from_json("item", "name string, aliases array<string>, description string, personality string"))
        return p.select("work_id", "pos", "j.name", F.coalesce("j.aliases", F.array().cast("array<string>")).alias("aliases"), F.coalesce("j.description", F.lit("")).alias("description"), F.coalesce("j.personality", F.lit("")).alias("personality"), "error")

    p = stage(spark, f"{root}/profiles", works, "work_id", profiles)
    known = p.where("error is null")
    cast = known.groupBy("work_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "name", "description"))), lambda c: F.concat(F.lit("- "), c["name"], F.lit(": "), c["description"])), "\n").alias("cast"))
    told = works.join(cast, "work_id").withColumn("fingerprint", _fingerprint(F.col("fingerprint"), F.col("cast")))

    def chunks(of: DataFrame) -> DataFrame:
        return of.select("work_id", "cast", F.posexplode(books.chunk_windows(F.col("text"), target)).alias("chunk", "body"))

    def scenes(missing: DataFrame) -> DataFrame:
        asked = chunks(missing).withColumn("prompt", F.concat(F.lit(prompts["scenes"] + "\n\n## Known characters\n"), F.col("cast"), F.lit("\n\n## Text\n"), F.col("body")))
        rows = ask_rows(asked, ["work_id", "chunk"], "prompt", call, _list_of("scenes", ("participants",)))
        s = rows.withColumn("j", F.from_json("item", "setting string, context string, participants array<string>"))
        return s.select("work_id", "chunk", F.concat_ws("/", F.col("chunk").cast("string"), F.col("pos").cast("string")).alias("scene"), "j.setting", "j.context", "j.participants", "error")

    aliases = books.resolved(known)
    usable = books.usable_scenes(stage(spark, f"{root}/scenes", told, "work_id", scenes).where("error is null"), aliases)
    acts = usable.groupBy("work_id").agg(F.array_join(F.sort_array(F.collect_list(F.to_json(F.struct("scene", "setting", "context", "participants")))), "\n").alias("acts"))
    staged = told.join(acts, "work_id").withColumn("fingerprint", _fingerprint(F.col("fingerprint"), F.col("acts")))

    def dialogues(missing: DataFrame) -> DataFrame:
        asked = usable.join(chunks(missing), ["work_id", "chunk"]).withColumn("prompt", F.concat(F.lit(prompts["dialogue"] + "\n\n## Scene\n"), F.coalesce("setting", F.lit("")), F.lit("\nParticipants: "), F.array_join("participants", ", "), F.lit("\n\n## Source text\n"), F.col("body")))
        rows = ask_rows(asked, ["work_id", "chunk", "scene"], "prompt", call, _list_of("turns", ("speaker", "content")))
        t = rows.withColumn("j", F.from_json("item", "speaker string, content string, thought string"))
        return t.select("work_id", "chunk", "scene", "pos", "j.speaker", "j.content", "j.thought", "error")

    d = stage(spark, f"{root}/dialogues", staged, "work_id", dialogues)
    return {"profiles": p, "scenes": usable, "dialogues": d, "usable": books.sound_dialogue(d.where("error is null"), usable, aliases)}
