"""New task instances proposed by a model: surfaces come from the model, ground truth is always recomputed."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.spans import surface_rows_of, tagged_count
from corpusloom.functions.text import slug_ascii, strip
from corpusloom.operators.trajectories import new_instances
from corpusloom.plans.models import Batch, complete
from corpusloom.session import cut

Deriver = Callable[[DataFrame], DataFrame]


def derive_tagged(candidates: DataFrame) -> DataFrame:
    """Instances of the tagged-count task from surfaces (``item`` JSON with name, entries_block, tag).

    The true count is counted here; a list of fewer than three items, or whose tag is on none or all of them, gives none.
    """
    j = candidates.withColumn("j", F.from_json("item", "name string, entries_block string, tag string"))
    s = j.select(strip(F.coalesce("j.entries_block", F.lit(""))).alias("block"), strip(F.coalesce("j.tag", F.lit(""))).alias("tag"), strip(F.coalesce("j.name", F.lit(""))).alias("name"))
    s = s.where("block <> '' and tag <> '' and name <> ''").withColumn("n", tagged_count(F.col("block"), F.col("tag"))).where("n is not null")
    slug = slug_ascii(F.col("name"))
    params = {"entries_block": F.concat("block", F.lit("\n")), "tag": F.col("tag"), "true_count": F.col("n").cast("string"), "destination": F.concat(F.lit("lists/"), slug, F.lit("-log.txt")), "count_destination": F.concat(F.lit("lists/"), slug, F.lit("-count.txt"))}
    out = s.select(F.create_map(*[x for k in sorted(params) for x in (F.lit(k), params[k])]).alias("params"))
    return out.withColumn("identity", F.to_json(F.array_sort(F.map_entries("params")))).dropDuplicates(["identity"])


#: Derivers by template id; a template is registered by adding its own.
DERIVERS: dict[str, Deriver] = {"count.tagged_count": derive_tagged}


def evolve_prompt(description: str, fields: list[str], n: int, examples: list[dict]) -> str:
    """What a model is asked for: new surfaces of a task, varied and never with their answer."""
    rules = ["vary domains, tone, length and size, among themselves and against the examples", "never state or hint at the answer; it is recomputed", "some items carry the tag and some do not"]
    shape = f"Reply with one JSON array of {n} objects with the fields {', '.join(fields)}."
    return "\n".join([f"Task: {description.strip()}", "Known examples:", json.dumps(examples, ensure_ascii=False), "Rules:", *[f"- {r}" for r in rules], shape])


def evolve(template: str, known: DataFrame, cache: DataFrame, call: Batch, prompt: Callable[[int], str], wanted: int, rounds: int = 3, model: str = "") -> DataFrame:
    """At least ``wanted`` new instances if the model gives them within three rounds: derived, and known neither before nor from an earlier round."""
    derive = DERIVERS[template]
    found: list[DataFrame] = []
    for n in range(rounds):
        ask = known.sparkSession.createDataFrame([(model, None, prompt(n), "{}")], "model string, system string, prompt string, options string")
        items = complete(ask, cache, call, 1).where("text is not null").select(F.explode(surface_rows_of("text")).alias("item"))
        before = reduce(DataFrame.unionByName, [x.select("identity") for x in found], known.select("identity"))
        found.append(cut(new_instances(derive(items), before, "identity")))
        if sum(x.count() for x in found) >= wanted:
            break
    return reduce(DataFrame.unionByName, found)
