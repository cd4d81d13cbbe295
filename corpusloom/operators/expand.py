"""Task expansion, rollout order, job grids and seeds from notes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.hashing import short_hash
from corpusloom.functions.text import shorten
from corpusloom.operators.order import numbered, stride_all
from corpusloom.operators.split import hash_holdout, hash_pick


def instance_key(template: Column, names: Column, values: Column) -> Column:
    """12 hex digits over the canonical form of template and parameters (names sorted)."""
    quote = lambda c: F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    pairs = F.array_join(F.zip_with(names, values, lambda k, v: F.concat(quote(k), F.lit(":"), quote(v))), ",")
    return short_hash(F.concat(F.lit('{"params":{'), pairs, F.lit('},"template":'), quote(template), F.lit("}")), 12)


def expand_tasks(tasks: DataFrame, persona: str = "") -> DataFrame:
    """Instances of task templates: the product of the parameter lists, or their k-th values together; the prompt is filled in.

    Both modes number the combinations 0..n-1 and read each parameter's value by arithmetic, so nothing is cross-joined.
    """
    sizes = F.transform("params", lambda p: F.size(p["options"]))
    product = F.aggregate(sizes, F.lit(1), lambda a, n: a * n)
    total = F.when(F.size("params") == 0, 1).when(F.col("mode") == "zip", F.array_min(sizes)).otherwise(product)
    t = tasks.withColumn("_total", total).withColumn("combo", F.explode(F.sequence(F.lit(0), F.col("_total") - 1)))
    # the last sorted key varies fastest
    after = lambda i: F.aggregate(F.slice(sizes, i + 2, F.size(sizes)), F.lit(1), lambda a, n: a * n)
    index = lambda p, i: F.when(F.col("mode") == "zip", F.col("combo")).otherwise(F.floor(F.col("combo") / after(i)).cast("int") % F.size(p["options"]))
    values = F.transform("params", lambda p, i: F.get(p["options"], index(p, i)))
    t = t.withColumn("values", values).withColumn("names", F.transform("params", lambda p: p["name"]))
    filled = F.aggregate(F.arrays_zip("names", "values"), F.replace("prompt", F.lit("{persona}"), F.lit(persona)), lambda acc, kv: F.replace(acc, F.concat(F.lit("{"), kv["names"], F.lit("}")), kv["values"]))
    return t.select("pos", "combo", "template_id", "family", "holdout", F.map_from_arrays("names", "values").alias("params"), filled.alias("prompt"), "n_rollouts", "verifier", instance_key(F.col("template_id"), F.col("names"), F.col("values")).alias("instance_key"))


def rollout_order(instances: DataFrame, order: list[str], rollouts: str = "n_rollouts") -> DataFrame:
    """One row for each rollout, round-robin over the instances: adds ``round`` and ``prompt_index``.

    The index is the position in order of round and instance over range partitions, so no round is gathered in one task.
    """
    r = instances.where(F.col(rollouts) > 0).withColumn("round", F.explode(F.sequence(F.lit(0), F.col(rollouts) - 1)))
    return numbered(r, ["round", *order], "prompt_index")


def batch_inputs(rollouts: DataFrame) -> DataFrame:
    """``prompt_index, line``: one JSON line with the prompt of each rollout, by which an external runner's output is numbered."""
    quoted = F.regexp_extract(F.to_json(F.struct(F.coalesce("prompt", F.lit("")).alias("p"))), r'(?s)^\{"p":(.*)\}$', 1)
    return rollouts.select("prompt_index", F.concat(F.lit('{"prompt": '), quoted, F.lit("}")).alias("line"))


def few_shots(tasks: DataFrame, fields: list[str], k: int = 3) -> DataFrame:
    """``template_id, n, example``: the first ``k`` instances of each template by the k-th values of its parameters, as maps of the given fields."""
    mine = F.filter("params", lambda p: p["name"].isin(*fields))
    some = F.least(F.lit(k), F.coalesce(F.array_min(F.transform(mine, lambda p: F.size(p["options"]))), F.lit(0)))
    at = F.when(some > 0, F.sequence(F.lit(0), some - 1)).otherwise(F.array().cast("array<int>"))
    examples = F.transform(at, lambda i: F.map_from_arrays(F.transform(mine, lambda p: p["name"]), F.transform(mine, lambda p: F.get(p["options"], i))))
    return tasks.select("template_id", F.posexplode(examples).alias("n", "example"))


def job_grid(seeds: DataFrame, personas: DataFrame, repeats: int) -> DataFrame:
    """Every seed with its personas and repeats; ``personas`` must be a small table (``seed_id`` null = for all)."""
    allowed = F.col("user_sim_personas")
    names = personas.agg(F.sort_array(F.collect_set("persona_id")).alias("_all"))
    s = seeds.join(F.broadcast(names)).withColumn("persona_id", F.explode(F.when(F.coalesce(F.size(allowed), F.lit(0)) > 0, allowed).otherwise(F.col("_all"))))
    return s.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).drop("_all")


def hash_sample_personas(seed_id: Column, personas: Column, k: int) -> Column:
    """``k`` of an array of personas with the smallest hashes for a seed; all if ``k`` <= 0 or more than there are."""
    if k <= 0:
        return personas
    ranked = F.array_sort(F.transform(personas, lambda p: F.struct(F.sha2(F.concat(seed_id, F.lit(":"), p), 256).alias("h"), p.alias("p"))))
    return F.transform(F.slice(ranked, 1, k), lambda x: x["p"])


def note_seeds(rows: DataFrame, kind: str, scenario: Column, grounding: Column, speaker: str, cap: int, order: list[str]) -> DataFrame:
    """Seeds of one kind from note rows (``family_key``): id, hashed holdout, scenario, grounding; ``cap`` of them by stride in order (all for 0)."""
    s = rows.select(
        F.concat_ws("-", F.lit("companion"), F.lit(kind), F.col("family_key"), *([F.col("i").cast("string")] if "i" in rows.columns else [])).alias("seed_id"),
        F.concat(F.lit("companion/"), F.col("family_key")).alias("family"),
        hash_holdout(F.col("family_key")).alias("holdout"),
        F.lit(speaker).alias("character_name"),
        scenario.alias("scenario"),
        grounding.alias("grounding"),
        *order,
    )
    return stride_all(s, order, cap).drop("pos", *order)


def event_seeds(dated: DataFrame, speaker: str, cap: int) -> DataFrame:
    """A seed for each dated entry (``rel, family_key, year, summary, i, when, what``)."""
    what = shorten(F.col("what"), 300)
    return note_seeds(dated, "event", F.concat(F.lit("The user brings up something from "), F.col("when"), F.lit(" ("), F.col("year"), F.lit("): "), what), F.concat(F.lit("## What you remember about "), F.col("year"), F.lit("\n"), F.col("summary"), F.lit("\n\n## This particular thing\n"), F.col("when"), F.lit(": "), F.col("what")), speaker, cap, ["rel", "i"])


def person_seeds(people: DataFrame, speaker: str, cap: int) -> DataFrame:
    """A seed for each note about a person (``rel, family_key, title, summary``)."""
    return note_seeds(people, "person", F.concat(F.lit("The user talks about "), F.col("title"), F.lit(".")), F.concat(F.lit("## What you know about "), F.col("title"), F.lit("\n"), F.col("summary")), speaker, cap, ["rel"])


def topic_seeds(bullet_rows: DataFrame, speaker: str, cap: int) -> DataFrame:
    """A seed for each bullet (``rel, family_key, i, bullet, summary``)."""
    return note_seeds(bullet_rows, "topic", F.concat(F.lit("The user comes back to this: "), shorten(F.col("bullet"), 300)), F.concat(F.col("summary"), F.lit("\n\n"), F.col("bullet")), speaker, cap, ["rel", "i"])


def obsession_seeds(own_notes: DataFrame, speaker: str, cap: int, framings: list[str]) -> DataFrame:
    """A seed for each of the owner's own notes (``rel, family_key, title, summary``), with one of several framings by hash of its id."""
    which = F.get(F.array(*[F.lit(f) for f in framings]), hash_pick("variant:", F.concat(F.lit("companion-obsession-"), F.col("family_key")), len(framings)).cast("int"))
    return note_seeds(own_notes, "obsession", F.concat(F.lit("The user is full of "), F.col("title"), F.lit(". "), which), F.col("summary"), speaker, cap, ["rel"])


def interest_seeds(communities: DataFrame, speaker: str, cap: int) -> DataFrame:
    """A seed for each community (``community, n, texts``), the most active first."""
    rows = communities.select(F.concat(F.lit("reddit-"), short_hash(F.lower("community"), 8)).alias("family_key"), (-F.col("n")).alias("rank"), "first_seen", "community", "texts")
    return note_seeds(rows, "interest", F.concat(F.lit("The user explains something from "), F.col("community"), F.lit(" unprompted.")), F.array_join("texts", "\n\n"), speaker, cap, ["rank", "first_seen"])


def seeds_of_all_kinds(kinds: list[DataFrame]) -> DataFrame:
    """Seeds of several kinds, each already capped."""
    return reduce(DataFrame.unionByName, kinds)


def scene_seeds(scenes: DataFrame, per_work: int, order: list[str]) -> DataFrame:
    """The first scenes of each work with at least two speakers."""
    ok = scenes.where("n_speakers >= 2")
    return ok.withColumn("_r", F.row_number().over(Window.partitionBy("work_id").orderBy(*order))).where(F.col("_r") <= per_work).drop("_r")
