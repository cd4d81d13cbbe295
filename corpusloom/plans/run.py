"""Run control on the driver: targets, configuration by target, frozen inputs, widths of model calls, render with guards."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.hashing import tree_hash
from corpusloom.operators import dedupe, split
from corpusloom.plans import render
from corpusloom.session import cut


@dataclass(frozen=True)
class RunConfig:
    """Knobs of a run."""

    eval_fraction: float = 0.15
    seed: int = 7
    min_margin: float = 1.0
    dedupe_threshold: float = 0.8
    lanes: tuple[str, ...] = ("a", "b", "c", "d")
    holdout: frozenset[str] = field(default_factory=frozenset)


def target_name(default: str, env: str = "CORPUSLOOM_TARGET") -> str:
    """The build target from the environment, else the default."""
    return os.environ.get(env, default)


def config_file(root: str | Path, kind: str, target: str) -> Path:
    """``<kind>.<target>.yaml`` if it is there, else ``<kind>.yaml``."""
    own = Path(root) / f"{kind}.{target}.yaml"
    return own if own.exists() else Path(root) / f"{kind}.yaml"


def inputs_hash(*roots: str | Path) -> str:
    """One hash over the trees that decide a run."""
    return "-".join(tree_hash(r)[:16] for r in roots)


def pool_width(routes: list[dict], caps: dict[str, int], default: int = 4) -> int:
    """Partitions for model calls: the smallest cap of the providers in the pool."""
    return min((caps.get(r["provider"], default) for r in routes), default=default)


def render_run(kept: DataFrame, rejected: DataFrame, prior: DataFrame | None, order: str, cfg: RunConfig, key: Column | None = None) -> dict[str, DataFrame]:
    """The artifacts of a run: lane bound, prior corpus first in deduplication, split, guards before anything is written.

    ``order`` must be unique in each of the tables. Raises ``HoldoutViolation`` with nothing written.
    """
    inside = F.col("provenance.lane").isin(*cfg.lanes)
    pool = kept.where(inside)
    both = dedupe.corpus_union((prior if prior is not None else pool.limit(0)).where(inside), pool, order)
    texts = both.select("order_key", dedupe.conversational_text(F.col("messages")).alias("t"))
    found = dedupe.duplicates(texts, "order_key", "order_key", "t", cfg.dedupe_threshold)
    once = dedupe.without(both, found, "order_key")
    split_key = F.coalesce("provenance.sibling_group", "provenance.record_id") if key is None else key
    marked = once.withColumn("_key", split_key).withColumn("_holdout", F.coalesce("provenance.holdout", F.lit(False))).withColumn("_family", F.col("provenance.family"))
    # the guards and every artifact read it
    parts = cut(split.split_train_eval(marked, "_key", "_holdout", cfg.eval_fraction, cfg.seed))
    split.guard(parts, "_family", "_holdout")
    return render.render_all(parts, rejected.where(inside), F.col("is_eval"), cfg.min_margin)


def render_counts(artifacts: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of each artifact."""
    return {k: v.count() for k, v in artifacts.items()}
