"""Model calls as batch functions over request tables.

A model is any function from a list of requests to a list of replies. Requests are keyed, looked up in the response table, and
only misses are sent, in Arrow batches on as many partitions as the provider allows; an exception becomes an error
value of its row. Everything is testable with a scripted function.
"""

from __future__ import annotations

import json
import random
import re
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.hashing import hash_int, request_key

Batch = Callable[[list[dict]], list[str]]
RETRYABLE = (408, 429, 500, 502, 503, 504)


class ModelError(RuntimeError):
    """A failed call; ``status`` decides whether it is tried again."""

    def __init__(self, message: str, status: int = 0, retry_after: float | None = None):
        super().__init__(message)
        self.status, self.retry_after = status, retry_after


def scripted(replies: dict[str, str] | Callable[[dict], str]) -> Batch:
    """A deterministic model: replies by prompt, or by a function of the request."""
    return lambda batch: [replies(r) if callable(replies) else replies[r["prompt"]] for r in batch]


def with_retry(call: Batch, tries: int = 5, cap: float = 30.0, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random) -> Batch:
    """Tries again on overload and server errors, after the time the server names or 2^n seconds (at most 30), and up to a second more, so that tasks do not return at once."""

    def run(batch: list[dict]) -> list[str]:
        for n in range(tries):
            try:
                return call(batch)
            except ModelError as e:
                if e.status not in RETRYABLE or n == tries - 1:
                    raise
                sleep(min(cap, e.retry_after if e.retry_after is not None else 2.0**n) + jitter())
        raise AssertionError

    return run


def call_json(call: Batch, request: dict, check: Callable[[object], object], repairs: int = 2) -> object:
    """A reply as checked JSON; up to two times the model is shown its error and asked again."""
    for n in range(repairs + 1):
        text = call([request])[0]
        try:
            return check(json.loads(re.sub(r"(?m)^```[a-z]*\s*$", "", text).strip()))
        except (ValueError, KeyError, TypeError) as e:
            if n == repairs:
                raise ModelError(f"no valid JSON: {e}") from e
            request = request | {"prompt": f"{request['prompt']}\n\nYour reply was invalid ({e}). Reply with valid JSON only."}
    raise AssertionError


def keyed_requests(requests: DataFrame) -> DataFrame:
    """Adds ``request_key`` to requests (``model, system, prompt, options``)."""
    return requests.withColumn("request_key", request_key(F.col("model"), F.col("system"), F.col("prompt"), F.col("options")))


def complete(requests: DataFrame, cache: DataFrame, call: Batch, width: int = 8, batch_rows: int = 64) -> DataFrame:
    """``request_key, text, error`` of each distinct request: from the cache, or from the model on ``width`` partitions.

    Misses are sent once each however often they are asked. A failing batch is sent row by row, so that one failure is one error value.
    """
    keyed = keyed_requests(requests)
    hits = keyed.select("request_key").distinct().join(cache.select("request_key", "text"), "request_key").withColumn("error", F.lit(None).cast("string"))
    misses = keyed.dropDuplicates(["request_key"]).join(cache.select("request_key"), "request_key", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, batch_rows):
                rows = whole.slice(at, batch_rows).to_pylist()
                try:
                    got: list[tuple[str | None, str | None]] = [(t, None) for t in call(rows)]
                except Exception:  # noqa: BLE001  any failure becomes a value
                    got = []
                    for r in rows:
                        try:
                            got.append((call([r])[0], None))
                        except Exception as e:  # noqa: BLE001
                            got.append((None, f"{type(e).__name__}: {e}"))
                yield pa.RecordBatch.from_arrays([pa.array([r["request_key"] for r in rows], pa.string()), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], names=["request_key", "text", "error"])

    sent = misses.repartition(width).select("request_key", "model", "system", "prompt", "options").mapInArrow(run, "request_key string, text string, error string")
    return hits.unionByName(sent)


def routes(roster: DataFrame, lane: str, role: str) -> DataFrame:
    """Routes of a role: the role itself, then its variants ``role_*`` in declared order."""
    return roster.where((F.col("lane") == lane) & ((F.col("role") == role) | F.col("role").startswith(f"{role}_"))).orderBy("pos")


def rotate(key: Column, pool: Column, exclude_provider: Column) -> Column:
    """A route of a pool (``array<struct<id, provider>>``) by hash, of another provider if there is one."""
    others = F.filter(pool, lambda r: r["provider"] != exclude_provider)
    among = F.when(F.size(others) > 0, others).otherwise(pool)
    return F.get(among, (hash_int(F.concat(F.lit("rotate:"), key), 8) % F.size(among)).cast("int"))["id"]


def judge_for(key: Column, judges: Column, generator_provider: Column) -> Column:
    """A judge of another provider than the generator's by hash of the key; the first for an empty key; null if there is none."""
    others = F.filter(judges, lambda r: F.coalesce(r["provider"] != generator_provider, F.lit(True)))
    at = F.when(F.coalesce(key, F.lit("")) == "", F.lit(0)).otherwise((hash_int(key, 8) % F.greatest(F.size(others), F.lit(1))).cast("int"))
    return F.get(others, at)["id"]


def generator_id(teachers: Column) -> Column:
    """The teacher that wrote the text: by role character, dialogue, assistant, else the first recorded."""
    named = F.coalesce(*[F.try_element_at(teachers, F.lit(r)) for r in ("character", "dialogue", "assistant")])
    return F.coalesce(named, F.get(F.map_values(teachers), 0))


def self_play(seed: dict, character: Batch, user: Batch, min_turns: int = 8, max_turns: int = 24, budget: int = 60_000, loop: float = 0.6) -> tuple[list[dict], str]:
    """One conversation between a character and a simulated user, and why it ended: max_turns, user_ended, degenerate, budget or empty_turn."""
    from corpusloom.plans.selfplay_text import overlap

    messages: list[dict] = []
    used = 0
    while len(messages) < max_turns:
        by_user = len(messages) % 2 == 0
        history = [m if not by_user else m | {"role": "assistant" if m["role"] == "user" else "user"} for m in messages]
        text = (user if by_user else character)([seed | {"prompt": json.dumps(history, ensure_ascii=False)}])[0].strip()
        if by_user and text == "[END]":
            if len(messages) >= min_turns:
                return messages, "user_ended"
            text = "…"
        if not text:
            return messages, "empty_turn"
        messages.append({"role": "user" if by_user else "assistant", "content": text})
        used += len(text)
        said = [m["content"] for m in messages if m["role"] == "assistant"]
        if len(said) >= 2 and overlap(said[-1], said[-2]) >= loop:
            return messages[:-2], "degenerate"
        if used > budget:
            return messages, "budget"
    return messages, "max_turns"


def self_play_all(seeds: DataFrame, character: Batch, user: Batch, width: int = 8, **limits: float) -> DataFrame:
    """``seed_id, messages, stop`` of a conversation for each seed (``seed_id, card``), on ``width`` partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(s["seed_id"], *self_play(s, character, user, **limits)) for s in b.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())]))), pa.array([o[2] for o in out], pa.string())], names=["seed_id", "messages", "stop"]
            )

    return seeds.select("seed_id", "card").repartition(width).mapInArrow(run, "seed_id string, messages array<struct<role string, content string>>, stop string")
