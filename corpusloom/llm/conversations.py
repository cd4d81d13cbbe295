"""Conversations rebuilt from message rows (problem 6).

Reply links: inside each channel the candidates of a message are the ``window`` messages before it; a candidate's score adds up closeness in time, a mention
of its sender, the lexical overlap and a turn change, and the likeliest becomes the parent. The links form trees, and a tree is a
conversation: its messages in order of time get the turn numbers, and whether it is whole (both roles, no lost sender or time, a reply at the end)
is asked of each tree. With ``break_below`` weak links are cut, so a channel in which several conversations run at once falls into as many trees;
without it every message finds a parent and a channel is one tree, which is what a channel that is one conversation by its id asks for.

The messages are range-partitioned by channel and time once, so a channel of any size, or with one time stamp for all, spreads over many tasks. Scores are
computed lag by lag in whole arrays. A partition needs the last ``window`` messages before it and how far its first channel has
come, which is all that the driver sees: at most ``window`` short rows a partition.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.deliveries import drop_repeated, keyed_messages, rank_in_group
from corpusloom.session import cut

_NO_WORD = re.compile(r"[^\w]+")
WINDOW = 16
MENTION, CHANGE = 2.0, 0.25
#: A link of a lower score is none where several conversations may run in a channel.
BREAK_BELOW = 0.9


def _tokens(text: Column) -> Column:
    """Hashes of the distinct words of three letters or more."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)[^\w]+"), lambda w: F.length(w) > 2)
    return F.array_distinct(F.transform(words, lambda w: F.hash(w)))


def _overlap(tokens: list[np.ndarray], lag: int) -> np.ndarray:
    """Share of common words of each row and the one ``lag`` before, of the shorter of the two."""
    size = np.array([len(t) for t in tokens], np.int64)
    flat = np.concatenate(tokens).astype(np.int64) & 0xFFFFFFFF if len(tokens) else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(tokens)), size)
    keys = np.sort(row << 32 | flat)
    moved = (row + lag) << 32 | flat
    at = np.minimum(np.searchsorted(keys, moved), max(len(keys) - 1, 0))
    hit = keys[at] == moved if len(keys) else np.zeros(0, bool)
    common = np.bincount((row + lag)[hit], minlength=len(tokens) + lag)[: len(tokens)]
    before = np.concatenate([np.zeros(min(lag, len(size)), np.int64), size[:-lag]])[: len(size)]
    return common / np.maximum(np.minimum(size, before), 1)


class _Stream:
    """The messages of one partition in order, a batch at a time, with the last ones before."""

    def __init__(self, context: dict | None, window: int, half_life_s: int, break_below: float | None):
        self.window, self.half_life, self.least = window, half_life_s * 1e6, break_below
        c = context or {"channel": None, "before": 0, "rows": []}
        self.channel, self.turn = c["channel"], c["before"]
        # (time, sender, words, turn, root, whether the root is still to be found before the partition)
        self.past = [(ts, who, np.array(tok, np.int64), turn, turn, True) for ts, who, tok, turn in c["rows"]]

    def link(self, channels: list, ts: np.ndarray, senders: list, low: list, tokens: list) -> tuple[list, list, list, list, list]:
        """``turn, parent, score, root, whether the root lies before the partition`` of each message."""
        m, n = len(self.past), len(channels)
        new = [c != p for c, p in zip(channels, [self.channel, *channels[:-1]])]
        start, turns, at, turn = np.zeros(m + n, np.int64), [p[3] for p in self.past], 0, self.turn
        for i, fresh in enumerate(new):
            at, turn = (m + i, 1) if fresh else (at, turn + 1)
            start[m + i] = at
            turns.append(turn)
        ts = np.concatenate([np.array([p[0] for p in self.past], np.float64), ts.astype(np.float64)])
        names = [p[1] for p in self.past] + senders
        code = {s: k for k, s in enumerate(dict.fromkeys(names))}
        who = np.array([code[s] for s in names], np.int64)
        # a mention is a sender's name in whole words
        called = {s: f" {name} " if (name := _NO_WORD.sub(" ", s).strip()) else "" for s in code}
        words = [p[2] for p in self.past] + tokens
        mentions = []
        for i, text in enumerate(low, m):
            if text:
                near = dict.fromkeys(names[max(start[i], i - self.window) : i])
                mentions += [(i, code[s]) for s in near if called[s] and called[s] in text]
        best, lag_of = np.full(m + n, -1.0), np.zeros(m + n, np.int64)
        for lag in range(min(self.window, m + n - 1), 0, -1):
            i = np.arange(lag, m + n)
            ok = i - lag >= np.maximum(start[i], 0)
            score = 1.0 / (1.0 + np.maximum(ts[i] - ts[i - lag], 0) / self.half_life) + np.where(who[i] == who[i - lag], 0.0, CHANGE) + _overlap(words, lag)[lag:]
            for k, s in mentions:
                if k >= lag and who[k - lag] == s:
                    score[k - lag] += MENTION
            better = ok & (score >= best[i])
            best[i[better]], lag_of[i[better]] = score[better], lag
        if self.least is not None:
            lag_of[best < self.least] = 0
        root, pending = [p[4] for p in self.past], [p[5] for p in self.past]
        for i in range(m, m + n):
            up = i - int(lag_of[i])
            root.append(turns[i] if up == i else root[up])
            pending.append(False if up == i else pending[up])
        linked = lag_of[m:] > 0
        parent = [turns[i - int(lag_of[i])] if f else None for i, f in enumerate(linked, m)]
        score = [float(best[i]) if f else None for i, f in enumerate(linked, m)]
        keep = range(max(int(start[-1]), m + n - self.window), m + n)
        self.past = [(ts[i], names[i], words[i], turns[i], root[i], pending[i]) for i in keep]
        self.channel, self.turn = channels[-1], turns[-1]
        return turns[m:], parent, score, root[m:], pending[m:]


def _lists(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def reply_links(messages: DataFrame, channel: str = "conversation_id", window: int = WINDOW, half_life_s: int = 900, break_below: float | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """``channel, row_id, ts_us, turn_no, parent_turn, link_score, root_turn`` of messages with ``ts_us, row_id, sender_key, text``; ``carry`` columns pass through.

    ``turn_no`` counts from 1 in the channel. Ties go to the nearest candidate. The first message of a channel, and with ``break_below`` each whose
    best score is lower, has a null parent and is its own root. Rows without time or sender have no place in the order and must be left out before.
    """
    order = [channel, "ts_us", "row_id"]
    rows = messages.select(channel, "ts_us", "row_id", F.coalesce("sender_key", F.lit("")).alias("_who"), F.concat(F.lit(" "), F.regexp_replace(F.lower("text"), r"(?U)[^\w]+", " "), F.lit(" ")).alias("_low"), _tokens(F.col("text")).alias("_tok"), *carry)
    # cut, since another run of the range sampling could draw other borders
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    kind = {f.name: f.dataType.simpleString() for f in placed.schema.fields}

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, n, tail = None, None, 0, None
        for b in batches:
            if not b.num_rows:
                continue
            names = b.column(channel).to_pylist()
            first = names[0] if first is None else first
            same = len(names) - next((k for k in range(len(names) - 1, -1, -1) if names[k] != names[-1]), -1) - 1
            own = b.slice(len(names) - min(same, window), min(same, window)).select(["ts_us", "_who", "_tok"])
            whole = same == len(names) and names[-1] == last
            tail = pa.concat_batches([tail, own]).slice(max(0, tail.num_rows + own.num_rows - window)) if whole else own
            last, n = names[-1], n + same if whole else same
        if tail is not None:
            k = tail.num_rows
            fixed = [pa.array([v] * k, t) for v, t in ((TaskContext.get().partitionId(), pa.int32()), (first, pa.string()), (last, pa.string()), (n, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*fixed, pa.array(range(k), pa.int32()), *tail.columns], names=["part", "first", "last", "n", "i", "ts_us", "_who", "_tok"])

    contexts: dict[int, dict] = {}
    at, seen, tail = None, 0, []
    got = placed.select(F.col(channel).cast("string").alias(channel), "ts_us", "_who", "_tok").mapInArrow(edges, "part int, first string, last string, n bigint, i int, ts_us bigint, _who string, _tok array<int>").collect()
    parts: dict[int, list] = {}
    for r in sorted(got, key=lambda r: (r["part"], r["i"])):
        parts.setdefault(r["part"], []).append(r)
    for p, rs in parts.items():
        if at is not None and rs[0]["first"] == at:
            contexts[p] = {"channel": at, "before": seen, "rows": tail}
        goes_on = at == rs[0]["first"] == rs[0]["last"]
        seen = rs[0]["n"] + (seen if goes_on else 0)
        own = [(r["ts_us"], r["_who"], r["_tok"], seen - len(rs) + 1 + k) for k, r in enumerate(rs)]
        tail = [*(tail if goes_on else []), *own][-window:]
        at = rs[0]["last"]
    known = placed.sparkSession.sparkContext.broadcast(contexts)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(known.value.get(TaskContext.get().partitionId()), window, half_life_s, break_below)
        for b in batches:
            if not b.num_rows:
                continue
            names = [None if c is None else str(c) for c in b.column(channel).to_pylist()]
            got = stream.link(names, b.column("ts_us").to_numpy(zero_copy_only=False), b.column("_who").to_pylist(), b.column("_low").to_pylist(), _lists(b.column("_tok")))
            types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (channel, "row_id", "ts_us", *carry)), *(pa.array(v, t) for v, t in zip(got, types))], names=[channel, "row_id", "ts_us", *carry, "turn_no", "parent_turn", "link_score", "root_turn", "_pending"])

    head = ", ".join(f"`{c}` {kind[c]}" for c in (channel, "row_id", "ts_us", *carry))
    links = placed.mapInArrow(link, f"{head}, turn_no bigint, parent_turn bigint, link_score double, root_turn bigint, _pending boolean")
    if not contexts:
        return links.drop("_pending")
    links = cut(links)
    # roots before a partition: only the last messages before one can be meant, so few rows are looked up, in order
    asked = [(c["channel"], r[3]) for c in contexts.values() for r in c["rows"]]
    ask = F.broadcast(placed.sparkSession.createDataFrame(sorted(set(asked)), "_c string, _t bigint"))
    met = links.withColumn("_c", F.col(channel).cast("string")).withColumn("_t", F.col("turn_no")).join(ask, ["_c", "_t"])
    found = {(r["_c"], r["_t"]): (r["root_turn"], r["_pending"]) for r in met.select("_c", "_t", "root_turn", "_pending").collect()}
    resolved = {}
    for c, t in sorted(found):
        r, pending = found[c, t]
        resolved[c, t] = resolved[c, r] if pending else r
    roots = placed.sparkSession.createDataFrame([(c, t, r, True) for (c, t), r in resolved.items()], "_c string, _t bigint, _r bigint, _pending boolean")
    links = links.withColumn("_c", F.col(channel).cast("string")).withColumn("_t", F.col("root_turn")).join(F.broadcast(roots), ["_c", "_t", "_pending"], "left")
    return links.withColumn("root_turn", F.coalesce("_r", "root_turn")).drop("_c", "_t", "_r", "_pending")


def rebuilt_conversations(chat: DataFrame, sources: DataFrame, channel: str = "conversation_id", window: int = WINDOW, break_below: float | None = None) -> DataFrame:
    """``conversation_id, thread, turn_no, row_id, role`` of every message of the conversations that are whole.

    Repeated deliveries go first, then rows without visible text. A conversation is a tree of reply links; ``thread`` is the turn in the channel at
    which it begins, and ``turn_no`` counts in the tree. It is dropped if a role is missing or its last message is the user's; and all of a channel, if a remaining
    row of it lacks sender or readable time, as it may belong to any of them. A row whose source is unknown has no role, which breaks its conversation;
    rows with a null channel are left out. Ties in time are ordered by ``row_id``. An empty table gives no rows; other columns are ignored.
    """
    s = sources.select("source", T.sender_key(F.col("owner_sender")).alias("owner"), T.sender_key(F.col("assistant_sender")).alias("named"))
    m = drop_repeated(keyed_messages(chat)).where(T.visible(F.col("text"))).where(F.col(channel).isNotNull()).join(s, "source", "left")
    role = (
        F.when(F.col("owner").isNotNull(), F.when(F.col("sender_key") == F.col("owner"), "user").otherwise("assistant"))
        .when(F.col("named").isNotNull(), F.when(F.col("sender_key") == F.col("named"), "assistant").otherwise("user"))
    )
    m = cut(m.select("conversation_id", *({channel} - {"conversation_id"}), "row_id", "ts_us", "sender_key", "text", role.alias("role")))
    lost = F.col("sender_key").isNull() | F.col("ts_us").isNull()
    carry = ("role", *({"conversation_id"} - {channel}))
    links = cut(reply_links(m.where(~lost), channel, window, break_below=break_below, carry=carry))
    trees = links.groupBy(channel, "root_turn").agg(F.bool_and(F.col("role").isNotNull()).alias("ok"), F.bool_or(F.col("role") == "user").alias("u"), F.max_by("role", F.struct("ts_us", "row_id")).alias("last"))
    whole = trees.where("ok and u and last = 'assistant'").join(m.where(lost).select(channel).distinct(), channel, "left_anti").select(channel, "root_turn")
    kept = links.join(whole, [channel, "root_turn"], "left_semi")
    if break_below is not None:  # turns of the tree, no longer those of the channel
        kept = rank_in_group(kept, [channel, "root_turn"], F.expr("turn_no div 4096"), ["turn_no"], "_rank").drop("turn_no").withColumnRenamed("_rank", "turn_no")
    return kept.select("conversation_id", F.col("root_turn").alias("thread"), "turn_no", "row_id", "role")
