"""Records to training text.

A record is one row and stays one: every message becomes a text fragment by array expressions, fragments are joined, and
loss spans are running sums of their lengths. Rendering therefore needs no shuffle and no Python, whatever the number of records.
Next-speaker samples and preference prompts reuse the same fragments, so they cannot drift from the rendered conversation.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from corpusloom.functions.text import explode_once, let, strip
from corpusloom.schema import speakers

CONTRACT = "v3"
IM_START, IM_END = "<|im_start|>", "<|im_end|>"
WITH_THOUGHTS, NO_THOUGHTS = "with_thoughts", "no_thoughts"

# The text around the tools of a system turn, byte for byte as the chat template has it.
TOOLS_HEADER = "# Tools\n\nYou have access to the following functions:\n\n<tools>"
TOOLS_FOOTER = (
    "\n</tools>\n\nIf you choose to call a function ONLY reply in the following format with NO suffix:\n\n"
    "<tool_call>\n<function=example_function_name>\n<parameter=example_parameter_1>\nvalue_1\n</parameter>\n<parameter=example_parameter_2>\n"
    "This is the value for the second parameter\nthat can span\nmultiple lines\n</parameter>\n</function>\n</tool_call>\n\n"
    "<IMPORTANT>\nReminder:\n- Function calls MUST follow the specified format: an inner <function=...></function> block must be nested within <tool_call></tool_call> XML tags\n"
    "- Required parameters MUST be specified\n- You may provide optional reasoning for your function call in natural language BEFORE the function call, but NOT after\n"
    "- If there is no function call available, answer the question like normal with your current knowledge and do not tell the user about function calls\n</IMPORTANT>"
)


@F.pandas_udf(ArrayType(StringType()))
def tool_envelopes(schemas: pd.Series) -> pd.Series:
    """Each tool of a JSON array in its function envelope, dumped with default spacing and authored key order."""

    def one(s: str | None) -> list[str] | None:
        if s is None:
            return None
        return [json.dumps(t if t.get("type") == "function" else {"type": "function", "function": t}, ensure_ascii=False) for t in json.loads(s)]

    return schemas.map(one)


def turn(role: str, body: Column) -> Column:
    """One framed turn."""
    return F.concat(F.lit(f"{IM_START}{role}\n"), body, F.lit(f"{IM_END}\n"))


def _text(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit("")))


def system_turn(system: Column, tools: Column) -> Column:
    """Tools block first, then the record's system text; an empty string if there is neither. ``tools`` are envelopes or null."""
    own = _text(system)
    block = F.concat(F.lit(TOOLS_HEADER), F.array_join(F.transform(tools, lambda t: F.concat(F.lit("\n"), t)), ""), F.lit(TOOLS_FOOTER))
    both = F.when(own == "", block).otherwise(F.concat(block, F.lit("\n\n"), own))
    return F.when(tools.isNotNull(), turn("system", both)).when(own == "", F.lit("")).otherwise(turn("system", own))


def tool_call_xml(call: Column) -> Column:
    """A tool call in XML, arguments in recorded order."""
    args = F.transform(
        F.coalesce(call["arguments"], F.array().cast("array<struct<name:string,rendered:string,raw_json:string>>")),
        lambda a: F.concat(F.lit("<parameter="), a["name"], F.lit(">\n"), F.coalesce(a["rendered"], F.lit("None")), F.lit("\n</parameter>\n")),
    )
    return F.concat(F.lit("<tool_call>\n<function="), call["name"], F.lit(">\n"), F.array_join(args, ""), F.lit("</function>\n</tool_call>"))


def last_user_position(messages: Column) -> Column:
    """0-based position of the last user message; -1 without one, so that every assistant turn lies behind it."""
    at = F.transform(messages, lambda m, i: F.when(m["role"] == "user", i).otherwise(F.lit(-1)))
    return F.coalesce(F.array_max(at), F.lit(-1))


def assistant_body(m: Column, thinks: Column, with_thoughts: bool, prefix_speaker: Column) -> Column:
    """Think block where due, speaker label in multi-speaker records, content, tool calls."""
    content = _text(m["content"])
    named = prefix_speaker & (F.coalesce(m["speaker"], F.lit("")) != "")
    content = F.when(named, F.when(content == "", F.concat(m["speaker"], F.lit(":"))).otherwise(F.concat(m["speaker"], F.lit(": "), content))).otherwise(content)
    thought = _text(m["thought"]) if with_thoughts else F.lit("")
    think = F.when(thinks, F.concat(F.lit("<think>\n"), thought, F.lit("\n</think>\n\n"))).otherwise(F.lit(""))
    calls = F.transform(F.coalesce(m["tool_calls"], F.array().cast("array<struct<id:string,name:string,arguments:array<struct<name:string,rendered:string,raw_json:string>>>>")), tool_call_xml)
    return F.concat(think, content, F.when((F.size(calls) > 0) & (content != ""), F.lit("\n\n")).otherwise(F.lit("")), F.array_join(calls, "\n"))


def fragments(messages: Column, mode: str) -> Column:
    """Text of each message. A run of tool results shares one user turn: its first fragment opens it, its last one closes it."""
    known = F.struct((F.size(speakers(messages)) > 1).alias("many"), last_user_position(messages).alias("last_user"))
    role_at = lambda i: F.try_element_at(messages, i)["role"]

    def fragment(k: Column, m: Column, i: Column) -> Column:
        opens = F.when((i > 0) & (role_at(F.greatest(i, F.lit(1))) == "tool"), F.lit("")).otherwise(F.lit(f"{IM_START}user"))
        closes = F.when(F.coalesce(role_at(i + 2) == "tool", F.lit(False)), F.lit("")).otherwise(F.lit(f"{IM_END}\n"))
        tool = F.concat(opens, F.lit("\n<tool_response>\n"), _text(m["content"]), F.lit("\n</tool_response>"), closes)
        said = turn("assistant", assistant_body(m, i > k["last_user"], mode == WITH_THOUGHTS, k["many"]))
        return F.when(m["role"] == "tool", tool).when(m["role"] == "assistant", said).otherwise(turn("user", _text(m["content"])))

    return let(known, lambda k: F.transform(messages, lambda m, i: fragment(k, m, i)))


def with_fragments(records: DataFrame, mode: str) -> DataFrame:
    """Adds ``head`` (system turn), ``frags`` and ``starts`` (offset of each fragment in the text).

    A null message array renders like an empty one. System messages belong into ``system``: rows that hold one fail.
    """
    none = F.array().cast(records.schema["messages"].dataType)
    checked = F.when(F.exists(F.coalesce("messages", none), lambda m: F.coalesce(m["role"] == "system", F.lit(False))), F.raise_error(F.lit("system prompt belongs in record.system, not messages")).cast("boolean"))
    tools = F.when(F.col("tools_schema_json").isNotNull(), tool_envelopes("tools_schema_json"))
    r = records.withColumn("messages", F.when(checked.isNull(), F.coalesce("messages", none)).otherwise(none)).withColumn("_tools", tools)
    r = r.withColumn("head", system_turn(F.col("system"), F.col("_tools"))).withColumn("frags", fragments(F.col("messages"), mode)).drop("_tools")
    lengths = F.transform("frags", lambda f: F.length(f))
    running = F.aggregate(lengths, F.array(F.length("head")), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))
    return r.withColumn("starts", F.slice(running, 1, F.size("frags")))


def rendered(records: DataFrame, mode: str = WITH_THOUGHTS) -> DataFrame:
    """``text`` and ``train_spans`` of each record (other columns stay): spans cover assistant bodies up to and with the end mark."""
    r = with_fragments(records, mode)
    open_len = len(f"{IM_START}assistant\n")
    spans = F.filter(
        F.transform("frags", lambda f, i: F.when(F.element_at("messages", i + 1)["role"] == "assistant", F.struct((F.element_at("starts", i + 1) + open_len).cast("int").alias("start"), (F.element_at("starts", i + 1) + F.length(f) - 1).cast("int").alias("end")))),
        lambda s: s.isNotNull(),
    )
    return r.withColumn("text", F.concat("head", F.array_join("frags", ""))).withColumn("train_spans", spans).drop("head", "frags", "starts")


def next_speaker_samples(records: DataFrame) -> DataFrame:
    """One sample for each labelled assistant turn but the first message, in multi-speaker records: prefix, opening, ``Speaker:``.

    Adds ``turn_index, text, span_start, span_end``; the span covers the label alone.
    """
    r = with_fragments(records, NO_THOUGHTS).where(F.size(speakers(F.col("messages"))) > 1)
    last_user = last_user_position(F.col("messages"))
    wanted = F.filter(F.sequence(F.lit(1), F.greatest(F.size("messages") - 1, F.lit(1))), lambda i: (F.try_element_at(F.col("messages"), i + 1)["role"] == "assistant") & (F.coalesce(F.try_element_at(F.col("messages"), i + 1)["speaker"], F.lit("")) != ""))
    r = explode_once(r.withColumn("last_user", last_user), wanted, "turn_index")
    prefix = F.concat("head", F.array_join(F.slice("frags", F.lit(1), F.col("turn_index")), ""))
    opening = F.concat(F.lit(f"{IM_START}assistant\n"), F.when(F.col("turn_index") > F.col("last_user"), F.lit("<think>\n\n</think>\n\n")).otherwise(F.lit("")))
    label = F.concat(F.element_at("messages", F.col("turn_index") + 1)["speaker"], F.lit(":"))
    return (
        r.withColumn("text", F.concat(prefix, opening, label))
        .withColumn("span_end", F.length("text"))
        .withColumn("span_start", F.col("span_end") - F.length(label))
        .drop("head", "frags", "starts", "last_user")
    )


def prompt_and_answer(records: DataFrame, mode: str = WITH_THOUGHTS) -> DataFrame:
    """``prompt_text`` (up to the first user turn) and ``answer_text`` (the rest); records without a user turn fall away.

    The prompt is rendered by itself, as its turns may carry other think blocks than in the whole record.
    """
    first_user = F.array_position(F.transform("messages", lambda m: m["role"]), "user").cast("int")
    r = records.withColumn("_n", first_user).where("_n > 0")
    whole = rendered(r, mode).drop("train_spans").withColumnRenamed("text", "_whole").withColumn("_all", F.col("messages"))
    alone = rendered(whole.withColumn("messages", F.slice("messages", F.lit(1), F.col("_n"))), mode).drop("train_spans").withColumnRenamed("text", "prompt_text")
    answer = F.expr("substring(_whole, length(prompt_text) + 1)")
    return alone.withColumn("answer_text", answer).withColumn("messages", F.col("_all")).drop("_n", "_whole", "_all")


def preference_pairs(kept: DataFrame, rejected: DataFrame, min_margin: float = 1.0, mode: str = WITH_THOUGHTS) -> DataFrame:
    """Kept records joined with rejected siblings of the same group that lost at the judge by at least ``min_margin``.

    Both sides must be judged, the rejected one verified, and the prompts byte-identical. Only ids, scores and rendered texts are
    shuffled, on (group, prompt hash): siblings with other prompts never meet.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return prompt_and_answer(df, mode).select(
            F.col("provenance.sibling_group").alias("sibling_group"),
            F.xxhash64("prompt_text").alias("_h"),
            F.col("prompt_text").alias(f"{name}_prompt"),
            F.col("answer_text").alias(f"{name}_text"),
            F.col("provenance.record_id").alias(f"{name}_id"),
            F.col("provenance.lane").alias(f"{name}_lane"),
            F.col("provenance.family").alias(f"{name}_family"),
            F.col("gate_state.judge.overall").alias(f"{name}_overall"),
        )

    judged = "coalesce(provenance.sibling_group, '') <> '' and gate_state.judge is not null"
    c = side(kept.where(judged), "chosen")
    r = side(rejected.where(judged + " and gate_state.drop_reason = 'judge' and gate_state.verified"), "rejected").drop("rejected_lane", "rejected_family")
    j = c.join(r, ["sibling_group", "_h"]).where("chosen_prompt = rejected_prompt").withColumn("margin", F.col("chosen_overall") - F.col("rejected_overall")).where(F.col("margin") >= min_margin)
    meta = {"sibling_group": "sibling_group", "chosen_id": "chosen_id", "rejected_id": "rejected_id", "lane": "chosen_lane", "family": "chosen_family"}
    pairs = [x for k, v in meta.items() for x in (F.lit(k), F.col(v))] + [F.lit("margin"), F.format_string("%.3f", "margin"), F.lit("thought_mode"), F.lit(mode), F.lit("contract"), F.lit(CONTRACT)]
    return j.select(F.col("chosen_prompt").alias("prompt_text"), "chosen_text", "rejected_text", F.create_map(*pairs).alias("meta"))


def judge_transcript(system: Column, messages: Column) -> Column:
    """Readable transcript for a judge: tool results cut at 2,000 characters, inner thoughts and tool calls named."""

    def line(m: Column) -> Column:
        who = F.when(F.coalesce(m["speaker"], F.lit("")) != "", m["speaker"]).otherwise(m["role"])
        body = F.coalesce(m["content"], F.lit(""))
        calls = F.array_join(F.transform(m["tool_calls"], lambda c: F.concat(c["name"], F.lit("("), F.array_join(F.transform(c["arguments"], lambda a: F.concat(a["name"], F.lit("="), F.coalesce(a["rendered"], F.lit("None")))), ", "), F.lit(")"))), "; ")
        with_calls = F.when(F.coalesce(F.size(m["tool_calls"]), F.lit(0)) > 0, F.concat(F.when(body == "", "").otherwise(F.concat(body, F.lit("\n"))), F.lit("[calls tools: "), calls, F.lit("]"))).otherwise(body)
        thought = F.when(F.coalesce(m["thought"], F.lit("")) != "", F.concat(F.lit("(inner thought: "), m["thought"], F.lit(")\n"))).otherwise(F.lit(""))
        tool = F.concat(F.lit("[tool result]\n"), F.substring(body, 1, 2000), F.lit("\n"))
        return F.when(m["role"] == "tool", tool).otherwise(F.concat(F.lit("["), who, F.lit("]\n"), thought, with_calls, F.lit("\n")))

    head = F.concat(F.lit("[system]\n"), F.coalesce(system, F.lit("")), F.lit("\n"))
    return F.concat_ws("\n", head, F.array_join(F.transform(messages, line), "\n"))


def flip_history(messages: Column) -> Column:
    """User and assistant exchanged, for the simulated user's side; other roles fall away."""
    talk = F.filter(messages, lambda m: m["role"].isin("user", "assistant"))
    return F.transform(talk, lambda m: F.struct(F.when(m["role"] == "user", F.lit("assistant")).otherwise(F.lit("user")).alias("role"), m["content"].alias("content")))


def render_all(kept: DataFrame, rejected: DataFrame, is_eval: Column, min_margin: float = 1.0) -> dict[str, DataFrame]:
    """The six artifacts: train and eval with and without thoughts, next-speaker samples and preference pairs of train."""
    train, evals = kept.where(~is_eval), kept.where(is_eval)
    return {
        "train": rendered(train, WITH_THOUGHTS),
        "train_no_thoughts": rendered(train, NO_THOUGHTS),
        "eval": rendered(evals, WITH_THOUGHTS),
        "eval_no_thoughts": rendered(evals, NO_THOUGHTS),
        "next_speaker": next_speaker_samples(train),
        "pairs": preference_pairs(train, rejected, min_margin),
    }
