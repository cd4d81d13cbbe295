"""Trajectories (role/value turns with XML-ish marks) to records, and the joins around them."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from corpusloom.functions.text import strip

# Who a turn's source stands for, and the marks inside turns.
ROLE_MAP = {"human": "user", "user": "user", "gpt": "assistant", "assistant": "assistant", "tool": "tool", "observation": "tool", "function": "tool"}
THINK = r"(?s)\A\s*<think>\s*(.*?)\s*</think>\s*"
CALL = re.compile(r"<tool_call>\s*(\{.*?\})\s*</tool_call>", re.S)
RESPONSE = re.compile(r"<tool_response>\s*(\{.*?\})\s*</tool_response>", re.S)
TOOLS = r"(?s)<tools>\s*(\[.*?\])\s*</tools>"
_S = StringType()
_ARGUMENT = StructType([StructField("name", _S), StructField("rendered", _S), StructField("raw_json", _S)])
CALLS_TYPE = StructType([StructField("calls", ArrayType(StructType([StructField("name", _S), StructField("arguments", ArrayType(_ARGUMENT))]))), StructField("error", _S)])
RESPONSES_TYPE = StructType([StructField("responses", ArrayType(StructType([StructField("tool_call_id", _S), StructField("name", _S), StructField("content", _S)]))), StructField("error", _S)])


def role_of(source: Column) -> Column:
    """Role of a turn's source; null for an unknown one."""
    return F.coalesce(*[F.when(source.isin(*[k for k, v in ROLE_MAP.items() if v == r]), F.lit(r)) for r in ("user", "assistant", "tool")])


def rendered_value(v: object) -> str:
    """Containers as JSON with default spacing, scalars as Python prints them."""
    return json.dumps(v, ensure_ascii=False) if isinstance(v, (dict, list)) else str(v)


@F.pandas_udf(CALLS_TYPE)
def calls_of(values: pd.Series) -> pd.DataFrame:
    """Tool calls of assistant turns, arguments in recorded order; ``error`` where one is broken."""
    calls, errors = [], []
    for v in values:
        out, error = [], None
        for m in CALL.finditer(v or ""):
            try:
                c = json.loads(m.group(1))
                args = c.get("arguments") or {}
                args = json.loads(args) if isinstance(args, str) else args
                if not c.get("name"):
                    raise ValueError("tool call without name")
                out.append({"name": c["name"], "arguments": [{"name": k, "rendered": rendered_value(x), "raw_json": json.dumps(x, ensure_ascii=False)} for k, x in args.items()]})
            except ValueError as e:
                error = f"tool call: {e}"
        calls.append(out)
        errors.append(error)
    return pd.DataFrame({"calls": calls, "error": errors})


@F.pandas_udf(RESPONSES_TYPE)
def responses_of(values: pd.Series) -> pd.DataFrame:
    """Responses of tool turns; each needs a call id and a name, and a turn at least one."""
    rows, errors = [], []
    for v in values:
        out, error = [], None
        for m in RESPONSE.finditer(v or ""):
            try:
                r = json.loads(m.group(1))
                c = r["content"]
                out.append({"tool_call_id": str(r["tool_call_id"]), "name": r["name"], "content": c if isinstance(c, str) else json.dumps(c, ensure_ascii=False)})
            except (ValueError, KeyError) as e:
                error = f"tool response: {e}"
        rows.append(out)
        errors.append(error or (None if out else "tool turn without response"))
    return pd.DataFrame({"responses": rows, "error": errors})


def tools_block(conversations: Column) -> Column:
    """The tools array of the first system turn, verbatim; null without one."""
    first = F.try_element_at(F.filter(conversations, lambda t: t["from"] == "system"), F.lit(1))["value"]
    return F.nullif(F.regexp_extract(first, TOOLS, 1), F.lit(""))


def thought_and_content(value: Column) -> tuple[Column, Column]:
    """Leading think block (null if blank), and the rest without tool calls."""
    thought = F.when(value.rlike(THINK), F.nullif(F.regexp_extract(value, THINK, 1), F.lit("")))
    rest = F.regexp_replace(value, THINK, "")
    return thought, strip(F.regexp_replace(rest, r"(?s)<tool_call>\s*\{.*?\}\s*</tool_call>", ""))


def pair_calls(calls: DataFrame, responses: DataFrame) -> DataFrame:
    """``rec, name, call_pos, resp_pos``: the k-th response of a name answers the k-th call of that name.

    A response without an open call before it comes out with a null call: an error for the record.
    """
    c = calls.withColumn("k", F.row_number().over(Window.partitionBy("rec", "name").orderBy("call_pos")))
    r = responses.withColumn("k", F.row_number().over(Window.partitionBy("rec", "name").orderBy("resp_pos")))
    j = r.join(c, ["rec", "name", "k"], "left")
    return j.withColumn("call_pos", F.when(F.col("call_pos") < F.col("resp_pos"), F.col("call_pos"))).drop("k")


def ingest(trajectories: DataFrame, rollouts: DataFrame, persona: str) -> DataFrame:
    """Complete trajectories joined with their rollout: ``prompt_index, messages, tools_schema_json, template_id, family, holdout, error``.

    A turn of an unknown role, a broken call or a response without an open call gives an ``error`` and null messages; the row stays, so that it can be counted.
    """
    t = trajectories.where("not coalesce(partial, false) and coalesce(completed, true)")
    turns = t.select("prompt_index", F.posexplode("conversations").alias("i", "t")).where("t.from <> 'system'")
    turns = turns.select("prompt_index", "i", role_of(F.col("t.from")).alias("role"), F.coalesce("t.value", F.lit("")).alias("value"))
    thought, content = thought_and_content(F.col("value"))
    turns = turns.withColumn("c", F.when(F.col("role") == "assistant", calls_of("value"))).withColumn("r", F.when(F.col("role") == "tool", responses_of("value"))).withColumn("thought", thought).withColumn("content", content)
    broken = F.coalesce(F.when(F.col("role").isNull(), F.lit("unknown role")), F.col("c.error"), F.col("r.error"))
    turns = turns.withColumn("error", broken)
    c = turns.where("role = 'assistant'").select(F.col("prompt_index").alias("rec"), "i", F.posexplode("c.calls").alias("j", "call")).select("rec", F.col("call.name").alias("name"), F.struct("i", "j").alias("call_pos"), "call")
    r = turns.where("role = 'tool'").select(F.col("prompt_index").alias("rec"), "i", F.posexplode("r.responses").alias("j", "resp")).select("rec", F.col("resp.name").alias("name"), F.struct("i", "j").alias("resp_pos"), "resp")
    paired = pair_calls(c.select("rec", "name", "call_pos"), r.select("rec", "name", "resp_pos"))
    answered = paired.join(r, ["rec", "name", "resp_pos"]).select("rec", "call_pos", "resp_pos", F.col("resp.tool_call_id").alias("id"), F.col("resp.content").alias("content"))
    none = "array<struct<id:string,name:string,arguments:array<struct<name:string,rendered:string,raw_json:string>>>>"
    call_rows = c.join(answered.where("call_pos is not null").select("rec", "call_pos", "id"), ["rec", "call_pos"], "left")
    own_id = F.concat_ws("_", F.lit("call"), F.col("call_pos.i").cast("string"), F.col("call_pos.j").cast("string"))
    named = call_rows.select("rec", F.col("call_pos.i").alias("i"), F.struct("call_pos", F.struct(F.coalesce("id", own_id).alias("id"), "call.name", "call.arguments").alias("call")).alias("x"))
    by_turn = named.groupBy("rec", "i").agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["call"]).alias("tool_calls"))
    said = turns.where("role in ('user', 'assistant')").join(by_turn.withColumnRenamed("rec", "prompt_index"), ["prompt_index", "i"], "left")
    body = F.when(F.col("role") == "assistant", F.col("content")).otherwise(F.col("value"))
    msg = lambda role, speaker, content, thought, calls, call_id: F.struct(role.alias("role"), speaker.alias("speaker"), content.alias("content"), thought.alias("thought"), calls.alias("tool_calls"), call_id.alias("tool_call_id"), F.lit(None).cast("string").alias("ts"))
    null = F.lit(None).cast("string")
    assistant = F.col("role") == "assistant"
    m1 = said.select("prompt_index", F.struct("i", F.lit(0).alias("j")).alias("p"), msg(F.col("role"), F.when(assistant, F.lit(persona)), body, F.when(assistant, F.col("thought")), F.coalesce("tool_calls", F.array().cast(none)), null).alias("m"))
    m2 = answered.select(F.col("rec").alias("prompt_index"), F.col("resp_pos").alias("p"), msg(F.lit("tool"), null, F.col("content"), null, F.array().cast(none), F.col("id")).alias("m"))
    messages = m1.unionByName(m2).groupBy("prompt_index").agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "m"))), lambda x: x["m"]).alias("messages"))
    errors = turns.where("error is not null").select("prompt_index", "error").unionByName(paired.where("call_pos is null").select(F.col("rec").alias("prompt_index"), F.concat(F.lit("no open call of "), F.col("name")).alias("error")))
    errors = errors.groupBy("prompt_index").agg(F.min("error").alias("error"))
    out = t.select("prompt_index", tools_block(F.col("conversations")).alias("tools_schema_json")).join(messages, "prompt_index", "left").join(errors, "prompt_index", "left").join(rollouts.select("prompt_index", "template_id", "family", "holdout", "instance_key"), "prompt_index", "left")
    error = F.coalesce(F.col("error"), F.when(F.col("template_id").isNull(), F.lit("prompt index outside the emitted inputs")))
    return out.withColumn("error", error).withColumn("messages", F.when(F.col("error").isNull(), F.col("messages")))


def new_instances(candidates: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Candidates whose identity is not known yet, each once."""
    return candidates.join(known.select(key), key, "left_anti").dropDuplicates([key])
