"""Schemas of records, rendered samples and raw inputs, and the message shape rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: One conversation record. ``arguments`` keep their recorded order and their rendered form, which JSON maps would lose.
RECORD_DDL = (
    "schema_version int, system string, tools_schema_json string, messages array<struct<role string, speaker string, content string, thought string, "
    "tool_calls array<struct<id string, name string, arguments array<struct<name string, rendered string, raw_json string>>>>, tool_call_id string, ts string>>, "
    "provenance struct<record_id string, lane string, run_id string, family string, template_id string, holdout boolean, teachers map<string,string>, sibling_group string, "
    "hermes_commit string, prompt_set_hash string, source struct<kind string, detail_json string>>, "
    "gate_state struct<verified boolean, verifier_id string, verifier_details_json string, judge struct<axes map<string,double>, overall double, passed boolean, judge_model string>, "
    "scrub_flags array<string>, deduped_against string, harmonized boolean, dropped boolean, drop_reason string>"
)
SAMPLE_DDL = "text string, train_spans array<struct<start int, end int>>, meta map<string,string>"
PAIR_DDL = "prompt_text string, chosen_text string, rejected_text string, meta map<string,string>"
GENERIC_CHAT_DDL = "conversation_id string, ts string, sender string, text string"
IMESSAGE_DDL = "timestamp bigint, sender string, type string, parts array<struct<type string, text string, url string, history array<struct<text string>>>>"
INSTAGRAM_DDL = "participants array<struct<name string>>, messages array<struct<sender_name string, timestamp_ms bigint, content string>>"
TEAMS_DDL = "me struct<name string>, participant struct<name string>, messages array<struct<`from` string, sent string, text string>>"
REDDIT_DDL = (
    "account string, me struct<name string>, comments array<struct<sent string, text string, subreddit string, permalink string, in_reply_to struct<author string, title string, text string>>>"
)
WORKS_DDL = "id bigint, title string, metadata map<string,string>, text string"
TRAJECTORY_DDL = "prompt_index bigint, completed boolean, partial boolean, conversations array<struct<`from` string, value string>>"
USAGE_DDL = "teacher string, lane string, tokens_in bigint, tokens_out bigint"

ROLES = ("user", "assistant", "tool")
LANES = ("a", "b", "c", "d")
#: A pinned model id names a dated snapshot.
DATED_ID = r"[-_/]20\d{6}$"


def message_is_sound(m: Column) -> Column:
    """Tool messages have a call id and only they; tool calls and thoughts occur on assistant turns only."""
    tool = m["role"] == "tool"
    calls = F.coalesce(F.size(m["tool_calls"]), F.lit(0)) > 0
    ok = m["role"].isin(*ROLES) & (tool == m["tool_call_id"].isNotNull()) & ((m["role"] == "assistant") | ~(calls | m["thought"].isNotNull()))
    return F.coalesce(ok, F.lit(False))


def record_is_sound(messages: Column) -> Column:
    """Every message of a record obeys the shape rules; a null array does not."""
    return F.coalesce(F.forall(messages, message_is_sound), F.lit(False))


def dated_id(c: Column) -> Column:
    """Whether a model id is pinned: dated, and neither ``latest`` nor a free tier."""
    return F.coalesce(c.rlike(DATED_ID) & ~c.contains("latest") & ~c.endswith(":free"), F.lit(False))


def speakers(messages: Column) -> Column:
    """Distinct non-empty assistant speakers in order of first appearance."""
    said = F.filter(messages, lambda m: (m["role"] == "assistant") & (F.coalesce(m["speaker"], F.lit("")) != ""))
    return F.array_distinct(F.transform(said, lambda m: m["speaker"]))
