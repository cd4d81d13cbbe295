"""Outcome predicates over finished records: each gives ``struct<passed boolean, failed array<string>>`` as array expressions inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import let, squeeze, strip
from corpusloom.functions.timestamps import instant_us

# Patterns of the checks.
USER_TAG = r"(?im)^\s*(?:\{\{user\}\}|user|you)\s*:"
YOU_SAY = r"(?i)\byou\s+(?:say|reply|respond|answer)\b[,:]?\s*[\"“]"
LIST_MARK = r"^\s*(?:\d+\s*[.)]|[-*•])\s"
FRONT_MATTER = r"(?s)^(---\s*\n.*?\n---\s*(?:\n|$))"
URL = r"https?://[^\s\"'<>\)\]\}]+"
NUMBER = r"\d[\d,]*(?:\.\d+)?"


def result(checks: dict[str, Column]) -> Column:
    """All checks passed, and the names of those that did not; an unknown check counts as failed."""
    sure = {k: F.coalesce(v, F.lit(False)) for k, v in checks.items()}
    failed = F.array_compact(F.array(*[F.when(~v, F.lit(k)) for k, v in sure.items()]))
    return let(failed, lambda f: F.struct((F.size(f) == 0).alias("passed"), f.alias("failed")))


def _text(m: Column) -> Column:
    return F.coalesce(m["content"], F.lit(""))


def _calls(m: Column) -> Column:
    return F.coalesce(F.size(m["tool_calls"]), F.lit(0))


def _tool_calls(m: Column) -> Column:
    return F.coalesce(m["tool_calls"], F.array().cast("array<struct<id:string,name:string,arguments:array<struct<name:string,rendered:string,raw_json:string>>>>"))


def _of(messages: Column, role: str) -> Column:
    return F.filter(messages, lambda m: m["role"] == role)


def argument(call: Column, name: str) -> Column:
    """Rendered value of a call's argument, null without it."""
    hit = F.filter(call["arguments"], lambda a: a["name"] == name)
    return F.try_element_at(hit, F.lit(1))["rendered"]


def path_parts(path: Column) -> Column:
    """Components of a path; a leading slash is one of them."""
    return F.concat(F.when(path.startswith("/"), F.array(F.lit("/"))).otherwise(F.array().cast("array<string>")), F.filter(F.split(path, "/"), lambda x: ~x.isin("", ".")))


def is_destination(path: Column, target: Column) -> Column:
    """Whether the last components of a path are the target's."""
    p, t = path_parts(path), path_parts(target)
    return (F.size(t) > 0) & (F.size(p) >= F.size(t)) & (F.slice(p, F.greatest(F.size(p) - F.size(t) + 1, F.lit(1)), F.greatest(F.size(t), F.lit(1))) == t)


def tool_ok(content: Column) -> Column:
    """Whether a tool result is a JSON object without a truthy error."""
    j = F.from_json(content, "map<string,string>")
    error = F.coalesce(F.try_element_at(j, F.lit("error")), F.lit(""))
    return j.isNotNull() & error.isin("", "false", "null", "0", "0.0", "[]", "{}")


def final_write(messages: Column, target: Column) -> Column:
    """``struct<ok, content>`` of the last answered write to a path that is the target; not ok and empty without one."""
    writes = F.flatten(F.transform(_of(messages, "assistant"), lambda m: F.filter(_tool_calls(m), lambda c: (c["name"] == "write_file") & argument(c, "path").isNotNull())))
    mine = F.filter(writes, lambda c: F.coalesce(is_destination(argument(c, "path"), target), F.lit(False)))

    def last(calls: Column) -> Column:
        answers = F.filter(_of(messages, "tool"), lambda m: F.exists(calls, lambda c: F.coalesce(c["id"] == m["tool_call_id"], F.lit(False))))
        return let(F.try_element_at(answers, F.lit(-1)), lambda t: F.struct(F.coalesce(tool_ok(t["content"]), F.lit(False)).alias("ok"), F.coalesce(argument(F.try_element_at(F.filter(calls, lambda c: c["id"] == t["tool_call_id"]), F.lit(-1)), "content"), F.lit("")).alias("content")))

    return let(mine, last)


def _with_writes(messages: Column, params: Column, names: list[str], use) -> Column:
    """``use`` of the final writes to the targets that parameters name, each evaluated once."""
    return let(F.struct(*[final_write(messages, _param(params, n)).alias(n) for n in names]), use)


def confirmed(messages: Column) -> Column:
    """The last message is an assistant's, without calls and not blank."""
    last = F.try_element_at(messages, F.lit(-1))
    return (last["role"] == "assistant") & (_calls(last) == 0) & (strip(_text(last)) != "")


def _param(params: Column, name: str) -> Column:
    return F.nullif(F.try_element_at(params, F.lit(name)), F.lit(""))


def urls(text: Column) -> Column:
    """Distinct links without closing punctuation and slash."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(f"({URL})"), 1), lambda u: F.regexp_replace(F.regexp_replace(u, "[.,;:!?]+$", ""), "/+$", "")))


def words_without_urls(text: Column) -> Column:
    """Number of words that are no links."""
    return F.size(F.filter(F.split(squeeze(text), " "), lambda w: (w != "") & ~w.rlike(f"^{URL}")))


def scene_wellformed(messages: Column, system: Column, params: Column | None = None) -> Column:
    """At least six turns by two labelled speakers, half of them with thoughts, no bracketed thoughts, a scene in the system text."""
    t = _of(messages, "assistant")
    named = F.array_distinct(F.filter(F.transform(t, lambda m: m["speaker"]), lambda s: F.coalesce(s, F.lit("")) != ""))
    with_thought = F.size(F.filter(t, lambda m: F.coalesce(m["thought"], F.lit("")) != ""))
    return result(
        {
            "enough_turns": F.size(t) >= 6,
            "multi_speaker": F.size(named) >= 2,
            "speakers_labeled": F.forall(t, lambda m: F.coalesce(m["speaker"], F.lit("")) != ""),
            "thought_coverage": (F.size(t) > 0) & (with_thought >= F.size(t) * 0.5),
            "no_bracket_thoughts": ~F.exists(t, lambda m: F.contains(_text(m), F.lit("[")) & F.contains(_text(m), F.lit("]"))),
            "system_has_scene": F.contains(F.coalesce(system, F.lit("")), F.lit("## Scene")),
        }
    )


def no_impersonation(messages: Column, system: Column | None = None, params: Column | None = None) -> Column:
    """No assistant turn opens a line in the user's name or scripts the user's words."""
    return result({"no_impersonation": ~F.exists(_of(messages, "assistant"), lambda m: _text(m).rlike(USER_TAG) | _text(m).rlike(YOU_SAY))})


def turn_dynamics(messages: Column, system: Column | None = None, params: Column | None = None) -> Column:
    """At least three user turns, strict alternation, more than half of the assistant turns distinct."""
    talk = F.filter(messages, lambda m: m["role"].isin("user", "assistant"))
    said = F.transform(_of(talk, "assistant"), lambda m: squeeze(F.lower(_text(m))))
    roles = F.transform(talk, lambda m: m["role"])
    pairs = F.zip_with(F.slice(roles, 1, F.greatest(F.size(roles) - 1, F.lit(0))), F.slice(roles, 2, F.greatest(F.size(roles) - 1, F.lit(0))), lambda a, b: a != b)
    return result(
        {
            "enough_exchanges": F.size(_of(talk, "user")) >= 3,
            "alternating": F.forall(pairs, lambda x: x),
            "not_degenerate": (F.size(said) > 0) & (F.size(F.array_distinct(said)) > F.size(said) * 0.5),
        }
    )


def stream_wellformed(messages: Column, family: Column, source: Column) -> Column:
    """A two-sided stream: non-empty, labelled, timed in order, without tools, its family the source and first month."""
    ts = F.transform(messages, lambda m: instant_us(m["ts"]))
    n = F.greatest(F.size(ts) - 1, F.lit(0))
    in_order = F.forall(F.zip_with(F.slice(ts, 1, n), F.slice(ts, 2, n), lambda a, b: a <= b), lambda x: F.coalesce(x, F.lit(False)))
    month = F.concat_ws("/", F.coalesce(source, F.lit("")), F.date_format(F.timestamp_micros(F.try_element_at(ts, F.lit(1))), "yyyy-MM"))
    timed = (F.size(messages) > 0) & F.forall(ts, lambda t: t.isNotNull())
    return result(
        {
            "two_sided_conversation": F.size(F.array_distinct(F.transform(messages, lambda m: m["role"]))) >= 2,
            "content_non_empty": F.forall(messages, lambda m: strip(_text(m)) != ""),
            "speakers_present": F.forall(messages, lambda m: F.coalesce(m["speaker"], F.lit("")) != ""),
            "all_messages_timestamped": F.forall(ts, lambda t: t.isNotNull()),
            "timestamps_ordered": F.forall(ts, lambda t: t.isNotNull()) & in_order,
            "no_tool_machinery": F.forall(messages, lambda m: m["role"].isin("user", "assistant") & (_calls(m) == 0)),
            "family_matches_first_month": timed & (family == month),
        }
    )


def batch_consistency(messages: Column, params: Column) -> Column:
    """Each of the numbered notes 1..count was written with the required first line."""
    count, prefix, line = _param(params, "count").try_cast("int"), _param(params, "prefix_dir"), F.try_element_at(params, F.lit("required_line"))
    present = count.isNotNull() & prefix.isNotNull() & line.isNotNull()
    notes = F.when(present & (count > 0), F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))

    def good(i: Column) -> Column:
        w = final_write(messages, F.concat(prefix, F.lit("/note-"), i.cast("string"), F.lit(".txt")))
        return w["ok"] & (F.substring_index(w["content"], "\n", 1) == line)

    return result({"params_present": present, "notes_written": F.forall(notes, good), "confirmed_to_user": confirmed(messages)})


def normal_lines(text: Column) -> Column:
    """Lines without trailing blanks, closing empty lines gone."""
    return F.split(F.regexp_replace(F.regexp_replace(text, r"(?Um)[^\S\n]+$", ""), r"\n+$", ""), "\n")


def tagged_count(messages: Column, params: Column) -> Column:
    """The log was written verbatim and the count file states the true count."""
    true_count = _param(params, "true_count").try_cast("bigint")

    def checks(w: Column) -> Column:
        log, n = w["destination"], w["count_destination"]
        return result(
            {
                "wrote_log_verbatim": log["ok"] & (normal_lines(log["content"]) == normal_lines(F.coalesce(F.try_element_at(params, F.lit("entries_block")), F.lit("")))),
                "wrote_correct_count": n["ok"] & F.exists(F.regexp_extract_all(n["content"], F.lit(r"(\d+)"), 1), lambda x: F.coalesce(x.try_cast("bigint") == true_count, F.lit(False))),
                "confirmed_to_user": confirmed(messages),
            }
        )

    return _with_writes(messages, params, ["destination", "count_destination"], checks)


def save_note(messages: Column, params: Column) -> Column:
    """The note is there and not blank, and the index names it."""
    target = _param(params, "destination")

    def checks(w: Column) -> Column:
        note, index = w["destination"], w["index"]
        return result(
            {
                "wrote_requested_path": note["ok"],
                "content_nonempty": strip(note["content"]) != "",
                "index_written": index["ok"],
                "index_names_file": F.contains(index["content"], F.substring_index(F.regexp_replace(target, "/+$", ""), "/", -1)),
                "confirmed_to_user": confirmed(messages),
            }
        )

    return _with_writes(messages, params, ["destination", "index"], checks)


def rename_patch(messages: Column, params: Column) -> Column:
    """Writes and replacing patches are replayed in the order of their results; the old term is gone and the new one there."""
    target, old, new = _param(params, "destination"), _param(params, "old_term"), _param(params, "new_term")
    calls = F.flatten(F.transform(_of(messages, "assistant"), _tool_calls))
    mine = F.filter(calls, lambda c: F.coalesce(is_destination(argument(c, "path"), target), F.lit(False)) & ((c["name"] == "write_file") | ((c["name"] == "patch") & (F.coalesce(argument(c, "mode"), F.lit("replace")) == "replace"))))

    def replay(state: Column, m: Column) -> Column:
        c = F.try_element_at(F.filter(mine, lambda x: x["id"] == m["tool_call_id"]), F.lit(-1))
        a, b = F.coalesce(argument(c, "old_string"), F.lit("")), F.coalesce(argument(c, "new_string"), F.lit(""))
        at = F.position(a, state)
        once = F.when(at > 0, F.concat(F.substring(state, F.lit(1), at - 1), b, F.substring(state, at + F.length(a), F.length(state)))).otherwise(state)
        every = F.coalesce(F.lower(argument(c, "replace_all")), F.lit("false")).isin("true", "1")
        patched = F.when(every, F.replace(state, a, b)).otherwise(once)
        return F.when(c.isNull() | ~F.coalesce(tool_ok(m["content"]), F.lit(False)), state).when(c["name"] == "write_file", F.coalesce(argument(c, "content"), F.lit(""))).otherwise(patched)

    end = F.aggregate(_of(messages, "tool"), F.lit(None).cast("string"), replay)
    checks = lambda final: {"wrote_requested_path": final.isNotNull(), "old_term_gone": old.isNotNull() & ~F.contains(final, old), "new_term_present": new.isNotNull() & F.contains(final, new), "confirmed_to_user": confirmed(messages)}
    return let(end, lambda final: result(checks(final)))


def exact_lines(messages: Column, params: Column) -> Column:
    """Exactly n lines, none blank or marked, in alphabetical order without regard to case."""
    n = _param(params, "n_lines").try_cast("int")

    def checks(w: Column) -> Column:
        lines, low = w["lines"], F.transform(w["lines"], F.lower)
        return result(
            {
                "wrote_requested_path": w["ok"],
                "exact_line_count": F.size(lines) == n,
                "no_blank_lines": (F.size(lines) > 0) & F.forall(lines, lambda x: strip(x) != ""),
                "no_list_markers": (F.size(lines) > 0) & ~F.exists(lines, lambda x: x.rlike(LIST_MARK)),
                "alphabetical_order": (F.size(lines) > 0) & (low == F.array_sort(low)),
                "confirmed_to_user": confirmed(messages),
            }
        )

    lines = lambda c: F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(c, r"\n+$", ""), "\n"))
    return _with_writes(messages, params, ["destination"], lambda w: let(F.struct(w["destination"]["ok"].alias("ok"), lines(w["destination"]["content"]).alias("lines")), checks))


def _numbers(text: Column) -> Column:
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(f"({NUMBER})"), 1), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double")), lambda x: x.isNotNull())


def monthly_payment(principal: Column, rate_pct: Column, years: Column) -> Column:
    """Payment of an amortised loan; null for a rate or term that is not positive."""
    r, n = rate_pct / 1200.0, years * 12
    return F.when((r > 0) & (n > 0), principal * r / (1.0 - F.pow(1.0 + r, -n)))


def calc_note(messages: Column, params: Column) -> Column:
    """The saved note states the recomputed payment to the cent."""
    due = monthly_payment(_param(params, "principal").try_cast("double"), _param(params, "rate_pct").try_cast("double"), _param(params, "years").try_cast("int"))
    near = lambda c: F.exists(_numbers(c), lambda x: F.coalesce(F.abs(x - F.round(due, 2)) <= 0.011, F.lit(False)))
    return _with_writes(messages, params, ["destination"], lambda w: result({"wrote_requested_path": w["destination"]["ok"], "correct_amount": near(w["destination"]["content"]), "confirmed_to_user": confirmed(messages)}))


def _stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(.)\.[^.]*$", "$1")


def _links(text: Column, path: Column) -> Column:
    inner = F.transform(F.regexp_extract_all(text, F.lit(r"\[\[([^\]]*)\]\]"), 1), lambda x: F.substring_index(x, "|", 1))
    return path.isNotNull() & F.exists(inner, lambda x: x.endswith(_stem(path)))


def linked_note(messages: Column, params: Column) -> Column:
    """Note with tagged front matter and hub, each linking the other."""
    target, hub = _param(params, "destination"), _param(params, "hub")

    def checks(w: Column) -> Column:
        n, h = w["destination"], w["hub"]
        return result(
            {
                "wrote_note": n["ok"],
                "note_has_frontmatter_tags": F.contains(F.regexp_extract(n["content"], FRONT_MATTER, 1), F.lit("tags")),
                "wrote_hub": h["ok"],
                "hub_links_note": _links(h["content"], target),
                "note_backlinks_hub": _links(n["content"], hub),
                "confirmed_to_user": confirmed(messages),
            }
        )

    return _with_writes(messages, params, ["destination", "hub"], checks)


def _grounded(messages: Column, content: Column) -> Column:
    seen = F.array_distinct(F.flatten(F.transform(_of(messages, "tool"), lambda m: urls(_text(m)))))
    return F.size(F.array_intersect(urls(content), seen))


def _cited(messages: Column, params: Column, least: int, name: str, most_words: int, more=None) -> Column:
    def checks(w: Column) -> Column:
        c = w["destination"]["content"]
        between = let(words_without_urls(c), lambda n: (n > 0) & (n <= most_words))
        return result({"wrote_requested_path": w["destination"]["ok"], name: _grounded(messages, c) >= least, **(more(c) if more else {}), "within_word_budget": between, "confirmed_to_user": confirmed(messages)})

    return _with_writes(messages, params, ["destination"], checks)


def compare_sources(messages: Column, params: Column) -> Column:
    """At least three cited links that tools returned, and 1 to 300 words."""
    return _cited(messages, params, 3, "cited_three_grounded_sources", 300)


def ratio_consistent(text: Column) -> Column:
    """Whether a stated number is the ratio of two others, the first larger, within two per cent."""
    v = F.filter(_numbers(text), lambda x: x > 0)
    at = F.transform(v, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    fits = lambda x, a, b: (a["i"] != x["i"]) & (b["i"] != x["i"]) & (b["i"] != a["i"]) & (a["x"] > b["x"]) & (F.abs(x["x"] - a["x"] / b["x"]) <= 0.02 * a["x"] / b["x"])
    return let(at, lambda n: F.exists(n, lambda x: F.exists(n, lambda a: F.exists(n, lambda b: fits(x, a, b)))))


def fact_ratio(messages: Column, params: Column) -> Column:
    """At least two grounded links, a ratio that follows from the stated numbers, 1 to 200 words."""
    return _cited(messages, params, 2, "cited_two_grounded_sources", 200, lambda c: {"ratio_internally_consistent": ratio_consistent(c)})


#: Task verifiers by template id, and lane verifiers: all of a lane's must pass.
BY_TEMPLATE: dict[str, Callable[[Column, Column], Column]] = {
    "audit.batch_consistency": batch_consistency,
    "count.tagged_count": tagged_count,
    "files.save_note": save_note,
    "refactor.rename_patch": rename_patch,
    "revise.exact_lines": exact_lines,
    "terminal.calc_note": calc_note,
    "vault.linked_note": linked_note,
    "web.compare_sources": compare_sources,
    "webmath.fact_ratio": fact_ratio,
}


#: Ids of the lane verifiers; those of tasks follow from their templates.
VERIFIER_IDS = {"b": "scenes/scene_wellformed", "c": "selfplay/no_impersonation+selfplay/turn_dynamics", "d": "streams/stream_wellformed"}


def verified(records: DataFrame, out: str) -> DataFrame:
    """Adds the result of the verifiers that a record's lane or template asks for, with their ids; null where a template of lane a is unknown (an error for the gate).

    Each verifier is a column of its own, so that the analyzer never meets them in one expression.
    """
    lane, template, detail = F.col("provenance.lane"), F.col("provenance.template_id"), F.col("provenance.source.detail_json")
    m = F.col("messages")
    df = records.withColumn("_params", F.from_json(F.get_json_object(detail, "$.params"), "map<string,string>"))
    checks = {"_b": (lane == "b", scene_wellformed(m, F.col("system"))), "_d": (lane == "d", stream_wellformed(m, F.col("provenance.family"), F.get_json_object(detail, "$.source"))), "_c1": (lane == "c", no_impersonation(m)), "_c2": (lane == "c", turn_dynamics(m))}
    checks |= {f"_a{i}": ((lane == "a") & (template == name), check(m, F.col("_params"))) for i, (name, check) in enumerate(BY_TEMPLATE.items())}
    for name, (when, check) in checks.items():
        df = df.withColumn(name, F.when(when, check))
    with_id = lambda name, label: F.when(F.col(name).isNotNull(), F.struct(f"{name}.passed", f"{name}.failed", F.lit(label).alias("verifier_id")))
    both = F.when(lane == "c", F.struct((F.col("_c1.passed") & F.col("_c2.passed")).alias("passed"), F.concat("_c1.failed", "_c2.failed").alias("failed"), F.lit(VERIFIER_IDS["c"]).alias("verifier_id")))
    of_tasks = [with_id(f"_a{i}", f"tasks/{name.replace('.', '/')}") for i, name in enumerate(BY_TEMPLATE)]
    return df.withColumn(out, F.coalesce(with_id("_b", VERIFIER_IDS["b"]), with_id("_d", VERIFIER_IDS["d"]), both, *of_tasks)).drop("_params", *checks)
