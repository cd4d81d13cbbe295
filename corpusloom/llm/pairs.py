"""Broken prompt and response pairs (problem 1).

Each side's answer (without ChatML marks and think block) is compared with the user's turn. Copies: if the word shingles of one
contain enough of the other, a bit-parallel longest common subsequence measures how much of each is covered, however often the turn is given back. Refusals: each
of the answer's sentences, without what it quotes, is aligned by the same subsequence against refusal templates. Language: scripts and character
trigrams learned from turns and answers (``languages``). Truncation: open structures, a missing end mark, and last words that hardly
ever end a line or sentence in other answers and are not shared by enough unrelated answers (``endings``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.endings import END, END_SHARE, LINE, LINE_SHARE, OTHER_LINES, OTHER_WORDS, REMARK, WORD_SHARE, end_key, ending, enough, evidence, last_word, line_key, remark_key, sketch, vote_counts
from corpusloom.llm.languages import Profile, learn
from corpusloom.session import cut

_TURN = re.compile(r"<\|im_start\|>(\w*)\n?(.*?)(?=<\|im_start\|>|$)", re.DOTALL)
_THINK = re.compile(r"<think>.*?(?:</think>|$)", re.DOTALL)
_CALLS = re.compile(r"<tool_call>.*?(?:</tool_call>|$)|<tool_response>.*?(?:</tool_response>|$)", re.DOTALL)
_WORD = re.compile(r"[^\W_]+")
_HIDDEN = re.compile("[\\s\\x1c-\\x1f​‌‍⁠﻿￼]+")
_QUOTED = re.compile(r"“[^”\"]*[”\"]|\"[^\"”]*[\"”]|«[^»]*»|„[^“”\"]*[“”\"]")
_CODE = re.compile(r"```.*?(?:```|$)|`[^`\n]*`|https?://\S+", re.DOTALL)

#: How an assistant declines, by language. Alignment allows for words in between.
REFUSALS = [
    t.split()
    for t in (
        "i can t help with|i cannot help with|i can t assist with|i cannot assist with|i won t answer that|i will not answer|i can t answer that|i m going to stay out of this|i am unable to|i m unable to|i must decline|i have to decline|"
        "i have to pass on this|my guidelines keep me from|beyond what i am permitted to|it would not be right for me to|i d rather not get into|i would rather not get into|i am not able to say anything|i m not able to help|"
        "question i have to leave unanswered|no help with will come from me|i can t discuss|i cannot provide|i can t provide|i m not allowed to|i am not allowed to|as an ai i can t|as an ai language model i|"
        "dabei kann ich nicht helfen|kann ich dir nicht helfen|kann ich ihnen nicht helfen|dazu darf ich nichts sagen|das beantworte ich nicht|möchte ich mich nicht äußern|diese frage lasse ich offen|muss ich ablehnen|muss ich leider ablehnen|ich muss ablehnen|ich muss das ablehnen|"
        "lasse ich unbeantwortet|von mir gibt es dazu keine|"
        "je ne peux pas vous aider|je ne peux pas t aider|je ne peux pas répondre|je préfère ne pas parler de|je dois refuser de répondre|je dois refuser|il m est impossible de|je laisse cette question sans réponse|je ne suis pas autorisé à|"
        "no puedo ayudar con|no puedo ayudarte|no puedo responder|prefiero no hablar de|debo rechazar esta|no me está permitido responder|dejo esa pregunta sin respuesta|me es imposible dar|no estoy autorizado a"
    ).split("|")
]
_ANCHOR = re.compile(
    r"(?i)\b(?:help|assist|answer|stay out|unable|decline|pass on|guidelines|permitted|not be right|rather not|able to say|unanswered|discuss|provide|allowed|as an ai|helfen|nichts sagen|beantworte|äußern|ablehnen|offen|unbeantwortet|keine|"
    r"aider|répondre|préfère|refuser|impossible|laisse|autorisé|ayudar|ayudarte|responder|prefiero|rechazar|permitido|respuesta|imposible|autorizado)\b"
)
#: Names of the languages in each other.
LANGUAGE_NAMES = {
    "en": "english englisch anglais inglés ingles",
    "de": "german deutsch allemand alemán aleman",
    "fr": "french französisch français francais francés frances",
    "es": "spanish spanisch espagnol español espanol castellano",
    "ja": "japanese japanisch japonais japonés",
    "it": "italian italienisch italien italiano",
    "pt": "portuguese portugiesisch portugais portugués",
    "pl": "polish polnisch polonais polaco",
    "nl": "dutch niederländisch néerlandais neerlandés",
    "ru": "russian russisch russe ruso",
}
_NAME_OF = {n: k for k, v in LANGUAGE_NAMES.items() for n in v.split()}
#: Pairs (about so many, by hash) whose turns and answers teach the language profile.
TEACHERS = 20_000
_ASKED = re.compile(r"(?i)\b(?:in|auf|en|into|to|ins|al)\s+(" + "|".join(_NAME_OF) + r")\b")
_WORDING = re.compile(r"(?i)\b(?:turns? down|declin\w+|say no|refus\w+|reject\w*|absag\w*|ablehn\w*|nein sag\w*|refuser|décliner|dire non|rechaz\w+|declinar|decir que no)\b")
#: An answer that words a message for somebody else.
_LETTER = re.compile(r"(?im)^\W*(?:dear|hi|hello|hey|liebe[rs]?|hallo|sehr geehrte\w*|ch(?:er|ère)|bonjour|estimad[oa]|querid[oa]|hola)\b.{0,40},\s*$|^.{0,60}(?:here is|you could (?:write|say)|du könntest|tu peux écrire|puedes escribir)\b.{0,60}[:.]\s*")


def lcs(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict[str, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for w in b:
        x = row & where.get(w, 0)
        row = ((row + x) | (row - x)) & full
    return len(a) - row.bit_count()


def user_turn(prompt: str | None) -> str:
    """The last user turn of a rendered prompt that is no tool response; a prompt without marks is its own turn."""
    turns = [t for r, t in _TURN.findall(prompt or "") if r == "user" and "<tool_response>" not in t]
    return (turns[-1] if turns else "" if "<|im_start|>" in (prompt or "") else prompt or "").replace("<|im_end|>", "").strip()


def answer_of(side: str | None) -> tuple[str, str, bool]:
    """The last assistant turn, all assistant turns (both without marks and think blocks), and whether the side ends with its end mark."""
    if side is None:
        return "", "", True
    turns = [t for r, t in _TURN.findall(side) if r == "assistant"] if "<|im_start|>" in side else [side]
    clean = [_THINK.sub("", t.replace("<|im_end|>", "")).strip() for t in turns]
    return (clean[-1] if clean else ""), "\n".join(clean).strip(), side.rstrip().endswith("<|im_end|>") or "<|im_start|>" not in side


def plain(text: str) -> str:
    """A text without tool calls, code, links and quotations; with its quotations if nothing else is left."""
    bare = _CODE.sub(" ", _CALLS.sub(" ", text))
    unquoted = _QUOTED.sub(" ", bare)
    return unquoted if _WORD.search(unquoted) else bare


def expected_language(turn: str, profile: Profile) -> str | None:
    """The language the user asks for, else that of the turn."""
    asked = _ASKED.findall(turn)
    return _NAME_OF[asked[-1].lower()] if asked else profile.name(plain(turn))


def is_copy(turn: str, answer: str) -> bool:
    """Whether an answer only gives back the turn, whole or barely changed, once or more often."""
    u, a = _WORD.findall(turn.lower()), _WORD.findall(_CALLS.sub(" ", answer).lower())
    if a and a[0] in ("question", "frage", "pregunta", "user", "q", "nutzer", "usuario", "utilisateur") and u[:1] != a[:1]:
        a = a[1:]
    if len(u) < 2:
        return bool(u) and bool(a) and set(a) == set(u)
    pairs = set(zip(u, u[1:]))
    if not a or (len(a) > 1 and pairs.isdisjoint(zip(a, a[1:]))):
        return False
    inside = sum(p in pairs for p in zip(a, a[1:]))
    if inside < 0.4 * max(1, len(a) - 1):
        return False
    times = max(1, round(len(a) / len(u)))
    common = lcs(u * times, a)
    return common >= 0.8 * len(a) and common >= 0.6 * len(u)


def refusal_sentences(answer: str) -> tuple[int, int]:
    """Number of sentences that decline and of all sentences, without quotations and block quotes; none of either without a word of refusals."""
    if not _ANCHOR.search(answer):
        return 0, 0
    text = _CALLS.sub(" ", answer)
    text = re.sub(r"(?m)^\s*>.*$", " ", text)
    text = _QUOTED.sub(" QUOTED ", text)
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if _WORD.search(p)]
    n = 0
    for p in parts:
        if _ANCHOR.search(p):
            ws = _WORD.findall(p.lower())
            if any(_aligned(t, ws) for t in REFUSALS):
                n += 1
    return n, len(parts)


def _aligned(template: list[str], ws: list[str]) -> bool:
    if sum(w in ws for w in template) < len(template) - (len(template) > 6):
        return False
    span = len(template) + 3
    need = len(template) - (len(template) > 6)
    return any(ws[i] == template[0] and lcs(template, ws[i : i + span]) >= need for i in range(len(ws)))


def defect_of(turn: str, side: str | None, profile: Profile, want: str | None) -> tuple[str | None, str]:
    """The defect of a side, or null, and the text whose ending is still to be judged (empty if it isn't); ``want`` is the language asked for."""
    last, whole, closed = answer_of(side)
    if not _HIDDEN.sub("", whole):
        return "empty", ""
    if is_copy(turn, last) or (whole != last and is_copy(turn, whole) and not _CALLS.search(whole)):
        return "copy", ""
    refusing, sentences = refusal_sentences(last)
    if refusing and not (_WORDING.search(turn) and (_LETTER.search(last) or sentences > 3 * refusing + 2)):
        return "refusal", ""
    if last.count("```") % 2 or last.count("<tool_call>") != last.count("</tool_call>") or not closed:
        return "truncated", ""
    got = profile.name(plain(last), want) if want else None
    return ("language" if want and got and want != got else None), last


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The user's turn and the last answers of each pair, without code and quotations."""
    for b in batches:
        out = [plain(user_turn(p)) for p in b.column("prompt_text").to_pylist()]
        out += [plain(answer_of(t)[0]) for c in ("chosen_text", "rejected_text") for t in b.column(c).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["text"])


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([answer_of(t)[0] for t in b.column("text").to_pylist()], pa.string())], names=["text"])


def broken_sides(pairs: DataFrame) -> DataFrame:
    """``pair_id, side, defect`` of each side of each pair that is no sound answer to the user's turn.

    A side has one defect, the first of: empty, copy, refusal, truncated, language. A null side is empty; a null prompt
    asks nothing, so neither copy nor language can be told. Repeated rows come out each for itself; an empty
    table gives no rows; other columns are ignored.
    """
    kind = pairs.schema["pair_id"].dataType.simpleString()
    base = pairs.select("pair_id", "prompt_text", "chosen_text", "rejected_text")
    # the profile is a classifier of its own: any sample of TEACHERS pairs, by hash, teaches it
    taught_by = F.pmod(F.xxhash64("pair_id"), F.lit(max(pairs.count(), 1))) < TEACHERS
    known_to_all = pairs.sparkSession.sparkContext.broadcast(learn(base.where(taught_by).mapInArrow(_texts, "text string")))
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
    names = ["side", "defect", "how", "end_key", "end_slot", "line_key", "line_slot", "word", "remark_key", "remark_slot", "sketch"]
    nothing = (None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profile = known_to_all.value
        for b in batches:
            out: list[tuple] = []
            for p, prompt, chosen, rejected in zip(*(b.column(c).to_pylist() for c in ("pair_id", "prompt_text", "chosen_text", "rejected_text"))):
                turn = user_turn(prompt)
                want = expected_language(turn, profile)
                for side, text in (("chosen", chosen), ("rejected", rejected)):
                    defect, answer = defect_of(turn, text, profile, want)
                    how, _, body = ending(answer) if answer else ("whole", False, "")
                    if how == "open":
                        word = last_word(body)
                        out.append((p, side, defect, how, *(end_key(body) or nothing), *(line_key(body) or nothing), word, *((remark_key(body) if word else None) or nothing), sketch(body)))
                    elif defect or how == "inside":
                        out.append((p, side, "truncated" if how == "inside" else defect, "known", *[None] * 8))
            cols = list(zip(*out)) if out else [[]] * 12
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [b.schema.field("pair_id").type, *types])], names=["pair_id", *names])

    rows = cut(base.mapInArrow(run, f"pair_id {kind}, side string, defect string, how string, end_key bigint, end_slot int, line_key bigint, line_slot int, word string, remark_key bigint, remark_slot int, sketch array<bigint>"))
    known = rows.where("how = 'known'").select("pair_id", "side", "defect")
    asked = rows.where("how = 'open'")
    lines = cut(vote_counts(asked.where("line_key is not null"), "line_key", OTHER_LINES).withColumnRenamed("votes", "line_n"))
    words = cut(vote_counts(asked.where("word is not null"), "word", OTHER_WORDS).withColumnRenamed("votes", "word_n"))
    of = lambda df, kind: df.select(F.col(f"{kind}_key").alias("key"), F.col(f"{kind}_slot").alias("slot"))
    keys = of(asked, "end").unionByName(of(asked.join(lines, "line_key", "left_semi"), "line")).unionByName(of(asked.join(words, "word", "left_semi"), "remark"))
    answers = cut(pairs.select(F.explode(F.array("chosen_text", "rejected_text")).alias("text")).mapInArrow(_answers, "text string"))
    repeated = answers.groupBy(F.xxhash64("text").alias("h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    rates = cut(evidence(answers, keys, (END, LINE, REMARK), repeated))
    on = lambda key, name: rates.select(F.col("key").alias(key), F.col("n_goes_on").alias(name))
    judged = asked.join(rates.select(F.col("key").alias("end_key"), "n_ends", F.col("n_goes_on").alias("end_on")), "end_key", "left")
    judged = judged.join(lines.join(on("line_key", "line_on"), "line_key", "left"), "line_key", "left").join(words, "word", "left").join(on("remark_key", "word_on"), "remark_key", "left")
    shared = enough(F.col("n_ends"), F.col("end_on"), 0, END_SHARE) | enough(F.col("line_n"), F.col("line_on"), OTHER_LINES, LINE_SHARE) | enough(F.col("word_n"), F.col("word_on"), OTHER_WORDS, WORD_SHARE)
    late = judged.select("pair_id", "side", F.when(~shared, F.lit("truncated")).otherwise(F.col("defect")).alias("defect")).where("defect is not null")
    return known.unionByName(late)
