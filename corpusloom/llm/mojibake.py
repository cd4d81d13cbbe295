"""Text garbled by a wrong character encoding (problem 4).

A hidden Markov model labels the characters: one clean state, one state for each encoding pair and one for losses. Pairs are UTF-8 bytes
that were read as some one-byte encoding, and Cyrillic, Greek, Chinese or Japanese bytes that were read as Western. A pair's state emits the characters that stand for the
bytes of one UTF-8 character, or of one word of the other encodings, at a cost that depends on what they encode; the clean state emits each
character at a cost that depends on how odd it is beside its neighbours. ASCII is the same in every state, so a run of it is one step. Viterbi finds
the cheapest labelling, each labelled span gets its state's inverse transform, and the whole is repeated until nothing
changes, as texts may be garbled any number of times: every round makes the text shorter, or rids it of candidates.

The costs are negative log probabilities by character class; no state but the clean one can emit anything in a text without a
byte sequence of some pair, so only texts with one are decoded.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: One-byte encodings in which UTF-8 bytes were read.
ENCODINGS = ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1251")
ENTER, LEAVE = 3.0, 0.5
LOST = "lost"


def _table(encoding: str) -> dict[str, int]:
    """Character to byte (0x80 up); bytes that the encoding leaves undefined stand for the C1 character of the same number."""
    out = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            c = chr(b)
        out.setdefault(c, b)
    return out


TABLES = {e: _table(e) for e in ENCODINGS}


def _pattern(table: dict[str, int]) -> str:
    cls = lambda lo, hi: "[" + "".join(re.escape(c) for c, b in table.items() if lo <= b <= hi) + "]"
    t = cls(0x80, 0xBF)
    return f"{cls(0xC2, 0xDF)}{t}|{cls(0xE0, 0xEF)}{t}{t}|{cls(0xF0, 0xF4)}{t}{t}{t}"


#: Encodings whose bytes were read as a Western one, by the Western one; their vowels tell words from chance.
READ_AS = {("cp1251", "cp1252"): "аеёиоуыэюяієї", ("koi8-r", "cp1252"): "аеёиоуыэюя", ("cp1253", "cp1252"): "αεηιουωάέήίόύώϊϋ", ("gb2312", "cp1252"): "", ("shift_jis", "cp1252"): ""}
#: A lone first byte whose second, a no-break space, became a plain blank: it stood for the letter a with grave.
BARE = re.compile(r"(?<![^\s'’])Ã(?=\s)")
#: Words of a double-byte or one-byte encoding read as Western: runs without any ASCII letter beside them.
_RUN = re.compile(r"(?<![A-Za-z0-9])[^\x00-\x7f\xa0]{1,}(?![A-Za-z0-9])")
CANDIDATE = re.compile("|".join([*(_pattern(t) for t in TABLES.values()), "[\x80-\x84\x86-\x9f�]", BARE.pattern, "[\xa1-\xff]{4}", "(?:[‚ƒ][^\x00-\x7f]){2}"]))


@lru_cache(maxsize=65536)
def _kind(c: str) -> str:
    """Class of a character for the emission costs."""
    o = ord(c)
    if o < 128:
        return "upper" if c.isupper() else "lower" if c.isalpha() else "space" if c.isspace() else "ascii"
    if o == 0xFFFD:
        return "lost"
    if 0x80 <= o <= 0x9F:
        return "control"
    if 0x0400 <= o <= 0x04FF:
        plain = "а" <= c <= "я" or "А" <= c <= "Я" or c in "ёЁ"
        return ("cyr" if plain else "cyr_rare") + ("_up" if c.isupper() else "_low")
    if 0x0370 <= o <= 0x03FF:
        return "greek_up" if c.isupper() else "greek_low"
    if c.isalpha():
        if o > 0x024F:
            return "script"
        if c in "ªº":
            return "mark"
        return "latin_up" if c.isupper() else "latin_low"
    if 0x2500 <= o <= 0x259F or o in (0xF8FF, 0xAD):
        return "box"
    if o == 0xA0:
        return "space"
    if c in "’‘“”–—…«»¡¿":
        return "quote"
    return "symbol"


def _script(kind: str) -> str:
    return "cyr" if kind.startswith("cyr") else "greek" if kind.startswith("greek") else "script" if kind == "script" else "latin" if kind in ("upper", "lower", "latin_up", "latin_low") else ""


class Words:
    """The words around the positions of a text, each looked at once."""

    def __init__(self, text: str):
        self.text, self.at, self.known = text, {}, {}
        self.latin = sum(c.isascii() and c.isalpha() for c in text) >= 3

    def around(self, i: int) -> tuple[int, int]:
        """Bounds of the word around position ``i``."""
        if i not in self.at:
            text = self.text
            a = b = i
            while a and not text[a - 1].isspace():
                a -= 1
            while b < len(text) and not text[b].isspace():
                b += 1
            for k in range(a, max(b, i + 1)):
                self.at[k] = a, b
        return self.at[i]

    def facts(self, i: int) -> tuple[bool, bool]:
        """Whether the word around position ``i`` is written in capitals, and whether it is foreign: without any ASCII letter or digit and short, or of Latin letters with marks, in a text of ASCII letters."""
        a, b = self.around(i)
        if (a, b) not in self.known:
            w = self.text[a:b]
            capitals = not any("a" <= c <= "z" for c in w) and sum("A" <= c <= "Z" for c in w) >= 2
            plain = any(c.isascii() and c.isalnum() for c in w)
            self.known[a, b] = capitals, bool(w) and not plain and self.latin and (len(w) <= 4 or any(_script(_kind(c)) == "latin" for c in w))
        return self.known[a, b]


def letters_beside(text: str, i: int) -> bool:
    """Whether a neighbour of position ``i`` is a letter."""
    return text[i - 1 : i].isalpha() or text[i + 1 : i + 2].isalpha()


def clean_cost(text: str, i: int, words: Words) -> float:
    """Cost of position ``i`` in the clean state: how odd the character is beside its neighbours."""
    k = _kind(text[i])
    if k in ("upper", "lower", "ascii", "space"):
        return 0.0 if text[i] != "\xa0" else 1.0
    if k in ("latin_low", "latin_up", "symbol", "box") or k.startswith(("cyr", "greek")):
        return _odd_cost(text, i, k, words) + (1.0 if words.facts(i)[1] else 0.0)
    return _odd_cost(text, i, k, words)


def _odd_cost(text: str, i: int, k: str, words: Words) -> float:
    before = _kind(text[i - 1]) if i else "space"
    after = _kind(text[i + 1]) if i + 1 < len(text) else "space"
    if k in ("control", "lost"):
        return 9.0
    if k == "box":
        return 5.0
    last, bare = text[i + 1 : i + 2], not text[i + 1 : i + 2].isascii()
    letters = (_script(before), _script(after))
    if text[i] == "ƒ":
        return 6.0 if letters_beside(text, i) else 2.0
    if k == "latin_low":
        if words.facts(i)[0]:
            return 5.0
        odd = after in ("symbol", "box", "control", "cyr_rare_up") or (after == "quote" and text[i] in "âãðïåäæç")
        return 4.0 if odd or letters[0] in ("cyr", "greek") or letters[1] in ("cyr", "greek") else 1.0
    if k == "latin_up":
        if words.facts(i)[0]:
            return 1.0
        if after in ("symbol", "box", "control", "mark", "latin_up") or last == "\xa0" or (after == "quote" and before != "upper") or (text[i] == "Ã" and before == after == "space"):
            return 5.0
        return 5.0 if before in ("lower", "latin_low") or letters[0] in ("cyr", "greek") else 1.5
    if k.startswith("cyr") or k.startswith("greek"):
        mixed = any(s and s != k[: len(s)] for s in letters)
        hump = k.endswith("_up") and before.endswith("_low")
        rare = 2.0 if "rare" in k else 0.0
        lone = words.facts(i)[1] and (last == "\xa0" or before == "space") and not after.startswith(("cyr_low", "greek_low"))
        return 0.5 + 4.5 * mixed + 3.5 * hump + rare + 2.0 * (after in ("symbol", "box", "control")) + 3.0 * lone
    if k == "script":
        return 0.5
    glued = bool(letters[0]) and bool(letters[1])
    if k == "quote":
        return 0.5 if text[i] == "’" or not glued else 4.0
    if k == "mark":
        return 1.0 if not glued else 3.0
    return (6.0 if glued else 3.5 if letters[0] else 1.0) + (3.0 if last and bare and after != "space" else 0.0)


def coded_cost(c: str, i: int, words: Words) -> float:
    """Cost of a character that positions from ``i`` would encode."""
    k = _kind(c)
    if k == "control":
        return 4.0
    if c == "ƒ":
        return 1.0
    if k == "latin_low":
        return 5.0 if words.facts(i)[0] else 1.0
    if k in ("latin_up", "cyr_rare_up", "cyr_rare_low"):
        return 1.5
    if k == "script" and unicodedata.name(c, "").split(" ")[0] not in ("CJK", "HIRAGANA", "KATAKANA", "HANGUL", "ARABIC", "HEBREW", "LATIN", "THAI", "DEVANAGARI"):
        return 5.0
    if unicodedata.category(c) in ("Cn", "Co", "Cs", "Mn") and c != "\ufe0f":
        return 6.0
    return 1.0


def units(text: str, encoding: str, places: list[int], words: Words) -> dict[int, tuple[int, str, float]]:
    """Positions where the bytes of a UTF-8 character begin under ``encoding``: length, the character and its cost. ``places`` are the positions beyond ASCII."""
    t = TABLES[encoding]
    out = {}
    for i in places:
        b = t.get(text[i], 0)
        n = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 0
        if n and i + n <= len(text):
            try:
                rest = text[i + 1 : i + n]
                # in a longer sequence a no-break space may have become a plain blank
                c = bytes([b, *(0xA0 if x == " " and n > 2 else t[x] for x in rest)]).decode("utf-8")
                out[i] = n, c, coded_cost(c, i, words)
            except (KeyError, UnicodeDecodeError):
                pass
    if encoding in ("cp1252", "latin-1"):
        out |= {m.start(): (1, "à", coded_cost("à", m.start(), words)) for m in BARE.finditer(text) if m.start() not in out}
    return out


def _likely_word(word: str, vowels: str) -> bool:
    """Whether decoded bytes make a word: one script, no capital inside, vowels among the letters."""
    low = word.lower()
    if not word.isalpha() or not (word.islower() or word.isupper() or (word[0].isupper() and word[1:].islower())):
        return False
    if len({_script(_kind(c)) for c in word}) > 1 or any(_kind(c).startswith("cyr_rare") and c not in "іїєІЇЄ" for c in word):
        return False
    share = sum(c in vowels for c in low) / len(word)
    return len(word) < 3 or 0.22 <= share <= 0.8


def word_units(text: str, true: str, read: str, vowels: str) -> dict[int, tuple[int, str, float]]:
    """Positions where a word of the encoding ``true`` begins that was read as ``read``: length, the word and its cost."""
    t, out = TABLES[read], {}
    for m in _RUN.finditer(text):
        w = m.group().strip("«»“”…—–¿¡")
        a = m.start() + m.group().find(w) if w else 0
        if not w or any(c not in t for c in w):
            continue
        try:
            word = bytes(t[c] for c in w).decode(true)
        except UnicodeDecodeError:
            continue
        if vowels and _likely_word(word, vowels):
            out[a] = len(w), word, 1.5
        elif not vowels and len(word) >= 2 and all("ぁ" <= c <= "ヺ" or "一" <= c <= "鿿" or c in "、。ー！？，" for c in word) and (true != "shift_jis" or any("ぁ" <= c <= "ヺ" for c in word)):
            out[a] = len(w), word, 1.4 * len(word)
    return out


def label(text: str) -> list[tuple[int, int, str, str | None]]:
    """Cheapest labelling: garbled units ``(start, end, state, restored or None)`` in order. Linear in the text."""
    n, words = len(text), Words(text)
    places = [i for i, c in enumerate(text) if not c.isascii()]
    found = {e: u for e in ENCODINGS if (u := units(text, e, places, words))}
    found |= {f"{true} as {read}": u for (true, read), v in READ_AS.items() if (u := word_units(text, true, read, v))}
    # what no unit covers, and no loss, is clean on every path: only the rest is weighed
    odd = bytearray(n)
    for u in found.values():
        for a, (k, *_) in u.items():
            odd[a : a + k] = b"\1" * k
    for i in places:
        if text[i] == "�" or "\x80" <= text[i] <= "\x9f":
            odd[i] = 1
    best: dict[int, dict[str, tuple[float, int, str, str | None]]] = {0: {"": (0.0, -1, "", None)}}  # position -> state -> (cost, position and state before, what it stands for)

    def go(here: dict, i: int, j: int, state: str, step: float, stands_for: str | None) -> None:
        # from the same state for free, from the clean one by ENTER, to the clean one by LEAVE
        there = best.setdefault(j, {})
        for s, (cost, *_) in here.items():
            total = cost + step + (0.0 if s == state else (LEAVE if s else 0.0) + (ENTER if state else 0.0))
            if state not in there or (total, s) < (there[state][0], there[state][2]):
                there[state] = total, i, s, stands_for

    i = 0
    while i < n:
        here = best.get(i)
        if not here:
            i += 1
            continue
        if not odd[i]:
            j = odd.find(1, i)
            j = n if j < 0 else j
            if not text[i:j].isascii():
                cost, s = min((v[0] + (LEAVE if s else 0.0), s) for s, v in here.items())
                best.setdefault(j, {})[""] = cost, i, s, None
                i = j
                continue
        c = text[i]
        if c.isascii():  # a run of ASCII costs nothing in any state
            j = i + 1
            while j < n and text[j].isascii() and j not in best and odd[j] == odd[i]:
                j += 1
            for s, (cost, *_) in here.items():
                there = best.setdefault(j, {})
                if s not in there or cost < there[s][0]:
                    there[s] = cost, i, s, None
            i += 1 if odd[i] else j - i
            continue
        go(here, i, i + 1, "", clean_cost(text, i, words), None)
        if c == "�" or "\x80" <= c <= "\x9f":
            go(here, i, i + 1, LOST, 2.0, None)
        for e, u in found.items():
            if i in u:
                k, stands_for, cost = u[i]
                go(here, i, i + k, e, cost, stands_for)
        i += 1
    out = []
    at, state = n, min((v[0] + (LEAVE if s else 0.0), s) for s, v in best[n].items())[1]
    while at > 0:
        _, before, previous, stands_for = best[at][state]
        if state == LOST and not text[before].isascii():
            out.append((before, at, LOST, None))
        elif stands_for is not None:
            out.append((before, at, state, stands_for))
        at, state = before, previous
    return out[::-1]


def repair(text: str | None) -> tuple[bool, str | None, bool, int]:
    """Whether a text is garbled, its restored form, whether anything was lost, and the number of layers undone, until none is left."""
    garbled, layers = False, 0
    while text and CANDIDATE.search(text):
        spans = label(text)
        garbled |= bool(spans)
        spans = [s for s in spans if s[3] is not None]
        if not spans:
            break
        parts, at = [], 0
        for a, b, _, chars in spans:
            parts += [text[at:a], chars]
            at = b
        text, layers = "".join(parts) + text[at:], layers + 1
    return garbled, text, bool(text) and "�" in text, layers


def garbled_texts(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, restored, lossy, layers`` of each row whose text is garbled in whole or in part.

    ``restored`` equals the text as it was written where nothing was lost; replacement characters stay
    and make ``lossy`` true. Null, empty and ASCII texts are never garbled. Repeated rows are judged each for itself; no shuffle.
    """
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, restored, lossy, layers = [], [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                if CANDIDATE.search(t):
                    bad, s, lost, n = repair(t)
                    if bad:
                        keep.append(i)
                        restored.append(s)
                        lossy.append(lost)
                        layers.append(n)
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(keep, pa.int64())), pa.array(restored, pa.string()), pa.array(lossy, pa.bool_()), pa.array(layers, pa.int32())], names=["key", "restored", "lossy", "layers"])

    odd = rows.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").rlike(r"[^\x00-\x7f]"))
    return odd.mapInArrow(run, f"key {kind}, restored string, lossy boolean, layers int").withColumnRenamed("key", key)
