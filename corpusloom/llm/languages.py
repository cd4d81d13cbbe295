"""The language of short texts: function words, scripts, and character trigrams learned from the corpus.

Function words name the language of texts that hold enough of them. From those texts of the corpus itself the frequencies of hashed
character trigrams are learned for each language; the profile (languages x 16,384 numbers, a fixed size) then names the
language of short and odd texts too. Nothing in the profile is fitted by hand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W\d_]+")
_CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
#: Letters of other scripts than Latin.
_BEYOND = re.compile(r"[\u0370-\u1fff\u2c00-\u2dff\u3040-\ud7ff\uf900-\ufaff\U00010000-\U0001f0ff\U00020000-\U000323af]")
_KANA = re.compile(r"[぀-ヿ]")

# Closed-class words (articles, pronouns, prepositions, conjunctions, auxiliaries, particles) by language.
FUNCTION_WORDS = {
    "en": "a an the and or but nor if then than that this these those of to in on at by for from with without into onto about over under between after before during through until is are was were be been being am do does did have has had having will would shall should can could may might must not no so as because while when where who whom whose which what why how i you he she it we they me him her us them my your his its our their there here up down out off again once only very too also just both each either neither any some",
    "de": "der die das den dem des ein eine einen einem einer eines und oder aber denn sondern nicht kein keine keinen ist sind war waren bin bist sein wird werden wurde hat habe haben hatte kann können muss müssen soll will ich du er sie es wir ihr mich dich sich uns mir dir ihm ihn ihnen mein dein unser für auf aus im in von zu zum zur an am bei mit nach vor über unter durch gegen ohne um wie was wer wann wo wenn weil dass ob als auch nur noch schon so dann hier da doch ja mal sehr man",
    "fr": "le la les l un une des du de d et ou mais donc ni car ne n pas plus est sont était sera suis es a ai as ont avait avoir être je j tu il elle on nous vous ils elles me m te t se s moi toi lui leur mon ma mes ton ta tes son sa ses notre votre nos vos ce c cet cette ces ça cela qui que qu quoi dont où quand comment pourquoi si avec sans pour par sur sous dans en à au aux chez vers entre après avant très aussi bien y",
    "es": "el la los las lo un una unos unas y e o u pero sino ni no es son era eran fue está están estoy ser estar ha he han hay había haber yo tú él ella nosotros ellos ellas usted ustedes me te se le les nos mi mis tu tus su sus nuestro este esta esto ese esa eso aquel que qué quien quién cuando cuándo donde dónde como cómo porque por para con sin sobre entre hasta desde de del al a en ante muy más menos también ya sí si",
    "pt": "o os a as um uma uns umas e ou mas nem não é são era foi está estão estou ser estar há tem tenho ter eu tu você ele ela nós eles elas me te se lhe nos meu minha seu sua teu tua este esta isto esse essa isso aquele que quem quando onde como porque por para com sem sobre entre até desde de do da dos das em no na nos nas ao à pelo pela muito mais menos também já sim",
    "it": "il lo la i gli le un uno una e ed o ma né non è sono era erano sei ho hai ha abbiamo hanno avere essere io tu lui lei noi voi loro mi ti si ci vi mio mia tuo tua suo sua questo questa quello quella che chi cosa quando dove come perché per con senza su tra fra fino di del della dei delle da dal dalla in nel nella a al alla ai molto più meno anche già sì se",
    "nl": "de het een en of maar want niet geen is zijn was waren ben bent heb hebt heeft had kan kunnen moet moeten zal zou ik jij je u hij zij ze wij we jullie mij me jou hem haar ons hun mijn jouw dit dat deze die wie wat waar wanneer hoe waarom voor van op aan in uit bij met naar over onder door tegen zonder om te er ook nog al wel dan als omdat",
    "pl": "i a oraz lub ale nie jest są był była było być mam masz ma mieć ja ty on ona ono my wy oni mnie mi cię ci go jej jego ich się mój moja twój swój ten ta to te tam tu tak że żeby bo jak co kto gdzie kiedy dlaczego czy w we z ze na do od po przy przez pod nad za o u dla bez już jeszcze tylko bardzo też",
}
NAMES = tuple(FUNCTION_WORDS)
LANGUAGES_OF: dict[str, list[int]] = {}
for _k, _words in enumerate(FUNCTION_WORDS.values()):
    for _w in dict.fromkeys(_words.split()):
        LANGUAGES_OF.setdefault(_w, []).append(_k)

BITS = 14
#: A text teaches if so many function words name its language, and twice as many as any other.
TEACHING_WORDS = 4
#: Added to the count of every trigram of a language.
SMOOTHING = 0.05
#: Log-likelihood margin, in all and for each trigram, that names a language by the profile.
MARGIN, MARGIN_EACH = 2.5, 0.08
#: Log odds that an answer is in the language of its question: one in fifty is not.
PRIOR = 4.0


def by_script(text: str) -> str | None:
    """The language of a text in another script; null for Latin letters."""
    if text.isascii() or not _BEYOND.search(text):
        return None
    letters = [c for c in text if c.isalpha()]
    other = [c for c in letters if ord(c) > 0x2FF]
    if not letters or 2 * len(other) <= len(letters):
        return None
    if _KANA.search(text):
        return "ja"
    return "zh" if _CJK.search(text) else "ru" if any("Ѐ" <= c <= "ӿ" for c in other) else "other"


def function_scores(words: list[str]) -> list[float]:
    """Function words of each language; a word of several languages is shared among them."""
    score = [0.0] * len(NAMES)
    for w in words:
        for k in LANGUAGES_OF.get(w, ()):
            score[k] += 1 / len(LANGUAGES_OF[w])
    return score


def by_function_words(text: str, least: float = TEACHING_WORDS) -> str | None:
    """The language by script, or by at least ``least`` function words, twice as many as of any other; else null."""
    script = by_script(text)
    if script:
        return script
    score = function_scores(_WORD.findall(text.lower()))
    first, second = sorted(score, reverse=True)[:2]
    return NAMES[score.index(first)] if first >= least and first >= 2 * second else None


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the letters of a text in lower case; runs of anything else count as one blank."""
    t = " " + " ".join(_WORD.findall(text.lower())) + " "
    c = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h = (c[:-2] * np.uint64(0x9E3779B1) + c[1:-1]) * np.uint64(0x85EBCA77) + c[2:] if len(c) > 2 else np.empty(0, np.uint64)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


class Profile:
    """Log likelihoods of the trigrams, ``(2**14, languages)``, of the languages that the corpus teaches."""

    def __init__(self, counts: np.ndarray):
        taught = np.flatnonzero(counts.sum(axis=1))
        self.names = [NAMES[k] for k in taught]
        share = (counts[taught] + SMOOTHING) / (counts[taught].sum(axis=1, keepdims=True) + SMOOTHING * counts.shape[1])
        # against a uniform draw of trigrams: a language with little text says little of anything it has not seen
        self.table = np.ascontiguousarray(np.log(share * counts.shape[1]).T.astype(np.float32))

    def name(self, text: str, likely: str | None = None) -> str | None:
        """The language of a text: by script, by the trigrams with enough margin, by function words, or null without evidence. A ``likely`` language has prior odds."""
        script = by_script(text)
        if script:
            return script
        if self.names:
            g = trigrams(text)
            score = self.table[g].sum(axis=0).tolist()
            if likely in self.names:
                score[self.names.index(likely)] += PRIOR
            first = max(score)
            second = sorted(score)[-2] if len(score) > 1 else 0.0
            if first > 0 and first - second >= max(MARGIN, MARGIN_EACH * len(g)):
                return self.names[score.index(first)]
        return by_function_words(text, 1)


#: Names languages by script and function words alone.
UNTAUGHT = Profile(np.zeros((len(NAMES), 1 << BITS)))


def learn(texts: DataFrame, text: str = "text") -> Profile:
    """Trigram profile from the rows whose language function words name. What reaches the driver is at most languages x 16,384 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(NAMES) << BITS, np.int64)
        for b in batches:
            at = [trigrams(t) + (NAMES.index(lang) << BITS) for t in b.column(0).to_pylist() if t and (lang := by_function_words(t)) in FUNCTION_WORDS]
            if at:
                counts += np.bincount(np.concatenate(at), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    counts = np.zeros(len(NAMES) << BITS)
    for r in texts.select(F.col(text)).mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["at"]] = r["n"]
    return Profile(counts.reshape(len(NAMES), -1))
