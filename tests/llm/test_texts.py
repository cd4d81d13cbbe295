"""Garbled encodings, repetition, personal data, truncation, pairs, splits."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import endings, languages, mojibake, pairs, personal, repetition, splits, truncation

CLEAN = ["it’s 30° in the café today 🥵", "Ich glaube, die Köchin hat angerufen", "¿compraste piña? ¡qué bien!", "встретимся завтра у вокзала", "ご飯はとても美味しかったです", "gdzie jesteś? czekam już godzinę", "μην ξεχάσεις το κλειδί", "ça marche, à bientôt"]
TRAPS = ["na placa diz «MAÇû", "PARABÉNS, IRMÖ festa hoje!", "liguei para a IRMÅ\xa0e nada!", "NÃO acredito", "Ø", "½ price", "Её зовут Вёда", "“ok” — yes", "naïve façade", "поезд опять опаздывает", "2º B, 20°", "", "plain"]


def garble(text, encoding):
    back = {b: c for c, b in mojibake.TABLES[encoding].items()}
    return "".join(chr(b) if b < 128 else back.get(b, chr(b)) for b in text.encode())


@pytest.mark.parametrize("encoding", mojibake.ENCODINGS)
@pytest.mark.parametrize("text", CLEAN)
def test_round_trip(text, encoding):
    bad, restored, lossy, layers = mojibake.repair(garble(text, encoding))
    assert bad and restored == text and not lossy and layers >= 1


@pytest.mark.parametrize("text", CLEAN + TRAPS)
def test_clean_texts_stay(text):
    assert mojibake.repair(text)[:2] == (False, text)


def test_twice_and_partly_garbled():
    t = "façade – déjà vu"
    assert mojibake.repair(garble(garble(t, "cp1252"), "cp1252"))[1] == t
    assert mojibake.repair("✓ ok é " + garble("señor", "cp1252"))[1] == "✓ ok é señor"
    bad, restored, lossy, _ = mojibake.repair("the caf� is open")
    assert bad and lossy and restored == "the caf� is open"
    assert mojibake.repair(None) == (False, None, False, 0)


@pytest.mark.parametrize("layers", [2, 5, 7])
def test_any_number_of_layers(layers):
    t = "Grüße"
    for _ in range(layers):
        t = garble(t, "cp1252")
    assert mojibake.repair(t) == (True, "Grüße", False, layers)


@pytest.mark.parametrize("text,true,read", [("Привет мир, как дела", "cp1251", "latin-1"), ("Привет мир, как дела", "koi8-r", "latin-1"), ("Καλημέρα κόσμε", "cp1253", "latin-1"), ("你好世界", "gb2312", "latin-1"), ("こんにちは", "shift_jis", "cp1252")])
def test_other_bytes_read_as_western(text, true, read):
    assert mojibake.repair(text.encode(true).decode(read))[:2] == (True, text)


def test_long_texts_take_linear_time():
    began = time.perf_counter()
    bad, restored, _, _ = mojibake.repair("слово " * 20_000 + "«ГАЗ» " + garble("привет", "cp1252"))
    assert bad and restored.endswith("«ГАЗ» привет") and time.perf_counter() - began < 20


@pytest.mark.parametrize("garbled,want", [("NÃƒO acredito", "NÃO acredito"), ("NÃƒÆ’O acredito", "NÃO acredito"), ("klucza, proszƒô", "klucza, proszę"), ("IRMÃƒÆ’Ã¢â‚¬Â¦ e nada", "IRMÃ… e nada"), ("ã\x81\x8fã\x81 ã\x81•", "くださ"[:2] + "さ")])
def test_hard_cases(garbled, want):
    assert mojibake.repair(garbled)[:2] == (True, want)


def test_garbled_texts(spark):
    df = spark.createDataFrame([(1, garble(CLEAN[0], "mac_roman")), (2, None), (3, ""), (4, CLEAN[0]), (1, garble(CLEAN[0], "mac_roman"))], "row_id bigint, text string").selectExpr("*", "'x' as key", "1 as layers")
    got = mojibake.garbled_texts(df, "row_id").collect()
    assert [(r["row_id"], r["restored"]) for r in got] == [(1, CLEAN[0])] * 2
    assert mojibake.garbled_texts(df.limit(0), "row_id").count() == 0


def plain_share(text):
    import regex

    ws = regex.findall(r"\p{L}+", (text or "").lower())
    if len(ws) < 12:
        return 0.0
    seen, hit = set(), set()
    for i in range(len(ws) - 4):
        g = tuple(ws[i : i + 5])
        if g in seen:
            hit |= set(range(i, i + 5))
        seen.add(g)
    return len(hit) / len(ws)


def test_repeated_share_like_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", "one two", "a b c d e " * 3, "la " * 30, "x² y" * 9, "don't stop " * 8]
    for _ in range(120):
        base = [rng.choice("abcdefgh") for _ in range(rng.randrange(4, 60))]
        texts.append(rng.choice([" ", ", ", "\n"]).join(base[: rng.randrange(1, len(base))] + base))
    df = spark.createDataFrame(list(enumerate(texts)), "k bigint, text string").selectExpr("k", "text", "7 as share", "'n' as n_words")
    got = {r["k"]: r["share"] for r in repetition.repeated_content(df, ["k"]).collect()}
    assert got == {i: pytest.approx(plain_share(t)) for i, t in enumerate(texts)}
    assert repetition.repeated_content(df.limit(0), ["k"]).count() == 0


def test_distances_of_one_operator(spark):
    usual = ["it was the end of the road and we had to go to the house", "the house at the end of the road was not there and we did go", "and so it was that the road to the house had no end at all"]
    df = spark.createDataFrame(list(enumerate([*usual * 5, "the gold of the " * 20, None, "", "ok"])), "k bigint, text string")
    got = {r["k"]: r for r in repetition.repeated_content(df, ["k"]).collect()}
    assert got[15]["share"] > 0.9 and got[15]["word_distance"] > max(got[k]["word_distance"] for k in range(15)) and got[0]["lang"] == "en"
    assert all(got[k]["word_distance"] is None and got[k]["share"] == 0 for k in (16, 17, 18))
    same = np.array([[1.0, 2, 3]])
    assert repetition.js_distances(same, 2 * same)[0] < 1e-9 and repetition.js_distances(same, 0 * same)[0] == 1 and abs(repetition.js_distances(np.array([[1.0, 0]]), np.array([[0, 1.0]]))[0] - 1) < 1e-9


FOUND = {
    "mail anna.b+x@host.example now": {"email"},
    "write hugo (at) host.example": {"email"},
    "write hugo[at]host[dot]example": {"email"},
    "hello-x at kukil dot test again": {"email"},
    "X <mailto:ROSA@HOST.TEST> y": {"email"},
    "call (555) 012-5705": {"phone"},
    "ruf mich an: +49 30 23125 071": {"phone"},
    "llámame al 0034 999 861 368": {"phone"},
    "mon numéro: 01 99 00 96 24": {"phone"},
    "text 5550108364 if lost": {"phone"},
    "it rang from five five five four two three zero zero six zero": {"phone"},
    "ssn 902 30 6002": {"id_number"},
    "SSN: 963-86-7406": {"id_number"},
    "NI number QQ 89 55 14 A": {"id_number"},
    "passport no. X65018439": {"id_number"},
    "numéro fiscal 010 366 740 51": {"id_number"},
    "driving licence 0033 283 496 09": {"id_number"},
    "card 4111 1111 1111 1111": {"id_number"},
    "IBAN GB82 WEST 1234 5698 7654 32": {"id_number"},
    "the party is at 718 Upper Sezo Drive, Apt 38B": {"address"},
    "ich wohne Fuvuplatz 118a": {"address"},
    "on habite 174 bis rue Mihor": {"address"},
    "vivimos en Calle de la Porwor 37, 2º B": {"address"},
    "my landlord Maria Kelensson called": {"person"},
    "ask for Kesaetti, Stefan at the desk": {"person"},
    "I met Dr. Lorhiley at the fair": {"person"},
    "LAURA ZAVORWICK wants it": {"person"},
    "signed by J. Kelensson": {"person"},
    "Robert Gebehart, call +1 555 018 2656": {"person", "phone"},
}
NOT_FOUND = [
    "pkg@2.1.0 needs node 18", "@nightowl_77 liked it", "meet @ 5 by the gate", "info at the desk", "order 4471-88-20913 shipped", "it was 2024-05-11 or 2024-05-12", "only 1 200 300 views", "tracking RX 0014 2231 8 DE",
    "isbn 978-0-00-000000-2", "score was 555-540", "seat 12-34-5678 of the raffle", "flight XK 4410 at 18:25", "ref 2024-0187", "case 4471/88", "lot 900-12", "ticket #123456789 open", "room 204, Lower Court side", "the Kettle Inn",
    "Old Harbour House said so", "thanks Anna!", "Herr Ober, noch ein Kaffee!", "Mira Odile fährt los", "Bergen Books Ltd", "costs 555.90 now", '{"ok": true, "bytes": 2842}', "the corner of the market", "PERHAPS A MAN FROM UPSTREAM", "Hollow Brook called", "North Mill Ltd wants it", "",
]


@pytest.mark.parametrize("text", FOUND)
def test_personal_found(text):
    assert {k for _, _, k in personal.find_personal(text)} == FOUND[text]


@pytest.mark.parametrize("text", NOT_FOUND)
def test_personal_not_found(text):
    assert personal.find_personal(text) == []


def test_redacted_text(spark):
    df = spark.createDataFrame([(1, "Mail a@b.example or 555-014-4938, says Mr Lorhiley."), (2, None), (3, ""), (4, "nothing"), (5, "x " * 50000 + "a@b.example")], "k bigint, text string").selectExpr("k", "text", "'c' as kinds", "1 as redacted")
    names = spark.createDataFrame([("Zorro",), (None,)], "given_name string")
    got = {r["k"]: r for r in personal.personal_data(df, ["k"], given_names=names, redacted=True).collect()}
    assert set(got) == {1, 5} and got[1]["redacted"] == "Mail [EMAIL] or [PHONE], says [PERSON]." and got[1]["kinds"] == ["email", "phone", "person"]
    assert got[5]["redacted"].endswith("[EMAIL]")
    assert personal.personal_data(df.limit(0), ["k"]).count() == 0


def test_given_names_of_any_number(spark):
    """Beyond the bound names are joined with the texts instead of sent; the result is the same."""
    df = spark.createDataFrame([(1, "ask Zorro Kelensson at the desk"), (2, "ask Zorro Kelensson at the desk"), (3, "Yuzu Kelensson came"), (4, None)], "k bigint, text string")
    names = spark.createDataFrame([("Zorro",), ("yuzu ",), ("Xara",), (None,)], "given_name string")
    both = [sorted((r["k"], r["redacted"]) for r in personal.personal_data(df, ["k"], given_names=names, redacted=True, sent_names=n).collect()) for n in (100, 1)]
    assert both[0] == both[1] and [k for k, _ in both[0]] == [1, 2, 3]


def test_validators():
    assert personal.luhn("4111111111111111") and not personal.luhn("4111111111111112")
    assert personal.mod97("GB82 WEST 1234 5698 7654 32") and not personal.mod97("GB83 WEST 1234 5698 7654 32")
    assert personal.dni_letter("00000000T") and not personal.dni_letter("00000000A")


def test_ending_kinds():
    assert endings.ending("All done.")[0] == "whole" and endings.ending("said “yes.”")[0] == "whole" and endings.ending("see https://a.example/x")[0] == "whole"
    assert endings.ending("x<|im_end|>\n")[:2] == ("whole", False) and endings.ending("and then he…")[1] is True
    assert endings.ending("one two three four,")[0] == "inside" and endings.ending("they left for the")[0] == "inside"
    assert endings.ending("<|im_start|>user\nthey left for home")[0] == "inside" and endings.ending('{"ok": true, "no')[0] == "inside"
    assert endings.ending("they left for the stat")[0] == "open" and endings.end_key("a b\nthey left 42 Hens") == endings.words_key(["left", "0", "hens"], endings.END)
    assert endings.split_mark("and so" + "." * 200) == ("and so", True) and endings.split_mark("and so [ ... ]  ") == ("and so", True) and endings.split_mark("and [so]") == ("and [so]", False)
    assert endings.terminal("see https://a.example/" + "x" * 400) and endings.terminal("Yes." + "”)" * 200) and not endings.terminal("a.b")


def test_places_like_plain_scan():
    """Ends and goings-on of all word sequences, against a scan by hand; long lines and long words are read whole."""
    text = "The old house is here. And so it was\n" + "the old lighthouse stood " * 40 + "\nend of " + "w" * 300 + "\nlast line"
    _, keys, goes = endings.Places()([None, "", text], np.ones(1 << 22, bool), np.ones(1 << 22, bool), (endings.END, endings.LINE, endings.REMARK))
    got = {}
    for k, g in zip(keys.tolist(), goes.tolist()):
        got.setdefault(k, set()).add(g)
    of = lambda words, kind: got.get(endings.words_key(words.split(), kind)[0])
    assert of("the old house", endings.END) == {True} and of("house is here", endings.END) == {False} and of("the old light", endings.END) == {True}
    assert of("so it was", endings.END) == {False} and of("lighthouse stood", endings.END) is None and of("old lighthouse stood", endings.END) == {True, False}
    assert of(("the old lighthouse stood " * 40).strip(), endings.LINE) == {False} and of("and so it was", endings.REMARK) == {False}
    assert of("end of " + "w" * 300, endings.END) == {False} and of("end of " + "w" * 299, endings.END) == {True} and of("last line", endings.LINE) is None


def test_evidence_counts_distinct_texts(spark):
    rows = [("we met at the gate\nmore",), ("we met at the gate\nmore",), ("at the gate. More",), ("at the gates of\nmore",), ("at the gate we met",), (None,), ("",)]
    key, slot = endings.words_key("at the gate".split(), endings.END)
    texts, asked = spark.createDataFrame(rows, "text string"), spark.createDataFrame([(key, slot), (None, None), (5, 7)], "key bigint, slot int")
    repeated = texts.groupBy(F.xxhash64("text").alias("h")).count().where("count > 1").select("h")
    got = endings.evidence(texts, asked, (endings.END,), repeated).collect()
    assert [(r["key"], r["n_ends"], r["n_goes_on"]) for r in got] == [(key, 2, 2)]


def documents(spark):
    rng = random.Random(8)
    sentence = lambda: " ".join(rng.choice("red green blue violin market harbour lamp winter crooked pale".split()) for _ in range(rng.randrange(5, 12))).capitalize() + "."
    rows, cut = [], set()
    for i in range(600):
        text = " ".join(sentence() for _ in range(rng.randrange(3, 40)))
        source = f"s{i % 4}"
        limit = {"s1": 500, "s2": 300}.get(source)
        if limit and len(text) > limit and rng.random() < 0.6:
            text = text[:limit] if source == "s1" else text[: limit - 10].rsplit(" ", 1)[0] + "…"
            if not text.rstrip("…").rstrip().endswith("."):
                cut.add(i)
        rows.append((i, source, text, "x"))
    rows += [(700, "s3", rows[next(iter(cut))][2], "x"), (701, None, None, "x"), (702, "s1", "", "x"), (703, "s1", "  ", "x")]
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string, cut string"), cut | {700}


def test_truncated_texts(spark):
    df, cut = documents(spark)
    rows = truncation.truncated_texts(df).collect()
    got = {r["doc_id"] for r in rows if r["cut"]}
    assert len(rows) == 604 and len(got ^ cut) <= 0.05 * len(cut) and 700 in got and not got & {701, 702, 703}
    assert truncation.truncated_texts(df.limit(0)).count() == 0


def test_limits(spark):
    df, _ = documents(spark)
    from corpusloom.llm.truncation import _features

    limits = truncation.length_limits(_features(df, "doc_id", "source", "text")).collect()
    assert {(r["source"], r["size"]) for r in limits if not r["marked"] and r["measure"] == "chars"} == {("s1", 500)}


def test_two_limits_in_a_source(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    rows = []
    for i in range(400):
        text = " ".join(word() for _ in range(rng.randrange(10, 200))) + "."
        limit = (300, 600)[i % 2]
        kept = text if len(text) <= limit else text[:limit] if i % 4 < 2 else text[: limit - 6].rsplit(" ", 1)[0] + " ..."
        rows.append((i, "s", kept))
    limits = truncation.length_limits(truncation._features(spark.createDataFrame(rows, "doc_id bigint, source string, text string"), "doc_id", "source", "text")).where("measure = 'chars'").collect()
    assert {r["size"] for r in limits if not r["marked"]} == {300, 600}
    marked = {r["size"] for r in limits if r["marked"]}
    assert marked and {s // 300 for s in marked} == {0, 1} and all(min(abs(s - 300), abs(s - 600)) <= 24 for s in marked)


def side(text):
    return f"<|im_start|>assistant\n<think>\nx\n</think>\n\n{text}<|im_end|>\n"


PROMPT = "<|im_start|>system\nYou are Q.<|im_end|>\n<|im_start|>user\n{}<|im_end|>\n"
ASK = "How do I get better at bread ovens with little time?"
DEFECTS = [
    (ASK, None, "empty"), (ASK, "\n", "empty"), (ASK, side("​ "), "empty"), (ASK, side(ASK), "copy"), (ASK, side(f'"{ASK}"'), "copy"), (ASK, side("How do I really get better at ovens with little time?"), "copy"), (ASK, side(f"{ASK} {ASK}"), "copy"),
    (ASK, side("Look, I'd rather not get into bread ovens. I hope you understand."), "refusal"), (ASK, side("I'm sorry, but my guidelines keep me from discussing bread ovens."), "refusal"), ("Wie wird das Brot besser?", side("Es tut mir leid, dabei kann ich nicht helfen."), "refusal"),
    (ASK, side("Das wird leichter, wenn man sich Zeit nimmt und nicht zu viel will."), "language"), (ASK, side("ご飯はとても美味しかったです."), "language"), ("Answer in German only: the tale of a lamp.", side("The lamp was old and it was in the house."), "language"),
    (ASK, side("Try this.\n\n```\nsort notes"), "truncated"), (ASK, "<|im_start|>assistant\nIt is the first thing to", "truncated"), (ASK, side("Use the oven. Then check the smallest lay"), "truncated"),
    (ASK, side("Use less than you think, and check the heat."), None), (ASK, side(f"> {ASK}\n\nUse less than you think, then check the heat of the stone and wait for it."), None), (ASK, side("I can't see your kitchen from here, but the steps are the same."), None), (ASK, side("Yes."), None),
    ("Please write a polite note that turns down an offer.", side('You could write: "Sorry, I can\'t help with that right now." Short is fine.'), None), ("Write me a few lines in French, please.", side("La nuit est belle et je ne dors pas."), None),
]


def test_pair_defects(spark):
    rows = [(i, PROMPT.format(t), s, side("That is a sound answer."), "x") for i, (t, s, _) in enumerate(DEFECTS)] + [(99, None, side("A sound answer."), None, "x")]
    got = {(r["pair_id"], r["side"]): r["defect"] for r in pairs.broken_sides(spark.createDataFrame(rows, "pair_id bigint, prompt_text string, chosen_text string, rejected_text string, defect string")).collect()}
    assert {k: v for k, v in got.items() if k[1] == "chosen"} == {(i, "chosen"): d for i, (_, _, d) in enumerate(DEFECTS) if d}
    assert got[99, "rejected"] == "empty" and (99, "chosen") not in got


def test_whole_answers_are_judged():
    """A refusal in the sixth sentence, a turn given back ten times, quotations in short and long answers."""
    late = "You asked about bread. Bread is old. Ovens are older. Stones are oldest. That is all true. I'm sorry, but I can't help with that."
    assert pairs.refusal_sentences(late) == (1, 6)
    assert all(pairs.is_copy(ASK, " ".join([ASK] * n)) for n in (1, 4, 6, 10, 60)) and not pairs.is_copy(ASK, "Use less heat. " * 60)
    assert pairs.is_copy("Hello", "hello hello hello") and not pairs.is_copy("Hello", "hello there")
    assert pairs.plain("he said „ja und nein“ and left `x = 1` now").split() == ["he", "said", "and", "left", "now"] and pairs.plain('"all quoted"') == '"all quoted"'


def test_language_profile(spark):
    english, german = ["it is the house that we had at the end of the road and it was not there", "you are the one who is in it and we have to do it"], ["das ist nicht das haus das wir da am ende haben und es war nicht da", "du bist der eine der in dem haus ist und wir haben es nicht"]
    learned = languages.learn(spark.createDataFrame([(t,) for t in english + german] + [(None,), ("",)], "text string"))
    assert learned.names == ["en", "de"] and learned.name("the road that was") == "en" and learned.name("am ende das haus") == "de" and learned.name("") is None
    assert learned.name("ご飯はとても") == "ja" and learned.name("где ключ") == "ru" and languages.UNTAUGHT.name("the house and the road of it") == "en"
    assert languages.learn(spark.createDataFrame([], "text string")).names == []


def test_lcs():
    assert pairs.lcs("a b c d".split(), "b x d".split()) == 2 and pairs.lcs([], ["a"]) == 0 and pairs.lcs(["a"] * 100, ["a"] * 70) == 70


def test_components_like_union_find(spark):
    rng = random.Random(11)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(1000 + i, 1001 + i) for i in range(64)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["root"] for r in splits.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert splits.connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_keys_and_groups(spark):
    tasks = spark.createDataFrame([(1, "Files A", "x"), (2, "files_a ", "x"), (3, "N/A", "x"), (4, None, "x"), (5, "fic.77", "x"), (6, "fic", "x"), (7, "unknown", "x")], "rec_no bigint, family string, key string")
    seeds = spark.createDataFrame([(10, "files-a"), (11, " ")], "rec_no bigint, family string")
    books = spark.createDataFrame([(20, "FIC 77/", "Lee, Ann"), (21, "fic-78", "Various; ann  LEE"), (22, "fic-", "Anonymous"), (23, "fic-79", "-"), (24, "fic-79", None), (25, "fic-80", "ann lee")], "rec_no bigint, work_id string, author string")
    got = {r["rec_no"]: r["group_no"] for r in splits.record_groups(splits.record_keys(tasks, seeds, books)).collect()}
    assert got == {1: 1, 2: 1, 10: 1, 3: 3, 4: 4, 6: 6, 7: 7, 11: 11, 5: 5, 20: 5, 21: 5, 25: 5, 22: 22, 23: 23, 24: 23}


def test_splits_keep_groups_and_shares(spark):
    rng = random.Random(12)
    sizes = [300, 120, 80] + [rng.randrange(1, 12) for _ in range(400)]
    rows, n = [], 0
    for s in sizes:
        rows += [(n + i, n) for i in range(s)]
        n += s
    df = spark.createDataFrame(rows, "rec_no bigint, group_no bigint")
    shares = {"train": 0.8, "validation": 0.1, "test": 0.1}
    got = splits.assign_splits(df, shares, bins=60, buckets=4).collect()
    assert len(got) == n and all(len({r["split"] for r in got if r["group_no"] == g}) == 1 for g in {0, 300, 420})
    for s, p in shares.items():
        assert abs(sum(r["split"] == s for r in got) / n - p) < 0.01


def test_differencing_balances():
    import numpy as np

    rng = np.random.default_rng(1)
    w = rng.integers(1, 100, 5000)
    at, sums = splits.difference(w, 50)
    assert np.array_equal(np.bincount(at, weights=w, minlength=50), sums) and sums.max() - sums.min() <= 2
    assert splits.difference(np.array([], np.int64), 5)[1].sum() == 0


def test_empty_tables_and_null_keys(spark):
    none = spark.createDataFrame([], "pair_id bigint, prompt_text string, chosen_text string, rejected_text string")
    assert pairs.broken_sides(none).count() == 0
    t, s, b = (spark.createDataFrame([], d) for d in ("rec_no bigint, family string", "rec_no bigint, family string", "rec_no bigint, work_id string, author string"))
    assert splits.record_groups(splits.record_keys(t, s, b)).count() == 0
    assert splits.assign_splits(spark.createDataFrame([], "rec_no bigint, group_no bigint"), {"train": 0.8, "test": 0.2}).count() == 0
    odd = spark.createDataFrame([(None, "f"), (3, "f"), (4, "f")], "rec_no bigint, family string")
    got = {r["rec_no"]: r["group_no"] for r in splits.record_groups(splits.record_keys(odd, s, b)).collect()}
    assert got == {3: 3, 4: 3}



def chatter(rng, n):
    return "\n".join(f"[{rng.randrange(10, 24)}:{rng.randrange(10, 60)}] {rng.choice(('Otto', 'Mira', 'Wren'))}: {' '.join(rng.choices(WORDS, k=7))}." for _ in range(n))


WORDS = [f"{a}{b}" for a in "bal cor dim fen gar hol".split() for b in "ta ri no ku me so".split()]


def test_copies_and_unrelated_cuts_clear_no_text(spark):
    rng = random.Random(21)
    hot = chatter(rng, 14)
    cut = [hot.replace(rng.choice(WORDS), "lamps", 1) + "\n[14:07] Lysande" for _ in range(8)]
    cut += [chatter(rng, 6) + f"\n[{10 + i}:{20 + i}] Otto" for i in range(6)]
    whole = [chatter(rng, 6) + "\n- never mentions the lamp" for _ in range(6)]
    rest = [chatter(rng, 8) for _ in range(150)]
    rows = [(i, f"s{i % 9}", t) for i, t in enumerate([*cut, *whole, *rest])]
    got = {r["doc_id"] for r in truncation.truncated_texts(spark.createDataFrame(rows, "doc_id bigint, source string, text string")).collect() if r["cut"]}
    assert got == set(range(len(cut)))


def test_pair_rows_clear_no_cut_answer(spark):
    rng = random.Random(22)
    lead = lambda: " ".join(rng.choices(WORDS, k=9)).capitalize() + ". "
    cut = "Use the small oven. then wait for the heat of the sto"
    goes_on = [lead() + "then wait for the heat of the stone to come back." for _ in range(60)]
    whole = [lead() + f"let me ask the {w} and get back to you" for w in "baker clerk nurse pilot".split()]
    answers = [cut, cut, cut, *whole, *goes_on]
    rows = [(i, None, side(a), side("That is a sound answer.")) for i, a in enumerate(answers)]
    got = {(r["pair_id"], r["defect"]) for r in pairs.broken_sides(spark.createDataFrame(rows, "pair_id bigint, prompt_text string, chosen_text string, rejected_text string")).collect()}
    assert got == {(i, "truncated") for i in range(3)}


def test_votes_count_near_copies_once(spark):
    """Texts of one key that share a band, also by way of others, are one vote; keys without enough votes are left out."""
    bands = lambda *shared: [shared[k] if k < len(shared) else 1_000_000 * (1 + sum(shared)) + k for k in range(16)]
    chain = [bands(k, 100 + k) for k in range(6)]
    for a, b in zip(chain, chain[1:]):
        b[2], a[3] = 7_000 + chain.index(b), 8_000 + chain.index(b)
        b[3] = 9_000 + chain.index(b)
        a[5] = b[5] = 5_000 + chain.index(b)
    for k, c in enumerate(chain[1:-1], 1):  # each shares one band with the one before and another with the next
        c[5], c[6] = chain[k - 1][5] if k == 1 else 5_000 + k, 6_000 + k
        chain[k + 1][6] = 6_000 + k
    lone = [bands(50 + k, 500 + k) for k in range(3)]
    rows = [("x", s) for s in chain + lone + lone] + [("y", lone[0]), ("y", lone[1])]
    want = {}
    for key in ("x", "y"):
        sketches = [list(t) for t in {tuple(s) for k, s in rows if k == key}]
        groups = list(range(len(sketches)))
        for _ in sketches:
            for i, s in enumerate(sketches):
                for j, t in enumerate(sketches):
                    if any(p == q for p, q in zip(s, t)):
                        groups[i] = groups[j] = min(groups[i], groups[j])
        want[key] = len(set(groups))
    got = endings.vote_counts(spark.createDataFrame(rows, "key string, sketch array<bigint>"), "key", 2).collect()
    assert {r["key"]: r["votes"] for r in got} == {k: n for k, n in want.items() if n > 2} and want["x"] > 3
    assert endings.vote_counts(spark.createDataFrame([], "key string, sketch array<bigint>"), "key", 2).count() == 0
