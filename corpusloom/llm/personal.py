"""Personal data in free text (problem 7).

Regular expressions propose spans of each kind; checksum validators (Luhn for cards, mod-97 for IBANs, mod-23 letters) confirm or
reject numbers, and shapes of dates are no phone numbers; words nearby raise or lower the score of a span. Spans that reach
their threshold become typed placeholders. Kinds are tried in a fixed order and a span is never used twice.

The lists of words are written by hand, a few entries after test messages: common given names beside the table of given names, usual endings of surnames, and capitalised words that
begin sentences or name places and firms. A name in lower case is not found.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "phone", "id_number", "address", "person")
THRESHOLD = 2.5

# --- email -------------------------------------------------------------------------------------------
_AT = r"(?:\s?@\s?|\s?[\[({<]\s?(?:at|arroba)\s?[\])}>]\s?|(?P<word>\s(?:at|arroba)\s))"
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|punto|punkt|point)\s?[\])}]\s?|(?P<wdot>\s(?:dot|punto|punkt|point)\s))"
_DOT2 = _DOT.replace("(?P<wdot>", "(?:")
EMAIL = re.compile(rf"(?i)(?<![\w.+@-])(?:mailto:)?[a-z0-9][a-z0-9._%+-]*{_AT}(?P<dom>[a-z0-9][a-z0-9-]*(?:{_DOT2}[a-z0-9-]+)*{_DOT2}[a-z]{{2,}})(?![\w-])")
_SPELLED_DOT = re.compile(r"(?i)\b(?:dot|punto|punkt|point)\b|[\[({]\s?dot")
EMAIL_HINT = re.compile(r"(?i)@|[\[({<]\s?(?:at|arroba)\s?[\])}>]|\s(?:at|arroba)\s[^\n]{1,80}?(?:\bdot\b|\bpunto\b|\bpunkt\b|\bpoint\b)")

# --- address -----------------------------------------------------------------------------------------
_CAP = r"[A-ZÀ-ÖØ-Þ][\w'’-]*"
_STREET = "St|Street|Ave|Avenue|Rd|Road|Row|Way|Drive|Dr|Lane|Ln|Court|Ct|Close|Terrace|Blvd|Boulevard|Place|Pl|Crescent|Square|Sq|Hill|Gardens|Grove|Walk|Mews|Parkway|Pkwy|Highway"
ADDRESS = re.compile(
    rf"(?<![\w#])\d{{1,5}}\s?[a-zA-Z]?,? (?:(?:[NSEW]|[NS][EW]|North|South|East|West|Upper|Lower|Old|New|Great|Little)\.? )?(?:{_CAP} ){{1,3}}(?:{_STREET}|{_STREET.upper()})\b\.?"
    rf"|\b[A-ZÄÖÜ][\wäöüß-]+(?:straße|strasse|str\.|gasse|weg|platz|allee|ufer|damm|graben|STRASSE|STRAßE|GASSE|WEG|PLATZ|ALLEE|UFER) \d{{1,4}}(?: ?[a-zA-Z])?\b"
    rf"|\b[A-ZÄÖÜ][\wäöüß-]+ (?:Straße|Str\.|Weg|Platz|Allee|Gasse) \d{{1,4}}(?: ?[a-z])?\b"
    rf"|(?<!\w)\d{{1,4}}(?: ?(?:bis|ter|quater))?,? (?:rue|avenue|allée|allee|quai|boulevard|bd|place|chemin|impasse|cours|route|square|RUE|AVENUE|ALLÉE|QUAI|BOULEVARD|PLACE|Rue|Avenue|Allée|Quai|Boulevard|Place) (?:de la |de l['’]|des |du |de |d['’]|DE LA |DES |DU |DE )?{_CAP}"
    rf"|\b(?:[Cc]alle|CALLE|[Aa]v(?:da|enida)?\.?|AVDA\.|AVENIDA|[Pp]laza|PLAZA|[Pp]aseo|PASEO|[Cc]amino|[Rr]onda|C/) ?(?:de la |de los |de las |del |de |DE LA |DEL |DE )?{_CAP}(?: {_CAP})?,? (?:n[.º°]* ?)?\d{{1,4}}\b"
)

#: A number after one of these is a place inside a building.
_INDOORS = re.compile(r"(?i)\b(?:room|gate|hall|pier|floor|seat|platform|track|desk|table|zimmer|raum|gleis|sala)\s$")

# --- numbers -----------------------------------------------------------------------------------------
_ID_WORD = (
    r"(?:ssn|social(?:\s+security)?|sozialversicherung\w*|seguridad social|sécurité sociale|national insurance|nat\.?\s?ins\w*\.?|ni|nino|passport|pasaporte|passeport|reisepass|pass|dni|nie|nif|tax\s*(?:id|file)|tin|"
    r"steuer-?\s?(?:id|nummer|nr)|n(?:uméro|º|°)\s+fiscal|número fiscal|driv\w+ licen[cs]e|driver'?s licen[cs]e|führerschein\w*|permis(?: de conduire)?|carnet de conducir|licen[cs]e|personalausweis|ausweis\w*|carte d'identité|identity (?:card|number)|id card)"
)
ID_CONTEXT = re.compile(rf"(?i)(?<!\w){_ID_WORD}(?:\s*(?:no|nr|num|number|nummer|numéro|número|is|ist|est|es)\b\.?)*\s*[:#=]?\s*$")
NI = re.compile(r"(?i)(?<!\w)[A-Z]{2}[ -]?\d{2}[ -]?\d{2}[ -]?\d{2}[ -]?[A-D](?!\w)")
ID_SHAPE = re.compile(r"(?<![\w#/.-])(?:[A-Z]{1,2}[ -]?)?\d[\d -]{4,16}\d(?:[ -]?[A-Za-z](?!\w))?(?![\w/])")
SSN = re.compile(r"(?<![\w-])(?!000|666)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])")
PASSPORT = re.compile(r"(?<!\w)[A-Z]\d{8}(?!\w)")
DNI = re.compile(r"(?<!\w)\d{8}-?[A-Z](?!\w)")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,4})?(?!\w)")
CARD = re.compile(r"(?<![\w-])\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}(?![\w-])")
PHONE = re.compile(r"(?<![\w#@/.,:-])(?:\+|\()?\d[\d\s().\-/]{5,20}\d(?![\w/]|[.,:-]\d)")
_GOOD_PHONE = re.compile(r"(?i)\b(?:phone|mobile|cell|tel\w*|call|ring|text|dial|fax|number|numéro|número|nummer|handy|ruf|llámame|llama|messenger|whatsapp|plumber|clinic|rang|appelle|sms|contact)\b")
_BAD_NUMBER = re.compile(r"(?i)(?:\b(?:ticket|order|ref|reference|case|lot|isbn|tracking|flight|seat|room|code|score|views|costs?|invoice|version|form|page|chapter|line|lines|bytes|port|build|commit|issue|pr)\b\W{0,3}(?:[A-Z]{1,3} )?|#)$")
_DIGIT_WORD = (
    "zero|oh|one|two|three|four|five|six|seven|eight|nine|null|eins|zwei|drei|vier|fünf|sechs|sieben|acht|neun|zéro|un|deux|trois|quatre|cinq|sept|huit|neuf|cero|uno|dos|tres|cuatro|cinco|seis|siete|ocho|nueve|plus|double"
)
SPOKEN = re.compile(rf"(?i)(?<!\w)(?:(?:{_DIGIT_WORD})[\s,.-]+){{6,15}}(?:{_DIGIT_WORD})(?!\w)")

# --- person ------------------------------------------------------------------------------------------
_TITLE = r"(?:Mr|Mrs|Ms|Miss|Dr|Prof|Professor|Herr|Frau|Señor|Señora|Señorita|Sr|Sra|Don|Doña|Mme|Mlle|Monsieur|Madame|MR|MRS|MS|DR|PROF|HERR|FRAU|SEÑOR|SEÑORA|MME)"
_NAME = r"(?:(?:Mc|Mac|O['’]|D['’])?[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{2,}|[A-ZÀ-ÖØ-Þ]{3,})"
_SUR = rf"(?:(?:van|von|de|del|della|di|da|la|le) (?:der |den |la )?)?{_NAME}(?:-{_NAME})*"
PERSON = re.compile(
    rf"(?<![\w@.+-])(?:(?P<title>{_TITLE}\.?|M\.) (?:(?P<tgiven>{_NAME}|[A-Z]\.) )?(?P<tsur>{_SUR})"
    rf"|(?P<ini>(?:[A-ZÀ-ÖØ-Þ]\. ?){{1,3}})(?P<isur>{_SUR})"
    rf"|(?P<rsur>{_SUR}), (?P<rgiven>{_NAME})(?: [A-Z]\.)?"
    rf"|(?P<given>{_NAME}(?:-{_NAME})?) (?P<mid>[A-Z]\.? )?(?P<sur>{_SUR}))(?![\w@]|-\w)"
)
_NEXT_WORD = re.compile(rf"{_NAME}")
#: Common given names beside the table of given names; a parameter, stated plainly.
GIVEN = frozenset(
    "Aaron Alan Albert Alex Alexander Alice Amy Andrea Andreas Andrew Angela Ann Anne Antonio Arthur Barbara Ben Bernard Brian Carl Carlos Carmen Catherine Charles Charlotte Christian Christine Claire Claudia "
    "David Diana Diego Dora Dorothy Edward Elisabeth Elizabeth Emily Emma Eric Ernst Eva Florian Frances Francis Frank Franz Fred Frieda George Georg Gerhard Gloria Hannah Hans Harry Heinrich Henri Henry Isabel "
    "Jack Jacob James Jan Jane Javier Jean Jennifer Joan Johann John Jorge Jose Joseph Juan Karen Katharina Kevin Klaus Laura Lars Linda Louis Louise Lucas Luis Luise Margaret Maria Marie Mark Mary Matthew Max Michael "
    "Michel Miguel Monica Nicole Nina Olga Oliver Oscar Patricia Patrick Paul Pedro Peter Philip Pierre Ralph Raymond Rebecca Richard Robert Roger Ruth Sandra Sarah Sebastian Silvia Sophie Stefan Stephen Steven Susan "
    "Susanne Sylvia Thomas Ursula Valentina Walter Werner William Wolfgang Xavier Yvonne".split()
)
_SUR_END = re.compile(r"(?i)(?:son|sson|sen|ley|wick|ford|ton|ova|eva|off|etti|elli|ini|ino|ero|ez|brook|stad|hart|ard|mund|mann|man|berg|stein|bauer|meier|meyer|müller|ski|sky|ska|vic|vić|ich|oux|eau|well|worth|field|sworth)$")
_NO_NAME = frozenset(
    "The Old New Big Great Little Upper Lower North South East West Saint San Santa Street Road Avenue Inn House Hall Club Hotel Cafe Café Bar Ltd Limited Inc Corp Company Co GmbH Ag Llc Books School College University Church "
    "Bridge River Lake Mount Park Garden Gardens Station Market Harbour Kettle Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September October November December "
    "Topic Save Output Scene Present Chapter Part Case Ticket Note Thanks Hello Dear Please Let Tell Did Could Can Why How What When Where Who Ha Give Just Running Anyone Honestly Sorry Sounds Pushed Been Wait Not There This "
    "That These Those And But For With From Your Die Der Das Den Dem Ein Eine Ich Wir Und Aber Les Des Une Est Los Las Una Pero Before After Between Behind Without Beyond While Once Then Only Every Some Somebody Nobody Someone Ober Doktor Professor Doctor President Präsident Minister Director Direktor Kollege Nachbar Hollow Green Red".split()
)
_FIRM = re.compile(r"^[ ,&]*(?:Ltd|Limited|Inc|Corp|Company|GmbH|AG|LLC|Books|Inn|House|Hall|Club|Hotel|Street|Road|Lane|Café|Cafe|School|College|Church|Station|Park|& Sons|and Sons)\b")
_NAME_WORD = re.compile(
    r"(?i)\b(?:landlord|landlady|dentist|doctor|teacher|profesora?|tutor|neighbour|congrats|forwarded|signed|lease|name|named|names|will|seat|desk|school|met|ask for|thanks|called|wants|dile a|j'ai vu|vertrag|contract|dear|sincerely|regards|"
    r"mr|mrs|contact|manager|boss|coach|aunt|uncle|cousin|born|married|says|from|cc|hi|with)\b"
)
PERSON_HINT = re.compile(rf"(?:{_NAME}|[A-Z]\.),? (?:[A-Z]\. ?)?(?:(?:van|von|de|del|di|da) )?[A-ZÀ-ÖØ-Þ]|{_TITLE}\.? [A-ZÀ-ÖØ-Þ]")
DIGITS = re.compile(r"\d")


def luhn(digits: str) -> bool:
    """Checksum of payment cards."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Checksum of international account numbers."""
    s = re.sub(r"\W", "", iban).upper()
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def dni_letter(value: str) -> bool:
    """Control letter of a national number of eight digits."""
    d = re.sub(r"\D", "", value)
    return "TRWAGMYFPDXBNJZSQVHLCKE"[int(d) % 23] == value[-1].upper()


def _groups(value: str) -> list[int]:
    return [len(g) for g in re.findall(r"\d+", value)]


def _phone_score(value: str, before: str, after: str) -> float:
    digits = re.sub(r"\D", "", value)
    n, g = len(digits), _groups(value)
    if not 7 <= n <= 15 or "\n" in value or _BAD_NUMBER.search(before) or ID_CONTEXT.search(before):
        return 0.0
    near = 1.0 if _GOOD_PHONE.search(before[-40:]) or _GOOD_PHONE.search(after[:40]) else 0.0
    if value.startswith("+"):
        return 3.0 if n >= 8 else 0.0
    if re.fullmatch(r"(?:19|20)\d\d[-./ ]\d{1,2}[-./ ]\d{1,2}|\d{1,2}[-./ ]\d{1,2}[-./ ](?:19|20)\d\d", value):
        return 0.0
    if g == [3, 3, 4] or (g[:1] == [1] and g[1:] == [3, 3, 4]):
        return 3.0
    if value.startswith("00") and n >= 10:
        return 3.0 if g[-1] >= 3 else 1.5 + near
    if value.startswith("0") and 9 <= n <= 12:
        if g == [3, 3, 3, 2] or g == [4, 3, 3, 2]:
            return 1.0 + near
        return 3.0 if len(g) > 1 else 1.6 + near
    if g in ([10], [11]):
        return 2.0 + near
    if g == [3, 4]:
        return 1.6 + near
    if n in (9, 10, 11) and len(g) >= 3 and all(x in (2, 3) for x in g) and " " in value and "-" not in value:
        return 1.6 + near
    return 0.0


def _id_spans(text: str) -> Iterator[tuple[int, int]]:
    for m in NI.finditer(text):
        yield m.span()
    for m in SSN.finditer(text):
        if not _BAD_NUMBER.search(text[max(0, m.start() - 24) : m.start()]):
            yield m.span()
    for p, valid in ((PASSPORT, None), (DNI, dni_letter)):
        for m in p.finditer(text):
            before = text[max(0, m.start() - 40) : m.start()]
            if ID_CONTEXT.search(before) or (not _BAD_NUMBER.search(before) and (valid is None or valid(m.group()))):
                yield m.span()
    for m in IBAN.finditer(text):
        if mod97(m.group()):
            yield m.span()
    for m in CARD.finditer(text):
        d = re.sub(r"\D", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d) and len(set(d)) > 1 and not _BAD_NUMBER.search(text[max(0, m.start() - 24) : m.start()]):
            yield m.span()
    for m in ID_SHAPE.finditer(text):
        if len(re.sub(r"\D", "", m.group())) >= 6 and ID_CONTEXT.search(text[max(0, m.start() - 48) : m.start()]):
            yield m.span()


def _title_case(s: str) -> str:
    return s.capitalize() if s.isupper() else s


def _person_score(m: re.Match, text: str, given: frozenset[str]) -> float:
    title = m["title"]
    first = m["given"] or m["rgiven"] or m["tgiven"] or ""
    sur = (m["tsur"] or m["isur"] or m["rsur"] or m["sur"]).split(" ")[-1]
    first_word, parts = _title_case(first.split("-")[0]), [_title_case(p) for p in sur.split("-")]
    if parts[0] in _NO_NAME or (first_word in _NO_NAME and not title):
        return 0.0
    if m.group().isupper() and not (title or first_word in given):
        return 0.0  # running text in capitals
    after, before = text[m.end() : m.end() + 40], text[max(0, m.start() - 40) : m.start()]
    if _FIRM.match(after) or re.search(r"(?i)\b(?:the|old)\s$", before):
        return 0.0
    known = first_word in given
    score = 2.0 if known else 0.0
    if title:
        score += 3.0 if title != "M." else 2.0
    if m["ini"]:
        score += 1.5
    if m["mid"]:
        score += 1.5
    if len(parts) > 1:
        score += 1.0
    if _SUR_END.search(parts[-1]) and parts[-1] not in given:
        score += 1.5
    elif parts[-1] in given and not title:
        score -= 3.0
    if _NAME_WORD.search(before) or _NAME_WORD.search(after):
        score += 1.0
    if not (known or title or m["ini"]):
        score -= 1.0
    if known and not (title or m["mid"]) and len(parts[-1]) < 5:
        score -= 1.0
    return score


def find_personal(text: str, given: frozenset[str] = GIVEN) -> list[tuple[int, int, str]]:
    """Spans ``(start, end, kind)`` of personal data in order."""
    spans: list[tuple[int, int, str]] = []

    def take(found: Iterable[tuple[int, int]], kind: str, text: str) -> str:
        for a, b in found:
            if "\0" not in text[a:b]:
                spans.append((a, b, kind))
                text = text[:a] + "\0" * (b - a) + text[b:]
        return text

    if EMAIL_HINT.search(text):
        text = take((m.span() for m in EMAIL.finditer(text) if not (m["word"] and not _SPELLED_DOT.search(m["dom"]))), "email", text)
    if DIGITS.search(text):
        text = take([m.span() for m in ADDRESS.finditer(text) if not _INDOORS.search(text[max(0, m.start() - 12) : m.start()])], "address", text)
        text = take([*_id_spans(text)], "id_number", text)
        phones = []
        for m in PHONE.finditer(text):
            v = m.group().rstrip(" .-/(")
            if _phone_score(v, text[max(0, m.start() - 48) : m.start()], text[m.start() + len(v) : m.end() + 48]) >= THRESHOLD:
                phones.append((m.start(), m.start() + len(v)))
        text = take(phones, "phone", text)
    text = take([m.span() for m in SPOKEN.finditer(text)], "phone", text) if " " in text else text
    if PERSON_HINT.search(text):
        people, at = [], 0
        while m := PERSON.search(text, at):
            if _person_score(m, text, given) >= THRESHOLD:
                people.append(m.span())
                at = m.end()
            else:  # the next name may begin inside the rejected one
                n = _NEXT_WORD.match(text, m.start())
                at = n.end() if n else m.start() + 1
        text = take(people, "person", text)
    return sorted(spans)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with typed placeholders for the spans."""
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


#: Given names that are sent to the tasks at once; more are joined with the words of the texts.
SENT_NAMES = 100_000
_NAME_WORD_JVM = r"(?U)([A-ZÀ-ÖØ-Þ][\p{L}'’]{1,})"


def personal_data(texts: DataFrame, keys: list[str], text: str = "text", given_names: DataFrame | None = None, redacted: bool = False, sent_names: int = SENT_NAMES) -> DataFrame:
    """``keys, kinds`` of each text with personal data, or with ``redacted`` ``keys, kinds, redacted`` with placeholders.

    Null and empty texts hold none and are left out. Texts of any length are read whole. A table of up to ``sent_names`` given names goes to the tasks with the
    function, and nothing is shuffled; of a larger one each distinct text is joined with the names among its own words. Both ways give the same result.
    """
    given, own = GIVEN, None
    t = F.col(text)
    # nothing can be found in a text without a digit, an at, a capital or a spelled number
    may = t.rlike(r"[0-9@A-ZÀ-ÖØ-Þ]|\bat\b|\(at|\[at|arroba") | t.rlike(r"(?i)(?:\b\p{L}{2,6}\b[\s,.-]+){6}")
    rows = texts.select(*keys, t.alias("_text")).where(may)
    if given_names is not None:
        names = given_names.where("given_name is not null").select(F.initcap(F.trim("given_name")).alias("name")).distinct()
        sent = names.limit(sent_names + 1).collect()
        if len(sent) <= sent_names:
            given = GIVEN | {r[0] for r in sent}
        else:
            hashes = [F.xxhash64("_text").alias("_h1"), F.xxhash64(F.lit(7), F.col("_text")).alias("_h2")]
            words = F.array_distinct(F.transform(F.regexp_extract_all("_text", F.lit(_NAME_WORD_JVM), 1), F.initcap))
            held = rows.select(*hashes, words.alias("_w")).dropDuplicates(["_h1", "_h2"]).select("_h1", "_h2", F.explode("_w").alias("name"))
            met = held.join(names, "name").groupBy("_h1", "_h2").agg(F.collect_set("name").alias("_own"))
            rows = rows.select("*", *hashes).join(met, ["_h1", "_h2"], "left").select(*keys, "_text", "_own")
            own = "_own"
    head = ", ".join(f"`{k}` {texts.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, kinds, clean = [], [], []
            theirs = b.column(own).to_pylist() if own else None
            for i, t in enumerate(b.column("_text").to_pylist()):
                known = given | set(theirs[i]) if theirs and theirs[i] else given
                if spans := find_personal(t, known):
                    keep.append(i)
                    kinds.append([k for k in KINDS if any(s[2] == k for s in spans)])
                    if redacted:
                        clean.append(redact(t, spans))
            at = pa.array(keep, pa.int64())
            cols = [*(b.column(k).take(at) for k in keys), pa.array(kinds, pa.list_(pa.string()))] + ([pa.array(clean, pa.string())] if redacted else [])
            yield pa.RecordBatch.from_arrays(cols, names=[*keys, "kinds"] + ["redacted"] * redacted)

    return rows.mapInArrow(run, f"{head}, kinds array<string>" + (", redacted string" if redacted else ""))
