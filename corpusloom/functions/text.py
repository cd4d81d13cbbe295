"""Text expressions. Unicode classes throughout, as Spark's defaults are ASCII."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as Python's ``str.strip`` sees it: Unicode White_Space and the four separators FS, GS, RS, US.
WS = r"[\s\x1c-\x1f]"
#: Characters that show nothing: white space, U+200B, U+FEFF, U+FFFC.
INVISIBLE = r"[\s\x1c-\x1f\x{200B}\x{FEFF}\x{FFFC}]"


def strip(c: Column) -> Column:
    """Remove outer white space of any kind."""
    return F.regexp_replace(c, rf"(?U)^{WS}+|{WS}+$", "")


def squeeze(c: Column) -> Column:
    """Collapse every run of white space to one blank and strip."""
    return F.trim(F.regexp_replace(c, rf"(?U){WS}+", " "))


def normalise(c: Column) -> Column:
    """Lower case, white space collapsed and stripped: the text form used by exact deduplication."""
    return F.trim(F.regexp_replace(F.lower(c), rf"(?U){WS}+", " "))


def sender_key(c: Column) -> Column:
    """Sender without outer white space in lower case; null where missing or blank."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


def visible(c: Column) -> Column:
    """Whether the text shows anything."""
    return c.isNotNull() & F.coalesce(F.regexp_replace(c, rf"(?U){INVISIBLE}+", "") != "", F.lit(False))


def slugify(c: Column, limit: int = 80) -> Column:
    """Keep word characters, blanks and dashes; blanks to dashes; cut; strip dashes; lower; ``untitled`` if nothing is left."""
    s = F.regexp_replace(c, r"(?U)[^\w\s-]", "")
    s = F.regexp_replace(strip(s), r"(?U)[\s-]+", "-")
    s = F.lower(F.regexp_replace(F.substring(s, 1, limit), r"^-+|-+$", ""))
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit("untitled")).otherwise(s)


def slug_ascii(c: Column, limit: int = 32) -> Column:
    """Runs of anything but a-z0-9 become one dash; cut to ``limit``; ``item`` if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    s = F.regexp_replace(F.substring(s, 1, limit), "-+$", "")
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit("item")).otherwise(s)


def key_slug(c: Column) -> Column:
    """Lower case, runs other than a-z0-9 as one hyphen, outer hyphens removed."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def author_flip(c: Column) -> Column:
    """``Last, First`` to ``First Last``; other forms unchanged."""
    return F.when(
        F.instr(c, ",") > 0,
        F.trim(F.concat_ws(" ", F.trim(F.regexp_extract(c, r"^([^,]*),\s*(.*)$", 2)), F.trim(F.regexp_extract(c, r"^([^,]*),\s*(.*)$", 1)))),
    ).otherwise(F.trim(c))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, also where it is used inside lambdas (which Spark evaluates anew for each element)."""
    return F.get(F.transform(F.array(value), use), 0)


def explode_once(df: DataFrame, array: Column, out: str, pos: str | None = None) -> DataFrame:
    """One row for each element of a computed array, evaluated once.

    A plain ``explode`` makes the optimizer infer a filter on the array's size and push it down, which evaluates the array, with everything that it is made of, again.
    """
    got = df.select("*", F.posexplode_outer(array).alias(pos, out) if pos else F.explode_outer(array).alias(out))
    return got.where(F.col(out).isNotNull())


def words(c: Column) -> Column:
    """Words of a normalised text (blank separated); an empty array for an empty text."""
    return F.filter(F.split(normalise(c), " "), lambda w: w != "")


def ngrams(ws: Column, n: int) -> Column:
    """Distinct word n-grams joined by a blank; a shorter text gives one gram of all its words, an empty text none."""

    def grams(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).when(F.size(w) < n, F.array(F.array_join(w, " "))).otherwise(F.array_distinct(every))

    return let(ws, grams)


def fence_strip(c: Column) -> Column:
    """Drop code-fence lines."""
    return strip(F.regexp_replace(c, r"(?m)^```[A-Za-z0-9]*[ \t]*$\n?", ""))


def yaml_quote(c: Column) -> Column:
    """Double-quoted YAML scalar: backslash first, then quote."""
    return F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def clean_url(c: Column) -> Column:
    """Scheme, host and path only."""
    return F.regexp_replace(c, "(?s)[?#].*", "")


def shorten(c: Column, limit: int) -> Column:
    """Collapse white space; if longer than ``limit`` cut at the last blank before it and add an ellipsis."""
    s = squeeze(c)
    head = F.substring(s, 1, limit)
    at = F.regexp_extract(head, r"(?s)^(.*)\s", 1)
    return F.when(F.length(s) <= limit, s).otherwise(F.concat(F.rtrim(F.when(at == "", head).otherwise(at)), F.lit("…")))


def summary_lines(c: Column, limit: int) -> Column:
    """At most ``limit`` characters, cut at the last line break before it, with an ellipsis."""
    s = strip(c)
    head = F.substring(s, 1, limit)
    at = F.regexp_extract(head, r"(?s)^(.*)\n", 1)
    return F.when(F.length(s) <= limit, s).otherwise(F.concat(F.when(at == "", head).otherwise(at), F.lit("\n…")))
