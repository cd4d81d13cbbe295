"""Markdown notes with front matter."""

from __future__ import annotations

import re

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from corpusloom.functions.hashing import note_family
from corpusloom.functions.text import strip
from corpusloom.sources.jsonl import path_exists

# Front matter and section marks of a note.
FRONT = r"(?s)^---\n(.*?)\n---\n"
_SECTION = re.compile(r"^##\s+(?P<name>.+?)\s*$\n(?P<body>.*?)(?=^##\s|\Z)", re.M | re.S)


@F.pandas_udf(MapType(StringType(), StringType()))
def front_matter(texts: pd.Series) -> pd.Series:
    """Front matter as a map; empty where there is none or it is no mapping."""

    def one(t: str | None):
        try:
            got = yaml.safe_load(t) if t else None
        except yaml.YAMLError:
            got = None
        return {str(k): str(v) for k, v in got.items() if v is not None} if isinstance(got, dict) else {}

    return texts.map(one)


@F.pandas_udf(MapType(StringType(), StringType()))
def sections(bodies: pd.Series) -> pd.Series:
    """Body of each ``##`` heading."""
    return bodies.map(lambda t: {} if t is None else {m["name"]: m["body"].strip() for m in _SECTION.finditer(t)})


def bullets(body: Column, longer_than: int = 40) -> Column:
    """Bullet texts of more than 40 characters."""
    return F.filter(F.transform(F.regexp_extract_all(body, F.lit(r"(?m)^[-*]\s+(.*)$"), 1), strip), lambda b: F.length(b) > longer_than)


def dated_bullets(body: Column) -> Column:
    """``array<struct<when, what>>`` of bullets that begin with a bold date."""
    p = r"(?m)^[-*]\s+\*\*([^*]+?):?\*\*:?\s*(.+)$"
    return F.zip_with(F.regexp_extract_all(body, F.lit(p), 1), F.regexp_extract_all(body, F.lit(p), 2), lambda a, b: F.struct(strip(a).alias("when"), strip(b).alias("what")))


def notes_of(files: DataFrame, root: str, kb_dir: str) -> DataFrame:
    """``rel, section, title, front, body, family_key`` of note files (``path, text``). The section is the folder under ``kb_dir``, ``Index`` at its root, ``notes`` elsewhere."""
    rel = F.regexp_extract("path", rf"{re.escape(root.rstrip('/'))}/(.*)$", 1)
    inside = F.regexp_extract(rel, rf"^{re.escape(kb_dir)}/(.*)$", 1)
    section = F.when(inside == "", F.lit("notes")).when(F.contains(inside, F.lit("/")), F.substring_index(inside, "/", 1)).otherwise(F.lit("Index"))
    n = files.select(rel.alias("rel"), section.alias("section"), front_matter(F.regexp_extract("text", FRONT, 1)).alias("front"), strip(F.regexp_replace("text", FRONT, "")).alias("body"))
    title = F.coalesce(F.nullif(strip(F.coalesce(F.try_element_at("front", F.lit("name")), F.lit(""))), F.lit("")), F.regexp_extract("rel", r"([^/]+?)(?:\.md)?$", 1))
    return n.withColumn("title", title).withColumn("family_key", note_family(F.col("section"), F.col("rel")))


def voice_note(spark: SparkSession, root: str, kb_dir: str, name: str) -> str:
    """Text of the note that describes the owner's voice; empty where there is none."""
    at = f"{root.rstrip('/')}/{kb_dir}/{name}"
    if not path_exists(spark, at):
        return ""
    row = spark.read.text(at, wholetext=True).select(strip(F.col("value"))).first()
    return row[0] if row else ""


def read_vault(spark: SparkSession, root: str, kb_dir: str, notes_dirs: list[str] | None = None) -> DataFrame:
    """Markdown notes under ``root``: those of ``kb_dir`` and of ``notes_dirs`` (of all other folders, if none are named)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(root)
    notes = notes_of(files.select(F.regexp_replace("path", "^file:(//)?", "").alias("path"), F.decode("content", "UTF-8").alias("text")), root, kb_dir)
    if notes_dirs is None:
        return notes
    inside = F.lit(False)
    for folder in [kb_dir, *notes_dirs]:
        inside = inside | F.col("rel").startswith(f"{folder.strip('/')}/")
    return notes.where(inside)
