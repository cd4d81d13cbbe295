"""Canonical JSON, content keys and hash integers."""

from __future__ import annotations

import hashlib
import json
import re
from pathlib import Path

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def canonical_json(value: object) -> str:
    """Sorted keys, no blanks, characters kept."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


@F.pandas_udf(StringType())
def canonical_json_of(texts: pd.Series) -> pd.Series:
    """Canonical form of JSON texts; null where a text is no JSON."""

    def one(t: str | None) -> str | None:
        try:
            return None if t is None else canonical_json(json.loads(t))
        except ValueError:
            return None

    return texts.map(one)


@F.pandas_udf(StringType())
def record_id_of(texts: pd.Series) -> pd.Series:
    """16 hex digits over a JSON text with sorted keys and default separators."""
    return texts.map(lambda t: None if t is None else hashlib.sha256(json.dumps(json.loads(t), sort_keys=True).encode()).hexdigest()[:16])


def hash_int(text: Column, digits: int = 8) -> Column:
    """The first hex digits of a text's SHA-256 as a bigint."""
    return F.conv(F.substring(F.sha2(text, 256), 1, digits), 16, 10).cast("bigint")


def short_hash(text: Column, digits: int) -> Column:
    """The first hex digits of a text's SHA-256."""
    return F.substring(F.sha2(text, 256), 1, digits)


def request_key(model: Column, system: Column, messages_json: Column, options_json: Column) -> Column:
    """Cache key of a model request with the fingerprint of its route; all parts matter, nulls are distinct from empty."""
    return F.sha2(F.to_json(F.struct(messages_json.alias("messages"), model.alias("model"), options_json.alias("options"), system.alias("system")), {"ignoreNullFields": "false"}), 256)


def note_family(section: Column, path: Column) -> Column:
    """``<section>-<8 hex digits of the path's hash>``."""
    return F.concat_ws("-", F.lower(section), short_hash(path, 8))


#: Files that are no configuration.
NO_CONFIG = re.compile(r"(?:^|/)__pycache__/|\.pyc$|(?:^|/)\.DS_Store$")


def tree_hash(root: str | Path) -> str:
    """SHA-256 of a folder's listing, a line ``<hash of the bytes>  <path below the folder>`` for each configuration file in path order."""
    listing = {p.relative_to(root).as_posix(): hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(root).rglob("*") if p.is_file()}
    return hashlib.sha256("".join(f"{listing[name]}  {name}\n" for name in sorted(listing) if not NO_CONFIG.search(name)).encode()).hexdigest()


def prompt_set_hash(prompts: dict[str, str]) -> str:
    """Hash of named prompts in key order."""
    return hashlib.sha256("\0".join(f"{k}\1{prompts[k]}" for k in sorted(prompts)).encode()).hexdigest()
