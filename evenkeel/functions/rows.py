"""Column expressions that make rows of two systems comparable."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "_composite_key"
DIGEST = "_row_hash"
# Fixed value: separator between the parts of a key and of a digest text.
SEPARATOR = "||"
# Fixed value: texts that cast to the double NaN (surrounding blanks and control characters allowed).
NAN_TEXT = r"^[\x00-\x20]*(?:[+-]?NaN|[nN][aA][nN])[\x00-\x20]*\z"

TEXT_TYPES = (T.StringType, T.CharType, T.VarcharType)


def is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, TEXT_TYPES)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def is_nan_text(name: str) -> Column:
    """Would this text cast to NaN?"""
    return F.expr(_nan_sql(quote(name)))


def _nan_sql(text: str) -> str:
    # Same answer as isnan(try_cast(text AS DOUBLE)), which parses every value and raises
    # an exception inside the JVM for every ordinary word. Here the first byte rules out
    # nearly all values before the pattern is tried.
    first = " OR ".join([f"{text} < '!'", *[f"startswith({text}, '{c}')" for c in "Nn+-"]])
    return f"(({first}) AND {text} RLIKE r'{NAN_TEXT}')"


def blank_missing(name: str) -> Column:
    """Text with NULL and NaN spellings folded to the empty string."""
    text = quote(name)
    return F.expr(f"CASE WHEN {text} IS NULL OR {_nan_sql(text)} THEN '' ELSE {text} END").alias(name)


def joined_key(names: Sequence[str]) -> Column:
    """Key parts joined to one text; NULL parts are left out, so it is never NULL."""
    return F.concat_ws(SEPARATOR, *[quote(name) for name in names])


def typed_key(names: Sequence[str]) -> Column:
    """Key parts kept apart with their types; equal when every part is, NULL included."""
    return F.struct(*[quote(name) for name in names])


def text_digest(names: Sequence[str], given: Mapping[str, Column] | None = None) -> Column:
    """SHA-256 (hex) of all values as text; NULL reads as the empty string. ``given`` holds texts made otherwise."""
    if given:
        texts = [given.get(name, F.expr(f"coalesce(CAST({quote(name)} AS STRING), '')")) for name in names]
        return F.sha2(F.concat_ws(SEPARATOR, *texts), 256)
    texts = "".join(f", coalesce(CAST({quote(name)} AS STRING), '')" for name in names)
    return F.expr(f"sha2(concat_ws('{SEPARATOR}'{texts}), 256)")


def safe_digest(values: Sequence[tuple[str, Column]]) -> Column:
    """SHA-256 (hex) of a JSON object of the values: tells NULL from ``''`` and keeps
    values apart that contain the separator. ``values`` are names and texts."""
    if not values:
        return text_digest([])
    return F.sha2(F.to_json(F.struct(*[value.alias(name) for name, value in values])), 256)
