"""Bytes to text where the declared charset can't be trusted."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Charsets that are tried in this order after UTF-8 and the declared one.
FALLBACKS = ["windows-1258", "cp1252", "iso-8859-1"]


def guessed(raw: bytes) -> list[str]:
    """What chardet takes the bytes for, if it is installed and they aren't UTF-8."""
    try:
        raw.decode()
        return []
    except UnicodeDecodeError:
        pass
    try:
        import chardet
    except ImportError:
        return []
    found = chardet.detect(raw).get("encoding")
    return [found] if found else []


def decoded(raw: bytes, declared: str | None) -> str:
    tries = [declared] if declared and declared.lower() not in ("utf-8", "utf8") else []
    for charset in ("utf-8", *tries, *guessed(raw), *FALLBACKS):
        try:
            return raw.decode(charset)
        except (UnicodeDecodeError, LookupError):
            continue
    return raw.decode("utf-8", "replace")


@F.arrow_udf(T.StringType())
def _decoded(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for raw, declared in batches:
        yield pa.array([None if r is None else decoded(r, d) for r, d in zip(raw.to_pylist(), declared.to_pylist(), strict=True)], pa.string())


def decode(raw: Column, declared: Column) -> Column:
    """Valid UTF-8 is read as that without leaving the engine; the rest tries the declared charset, then FALLBACKS."""
    valid = F.call_function("is_valid_utf8", raw.cast("string"))
    return F.when(valid, raw.cast("string")).otherwise(_decoded(F.when(~valid, raw), declared))
