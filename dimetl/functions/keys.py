"""Deterministic keys and change hashes (no sequence, no driver state).

* ``row_hash``: SHA-256 over ordered columns, joined with ``||``.  NULLs are
  replaced by a NUL character first, so ``(a, NULL)`` and ``(NULL, a)`` hash
  differently (plain ``concat_ws`` skips NULLs), and ``|`` and ``\\`` inside
  values are escaped, so a value cannot imitate the separator.
* ``md5_key``: MD5 over ordered columns (string play keys).
* ``hash_key``: the MD5 as 32 hex digits (128 bits: at 10^12 rows two keys meet
  with a probability under 10^-14); used as the default surrogate key.  Any
  executor computes the same key for the same business key, so loads are
  repeatable and need no coordination.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column separator of hashed keys and the NULL marker.
KEY_SEPARATOR = "||"
NULL_TOKEN = "\u0000"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _joined(cols, null_token: str | None = NULL_TOKEN) -> Column:
    parts = [F.regexp_replace(_c(c).cast("string"), r"([\\|])", r"\\$1") for c in cols]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.concat_ws(KEY_SEPARATOR, *parts)


def row_hash(*cols: str | Column, null_token: str | None = NULL_TOKEN) -> Column:
    if not cols:
        raise ValueError("row_hash needs at least one column")
    return F.sha2(_joined(cols, null_token), 256)


def md5_key(*cols: str | Column, null_token: str | None = NULL_TOKEN) -> Column:
    if not cols:
        raise ValueError("md5_key needs at least one column")
    return F.md5(_joined(cols, null_token))


def hash_key(*cols: str | Column) -> Column:
    """128-bit key of the columns as hex text."""
    if not cols:
        raise ValueError("hash_key needs at least one column")
    return md5_key(*cols)


def ts_text(c: str | Column) -> Column:
    """Millisecond timestamp text used inside keys (explicit format, engine-neutral)."""
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss.SSS")
