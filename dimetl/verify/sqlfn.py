"""Oracle-side (DuckDB SQL text) spellings of the library's key and hash functions."""

from __future__ import annotations


def _parts(*exprs: str) -> str:
    return ", ".join(f"coalesce(replace(replace(CAST({e} AS VARCHAR), '\\', '\\\\'), '|', '\\|'), chr(0))" for e in exprs)


def sql_md5(*exprs: str) -> str:
    return f"md5(concat_ws('||', {_parts(*exprs)}))"


def sql_sha256(*exprs: str) -> str:
    return f"sha256(concat_ws('||', {_parts(*exprs)}))"


def sql_hash_key(*exprs: str) -> str:
    return sql_md5(*exprs)


def sql_ts_text(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%d %H:%M:%S.%g')"


def sql_first(source: str, partition: str, order: str, cols: str = "*") -> str:
    """First row per partition under an order (oracle for min_by / first-wins)."""
    return (
        f"(SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {partition} ORDER BY {order}) AS __rn "
        f"FROM {source}) WHERE __rn = 1)"
    )
