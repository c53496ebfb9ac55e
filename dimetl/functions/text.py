"""Text cleaning functions: column expressions built from JVM-side built-ins."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values -------------------------------------------------------------
# HTML tag remover that keeps <a ...> and </a> (Java regex, lookaheads).
TAG_PATTERN = r"<(?!/?a(?:>|\s[^>\n\r\u0085\u2028\u2029]*>))[^>\n\r\u0085\u2028\u2029]*>"
# Code points removed from listing text fields: left and right double
# quotation marks, heavy black heart, variation selector-16.
REMOVED_CODE_POINTS = "“”❤️"
# Characters that end the numeric part of a price text.
PRICE_STOP_CHARS = ",€$£"
UNKNOWN = "Unknown"
# --------------------------------------------------------------------------


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_tags(c: str | Column) -> Column:
    """Remove every HTML tag except anchors (``<a ...>``, ``</a>``)."""
    return F.regexp_replace(_c(c), TAG_PATTERN, "")


def limit_length(c: str | Column, n: int) -> Column:
    """Keep at most ``n`` characters."""
    if n <= 0:
        raise ValueError("length threshold must be positive")
    return F.substring(_c(c), 1, n)


def remove_unicode(c: str | Column) -> Column:
    return F.translate(_c(c), REMOVED_CODE_POINTS, "")


def absolute_url(prefix: str | Column, c: str | Column) -> Column:
    """Absolute URL: ``prefix`` (a literal base or a per-row host column) + relative path."""
    return F.concat(prefix if isinstance(prefix, Column) else F.lit(prefix), _c(c))


def parse_price_text(c: str | Column) -> Column:
    """Price text -> its numeric part as text; ``"Unknown"`` if there is none.

    ``"250 000,00 €"`` -> ``"250000"``.
    """
    pattern = "^([^" + re.escape(PRICE_STOP_CHARS) + "]+)"
    part = F.regexp_extract(F.replace(_c(c), F.lit(" "), F.lit("")), pattern, 1)
    return F.when(part == "", F.lit(UNKNOWN)).otherwise(part)


def parse_price(c: str | Column) -> Column:
    """Price text -> double (NULL when no number can be read)."""
    return parse_price_text(c).try_cast("double")


def split_location(c: str | Column) -> Column:
    """``"Country, District (x), County, Parish, City"`` -> struct(district, county, parish).

    Token i (1-based 2..4) is cut before any ``(`` and trimmed; absent tokens
    give NULL.
    """
    tokens = F.split(_c(c), ",")

    def tok(i: int) -> Column:
        return F.trim(F.regexp_extract(F.try_element_at(tokens, F.lit(i)), r"^[^(]+", 0))

    return F.struct(tok(2).alias("district"), tok(3).alias("county"), tok(4).alias("parish"))


def digit_sum(c: str | Column) -> Column:
    """Sum of every decimal digit in the text (``"2 Box + 1"`` -> 3)."""
    digits = F.regexp_extract_all(_c(c), F.lit(r"\d"), 0)
    return F.aggregate(F.transform(digits, lambda x: x.cast("int")), F.lit(0), lambda acc, x: acc + x)


def snake_case(name: str) -> str:
    """``PriceCurrencyFormated`` -> ``price_currency_formated``: every capital starts a word."""
    words: list[str] = []
    for char in name:
        if char.isspace():
            words.append("")
        elif char.isupper() or not words:
            words.append(char.lower())
        else:
            words[-1] += char
    return "_".join(w for w in words if w)


def rename_snake(df: DataFrame) -> DataFrame:
    """All column names to snake case, in one projection."""
    return df.select([F.col(f"`{c}`").alias(snake_case(c)) for c in df.columns])


def rename_mapped(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep and rename only the mapped columns (unknown keys are dropped)."""
    present = set(df.columns)
    return df.select([F.col(f"`{src}`").alias(dst) for src, dst in mapping.items() if src in present])


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def canonical_zero(c: Column) -> Column:
    """``-0.0`` -> ``0.0`` (other values, NULL included, unchanged)."""
    return F.when(c == 0, F.lit(0.0)).otherwise(c)


def fill_missing(
    df: DataFrame,
    numeric: list[str],
    textual: list[str],
    numeric_fill: float = -1,
    text_fill: str = UNKNOWN,
) -> DataFrame:
    """Cast the numeric attributes to double, then fill missing values.

    Casting first matters: a numeric fill on a string column is a no-op.  A
    negative zero is made ``0.0`` so equal values hash equally (``"-0"`` and
    ``"0"`` must not look like a change).
    """
    present = set(df.columns)
    casts = {c: canonical_zero(F.col(c).try_cast("double")) for c in numeric if c in present}
    out = df.withColumns(casts) if casts else df
    num = [c for c in numeric if c in present]
    txt = [c for c in textual if c in present]
    if num:
        out = out.fillna(float(numeric_fill), subset=num)
    if txt:
        out = out.fillna(text_fill, subset=txt)
    return out


def clean_strings(
    df: DataFrame,
    max_lengths: dict[str, int] | None = None,
    default_max_length: int | None = None,
    blanks_as_null: bool = True,
    empty_as_null: bool = True,
    truncate: bool = True,
) -> DataFrame:
    """COPY-style cleaning of every string column.

    ``empty_as_null``: ``''`` -> NULL; ``blanks_as_null``: whitespace-only ->
    NULL; ``truncate``: cut at the column's declared length (characters);
    a column without one is not cut unless ``default_max_length`` says so.
    """
    max_lengths = max_lengths or {}
    exprs = {}
    for f in df.schema.fields:
        if not isinstance(f.dataType, T.StringType):
            continue
        v = F.col(f"`{f.name}`")
        if empty_as_null:
            v = F.when(v == "", F.lit(None).cast("string")).otherwise(v)
        if blanks_as_null:
            v = F.when(F.trim(v) == "", F.lit(None).cast("string")).otherwise(v)
        n = max_lengths.get(f.name, default_max_length)
        if truncate and n:
            v = F.substring(v, 1, n)
        exprs[f.name] = v
    return df.withColumns(exprs) if exprs else df


def typed_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Coerce text columns to declared types; unreadable values become NULL."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()})
