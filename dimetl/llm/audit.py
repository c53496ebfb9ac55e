"""Filter interaction audit: what every order of a set of filters removes at every step.

One pass over the texts gives each document a mask of the filters it fails;
documents are then only counts per (part, mask), at most 2^k cells a part.  All
prefixes of all filter orders come from a recursive CTE over those cells: each
level extends every prefix by each unused letter, joins the part's mask cells
and carries the bits applied so far, so it emits the metrics of its own step.
An order's step is the prefix of that length, which is computed once however
many orders share it.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimetl.llm.common import id_col, materialise, text_or_empty

#: White space that separates words.
_SPACE = r"[ \t-\r]+"
LETTERS = "ABCDE"


def text_conditions(text: Column) -> dict[str, Column]:
    """Failure conditions that need the text alone: short, repetitive, upper case, signs."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.split(trimmed, _SPACE)
    n = F.when(trimmed == "", 0).otherwise(F.size(words)).cast("long")
    distinct = F.when(trimmed == "", 0).otherwise(F.size(F.array_distinct(words))).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 200,
        "B": 100 * distinct < 50 * n,
        "C": 100 * capitals.cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _bits(conditions: dict[str, Column], letters: str) -> Column:
    mask = F.lit(0)
    for letter, fails in conditions.items():
        mask = mask + F.when(fails, 1 << letters.index(letter)).otherwise(0)
    return mask


def failure_masks(docs: DataFrame, part_column: str = "source", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, part, mask`` of every row; bit n of the mask: the n-th of the filters A-E fails.

    Filter E fails a row whose text another row with a smaller id has, anywhere
    in the table.  Texts are compared by their SHA-256, so no text is shuffled;
    a text's smallest id is found with partial aggregation, and only texts with
    more than one id meet the rows again, on a plain exchange that AQE can split.
    A null id is no smaller than any and has none smaller.
    """
    text = text_or_empty(text_column)
    rows = docs.select(
        id_col(id_column).alias("doc_id"),
        F.coalesce(F.col(f"`{part_column}`").cast("string"), F.lit("")).alias("part"),
        _bits(text_conditions(text), LETTERS).alias("own"),
        F.unhex(F.sha2(text, 256)).alias("key"),
    )
    rows = materialise(rows, "audit-rows")
    ids = rows.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    repeated = materialise(ids.filter("lo < hi").select(F.col("key").alias("rkey"), "lo"), "audit-repeated")
    later = F.coalesce(F.col("doc_id") > F.col("lo"), F.lit(False))
    return rows.join(repeated, F.col("key") == F.col("rkey"), "left").select(
        "doc_id", "part", (F.col("own") + F.when(later, 1 << LETTERS.index("E")).otherwise(0)).alias("mask")
    )


def mask_cells(masks: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``part, mask, docs, good, toxic`` counts; a document is good (toxic) if some label row of its id says so."""
    marks = labels.filter(F.col(f"`{id_column}`").isNotNull()).groupBy(id_col(id_column).alias("label_id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
    )
    marks = materialise(marks.filter("good + toxic > 0"), "audit-labels")
    joined = masks.join(marks, F.col("doc_id") == F.col("label_id"), "left")
    return joined.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.coalesce("good", F.lit(0))).cast("long").alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).cast("long").alias("toxic"),
    )


def _walk_sql(letters: str) -> str:
    """The recursive CTE: one row per part and prefix of distinct letters, with the metrics of its last letter."""
    alphabet = ", ".join(f"('{c}', {1 << n})" for n, c in enumerate(letters))

    def total(what: str, when: str) -> str:
        return f"aggregate(p.cells, 0L, (s, c) -> s + if({when}, c.{what}, 0L))"

    here = "(c.mask & w.applied) = 0 AND (c.mask & l.bit) <> 0"
    return f"""
WITH RECURSIVE
letters(letter, bit) AS (VALUES {alphabet}),
walk(part, prefix, applied, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
  SELECT part, '', 0, 0, 0L, 0L, 0L, 0L, 0L, 0L FROM {{parts}}
  UNION ALL
  SELECT w.part, concat(w.prefix, l.letter), w.applied | l.bit, w.step + 1,
         {total('docs', '(c.mask & (w.applied | l.bit)) = 0')},
         {total('docs', here)},
         {total('docs', '(c.mask & w.applied) <> 0 AND (c.mask & l.bit) <> 0')},
         {total('docs', 'c.mask = l.bit')},
         {total('good', here)},
         {total('toxic', here)}
  FROM walk w
  JOIN letters l ON (w.applied & l.bit) = 0
  JOIN {{parts}} p ON p.part = w.part
)
SELECT part, prefix, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost FROM walk WHERE step > 0"""


_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def prefix_metrics(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part and non-empty prefix of every order: the metrics of the prefix's last step.

    Written at once: the recursion's row limit is a session setting, and rows
    grow with the number of parts, so it is lifted only while this runs.
    """
    spark = cells.sparkSession
    packed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("cells"))
    parts = materialise(packed, "audit-parts")
    before = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        return materialise(spark.sql(_walk_sql(letters), parts=parts), "audit-walk")
    finally:
        spark.conf.set(_ROW_LIMIT, before)


def all_orders(metrics: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``part, filter_order, step`` and the metrics of every step of every order, with each filter's Shapley count.

    ``shapley`` is what the step's filter removes, summed over all orders: each
    prefix counts once for every order that begins with it.
    """
    spark, k = metrics.sparkSession, len(letters)
    weight = F.element_at(F.array(*[F.lit(factorial(k - n)) for n in range(1, k + 1)]), F.col("step")).cast("long")
    last = F.substring("prefix", -1, 1)
    shapley = metrics.groupBy("part", last.alias("letter")).agg(F.sum(F.col("removed") * weight).alias("shapley"))
    orders = F.explode(F.array(*[F.lit("".join(p)) for p in permutations(letters)]))
    # k! orders of k steps: a fixed, small table.
    steps = spark.range(1).select(orders.alias("filter_order")).select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
    steps = steps.select("filter_order", F.expr("substring(filter_order, 1, step)").alias("prefix"))
    with_shapley = metrics.withColumn("letter", last).join(shapley, ["part", "letter"])
    return with_shapley.join(F.broadcast(steps), "prefix").select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit_filters(docs: DataFrame, labels: DataFrame, part_column: str = "source", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The audit of the five filters over whole texts: one row per part, order and step.

    Null texts are empty; null parts are the empty string, and one with it.
    Repeated rows count as documents of their own.  Labels of null ids, of ids
    without a document, and labels other than 1 count nowhere; repeated labels
    count once.  An empty table gives no rows.  Extra columns play no part.
    """
    masks = failure_masks(docs, part_column, id_column, text_column)
    cells = mask_cells(masks, labels, id_column)
    return all_orders(prefix_metrics(cells))


#: Oracle: the same definitions, with every order evaluated on every cell directly.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
),
w AS (
  SELECT doc_id, part, t, list_filter(string_split_regex(t, '[ \t-\r]+'), lambda x: x <> '') AS ws,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS caps, min(doc_id) OVER (PARTITION BY t) AS lo
  FROM d
),
m AS (
  SELECT doc_id, part,
         (CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END)
       + (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END)
       + (CASE WHEN 100 * caps > 2 * length(t) THEN 4 ELSE 0 END)
       + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
       + (CASE WHEN lo < doc_id THEN 16 ELSE 0 END) AS mask
  FROM w
),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS docs, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask
),
f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT a.letter || b.letter || x.letter || y.letter || z.letter AS filter_order
  FROM f a, f b, f x, f y, f z WHERE a.bit + b.bit + x.bit + y.bit + z.bit = 31 AND (a.bit | b.bit | x.bit | y.bit | z.bit) = 31
),
s AS (
  SELECT filter_order, n AS step, (SELECT bit FROM f WHERE letter = substr(filter_order, n, 1)) AS bit,
         coalesce((SELECT sum(bit) FROM f WHERE instr(substr(filter_order, 1, n - 1), letter) > 0), 0)::INTEGER AS applied
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS n)
),
r AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (applied | bit) = 0 THEN docs ELSE 0 END) AS kept,
         sum(CASE WHEN mask & applied = 0 AND mask & bit <> 0 THEN docs ELSE 0 END) AS removed,
         sum(CASE WHEN mask & applied <> 0 AND mask & bit <> 0 THEN docs ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN docs ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & applied = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & applied = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
"""
