"""Mixing sources to target weights (operator 3, native).

Every document gets a hash-random key.  Keys are range-partitioned inside each
source by their leading bits, so (source, range) is a deterministic range sort
that spreads a hot source over all ranges; running sums inside a range plus the
totals of the ranges before it give the prefix sum of sizes over the source.
A source's budget is cut at its exact word: whole epochs first, then the
prefix in key order, whose last document may be taken in part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import same

#: Leading hex digits of the key that name its range: 16 ** 3 ranges a source.
RANGE_DIGITS = 3


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size) -> (source, source_size, weight, target double).

    Weights repeat over the sources in code point order, null last.  Targets are
    shares of the sum of all sizes; one above `cap` times its source's size stops there
    and the excess is reshared by weight until none is above.  That fixed point is found
    by one pass in order of size / weight: a source stops if the share it would get, once
    all sources before it have stopped, exceeds its cap.  One row per source: the window
    holds the list of sources, never documents.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    cycle = F.array(*[F.lit(w) for w in weights])
    t = totals.withColumn("weight", F.get(cycle, (F.row_number().over(in_order) - 1) % len(weights)).cast("long"))
    stops = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = stops.rowsBetween(Window.unboundedPreceding, -1)
    since = stops.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    big = "decimal(38,0)"
    t = t.withColumns({
        "cap": (F.col("source_size") * cap).cast("long"),
        "total": F.sum("source_size").over(everything),
        "left": F.sum("source_size").over(everything)
                - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0)),
        "left_w": F.sum("weight").over(since),
    })
    t = t.withColumn("stops", F.col("left").cast(big) * F.col("weight").cast(big)
                     > F.col("cap").cast(big) * F.col("left_w").cast(big))
    free = F.col("total") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(everything), F.lit(0))
    free_w = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything)
    return t.select(
        "source", "source_size", "weight",
        F.when(F.col("stops"), F.col("cap").cast("double"))
         .otherwise(free.cast("double") * F.col("weight").cast("double") / free_w.cast("double")).alias("target"),
    )


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size",
        weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: str = "mix-1") -> DataFrame:
    """`df` plus source_size long, target double and taken long (repeats counted).

    `df` is read twice: give it narrow, or materialised.  Deterministic: the key is
    md5(seed, id); equal keys (repeated ids) are ordered by size and then by all the other
    columns' hash, and rows that are still equal are interchangeable.  A null size counts as 0, a null
    source is a source of its own, a null id hashes as the empty text.  An empty table gives an empty one.
    A column of `df` named like a result is replaced.
    """
    df = df.drop("source_size", "target", "taken")
    size = F.coalesce(F.col(size_col).cast("long"), F.lit(0).cast("long"))
    rest = [c for c in df.columns if c not in (id_col, size_col, source_col)]
    keyed = df.withColumns({
        "__key": F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))),
        "__size": size,
        "__tie": F.xxhash64(*[F.col(c) for c in rest]) if rest else F.lit(0),
    }).withColumn("__range", F.substring("__key", 1, RANGE_DIGITS))

    ranges = keyed.groupBy(F.col(source_col).alias("source"), F.col("__range").alias("rng")).agg(
        F.sum("__size").alias("range_size"))
    by_source = Window.partitionBy("source")
    ahead = by_source.orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("ahead", F.coalesce(F.sum("range_size").over(ahead), F.lit(0).cast("long")))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, cap)
    o, t = offsets.alias("o"), targets.alias("t")
    plan = o.join(t, same(F.col("o.source"), F.col("t.source"))).select(
        F.col("o.source").alias("__s"), F.col("rng").alias("__r"), "ahead", "source_size", "target")

    inside = Window.partitionBy(source_col, "__range").orderBy("__key", F.col(id_col).asc_nulls_last(), "__size", "__tie") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = keyed.withColumn("__upto", F.sum("__size").over(inside))
    out = run.join(plan, same(F.col(source_col), F.col("__s")) & (F.col("__range") == F.col("__r")))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(F.lit(0).cast("long"))
    rest_words = budget - epochs * F.col("source_size")
    start = F.col("ahead") + F.col("__upto") - F.col("__size")
    cut = F.greatest(F.lit(0).cast("long"), F.least(F.col("__size"), rest_words - start))
    return out.select(*[F.col(c) for c in df.columns], "source_size", "target",
                      (epochs * F.col("__size") + cut).alias("taken"))


def apply_mix(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of `mix` (with size and taken) -> the mixed corpus: a row for every whole repeat
    and one with the leading `taken % size` words where the budget cuts a document; documents
    of which nothing is taken go.  Only the cut documents' texts change."""
    part = F.col("taken") % F.col("size")
    whole = F.expr("cast(taken div size as int)")
    lead = F.call_function("regexp_extract", F.col(text_col), F.concat(
        F.lit(r"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){"), (part - 1).cast("string"),
        F.lit(r"}+[^\x20\x09-\x0D]++")), F.lit(0))
    texts = F.concat(F.array_repeat(F.col(text_col), whole),
                     F.when(part > 0, F.array(lead)).otherwise(F.array().cast("array<string>")))
    return df.filter((F.col("size") > 0) & (F.col("taken") > 0)).withColumn(text_col, F.explode(texts))
