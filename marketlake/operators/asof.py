"""As-of joins (J4, J5) as one tagged union + a running window.

Spark has no public as-of join, and a range join would multiply rows.  Both
sides are unioned, ordered by (key, side), and every probe row takes the
last non-null right-side struct before it.  Which side sorts first at equal
keys decides strict (<) versus inclusive (<=).

Skew: the window is partitioned by `by` plus an optional bucket of the key
(e.g. the month of a date, the hour of a timestamp), so a hot symbol is
split into many tasks.  A probe whose bucket holds no earlier right row takes
the carry: the last right row of any earlier bucket, computed on the small
(by, bucket) aggregate.  A bucket must be a monotone function of the key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_key: str,
    right_key: str,
    values: Sequence[str],
    *,
    strict: bool,
    right_order: Sequence[str] = (),
    bucket: Callable[[Column], Column] | None = None,
    forward: bool = False,
) -> DataFrame:
    """Attach to each left row the `values` of the last right row with
    right_key < left_key (strict) or <= (inclusive), per `by`.

    With `forward=True` it is the first right row with key > (strict) or >=.
    Left rows without a match get nulls.  `values` must not clash with left
    column names; `right_order` breaks ties between right rows at equal key
    (the last one wins backward, the first one forward).
    """
    by = list(by)
    lcols = left.columns
    vstruct = F.struct(*[F.col(v) for v in values])
    # ascending (backward): side 0 sorts first at equal keys;
    # descending (forward): side 1 sorts first
    if forward:
        l_side, r_side = (1, 0) if strict else (0, 1)
    else:
        l_side, r_side = (0, 1) if strict else (1, 0)
    l = left.select(*[F.col(c) for c in lcols], F.col(left_key).alias("_k"),
                    F.lit(l_side).alias("_side"), F.lit(True).alias("_is_left"))
    r = right.select(*[F.col(b) for b in by], F.col(right_key).alias("_k"),
                     F.lit(r_side).alias("_side"), F.lit(False).alias("_is_left"),
                     vstruct.alias("_v"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(right_order)])
    u = l.unionByName(r, allowMissingColumns=True)
    part = list(by)
    if bucket is not None:
        u = u.withColumn("_b", bucket(F.col("_k")))
        part.append("_b")
    ords = [F.col("_k"), F.col("_side")] + [F.col(f"_o{i}") for i in range(len(right_order))]
    if forward:
        ords = [o.desc() for o in ords]
    w = Window.partitionBy(*part).orderBy(*ords)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    u = u.withColumn("_m", F.last("_v", ignorenulls=True).over(running))
    if bucket is None:
        found = u.where("_is_left")
    else:
        # the bucket's boundary right row comes from the same window pass
        # (whole-partition frame), so the carry reuses the window's shuffle
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        u = u.withColumn("_bl", F.last("_v", ignorenulls=True).over(whole))
        found = u.where("_is_left")
        per_bucket = u.groupBy(*by, "_b").agg(F.first("_bl", ignorenulls=True).alias("_bv"))
        wb = Window.partitionBy(*by).orderBy(F.col("_b").desc() if forward else F.col("_b"))
        carry = per_bucket.select(
            *by, "_b",
            F.last("_bv", ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_c"))
        found = (found.join(carry, on=[*by, "_b"], how="left")
                 .withColumn("_m", F.coalesce("_m", "_c")))
    return found.select(*[F.col(c) for c in lcols], *[F.col("_m")[v].alias(v) for v in values])


#: Ranges that a task gets on average, the fewest and the most rows of a range, and splitters of one key at most.
RANGES_PER_TASK, LEAST_ROWS, MOST_ROWS, SPLITTERS_MOST = 8, 50_000, 200_000, 4096


class _Ranges:
    """Splitters of the keys that hold more rows than a range should, as counted in the data."""

    def __init__(self, counted: DataFrame, by: list[str], rows_per_range: int | None, least_rows: int):
        spark = counted.sparkSession
        per_key = counted.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        total = 0 if rows_per_range else per_key.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
        # what a task sorts and a window holds does not grow with the table
        target = rows_per_range or max(least_rows, min(MOST_ROWS, -(-total // (RANGES_PER_TASK * tasks))))
        self.tasks = -(-total // MOST_ROWS)
        hot = per_key.where(F.col("_n") > target).collect()  # at most total / target keys
        self.by, self.rows, self.frame, self.every = by, [], None, None
        if not hot:
            return
        parts = min(SPLITTERS_MOST, max(-(-r["_n"] // target) for r in hot))
        keys = [f for f in per_key.schema.fields if f.name in by]
        known = spark.createDataFrame([tuple(r[b] for b in by) for r in hot], T.StructType([T.StructField(f"_h{i}", next(
            f.dataType for f in keys if f.name == b)) for i, b in enumerate(by)]))
        self.on = [F.col(b).eqNullSafe(F.col(f"_h{i}")) for i, b in enumerate(by)]
        quantiles = counted.join(F.broadcast(known), self.on, "left_semi").groupBy(*by).agg(
            F.count(F.lit(1)).alias("_n"), F.percentile_approx("_k", [i / parts for i in range(1, parts)], 10 * SPLITTERS_MOST).alias("_q"))
        kind = counted.schema["_k"].dataType
        rows, every = [], []
        for r in quantiles.collect():
            mine = -(-r["_n"] // target)  # of `parts` quantiles, as many as this key has ranges
            q = sorted({r["_q"][i * parts // mine - 1] for i in range(1, mine) if i * parts // mine >= 1})
            wide = max(1, math.isqrt(len(q)))
            chunks = [q[i: i + wide] for i in range(0, len(q), wide)] or [[]]
            key = tuple(r[b] for b in by)
            rows.append((*key, [c[0] for c in chunks[1:]], chunks, wide + 1))
            every += [(*key, i * (wide + 1) + j) for i, c in enumerate(chunks) for j in range(len(c) + 1)]
        fields = list(known.schema.fields)
        self.frame = spark.createDataFrame(rows, T.StructType([*fields, T.StructField("_tops", T.ArrayType(kind)), T.StructField(
            "_chunks", T.ArrayType(T.ArrayType(kind))), T.StructField("_wide", T.IntegerType())]))
        self.every = spark.createDataFrame(every, T.StructType([*fields, T.StructField("_b", T.IntegerType())]))

    def number(self, df: DataFrame) -> DataFrame:
        """`df` with the number `_b` of its range: 0 for keys that are one range.  Splitters are looked up in two steps, chunk and
        place, so a row costs about the square root of their number."""
        if self.frame is None:
            return df.withColumn("_b", F.lit(0))
        # as many rows as hot keys, each with SPLITTERS_MOST splitters at most
        j = df.join(F.broadcast(self.frame), self.on, "left")
        chunk = F.size(F.filter("_tops", lambda s: s <= F.col("_k")))
        j = j.withColumn("_c", chunk)
        place = F.size(F.filter(F.get("_chunks", F.col("_c")), lambda s: s <= F.col("_k")))
        b = F.when(F.col("_wide").isNotNull() & F.col("_k").isNotNull(), F.col("_c") * F.col("_wide") + place).otherwise(F.lit(0))
        return j.withColumn("_b", b).drop("_c", "_tops", "_chunks", "_wide", *[f"_h{i}" for i in range(len(self.by))])


def asof_measured(left: DataFrame, right: DataFrame, by: Sequence[str], left_key: str, right_key: str, values: Sequence[str], *,
                  strict: bool, right_order: Sequence[str] = (), forward: bool = False, rows_per_range: int | None = None,
                  least_rows: int = LEAST_ROWS) -> DataFrame:
    """`asof_backward` without a bucket to choose: keys that hold more rows than a range should are cut at quantiles of
    their own rows, so a busy hour, or one busy minute of it, is spread over as many tasks as it needs.

    Counts of rows per key find the hot keys; only for those are quantiles taken.  Each range of a hot key starts with a row
    that carries the last right row of the ranges before it (the first of those after it with `forward`), so one window pass over (by, range) gives
    every left row its match.  Rows of one key at one instant stay together.  A null left key matches nothing, a null right key is never matched.
    """
    by, lcols = list(by), left.columns
    order_cols = [f"_o{i}" for i in range(len(right_order))]
    if forward:
        l_side, r_side = (1, 0) if strict else (0, 1)
    else:
        l_side, r_side = (0, 1) if strict else (1, 0)
    l = left.withColumns({"_k": F.col(left_key), "_side": F.lit(l_side), "_is_left": F.lit(True)})
    r = right.where(F.col(right_key).isNotNull()).select(
        *by, F.col(right_key).alias("_k"), F.lit(r_side).alias("_side"), F.lit(False).alias("_is_left"),
        F.struct(*values).alias("_v"), *[F.col(o).alias(c) for o, c in zip(right_order, order_cols, strict=True)])
    ranges = _Ranges(l.select(*by, "_k").unionByName(r.select(*by, "_k")), by, rows_per_range, least_rows)
    u = ranges.number(l.unionByName(r, allowMissingColumns=True)).withColumn("_carry", F.lit(0))
    if ranges.frame is not None:
        rank = F.struct("_k", *order_cols)
        last = (F.min_by if forward else F.max_by)("_v", rank)
        held = ranges.number(r.join(F.broadcast(ranges.frame.select(*[f"_h{i}" for i in range(len(by))])), ranges.on, "left_semi")).groupBy(
            *by, "_b").agg(last.alias("_bv"))
        e = ranges.every.select(*[F.col(f"_h{i}").alias(b) for i, b in enumerate(by)], "_b")
        joined = e.alias("e").join(held.alias("h"), [F.col(f"e.{c}").eqNullSafe(F.col(f"h.{c}")) for c in [*by, "_b"]], "left").select("e.*", "_bv")
        before = Window.partitionBy(*by).orderBy(F.col("_b").desc() if forward else F.col("_b")).rowsBetween(Window.unboundedPreceding, -1)
        carried = joined.select(*by, "_b", F.last("_bv", ignorenulls=True).over(before).alias("_v")).where("_v is not null")
        u = u.unionByName(carried.withColumns({"_carry": F.lit(1), "_is_left": F.lit(False)}), allowMissingColumns=True)
    ords = [F.col("_k"), F.col("_side"), *[F.col(c) for c in order_cols]]
    if forward:
        ords = [o.desc() for o in ords]
    running = Window.partitionBy(*by, "_b").orderBy(F.col("_carry").desc(), *ords).rowsBetween(Window.unboundedPreceding, 0)
    if ranges.tasks > 1:  # by counted rows: repeated values shuffle as few bytes, but are sorted whole
        u = u.repartition(ranges.tasks, *by, "_b")
    found = u.withColumn("_m", F.last("_v", ignorenulls=True).over(running)).where("_is_left")
    return found.select(*[F.col(c) for c in lcols], *[F.when(F.col("_k").isNotNull(), F.col("_m")[v]).alias(v) for v in values])
