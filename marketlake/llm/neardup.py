"""Embedding near-dedup with spherical k-means cells (operator 2).

Vectors of a label are assigned to the nearest of the label's centroids.  A vector within `cosine` of another
is at most sqrt(2 - 2 * cosine) away from it, so it also visits every cell of a smaller number whose border is
nearer than that: no link is lost at a border, and each is found in one cell only.  Blocks of a cell's own
vectors are compared with each other and with the visitors by matrix products in double precision; a
product returns link counts and a spanning forest of its links, never its pairs.
Equal vectors are one class with a multiplicity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import given_id, ordered_id, written
from .components import components

#: Vectors a cell should have; centroids of all labels together at most; sampled vectors a cell for fitting.
CELL, CELLS_MOST, SAMPLE_PER_CELL = 1024, 4096, 32
#: Vectors of one side of a block pair, and of the slices that are multiplied at once.
BLOCK, SLICE = 4096, 512


def _clean(v) -> np.ndarray | None:
    """The unit vector, or None for null, empty, zero or non-finite ones and those that hold nulls."""
    if v is None or any(x is None for x in v):
        return None
    x = np.asarray(v, float)
    size = np.abs(x).max() if len(x) else 0.0
    if not len(x) or not np.isfinite(x).all() or not size > 0:
        return None
    x = x / size
    return x / np.linalg.norm(x)


def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids of the unit rows of `x`, started from evenly spaced rows."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        for j in range(len(c)):
            total = x[near == j].sum(axis=0)
            size = np.linalg.norm(total)
            if size > 0:
                c[j] = total / size
    return c


def _prepared(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    for b in batches:
        keys, units = [], []
        for label, v in zip(b.column(1), b.column(2), strict=True):
            raw = v.as_py()
            u = _clean(raw) if label.is_valid else None
            units.append(None if u is None else u.tobytes())
            keys.append(None if u is None else xxhash.xxh3_128_digest(np.asarray(raw, "<f8").tobytes()))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(units, pa.binary())], schema=schema)


def _cells_of(x: np.ndarray, c: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The own cell of each vector, and (row, cell) for it and all smaller cells whose border is within `reach`."""
    d = x @ c.T
    own = d.argmax(axis=1)
    best = d[np.arange(len(x)), own][:, None]
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * (c @ c.T)))[own]
    near = best - d <= reach * apart + 1e-9
    near &= np.arange(len(c))[None, :] < own[:, None]
    near[np.arange(len(x)), own] = True
    return own, np.argwhere(near)


def _dealt(batches: Iterator[pa.RecordBatch], centroids: dict, reach: float, schema: pa.Schema):
    """A row for each class and cell it belongs to or borders on."""
    for b in batches:
        labels = np.array(b.column(1).to_pylist(), dtype=object)
        units = b.column(3).to_pylist()
        rows, cells, home = [], [], []
        by: dict = {}
        for i, u in enumerate(units):
            by.setdefault((labels[i], len(u)), []).append(i)
        for (label, _), at in by.items():
            c = centroids.get(label)
            for lo in range(0, len(at), 1024):
                part = at[lo: lo + 1024]
                if c is None or c.shape[1] * 8 != len(units[part[0]]):
                    rows += part
                    cells += [0] * len(part)
                    home += [True] * len(part)
                    continue
                x = np.stack([np.frombuffer(units[i]) for i in part])
                own, near = _cells_of(x, c, reach)
                rows += [part[i] for i in near[:, 0].tolist()]
                cells += near[:, 1].tolist()
                home += (own[near[:, 0]] == near[:, 1]).tolist()
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(i).take(take) for i in range(4)] + [
            pa.array(cells, pa.int32()), pa.array(home, pa.bool_())], schema=schema)


def _product(cosine: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """One pair of blocks: link counts of its classes and a spanning forest of its links."""
        counted, linked = [], []
        for _, same in group.groupby(group["unit"].map(len)):
            a, b = same[same["is_left"]], same[same["is_right"]]
            if not len(a) or not len(b):
                continue
            one_block = bool(same["one_block"].iloc[0])
            x, y = (np.stack([np.frombuffer(u) for u in s["unit"]]) for s in (a, b))
            left, right = a["node"].tolist(), b["node"].tolist()
            many_a, many_b = a["many"].to_numpy(), b["many"].to_numpy()
            count_b = np.zeros(len(b), np.int64)
            group_of = np.arange(len(b))  # of the right rows, by the links so far
            for lo in range(0, len(a), SLICE):
                links = x[lo: lo + SLICE] @ y.T >= cosine
                if one_block:  # both sides are the same rows in the same order, each link stands twice
                    links[np.arange(len(links)), lo + np.arange(len(links))] = False
                else:
                    count_b += links.T @ many_a[lo: lo + SLICE]
                counted += zip(left[lo: lo + SLICE], (links @ many_b).tolist())
                for i in np.flatnonzero(links.any(axis=1)).tolist():
                    at = np.flatnonzero(links[i])
                    if one_block:
                        at = np.append(at, lo + i)
                    groups, first = np.unique(group_of[at], return_index=True)
                    if one_block and len(groups) == 1:
                        continue
                    if len(groups) > 1:
                        group_of[np.isin(group_of, groups)] = groups[0]
                    linked += ((left[lo + i], right[at[f]]) for f in first.tolist())
            counted += zip(right, count_b.tolist())
        counted = [x for x in counted if x[1]]
        return pd.concat([pd.DataFrame(rows, columns=names, dtype="Int64") for rows, names in (
            (counted, ["node", "links"]), (linked, ["a", "b"]))], ignore_index=True)
    return run


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    cosine: float = 0.98, cell: int = CELL, cells_most: int = CELLS_MOST,
                    sample_per_cell: int = SAMPLE_PER_CELL, block: int = BLOCK) -> DataFrame:
    """(id, n_links long, component_id long, kept boolean) for every row.

    Rows link if their labels are equal and not null and their cosine is `cosine` or more; null, zero, empty
    and non-finite vectors, and vectors of different lengths, link with nothing.  Repeated rows are
    vectors of their own; rows with a null id come after all others.  The cells are fitted on a sample of at most `cells_most * sample_per_cell`
    vectors, in order of a hash; they only decide where links are looked for, not which are found.
    An empty table gives an empty one.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    def typed(ddl: str):
        s = StructType.fromDDL(ddl)
        return s, to_arrow_schema(s)

    spark = df.sparkSession
    src = df.select(ordered_id(F.col(id_col)).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    kind = src.schema["label"].dataType.simpleString()
    s1, a1 = typed(f"id long, label {kind}, key binary, unit binary")
    vectors = written(src.mapInArrow(lambda it: _prepared(it, a1), s1), "vectors")
    node = F.xxhash64("label", "key")
    classes = vectors.filter("key is not null").groupBy("label", "key").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("many"), F.first("unit").alias("unit")).withColumn("node", node)
    classes = written(classes, "classes")

    sizes = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 2 * cell)
    total = sizes.agg(F.coalesce(F.sum(F.ceil(F.col("n") / cell)), F.lit(0))).first()[0]
    shrink = min(1.0, cells_most / total) if total else 1.0
    # labels whose share is below two cells stay whole, so at most cells_most centroids exist
    plan = sizes.withColumn("k", F.floor(F.ceil(F.col("n") / cell) * shrink).cast("int")).filter("k >= 2")
    rate = F.col("k") * sample_per_cell / F.col("n")
    sample = classes.join(plan, "label").filter(
        F.pmod(F.xxhash64(F.lit("fit"), "key"), F.lit(1 << 20)) < rate * (1 << 20)).select("label", "k", "unit")

    def fitted(g: pd.DataFrame) -> pd.DataFrame:
        g = g[g["unit"].map(len) == g["unit"].map(len).mode().iloc[0]].sort_values("unit")
        c = k_means(np.stack([np.frombuffer(u) for u in g["unit"]]), int(g["k"].iloc[0]))
        return pd.DataFrame({"label": [g["label"].iloc[0]], "dim": [c.shape[1]], "c": [c.tobytes()]})
    rows = sample.groupBy("label").applyInPandas(fitted, f"label {kind}, dim int, c binary").collect()
    centroids = {r["label"]: np.frombuffer(bytes(r["c"])).reshape(-1, r["dim"]) for r in rows}
    shared = spark.sparkContext.broadcast(centroids)

    reach = math.sqrt(2 - 2 * cosine) + 1e-6
    s2, a2 = typed(f"node long, label {kind}, many long, unit binary, cell int, home boolean")
    dealt = classes.select("node", "label", "many", "unit").mapInArrow(lambda it: _dealt(it, shared.value, reach, a2), s2)
    dealt = written(dealt, "dealt")
    counts = dealt.groupBy("label", "cell").agg(
        F.ceil(F.sum(F.col("home").cast("long")) / block).alias("own"),
        F.ceil(F.sum((~F.col("home")).cast("long")) / block).alias("visiting"))
    salt = F.xxhash64("node")
    placed = dealt.join(counts, ["label", "cell"]).withColumn("blk", F.when(
        F.col("home"), F.pmod(salt, F.col("own"))).otherwise(F.col("own") + F.pmod(salt, F.greatest("visiting", F.lit(1)))))

    def pair(left, right, is_left, is_right):
        return F.struct(left.alias("l"), right.alias("r"), F.lit(is_left).alias("is_left"), F.lit(is_right).alias("is_right"))

    def upto(first, past, one):
        return F.transform(F.when(first < past, F.sequence(first, past - 1)).otherwise(F.array().cast("array<long>")), one)
    zero, blk, own = F.lit(0).cast("long"), F.col("blk"), F.col("own")
    # own blocks meet themselves, the own blocks after them and the visitors; visitors meet own blocks only
    as_left = F.concat(F.array(pair(blk, blk, True, True)), upto(blk + 1, own + F.col("visiting"), lambda r: pair(blk, r, True, False)))
    as_right = upto(zero, F.when(F.col("home"), blk).otherwise(own), lambda x: pair(x, blk, False, True))
    pairs = F.when(F.col("home"), F.concat(as_left, as_right)).otherwise(as_right)
    sides = placed.withColumn("p", F.explode(pairs)).select(
        "label", "cell", "p.l", "p.r", "node", "many", "unit", "p.is_left", "p.is_right",
        (F.col("p.l") == F.col("p.r")).alias("one_block"))
    found = written(sides.groupBy("label", "cell", "l", "r").applyInPandas(
        _product(cosine), "node long, links long, a long, b long"), "links")

    links = found.filter("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.filter("a is not null").select("a", "b"))
    named = classes.select("node", "label", "key", "least", "many").join(links, "node", "left").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    told = named.join(groups, "root").select(
        F.col("label").alias("__l"), F.col("key").alias("__k"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"))
    v = vectors.select("id", "label", "key")
    out = v.join(told, (F.col("label") == F.col("__l")) & (F.col("key") == F.col("__k")), "left")
    comp = F.coalesce("component_id", "id")
    return out.select(given_id(F.col("id")).alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      given_id(comp).alias("component_id"), F.coalesce(comp == F.col("id"), F.lit(True)).alias("kept"))
