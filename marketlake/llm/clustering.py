"""Centroid clustering with geometric drift tightening (operator 12).

Every vector carries its cluster, an upper bound of the distance to its centroid and a lower bound of the distance to
any other.  After a round the bounds are loosened by how far centroids have moved.  A lower bound need not lose a
centroid's full drift: all vectors of a cluster lie in a sphere about its old centroid, and in the plane through that
centre and the old and new place of another centroid, the sphere is a disc that bounds how much nearer the
other can have come.  Vectors whose bounds still part are left alone; ambiguous ones are scanned exactly, in integers.

Vectors and bounds are one table, written anew each round without a shuffle; the driver sees sums by
cluster only, and only of the vectors that have changed their cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written, written_at

SIZE, CLUSTERS, ROUNDS, SCALE, SALT = 64, 8, 10, 1024, "3"
#: Components are kept below this, so that squared distances stay exact in 64 bits.
MOST = 1 << 25
#: Bounds are rounded outwards by these shares: of themselves, and of a drift that went through square roots.
ROUNDING, ROOTS = 1e-12, 1e-6


def whole_numbers(column: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, floor(scale * x) of their components): rows of exactly `size` finite components."""
    length = np.asarray(column.value_lengths().fill_null(-1))
    at = np.flatnonzero(length == size)
    flat = column.take(pa.array(at)).flatten().cast(pa.float64(), safe=False)
    x = np.asarray(flat.fill_null(np.nan), np.float64).reshape(len(at), size)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(x * scale)
        good = (np.abs(x) < MOST).all(axis=1)
    return at[good], x[good].astype(np.int32)


def _prepared(batches: Iterator[pa.RecordBatch], size: int, scale: int, schema: pa.Schema):
    for b in batches:
        at, x = whole_numbers(b.column(1), size, scale)
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array([r.tobytes() for r in x], pa.binary())], schema=schema)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of `x` from those of `c`."""
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


def loosening(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """How much less than from `old` the distance from `new` can be, at most, for any point within `radius` of `centre`.

    In the plane of the three, seen from the middle between `old` and `new`, a point at an angle t from the way of the
    move is nearer to `new` by |new - old| * cos(t) at most.  The smallest angle of the sphere's disc is the centre's
    less that of the disc's tangent.
    """
    move = new - old
    drift = float(np.linalg.norm(move))
    if not drift:
        return 0.0
    away = centre - (old + new) / 2
    along, far = float(away @ move) / drift, float(np.linalg.norm(away))
    aside = float(np.sqrt(max(0.0, far * far - along * along)))
    if far <= radius or (along > 0 and aside <= radius):
        return drift
    half = radius / far
    cosine = along / far * np.sqrt(max(0.0, 1 - half * half)) + aside / far * half
    return float(min(drift, max(0.0, drift * cosine) + ROOTS * drift))


def _step(batches: Iterator[pa.RecordBatch], c: np.ndarray, drift: np.ndarray, loosened: np.ndarray, schema: pa.Schema):
    """Vectors with the bounds of the round before -> with those of this one."""
    for b in batches:
        n = b.num_rows
        x = np.frombuffer(b"".join(b.column(1).to_pylist()), "<i4").reshape(n, c.shape[1]).astype(np.int64)
        was, upper, lower = (b.column(i).to_numpy() for i in (2, 3, 4))
        own, upper, lower = was.copy(), upper.copy(), lower.copy()
        known = was >= 0
        upper[known] = (upper[known] + drift[was[known]]) * (1 + ROUNDING)
        loose = loosened[was[known]]
        lower[known] = lower[known] - loose - ROUNDING * (lower[known] + loose)
        open_ = np.flatnonzero(~known | (upper >= lower))
        if len(open_):  # the own distance may settle it
            mine = open_[known[open_]]
            upper[mine] = np.sqrt(((x[mine] - c[own[mine]]) ** 2).sum(axis=1)) * (1 + ROUNDING)
            open_ = np.flatnonzero(~known | (upper >= lower))
        scanned = np.zeros(n, bool)
        if len(open_):
            d = squared(x[open_], c)
            near = d.argmin(axis=1)  # the smaller number of equal ones
            own[open_], scanned[open_] = near, True
            at = np.arange(len(open_))
            upper[open_] = np.sqrt(d[at, near]) * (1 + ROUNDING)
            if len(c) > 1:
                d[at, near] = np.iinfo(np.int64).max
                lower[open_] = np.sqrt(d.min(axis=1)) * (1 - ROUNDING)
            else:
                lower[open_] = np.inf
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(v, f.type) for v, f in zip(
            (own, upper, lower, was, scanned), list(schema)[2:], strict=True)]], schema=schema)


def _moved(batches: Iterator[pa.RecordBatch], k: int, size: int, schema: pa.Schema):
    """Change of each cluster's sums and count (place -1) by the vectors of a task that went or came."""
    total, count = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
    for b in batches:
        x = np.frombuffer(b"".join(b.column(0).to_pylist()), "<i4").reshape(-1, size).astype(np.int64)
        now, was = b.column(1).to_numpy(), b.column(2).to_numpy()
        left = was >= 0
        np.add.at(total, now, x)
        np.subtract.at(total, was[left], x[left])
        count += np.bincount(now, minlength=k) - np.bincount(was[left], minlength=k)
    table = np.concatenate([count[:, None], total], axis=1)
    cluster, place = np.nonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(place - 1, pa.int32()),
                                      pa.array(table[cluster, place], pa.int64())], schema=schema)


def _distances(batches: Iterator[pa.RecordBatch], c: np.ndarray, schema: pa.Schema):
    for b in batches:
        x = np.frombuffer(b"".join(b.column(1).to_pylist()), "<i4").reshape(b.num_rows, c.shape[1]).astype(np.int64)
        own = b.column(2).to_numpy()
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(((x - c[own]) ** 2).sum(axis=1), pa.int64())], schema=schema)


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
            size: int = SIZE, scale: int = SCALE, salt: str = SALT, work: list | None = None) -> DataFrame:
    """(id, cluster int, distance long, cluster_inertia long, inertia long, centroid array<int>) of every vector kept.

    Kept are vectors of exactly `size` components, none of them null or non-finite; a component x counts as
    floor(scale * x), which must lie within 25 bits (others are left out: their squared distances have no 64-bit
    value).  The first centroids are the k vectors with the smallest sha256 of `salt:id`; rows that share an id are told
    apart by their components, and rows without one come last.  Fewer vectors than k give fewer centroids, none an empty table.
    Repeated rows are vectors of their own; extra columns are left out.  A vector equally near to two centroids goes to the
    smaller number; a centroid without vectors stays.  `work` receives the number of vectors scanned in each round.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BinaryType, StructField, StructType

    spark = df.sparkSession

    def typed(*fields):
        s = StructType([StructField(id_col, df.schema[id_col].dataType), *StructType.fromDDL(", ".join(fields)).fields])
        return s, to_arrow_schema(s)

    s0 = StructType([StructField(id_col, df.schema[id_col].dataType), StructField("v", BinaryType())])
    a0 = to_arrow_schema(s0)
    vectors = df.select(id_col, vector_col).mapInArrow(lambda it: _prepared(it, size, scale, a0), s0).select(
        "*", F.lit(-1).alias("cluster"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"))
    table, path = written_at(vectors, "vectors")
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(id_col).cast("string")), 256)
    first = table.select("v", key.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    out, arrow = typed("cluster int", "distance long")
    if not first:
        return spark.createDataFrame([], StructType([*out.fields, *StructType.fromDDL(
            "cluster_inertia long, inertia long, centroid array<int>").fields]))
    c = np.stack([np.frombuffer(r[0], "<i4") for r in first]).astype(np.int64)
    k = len(c)
    total, count = [[0] * size for _ in range(k)], [0] * k
    drift, loosened = np.zeros(k), np.zeros(k)
    s1, a1 = typed("v binary", "cluster int", "upper double", "lower double", "was int", "scanned boolean")
    s2 = StructType.fromDDL("cluster int, place int, n long")
    a2 = to_arrow_schema(s2)
    for r in range(rounds + 1):
        # this round's centroids go to the tasks by value: k * size numbers
        now, now_path = written_at(table.select(id_col, "v", "cluster", "upper", "lower").mapInArrow(
            lambda it, c=c, drift=drift, loosened=loosened: _step(it, c, drift, loosened, a1), s1), "vectors")
        forget(spark, path)
        table, path = now, now_path
        if work is not None:
            work.append(table.where("scanned").count())
        if r == rounds:
            break
        changed = table.where("cluster <> was").select("v", "cluster", "was").mapInArrow(
            lambda it: _moved(it, k, size, a2), s2).groupBy("cluster", "place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
        for row in changed.collect():  # k * (size + 1) rows
            if row["place"] < 0:
                count[row["cluster"]] += int(row["n"])
            else:
                total[row["cluster"]][row["place"]] += int(row["n"])
        radius = {x[0]: x[1] for x in table.groupBy("cluster").agg(F.max("upper")).collect()}  # k rows
        new = np.array([[t // n for t in row] if n else old.tolist() for row, n, old in zip(total, count, c, strict=True)], np.int64)
        a, b = c.astype(float), new.astype(float)
        drift = np.linalg.norm(b - a, axis=1) * (1 + ROUNDING)
        loosened = np.array([max((loosening(a[i], radius.get(i, 0.0) * (1 + ROUNDING), a[j], b[j]) for j in range(k) if j != i), default=0.0)
                             for i in range(k)])
        c = new
    far = written(table.select(id_col, "v", "cluster").mapInArrow(lambda it: _distances(it, c, arrow), out), "distances")
    forget(spark, path)
    inertia = far.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()  # k rows
    whole = sum(x["n"] for x in inertia)
    facts = spark.createDataFrame([(x["cluster"], x["n"], whole, c[x["cluster"]].tolist()) for x in inertia],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<int>")
    return far.join(F.broadcast(facts), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def report(clustered: DataFrame) -> DataFrame:
    return clustered.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(
        F.array_join("centroid", ","), 256).alias("centroid_sha256"))
