"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios (operator 9).

Features are the distinct hashed 3- to 5-grams of code points of the lower-cased text.  Each is scaled by the
log ratio of its smoothed document counts in toxic and other training texts; a logistic regression is
fitted on the scaled features of a bounded sample of labelled rows, and its weights, one vector of
fixed size, score every whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

ORDERS = (3, 4, 5)
BITS = 18
#: Bound of the labelled sample: so many rows of each class, in order of a hash of the id.
PER_CLASS = 1200
#: Characters of a text that are featurised at once; pieces overlap by the longest n-gram, so none is lost.
CHUNK = 1 << 20


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    text = (text or "").lower()
    found = []
    for at in range(0, max(1, len(text)), CHUNK):
        piece = text[at: at + CHUNK + max(ORDERS) - 1]
        c = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4")
        h = np.zeros(len(c), np.uint32)
        seen = np.zeros(1 << BITS, bool)
        for n in range(1, max(ORDERS) + 1):
            m = len(c) - n + 1
            if m <= 0:
                break
            h = (h[:m] ^ (c[n - 1: n - 1 + m] * np.uint32(0x9E3779B1))) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
            if n in ORDERS:
                seen[h >> np.uint32(32 - BITS)] = True
        found.append(np.flatnonzero(seen))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def fit(texts: list[str], toxic: list[int], smoothing: float = 1.0, ridge: float = 0.01, steps: int = 50) -> np.ndarray:
    """Weights of all features and, last, the bias.  With one class only, the weights are 0 and the
    bias gives that class's smoothed rate."""
    y = np.asarray(toxic, float)
    w = np.zeros((1 << BITS) + 1)
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.1
        w[-1] = math.log(rate / (1 - rate))
        return w
    x = [features(t) for t in texts]
    size = np.array([len(f) for f in x])
    col, row = np.concatenate(x).astype(np.int64), np.repeat(np.arange(len(x)), size)
    p = np.bincount(col, weights=y[row], minlength=1 << BITS) + smoothing
    q = np.bincount(col, weights=1 - y[row], minlength=1 << BITS) + smoothing
    # document counts over the documents of each class
    ratio = np.log(p / (y.sum() + 2 * smoothing)) - np.log(q / ((1 - y).sum() + 2 * smoothing))
    value = ratio[col]
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())  # both classes weigh the same

    def times(v: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=value * v[col], minlength=len(y))

    def back(e: np.ndarray) -> np.ndarray:
        return np.bincount(col, weights=value * e[row], minlength=1 << BITS)

    v = ratio  # largest curvature by power iteration, for the step size
    for _ in range(6):
        v = v / (np.linalg.norm(v) or 1.0)
        v = back(share * times(v))
    step = 1 / (0.25 * np.linalg.norm(v) + ridge)
    v = last = np.zeros(1 << BITS)
    bias = last_bias = 0.0
    for t in range(1, steps + 1):  # accelerated gradient descent: its steps keep the ratios' scale
        m = (t - 1) / (t + 2)
        at, at_bias = v + m * (v - last), bias + m * (bias - last_bias)
        e = (1 / (1 + np.exp(-np.clip(times(at) + at_bias, -40, 40))) - y) * share
        last, last_bias = v, bias
        v, bias = at - step * (back(e) + ridge * at), at_bias - e.sum()
    w[:-1], w[-1] = v * ratio, bias
    return w


def score(text: str | None, weights: np.ndarray) -> float:
    z = float(weights[features(text)].sum() + weights[-1])
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", per_class: int = PER_CLASS) -> np.ndarray:
    """Fit on at most `per_class` labelled rows of each class (ids repeated in `docs` count once a row).
    Rows without text count as empty, rows with a null label are left out."""
    ids = []
    for value in (0, 1):
        ids.append(labels.filter(F.col(label_col) == value).select(F.col(id_col).alias("__id"), F.lit(value).alias("y"))
                   .filter("__id is not null").dropDuplicates(["__id"])
                   .orderBy(F.xxhash64("__id"), "__id").limit(per_class))
    picked = written(ids[0].unionByName(ids[1]), "sample-ids")
    # at most 2 * per_class short rows
    sample = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(
        F.broadcast(picked), "__id").dropDuplicates(["__id"])

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("__id")
        return pd.DataFrame({"w": [fit(group["text"].tolist(), group["y"].tolist()).astype("<f4").tobytes()]})
    rows = sample.groupBy(F.lit(0).alias("g")).applyInPandas(fitted, "w binary").collect()
    return np.frombuffer(rows[0]["w"], "<f4").astype(float) if rows else fit([], [])


def scored(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score double) for every row; a null text scores as an empty one."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([docs.schema[id_col], StructField("score", DoubleType())])
    arrow, shared = to_arrow_schema(schema), docs.sparkSession.sparkContext.broadcast(weights.astype("<f4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(float)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([score(t.as_py(), w) for t in b.column(1)], pa.float64())], schema=arrow)
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 4, held: int = 2,
             per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`; rows whose crc32(doc_id as text) mod
    `folds` is `held` are never learned from.  Labels, ids and other columns are no inputs of a score.
    A null id is not held out.  An empty table gives an empty one; without labels every score is one constant.
    """
    fold = lambda c: F.crc32(c.cast("string").cast("binary")) % folds == held
    w = train(docs, labels.filter(~fold(F.col("doc_id"))), per_class=per_class)
    return scored(docs, w).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
