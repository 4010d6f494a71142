"""Ranked lexical search over a length-stratified index (operator 11).

Documents with an equal length normaliser m are a stratum; a term occurring tf times in any document of
a stratum is worth the same there, so postings are held by stratum, term and tf, and an impact is computed once for
each of those.  The largest tf of each term bounds what any document of the stratum can score.  A stratum with many documents
is held in several blocks of its own bounds, so no group grows with the data.

A search first visits the blocks of each item's greatest bounds; their scores give a threshold.  Then tasks go through
all blocks, visit those whose bound reaches the item's threshold, greatest first, and raise the threshold as they
go.  Results are exact: a block is passed over only if none of its documents can enter the ranking.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, given_id, ordered_id, written, written_at

#: Documents of a block; items of one search; blocks that an item visits first.
BLOCK, ITEMS_MOST, FIRST = 1024, 10_000, 16
_MAP = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of letters and digits of ASCII and of all other characters, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_MAP).split()


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def impact(w: np.ndarray, tf: np.ndarray, m: int) -> np.ndarray:
    """What tf occurrences of a term of weight w are worth in the stratum m, in 64-bit integers."""
    return w * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def _typed(ddl: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    s = StructType.fromDDL(ddl)
    return s, to_arrow_schema(s)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate([*values, np.zeros(0, np.int64)])
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def _counted(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int], schema: pa.Schema):
    """(doc, n, term numbers, their tf) of documents with a term."""
    for b in batches:
        docs, sizes, found, tfs = [], [], [], []
        for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            ts = terms(t.as_py())
            if ts:
                c = Counter(map(vocabulary.get, ts))
                c.pop(None, None)
                docs.append(i)
                sizes.append(len(ts))
                found.append(np.fromiter(c.keys(), np.int64, len(c)))
                tfs.append(np.fromiter(c.values(), np.int64, len(c)))
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(sizes, pa.int64()),
                                          _lists(found, pa.int32()), _lists(tfs, pa.int32())], schema=schema)


def _block(m: int, docs: list, found: list, tfs: list):
    """The columns of one block: postings ordered by term, then tf descending; `first` is where a (term, tf) begins."""
    at = np.repeat(np.arange(len(docs)), [len(x) for x in found])
    term, tf = np.concatenate([*found, np.zeros(0, np.int64)]), np.concatenate([*tfs, np.zeros(0, np.int64)])
    order = np.lexsort((at, -tf, term))
    at, term, tf = at[order], term[order], tf[order]
    new = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1]))) if len(term) else np.zeros(0, np.int64)
    return m, np.asarray(docs, np.int64), term[new], tf[new], np.append(new, len(term)), at


def _blocks(batches: Iterator[pa.RecordBatch], size: int, schema: pa.Schema):
    """Runs of documents of one stratum, in order of m, as blocks of `size` at most."""
    no = TaskContext.get().partitionId() << 32

    def row(block):
        nonlocal no
        no += 1
        m, *lists = block
        return pa.RecordBatch.from_arrays([pa.array([no], pa.int64()), pa.array([m], pa.int64()), _lists(lists[:1], pa.int64()), *[
            _lists([x], pa.int32()) for x in lists[1:]]], schema=schema)
    m, docs, found, tfs = None, [], [], []
    for b in batches:
        for doc, here, t, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
            if docs and (here != m or len(docs) == size):
                yield row(_block(m, docs, found, tfs))
                docs, found, tfs = [], [], []
            m = here
            docs.append(doc)
            found.append(t.values.to_numpy())
            tfs.append(f.values.to_numpy())
    if docs:
        yield row(_block(m, docs, found, tfs))


@dataclass
class Index:
    """Blocks of a document table for a vocabulary, and the table's statistics."""

    blocks: DataFrame | None
    vocabulary: dict[bytes, int]
    docs: int
    weights: np.ndarray


def build(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> Index:
    """The length-stratified index of all rows of `docs`, with postings of the terms of `vocabulary`."""
    spark = docs.sparkSession
    numbers = {t: i for i, t in enumerate(vocabulary)}
    known = spark.sparkContext.broadcast(numbers)  # bounded by the items of one search
    s0, a0 = _typed("doc long, n long, term array<int>, tf array<int>")
    counted, counted_path = written_at(docs.select(ordered_id(F.col(id_col)).alias("doc"), F.col(text_col)).mapInArrow(
        lambda it: _counted(it, known.value, a0), s0), "counted")
    total = counted.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("n").cast("decimal(38,0)")).alias("words")).first()
    if not total["n"]:
        return Index(None, numbers, 0, np.zeros(len(vocabulary), np.int64))
    df = np.zeros(len(vocabulary), np.int64)
    for t, n in counted.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # a row a term of the vocabulary
        df[t] = n
    weights = np.array([weight(total["n"], int(x)) for x in df], np.int64)
    m = F.expr(f"10 + cast(cast(90 as decimal(38,0)) * n * {total['n']}BD div {total['words']}BD as bigint)")
    s1, a1 = _typed("block long, m long, docs array<long>, term array<int>, tf array<int>, first array<int>, at array<int>")
    # ranges of (m, hash): a stratum of many documents is dealt to several tasks
    strata = counted.select("doc", m.alias("m"), "term", "tf").withColumn("h", F.xxhash64("doc"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total["n"] // (64 * block) + 1)
    dealt = strata.repartitionByRange(parts, "m", "h").sortWithinPartitions("m", "h").drop("h")
    blocks = written(dealt.mapInArrow(lambda it: _blocks(it, block, a1), s1), "blocks")
    forget(spark, counted_path)
    return Index(blocks, numbers, total["n"], weights)


class Items:
    """Items as term numbers, one after another; items without a term are left out."""

    def __init__(self, items: list[tuple[int, list[int]]]):
        items = [x for x in items if x[1]]
        self.no = [x[0] for x in items]
        self.size = np.array([len(x[1]) for x in items], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.term = np.array([t for x in items for t in x[1]], np.int64)


class Block:
    """A block's postings against a set of items."""

    def __init__(self, row: tuple, items: Items, weights: np.ndarray):
        self.m, self.docs, term, tf, self.first, self.at = row
        self.items = items
        self.impact = impact(weights[term], tf.astype(np.int64), self.m)
        heads = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
        self.edge = np.append(heads, len(term))
        here = term[heads]
        place = np.searchsorted(here, items.term)
        there = place < len(here)
        there[there] = here[place[there]] == items.term[there]
        self.place = np.where(there, place, -1)
        # a term's first group has its largest tf
        best = np.append(self.impact[heads], 0)
        self.bounds = np.add.reduceat(best[self.place], items.start) if len(items.no) else np.zeros(0, np.int64)

    def best(self, item: int, k: int, floor: int) -> list[tuple[int, int]]:
        """(-score, doc) of the item's k best documents of at least `floor` and above 0."""
        a = self.items.start[item]
        score = np.zeros(len(self.docs), np.int64)
        for p in self.place[a: a + self.items.size[item]]:
            if p >= 0:
                groups = slice(self.edge[p], self.edge[p + 1])
                lo, hi = self.first[self.edge[p]], self.first[self.edge[p + 1]]
                score[self.at[lo:hi]] += np.repeat(self.impact[groups], np.diff(self.first[self.edge[p]: self.edge[p + 1] + 1]))
        at = np.flatnonzero(score >= max(1, floor))
        at = at[np.lexsort((self.docs[at], -score[at]))[:k]]
        return list(zip((-score[at]).tolist(), self.docs[at].tolist(), strict=True))


def _rows(b: pa.RecordBatch):
    for no, *row in zip(*(c for c in b.columns), strict=True):
        yield no.as_py(), (row[0].as_py(), *(x.values.to_numpy() for x in row[1:]))


def _greatest(batches: Iterator[pa.RecordBatch], items: Items, weights: np.ndarray, most: int, schema: pa.Schema):
    """The `most` blocks of greatest bounds of each item, among those of this task."""
    bound = np.zeros((most, len(items.no)), np.int64)
    block = np.zeros((most, len(items.no)), np.int64)
    for b in batches:
        for no, row in _rows(b):
            new = Block(row, items, weights).bounds
            low = bound.argmin(axis=0)
            at = np.flatnonzero(new > bound[low, np.arange(len(items.no))])
            bound[low[at], at], block[low[at], at] = new[at], no
    r, i = np.nonzero(bound)
    yield pa.RecordBatch.from_arrays([pa.array(np.asarray(items.no)[i], pa.int64()), pa.array(block[r, i], pa.int64()),
                                      pa.array(bound[r, i], pa.int64())], schema=schema)


def _visited(batches: Iterator[pa.RecordBatch], items: Items, weights: np.ndarray, floor: np.ndarray, k: int, schema: pa.Schema,
             only: dict[int, set[int]] | None = None):
    """The k best documents of each item in this task's blocks; `only` names the items that visit a block."""
    floor, best = floor.copy(), [[] for _ in items.no]
    place = {x: i for i, x in enumerate(items.no)}
    visits = 0
    for b in batches:
        blocks, who, which, bounds = [], [], [], []
        for no, row in _rows(b):
            if only is not None and no not in only:
                continue
            x = Block(row, items, weights)
            at = np.array([place[i] for i in only[no]], np.int64) if only is not None else np.flatnonzero(x.bounds >= np.maximum(1, floor))
            who.append(at)
            which.append(np.full(len(at), len(blocks)))
            bounds.append(x.bounds[at])
            blocks.append(x)
        if not blocks:
            continue
        who, which, bounds = np.concatenate(who), np.concatenate(which), np.concatenate(bounds)
        for j in np.argsort(-bounds, kind="stable").tolist():
            i = who[j]
            if bounds[j] < floor[i]:
                continue  # the threshold has risen since
            visits += 1
            got = blocks[which[j]].best(i, k, int(floor[i]))
            if got:
                best[i] = sorted(best[i] + got)[:k]
                if len(best[i]) == k:
                    floor[i] = max(floor[i], -best[i][-1][0])
    rows = [(items.no[i], doc, -s, visits) for i, found in enumerate(best) for s, doc in found]
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, schema, strict=True)], schema=schema)


def rank(index: Index, items: list[tuple[int, list[bytes]]], k: int = 10, first: int = FIRST) -> DataFrame:
    """(no, rank int, doc long, score long, visits long) of the k best documents of each (no, distinct terms) item; `visits`
    counts the blocks that the row's task scored."""
    from pyspark.sql.types import StructType

    q = Items([(no, [index.vocabulary[t] for t in ts if t in index.vocabulary]) for no, ts in items])
    weights = index.weights
    s2, a2 = _typed("no long, doc long, score long, visits long")
    if index.blocks is None or not q.no:
        raise LookupError("nothing to search")
    spark = index.blocks.sparkSession
    shared = spark.sparkContext.broadcast((q, weights))  # ITEMS_MOST items
    s1, a1 = _typed("no long, block long, bound long")
    by = Window.partitionBy("no").orderBy(F.desc("bound"), "block")
    top = index.blocks.mapInArrow(lambda it: _greatest(it, *shared.value, first, a1), s1).withColumn(
        "r", F.row_number().over(by)).where(F.col("r") <= first).collect()  # `first` rows an item
    only: dict[int, set[int]] = {}
    for x in top:
        only.setdefault(x["block"], set()).add(x["no"])
    none = np.zeros(len(q.no), np.int64)
    chosen = index.blocks.where(F.col("block").isin(list(only))) if len(only) <= 1000 else index.blocks.join(
        F.broadcast(spark.createDataFrame([(x,) for x in only], "block long")), "block", "left_semi").select(*index.blocks.columns)
    order = Window.partitionBy("no").orderBy(F.desc("score"), "doc")
    seen = chosen.mapInArrow(lambda it: _visited(it, *shared.value, none, k, a2, only), s2).withColumn(
        "r", F.row_number().over(order)).where(F.col("r") == k).select("no", "score").collect()  # a row an item
    reached = {x["no"]: x["score"] for x in seen}
    floor = np.array([reached.get(i, 0) for i in q.no], np.int64)
    return index.blocks.mapInArrow(lambda it: _visited(it, *shared.value, floor, k, a2), s2).withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= k).select("no", "rank", "doc", "score", "visits")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text", block: int = BLOCK, items_most: int = ITEMS_MOST) -> DataFrame:
    """(item id, rank int, id, score long): the k documents of highest score above 0 for each row of `items`, equal scores by
    ascending id.

    Every row of `docs` is a document, repeated rows too; one with a null id comes after all others of its score.
    Null and empty texts, and those without a term, are not counted and never found; items without a term, or whose
    terms no document has, give no rows.  Each row of `items` is an item, so a repeated one gives its rows again.  Items are
    searched by groups of about `items_most`, each over an index of its terms.  Extra columns are left out; empty tables give an empty one.
    """
    from pyspark.sql.types import IntegerType, LongType, StructField, StructType

    spark = docs.sparkSession
    out = StructType([StructField(item_col, items.schema[item_col].dataType), StructField("rank", IntegerType()),
                      StructField(id_col, LongType()), StructField("score", LongType())])
    groups = -(-items.count() // items_most)
    parts = []
    for g in range(groups):
        part = items if groups == 1 else items.where(F.pmod(F.xxhash64(item_col, item_text), F.lit(groups)) == g)
        rows = part.select(item_col, item_text).collect()  # about items_most rows
        asked = [(no, sorted(set(terms(r[1])))) for no, r in enumerate(rows)]
        vocabulary = sorted({t for _, ts in asked for t in ts})
        index = build(docs, vocabulary, id_col, text_col, block) if vocabulary else None
        if index is None or index.blocks is None:
            continue
        ids = spark.createDataFrame([(no, r[0]) for no, r in enumerate(rows)], StructType([StructField("no", LongType()), out[item_col]]))
        parts.append(rank(index, asked, k).join(F.broadcast(ids), "no").select(
            item_col, "rank", given_id(F.col("doc")).alias(id_col), "score"))
    found = spark.createDataFrame([], out)
    for p in parts:
        found = found.unionByName(p)
    return found if len(parts) != 1 else parts[0]
