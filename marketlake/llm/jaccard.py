"""N-gram Jaccard join by T-occurrence search (operator 6).

Documents are sets of hashed shingles; equal sets are one class.  Shingles are ordered by hash with the
frequent ones last, and two sets of the wanted similarity share e or more of the first n - T + e of each
(T: the least overlap; e: a tenth of the smaller set).  Inverted lists of those prefixes tell which classes
share so much with others at all; they are dealt into blocks by their most widely shared shingle and their
length, and the pairs of blocks that meet in enough lists are searched by DivideSkip: short lists are merged,
long ones probed by binary search, and a partner is kept if its occurrences reach the overlap.
A block pair returns a spanning forest of its links, so what is returned grows with documents, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import given_id, ordered_id, row_key, small_side, written
from .components import components
from .ngrams import FREQUENT_MOST, Survey, batch_of, column, is_in, longs, shingles

#: Shingles a block holds on average at most.
BLOCK = 1 << 17


def least_overlap(n: int, m: int, num: int, den: int) -> int:
    """Smallest intersection with den * intersection >= num * union for sets of n and m."""
    return -(-num * (n + m) // (num + den))


#: A prefix is made for so many hits: one in EARLY of the set.
EARLY = 10


def early(n: int) -> int:
    return -(-n // EARLY)


def node_of(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63


def _surveyed(batches: Iterator[pa.RecordBatch], k: int, schema: pa.Schema):
    def told(h, c):
        none = pa.nulls(len(h), pa.int64())
        return batch_of(schema, none, none, none, none, longs(h), longs(c))
    survey, known = Survey(), set()
    for b in batches:
        sets = [shingles(t.as_py(), k) for t in b.column(2)]
        n = np.array([len(s) for s in sets], np.int64)
        nodes = [node_of(s) if len(s) else None for s in sets]
        none = pa.nulls(len(sets), pa.int64())
        yield batch_of(schema, b.column(0), b.column(1), n, nodes, none, none)
        new = [i for i, x in enumerate(nodes) if x is not None and not (x in known or known.add(x))]
        yield told(*survey.add([sets[i] for i in new], len(sets)))
    yield told(*survey.rest())


def _prefixes(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int, often: np.ndarray, schema: pa.Schema):
    known = set()  # a class is posted once a task
    for b in batches:
        keys, nodes, sizes, heavy = [], [], [], []
        for t in b.column(2):
            s = shingles(t.as_py(), k)
            if not len(s) or (node := node_of(s)) in known:
                continue
            known.add(node)
            p = min(len(s), len(s) - -(-num * len(s) // den) + early(len(s)))
            f = is_in(s, often)
            first = s[~f][:p]
            last = s[f][: p - len(first)]
            keys += [first, last]
            nodes.append(np.full(p, node, np.int64))
            sizes.append(np.full(p, len(s), np.int32))
            heavy += [np.zeros(len(first), bool), np.ones(len(last), bool)]
        if keys:
            yield batch_of(schema, longs(np.concatenate(keys)), np.concatenate(nodes), np.concatenate(sizes), np.concatenate(heavy))


def _shared(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    """Postings of the lists with two classes or more; a partition holds whole lists."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    h, node, n = (column(got, i) for i in range(3))
    sorted_h = np.sort(h)
    twice = sorted_h[1:][sorted_h[1:] == sorted_h[:-1]]  # most lists have one entry
    some = is_in(h, twice)
    h, node, n = h[some], node[some], n[some]
    if not len(h):
        return
    order = np.lexsort((node, h))
    h, node, n = h[order], node[order], n[order]
    new = np.append(True, (h[1:] != h[:-1]) | (node[1:] != node[:-1]))
    h, node, n = h[new], node[new], n[new]
    start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    df = np.diff(np.append(start, len(h)))
    df = np.repeat(df, df)
    keep = df > 1
    if keep.any():
        yield batch_of(schema, h[keep], node[keep], n[keep], df[keep])


def _sets(batches: Iterator[pa.RecordBatch], k: int, schema: pa.Schema):
    for b in batches:
        nodes, blocks, out = [], [], []
        for t, node, block in zip(*(c if i == 0 else c.to_pylist() for i, c in enumerate(b.columns)), strict=True):
            s = shingles(t.as_py(), k)
            if len(s) and node_of(s) == node:
                nodes.append(node)
                blocks.append(block)
                out.append(s.tobytes())
        yield batch_of(schema, nodes, blocks, out)


def divide_skip(query: np.ndarray, lists: np.ndarray, owners: np.ndarray, sizes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Owners whose sets overlap with `query` by the T-occurrence bound.

    `lists` are the sorted hashes of all owners' elements, `owners` theirs (ascending within a hash),
    `sizes` the owners' set sizes."""
    n = len(query)
    lo, hi = np.searchsorted(lists, query, "left"), np.searchsorted(lists, query, "right")
    length = hi - lo
    hit = length > 0
    lo, hi, length = lo[hit], hi[hit], length[hit]
    t = -(-num * n // den)  # no partner needs less
    if len(lo) < t:
        return np.zeros(0, np.int64)
    order = np.argsort(length, kind="stable")
    n_long = min(t - 1, int(t / (0.01 * math.log2(length[order[-1]] + 1) + 1)))
    n_long = min(n_long, int((length > 8).sum()))
    short, long = order[: len(order) - n_long], order[len(order) - n_long:]
    merged = np.concatenate([owners[lo[i]: hi[i]] for i in short]) if len(short) else np.zeros(0, np.int64)
    found, seen = np.unique(merged, return_counts=True)
    ok = seen >= t - n_long
    found, seen = found[ok], seen[ok]
    for i in long:
        if not len(found):
            break
        part = owners[lo[i]: hi[i]]
        at = np.minimum(np.searchsorted(part, found), len(part) - 1)
        seen = seen + (part[at] == found)
    need = -(-num * (n + sizes[found]) // (num + den))
    return found[seen >= need]


def _joined(num: int, den: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """One pair of blocks -> a spanning forest of its links."""
        group = group.drop_duplicates("node")
        nodes = group["node"].to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in group["set"]]
        left, right = (np.flatnonzero(group[c].to_numpy()) for c in ("is_left", "is_right"))
        sizes = np.array([len(s) for s in sets], np.int64)
        h = np.concatenate([sets[i] for i in right]) if len(right) else np.zeros(0, np.uint64)
        own = np.repeat(right, sizes[right])
        order = np.lexsort((own, h))
        h, own = h[order], own[order]
        parent = list(range(len(nodes)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i
        edges = []
        for i in left.tolist():
            for j in divide_skip(sets[i], h, own, sizes, num, den).tolist():
                a, b = root(i), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    edges.append((nodes[i], nodes[j]))
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")
    return run


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                 similarity: Fraction | float = Fraction(3, 4)) -> DataFrame:
    """(id, n_shingles long, component_id): component_id is the smallest id reachable by links of
    Jaccard similarity `similarity` or more.

    A null text or one without words has an empty set and links with nothing; with fewer than `k` words the
    whole sequence is the one shingle; equal sets always link (similarity 1), repeated rows too.  Ids are integers; rows with a null id come after all others.  An empty table gives an empty one.
    Shingles and sets are compared by 64-bit hashes.
    """
    return _grouped(df, id_col, text_col, k, similarity).select(
        given_id(F.col("id")).alias(id_col), F.col("n").alias("n_shingles"),
        given_id(F.coalesce(F.col("first.id"), F.col("id"))).alias("component_id"))


def _grouped(df: DataFrame, id_col: str, text_col: str, k: int, similarity: Fraction | float) -> DataFrame:
    """(id, row, n, first struct<id,row>) for each row: its key and the first row of its group by id, then by
    key; null without words."""
    share = Fraction(similarity).limit_denominator(10_000)
    num, den = share.numerator, share.denominator
    docs = df.select(ordered_id(F.col(id_col)).alias("__id"), row_key(id_col, text_col).alias("__row"), F.col(text_col).alias("__text"))
    spark = df.sparkSession
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    def typed(ddl: str) -> tuple[StructType, pa.Schema]:
        s = StructType.fromDDL(ddl)
        return s, to_arrow_schema(s)

    s, a = typed("id long, row long, n long, node long, h long, c long")
    survey = written(docs.mapInArrow(lambda it: _surveyed(it, k, a), s), "survey")
    often = np.sort(np.array([r[0] for r in survey.filter("h is not null").groupBy("h").agg(F.sum("c").alias("c"))
                              .orderBy(F.desc("c"), "h").limit(FREQUENT_MOST).select("h").collect()], np.int64).view(np.uint64))
    heavy = spark.sparkContext.broadcast(often)

    ps, pa_ = typed("h long, node long, n int, heavy boolean")
    postings = docs.mapInArrow(lambda it: _prefixes(it, k, num, den, heavy.value, pa_), ps)
    ss, sa = typed("h long, node long, n int, df long")
    light = postings.filter("not heavy").drop("heavy").repartition("h").mapInArrow(lambda it: _shared(it, sa), ss)
    # frequent shingles need no lists to be known as shared
    often_shared = postings.filter("heavy").drop("heavy").dropDuplicates(["h", "node"]).withColumn("df", F.lit(1 << 30))
    shared = written(light.unionByName(often_shared), "shared")

    # a partner is num / den as large at least, so its prefix is made for so many hits of these
    needed = F.ceil(F.col("n") * F.lit(num) / F.lit(EARLY * den))
    # blocks: the shingle shared most widely (by powers of two, then by hash), so that a family of copies
    # meets in few blocks; length band; and a salt by the size of the two
    sig = F.shiftleft((F.lit(31) - F.floor(F.log2(F.col("df").cast("double")))).cast("long"), 58).bitwiseOR(
        F.shiftrightunsigned("h", 6))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(den / num))).cast("int")
    nodes = shared.groupBy("node").agg(F.min(sig).alias("sig"), F.max("n").alias("n"), F.count(F.lit(1)).alias("hits")).filter(
        F.col("hits") >= needed).select("node", "sig", "n", band.alias("band"))
    nodes = written(nodes, "nodes")
    # only families larger than a block are salted: at most one in BLOCK shingles, counted before it is broadcast
    large = written(nodes.groupBy("sig", "band").agg(F.sum("n").alias("total")).filter(F.col("total") > BLOCK).select(
        F.col("sig").alias("__s"), F.col("band").alias("__b"), F.ceil(F.col("total") / BLOCK).alias("salts")), "large")
    side = small_side(large, large.count())
    salt = F.pmod(F.xxhash64("node"), F.coalesce("salts", F.lit(1).cast("long")))
    # hits that two sets of the band's smallest size must have in common
    least = F.ceil(F.floor(F.pow(F.lit(den / num), "band") * 0.999999) / EARLY)
    blocks = nodes.join(side, (F.col("sig") == F.col("__s")) & (F.col("band") == F.col("__b")), "left").select(
        "node", "n", "band", F.xxhash64("sig", "band", salt).alias("block"), least.alias("least"))
    blocks = written(blocks, "blocks")
    meets = shared.select("h", "node").join(blocks, "node").groupBy("h", "block").agg(
        F.first("band").alias("band"), F.first("least").alias("least"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    x, y = meets.alias("x"), meets.alias("y")
    # block pairs that share as many lists as two of their members must; sizes in the ratio wanted are at
    # most one band apart
    pairs = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.block") <= F.col("y.block"))
                   & (F.abs(F.col("x.band") - F.col("y.band")) <= 1)
                   & ((F.col("x.block") < F.col("y.block")) | (F.col("x.lo") < F.col("x.hi")))).select(
        F.col("x.block").alias("left"), F.col("y.block").alias("right"), F.least("x.least", "y.least").alias("least")).groupBy(
        "left", "right").agg(F.count(F.lit(1)).alias("lists"), F.first("least").alias("least")).filter(
        F.col("lists") >= F.col("least")).select("left", "right")
    pairs = written(pairs, "pairs")

    # the sets of the classes in them, from one document of each class
    least = survey.filter("node is not null").groupBy("node").agg(F.min(F.struct("id", "row")).alias("least"))
    need = written(least.select("node", F.col("least.id").alias("__need"), F.col("least.row").alias("__own")).join(
        blocks.select("node", "block"), "node"), "need")
    some = small_side(need, need.count(), 1_000_000)
    ns, na = typed("node long, block long, set binary")
    sets = docs.join(some, (F.col("__id") == F.col("__need")) & (F.col("__row") == F.col("__own"))).select("__text", "node", "block").mapInArrow(
        lambda it: _sets(it, k, na), ns)
    sides = pairs.select("left", "right", F.col("left").alias("block"), F.lit(True).alias("is_left"), (F.col("left") == F.col("right")).alias("is_right")) \
        .unionByName(pairs.filter("left <> right").select("left", "right", F.col("right").alias("block"), F.lit(False).alias("is_left"), F.lit(True).alias("is_right")))
    sides = written(sides, "sides")
    edges = sets.join(small_side(sides, sides.count(), 500_000), "block").select("left", "right", "node", "set", "is_left", "is_right").groupBy("left", "right").applyInPandas(
        _joined(num, den), "a long, b long")
    roots = components(edges)

    named = least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = named.groupBy("root").agg(F.min("least").alias("first"))
    by_node = named.join(groups, "root").select(F.col("node").alias("__node"), "first")
    return survey.filter("h is null").join(by_node, F.col("node") == F.col("__node"), "left").select("id", "row", "n", "first")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                similarity: Fraction | float = Fraction(3, 4)) -> DataFrame:
    """One row of `df` for each group: the one of the smallest id, null ids last, then of the smallest key of
    id and text.  Rows are judged by their own text, whatever their ids: unlike rows that share an id, or have
    none, all stay.  Rows without words are in no group; rows equal in id and text are one."""
    found = written(_grouped(df, id_col, text_col, k, similarity), "groups")
    gone = written(found.filter(F.col("row") != F.col("first.row")).select(F.col("row").alias("__gone")).distinct(), "gone")
    rows = df.withColumn("__row", row_key(id_col, text_col))
    rest = rows.join(small_side(gone, gone.count(), 1_000_000), F.col("__row") == F.col("__gone"), "left_anti")
    twice = written(found.groupBy(F.col("row").alias("__twice")).count().filter("count > 1").select("__twice"), "repeated")
    n = twice.count()
    if not n:
        return rest.drop("__row")
    side = small_side(twice, n, 1_000_000)
    same_row = F.col("__row") == F.col("__twice")
    return rest.join(side, same_row, "left_anti").unionByName(
        rest.join(side, same_row, "left_semi").dropDuplicates(["__row"])).drop("__row")
