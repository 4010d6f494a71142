"""Substring dedup by De Bruijn compaction (operator 8).

Windows of `span` words are looked for through k-mers of words.  Of each window's k-mers the one with the
smallest hash is its anchor, so equal windows have equal anchors and about a sixth of all k-mers are
kept.  Anchors that occur twice are nodes of the graph, and successive ones of a document its edges; k is so
large that successive anchors overlap, so an edge fixes the words between.  Where all occurrences of a node
follow the same node at the same distance, and both occur equally often, the path does not branch and is
compacted: all windows inside share the fate of their anchor, whose source coordinates (document,
row key, place) tell its first occurrence.  Only windows across branches are compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import given_id, ordered_id, row_key, small_side, written
from .ngrams import FREQUENT_MOST, Survey, batch_of, column, is_in, longs, runs, word_hashes, words

SPAN = 20
#: Entries of the per-document lists that a broadcast may hold; beyond, both sides are shuffled.
LIST_BOUND = 8_000_000
#: One row in so many is surveyed for frequent anchors.
SURVEY_SHARE = 8


def k_of(span: int) -> int:
    """k-mers so long that successive anchors overlap: span - k + 1 starts a window, k > that many."""
    return span // 2 + 1


def anchors(h: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k-mer hashes, distinct anchor places in order, the anchor's number for each window)."""
    k = k_of(span)
    g = runs(h, k)
    n = len(h) - span + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return g, none, none
    least = np.lib.stride_tricks.sliding_window_view(g, span - k + 1).argmin(axis=1) + np.arange(n)
    new = np.append(True, least[1:] != least[:-1])
    return g, least[new], np.cumsum(new) - 1


def _hashes(t) -> np.ndarray:
    return word_hashes(words(t.as_py()))


def _frequent(batches: Iterator[pa.RecordBatch], span: int, schema: pa.Schema):
    survey = Survey()
    for b in batches:
        keys = []
        for t in b.column(0):
            g, at, _ = anchors(_hashes(t), span)
            keys.append(g[at])
        h, c = survey.add(keys, b.num_rows)
        yield batch_of(schema, longs(h), longs(c))
    h, c = survey.rest()
    yield batch_of(schema, longs(h), longs(c))


def _anchored(batches: Iterator[pa.RecordBatch], span: int, often: np.ndarray, schema: pa.Schema):
    """A row for each anchor that is not frequent: hash, document, row key, place, the anchor before and its distance;
    and one with a negative distance for each document that has a frequent one."""
    for b in batches:
        ids, rows, keys, places, before, gaps = [], [], [], [], [], []
        for i, r, t in zip(*b.columns, strict=True):
            g, at, _ = anchors(_hashes(t), span)
            if not len(at):
                continue
            key = g[at]
            rare = ~is_in(key, often)
            ids.append(np.full(int(rare.sum()), i.as_py(), np.int64))
            rows.append(np.full(int(rare.sum()), r.as_py(), np.int64))
            keys.append(key[rare])
            places.append(at[rare])
            before.append(np.append(np.uint64(0), key[:-1])[rare])
            gaps.append(np.diff(at, prepend=at[0])[rare])  # 0: no anchor before
            if not rare.all():
                for column_, value in ((ids, i.as_py()), (rows, r.as_py()), (places, -1), (gaps, -1)):
                    column_.append(np.array([value], np.int64))
                keys.append(np.array([r.as_py()], np.int64).view(np.uint64))
                before.append(np.zeros(1, np.uint64))
        if keys:
            yield batch_of(schema, longs(np.concatenate(keys)), np.concatenate(ids), np.concatenate(rows),
                           np.concatenate(places).astype(np.int32), longs(np.concatenate(before)),
                           np.concatenate(gaps).astype(np.int8))


def _nodes(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    """Occurrences of the anchors that occur twice or more; a partition holds all of an anchor's.
    `fate` packs the count, whether one way leads here, and whether this is the first occurrence.  Documents with a
    frequent anchor have place -1 and fate 0 besides, so that a document without any row here has no repeated window."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    h, doc, row, at, before, gap = (column(got, i) for i in range(6))
    mark = gap < 0
    if mark.any():
        yield batch_of(schema, row[mark], at[mark], np.zeros(int(mark.sum()), np.int64))
        h, doc, row, at, before, gap = (x[~mark] for x in (h, doc, row, at, before, gap))
        if not len(h):
            return
    order = np.lexsort((at, row, doc, h))
    h, doc, row, at, before, gap = h[order], doc[order], row[order], at[order], before[order], gap[order]
    start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    count = np.diff(np.append(start, len(h)))
    group = np.repeat(np.arange(len(start)), count)
    odd = (before != before[start][group]) | (gap != gap[start][group]) | (gap == 0)
    one_way = np.bincount(group, weights=odd, minlength=len(start)) == 0
    first = (row == row[start][group]) & (at == at[start][group])
    fate = count[group].astype(np.int64) * 4 + one_way[group] * 2 + first
    keep = count[group] > 1
    if keep.any():
        yield batch_of(schema, row[keep], at[keep], fate[keep])


class Windows:
    """What is known of a document's windows: which are in compacted paths and repeated, which are open."""

    def __init__(self, text, span: int, often: np.ndarray, places, fates):
        self.words = words(text)
        self.h = word_hashes(self.words)
        g, at, owner = anchors(self.h, span)
        n = len(owner)
        self.repeated, self.open = np.zeros(n, bool), np.zeros(0, np.int64)
        if not n:
            return
        known = is_in(g[at], often)
        fate = np.zeros(len(at), np.int64)
        if places is not None and len(places):
            places, fates = np.asarray(places, np.int64), np.asarray(fates, np.int64)
            order = np.argsort(places, kind="stable")
            places, fates = places[order], fates[order]
            i = np.minimum(np.searchsorted(places, at), len(places) - 1)
            mine = (places[i] == at) & ~known
            fate[mine] = fates[i][mine]
        node = fate > 0
        if not (node.any() or known.any()):
            return
        # an edge that cannot branch: one way leads to the later node, and both occur equally often
        plain = np.zeros(len(at), bool)
        plain[1:] = node[1:] & node[:-1] & (fate[1:] & 2 > 0) & (fate[1:] >> 2 == fate[:-1] >> 2)
        path = np.cumsum(~plain)
        head = np.flatnonzero(~plain)[path - 1]
        tail = np.append(np.flatnonzero(~plain)[1:] - 1, len(at) - 1)[path - 1]
        s = np.arange(n)
        inside = node[owner] & (s >= at[head][owner]) & (s + span <= at[tail][owner] + k_of(span))
        self.repeated = inside & (fate[owner] & 1 == 0)
        self.open = s[(node | known)[owner] & ~inside]


def _opened(batches: Iterator[pa.RecordBatch], span: int, often: np.ndarray, schema: pa.Schema):
    """Hashes of the open windows; equal ones of a batch give their first only."""
    for b in batches:
        ids, rows, keys, places = [], [], [], []
        for i, r, t, p, f in zip(*b.columns, strict=True):
            if not p.is_valid:
                continue
            w = Windows(t.as_py(), span, often, p.as_py(), f.as_py())
            if len(w.open):
                ids.append(np.full(len(w.open), i.as_py(), np.int64))
                rows.append(np.full(len(w.open), r.as_py(), np.int64))
                keys.append(runs(w.h, span)[w.open])
                places.append(w.open)
        if keys:
            yield _firsts_of(*map(np.concatenate, (keys, ids, rows, places)), schema)


def _firsts_of(key: np.ndarray, doc: np.ndarray, row: np.ndarray, at: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    order = np.lexsort((at, row, doc, key))
    key, doc, row, at = key[order], doc[order], row[order], at[order]
    new = np.append(True, key[1:] != key[:-1])
    return batch_of(schema, longs(key[new]), doc[new], row[new], at[new].astype(np.int32))


def _firsts(batches: Iterator[pa.RecordBatch], schema: pa.Schema):
    got = [b for b in batches if b.num_rows]
    if got:
        yield _firsts_of(*(column(got, i) for i in range(4)), schema)


def _removed(batches: Iterator[pa.RecordBatch], span: int, often: np.ndarray, schema: pa.Schema):
    for b in batches:
        n_words, n_removed, kept, spans = [], [], [], []
        for _, t, p, f, first in zip(*b.columns, strict=True):
            if not p.is_valid:  # none of its windows can be repeated
                ws = words(t.as_py())
                n_words.append(len(ws))
                n_removed.append(0)
                kept.append(b" ".join(ws).decode("utf-8", "surrogatepass"))
                spans.append([])
                continue
            w = Windows(t.as_py(), span, often, p.as_py(), f.as_py())
            repeated = w.repeated
            if len(w.open):
                repeated[w.open] = True
                if first.is_valid:
                    repeated[np.asarray(first.as_py(), np.int64)] = False
            edge = np.zeros(len(w.words) + 1, np.int64)
            at = np.flatnonzero(repeated)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + span, -1)
            gone = np.cumsum(edge)[:-1] > 0
            bounds = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            spans.append([{"start": int(s), "end": int(e)} for s, e in zip(bounds[::2], bounds[1::2], strict=True)])
            rest = [x for x, g in zip(w.words, gone.tolist(), strict=True) if not g] if len(at) else w.words
            n_words.append(len(w.words))
            n_removed.append(int(gone.sum()))
            kept.append(b" ".join(rest).decode("utf-8", "surrogatepass"))
        yield batch_of(schema, b.column(0), n_words, n_removed, spans, kept)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """(id, n_words, n_removed, spans array<struct<start,end>>, kept): each row's words without those in
    windows of `span` words that also start earlier: at a smaller id, or earlier in the same row.

    `spans` are the removed runs of words, end exclusive; `kept` joins the other words by one space.  A null
    text has no words; texts shorter than `span` words keep all.  Ids are integers; rows with a
    null id come after all others, and rows of one id or none by a key of id and text.  Rows equal in both are
    one document, so a repeated row removes nothing from its twin.  An empty table gives an empty one.  Windows and k-mers are compared by 64-bit hashes.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    def typed(ddl: str):
        s = StructType.fromDDL(ddl)
        return s, to_arrow_schema(s)

    docs = df.select(ordered_id(F.col(id_col)).alias("doc"), row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    spark = df.sparkSession
    fs, fa = typed("h long, c long")
    # which anchors count as frequent orders the work and changes no result, so a fixed share of the rows is surveyed
    surveyed = docs.where(F.pmod(F.xxhash64("row"), F.lit(SURVEY_SHARE)) == 0)
    top = surveyed.select("text").mapInArrow(lambda it: _frequent(it, span, fa), fs).groupBy("h").agg(F.sum("c").alias("c")) \
        .orderBy(F.desc("c"), "h").limit(FREQUENT_MOST).select("h").collect()
    often = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64)))

    s1, a1 = typed("h long, doc long, row long, at int, before long, gap byte")
    s2, a2 = typed("row long, at int, fate long")
    nodes = docs.mapInArrow(lambda it: _anchored(it, span, often.value, a1), s1).repartition("h").mapInArrow(
        lambda it: _nodes(it, a2), s2)
    # equal rows give each place twice, with one fate
    listed = written(nodes.groupBy(F.col("row").alias("__n")).agg(
        F.collect_list("at").alias("places"), F.collect_list("fate").alias("fates")), "nodes")
    n = listed.agg(F.coalesce(F.sum(F.size("places")), F.lit(0))).first()[0]
    known = docs.join(small_side(listed, n, LIST_BOUND), F.col("row") == F.col("__n"), "left")

    s3, a3 = typed("h long, doc long, row long, at int")
    opened = known.select("doc", "row", "text", "places", "fates").mapInArrow(lambda it: _opened(it, span, often.value, a3), s3)
    firsts = written(opened.repartition("h").mapInArrow(lambda it: _firsts(it, a3), s3).groupBy(
        F.col("row").alias("__f")).agg(F.collect_list("at").alias("first")), "firsts")
    m = firsts.agg(F.coalesce(F.sum(F.size("first")), F.lit(0))).first()[0]
    both = known.join(small_side(firsts, m, LIST_BOUND), F.col("row") == F.col("__f"), "left")
    s4, a4 = typed("doc long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string")
    return both.select("doc", "text", "places", "fates", "first").mapInArrow(
        lambda it: _removed(it, span, often.value, a4), s4).select(given_id(F.col("doc")).alias(id_col), "n_words", "n_removed", "spans", "kept")


def report(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
