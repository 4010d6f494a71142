"""Best-fit packing in bulk-synchronous rounds (operator 5).

Texts become token pieces of at most `capacity` ids.  Pieces of one length are interchangeable, and so
are sequences with equal gaps, so both are held as range-sorted runs: (length, count) and (gap, first
sequence, count).  A round takes the longest remaining run of pieces and sweeps the gap runs from its
successor, the smallest gap that fits, upwards; pieces are matched to gaps by rank, the gap runs
are updated, and the next round begins.  Ranks of pieces are counted in Spark; the rounds see at
most `capacity` runs of pieces and O(capacity) runs of gaps, whatever the number of documents.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

CAPACITY = 1024
END = 2
#: In these blocks both libraries agree on letters, digits and blanks; other texts go to `tokenizers` itself.
_OTHER = re.compile("[^\x00-ɏ‐-‧€]")
_SPECIAL = "<|endoftext|>"
_loaded: dict[str, tuple] = {}


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _load(path: str):
    """(tokenizers.Tokenizer, tiktoken.Encoding of the same vocabulary or None), once a process."""
    if path not in _loaded:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        fast = None
        if path == tokenizer_file():
            with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _loaded[path] = (Tokenizer.from_file(path), fast)
    return _loaded[path]


def ids_of(text: str | None, path: str, end: int | None = END) -> np.ndarray:
    """The ids of a whole text as unsigned 32-bit numbers, `end` last."""
    exact, fast = _load(path)
    text = text or ""
    if fast is not None and _SPECIAL not in text and not _OTHER.search(text):
        ids = fast.encode_to_numpy(text, disallowed_special=())
    else:
        ids = exact.encode(text, add_special_tokens=False).ids
    tail = [] if end is None else [end]
    return np.concatenate([np.asarray(ids, "<u4"), np.asarray(tail, "<u4")])


def cuts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; the first may be shorter, and only longer documents are cut."""
    first = (length - 1) % capacity + 1 if length else 0
    return [(0, first)] * (first > 0) + [(s, capacity) for s in range(first, length, capacity)]


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           path: str | None = None, end: int | None = END) -> DataFrame:
    """(id, piece int, start long, length long, ids_crc32 long) for every piece of every row."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import IntegerType, LongType, StructField, StructType

    schema = StructType([df.schema[id_col], StructField("piece", IntegerType()), *[
        StructField(c, LongType()) for c in ("start", "length", "ids_crc32")]])
    arrow, path = to_arrow_schema(schema), path or tokenizer_file()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, no, start, size, crc = [], [], [], [], []
            for i, t in enumerate(b.column(1)):
                ids = ids_of(t.as_py(), path, end)
                for k, (s, n) in enumerate(cuts(len(ids), capacity)):
                    row.append(i), no.append(k), start.append(s), size.append(n)
                    crc.append(zlib.crc32(ids[s: s + n].tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), *[
                pa.array(v, f.type) for v, f in zip((no, start, size, crc), list(arrow)[1:], strict=True)]], schema=arrow)
    return df.select(id_col, text_col).mapInArrow(run, schema)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rounds of best fit over runs -> intervals (length, first rank, past last rank, first sequence,
    offset, pieces a sequence): the piece of rank r stands in sequence first + (r - first rank) // pieces
    at offset + (r - first rank) % pieces * length."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first sequence, sequences)]
    sizes: list[int] = []  # the gaps that exist, sorted
    used, out = 0, []

    def put(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in gaps:
                bisect.insort(sizes, gap)
                gaps[gap] = []
            gaps[gap].append((first, n))

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(sizes, length)  # the successor
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first, n = capacity, used, -(-left // (capacity // length))
                used += n
            each = gap // length
            full, part = min(n, left // each), 0
            if full:
                out.append((length, rank, rank + full * each, first, capacity - gap, each))
            if full < n and left - full * each:
                part = left - full * each
                if part < each:
                    out.append((length, rank + full * each, rank + left, first + full, capacity - gap, part))
                else:
                    part = 0
            rank, left = rank + full * each + part, left - full * each - part
            put(gap - each * length, first, full)
            put(gap - part * length, first + full, 1 if part else 0)
            put(gap, first + full + (1 if part else 0), n - full - (1 if part else 0))
    return out


def pack(sized: DataFrame, order: list[str], length_col: str = "length", capacity: int = CAPACITY,
         ranges: int = 256) -> DataFrame:
    """`sized` plus sequence_id long and offset long (gapless from 0 in each sequence).

    `sized` is read three times: give it materialised.  Its lengths are 1 to `capacity`; rows of null
    or other lengths raise.  `order` names columns that tell rows apart; rows equal in them are interchangeable.
    An empty table gives an empty one.
    """
    length = F.coalesce(F.col(length_col).cast("int"), F.lit(0))
    sized = sized.drop("sequence_id", "offset")
    rng = F.pmod(F.xxhash64(*order), F.lit(ranges))
    keyed = sized.withColumns({"__len": length, "__rng": rng})
    runs = keyed.groupBy("__len", "__rng").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("__len").orderBy("__rng").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(runs.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0).cast("long"))), "length-runs")
    counts = {r["__len"]: r["n"] for r in runs.groupBy("__len").agg(F.sum("n").alias("n")).collect()}  # capacity rows
    if any(not 1 <= x <= capacity for x in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    plan: dict[int, list[tuple]] = {}
    for x in best_fit(counts, capacity):
        plan.setdefault(x[0], []).append(x[1:])
    spark = sized.sparkSession
    steps = spark.createDataFrame(
        list(plan.items()), "__l int, __plan array<struct<lo:long,hi:long,first:long,at:long,each:long>>")
    inside = Window.partitionBy("__len", "__rng").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    ranked = keyed.withColumn("__no", F.row_number().over(inside)).join(runs.drop("n"), ["__len", "__rng"]).withColumn(
        "__rank", F.col("ahead") + F.col("__no") - 1)
    # the plan has O(capacity) intervals, whatever the number of pieces
    placed = ranked.join(F.broadcast(steps), F.col("__len") == F.col("__l")).withColumn(
        "__p", F.get(F.filter("__plan", lambda p: (p["lo"] <= F.col("__rank")) & (F.col("__rank") < p["hi"])), F.lit(0)))
    return placed.select(
        *sized.columns, F.expr("__p.first + (__rank - __p.lo) div __p.each").alias("sequence_id"),
        F.expr("__p.at + (__rank - __p.lo) % __p.each * __len").cast("long").alias("offset"))


def packed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           path: str | None = None) -> DataFrame:
    """Pieces of all rows with their places.  A null text is an empty one: its one piece is the end id.  Repeated
    rows are packed as often as they occur."""
    p = written(pieces(df, id_col, text_col, capacity, path), "pieces")
    return pack(p, [id_col, "piece", "start", "ids_crc32"], capacity=capacity)
