"""Quality rules with cross-document line frequency (operator 4).

One pass over the texts computes the base figures and the hashes of the normalised lines; the
distinct documents of each (host, line) are counted with partial sums; lines above the limits
leave every document of the host, and documents depleted by that are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, same, small_side, written

SYMBOLS = "#*$%&|<>"
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def normalised(line: str) -> bytes:
    """Lower case, blanks collapsed."""
    return b" ".join(line.lower().encode("utf-8", "surrogatepass").split())


def line_key(line: str) -> int | None:
    bare = normalised(line)
    return xxhash.xxh3_64_intdigest(bare) - 2**63 if bare else None


def repeat_words(words: list[bytes], span: int = 3) -> int:
    """Words covered by `span`-word windows that stand twice or more in the text."""
    n = len(words) - span + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    keys = np.zeros(n, np.uint64)
    for i in range(span):
        keys += (h[i: i + n] ^ (h[i: i + n] >> np.uint64(29))) * _MIX[i % 3]
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    # equal hashes are confirmed on the words themselves
    places: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(keys, twice)).tolist():
        places.setdefault(tuple(words[i: i + span]), []).append(i)
    covered = np.zeros(len(words), bool)
    for at in places.values():
        if len(at) > 1:
            for i in at:
                covered[i: i + span] = True
    return int(covered.sum())


def measure(text: str | None) -> dict:
    """Base figures of one text and its lines as parallel lists of key and words (distinct keys)."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    raw, lines, dup = set(), {}, 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            dup += line in raw
            raw.add(line)
            k = line_key(line)
            lines[k] = lines.get(k, 0) + len(line.encode("utf-8", "surrogatepass").split())
    return {
        "n_words": len(words), "word_chars": len(text) - sum(map(text.count, BLANKS)),
        "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": dup, "n_repeat_words": repeat_words(words),
        "content": xxhash.xxh3_64_intdigest(b" ".join(words)) - 2**63,
        "line_keys": list(lines), "line_words": list(lines.values()),
    }


MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "content long, line_keys array<long>, line_words array<long>")


def _measured(batches: Iterator[pa.RecordBatch], text_col: str, keep: list[str], schema: pa.Schema):
    for b in batches:
        rows = [measure(t) for t in b.column(text_col).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(c) for c in keep] + [pa.array([r[f.name] for r in rows], f.type) for f in list(schema)[len(keep):]],
            schema=schema)


def measured(df: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """`keep` columns of `df` and the measures of its texts (Arrow batches, no shuffle)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType([df.schema[c] for c in keep] + list(StructType.fromDDL(MEASURES)))
    arrow = to_arrow_schema(schema)
    return df.select(*keep, *([text_col] if text_col not in keep else [])).mapInArrow(
        lambda batches: _measured(batches, text_col, keep, arrow), schema)


def frequent_lines(m: DataFrame, host_col: str, max_share: float, min_docs: int) -> DataFrame:
    """(host, line) on more than `max_share` of the host's distinct documents and on `min_docs` at least.
    Documents of equal words count once.  All counts have map-side partial sums."""
    host = F.col(host_col).alias("host")
    whole = m.select(host, "content", F.lit(None).cast("long").alias("line"))
    lines = m.select(host, "content", F.explode("line_keys").alias("line"))
    counts = whole.unionByName(lines).groupBy("host", "line", "content").agg(F.lit(1).alias("one")) \
        .groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"))
    counts = written(counts.filter(F.col("line").isNull() | (F.col("docs") >= min_docs)), "line-docs")
    hosts = counts.filter("line is null").select(F.col("host").alias("__h"), F.col("docs").alias("host_docs"))
    return counts.filter("line is not null").join(hosts, same(F.col("host"), F.col("__h"))).filter(
        F.col("docs") > F.lit(max_share) * F.col("host_docs")).select("host", "line")


def judge(df: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
          max_share: float = 0.2, min_docs: int = 20, min_rest: float = 0.3) -> DataFrame:
    """(id, base figures, base_failed, n_line_words, frequent array<long>, kept) for each row of `df`.

    `frequent` has the keys of the document's lines above the limits, n_line_words the words in them; a
    document is depleted if less than `min_rest` of its words stands outside them.  A null text has no
    words and fails; a null host is a host of its own; repeated rows get equal verdicts and count once as
    content.  An empty table gives an empty one.
    """
    host = "__host"
    m = written(measured(df.select(F.col(id_col), F.col(host_col).alias(host), F.col(text_col)),
                         [id_col, host], text_col), "measures")
    over = written(frequent_lines(m, host, max_share, min_docs), "frequent")
    per_host = over.groupBy("host").agg(F.collect_list("line").alias("over"))
    side = small_side(per_host.withColumnRenamed("host", "__h"), over.count())
    out = m.join(side, same(F.col(host), F.col("__h")), "left")
    hit = F.array_intersect("line_keys", F.coalesce("over", F.array().cast("array<long>")))
    gone = F.aggregate(F.filter(F.arrays_zip("line_keys", "line_words"),
                                lambda x: F.array_contains(F.col("frequent"), x["line_keys"])),
                       F.lit(0).cast("long"), lambda a, x: a + x["line_words"])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("frequent", hit).withColumns({"n_line_words": gone, "base_failed": failed}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("n_words") - F.col("n_line_words") >= min_rest * F.col("n_words"))
    ).select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "n_line_words", "frequent")


def cleaned(df: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", **limits) -> DataFrame:
    """The rows of `df` that `judge` keeps, without their lines above the limits, in `df`'s columns.
    Verdicts are of (id, host, text), so rows that share an id but differ are judged apart."""
    row = F.xxhash64(F.col(id_col).cast("string"), F.col(host_col).cast("string"), F.col(text_col))
    rows = df.withColumn("__row", row)
    told = judge(rows.select("__row", F.col(host_col), F.col(text_col)), "__row", host_col, text_col, **limits)
    told = written(told.filter(~F.col("kept") | (F.size("frequent") > 0)).select(
        F.col("__row").alias("__told"), "kept", "frequent").dropDuplicates(["__told"]), "verdicts")
    n = told.agg(F.coalesce(F.sum(1 + F.size("frequent")), F.lit(0))).first()[0]
    side = small_side(told.withColumnRenamed("kept", "__kept").withColumnRenamed("frequent", "__gone"), n)
    out = rows.join(side, F.col("__row") == F.col("__told"), "left").filter(F.coalesce("__kept", F.lit(True)))

    @F.pandas_udf("string")
    def rest(text: pd.Series, gone: pd.Series) -> pd.Series:
        def without(t, g):
            keys = set() if g is None else {int(k) for k in g}
            return "\n".join(x for x in t.split("\n") if line_key(x) not in keys) if keys else t
        return pd.Series([without(t, g) for t, g in zip(text, gone, strict=True)], dtype=object)
    text = rest(F.col(text_col), F.col("__gone"))
    return out.select(*[text.alias(c) if c == text_col else F.col(c) for c in df.columns])
