"""Compaction of landed micro-batches: file sizes, the same rows, replay and a run that died half way."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from marketlake.sinks import compact
from marketlake.sinks import lake as sink
from marketlake.sources import lake as src

TARGET = 150_000


def batch(spark, n, rows=2000):
    """Ticks of one micro-batch; some of every seventh belong to the day before."""
    i = F.col("id")
    return spark.range(n * rows, (n + 1) * rows, numPartitions=2).select(
        F.timestamp_micros(F.lit(1_704_445_200_000_000) + i * 1000).alias("ts_event"), F.timestamp_micros(F.lit(1_704_445_200_000_000) + i * 1001).alias("ts_received"),
        F.concat(F.lit("S"), F.xxhash64(i) % 50).alias("symbol"), F.lit("equity").alias("asset_class"), F.lit("HOSE").alias("exchange"),
        (F.xxhash64(i, F.lit(1)) % 100_000).alias("price"), (F.xxhash64(i, F.lit(2)) % 1000).alias("volume"), F.lit("continuous").alias("match_type"),
        F.lit("B").alias("side"), F.concat(F.lit("T"), i).alias("trade_id"), i.alias("seq"), i.alias("ingest_seq"),
        F.when((i % 500 == 0) & (F.lit(n) % 7 == 0), F.lit(dt.date(2024, 1, 4))).otherwise(F.lit(dt.date(2024, 1, 5))).alias("date"))


def files(root):
    out = {}
    for d, _, names in os.walk(f"{root}/raw/ticks"):
        for f in names:
            if f.endswith(".parquet"):
                out[os.path.join(d, f)] = os.path.getsize(os.path.join(d, f))
    return out


def keys(spark, root):
    return sorted(r[0] for r in src.scan_raw(spark, root, "ticks").select("seq").collect())


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("compact"))
    for n in range(100):
        sink.land_stream(batch(spark, n), root, "ticks", str(n))
    return root


def test_a_hundred_batches(spark, landed):
    before, rows = files(landed), keys(spark, landed)
    assert len(before) >= 100 and rows == list(range(200_000))
    out = compact.compact_stream(spark, landed, "ticks", TARGET)
    assert out["partitions"] == 2 and out["files_before"] == len(before) - sum("batch=98" in f or "batch=99" in f for f in before)
    assert keys(spark, landed) == rows
    after = files(landed)
    big = [n for f, n in after.items() if "compacted" in f and "date=2024-01-05" in f]
    assert len(big) > 5 and all(TARGET / 2 <= n <= 2 * TARGET for n in big)
    assert {f for f in after if "compacted" not in f} == {f for f in before if "batch=98" in f or "batch=99" in f}
    # nothing is left to do, and the newest batch may still be replayed
    assert compact.compact_stream(spark, landed, "ticks", TARGET)["partitions"] == 0
    sink.land_stream(batch(spark, 99), landed, "ticks", "99")
    assert keys(spark, landed) == rows


def test_later_batches_join_the_compacted_ones(spark, tmp_root):
    for n in range(6):
        sink.land_stream(batch(spark, n, 300), tmp_root, "ticks", str(n))
    assert compact.compact_stream(spark, tmp_root, "ticks", TARGET)["files_after"] >= 1
    for n in range(6, 12):
        sink.land_stream(batch(spark, n, 300), tmp_root, "ticks", str(n))
    assert compact.compact_stream(spark, tmp_root, "ticks", TARGET)["partitions"] >= 1
    assert keys(spark, tmp_root) == list(range(3600))
    names = {f.split("batch=")[1].split("/")[0] for f in files(tmp_root) if "date=2024-01-05" in f}
    assert names == {"compacted-9", "10", "11"}


def test_a_run_that_died_is_finished_by_the_next(spark, tmp_root, monkeypatch):
    for n in range(5):
        sink.land_stream(batch(spark, n, 300), tmp_root, "ticks", str(n))
    with monkeypatch.context() as m:
        calls = []

        def dies(spark, path):
            calls.append(path)
            if len(calls) == 3:
                raise OSError("lost")
            return keep(spark, path)
        keep = sink.remove
        m.setattr(sink, "remove", dies)
        with pytest.raises(OSError):
            compact.compact_stream(spark, tmp_root, "ticks", TARGET)
    compact.compact_stream(spark, tmp_root, "ticks", TARGET)
    assert keys(spark, tmp_root) == list(range(1500))
    assert not sink.path_exists(spark, compact._journal(tmp_root, "ticks"))


def test_nothing_landed(spark, tmp_root):
    assert compact.compact_stream(spark, tmp_root, "ticks") == {"stream": "ticks", "partitions": 0, "files_before": 0, "files_after": 0}
