"""Raw side: wire parsing, validation, quarantine, receipts, side files."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..bindings_sql import CLASSIFY
from ..functions.prices import classify_symbol
from ..operators import ingest
from ..sources import jsonl
from . import query


@query("parse_ticks", "SELECT * FROM parsed_ticks")
def q_parse_ticks(lk):
    return ingest.parse_ticks(lk.messages_raw)


@query("parse_quotes_l1", f"""
SELECT msg_id, epoch_ms(T) AS ts_event, ts_received, S AS symbol, {CLASSIFY} AS asset_class,
       coalesce(EX, 'HOSE') AS exchange, coalesce(BP, 0) AS bid_price, coalesce(BV, 0) AS bid_size,
       coalesce(AP, 0) AS ask_price, coalesce(AV, 0) AS ask_size,
       CASE WHEN coalesce(BP, 0) > 0 AND coalesce(AP, 0) > 0 THEN (coalesce(BP, 0) + coalesce(AP, 0)) // 2 END AS mid_price,
       CASE WHEN coalesce(BP, 0) > 0 AND coalesce(AP, 0) > 0 THEN CAST(round_even(10000.0::DOUBLE *
            (coalesce(AP, 0) - coalesce(BP, 0)) / ((coalesce(BP, 0) + coalesce(AP, 0)) // 2), 0) AS INTEGER) END AS spread_bps
FROM decoded_l1 WHERE parse_error IS NULL
""")
def q_parse_quotes_l1(lk):
    return ingest.parse_quotes_l1(lk.messages_raw)


def _l2_sql():
    cols = []
    for side, k in (("bid", "B"), ("ask", "A")):
        for i in range(schemas.BOOK_LEVELS):
            for w, f in (("px", "P"), ("sz", "V"), ("n", "N")):
                cols.append(f'"{k}[{i}].{f}" AS {side}_{w}_{i + 1}')
    return (f"SELECT msg_id, epoch_ms(T) AS ts_event, ts_received, S AS symbol, {CLASSIFY} AS asset_class, "
            f"coalesce(EX, 'HOSE') AS exchange, " + ", ".join(cols)
            + " FROM decoded_l2 WHERE parse_error IS NULL")


@query("parse_quotes_l2", _l2_sql())
def q_parse_quotes_l2(lk):
    return ingest.parse_quotes_l2(lk.messages_raw)


@query("parse_indices", """
SELECT msg_id, epoch_ms(T) AS ts_event, ts_received, IC AS index_code, coalesce(EX, 'HOSE') AS exchange,
       V AS value, C AS change, CP AS change_pct, TVO AS total_volume, TVA AS total_value,
       ADV AS advance_count, DEC AS decline_count, UNC AS unchanged_count
FROM decoded_index WHERE parse_error IS NULL
""")
def q_parse_indices(lk):
    return ingest.parse_indices(lk.messages_raw)


@query("quarantine_parse_errors", " UNION ALL ".join(
    f"SELECT msg_id, channel, payload AS raw, ts_received AS ts, parse_error AS error "
    f"FROM decoded_{ch} WHERE parse_error IS NOT NULL" for ch in ("tick", "l1", "l2", "index")))
def q_quarantine_parse_errors(lk):
    return ingest.parse_errors(lk.messages_raw)


def _validated(lk, stream):
    return ingest.keyed_by_symbol(ingest.validated(lk.messages_raw, stream), stream)


VALIDATED = {"ticks": "validated_ticks", "quotes_l1": "validated_l1", "quotes_l2": "validated_l2",
             "index_values": "validated_index"}


def _register_validation(stream: str, name: str) -> None:
    @query(name, f"SELECT msg_id, symbol, reject_reason FROM {VALIDATED[stream]}")
    def q_validate(lk):
        """Every parsed row of the stream with its reject reasons."""
        return _validated(lk, stream).select("msg_id", "symbol", "reject_reason")


for _stream, _name in (("ticks", "validate_rows"), ("quotes_l1", "validate_quotes_l1"),
                       ("quotes_l2", "validate_quotes_l2"), ("index_values", "validate_indices")):
    _register_validation(_stream, _name)


@query("quarantine_rejects", " UNION ALL ".join(
    f"SELECT '{s}' AS stream, msg_id, symbol, ts_event, CAST(ts_event AS DATE) AS date, reject_reason "
    f"FROM {v} WHERE reject_reason IS NOT NULL" for s, v in VALIDATED.items()))
def q_quarantine_rejects(lk):
    """S4 over the four streams."""
    return ingest.routed(lk.messages_raw).rejects()


RECEIPTS_SQL = " UNION ALL ".join(
    f"SELECT 'raw/{s}/date=' || CAST(CAST(ts_event AS DATE) AS VARCHAR) || '/batch=0' AS file, count(*) AS rows, "
    f"min(ts_event) AS min_ts, max(ts_event) AS max_ts, '1' AS schema_version, '{s}' AS stream, "
    f"CAST(ts_event AS DATE) AS date, symbol FROM {v} WHERE reject_reason IS NULL GROUP BY CAST(ts_event AS DATE), symbol"
    for s, v in VALIDATED.items())


def all_receipts(lk):
    """Receipts of the accepted rows of the four streams."""
    return ingest.routed(lk.messages_raw).receipts()


@query("write_receipts", RECEIPTS_SQL)
def q_write_receipts(lk):
    """S3: one receipt per landed (stream, date, symbol) of accepted rows."""
    return all_receipts(lk)


@query("read_receipts", RECEIPTS_SQL)
def q_read_receipts(lk):
    """Receipts landed as JSON-lines files and read back with their schema."""
    from ..sinks.lake import write_receipts
    root = lk.scratch("receipts")
    write_receipts(all_receipts(lk), root, "0")
    return jsonl.read_receipts(jsonl.text_lines(lk.spark, f"{root}/_ops/ingest-receipts"))


@query("read_gaps", """
SELECT json_extract_string(value, '$.stream') AS stream,
       CAST(TRY_STRPTIME(json_extract_string(value, '$.start'), '%Y-%m-%d') AS DATE) AS start,
       CAST(TRY_STRPTIME(json_extract_string(value, '$.end'), '%Y-%m-%d') AS DATE) AS "end",
       json_extract_string(value, '$.reason') AS reason,
       json_extract_string(value, '$.recorded_at') AS recorded_at
FROM gap_lines WHERE coalesce(CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' END, false)
""")
def q_read_gaps(lk):
    return jsonl.read_gaps(lk.gap_lines)


@query("read_dead_letters", """
SELECT json_extract_string(value, '$.data') AS data, json_extract_string(value, '$.attributes.topic') AS topic,
       json_extract_string(value, '$.attributes.symbol') AS symbol,
       json_extract_string(value, '$.publish_time') AS publish_time
FROM dead_letter_lines
""")
def q_read_dead_letters(lk):
    d = jsonl.read_dead_letters(lk.dead_letter_lines)
    return d.select("data", F.col("attributes")["topic"].alias("topic"),
                    F.col("attributes")["symbol"].alias("symbol"), "publish_time")


@query("read_equity_curve", "SELECT strategy, date, equity, NULL::DOUBLE AS position FROM equity_curve")
def q_read_equity_curve(lk):
    """Required-column check and typing of an equity curve table."""
    return jsonl.check_equity_curve(lk.equity_curve)


@query("classify_symbol", """
WITH wire AS (
  SELECT S AS symbol FROM decoded_tick UNION SELECT S FROM decoded_l1 UNION SELECT S FROM decoded_l2
  UNION SELECT symbol FROM futures_contracts)
SELECT DISTINCT symbol, CASE WHEN starts_with(symbol, 'VN30F') OR starts_with(symbol, 'GB') THEN 'future' ELSE 'equity' END AS asset_class
FROM wire WHERE symbol IS NOT NULL
""")
def q_classify_symbol(lk):
    """P1 over every symbol seen on the wire, whatever its channel, and every listed future."""
    m = ingest.decode(lk.messages_raw).select(F.col("m.tick.S").alias("a"), F.col("m.l1.S").alias("b"), F.col("m.l2.S").alias("c"))
    wire = m.select(F.coalesce("a", "b", "c").alias("symbol")).where("symbol is not null")
    syms = wire.unionByName(lk.futures_contracts.select("symbol")).distinct()
    return syms.select("symbol", classify_symbol(F.col("symbol")).alias("asset_class"))
