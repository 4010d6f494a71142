"""Entity schemas, enums and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for the same results)
# ---------------------------------------------------------------------------
ASSET_CLASSES = ["equity", "future", "index"]
EXCHANGES = ["HOSE", "HNX", "UPCoM", "HNX-DERIV"]
MATCH_TYPES = ["ATO", "continuous", "ATC", "put-through"]
SIDES = ["B", "S", "?"]
ACTION_TYPES = ["dividend_cash", "dividend_stock", "split", "rights", "merger"]
# symbols starting with these are futures, everything else equity
FUTURE_PREFIXES = ["VN30F", "GB"]
# wire defaults when a field is absent
DEFAULT_EXCHANGE = "HOSE"
DEFAULT_MATCH_TYPE = "continuous"
DEFAULT_SIDE = "?"
# alert suppression window per severity, seconds; unknown severity -> 600
ALERT_TTL_SECONDS = {"critical": 0, "error": 600, "warning": 600, "info": 3600, "debug": 300}
ALERT_TTL_DEFAULT = 600
ALERT_KEY_MAX = 1500
# quarterly filing deadlines (month, day) and the +-days window around them
QUARTERLY_REPORT_DATES = {"Q1": (4, 30), "Q2": (7, 30), "Q3": (10, 30), "Q4": (1, 30)}
QUARTERLY_WINDOW_DAYS = 3
# corporate actions looked up this many days ahead of the run date
FORWARD_ACTION_DAYS = 30
# trading sessions per calendar class (inclusive bounds, exchange wall clock)
SESSIONS = {
    "equity": [("09:00", "11:30"), ("13:00", "14:45")],
    "derivative": [("08:45", "11:30"), ("13:00", "14:45")],
}
EXCHANGE_ZONE = "Asia/Ho_Chi_Minh"
TRADING_DAYS_PER_YEAR = 252
# fixed-date public holidays used when a calendar is derived from a date range
FIXED_HOLIDAYS = [
    (1, 1, "New Year's Day"),
    (4, 30, "Reunification Day"),
    (5, 1, "Labour Day"),
    (9, 2, "National Day"),
]
# ---------------------------------------------------------------------------

BOOK_LEVELS = 10


def l2_columns() -> list[str]:
    """The 60 flat book columns in their natural order."""
    cols = []
    for side in ("bid", "ask"):
        for i in range(1, BOOK_LEVELS + 1):
            cols += [f"{side}_px_{i}", f"{side}_sz_{i}", f"{side}_n_{i}"]
    return cols


HEADER = [
    T.StructField("ts_event", T.TimestampType()),
    T.StructField("ts_received", T.TimestampType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("asset_class", T.StringType()),
    T.StructField("exchange", T.StringType()),
]

TICK = T.StructType(HEADER + [
    T.StructField("price", T.LongType()),
    T.StructField("volume", T.LongType()),
    T.StructField("match_type", T.StringType()),
    T.StructField("side", T.StringType()),
    T.StructField("trade_id", T.StringType()),
    T.StructField("seq", T.LongType()),
])

QUOTE_L1 = T.StructType(HEADER + [
    T.StructField("bid_price", T.LongType()),
    T.StructField("bid_size", T.LongType()),
    T.StructField("ask_price", T.LongType()),
    T.StructField("ask_size", T.LongType()),
])

QUOTE_L2 = T.StructType(HEADER + [T.StructField(c, T.LongType()) for c in l2_columns()])

INDEX_VALUE = T.StructType([
    T.StructField("ts_event", T.TimestampType()),
    T.StructField("ts_received", T.TimestampType()),
    T.StructField("index_code", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("change", T.DoubleType()),
    T.StructField("change_pct", T.DoubleType()),
    T.StructField("total_volume", T.LongType()),
    T.StructField("total_value", T.LongType()),
    T.StructField("advance_count", T.IntegerType()),
    T.StructField("decline_count", T.IntegerType()),
    T.StructField("unchanged_count", T.IntegerType()),
])

# Wire payloads (short keys as sent by the feed)
WIRE_TICK = T.StructType([
    T.StructField("S", T.StringType()), T.StructField("P", T.LongType()),
    T.StructField("V", T.LongType()), T.StructField("T", T.LongType()),
    T.StructField("MT", T.StringType()), T.StructField("TID", T.StringType()),
    T.StructField("SEQ", T.LongType()), T.StructField("EX", T.StringType()),
    T.StructField("SD", T.StringType()),
])
WIRE_L1 = T.StructType([
    T.StructField("S", T.StringType()), T.StructField("T", T.LongType()),
    T.StructField("EX", T.StringType()),
    T.StructField("BP", T.LongType()), T.StructField("BV", T.LongType()),
    T.StructField("AP", T.LongType()), T.StructField("AV", T.LongType()),
])
_LEVEL = T.StructType([T.StructField("P", T.LongType()), T.StructField("V", T.LongType()),
                       T.StructField("N", T.LongType())])
WIRE_L2 = T.StructType([
    T.StructField("S", T.StringType()), T.StructField("T", T.LongType()),
    T.StructField("EX", T.StringType()),
    T.StructField("B", T.ArrayType(_LEVEL)), T.StructField("A", T.ArrayType(_LEVEL)),
])
WIRE_INDEX = T.StructType([
    T.StructField("IC", T.StringType()), T.StructField("T", T.LongType()),
    T.StructField("EX", T.StringType()), T.StructField("V", T.DoubleType()),
    T.StructField("C", T.DoubleType()), T.StructField("CP", T.DoubleType()),
    T.StructField("TVO", T.LongType()), T.StructField("TVA", T.LongType()),
    T.StructField("ADV", T.IntegerType()), T.StructField("DEC", T.IntegerType()),
    T.StructField("UNC", T.IntegerType()),
])

# Symbols (indices) pinned to shard 0.
PINNED_SYMBOLS = [
    "VNINDEX", "VN30", "VN100", "VNALL", "VNX50", "VNMID", "VNSML", "HNXINDEX", "HNX30", "HNXLCAP", "HNXMSCAP",
    "HNXSCAP", "UPCOMINDEX", "UPCOMLARGE", "UPCOMMEDIUM", "UPCOMSMALL", "UPCOMPREMIUM", "VNFIN", "VNCONS", "VNCOND",
    "VNENE", "VNHEALTH", "VNIND", "VNIT", "VNMAT", "VNREAL", "VNUTI", "VNTEL", "VNDIAMOND", "VNFINLEAD", "VNFINSELECT",
    "VNXALL",
]

# streams that are landed, receipted and watched
STREAMS = ["ticks", "quotes_l1", "quotes_l2", "index_values"]

GAP = T.StructType([
    T.StructField("stream", T.StringType()), T.StructField("start", T.StringType()),
    T.StructField("end", T.StringType()), T.StructField("reason", T.StringType()),
    T.StructField("recorded_at", T.StringType()),
])

DEAD_LETTER = T.StructType([
    T.StructField("data", T.StringType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("publish_time", T.StringType()),
])

CALENDAR_DOC = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("trading_days", T.ArrayType(T.StringType())),
    T.StructField("holidays", T.ArrayType(T.StructType([
        T.StructField("date", T.StringType()), T.StructField("name", T.StringType())]))),
    T.StructField("sessions", T.MapType(T.StringType(), T.ArrayType(T.ArrayType(T.StringType())))),
])

ALERT_BODY = T.StructType([
    T.StructField("severity", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("body", T.StringType()), T.StructField("scope", T.StringType()),
    T.StructField("source", T.StringType()),
])

# Pulled tables as landed: the entity, the landing order and the partition columns
_DAILY = ("date date, symbol string, asset_class string, exchange string, open bigint, high bigint, low bigint, close bigint, volume bigint, "
          "value bigint, foreign_buy_vol bigint, foreign_sell_vol bigint, ingest_seq bigint")
_TYPES = {"date": T.DateType(), "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType()}
PULLED = {t: T.StructType([T.StructField(n, _TYPES[k]) for n, k in (c.split() for c in cols.split(","))]) for t, cols in {
    "daily_ohlcv": f"{_DAILY}, year int",
    "daily_ohlcv_backfill": f"{_DAILY}, source string, year int",
    "fundamentals": "as_of_date date, symbol string, period string, pe double, pb double, eps double, bvps double, roe double, roa double, "
                    "debt_to_equity double, market_cap bigint, revenue bigint, net_income bigint, total_assets bigint, total_equity bigint, "
                    "ingest_seq bigint, quarter string",
    "corp_actions": "ex_date date, record_date date, payment_date date, symbol string, action_type string, ratio double, amount double, "
                    "ingest_seq bigint, year int",
    "tickers": "symbol string, name string, exchange string, asset_class string, sector_l1 string, sector_l2 string, industry string, "
               "status string, listed_date date, lot_size bigint, tick_size bigint, foreign_room_pct double, snapshot date",
    "futures_contracts": "symbol string, underlying_index string, expiry_date date, contract_size bigint, tick_size bigint, margin_pct double, "
                         "snapshot date",
}.items()}
