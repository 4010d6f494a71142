"""Bind the driver's test tables to market-data entities (Spark side).

Every mapping here has a SQL twin in `bindings_sql.py`; the two must stay in
step because the DuckDB oracle recomputes every entity from the same parquet
files.  The mappings are deterministic functions of the input rows, so the
work of every query grows with the tables.

Timestamps in the test files carry no zone (Spark reads `timestamp_ntz`);
they are read as UTC instants here, once.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .session import checkpoint_dir, configure


#: Events that a task turns into wide rows.
ROWS_PER_TASK = 200_000


def _case(col: Column, mapping: list[tuple[object, object]], default: object = None) -> Column:
    out = None
    for k, v in mapping:
        out = (F.when(col == F.lit(k), F.lit(v)) if out is None
               else out.when(col == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default))


def _plus_seconds(ts: Column, secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs, ts)


class TestLake:
    """Lazy entity frames over one scale-factor directory."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def n_suppliers(self) -> int:
        # one scalar per run (parquet footers answer it); used as a literal modulus
        return self.table("supplier").count()

    # ------------------------------------------------------------------ daily
    @cached_property
    def daily_raw(self) -> DataFrame:
        li = self.table("lineitem")
        close = F.bround(F.col("l_extendedprice") * 100 / F.col("l_quantity"), 0).cast("long")
        return li.select(
            F.to_date("l_shipdate").alias("date"),
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
            F.lit("equity").alias("asset_class"),
            _case(F.col("l_suppkey") % 3, [(0, "HOSE"), (1, "HNX")], "UPCoM").alias("exchange"),
            (close - F.col("l_linenumber") * 50).alias("open"),
            (close + F.col("l_linenumber") * 100).alias("high"),
            (close - F.col("l_linenumber") * 100).alias("low"),
            close.alias("close"),
            F.col("l_quantity").cast("long").alias("volume"),
            (close * F.col("l_quantity").cast("long")).alias("value"),
            ((F.col("l_partkey") % 1000) * 10).alias("foreign_buy_vol"),
            ((F.col("l_orderkey") % 1000) * 10).alias("foreign_sell_vol"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingest_seq"),
        )

    @cached_property
    def corp_actions_raw(self) -> DataFrame:
        n = self.n_suppliers
        o = self.table("orders")
        digit = F.substring("o_orderpriority", 1, 1)
        ex_date = F.to_date("o_orderdate")
        return o.select(
            ex_date.alias("ex_date"),
            F.concat(F.lit("S"), (F.col("o_orderkey") % n).cast("string")).alias("symbol"),
            _case(digit, [("1", "split"), ("2", "dividend_cash"), ("3", "dividend_stock"),
                          ("4", "rights")], "merger").alias("action_type"),
            _case(digit, [("1", 1.02), ("3", 0.01), ("4", 0.005)]).cast("double").alias("ratio"),
            F.when(digit == "2", (F.col("o_custkey") % 500).cast("double")).alias("amount"),
            F.date_add(ex_date, 2).alias("record_date"),
            F.when(digit == "2", F.date_add(ex_date, 30)).alias("payment_date"),
            F.col("o_orderkey").alias("ingest_seq"),
        )

    # ---------------------------------------------------------------- streams
    @cached_property
    def _events_dealt(self) -> DataFrame:
        """The events dealt to tasks by their number (parquet footers answer it), for rows that grow wide before they are
        sorted: the bytes of a file say little about those."""
        e = self.table("events")
        tasks = -(-e.count() // ROWS_PER_TASK)
        return e.repartition(tasks, "event_id") if tasks > 1 else e

    @cached_property
    def _events_base(self) -> DataFrame:
        return self._base_of(self.table("events"))

    def _base_of(self, e: DataFrame) -> DataFrame:
        ts = F.col("ts").cast("timestamp")
        click = F.col("event_type") == "click"
        return e.select(
            "event_id",
            ts.alias("ts_event"),
            _plus_seconds(ts, F.col("event_id") % 5).alias("ts_received"),
            F.concat(F.lit("U"), (F.col("user_id") % 20).cast("string")).alias("symbol"),
            F.when(click, "future").otherwise("equity").alias("asset_class"),
            F.when(click, "HNX-DERIV").otherwise("HOSE").alias("exchange"),
            F.bround(F.col("value") * 100, 0).cast("long").alias("p"),
            "event_type", "value", "user_id",
        )

    @cached_property
    def ticks_raw(self) -> DataFrame:
        b = self._events_base
        base = b.select(
            "ts_event", "ts_received", "symbol", "asset_class", "exchange",
            F.col("p").alias("price"),
            (F.col("event_id") % 100 + 1).alias("volume"),
            _case(F.col("event_id") % 20, [(0, "ATO"), (1, "ATC"), (2, "put-through")],
                  "continuous").alias("match_type"),
            _case(F.col("event_id") % 3, [(0, "B"), (1, "S")], "?").alias("side"),
            F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("trade_id"),
            F.col("event_id").alias("seq"),
        )
        again = (base.where(F.col("seq") % 10 == 0)
                 .withColumn("ts_received", _plus_seconds(F.col("ts_received"), F.lit(60)))
                 .withColumn("price", F.col("price") + 1))
        return base.unionByName(again).withColumn("date", F.to_date("ts_event"))

    @cached_property
    def quotes_l1_raw(self) -> DataFrame:
        return self._quotes_l1_of(self._events_base)

    def _quotes_l1_of(self, b: DataFrame) -> DataFrame:
        eid = F.col("event_id")
        base = b.select(
            "ts_event", "ts_received", "symbol", "asset_class", "exchange",
            F.when(eid % 11 == 0, F.lit(0).cast("long")).otherwise(F.col("p")).alias("bid_price"),
            (eid % 100 + 1).alias("bid_size"),
            F.when(eid % 7 == 0, F.col("p") - 2).otherwise(F.col("p") + eid % 7).alias("ask_price"),
            (eid % 50 + 1).alias("ask_size"),
            eid.alias("ingest_seq"),
        )
        again = (base.where(F.col("ingest_seq") % 10 == 0)
                 .withColumn("ts_received", _plus_seconds(F.col("ts_received"), F.lit(60)))
                 .withColumn("bid_size", F.col("bid_size") + 1))
        return base.unionByName(again).withColumn("date", F.to_date("ts_event"))

    @cached_property
    def quotes_l2_raw(self) -> DataFrame:
        q = self._quotes_l1_of(self._base_of(self._events_dealt.drop("props")))
        eid = F.col("ingest_seq")
        depth = eid % 10 + 1
        cols = []
        for i in range(1, schemas.BOOK_LEVELS + 1):
            has_bid = (F.lit(i) <= depth) & (F.col("bid_price") != 0)
            has_ask = F.lit(i) <= depth
            px = F.col("bid_price") - (i - 1)
            if i == 1:
                px = px + F.when(eid % 13 == 0, 1).otherwise(0)
            cols += [
                F.when(has_bid, px).alias(f"bid_px_{i}"),
                F.when(has_bid, (eid + i) % 90 + 1).alias(f"bid_sz_{i}"),
                F.when(has_bid, (eid + i) % 7 + 1).alias(f"bid_n_{i}"),
            ]
        for i in range(1, schemas.BOOK_LEVELS + 1):
            has_ask = F.lit(i) <= depth
            cols += [
                F.when(has_ask, F.col("ask_price") + (i - 1)).alias(f"ask_px_{i}"),
                F.when(has_ask, (eid + 2 * i) % 90 + 1).alias(f"ask_sz_{i}"),
                F.when(has_ask, (eid + 2 * i) % 7 + 1).alias(f"ask_n_{i}"),
            ]
        hdr = ["ts_event", "ts_received", "symbol", "asset_class", "exchange"]
        return q.select(*hdr, *cols, "ingest_seq", "date",
                        F.hour("ts_event").alias("hour"))

    @cached_property
    def index_raw(self) -> DataFrame:
        b = self._events_base
        eid = F.col("event_id")
        return b.select(
            "ts_event", "ts_received",
            F.upper("event_type").alias("index_code"),
            F.lit("HOSE").alias("exchange"),
            F.col("value").alias("value"),
            (F.col("value") - 50.0).alias("change"),
            ((F.col("value") - 50.0) * 2.0).alias("change_pct"),
            (eid * 10).alias("total_volume"),
            (eid * 1000).alias("total_value"),
            (eid % 300).cast("int").alias("advance_count"),
            ((eid * 7) % 300).cast("int").alias("decline_count"),
            ((eid * 3) % 50).cast("int").alias("unchanged_count"),
            eid.alias("ingest_seq"),
            F.to_date("ts_event").alias("date"),
        )

    # -------------------------------------------------------------- reference
    @cached_property
    def fundamentals_raw(self) -> DataFrame:
        n = self.n_suppliers
        o = self.table("orders")
        d = F.to_date("o_orderdate")
        fl = F.floor("o_totalprice").cast("long")
        return o.select(
            d.alias("as_of_date"),
            F.concat(F.lit("S"), (F.col("o_custkey") % n).cast("string")).alias("symbol"),
            F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("period"),
            (F.col("o_totalprice") / 10000.0).alias("pe"),
            (F.col("o_totalprice") / 100000.0).alias("pb"),
            (F.col("o_totalprice") / 100.0).alias("eps"),
            (F.col("o_totalprice") / 10.0).alias("bvps"),
            ((F.col("o_custkey") % 30) / 100.0).alias("roe"),
            ((F.col("o_custkey") % 15) / 100.0).alias("roa"),
            ((F.col("o_orderkey") % 200) / 100.0).alias("debt_to_equity"),
            (fl * 1000).alias("market_cap"),
            (fl * 100).alias("revenue"),
            (fl * 10).alias("net_income"),
            (fl * 5000).alias("total_assets"),
            (fl * 2000).alias("total_equity"),
            F.col("o_orderkey").alias("ingest_seq"),
        )

    @cached_property
    def tickers(self) -> DataFrame:
        s = self.table("supplier")
        nat = self.table("nation")
        reg = self.table("region")
        # nation (25 rows) and region (5 rows) are fixed-size dimensions
        base = (s.join(F.broadcast(nat), s.s_nationkey == nat.n_nationkey)
                .join(F.broadcast(reg), nat.n_regionkey == reg.r_regionkey))
        k = F.col("s_suppkey")
        common = [
            F.concat(F.lit("S"), k.cast("string")).alias("symbol"),
            F.col("s_name").alias("name"),
            _case(k % 3, [(0, "HOSE"), (1, "HNX")], "UPCoM").alias("exchange"),
            F.lit("equity").alias("asset_class"),
            F.col("r_name").alias("sector_l1"),
            F.col("n_name").alias("sector_l2"),
            F.concat_ws("/", "r_name", "n_name").alias("industry"),
            F.date_add(F.lit("2000-01-01").cast("date"), (k % 3650).cast("int")).alias("listed_date"),
            F.lit(100).cast("long").alias("lot_size"),
            F.lit(10).cast("long").alias("tick_size"),
            (F.col("s_acctbal") / 1000.0).alias("foreign_room_pct"),
        ]
        first = base.select(*common, F.lit("listed").alias("status"),
                            F.lit("2024-01-01").cast("date").alias("snapshot"))
        second = base.select(
            *common, F.when(k % 10 == 0, "delisted").otherwise("listed").alias("status"),
            F.lit("2024-02-01").cast("date").alias("snapshot"))
        return first.unionByName(second)

    @cached_property
    def futures_contracts(self) -> DataFrame:
        months = (self.table("orders")
                  .select(F.trunc(F.to_date("o_orderdate"), "month").alias("m")).distinct())
        sym = F.concat(F.lit("VN30F"), F.date_format("m", "yyMM"))
        cols = [sym.alias("symbol"), F.lit("VN30").alias("underlying_index"),
                F.last_day("m").alias("expiry_date"),
                F.lit(100000).cast("long").alias("contract_size"),
                F.lit(1).cast("long").alias("tick_size"), F.lit(17.0).alias("margin_pct")]
        return (months.select(*cols, F.lit("2024-01-01").cast("date").alias("snapshot"))
                .unionByName(months.select(*cols, F.lit("2024-02-01").cast("date").alias("snapshot"))))

    # ------------------------------------------------------------------- ops
    @cached_property
    def messages_raw(self) -> DataFrame:
        """Wire messages as a bus holds them: written once, in as many files as there are tasks to read them."""
        from .sinks.lake import staged
        return staged(self._messages.repartition(2 * self.spark.sparkContext.defaultParallelism), "messages")

    @cached_property
    def _messages(self) -> DataFrame:
        """Wire messages for the four channels, some cut short, some invalid."""
        b = self._events_base
        eid = F.col("event_id")
        ms = F.unix_millis("ts_event")
        price = F.when(eid % 19 == 0, F.lit(-1).cast("long")).otherwise(F.col("p"))
        ch = _case(eid % 4, [(0, "tick"), (1, "l1"), (2, "l2")], "index")
        tick = F.to_json(F.struct(
            F.col("symbol").alias("S"), price.alias("P"), (eid % 100 + 1).alias("V"), ms.alias("T"),
            F.when(eid % 20 != 3, F.lit("continuous")).alias("MT"),
            F.concat(F.lit("T"), eid.cast("string")).alias("TID"), eid.alias("SEQ"),
            F.when(eid % 8 != 5, F.col("exchange")).alias("EX"),
            _case(eid % 3, [(0, "B"), (1, "S")]).alias("SD")))
        l1 = F.to_json(F.struct(
            F.col("symbol").alias("S"), ms.alias("T"), F.col("exchange").alias("EX"),
            F.when(eid % 11 != 0, price).alias("BP"), (eid % 100 + 1).alias("BV"),
            (F.col("p") + eid % 7).alias("AP"), (eid % 50 + 1).alias("AV")))
        lvl = lambda px, j: F.struct(px.alias("P"), ((eid + j) % 90 + 1).alias("V"),
                                     ((eid + j) % 7 + 1).alias("N"))
        depth_b = eid % 4
        l2 = F.to_json(F.struct(
            F.col("symbol").alias("S"), ms.alias("T"), F.col("exchange").alias("EX"),
            F.slice(F.array(*[lvl(price - i, i) for i in range(10)]), 1, depth_b * 3 + 1).alias("B"),
            F.slice(F.array(*[lvl(F.col("p") + 1 + i, 2 * i) for i in range(10)]), 1,
                    (eid % 5) * 2 + 1).alias("A")))
        idx = F.to_json(F.struct(
            F.upper("event_type").alias("IC"), ms.alias("T"), F.lit("HOSE").alias("EX"),
            F.col("value").alias("V"), (F.col("value") - 50.0).alias("C"),
            ((F.col("value") - 50.0) * 2.0).alias("CP"), (eid * 10).alias("TVO"),
            (eid * 1000).alias("TVA"), (eid % 300).cast("int").alias("ADV"),
            ((eid * 7) % 300).cast("int").alias("DEC"), ((eid * 3) % 50).cast("int").alias("UNC")))
        # some feeds quote whole numbers or give them a fraction
        tick = F.when(eid % 23 == 0, F.regexp_replace(tick, '"P":(-?[0-9]+)', '"P":"$1"')).otherwise(tick)
        tick = F.when(eid % 29 == 0, F.regexp_replace(tick, '"V":([0-9]+)', '"V":$1.0')).otherwise(tick)
        payload = (F.when(ch == "tick", tick).when(ch == "l1", l1)
                   .when(ch == "l2", l2).otherwise(idx))
        payload = F.when(eid % 17 == 0, F.concat(F.lit("{broken "), eid.cast("string"))).otherwise(payload)
        return b.select(eid.alias("msg_id"), ch.alias("channel"), payload.alias("payload"),
                        F.col("ts_received"))

    @cached_property
    def alerts_raw(self) -> DataFrame:
        e = self.table("events")
        eid = F.col("event_id")
        sev = _case(F.col("event_type"), [("error", "error"), ("click", "warning"),
                                          ("view", "info"), ("purchase", "debug")], "critical")
        name = F.concat(F.lit("A"), (F.col("user_id") % 5).cast("string"))
        scope = F.concat(F.lit("U/"), (F.col("user_id") % 3).cast("string"))
        obj = F.to_json(F.struct(
            F.when(eid % 5 != 1, sev).alias("severity"), name.alias("name"),
            F.concat(F.lit("event="), eid.cast("string")).alias("body"),
            F.when(eid % 4 != 2, scope).alias("scope"), F.lit("ops").alias("source")))
        text = F.concat(F.lit("plain alert "), F.col("event_type"))
        data = F.base64(F.when(eid % 3 == 0, text).otherwise(obj).cast("binary"))
        attrs = F.create_map(F.lit("severity"), sev, F.lit("scope"), scope)
        return e.select(eid.alias("alert_id"), F.col("ts").cast("timestamp").alias("ts"),
                        data.alias("data"), attrs.alias("attributes"))

    @cached_property
    def gap_lines(self) -> DataFrame:
        e = self.table("events")
        eid = F.col("event_id")
        d = F.to_date(F.col("ts").cast("timestamp"))
        good = F.to_json(F.struct(
            F.when(eid % 100 == 0, "ticks").otherwise("quotes_l1").alias("stream"),
            F.date_format(d, "yyyy-MM-dd").alias("start"),
            F.when(eid % 200 == 0, F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss"))
             .otherwise(F.date_format(F.date_add(d, 1), "yyyy-MM-dd")).alias("end"),
            F.lit("source_unavailable").alias("reason"),
            F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("recorded_at")))
        line = (F.when(eid % 150 == 0, F.lit("{not json"))
                .when(eid % 350 == 0, F.lit("   "))
                .when(eid % 250 == 0, F.lit('{"stream": "ticks", "start": "soon", "end": "2024-13-45"}'))
                .otherwise(good))
        return e.select(line.alias("value"))

    @cached_property
    def dead_letter_lines(self) -> DataFrame:
        e = self.table("events")
        topic = F.when(F.col("event_type").isin("click", "view"), "ticks").otherwise("quotes-l1")
        return e.select(F.to_json(F.struct(
            F.col("props").alias("data"),
            F.create_map(F.lit("topic"), topic, F.lit("symbol"),
                         F.concat(F.lit("U"), (F.col("user_id") % 20).cast("string"))).alias("attributes"),
            F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("publish_time"))).alias("value"))

    # ------------------------------------------------------------- curated
    @cached_property
    def curated_daily_plan(self) -> DataFrame:
        """Curation of the daily bars from the raw tables (lazy plan)."""
        from .operators.curate import curate_daily_ohlcv
        return curate_daily_ohlcv(self.daily_raw, self.corp_actions_raw)

    @cached_property
    def root(self) -> str:
        """Lake root of this run, in the folder that all executors share."""
        return self.scratch("lake")

    def scratch(self, name: str) -> str:
        return f"{checkpoint_dir(self.spark)}/{name}-{uuid.uuid4().hex}"

    def _written(self, plan: DataFrame, stream: str) -> DataFrame:
        """A curated table as downstream queries read it: written once by the
        curation sink and scanned from its partitioned files, as the
        curation jobs and research queries do."""
        from .sinks.lake import write_curated
        from .sources.lake import curated_columns
        year = {"daily_ohlcv": "date", "corp_actions": "ex_date"}.get(stream)
        if year:
            plan = plan.withColumn("year", F.year(year))
        if stream == "fundamentals":
            plan = plan.withColumn("quarter", F.col("period"))
        write_curated(plan, self.root, stream)
        return curated_columns(self.spark, self.root, stream)

    # ------------------------------------------------------------ calendar
    @cached_property
    def calendar_lines(self) -> DataFrame:
        """Calendar documents (JSON text), one for each year that has bars or events: weekdays
        less fixed holidays and the exchange's own closures."""
        from .operators.calendar import calendar_docs, local_wall
        bar_years = self.table("lineitem").select(F.year("l_shipdate").alias("year"))
        local, _ = local_wall(F.col("ts").cast("timestamp"))
        years = bar_years.unionByName(self.table("events").select(F.year(local).alias("year"))).distinct()
        return calendar_docs(years.where(F.col("year").between(1970, 2100)))

    @cached_property
    def calendar(self):
        from .operators.calendar import read_calendar
        return read_calendar(self.calendar_lines)

    @cached_property
    def curated_daily(self) -> DataFrame:
        return self._written(self.curated_daily_plan, "daily_ohlcv")

    @cached_property
    def curated_corp_actions_plan(self) -> DataFrame:
        from .operators.curate import curate_corp_actions
        return curate_corp_actions(self.corp_actions_raw)

    @cached_property
    def curated_corp_actions(self) -> DataFrame:
        return self._written(self.curated_corp_actions_plan, "corp_actions")

    @cached_property
    def curated_ticks_plan(self) -> DataFrame:
        from .operators.curate import curate_ticks
        return curate_ticks(self.ticks_raw)

    @cached_property
    def curated_ticks(self) -> DataFrame:
        return self._written(self.curated_ticks_plan, "ticks")

    @cached_property
    def curated_l1_plan(self) -> DataFrame:
        from .operators.curate import curate_quotes_l1
        return curate_quotes_l1(self.quotes_l1_raw)

    @cached_property
    def curated_l1(self) -> DataFrame:
        return self._written(self.curated_l1_plan, "quotes_l1")

    @cached_property
    def curated_l2_plan(self) -> DataFrame:
        from .operators.curate import curate_quotes_l2
        return curate_quotes_l2(self.quotes_l2_raw)

    @cached_property
    def curated_l2(self) -> DataFrame:
        return self._written(self.curated_l2_plan, "quotes_l2")

    @cached_property
    def curated_index_plan(self) -> DataFrame:
        from .operators.curate import curate_indices
        return curate_indices(self.index_raw)

    @cached_property
    def curated_index(self) -> DataFrame:
        return self._written(self.curated_index_plan, "index_values")

    @cached_property
    def curated_fundamentals_plan(self) -> DataFrame:
        from .operators.curate import curate_fundamentals
        return curate_fundamentals(self.fundamentals_raw)

    @cached_property
    def curated_fundamentals(self) -> DataFrame:
        return self._written(self.curated_fundamentals_plan, "fundamentals")

    # ------------------------------------------------------------ derived raw
    @cached_property
    def tick_bars(self) -> DataFrame:
        """Vendor-style daily bars built from the raw (re-delivered) tick feed."""
        k = F.col("seq") * 1000000 + F.col("price")
        return (self.ticks_raw.groupBy("date", "symbol")
                .agg(F.min_by("price", k).alias("open"), F.max("price").alias("high"),
                     F.min("price").alias("low"), F.max_by("price", k).alias("close"),
                     F.sum("volume").alias("volume"), F.sum(F.col("price") * F.col("volume")).alias("value"))
                .select("date", "symbol", F.lit("equity").alias("asset_class"), F.lit("HOSE").alias("exchange"),
                        "open", "high", "low", "close", "volume", "value"))

    @cached_property
    def equity_curve(self) -> DataFrame:
        return self.curated_daily.select(F.col("symbol").alias("strategy"), "date",
                                         F.col("adj_close").cast("double").alias("equity"))

    @cached_property
    def universe_lines(self) -> DataFrame:
        """Symbol list lines: JSON strings (lower case) or objects, with repeats and blanks."""
        s = self.table("supplier")
        k = F.col("s_suppkey")
        as_text = F.concat(F.lit('"s'), k.cast("string"), F.lit('"'))
        as_obj = F.to_json(F.struct(F.concat(F.lit("S"), k.cast("string")).alias("symbol")))
        first = s.select(F.when(k % 2 == 0, as_text).otherwise(as_obj).alias("value"))
        again = s.where(k % 5 == 0).select(as_obj.alias("value"))
        blank = s.where(k % 9 == 0).select(F.lit("").alias("value"))
        return first.unionByName(again).unionByName(blank)

    @cached_property
    def accepted_ticks(self) -> DataFrame:
        from .operators import ingest
        v = ingest.validate_rows(ingest.parse_ticks(self.messages_raw), "ticks")
        ok, _ = ingest.split_rejects(v)
        return ok.withColumn("date", F.to_date("ts_event"))

    # ------------------------------------------------------- vendor pulls
    @cached_property
    def vendor_daily(self) -> DataFrame:
        """Vendor-shaped daily rows (prices in thousands, float volume), one per lineitem."""
        li = self.table("lineitem")
        c = F.col("l_extendedprice") / F.col("l_quantity")
        n = F.col("l_linenumber")
        return li.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
                         F.col("l_shipdate").alias("time"), (c - n * 0.5).alias("open"), (c + n).alias("high"),
                         (c - n).alias("low"), c.alias("close"), F.col("l_quantity").alias("volume"))

    @cached_property
    def vendor_fundamentals(self) -> DataFrame:
        """Vendor fundamentals: report_date alias, year/quarter ints, three ratios only."""
        n = self.n_suppliers
        o = self.table("orders")
        return o.select(F.concat(F.lit("S"), (F.col("o_custkey") % n).cast("string")).alias("symbol"),
                        F.to_date("o_orderdate").alias("report_date"), F.year("o_orderdate").alias("year"),
                        F.quarter("o_orderdate").alias("quarter"), (F.col("o_totalprice") / 10000.0).alias("pe"),
                        (F.col("o_totalprice") / 100000.0).alias("pb"), (F.col("o_totalprice") / 100.0).alias("eps"))

    @cached_property
    def vendor_corp_actions(self) -> DataFrame:
        """Vendor actions with `exDate` as the ex-date column and no payment_date."""
        a = self.corp_actions_raw
        return a.select(F.col("ex_date").alias("exDate"), "symbol", "action_type", "ratio", "amount",
                        "record_date")

    @cached_property
    def vendor_tickers(self) -> DataFrame:
        s = self.table("supplier")
        k = F.col("s_suppkey")
        return s.select(F.concat(F.lit("S"), k.cast("string")).alias("symbol"), F.col("s_name").alias("name"),
                        F.when(k % 6 == 0, F.lit("N/A"))
                         .otherwise(F.date_format(F.date_add(F.lit("2000-01-01").cast("date"),
                                                             (k % 3650).cast("int")), "yyyy-MM-dd"))
                         .alias("listed_date"),
                        F.lit(100).cast("long").alias("lot_size"))

    @cached_property
    def vendor_futures(self) -> DataFrame:
        f = self.futures_contracts.where(F.col("snapshot") == F.lit("2024-02-01").cast("date"))
        return f.select("symbol", "underlying_index",
                        F.date_format("expiry_date", "yyyy-MM-dd").alias("expiry_date"), "contract_size")

    @cached_property
    def pull_results(self) -> DataFrame:
        """Outcome of each source per symbol: (source, rank, symbol, status)."""
        s = self.table("supplier")
        k = F.col("s_suppkey")
        src = F.explode(F.array(F.struct(F.lit("primary").alias("source"), F.lit(1).alias("rank"),
                                         F.when(k % 4 == 0, "error").otherwise("ok").alias("status")),
                                F.struct(F.lit("secondary").alias("source"), F.lit(2).alias("rank"),
                                         F.when(k % 8 == 0, "error").otherwise("ok").alias("status"))))
        return s.select(F.concat(F.lit("S"), k.cast("string")).alias("symbol"), src.alias("r")).select(
            "r.source", "r.rank", "symbol", "r.status")

    @cached_property
    def billing(self) -> DataFrame:
        e = self.table("events")
        return e.select(F.to_date("ts").alias("date"), F.col("value").alias("cost"))
