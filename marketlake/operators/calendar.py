"""Trading calendar: days, holidays, sessions; day flags (J8), session test (J9),
missing days (M7).

The calendar comes from year documents and is tiny (one row per day, a few session
intervals), so it is broadcast; its size is bounded by the documents, never by data volume.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas


def _hm_to_micros(hm: Column) -> Column:
    parts = F.split(hm, ":")
    return (parts[0].cast("long") * 3600 + parts[1].cast("long") * 60) * 1000000


class Calendar(NamedTuple):
    """What the documents say: trading days (date, year), holidays (date, name), sessions
    (year, calendar_class, session_no, start_us, end_us; bounds inclusive)."""

    days: DataFrame
    holidays: DataFrame
    sessions: DataFrame


def read_calendar(docs: DataFrame, col: str = "value") -> Calendar:
    """Year documents (JSON text) -> calendar tables (A10).  They are the only source of trading
    days: a weekday that a document does not list is closed."""
    d = docs.select(F.from_json(F.col(col), schemas.CALENDAR_DOC).alias("c")).where("c IS NOT NULL")
    days = d.select(F.col("c.year").alias("year"),
                    F.explode("c.trading_days").alias("_d")).select(
        F.to_date("_d").alias("date"), "year")
    hol = d.select(F.explode("c.holidays").alias("h")).select(
        F.to_date("h.date").alias("date"), F.col("h.name").alias("name"))
    ses = (d.select("c.year", F.explode("c.sessions").alias("calendar_class", "ivs"))
           .select("year", "calendar_class", F.posexplode("ivs").alias("_i", "iv"))
           .select("year", "calendar_class", (F.col("_i") + 1).alias("session_no"),
                   _hm_to_micros(F.col("iv")[0]).alias("start_us"),
                   _hm_to_micros(F.col("iv")[1]).alias("end_us")))
    return Calendar(days, hol, ses)


def _closure(date: str = "date") -> Column:
    """Name of the holiday on a date: the fixed ones, and the exchange's closures on the third
    Monday of January and February."""
    name = None
    for m, d, n in schemas.FIXED_HOLIDAYS:
        cond = (F.month(date) == m) & (F.dayofmonth(date) == d)
        name = F.when(cond, F.lit(n)) if name is None else name.when(cond, F.lit(n))
    return name.when(F.month(date).isin(1, 2) & (F.dayofweek(date) == 2) & F.dayofmonth(date).between(15, 21),
                     F.lit("Exchange closure"))


def calendar_docs(years: DataFrame) -> DataFrame:
    """One JSON document for each `year`, as an exchange publishes them."""
    day = F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))))
    days = years.select(F.col("year").cast("int").alias("year"), day.alias("date")).withColumn("name", _closure())
    text = F.date_format("date", "yyyy-MM-dd")
    open_ = ~F.dayofweek("date").isin(1, 7) & F.col("name").isNull()
    sessions = F.create_map(*[x for cls, ivs in schemas.SESSIONS.items()
                              for x in (F.lit(cls), F.array(*[F.array(F.lit(s), F.lit(e)) for s, e in ivs]))])
    per_year = days.groupBy("year").agg(
        F.sort_array(F.collect_list(F.when(open_, text))).alias("trading_days"),
        F.sort_array(F.collect_list(F.when(F.col("name").isNotNull(), F.struct(text.alias("date"), "name")))).alias("holidays"))
    return per_year.select(F.to_json(F.struct("year", "trading_days", "holidays", sessions.alias("sessions"))).alias("value"))


def days_between(df: DataFrame, col: str = "date") -> DataFrame:
    """Every calendar day from min(col) to max(col) (one-row aggregate, then explode)."""
    return df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi")).select(
        F.explode(F.sequence("_lo", "_hi")).alias("date"))


def trading_day_flags(dates: DataFrame, calendar: Calendar, col: str = "date") -> DataFrame:
    """is_trading_day, holiday_name and year for each row's date."""
    td = calendar.days.select(F.col("date").alias("_td"), F.lit(True).alias("_t"))
    hol = calendar.holidays.select(F.col("date").alias("_hd"), F.col("name").alias("holiday_name"))
    out = (dates.join(F.broadcast(td), F.col(col) == F.col("_td"), "left")
           .join(F.broadcast(hol), F.col(col) == F.col("_hd"), "left"))
    return out.select(*dates.columns, F.coalesce("_t", F.lit(False)).alias("is_trading_day"),
                      "holiday_name", F.year(col).alias("year"))


def calendar_class(asset_class: Column) -> Column:
    """Market classes map onto the calendar's two classes: futures trade on the
    derivative schedule, everything else on the equity one."""
    return F.when(asset_class == "future", F.lit("derivative")).otherwise(F.lit("equity"))


def local_wall(ts: Column) -> tuple[Column, Column]:
    """(local date, microseconds since local midnight) on the exchange clock."""
    local = F.from_utc_timestamp(ts, schemas.EXCHANGE_ZONE)
    us = F.unix_micros(local) - F.unix_micros(F.date_trunc("DAY", local))
    return F.to_date(local), us


def in_session(df: DataFrame, calendar: Calendar, ts: str = "ts_event",
               asset_class: str = "asset_class") -> DataFrame:
    """Flag rows on a trading day and inside a session of their class, bounds
    inclusive (J9).  Adds local_date, session_no (null outside) and in_session."""
    ld, us = local_wall(F.col(ts))
    x = (df.withColumn("local_date", ld).withColumn("_us", us)
         .withColumn("_cls", calendar_class(F.col(asset_class))))
    ses = calendar.sessions.select(F.col("year").alias("_sy"), F.col("calendar_class").alias("_sc"), F.col("session_no"),
                          F.col("start_us").alias("_s0"), F.col("end_us").alias("_s1"))
    td = calendar.days.select(F.col("date").alias("_td"), F.lit(True).alias("_trading"))
    # both sides are bounded by the documents: a handful of intervals a year, one row per day
    j = (x.join(F.broadcast(ses), (F.year("local_date") == F.col("_sy")) & (F.col("_cls") == F.col("_sc")) & F.col("_us").between(F.col("_s0"), F.col("_s1")),
                "left")
         .join(F.broadcast(td), F.col("local_date") == F.col("_td"), "left"))
    flag = F.coalesce(F.col("_trading"), F.lit(False)) & F.col("session_no").isNotNull()
    return (j.withColumn("in_session", flag)
            .withColumn("session_no", F.when(flag, F.col("session_no")))
            .drop("_us", "_cls", "_sy", "_sc", "_s0", "_s1", "_td", "_trading"))


def missing_days(bars: DataFrame, calendar: Calendar) -> DataFrame:
    """Per symbol, trading days between its first and last bar with no bar (M7).

    Bars on trading days are ordered per symbol (one row per trading day, so
    bounded by the calendar); each gap between consecutive bars expands to the
    calendar days strictly inside it, kept when they are trading days.  Output
    size is the number of missing days: no symbol x calendar product and no
    global window.
    """
    td = calendar.days.select("date")
    b = bars.select("symbol", "date").join(F.broadcast(td), "date", "left_semi")
    w = Window.partitionBy("symbol").orderBy("date")
    gaps = (b.withColumn("_prev", F.lag("date").over(w))
            .where(F.datediff("date", "_prev") > 1)
            .select("symbol", F.explode(F.sequence(F.date_add("_prev", 1), F.date_sub("date", 1))).alias("date")))
    return gaps.join(F.broadcast(td), "date", "left_semi").select("symbol", "date")
