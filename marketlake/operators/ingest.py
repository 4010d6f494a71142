"""Wire messages -> typed rows (A3-A6), validation (P4), quarantine (S4, S5), receipts (S3).

Parsing is `from_json` with an explicit schema (no inference, no Python); a
message is a parse error when its text is not JSON or a required field is
missing or mistyped.  Validation then turns the model rules (non-negative
numbers, enum values) into an array of reject reasons per row.  `routed` does
all of it for all channels with one decode per message.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.prices import classify_symbol, epoch_to_ts, l1_derived

CHANNELS = {"tick": schemas.WIRE_TICK, "l1": schemas.WIRE_L1, "l2": schemas.WIRE_L2,
            "index": schemas.WIRE_INDEX}
REQUIRED = {
    "tick": ["S", "P", "V", "T", "TID", "SEQ"],
    "l1": ["S", "T"],
    "l2": ["S", "T"],
    "index": ["IC", "T", "V", "C", "CP", "TVO", "TVA", "ADV", "DEC", "UNC"],
}


def _is_object(payload: Column) -> Column:
    return F.trim(payload).startswith("{") & F.get_json_object(payload, "$").isNotNull()


def _as_text(t: T.DataType) -> T.DataType:
    """The wire schema with every number as text."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_as_text(t.elementType))
    return T.StringType()


def _coerced(c: str, t: T.DataType) -> str:
    """SQL from text to the declared type: whole numbers may be quoted or carry a fraction, which is cut."""
    if isinstance(t, T.StructType):
        fields = ", ".join(f"'{f.name}', {_coerced(f'{c}.`{f.name}`', f.dataType)}" for f in t.fields)
        return f"if({c} is null, null, named_struct({fields}))"
    if isinstance(t, T.ArrayType):
        return f"transform({c}, x -> {_coerced('x', t.elementType)})"
    if isinstance(t, T.IntegralType):
        whole = f"coalesce(try_cast({c} as bigint), try_cast(try_cast({c} as decimal(38,6)) as bigint))"
        return whole if isinstance(t, T.LongType) else f"try_cast({whole} as {t.simpleString()})"
    return c if isinstance(t, T.StringType) else f"try_cast({c} as {t.simpleString()})"


def _one_row(c: Column, name: str) -> Column:
    """`explode(array(c))` yields exactly one row per row, and expressions on it stay above the
    generator: `c` is computed once, however often and wherever it is used."""
    return F.explode(F.array(c)).alias(name)


def _wire(channels: Sequence[str]) -> T.StructType:
    """The text schema that holds the fields of all `channels`, so one pass reads any of their messages."""
    fields: dict[str, T.StructField] = {}
    for ch in channels:
        for f in _as_text(CHANNELS[ch]).fields:
            fields.setdefault(f.name, f)
    return T.StructType(list(fields.values()))


def decode(messages: DataFrame, channels: str | Sequence[str] = tuple(CHANNELS), payload: str = "payload") -> DataFrame:
    """Messages of the channels with `m`, a struct that holds the typed message under its channel's name, and a
    `parse_error` text.  Every message's JSON is read once.  With all channels, those of an unknown one are errors."""
    chs = [channels] if isinstance(channels, str) else list(channels)
    if set(chs) != set(CHANNELS):
        messages = messages.where(F.col("channel").isin(chs))
    given = messages.columns
    text = F.when(_is_object(F.col(payload)), F.from_json(F.col(payload), _wire(chs)))
    d = messages.select(*given, _one_row(text, "_t"))

    typed = ", ".join(f"'{ch}', " + (f"if(channel = '{ch}', {_coerced('_t', CHANNELS[ch])}, null)" if len(chs) > 1 else
                                     _coerced("_t", CHANNELS[ch])) for ch in chs)
    d = d.select(*given, _one_row(F.expr(f"named_struct({typed})"), "m"))
    cases = []
    for ch in chs:
        missing = ", ".join(f"if(m.{ch}.`{f}` is null, '{f}', null)" for f in REQUIRED[ch])
        cases.append(f"when channel <> '{ch}' then null when m.{ch} is null then 'unparsable' else "
                     f"nullif(concat('missing:', concat_ws(',', {missing})), 'missing:') end")
    error = "case channel " + " ".join(f"when '{ch}' then case {c}" for ch, c in zip(chs, cases, strict=True)) + " else 'unknown channel' end"
    return d.select("*", _one_row(F.expr(error), "parse_error"))


def _exchange(m: Column) -> Column:
    return F.coalesce(m["EX"], F.lit(schemas.DEFAULT_EXCHANGE)).alias("exchange")


def _header(m: Column) -> list[Column]:
    return [epoch_to_ts(m["T"]).alias("ts_event"), F.col("ts_received"), m["S"].alias("symbol"),
            classify_symbol(m["S"]).alias("asset_class"), _exchange(m)]


def _tick(m: Column) -> list[Column]:
    return [*_header(m), m["P"].alias("price"), m["V"].alias("volume"),
            F.coalesce(m["MT"], F.lit(schemas.DEFAULT_MATCH_TYPE)).alias("match_type"),
            F.coalesce(m["SD"], F.lit(schemas.DEFAULT_SIDE)).alias("side"), m["TID"].alias("trade_id"), m["SEQ"].alias("seq")]


def _quote(m: Column) -> list[Column]:
    z = F.lit(0).cast("long")
    return [*_header(m), F.coalesce(m["BP"], z).alias("bid_price"), F.coalesce(m["BV"], z).alias("bid_size"),
            F.coalesce(m["AP"], z).alias("ask_price"), F.coalesce(m["AV"], z).alias("ask_size")]


def _book(m: Column) -> list[Column]:
    """The levels stay arrays until a row leaves (`_flat_book`)."""
    return [*_header(m), *[F.slice(m[k], 1, schemas.BOOK_LEVELS).alias(side) for side, k in (("bid", "B"), ("ask", "A"))]]


def _index(m: Column) -> list[Column]:
    return [epoch_to_ts(m["T"]).alias("ts_event"), F.col("ts_received"), m["IC"].alias("index_code"), _exchange(m),
            m["V"].alias("value"), m["C"].alias("change"), m["CP"].alias("change_pct"), m["TVO"].alias("total_volume"),
            m["TVA"].alias("total_value"), m["ADV"].alias("advance_count"), m["DEC"].alias("decline_count"),
            m["UNC"].alias("unchanged_count")]


#: stream -> (channel, columns of its row)
STREAMS = {"ticks": ("tick", _tick), "quotes_l1": ("l1", _quote), "quotes_l2": ("l2", _book), "index_values": ("index", _index)}


def _flat_book(rows: DataFrame) -> DataFrame:
    """Bid and ask level arrays as 60 columns; levels past the book are null."""
    levels = [f"get({side}, {i}).{k} as {side}_{c}_{i + 1}" for side in ("bid", "ask") for i in range(schemas.BOOK_LEVELS)
              for c, k in (("px", "P"), ("sz", "V"), ("n", "N"))]
    kept = [c for c in rows.columns if c not in ("bid", "ask")]
    return rows.selectExpr(*[c for c in kept if c != "reject_reason"], *levels, *[c for c in kept if c == "reject_reason"])


def _finished(rows: DataFrame, stream: str) -> DataFrame:
    if stream == "quotes_l2":
        return _flat_book(rows)
    return l1_derived(rows) if stream == "quotes_l1" else rows


def _parsed(messages: DataFrame, stream: str) -> DataFrame:
    ch, row = STREAMS[stream]
    d = decode(messages, ch).where(F.col("parse_error").isNull())
    return _finished(d.select("msg_id", *row(F.col("m")[ch])), stream)


def parse_ticks(messages: DataFrame) -> DataFrame:
    return _parsed(messages, "ticks")


def parse_quotes_l1(messages: DataFrame) -> DataFrame:
    return _parsed(messages, "quotes_l1")


def parse_quotes_l2(messages: DataFrame) -> DataFrame:
    return _parsed(messages, "quotes_l2")


def parse_indices(messages: DataFrame) -> DataFrame:
    return _parsed(messages, "index_values")


def _errors(decoded: DataFrame, payload: str = "payload") -> DataFrame:
    return decoded.where(F.col("parse_error").isNotNull()).select(
        "msg_id", "channel", F.col(payload).alias("raw"), F.col("ts_received").alias("ts"), F.col("parse_error").alias("error"))


def parse_errors(messages: DataFrame) -> DataFrame:
    """Unparsable messages of every channel: channel, raw text, time, error."""
    return _errors(decode(messages))


# ------------------------------------------------------------------ validation
Get = Callable[[str], Column]


def _nonneg(cols: list[str], get: Get) -> list[Column]:
    return [F.when(get(c) < 0, F.lit(f"{c}<0")) for c in cols]


def _enum(col: str, allowed: list[str], get: Get) -> Column:
    return F.when(~get(col).isin(allowed), F.lit(f"{col}:invalid"))


def _required(cols: list[str], get: Get) -> list[Column]:
    return [F.when(get(c).isNull(), F.lit(f"{c}:missing")) for c in cols]


def _negative_levels(side: str, get: Get) -> Column:
    """Reasons of an array of levels, in the order of the flat columns."""
    return F.flatten(F.transform(F.coalesce(get(side), F.array()), lambda x, i: F.array(*[
        F.when(x[k] < 0, F.concat(F.lit(f"{side}_{c}_"), (i + 1).cast("string"), F.lit("<0"))) for c, k in (("px", "P"), ("sz", "V"), ("n", "N"))])))


#: stream -> the columns that must be there, must not be negative, and must be one of a list
RULES = {
    "ticks": (["ts_event", "symbol", "trade_id", "price", "volume", "seq"], ["price", "volume", "seq"],
              {"exchange": schemas.EXCHANGES, "match_type": schemas.MATCH_TYPES, "side": schemas.SIDES, "asset_class": schemas.ASSET_CLASSES}),
    "quotes_l1": (["ts_event", "symbol"], ["bid_price", "bid_size", "ask_price", "ask_size"], {"exchange": schemas.EXCHANGES}),
    "quotes_l2": (["ts_event", "symbol"], schemas.l2_columns(), {"exchange": schemas.EXCHANGES}),
    "index_values": (["ts_event", "index_code"], ["value", "total_volume", "total_value", "advance_count", "decline_count", "unchanged_count"],
                     {"exchange": schemas.EXCHANGES}),
}


def _reasons(stream: str, get: Get = F.col, levels: bool = False) -> Column:
    """The rules that a row breaks, joined by commas; null without any.  `levels`: a book whose levels are arrays."""
    needed, positive, lists = RULES[stream]
    parts = [F.array(*_required(needed, get))]
    parts += [_negative_levels(side, get) for side in ("bid", "ask")] if levels else [F.array(*_nonneg(positive, get))]
    parts.append(F.array(*[_enum(c, allowed, get) for c, allowed in lists.items()]))
    return F.nullif(F.concat_ws(",", *parts), F.lit(""))


def validate_rows(df: DataFrame, stream: str) -> DataFrame:
    """Add `reject_reason` (comma list, null when the row is accepted)."""
    return df.select("*", _one_row(_reasons(stream), "reject_reason"))


def split_rejects(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) halves of a validated frame."""
    ok = validated.where(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = validated.where(F.col("reject_reason").isNotNull())
    return ok, bad


def _judged(decoded: DataFrame, stream: str, keep: Sequence[str] = ("msg_id",)) -> DataFrame:
    """Parsed rows of one stream with their reject reasons; a book's levels are still arrays."""
    ch, row = STREAMS[stream]
    rows = decoded.where((F.col("channel") == ch) & F.col("parse_error").isNull()).select(*keep, *row(F.col("m")[ch]))
    return rows.select("*", _one_row(_reasons(stream, levels=stream == "quotes_l2"), "reject_reason"))


def validated(messages: DataFrame, stream: str) -> DataFrame:
    """Parsed rows of a stream with their reject reasons."""
    return _finished(_judged(decode(messages, STREAMS[stream][0]), stream), stream)


@dataclass
class Routed:
    """Messages of all channels, decoded once: the rows of each stream, rejects, errors and receipts derive from it.

    `tagged` has one row per message; persist it where several of these are wanted, as the landing of a
    micro-batch does."""

    tagged: DataFrame

    def rows(self, stream: str) -> DataFrame:
        """All rows of a stream with their reject reasons."""
        return _finished(self.tagged.where((F.col("stream") == stream) & F.col("error").isNull()).select(
            "msg_id", f"row.{stream}.*", "reject_reason"), stream)

    def errors(self) -> DataFrame:
        """Messages that cannot be parsed."""
        return self.tagged.where(F.col("error").isNotNull()).select("msg_id", "channel", "raw", F.col("ts_received").alias("ts"), "error")

    def rejects(self) -> DataFrame:
        """(stream, msg_id, symbol, ts_event, date, reject_reason) of every rejected row."""
        return self.tagged.where(F.col("reject_reason").isNotNull()).select(
            "stream", "msg_id", "symbol", "ts_event", F.to_date("ts_event").alias("date"), "reject_reason")

    def receipts(self, batch: str = "0") -> DataFrame:
        """Receipts of the accepted rows of all streams, in one aggregate (S3)."""
        ok = self.tagged.where(F.col("error").isNull() & F.col("reject_reason").isNull())
        return _receipts(ok.select("stream", "symbol", "ts_event", F.to_date("ts_event").alias("date")), batch)

    def counts(self) -> DataFrame:
        """(stream, accepted, rejected) of the parsed messages."""
        return self.tagged.where(F.col("error").isNull()).groupBy("stream").agg(
            F.count_if(F.col("reject_reason").isNull()).alias("accepted"), F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"))


def routed(messages: DataFrame) -> Routed:
    """Decode, route and judge every message in one pass."""
    d = decode(messages)
    at = {ch: s for s, (ch, _) in STREAMS.items()}
    stream = F.coalesce(*[F.when(F.col("channel") == ch, F.lit(s)) for ch, s in at.items()])
    row = F.struct(*[F.when((F.col("channel") == ch) & F.col("parse_error").isNull(), F.struct(*cols(F.col("m")[ch]))).alias(s)
                     for s, (ch, cols) in STREAMS.items()])
    d = d.select("msg_id", "channel", F.when(F.col("parse_error").isNotNull(), F.col("payload")).alias("raw"), "ts_received",
                 stream.alias("stream"), F.col("parse_error").alias("error"), _one_row(row, "row"))
    reasons = F.coalesce(*[F.when(F.col("row")[s].isNotNull(), _reasons(
        s, lambda c, s=s: F.col("row")[s][c], s == "quotes_l2")) for s in STREAMS])
    key = F.coalesce(*[F.col("row")[s]["index_code" if s == "index_values" else "symbol"] for s in STREAMS])
    when = F.coalesce(*[F.col("row")[s]["ts_event"] for s in STREAMS])
    return Routed(d.select("*", key.alias("symbol"), when.alias("ts_event"), _one_row(reasons, "reject_reason")))


def keyed_by_symbol(rows: DataFrame, stream: str) -> DataFrame:
    """Rows with a `symbol` column: index rows are named by their code."""
    return rows.withColumnRenamed("index_code", "symbol") if stream == "index_values" else rows


def _receipts(keyed: DataFrame, batch: str, root: str = "raw", schema_version: str = "1") -> DataFrame:
    file = F.concat_ws("/", F.lit(root), F.col("stream"), F.concat(F.lit("date="), F.col("date").cast("string")),
                       F.lit(f"batch={batch}"))
    return keyed.groupBy("stream", "date", "symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.min("ts_event").alias("min_ts"), F.max("ts_event").alias("max_ts")).select(
        file.alias("file"), "rows", "min_ts", "max_ts", F.lit(schema_version).alias("schema_version"), "stream", "date", "symbol")


def receipts(landed: DataFrame, stream: str, batch: str = "0", root: str = "raw", schema_version: str = "1") -> DataFrame:
    """One receipt per landed (date, symbol) of a batch (S3): file, rows, min_ts, max_ts,
    schema_version, stream, date, symbol.  The same columns are written, read (A9) and watched (J10, X6, M8)."""
    rows = keyed_by_symbol(landed, stream)
    if "date" not in rows.columns:
        rows = rows.withColumn("date", F.to_date("ts_event"))
    return _receipts(rows.select(F.lit(stream).alias("stream"), "date", "symbol", "ts_event"), batch, root, schema_version)
