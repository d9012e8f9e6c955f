"""Landed API payloads to typed rows.

Each parser returns every row it finds, with a ``reason`` that is NULL for good rows, so a job can
write good rows and rejects from one parse (``valid`` / ``rejects``). A payload is one API page, whose
size the API bounds, so exploding it inside a task is safe.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlehouse.functions import columns as C
from candlehouse.functions.arguments import range_bounds
from candlehouse.schemas import DAILY, INTERVAL_CODES, MAX_SYMBOL_LENGTH

_PRICES = ["open", "high", "low", "close"]

# Payload shapes. Every leaf is text: a bad number must reach the reject table, not vanish.
_SERIES_SCHEMA = (
    "values array<struct<datetime:string,open:string,high:string,low:string,close:string,volume:string>>,"
    "_corrupt_record string"
)
_CRYPTO_SCHEMA = (
    "Data struct<Data:array<struct<time:string,open:string,high:string,low:string,close:string,"
    "volumefrom:string,volumeto:string>>>, _corrupt_record string"
)
_NEWS_SCHEMA = (
    "rows array<struct<row:struct<title:string,published_date:string,description:string,content:string,"
    "link:string,top_image:string,authors:string,section:string>>>, _corrupt_record string"
)
_RANKING_SCHEMA = "Data array<struct<CoinInfo:struct<Name:string>>>, _corrupt_record string"

MALFORMED = "malformed payload"
REFUSED = "page with a bad row"


def read_landed(spark: SparkSession, path: str, keys: list[str], numbered_lines: bool = False) -> DataFrame:
    """Landed payloads below ``key=value`` directories, one per file, or one per line as ``number<TAB>payload``.

    Which of two equal bars came first is told by ``page``: a key directory of that name, the number of the line, or
    else the file's name. Lines must carry a number, since Spark reads a file's lines in no certain order.
    """
    return _landed(spark.read.schema(_landed_schema(keys)).text(path, wholetext=not numbered_lines), keys, numbered_lines)


def stream_landed(
    spark: SparkSession, path: str, keys: list[str], numbered_lines: bool = False, files_per_batch: int | None = 1000
) -> DataFrame:
    """The same as a stream of the files that land below ``path``; without ``files_per_batch`` a batch takes all that are there."""
    reader = spark.readStream.schema(_landed_schema(keys))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _landed(reader.text(path, wholetext=not numbered_lines), keys, numbered_lines)


def _landed_schema(keys: list[str]) -> str:
    return ", ".join(f"{c} {'bigint' if c == 'page' else 'string'}" for c in ["value", *keys])


def _landed(texts: DataFrame, keys: list[str], numbered_lines: bool) -> DataFrame:
    value, page = F.col("value"), [] if "page" in keys else [F.col("_metadata.file_path").alias("page")]
    if numbered_lines:
        cut = F.instr(value, "\t")
        page = [F.substring(value, F.lit(1), cut - 1).try_cast("bigint").alias("page")]
        value = F.substring(value, cut + 1, F.length(value))
    return texts.select(*[k for k in keys if not (numbered_lines and k == "page")], *page, value.alias("payload"))


def _decode(payloads: DataFrame, schema: str) -> DataFrame:
    keep = [c for c in payloads.columns if c != "payload"]
    return payloads.select(*keep, F.from_json("payload", schema).alias("_doc"))


def _explode(decoded: DataFrame, array: str, is_bad: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per array entry; a malformed payload gives one row without entry, an empty one none.

    With ``is_bad``, an array that holds any bad entry gives one row without entry, marked ``_refused``. The test
    runs on the array, so a page is judged as a whole without grouping its rows again.
    """
    keep = [c for c in decoded.columns if c != "_doc"]
    broken = F.col("_doc._corrupt_record").isNotNull()
    refused = F.coalesce(F.exists(array, is_bad), F.lit(False)) if is_bad is not None else F.lit(False)
    entries = F.when(broken | refused, F.array(F.lit(None))).otherwise(F.col(array))
    return decoded.select(
        *keep, broken.alias("_broken"), refused.alias("_refused"), F.posexplode(entries).alias("pos", "entry"))


def _arrival(payloads: DataFrame) -> list[str]:
    """Columns that tell which of two equal bars came first: the page, if known, and the place in it."""
    return [c for c in ("page",) if c in payloads.columns] + ["pos"]


def _first_problem(checks: list[tuple[str, Column, Column]], *more: Column) -> Column:
    """Reason text of the first field that is missing or does not parse."""
    found = [F.when(F.col("_broken"), F.lit(MALFORMED)), F.when(F.col("_refused"), F.lit(REFUSED)), *more]
    for name, raw, parsed in checks:
        found.append(F.when(raw.isNull(), F.lit(f"missing {name}")).when(parsed.isNull(), F.lit(f"bad {name}")))
    return F.coalesce(*found)


def _bad_key(column: str, longest: int) -> Column:
    return (F.when(F.col(column).isNull(), F.lit(f"missing {column}"))
            .when(F.length(column) > longest, F.lit(f"{column} too long")))


def _series_fields(entry: Column, interval_code: Column, with_volume: bool) -> dict[str, Column]:
    fields = {"ts": C.parse_bar_time(entry["datetime"], interval_code)}
    fields |= {name: C.parse_price(entry[name]) for name in _PRICES}
    return fields | ({"volume": C.parse_whole(entry["volume"])} if with_volume else {})


def _parse_series(payloads: DataFrame, symbol: str, with_volume: bool, whole_pages: bool, longest: int) -> DataFrame:
    interval = F.col("interval_code")

    def is_bad(entry: Column) -> Column:
        return reduce(or_, [c.isNull() for c in _series_fields(entry, interval, with_volume).values()])

    payloads = payloads.withColumn("interval_code", F.coalesce("interval_code", F.lit(DAILY)))
    decoded = _decode(payloads, _SERIES_SCHEMA)
    rows = _explode(decoded, "_doc.values", is_bad if whole_pages else None)
    parsed = _series_fields(F.col("entry"), interval, with_volume)
    rows = rows.withColumns(parsed)
    checks = [("datetime", F.col("entry.datetime"), F.col("ts"))]
    checks += [(name, F.col(f"entry.{name}"), F.col(name)) for name in parsed if name != "ts"]
    unsupported = F.when(~interval.isin(INTERVAL_CODES), F.lit("unsupported interval"))
    return rows.select(
        *_arrival(payloads), symbol, "interval_code", F.col("entry.datetime").alias("source_time"), *parsed,
        C.bar_start(F.col("ts"), interval).alias("start_date_time"),
        C.bar_end(F.col("ts"), interval).alias("end_date_time"),
        _first_problem(checks, _bad_key(symbol, longest), unsupported).alias("reason"),
    )


def parse_stock(payloads: DataFrame, whole_pages: bool = False, longest: int = MAX_SYMBOL_LENGTH) -> DataFrame:
    """Stock time series: (symbol, interval_code, payload) to bars with volume.

    ``whole_pages`` is the rule of the date-range backfill: a page with any bad bar is refused, with one reject.
    ``longest`` is the length of a symbol that the raw table allows; longer ones are rejected.
    """
    return _parse_series(payloads, "symbol", with_volume=True, whole_pages=whole_pages, longest=longest)


def parse_forex(payloads: DataFrame, whole_pages: bool = False, longest: int = MAX_SYMBOL_LENGTH) -> DataFrame:
    """Forex time series: (currency_pair, interval_code, payload) to bars."""
    return _parse_series(payloads, "currency_pair", with_volume=False, whole_pages=whole_pages, longest=longest)


def parse_crypto(payloads: DataFrame, longest: int = MAX_SYMBOL_LENGTH) -> DataFrame:
    """Crypto history: (symbol, currency, payload) to bars; time is in epoch seconds. Good rows of a page are always kept."""
    rows = _explode(_decode(payloads, _CRYPTO_SCHEMA), "_doc.Data.Data")
    seconds = C.parse_whole(F.col("entry.time"))
    parsed = {"ts": F.timestamp_seconds(seconds)}
    parsed |= {name: C.parse_price(F.col(f"entry.{name}")) for name in _PRICES}
    parsed |= {"volume_from": C.parse_price(F.col("entry.volumefrom")),
               "volume_to": C.parse_price(F.col("entry.volumeto"))}
    rows = rows.withColumns(parsed)
    fields = {"ts": "time", "volume_from": "volumefrom", "volume_to": "volumeto"}
    checks = [(fields.get(c, c), F.col(f"entry.{fields.get(c, c)}"), F.col(c)) for c in parsed]
    return rows.select(
        *_arrival(payloads), "symbol", "currency", F.col("entry.time").alias("source_time"), *parsed,
        _first_problem(checks, _bad_key("symbol", longest), _bad_key("currency", longest)).alias("reason"),
    )


def parse_news(payloads: DataFrame) -> DataFrame:
    """News pages: (payload) to raw articles. A JSON null description is a missing one."""
    rows = _explode(_decode(payloads, _NEWS_SCHEMA), "_doc.rows")
    row = "entry.row"
    published = F.try_to_timestamp(F.col(f"{row}.published_date"), F.lit("yyyy-MM-dd")).cast("date")
    link = F.col(f"{row}.link")
    rows = rows.withColumns({"published_date": published, "link": link})
    checks = [
        ("published_date", F.col(f"{row}.published_date"), F.col("published_date")),
        ("link", link, link),
    ]
    return rows.select(
        *_arrival(payloads), F.coalesce(F.col(f"{row}.title"), F.lit("")).alias("title"), "published_date",
        F.col(f"{row}.description").alias("description"),
        F.coalesce(F.col(f"{row}.content"), F.lit("")).alias("content"), "link",
        F.col(f"{row}.top_image").alias("top_image"), F.col(f"{row}.authors").alias("authors"),
        F.col(f"{row}.section").alias("section"), F.lit(False).alias("transformed"),
        F.col(f"{row}.published_date").alias("source_time"),
        _first_problem(checks).alias("reason"),
    )


def valid(parsed: DataFrame) -> DataFrame:
    """Good rows, with the arrival columns ``page`` and ``pos`` still on them."""
    return parsed.filter("reason IS NULL").drop("reason", "source_time")


def rejects(parsed: DataFrame, source: str) -> DataFrame:
    """Rows that could not be stored, bars or articles: where they came from (source, page, place in it), what names
    them, their time as it was sent, and the reason."""
    def text(*names: str) -> Column:
        there = [F.col(n).cast("string") for n in names if n in parsed.columns]
        return F.coalesce(*there, F.lit(None).cast("string"))

    return parsed.filter("reason IS NOT NULL").select(
        F.lit(source).alias("source"), text("page").alias("page"), "pos", text("symbol", "currency_pair", "link").alias("symbol"),
        text("currency").alias("currency"), text("interval_code").alias("interval_code"), "source_time", "reason",
    )


def in_date_range(bars: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Bars from the first to the last day, both included."""
    low, high = range_bounds(start, end)
    return bars.filter((F.col("ts") >= C.utc(low)) & (F.col("ts") < C.utc(high)))


def price_points(payloads: DataFrame, include_volume: bool = False) -> DataFrame:
    """Chart points of a payload in source order; incomplete points are skipped.

    ``volume`` is set only when asked for and present.
    """
    rows = _explode(_decode(payloads, _SERIES_SCHEMA), "_doc.values")
    keep = [c for c in rows.columns if c not in ("_broken", "_refused", "entry")]
    points = rows.select(
        *keep, F.col("entry.datetime").alias("date"),
        *[F.col(f"entry.{name}").try_cast("double").alias(name) for name in _PRICES],
        (C.parse_whole(F.col("entry.volume")) if include_volume else F.lit(None).cast("bigint")).alias("volume"),
    )
    return points.dropna(subset=["date", *_PRICES])


def crypto_price_points(payloads: DataFrame) -> DataFrame:
    """Chart points of a crypto payload: UTC date, prices and both volumes."""
    rows = _explode(_decode(payloads, _CRYPTO_SCHEMA), "_doc.Data.Data")
    keep = [c for c in rows.columns if c not in ("_broken", "_refused", "entry")]
    seconds = C.parse_whole(F.col("entry.time"))
    numbers = {"open": "open", "high": "high", "low": "low", "close": "close",
               "volume_from": "volumefrom", "volume_to": "volumeto"}
    points = rows.select(
        *keep, F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd").alias("date"),
        *[F.col(f"entry.{field}").try_cast("double").alias(name) for name, field in numbers.items()],
    )
    return points.dropna(subset=["date", *numbers])


def ranked_names(payloads: DataFrame) -> DataFrame:
    """Symbols of a ranking payload, in rank order within the payload."""
    rows = _explode(_decode(payloads, _RANKING_SCHEMA), "_doc.Data")
    return rows.filter("NOT _broken").select("pos", F.col("entry.CoinInfo.Name").alias("symbol"))
