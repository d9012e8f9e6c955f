"""The SQL counterpart of each query, for DuckDB over the same tables.

Types follow ``queries.plain``: measures as DOUBLE, whole numbers as BIGINT, timestamps without zone.
"""

from __future__ import annotations

from candlehouse.schemas import ASSET_TYPES, TIME_INTERVALS
from candlehouse.workload import tables as recipes


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def _symbol_id(asset_type: str, symbol: str, currency: str) -> str:
    text = f"{asset_type} || '|' || {symbol} || '|' || coalesce({currency}, '')"
    return f"cast('0x' || substr(md5({text}), 1, 15) as bigint)"


def _first(table: str, key: str, order: str = "src_id") -> str:
    return (f"select * exclude (rn) from (select *, row_number() over (partition by {key} order by {order}) as rn"
            f" from {table}) where rn = 1")


def _percent(start: str, end: str) -> str:
    return f"cast({end} - {start} as double) / nullif(cast({start} as double), 0) * 100"


def _change(open_: str, close: str) -> str:
    return f"case when {open_} > 0 then {_percent(open_, close)} else cast(0 as double) end"


def _mean(column: str) -> str:
    return f"cast(sum({column}) as double) / nullif(count({column}), 0)"


def _d(*columns: str) -> str:
    return ", ".join(f"cast({c} as double) as {c}" for c in columns)


OHLC = _d("open", "high", "low", "close")

_BASE = f"""
with asset_types(asset_type_id, asset_type_code, asset_type_name, description) as (values {_values(ASSET_TYPES)}),
intervals(interval_id, interval_code, interval_name, interval_minutes, description) as (values {_values(TIME_INTERVALS)}),
landed_stock as ({recipes.LANDED_STOCK.format(events="events")}),
landed_forex as ({recipes.LANDED_FOREX.format(orders="orders")}),
landed_crypto as ({recipes.LANDED_CRYPTO.format(lineitem="lineitem")}),
price_requests as ({recipes.PRICE_REQUESTS.format(orders="orders")}),
landed_news as (
  select doc_id as src_id, md5(text) as link,
         case when doc_id % 20 = 13 then chr(8195) else source || ' ' || doc_id end as title,
         date '2017-01-01' + cast(doc_id % 2830 as integer) as published_date,
         case doc_id % 10 when 0 then null when 1 then chr(160) || '  ' when 2 then ' ' || chr(9) else source end
           as description,
         text as content
  from documents),
raw_stock as ({_first("landed_stock", "symbol, interval_code, ts")}),
raw_forex as ({_first("landed_forex", "currency_pair, interval_code, ts")}),
raw_news as ({_first("landed_news", "link")}),
sent_news as ({_first("(select * from landed_news where src_id % 50 not in (7, 9))", "link")}),
t_stock as (select symbol, interval_code, ts, open, high, low, close, volume,
                   {_change("open", "close")} as price_change from raw_stock),
t_forex as (select currency_pair, interval_code, ts, open, high, low, close,
                   {_change("open", "close")} as price_change from raw_forex),
crypto_days as (
  select symbol, currency, date_trunc('day', ts) as ts, min(open) as open, max(high) as high, min(low) as low,
         max(close) as close, sum(volume_from) as volume_from, sum(volume_to) as volume_to,
         {_mean("high + low")} / 2 as avg_price
  from landed_crypto group by all),
t_crypto as (select *, {_percent("open", "close")} as price_change from crypto_days),
bars as (
  select 'STOCK' as asset_type_code, symbol as symbol_code, cast(null as varchar) as currency, interval_code, ts,
         open, high, low, close, volume, cast(null as double) as volume_from, cast(null as double) as volume_to,
         price_change, cast(null as double) as avg_price, 'transformed_stock_data' as source_table from t_stock
  union all
  select 'FOREX', currency_pair, null, interval_code, ts, open, high, low, close, null, null, null,
         price_change, null, 'transformed_forex_data' from t_forex
  union all
  select 'CRYPTO', symbol, currency, '1day', ts, open, high, low, close, null, cast(volume_from as double),
         cast(volume_to as double), price_change, avg_price, 'transformed_crypto_data' from t_crypto),
fact as (
  select {_symbol_id("asset_type_code", "symbol_code", "currency")} as symbol_id,
         cast(asset_type_id as bigint) as asset_type_id, cast(interval_id as bigint) as interval_id,
         asset_type_code, symbol_code, currency, interval_code, ts, open, high, low, close, volume, volume_from,
         volume_to, price_change, avg_price, source_table
  from bars join asset_types using (asset_type_code) join intervals using (interval_code)),
symbols as (
  select distinct {_symbol_id("asset_type_code", "symbol_code", "currency")} as symbol_id, symbol_code,
         cast(asset_type_id as bigint) as asset_type_id, symbol_code as symbol_name,
         cast(null as varchar) as exchange, currency, true as is_active
  from bars join asset_types using (asset_type_code)),
daily as (
  select symbol_id, symbol_code, asset_type_code, currency, interval_code, date_trunc('day', ts) as trading_day,
         count(*) as record_count, cast(min(open) as double) as day_open, cast(max(high) as double) as day_high,
         cast(min(low) as double) as day_low, cast(max(close) as double) as day_close,
         cast(sum(volume) as double) as total_volume, {_mean("close")} as avg_close_price,
         max(ts) as last_updated, min(low) as low_exact, max(high) as high_exact
  from fact group by symbol_id, symbol_code, asset_type_code, currency, interval_code, date_trunc('day', ts)),
hourly as (
  select symbol_id, symbol_code, asset_type_code, currency, interval_code, date_trunc('hour', ts) as trading_hour,
         count(*) as record_count, cast(arg_min(open, ts) as double) as hour_open,
         cast(max(high) as double) as hour_high, cast(min(low) as double) as hour_low,
         cast(arg_max(close, ts) as double) as hour_close, cast(sum(volume) as double) as total_volume,
         {_mean("close")} as avg_close_price, min(low) as low_exact, max(high) as high_exact
  from fact group by symbol_id, symbol_code, asset_type_code, currency, interval_code, date_trunc('hour', ts))
"""


def _volatility(high: str, low: str) -> str:
    return f"coalesce(case when {low} > 0 then {_percent(low, high)} else cast(0 as double) end, 0)"


def _rollup(grain: str, source: str = "fact") -> str:
    return f"""select symbol_id, asset_type_id, interval_id, date_trunc('{grain}', ts) as bucket,
       cast(arg_min(open, ts) as double) as open, cast(max(high) as double) as high,
       cast(min(low) as double) as low, cast(arg_max(close, ts) as double) as close,
       cast(sum(volume) as double) as volume, {_mean("close")} as avg_price, count(*) as record_count
from {source} group by symbol_id, asset_type_id, interval_id, date_trunc('{grain}', ts)"""


def _view(mart: str, bucket: str, prefix: str) -> str:
    return f"""select symbol_id, interval_code, {bucket} as bucket, coalesce(total_volume, 0) as total_volume,
       coalesce(total_volume / nullif(record_count, 0), 0) as avg_volume,
       coalesce(total_volume, 0) as max_volume, cast(0 as bigint) as min_volume,
       {prefix}_open as first_open, {prefix}_close as last_close, {prefix}_high as max_high,
       {prefix}_low as min_low, avg_close_price as avg_close,
       {_volatility("high_exact", "low_exact")} as volatility, record_count
from {mart}"""


def _refresh(grain: str, start: str, end: str) -> str:
    """Buckets without minute bars, except in the refreshed range."""
    as_of = "(select max(ts) from landed_stock)"
    low = f"(date_trunc('{grain}', {as_of} - interval {start} - interval 1 microsecond) + interval 1 {grain})"
    high = f"date_trunc('{grain}', {as_of} - interval {end})"
    inside = f"date_trunc('{grain}', ts) >= {low} and date_trunc('{grain}', ts) < {high}"
    return f"(select * from fact where interval_code <> '1min' or ({inside}))"


FACT = f"""symbol_id, asset_type_id, interval_id, ts, {OHLC}, cast(volume as bigint) as volume, volume_from, volume_to,
price_change, avg_price, source_table"""

_BAD_STOCK = "src_id % 100 in (7, 9)"
_STOCK_TIME = ("case when interval_code in ('1min', '1h') then date_trunc('second', ts) "
               "else date_trunc('day', ts) end")
_STOCK_TEXT = ("case when interval_code in ('1min', '1h') then strftime(ts, '%Y-%m-%d %H:%M:%S') "
               "else strftime(ts, '%Y-%m-%d') end")
_BAR_START = ("case interval_code when '1min' then date_trunc('minute', {t}) when '1h' then date_trunc('hour', {t}) "
              "else date_trunc('day', {t}) end")
_BAR_LENGTH = ("case interval_code when '1min' then interval 1 minute when '1h' then interval 1 hour "
               "else interval 1 day end")


def _bounds(time: str) -> str:
    start = _BAR_START.format(t=time)
    return (f"{start} as start_date_time, {start} + {_BAR_LENGTH} - interval 1 microsecond as end_date_time")


_INGEST_STOCK = f"""select symbol, interval_code, {_STOCK_TIME} as ts, {OHLC}, volume, {_bounds(_STOCK_TIME)}
from landed_stock where not ({_BAD_STOCK}) and interval_code <> '1week'"""

_PAGE = "src_id // 100"


def _pos(key: str) -> str:
    return f"row_number() over (partition by {key}, {_PAGE} order by src_id) - 1"


# Place in the page: lots are sorted by order, line and then the numbers themselves.
_CRYPTO_ORDER = ("l_orderkey, l_linenumber, ts, open, high, low, close, volume_from,"
                 " case when volume_from <> 13 then volume_to end nulls first")
_CRYPTO_POS = f"row_number() over (partition by symbol, currency, l_orderkey // 100 order by {_CRYPTO_ORDER}) - 1"
_NEWS_POS = "row_number() over (partition by src_id // 20 order by src_id) - 1"

# Raw tables as ingested: the first copy of each key that a page sent without fault.
_SENT_STOCK = f"""select symbol, interval_code, {_STOCK_TIME} as ts, {OHLC}, open as o, close as c, volume, {_bounds(_STOCK_TIME)}, src_id,
    not bool_or({_BAD_STOCK}) over (partition by symbol, interval_code, {_PAGE}) as page_ok
    from landed_stock where interval_code <> '1week'
    qualify not ({_BAD_STOCK}) and row_number() over (
      partition by symbol, interval_code, {_STOCK_TIME} order by ({_BAD_STOCK}), src_id) = 1"""
_DAY = "date_trunc('day', ts) as start_date_time, date_trunc('day', ts) + interval 1 day - interval 1 microsecond as end_date_time"
_SENT_FOREX = f"""select * exclude (n) from (select currency_pair, interval_code, date_trunc('day', ts) as ts, {OHLC}, open as o, close as c, {_DAY}, src_id,
    row_number() over (partition by currency_pair, interval_code, date_trunc('day', ts) order by src_id) as n
    from landed_forex where src_id % 50 not in (7, 9)) where n = 1"""
_SENT_CRYPTO = f"""select * exclude (n) from (select *, row_number() over (
    partition by symbol, currency, ts order by l_orderkey // 100, {_CRYPTO_ORDER}) as n
    from landed_crypto where volume_from <> 13) where n = 1"""

_LAST = "row_number() over (partition by {key} order by ts desc)"

_SPLIT_LOADED = {
    "crypto_done": "select distinct symbol, currency, ts from (select symbol, currency, date_trunc('day', ts) as ts"
                   " from landed_crypto where ts < timestamp '1998-01-01')",
}

_QUERIES = {
    "ingest_stock": _INGEST_STOCK,
    "ingest_forex": f"""select currency_pair, interval_code, date_trunc('day', ts) as ts, {OHLC},
        date_trunc('day', ts) as start_date_time,
        date_trunc('day', ts) + interval 1 day - interval 1 microsecond as end_date_time
        from landed_forex where src_id % 50 not in (7, 9)""",
    "ingest_crypto": f"""select symbol, currency, ts, {OHLC}, {_d("volume_from", "volume_to")}
        from landed_crypto where volume_from <> 13""",
    "ingest_news": """select link, title, published_date, description, content, false as transformed
        from landed_news where src_id % 50 not in (7, 9)""",
    "ingest_rejects": f"""
        select 'stock' as source, cast({_PAGE} as varchar) as page, {_pos("symbol, interval_code")} as pos, symbol,
               cast(null as varchar) as currency, interval_code, {_STOCK_TEXT} as source_time,
               case when interval_code = '1week' then 'unsupported interval'
                    when src_id % 100 = 7 then 'missing close' else 'bad close' end as reason, src_id as place
        from landed_stock qualify {_BAD_STOCK} or interval_code = '1week'
        union all
        select 'forex', cast({_PAGE} as varchar), {_pos("currency_pair, interval_code")}, currency_pair, null, interval_code,
               strftime(ts, '%Y-%m-%d'), case when src_id % 50 = 7 then 'missing open' else 'bad open' end, src_id
        from landed_forex qualify src_id % 50 in (7, 9)
        union all
        select 'crypto', cast(l_orderkey // 100 as varchar), {_CRYPTO_POS}, symbol, currency, null,
               cast(cast(epoch(ts) as bigint) as varchar), 'missing volumeto', l_orderkey
        from landed_crypto qualify volume_from = 13
        union all
        select 'news', cast(src_id // 20 as varchar), {_NEWS_POS}, case when src_id % 50 = 9 then null else link end, null, null,
               case when src_id % 50 = 7 then 'soon' else strftime(published_date, '%Y-%m-%d') end,
               case when src_id % 50 = 7 then 'bad published_date' else 'missing link' end, src_id
        from landed_news qualify src_id % 50 in (7, 9)""",
    "ingest_store": f"""select symbol, interval_code, ts, open, high, low, close, volume, start_date_time, end_date_time
        from ({_SENT_STOCK})""",
    "ingest_store_forex": f"""select currency_pair, interval_code, ts, open, high, low, close, start_date_time, end_date_time
        from ({_SENT_FOREX})""",
    "ingest_store_crypto": f"select symbol, currency, ts, {OHLC}, {_d('volume_from', 'volume_to')} from ({_SENT_CRYPTO})",
    "payload_history": f"""select symbol, interval_code, {_STOCK_TEXT} as date, {OHLC}, volume
        from landed_stock where not ({_BAD_STOCK})""",
    "price_history_crypto": f"""select symbol, currency, strftime(ts, '%Y-%m-%d') as date, {OHLC},
        {_d("volume_from", "volume_to")} from landed_crypto where volume_from <> 13""",
    "kline_bounds": f"select src_id, interval_code, ts, {_bounds('ts')} from landed_stock",
    "top_symbols": """select symbol, cast(sum(volume_to) as double) as total_volume from landed_crypto
        group by symbol order by sum(volume_to) desc, symbol limit 10""",
    "ranked_names": """select row_number() over (order by v desc, symbol) - 1 as pos, symbol from (
        select symbol, sum(volume_to) as v from landed_crypto group by symbol order by v desc, symbol limit 10)""",
    "backfill_top": f"""
        select 'STOCK' as asset_type_code, symbol, cast(null as varchar) as currency, interval_code, ts, {OHLC} from (
          select symbol, interval_code, {_STOCK_TIME} as ts, open, high, low, close, row_number() over (
            partition by symbol, interval_code, {_STOCK_TIME} order by src_id) as n
          from (select *, bool_or({_BAD_STOCK}) over (partition by symbol, interval_code, {_PAGE}) as refused from landed_stock)
          where not refused and interval_code <> '1week' and symbol in (
            select symbol from landed_stock group by symbol order by count(*) desc, symbol limit 10))
        where n = 1
        union all
        select 'FOREX', currency_pair, null, interval_code, ts, {OHLC} from (
          select currency_pair, interval_code, date_trunc('day', ts) as ts, open, high, low, close, row_number() over (
            partition by currency_pair, interval_code, date_trunc('day', ts) order by src_id) as n
          from (select *, bool_or(src_id % 50 in (7, 9)) over (partition by currency_pair, interval_code, {_PAGE}) as refused
                from landed_forex)
          where not refused and currency_pair in (
            select currency_pair from landed_forex group by currency_pair order by count(*) desc, currency_pair limit 10))
        where n = 1
        union all
        select 'CRYPTO', symbol, currency, null, ts, {OHLC} from ({_SENT_CRYPTO})
        where symbol in (
          select symbol from landed_crypto group by symbol order by sum(volume_to) desc, symbol limit 10)""",
    "insert_ignore_raw": f"select src_id, currency_pair, interval_code, ts, {OHLC} from raw_forex",
    "insert_ignore_stock": f"select src_id, symbol, interval_code, ts, {OHLC}, volume from raw_stock",
    "insert_ignore_bucketed": f"select src_id, symbol, interval_code, ts, {OHLC}, volume from raw_stock",
    "insert_ignore_crypto": f"""select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, symbol, currency,
        ts, {OHLC}, {_d("volume_from", "volume_to")}
        from (select *, row_number() over (partition by symbol, currency, ts order by l_orderkey, l_linenumber, open,
              high, low, close, volume_from, volume_to) as rn from landed_crypto) where rn = 1""",
    "transform_stock": f"select symbol, interval_code, ts, {OHLC}, volume, price_change from t_stock",
    "transform_forex": f"select currency_pair, interval_code, ts, {OHLC}, price_change from t_forex",
    "transform_crypto": f"""select symbol, currency, ts, {OHLC}, {_d("volume_from", "volume_to")}, avg_price,
        price_change from t_crypto""",
    "transform_crypto_pending": f"""select symbol, currency, ts, {OHLC}, {_d("volume_from", "volume_to")}, avg_price,
        price_change from t_crypto where not exists (select 1 from ({_SPLIT_LOADED["crypto_done"]}) d
        where d.symbol = t_crypto.symbol and d.currency = t_crypto.currency and d.ts = t_crypto.ts)""",
    "pending_keys": """select row_number() over (order by symbol, interval_code) as position, symbol, interval_code from (
        select distinct symbol, interval_code from landed_stock r where not exists (
          select 1 from landed_stock t where t.interval_code = '1day' and t.symbol = r.symbol
          and t.interval_code = r.interval_code and t.ts = r.ts)
        union all
        select distinct currency_pair, interval_code from landed_forex r where not exists (
          select 1 from landed_forex t where t.ts < timestamp '2000-01-01' and t.currency_pair = r.currency_pair
          and t.interval_code = r.interval_code and t.ts = r.ts))""",
    "dedup_news": "select src_id, link, title, published_date, description, content from raw_news",
    "news_link_counts": "select link, count(*) as articles from landed_news group by link",
    "transform_news": r"""select link, title, published_date, description, content from raw_news
        where regexp_matches(title, '[^\s\x0B\x1C-\x1F\p{Z}]')
          and regexp_matches(description, '[^\s\x0B\x1C-\x1F\p{Z}]')
          and regexp_matches(content, '[^\s\x0B\x1C-\x1F\p{Z}]')""",
    "dim_seed": """select cast(interval_id as bigint) as interval_id, interval_code, interval_name,
        cast(interval_minutes as bigint) as interval_minutes, count(src_id) as bars
        from intervals left join landed_stock using (interval_code) group by all""",
    "defaults_stored": "select * from symbols where asset_type_id <> (select asset_type_id from asset_types where asset_type_code = 'CRYPTO')",
    "stream_dedup_state": f"select src_id, symbol, interval_code, ts, {OHLC}, volume from raw_stock",
    "stream_cagg_late": _rollup("day", "(select * from fact where asset_type_code = 'STOCK')"),
    "stream_cagg_open": _rollup("day", "(select * from fact where asset_type_code <> 'CRYPTO')"),
    "dim_symbol_load": "select * from symbols",
    "fact_load_stock": f"select {FACT} from fact where asset_type_code = 'STOCK'",
    "fact_load_forex": f"select {FACT} from fact where asset_type_code = 'FOREX'",
    "fact_load_crypto": f"select {FACT} from fact where asset_type_code = 'CRYPTO'",
    "fact_union": f"select {FACT} from fact",
    "full_load": f"select {FACT} from fact",
    "load_selected": f"select {FACT} from fact where asset_type_code in ('STOCK', 'CRYPTO')",
    "incremental_load": f"select {FACT} from fact",
    "lookback": f"select {FACT} from fact where ts > (select max(ts) from landed_stock) - interval 24 hours",
    "load_report": """
        select cast(run as bigint) as run, 'full' as load_type, asset_type_code,
               case when run = 1 then n else 0 end as records_loaded,
               cast(case when run = 1 then total else 0 end as bigint) as total_records_loaded,
               strftime(earliest, '%Y-%m-%d %H:%M:%S') as earliest, strftime(latest, '%Y-%m-%d %H:%M:%S') as latest
        from (select asset_type_code, count(*) as n from fact group by asset_type_code),
             (select count(*) as total, min(ts) as earliest, max(ts) as latest from fact), (values (1), (2)) r(run)""",
    "refresh_marts": """
        select view_name, case when n is null then 'error' else 'refreshed' end as status, n as rows,
               cast(5 as bigint) as views_processed, cast(4 as bigint) as views_refreshed,
               cast(1 as bigint) as views_with_errors
        from (select 'mv_daily_ohlc_summary' as view_name, count(*) as n from daily
              union all select 'mv_hourly_ohlc_summary', count(*) from hourly
              union all select 'mv_asset_type_summary', count(distinct asset_type_id) from fact
              union all select 'mv_symbol_analytics', count(distinct symbol_id) from fact
              union all select 'mv_failing', null)""",
    "mv_daily": "select * exclude (low_exact, high_exact) from daily",
    "mv_hourly": "select * exclude (low_exact, high_exact) from hourly",
    "mv_asset_type": """select asset_type_code, asset_type_name, count(distinct symbol_id) as unique_symbols,
        count(*) as total_records, min(ts) as earliest_data, max(ts) as latest_data
        from fact join asset_types using (asset_type_code) group by asset_type_code, asset_type_name""",
    "mv_symbol": f"""select symbol_id, symbol_code, asset_type_code, currency, cast(null as varchar) as exchange,
        count(*) as total_records, min(ts) as first_record_date, max(ts) as last_record_date,
        {_mean("close")} as avg_price, round(stddev_samp(cast(close as double)), 4) as price_volatility,
        cast(min(low) as double) as all_time_low, cast(max(high) as double) as all_time_high,
        cast(sum(volume) as double) as total_volume_traded
        from fact group by symbol_id, symbol_code, asset_type_code, currency""",
    "ohlc_1day": _view("daily", "trading_day", "day"),
    "ohlc_1hour": _view("hourly", "trading_hour", "hour"),
    "ohlc_7day": f"""select symbol_id, interval_code, date_trunc('week', trading_day) as bucket,
        coalesce(sum(total_volume), 0) as total_volume, coalesce(avg(total_volume), 0) as avg_volume,
        coalesce(max(total_volume), 0) as max_volume, coalesce(min(total_volume), 0) as min_volume,
        min(day_open) as first_open, max(day_close) as last_close, max(day_high) as max_high, min(day_low) as min_low,
        round(avg(avg_close_price), 6) as avg_close, cast(sum(record_count) as bigint) as record_count,
        {_volatility("max(high_exact)", "min(low_exact)")} as volatility
        from daily group by symbol_id, interval_code, date_trunc('week', trading_day)""",
    "cagg_daily": _rollup("day"),
    "cagg_hourly": _rollup("hour"),
    "cagg_daily_refresh": _rollup("day", _refresh("day", "3 days", "1 hour")),
    "cagg_hourly_refresh": _rollup("hour", _refresh("hour", "1 day", "15 minutes")),
    "late_rows": f"""select symbol_id, asset_type_id, interval_id, bucket, actual_count,
        coalesce(stored_count, 0) as stored_count, actual_count - coalesce(stored_count, 0) as late_rows
        from (select symbol_id, asset_type_id, interval_id, bucket, record_count as actual_count
              from ({_rollup("day")})) a
        left join (select symbol_id, asset_type_id, interval_id, bucket, record_count as stored_count
              from ({_rollup("day", _refresh("day", "3 days", "1 hour"))})) b
        using (symbol_id, asset_type_id, interval_id, bucket)
        where actual_count > coalesce(stored_count, 0)""",
    "stream_dedup": f"select symbol, interval_code, ts, {OHLC}, volume from raw_stock",
    **{f"stream_cagg_{name}": f"""select * from ({_rollup(grain, "(select * from fact where asset_type_id = 1)")})
        where bucket + interval 1 {grain} <= (select max(ts) from fact where asset_type_id = 1) - interval 3 days"""
       for name, grain in (("daily", "day"), ("hourly", "hour"))},
    "price_history": f"""select * exclude (kind), count(*) over (partition by kind, symbol, currency) as count from (
        select kind, symbol, currency, interval_code, cast(30 as bigint) as days, {_LAST.format(key="kind, symbol, currency")} as rn,
               strftime(ts, '%Y-%m-%d %H:%M:%S') as date, {OHLC}, volume, {_d("volume_from", "volume_to")}
        from (select 1 as kind, symbol, cast(null as varchar) as currency, interval_code, ts, open, high, low, close, volume,
                     cast(null as double) as volume_from, cast(null as double) as volume_to from t_stock
              union all select 2, currency_pair, null, interval_code, ts, open, high, low, close, null, null, null from t_forex
              union all select 3, symbol, currency, '1day', ts, open, high, low, close, null, volume_from, volume_to from t_crypto)
        where interval_code = '1day') where rn <= 30""",
    "index_daily": f"""select symbol, interval_code, cast(100000 as bigint) as days,
        strftime(ts, '%Y-%m-%d %H:%M:%S') as date, {OHLC}, volume
        from (select * from t_stock where symbol = 'view' and interval_code = '1day' order by ts desc limit 100000)""",
    "price_by_date": """select r.symbol, r.currency, r.date, cast(c.close as double) as close
        from (select distinct symbol, currency, date, date + interval 1 day - interval 1 second as until
              from price_requests where symbol is not null and date is not null) r
        asof left join t_crypto c on r.symbol = c.symbol and r.currency = c.currency and r.until >= c.ts""",
    "warehouse_stats": """select coalesce(asset_type_code, 'ALL') as asset_type_code,
        cast(sum(n) as bigint) as record_count, cast(sum(active) as bigint) as active_symbols,
        min(lo) as earliest, max(hi) as latest
        from (select asset_type_code, count(*) as n, count(distinct symbol_id) as active, min(ts) as lo, max(ts) as hi
              from fact group by asset_type_code) group by rollup (asset_type_code)""",
    "date_range": """select strftime(min(ts), '%Y-%m-%d %H:%M:%S') as earliest,
        strftime(max(ts), '%Y-%m-%d %H:%M:%S') as latest from fact""",
}
_QUERIES["transform_store_stock"] = _QUERIES["transform_stock"]
_QUERIES["transform_store_crypto"] = _QUERIES["transform_crypto"]
_QUERIES["incremental_symbol"] = _QUERIES["mv_symbol"]
_QUERIES["incremental_daily"] = _QUERIES["mv_daily"]
_QUERIES["news_all"] = _QUERIES["transform_news"].replace("raw_news", "sent_news")
_QUERIES["transform_store_forex"] = _QUERIES["transform_forex"]
_QUERIES["refresh_after_gap"] = _QUERIES["mv_daily"]
_QUERIES["stream_transform_crypto"] = _QUERIES["transform_crypto"]
_QUERIES["stream_full_load"] = _QUERIES["full_load"]
_QUERIES["stream_ingest"] = _QUERIES["ingest_store"]
_QUERIES["stream_ingest_rejects"] = f"select * exclude (place) from ({_QUERIES['ingest_rejects']}) where source = 'stock'"
_QUERIES["ingest_rejects"] = f"select * exclude (place) from ({_QUERIES['ingest_rejects']})"


def _ranged(rows: str, start: str, end: str) -> str:
    """Good rows of the range, and all rejects; a refused or malformed page has one at place 0 without time and prices."""
    return (f"select page, pos, symbol, ts, {OHLC}, reason from ({rows}) where reason is not null"
            f" or (ts >= timestamp '{start}' and ts < timestamp '{end}' + interval 1 day)")


def _paged(source: str, key: str, symbol: str, time: str, bad: str, unsupported: str) -> str:
    return f"""
      select {_PAGE} as page, {_pos(key)} as pos, {symbol} as symbol, {time} as ts, open, high, low, close,
             case when {unsupported} then 'unsupported interval' end as reason
      from (select *, bool_or({bad}) over (partition by {key}, {_PAGE}) as refused from {source}) where not refused
      union all
      select distinct {_PAGE}, 0, {symbol}, cast(null as timestamp), null, null, null, null, 'page with a bad row'
      from (select *, bool_or({bad}) over (partition by {key}, {_PAGE}) as refused from {source}) where refused"""


_QUERIES["ingest_range"] = _ranged(
    _paged("landed_stock", "symbol, interval_code", "symbol", _STOCK_TIME, _BAD_STOCK, "interval_code = '1week'"),
    "2024-01-10", "2024-01-19")
# Two keys of one symbol may have refused pages of the same number: distinct must not merge them.
_QUERIES["ingest_range"] = _QUERIES["ingest_range"].replace(
    "select distinct src_id // 100, 0, symbol", "select distinct on (symbol, interval_code, src_id // 100) src_id // 100, 0, symbol")
_QUERIES["ingest_range_forex"] = _ranged(
    _paged("landed_forex", "currency_pair, interval_code", "currency_pair", "date_trunc('day', ts)", "src_id % 50 in (7, 9)", "false"),
    "1996-01-01", "1997-12-31")
_QUERIES["ingest_range_crypto"] = _ranged(f"""
      select l_orderkey // 100 as page, {_CRYPTO_POS} as pos, symbol, ts, open, high, low, close,
             case when volume_from = 13 then 'missing volumeto' end as reason from landed_crypto""", "1996-01-01", "1997-12-31")
_SENT_DAYS = f"""
    select symbol, currency, date_trunc('day', ts) as ts, min(open) as open, max(high) as high, min(low) as low, max(close) as close,
             sum(volume_from) as volume_from, sum(volume_to) as volume_to, {_mean("high + low")} / 2 as avg_price
      from landed_crypto where volume_from <> 13 group by all"""
_LOADED = f"""
    select {_symbol_id("'STOCK'", "symbol", "null")} as symbol_id, cast(1 as bigint) as asset_type_id,
      cast(interval_id as bigint) as interval_id, ts, {OHLC}, volume, cast(null as double) as volume_from,
      cast(null as double) as volume_to, {_change("o", "c")} as price_change, cast(null as double) as avg_price,
      'transformed_stock_data' as source_table
    from ({_SENT_STOCK}) join intervals using (interval_code)
    union all
    select {_symbol_id("'FOREX'", "currency_pair", "null")}, 2, interval_id, ts, {OHLC}, null, null, null,
      {_change("o", "c")}, null, 'transformed_forex_data'
    from ({_SENT_FOREX}) join intervals using (interval_code)
    union all
    select {_symbol_id("'CRYPTO'", "symbol", "currency")}, 3, 6, ts, {OHLC}, null, cast(volume_from as double), cast(volume_to as double),
      {_percent("open", "close")}, avg_price, 'transformed_crypto_data'
    from ({_SENT_DAYS})"""
_QUERIES["load_by_type"] = _LOADED

ORACLE: dict[str, str] = {name: f"{_BASE}{text}" for name, text in _QUERIES.items()}
