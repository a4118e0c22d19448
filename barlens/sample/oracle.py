"""DuckDB SQL that must give the same rows as the queries of the same name."""

from __future__ import annotations


def _bars(price: str = "floor(l_extendedprice * 64) / 64") -> str:
    rank = "row(l_orderkey, l_linenumber, l_extendedprice)"
    return f"""
    lines AS (SELECT *, {price} AS p FROM lineitem),
    bars AS (
      SELECT CAST(l_suppkey AS VARCHAR) AS ticker, any_value(s_name) AS company, l_shipdate AS "time",
             arg_min(p, {rank}) AS "Open", max(p) AS "High", min(p) AS "Low",
             arg_max(p, {rank}) AS "Close", sum(l_quantity) AS "Volume"
      FROM lines JOIN supplier ON l_suppkey = s_suppkey
      GROUP BY l_suppkey, l_shipdate)"""


BARS = _bars()
SMOOTH = _bars("1024 + floor(l_extendedprice / 1000 * 64) / 64")

LINE_BARS = """
    bars AS (
      SELECT CASE WHEN l_suppkey % 3 = 0 THEN 'HOT' ELSE CAST(l_suppkey AS VARCHAR) END AS ticker,
             l_shipdate + to_seconds(l_orderkey % 86400) AS "time",
             floor(l_extendedprice * 64) / 64 AS "Close", l_quantity AS "Volume",
             l_orderkey, l_linenumber, l_extendedprice, l_partkey
      FROM lineitem)"""


def _features(order: str = '"time"') -> str:
    w = f"PARTITION BY ticker ORDER BY {order}"
    past = f"{w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

    def average(column: str, rows: int) -> str:
        return f"avg({column}) OVER ({w} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"

    def change(lag: int) -> str:
        base = f'lag("Close", {lag}) OVER ({w})'
        return f'("Close" - {base}) / nullif({base}, 0)'

    return f"""
    f1 AS (
      SELECT *, strftime("time", '%Y-%m') AS month,
             {average('"Close"', 50)} AS ma50, {average('"Close"', 100)} AS ma100,
             {average('"Close"', 200)} AS ma200,
             {change(1)} AS daily_return, {change(30)} AS return_30d, {change(90)} AS return_90d,
             "Close" / nullif(first_value("Close") OVER ({past}), 0) - 1 AS cumulative_return,
             max("Close") OVER ({past}) AS peak,
             {average('"Volume"', 20)} AS volume_ma20
      FROM bars),
    f2 AS (
      SELECT *, CASE WHEN ma50 > ma200 THEN 'up' WHEN ma50 < ma200 THEN 'down' ELSE 'sideway' END AS trend,
             (ma50 - ma200) / nullif("Close", 0) AS trend_strength,
             ("Close" - peak) / nullif(peak, 0) AS drawdown,
             "Volume" / nullif(volume_ma20, 0) AS volume_ratio
      FROM f1),
    f3 AS (
      SELECT *, min(drawdown) OVER (PARTITION BY ticker) AS max_drawdown,
             stddev_samp(daily_return) OVER (PARTITION BY ticker, month) AS vol
      FROM f2),
    features AS (
      SELECT *, round(vol, 9) AS monthly_volatility,
             CASE WHEN ma50 > ma200 AND vol < 0.02 THEN 'bull'
                  WHEN ma50 < ma200 AND vol > 0.03 THEN 'bear'
                  WHEN vol > 0.05 THEN 'high_vol' ELSE 'normal' END AS market_regime
      FROM f3)"""


FEATURES = f"{BARS}, {_features()}"

FEATURE_COLUMNS = """ma50, ma100, ma200, trend, trend_strength, daily_return, cumulative_return,
    return_30d, return_90d, drawdown, max_drawdown, volume_ma20, volume_ratio, monthly_volatility,
    market_regime"""

# Damaged messages: the day of the year modulo 11 says how (see inputs.messages_from_bars).
MESSAGES = f"""{BARS},
    messages AS (
      SELECT ticker AS key, "time" AS bar_time, dayofyear("time") % 11 AS kind,
             strftime("time", '%Y-%m-%d %H:%M:%S') AS stamp,
             epoch_ms("time") + dayofyear("time") * 60000 AS envelope_ms, *
      FROM bars)"""

TICKS = """
    ticks AS (
      SELECT event_id, event_type AS ticker, ts, 5000.0::DOUBLE + floor("value" * 64) / 64 AS p FROM events)"""

METRICS = f"""{TICKS},
    docs AS (
      SELECT date_trunc('minute', ts) AS "@timestamp", date_trunc('minute', ts) AS window_start,
             date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, ticker, ticker AS company,
             avg(p) AS avg_price, min(p) AS min_price, max(p) AS max_price,
             CAST(count(*) AS DOUBLE) AS total_volume, count(*) AS trade_count,
             round(stddev_samp(p), 6) AS price_volatility, max(ts) AS source_time,
             ticker || '_' || strftime(date_trunc('minute', ts), '%Y%m%d%H%M') AS doc_id
      FROM ticks GROUP BY ticker, date_trunc('minute', ts))"""

OHLCV = f"""{TICKS},
    per_instant AS (
      SELECT ticker, date_trunc('hour', ts) AS w, ts, min(p) AS lo, max(p) AS hi, count(*) AS n
      FROM ticks GROUP BY ALL),
    windows AS (
      SELECT ticker, w AS "@timestamp", w AS window_start, w + INTERVAL 1 HOUR AS window_end,
             arg_min(lo, ts) AS open_1m, arg_max(hi, ts) AS close_1m, max(hi) AS high_1m,
             min(lo) AS low_1m, CAST(sum(n) AS DOUBLE) AS volume_sum_1m, max(ts) AS source_time
      FROM per_instant GROUP BY ticker, w)"""

ALERTS = f"""{OHLCV},
    moves AS (
      SELECT *, (close_1m - open_1m) / open_1m AS return_pct_1m, (high_1m - low_1m) / open_1m AS range_pct_1m
      FROM windows WHERE open_1m > 0),
    reasons AS (
      SELECT *, CASE WHEN abs(return_pct_1m) >= 0.01 THEN 'return_pct'
                     WHEN range_pct_1m >= 0.015 THEN 'range_pct' END AS alert_reason,
             CASE WHEN return_pct_1m >= 0 THEN 'up' ELSE 'down' END AS direction
      FROM moves),
    alerts AS (
      SELECT *, CASE WHEN alert_reason = 'return_pct' THEN abs(return_pct_1m) ELSE range_pct_1m END AS alert_score,
             ticker || '_' || strftime(window_start, '%Y%m%d%H%M') || '_' || alert_reason || '_' || direction AS doc_id
      FROM reasons WHERE alert_reason IS NOT NULL)"""

CLOSED = "window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE"

ARCHIVE = f"""{BARS},
    days AS (
      SELECT strftime("time", '%Y-%m-%d') AS date, ticker, strftime("time", '%Y-%m-%d %H:%M:%S') AS "time",
             "Close", "Volume", dayofyear("time") AS d FROM bars),
    stored AS (SELECT date, ticker, "time", "Close", "Volume" FROM days WHERE d % 3 <> 0),
    fresh AS (SELECT date, ticker, "time", "Close" + 1 AS "Close", "Volume", d FROM days WHERE d % 3 = 0)"""

ARCHIVE_RESULT = """
    SELECT * FROM stored
    UNION ALL SELECT date, ticker, "time", "Close", "Volume" FROM fresh
    UNION ALL SELECT date, ticker, "time", "Close", "Volume" FROM fresh WHERE d % 5 = 0"""

COMPLETE_DOCUMENTS = """
    SELECT ticker || '_' || strftime("time", '%Y%m%d%H%M%S') AS doc_id, ticker, company, month, "time",
           return_90d, market_regime
    FROM features WHERE return_90d IS NOT NULL AND return_30d IS NOT NULL AND vol IS NOT NULL
         AND volume_ratio IS NOT NULL AND trend_strength IS NOT NULL"""

TREND = 'SELECT ticker, "time", ma50, ma100, ma200 FROM features'
VOLATILITY_PER_BAR = 'SELECT ticker, month, "time", "Close", monthly_volatility FROM features'

_ORDER_TEXT = """
    texts AS (SELECT o_orderkey, o_orderkey % 8 AS way, date_trunc('day', o_orderdate) AS d FROM orders)"""

ORACLE = {
    "bars_daily": f'WITH {BARS} SELECT * FROM bars',
    "moving_averages": f"WITH {FEATURES} {TREND}",
    "moving_averages_frame": f"WITH {FEATURES} {TREND}",
    "moving_averages_prefix": f"WITH {FEATURES} {TREND}",
    "trend": f'WITH {FEATURES} SELECT ticker, "time", trend, trend_strength FROM features',
    "returns": f"""WITH {FEATURES}
        SELECT ticker, "time", daily_return, return_30d, return_90d, cumulative_return FROM features""",
    "drawdown": f'WITH {FEATURES} SELECT ticker, "time", drawdown, max_drawdown FROM features',
    "volume_profile": f'WITH {FEATURES} SELECT ticker, "time", "Volume", volume_ma20, volume_ratio FROM features',
    "monthly_returns": f"""WITH {BARS}, ends AS (
          SELECT ticker, strftime("time", '%Y-%m') AS month, arg_min("Close", "time") AS a, arg_max("Close", "time") AS b
          FROM bars GROUP BY ALL)
        SELECT ticker, month, (b - a) / nullif(a, 0) AS monthly_return FROM ends""",
    "monthly_volatility": f"""WITH {FEATURES}
        SELECT ticker, month, round(stddev_samp(daily_return), 9) AS monthly_volatility
        FROM features GROUP BY ticker, month""",
    "volatility_join": f"WITH {FEATURES} {VOLATILITY_PER_BAR}",
    "volatility_window": f"WITH {FEATURES} {VOLATILITY_PER_BAR}",
    "market_regime": f'WITH {SMOOTH}, {_features()} SELECT ticker, "time", market_regime FROM features',
    "feature_table_all": f"""WITH {FEATURES}
        SELECT ticker, month, "time", "Open", "High", "Low", "Close", "Volume", {FEATURE_COLUMNS} FROM features""",
    "feature_table_hot_key": f"""WITH {LINE_BARS},
        {_features('"time", l_orderkey, l_linenumber, l_extendedprice, l_partkey')}
        SELECT ticker, month, "time", "Close", "Volume", l_orderkey, l_linenumber, l_extendedprice,
               l_partkey, {FEATURE_COLUMNS} FROM features""",
    "feature_documents_complete": f"WITH {FEATURES} {COMPLETE_DOCUMENTS}",
    "feature_documents_published": f"WITH {FEATURES} {COMPLETE_DOCUMENTS}",
    "cast_to_float": f"""WITH {BARS}
        SELECT ticker, "time", CAST(CAST("Open" AS FLOAT) AS DOUBLE) AS "Open",
               CAST(CAST("High" AS FLOAT) AS DOUBLE) AS "High", CAST(CAST("Low" AS FLOAT) AS DOUBLE) AS "Low",
               CAST(CAST("Close" AS FLOAT) AS DOUBLE) AS "Close",
               CAST(CAST("Volume" AS FLOAT) AS DOUBLE) AS "Volume" FROM bars""",
    "latest_bar": f"""WITH {BARS}
        SELECT ticker, "time", "Open", "High", "Low", "Close", "Volume" FROM bars
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY "time" DESC) = 1""",
    "range_and_tickers": f"""WITH {BARS}
        SELECT ticker, "time", "Open", "High", "Low", "Close", "Volume" FROM bars
        WHERE ticker IN ('1', '2', '3', '5', '8') AND "time" < TIMESTAMP '1999-01-01'
              AND "time" >= TIMESTAMP '1999-01-01' - INTERVAL 730 DAY""",
    "union_tickers": f"""WITH {BARS}
        SELECT ticker, "time", "Open", "High", "Low", "Close",
               CASE WHEN CAST(ticker AS BIGINT) % 3 <> 1 THEN "Volume" END AS "Volume" FROM bars""",
    "decode_messages": f"""WITH {MESSAGES}
        SELECT key, bar_time,
               CASE WHEN kind NOT IN (2, 4) THEN ticker END AS ticker,
               CASE WHEN kind NOT IN (2, 6) THEN company END AS company,
               CASE WHEN kind = 3 THEN '' WHEN kind <> 2 THEN stamp END AS "time",
               CASE WHEN kind NOT IN (1, 2) THEN "Open" END AS "Open",
               CASE WHEN kind <> 2 THEN "High" END AS "High",
               CASE WHEN kind <> 2 THEN "Low" END AS "Low",
               CASE WHEN kind NOT IN (2, 5) THEN "Close" END AS "Close",
               CASE WHEN kind NOT IN (2, 7) THEN "Volume" + 0.5 END AS "Volume" FROM messages""",
    "message_round_trip": f"""WITH {BARS}
        SELECT ticker AS key, ticker, company, strftime("time", '%Y-%m-%d %H:%M:%S') AS "time",
               "Open", "High", "Low", "Close", "Volume" FROM bars""",
    "parse_times": f"""WITH {_ORDER_TEXT}
        SELECT o_orderkey,
               CASE way WHEN 0 THEN d + INTERVAL '14 hours 30 minutes' WHEN 1 THEN d + INTERVAL '9 hours 30 minutes'
                        WHEN 2 THEN d WHEN 3 THEN d + INTERVAL '21 hours 15 minutes'
                        WHEN 4 THEN d + INTERVAL '9 hours 30 minutes' WHEN 5 THEN d + INTERVAL '22 hours'
                        END AS source_time,
               CASE way WHEN 2 THEN d WHEN 4 THEN d + INTERVAL '9 hours 30 minutes' END AS bound,
               CASE WHEN way < 6 THEN strftime(d, '%Y-%m-%d') END AS archive_date
        FROM texts""",
    "missing_fields": f"""WITH {MESSAGES}
        SELECT key, bar_time,
               CASE kind WHEN 1 THEN 'Open' WHEN 2 THEN 'ticker,time,Open,High,Low,Close,Volume'
                         WHEN 4 THEN 'ticker' WHEN 7 THEN 'Volume' ELSE '' END AS missing,
               CASE WHEN kind IN (1, 2, 4, 7) THEN 0 ELSE 1 END::BIGINT AS is_valid FROM messages""",
    "standardised": f"""WITH {MESSAGES}
        SELECT key, bar_time, CASE WHEN kind = 4 THEN '' ELSE ticker END AS ticker,
               CASE WHEN kind <> 6 THEN company END AS company,
               CASE WHEN kind = 3 THEN '' ELSE stamp END AS "time",
               CASE WHEN kind = 1 THEN 0.0 ELSE "Open" END::DOUBLE AS "Open", "High", "Low", "Close",
               CAST(NULL AS DOUBLE) AS "Adj Close",
               CASE WHEN kind = 7 THEN 0 ELSE trunc("Volume" + 0.5) END::BIGINT AS "Volume"
        FROM messages WHERE kind NOT IN (2, 5)""",
    "standardise_problems": f"""WITH {MESSAGES}
        SELECT key, bar_time, CASE kind WHEN 2 THEN 'bad_json' ELSE 'Close' END AS problem
        FROM messages WHERE kind IN (2, 5)""",
    "quarantine": f"""WITH {MESSAGES}
        SELECT key, bar_time, CASE kind WHEN 2 THEN 'bad_json' WHEN 3 THEN 'bad_time' WHEN 4 THEN 'no_ticker' END AS problem
        FROM messages""",
    "envelope_range": f"""WITH {MESSAGES}, timed AS (
          SELECT key, bar_time, bar_time + to_minutes(dayofyear(bar_time)) AS "timestamp" FROM messages)
        SELECT * FROM timed WHERE "timestamp" BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-01-01'""",
    "nan_to_null": f"""WITH {BARS}
        SELECT ticker, "time", CASE WHEN dayofyear("time") % 7 <> 0 THEN "Close" END AS "Close" FROM bars""",
    "complete_rows": f"""WITH {BARS}
        SELECT ticker, "time", "Close" FROM bars WHERE dayofyear("time") % 7 <> 0 AND dayofyear("time") % 5 > 0""",
    "window_metrics_batch": f"WITH {METRICS} SELECT * FROM docs",
    "window_ohlcv": f"WITH {OHLCV} SELECT * FROM windows",
    "move_alerts_batch": f"WITH {ALERTS} SELECT * FROM alerts",
    "window_metrics_stream": f"WITH {METRICS} SELECT * FROM docs WHERE {CLOSED}",
    "move_alerts_stream": f"WITH {ALERTS} SELECT * FROM alerts WHERE {CLOSED}",
    "late_data_stream": f"""WITH {TICKS},
        arrivals AS (
          SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-20' AND event_id % 2 = 0 THEN 1 ELSE 2 END AS run,
                 date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end
          FROM ticks),
        marks AS (
          SELECT max(ts) FILTER (run = 1) - INTERVAL 2 MINUTE AS first_mark,
                 max(ts) - INTERVAL 2 MINUTE AS last_mark FROM arrivals)
        SELECT ticker, window_start, count(*) AS trade_count, avg(p) AS avg_price
        FROM arrivals, marks
        WHERE (run = 1 OR window_end > first_mark) AND window_end <= last_mark
        GROUP BY ticker, window_start""",
    "relay_stream": f"""WITH {MESSAGES}
        SELECT key, CASE WHEN kind <> 2 THEN "High" END AS high, 2::BIGINT AS n_headers, envelope_ms FROM messages""",
    "archive_merged": f"WITH {ARCHIVE} {ARCHIVE_RESULT}",
    "archive_merged_dedup": f"""WITH {ARCHIVE} SELECT * FROM stored
        UNION ALL SELECT date, ticker, "time", "Close", "Volume" FROM fresh""",
    "archive_stats": f"""WITH {ARCHIVE}
        SELECT (SELECT count(*) FROM fresh) AS slices_written,
               (SELECT count(*) FROM days WHERE d % 3 = 2) AS slices_skipped,
               (SELECT count(*) + count(*) FILTER (d % 5 = 0) FROM fresh) AS new_records,
               (SELECT count(*) + count(*) FILTER (d % 5 = 0) FROM fresh)
                 + (SELECT count(*) FROM days WHERE d % 3 = 2) AS total_records""",
    "archive_slices_present": f"WITH {ARCHIVE} SELECT date, ticker FROM days WHERE d % 3 = 2",
    "archive_written": f"WITH {ARCHIVE} {ARCHIVE_RESULT}",
    "backfill_stats": f"""WITH {ARCHIVE}, chosen AS (
          SELECT * FROM days WHERE CAST(ticker AS BIGINT) BETWEEN 1 AND 50
                 AND date >= '1996-01-01' AND date < '2000-07-01')
        SELECT count(*) FILTER (d % 3 = 0) AS slices_written, count(*) FILTER (d % 3 <> 0) AS slices_skipped,
               count(*) FILTER (d % 3 = 0) AS new_records, count(*) AS total_records FROM chosen""",
    "archive_stream": f"""WITH {MESSAGES}
        SELECT strftime(bar_time, '%Y-%m-%d') AS date, ticker, stamp AS "time",
               CASE WHEN kind <> 5 THEN "Close" END AS "Close",
               CASE WHEN kind <> 7 THEN "Volume" + 0.5 END AS "Volume"
        FROM messages WHERE kind NOT IN (2, 3, 4)""",
    "ndjson_archive": f"""WITH {BARS}
        SELECT ticker, company, strftime("time", '%Y-%m-%d %H:%M:%S') AS "time",
               "Open", "High", "Low", "Close", "Volume" FROM bars""",
    "upsert_documents": f"""WITH {BARS}
        SELECT ticker || '_' || strftime("time", '%Y%m%d%H%M%S') AS doc_id,
               CASE WHEN dayofyear("time") % 2 = 0 THEN "Close" + 1 ELSE "Close" END AS "Close",
               strftime("time", '%Y-%m') AS part FROM bars""",
    "trend_unquantised": f"""WITH {_bars("l_extendedprice")}, {_features()}
        SELECT ticker, "time", trend FROM features""",
    "archive_to_features": f"""WITH {FEATURES}
        SELECT ticker, "time", ma50, trend, drawdown, max_drawdown FROM features""",
    "archive_to_features_parquet": f"""WITH {FEATURES}
        SELECT ticker, "time", ma50, trend, drawdown, max_drawdown FROM features""",
    "range_on_text_times": f"""WITH {BARS}, texts AS (
          SELECT ticker, "Close", dayofyear("time") % 3 AS way, "time" AS t FROM bars),
        timed AS (
          SELECT *, CASE WHEN way = 2 THEN date_trunc('day', t) + INTERVAL 27 HOUR
                         WHEN way = 0 THEN date_trunc('day', t) ELSE t END AS moment,
                 CASE way WHEN 0 THEN strftime(t, '%Y-%m-%d') WHEN 1 THEN strftime(t, '%Y-%m-%dT%H:%M:%S')
                          ELSE strftime(t, '%Y-%m-%d') || ' 22:00:00-05:00' END AS "time" FROM texts)
        SELECT ticker, "time", "Close" FROM timed
        WHERE moment >= TIMESTAMP '1996-03-01' AND moment < TIMESTAMP '1999-08-15'""",
    "cast_bad_text": f"""WITH {BARS}
        SELECT ticker, "time", CASE WHEN dayofyear("time") % 7 <> 0 THEN "Close" END AS "Close", "Volume"
        FROM bars""",
    "latest_with_null_times": f"""WITH {BARS}, known AS (
          SELECT ticker, CASE WHEN CAST(ticker AS BIGINT) % 4 <> 0 THEN "time" END AS "time", "Close" FROM bars)
        SELECT ticker, "time", "Close" FROM known
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY "time" DESC, "Close" DESC) = 1""",
    "upsert_wider_schema": f"""WITH {BARS}
        SELECT ticker || '_' || strftime("time", '%Y%m%d') AS doc_id, "Close",
               CASE WHEN dayofyear("time") % 2 <> 0 THEN "Volume" END AS "Volume",
               strftime("time", '%Y-%m') AS part FROM bars""",
    "arrival_clock": f"""WITH {TICKS}
        SELECT ticker, count(*) AS trade_count, 1::BIGINT AS windows FROM ticks GROUP BY ticker""",
    "labelled_prices": f"""WITH {BARS}
        SELECT 'SEVEN' AS ticker, CAST(NULL AS VARCHAR) AS company,
               strftime("time", '%Y-%m-%d %H:%M:%S') AS "time",
               CASE WHEN dayofyear("time") % 7 <> 0 THEN "Close" END AS "Close", "Volume"
        FROM bars WHERE ticker = '7'""",
    "labelled_prices_all": f"""WITH {BARS}
        SELECT 'T' || ticker AS ticker, company, strftime("time", '%Y-%m-%d %H:%M:%S') AS "time",
               CASE WHEN dayofyear("time") % 7 <> 0 THEN "Close" END AS "Close", "Volume"
        FROM bars""",
    "two_sinks_stream": f"""WITH {METRICS}
        SELECT doc_id, trade_count, sink::INTEGER AS sink FROM docs, (SELECT unnest([1, 2]) AS sink)
        WHERE {CLOSED}""",
    "message_counts": f"WITH {TICKS} SELECT count(*) AS reported, count(*) AS arrived FROM ticks",
    "late_rows_counted": f"""WITH {TICKS},
        arrivals AS (
          SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-20' AND event_id % 2 = 0 THEN 1 ELSE 2 END AS run FROM ticks),
        marks AS (SELECT max(ts) FILTER (run = 1) - INTERVAL 2 MINUTE AS first_mark FROM arrivals)
        SELECT count(*) FILTER (run = 2 AND ts <= first_mark) AS late_rows,
               count(*) FILTER (run = 1 OR ts > first_mark) AS kept_rows FROM arrivals, marks""",
    "slice_places": f"""WITH {BARS}
        SELECT strftime("time", '%Y-%m') AS month, ticker, "time", "Close",
               row_number() OVER (PARTITION BY strftime("time", '%Y-%m') ORDER BY "time", ticker) - 1 AS place
        FROM bars""",
    "typed_messages": f"""WITH {MESSAGES}
        SELECT key, bar_time,
               CASE WHEN kind NOT IN (2, 4) THEN ticker END AS ticker,
               CASE WHEN kind IN (2, 4) THEN 'missing' ELSE 'text' END AS ticker_kind,
               CASE WHEN kind NOT IN (2, 6) THEN company END AS company,
               CASE kind WHEN 2 THEN 'missing' WHEN 6 THEN 'null' ELSE 'text' END AS company_kind,
               CASE WHEN kind = 3 THEN '' WHEN kind <> 2 THEN stamp END AS "time",
               CASE WHEN kind = 2 THEN 'missing' ELSE 'text' END AS time_kind,
               CASE WHEN kind NOT IN (1, 2) THEN "Open" END AS "Open",
               CASE WHEN kind IN (1, 2) THEN 'missing' ELSE 'number' END AS "Open_kind",
               CASE WHEN kind NOT IN (2, 5) THEN "Close" END AS "Close",
               CASE kind WHEN 2 THEN 'missing' WHEN 5 THEN 'text' ELSE 'number' END AS "Close_kind",
               CASE WHEN kind NOT IN (2, 7) THEN "Volume" + 0.5 END AS "Volume",
               CASE WHEN kind IN (2, 7) THEN 'missing' ELSE 'number' END AS "Volume_kind" FROM messages""",
    "archive_by_date_and_ticker": f"""WITH {BARS},
        grouped AS (
          SELECT strftime("time", '%Y-%m-01') AS date, 'g' || CAST(ticker AS BIGINT) % 5 AS ticker,
                 strftime("time", '%d') || ':' || CAST(ticker AS BIGINT) % 60 AS stamp, dayofyear("time") AS d FROM bars),
        stored AS (SELECT date, ticker, stamp FROM grouped WHERE d % 3 <> 0),
        arriving AS (
          SELECT date, ticker, stamp, unnest(range(CASE WHEN d % 5 = 0 THEN 2 ELSE 1 END)) FROM grouped WHERE d % 3 <> 1),
        fresh AS (SELECT date, ticker, stamp FROM arriving ANTI JOIN stored USING (date, ticker, stamp))
        SELECT date, ticker, count(*) AS rows FROM (FROM stored UNION ALL FROM fresh) GROUP BY date, ticker""",
    "absent_columns_skipped": f'WITH {BARS} SELECT ticker, "Close", "Volume" FROM bars',
}
ORACLE["preview_size"] = f"""SELECT least(10, count(*)) AS rows, least(10, count(*)) AS reasons,
    'ticker,window_start,open_1m,close_1m,return_pct_1m,range_pct_1m,alert_reason,direction,alert_score' AS columns
    FROM ({ORACLE["move_alerts_batch"]})"""
