"""DuckDB SQL twins of the registered queries.

Each statement runs on the driver tables registered as views and computes
the same result with plain window functions, self joins and residual sums;
the quadratic fit solves the same centred normal equations as the Spark code
(``tests/test_models.py`` checks it against numpy).  Doubles
are rounded by :func:`R` exactly as ``queries.compare_round`` does;
``+ 0.0`` turns DuckDB's ``-0.0`` into ``0.0`` (Spark's ``round`` never
yields negative zero).
"""

from __future__ import annotations


def R(expr: str) -> str:
    """6 decimals below 1000, 9 significant digits from 1000 up (see queries.compare_round)."""
    x = f"({expr})"
    k = f"(8 - floor(log10(abs({x}))))"
    return (f"(CASE WHEN {x} IS NULL OR isnan({x}) OR isinf({x}) THEN {x} "
            f"WHEN abs({x}) < 1000 THEN round({x} + 1.234567e-10, 6) + 0.0 "
            f"WHEN {k} >= 0 THEN round({x} * power(10.0, {k}) + 1.234567e-4) / power(10.0, {k}) + 0.0 "
            f"ELSE round({x} / power(10.0, -{k}) + 1.234567e-4) * power(10.0, -{k}) + 0.0 END)")


BARS_DAILY = """bars_daily AS (
  SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS date,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high,
         min(value) AS low, last(value ORDER BY ts, event_id) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)"""

_PRICE = "(l_extendedprice / l_quantity)"
_LORD = "l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity"
BARS_LONG = f"""bars_long AS (
  SELECT 'P' || l_partkey AS symbol, CAST(l_shipdate AS DATE) AS date,
         first({_PRICE} ORDER BY {_LORD}) AS open, max({_PRICE}) AS high,
         min({_PRICE}) AS low, last({_PRICE} ORDER BY {_LORD}) AS close,
         CAST(sum(l_quantity) AS DOUBLE) AS volume
  FROM lineitem GROUP BY 1, 2)"""


def _analysis(bars_cte: str, src: str) -> str:
    return f"""WITH {bars_cte},
x AS (SELECT *, CAST(date - min(date) OVER (PARTITION BY symbol) AS BIGINT) AS xi FROM {src}),
fit AS (SELECT symbol, coalesce(regr_slope(close, xi), 0) AS slope,
               coalesce(regr_intercept(close, xi), avg(close)) AS icpt
        FROM x GROUP BY symbol),
p AS (SELECT x.*, icpt + slope * xi AS pred FROM x JOIN fit USING (symbol)),
m AS (SELECT symbol, avg(power(close - pred, 2)) AS mse FROM p GROUP BY symbol),
r AS (SELECT symbol, date, close, xi AS day_index, pred AS predicted_close,
       CASE WHEN count(close) OVER w3 = 3 THEN avg(close) OVER w3 END AS moving_average,
       (close / nullif(lag(close) OVER w, 0) - 1) * 100 AS daily_change,
       CASE WHEN count(close) OVER w3 = 3 THEN stddev_samp(close) OVER w3 END AS volatility,
       mse
FROM p JOIN m USING (symbol)
WINDOW w AS (PARTITION BY symbol ORDER BY date),
       w3 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT symbol, date, {R('close')} AS close, day_index, {R('predicted_close')} AS predicted_close,
       {R('moving_average')} AS moving_average, {R('daily_change')} AS daily_change,
       {R('volatility')} AS volatility, {R('mse')} AS mse FROM r"""


ORACLES: dict[str, str] = {}

ORACLES["analysis_series"] = _analysis(BARS_DAILY, "bars_daily")
ORACLES["analysis_series_long"] = _analysis(BARS_LONG, "bars_long")

ORACLES["latest_indicators"] = f"""WITH a AS ({_analysis(BARS_DAILY, "bars_daily")})
SELECT symbol, date, close, moving_average, daily_change, volatility, mse,
       daily_change > 0 AS is_positive
FROM a QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1"""

ORACLES["history_series"] = f"""WITH {BARS_DAILY}
SELECT symbol, date, {R('open')} AS open, {R('high')} AS high, {R('low')} AS low,
       {R('close')} AS close
FROM bars_daily ORDER BY symbol, date"""

ORACLES["linear_trend"] = f"""WITH {BARS_DAILY},
x AS (SELECT *, date - min(date) OVER (PARTITION BY symbol) AS xi FROM bars_daily),
fit AS (SELECT symbol, count(*) AS n, min(date) AS anchor,
               coalesce(regr_slope(close, xi), 0) AS slope,
               coalesce(regr_intercept(close, xi), avg(close)) AS icpt,
               max(close) = min(close) AS flat, var_pop(close) AS var_y
        FROM x GROUP BY symbol),
res AS (SELECT symbol, avg(power(close - (icpt + slope * xi), 2)) AS mse
        FROM x JOIN fit USING (symbol) GROUP BY symbol)
SELECT symbol, n, anchor, {R('slope')} AS slope, {R('icpt')} AS intercept, {R('mse')} AS mse,
       {R('CASE WHEN n < 2 THEN NULL WHEN flat THEN 1.0 ELSE 1 - mse / var_y END')} AS r2
FROM fit JOIN res USING (symbol)"""

BARS_MINUTE = """bars_minute AS (
  SELECT symbol, bar_ts AS ts,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high,
         min(value) AS low, last(value ORDER BY ts, event_id) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM (SELECT 'U' || user_id AS symbol, date_trunc('minute', ts) AS bar_ts, ts, event_id, value
        FROM events)
  GROUP BY symbol, bar_ts)"""

TICKS = """ticks AS (
  SELECT 'U' || user_id AS symbol, ts, event_id AS seq, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size
  FROM events)"""

ARRIVALS = f"""{TICKS},
arrivals AS (
  SELECT symbol, CAST(ts AS DATE) AS date, seq, price AS open, price AS high,
         price AS low, price AS close, size AS volume
  FROM ticks)"""


def trading_day_sql(t: str) -> str:
    return (f"(CASE WHEN isodow({t}) = 6 THEN CAST({t} AS DATE) - 1 "
            f"WHEN isodow({t}) = 7 THEN CAST({t} AS DATE) - 2 "
            f"WHEN isodow({t}) = 1 AND hour({t}) < 9 THEN CAST({t} AS DATE) - 3 "
            f"WHEN hour({t}) < 9 OR (hour({t}) = 9 AND minute({t}) < 30) THEN CAST({t} AS DATE) - 1 "
            f"ELSE CAST({t} AS DATE) END)")


def _fits(bars_cte: str, src: str) -> str:
    """CTEs x (bars with day index), co (per-symbol moments) and fit (three fitted values)."""
    return f"""WITH {bars_cte},
x AS (SELECT symbol, date, close AS y,
             CAST(date - min(date) OVER (PARTITION BY symbol) AS DOUBLE) AS xi FROM {src}),
s1 AS (SELECT symbol, count(*) AS n, avg(xi) AS mx, avg(y) AS my, count(DISTINCT xi) AS nx,
              max(xi) AS xmax, max(y) = min(y) AS flat FROM x GROUP BY symbol),
s2 AS (SELECT symbol, avg(power(xi - mx, 2)) AS m2, avg(power(xi - mx, 3)) AS m3,
              avg(power(xi - mx, 4)) AS m4, avg((xi - mx) * (y - my)) AS c1,
              avg(power(xi - mx, 2) * (y - my)) AS c2, avg(power(y - my, 2)) AS vy
       FROM x JOIN s1 USING (symbol) GROUP BY symbol),
co AS (SELECT *, CASE WHEN m2 > 0 THEN c1 / m2 ELSE 0 END AS lb,
              m2 * (m4 - m2 * m2) - m3 * m3 AS det FROM s1 JOIN s2 USING (symbol)),
pairs AS (SELECT a.symbol, a.date, b.y AS yj, a.n,
                 row_number() OVER (PARTITION BY a.symbol, a.date
                                    ORDER BY abs(b.xi - a.xi), b.xi) AS k
          FROM (x JOIN co USING (symbol)) a JOIN x b ON a.symbol = b.symbol),
rf AS (SELECT symbol, date,
              sum(yj * (power((n - k + 1.0) / n, n) - power((n - k + 0.0) / n, n))) AS rf_fit
       FROM pairs GROUP BY symbol, date),
fit AS (SELECT x.symbol, x.date, x.xi, x.y, co.n, co.vy, co.flat,
               co.my + co.lb * (x.xi - co.mx) AS linear_fit,
               {_poly_at('x.xi')} AS poly_fit, rf.rf_fit
        FROM x JOIN co USING (symbol) JOIN rf ON rf.symbol = x.symbol AND rf.date = x.date)"""


def _poly_at(xi: str) -> str:
    u = f"({xi} - co.mx)"
    return (f"(CASE WHEN co.nx >= 3 THEN co.my "
            f"+ (co.c1 * (co.m4 - co.m2 * co.m2) - co.c2 * co.m3) / co.det * {u} "
            f"+ (co.m2 * co.c2 - co.m3 * co.c1) / co.det * ({u} * {u} - co.m2) "
            f"WHEN co.nx = 2 THEN (co.my - co.lb * co.mx) "
            f"+ co.lb * co.xmax / (1 + co.xmax * co.xmax) * ({xi} / co.xmax + {xi} * {xi}) "
            f"ELSE co.my END)")


ORACLES["quadratic_trend"] = _fits(BARS_LONG, "bars_long") + f"""
SELECT symbol, date, CAST(xi AS BIGINT) AS day_index, {R('y')} AS close,
       {R('linear_fit')} AS linear_fit, {R('poly_fit')} AS poly_fit FROM fit"""

ORACLES["bagged_tree_trend"] = _fits(BARS_DAILY, "bars_daily") + f"""
SELECT symbol, date, {R('y')} AS close, {R('rf_fit')} AS rf_fit FROM fit"""

ORACLES["bagged_tree_trend_long"] = _fits(BARS_LONG, "bars_long") + f"""
SELECT symbol, date, {R('y')} AS close, {R('rf_fit')} AS rf_fit FROM fit"""


def _r2(mse: str) -> str:
    return f"CASE WHEN n < 2 THEN NULL WHEN flat THEN 1.0 ELSE 1 - {mse} / vy END"


ORACLES["model_metrics"] = _fits(BARS_DAILY, "bars_daily") + f""",
m AS (SELECT symbol, any_value(n) AS n, any_value(vy) AS vy, any_value(flat) AS flat,
             avg(power(y - linear_fit, 2)) AS linear_mse, avg(power(y - poly_fit, 2)) AS poly_mse,
             avg(power(y - rf_fit, 2)) AS rf_mse FROM fit GROUP BY symbol)
SELECT symbol, {R('linear_mse')} AS linear_mse, {R('poly_mse')} AS poly_mse,
       {R('rf_mse')} AS rf_mse, {R(_r2('linear_mse'))} AS linear_r2,
       {R(_r2('poly_mse'))} AS poly_r2, {R(_r2('rf_mse'))} AS rf_r2 FROM m"""


def _forecast(bars_cte: str, src: str) -> str:
    return f"""WITH {bars_cte},
x AS (SELECT symbol, date, close AS y,
             CAST(date - min(date) OVER (PARTITION BY symbol) AS DOUBLE) AS xi,
             max(date) OVER (PARTITION BY symbol) AS last_date FROM {src}),
s1 AS (SELECT symbol, count(*) AS n, avg(xi) AS mx, avg(y) AS my, count(DISTINCT xi) AS nx,
              max(xi) AS xmax, any_value(last_date) AS last_date FROM x GROUP BY symbol),
s2 AS (SELECT symbol, avg(power(xi - mx, 2)) AS m2, avg(power(xi - mx, 3)) AS m3,
              avg(power(xi - mx, 4)) AS m4, avg((xi - mx) * (y - my)) AS c1,
              avg(power(xi - mx, 2) * (y - my)) AS c2
       FROM x JOIN s1 USING (symbol) GROUP BY symbol),
co AS (SELECT *, CASE WHEN m2 > 0 THEN c1 / m2 ELSE 0 END AS lb,
              m2 * (m4 - m2 * m2) - m3 * m3 AS det FROM s1 JOIN s2 USING (symbol)),
rk AS (SELECT x.symbol, x.y, co.n,
              row_number() OVER (PARTITION BY x.symbol ORDER BY x.xi DESC) AS k
       FROM x JOIN co USING (symbol)),
rf AS (SELECT symbol, sum(y * (power((n - k + 1.0) / n, n) - power((n - k + 0.0) / n, n))) AS rf_future
       FROM rk GROUP BY symbol),
hz AS (SELECT co.*, rf.rf_future, h, co.xmax + h AS hx,
              CAST(co.last_date + CAST(h AS INTEGER) AS DATE) AS date
       FROM co JOIN rf USING (symbol), range(1, 31) t(h)),
fc AS (SELECT symbol, 'linear' AS model, date, hx, my + lb * (hx - mx) AS prediction FROM hz
       UNION ALL
       SELECT symbol, 'polynomial', date, hx, {_poly_at('hx').replace('co.', '')} FROM hz
       UNION ALL
       SELECT symbol, 'random_forest', date, hx, rf_future FROM hz)"""


ORACLES["forecasts"] = _forecast(BARS_DAILY, "bars_daily") + f"""
SELECT symbol, model, date, CAST(hx AS BIGINT) AS day_index, {R('prediction')} AS prediction FROM fc"""

ORACLES["forecasts_long"] = _forecast(BARS_LONG, "bars_long") + f"""
SELECT symbol, model, date, CAST(hx AS BIGINT) AS day_index, {R('prediction')} AS prediction FROM fc"""

ORACLES["forecast_horizon"] = _forecast(BARS_DAILY, "bars_daily") + """
SELECT symbol, CAST(h AS INTEGER) AS h, date, CAST(hx AS BIGINT) AS day_index FROM hz"""

ORACLES["prediction_series"] = _forecast(BARS_DAILY, "bars_daily") + f"""
SELECT symbol, 'history' AS series, date, {R('close')} AS price FROM bars_daily
UNION ALL
SELECT symbol, model, date, {R('prediction')} FROM fc"""

_IND = f"""WITH {BARS_DAILY},
ind AS (SELECT symbol, date, lag(close) OVER w AS prev_close,
               CASE WHEN count(close) OVER w3 = 3 THEN avg(close) OVER w3 END AS moving_average,
               (close / nullif(lag(close) OVER w, 0) - 1) * 100 AS daily_change,
               CASE WHEN count(close) OVER w3 = 3 THEN stddev_samp(close) OVER w3 END AS volatility
        FROM bars_daily
        WINDOW w AS (PARTITION BY symbol ORDER BY date),
               w3 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""

ORACLES["moving_average"] = _IND + f"\nSELECT symbol, date, {R('moving_average')} AS moving_average FROM ind"
ORACLES["daily_change"] = _IND + (f"\nSELECT symbol, date, {R('prev_close')} AS prev_close, "
                                  f"{R('daily_change')} AS daily_change FROM ind")
ORACLES["volatility"] = _IND + f"\nSELECT symbol, date, {R('volatility')} AS volatility FROM ind"

ORACLES["day_index"] = f"""WITH {BARS_DAILY}
SELECT symbol, date, CAST(date - min(date) OVER (PARTITION BY symbol) AS BIGINT) AS day_index
FROM bars_daily"""

ORACLES["symbols_sorted"] = f"""WITH {BARS_DAILY}
SELECT DISTINCT symbol FROM bars_daily WHERE symbol IS NOT NULL ORDER BY symbol"""

ORACLES["symbols_first_n"] = f"""WITH {BARS_DAILY}
SELECT DISTINCT symbol FROM bars_daily WHERE symbol IS NOT NULL ORDER BY symbol LIMIT 100"""

ORACLES["symbols_page"] = f"""WITH {BARS_LONG}
SELECT symbol, (SELECT count(DISTINCT symbol) FROM bars_long) AS total_count,
       20 AS page_offset, 100 AS page_limit
FROM (SELECT DISTINCT symbol FROM bars_long WHERE symbol IS NOT NULL ORDER BY symbol
      LIMIT 100 OFFSET 20)"""

ORACLES["symbols_deep_page"] = (ORACLES["symbols_page"].replace("20 AS page_offset, 100 AS", "150 AS page_offset, 40 AS")
                                .replace("LIMIT 100 OFFSET 20", "LIMIT 40 OFFSET 150"))

ORACLES["symbol_search"] = f"""WITH {BARS_DAILY}
SELECT DISTINCT symbol FROM bars_daily WHERE lower(symbol) LIKE '%' || lower(trim(' u1 ')) || '%'"""

ORACLES["coverage"] = f"""WITH {BARS_MINUTE}
SELECT symbol, count(*) AS count, count(DISTINCT ts) AS unique_times,
       count(DISTINCT CAST(ts AS DATE)) AS unique_dates, min(ts) AS earliest, max(ts) AS latest,
       {R("date_diff('microsecond', min(ts), max(ts)) / 3600000000.0")} AS time_range_hours
FROM bars_minute GROUP BY symbol"""

ORACLES["coverage_appended"] = ORACLES["coverage"]

ORACLES["bars_for_symbol"] = f"""WITH {BARS_DAILY}
SELECT symbol, date, {R('open')} AS open, {R('high')} AS high, {R('low')} AS low,
       {R('close')} AS close, {R('volume')} AS volume
FROM bars_daily WHERE symbol = 'U7'"""

_KEEP_LAST = f"""WITH {ARRIVALS},
kept AS (SELECT * FROM arrivals
         QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY seq DESC) = 1)"""
_ARR_COLS = (f"symbol, date, seq, {R('open')} AS open, {R('high')} AS high, {R('low')} AS low, "
             f"{R('close')} AS close, {R('volume')} AS volume")

ORACLES["dedup_keep_last"] = _KEEP_LAST + f"\nSELECT {_ARR_COLS} FROM kept"
ORACLES["retain_last_n"] = _KEEP_LAST + f"""
SELECT {_ARR_COLS} FROM kept
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY seq DESC) <= 5000"""
ORACLES["retain_last_n_cap10"] = _KEEP_LAST + f"""
SELECT {_ARR_COLS} FROM kept
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY seq DESC) <= 10"""

ORACLES["trading_day"] = f"""WITH {TICKS}
SELECT symbol, seq, ts, {trading_day_sql('ts')} AS trading_day FROM ticks"""

ORACLES["trailing_month"] = f"""WITH {BARS_LONG}
SELECT symbol, date, {R('open')} AS open, {R('high')} AS high, {R('low')} AS low,
       {R('close')} AS close, {R('volume')} AS volume
FROM bars_long
QUALIFY date > max(date) OVER (PARTITION BY symbol) - INTERVAL 1 MONTH"""

_ASOF = f"(SELECT {trading_day_sql('max(ts)')} FROM bars_minute)"
_MIN_COLS = (f"symbol, ts, {R('open')} AS open, {R('high')} AS high, {R('low')} AS low, "
             f"{R('close')} AS close, {R('volume')} AS volume")

ORACLES["session_bars"] = f"""WITH {BARS_MINUTE}
SELECT {_MIN_COLS} FROM bars_minute WHERE CAST(ts AS DATE) = {_ASOF}"""

_VIEW = f"""WITH {BARS_MINUTE},
flag AS (SELECT *, CAST(ts AS DATE) = {_ASOF} AS in_s,
                max(CASE WHEN CAST(ts AS DATE) = {_ASOF} THEN 1 ELSE 0 END)
                  OVER (PARTITION BY symbol) AS has_s
         FROM bars_minute),
view AS (SELECT symbol, ts, open, high, low, close, volume,
                row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS pos, true AS in_session
         FROM flag WHERE has_s = 1 AND in_s
         UNION ALL
         SELECT * FROM (SELECT symbol, ts, open, high, low, close, volume,
                row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) - 1 AS pos,
                false AS in_session
                FROM flag WHERE has_s = 0) WHERE pos < 100)"""

ORACLES["session_or_recent"] = _VIEW + f"""
SELECT {_MIN_COLS}, pos, in_session FROM view"""

ORACLES["candles"] = _VIEW + f"""
SELECT symbol,
       list(strftime(ts, '%Y-%m-%d %H:%M:%S') ORDER BY pos) AS x,
       list_transform(list(open ORDER BY pos), lambda v: {R('v')}) AS open,
       list_transform(list(high ORDER BY pos), lambda v: {R('v')}) AS high,
       list_transform(list(low ORDER BY pos), lambda v: {R('v')}) AS low,
       list_transform(list(close ORDER BY pos), lambda v: {R('v')}) AS close,
       list_transform(list(volume ORDER BY pos), lambda v: {R('v')}) AS volume,
       'candlestick' AS type, symbol AS name
FROM view GROUP BY symbol"""

ORACLES["quote_board"] = _VIEW + f""",
r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS rn FROM view),
q AS (SELECT a.symbol, a.ts AS as_of, a.close AS price, coalesce(b.close, a.close) AS prev_close,
             a.open, a.low AS day_low, a.high AS day_high, a.volume
      FROM r a LEFT JOIN r b ON a.symbol = b.symbol AND b.rn = 2 WHERE a.rn = 1)
SELECT symbol, as_of, {R('price')} AS price, {R('prev_close')} AS prev_close,
       {R('price - prev_close')} AS change,
       {R('(price / nullif(prev_close, 0) - 1) * 100')} AS change_pct,
       {R('open')} AS open, {R('day_low')} AS day_low, {R('day_high')} AS day_high,
       {R('volume')} AS volume, price - prev_close >= 0 AS is_up
FROM q"""

# Fault codes by seq % 50 (see sources.fixtures): 0 not JSON, 1 Open missing,
# 2 Symbol missing, 3 Volume as text, 4 Close NaN, 5 Date missing, 6 bad Date.
_ENV = f"""WITH {TICKS},
env AS (SELECT *, seq % 50 AS f FROM ticks),
parsed AS (
  SELECT seq, symbol AS symbol_key, ts AS msg_ts, f, f <> 0 AS is_json,
         CASE WHEN f IN (0, 2) THEN NULL ELSE symbol END AS Symbol,
         CASE WHEN f IN (0, 5) THEN NULL WHEN f = 6 THEN 'not-a-date'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS Date,
         CASE WHEN f IN (0, 1) THEN NULL ELSE price END AS Open,
         CASE WHEN f = 0 THEN NULL ELSE price END AS High,
         CASE WHEN f = 0 THEN NULL ELSE price END AS Low,
         CASE WHEN f = 0 THEN NULL WHEN f = 4 THEN CAST('NaN' AS DOUBLE) ELSE price END AS Close,
         CASE WHEN f IN (0, 3) THEN NULL ELSE size END AS Volume
  FROM env)"""

ORACLES["envelope_decode"] = _ENV + f"""
SELECT symbol_key, seq, is_json, Symbol, Date, {R('Open')} AS Open, {R('High')} AS High,
       {R('Low')} AS Low, {R('Close')} AS Close, {R('Volume')} AS Volume FROM parsed"""

_BAR_OUT = (f"{R('Open')} AS open, {R('High')} AS high, {R('Low')} AS low, "
            f"{R('Close')} AS close, {R('Volume')} AS volume")

ORACLES["valid_bars"] = _ENV + f"""
SELECT Symbol AS symbol, date_trunc('second', msg_ts) AS ts, seq, {_BAR_OUT}
FROM parsed WHERE f >= 7"""

ORACLES["rejects"] = _ENV + """
SELECT seq, symbol_key,
       CASE f WHEN 0 THEN 'not_json' WHEN 1 THEN 'missing_open' WHEN 2 THEN 'missing_symbol'
              WHEN 3 THEN 'missing_volume' WHEN 4 THEN 'nan_close' WHEN 5 THEN 'missing_date'
              WHEN 6 THEN 'bad_date' END AS reason
FROM parsed WHERE f < 7"""

ORACLES["event_time_default"] = _ENV + f"""
SELECT Symbol AS symbol,
       CASE WHEN f = 5 THEN msg_ts ELSE date_trunc('second', msg_ts) END AS ts, seq, {_BAR_OUT}
FROM parsed WHERE f >= 7 OR f = 5"""

ORACLES["intraday_zero_fill"] = _ENV + f"""
SELECT Symbol AS symbol, seq, Date AS date_text,
       {R("coalesce(CASE WHEN isnan(Open) THEN 0 ELSE Open END, 0)")} AS open,
       {R("coalesce(CASE WHEN isnan(High) THEN 0 ELSE High END, 0)")} AS high,
       {R("coalesce(CASE WHEN isnan(Low) THEN 0 ELSE Low END, 0)")} AS low,
       {R("coalesce(CASE WHEN isnan(Close) THEN 0 ELSE Close END, 0)")} AS close,
       {R("coalesce(CASE WHEN isnan(Volume) THEN 0 ELSE Volume END, 0)")} AS volume
FROM parsed WHERE Symbol IS NOT NULL"""


def _cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


ORACLES["ingest_metrics"] = _ENV + f"""
SELECT count(*) AS messages, {_cnt('f >= 7')} AS valid, {_cnt('f < 7')} AS rejected,
       {_cnt('f = 0')} AS not_json, {_cnt('f = 2')} AS missing_symbol,
       {_cnt('f = 5')} AS missing_date, {_cnt('f = 6')} AS bad_date,
       {_cnt('f = 1')} AS missing_open, {_cnt('false')} AS missing_high,
       {_cnt('false')} AS missing_low, {_cnt('false')} AS missing_close,
       {_cnt('f = 3')} AS missing_volume, {_cnt('false')} AS nan_open,
       {_cnt('false')} AS nan_high, {_cnt('false')} AS nan_low, {_cnt('f = 4')} AS nan_close,
       {_cnt('false')} AS nan_volume
FROM parsed"""

_DAILY_OUT = (f"symbol, date, {R('open')} AS open, {R('high')} AS high, {R('low')} AS low, "
              f"{R('close')} AS close, {R('volume')} AS volume")

ORACLES["envelope_encode"] = f"""WITH {BARS_MINUTE}
SELECT symbol, ts, {R('open')} AS open, {R('high')} AS high, {R('low')} AS low,
       {R('close')} AS close, {R('volume')} AS volume FROM bars_minute"""

# CSV faults by (user id + day of month) % 50: 0 no symbol, 1 Open missing,
# 2 Close text, 3 Volume missing -> all four dropped by the cleansing.
ORACLES["scan_bars_csv"] = f"""WITH {BARS_DAILY}
SELECT {_DAILY_OUT} FROM bars_daily
WHERE (CAST(substr(symbol, 2) AS BIGINT) + day(date)) % 50 NOT IN (0, 1, 2, 3)"""

ORACLES["csv_roundtrip"] = f"""WITH {BARS_DAILY}
SELECT {_DAILY_OUT} FROM bars_daily"""

ORACLES["union_symbol_files"] = ORACLES["scan_bars_csv"]
ORACLES["clean_csv_bars"] = ORACLES["scan_bars_csv"]

ORACLES["symbol_universe"] = f"""WITH {BARS_DAILY}
SELECT DISTINCT symbol FROM bars_daily WHERE day(date) % 5 = 0 OR day(date) % 7 <> 0"""

ORACLES["screener_symbols"] = f"""WITH {BARS_DAILY}
SELECT DISTINCT symbol FROM bars_daily"""

# Streams: the batch twin's SQL.
ORACLES["stream_ingest"] = ORACLES["valid_bars"]
ORACLES["stream_idempotent"] = ORACLES["valid_bars"]
ORACLES["stream_resume"] = ORACLES["valid_bars"]
ORACLES["stream_rejects"] = ORACLES["rejects"]
ORACLES["stream_latest_state"] = ORACLES["retain_last_n_cap10"]

# ST4: 5 producer cycles of equal offset ranges; cycle 0 publishes its session day.
def _snapshot_sql(deltas_of: str, newest_first: str) -> str:
    return _ENV + f""",
valid AS (SELECT Symbol AS symbol,
                 CASE WHEN f = 5 THEN msg_ts ELSE date_trunc('second', msg_ts) END AS ts,
                 seq, Open, High, Low, Close, Volume,
                 seq // CAST(ceil((SELECT max(seq) + 1 FROM ticks) / 5.0) AS BIGINT) AS chunk
          FROM parsed WHERE f >= 7 OR f = 5),
session AS (SELECT {trading_day_sql('max(ts)')} AS day FROM valid WHERE chunk = 0),
cyc AS (SELECT * FROM valid WHERE chunk = 0 AND CAST(ts AS DATE) = (SELECT day FROM session)
        UNION ALL
        SELECT * FROM valid WHERE chunk > 0
        QUALIFY row_number() OVER (PARTITION BY {deltas_of} ORDER BY {newest_first}) = 1)
SELECT symbol, ts, seq, {_BAR_OUT}, CAST(chunk AS INTEGER) AS cycle FROM cyc"""


ORACLES["snapshot_then_delta"] = _snapshot_sql("chunk, symbol", "ts DESC, seq DESC")
ORACLES["snapshot_current"] = _snapshot_sql("symbol", "chunk DESC, ts DESC, seq DESC")

ORACLES["symbol_count"] = f"""WITH {BARS_LONG}
SELECT count(DISTINCT symbol) AS total_count FROM bars_long"""


def _fmt2(x: str) -> str:
    return f"printf('%.2f', {x})"


ORACLES["quote_text"] = _VIEW + f""",
r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS rn FROM view),
q AS (SELECT a.symbol, a.close AS price, coalesce(b.close, a.close) AS prev_close,
             a.low AS day_low, a.high AS day_high, a.volume
      FROM r a LEFT JOIN r b ON a.symbol = b.symbol AND b.rn = 2 WHERE a.rn = 1),
c AS (SELECT *, price - prev_close AS change,
             (price / nullif(prev_close, 0) - 1) * 100 AS pct FROM q)
SELECT symbol,
       '$' || {_fmt2('price')} AS price_text,
       CASE WHEN change >= 0 THEN '+' ELSE '' END || {_fmt2('change')} || ' ('
         || CASE WHEN pct >= 0 THEN '+' ELSE '' END || coalesce({_fmt2('pct')}, 'NaN') || '%)'
         AS change_text,
       '$' || {_fmt2('day_low')} || ' - $' || {_fmt2('day_high')} AS range_text,
       CASE WHEN volume >= 1e9 THEN {_fmt2('volume / 1e9')} || 'B'
            WHEN volume >= 1e6 THEN {_fmt2('volume / 1e6')} || 'M'
            WHEN volume >= 1e3 THEN {_fmt2('volume / 1e3')} || 'K'
            ELSE {_fmt2('volume')} END AS volume_text
FROM c"""


ORACLES["intraday_indicators_hot"] = f"""WITH hot_minute AS (
  SELECT symbol, bar_ts AS ts, last(value ORDER BY ts, event_id) AS close
  FROM (SELECT CASE WHEN user_id % 3 = 0 THEN 'HOT' ELSE 'U' || user_id END AS symbol,
               date_trunc('minute', ts) AS bar_ts, ts, event_id, value FROM events)
  GROUP BY symbol, bar_ts),
ind AS (SELECT symbol, ts, close, lag(close) OVER w AS prev_close,
               CASE WHEN count(close) OVER w3 = 3 THEN avg(close) OVER w3 END AS moving_average,
               (close / nullif(lag(close) OVER w, 0) - 1) * 100 AS daily_change,
               CASE WHEN count(close) OVER w3 = 3 THEN stddev_samp(close) OVER w3 END AS volatility
        FROM hot_minute
        WINDOW w AS (PARTITION BY symbol ORDER BY ts),
               w3 AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT symbol, ts, {R('close')} AS close, {R('prev_close')} AS prev_close,
       {R('moving_average')} AS moving_average, {R('daily_change')} AS daily_change,
       {R('volatility')} AS volatility FROM ind"""

# x counted in whole minutes from the symbol's first bar; the quadratic by centred normal equations.
ORACLES["minute_trends_hot"] = f"""WITH hot_minute AS (
  SELECT symbol, bar_ts AS ts, last(value ORDER BY ts, event_id) AS y
  FROM (SELECT CASE WHEN user_id % 3 = 0 THEN 'HOT' ELSE 'U' || user_id END AS symbol,
               date_trunc('minute', ts) AS bar_ts, ts, event_id, value FROM events)
  GROUP BY symbol, bar_ts),
x AS (SELECT symbol, y, CAST(date_diff('minute', min(ts) OVER (PARTITION BY symbol), ts) AS DOUBLE) AS x FROM hot_minute),
s1 AS (SELECT symbol, count(*) AS n, avg(x) AS mx, avg(y) AS my, max(x) AS xl, max(y) = min(y) AS flat,
              coalesce(regr_slope(y, x), 0) AS slope, corr(y, x) AS r FROM x GROUP BY symbol),
s2 AS (SELECT symbol, any_value(n) AS n, any_value(mx) AS mx, any_value(my) AS my, any_value(xl) AS xl,
              any_value(flat) AS flat, any_value(slope) AS slope, any_value(r) AS r,
              avg(power(x - mx, 2)) AS m2, avg(power(x - mx, 3)) AS m3, avg(power(x - mx, 4)) AS m4,
              avg((x - mx) * (y - my)) AS c1, avg(power(x - mx, 2) * (y - my)) AS c2
       FROM x JOIN s1 USING (symbol) GROUP BY symbol),
q AS (SELECT *, m2 * (m4 - m2 * m2) - m3 * m3 AS det FROM s2),
f AS (SELECT *, CASE WHEN n >= 3 THEN (c1 * (m4 - m2 * m2) - c2 * m3) / det END AS b,
             CASE WHEN n >= 3 THEN (m2 * c2 - m3 * c1) / det END AS c FROM q),
e AS (SELECT *, my - slope * mx AS l0, my + slope * (xl - mx) AS l1,
             CASE WHEN n >= 3 THEN my - c * m2 - b * mx + c * mx * mx
                  WHEN n = 2 THEN my - slope * mx ELSE my END AS q0,
             CASE WHEN n >= 3 THEN my - c * m2 + b * (xl - mx) + c * (xl - mx) * (xl - mx)
                  WHEN n = 2 THEN my + slope * (xl - mx) ELSE my END AS q1 FROM f)
SELECT symbol, n, {R('slope')} AS slope,
       {R('CASE WHEN n < 2 THEN NULL WHEN flat THEN 1.0 ELSE r * r END')} AS r2,
       {R('l0')} AS linear_first, {R('l1')} AS linear_last, {R('q0')} AS quadratic_first, {R('q1')} AS quadratic_last
FROM e"""


def _pytext(x: str, places: int) -> str:
    """``round(x, places)`` printed as the shortest double (binary half-even rounding)."""
    return f"CAST(CAST(printf('%.{places}f', {x}) AS DOUBLE) AS VARCHAR)"


ORACLES["indicator_card_text"] = f"""WITH a AS ({_analysis(BARS_DAILY, "bars_daily").replace(
    "SELECT symbol, date, " + R('close'), "SELECT symbol, date, close").replace(
    R('predicted_close'), 'predicted_close').replace(R('moving_average'), 'moving_average').replace(
    R('daily_change'), 'daily_change').replace(R('volatility'), 'volatility').replace(R('mse'), 'mse')}),
last AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1)
SELECT symbol, {_pytext('mse', 2)} AS mse_text,
       '$' || {_pytext('moving_average', 2)} AS moving_average_text,
       CASE WHEN daily_change > 0 THEN '+' ELSE '' END || {_pytext('daily_change', 2)} || '%'
         AS daily_change_text,
       {_pytext('volatility', 2)} AS volatility_text
FROM last"""

ORACLES["metrics_text"] = _fits(BARS_DAILY, "bars_daily") + f""",
m AS (SELECT symbol, any_value(n) AS n, any_value(vy) AS vy, any_value(flat) AS flat,
             avg(power(y - linear_fit, 2)) AS linear_mse, avg(power(y - poly_fit, 2)) AS poly_mse,
             avg(power(y - rf_fit, 2)) AS rf_mse FROM fit GROUP BY symbol)
SELECT symbol, {_pytext('linear_mse', 4)} AS linear_mse_text, {_pytext('poly_mse', 4)} AS poly_mse_text,
       {_pytext('rf_mse', 4)} AS rf_mse_text, {_pytext(_r2('linear_mse'), 4)} AS linear_r2_text,
       {_pytext(_r2('poly_mse'), 4)} AS poly_r2_text, {_pytext(_r2('rf_mse'), 4)} AS rf_r2_text
FROM m"""

# Temporal output columns rendered as ISO text (queries.finalize does the same).
DATE_COLUMNS = ("date", "anchor", "trading_day")
TIMESTAMP_COLUMNS = ("ts", "earliest", "latest", "as_of")
TEMPORAL: dict[str, tuple[str, ...]] = {
    "linear_trend": ("anchor",),
    "coverage": ("earliest", "latest"),
    "coverage_appended": ("earliest", "latest"),
    "trading_day": ("ts", "trading_day"),
    "quote_board": ("as_of",),
}
for _name in ["analysis_series", "analysis_series_long", "latest_indicators", "history_series",
              "quadratic_trend", "bagged_tree_trend", "bagged_tree_trend_long", "forecast_horizon",
              "forecasts", "forecasts_long", "prediction_series", "moving_average", "daily_change",
              "volatility", "day_index", "bars_for_symbol", "dedup_keep_last", "retain_last_n",
              "retain_last_n_cap10", "trailing_month", "scan_bars_csv", "csv_roundtrip",
              "union_symbol_files", "clean_csv_bars", "stream_latest_state"]:
    TEMPORAL[_name] = ("date",)
for _name in ["intraday_indicators_hot", "session_bars", "session_or_recent", "valid_bars",
              "event_time_default",
              "envelope_encode", "stream_ingest", "stream_idempotent", "stream_resume",
              "snapshot_then_delta", "snapshot_current"]:
    TEMPORAL[_name] = ("ts",)


def as_text(name: str, sql: str) -> str:
    """Wrap an oracle so its temporal columns come out as ISO text."""
    cols = TEMPORAL.get(name)
    if not cols:
        return sql
    parts = []
    for c in cols:
        fmt = "%Y-%m-%d" if c in DATE_COLUMNS else "%Y-%m-%d %H:%M:%S.%f"
        parts.append(f"strftime({c}, '{fmt}') AS {c}")
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM (\n{sql}\n) AS oracle_q"


def oracles() -> dict[str, str]:
    return {k: as_text(k, v) for k, v in ORACLES.items()}
