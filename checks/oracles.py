"""The same queries as SQL, written from the rules and not from the Spark code."""

from __future__ import annotations


def r(expr: str, places: int) -> str:
    """Rounded as Spark rounds a double: half away from zero on the shortest
    decimal that names the double. Decimals also have no negative zero."""
    return (
        f"CAST(round(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 18)), {places}) AS DOUBLE)"
    )


def rounded(places: dict[str, int], prefix: str = "") -> str:
    return ", ".join(f"{r(prefix + c, n)} AS {c}" for c, n in places.items())


QUOTES = """quotes AS (
  SELECT n_name AS symbol, CAST(l_shipdate AS DATE) AS date,
         l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS volume,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_linestatus,
         l_discount, l_tax
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""


def bars_of(name: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT symbol, date, max(CASE WHEN up = 1 THEN price END) AS open, max(price) AS high,
         min(price) AS low, max(CASE WHEN down = 1 THEN price END) AS close,
         CAST(sum(volume) AS BIGINT) AS volume
  FROM (SELECT *,
          row_number() OVER (PARTITION BY symbol, date ORDER BY l_orderkey, l_linenumber,
            l_partkey, l_suppkey, l_extendedprice) AS up,
          row_number() OVER (PARTITION BY symbol, date ORDER BY l_orderkey DESC,
            l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS down
        FROM quotes WHERE {where})
  GROUP BY symbol, date)"""


BARS = f"{QUOTES}, {bars_of('bars')}"
CLEAN = f"""{BARS}, clean AS (
  SELECT *, (close - open) / nullif(open, 0) AS daily_return FROM bars
  WHERE close > 0 AND volume > 0 AND high >= low AND abs((close - open) / nullif(open, 0)) < 0.5)"""


def indexed_of(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS n,
         lag(close) OVER w AS prev_close, lead(close) OVER w AS next_close
  FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY date))"""


IX = f"{CLEAN}, {indexed_of('clean', 'ix')}"


def indicators_of(ix: str, name: str) -> str:
    """Recurrences row by row, frames as windows."""
    return f"""tr AS (
  SELECT symbol, pos, close, coalesce(close - prev_close, 0) AS d,
         greatest(high - low, coalesce(abs(high - prev_close), 0), coalesce(abs(low - prev_close), 0)) AS tr
  FROM {ix}),
rec(symbol, pos, e12, e26, up, dn, trs, atr, sig) AS (
  SELECT symbol, pos, close, close, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), tr, CAST(0 AS DOUBLE),
         CAST(0 AS DOUBLE)
  FROM tr WHERE pos = 0
  UNION ALL
  SELECT t.symbol, t.pos,
         p.e12 * 11 / 13 + t.close * 2 / 13,
         p.e26 * 25 / 27 + t.close * 2 / 27,
         p.up * 13 / 14 + greatest(t.d, 0) / 14,
         p.dn * 13 / 14 + greatest(-t.d, 0) / 14,
         p.trs + t.tr,
         CASE WHEN t.pos < 13 THEN 0 WHEN t.pos = 13 THEN (p.trs + t.tr) / 14
              ELSE (13 * p.atr + t.tr) / 14 END,
         CASE WHEN t.pos < 25 THEN 0
              WHEN t.pos = 25 THEN (p.e12 * 11 / 13 + t.close * 2 / 13) - (p.e26 * 25 / 27 + t.close * 2 / 27)
              ELSE 0.8 * p.sig + 0.2 * ((p.e12 * 11 / 13 + t.close * 2 / 13)
                                        - (p.e26 * 25 / 27 + t.close * 2 / 27)) END
  FROM rec p JOIN tr t ON t.symbol = p.symbol AND t.pos = p.pos + 1),
roll AS (
  SELECT *,
    CASE WHEN pos >= 9 THEN avg(close) OVER w10 END AS sma_10,
    CASE WHEN pos >= 19 THEN avg(close) OVER w20 END AS sma_20,
    CASE WHEN pos >= 19 THEN stddev_pop(close) OVER w20 END AS sd,
    CASE WHEN pos >= 19 THEN avg(volume) OVER w20 END AS vma,
    close / nullif(lag(close, 1) OVER w, 0) - 1 AS return_1d,
    close / nullif(lag(close, 5) OVER w, 0) - 1 AS return_5d
  FROM {ix}
  WINDOW w AS (PARTITION BY symbol ORDER BY pos),
         w10 AS (PARTITION BY symbol ORDER BY pos ROWS 9 PRECEDING),
         w20 AS (PARTITION BY symbol ORDER BY pos ROWS 19 PRECEDING)),
{name} AS (
  SELECT roll.*,
    sma_20 + 2 * sd AS bb_upper, sma_20 - 2 * sd AS bb_lower,
    4 * sd / nullif(sma_20, 0) * 100 AS bb_width,
    CASE WHEN vma = 0 THEN 1 ELSE volume / vma END AS vol_ratio,
    CASE WHEN pos >= 11 THEN e12 END AS ema_12,
    CASE WHEN pos >= 13 THEN CASE WHEN dn = 0 THEN 100 ELSE 100 - 100 / (1 + up / dn) END END AS rsi_14,
    CASE WHEN pos >= 25 THEN e12 - e26 END AS macd,
    CASE WHEN pos >= 33 THEN sig END AS macd_signal,
    CASE WHEN pos >= 33 THEN e12 - e26 - sig END AS macd_hist,
    atr AS atr_14
  FROM roll JOIN rec USING (symbol, pos))"""


IND = f"{IX}, {indicators_of('ix', 'ind')}"
OHLC = {"open": 4, "high": 4, "low": 4, "close": 4}
ALL = {"rsi_14": 4, "macd": 4, "macd_signal": 4, "macd_hist": 4, "bb_upper": 4, "bb_lower": 4,
       "bb_width": 4, "atr_14": 4, "return_1d": 6, "return_5d": 6}
JOINED = {c: n for c, n in ALL.items() if c not in ("macd_hist", "bb_width")}
LIVE = ["open", "high", "low", "volume", "rsi_14", "macd", "macd_signal", "bb_upper", "bb_lower",
        "bb_width", "atr_14", "return_1d", "return_5d", "sma_10", "sma_20", "vol_ratio"]
# vwap and day_of_week are computed where these are selected.
BATCH = ["open", "high", "low", "volume", "rsi_14", "macd", "macd_signal", "bb_upper", "bb_lower",
         "atr_14", "return_1d", "return_5d"]


def ind(places: dict[str, int]) -> str:
    return f"WITH RECURSIVE {IND} SELECT symbol, date, {rounded(places)} FROM ind"


def roll(places: dict[str, int]) -> str:
    return ind(places)


# -- backtest parts ------------------------------------------------------------

TARGETS = f"""{IX}, targets AS (
  SELECT symbol, date, open, close, prev_close, next_close AS target, pos, n - 1 AS n
  FROM ix WHERE pos < n - 1)"""
DRIFT = f"""{TARGETS}, preds AS (
  SELECT *, close + coalesce(close - prev_close, 0) AS pred FROM targets)"""
NAIVE = f"{TARGETS}, preds AS (SELECT *, close AS pred FROM targets)"


def tested(base: str) -> str:
    return f"""{base}, test AS (
  SELECT symbol, date, close, target, pred, CAST(floor(n * 0.8) AS BIGINT) AS train_days,
         pos - CAST(floor(n * 0.8) AS BIGINT) AS tpos, n - CAST(floor(n * 0.8) AS BIGINT) AS tn,
         (target - close) / nullif(close, 0) AS bh,
         CASE WHEN pred > close THEN (target - close) / nullif(close, 0) ELSE 0 END AS sr
  FROM preds WHERE pos >= CAST(floor(n * 0.8) AS BIGINT))"""


def sharpe_s(c: str) -> str:
    return f"""CASE WHEN stddev_samp({c}) > 1e-10
      THEN (avg({c}) - 0.02 / 252) / stddev_samp({c}) * sqrt(252) ELSE 0 END"""


METRICS = f"""metrics AS (
  SELECT symbol, max(train_days) AS train_days, count(*) AS test_days,
    {r('avg(abs(pred - target))', 4)} AS mae, {r('avg(abs(close - target))', 4)} AS naive_mae,
    {r('(avg(abs(close - target)) - avg(abs(pred - target))) / nullif(avg(abs(close - target)), 0) * 100', 2)}
      AS mae_vs_naive_pct,
    {r('avg(CASE WHEN sign(target - close) = sign(pred - close) THEN 1.0 ELSE 0.0 END) * 100', 2)}
      AS directional_accuracy,
    {r(sharpe_s('sr'), 3)} AS strategy_sharpe, {r(sharpe_s('bh'), 3)} AS buyhold_sharpe,
    {r('product(1 + sr)', 4)} AS final_equity
  FROM test GROUP BY symbol)"""

EVAL = f"""{DRIFT}, ev AS (
  SELECT symbol, pos, target AS actual, pred AS predicted,
         lag(target) OVER w AS pa, lag(pred) OVER w AS pp
  FROM preds WINDOW w AS (PARTITION BY symbol ORDER BY date)),
evr AS (
  SELECT *, CASE WHEN pos > 0 THEN (actual - pa) / nullif(pa, 0) * sign(predicted - pp) END AS sr,
         CASE WHEN pos > 0 THEN CASE WHEN sign(actual - pa) = sign(predicted - pp) THEN 1.0 ELSE 0.0 END END AS hit
  FROM ev),
curve AS (
  SELECT symbol, pos, product(1 + sr) OVER (PARTITION BY symbol ORDER BY pos ROWS UNBOUNDED PRECEDING) AS v
  FROM evr WHERE pos > 0),
peaks AS (
  SELECT symbol, v, max(v) OVER (PARTITION BY symbol ORDER BY pos ROWS UNBOUNDED PRECEDING) AS peak FROM curve),
dd AS (SELECT symbol, min((v - peak) / nullif(peak, 0)) * 100 AS max_drawdown_pct FROM peaks GROUP BY symbol)"""

# -- portfolio parts -----------------------------------------------------------

def aligned(days: int) -> str:
    return f"""{IX}, shortest AS (SELECT least(min(n), {days}) AS m FROM ix),
aligned AS (
  SELECT symbol, date, m - 1 - (n - 1 - pos) AS rn, close, prev_close
  FROM ix, shortest WHERE n - 1 - pos < m),
ret AS (SELECT symbol, rn, ln(close / nullif(prev_close, 0)) AS r FROM aligned WHERE rn > 0)"""


def moments(days: int) -> str:
    return f"""{aligned(days)}, mean AS (SELECT symbol, avg(r) * 252 AS ann_mean FROM ret GROUP BY symbol),
cov AS (
  SELECT a.symbol AS asset_i, b.symbol AS asset_j, covar_samp(a.r, b.r) * 252 AS cov
  FROM ret a JOIN ret b ON a.rn = b.rn GROUP BY a.symbol, b.symbol)"""


def weighted(draws: int, days: int = 252) -> str:
    return f"""{moments(days)}, draw AS (
  SELECT portfolio, symbol AS asset,
    -ln((CAST('0x' || substr(md5('42:' || portfolio || ':' || symbol), 1, 13) AS BIGINT) + 1)
        / 4503599627370496.0) AS e
  FROM mean, range({draws}) t(portfolio)),
weights AS (SELECT portfolio, asset, e / sum(e) OVER (PARTITION BY portfolio) AS w FROM draw),
eq AS (SELECT -1 AS portfolio, symbol AS asset, 1.0 / count(*) OVER () AS w FROM mean)"""


def moments_of(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT portfolio, ret, vol, CASE WHEN vol > 1e-10 THEN (ret - 0.02) / vol ELSE 0 END AS sharpe
  FROM (SELECT portfolio, ret, sqrt(greatest(var, 0)) AS vol
        FROM (SELECT portfolio, sum(w * ann_mean) AS ret FROM {source} JOIN mean ON symbol = asset GROUP BY portfolio)
        JOIN (SELECT portfolio, sum(w * part) AS var
              FROM (SELECT x.portfolio, x.asset, x.w, sum(y.w * cov) AS part
                    FROM {source} x JOIN cov ON asset_i = x.asset
                    JOIN {source} y ON y.portfolio = x.portfolio AND y.asset = asset_j
                    GROUP BY x.portfolio, x.asset, x.w)
              GROUP BY portfolio) USING (portfolio)))"""


def mc(days: int = 252) -> str:
    return f"{weighted(10000, days)}, {moments_of('weights', 'mc')}"


def best(days: int = 252) -> str:
    return f"""{mc(days)}, {moments_of('eq', 'eqm')},
best AS (SELECT * FROM mc ORDER BY sharpe DESC, portfolio LIMIT 1),
record AS (
  SELECT best.portfolio,
    {r('best.ret * 100', 2)} AS expected_return, {r('best.vol * 100', 2)} AS volatility,
    {r('best.sharpe', 3)} AS sharpe, {r('eqm.ret * 100', 2)} AS eq_return,
    {r('eqm.vol * 100', 2)} AS eq_volatility, {r('eqm.sharpe', 3)} AS eq_sharpe,
    {r('(best.sharpe - eqm.sharpe) / nullif(abs(eqm.sharpe), 0) * 100', 1)} AS sharpe_improvement,
    m AS days_used
  FROM best, eqm, shortest)"""


def record(days: int = 252) -> str:
    return f"""WITH {best(days)} SELECT
        (SELECT string_agg(asset, ',' ORDER BY asset) FROM weights WHERE portfolio = record.portfolio) AS symbols,
        (SELECT string_agg(printf('%.4f', round(w, 4)), ',' ORDER BY asset) FROM weights
          WHERE portfolio = record.portfolio) AS weights,
        expected_return, volatility, sharpe, eq_return, eq_volatility, eq_sharpe, sharpe_improvement,
        days_used FROM record"""


ALIGNED, MOMENTS, MC, BEST = aligned(252), moments(252), mc(), best()
FRONTIER = f"""front AS (
  SELECT portfolio, {r('ret * 100', 2)} AS ret, {r('vol * 100', 2)} AS vol FROM mc WHERE portfolio < 500)"""

# -- text parts ----------------------------------------------------------------

HEADLINES = """headlines AS (
  SELECT source AS symbol, DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS date, text AS headline,
         'doc/' || doc_id AS url, doc_id, lang
  FROM documents)"""
BLANKS = r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"


def words(items: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in items) + "]"


def scored(pos: list[str], neg: list[str], name: str = "scored") -> str:
    return f"""{name} AS (
  SELECT *, p / greatest(p + n, 1) AS sentiment_positive, n / greatest(p + n, 1) AS sentiment_negative,
         1 - (p + n) / greatest(p + n, 1) AS sentiment_neutral,
         (p - n) / greatest(p + n, 1) AS sentiment_compound
  FROM (SELECT *, len(list_intersect(tokens, {words(pos)})) AS p, len(list_intersect(tokens, {words(neg)})) AS n
        FROM (SELECT *, list_distinct(regexp_split_to_array(lower(headline), '{BLANKS}')) AS tokens FROM headlines)))"""


SHORT_POS = ["rise", "gain", "beat", "profit", "growth", "up", "record", "strong"]
SHORT_NEG = ["fall", "drop", "miss", "loss", "decline", "down", "weak", "cut"]
LONG_POS = SHORT_POS + ["bull", "surge", "soar", "rally", "high", "positive", "buy"]
LONG_NEG = SHORT_NEG + ["bear", "crash", "plunge", "slump", "low", "negative", "sell"]
SCORED = f"{HEADLINES}, {scored(['the', 'and', 'is'], ['of', 'to', 'a'])}"
DAILY = f"""{SCORED}, daily AS (
  SELECT symbol, date, avg(sentiment_compound) AS sentiment_compound,
         avg(sentiment_positive) AS sentiment_positive, avg(sentiment_negative) AS sentiment_negative,
         count(*) AS article_count
  FROM scored GROUP BY symbol, date)"""
ARTICLES = f"""{SCORED}, articles AS (
  SELECT doc_id, symbol, {r('sentiment_compound', 4)} AS sentiment_score,
    CASE WHEN sentiment_compound > 0.05 THEN 'Bullish' WHEN sentiment_compound < -0.05 THEN 'Bearish'
         ELSE 'Neutral' END AS sentiment_label
  FROM scored),
persym AS (
  SELECT a.symbol, {r('coalesce(m, 0)', 4)} AS aggregate_score,
    CASE WHEN coalesce(m, 0) > 0.05 THEN 'Bullish' WHEN coalesce(m, 0) < -0.05 THEN 'Bearish'
         ELSE 'Neutral' END AS aggregate_label,
    coalesce(c, 0) AS article_count
  FROM (SELECT source AS symbol FROM documents UNION SELECT n_name FROM nation) a
  LEFT JOIN (SELECT symbol, avg(sentiment_score) AS m, count(*) AS c FROM articles GROUP BY symbol) b
    ON a.symbol = b.symbol)"""

TICKS = """ticks AS (
  SELECT event_id, event_type AS symbol, value AS price, CAST(1 AS BIGINT) AS volume,
         value - 0.01 AS bid, value + 0.01 AS ask, ts AS timestamp, 'feed' AS source
  FROM events)"""
MESSAGES = """messages AS (
  SELECT event_id,
    concat_ws(',', CASE WHEN event_type = 'view' THEN 'price' END,
                   CASE WHEN event_type = 'error' THEN 'volume' END,
                   CASE WHEN event_type = 'signup' THEN 'timestamp' END) AS missing,
    event_type <> 'view' AND value - 5 > 0 AS price_ok
  FROM events),
judged AS (
  SELECT *, CAST(missing <> '' AS INTEGER) + CAST(NOT price_ok AS INTEGER) AS errors FROM messages)"""
HOUR_BARS = f"""WITH {TICKS}
SELECT symbol, time_bucket(INTERVAL 1 HOUR, timestamp) AS window_start,
  arg_min(price, struct_pack(t := timestamp, e := event_id)) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, struct_pack(t := timestamp, e := event_id)) AS close,
  CAST(sum(volume) AS BIGINT) AS volume, count(*) AS ticks
FROM ticks GROUP BY symbol, window_start"""
LATEST_TICK = f"""WITH {TICKS}
SELECT symbol, price, timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, event_id DESC) AS k FROM ticks)
WHERE k = 1"""


def checks(source: str, counts: dict[str, str]) -> str:
    parts = [
        f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE {cond}) AS failures FROM {source}"
        for name, cond in counts.items()
    ]
    parts.append(
        f"""SELECT 'no_duplicates', CAST(coalesce(sum(c - 1), 0) AS BIGINT)
            FROM (SELECT count(*) AS c FROM {source} GROUP BY symbol, date)"""
    )
    union = " UNION ALL ".join(parts)
    return f'SELECT "check", failures = 0 AS passed, failures FROM ({union})'


LIGHT = {f"no_nulls_{c}": f"{c} IS NULL" for c in ("symbol", "date", "close", "volume")}
LIGHT |= {"close_positive": "close <= 0", "volume_positive": "volume <= 0"}
EXPECT = {f"not_null_{c}": f"{c} IS NULL" for c in ("symbol", "date", "close")}
EXPECT |= {"between_close": "close < 0", "between_volume": "volume < 0",
           "between_rsi_14": "rsi_14 < 0 OR rsi_14 > 100"}

STATUS = f"""{QUOTES}, {bars_of('bars_f', "l_linestatus = 'F'")}, {bars_of('bars_o', "l_linestatus = 'O'")}"""


def banded(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT symbol, date,
    CASE WHEN k >= 20 THEN m + 2 * s END AS bb_upper, CASE WHEN k >= 20 THEN m - 2 * s END AS bb_lower,
    close / nullif(prev, 0) - 1 AS return_1d
  FROM (SELECT *, row_number() OVER w AS k, lag(close) OVER w AS prev, avg(close) OVER w20 AS m,
               stddev_pop(close) OVER w20 AS s
        FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY date),
          w20 AS (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING)))"""


def market(source: str, where: str) -> str:
    places = {"rsi_14": 2, "macd": 4, "macd_signal": 4, "bb_upper": 4, "bb_lower": 4}
    return f"SELECT symbol, date, {rounded(OHLC)}, volume, {rounded(places)} FROM {source} WHERE {where}"


SCALED = f"""{IX}, fitted AS (
  SELECT symbol, min(close) AS c0, max(close) - min(close) AS cr, min(open) AS o0, max(open) - min(open) AS orr,
         min(volume) AS v0, max(volume) - min(volume) AS vr
  FROM ix WHERE pos < floor(n * 0.85) GROUP BY symbol),
scaled AS (
  SELECT ix.*, CASE WHEN pos < floor(n * 0.85) THEN 'train' ELSE 'test' END AS part, c0, cr,
    (close - c0) / CASE WHEN cr = 0 THEN 1 ELSE cr END AS sc,
    (open - o0) / CASE WHEN orr = 0 THEN 1 ELSE orr END AS so,
    (volume - v0) / CASE WHEN vr = 0 THEN 1.0 ELSE vr END AS sv
  FROM ix JOIN fitted USING (symbol))"""

# -- stored models and records -------------------------------------------------

RULES = {"naive": "close", "drift": "close + coalesce(close - prev_close, 0)",
         "reversal": "close - coalesce(close - prev_close, 0)"}
MATRIX = f"""{IND}, complete AS (SELECT symbol, date, open, close FROM ind
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in LIVE)}), {indexed_of('complete', 'mx')}"""


def judged(name: str, gate: float) -> str:
    """The decision on one rule over the rows of the matrix."""
    return f"""judged_{name} AS (WITH preds AS (
    SELECT symbol, date, close, next_close AS target, pos, n - 1 AS n, {RULES[name]} AS pred FROM mx WHERE pos < n - 1),
  {tested('x').removeprefix('x, ')}, {METRICS}
  SELECT '{name}' AS model_version, avg(strategy_sharpe) AS avg_sharpe, avg(directional_accuracy) AS avg_accuracy,
    count(*) AS symbols, (SELECT symbol FROM metrics ORDER BY strategy_sharpe DESC, symbol LIMIT 1) AS best_symbol,
    avg(strategy_sharpe) >= {gate} AS promoted FROM metrics)"""


JUDGED = f"""{MATRIX}, {judged('naive', -1e9)}, {judged('drift', 0.8)}, {judged('reversal', 0.8)}"""


def forecasts(need: int) -> str:
    """A record of every rule for every symbol; prices in four places, as they are stored."""
    union = " UNION ALL ".join(
        f"SELECT symbol, '{name}' AS model_version, {rule} AS pred FROM mx WHERE pos = n - 1 AND n - 1 >= {need}"
        for name, rule in RULES.items())
    return f"""vol AS (SELECT symbol, stddev_samp(close) AS sd, arg_max(close, date) AS cur
    FROM mx WHERE pos >= n - 20 GROUP BY symbol),
made AS (SELECT symbol, model_version, pred, cur, {r('pred - 1.96 * sd', 4)} AS lo, {r('pred + 1.96 * sd', 4)} AS hi
  FROM ({union}) JOIN vol USING (symbol)),
forecasts AS (SELECT symbol, model_version, {r('cur', 4)} AS current_price, {r('pred', 4)} AS predicted_price,
  lo AS confidence_lower, hi AS confidence_upper,
  {r('greatest(0.0, least(1.0, 1 - CASE WHEN cur = 0 THEN 0.1 ELSE (hi - lo) / cur END))', 4)} AS confidence_score,
  DATE '1998-12-02' AS prediction_date, CAST(NULL AS DOUBLE) AS sentiment_score, 'Neutral' AS sentiment_label FROM made)"""


def fixed(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18, 4)) AS VARCHAR)"


SCALES = [*BATCH[:4], "vwap", *BATCH[4:], "day_of_week", "adjusted_close"]
BATCH_SCALED = f"""{IND}, bt AS (
  SELECT symbol, date, {', '.join(BATCH)}, (high + low + close) / 3 AS vwap, dayofweek(date) + 1 AS day_of_week,
    close AS adjusted_close FROM ind WHERE {' AND '.join(f'{c} IS NOT NULL' for c in BATCH)}),
bx AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS pos,
    count(*) OVER (PARTITION BY symbol) AS n FROM bt),
bf AS (SELECT symbol, {', '.join(f'min({c}) AS lo_{c}, max({c}) - min({c}) AS w_{c}' for c in SCALES)}
  FROM bx WHERE pos < floor(n * 0.85) GROUP BY symbol),
bs AS (SELECT symbol, date, pos, CASE WHEN pos < floor(n * 0.85) THEN 'train' ELSE 'test' END AS part,
  {', '.join(f'({c} - lo_{c}) / CASE WHEN w_{c} = 0 THEN 1.0 ELSE w_{c} END AS scaled_{c}' for c in SCALES)}
  FROM bx JOIN bf USING (symbol))"""
DAILY_OF = f"""{SCORED}, {scored(['of', 'to', 'a'], ['the', 'and', 'is'], 'turned')},
kept AS (SELECT symbol, date, avg(sentiment_compound) AS c, avg(sentiment_positive) AS p, avg(sentiment_negative) AS g,
    count(*) AS k FROM scored WHERE date <= DATE '2024-01-20' GROUP BY symbol, date),
came AS (SELECT symbol, date, avg(sentiment_compound) AS c, avg(sentiment_positive) AS p, count(*) AS k
  FROM turned WHERE date >= DATE '2024-01-11' GROUP BY symbol, date)"""

ORACLES: dict[str, str] = {
    "bars_daily": f"WITH {BARS} SELECT symbol, date, {rounded(OHLC)}, volume FROM bars",
    "clean_bars": f"""WITH {CLEAN} SELECT symbol, date, {rounded(OHLC)}, volume,
        {r('daily_return', 6)} AS daily_return FROM clean""",
    "derive_bars": f"""WITH {CLEAN} SELECT symbol, date, {r('high - low', 4)} AS price_range,
        {r('(high + low + close) / 3', 4)} AS vwap, CAST(year(date) AS INTEGER) AS year,
        CAST(month(date) AS INTEGER) AS month, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week
        FROM clean""",
    "dedupe_latest": f"""WITH {QUOTES} SELECT symbol, date, {r('price', 4)} AS price, volume, l_orderkey, l_linenumber
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY l_orderkey DESC,
          l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS k FROM quotes)
        WHERE k = 1""",
    "split_valid_prices": f"""WITH {QUOTES} SELECT symbol,
        concat_ws(',', CASE WHEN price * (1 + l_discount - l_tax) <= 0 THEN 'high' END,
                  CASE WHEN price * (1 + l_discount - l_tax) < price THEN 'high_low' END) AS reasons,
        count(*) AS rows, CAST(sum(volume) AS BIGINT) AS volume
        FROM quotes GROUP BY 1, 2""",
    "split_valid_ticks": f"""WITH {TICKS} SELECT symbol,
        concat_ws(',', CASE WHEN price <= 0 THEN 'price' END, CASE WHEN bid <= 0 THEN 'bid' END,
                  CASE WHEN ask <= 0 THEN 'ask' END) AS reasons, count(*) AS rows
        FROM ticks GROUP BY 1, 2""",
    "drop_incomplete": f"""WITH RECURSIVE {IND} SELECT symbol, count(*) AS rows, min(date) AS first_date
        FROM ind WHERE macd_signal IS NOT NULL AND return_5d IS NOT NULL GROUP BY symbol""",
    "validate_fallback": f"WITH RECURSIVE {IND} " + checks(
        "ind", {**LIGHT, "rsi_range": "rsi_14 < 0 OR rsi_14 > 100"}),
    "validate_quotes": f"WITH {QUOTES}, q AS (SELECT symbol, date, price AS close, volume FROM quotes) "
        + checks("q", LIGHT),
    "validate_expectations": f"WITH RECURSIVE {IND} " + checks("ind", EXPECT),
    "expectations_broken": f"""WITH RECURSIVE {IND}, broken AS (SELECT
          CASE WHEN day(date) <> 7 THEN symbol END AS symbol, CASE WHEN day(date) <> 8 THEN date END AS date,
          CASE WHEN day(date) = 3 THEN -close WHEN day(date) <> 4 THEN close END AS close,
          CASE WHEN day(date) = 5 THEN -volume ELSE volume END AS volume,
          CASE WHEN day(date) = 6 THEN rsi_14 + 100.5 ELSE rsi_14 END AS rsi_14 FROM ind),
        c AS ({checks('broken', EXPECT)})
        SELECT c.*, t.* FROM c, (SELECT count(*) FILTER (WHERE passed) AS successful, count(*) AS evaluated,
          bool_and(passed) AS all_passed FROM c) t""",
    "validation_statistics": f"WITH RECURSIVE {IND}, c AS ({checks('ind', EXPECT)}) "
        "SELECT count(*) FILTER (WHERE passed) AS successful, count(*) AS evaluated, "
        "bool_and(passed) AS success FROM c",
    "parse_daily_json": f"""WITH {BARS} SELECT symbol, date, {rounded(OHLC)},
        {r('close', 4)} AS adjusted_close, volume FROM bars""",
    "lake_roundtrip": f"WITH {BARS} SELECT symbol, date, {rounded(OHLC)}, volume FROM bars",
    "etl_processed": f"""WITH RECURSIVE {IND} SELECT symbol, date, {rounded(OHLC)}, volume,
        {rounded(ALL)}, {r('daily_return', 6)} AS daily_return, {r('high - low', 4)} AS price_range,
        {r('(high + low + close) / 3', 4)} AS vwap, CAST(year(date) AS INTEGER) AS year,
        CAST(month(date) AS INTEGER) AS month, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week FROM ind""",
    "warehouse_load": f"""WITH RECURSIVE {IND} SELECT symbol, date, {rounded(OHLC)}, volume, {rounded(
        {"rsi_14": 4, "macd": 6, "macd_signal": 6, "bb_upper": 4, "bb_lower": 4, "atr_14": 4,
         "return_1d": 6, "return_5d": 6})} FROM ind""",
    "processed_roundtrip": f"""WITH RECURSIVE {IND} SELECT symbol, date, {rounded({'close': 4, 'rsi_14': 4})}
        FROM ind WHERE date >= DATE '1996-07-01'""",
    "returns": ind({"return_1d": 6, "return_5d": 6}),
    "bollinger": ind({"bb_upper": 4, "bb_lower": 4, "bb_width": 4}),
    "sma": ind({"sma_10": 4, "sma_20": 4}),
    "volume_ratio": ind({"vol_ratio": 6}),
    "ema12": ind({"ema_12": 4}),
    "rsi": ind({"rsi_14": 4}),
    "macd": ind({"macd": 4, "macd_signal": 4, "macd_hist": 4}),
    "atr": ind({"atr_14": 4}),
    "indicators_all": ind(ALL),
    "feature_matrix": f"""WITH RECURSIVE {IND} SELECT symbol, date, pos - 33 AS pos, n - 33 AS n, volume,
        {rounded({c: 4 for c in LIVE if c != 'volume'})} FROM ind
        WHERE {' AND '.join(f'{c} IS NOT NULL' for c in LIVE)}""",
    "batch_features": f"""WITH RECURSIVE {IND} SELECT symbol, date, volume,
        {rounded({c: 4 for c in BATCH if c != 'volume'})}, {r('close', 4)} AS adjusted_close,
        {r('(high + low + close) / 3', 4)} AS vwap, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week FROM ind
        WHERE {' AND '.join(f'{c} IS NOT NULL' for c in BATCH)}""",
    "next_target": f"WITH {TARGETS} SELECT symbol, date, {rounded({'close': 4, 'target': 4})} FROM targets",
    "chrono_split": f"""WITH {IX} SELECT symbol, date, pos,
        CASE WHEN pos < floor(n * 0.85) THEN 'train' ELSE 'test' END AS part FROM ix""",
    "log_returns": f"""WITH {IX} SELECT symbol, date, {r('ln(close / nullif(prev_close, 0))', 6)} AS r
        FROM ix WHERE pos > 0""",
    "market_window": f"""WITH RECURSIVE {CLEAN}, {indexed_of('clean', 'full_ix')},
        cut AS (SELECT symbol, date, open, high, low, close, volume FROM full_ix WHERE pos >= n - 90),
        {indexed_of('cut', 'wx')}, {indicators_of('wx', 'view_ind')} {market('view_ind', 'TRUE')}""",
    "market_history": f"WITH RECURSIVE {IND} {market('ind', 'pos >= n - 90')}",
    "rsi_zones": f"""WITH RECURSIVE {IND} SELECT symbol,
        CASE WHEN rsi_14 > 70 THEN 'overbought' WHEN rsi_14 < 30 THEN 'oversold'
             WHEN rsi_14 IS NOT NULL THEN 'neutral' END AS zone,
        CASE WHEN macd - macd_signal >= 0 THEN 'up' WHEN macd - macd_signal < 0 THEN 'down' END AS side,
        count(*) AS rows FROM ind GROUP BY ALL""",
    "null_keys_reported": f"""WITH {CLEAN}, p AS (
        SELECT CASE WHEN symbol <> 'NATION_5' OR day(date) <> 17 THEN symbol END AS symbol,
               CASE WHEN symbol <> 'NATION_3' OR day(date) <> 13 THEN date END AS date FROM clean)
        SELECT count(*) AS rows, count(*) FILTER (WHERE symbol IS NULL) AS null_symbols,
               count(*) FILTER (WHERE date IS NULL) AS null_dates,
               (SELECT count(*) - count(DISTINCT symbol) FROM p
                WHERE symbol IS NOT NULL AND date IS NOT NULL) AS returns FROM p""",
    "lookback_sequences": f"""WITH {IX} SELECT a.symbol, a.date, CAST(count(*) AS INTEGER) AS len,
        {r('sum((b.open + b.close) * (b.pos - a.pos + 61))', 2)} AS checksum,
        {r('max(a.close)', 4)} AS label
        FROM ix a JOIN ix b ON a.symbol = b.symbol AND b.pos BETWEEN a.pos - 60 AND a.pos - 1
        WHERE a.pos >= 60 GROUP BY a.symbol, a.date""",
    "minmax_scale": f"""WITH {SCALED} SELECT symbol, date, part, {r('sc', 6)} AS scaled_close,
        {r('sv', 6)} AS scaled_volume, {r('sc * CASE WHEN cr = 0 THEN 1 ELSE cr END + c0', 4)} AS close_back FROM scaled""",
    "symbol_alias": f"""WITH {BARS} SELECT resolved, resolved IN ('N0', 'NATION_2', 'NATION_3', 'NATION_7') AS supported,
        count(*) AS rows FROM (SELECT CASE upper(symbol) WHEN 'NATION_0' THEN 'N0' WHEN 'NATION_1' THEN 'N1'
          ELSE upper(symbol) END AS resolved FROM bars) GROUP BY resolved""",
    "symbol_lists": """SELECT p_partkey, upper(trim(p_brand)) || '|' || upper(trim(p_name)) AS symbols FROM part""",
    "tail_n": f"""WITH {BARS} SELECT symbol, date, {r('close', 4)} AS close FROM (
        SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM bars) WHERE k <= 20""",
    "history_window": f"""WITH {BARS} SELECT symbol, date, {r('close', 4)} AS close FROM bars
        WHERE symbol = 'NATION_3' AND date >= DATE '1998-12-01' - 180""",
    "min_history_gate": f"WITH {CLEAN} SELECT symbol, count(*) AS rows, count(*) >= 900 AS enough FROM clean GROUP BY symbol",
    "left_join_prices_indicators": f"""WITH RECURSIVE {IND} SELECT b.symbol, b.date, {rounded(OHLC, 'b.')}, b.volume,
        {rounded(JOINED, 'i.')} FROM bars b LEFT JOIN ind i ON b.symbol = i.symbol AND b.date = i.date""",
    "read_prices": f"""WITH RECURSIVE {IND} SELECT b.symbol, b.date, {rounded(OHLC, 'b.')}, b.volume,
        {rounded(JOINED, 'i.')} FROM bars b LEFT JOIN ind i ON b.symbol = i.symbol AND b.date = i.date
        WHERE b.symbol = 'NATION_3' AND b.date >= DATE '1998-12-01' - 365""",
    "union_frames": f"""WITH {STATUS} SELECT symbol, date, {r('close', 4)} AS close, volume FROM bars_f
        UNION ALL SELECT symbol, date, {r('close', 4)}, NULL FROM bars_o""",
    "ingest_totals": f"WITH {BARS} SELECT symbol, count(*) AS rows FROM bars GROUP BY ROLLUP (symbol)",
    "upsert_prices": f"""WITH {STATUS} SELECT coalesce(f.symbol, o.symbol) AS symbol, coalesce(f.date, o.date) AS date,
        {r('coalesce(f.open, o.open)', 4)} AS open, {r('coalesce(f.high, o.high)', 4)} AS high,
        {r('coalesce(f.low, o.low)', 4)} AS low, {r('coalesce(o.close, f.close)', 4)} AS close,
        {r('coalesce(o.close, f.close)', 4)} AS adjusted_close, coalesce(o.volume, f.volume) AS volume
        FROM bars_f f FULL JOIN bars_o o ON f.symbol = o.symbol AND f.date = o.date""",
    "etl_counts": f"""WITH {IX}, c AS (SELECT count(*) AS written FROM clean), b AS (SELECT count(*) AS read FROM bars)
        SELECT symbol, count(*) AS rows, count(*) FILTER (WHERE pos >= 13) AS rated, read, written
        FROM ix, c, b GROUP BY symbol, read, written""",
    "indicator_records": f"""WITH RECURSIVE {IND} SELECT symbol, CASE WHEN day(date) = 13 THEN 'macd' ELSE '' END AS reasons,
        count(*) AS rows, count(macd) FILTER (WHERE day(date) <> 13) AS macds, CAST(0 AS BIGINT) AS returns,
        {r('sum(rsi_14)', 2)} AS rsi_total FROM ind GROUP BY symbol, day(date) = 13""",
    "scorer_plug": f"""WITH {HEADLINES}, n AS (SELECT symbol, date, length(headline) - length(replace(headline, 'e', '')) AS g,
          length(headline) - length(replace(headline, 'a', '')) AS b FROM headlines)
        SELECT symbol, date, {r('avg((g - b) / greatest(g + b, 1))', 6)} AS sentiment_compound,
          {r('avg(g / greatest(g + b, 1))', 6)} AS sentiment_positive, {r('avg(b / greatest(g + b, 1))', 6)} AS sentiment_negative,
          count(*) AS article_count FROM n GROUP BY symbol, date""",
    "warehouse_upserts": f"""WITH {STATUS} SELECT coalesce(f.symbol, o.symbol) AS symbol, coalesce(f.date, o.date) AS date,
        {r('coalesce(f.open, o.open)', 4)} AS open, {r('coalesce(f.high, o.high)', 4)} AS high,
        {r('coalesce(f.low, o.low)', 4)} AS low, {r('coalesce(o.close, f.close)', 4)} AS close,
        {r('coalesce(o.close, f.close)', 4)} AS adjusted_close, coalesce(o.volume, f.volume) AS volume
        FROM bars_f f FULL JOIN bars_o o ON f.symbol = o.symbol AND f.date = o.date
        WHERE coalesce(f.date, o.date) >= DATE '1994-07-15'""",
    "upsert_indicators": f"""WITH {STATUS}, {banded('bars_f', 'f')}, {banded('bars_o', 'o')}
        SELECT coalesce(f.symbol, o.symbol) AS symbol, coalesce(f.date, o.date) AS date,
        {r('CASE WHEN o.symbol IS NULL THEN f.bb_upper ELSE o.bb_upper END', 4)} AS bb_upper,
        {r('f.bb_lower', 4)} AS bb_lower,
        {r('CASE WHEN o.symbol IS NULL THEN f.return_1d ELSE o.return_1d END', 6)} AS return_1d
        FROM f FULL JOIN o ON f.symbol = o.symbol AND f.date = o.date""",
    "upsert_predictions": f"""WITH {STATUS} SELECT coalesce(f.symbol, o.symbol) AS symbol,
        coalesce(f.date, o.date) + 1 AS prediction_date,
        {r('coalesce(o.close, f.close)', 4)} AS predicted_price,
        {r('coalesce(o.low, f.low)', 4)} AS confidence_lower,
        {r('coalesce(o.high, f.high)', 4)} AS confidence_upper,
        {r('coalesce(o.low / o.high, f.low / f.high)', 4)} AS confidence_score, 'v1' AS model_version,
        {r('coalesce(f.open, o.open)', 4)} AS sentiment_score,
        CASE WHEN f.symbol IS NOT NULL THEN 'F' ELSE 'O' END AS sentiment_label
        FROM bars_f f FULL JOIN bars_o o ON f.symbol = o.symbol AND f.date = o.date""",
    "latest_with_ttl": f"""WITH {TICKS} SELECT upper('price:' || symbol) AS key, timestamp, price,
        timestamp + INTERVAL 60 SECONDS AS expires_at FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, event_id DESC) AS k FROM ticks)
        WHERE k = 1 AND timestamp + INTERVAL 60 SECONDS > TIMESTAMP '2024-01-30 23:50:00'""",
    "naive_backtest": f"WITH {tested(NAIVE)}, {METRICS} SELECT * FROM metrics",
    "drift_backtest": f"WITH {tested(DRIFT)}, {METRICS} SELECT * FROM metrics",
    "backtest_flags": f"""WITH {tested(DRIFT)}, {METRICS} SELECT symbol, directional_accuracy > 55 AS accuracy_ok,
        strategy_sharpe > 0.5 AS sharpe_ok, final_equity > 1 AS equity_ok FROM metrics""",
    "equity_curve": f"""WITH {tested(DRIFT)} SELECT symbol, date, {r('sr', 6)} AS strategy_return,
        {r('''coalesce(product(1 + sr) OVER (PARTITION BY symbol ORDER BY tpos
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1)''', 4)} AS equity FROM test""",
    "chart_downsample": f"""WITH {tested(DRIFT)}, eqc AS (SELECT *,
        coalesce(product(1 + sr) OVER (PARTITION BY symbol ORDER BY tpos
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS eq FROM test)
        SELECT symbol, date, {r('target', 4)} AS actual, {r('pred', 4)} AS predicted, {r('eq', 4)} AS equity
        FROM eqc WHERE tpos % greatest(1, tn // 60) = 0""",
    "eval_metrics": f"""WITH {EVAL} SELECT evr.symbol, {r('avg(abs(actual - predicted))', 4)} AS mae,
        {r('sqrt(avg((actual - predicted) ** 2))', 4)} AS rmse,
        {r('1 - sum((actual - predicted) ** 2) / nullif(var_pop(actual) * count(*), 0)', 4)} AS r2,
        {r('avg(abs((actual - predicted) / nullif(actual, 0))) * 100', 2)} AS mape_pct,
        {r('avg(hit) * 100', 2)} AS directional_acc_pct,
        {r('CASE WHEN stddev_pop(sr) = 0 THEN 0 ELSE sqrt(252) * (avg(sr) - 0.05 / 252) / stddev_pop(sr) END', 4)}
          AS sharpe_ratio,
        {r('max(max_drawdown_pct)', 2)} AS max_drawdown_pct
        FROM evr JOIN dd ON evr.symbol = dd.symbol GROUP BY evr.symbol""",
    "dir_acc_diff": f"WITH {EVAL} SELECT symbol, {r('avg(hit) * 100', 4)} AS directional_acc_pct FROM evr GROUP BY symbol",
    "max_drawdown": f"WITH {EVAL} SELECT symbol, {r('max_drawdown_pct', 4)} AS max_drawdown_pct FROM dd",
    "sharpe_pop": f"""WITH {DRIFT}, s AS (SELECT symbol,
        CASE WHEN pred > close THEN (target - close) / nullif(close, 0) ELSE 0 END AS sr FROM preds)
        SELECT symbol, {r('CASE WHEN stddev_pop(sr) = 0 THEN 0 ELSE sqrt(252) * (avg(sr) - 0.05 / 252) / stddev_pop(sr) END', 4)}
        AS sharpe FROM s GROUP BY symbol""",
    "sharpe_sample": f"""WITH {DRIFT}, s AS (SELECT symbol,
        CASE WHEN pred > close THEN (target - close) / nullif(close, 0) ELSE 0 END AS sr FROM preds)
        SELECT symbol, {r(sharpe_s('sr'), 4)} AS sharpe FROM s GROUP BY symbol""",
    "retrain_summary": f"""WITH {tested(DRIFT)}, {METRICS} SELECT {r('avg(strategy_sharpe)', 4)} AS avg_sharpe,
        {r('avg(directional_accuracy)', 3)} AS avg_accuracy, count(*) AS symbols,
        (SELECT symbol FROM metrics ORDER BY strategy_sharpe DESC, symbol LIMIT 1) AS best_symbol,
        avg(strategy_sharpe) >= 0.8 AS promoted FROM metrics""",
    "align_positions": f"WITH {ALIGNED} SELECT symbol, date, rn, {r('close', 4)} AS close FROM aligned",
    "ann_mean_cov": f"""WITH {MOMENTS} SELECT asset_i, asset_j, {r('cov', 6)} AS cov, {r('ann_mean', 6)} AS ann_mean
        FROM cov JOIN mean ON symbol = asset_i""",
    "asset_sharpe": f"""WITH {ALIGNED} SELECT symbol, {r('''CASE WHEN stddev_samp(r) * sqrt(252) < 1e-10 THEN 0
        ELSE (avg(r) * 252 - 0.02) / (stddev_samp(r) * sqrt(252)) END''', 6)} AS sharpe FROM ret GROUP BY symbol""",
    "short_assets_reported": f"""WITH {CLEAN}, c AS (
        SELECT symbol, count(*) AS n FROM clean WHERE symbol <> 'NATION_7' OR date >= DATE '1998-11-20' GROUP BY symbol),
        g AS (SELECT *, CASE WHEN n < 60 THEN 'short' WHEN symbol = 'NATION_3' THEN 'price' ELSE 'used' END AS reason FROM c)
        SELECT symbol, CASE reason WHEN 'used'
          THEN least(252, (SELECT min(n) FROM g WHERE reason = 'used')) ELSE n END AS rows, reason FROM g""",
    "mc_weights": f"""WITH {weighted(10000)} SELECT CAST(portfolio AS INTEGER) AS portfolio, asset, {r('w', 8)} AS w
        FROM weights""",
    "equal_weight_sharpe": f"""WITH {ALIGNED}, p AS (
        SELECT rn, sum(r / (SELECT count(DISTINCT symbol) FROM ret)) AS p FROM ret GROUP BY rn)
        SELECT -1 AS portfolio, {r('(avg(p) * 252 - 0.02) / (stddev_samp(p) * sqrt(252))', 6)} AS sharpe FROM p""",
    "mc_portfolios": f"""WITH {MC} SELECT CAST(portfolio AS INTEGER) AS portfolio,
        {rounded({'ret': 6, 'vol': 6, 'sharpe': 6})} FROM mc""",
    "best_portfolio": f"""WITH {MC} SELECT CAST(portfolio AS INTEGER) AS portfolio,
        {rounded({'ret': 6, 'vol': 6, 'sharpe': 6})} FROM mc ORDER BY mc.sharpe DESC, mc.portfolio LIMIT 1""",
    "model_decisions": f"""WITH RECURSIVE {JUDGED} SELECT model_version, {r('avg_sharpe', 4)} AS avg_sharpe,
        {r('avg_accuracy', 3)} AS avg_accuracy, symbols, best_symbol, promoted FROM (
        SELECT * FROM judged_naive UNION ALL SELECT * FROM judged_drift UNION ALL SELECT * FROM judged_reversal)""",
    "batch_scoring": f"""WITH RECURSIVE {JUDGED}, {forecasts(60)} SELECT symbol, prediction_date, predicted_price,
        confidence_lower, confidence_upper, confidence_score, model_version, sentiment_score, sentiment_label
        FROM forecasts WHERE model_version = CASE WHEN (SELECT promoted FROM judged_reversal) THEN 'reversal'
          WHEN (SELECT promoted FROM judged_drift) THEN 'drift' ELSE 'naive' END""",
    "forecast_record": f"""WITH RECURSIVE {MATRIX}, {forecasts(10)} SELECT 'PREDICTION:' || upper(symbol) AS key,
        TIMESTAMP '1998-12-01 01:00:00' AS expires_at, * FROM forecasts WHERE model_version = 'reversal'""",
    "backtest_record": f"""WITH {tested(DRIFT)}, {METRICS}, eqc AS (SELECT *,
        coalesce(product(1 + sr) OVER (PARTITION BY symbol ORDER BY tpos
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS eq FROM test),
        charts AS (SELECT symbol, string_agg(date || '|' || {fixed(r('target', 4))} || '|' || {fixed(r('pred', 4))}
          || '|' || {fixed(r('eq', 4))}, ';' ORDER BY date) AS chart
          FROM eqc WHERE tpos % greatest(1, tn // 60) = 0 GROUP BY symbol)
        SELECT metrics.*, chart FROM metrics JOIN charts USING (symbol)""",
    "portfolio_record": f"""WITH one AS ({record()}), front AS (WITH {weighted(500)}, {moments_of('weights', 'mc')}
          SELECT string_agg({fixed(r('ret * 100', 2))} || '|' || {fixed(r('vol * 100', 2))}, ';' ORDER BY portfolio) AS frontier FROM mc)
        SELECT one.*, frontier FROM one, front""",
    "sentiment_record": f"""WITH {ARTICLES}, firsts AS (SELECT symbol, string_agg(t, ';' ORDER BY t) AS articles FROM (
          SELECT a.symbol, 'doc/' || doc_id || '|' || {fixed('sentiment_score')} || '|' || sentiment_label AS t,
            row_number() OVER (PARTITION BY a.symbol ORDER BY doc_id) AS k FROM articles a) WHERE k <= 15 GROUP BY symbol)
        SELECT persym.*, articles FROM persym JOIN firsts ON firsts.symbol = persym.symbol""",
    "model_scaling": f"""WITH RECURSIVE {BATCH_SCALED} SELECT symbol, date, part,
        {rounded({f'scaled_{c}': 6 for c in SCALES})} FROM bs""",
    "model_sequences": f"""WITH RECURSIVE {BATCH_SCALED} SELECT a.symbol, a.date, CAST(count(*) AS INTEGER) AS len,
        {len(SCALES) - 1} AS features,
        {r('sum((' + ' + '.join(f'b.scaled_{c}' for c in SCALES[:-1]) + ') * (b.pos - a.pos + 61))', 3)} AS checksum,
        {r('max(a.scaled_adjusted_close)', 6)} AS label
        FROM bs a JOIN bs b ON a.symbol = b.symbol AND b.pos BETWEEN a.pos - 60 AND a.pos - 1
        WHERE a.pos >= 60 GROUP BY a.symbol, a.date""",
    "upsert_sentiment": f"""WITH {DAILY_OF} SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.date, b.date) AS date,
        {r('coalesce(b.c, a.c)', 6)} AS sentiment_compound, {r('coalesce(b.p, a.p)', 6)} AS sentiment_positive,
        {r('a.g', 6)} AS sentiment_negative, coalesce(b.k, a.k) AS article_count
        FROM kept a FULL JOIN came b ON a.symbol = b.symbol AND a.date = b.date""",
    "run_log": f"""WITH {CLEAN}, t AS (SELECT count(*) AS stored FROM clean)
        SELECT 'batch' AS dag_id, 'r1' AS run_id, 'ok' AS status, stored AS rows_processed,
          CAST(NULL AS VARCHAR) AS error_message, stored FROM t
        UNION ALL SELECT 'batch', 'r2', 'failed', 0, 'validation failed', stored FROM t""",
    "portfolio_horizons": " UNION ALL ".join(
        f"SELECT {days} AS days, * FROM ({record(days)})" for days in (60, 126, 252, 504)),
    "frontier": f"""WITH {weighted(500)}, {moments_of('weights', 'mc')}, {FRONTIER}
        SELECT CAST(portfolio AS INTEGER) AS portfolio, ret, vol FROM front""",
    "frontier_csv": f"""WITH {BEST}, {FRONTIER}
        SELECT 'sample' AS type, vol AS volatility_pct, ret AS return_pct,
               {r('(ret / 100 - 0.02) / nullif(vol / 100, 0)', 3)} AS sharpe FROM front
        UNION ALL SELECT 'optimal', volatility, expected_return, sharpe FROM record
        UNION ALL SELECT 'equal_weight', eq_volatility, eq_return, eq_sharpe FROM record""",
    "headline_dedupe": f"""WITH {HEADLINES} SELECT symbol, date, url, CAST(length(headline) AS BIGINT) AS chars FROM (
        SELECT *, row_number() OVER (PARTITION BY symbol, headline ORDER BY date, doc_id) AS k FROM headlines)
        WHERE k = 1""",
    "feed_entries": f"""WITH {HEADLINES} SELECT symbol, date, url AS headline, headline AS summary, url,
        'feed' AS source FROM headlines WHERE date >= DATE '2024-01-23'""",
    "lexicon_score": f"""WITH {SCORED} SELECT doc_id, symbol, {rounded({c: 4 for c in (
        'sentiment_positive', 'sentiment_negative', 'sentiment_neutral', 'sentiment_compound')})} FROM scored""",
    "lexicon_default": f"""WITH {HEADLINES}, {scored(SHORT_POS, SHORT_NEG)}, {scored(LONG_POS, LONG_NEG, 'wide')}
        SELECT s.doc_id, {rounded({c: 4 for c in (
        'sentiment_positive', 'sentiment_negative', 'sentiment_neutral', 'sentiment_compound')}, 's.')},
        {r('w.sentiment_compound', 4)} AS long_compound FROM scored s JOIN wide w ON s.doc_id = w.doc_id""",
    "sentiment_daily": f"""WITH {DAILY} SELECT symbol, date, {rounded({c: 6 for c in (
        'sentiment_compound', 'sentiment_positive', 'sentiment_negative')})}, article_count FROM daily""",
    "latest_sentiment": f"""WITH {DAILY} SELECT symbol, date, {r('sentiment_compound', 6)} AS sentiment_compound,
        CASE WHEN sentiment_compound > 0.1 THEN 'Positive' WHEN sentiment_compound < -0.1 THEN 'Negative'
             ELSE 'Neutral' END AS label
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM daily) WHERE k = 1""",
    "article_scores": f"WITH {ARTICLES} SELECT doc_id, sentiment_score, sentiment_label FROM articles",
    "sentiment_symbol": f"WITH {ARTICLES} SELECT * FROM persym",
    "sentiment_counts": f"""WITH {ARTICLES} SELECT count(*) FILTER (WHERE aggregate_label = 'Bullish') AS bullish,
        count(*) FILTER (WHERE aggregate_label = 'Bearish') AS bearish,
        count(*) FILTER (WHERE aggregate_label = 'Neutral') AS neutral FROM persym""",
    "top15_articles": f"""WITH {HEADLINES} SELECT symbol, doc_id AS seq, headline AS title, symbol AS publisher, url,
        CAST(date AS VARCHAR) AS published_at FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY doc_id) AS k FROM headlines)
        WHERE k <= 15 AND lang <> 'de' AND headline <> ''""",
    "feature_sentiment": f"""WITH {IX}, {DAILY} SELECT ix.symbol, ix.date, {r('close', 4)} AS close,
        {r('sentiment_compound', 6)} AS sentiment_score
        FROM ix LEFT JOIN daily d ON ix.symbol = replace(d.symbol, 'src', 'NATION_')
          AND ix.date = DATE '1996-01-01' + CAST(d.date - DATE '2024-01-01' AS INTEGER)""",
    "confidence_band": f"""WITH {IX}, last AS (SELECT symbol, stddev_samp(close) AS sd, arg_max(close, date) AS cur
          FROM ix WHERE pos >= n - 20 GROUP BY symbol),
        band AS (SELECT symbol, cur, {r('cur * 1.01 - 1.96 * sd', 4)} AS lo, {r('cur * 1.01 + 1.96 * sd', 4)} AS hi FROM last)
        SELECT symbol, lo AS confidence_lower, hi AS confidence_upper,
          {r('greatest(0.0, least(1.0, 1 - CASE WHEN cur = 0 THEN 0.1 ELSE (hi - lo) / cur END))', 4)} AS confidence_score
        FROM band""",
    "blend": f"""WITH {SCALED} SELECT symbol, date,
        {r('(0.6 * sc + 0.4 * so) * CASE WHEN cr = 0 THEN 1 ELSE cr END + c0', 4)} AS price FROM scaled""",
    "forecast_signal": f"""WITH {IX} SELECT symbol, date, {r('close - open', 4)} AS change,
        {r('(close - open) / nullif(open, 0) * 100', 4)} AS change_pct,
        CASE WHEN close - open > 0 THEN 'Buy' ELSE 'Sell' END AS signal FROM ix WHERE pos = n - 1""",
    "missing_fields": f"WITH {MESSAGES} SELECT event_id, missing, price_ok, errors FROM judged",
    "tick_quality": f"""WITH {MESSAGES} SELECT count(*) AS checked, CAST(sum(errors) AS BIGINT) AS errors FROM judged""",
    "stream_quality": f"""WITH {MESSAGES} SELECT CAST(count(*) AS BIGINT) AS checked, CAST(sum(errors) AS BIGINT) AS errors FROM judged""",
    "parse_ticks": f"""WITH {TICKS} SELECT event_id, symbol, {rounded({'price': 4, 'bid': 4, 'ask': 4})}, volume,
        CAST(date_trunc('second', timestamp) AS TIMESTAMP) AS second, 'unknown' AS source FROM ticks""",
    "tick_bars": HOUR_BARS,
    "stream_tick_bars": HOUR_BARS,
    "latest_tick": LATEST_TICK,
    "stream_latest": LATEST_TICK,
    "stream_batches": f"SELECT *, true AS several FROM ({HOUR_BARS})",
    "stream_live_prices": f"""SELECT symbol, CASE WHEN live THEN price END AS price, timestamp, live FROM (
        SELECT *, timestamp + INTERVAL 60 SECONDS >= (SELECT max(ts) FROM events) - INTERVAL 10 SECONDS AS live
        FROM ({LATEST_TICK}))""",
    "topic_backlog": """WITH o AS (SELECT event_type AS topic, user_id, min(event_id) AS b, max(event_id) AS e
          FROM events GROUP BY 1, 2)
        SELECT topic, CAST(sum(greatest(0, e - b)) AS BIGINT) AS retained,
          CAST(sum(greatest(0, e - (b + (e - b) // 2))) AS BIGINT) AS lag,
          sum(greatest(0, e - b)) > 10000 AS alert FROM o GROUP BY topic""",
}
