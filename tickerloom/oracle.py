"""The same results as plain SQL for an independent engine, one statement per query.

Each statement is a chain of common table expressions from the raw tables up. Zero denominators
become NULL, an undefined correlation becomes NULL, and inexact statistics keep six decimals.
"""

from __future__ import annotations

from .bindings import BRANDS

_MARKET, _SECTOR = "Brand#1", "Brand#2"

_LINES = """lines AS (
  SELECT p_brand AS symbol, CAST(l_partkey AS VARCHAR) AS part,
         CAST(l_shipdate AS DATE) AS date, l_quantity AS quantity,
         l_orderkey AS o, l_linenumber AS n, round(l_extendedprice * 100) AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _bars(symbol: str) -> str:
    return f"""{_LINES}, bars AS (
  SELECT {symbol} AS symbol, date,
         min({{'o': o, 'n': n, 'p': price}}).p AS open, max(price) AS high, min(price) AS low,
         max({{'o': o, 'n': n, 'p': price}}).p AS close, CAST(sum(quantity) AS BIGINT) AS volume
  FROM lines GROUP BY 1, 2)"""


_OBS = """obs AS (
  SELECT 'CPIAUCSL' AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         max(o_totalprice) AS value
  FROM orders GROUP BY 2
  UNION ALL
  SELECT 'FEDFUNDS', CAST(date_trunc('month', o_orderdate) AS DATE), CAST(count(*) AS DOUBLE)
  FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderdate >= DATE '1995-04-01' GROUP BY 2
  UNION ALL
  SELECT 'DGS10', CAST(o_orderdate AS DATE), min(o_totalprice)
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 2)"""


def _known(frame: str, columns: str) -> str:
    """``frame`` as-of joined with the three series."""
    return f"""SELECT {columns}, c.value AS cpi, f.value AS "fedFundsRate", t.value AS treasury10y
  FROM {frame} b
  ASOF LEFT JOIN (SELECT * FROM obs WHERE series_id = 'CPIAUCSL') c ON b.date >= c.date
  ASOF LEFT JOIN (SELECT * FROM obs WHERE series_id = 'FEDFUNDS') f ON b.date >= f.date
  ASOF LEFT JOIN (SELECT * FROM obs WHERE series_id = 'DGS10') t ON b.date >= t.date"""


def _features(symbol: str) -> str:
    return f"""{_bars(symbol)}, {_OBS}, silver AS ({_known('bars', 'b.*')}), step AS (
  SELECT *, close - lag(close) OVER w AS move,
         close / NULLIF(lag(close, 1) OVER w, 0) - 1 AS return_1d,
         close / NULLIF(lag(close, 5) OVER w, 0) - 1 AS return_5d,
         close / NULLIF(lag(close, 21) OVER w, 0) - 1 AS return_21d,
         close / NULLIF(lag(close, 63) OVER w, 0) - 1 AS return_63d,
         avg(close) OVER (w ROWS 19 PRECEDING) AS sma_20,
         avg(close) OVER (w ROWS 49 PRECEDING) AS sma_50,
         avg(close) OVER (w ROWS 199 PRECEDING) AS sma_200,
         avg(volume) OVER (w ROWS 19 PRECEDING) AS usual_volume,
         max(high) OVER (w ROWS 251 PRECEDING) AS peak,
         cpi / NULLIF(lag(cpi, 21) OVER w, 0) - 1 AS cpi_chg_1m,
         "fedFundsRate" - lag("fedFundsRate") OVER w AS fed_funds_chg,
         treasury10y - lag(treasury10y) OVER w AS treasury10y_chg
  FROM silver WINDOW w AS (PARTITION BY symbol ORDER BY date)
), derived AS (
  SELECT *, stddev_samp(return_1d) OVER (w ROWS 20 PRECEDING) AS vol_21d,
         stddev_samp(return_1d) OVER (w ROWS 62 PRECEDING) AS vol_63d,
         avg(CASE WHEN move > 0 THEN move ELSE 0.0::DOUBLE END) OVER (w ROWS 13 PRECEDING) AS up,
         avg(CASE WHEN move < 0 THEN -move ELSE 0.0::DOUBLE END) OVER (w ROWS 13 PRECEDING) AS down
  FROM step WINDOW w AS (PARTITION BY symbol ORDER BY date)
), gold AS (
  SELECT symbol, date, open, high, low, close, volume, cpi, "fedFundsRate", treasury10y,
         return_1d, return_5d, return_21d, return_63d, sma_20, sma_50, sma_200,
         close / NULLIF(sma_20, 0) - 1 AS dist_sma_20, close / NULLIF(sma_50, 0) - 1 AS dist_sma_50,
         close / NULLIF(sma_200, 0) - 1 AS dist_sma_200,
         vol_21d, vol_63d, vol_21d * sqrt(252) AS vol_ann_21d,
         volume / NULLIF(usual_volume, 0) AS volume_rel_20d,
         CASE WHEN down = 0 THEN 100.0::DOUBLE ELSE 100 - 100 / (1 + up / down) END AS rsi_14,
         close / NULLIF(peak, 0) - 1 AS drawdown_252d,
         cpi_chg_1m, fed_funds_chg, treasury10y_chg
  FROM derived)"""


_GOLD = _features("symbol")


def _snapshot(name: str, where: str) -> str:
    return f"""{name} AS (
  SELECT symbol, date AS as_of_date, close AS last_close, return_21d AS return_1m,
         return_63d AS return_3m, vol_ann_21d AS vol_ann_1m, rsi_14, drawdown_252d,
         dist_sma_50, dist_sma_200, cpi, "fedFundsRate", treasury10y
  FROM gold WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1)"""


_SUMMARY = f"{_GOLD}, {_snapshot('summary', 'TRUE')}"
_ETF = "symbol IN ('Brand#2', 'Brand#3', 'Brand#4', 'Brand#5')"
_ASSET = f"CASE WHEN {_ETF} THEN 'ETF' ELSE 'STOCK' END AS asset_type"
_RECENT = f"""{_GOLD}, recent AS (
  SELECT symbol, {_ASSET},
         CASE WHEN symbol IN ('Brand#5', 'Brand#6', 'Brand#7', 'Brand#8') THEN 'Semiconductors'
              ELSE 'Tech (broad)' END AS sector,
         date, close, volume, return_1d, return_21d, vol_ann_21d, rsi_14, dist_sma_50,
         dist_sma_200, drawdown_252d, cpi, "fedFundsRate", treasury10y
  FROM gold WHERE date >= (SELECT max(date) FROM gold) - INTERVAL 2 YEAR)"""
_COMPARISON = f"""{_RECENT}, comparison AS (
  SELECT c.* EXCLUDE (volume), e.return_1d AS sector_return_1d, e.return_21d AS sector_return_21d,
         c.return_1d - e.return_1d AS alpha_1d, c.return_21d - e.return_21d AS alpha_21d
  FROM recent c LEFT JOIN (SELECT * FROM recent WHERE symbol = '{_SECTOR}') e USING (date))"""


def _corr(a: str, b: str) -> str:
    return f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END"


_PAIRS = f"""{_GOLD}, pairs AS (
  SELECT a.symbol AS symbol_a, b.symbol AS symbol_b,
         {_corr('a.return_1d', 'b.return_1d')} AS correlation
  FROM gold a JOIN gold b ON a.date = b.date AND a.symbol < b.symbol
  WHERE a.return_1d IS NOT NULL AND b.return_1d IS NOT NULL GROUP BY 1, 2)"""

_BESIDE = f"""{_GOLD}, beside AS (
  SELECT a.symbol, a.return_1d AS r, s.return_1d AS m
  FROM gold a JOIN gold s ON a.date = s.date AND s.symbol = '{_MARKET}'
  WHERE a.symbol <> '{_MARKET}')"""
_BETA = "covar_samp(r, m) / NULLIF(var_samp(m), 0)"
_REGIMES = f"""{_GOLD}, regimes AS (
  SELECT symbol, CASE WHEN fed_funds_chg > 0 THEN 'tightening' WHEN fed_funds_chg < 0 THEN 'easing'
                      ELSE 'stable' END AS regime, avg(return_1d) AS avg_return, count(*) AS days
  FROM gold WHERE fed_funds_chg IS NOT NULL GROUP BY 1, 2)"""
_EVENT = "volume_rel_20d > 2.0 AND abs(return_1d) > 0.03"


def _rounded(*columns: str) -> str:
    return "* REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in columns) + ")"


_VOL = _rounded("vol_21d", "vol_63d", "vol_ann_21d")


def _wide(value: str, by: str, names: list[str]) -> str:
    return ", ".join(f"max(CASE WHEN {by} = '{n}' THEN {value} END) AS \"{n}\"" for n in names)


def _checks(frame: str, required: list[str], bars: bool) -> str:
    """One row per check over ``frame``."""
    nulls = " OR ".join(f"{c} IS NULL" for c in required)
    counts = {
        "no_duplicates_in(symbol,date)":
            f"(SELECT count(*) FROM (SELECT 1 FROM {frame} GROUP BY symbol, date HAVING count(*) > 1))",
        f"no_nulls_in({','.join(required)})":
            f"(SELECT count(*) FROM {frame} WHERE {nulls})",
        "positive_prices":
            f"(SELECT count(*) FROM {frame} WHERE open <= 0 OR high <= 0 OR low <= 0 OR close <= 0)",
    }
    if bars:
        counts["high_greater_or_equal_low"] = f"(SELECT count(*) FROM {frame} WHERE high < low)"
        counts["non_negative_volume"] = f"(SELECT count(*) FROM {frame} WHERE volume < 0)"
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", {count} AS violating_rows" for name, count in counts.items()
    )
    return f"""SELECT "check", violating_rows, violating_rows = 0 AS passed,
       CASE WHEN violating_rows = 0 THEN 'OK'
            ELSE 'FAILED (' || violating_rows || ' rows)' END AS status FROM ({rows})"""


_FULL = ["symbol", "date", "open", "high", "low", "close"]
_TICKS = """ticks AS (
  SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date,
         round(l_extendedprice * 100) AS open, p_retailprice * 100 AS high,
         round(l_extendedprice * 100) AS low, round(l_extendedprice * 100) AS close,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS volume
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_ALPHA = """SELECT symbol, round(avg(alpha_1d), 6) AS avg_daily_alpha,
       round(stddev_samp(alpha_1d), 6) AS alpha_volatility"""
_BARS = _bars("symbol")
_SILVER = f"{_BARS}, {_OBS}, silver AS ({_known('bars', 'b.*')})"


def _gold_columns(*columns: str) -> str:
    picked = ", ".join(
        f"round({c}, 6) AS {c}" if c.startswith("vol_") else c for c in columns
    )
    return f"WITH {_GOLD} SELECT symbol, date, {picked} FROM gold"


ORACLE: dict[str, str] = {
    "bars": f"WITH {_BARS} SELECT * FROM bars",
    "macro_observations": f"WITH {_OBS} SELECT * FROM obs",
    "macro_wide": f"""WITH {_OBS} SELECT date,
       max(CASE WHEN series_id = 'CPIAUCSL' THEN value END) AS cpi,
       max(CASE WHEN series_id = 'FEDFUNDS' THEN value END) AS "fedFundsRate",
       max(CASE WHEN series_id = 'DGS10' THEN value END) AS treasury10y FROM obs GROUP BY date""",
    "macro_asof": f"""WITH {_BARS}, {_OBS}, days AS (SELECT DISTINCT date FROM bars)
       {_known('days', 'b.date')}""",
    "silver_price_with_macro": f"WITH {_SILVER} SELECT * FROM silver",
    "returns": _gold_columns("return_1d", "return_5d", "return_21d", "return_63d"),
    "moving_averages": _gold_columns(
        "sma_20", "sma_50", "sma_200", "dist_sma_20", "dist_sma_50", "dist_sma_200"
    ),
    "volatility": _gold_columns("vol_21d", "vol_63d", "vol_ann_21d"),
    "relative_volume": _gold_columns("volume_rel_20d"),
    "rsi": _gold_columns("rsi_14"),
    "drawdown": _gold_columns("drawdown_252d"),
    "macro_changes": _gold_columns("cpi_chg_1m", "fed_funds_chg", "treasury10y_chg"),
    "daily_features": f"WITH {_GOLD} SELECT {_VOL} FROM gold",
    "daily_features_part": f"WITH {_features('part')} SELECT {_VOL} FROM gold",
    "symbol_summary": f"WITH {_SUMMARY} SELECT {_rounded('vol_ann_1m')} FROM summary",
    "leaderboard": f"""WITH {_SUMMARY}
       SELECT symbol, {_ASSET}, as_of_date, last_close, return_1m, return_3m,
              round(vol_ann_1m, 6) AS vol_ann_1m, rsi_14, drawdown_252d, dist_sma_50, dist_sma_200,
              rank() OVER (ORDER BY return_1m DESC NULLS LAST) AS rank_return_1m,
              rank() OVER (ORDER BY summary.vol_ann_1m ASC NULLS LAST) AS rank_lowest_vol
       FROM summary""",
    "daily_leaderboard": f"""WITH {_GOLD} SELECT symbol, date, return_21d,
       rank() OVER (ORDER BY return_21d DESC NULLS LAST) AS rank_return_1m FROM gold""",
    "daily_recent": f"WITH {_RECENT} SELECT {_rounded('vol_ann_21d')} FROM recent",
    "sector_comparison": f"WITH {_COMPARISON} SELECT {_rounded('vol_ann_21d')} FROM comparison",
    "return_correlation": f"WITH {_PAIRS} SELECT {_rounded('correlation')} FROM pairs",
    "capm_beta": f"""WITH {_BESIDE} SELECT symbol, round({_BETA}, 6) AS beta,
       round({_corr('r', 'm')}, 6) AS correlation_to_spy,
       round(avg(r) - avg(m), 6) AS naive_alpha FROM beside GROUP BY symbol""",
    "rate_regime": f"WITH {_REGIMES} SELECT {_rounded('avg_return')} FROM regimes",
    "sector_alpha": f"WITH {_COMPARISON} {_ALPHA} FROM comparison GROUP BY symbol",
    "event_screen": f"""WITH {_GOLD} SELECT symbol, date, close, return_1d, volume_rel_20d,
       round(vol_ann_21d, 6) AS vol_ann_21d FROM gold WHERE {_EVENT}""",
    "mean_reversion": f"""WITH {_GOLD}
       SELECT symbol, date, close, rsi_14, dist_sma_50, dist_sma_200 FROM gold
       WHERE (rsi_14 < 30 OR rsi_14 > 70) AND abs(dist_sma_50) > 0.10""",
    "tail_risk": f"""WITH {_BESIDE} SELECT symbol,
       round(avg(r) FILTER (WHERE m < -0.01), 6) AS avg_return_on_bad_market_days,
       count(*) FILTER (WHERE m < -0.01) AS bad_days FROM beside GROUP BY symbol""",
    "returns_wide": f"""WITH {_GOLD} SELECT date, {_wide('return_1d', 'symbol', BRANDS)}
       FROM gold WHERE return_1d IS NOT NULL GROUP BY date""",
    "correlation_matrix": f"""WITH {_PAIRS} SELECT symbol_b AS row_symbol,
       symbol_a AS column_symbol, round(correlation, 6) AS correlation FROM pairs""",
    "correlation_range": f"""WITH {_PAIRS} SELECT round(min(correlation), 6) AS min_correlation,
       round(max(correlation), 6) AS max_correlation FROM pairs""",
    "beta_flagged": f"""WITH {_BESIDE} SELECT symbol, round({_BETA}, 6) AS beta,
       coalesce({_BETA} > 1, FALSE) AS above_market FROM beside GROUP BY symbol""",
    "regime_wide": f"""WITH {_REGIMES} SELECT symbol,
       {_wide('round(avg_return, 6)', 'regime', ['easing', 'stable', 'tightening'])}
       FROM regimes GROUP BY symbol""",
    "alpha_flagged": f"""WITH {_COMPARISON} {_ALPHA},
       coalesce(avg(alpha_1d) > 0, FALSE) AS positive FROM comparison GROUP BY symbol""",
    "event_labels": f"""WITH {_GOLD} SELECT symbol, date, return_1d, volume_rel_20d,
       {_EVENT} AS is_event FROM gold
       WHERE volume_rel_20d IS NOT NULL AND return_1d IS NOT NULL""",
    "bad_day_returns": f"""WITH {_BESIDE} SELECT symbol,
       round(avg(r) FILTER (WHERE m < -0.01), 6) AS avg_return_on_bad_days
       FROM beside GROUP BY symbol""",
    "silver_quality": f"WITH {_BARS} {_checks('bars', _FULL, True)}",
    "tick_quality": f"WITH {_TICKS} {_checks('ticks', _FULL, True)}",
    "gold_quality": f"WITH {_GOLD} {_checks('gold', ['symbol', 'date', 'close'], False)}",
    "upsert_daily": f"""WITH {_SILVER}, newest AS (SELECT max(date) AS d FROM silver)
       SELECT s.* FROM silver s, newest WHERE date <= d - INTERVAL 2 MONTH
       UNION ALL
       SELECT s.* REPLACE (volume + 1 AS volume) FROM silver s, newest
       WHERE date > d - INTERVAL 2 MONTH""",
    "upsert_summary": f"""WITH {_GOLD}, newest AS (SELECT max(date) AS d FROM gold),
       {_snapshot('fresh', 'date = (SELECT d FROM newest)')},
       {_snapshot('old', 'date <= (SELECT d FROM newest) - INTERVAL 1 MONTH')}
       SELECT {_rounded('vol_ann_1m')} FROM (
         SELECT * FROM fresh UNION ALL
         SELECT * FROM old WHERE symbol NOT IN (SELECT symbol FROM fresh))""",
    "silver_job": f"WITH {_SILVER} SELECT * FROM silver",
    "gold_job": f"WITH {_GOLD} SELECT {_VOL} FROM gold",
    "silver_stream": f"WITH {_SILVER} SELECT * FROM silver",
    "bronze_prices": f"WITH {_BARS} SELECT * FROM bars",
    "bronze_macro": f"WITH {_OBS} SELECT * FROM obs",
    "bronze_rejected": """SELECT 'prices' AS kind, 'error answer' AS reason, '404' AS code,
         'symbol not found: ' || s_name AS message, count(*) AS documents
       FROM supplier GROUP BY s_name
       UNION ALL
       SELECT 'prices', 'unreadable', NULL, NULL, count(*) FROM nation HAVING count(*) > 0
       UNION ALL
       SELECT 'macro', 'unreadable', NULL, NULL, count(*) FROM region HAVING count(*) > 0
       UNION ALL
       SELECT 'macro', 'no data', NULL, NULL, count(*) FROM nation HAVING count(*) > 0""",
}

# The views that SQL users query hold what the queries of the same content hold.
ORACLE |= {f"view_{name}": ORACLE[query] for name, query in {
    "silver_price_with_macro": "silver_price_with_macro", "gold_daily_features": "daily_features",
    "gold_symbol_summary": "symbol_summary", "gold_daily_recent": "daily_recent",
    "gold_sector_comparison": "sector_comparison", "gold_leaderboard": "leaderboard",
}.items()}
ORACLE["gold_incremental"] = ORACLE["gold_stream"] = ORACLE["daily_features"]
ORACLE["macro_point_in_time"] = f"""WITH {_BARS}, {_OBS}, told AS (
  SELECT series_id, date, value,
         date + CASE WHEN series_id = 'DGS10' THEN 1 ELSE (10 + dayofyear(date) % 7)::INT END AS published FROM obs
  UNION ALL SELECT series_id, date, value + 0.5, date + 40 FROM obs WHERE month(date) % 3 = 0
), known AS (
  SELECT d.date, t.series_id, t.value FROM (SELECT DISTINCT date FROM bars) d JOIN told t ON greatest(t.published, t.date) <= d.date
  QUALIFY row_number() OVER (PARTITION BY d.date, t.series_id ORDER BY t.date DESC, t.published DESC, t.value DESC) = 1
) SELECT d.date, max(value) FILTER (WHERE series_id = 'CPIAUCSL') AS cpi,
         max(value) FILTER (WHERE series_id = 'FEDFUNDS') AS "fedFundsRate", max(value) FILTER (WHERE series_id = 'DGS10') AS treasury10y
  FROM (SELECT DISTINCT date FROM bars) d LEFT JOIN known k ON k.date = d.date GROUP BY d.date"""
ORACLE["correlation_kept"] = ORACLE["correlation_matrix"]
