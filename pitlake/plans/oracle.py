"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code: plain SQL over the same parquet
views, using DuckDB's own ``ASOF JOIN``, ``arg_max`` and ``quantile_cont``.
"""

from __future__ import annotations

EV = """
bars AS (
  SELECT user_id AS ticker, CAST(ts AS DATE) AS date, arg_min(value, ts) AS open, max(value) AS high,
         min(value) AS low, arg_max(value, ts) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2),
cal AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events),
cal_idx AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS idx FROM cal),
uni AS (SELECT DISTINCT user_id AS ticker FROM events),
grid AS (SELECT u.ticker, c.date FROM uni u CROSS JOIN cal c),
market AS (SELECT CAST(ts AS DATE) AS date, count(*) AS n_events, max(value) AS max_value FROM events GROUP BY 1),
signup AS (
  SELECT user_id AS ticker, CAST(ts AS DATE) AS date, arg_max(value, ts) AS signup_value, max(ts) AS signup_ts
  FROM events WHERE event_type = 'signup' GROUP BY 1, 2),
weekly AS (
  SELECT CAST(date_trunc('week', ts) AS DATE) + 6 AS date, max(value) AS max_purchase, count(*) AS n_purchases
  FROM events WHERE event_type = 'purchase' GROUP BY 1)
"""


def _labels_sql(grid: str, px: str, cal: str, horizons=(1, 5, 20)) -> str:
    """Labels over a grid(ticker, date), prices px(ticker, date, p) and calendar cal(date)."""
    sel, joins = [], []
    for h in horizons:
        sel.append(f"CASE WHEN p0.p IS NOT NULL AND p{h}.p IS NOT NULL AND p0.p <> 0 "
                   f"THEN greatest(-2000.0, least(2000.0, 10000 * (p{h}.p / p0.p - 1))) END AS r_{h}d")
        sel.append(f"CASE WHEN p0.p IS NULL OR p{h}.p IS NULL OR p0.p = 0 THEN 1 ELSE 0 END AS label_na_{h}d")
        joins.append(f"LEFT JOIN pxi p{h} ON p{h}.ticker = g.ticker AND p{h}.idx = ci.idx + {h}")
    return f"""
, ci_all AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS idx FROM (SELECT DISTINCT date FROM {cal}))
, pxi AS (SELECT x.ticker, c.idx, x.p FROM {px} x JOIN ci_all c USING (date))
SELECT g.ticker, g.date, {', '.join(sel)}
FROM {grid} g LEFT JOIN ci_all ci USING (date)
LEFT JOIN pxi p0 ON p0.ticker = g.ticker AND p0.idx = ci.idx
{chr(10).join(joins)}
"""


BARS_COLS = ("open", "high", "low", "close", "volume")

SQL: dict[str, str] = {}

SQL["bars"] = f"WITH {EV} SELECT * FROM bars"

SQL["base_grid"] = f"""WITH {EV} SELECT ticker, date FROM grid
WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-24'"""

SQL["join_daily"] = f"""WITH {EV}
SELECT g.ticker, g.date, {', '.join(f'b.{c} AS feat_{c}_bars' for c in BARS_COLS)}
FROM grid g LEFT JOIN bars b ON b.ticker = g.ticker AND b.date = g.date"""

SQL["join_market"] = f"""WITH {EV}
SELECT g.ticker, g.date, m.n_events AS feat_n_events_market, m.max_value AS feat_max_value_market
FROM grid g LEFT JOIN market m ON m.date = g.date"""

SQL["labels"] = f"WITH {EV}, px AS (SELECT ticker, date, close AS p FROM bars)" + _labels_sql("grid", "px", "cal")

SQL["labels_lineitem"] = """WITH
px AS (SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS p
       FROM lineitem GROUP BY 1, 2),
cal AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem),
grid AS (SELECT s_suppkey AS ticker, c.date FROM supplier CROSS JOIN cal c)""" + _labels_sql("grid", "px", "cal")

SQL["asof_keyed"] = f"""WITH {EV}
SELECT g.ticker, g.date, s.signup_value AS feat_signup_value_signup, s.signup_ts AS feat_signup_ts_signup,
       s.date AS effective_date_signup
FROM grid g ASOF LEFT JOIN signup s ON s.ticker = g.ticker AND g.date >= s.date"""

SQL["asof_market"] = f"""WITH {EV}
SELECT g.ticker, g.date, w.max_purchase AS feat_max_purchase_weekly, w.n_purchases AS feat_n_purchases_weekly,
       w.date AS effective_date_weekly
FROM grid g ASOF LEFT JOIN weekly w ON g.date >= w.date"""

SQL["asof_orders"] = """WITH
cal AS (SELECT min(CAST(o_orderdate AS DATE)) AS date FROM orders
        GROUP BY date_trunc('month', CAST(o_orderdate AS DATE))),
grid AS (SELECT c_custkey AS ticker, cal.date FROM customer CROSS JOIN cal),
src AS (SELECT o_custkey AS ticker, CAST(o_orderdate AS DATE) AS date, max(o_orderkey) AS o_orderkey,
               arg_max(o_totalprice, o_orderkey) AS o_totalprice, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus
        FROM orders GROUP BY 1, 2)
SELECT g.ticker, g.date, s.o_orderkey AS feat_o_orderkey_orders, s.o_totalprice AS feat_o_totalprice_orders,
       s.o_orderstatus AS feat_o_orderstatus_orders, s.date AS effective_date_orders
FROM grid g ASOF LEFT JOIN src s ON s.ticker = g.ticker AND g.date >= s.date"""

PANEL_SQL = f"""
SELECT g.ticker, g.date, {', '.join(f'b.{c} AS feat_{c}_bars' for c in BARS_COLS)},
       m.n_events AS feat_n_events_market, m.max_value AS feat_max_value_market,
       s.signup_value AS feat_signup_value_signup, s.signup_ts AS feat_signup_ts_signup,
       s.date AS effective_date_signup,
       w.max_purchase AS feat_max_purchase_weekly, w.n_purchases AS feat_n_purchases_weekly,
       w.date AS effective_date_weekly
FROM grid g
LEFT JOIN bars b ON b.ticker = g.ticker AND b.date = g.date
LEFT JOIN market m ON m.date = g.date
ASOF LEFT JOIN signup s ON s.ticker = g.ticker AND g.date >= s.date
ASOF LEFT JOIN weekly w ON g.date >= w.date"""

SQL["panel"] = f"WITH {EV} {PANEL_SQL}"

# ------------------------------------------------------------------ gold
LAB_CTE = """
ci_all AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS idx FROM cal),
pxi AS (SELECT b.ticker, c.idx, b.close AS p FROM bars b JOIN ci_all c USING (date)),
lab AS (
  SELECT g.ticker, g.date, """ + ", ".join(
    f"CASE WHEN p0.p IS NOT NULL AND p{h}.p IS NOT NULL AND p0.p <> 0 "
    f"THEN greatest(-2000.0, least(2000.0, 10000 * (p{h}.p / p0.p - 1))) END AS r_{h}d, "
    f"CASE WHEN p0.p IS NULL OR p{h}.p IS NULL OR p0.p = 0 THEN 1 ELSE 0 END AS label_na_{h}d"
    for h in (1, 5, 20)) + """
  FROM grid g LEFT JOIN ci_all ci USING (date)
  LEFT JOIN pxi p0 ON p0.ticker = g.ticker AND p0.idx = ci.idx
""" + "\n".join(f"  LEFT JOIN pxi p{h} ON p{h}.ticker = g.ticker AND p{h}.idx = ci.idx + {h}" for h in (1, 5, 20)) + ")"

GOLD_WITH = f"""WITH {EV}, {LAB_CTE},
pan AS ({PANEL_SQL}),
gold AS (SELECT pan.*, lab.r_1d, lab.label_na_1d, lab.r_5d, lab.label_na_5d, lab.r_20d, lab.label_na_20d
         FROM pan JOIN lab USING (ticker, date))
"""

SQL["gold"] = GOLD_WITH + "SELECT * FROM gold"
SQL["gold_unfused"] = SQL["gold"]

# (name, numeric?) of every gold column
GOLD_COLS = ([("ticker", True), ("date", False)] + [(f"feat_{c}_bars", True) for c in BARS_COLS] +
             [("feat_n_events_market", True), ("feat_max_value_market", True),
              ("feat_signup_value_signup", True), ("feat_signup_ts_signup", False), ("effective_date_signup", False),
              ("feat_max_purchase_weekly", True), ("feat_n_purchases_weekly", True), ("effective_date_weekly", False)] +
             [(f"{k}_{h}d", True) for h in (1, 5, 20) for k in ("r", "label_na")])

NL = "chr(10)"


def _feat_block():
    parts = [f"CASE WHEN feat_{n}_bars IS NOT NULL THEN '{n}=' || printf('%.6f', CAST(feat_{n}_bars AS DOUBLE)) END"
             for n in BARS_COLS]
    return f"concat_ws({NL}, {', '.join(parts)})"


_T = "'TICKER=' || CAST(ticker AS VARCHAR)"
_D = "'DATE=' || strftime(CAST(date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')"
_OUT = "CASE WHEN label_na_1d = 1 OR r_1d IS NULL THEN 'LABEL_NA=1' ELSE CAST(CAST(trunc(r_1d) AS BIGINT) AS VARCHAR) END"

SQL["export_cpt"] = GOLD_WITH + f"""SELECT {_T} || {NL} || {_D} || {NL} || 'FEATURES:' || {NL} || {_feat_block()}
  || {NL} || 'TARGET_RETURN_BPS_NEXT_1D:' || {NL} || {_OUT} AS text FROM gold"""

SQL["export_sft"] = GOLD_WITH + f"""SELECT
  'Based on the provided market data for a stock on a given day, predict the future return in basis points (bps) for the next 1 trading day(s).' AS Instruction,
  {_T} || {NL} || {_D} || {NL} || 'FEATURES:' || {NL} || {_feat_block()} AS Input,
  {_OUT} AS Output FROM gold"""

SQL["export_txt"] = GOLD_WITH + f"""SELECT {_T} || {NL} || {_D} || {NL} || {NL} || 'FEATURES:' || {NL} || {_feat_block()}
  || {NL} || {NL} || 'TARGET_RETURN_BPS_NEXT_1D:' || {NL} || {_OUT} || {NL} AS text FROM gold"""

_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) - count({c}) AS missing_count, "
    f"round(CAST(100.0 AS DOUBLE) * (count(*) - count({c})) / count(*), 2) AS missing_percentage FROM gold"
    for c, _ in GOLD_COLS)

_DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
  round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS "25%", round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS "50%",
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS "75%", CAST(max({c}) AS DOUBLE) AS max FROM gold"""
    for c, num in GOLD_COLS if num)

SQL["missing_report"] = GOLD_WITH + _MISSING
SQL["describe"] = GOLD_WITH + _DESCRIBE
SQL["stats_summary"] = GOLD_WITH + f""", d AS ({_DESCRIBE}), m AS ({_MISSING})
SELECT coalesce(d.column, m.column) AS column, d.count, d.mean, d.std, d.min, d."25%", d."50%", d."75%", d.max,
       m.missing_count, m.missing_percentage
FROM d FULL OUTER JOIN m ON d.column = m.column ORDER BY 1"""
SQL["label_na"] = GOLD_WITH + " UNION ALL ".join(
    f"SELECT 'label_na_{h}d' AS label_horizon, CAST(sum(label_na_{h}d) AS BIGINT) AS na_label_count FROM gold"
    for h in (1, 5, 20))
SQL["lookahead"] = GOLD_WITH + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(sum(CASE WHEN {c} > date THEN 1 ELSE 0 END) AS BIGINT) AS violations, "
    f"sum(CASE WHEN {c} > date THEN 1 ELSE 0 END) = 0 AS passed FROM gold"
    for c in ("effective_date_signup", "effective_date_weekly"))

# ------------------------------------------------------------ normalise
SQL["silver_orders"] = """SELECT o_orderkey, o_custkey AS ticker, o_orderstatus, o_totalprice AS amount, o_orderpriority,
  CAST(o_orderdate AS DATE) AS effective_date FROM orders"""

SQL["silver_union"] = """SELECT user_id, ts, CASE WHEN event_type = 'purchase' THEN value END AS amount,
  CASE WHEN event_type IN ('signup', 'error') THEN props END AS props, CASE WHEN event_type = 'view' THEN event_id END AS view_id,
  CASE WHEN event_type = 'click' THEN event_id END AS click_id, CASE WHEN event_type = 'error' THEN value END AS error_value
FROM events WHERE event_type IN ('purchase', 'signup', 'view', 'click', 'error')"""

CODES = """codes AS (
  SELECT l_orderkey, l_linenumber, code, code || CASE WHEN starts_with(code, '6') THEN '.SH' ELSE '.SZ' END AS ticker
  FROM (SELECT l_orderkey, l_linenumber,
               CASE WHEN length(c) < 6 THEN lpad(c, 6, '0') ELSE c END AS code
        FROM (SELECT *, CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS c FROM lineitem)))"""
SQL["exchange_code"] = f"WITH {CODES} SELECT * FROM codes"

SQL["dedupe_last"] = """SELECT ticker, date, l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM (
  SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber, l_extendedprice, l_quantity,
         row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
                            ORDER BY l_orderkey DESC, l_linenumber DESC) AS rn
  FROM lineitem) WHERE rn = 1"""

SQL["typed_features"] = f"WITH {EV} SELECT ticker, date, open, high, low, close, CAST(volume AS DOUBLE) AS volume FROM bars"

# ------------------------------------------------------------- manifest
from pitlake.sources.registry import SOURCES  # noqa: E402

REG_VALUES = ", ".join(f"('{i}', '{d}', '{s}')" for i, d, _, s, _, _ in SOURCES)


def _manifest_sql(cal_sql: str) -> str:
    return f"""SELECT interface_id, params_json, tid AS task_id, source_domain,
  'data_raw/source_domain=' || source_domain || '/interface=' || interface_id || '/date=' || replace(d, '-', '')
  || '/part-' || substr(tid, 1, 10) || '.parquet' AS output_path, 'pending' AS status
FROM (SELECT *, sha256(interface_id || '-' || params_json) AS tid FROM (
  SELECT r.interface_id, r.source_domain, x.d, '{{"date": "' || x.d || '"}}' AS params_json
  FROM (VALUES {REG_VALUES}) r(interface_id, source_domain, scope)
  CROSS JOIN (SELECT DISTINCT date FROM ({cal_sql})) c
  CROSS JOIN LATERAL (SELECT CASE WHEN r.interface_id LIKE '%stock_sse_deal_daily%'
                                    OR r.interface_id LIKE '%stock_notice_report%'
                                  THEN strftime(c.date, '%Y-%m-%d') ELSE strftime(c.date, '%Y%m%d') END AS d) x
  WHERE r.scope = 'market_wide_single_day'))"""


SHIP_CAL = "SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem"
ORDER_CAL = "SELECT CAST(o_orderdate AS DATE) AS date FROM orders"
SQL["full_manifest"] = _manifest_sql(SHIP_CAL)
SQL["pending_tasks"] = f"""WITH todo AS ({_manifest_sql(SHIP_CAL)}), done AS ({_manifest_sql(ORDER_CAL)})
SELECT * FROM todo WHERE task_id NOT IN (SELECT task_id FROM done)"""

_SD = {i: d for i, d, *_ in SOURCES}
SQL["replay_manifest"] = f"""WITH {CODES},
u AS (
  SELECT 'stock_zh_a_hist' AS interface_id, '{_SD["stock_zh_a_hist"]}' AS source_domain, ticker,
         'smoke_test_price_hist' AS scope, 'data_raw/bootstrap/price_' || replace(ticker, '.', '') || '.csv' AS replay_path,
         '{{"ticker": "' || ticker || '"}}' AS params_json
  FROM (SELECT DISTINCT ticker FROM codes)
  UNION ALL
  SELECT 'tool_trade_date_hist_sina', '{_SD["tool_trade_date_hist_sina"]}', NULL, 'market_wide_calendar',
         'data_raw/bootstrap/trading_calendar.csv', '{{}}')
SELECT interface_id, source_domain, ticker, scope, replay_path, params_json, tid AS task_id,
  'data_raw/source_domain=' || source_domain || '/interface=' || interface_id || '/date=static/part-'
  || substr(tid, 1, 10) || '.parquet' AS output_path, 'pending' AS status
FROM (SELECT *, sha256(interface_id || '-' || params_json) AS tid FROM u)"""

# ----------------------------------------------------------- treatments
SQL["winsorize"] = """WITH b AS (SELECT quantile_cont(l_extendedprice, 0.001) AS lo, quantile_cont(l_extendedprice, 0.999) AS hi
                    FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice,
       CASE WHEN l_extendedprice IS NOT NULL THEN greatest(b.lo, least(b.hi, l_extendedprice)) END AS l_extendedprice_w
FROM lineitem, b"""

SQL["fill"] = f"""WITH {EV}
SELECT g.ticker, g.date, b.open AS feat_open_bars, b.high AS feat_high_bars, b.low AS feat_low_bars,
       b.close AS feat_close_bars, coalesce(b.volume, 0) AS feat_volume_bars
FROM grid g LEFT JOIN bars b ON b.ticker = g.ticker AND b.date = g.date"""

SQL["ffill"] = f"""WITH {EV}
SELECT g.ticker, g.date, b.open AS feat_open_bars, b.high AS feat_high_bars, b.low AS feat_low_bars,
       last_value(b.close IGNORE NULLS) OVER (PARTITION BY g.ticker ORDER BY g.date
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS feat_close_bars,
       b.volume AS feat_volume_bars
FROM grid g LEFT JOIN bars b ON b.ticker = g.ticker AND b.date = g.date"""

SQL["split"] = f"""WITH {EV}
SELECT ticker, date, CASE
  WHEN date >= DATE '2019-12-30' AND date < DATE '2024-01-01' THEN 'train'
  WHEN date >= DATE '2024-01-03' AND date < DATE '2025-01-01' THEN 'validation'
  WHEN date >= DATE '2025-01-01' AND date <= DATE '2025-08-15' THEN 'test' END AS split
FROM grid"""

SQL["avail_shift"] = f"""WITH {EV}, ci AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS idx FROM cal),
m0 AS (SELECT m.*, (SELECT min(idx) FROM ci WHERE ci.date >= m.date) AS i0 FROM market m)
SELECT m0.date, m0.n_events, m0.max_value, c1.date AS eff_t1, c5.date AS eff_t5
FROM m0 LEFT JOIN ci c1 ON c1.idx = m0.i0 + 1 LEFT JOIN ci c5 ON c5.idx = m0.i0 + 5"""

SQL["avail_announce"] = """WITH cal AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)
SELECT o_orderkey, o_orderdate, (SELECT min(date) FROM cal WHERE cal.date >= CAST(o_orderdate AS DATE)) AS effective_date
FROM orders"""

SQL["calendar_enriched"] = """SELECT date, 1 AS is_trade, lag(date) OVER (ORDER BY date) AS prev_trade_date,
       lead(date) OVER (ORDER BY date) AS next_trade_date
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)"""

SQL["is_member"] = """SELECT o_custkey AS ticker, CAST(o_orderdate AS DATE) AS date, o_orderkey,
  CAST(CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) THEN 1 ELSE 0 END AS TINYINT) AS is_member
FROM orders"""

SQL["is_suspended"] = """WITH
spans AS (SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS s,
                 CASE WHEN NOT (l_linenumber = 7 AND l_quantity >= 49) THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) END AS e
          FROM lineitem WHERE l_returnflag = 'R'),
grid AS (SELECT s_suppkey AS ticker, date FROM supplier CROSS JOIN (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)),
open AS (SELECT g.ticker, g.date, count(*) AS n FROM grid g
         JOIN spans x ON x.ticker = g.ticker AND x.s <= g.date AND (x.e IS NULL OR x.e >= g.date) GROUP BY 1, 2)
SELECT g.ticker, g.date, CAST(CASE WHEN o.n > 0 THEN 1 ELSE 0 END AS TINYINT) AS is_suspended, coalesce(o.n, 0) AS n_open
FROM grid g LEFT JOIN open o ON o.ticker = g.ticker AND o.date = g.date"""

SQL["asof_restated"] = """WITH
cal AS (SELECT min(CAST(o_orderdate AS DATE)) AS date FROM orders
        GROUP BY date_trunc('month', CAST(o_orderdate AS DATE))),
rep AS (SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS known, CAST(date_trunc('quarter', CAST(o_orderdate AS DATE)) AS DATE) AS quarter,
               l_orderkey, l_linenumber, l_extendedprice AS price
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
grid AS (SELECT s_suppkey AS ticker, cal.date FROM supplier CROSS JOIN cal),
best AS (SELECT g.ticker, g.date, r.* EXCLUDE (ticker) FROM grid g JOIN rep r ON r.ticker = g.ticker AND r.known <= g.date
         QUALIFY row_number() OVER (PARTITION BY g.ticker, g.date ORDER BY quarter DESC, known DESC, l_orderkey DESC, l_linenumber DESC) = 1)
SELECT g.ticker, g.date, b.quarter AS feat_quarter_reports, b.l_orderkey AS feat_l_orderkey_reports,
       b.l_linenumber AS feat_l_linenumber_reports, b.price AS feat_price_reports, b.known AS effective_date_reports
FROM grid g LEFT JOIN best b ON b.ticker = g.ticker AND b.date = g.date"""

SQL["asof_events"] = """WITH s AS (
  SELECT user_id AS ticker, ts, arg_max(value, event_id) AS signup_value, max(event_id) AS signup_id
  FROM events WHERE event_type = 'signup' GROUP BY 1, 2)
SELECT e.event_id, e.user_id AS ticker, e.ts, s.signup_value AS feat_signup_value_signups,
       s.signup_id AS feat_signup_id_signups, s.ts AS effective_date_signups
FROM events e ASOF LEFT JOIN s ON e.user_id = s.ticker AND e.ts >= s.ts"""

SQL["union_drift"] = """
SELECT event_id, floor(value)::DOUBLE AS amount, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS at, NULL::VARCHAR AS ref FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, value, ts, NULL FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, NULL, NULL, CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, NULL, ts, props FROM events WHERE event_type = 'signup'"""

SQL["date_forms"] = """WITH l AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE l_linenumber
         WHEN 1 THEN strftime(d, '%Y%m%d') WHEN 2 THEN strftime(d, '%Y-%m-%d') WHEN 3 THEN strftime(d, '%Y/%-m/%-d')
         WHEN 4 THEN strftime(d, '%Y-%m') WHEN 5 THEN strftime(d, '%Y%m') WHEN 6 THEN strftime(d, '%Y年%-m月%-d日')
         WHEN 7 THEN strftime(d, '%Y-%m-%d') || ' 00:00:00' END AS written,
       CASE WHEN l_linenumber IN (4, 5) THEN CAST(date_trunc('month', d) AS DATE) WHEN l_linenumber <= 7 THEN d END AS effective_date
FROM l"""

SQL["panel_landed"] = """WITH
ln AS (SELECT *, lpad(CAST(l_suppkey AS VARCHAR), CAST(greatest(6, length(CAST(l_suppkey AS VARCHAR))) AS INTEGER), '0') AS code, CAST(l_shipdate AS DATE) AS date FROM lineitem),
l AS (SELECT *, code || CASE WHEN code LIKE '6%' THEN '.SH' ELSE '.SZ' END AS ticker FROM ln),
s0 AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(6, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS code FROM supplier),
uni AS (SELECT code || CASE WHEN code LIKE '6%' THEN '.SH' ELSE '.SZ' END AS ticker FROM s0),
cal AS (SELECT date, row_number() OVER (ORDER BY date) AS idx FROM (SELECT DISTINCT date FROM l)),
px AS (SELECT ticker, date, max(l_extendedprice) AS price, count(*) AS n FROM l GROUP BY 1, 2),
mk AS (SELECT n.date AS eff, m.lines, m.top_price FROM (SELECT date, count(*) AS lines, max(l_extendedprice) AS top_price FROM l GROUP BY 1) m
       JOIN cal c ON c.date = m.date JOIN cal n ON n.idx = c.idx + 1),
rp AS (SELECT ticker, date, max({'p': CAST(date_trunc('quarter', CAST(o_orderdate AS DATE)) AS DATE), 'd': date, 'o': l_orderkey,
                                 'n': l_linenumber, 'x': l_extendedprice, 's': CAST(l_suppkey AS VARCHAR)}) AS r
       FROM l JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
rq AS (SELECT ticker, date, max(r) OVER (PARTITION BY ticker ORDER BY date) AS r FROM rp),
rt AS (SELECT ticker, date, max({'o': l_orderkey, 'n': l_linenumber, 'x': l_extendedprice, 'q': l_quantity, 's': CAST(l_suppkey AS VARCHAR)}) AS r
       FROM l WHERE l_returnflag = 'R' GROUP BY 1, 2),
mm AS (SELECT last_day(CAST(o_orderdate AS DATE)) AS m, max(o_totalprice) AS top_order, count(*) AS n_orders FROM orders GROUP BY 1),
mc AS (SELECT eff, arg_max(top_order, m) AS top_order, arg_max(n_orders, m) AS n_orders
       FROM (SELECT *, (SELECT min(date) FROM cal WHERE date >= m) AS eff FROM mm) WHERE eff IS NOT NULL GROUP BY 1),
g AS (SELECT ticker, date FROM uni CROSS JOIN cal)
SELECT g.ticker, g.date, px.price AS feat_close_stock_zh_a_hist, px.n AS feat_volume_stock_zh_a_hist, px.price AS feat_adj_close_hfq_stock_zh_a_hist,
       px.date AS effective_date_stock_zh_a_hist,
       mk.lines AS feat_lines_stock_margin_sse, mk.top_price AS feat_top_price_stock_margin_sse, mk.eff AS effective_date_stock_margin_sse,
       rq.r.s AS feat_股票代码_stock_yjbb_em, rt.r.s AS feat_证券代码_stock_industry_change_cninfo,
       rq.r.o AS feat_l_orderkey_stock_yjbb_em, rq.r.n AS feat_l_linenumber_stock_yjbb_em, rq.r.x AS feat_price_stock_yjbb_em,
       rq.r.p AS feat_report_period_stock_yjbb_em, rq.r.d AS effective_date_stock_yjbb_em,
       rt.r.x AS feat_ret_price_stock_industry_change_cninfo, rt.r.q AS feat_ret_qty_stock_industry_change_cninfo,
       rt.r.o AS feat_l_orderkey_stock_industry_change_cninfo, rt.r.n AS feat_l_linenumber_stock_industry_change_cninfo,
       rt.date AS effective_date_stock_industry_change_cninfo,
       mc.top_order AS feat_top_order_macro_info_ws, mc.n_orders AS feat_n_orders_macro_info_ws, mc.eff AS effective_date_macro_info_ws
FROM g LEFT JOIN px ON px.ticker = g.ticker AND px.date = g.date LEFT JOIN mk ON mk.eff = g.date
ASOF LEFT JOIN rq ON rq.ticker = g.ticker AND rq.date <= g.date
ASOF LEFT JOIN rt ON rt.ticker = g.ticker AND rt.date <= g.date
ASOF LEFT JOIN mc ON mc.eff <= g.date"""

STREAM = """ev AS (SELECT *, CASE WHEN event_type IN ('view', 'signup', 'error') THEN 'shared'
                           ELSE CAST(user_id AS VARCHAR) END AS stream FROM events)"""

SQL["asof_hot"] = f"""WITH {STREAM},
s AS (SELECT stream, ts, arg_max(value, event_id) AS large, max(event_id) AS large_id FROM ev WHERE value >= 90 GROUP BY 1, 2)
SELECT e.event_id, e.stream, e.ts, s.large AS feat_large_stream, s.large_id AS feat_large_id_stream,
       s.ts AS effective_date_stream
FROM ev e ASOF LEFT JOIN s ON e.stream = s.stream AND e.ts >= s.ts"""

SQL["ffill_hot"] = f"""WITH {STREAM},
m AS (SELECT stream, ts, max(value) AS value FROM ev GROUP BY 1, 2)
SELECT stream, ts, value, last_value(CASE WHEN value >= 90 THEN value END IGNORE NULLS) OVER (
         PARTITION BY stream ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS large
FROM m"""

SQL["gold_lineitem"] = """WITH
bars AS (SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS price,
                count(*) AS n_lines FROM lineitem GROUP BY 1, 2),
cal AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem),
ci AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS idx FROM cal),
grid AS (SELECT s_suppkey AS ticker, c.date, c.idx FROM supplier CROSS JOIN ci c),
ret AS (SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date,
               arg_max(l_extendedprice, (l_orderkey, l_linenumber)) AS ret_price,
               arg_max(l_quantity, (l_orderkey, l_linenumber)) AS ret_qty,
               arg_max(l_orderkey, (l_orderkey, l_linenumber)) AS l_orderkey,
               arg_max(l_linenumber, (l_orderkey, l_linenumber)) AS l_linenumber
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
mkt AS (SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS lines, max(l_extendedprice) AS top_price
        FROM lineitem GROUP BY 1),
pxi AS (SELECT b.ticker, c.idx, b.price AS p FROM bars b JOIN ci c USING (date))
SELECT g.ticker, g.date, b.price AS feat_price_bars, b.n_lines AS feat_n_lines_bars,
       r.ret_price AS feat_ret_price_returns, r.ret_qty AS feat_ret_qty_returns,
       r.l_orderkey AS feat_l_orderkey_returns, r.l_linenumber AS feat_l_linenumber_returns,
       r.date AS effective_date_returns, m.lines AS feat_lines_market, m.top_price AS feat_top_price_market,
""" + ",\n".join(
    f"""       CASE WHEN p0.p IS NOT NULL AND p{h}.p IS NOT NULL AND p0.p <> 0
            THEN greatest(-2000.0, least(2000.0, 10000 * (p{h}.p / p0.p - 1))) END AS r_{h}d,
       CASE WHEN p0.p IS NULL OR p{h}.p IS NULL OR p0.p = 0 THEN 1 ELSE 0 END AS label_na_{h}d"""
    for h in (1, 5, 20)) + """
FROM grid g
LEFT JOIN bars b ON b.ticker = g.ticker AND b.date = g.date
LEFT JOIN mkt m ON m.date = g.date
LEFT JOIN pxi p0 ON p0.ticker = g.ticker AND p0.idx = g.idx
LEFT JOIN pxi p1 ON p1.ticker = g.ticker AND p1.idx = g.idx + 1
LEFT JOIN pxi p5 ON p5.ticker = g.ticker AND p5.idx = g.idx + 5
LEFT JOIN pxi p20 ON p20.ticker = g.ticker AND p20.idx = g.idx + 20
ASOF LEFT JOIN ret r ON r.ticker = g.ticker AND g.date >= r.date"""

# ------------------- gaps, missing and repeated prices, times, look-ahead
WEEKDAY = "dayofweek(date) NOT IN (0, 6)"
SHIP_BARS = """px AS (SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS p FROM lineitem GROUP BY 1, 2),
days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem),
cal AS (SELECT date FROM days WHERE dayofweek(date) NOT IN (0, 6)),
grid AS (SELECT s_suppkey AS ticker, d.date FROM supplier CROSS JOIN days d)"""

SQL["labels_gapped"] = f"WITH {SHIP_BARS}" + _labels_sql("grid", "px", "cal")

SQL["calendar_gapped"] = f"""SELECT date, 1 AS is_trade, lag(date) OVER (ORDER BY date) AS prev_trade_date,
       lead(date) OVER (ORDER BY date) AS next_trade_date
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem) WHERE {WEEKDAY}"""

WCAL = f"""wcal AS (SELECT date FROM cal WHERE {WEEKDAY}),
wci AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS idx FROM wcal),
wgrid AS (SELECT u.ticker, c.date, c.idx FROM uni u CROSS JOIN wci c)"""

SQL["avail_shift_gapped"] = f"""WITH {EV}, {WCAL},
m0 AS (SELECT m.*, (SELECT min(idx) FROM wci WHERE wci.date >= m.date) AS i0 FROM market m)
SELECT m0.date, m0.n_events, m0.max_value, c1.date AS eff_t1, c5.date AS eff_t5
FROM m0 LEFT JOIN wci c1 ON c1.idx = m0.i0 + 1 LEFT JOIN wci c5 ON c5.idx = m0.i0 + 5"""

SQL["gold_gapped"] = f"""WITH {EV}, {WCAL}, pxi AS (SELECT b.ticker, c.idx, b.close AS p FROM bars b JOIN wci c USING (date))
SELECT g.ticker, g.date, {', '.join(f'b.{c} AS feat_{c}_bars' for c in BARS_COLS)},
       s.signup_value AS feat_signup_value_signup, s.signup_ts AS feat_signup_ts_signup, s.date AS effective_date_signup,
       w.max_purchase AS feat_max_purchase_weekly, w.n_purchases AS feat_n_purchases_weekly, w.date AS effective_date_weekly,
""" + ", ".join(
    f"CASE WHEN p0.p IS NOT NULL AND p{h}.p IS NOT NULL AND p0.p <> 0 "
    f"THEN greatest(-2000.0, least(2000.0, 10000 * (p{h}.p / p0.p - 1))) END AS r_{h}d, "
    f"CASE WHEN p0.p IS NULL OR p{h}.p IS NULL OR p0.p = 0 THEN 1 ELSE 0 END AS label_na_{h}d" for h in (1, 5, 20)) + """
FROM wgrid g LEFT JOIN bars b ON b.ticker = g.ticker AND b.date = g.date
LEFT JOIN pxi p0 ON p0.ticker = g.ticker AND p0.idx = g.idx
""" + "\n".join(f"LEFT JOIN pxi p{h} ON p{h}.ticker = g.ticker AND p{h}.idx = g.idx + {h}" for h in (1, 5, 20)) + """
ASOF LEFT JOIN signup s ON s.ticker = g.ticker AND g.date >= s.date
ASOF LEFT JOIN weekly w ON g.date >= w.date"""

SQL["labels_nan"] = f"""WITH {EV},
bad AS (SELECT DISTINCT user_id AS ticker, CAST(ts AS DATE) AS date FROM events WHERE event_type = 'error'),
px AS (SELECT b.ticker, b.date, CASE WHEN x.ticker IS NOT NULL THEN NULL WHEN b.volume = 1 THEN 0.0 ELSE b.close END AS p
       FROM bars b LEFT JOIN bad x ON x.ticker = b.ticker AND x.date = b.date)""" + _labels_sql("grid", "px", "cal")

SQL["labels_dup"] = """WITH
px AS (SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date, arg_max(l_extendedprice, (l_orderkey, l_linenumber)) AS p
       FROM lineitem GROUP BY 1, 2),
cal AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem),
grid AS (SELECT s_suppkey AS ticker, c.date FROM supplier CROSS JOIN cal c)""" + _labels_sql("grid", "px", "cal")

SQL["asof_market_ts"] = """WITH s AS (
  SELECT ts, arg_max(value, event_id) AS error_value, max(event_id) AS error_id FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT e.event_id, e.ts, s.error_id AS feat_error_id_errors, s.error_value AS feat_error_value_errors, s.ts AS effective_date_errors
FROM events e ASOF LEFT JOIN s ON e.ts >= s.ts"""

SQL["asof_day_time"] = f"""WITH {EV}, s AS (
  SELECT user_id AS ticker, CAST(ts AS DATE) AS day, arg_max(value, (ts, event_id)) AS signup_value,
         arg_max(event_id, (ts, event_id)) AS signup_id, max(ts) AS ts
  FROM events WHERE event_type = 'signup' GROUP BY 1, 2)
SELECT g.ticker, g.date, s.signup_value AS feat_signup_value_signups, s.signup_id AS feat_signup_id_signups,
       s.ts AS effective_date_signups
FROM grid g ASOF LEFT JOIN s ON s.ticker = g.ticker AND g.date >= s.day"""

SQL["panel_available"] = f"""WITH {EV}, {WCAL},
m0 AS (SELECT m.*, (SELECT min(idx) FROM wci WHERE wci.date >= m.date) + 1 AS i FROM market m),
m1 AS (SELECT c.date AS eff, arg_max(n_events, m0.date) AS n_events, arg_max(max_value, m0.date) AS max_value
       FROM m0 JOIN wci c ON c.idx = m0.i GROUP BY 1),
b0 AS (SELECT b.*, (SELECT min(wcal.date) FROM wcal WHERE wcal.date >= b.date) AS eff FROM bars b),
b1 AS (SELECT * FROM b0 WHERE eff IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker, eff ORDER BY date DESC) = 1)
SELECT g.ticker, g.date, {', '.join(f'b.{c} AS feat_{c}_bars' for c in BARS_COLS)}, b.eff AS effective_date_bars,
       m.n_events AS feat_n_events_market, m.max_value AS feat_max_value_market, m.eff AS effective_date_market
FROM wgrid g LEFT JOIN b1 b ON b.ticker = g.ticker AND b.eff = g.date LEFT JOIN m1 m ON m.eff = g.date"""

SQL["lookahead_violations"] = f"""WITH {EV}, {WCAL},
m0 AS (SELECT m.date, (SELECT min(idx) FROM wci WHERE wci.date >= m.date) + 1 AS i FROM market m),
j AS (SELECT g.date, c.date AS eff FROM wgrid g LEFT JOIN m0 ON m0.date = g.date LEFT JOIN wci c ON c.idx = m0.i)
SELECT 'effective_date_market' AS column, CAST(sum(CASE WHEN eff > date THEN 1 ELSE 0 END) AS BIGINT) AS violations,
       sum(CASE WHEN eff > date THEN 1 ELSE 0 END) = 0 AS passed FROM j"""

SQL["split_inside"] = """SELECT date, CASE
  WHEN date >= DATE '1993-01-01' AND date < DATE '1995-01-01' THEN 'train'
  WHEN date >= DATE '1995-01-03' AND date < DATE '1997-01-01' THEN 'validation'
  WHEN date >= DATE '1997-01-01' AND date <= DATE '1998-06-30' THEN 'test' END AS split
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)"""
