"""The adapter views in SQL, for the oracle."""

from __future__ import annotations

from catalog.registry import view

view("lines", """
SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) AS qty,
       l_extendedprice / l_quantity AS price
FROM lineitem""")

view("bars", """
SELECT security_id, trade_date, coalesce(CASE WHEN open_qty > 0 THEN open_cents / 100::DOUBLE / open_qty END, close) AS open,
       high, low, close, volume, traded_value, delivery_qty
FROM (SELECT l_partkey % 50 AS security_id, CAST(date_trunc('week', l_shipdate) AS DATE) AS trade_date,
             max(price) AS high, min(price) AS low, CAST(sum(qty) AS BIGINT) AS volume,
             sum(cents)::DOUBLE / 100::DOUBLE AS traded_value,
             sum(cents)::DOUBLE / 100::DOUBLE / sum(qty)::DOUBLE AS close,
             sum(CASE WHEN l_linestatus = 'O' THEN qty ELSE 0 END)::DOUBLE AS open_qty,
             sum(CASE WHEN l_linestatus = 'O' THEN cents ELSE 0 END)::DOUBLE AS open_cents,
             CAST(sum(CASE WHEN l_returnflag = 'N' THEN qty END) AS BIGINT) AS delivery_qty
      FROM lines GROUP BY 1, 2)""", ("lines",))

view("trading_calendar", """
SELECT trade_date, CASE WHEN row_number() OVER (ORDER BY trade_date) % 53 = 0 THEN 'special_preopen' ELSE 'normal' END AS session_type
FROM (SELECT DISTINCT CAST(date_trunc('week', l_shipdate) AS DATE) AS trade_date FROM lineitem)""")

view("sessions", """
SELECT trade_date, CAST(row_number() OVER (ORDER BY trade_date) AS INTEGER) AS session_no, CAST(count(*) OVER () AS INTEGER) AS last_session_no
FROM trading_calendar WHERE session_type = 'normal'""", ("trading_calendar",))

view("numbered", "SELECT b.*, s.session_no FROM bars b JOIN sessions s USING (trade_date)", ("bars", "sessions"))

view("spine", """
SELECT f.security_id, s.session_no, n.trade_date IS NOT NULL AS present, n.open, n.close AS tr, n.close AS adj_close,
       n.high AS adj_high, n.low AS adj_low, n.traded_value, n.volume, n.delivery_qty
FROM (SELECT security_id, min(session_no) AS first_no FROM numbered GROUP BY 1) f
JOIN sessions s ON s.session_no >= f.first_no
LEFT JOIN numbered n ON n.security_id = f.security_id AND n.session_no = s.session_no""", ("numbered", "sessions"))

view("index_levels", """
SELECT trade_date, sum(CAST(round(close * 10000) AS BIGINT))::DOUBLE / count(*)::DOUBLE / 10000::DOUBLE AS index_tr
FROM bars GROUP BY 1""", ("bars",))

view("events", """
SELECT 'INE' || lpad(CAST(o_custkey % 20 AS VARCHAR), 9, '0') AS isin,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'EQ' WHEN '2-HIGH' THEN 'BE' WHEN '3-MEDIUM' THEN 'BL'
            WHEN '4-NOT SPECIFIED' THEN 'SM' ELSE 'EQ' END AS series,
       'SYM' || CAST(o_custkey % 20 AS VARCHAR) AS symbol,
       CAST(date_trunc('week', o_orderdate) AS DATE) AS trade_date, o_orderkey AS version_no,
       CAST(round(o_totalprice * 100) AS BIGINT) AS close_cents, CAST(round(o_totalprice * 100) AS BIGINT) % 9973 AS volume,
       CAST(date_trunc('week', o_orderdate) AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS usable_day,
       CAST(epoch(date_trunc('week', o_orderdate)) AS BIGINT) + (o_orderkey % 5) * 86400 + 61200 AS usable_epoch,
       o_orderkey % 5 = 0 AS availability_inferred,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'disclosure' ELSE 'exchange_eod' END AS domain,
       o_orderkey % 31 = 0 AS is_tombstone
FROM orders WHERE o_orderstatus <> 'F'""")

view("deliveries", """
SELECT 'INE' || lpad(CAST(o_custkey % 20 AS VARCHAR), 9, '0') AS isin,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'EQ' WHEN '2-HIGH' THEN 'BE' WHEN '3-MEDIUM' THEN 'BL'
            WHEN '4-NOT SPECIFIED' THEN 'SM' ELSE 'EQ' END AS series,
       'SYM' || CAST(o_custkey % 20 AS VARCHAR) AS symbol,
       CAST(date_trunc('week', o_orderdate) AS DATE) AS trade_date, o_orderkey AS version_no,
       CAST(round(o_totalprice * 100) AS BIGINT) % 5003 AS delivery_qty,
       CAST(round(o_totalprice * 100) AS BIGINT) % 9973 AS traded_qty_reported,
       CAST(epoch(date_trunc('week', o_orderdate)) AS BIGINT) + (o_orderkey % 7) * 86400 + 62100 AS usable_epoch,
       o_orderkey % 7 = 0 AS availability_inferred, o_orderkey % 37 = 0 AS quarantined, o_orderkey % 5 = 0 AS is_tombstone
FROM orders WHERE o_orderstatus = 'F'""")

view("delivery_files", """
SELECT DISTINCT trade_date, usable_epoch, ((trade_date - DATE '1992-01-06') // 7) % 5 <> 0 AS complete FROM deliveries""", ("deliveries",))

view("facts", """
SELECT 'INE' || lpad(CAST(o_custkey % 100 AS VARCHAR), 9, '0') AS isin,
       CASE WHEN o_orderstatus = 'F' OR o_orderkey % 2 = 0 THEN 'consolidated' ELSE 'standalone' END AS basis,
       CASE o_orderkey % 3 WHEN 0 THEN 'revenue' WHEN 1 THEN 'pat' ELSE 'cfo' END AS fact,
       last_day(CAST(date_trunc('quarter', o_orderdate) AS DATE) + INTERVAL 2 MONTH) AS period_end,
       o_orderkey AS version,
       CAST(epoch(last_day(CAST(date_trunc('quarter', o_orderdate) AS DATE) + INTERVAL 2 MONTH)) AS BIGINT)
         + (30 + o_orderkey % 60) * 86400 + 45000 + (o_orderkey % 4) * 3600 AS usable_epoch,
       o_totalprice AS value
FROM orders""")

ACCOUNT_TOTALS = """
SELECT l_suppkey AS company, {period} AS period,
       CAST(sum(cents) AS BIGINT) AS rev, CAST(sum(cents * CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS disc,
       CAST(sum(cents * CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS duty,
       CAST(sum(CASE WHEN l_returnflag = 'N' THEN cents ELSE 0 END) AS BIGINT) AS n,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN cents ELSE 0 END) AS BIGINT) AS r,
       CAST(sum(CASE WHEN l_returnflag = 'A' THEN cents ELSE 0 END) AS BIGINT) AS a,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN cents ELSE 0 END) AS BIGINT) AS o, count(*) AS lines
FROM lines GROUP BY 1, 2"""

ACCOUNTS = """
SELECT company, {keys}, lines, rev::DOUBLE / 100 AS revenue, (rev * 52 - disc * 10)::DOUBLE / 100000 AS pbt,
       CASE WHEN lines % 13 <> 0 THEN duty::DOUBLE / 100000 END AS tax,
       (rev * 52 - disc * 10)::DOUBLE / 100000 * 0.75::DOUBLE AS pat_owners,
       CASE WHEN lines % 7 = 0 THEN 0::DOUBLE ELSE o::DOUBLE / 100000 END AS finance_costs,
       a::DOUBLE / 1000000 AS other_income,
       CASE WHEN lines % 3 = 0 THEN 0::DOUBLE ELSE r::DOUBLE / 1000000 END AS exceptional_net,
       n::DOUBLE / 3000 AS cfo, CASE WHEN lines % 19 <> 0 THEN (n * 10 - r * 9)::DOUBLE / 1000 END AS total_equity_owners,
       a::DOUBLE / 1000 AS borrowings, o::DOUBLE / 10000 AS lease_liabilities, r::DOUBLE / 2000 AS cash_equivalents,
       rev::DOUBLE / 200 AS total_assets,
       (rev * 52 - disc * 10)::DOUBLE / 100000 + o::DOUBLE / 100000 - a::DOUBLE / 20000 AS ebitda,
       r::DOUBLE / 400 AS receivables, CASE WHEN lines % 5 = 0 THEN 0::DOUBLE ELSE a::DOUBLE / 500 END AS inventory,
       CASE WHEN lines % 17 <> 0 THEN o::DOUBLE / 700 END AS rpt_total, lines % 4 <> 0 AS disclosure_present,
       (1000 + rev % 400)::DOUBLE AS shares
FROM {totals}"""

view("year_totals", ACCOUNT_TOTALS.format(period="CAST(year(l_shipdate) AS INTEGER)"), ("lines",))
view("fiscal_years", ACCOUNTS.format(keys="period AS fy_no", totals="year_totals"), ("year_totals",))
view("quarter_totals", ACCOUNT_TOTALS.format(period="CAST(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS INTEGER)"), ("lines",))
view("quarters", ACCOUNTS.format(keys="period AS quarter_no", totals="quarter_totals"), ("quarter_totals",))
view("company_sectors", """
SELECT s_suppkey AS company, CAST(n_regionkey AS BIGINT) AS sector FROM supplier JOIN nation ON s_nationkey = n_nationkey""")

view("population_cells", """
SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS eval_date, 'INE' || lpad(CAST(o_custkey % 200 AS VARCHAR), 9, '0') AS isin,
       CAST(sum(o_orderkey) AS BIGINT) AS k, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS s, count(*) AS n
FROM orders GROUP BY 1, 2""")


def _spread(modulus, low, high, salt=1):
    return f"{low}::DOUBLE + ((k * {salt} + s) % {modulus})::DOUBLE / {modulus - 1}::DOUBLE * ({high}::DOUBLE - {low}::DOUBLE)"


def _feature(name, value, missing=0, conflicted=0, drop=0, fail=0):
    cases = [(missing, "missing"), (conflicted, "conflicted"), (drop, "drop"), (fail, "fail")]
    arms = " ".join(f"WHEN (k + n) % {m} = 0 THEN '{kind}'" for m, kind in cases if m)
    kind = f"CASE {arms} ELSE 'known' END" if arms else "'known'"
    return (f"CASE WHEN {kind} IN ('fail', 'drop') THEN 'out_of_domain' ELSE {kind} END AS {name}_state, "
            f"CASE WHEN {kind} IN ('known', 'conflicted') THEN {value} END AS {name}, "
            f"CASE WHEN {kind} IN ('fail', 'drop') THEN {kind} END AS {name}_outcome")


FEATURES = [
    ("adv_20d_cr", _spread(97, 15.0, 150.0), dict(missing=41)),
    ("price_vs_dma50", _spread(89, 0.95, 1.3, 3), {}),
    ("price_vs_dma200", _spread(83, 0.95, 1.4, 5), {}),
    ("ret_12m_skip_1m", _spread(79, -0.05, 0.8, 7), {}),
    ("ret_6m_skip_1m", _spread(79, -0.1, 0.5, 7), {}),
    ("realised_vol_60d", _spread(73, 0.2, 0.5), {}),
    ("vol_adj_mom_12m", _spread(7919, 0.3, 2.5, 11), dict(missing=43)),
    ("vol_adj_mom_6m", _spread(6101, 0.2, 2.0, 13), dict(conflicted=29)),
    ("rel_strength_6m_vs_index", _spread(71, 0.0, 0.4, 17), {}),
    ("delivery_pct_20d_avg", _spread(67, 0.2, 0.8, 19), {}),
    ("is_fno_eligible", "s % 2 = 0", dict(missing=61)),
    ("atr_pct_20", _spread(59, 0.01, 0.05), {}),
    ("circuit_days_60d", "(s % 7)::DOUBLE", dict(missing=47)),
    ("surveillance_stage", "CASE WHEN s % 10 < 9 THEN 'none' ELSE 'asm_lt_1' END", {}),
    ("market_breadth", _spread(53, 0.3, 0.7), dict(missing=37)),
    ("operating_history_years", "(5 + s % 11)::DOUBLE", {}),
    ("roce_3y_avg", _spread(5003, 0.1, 0.4, 3), dict(fail=59)),
    ("roce_hy_ttm", _spread(5009, 0.1, 0.4, 5), dict(fail=59)),
    ("roce_5y_trend", _spread(5011, -0.1, 0.2, 7), {}),
    ("roce_stability", _spread(5021, 0.8, 1.0, 11), dict(missing=31)),
    ("cfo_pat_3y", _spread(5023, 0.4, 1.5, 13), {}),
    ("debt_equity", _spread(5039, 0.0, 1.6, 17), dict(missing=53)),
    ("interest_coverage", _spread(5051, 1.5, 20.0, 19), {}),
    ("positive_revenue_growth_years_5y", "(k % 6)::DOUBLE", dict(missing=23)),
    ("exceptional_frequency", "(k % 4)::DOUBLE", {}),
    ("earnings_yield_ttm", _spread(5059, 0.005, 0.1, 23), {}),
    ("ey_median_5y", _spread(5077, 0.005, 0.1, 29), {}),
    ("ey_vs_own_5y_median", _spread(5081, 0.6, 2.0, 31), dict(drop=37)),
    ("ev_ebitda_vs_sector", _spread(5087, 0.4, 1.8, 37), dict(conflicted=19)),
    ("earnings_yield_spread", _spread(5099, -0.03, 0.05, 41), dict(missing=31)),
    ("realised_vol_1y", _spread(101, 0.15, 0.5), {}),
    ("promoter_pledge_pct", _spread(103, 0.0, 0.2), {}),
    ("auditor_resignation_5y", "s % 23 = 0", {}),
    ("forensic_flag_count", "(s % 3)::DOUBLE", {}),
    ("forensic_coverage_pct", _spread(107, 0.7, 1.0), {}),
]

view("population", f"""
SELECT eval_date, isin,
       CASE s % 6 WHEN 0 THEN 'it_services' WHEN 1 THEN 'banks' WHEN 2 THEN 'pharma' WHEN 3 THEN 'autos' WHEN 4 THEN 'cement' ELSE 'consumer' END AS sector,
       k % 25 <> 0 AS market_eligible, s AS market_cap, 50::DOUBLE + (s % 2000)::DOUBLE / 10 AS close,
       CAST(epoch(eval_date) AS BIGINT) + (k % 3) * 86400 + 63000 AS signal_epoch,
       {", ".join(_feature(name, value, **states) for name, value, states in FEATURES)}
FROM population_cells""", ("population_cells",))
