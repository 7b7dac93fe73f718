"""Costs, tax, corporate actions and fills (X), tax buckets (A15) and effective-dated rates (J09)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, view
from pitframe.functions.scalars import impact_cost
from pitframe.operators import money
from pitframe.sources import adapters

c = F.col


def orders(spark, sf_dir):
    return adapters.table(spark, sf_dir, "orders")


def later(column):
    """Dates shifted by 20 years, into the span of the schedules."""
    return F.add_months(F.to_date(column), 240)


def schedule_sql(schedule, name, day="d"):
    arms = " ".join(f"WHEN {day} BETWEEN DATE '{a}' AND DATE '{b or '9999-12-31'}' THEN {r[name]}" for a, b, r in schedule)
    return f"CASE {arms} END"


# --------------------------------------------------------------------------- costs


@query("X01", """SELECT o_orderkey, round(CASE WHEN adv <= 0 THEN NULL ELSE CASE WHEN adv >= 100 THEN 0.0005 WHEN adv >= 25 THEN 0.001 ELSE 0.002 END + 0.02 * sqrt(v / adv) END, 9) AS impact, adv <= 0 AS infinite
FROM (SELECT o_orderkey, o_totalprice / 100000 AS v, (o_custkey % 130)::DOUBLE AS adv FROM orders)""")
def impact(spark, sf_dir):
    cost = impact_cost(c("o_totalprice") / 100000, (c("o_custkey") % 130).cast("double"))
    o = orders(spark, sf_dir).withColumn("impact", cost)
    endless = c("impact") == float("inf")
    return o.select("o_orderkey", F.when(~endless, F.round("impact", 9)).alias("impact"), endless.alias("infinite"))


def trades(spark, sf_dir):
    return orders(spark, sf_dir).select(
        "o_orderkey", F.when(c("o_orderkey") % 2 == 0, F.lit("buy")).otherwise(F.lit("sell")).alias("side"), c("o_totalprice").alias("value"), later("o_orderdate").alias("trade_date")
    )


def r2(x):
    return f"round({x} + 1e-12, 2)"


SIDE = "CASE WHEN s THEN {} ELSE {} END"


@query("X02", f"""SELECT o_orderkey, brokerage, stt, stamp_duty, exchange_txn_nse, sebi_turnover_fee, gst, dp_charge, {r2('brokerage + stt + stamp_duty + exchange_txn_nse + sebi_turnover_fee + gst + dp_charge')} AS total FROM (
SELECT *, {r2('g * (brokerage + exchange_txn_nse + sebi_turnover_fee)')} AS gst, CASE WHEN s THEN {r2('13.5::DOUBLE + g * 13.5')} ELSE 0::DOUBLE END AS dp_charge FROM (
SELECT o_orderkey, s, 20::DOUBLE AS brokerage, {r2('v * ' + SIDE.format(schedule_sql(money.STT, 'sell'), schedule_sql(money.STT, 'buy')) + '::DOUBLE')} AS stt,
{r2('v * ' + SIDE.format(schedule_sql(money.STAMP_DUTY, 'sell'), schedule_sql(money.STAMP_DUTY, 'buy')) + '::DOUBLE')} AS stamp_duty,
{r2('v * (' + schedule_sql([(a, b, {'rate': f'{r["rate"]:.7f}'}) for a, b, r in money.EXCHANGE_TXN_NSE], 'rate') + ')::DOUBLE')} AS exchange_txn_nse, {r2('v * 0.000001::DOUBLE')} AS sebi_turnover_fee, ({schedule_sql(money.GST, 'rate')})::DOUBLE AS g
FROM (SELECT o_orderkey, o_orderkey % 2 = 1 AS s, o_totalprice AS v, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS d FROM orders)))""")
def trade_costs(spark, sf_dir):
    out = money.with_trade_costs(trades(spark, sf_dir))
    return out.drop("side", "value", "trade_date")


@query("J09", f"SELECT o_orderkey, ({schedule_sql(money.GST, 'rate')})::DOUBLE AS rate FROM (SELECT o_orderkey, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS d FROM orders)")
def rate_in_force(spark, sf_dir):
    return orders(spark, sf_dir).select("o_orderkey", money.rate_on(money.GST, later("o_orderdate"), "rate").alias("rate"))


# --------------------------------------------------------------------------- tax


def disposals(spark, sf_dir):
    """Every line, sold on its order's date at the earliest, with per-share prices in four decimals."""
    li = adapters.table(spark, sf_dir, "lineitem")
    o = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate")
    sell = F.add_months(F.date_add(F.to_date("l_shipdate"), c("l_linenumber") * 200), 240)
    qty = c("l_quantity").cast("bigint")
    price = F.expr("CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * 100 div CAST(l_quantity AS BIGINT) AS DECIMAL(20,0))")

    def per_share(pct):
        return F.expr(f"CAST(CAST({{p}} AS DECIMAL(20,0)) * {pct} / 1000000 AS DECIMAL(20,4))".format(p="price_ticks"))

    rows = li.join(o, c("l_orderkey") == c("o_orderkey")).select(
        c("o_custkey").alias("account"), later("o_orderdate").alias("buy_date"), F.greatest(sell, later("o_orderdate")).alias("sell_date"), qty.alias("qty"), price.alias("price_ticks"), "l_linenumber"
    )
    return rows.select(
        "account", "buy_date", "sell_date", "qty", per_share("(70 + l_linenumber * 10)").alias("cost_per_share"), per_share(100).alias("sale_per_share"),
        F.when(c("l_linenumber") % 3 == 0, per_share(105)).alias("fmv_2018"),
    )


view("disposals", """SELECT account, buy_date, sell_date, qty, ((ticks * (70 + ln * 10) + 50) // 100)::DECIMAL(20,0) * 0.0001::DECIMAL(5,4) AS cost, ((ticks * 100 + 50) // 100)::DECIMAL(20,0) * 0.0001::DECIMAL(5,4) AS sale,
 CASE WHEN ln % 3 = 0 THEN ((ticks * 105 + 50) // 100)::DECIMAL(20,0) * 0.0001::DECIMAL(5,4) END AS fmv FROM (
 SELECT o_custkey AS account, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS buy_date, greatest(CAST(l_shipdate + to_days(l_linenumber * 200) + INTERVAL 20 YEAR AS DATE), CAST(o_orderdate + INTERVAL 20 YEAR AS DATE)) AS sell_date, qty, cents * 100 // qty AS ticks, l_linenumber AS ln
 FROM lines JOIN orders ON l_orderkey = o_orderkey)""", ("lines",))
REGIME = "CASE WHEN sell_date <= DATE '2018-03-31' THEN 2 WHEN sell_date <= DATE '2024-07-22' THEN 3 ELSE 4 END"
view("gains", f"""SELECT *, year(sell_date) - CASE WHEN month(sell_date) < 4 THEN 1 ELSE 0 END AS fy, (sale - CASE WHEN buy_date < DATE '2018-02-01' AND fmv IS NOT NULL THEN greatest(cost, least(fmv, sale)) ELSE cost END) * qty AS gain,
 sell_date > buy_date + INTERVAL 1 YEAR AS long_term, {REGIME} AS regime FROM disposals""", ("disposals",))
view("buckets", """SELECT account, fy, regime, sum(CASE WHEN NOT long_term THEN gain ELSE 0 END) AS st, sum(CASE WHEN long_term THEN gain ELSE 0 END) AS lt, max(sell_date) AS last_sale FROM gains GROUP BY 1, 2, 3""", ("gains",))


@query("A15", """SELECT account, CAST(fy AS INTEGER) AS fy, CASE regime WHEN 4 THEN 0.2 ELSE 0.15 END::DOUBLE AS st_rate, CASE regime WHEN 2 THEN 0 WHEN 3 THEN 0.1 ELSE 0.125 END::DOUBLE AS lt_rate, st::DOUBLE AS st, lt::DOUBLE AS lt FROM buckets""", ("buckets",))
def tax_buckets(spark, sf_dir):
    b = money.tax_buckets(disposals(spark, sf_dir))
    return b.select("account", "fy", *[c(x).cast("double").alias(x) for x in ("st_rate", "lt_rate", "st", "lt")])


@query("X03", "SELECT account, buy_date, sell_date, count(*) AS n, bool_and(long_term) AS long_term FROM gains GROUP BY 1, 2, 3", ("gains",))
def long_term(spark, sf_dir):
    d = disposals(spark, sf_dir).withColumn("lt", money.is_long_term(c("buy_date"), c("sell_date")))
    return d.groupBy("account", "buy_date", "sell_date").agg(F.count(F.lit(1)).alias("n"), F.bool_and("lt").alias("long_term"))


@query("X04", "SELECT account, count(*) AS n, sum(CASE WHEN buy_date < DATE '2018-02-01' AND fmv IS NOT NULL THEN greatest(cost, least(fmv, sale)) ELSE cost END)::DOUBLE AS basis FROM disposals GROUP BY 1", ("disposals",))
def cost_basis(spark, sf_dir):
    basis = money.cost_basis(c("buy_date"), c("cost_per_share"), c("sale_per_share"), c("fmv_2018"))
    return disposals(spark, sf_dir).groupBy("account").agg(F.count(F.lit(1)).alias("n"), F.sum(basis).cast("double").alias("basis"))


@query("X05", """SELECT account, CAST(fy AS INTEGER) AS fy, round(st, 2)::DOUBLE AS stcg, round(lt, 2)::DOUBLE AS ltcg, round(taxable, 2)::DOUBLE AS taxable_ltcg, round(tax, 2)::DOUBLE AS tax_before_cess, round(tax * 1.04, 2)::DOUBLE AS tax_with_cess FROM (
SELECT *, st * sr + taxable * lr AS tax FROM (SELECT *, CASE WHEN lr > 0 THEN greatest(lt - ex, 0) ELSE 0 END AS taxable FROM (
SELECT account, fy, greatest(st, 0) AS st, CASE WHEN st < 0 THEN lt + st ELSE lt END AS lt, CASE r WHEN 4 THEN 0.2 ELSE 0.15 END AS sr, CASE r WHEN 2 THEN 0 WHEN 3 THEN 0.1 ELSE 0.125 END AS lr, CASE r WHEN 2 THEN 0 WHEN 3 THEN 100000 ELSE 125000 END AS ex FROM (
SELECT account, fy, sum(st)::DECIMAL(24,4) AS st, sum(lt)::DECIMAL(24,4) AS lt, arg_max(regime, last_sale) AS r FROM buckets GROUP BY 1, 2))))""", ("buckets",))
def tax_view(spark, sf_dir):
    t = money.tax_view(disposals(spark, sf_dir))
    return t.select("account", "fy", *[c(x).cast("double").alias(x) for x in t.columns[2:]])


def multi_year_sql() -> str:
    """A fold over an account's years: t and u hold the short- and long-term losses by age, used up from the oldest on."""
    life = money.CARRY_FORWARD_YEARS
    step = """SELECT y.account, y.n, y.fy, y.sr, y.lr, list_concat(list_transform(range(y.fy - r.fy - 1), lambda x: 0::DOUBLE), r.t) AS t, list_concat(list_transform(range(y.fy - r.fy - 1), lambda x: 0::DOUBLE), r.u) AS u,
 y.st + own AS st, y.lt - own AS lt FROM r JOIN (SELECT *, CASE WHEN st < 0 AND lt > 0 THEN least(-st, lt) ELSE 0 END AS own FROM years) y ON y.account = r.account AND y.n = r.n + 1"""
    for age in range(life, 0, -1):
        step = f"SELECT *, least(greatest(st, 0), t[{age}]) AS a{age} FROM ({step})"
        step = f"SELECT *, least(greatest(lt, 0), t[{age}] - a{age}) AS b{age} FROM ({step})"
        step = f"SELECT *, least(greatest(lt - b{age}, 0), u[{age}]) AS c{age} FROM ({step})"
        step = f"SELECT * REPLACE (st - a{age} AS st, lt - b{age} - c{age} AS lt) FROM ({step})"
    left_t = ", ".join(f"t[{k}] - a{k} - b{k}" for k in range(1, life + 1))
    left_u = ", ".join(f"u[{k}] - c{k}" for k in range(1, life + 1))
    none = "[" + ", ".join(["0::DOUBLE"] * (life + 1)) + "]"
    return f"""WITH RECURSIVE rated AS (SELECT account, fy, st::DOUBLE AS st, lt::DOUBLE AS lt, CASE regime WHEN 4 THEN 0.2 ELSE 0.15 END::DOUBLE AS sr, CASE regime WHEN 2 THEN 0 WHEN 3 THEN 0.1 ELSE 0.125 END::DOUBLE AS lr FROM buckets),
years AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY fy) AS n FROM (SELECT account, fy, sum(st) AS st, sum(lt) AS lt, coalesce(sum(greatest(st, 0) * sr) / nullif(sum(greatest(st, 0)), 0), 0) AS sr,
 coalesce(sum(greatest(lt, 0) * lr) / nullif(sum(greatest(lt, 0)), 0), 0) AS lr FROM rated GROUP BY 1, 2)),
r(account, n, fy, t, u, st, lt, sr, lr) AS (SELECT account, 0::BIGINT, min(fy) - 1, {none}, {none}, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE FROM years GROUP BY account
 UNION ALL SELECT account, n, fy, [greatest(-st, 0), {left_t}], [greatest(-lt, 0), {left_u}], greatest(st, 0), greatest(lt, 0), sr, lr FROM ({step}))
SELECT account, CAST(fy AS INTEGER) AS fy, round((st)::DECIMAL(30,6), 2)::DOUBLE AS stcg, round((lt)::DECIMAL(30,6), 2)::DOUBLE AS ltcg, round((0 - list_sum(t))::DECIMAL(30,6), 2)::DOUBLE AS carried_st_loss, round((0 - list_sum(u))::DECIMAL(30,6), 2)::DOUBLE AS carried_lt_loss,
 round((st * sr + greatest(lt - ex, 0) * lr)::DECIMAL(30,6), 2)::DOUBLE AS tax_before_cess, round(((st * sr + greatest(lt - ex, 0) * lr) * 1.04)::DECIMAL(30,6), 2)::DOUBLE AS tax_with_cess
FROM (SELECT *, CASE WHEN fy + 1 <= 2018 THEN 0 WHEN fy + 1 <= 2024 THEN 100000 ELSE 125000 END AS ex FROM r WHERE n > 0)"""


@query("X06", multi_year_sql(), ("buckets",))
def tax_multi_year(spark, sf_dir):
    return money.tax_multi_year(disposals(spark, sf_dir))


# --------------------------------------------------------------------------- corporate actions


@query("X07", """SELECT o_orderkey, CAST(floor(q / f + 1e-9) AS BIGINT) AS qty, round(p * f, 4) AS entry_basis, round((q / f - floor(q / f + 1e-9)) * p * f, 6) AS cash_in_lieu FROM (
SELECT o_orderkey, (o_custkey + 1)::DOUBLE AS q, [0.5::DOUBLE, 0.6666666667::DOUBLE, 0.7::DOUBLE][CAST(o_orderkey % 3 + 1 AS INTEGER)] AS f, o_totalprice / 97 AS p FROM orders)""")
def split(spark, sf_dir):
    return money.apply_split(positions(spark, sf_dir), ["entry_basis"], digits=6).select("o_orderkey", "qty", "entry_basis", "cash_in_lieu")


def positions(spark, sf_dir):
    f = F.element_at(F.array(F.lit(0.5), F.lit(0.6666666667), F.lit(0.7)), (c("o_orderkey") % 3 + 1).cast("int"))
    p = c("o_totalprice") / 97
    return orders(spark, sf_dir).select("o_orderkey", adapters.isin(c("o_custkey")).alias("isin"), (c("o_custkey") + 1).cast("double").alias("qty"), f.alias("f"), p.alias("entry_basis"), p.alias("p_cum"))


@query("X08", """SELECT o_orderkey, round(d / p, 6) AS f, CAST(floor(e + 1e-9) AS BIGINT) AS stub_qty, round(floor(e + 1e-9) * ((p - d) / r), 6) AS stub_value, round((e - floor(e + 1e-9)) * ((p - d) / r), 6) AS cash_in_lieu FROM (
SELECT *, q * r AS e FROM (SELECT o_orderkey, (o_custkey + 1)::DOUBLE AS q, o_totalprice / 100 AS p, o_totalprice / 130 AS d, [0.5::DOUBLE, 1::DOUBLE, 0.3::DOUBLE][CAST(o_orderkey % 3 + 1 AS INTEGER)] AS r FROM orders))""")
def demerger(spark, sf_dir):
    r = F.element_at(F.array(F.lit(0.5), F.lit(1.0), F.lit(0.3)), (c("o_orderkey") % 3 + 1).cast("int"))
    rows = orders(spark, sf_dir).select("o_orderkey", (c("o_custkey") + 1).cast("double").alias("parent_qty"), (c("o_totalprice") / 100).alias("p_cum"), (c("o_totalprice") / 130).alias("p_discovered"), r.alias("ratio"))
    return money.demerge(rows, digits=6).select("o_orderkey", "f", "stub_qty", "stub_value", "cash_in_lieu")


@query("X09", """SELECT o_orderkey, round(terp, 6) AS terp, CASE WHEN s < p THEN round(terp / p, 6) ELSE 1 END AS f, CAST(ent AS BIGINT) AS entitlements, round(ent * coalesce(re, greatest(0, terp - s)), 6) AS value FROM (
SELECT *, (b * p + a * s) / (a + b) AS terp, floor(q * a / b + 1e-9) AS ent FROM (SELECT o_orderkey, (o_custkey + 1)::DOUBLE AS q, (o_orderkey % 2 + 1)::DOUBLE AS a, (o_orderkey % 5 + 3)::DOUBLE AS b,
 o_totalprice / 71 AS p, o_totalprice / 71 * (0.6::DOUBLE + (o_orderkey % 7)::DOUBLE / 10) AS s, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice / 900 END AS re FROM orders))""")
def rights(spark, sf_dir):
    k, p = c("o_orderkey"), c("o_totalprice") / 71
    rows = orders(spark, sf_dir).select(
        "o_orderkey", (c("o_custkey") + 1).cast("double").alias("held"), (k % 2 + 1).cast("double").alias("a"), (k % 5 + 3).cast("double").alias("b"), p.alias("p_cum"),
        (p * (F.lit(0.6) + (k % 7).cast("double") / F.lit(10.0))).alias("issue_price"), F.when(k % 4 == 0, c("o_totalprice") / 900).alias("re_close"),
    )
    terp = (c("b") * c("p_cum") + c("a") * c("issue_price")) / (c("a") + c("b"))
    return money.rights(rows, digits=6).withColumn("terp", F.round(terp, 6)).select("o_orderkey", "terp", "f", "entitlements", "value")


@query("X10", """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'INF' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') ELSE 'INE' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS isin, CAST(floor(q / f + 1e-9) AS BIGINT) AS qty, round(p * f, 4) AS entry_basis FROM (
SELECT o_orderkey, o_custkey, (o_custkey + 1)::DOUBLE AS q, [0.5::DOUBLE, 0.6666666667::DOUBLE, 0.7::DOUBLE][CAST(o_orderkey % 3 + 1 AS INTEGER)] AS f, o_totalprice / 97 AS p FROM orders)""")
def isin_change(spark, sf_dir):
    p = positions(spark, sf_dir).withColumn("new_isin", F.when(c("o_orderkey") % 2 == 0, F.concat(F.lit("INF"), F.substring("isin", 4, 9))))
    return money.carry_isin_change(p, ["entry_basis"]).select("o_orderkey", "isin", "qty", "entry_basis")


def actions(spark, sf_dir):
    """One action per security and year: a date and a factor from the supplier table."""
    s = adapters.table(spark, sf_dir, "supplier").select((c("s_suppkey") % 50).alias("security_id")).distinct()
    year = F.explode(F.sequence(F.lit(1996), F.lit(2001))).alias("year")
    return s.select("security_id", year).select(
        "security_id", F.make_date("year", (c("security_id") % 12 + 1).cast("int"), F.lit(3)).alias("ex_date"), F.when(c("year") % 2 == 0, F.lit(0.5)).otherwise(F.lit(0.8)).alias("f")
    )


@query("X11", """SELECT b.security_id, b.trade_date, round(b.close / 97 * coalesce(product(a.f), 1), 6) AS adj_close FROM bars b LEFT JOIN (SELECT s AS security_id, make_date(CAST(y AS INTEGER), CAST(s % 12 + 1 AS INTEGER), 3) AS ex_date, CASE WHEN y % 2 = 0 THEN 0.5 ELSE 0.8 END::DOUBLE AS f
 FROM (SELECT DISTINCT s_suppkey % 50 AS s FROM supplier), range(1996, 2002) t(y)) a ON a.security_id = b.security_id AND a.ex_date > b.trade_date GROUP BY 1, 2, b.close""", ("bars",))
def adjusted(spark, sf_dir):
    b = adapters.bars(spark, sf_dir).select("security_id", "trade_date", (c("close") / 97).alias("close"))
    return money.adjusted_closes(b, actions(spark, sf_dir), digits=6).select("security_id", "trade_date", "adj_close")


@query("X12", """SELECT o_orderkey, CASE WHEN d >= ex THEN o_totalprice ELSE 0 END AS accrued, CASE WHEN d >= ex + 26 THEN o_totalprice ELSE 0 END AS spendable FROM (
SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS ex, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 50 - 10 AS INTEGER) AS d FROM orders)""")
def dividends(spark, sf_dir):
    ex = F.to_date("o_orderdate")
    accrued, spendable = money.dividend_cash(c("o_totalprice"), ex, F.date_add(ex, 26), F.date_add(ex, (c("o_orderkey") % 50 - 10).cast("int")))
    return orders(spark, sf_dir).select("o_orderkey", accrued.alias("accrued"), spendable.alias("spendable"))


# --------------------------------------------------------------------------- fills


def placed_orders(spark, sf_dir):
    return orders(spark, sf_dir).select("o_orderkey", (c("o_custkey") % adapters.SECURITIES).alias("security_id"), adapters.week("o_orderdate").alias("trade_date"), (c("o_totalprice") / 100).alias("limit"))


view("placed_orders", "SELECT o_orderkey, o_custkey % 50 AS security_id, CAST(date_trunc('week', o_orderdate) AS DATE) AS trade_date, o_totalprice / 100 AS lim FROM orders")


@query("X13", """SELECT o_orderkey, CASE WHEN NOT coalesce(open >= band, false) AND open <= lim THEN open END AS fill_price FROM (
SELECT o.*, b.open, CASE WHEN o_orderkey % 10 > 0 THEN b.close * 1.1 END AS band FROM placed_orders o JOIN bars b USING (security_id, trade_date))""", ("placed_orders", "bars"))
def buy_fills(spark, sf_dir):
    b = adapters.bars(spark, sf_dir).select("security_id", "trade_date", "open", "close")
    o = placed_orders(spark, sf_dir).join(b, ["security_id", "trade_date"])
    band = F.when(c("o_orderkey") % 10 > 0, c("close") * 1.1)
    return o.select("o_orderkey", money.buy_limit_fill(c("limit"), c("open"), band).alias("fill_price"))


@query("X14", """SELECT o_orderkey, round(f.open * (1 - (least(0.01 * (f.n - b.n), 0.05) + CASE WHEN f.band IS NULL THEN 0.02 ELSE 0 END)), 7) AS fill_price, coalesce(f.n - b.n, b.remaining) AS delayed FROM (
 SELECT o.o_orderkey, b.security_id, b.n, b.remaining, (SELECT min(x.n) FROM banded x WHERE x.security_id = b.security_id AND x.n >= b.n AND NOT coalesce(x.open <= x.band, false)) AS fn
 FROM placed_orders o JOIN banded b USING (security_id, trade_date)) b LEFT JOIN banded f ON f.security_id = b.security_id AND f.n = b.fn""", ("placed_orders", "banded"))
def exit_fills(spark, sf_dir):
    b = adapters.bars(spark, sf_dir)
    band = F.when(c("volume") % 9 > 0, c("close") * 0.9)
    fills = money.exit_fills(b.select("security_id", "trade_date", (c("open") / 97).alias("open"), (band / 97).alias("lower_band")), digits=7)
    return placed_orders(spark, sf_dir).join(fills, ["security_id", "trade_date"]).select("o_orderkey", "fill_price", "delayed")


view("banded", """SELECT security_id, trade_date, open / 97 AS open, CASE WHEN volume % 9 > 0 THEN close * 0.9 / 97 END AS band, row_number() OVER (PARTITION BY security_id ORDER BY trade_date) AS n,
 count(*) OVER (PARTITION BY security_id ORDER BY trade_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS remaining FROM bars""", ("bars",))
