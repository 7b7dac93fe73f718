"""Calendar (C) and rolling-window (W) queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.registry import query, view
from pitframe.functions import clock, states
from pitframe.operators import calendar, windows
from pitframe.sources import adapters

# --------------------------------------------------------------------------- calendar


@query("C01", "SELECT trade_date, CAST(session_no AS INTEGER) AS session_no FROM sessions", ("sessions",))
def executable_sessions(spark, sf_dir):
    return adapters.sessions(spark, sf_dir).select("trade_date", "session_no")


@query("C02", "SELECT security_id, session_no, present, tr AS close FROM spine", ("spine",))
def spine(spark, sf_dir):
    s = adapters.spine(spark, sf_dir)
    return s.select("security_id", "session_no", "present", F.col("tr").alias("close"))


def order_days(spark, sf_dir):
    """Distinct order dates; one in 11 a muhurat session."""
    days = adapters.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("trade_date")).distinct()
    kind = F.when(F.unix_date("trade_date") % 11 == 0, F.lit("muhurat")).otherwise(F.lit("normal"))
    return days.withColumn("session_type", kind)


view("order_days", """
SELECT d AS trade_date, CASE WHEN date_diff('day', DATE '1970-01-01', d) % 11 = 0 THEN 'muhurat' ELSE 'normal' END AS session_type
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""")


@query("C03", """SELECT CAST(date_trunc('week', trade_date) AS DATE) AS week, max(trade_date) AS weekly_session
FROM order_days WHERE session_type = 'normal' AND isodow(trade_date) <= 5 GROUP BY 1""", ("order_days",))
def weekly_sessions(spark, sf_dir):
    return calendar.weekly_sessions(order_days(spark, sf_dir), "fri")


@query("C04", """SELECT day FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM
(SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders)) WHERE isodow(day) < 6""")
def weekday_range(spark, sf_dir):
    day = F.to_date("o_orderdate")
    bounds = adapters.table(spark, sf_dir, "orders").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return calendar.date_range(bounds, "lo", "hi")


@query("C05", """SELECT CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END AS INTEGER) AS fy,
count(*) AS orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1""")
def fiscal_year(spark, sf_dir):
    o = adapters.table(spark, sf_dir, "orders")
    return o.groupBy(clock.fiscal_year(F.col("o_orderdate")).alias("fy")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(adapters.cents("o_totalprice")).alias("cents")
    )


# --------------------------------------------------------------------------- rolling features

VALUE = "security_id, session_no, CASE WHEN {kind} = 'known' THEN value END AS value, CASE WHEN {kind} IN ('fail', 'drop') THEN 'out_of_domain' ELSE {kind} END AS state, CASE WHEN {kind} IN ('fail', 'drop') THEN {kind} END AS outcome"


def look(field, k, name):
    """SQL for the lookback: the frame holds a struct so that a NULL field of a present bar is returned."""
    return f"""struct_extract(last_value(CASE WHEN present THEN {{'v': {field}}} END IGNORE NULLS)
        OVER (PARTITION BY security_id ORDER BY session_no ROWS BETWEEN {k + 5} PRECEDING AND {k} PRECEDING), 'v') AS {name}"""


def feature_sql(inner, value, kind):
    return f"SELECT security_id, session_no, CASE WHEN kind = 'known' THEN value END AS value, " \
           f"CASE WHEN kind IN ('fail', 'drop') THEN 'out_of_domain' ELSE kind END AS state, " \
           f"CASE WHEN kind IN ('fail', 'drop') THEN kind END AS outcome FROM (" \
           f"SELECT security_id, session_no, {value} AS value, {kind} AS kind FROM ({inner}))"


def over(n, last=0):
    return f"OVER (PARTITION BY security_id ORDER BY session_no ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def one_feature(name):
    def run(spark, sf_dir):
        features = windows.add_price_features(adapters.spine(spark, sf_dir), [name])
        return features.select("security_id", "session_no", *states.flat(F.col(name)))

    run.__doc__ = f"{name} for every security and session."
    return run


@query("W01", f"SELECT security_id, session_no, v AS value FROM (SELECT security_id, session_no, {look('tr', 21, 'v')} FROM spine)", ("spine",))
def lookback(spark, sf_dir):
    s = adapters.spine(spark, sf_dir)
    return s.select("security_id", "session_no", windows.lookback("tr", 21).alias("value"))


def momentum_view(name, near, far):
    view(name, feature_sql(f"SELECT *, {look('tr', near, 'a')}, {look('tr', far, 'b')} FROM spine", "round(a / b - 1, 6)",
                           "CASE WHEN a IS NULL OR b IS NULL THEN 'missing' ELSE 'known' END"), ("spine",))


def vol_view(name, n, need):
    view(name, feature_sql(
        f"""SELECT *, stddev_samp(lr) {over(n)} * sqrt(250) AS sd, count(lr) {over(n)} AS c FROM
        (SELECT *, ln(adj_close / lag(adj_close) OVER (PARTITION BY security_id ORDER BY session_no)) AS lr FROM spine)""",
        "round(sd, 6)", f"CASE WHEN c < {need} OR NOT coalesce(sd > 0, false) THEN 'drop' ELSE 'known' END"), ("spine",))


momentum_view("mom12", 21, 252)
momentum_view("mom6", 21, 126)
vol_view("vol60", 60, 54)
vol_view("vol1y", 250, 225)


@query("W02", """SELECT *, CAST(row_number() OVER (PARTITION BY session_no ORDER BY value DESC NULLS LAST, security_id) AS INTEGER) AS position
FROM mom12""", ("mom12",))
def momentum_ranked(spark, sf_dir):
    """12-1 momentum of every security and session, with its place in the session; sparse data still returns rows, with their state."""
    features = windows.add_price_features(adapters.spine(spark, sf_dir), ["ret_12m_skip_1m"])
    flat = features.select("security_id", "session_no", *states.flat(F.col("ret_12m_skip_1m")))
    best = Window.partitionBy("session_no").orderBy(F.desc_nulls_last("value"), "security_id")
    return flat.withColumn("position", F.row_number().over(best))


query("W03", "SELECT * FROM mom6", ("mom6",))(one_feature("ret_6m_skip_1m"))
query("W04", "SELECT * FROM vol60", ("vol60",))(one_feature("realised_vol_60d"))
query("W05", "SELECT * FROM vol1y", ("vol1y",))(one_feature("realised_vol_1y"))


@query("W06", """SELECT m.security_id, m.session_no,
 CASE WHEN m.state = 'known' AND v.state = 'known' THEN round(m.value / v.value, 6) END AS m12_value,
 CASE WHEN m.state = 'known' AND v.state = 'known' THEN 'known' ELSE 'missing' END AS m12_state, CAST(NULL AS VARCHAR) AS m12_outcome,
 CASE WHEN s.state = 'known' AND v.state = 'known' THEN round(s.value / v.value, 6) END AS m6_value,
 CASE WHEN s.state = 'known' AND v.state = 'known' THEN 'known' ELSE 'missing' END AS m6_state, CAST(NULL AS VARCHAR) AS m6_outcome
FROM mom12 m JOIN vol60 v USING (security_id, session_no) JOIN mom6 s USING (security_id, session_no)""", ("mom12", "mom6", "vol60"))
def vol_adjusted(spark, sf_dir):
    features = windows.add_price_features(adapters.spine(spark, sf_dir), ["vol_adj_mom_12m", "vol_adj_mom_6m"])
    return features.select(
        "security_id", "session_no",
        *states.flat(F.col("vol_adj_mom_12m"), "m12"), *states.flat(F.col("vol_adj_mom_6m"), "m6"),
    )


def spine_with_index(spark, sf_dir):
    """The index level on every session, absent ones included. One row per session, so the join broadcasts."""
    levels = adapters.index_levels(spark, sf_dir).join(adapters.sessions(spark, sf_dir), "trade_date")
    return adapters.spine(spark, sf_dir).join(F.broadcast(levels.select("session_no", "index_tr")), "session_no", "left")


@query("W07", feature_sql(
    f"SELECT *, {look('tr', 21, 'a')}, {look('tr', 126, 'b')}, {look('index_tr', 21, 'c').replace('present', 'index_tr IS NOT NULL')}, "
    f"{look('index_tr', 126, 'd').replace('present', 'index_tr IS NOT NULL')} FROM "
    "(SELECT spine.*, i.index_tr FROM spine LEFT JOIN (SELECT session_no, index_tr FROM index_levels JOIN sessions USING (trade_date)) i USING (session_no))",
    "round(a / b - c / d, 6)", "CASE WHEN a IS NULL OR b IS NULL OR c IS NULL OR d IS NULL THEN 'missing' ELSE 'known' END"),
    ("spine", "index_levels", "sessions"))
def relative_strength(spark, sf_dir):
    s = spine_with_index(spark, sf_dir).select("*", windows.relative_strength().alias("rs"))
    return s.select("security_id", "session_no", *states.flat(F.col("rs")))


query("W08", feature_sql(
    f"SELECT *, avg(traded_value) {over(20)} / 1e7 AS v, count(CASE WHEN present THEN 1 END) {over(20)} AS c FROM spine",
    "round(v, 6)", "CASE WHEN c < 15 THEN 'missing' ELSE 'known' END"), ("spine",))(one_feature("adv_20d_cr"))

query("W09", feature_sql(
    f"""SELECT *, sum(CASE WHEN u THEN delivery_qty END) {over(20)}::DOUBLE / nullif(sum(CASE WHEN u THEN volume END) {over(20)}, 0)::DOUBLE AS v,
        count(CASE WHEN u THEN 1 END) {over(20)} AS c FROM
        (SELECT *, present AND volume > 0 AND delivery_qty IS NOT NULL AS u FROM spine)""",
    "round(v, 6)", "CASE WHEN c < 15 THEN 'missing' ELSE 'known' END"), ("spine",))(one_feature("delivery_pct_20d_avg"))


def dma_sql(n, need):
    return feature_sql(
        f"SELECT *, adj_close / avg(adj_close) {over(n)} AS v, count(CASE WHEN present THEN 1 END) {over(n)} AS c FROM spine",
        "round(v, 6)", f"CASE WHEN NOT present OR c < {need} THEN 'missing' ELSE 'known' END")


query("W10", dma_sql(50, 45), ("spine",))(one_feature("price_vs_dma50"))
query("W11", dma_sql(200, 180), ("spine",))(one_feature("price_vs_dma200"))
query("W12", feature_sql(
    f"""SELECT *, avg(t) {over(20)} / adj_close AS v, count(t) {over(20)} AS c FROM
        (SELECT *, CASE WHEN present THEN greatest(adj_high, p) - least(adj_low, p) END AS t FROM
         (SELECT *, lag(adj_close) OVER (PARTITION BY security_id ORDER BY session_no) AS p FROM spine))""",
    "round(v, 6)", "CASE WHEN NOT present OR c < 18 OR NOT coalesce(v > 0, false) THEN 'drop' ELSE 'known' END"), ("spine",))(one_feature("atr_pct_20"))


@query("W13", feature_sql(
    f"""SELECT *, count(CASE WHEN b <> 'inside' THEN 1 END) {over(60)} AS v, count(b) {over(60)} AS c FROM
        (SELECT *, CASE WHEN session_no % 97 = 0 THEN NULL WHEN tr >= adj_high THEN 'closed_at_upper_band'
                        WHEN tr <= adj_low THEN 'closed_at_lower_band' ELSE 'inside' END AS b FROM spine)""",
    "v", "CASE WHEN c < 60 THEN 'missing' ELSE 'known' END"), ("spine",))
def circuit_days(spark, sf_dir):
    """Band file missing on one session in 97; an absent security has no band close."""
    band = (
        F.when(F.col("session_no") % 97 == 0, F.lit(None))
        .when(F.col("tr") >= F.col("adj_high"), F.lit("closed_at_upper_band"))
        .when(F.col("tr") <= F.col("adj_low"), F.lit("closed_at_lower_band"))
        .otherwise(F.lit("inside"))
    )
    s = adapters.spine(spark, sf_dir).withColumn("band_state", band).select("*", windows.band_close_days().alias("c"))
    return s.select("security_id", "session_no", *states.flat(F.col("c")))


@query("W14", f"""SELECT security_id, session_no, CASE WHEN c >= 3 THEN b END AS below_3_sessions FROM (
SELECT security_id, session_no, count(x) {over(3)} AS c, bool_and(x) {over(3)} AS b FROM
(SELECT *, adj_close < avg(adj_close) {over(50)} AS x FROM spine))""", ("spine",))
def persist(spark, sf_dir):
    s = adapters.spine(spark, sf_dir)
    s = s.withColumn("below", F.col("adj_close") < F.avg("adj_close").over(windows.sessions(-49, 0)))
    return s.select("security_id", "session_no", windows.persist(F.col("below"), 3).alias("below_3_sessions"))


def daily_yields(spark, sf_dir):
    """Units per unit of value of 16 securities on every day that anything shipped, with blackout days and rare actions."""
    days = adapters.table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 16).alias("security_id"), F.col("l_shipdate").cast("date").alias("trade_date")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"), F.sum(adapters.cents("l_extendedprice")).alias("cents"))
    calendar_days = days.select("trade_date").distinct().withColumn("session_type", F.lit("normal"))
    spine = calendar.session_spine(days, calendar.executable_sessions(calendar_days))
    return spine.select(
        "security_id", "session_no", ((F.col("qty") * 100000).cast("double") / F.col("cents").cast("double")).alias("ey"),
        (F.col("session_no") % 11 == 0).alias("blackout"), ((F.col("security_id") * 97 + F.col("session_no")) % 1709 == 0).alias("is_action"),
    )


view("daily_numbered", """SELECT *, dense_rank() OVER (ORDER BY trade_date) AS session_no FROM (
SELECT l_suppkey % 16 AS security_id, CAST(l_shipdate AS DATE) AS trade_date, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
 CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY 1, 2)""")
view("daily_yields", """SELECT f.security_id, CAST(s.session_no AS INTEGER) AS session_no, (n.qty * 100000)::DOUBLE / n.cents::DOUBLE AS ey, (f.security_id * 97 + s.session_no) % 1709 = 0 AS act
FROM (SELECT security_id, min(session_no) AS first_no FROM daily_numbered GROUP BY 1) f JOIN (SELECT DISTINCT session_no FROM daily_numbered) s ON s.session_no >= f.first_no
LEFT JOIN daily_numbered n ON n.security_id = f.security_id AND n.session_no = s.session_no""", ("daily_numbered",))


@query("W15", """SELECT security_id, session_no, CASE WHEN c >= 750 THEN round(m, 6) END AS value,
CASE WHEN c >= 750 THEN 'known' ELSE 'out_of_domain' END AS state, CASE WHEN c < 750 THEN 'drop' END AS outcome FROM (
SELECT *, quantile_cont(x, 0.5) OVER w AS m, count(x) OVER w AS c FROM (
  SELECT *, CASE WHEN session_no % 11 <> 0 AND NOT act THEN ey END AS x,
         count(CASE WHEN act THEN 1 END) OVER (PARTITION BY security_id ORDER BY session_no) AS epoch_no FROM daily_yields)
WINDOW w AS (PARTITION BY security_id, epoch_no ORDER BY session_no ROWS BETWEEN 1249 PRECEDING AND CURRENT ROW))""", ("daily_yields",))
def yield_median(spark, sf_dir):
    m = windows.yield_median(windows.with_action_epoch(daily_yields(spark, sf_dir)), "ey")
    return m.select("security_id", "session_no", *states.flat(F.col("yield_median")))


def stop_paths(spark, sf_dir):
    """A position per security every 40 sessions, filled at the first present open."""
    bars = adapters.spine(spark, sf_dir).filter("present").select(
        F.concat_ws("-", "security_id", F.floor(F.col("session_no") / 40)).alias("position_id"),
        "session_no", "open", F.col("adj_close").alias("close"),
        F.round(F.least((F.col("adj_high") - F.col("adj_low")) / F.col("adj_close") / 20, F.lit(0.2)), 6).alias("atr_pct"),
    )
    by_position = Window.partitionBy("position_id").orderBy("session_no")
    whole = by_position.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return bars.select(
        "position_id", (F.row_number().over(by_position) - 1).alias("step"),
        F.first("open").over(whole).alias("entry_fill"), F.first("atr_pct").over(whole).alias("atr_at_signal"),
        "close", "atr_pct",
    )


@query("W16", """SELECT position_id, step, stop_in_force, CAST(exit_session AS INTEGER) AS exit_session FROM (
 SELECT *, min(CASE WHEN close < stop_in_force THEN step END) OVER (PARTITION BY position_id) AS exit_session FROM (
  SELECT *, greatest(entry_fill * (1 - 2.5 * atr_at_signal), coalesce(max(peak * (1 - 2.5 * peak_atr)) OVER
     (PARTITION BY position_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS stop_in_force FROM (
   SELECT *, greatest(entry_fill, max(close) OVER u) AS peak,
          coalesce(last_value(CASE WHEN is_new THEN atr_pct END IGNORE NULLS) OVER u, atr_at_signal) AS peak_atr FROM (
    SELECT *, close > greatest(entry_fill, coalesce(max(close) OVER (PARTITION BY position_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_new
    FROM (SELECT position_id, CAST(row_number() OVER (PARTITION BY position_id ORDER BY session_no) - 1 AS INTEGER) AS step,
      first_value(open) OVER (PARTITION BY position_id ORDER BY session_no) AS entry_fill,
      first_value(atr_pct) OVER (PARTITION BY position_id ORDER BY session_no) AS atr_at_signal, close, atr_pct
      FROM (SELECT CAST(security_id AS VARCHAR) || '-' || CAST(CAST(floor(session_no / 40) AS INTEGER) AS VARCHAR) AS position_id, session_no, open,
         adj_close AS close, round(least((adj_high - adj_low) / adj_close / 20, 0.2::DOUBLE), 6) AS atr_pct FROM spine WHERE present)))
   WINDOW u AS (PARTITION BY position_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))))
WHERE exit_session IS NULL OR step <= exit_session""", ("spine",))
def trailing_stop(spark, sf_dir):
    stops = windows.trailing_stop(stop_paths(spark, sf_dir))
    return stops.select("position_id", "step", F.col("stop_tested").alias("stop_in_force"), "exit_session")


@query("W17", """SELECT security_id, round(greatest(max((peak - tr) / peak), 0::DOUBLE), 6) AS max_drawdown FROM
(SELECT security_id, tr, max(tr) OVER (PARTITION BY security_id ORDER BY session_no) AS peak FROM spine WHERE present) GROUP BY 1""", ("spine",))
def max_drawdown(spark, sf_dir):
    s = adapters.spine(spark, sf_dir).filter("present")
    out = windows.max_drawdown(s, "security_id", "session_no", "tr")
    return out.select("security_id", F.round("max_drawdown", 6).alias("max_drawdown"))


def monthly_excess(spark, sf_dir):
    """Four-session return minus the index, one row per security and four-session step; the last third is holdout."""
    s = spine_with_index(spark, sf_dir)
    own = windows.lookback("tr", 0) / windows.lookback("tr", 4) - 1
    index = F.col("index_tr") / F.lag("index_tr", 4).over(windows.in_order()) - 1
    step = s.select("security_id", "session_no", F.round(own - index, 9).alias("excess"))
    return step.filter((F.col("session_no") % 4 == 0) & F.col("excess").isNotNull()).select(
        "security_id",
        F.floor(F.col("session_no") / 4).cast("int").alias("month_no"),
        F.when(F.col("session_no") > 230, F.lit("holdout")).otherwise(F.lit("design")).alias("period"),
        "excess",
    )


view("monthly_excess", f"""
SELECT security_id, CAST(floor(session_no / 4) AS INTEGER) AS month_no, CASE WHEN session_no > 230 THEN 'holdout' ELSE 'design' END AS period, excess
FROM (SELECT *, round((a / b - 1) - (index_tr / lag(index_tr, 4) OVER (PARTITION BY security_id ORDER BY session_no) - 1), 9) AS excess FROM (
  SELECT *, {look('tr', 0, 'a')}, {look('tr', 4, 'b')} FROM
    (SELECT spine.*, i.index_tr FROM spine LEFT JOIN (SELECT session_no, index_tr FROM index_levels JOIN sessions USING (trade_date)) i USING (session_no))))
WHERE session_no % 4 = 0 AND excess IS NOT NULL""", ("spine", "index_levels", "sessions"))


@query("W18", """SELECT security_id, round(avg(CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END), 6) AS positive_share, count(*) AS windows FROM (
SELECT security_id, avg(excess) OVER w AS m, count(*) OVER w AS c FROM monthly_excess
WINDOW w AS (PARTITION BY security_id ORDER BY month_no ROWS BETWEEN 35 PRECEDING AND CURRENT ROW)) WHERE c = 36 GROUP BY 1""", ("monthly_excess",))
def rolling_alpha(spark, sf_dir):
    out = windows.rolling_alpha_share(monthly_excess(spark, sf_dir), "security_id", "month_no", "excess")
    return out.select("security_id", F.round("positive_share", 6).alias("positive_share"), "windows")


@query("W19", """SELECT security_id, session_no, session_no - first_value(session_no) OVER
(PARTITION BY security_id, session_no // 40 ORDER BY session_no) AS holding_days FROM spine""", ("spine",))
def holding_days(spark, sf_dir):
    """Positions open on the first session of each block of 40."""
    s = adapters.spine(spark, sf_dir).withColumn("block", F.floor(F.col("session_no") / 40))
    first = F.min("session_no").over(Window.partitionBy("security_id", "block"))
    held = windows.holding_days(s.withColumn("entry_session_no", first))
    return held.select("security_id", "session_no", "holding_days")
