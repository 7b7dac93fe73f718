"""Company features against hand-worked values."""

import math

import pytest
from pyspark.sql import functions as F

from pitframe.functions import states
from pitframe.operators import cross_section as cs
from pitframe.operators import fundamentals as fu

FIELDS = ("revenue", "pbt", "tax", "pat_owners", "finance_costs", "other_income", "exceptional_net", "cfo", "total_equity_owners", "borrowings", "lease_liabilities", "cash_equivalents", "total_assets")
# Per year: revenue, profit before tax, tax, profit, cash flow. Equity 1,000 and assets 2,000 throughout.
YEARS = [(1000, 150, 40, 110, 100), (1100, 200, 50, 150, 140), (1050, 200, 50, 150, 90), (1200, 250, 70, 180, 150), (1300, 250, 70, 180, 200), (1300, 300, 60, 240, 210)]


def accounts(spark, patches):
    """One company per case: the base years with some fields replaced."""
    rows = []
    for case, (patch, n) in patches.items():
        for i, (revenue, pbt, tax, pat, cfo) in enumerate(YEARS[:n]):
            year = dict(zip(FIELDS, (revenue, pbt, tax, pat, 0, 0, 0, cfo, 1000, 0, 0, 0, 2000)))
            year.update(patch.get(i, {}))
            rows.append((case, 2021 + i, *[None if year[f] is None else float(year[f]) for f in FIELDS]))
    df = spark.createDataFrame(rows, "company string, fy_no int, " + ", ".join(f"{f} double" for f in FIELDS))
    y = fu.add_year_position(fu.add_annual_roce(df)).withColumns({"prior_revenue": F.lag("revenue").over(fu.by_year())})
    y = y.withColumns({"history": fu.operating_history(), "avg3": fu.roce_average(), "trend": fu.roce_trend(), "stability": fu.roce_stability(), "cfo_pat": fu.cash_conversion(), "growth": fu.growth_years()})
    return {(r["company"], r["fy_no"]): r for r in y.collect()}


CASES = {
    "base": ({}, 6), "no_tax": ({2: {"tax": None}}, 6), "negative_equity": ({4: {"total_equity_owners": -10}}, 6), "three": ({}, 3), "no_pbt": ({1: {"pbt": None}}, 6),
    "no_prior_equity": ({0: {"total_equity_owners": None}}, 6), "flat": ({1: {"pbt": 100}, 2: {"pbt": -100}, 3: {"pbt": 100}, 4: {"pbt": -100}, 5: {"pbt": 0}}, 6), "no_cfo": ({5: {"cfo": None}}, 6),
    "no_revenue": ({2: {"revenue": None}}, 6), "ood_and_missing": ({4: {"total_equity_owners": -10}, 5: {"pbt": None}}, 6),
}
WANT = [
    ("base", 2026, "history", "known", 6), ("no_tax", 2026, "history", "known", 3), ("base", 2026, "avg3", "known", 0.266667), ("negative_equity", 2026, "avg3", "out_of_domain", None),
    ("base", 2026, "trend", "known", 0.104167), ("base", 2026, "stability", "known", 0.963933), ("base", 2026, "cfo_pat", "known", 0.933333), ("base", 2026, "growth", "known", 3),
    ("three", 2023, "avg3", "missing", None), ("no_pbt", 2022, "roce", "missing", None), ("no_prior_equity", 2022, "roce", "missing", None), ("flat", 2026, "trend", "out_of_domain", None),
    ("no_cfo", 2026, "cfo_pat", "missing", None), ("no_revenue", 2026, "growth", "missing", None), ("ood_and_missing", 2026, "avg3", "out_of_domain", None),
]


@pytest.fixture(scope="module")
def computed(spark):
    return accounts(spark, CASES)


@pytest.mark.parametrize("case, year, name, state, value", WANT)
def test_annual(computed, case, year, name, state, value):
    got = computed[(case, year)][name]
    assert got["state"] == state and (value is None or math.isclose(got["value"], value, abs_tol=1e-6))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def L(*values):
    return [F.lit(None if v is None else float(v)).cast("double") for v in values]


@pytest.mark.parametrize("args, state, value", [
    ((210, 1000, 1050, 950, 2000, 2000), "known", 0.21), ((200, 500, 20, 25, 1000, 1000), "known", 1.0), ((50, -10, 270, 270, 400, 400), "out_of_domain", None), ((-20, 500, 10, 10, 520, 520), "out_of_domain", None),
    ((30, 400, 150, -140, 1000, 1000), "known", 1.0), ((30, 400, 150, -200, 1000, 1000), "known", 1.0), ((500, 400, 400, 400, 1000, 1000), "known", 1.0), ((10, 50, 50, 50, 1000, 1000), "known", 1.0),
    ((10, 51, 51, 51, 1000, 1000), "known", 0.196078), ((50, 0, 280, 280, 400, 400), "out_of_domain", None), ((0, 500, 10, 10, 1000, 1000), "out_of_domain", None), ((180, 950, 1000, 800, 2000, 2000), "known", 0.2),
])
def test_roce_rule(spark, args, state, value):
    got = one(spark, fu.roce_rule(*L(*args)))
    assert got["state"] == state and (value is None or math.isclose(got["value"], value, abs_tol=1e-6))


def test_scalar_features(spark):
    assert one(spark, fu.debt_equity(*L(300, 100, 800)))["value"] == 0.5
    assert one(spark, fu.debt_equity(*L(300, 100, 0)))["outcome"] == "fail"
    assert [one(spark, fu.interest_coverage(*L(*a)))["value"] for a in ((500, 50), (500, 0), (1e6, 1))] == [10.0, 100.0, 100.0]
    assert [one(spark, fu.pat_underlying(*L(*a))) for a in ((100, 20, 30, 120), (100, 20, 5, -10), (100, 20, 5, 0), (100, 20, 52, 100))] == [85.0, 80.0, 80.0, 80.0]
    k = lambda v: states.known(F.lit(v))
    no = F.lit(False)
    assert one(spark, fu.yield_vs_median(k(0.06), k(0.05), no))["value"] == 1.2
    assert one(spark, fu.yield_vs_median(k(-0.01), k(0.05), no))["outcome"] == "fail"
    assert one(spark, fu.yield_vs_median(k(0.06), states.value_state(F.lit(1.0), (F.lit(True), "drop")), no))["state"] == "missing"
    assert one(spark, fu.yield_spread(*L(0.08, 0.069)))["value"] == 0.011
    assert [one(spark, fu.promoter_pledge(*L(*a)))["value"] for a in ((150, 1000), (0, 0))] == [0.15, 0.0]
    assert one(spark, fu.fno_eligible(F.lit(True), F.lit(False)))["state"] == "missing"
    day = lambda d: F.lit(d).cast("date")
    none = F.lit(None).cast("string")
    stages = [("2012-06-01", none, False), ("2019-06-03", none, False), ("2019-06-03", none, True), ("2019-06-03", F.lit("asm_st_1"), True), ("2017-03-01", none, False)]
    got = [one(spark, fu.surveillance_stage(day(d), s, F.lit(c))) for d, s, c in stages]
    assert [(g["state"], g["value"]) for g in got] == [("known", "none"), ("missing", None), ("known", "none"), ("known", "asm_st_1"), ("missing", None)]


def test_flag_count(spark):
    flags = [(True, True), (True, False), (True, None), (False, None), (True, True), (True, False), (True, False), (True, False)]
    count, share = fu.flag_count_and_coverage([(F.lit(a), F.lit(v).cast("boolean")) for a, v in flags])
    assert (one(spark, count)["value"], one(spark, share)["value"]) == (2, 0.857143)
    count, share = fu.flag_count_and_coverage([(F.lit(False), F.lit(None).cast("boolean"))] * 2)
    assert (one(spark, count)["value"], one(spark, share)["value"]) == (0, 1.0)


def test_threshold_flags_decide_on_quantised_values(spark):
    above = lambda a, b: one(spark, fu.above(F.lit(a), F.lit(b)))
    assert above((0.1 + 0.1 + 0.1) / 3, 0.10) is False and above(0.101, 0.10) is True
    rows = [("a", 2021 + i, d, m) for i, (d, m) in enumerate(((50.0, .20), (61.0, .18), (74.0, .15)))] + [("b", 2021 + i, d, m) for i, (d, m) in enumerate(((50.0, .20), (61.0, .18), (72.0, .15)))]
    rows += [("c", 2021 + i, d, m) for i, (d, m) in enumerate(((50.0, .20), (60.0, .18), (72.1, .15)))] + [("d", 2021 + i, d, m) for i, (d, m) in enumerate(((50.0, .20), (61.0, .18), (74.0, .18)))]
    df = spark.createDataFrame(rows, "company string, fy_no int, receivable_days double, opm double")
    got = {r["company"]: r["f"] for r in df.withColumn("f", fu.receivables_diverging()).filter("fy_no = 2023").collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False}
    assert one(spark, fu.dilution_persistent(*L(1180, 1000))) is True and one(spark, fu.dilution_persistent(*L(1100, None))) is None


def test_auditor_windows(spark):
    events = [("a", "2023-01-10", "resignation"), ("b", "2021-06-01", "resignation"), ("b", "2024-04-01", "rotation"), ("c", "2022-05-01", "other"), ("c", "2024-02-01", "resignation"), ("c", "2025-04-01", "rotation"),
              ("d", "2021-09-24", "resignation"), ("d", "2026-09-24", "resignation")]
    e = spark.createDataFrame(events, "company string, d string, kind string").selectExpr("company", "CAST(d AS DATE) AS effective_date", "kind")
    cutoffs = e.select("company", F.lit("2026-09-24").cast("date").alias("cutoff_date")).distinct()
    got = {r["company"]: (r["resignations"], r["changes"]) for r in fu.event_counts_in_window(cutoffs, e, {"resignations": ("resignation",), "changes": ("resignation", "other")}).collect()}
    assert got == {"a": (1, 1), "b": (0, 0), "c": (1, 2), "d": (1, 1)}, "the window is open at its start and closed at its end"


@pytest.mark.parametrize("peers, want", [([5, 6, 7, 8, 9, 10, 11, 12, 13], 1.111111), ([5, 6, 7, 8, 9, 10, 11, None, None], None), ([5, 6, 7, 8, 9, 10, 11, 12], 1.176471), ([0] * 8, None)])
def test_sector_multiple(spark, peers, want):
    rows = [("own", "s", 10.0)] + [(f"p{i}", "s", None if p is None else float(p)) for i, p in enumerate(peers)]
    m = cs.leave_one_out_median(spark.createDataFrame(rows, "company string, sector string, own double"), ["sector"], "own")
    r = m.filter("company = 'own'").select(fu.relative_to_peers(F.col("own"), F.col("peer_median"), F.col("peers"), F.lit(False)).alias("r")).first()["r"]
    assert (r["value"] is None) == (want is None) and (want is None or math.isclose(r["value"], want, abs_tol=1e-6))
