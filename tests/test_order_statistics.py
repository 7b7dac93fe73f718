"""Distributed order statistics against brute force, on distributions that crowd into few values."""

import random
import statistics

import pytest

from __spark_entry__ import queries
from catalog import fundamental_queries
from pitframe.operators import cross_section as cs


def sets():
    rng = random.Random(7)
    return {
        "uniform": [rng.random() for _ in range(200)],
        "heavy": [rng.lognormvariate(0, 3) for _ in range(200)] + [1e9],
        "tied": [1.0] * 150 + [rng.random() for _ in range(50)],
        "equal": [2.5] * 40,
        "pair": [1.0, 2.0],
        "single": [3.0],
        "negative": [-x for x in range(31)],
    }


@pytest.fixture(scope="module")
def rows(spark):
    data = [(g, i, float(v)) for g, vs in sets().items() for i, v in enumerate(vs)]
    return spark.createDataFrame(data, "g string, i int, v double")


def linear(values, q):
    s = sorted(values)
    at = (len(s) - 1) * q
    lo = int(at)
    hi = min(lo + (at > lo), len(s) - 1)
    return s[lo] + (s[hi] - s[lo]) * (at - lo)


def test_quantiles(rows):
    qs = {"a": 0.01, "b": 0.25, "c": 0.5, "d": 0.99}
    got = {r["g"]: r for r in cs.quantiles(cs.positions(rows, ["g"], "v", parts=8), ["g"], "v", qs).collect()}
    for g, values in sets().items():
        assert got[g]["n"] == len(values)
        for name, q in qs.items():
            assert got[g][name] == pytest.approx(linear(values, q))


def test_positions_and_neighbours(rows):
    got = {}
    for r in cs.positions(rows, ["g"], "v", parts=8).collect():
        got.setdefault(r["g"], {})[r["v"]] = (r["before"], r["copies"], r["below"], r["above"])
    for g, values in sets().items():
        distinct = sorted(set(map(float, values)))
        for i, v in enumerate(distinct):
            want = (sum(x < v for x in values), values.count(v), distinct[i - 1] if i else None, distinct[i + 1] if i + 1 < len(distinct) else None)
            assert got[g][v] == want


def test_leave_one_out(rows):
    got = {(r["g"], r["i"]): (r["peers"], r["peer_median"]) for r in cs.leave_one_out_median(rows, ["g"], "v").collect()}
    for g, values in sets().items():
        for i in range(len(values)):
            others = values[:i] + values[i + 1:]
            peers, median = got[(g, i)]
            assert peers == len(others) and median == (pytest.approx(statistics.median(others)) if others else None)


def test_leave_one_out_among_eligible_peers(spark):
    rng = random.Random(3)
    data = [(g, i, rng.choice([None, 1.0, 2.0, rng.random()]), rng.choice([True, True, False, None])) for g in "ab" for i in range(40)] + [("c", 0, 5.0, False)]
    df = spark.createDataFrame(data, "g string, i int, v double, ok boolean")
    for r in cs.leave_one_out_median(df, ["g"], "v", "ok").collect():
        others = [v for g, i, v, ok in data if g == r["g"] and i != r["i"] and ok and v is not None]
        assert r["peers"] == len(others)
        assert r["peer_median"] == (pytest.approx(statistics.median(others)) if others else None)


def test_sector_peers_are_all_companies_of_the_sector(spark, monkeypatch):
    rng = random.Random(4)
    data = [(c, y, c % 7 > 0, c % 3, rng.choice([None, round(rng.random() * 20, 3)])) for c in range(40) for y in (1, 2)] + [(90, 1, False, 8, 5.0), (91, 1, True, 8, 6.0)]
    df = spark.createDataFrame(data, "company int, fy_no int, eligible boolean, sector int, own double")
    monkeypatch.setattr(fundamental_queries, "multiples", lambda *_: df)
    got = {(r["company"], r["fy_no"]): r for r in queries()["J12"](spark, "").collect()}
    assert len(got) == len(data)
    for company, year, _, sector, _ in data:
        others = [(own, ok) for c, y, ok, s, own in data if (y, s) == (year, sector) and c != company and own is not None]
        for peers, median, values in (("peers", "peer_median", [v for v, _ in others]), ("eligible_peers", "eligible_median", [v for v, ok in others if ok])):
            assert got[company, year][peers] == len(values)
            assert got[company, year][median] == (pytest.approx(statistics.median(values), abs=1e-6) if values else None)


def anchored(rows, tol=1e-9):
    order = sorted(rows, key=lambda r: (-r[1], -r[2], r[0]))
    out, i = [], 0
    while i < len(order):
        j = i
        while j + 1 < len(order) and order[i][1] - order[j + 1][1] <= tol:
            j += 1
        out += sorted(order[i:j + 1], key=lambda r: (-r[2], r[0]))
        i = j + 1
    return [r[0] for r in out]


@pytest.mark.parametrize("seed", range(3))
def test_rank_order_with_chains_of_near_ties(spark, seed):
    rng = random.Random(seed)
    rows = [(f"S{i:03d}", round(rng.randint(0, 60) * 4e-10 + rng.choice([0, 0.3]), 12), rng.randint(1, 9)) for i in range(200)]
    df = spark.createDataFrame([("x", *r) for r in rows], "day string, isin string, score double, market_cap int")
    got = [r["isin"] for r in cs.rank_order(df, ["day"], "score").orderBy("position").collect()]
    assert got == anchored(rows)
