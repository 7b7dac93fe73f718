"""Point-in-time reads: boundaries, both cutoff domains, sentinels, and look-ahead as a property."""

import random

import pytest
from pyspark.sql import functions as F

from pitframe.functions import clock
from pitframe.operators import bitemporal as bt
from pitframe.operators import quality


def instants(df, *columns):
    return df.withColumns({c: clock.ist_text_to_instant(F.col(c)) for c in columns})


@pytest.fixture(scope="module")
def filings(spark):
    rows = [("X", "consolidated", "2026-09-17T18:00:00", 1), ("X", "standalone", "2026-09-18T18:30:00", 2), ("X", "consolidated", "2026-09-18T20:30:00", 3)]
    df = spark.createDataFrame([(*r, "disclosure", r[3]) for r in rows], "isin string, basis string, usable_from string, value int, domain string, version int")
    return instants(df, "usable_from")


@pytest.mark.parametrize("basis, day, want", [("consolidated", "2026-09-18", 1), ("consolidated", "2026-09-19", 3), ("standalone", "2026-09-18", 2), ("standalone", "2026-09-17", None)])
def test_as_of_run_date(spark, filings, basis, day, want):
    asked = spark.createDataFrame([("X", day)], "isin string, d string").selectExpr("isin", "CAST(d AS DATE) AS run_date")
    got = bt.as_of_by_run_date(asked, filings.filter(F.col("basis") == basis), ["isin"], ["value"]).collect()
    assert [r["value"] for r in got] == ([] if want is None else [want])


@pytest.mark.parametrize("domain, usable, day", [("disclosure", "2026-09-18T20:00:00", "2026-09-18"), ("disclosure", "2026-09-18T20:00:01", "2026-09-19"), ("disclosure", "2026-09-18T21:00:00", "2026-09-19"), ("exchange_eod", "2026-09-18T22:30:00", "2026-09-18"), ("exchange_eod", "2026-09-18T23:00:00", "2026-09-18"), ("exchange_eod", "2026-09-18T23:00:01", "2026-09-19")])
def test_each_domain_has_its_own_cutoff(spark, domain, usable, day):
    row = instants(spark.createDataFrame([(domain, usable)], "domain string, usable_from string"), "usable_from")
    assert str(row.select(clock.first_run_date(F.col("usable_from"), F.col("domain")).alias("d")).first()["d"]) == day


def test_timestamps_without_a_zone_are_refused(spark):
    texts = spark.createDataFrame([("2026-09-18T20:00:00",), ("2026-09-18T20:00:00+05:30",), ("2026-09-18T14:30:00Z",)], "t string")
    got = [(r["aware"], r["naive"]) for r in texts.select(F.unix_seconds(clock.aware_text_to_instant(F.col("t"))).alias("aware"), F.unix_seconds(clock.ist_text_to_instant(F.col("t"))).alias("naive")).collect()]
    at = got[1][0]
    assert got == [(None, at), (at, None), (at, None)]


def test_guard_raises(spark, filings):
    assert bt.look_ahead_violations(filings, "2026-09-18").count() == 1
    with pytest.raises(Exception, match="look-ahead"):
        bt.guarded(filings, "2026-09-18").collect()
    assert len(bt.guarded(filings, "2026-09-19").collect()) == 3


def test_basis_and_restatement(spark):
    rows = [("standalone", "2015-03-31", 1, "2015-05-20T18:00:00", 100.0), ("standalone", "2016-03-31", 1, "2016-05-20T18:00:00", 110.0), ("consolidated", "2016-03-31", 1, "2016-05-25T18:00:00", 130.0),
            ("standalone", "2017-03-31", 1, "2017-05-20T18:00:00", 120.0), ("consolidated", "2017-03-31", 1, "2017-05-20T18:00:00", 145.0), ("consolidated", "2016-03-31", 2, "2017-08-10T20:00:00", 128.0)]
    df = spark.createDataFrame([("B", "revenue", "disclosure", *r) for r in rows], "isin string, fact string, domain string, basis string, period_end string, version int, usable_from string, value double")
    facts = instants(df, "usable_from").withColumn("period_end", F.col("period_end").cast("date"))

    def basis(day, *periods):
        w = spark.createDataFrame([("B", 1, p) for p in periods], "isin string, window_id int, p string").selectExpr("isin", "window_id", "CAST(p AS DATE) AS period_end")
        return bt.basis_for_windows(bt.period_panel(facts, day), w).first()["basis"]

    assert basis("2017-06-01", "2016-03-31", "2017-03-31") == "consolidated" and basis("2015-06-01", "2015-03-31") == "standalone"
    assert basis("2016-06-01", "2015-03-31", "2016-03-31") is None and basis("2016-05-22", "2016-03-31") == "standalone"
    panel = {day: {str(r["period_end"]): r["value"] for r in bt.period_panel(facts, day).filter("basis = 'consolidated'").collect()} for day in ("2017-08-09", "2017-08-10")}
    assert panel["2017-08-09"]["2016-03-31"] == 130.0 and panel["2017-08-10"] == {"2016-03-31": 128.0, "2017-03-31": 145.0}
    assert str(bt.latest_period(bt.period_panel(facts, "2017-08-10")).filter("basis = 'consolidated'").first()["latest_period"]) == "2017-03-31"


def stream(seed, n):
    rng = random.Random(seed)
    rows = []
    for v in range(1, n + 1):
        day = rng.randint(1, 20)
        late = rng.choice([0, 0, 0, 1, 3, 9])
        rows.append((rng.choice("AB"), rng.choice(["EQ", "BE"]), f"2026-09-{day:02d}", v, f"2026-09-{min(day + late, 30):02d}T{rng.choice(['16:00', '22:30', '23:00', '23:30'])}:00", rng.random() < 0.15, rng.randint(1, 9)))
    return rows


SCHEMA = "isin string, series string, trade_date string, version_no int, usable_from string, is_tombstone boolean, close int"


def build(spark, rows):
    return instants(spark.createDataFrame(rows, SCHEMA), "usable_from").withColumn("trade_date", F.col("trade_date").cast("date")).withColumn("domain", F.lit("exchange_eod"))


def known(df, day, select):
    return sorted(tuple(map(str, r)) for r in select(df, bt.as_day(day)).select("isin", "series", "trade_date", "version_no").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_later_knowledge_never_changes_an_earlier_read(spark, seed):
    rows = stream(seed, 120)
    cut = "2026-09-15T23:00:00"
    early = build(spark, [r for r in rows if r[4] <= cut])
    whole = build(spark, rows)
    latest = lambda df, day: bt.latest_usable(df, bt.exchange_cutoff(day))
    assert known(early, "2026-09-15", latest) == known(whole, "2026-09-15", latest)
    first = lambda df, day: bt.first_known(df.filter(F.col("trade_date") <= day), bt.exchange_cutoff(day))
    assert known(early, "2026-09-15", first) == known(whole, "2026-09-15", first)


@pytest.mark.parametrize("seed", [3, 4])
def test_first_known_matches_brute_force(spark, seed):
    rows = stream(seed, 150)
    horizon = "2026-09-25T23:00:00"
    want = {}
    for key in {r[:3] for r in rows}:
        mine = [r for r in rows if r[:3] == key]
        own = [r for r in mine if r[4] <= f"{key[2]}T23:00:00"]
        later = [r for r in mine if r[4] <= horizon]
        if own:
            want[key] = max(r[3] for r in own)
        elif later:
            want[key] = min(r[3] for r in later)
    got = bt.first_known(build(spark, rows), bt.exchange_cutoff(bt.as_day("2026-09-25"))).collect()
    assert {(r["isin"], r["series"], str(r["trade_date"])): r["version_no"] for r in got} == want


@pytest.mark.parametrize("seed", [5, 6])
def test_as_of_join_with_one_hot_key_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < 0.6 else rng.choice("abc")
    left = [(i, key(), rng.randint(0, 10**7)) for i in range(300)]
    right = [(i, key(), rng.randint(0, 10**7), rng.random()) for i in range(300)]
    want = {}
    for i, k, t in left:
        found = [r for r in right if r[1] == k and r[2] <= t]
        want[i] = max(found, key=lambda r: (r[2], r[0]))[3] if found else None
    l = spark.createDataFrame(left, "id int, k string, t long").withColumn("at", F.timestamp_seconds("t")).drop("t")
    r = spark.createDataFrame(right, "n int, k string, t long, v double").withColumn("seen", F.timestamp_seconds("t"))
    got = {x["id"]: x["v"] for x in bt.as_of(l, r, ["k"], "at", "seen", ["v"], "n", block="day").collect()}
    assert got == want


def test_sentinels_catch_wrong_reads(spark):
    dates = spark.createDataFrame([("2026-09-07",), ("2026-09-08",)], "d string").selectExpr("CAST(d AS DATE) AS trade_date")
    rows = bt.sentinels(dates)
    own = bt.exchange_cutoff(F.col("trade_date"))
    right = bt.latest_events(rows.filter(F.col("usable_from") <= own))
    assert bt.sentinel_audit(right, dates).count() == 0
    newest = bt.latest_events(rows)
    assert {r["problem"] for r in bt.sentinel_audit(newest, dates).collect()} == {"leaked", "missing"}
    assert {r["problem"] for r in bt.sentinel_audit(right.limit(0), dates).collect()} == {"missing"}, "an empty read is never a pass"


def test_canonical_tie_fails(spark):
    rows = [("A", "EQ", "2026-09-07", 1), ("A", "BL", "2026-09-07", 2), ("A", "BE", "2026-09-07", 3)]
    df = spark.createDataFrame(rows, "isin string, series string, d string, version_no int").withColumn("trade_date", F.col("d").cast("date")).drop("d")
    assert [r["series"] for r in bt.canonical_prices(df).collect()] == ["EQ"]
    tie = df.filter("series = 'BL'").withColumn("series", F.lit("XA")).union(df.filter("series = 'BL'").withColumn("series", F.lit("XB")))
    with pytest.raises(Exception, match="two canonical candidates"):
        bt.canonical_prices(tie.select(*df.columns)).collect()


def test_exact_quality_thresholds(spark):
    daily = spark.createDataFrame([("2026-09-01", 20, 20), ("2026-09-02", 19, 19), ("2026-09-03", 17, 17), ("2026-09-04", 18, 18)], "d string, file_rows int, observations int").withColumn("trade_date", F.col("d").cast("date"))
    assert [r["verdict"] for r in quality.row_count_guard(daily).orderBy("d").collect()] == ["first", "ok", "kill", "warn"]
    rows = spark.createDataFrame([("f", "bad" if i < 1 else None) for i in range(20)] + [("g", "bad" if i < 2 else None) for i in range(20)], "file string, reason string")
    assert [r["file"] for r in quality.rejected_files(rows).collect()] == ["g"], "exactly five per cent is accepted"
