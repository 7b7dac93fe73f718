"""The stages one after another against plain versions of their decisions."""

import random

import corpus_pipeline
from pitframe.llm import exact_dedup, minhash, packing, quality_rules
from tests.llm.conftest import prose
from tests.llm.test_free_operators import near_expected
from tests.llm.test_native_operators import exact_expected


def test_stages(spark, docs, corpus, tmp_path):
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    names = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        path = str(tmp_path / name)
        stage(spark, docs, "").write.parquet(path)
        after = spark.read.parquet(path)
        names.append(name)
        if name == "packing":
            assert {r["doc_id"] for r in after.collect()} == set(before)
            continue
        assert after.columns == docs.columns
        rows = after.collect()
        assert all(before[r["doc_id"]] == r for r in rows)
        own = [(i, r["text"], r["lang"], r["source"], r["n_chars"]) for i, r in before.items()]
        expected = {
            "quality": lambda: {r["doc_id"] for r in quality_rules.quality(docs).collect() if r["kept"]},
            "exact_dedup": lambda: {i for i, v in exact_expected(own).items() if v[2]},
            "near_dedup": lambda: {i for i, v in near_expected([o[:2] for o in own]).items() if v[2]},
            "mixing": lambda: set(before),
        }[name]()
        assert sorted(r["doc_id"] for r in rows) == sorted(expected)
        docs = after
    assert names == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert exact_dedup.keep(docs).count() == docs.count() and minhash.keep(docs).count() == docs.count()


def test_empty(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_packing_follows_the_mix(spark, tmp_path):
    """Sequences are numbered in the order of the mix, so every prefix of them has the shares of the mix's prefix."""
    rng = random.Random(3)
    rows = [(i, prose(rng, 40 if i % 3 else 90), "hot" if i % 3 else "other") for i in range(900)]
    tables = {"mixed": rows, "apart": sorted(rows, key=lambda r: r[2])}
    settings = packing.Packing(capacity=512, ordered_items=60)
    got = {}
    for name, own in tables.items():
        path = str(tmp_path / name)
        spark.createDataFrame(own, "doc_id bigint, text string, source string").coalesce(1).write.option("maxRecordsPerFile", 250).parquet(path)
        got[name] = sorted(packing.pack(spark.read.parquet(path), settings, ordered=True).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
        assert sorted((r["doc_id"], r["start"]) for r in got[name]) == sorted((r["doc_id"], r["start"]) for r in packing.pack(spark.read.parquet(path), settings).collect())
        place = {r[0]: k for k, r in enumerate(own)}
        firsts, ends = {}, {}
        for r in got[name]:
            firsts[r["sequence_id"]] = min(firsts.get(r["sequence_id"], 10**9), place[r["doc_id"]])
            assert r["offset"] == ends.get(r["sequence_id"], 0)
            ends[r["sequence_id"]] = r["offset"] + r["length"]
        assert max(ends.values()) <= settings.capacity
        assert list(firsts.values()) == sorted(firsts.values())
    source = {r[0]: r[2] for r in rows}

    def hot(part):
        return sum(r["length"] for r in part if source[r["doc_id"]] == "hot") / sum(r["length"] for r in part)

    target = hot(got["mixed"])
    for at in range(200, len(rows), 100):
        assert abs(hot(got["mixed"][:at]) - target) < 0.08
    assert hot(got["apart"][:300]) > 0.95 and hot(got["apart"][-150:]) < 0.05


def test_pipeline_packs_in_file_order(spark, docs):
    order = [r["doc_id"] for r in docs.select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()]
    firsts = {}
    for r in corpus_pipeline.pack(spark, docs, "").collect():
        firsts[r["sequence_id"]] = min(firsts.get(r["sequence_id"], 10**9), order.index(r["doc_id"]))
    assert [firsts[k] for k in sorted(firsts)] == sorted(firsts.values())
