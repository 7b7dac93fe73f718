"""Ranked search, web archives and centroid clustering against plain versions."""

import base64
import gzip
import hashlib
import io
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitframe.llm import clustering, lexical_search, warc
from tests.llm.conftest import prose

# ---- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def search_expected(rows, items, top=10):
    bags = [(i, terms(t)) for i, t in rows]
    bags = [(i, w) for i, w in bags if w]
    total, n_docs = sum(len(w) for _, w in bags), len(bags)
    df = {}
    for _, w in bags:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    result = {}
    for item, words in wanted.items():
        scored = []
        for i, w in bags:
            m = 10 + (90 * len(w) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * w.count(t)) // (1000 * w.count(t) + 8 * m)) for t in words if t in w)
            if score > 0:
                scored.append((-score, math.inf if i is None else i))
        if scored:
            result[item] = [(r, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scored)[:top], 1)]
    return result


def ranked(frame):
    got = {}
    for r in sorted(frame.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return got


ITEMS = [(1, "The AN on; re-ti É one two"), (2, None), (3, " .. "), (4, "nowhere_to_be found"), (4, "edit license"), (None, "ab mit ción"), (5, "\x00b x")]


@pytest.mark.parametrize("pairs", [500_000, 3])
def test_search(spark, docs, corpus, empty, pairs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumns({n: F.lit(1) for n in ("terms", "rank", "id", "item", "block", "score")})
    expected = search_expected([c[:2] for c in corpus], ITEMS)
    assert ranked(lexical_search.search(docs, items, pairs=pairs)) == expected and len(expected) == 4
    assert lexical_search.search(empty, items, pairs=pairs).count() == 0
    assert lexical_search.search(docs, items.limit(0), pairs=pairs).count() == 0


def test_search_expands_classes_of_copies_and_ties(spark):
    rng = random.Random(5)
    rows = [(i, "alpha beta") for i in rng.sample(range(1000, 9000), 3000)]  # one class
    rows += [(i, "beta  ALPHA!") for i in range(40, 45)]  # the same bag
    rows += [(7, "alpha beta")] * 3 + [(None, "alpha beta"), (2, "alpha gamma"), (3, "gamma alpha"), (1, "alpha beta delta")]
    rows += [(20_000 + i, prose(rng, 30)) for i in range(200)]
    rng.shuffle(rows)
    items = [(1, "alpha"), (2, "alpha beta"), (3, "gamma beta"), (4, "delta")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    expected = search_expected(rows, items)
    assert [d for _, d, _ in expected[2]] == [7, 7, 7, 40, 41, 42, 43, 44] + sorted(r[0] for r in rows if r[0] and 1000 <= r[0] < 9000)[:2]
    assert ranked(lexical_search.search(docs, spark.createDataFrame(items, "item_id bigint, text string"))) == expected
    bags = docs.mapInArrow(lexical_search._bag_batches({b"alpha": 0, b"beta": 1, b"gamma": 2, b"delta": 3}), lexical_search.BAGS)
    classes = lexical_search.bag_classes(bags, len(rows), 3 * len(rows)).collect()
    assert sorted(len(r["members"]) for r in classes) == [1, 2, 10]


def test_scores_are_cut_into_steps(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(1, 60))) for i in range(300)]
    items = [(i, prose(rng, 8)) for i in range(30)]
    monkeypatch.setattr(lexical_search, "CELLS", 50)
    docs, asked = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert ranked(lexical_search.search(docs, asked)) == search_expected(rows, items)


# ---- web archives


def archive_expected(rows, least=1000):
    payloads = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if page is not None and len(data) >= least:
            payloads[data] = max(page, payloads.get(data, page))
    result = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = payloads.get(data)
        again = first is not None and page != first
        result.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(result, key=repr)


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(4)
    copied, trap = "<p>" + prose(rng, 400), "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n"
    rows = [(i, f"http://e.example/{i}?q=ä ö\n", f"<html>{prose(rng, rng.randint(1, 300))}</html>") for i in range(30)]
    rows += [(100 + i, None if i % 2 else "http://c.example/", copied) for i in range(9)]
    rows += [(200, "u", "x" * 1000), (201, "u", "x" * 1000), (202, "u", "y" * 999), (203, "u", "y" * 999), (204, "é", "é" * 500), (205, "é", "é" * 500)]
    rows += [(300, "", None), (301, None, ""), (None, "n", copied), (None, None, None), (302, "t", trap * 50), (303, "t", "\r\n"), (304, "t", "\x00\n\r\n")]
    rows += [(400, "same", "z" * 2000)] * 3 + [(401, "same", "q" * 30), (401, "other", "w" * 5000)]
    rows += [(500, "long", prose(rng, 90_000))]
    return rows


PAGES = "page_id bigint, url string, html string"


def test_archives_round_trip(spark, pages, tmp_path):
    frame = spark.createDataFrame(pages, PAGES).withColumns({n: F.lit("x") for n in ("payload", "identity", "chunk", "last", "sha1", "path", "record_id", "n", "d")}).repartition(3)
    for chunk, archive in ((warc.CHUNK, warc.ARCHIVE), (97, 3000)):
        got = warc.round_trip(frame, chunk, archive).collect()
        assert sorted((tuple(r)[:5] for r in got), key=repr) == archive_expected(pages)
        assert all(r["intact"] for r in got)
        assert {r["n_chunks"] for r in got if r["page_id"] == 500} == {-(-len(pages[-1][2].encode()) // chunk)}


def test_chunk_table_carries_whole_texts_and_running_digests(spark, pages, tmp_path):
    manifest = warc.write_archives(spark.createDataFrame(pages, PAGES), str(tmp_path / "archives"), 1000, 20_000)
    listed = manifest.collect()
    assert len(listed) > 3 and sum(r["records"] for r in listed) == len(pages)
    found = {}
    for r in warc.read_archives(manifest, 1000).orderBy("path", "record", "chunk").collect():
        own = found.setdefault((r["path"], r["record"]), {"type": r["record_type"], "page": r["page_id"], "url": r["url"], "data": b"", "n": 0})
        assert r["chunk"] == own["n"] and len(r["data"]) <= 1000
        own["data"] += r["data"]
        own["n"] += 1
        assert r["bytes_so_far"] == len(own["data"]) and (own["type"] == "revisit" or r["digest_so_far"] == hashlib.sha1(own["data"]).hexdigest())
    wanted = sorted((repr((p, u, h or "")) for p, u, h in pages))
    revisits = [v for v in found.values() if v["type"] == "revisit"]
    assert all(v["data"] == b"" for v in revisits) and len(revisits) == sum(r[3] == "revisit" for r in archive_expected(pages))
    held = sorted(repr((v["page"], v["url"], v["data"].decode())) for v in found.values() if v["type"] == "response")
    assert set(held) <= set(wanted) and len(held) == len(pages) - len(revisits)


def test_records_are_members_that_other_readers_find(spark, pages, tmp_path):
    """Each gzip member is one record whose length and digest fields are right."""
    import zlib

    manifest = warc.write_archives(spark.createDataFrame(pages, PAGES).coalesce(1), str(tmp_path / "archives"))
    total = 0
    for r in manifest.collect():
        rest = open(r["path"], "rb").read()
        while rest:
            expand = zlib.decompressobj(31)
            head, _, block = expand.decompress(rest).partition(b"\r\n\r\n")
            rest, total = expand.unused_data, total + 1
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\n") and block.endswith(b"\r\n\r\n") and len(block) == int(fields["Content-Length"]) + 4
            payload = block[:-4].partition(b"\r\n\r\n")[2]
            if fields["WARC-Type"] == "response":
                assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    assert total == len(pages)


def test_foreign_archives_are_read(spark, tmp_path):
    """Uncompressed, compressed as one stream, with records that hold no page."""
    body = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\nhello\r\n\r\nWARC/1.0\r\n"
    info = b"software: x\r\n"
    text = (b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: " + str(len(info)).encode() + b"\r\n\r\n" + info + b"\r\n\r\n"
            + b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a/\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n")
    (tmp_path / "a.warc").write_bytes(text)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(text))
    (tmp_path / "empty.warc").write_bytes(b"")
    manifest = spark.createDataFrame([(str(tmp_path / n),) for n in ("a.warc", "b.warc.gz", "empty.warc")], "path string")
    rows = warc.read_archives(manifest).collect()
    assert len(rows) == 4 and {bytes(r["data"]) for r in rows if r["record_type"] == "response"} == {b"hello\r\n\r\nWARC/1.0\r\n"}
    with pytest.raises(ValueError, match="ends inside"):
        for _ in warc.records(io.BytesIO(text[:-30])):
            pass


def test_lost_attempts_leave_nothing_in_the_manifest(spark, pages, tmp_path):
    folder = str(tmp_path / "archives")
    manifest = warc.write_archives(spark.createDataFrame(pages, PAGES), folder)
    (tmp_path / "archives" / "000000-999-0.warc.gz").write_bytes(b"\x1f\x8bcut off")
    assert warc.archived(manifest).count() == len(pages)


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


# ---- centroid clustering


def clusters_expected(rows, clusters=8, rounds=10, components=64):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:clusters]
    centroids = [v for _, v in seeds]
    if not centroids:
        return []

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(assign(v)[1], []).append(v)
        centroids = [[sum(column) // len(members[k]) for column in zip(*members[k])] if k in members else c for k, c in enumerate(centroids)]
    final = [(i, *assign(v)) for i, v in kept]
    inertia = {k: sum(d for _, d, c in final if c == k) for k in range(len(centroids))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), digests[k]) for i, d, k in final), key=repr)


EMBEDDINGS = "vec_id bigint, embedding array<float>"


def test_clusters(spark):
    rng = random.Random(2)

    def near(centre):
        return [float(np.float32(x + rng.gauss(0, 0.05))) for x in centre]

    centres = [[rng.gauss(0, 0.2) for _ in range(64)] for _ in range(5)]
    rows = [(i, near(rng.choice(centres))) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # a third of all rows is one vector
    rows += [rows[5], rows[5], (None, rows[6][1]), (400, None), (401, []), (402, rows[0][1][:63]), (403, rows[0][1] + [0.0]), (404, [None] + rows[0][1][1:]),
             (405, [float("nan")] + rows[0][1][1:]), (406, [float("-inf")] + rows[0][1][1:]), (407, [-0.0] * 64)]
    frame = spark.createDataFrame(rows, EMBEDDINGS).withColumns({n: F.lit("x") for n in ("v", "cluster", "total", "place", "label")}).repartition(5)
    assert sorted(map(tuple, clustering.cluster(frame).collect()), key=repr) == clusters_expected(rows)
    few = rows[:3] + [rows[0]]
    assert sorted(map(tuple, clustering.cluster(spark.createDataFrame(few, EMBEDDINGS)).collect()), key=repr) == clusters_expected(few)
    assert clustering.cluster(spark.createDataFrame([], EMBEDDINGS)).count() == 0
    assert clustering.cluster(spark.createDataFrame([(1, None), (None, rows[0][1])], EMBEDDINGS)).count() == 0


def test_huge_components_saturate(spark):
    rows = [(i, [3e38 if i % 2 else -3e38] * 64) for i in range(20)]
    got = clustering.cluster(spark.createDataFrame(rows, EMBEDDINGS)).collect()
    assert len(got) == 20 and {r["distance"] for r in got} == {0}


@pytest.mark.parametrize("k", [1, 2, 3, 8, 40])
def test_tree_search_equals_all_distances(k):
    rng = np.random.default_rng(k)
    for spread in (2, 5, 1000):  # small spreads make ties and equal centroids
        centroids = rng.integers(-spread, spread + 1, (k, 6))
        vectors = rng.integers(-spread, spread + 1, (400, 6))
        every = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        number, distance = clustering.nearest(vectors, centroids, clustering.build_tree(centroids))
        assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_tree_prunes(monkeypatch):
    """Vectors near a far-off centroid do not see most of the others."""
    rng = np.random.default_rng(1)
    centroids = rng.integers(-10**6, 10**6, (64, 3))
    vectors = centroids[rng.integers(0, 64, 500)] + rng.integers(-5, 6, (500, 3))
    nodes, seen = clustering.build_tree(centroids), [0]
    plain = clustering.squared

    def counted(v, c):
        seen[0] += len(v)
        return plain(v, c)

    monkeypatch.setattr(clustering, "squared", counted)
    clustering.nearest(vectors, centroids, nodes)
    assert seen[0] < 500 * 64 / 3
