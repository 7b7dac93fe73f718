"""Mixing, quality rules, license scan and exact dedup against plain Python, with nulls, repeats, long texts and clashing names."""

import hashlib
import math
import re
import textwrap
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pitframe.llm import exact_dedup, license_scan, mixing, quality_rules

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in BLANK.split(text or "") if w]


# ---- exact dedup


def exact_expected(corpus):
    groups = defaultdict(list)
    for doc_id, text, *_ in corpus:
        groups[BLANK.sub("", text or "")].append((-len(text or ""), doc_id))
    result = {}
    for norm, members in groups.items():
        keep = min(members)[1]
        for _, doc_id in members:
            result[doc_id] = (keep, len(members), doc_id == keep, hashlib.sha256(norm.encode()).hexdigest())
    return result


def test_exact_dedup(docs, corpus):
    got = {r[0]: tuple(r)[1:] for r in exact_dedup.deduplicate(docs).collect()}
    assert got == exact_expected(corpus)


@pytest.mark.parametrize("batches", [1, 2, 100])
def test_exact_dedup_does_not_depend_on_batches(docs, corpus, batches):
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.verdicts(docs, batches=batches).collect()}
    assert got == {k: v[:2] for k, v in exact_expected(corpus).items()}


def test_equal_digests_are_settled_by_the_bytes(docs, corpus):
    weak = lambda norm: F.encode(F.substring(norm, 1, 1), "utf-8")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.verdicts(docs, digest=weak).collect()}
    assert got == {k: v[:3] for k, v in exact_expected(corpus).items()}


def test_exact_dedup_keeps_rows_and_columns(docs, corpus):
    kept = exact_dedup.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, v in exact_expected(corpus).items() if v[2])


def test_exact_dedup_null_id_and_empty(spark, empty):
    rows = spark.createDataFrame([(None, "a b"), (5, "ab"), (5, "ab"), (None, "c")], "doc_id bigint, text string")
    got = sorted(map(str, (tuple(r)[:4] for r in exact_dedup.deduplicate(rows).collect())))
    assert got == sorted(["(None, None, 3, True)", "(5, None, 3, False)", "(5, None, 3, False)", "(None, None, 1, True)"])
    assert exact_dedup.deduplicate(empty).count() == 0 and exact_dedup.keep(empty).count() == 0


# ---- quality rules


def repeated_words(words):
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    return len({i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)})


def test_quality_counts(docs, corpus):
    got = {r["doc_id"]: r for r in quality_rules.quality(docs).collect()}
    assert len(got) == len(corpus)
    for doc_id, text, *_ in corpus:
        words = words_of(text)
        lines = [line for line in (text or "").split("\n") if words_of(line)]
        r = got[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), repeated_words(words))
        assert r["base_failed"] == (len(words) < 50 or 100 * r["n_repeat_words"] > 50 * len(words))
        assert not (r["kept"] and r["base_failed"])


def js(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    kl = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
    return math.sqrt((kl(p, q) + kl(q, p)) / 2)


def test_character_distance(docs, corpus):
    def classes(text):
        up, digit, symbol = (len(re.findall(c, text)) for c in ("[A-Z]", "[0-9]", r"[#*$%&|<>]"))
        blank, wide = len(re.findall(r"[\x20\x09-\x0D]", text)), len(text.encode()) - len(text)
        return [up, digit, symbol, blank, wide, len(text) - up - digit - symbol - blank]

    reference = defaultdict(lambda: [0] * 6)
    for _, text, lang, *_ in corpus:
        reference[lang] = [a + b for a, b in zip(reference[lang], classes(text or ""))]
    got = {r["doc_id"]: r["character_distance"] for r in quality_rules.quality(docs).collect()}
    for doc_id, text, lang, *_ in corpus:
        if len(text or "") < quality_rules.Rules.min_characters:
            assert got[doc_id] is None
        else:
            assert got[doc_id] == pytest.approx(js(classes(text), reference[lang]), abs=1e-4)


def test_quality_keeps_prose_and_drops_junk(spark):
    from random import Random

    from tests.llm.conftest import prose

    rng = Random(2)
    rows = [(i, "the on " + prose(rng, 150), "en") for i in range(60)]
    rows += [(100 + i, " ".join(w + "###" for w in prose(rng, 150).split()), "en") for i in range(5)]
    kept = {r["doc_id"] for r in quality_rules.keep(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert kept == set(range(60))


def test_quality_columns_and_empty(docs, empty):
    assert quality_rules.keep(docs).columns == docs.columns
    assert quality_rules.quality(empty).count() == 0 and quality_rules.keep(empty).count() == 0


# ---- license scan


def test_license_base(docs, corpus):
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    for doc_id, text, *_ in corpus:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = [(i, label) for phrase, label in license_scan.PHRASES for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
        r = got[doc_id]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))


def test_set_join_finds_every_block(spark):
    from random import Random

    rng = Random(4)
    templates = [(f"t{i}", " ".join(rng.sample("abcdefghijklmnop", rng.randint(3, 9)))) for i in range(6)]
    lines = [" ".join(rng.choices("abcdefghijklmnopqr", k=rng.randint(0, 25))) for _ in range(300)]
    docs = spark.createDataFrame([(i, "\n".join(lines[i * 3:i * 3 + 3])) for i in range(100)], "doc_id bigint, text string")
    for threshold in (0.5, 0.75, 1.0):
        got = {r["doc_id"]: (r["labels"], round(r["score"], 9)) for r in license_scan.scan(docs, templates, threshold).collect()}
        for i in range(100):
            hits = [(label, len(set(t.split()) & set(line.split())) / len(set(t.split()))) for label, t in templates for line in lines[i * 3:i * 3 + 3]]
            hits = [(label, c) for label, c in hits if c >= threshold]
            assert got[i] == (",".join(sorted({label for label, _ in hits})), round(max([c for _, c in hits], default=0), 9))


def test_wrapped_notices(spark, tmp_path):
    from pitframe.llm import queries

    def wrapped(label, width, mark, number=0):
        own = [text for name, text in license_scan.TEMPLATES if name == label][number]
        return "".join(f"\n{mark}{line}" for line in textwrap.wrap(own.capitalize(), width))

    head = "an the on re ti ou sch ing ble " * 9
    rows = [(1, f"{head}\n/*{wrapped('mit', 72, ' * ')}\n */\n{head}", "mit"), (2, wrapped("bsd", 76, ""), "bsd"), (3, f"{head}{wrapped('mpl', 20, '// ')}{head}", "mpl"),
            (4, wrapped("bsd", 16, "# ") + "\n\n" + wrapped("mit", 70, "\n# "), "bsd,mit"), (5, wrapped("mit", 72, "")[:90] + f"\n{head * 3}\n" + wrapped("mit", 72, "")[90:], ""),
            (6, head, ""), (7, "", ""), (8, None, ""), (9, "\n\n \n", "")]
    rows += [(100 + k, "word " * k + wrapped("mit", 60, ""), "mit") for k in range(70)]  # wherever the windows begin
    spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op3_license_scan(spark, str(tmp_path)).collect()}
    assert {i: r["labels"] for i, r in got.items()} == {r[0]: r[2] for r in rows}
    assert got[1]["score"] == 1.0 and got[5]["score"] == 0.0 and got[8]["n_words"] == 0


def test_license_empty(empty):
    assert license_scan.scan(empty).count() == 0


# ---- mixing


def ideal_mix(parts, counts, n):
    """What each source has handed out after n slots if all run at their weights until they have no block left."""
    done, left = {k: Fraction(0) for k in counts}, Fraction(n)
    while left:
        running = [k for k in counts if done[k] < counts[k]]
        step = min(left / sum(parts[k] for k in running), *((counts[k] - done[k]) / parts[k] for k in running))
        for k in running:
            done[k] += step * parts[k]
        left -= step * sum(parts[k] for k in running)
    return done


@pytest.mark.parametrize("blocks, parts", [
    ({"a": 40, "b": 7, "c": 1, "d": 13}, {"a": 7, "b": 3, "c": 1, "d": 4}),
    ({"a": 30, "b": 30, "c": 300}, {"a": 180, "b": 180, "c": 40}),  # fewer blocks than parts
    ({"a": 19, "b": 2, "c": 55, "d": 3, "e": 3}, {"a": 20, "b": 9, "c": 160, "d": 1, "e": 210}),
])
def test_schedule_is_edf_and_stays_within_one_block_of_the_target(spark, blocks, parts):
    sizes = spark.createDataFrame([(k, 1, 1, blocks[k], parts[k]) for k in blocks], "key string, n_docs bigint, volume bigint, blocks bigint, p int")
    slots = {}
    for r in mixing.schedule(sizes).collect():
        for turn in range(r["first_round"], r["end_round"]):
            slots[r["base"] + (turn - r["first_round"]) * r["slots"] + r["slot"]] = (turn, r["key"], r["k"], r["release"], r["due"], r["slot"])
    assert sorted(slots) == list(range(sum(blocks.values())))  # every block once, no gap
    for turn in {s[0] for s in slots.values()}:
        here = [slots[s] for s in sorted(slots) if slots[s][0] == turn]
        counts = Counter(s[1] for s in here)
        waiting = sorted(here, key=lambda s: s[4])
        seen = Counter()
        for n, (_, key, k, release, due, slot) in enumerate(here):
            assert slot == n and release <= n < due and k == seen[key]
            assert due == min(s[4] for s in waiting if s[3] <= n)  # no released block is due before it
            waiting.remove(here[n])
            seen[key] += 1
            assert all(abs(seen[j] - v) < 1 for j, v in ideal_mix(parts, counts, n + 1).items())


def test_target_weights_hold_when_sources_have_fewer_blocks_than_parts(spark):
    """Up to the slot where the first source runs out, shares are those of the weights, not of the volumes."""
    rows = [(i, "x" * 100, "hot" if i < 900 else "b" if i < 950 else "c") for i in range(1000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), {"hot": 0.2, "b": 0.4, "c": 0.4}, block=100).collect()
    order = [r["source"] for r in sorted(got, key=lambda r: (r["position"], r["place"]))]
    for n in range(1, 126):
        assert all(abs(order[:n].count(s) - n * w) < 1 for s, w in (("hot", 0.2), ("b", 0.4), ("c", 0.4)))
    assert order[125:] == ["hot"] * 875


def test_mix_places_every_row(docs, corpus):
    rows = mixing.mix(docs, block=2000, parts=20, cell_rows=5).collect()
    assert sorted(r["doc_id"] for r in rows) == [c[0] for c in corpus]
    order = lambda i: (int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16), i)
    volume, blocks = defaultdict(int), {}
    for doc_id, text, _, source, _ in sorted(corpus, key=lambda c: order(c[0])):
        blocks[doc_id] = volume[source or ""] // 2000
        volume[source or ""] += len(text or "")
    last = {s: max(1, -(-v // 2000)) - 1 for s, v in volume.items()}
    assert all(r["block"] == min(blocks[r["doc_id"]], last[r["source"] or ""]) for r in rows)
    assert all(r["release"] <= r["position"] < r["due"] for r in rows)
    owner = {}
    assert all(owner.setdefault(r["position"], (r["source"] or "", r["block"])) == (r["source"] or "", r["block"]) for r in rows)


def test_mix_order_and_given_weights(docs, corpus, empty):
    ordered = mixing.in_mix_order(docs)
    assert ordered.columns == docs.columns
    place = {r["doc_id"]: (r["position"], r["place"]) for r in mixing.mix(docs).collect()}
    assert [r["doc_id"] for r in ordered.collect()] == sorted(place, key=place.get)
    rows = mixing.mix(docs, weights={"a": 0.7, "b": 0.3}, block=500, parts=10).collect()
    assert len(rows) == len(corpus)
    assert mixing.mix(empty).count() == 0 and mixing.in_mix_order(empty).count() == 0
