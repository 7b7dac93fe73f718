"""The other operators against brute force, exact round trips or held-out accuracy."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pitframe.llm import crf, html_text, minhash, packing, pii, shingles, suffix_dedup, toxicity
from pitframe.llm.anchors import anchors, segments
from pitframe.llm.components import connected_components
from tests.llm.conftest import prose

# ---- near duplicates


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def smallest_reachable(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def near_expected(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    component = smallest_reachable(ids, linked)
    return {i: (len(sets[i]), component[i], component[i] == i) for i in ids}


def test_near_duplicates(docs, corpus):
    assert {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(docs).collect()} == near_expected([c[:2] for c in corpus])
    kept = minhash.keep(docs)
    assert kept.columns == docs.columns and kept.count() == sum(v[2] for v in near_expected([c[:2] for c in corpus]).values())


def test_links_that_a_star_alone_would_miss(spark):
    """Variants of one text at about the threshold: links run between members far from any centre."""
    rng = random.Random(8)
    base = prose(rng, 120).split()
    rows = []
    for i in range(120):
        copy = list(base if i % 3 else rows[rng.randrange(len(rows))][1].split() if rows else base)
        for _ in range(rng.choice((0, 1, 1, 2, 3, 4))):
            copy[rng.randrange(len(copy))] = prose(rng, 1) + "x"
        rows.append((i, " ".join(copy)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    expected = near_expected(rows)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == expected
    assert 3 < len({v[1] for v in expected.values()}) < 120


def test_near_duplicates_null_id_and_empty(spark, empty):
    rows = spark.createDataFrame([(None, "a b c d e f"), (3, "A b c d e f"), (3, "A b c d e f"), (None, None)], "doc_id bigint, text string")
    assert sorted(map(str, map(tuple, minhash.near_duplicates(rows).collect()))) == sorted(["(3, 2, 3, True)", "(3, 2, 3, True)", "(None, 0, None, True)", "(None, 2, 3, False)"])
    assert minhash.near_duplicates(empty).count() == 0


def test_bins_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(3)
    order = minhash.probe_order()
    for size, changed in ((7, 1), (40, 4), (3000, 200)):
        rates = []
        for _ in range(30):
            a = np.unique(shingles.mixed(rng.integers(0, 1 << 62, size).astype(np.uint64)))
            b = np.unique(np.r_[a[changed:], shingles.mixed(rng.integers(0, 1 << 62, changed).astype(np.uint64))])
            sig = minhash.signatures([a, b], order)
            rates.append((sig[0] == sig[1]).mean())
        assert np.mean(rates) == pytest.approx((size - changed) / (size + changed), abs=0.05)


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    links = [(min(e), max(e)) for e in links if e[0] != e[1]]
    ids = {i for e in links for i in e}
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == smallest_reachable(ids, links)


# ---- repeated passages


def repeats_expected(rows):
    seen, result = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            window = data[p:p + 100]
            if window in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        result[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return result


def test_repeats(docs, corpus):
    assert {r[0]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs).collect()} == repeats_expected([c[:2] for c in corpus])


@pytest.mark.parametrize("spread", [1, 500])
def test_repeats_with_rims_and_periods(spark, monkeypatch, spread):
    monkeypatch.setattr(suffix_dedup, "SPREAD", spread)
    rng = random.Random(5)
    shared = [prose(rng, 60) for _ in range(3)]
    rows = []
    for i in range(60):
        s = rng.choice(shared)
        a = rng.randint(0, 80)
        rows.append((i, prose(rng, 5) + s[a: a + rng.randint(90, 200)] + rng.choice(("", "ab" * rng.randint(40, 90), "\0" * 130)) + prose(rng, 5)))
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == repeats_expected(rows)


def test_repeats_null_id_and_empty(spark, empty):
    text = "ab cd " * 40
    rows = spark.createDataFrame([(None, text), (1, text)], "doc_id bigint, text string")
    assert {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(rows).collect()} == {None: 0, 1: repeats_expected([(1, text)])[1][1]}
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_longest_previous_factors():
    rng = random.Random(6)
    for _ in range(30):
        text = [rng.choice("ab") for _ in range(60)]
        width = 8
        rows = np.array([[ord(c) for c in text[i:i + width]] for i in range(len(text) - width + 1)], np.uint8)
        n = len(rows)
        got = suffix_dedup.longest_previous_factors(rows, np.zeros(n, np.int64), np.arange(n))

        def common(i, j):
            return next((k for k in range(width) if rows[i][k] != rows[j][k]), width)

        assert got.tolist() == [max((common(i, j) for j in range(i)), default=0) for i in range(n)]


def test_every_window_has_its_anchor_by_content(monkeypatch):
    import pitframe.llm.anchors as module

    monkeypatch.setattr(module, "CHUNK", 700)  # long texts are cut with an overlap
    rng = random.Random(9)
    texts = [prose(rng, 300).encode(), b"ab" * 500, b"short", prose(rng, 30).encode()]
    windows = Counter()
    place = {}
    for group in segments(texts):
        a = anchors(group)
        for number, at, first, last in zip(a["text"], a["at"], a["first"], a["last"]):
            for p in range(first, last + 1):
                windows[number, p] += 1
                window = texts[number][p:p + 100]
                assert place.setdefault(window, at - p) == at - p and 0 <= at - p <= 60
    assert windows == Counter({(n, p): 1 for n, t in enumerate(texts) for p in range(len(t) - 99)})


# ---- packing


def test_packing_round_trip(docs, corpus):
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.pack(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert len(by_doc) == len(corpus)
    for doc_id, text, *_ in corpus:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces] == [
            (k, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
    for members in by_sequence.values():
        members.sort(key=lambda r: r["offset"])
        at = 0
        for r in members:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(by_sequence) <= math.ceil(sum(r["length"] for r in rows) / 2048) + 1


def test_tokens_of_odd_texts():
    encoder = packing.WordEncoder(packing._tokenizer(None), remembered=50)
    rng = random.Random(3)
    letters = "abZÉß '’<|>İıſžŽÿŸªº²¼ﬁḰ́ÀÖ×÷øΣσς9०٣中あ🙂 ​\u0085\t\n\x00\x7f_-'s'T'Re#!%"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + ["<|endoftext|>x", "<|EndOfText|>", None]
    for text, ids in zip(texts, packing.token_ids(pa.array(texts), encoder), strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_are_encoded_once_in_a_process(monkeypatch):
    learnt = []
    learn = packing.WordEncoder._learn
    monkeypatch.setattr(packing.WordEncoder, "_learn", lambda self, parts: (learnt.extend(parts), learn(self, parts))[1])
    packing._encoder.cache_clear()
    texts = ["Qzarnu's qzarnu, vbeltö! 中qzarnu\t vbeltö 7", None, "  ", "VBELTÖ <|endoftext|> qzarnu "]
    for part in (texts[:2], texts[2:], texts):  # as three tasks
        encoder = packing._encoder(None)
        for text, ids in zip(part, packing.token_ids(pa.array(part), encoder), strict=True):
            assert ids.tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
    assert sorted(learnt) == sorted(["qzarnu", "'s", ",", "vbeltö", "!", "7"])


def test_genetic_operators_keep_every_piece_once():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 2048, 400)
    settings = packing.Packing()
    population = packing.evolve(lengths, [], settings, 1)
    child = packing.crossover(population[0], population[-1], lengths, 2048, rng)
    for genome in (*population, child, packing.mutate(child, lengths, 2048, rng)):
        assert len(genome) == 400 and genome.min() == 0 and len(np.unique(genome)) == genome.max() + 1
        assert np.bincount(genome, weights=lengths).max() <= 2048
    fitnesses = [packing.fitness(g, lengths, 2048) for g in population]
    assert fitnesses == sorted(fitnesses, key=lambda f: (f[0], -f[1]))
    # what best fit alone leaves open, the search closes: each bin of this set is exactly two, and only the right two fit
    pairs = rng.integers(600, 1400, 150)
    exact = np.r_[pairs, 2048 - pairs]
    assert packing.fitness(packing.evolve(exact, [], packing.Packing(generations=40), 3)[0], exact, 2048)[0] <= 152


def test_packing_empty(empty):
    assert packing.pack(empty).count() == 0


# ---- toxicity


def toxic_rows(rng, n, bad):
    rows = []
    for _ in range(n):
        hits = rng.choice((1, 2, 6)) if rng.random() < 0.3 else 0
        words = prose(rng, rng.randint(20, 200)).split()
        for _ in range(hits):
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((" ".join(words), int(hits > 0), hits))
    return rows


def test_toxicity_held_out():
    rng = random.Random(12)
    bad = [f"zq{k}rude" for k in range(10)]
    rows, held = toxic_rows(rng, 900, bad), toxic_rows(rng, 400, bad)
    toxic = sum(t for _, t, _ in rows)
    model = toxicity.fit_model([r[:2] for r in rows], {0: 900 - toxic, 1: toxic})
    assert (np.diff(model.thresholds) > 0).all()
    scores = np.array([sum(model.weights.get(f, 0) for w in toxicity.words(t) for f in toxicity.features(w)) for t, _, _ in held])
    p, expected, _ = toxicity.predict(scores, model.thresholds)
    truth = np.array([t for _, t, _ in held])
    assert ((p >= 0.5) == truth).mean() > 0.97
    hits = np.array([h for _, _, h in held])
    assert expected[hits == 0].mean() < expected[hits == 1].mean() < expected[hits == 6].mean() <= 3


def test_toxicity_counts_features_on_spark(spark):
    rng = random.Random(13)
    texts = toxic_rows(rng, 400, [f"zq{k}rude" for k in range(10)])
    docs = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(texts)] + [(7, texts[7][0]), (500, None), (501, "")], "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(texts)] + [(500, 1), (501, 0), (900, 0)], "doc_id bigint, toxic int")
    sample, counts = toxicity.labelled_sample(docs, labels, toxicity.Fit())
    assert sample.count() == 402 and sample.select("row").distinct().count() == 402  # a written table, no texts on the driver
    got = toxicity.fit_sample(sample, counts)
    rows = [texts[i][:2] for i in sorted([*range(400), 7])] + [("", 0)]
    want = toxicity.fit_model(rows, counts)
    assert got.weights.keys() == want.weights.keys() and len(got.weights) > 5
    assert np.allclose([got.weights[f] for f in want.weights], [*want.weights.values()]) and np.allclose(got.thresholds, want.thresholds)


def test_toxicity_scores_all_rows(spark, docs, corpus, empty):
    labels = spark.createDataFrame([(i, i % 2, int(i < 25 and i % 5 == 0)) for i in range(60)] + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert sorted(r["doc_id"] for r in got) == [c[0] for c in corpus]
    assert all(0 <= r["p_toxic"] <= 1 and 0 <= r["expected_severity"] <= 3 and r["severity"] in range(4) for r in got)
    nothing = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert len(nothing) == len(corpus) and not any(r["toxic"] for r in nothing)
    assert toxicity.toxicity(empty, labels).count() == 0


# ---- personal data


def test_patterns_and_spans(docs, corpus):
    got = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert len(got) == len(corpus)
    doc_id, text = next((c[0], c[1]) for c in corpus if c[1] and c[1].startswith("mail "))
    r = got[doc_id]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1)
    assert (r["n_national_id"], r["n_secret"], r["n_spans"]) == (0, 1, 5)
    spans = [s.split(":") for s in r["spans"].split(",")]
    assert [(k, text[int(a):int(b)]) for k, a, b in spans] == [
        ("email", "a.b@c.example.com"), ("ip", "10.0.0.1"), ("card", "4111111111111111"), ("phone", "+1 (988) 555-2485"), ("secret", "b7db7aa4a5fcc78305")]
    base = ",".join(":".join(s) for s in spans[:4])
    assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    plain = got[0]
    assert plain["spans"] == "" and plain["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_email_search_equals_the_expression():
    import re

    rng = random.Random(1)
    expression = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    for _ in range(5000):
        text = "".join(rng.choice("ab@@.._ -%") for _ in range(rng.randint(0, 25)))
        assert [m.span() for m in expression.finditer(text)] == list(pii.emails(text))
    assert list(pii.emails("a" * 200_000 + "@")) == []


def test_long_numbers_do_not_break_the_patterns():
    assert pii.base_spans("9" * 6000 + ".1.1.1 " + "0" * 5000 + "1.1.1.1") == [("ip", 6007, 6007 + 5007)]


def test_pii_held_out():
    model = pii.trained()
    rows = pii.labelled_table(copies=6, seed=77)
    texts = [t for t, _ in rows]
    found = pii.added_spans(texts, [[] for _ in texts], model)
    truth = [{s for s in spans if s[0] in pii.ADDED} for _, spans in rows]
    hit = sum(len(t & set(f)) for t, f in zip(truth, found))
    assert hit / sum(map(len, truth)) > 0.9 and hit / max(1, sum(map(len, found))) > 0.9


def test_pii_reads_every_token(spark):
    """Digit-free credentials wherever they stand, items that the patterns miss, and no verdict by an unrelated number near by."""
    head = "an the on re ti ou sch ing ble " * 6
    cases = [
        ("login password=correct-horse-battery then go", [("secret", "correct-horse-battery")]), (head + "password=correct-horse-battery " + head, [("secret", "correct-horse-battery")]),
        (head + "1984 " + head + "\npassword=correct-horse-battery", [("secret", "correct-horse-battery")]), ("token=AbCdEfGhIjKlMn on", [("secret", "AbCdEfGhIjKlMn")]),
        ("call (555) 123-4567 the on", [("phone", "(555) 123-4567")]), ("re phone 555-123-4567", [("phone", "555-123-4567")]), (head, []), ("the password on the key re", []),
        ("re 10.0.0.256 on", []),
    ]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id bigint, text string")
    for r in pii.find(frame).collect():
        text, expected = cases[r["doc_id"]]
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        assert [(k, text[int(a):int(b)]) for k, a, b in spans] == expected
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (0, 0, 0, 0)


def base_expected(text):
    """The four expressions of the contract by the regex module's plain search."""
    import re

    def luhn(digits):
        doubled = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(reversed(digits))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    spans = []
    for kind, expression, right in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub(r"\D", "", m)) <= 15),
    ):
        spans += [(kind, *m.span()) for m in re.finditer(expression, text) if right(m[0])]
    return spans


def test_pattern_spans_equal_the_expressions():
    rng = random.Random(6)
    pieces = ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1112", "10.0.0.1", "1.2.3.4.5.6.7.8", "10.0.0.256", "+49 123 456789", "+1 (988) 555-2485", "+1", "a@b.c", "a@b",
              " ", "-", "x", "7", "+", "on ", "378282246310005", "12345678901234567890"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
        assert pii.base_spans(text) == base_expected(text)


def test_spans_are_ordered_by_kind_as_listed():
    spans = [("secret", 0, 1), ("phone", 37, 53), ("phone", 5, 19), ("national_id", 2, 3), ("email", 90, 99), ("ip", 1, 2), ("card", 4, 5)]
    assert [s[0] for s in pii.in_order(spans)] == ["email", "ip", "card", "phone", "phone", "national_id", "secret"] and pii.in_order(spans)[3] == ("phone", 5, 19)


def test_tokens_equal_the_expression():
    rng = random.Random(3)
    texts = ["", "a", "\n\n", "=", "é=\u3000b\u00a0c\x85d\x1ce \U0001F642=x", "no end\r\nline \u2028 same"]
    texts += ["".join(rng.choice("aé🙂= \n\r\"'(x:\u2003") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    t = pii.tokens_of(texts)
    owner = np.repeat(t.owner, t.lengths)
    got = {}
    for a, b, w, i in zip(t.begin, t.end, t.word, owner, strict=True):
        got.setdefault(int(i), []).append((int(a - t.text_begin[i]), int(b - t.text_begin[i])))
        assert texts[i][a - t.text_begin[i]: b - t.text_begin[i]] == t.words[w]
    assert got == {i: spans for i, text in enumerate(texts) if (spans := [m.span() for m in pii.TOKEN.finditer(text)])}
    import re

    assert t.lengths.tolist() == [n for text in texts for line in re.split("[\n\r]", text) if (n := len(pii.TOKEN.findall(line)))]


def test_lines_left_out_of_the_search_have_no_label():
    rng = np.random.default_rng(11)
    left_out = 0
    for seed in range(60):
        labels = 5
        model = crf.Model(None, rng.normal(size=(labels, labels)), rng.normal(size=labels))
        lengths = rng.integers(1, 7, 20)
        score = rng.normal(size=(lengths.sum(), labels)) * 2
        score[:, pii.OUTSIDE] += rng.choice([2.0, 6.0, 9.0], lengths.sum())
        path = crf.decode(model, score, lengths)
        searched = set(pii.undecided(model, score, lengths).tolist())
        begin = np.cumsum(lengths) - lengths
        for k in set(range(len(lengths))) - searched:
            left_out += 1
            assert (path[begin[k]: begin[k] + lengths[k]] == pii.OUTSIDE).all()
    assert left_out > 100


def test_gradient_of_the_likelihood():
    """Against differences of the likelihood itself."""
    rng = np.random.default_rng(13)
    model = crf.Model(None, rng.normal(size=(3, 3)), rng.normal(size=3))
    lengths = np.array([1, 4, 2])
    score, mask = crf.padded(rng.normal(size=(lengths.sum(), 3)), lengths)
    gold, _ = crf.padded(rng.integers(0, 3, lengths.sum()), lengths, 0)
    _, by_score, by_pair, by_initial = crf.log_likelihood(model, score, mask, gold)
    for values, gradient in ((score, by_score), (model.transitions, by_pair), (model.initial, by_initial)):
        for at in np.ndindex(values.shape):
            if values is score and not mask[at[:2]]:
                continue
            before, ends = values[at], []
            for step in (1e-5, -1e-5):
                values[at] = before + step
                ends.append(crf.log_likelihood(model, score, mask, gold)[0])
            values[at] = before
            assert abs((ends[0] - ends[1]) / 2e-5 - gradient[at]) < 1e-6


def test_pii_scores_are_those_of_the_features():
    rng = np.random.default_rng(2)
    model = crf.Model(rng.normal(size=(pii.FEATURES, len(pii.LABELS))), None, None)
    lines = [t for t, _ in pii.labelled_table(copies=1, seed=5)]
    tokens = [pii.TOKEN.findall(t) for t in lines]
    got = pii.Scores(model).of([t for own in tokens for t in own], np.array([len(own) for own in tokens]))
    assert np.allclose(got, np.array([model.weights[f].sum(0) for own in tokens for f in pii.features(own)]))


def test_viterbi_is_the_best_path():
    from itertools import product

    rng = np.random.default_rng(4)
    model = crf.Model(rng.normal(size=(20, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    lengths = np.array([1, 4, 6, 2, 5])
    features = rng.integers(0, 20, lengths.sum() * 2)
    starts = np.arange(lengths.sum()) * 2
    got = crf.viterbi(model, features, starts, lengths)
    score = crf.emissions(model, features, starts)
    at = 0
    for n in lengths:
        own = score[at:at + n]
        best = max(product(range(3), repeat=int(n)), key=lambda y: model.initial[y[0]] + sum(own[i, y[i]] for i in range(n)) + sum(model.transitions[y[i], y[i + 1]] for i in range(n - 1)))
        assert tuple(got[at:at + n]) == best
        at += n


def test_pii_empty(empty):
    assert pii.find(empty).count() == 0


# ---- pages


def test_pages_held_out():
    model = html_text.trained()
    wrong = total = 0
    for html, labels in html_text.labelled_pages(60, seed=123):
        page = html_text.blocks(html)
        got = crf.viterbi(model, *html_text._encoded([html_text.features(page)]))
        wrong += int((got != np.array(labels)).sum())
        total += len(labels)
    assert wrong / total < 0.01


def test_pages_text(spark):
    pages = [
        (1, "u", "<html><body><nav><a href='/'>Menu</a></nav><article><h1>A  title &amp; more</h1><p>One<br>two <b>three</b>&nbsp;four.<p>Five &eacute;.<script>x()</script></article><footer>&copy; me</footer></body></html>"),
        (2, None, None), (2, None, ""), (3, "u", "<p"), (4, "u", "<div class='ad'>buy</div><!-- <p>hidden</p> -->"), (None, "u", "<article><p>" + "long words " * 100_000),
    ]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = html_text.extract(frame).collect()
    assert len(got) == 6 and all(r["n_chars"] == len(r["text"]) for r in got)
    texts = {r["page_id"]: r["text"] for r in got}
    assert texts[1] == "A title & more\nOne two three four.\nFive é."
    assert texts[2] == "" and texts[4] == "" and texts[None] == ("long words " * 100_000).strip()
    assert html_text.extract(frame.limit(0)).count() == 0


def test_pages_lose_no_text(spark):
    """Self-closed drawings, formulas and fallbacks in the article, and elements with many class words."""
    start, end = "<html><body><nav><ul><li><a href='/'>Menu</a></li></ul></nav><article><p>First part of the text, long enough.</p>", "<p>Last part of the text, long enough.</p></article><footer>&copy; me</footer></body></html>"
    first, last = "First part of the text, long enough.", "Last part of the text, long enough."
    cases = {
        '<svg class="icon"/><p>Middle.</p>': "Middle.", "<math/><p>Middle.</p>": "Middle.", '<p>See <svg class="i"><title>Icon</title><path d="M0"/><g></g></svg> this <svg/>line.</p>': "See this line.",
        "<p>Where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>": "Where x=2 holds.", "<noscript><p>Shown without scripts.</p></noscript>": "Shown without scripts.",
        "<p>A <canvas>drawn text</canvas> here.</p>": "A drawn text here.", "<p>An <object data='x'>object text</object> here.</p>": "An object text here.",
        "<svg><g><text>One label</text><text>Other label</text></g></svg>": "One label\nOther label", "<svg><path d='M0'><p>One.</p><p>Two.</p>": "One.\nTwo.", "<iframe src='/x'/><p>After a frame.</p>": "After a frame.",
        "<template><p>never</p></template><script>never()</script><style>p{}</style><svg><style>p{}</style></svg>": None,
        '<div class="wp-block-column is-layout-flow has-background sidebar"><h4>Read more</h4><p>Some other long text that stands at the side of it.</p></div>': None,
    }
    rows = [(i, start + middle + end) for i, middle in enumerate(cases)]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id bigint, html string").selectExpr("*", "'u' AS url")).collect()}
    for i, expected in enumerate(cases.values()):
        assert got[i] == "\n".join(x for x in (first, expected, last) if x is not None)
