"""Whitening, phrase mining and decontamination against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import phrases, whitening, winnowing
from tidemark.llm.bitmaps import bit_table, perhaps

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, document long, size int, n long, words string"


def documents(spark, rows):
    """Rows of (doc_id, text, lang) with further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, "s", 1, 2, 3, 4, "w") for i, t, lang in rows], DOCUMENTS)


def prose(seed: int, n: int, words: int = 40) -> str:
    rng = np.random.default_rng(seed)
    known = [f"w{i}" for i in range(words)]
    out = []
    for at in range(n):
        out.append(known[int(words * rng.random() ** 2)])
        if at % 9 == 8:
            out[-1] += ". "[int(rng.random() < 0.2) :] + "\n"
    return " ".join(out)


def test_bit_table_holds_what_it_was_given(spark):
    given = spark.range(0, 5000).select(F.xxhash64("id").alias("h"))
    table = bit_table(given, F.col("h"), 1 << 18)
    inside = np.array([r["h"] for r in given.collect()], np.int64).view(np.uint64)
    assert perhaps(table, inside).all() and np.unpackbits(table).sum() <= 5000
    other = np.random.default_rng(1).integers(0, 1 << 62, 20_000).astype(np.uint64)
    assert perhaps(table, other).mean() < 0.05
    assert not perhaps(bit_table(given.limit(0), F.col("h"), 1 << 15), inside).any()


# Whitening


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_components_match_a_dense_solver(n):
    rng = np.random.default_rng(n)
    a = rng.normal(size=(200, n)) * np.linspace(1, 30, n)
    a = a.T @ a / 200
    values, vectors = whitening.spectral_components(a, min(n, 16))
    known, basis = np.linalg.eigh(a)
    k = len(values)
    assert np.allclose(values, known[::-1][:k], rtol=1e-12)
    assert np.allclose(np.abs((vectors * basis[:, ::-1][:, :k]).sum(axis=0)), 1, atol=1e-10)


def test_components_of_equal_and_zero_eigenvalues():
    values, vectors = whitening.spectral_components(np.diag([5.0, 5, 5, 2, 2, 0, 0]), 7)
    assert np.allclose(values, [5, 5, 5, 2, 2, 0, 0], atol=1e-12) and np.allclose(vectors.T @ vectors, np.eye(7), atol=1e-12)
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    spread = np.array([7.0] * 10 + [7.0 - 1e-9] * 10 + [1e-7] * 10)
    values, vectors = whitening.spectral_components((q * spread) @ q.T, 30)
    assert np.allclose(values, spread, atol=1e-12) and np.allclose(vectors.T @ vectors, np.eye(30), atol=1e-12)


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    values = np.array([3, 1, 1e-9, 1e-3, 2, 9, -1, -1e-12, -4, -2, -1e-5, -7.0])
    assert np.allclose(whitening.polar_factor((q * values) @ q.T), (q * np.sign(values)) @ q.T, atol=1e-4)


def brute_whitening(vectors, k):
    """(rows of integers, n, sums, eigenvalues, components, trace) by plain numpy and whole numbers."""
    good = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in good]
    distinct = sorted({tuple(v) for v in x})
    n = len(distinct)
    sums = [sum(v[i] for v in distinct) for i in range(len(distinct[0]))]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in distinct])
    cov = centred.T @ centred / n
    values, basis = np.linalg.eigh(cov)
    return x, n, sums, values[::-1][:k], basis[:, ::-1][:, :k], np.trace(cov)


def test_whitening_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    made = (rng.normal(size=(400, 20)) * np.linspace(0.2, 3, 20)).astype(np.float32).tolist()
    vectors = made + [made[0]] * 300 + [None, [None] + made[1][1:], [float("nan")] + made[1][1:], made[2][:-1] + [float("inf")], [1.0] * 19]
    rows = [(None if i == 5 else i, v, 1, "n", "x") for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, deviation string, x string")
    found = whitening.whiten(df.repartition(7), 16).collect()
    x, n, sums, values, basis, trace = brute_whitening(vectors[:-1], 16)
    assert len(found) == 700 and sum(r["vec_id"] is None for r in found) == 1
    by_id = {r["vec_id"]: r for r in found}
    for i in (0, 3, 50, 399, 650):
        r = by_id[i]
        assert r["n"] == n == 400 and int(r["deviation"]) == sum((n * a - s) ** 2 for a, s in zip(x[i], sums, strict=True))
        mine = (np.array([(n * a - s) / n for a, s in zip(x[i], sums, strict=True)]) @ basis) / np.sqrt(values)
        assert np.allclose(np.abs(r["whitened"]), np.abs(mine), rtol=1e-8, atol=1e-9)
        assert np.allclose(r["explained"], values / trace, rtol=1e-10) and r["identity_error"] < 1e-9
    signs = {tuple(np.sign(np.array(by_id[i]["whitened"]) * ((np.array([(n * a - s) / n for a, s in zip(x[i], sums, strict=True)]) @ basis)))) for i in range(6, 200)}
    assert len(signs) == 1


def test_whitening_is_the_same_for_every_layout(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rng.normal(size=(200, 6)).tolist())], "vec_id long, embedding array<double>")
    one, other = (sorted(whitening.whiten(df.repartition(k), 6).drop("identity_error").collect()) for k in (1, 9))
    assert one == other


def test_whitening_of_odd_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)).collect()
    assert len(same) == 5 and all(r["whitened"] == [] and r["deviation"] == 0 and r["n"] == 1 for r in same)
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.5]) for i in range(5)], schema)).collect()
    assert {len(r["whitened"]) for r in line} == {1}
    huge = [(0, [1e14, 1.0]), (1, [-1e14, 2.0]), (2, [3.0, 5.0]), (3, [1e300, 0.0])]
    found = {r["vec_id"]: r for r in whitening.whiten(spark.createDataFrame(huge, schema)).collect()}
    x, n, sums, *_ = brute_whitening([v for _, v in huge[:3]], 2)
    assert set(found) == {0, 1, 2} and all(int(found[i]["deviation"]) == sum((n * a - s) ** 2 for a, s in zip(x[i], sums, strict=True)) for i in range(3))


# Phrases


def brute_counts(rows, longest):
    times, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    times[lang, tuple(words[at : at + size])] += 1
    return times, totals


def brute_collocations(rows, support, longest, first, covered):
    times, totals = brute_counts(rows, longest)
    out = defaultdict(list)
    candidates = {k: a for k, a in times.items() if len(k[1]) > 1 and a >= support}
    longer = Counter()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for at in range(len(words) - size + 1):
                longer[lang, words[at : at + size]] = max(longer[lang, words[at : at + size]], a)
    for (lang, words), a in candidates.items():
        if (lang, words) in longer and 100 * longer[lang, words] >= covered * a:
            continue
        score, k = min((1_000_000 * a * a // (times[lang, words[:k]] * times[lang, words[k:]]), k) for k in range(1, len(words)))
        out[lang].append((-score, -a, " ".join(words).encode(), times[lang, words[:k]], times[lang, words[k:]]))
    return {
        (lang, i, p.decode(), -a, left, right, totals[lang], -score)
        for lang, found in out.items()
        for i, (score, a, p, left, right) in enumerate(sorted(found)[:first], 1)
    }


PHRASE_ROWS = [
    *[(i, prose(i, 300), ["en", "de", None][i % 3]) for i in range(30)],
    *[(500 + i, "hot Words come; back again and again", "en") for i in range(400)],  # copies, far more than the rest
    (None, "a a a a a a a a a a a a a a", "en"),
    (900, None, "en"),
    (901, "", None),
    (902, " \t.,;\n", "fr"),
    (903, "x" * 30_000 + " " + "long text " * 5_000, "en"),
    (904, "ÄÖ äö ÄÖ äö", "de"),
    *[(905, "same row twice", "es")] * 2,
]


@pytest.mark.parametrize(("support", "longest", "shards", "bits"), [(10, 3, 4, 1 << 20), (3, 4, 2, 1 << 15), (25, 2, 7, 1 << 20)])
def test_collocations_match_brute_force(spark, support, longest, shards, bits):
    df = documents(spark, PHRASE_ROWS).repartition(5)
    found = phrases.collocations(df, support, longest, 25, 50, shards, bits)
    assert {tuple(r) for r in found.collect()} == brute_collocations(PHRASE_ROWS, support, longest, 25, 50)


def test_no_frequent_phrase_is_lost_by_the_shards(spark):
    """Each shard alone has too few occurrences; thresholds follow the shares."""
    rows = [(i, f"rare pair {i}a {i}b", "en") for i in range(12)] + [(100 + i, prose(i, 200, 5), "en") for i in range(20)]
    counted, _ = phrases.frequent_phrases(documents(spark, rows), 10, 3, 9, 1 << 18)
    times, _ = brute_counts(rows, 3)
    assert {(r["lang"], tuple(r["phrase"].split(" "))): r["times"] for r in counted.collect()} == {k: a for k, a in times.items() if a >= 10}


def test_collocations_of_an_empty_table(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0
    assert phrases.collocations(documents(spark, [(1, None, None)])).count() == 0


def test_mining_prunes(spark):
    """Phrases that no shard finds frequent are not counted: far fewer rows than there are phrases."""
    rows = [(i, prose(i, 200, 4000), "en") for i in range(40)]
    counted, totals = phrases.frequent_phrases(documents(spark, rows), 10, 3, 4, 1 << 18)
    assert counted.count() < 500 and totals.head()["n"] == 8000


# Winnowing


def brute_contamination(rows, items, window=10):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    known = defaultdict(set)
    for item, text in items:
        found = words(text)
        size = min(len(found), window)
        for at in range(len(found) - size + 1 if size else 0):
            known[tuple(found[at : at + size])].add(item)
    sizes = {len(k) for k in known}
    out = []
    for i, text, _ in rows:
        found, hit, ids = words(text), set(), set()
        for size in sizes:
            for at in range(len(found) - size + 1):
                key = tuple(found[at : at + size])
                if key in known:
                    hit |= set(range(at, at + size))
                    ids |= {str(x) for x in known[key] if x is not None}
        out.append((i, len(found), len(hit), sorted(ids), bool(hit)))
    return out


PASSAGE = "The quick BROWN fox jumps-over 13 lazy dogs while ünï code sings and nobody counts the remaining words of this line"
ITEMS = [
    (1, PASSAGE),
    (2, "tiny"),
    (3, "two words"),
    (10, PASSAGE[:60]),
    (11, "a b a b a b a b a b a b"),
    (12, ""),
    (13, None),
    (None, "an item without id has seven words"),
    (14, "Exactly ten words are in this one item right here"),
    (14, "same id another text with more than ten words in all of it"),
]


def contaminated_rows():
    long = PASSAGE.lower().split()
    rows = [(i, prose(i, 150), "en") for i in range(12)]
    rows += [(100 + i, prose(i, 40) + " " + " ".join(long[i : i + 10 + i % 4]) + " " + prose(i + 1, 30), "en") for i in range(9)]
    rows += [(200 + i, " ".join(long[i : i + 9]), "en") for i in range(9)]  # one word too few
    rows += [(300 + i, PASSAGE, "en") for i in range(200)]  # a passage in most documents
    rows += [(400, "so tiny it is", "en"), (401, "two, WORDS", None), (402, "two other words", "en"), (403, "b a " * 30, "en"), (403, "b a " * 30, "en")]
    rows += [(None, "an ITEM without id; has seven words!", "en"), (500, None, "en"), (501, "", "en"), (502, "!? \n", "en")]
    rows += [(503, ("x" * 50 + " ") * 3000 + PASSAGE + " end" * 3000, "en"), (504, "exactly ten words are in this one item right here", "en")]
    return rows


@pytest.mark.parametrize(("window", "k"), [(10, 5), (10, 1), (10, 10), (6, 3)])
def test_contamination_matches_brute_force(spark, window, k):
    rows = contaminated_rows()
    benchmark = spark.createDataFrame([(i, t, 1, 2) for i, t in ITEMS], "item_id long, text string, window int, fingerprint int")
    found = winnowing.decontaminate(documents(spark, rows).repartition(6), benchmark, window, k, 1 << 16)
    mine = sorted((repr(r["doc_id"]), r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in found.collect())
    assert mine == sorted((repr(i), *rest) for i, *rest in brute_contamination(rows, ITEMS, window))


def test_contamination_of_empty_tables(spark):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert winnowing.decontaminate(documents(spark, []), benchmark).count() == 0
    none = winnowing.decontaminate(documents(spark, [(1, PASSAGE, "en")]), benchmark.limit(0)).collect()
    assert [(r["doc_id"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in none] == [(1, 0, [], False)]
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.array_join(F.array().cast("array<string>"), ","), 256)).head()[0]


def test_every_shared_span_has_a_fingerprint():
    """Two texts with ten words in common select the same k-gram in them, wherever the words lie."""
    rng = np.random.default_rng(8)
    for _ in range(50):
        span = " ".join(f"s{int(v)}" for v in rng.integers(0, 4, 10))
        texts = [f"{prose(int(rng.integers(1000)), int(rng.integers(0, 30)))} {span} {prose(int(rng.integers(1000)), 12)}".encode() for _ in range(2)]
        one, other = (set(winnowing._Text([t]).selected(10, 5)[2].tolist()) for t in texts)
        assert one & other
