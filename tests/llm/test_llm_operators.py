"""Each operator against brute force, an exact round trip or held-out accuracy, on small tables."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, exact_dedup, language, licences, mixing, near_join, packing, quality_knn, quality_rules, tokens, toxicity
from tidemark.llm.arrays import Words
from tidemark.llm.components import components
from tidemark.llm.queries import ORACLES, domain_of_source

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, tokens string, n int, kept string, links string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def prose(seed: int, n: int = 120) -> str:
    rng = np.random.default_rng(seed)
    made = ["".join(rng.choice(list("abdefgilmnorstu"), rng.integers(2, 8))) for _ in range(n)]
    return ". ".join(" ".join(made[i : i + 12]) for i in range(0, n, 12)) + "."


def edited(text: str, every: int) -> str:
    words = text.split()
    return " ".join("changed" if i % every == every - 1 else w for i, w in enumerate(words))


def frame(spark, rows):
    """Documents with further columns whose names clash with the operators' own."""
    full = [(i, t, lang, source, None, "k", "t", 1, "x", "y") for i, t, lang, source in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD_ROWS = [
    (None, "no id", "en", "src1"),
    (1, None, None, None),
    (2, "", "en", "src1"),
    (3, " \t\n", "en", ""),
    (4, "word", "en", "src2"),
    (4, "word", "en", "src2"),
    (5, "x" * 60_000 + " end", "de", "src3"),
    (6, "日本語 текст ünï", "xx", "src1"),
    (7, "wo rd", "en", "src2"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD_ROWS)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, prose(i), "en", f"src{i % 5}") for i in range(60)]
    rows += [(100 + i, prose(i % 3), "en", "src0") for i in range(30)]  # a hot group of copies
    rows += [(200 + i, edited(prose(7), 40 + i), "en", "src0") for i in range(25)]  # near copies
    rows += [(300 + i, edited(prose(8), 3), "en", "src1") for i in range(3)]
    return frame(spark, rows), rows


def test_word_arrays_match_plain_python():
    texts = ["a b a b c", "", "one", " x\ty\vz ", "ä ö\nü ä ö"]
    words = Words([t.encode() for t in texts])
    found = defaultdict(list)
    for o, s, e in zip(words.owner, words.start, words.end, strict=True):
        found[o].append(words.buffer[s:e].tobytes().decode())
    assert [found[i] for i in range(len(texts))] == [WORDS.findall(t) for t in texts]
    hashes = words.hashes()
    by_word = defaultdict(set)
    for h, s, e in zip(hashes, words.start, words.end, strict=True):
        by_word[words.buffer[s:e].tobytes()].add(int(h))
    assert all(len(v) == 1 for v in by_word.values()) and len(set().union(*by_word.values())) == len(by_word)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (20, 21), (21, 22), (22, 20), (30, 30)] + [(50, 50 + i) for i in range(1, 40)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in (1, 2, 3, 4)} == {1} and found[11] == 10 and found[22] == 20 and found[77] == 50 and 30 not in found


# exact duplicates


def brute_groups(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    return groups


@pytest.mark.parametrize("capacity", [2, 4096])
def test_exact_groups(spark, corpus, capacity):
    df, rows = corpus
    found = {r["doc_id"]: r for r in exact_dedup.duplicates(df, capacity=capacity, max_depth=6).collect()}
    assert len(found) == len(rows)
    for content, members in brute_groups(rows).items():
        keep = min(members)[2]
        for *_, i in members:
            r = found[i]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(members), i == keep)
            assert r["text_sha256"] == hashlib.sha256(content.encode()).hexdigest()


def test_exact_odd_rows(odd, empty):
    found = exact_dedup.duplicates(odd).collect()
    assert len(found) == len(ODD_ROWS)
    assert Counter(r["kept"] for r in found)[True] == len(brute_groups(ODD_ROWS))
    assert {r["keep_id"] for r in found if r["doc_id"] in (1, 2, 3)} == {3}
    assert {r["keep_id"] for r in found if r["doc_id"] in (4, 7)} == {7}
    assert exact_dedup.duplicates(empty).count() == 0
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == len(brute_groups(ODD_ROWS))


def test_directory_doubles_until_buckets_fit():
    keys = {0: 5, 1: 1, 2: 1, 3: 0, 4: 1, 5: 1, 6: 0, 7: 1}
    assert exact_dedup.directory(keys, 3, 3) == [0, 1, 2, 2, 4, 4, 4, 4]
    assert exact_dedup.directory({}, 3, 3) == [0] * 8


# near copies


def brute_links(rows):
    texts = defaultdict(list)
    for i, t, *_ in rows:
        texts[t or ""].append(i)
    sets = {}
    for t in texts:
        w = WORDS.findall(t)
        sets[t] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    parent = {t: t for t in texts}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    degree = Counter()
    for a, b in linked:
        degree[a] += 1
        degree[b] += 1
        parent[root(a)] = root(b)
    least = {}
    for t, ids in texts.items():
        known = [i for i in ids if i is not None]
        least[root(t)] = min([*known, least.get(root(t), 10**9)])
    return {(i, least[root(t)], degree[t], len(ids)) for t, ids in texts.items() for i in ids}


@pytest.mark.parametrize("block", [8, 256])
def test_jaccard_links(corpus, monkeypatch, block):
    monkeypatch.setattr(near_join, "BLOCK", block)
    df, rows = corpus
    found = {(r["doc_id"], r["class_id"], r["links"], r["copies"]) for r in near_join.links(df).collect()}
    assert found == brute_links(rows)


def test_jaccard_odd_rows(odd, empty):
    found = near_join.links(odd).collect()
    assert len(found) == len(ODD_ROWS) and all(r["links"] == 0 for r in found)
    assert near_join.links(empty).count() == 0
    assert near_join.keep_one(odd).columns == odd.columns


def test_prefixes_are_shortened_to_the_recall():
    d = near_join.matched_depth(0.8, 30, 10, 0.999)
    assert 1 - (1 - 0.8**d) ** 30 >= 0.999 > 1 - (1 - 0.8 ** (d + 1)) ** 30


# packing


def check_pieces(rows, pieces, length):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for i, t, *_ in rows:
        ids = np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want[(i, ids.tobytes())] += 1
    place = sorted((p["sequence_id"], p["offset"], p["length"]) for p in pieces)
    for (s, o, n), (s2, o2, _) in itertools.pairwise(place):
        assert (s2, o2) == ((s, o + n) if o + n < length else (s + 1, 0))
    rebuilt = Counter()
    run: dict = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        ids = np.array(p["ids"], "<u4")
        assert len(ids) == p["length"] and zlib.crc32(ids.tobytes()) == p["ids_crc32"]
        held = run.setdefault(p["doc_id"], [])
        assert p["start"] == sum(map(len, held))
        held.append(ids)
        if sum(map(len, held)) == p["doc_tokens"]:
            rebuilt[(p["doc_id"], np.concatenate(run.pop(p["doc_id"])).tobytes())] += 1
    assert rebuilt == want and not run


def test_pieces_hold_every_id_once(corpus):
    df, rows = corpus
    check_pieces(rows, packing.pack(df, TOKENIZER, length=64, with_ids=True).collect(), 64)


def test_packing_odd_rows(odd, empty):
    pieces = packing.pack(odd, TOKENIZER, length=64, with_ids=True)
    check_pieces(ODD_ROWS, pieces.collect(), 64)
    made = packing.sequences(pieces, 64).collect()
    assert all(len(r["ids"]) in (64, r["used"]) for r in made)
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_chunks_have_the_tokenizers_own_ids():
    from tokenizers import Tokenizer

    from tidemark.llm.tokens import ChunkIds

    plain, chunks = Tokenizer.from_file(TOKENIZER), ChunkIds(TOKENIZER, 1)
    texts = ["It's  a\ttest's\x1c end", "", "É e\u0301 ﬁ\u00a0x\u2003y", "<|endoftext|> a<|startoftext|>b", "don't! WE'LL\n\n12 3.5", "\u0301 x \u0301"]
    ids, counts = chunks.encode(texts)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_hilbert_neighbours_touch():
    side = np.array(list(itertools.product(range(8), repeat=3)))
    path = side[np.argsort(packing.hilbert_keys(side, 3))]
    assert len(set(map(tuple, path))) == 512 and (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


# mixture


def plain_shares(budget, weights, limits):
    """Shares of ``budget`` by weight, none above its limit; what one cannot take goes to the others by weight."""
    given, open_ = [0.0] * len(weights), set(range(len(weights)))
    left = min(budget, sum(limits))
    while open_ and left > 1e-9:
        total = sum(weights[i] for i in open_)
        if total <= 0:
            total, weights = float(len(open_)), [1.0 if i in open_ else w for i, w in enumerate(weights)]
        full = [i for i in open_ if limits[i] <= left * weights[i] / total]
        if not full:
            for i in open_:
                given[i] = left * weights[i] / total
            return given
        for i in full:
            given[i] = limits[i]
        left -= sum(limits[i] for i in full)
        open_ -= set(full)
    return given


def plain_budgets(tokens, total, weights, max_epochs):
    """Token budget of every leaf.  ``weights`` is by path (a prefix of a leaf); a path without one weighs 1."""
    children: dict[tuple, set[tuple]] = defaultdict(set)
    limit: dict[tuple, float] = defaultdict(float)
    for leaf, held in tokens.items():
        for depth in range(len(leaf) + 1):
            limit[leaf[:depth]] += held * max_epochs
            if depth:
                children[leaf[: depth - 1]].add(leaf[:depth])
    out: dict[tuple, int] = {}

    def descend(node: tuple, budget: float) -> None:
        if node in tokens and not children[node]:
            out[node] = int(budget + 1e-6)
            return
        below = sorted(children[node], key=repr)
        for child, part in zip(below, plain_shares(budget, [weights.get(c, 1.0) for c in below], [limit[c] for c in below]), strict=True):
            descend(child, part)

    descend((), min(total, limit[()]))
    return out


def test_budgets_equal_the_plain_descent(spark):
    rng = np.random.default_rng(4)
    leaves = {(d, lang, s): int(rng.integers(0, 2000)) for d in ("a", "b", None, "z") for lang in ("x", "y", None) for s in ("1", "2", "3", None) if rng.random() < 0.7}
    schema = "domain string, lang string, source string, tokens long"
    df = spark.createDataFrame([(*leaf, n) for leaf, n in leaves.items()], schema)
    weights = {("a",): 5.0, ("z",): 0.0, ("a", "x"): 0.3, ("b", None): 4.0, ("a", "y", "1"): 0.0, ("a", "y", "2"): 0.0, (None, "x", None): 7.5}
    for total, epochs in ((0.1, 1), (0.5, 1), (0.97, 1), (1.0, 1), (1.7, 3), (9.0, 2)):
        want = plain_budgets(leaves, total * sum(leaves.values()), weights, epochs)
        found = mixing.leaf_budgets(df, total * sum(leaves.values()), weights, epochs).collect()
        assert {(r["domain"], r["lang"], r["source"]): r["budget"] for r in found} == want


def test_shortages_go_to_siblings_first():
    tokens = {("a", "x", "1"): 100, ("a", "x", "2"): 1000, ("a", "y", "1"): 1000, ("b", "x", "1"): 1000}
    found = plain_budgets(tokens, 800, {("a",): 1, ("b",): 1}, 1)
    assert found == {("a", "x", "1"): 100, ("a", "x", "2"): 100, ("a", "y", "1"): 200, ("b", "x", "1"): 400}
    tight = plain_budgets({("a", "x", "1"): 100, ("a", "x", "2"): 1000, ("b", "x", "1"): 1000}, 1000, {("a", "x", "1"): 9}, 1)
    assert tight == {("a", "x", "1"): 100, ("a", "x", "2"): 400, ("b", "x", "1"): 500}
    assert sum(plain_budgets(tokens, 10**9, {}, 2).values()) == 2 * sum(tokens.values())
    assert plain_budgets({}, 10, {}, 1) == {}


@pytest.mark.parametrize("slice_rows", [4, 4096])
def test_mixture_is_the_seeded_prefix(spark, corpus, monkeypatch, slice_rows):
    monkeypatch.setattr(mixing, "SLICE_ROWS", slice_rows)
    df, rows = corpus
    weights = {("web",): 0.6, ("books",): 0.3, ("reference",): 0.1}
    chosen = Counter((r["doc_id"], r["epoch"]) for r in mixing.mix(df, domain_of_source(), weights, 0.9, 3).collect())
    assert max(chosen.values()) == 1
    keyed = df.select("doc_id", domain_of_source().alias("domain"), "lang", "source", F.xxhash64("doc_id", "text").alias("key"), "text").collect()
    leaves = defaultdict(list)
    for r in keyed:
        leaves[(r["domain"], r["lang"], r["source"])].append((r["doc_id"], r["key"], len(WORDS.findall(r["text"]))))
    held = {k: sum(x[2] for x in v) for k, v in leaves.items()}
    granted = plain_budgets(held, 0.9 * sum(held.values()), weights, 3)
    want = set()
    for leaf, members in leaves.items():
        whole, rest = divmod(granted[leaf], held[leaf])
        want |= {(i, e) for i, *_ in members for e in range(whole)}
        hashed = spark.createDataFrame([(i, k, t, whole) for i, k, t in members], "i long, k long, t long, e int")
        order = sorted((r["h"], r["i"], r["t"]) for r in hashed.select("i", "t", F.xxhash64("k", F.lit(mixing.SEED), "e").alias("h")).collect())
        before = 0
        for _, i, t in order:
            if rest and before + t / 2 <= rest:
                want.add((i, whole))
            before += t
    assert set(chosen) == want


def test_mixture_odd_rows(odd, empty):
    found = mixing.mix(odd, domain_of_source(), {}, 4.0, 4)
    # Without tokens a row comes along only where its leaf gives whole epochs: the empty text of src1 does.
    assert sorted(r["doc_id"] or 0 for r in found.where("epoch = 0").collect()) == [0, 2, 4, 4, 5, 6, 7]
    assert {r["key"] for r in found.collect()} == {"k"}
    assert mixing.mix(empty, domain_of_source(), {}, 0.5, 1).count() == 0


# toxicity, language, quality


def test_toxic_words_are_learnt_and_clean_texts_left_alone(spark):
    def text(i):
        words = prose(i, 150).split()
        if i % 4 == 0:
            for k in range(5, 150, 30):
                words[k] = ["zonkwit", "zonkwitty", "blarghed", "blargher"][(i + k) % 4]
        return " ".join(words)

    rows = [(i, text(i), "en", "s") for i in range(400)]
    df = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    assert {"zonkw", "blarg"} & {e[:5] for e in model.ratios}
    scores = {r["doc_id"]: r["s"] for r in df.select("doc_id", toxicity.score_column(df, model).alias("s")).collect()}
    wrong = [i for i in range(300, 400) if (scores[i] >= 0.7) != (i % 4 == 0)]
    assert len(wrong) <= 2


def toxic_frame(spark, n=400):
    def text(i):
        words = prose(i, 150).split()
        for k in range(5, 150, 30) if i % 4 == 0 else ():
            words[k] = ["zonkwit", "zonkwitty", "blarghed", "blargher"][(i + k) % 4]
        return " ".join(words)

    rows = [(i, text(i), "en", "s") for i in range(n)]
    return frame(spark, rows + [(n, None, "en", "s"), (n + 1, "12 ...", "en", "s"), (None, text(4), "en", "s"), (7, text(8), "en", "s")])


def test_toxicity_model_beyond_the_broadcast_keeps_every_expression(spark):
    df = toxic_frame(spark)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    small, large = toxicity.fit(df, labels), toxicity.fit(df, labels, broadcast_bytes=0)
    assert small.table is None and large.ratios == {} and len(small.ratios) > 3
    assert {r["expression"]: r["ratio"] for r in large.table.collect()} == small.ratios
    assert large.weights == pytest.approx(small.weights, rel=1e-9)
    large.weights = small.weights
    by = [sorted((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in toxicity.scored(df, m).collect()) for m in (small, large)]
    assert by[0] == by[1] and len(by[0]) == 404 and toxicity.scored(df, large).columns == [*df.columns, "score"]


def test_toxicity_counts_all_labelled_rows(spark):
    df = toxic_frame(spark)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    # A word of toxic texts of one fold alone is learnt, whichever fold it is.
    folds = df.where("doc_id BETWEEN 0 AND 299 AND doc_id % 4 = 0").select("doc_id", F.pmod(F.xxhash64(F.col("doc_id"), F.lit("calibration")), F.lit(4)).alias("fold"))
    for fold in (0, 1):
        ids = sorted({r["doc_id"] for r in folds.where(F.col("fold") == fold).collect()})[:12]
        marked = df.withColumn("text", F.when(F.col("doc_id").isin(ids), F.concat("text", F.lit(" quuxterly"))).otherwise(F.col("text")))
        assert toxicity.fit(marked, labels).ratios.get("quuxt", 0) > 0


def test_workers_hold_little_and_let_go_of_the_encoder():
    """A worker that has encoded tokens and turns to other work frees the encoder; counts leave it in small parts."""
    letters = str.maketrans("0123456789", "abcdefghij")
    texts = [" ".join(f"{i * 1000 + k:07d}".translate(letters) for k in range(1000)) for i in range(250)]
    batch = pd.DataFrame({"text": texts, "toxic": 0, "sampled": False})
    tokens.chunk_ids(TOKENIZER, 1)
    parts = list(toxicity._expressions(iter([batch])))
    assert tokens.chunk_ids.cache_info().currsize == 0
    assert max(map(len, parts)) < 110_000
    counted = pd.concat(parts).groupby("expression")["ordinary"].sum()
    assert counted[""] == 250_000 and (counted[[w for t in texts for w in t.split()]] == 1).all()
    tokens.chunk_ids(TOKENIZER, 1)
    found = near_join._verified(pd.DataFrame({"text": ["a b c d e f"] * 2, "node": [3, 5], "candidate": 3, "part": 0, "bi": 0, "bj": 0}))
    assert tokens.chunk_ids.cache_info().currsize == 0 and found["root"].tolist() == [3, 3]


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    assert [r["s"] for r in odd.select(toxicity.score_column(odd, model).alias("s")).collect()] == [0.0] * len(ODD_ROWS)
    assert empty.select(toxicity.score_column(empty, model)).count() == 0


def test_languages(spark, odd, empty):
    alphabets = {"aa": "abcdef", "bb": "klmnop", "cc": "tuvwxy"}

    def text(lang, i):
        rng = np.random.default_rng(i)
        return " ".join("".join(rng.choice(list(alphabets[lang]), rng.integers(2, 7))) for _ in range(40))

    rows = [(i, text(lang, i), lang if i < 240 else None, "s") for i, lang in enumerate(list(alphabets) * 100)]
    df = frame(spark, rows)
    found = {r["doc_id"]: r for r in language.classify(df, language.fit(df)).collect()}
    assert all(found[i]["lang_pred"] == list(alphabets)[i % 3] and 0 < found[i]["score"] <= 1 for i in range(240, 300))
    unknown = [r for r in language.classify(odd, language.fit(df)).collect() if r["lang_pred"] == "und"]
    assert sorted(r["doc_id"] for r in unknown) == [1, 2, 3] and all(r["score"] == 0 for r in unknown)
    assert {r["lang_pred"] for r in language.classify(df, None).collect()} == {"und"}
    assert language.classify(empty, language.fit(df)).count() == 0 and language.fit(empty) is None


def test_quality_votes(spark, odd, empty):
    def text(i):
        words = prose(i, 80).split()
        kind = i % 8
        return " ".join(w.upper() + "!!" for w in words) if kind == 0 else " ".join([words[0]] * 40 + [words[1]] * 40) if kind == 1 else " ".join(words)

    df = frame(spark, [(i, text(i), "en", "s") for i in range(320)])
    labels = spark.createDataFrame([(i, int(i % 8 > 1)) for i in range(240)] + [(None, 1), (3, None)], "doc_id long, quality int")
    space = quality_knn.fit(df, labels)
    found = {r["doc_id"]: r["score"] for r in quality_knn.score(df, space).collect()}
    assert sum((found[i] >= 0.3) != (i % 8 > 1) for i in range(240, 320)) <= 1
    assert quality_knn.score(odd, space).count() == len(ODD_ROWS) and quality_knn.score(empty, space).count() == 0
    assert {r["score"] for r in quality_knn.score(odd, quality_knn.fit(odd, labels.limit(0))).collect()} == {0.5}


def test_votes_are_exact():
    rng = np.random.default_rng(1)
    x, labelled = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (rng.normal(size=(20, 6)), rng.normal(size=(50, 6))))
    labels = rng.integers(0, 2, 50).astype(float)
    found = quality_knn.votes(x, quality_knn.Space(np.ones(1), np.eye(6), labelled, labels), 7)
    for v, got in zip(x, found, strict=True):
        near = sorted(((float(v @ w), y) for w, y in zip(labelled, labels, strict=True)), reverse=True)[:7]
        weight = [np.exp(quality_knn.SHARPNESS * (c - 1)) for c, _ in near]
        assert got == pytest.approx(sum(w * y for w, (_, y) in zip(weight, near, strict=True)) / sum(weight))


# quality rules


def brute_counts(text):
    words = WORDS.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    cover = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(cover),
    }


def test_rule_counts(spark, odd):
    line = " ".join(f"w{i}" for i in range(12))
    texts = [line, f"{line}\n{line}\n\n{line} ", "ä # $$ <b>\n \n# x", "a " * 40, *[r[1] for r in ODD_ROWS]]
    df = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    for r in quality_rules.judge(df).collect():
        want = brute_counts(texts[r["doc_id"]])
        assert {c: r[c] for c in want} == want
        assert r["base_failed"] == (want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.judge(odd).count() == len(ODD_ROWS)


def test_expectation_maximisation_trusts_the_better_rules():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.7
    votes = np.stack([np.where(rng.random(4000) < a, truth, ~truth) + 1 for a in (0.95, 0.9, 0.6)], 1)
    votes[rng.random(votes.shape) < 0.2] = 0
    patterns = Counter(map(tuple, votes.tolist()))
    posterior, chance = quality_rules.fit(patterns, 3)
    right = [(posterior[tuple(v)] >= 0.5) == t for v, t in zip(votes.tolist(), truth, strict=True)]
    assert np.mean(right) > 0.88 and chance[0, 1, 2] > chance[2, 1, 2] and len(posterior) == 27


def plain_posterior(patterns, n_rules, rounds):
    """Expectation-maximisation rule by rule, pattern by pattern."""
    chance = [{y: list(quality_rules.START[y]) for y in (0, 1)} for _ in range(n_rules)]
    prior = quality_rules.PRIOR

    def good(pattern):
        weight = {0: 1 - prior, 1: prior}
        for rule, vote in enumerate(pattern):
            for y in weight:
                weight[y] *= chance[rule][y][vote]
        return weight[1] / (weight[0] + weight[1])

    for _ in range(rounds):
        share = {p: good(p) for p in patterns}
        for rule in range(n_rules):
            for y in (0, 1):
                counts = [quality_rules.SMOOTHING] * 3
                for p, n in patterns.items():
                    counts[p[rule]] += n * (share[p] if y else 1 - share[p])
                chance[rule][y] = [c / sum(counts) for c in counts]
        prior = min(0.999, max(0.001, sum(n * share[p] for p, n in patterns.items()) / sum(patterns.values())))
    return {p: good(p) for p in patterns}


def test_verdicts_equal_a_plain_expectation_maximisation(monkeypatch):
    rng = np.random.default_rng(8)
    truth = rng.random(500) < 0.8
    votes = np.stack([np.where(rng.random(500) < a, truth, ~truth) + 1 for a in (0.9, 0.8, 0.85, 0.7)], 1)
    votes[rng.random(votes.shape) < 0.3] = 0
    patterns = Counter(map(tuple, votes.tolist()))
    monkeypatch.setattr(quality_rules, "ROUNDS", 25)
    posterior, _ = quality_rules.fit(patterns, 4)
    for pattern, want in plain_posterior(patterns, 4, 25).items():
        assert posterior[pattern] == pytest.approx(want, abs=1e-9)


def test_one_fault_is_outvoted_and_several_are_not(spark):
    def text(i):
        words = prose(i, 150).split()
        if i % 10 == 0:  # marks on every second word
            return " ".join(w + "###" if k % 2 else w for k, w in enumerate(words))
        if i in (1, 2):  # capitals only
            return " ".join(words).upper()
        if i in (3, 4):  # repeated lines only
            return " ".join(words) + "\nso it goes" * 4
        if i == 5:  # long words only
            return " ".join("".join(words[k : k + 3]).replace(".", "") for k in range(0, 150, 3)) + " " + " ".join("x" * 30 + str(k) for k in range(20))
        return " ".join(words)

    df = frame(spark, [(i, text(i), "en", "s") for i in range(300)])
    found = {r["doc_id"]: r for r in quality_rules.judge(df).collect()}
    assert [i for i in found if found[i]["kept"] == (i % 10 == 0)] == []
    conditions = {name: against for name, (against, _) in quality_rules.rules().items()}
    faults = quality_rules.counted(df).select("doc_id", *[F.coalesce(c, F.lit(False)).alias(n) for n, c in conditions.items()]).collect()
    by_id = {r["doc_id"]: sorted(n for n in conditions if r[n]) for r in faults}
    assert [by_id[i] for i in (1, 3, 5, 6)] == [["capitals"], ["repeated lines"], ["word length"], []]
    assert by_id[10] == ["marks", "symbols", "words with symbols"]


def test_marks_and_marked_words():
    made = quality_rules.text_counts(["a# b ## c, (d) $1% \u20ac".encode(), b""])
    assert made["n_marks"].tolist() == [8, 0] and made["n_marked_words"].tolist() == [3, 0]


def test_rules_on_empty_table(empty):
    assert quality_rules.judge(empty).count() == 0


def test_index_holds_every_text(spark, empty):
    texts = [f"text number {i}" for i in range(300)] + ["twice  over", "twice over"]
    docs = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    index = exact_dedup.build_index(docs, capacity=16, max_depth=8)
    rows = index.rows.collect()
    assert len(rows) == 301 and {r["link"] for r in rows} == {1}
    assert len({r["bucket"] for r in rows}) > 8 and all(index.cells[(r["key"] & (2**64 - 1)) >> 56] == r["bucket"] for r in rows)
    asked = spark.createDataFrame([("text number 7", 1), ("textnumber 7", 2), ("twiceover", 3), ("never seen", 4), (None, 5)], "text STRING, key INT")
    got = {r["key"]: (r["keep_id"], r["group_size"]) for r in index.lookup(asked).collect()}
    assert got == {1: (7, 1), 2: (7, 1), 3: (300, 2), 4: (None, None), 5: (None, None)}
    assert exact_dedup.build_index(empty).lookup(asked).where("keep_id IS NOT NULL").count() == 0


def test_texts_of_one_key_are_links_of_a_chain(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *_: F.lit(5).cast("long"))
    docs = frame(spark, [(i, t, "en", "s") for i, t in enumerate(["a", "b", "c", "b "])])
    index = exact_dedup.build_index(docs)
    assert sorted(r["link"] for r in index.rows.collect()) == [1, 2, 3]
    assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.duplicates(docs).collect()} == {0: (0, True), 1: (3, False), 2: (2, True), 3: (3, True)}


# licences


def test_licence_rules(spark, odd, empty):
    s = licences.SENTENCES
    texts = [
        "Title\nReleased under the MIT License.\nMore text.",
        f"{s['bsd-forms']}: {s['bsd-source']}. {s['bsd-binary']}. {s['bsd-endorse']}.",
        f"{s['bsd-forms']}: {s['bsd-source']}.\n\n{s['bsd-binary']}.",
        f"{s['mit-condition']}. {s['mit-grant']}.",
        "Licensed under the Apache License,\nVersion 2.0. All rights reserved.",
        "We license nothing here. Rights matter.",
    ]
    df = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    found = {r["doc_id"]: r for r in licences.scan(df).collect()}
    assert [found[i]["licences"] for i in range(6)] == [["MIT"], ["BSD-3-Clause"], ["BSD-2-Clause"], [], ["Apache-2.0"], []]
    assert found[3]["sentence_ids"] == ["mit-condition", "mit-grant"]
    assert all(r["licences"] == [] for r in licences.scan(odd).collect()) and licences.scan(empty).count() == 0


def test_every_sentence_is_normal_and_anchored():
    assert all(re.fullmatch(r"[a-z0-9]+( [a-z0-9]+)*", w) and any(a in w for a in licences.ANCHORS) for w in licences.SENTENCES.values())
    assert {i for found in licences.RULES.values() for s in found for i in s} <= set(licences.SENTENCES)


GPL_HEADER = """Copyright (C) 2020  A. Author

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
MIT_HEADER = """Copyright (c) 2020 A. Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY."""
BSD_HEADER = """Copyright (c) 2020, A. Author

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
APACHE_HEADER = """Copyright 2020 A. Author

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""


def test_verbatim_headers_plain_and_in_comments(spark):
    headers = {"GPL-3.0": GPL_HEADER, "MPL-2.0": MPL_HEADER, "MIT": MIT_HEADER, "BSD-3-Clause": BSD_HEADER, "Apache-2.0": APACHE_HEADER}
    cases = []
    for name, header in headers.items():
        lines = header.split("\n")
        cases += [(name, header), (name, header.replace("\n", "\r\n"))]
        for mark in ("#", "//", ";;", "--", "%", "!", "dnl"):
            cases.append((name, "\n".join(f"{mark} {line}".rstrip() for line in lines) + "\nx = 1\n"))
        cases.append((name, "/*\n" + "\n".join(f" * {line}".rstrip() for line in lines) + "\n */\nint x;\n"))
        cases.append((name, "<!--\n" + header + "\n-->\n"))
    cases.append(("MIT", MIT_HEADER.replace("Author\n\n", "Author\n")))
    df = frame(spark, [(i, text, "en", "s") for i, (_, text) in enumerate(cases)])
    found = {r["doc_id"]: r["licences"] for r in licences.scan(df).collect()}
    assert [found[i] for i in range(len(cases))] == [[name] for name, _ in cases]


LGPL_HEADER = GPL_HEADER.replace("This program", "This library").replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1")
ORGANISATION = BSD_HEADER.replace("the copyright holder", "the University of Somewhere, Department of Things,")


def test_licence_headers_as_people_change_them(spark):
    one_line = " ".join(MIT_HEADER.split())
    literal = "\n".join(f'  "{line}\\n"' for line in MIT_HEADER.split("\n"))
    cases = [
        (["BSD-3-Clause"], BSD_HEADER.replace("Author\n", "Author\nAll rights reserved.\n")),
        (["BSD-3-Clause"], ORGANISATION),
        (["BSD-3-Clause"], ORGANISATION.replace("\n", "\n# ")),
        (["BSD-3-Clause"], BSD_HEADER[: BSD_HEADER.index("3.")] + "3. The name of the author may not be used to endorse or promote products\n   derived from this software without specific prior written permission."),
        (["BSD-2-Clause"], BSD_HEADER[: BSD_HEADER.index("3.")]),
        (["MIT"], one_line),
        (["MIT"], literal),
        (["MIT"], "Licensed under the MIT license (see LICENSE)."),
        (["GPL-2.0"], GPL_HEADER.replace("version 3", "version 2")),
        (["GPL-3.0"], " ".join(GPL_HEADER.split())),
        (["LGPL-2.1"], LGPL_HEADER),
        (["LGPL-3.0"], GPL_HEADER.replace("GNU General", "GNU Lesser General")),
        (["AGPL-3.0"], GPL_HEADER.replace("GNU General", "GNU Affero General")),
        (["GPL-2.0"], "// SPDX-License-Identifier: GPL-2.0-only\nint x;"),
        (["Apache-2.0", "MIT"], "# SPDX-License-Identifier: (MIT OR Apache-2.0)\nx = 1"),
        ([], "SPDX-License-Identifier: None-Such\n"),
        (["Proprietary"], "Copyright 2020 Firm\nAll rights reserved."),
    ]
    df = frame(spark, [(i, text, "en", "s") for i, (_, text) in enumerate(cases)])
    found = {r["doc_id"]: r["licences"] for r in licences.scan(df).collect()}
    assert [found[i] for i in range(len(cases))] == [named for named, _ in cases]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(cases)), "text": [text for _, text in cases]}))
    con.execute(ORACLES["op2_licence_sentences"])
    assert {r[0]: r[-1] for r in con.fetchall()} == {i: " ".join(named) for i, (named, _) in enumerate(cases)}


# chat


HARD = ["", " ", "[INST]", " [/INST]", "</s>[INST] ok [/INST]", "\\", "\\\\[/INST]\\", "a [/INS", "<<SYS>> x <</SYS>>", "[ROLE] [IS] [/ROLE]", "é\n😀</s", "\\</s>"]


@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool [IS] x", ""])
def test_turns_come_back(role):
    for text in HARD:
        segment, begin, end = chat.render_turn(role, text)
        assert chat.parse(chat.HEAD + segment) == [(role, text)] and chat.plain(segment[begin:end]) == text


def test_conversations(spark):
    rows = [(c, t, ["user", "assistant", None][t % 3], HARD[(c + t) % len(HARD)]) for c in range(6) for t in range(4)]
    rows += [(None, 1, "user", None), (3, None, "system", "first"), (2, 1, "assistant", "tie"), (2, 1, "assistant", "tie")]
    segments = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    whole = {r["conv_id"]: r["formatted"] for r in chat.whole(segments).collect()}
    found = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    assert len(found) == 7
    for conv, r in found.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] is not None, x[2] or "", x[3] or ""))
        turns = [(x[2] or "", x[3] or "") for x in own]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert sorted(chat.parse(whole[conv])) == sorted(turns) and r["formatted_chars"] == len(whole[conv])
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert chat.read_back(segments.limit(0)).count() == 0
