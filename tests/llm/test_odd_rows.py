"""Rows that operators and stages of the pipeline must not lose, confuse or fall over."""

import os
import unicodedata

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_llm_operators import ODD_ROWS, SCHEMA, edited, frame, prose

import corpus_pipeline
from tidemark.llm import chat, near_join, toxicity
from tidemark.llm.tokens import TAIL, ChunkIds

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_near_copies_that_share_an_id_with_other_texts(spark):
    text, other = prose(1), prose(2)
    near = edited(text, 60)
    rows = [(2, text), (5, near), (5, other), (9, prose(3)), (9, prose(3)), (None, edited(other, 70)), (None, prose(4)), (None, prose(4))]
    kept = near_join.keep_one(frame(spark, [(i, t, "en", "s") for i, t in rows])).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted([("2", text), ("5", other), ("9", prose(3)), ("None", prose(4))])


def test_a_giant_group_of_long_near_copies(spark):
    base = prose(6, 3000)
    rows = [(i, edited(base, 400 + i), "en", "s") for i in range(60)] + [(1000 + i, base, "en", "s") for i in range(300)]
    df = frame(spark, rows).repartition(4)
    assert [r["doc_id"] for r in near_join.keep_one(df).collect()] == [0]
    assert {(r["class_id"], r["copies"]) for r in near_join.links(df).where("doc_id >= 1000").collect()} == {(0, 300)}


def test_tied_turns_follow_their_texts(spark):
    hard = ["[INST]", "[Z", "</s>", "<a", "\\[", "[", "[/INST] x", "\\"]
    rows = [(1, 0, "assistant", t) for t in hard] + [(2, 0, role, t) for role, t in ((None, "b"), ("", "a"), (None, "[INST]"))]
    found = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    import hashlib

    for conv, own in ((1, [("assistant", t) for t in sorted(hard)]), (2, [("", "[INST]"), ("", "a"), ("", "b")])):
        assert found[conv]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()


def test_every_pair_of_hard_turns_comes_back_across_the_border():
    hard = ["", "[INST]", " [/INST]", "</s>[INST] ok [/INST]", "\\", "\\\\[/INST]\\", "a [/INS", "<<SYS>> x <</SYS>>", "[ROLE] [IS] [/ROLE]", "</s", "<s>", "[", "T] x"]
    for first in hard:
        for second in hard:
            for roles in (("user", "assistant"), ("assistant", "user"), ("system", "x [IS]"), ("assistant", "assistant")):
                turns = list(zip(roles, (first, second), strict=True))
                assert chat.parse(chat.HEAD + "".join(chat.render_turn(*t)[0] for t in turns)) == turns


def test_a_model_kept_as_a_table_scores_documents_with_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BROADCAST_BYTES", 0)
    rows = [(i, ("vile awful " if i % 3 == 0 else "fine ") + prose(i, 30)) for i in range(120)]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(plain, labels, F.lit(True))
    extra = plain.withColumns({c: F.lit("own") for c in ("words", "ratios", "_text_key", "_ratios", "word", "score")})
    found = toxicity.scored(extra, model, "_toxicity")
    assert found.columns == [*extra.columns, "_toxicity"]
    same = {r["doc_id"]: r["_toxicity"] for r in toxicity.scored(plain, model, "_toxicity").collect()}
    assert {r["doc_id"]: r["_toxicity"] for r in found.collect()} == same
    assert found.where("words <> 'own' OR _text_key <> 'own'").isEmpty()


def test_token_ids_are_the_tokenizers_own():
    """All letters below the end of extended Latin, in both places of a word, before every punctuation mark."""
    path = public_tokenizers.path("word_bpe_49k.json")
    own = ChunkIds(path, 1)
    letters = [chr(c) for c in range(0x21, 0x250) if unicodedata.category(chr(c))[0] == "L"]
    texts = [w + mark for c in letters for w in (c, "ab" + c, c + "ab", "KI" + c) for mark in ["", *TAIL, ").", "!?"]]
    ids, counts = own.encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert ids[at : at + n - 1].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids, text
        at += n


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, name):
    """Nulls, empty texts, repeated ids and rows, very long words, and columns named like the operators' own."""
    stage = dict(corpus_pipeline.STAGES)[name]
    clean = [(7000 + i, prose(i, 60), "en", f"src{i % 3}") for i in range(30)]
    extra = ("_toxicity", "_text_key", "words", "ratios", "same", "row", "node", "ids")
    docs = frame(spark, [*ODD_ROWS, *clean, (7000, prose(90, 60), "en", None), clean[1]]).withColumns({c: F.lit("own") for c in extra})
    found = stage(spark, docs, FOLDER)
    if name != "packing":
        assert found.columns == docs.columns
    rows = found.collect()
    texts = {t for _, t, *_ in clean}
    if name == "packing":
        assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    elif name != "mixing sources":
        assert texts <= {r["text"] for r in rows} and all(r["words"] == "own" for r in rows)
        assert len(rows) >= len(texts) + 1
    assert stage(spark, spark.createDataFrame([], SCHEMA), FOLDER).count() == 0
