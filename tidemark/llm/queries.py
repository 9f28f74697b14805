"""Registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    exact_dedup,
    language,
    licences,
    mixing,
    near_join,
    packing,
    phrases,
    quality_knn,
    quality_rules,
    toxicity,
    whitening,
    winnowing,
)
from tidemark.llm.common import fold_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


TOXIC_FROM = 0.7


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity.fit(documents, table(spark, folder, "labels"), fold_of(F.col("doc_id"), 3) != 1)
    return toxicity.scored(documents.select("doc_id", "text"), model).select(
        "doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )


@query
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op3_exact_dedup"] = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
    FROM documents
), g AS (
    SELECT doc_id, content, first_value(doc_id) OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY content) AS group_size
    FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM g
"""


@query
def op6_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_join.links(table(spark, folder, "documents"))


#: Production mixture: a source's domain follows from its number; paths without a weight weigh 1.
DOMAINS = ("web", "books", "reference")
MIXTURE = {
    ("web",): 0.5, ("books",): 0.3, ("reference",): 0.2,
    **{(d, lang): w for d in DOMAINS for lang, w in (("en", 0.55), ("de", 0.15), ("fr", 0.15), ("es", 0.15))},
}


def domain_of_source() -> Column:
    number = F.regexp_extract(F.coalesce("source", F.lit("")), r"(\d+)$", 1).try_cast("long")
    return F.coalesce(F.element_at(F.array(*map(F.lit, DOMAINS)), (F.pmod(number, F.lit(len(DOMAINS))) + 1).cast("int")), F.lit("other"))


@query
def op10_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    chosen = mixing.mix(table(spark, folder, "documents"), domain_of_source(), MIXTURE, share=0.6, max_epochs=4)
    return chosen.select("doc_id", "domain", "lang", "source", "tokens", "epoch")


def word_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_hilbert_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), word_tokenizer())


@query
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = language.classify(documents, language.fit(documents, fold_of(F.col("doc_id"), 3) != 1))
    return found.withColumn("held_out", fold_of(F.col("doc_id"), 3) == 1)


GOOD_FROM = 0.3


@query
def op5_quality_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    space = quality_knn.fit(documents, table(spark, folder, "labels"), fold_of(F.col("doc_id"), 5) != 0)
    return quality_knn.score(documents, space).withColumns(
        {"held_out": fold_of(F.col("doc_id"), 5) == 0, "predicted": (F.col("score") >= GOOD_FROM).cast("int")}
    )


@query
def op2_licence_sentences(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", " ").alias("sentence_ids"),
        F.array_join("licences", " ").alias("licences"),
    )


def _replaced(column: str, steps: list[tuple[str, str]], flags: str = "") -> str:
    """SQL of replacements one after the other."""
    for pattern, other in steps:
        parts = (flags + pattern).replace("'", "''"), re.sub(r"[$]([0-9])", r"\\\1", other)
        column = f"regexp_replace({column}, '{parts[0]}', '{parts[1]}', 'g')"
    return column


def _licence_sql() -> str:
    """The operator's own cuts and rules."""
    values = ", ".join(f"('{words}', '{name}')" for name, words in licences.SENTENCES.items())
    fires = {n: "(" + " OR ".join(f"contains(joined, ' {' '.join(s)} ')" for s in found) + ")" for n, found in licences.RULES.items()}
    for name, others in licences.YIELDS.items():
        fires[name] = f"({fires[name]} AND NOT ({' OR '.join(fires[other] for other in others)}))"
    named = ", ".join(f"CASE WHEN {condition} THEN '{name}' END" for name, condition in fires.items())
    normal = _replaced("trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g'))", licences.SAME)
    return rf"""
WITH known(words, name) AS (VALUES {values}),
sentences AS (
    SELECT doc_id, text, unnest(s) AS part, generate_subscripts(s, 1) AS i
    FROM (SELECT doc_id, text, string_split({_replaced("coalesce(text, '')", licences.CUTS, "(?im)")}, chr(1)) AS s FROM documents)
),
whole AS (SELECT s.*, k.name FROM sentences s LEFT JOIN known k ON k.words = {normal}),
lines AS (
    SELECT doc_id, i, unnest(l) AS part, generate_subscripts(l, 1) AS j
    FROM (SELECT doc_id, i, string_split(part, chr(10)) AS l FROM whole WHERE name IS NULL)
),
found AS (
    SELECT doc_id, i, 0 AS j, name FROM whole WHERE name IS NOT NULL
    UNION ALL SELECT doc_id, i, j, k.name FROM lines JOIN known k ON k.words = {normal}
),
sequence AS (SELECT doc_id, count(*) AS n, string_agg(name, ' ' ORDER BY i, j) AS ids FROM found GROUP BY doc_id),
joined AS (
    SELECT d.doc_id, coalesce(n, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids, ' ' || coalesce(ids, '') || ' ' AS joined
    FROM documents d LEFT JOIN sequence s ON s.doc_id = d.doc_id
)
SELECT doc_id, n_sentences, sentence_ids, concat_ws(' ', {named}) AS licences FROM joined
"""


ORACLES["op2_licence_sentences"] = _licence_sql()


@query
def op7_chat_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    added = spark.sql(f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '{text}' AS text UNION ALL SELECT -7L, 1L, 'assistant', '{text}'")
    return chat.read_back(chat.format_turns(given.unionByName(added)))


def _chat_sql() -> str:
    controls = " + ".join(f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}" for c in chat.CONTROLS)
    marks = " ".join(f"WHEN '{role}' THEN {len(a) + len(b)}" for role, (a, b) in chat.MARKS.items())
    other = len(chat.OTHER_OPEN + chat.OTHER_NAMED + chat.OTHER_CLOSE)
    return rf"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
), e AS (
    SELECT *, length(text) - length(replace(text, '\', '')) + {controls} AS escapes,
           CASE role {marks} ELSE {other} + length(role) END AS marks
    FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       ({len(chat.HEAD)} + sum(length(text) + marks + escapes))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


ORACLES["op7_chat_round_trip"] = _chat_sql()


@query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")
    return judged.select(*columns)


@query
def op11_qdwh_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.whiten(table(spark, folder, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "found")
    return rows.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("found.whitened").alias("whitened"),
        F.col("found.explained").alias("explained"),
        "identity_error",
    )


PHRASE_SUPPORT, PHRASE_WORDS, PHRASES_PER_LANGUAGE, COVERED_PERCENT = 10, 3, 2000, 50


@query
def op12_son_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"), PHRASE_SUPPORT, PHRASE_WORDS, PHRASES_PER_LANGUAGE, COVERED_PERCENT)


ORACLES["op12_son_collocations"] = rf"""
WITH p AS (
    SELECT doc_id, lang, unnest(s) AS piece, generate_subscripts(s, 1) AS piece_no
    FROM (SELECT row_number() OVER () AS doc_id, coalesce(lang, 'und') AS lang,
          string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS s FROM documents)
), w AS (
    SELECT doc_id, lang, piece_no, unnest(s) AS a, generate_subscripts(s, 1) AS i
    FROM (SELECT doc_id, lang, piece_no, regexp_extract_all(piece, '[^\x20\x09]+') AS s FROM p)
), runs AS (
    SELECT lang, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY doc_id, piece_no ORDER BY i)
), f AS (
    SELECT lang, 1 AS size, a AS phrase, count(*) AS times FROM runs GROUP BY ALL
    UNION ALL SELECT lang, 2, a || ' ' || b, count(*) FROM runs WHERE b IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c, count(*) FROM runs WHERE c IS NOT NULL GROUP BY ALL
), totals AS (SELECT lang, sum(times)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
frequent AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS s FROM f WHERE times >= {PHRASE_SUPPORT}),
candidates AS (SELECT * FROM frequent WHERE size > 1),
parted AS MATERIALIZED (
    SELECT *, array_to_string(s[:k], ' ') AS head, array_to_string(s[k + 1:], ' ') AS tail FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
),
cuts AS (
    SELECT c.lang, c.phrase, c.size, c.times AS a, c.s, k, l.times AS l, r.times AS r,
           ((1000000::HUGEINT * c.times * c.times) // (l.times::HUGEINT * r.times))::BIGINT AS score
    FROM parted c JOIN frequent l ON l.lang = c.lang AND l.phrase = c.head JOIN frequent r ON r.lang = c.lang AND r.phrase = c.tail
), lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, phrase, max(times) AS longer FROM (
        SELECT lang, s[1] || ' ' || s[2] AS phrase, times FROM candidates WHERE size = 3
        UNION ALL SELECT lang, s[2] || ' ' || s[3], times FROM candidates WHERE size = 3
    ) GROUP BY lang, phrase
), kept AS (
    SELECT t.*, row_number() OVER (PARTITION BY t.lang ORDER BY score DESC, a DESC, t.phrase) AS rank
    FROM lowest t LEFT JOIN inside i ON i.lang = t.lang AND i.phrase = t.phrase WHERE longer IS NULL OR 100 * longer < {COVERED_PERCENT} * a
)
SELECT k.lang, rank, phrase, a, l, r, n, score FROM kept k JOIN totals t ON t.lang = k.lang WHERE rank <= {PHRASES_PER_LANGUAGE}
"""


@query
def op13_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    found = winnowing.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def _winnowing_sql() -> str:
    def words(name: str, key: str) -> str:
        low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return rf"SELECT row_number() OVER () AS row_no, {key}, regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {name}"

    return rf"""
WITH d AS ({words("documents", "doc_id")}), b AS ({words("benchmark", "item_id")}),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS said
    FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM (SELECT *, least(len(w), {winnowing.WINDOW}) AS size FROM b WHERE len(w) > 0))
),
places AS (
    SELECT row_no, size, i, array_to_string(w[i:i + size - 1], ' ') AS said
    FROM (SELECT row_no, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM windows))
),
found AS (SELECT row_no, i, p.size, item_id FROM places p JOIN windows USING (size, said)),
hit AS (SELECT row_no, count(DISTINCT word) AS n_hit FROM (SELECT row_no, unnest(range(i, i + size)) AS word FROM (SELECT DISTINCT row_no, i, size FROM found)) GROUP BY row_no),
items AS (SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT row_no, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY row_no)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row_no) LEFT JOIN items USING (row_no)
"""


ORACLES["op13_winnowing"] = _winnowing_sql()
