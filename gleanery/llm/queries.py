"""The operators over the driver's tables, and the same results as SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import (
    best_position,
    collocations,
    kneser_ney,
    packing,
    page_text,
    personal_data,
    piece_codec,
    quality_cascade,
    shingle_join,
    simhash,
    top_k,
    toxicity,
    url_trees,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return kneser_ney.score(table(spark, sf_dir, "documents"), held_out)


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge(table(spark, sf_dir, "pages"))


def op6_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cascade.judge(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.judge(table(spark, sf_dir, "documents"))


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.grouped(table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(table(spark, sf_dir, "documents"))


def op12_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_page_text,
        op3_kneser_ney,
        op4_exact_top_k,
        op5_url_trees,
        op6_quality_cascade,
        op7_personal_data,
        op8_piece_codec,
        op9_packing,
        op10_shingle_join,
        op11_simhash,
        op12_best_position,
        op13_collocations,
    )
}

ORACLES = {
    "op4_exact_top_k": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS n FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.n, c.n), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
    "op6_quality_cascade": r"""
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), g AS (
    SELECT doc_id, i, words[i:i+4] AS five FROM w, unnest(range(1, len(words) - 3)) AS r(i)
), again AS (
    SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1
), repeats AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM again, unnest(range(0, 5)) AS r(k) GROUP BY doc_id
), s AS (
    SELECT doc_id, text, words, lines, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN repeats USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
            OR n_symbols * 100 > n_words * 10
            OR n_dup_lines * 100 > len(lines) * 40
            OR 2 * len(regexp_extract_all(text, '[A-ZÀ-ÖØ-Þ]{2}')) * 100 > word_chars * 40
            OR (length(text) - length(replace(text, '!', ''))) * 100 > n_words * 50
            OR len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) * 100 > n_words * 30
            OR word_chars < n_words * 2 OR word_chars > n_words * 20) AS kept
FROM s""",
    "op10_shingle_join": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
                                  lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS words
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, hash(words[i:i+4]) AS shingle FROM w, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS r(i)
), n AS (
    SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s AS a JOIN s AS b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
    WHERE 100 * shared >= 80 * (x.n_shingles + y.n_shingles - shared)
), reached AS (
    SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reached AS r JOIN links AS l ON r.other = l.a
), least AS (
    SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n_shingles, 0) AS n_shingles, least(w.doc_id, coalesce(other, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)""",
    "op12_best_position": r"""
WITH t AS (
    SELECT row_number() OVER () AS d, doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
        lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
    FROM documents
), p AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM t) GROUP BY ALL
), f AS (SELECT term, count(*) AS df FROM p GROUP BY term
), c AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS all_terms FROM t WHERE len(terms) > 0
), q AS (
    SELECT DISTINCT item_id, unnest(list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
        lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS term
    FROM benchmark
), w AS (SELECT item_id, term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM q JOIN f USING (term), c
), s AS (
    SELECT item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(terms) * docs) // all_terms)))) AS BIGINT) AS score
    FROM w JOIN p USING (term) JOIN t USING (d), c GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50""",
    "op13_collocations": r"""
WITH pieces AS (
    SELECT row_number() OVER () AS p, lang, piece FROM (SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), w AS (SELECT p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), f AS (
    SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase, count(*) AS f
    FROM w, unnest(range(1, 6)) AS s(size), unnest(range(1, len(words) + 2 - size)) AS r(i) GROUP BY ALL
), n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND f >= 100
), cuts AS (
    SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n, CAST((1000 * a::HUGEINT * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM c JOIN n USING (lang), unnest(range(1, c.size)) AS u(k)
    JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(words[1:k], ' ')
    JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(words[k + 1:], ' ')
), lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
    SELECT DISTINCT c.lang, array_to_string(c.words[i:i + part - 1], ' ') AS phrase, c.a AS longer
    FROM c, unnest(range(2, c.size)) AS z(part), unnest(range(1, c.size + 2 - part)) AS u(i)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest WHERE NOT EXISTS (SELECT 1 FROM held WHERE held.lang = lowest.lang AND held.phrase = lowest.phrase AND 100 * longer >= 100 * a)
QUALIFY rank <= 2000""",
}
