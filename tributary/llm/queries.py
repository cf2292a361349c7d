"""The queries of the subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tributary.llm import alignment, collocations, langid, line_rules, mixing, neighbours, packing, pii, quality, repeats, simhash, toxicity, warc
from tributary.llm.common import table


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows.where("vec_id % 100 = 0"), rows, k=10)


OP1_SQL = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_reduce(
        list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])), lambda a, b: a + b
    )) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"), sample=12000)
    return toxicity.scores(docs, machine, threshold=0.3)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warc.write(table(spark, sf_dir, "pages"), least_bytes=0)
    records = warc.read(packages, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
hashed AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, upper(sha1(payload)) AS digest,
        min(page_id) OVER (PARTITION BY payload) AS first
    FROM payloads
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
        (CAST('0x' || substr(digest, 1 + 5 * CAST(i // 4 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER
    ), 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed
"""


def op5_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), length=400).drop("removed")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), size=2048)
    return packed.drop("ids")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_rules(table(spark, sf_dir, "documents")).drop("removed_lines")


OP7_SQL = r"""
WITH texts AS (
    SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
    FROM texts, unnest(range(1, len(words) - 1)) AS t(i)
), repeated AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), marked AS (
    SELECT doc_id, count(DISTINCT i + d) AS n FROM repeated, unnest([0, 1, 2]) AS t(d) GROUP BY doc_id
), lines AS (
    SELECT doc_id, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words
    FROM texts, unnest(string_split(text, chr(10))) AS t(line) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), duplicates AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id
), levelled AS (
    SELECT doc_id, source, sum(len(words)) AS words, regexp_replace(translate(array_to_string(words, ' '),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g') AS line
    FROM lines GROUP BY ALL
), kept_lines AS (
    SELECT doc_id, source, line, sum(words) AS words FROM levelled GROUP BY ALL
), common AS (
    SELECT c.source, c.line FROM (SELECT source, line, count(*) AS docs FROM kept_lines GROUP BY ALL) c
    JOIN (SELECT source, count(*) AS n FROM documents GROUP BY ALL) h ON c.source IS NOT DISTINCT FROM h.source
    WHERE c.docs > 20 AND (c.docs > 1000 OR c.docs > h.n * 0.05)
), removed AS (
    SELECT l.doc_id, sum(l.words) AS n FROM kept_lines l
    JOIN common c ON l.source IS NOT DISTINCT FROM c.source AND l.line = c.line GROUP BY l.doc_id
), counted AS (
    SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words, CAST(length(array_to_string(t.words, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(m.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed_words
    FROM texts t LEFT JOIN duplicates d USING (doc_id) LEFT JOIN marked m USING (doc_id) LEFT JOIN removed r USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_removed_words >= 0.5 * n_words AS kept
FROM counted
"""


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs, sample=600, centroids=4))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents")).drop("found")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.link_counts(table(spark, sf_dir, "documents"), a, b)


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), sample=6000)
    return quality.scores(docs, model, threshold=0.3)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


OP13_SQL = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w
    FROM texts, unnest(string_split_regex(t, '[.,;:!?
-
]')) AS u(piece)
), counted AS (
    SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS c
    FROM pieces, unnest(range(1, 6)) AS a(k), unnest(range(1, len(w) - k + 2)) AS b(i) GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND c >= 100
), inside AS (
    SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN candidates t ON s.lang = t.lang AND t.k > s.k AND 100 * t.a >= 100 * s.a
        AND contains(' ' || t.phrase || ' ', ' ' || s.phrase || ' ')
), cuts AS (
    SELECT p.lang, p.phrase, p.a, j, l.c AS l, r.c AS r, n, CAST(CAST(1000 AS HUGEINT) * p.a * n // (CAST(l.c AS HUGEINT) * r.c) AS BIGINT) AS score
    FROM candidates p JOIN totals t ON t.lang = p.lang CROSS JOIN unnest(range(1, p.k)) AS u(j)
    JOIN counted l ON l.lang = p.lang AND l.phrase = array_to_string(list_slice(p.w, 1, j), ' ')
    JOIN counted r ON r.lang = p.lang AND r.phrase = array_to_string(list_slice(p.w, j + 1, p.k), ' ')
), lowest AS (
    SELECT * FROM cuts ANTI JOIN inside USING (lang, phrase) QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= 2000
"""


QUERIES = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_toxicity": op2_toxicity,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_warc": op4_warc,
    "op5_repeat_removal": op5_repeat_removal,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_source_mixing": op8_source_mixing,
    "op9_language_id": op9_language_id,
    "op10_pii": op10_pii,
    "op11_token_alignment": op11_token_alignment,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_collocations": op13_collocations,
}

SQL = {
    "op1_nearest_neighbours": OP1_SQL,
    "op4_warc": OP4_SQL,
    "op7_quality_rules": OP7_SQL,
    "op13_collocations": OP13_SQL,
}
