"""Registered queries of the training-data operators over the driver's tables, with their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import alignment, byte_bpe, class_ngrams, curves, exact_topk, language, packing, prefix_trie, secrets, simhash
from . import substring_dedup, suffix_dedup, token_counts
from .common import documents, embeddings, read_table
from .vectors import usable

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DEFINITION = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.deduplicate(documents(spark, sf_dir)))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), DEFINITION, special_as_text=False)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_ngrams.score_documents(documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.deduplicate(documents(spark, sf_dir)))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(embeddings(spark, sf_dir))
    return curves.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(documents(spark, sf_dir), RANKS)
    return byte_bpe.digests(byte_bpe.decode(encoded, RANKS))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir), RANKS)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(simhash.components(documents(spark, sf_dir)))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = exact_topk.quantized(embeddings(spark, sf_dir))
    return exact_topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.in_order(prefix_trie.turns(read_table(spark, sf_dir, "conversations")))
    return prefix_trie.digests(prefix_trie.trie(*prefix_trie.forked(turns)))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(alignment.align(documents(spark, sf_dir), DEFINITION, PIECES))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), DEFINITION, limit=512)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_secret_scan": op7_secret_scan,
    "op8_language_id": op8_language_id,
    "op9_simhash": op9_simhash,
    "op10_exact_topk": op10_exact_topk,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_alignment": op12_alignment,
    "op13_token_counts": op13_token_counts,
}

ORACLES: dict[str, str] = {
    "op4_substring_dedup": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ),
        windows AS (
            SELECT doc_id, i, array_to_string(list_slice(words, i, i + 49), ' ') AS run
            FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS i FROM w WHERE len(words) >= 50)
        ),
        least AS (SELECT run, min(doc_id) AS doc_id FROM windows GROUP BY run HAVING count(DISTINCT doc_id) > 1),
        gone AS (
            SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS place
            FROM (SELECT w.doc_id, w.i FROM windows w JOIN least l ON w.run = l.run AND w.doc_id > l.doc_id)
        ),
        removed AS (SELECT doc_id, list(place) AS ats FROM gone GROUP BY doc_id),
        kept AS (
            SELECT w.doc_id, len(w.words) AS n_words, len(coalesce(r.ats, [])) AS n_removed,
                   array_to_string(
                       CASE WHEN r.ats IS NULL THEN w.words
                            ELSE list_filter(w.words, lambda x, i: NOT list_contains(r.ats, i)) END, ' ') AS text
            FROM w LEFT JOIN removed r ON w.doc_id = r.doc_id
        )
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
               sha256(text) AS kept_sha256
        FROM kept
    """,
    "op10_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, rank, vec_id, score FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        ) WHERE rank <= 5
    """,
    "op11_prefix_trie": """
        WITH turns AS (
            SELECT conv_id, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS t,
                   row_number() OVER (
                       PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS i
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        own AS (SELECT conv_id, list(t ORDER BY i) AS t FROM turns GROUP BY conv_id),
        -- CRC-32 of the decimals, bit by bit.
        heads AS (
            SELECT conv_id, t, xor(list_reduce(
                list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                lambda crc, byte: list_reduce(
                    list_concat([xor(crc, byte)], list_transform(range(8), lambda z: CAST(0 AS BIGINT))),
                    lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 9 AS h
            FROM own
        ),
        rebuilt AS (
            SELECT c.conv_id, list_concat(list_slice(coalesce(p.t, []), 1, h), list_slice(c.t, h + 1, len(c.t))) AS t
            FROM heads c LEFT JOIN own p ON p.conv_id = c.conv_id - (c.conv_id % 5 + 5) % 5
        ),
        members AS (
            SELECT conv_id, list_slice(t, 1, d) AS path, d, len(t) AS length
            FROM (SELECT *, unnest(generate_series(0, len(t))) AS d FROM rebuilt)
        ),
        nodes AS (
            SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = d), '') AS ends
            FROM members GROUP BY path
        ),
        children AS (SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
        weighed AS (
            SELECT n.*, coalesce(c.n, 0) AS n_children,
                   CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(n.path[depth].text) ELSE 0 END AS saved
            FROM nodes n LEFT JOIN children c ON n.path = c.path
        ),
        below AS (
            SELECT list_slice(path, 1, d) AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved
            FROM (SELECT *, unnest(generate_series(0, depth)) AS d FROM weighed) GROUP BY 1
        )
        SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, CAST(w.n_children AS BIGINT) AS n_children,
               b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
        FROM weighed w JOIN below b ON w.path = b.path
        LEFT JOIN nodes p ON w.depth > 0 AND p.path = list_slice(w.path, 1, w.depth - 1)
    """,
}
