"""The registered queries: every operator over the given tables, with its check in SQL.

Stand-ins: a repository is ``lang/source`` of ``documents`` (or ``source`` and a range of ids where
archives are built), a record id is ``doc_id``.  Archives are zipped by Spark from ``documents``.
"""

from __future__ import annotations

import base64
import functools
import io
import os
import tempfile
import zipfile
from collections.abc import Callable

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.functions import names, text
from codequarry.functions.tokens import token_counter
from codequarry.operators import dedup, fetch, languages, stats
from codequarry.operators.joins import keep_matching
from codequarry.plans import corpus, incremental
from codequarry.schemas import RECORD_COLUMNS, WHITE_SPACE
from codequarry.session import prepare, shared_dir
from codequarry.sinks.records import write_records
from codequarry.sources import archives, catalog, records, repos
from codequarry.sources.zip_entries import storage_uri


@functools.cache
def small_vocabulary() -> str:
    """A vocabulary of all bytes and one merge, ``on``, whose counts SQL can follow."""
    path = os.path.join(tempfile.mkdtemp(prefix="codequarry-"), "small.tiktoken")
    tokens = [bytes([byte]) for byte in range(256)] + [b"on"]
    with open(path, "wb") as file:
        for rank, token in enumerate(tokens):
            file.write(base64.b64encode(token) + b" " + str(rank).encode() + b"\n")
    return path


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its equivalent in SQL."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir)

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- content: trim, hash, encoding, size, ids -------------------------------------------------

_WS = "concat(" + ", ".join(f"chr({ord(c)})" for c in WHITE_SPACE) + ")"
_TRIMMED = f"SELECT doc_id, trim(text, {_WS}) AS text, lang, source, n_chars FROM documents"


def trimmed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.withColumn("text", text.trim_text(F.col("text")))


def _padding(shift: int) -> Column:
    place = F.pmod(F.col("doc_id") + shift, F.lit(len(WHITE_SPACE))).cast("int") + 1
    return F.substr(F.lit(WHITE_SPACE), place, F.lit(1))


@query(f"""
    SELECT doc_id, trim(concat(substr({_WS}, CAST(doc_id % 25 AS INT) + 1, 1), text,
                               substr({_WS}, CAST((doc_id + 7) % 25 AS INT) + 1, 1)), {_WS}) AS text
    FROM documents""")
def trimmed_text(spark, sf_dir):
    padded = F.concat(_padding(0), F.col("text"), _padding(7))
    return table(spark, sf_dir, "documents").select("doc_id", text.trim_text(padded).alias("text"))


@query("SELECT doc_id, md5(text) AS content_hash FROM documents")
def content_hash(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


@query("SELECT doc_id, text FROM documents WHERE lang <> 'fr' OR n_chars % 2 = 0")
def utf8_filter(spark, sf_dir):
    broken = (F.col("lang") == "fr") & (F.col("n_chars") % 2 == 1)
    content = F.col("text").cast("binary")
    content = F.when(broken, F.concat(content, F.unhex(F.lit("FF")))).otherwise(content)
    decoded = table(spark, sf_dir, "documents").select(
        "doc_id", text.decode_utf8(content).alias("text")
    )
    return decoded.filter(F.col("text").isNotNull())


@query("SELECT doc_id, CAST(strlen(text) AS BIGINT) AS size_in_bytes FROM documents "
       "WHERE strlen(text) <= 2048")
def size_filter(spark, sf_dir):
    size = F.octet_length("text").cast("long")
    sized = table(spark, sf_dir, "documents").select("doc_id", size.alias("size_in_bytes"))
    return sized.filter(F.col("size_in_bytes") <= 2048)


@query("SELECT page_id, sha256(concat('pages', chr(0), url, chr(0), page_id)) AS id FROM pages")
def record_ids(spark, sf_dir):
    made = text.stable_record_id(F.lit("pages"), F.col("url"), F.col("page_id"))
    return table(spark, sf_dir, "pages").select("page_id", made.alias("id"))


# --- paths and file names ---------------------------------------------------------------------

@query("""
    SELECT page_id,
           CASE WHEN position('.' IN url) > 0 THEN substr(url, position('.' IN url)) END
             AS file_extension,
           nullif(regexp_extract(split_part(url, '/', -1), '(\\.[^.]+)$', 1), '') AS last_extension
    FROM pages""")
def file_extension(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        names.first_dot_extension(url).alias("file_extension"),
        names.last_dot_extension(F.substring_index(url, "/", -1)).alias("last_extension"),
    )


@query("""
    WITH base AS (SELECT page_id, replace(url, '://', '/') AS p FROM pages),
    paths AS (
      SELECT page_id, CASE page_id % 7 WHEN 0 THEN concat('/', p) WHEN 1 THEN concat('../', p)
        WHEN 2 THEN concat(p, '/../../x.c') WHEN 3 THEN concat('a/../../', p)
        WHEN 4 THEN concat('./', p, '/.') WHEN 5 THEN concat(p, '/..') ELSE p END AS path FROM base),
    parts AS (SELECT page_id, unnest(string_split(path, '/')) AS part,
                     generate_subscripts(string_split(path, '/'), 1) AS i FROM paths),
    depths AS (SELECT page_id, sum(CASE WHEN part IN ('', '.') THEN 0 WHEN part = '..' THEN -1
                 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY i) AS depth FROM parts),
    lowest AS (SELECT page_id, min(depth) AS depth FROM depths GROUP BY page_id)
    SELECT page_id,
           CASE WHEN depth >= 0 AND NOT starts_with(path, '/') THEN path END AS safe_path,
           nullif(list_filter(string_split(path, '/'), lambda x: x NOT IN ('', '.'))[-1], '..')
             AS file_name
    FROM paths JOIN lowest USING (page_id)""")
def safe_paths(spark, sf_dir):
    base = F.replace(F.col("url"), F.lit("://"), F.lit("/"))
    case = F.col("page_id") % 7
    path = (
        F.when(case == 0, F.concat(F.lit("/"), base))
        .when(case == 1, F.concat(F.lit("../"), base))
        .when(case == 2, F.concat(base, F.lit("/../../x.c")))
        .when(case == 3, F.concat(F.lit("a/../../"), base))
        .when(case == 4, F.concat(F.lit("./"), base, F.lit("/.")))
        .when(case == 5, F.concat(base, F.lit("/..")))
        .otherwise(base)
    )
    paths = table(spark, sf_dir, "pages").select("page_id", path.alias("path"))
    return paths.select(
        "page_id",
        names.safe_path(F.col("path")).alias("safe_path"),
        names.path_file_name(F.col("path")).alias("file_name"),
    )


_FILE_SQL = """
    SELECT p_partkey, concat(replace(p_name, ' ', '_'), '_', p_size, '.', lower(p_type), '.zip')
      AS file FROM part"""


def part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file name with underscores and dots for each part."""
    stem = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.col("p_size"))
    file = F.concat(stem, F.lit("."), F.lower("p_type"), F.lit(".zip"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_type", file.alias("file"))


@query(f"""
    SELECT p_partkey, regexp_replace(file, '\\.zip$', '') AS stem,
           split_part(file, '_', 1) AS match_key,
           regexp_replace(regexp_replace(file, '\\.zip$', ''), '_[^_]*$', '') AS base_name
    FROM ({_FILE_SQL})""")
def file_keys(spark, sf_dir):
    stem = names.file_stem(F.col("file"))
    return part_files(spark, sf_dir).select(
        "p_partkey",
        stem.alias("stem"),
        names.match_key(stem).alias("match_key"),
        names.output_base(stem).alias("base_name"),
    )


# --- repository lists and archive matching ----------------------------------------------------

_LINE_SQL = """
    SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN lang WHEN 1 THEN concat(lang, '/', source, '/x')
             WHEN 2 THEN concat('/', source) ELSE concat(lang, '/', source) END AS raw,
           doc_id % 9 = 3 AS is_number, doc_id % 9 = 4 AS is_open FROM documents"""


def repo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository-list lines, some malformed: one, three or empty parts, a number, an open string."""
    case = F.col("doc_id") % 9
    value = (
        F.when(case == 0, F.col("lang"))
        .when(case == 1, F.concat_ws("/", "lang", "source", F.lit("x")))
        .when(case == 2, F.concat(F.lit("/"), F.col("source")))
        .otherwise(F.concat_ws("/", "lang", "source"))
    )
    quote = F.lit('"')
    line = (
        F.when(case == 3, F.col("doc_id").cast("string"))
        .when(case == 4, F.concat(quote, value))
        .otherwise(F.concat(quote, value, quote))
    )
    return table(spark, sf_dir, "documents").select(line.alias("value"))


_PARSED_SQL = f"""
    SELECT CASE WHEN is_number THEN CAST(doc_id AS VARCHAR) WHEN is_open THEN concat('"', raw)
             ELSE raw END AS raw,
           CASE WHEN ok THEN split_part(raw, '/', 1) END AS "user",
           CASE WHEN ok THEN split_part(raw, '/', 2) END AS name,
           CASE WHEN ok THEN replace(raw, '/', '-') END AS repo_key,
           NOT ok AS is_malformed
    FROM (SELECT *, NOT is_number AND NOT is_open AND len(string_split(raw, '/')) = 2 AS ok
          FROM ({_LINE_SQL}))"""


@query(_PARSED_SQL)
def repo_list(spark, sf_dir):
    return repos.parse_repos(repo_lines(spark, sf_dir))


@query(f"SELECT raw FROM ({_PARSED_SQL}) WHERE is_malformed")
def malformed_repos(spark, sf_dir):
    return repos.malformed_repos(repos.parse_repos(repo_lines(spark, sf_dir)))


@query(f"SELECT DISTINCT repo_key FROM ({_PARSED_SQL}) WHERE NOT is_malformed")
def repo_keys(spark, sf_dir):
    return repos.repo_keys(repos.valid_repos(repos.parse_repos(repo_lines(spark, sf_dir))))


_TOXIC_SQL = """SELECT DISTINCT lang AS "user", source AS name, concat(lang, '-', source) AS repo_key
    FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)"""


def listed_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repositories with a document labelled toxic, parsed from list lines."""
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    listed = documents.join(toxic, "doc_id", "left_semi")
    line = F.concat(F.lit('"'), F.concat_ws("/", "lang", "source"), F.lit('"'))
    return repos.valid_repos(repos.parse_repos(listed.select(line.alias("value"))))


@query(f"""SELECT doc_id, text, concat(lang, '-', source) AS repo FROM documents
    WHERE concat(lang, '-', source) IN (SELECT repo_key FROM ({_TOXIC_SQL}))""")
def repo_semi_join(spark, sf_dir):
    repo = names.repo_key(F.col("lang"), F.col("source")).alias("repo")
    files = table(spark, sf_dir, "documents").select("doc_id", "text", repo)
    keys = listed_repos(spark, sf_dir).select(F.col("repo_key").alias("repo"))
    return keep_matching(files, keys, "repo", spread=["doc_id"])


_KEY_SQL = "SELECT DISTINCT concat(lower(p_type), '-', p_size) AS repo_key FROM part"
_STEM_SQL = """SELECT p_partkey, concat(lower(p_type), '-', p_size,
    CASE WHEN p_partkey % 3 = 0 THEN '_' || replace(p_name, ' ', '_') ELSE '' END) AS stem FROM part"""


def part_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.concat(F.lit("_"), F.replace("p_name", F.lit(" "), F.lit("_")))
    suffix = F.when(F.col("p_partkey") % 3 == 0, suffix).otherwise("")
    stem = F.concat(F.lower("p_type"), F.lit("-"), F.col("p_size"), suffix)
    return table(spark, sf_dir, "part").select("p_partkey", stem.alias("stem"))


def part_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lower("p_type"), F.lit("-"), F.col("p_size"))
    return table(spark, sf_dir, "part").select(key.alias("repo_key"))


@query(f"SELECT * FROM ({_STEM_SQL}) WHERE stem IN (SELECT repo_key FROM ({_KEY_SQL}))")
def match_exact(spark, sf_dir):
    return archives.match_archives(part_archives(spark, sf_dir), part_repos(spark, sf_dir))


@query(f"""SELECT * FROM ({_STEM_SQL})
    WHERE split_part(stem, '_', 1) IN (SELECT repo_key FROM ({_KEY_SQL}))""")
def match_prefix(spark, sf_dir):
    files = part_archives(spark, sf_dir)
    return archives.match_archives(files, part_repos(spark, sf_dir), match="prefix")


# --- fetch planning ---------------------------------------------------------------------------

_REPO_SQL = "SELECT DISTINCT lang, source FROM documents"
_STORED_SQL = "SELECT concat(lang, '-', source) AS stem FROM documents GROUP BY lang, source " \
              "HAVING max(n_chars) > 20000"


def document_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, name = F.col("lang").alias("user"), F.col("source").alias("name")
    key = names.repo_key(F.col("lang"), F.col("source")).alias("repo_key")
    return table(spark, sf_dir, "documents").select(user, name, key)


def stored_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").groupBy("lang", "source")
    long_ones = documents.agg(F.max("n_chars").alias("longest")).filter("longest > 20000")
    return long_ones.select(names.repo_key(F.col("lang"), F.col("source")).alias("stem"))


@query(f"""
    SELECT repo_key, priority, branch,
           concat('https://github.com/', lang, '/', source, '/archive/refs/heads/', branch, '.zip')
             AS url,
           concat('/data/zip/', repo_key, '.zip') AS target
    FROM (SELECT lang, source, concat(lang, '-', source) AS repo_key FROM ({_REPO_SQL})),
         (VALUES (1, 'main'), (2, 'master')) AS b(priority, branch)
    WHERE repo_key NOT IN (SELECT stem FROM ({_STORED_SQL}))""")
def pending_fetch(spark, sf_dir):
    listed = document_repos(spark, sf_dir)
    return fetch.fetch_plan(listed, stored_archives(spark, sf_dir), "/data/zip")


@query("""
    SELECT lang AS "user", source AS name,
           CASE WHEN bool_or(n_chars > 15000) THEN 'main' ELSE 'master' END AS branch
    FROM documents GROUP BY lang, source
    HAVING bool_or(n_chars > 15000) OR bool_or(n_chars < 100)""")
def branch_fallback(spark, sf_dir):
    attempts = fetch.branch_candidates(
        table(spark, sf_dir, "documents").select(
            F.col("lang").alias("user"), F.col("source").alias("name"), "n_chars"
        )
    )
    on_main = (F.col("branch") == "main") & (F.col("n_chars") > 15000)
    on_master = (F.col("branch") == "master") & (F.col("n_chars") < 100)
    return fetch.first_success(attempts.withColumn("succeeded", on_main | on_master))


@query("""
    SELECT concat(page_id, '-', url) AS path,
           CASE WHEN contains(url, 'utm_source') THEN 'new'
                WHEN contains(url, '#top') THEN 'changed' ELSE 'unchanged' END AS status
    FROM pages""")
def reconcile(spark, sf_dir):
    path = F.concat_ws("-", "page_id", "url").alias("path")
    pages = table(spark, sf_dir, "pages")
    fetched = pages.select(path, F.col("html").alias("content"))
    older = F.when(F.contains("url", F.lit("#top")), F.concat("html", F.lit("old")))
    stored = pages.filter(~F.contains("url", F.lit("utm_source")))
    stored = stored.select(path, F.coalesce(older, "html").alias("content"))
    return fetch.reconcile_archives(fetched, stored)


# --- languages --------------------------------------------------------------------------------

_CATALOG_SQL = """
    SELECT DISTINCT concat(lang, '-', source) AS language,
           CASE WHEN lang = 'es' THEN NULL WHEN source IN ('src1', 'src2', 'src12', 'src13')
             THEN 'programming' ELSE 'data' END AS type,
           CASE WHEN source = 'src5' THEN [] WHEN lang = 'en' THEN
             [concat('.', lang, substr(source, 4)), '.h'] ELSE [concat('.', lang, substr(source, 4))]
           END AS extensions
    FROM documents"""
_REQUEST_SQL = """
    SELECT concat(lang, '-', source) AS language FROM documents
    WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
    UNION SELECT concat('no-', lang) FROM documents"""
_NAMED_SQL = f"""SELECT DISTINCT unnest(extensions) AS extension, type FROM ({_CATALOG_SQL})
    WHERE type IS NOT NULL AND language IN (SELECT language FROM ({_REQUEST_SQL}))"""
_PROGRAMMING_SQL = f"""SELECT DISTINCT unnest(extensions) AS extension, type FROM ({_CATALOG_SQL})
    WHERE type = 'programming'"""


def catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language catalog with one language per (lang, source), some without type or extensions."""
    own = F.concat(F.lit("."), F.col("lang"), F.substring("source", 4, 100))
    kinds = F.when(F.col("source").isin("src1", "src2", "src12", "src13"), "programming")
    extensions = (
        F.when(F.col("source") == "src5", F.array().cast("array<string>"))
        .when(F.col("lang") == "en", F.array(own, F.lit(".h")))
        .otherwise(F.array(own))
    )
    return table(spark, sf_dir, "documents").select("lang", "source").distinct().select(
        F.concat_ws("-", "lang", "source").alias("language"),
        F.when(F.col("lang") != "es", F.coalesce(kinds, F.lit("data"))).alias("type"),
        extensions.alias("extensions"),
    )


def missing_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    made_up = F.concat(F.lit("no-"), F.col("lang")).alias("language")
    return table(spark, sf_dir, "documents").select(made_up)


def requested_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = listed_repos(spark, sf_dir).select(F.col("repo_key").alias("language"))
    return named.union(missing_languages(spark, sf_dir)).distinct()


@query(_PROGRAMMING_SQL)
def programming_extensions(spark, sf_dir):
    return languages.programming_extensions(catalog_rows(spark, sf_dir))


@query(_NAMED_SQL)
def language_extensions(spark, sf_dir):
    return languages.language_extensions(
        catalog_rows(spark, sf_dir), requested_languages(spark, sf_dir)
    )


@query(_PROGRAMMING_SQL)
def language_fallback(spark, sf_dir):
    return languages.language_extensions(
        catalog_rows(spark, sf_dir), missing_languages(spark, sf_dir)
    )


@query(f"""SELECT language FROM ({_REQUEST_SQL})
    WHERE language NOT IN (SELECT language FROM ({_CATALOG_SQL}))""")
def unknown_languages(spark, sf_dir):
    return languages.unknown_languages(
        catalog_rows(spark, sf_dir), requested_languages(spark, sf_dir)
    )


@query(f"""
    SELECT doc_id, text, concat('doc.', doc_id, '.', lang, substr(source, 4)) AS file_name
    FROM documents
    WHERE concat('.', lang, substr(source, 4)) IN (SELECT extension FROM ({_NAMED_SQL}))""")
def language_filter(spark, sf_dir):
    number = F.substring("source", 4, 100)
    file_name = F.concat(F.lit("doc."), F.col("doc_id"), F.lit("."), F.col("lang"), number)
    files = table(spark, sf_dir, "documents").select("doc_id", "text", file_name.alias("file_name"))
    wanted = languages.language_extensions(
        catalog_rows(spark, sf_dir), requested_languages(spark, sf_dir)
    )
    return languages.keep_languages(files, wanted)


# --- deduplication ----------------------------------------------------------------------------

@query(f"""
    SELECT doc_id, text, lang, source, n_chars FROM ({_TRIMMED})
    QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1""")
def exact_dedup(spark, sf_dir):
    return dedup.exact_dedup(trimmed_documents(spark, sf_dir), id="doc_id")


@query("SELECT md5(text) AS content_hash, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def survivor_ids(spark, sf_dir):
    return dedup.content_survivors(table(spark, sf_dir, "documents"), id="doc_id")


@query("""
    SELECT md5(text) AS content_hash, arg_min(concat(source, '-', doc_id), doc_id) AS id
    FROM documents GROUP BY 1""")
def survivor_ids_by_order(spark, sf_dir):
    made = F.concat_ws("-", "source", "doc_id").alias("id")
    documents = table(spark, sf_dir, "documents").select("text", "doc_id", made)
    return dedup.content_survivors(documents, order_by="doc_id")


@query("""
    SELECT count(*) AS loaded, count(DISTINCT md5(text)) AS "unique",
           1 - count(DISTINCT md5(text)) / count(*) AS duplicate_rate FROM documents""")
def dedup_summary(spark, sf_dir):
    return dedup.dedup_summary(table(spark, sf_dir, "documents"))


# --- statistics and tokens --------------------------------------------------------------------

@query("""
    SELECT source AS repo, count(DISTINCT source) AS files, count(*) AS records,
           CAST(sum(n_chars) AS BIGINT) AS tokens,
           count(*) // count(DISTINCT source) AS avg_records_per_file,
           sum(length(text)) / count(text) AS avg_chars
    FROM documents GROUP BY ROLLUP (source)""")
def corpus_stats(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return stats.corpus_stats(
        documents.select(F.col("source").alias("repo"), "text", F.col("n_chars").alias("tokens"))
    )


@query("SELECT source AS repo, count(*) AS records FROM documents GROUP BY source")
def archive_counts(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return stats.records_per_repo(documents.select(F.col("source").alias("repo")))


@query("SELECT count(*) AS records FROM documents")
def total_records(spark, sf_dir):
    return stats.total_records(table(spark, sf_dir, "documents"))


_COUNT_SQL = "strlen(text) - (strlen(text) - strlen(replace(text, 'on', ''))) // 2"


@query(ORACLES["corpus_stats"].replace("n_chars", f"({_COUNT_SQL})"))
def token_stats(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(F.col("source").alias("repo"), "text")
    count = token_counter(spark, small_vocabulary())
    return stats.corpus_stats(documents.withColumn("tokens", count(F.col("text"))))


# --- archives, records and the compositions ---------------------------------------------------

_ARCHIVE_DOCS = 1000
_CAP = 20000

# A file per document: some with no dot in the path, some unsafe, some not UTF-8, all padded.
_MEMBER_SQL = f"""
    SELECT *, row_number() OVER (PARTITION BY repo ORDER BY doc_id) AS entry_index,
           strlen(text) + 3 + CAST(broken AS INT) AS size_in_bytes
    FROM (SELECT doc_id, text, source, lang, lang = 'fr' AND n_chars % 2 = 1 AS broken,
                 concat(source, '-batch', doc_id // {_ARCHIVE_DOCS}) AS repo,
                 CASE WHEN n_chars % 11 = 0 THEN concat('main/doc', doc_id, '/README')
                      WHEN n_chars % 13 = 0 THEN concat('main/../../doc', doc_id, '.', lang)
                      ELSE concat('main/', lang, '/doc', doc_id, '.', lang) END AS path
          FROM documents)"""
_EXTRACTED_SQL = f"""
    SELECT trim(text, {_WS}) AS text,
           sha256(concat(repo, chr(0), path, chr(0), entry_index)) AS id,
           substr(path, position('.' IN path)) AS file_extension, 'programming' AS category, path,
           CAST(size_in_bytes AS BIGINT) AS size_in_bytes, split_part(path, '/', -1) AS file_name,
           repo
    FROM ({_MEMBER_SQL})
    WHERE NOT broken AND position('.' IN path) > 0 AND NOT contains(path, '..')
      AND size_in_bytes <= {_CAP} AND source <> 'src7'"""


def archive_members(spark: SparkSession, sf_dir: str, content: Column | None = None) -> DataFrame:
    """Members with the text, or other content, of each document."""
    lang, doc_id = F.col("lang"), F.col("doc_id")
    file = F.concat(F.lit("doc"), doc_id, F.lit("."), lang)
    path = (
        F.when(F.col("n_chars") % 11 == 0, F.concat(F.lit("main/doc"), doc_id, F.lit("/README")))
        .when(F.col("n_chars") % 13 == 0, F.concat(F.lit("main/../../"), file))
        .otherwise(F.concat(F.lit("main/"), lang, F.lit("/"), file))
    )
    padded = F.concat(F.lit(" "), F.col("text") if content is None else content, F.lit("\n")).cast("binary")
    broken = (lang == "fr") & (F.col("n_chars") % 2 == 1)
    batch = F.floor(doc_id / _ARCHIVE_DOCS)
    return table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit("-batch"), batch).alias("repo"),
        "doc_id",
        path.alias("path"),
        F.when(broken, F.concat(padded, F.unhex(F.lit("FF")))).otherwise(padded).alias("content"),
    )


def archive_repos(spark: SparkSession, sf_dir: str, unlisted: str = "src7") -> DataFrame:
    """The list of all archived repositories but those of one source."""
    batch = F.concat(F.lit("batch"), F.floor(F.col("doc_id") / _ARCHIVE_DOCS))
    line = F.concat(F.lit('"'), F.concat_ws("/", "source", batch), F.lit('"'))
    others = table(spark, sf_dir, "documents").filter(F.col("source") != unlisted)
    return repos.valid_repos(repos.parse_repos(others.select(line.alias("value"))))


def zip_archives(members: DataFrame, directory: str | None = None) -> DataFrame:
    """(archive, stem, length, content): a zip per repository, of at most ``_ARCHIVE_DOCS`` files.

    With ``directory`` each zip is written there and ``content`` is left NULL.  Members with a ``flaw``
    are stored with a changed byte, or their whole archive is cut short.
    """

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
            out.writestr(zipfile.ZipInfo("main/"), b"")
            for path, content in zip(group["path"], group["content"]):
                out.writestr(zipfile.ZipInfo(path), bytes(content), zipfile.ZIP_DEFLATED)
        data, stem = bytearray(buffer.getvalue()), group["repo"].iloc[0]
        if "flaw" in group:
            with zipfile.ZipFile(io.BytesIO(bytes(data))) as made:
                for path in group["path"][group["flaw"] == "damaged"]:
                    info = made.getinfo(path)
                    begin = info.header_offset + 30 + len(path.encode())
                    data[begin] ^= 0xFF
            if (group["flaw"] == "cut").any():
                data = data[:-30]
        data = bytes(data)
        archive = f"{directory or 'memory:'}/{stem}.zip"
        if directory:
            filesystem, inner = fs.FileSystem.from_uri(storage_uri(archive))
            filesystem.create_dir(inner.rpartition("/")[0])
            with filesystem.open_output_stream(inner) as stream:
                stream.write(data)
        row = {"archive": archive, "stem": stem, "length": len(data)}
        return pd.DataFrame([row | {"content": None if directory else data}])

    schema = "archive string, stem string, length long, content binary"
    return members.groupBy("repo").applyInPandas(build, schema)


def stored_zip_dir(spark: SparkSession, sf_dir: str, members: DataFrame | None = None) -> str:
    """Write archives, those of ``documents`` by default, into a new shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark, "archives"))
    filesystem = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    directory = filesystem.makeQualified(path).toString()
    if members is None:
        members = archive_members(spark, sf_dir)
    written = zip_archives(members, directory).select("length")
    written.write.format("noop").mode("overwrite").save()
    return directory


def extracted(spark: SparkSession, sf_dir: str, vocabulary: str | None) -> DataFrame:
    return corpus.extract(
        spark,
        archive_repos(spark, sf_dir),
        stored_zip_dir(spark, sf_dir),
        vocabulary=vocabulary,
        max_file_size=_CAP,
    )


@query(f"SELECT DISTINCT repo AS stem FROM ({_MEMBER_SQL})")
def archive_listing(spark, sf_dir):
    return archives.list_archives(spark, stored_zip_dir(spark, sf_dir)).select("stem")


@query(f"SELECT DISTINCT repo FROM ({_MEMBER_SQL}) WHERE source IN ('src3', 'src4')")
def archive_errors(spark, sf_dir):
    held = zip_archives(archive_members(spark, sf_dir))
    # The end of a zip is its directory.
    cut = F.substring("content", F.lit(1), F.octet_length("content") - 30)
    damaged = F.col("stem").startswith("src3-") | F.col("stem").startswith("src4-")
    held = held.withColumn("content", F.when(damaged, cut).otherwise(F.col("content")))
    return archives.archive_errors(archives.list_archive_entries(held)).select("repo")


@query(f"""
    SELECT repo, entry_index, path AS entry_name, CAST(size_in_bytes AS BIGINT) AS size_in_bytes,
           CASE WHEN broken THEN NULL ELSE md5(concat(chr(160), text, chr(10))) END AS content_hash
    FROM ({_MEMBER_SQL})
    WHERE position('.' IN path) > 0 AND NOT contains(path, '..') AND size_in_bytes <= {_CAP}""")
def archive_entries(spark, sf_dir):
    held = zip_archives(archive_members(spark, sf_dir))
    entries = archives.expand_archives(held, max_file_size=_CAP)
    decoded = text.decode_utf8(F.col("content"))
    return entries.select(
        "repo", "entry_index", "entry_name", "size_in_bytes",
        text.content_hash(decoded).alias("content_hash"),
    )


@query(f"""
    SELECT repo, entry_index, path AS entry_name, true AS is_file, CAST(size_in_bytes AS BIGINT) AS size_in_bytes
    FROM ({_MEMBER_SQL})
    UNION ALL
    SELECT DISTINCT repo, 0, 'main/', false, 0 FROM ({_MEMBER_SQL})""")
def archive_directories(spark, sf_dir):
    """Central directories, each cut into ranges of a few members."""
    listed = archives.list_archives(spark, stored_zip_dir(spark, sf_dir))
    tasks = spark.sparkContext.defaultParallelism
    entries = archives.list_long_directories(listed, tasks, longer_than=0, directory_bytes=1 << 10)
    return entries.select("repo", "entry_index", "entry_name", "is_file", "size_in_bytes")


@query(_EXTRACTED_SQL)
def extract_records(spark, sf_dir):
    return extracted(spark, sf_dir, None)


@query(f"SELECT *, {_COUNT_SQL} AS tokens FROM ({_EXTRACTED_SQL})")
def extract_with_tokens(spark, sf_dir):
    return extracted(spark, sf_dir, small_vocabulary())


_IN_ARCHIVE = f"position('.' IN path) > 0 AND NOT contains(path, '..') AND size_in_bytes <= {_CAP}"


@query(f"""
    SELECT DISTINCT repo, CAST(NULL AS VARCHAR) AS path, 'archive' AS reason
    FROM ({_MEMBER_SQL}) WHERE source = 'src3'
    UNION ALL
    SELECT repo, path, CASE WHEN source = 'src4' AND n_chars % 5 = 0 THEN 'damaged' ELSE 'encoding' END
    FROM (SELECT m.*, d.n_chars FROM ({_MEMBER_SQL}) m JOIN documents d USING (doc_id))
    WHERE {_IN_ARCHIVE} AND source NOT IN ('src3', 'src7')
      AND (broken OR (source = 'src4' AND n_chars % 5 = 0))""")
def extract_quarantine(spark, sf_dir):
    rows = corpus.extract(
        spark,
        archive_repos(spark, sf_dir),
        flawed_zip_dir(spark, sf_dir),
        vocabulary=None,
        max_file_size=_CAP,
        with_errors=True,
    )
    return corpus.rejected(rows).select("repo", "path", reason_of_error().alias("reason"))


def flawed_zip_dir(spark: SparkSession, sf_dir: str) -> str:
    """Archives of which those of ``src3`` are cut short and some members of ``src4`` are damaged."""
    listed = table(spark, sf_dir, "documents")
    flaw = (
        F.when(F.col("source") == "src3", "cut")
        .when((F.col("source") == "src4") & (F.col("n_chars") % 5 == 0), "damaged")
        .otherwise("")
    )
    members = archive_members(spark, sf_dir).join(listed.select("doc_id", flaw.alias("flaw")), "doc_id")
    return stored_zip_dir(spark, sf_dir, members)


def reason_of_error() -> Column:
    return (
        F.when(F.col("error").isNull(), F.lit(None))
        .when(F.col("error").startswith("damaged"), "damaged")
        .when(F.col("error") == "not UTF-8 text", "encoding")
        .when(F.col("error") == "refused by the tokenizer", "tokenizer")
        .otherwise("archive")
    )


@functools.cache
def refusing_vocabulary() -> str:
    """A tokenizer definition that has no token, and no unknown one, for a text with an umlaut u."""
    from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

    tokenizer = Tokenizer(models.WordLevel({"x": 0}))
    tokenizer.normalizer = normalizers.Replace(Regex("[^ü]+"), "x")
    tokenizer.pre_tokenizer = pre_tokenizers.Split("ü", "isolated")
    path = os.path.join(tempfile.mkdtemp(prefix="codequarry-"), "refusing.json")
    tokenizer.save(path)
    return path


@query(f"""
    SELECT repo, path, CASE WHEN contains(text, 'ü') THEN NULL ELSE CAST(text <> '' AS BIGINT) END AS tokens,
           CASE WHEN contains(text, 'ü') THEN 'tokenizer' END AS reason
    FROM ({_EXTRACTED_SQL})""")
def extract_refused(spark, sf_dir):
    """Records of a tokenizer that refuses some texts, and the texts it refused."""
    rows = corpus.extract(
        spark,
        archive_repos(spark, sf_dir),
        stored_zip_dir(spark, sf_dir),
        vocabulary=refusing_vocabulary(),
        max_file_size=_CAP,
        with_errors=True,
    )
    rows = rows.filter(F.col("error").isNull() | (F.col("error") == "refused by the tokenizer"))
    return rows.select("repo", "path", "tokens", reason_of_error().alias("reason"))


_QUARANTINE_SQL = ORACLES["extract_quarantine"]


@query(f"""
    {_QUARANTINE_SQL}
    UNION ALL
    SELECT repo, path, CASE WHEN contains(text, 'ü') THEN 'tokenizer' END FROM (
      SELECT e.* FROM ({_EXTRACTED_SQL}) e
      WHERE NOT starts_with(repo, 'src3-') AND id NOT IN (
        SELECT sha256(concat(repo, chr(0), path, chr(0), entry_index))
        FROM (SELECT m.*, d.n_chars FROM ({_MEMBER_SQL}) m JOIN documents d USING (doc_id))
        WHERE source = 'src4' AND n_chars % 5 = 0)
      QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY id) = 1)""")
def extract_unique_quarantine(spark, sf_dir):
    """Unique records of flawed archives (no reason), and the account of all that is left out."""
    rows = corpus.extract_unique(
        spark,
        archive_repos(spark, sf_dir),
        flawed_zip_dir(spark, sf_dir),
        vocabulary=refusing_vocabulary(),
        max_file_size=_CAP,
        with_errors=True,
    )
    return rows.select("repo", "path", reason_of_error().alias("reason"))


@query(f"SELECT * FROM ({_EXTRACTED_SQL}) WHERE path LIKE '%.de' OR path LIKE '%.es'")
def extract_languages(spark, sf_dir):
    langs = table(spark, sf_dir, "documents").select("lang").distinct()
    known = langs.select(
        F.col("lang").alias("language"),
        F.lit("programming").alias("type"),
        F.array(F.concat(F.lit("."), "lang")).alias("extensions"),
    )
    return corpus.extract(
        spark,
        archive_repos(spark, sf_dir),
        stored_zip_dir(spark, sf_dir),
        vocabulary=None,
        max_file_size=_CAP,
        languages=known.filter("language in ('de', 'es')").select("language"),
        catalog=known,
    )


_DEDUPED_SQL = f"""
    SELECT repo, path, md5(text) AS content_hash FROM (
      SELECT * FROM ({_EXTRACTED_SQL})
      QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY id) = 1)"""


@query(_DEDUPED_SQL)
def extract_unique(spark, sf_dir):
    unique = corpus.extract_unique(
        spark,
        archive_repos(spark, sf_dir),
        stored_zip_dir(spark, sf_dir),
        vocabulary=small_vocabulary(),
        max_file_size=_CAP,
    )
    return unique.select("repo", "path", text.content_hash(F.col("text")).alias("content_hash"))


@query(_DEDUPED_SQL)
def extract_write_dedupe(spark, sf_dir):
    directory = shared_dir(spark, "records")
    write_records(extracted(spark, sf_dir, small_vocabulary()), directory)
    kept = corpus.dedupe(
        spark, archive_repos(spark, sf_dir), directory, layout="repo"
    )
    return kept.select("repo", "path", text.content_hash(F.col("text")).alias("content_hash"))



_CHANGED = "CAST(substr(source, 4) AS INT) % 3 = 1"


@query(_DEDUPED_SQL.replace("FROM documents)", f"""FROM (SELECT * REPLACE (
    CASE WHEN {_CHANGED} THEN concat(text, ' changed') ELSE text END AS text) FROM documents))"""))
def extract_incremental(spark, sf_dir):
    """A store that was filled, then refreshed after a third of the archives changed, one source came and one went."""
    store, directory = shared_dir(spark, "store"), stored_zip_dir(spark, sf_dir)
    options = {"vocabulary": small_vocabulary(), "max_file_size": _CAP}
    incremental.refresh(spark, archive_repos(spark, sf_dir, unlisted="src9"), directory, store, **options)
    changed = archive_members(spark, sf_dir, F.concat("text", F.lit(" changed")))
    changed = changed.filter(F.substring_index("repo", "-", 1).substr(4, 9).cast("int") % 3 == 1)
    zip_archives(changed, directory).write.format("noop").mode("overwrite").save()
    incremental.refresh(spark, archive_repos(spark, sf_dir), directory, store, **options)
    unique = incremental.stored_unique(spark, store)
    return unique.select("repo", "path", text.content_hash(F.col("text")).alias("content_hash"))



def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON line per document: some cut short, without a field, with a wrong type or followed by
    more text, some with a further field."""
    columns = {
        "text": F.col("text"),
        "id": F.concat(F.lit("id-"), F.col("doc_id")),
        "file_extension": F.concat(F.lit("."), F.col("lang")),
        "category": F.lit("programming"),
        "path": F.concat_ws("/", "source", "lang"),
        "size_in_bytes": F.octet_length("text").cast("long"),
        "file_name": F.col("lang"),
        "tokens": F.col("n_chars"),
    }
    whole = F.to_json(F.struct(*[c.alias(name) for name, c in columns.items()]))
    more = F.to_json(F.struct(*[c.alias(n) for n, c in columns.items()], F.lit(1).alias("extra")))
    less = F.to_json(F.struct(*[c.alias(n) for n, c in columns.items() if n != "path"]))
    typed = F.to_json(F.struct(*[F.lit("5").alias(n) if n == "tokens" else c.alias(n)
                                 for n, c in columns.items()]))
    case = F.col("n_chars") % 7
    line = (
        F.when(case == 0, F.substr(whole, F.lit(1), F.char_length(whole) - 3))
        .when(case == 1, less)
        .when(case == 2, typed)
        .when(case == 3, F.concat(whole, F.lit(" x")))
        .when(case == 4, more)
        .otherwise(whole)
    )
    return table(spark, sf_dir, "documents").select("doc_id", line.alias("value"))


@query("""
    SELECT doc_id, text, concat('id-', doc_id) AS id, concat('.', lang) AS file_extension,
           'programming' AS category, concat(source, '/', lang) AS path,
           CAST(strlen(text) AS BIGINT) AS size_in_bytes, lang AS file_name, n_chars AS tokens
    FROM documents WHERE n_chars % 7 > 3""")
def record_scan(spark, sf_dir):
    return records.valid_records(records.parse_record_lines(record_lines(spark, sf_dir)))


@query("SELECT doc_id FROM documents WHERE n_chars % 7 <= 3")
def malformed_records(spark, sf_dir):
    parsed = records.parse_record_lines(record_lines(spark, sf_dir))
    return records.malformed_records(parsed).drop("raw")


@query(_DEDUPED_SQL)
def dedupe_written(spark, sf_dir):
    """The deduplicated records as they are written and read back."""
    directory, unique = shared_dir(spark, "records"), shared_dir(spark, "unique")
    write_records(extracted(spark, sf_dir, small_vocabulary()), directory, fmt="parquet")
    kept = corpus.dedupe(spark, archive_repos(spark, sf_dir), directory, layout="parquet")
    write_records(kept, unique, cluster=True)
    back = corpus.read_corpus(spark, unique, layout="repo")
    return back.select("repo", "path", text.content_hash(F.col("text")).alias("content_hash"))


def write_flat(rows: DataFrame, directory: str) -> None:
    """A ``<repo>.jsonl`` file for each repository, as other tools write them."""

    def write(group: pd.DataFrame) -> pd.DataFrame:
        repo = group["repo"].iloc[0]
        filesystem, inner = fs.FileSystem.from_uri(storage_uri(f"{directory}/{repo}.jsonl"))
        filesystem.create_dir(inner.rpartition("/")[0])
        with filesystem.open_output_stream(inner) as stream:
            for line in group["line"]:
                stream.write(line.encode() + b"\n")
        return pd.DataFrame([{"repo": repo}])

    lines = rows.select("repo", F.to_json(F.struct(*RECORD_COLUMNS)).alias("line"))
    lines.groupBy("repo").applyInPandas(write, "repo string").write.format("noop").mode("overwrite").save()


@query(f"""
    SELECT layout, repo, path, md5(text) AS content_hash
    FROM ({_EXTRACTED_SQL}), (VALUES ('bucket'), ('file'), ('parquet'), ('repo')) AS l(layout)""")
def read_layouts(spark, sf_dir):
    """Records written and read in each folder layout."""
    written = shared_dir(spark, "records")
    write_records(extracted(spark, sf_dir, small_vocabulary()), written, fmt="parquet")
    rows = corpus.read_corpus(spark, written, layout="parquet")
    found = [("parquet", rows)]
    flat = shared_dir(spark, "records")
    write_flat(rows, flat)
    found.append(("file", corpus.read_corpus(spark, flat, archive_repos(spark, sf_dir), layout="file")))
    for layout, options in (("repo", {}), ("bucket", {"buckets": 3})):
        directory = shared_dir(spark, "records")
        write_records(rows, directory, **options)
        found.append((layout, corpus.read_corpus(spark, directory, layout=layout)))
    content = text.content_hash(F.col("text")).alias("content_hash")
    parts = [part.select(F.lit(layout).alias("layout"), "repo", "path", content) for layout, part in found]
    return functools.reduce(DataFrame.unionByName, parts)


@query("""
    SELECT concat(lang, '-', source) AS repo_key, count(*) AS listed FROM documents
    WHERE n_chars % 4 <> 1 GROUP BY 1""")
def repo_list_file(spark, sf_dir):
    """A written list: a quarter of its lines go on after their string, and are malformed."""
    line = F.concat(F.lit('"'), F.concat_ws("/", "lang", "source"), F.lit('"'))
    ends = F.element_at(F.array(F.lit(""), F.lit("] junk"), F.lit(" "), F.lit("\t")), (F.col("n_chars") % 4 + 1).cast("int"))
    directory = shared_dir(spark, "list")
    table(spark, sf_dir, "documents").select(F.concat(line, ends).alias("value")).write.text(directory)
    valid = repos.valid_repos(repos.scan_repo_list(spark, directory))
    return valid.groupBy("repo_key").agg(F.count("*").alias("listed"))


@query("""
    SELECT shape, lang AS language, 'programming' AS type, concat('.', lang) AS extension
    FROM (SELECT DISTINCT lang FROM documents), (VALUES ('array'), ('lines'), ('map')) AS s(shape)""")
def catalog_scan(spark, sf_dir):
    """A catalog written in each of its three shapes."""
    langs = table(spark, sf_dir, "documents").select("lang").distinct()
    entry = F.struct(F.lit("programming").alias("type"), F.array(F.concat(F.lit("."), "lang")).alias("extensions"))
    row = F.struct(F.col("lang").alias("language"), entry["type"].alias("type"), entry["extensions"].alias("extensions"))
    shapes = {
        "lines": langs.select(F.to_json(row)),
        "array": langs.agg(F.to_json(F.collect_list(row))),
        "map": langs.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("lang"), entry))))),
    }
    parts = []
    for shape, lines in shapes.items():
        directory = shared_dir(spark, "catalog")
        lines.coalesce(1).write.text(directory)
        found = catalog.scan_catalog(spark, directory)
        parts.append(found.select(F.lit(shape).alias("shape"), "language", "type", F.explode("extensions").alias("extension")))
    return functools.reduce(DataFrame.unionByName, parts)
