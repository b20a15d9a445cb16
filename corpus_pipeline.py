"""Corpus pipeline: language ID, near-dedup, substring dedup, secret removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a table that can be written and read again as the next
one's documents; all but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.llm import language, packing, secrets, simhash, substring_dedup
from codequarry.llm.common import documents, is_remainder, materialize
from codequarry.session import prepare

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DEFINITION = public_tokenizers.path("byte_bpe_50k.json")
# A text below both is in no learned language.
LEAST_SCORE = 0.75
LEAST_KNOWN = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language; a null label becomes the predicted one.

    Rejected: null texts, texts without a letter, and those that are neither clearly of one language
    (``LEAST_SCORE``) nor made of learned words (``LEAST_KNOWN``), such as unlearned languages and gibberish.
    """
    prepare(spark)
    model = language.train(docs.filter(~is_remainder("doc_id", 3, 1)))
    rows = docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("row"), docs["text"])
    is_learned = (F.col("score") >= LEAST_SCORE) | (F.col("known") >= LEAST_KNOWN)
    kept = language.predict(rows, model).filter((F.col("lang_pred") != language.UNDETERMINED) & is_learned)
    columns = [
        F.coalesce("row.lang", "lang_pred").alias("lang") if name == "lang" else F.col("row")[name].alias(name)
        for name in docs.columns
    ]
    return kept.select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest-numbered document of each group linked by three-word fingerprints at distance 3.

    Null numbers come after all others, null texts have no words, and of rows that repeat number and text one stays.
    """
    prepare(spark)
    return simhash.remove_near_duplicates(docs, shingle=3, distance=3)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words of 50-word windows that a smaller-numbered document has; what lost all words goes.

    Untouched texts stay as they are, null ones too, others are their kept words joined by spaces.  Rows that
    repeat a number do not remove each other's words.
    """
    prepare(spark)
    # The text crosses the shuffle once: of all else only whether it was null comes along.
    mark = "null_text" + "_" * sum(map(len, docs.columns))
    marked = docs.withColumn(mark, F.col("text").isNull())
    others = tuple(name for name in marked.columns if name != "text")
    deduplicated = substring_dedup.deduplicate(marked, carry=others, untouched=True)
    kept = deduplicated.filter("n_removed = 0 or n_removed < n_words")
    text = F.when(~F.col("carried")[mark], F.col("kept"))
    return kept.select(*_with_text(docs, "carried", text))


def secret_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; no document goes."""
    prepare(spark)
    masked = secrets.redact(docs, RANKS)
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack_documents(docs, DEFINITION, special_as_text=False)


def _with_text(docs: DataFrame, row: str, text) -> list:
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return [(new[name] if name in new else F.col(row)[name]).alias(name) for name in docs.columns]


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("secret_removal", secret_removal),
    ("packing", packing_stage),
]

# Learned language scores, SimHash and tokenizers cannot be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
