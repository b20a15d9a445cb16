import base64
import random

import pytest
from conftest import SF
from pyspark.sql import functions as F

from codequarry.functions.tokens import pre_token_count, token_counter

# Reference counts of these tables, computed once with two independent tokenizer libraries.
GOLDEN = {"sf0.001": 195872, "sf0.01": 983065}


@pytest.mark.parametrize("scale", GOLDEN)
def test_total_on_documents(spark, ranks, scale):
    documents = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet")
    count = token_counter(spark, ranks)
    total = documents.select(count(F.col("text")).alias("n")).agg(F.sum("n")).first()[0]
    assert total == GOLDEN[scale]


@pytest.mark.parametrize("kind", ["tiktoken", "json"])
def test_end_of_text_is_one_token_unless_read_as_text(spark, column, ranks, kind):
    vocabulary = ranks.removesuffix("tiktoken") + kind
    values = ["a <|endoftext|> b", "", None]
    assert column(token_counter(spark, vocabulary), values) == [4, 0, None]
    as_text = token_counter(spark, vocabulary, special_as_text=True)
    assert column(as_text, values) == [9, 0, None]


def test_both_vocabulary_kinds_agree_on_odd_texts(spark, column, ranks):
    generator = random.Random(7)
    alphabet = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000] + list("😀👩‍👩‍👧") * 50
    plain = list("  \n\t'sre lldvmt19_-aé 　\u0085")
    values = ["a b　c", "👩‍👩‍👧‍👦", " " * 5000 + "x", "=" * 5000, "\n" * 999]
    values += ["".join(generator.choice(generator.choice([alphabet, plain])) for _ in range(80))
               for _ in range(300)]
    fast = column(token_counter(spark, ranks), values)
    assert fast == column(token_counter(spark, ranks.removesuffix("tiktoken") + "json"), values)


def test_pre_tokens_never_exceed_tokens(spark, ranks):
    count = token_counter(spark, ranks)
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    both = documents.select(pre_token_count(F.col("text")).alias("low"),
                            count(F.col("text")).alias("n"))
    assert both.filter("low > n OR low = 0").count() == 0


def test_total_does_not_depend_on_batches(spark, ranks):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        documents = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
        counted = documents.select(token_counter(spark, ranks)(F.col("text")).alias("n"))
        assert counted.agg(F.sum("n")).first()[0] == GOLDEN["sf0.001"]
    finally:
        spark.conf.set(key, before)


def test_vocabulary_size_is_checked(spark, tmp_path):
    empty = tmp_path / "none.tiktoken"
    empty.write_bytes(b"")
    with pytest.raises(ValueError):
        token_counter(spark, str(empty))


def test_merges_follow_the_ranks(spark, column, tmp_path):
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"abc"]
    ranked = tmp_path / "small.tiktoken"
    ranked.write_text("\n".join(f"{base64.b64encode(t).decode()} {i}"
                                for i, t in enumerate(tokens)))
    assert column(token_counter(spark, str(ranked)), ["abc", "ab", "abcd", "xyz"]) == [1, 1, 2, 3]
