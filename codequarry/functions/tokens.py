"""GPT-2 token counts through Arrow batches, and their native lower bound."""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from codequarry.schemas import END_OF_TEXT, END_OF_TEXT_ID

_MAX_VOCABULARY_BYTES = 64 << 20

# Fixed value: the pattern that splits text before the merges.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def pre_token_count(text: Column) -> Column:
    """Number of pre-tokens, never above the token count; runs inside the JVM."""
    return F.regexp_count(text, F.lit("(?U)" + PRE_TOKENS))


def token_counter(
    spark: SparkSession, vocabulary: str, *, special_as_text: bool = False
) -> Callable[[Column], Column]:
    """A function from a text column to its token count (LONG).

    ``vocabulary`` is a byte-level BPE file: merge ranks (``.tiktoken``) or a tokenizer definition
    (``.json``).  Both count alike; ranks are several times faster.  The file is read once on the
    driver and broadcast, so the path need not exist on the executors.  The end-of-text marker
    counts as one token unless ``special_as_text``.  A text the tokenizer refuses yields NULL.
    """
    kind = "json" if vocabulary.endswith(".json") else "ranks"
    shipped = spark.sparkContext.broadcast(_read_bounded(spark, vocabulary))

    @F.arrow_udf("long")
    def count_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = _load(kind, shipped.value, special_as_text)
        for texts in batches:
            yield pa.array([_count_or_none(count, text.as_py()) for text in texts], pa.int64())

    # Deterministic in fact; marked otherwise so that a filter on the count is not pushed below
    # the projection, where the counting would run a second time.
    return count_tokens.asNondeterministic()


def _read_bounded(spark: SparkSession, path: str) -> bytes:
    if os.path.exists(path):
        with open(path, "rb") as file:
            content = file.read(_MAX_VOCABULARY_BYTES + 1)
    else:
        found = spark.read.format("binaryFile").load(path)
        found = found.filter(F.col("length") <= _MAX_VOCABULARY_BYTES).select("content").first()
        content = bytes(found[0]) if found else b""
    if not 0 < len(content) <= _MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: vocabulary is empty or above {_MAX_VOCABULARY_BYTES} bytes")
    return content


@functools.lru_cache(maxsize=4)
def _load(kind: str, content: bytes, special_as_text: bool) -> Callable[[str], int]:
    """Kept per worker process, so reused workers load a vocabulary once."""
    if kind == "json":
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(content)
        tokenizer.encode_special_tokens = special_as_text
        return lambda text: len(tokenizer.encode(text, add_special_tokens=False))
    import tiktoken

    ranks = {}
    for line in content.splitlines():
        if line:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    encoding = tiktoken.Encoding(
        "byte_bpe",
        pat_str=PRE_TOKENS,
        mergeable_ranks=ranks,
        special_tokens={END_OF_TEXT: END_OF_TEXT_ID},
    )
    if special_as_text:
        return lambda text: len(encoding.encode_ordinary(text))
    return lambda text: len(encoding.encode(text, allowed_special="all"))


def _count_or_none(count: Callable[[str], int], text: str | None) -> int | None:
    """NULL for what encoders refuse: text that is no valid Unicode, or that a definition without an
    unknown token has no token for.  Other errors are not the text's."""
    if text is None:
        return None
    try:
        return count(text)
    except (UnicodeError, TypeError):
        return None
    except Exception as error:
        # The definition's library has no error class of its own.
        if type(error) is not Exception:
            raise
        return None
