"""Repository lists: one JSON string ``"user/name"`` per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.functions import names


def with_json(lines: DataFrame, line: Column, *keep: Column | str) -> DataFrame:
    """The ``keep`` columns, ``_json``, an array of the JSON value of ``line`` and a mark, and ``_mark``.

    The parser would ignore what follows a value.  So the value is parsed inside brackets and followed
    by a hash of the line: a line that closes the bracket itself, ends early or goes on after its value
    has something else, or nothing, in the second place.  The parse is the input of a generator so that
    filters on its fields stay above it: pushed below, they would parse every line once more per field.
    """
    mark = F.xxhash64(line)
    marked = F.concat(F.lit("["), line, F.lit(","), mark.cast("string"), F.lit("]"))
    return lines.select(*keep, mark.alias("_mark"), F.explode(F.array(F.try_parse_json(marked))).alias("_json"))


def holds_one_value() -> Column:
    """Whether ``_json`` is one value and the mark, and nothing else."""
    second = F.try_variant_get("_json", "$[1]", "long")
    third = F.try_variant_get("_json", "$[2]", "variant")
    return F.coalesce((second == F.col("_mark")) & third.isNull(), F.lit(False))


def json_field(path: str, kind: str, data_type: str) -> Column:
    """A field of the only value of ``_json``, if its JSON type is ``kind``; else NULL."""
    place = f"$[0]{path}"
    # A cast alone would also accept other types, such as numbers as strings.
    same_kind = F.schema_of_variant(F.try_variant_get("_json", place, "variant")) == kind
    return F.when(holds_one_value() & same_kind, F.try_variant_get("_json", place, data_type))


def parse_repos(lines: DataFrame, column: str = "value") -> DataFrame:
    """Every non-blank line as (raw, user, name, repo_key, is_malformed); duplicates are kept.

    ``raw`` is the JSON string, or the line itself where it holds no JSON string.
    """
    line = F.col(column)
    written = lines.filter(F.btrim(line, F.lit(" \t\r\n")) != "")
    parsed = with_json(written, line, line.alias("_line")).select(
        "_line", json_field("", "STRING", "string").alias("_text")
    )
    text = F.col("_text")
    user, name = names.repo_user(text), names.repo_name(text)
    return parsed.select(
        F.coalesce(text, "_line").alias("raw"),
        user.alias("user"),
        name.alias("name"),
        names.repo_key(user, name).alias("repo_key"),
        (~names.is_repo(text)).alias("is_malformed"),
    )


def scan_repo_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_repos(spark.read.text(path))


def valid_repos(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("is_malformed")).select("user", "name", "repo_key")


def malformed_repos(parsed: DataFrame) -> DataFrame:
    """The quarantine next to ``valid_repos``."""
    return parsed.filter("is_malformed").select("raw")


def repo_keys(repos: DataFrame) -> DataFrame:
    """The list as a set of ``user-name`` keys."""
    return repos.select("repo_key").distinct()
