"""The language catalog as a table of (language, type, extensions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.operators.guards import require_non_empty
from codequarry.schemas import CATALOG
from codequarry.sources.repos import holds_one_value, with_json

# Every shape as an array of (name, value): a map by language, an array of rows, one row, rows by line.
_ROWS = """
    CASE
      WHEN json IS NULL THEN transform(
        filter(split(value, '\\n'), line -> btrim(line, ' \\t\\r') <> ''),
        line -> struct(try_variant_get(try_parse_json(line), '$.language', 'string') AS name, try_parse_json(line) AS row))
      WHEN try_variant_get(json, '$', 'array<variant>') IS NOT NULL THEN transform(
        try_variant_get(json, '$', 'array<variant>'),
        row -> struct(try_variant_get(row, '$.language', 'string') AS name, row AS row))
      WHEN schema_of_variant(try_variant_get(json, '$.language', 'variant')) = 'STRING'
        THEN array(struct(try_variant_get(json, '$.language', 'string') AS name, json AS row))
      ELSE transform(
        map_entries(try_variant_get(json, '$', 'map<string,variant>')),
        entry -> struct(entry.key AS name, entry.value AS row))
    END"""


def scan_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Rows with a language; raises when there is none.

    A file is one JSON object per line, one JSON array of objects (both with a ``language``), or one
    JSON object that maps each language to its ``type`` and ``extensions``.
    """
    files = with_json(spark.read.text(path, wholetext=True), F.col("value"), "value")
    whole = F.when(holds_one_value(), F.try_variant_get("_json", "$[0]", "variant"))
    parsed = files.select("value", F.explode(F.array(whole)).alias("json"))
    rows = parsed.select(F.explode(F.expr(_ROWS)).alias("r")).select(
        F.col("r.name").alias("language"),
        F.try_variant_get("r.row", "$.type", "string").alias("type"),
        F.try_variant_get("r.row", "$.extensions", "array<string>").alias("extensions"),
    )
    named = rows.filter("language is not null").select(*CATALOG.fieldNames())
    return require_non_empty(named, f"language catalog {path}")
