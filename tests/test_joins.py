import pytest
from pyspark.sql import functions as F

from codequarry.operators.guards import EmptyInputError, require_non_empty
from codequarry.operators.joins import fits_broadcast, keep_matching


@pytest.fixture
def rows(spark):
    made = spark.range(3000).withColumn(
        "key", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), "id")))
    return made.withColumn("key", F.when(F.col("id") != 7, F.col("key")))


@pytest.mark.parametrize("max_rows", [10_000, 5])
def test_matches_brute_force_on_both_ways(spark, rows, max_rows):
    wanted = ["hot"] + [f"k{i}" for i in range(0, 3000, 7)] + [None, "absent", "hot"]
    keys = spark.createDataFrame([(w,) for w in wanted], "key string")
    kept = keep_matching(rows, keys, "key", spread=["id"], max_rows=max_rows)
    expected = {r.id for r in rows.collect() if r.key is not None and r.key in set(wanted)}
    found = [r.id for r in kept.collect()]
    assert sorted(found) == sorted(expected)
    assert kept.columns == rows.columns


def test_large_key_sets_are_joined_with_a_salt(spark, rows):
    keys = spark.createDataFrame([("hot",), ("k1",)], "key string")
    salted = keep_matching(rows, keys, "key", spread=["id"], max_rows=1)
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "rightHint=(strategy=broadcast" not in plan
    small = keep_matching(rows, keys, "key", spread=["id"])
    assert "_salt" not in small._jdf.queryExecution().optimizedPlan().toString()
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_bounds_are_checked_on_rows_and_bytes(spark):
    keys = spark.createDataFrame([("x" * 100,)] * 10, "key string")
    assert fits_broadcast(keys)
    assert not fits_broadcast(keys, max_rows=9)
    assert not fits_broadcast(keys, max_bytes=999)
    assert fits_broadcast(keys.limit(0), max_rows=0, max_bytes=0)


def test_guard(spark):
    assert require_non_empty(spark.range(1), "one").count() == 1
    with pytest.raises(EmptyInputError, match="none"):
        require_non_empty(spark.range(0), "none")


@pytest.mark.parametrize("max_rows", [100, 0])
def test_keys_are_evaluated_once(spark, rows, max_rows):
    seen = spark.sparkContext.accumulator(0)

    def counted(value):
        seen.add(1)
        return value

    keys = spark.createDataFrame([("hot",), ("k1",)], "key string").coalesce(1)
    keys = keys.select(F.udf(counted, "string").asNondeterministic()("key").alias("key"))
    kept = keep_matching(rows, keys, "key", spread=["id"], max_rows=max_rows)
    assert kept.count() == 1001 and kept.count() == 1001
    assert seen.value == 2
