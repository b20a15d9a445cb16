from codequarry.operators import fetch
from codequarry.sources import repos


def parsed(spark, *listed):
    lines = spark.createDataFrame([(f'"{r}"',) for r in listed], "value string")
    return repos.valid_repos(repos.parse_repos(lines))


def test_plan_covers_missing_repositories_once_in_branch_order(spark):
    stored = spark.createDataFrame([("u-have",), ("u-other",)], "stem string")
    plan = fetch.fetch_plan(parsed(spark, "u/have", "u/new_x", "u/new_x"), stored, "/zip")
    rows = sorted(plan.collect(), key=lambda r: r.priority)
    base = "https://github.com/u/new_x/archive/refs/heads/"
    assert [tuple(r) for r in rows] == [
        ("u-new_x", 1, "main", base + "main.zip", "/zip/u-new_x.zip"),
        ("u-new_x", 2, "master", base + "master.zip", "/zip/u-new_x.zip"),
    ]


def test_first_success_gives_the_branch_of_least_priority(spark):
    results = [("u", "a", 1, "trunk", True), ("u", "a", 2, "master", True), ("u", "b", 1, "main", False),
               ("u", "b", 3, "dev", True), ("u", "c", 1, "main", False), ("u", "c", 2, "master", False)]
    rows = spark.createDataFrame(results, "user string, name string, priority int, "
                                          "branch string, succeeded boolean")
    found = sorted(tuple(r) for r in fetch.first_success(rows).collect())
    assert found == [("u", "a", "trunk"), ("u", "b", "dev")]


def test_reconcile(spark):
    schema = "path string, content binary"
    fetched = spark.createDataFrame([("a", b"1"), ("b", b"2"), ("c", b"")], schema)
    stored = spark.createDataFrame([("a", b"1"), ("b", b"3"), ("d", b"4")], schema)
    found = dict(fetch.reconcile_archives(fetched, stored).collect())
    assert found == {"a": "unchanged", "b": "changed", "c": "new"}
