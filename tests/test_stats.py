from codequarry.operators import stats

ROWS = [("r1", "abc", 2), ("r1", "", 0), ("r2", "é漢😀", 5), ("r1", "xyz", 1), ("r1", "q", 1)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "repo string, text string, tokens long")


def test_per_repository_and_total(spark):
    found = {row.repo: tuple(row)[1:] for row in stats.corpus_stats(frame(spark)).collect()}
    assert found == {
        "r1": (1, 4, 4, 4, 7 / 4),
        "r2": (1, 1, 5, 1, 3.0),
        None: (2, 5, 9, 2, 2.0),
    }


def test_files_without_records_count(spark):
    files = spark.createDataFrame([("r1",), ("r2",), ("empty",)], "repo string")
    found = {r.repo: tuple(r)[1:] for r in stats.corpus_stats(frame(spark), files=files).collect()}
    assert found["empty"] == (1, 0, 0, 0, None)
    assert found[None] == (3, 5, 9, 1, 2.0)
    assert found["r1"] == (1, 4, 4, 4, 7 / 4)


def test_no_records(spark):
    assert stats.corpus_stats(frame(spark, [])).count() == 0
    files = spark.createDataFrame([("empty",)], "repo string")
    found = {tuple(row) for row in stats.corpus_stats(frame(spark, []), files=files).collect()}
    assert found == {("empty", 1, 0, 0, 0, None), (None, 1, 0, 0, 0, None)}


def test_counts(spark):
    assert {tuple(r) for r in stats.records_per_repo(frame(spark)).collect()} == {
        ("r1", 4), ("r2", 1)}
    assert stats.total_records(frame(spark)).first().records == 5
