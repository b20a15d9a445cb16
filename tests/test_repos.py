import pytest

from codequarry.sources import repos

LINES = ['"a/b"', '"a\\/b"', "3", '{"a":1}', "bad", "", "   ", '"a"', '"a/b/c"', '"/b"', '"a/b"',
         '"a/b" "c/d"', "null", '"é/ü"', '"x.js/y_z"\r']


def write(path):
    path.write_bytes("\n".join(LINES).encode())
    return str(path)


def test_scan_keeps_duplicates_and_quarantines_the_rest(spark, tmp_path):
    parsed = repos.scan_repo_list(spark, write(tmp_path / "repos.jsonl"))
    valid = sorted(row.repo_key for row in repos.valid_repos(parsed).collect())
    assert valid == ["-b", "a-b", "a-b", "a-b", "x.js-y_z", "é-ü"]
    quarantined = sorted(row.raw for row in repos.malformed_repos(parsed).collect())
    assert quarantined == sorted(["3", '{"a":1}', "bad", "a", "a/b/c", '"a/b" "c/d"', "null"])


def test_keys_are_a_set(spark, tmp_path):
    parsed = repos.scan_repo_list(spark, write(tmp_path / "repos.jsonl"))
    keys = sorted(row.repo_key for row in repos.repo_keys(repos.valid_repos(parsed)).collect())
    assert keys == ["-b", "a-b", "x.js-y_z", "é-ü"]


def test_each_line_is_parsed_once(spark, tmp_path):
    parsed = repos.valid_repos(repos.scan_repo_list(spark, write(tmp_path / "repos.jsonl")))
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


@pytest.mark.parametrize("tail", ['] junk', '],["c/d"', ',', ',"c/d"', '"', ' x', ']', ',1]', '],1'])
def test_text_after_the_value_makes_a_line_malformed(spark, tail):
    lines = spark.createDataFrame([('"a/b"' + tail,), ('"c/d" ',)], "value string")
    found = {r.raw: r.is_malformed for r in repos.parse_repos(lines).collect()}
    assert found == {'"a/b"' + tail: True, "c/d": False}
