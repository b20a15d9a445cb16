from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codequarry.functions import names


def test_repo_split_needs_exactly_two_parts(column):
    values = ["a/b", "a", "a/b/c", "/b", "a/", "", "https://github.com/a/b", " a/b "]
    assert column(names.is_repo, values) == [True, False, False, True, True, False, False, True]
    assert column(names.repo_user, values) == ["a", None, None, "", "a", None, None, " a"]
    assert column(names.repo_name, values) == ["b", None, None, "b", "", None, None, "b "]


def test_file_stem_cuts_the_last_extension_only(column):
    values = ["u-r.zip", "u-foo.js.zip", ".zip", "plain", "a.", "..zip"]
    assert column(names.file_stem, values) == ["u-r", "u-foo.js", ".zip", "plain", "a", "."]


def test_match_key_and_output_base_cut_at_first_and_last_underscore(column):
    values = ["u-r", "u-r_x", "u-r_x_y", "_x", "x_"]
    assert column(names.match_key, values) == ["u-r", "u-r", "u-r", "", "x"]
    assert column(names.output_base, values) == ["u-r", "u-r", "u-r_x", "", "x"]


def test_first_dot_extension_looks_at_the_whole_path(column):
    values = ["r/a.tar.gz", "r/Makefile", "r.js/src/a.py", "r/.github/x.yml", "r/foo."]
    expected = [".tar.gz", None, ".js/src/a.py", ".github/x.yml", "."]
    assert column(names.first_dot_extension, values) == expected


def test_last_dot_extension_looks_at_the_file_name(column):
    values = ["a.tar.gz", "Makefile", "foo.", ".gitignore", ""]
    expected = [".gz", None, None, ".gitignore", None]
    assert column(names.last_dot_extension, values) == expected


def test_unsafe_paths_are_rejected(column):
    values = ["r/a.c", "/r/a", "r/../../x", "r/../x", "../r/x", "r/a\u0000b", "./a", "a//b/../..",
              "a/../../b/c/d", "..", "a..b/c", ""]
    expected = [True, False, False, True, False, False, True, True, False, False, True, True]
    assert column(names.is_safe_path, values) == expected
    assert column(names.safe_path, values[:2]) == ["r/a.c", None]


def test_file_name_is_the_last_real_component(column):
    values = ["r/a.c", "a", "a/", "a/.", "a/./", "a/..", "./", "", "x/./y//", "a/.b"]
    expected = ["a.c", "a", "a", "a", "a", None, None, None, "y", ".b"]
    assert column(names.path_file_name, values) == expected


def test_urls_and_targets(spark):
    row = spark.range(1).select(
        names.archive_url(F.lit("u"), F.lit("r.js"), F.lit("main")).alias("url"),
        names.archive_target("/data/zip/", F.lit("u"), F.lit("r.js")).alias("target"),
    ).first()
    assert row.url == "https://github.com/u/r.js/archive/refs/heads/main.zip"
    assert row.target == "/data/zip/u-r.js.zip"


def walk(path):
    """(safe, file name) by following the path component by component."""
    depth, safe, last = 0, not path.startswith("/") and "\u0000" not in path, None
    for part in path.split("/"):
        if part in ("", "."):
            continue
        depth += -1 if part == ".." else 1
        safe = safe and depth >= 0
        last = None if part == ".." else part
    return safe, last


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["a", "b.c", "..", ".", "", "...", "é"]), max_size=7)
                .map("/".join), min_size=1, max_size=40))
def test_paths_match_a_walk(column, paths):
    assert column(names.is_safe_path, paths) == [walk(p)[0] for p in paths]
    assert column(names.path_file_name, paths) == [walk(p)[1] for p in paths]
