import json

import pytest

from codequarry.operators import languages
from codequarry.sources.catalog import scan_catalog

CATALOG = [
    {"language": "C", "type": "programming", "extensions": [".c", ".h"]},
    {"language": "C++", "type": "programming", "extensions": [".cpp", ".h"]},
    {"language": "JSON", "type": "data", "extensions": [".json"]},
    {"language": "Markdown", "type": "prose", "extensions": [".md"]},
    {"language": "Bare", "type": "programming"},
    {"language": "Untyped", "extensions": [".un"]},
]


@pytest.fixture
def catalog(spark, tmp_path):
    path = tmp_path / "languages.json"
    path.write_text(json.dumps(CATALOG, indent=2))
    return scan_catalog(spark, str(path))


def requested(spark, *wanted):
    return spark.createDataFrame([(w,) for w in wanted], "language string")


def pairs(rows):
    return sorted(tuple(row) for row in rows.collect())


PROGRAMMING = [(".c", "programming"), (".cpp", "programming"), (".h", "programming")]


def test_programming_extensions(catalog):
    assert pairs(languages.programming_extensions(catalog)) == PROGRAMMING


@pytest.mark.parametrize("wanted,expected", [
    (["JSON", "C"], [(".c", "programming"), (".h", "programming"), (".json", "data")]),
    (["JSON", "Cobol"], [(".json", "data")]),
    (["Cobol"], PROGRAMMING),
    (["Bare", "Untyped"], PROGRAMMING),
    (["json"], PROGRAMMING),
])
def test_requested_languages_or_all_programming(spark, catalog, wanted, expected):
    assert pairs(languages.language_extensions(catalog, requested(spark, *wanted))) == expected


def test_unknown_languages(spark, catalog):
    missing = languages.unknown_languages(catalog, requested(spark, "C", "Cobol", "Bare", "Cobol"))
    assert pairs(missing) == [("Cobol",)]


def test_file_filter_uses_the_last_extension(spark, catalog):
    files = spark.createDataFrame([("a.c",), ("a.c.md",), ("c",), (".h",), ("x.tar.h",), ("a.C",)],
                                  "file_name string")
    kept = languages.keep_languages(files, languages.programming_extensions(catalog))
    assert pairs(kept) == [(".h",), ("a.c",), ("x.tar.h",)]


@pytest.mark.parametrize("content", [
    '{"language": "A", "type": "programming", "extensions": [".a"]}\n\n{"language": "B", "extensions": [".b"]}\n',
    '[{"language": "A", "type": "programming", "extensions": [".a"]},\n {"language": "B", "extensions": [".b"]}]',
    '{"A": {"type": "programming", "extensions": [".a"]},\n "B": {"extensions": [".b"]}}',
])
def test_catalog_shapes(spark, tmp_path, content):
    (tmp_path / "catalog.json").write_text(content)
    found = sorted(map(tuple, scan_catalog(spark, str(tmp_path / "catalog.json")).collect()))
    assert found == [("A", "programming", [".a"]), ("B", None, [".b"])]


def test_a_catalog_without_rows_raises(spark, tmp_path):
    (tmp_path / "catalog.json").write_text("[]")
    with pytest.raises(ValueError):
        scan_catalog(spark, str(tmp_path / "catalog.json"))
