import json
import random

import pytest

from codequarry.schemas import RECORD_COLUMNS
from codequarry.sinks.records import write_records
from codequarry.sources import records

GOOD = {"text": "fn main() {}", "id": "test-id", "file_extension": ".rs",
        "category": "programming", "path": "test.rs", "size_in_bytes": 13,
        "file_name": "test.rs", "tokens": 5}


def line(**changes):
    row = GOOD | changes
    return json.dumps({k: v for k, v in row.items() if v is not ...})


BAD = [
    "", "   ", "{", "null", "[1]", '"text"', "5",
    line()[:-1],
    line() + " x",
    line() + line(),
    line(path=...),
    line(text=None),
    line(text=5),
    line(tokens="5"),
    line(tokens=5.0),
    line(tokens=-1),
    line(tokens=True),
    line(size_in_bytes=2**64),
    line(id=["a"]),
    "{'text': 'single quotes'}",
    line()[:-1] + ', "id": "twice"}',
]
KEPT = [line(), line(extra={"text": 1}), line(text=""), line(text="é\n  \\ \""),
        "  " + line(id="spaced") + " \r"]


def scanned(spark, path, content, **options):
    (path / "u-r.jsonl").write_bytes(content)
    return records.parse_record_lines(records.scan_record_lines(spark, str(path), **options))


def test_good_and_bad_lines(spark, tmp_path):
    parsed = scanned(spark, tmp_path, "\n".join(BAD + KEPT).encode())
    good = records.valid_records(parsed)
    assert set(good.columns) == {*RECORD_COLUMNS, "repo"}
    assert sorted(r.text for r in good.collect()) == sorted(json.loads(k)["text"] for k in KEPT)
    assert {r.repo for r in good.collect()} == {"u-r"}
    quarantined = records.malformed_records(parsed)
    assert sorted(r.raw for r in quarantined.collect()) == sorted(BAD)


def test_count_does_not_depend_on_the_columns_read(spark, tmp_path):
    good = records.valid_records(scanned(spark, tmp_path, "\n".join(BAD + KEPT).encode()))
    assert good.count() == len(good.select("id").collect()) == len(good.collect()) == len(KEPT)


def test_invalid_utf8_is_quarantined(spark, tmp_path):
    content = line().encode() + b"\n" + line(text="@").encode().replace(b"@", b"\xff")
    parsed = scanned(spark, tmp_path, content)
    assert records.valid_records(parsed).count() == 1
    assert records.malformed_records(parsed).count() == 1


def test_bracket_tricks_are_no_records(spark, tmp_path):
    parsed = scanned(spark, tmp_path, f"{line()},{line()}\n{line()},\n".encode())
    assert records.valid_records(parsed).count() == 0


@pytest.mark.parametrize("stem", ["u-r x+y%20z", "é-ü.js", "a_b", "007", "u-r#1"])
def test_repo_comes_from_the_file_name(spark, tmp_path, stem):
    (tmp_path / f"{stem}.jsonl").write_text(line())
    (tmp_path / "other.json").write_text(line())
    for nested in ("a=1", "b=2", "c"):
        (tmp_path / nested).mkdir()
        (tmp_path / nested / "x.jsonl").write_text(line())
    lines = records.scan_record_lines(spark, str(tmp_path))
    assert [r.repo for r in lines.collect()] == [stem]


def frame(spark, rows):
    from codequarry.schemas import RECORD

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RECORD.fields)
    listed = [tuple((GOOD | r)[n] for n in RECORD_COLUMNS) + (r["repo"],) for r in rows]
    return spark.createDataFrame(listed, schema + ", repo string")


ROWS = [{"id": str(i), "repo": repo, "text": f"t{i}\n\t\u0001é"}
        for i, repo in enumerate(["007", "u-r", "u-r", "a=b/c", "u-r x%+"])]


def as_set(rows):
    return {(r.id, r.repo, r.text, r.tokens) for r in rows.collect()}


@pytest.mark.parametrize("cluster", [False, True])
@pytest.mark.parametrize("buckets,layout", [(None, "repo"), (3, "bucket")])
def test_round_trip(spark, tmp_path, cluster, buckets, layout):
    target = str(tmp_path / "out")
    made = frame(spark, ROWS)
    write_records(made, target, cluster=cluster, buckets=buckets)
    lines = records.scan_record_lines(spark, target, layout=layout)
    back = records.valid_records(records.parse_record_lines(lines))
    assert as_set(back) == as_set(made)


@pytest.mark.parametrize("buckets", [None, 3])
def test_parquet_round_trip(spark, tmp_path, buckets):
    target = str(tmp_path / "out")
    made = frame(spark, ROWS)
    write_records(made, target, buckets=buckets, fmt="parquet")
    assert as_set(records.scan_record_table(spark, target)) == as_set(made)


def test_field_order_of_written_lines(spark, tmp_path):
    write_records(frame(spark, ROWS[:1]), str(tmp_path / "out"))
    written = next((tmp_path / "out" / "repo=007").glob("*.json")).read_text()
    assert list(json.loads(written)) == RECORD_COLUMNS


def test_overwrite_replaces_all_or_only_written_repos(spark, tmp_path):
    target = str(tmp_path / "out")

    def written():
        lines = records.scan_record_lines(spark, target, layout="repo")
        return {(r.repo, json.loads(r.value)["id"]) for r in lines.collect()}

    write_records(frame(spark, [{"id": "1", "repo": "a"}, {"id": "2", "repo": "b"}]), target)
    write_records(frame(spark, [{"id": "3", "repo": "a"}]), target, keep_other_repos=True)
    assert written() == {("a", "3"), ("b", "2")}
    write_records(frame(spark, [{"id": "4", "repo": "a"}]), target)
    assert written() == {("a", "4")}


def test_clustered_write_splits_a_hot_repository_and_gathers_the_others(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    rows = [{"id": str(i), "repo": "hot" if i % 3 else f"r{i % 40}",
             "text": random.Random(i).randbytes(300).hex()} for i in range(6000)]
    made = frame(spark, rows).repartition(16)
    spark.conf.set(key, "400k")
    try:
        write_records(made, str(tmp_path / "out"), cluster=True)
    finally:
        spark.conf.set(key, before)
    files = {d.name: len(list(d.glob("part-*"))) for d in (tmp_path / "out").glob("repo=*")}
    assert files["repo=hot"] > 1
    # Of the others only those in the hot one's shuffle partition may be split along with it.
    assert sum(count == 1 for count in files.values()) > len(files) / 2
    lines = records.scan_record_lines(spark, str(tmp_path / "out"), layout="repo")
    assert as_set(records.valid_records(records.parse_record_lines(lines))) == as_set(made)


def test_very_long_text(spark, tmp_path):
    long = line(text="é\n" * 10_000_000)
    parsed = scanned(spark, tmp_path, f"{long}\n{line()}\n".encode())
    found = records.valid_records(parsed).selectExpr("char_length(text) AS n").collect()
    assert sorted(r.n for r in found) == [12, 20_000_000]


@pytest.mark.parametrize("tail", ["] junk", "],[", ",", "],{}", " {}", "]", ",1]"])
def test_text_after_the_record_makes_a_line_malformed(spark, tail):
    import json

    record = {"text": "a", "id": "1", "file_extension": ".py", "category": "c", "path": "p",
              "size_in_bytes": 1, "file_name": "f", "tokens": 1}
    lines = spark.createDataFrame([(json.dumps(record) + tail,), (json.dumps(record),)], "value string")
    parsed = records.parse_record_lines(lines)
    assert records.valid_records(parsed).count() == 1 and records.malformed_records(parsed).count() == 1
