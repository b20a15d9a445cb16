import hashlib
import zipfile

import pytest

from codequarry.operators import joins
from codequarry.operators.stats import corpus_stats
from codequarry.plans import corpus
from codequarry.schemas import RECORD_COLUMNS
from codequarry.sinks.records import write_records
from codequarry.sources import records as record_source
from codequarry.sources import repos

FILES = {
    "u-r": [("r-main/", b""), ("r-main/a.py", b"\n print(1) \n"), ("r-main/b.tar.gz", b"\xff\xfe"),
            ("r-main/.github/x.yml", b"on: push"), ("r-main/e.py", b""),
            ("r-main/c.h", b"a <|endoftext|> b")],
    "u-r_x": [("r_x-main/copy.py", b"print(1)"), ("r_x-main/d.md", b"# d")],
    "v-s": [("s-main/z.py", b"zzz")],
}


@pytest.fixture
def folder(tmp_path):
    for stem, members in FILES.items():
        with zipfile.ZipFile(tmp_path / f"{stem}.zip", "w") as out:
            for name, data in members:
                out.writestr(zipfile.ZipInfo(name), data)
    (tmp_path / "u-bad.zip").write_bytes(b"no zip")
    return str(tmp_path)


def listed(spark, *names):
    lines = spark.createDataFrame([(f'"{n}"',) for n in names], "value string")
    return repos.valid_repos(repos.parse_repos(lines))


def paths(rows):
    return sorted(row.path for row in rows.collect())


def test_records(spark, folder, ranks):
    made = corpus.extract(spark, listed(spark, "u/r", "u/bad"), folder, vocabulary=ranks)
    assert made.columns == [*RECORD_COLUMNS, "repo"]
    rows = {row.path: row for row in made.collect()}
    assert sorted(rows) == ["r-main/.github/x.yml", "r-main/a.py", "r-main/c.h", "r-main/e.py"]
    row = rows["r-main/a.py"]
    key = hashlib.sha256(b"u-r\0r-main/a.py\0" + b"1").hexdigest()
    assert tuple(row) == ("print(1)", key, ".py", "programming", "r-main/a.py", 12, "a.py", 4,
                          "u-r")
    assert rows["r-main/.github/x.yml"].file_extension == ".github/x.yml"
    assert (rows["r-main/e.py"].text, rows["r-main/e.py"].tokens) == ("", 0)
    assert rows["r-main/c.h"].tokens == 4


def test_archives_read_through_spark_give_the_same_records(spark, folder, ranks):
    keys = listed(spark, "u/r", "u/r_x", "u/bad")
    opened = corpus.extract(spark, keys, folder, vocabulary=ranks)
    through = corpus.extract(spark, keys, folder, vocabulary=ranks, through_spark=True)
    assert set(map(tuple, through.collect())) == set(map(tuple, opened.collect()))


def test_options(spark, folder, ranks):
    keys = listed(spark, "u/r")
    made = corpus.extract(spark, keys, folder, vocabulary=ranks, special_as_text=True,
                          extension="last_dot", record_id="uuid", max_file_size=17)
    rows = {row.path: row for row in made.collect()}
    assert rows["r-main/c.h"].tokens == 9
    assert rows["r-main/.github/x.yml"].file_extension == ".yml"
    assert len({row.id for row in rows.values()}) == len(rows) == 4
    assert all(len(row.id) == 36 for row in rows.values())
    small = corpus.extract(spark, keys, folder, vocabulary=ranks, max_file_size=11)
    assert paths(small) == ["r-main/.github/x.yml", "r-main/e.py"]
    for wrong in ({"extension": "x"}, {"record_id": "x"}, {"match": "x"}, {"languages": keys}):
        with pytest.raises(ValueError):
            corpus.extract(spark, keys, folder, vocabulary=ranks, **wrong)


def test_prefix_match_admits_suffixed_archives(spark, folder, ranks):
    keys = listed(spark, "u/r")
    exact = corpus.extract(spark, keys, folder, vocabulary=ranks)
    assert {row.repo for row in exact.collect()} == {"u-r"}
    prefix = corpus.extract(spark, keys, folder, vocabulary=ranks, match="prefix")
    assert {row.repo for row in prefix.collect()} == {"u-r", "u-r_x"}


def test_language_filter(spark, folder, ranks, monkeypatch):
    catalog = spark.createDataFrame(
        [("Python", "programming", [".py"]), ("C", "programming", [".c", ".h"]),
         ("Markdown", "prose", [".md"])], "language string, type string, extensions array<string>")

    def run(*wanted):
        languages = spark.createDataFrame([(w,) for w in wanted], "language string")
        return paths(corpus.extract(spark, listed(spark, "u/r", "u/r_x"), folder,
                                    vocabulary=ranks, languages=languages, catalog=catalog))

    assert run("Markdown", "C") == ["r-main/c.h", "r_x-main/d.md"]
    with monkeypatch.context() as patch:
        patch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
        assert run("Markdown", "C") == ["r-main/c.h", "r_x-main/d.md"]
    assert run("Cobol") == ["r-main/a.py", "r-main/c.h", "r-main/e.py", "r_x-main/copy.py"]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_extract_write_dedupe_stats(spark, folder, ranks, tmp_path, fmt):
    keys = listed(spark, "u/r", "u/r_x", "v/s")
    target = str(tmp_path / "records")
    write_records(corpus.extract(spark, keys, folder, vocabulary=ranks), target, fmt=fmt)
    layout = "repo" if fmt == "json" else "parquet"
    whole = corpus.dedupe(spark, None, target, layout=layout)
    assert whole.count() == 6
    assert len({row.text for row in whole.collect()}) == 6
    some = corpus.dedupe(spark, listed(spark, "u/r_x", "v/s"), target, layout=layout)
    assert paths(some) == ["r_x-main/copy.py", "r_x-main/d.md", "s-main/z.py"]
    kept = str(tmp_path / "kept")
    write_records(whole, kept, cluster=True, fmt=fmt)
    back = corpus.read_corpus(spark, kept, layout=layout)
    total = corpus_stats(back).filter("repo IS NULL").first()
    assert (total.records, total.tokens) == (6, sum(r.tokens for r in whole.collect()))


def test_tokens_may_be_counted_after_the_dedup(spark, folder, ranks, tmp_path):
    keys = listed(spark, "u/r", "u/r_x", "v/s")
    first, late = str(tmp_path / "first"), str(tmp_path / "late")
    write_records(corpus.extract(spark, keys, folder, vocabulary=ranks), first)
    bare = corpus.extract(spark, keys, folder, vocabulary=None)
    assert bare.columns == [c for c in RECORD_COLUMNS if c != "tokens"] + ["repo"]
    write_records(bare, late, fmt="parquet")
    counted = corpus.add_tokens(corpus.dedupe(spark, keys, late, layout="parquet"), ranks)
    expected = corpus.dedupe(spark, keys, first, layout="repo")
    assert counted.columns == expected.columns
    assert set(map(tuple, counted.collect())) == set(map(tuple, expected.collect()))


@pytest.mark.parametrize("split_bytes", [None, 300])
def test_unique_extraction_equals_extract_write_dedupe(spark, folder, ranks, tmp_path, split_bytes):
    keys = listed(spark, "u/r", "u/r_x", "v/s", "u/bad")
    catalog = spark.createDataFrame([("Python", "programming", [".py"])],
                                    "language string, type string, extensions array<string>")
    python = spark.createDataFrame([("Python",)], "language string")
    options = {"vocabulary": ranks} | ({"split_bytes": split_bytes} if split_bytes else {})
    for number, chosen in enumerate(({}, {"languages": python, "catalog": catalog})):
        target = str(tmp_path / f"records{number}")
        write_records(corpus.extract(spark, keys, folder, **options, **chosen), target)
        expected = corpus.dedupe(spark, keys, target, layout="repo")
        unique = corpus.extract_unique(spark, keys, folder, **options, **chosen)
        assert unique.columns == expected.columns
        rows = list(map(tuple, unique.collect()))
        assert len(rows) == len(set(rows)) == (6 - 3 * number)
        assert set(rows) == set(map(tuple, expected.collect()))


def test_flat_files_of_another_writer(spark, tmp_path):
    template = ('{"text":"%s","id":"%s","file_extension":".py","category":"programming",'
                '"path":"p","size_in_bytes":1,"file_name":"f","tokens":1}\n')
    (tmp_path / "u-a.jsonl").write_text(template % ("same", "2") + "broken\n")
    (tmp_path / "u-b.jsonl").write_text(template % ("same", "1") + template % ("own", "3"))
    (tmp_path / "u-c.jsonl").write_text(template % ("unlisted", "4"))
    kept = corpus.dedupe(spark, listed(spark, "u/a", "u/b"), str(tmp_path))
    assert sorted((r.id, r.repo) for r in kept.collect()) == [("1", "u-b"), ("3", "u-b")]
    (tmp_path / "u-a_v2.jsonl").write_text(template % ("more", "5"))
    exact = corpus.read_corpus(spark, str(tmp_path), listed(spark, "u/a"))
    assert [r.id for r in exact.collect()] == ["2"]
    prefix = corpus.read_corpus(spark, str(tmp_path), listed(spark, "u/a"), match="prefix")
    assert sorted(r.id for r in prefix.collect()) == ["2", "5"]


def test_unique_extraction_with_an_account(spark, folder, ranks):
    keys = listed(spark, "u/r", "u/r_x", "v/s", "u/bad")
    rows = corpus.extract_unique(spark, keys, folder, vocabulary=ranks, with_errors=True)
    bare = corpus.extract_unique(spark, keys, folder, vocabulary=ranks)
    assert set(map(tuple, corpus.accepted(rows).collect())) == set(map(tuple, bare.collect()))
    found = {(r.repo, r.path, r.error) for r in corpus.rejected(rows).collect()}
    assert ("u-r", "r-main/b.tar.gz", "not UTF-8 text") in found and len(found) == 2
    assert next(e for repo, _, e in found if repo == "u-bad").startswith("BadZipFile")


def test_unique_extraction_lists_each_archive_twice(spark, folder, ranks):
    keys = listed(spark, "u/r", "u/r_x", "v/s", "u/bad")
    rows = corpus.extract_unique(spark, keys, folder, vocabulary=ranks, with_errors=True)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # The first pass has run: what is left is one more listing, the hashes and the account.
    assert plan.count("MapInArrow listing") == 1
    assert "SortAggregate" not in plan


def test_refused_texts_are_named(spark, folder):
    import workload

    keys = listed(spark, "u/r", "u/r_x")
    vocabulary = workload.refusing_vocabulary()
    rows = corpus.extract(spark, keys, folder, vocabulary=vocabulary, with_errors=True)
    assert all(r.error != "refused by the tokenizer" for r in rows.collect())
    with zipfile.ZipFile(f"{folder}/u-r.zip", "a") as out:
        out.writestr("r-main/ü.py", "für")
        out.writestr("r-main/v.py", "für")
    for run, names in ((corpus.extract, ["r-main/v.py", "r-main/ü.py"]), (corpus.extract_unique, None)):
        rows = run(spark, keys, folder, vocabulary=vocabulary, with_errors=True).collect()
        refused = sorted(r.path for r in rows if r.error == "refused by the tokenizer")
        assert refused == names or names is None and len(refused) == 1
        assert all(r.tokens is None for r in rows if r.error)
    plain = corpus.extract(spark, keys, folder, vocabulary=vocabulary)
    assert not {"r-main/ü.py", "r-main/v.py"} & set(paths(plain))


def test_contents_are_read_after_the_match(spark, folder, ranks):
    from codequarry.sources import archives

    listing = archives.list_archives(spark, folder)
    matched = archives.match_archives(listing, listed(spark, "u/r", "v/s"))
    held, too_large = archives.read_contents(matched)
    assert sorted(r.stem for r in held.collect()) == ["u-r", "v-s"] and too_large.count() == 0
    assert "Exchange" not in held._jdf.queryExecution().executedPlan().toString()
    assert len(held.inputFiles()) == 2
    sizes = {r.stem: r.length for r in matched.collect()}
    held, too_large = archives.read_contents(matched, max_bytes=sizes["v-s"])
    assert [r.stem for r in held.collect()] == ["v-s"]
    assert [(r.repo, r.error) for r in too_large.collect()] == [("u-r", "archive above the size of a cell")]
    nothing, _ = archives.read_contents(matched, max_bytes=0)
    assert nothing.count() == 0
    plan = corpus.extract(spark, listed(spark, "u/r"), folder, vocabulary=None, through_spark=True)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_large_archives_through_spark_are_errors(spark, folder, monkeypatch):
    from codequarry.sources import archives

    monkeypatch.setattr(archives.read_contents, "__defaults__", (0,))
    rows = corpus.extract(spark, listed(spark, "u/r"), folder, vocabulary=None, through_spark=True, with_errors=True)
    assert [(r.repo, r.error) for r in corpus.rejected(rows).collect()] == [("u-r", "archive above the size of a cell")]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_only_listed_folders_are_in_the_scan(spark, folder, ranks, tmp_path, fmt):
    keys = listed(spark, "u/r", "u/r_x", "v/s")
    target = str(tmp_path / "records")
    write_records(corpus.extract(spark, keys, folder, vocabulary=ranks), target, fmt=fmt)
    layout = "repo" if fmt == "json" else "parquet"
    # More keys than a broadcast takes would be pruned alike: none is broadcast or joined with rows.
    many = listed(spark, "u/r_x", *[f"no/{i}" for i in range(50)])
    rows = corpus.read_corpus(spark, target, many, layout=layout)
    assert paths(rows) == ["r_x-main/copy.py", "r_x-main/d.md"]
    assert rows.inputFiles() and all("repo=u-r_x/" in file for file in rows.inputFiles())
    assert "Join" not in rows._jdf.queryExecution().executedPlan().toString()
    prefix = corpus.read_corpus(spark, target, listed(spark, "u/r"), layout=layout, match="prefix")
    assert {r.repo for r in prefix.collect()} == {"u-r", "u-r_x"}
    assert corpus.read_corpus(spark, target, listed(spark, "no/one"), layout=layout).count() == 0


@pytest.mark.parametrize("buckets", [None, 2])
def test_parquet_folders_are_listed_once(spark, folder, ranks, tmp_path, monkeypatch, buckets):
    keys = listed(spark, "u/r", "u/r_x", "v/s")
    target = str(tmp_path / "records")
    write_records(corpus.extract(spark, keys, folder, vocabulary=ranks), target, fmt="parquet", buckets=buckets)
    calls, listing = [], record_source.list_leaf_folders

    def counted(*args):
        calls.append(args)
        return listing(*args)

    monkeypatch.setattr(record_source, "list_leaf_folders", counted)
    rows = corpus.read_corpus(spark, target, listed(spark, "v/s"), layout="parquet")
    assert paths(rows) == ["s-main/z.py"]
    assert len(calls) == 1


def test_bucket_folders_are_filtered_by_row(spark, folder, ranks, tmp_path):
    keys = listed(spark, "u/r", "u/r_x", "v/s")
    for fmt, layout in (("json", "bucket"), ("parquet", "parquet")):
        target = str(tmp_path / fmt)
        write_records(corpus.extract(spark, keys, folder, vocabulary=ranks), target, fmt=fmt, buckets=2)
        rows = corpus.read_corpus(spark, target, listed(spark, "v/s"), layout=layout)
        assert paths(rows) == ["s-main/z.py"]


@pytest.mark.parametrize("run", ["extract", "dedupe"])
def test_guards_raise_after_the_write(spark, folder, ranks, tmp_path, run):
    from codequarry.operators.guards import EmptyInputError, RowGuard

    source, target = str(tmp_path / "records"), str(tmp_path / "kept")
    write_records(corpus.extract(spark, listed(spark, "u/r"), folder, vocabulary=ranks), source)

    def records(names, guard):
        keys = listed(spark, *names) if names else spark.createDataFrame([], "repo_key string")
        if run == "extract":
            return corpus.extract(spark, keys, folder, vocabulary=ranks, guard=guard)
        return corpus.dedupe(spark, keys, source, layout="repo", guard=guard)

    guard = RowGuard("records")
    write_records(records(["u/r"], guard), target, guard=guard)
    for names in ([], ["no/one"]):
        guard = RowGuard("no records")
        with pytest.raises(EmptyInputError, match="no records"):
            write_records(records(names, guard), target, guard=guard)
    (tmp_path / "empty").mkdir()
    guard = RowGuard("empty folder")
    rows = corpus.extract(spark, listed(spark, "u/r"), str(tmp_path / "empty"), vocabulary=ranks, guard=guard)
    with pytest.raises(EmptyInputError, match="empty folder"):
        write_records(rows, target, guard=guard)


def make_zip(path, members):
    with zipfile.ZipFile(path, "w") as out:
        for name, data in members:
            out.writestr(zipfile.ZipInfo(name), data)


def test_refresh_extracts_what_changed(spark, folder, ranks, tmp_path):
    from codequarry.plans import incremental

    store = str(tmp_path / "store")
    keys = listed(spark, "u/r", "u/r_x", "v/s")

    def refreshed(keys):
        found = incremental.refresh(spark, keys, folder, store, vocabulary=ranks).collect()
        full = corpus.extract(spark, keys, folder, vocabulary=ranks)
        assert set(map(tuple, incremental.stored_records(spark, store).collect())) == set(map(tuple, full.collect()))
        unique = corpus.extract_unique(spark, keys, folder, vocabulary=ranks)
        assert set(map(tuple, incremental.stored_unique(spark, store).collect())) == set(map(tuple, unique.collect()))
        return {r.repo: r.status for r in found}

    assert refreshed(keys) == {"u-r": "new", "u-r_x": "new", "v-s": "new"}
    assert refreshed(keys) == {"u-r": "unchanged", "u-r_x": "unchanged", "v-s": "unchanged"}
    make_zip(f"{folder}/u-r.zip", FILES["u-r"][:1] + [("r-main/d.md", b"# d"), ("r-main/z.py", b"zzz")])
    make_zip(f"{folder}/w-t.zip", [("t/a.py", b"new")])
    wider = listed(spark, "u/r", "u/r_x", "w/t")
    assert refreshed(wider) == {"u-r": "changed", "u-r_x": "unchanged", "v-s": "gone", "w-t": "new"}
    assert len({r.generation for r in incremental.manifest(spark, store)[0].collect()}) == 2
    # Nothing of a changed archive is left, not even where it has no records any more.
    make_zip(f"{folder}/w-t.zip", [("t/a.bin", b"\xff\xfe")])
    assert refreshed(wider)["w-t"] == "changed"


def test_refresh_matches_archives_once(spark, folder, ranks, tmp_path, monkeypatch):
    from codequarry.plans import incremental

    plans, digests = [], incremental.archive_digests

    def seen(archives):
        plans.append(archives._jdf.queryExecution().executedPlan().toString())
        return digests(archives)

    monkeypatch.setattr(incremental, "archive_digests", seen)
    found = incremental.refresh(spark, listed(spark, "u/r", "u/r"), folder, str(tmp_path / "store"), vocabulary=ranks)
    assert [(r.repo, r.status) for r in found.collect()] == [("u-r", "new")]
    # The digests count the archives, then read them: neither time are they matched with the list.
    assert len(plans) == 1 and "Join" not in plans[0]


def test_refresh_that_failed_leaves_the_store(spark, folder, ranks, tmp_path, monkeypatch):
    from codequarry.plans import incremental

    store, keys = str(tmp_path / "store"), listed(spark, "u/r", "v/s")
    incremental.refresh(spark, keys, folder, store, vocabulary=ranks)
    before = set(map(tuple, incremental.stored_records(spark, store).collect()))
    make_zip(f"{folder}/v-s.zip", [("s-main/other.py", b"other")])
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(incremental, "content_hash", lambda _: (_ for _ in ()).throw(RuntimeError()))
        incremental.refresh(spark, keys, folder, store, vocabulary=ranks)
    assert set(map(tuple, incremental.stored_records(spark, store).collect())) == before
    found = incremental.refresh(spark, keys, folder, store, vocabulary=ranks)
    assert {r.repo: r.status for r in found.collect()} == {"u-r": "unchanged", "v-s": "changed"}
    assert "s-main/other.py" in paths(incremental.stored_records(spark, store))
