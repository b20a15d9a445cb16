"""The pipeline's stages one by one on a small table with planted cases."""

import random

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from codequarry.llm import simhash
from codequarry.llm.common import materialize

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(9)
    letters = {"en": "etaoinshrdlu", "de": "enisratdhulc"}
    words = {lang: ["".join(rnd.choice(own) for _ in range(rnd.randint(3, 8))) for _ in range(400)] for lang, own in letters.items()}
    text = lambda lang, n: " ".join(rnd.choice(words[lang]) for _ in range(n))
    rows = [(i, text("en" if i % 2 else "de", 150), "en" if i % 2 else "de") for i in range(60)]
    passage = text("en", 60)
    rows += [(100, None, "en"), (101, "12 34", "en"), (102, rows[3][1], "en"), (103, rows[3][1] + " end", "en")]
    rows += [(104, f"{passage} {text('en', 40)}", None), (105, f"{text('en', 40)} {passage}", "en")]
    rows += [(106, text("en", 60) + " password=abcdefgh12345 " + text("en", 60), "en"), (None, text("en", 90), "en")]
    # An unlearned language, gibberish of seldom letters, and one of the learned ones without a label.
    rows += [(110, "это текст на другом языке", None), (111, "xqzv wkjp qqzx zzxw vbvm", None), (112, text("de", 30), None)]
    return spark.createDataFrame([(i, t, lang, "s", len(t) if t else None) for i, t, lang in rows], SCHEMA)


def test_stages(spark, planted):
    docs, seen = planted, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, ""), "test-stage")
        seen[name] = docs
        if name != "packing":
            assert docs.dtypes == before.dtypes
    ids = {name: {r.doc_id for r in table.collect()} for name, table in seen.items()}
    everything = {r.doc_id for r in planted.collect()}
    assert ids["language_id"] == everything - {100, 101, 110, 111}
    linked = simhash.components(seen["language_id"]).filter("not doc_id <=> component_id").collect()
    assert {102} <= {r.doc_id for r in linked} <= {102, 103}
    assert ids["near_dedup"] == ids["language_id"] - {r.doc_id for r in linked}
    assert ids["passage_dedup"] == ids["near_dedup"] == ids["secret_removal"] == ids["packing"]
    texts = {r.doc_id: r for r in seen["secret_removal"].collect()}
    assert "password" not in texts[106].text and "[secret]" in texts[106].text
    assert texts[104].lang in ("en", "de") and len(texts[105].text.split()) == 40
    assert all(r.n_chars == len(r.text) for r in texts.values())


def test_empty_table(spark, planted):
    docs = planted.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, ""), "test-empty")
    assert docs.count() == 0


def test_passage_dedup_keeps_null_and_untouched_texts(spark):
    rnd = random.Random(1)
    words = lambda n: " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(n))
    passage, odd = words(60), "  two  spaces\n" + words(60)
    long = words(30_000)
    rows = [(1, None), (2, ""), (3, odd), (4, f"{words(5)} {passage}"), (5, f"{passage} {words(3)}"), (6, passage), (None, None), (7, long), (8, long)]
    table = [(i, t, "en", "s", len(t) if t else None, "kept", "carried") for i, t in [*rows, rows[2]]]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long, kept string, carried string")
    found = corpus_pipeline.passage_dedup(spark, docs, "")
    assert found.dtypes == docs.dtypes
    texts = sorted(((r.doc_id, r.text) for r in found.collect()), key=repr)
    last = (5, " ".join(rows[4][1].split()[60:]))
    assert texts == sorted([*rows[:4], last, rows[6], rows[7], rows[2]], key=repr)
    assert all((r.kept, r.carried) == ("kept", "carried") for r in found.collect())


def test_registered():
    found = driver.queries()
    assert {f"op{n}_" for n in range(1, 14)} <= {name[: name.index("_") + 1] for name in found if name.startswith("op")}
    assert found["pipeline"] is corpus_pipeline.run
    assert set(driver.oracle_sql()) <= set(found)


def test_near_dedup_takes_the_fingerprints_of_the_query(spark, planted):
    docs = planted.unionByName(planted.filter("doc_id in (3, 102)"))
    found = simhash.digests(simhash.components(docs)).filter("doc_id <=> component_id")
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.dtypes == docs.dtypes
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted({r.doc_id for r in found.collect()}, key=str)
