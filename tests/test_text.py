import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codequarry.functions import text
from codequarry.schemas import WHITE_SPACE


def test_trim_strips_all_white_space_code_points(column):
    assert len(set(WHITE_SPACE)) == 25
    assert column(text.trim_text, [c + "a b" + c + c for c in WHITE_SPACE]) == ["a b"] * 25


def test_trim_keeps_everything_else(column):
    kept = [c + "a" + c for c in ["​", "﻿", "\u001c", "\u001f", "᠎"]]
    assert column(text.trim_text, kept) == kept
    assert column(text.trim_text, [" \t\n", ""]) == ["", ""]


@pytest.mark.parametrize("fill", ["x", "é", "漢", "😀", "䀨", "ऀ", ""])
def test_trim_of_long_ends(column, fill):
    """Ends around the number of bytes that are looked at first, cut inside characters."""
    values, expected = [], []
    for count in (0, 1, 2, 40, 60, 61, 62, 63, 64, 120, 124, 125, 126, 127, 128, 129, 130, 300):
        for space in (" ", "\n", "\u00a0", "\u2028", "\u3000"):
            for body in (fill, fill * 3, "a" + fill, fill * 200):
                values.append(space * count + body + space * count)
                expected.append(body)
    assert column(text.trim_text, values) == expected


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from([*WHITE_SPACE, "a", "é", "漢", "😀", "䀨", "\u200b"]),
                         max_size=90).map("".join), min_size=1, max_size=30))
def test_trim_matches_python(column, values):
    assert column(text.trim_text, values) == [v.strip(WHITE_SPACE) for v in values]


def test_content_hash_is_md5_of_utf8(column):
    values = ["", "a", "é漢😀"]
    expected = [hashlib.md5(v.encode()).hexdigest() for v in values]
    assert column(text.content_hash, values) == expected


def test_decode_drops_invalid_and_keeps_empty_and_bom(spark):
    contents = [b"\xff\xfe", b"", b"\xef\xbb\xbfx", "ä".encode("latin1"), "ä".encode()]
    rows = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(contents)],
                                 "i int, c binary")
    found = rows.orderBy("i").select(text.decode_utf8(F.col("c")).alias("t")).collect()
    assert [row.t for row in found] == [None, "", "﻿x", None, "ä"]


def test_stable_id_is_a_function_of_repo_path_and_position(spark):
    made = spark.range(1).select(
        text.stable_record_id(F.lit("u-r"), F.lit("a.c"), F.lit(3).cast("long"))
    ).first()[0]
    assert made == hashlib.sha256(b"u-r\0a.c\x003").hexdigest()
