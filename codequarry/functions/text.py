"""Columns over file contents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codequarry.schemas import WHITE_SPACE

_TAIL_BYTES = 128
_MAX_CHARACTER_BYTES = 4


def decode_utf8(content: Column) -> Column:
    """Binary content as a string; NULL when it is not valid UTF-8."""
    return F.try_validate_utf8(content.cast("string"))


def trim_text(text: Column) -> Column:
    """Strip Unicode white space, and nothing else, from both ends.

    ``btrim`` and ``rtrim`` index every character of their input, so the right end is trimmed on the
    last bytes alone.  Where hardly more than a cut character is left of these, all of the text is
    trimmed.
    """
    space = F.lit(WHITE_SPACE)
    data = text.cast("binary")
    tail = F.substring(data, -_TAIL_BYTES, _TAIL_BYTES).cast("string")
    kept = F.octet_length(F.rtrim(tail, space))
    length = F.octet_length(text) - F.octet_length(tail) + kept
    left_part = F.substring(data, F.lit(1), length).cast("string")
    return F.when(kept >= _MAX_CHARACTER_BYTES, F.ltrim(left_part, space)).otherwise(
        F.btrim(text, space)
    )


def content_hash(text: Column) -> Column:
    """MD5 of the UTF-8 bytes in lower-case hex."""
    return F.md5(text)


def stable_record_id(repo: Column, path: Column, entry_index: Column) -> Column:
    """An id that survives task retries and tells apart repeated paths of one archive."""
    return F.sha2(F.concat_ws("\u0000", repo, path, entry_index.cast("string")), 256)
