"""Fixed schemas and constants of the corpus data model."""

from __future__ import annotations

from pyspark.sql import types as T

# One source file of one repository.  ``repo`` names the archive the file came from.
RECORD = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("file_extension", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("size_in_bytes", T.LongType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("tokens", T.LongType()),
    ]
)
RECORD_COLUMNS = RECORD.fieldNames()

# One member of one zip archive as its central directory describes it.  ``error`` is set, and the
# entry columns are NULL, for an archive that cannot be read.
ENTRY = T.StructType(
    [
        T.StructField("repo", T.StringType()),
        T.StructField("archive", T.StringType()),
        T.StructField("entry_index", T.LongType()),
        T.StructField("entry_name", T.StringType()),
        T.StructField("is_file", T.BooleanType()),
        T.StructField("size_in_bytes", T.LongType()),
        T.StructField("compressed_size", T.LongType()),
        T.StructField("header_offset", T.LongType()),
        T.StructField("method", T.IntegerType()),
        T.StructField("crc", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)

# A byte range of a central directory, of which the entries between ``first`` and ``last`` are listed.
# ``begin`` is NULL for a directory that is listed as a whole.
DIRECTORY_PART = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("stem", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("begin", T.LongType()),
        T.StructField("until", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("stop", T.LongType()),
        T.StructField("shift", T.LongType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("n", T.LongType()),
    ]
)

CATALOG = T.StructType(
    [
        T.StructField("language", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("extensions", T.ArrayType(T.StringType())),
    ]
)

# Fixed value: the Unicode White_Space code points, which trimming removes.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed values of the output format.
MAX_FILE_SIZE = 131072
CATEGORY = "programming"
BRANCHES = ("main", "master")
END_OF_TEXT = "<|endoftext|>"
END_OF_TEXT_ID = 50256
