"""Columns over repository names, archive file names and archive entry paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_repo(value: Column) -> Column:
    """Whether ``value`` reads ``user/name``: exactly two parts, either of which may be empty."""
    return F.coalesce(F.size(F.split(value, "/")) == 2, F.lit(False))


def repo_user(value: Column) -> Column:
    return F.when(is_repo(value), F.substring_index(value, "/", 1))


def repo_name(value: Column) -> Column:
    return F.when(is_repo(value), F.substring_index(value, "/", -1))


def repo_key(user: Column, name: Column) -> Column:
    """``user-name``; NULL when either is NULL."""
    return F.concat(user, F.lit("-"), name)


def base_file_name(path: Column) -> Column:
    """Last component of a file listing path."""
    return F.substring_index(path, "/", -1)


def file_stem(file_name: Column) -> Column:
    """File name without its last extension; a name such as ``.zip`` is kept whole."""
    return F.regexp_replace(file_name, r"(?s)(?<=.)\.[^.]*$", "")


def match_key(stem: Column) -> Column:
    """Stem up to the first underscore."""
    return F.substring_index(stem, "_", 1)


def output_base(stem: Column) -> Column:
    """Stem up to the last underscore, or the whole stem."""
    return F.regexp_replace(stem, r"(?s)_[^_]*$", "")


def first_dot_extension(path: Column) -> Column:
    """Everything from the first dot of the whole path; NULL without a dot."""
    dot = F.instr(path, ".")
    return F.when(dot > 0, F.substr(path, dot))


def last_dot_extension(file_name: Column) -> Column:
    """The suffix a language catalog lists, such as ``.py``; NULL without one."""
    return F.nullif(F.regexp_extract(file_name, r"(?s)(\.[^.]+)$", 1), F.lit(""))


def _skipped(part: Column) -> Column:
    return part.isin("", ".")


def is_safe_path(path: Column) -> Column:
    """False for a path with a NUL, an absolute path, and one that ever climbs above its root."""

    def step(depth: Column, part: Column) -> Column:
        return (
            F.when((depth < 0) | _skipped(part), depth)
            .when(part == "..", depth - 1)
            .otherwise(depth + 1)
        )

    stays_inside = F.aggregate(F.split(path, "/"), F.lit(0), step) >= 0
    return (
        ~F.startswith(path, F.lit("/"))
        & (F.instr(path, "\u0000") == 0)
        & F.when(F.contains(path, F.lit("..")), stays_inside).otherwise(True)
    )


def safe_path(path: Column) -> Column:
    """The path as it is when safe, else NULL."""
    return F.when(is_safe_path(path), path)


def path_file_name(path: Column) -> Column:
    """Last real component of an entry path; NULL when there is none or it is ``..``."""
    last = F.substring_index(path, "/", -1)
    named = F.filter(F.split(path, "/"), lambda part: ~_skipped(part))
    last_named = F.try_element_at(named, F.lit(-1))
    return F.nullif(F.when(_skipped(last), last_named).otherwise(last), F.lit(".."))


def archive_url(user: Column, name: Column, branch: Column) -> Column:
    return F.format_string(
        "https://github.com/%s/%s/archive/refs/heads/%s.zip", user, name, branch
    )


def archive_target(directory: str, user: Column, name: Column) -> Column:
    return F.concat(F.lit(f"{directory.rstrip('/')}/"), repo_key(user, name), F.lit(".zip"))
