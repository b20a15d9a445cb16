"""Secret scan: patterns of known kinds, and a token-efficiency test for random strings.

A merge vocabulary spells words with few tokens and random strings with many: a run of key letters
that yields few characters a token is random.  Runs that overlap a span found already, known digests,
identifiers of words, plain numbers and words of one case are excluded before the test.  Readable words
that are glued to a random string do not hide it: the parts of a run are tested too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import texts
from .vocabulary import encoding

# Kinds in the order in which spans of one beginning are listed.
KINDS = ("assign", "access", "hex", "random")

# The patterns of the base kinds.  ``{32,}`` and ``{12,}`` find the same runs as ``+`` with
# a length check, because a shorter run has no longer one inside it; for assignments that is not so.
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_LEAST = 20
_UUID = re.compile(r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}")
_IDENTIFIER = re.compile(r"[A-Za-z]+(?:[_/-][A-Za-z]+)*[_/-]?[0-9]{0,6}|[0-9_/+=-]+|[_/+=-]+")
_DIGEST = re.compile(r"(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{56}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{96}|[0-9A-Fa-f]{128})")
_KNOWN = re.compile(rf"(?<![A-Za-z0-9])(?:{_UUID.pattern}|{_DIGEST.pattern})(?![A-Za-z0-9])")
_LETTERS = re.compile(r"[A-Za-z]+")
_DIVISIONS = (re.compile(r"=+"), re.compile(r"[=/]+"), re.compile(r"[=/_-]+"))
_PIECE = re.compile(r"[A-Za-z0-9+]+[=/_-]*|[=/_-]+")

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """``(start, kind, end)`` of the base kinds, by start, then kind."""
    spans: list[Span] = []
    lowered = text.lower()
    if any(word in lowered for word in _WORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def _mixed(run: str) -> bool:
    """Whether upper case, lower case and digits are not all but one missing."""
    return sum(any(map(test, run)) for test in (str.isupper, str.islower, str.isdigit)) >= 2


def _is_identifier(run: str, coder, max_chars_per_token: float) -> bool:
    """Whether a run has the form of an identifier, and its letters are spelt with few tokens as words are."""
    if not _IDENTIFIER.fullmatch(run):
        return False
    letters = _LETTERS.findall(run)
    return sum(map(len, letters)) >= max_chars_per_token * sum(len(coder.encode_ordinary(part)) for part in letters)


def is_random(run: str, coder, max_chars_per_token: float) -> bool:
    """Whether a run of key letters is no digest or identifier and is spelt with few characters a token."""
    if _UUID.fullmatch(run) or _DIGEST.fullmatch(run) or not _mixed(run) or _is_identifier(run, coder, max_chars_per_token):
        return False
    return len(run) / len(coder.encode_ordinary(run)) < max_chars_per_token


def _least_efficient(run: str, coder, max_chars_per_token: float) -> str:
    """Of the sequences of pieces with ``_LEAST`` letters, the one that has most tokens beyond the bound."""
    best, most, low = "", 0.0, (0.0, 0)
    starts: list[tuple[int, float]] = []
    total, ready = 0.0, 0
    for piece in _PIECE.finditer(run):
        starts.append((piece.start(), total))
        total += max_chars_per_token * len(coder.encode_ordinary(piece.group())) - len(piece.group())
        while ready < len(starts) and piece.end() - starts[ready][0] >= _LEAST:
            at, before = starts[ready]
            low = min(low, (before, at)) if ready else (before, at)
            ready += 1
        if ready and total - low[0] > most:
            best, most = run[low[1] : piece.end()], total - low[0]
    return best.strip("=/_-")


def has_random_part(run: str, coder, max_chars_per_token: float) -> bool:
    """Whether a part of a run between separators, or a sequence of such parts, is random by itself."""
    if not _mixed(run):
        return False
    for between in _KNOWN.split(run):
        parts = {part for division in _DIVISIONS for part in division.split(between)} - {run}
        if len(between) >= _LEAST:
            parts.add(_least_efficient(between, coder, max_chars_per_token))
        if any(len(part) >= _LEAST and is_random(part, coder, max_chars_per_token) for part in parts):
            return True
    return False


def joined(spans: list[Span]) -> list[tuple[int, int]]:
    """Sorted spans as stretches that do not overlap."""
    out: list[tuple[int, int]] = []
    for start, _, end in spans:
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def random_spans(text: str, known: list[Span], coder, max_chars_per_token: float) -> list[Span]:
    """Runs of 20 or more key letters that overlap no known span and are random or have a random part."""
    spans, taken, at = [], joined(known), 0
    for match in _RUN.finditer(text):
        start, end = match.span()
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at < len(taken) and taken[at][0] < end:
            continue
        run = match.group()
        if is_random(run, coder, max_chars_per_token) or has_random_part(run, coder, max_chars_per_token):
            spans.append((start, 3, end))
    return spans


def all_spans(text: str, coder, max_chars_per_token: float) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans, each by start, then kind."""
    base = base_spans(text)
    return base, sorted(base + random_spans(text, base, coder, max_chars_per_token))


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, vocabulary: str, max_chars_per_token: float = 2.0) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` of each whole text, row by row.

    Null texts are empty and have no spans; a span is ``kind:start:end`` in characters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(vocabulary)
        for batch in batches:
            counts, hashes, written = [], [], []
            for text in batch.column("text").to_pylist():
                base, spans = all_spans(text, coder, max_chars_per_token)
                counts.append([sum(kind == k for _, kind, _ in spans) for k in range(len(KINDS))])
                hashes.append(hashlib.sha256(_written(base).encode()).hexdigest())
                written.append(_written(spans))
            columns = {"doc_id": batch.column("doc_id")}
            for k, kind in enumerate(KINDS):
                columns[f"n_{kind}"] = pa.array([count[k] for count in counts], pa.int64())
            columns |= {"base_sha256": pa.array(hashes, pa.string()), "spans": pa.array(written, pa.string())}
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return texts(docs).select("doc_id", "text").mapInArrow(run, schema)


def redact(docs: DataFrame, vocabulary: str, max_chars_per_token: float = 2.0, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each secret in ``text`` (overlapping ones joined) replaced by ``mark``; nulls stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(vocabulary)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            masked = []
            for text in batch.column(at).to_pylist():
                for start, end in reversed(joined(all_spans(text, coder, max_chars_per_token)[1]) if text else []):
                    text = text[:start] + mark + text[end:]
                masked.append(text)
            yield batch.set_column(at, batch.schema.field(at).name, pa.array(masked, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
