"""Worker-side helpers that list and read the members of one open zip archive."""

from __future__ import annotations

import io
import lzma
import stat
import struct
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

from pyarrow import fs

# What damaged or unsupported archive data raises.
DAMAGE = (
    zipfile.BadZipFile,
    zlib.error,
    lzma.LZMAError,
    struct.error,
    EOFError,
    NotImplementedError,
    ValueError,
)

_UNIX = 3
_ENCRYPTED = 0x1
_BUFFER_BYTES = 4 << 20
_LOCAL_HEADER_BYTES = 30
# Fixed values of the format: marks and lengths of the records of a central directory and its end.
_ENTRY_MARK, _ENTRY_BYTES = b"PK\x01\x02", 46
_END_MARK, _END_BYTES = b"PK\x05\x06", 22
_END64_MARK, _END64_BYTES = b"PK\x06\x06", 56
_LOCATOR_MARK, _LOCATOR_BYTES = b"PK\x06\x07", 20
_LONGEST_COMMENT = 0xFFFF
_LONGEST_ENTRY = _ENTRY_BYTES + 3 * 0xFFFF


def storage_uri(path: str) -> str:
    """A path as Spark reports it, which is not URL-encoded, as a URI for Arrow's file systems."""
    if path.startswith("/"):
        return "file://" + quote(path)
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return "file:///" + quote(rest.lstrip("/"))
    arrow_scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return f"{arrow_scheme}:{quote(rest, safe='/:@')}"


def open_archive(path: str) -> BinaryIO:
    """A buffered, seekable stream over an archive on local, HDFS or object storage."""
    filesystem, inner = fs.FileSystem.from_uri(storage_uri(path))
    return io.BufferedReader(_ArrowStream(filesystem.open_input_file(inner)), _BUFFER_BYTES)


class _ArrowStream(io.RawIOBase):
    """An Arrow file as a raw stream whose failed seeks are OSErrors, as ``zipfile`` expects.

    A failed read is remembered in ``failure``, because ``zipfile`` takes it for damage.
    """

    def __init__(self, file):
        self._file = file
        self.failure: OSError | None = None

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        try:
            return self._file.readinto(buffer)
        except OSError as error:
            self.failure = error
            raise

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        try:
            return self._file.seek(offset, whence)
        except ValueError as error:
            raise OSError(str(error)) from error

    def tell(self) -> int:
        return self._file.tell()

    def close(self) -> None:
        if not self.closed:
            self._file.close()
        super().close()


def failure_of(stream: BinaryIO) -> OSError | None:
    """The storage error that a stream of ``open_archive`` met, if any."""
    return getattr(getattr(stream, "raw", None), "failure", None)


def list_entries(stream: BinaryIO) -> Iterator[dict]:
    """Central directory rows in archive order; no member is inflated."""
    with zipfile.ZipFile(stream) as archive:
        yield from _entry_rows(archive.infolist())


def _entry_rows(infos: list[zipfile.ZipInfo], first_index: int = 0, shift: int = 0) -> Iterator[dict]:
    for index, info in enumerate(infos, first_index):
        yield {
            "entry_index": index,
            # ``filename`` is cut at a NUL; the full name must reach the path check.
            "entry_name": info.orig_filename,
            "is_file": _is_file(info),
            "size_in_bytes": info.file_size,
            "compressed_size": info.compress_size,
            "header_offset": info.header_offset + shift,
            "method": info.compress_type,
            "crc": info.CRC,
            "error": "encrypted entry" if info.flag_bits & _ENCRYPTED else None,
        }


def find_directory(stream: BinaryIO) -> tuple[int, int, int] | None:
    """Where the central directory begins and ends, and what is added to the offsets in it.

    None where its end record is not plain: the archive may be damaged.
    """
    size = stream.seek(0, io.SEEK_END)
    length = min(size, _END64_BYTES + _LOCATOR_BYTES + _END_BYTES + _LONGEST_COMMENT)
    stream.seek(size - length)
    tail = stream.read(length)
    at = len(tail) - _END_BYTES
    if not (tail.startswith(_END_MARK, max(at, 0)) and tail.endswith(b"\0\0")):
        at = tail.rfind(_END_MARK)
    if not 0 <= at <= len(tail) - _END_BYTES or len(tail) - at > _END_BYTES + _LONGEST_COMMENT:
        return None
    held, offset = struct.unpack_from("<2L", tail, at + 12)
    stop = size - len(tail) + at
    locator = at - _LOCATOR_BYTES
    if locator >= 0 and tail.startswith(_LOCATOR_MARK, locator):
        wide = locator - _END64_BYTES
        disk, disks = struct.unpack_from("<L8xL", tail, locator + 4)
        if disk or disks > 1 or wide < 0 or not tail.startswith(_END64_MARK, wide):
            return None
        held, offset = struct.unpack_from("<2Q", tail, wide + 40)
        stop -= _LOCATOR_BYTES + _END64_BYTES
    start = stop - held
    return None if start < 0 else (start, stop, start - offset)


def entries_between(stream: BinaryIO, begin: int, until: int, stop: int) -> tuple[int, int, int] | None:
    """First entry from ``begin`` on, the end of the last that begins before ``until``, and how many they are.

    The first one is found by its mark, and taken if entry after entry follows up to ``until`` in a directory that
    ends at ``stop``.  That it is an entry, and not a name that looks like one, shows only where the entries
    before it end.  None if there is no such row of entries, or if one of them cannot be read.
    """
    stream.seek(begin)
    data = stream.read(min(until + _LONGEST_ENTRY, stop) - begin)
    limit = until - begin
    failed: set[int] = set()
    first = data.find(_ENTRY_MARK)
    while 0 <= first < limit:
        at, passed = first, []
        while at < limit and at not in failed and data.startswith(_ENTRY_MARK, at) and at + _ENTRY_BYTES <= len(data):
            passed.append(at)
            at += _ENTRY_BYTES + sum(struct.unpack_from("<3H", data, at + 28))
        if limit <= at <= len(data):
            try:
                _infos(data[first:at])
            except DAMAGE:
                return None
            return begin + first, begin + at, len(passed)
        failed.update(passed)
        first = data.find(_ENTRY_MARK, first + 1)
    return None


def list_entries_between(stream: BinaryIO, first: int, last: int, first_index: int, shift: int) -> Iterator[dict]:
    """Rows of the entries that lie between two bytes of a central directory."""
    stream.seek(first)
    yield from _entry_rows(_infos(stream.read(last - first)), first_index, shift)


def _infos(entries: bytes) -> list[zipfile.ZipInfo]:
    # The empty entry at the end keeps what the last comment holds from being taken for an end record.
    directory = entries + _ENTRY_MARK + bytes(_ENTRY_BYTES - len(_ENTRY_MARK))
    end = _END_MARK + struct.pack("<4H2LH", 0, 0, 0, 0, len(directory), 0, 0)
    with zipfile.ZipFile(io.BytesIO(directory + end)) as archive:
        return archive.infolist()[:-1]


def _is_file(info: zipfile.ZipInfo) -> bool:
    if info.orig_filename.endswith(("/", "\\")):
        return False
    mode = info.external_attr >> 16
    return not (info.create_system == _UNIX and stat.S_ISLNK(mode))


def read_entry(stream: BinaryIO, entry: dict) -> tuple[bytes | None, str | None]:
    """The content of one listed member, or what is wrong with its data.

    Neither what is read nor what is inflated exceeds a bound that follows the listed size, whatever
    the archive claims, and the checksum must match.  Errors of the storage itself are raised, so that
    the task is tried again.
    """
    stream.seek(entry["header_offset"])
    header = stream.read(_LOCAL_HEADER_BYTES)
    skip = int.from_bytes(header[26:28], "little") + int.from_bytes(header[28:30], "little")
    stream.seek(skip, io.SEEK_CUR)
    # No method needs more than this for so few bytes; a larger claim runs out of data.
    most = 2 * entry["size_in_bytes"] + _BUFFER_BYTES
    packed = io.BytesIO(stream.read(min(entry["compressed_size"], most)))
    info = zipfile.ZipInfo("member")
    info.compress_type = entry["method"]
    info.compress_size = entry["compressed_size"]
    info.file_size = entry["size_in_bytes"]
    info.CRC = entry["crc"]
    try:
        content = zipfile.ZipExtFile(packed, "r", info).read(info.file_size + 1)
    except (*DAMAGE, OSError) as error:  # nothing but memory is read here
        return None, f"damaged entry: {type(error).__name__}"
    if len(content) != entry["size_in_bytes"]:
        return None, "damaged entry: size differs"
    return content, None
