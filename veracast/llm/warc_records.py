"""WARC records as bytes: headers first, payloads only where asked for.

``records`` walks over one archive file, plain or with one gzip member a record. It reads the headers
of each record and hands it out; the block is read, inflated and decoded only if the caller asks.
Otherwise the file position moves on: by Content-Length in a plain file, by the ``sl`` field (lengths
of the member) in a gzip file that has it. A gzip member without that field has to be inflated to
find its end, in small pieces that are dropped.
"""

from __future__ import annotations

import base64
import struct
import zlib
from collections.abc import Iterator

# Fixed values of the formats.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EXTRA_FLAG, _NAME_FLAG, _COMMENT_FLAG, _HEADER_CRC_FLAG = 4, 8, 16, 2

_CHUNK = 16 << 10
_MOST_HEADER = 1 << 20


class DamagedArchive(ValueError):
    """A file that ends within a record, or does not hold WARC records."""


class _Plain:
    """A record's bytes in a plain file."""

    def __init__(self, source, at: int):
        self._source, self.at = source, at

    def read(self, n: int) -> bytes:
        self._source.seek(self.at)
        data = self._source.read(n)
        self.at += len(data)
        return data

    def end(self, left: int) -> int:
        return self.at + left


class _Member:
    """A record's bytes in a gzip member, inflated as far as they are read."""

    def __init__(self, source, at: int):
        self._source, self._start, self._next = source, at, at
        self._inflate = zlib.decompressobj(31)
        self._given = b""
        first = self._fetch()
        if first[:2] != b"\x1f\x8b":
            raise DamagedArchive(f"no gzip member at byte {at}")
        self._length = _member_length(first)
        self._given = first

    def _fetch(self) -> bytes:
        self._source.seek(self._next)
        data = self._source.read(_CHUNK)
        self._next += len(data)
        return data

    def read(self, n: int) -> bytes:
        out = []
        while n > 0 and not self._inflate.eof:
            raw = self._given or self._fetch()
            if not raw:
                raise DamagedArchive(f"the member at byte {self._start} is cut off")
            try:
                part = self._inflate.decompress(raw, n)
            except zlib.error as wrong:
                raise DamagedArchive(f"the member at byte {self._start}: {wrong}") from wrong
            self._given = self._inflate.unconsumed_tail
            out.append(part)
            n -= len(part)
        return b"".join(out)

    def end(self, left: int) -> int:
        if self._length:
            return self._start + self._length
        while not self._inflate.eof:
            self.read(_CHUNK)
        return self._next - len(self._inflate.unused_data) - (
            0 if self._inflate.unused_data else len(self._given)
        )


def _member_length(head: bytes) -> int | None:
    """Length of a gzip member as its ``sl`` field states it."""
    if len(head) < 12 or not head[3] & _EXTRA_FLAG:
        return None
    (total,) = struct.unpack_from("<H", head, 10)
    at, end = 12, min(12 + total, len(head))
    while at + 4 <= end:
        name, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if name == b"sl" and size == 8 and at + 12 <= end:
            return struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + size
    return None


def _header_lines(text: bytes) -> dict[str, str]:
    """Field names in lower case to values; continued lines are joined, the first of a name counts."""
    out: dict[str, str] = {}
    name = None
    for line in text.split(b"\r\n"):
        if line[:1] in b" \t" and line and name:
            out[name] += " " + line.decode("utf-8", "replace").strip()
            continue
        key, mark, value = line.decode("utf-8", "replace").partition(":")
        name = key.strip().lower() if mark else None
        if name is not None:
            out.setdefault(name, value.strip())
    return out


class Record:
    """One record: its headers, and on demand the HTTP headers and the payload of its block."""

    def __init__(self, body, headers: dict[str, str], left: int, rest: bytes, offset: int):
        self.headers, self.offset = headers, offset
        self._body, self._rest, self._left = body, rest, left
        self._http: tuple[int | None, dict[str, str]] | None = None

    @property
    def is_http(self) -> bool:
        return self.headers.get("content-type", "").lower().startswith("application/http")

    def _more(self, n: int) -> bytes:
        """Up to ``n`` further bytes of the block."""
        take, self._rest = self._rest[:n], self._rest[n:]
        n = min(n, self._left) - len(take)
        if n > 0:
            read = self._body.read(n)
            if len(read) < n:
                raise DamagedArchive(f"the record at byte {self.offset} is cut off")
            take += read
        self._left -= len(take)
        return take

    def http(self) -> tuple[int | None, dict[str, str]]:
        """Status and headers of the HTTP message in the block; none if it holds no such message."""
        if self._http is None:
            self._http = (None, {})
            if self.is_http:
                head = b""
                while b"\r\n\r\n" not in head and len(head) < _MOST_HEADER:
                    part = self._more(_CHUNK)
                    if not part:
                        break
                    head += part
                lines, _, after = head.partition(b"\r\n\r\n")
                self._rest, self._left = after + self._rest, self._left + len(after)
                first, _, fields = lines.partition(b"\r\n")
                words = first.split(None, 2)
                code = int(words[1]) if len(words) > 1 and words[1].isdigit() else None
                self._http = (code, _header_lines(fields))
        return self._http

    def payload(self) -> bytes:
        """The block's entity without its transfer and content codings; the block if it is no HTTP."""
        _, fields = self.http()
        data = self._more(self._left)
        if "chunked" in fields.get("transfer-encoding", "").lower():
            data = _unchunked(data)
        coding = fields.get("content-encoding", "").strip().lower()
        if coding in ("gzip", "x-gzip"):
            data = zlib.decompress(data, 31) if data else data
        elif coding == "deflate":
            data = zlib.decompress(data, 15) if data else data
        return data

    def end(self) -> int:
        """Where the next record starts."""
        return self._body.end(self._left - len(self._rest) + 4)


def _unchunked(data: bytes) -> bytes:
    out, at = [], 0
    while True:
        stop = data.find(b"\r\n", at)
        size = int(data[at:stop].split(b";")[0] or b"0", 16) if stop >= 0 else 0
        if not size:
            return b"".join(out)
        out.append(data[stop + 2 : stop + 2 + size])
        at = stop + 2 + size + 2


def records(source, size: int) -> Iterator[Record]:
    """All records of a seekable file of ``size`` bytes, in its order."""
    at = 0
    if size:
        source.seek(0)
        kind = _Member if source.read(2) == b"\x1f\x8b" else _Plain
    while at < size:
        body = kind(source, at)
        head = b""
        while b"\r\n\r\n" not in head:
            part = body.read(_CHUNK)
            if not part or len(head) > _MOST_HEADER:
                raise DamagedArchive(f"no record headers at byte {at}")
            head += part
        lines, _, rest = head.partition(b"\r\n\r\n")
        version, _, fields = lines.lstrip(b"\r\n").partition(b"\r\n")
        headers = _header_lines(fields)
        length = headers.get("content-length", "")
        if not version.startswith(b"WARC/") or not length.isdigit():
            raise DamagedArchive(f"no WARC record at byte {at}")
        left = int(length)
        if kind is _Plain:
            body.at -= max(0, len(rest) - left)
        record = Record(body, headers, left, rest[:left], at)
        yield record
        at = record.end()


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def hex_digest(labelled: str | None) -> str | None:
    """``sha1:`` digests, base 32 or hex, as ``sha1:`` and lower-case hex; others as they are."""
    if not labelled:
        return None
    kind, _, value = labelled.partition(":")
    if kind.lower() == "sha1" and len(value) == 32:
        try:
            return "sha1:" + base64.b32decode(value.upper()).hex()
        except ValueError:
            return labelled
    return f"{kind.lower()}:{value.lower()}" if kind.lower() == "sha1" else labelled


def _safe(value: str) -> str:
    """A header value or URI without characters that would end the line: those are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def record_bytes(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A whole record; fields without a value are left out."""
    lines = [VERSION]
    for name, value in fields:
        if value is not None:
            lines.append(f"{name}: {_safe(str(value))}".encode("utf-8", "surrogatepass"))
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    """One gzip member with the lengths of itself and of its content in its ``sl`` field."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    whole = 10 + 2 + 12 + len(body) + 8
    if whole > 0xFFFFFFFF or len(data) > 0xFFFFFFFF:
        deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
        return deflate.compress(data) + deflate.flush()
    head = b"\x1f\x8b\x08" + bytes([_EXTRA_FLAG]) + b"\0\0\0\0\0\xff"
    extra = struct.pack("<H2sHII", 12, b"sl", 8, whole, len(data))
    return head + extra + body + struct.pack("<II", zlib.crc32(data), len(data))
