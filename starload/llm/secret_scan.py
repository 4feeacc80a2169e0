"""Secret scans by a recursive decoding worklist.

A text is the first layer. Each layer is scanned for secrets, and every
encoded run found in it (percent escapes, Unicode escapes, base64 in one line
or wrapped, and the zlib, gzip, zstd, bz2, xz or raw deflate streams that these
hold) is decoded into a new layer that goes on the worklist. A layer whose content was met before is not scanned
again for the same place, so cycles end; the list runs empty at the fixpoint.
Each layer maps its positions to those of the text it came from, so that a
secret found at any depth is reported as the span of the original text that
holds it.

The scan is a map over rows: texts never move, and a lost executor costs only
its own tasks.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import io
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import per_row, text_or_empty

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORD = re.compile(r"passw(?:or)?d|secret|token|api_?key", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++(?:\r?\n[ \t]*+(?==))?={0,2}")
#: Letters of base64 that also part the words of paths and ids.
SEPARATOR = re.compile(r"[+/_-]")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|\\[0-3][0-7]{2}"
                    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
GZIP, ZLIB, ZSTD, BZ2, XZ = b"\x1f\x8b", b"\x78", b"\x28\xb5\x2f\xfd", b"BZh", b"\xfd7zXZ\0"
STREAMS = (GZIP, ZLIB, ZSTD, BZ2, XZ)
#: Beginnings that tell a stream inside other characters.
HEADS = (GZIP, *(ZLIB + bytes([b]) for b in (0x01, 0x5E, 0x9C, 0xDA)), ZSTD, BZ2, XZ)
DAMAGED = (zlib.error, zstandard.ZstdError, lzma.LZMAError, OSError, EOFError)


def _begins(escapes: str) -> str:
    """A pattern of HEADS whose bytes are escaped (``escapes`` has their codes
    as x, d and o) or are characters that stand for themselves."""
    def one(b):
        return f"(?:(?i:{escapes.format(x=f'{b:02x}', d=b, o=f'{b:03o}')}){'|' + re.escape(chr(b)) if 33 <= b < 127 and b != 92 else ''})"
    return "(?:" + "|".join("".join(map(one, head)) for head in HEADS) + ")"


PERCENT_STREAM = re.compile(_begins("%{x}") + r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~!*'()/:@$,;+-])*+")
ESCAPED_STREAM = re.compile(_begins(r"\\x{x}|\\u00{x}|\\u\{{0*{x}\}}|\\{o}|&\#0*{d};|&\#x0*{x};") + r"[ -~]*+")
ESCAPED_BYTE = re.compile(rf"({ESCAPE.pattern})|\\([abfnrtv0\\'\"])|([ -~])")
SHORT = dict(zip("abfnrtv0\\'\"", b"\a\b\f\n\r\t\v\0\\'\""))
#: Every secret, and every run that can hold one, has so many ASCII characters in a row.
ASCII = re.compile(rb"[\t\n\r -~]{16}")
WIDE = (("utf-16-le", re.compile(rb"(?:[\t\n\r -~]\0){16}")), ("utf-16-be", re.compile(rb"(?:\0[\t\n\r -~]){16}")))
#: Where no pattern goes on, read as single bytes or as UTF-16: bytes that none
#: holds, a null that stands apart or has two more about it, and a line's end
#: that is not within wrapped base64. A long stream is scanned in pieces that end so.
BREAK = re.compile(rb"[,<({>)}\[\]!?*|~^@$`]|(?<=[^\0].)\0(?=.[^\0])|(?<=\0)\0(?=\0)|\n\n|(?<=[^\0\sA-Za-z0-9+/_=-])\n",
                   re.DOTALL)
PIECE_BYTES = 8 << 20
#: A bomb is decoded so far; ``n_cut`` of the result tells of it.
STREAM_BYTES = 1 << 30


def find(text: str) -> list[tuple[int, int, int]]:
    """Secrets of one layer as (start, kind, end), leftmost and non-overlapping per kind."""
    found = []
    if ASSIGN_WORD.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _escaped(run: str) -> str | None:
    """The character that a Unicode escape stands for."""
    digits = run[2:].strip("{};")
    if run[0] == "\\" and run[1].isdigit():
        code = int(run[1:], 8)
    elif run[0] == "&" and digits[0] not in "xX":
        code = int(digits)
    else:
        code = int(digits.lstrip("xX"), 16)
    return chr(code) if code <= 0x10FFFF and not 0xD800 <= code < 0xE000 else None


def _percent(run: str) -> str:
    """The text that a run of percent escapes stands for."""
    return _text(bytes.fromhex(run.replace("%", "")))


def _substituted(layer: str, pattern: re.Pattern, decode):
    """The layer with every run of ``pattern`` decoded, and a function from a
    span of it to the span of the layer; None if nothing was decoded."""
    pieces, starts, sources, at, size = [], [], [], 0, 0

    def add(piece, source, end):
        nonlocal size
        if piece:
            pieces.append(piece)
            starts.append(size)
            sources.append((source, end))
            size += len(piece)

    for m in pattern.finditer(layer):
        text = decode(m[0])
        if text:
            add(layer[at:m.start()], at, None)
            add(text, m.start(), m.end())
            at = m.end()
    if not pieces:
        return None
    add(layer[at:], at, None)

    def inner(a: int, b: int) -> tuple[int, int]:
        i, j = bisect_right(starts, a) - 1, bisect_right(starts, b - 1) - 1
        (s, s_end), (t, t_end) = sources[i], sources[j]
        return (s if s_end else s + a - starts[i]), (t_end or t + b - starts[j])
    return "".join(pieces), inner


def _text(data: bytes) -> str:
    """Bytes as text: UTF-8, or one character for each byte (all patterns are ASCII)."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _bytes_texts(data: bytes) -> Iterator[str]:
    """Texts in which the secrets of decoded bytes are found, whatever the bytes
    are; also those of UTF-16 inside them, at even and odd places."""
    if ASCII.search(data):
        yield _text(data)
    for codec, pattern in WIDE:
        for odd in sorted({m.start() % 2 for m in pattern.finditer(data)}):
            yield data[odd:].decode(codec, "replace")


class _Inflated(io.RawIOBase):
    """The content of the zlib stream, or of the gzip members, that ``source`` holds."""

    def __init__(self, source: io.BufferedReader, bits: int = 47):
        self.source, self.stream, self.rest = source, zlib.decompressobj(bits), b""

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while True:
            if self.stream.eof:
                self.rest = self.stream.unused_data
                if len(self.rest) < 2:
                    self.rest += self.source.read(1 << 16)
                if self.rest[:2] != GZIP:
                    return 0
                self.stream = zlib.decompressobj(47)
            feed = self.rest or self.source.read(1 << 16)
            data = self.stream.decompress(feed, len(out))
            self.rest = self.stream.unconsumed_tail
            if data or not (feed or self.stream.eof):
                out[:len(data)] = data
                return len(data)


class _Raw(bytes):
    """Bytes that are read as a deflate stream without header."""


def _opened(data: bytes, depth: int) -> io.BufferedReader:
    """What ``data`` holds below ``depth`` compressed streams."""
    source = io.BufferedReader(io.BytesIO(data))
    if isinstance(data, _Raw):
        source = io.BufferedReader(_Inflated(source, -15))
    for _ in range(depth):
        head = source.peek(6)
        if head.startswith(BZ2):
            source = io.BufferedReader(bz2.BZ2File(source))
        elif head.startswith(XZ):
            source = io.BufferedReader(lzma.LZMAFile(source))
        elif head.startswith(ZSTD):
            source = io.BufferedReader(zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True))
        else:
            source = io.BufferedReader(_Inflated(source))
    return source


def _read(source: io.BufferedReader, most: int) -> Iterator[bytes]:
    """The source bit by bit: up to its end, a damaged place or ``most`` bytes."""
    while most > 0:
        try:
            data = source.read1(min(most, 1 << 20))
        except DAMAGED:
            return
        if not data:
            return
        most -= len(data)
        yield data


def _depth(data: bytes) -> int:
    """How many compressed streams lie around what ``data`` holds; a stream
    that holds itself, also by way of others, ends the count."""
    depth, met = 0, set()
    while True:
        if not _opened(data, depth).peek(6).startswith(STREAMS):
            return depth
        content = hashlib.sha256()
        for part in _read(_opened(data, depth), STREAM_BYTES):
            content.update(part)
        try:
            if content.digest() in met or not _opened(data, depth + 1).peek(1):
                return depth
        except DAMAGED:
            return depth
        met.add(content.digest())
        depth += 1


def _pieces(parts: Iterator[bytes]) -> Iterator[bytes]:
    """A stream in pieces of at least half of PIECE_BYTES, which end where no pattern goes on."""
    held, tried = bytearray(), 0
    for part in parts:
        held += part
        while len(held) >= PIECE_BYTES:
            if not (end := BREAK.search(held, max(tried - 4, PIECE_BYTES // 2))):
                tried = len(held)
                break
            cut, tried = end.end(), 0
            del end  # it holds the buffer
            yield bytes(held[:cut])
            del held[:cut]
    yield bytes(held)


def _base64_bytes(run: str) -> bytes:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        body = body[:-1]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _stream_texts(data: bytes, depth: int) -> Iterator[str | None]:
    """The texts of what lies below ``depth`` streams; None tells of a cut at STREAM_BYTES."""
    rest = _opened(data, depth)
    size = sum(map(len, _read(rest, STREAM_BYTES)))
    if size == STREAM_BYTES and any(_read(rest, 1)):
        yield None
    for piece in _pieces(_read(_opened(data, depth), STREAM_BYTES)):
        yield from _bytes_texts(piece)


def _data_texts(data: bytes) -> Iterator[str | None]:
    """The texts that decoded bytes stand for; None tells of a cut."""
    if depth := _depth(data):
        yield from _stream_texts(data, depth)
        return
    if not data.startswith(ZSTD):  # else a damaged stream
        yield from _bytes_texts(data)
    raw = _Raw(data)
    try:
        if not _opened(raw, 0).peek(1):
            return
    except DAMAGED:
        return
    yield from _stream_texts(raw, _depth(raw))


def _run_texts(run: str) -> Iterator[str | None]:
    """The texts of a run of base64, over several lines or on one. Other words
    of the same letters may stand before it (a path, an id), so it is read from
    each of four places, and streams from wherever a word or a line begins."""
    lines = run.rstrip("=").split()
    body = "".join(lines)
    if len(body) < 20:
        return
    read = [_base64_bytes(body[k:]) for k in range(4)]
    for data in read:
        yield from _data_texts(data)
    begins, at = {m.end() for m in SEPARATOR.finditer(body)}, 0
    for line in lines[:-1]:
        at += len(line)
        begins.add(at)
    for at in sorted(begins):
        k, data = at % 4, read[at % 4][(at - at % 4) // 4 * 3:]
        if at > k and data.startswith(HEADS) and (depth := _depth(data)):
            yield from _stream_texts(data, depth)


def _escaped_streams(layer: str) -> Iterator[tuple[bytes, int, int]]:
    """Streams written with escapes among characters that stand for themselves, and their spans."""
    if "%" in layer:
        for m in PERCENT_STREAM.finditer(layer):
            yield unquote_to_bytes(m[0]), *m.span()
            if "+" in m[0]:
                yield unquote_to_bytes(m[0].replace("+", " ")), *m.span()
        for m in PERCENT.finditer(layer):
            if "%00" in m[0]:  # UTF-16
                yield bytes.fromhex(m[0].replace("%", "")), *m.span()
    if "\\" in layer or "&#" in layer:
        for m in ESCAPED_STREAM.finditer(layer):
            quote = layer[m.start() - 1:m.start()]
            stops = quote if quote in ("'", '"') else "\"' "
            data, end = bytearray(), m.start()
            for token in ESCAPED_BYTE.finditer(layer, *m.span()):
                code = ord(_escaped(token[1]) or "\uffff") if token[1] else SHORT[token[2]] if token[2] else ord(token[3])
                if code > 255 or token[3] and token[3] in stops:
                    break
                data.append(code)
                end = token.end()
            yield bytes(data), m.start(), end


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """Base spans of the text, all spans with those of its decoded layers, and
    how many streams were cut."""
    base, n_cut = find(text), 0
    spans = set(base)
    seen = {(hashlib.sha256(text.encode("utf-8")).digest(), 0, len(text))}
    work = [(_children(text), lambda a, b: (a, b))]  # what is left of a layer, and the layer's map to the original text
    while work:
        children, place = work[-1]
        if (unwrapped := next(children, None)) is None:
            work.pop()
            continue
        child, inner, cut = unwrapped
        n_cut += cut

        def where(a, b, inner=inner, place=place):
            return place(*inner(a, b))
        name = (hashlib.sha256(child.encode("utf-8")).digest(), *where(0, len(child)))
        if name in seen:
            continue
        seen.add(name)
        for start, kind, end in find(child):
            a, b = where(start, end)
            spans.add((a, kind, b))
        work.append((_children(child), where))
    return base, sorted(spans), n_cut


def _children(layer: str):
    """The layers that one layer unwraps to, with maps of their spans to its
    own, and whether a stream was cut (told by an empty layer)."""
    if "%" in layer and (found := _substituted(layer, PERCENT, _percent)):
        yield *found, False
    if ("\\" in layer or "&#" in layer) and (found := _substituted(layer, ESCAPE, _escaped)):
        yield *found, False
    for texts, s, e in _runs(layer):
        def run(a, b, s=s, e=e):
            return s, e
        for child in texts:
            yield child or "", run, child is None


def _runs(layer: str) -> Iterator[tuple[Iterator[str | None], int, int]]:
    """The texts of each run whose bytes are decoded as a whole, and the run's span."""
    for m in BASE64.finditer(layer):
        yield _run_texts(m[0]), *m.span()
    if "\n" in layer:
        for m in WRAPPED.finditer(layer):
            yield _run_texts(m[0]), *m.span()
    for data, s, e in _escaped_streams(layer):
        yield _data_texts(data), s, e


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of documents (doc_id, text): one row per input row.

    doc_id; n_assign, n_access and n_hex, the secrets of the text itself;
    base_spans and spans, as ``kind:start:end`` by start and kind, joined by
    commas (code points, end exclusive). ``spans`` adds the spans of decoded
    layers, of the same kinds. A secret below a base64 or compressed run takes
    the whole run as its span; below percent or Unicode escapes it takes the
    characters and escapes it came from. A null text has no spans. Decoded bytes
    are scanned whatever they are: as UTF-8 or else byte by byte, and as UTF-16.
    Only bytes that begin as a zstd stream and cannot be opened are left.

    Compressed streams of any size are decoded and scanned piece by piece, up to
    the place where they are damaged; ``n_cut`` counts those that hold more
    than STREAM_BYTES (bombs), which are scanned so far.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                        ("base_spans", pa.string()), ("spans", pa.string()), ("n_cut", pa.int64())])

    def row(text):
        base, spans, n_cut = scan(text)
        return (*(sum(k == kind for _, k, _ in base) for kind in range(3)), joined(base), joined(spans), n_cut)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(per_row(row, ["doc_id", "text"], schema),
                           "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string, n_cut long")
