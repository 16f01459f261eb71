"""Secrets in texts, also under nested encodings: a decoding worklist run to its fixpoint."""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from array import array
from itertools import accumulate, chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import LOWER, by_rows, texts

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
_KEYWORDS = re.compile(rb"(?=passw|secret|token|api)")  # may overlap
_KEYWORD_PARTS = (b"passw", b"secret", b"token", b"api")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Characters of base64 in either alphabet; a run of them also holds every access key and hex string.
_RUN = bytes(b in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-" for b in range(256))
_SHORTEST_RUN = 16
_URL = re.compile(rb"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(rb"(?:\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\x[0-9a-fA-F]{2})+")
_URL_END = re.compile(rb"%([0-9A-Fa-f]{2})\Z")
_UNICODE_END = re.compile(
    rb"(?:\\u(d[89ab][0-9a-f]{2})\\u(d[c-f][0-9a-f]{2})|\\u((?!d[89a-f])[0-9a-f]{4})|\\U([0-9a-f]{8})|\\x([0-9a-f]{2}))\Z".replace(b"[0-9a-f]", b"[0-9a-fA-F]")
    .replace(b"d[89ab]", b"[dD][89abAB]").replace(b"d[c-f]", b"[dD][c-fC-F]").replace(b"d[89a-f]", b"[dD][89a-fA-F]")
)
_ONE_UNICODE = re.compile(rb"\\u([0-9a-fA-F]{4})|\\U([0-9a-fA-F]{8})|\\x([0-9a-fA-F]{2})")
_PADDING = re.compile(rb"={0,2}")
_STANDARD = bytes.maketrans(b"-_", b"+/")
#: Runs that go on over line breaks, and the places in them where an encoding may start.
_WRAPPED = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)+")
#: A layer without any of these holds no finding and no layer.
_WORTH = re.compile(rb"(?i:passw|secret|token|api)|[%\\\n]|[A-Za-z0-9+/_-]{16}|[\t\r\x20-\x7e]\x00(?:[\t\r\x20-\x7e]\x00){5}|\x00[\t\r\x20-\x7e](?:\x00[\t\r\x20-\x7e]){5}")
_BREAK = re.compile(rb"[\x20\t]*\r?\n[\x20\t]*")
_SEPARATOR = re.compile(rb"[+/_-]")
#: ASCII in UTF-16 of either byte order.
_WIDE = (  # the first character stands alone: no repeat is begun where it does not fit
    re.compile(rb"[\t\n\r\x20-\x7e]\x00(?:[\t\n\r\x20-\x7e]\x00){5,}"), re.compile(rb"\x00[\t\n\r\x20-\x7e](?:\x00[\t\n\r\x20-\x7e]){5,}"),
)

#: Bytes of a compressed layer's contents that are looked at whole, what larger pieces share, and bytes inflated at a time.
WHOLE, OVERLAP, CHUNK = 8 << 20, 1 << 20, 1 << 16

SCHEMA = "doc_id long, findings array<struct<kind:string,start:long,end:long,depth:int,layers:string>>"


def _runs(body: bytes) -> list[tuple[int, int]]:
    """Where at least 16 characters of base64 stand in a row."""
    marks = np.frombuffer(body.translate(_RUN), dtype=np.uint8)
    stops = np.concatenate(([-1], np.flatnonzero(marks == 0), [len(marks)]))
    at = np.flatnonzero(np.diff(stops) > _SHORTEST_RUN)
    return list(zip((stops[at] + 1).tolist(), stops[at + 1].tolist(), strict=True))


def scan(body: bytes, runs: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """The base kinds in one layer as (kind, start, end) in bytes: leftmost, not overlapping per kind."""
    found = []
    lower = body.translate(LOWER)
    if any(part in lower for part in _KEYWORD_PARTS):
        free = 0
        for hit in _KEYWORDS.finditer(lower):
            if hit.start() >= free and (match := ASSIGN.match(body, hit.start())):
                free = match.end()
                if match.end(2) - match.start(2) >= LEAST["assign"]:
                    found.append(("assign", match.start(), match.end()))
    for start, end in runs:
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            if end - start >= LEAST[kind]:
                for match in pattern.finditer(body, start, end):
                    if match.end() - match.start() >= LEAST[kind]:
                        found.append((kind, match.start(), match.end()))
    return found


def _packed(data: bytes) -> bool:
    return data[:2] == b"\x1f\x8b" or (len(data) > 2 and data[0] & 15 == 8 and (data[0] << 8 | data[1]) % 31 == 0)


def _streams(source):
    """What the compressed streams at the start of ``source`` hold, one after another, as far as they are sound.

    ``source`` yields bytes, and so does this: never more than a chunk at a time.
    """
    source, held = iter(source), b""
    while True:
        while len(held) < 3 and (more := next(source, b"")):
            held += more
        if not _packed(held):
            return
        stream = zlib.decompressobj(47)
        try:
            while not stream.eof:
                held = held or next(source, b"")
                out = stream.decompress(held, CHUNK)
                if not held and not out:
                    return
                held = stream.unconsumed_tail
                if out:
                    yield out
        except zlib.error:
            return
        held = stream.unused_data


def _inflated(data: bytes) -> tuple[bytes, int, bool]:
    """What is left when compressed layers are taken off until none is left or one repeats, how many, and whether that is all.

    It is not where the contents of the next layer are more than WHOLE bytes.
    """
    seen, layers = set(), 0
    while _packed(data):
        mark = hashlib.sha256(data).digest()
        if mark in seen:
            break
        seen.add(mark)
        inner = bytearray()
        for out in _streams([data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]):
            inner += out
            if len(inner) > WHOLE:
                return data, layers, False
        if not inner:
            break
        data = bytes(inner)
        layers += 1
    return data, layers, True


def _contents(data: bytes):
    """(bytes, layers): compressed layers taken off until none is left or one repeats.

    Contents of more than WHOLE bytes come in pieces that overlap, however large they are:
    a finding or layer within that is longer than the overlap may be met in parts.
    """
    data, layers, all_of_it = _inflated(data)
    if all_of_it:
        yield data, layers
    else:
        yield from _pieces(data, layers)


def _pieces(data: bytes, layers: int):
    """The contents of large compressed layers: streams within streams are inflated side by side, a chunk at a time."""
    chunks, heads = iter([data]), set()
    while True:
        head = bytearray()
        for out in chunks:
            head += out
            if len(head) >= CHUNK:
                break
        mark = hashlib.sha256(head).digest()
        chunks = chain([bytes(head)], chunks)
        if not _packed(bytes(head[:3])) or mark in heads:
            break
        heads.add(mark)
        chunks = _streams(chunks)
        layers += 1
    held, last = bytearray(), None
    for out in chunks:
        held += out
        if len(held) >= WHOLE:
            piece = bytes(held)
            # long stretches of the same bytes are looked at once
            if (mark := hashlib.sha256(piece).digest()) != last:
                yield piece, layers
            last, held = mark, held[-OVERLAP:]
    if held:
        yield bytes(held), layers


def _is_text(data: bytes) -> bool:
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return sum(c.isprintable() or c.isspace() for c in text) >= 0.9 * len(text) > 0


def _replaced(body: bytes, starts, ends, pattern, decode):
    """The layer with all escapes decoded, and for each byte the span it comes from."""
    parts, froms, tos, at = [], [], [], 0
    for match in pattern.finditer(body):
        parts.append(body[at : match.start()])
        froms.append(starts[at : match.start()])
        tos.append(ends[at : match.start()])
        for piece, a, b in decode(match):
            parts.append(piece)
            froms.append(np.full(len(piece), starts[a]))
            tos.append(np.full(len(piece), ends[b - 1]))
        at = match.end()
    parts.append(body[at:])
    froms.append(starts[at:])
    tos.append(ends[at:])
    return b"".join(parts), np.concatenate(froms), np.concatenate(tos)


def _url_pieces(match):
    for a in range(match.start(), match.end(), 3):
        yield bytes([int(match.string[a + 1 : a + 3], 16)]), a, a + 3


def _url_end(tail: bytes):
    match = _URL_END.search(tail)
    return match and (3, bytes([int(match[1], 16)]))


def _unicode_end(tail: bytes):
    match = _UNICODE_END.search(tail)
    if not match:
        return None
    if match[1]:
        return 12, chr(0x10000 + (int(match[1], 16) - 0xD800 << 10) + int(match[2], 16) - 0xDC00).encode()
    code = int(match[3] or match[4] or match[5], 16)
    return (len(match[0]), chr(code).encode()) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def _fully_decoded(body: bytes, starts, ends, mark: bytes, reach: int, complete):
    """The layer with its escapes decoded until none is left, the spans of its bytes, and how many rounds that takes.

    One pass: an escape is decoded as soon as its last character is there, and what it
    gives may itself be part of the next one.  Escapes never overlap, so the order does
    not matter.  ``mark`` begins an escape, ``reach`` is how far back an open one may begin.
    """
    out, froms, tos, rounds = bytearray(), array("q"), array("q"), array("q")
    at, most = 0, 0
    while at < len(body):
        if out.find(mark, max(0, len(out) - reach)) < 0:
            # nothing can happen before the next mark
            stop = body.find(mark, at)
            stop = len(body) if stop < 0 else stop + 1
            out += body[at:stop]
            froms.frombytes(np.ascontiguousarray(starts[at:stop], dtype=np.int64).tobytes())
            tos.frombytes(np.ascontiguousarray(ends[at:stop], dtype=np.int64).tobytes())
            rounds.frombytes(bytes(8 * (stop - at)))
            at = stop
            continue
        out.append(body[at])
        froms.append(int(starts[at]))
        tos.append(int(ends[at]))
        rounds.append(0)
        at += 1
        while done := complete(bytes(out[-12:])):
            size, data = done
            depth, first, last = max(rounds[-size:]) + 1, froms[-size], tos[-1]
            most = max(most, depth)
            del out[-size:], froms[-size:], tos[-size:], rounds[-size:]
            out += data
            for _ in data:
                froms.append(first)
                tos.append(last)
                rounds.append(depth)
    return bytes(out), np.frombuffer(froms, dtype=np.int64), np.frombuffer(tos, dtype=np.int64), most


def _unicode_pieces(match):
    high = None
    for one in _ONE_UNICODE.finditer(match.string, match.start(), match.end()):
        code = int(next(g for g in one.groups() if g), 16)
        if high is not None and 0xDC00 <= code < 0xE000:
            yield chr(0x10000 + (high[0] - 0xD800 << 10) + code - 0xDC00).encode(), high[1], one.end()
            high = None
            continue
        high = (code, one.start()) if 0xD800 <= code < 0xDC00 else None
        if high is None and code < 0x110000 and not 0xD800 <= code < 0xE000:
            yield chr(code).encode(), one.start(), one.end()


#: (name, first character, pattern, pieces of a match, how far back an open one begins, the one that a tail completes)
ESCAPES = (("url", b"%", _URL, _url_pieces, 2, _url_end), ("unicode", b"\\", _UNICODE, _unicode_pieces, 11, _unicode_end))


def _unwrapped(body: bytes, starts, ends, runs, path: str = ""):
    """The layers directly under one: (name, bytes, starts, ends).

    Escapes of escapes are decoded once, and to their end in one pass; the layers between,
    of which there may be as many as a third of the text's bytes, differ in escapes only.
    """
    for name, mark, pattern, pieces, reach, complete in ESCAPES:
        if mark not in body or path.endswith(name) or not pattern.search(body):
            continue
        once = _replaced(body, starts, ends, pattern, pieces)
        yield name, *once
        if pattern.search(once[0]):
            *whole, rounds = _fully_decoded(body, starts, ends, mark, reach, complete)
            yield "/".join([name] * rounds) if rounds < 4 else f"{name}^{rounds}", *whole
    for data, layers in _contents(body):
        if layers:
            yield "compressed", data, np.broadcast_to(starts[0], len(data)), np.broadcast_to(ends[-1], len(data))
    for a, b in runs:
        yield from _decoded(body, a, b, starts, ends)
    if b"\n" in body:
        for match in _WRAPPED.finditer(body):
            if match.end() - match.start() > _SHORTEST_RUN:
                yield from _decoded(body, *match.span(), starts, ends)


def _named(layers: int) -> str:
    return "base64" + ("+compressed" * layers if layers < 4 else f"+compressed^{layers}")


def _decoded(body: bytes, a: int, b: int, starts, ends):
    """The layers that the base64 characters from ``a`` to ``b`` hold in each of the four alignments.

    A text or a compressed stream that fills them has their whole span; otherwise each
    byte has that of its own characters, and a stream within, behind a separator or a line
    break, that from there to the end.
    """
    breaks = [m.span() for m in _BREAK.finditer(body, a, b)]
    pieces = list(zip([a, *(e for _, e in breaks)], [*(s for s, _ in breaks), b], strict=True))
    run = b"".join([body[x:y] for x, y in pieces])
    if len(run) < _SHORTEST_RUN:
        return
    padded = _PADDING.match(body, b).end()
    lines = list(accumulate(y - x for x, y in pieces[:-1]))
    marks = [0, *(m.end() for m in _SEPARATOR.finditer(run)), *lines]
    run, places = run.translate(_STANDARD), None
    for shift in range(4):
        part = run[shift:]
        part = part[: len(part) - (len(part) % 4 == 1)]
        if not part:
            continue
        try:
            data = base64.b64decode(part + b"=" * (-len(part) % 4))
        except (binascii.Error, ValueError):
            continue
        if not shift:
            whole = False
            for inner, layers in _contents(data):
                if layers or _is_text(inner):
                    yield _named(layers), inner, np.broadcast_to(starts[a], len(inner)), np.broadcast_to(ends[padded - 1], len(inner))
                    whole = not layers
            if whole:
                continue
        inside = {(m - shift) // 4 * 3 for m in marks if m > shift and (m - shift) % 4 == 0}
        inside |= {m.start() for m in re.finditer(rb"\x1f\x8b\x08", data)} | ({0} if shift else set())
        packed = [first for first in sorted(inside) if _packed(data[first : first + 3])]
        worth = _WORTH.search(data)
        if not worth and not packed:
            continue
        if places is None:
            places = np.concatenate([np.arange(x, y) for x, y in pieces])
        at = np.arange(len(data))
        head = shift + at // 3 * 4 + at % 3
        if worth:
            yield "base64", data, starts[places[head]], ends[places[np.minimum(head + 1, len(run) - 1)]]
        for first in packed:
            for inner, layers in _contents(data[first:]):
                if layers:
                    froms = np.broadcast_to(starts[places[head[first]]], len(inner))
                    yield _named(layers), inner, froms, np.broadcast_to(ends[padded - 1], len(inner))


def _narrowed(body: bytes, starts, ends):
    """The stretches of UTF-16 in a decoded layer, as ASCII."""
    for order, pattern in enumerate(_WIDE):
        for match in pattern.finditer(body):
            a, b = match.span()
            yield "utf-16", body[a + order : b : 2], starts[a:b:2], ends[a + 1 : b : 2]


def find_secrets(body: bytes) -> list[tuple[str, int, int, int, str]]:
    """All findings of one text: (kind, start, end, depth, layers), in code points of the text.

    Each layer is scanned for the base kinds.  What its URL escapes, Unicode escapes,
    base64 runs - also over line breaks, and in all four alignments - and compressed
    streams hold goes on the worklist, text or not, and the UTF-16 in it too, as a layer
    of its own, until no layer gives a new one; a layer seen before at the same place is
    not entered again, so cycles end.  A finding in a layer has the span of the text that
    it was decoded from; one that repeats a span of its kind is listed once, with the
    least depth.  Contents of compressed layers are inflated in a stream and looked at in
    pieces where they are large, so a small text that unfolds to gigabytes costs time, not memory.
    """
    runs = _runs(body)
    found = {(k, a, b): (0, "") for k, a, b in scan(body, runs)}
    if b"%" in body or b"\\" in body or runs or b"\n" in body or body[:2] in (b"\x1f\x8b",):
        here = np.arange(len(body) + 1)
        # a layer's own layers are made one at a time, so what is held is one layer for each step down
        work, seen = [("", body, _unwrapped(body, here[:-1], here[1:], runs))], set()
        while work:
            path, layer, inner = work[-1]
            if (one := next(inner, None)) is None:
                work.pop()
                continue
            name, data, froms, tos = one
            if not len(data):
                continue
            mark = hashlib.sha256(data).digest() + int(froms[0]).to_bytes(8, "big") + int(tos[-1]).to_bytes(8, "big")
            if data == layer or mark in seen:
                continue
            seen.add(mark)
            own, depth, below = _runs(data), len(work), f"{path}/{name}"
            for kind, a, b in scan(data, own):
                key = (kind, int(froms[a]), int(tos[b - 1]))
                if key not in found or depth < found[key][0]:
                    found[key] = (depth, below)
            work.append((below, data, chain(_unwrapped(data, froms, tos, own, below), _narrowed(data, froms, tos))))
    if not found:
        return []
    heads = np.cumsum((np.frombuffer(body, dtype=np.uint8) & 0xC0) != 0x80)
    point = lambda at: int(heads[at - 1]) if at else 0
    rows = [(k, point(a), point(b), depth, path[1:]) for (k, a, b), (depth, path) in found.items()]
    return sorted(rows, key=lambda r: (r[1], KINDS.index(r[0]), r[2]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, findings): the findings of every row, an empty list where there are none.

    Null and empty texts have no findings; a row that repeats is scanned again and
    listed again; an empty table gives none; other columns are not read.  Each text is
    scanned whole in the task that reads it, so nothing is shuffled.  ``findings`` has
    kind, start, end (code points, end exclusive), depth (0: the text itself) and the
    layers that were taken off, outermost first.
    """

    def process(key, body):
        yield key, [dict(zip(("kind", "start", "end", "depth", "layers"), r, strict=True)) for r in find_secrets(body)]

    return texts(docs, id_col, text_col).mapInArrow(by_rows(process, SCHEMA), SCHEMA)


def listed(findings: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ","
    )


def secret_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_decoded) from the findings of every text."""
    base = F.filter("findings", lambda f: f["depth"] == 0)
    count = lambda kind: F.size(F.filter("findings", lambda f: (f["depth"] == 0) & (f["kind"] == kind))).cast("long")
    return scan_secrets(docs).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("findings")).alias("spans"),
        (F.size("findings") - F.size(base)).cast("long").alias("n_decoded"),
    )


def redact(docs: DataFrame, mark: str = "[{kind}]") -> DataFrame:
    """The documents with every finding replaced by a mark of its kind; overlapping spans become one.

    Columns, rows and their types stay; ``n_chars`` follows the new text where there is
    such a column.  Null texts stay null.
    """
    fields = docs.columns
    marks = {k: mark.format(kind=k.upper()).encode() for k in KINDS}

    def cleaned(batches):
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index("text")
            out = []
            for text in batch.column(at).to_pylist():
                spans = find_secrets(text.encode()) if text else []
                if spans:
                    parts, free = [], 0
                    for kind, a, b, _, _ in spans:
                        if a >= free:
                            parts += [text[free:a], marks[kind].decode()]
                        free = max(free, b)
                    text = "".join([*parts, text[free:]])
                out.append(text)
            columns = [pa.array(out, type=batch.schema.field(at).type) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    result = docs.mapInArrow(cleaned, docs.schema)
    if "n_chars" in fields:
        result = result.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return result.select(*[f"`{c}`" for c in fields])
