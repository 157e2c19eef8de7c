"""Secrets in plain text and below layers of encoding.

``find_secrets`` keeps a worklist of layers. The first is the text itself. Each
layer is scanned, then unwrapped in every way that applies: percent escapes,
Unicode escapes, base64 runs, and what base64 holds when it is gzip, zlib or
zstandard data, all members and frames of it. New layers go back on the list
until nothing new appears; a digest per layer stops cycles. Every layer knows,
for each of its characters, the span of the original text it came from; a
compressed layer stands for its whole run. So every finding is a span of the
original text.

Escapes may be nested thousands of times in one place (``%252525...41``). A layer
with escapes gives the layer of one step (each kind of escape by itself) and, if
escapes are left in that, the layer in which all of them are undone; what lies
between is no layer. A finding of such a form in between shows in the last form
or in the first two as well, with its neighbours if they became part of it.

Base64 may be wrapped: runs that only line ends part are also read as one, from
the start of each of them. A word in the line after a run cannot be told from
the run's last line, so a finding at the very end of a run can be there a second
time with a few characters more. Decoded bytes need be neither printable nor
UTF-8; those that are not UTF-8 are read as Latin-1.

Kinds and patterns are fixed by ``KINDS``. Base findings are those of the text
itself; layers only add spans. Null counts as empty. Nothing is cut: texts and
layers are scanned whole. ``n_unopened`` counts compressed data that could not
be treated so: data that breaks off with an error (what came before is scanned),
and data that grows beyond ``MAX_EXPANDED`` bytes, which is scanned in
overlapping chunks, up to ``MAX_STREAMED`` bytes a text (a decompression bomb
would not end). A base64 run that is open where a chunk ends is cut between two
groups of four characters, so the next chunk reads on in the same phase.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimloom.llm.batches import pieces

MAX_EXPANDED = 1 << 26
MAX_STREAMED = 1 << 32
CHUNK, OVERLAP = 1 << 24, 1 << 20  # characters, of expansions beyond MAX_EXPANDED
MASK = "[SECRET]"

# What counts as a secret, by kind, and the length a finding needs.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
_WRAPPED = re.compile(  # pieces parted by line ends; possessive, so that long runs are passed once
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+(?:\r\n?|\n)[ \t]*+[A-Za-z0-9+/_-]++)++"
    r"(?:(?:[ \t]*+(?:\r\n?|\n)[ \t]*+)?=){0,2}"
)
_LEAST_RUN = 19  # fewer characters hold fewer than 14 bytes, which neither are a finding nor hold one
_OPEN = re.compile(  # a run at the end of a text, read backwards
    r"[A-Za-z0-9+/_-]*+(?:[ \t]*+(?:\n\r?+|\r)[ \t]*+[A-Za-z0-9+/_-]++)*+"
)
_ALPHABET = np.array([re.fullmatch(r"[A-Za-z0-9+/_-]", chr(i)) is not None for i in range(256)])
_BLANKS = re.compile(r"\x20{2,}")


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the whole match, leftmost and non-overlapping per kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


@dataclass
class Layer:
    """Text of a layer; character i comes from starts[i] to ends[i] of the original text, or all from ``whole``."""

    text: str
    starts: np.ndarray | None = None  # None: the text itself
    ends: np.ndarray | None = None
    whole: tuple[int, int] | None = None
    unescaped: bool = False  # its escapes are undone by a layer beside it

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())


class _Builder:
    """Collects a new layer's characters with the parent spans they stand for."""

    def __init__(self, parent: Layer):
        self.parent, self.parts, self.starts, self.ends = parent, [], [], []

    def copy(self, start: int, end: int) -> None:
        if end > start:
            parent = self.parent
            self.parts.append(parent.text[start:end])
            if parent.whole:
                return
            self.starts.append(np.arange(start, end) if parent.starts is None else parent.starts[start:end])
            self.ends.append(np.arange(start + 1, end + 1) if parent.ends is None else parent.ends[start:end])

    def put(self, text: str, bounds: list[tuple[int, int]]) -> None:
        """``bounds``: the parent span of each character of ``text``."""
        if text:
            self.parts.append(text)
            if self.parent.whole:
                return
            origins = [self.parent.origin(a, b) for a, b in bounds]
            self.starts.append(np.array([a for a, _ in origins]))
            self.ends.append(np.array([b for _, b in origins]))

    def layer(self) -> Layer:
        if self.parent.whole:
            return Layer("".join(self.parts), whole=self.parent.whole)
        if not self.parts:
            return Layer("", np.zeros(0, int), np.zeros(0, int))
        return Layer("".join(self.parts), np.concatenate(self.starts), np.concatenate(self.ends))


def _characters(data: bytes) -> tuple[str, list[int]]:
    """Text of the data, Latin-1 if it is not UTF-8, and where each character begins."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return data.decode("latin-1"), list(range(len(data) + 1))
    places = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return text, [*places.tolist(), len(data)]


def _unescape_percent(layer: Layer) -> Layer | None:
    out, end = _Builder(layer), 0
    for m in _PERCENT.finditer(layer.text):
        text, places = _characters(bytes.fromhex(m[0].replace("%", "")))
        out.copy(end, m.start())
        out.put(text, [(m.start() + 3 * a, m.start() + 3 * b) for a, b in zip(places, places[1:])])
        end = m.end()
    if not end:
        return None
    out.copy(end, len(layer.text))
    return out.layer()


def _unescape_unicode(layer: Layer) -> Layer | None:
    out, end, spans, codes = _Builder(layer), 0, [], []

    def flush() -> None:
        # surrogate halves that follow each other make one character
        i = 0
        while i < len(codes):
            pair = i + 1 < len(codes) and 0xD800 <= codes[i] < 0xDC00 <= codes[i + 1] < 0xE000
            code = 0x10000 + ((codes[i] - 0xD800) << 10) + codes[i + 1] - 0xDC00 if pair else codes[i]
            last = i + pair
            out.put(chr(code) if not 0xD800 <= code < 0xE000 else "\ufffd", [(spans[i][0], spans[last][1])])
            i = last + 1
        codes.clear(), spans.clear()

    for m in _UNICODE.finditer(layer.text):
        code = int(m[6]) if m[6] else int(next(filter(None, m.groups())), 16)
        if code > 0x10FFFF:
            continue
        if spans and spans[-1][1] != m.start():
            flush()
        out.copy(end, m.start())
        codes.append(code)
        spans.append(m.span())
        end = m.end()
        if not 0xD800 <= code < 0xDC00:
            flush()
    flush()
    if not end:
        return None
    out.copy(end, len(layer.text))
    return out.layer()


_TRIGGER = re.compile(r"[0-9A-Fa-f;}]|[^0-9A-Fa-f;}]+")  # what may end an escape, and what lies between
_ENTITY = re.compile(r"&#(?:[xX]([0-9A-Fa-f]{1,6})|([0-9]{1,7}));")
_BRACED = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}")
_FIXED = (("%", 1, 2), ("\\x", 2, 2), ("\\u", 2, 4), ("\\U", 2, 8))  # mark, its length, digits


def _closed_escape(out: list[str]) -> tuple[int, int] | None:
    """(characters, code) of the escape that the last character of ``out`` ends."""
    last = out[-1]
    if last in ";}":
        tail = "".join(out[-11:])
        at = tail.rfind("&#" if last == ";" else "\\u{")
        m = (_ENTITY if last == ";" else _BRACED).fullmatch(tail, at) if at >= 0 else None
        if m is None:
            return None
        code = int(m[2]) if last == ";" and m[2] else int(m[1], 16)
        return (len(m[0]), code) if code <= 0x10FFFF else None
    for mark, length, digits in _FIXED:
        size = length + digits
        if len(out) >= size and out[-size] == mark[0] and (length == 1 or out[-size + 1] == mark[1]):
            code = "".join(out[-digits:])
            if all(c in "0123456789abcdefABCDEF" for c in code) and int(code, 16) <= 0x10FFFF:
                return size, int(code, 16)
    return None


def _unescape_all(layer: Layer) -> Layer:
    """All escapes undone until none is left, in one pass over the text.

    A character that an escape stands for goes back on the end of what is read
    so far and may end another escape there. Escapes beyond ASCII, which no
    finding and no escape holds, become one character each.
    """
    out, firsts, lasts = [], array("q"), array("q")  # characters and the spans of the layer they stand for
    for m in _TRIGGER.finditer(layer.text):
        start, end = m.span()
        out.extend(m[0])
        if not layer.whole:
            firsts.extend(range(start, end))
            lasts.extend(range(start + 1, end + 1))
        while out[-1] in "0123456789abcdefABCDEF;}" and (escape := _closed_escape(out)):
            size, code = escape
            del out[-size:]
            out.append(chr(code) if not 0xD800 <= code < 0xE000 else "\ufffd")
            if not layer.whole:
                first, last = firsts[-size], lasts[-1]
                del firsts[-size:], lasts[-size:]
                firsts.append(first)
                lasts.append(last)
    text = "".join(out)
    if layer.whole:
        return Layer(text, whole=layer.whole, unescaped=True)
    first, last = np.array(firsts, int), np.array(lasts, int)
    if layer.starts is not None:
        first, last = layer.starts[first], layer.ends[last - 1]
    return Layer(text, first, last, unescaped=True)


def _unescaped(layer: Layer) -> Iterator[Layer]:
    """The layers of one step, and the last one if it takes more steps."""
    steps = [_unescape_percent(layer)] if "%" in layer.text else []
    steps += [_unescape_unicode(layer)] if "\\" in layer.text or "&#" in layer.text else []
    steps = [step for step in steps if step]
    if any(_PERCENT.search(step.text) or _UNICODE.search(step.text) for step in steps):
        steps.append(_unescape_all(layer))
    for step in steps:
        step.unescaped = True
        yield step


def _inflater(head: bytes):
    """What opens data with this head, or None."""
    if head[:4] == b"\x28\xb5\x2f\xfd" or (head[1:4] == b"\x2a\x4d\x18" and head[0] >> 4 == 5):
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj()
    if head[:2] == b"\x1f\x8b" or (len(head) > 2 and head[0] == 0x78 and int.from_bytes(head[:2]) % 31 == 0):
        return zlib.decompressobj(47)
    return None


class _Expansion:
    """What compressed data holds, all members and frames that follow each other, in small chunks."""

    STEP = 64  # bytes put in at once: even these can hold megabytes

    def __init__(self, source: Iterator[bytes]):
        self.source, self.consumed, self.broken, self.large = source, 0, False, False

    def _more(self, held: bytes, least: int) -> bytes:
        while len(held) < least and (more := next(self.source, None)) is not None:
            held += more
        return held

    def __iter__(self) -> Iterator[bytes]:
        from zstandard import ZstdError

        held, at, opened = b"", 0, False
        while True:
            held, at, padding = self._more(held[at:], 4), 0, 0
            while opened and held[:1] == b"\0":  # members may be padded with zeros
                bare = held.lstrip(b"\0")
                padding += len(held) - len(bare)
                held = self._more(bare, 4)
            machine = _inflater(held[:4])
            if machine is None:
                return
            self.consumed += padding
            got = False
            while not machine.eof:
                if at >= len(held):
                    held, at = self._more(b"", 1), 0
                    if not held:
                        return  # breaks off
                piece = held[at : at + self.STEP]
                try:
                    out = machine.decompress(piece)
                except (zlib.error, ZstdError):
                    self.broken = got
                    return
                at += len(piece)
                self.consumed += len(piece)
                got = got or bool(out)
                if out:
                    yield out
            at -= len(machine.unused_data)
            self.consumed -= len(machine.unused_data)
            opened = True


class _Tally:
    """Per text: expansions not scanned whole, bytes streamed so far."""

    def __init__(self):
        self.unopened, self.streamed = 0, 0


def _gathered(source: Iterator[bytes], limit: int) -> tuple[bytes, bool]:
    """The source's first bytes, a little over ``limit`` at most, and whether there may be more."""
    parts, size = [], 0
    for part in source:
        parts.append(part)
        size += len(part)
        if size > limit:
            return b"".join(parts), True
    return b"".join(parts), False


def _cut(text: str) -> int:
    """Where the next chunk begins: ``OVERLAP`` before the end, or a little earlier in the phase of an open run."""
    cut = max(len(text) - OVERLAP, 0)
    open_run = _OPEN.match(text[::-1])
    begin = len(text) - open_run.end()
    if begin >= cut:
        return cut
    held = np.frombuffer(text[begin:cut].encode("latin-1"), np.uint8)
    groups = np.flatnonzero(_ALPHABET[held])[::4]  # first characters of groups of four
    return begin + int(groups[-1]) if len(groups) else cut


def _expanded(data: bytes, tally: _Tally) -> tuple[Iterator[str], _Expansion] | None:
    """Texts that compressed data holds: one, or overlapping chunks of a large one."""
    if _inflater(data[:4]) is None:
        return None
    expansion = _Expansion(iter([data]))

    def texts() -> Iterator[str]:
        source = iter(expansion)
        first, large = _gathered(source, MAX_EXPANDED)
        expansion.large = large
        tally.unopened += large or expansion.broken
        if not large:
            if first:
                yield first.decode("latin-1")  # what is looked for is ASCII, and the bytes can be had again
            return
        if _inflater(first[:4]) is not None:  # large and compressed again
            source = iter(_Expansion(chain([first], source)))
            first, _ = _gathered(source, CHUNK)
        tail = ""
        while first and tally.streamed < MAX_STREAMED:
            for start in range(0, len(first), CHUNK):
                text = _BLANKS.sub(" ", tail + first[start : start + CHUNK].decode("latin-1"))
                yield text
                tail = text[_cut(text) :]
            tally.streamed += len(first)
            first, _ = _gathered(source, CHUNK)

    return texts(), expansion


def _base64_bytes(run: str) -> bytes:
    run = run.replace("-", "+").replace("_", "/")
    run = run[: len(run) - (len(run) % 4 == 1)]  # a single last character holds no byte
    return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)


def _decoded(layer: Layer, run: str, at: np.ndarray, end: int) -> Layer:
    """The bytes of a run as text; character i of the run stands at ``at[i]``, the run ends before ``end``."""
    data = _base64_bytes(run)
    text, places = _characters(data)
    if layer.whole:
        return Layer(text, whole=layer.whole)
    # every three bytes are four characters of the run
    places = np.array(places)
    first, last = places[:-1] // 3 * 4, -(-places[1:] // 3) * 4
    first, last = at[first], np.where(last < len(at), at[np.minimum(last, len(at)) - 1] + 1, end)
    if layer.starts is None:
        return Layer(text, first, last)
    return Layer(text, layer.starts[first], layer.ends[last - 1])


def _runs(text: str) -> Iterator[tuple[str, np.ndarray, int, list[int]]]:
    """(characters, their places, end, starts of pieces) of base64 runs, single ones and wrapped ones."""
    for m in _BASE64.finditer(text):
        run = m[0].rstrip("=")
        yield run, np.arange(m.start(), m.start() + len(run)), m.end(), [0]
    if "\n" in text or "\r" in text:
        for m in _WRAPPED.finditer(text):
            if m.end() - m.start() < _LEAST_RUN:
                continue
            spans = [p.span() for p in _PIECE.finditer(text, m.start(), m.end())]
            run = "".join([text[a:b] for a, b in spans])
            if len(run) >= _LEAST_RUN:
                starts = np.cumsum([0] + [b - a for a, b in spans[:-1]]).tolist()
                yield run, np.concatenate([np.arange(a, b) for a, b in spans]), m.end(), starts


def _decoded_runs(layer: Layer, tally: _Tally) -> Iterator[Layer]:
    """The layers that base64 runs hold, and those that compressed data in them holds."""
    for run, at, end, starts in _runs(layer.text):
        phases, opened = set(), 0
        for start in starts:
            if len(run) - start < 16:
                break
            if start >= opened and _inflater(_base64_bytes(run[start : start + 8])[:4]) is not None:
                data = _base64_bytes(run[start:])
                texts, expansion = _expanded(data, tally)
                span = None
                for text in texts:
                    if span is None:
                        opened = len(run) if expansion.large else min(start + -(-expansion.consumed // 3) * 4, len(run))
                        span = layer.origin(int(at[start]), end if opened == len(run) else int(at[opened - 1]) + 1)
                    yield Layer(text, whole=span)
                if span and expansion.consumed == len(data):
                    continue  # opened to its end
            if start % 4 not in phases:  # later starts of the same phase are read along
                phases.add(start % 4)
                yield _decoded(layer, run[start:], at[start:], end)


def _inner(layer: Layer, tally: _Tally) -> Iterator[Layer]:
    """The layers directly below a layer."""
    if not layer.unescaped:
        yield from _unescaped(layer)
    yield from _decoded_runs(layer, tally)
    if layer.whole and _inflater(layer.text[:4].encode("latin-1", "replace")) is not None:
        try:
            data = layer.text.encode("latin-1")
        except UnicodeEncodeError:
            return
        for text in _expanded(data, tally)[0]:
            yield Layer(text, whole=layer.whole)


def find_secrets(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    """(base findings, all findings, layers left unopened), in order of start, then kind."""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    text = text or ""
    base = sorted(scan(text), key=order)
    spans, tally, seen = set(base), _Tally(), set()
    worklist = [iter([Layer(text)])]  # layers are made as they are scanned, so large ones are not held together
    while worklist:
        if (layer := next(worklist[-1], None)) is None:
            worklist.pop()
            continue
        digest = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if layer.starts is not None or layer.whole:
            # the same text from another place is another finding, so the place belongs to the digest
            key = (digest, layer.origin(0, len(layer.text))) if layer.text else (digest, None)
            if key in seen:
                continue
            seen.add(key)
            spans.update((kind, *layer.origin(a, b)) for kind, a, b in scan(layer.text))
        worklist.append(_inner(layer, tally))
    return base, sorted(spans, key=order), tally.unopened


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def masked(text: str | None, spans: list[tuple[str, int, int]], mask: str = MASK) -> str | None:
    """``text`` with every span, overlapping ones together, replaced by ``mask``."""
    if not spans:
        return text
    out, end = [], 0
    for start, stop in sorted((a, b) for _, a, b in spans):
        if start >= end:
            out += [text[end:start], mask]
        end = max(end, stop)
    return "".join([*out, text[end:]])


def scan_documents(docs: DataFrame, text: str, keep: Mapping[str, Column]) -> DataFrame:
    """(columns of ``keep``, n_assign, n_access, n_hex, base_spans, spans, n_unopened) per row."""
    fields = "n_assign bigint, n_access bigint, n_hex bigint, base_spans string, spans string, n_unopened bigint"

    def describe(value):
        base, spans, unopened = find_secrets(value)
        counts = [sum(s[0] == kind for s in base) for kind in KINDS]
        return (*counts, joined(base), joined(spans), unopened)

    return _mapped(docs, text, keep, describe, fields)


def mask_secrets(docs: DataFrame, text: str, keep: Mapping[str, Column], mask: str = MASK) -> DataFrame:
    """(columns of ``keep``, masked, n_secrets, n_unopened) per row; null texts stay null."""

    def describe(value):
        _, spans, unopened = find_secrets(value)
        return masked(value, spans, mask), len(spans), unopened

    return _mapped(docs, text, keep, describe, "masked string, n_secrets bigint, n_unopened bigint")


_TYPES = {"bigint": pa.int64(), "string": pa.string()}


def _mapped(docs: DataFrame, text: str, keep: Mapping[str, Column], describe, fields: str) -> DataFrame:
    made = [f.split() for f in fields.split(", ")]

    def run(batches):
        for piece in pieces(batches):
            rows = list(zip(*map(describe, piece.column(0).to_pylist())))
            arrays = [pa.array(values, _TYPES[kind]) for values, (_, kind) in zip(rows, made)]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[1:], *arrays], names=[*piece.schema.names[1:], *(n for n, _ in made)]
            )

    rows = docs.select(F.col(text).alias("_text"), *[c.alias(name) for name, c in keep.items()])
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, ", ".join(x for x in (kept, fields) if x))
