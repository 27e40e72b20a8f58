"""Secret scans with a recursive decoding worklist (operator 2).

A document is the first layer. From every layer, lines with URL or Unicode
escapes and runs of base64 characters are decoded, also those wrapped over
consecutive lines and those that begin inside a longer run, and what a run decodes to is
unpacked for as long as it is compressed. Of bytes that are no readable UTF-8
the runs of ASCII are taken, since no pattern has other characters, and what
looks like UTF-16. Each new layer is scanned and put on the
worklist; a layer whose content and place have been seen is not taken up again,
so the work ends. Every character of a layer knows which characters of the
document it comes from, so findings in a layer become spans of the document.
An escape that was escaped again, however often, is resolved at once.

Layers of compressed bytes are unpacked by a list of open layers, not by calls in
calls: their number is not bounded. A run's bytes are decoded once for each
alignment; a place that looks packed is read from there, its header is checked
first, and places whose headers lead to the same data are tried once. What
unpacks to more than PIECE bytes is streamed and scanned in pieces that overlap,
cut where no base64 run goes on, so that a secret of at most OVERLAP bytes and a
base64 run of at most LONGEST_RUN are found wherever they stand.

Guards, which n_guarded counts where they left something out: a document is
unpacked to MAX_INFLATED bytes at most, against bombs; an xz or zstd stream that
asks for more than MEMORY bytes is skipped; a base64 run inside a stream is cut
at LONGEST_RUN; a nested stream that fails after PIECE bytes is not scanned as
plain bytes.

Edge cases: a null text is an empty text; undecodable runs make no layer; repeated
rows are scanned alike.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from itertools import chain, repeat

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridlark.llm._shared import map_texts

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
WORDS = ("passw", "secret", "token", "key")

ESCAPED = re.compile(r"%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Runs on consecutive lines, and the line breaks between them.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
BREAKS = re.compile(r"[ \t]*\r?\n[ \t]*")
#: What the first bytes of compressed formats are in base64.
PACKED = re.compile(r"(?=H4sI|Qlpo|/Td6WFoA|KLUv/|eA[E-H]|eF[4-7]|eJ[w-z]|eN[o-r])")
#: Bytes that a document's streams may unpack to; bytes of a piece, those that it shares with the next one, and those of a base64 run that it may be longer by.
MAX_INFLATED, PIECE, OVERLAP, LONGEST_RUN = 1 << 30, 16 << 20, 1 << 16, 64 << 20
#: Bytes that unpacking a stream may take: enough for the highest presets.
MEMORY = 128 << 20

OUT = T.StructType([
    T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()), T.StructField("n_hex", T.LongType()),
    T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_layers", T.LongType()), T.StructField("n_guarded", T.LongType()),
])


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the secrets of one layer."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _code(escape: str) -> int:
    """The byte (for % and \\x) or code point that an escape stands for."""
    if escape[0] == "%":
        return int(escape[1:], 16)
    if escape[0] == "&":
        body = escape[2:-1]
        return int(body[1:], 16) if body[0] in "xX" else int(body)
    return int(escape[3:-1] if escape[2] == "{" else escape[2:], 16)


def _resolved(line: str, m: re.Match) -> tuple[int, bool, int]:
    """What the escape m stands for, whether that is a byte, and where it ends: as long as it begins another escape, that one counts."""
    code, is_byte, end = _code(m[0]), m[0][0] == "%", m.end()
    while code in (0x25, 0x26, 0x5C):
        more = ESCAPED.match(chr(code) + line[end : end + LONGEST_ESCAPE])
        if not more:
            break
        end += more.end() - 1
        code, is_byte = _code(more[0]), more[0][0] == "%"
    return code, is_byte, end


LONGEST_ESCAPE = 11


def _unescape(line: str, starts, ends):
    """A line with its escapes resolved, and where each character comes from."""
    chars, s, e, at = [], [], [], 0
    run: list[tuple[int, int, int]] = []  # neighbouring bytes make characters together: (byte, start, end)

    def put(c: str, a: int, b: int) -> None:
        chars.append(c)
        s.append(starts[a])
        e.append(ends[b - 1])

    def put_run() -> None:
        k, raw = 0, bytes(x[0] for x in run)
        while k < len(raw):
            size = 1 if raw[k] < 0x80 else 2 if raw[k] < 0xE0 else 3 if raw[k] < 0xF0 else 4
            try:
                c = raw[k : k + size].decode()
            except UnicodeDecodeError:
                size, c = 1, chr(raw[k])
            put(c, run[k][1], run[min(k + size, len(run)) - 1][2])
            k += size
        run.clear()

    m = ESCAPED.search(line)
    while m:
        a = m.start()
        if run and run[-1][2] != a:
            put_run()
        chars += line[at:a]
        s.extend(starts[at:a])
        e.extend(ends[at:a])
        code, is_byte, at = _resolved(line, m)
        if is_byte:
            run.append((code, a, at))
        else:
            if run:
                put_run()
            if code < 0x110000 and not 0xD800 <= code < 0xE000:
                put(chr(code), a, at)
        m = ESCAPED.search(line, at)
    if run:
        put_run()
    chars += line[at:]
    return "".join(chars), np.array(s + list(starts[at:]), np.int64), np.array(e + list(ends[at:]), np.int64)


class Budget:
    """Bytes that a document may still unpack to, and what guards have left out."""

    def __init__(self):
        self.left, self.guarded = MAX_INFLATED, 0


def _deflated(raw: bytes, at: int) -> bool:
    """Whether a first block of deflated data can begin here."""
    head = raw[at : at + 5]
    kind = head[0] >> 1 & 3 if head else 3
    if kind == 0:
        return len(head) < 5 or int.from_bytes(head[1:3], "little") ^ int.from_bytes(head[3:5], "little") == 0xFFFF
    return kind == 1 or kind == 2 and head[0] >> 3 <= 29 and (len(head) < 2 or head[1] & 31 <= 29)


def _packed(raw: bytes, at: int, zeros: np.ndarray | None = None) -> tuple[str, int] | None:
    """The format that begins at a place, and where its decoder is to begin, if the header is one. zeros: places of zero bytes, sorted."""
    def after_zero(i: int) -> int:
        if zeros is None:
            return raw.find(b"\0", i) + 1
        k = int(np.searchsorted(zeros, i))
        return int(zeros[k]) + 1 if k < len(zeros) else 0

    head = raw[at : at + 18]
    if head[:3] == b"\x1f\x8b\x08" and len(head) > 10 and not head[3] & 0xE0:
        i, flags = at + 10, head[3]
        if flags & 4:
            i += 2 + int.from_bytes(raw[i : i + 2], "little")
        for bit in (8, 16):
            if flags & bit and not (i := after_zero(i)):
                return None
        i += 2 if flags & 2 else 0
        return ("gzip", i) if _deflated(raw, i) else None
    if head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0 and not head[1] & 0x20:
        return ("zlib", at + 2) if _deflated(raw, at + 2) else None
    if head[:3] == b"BZh" and head[3:4].isdigit() and head[4:10] in (b"1AY&SY", b"\x17rE8P\x90"):
        return "bz2", at
    if head[:6] == b"\xfd7zXZ\0" and len(head) > 12 and zlib.crc32(head[6:8]) == int.from_bytes(head[8:12], "little"):
        return "xz", at
    if head[:4] == b"\x28\xb5\x2f\xfd" and len(head) > 6 and not head[4] & 8:
        return "zstd", at
    return None


class _Source:
    """Chunks of bytes with a buffer before them."""

    def __init__(self, chunks):
        self.chunks, self.buf, self.over, self.given = iter(chunks), b"", False, 0
        #: A stream that is being read from here, and whether the rest is no more tried as one.
        self.stream: _Stream | None = None
        self.plain = False

    def fill(self, n: int) -> None:
        """At least n bytes in the buffer, or all there are."""
        if len(self.buf) >= n or self.over:
            return
        held = [self.buf]
        many = len(self.buf)
        while many < n:
            chunk = next(self.chunks, None)
            if chunk is None:
                self.over = True
                break
            held.append(chunk)
            many += len(chunk)
            self.given += len(chunk)
        self.buf = b"".join(held)

    def take(self) -> bytes:
        """What the buffer has, else the next chunk; nothing at the end."""
        if not self.buf and not self.over:
            self.buf = next(self.chunks, b"")
            self.over, self.given = not self.buf, self.given + len(self.buf)
        out, self.buf = self.buf, b""
        return out


class _Stream:
    """What a source unpacks to, in chunks. At its end the source has the bytes that are left: those after the stream, or all of them if it has failed."""

    def __init__(self, src: _Source, kind: str, start: int, budget: Budget):
        self.src, self.kind, self.start, self.budget = src, kind, start, budget
        self.failed = self.ended = False
        self.chunks = self._run()

    def _feed(self, d, piece: bytes):
        if self.kind == "zstd":
            yield d.decompress(piece)
        elif self.kind in ("gzip", "zlib"):
            while piece:
                yield d.decompress(piece, OUT_BYTES)
                piece = d.unconsumed_tail
        else:
            yield d.decompress(piece, OUT_BYTES)
            while not d.eof and not d.needs_input:
                yield d.decompress(b"", OUT_BYTES)

    def _run(self):
        src, fed, many = self.src, [], 0
        try:
            if self.kind == "bz2":
                d = bz2.BZ2Decompressor()
            elif self.kind == "xz":
                d = lzma.LZMADecompressor(memlimit=MEMORY)
            elif self.kind == "zstd":
                d = zstandard.ZstdDecompressor(max_window_size=MEMORY).decompressobj()
            else:
                d = zlib.decompressobj(-15)
            step = ZSTD_STEP if self.kind == "zstd" else STEP
            while chunk := src.take():
                at, many = (self.start if not many else 0), many + len(chunk)
                if many <= PIECE + OVERLAP or not fed:
                    fed.append(chunk)
                for i in range(at, len(chunk), step):
                    idle = step
                    for out in self._feed(d, chunk[i : i + step]):
                        self.budget.left -= len(out)
                        idle -= len(out)
                        if out:
                            yield out
                        if self.budget.left < 0:
                            self.budget.guarded += 1
                            src.buf, src.over, src.chunks = b"", True, iter(())
                            return
                    self.budget.left -= max(0, idle)  # reading that gives nothing counts too
                    if d.eof:
                        src.buf = d.unused_data + chunk[i + step :]
                        # checksums behind raw data
                        trailer = {"gzip": 8, "zlib": 4}.get(self.kind, 0)
                        src.fill(trailer)
                        src.buf = src.buf[trailer:]
                        self.ended = True
                        return
        except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError, MemoryError) as e:
            self.failed = True
            if "emory" in str(e) or "window" in str(e).lower():
                self.budget.guarded += 1
            if sum(map(len, fed)) == many:
                src.buf = b"".join(fed) + src.buf
            else:
                self.budget.guarded += 1


#: Bytes given to a decompressor at once, fewer where it can't be told how much to give back; and bytes that it gives back.
STEP, ZSTD_STEP, OUT_BYTES = 1 << 12, 1 << 8, 1 << 20
#: Where a base64 run, on one line or several, has ended.
RUN_END = re.compile(rb"[^A-Za-z0-9+/\-_=\r\n\t ]|(?<=[^\r\n\t ])[\t ]+(?=[^\r\n\t ])")


def _pieces(src: _Source, budget: Budget):
    """A source's bytes to its end, in pieces that overlap and split no base64 run that is not too long."""
    while True:
        src.fill(PIECE + 1)
        if len(src.buf) <= PIECE:
            if src.buf:
                yield src.buf
            src.buf = b""
            return
        cut, end = PIECE, None
        if not RUN_END.match(src.buf, PIECE):
            searched = PIECE
            while end is None and searched < PIECE + LONGEST_RUN:
                src.fill(min(searched + (1 << 20), PIECE + LONGEST_RUN))
                end = RUN_END.search(src.buf, searched)
                if end is None and src.over:
                    yield src.buf
                    src.buf = b""
                    return
                searched = len(src.buf)
            cut = end.start() if end else searched
            budget.guarded += end is None
        yield src.buf[:cut]
        src.buf = src.buf[max(1, cut - OVERLAP) :]


def _contents(first: _Source, budget: Budget):
    """Pieces of a source's bytes, unpacked until none begins as a compressed format does.

    The open layers are a list: the last one is read; when it has no more, the one
    below goes on with what its stream left.
    """
    open_, seen = [first], set()
    while open_:
        src = open_[-1]
        if src.stream is not None:
            # the layer above has read the stream to its end
            src.plain, src.stream = src.plain or src.stream.failed, None
        src.fill(PIECE)
        if not src.buf:
            open_.pop()
            continue
        if not src.plain:
            mark = xxhash.xxh3_128_digest(src.buf)
            here = None if mark in seen else _packed(src.buf, 0)
            if here is not None:
                seen.add(mark)
                src.stream = _Stream(src, *here, budget)
                # a small layer is unpacked whole, so that its stream is closed before the next one is opened
                held, many = [], 0
                for out in src.stream.chunks:
                    held.append(out)
                    many += len(out)
                    if many > PIECE:
                        break
                more = src.stream.chunks if many > PIECE else ()
                if many <= PIECE:
                    src.plain, src.stream = src.plain or src.stream.failed, None
                    if not src.buf and src.over:
                        open_.pop()
                if held:
                    open_.append(_Source(chain([b"".join(held)], more)))
                continue
        yield from _pieces(src, budget)
        open_.pop()


def _whole(raw: bytes) -> bytes:
    """raw without the parts of characters at its ends that a cut has left."""
    a = next((k for k in range(min(4, len(raw))) if raw[k] & 0xC0 != 0x80), 0)
    b = next((k for k in range(1, min(4, len(raw)) + 1) if raw[-k] & 0xC0 != 0x80), 0)
    if b and raw[-b] >= 0xC0 and b < (2 if raw[-b] < 0xE0 else 3 if raw[-b] < 0xF0 else 4):
        return raw[a : len(raw) - b]
    return raw[a:]


def _readable(raw: bytes) -> str | None:
    """raw as text if it is UTF-8 without control characters."""
    if not raw or raw.translate(None, CONTROL) != raw:
        return None
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return None


CONTROL = bytes(b for b in [*range(32), 127] if b not in b"\t\n\r\x0b\x0c")
#: The shortest secret has 14 characters, and so has at least what it is escaped or encoded to.
ASCII = re.compile(rb"[\t\n\r\x20-\x7e]{14,}")
#: As much in characters of two bytes, the lower or the higher one first.
WIDE = re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){14}|(?:\x00[\t\n\r\x20-\x7e]){14}")


def _texts(raw: bytes):
    """raw as texts in which secrets can stand, with the place of the first byte of each character and of the last one's end: UTF-8, else its runs of ASCII; UTF-16."""
    plain = _readable(raw)
    if plain is not None:
        if len(plain) == len(raw):
            yield plain, np.arange(len(raw) + 1)
        else:
            code = np.frombuffer(plain.encode("utf-32-le"), np.uint32)
            yield plain, np.r_[0, np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))]
    else:  # nothing that is looked for has other characters
        for m in ASCII.finditer(raw):
            yield m[0].decode(), np.arange(m.start(), m.end() + 1)
    if b"\x00" in raw and (m := WIDE.search(raw)):
        at = m.start() % 2
        body = raw[at : at + (len(raw) - at) // 2 * 2]
        wide = body.decode("utf-16-be" if m[0][:1] == b"\x00" else "utf-16-le", "replace")
        code = np.frombuffer(wide.encode("utf-32-le"), np.uint32)
        yield wide, np.r_[at, at + np.cumsum(2 + 2 * (code >= 0x10000))]


class _Same:
    """A value many times over, as a sequence."""

    def __init__(self, value: int, n: int):
        self.value, self.n = value, n

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i):
        if isinstance(i, slice):
            return _Same(self.value, len(range(*i.indices(self.n))))
        return _Same(self.value, len(i)) if isinstance(i, np.ndarray) else self.value

    def __iter__(self):
        return repeat(self.value, self.n)


def _layers(text: str, starts, ends, budget: Budget):
    """The layers that a layer wraps: (text, starts, ends)."""
    if "%" in text or "\\" in text or "&#" in text:
        at = 0
        for line in text.split("\n"):
            if ESCAPED.search(line):
                yield _unescape(line, starts[at : at + len(line)], ends[at : at + len(line)])
            at += len(line) + 1
    for m in RUN.finditer(text):
        run = m[0].rstrip("=")
        yield from _decoded(run, np.arange(m.start(), m.start() + len(run)), starts, ends, budget)
    if "\n" in text:
        for m in WRAPPED.finditer(text):
            whole = m[0].rstrip("=")
            run, places, at = [], [], 0
            for x in BREAKS.finditer(whole):
                run.append(whole[at : x.start()])
                places += range(m.start() + at, m.start() + x.start())
                at = x.end()
            run.append(whole[at:])
            places += range(m.start() + at, m.start() + len(whole))
            if len(places) >= 16:
                yield from _decoded("".join(run), np.array(places), starts, ends, budget)


def _bytes_of(run: str) -> bytes:
    """The bytes of a base64 run; a last character that makes no byte is left out."""
    n = len(run) - (len(run) % 4 == 1)
    return binascii.a2b_base64(run[:n] + "=" * (-n % 4))


def _decoded(run: str, places: np.ndarray, starts, ends, budget: Budget):
    """The layers in a base64 run, whose characters stand at places: each alignment as text, and all that begins as a compressed format does."""
    run = run.translate(URL_SAFE)
    raws = [_bytes_of(run[phase:]) for phase in range(4)]
    for phase, raw in enumerate(raws):
        for plain, at in _texts(raw) if not phase or ASCII.search(raw) or b"\x00" in raw else ():
            first = places[phase + at[:-1] * 4 // 3]
            last = places[np.minimum(len(run) - 1, phase + (at[1:] * 4 + 2) // 3 - 1)]
            yield plain, starts[first], ends[last]
    zeros: list[np.ndarray | None] = [None] * 4
    done, tried = 0, set()
    for m in PACKED.finditer(run):
        if m.start() < done:
            continue
        phase, at = m.start() % 4, m.start() // 4 * 3
        raw = raws[phase]
        if zeros[phase] is None:
            zeros[phase] = np.flatnonzero(np.frombuffer(raw, np.uint8) == 0)
        while (found := _packed(raw, at, zeros[phase])) is not None and (phase, *found) not in tried:
            tried.add((phase, *found))
            src = _Source(raw[i : i + READ] for i in range(found[1], len(raw), READ))
            stream = _Stream(src, found[0], 0, budget)
            inner = _Source(stream.chunks)
            inner.fill(1)
            if not inner.buf and stream.failed:
                break  # as nearly all that only look packed
            for piece in _contents(inner, budget):
                for plain, _ in _texts(_whole(piece)):
                    yield plain, _Same(starts[places[m.start()]], len(plain)), _Same(ends[places[-1]], len(plain))
            if not stream.ended:
                break
            # what begins inside the stream has been unpacked with it
            at = found[1] + src.given - len(src.buf)
            done = max(done, m.start(), phase + at // 3 * 4)


#: Bytes of a run that a decoder is given at a time.
READ = 1 << 16
URL_SAFE = str.maketrans("-_", "+/")


def find(text: str, budget: Budget | None = None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """Base spans, all spans and the number of layers below the text."""
    budget = budget or Budget()
    base = scan(text)
    spans, seen, n = set(base), set(), 0
    work = [(text, np.arange(len(text)), np.arange(1, len(text) + 1))] if MAYBE.search(text) else []
    while work:
        for layer, s, e in _layers(*work.pop(), budget):
            if not layer:
                continue
            mark = (hashlib.blake2b(layer.encode("utf-8", "replace"), digest_size=16).digest(), int(s[0]), int(e[-1]))
            if mark in seen:
                continue
            seen.add(mark)
            n += 1
            spans.update((int(s[a]), kind, int(e[b - 1])) for a, kind, b in scan(layer))
            work.append((layer, s, e))
    return base, sorted(spans), n


#: What a text has at least if anything can be decoded from it: an escape, or letters enough for a run on one line or several.
MAYBE = re.compile(r"%[0-9A-Fa-f]|\\[ux]|&#|[A-Za-z0-9+/_-]{16}|[A-Za-z0-9+/_-]\s*\n\s*[A-Za-z0-9+/_-]")


def write_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])


def scan_documents(docs: DataFrame) -> DataFrame:
    """docs with base counts, base_spans, spans (kind:start:end), n_layers and n_guarded, what guards have left out."""

    def start():
        def work(column):
            made = {f.name: [] for f in OUT}
            for t in column:
                budget = Budget()
                base, spans, n = find(t, budget)
                for i, k in enumerate(KINDS):
                    made[f"n_{k}"].append(sum(x[1] == i for x in base))
                made["base_spans"].append(write_spans(base))
                made["spans"].append(write_spans(spans))
                made["n_layers"].append(n)
                made["n_guarded"].append(budget.guarded)
            return made

        return work

    return map_texts(docs, start, OUT)
