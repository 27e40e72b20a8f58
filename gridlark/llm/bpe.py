"""BPE encoding and decoding (operator 6).

The codec reads a public vocabulary file and follows its normalizer, splitter
and byte alphabet. A piece is merged with a priority queue of (merge rank,
position) over a doubly linked list of symbols; entries whose symbols have
changed since they were queued are stale and skipped. Decoding concatenates
vocabulary strings with the file's separator (none of its decoders: one space).

Edge cases: a null or empty text has no tokens and decodes to an empty text;
the strings of special tokens in a text are those tokens; very long texts are
handled a white-space delimited word at a time.
"""

from __future__ import annotations

import hashlib
import json
import struct
import sys
import unicodedata
from array import array
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridlark.llm._shared import map_texts

#: Unicode White_Space, as a character class body. str.split() has these and four separators more.
WHITE = r"\x09-\x0d \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NOT_WHITE = regex.compile("[\x1c-\x1f]")
#: Words that a generation of a worker's memory holds.
CACHE_WORDS = 300_000
# What the library's tables have beyond Unicode 15.1, as first and last code points.
# Its letters and numbers are those of Unicode 16.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
# First and last code points that the library makes lower case, and what the first becomes (Unicode 17).
NEW_LOWER = [
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3),
    (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB),
]
# Marks younger than the library's composition tables (Unicode 9), which neither move nor join there.
YOUNG_MARKS = [
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xAFA, 0xAFF), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA), (0x1715, 0x1715), (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C),
    (0x10D24, 0x10D27), (0x10EAB, 0x10EAC), (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85), (0x11070, 0x11070), (0x1133B, 0x1133B),
    (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x11930, 0x11930), (0x1193D, 0x1193E), (0x11943, 0x11943), (0x119E0, 0x119E0), (0x11A34, 0x11A34), (0x11A47, 0x11A47),
    (0x11A99, 0x11A99), (0x11D42, 0x11D45), (0x11D97, 0x11D97), (0x11F41, 0x11F42), (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136),
    (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF), (0x1E4EC, 0x1E4EF),
]
LOWER_TABLE = {c: to + c - a for a, b, to in NEW_LOWER for c in range(a, b + 1)}


def class_body(ranges: list[tuple[int, int]]) -> str:
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in ranges)


def assigned(kind: str) -> list[tuple[int, int]]:
    """First and last code points of the runs whose general category begins with kind."""
    out: list[tuple[int, int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] == kind:
            if out and out[-1][1] == c - 1:
                out[-1] = out[-1][0], c
            else:
                out.append((c, c))
    return out


UPPER_YOUNG = regex.compile(f"[{class_body([(a, b) for a, b, _ in NEW_LOWER])}]")
YOUNG = regex.compile(f"([{class_body(YOUNG_MARKS)}])")

OUT = T.StructType([
    T.StructField("ids", T.BinaryType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("decoded", T.StringType()),
])


def byte_alphabet() -> dict[int, str]:
    """Printable Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def is_latin(text: str) -> bool:
    """Whether text is of Latin-1 alone, which NFC leaves as it is."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def composed(text: str) -> str:
    """NFC by the library's tables: nothing moves or joins across a mark that it does not know."""
    if YOUNG.search(text):
        return "".join([x if i % 2 else unicodedata.normalize("NFC", x) for i, x in enumerate(YOUNG.split(text))])
    return unicodedata.normalize("NFC", text)


def packed(ids: list[int]) -> bytes:
    """ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class BpeCodec:
    """Encodes and decodes by a vocabulary file with a normalizer and word ends."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: left id << 20 | right id to rank; rank to merged id
        self.ranks = {self.vocab[a] << 20 | self.vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [self.vocab[a + b] for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        steps = spec["normalizer"]["normalizers"] if spec["normalizer"]["type"] == "Sequence" else [spec["normalizer"]]
        self.nfc = any(s["type"] == "NFC" for s in steps)
        self.lower = any(s["type"] == "Lowercase" for s in steps)
        split = next(s for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")
        self.pattern = split["pattern"]["Regex"].replace(r"\s", WHITE)
        self.pieces = regex.compile(self.pattern)
        self._exact: regex.Pattern | None = None
        self.white = regex.compile(f"[{WHITE}]+")
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        alphabet = byte_alphabet()
        #: the symbol of each byte, and of each byte at a piece's end; None where the vocabulary has none
        self.first = [self.vocab.get(alphabet[b]) for b in range(256)]
        self.last = [self.vocab.get(alphabet[b] + self.suffix) for b in range(256)]
        self.cache_words = cache_words
        self.words: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Applies merges in order of rank, then place.

        An entry of the queue is one integer, rank << shift | place; it is stale
        if the pair now at that place has another rank.
        """
        n, rank, made = len(symbols), self.ranks.get, self.made
        shift = n.bit_length()
        mask = (1 << shift) - 1
        now = [rank(a << 20 | b, -1) for a, b in zip(symbols, symbols[1:])]
        queue = [r << shift | i for i, r in enumerate(now) if r >= 0]
        if not queue:
            return symbols
        now.append(-1)
        heapify(queue)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heappop(queue)
            i, r = entry & mask, entry >> shift
            if now[i] != r:
                continue
            j, new = right[i], made[r]
            symbols[i], symbols[j], now[j] = new, -1, -1
            k = right[i] = right[j]
            r = -1
            if k < n:
                left[k] = i
                r = rank(new << 20 | symbols[k], -1)
                if r >= 0:
                    heappush(queue, r << shift | i)
            now[i] = r
            h = left[i]
            if h >= 0:
                r = now[h] = rank(symbols[h] << 20 | new, -1)
                if r >= 0:
                    heappush(queue, r << shift | h)
        return [s for s in symbols if s >= 0]

    def split(self, text: str) -> list[str]:
        """The pieces of a word. Where a code point is too young for this Python's tables, letters and numbers are spelled out."""
        if text.isascii() or not any(unicodedata.category(c) == "Cn" for c in text):
            return self.pieces.findall(text)
        if self._exact is None:
            letters, numbers = class_body(assigned("L") + NEW_LETTERS), class_body(assigned("N") + NEW_NUMBERS)
            self._exact = regex.compile(self.pattern.replace(r"\p{L}", letters).replace(r"\p{N}", numbers))
        return self._exact.findall(text)

    def piece(self, text: str) -> list[int]:
        raw = text.encode()
        symbols = [self.first[b] for b in raw[:-1]]
        symbols.append(self.last[raw[-1]])
        if None in symbols:
            symbols = [s for s in symbols if s is not None]
        return self.merge(symbols) if len(symbols) > 1 else symbols

    def word(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers and token strings of text without white space.

        Two generations of words are remembered: when the younger is full, it
        takes the place of the older, so that frequent words stay.
        """
        made = self.older.get(text)
        if made is None:
            pieces = (text,) if text.isascii() and text.isalpha() else self.split(text)
            ids = [i for p in pieces for i in self.piece(p)]
            made = packed(ids), self.decode(ids)
        if len(text) <= 64:
            if len(self.words) >= self.cache_words:
                self.older = self.words.copy()
                self.words.clear()
            self.words[text] = made
        return made

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        plain = text.isascii() or is_latin(text)
        if self.nfc and not plain:
            text = composed(text)
        if self.lower:
            # character by character: a final capital sigma gets no form of its own
            text = text.replace("Σ", "σ").lower()
            if not plain and UPPER_YOUNG.search(text):
                text = text.translate(LOWER_TABLE)
        known, word = self.words, self.word
        if NOT_WHITE.search(text):
            return [known.get(w) or word(w) for w in self.white.sub(" ", text).split(" ") if w]
        return [known.get(w) or word(w) for w in text.split()]

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """Ids as bytes, and the decoded text."""
        if self.cut is not None and "<|" in text or self.cut is not None and any(s in text for s in self.special):
            parts = []
            for i, x in enumerate(self.cut.split(text)):
                if i % 2:
                    parts.append((packed([self.special[x]]), x))
                else:
                    parts.extend(self._plain(x))
        else:
            parts = self._plain(text)
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts if p[0]])

    def encode(self, text: str) -> list[int]:
        raw = self.encode_decode(text)[0]
        return list(struct.unpack(f"<{len(raw) // 4}I", raw))

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids])


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """docs with ids (little-endian unsigned 32-bit integers), n_tokens and decoded."""

    def start():
        codec = BpeCodec(path)

        def work(column):
            both = [codec.encode_decode(t) for t in column]
            return {"ids": [b[0] for b in both], "n_tokens": [len(b[0]) // 4 for b in both], "decoded": [b[1] for b in both]}

        return work

    return map_texts(docs, start, OUT)


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """As encode_documents, with SHA-256 of ids and decoded text in their place."""
    out = T.StructType([
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ])

    def start():
        codec = BpeCodec(path)

        def work(column):
            made = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for t in column:
                ids, decoded = codec.encode_decode(t)
                made["n_tokens"].append(len(ids) // 4)
                made["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                made["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            return made

        return work

    return map_texts(docs, start, out)
