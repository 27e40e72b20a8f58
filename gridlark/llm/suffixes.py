"""Suffix-array dedup (operator 8): a merge sort of suffixes that knows common prefixes.

A byte is removed if a WINDOW-byte string that covers it also starts in a
document with a smaller doc_id. Of the suffixes of a text only those at anchors
are sorted: the anchor of a window is the GRAM-byte string in it with the least
hash (the leftmost of equals), so equal windows have equal anchors at equal
places, and one suffix, with the bytes before it, stands for all the
neighbouring windows that share its anchor.

1. Documents are packed with their anchors; a pack is the unit of every later step.
2. Packs exchange sorted anchor hashes; anchors of one document only drop out.
   This sieve is lossless: it can only keep too much.
3. Each pack sorts its remaining suffixes, equal ones of its documents being one
   with the smallest doc_id, and sends them front coded.
4. Runs are merged by a loser tree that holds every loser's common prefix with
   the last winner, so that known prefixes are never compared again. The common
   prefixes of neighbours in merged order tell which windows are equal.
5. Packs get back which windows have a smaller document, and drop bytes.

An anchor with very many places is hot: its windows are exchanged one by one, as
suffixes with themselves as anchors, so that they spread over all tasks.

Edge cases: a null text is empty; a null doc_id counts as the largest possible
one; rows with equal doc_ids keep each other's strings; texts shorter than
WINDOW keep all; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.llm._shared import Scratch, rows_of, slices, texts

WINDOW, GRAM = 50, 20
SPAN = WINDOW - GRAM + 1
#: Bytes of text of a pack and bytes of text for which one merging task is made.
PACK_BYTES, BUCKET_BYTES = 4 << 20, 32 << 20
#: Windows are looked for in pieces of so many bytes; pieces overlap by WINDOW - 1.
PIECE = 1 << 20
#: Bits for a place in a piece; the others hold the anchor's hash.
PLACE = 21
#: An anchor is hot from so many places on, as counted by packs: one a pack, or HEAVY where the pack has so many.
HOT, HEAVY = 4096, 64
#: Suffixes that are compared at a time, if they end with an anchor's last.
CHUNK = 200_000
#: What a null doc_id counts as.
NULL_ID = (1 << 63) - 1


def pack_documents(docs: DataFrame) -> DataFrame:
    """(pack, ids, nulls, sizes, data, runs): arrays as bytes, and compressed the texts one after another and their anchors."""
    def run(batches):
        me, n, press = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=3)
        ids, parts = [], []

        def pack():
            nonlocal n
            n += 1
            own = Pack(np.array([NULL_ID if i is None else i for i in ids], np.int64).tobytes(), np.packbits([i is None for i in ids]).tobytes(), np.array([len(p) for p in parts], np.int64).tobytes(), b"".join(parts))
            row = [own.ids.tobytes(), own.nulls, own.sizes.tobytes(), press.compress(own.data), press.compress(own.coded_runs())]
            return pa.RecordBatch.from_arrays([pa.array([me << 32 | n], pa.int64()), *(pa.array([x], pa.binary()) for x in row)], names=["pack", "ids", "nulls", "sizes", "data", "runs"])

        held = 0
        for whole in batches:
            for b in slices(whole, most=PACK_BYTES):
                for i, t in zip(b.column("doc_id").to_pylist(), texts(b.column("text"))):
                    raw = t.encode()
                    if held and held + len(raw) > PACK_BYTES:
                        yield pack()
                        ids, parts, held = [], [], 0
                    ids.append(i)
                    parts.append(raw)
                    held += len(raw)
        if ids:
            yield pack()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "pack long, ids binary, nulls binary, sizes binary, data binary, runs binary")


def gram_hashes(data: bytes, at) -> np.ndarray:
    """64-bit hashes of the GRAM bytes at places `at`, a slice or an array."""
    load = np.ndarray((len(data),), np.uint64, np.frombuffer(data + bytes(8), np.uint8).data, strides=(1,))
    here = lambda by: load[at.start + by : at.stop + by] if isinstance(at, slice) else load[at + by]
    h = np.array(here(0)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h ^= here(8)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h ^= here(GRAM - 8)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def window_hashes(data: bytes, at: np.ndarray) -> np.ndarray:
    """48-bit hashes of the WINDOW bytes at places `at`."""
    h = gram_hashes(data, at)
    for by in (GRAM, WINDOW - GRAM):
        h = (h ^ gram_hashes(data, at + by)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return h >> np.uint64(16)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the values are in `known`, which is sorted."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class Pack:
    """The texts of a pack's documents, their windows and the windows' anchors."""

    def __init__(self, ids: bytes, nulls: bytes, sizes: bytes, data: bytes, runs: bytes | None = None):
        self.ids, self.nulls, self.sizes, self.data = np.frombuffer(ids, np.int64), nulls, np.frombuffer(sizes, np.int64), data
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self._runs = runs

    @classmethod
    def of_row(cls, row: dict) -> "Pack":
        open_ = zstandard.ZstdDecompressor().decompress
        return cls(row["ids"], row["nulls"], row["sizes"], open_(row["data"]), open_(row["runs"]))

    def _piece(self, a: int, b: int):
        """Neighbouring windows with one anchor in bytes a to b: first and last window, anchor."""
        n = b - a
        k = n - GRAM + 1
        h = gram_hashes(self.data[a:b], slice(0, k))
        least = (h >> np.uint64(PLACE) << np.uint64(PLACE)) | np.arange(k, dtype=np.uint64)
        step = 1
        while step * 2 <= SPAN:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        rest = SPAN - step
        least = np.minimum(least[: len(least) - rest], least[rest:])
        ok = np.zeros(len(least), bool)
        i = max(0, int(np.searchsorted(self.starts, a, "right")) - 1)
        while i < len(self.sizes) and self.starts[i] < b:
            x, y = max(self.starts[i], a) - a, min(self.starts[i + 1], b) - a - WINDOW + 1
            if y > x:
                ok[x:y] = True
            i += 1
        window = np.flatnonzero(ok)
        if not len(window):
            return window, window, window
        anchor = (least[window] & np.uint64((1 << PLACE) - 1)).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)])
        last = np.r_[new[1:], len(window)] - 1
        return window[new] + a, window[last] + a, anchor[new] + a

    def coded_runs(self) -> bytes:
        """Neighbouring windows with one anchor, as three numbers each: how many, from the last one to the anchor, from the run before to the first."""
        found = [self._piece(a, b) for a in range(0, len(self.data), PIECE) if (b := min(len(self.data), a + PIECE + WINDOW - 1)) - a >= WINDOW]
        if not found:
            return b""
        lo, hi, at = (np.concatenate(x) for x in zip(*found))
        gap = lo - np.r_[0, hi[:-1] + 1]
        return (hi - lo + 1).astype(np.uint8).tobytes() + (at - hi).astype(np.uint8).tobytes() + gap.astype("<u4").tobytes()

    def runs(self):
        """Neighbouring windows with one anchor: first and last window, anchor, hash of 48 bits, document."""
        coded = self.coded_runs() if self._runs is None else self._runs
        k = len(coded) // 6
        many, back = (np.frombuffer(coded, np.uint8, k, i * k).astype(np.int64) for i in (0, 1))
        gap = np.frombuffer(coded, "<u4", k, 2 * k).astype(np.int64)
        lo = np.cumsum(gap) + np.cumsum(many) - many
        hi = lo + many - 1
        at = hi + back
        gram = gram_hashes(self.data, at) >> np.uint64(16) if k else np.zeros(0, np.uint64)
        return lo, hi, at, gram, np.searchsorted(self.starts, lo, "right") - 1

    def anchors(self, runs):
        """Distinct anchor hashes, sorted; whether two documents of the pack have them; whether HEAVY places have."""
        _, _, _, gram, doc = runs
        ids = self.ids[doc]
        order = np.lexsort((ids, gram))
        g, d = gram[order], ids[order]
        new = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
        end = np.r_[new[1:], len(g)] - 1 if len(g) else new
        return g[new], d[new] != d[end], end - new + 1 >= HEAVY

    def exchanged(self, runs, shared: np.ndarray, hot: np.ndarray):
        """The runs whose anchors are in shared; those with hot ones are taken apart, so that each window is its own anchor."""
        lo, hi, at, gram, doc = runs
        is_hot = among(gram, hot)
        keep = np.flatnonzero(among(gram, shared) & ~is_hot)
        n = hi[is_hot] - lo[is_hot] + 1
        start = np.repeat(lo[is_hot] - np.r_[0, np.cumsum(n)[:-1]] if len(n) else lo[is_hot], n) + np.arange(n.sum())
        own = window_hashes(self.data, start) if len(start) else np.zeros(0, np.uint64)
        join = lambda x, y: np.concatenate([x[keep], y])
        return join(lo, start), join(hi, start), join(at, start), join(gram, own), join(doc, np.repeat(doc[is_hot], n))

    def suffixes(self, runs):
        """The document of each run, and the distinct suffixes that the runs are.

        A suffix is the bytes from the anchor to the end of the last window,
        then those before the anchor, backwards; with the number of the former.
        """
        lo, hi, at, gram, doc = runs
        ids = self.ids[doc]
        known: dict[tuple[bytes, int], int] = {}
        data, least, grams, which = self.data, [], [], []
        for a, b, c, g, d in zip(lo.tolist(), hi.tolist(), at.tolist(), gram.tolist(), ids.tolist()):
            key = data[c : b + WINDOW] + data[a:c][::-1], b + WINDOW - c
            i = known.setdefault(key, len(least))
            if i == len(least):
                least.append(d)
                grams.append(g)
            elif d < least[i]:
                least[i] = d
            which.append(i)
        return ids, np.array(which, np.int64), list(known), np.array(least, np.int64), np.array(grams, np.uint64)


def bucket_of(grams: np.ndarray, buckets: int) -> np.ndarray:
    return ((grams * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)) % np.uint64(buckets)


def planes(hashes: np.ndarray) -> bytes:
    """48-bit numbers by byte, highest first: sorted ones compress well so."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].T.tobytes()


def unplanes(raw: bytes) -> np.ndarray:
    six = np.frombuffer(raw, np.uint8).reshape(6, -1)
    out = np.zeros((six.shape[1], 8), np.uint8)
    out[:, 2:] = six.T
    return out.view(">u8").ravel().astype(np.uint64)


def front_code(keys: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Sorted strings as common prefix lengths with the string before, lengths of the rest, and the rests."""
    if not keys:
        return b"", b"", b""
    size = np.fromiter(map(len, keys), np.int64, len(keys))
    width = int(size.max()) + 1
    grid = np.frombuffer(b"".join([k.ljust(width, b"\0") for k in keys]), np.uint8).reshape(-1, width)
    differ = grid[1:] != grid[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.r_[0, np.minimum(common, np.minimum(size[1:], size[:-1]))]
    rest = [k[c:] for k, c in zip(keys, common.tolist())]
    return common.astype(np.uint8).tobytes(), (size - common).astype(np.uint8).tobytes(), b"".join(rest)


def decode(common: bytes, sizes: bytes, rests: bytes):
    """(common prefix with the string before, string) of a front-coded run, one at a time."""
    at, last = 0, b""
    for c, n in zip(common, sizes):
        last = last[:c] + rests[at : at + n]
        at += n
        yield c, last


def common_from(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix of a and b, which share `known` bytes."""
    end = min(len(a), len(b))
    x = int.from_bytes(a[known:end], "big") ^ int.from_bytes(b[known:end], "big")
    return end - (x.bit_length() + 7) // 8


def merge_runs(runs: list):
    """Merges sorted runs of (common prefix, string): yields (common prefix with the last, string, run).

    A loser tree: node j holds the run that lost there. common[r] is the length
    of the prefix that run r's string shares with the last string to have passed
    its node, so the longer of two different ones is the smaller string, and
    only from equal ones on are bytes compared.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list[bytes | None] = [None] * k
    common = [0] * k
    pull = [iter(r).__next__ for r in runs]

    def advance(r: int) -> None:
        try:
            common[r], heads[r] = pull[r]()
        except StopIteration:
            heads[r], common[r] = None, -1

    def first(a: int, b: int) -> bool:
        """Whether run a's string comes before run b's; the loser's prefix is updated."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return y is None
        n = common_from(x, y, common[a])
        if n == len(x) and n == len(y):
            a_first = a < b
        else:
            a_first = n == len(x) or n < len(y) and x[n] < y[n]
        common[b if a_first else a] = n
        return a_first

    for r in range(k):
        if r < len(runs):
            advance(r)
        else:
            common[r] = -1
    losers = [0] * k

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        won = a if first(a, b) else b
        losers[node] = b if won == a else a
        return won

    won = play(1) if k > 1 else 0
    while heads[won] is not None:
        yield common[won], heads[won], won
        advance(won)
        node = (won + k) // 2
        mine = common[won]
        while node:
            other = losers[node]
            theirs = common[other]
            if mine < theirs or mine == theirs and mine >= 0 and not first(won, other):
                losers[node], won = won, other
            mine = common[won]
            node //= 2


def _shared_anchors(table: pa.Table, least: int = HOT) -> pa.Table:
    """Of one bucket: which of each pack's hashes two documents have, and which are hot, having `least` places."""
    rows = [unplanes(x) for x in table.column("hashes").to_pylist()]
    size = [len(r) for r in rows]
    plane = lambda name: np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(table.column(name).to_pylist(), size)]).astype(bool)
    h = np.concatenate(rows)
    order = np.argsort(h, kind="stable")
    new = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
    total = lambda x: np.add.reduceat(x[order].astype(np.int64), new)
    packs = np.diff(np.r_[new, len(h)])
    shared, hot = (packs > 1) | (total(plane("many")) > 0), packs + (HEAVY - 1) * total(plane("heavy")) >= least
    out = {}
    for name, x in (("shared", shared), ("hot", hot)):
        own = np.empty(len(h), bool)
        own[order] = np.repeat(x, packs)
        out[name] = pa.array([np.packbits(y).tobytes() for y in np.split(own, np.cumsum(size)[:-1])], pa.binary())
    return pa.table({"pack": table.column("pack"), "bucket": table.column("bucket"), **out})


def covered(common: np.ndarray, strings: list[bytes], right: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Of suffixes in merged order: which of their windows start in a smaller document too, a bit each.

    common: of each suffix, the prefix that it shares with the one before;
    right: its bytes from the anchor on. Windows that begin j bytes before their
    anchors are equal if WINDOW - j bytes from the anchor on are, which the
    prefixes known from merging tell, and j bytes backwards from the anchor,
    which the common prefixes of the sorted left sides tell.
    """
    m = len(strings)
    left = np.fromiter(map(len, strings), np.int64, m) - right
    pad = b"".join([s[r:].ljust(32, b"\0") for s, r in zip(strings, right.tolist())])
    order = np.lexsort(np.frombuffer(pad, ">u8").reshape(m, 4).T[::-1])
    sides = np.frombuffer(pad, np.uint8).reshape(m, 32)[order]
    differ = sides[1:] != sides[:-1]
    left_common = np.r_[0, np.where(differ.any(axis=1), differ.argmax(axis=1), 32)]
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)
    by_doc = np.argsort(docs, kind="stable")
    masks = np.zeros(m, np.uint32)
    for j in range(SPAN):
        at = by_doc[(left[by_doc] >= j) & (right[by_doc] >= WINDOW - j)]
        if len(at) < 2:
            continue
        key = np.cumsum(common < WINDOW - j)[at] * (m + 1) + np.cumsum(left_common < j)[place[at]]
        sort = np.argsort(key, kind="stable")
        at, key = at[sort], key[sort]
        new = np.r_[True, key[1:] != key[:-1]]
        least = docs[at[new]][np.cumsum(new) - 1]
        hit = at[docs[at] > least]
        masks[hit] |= np.uint32(1) << (left[hit] - j).astype(np.uint32)
    return masks


def _merge_bucket(table: pa.Table) -> pa.Table:
    """Merges one bucket's runs; (pack, numbers, masks) of the windows to remove."""
    packs = table.column("pack").to_pylist()
    coded = list(zip(*(table.column(c).to_pylist() for c in ("common", "lengths", "rests"))))
    size = [len(x[0]) for x in coded]
    docs = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("docs").to_pylist()])
    rights = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("rights").to_pylist()]).astype(np.int64)
    numbers = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("numbers").to_pylist()])
    begin = np.r_[0, np.cumsum(size)]
    done, found = begin[:-1].copy(), []
    common, strings, runs = [], [], []

    def flush():
        run = np.array(runs, np.int64)
        sort = np.argsort(run, kind="stable")
        first = np.searchsorted(run[sort], run[sort])
        at = np.empty(len(run), np.int64)
        at[sort] = done[run[sort]] + np.arange(len(run)) - first  # the strings of a run come in their order
        np.add.at(done, run, 1)
        n = np.array(common, np.int64)
        new = n < GRAM
        new[0] = True
        many = np.flatnonzero(np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1)  # an anchor's only suffix has no equal
        if len(many):
            masks = covered(np.where(new[many], 0, n[many]), [strings[i] for i in many.tolist()], rights[at[many]], docs[at[many]])
            hit = np.flatnonzero(masks)
            found.append((at[many[hit]], masks[hit]))

    for shared, s, run in merge_runs([decode(*c) for c in coded]):
        if shared < GRAM and len(strings) >= CHUNK:
            flush()
            common, strings, runs = [], [], []
        common.append(shared)
        strings.append(s)
        runs.append(run)
    if strings:
        flush()
    at, masks = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*found)) or ((), ())))
    owner = np.searchsorted(begin, at, "right") - 1
    sort = np.argsort(owner, kind="stable")
    own, cut = np.unique(owner[sort], return_index=True)
    part = lambda x, kind: [y.astype(kind).tobytes() for y in np.split(x[sort], cut[1:])] if len(own) else []
    return pa.table({"pack": pa.array([packs[r] for r in own], pa.int64()), "numbers": pa.array(part(numbers[at], np.uint32), pa.binary()), "masks": pa.array(part(masks, np.uint32), pa.binary())})


def _exchanged(pack: Pack, marks, buckets: int):
    """The pack's runs that have to meet others, by what the buckets have marked."""
    runs = pack.runs()
    grams, _, _ = pack.anchors(runs)
    order = np.argsort(bucket_of(grams, buckets), kind="stable")
    to = bucket_of(grams, buckets)[order]
    bits = {"shared": np.zeros(len(grams), bool), "hot": np.zeros(len(grams), bool)}
    for m in marks or ():
        a, b = np.searchsorted(to, m["bucket"]), np.searchsorted(to, m["bucket"], "right")
        for name, x in bits.items():
            x[order[a:b]] = np.unpackbits(np.frombuffer(m[name], np.uint8), count=b - a).astype(bool)
    return pack.exchanged(runs, grams[bits["shared"]], grams[bits["shared"] & bits["hot"]])


def _by_bucket(to: np.ndarray):
    """(bucket, places) of each bucket, places in their order."""
    order = np.argsort(to, kind="stable")
    own, cut = np.unique(to[order], return_index=True)
    return zip(own.tolist(), np.split(order, cut[1:]) if len(own) else [])


def dedup_substrings(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans, kept_sha256) of every document; kept is binary. hot: see HOT."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    packs = scratch.save(pack_documents(docs), codec="none")
    total = packs.agg(F.sum(F.length("data"))).first()[0] or 0
    buckets = max(1, -(-3 * total // BUCKET_BYTES))  # texts compress to about a third

    def dealt(df: DataFrame) -> DataFrame:
        """Each bucket in a partition of its own."""
        return df.repartitionById(buckets, F.col("bucket"))

    def send_anchors(batches):
        for row in rows_of(batches):
            pack = Pack.of_row(row)
            grams, many, heavy = pack.anchors(pack.runs())
            made = [(k, planes(grams[own]), np.packbits(many[own]).tobytes(), np.packbits(heavy[own]).tobytes()) for k, own in _by_bucket(bucket_of(grams, buckets))]
            k, *arrays = list(zip(*made)) or ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array([row["pack"]] * len(k), pa.int64()), *(pa.array(x, pa.binary()) for x in arrays)], names=["bucket", "pack", "hashes", "many", "heavy"])

    sent = dealt(packs.mapInArrow(send_anchors, "bucket int, pack long, hashes binary, many binary, heavy binary"))
    bits = sent.groupBy("bucket").applyInArrow(lambda t: _shared_anchors(t, hot), "pack long, bucket int, shared binary, hot binary")
    marks = scratch.save(bits.groupBy("pack").agg(F.collect_list(F.struct("bucket", "shared", "hot")).alias("marks")))

    def send_suffixes(batches):
        for row in rows_of(batches):
            _, _, keys, least, grams = (pack := Pack.of_row(row)).suffixes(_exchanged(pack, row["marks"], buckets))
            made = []
            for k, own in _by_bucket(bucket_of(grams, buckets)):
                own = sorted(own.tolist(), key=keys.__getitem__)
                made.append((k, *front_code([keys[i][0] for i in own]), bytes(keys[i][1] for i in own), least[own].tobytes(), np.array(own, np.uint32).tobytes()))
            k, *arrays = list(zip(*made)) or ((),) * 7
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array([row["pack"]] * len(k), pa.int64()), *(pa.array(x, pa.binary()) for x in arrays)], names=["bucket", "pack", "common", "lengths", "rests", "rights", "docs", "numbers"])

    coded = dealt(packs.join(marks, "pack").mapInArrow(send_suffixes, "bucket int, pack long, common binary, lengths binary, rests binary, rights binary, docs binary, numbers binary"))
    gone = coded.groupBy("bucket").applyInArrow(_merge_bucket, "pack long, numbers binary, masks binary")
    gone = scratch.save(gone.groupBy("pack").agg(F.collect_list(F.struct("numbers", "masks")).alias("gone")))

    def remove(batches):
        for row in rows_of(batches):
            yield _without(Pack.of_row(row), row["marks"], row["gone"], buckets)

    return packs.join(marks, "pack", "left").join(gone, "pack", "left").mapInArrow(remove, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _without(pack: Pack, marks, gone, buckets: int) -> pa.RecordBatch:
    """The pack's documents without the bytes of windows that a smaller document has."""
    edge = np.zeros(len(pack.data) + 1, np.int32)
    if marks:
        runs = _exchanged(pack, marks, buckets)
        lo, hi, *_ = runs
        ids, which, _, least, _ = pack.suffixes(runs)
        masks = np.zeros(len(least), np.uint32)
        for g in gone or ():
            masks[np.frombuffer(g["numbers"], np.uint32)] = np.frombuffer(g["masks"], np.uint32)
        if len(which):
            n = (hi - lo + 1).astype(np.uint64)
            full = ((np.uint64(1) << n) - np.uint64(1)).astype(np.uint32)
            # a later document of the pack loses all the windows, the smallest those of the mask
            mine = np.where(ids > least[which], full, masks[which])
            for i in range(SPAN):
                at = lo[(mine >> np.uint32(i)) & np.uint32(1) == 1] + i
                np.add.at(edge, at, 1)
                np.add.at(edge, at + WINDOW, -1)
    hit = np.cumsum(edge[:-1]) > 0
    null = np.unpackbits(np.frombuffer(pack.nulls, np.uint8), count=len(pack.ids)).astype(bool)
    raw, starts = np.frombuffer(pack.data, np.uint8), pack.starts
    cols = [[], [], [], [], [], []]
    for i, d in enumerate(pack.ids.tolist()):
        a, b = starts[i], starts[i + 1]
        own = hit[a:b]
        k = int(own.sum())
        kept = raw[a:b][~own].tobytes() if k else pack.data[a:b]
        spans = int((own & ~np.r_[False, own[:-1]]).sum()) if k else 0
        for c, x in zip(cols, (None if null[i] else d, kept, int(b - a), k, spans, hashlib.sha256(kept).hexdigest())):
            c.append(x)
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
