"""Exact Jaccard join of word-shingle sets, skipping by relations between sets.

Sets are indexed by the rare end of their shingles. Inside one index list, sets of equal size form a block ordered by position, so
whatever lies too far back in both blocks is skipped without a look. Candidates meet in groups of sets that look alike, first
as parity bitmaps, then, where these leave a partner, as shingles: the overlaps of a set are those of the set before it,
corrected by the shingles the two do not share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costseries.llm import graph
from costseries.llm.common import fields
from costseries.session import landed_alone

WORDS, PERCENT = 5, 80
FREQUENT = 16  # sets from which on a shingle's frequency is known by number
TABLE = 1 << 20  # most frequent shingles known at once, as a broadcast table of 16 bytes each
HELD = 1 << 20  # shingles a task holds before it passes them on
CELL = 1 << 14  # sets of one index list handled together; longer lists are dealt to a grid of cells
SHORT = 64  # sets of an index list up to which its pairs are simply tried
PIECE = 1 << 18  # shingles of the sets verified together on either side
SPREAD = 1 << 20  # shingles counted by one task; indexes and groups take a few times as many
WANTED = 1 << 18  # texts fetched by a broadcast list of hashes; more are fetched by a broadcast bit table
MARKS = 1 << 26  # bits of that table, one for each hash; a full one costs time, never a text
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIXERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIXERS[0]
    x = (x ^ (x >> np.uint64(27))) * MIXERS[1]
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Ascending 64-bit hashes of the distinct word shingles of a text; none without a word.

    A-Z are lower-cased, words are split at ASCII white space; fewer words than ``size`` are one shingle.
    """
    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    size = min(size, len(found))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    n = len(found) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = total * MULTIPLIER + hashes[k : k + n]
    return np.unique(_mixed(total))


def _set_key(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _bitmap(found: np.ndarray) -> bytes:
    """Parity of the shingles by the last bits of their hashes, one to two bits for every shingle, at least 64."""
    bits = max(64, 1 << (len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _folded(bitmaps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps of fewer bits from larger ones, a row of 64-bit words each."""
    while bitmaps.shape[1] > words:
        half = bitmaps.shape[1] // 2
        bitmaps = bitmaps[:, :half] ^ bitmaps[:, half:]
    return bitmaps


def _new_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """Key and shingles of every set, the first time that this task sees it: copies cost a look, not a row."""
    seen: set[bytes] = set()
    for batch in batches:
        for value in batch.column(0):
            found = shingles(value.as_py(), size)
            key = _set_key(found)
            if len(found) and key not in seen:
                seen.add(key)
                yield key, found


def members(docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = WORDS) -> DataFrame:
    """``(id, s, n, t, bits)`` per document: key of its set (null for the empty one), size of the set, hash of the text, bitmap of the set."""
    kind = docs.schema[doc].dataType.simpleString()
    schema = fields(f"id {kind}, s binary, n long, t long, bits binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, bitmaps = [], [], []
            for value in batch.column(1):
                found = shingles(value.as_py(), size)
                keys.append(_set_key(found) if len(found) else None)
                sizes.append(len(found))
                bitmaps.append(_bitmap(found) if len(found) else None)
            columns = [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), batch.column(2), pa.array(bitmaps, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(docs[doc].alias("id"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("t")).mapInArrow(run, schema)


def _bits(items: int, most: int) -> int:
    """Leading bits of a hash that deal ``items`` to buckets of about ``most``."""
    return max(0, (max(items, 1) - 1) // most).bit_length()


def _code(found: np.ndarray, bits: int) -> np.ndarray:
    """The leading ``bits + 32`` bits of a hash, the name under which a shingle is counted."""
    return found >> np.uint64(32 - bits)


def _flat(codes: np.ndarray) -> bytes:
    """The low halves of ascending codes, byte by byte of all of them, which packs well."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unflat(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.uint64)


def frequencies(docs: DataFrame, n_shingles: int, text: str = "text", size: int = WORDS) -> DataFrame:
    """``(code, df)`` of the shingles in at least ``FREQUENT`` sets, counted over all documents.

    Every task counts on its own first and sends packed counts, so a shingle of a third of all sets travels
    once per ``HELD`` shingles. A copy counts once per task. Shingles are told apart by 32 bits beyond those of their bucket; a
    chance meeting of two only moves both towards the frequent end.
    """
    bits = _bits(n_shingles, SPREAD)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(parts: list[np.ndarray]) -> pa.RecordBatch:
            codes, counts = np.unique(_code(np.concatenate(parts), bits), return_counts=True)
            bucket = (codes >> np.uint64(32)).astype(np.int64)
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=1 << 40))
            rows = [(int(bucket[a]), _flat(codes[a:b] & np.uint64(0xFFFFFFFF)), counts[a:b].astype("<u4").tobytes()) for a, b in zip(edges, edges[1:])]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "codes", "counts"])

        held, parts = 0, []
        for _, found in _new_sets(batches, size):
            parts.append(found)
            held += len(found)
            if held >= HELD:
                yield flushed(parts)
                held, parts = 0, []
        if parts:
            yield flushed(parts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = [], []
        for batch in batches:
            for bucket, raw, numbers in zip(*[c.to_pylist() for c in batch.columns]):
                codes.append(_unflat(raw) | np.uint64(bucket << 32))
                counts.append(np.frombuffer(numbers, "<u4"))
        if not codes:
            return
        every, number = np.concatenate(codes), np.concatenate(counts).astype(np.int64)
        codes.clear(), counts.clear()
        order = np.argsort(every, kind="stable")
        every, number = every[order], number[order]
        starts = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        totals = np.add.reduceat(number, starts)
        some = totals >= FREQUENT
        yield pa.RecordBatch.from_arrays([pa.array(every[starts][some].view(np.int64)), pa.array(totals[some])], names=["code", "df"])

    counted = docs.select(docs[text].alias("text")).mapInArrow(count, "bucket long, codes binary, counts binary")
    return counted.repartition(1 << bits, "bucket").mapInArrow(merge, "code long, df long")


def _most_frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes and numbers of the most frequent shingles, whole powers of two of frequency, at most ``TABLE`` of them."""
    by_power = {r["p"]: r["c"] for r in counts.groupBy(F.floor(F.log2("df")).alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}
    least, total = 64, 0
    for p in sorted(by_power, reverse=True):
        total += by_power[p]
        if total > TABLE:
            break
        least = p
    rows = counts.where(F.floor(F.log2("df")) >= least).toArrow()
    codes = rows.column("code").to_numpy().view(np.uint64)
    order = np.argsort(codes)
    return codes[order], rows.column("df").to_numpy()[order]


class Order:
    """The one order of all shingles: by frequency where that is known, then by hash."""

    def __init__(self, codes: np.ndarray, df: np.ndarray, bits: int):
        self.codes, self.df, self.bits = codes, df, bits

    def frequency(self, found: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(len(found), np.int64)
        codes = _code(found, self.bits)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.df[at], 0)


def needed(a, b, percent: int = PERCENT):
    """Least overlap of sets of sizes a and b for ``100 * intersection >= percent * union``."""
    return -(-percent * (a + b) // (100 + percent))


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


ENTRY = [("token", "<u8"), ("owner", "<u4"), ("pos", "<u4"), ("cell", "<u4"), ("salt", "<u4")]


def _entries(batches: Iterator[pa.RecordBatch], order: Order, size: int, percent: int) -> Iterator[tuple[list[bytes], list[int], np.ndarray]]:
    """Index entries of the sets of a task, a bounded number at a time, with keys and sizes of their owners.

    A list of more than ``CELL`` sets is dealt to cells: a set with salt k goes to all cells (k, j) and (j, k) of
    the list's triangle, so any two sets meet in one cell and no cell is long.
    """
    keys, sizes, parts, held = [], [], [], 0
    for key, found in _new_sets(batches, size):
        df = order.frequency(found)
        place = np.lexsort((found, df))[: _prefix(len(found), percent)] if df.any() else np.arange(_prefix(len(found), percent))
        part = np.zeros(len(place), ENTRY)
        part["token"], part["owner"], part["pos"] = found[place], len(keys), np.arange(len(place))
        salts = -(-df[place] // CELL)
        for at in np.flatnonzero(salts > 1):
            s = int(salts[at])
            mine = int.from_bytes(key[:8], "little") % s
            rows = np.zeros(s, ENTRY)
            rows["token"], rows["owner"], rows["pos"], rows["salt"] = part["token"][at], len(keys), part["pos"][at], mine
            other = np.arange(s)
            rows["cell"] = 1 + np.minimum(other, mine) * s + np.maximum(other, mine)
            parts.append(rows)
        parts.append(part[salts <= 1])
        keys.append(key)
        sizes.append(len(found))
        held += len(place)
        if held >= HELD:
            yield keys, sizes, np.concatenate(parts)
            keys, sizes, parts, held = [], [], [], 0
    if keys:
        yield keys, sizes, np.concatenate(parts)


def _bucket(entries: np.ndarray, bits: int) -> np.ndarray:
    """Bucket of a list or, beyond the first bits of the shingle, of one of its cells."""
    mixed = _mixed(entries["token"] + entries["cell"].astype(np.uint64) * MULTIPLIER)
    return (mixed >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64)


def _products(starts_a, counts_a, starts_b, counts_b) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places of slices a and b, slice by slice, at most about a million at a time."""
    most = 1 << 20
    for a, n, b, m in zip(starts_a, counts_a, starts_b, counts_b):
        step = max(1, most // m)
        for k in range(0, n, step):
            rows = np.arange(a + k, a + min(n, k + step))
            yield np.repeat(rows, m), np.tile(np.arange(b, b + m), len(rows))


def _pairs_of_list(n: np.ndarray, pos: np.ndarray, start: int, stop: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs of one long list, ordered by (size, position): blocks of one size, cut where a position is too far back."""
    sizes, firsts = np.unique(n[start:stop], return_index=True)
    firsts = np.r_[firsts, stop - start] + start
    place = n[start:stop] * np.int64(1 << 32) + pos[start:stop]
    for k, small in enumerate(sizes):
        upto = np.searchsorted(sizes, small * 100 // percent, "right")
        large = sizes[k:upto]
        need = needed(small, large, percent)
        mine = np.searchsorted(place, small * (1 << 32) + (small - need), "right") + start - firsts[k]
        theirs = np.searchsorted(place, large * (1 << 32) + (large - need), "right") + start - firsts[k:upto]
        some = np.flatnonzero((mine > 0) & (theirs > 0))
        yield from _products(np.full(len(some), firsts[k]), mine[some], firsts[k:upto][some], theirs[some])


def _pairs_of_short_lists(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places of many short lists, about a million at a time."""
    weight = np.cumsum(lengths * (lengths - 1) // 2) // (1 << 20)
    for part in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(weight)) + 1) if len(starts) else []:
        s, m = starts[part], lengths[part]
        first = np.repeat(s, m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        later = np.repeat(s + m, m) - first - 1
        one = np.repeat(first, later)
        yield one, one + 1 + np.arange(len(one)) - np.repeat(np.cumsum(later) - later, later)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (two big-endian halves each) in ascending order, and the number of every row's key."""
    keys = keys.astype(np.uint64)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.r_[True, (keys[order][1:] != keys[order][:-1]).any(axis=1)]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return keys[order][new], number


class Lists:
    """Index lists with more than one set, each ordered by (size, position).

    ``entries`` are those of numbered owners; ``size`` is by owner. Copies that several tasks have sent are one entry.
    """

    def __init__(self, entries: np.ndarray, size: np.ndarray, percent: int):
        order = np.lexsort((entries["owner"], entries["cell"], entries["token"]))
        token, cell, owner = (entries[c][order] for c in ("token", "cell", "owner"))
        other = np.r_[True, (token[1:] != token[:-1]) | (cell[1:] != cell[:-1])][: len(order)]
        new = other | np.r_[True, owner[1:] != owner[:-1]][: len(order)]
        order, other = order[new], other[new]
        lengths = np.diff(np.r_[np.flatnonzero(other), len(order)])
        lists, lengths = np.repeat(np.arange(len(lengths)), lengths), np.repeat(lengths, lengths)
        order, lists = order[lengths > 1], lists[lengths > 1]
        pos, n = entries["pos"][order], size[entries["owner"][order]]
        self.entries = entries[order[np.lexsort((pos, n, lists))]]
        self.starts = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]][: len(lists)])
        self.lengths = np.diff(np.r_[self.starts, len(lists)])
        self.owner, self.percent = self.entries["owner"].astype(np.int64), percent
        self.n, self.pos = size[self.owner], self.entries["pos"].astype(np.int64)

    def pairs(self, wanted: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of all two sets of one of the ``wanted`` lists that length and position leave together, a bounded number at a time."""
        if not len(self.starts):
            return
        n, pos, owner, salt = self.n, self.pos, self.owner, self.entries["salt"]
        mixed = np.minimum.reduceat(salt, self.starts) != np.maximum.reduceat(salt, self.starts)
        two_salts = np.repeat(mixed, self.lengths)  # a cell off the diagonal: sets of one salt meet elsewhere
        wanted = np.ones(len(self.starts), bool) if wanted is None else wanted

        def passed(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            far = np.minimum(n[one] - pos[one], n[two] - pos[two]) >= needed(n[one], n[two], self.percent)
            some = far & (owner[one] != owner[two]) & ((salt[one] != salt[two]) | ~two_salts[one])
            return one[some], two[some]

        short = wanted & (self.lengths <= SHORT)
        for one, two in _pairs_of_short_lists(self.starts[short], self.lengths[short]):
            yield passed(one, two)
        for k in np.flatnonzero(wanted & (self.lengths > SHORT)):
            for one, two in _pairs_of_list(n, pos, self.starts[k], self.starts[k] + self.lengths[k], self.percent):
                yield passed(one, two)


def _binary(keys: np.ndarray) -> pa.Array:
    """Keys (two halves each) as a column."""
    return pa.Array.from_buffers(pa.binary(16), len(keys), [None, pa.py_buffer(keys.astype(">u8").tobytes())]).cast(pa.binary())


def _halves(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").reshape(-1, 2)


def index(docs: DataFrame, counts: DataFrame, n_shingles: int, text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(token, cell, salt, pos, n, s, least)``: the entries of index lists that have a candidate partner in their list.

    ``least`` is the smallest key among these partners. Pairs are looked at inside the tasks only; what leaves them is one row per entry.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_most_frequent(counts))
    code_bits, bits = _bits(n_shingles, SPREAD), _bits(n_shingles, SPREAD * 2)
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    schema = fields("token long, cell long, salt long, pos long, n long, s binary, least binary")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, sizes, entries in _entries(batches, Order(*shared.value, code_bits), size, percent):
            bucket = _bucket(entries, bits)
            order = np.argsort(bucket, kind="stable")
            edges, rows = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=1 << 62)), []
            for a, b in zip(edges, edges[1:]):
                part = entries[order[a:b]]
                owners, part["owner"] = np.unique(part["owner"], return_inverse=True)
                rows.append((int(bucket[order[a]]), b"".join(keys[k] for k in owners), np.array([sizes[k] for k in owners], "<u4").tobytes(), _packed(part)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["bucket", "keys", "sizes", "entries"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes, parts, at = [], [], [], 0
        for batch in batches:
            for _, k, n, raw in zip(*[c.to_pylist() for c in batch.columns]):
                part = _unpacked(raw)
                part["owner"] += at
                at += len(k) // 16
                keys.append(np.frombuffer(k, ">u8").reshape(-1, 2)), sizes.append(np.frombuffer(n, "<u4")), parts.append(part)
        if not keys:
            return
        distinct, number = _numbered(np.concatenate(keys))
        n = np.zeros(len(distinct), np.int64)
        n[number] = np.concatenate(sizes)
        entries = np.concatenate(parts)
        parts.clear(), keys.clear()
        entries["owner"] = number[entries["owner"]]
        lists = Lists(entries, n, percent)
        least = np.full(len(lists.owner), len(distinct))
        for one, two in lists.pairs():  # keys ascend with their numbers
            np.minimum.at(least, one, lists.owner[two])
            np.minimum.at(least, two, lists.owner[one])
        kept = np.flatnonzero(least < len(distinct))
        for part in np.split(kept, range(HELD, len(kept), HELD)):
            rows = lists.entries[part]
            numbers = [pa.array(rows[c].astype("<u8").view(np.int64)) for c in ("token", "cell", "salt", "pos")]
            yield pa.RecordBatch.from_arrays([*numbers, pa.array(lists.n[part]), _binary(distinct[lists.owner[part]]), _binary(distinct[least[part]])], names=schema.names)

    rows = docs.select(docs[text].alias("text")).mapInArrow(deal, "bucket long, keys binary, sizes binary, entries binary")
    return rows.repartition(1 << bits, "bucket").mapInArrow(meet, schema)


def meetings(placed: DataFrame, tasks: int, percent: int = PERCENT) -> DataFrame:
    """``(g, right, s)``: the groups in which a set meets its candidates, one for every two pieces with a candidate pair between them.

    ``placed`` is the index with the ``piece`` of every set. A set gets one row per piece it may have a partner in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        distinct, number = _numbered(_halves(rows.column("s")))
        names = sorted(pc.unique(rows.column("piece")).to_pylist())
        piece = np.zeros(len(distinct), np.int64)
        piece[number] = pc.index_in(rows.column("piece"), pa.array(names)).to_numpy()
        n = np.zeros(len(distinct), np.int64)
        n[number] = rows.column("n").to_numpy()
        entries = np.zeros(len(number), ENTRY)
        entries["owner"] = number
        for c in ("token", "cell", "salt", "pos"):
            entries[c] = rows.column(c).to_numpy().view(np.uint64)
        lists = Lists(entries, n, percent)
        at = piece[lists.owner]
        # In a list of one piece every entry has its partner there; other lists are looked at pair by pair.
        alone = np.minimum.reduceat(at, lists.starts) == np.maximum.reduceat(at, lists.starts) if len(at) else np.zeros(0, bool)
        inside = np.repeat(alone, lists.lengths)
        found, held = [lists.owner[inside] * len(names) + at[inside]], 0
        for one, two in lists.pairs(~alone):
            found += [np.unique(lists.owner[one] * len(names) + at[two]), np.unique(lists.owner[two] * len(names) + at[one])]
            held += len(one)
            if held > 1 << 22:
                found, held = [np.unique(np.concatenate(found))], 0
        codes = np.unique(np.concatenate(found))
        for part in np.split(codes, range(HELD, len(codes), HELD)):
            owner, other = part // len(names), part % len(names)
            mine = piece[owner]
            groups = [f"{names[a]}|{names[b]}" for a, b in zip(np.minimum(mine, other), np.maximum(mine, other))]
            yield pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), pa.array(mine > other), _binary(distinct[owner])], names=["g", "right", "s"])

    return placed.repartition(tasks, "token", "cell").mapInArrow(run, "g string, right boolean, s binary").distinct()


def _packed(entries: np.ndarray) -> bytes:
    """Entries column by column; cells and salts only where a list has any."""
    names = [n for n, _ in ENTRY] if entries["cell"].any() else ["token", "owner", "pos"]
    return bytes([len(names)]) + b"".join(np.ascontiguousarray(entries[n]).tobytes() for n in names)


def _unpacked(raw: bytes) -> np.ndarray:
    names, width = ENTRY[: raw[0]], 16 + 8 * (raw[0] == 5)
    count, at = (len(raw) - 1) // width, 1
    out = np.zeros(count, ENTRY)
    for name, kind in names:
        out[name] = np.frombuffer(raw, kind, count, at)
        at += count * np.dtype(kind).itemsize
    return out


class Verifier:
    """Overlaps of sets with a block of sets, each derived from the overlaps of the set before it."""

    def __init__(self, block: list[np.ndarray]):
        lengths = np.array([len(b) for b in block])
        every, owner = np.concatenate(block), np.repeat(np.arange(len(block)), lengths)
        order = np.argsort(every, kind="stable")
        self.owner, self.every = owner[order], every[order]
        self.tokens, self.starts = np.unique(self.every, return_index=True)
        self.stops = np.r_[self.starts[1:], len(self.every)]
        self.count = len(block)
        self.last, self.overlaps = np.zeros(0, np.uint64), np.zeros(self.count, np.int64)

    def _listed(self, found: np.ndarray) -> np.ndarray:
        """In how many of these shingles' lists each set of the block stands."""
        if not len(found):
            return np.zeros(self.count, np.int64)
        at = np.minimum(np.searchsorted(self.tokens, found), len(self.tokens) - 1)
        at = at[self.tokens[at] == found]
        lengths = self.stops[at] - self.starts[at]
        place = np.repeat(self.starts[at], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return np.bincount(self.owner[place], minlength=self.count)

    def of(self, found: np.ndarray) -> np.ndarray:
        """Overlap of a set with every set of the block."""
        new, gone = np.setdiff1d(found, self.last, assume_unique=True), np.setdiff1d(self.last, found, assume_unique=True)
        if len(new) + len(gone) < len(found):
            self.overlaps = self.overlaps + self._listed(new) - self._listed(gone)
        else:
            self.overlaps = self._listed(found)
        self.last = found
        return self.overlaps


def _verified(left: list[tuple], right: list[tuple] | None, percent: int) -> list[tuple]:
    """Links of a group, ``left`` with ``right`` or inside ``left``, as rows ``(u, v, null)`` that connect what is connected
    and rows ``(u, null, documents)`` with the linked documents of every set. Sets are ``(key, shingles, copies)``.
    """
    block = left if right is None else right
    if not left or not block:
        return []
    keys, copies, sizes = [k for k, _, _ in block], np.array([c for _, _, c in block]), np.array([len(b) for _, b, _ in block])
    verifier, linked, out = Verifier([b for _, b, _ in block]), np.zeros(len(block), np.int64), []
    label, own = np.arange(len(block) + len(left)), len(block)
    number = {k: j for j, k in enumerate(keys)}
    for key, found, weight in sorted(left, key=lambda r: r[1][:8].tobytes()):  # sets that look alike follow each other
        near = verifier.of(found) >= needed(len(found), sizes, percent)
        me = number.get(key, own)
        if me < len(block):
            near[me] = False
        else:
            own += 1
        if not near.any():
            continue
        out.append((key, None, int(copies[near].sum())))
        linked[near] += weight
        places = np.flatnonzero(near)
        for j in places[np.unique(label[places], return_index=True)[1]]:
            if label[j] != label[me]:
                out.append((key, keys[j], None))
                label[label == label[j]] = label[me]
    if right is not None:
        out += [(keys[j], None, int(linked[j])) for j in np.flatnonzero(linked)]
    return out


def _alike(left: list[tuple], right: list[tuple] | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which sets ``(key, size, bitmap)`` of either side may have a partner on the other side, or inside ``left``.

    Every bit in which two bitmaps differ stands for a shingle that only one of the sets has, so no pair within reach is lost.
    """
    def by_length(side: list[tuple]) -> list[tuple]:
        lengths, out = np.array([len(b) // 8 for _, _, b in side]), []
        for words in np.unique(lengths):
            at = np.flatnonzero(lengths == words)
            out.append((at, np.array([side[k][1] for k in at]), np.frombuffer(b"".join(side[k][2] for k in at), "<u8").reshape(-1, words)))
        return out

    block = left if right is None else right
    mine, theirs = np.zeros(len(left), bool), np.zeros(len(block), bool)
    blocks = by_length(block)
    for at, n, bitmaps in by_length(left):
        for other, sizes, others in blocks:
            words = min(bitmaps.shape[1], others.shape[1])
            for size in np.unique(n):
                need = needed(size, sizes, percent)
                some = np.flatnonzero(need <= np.minimum(size, sizes))
                if not len(some):
                    continue
                one, two, most = at[n == size], _folded(others[some], words), (size + sizes - 2 * need)[some]
                bits, step = _folded(bitmaps[n == size], words), max(1, (1 << 20) // (len(some) * words))
                for k in range(0, len(one), step):
                    near = np.bitwise_count(bits[k : k + step, None] ^ two).sum(axis=2, dtype=np.int64) <= most
                    if right is None:
                        near &= one[k : k + step, None] != other[some]
                    mine[one[k : k + step]] |= near.any(axis=1)
                    theirs[other[some]] |= near.any(axis=0)
    return mine, theirs


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple], list[tuple] | None]]:
    """Groups of rows ``(g, right, ...)`` ordered by group, each with its left and right rows; None if it is one piece."""
    def done() -> tuple[str, list[tuple], list[tuple] | None]:
        a, b = group.split("|")
        return group, sides[0], None if a == b else sides[1]

    group, sides = None, ([], [])
    for batch in batches:
        for g, right, *row in zip(*[c.to_pylist() for c in batch.columns]):
            if g != group:
                if group is not None:
                    yield done()
                group, sides = g, ([], [])
            sides[right].append(tuple(row))
    if group is not None:
        yield done()


def sifted(met: DataFrame, placed: DataFrame, tasks: int, percent: int = PERCENT) -> DataFrame:
    """The rows of ``meetings`` without the sets whose bitmap leaves them no partner in the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, left, right in _groups(batches):
            mine, theirs = _alike(left, right, percent)
            if right is None:
                mine, theirs = mine | theirs, theirs[:0]
            keys = [left[k][0] for k in np.flatnonzero(mine)] + [right[k][0] for k in np.flatnonzero(theirs)]
            sides = np.arange(len(keys)) >= mine.sum()
            yield pa.RecordBatch.from_arrays([pa.array([group] * len(keys), pa.string()), pa.array(sides), pa.array(keys, pa.binary())], names=["g", "right", "s"])

    rows = met.join(placed.select("s", "n", "bits"), "s").select("g", "right", "s", "n", "bits")
    return rows.repartition(tasks, "g").sortWithinPartitions("g").mapInArrow(run, "g string, right boolean, s binary")


def _marks(wanted: DataFrame) -> np.ndarray:
    """Bit table of the hashes in column ``t``, read as at most ``MARKS`` / 64 numbers."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("t").bitwiseAND(F.lit(63)).cast("int"))
    cell = F.shiftright(F.col("t").bitwiseAND(F.lit(MARKS - 1)), 6).alias("cell")
    found = wanted.groupBy(cell).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(MARKS >> 6, np.int64)
    table[found.column("cell").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint64)


def _texts(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """Texts with the hashes ``wanted``. Few hashes are broadcast, more as a bit table, which also lets through a few other texts."""
    wanted = landed_alone(wanted.distinct(), "wanted")
    rows = docs.select(docs[text].alias("text"), F.xxhash64(docs[text]).alias("t"))
    if wanted.count() <= WANTED:
        return rows.join(F.broadcast(wanted), "t", "left_semi").select("text")
    shared = docs.sparkSession.sparkContext.broadcast(_marks(wanted))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = batch.column(1).to_numpy().view(np.uint64)
            cell = (t & np.uint64((len(shared.value) << 6) - 1)) >> np.uint64(6)
            hit = (shared.value[cell] >> (t & np.uint64(63))) & np.uint64(1)
            yield batch.select(["text"]).filter(pa.array(hit.astype(bool)))

    return rows.mapInArrow(marked, "text string")


def classes(rows: DataFrame) -> DataFrame:
    """``(s, n, t, least, copies, bits)`` per set that is not empty: one of its texts, its smallest id, its documents and its bitmap."""
    found = rows.where("s IS NOT NULL").groupBy("s")
    return found.agg(F.max("n").alias("n"), F.min("t").alias("t"), F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.max("bits").alias("bits"))


def links(docs: DataFrame, sets: DataFrame, text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The links between different sets, ``100 * intersection >= percent * union``, without a row per link.

    Rows ``(u, v, null)`` are links that connect all that links connect; rows ``(u, null, w)`` add up to the documents that
    link with those of set u. ``sets`` is the landed table of ``classes``. Candidate sets gather around the least of
    their neighbours; sets of one neighbourhood are cut into pieces of about ``PIECE`` shingles, and two pieces with a candidate
    pair between them are verified together. A set travels there as a bitmap first, and as shingles only to pieces where a
    bitmap is near its own: sets that share a chance shingle, ever more of them in larger corpora, fetch no text.
    """
    n_shingles = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counts = landed_alone(frequencies(docs, n_shingles, text, size), "frequencies")
    entries = landed_alone(index(docs, counts, n_shingles, text, size, percent), "index")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, found in _new_sets(batches, size):
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([found.tobytes()])], names=["s", "tokens"])

    near = entries.groupBy("s").agg(F.min("least").alias("least"))
    homes = landed_alone(near.join(sets, "s").select("s", "n", "t", "copies", "bits", F.least(near.s, near.least).alias("home")), "homes")
    parts = homes.groupBy("home").agg(F.ceil(F.sum("n") / F.lit(PIECE)).alias("parts")).where("parts > 1")  # the few large neighbourhoods
    piece = F.concat_ws("-", F.hex("home"), F.pmod(F.xxhash64("s"), F.coalesce("parts", F.lit(1))).cast("string"))
    placed = landed_alone(homes.join(parts, "home", "left").select("s", "n", "t", "copies", "bits", piece.alias("piece")), "pieces")
    tasks = 1 << _bits(n_shingles, SPREAD * 4)
    met = meetings(entries.drop("least").join(placed.select("s", "piece"), "s"), tasks, percent)
    kept = landed_alone(sifted(met, placed, tasks, percent), "sifted")
    some = placed.join(kept.select("s").distinct(), "s", "left_semi")
    full = _texts(docs, some.select("t"), text).mapInArrow(tokens, "s binary, tokens binary").dropDuplicates(["s"])
    dealt = kept.join(full.join(some.select("s", "copies"), "s"), "s").select("g", "right", "s", "tokens", "copies")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets_of(side: list[tuple]) -> list[tuple]:
            return [(key, np.frombuffer(raw, np.uint64), copies) for key, raw, copies in side]

        for _, one, two in _groups(batches):
            rows = _verified(sets_of(one), None if two is None else sets_of(two), percent)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.binary(), pa.binary(), pa.int64()))], names=["u", "v", "w"])

    return dealt.repartition(tasks, "g").sortWithinPartitions("g").mapInArrow(verify, "u binary, v binary, w long")


def join(docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (smallest id in reach by links) and ``n_links`` (linked documents).

    Two documents link when 100 times the shingles they share is at least ``percent`` times the shingles of either. Equal sets are one
    set before any comparison, and copies are never expanded into pairs. A document without words (also a null text)
    links with nothing and is its own component. Null ids count as larger than any id and give a null component only
    where a group has no other id. Repeated rows are documents of their own; other columns are not carried; an empty
    table gives an empty result. Shingles are compared by 64-bit, sets by 128-bit hashes.
    """
    rows = landed_alone(members(docs, doc, text, size), "members")
    sets = landed_alone(classes(rows), "sets")
    found = landed_alone(links(docs, sets, text, size, percent), "links")
    partners = found.where("w IS NOT NULL").groupBy("u").agg(F.sum("w").alias("partners"))
    roots = graph.components(found.where("v IS NOT NULL").select("u", "v"))
    rooted = sets.join(roots, sets.s == roots.node, "left").join(partners, sets.s == partners.u, "left")
    rooted = rooted.select("s", "least", F.coalesce("root", "s").alias("root"), (F.col("copies") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"))
    reach = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = landed_alone(rooted.join(reach, "root").select("s", "component", "n_links"), "named")
    component = F.when(F.col("s").isNull(), F.col("id")).otherwise(F.col("component"))
    return rows.join(named, "s", "left").select(
        F.col("id").alias(doc), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def sql() -> str:
    """The query's rows in DuckDB."""
    return r"""
    WITH RECURSIVE words AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    sets AS (
        SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g
        FROM words),
    tokens AS (SELECT r, unnest(g) AS token FROM sets),
    shared AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM tokens a JOIN tokens b ON a.token = b.token AND a.r <> b.r GROUP BY ALL),
    linked AS (
        SELECT a, b FROM shared JOIN sets x ON x.r = a JOIN sets y ON y.r = b
        WHERE 100 * k >= 80 * (len(x.g) + len(y.g) - k)),
    reach AS (SELECT r AS a, r AS b FROM sets UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a),
    least AS (SELECT a, min(s.doc_id) AS component_id FROM reach JOIN sets s ON s.r = b GROUP BY a),
    counted AS (SELECT a, count(*) AS n_links FROM linked GROUP BY a)
    SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0)::BIGINT AS n_links
    FROM sets JOIN least ON least.a = r LEFT JOIN counted ON counted.a = r"""
