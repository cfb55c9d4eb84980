"""Benchmark decontamination: fingerprints of item-sized windows, then exact weighted-shingle similarity."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from costseries.llm.common import fields

SHINGLE = 5  # words
SIMILARITY = 0.8
RADIUS = 19  # differing bits of a window that is still verified
SEGMENTS = 4  # of 16 bits: of 19 differing bits at most 4 lie in some segment
BLOCK_WORDS = 1_000_000  # words of benchmark items that one pass holds
TABLE = 20  # bits of the table that tells texts without any shingle of an item
PART = 1 << 15  # windows fingerprinted at a time
WORD = re.compile(r"\w+")

Item = tuple[object, list[str]]


def tokens(text: str | None) -> list[str]:
    """Lower-cased words: runs of letters, digits and underscores."""
    return WORD.findall(text.lower()) if text else []


def similarity(a: list[str], b: list[str], size: int = SHINGLE) -> float:
    """Weighted Jaccard similarity of two word sequences: a shingle weighs its letters times its occurrences."""
    one, two = _shingles(a, size), _shingles(b, size)
    both = sum(min(n, two[s]) * _letters(s) for s, n in one.items() if s in two)
    total = sum(n * _letters(s) for s, n in one.items()) + sum(n * _letters(s) for s, n in two.items())
    return both / (total - both) if total > both else float(bool(total))


def _shingles(found: list[str], size: int) -> Counter:
    n = min(size, len(found))
    return Counter(tuple(found[k : k + n]) for k in range(len(found) - n + 1)) if n else Counter()


def _letters(shingle: tuple[str, ...]) -> int:
    return sum(map(len, shingle))


class Shingled:
    """Hashes and weights of the shingles of a text, in order."""

    def __init__(self, found: list[str], codes: np.ndarray, size: int):
        self.found, self.size = found, size
        n = max(0, len(found) - size + 1)
        self.hashes = np.zeros(n, np.uint64)
        for k in range(size):
            self.hashes = (self.hashes ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            self.hashes ^= self.hashes >> np.uint64(29)

    @cached_property
    def weights(self) -> np.ndarray:
        sizes = np.cumsum([0, *map(len, self.found)], dtype=np.int64)
        return sizes[self.size : self.size + len(self.hashes)] - sizes[: len(self.hashes)]

    def fingerprints(self, first: int, last: int, width: int) -> np.ndarray:
        """Weighted SimHash of the windows of ``width`` shingles that start at first..last - 1."""
        h = self.hashes[first : last + width - 1]
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int64)
        signed = (2 * bits - 1) * self.weights[first : last + width - 1, None]
        sums = np.concatenate((np.zeros((1, 64), np.int64), signed.cumsum(0)))
        packed = np.packbits(sums[width:] - sums[:-width] > 0, axis=1)
        return packed.view(">u8").reshape(-1).astype(np.uint64)


class _Words(dict):
    """Hash of each word, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = got = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return got

    def codes(self, found: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def among(hashes: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which hashes occur in an ordered array."""
    return ordered[np.minimum(np.searchsorted(ordered, hashes), len(ordered) - 1)] == hashes


class Length:
    """The items of one length with a multi-index over their fingerprints."""

    def __init__(self, items: list[Item], size: int, known: _Words):
        self.items, self.size = items, size
        shingled = [Shingled(w, known.codes(w), size) for _, w in items]
        self.width = len(shingled[0].hashes)
        self.prints = np.concatenate([s.fingerprints(0, 1, self.width) for s in shingled])
        self.own = np.unique(np.concatenate([s.hashes for s in shingled]))
        self.weight = np.array([s.weights.sum() for s in shingled])
        masks = np.array([sum(1 << b for b in c) for r in range(RADIUS // SEGMENTS + 1) for c in combinations(range(16), r)], np.uint64)
        self.near = np.zeros((SEGMENTS, 1 << 16), bool)  # per segment, the values in the balls around all items
        for k in range(SEGMENTS):
            values = (self.prints >> np.uint64(16 * k)) & np.uint64(0xFFFF)
            self.near[k][(values[:, None] ^ masks).ravel().astype(np.int64)] = True

    def candidates(self, text: Shingled, shared: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, item) of all windows within the radius that share a shingle with an item of this length.

        ``shared`` has the places of shingles that any item has. A window without a common shingle has
        similarity zero, so it needs no fingerprint. A text shorter than the items is one window; an item that
        outweighs it too much to be similar is left out.
        """
        n = len(text.hashes) - self.width + 1
        own = shared[among(text.hashes[shared], self.own)]
        if not len(own):
            return
        if n <= 0:
            near = np.bitwise_count(self.prints ^ text.fingerprints(0, 1, len(text.hashes))[0]) <= RADIUS
            for i in np.flatnonzero(near & (self.weight * SIMILARITY <= text.weights.sum())):
                yield 0, int(i)
            return
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, np.minimum(np.maximum(own - self.width + 1, 0), n), 1)
        np.add.at(change, np.minimum(own + 1, n), -1)
        open_ = np.flatnonzero(change[:-1].cumsum())
        runs = np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1)
        for run in runs:
            for first in range(int(run[0]), int(run[-1]) + 1, PART):
                last = min(first + PART, int(run[-1]) + 1)
                prints = text.fingerprints(first, last, self.width)
                hit = np.zeros(len(prints), bool)
                for k in range(SEGMENTS):
                    hit |= self.near[k][((prints >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64)]
                for w in np.flatnonzero(hit):
                    for i in np.flatnonzero(np.bitwise_count(self.prints ^ prints[w]) <= RADIUS):
                        yield first + int(w), int(i)


class Matcher:
    """Finds the items of a benchmark block in texts."""

    def __init__(self, items: list[Item]):
        self.known = _Words()
        lengths: dict[int, list[Item]] = defaultdict(list)
        for item in items:
            if item[1]:
                lengths[len(item[1])].append(item)
        self.lengths = [Length(own, min(SHINGLE, n), self.known) for n, own in sorted(lengths.items())]
        sizes = {x.size for x in self.lengths}
        self.all = {s: np.unique(np.concatenate([x.own for x in self.lengths if x.size == s])) for s in sizes}
        self.first = {s: np.zeros(1 << TABLE, bool) for s in sizes}  # the same by their first bits, for a quick look
        for s, own in self.all.items():
            self.first[s][(own >> np.uint64(64 - TABLE)).astype(np.int64)] = True

    def leaks(self, text: str | None) -> list[tuple[object, float, int]]:
        """(item, similarity, first word) of every item that a window of its own size, or the whole of a shorter text, resembles, at its best window."""
        found = tokens(text)
        best: dict[tuple[int, int], tuple[float, int]] = {}
        codes, shingled = self.known.codes(found), {}
        for size, first in self.first.items():
            one = Shingled(found, codes, size)
            at = np.flatnonzero(first[(one.hashes >> np.uint64(64 - TABLE)).astype(np.int64)])
            at = at[among(one.hashes[at], self.all[size])]
            if len(at):
                shingled[size] = one, at
        for k, length in enumerate(self.lengths):
            if length.size in shingled:
                for start, i in length.candidates(*shingled[length.size]):
                    words = length.items[i][1]
                    got = similarity(found[start : start + len(words)], words)
                    if got >= SIMILARITY and got > best.get((k, i), (0.0, 0))[0]:
                        best[k, i] = got, start
        return [(self.lengths[k].items[i][0], s, at) for (k, i), (s, at) in sorted(best.items())]


def blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[Item]]:
    """Items in blocks of bounded size; the whole benchmark is read, one block at a time."""
    block, held = [], 0
    for row in benchmark.select(item, text).toLocalIterator():
        words = tokens(row[1])
        block.append((row[0], words))
        held += len(words) + 1
        if held >= BLOCK_WORDS:
            yield block
            block, held = [], 0
    if block:
        yield block


def find(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and leaked item: both ids, the similarity and the first word of the best window.

    All windows of all texts are searched for all items; a text shorter than an item is one window. Null or empty texts and items without a word leak
    nothing; an item of fewer than five words is one shingle and must occur word by word. Repeated documents
    and items give a row each; empty tables give an empty result; other columns are not carried.
    """
    kinds = docs.schema[doc].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = fields(f"doc {kinds[0]}, item {kinds[1]}, similarity double, first_word long")
    rows = docs.select(docs[doc].alias("doc"), docs[text].alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    item_type = to_arrow_type(benchmark.schema[item].dataType)

    for block in blocks(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            for batch in batches:
                got = [(k, *leak) for k, value in enumerate(batch.column(1)) for leak in matcher.leaks(value.as_py())]
                if got:
                    at, items, scores, starts = zip(*got)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), pa.array(items, item_type), pa.array(scores), pa.array(starts, pa.int64())],
                        names=schema.names,
                    )

        out = out.unionAll(rows.mapInArrow(run, schema))
    return out.withColumnRenamed("doc", doc).withColumnRenamed("item", item if item != doc else f"{item}_2")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without a leaked item, with all their columns; no shuffle.

    Null and empty texts, and all documents if the benchmark is empty, stay; repeated rows stay or go together. An
    empty table gives an empty result. What counts as leaked says ``find``.
    """
    at, schema = docs.columns.index(text), docs.schema
    for block in blocks(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            for batch in batches:
                yield batch.filter(pa.array([not matcher.leaks(value.as_py()) for value in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
