"""Byte-pair encoding with forced-boundary splitting."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from costseries.llm.common import fields

CACHE = 200_000  # pieces remembered per task
CACHED = 64  # longest remembered piece, in code points or units, so that the memory is bounded in bytes
HEAP = 200  # units from which on merges are kept in a heap
NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: visible Latin-1 as it is, the rest from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Tables of a tokenizer file: byte-level BPE with an end-of-word mark and no decoder of its own."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if spec.get("decoder"):
            raise ValueError("only tokenizers without a decoder, whose tokens are joined by spaces, are known here")
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.ranks: dict[tuple[int, int], int] = {}
        self.results: list[int] = []  # token by rank
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[self.ids[a], self.ids[b]] = rank
            self.results.append(self.ids[a + b])
        letters = byte_letters()
        self.inner = [self.ids.get(c) for c in letters]
        self.last = [self.ids.get(c + self.end) for c in letters]
        back = {c: b for b, c in enumerate(letters)}
        self.tokens: dict[int, str] = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.joined: set[tuple[int, int]] = set()
        for token in self.ids:
            ended = bool(self.end) and token.endswith(self.end)
            plain = token[: -len(self.end)] if ended else token
            units = self.units(bytes(back[c] for c in plain), ended)
            self.joined.update(zip(units, units[1:]))

    def units(self, raw: bytes, ended: bool = True) -> list[int]:
        """First ids of a byte sequence; the last byte of a word has an id of its own."""
        if not raw:
            return []
        return [self.inner[b] for b in raw[:-1]] + [(self.last if ended else self.inner)[raw[-1]]]

    def fragments(self, units: list[int]) -> list[tuple[int, ...]]:
        """Cut wherever two neighbours stand side by side inside no token: no merge can ever cross."""
        joined, out, start = self.joined, [], 0
        for k, pair in enumerate(zip(units, units[1:]), 1):
            if pair not in joined:
                out.append(tuple(units[start:k]))
                start = k
        out.append(tuple(units[start:]))
        return out

    def merged(self, units: tuple[int, ...]) -> list[int]:
        """Apply the merge of the least rank, the leftmost first, until none is left."""
        ids = list(units)
        if len(ids) >= HEAP:
            return self._merged_long(ids)
        get, results = self.ranks.get, self.results
        ranks = [get(p, NEVER) for p in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NEVER:
            k = ranks.index(best)
            ids[k : k + 2] = [results[best]]
            del ranks[k]
            if k:
                ranks[k - 1] = get((ids[k - 1], ids[k]), NEVER)
            if k < len(ranks):
                ranks[k] = get((ids[k], ids[k + 1]), NEVER)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same in n log n steps: a heap of merges by rank and place over a doubly linked list."""
        get, n = self.ranks.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k) for k, p in enumerate(zip(ids, ids[1:])) if (r := get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            right = after[k]
            if ids[k] < 0 or right >= n or get((ids[k], ids[right])) != rank:
                continue  # one of the two has been merged away since
            ids[k], ids[right] = self.results[rank], -1
            after[k] = behind = after[right]
            if behind < n:
                before[behind] = k
                if (r := get((ids[k], ids[behind]))) is not None:
                    heapq.heappush(heap, (r, k))
            if (ahead := before[k]) >= 0 and (r := get((ids[ahead], ids[k]))) is not None:
                heapq.heappush(heap, (r, ahead))
        return [i for i in ids if i >= 0]


class Codec:
    """Encoder and decoder with bounded memories of pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.split = regex.compile(vocabulary.pattern)
        plain = vocabulary.pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")
        self.ascii = None if r"\p" in plain else re.compile(plain, re.ASCII)  # the same pieces of ASCII texts
        self.table = [t.encode("utf-8", "surrogatepass") for t in (vocabulary.tokens.get(i, "") for i in range(max(vocabulary.tokens) + 1))]
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.pieces: dict[str, bytes] = {}
        self.parts: dict[tuple[int, ...], list[int]] = {}

    def normalised(self, text: str) -> str:
        """NFC, then lower case letter by letter (a sigma stays a sigma at the end of a word)."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def piece(self, piece: str) -> bytes:
        ids: list[int] = []
        parts = self.parts
        for part in self.v.fragments([u for u in self.v.units(piece.encode("utf-8")) if u is not None]):
            got = parts.get(part)
            if got is None:
                got = self.v.merged(part)
                if len(part) <= CACHED:
                    if len(parts) >= CACHE:
                        parts.clear()
                    parts[part] = got
            ids += got
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        known = self.pieces
        for k, run in enumerate(self.special.split(text) if self.special and "<" in text else (text,)):
            if k % 2:
                out.append(np.array([self.v.special[run]], "<u4").tobytes())
                continue
            body = self.normalised(run)
            found = (self.ascii if self.ascii and body.isascii() else self.split).findall(body)
            got = list(map(known.get, found))
            at = -1
            for _ in range(got.count(None)):
                at = got.index(None, at + 1)
                piece = found[at]
                got[at] = ids = known.get(piece) or self.piece(piece)  # a new piece may come up again in the same text
                if len(piece) <= CACHED:
                    if len(known) >= CACHE:
                        known.clear()
                    known[piece] = ids
            out += got
        return b"".join(out)

    def decode_bytes(self, ids: bytes) -> bytes:
        """The tokens joined by spaces, as a tokenizer without a decoder puts them, in UTF-8."""
        return b" ".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: bytes) -> str:
        return self.decode_bytes(ids).decode("utf-8", "surrogatepass")


def vocabulary_text(spark: SparkSession, path: str) -> bytes:
    """Content of a tokenizer file, by Spark's readers or, for a file of this machine, from the driver's disk."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).first()["content"])
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary: str, doc: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """One row per document: id, ``n_tokens``, the ``ids`` (array of int, on wish), the digests of ids and of the decoded text.

    ``vocabulary`` is the path of a tokenizer file (a few MB, broadcast). A null or empty text has no
    tokens. Texts of any length are encoded whole. Repeated rows give repeated results; other columns
    are not carried, so names can't clash; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary_text(spark, vocabulary))
    kind = docs.schema[doc].dataType.simpleString()
    schema = fields(f"id {kind}, n_tokens long, " + "ids array<int>, " * ids + "ids_sha256 string, decoded_sha256 string")
    chars = 4_000_000  # of text in one batch that goes back

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(Vocabulary(json.loads(shared.value)))

        def batch_of(keys, coded, said) -> pa.RecordBatch:
            counts = np.array([len(c) // 4 for c in coded], np.int64)
            lists = [pa.ListArray.from_arrays(np.concatenate(([0], counts.cumsum())).astype(np.int32), np.frombuffer(b"".join(coded), "<i4"))] * ids
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, id_type), pa.array(counts), *lists, pa.array([hashlib.sha256(c).hexdigest() for c in coded]), pa.array(said)],
                names=schema.names,
            )

        for batch in batches:
            id_type, keys, coded, said, held = batch.column(0).type, [], [], [], 0
            for key, value in zip(batch.column(0), batch.column(1)):
                body = value.as_py() or ""
                one = codec.encode(body)
                keys.append(key.as_py())
                coded.append(one)
                said.append(hashlib.sha256(codec.decode_bytes(one)).hexdigest())
                held += len(body)
                if held > chars:
                    yield batch_of(keys, coded, said)
                    keys, coded, said, held = [], [], [], 0
            if keys:
                yield batch_of(keys, coded, said)

    return docs.select(docs[doc].alias("id"), docs[text].alias("text")).mapInArrow(run, schema).withColumnRenamed("id", doc)
