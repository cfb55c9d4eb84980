"""Fill-in-middle: texts cut into prefix, middle and suffix and put in another order, as array operations on whole batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costseries.llm.common import fields

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# A unit on UTF-8 bytes: a run of letters, another ASCII character, or the bytes of one further code point.
UNIT = r"[A-Za-z]+|[\x00-\x7f]|[\xc0-\xff][\x80-\xbf]*"
END = b"\xff"  # a byte that no UTF-8 text holds
BYTES = 2_000_000  # of text handled at a time


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``BYTES`` of text each; one long text may be larger."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // BYTES
    for start, stop in zip(*(lambda c: (np.r_[0, c], np.r_[c, len(part)]))(np.flatnonzero(np.diff(part)) + 1)):
        if stop > start:
            yield batch.slice(start, stop - start)


def _units(raw: pa.Array) -> pa.ListArray:
    """Every text as the list of its units, with one empty unit at the end."""
    return pc.split_pattern(pc.replace_substring_regex(raw, UNIT, b"\\0" + END), END)


def _joined(values: pa.Array, parents: np.ndarray, keep: np.ndarray, rows: int) -> pa.Array:
    """The kept units of every row in one piece."""
    offsets = np.concatenate(([0], np.cumsum(np.bincount(parents[keep], minlength=rows)))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), values.filter(pa.array(keep)))
    return pc.binary_join(lists, pa.scalar(b"", pa.binary()))


def pieces(raw: pa.Array, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Units of every text, and its prefix, middle and suffix.

    The prefix ends after the smaller of ``first % (n + 1)`` and ``second % (n + 1)`` units, the middle after the larger.
    """
    lists = _units(raw)
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64) - 1
    values, parents = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    starts = np.cumsum(n + 1) - (n + 1)
    ordinal = np.arange(len(parents)) - starts[parents]
    cuts = np.sort(np.stack([first % (n + 1), second % (n + 1)]), axis=0)
    role = (ordinal >= cuts[0][parents]).astype(np.int8) + (ordinal >= cuts[1][parents]) + (ordinal >= n[parents])
    return n, [_joined(values, parents, role == k, len(raw)) for k in range(3)]


def _form(raw: pa.Array, n: np.ndarray, third: np.ndarray, fourth: np.ndarray, plain: int, spm: int) -> np.ndarray:
    tagged = np.zeros(len(raw), bool)
    for tag in (PREFIX, SUFFIX, MIDDLE):
        tagged |= pc.match_substring(raw, tag).to_numpy(zero_copy_only=False)
    stay = (n == 0) | tagged | (third % 100 >= 100 - plain)
    return np.where(stay, "plain", np.where(fourth % 100 < spm, "spm", "psm"))


def _chars(piece: pa.Array) -> pa.Array:
    return pc.utf8_length(piece.cast(pa.string())).cast(pa.int64())


def _rows(raw: pa.Array, h: list[np.ndarray], plain: int, spm: int) -> list[pa.Array]:
    n, (prefix, middle, suffix) = pieces(raw, h[0], h[1])
    form = _form(raw, n, h[2], h[3], plain, spm)
    psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, b"")
    other = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, b"")
    is_plain = pa.array(form == "plain")
    output = pc.if_else(is_plain, raw, pc.if_else(pa.array(form == "psm"), psm, other))
    null = pa.scalar(None, pa.int64())
    counts = [pc.if_else(is_plain, null, _chars(p)) for p in (prefix, middle)]
    return [pa.array(n), pa.array(form), *counts, output.cast(pa.string())]


def hashes(doc: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers of an id: the first 8-digit groups of the SHA-256 of ``seed:id`` (a null id: empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transform(docs: DataFrame, doc: str = "doc_id", text: str = "text", seed: int = 1, plain: int = 10, spm: int = 20) -> DataFrame:
    """One row per document: id, units ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and the new text ``output``.

    ``plain`` per cent of the documents stay as they are, ``spm`` per cent of the others put the suffix first. A text that is
    null or empty, or holds one of the tags, is plain; its two counts are null. Cuts depend on seed, id and text alone, so repeated
    rows give repeated results. Texts of any length are cut whole; other columns are not carried; an empty table gives an empty result.
    """
    kind = docs.schema[doc].dataType.simpleString()
    schema = fields(f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 1):
                raw = pc.fill_null(batch.column(1).cast(pa.binary()), b"")
                h = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(2, 6)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *_rows(raw, h, plain, spm)], names=schema.names)

    rows = docs.select(docs[doc].alias("id"), docs[text].alias("text"), *hashes(docs[doc], seed))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", doc)


def restored(output: pa.Array, form: pa.Array) -> pa.Array:
    """The exact texts behind outputs; a tag's first place is its own, as no text that was cut holds a tag."""
    raw, is_plain, is_psm = output.cast(pa.binary()), pc.equal(form, "plain"), pc.equal(form, "psm")

    def cut(tags: tuple[bytes, ...], mine: pa.Array) -> list[pa.Array]:
        """The pieces behind each tag; rows of another form are cut out of the bare tags."""
        found, rest = [], pc.if_else(mine, raw, pa.scalar(b"".join(tags)))
        for tag in tags:
            both = pc.split_pattern(rest, tag, max_splits=1)
            head, rest = pc.list_element(both, 0), pc.list_element(both, 1)
            found.append(head)
        return [*found[1:], rest]

    prefix, suffix, middle = cut((PREFIX, SUFFIX, MIDDLE), is_psm)
    suffix_, prefix_, middle_ = cut((SUFFIX, PREFIX, MIDDLE), pc.equal(form, "spm"))
    psm, spm = pc.binary_join_element_wise(prefix, middle, suffix, b""), pc.binary_join_element_wise(prefix_, middle_, suffix_, b"")
    return pc.if_else(is_plain, raw, pc.if_else(is_psm, psm, spm)).cast(pa.string())


def restore(rows: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """Add the text that ``output`` was made from, by output and form alone; null where either is null."""
    if name in rows.columns:
        raise ValueError(f"{name} is a column already")
    schema = fields(rows.schema.toDDL()).add(name, "string")
    at, kind = rows.columns.index(output), rows.columns.index(form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, at):
                yield pa.RecordBatch.from_arrays([*batch.columns, restored(batch.column(at), batch.column(kind))], names=schema.names)

    return rows.mapInArrow(run, schema)


def sql() -> str:
    """The query's rows in DuckDB."""
    return r"""
    WITH units AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
        FROM documents),
    numbers AS (
        SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
        FROM units),
    cuts AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM numbers),
    parts AS (
        SELECT doc_id, text, n, form, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
            coalesce(array_to_string(u[b + 1:n], ''), '') AS s
        FROM cuts)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM parts"""
