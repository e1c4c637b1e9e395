"""Operator 12, the fill-in-middle transformation by secondary-sort assembly.

A text is cut into pieces of whole units, keyed by row and output position.
Rows are dealt to tasks and their pieces sorted by position, so the output
streams through an incremental digest and is never held whole.  Sorted again
inside the same tasks, by what the markers of the output say, the pieces give
the text back.  ``repartition`` followed by ``sortWithinPartitions`` on the key
and the position is Spark's repartition-and-sort, with an external sort.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
PLAIN_FROM, SPM_BELOW = 90, 20     # of 100
CHUNK_UNITS = 4_096                # units in a piece at most

_HEAD = [("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
_PIECE = pa.schema([*_HEAD, ("pos", pa.int64()), ("piece", pa.string())])
_BACK = pa.schema([*_HEAD, ("section", pa.int32()), ("pos", pa.int64()), ("piece", pa.string()), ("output_sha256", pa.string())])
_DONE = pa.schema([*_HEAD[1:], ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_SQL = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SQL[f.type]}" for f in schema)


def draws(doc_id: int | None) -> list[int]:
    """h1 to h4 of an id (a null id counts as the empty string)."""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[8 * i:8 * i + 8], 16) for i in range(4)]


def unit_starts(text: str) -> np.ndarray:
    """Where units begin, code points: a run of ASCII letters is one unit, any
    other code point is one; the text's length comes last."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((c | 32) >= 97) & ((c | 32) <= 122)
    begin = ~letter
    begin[:1] = True
    begin[1:] |= ~letter[:-1]
    return np.append(np.flatnonzero(begin), len(c))


def _form(text: str, h: list[int]) -> str:
    if not text or any(m in text for m in MARKERS) or h[2] % 100 >= PLAIN_FROM:
        return "plain"
    return "spm" if h[3] % 100 < SPM_BELOW else "psm"


def _cut(chunk: int):
    """Arrow task: the pieces of every text.  The piece at position 0 is empty
    and carries what is known of the row."""
    def pieces(row, doc_id, text):
        text, h = text or "", draws(doc_id)
        at = unit_starts(text)
        n, form = len(at) - 1, _form(text, h)
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        known = (row, doc_id, n, form, *((None, None) if form == "plain" else (int(at[a]), int(at[b] - at[a]))))
        yield (*known, 0, "")
        sections = {"plain": [(None, 0, n)], "psm": [(PREFIX, 0, a), (SUFFIX, b, n), (MIDDLE, a, b)],
                    "spm": [(SUFFIX, b, n), (PREFIX, 0, a), (MIDDLE, a, b)]}[form]
        pos = 0
        for marker, lo, hi in sections:
            if marker:
                pos += 1
                yield row, None, None, None, None, None, pos, marker
            for i in range(lo, hi, chunk):
                pos += 1
                yield row, None, None, None, None, None, pos, text[at[i]:at[min(i + chunk, hi)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for row, doc_id, text in _read(batches, ["row", "doc_id", "text"]):
                yield from pieces(row, doc_id, text)
        yield from _write(rows(), _PIECE)
    return run


def _read(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for b in batches:
        for at in range(0, b.num_rows, 512):     # a few texts at a time are Python objects
            part = b.slice(at, 512)
            yield from zip(*(part.column(n).to_pylist() for n in names))


def _write(rows: Iterator[tuple], schema: pa.Schema, size: int = 2_048, chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``size`` rows and about ``chars`` characters of pieces."""
    text_at, held, n = schema.get_field_index("piece"), [], 0
    for row in rows:
        held.append(row)
        n += len(row[text_at] or "") if text_at >= 0 else 0
        if len(held) >= size or n >= chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _stream_output():
    """Arrow task over pieces by (row, pos): the digest of every row's output,
    and its pieces under the place they have in the text.  The place comes from
    the output alone: a marker says what section follows it, and no piece of
    the text equals a marker, or the form were plain."""
    order = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            known = digest = None
            section = 0
            for row, *head, pos, piece in _read(batches, _PIECE.names):
                if pos == 0:
                    if known:
                        yield (*known, -1, 0, None, digest.hexdigest())
                    known, digest, section = (row, *head), hashlib.sha256(), 0
                    continue
                digest.update(piece.encode("utf-8", "surrogatepass"))
                if known[3] != "plain" and piece in order:
                    section = order[piece]
                else:
                    yield row, None, None, None, None, None, section, pos, piece, None
            if known:
                yield (*known, -1, 0, None, digest.hexdigest())
        yield from _write(rows(), _BACK)
    return run


def _stream_restored():
    """Arrow task over pieces by (row, section, pos): one row per text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            known = digest = None
            for _, *head, section, _, piece, output in _read(batches, _BACK.names):
                if section < 0:
                    if known:
                        yield (*known, digest.hexdigest())
                    known, digest = (*head, output), hashlib.sha256()
                else:
                    digest.update(piece.encode("utf-8", "surrogatepass"))
            if known:
                yield (*known, digest.hexdigest())
        yield from _write(rows(), _DONE)
    return run


def fim_pieces(docs: DataFrame, chunk: int = CHUNK_UNITS) -> DataFrame:
    """The transformed texts as pieces: row (a number of the input row), doc_id,
    n, form, prefix_chars, middle_chars (these only at position 0), pos, piece.
    All pieces of a row are in one partition, in order of output.

    A null text counts as empty, an empty text is plain; rows that repeat are
    transformed each for itself.  ``docs`` should be a table, whose rows keep
    their order if a lost task reads them again.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_cut(chunk), _ddl(_PIECE)).repartition("row").sortWithinPartitions("row", "pos")


def fim_texts(docs: DataFrame, chunk: int = CHUNK_UNITS) -> DataFrame:
    """(doc_id, form, output): the transformed texts, whole."""
    return fim_pieces(docs, chunk).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("form").alias("form"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), "").alias("output")).drop("row")


def fim_report(docs: DataFrame, chunk: int = CHUNK_UNITS) -> DataFrame:
    """Form, cut and digests of output and restored text, a row per document."""
    back = fim_pieces(docs, chunk).mapInArrow(_stream_output(), _ddl(_BACK)).sortWithinPartitions("row", "section", "pos")
    return back.mapInArrow(_stream_restored(), _ddl(_DONE))
