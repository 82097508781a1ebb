"""Rows of numbers that change tasks in packed pieces, one for each home of keys, and not one by one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame

from vecloom.llm.text import mixed, steps

#: The columns of a frame of pieces.
PIECES = "home long, rows binary"
#: Neighbours with the same upper bits of their row numbers change tasks together, so much text at most at a time.
CHUNK_BITS, CHUNK_BYTES = 7, 1 << 19


def packed(key: np.ndarray, *others: np.ndarray) -> bytes:
    """Rows by ascending key in bytes that compress well: differences of keys, and the other columns, by byte plane."""
    order = np.argsort(key, kind="stable")
    wide = np.stack([np.diff(key[order], prepend=0), *(x[order] for x in others)]).astype("<i8")
    return np.ascontiguousarray(wide.view(np.uint8).reshape(len(wide), -1, 8).transpose(0, 2, 1)).tobytes()


def unpacked(blobs: list[bytes], columns: int) -> tuple[np.ndarray, ...]:
    """The columns of all rows; the first one is the key."""
    parts = []
    for blob in blobs:
        planes = np.frombuffer(blob, np.uint8).reshape(columns, 8, -1)
        wide = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[:, :, 0]
        parts.append(np.concatenate([np.cumsum(wide[:1], axis=1), wide[1:]]))
    return tuple(np.concatenate(parts, axis=1))


def dealt(home: np.ndarray, tasks: int, columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    """The rows in one piece of bytes for each home that has any."""
    order = np.argsort(home, kind="stable")
    cuts = np.searchsorted(home[order], np.arange(tasks + 1))
    full = np.flatnonzero(np.diff(cuts))
    blobs = [packed(*(x[order[cuts[h] : cuts[h + 1]]] for x in columns)) for h in full.tolist()]
    return pa.RecordBatch.from_arrays([pa.array(full), pa.array(blobs, pa.binary())], ["home", "rows"])


def home_of(key: np.ndarray, tasks: int) -> np.ndarray:
    return (mixed(key.view(np.uint64)) % np.uint64(tasks)).astype(np.int64)


def blobs(batches: Iterator[pa.RecordBatch]) -> list[bytes]:
    return [blob for batch in batches for blob in batch.column(1).to_pylist()]


def chunks(frame: DataFrame, row: str, text: str) -> DataFrame:
    """(chunk, rows): the rows of a written frame, neighbours as one compressed Arrow stream.

    Texts that change tasks so take about half of the disk that they take one by one. A chunk may
    come in several streams; `row` is a number from `with_row`.
    """
    place = frame.columns.index(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in steps(batches, text, CHUNK_BYTES):
            chunk = batch.column(place).to_numpy() >> CHUNK_BITS
            first = run_starts(chunk)
            found = []
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(chunk)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                    out.write_batch(batch.slice(a, b - a))
                found.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(chunk[first]), pa.array(found, pa.binary())], ["chunk", "rows"])

    return frame.mapInArrow(run, "chunk long, rows binary")


def met_rows(batches: Iterator[pa.RecordBatch], row: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, pa.StructArray]]:
    """The rows of each stream with the items (structs with a row number) that belong to them, by the place of their row.

    Batches hold the streams and the lists of their chunks' items, which may be null.
    """
    for batch in batches:
        for k, stream in enumerate(batch.column(0).to_pylist()):
            with pa.ipc.open_stream(stream) as source:
                rows = source.read_next_batch()
            items = batch.column(1).slice(k, 1).flatten()
            number, wanted = rows.column(row).to_numpy(), items.field("row").to_numpy()
            order = np.argsort(number, kind="stable")
            place = order[np.minimum(np.searchsorted(number, wanted, sorter=order), len(number) - 1)]
            own = number[place] == wanted
            yield rows, place[own], items.filter(pa.array(own))


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal values of sorted columns begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, np.any([x[1:] != x[:-1] for x in columns], axis=0)])
