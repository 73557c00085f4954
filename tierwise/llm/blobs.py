"""Integer arrays and texts as compressed binary values, for exchanges that carry many small numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def press(body: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpress(body: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(body)


def deltas(a: np.ndarray) -> np.ndarray:
    """Differences of ascending unsigned values (the first from zero)."""
    return np.diff(a, prepend=np.uint64(0))


def _planes(values: np.ndarray, size: int) -> bytes:
    """The low ``size`` bytes of each value, byte position by byte position, so that like stands with like."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def pack_arrays(arrays: list[np.ndarray]) -> bytes:
    """Unsigned integer arrays, each as byte planes of its least sufficient width, compressed."""
    head, bodies = [len(arrays)], []
    for a in arrays:
        a = a.astype(np.uint64, copy=False)
        size = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
        head += [len(a), size]
        bodies.append(_planes(a, size))
    return press(np.array(head, "<u8").tobytes() + b"".join(bodies))


def unpack_arrays(body: bytes) -> list[np.ndarray]:
    """The arrays, as 32-bit integers where that is wide enough, else 64-bit."""
    body = unpress(body)
    count = int(np.frombuffer(body, "<u8", 1)[0])
    head = np.frombuffer(body, "<u8", 1 + 2 * count)[1:].reshape(count, 2).astype(np.int64)
    at, out = 8 * (1 + 2 * count), []
    for n, size in head:
        held = 4 if size <= 4 else 8
        planes = np.zeros((n, held), np.uint8)
        planes[:, :size] = np.frombuffer(body, np.uint8, n * size, at).reshape(size, n).T
        out.append(planes.view(f"<u{held}").ravel())
        at += n * size
    return out


def runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the runs of equal values in a grouped array."""
    cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)], strict=True)) if len(keys) else []


def _with_text(docs: DataFrame, column: str, kind: T.DataType, change) -> DataFrame:
    schema = T.StructType([T.StructField(f.name, kind if f.name == column else f.dataType) for f in docs.schema])
    place = docs.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[place] = change(columns[place])
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, schema)


def squeezed(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with a text column compressed (nulls stay), to halve what a shuffle of it writes."""

    def change(values: pa.Array) -> pa.Array:
        raw = values.cast(pa.binary())
        return pa.array([None if (b := x.as_py()) is None else press(b) for x in raw], pa.binary())

    return _with_text(docs, column, T.BinaryType(), change)


def unsqueezed(docs: DataFrame, column: str) -> DataFrame:
    def change(values: pa.Array) -> pa.Array:
        return pa.array([None if (b := x.as_py()) is None else unpress(b) for x in values], pa.binary()).cast(pa.string())

    return _with_text(docs, column, T.StringType(), change)
