"""Helpers that run inside Arrow tasks: byte-bounded slices and per-worker caches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes one numpy pass works on (a single longer text is still taken whole).
SLICE_BYTES = 1 << 19


def cached(key: str, make: Callable, slot: str | None = None, most: int = 1):
    """``make()`` once per worker process; the functions themselves travel by value.

    Of the entries of a ``slot`` only the ``most`` last used ones stay, so a
    worker that serves one operator after another does not gather their tables.
    """
    store = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache")).__dict__
    held = store.setdefault(f"slot:{slot}", {}) if slot else store
    if key in held:
        if slot:
            held[key] = held.pop(key)
        return held[key]
    while slot and len(held) >= most:
        held.pop(next(iter(held)))
    held[key] = make()
    return held[key]


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes as uint8, offsets as int64) of a string column; nulls become empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    arr = pc.fill_null(column.cast(pa.large_string()), "")
    if len(arr) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES, rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Zero-copy cuts of the batches with at most ``limit`` text bytes and ``rows`` rows each (always at least one row)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        length = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        end = np.cumsum(length, dtype=np.int64)
        start = 0
        while start < n:
            base = end[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(end, base + limit, side="right")))
            stop = min(stop, start + rows)
            yield batch.slice(start, stop - start)
            start = stop


class Table:
    """The bytes of every id of a vocabulary."""

    def __init__(self, raw: list[bytes]):
        self.length = np.array([len(x) for x in raw], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(raw), np.uint8)

    def spelled(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        run = np.cumsum(lengths) - lengths
        return self.data[np.arange(int(lengths.sum())) + np.repeat(self.start[ids] - run, lengths)]


def decimals(ids: int) -> np.ndarray:
    """The decimal digits of the ids below ``ids``, one row each, with bytes 0 before the first."""
    text = [str(i).encode() for i in range(ids)]
    wide = len(text[-1])
    return np.frombuffer(b"".join(t.rjust(wide, b"\0") for t in text), np.uint8).reshape(ids, wide)


def bounded_batches(spark) -> None:
    """Texts travel to Python in batches bounded by bytes, so that a worker's memory does not depend on their length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def release(spark) -> None:
    """Lets Spark's cleaner drop the shuffle files of steps whose result has been written.

    The cleaner acts on objects that the driver's collectors have found dead,
    which on a driver with little to do happens every half hour.
    """
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*frames) -> None:
    """Deletes the files of written intermediate tables that nothing reads any more."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/cartwheel-cut/" not in folder:
                raise ValueError(f"{folder} is not an intermediate table")
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
