"""Token-id packing: best-fit-decreasing into rows of fixed length, by a segment tree over capacities.

Each document becomes its token ids and an end-of-document id.  A document of more than ``length`` ids
is split without loss: whole rows first, the rest is an item like any short document.  Items are placed
from long to short into the open row with the least room that still fits; the tree over room sizes
(0 .. length) finds it in log(length) steps, whatever the number of open rows.

Tokenising, splitting and packing are one map, so token ids are never shuffled.  A task packs windows
of ``window`` ids at a time (8 MB as 2-byte ids), which bounds its memory and leaves about one row in a
thousand less than full.  Rows depend on the input's partitions only; a task that is run again gives
the same rows.

A row: ``ids`` (little-endian, ``length`` ids, the tail filled with ``pad``), ``n_tokens``, ``cu_seqlens``
(0, then the end of each segment), ``position_resets`` (where position ids start again at 0), and for each segment
``doc_ids`` and ``doc_offsets`` (the place of its first id in the document).

Defined results: null or empty text has no segment; blanks are text; repeated rows and ids are packed
each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from riskloom.llm.state import prepare
from riskloom.llm.tokens import VOCABULARY, encode_column, encoder, vocabulary

LENGTH = 2048
WINDOW = 1 << 22


class Rooms:
    """Open rows by their room; a segment tree counts them."""

    def __init__(self, length: int):
        self.leaves = 1 << (length + 1 - 1).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) of the open row with the least room of at least ``size``."""
        i, count = size + self.leaves, self.count
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):  # up, to a right neighbour that has rows
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._change(room, -1)
        return room, self.rows[room].pop()


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Items of each row, best-fit-decreasing; sizes are 1 .. length."""
    rooms, rows = Rooms(length), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = rooms.take(size)
        if found is None:
            room, row = length, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(i)
        if room > size:
            rooms.add(room - size, row)
    return rows


_NAMES = ["row_id", "ids", "n_tokens", "cu_seqlens", "position_resets", "doc_ids", "doc_offsets"]


def _lists(values: list[np.ndarray], kind) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values), kind))


def _pack(tokens, length: int, eod: int, pad: int, window: int, dtype: str):
    def rows_of(items: list, number: int) -> pa.RecordBatch:
        sizes = np.array([len(x[2]) for x in items])
        rows = best_fit(sizes, length)
        ids = np.full((len(rows), length), pad, dtype)
        ends, resets, docs, offsets, filled = [], [], [], [], []
        for k, row in enumerate(rows):
            stop = np.concatenate([[0], np.cumsum(sizes[row])])
            ids[k, :stop[-1]] = np.concatenate([items[i][2] for i in row])
            ends.append(stop)
            resets.append(stop[:-1])
            docs.append([items[i][0] for i in row])
            offsets.append(np.array([items[i][1] for i in row]))
            filled.append(stop[-1])
        flat = ids.reshape(-1).view(np.uint8)
        at = pa.array(np.arange(len(rows) + 1) * length * ids.itemsize, pa.int32())
        binary = pa.Array.from_buffers(pa.binary(), len(rows), [None, at.buffers()[1], pa.py_buffer(flat)])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(number, number + len(rows))), binary, pa.array(filled, pa.int32()), _lists(ends, pa.int32()),
             _lists(resets, pa.int32()), pa.array(docs, pa.list_(pa.int64())), _lists(offsets, pa.int64())], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = encoder(tokens.value), TaskContext.get().partitionId() << 33
        items, held = [], 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode_column(encode, batch.column(1), dtype)):
                if not len(ids):
                    continue
                ids = np.append(ids, np.array([eod], dtype))
                for a in range(0, len(ids), length):
                    items.append((doc_id, a, ids[a:a + length]))
                    held += len(items[-1][2])
                    if held >= window:
                        out = rows_of(items, number)
                        number += out.num_rows
                        items, held = [], 0
                        yield out
        if items:
            yield rows_of(items, number)

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         path: str = VOCABULARY, window: int = WINDOW) -> DataFrame:
    """The packed rows of ``docs``; see the module text.  The end-of-document id is the first free one."""
    spark = docs.sparkSession
    prepare(spark, rows=1000, size="4m")
    tokens = vocabulary(spark, path)
    eod = len(tokens.value)
    dtype = "<u2" if eod < 1 << 16 else "<u4"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        _pack(tokens, length, eod, eod, window, dtype),
        "row_id long, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, "
        "doc_offsets array<long>")


def position_ids(row: Row, length: int = LENGTH) -> np.ndarray:
    """Position ids of a packed row: 0, 1, ... from each reset on."""
    out = np.arange(length)
    for start in row["position_resets"]:
        out[start:] = np.arange(length - start)
    return out


def write_packed(packed: DataFrame, path: str) -> None:
    """Id matrices, segment lengths and resets as Parquet files, one matrix row per record."""
    packed.write.mode("error").parquet(path)
