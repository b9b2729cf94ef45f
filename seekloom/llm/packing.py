"""Packing of documents into sequences of a fixed number of tokens.

Bounded-space online packing. Each task keeps a fixed number of open windows. The part of a
document beyond its full windows goes to the open window where it leaves the smallest gap.
When it fits none, the fullest window is emitted: a gap of ``min_piece`` tokens or more is
filled with the document's first ids, a smaller one is padding. Windows left open by all
tasks are merged in rounds of a few tasks' windows each, until one window is left.

Null text is empty and has its end id alone. Rows may repeat; each is packed. Other columns
are ignored. An empty table gives no pieces.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekloom.llm.batches import as_batch, slices
from seekloom.llm.tokens import SLICE_BYTES, encoder
from seekloom.session import new_folder

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_OPEN = f"{PIECES}, group long, open boolean"
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary()), ("group", pa.int64()), ("open", pa.bool_())]
)
#: Tasks whose open windows are merged by one task of the next round.
FAN_IN = 64


class Windows:
    """Open windows of one task, in order of their gaps."""

    def __init__(self, size: int, count: int, min_piece: int, first_id: int):
        self.size, self.count, self.min_piece = size, count, min_piece
        self.next_id = first_id
        self.gaps: list[tuple[int, int]] = []
        self.held: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def _open(self) -> int:
        number, self.next_id = self.next_id, self.next_id + 1
        self.held[number] = []
        return number

    def _put(self, number: int, gap: int, piece: tuple) -> int:
        doc_id, start, total, ids = piece
        self.held[number].append((doc_id, start, len(ids), total, number, self.size - gap, ids.tobytes()))
        return gap - len(ids)

    def _emit(self, number: int) -> None:
        self.done.extend(self.held.pop(number))

    def _fill(self, number: int, gap: int, piece: tuple) -> tuple:
        """Fill a window's gap with the head of a piece; gives the rest."""
        doc_id, start, total, ids = piece
        self._put(number, gap, (doc_id, start, total, ids[:gap]))
        self._emit(number)
        return doc_id, start + gap, total, ids[gap:]

    def place(self, piece: tuple) -> None:
        while len(piece[3]) >= self.size:
            piece = self._fill(self._open(), self.size, piece)
        if not len(piece[3]):
            return
        at = bisect_left(self.gaps, (len(piece[3]), -1))
        if at < len(self.gaps):
            gap, number = self.gaps.pop(at)
        else:
            gap, number = self.size, None
            if len(self.gaps) >= self.count:
                left, fullest = self.gaps.pop(0)
                if left >= self.min_piece:
                    piece = self._fill(fullest, left, piece)
                else:
                    self._emit(fullest)
            number = self._open()
        gap = self._put(number, gap, piece)
        if gap:
            insort(self.gaps, (gap, number))
        else:
            self._emit(number)

    def rows(self, group: int, last: bool = False) -> pa.RecordBatch:
        """The emitted pieces; at the end those of open windows too."""
        found = [(*p, group, False) for p in self.done]
        self.done = []
        if last:
            found += [(*p, group, True) for number in sorted(self.held) for p in self.held[number]]
            self.held, self.gaps = {}, []
        return as_batch(_ARROW, *(zip(*found, strict=True) if found else [[]] * len(_ARROW)))


def _merge_round(left: DataFrame, size: int, round_number: int) -> DataFrame:
    """Fill windows one after the other with the pieces of a group of tasks."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, group = None, None
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("doc_id", "start", "doc_tokens", "ids", "group")]
            for doc_id, start, total, ids, own in zip(*columns, strict=True):
                if own != group:
                    if windows:
                        yield windows.rows(group // FAN_IN, last=True)
                    # One window at a time, always filled to the end.
                    group, windows = own, Windows(size, 1, 1, (round_number << 56) + (own << 24))
                windows.place((doc_id, start, total, np.frombuffer(ids, "<u4")))
            if windows:
                yield windows.rows(group // FAN_IN)
        if windows:
            yield windows.rows(group // FAN_IN, last=True)

    grouped = left.repartition("group").sortWithinPartitions("group", "sequence_id", "offset")
    return grouped.select(*(n for n in _ARROW.names if n != "open")).mapInArrow(merge, _OPEN)


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    max_tokens: int = 2048,
    end_id: int = 1,
    open_windows: int = 64,
    min_piece: int = 16,
) -> DataFrame:
    """Pieces of documents and their places in sequences of ``max_tokens`` tokens.

    A piece has ``length`` of its document's ``doc_tokens`` ids (the end id counts) from
    ``start`` on; they stand at ``offset`` of sequence ``sequence_id``. ``ids`` holds them as
    little-endian unsigned 32-bit integers. Sequences are shorter than ``max_tokens`` by less
    than ``min_piece``, but for the last one.

    What the tasks emit is stored in the shared folder, as merging reads it once more.
    """
    spark = documents.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        windows = Windows(max_tokens, open_windows, min_piece, task << 32)
        end = np.array([end_id], dtype="<u4")
        for batch in slices(batches, "text", SLICE_BYTES):
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, ids in zip(doc_ids, encoder(tokenizer).encode_column(batch.column("text")), strict=True):
                windows.place((doc_id, 0, len(ids) + 1, np.concatenate([ids, end])))
            yield windows.rows(task // FAN_IN)
        yield windows.rows(task // FAN_IN, last=True)

    def stored(rows: DataFrame) -> DataFrame:
        path = new_folder(spark, "packed")
        rows.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(_OPEN).parquet(path)

    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = stored(texts.mapInArrow(pack, _OPEN))
    names = [f.split()[0] for f in PIECES.split(", ")]
    packed, round_number = rows.where(~F.col("open")).select(*names), 1
    while True:
        left = rows.where("open")
        groups = left.agg(F.max("group")).first()[0]
        if groups is None:
            return packed
        rows = stored(_merge_round(left, max_tokens, round_number))
        if groups == 0:
            # One task has filled the last windows; what is still open is the last sequence.
            return packed.unionByName(rows.select(*names))
        packed = packed.unionByName(rows.where(~F.col("open")).select(*names))
        round_number += 1
