"""Sequences of fixed length by bounded-space online packing.

A partition is packed as it streams by, with at most ``OPEN`` open windows. A document is cut
into full windows; what remains goes to the open window it fits best, and where none fits and all
places are taken, the fullest window is emitted. Windows still open at a partition's end are
merged with those of other partitions by the same rule, a level of a tree at a time.
"""

import bisect
import zlib
from collections.abc import Iterator
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgetide.llm.common import small_batches
from edgetide.llm.tokens import encoded
from edgetide.storage import store

LENGTH = 1024
OPEN = 64
FAN_IN = 64
ROWS_AT_ONCE = 4096

_PIECES = (
    "part long, window long, open boolean, doc_id bigint, start long, length long, "
    "ids_crc32 long, doc_tokens long, offset long"
)
_ARROW = pa.schema(
    [
        (name, {"long": pa.int64(), "bigint": pa.int64(), "boolean": pa.bool_()}[kind])
        for name, kind in (field.split(" ") for field in _PIECES.split(", "))
    ]
)
_NAMES = [field.split(" ")[0] for field in _PIECES.split(", ")]


class Windows:
    """At most ``most`` open windows of ``length`` places; an item is anything with a size."""

    def __init__(self, length: int, most: int):
        self._length, self._most = length, most
        self._room: list[int] = []  # of the open windows, rising
        self._items: list[list] = []

    def put(self, item, size: int) -> list | None:
        """Place an item of up to ``length``; returns the items of a window that is emitted."""
        emitted = None
        at = bisect.bisect_left(self._room, size)
        if at < len(self._room):
            left, items = self._room.pop(at) - size, self._items.pop(at)
        else:
            if len(self._room) >= self._most:
                self._room.pop(0)
                emitted = self._items.pop(0)
            left, items = self._length - size, []
        items.append((item, size))
        if left == 0 and emitted is None:
            return items
        at = bisect.bisect_left(self._room, left)
        self._room.insert(at, left)
        self._items.insert(at, items)
        return emitted

    def rest(self) -> list[list]:
        return self._items


def _pack_partition(
    batches: Iterator[pa.RecordBatch], tokenizer: str | None, length: int, most: int
) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    windows, number, rows = Windows(length, most), 0, []

    def emit(items: list, is_open: bool) -> None:
        nonlocal number
        offset = 0
        for piece, size in items:
            rows.append((part, number, is_open, *piece, offset))
            offset += size
        number += 1

    def batch() -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(_NAMES)
        arrays = [pa.array(x, kind) for x, kind in zip(columns, _ARROW.types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)

    for doc_id, ids in encoded(batches, tokenizer):
        total = len(ids) // 4
        for start in range(0, total, length):
            cut = ids[4 * start : 4 * (start + length)]
            size = len(cut) // 4
            piece = (doc_id, start, size, zlib.crc32(cut), total)
            full = windows.put(piece, size) if size < length else [(piece, size)]
            if full:
                emit(full, False)
        if len(rows) >= ROWS_AT_ONCE:
            yield batch()
            rows.clear()
    for items in windows.rest():
        emit(items, True)
    yield batch()


def _merge(frame: pd.DataFrame, length: int, most: int, root: bool) -> pd.DataFrame:
    """Merge a group's open windows; the pieces of one stay together."""
    frame = frame.sort_values(["part", "window", "offset"], ignore_index=True)
    part = int(frame["part"].iloc[0]) // FAN_IN
    windows, number, place = Windows(length, most), 0, {}

    def emit(items: list, is_open: bool) -> None:
        nonlocal number
        base = 0
        for name, size in items:
            place[name] = (number, is_open, base)
            base += size
        number += 1

    sizes = frame.groupby(["part", "window"], sort=True)["length"].sum()
    for name, size in sizes.items():
        full = windows.put(name, int(size))
        if full:
            emit(full, False)
    for items in windows.rest():
        emit(items, not root)
    found = [place[name] for name in zip(frame["part"], frame["window"], strict=True)]
    frame["part"], frame["window"] = part, [x[0] for x in found]
    frame["open"] = [x[1] for x in found]
    frame["offset"] += [x[2] for x in found]
    return frame[_NAMES]


def _one_argument(work):
    return lambda frame: work(frame)


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    length: int = LENGTH,
    most: int = OPEN,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), a row for each piece.

    Ids are those of the whole text, then id 0; a null or empty text is that one id. Each id lies
    in one piece; a sequence holds at most ``length`` ids and its pieces' offsets leave no gap.
    Rows with equal ids are documents of their own. An empty table gives no rows; other columns
    are ignored. ``sequence_id`` is unique, made of level, part and window.
    """
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text")
    )

    def pack(batches):
        return _pack_partition(batches, tokenizer, length, most)

    with small_batches(docs.sparkSession):
        level, _ = store(rows.mapInArrow(pack, _PIECES), "pieces")
    parts = (level.agg(F.max("part")).first()[0] or 0) + 1
    done, depth = [], 0
    while True:
        named = F.lit(depth << 58) + F.shiftleft(F.col("part"), 32) + F.col("window")
        done.append(level.where("not open").withColumn("sequence_id", named))
        if depth and parts == 1:
            break
        parts, depth = -(-parts // FAN_IN), depth + 1

        merge = partial(_merge, length=length, most=most, root=parts == 1)
        group = F.floor(F.col("part") / FAN_IN).alias("group")
        left = level.where("open").groupBy(group)
        level, _ = store(left.applyInPandas(_one_argument(merge), _PIECES), "merged")
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
