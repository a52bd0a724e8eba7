"""Token ids in Simple-8b words, written to and read from files in ascending document order.

A 64-bit word holds a 4-bit selector and 60 bits of payload: selector s > 0 packs ``PER_WORD[s]``
values of ``60 // PER_WORD[s]`` bits, the first value lowest. Selector 0 is an escape: the next
word is one value of up to 64 bits. A block is a Parquet row; it starts and ends with a document
and carries the place of its first id in the file, each document's id and length, and the places
of its escapes, so that it is decoded on its own, without a loop over words. Files are written by
Spark, hence to any file system and with its commit of whole tasks.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgetide.llm.tokens import encoded
from edgetide.storage import scratch_path

# Values in a word, by selector; selector 0 is the escape.
PER_WORD = (0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BLOCK_IDS = 1 << 16

_BLOCKS = (
    "file int, first long, doc_ids array<bigint>, lengths array<bigint>, "
    "n_ids long, escapes binary, words binary"
)
_ARROW = pa.schema(
    [
        ("file", pa.int32()),
        ("first", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("n_ids", pa.int64()),
        ("escapes", pa.binary()),
        ("words", pa.binary()),
    ]
)
_FOUND = "doc_id bigint, file int, at long, n_tokens long, ids_crc32 long"


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, at least 1."""
    if not len(values) or values.max() < 1 << 32:
        return np.maximum(np.frexp(values.astype(np.float64))[1], 1).astype(np.uint8)
    high = (values >> np.uint64(32)).astype(np.float64)
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.float64)
    bits = np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1])
    return np.maximum(bits, 1).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, indexes of the words that are escaped values) of unsigned integers."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    bits = _bits(values)
    chosen = np.zeros(n + 1, np.uint8)  # the selector if a word starts here
    need, span = bits.copy(), 1  # most bits among the `span` values from here on
    for selector in range(len(PER_WORD) - 1, 0, -1):
        per = PER_WORD[selector]
        if per > n:
            break
        while span < per:
            step = min(span, per - span)
            shifted = np.full(n, 255, np.uint8)
            shifted[: n - step] = need[step:]
            need = np.maximum(need, shifted)
            span += step
        chosen[:n][need <= 60 // per] = selector
        if not (need <= 60 // per).any():
            # longer runs need even narrower values
            break
    # as bytes, whose items cost no memory of their own
    step = np.array([1, *PER_WORD[1:]], np.uint8)[chosen].tobytes()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    selectors = chosen[starts]
    escaped = selectors == 0
    place = np.arange(len(starts)) + np.concatenate(([0], np.cumsum(escaped)[:-1]))[: len(starts)]
    words = np.zeros(len(starts) + int(escaped.sum()), np.uint64)
    for selector in range(1, len(PER_WORD)):
        own = starts[selectors == selector]
        if len(own):
            per = PER_WORD[selector]
            width = np.uint64(60 // per)
            packed = np.full(len(own), np.uint64(selector) << np.uint64(60), np.uint64)
            for k in range(per):
                packed |= values[own + k] << (np.uint64(k) * width)
            words[place[selectors == selector]] = packed
    escapes = place[escaped] + 1
    words[escapes] = values[starts[escaped]]
    return words, escapes.astype(np.uint32)


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The values behind ``encode``, a vector operation for each selector."""
    words = np.asarray(words, np.uint64)
    plain = np.ones(len(words), bool)
    plain[np.asarray(escapes, np.int64)] = False
    heads = np.flatnonzero(plain)
    selectors = (words[heads] >> np.uint64(60)).astype(np.int64)
    counts = np.array([1, *PER_WORD[1:]], np.int64)[selectors]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    starts = ends - counts
    for selector in np.unique(selectors):
        own = selectors == selector
        if selector == 0:
            out[starts[own]] = words[heads[own] + 1]
            continue
        per = PER_WORD[selector]
        width = 60 // per
        mask = np.uint64((1 << width) - 1)
        for k in range(per):
            out[starts[own] + k] = (words[heads[own]] >> np.uint64(k * width)) & mask
    return out


def _write_blocks(batches: Iterator[pa.RecordBatch], path: str | None, block_ids: int):
    context = TaskContext.get()
    file = context.partitionId() if context else 0
    first, ids, lengths, size, packed = 0, [], [], 0, []

    def block() -> pa.RecordBatch:
        words, escapes = encode(np.frombuffer(b"".join(packed), "<u4"))
        row = {
            "file": file,
            "first": first,
            "doc_ids": ids,
            "lengths": lengths,
            "n_ids": size,
            "escapes": escapes.astype("<u4").tobytes(),
            "words": words.astype("<u8").tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema=_ARROW)

    for doc_id, found in encoded(batches, path):
        ids.append(doc_id)
        packed.append(found)
        lengths.append(len(found) // 4)
        size += lengths[-1]
        if size >= block_ids:
            yield block()
            first += size
            ids, lengths, size, packed = [], [], 0, []
    if ids:
        yield block()


def _read_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples():
            found = decode(np.frombuffer(row.words, "<u8"), np.frombuffer(row.escapes, "<u4"))
            if len(found) != row.n_ids:
                raise ValueError(f"file {row.file}: {len(found)} ids in place of {row.n_ids}")
            packed = found.astype("<u4").tobytes()
            lengths = np.asarray(row.lengths, np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            crc = [zlib.crc32(packed[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)]
            yield pd.DataFrame(
                {
                    "doc_id": pd.array(list(row.doc_ids), dtype="Int64"),
                    "file": row.file,
                    "at": row.first + starts,
                    "n_tokens": lengths,
                    "ids_crc32": crc,
                }
            )


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode whole texts and write them under ``folder``, ordered by id within and across files.

    Each document ends with id 0, so an empty or null text is that one id. Null ids come first.
    """
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text")
    )
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")

    def work(batches):
        return _write_blocks(batches, tokenizer, block_ids)

    ordered.mapInArrow(work, _BLOCKS).write.parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the decoded ids of each document under ``folder``.

    ``start`` counts the ids of all documents before; a file's own start comes from the files'
    totals, one row for each file.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(folder)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        blocks.groupBy("file")
        .agg(F.sum("n_ids").alias("ids"))
        .select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    )
    documents = blocks.mapInPandas(_read_blocks, _FOUND)
    return documents.join(files, "file").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the documents' ids to a scratch folder and read them back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    write_tokens(docs, folder, tokenizer)
    return read_tokens(spark, folder)
