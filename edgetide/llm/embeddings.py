"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its ``NEAREST`` nearest pivots in the order of their distance; the pivots
are a bounded, thinned sample of the vectors. Two vectors share a pivot where it stands in both
orders, at places that are at most ``MOVED`` apart. Those that share ``SHARED`` pivots meet in the
inverted list of one of the ``NEAREST - SHARED + 1`` rarest. No two pivots are nearer than
``APART``, so a clump of near copies has about one, and its members share the pivots around it. A
list is cut into blocks; a task takes two blocks, counts shared pivots through the blocks' own
inverted lists and verifies the pairs that share enough by cosine, in double precision. It returns
sums and labels, never pairs.
"""

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgetide.llm.components import components
from edgetide.storage import store

COSINE = 0.95
NEAREST = 16
SHARED = 6
MOVED = 12
APART = 0.9
ROWS_PER_PIVOT = 64
FEWEST, MOST = 64, 16_384
BLOCK = 1024

_CLASSED = "vec_id bigint, class binary, vec binary"
_FOUND = "id long, links long, label long"


def _unit(vec: np.ndarray) -> np.ndarray:
    return vec / np.linalg.norm(vec, axis=-1, keepdims=True)


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector as 64-bit floats with a digest of them; neither for one that links to nothing."""
    for batch in batches:
        vectors, classes = [], []
        for values in batch.column("embedding").to_pylist():
            vec = None
            if values and None not in values:
                vec = np.array(values, "<f8")
                vec += 0.0  # one zero only
                if not np.isfinite(vec).all() or not vec.any():
                    vec = None
            vectors.append(None if vec is None else _scaled(vec).tobytes())
            classes.append(
                None if vec is None else hashlib.blake2b(vec.tobytes(), digest_size=16).digest()
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(classes, pa.binary()), pa.array(vectors, pa.binary())],
            names=["vec_id", "class", "vec"],
        )


def _scaled(vec: np.ndarray) -> np.ndarray:
    """Divided by the largest component, so that squares neither overflow nor vanish."""
    return (vec / np.abs(vec).max()).astype("<f8")


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1))


def _thinned(sample: np.ndarray, apart: float = APART) -> np.ndarray:
    """The unit vectors that are not nearer than ``apart`` to one taken before them."""
    kept = sample[:0]
    for start in range(0, len(sample), 512):
        part = sample[start : start + 512]
        if len(kept):
            part = part[(part @ kept.T).max(1) < apart]
        free = np.ones(len(part), bool)
        for i, near in enumerate(part @ part.T >= apart):
            if free[i]:
                free[i + 1 :] &= ~near[i + 1 :]
        kept = np.concatenate([kept, part[free]])
    return kept


def _nearest(
    batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray], nearest: int
) -> Iterator[pa.RecordBatch]:
    """The nearest pivots of each vector, nearest first; pivots are those of its dimension."""
    for batch in batches:
        vectors = batch.column("vec").to_pylist()
        found: list = [None] * len(vectors)
        sizes = np.array([len(x) for x in vectors])
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            of = pivots[int(size)]
            count = min(nearest, len(of))
            for start in range(0, len(own), 512):
                part = own[start : start + 512]
                near = _matrix([vectors[i] for i in part]) @ of.T
                best = np.argpartition(-near, count - 1, axis=1)[:, :count]
                order = np.lexsort((best, -np.take_along_axis(near, best, 1)))
                best = np.take_along_axis(best, order, 1)
                for i, row in zip(part, best, strict=True):
                    found[i] = row.astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("copies"), pa.array(vectors, pa.binary()),
             pa.array(found, pa.list_(pa.int32()))],
            names=["id", "copies", "vec", "near"],
        )


def _entries(
    batches: Iterator[pa.RecordBatch], ranks: dict[int, np.ndarray], shared: int, nearest: int
) -> Iterator[pa.RecordBatch]:
    """A row for each list a vector is in; ``near`` by rank, each with its place in the order."""
    for batch in batches:
        sizes, lists, at, nears, places = [], [], [], [], []
        vectors, near = batch.column("vec").to_pylist(), batch.column("near").to_pylist()
        for i, own in enumerate(near):
            size = len(vectors[i])
            ranked = ranks[size][own].astype(np.int32)
            order = np.argsort(ranked)  # the place of each in the vector's order of pivots
            ranked = ranked[order]
            need = min(shared, len(ranked))
            for pivot in ranked[: len(ranked) - need + 1].tolist():
                sizes.append(size)
                lists.append(pivot)
                at.append(i)
                nears.append(ranked.tobytes())
                places.append(order.astype(np.int32).tobytes())
        take = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(sizes, pa.int32()), pa.array(lists, pa.int32())]
            + [batch.column(x).take(take) for x in ("id", "copies", "vec")]
            + [pa.array(nears, pa.binary()), pa.array(places, pa.binary())],
            names=["size", "pivot", "id", "copies", "vec", "near", "places"],
        )


def _inverted(side: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """pivot -> (rows it is near to, its place in the order of each)."""
    near, places = (np.frombuffer(b"".join(side[x]), np.int32) for x in ("near", "places"))
    rows = np.repeat(np.arange(len(side)), [len(x) // 4 for x in side["near"]])
    order = np.argsort(near, kind="stable")
    names, starts = np.unique(near[order], return_index=True)
    parts = (np.split(x[order], starts[1:]) for x in (rows, places))
    return dict(zip(names.tolist(), zip(*parts, strict=True), strict=True))


def _compare(frame: pd.DataFrame, shared: int, moved: int, cosine: float) -> pd.DataFrame:
    """Links between (or inside) the two blocks of a list: sums of copies, and a common label."""
    pivot, same = int(frame["pivot"].iloc[0]), frame["low"].iloc[0] == frame["high"].iloc[0]
    left = frame if same else frame[frame["block"] == frame["low"]]
    right = left if same else frame[frame["block"] == frame["high"]]
    empty = pd.DataFrame({"id": [], "links": [], "label": []}, dtype="int64")
    if not len(left) or not len(right):
        return empty
    need = min(shared, len(left["near"].iloc[0]) // 4)
    lists_a = _inverted(left)
    lists_b = lists_a if same else _inverted(right)
    counts = np.zeros((len(left), len(right)), np.uint8)
    earlier = np.zeros(counts.shape, bool)  # they meet in the list of a rarer pivot
    for name, (rows, places) in lists_a.items():
        if name in lists_b:
            others, there = lists_b[name]
            cell = np.ix_(rows, others)
            counts[cell] += np.abs(places[:, None] - there) <= moved
            if name < pivot:
                earlier[cell] = True
    pairs = (counts >= need) & ~earlier
    if same:
        pairs &= np.tri(len(left), k=-1, dtype=bool).T
    if not pairs.any():
        return empty
    a = _matrix(list(left["vec"]))
    b = a if same else _matrix(list(right["vec"]))
    pairs &= a @ b.T >= cosine
    i, j = np.nonzero(pairs)
    if not len(i):
        return empty
    ids = np.concatenate([left["id"].to_numpy(), right["id"].to_numpy()])
    copies = np.concatenate([left["copies"].to_numpy(), right["copies"].to_numpy()])
    j = j + len(left)
    links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
    label = ids.copy()
    while True:
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        if same:  # both halves of the arrays are the same rows
            half = np.minimum(label[: len(left)], label[len(left) :])
            label = np.concatenate([half, half])
        if (label == before).all():
            break
    hit = links > 0
    return pd.DataFrame(
        {"id": ids[hit], "links": links[hit].astype(np.int64), "label": label[hit]}
    )


def _one_argument(work):
    return lambda frame: work(frame)


def near_duplicate_vectors(
    table: DataFrame,
    cosine: float = COSINE,
    nearest: int = NEAREST,
    shared: int = SHARED,
    moved: int = MOVED,
    block: int = BLOCK,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each vector.

    ``n_links`` counts the other vectors found with at least ``cosine``, copies included;
    ``component_id`` is the smallest id reachable. Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing, and vectors of different lengths not with each
    other. Equal vectors are one class, so their copies never meet in a list. An empty table gives
    no rows; other columns are ignored. Pivots are drawn as fit ``ROWS_PER_PIVOT``, within ``FEWEST``
    and ``MOST``, for each length, and thinned.
    """
    rows = table.select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("embedding"),
    )
    rows, _ = store(rows.mapInArrow(_valid, _CLASSED), "vectors")
    classes, _ = store(
        rows.where("class is not null")
        .groupBy("class")
        .agg(
            F.min("vec_id").alias("least"),
            F.count(F.lit(1)).alias("copies"),
            F.first("vec").alias("vec"),
        )
        .withColumn("id", F.monotonically_increasing_id()),
        "vector-classes",
    )
    size = F.octet_length("vec")
    counts = {r["size"]: r["count"] for r in classes.groupBy(size.alias("size")).count().collect()}
    pivots = {}
    for length, count in counts.items():
        most = max(FEWEST, min(MOST, count // ROWS_PER_PIVOT))
        sample = classes.where(size == length).orderBy(F.xxhash64("class"), "class").limit(most)
        found = [bytes(r["vec"]) for r in sample.select("vec").collect()]
        pivots[length] = _thinned(_matrix(found))
    described, _ = store(
        classes.select("id", "copies", "vec").mapInArrow(
            partial(_nearest, pivots=pivots, nearest=nearest),
            "id long, copies long, vec binary, near array<int>",
        ),
        "described",
    )
    used: dict[int, np.ndarray] = {length: np.zeros(len(x)) for length, x in pivots.items()}
    entries = described.select(size.alias("size"), F.explode("near").alias("pivot"))
    for row in entries.groupBy("size", "pivot").count().collect():  # a row for each pivot
        used[row["size"]][row["pivot"]] = row["count"]
    ranks = {length: np.argsort(np.argsort(x, kind="stable")) for length, x in used.items()}
    lists = described.mapInArrow(
        partial(_entries, ranks=ranks, shared=shared, nearest=nearest),
        "size int, pivot int, id long, copies long, vec binary, near binary, places binary",
    )
    lists, _ = store(lists, "pivot-lists")
    blocks = F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")
    cut = (
        lists.join(F.broadcast(lists.groupBy("size", "pivot").agg(blocks)), ["size", "pivot"])
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("blocks", "other")
    )
    compare = partial(_compare, shared=shared, moved=moved, cosine=cosine)
    found, _ = store(
        cut.groupBy("size", "pivot", "low", "high").applyInPandas(_one_argument(compare), _FOUND),
        "vector-links",
    )
    roots = components(found.select(F.col("id").alias("a"), F.col("label").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = (
        classes.select("id", "class", "copies", "least")
        .join(links, "id", "left")
        .join(roots.toDF("id", "root"), "id", "left")
        .withColumn("root", F.coalesce("root", "id"))
    )
    least = joined.groupBy("root").agg(F.min("least").alias("component"))
    of_class = joined.join(least, "root").select(
        "class", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return rows.drop("vec").join(of_class, "class", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
