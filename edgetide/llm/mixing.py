"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source of S words with target T is expected T/S times: the whole part is taken
outright, the fraction is its copy probability. Two fractional documents are paired and words
are moved at random from one's expectation to the other's until one of the two is integral; the
moves keep each expectation and the pair's words. What stays fractional, one document for each
source and size class of a block, goes up a reduction tree, and at the root the largest are
settled against the pool of the smaller, so that a source misses its target by less than a
document or so.
"""

import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgetide.llm.common import buckets_for, number_in_order, word_count
from edgetide.storage import store

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2.0
ROWS_PER_BLOCK = 8192
FAN_IN = 64
SURE = 1e-9

_ROWS = "doc_id bigint, part bigint, source string, size bigint, p double, extra int"


def source_targets(
    sources: DataFrame,
    weights: tuple = WEIGHTS,
    budget: float = BUDGET,
    most: float = MOST,
) -> DataFrame:
    """``target`` for each row of ``sources`` (source, source_size).

    Weights repeat over the sources in code-point order, null last. A level c gives every source
    ``min(most * source_size, c * weight)``; resharing the excess raises c until the targets add
    up to ``budget`` times all words. Only sums come to the driver.
    """
    listed = number_in_order(sources, F.col("source").asc_nulls_last(), "sources")
    pick = F.element_at(
        F.array(*(F.lit(float(weight)) for weight in weights)),
        (F.pmod("position", F.lit(len(weights))) + 1).cast("int"),
    )
    weighed, _ = store(
        listed.select(
            "source", "source_size", pick.alias("weight"),
            (F.col("source_size") * F.lit(float(most))).alias("ceiling"),
        ),
        "weights",
    )
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * budget
    level, capped = 0.0, -1
    while True:
        above = F.col("ceiling") < F.lit(level) * F.col("weight")
        row = weighed.agg(
            F.count_if(above).alias("capped"),
            F.coalesce(F.sum(F.when(above, F.col("ceiling"))), F.lit(0.0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if row["capped"] == capped or not row["open"]:
            break
        capped, level = row["capped"], max(0.0, total - row["fixed"]) / row["open"]
    return weighed.select(
        "source", "source_size",
        F.least("ceiling", F.lit(level) * F.col("weight")).alias("target"),
    )


def _chance(seed: int, *ids) -> float:
    """A number in [0, 1) that the seed and the ids decide."""
    digest = hashlib.blake2b(repr((seed, *ids)).encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little") / 2.0**64


class _Doc:
    __slots__ = ("at", "name", "p", "size")

    def __init__(self, at, name, size, p):
        self.at, self.name, self.size, self.p = at, name, size, p

    def settled(self) -> bool:
        if self.p < SURE or self.p > 1 - SURE:
            self.p = float(round(self.p))
            return True
        return False


def _transfer(a: _Doc, b: _Doc, seed: int) -> None:
    """Move words between two fractional documents until one is integral."""
    into_a = min((1 - a.p) * a.size, b.p * b.size)
    into_b = min(a.p * a.size, (1 - b.p) * b.size)
    moved = into_a if _chance(seed, a.name, b.name) * (into_a + into_b) < into_b else -into_b
    a.p += moved / a.size
    b.p -= moved / b.size


def _settle(docs: list[_Doc], seed: int) -> None:
    """At the root: each document, largest first, against the pool of all smaller ones."""
    docs = sorted(docs, key=lambda doc: (-doc.size, repr(doc.name)))
    for i, doc in enumerate(docs):
        if doc.settled():
            continue
        pool = [x for x in docs[i + 1 :] if not x.settled()]
        mass, room = sum(x.p * x.size for x in pool), sum((1 - x.p) * x.size for x in pool)
        into = min((1 - doc.p) * doc.size, mass)
        out = min(doc.p * doc.size, room)
        if into + out > 0:
            gains = _chance(seed, doc.name, "pool") * (into + out) < out
            moved = into if gains else -out
            doc.p += moved / doc.size
            for x in pool:
                x.p -= moved * x.p / mass if gains else moved * (1 - x.p) / room
        if not doc.settled():
            doc.p = float(_chance(seed, doc.name, "last") < doc.p)


def _round(frame: pd.DataFrame, seed: int, root: bool) -> pd.DataFrame:
    """Round the rows of one block; ``extra`` stays null for the few left to the next level.

    Chances depend on a row's place, so rows come in a total order: what ties is equal.
    """
    frame = frame.sort_values(["doc_id", "size", "source", "p"], ignore_index=True)
    extra = [0] * len(frame)
    p = frame["p"].tolist()
    open_docs: dict = {}
    rows = zip(frame["doc_id"], frame["source"], frame["size"], p, strict=True)
    for at, (doc_id, source, size, chance) in enumerate(rows):
        source = None if pd.isna(source) else source
        name = (None if pd.isna(doc_id) else int(doc_id), source, at)
        doc = _Doc(at, name, int(size), chance)
        if doc.settled() or doc.size == 0:
            extra[at] = int(doc.p) if doc.size else 0
            continue
        kind = source if root else (source, doc.size.bit_length())
        if root:
            open_docs.setdefault(kind, []).append(doc)
            continue
        other = open_docs.pop(kind, None)
        if other is None:
            open_docs[kind] = doc
            continue
        _transfer(other, doc, seed)
        for x in (other, doc):
            if x.settled():
                extra[x.at] = int(x.p)
            else:
                open_docs[kind] = x
    if root:
        for docs in open_docs.values():
            _settle(docs, seed)
            for doc in docs:
                extra[doc.at] = int(doc.p)
    else:
        for doc in open_docs.values():
            extra[doc.at], p[doc.at] = None, doc.p
    frame["extra"] = pd.array(extra, dtype="Int32")
    frame["p"] = p
    return frame[["doc_id", "part", "source", "size", "p", "extra"]]


def _up(rows: DataFrame, keys: list[str], seed: int, root: bool) -> DataFrame:
    def work(frame: pd.DataFrame) -> pd.DataFrame:
        return _round(frame, seed, root)

    done, _ = store(rows.groupBy(*keys).applyInPandas(work, _ROWS), "rounded")
    return done


def round_copies(rows: DataFrame, blocks: int, seed: int = 0, fan_in: int = FAN_IN) -> DataFrame:
    """``extra`` 0 or 1 for each row of ``rows`` (doc_id, source, size, p).

    Blocks come from the hash of the id, not from how the input happens to be split, so reruns
    agree. A level of the tree joins ``fan_in`` blocks, and only the fractional rows move up.
    """
    part = F.pmod(F.xxhash64("doc_id"), F.lit(blocks))
    level = rows.select(
        "doc_id", part.alias("part"), "source", "size", "p", F.lit(None).cast("int").alias("extra")
    )
    level = _up(level, ["part"], seed, False)
    done, parts = [level.where("extra is not null")], blocks
    while True:
        parts = -(-parts // fan_in)
        left = level.where("extra is null").withColumn(
            "part", F.floor(F.col("part") / fan_in).cast("bigint")
        )
        root = parts == 1
        level = _up(left, ["source"] if root else ["source", "part"], seed, root)
        done.append(level.where("extra is not null"))
        if root:
            break
    result = done[0]
    for part_done in done[1:]:
        result = result.unionByName(part_done)
    return result.select("doc_id", "source", "size", "extra")


def mix_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple = WEIGHTS,
    budget: float = BUDGET,
    most: float = MOST,
    seed: int = 0,
) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) for every row of ``docs``.

    Size is the number of words, 0 for a null text; such documents are taken 0 times. A null
    source is a source like others, the last. Rows with equal ids are rounded each on its own.
    An empty table gives no rows; other columns are ignored.
    """
    rows, _ = store(
        docs.select(
            F.col(id_column).cast("bigint").alias("doc_id"),
            F.col(source_column).cast("string").alias("source"),
            word_count(F.col(text_column)).alias("size"),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")
    )
    count = rows.count()
    targets, _ = store(
        source_targets(sizes.select("source", "source_size"), weights, budget, most), "targets"
    )
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.select(
        F.col("source").alias("_source"), "source_size", "target",
        F.floor(share + SURE).alias("whole"),
        F.greatest(share - F.floor(share + SURE), F.lit(0.0)).alias("p"),
    )
    meet = F.col("source").eqNullSafe(F.col("_source"))
    fractions = rows.join(targets, meet).select("doc_id", "source", "size", "p")
    rounded = round_copies(fractions, buckets_for(count, ROWS_PER_BLOCK), seed)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(F.lit(0))
    return (
        rounded.join(targets, meet)
        .select("doc_id", "size", "source_size", "target", copies.cast("bigint").alias("copies"))
        .withColumn("taken", F.col("size") * F.col("copies"))
    )
