"""Near-duplicates by bottom-k sketches.

One hash function maps a document's shingles to numbers; the ``KEPT`` smallest are its sketch.
Documents with the same set form a class, and classes are compared. Inverted lists hold a class
under the rarest of its retained values only: two linked classes share so many that one of those
must be in common, and values that many unrelated documents have are never reached. In each list
every class is paired with the most central one; where that leaves a list in several components,
the classes outside the largest are paired with one class of it, then with all others, so no link
that matters is missed. Pairs are filtered by the estimate from the union's sketch and confirmed on
the full sets. Where a class has to be held against all others, longer sketches are drawn: of sets
that fit into them whole the overlap is known and not estimated, so a large group whose members are
less alike than asked for lets hardly a pair through.
"""

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgetide.llm.brown import tokens
from edgetide.llm.common import bind, small_batches
from edgetide.llm.components import components
from edgetide.storage import drop_scratch, store

KEPT = 64
WIDE = 256
WORDS = 3
PERCENT = 85
SIGMAS = 5.0
ROWS = 256
REMEMBERED = 200_000

_SKETCHES = "doc_id bigint, text_hash long, n long, class binary, sketch array<bigint>"
_SKETCHES_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()),
        ("class", pa.binary()), ("sketch", pa.list_(pa.int64())),
    ]
)


class Shingles:
    """Text -> sorted, distinct 64-bit hashes of its shingles; hashes of words seen lately stay."""

    def __init__(self, words: int):
        self._words = words
        self._known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = tokens(text)
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self._words, len(words))
        if not size:
            return hashes
        count = len(words) - size + 1
        found = np.full(count, size, np.uint64)
        for at in range(size):
            found = (found ^ hashes[at : at + count]) * np.uint64(0x9E3779B97F4A7C15)
            found ^= found >> np.uint64(32)
            found *= np.uint64(0xD6E8FEB86659FD93)
            found ^= found >> np.uint64(29)
        return np.unique(found)


def _sketch(
    batches: Iterator[pa.RecordBatch], words: int, kept: int
) -> Iterator[pa.RecordBatch]:
    shingles = Shingles(words)
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            rows = batch.slice(start, ROWS)
            sizes, classes, sketches = [], [], []
            for text in rows.column("text").to_pylist():
                found = shingles(text)
                sizes.append(len(found))
                classes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                # halved, so that the order of numbers is that of signed integers
                sketches.append((found[:kept] >> np.uint64(1)).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                schema=_SKETCHES_ARROW,
            )


def _confirm(
    batches: Iterator[pa.RecordBatch], words: int, percent: int
) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar enough; rows with the same ``b`` come one after another."""
    shingles = Shingles(words)
    last, other = None, None
    for batch in batches:
        linked = ([], [])
        for start in range(0, batch.num_rows, ROWS):
            rows = batch.slice(start, ROWS).to_pydict()
            for a, b, text_a, text_b in zip(
                rows["a"], rows["b"], rows["text_a"], rows["text_b"], strict=True
            ):
                if b != last:
                    last, other = b, shingles(text_b)
                own = shingles(text_a)
                common = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * common >= percent * (len(own) + len(other) - common):
                    linked[0].append(a)
                    linked[1].append(b)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in linked], names=["a", "b"])


def _wide(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(id, wide) of rows (id, text): the upper halves of the ``WIDE`` smallest values, in order."""
    shingles = Shingles(words)
    for batch in batches:
        found = [
            (shingles(text)[:WIDE] >> np.uint64(32)).astype(np.int64) - 2**31
            for text in batch.column(1).to_pylist()
        ]
        sets = pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), sets], names=["id", "wide"])


class Search:
    """One search; the thresholds follow from the similarity and the sketch size."""

    def __init__(self, docs: DataFrame, words: int, percent: int, kept: int):
        self.words, self.percent, self.kept = words, percent, kept
        self.share = self._share(kept)
        self.docs = docs.withColumn("text_hash", F.xxhash64("text"))
        work = partial(_sketch, words=words, kept=kept)
        every, path = store(self.docs.mapInArrow(work, _SKETCHES), "sketches")
        self.rows, _ = store(every.select("doc_id", "n", "class"), "rows")
        one = F.first(F.struct("doc_id", "text_hash", "n", "sketch")).alias("one")
        classes = every.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("label"), one)
        self.classes, _ = store(
            classes.select(F.monotonically_increasing_id().alias("id"), "class", "label", "one.*"),
            "classes",
        )
        drop_scratch(docs.sparkSession, path)

    def lists(self) -> DataFrame:
        """(value, id, n, owners, central): inverted lists of each class's rarest shared values.

        Of s retained values a linked partner shares at least ``share`` * s, so it has one of the
        s - share * s + 1 rarest. Values of a single class come first among those and need no list.
        """
        values = self.classes.select("id", F.explode("sketch").alias("value"))
        shared = values.groupBy("value").agg(F.count(F.lit(1)).alias("owners")).where("owners > 1")
        entry = F.struct("owners", "value")
        of_class = (
            values.join(shared, "value")
            .groupBy("id")
            .agg(F.sort_array(F.collect_list(entry)).alias("shared"), F.sum("owners").alias("central"))
        )
        sizes = self.classes.select("id", "n", F.size("sketch").alias("kept"))
        prefix = F.col("kept") - F.floor(F.col("kept") * self.share) + 1
        room = F.greatest(prefix - (F.col("kept") - F.size("shared")), F.lit(0)).cast("int")
        rows = (
            of_class.join(sizes, "id")
            .select("id", "n", "central", F.inline(F.slice("shared", F.lit(1), room)))
            .select("value", "id", "n", "owners", "central")
        )
        return store(rows, "lists")[0]

    def _texts(self, lists: DataFrame) -> DataFrame:
        """One text for each class in a list; ids may repeat, and so may whole rows."""
        ids = lists.select("id").distinct()
        wanted = ids.join(self.classes.select("id", "doc_id", "text_hash"), "id").toDF(
            "id", "_id", "_hash"
        )
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        found = self.docs.join(wanted, same).select("id", "text").dropDuplicates(["id"])
        return store(found, "texts")[0]

    def _near_size(self, a: Column, b: Column) -> Column:
        return (a * 100 >= b * self.percent) & (b * 100 >= a * self.percent)

    def _share(self, kept: int) -> float:
        """What the sketches of a linked pair share at least, but for chances beyond SIGMAS."""
        similarity = self.percent / 100
        return max(0.05, similarity - SIGMAS * math.sqrt(similarity * (1 - similarity) / kept))

    def _likely(self, a: Column, b: Column, kept: int | None = None) -> Column:
        """The estimate of two sketches: which of the union's smallest values both have."""
        kept = kept or self.kept
        union = F.slice(F.sort_array(F.array_union(a, b)), 1, kept)
        return bind(
            union,
            lambda union: F.size(F.array_intersect(F.array_intersect(a, b), union))
            >= F.floor(F.size(union) * self._share(kept)),
        )

    def _alike(self, n_a: Column, n_b: Column, a: Column, b: Column) -> Column:
        """The same for long sketches; of sets that they hold whole, the overlap itself.

        Values of 32 bits may agree by chance: within a set two may count as one, so the overlap may
        fall short by as many, for which two are allowed.
        """
        common = F.size(F.array_intersect(a, b)) + 2
        whole = common * (100 + self.percent) >= self.percent * (n_a + n_b)
        return F.when((n_a <= WIDE) & (n_b <= WIDE), whole).otherwise(self._likely(a, b, WIDE))

    def _confirmed(self, likely: DataFrame, texts: DataFrame) -> DataFrame:
        """The linked ones among ``likely`` pairs (a, b), by their full sets."""
        work = partial(_confirm, words=self.words, percent=self.percent)
        linked = (
            likely.join(texts.toDF("a", "text_a"), "a")
            .join(texts.toDF("b", "text_b"), "b")
            .select("a", "b", "text_a", "text_b")
            .mapInArrow(work, "a bigint, b bigint")
        )
        return store(linked, "links")[0]

    def _star_pairs(self, lists: DataFrame, centre: Column) -> DataFrame:
        """Each class of ``lists`` outside its list's centre with that centre, (id, n) of ``centre``."""
        centres = lists.groupBy("value").agg(F.max(centre).alias("centre"))
        pairs = (
            lists.join(centres, "value")
            .where(F.col("id") != F.col("centre.id"))
            .where(self._near_size(F.col("n"), F.col("centre.n")))
        )
        if "root" in lists.columns:
            pairs = pairs.where(F.col("root") != F.col("main"))
        pairs = pairs.select(F.col("id").alias("a"), F.col("centre.id").alias("b")).distinct()
        sketch = self.classes.select("id", "sketch")
        return (
            pairs.join(sketch.toDF("a", "sketch_a"), "a")
            .join(sketch.toDF("b", "sketch_b"), "b")
            .where(self._likely(F.col("sketch_a"), F.col("sketch_b")))
            .select("a", "b")
        )

    def _unresolved(self, lists: DataFrame, roots: DataFrame) -> DataFrame:
        """Lists of several components, with each class's ``root`` and the largest one, ``main``."""
        rows = lists.drop("root", "main").join(roots.toDF("id", "root"), "id", "left")
        rows = rows.withColumn("root", F.coalesce("root", "id"))
        parts = rows.groupBy("value", "root").agg(F.count(F.lit(1)).alias("size"))
        main = parts.groupBy("value").agg(
            F.count(F.lit(1)).alias("parts"), F.max(F.struct("size", "root")).alias("largest")
        )
        main = main.where("parts > 1").select("value", F.col("largest.root").alias("main"))
        return store(rows.join(main, "value"), "lists")[0]

    def _cross_pairs(self, lists: DataFrame, texts: DataFrame) -> DataFrame:
        """In each list, the classes outside the main component with all of other components.

        A pair is looked at in the list of its rarest common value only, and the join lets none
        through that its long sketches speak against.
        """
        entry = F.sort_array(F.collect_list(F.struct("owners", "value")))
        first = lists.groupBy("id").agg(entry.alias("entries"))
        work = partial(_wide, words=self.words)
        wide, _ = store(
            texts.join(first.select("id"), "id").mapInArrow(work, "id bigint, wide array<int>"),
            "wide",
        )
        of_class = first.select("id", F.col("entries.value").alias("first")).join(wide, "id")
        full = lists.select("value", "id", "n", "root", "main").join(of_class, "id")

        def side(table: DataFrame, mark: str) -> DataFrame:
            return table.select(
                "value", "main", *(F.col(x).alias(x + mark) for x in ("id", "n", "root", "first", "wide"))
            )

        a = side(full.where("root != main"), "_a")
        b = side(full, "_b").drop("main")
        common = F.array_intersect("first_a", "first_b")
        meet = (
            (a["value"] == b["value"])
            & (F.col("root_a") != F.col("root_b"))
            & ((F.col("root_b") == F.col("main")) | (F.col("id_a") < F.col("id_b")))
            & self._near_size(F.col("n_a"), F.col("n_b"))
            & (F.get(common, F.lit(0)) == a["value"])
            & self._alike(F.col("n_a"), F.col("n_b"), F.col("wide_a"), F.col("wide_b"))
        )
        return a.join(b, meet).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))

    def components(self) -> DataFrame:
        """(id, root) of the classes with links."""
        lists = self.lists()
        texts = self._texts(lists)
        roots = None
        of_main = F.when(F.col("root") == F.col("main"), F.xxhash64("id", "value"))
        steps = (
            # the most central class of each list with all others of it
            lambda: self._star_pairs(lists, F.struct("central", "id", "n")),
            # one of the main component, another for each list, with the classes outside it
            lambda: self._star_pairs(lists, F.struct(of_main.alias("chance"), "id", "n")),
            lambda: self._cross_pairs(lists, texts),
        )
        for number, step in enumerate(steps, start=1):
            links = self._confirmed(step(), texts)
            if roots is not None:  # what is known already, in as few edges as there are nodes
                links = links.unionByName(roots.toDF("a", "b"))
            roots = store(components(links), "roots")[0].toDF("id", "root")
            if number < len(steps):
                lists = self._unresolved(lists, roots)
                if lists.isEmpty():
                    break
        return roots

    def result(self) -> DataFrame:
        found = self.classes.select("id", "class", "label").join(self.components(), "id", "left")
        found = found.withColumn("root", F.coalesce("root", "id"))
        least = found.groupBy("root").agg(F.min("label").alias("component_id"))
        of_class = found.join(least, "root").select("class", "component_id")
        # a document without shingles is alone
        component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        return self.rows.join(of_class, "class", "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
        )


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    kept: int = KEPT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each document.

    Documents are linked if 100 * common shingles >= ``percent`` * all shingles of both;
    ``component_id`` is the smallest id reachable by links. A text with fewer words than a shingle
    is one shingle; a null text or one without words has none, is linked with nothing and kept.
    Rows that share an id stay or go together. An empty table gives no rows; other columns are
    ignored.
    """
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    with small_batches(docs.sparkSession):  # what is left to run afterwards needs no Python
        return Search(rows, words, percent, kept).result()
