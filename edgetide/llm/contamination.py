"""Benchmark passages in training documents, found with a distributed positional inverted index.

The index holds a posting (term, text, position) for each word of the documents that occurs in the
test items, and one of the empty term where a text ends; every task writes the postings of its documents as one segment sorted by term, so nothing
is shuffled to build it and a reader skips the row groups of other terms. A window of an item is
looked up from its rarest terms: the postings of the two rarest are moved back by their place in the
window, and where both lists name the same start of the same text (one aggregation over equal keys)
the window may begin. What is left is compared word by word with the texts themselves.

For proximity the same two lists are met by stretches of a text in place of equal starts.

Texts are named by two 64-bit hashes, so that copies of a text, however many, are searched as one
wherever postings meet; different texts that agree in both would have to do so at 1 in 10^38 a pair.
Everything is a DataFrame expression.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgetide.llm.common import bind
from edgetide.storage import drop_scratch, store

# Fixed value: what a word is, after A-Z is lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# No word; where it stands in the index, a text ends.
END = ""

WINDOW = 10
NEAR = 20
LISTS = 2
TEXT = ["text0", "text1"]

# A side is broadcast only if it was counted and holds no more than this.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 48 << 20


def terms_of(text: Column) -> Column:
    """The words of a text in order, A-Z lower-cased; none for null."""
    text = F.coalesce(text, F.lit(""))
    # of text in ASCII, which lower() is faster at, it changes A-Z only
    ascii_only = F.octet_length(text) == F.char_length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))


def _key(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("text0"), F.xxhash64(F.lit("second"), text).alias("text1")]


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, text0, text1); other columns are left behind."""
    return docs.select(docs["doc_id"], docs["text"], *_key(docs["text"]))


def _if_small(stored: DataFrame, size: Column) -> DataFrame:
    """A stored table, marked for broadcast if its rows and bytes (``size`` a row) are few."""
    found = stored.agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")).first()
    few = found["rows"] <= BROADCAST_ROWS and (found["bytes"] or 0) <= BROADCAST_BYTES
    return F.broadcast(stored) if few else stored


@dataclass(frozen=True)
class PositionalIndex:
    """Postings (term, text0, text1, position) in segments sorted by term."""

    postings: DataFrame
    path: str

    def frequencies(self) -> DataFrame:
        """(term, postings) of each term."""
        counts = self.postings.groupBy("term").agg(F.count(F.lit(1)).alias("postings"))
        return counts.where(F.col("term") != END)

    def lengths(self) -> DataFrame:
        """(text*, n_words) of each text."""
        ends = self.postings.where(F.col("term") == END)
        return ends.groupBy(*TEXT).agg(F.max("position").cast("bigint").alias("n_words"))

    def release(self) -> None:
        drop_scratch(self.postings.sparkSession, self.path)


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> PositionalIndex:
    """Index every word of the whole texts, or those in a stored table ``terms`` (term, distinct)."""
    words = F.concat(terms_of(F.col("text")), F.array(F.lit(END)))
    places = _keyed(docs).select(*TEXT, F.posexplode(words).alias("position", "term"))
    if terms is not None:
        end = docs.sparkSession.range(1).select(F.lit(END).alias("term"))
        terms = terms.unionByName(end)
        places = places.join(_if_small(terms, F.octet_length("term")), "term", "left_semi")
    segments = places.select("term", *TEXT, "position").sortWithinPartitions(
        "term", "text0", "position"
    )
    return PositionalIndex(*store(segments, "postings"))


@dataclass(frozen=True)
class Windows:
    """``phrases`` (phrase_id, phrase, length), distinct, and ``owners`` (phrase_id, item_id)."""

    phrases: DataFrame
    owners: DataFrame

    def terms(self) -> DataFrame:
        return self.phrases.select(F.explode(F.split("phrase", " ")).alias("term")).distinct()


def windows_of(items: DataFrame, size: int = WINDOW) -> Windows:
    """All stretches of ``size`` successive words; a shorter item, unless it has no word, is one."""
    words = items.select(items["item_id"], terms_of(items["text"]).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (size - 1)))
    cut = (
        words.where(F.size("words") > 0)
        .select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.array_join(F.slice("words", F.col("start"), size), " ").alias("phrase"))
    )
    cut, _ = store(cut.distinct(), "windows")
    length = F.size(F.split("phrase", " ")).alias("length")
    number = F.monotonically_increasing_id().alias("phrase_id")  # fixed once it is stored
    phrases, _ = store(cut.select("phrase").distinct().select(number, "phrase", length), "phrases")
    owners, _ = store(cut.join(phrases, "phrase").select("phrase_id", "item_id"), "owners")
    return Windows(phrases, owners)


def rarest_terms(index: PositionalIndex, windows: Windows) -> DataFrame:
    """(phrase_id, length, term, offset, rank): each window's places, rarest term first.

    A window with a term that no text has cannot occur and is left out.
    """
    places = windows.phrases.select(
        "phrase_id", "length", F.posexplode(F.split("phrase", " ")).alias("offset", "term")
    )
    counted, _ = store(index.frequencies(), "frequencies")
    known = places.join(_if_small(counted, F.octet_length("term")), "term")
    of_phrase = Window.partitionBy("phrase_id")
    return (
        known.withColumn("present", F.count(F.lit(1)).over(of_phrase))
        .withColumn("rank", F.row_number().over(of_phrase.orderBy("postings", "offset")))
        .where("present = length")
        .select("phrase_id", "length", "term", "offset", "rank")
    )


def _lists(index: PositionalIndex, ranked: DataFrame) -> DataFrame:
    """The postings of the rarest terms: (phrase_id, length, rank, text*, position, offset)."""
    wanted, _ = store(ranked.where(F.col("rank") <= LISTS), "rarest")
    return index.postings.join(_if_small(wanted, F.octet_length("term") + 24), "term").drop("term")


def phrase_starts(index: PositionalIndex, ranked: DataFrame) -> DataFrame:
    """(text*, start, length), distinct: where the offset-adjusted lists of a window intersect."""
    moved = _lists(index, ranked).withColumn("start", F.col("position") - F.col("offset"))
    bit = F.expr("shiftleft(1, rank - 1)")
    all_bits = F.expr(f"shiftleft(1, least({LISTS}, length)) - 1")
    met = (
        moved.where("start >= 0")
        .groupBy("phrase_id", "length", *TEXT, "start")
        .agg(F.bit_or(bit).alias("bits"))
        .where(F.col("bits") == all_bits)
    )
    return met.select(*TEXT, "start", "length").distinct()


def near_places(index: PositionalIndex, ranked: DataFrame, within: int) -> DataFrame:
    """(text*, phrase_id, position): the rarest term's places with the second rarest near them.

    A place keeps those whose own stretch of ``within`` words, or a neighbouring one, holds a posting
    of the second rarest term; a window of one word needs none.
    """
    lists = _lists(index, ranked.where("rank = 1 OR (rank <= 2 AND length > 1)"))
    stretch = F.floor(F.col("position") / within).cast("int")
    meet = ["phrase_id", *TEXT, "stretch"]
    first = lists.where("rank = 1").select("phrase_id", *TEXT, "position", "length").distinct()
    second = lists.where("rank = 2").select("phrase_id", *TEXT, stretch.alias("stretch"))
    around = F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("stretch")
    near = first.where("length > 1").select("phrase_id", *TEXT, "position", around)
    met = near.join(second.distinct(), meet, "left_semi")
    alone = first.where("length = 1")
    columns = ["phrase_id", *TEXT, "position"]
    return met.select(*columns).unionByName(alone.select(*columns)).distinct()


def _with_texts(docs: DataFrame, spots: DataFrame) -> DataFrame:
    """``spots`` (text*, spots) with the words of the texts, each text once whatever its copies."""
    keyed = _keyed(docs)
    spots, _ = store(spots, "spots")
    small = _if_small(spots, F.size("spots") * 24 + 40)
    chosen = (
        keyed.select("doc_id", *TEXT)
        .join(small.select(*TEXT), TEXT, "left_semi")
        .groupBy(*TEXT)
        .agg(F.min("doc_id").alias("_chosen"))
        .join(spots, TEXT)
    )
    chosen, _ = store(chosen, "chosen")
    chosen = _if_small(chosen, F.size("spots") * 24 + 40)
    one = keyed.join(chosen, TEXT).where(F.col("doc_id").eqNullSafe(F.col("_chosen")))
    return one.select(*TEXT, "spots", terms_of(F.col("text")).alias("words"))


def phrase_matches(docs: DataFrame, index: PositionalIndex, windows: Windows) -> DataFrame:
    """(text*, phrase_id, start, length): every occurrence of a window in a text, exactly."""
    starts = phrase_starts(index, rarest_terms(index, windows))
    spots = starts.groupBy(*TEXT).agg(F.collect_list(F.struct("start", "length")).alias("spots"))

    def phrase(words: Column, spot: Column) -> Column:
        return F.array_join(F.slice(words, spot["start"] + 1, spot["length"]), " ")

    texts = _with_texts(docs, spots)
    read = F.transform(
        "spots",
        lambda spot: F.struct(
            spot["start"].alias("start"), phrase(F.col("words"), spot).alias("phrase")
        ),
    )
    phrases = _if_small(windows.phrases, F.octet_length("phrase") + 12)
    return (
        texts.select(*TEXT, F.inline(read))
        .join(phrases, "phrase")
        .select(*TEXT, "phrase_id", "start", "length")
        .distinct()
    )


def near_matches(
    docs: DataFrame, index: PositionalIndex, windows: Windows, within: int = NEAR
) -> DataFrame:
    """(text*, phrase_id): windows all of whose words occur in ``within`` successive words of a text.

    The order of the words does not matter, nor how often a word occurs.
    """
    if within < 1:
        raise ValueError("within must be at least 1")
    places = near_places(index, rarest_terms(index, windows), within)
    spots = places.groupBy(*TEXT).agg(
        F.collect_list(F.struct("phrase_id", "position")).alias("spots")
    )

    def around(spot: Column) -> Column:
        start = F.greatest(F.lit(1), spot["position"] - (within - 2))
        return F.slice("words", start, spot["position"] + within - start + 1)

    texts = _with_texts(docs, spots)
    read = F.transform(
        "spots",
        lambda spot: F.struct(spot["phrase_id"].alias("phrase_id"), around(spot).alias("near")),
    )
    phrases = _if_small(windows.phrases, F.octet_length("phrase") + 12)

    def covered(near: Column, phrase: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(near) - (within - 1)))

        def holds(start: Column) -> Column:
            return F.size(F.array_except(phrase, F.slice(near, start, within))) == 0

        # the whole neighbourhood first: most lack a word of the window
        whole = F.size(F.array_except(phrase, near)) == 0
        return whole & F.exists(starts, holds)

    found = texts.select(*TEXT, F.inline(read)).join(phrases, "phrase_id")
    held = bind(F.split("phrase", " "), lambda phrase: covered(F.col("near"), phrase))
    return found.where(held).select(*TEXT, "phrase_id").distinct()


def _covered_words(matches: DataFrame) -> DataFrame:
    """(text*, n_hit): words inside one match or more; a match counts what no earlier one reaches."""
    spans = matches.select(*TEXT, "start", (F.col("start") + F.col("length")).alias("end"))
    before = (
        Window.partitionBy(*TEXT)
        .orderBy("start", "end")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    spans = spans.distinct().select(*TEXT, "start", "end", reached.alias("reached"))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reached"))
    return spans.groupBy(*TEXT).agg(F.sum(new).cast("bigint").alias("n_hit"))


def _items_in(matches: DataFrame, windows: Windows) -> DataFrame:
    """(text*, items): ids of the items a text has windows of, sorted as strings."""
    owners = _if_small(windows.owners, F.lit(16))
    pairs = matches.select(*TEXT, "phrase_id").distinct().join(owners, "phrase_id")
    ids = pairs.select(*TEXT, F.col("item_id").cast("string").alias("item")).distinct()
    return ids.groupBy(*TEXT).agg(F.sort_array(F.collect_list("item")).alias("items"))


def find_contamination(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, within: int | None = NEAR
) -> DataFrame:
    """What each document (doc_id, text) shares with the items (item_id, text).

    (doc_id, n_words, n_hit, items, contaminated, n_near): ``n_hit`` words lie inside an occurrence of
    a window of ``size`` successive item words; ``items`` are the ids, sorted as strings, of the items
    with such a window; ``n_near`` items have a window whose words all occur in ``within`` successive
    words, in any order (null for ``within`` None).

    One row for each row of ``docs``, so repeated rows and ids give repeated results. A null or empty
    text has no words and shares nothing; neither does such an item. An item without id marks words
    but is not listed; repeated items count once for each id. Very long texts are read whole. Other
    columns of either table are ignored. Without documents there are no rows, without items nothing
    is shared.
    """
    windows = windows_of(items, size)
    terms, _ = store(windows.terms(), "terms")
    index = build_index(docs, terms)
    matches, _ = store(phrase_matches(docs, index, windows), "matches")
    shared = _covered_words(matches).join(_items_in(matches, windows), TEXT, "left")
    near = F.lit(None).cast("bigint")
    if within is not None:
        owners = _if_small(windows.owners, F.lit(16))
        places = near_matches(docs, index, windows, within).join(owners, "phrase_id")
        counts = places.groupBy(*TEXT).agg(F.count_distinct("item_id").alias("n_near"))
        shared, near = shared.join(counts, TEXT, "full"), F.coalesce("n_near", F.lit(0))
    known, _ = store(index.lengths().join(shared, TEXT, "left"), "shared")
    index.release()
    none = F.array().cast("array<string>")
    return (
        _keyed(docs)
        .select("doc_id", *TEXT)
        .join(known, TEXT)
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
            near.alias("n_near"),
        )
    )
