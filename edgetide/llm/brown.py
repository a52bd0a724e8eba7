"""Scoring by a Brown class model: P(word | before) = P(class | class before) * P(word | class).

Exchange clustering gives every word a class, in two steps. The units of the first are the ``UNITS``
most frequent words, and, for all the others, the ends of words in ``ENDINGS`` groups; the end of a
text has a class of its own. The counts of neighbouring units are summed by Spark and kept in two
copies, by unit and by follower; in each round every unit's neighbours are counted by class, and
half of the units move to the class that raises the likelihood most. In the second step every other
word seen ``SEEN`` times or more is a unit: a table holds its neighbours by class, and tasks move it
from the class of its ending to the best one against the counts between classes. So the clustered
words follow the vocabulary.

Counts of words are exact and cover all training texts. The ``DICTIONARY`` most frequent words
travel to the tasks with their classes; those of all others stay in a table that is joined by word.
Texts are stored as places in the dictionary, so words are looked up once.
"""

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgetide.llm.common import id_fold
from edgetide.operators.skew import ROWS_PER_SLICE, hot_keys, join_unique
from edgetide.storage import store

FOLDS, HELD_OUT = 7, 2
UNITS = 4096
ENDINGS = 512
SEEN = 3
CLASSES = 64
ROUNDS = 6
DICTIONARY = 200_000
LONGEST = 64
ROWS = 256
FLUSH_WORDS = 250_000
FLUSH_TOKENS = 2_000_000

END = ""  # the token that ends a text; no word is empty

_COUNTS = "word string, n long"
_PAIRS = "unit int, next int, n long"
_ENCODED = "row long, doc_id bigint, held_out boolean, places binary, rare array<string>"
_NEIGHBOURS = "name long, place int, at int, n int"
_RARE = "row long, held_out boolean, at long, word string, ending int, before int, after int"
_LOCAL = (
    "row long, doc_id bigint, held_out boolean, n_tokens long, known long, base double, "
    "score double"
)


def tokens(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case; bytes split at the six blanks and nothing else."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            for text in batch.column("text").slice(start, ROWS).to_pylist():
                yield tokens(text)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    ends = 0
    for words in _texts(batches):
        counts.update(words)
        ends += 1
        if len(counts) >= FLUSH_WORDS:
            yield flush()
            counts.clear()
    if ends:
        counts[END.encode()] += ends
    yield flush()


class _Index(dict):
    """word -> its place in the dictionary, or behind it the group of its ending."""

    def __init__(self, words: list[bytes], endings: int):
        super().__init__(zip(words, range(len(words)), strict=True))
        self._size, self._endings = len(words), endings

    def ending(self, word: bytes) -> int:
        return zlib.crc32(word[-3:]) % self._endings

    def __missing__(self, word: bytes) -> int:
        return self._size + self.ending(word)


@dataclass
class Lexicon:
    """The frequent words with their counts, most frequent first, and each place's unit.

    Places go on behind the words with the groups of endings and the end of a text. ``lowest`` is
    the step of counts (see ``_step``) from which words are in; None where none is.
    """

    words: list[bytes]
    counts: np.ndarray
    units: int
    endings: int
    lowest: int | None = None

    def index(self) -> _Index:
        return _Index(self.words, self.endings)

    @property
    def size(self) -> int:
        return len(self.words)

    @property
    def end_place(self) -> int:
        return self.size + self.endings

    @property
    def end_unit(self) -> int:
        return self.units + self.endings

    def unit_of(self) -> np.ndarray:
        """The unit of each place."""
        index = self.index()
        beyond = [self.units + index.ending(word) for word in self.words[self.units :]]
        groups = range(self.units, self.end_unit + 1)
        return np.array([*range(min(self.units, self.size)), *beyond, *groups], np.int64)

    def holds(self, word: Column, n: Column) -> Column:
        """Whether a word with this count is in the dictionary."""
        if self.lowest is None:
            return F.lit(False)
        return (F.octet_length(word) <= LONGEST) & (_step(n) >= self.lowest) & (word != END)


def _name(word: Column) -> Column:
    """A negative hash of a word, so that it is no place; two words of one name move together."""
    return F.xxhash64(word).bitwiseOR(F.lit(-(1 << 63)))


def _step(n: Column) -> Column:
    """Quarters of a power of two: a few hundred steps whatever the counts."""
    return F.floor(F.log2(n) * 4).cast("int")


_made: list = [None, None]


def _index_of(lexicon_of) -> _Index:
    """The index of the broadcast lexicon, made once in a worker process."""
    lexicon = lexicon_of.value
    if _made[0] is not lexicon:
        _made[:] = [lexicon, lexicon.index()]
    return _made[1]


def _encode(batches: Iterator[pa.RecordBatch], lexicon_of) -> Iterator[pa.RecordBatch]:
    """Texts as places, each with the end behind it, and their words beyond the dictionary."""
    index, lexicon = _index_of(lexicon_of), lexicon_of.value
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 33
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            rows = batch.slice(start, ROWS)
            places, rare = [], []
            for text in rows.column("text").to_pylist():
                words = tokens(text)
                at = np.fromiter(map(index.__getitem__, words), np.int32, len(words))
                beyond = np.flatnonzero(at >= lexicon.size).tolist()
                rare.append([words[i].decode("utf-8", "surrogatepass") for i in beyond])
                places.append(np.append(at, lexicon.end_place).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(number, number + rows.num_rows)),
                    rows.column("doc_id"),
                    rows.column("held_out"),
                    pa.array(places, pa.binary()),
                    pa.array(rare, pa.list_(pa.string())),
                ],
                names=["row", "doc_id", "held_out", "places", "rare"],
            )
            number += rows.num_rows


def _places(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(all places of a batch's texts, where each text starts among them)."""
    texts = batch.column("places").to_pylist()
    lengths = np.array([len(text) // 4 for text in texts], np.int64)
    flat = np.frombuffer(b"".join(texts), "<i4").astype(np.int64)
    return flat, np.cumsum(lengths) - lengths


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``ROWS`` rows, so that what numpy holds for one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _before(flat: np.ndarray, end: int) -> np.ndarray:
    """What stands before each place: every text starts behind an end, its own or the last one's."""
    return np.concatenate(([end], flat[:-1]))


def _count_pairs(
    batches: Iterator[pa.RecordBatch], unit_of_place, width: int
) -> Iterator[pa.RecordBatch]:
    """Neighbouring units; a text starts behind an end and stops before one."""
    unit_of = unit_of_place.value
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        codes, n = np.unique(np.concatenate(held), return_counts=True)
        arrays = [(codes // width).astype(np.int32), (codes % width).astype(np.int32), n]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in arrays], names=["unit", "next", "n"]
        )

    for batch in _slices(batches):
        units = unit_of[_places(batch)[0]]
        held.append(_before(units, width - 1) * width + units)
        size += len(units)
        if size >= FLUSH_TOKENS:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _by_class(
    batches: Iterator[pa.RecordBatch], key: str, other: str, classes: np.ndarray, width: int
) -> Iterator[pa.RecordBatch]:
    """For each unit of these rows, the counts of its neighbours' classes."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        units, others, n = (batch.column(x).to_numpy() for x in (key, other, "n"))
        names, at = np.unique(units, return_inverse=True)
        sums = np.bincount(at * width + classes[others], n, len(names) * width)
        for name, own in zip(names.tolist(), sums.reshape(-1, width), strict=True):
            found[name] = found[name] + own if name in found else own
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(found), pa.int32()),
            pa.array([x.astype("<f8").tobytes() for x in found.values()], pa.binary()),
        ],
        names=["unit", "counts"],
    )


def _collect(table: DataFrame, key: str, other: str, classes: np.ndarray, width: int) -> np.ndarray:
    """The counts of all units, (units) x (classes); no larger than that on the driver."""
    work = partial(_by_class, key=key, other=other, classes=classes, width=width)
    found = np.zeros((len(classes), width))
    rows = table.mapInArrow(work, "unit int, counts binary").toArrow()
    for unit, counts in zip(*(rows.column(x).to_pylist() for x in ("unit", "counts")), strict=True):
        found[unit] += np.frombuffer(counts, "<f8")
    return found


def _xlogx(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0)
    return x * np.log(np.where(x > 0, x, 1))


def _best(between: np.ndarray, f: np.ndarray, p: np.ndarray, count: int) -> int:
    """The class with the largest gain for a unit that ``between`` leaves out.

    ``f`` and ``p`` count the classes behind and before the unit.
    """
    rows, columns = between[:count], between[:, :count].T
    gain = (_xlogx(rows + f) - _xlogx(rows)).sum(1)
    gain += (_xlogx(columns + p) - _xlogx(columns)).sum(1)
    totals, into = between.sum(1)[:count], between.sum(0)[:count]
    gain -= _xlogx(totals + f.sum()) - _xlogx(totals)
    gain -= _xlogx(into + p.sum()) - _xlogx(into)
    return int(np.argmax(gain))


def exchange(
    classes: np.ndarray, after: np.ndarray, before: np.ndarray, movable: np.ndarray, count: int
) -> np.ndarray:
    """Move each movable unit to the class with the largest gain, one after the other.

    ``after`` and ``before`` are the units' neighbours by class. They stay as they are during the
    call, the counts between classes follow every move.
    """
    width = after.shape[1]
    classes = classes.copy()
    between = np.zeros((width, width))
    np.add.at(between, classes, after)
    for unit in movable:
        f, p, old = after[unit], before[unit], classes[unit]
        if not f.any():
            continue
        between[old] -= f
        between[:, old] -= p
        new = _best(between, f, p, count)
        classes[unit] = new
        between[new] += f
        between[:, new] += p
    return classes


def cluster(
    pairs: DataFrame, units: int, count: int = CLASSES, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """(class of each unit, counts between classes) from (unit, next, n); the last unit is the end."""
    end = units - 1
    classes = np.arange(units) % count
    classes[end] = count
    by_unit, _ = store(pairs.repartition("unit"), "pairs")
    by_next, _ = store(by_unit.repartition("next"), "pairs")
    for done in range(rounds):
        after = _collect(by_unit, "unit", "next", classes, count + 1)
        before = _collect(by_next, "next", "unit", classes, count + 1)
        weight = after.sum(1)
        order = np.argsort(-weight, kind="stable")
        movable = [u for u in order.tolist() if u != end and (u + done) % 2 == 0]
        classes = exchange(classes, after, before, movable, count)
    after = _collect(by_unit, "unit", "next", classes, count + 1)
    between = np.zeros((count + 1, count + 1))
    np.add.at(between, classes, after)
    return classes, between


def _count_neighbours(
    batches: Iterator[pa.RecordBatch], lexicon_of, classes_of, width: int
) -> Iterator[pa.RecordBatch]:
    """The words beyond the first step's units: classes behind them, then, from ``width``, before.

    A word of the dictionary goes by its place, with name 0; any other by its hash and the place of
    its ending.
    """
    lexicon, classes = lexicon_of.value, classes_of.value
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        names, places, after, before = (np.concatenate(x) for x in zip(*held, strict=True))
        known, of = np.unique(np.where(names == 0, places, names), return_inverse=True)
        one = np.zeros(len(known), np.int64)
        one[of] = np.arange(len(of))
        codes = np.concatenate([of * (2 * width) + after, of * (2 * width) + width + before])
        codes, n = np.unique(codes, return_counts=True)
        word, at = one[codes // (2 * width)], codes % (2 * width)
        return pa.RecordBatch.from_arrays(
            [pa.array(names[word]), pa.array(places[word].astype(np.int32)),
             pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))],
            names=["name", "place", "at", "n"],
        )

    for batch in _slices(batches):
        flat, _ = _places(batch)
        own = classes[flat]
        before, after = _before(own, width - 1), np.append(own[1:], width - 1)
        names = np.zeros(len(flat), np.int64)
        beyond = (flat >= lexicon.size) & (flat < lexicon.end_place)
        names[beyond] = batch.column("rare").flatten().to_numpy()
        chosen = (flat >= min(lexicon.units, lexicon.size)) & (flat < lexicon.end_place)
        held.append(tuple(x[chosen] for x in (names, flat, after, before)))
        size += 2 * len(held[-1][0])
        if size >= FLUSH_TOKENS:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _best_of_words(
    between: np.ndarray, old: np.ndarray, of: np.ndarray, at: np.ndarray, times: np.ndarray
) -> np.ndarray:
    """The class with the largest gain for each word, as by ``_best`` with the word left out.

    An entry says that word ``of`` has ``times`` neighbours ``at`` a class, behind it or, from
    ``width``, before it; entries are in the order of words, one at least for each. A class it never
    meets adds nothing to a sum, so only entries are computed.
    """
    width = len(between)
    count = width - 1
    words = np.arange(len(old))
    counts = np.zeros((len(old), 2 * width))
    counts[of, at] = times
    f, p = counts[:, :width], counts[:, width:]
    met = np.concatenate([between[:count].T, between[:, :count]])  # at, class
    own, entries = old[of], np.arange(len(of))
    x, stays = met[at], _xlogx(met)[at]
    x[entries, own] -= times
    behind, ahead = np.flatnonzero(at == own), np.flatnonzero(at == own + width)
    x[behind] -= p[of[behind], :count]
    x[ahead] -= f[of[ahead], :count]
    stays[entries, own] = _xlogx(x[entries, own])
    for rows in (behind, ahead):
        stays[rows] = _xlogx(x[rows])
    x += times[:, None]
    gain = np.add.reduceat(_xlogx(x) - stays, np.searchsorted(of, words))
    totals, into = between.sum(1)[:count] - p[:, :count], between.sum(0)[:count] - f[:, :count]
    totals[words, old] -= f.sum(1)
    into[words, old] -= p.sum(1)
    gain -= _xlogx(totals + f.sum(1)[:, None]) - _xlogx(totals)
    gain -= _xlogx(into + p.sum(1)[:, None]) - _xlogx(into)
    return np.argmax(gain, 1)


def _move(
    batches: Iterator[pa.RecordBatch], classes_of, between: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """(name, place, class) from (name, place, at, times): the best class of each word."""
    classes = classes_of.value
    for batch in _slices(batches):
        ats = batch.column("at")
        at, times = ats.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
        lengths = ats.value_lengths().to_numpy()
        of = np.repeat(np.arange(len(lengths)), lengths)
        old = classes[batch.column("place").to_numpy()]
        found = _best_of_words(between, old, of, at.astype(np.int64), times.astype(float))
        yield pa.RecordBatch.from_arrays(
            [batch.column("name"), batch.column("place"), pa.array(found.astype(np.int32))],
            names=["name", "place", "class"],
        )


def move_words(
    training: DataFrame, lexicon_of, classes_of, between: np.ndarray, count: int, seen: int
) -> DataFrame:
    """(name, place, class) of every word beyond the first step's units seen ``seen`` times or more.

    Rows are dealt out once, by word. No word beyond the units holds more than a small share of
    them, since the units are the most frequent, and tasks count before.
    """
    width = count + 1
    counting = partial(
        _count_neighbours, lexicon_of=lexicon_of, classes_of=classes_of, width=width
    )
    moving = partial(_move, classes_of=classes_of, between=between)
    return (
        training.select("places", F.transform("rare", _name).alias("rare"))
        .mapInArrow(counting, _NEIGHBOURS)
        .repartition("name", "place")
        .groupBy("name", "place", "at")
        .agg(F.sum("n").alias("n"))
        .groupBy("name", "place")
        .agg(
            F.collect_list("at").alias("at"),  # at most two for each class
            F.collect_list("n").alias("times"),
            F.sum(F.when(F.col("at") < width, F.col("n"))).alias("n"),
        )
        .where(F.col("n") >= seen)
        .select("name", "place", "at", "times")
        .mapInArrow(moving, "name long, place int, class int")
    )


def _rare_tokens(
    batches: Iterator[pa.RecordBatch], lexicon_of, classes_of, width: int
) -> Iterator[pa.RecordBatch]:
    """The words beyond the dictionary with their neighbours' classes; -1 for one that is beyond too."""
    lexicon, classes = lexicon_of.value, classes_of.value
    for batch in _slices(batches):
        flat, starts = _places(batch)
        own = classes[flat]
        rare = (flat >= lexicon.size) & (flat < lexicon.end_place)
        known = np.where(rare, -1, own)
        before, after = _before(known, width - 1), np.append(known[1:], width - 1)
        at = np.flatnonzero(rare)
        of = np.searchsorted(starts, at, "right") - 1
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row").take(pa.array(of)),
                batch.column("held_out").take(pa.array(of)),
                pa.array(at - starts[of]),
                batch.column("rare").flatten(),
                *(pa.array(x[at].astype(np.int32)) for x in (own, before, after)),
            ],
            names=["row", "held_out", "at", "word", "ending", "before", "after"],
        )


def _count_steps(
    batches: Iterator[pa.RecordBatch], lexicon_of, classes_of, width: int
) -> Iterator[pa.RecordBatch]:
    """Class after class where both words are in the dictionary."""
    lexicon, classes = lexicon_of.value, classes_of.value
    total = np.zeros(width * width, np.int64)
    for batch in _slices(batches):
        flat, _ = _places(batch)
        rare = (flat >= lexicon.size) & (flat < lexicon.end_place)
        own = np.where(rare, -1, classes[flat])
        before = _before(own, width - 1)
        both = (own >= 0) & (before >= 0)
        total += np.bincount(before[both] * width + own[both], minlength=width * width)
    codes = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array((codes // width).astype(np.int32)), pa.array((codes % width).astype(np.int32)),
         pa.array(total[codes])],
        names=["before", "class", "n"],
    )


@dataclass
class ClassModel:
    """Logarithms to base 10; ``step`` is class after class, ``share`` what a class divides by."""

    classes: np.ndarray
    step: np.ndarray
    share: np.ndarray
    train_tokens: int
    types: int
    ends: int

    @property
    def divisor(self) -> float:
        return math.log10(self.train_tokens + self.types + 1)


def _class_model(
    classes: np.ndarray, between: np.ndarray, sizes: np.ndarray, count: int
) -> ClassModel:
    """From the counts between classes and each class's (types, tokens)."""
    types, words = sizes
    share = (words + 1) / (words + 1).sum()
    steps = (between + share) / (between.sum(1, keepdims=True) + 1)
    return ClassModel(
        classes, np.log10(steps), np.log10(words + types + 1),
        int(words.sum()), int(types.sum()), int(words[count]),
    )


def _score(batches: Iterator[pa.RecordBatch], lexicon_of, model_of) -> Iterator[pa.RecordBatch]:
    """What the words of the dictionary and the ends add to each text's scores."""
    lexicon, model = lexicon_of.value, model_of.value
    logs = np.log10(np.concatenate([lexicon.counts, np.zeros(lexicon.endings), [model.ends]]) + 1.0)
    end_class = model.classes[lexicon.end_place]
    for batch in _slices(batches):
        flat, starts = _places(batch)
        rare = (flat >= lexicon.size) & (flat < lexicon.end_place)
        own = model.classes[flat]
        before, rare_before = _before(own, end_class), _before(rare, False)
        steps = np.where(rare | rare_before, 0.0, model.step[before, own])
        shares = np.where(rare, 0.0, model.share[own])
        n = np.diff(np.append(starts, len(flat)))
        local = np.add.reduceat(logs[flat], starts)
        found = {
            "n_tokens": n,
            "known": n - 1 - np.add.reduceat(rare.astype(np.int64), starts) + (model.ends > 0),
            "base": local - n * model.divisor,
            "score": local + np.add.reduceat(steps - shares, starts),
        }
        yield pa.RecordBatch.from_arrays(
            [batch.column(name) for name in ("row", "doc_id", "held_out")]
            + [pa.array(values) for values in found.values()],
            names=["row", "doc_id", "held_out", *found],
        )


def _score_rare(batches: Iterator[pa.RecordBatch], model_of) -> Iterator[pa.RecordBatch]:
    """What each word beyond the dictionary adds: itself, the step to it, and that to a known one."""
    model = model_of.value
    for batch in batches:
        n, own, before, after = (
            batch.column(x).to_numpy() for x in ("n", "class", "before", "after")
        )
        base = np.log10(n + 1.0)
        score = base - model.share[own] + model.step[before, own]
        score += np.where(after >= 0, model.step[own, np.maximum(after, 0)], 0.0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), *(pa.array(x) for x in (base, score, (n > 0).astype(np.int64)))],
            names=["row", "base", "score", "known"],
        )


def frequent_words(vocabulary: DataFrame, most: int, units: int, endings: int) -> Lexicon:
    """At most ``most`` words of up to ``LONGEST`` bytes: those above a count that fits them all."""
    short = vocabulary.where((F.octet_length("word") <= LONGEST) & (F.col("word") != END))
    step = _step(F.col("n"))
    steps = short.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()
    total, lowest = 0, None
    for row in sorted(steps, key=lambda row: -row["step"]):
        total += row["words"]
        if total > most:
            break
        lowest = row["step"]
    if lowest is None:
        return Lexicon([], np.zeros(0), units, endings)
    table = short.where(step >= lowest).toArrow()
    words = table.column("word").cast(pa.binary()).to_pylist()
    counts = table.column("n").to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    return Lexicon([words[i] for i in order], counts[order].astype(float), units, endings, lowest)


def score_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    most: int = DICTIONARY,
    units: int = UNITS,
    endings: int = ENDINGS,
    count: int = CLASSES,
    rounds: int = ROUNDS,
    seen: int = SEEN,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity).

    One row for each document. Learns from the documents outside the held-out fold of the id. Each
    class has one unseen word of its own, and all counts are one higher than seen, so every
    probability is positive. A null or empty text is its end alone. With nothing to learn from,
    all counts are 0. Equal rows are scored alike, ids need not be unique; other columns are
    ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text")
    ).withColumn("held_out", id_fold(F.col("doc_id"), FOLDS) == HELD_OUT)
    training = rows.where(~F.col("held_out")).select("text")
    vocabulary, _ = store(
        training.mapInArrow(_count_words, _COUNTS).groupBy("word").agg(F.sum("n").alias("n")),
        "words",
    )
    lexicon = frequent_words(vocabulary, most, units, endings)
    ends = vocabulary.where(F.col("word") == END).agg(F.sum("n")).first()[0] or 0
    context, width = spark.sparkContext, count + 1
    lexicon_of = context.broadcast(lexicon)
    encoded, _ = store(rows.mapInArrow(partial(_encode, lexicon_of=lexicon_of), _ENCODED), "places")
    learnt = encoded.where(~F.col("held_out"))

    # the first step's classes, then those of all other words
    unit_of = lexicon.unit_of()
    pairing = partial(
        _count_pairs, unit_of_place=context.broadcast(unit_of), width=lexicon.end_unit + 1
    )
    pairs = (
        learnt.select("places").mapInArrow(pairing, _PAIRS)
        .groupBy("unit", "next")
        .agg(F.sum("n").alias("n"))
    )
    of_unit, between = cluster(pairs, lexicon.end_unit + 1, count, rounds)
    classes = of_unit[unit_of]
    moved, _ = store(
        move_words(
            learnt.select("places", "rare"), lexicon_of, context.broadcast(classes), between,
            count, seen,
        ),
        "moved",
    )
    classes = classes.copy()
    inside = moved.where(F.col("place") < lexicon.size).select("place", "class").toArrow()
    classes[inside.column("place").to_numpy()] = inside.column("class").to_numpy()
    classes_of = context.broadcast(classes)

    # count and class of the words beyond the dictionary, and where they stand
    of_ending = F.array(*(F.lit(int(x)) for x in classes[lexicon.size : lexicon.end_place]))
    ending = F.pmod(F.crc32(F.substring(F.col("word").cast("binary"), -3, 3)), F.lit(endings))
    outside = moved.where(F.col("place") >= lexicon.size)
    beyond, _ = store(
        vocabulary.where((F.col("word") != END) & ~lexicon.holds(F.col("word"), F.col("n")))
        .withColumn("name", _name(F.col("word")))
        .withColumn("place", (ending + lexicon.size).cast("int"))
        .join(outside, ["name", "place"], "left")
        .select(
            "word", "n",
            F.coalesce("class", F.get(of_ending, F.col("place") - lexicon.size)).alias("class"),
        ),
        "beyond",
    )
    with_classes = {"lexicon_of": lexicon_of, "classes_of": classes_of, "width": width}
    tokens_beyond = encoded.where(F.size("rare") > 0).mapInArrow(
        partial(_rare_tokens, **with_classes), _RARE
    )
    hot = hot_keys(beyond, ["word"], "n", ROWS_PER_SLICE)
    in_text = Window.partitionBy("row").orderBy("at")
    rare, _ = store(
        join_unique(tokens_beyond, beyond, "word", hot, "left")
        .withColumn("class", F.coalesce("class", "ending"))
        .withColumn(
            "before",
            F.when(F.col("before") >= 0, F.col("before")).otherwise(F.lag("class").over(in_text)),
        )
        .select(
            "row", "held_out", "class", "before", "after", F.coalesce("n", F.lit(0)).alias("n")
        ),
        "rare",
    )

    # the model: steps between classes, and each class's words
    learnt_rare = rare.where(~F.col("held_out"))
    one = F.lit(1).cast("bigint").alias("n")
    steps = (
        learnt.select("places")
        .mapInArrow(partial(_count_steps, **with_classes), "before int, class int, n long")
        .unionAll(learnt_rare.select("before", "class", one))
        .unionAll(learnt_rare.where(F.col("after") >= 0).select("class", "after", one))
    )
    between = np.zeros((width, width))
    for row in steps.groupBy("before", "class").agg(F.sum("n").alias("n")).collect():
        between[row["before"], row["class"]] = row["n"]
    own = classes[: lexicon.size]
    sizes = np.zeros((2, width))
    sizes[0] = np.bincount(own, minlength=width)
    sizes[1] = np.bincount(own, lexicon.counts, width)
    sizes[:, count] = ends > 0, ends
    for row in (
        beyond.groupBy("class")
        .agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("tokens"))
        .collect()
    ):
        sizes[:, row["class"]] += row["types"], row["tokens"]
    model = _class_model(classes, between, sizes, count)
    model_of = context.broadcast(model)

    scoring = partial(_score, lexicon_of=lexicon_of, model_of=model_of)
    local = encoded.select("row", "doc_id", "held_out", "places").mapInArrow(scoring, _LOCAL)
    more = (
        rare.select("row", "class", "before", "after", "n")
        .mapInArrow(
            partial(_score_rare, model_of=model_of),
            "row long, base double, score double, known long",
        )
        .groupBy("row")
        .agg(*(F.sum(name).alias(f"more_{name}") for name in ("base", "score", "known")))
    )

    def whole(name: str) -> Column:
        zero = F.lit(0) if name == "known" else F.lit(0.0)
        return F.col(name) + F.coalesce(f"more_{name}", zero)

    return local.join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        whole("known").alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        whole("base").alias("base_score"),
        whole("score").alias("score"),
        F.pow(F.lit(10.0), -whole("score") / F.col("n_tokens")).alias("perplexity"),
    )
