"""Periodic runs of words, found online by dyadic square catching.

Words are appended to a text. Each completed aligned block of a power of two words is a catcher: it
waits for its words to come again at a distance that its level is responsible for. Such a meeting is
a stretch of words that equal the ones one distance before; it grows with every appended word that
goes on equalling, and backwards by comparisons of dyadic windows. A stretch of twice its distance is
a square, and the squares of one distance that touch are one run.

A run of length L and period q holds at least max(12, 2q) - q successive words that equal the ones q
later, and any 2b - 1 successive words hold a whole aligned block of b words. So every period has a
block length whose catchers cannot miss a run. A word meets at most two catchers of a level of long
blocks, so the work is n log n however periodic the text is.

Windows are compared by hashes; equal windows always agree, and a stretch is compared word by word
before it counts as a run, so that an accidental agreement neither adds nor hides one.

Documents are Spark's rows and never leave their task: nothing is shuffled. A task joins the words
of a bounded number of documents to one text, with a mark that occurs once between any two, as no run
can contain such a word.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST_LENGTH = 12
REWRITTEN = 10

# Words appended at a time; documents share a text of about as many words.
WORDS_AT_ONCE = 200_000

SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
)

_NONE = np.empty((0, 3), np.int64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values * np.uint64(0x9E3779B97F4A7C15)
    return (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _inside(found: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which stretches (period, start, end) lie inside one of the known ones."""
    if not len(known) or not len(found):
        return np.zeros(len(found), bool)
    known = known[np.argsort(known[:, 1], kind="stable")]
    furthest = np.maximum.accumulate(known[:, 2])
    at = np.searchsorted(known[:, 1], found[:, 1], side="right") - 1
    return (at >= 0) & (furthest[np.maximum(at, 0)] >= found[:, 2])


class Catchers:
    """The runs of a growing text of word numbers that are at least ``least`` words long.

    ``append`` takes any number of words at a time; the runs do not depend on how words are dealt
    out. ``longest`` bounds the length of a run where it is known that no longer one can occur.
    """

    def __init__(self, least: int = LEAST_LENGTH, longest: int | None = None) -> None:
        self.least = least
        self.longest = longest
        self.words = np.empty(0, np.int64)
        # hashes of all windows of 1, 2, 4, ... words
        self._windows: dict[int, np.ndarray] = {}
        # rows (period, start, end): stretches that reach the end of the text, and ended runs
        self._open = _NONE
        self._closed = _NONE

    def append(self, words: np.ndarray) -> None:
        """Add words, and move every catcher and every open stretch on."""
        since = len(self.words)
        self.words = np.concatenate([self.words, np.asarray(words, np.int64)])
        n = len(self.words)
        self._hash_new(since, min(n, self.longest or n))
        found = [self._grown(self._open)]
        runs = self._runs_among(np.concatenate([self._closed, found[0]]))
        # a square that is not complete yet may have met its catcher already
        for block, periods in self._levels(min(n - 1, self.longest // 2 if self.longest else n)):
            met = self._meetings(block, periods, since)
            # a meeting inside a run of a period up to a block is at a multiple of it
            met = self._grown(met[~_inside(met, runs[runs[:, 0] <= block])])
            if len(met):
                met = np.unique(met, axis=0)
                found.append(met)
                if self._long(met).any():
                    runs = self._runs_among(np.concatenate([runs, met]))
        found = np.unique(np.concatenate(found), axis=0)
        self._open = found[found[:, 2] == n]
        self._closed = runs[runs[:, 2] < n]

    def runs(self) -> np.ndarray:
        """All runs so far as rows (start, length, period), by start, then period."""
        found = self._runs_among(np.concatenate([self._closed, self._open]))
        found = found[np.lexsort((found[:, 0], found[:, 1]))]
        return np.stack([found[:, 1], found[:, 2] - found[:, 1], found[:, 0]], axis=1)

    def _levels(self, most: int) -> Iterator[tuple[int, range]]:
        """Block lengths with the periods they catch, in order; a group holds no two multiples."""
        period = 1
        while period <= most:
            successive = max(period, self.least - period)
            block = 1 << ((successive + 1) // 2).bit_length() - 1
            last = 4 * block - 3 if self.least <= period < 4 * block - 2 else period
            yield block, range(period, min(last, most) + 1)
            period = last + 1

    def _hash_new(self, since: int, most: int) -> None:
        new = _mixed(self.words[since:].astype(np.uint64) + np.uint64(1))
        old = self._windows.get(1, new[:0])
        self._windows[1] = level = np.concatenate([old, new])
        size = 1
        while 2 * size <= most:
            old = self._windows.get(2 * size, new[:0])
            left, right = level[len(old) : len(level) - size], level[len(old) + size :]
            joined = _mixed(left * np.uint64(3) + (right ^ (right >> np.uint64(31))))
            size *= 2
            self._windows[size] = level = np.concatenate([old, joined])

    def _meetings(self, block: int, periods: range, since: int) -> np.ndarray:
        """Where a block's words come again in windows that end after ``since``; neighbours joined."""
        hashes = self._windows.get(block, self._windows[1][:0])
        first = max(0, since - block + 1)
        found = []
        if len(periods) <= self.least:
            for period in periods:
                least = -(-max(0, first - period) // block) * block
                at = np.arange(least, len(hashes) - period, block)
                at = at[hashes[at] == hashes[at + period]]
                found.append(np.stack([np.full(len(at), period), at], axis=1))
        else:  # at most two aligned blocks lie as far back as the periods say
            here = np.arange(max(first, periods[0]), len(hashes))
            at = -(-np.maximum(here - periods[-1], 0) // block) * block
            for _ in range(2):
                near = here - at >= periods[0]
                here, at = here[near], at[near]
                hit = hashes[at] == hashes[here]
                found.append(np.stack([here[hit] - at[hit], at[hit]], axis=1))
                at = at + block
        found = np.concatenate(found)
        if not len(found):
            return _NONE
        found = found[np.lexsort((found[:, 1], found[:, 0]))]
        step = np.diff(found, axis=0)
        heads = np.flatnonzero(np.r_[True, (step[:, 0] != 0) | (step[:, 1] != block)])
        lasts = np.append(heads[1:], len(found)) - 1
        period = found[heads, 0]
        return np.stack([period, found[heads, 1], found[lasts, 1] + block + period], axis=1)

    def _grown(self, found: np.ndarray) -> np.ndarray:
        """Stretches made as long as their words go on equalling, by ever shorter windows."""
        if not len(found):
            return found
        period, left, right = (column.copy() for column in found.T)
        for size in sorted(self._windows, reverse=True):
            hashes = self._windows[size]
            some = np.arange(len(found))
            while len(some):
                some = some[right[some] + size <= len(self.words)]
                some = some[hashes[right[some]] == hashes[right[some] - period[some]]]
                right[some] += size
            some = np.arange(len(found))
            while len(some):
                some = some[left[some] >= size]
                before = left[some] - size
                some = some[hashes[before] == hashes[before + period[some]]]
                left[some] -= size
        return np.stack([period, left, right], axis=1)

    def _long(self, found: np.ndarray) -> np.ndarray:
        return found[:, 2] - found[:, 1] >= np.maximum(self.least, 2 * found[:, 0])

    def _runs_among(self, found: np.ndarray) -> np.ndarray:
        """The stretches that are runs: long, equal word by word, and of no smaller period.

        A stretch of twice its length that lies in a run of a smaller period repeats that; the
        smaller period is at most half as long, so classes of doubled periods are taken in turn.
        """
        found = np.unique(self._equal(found[self._long(found)]), axis=0)
        runs, least = _NONE, 1
        while len(found):
            some = found[:, 0] < 2 * least
            now, found = found[some], found[~some]
            runs = np.concatenate([runs, now[~_inside(now, runs)]])
            least *= 2
        return runs

    def _equal(self, found: np.ndarray) -> np.ndarray:
        """The stretches compared word by word; where hashes erred, the true ones of that period."""
        words, good, wrong = self.words, [], set()
        for row in found:
            period, start, end = row
            if np.array_equal(words[start : end - period], words[start + period : end]):
                good.append(row)
            else:
                wrong.add(int(period))
        for period in wrong:
            edges = np.flatnonzero(
                np.diff(np.r_[False, words[:-period] == words[period:], False].astype(np.int8))
            )
            true = np.stack(
                [np.full(len(edges) // 2, period), edges[::2], edges[1::2] + period], axis=1
            )
            good.extend(true[self._long(true)])
        return np.array(good, np.int64).reshape(-1, 3)


def rewritten(n: int, doc_id: int | None) -> np.ndarray | None:
    """Which original word stands at each place, where the id says that a document repeats itself.

    The crc32 of the decimal id decides; None where it leaves the words alone, as it does for a null
    id.
    """
    code = zlib.crc32(str(doc_id).encode())
    if doc_id is None or code % REWRITTEN or not n:
        return None
    code //= REWRITTEN
    start = code % n
    period = 1 + (n - start) // (3 + code % 8)
    places = np.arange(n)
    places[start:] = start + (places[start:] - start) % period
    return places


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run repeats, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(marks[:-1]) == 0))


def described(texts: list[list[bytes]], at_once: int = WORDS_AT_ONCE) -> Iterator[tuple]:
    """Of each text (its words): runs (start, length, period), and the text without repeats."""
    sizes = np.array([len(words) for words in texts], np.int64)
    joined = [word for words in texts for word in words]
    numbers = pd.factorize(np.array(joined, dtype=object))[0] if joined else np.empty(0, np.int64)
    # a mark that occurs once follows each text
    ends = np.cumsum(sizes)
    marks = len(joined) + np.arange(len(texts))
    text = np.insert(numbers.astype(np.int64), ends, marks)
    catchers = Catchers(longest=int(sizes.max(initial=0)) or 1)
    for at in range(0, len(text), at_once):
        catchers.append(text[at : at + at_once])
    found = catchers.runs()
    starts = ends - sizes + np.arange(len(texts))
    cuts = np.searchsorted(found[:, 0], np.append(starts, len(text)))
    for k, words in enumerate(texts):
        runs = found[cuts[k] : cuts[k + 1]] - np.array([starts[k], 0, 0])
        yield runs, _collapsed(words, runs)


def _row(doc_id: int | None, runs: np.ndarray, collapsed: bytes) -> tuple:
    """The row of ``SCHEMA`` of one document."""
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    digests = (hashlib.sha256(x).hexdigest() for x in (listed.encode(), collapsed))
    if not len(runs):
        return doc_id, 0, None, None, None, None, *digests
    best = np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]
    start, length, period = (int(x) for x in runs[best])
    return doc_id, len(runs), start, length, period, 1000 * length // period, *digests


def _groups(batch: pa.RecordBatch, at_once: int) -> Iterator[tuple[list, list]]:
    """Ids and words of documents, about ``at_once`` words in a group."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        # bytes.split() parts at space, tab, line feed, vertical tab, form feed and return
        words = (text.as_py() or "").encode().split()
        places = rewritten(len(words), doc_id)
        ids.append(doc_id)
        texts.append(words if places is None else [words[i] for i in places])
        held += len(words)
        if held >= at_once:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def periodic_runs(docs: DataFrame, at_once: int = WORDS_AT_ONCE) -> DataFrame:
    """Runs of each document as ``SCHEMA``: their number, the longest one, and two digests.

    Of the longest run (ties: least start, then period) start, length, period and 1000 times length
    through period are given, null without a run. A null or empty text has no words and no run. Rows
    are taken one by one, so repeated rows and ids give repeated results; a null id leaves its text as
    it is. Texts of any length are read whole. Other columns are ignored; no rows give no rows.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        kinds = [pa.string() if name.endswith("sha256") else pa.int64() for name in names]
        for batch in batches:
            for ids, texts in _groups(batch, at_once):
                rows = [_row(i, *x) for i, x in zip(ids, described(texts, at_once), strict=True)]
                columns = [
                    pa.array(column, kind)
                    for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    columns = docs["doc_id"].cast("bigint"), docs["text"]
    return docs.select(*columns).mapInArrow(each, SCHEMA)
