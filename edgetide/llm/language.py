"""Language identification by character models with interpolated Kneser-Ney smoothing.

Each language has a model of the characters of words, up to ``ORDER`` at a time, word ends
included. All models lie in arrays sorted by the hash of the characters, one for each order, with
a column for each language. A text goes to the language with the lowest cross-entropy per
character; a temperature and, for each language, a limit of the cross-entropy are calibrated on
documents that the models have not seen.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgetide.llm.common import id_fold
from edgetide.storage import store

ORDER = 4
TRAIN_ROWS = 20_000  # of each language
FEW_ROWS = 8
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
REMEMBERED = 200_000
ROWS = 512
START, END = "\x02", "\x03"

_words = re.compile(r"[^\W\d_]+").findall
_GRAMS = "lang string, gram string, n long"
_FOUND = "doc_id bigint, held_out boolean, lang_pred string, score double, entropy double, rejected boolean"
_FOUND_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
        ("score", pa.float64()), ("entropy", pa.float64()), ("rejected", pa.bool_()),
    ]
)


def _count_grams(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """Counts of the longest runs of characters: every character of a word with what precedes it."""
    words: dict[str, Counter] = {}
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            rows = batch.slice(start, ROWS)
            for lang, text in zip(
                rows.column("lang").to_pylist(), rows.column("text").to_pylist(), strict=True
            ):
                words.setdefault(lang, Counter()).update(_words((text or "").lower()))
    for lang, counts in words.items():
        grams: Counter = Counter()
        for word, n in counts.items():
            padded = START + word + END
            for end in range(2, len(padded) + 1):
                grams[padded[max(0, end - order) : end]] += n
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(grams), pa.string()),
                pa.array(list(grams), pa.string()),
                pa.array(list(grams.values()), pa.int64()),
            ],
            names=["lang", "gram", "n"],
        )


def _hashes(codes: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of the ``length`` characters that end at each place."""
    found = np.full(len(places), length, np.uint64)
    for back in range(length - 1, -1, -1):
        found = (found ^ codes[places - back]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return found


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _hash_of(grams: list[str]) -> np.ndarray:
    """Hashes of grams of one length."""
    length = len(grams[0])
    codes = _codes("".join(grams))
    return _hashes(codes, np.arange(length - 1, len(codes), length), length)


@dataclass
class Models:
    """For each order: sorted hashes of grams with probabilities, of contexts with what they leave
    to the next lower order; a column for each language."""

    langs: list[str]
    order: int
    floor: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    limits: np.ndarray
    temperature: float = 1.0

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Natural log-probability of each word and its end, a column for each language."""
        padded = [START + word + END for word in words]
        codes = _codes("".join(padded))
        lengths = np.array([len(x) for x in padded])
        starts = np.cumsum(lengths) - lengths
        inside = np.arange(len(codes)) - np.repeat(starts, lengths)
        places = np.flatnonzero(inside > 0)
        depth = inside[places]
        p = np.repeat(self.floor[None, :], len(places), 0)
        for n in range(1, self.order + 1):
            deep = np.flatnonzero(depth >= n - 1)
            at = places[deep]
            lower = p[deep]
            if n > 1:
                keys, leaves = self.contexts[n - 1]
                _, own, hit = _search(keys, _hashes(codes, at - 1, n - 1))
                lower[hit] *= leaves[own[hit]]
            keys, add = self.grams[n - 1]
            _, own, hit = _search(keys, _hashes(codes, at, n))
            lower[hit] += add[own[hit]]
            p[deep] = lower
        logs = np.log(p)
        first = np.cumsum(lengths - 1) - (lengths - 1)
        return np.add.reduceat(logs, first, axis=0)


def _search(keys: np.ndarray, wanted: np.ndarray):
    own = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    hit = keys[own] == wanted if len(keys) else np.zeros(len(wanted), bool)
    return wanted, own, hit


def _models(rows: list, order: int) -> Models:
    """Models from (lang, gram, n); the highest order counts occurrences, a lower one in how many
    ways its grams continue to the left."""
    langs = sorted({row["lang"] for row in rows})
    count: list[list[Counter]] = [[Counter() for _ in langs] for _ in range(order + 1)]
    for row in rows:
        lang, gram = langs.index(row["lang"]), row["gram"]
        count[len(gram)][lang][gram] += row["n"]
    for lang in range(len(langs)):
        for n in range(order, 1, -1):
            for gram in list(count[n][lang]):
                # a gram at a word's start has no characters before it: its own count stays
                count[n - 1][lang][gram[1:]] += 1
    letters = {gram for counter in count[1] for gram in counter}
    floor = np.full(len(langs), 1.0 / (len(letters) + 1))
    grams, contexts = [], []
    for n in range(1, order + 1):
        add: dict[str, np.ndarray] = {}
        leaves: dict[str, np.ndarray] = {}
        for lang, counter in enumerate(count[n]):
            total: Counter = Counter()
            kinds: Counter = Counter()
            for gram, c in counter.items():
                total[gram[:-1]] += c
                kinds[gram[:-1]] += 1
            ones = sum(c == 1 for c in counter.values())
            twos = sum(c == 2 for c in counter.values())
            discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones + twos else 0.5
            for gram, c in counter.items():
                own = add.setdefault(gram, np.zeros(len(langs)))
                own[lang] = max(c - discount, 0) / total[gram[:-1]]
            for context, c in total.items():
                own = leaves.setdefault(context, np.ones(len(langs)))
                own[lang] = discount * kinds[context] / c
        if n == 1:
            floor = floor * leaves.get("", np.ones(len(langs)))
        grams.append(_sorted(add, len(langs)))
        contexts.append(_sorted(leaves, len(langs)) if n > 1 else _sorted({}, len(langs)))
    return Models(langs, order, floor, grams, contexts, np.full(len(langs), np.inf))


def _sorted(table: dict[str, np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    if not table:
        return np.empty(0, np.uint64), np.empty((0, width))
    keys, values = _hash_of(list(table)), np.stack(list(table.values()))
    order = np.argsort(keys)
    return keys[order], values[order]


class _Scorer:
    """Scores of whole texts; the scores of words seen lately are kept."""

    def __init__(self, models: Models):
        self._models = models
        self._reset()

    def _reset(self) -> None:
        self._at: dict[str, int] = {}
        self._scores = np.zeros((0, len(self._models.langs)))

    def __call__(self, texts: list[str | None]) -> list[tuple[np.ndarray, int] | None]:
        """(cross-entropy by language, characters) of each text; None without letters."""
        split = [_words((text or "").lower()) for text in texts]
        new = list(set().union(*split).difference(self._at))
        if len(self._at) + len(new) > REMEMBERED:
            self._reset()
            new = list(set().union(*split))
        if new:
            for start in range(0, len(new), 20_000):
                part = new[start : start + 20_000]
                base = len(self._at)
                self._at.update(zip(part, range(base, base + len(part)), strict=True))
                self._scores = np.concatenate([self._scores, self._models.word_scores(part)])
        found: list = []
        for words in split:
            chars = sum(map(len, words)) + len(words)
            if not any(x.isalpha() for word in words for x in word):
                found.append(None)
                continue
            at = np.fromiter(map(self._at.__getitem__, words), np.int64, len(words))
            found.append((-self._scores[at].sum(0) / chars, chars))
        return found


def _judge(models: Models, entropy: np.ndarray) -> tuple[int, float, bool]:
    """(language, score, rejected) from the cross-entropies per character."""
    best = int(np.argmin(entropy))
    weights = np.exp((entropy[best] - entropy) / models.temperature)
    rejected = bool(entropy[best] > models.limits[best])
    return best, float(1 / weights.sum()) * (0.5 if rejected else 1.0), rejected


def _predict(batches: Iterator[pa.RecordBatch], models: Models) -> Iterator[pa.RecordBatch]:
    scorer = _Scorer(models) if models.langs else None
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            rows = batch.slice(start, ROWS)
            texts = rows.column("text").to_pylist()
            found = []
            for scored in scorer(texts) if scorer else [None] * len(texts):
                if scored is None:
                    found.append((UNKNOWN, 0.0, None, True))
                    continue
                best, score, rejected = _judge(models, scored[0])
                found.append((models.langs[best], score, float(scored[0][best]), rejected))
            columns = [rows.column("doc_id"), rows.column("held_out")]
            columns += [
                pa.array(x, kind)
                for x, kind in zip(zip(*found, strict=True), _FOUND_ARROW.types[2:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_FOUND_ARROW)


def _entropies(batches: Iterator[pa.RecordBatch], models: Models) -> Iterator[pa.RecordBatch]:
    scorer = _Scorer(models)
    for batch in batches:
        langs, entropies = [], []
        for start in range(0, batch.num_rows, ROWS):
            rows = batch.slice(start, ROWS)
            texts = rows.column("text").to_pylist()
            for lang, scored in zip(rows.column("lang").to_pylist(), scorer(texts), strict=True):
                if scored is not None:
                    langs.append(lang)
                    entropies.append(scored[0].tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(entropies, pa.list_(pa.float64()))],
            names=["lang", "entropies"],
        )


def _limit(entropies: np.ndarray) -> float:
    """The cross-entropy beyond which a text is rejected, from unseen texts of the language.

    Six deviations above the median, by quartiles, and no less than all but the highest hundredth
    (one at least), so that a few mislabelled rows do not lift it.
    """
    low, middle, high = np.quantile(entropies, (0.25, 0.5, 0.75))
    most = np.quantile(entropies, 0.99, method="lower")
    return float(max(middle + 6 * (high - low) / 1.349, most))


def fit_models(rows: DataFrame, order: int = ORDER, train_rows: int = TRAIN_ROWS) -> Models:
    """Models from labelled ``rows`` (doc_id, text, lang).

    About ``train_rows`` rows of each language, chosen by the hash of their ids, and all rows of
    one with fewer, bound what is collected: three quarters are counted, the others calibrate. Of
    a language with less than ``FEW_ROWS`` rows all are counted, and it has no limit.
    """
    totals = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("total"))
    spread = 1 << 40
    place = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(spread)) / spread
    chosen, _ = store(
        rows.join(F.broadcast(totals), "lang").where(place < train_rows / F.col("total")),
        "train",
    )
    few = F.col("total") < FEW_ROWS
    part = F.when(few, F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)))
    counted = (
        chosen.where(part < 3)
        .select("lang", "text")
        .mapInArrow(partial(_count_grams, order=order), _GRAMS)
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .collect()  # as many as the chosen rows hold
    )
    models = _models(counted, order)
    if not models.langs:
        return models
    unseen = (
        chosen.where(part == 3)
        .select("lang", "text")
        .mapInArrow(partial(_entropies, models=models), "lang string, entropies array<double>")
        .collect()
    )
    known = [(models.langs.index(r["lang"]), np.array(r["entropies"])) for r in unseen
             if r["lang"] in models.langs]
    for lang in range(len(models.langs)):
        own = [entropy[lang] for at, entropy in known if at == lang]
        if own:
            models.limits[lang] = _limit(np.array(own))
    if known:

        def loss(temperature: float) -> float:
            total = 0.0
            for at, entropy in known:
                gap = (entropy.min() - entropy) / temperature
                total += np.log(np.exp(gap).sum()) - gap[at]
            return total

        models.temperature = min((0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0), key=loss)
    return models


def identify(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, entropy, rejected), a row for each document.

    Learns from the text and non-null language of documents outside the held-out fold of the id.
    A null text or one without letters is ``und`` with score 0, as is every text when nothing
    could be learned. Ties go to the first language in code-point order. ``rejected`` marks texts
    whose cross-entropy is beyond their language's limit, their score is halved. Equal rows are
    judged alike; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(text_column).alias("text"),
        F.col(lang_column).alias("lang"),
    ).withColumn("held_out", id_fold(F.col("doc_id"), FOLDS) == HELD_OUT)
    labelled = rows.where(~F.col("held_out") & F.col("lang").isNotNull())
    models = fit_models(labelled.select("doc_id", "text", "lang"), train_rows=train_rows)
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        partial(_predict, models=models), _FOUND
    )
