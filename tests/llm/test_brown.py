import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from edgetide.llm import brown
from edgetide.llm.brown import exchange, score_documents, tokens


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def brute_base(texts):
    counts = Counter()
    for i, text in texts.items():
        if not held_out(i):
            counts.update([*tokens(text), b""])
    total, kinds = sum(counts.values()), len(counts)
    found = {}
    for i, text in texts.items():
        words = [*tokens(text), b""]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
        found[i] = (len(words), sum(counts[w] > 0 for w in words), total, base)
    return found


@pytest.fixture(scope="module")
def corpus():
    """Two kinds of words that follow each other in turn, and rare ones."""
    rng = random.Random(6)
    texts = {}
    for i in range(300):
        words = []
        for k in range(rng.randint(0, 80)):
            kind = "A" if k % 2 else "b"
            words.append(f"{kind}{min(rng.randrange(40), rng.randrange(40))}")
            if rng.random() < 0.05:
                words[-1] = f"{kind}rare{rng.randrange(10_000)}"
        texts[i] = " ".join(words)
    return texts


def small(docs, **options):
    return score_documents(docs, **({"units": 60, "endings": 16, "count": 4} | options))


@pytest.mark.parametrize("most", [10, 50, 100_000])
def test_counts_and_base_score(make_docs, corpus, crowded, most):
    docs = crowded(make_docs(list(corpus.values()), ids=list(corpus)).drop("word"))
    expected = brute_base(corpus)
    rows = small(docs, most=most).collect()
    assert len(rows) == len(corpus)
    for row in rows:
        n, known, total, base = expected[row.doc_id]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (n, known, total)
        assert row.base_score == pytest.approx(base)
        assert row.held_out == held_out(row.doc_id)
        assert row.perplexity == pytest.approx(10 ** (-row.score / n))


def test_the_classes_beat_single_words(make_docs, corpus):
    docs = make_docs(list(corpus.values()), ids=list(corpus))
    rows = [row for row in small(docs).collect() if row.held_out]
    assert sum(row.score for row in rows) > sum(row.base_score for row in rows)


def test_the_dictionary_size_hardly_matters(make_docs, corpus):
    """Scores come from exact counts: only which words are units may change."""
    docs = make_docs(list(corpus.values()), ids=list(corpus))
    wide = {row.doc_id: row.score for row in small(docs, units=20, most=200).collect()}
    whole = {row.doc_id: row.score for row in small(docs, units=20, most=100_000).collect()}
    assert wide == pytest.approx(whole)


@pytest.mark.parametrize("most", [40, 100_000])
def test_words_beyond_the_first_units_get_their_own_class(make_docs, most):
    """Endings say nothing here, so only the second step can tell the two kinds apart."""
    rng = random.Random(8)
    kinds = [[f"{rng.randrange(10**9)}" * (1 + (k % 9 == 0) * 9) for k in range(300)] for _ in "ab"]
    texts = []
    for _ in range(400):
        words = [
            rng.choices(kinds[k % 2], [1 / (i + 1) for i in range(300)])[0]
            for k in range(rng.randint(10, 60))
        ]
        texts.append(" ".join(words))

    def held(seen):
        rows = small(make_docs(texts), units=20, count=3, most=most, seen=seen).collect()
        return sum(row.score for row in rows if row.held_out)

    moved, by_ending, base = held(3), held(10**9), brute_base(dict(enumerate(texts)))
    assert moved > by_ending + 0.02 * abs(by_ending)
    assert moved > sum(base[i][3] for i in base if held_out(i))


def test_pairs_and_neighbours_are_counted_exactly(make_docs, corpus, monkeypatch):
    """The counts between classes add up to all training tokens, whatever the dictionary holds."""
    caught = []
    made = brown._class_model
    monkeypatch.setattr(brown, "_class_model", lambda *x: caught.append(x) or made(*x))
    for most in (40, 100_000):  # both hold all ten units
        small(make_docs(list(corpus.values()), ids=list(corpus)), units=10, most=most).collect()
    total = sum(len(tokens(t)) + 1 for i, t in corpus.items() if not held_out(i))
    (_, few, few_sizes, _), (_, all_, all_sizes, _) = caught
    assert few.sum() == all_.sum() == total
    assert (few_sizes[1] == few.sum(0)).all() and (few_sizes == all_sizes).all()
    assert (few == all_).all()


def test_probabilities_add_up_to_one(make_docs, corpus, monkeypatch):
    """Of all words of the training texts and one unseen word in each class, behind any class."""
    caught = []
    made = brown._class_model
    monkeypatch.setattr(brown, "_class_model", lambda *x: caught.append(made(*x)) or caught[0])
    docs = make_docs(list(corpus.values()), ids=list(corpus))
    small(docs).collect()
    step, share = caught[0].step, caught[0].share
    assert np.allclose((10**step).sum(1), 1)
    counts = Counter(w for i, t in corpus.items() if not held_out(i) for w in [*tokens(t), b""])
    # sum over a class's words and its unseen one of (count + 1) is what it is divided by
    assert (10**share).sum() == pytest.approx(sum(n + 1 for n in counts.values()) + len(share))


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(0)
    kind = np.arange(40) % 2
    pairs = rng.integers(1, 5, (40, 40)) * np.where(kind[:, None] != kind[None, :], 20, 1)
    classes = np.append(rng.integers(0, 4, 40), 4)
    full = np.zeros((41, 41))
    full[:40, :40] = pairs

    def neighbours(classes):
        one = np.eye(5)[classes]
        return full @ one, full.T @ one

    def likelihood(classes):
        between = np.zeros((5, 5))
        np.add.at(between, classes, neighbours(classes)[0])
        x = brown._xlogx
        return x(between).sum() - x(between.sum(0)).sum() - x(between.sum(1)).sum()

    before = likelihood(classes)
    for done in range(4):
        movable = [u for u in range(40) if (u + done) % 2 == 0]
        classes = exchange(classes, *neighbours(classes), movable, 4)
    assert likelihood(classes) > before
    assert not set(classes[:40][kind == 0]) & set(classes[:40][kind == 1])


def test_the_best_class_of_many_words_is_that_of_each():
    """Against the gain over whole rows of counts, with the word taken out of its class."""
    rng = np.random.default_rng(3)
    count, width, words = 5, 6, 200
    counts = rng.integers(1, 9, (words, 2 * width)) * (rng.random((words, 2 * width)) < 0.3)
    counts[:, 0] += ~counts.any(1)
    old = rng.integers(0, count, words)
    between = rng.integers(0, 400, (width, width)).astype(float)
    np.add.at(between, old, counts[:, :width])
    np.add.at(between.T, old, counts[:, width:])
    expected = []
    for own, row in zip(old, counts.astype(float), strict=True):
        others = between.copy()
        others[own] -= row[:width]
        others[:, own] -= row[width:]
        expected.append(brown._best(others, row[:width], row[width:], count))
    of, at = np.nonzero(counts)
    found = brown._best_of_words(between, old, of, at, counts[of, at].astype(float))
    assert found.tolist() == expected
    assert len(set(expected)) > 1 and (found != old).any()


def test_names_of_words_are_no_places(spark):
    words = spark.createDataFrame([("",), ("a",), ("\u00e9t\u00e9",), ("x" * 100,)], "w string")
    names = [row[0] for row in words.select(brown._name(words.w)).collect()]
    assert len(set(names)) == 4 and max(names) < 0


def test_odd_texts(make_docs, odd_texts):
    rows = small(make_docs(odd_texts)).collect()
    expected = brute_base(dict(enumerate(odd_texts)))
    assert len(rows) == len(odd_texts)
    for row in rows:
        n, known, total, base = expected[row.doc_id]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (n, known, total)
        assert row.base_score == pytest.approx(base) and math.isfinite(row.score)


def test_nothing_to_learn_from_and_no_rows(make_docs):
    unseen = next(i for i in range(100) if held_out(i))
    (row,) = small(make_docs(["a b"], ids=[unseen])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert small(make_docs([]).limit(0)).collect() == []


def test_repeated_and_null_ids(make_docs):
    rows = small(make_docs(["a b", "a b", "a b c"], ids=[1, 1, None])).collect()
    assert sorted(row.n_tokens for row in rows) == [3, 3, 4]
    assert len({row.score for row in rows if row.doc_id == 1}) == 1
