import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from edgetide.llm import language
from edgetide.llm.language import END, START, _models, identify

ALPHABETS = {"aa": "abcde", "bb": "edxyz", "cc": "éèabx"}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    langs, texts = {}, []
    for i in range(400):
        langs[i] = rng.choice(list(ALPHABETS))
        letters = ALPHABETS[langs[i]]
        texts.append(
            " ".join("".join(rng.choices(letters, weights=(5, 4, 3, 2, 1), k=rng.randint(1, 7)))
                     for _ in range(60))
        )
    return texts, langs


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy(make_docs, corpus, crowded):
    texts, langs = corpus
    wrong = {i: "aa" if held_out(i) else lang for i, lang in langs.items()}
    docs = make_docs(texts, langs=wrong)
    rows = identify(crowded(docs.drop("label"))).collect()
    assert len(rows) == len(texts) and all(r.held_out == held_out(r.doc_id) for r in rows)
    tested = [row.lang_pred == langs[row.doc_id] for row in rows if row.held_out]
    assert sum(tested) >= 0.98 * len(tested)
    assert all(0 <= row.score <= 1 for row in rows)


def kneser_ney(words, order, floor_letters):
    """p(character | up to order - 1 before) of one language, straight from the definition."""
    grams = [Counter() for _ in range(order + 1)]
    for word in words:
        padded = START + word + END
        for end in range(2, len(padded) + 1):
            gram = padded[max(0, end - order) : end]
            grams[len(gram)][gram] += 1
    for n in range(order, 1, -1):
        for gram in list(grams[n]):
            grams[n - 1][gram[1:]] += 1

    def p(context, char, n):
        if n == 0:
            return 1 / (floor_letters + 1)
        context = context[len(context) - n + 1 :] if n > 1 else ""
        counts = grams[n]
        ones, twos = (sum(c == k for c in counts.values()) for k in (1, 2))
        discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones + twos else 0.5
        total = sum(c for gram, c in counts.items() if gram[:-1] == context)
        lower = p(context, char, n - 1)
        if not total:
            return lower
        kinds = sum(gram[:-1] == context for gram in counts)
        return max(counts[context + char] - discount, 0) / total + discount * kinds / total * lower

    return p


def test_scores_follow_the_definition():
    words = {"aa": ["abab", "abc", "a", "bca"], "bb": ["xyz", "zz", "xa"]}
    rows = []
    for lang, known in words.items():
        for word in known:
            padded = START + word + END
            rows += [{"lang": lang, "gram": padded[max(0, e - 3) : e], "n": 1} for e in range(2, len(padded) + 1)]
    models = _models(rows, 3)
    letters = len({c for known in words.values() for c in "".join(known)} | {END})
    for column, lang in enumerate(models.langs):
        p = kneser_ney(words[lang], 3, letters)
        for word in ("abc", "zzq", "xab", "é"):
            padded = START + word + END
            expected = sum(
                math.log(p(padded[max(0, e - 2) : e], padded[e], min(3, e + 1)))
                for e in range(1, len(padded))
            )
            assert models.word_scores([word])[0][column] == pytest.approx(expected)


def test_probabilities_add_up_to_one():
    words = ["abab", "abc", "a", "bca", "cab"]
    p = kneser_ney(words, 3, 4)
    for context in ("a", "ab", START + "a", "zz"):
        assert sum(p(context, c, 3) for c in "abc" + END + "?") == pytest.approx(1)


def test_odd_texts(make_docs, odd_texts, crowded):
    docs = make_docs(odd_texts)
    rows = {row.doc_id: row for row in identify(docs).collect()}
    assert len(rows) == len(odd_texts)
    for i, text in enumerate(odd_texts):
        lettered = any(c.isalpha() for c in text or "")
        assert rows[i].lang_pred == ("en" if lettered else "und")
        assert rows[i].score == 0 if not lettered else rows[i].score > 0
    assert identify(docs.limit(0)).collect() == []


def test_nothing_learned(make_docs):
    rows = identify(make_docs(["some text", None], langs={0: None, 1: None})).collect()
    assert [(row.lang_pred, row.score) for row in rows] == [("und", 0.0)] * 2


def test_forgetting_words_changes_nothing(make_docs, corpus, monkeypatch):
    texts, langs = corpus
    docs = make_docs(texts[:100], langs=langs)
    usual = sorted(map(tuple, identify(docs).collect()))
    models = language.fit_models(docs)
    assert language._Scorer(models)(texts[:9])[0][1] > 0
    monkeypatch.setattr(language, "REMEMBERED", 5)
    scorer = language._Scorer(models)
    again = [scorer([text])[0][0] for text in texts[:9]]
    first = [x[0] for x in language._Scorer(models)(texts[:9])]
    assert all((a == pytest.approx(b)) for a, b in zip(again, first)) and len(usual) == 100


def test_a_rare_language_keeps_its_rows(make_docs):
    rng = random.Random(9)
    langs = {i: "aa" for i in range(3000)}
    common = [" ".join("".join(rng.choices("abcde", k=4)) for _ in range(12)) for _ in range(3000)]
    rare = [" ".join("".join(rng.choices("vwxyz", k=4)) for _ in range(12)) for _ in range(45)]
    langs |= {3000 + i: "bb" if i < 40 else "cc" for i in range(45)}
    rare[40:] = [x.translate(str.maketrans("vwxyz", "klmno")) for x in rare[40:]]
    docs = make_docs(common + rare, langs=langs)
    rows = {row.doc_id: row for row in identify(docs, train_rows=60).collect()}
    assert all(rows[i].lang_pred == langs[i] for i in range(2900, 3045))
    models = language.fit_models(docs, train_rows=60)
    limits = dict(zip(models.langs, models.limits))
    assert math.isfinite(limits["bb"]) and limits["cc"] == math.inf


@pytest.mark.parametrize("rows", [20, 5000])
def test_mislabelled_rows_do_not_lift_the_limit(rows):
    rng = np.random.default_rng(4)
    own = rng.normal(2.0, 0.1, rows)
    limit = language._limit(own)
    assert own.max() < limit < 3.5
    wrong = np.append(own, np.full(max(1, rows // 200), 9.0))
    assert language._limit(wrong) == pytest.approx(limit, abs=0.2) and limit < 9
    assert language._limit(np.array([2.0])) == 2.0
    assert language._limit(np.array([2.0, 2.4])) > 2.4


def test_mislabelled_texts_leave_rejection_on(spark, make_docs, corpus):
    """One calibrating row of each language holds another alphabet; texts of that are rejected."""
    texts, langs = corpus
    rng = random.Random(3)
    strange = [" ".join("".join(rng.choices("klmno", k=5)) for _ in range(60)) for _ in range(23)]
    part = "pmod(xxhash64(id, 'part'), 4) = 3"  # the rows that calibrate
    calibrating = [row.id for row in spark.range(400, 600).where(part).collect()]
    wrong = [i for i in calibrating if not held_out(i)][:3]
    ids = [*range(len(texts)), *wrong, *range(600, 620)]
    labels = langs | dict(zip(wrong, ALPHABETS)) | dict.fromkeys(range(600, 620))
    docs = make_docs(texts + strange, ids=ids, langs=labels)
    rows = {row.doc_id: row for row in identify(docs).collect()}
    assert all(rows[i].rejected for i in range(600, 620))
    assert sum(rows[i].rejected for i in range(len(texts))) <= 4
