import random
import re

import pytest

from edgetide.llm import contamination as module
from edgetide.llm.contamination import (
    TERM, build_index, find_contamination, terms_of, windows_of,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(TERM, (text or "").translate(LOWER))


def windows(words, size):
    if len(words) < size:
        return [words] if words else []
    return [words[i : i + size] for i in range(len(words) - size + 1)]


def brute(text, items, size, within):
    words = words_of(text)
    hit, found, near = set(), set(), set()
    for item_id, item in items:
        for window in windows(words_of(item), size):
            n = len(window)
            for i in range(len(words) - n + 1):
                if words[i : i + n] == window:
                    hit.update(range(i, i + n))
                    found.add(item_id)
            stretches = range(max(1, len(words) - within + 1))
            if words and any(set(window) <= set(words[i : i + within]) for i in stretches):
                near.add(item_id)
    ids = sorted(str(i) for i in found - {None})
    return len(words), len(hit), ids, bool(hit), len(near - {None})


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Über", "ñandú", *(f"w{i}" for i in range(12))]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, say(rng.randint(1, 12))) for i in range(12)]
    items += [(12, None), (13, ""), (14, " .,- "), (15, items[0][1]), (15, say(6)), (None, say(5))]
    items += [(16, "absent " + say(5)), (17, "the the the the"), (18, "w1"), (19, "the the")]
    texts = [say(rng.randint(0, 60)) for _ in range(40)]
    for _ in range(40):
        item = rng.choice(items[:12])[1].split()
        shuffled = rng.sample(item, len(item))
        part = rng.choice((item, item[:4], item[1:], shuffled))
        texts.append(f"{say(9)}, {'-'.join(part).upper()}. {say(rng.randint(0, 30))}")
    return texts, items


@pytest.fixture(params=[False, True])
def shuffled(request, monkeypatch):
    """With every table small enough to broadcast, and with none."""
    if request.param:
        monkeypatch.setattr(module, "BROADCAST_ROWS", -1)


@pytest.mark.parametrize("seed,size,within", [(1, 4, 7), (2, 2, 3)])
def test_equals_brute_force(spark, make_docs, odd_texts, crowded, shuffled, seed, size, within):
    texts, items = made(seed)
    texts += [*odd_texts, *texts[:5], "The THE the, the the", "w1"]
    ids = [None, 3, 3, *range(10, 7 + len(texts))]
    table = crowded(spark.createDataFrame(items, "item_id bigint, text string"))
    docs = crowded(make_docs(texts, ids=ids))
    rows = find_contamination(docs, table, size, within).collect()
    got = sorted((tuple(row) for row in rows), key=repr)
    want = [(i, *brute(text, items, size, within)) for i, text in zip(ids, texts)]
    assert got == sorted(want, key=repr)
    assert sum(row.contaminated for row in rows) > 20


def test_no_documents_no_items_and_no_proximity(spark, make_docs):
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    docs = make_docs(["a b c", None])
    assert find_contamination(docs.limit(0), items).collect() == []
    rows = find_contamination(docs, items.limit(0)).orderBy("doc_id").collect()
    assert [tuple(row) for row in rows] == [(0, 3, 0, [], False, 0), (1, 0, 0, [], False, 0)]
    rows = find_contamination(docs, items, within=None).orderBy("doc_id").collect()
    assert tuple(rows[0]) == (0, 3, 2, ["1"], True, None)


def test_index_has_every_position(make_docs):
    texts = ["a b a", None, "B;c", "a b a"]
    index = build_index(make_docs(texts))
    assert dict(index.frequencies().collect()) == {"a": 4, "b": 3, "c": 1}
    found = {(row.term, row.position) for row in index.postings.where("term != ''").collect()}
    assert found == {("a", 0), ("b", 1), ("a", 2), ("b", 0), ("c", 1)}
    assert sorted(row.n_words for row in index.lengths().collect()) == [0, 2, 3]
    index.release()


def test_windows_are_distinct_and_owned(spark):
    items = [(1, "a b c"), (2, "b c d"), (3, "x"), (3, "x")]
    windows = windows_of(spark.createDataFrame(items, "item_id int, text string"), 2)
    rows = windows.phrases.join(windows.owners, "phrase_id").select("phrase", "item_id").collect()
    assert sorted(map(tuple, rows)) == [("a b", 1), ("b c", 1), ("b c", 2), ("c d", 2), ("x", 3)]


def test_long_text_and_passage_of_many_copies(spark, make_docs):
    passage = " ".join(f"p{i}" for i in range(60))
    filler = " ".join(f"f{i % 701}" for i in range(30_000))
    texts = [f"{filler} {passage} {filler}", *[f"q {passage}"] * 400, filler]
    items = spark.createDataFrame([(7, passage)], "item_id bigint, text string")
    rows = find_contamination(make_docs(texts), items).orderBy("doc_id").collect()
    assert [row.n_hit for row in rows] == [60] * 401 + [0]
    assert [row.n_near for row in rows] == [1] * 401 + [0]


def test_no_python_on_the_path(spark, make_docs):
    docs = make_docs(["A b"])
    plan = docs.select(terms_of(docs["text"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
