import random
import re

import pytest

from edgetide.llm import mixing
from edgetide.llm.mixing import mix_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Targets by resharing, one source after the other."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weights = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    fixed = {}
    while True:
        rest = [name for name in names if name not in fixed]
        left = 1.5 * sum(sizes.values()) - sum(fixed.values())
        unit = left / sum(weights[name] for name in rest)
        above = [name for name in rest if unit * weights[name] > 2 * sizes[name] + 1e-9]
        if not above:
            return fixed | {name: unit * weights[name] for name in rest}
        fixed |= {name: 2.0 * sizes[name] for name in above}


@pytest.fixture(scope="module")
def docs(make_docs):
    texts, sources = [], []
    for i in range(3000):
        texts.append("w " * (i * 7919 % 90 + (i % 500 == 0) * 900))
        # one source holds a third of all rows
        sources.append("hot" if i % 3 == 0 else None if i % 10 == 1 else f"s{i % 7}")
    return make_docs(texts, sources=sources)


def by_source(docs, rows):
    source = {row.doc_id: row.source for row in docs.collect()}
    found = {}
    for row in rows:
        found.setdefault(source[row.doc_id], []).append(row)
    return found


def test_targets_and_taken(docs):
    found = by_source(docs, mix_documents(docs).collect())
    sizes = {name: sum(row.size for row in rows) for name, rows in found.items()}
    expected = brute_targets(sizes)
    for name, rows in found.items():
        assert {row.source_size for row in rows} == {sizes[name]}
        assert rows[0].target == pytest.approx(expected[name])
        taken = sum(row.taken for row in rows)
        assert taken == pytest.approx(expected[name], abs=max(row.size for row in rows))
        share = expected[name] / sizes[name]
        for row in rows:
            assert row.taken == row.copies * row.size <= 2 * row.size
            if row.size:
                assert int(share + 1e-9) <= row.copies <= int(share + 1e-9) + 1


def test_reruns_agree_whatever_the_partitions(docs):
    def rows(table):
        return sorted(map(tuple, mix_documents(table).collect()))

    assert rows(docs) == rows(docs.repartition(5))


def test_equal_ids_and_sizes_in_several_sources_do_not_depend_on_order(make_docs):
    texts = ["one two three"] * 60 + ["four words are here"] * 60
    ids, sources = [i % 7 for i in range(120)], ["a", "b", None, "c"] * 30
    rows = list(zip(ids, texts, sources))

    def taken(rows):
        docs = make_docs([r[1] for r in rows], [r[0] for r in rows], [r[2] for r in rows])
        return sorted(map(tuple, mix_documents(docs.coalesce(1)).collect()))

    usual = taken(rows)
    for seed in range(4):
        assert taken(random.Random(seed).sample(rows, len(rows))) == usual


def test_the_tree_keeps_the_sums(docs, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_BLOCK", 50)
    found = by_source(docs, mixing.mix_documents(docs).collect())
    for rows in found.values():
        assert sum(r.taken for r in rows) == pytest.approx(
            rows[0].target, abs=max(r.size for r in rows)
        )


def test_every_document_is_taken_as_often_as_others(spark):
    """Chances follow the fractions: over many seeds a document's mean is its fraction."""
    import pandas as pd

    total = [0] * 12
    for seed in range(300):
        frame = pd.DataFrame(
            {"doc_id": range(12), "part": 0, "source": "a", "size": [3, 50, 8, 8, 9, 10, 40, 12, 5, 6, 7, 33],
             "p": 0.3, "extra": None}
        )
        done = mixing._round(frame, seed, True)
        for i, extra in enumerate(done["extra"]):
            total[i] += extra
    assert all(0.15 < x / 300 < 0.45 for x in total)


def test_odd_rows(make_docs, odd_texts, crowded):
    docs = make_docs(odd_texts)
    rows = {row.doc_id: row for row in mix_documents(crowded(docs)).collect()}
    assert len(rows) == len(odd_texts)
    for i, text in enumerate(odd_texts):
        assert rows[i].size == len(WORD.findall(text or ""))
        assert rows[i].taken == rows[i].copies * rows[i].size
        assert rows[i].size or not rows[i].copies
    assert mix_documents(docs.limit(0)).collect() == []
    nothing = mix_documents(make_docs([None, "", " "])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in nothing] == [(0, 0, 0.0, 0)] * 3
