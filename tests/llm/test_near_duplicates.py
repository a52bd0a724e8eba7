"""Components, near-duplicate texts and near-duplicate vectors against brute force."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from edgetide.llm import embeddings, minhash
from edgetide.llm.common import BATCH_BYTES
from edgetide.llm.components import components
from edgetide.llm.embeddings import near_duplicate_vectors
from edgetide.llm.minhash import near_duplicates


def united(nodes, edges):
    """node -> smallest reachable node."""
    parent = {node: node for node in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 900 + i) for i in range(300)]
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    edges += edges[:20] + [(5, 5)]
    rng.shuffle(edges)
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    proper = [edge for edge in edges if edge[0] != edge[1]]
    expected = united({x for edge in proper for x in edge}, proper)
    assert {row.node: row.root for row in found} == expected and len(found) == len(expected)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(texts, size, percent):
    sets = {i: shingles(text, size) for i, text in texts.items()}
    ids, edges = sorted(sets), []
    for at, a in enumerate(ids):
        for b in ids[:at]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * len(sets[a] | sets[b]):
                edges.append((a, b))
    roots = united(ids, edges)
    return sorted((i, len(sets[i]), roots[i], roots[i] == i) for i in ids)


def corpus(seed):
    """Copies, near copies at all distances, a passage half of all share, and unrelated texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]

    def prose(n):
        return rng.choices(vocabulary, k=n)

    passage = prose(60)
    texts = []
    for _ in range(60):
        texts.append(prose(rng.randint(1, 60)) + passage + prose(rng.randint(1, 60)))
    for group in range(12):
        base = prose(rng.choice([4, 12, 40, 90, 400]))
        for _ in range(rng.randint(2, 9)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 40))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(own + (passage if group % 4 == 0 else []))
    base = prose(150)  # a large group whose members are not all linked with each other
    for _ in range(70):
        own = list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        texts.append(own)
    texts += texts[:25] + [base] * 40
    rng.shuffle(texts)
    return [" ".join(text) for text in texts]


@pytest.mark.parametrize("seed,words,percent", [(1, 3, 85), (2, 5, 80)])
def test_texts_equal_brute_force(make_docs, crowded, seed, words, percent):
    texts = dict(enumerate(corpus(seed)))
    docs = make_docs(list(texts.values()), ids=list(texts))
    found = near_duplicates(crowded(docs), words, percent).collect()
    assert sorted(map(tuple, found)) == brute(texts, words, percent)


def spread_group(seed, size, length):
    """One group whose members share from a few to nearly all words with each other."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = rng.choices(vocabulary, k=length)
    texts = []
    for _ in range(size):
        own = list(base)
        for _ in range(int(length * rng.choice((0.005, 0.02, 0.04, 0.06, 0.1)))):
            own[rng.randrange(length)] = rng.choice(vocabulary)
        texts.append(" ".join(own))
        if rng.random() < 0.1:  # a pair far from the centre
            own[rng.randrange(length)] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("size,length", [(800, 150), (150, 700)])
def test_a_group_of_all_similarities_loses_no_link(make_docs, monkeypatch, size, length):
    made, usual = [], minhash.Search._cross_pairs

    def counted(self, lists, texts):
        pairs = usual(self, lists, texts)
        made.append((pairs.count(), lists.select("id").distinct().count()))
        return pairs

    monkeypatch.setattr(minhash.Search, "_cross_pairs", counted)
    texts = dict(enumerate(spread_group(4, size, length)))
    docs = make_docs(list(texts.values()), ids=list(texts))
    found = near_duplicates(docs).collect()
    assert sorted(map(tuple, found)) == brute(texts, 3, 85)
    pairs, members = made[0]
    # sets that the long sketches hold whole are told apart better
    assert members > size / 2 and pairs < members**2 / (20 if length < minhash.WIDE else 10)


def test_odd_texts(make_docs, odd_texts):
    texts = dict(enumerate(odd_texts))
    found = near_duplicates(make_docs(odd_texts)).collect()
    assert sorted(map(tuple, found)) == brute(texts, 3, 85)
    assert near_duplicates(make_docs(odd_texts).limit(0)).collect() == []


def test_repeated_and_null_ids(make_docs):
    docs = make_docs(["a b c d", "a b c d", "x y z", "a b c d", None], ids=[5, 5, 5, None, None])
    rows = sorted(map(tuple, near_duplicates(docs).collect()), key=repr)
    assert rows == sorted(
        [(5, 2, 5, True), (5, 2, 5, True), (5, 1, 5, True), (None, 2, 5, False), (None, 0, None, True)],
        key=repr,
    )


def test_forgetting_words_changes_nothing(monkeypatch):
    text = " ".join(f"w{i % 50}" for i in range(500))
    usual = minhash.Shingles(3)(text)
    monkeypatch.setattr(minhash, "REMEMBERED", 3)
    again = minhash.Shingles(3)
    assert (again("some other words here") >= 0).all()
    assert np.array_equal(again(text), usual)


def vectors(seed):
    """Unrelated vectors, groups of near copies around a cosine of 0.95, exact and scaled copies."""
    rng = np.random.default_rng(seed)
    found = [rng.normal(size=24) for _ in range(250)]
    for spread in (0.02, 0.05, 0.1, 0.15):
        for _ in range(4):
            base = rng.normal(size=24)
            found += [base + spread * rng.normal(size=24) for _ in range(12)]
    found += [found[0]] * 30 + [found[1] * 3.0, found[2] * -1.0]
    return [x.astype(np.float32).tolist() for x in found]


ODD = [None, [], [0.0] * 24, [float("nan")] * 24, [None] + [1.0] * 23, [float("inf")] + [0.0] * 23,
       [1.0, 2.0], [2.0, 4.0], [1e-30] * 24, [1e30] * 24]


def cosines(values):
    def usable(x):
        return bool(x) and None not in x and np.isfinite(x).all() and any(x)

    keep = [i for i, x in enumerate(values) if usable(x)]
    edges = []
    for at, i in enumerate(keep):
        for j in keep[:at]:
            if len(values[i]) == len(values[j]):
                a, b = (np.array(values[k]) / np.abs(values[k]).max() for k in (i, j))
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                    edges.append((i, j))
    return edges


@pytest.mark.parametrize("block", [1024, 7])
def test_vectors_equal_brute_force(spark, crowded, block):
    values = vectors(4) + ODD
    rows = list(enumerate(values))
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = near_duplicate_vectors(crowded(table), block=block).collect()
    edges = cosines(values)
    roots = united(range(len(values)), edges)
    links = [0] * len(values)
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    got = {row.vec_id: row for row in found}
    assert len(found) == len(values) == len(got)
    assert all(got[i].n_links <= links[i] for i in got)
    assert sum(row.n_links for row in found) >= 0.97 * sum(links)  # the index's recall
    assert sum(got[i].component_id == roots[i] for i in got) >= 0.99 * len(got)
    assert all(row.kept == (row.vec_id == row.component_id) for row in found)
    assert all(got[len(values) - len(ODD) + i].n_links == 0 for i in range(6))


def test_vectors_of_check_size_are_found(spark, sf001):
    """Whole table against brute force in blocks; links there are well above the limit."""
    table = spark.read.parquet(f"{sf001}/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    matrix = np.array([row.embedding for row in rows], float)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    links = ((matrix @ matrix.T) >= 0.95).sum(1) - 1
    found = {row.vec_id: row.n_links for row in near_duplicate_vectors(table).collect()}
    assert [found[row.vec_id] for row in rows] == links.tolist()


def test_vectors_with_repeated_ids_and_none(spark):
    schema = "vec_id bigint, embedding array<float>"
    table = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.1])], schema)
    rows = near_duplicate_vectors(table).collect()
    assert sorted(row.n_links for row in rows) == [2, 2, 2]
    assert {row.component_id for row in rows} == {1}
    assert near_duplicate_vectors(table.limit(0)).collect() == []
    assert embeddings.FEWEST <= embeddings.MOST


def test_pivots_are_ordered_by_distance_and_the_order_counts(spark):
    rng = np.random.default_rng(7)
    pivots, vectors = (embeddings._unit(rng.normal(size=(n, 8))) for n in (40, 5))
    batch = pa.RecordBatch.from_pydict(
        {"id": range(5), "copies": [1] * 5, "vec": [x.tobytes() for x in vectors]}
    )
    (found,) = embeddings._nearest([batch], {64: pivots}, 16)
    expected = np.argsort(-(vectors @ pivots.T), axis=1)[:, :16]
    assert found.column("near").to_pylist() == expected.tolist()

    side = pd.DataFrame(
        {
            "pivot": 0, "block": 0, "low": 0, "high": 0, "id": [1, 2], "copies": 1,
            "vec": [vectors[0].tobytes()] * 2,
            "near": [np.arange(4, dtype=np.int32).tobytes()] * 2,
            "places": [np.array(x, np.int32).tobytes() for x in ([0, 1, 2, 3], [3, 1, 2, 0])],
        }
    )
    # all four pivots are shared when places may differ by three, two of them when not
    assert len(embeddings._compare(side, 4, 3, 0.95)) == 2
    assert len(embeddings._compare(side, 4, 2, 0.95)) == 0
    assert len(embeddings._compare(side, 2, 2, 0.95)) == 2


def test_a_clump_of_a_third_of_the_vectors_keeps_its_links(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=64)
    clump = base / np.linalg.norm(base) + rng.normal(size=(4000, 64)) * np.sqrt((1 / 0.96 - 1) / 64)
    matrix = np.concatenate([clump, rng.normal(size=(8000, 64))])[rng.permutation(12_000)]
    table = spark.createDataFrame(
        [(i, row.tolist()) for i, row in enumerate(matrix)], "vec_id bigint, embedding array<double>"
    )
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    links = int(((matrix @ matrix.T) >= 0.95).sum()) - len(matrix)
    found = near_duplicate_vectors(table).collect()
    assert sum(row.n_links for row in found) >= 0.95 * links
    assert sum(not row.kept for row in found) >= 3999


def test_thinned_pivots_lie_apart_and_cover_the_sample():
    rng = np.random.default_rng(6)
    sample = np.concatenate([1 + 0.1 * rng.normal(size=(900, 8)), rng.normal(size=(900, 8))])
    sample = (sample / np.linalg.norm(sample, axis=1, keepdims=True))[rng.permutation(1800)]
    pivots = embeddings._thinned(sample, 0.9)
    near = pivots @ pivots.T - 2 * np.eye(len(pivots))
    assert near.max() < 0.9 and (sample @ pivots.T).max(1).min() >= 0.9


def test_texts_reach_python_in_small_batches(spark, make_docs, tmp_path, monkeypatch):
    rng = random.Random(7)
    base = [f"{rng.getrandbits(40):010x}" for _ in range(12_000)]
    texts = [" ".join([*base, f"own{i}", f"more{i}"]) for i in range(120)]
    confirm, folder = minhash._confirm, str(tmp_path)

    def noted(batches, words, percent):
        def seen():
            for number, batch in enumerate(batches):
                with open(f"{folder}/{id(batches)}-{number}", "w") as file:
                    file.write(str(batch.nbytes))
                yield batch

        return confirm(seen(), words, percent)

    monkeypatch.setattr(minhash, "_confirm", noted)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    found = near_duplicates(make_docs(texts))
    assert spark.conf.get(name) == before
    assert {row.component_id for row in found.collect()} == {0}
    sizes = [int(path.read_text()) for path in tmp_path.iterdir()]
    assert sum(sizes) > 4 * BATCH_BYTES  # pairs of 260 KB
    assert max(sizes) < BATCH_BYTES + (1 << 20)
