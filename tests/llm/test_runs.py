import hashlib
import random
import zlib

import numpy as np
import pytest

from edgetide.llm import runs as module
from edgetide.llm.runs import Catchers, described, periodic_runs, rewritten


def brute(words, least=12):
    """Every (start, length, period), by comparing each word with the one a period before."""
    n, found = len(words), []
    for period in range(1, n // 2 + 1):
        i = 0
        while i + period < n:
            if words[i] != words[i + period]:
                i += 1
                continue
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            length = j + period - i
            if length >= max(least, 2 * period):
                stretch = words[i : i + length]
                smaller = any(
                    stretch[q:] == stretch[:-q] for q in range(1, period)
                )
                if not smaller:
                    found.append((i, length, period))
            i = j
    return sorted(found, key=lambda run: (run[0], run[2]))


def caught(words, pieces=None, least=12):
    catchers = Catchers(least)
    cuts = pieces or [len(words)]
    at = 0
    for size in cuts:
        catchers.append(np.array(words[at : at + size], np.int64))
        at += size
    return [tuple(int(x) for x in row) for row in catchers.runs()]


def texts():
    rng = random.Random(5)
    for _ in range(150):
        letters = rng.choice((1, 2, 2, 3, 5))
        parts = []
        for _ in range(rng.randint(1, 6)):
            unit = [rng.randrange(letters) for _ in range(rng.randint(1, 25))]
            parts += unit * rng.choice((1, 1, 2, 3, 7)) + unit[: rng.randint(0, len(unit))]
        yield parts
    a, b = [0], [0, 1]
    while len(b) < 300:  # Fibonacci words are rich in runs
        a, b = b, b + a
    yield b
    yield [0] * 500
    yield [0, 1, 0, 2] * 60 + [0, 1] * 40
    yield []
    yield [1]
    yield list(range(50))


@pytest.mark.parametrize("least", [12, 2])
def test_runs_equal_brute_force(least):
    for words in texts():
        if len(words) < 400 or least == 12:
            assert caught(words, least=least) == brute(words, least), words


def test_runs_do_not_depend_on_how_words_arrive():
    rng = random.Random(8)
    for words in list(texts())[::4]:
        whole = caught(words)
        pieces, left = [], len(words)
        while left:
            pieces.append(min(left, rng.choice((1, 1, 2, 5, 40))))
            left -= pieces[-1]
        assert caught(words, pieces or [0]) == whole
        if len(words) < 120:
            assert caught(words, [1] * len(words) or [0]) == whole


def test_agreeing_hashes_neither_add_nor_hide_runs(monkeypatch):
    mixed = module._mixed
    monkeypatch.setattr(module, "_mixed", lambda values: mixed(values) % np.uint64(7))
    for words in list(texts())[::5]:
        assert caught(words) == brute(words), words


def expected(doc_id, text):
    words = (text or "").encode().split()
    code = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if doc_id is not None and code % 10 == 0 and n:
        g = code // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words) if n < 3000 else fast(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = b" ".join(word for i, word in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    best = min(found, key=lambda run: (-run[1], run[0], run[2]), default=None)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *longest, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def fast(words):
    """The same as ``brute`` for long texts."""
    numbers = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words])
    found = []
    for q in range(1, len(ids) // 2 + 1):
        edges = np.flatnonzero(np.diff(np.r_[False, ids[:-q] == ids[q:], False].astype(int)))
        for i, j in zip(edges[::2], edges[1::2]):
            if j + q - i < max(12, 2 * q):
                continue
            if not any(s <= i and j + q <= s + n for s, n, p in found if p < q):
                found.append((int(i), int(j + q - i), q))
    return sorted(found, key=lambda run: (run[0], run[2]))


@pytest.mark.parametrize("at_once", [200_000, 50])
def test_documents_equal_brute_force(make_docs, odd_texts, crowded, at_once):
    rng = random.Random(2)
    more = [" ".join(rng.choices("ab", k=rng.randint(0, 60))) for _ in range(120)]
    long = [f"w{i % 977}" if i % 5000 > 20 else "x" for i in range(12_000)]
    given = [*odd_texts, *more, " ".join(long), "a b\x0bc\x1cd\xa0e " * 9, " a " * 12, " a " * 11]
    ids = [None, 3, 3, *range(10, 7 + len(given))]
    rows = periodic_runs(crowded(make_docs(given, ids=ids).drop("start")), at_once).collect()
    got = sorted((tuple(row) for row in rows), key=repr)
    assert got == sorted((expected(i, t) for i, t in zip(ids, given)), key=repr)
    assert sum(row.n_runs for row in rows) > 50
    assert any(rewritten(20, i) is not None for i in ids)


def test_no_rows(make_docs):
    assert periodic_runs(make_docs(["a"]).limit(0)).collect() == []
    assert list(described([])) == []
