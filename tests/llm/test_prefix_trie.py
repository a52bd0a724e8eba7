import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from edgetide.llm.prefix_trie import conversation_trie, euler_tour, list_ranks, prefix_sums

SCHEMA = "conv_id bigint, turn int, role string, text string"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [x[2:] for x in sorted(turns)] for conv, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - int(conv / 20) * 20 if conv < 0 else conv % 20
        out[conv] = own.get(conv - base, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members, ends = {}, {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(conv)
        ends.setdefault(tuple(turns), []).append(conv)
    words = lambda node: len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
    saves = {node: (len(of) - 1) * words(node) for node, of in members.items()}
    children, leaves, saved = {}, {}, dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node in members:
        for d in range(len(node) + 1):
            saved[node[:d]] += saves[node]
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
    return sorted(
        (
            (min(of), len(node), min(members[node[:-1]]) if node else None, len(of),
             children.get(node, 0), leaves[node], saved[node],
             hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
            for node, of in members.items()
        ),
        key=repr,
    )


def table(seed):
    rng = random.Random(seed)
    rows = []
    say = lambda: rng.choice(["hi", "go on please", "a b\tc\x0bd", "", None, "é\xa0x y", "sure"])
    for conv in [*range(-45, 130), 10**15, 10**15 + 1]:
        if conv % 20 == 0 and conv % 3 == 0:
            continue  # a base that does not exist
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, rng.choice((turn, turn, turn, None, 2)), rng.choice(("user", "bot", None)), say()))
    rows += rows[:40]
    rows += [(None, 1, "user", "x"), (None, None, None, None)]
    rows += [(77, i % 50, "user", f"same {i % 3}") for i in range(300)]
    for conv in range(200, 260):  # a group of copies
        rows += [(conv, 0, "system", "be kind"), (conv, 1, "user", "hello there"), (conv, 2, "bot", "hi"),
                 (conv, 3, "user", "bye now")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,few,block", [(1, 50_000, 65_536), (2, 40, 16)])
def test_equals_brute_force(spark, crowded, seed, few, block):
    rows = table(seed)
    given = crowded(spark.createDataFrame(rows, SCHEMA))
    got = conversation_trie(given, few, block).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_sums_of_a_long_conversation_are_cut_into_ranges(spark, monkeypatch):
    from edgetide.llm import prefix_trie

    monkeypatch.setattr(prefix_trie, "RANGE", 8)
    rows = table(3)
    got = conversation_trie(spark.createDataFrame(rows, SCHEMA), 100, 32).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_empty_and_nulls_only(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, 1, "user", "x")]
    assert conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_conversations_without_turns_are_members_of_the_root(spark):
    # 1 drops more turns than it has, and its base does not exist
    rows = [(c, 0, "user", "x") for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4]
    got = conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(row) for row in got] == brute(rows) and got[0].n_convs == len(rows)


@pytest.mark.parametrize("few", [1, 7, 5000])
def test_list_ranks(spark, few):
    rng = random.Random(few)
    order = [0, *rng.sample(range(1, 900), 899)]
    links = list(zip(order, [*order[1:], -1]))
    rng.shuffle(links)
    got = list_ranks(spark.createDataFrame(links, "arc bigint, next bigint"), few).collect()
    assert [row.arc for row in sorted(got, key=lambda row: row.position)] == order
    assert sorted(row.position for row in got) == list(range(900))


def test_tour_of_a_path_and_a_star(spark):
    # 0 -> 1, 2, 3; 2 -> 4; children follow each other
    nodes = [(0, 1, 3), (1, None, None), (2, 4, 4), (3, None, None), (4, None, None)]
    frame = spark.createDataFrame(nodes, "node bigint, first bigint, final bigint")
    follows = {row.arc: row.next for row in euler_tour(frame).collect()}
    arc, seen = 0, []
    while arc != -1:
        seen.append(arc)
        arc = follows[arc]
    assert seen == [0, 2, 3, 4, 8, 9, 5, 6, 7, 1]


def test_prefix_sums_in_levels(spark):
    values = spark.range(1000).select(F.col("id").alias("position"), (F.col("id") % 7).alias("x"))
    got = {row.position: row.x for row in prefix_sums(values, ["x"], 1000, 6).collect()}
    total = 0
    for i in range(1000):
        total += i % 7
        assert got[i] == total
