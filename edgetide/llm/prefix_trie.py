"""The prefix trie of conversations, measured by the Euler-tour technique.

Every conversation is rebuilt with the first turns of a base conversation, and each distinct sequence
of first turns is a node. A sequence's name is the sum of one hash for each (turn, place), so names
come from prefix sums and no conversation is ever gathered; two such sums of 64-bit hashes tell
sequences apart.

The tour goes through an enter and an exit arc of each node. Siblings stand next to each other in the
nodes' order, so an arc's successor is known from its node's row or its parent's. The linked list of
arcs is ranked by contraction: an arc whose hash is less than both neighbours' is spliced out, which
removes about a third in a round; the few that stay are walked, and the rounds are undone in reverse,
each arc's place being its holder's plus a known distance. Sums over a subtree are then differences of
prefix sums at the places of its two arcs.
"""

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgetide.llm.common import utf8_crc32, word_count
from edgetide.storage import drop_scratch, store

FAMILY = 20
MOST_HEAD = 4

# Turns, positions and conversation ids are taken together by ranges of so many.
RANGE = 4096
BLOCK = 65_536
# So many arcs are walked in one task.
FEW_ARCS = 50_000

_END = -1
_SUM = "decimal(38,0)"
_ROW_BITS = 33
NODE = ["id0", "id1"]
PARENT = ["parent0", "parent1"]


def _in_order(rows: DataFrame, order: list[Column], keep: list[str], label: str) -> DataFrame:
    """``keep`` of the rows, stored, with ``part`` and ``row``: range, and place within it, in order.

    Columns that only the order needs are moved once and not stored.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # counts rows from 0 within a partition, whose number stands above the lower 33 bits
    place = F.monotonically_increasing_id()
    stored, _ = store(ranged.select(*keep, place.alias("place")), label)
    return stored.select(
        *keep,
        F.shiftright("place", _ROW_BITS).alias("part"),
        F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("row"),
    )


def _ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, index, turn0, turn1, words): turns numbered from 0 within each conversation."""
    role, text = (F.coalesce(conversations[name], F.lit("")) for name in ("role", "text"))
    rows = conversations.select(
        conversations["conv_id"].cast("bigint").alias("conv_id"),
        conversations["turn"].alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.xxhash64(role, text).alias("turn0"),
        F.xxhash64(F.lit("second"), role, text).alias("turn1"),
        word_count(text).alias("words"),
        # equal rows may go to several ranges
        F.pmod(F.monotonically_increasing_id(), F.lit(RANGE)).alias("salt"),
    ).where("conv_id IS NOT NULL")
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text"), F.col("salt")]
    keep = ["conv_id", "turn0", "turn1", "words"]
    placed = _in_order(rows, order, keep, "turns")
    before = (
        Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranges = (
        placed.groupBy("conv_id", "part")
        .agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("held"))
        .select("conv_id", "part", "first", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    )
    index = F.col("row") - F.col("first") + F.col("before")
    return placed.join(ranges, ["conv_id", "part"]).select(*keep, index.alias("index"))


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, turn0, turn1, words) of the rebuilt conversations, and (conv_id, length)."""
    conv = F.col("conv_id")
    head = F.pmod(utf8_crc32(conv.cast("string")), F.lit(MOST_HEAD))
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    bases = sizes.select(conv.alias("base"), F.col("size").alias("base_size"))
    convs = (
        sizes.select("conv_id", "size", head.alias("head"), (conv - conv % FAMILY).alias("base"))
        .join(bases, "base", "left")
        .withColumn("taken", F.least("head", F.coalesce("base_size", F.lit(0))))
        .drop("base_size")
    )
    convs, _ = store(convs, "convs")
    content = ["turn0", "turn1", "words"]
    first = turns.where((conv % FAMILY == 0) & (F.col("index") < MOST_HEAD - 1))
    first = first.select(conv.alias("base"), "index", *content)
    heads = convs.where("taken > 0").join(first, "base").where("index < taken")
    heads = heads.select("conv_id", (F.col("index") + 1).alias("depth"), *content)
    own = turns.where(F.col("index") >= head).join(convs.select("conv_id", "taken"), "conv_id")
    own = own.select(
        "conv_id", (F.col("taken") + F.col("index") - head + 1).alias("depth"), *content
    )
    length = F.col("taken") + F.greatest(F.lit(0), F.col("size") - F.col("head"))
    return heads.unionByName(own), convs.select("conv_id", length.alias("length"))


def _named(depth: Column, sums: list[Column], names: list[str]) -> list[Column]:
    """The two hashes that name a sequence, from its depth and its two sums."""
    parts = [depth.cast("bigint"), *(x.cast(_SUM) for x in sums)]
    return [
        F.xxhash64(*parts).alias(names[0]),
        F.xxhash64(F.lit("second"), *parts).alias(names[1]),
    ]


def _root(names: list[str]) -> list[Column]:
    return _named(F.lit(0), [F.lit(0), F.lit(0)], names)


def _visits(rebuilt: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, id*, parent*, words, last): the nodes that a conversation goes through.

    Sums run over ranges of ``RANGE`` turns and then over the ranges.
    """
    hashes = ["turn0", "turn1", F.col("depth").cast("bigint")]
    rows = rebuilt.select(
        "conv_id",
        "depth",
        "words",
        F.floor((F.col("depth") - 1) / RANGE).alias("range"),
        F.xxhash64(*hashes).cast(_SUM).alias("add0"),
        F.xxhash64(F.lit("second"), *hashes).cast(_SUM).alias("add1"),
    )
    rows, _ = store(rows, "rebuilt")
    inside = Window.partitionBy("conv_id", "range").orderBy("depth")
    before = (
        Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranges = rows.groupBy("conv_id", "range").agg(
        *(F.sum(f"add{i}").cast(_SUM).alias(f"held{i}") for i in (0, 1))
    )
    ranges = ranges.select(
        "conv_id",
        "range",
        *(F.coalesce(F.sum(f"held{i}").over(before), F.lit(0)).cast(_SUM).alias(f"before{i}")
          for i in (0, 1)),
    )
    sums = [(F.col(f"before{i}") + F.col(f"inside{i}")).cast(_SUM) for i in (0, 1)]
    earlier = [(total - F.col(f"add{i}")).cast(_SUM) for i, total in enumerate(sums)]
    return (
        rows.select(
            "*", *(F.sum(f"add{i}").over(inside).cast(_SUM).alias(f"inside{i}") for i in (0, 1))
        )
        .join(ranges, ["conv_id", "range"])
        .join(lengths, "conv_id")
        .select(
            "conv_id",
            "depth",
            *_named(F.col("depth"), sums, NODE),
            *_named(F.col("depth") - 1, earlier, PARENT),
            "words",
            (F.col("depth") == F.col("length")).alias("last"),
        )
    )


def _nodes(visits: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row a node, numbered from 0, the root, so that the children of a node follow each other.

    (node, id*, parent*, conv_id, depth, n_convs, saved, first, final, n_children); ``first`` and
    ``final`` are the numbers of the first and the last child.
    """
    found = visits.groupBy(*NODE).agg(
        *(F.max(name).alias(name) for name in (*PARENT, "depth", "words")),
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
    )
    none = F.lit(None).cast("bigint")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    root = root.where("n_convs > 0").select(
        *_root(NODE),
        *(none.alias(name) for name in PARENT),
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(0).cast("bigint").alias("words"),
        "conv_id",
        "n_convs",
    )
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    every = found.unionByName(root).select(
        *NODE, *PARENT, F.col("depth").cast("bigint").alias("depth"), "conv_id", "n_convs", saved
    )
    order = [F.asc_nulls_first(name) for name in (*PARENT, *NODE)]
    placed = _in_order(every, order, every.columns, "nodes")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("held"))
    parts = parts.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    number = (F.col("row") + F.col("before")).alias("node")
    # one row for each range: as many as the session has shuffle partitions
    numbered, _ = store(
        placed.join(F.broadcast(parts), "part").select(number, *every.columns), "numbered"
    )
    children = numbered.where("depth > 0").groupBy(*PARENT).agg(
        F.min("node").alias("first"),
        F.max("node").alias("final"),
        F.count(F.lit(1)).alias("n_children"),
    )
    children = children.select(
        *(F.col(a).alias(b) for a, b in zip(PARENT, NODE, strict=True)),
        "first", "final", "n_children",
    )
    return store(numbered.join(children, NODE, "left"), "tree")[0]


def euler_tour(nodes: DataFrame) -> DataFrame:
    """(arc, next): a node v is entered by arc 2v and left by arc 2v + 1; -1 follows the last arc.

    ``nodes`` has node, first and final as ``_nodes`` gives them.
    """
    node = F.col("node")

    def arc(of: Column, then: Column, rank: int, given: Column = F.lit(True)) -> Column:
        return F.struct(of.alias("arc"), F.lit(rank).alias("rank"), then.cast("bigint").alias("next"),
                        given.alias("given"))

    inner = F.col("first").isNotNull()
    said = F.array(
        arc(2 * node, F.coalesce(2 * F.col("first"), 2 * node + 1), 0),
        # the next sibling, unless the parent says that there is none
        arc(2 * node + 1, 2 * (node + 1), 0),
        arc(2 * F.col("final") + 1, 2 * node + 1, 1, inner),
        arc(F.lit(1).cast("bigint"), F.lit(_END), 1, node == 0),
    )
    arcs = nodes.select(F.inline(F.filter(said, lambda x: x["given"])))
    return arcs.groupBy("arc").agg(F.max_by("next", "rank").alias("next"))


def _priority(arc: Column, salt: int) -> Column:
    """A hash of the arc; the first arc and the end are never less than a neighbour."""
    kept = (arc == 0) | (arc == _END)
    return F.when(kept, F.lit(2**63 - 1)).otherwise(F.xxhash64(F.lit(salt), arc))


def _contracted(links: DataFrame, salt: int) -> DataFrame:
    """One round: (arc, next, jump) that stay, and (arc, holder, jump) of those spliced out.

    An arc is spliced out when its priority is less than both neighbours'; the one before it is its
    holder, takes its successor and adds its distance.
    """
    mine, then = _priority(F.col("arc"), salt), _priority(F.col("next"), salt)
    low = links.where(mine < then)
    high = links.where(~(mine < then)).select(
        F.col("next").alias("held"), F.col("arc").alias("holder"), F.col("jump").alias("ahead")
    )
    none = F.lit(None).cast("bigint")

    def row(arc, follows, jump, holder=none, given=F.lit(True)):
        return F.struct(arc.alias("arc"), follows.alias("next"), jump.alias("jump"),
                        holder.alias("holder"), given.alias("given"))

    met = F.col("arc").isNotNull() & F.col("holder").isNotNull()
    column = F.col
    said = F.array(
        row(column("holder"), column("next"), column("ahead") + column("jump"), given=met),
        row(column("arc"), none, column("ahead"), column("holder"), met),
        row(column("arc"), column("next"), column("jump"), given=column("holder").isNull()),
        row(column("holder"), column("held"), column("ahead"), given=column("arc").isNull()),
    )
    joined = low.join(high, F.col("arc") == F.col("held"), "full")
    return joined.select(F.inline(F.filter(said, lambda x: x["given"]))).drop("given")


def _walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(arc, position) of a whole short list of (arc, next, jump) that starts with arc 0."""
    links = pd.concat(list(batches), ignore_index=True)
    follows = dict(zip(links["arc"], zip(links["next"], links["jump"], strict=True), strict=True))
    arcs, positions, arc, position = [], [], 0, 0
    while arc in follows:
        arcs.append(arc)
        positions.append(position)
        arc, jump = follows[arc]
        position += jump
    yield pd.DataFrame({"arc": arcs, "position": positions}, dtype="int64")


def list_ranks(tour: DataFrame, few: int = FEW_ARCS) -> DataFrame:
    """(arc, position) for a linked list (arc, next) that starts with arc 0 and ends with next -1.

    At most ``few`` arcs are left to one task, however long the list is; a round removes about a third
    and is a stored table, so the driver sees counts only.
    """
    spark = tour.sparkSession
    links, path = store(tour.select("arc", "next", F.lit(1).cast("bigint").alias("jump")), "tour")
    count, rounds = links.count(), []
    while count > few:
        table, path = store(_contracted(links, len(rounds)), "round")
        rounds.append((table, path))
        links = table.where("holder IS NULL").drop("holder")
        count = links.count()
    if not count:
        return links.select("arc", F.col("jump").alias("position"))
    walked = links.repartition(1).mapInPandas(_walked, "arc bigint, position bigint")
    known, path = store(walked, "positions")
    for table, used in reversed(rounds):
        holder = known.select(F.col("arc").alias("holder"), "position")
        gone = table.where("holder IS NOT NULL").join(holder, "holder")
        gone = gone.select("arc", (F.col("position") + F.col("jump")).alias("position"))
        old = path
        known, path = store(known.unionByName(gone), "positions")
        drop_scratch(spark, old)
        drop_scratch(spark, used)
    return known


def prefix_sums(values: DataFrame, columns: list[str], rows: int, block: int = BLOCK) -> DataFrame:
    """``values`` (position 0 to rows - 1, and columns) with each column summed up to its position.

    Blocks of ``block`` positions are summed alike, in as many levels as it takes, so no task sees
    more than a block.
    """
    blocked = values.withColumn("_block", F.floor(F.col("position") / block))
    inside = Window.partitionBy("_block").orderBy("position")
    summed = blocked.select(
        *(name for name in blocked.columns if name not in columns),
        *(F.sum(name).over(inside).cast("bigint").alias(name) for name in columns),
    )
    if rows <= block:
        return summed.drop("_block")
    totals = blocked.groupBy(F.col("_block").alias("position")).agg(
        *(F.sum(name).cast("bigint").alias(name) for name in columns)
    )
    upto = prefix_sums(totals, columns, -(-rows // block), block)
    before = upto.select(
        (F.col("position") + 1).alias("_block"), *(F.col(x).alias(f"_{x}") for x in columns)
    )
    return summed.join(before, "_block", "left").select(
        *(name for name in values.columns if name not in columns),
        *((F.col(x) + F.coalesce(F.col(f"_{x}"), F.lit(0))).alias(x) for x in columns),
    )


def _subtrees(nodes: DataFrame, few: int, block: int) -> DataFrame:
    """(node, n_leaves, saved_tokens): sums over each node's subtree, itself included."""
    positions = list_ranks(euler_tour(nodes), few)
    entered = nodes.select(
        (2 * F.col("node")).alias("arc"),
        F.col("first").isNull().cast("bigint").alias("leaf"),
        "saved",
    )
    values = positions.join(entered, "arc", "left").na.fill(0, ["leaf", "saved"])
    values, _ = store(values, "values")
    sums = prefix_sums(values, ["leaf", "saved"], values.count(), block)
    # what a node adds on being entered belongs to its own subtree
    own = values.select("arc", F.col("leaf").alias("own_leaf"), F.col("saved").alias("own_saved"))
    signed = sums.join(own, "arc")

    def between(total: str, own: str) -> Column:
        enter = F.col(own) - F.col(total)
        return F.sum(F.when(F.col("arc") % 2 == 0, enter).otherwise(F.col(total))).cast("bigint")

    return signed.groupBy(F.floor(F.col("arc") / 2).alias("node")).agg(
        between("leaf", "own_leaf").alias("n_leaves"),
        between("saved", "own_saved").alias("saved_tokens"),
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id0, id1, listed) in order -> (id0, id1, digest); one running digest at a time."""
    node, digest = None, None
    for batch in batches:
        done = []
        for id0, id1, listed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (id0, id1) != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (id0, id1), hashlib.sha256(listed.encode())
            else:
                digest.update(f",{listed}".encode())
        yield _digest_rows(done)
    if node is not None:
        yield _digest_rows([(*node, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("id0", pa.int64()), ("id1", pa.int64()), ("ends_sha256", pa.string())]
    columns = list(zip(*rows, strict=True)) or [()] * 3
    arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in kinds])


def _ends(visits: DataFrame, lengths: DataFrame) -> DataFrame:
    """(id*, ends_sha256): digest of the ids of the conversations that end at a node.

    Ids are joined by ranges first; a node's ranges then pass through one digest in order, which keeps
    none of them.
    """
    turnless = lengths.where("length = 0").select(*_root(NODE), "conv_id")
    ends = visits.where("last").select(*NODE, "conv_id").unionByName(turnless)
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))
    ranges = ends.groupBy(*NODE, F.floor(F.col("conv_id") / RANGE).alias("range")).agg(
        F.array_join(ids, ",").alias("listed")
    )
    ordered = ranges.repartition(*NODE).sortWithinPartitions(*NODE, "range")
    schema = "id0 bigint, id1 bigint, ends_sha256 string"
    return ordered.select(*NODE, "listed").mapInArrow(_digests, schema)


def conversation_trie(
    conversations: DataFrame, few: int = FEW_ARCS, block: int = BLOCK
) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations (conv_id, turn, role, text).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the
    smallest conversation through the node, its depth, its parent's ``conv_id`` (null for the root),
    the number of conversations through it, of children and of childless nodes in its subtree, the
    words that sharing saves in its subtree, and the digest of the ids that end there.

    Turns go by ``turn``, null first; ties by role, then text; equal rows are separate turns. A null
    role or text is empty, rows without conv_id belong to no conversation, remainders of negative ids
    are taken towards zero. Texts of any length are read whole; other columns are ignored. An empty
    table has no root and gives no rows.
    """
    turns, _ = store(_ordered_turns(conversations), "ordered")
    rebuilt, lengths = _rebuilt(turns)
    visits, _ = store(_visits(rebuilt, lengths), "visits")
    nodes = _nodes(visits, lengths)
    above = nodes.select(
        *(F.col(a).alias(b) for a, b in zip(NODE, PARENT, strict=True)),
        F.col("conv_id").alias("parent_conv_id"),
    )
    none = F.sha2(F.lit(""), 256)
    return (
        nodes.join(_subtrees(nodes, few, block), "node")
        .join(above, PARENT, "left")
        .join(_ends(visits, lengths), NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
