"""Short node keys.

The rounds join and shuffle by node many times, and ids may be long texts. They run on 64-bit
hashes of the ids instead, or on pairs of them where one hash is not unique over the graph's
nodes, or on the ids themselves should pairs clash as well. Which of these holds is counted, so
results never depend on luck.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _hashes(node: Column) -> list[Column]:
    return [F.xxhash64(node), F.xxhash64(F.lit("second"), node)]


@dataclass(frozen=True)
class Keys:
    """The key columns in use: one hash, two hashes, or (0) the id."""

    hashes: int

    def names(self, prefix: str) -> list[str]:
        return [f"{prefix}{i}" for i in range(max(self.hashes, 1))]

    def of(self, node: str, prefix: str) -> list[Column]:
        columns = _hashes(F.col(node))[: self.hashes] or [F.col(node)]
        return [
            column.alias(name)
            for column, name in zip(columns, self.names(prefix), strict=True)
        ]


def shortest_keys(nodes: DataFrame) -> Keys:
    """The shortest keys that tell all ids of a stored, distinct node table apart."""
    for hashes in (1, 2):
        keys = Keys(hashes)
        found = nodes.select(*keys.of("nodeId", "key")).agg(
            F.count(F.lit(1)).alias("ids"),
            F.count_distinct(*keys.names("key")).alias("keys"),
        )
        if found.where("ids = keys").count():
            return keys
    return Keys(0)
