"""Rank tables kept after some rounds, so that a later job goes on from them.

    <folder>/damping=<d>/round=<k>   (node*, pagerank), with the short keys of the graph's layout

The folder belongs to one graph; its name holds the graph's fingerprint. A round counts once its
table is completely written, so the folders are the manifest.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from edgetide.storage import numbered


@dataclass(frozen=True)
class Rounds:
    """The kept rounds of one graph and damping."""

    spark: SparkSession
    folder: str
    damping: float

    @property
    def _path(self) -> str:
        return f"{self.folder}/damping={float(self.damping)!r}"

    def kept(self) -> list[int]:
        return numbered(self.spark, self._path, "round")

    def last(self, upto: int) -> int | None:
        """The furthest kept round that is at most ``upto``."""
        return max((k for k in self.kept() if k <= upto), default=None)

    def read(self, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self._path}/round={number}")

    def keep(self, ranks: DataFrame, number: int) -> DataFrame:
        """Write the ranks after round ``number``; returns them read back."""
        ranks.write.mode("overwrite").parquet(f"{self._path}/round={number}")
        return self.spark.read.schema(ranks.schema).parquet(f"{self._path}/round={number}")
