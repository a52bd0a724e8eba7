"""Rank an edge file: ``spark-submit edgetide/__main__.py EDGES OUT [options]``."""

import argparse

from pyspark.sql import SparkSession

from edgetide.plans.job import run_job
from edgetide.schema import DAMPING, ITERATIONS
from edgetide.sources.edges import read_edges
from edgetide.sources.results import read_results


def main() -> None:
    parser = argparse.ArgumentParser(prog="edgetide", description="Rank the nodes of a graph.")
    parser.add_argument("edges", help="edge file or folder, any Hadoop path")
    parser.add_argument("out", help="folder for the results; each run adds a version")
    parser.add_argument("--iterations", type=int, default=ITERATIONS)
    parser.add_argument("--damping", type=float, default=DAMPING)
    parser.add_argument("--format", choices=["tab", "blank", "csv"], default="tab")
    parser.add_argument("--on-malformed", choices=["fail", "drop"], default="fail")
    parser.add_argument("--name", help="dataset name in the metadata (default: last path part)")
    arguments = parser.parse_args()

    spark = SparkSession.builder.appName("edgetide").getOrCreate()
    edges = read_edges(spark, arguments.edges, arguments.format, arguments.on_malformed)
    name = arguments.name or arguments.edges.rstrip("/").rsplit("/", 1)[-1]
    version = run_job(edges, arguments.out, name, arguments.iterations, arguments.damping)
    read_results(spark, arguments.out, version).top.orderBy("rank").show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
