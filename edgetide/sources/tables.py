"""Link graphs inside the test tables, as edges (src, dst) or counted ones (src, dst, copies)."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgetide.operators.skew import ROWS_PER_SLICE, find_hot, join_unique
from edgetide.storage import checkpoint


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _edge(src, dst, copies=None) -> list:
    ends = [src.cast("string").alias("src"), dst.cast("string").alias("dst")]
    return ends if copies is None else [*ends, copies.cast("bigint").alias("copies")]


def _next_in_large_orders(lines: DataFrame) -> DataFrame:
    """Successor edges of orders too large for one window group.

    Equal (line number, part) rows are merged first: they follow one another, so c of them are
    c-1 links of the part to itself. What is left is sorted by ranges, which cut a large order
    over many partitions. Successors are found within a range; the last row of a range takes
    the first part of the order's next range.
    """
    at = ["l_linenumber", "l_partkey"]
    merged = lines.groupBy("l_orderkey", *at).agg(F.count(F.lit(1)).alias("copies"))
    ranged = checkpoint(
        merged.repartitionByRange("l_orderkey", *at).withColumn("chunk", F.spark_partition_id())
    )
    inside = Window.partitionBy("l_orderkey", "chunk").orderBy(*at)
    follow = ranged.withColumn("next", F.lead("l_partkey").over(inside))
    chunks = Window.partitionBy("l_orderkey").orderBy("chunk")
    firsts = (
        ranged.groupBy("l_orderkey", "chunk")
        .agg(F.min(F.struct(*at)).alias("first"))
        .select("l_orderkey", "chunk", F.lead("first.l_partkey").over(chunks).alias("next"))
    )
    part, following = F.col("l_partkey"), F.col("next")
    within = follow.where(following.isNotNull()).select(*_edge(part, following, F.lit(1)))
    across = (
        follow.where(following.isNull())
        .drop("next")
        .join(firsts.where(following.isNotNull()), ["l_orderkey", "chunk"])
        .select(*_edge(part, following, F.lit(1)))
    )
    repeats = ranged.where("copies > 1").select(*_edge(part, part, F.col("copies") - 1))
    return within.unionByName(across).unionByName(repeats)


def part_next(
    spark: SparkSession, sf_dir: str, rows_per_order: int = ROWS_PER_SLICE
) -> DataFrame:
    """Each part to the part on the next line of the same order.

    Rows equal in line number and part have the same successors in any order, so these two
    columns are the whole sort key.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    hot = _heavy(lines, "l_orderkey", rows_per_order)
    within = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    usual = lines
    if hot is not None:
        large = F.broadcast(hot.select("l_orderkey"))
        usual = lines.join(large, "l_orderkey", "left_anti")
    edges = (
        usual.withColumn("next", F.lead("l_partkey").over(within))
        .where(F.col("next").isNotNull())
        .select(*_edge(F.col("l_partkey"), F.col("next"), F.lit(1)))
    )
    if hot is not None:
        cut = _next_in_large_orders(lines.join(large, "l_orderkey", "left_semi"))
        edges = edges.unionByName(cut)
    return edges


def part_supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part to its supplier, both in one id space."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(*_edge(F.col("l_partkey"), F.col("l_suppkey")))


def nation_trade(
    spark: SparkSession, sf_dir: str, rows_per_key: int = ROWS_PER_SLICE
) -> DataFrame:
    """Customer's nation to supplier's nation, one link per line sold.

    Lines are counted per (order, selling nation) and then per (customer, selling nation), so
    that an order or a customer brings at most one row per nation into the next join.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    sellers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("seller")
    )
    sold = join_unique(lines, sellers, "l_suppkey", _heavy(lines, "l_suppkey", rows_per_key))
    per_order = sold.groupBy("l_orderkey", "seller").agg(F.count(F.lit(1)).alias("copies"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")
    )
    per_customer = (
        per_order.join(orders, "l_orderkey")
        .groupBy("c_custkey", "seller")
        .agg(F.sum("copies").alias("copies"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        per_customer.join(customers, "c_custkey")
        .groupBy("c_nationkey", "seller")
        .agg(F.sum("copies").alias("copies"))
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    buyer, seller = nations.alias("buyer"), nations.alias("seller_nation")
    named = per_nation.join(buyer, F.col("c_nationkey") == F.col("buyer.n_nationkey")).join(
        seller, F.col("seller") == F.col("seller_nation.n_nationkey")
    )
    return named.select(
        *_edge(F.col("buyer.n_name"), F.col("seller_nation.n_name"), F.col("copies"))
    )


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page to every address its html refers to."""
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    pages = table(spark, sf_dir, "pages").select("url", F.explode(found).alias("target"))
    return pages.select(*_edge(F.col("url"), F.col("target")))


def _heavy(rows: DataFrame, key: str, threshold: int) -> DataFrame | None:
    """Hot keys of a table; the row count alone, which Parquet knows, rules out most cases."""
    if rows.count() <= threshold:
        return None
    return find_hot(rows, [key], "size", threshold)


GRAPHS = {
    "part_next": part_next,
    "part_supp": part_supp,
    "nation_trade": nation_trade,
    "page_links": page_links,
}


def edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines in the style of an edge file, every odd form included: (value).

    The line number of the order line picks the form, see the reader's rules.
    """
    part, supplier, order = (
        F.col(name).cast("string") for name in ("l_partkey", "l_suppkey", "l_orderkey")
    )
    forms = [
        F.concat(part, F.lit("\t"), supplier),
        F.concat(F.lit("# "), part, F.lit("\t"), supplier),
        F.concat(part, F.lit("\t"), supplier, F.lit("\t"), order),
        F.concat(part, F.lit(" "), supplier),
        F.concat(F.lit("  "), part, F.lit(" \t "), supplier, F.lit("  ")),
        F.concat(part, F.lit("\t\t"), supplier),
        F.concat(part, F.lit("\t")),
    ]
    return table(spark, sf_dir, "lineitem").select(_by_line_number(forms).alias("value"))


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for comma-separated files: plain, comment, third field, quoted, one field."""
    part, supplier, order = (
        F.col(name).cast("string") for name in ("l_partkey", "l_suppkey", "l_orderkey")
    )
    forms = [
        F.concat(part, F.lit(","), supplier),
        F.concat(F.lit("# "), part, F.lit(","), supplier),
        F.concat(part, F.lit(","), supplier, F.lit(","), order),
        F.concat(F.lit('"'), part, F.lit('","'), supplier, F.lit('"')),
        part,
        F.concat(F.lit('"'), part, F.lit(","), order, F.lit('",'), supplier),
        F.concat(part, F.lit(",")),
    ]
    return table(spark, sf_dir, "lineitem").select(_by_line_number(forms).alias("value"))


def _by_line_number(forms: list):
    line = F.when(F.col("l_linenumber") == 1, forms[0])
    for number, form in enumerate(forms[1:-1], start=2):
        line = line.when(F.col("l_linenumber") == number, form)
    return line.otherwise(forms[-1])
