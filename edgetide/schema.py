"""Column layouts and default parameters."""

from pyspark.sql import types as T

ITERATIONS = 10
DAMPING = 0.85
CHECKPOINT_EVERY = 5
TOP = 5
STORED = 1000

# An edge row is one link; a counted edge row stands for `copies` equal links.
EDGES = T.StructType(
    [
        T.StructField("src", T.StringType(), False),
        T.StructField("dst", T.StringType(), False),
    ]
)

RANKS = T.StructType(
    [
        T.StructField("nodeId", T.StringType()),
        T.StructField("pagerank", T.DoubleType()),
    ]
)

TOP_LIST = T.StructType([T.StructField("rank", T.LongType())] + RANKS.fields)

ADJACENCY = T.StructType(
    [
        T.StructField("nodeId", T.StringType()),
        T.StructField("part", T.LongType()),
        T.StructField("neighbors", T.ArrayType(T.StringType())),
    ]
)

# The field names of the saved description.
METADATA = T.StructType(
    [
        T.StructField("dataset_name", T.StringType()),
        T.StructField("total_nodes", T.LongType()),
        T.StructField("total_edges", T.LongType()),
        T.StructField("iterations", T.LongType()),
        T.StructField("damping_factor", T.DoubleType()),
        T.StructField("top_node", T.StringType()),
        T.StructField("completed_at", T.StringType()),
    ]
)
