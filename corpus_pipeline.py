"""From raw documents to packed sequences, in five stages.

Each stage takes (session, documents, table folder) and returns a DataFrame that is written and
read again as the next one's documents; all but the last return the documents' columns.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgetide.llm.minhash import near_duplicates
from edgetide.llm.mixing import mix_documents
from edgetide.llm.packing import pack_documents
from edgetide.llm.pii import redact_documents
from edgetide.llm.quality import clean_documents
from edgetide.storage import store

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a change of the text."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines and rejected documents go; null and empty texts are rejected.

    Rows are judged one by one, so equal rows fare alike; other columns are kept, no rows give none.
    """
    return _counted(clean_documents(docs))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    Rows that share an id stay or go together; rows without one, and texts without words, stay. Other
    columns are kept, no rows give none.
    """
    found = near_duplicates(docs, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    gone = found.where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind's name in brackets.

    A null text stays null; rows are searched one by one, other columns are kept.
    """
    return _counted(redact_documents(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, 0 to 2 times.

    Rows that share an id are taken as often as the one of them that is taken most; a null text has
    no words and is not taken. Columns of any name are kept, no rows give none.
    """
    copies = mix_documents(docs).groupBy("doc_id").agg(F.max("copies").alias("copies"))
    copies = copies.where("copies > 0")
    # a row travels as one column, so that its names cannot clash
    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
    taken = rows.join(copies, F.col("row.doc_id").eqNullSafe(copies["doc_id"]))
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return taken.select("row", each).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of up to 1024 tokens.

    A null or empty text is its end token; rows are packed one by one, other columns are left behind.
    """
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("minhash", deduplicate),
    ("pii", personal_data),
    ("mixing", mix),
    ("packing", pack),
]

# The stages' methods are iterative, random or fitted; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
