"""The stages on a small corpus, the registered queries, and what the subpackage may touch."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from checking import open_tables
from edgetide.llm.minhash import near_duplicates
from edgetide.llm.quality import judge_documents
from edgetide.storage import store

ROOT = Path(__file__).resolve().parents[2]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_each_other(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    before = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before[name] = docs
        docs, _ = store(stage(spark, docs, sf001), name)
        assert docs.columns == COLUMNS
        assert docs.where(F.length("text") != F.col("n_chars")).isEmpty()
        before[f"after {name}"] = docs

    def ids(table):
        return sorted(row.doc_id for row in table.select("doc_id").collect())

    judged = judge_documents(before["quality"])
    assert ids(before["after quality"]) == ids(judged.where("kept"))
    found = near_duplicates(before["minhash"], 5, 80)
    assert ids(before["after minhash"]) == ids(found.where("kept"))
    assert ids(before["after pii"]) == ids(before["pii"])
    text = F.col("text")
    assert before["after pii"].where(text.rlike(r"[a-z0-9]@[a-z0-9]+\.[a-z]")).isEmpty()
    mixed = before["after mixing"].groupBy("doc_id").count()
    assert mixed.agg(F.max("count")).first()[0] <= 2
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf001)
    lengths = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    repeats = lengths.join(mixed, "doc_id").where("n != t * count")
    assert repeats.isEmpty() and lengths.count() == mixed.count()


def test_stages_take_odd_rows(spark, make_docs, odd_texts):
    docs = make_docs(odd_texts)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() <= 3 * len(odd_texts) + 200
        assert stage(spark, docs.limit(0), "").collect() == []


def test_mixing_keeps_columns_of_any_name(make_docs, crowded):
    docs = crowded(make_docs([f"some words {i} " * 5 for i in range(40)])).drop("_key")
    docs = docs.withColumns({name: F.lit(name) for name in ("_id", "row", "a.b", "extra")})
    mixed = corpus_pipeline.mix(None, docs, "")
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    assert {row["copies"] for row in rows} == {"clash"} and {row["_id"] for row in rows} == {"_id"}
    assert 50 <= len(rows) <= 70  # half as much again


def test_all_queries_are_there():
    names = list(driver.queries())
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert "pipeline" in names and set(driver.oracle_sql()) <= set(names)


SQL = [name for name in driver.oracle_sql() if re.match(r"op\d+_", name)]


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, sf001, name):
    df = driver.queries()[name](spark, sf001)
    columns = sorted(df.columns)
    ours = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    result = open_tables(sf001).execute(driver.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    assert ours == sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)


def test_nothing_outside_needs_the_subpackage():
    for path in (ROOT / "edgetide").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text()
