import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from edgetide.functions.text import blank_fields, tab_fields, ten_decimals, trimmed
from edgetide.sources.edges import parse_blank, parse_tab, read_edges

# line -> (what the tab reader makes of it, what the blank reader makes of it)
RULES = [
    ("# c", None, None),
    ("#x\ty", None, None),
    (" #x\ty", ("#x", "y"), ("#x", "y")),
    ("0\t1", ("0", "1"), ("0", "1")),
    ("0\t1\t9", ("0", "1"), None),
    ("1 2", None, ("1", "2")),
    ("3\t", "malformed", None),
    ("\t4", "malformed", None),
    ("\t", "malformed", None),
    ("5\t\t6", ("5", ""), ("5", "6")),
    (" a \t b ", ("a ", " b"), ("a", "b")),
    ("", None, None),
    ("   ", None, None),
    ("007\t0010", ("007", "0010"), ("007", "0010")),
    (" x\ty ", ("x", "y"), ("x", "y")),
    ("\x1cx\ty\x1f", ("x", "y"), ("x", "y")),
    ("x　y", None, ("x", "y")),
]


def lines_of(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


@pytest.mark.parametrize("line,tab,blank", RULES)
def test_rules_line_by_line(spark, line, tab, blank):
    df = lines_of(spark, [line])
    expected = [] if tab in (None, "malformed") else [tab]
    assert [tuple(row) for row in parse_tab(df, "drop").collect()] == expected
    assert [tuple(row) for row in parse_blank(df).collect()] == ([blank] if blank else [])
    if tab == "malformed":
        with pytest.raises(PySparkException, match="two fields"):
            parse_tab(df).count()
    else:
        assert parse_tab(df).count() == len(expected)


def test_splitting_agrees_with_python(spark):
    samples = [line for line, _, _ in RULES if line.strip()]
    line = F.col("value")
    rows = lines_of(spark, samples).select(
        "value",
        trimmed(line).alias("t"),
        tab_fields(line).alias("f"),
        blank_fields(line).alias("b"),
    )
    for row in rows.collect():
        assert row.t == row.value.strip()
        assert row.f == row.value.strip().split("\t")
        assert row.b == row.value.split()


def test_unknown_options(spark, tmp_path):
    with pytest.raises(ValueError):
        parse_tab(lines_of(spark, ["a\tb"]), "ignore")
    with pytest.raises(ValueError):
        read_edges(spark, str(tmp_path), "xml")


def test_files(spark, tmp_path):
    text = "# c\n0\t1\n\n2\t3\r\n"
    (tmp_path / "plain.txt").write_text(text)
    with gzip.open(tmp_path / "packed.txt.gz", "wt") as packed:
        packed.write(text)
    plain = read_edges(spark, str(tmp_path / "plain.txt"))
    packed = read_edges(spark, str(tmp_path / "packed.txt.gz"), partitions=3)
    assert sorted(map(tuple, plain.collect())) == [("0", "1"), ("2", "3")]
    assert sorted(map(tuple, packed.collect())) == [("0", "1"), ("2", "3")]
    assert spark.read.text(str(tmp_path / "packed.txt.gz")).rdd.getNumPartitions() == 1
    assert packed.rdd.getNumPartitions() == 3


def test_csv(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text('# c\n01,2\n3,4,5\n"a,b",c\n')
    edges = read_edges(spark, str(path), "csv")
    assert sorted(map(tuple, edges.collect())) == [("01", "2"), ("3", "4"), ("a,b", "c")]
    path.write_text("1,2\n3\n4,\n")
    assert read_edges(spark, str(path), "csv", on_malformed="drop").count() == 1
    with pytest.raises(PySparkException, match="two fields"):
        read_edges(spark, str(path), "csv").collect()


def test_ten_decimals(spark):
    values = [0.15, 1.0, 445.71778597, 1e-11, 123456.78901234567]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(ten_decimals(F.col("v"))).collect()] == [
        f"{v:.10f}" for v in values
    ]
