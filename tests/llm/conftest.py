import random

import pytest

WORDS = "the of and to in is that for it was on are with as his they at be this from".split()


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows from texts; ids by position unless given."""

    def make(texts, ids=None, sources=None, langs=None):
        ids = ids if ids is not None else range(len(texts))
        rows = [
            (i, text, (langs or {}).get(i, "en"), sources[k] if sources else f"s{k % 3}",
             len(text) if text is not None else None)
            for k, (i, text) in enumerate(zip(ids, texts))
        ]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very long and repeated texts, odd characters and ties."""
    rng = random.Random(3)
    prose = [" ".join(rng.choices(WORDS, k=rng.randint(1, 300))) + "." for _ in range(30)]
    return [
        None, None, "", "", " ", "\n\n", "a", "A b", "a B\tc\x0bd", "\x00 x", "é ü\xa0ß",
        "汉字 语言 文本", "½ 12 3.5", "word " * 30_000, "x" * 60_000, "a,\n b. \n\nc !!",
        "<|endoftext|> is text", *prose, *prose[:5],
    ]


@pytest.fixture(scope="session")
def crowded(spark):
    """Extra columns whose names the operators use inside."""

    def add(docs):
        from pyspark.sql import functions as F

        names = ["group", "size", "shard", "row", "id", "n", "class", "kind", "words", "part",
                 "open", "held_out", "value", "word", "label", "left", "judged", "spans", "base",
                 "copies", "_copy", "_bucket", "_key", "target"]
        return docs.select("*", *(F.lit("clash").alias(name) for name in names))

    return add
