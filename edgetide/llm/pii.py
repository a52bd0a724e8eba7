"""Personal data by candidate gradient boosting, in DataFrame expressions only.

Four fixed patterns give the base spans, which always stay. Wider generators propose more,
overlapping candidates; boosted trees score each by its format and surroundings, and a threshold
calibrated for its kind decides. They are found from every start, not only behind the last match. The trees are fitted by Spark ML on a bounded table of labelled
examples (``EXAMPLES`` rows made from templates) and applied as plain expressions to the arrays of
candidates, so a document never leaves its row.
"""

import math
import random

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgetide.llm.common import bind, scan

EXAMPLES = 4000
TREES = 20
DEPTH = 4
PRECISION = 0.98
CONTEXT = 24

# Kinds in their order; the last is the method's own.
KINDS = ("email", "ip", "card", "phone", "secret")

# The base patterns. Possessive loops and the start rule change no match; they keep
# the time in proportion to the text and the matcher's stack flat.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# High-recall generators.
WIDE = {
    "email": r"[A-Za-z0-9._%+-]{1,64} ?(?:@|[(\[{]at[)\]}]) ?[A-Za-z0-9-]{1,64}"
    r"(?: ?(?:\.|[(\[{]dot[)\]}]) ?[A-Za-z0-9-]{1,64}){1,6}",
    "ip": r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}",
    "card": r"[0-9]{4}(?:[ ./_-]?[0-9]{2,6}){2,4}",
    "phone": r"\(?[0-9]{2,4}\)?[ ./-]{1,2}[0-9]{3,4}[ ./-][0-9]{3,4}",
    "secret": r"(?i)(?:token|secret|password|passwd|api[_-]?key)[\"']?[ ]{0,3}[:=][ ]{0,3}[\"']?"
    r"[A-Za-z0-9_+/=.-]{6,256}",
}

# The same from every start at which a number or word begins, so that what stands before it swallows
# nothing, and cards by their usual groups, so that what follows is left out: (kind, guard, pattern).
_CARDS = (r"[0-9]{4}(?:[ ./_-]?[0-9]{4}){3}(?![0-9])",
          r"[0-9]{4}[ ./_-]?[0-9]{6}[ ./_-]?[0-9]{5}(?![0-9])")
STARTS = (
    ("email", r"(?<![A-Za-z0-9._%+-])", WIDE["email"]),
    ("ip", r"(?<![0-9A-Fa-f:])", WIDE["ip"]),
    ("card", r"(?<![0-9])", WIDE["card"]),
    *(("card", r"(?<![0-9])", pattern) for pattern in _CARDS),
    ("phone", r"(?<![0-9])", WIDE["phone"]),
    ("secret", "", WIDE["secret"]),
)

# What a text must hold for a kind to be looked for at all.
_HINTS = {
    "email": r"@|[(\[{]at[)\]}]",
    "ip": r"[0-9]\.[0-9]|[0-9A-Fa-f]:",
    "card": r"[0-9][\x20./_-]?[0-9]",
    "phone": r"[0-9]",
    "secret": r"(?i)token|secret|passw|api[_-]?key",
}

# Words before a candidate that speak for and against it.
_FOR = r"(?i)(tel|phone|call|mobile|fax|mail|contact|card|visa|host|server|addr|reach|ip\b)"
_AGAINST = r"(?i)(version|order|isbn|page|total|price|invoice|serial|item|date|part|no\.|#|lot)"

FEATURES = (
    "kind", "length", "digits", "letters", "others", "luhn", "distinct", "joined_before",
    "joined_after", "speaks_for", "speaks_against", "groups", "mixed",
)


def _only(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def _passes(kind: str, match: Column) -> Column:
    """The base rule beyond the pattern."""
    digits = _only(match, "[^0-9]")
    if kind == "ip":

        def small(part: Column) -> Column:
            bare = F.regexp_replace(part, "^0+(?=.)", "")
            return (F.length(bare) <= 3) & (F.substring(bare, 1, 3).cast("int") <= 255)

        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        return F.length(digits).between(12, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _found(text: Column, pattern: str, kind: str, hint: str, keep=None) -> Column:
    """(start, kind, end, match) of every match, offsets in code points; lazily, behind ``hint``.

    Text between matches and matches alternate, so the sums of their lengths are the offsets.
    """

    def spans(matches: Column) -> Column:
        between = F.split(text, pattern, -1)
        lengths = bind(
            between,
            lambda between: F.transform(
                matches,
                lambda match, i: (F.length(F.get(between, i)) + F.length(match)).cast("bigint"),
            ),
        )
        zero = F.lit(0).cast("bigint")
        ends = bind(
            lengths,
            lambda lengths: F.zip_with(
                scan(lengths, zero, lambda a, b: a + b), lengths, lambda a, b: a + b
            ),
        )
        found = F.zip_with(
            matches,
            ends,
            lambda match, end: F.struct(
                (end - F.length(match)).alias("start"),
                F.lit(KINDS.index(kind)).alias("kind"),
                end.alias("end"),
                match.alias("match"),
            ),
        )
        return F.filter(found, lambda x: keep(x["match"])) if keep else found

    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,match:string>>")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(hint), bind(matches, spans)).otherwise(none)


def _from_starts(text: Column, guard: str, pattern: str, kind: str, hint: str) -> Column:
    """Like ``_found``, with the match at every start that ``guard`` lets pass; they may overlap.

    The text is cut at the starts, so the sums of the pieces' lengths are the offsets; one at the
    text's begin makes no empty piece.
    """

    def spans(matches: Column) -> Column:
        zero = F.lit(0).cast("bigint")

        def starts(pieces: Column) -> Column:
            lengths = F.transform(pieces, lambda piece: F.length(piece).cast("bigint"))
            return F.slice(
                scan(lengths, zero, lambda a, b: a + b),
                F.size(pieces) - F.size(matches) + 1,
                F.size(matches),
            )

        return F.zip_with(
            matches,
            bind(F.split(text, f"{guard}(?={pattern})", -1), starts),
            lambda match, start: F.struct(
                start.alias("start"),
                F.lit(KINDS.index(kind)).alias("kind"),
                (start + F.length(match)).alias("end"),
                match.alias("match"),
            ),
        )

    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,match:string>>")
    matches = F.regexp_extract_all(text, F.lit(f"{guard}(?=({pattern}))"), F.lit(1))
    found = bind(matches, lambda m: F.when(F.size(m) == 0, none).otherwise(spans(m)))
    return F.when(text.rlike(hint), found).otherwise(none)


def base_spans(text: Column) -> Column:
    return F.concat(
        *(
            _found(text, pattern, kind, _HINTS[kind], lambda m, kind=kind: _passes(kind, m))
            for kind, pattern in BASE.items()
        )
    )


def _surrounded(text: Column, span: Column) -> Column:
    """A candidate with the characters before and after it."""
    first = F.greatest(span["start"] - CONTEXT, F.lit(0))
    return F.struct(
        *(span[name].alias(name) for name in ("start", "kind", "end", "match")),
        F.substr(text, (first + 1).cast("int"), (span["start"] - first).cast("int")).alias("before"),
        F.substr(text, (span["end"] + 1).cast("int"), F.lit(2)).alias("after"),
    )


def _features(x: Column) -> Column:
    match, before, after = x["match"], x["before"], x["after"]
    digits = _only(match, "[^0-9]")
    letters = F.length(_only(match, "[^A-Za-z]"))
    groups = F.regexp_count(match, F.lit("[0-9]+"))

    def flag(test: Column) -> Column:
        return test.cast("double")

    values = {
        "kind": x["kind"].cast("double"),
        "length": F.length(match).cast("double"),
        "digits": F.length(digits).cast("double"),
        "letters": letters.cast("double"),
        "others": (F.length(match) - F.length(digits) - letters).cast("double"),
        "luhn": flag(F.length(digits).between(12, 19) & _luhn(digits)),
        "distinct": F.size(F.array_distinct(F.split(match, ""))).cast("double"),
        "joined_before": flag(before.rlike("[A-Za-z0-9]$")),
        "joined_after": flag(after.rlike("^[A-Za-z0-9]|^[.,:/-][0-9]")),
        "speaks_for": flag(before.rlike(_FOR)),
        "speaks_against": flag(before.rlike(_AGAINST)),
        "groups": groups.cast("double"),
        "mixed": flag(match.rlike("[0-9]") & match.rlike("[A-Za-z]")),
    }
    return F.struct(*(values[name].alias(name) for name in FEATURES))


def _examples(rows: int, seed: int = 7) -> list[tuple]:
    """(start, kind, end, match, before, after, label): invented candidates from templates."""
    rng = random.Random(seed)

    def number(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def name() -> str:
        return "".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randint(3, 9)))

    def code(n: int) -> str:
        return "".join(rng.choice("0123456789abcdef") for _ in range(n))

    def at() -> str:
        return rng.choice(["@", " (at) ", "[at]", "(at)"])

    def dot() -> str:
        return rng.choice([".", " (dot) ", "[dot]"])

    sep = [" ", "-", "."]
    yes = {
        "email": [lambda: f"{name()}{at()}{name()}{dot()}com", lambda: f"{name()}@{name()}.org"],
        "ip": [lambda: ":".join(code(4) for _ in range(8)),
               lambda: f"{code(4)}::{code(4)}:{code(4)}:{code(3)}"],
        "card": [lambda: (s := rng.choice(" -./")).join(number(4) for _ in range(4)),
                 lambda: f"{number(4)}.{number(6)}.{number(5)}"],
        "phone": [lambda: f"({number(3)}) {number(3)}-{number(4)}",
                  lambda: (s := rng.choice(sep)).join([number(3), number(3), number(4)])],
        "secret": [lambda: f'token = "{code(rng.choice([24, 32, 40]))}',
                   lambda: f"api_key: {code(32)}", lambda: f"password={name()}{number(4)}"],
    }
    no = {
        "email": [lambda: f"{name()} @ {number(2)}.{number(2)}", lambda: f"{number(1)}@{number(1)}.{number(2)}"],
        "ip": [lambda: ":".join(number(2) for _ in range(4)), lambda: f"{number(1)}:{number(2)}:{number(2)}:"],
        "card": [lambda: number(16), lambda: f"{number(4)}-{number(2)}-{number(2)}", lambda: number(12),
                 lambda: f"{number(4)}/{number(2)}/{number(2)}",
                 lambda: f"{number(4)} {number(3)}.{number(3)}.{number(2)}"],
        "phone": [lambda: f"{number(2)}.{number(3)}.{number(3)}", lambda: f"{number(4)}-{number(4)}/{number(4)}",
                  lambda: f"{number(2)}/{number(3)} {number(3)}", lambda: f"{number(3)} {number(3)} {number(3)}"],
        "secret": [lambda: f"password: {name()}", lambda: f"token = {name()}", lambda: "secret = undefined"],
    }
    good = ["phone ", "call me: ", "Mail ", "my card ", "server host ", "", "", " and ", "the "]
    bad = ["order ", "version ", "part no. ", "page ", "total ", "ISBN ", "invoice #", "", "", " and "]
    found = []
    for i in range(rows):
        label = i % 2
        kind = KINDS[(i // 2) % len(KINDS)]
        match = rng.choice((yes if label else no)[kind])()
        before = f"{name()} {rng.choice(good if label else bad)}"
        after = rng.choice([" x", ". ", ", ", "", "\n"] if label or rng.random() < 0.5 else ["7", "-4", ".5"])
        found.append((0, KINDS.index(kind), len(match), match, before, after, float(label)))
    return found


def _tree(node, depth: int = 0) -> tuple | float:
    """(feature, threshold, left, right) or the value of a leaf."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (
        int(split.featureIndex()), float(split.threshold()),
        _tree(node.leftChild()), _tree(node.rightChild()),
    )


class Model:
    """Boosted trees and thresholds as plain values."""

    def __init__(self, trees: list[tuple], thresholds: list[float]):
        self.trees, self.thresholds = trees, thresholds

    def probability(self, features: Column) -> Column:
        def value(tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            feature, threshold, left, right = tree
            low = features[FEATURES[feature]] <= threshold
            return F.when(low, value(left)).otherwise(value(right))

        margin = F.lit(0.0)
        for weight, tree in self.trees:
            margin = margin + F.lit(weight) * value(tree)
        return 1 / (1 + F.exp(-2 * margin))

    def accepts(self, x: Column) -> Column:
        limits = F.array(*(F.lit(limit) for limit in self.thresholds))
        return bind(
            _features(x), lambda features: self.probability(features) >= F.get(limits, x["kind"])
        )


def fit_model(spark: SparkSession, rows: int = EXAMPLES) -> Model:
    """Fit on one half of the examples; each kind's threshold comes from the other half.

    It is the lowest with a precision of ``PRECISION`` there; a kind without one takes nothing.
    """
    schema = (
        "start bigint, kind int, end bigint, match string, before string, after string, "
        "label double"
    )
    examples = spark.createDataFrame(_examples(rows), schema).coalesce(1)
    x = F.struct(*(F.col(name) for name in examples.columns[:-1]))
    table = examples.select("kind", "label", _features(x).alias("f")).select(
        F.col("kind").alias("of"), "label", "f.*"
    )
    half = F.pmod(F.xxhash64(*FEATURES, "label"), F.lit(2))
    table = table.withColumn("half", half)
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(table)
    fitted = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, maxBins=64, stepSize=0.3, seed=1, checkpointInterval=-1
    ).fit(assembled.where("half = 0"))
    trees = [
        (float(weight), _tree(tree._call_java("rootNode")))
        for weight, tree in zip(fitted.treeWeights, fitted.trees, strict=True)
    ]
    model = Model(trees, [math.inf] * len(KINDS))
    held_out = (
        table.where("half = 1")
        .select("of", "label", model.probability(F.struct(*FEATURES)).alias("p"))
        .collect()  # at most half of the examples
    )
    for kind in range(len(KINDS)):
        own = sorted(((r["p"], r["label"]) for r in held_out if r["of"] == kind), reverse=True)
        right = 0
        for i, (p, label) in enumerate(own, start=1):
            right += label
            ends = i == len(own) or own[i][0] < p
            if ends and p >= 0.5 and right >= PRECISION * i:
                model.thresholds[kind] = p
    return model


def all_spans(text: Column, model: Model, base: Column) -> Column:
    """Base spans and accepted candidates, sorted by start, then kind.

    A candidate inside a base span or a longer one of its kind, or equal to another, adds nothing.
    """

    def inside(x: Column, spans: Column, test) -> Column:
        return F.exists(
            spans, lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"]) & test(b)
        )

    def longest(wide: Column) -> Column:
        def longer(x: Column) -> Column:
            length = x["end"] - x["start"]
            return inside(
                x, wide, lambda b: (b["kind"] == x["kind"]) & (b["end"] - b["start"] > length)
            )

        return F.filter(wide, lambda x: ~longer(x))

    def accepted(base: Column) -> Column:
        wide = F.array_distinct(
            F.concat(
                *(_found(text, pattern, kind, _HINTS[kind]) for kind, pattern in WIDE.items()),
                *(
                    _from_starts(text, guard, pattern, kind, _HINTS[kind])
                    for kind, guard, pattern in STARTS
                ),
            )
        )
        taken = F.filter(
            wide,
            lambda x: ~inside(x, base, lambda b: F.lit(True))
            & model.accepts(_surrounded(text, x)),
        )
        return F.array_distinct(F.concat(base, bind(taken, longest)))

    return F.sort_array(accepted(base))


def spans_text(spans: Column) -> Column:
    names = F.array(*(F.lit(kind) for kind in KINDS))
    return F.array_join(
        F.transform(
            spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])
        ),
        ",",
    )


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each run of overlapping spans replaced by its first kind's name in brackets."""
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    zero = F.lit(0).cast("bigint")

    def cut(spans: Column) -> Column:
        ends = F.transform(spans, lambda x: x["end"])
        covered = scan(ends, zero, lambda a, b: F.greatest(a, b))

        def kept(covered: Column) -> Column:
            pieces = F.zip_with(
                spans,
                covered,
                lambda x, upto: F.when(
                    x["start"] >= upto,
                    F.concat(
                        F.substr(text, (upto + 1).cast("int"), (x["start"] - upto).cast("int")),
                        F.get(names, x["kind"]),
                    ),
                ).otherwise(F.lit("")),
            )
            last = F.array_max(ends).cast("int")
            return F.concat(F.array_join(pieces, ""), F.substr(text, last + 1, F.length(text)))

        return bind(covered, kept)

    return bind(spans, lambda spans: F.when(F.size(spans) == 0, text).otherwise(cut(spans)))


def redact_documents(
    docs: DataFrame, model: Model | None = None, text_column: str = "text"
) -> DataFrame:
    """All documents with all their columns, personal data replaced in the text; null stays null."""
    model = model or fit_model(docs.sparkSession)
    text = F.col(f"`{text_column}`")

    def clean(plain: Column) -> Column:
        found = bind(F.sort_array(base_spans(plain)), lambda base: all_spans(plain, model, base))
        return bind(found, lambda spans: redact(plain, spans))

    return docs.withColumn(
        text_column, F.when(text.isNotNull(), bind(F.coalesce(text, F.lit("")), clean))
    )


def find_personal_data(
    docs: DataFrame,
    model: Model | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, text, base, spans): arrays of (start, kind, end, match), a row for each document.

    Offsets count code points, the end is exclusive, kinds are numbers into ``KINDS``. A null or
    empty text has no spans; equal rows are searched each on its own; other columns are ignored.
    """
    model = model or fit_model(docs.sparkSession)
    text = F.col("text")
    return (
        docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
        .withColumn("_plain", F.coalesce(text, F.lit("")))
        .withColumn("base", F.sort_array(base_spans(F.col("_plain"))))
        .withColumn("spans", all_spans(F.col("_plain"), model, F.col("base")))
        .drop("_plain")
    )
