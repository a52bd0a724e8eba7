"""Line-first cleaning, in DataFrame expressions only.

Every line is held against rules for punctuation, navigation, symbols, shouting and boilerplate.
Lines that fail one are removed; a document that loses more than ``LOST_PERCENT`` of its words
that way is rejected, as is one that is too short or repeats itself.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgetide.llm.common import WORD, bind, words_of

LEAST_WORDS = 50
REPEAT_PERCENT = 50
LOST_PERCENT = 50
WINDOW = 3
# A line with a separator for this many words is navigation, with a phrase for as many boilerplate.
SEPARATED_WORDS = 8
PHRASE_WORDS = 20
# A text with lines of up to this length may be hard-wrapped; a wrapped line has at least so much.
WRAPPED_MOST = 120
WRAPPED_LEAST = 30

# The symbols that are counted.
SYMBOLS = "#*$%&|<>"
# A line of prose holds the end of a sentence: in Latin, Greek, Cyrillic and CJK text; Armenian; Arabic and
# Urdu; the danda of Hindi, Bengali and others; Tibetan; Burmese; Georgian; Ethiopic; Khmer; wide forms.
SIGNS = (
    ".!?:;…。！？"
    "\u0589\u055c\u055e"
    "\u061b\u061e\u061f\u06d4"
    "\u0964\u0965"
    "\u0f0d\u0f0e"
    "\u104a\u104b"
    "\u10fb"
    "\u1362\u1364\u1365\u1366\u1367\u1368"
    "\u17d4\u17d5\u17d6"
    "\uff0e\uff1a\uff1b\uff61"
)
ENDS = rf"""[{SIGNS}]["'”’»)\]]*([\x20\x09-\x0D]|$)"""
# Scripts without a sign for it.
UNSIGNED = r"[\p{IsThai}\p{IsLao}]"
SEPARATORS = "[|»•·›]"
# Quotes in either direction: one of their marks counts as a separator, and is none.
QUOTED = "«[^«»]*»|»[^«»]*«|‹[^‹›]*›|›[^‹›]*‹"
MARKS = r"[#*$%&|<>{}~^=]"
BOILERPLATE = (
    "(?i)(all rights reserved|privacy policy|cookie policy|terms of (use|service)|"
    "enable javascript|click here|read more|skip to content|sign up|log in|lorem ipsum|"
    "licensed under|subscribe to our)"
)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def continued(line: Column, after: Column, longest: Column) -> Column:
    """Whether the line ``after`` (null for none) goes on with the sentence of ``line``.

    It does where it begins in lower case, or where its first word had no room in a text whose
    ``longest`` line is no longer than a wrapped one.
    """
    first = F.regexp_extract(after, WORD, 0)
    lower = first.rlike(r"^[\p{Punct}«»‹›„“‘]*\p{Ll}")
    room = F.length(line) + 1 + F.least(F.length(first), F.lit(WRAPPED_LEAST)) <= longest
    wrapped = (longest <= WRAPPED_MOST) & ~room
    return F.coalesce(
        (F.length(line) >= WRAPPED_LEAST) & (F.length(first) > 0) & (lower | wrapped), F.lit(False)
    )


def line_fails(line: Column, words: Column, after: Column, longest: Column) -> Column:
    """Whether a line of ``words`` words fails a rule; a line without words never does."""
    punctuation = ~line.rlike(ENDS) & ~line.rlike(UNSIGNED) & ~continued(line, after, longest)
    separators = _count(line, SEPARATORS)
    navigation = (separators >= 2) & bind(
        separators - _count(line, QUOTED),
        lambda bare: (bare >= 2) & (bare * SEPARATED_WORDS >= words),
    )
    symbols = _count(line, MARKS) * 2 >= words
    shouting = (words >= 3) & (_count(line, "!") >= words)
    phrases = line.rlike(BOILERPLATE) & (_count(line, BOILERPLATE) * PHRASE_WORDS >= words)
    return (words > 0) & (punctuation | navigation | symbols | shouting | phrases)


def _lines(text: Column) -> Column:
    """(line, words, failed) of each line, in order."""

    def of(lines: Column, longest: Column) -> Column:
        def judged(line: Column, i: Column) -> Column:
            return bind(
                _count(line, WORD),
                lambda words: F.struct(
                    line.alias("line"),
                    words.alias("words"),
                    line_fails(line, words, F.get(lines, i + 1), longest).alias("failed"),
                ),
            )

        return F.transform(lines, judged)

    def with_longest(lines: Column) -> Column:
        longest = F.array_max(F.transform(lines, lambda line: F.length(line)))
        return bind(longest, lambda longest: of(lines, longest))

    return bind(F.split(F.coalesce(text, F.lit("")), "\n"), with_longest)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a run of ``window`` words found twice or more.

    Runs are compared by 64-bit hashes inside one text. Only a text that holds an equal pair is
    sorted; the sorted runs' neighbours tell which positions repeat.
    """

    def covered(positions: Column) -> Column:
        start = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("total"))
        return F.aggregate(
            positions,
            start,
            lambda done, at: F.struct(
                at.alias("last"),
                (done["total"] + F.least(F.lit(window), at - done["last"])).alias("total"),
            ),
            lambda done: done["total"],
        )

    def positions(runs: Column) -> Column:
        def repeats(run: Column, j: Column) -> Column:
            same = [F.get(runs, j - 1)["run"] == run["run"], F.get(runs, j + 1)["run"] == run["run"]]
            return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

        return F.sort_array(F.transform(F.filter(runs, repeats), lambda run: run["at"]))

    def count(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - window)
        keys = F.transform(
            starts, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(window)))
        )
        runs = bind(
            keys,
            lambda keys: F.when(
                F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)
            ).otherwise(
                bind(
                    F.sort_array(
                        F.transform(keys, lambda key, i: F.struct(key.alias("run"), i.alias("at")))
                    ),
                    lambda runs: covered(positions(runs)),
                )
            ),
        )
        return F.when(F.size(hashes) < window, F.lit(0)).otherwise(runs)

    return bind(F.transform(words, lambda word: F.xxhash64(word)), count)


def judgement(text: Column) -> Column:
    """Counts, verdict and what is left of a text, as one struct.

    (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_words, base_failed, kept,
    left). A null text has no words, is rejected as too short and stays null.
    """
    plain = F.coalesce(text, F.lit(""))
    bare = plain
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            repeated_words(words).cast("bigint").alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        full = F.transform(F.filter(lines, lambda x: x["words"] > 0), lambda x: x["line"])
        good = F.transform(F.filter(lines, lambda x: ~x["failed"]), lambda x: x["line"])
        repeats = bind(full, lambda full: F.size(full) - F.size(F.array_distinct(full)))
        return F.struct(
            repeats.cast("bigint").alias("n_dup_lines"),
            F.aggregate(
                lines,
                F.lit(0).cast("bigint"),
                lambda lost, x: lost + F.when(x["failed"], x["words"]).otherwise(0),
            ).alias("lost_words"),
            F.array_join(good, "\n").alias("left"),
        )

    def verdict(words: Column, lines: Column) -> Column:
        short = words["n_words"] < LEAST_WORDS
        failed = short | (words["n_repeat_words"] * 100 > words["n_words"] * REPEAT_PERCENT)
        loses = lines["lost_words"] * 100 > words["n_words"] * LOST_PERCENT
        return F.struct(
            words["n_words"].alias("n_words"),
            words["word_chars"].alias("word_chars"),
            (F.length(plain) - F.length(bare)).cast("bigint").alias("n_symbols"),
            lines["n_dup_lines"].alias("n_dup_lines"),
            words["n_repeat_words"].alias("n_repeat_words"),
            lines["lost_words"].alias("lost_words"),
            failed.alias("base_failed"),
            (~(failed | loses)).alias("kept"),
            F.when(text.isNotNull(), lines["left"]).alias("left"),
        )

    return bind(
        bind(words_of(text), of_words),
        lambda words: bind(bind(_lines(text), of_lines), lambda lines: verdict(words, lines)),
    )


def judge_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``judgement`` of every document as columns beside doc_id, one row each, no shuffle.

    Equal rows are judged each on its own; an empty table gives no rows; other columns are
    ignored.
    """
    judged = docs.select(
        F.col(id_column).alias("doc_id"), judgement(F.col(text_column)).alias("judged")
    )
    return judged.select("doc_id", "judged.*")


def clean_documents(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The kept documents with all their columns, failed lines removed from the text."""
    names = docs.columns
    judged = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in names)).alias("row"),
        judgement(F.col(f"`{text_column}`")).alias("judged"),
    ).where("judged.kept")
    return judged.select(
        *(
            F.col("judged.left").alias(name)
            if name == text_column
            else F.col(f"row.`{name}`").alias(name)
            for name in names
        )
    )
