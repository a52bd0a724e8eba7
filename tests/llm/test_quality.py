import re

import pytest

from edgetide.llm.quality import clean_documents, judge_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BOILERPLATE = re.compile(
    r"(?i)(all rights reserved|privacy policy|cookie policy|terms of (use|service)|"
    r"enable javascript|click here|read more|skip to content|sign up|log in|lorem ipsum|"
    r"licensed under|subscribe to our)"
)


def fails(line):
    n = len(WORD.findall(line))
    return n > 0 and bool(
        not re.search(r"""[.!?:;…。！？]["'”’»)\]…]*([\x20\x09-\x0D]|$)""".replace("…]*", "]*"), line)
        or len(re.findall("[|»•·›]", line)) >= 2
        or 2 * len(re.findall(r"[#*$%&|<>{}~^=]", line)) >= n
        or (n >= 3 and line.count("!") >= n)
        or BOILERPLATE.search(line)
    )


def brute(text):
    words = WORD.findall(text or "")
    lines = (text or "").split("\n")
    full = [line for line in lines if WORD.search(line)]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for run in runs:
        seen[run] = seen.get(run, 0) + 1
    repeated = {i + k for i, run in enumerate(runs) if seen[run] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    lost = sum(len(WORD.findall(line)) for line in lines if fails(line))
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(full) - len(set(full)), len(repeated), lost, failed,
        not failed and 100 * lost <= 50 * len(words),
        None if text is None else "\n".join(line for line in lines if not fails(line)),
    )


@pytest.fixture(scope="module")
def texts(odd_texts):
    clean = "One two three four five six seven eight nine ten, and so it goes on.\n"
    story = "".join(f"Line {i} tells of {i * 7} and of things {i * 3} that were not told.\n" for i in range(9))
    return [
        *odd_texts, story, story + "Home | About | Contact | Log in", story + "all rights reserved.",
        "Home | About\n" * 40, clean * 20, story.upper().replace(".", "!!!!!!!!!!!!!!!!"),
        story.replace(" ", "### "), story + story, story + "no end here",
        "Home | News | Sport | More words here\n" * 3 + story[:300],
    ]


def test_counts_verdicts_and_left_text(make_docs, texts, crowded):
    rows = judge_documents(crowded(make_docs(texts))).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    for row, text in zip(rows, texts):
        assert tuple(row)[1:] == brute(text), text[:80]


def test_clean_documents_stay_whole(make_docs, texts, crowded):
    docs = crowded(make_docs(texts))
    kept = clean_documents(docs)
    assert kept.columns == docs.columns
    expected = [(i, brute(text)[8]) for i, text in enumerate(texts) if brute(text)[7]]
    assert [(r.doc_id, r.text) for r in kept.orderBy("doc_id").collect()] == expected
    assert clean_documents(docs.limit(0)).collect() == []


def test_only_expressions_in_the_plan(make_docs):
    plan = judge_documents(make_docs(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))


def test_rules_of_a_line_go_by_its_words(make_docs):
    words = " ".join(f"mot{i}" for i in range(400))
    whole = [
        f"Il a dit « oui » et puis « non » avant le soir. {words}.",
        f"Er rief »ja« und dann »nein« und ‹halt› und ›still‹ in den Abend. {words}.",
        f"The readers must log in before they write. {words}.",
        f"Two of them | and one more | stand in a long line. {words}.",
    ]
    short = "Elle a dit « oui », puis « non », et il est parti."
    cut = ["Home | About | Contact us now.", "Please log in to read more.", "A » B » C are places."]
    story = "".join(" ".join(f"w{i}x{k}" for k in range(9)) + " too.\n" for i in range(9))
    docs = make_docs([*whole, story + short, *(story + line for line in cut)])
    kept = {row.doc_id: row.text for row in clean_documents(docs).collect()}
    assert [kept.get(i) for i in range(5)] == [*whole, story + short]
    assert [kept.get(i) for i in range(5, 8)] == [story.rstrip("\n")] * 3


def test_other_scripts_and_wrapped_prose_stay_whole(make_docs):
    def lines(words, sign, count=8):
        pick = [words[i:] + words[:i] for i in range(len(words))]
        return "\n".join(" ".join(f"{w}{i}" for w in pick[i % len(pick)]) + sign for i in range(count))

    hindi = "यह एक साफ पाठ है जो हर पंक्ति में".split()
    urdu = "یہ ایک صاف متن ہے جو ہر سطر میں".split()
    armenian, amharic = "սա մաքուր տեքստ է ամեն տող".split(), "ይህ ንጹህ ጽሑፍ ነው በየ መስመሩ".split()
    whole = [
        lines(hindi, "।"), lines(urdu, "۔"), lines(urdu, "؟"),
        lines(armenian, "։", 12), lines(amharic, "።", 12),
    ]
    words = [f"Word{i}" if i % 3 == 0 else f"word{i}" for i in range(140)]
    for style in (words, [f"शब्द{i}" for i in range(140)]):
        wrapped = [""]
        for word in style:
            if len(wrapped[-1]) + 1 + len(word) > 70:
                wrapped.append("")
            wrapped[-1] = f"{wrapped[-1]} {word}".strip()
        whole.append("\n".join(wrapped) + ".")
    menu = "Latest reports about the city council\n" * 2 + "Home\nNews\nThings to do this summer in town"
    kept = {row.doc_id: row.text for row in clean_documents(make_docs([*whole, whole[5] + "\n" + menu])).collect()}
    assert [kept.get(i) for i in range(len(whole))] == whole
    assert kept[len(whole)] == whole[5]


def test_sql_states_the_present_rules(make_docs, odd_texts):
    """Other scripts, wrapped and one-line texts, and phrases or quotes inside long lines."""
    import duckdb

    from edgetide.llm.oracle import OP8

    words = [f"mot{i}" for i in range(400)]
    prose, more = " ".join(words), " ".join(f"autre{i}" for i in range(400))
    wrapped = "\n".join(" ".join(words[i : i + 9]) + ("." if i % 27 == 0 else "") for i in range(0, 180, 9))
    given = [
        *(text for text in odd_texts if len(text or "") < 9000),
        prose + " log in " + more + ".",
        "« " + prose + " » et « " + more + " ».",
        " ".join(f"हिन्दी{i}" for i in range(60)) + "।",
        " ".join(f"اردو{i}" for i in range(60)) + "۔",
        " ".join(f"ไทย{i}" for i in range(60)),
        " ".join(f"բառ{i}" for i in range(60)) + "։",
        wrapped, wrapped.upper(), wrapped.replace("\n", "\n\n"),
        "Home | About | Contact\n" + prose + ".\n>> Read more <<\nGo! Now! Yes!\n# * # *",
        "\n".join(f"Line {i} of no end that is long enough to be wrapped" for i in range(30)),
        prose[:200] + "\n(suite) et fin.\n" + "X" * 130,
    ]
    docs = make_docs(given)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
               "lost_words", "base_failed", "kept"]
    rows = judge_documents(docs).select(columns).orderBy("doc_id").collect()
    connection = duckdb.connect()
    table = docs.select("doc_id", "text").toArrow()
    connection.register("documents", table)
    sql = connection.execute(f"SELECT {', '.join(columns)} FROM ({OP8}) ORDER BY doc_id").fetchall()
    assert [tuple(row) for row in rows] == sql
    at = given.index(prose + " log in " + more + ".")
    assert [row.kept for row in rows][at : at + 7] == [True] * 7
