import hashlib
import re

import pytest
from pyspark.sql import functions as F

from edgetide.llm.queries import op7_boosted_pii
from edgetide.llm.pii import KINDS, find_personal_data, fit_model, redact_documents, spans_text

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    total = 0
    for i, digit in enumerate(reversed(digits)):
        total += sum(divmod(2 * int(digit), 10)) if i % 2 else int(digit)
    return total % 10 == 0


def base(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match.group())
            if kind == 1 and any(int(x) > 255 for x in match.group().split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            found.append((match.start(), kind, match.end()))
    return sorted(found)


@pytest.fixture(scope="module")
def model(spark):
    return fit_model(spark)


@pytest.fixture(scope="module")
def texts(odd_texts):
    return [
        *odd_texts,
        "a@b.c_d@e.f x@y z@.com é 汉 me+tag@mail.example.com.",
        "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3 99999999999.1.1.1",
        "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 49927398716 0000000000000000",
        "+1 (555) 123-4567 +12345678 +1234567890123456 ++1 222 333 444 5",
        "a@b.co,1.2.3.4,+49 30 1234567 8@9.1.1",
        "1 " * 4000, "1.2.3.4 " * 700, "a@b.c " * 300, "0" * 20_000, "a" * 20_000 + "@b.c", "+" * 5000,
        "a@" + "b." * 4000 + "c",
    ]


def test_base_spans(make_docs, texts, model, crowded):
    found = find_personal_data(crowded(make_docs(texts)), model)
    rows = found.select("doc_id", "base", "spans", spans_text(F.col("spans")).alias("listed"))
    rows = rows.orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    for row, text in zip(rows, texts):
        assert [(x.start, x.kind, x.end) for x in row.base] == base(text)
        assert all(text[x.start : x.end] == x.match for x in row.spans)
        spans = [(x.start, x.kind, x.end) for x in row.spans]
        assert spans == sorted(set(spans)) and set(base(text)) <= set(spans)
        assert row.listed == ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def added(make_docs, model, texts):
    rows = find_personal_data(make_docs(texts), model).orderBy("doc_id").collect()
    return [[KINDS[x.kind] for x in row.spans if x not in row.base] for row in rows]


def test_the_trees_add_what_the_patterns_miss(make_docs, model):
    texts = [
        "write to jane.doe (at) example (dot) com please",
        "call me: (212) 555-7788 today",
        'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and more',
        "host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 is up",
    ]
    assert added(make_docs, model, texts) == [["email"], ["phone"], ["secret"], ["ip"]]


def test_plain_numbers_are_left_alone(make_docs, model):
    texts = [
        "on 2024-05-06 12:30 version 1.2.3 cost 1,299.00 or 12.345.678 in 1999",
        "the token is lost, password: hidden, page 12/345 6789",
        "order 20240506123456 of 10:20:30:40",
    ]
    assert added(make_docs, model, texts) == [[], [], []]


def test_redacted_text(make_docs, model, texts, crowded):
    docs = crowded(make_docs(texts))
    clean = redact_documents(docs, model)
    assert clean.columns == docs.columns
    rows = {row.doc_id: row.text for row in clean.collect()}
    spans = {r.doc_id: r.spans for r in find_personal_data(make_docs(texts), model).collect()}
    for i, text in enumerate(texts):
        expected, at = "", 0
        for x in spans[i]:
            if x.start >= at:
                expected += text[at : x.start] + f"[{KINDS[x.kind].upper()}]"
            at = max(at, x.end)
        assert rows[i] == (None if text is None else expected + text[at:])


def test_no_rows_and_no_python_on_the_executors(make_docs, model):
    docs = make_docs(["a@b.c"])
    assert find_personal_data(docs.limit(0), model).collect() == []
    plan = find_personal_data(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("PythonUDF", "Pandas", "Arrow", "Exchange"))


def test_numbers_behind_numbers_are_found(make_docs, model):
    numbers = {
        "Room 12 555-123-4567": "555-123-4567",
        "555-123-4567 in 2023": "555-123-4567",
        "in 2023 415-555-1234": "415-555-1234",
        "on 2024-03-15 415-555-1234": "415-555-1234",
        "zip 90210 415-555-1234": "415-555-1234",
        "汉字 in 2023 (415) 555-1234 or 12 212-555-1234": "(415) 555-1234",
        "in 2023 4111.1111.1111.1112": "4111.1111.1111.1112",
        "my card 4111.1111.1111.1112 2023": "4111.1111.1111.1112",
    }
    rows = find_personal_data(make_docs(list(numbers)), model).orderBy("doc_id").collect()
    for row, (text, number) in zip(rows, numbers.items()):
        at = text.index(number)
        covered = {i for x in row.spans for i in range(x.start, x.end)}
        assert set(range(at, at + len(number))) <= covered, (text, row.spans)
        assert all(text[x.start : x.end] == x.match for x in row.spans)


def test_accepted_secrets_may_start_in_a_match(make_docs, model):
    secret = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    docs = make_docs([f"password: secret = {secret} in the file"])
    assert secret not in redact_documents(docs, model).collect()[0].text


def test_the_query_counts_the_base_spans_of_each_kind(spark, make_docs, texts, tmp_path):
    texts = [text for text in texts if len(text or "") < 500]
    make_docs(texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op7_boosted_pii(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    for row, text in zip(rows, texts):
        spans = base(text)
        listed = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
