from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from trailmark.llm import pii
from trailmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def keeps(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [
        (kind, m.start(), m.end()) for kind, p in PATTERNS.items() for m in re.finditer(p, text) if keeps(kind, m.group())
    ]


def base(text):
    return [span for span in pii.find(text) if span[0] in pii.BASE]


PARTS = ["a", "b.c", "@", ".", "x@y.z", "1", "12", "255", "256", "4111111111111111", "4111 1111 1111 1111", "+1", " ", "-", "(", ")", "é", "00"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join))
def test_equals_patterns(text):
    assert base(text) == brute(text)


def test_own_kinds():
    text = "See https://u:p@host.example/x?y=1). IBAN: DE89 3704 0044 0532 0130 00, SSN 123-45-6789, account no 1234567, api_key = \"9abc12def0345678\""
    found = {kind: text[a:b] for kind, a, b in pii.find(text)}
    assert found["url"] == "https://u:p@host.example/x?y=1"
    assert found["iban"] == "DE89 3704 0044 0532 0130 00"
    assert found["ssn"] == "123-45-6789" and found["account"] == "1234567" and found["secret"] == "9abc12def0345678"
    assert [s[0] for s in pii.find("iban DE00 1111 2222 3333 4444 is no valid one")] == ["card"]


def test_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (3, "a@b.cd", 2), (3, "a@b.cd", 2), (None, "x" * 100_000 + " 1.2.3.4", 3)],
        "doc_id long, text string, spans int",
    )
    rows = sorted(map(tuple, pii.scan(docs).drop("base_sha256").collect()), key=str)
    assert rows == sorted(
        [(1, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, ""), *[(3, 1, 0, 0, 0, "email:0:6")] * 2, (None, 0, 1, 0, 0, "ip:100001:100008")],
        key=str,
    )
    assert pii.scan(docs.limit(0)).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op7_pii"](spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        spans = brute(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in spans) for k in pii.BASE]
        assert set(f"{k}:{a}:{b}" for k, a, b in spans) <= set(row.spans.split(","))
