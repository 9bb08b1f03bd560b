"""Personal data spans against a plain reading of their rules, and the edges."""

import random
import re

from pyspark.sql import functions as F

from framesift.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PARTS = ["a@b.c", "_d@e.f", "..", "1.2.3.4", "255.255.255.255", "0256.1.1.1", "00255.1.1.01", "4111 1111 1111 1111", "4111-1111-1111-1111 "]
PARTS += ["4", " ", "-", "+", "+1 (017) 555-7713", "(487) 555-7209", "é", "😀", "%", "x@y", "@", ".com", "+49 30", "9" * 21, "1", "call "]


def _luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def _plain(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 13 <= len(digits) <= 19 and _luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if fine:
                found.append((kind, m.start(), m.end(), m[0]))
    return found


def _spans(spark, texts):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string, start int").repartition(3)
    out = pii.find_documents(docs).collect()
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"], s["value"], s["score"]) for s in r["pii"]] for r in out}


def test_base_kinds_equal_a_plain_reading(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(1500)]
    texts += [None, "", texts[0], "a@b.c," * 3000, "1.2.3.4 " * 3000, "x" * 200_000 + "@y.z"]
    found = _spans(spark, texts)
    for i, text in enumerate(texts[:-1]):
        assert [s[:4] for s in found[i] if s[0] in PLAIN] == _plain(text), text
    assert found[len(texts) - 1][0][:3] == ("email", 0, 200_004)


def test_added_kinds_need_form_checksum_or_context(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00.", "DE89 3704 0044 0532 0130 01", "(487) 555-7209", "call 487-555-7209", "487-555-7209",
             "order no. (487) 555-7209", "+1 (487) 555-7209", "ssn 123-45-6789", "123-45-6789", "ssn 000-45-6789", "jo (at) mail (dot) com", "meet at noon dot"]
    kinds = {i: [s[0] for s in v] for i, v in _spans(spark, texts).items()}
    assert kinds == {0: ["iban"], 1: [], 2: ["tel"], 3: ["tel"], 4: [], 5: [], 6: ["phone"], 7: ["ssn"], 8: [], 9: [], 10: ["spelt_email"], 11: []}


def test_span_table_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "mail a@b.de"), (1, "mail a@b.de"), (None, None)], "doc_id long, text string")
    rows = pii.span_table(docs).collect()
    assert [tuple(r) for r in rows] == [(1, "email", 5, 11, "a@b.de", 1.0)] * 2
    assert pii.span_table(docs.limit(0)).count() == 0
    plan = docs.select(pii.find(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
