import hashlib
import random
import re

from pyspark.sql import functions as F

from waypost.llm.pii import find_spans, listed, of_kinds, redact

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute(text):
    text = text or ""
    out = []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = [
        ("email", EMAIL, lambda m: True),
        ("ip", IP, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", CARD, lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", PHONE, lambda m: 9 <= len(digits(m)) <= 15),
    ]
    for k, (kind, pattern, ok) in enumerate(rules):
        out += [(m.start(), k, kind, m.end()) for m in pattern.finditer(text) if ok(m)]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def test_base_spans_equal_brute_force(spark):
    r = random.Random(5)
    bits = ["a", "x.y", "@", "b.co", "-", "_", " ", "+", "4111111111111111", "4111 1111 1111 1111", "1.2.3.4",
            "256.1.1.1", "00255.0.0.1", ".", "é", "😀", "(0)", "79927398713", "49 30 1234567", "\n", "12", "%"]
    texts = ["".join(r.choice(bits) for _ in range(r.choice([1, 3, 8, 25]))) for _ in range(1500)]
    texts += [None, "", "9" * 9000, "a" * 3000, "a@b." + "c." * 2000 + "d", "+1" + "2" * 4000, "1." * 2000 + "1"]
    docs = spark.createDataFrame([(i, t, "v", 1) for i, t in enumerate(texts)], "doc_id long, text string, kind string, row int")
    got = find_spans(docs).select("doc_id", listed(of_kinds(F.col("spans"), "email", "ip", "card", "phone")).alias("s"))
    found = {x.doc_id: x.s for x in got.collect()}
    assert len(found) == len(texts)
    assert {i: (t, found[i]) for i, t in enumerate(texts) if found[i] != brute(t)} == {}


def test_very_long_runs(spark):
    texts = ["9" * 300_000, "a" * 300_000, "a." * 200_000 + "@", "+1" + "2" * 300_000, "1." * 200_000, "4 " * 200_000, "A" * 300_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: len(r.spans) for r in find_spans(docs).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 0, 4: 50_000, 5: 0, 6: 0}


def test_account_numbers_context_and_redaction(spark):
    docs = spark.createDataFrame(
        [(1, "my IBAN is GB82 WEST 1234 5698 7654 32."), (2, "code GB82 WEST 1234 5698 7654 33."), (3, "call +49 30 1234567 or a@b.co")],
        "doc_id long, text string",
    )
    spans = {r.doc_id: [(s.kind, s.value, round(s.score, 2)) for s in r.spans] for r in find_spans(docs).collect()}
    assert spans[1] == [("iban", "GB82 WEST 1234 5698 7654 32", 1.0)]
    assert spans[2] == []
    assert [s[0] for s in spans[3]] == ["phone", "email"] and spans[3][0][2] == 0.8
    red = {r.doc_id: r.redacted for r in redact(docs).collect()}
    assert red[3] == "call [phone] or [email]" and red[2] == "code GB82 WEST 1234 5698 7654 33."


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a@b.co"), (1, "a@b.co"), (1, "a@b.co"), (2, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), len(r.spans)) for r in find_spans(docs).collect()) == [("1", 1), ("1", 1), ("2", 0), ("None", 1)]
    assert find_spans(docs.limit(0)).collect() == []


def test_context_turns_a_rejected_span_into_an_accepted_one(spark):
    key = "Zq81hTb3Lw0pXs6Vn2Kd"
    texts = [
        "part 123-45-6789 in stock", "social security 123-45-6789 on file", "ssn 000-45-6789",
        f"see {key} there", f"api key: {key}.", f"token {'a' * 30}", "ssn " + "x" * 41 + " 123-45-6789",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.value, round(s.score, 2)) for s in r.spans] for r in find_spans(docs).collect()}
    assert found == {
        0: [], 1: [("ssn", "123-45-6789", 0.6)], 2: [], 3: [], 4: [("secret", key, 0.6)], 5: [], 6: [],
    }
    everything = {r.doc_id: len(r.spans) for r in find_spans(docs, accept=0.0).collect()}
    assert everything == {0: 1, 1: 1, 2: 0, 3: 1, 4: 1, 5: 0, 6: 1}


def test_redaction_keeps_repeated_and_null_ids(spark):
    docs = spark.createDataFrame(
        [(None, "a@b.co", 1), (1, "a@b.co", 2), (1, "x", 3), (1, "x", 4), (2, None, 5), (3, "", 6)],
        "doc_id long, text string, spans int",
    )
    got = sorted((str(r.doc_id), r.redacted) for r in redact(docs).where("redacted IS NOT NULL").collect())
    assert got == [("1", "[email]"), ("1", "x"), ("1", "x"), ("3", ""), ("None", "[email]")]
    assert redact(docs).where("redacted IS NULL").first().doc_id == 2
    assert redact(docs.limit(0)).collect() == []
