import hashlib
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm import pii
from gridloom.llm.queries import op7_pii

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("row", T.StringType()), ("found", T.LongType()), ("base", T.StringType()))])


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
)


def plain(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in PLAIN for m in re.finditer(p, text or "") if ok(m[0])]


TEXTS = [
    None,
    "",
    "é ñ mail a.b@c.de, then x@y.z_q@r.s.t and a@b@c.d.e; @@ a@.b",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 9999.1.1.1 1.1.1 1.2.3.4.",
    "4111 1111-1111 1111 4111111111111112 0000000000000 5500-0000-0000-0004 1 2 3",
    "+1 (017) 555-7713 and +44 20 7946 0958. +1.2.3.4 55555555 +123 +1 2+3 456 789 012 345",
    "x" * 50_000 + "@" + "y" * 10 + ".com " + "1 " * 20_000 + "7" * 30_000,
    "\U0001f600 card 4111111111111111\ntail@host.org",
]


def rows(spark):
    data = [(i, t, None, None, "b") for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], None, None, None), (None, TEXTS[4], None, None, None)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def test_base_spans_equal_plain_patterns(spark):
    got = pii.detect(rows(spark)).select("doc_id", pii.written(F.col("base")).alias("base")).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        assert r["base"] == ",".join(plain(TEXTS[r["doc_id"] if r["doc_id"] is not None else 4]))


def test_query_digest(spark, tmp_path):
    rows(spark).where("doc_id is not null").dropDuplicates(["doc_id"]).write.parquet(f"{tmp_path}/documents.parquet")
    for r in op7_pii(spark, str(tmp_path)).collect():
        want = plain(TEXTS[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w.startswith(k + ":") for w in want) for k in pii.KINDS]
        assert set(want) <= set(r["spans"].split(","))


def test_reliabilities_are_recovered():
    patterns = [("k", ("1", "1", "1"), 90.0), ("k", ("1", "0", "1"), 10.0), ("k", ("0", "1", "0"), 300.0), ("k", ("0", "0", "0"), 600.0), ("k", ("1", "-", "1"), 20.0)]
    post = pii.expectation_maximisation(patterns)
    assert post["k", ("1", "1", "1")] > 0.9 and post["k", ("1", "-", "1")] > 0.9 and post["k", ("0", "0", "0")] < 0.1
    assert pii.expectation_maximisation([]) == {}


def test_added_spans_follow_the_votes(spark):
    found = [(i, f"call my phone {300 + i % 60:03d}-555-{1000 + i} or +1 (212) 555-{1000 + i}") for i in range(200)]
    docs = spark.createDataFrame(found + [(900, "phone: 415-555-2671"), (901, "plain words")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in pii.detect(docs).collect()}
    text = dict(found)[5]
    assert {text[s["start"] : s["end"]] for s in got[5]["base"]} == {"+1 (212) 555-1005"}
    for r in got.values():
        spans = sorted((s["start"], s["end"]) for s in [*r["base"], *r["added"]])
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert not got[901]["base"] and not got[901]["added"]


def test_redaction(spark):
    model = pii.fit(pii.spans(pii.candidates(rows(spark))))
    got = {r["doc_id"]: r["text"] for r in pii.redact(rows(spark).where("doc_id is not null"), model).collect()}
    assert got[0] is None and got[1] == ""
    assert got[7] == "\U0001f600 card [CARD]\n[EMAIL]"
    assert "@c.de" not in got[2] and got[2].startswith("é ñ mail [EMAIL], then")
    assert pii.redact(rows(spark).limit(0), model).collect() == []
    assert pii.detect(rows(spark).limit(0)).collect() == []
