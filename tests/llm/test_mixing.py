import math
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import types as T

from gridloom.llm import mixing
from gridloom.llm.queries import oracle_sql, op4_mixing

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("source", T.StringType()), ("tokens", T.StringType()), ("epoch", T.LongType()))])


def corpus(spark):
    rows = []
    for i in range(300):
        source = "hot" if i % 3 == 0 else [None, "", "a", "b", "tiny"][min(4, i % 7)] if i % 11 else "tiny"
        rows.append((i, "x" * (i * 37 % 400), source, None, None))
    rows += [(1000, None, "void", None, None), (1001, "", "void", None, None), (7, "twice", "a", None, None), (7, "twice", "a", None, None), (None, "no id", "b", None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def plain_weights(docs, limit):
    totals = defaultdict(int)
    for r in docs.collect():
        totals[r["source"]] += (len((r["text"] or "").encode()) + 3) // 4
    p = {s: t / sum(totals.values()) for s, t in totals.items() if t}
    lo, hi = 0.0, 1.0
    ratio = lambda a: max(x ** (a - 1) for x in p.values()) / min(x ** (a - 1) for x in p.values())
    if ratio(0.0) <= limit:
        hi = 0.0
    else:
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if ratio(mid) <= limit else (mid, hi)
    z = sum(x**hi for x in p.values())
    return totals, {s: x**hi / z for s, x in p.items()}


def test_weights(spark):
    docs = corpus(spark)
    totals, want = plain_weights(docs, 2.0)
    got = {r["source"]: r for r in mixing.weights(docs, 2.0).collect()}
    for s, t in totals.items():
        r = got["null" if s is None else "=" + s]
        assert r["tokens"] == t
        assert r["weight"] == pytest.approx(want.get(s, 0.0))
        assert 1 <= r["repetition"] <= 2 + 1e-9 and r["whole"] >= 1


def test_entropy_target(spark):
    docs = corpus(spark)
    got = [r["weight"] for r in mixing.weights(docs, None, target_entropy=1.6).collect() if r["weight"]]
    assert -sum(w * math.log(w) for w in got) == pytest.approx(1.6, abs=1e-6)
    with pytest.raises(ValueError):
        mixing.weights(docs, 2.0, 1.0)


def test_every_use(spark):
    docs = corpus(spark)
    per_source = mixing.weights(docs, 2.0).cache()
    used = mixing.mix(docs, per_source, block_tokens=500).collect()
    quota = {r["source"]: r for r in per_source.collect()}
    by = defaultdict(list)
    for r in used:
        by[r["source"], r["epoch"]].append(r)
    held = defaultdict(list)
    for r in docs.collect():
        held[r["source"]].append(r["doc_id"])
    for (source, epoch), rows in by.items():
        q = quota["null" if source is None else "=" + source]
        ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)
        whole = sorted((i is None, i or 0) for i in held[source])
        assert ids == whole if epoch < q["whole"] else set(ids) <= set(whole)
        rows.sort(key=lambda r: (r["before_tokens"], r["tokens"]))
        at = epoch * q["tokens"]
        for r in rows:
            assert r["before_tokens"] == at or epoch == q["whole"]
            at = r["before_tokens"] + r["tokens"]
            assert at <= r["budget_tokens"]
    repeated = mixing.repeat_documents(docs, 2.0, block_tokens=500)
    assert repeated.columns == docs.columns
    count = defaultdict(int)
    for r in used:
        count[r["doc_id"]] += 1
    again = defaultdict(int)
    for r in repeated.collect():
        again[r["doc_id"]] += 1
    assert again == count


def test_sql(spark, tmp_path):
    for name, docs in (("a", corpus(spark)), ("b", corpus(spark).limit(0)), ("c", corpus(spark).where("source = 'a'"))):
        docs.select("doc_id", "text", "source").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = sorted(map(str, (tuple(r) for r in op4_mixing(spark, f"{tmp_path}/{name}").collect())))
        con = duckdb.connect()
        con.sql(f"create view documents as select * from '{tmp_path}/{name}/documents.parquet/*.parquet'")
        want = sorted(map(str, con.sql(oracle_sql()["op4_mixing"]).fetchall()))
        assert got == want


def test_order_of_the_mixture(spark):
    """Sources side by side in their weights from beginning to end; a document's uses apart."""
    rows = [(i, f"text {i} " * 20, "large" if i % 5 else "small", None, None) for i in range(2000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    mixed = mixing.repeat_documents(docs, 2.0, block_tokens=1 << 40)
    assert mixed.columns == docs.columns
    order = [(r["doc_id"], r["source"]) for r in mixed.coalesce(1).collect()]
    used = {i: [k for k, (j, _) in enumerate(order) if j == i] for i in range(2000)}
    twice = [v for v in used.values() if len(v) > 1]
    apart = sorted(b - a for a, b in twice)  # each epoch is a permutation of its own
    assert len(twice) > 300 and apart[len(apart) // 20] > 100 and sum(d == 1 for d in apart) < 3
    assert [i for i, _ in order] != sorted(i for i, _ in order)
    share = sum(s == "small" for _, s in order) / len(order)
    for lo in range(0, len(order) - 400, 400):
        assert abs(sum(s == "small" for _, s in order[lo : lo + 400]) / 400 - share) < 0.12
    blocks = mixing.repeat_documents(docs, 2.0, block_tokens=500)
    assert sorted(r["doc_id"] for r in blocks.collect()) == sorted(i for i, _ in order)
    assert mixing.repeat_documents(docs.limit(0)).collect() == []


def test_bases_over_stretches(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCH", 3)
    docs = corpus(spark)
    per_source = mixing.weights(docs, 2.0)
    few = {tuple(r) for r in mixing.mix(docs, per_source, block_tokens=300).collect()}
    monkeypatch.undo()
    assert few == {tuple(r) for r in mixing.mix(docs, per_source, block_tokens=300).collect()}


def test_hot_ids(spark, tmp_path, monkeypatch):
    """A third of the rows with one id, as many without any: the rows of the SQL, over stretches."""
    monkeypatch.setattr(mixing, "COPIES", 7)
    rows = [(5 if i % 3 == 0 else None if i % 3 == 1 else i, "x" * (40 if i % 3 < 2 else i % 90), "a" if i % 4 else "b") for i in range(900)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, (tuple(r) for r in op4_mixing(spark, str(tmp_path)).collect())))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(map(str, con.sql(oracle_sql()["op4_mixing"]).fetchall()))
    assert len(got) >= 900


def test_hot_id_spreads_over_the_mixture(spark):
    """A third of the rows share an id, as many have none, all texts differ: neither stands together."""
    rows = [(5 if i % 3 == 0 else None if i % 3 == 1 else i, f"text {i} " * 9, "a" if i % 4 else "b", None, None) for i in range(1800)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    order = [r["doc_id"] for r in mixing.repeat_documents(docs, 2.0, block_tokens=1 << 40).coalesce(1).collect()]
    assert {r[0] for r in rows} == set(order) and len(order) >= len(rows)
    for hot in (5, None):
        longest = run = 0
        for i in order:
            run = run + 1 if i == hot else 0
            longest = max(longest, run)
        assert longest < 20
