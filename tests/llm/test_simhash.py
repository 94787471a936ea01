import random

import pytest
import xxhash
from pyspark.sql import types as T

from gridloom.llm.simhash import ball_links, fingerprint, keep_one_per_group, near_duplicates


def plain_fingerprint(text, width=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: " " for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    ids = sorted(fps)
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "One two", "a b c", "É a\x0bB c d a b c", "x " * 70_000])
def test_fingerprint_equals_plain_form(text):
    got = fingerprint(None if text is None else text.encode()) & (1 << 64) - 1
    assert got == plain_fingerprint(text)


def test_links_equal_all_pairs(spark):
    rng = random.Random(5)
    words = {rng.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1}
    for w in list(words):
        for _ in range(4):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                w ^= 1 << b
            words.add(w)
    fps = dict(enumerate(sorted(words)))
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in fps.items()]
    from gridloom.llm.components import connected_components

    links = ball_links(spark.createDataFrame(signed, "node long, fp long"))
    for r in links.collect():
        assert bin(fps[r["a"]] ^ fps[r["b"]]).count("1") <= 3
    found = {i: i for i in fps} | {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert found == components(fps)


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("fp", T.StringType()), T.StructField("component_id", T.LongType())])


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(5, base, "x", 1), (3, base, None, 2), (3, base, None, 2), (9, base + " tail", "", 3), (7, None, None, None), (8, "", None, None), (1, "other words here " * 9, None, None), (None, base, None, None)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    want = components({i: plain_fingerprint(t) for i, t, *_ in rows if i is not None})
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == (want[r["doc_id"]] if r["doc_id"] is not None else want[3])
    kept = keep_one_per_group(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == SCHEMA.names
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect())[0] == 1
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_equal_ids_with_different_texts(spark):
    base, other = (" ".join(f"{c}{i}" for i in range(300)) for c in "vw")
    rows = [(5, base, "a", 1), (5, other, "b", 2), (9, base + " tail", None, 3), (8, other, None, None), (5, base, "c", 4), (5, base, "c", 4), (6, "alone here", None, 5), (None, base, None, 6)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = keep_one_per_group(docs).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(5, base), (5, other), (6, "alone here"), (0, base)])
    assert {tuple(r) for r in keep_one_per_group(docs.repartition(1)).collect()} == {tuple(r) for r in kept}
    got = near_duplicates(docs).collect()
    assert {r["component_id"] for r in got} == {5, 6} and len(got) == len(rows)


def test_ids_by_a_shuffle(spark, monkeypatch):
    from gridloom.llm import simhash

    base = " ".join(f"w{i}" for i in range(300))
    docs = spark.createDataFrame([(i, base if i % 2 else f"{i} own text {i} words", None, None) for i in range(20)], SCHEMA)
    want = {tuple(r) for r in keep_one_per_group(docs).collect()}
    monkeypatch.setattr(simhash, "MOST_SENT", 0)
    assert {tuple(r) for r in keep_one_per_group(docs).collect()} == want and len(want) == 11


def test_components_of_a_long_chain(spark):
    from gridloom.llm.components import connected_components

    chain = random.Random(5).sample(range(1000), 400)
    edges = spark.createDataFrame(list(zip(chain, chain[1:])), "a long, b long")
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert found == dict.fromkeys(chain, min(chain))
