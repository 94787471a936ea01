import math
from collections import defaultdict

import numpy as np
from pyspark.sql import types as T

from gridloom.llm import langid as L

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("score", T.StringType()), ("lang_pred", T.LongType()))])
EN = "the quick brown fox jumps over the lazy dog and runs away from the old house "
DE = "der schnelle braune fuchs springt über den faulen hund und läuft vom alten haus weg "


def plain_bits(counts, text):
    """Escape method C, byte by byte."""
    total, kinds, seen = ([defaultdict(float) for _ in range(4)] for _ in range(3))
    for code, n in counts.items():
        for order in range(4):
            gram = code % 256 ** (order + 1)
            kinds[order][gram // 256] += gram not in seen[order]
            seen[order][gram] += n
            total[order][gram // 256] += n
    symbols, bits = b"\n\n\n" + text.lower(), 0.0
    for i in range(3, len(symbols)):
        for order in (3, 2, 1, 0, -1):
            if order < 0:
                bits += 8
                break
            gram = int.from_bytes(symbols[i - order : i + 1], "big")
            if total[order][gram // 256] == 0:
                continue
            both = total[order][gram // 256] + kinds[order][gram // 256]
            if gram in seen[order]:
                bits += math.log2(both / seen[order][gram])
                break
            bits += math.log2(both / kinds[order][gram // 256])
    return bits


def gram_counts(text):
    b, out = b"\n\n\n" + text.lower(), defaultdict(int)
    for i in range(3, len(b)):
        out[int.from_bytes(b[i - 3 : i + 1], "big")] += 1
    return out


def test_code_lengths_equal_plain_form(monkeypatch):
    texts = [b"", b"a", EN.encode(), DE.encode() * 3, "совсем другое письмо".encode(), bytes(range(256))]
    counts = [gram_counts(EN.encode() * 2 + b"\xff\x00"), gram_counts(DE.encode()), gram_counts("письмо и слово".encode())]
    sides = [(np.array(sorted(c), np.uint32), np.array([c[k] for k in sorted(c)], float)) for c in counts]
    trees = L.build_trees(["x", "y", "z"], sides)
    got = L.code_lengths(texts, trees)
    for t, row in zip(texts, got):
        for c, g in zip(counts, row):
            assert abs(g - plain_bits(c, t)) < 1e-2
    pieces = L._pieces
    monkeypatch.setattr(L, "_pieces", lambda t: pieces(t, 11))
    assert np.allclose(L.code_lengths(texts, trees), got)


def test_places():
    rng = np.random.default_rng(3)
    codes = np.unique(np.append(rng.integers(0, 1 << 32, 5000), [0, (1 << 32) - 1])).astype(np.uint32)
    asked = np.concatenate([codes, rng.integers(0, 1 << 32, 5000).astype(np.uint32)])
    at = L.Places(codes).find(asked)
    known = np.isin(asked, codes)
    assert (codes[at[known]] == asked[known]).all() and (at[~known] == -1).all()
    assert (L.Places(codes[:0]).find(asked) == -1).all()


def test_counts_cover_all_rows(spark):
    rows = [(EN, "en"), (EN, "en"), (DE, "de"), (None, "de"), ("", "en"), ("x", None)]
    got = {(r["lang"], r["code"]): r["n"] for r in L.count_grams(spark.createDataFrame(rows, "text string, lang string").repartition(3)).collect()}
    want = defaultdict(int)
    for text, lang in rows[:3]:
        b = b"\n\n\n" + text.encode().lower()
        for i in range(3, len(b)):
            want[lang, int.from_bytes(b[i - 3 : i + 1], "big")] += 1
    assert got == dict(want)


def test_held_out_accuracy_and_odd_rows(spark):
    rows = []
    for i in range(60):
        words = (EN if i % 2 else DE).split()
        rows.append((i, " ".join(words[(i * 3 + k * 5) % len(words)] for k in range(12)), "en" if i % 2 else "de", None, None))
    rows += [(100, None, "en", None, None), (101, "", None, None, None), (102, "12 -- !?", "de", None, None), (None, EN, "en", None, None), (3, rows[3][1], "en", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = L.identify(docs, L.learn(docs)).collect()
    assert len(found) == len(rows)
    for r in found:
        odd = r["doc_id"] in (100, 101, 102)
        assert r["lang_pred"] == ("und" if odd else r["lang"])
        assert 0 <= r["score"] <= 1
    empty = spark.createDataFrame([], SCHEMA)
    assert L.identify(empty, L.learn(empty)).collect() == []
    assert {r["lang_pred"] for r in L.identify(docs, L.learn(empty)).collect()} == {"und"}


def test_a_rare_language_beside_a_large_one(spark):
    large = [(f"{EN} {i} {i * 7919}", "en") for i in range(400)]
    rare = [("ένα μικρό κείμενο για δοκιμή", "el"), ("ისევ ერთი პატარა ტექსტი", "ka")]
    model = L.train(spark.createDataFrame(large + rare, "text string, lang string").repartition(4))
    assert model.langs == ["el", "en", "ka"]
    asked = spark.createDataFrame([(0, "μικρό κείμενο"), (1, "პატარა ტექსტი"), (2, "the lazy dog")], "doc_id bigint, text string")
    assert [r["lang_pred"] for r in L.identify(asked, model).orderBy("doc_id").collect()] == ["el", "ka", "en"]


def test_passes_give_what_one_gives(spark):
    docs = spark.createDataFrame([(i, (EN, DE, EN + DE, "", None, "la casa")[i], (("en", "de", "fr", "es")[i % 4])) for i in range(6)], "doc_id bigint, text string, lang string")
    whole, parts = L.train(docs), L.train(docs, most_bytes=1)
    assert len(whole.shards) == 1 and len(parts.shards) == len(whole.langs) > 2
    one, many = ({r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.identify(docs, m).collect()} for m in (whole, parts))
    assert {k: v[0] for k, v in one.items()} == {k: v[0] for k, v in many.items()}
    assert np.allclose([one[k][1] for k in sorted(one)], [many[k][1] for k in sorted(one)])


def test_counting_starts_anew_where_a_task_holds_too_many(spark):
    rows = spark.createDataFrame([(EN * 2, "en"), (DE, "de"), (EN, "fr")] * 5, "text string, lang string").coalesce(1)
    assert sorted(map(tuple, L.count_grams(rows, most_held=3).collect())) == sorted(map(tuple, L.count_grams(rows).collect()))
