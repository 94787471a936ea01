import random
import zlib

import numpy as np
from pyspark.sql import types as T

from gridloom.llm import toxicity as X
from gridloom.llm.langid import held_out

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("score", T.StringType()), ("worst_start", T.LongType()))])


def corpus(n=600, seed=0):
    rng = random.Random(seed)
    clean = [f"{a}{b}" for a in ("ra", "lo", "mi", "te", "nu") for b in ("ban", "dor", "fel", "gus", "hin")]
    bad = ["grotty", "vile", "foulmouth", "foulness"]
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        sentences = [" ".join(rng.choice(clean) for _ in range(rng.randint(3, 9))) for _ in range(rng.randint(1, 40))]
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(bad)
        rows.append((i, ". ".join(s.capitalize() for s in sentences) + "."))
        labels.append((i, int(toxic)))
    return rows, labels


def test_document_labels_find_sentences(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    model = X.learn(docs, spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id bigint, toxic int"))
    held = {r["doc_id"] for r in docs.where(held_out("doc_id", 5, 0)).collect()}
    truth, text = dict(labels), dict(rows)
    got = {r["doc_id"]: r for r in X.score(docs, model).collect()}
    right = sum((got[i]["score"] >= 0.5) == bool(truth[i]) for i in held)
    assert len(held) > 60 and right / len(held) > 0.97
    for i in held:
        if truth[i] and got[i]["score"] >= 0.5:
            found = text[i][got[i]["worst_start"] : got[i]["worst_end"]].lower()
            assert any(w in found for w in ("grotty", "vile", "foul"))
        if not truth[i]:
            assert got[i]["worst_start"] is None


def test_scores_equal_plain_noisy_or(spark):
    model = X.ToxicModel({"bad": 5.0, "awfu*": 4.0, "fine": -1.0}, -4.0, 0.1)
    texts = ["bad day. fine day\nAwfully so! bad BAD", "awful", "x. y. z", "..."]
    for t, r in zip(texts, sorted(X.score(spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA), model).collect(), key=lambda r: r["doc_id"])):
        none = np.prod([1 - 1 / (1 + np.exp(-z)) for z in X.sentence_logits(t, model)])
        assert abs(r["score"] - (1 - none)) < 1e-9 and r["sentences"] == len(X.sentences(t))


def test_all_offending_sentences(spark):
    model = X.ToxicModel({"bad": 5.0, "mild": 2.0}, -3.0, 0.1)
    text = "Bad one. A fine one. Mild one!\nbad bad two"
    r = X.score(spark.createDataFrame([(1, text, None, None)], SCHEMA), model).first()
    assert [text[s["start"] : s["end"]] for s in r["offending"]] == ["Bad one.", "bad bad two"]
    assert all(s["probability"] > 0.5 for s in r["offending"])


def test_conflicting_labels_are_toxic(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(X, "fit_noisy_or", lambda texts, labels: X.ToxicModel({t: float(v) for t, v in zip(texts, labels)}, 0.0, 0.5))
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:2]
    docs = spark.createDataFrame([(ids[0], "b", None, None), (ids[0], "a", None, None), (ids[1], "c", None, None)], SCHEMA)
    for order in (1, -1):
        labels = [(ids[0], 0), (ids[0], 1), (ids[1], 0)][::order]
        seen[order] = X.learn(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).weight
    assert seen[1] == seen[-1] == {"a": 1.0, "c": 0.0}


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None), (2, "", None, None), (None, "bad", None, None), (3, "bad " * 50_000, None, None), (3, "bad", None, None)], SCHEMA)
    none = X.learn(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert all(0 <= r["score"] <= 1 for r in X.score(docs, none).collect())
    model = X.ToxicModel({"bad": 9.0}, -4.0, 0.1)
    got = X.score(docs, model).collect()
    assert len(got) == 5 and sorted(r["score"] for r in got)[:2] == [0.0, 0.0]
    assert X.score(docs.limit(0), model).collect() == []
    assert X.fit_noisy_or(["a", "b"], np.array([1, 1])).base == 1.0
