import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from gridloom.llm import suffix_dedup as S

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("run", T.StringType()), ("id", T.LongType()))])


def plain(texts, width):
    seen, out = set(), []
    for t in texts:
        covered = bytearray(len(t))
        for s in range(len(t) - width + 1):
            if t[s : s + width] in seen:
                covered[s : s + width] = b"\1" * width
            seen.add(t[s : s + width])
        kept = bytes(c for c, m in zip(t, covered) if not m)
        spans = sum(1 for i, m in enumerate(covered) if m and not (i and covered[i - 1]))
        out.append((len(t), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = prose(60), prose(25)
    texts = [None, "", "short", "a" * 1000, "a" * 99, "ab" * 300, passage]
    for _ in range(25):
        texts.append(prose(rng.randint(5, 60)) + rng.choice(["", passage, passage[20:-30], line, line + line]) + prose(rng.randint(0, 40)))
    texts += [texts[9], texts[9][:-1], "x" + texts[9], texts[10] + texts[11], texts[10].replace("a", "b", 2)]
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_removal_equals_brute_force(spark, seed, monkeypatch):
    texts = corpus(seed)
    rows = [(i * 3, t, "x", -i) for i, t in enumerate(texts)]
    random.Random(seed).shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = sorted(tuple(r) for r in S.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = plain([(t or "").encode() for t in texts], 100)
    assert got == [(i * 3, *w) for i, w in enumerate(want)]


def test_repeated_and_missing_ids(spark):
    base = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(400))
    rows = [(2, base, None, None), (1, base[50:], None, None), (None, base, None, None), (2, base, None, None)]
    got = S.remove_repeats(spark.createDataFrame(rows, SCHEMA), with_text=True).collect()
    want = plain([x.encode() for x in (base[50:], base, base, base)], 100)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"], r["kept_sha256"]) for r in got) == sorted(
        (i is None, i or 0, w[1], w[3]) for i, w in zip((1, 2, 2, None), want)
    )
    assert S.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_parts_of_long_texts_hold_every_window():
    text = bytes(np.random.default_rng(0).integers(97, 101, 5000, dtype=np.uint8))
    whole = S.parse([text], 100)
    held = []
    for rows, offsets, parts in S._groups([b"ab", text, b""], 100, 700):
        p = S.parse(parts, 100)
        for t, s, n in zip(p["text"], p["start"], p["windows"]):
            if rows[t] == 1:
                held += range(offsets[t] + s, offsets[t] + s + n)
    assert sorted(held) == list(range(len(text) - 99)) and whole["windows"].sum() == len(text) - 99


def test_equal_windows_have_equal_hashes_only():
    text = np.frombuffer(b"abracadabra" * 40, np.uint8)
    _, hashes = S.window_hashes(text, 100)
    windows = [text[i : i + 100].tobytes() for i in range(len(text) - 99)]
    assert len(set(windows)) == len(set(hashes.tolist())) == len(set(zip(windows, hashes.tolist())))


def test_merge_ranges():
    doc, start, n = (np.array(x) for x in ([1, 1, 1, 2, 2, 1], [0, 5, 3, 0, 10, 20], [3, 1, 2, 4, 2, 1]))
    assert [x.tolist() for x in S.merge_ranges(doc, start, n)] == [[1, 1, 2, 2], [0, 20, 0, 10], [6, 1, 4, 2]]
