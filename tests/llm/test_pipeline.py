import zlib
from collections import Counter

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from gridloom.llm.queries import tokenizer_path  # noqa: E402
from gridloom.llm.simhash import fingerprint  # noqa: E402

EN = "the quick brown fox jumps over the lazy dog and runs away from the old house near a river "
DE = "der schnelle braune fuchs springt über den faulen hund und läuft vom alten haus am fluss weg "


def documents():
    rows = []
    for i in range(80):
        words = (DE if i % 3 == 0 else EN).split()
        text = " ".join(words[(i * 7 + k * (3 + i % 5)) % len(words)] + ("x" * (i % 4)) for k in range(40 + i))
        rows.append((i, text, "de" if i % 3 == 0 else "en", f"s{i % 3 if i % 2 else 0}", len(text)))
    rows += [(100, rows[5][1], "en", "s1", 1), (101, None, None, "s1", None), (102, "12 34 !!", None, "s2", 8), (103, "", "en", None, 0)]
    rows += [(104, f"{EN}write to jane.doe@example.org or +1 (212) 555-0199 now", None, "s2", 9)]
    return rows


def test_stages_against_plain_forms(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{len(seen)}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs.collect())
        if len(seen) < len(corpus_pipeline.STAGES):
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    language, unique, clean, mixed, pieces = seen
    assert {r["doc_id"] for r in language} == {r[0] for r in rows} - {101, 102, 103}
    assert {r["doc_id"]: r["lang"] for r in language}[104] == "en"
    # near duplicates: components of fingerprints at three or fewer bits, smallest id kept
    fps = {r["doc_id"]: fingerprint(r["text"].encode(), 5) & (1 << 64) - 1 for r in language}
    up = {i: i for i in fps}
    for _ in fps:
        for a in fps:
            for b in fps:
                if bin(fps[a] ^ fps[b]).count("1") <= 3:
                    up[a] = min(up[a], up[b])
    assert {r["doc_id"] for r in unique} == {i for i, c in up.items() if i == c}
    assert 100 not in {r["doc_id"] for r in unique}
    before = {r["doc_id"]: r["text"] for r in unique}
    for r in clean:
        want = before[r["doc_id"]].replace("jane.doe@example.org", "[EMAIL]").replace("+1 (212) 555-0199", "[PHONE]")
        assert r["text"] == want and r["n_chars"] == len(want)
    assert len(clean) == len(unique)
    uses = Counter(r["doc_id"] for r in mixed)
    assert set(uses) == set(before) and max(uses.values()) <= 2
    assert {(r["doc_id"], r["text"]) for r in mixed} == {(r["doc_id"], r["text"]) for r in clean}
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    ids = {r["doc_id"]: t.encode(r["text"], add_special_tokens=False).ids + [2] for r in clean}
    place = 0
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(piece, "<u4").tobytes()) == r["ids_crc32"]
        assert 4096 * r["sequence_id"] + r["offset"] == place
        place += r["length"]
    assert place == sum(len(ids[i]) * n for i, n in uses.items())


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
