import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from gridloom.llm.packing import ChunkEncoder, pack
from gridloom.llm.queries import tokenizer_path

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType()), T.StructField("part", T.LongType())])
TEXTS = [None, "", " \n\t", "Hello, World! It's 3.14 o'clock", "a | b|c || d", "x.., y._z _.a", "ΑΣ Σ İstanbul é é", "naïve\x1ctext\x85more end.", "<|endoftext|> '.s", "word " * 9000, "Word. Word, WORD.,"]


def reference(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_chunks_give_the_same_ids():
    encoder = ChunkEncoder(tokenizer_path(), cache=10)
    for texts in ([t or "" for t in TEXTS], [t or "" for t in reversed(TEXTS)], []):
        ids, n = encoder.encode(texts)
        want = reference(texts)
        assert n.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("length", [7, 4096])
def test_pack_equals_plain_cutting(spark, length):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], None, None), (None, "no id", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = pack(docs, tokenizer_path(), length=length, with_ids=True).collect()
    want = {i: w + [2] for i, w in enumerate(reference(TEXTS))}
    want[None] = reference(["no id"])[0] + [2]
    total = sum(len(w) for w in want.values()) + len(want[3])
    assert sum(r["length"] for r in got) == total
    place = 0
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        piece = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        data = np.array(piece, "<u4").tobytes()
        assert (bytes(r["ids"]), r["ids_crc32"]) == (data, zlib.crc32(data))
        assert r["doc_tokens"] == len(want[r["doc_id"]])
        assert length * r["sequence_id"] + r["offset"] == place
        assert 0 < r["length"] <= length - r["offset"]
        place += r["length"]
    assert place == total


def test_no_rows(spark):
    assert pack(spark.createDataFrame([], SCHEMA), tokenizer_path()).collect() == []
