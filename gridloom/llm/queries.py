"""The registered queries of this subpackage: thin wrappers with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.ann import nearest
from gridloom.llm.common import materialize, table
from gridloom.llm import langid, mixing, pii, toxicity
from gridloom.llm.html_extract import extract
from gridloom.llm.packing import pack
from gridloom.llm.simhash import near_duplicates
from gridloom.llm.suffix_dedup import remove_repeats
from gridloom.llm.media import store_texts


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary files lie on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), length=4096, end_id=2)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), most_rows=6000)
    found = toxicity.score(docs, model)
    offending = F.array_join(F.transform("offending", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("offending")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted")
    return found.select("doc_id", langid.held_out("doc_id", 5, 0).alias("held_out"), "score", predicted, "worst_start", "worst_end", offending)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    per_source = materialize(mixing.weights(docs, max_repetition=2.0), "weights")
    used = mixing.mix(docs, per_source, block_tokens=250_000, seed=42)
    return used.drop("key", "whole")


OP4_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || source, 'null') AS source, (strlen(coalesce(text, '')) + 3) // 4 AS size FROM documents
),
sums AS (SELECT source, sum(size)::BIGINT AS tokens FROM docs GROUP BY source),
share AS (SELECT list(tokens / (SELECT sum(tokens) FROM sums)::DOUBLE) AS p FROM sums WHERE tokens > 0),
bisect AS (
  SELECT 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN lo ELSE (lo + hi) / 2 END, CASE WHEN ok THEN (lo + hi) / 2 ELSE hi END
  FROM (
    SELECT step, lo, hi,
      list_max(list_transform(p, lambda x: pow(x, (lo + hi) / 2 - 1))) <= 2.0 * list_min(list_transform(p, lambda x: pow(x, (lo + hi) / 2 - 1))) AS ok
    FROM bisect, share WHERE step < 60
  )
),
solved AS (
  SELECT CASE WHEN list_max(list_transform(p, lambda x: 1 / x)) <= 2.0 * list_min(list_transform(p, lambda x: 1 / x)) THEN 0.0 ELSE hi END AS alpha, p
  FROM bisect, share WHERE step = 60
),
reps AS (
  SELECT source, tokens,
    CASE WHEN tokens > 0 THEN pow(tokens / (SELECT sum(tokens) FROM sums)::DOUBLE, alpha - 1) / list_min(list_transform(p, lambda x: pow(x, alpha - 1))) ELSE 1.0 END AS repetition
  FROM sums, solved
),
quota AS (
  SELECT source, tokens, floor(repetition + 1e-9)::BIGINT AS whole,
    greatest(0, floor((repetition - floor(repetition + 1e-9)) * tokens))::BIGINT AS rest
  FROM reps
),
uses AS (
  SELECT doc_id, source, size, tokens, whole, rest, epoch, md5('42:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM docs JOIN quota USING (source), unnest(range(0, whole + CASE WHEN rest > 0 THEN 1 ELSE 0 END)) AS t(epoch)
),
placed AS (
  SELECT *, floor(('0x' || substr(key, 1, 8))::BIGINT * ceil(greatest(tokens, 1) / 250000.0) / 4294967296.0)::BIGINT AS block,
    coalesce(sum(size) OVER (PARTITION BY source, epoch ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM uses
)
SELECT doc_id, CASE WHEN source <> 'null' THEN substr(source, 2) END AS source, epoch, size AS tokens, block,
  (epoch * tokens + before)::BIGINT AS before_tokens, (whole * tokens + rest)::BIGINT AS budget_tokens
FROM placed WHERE epoch < whole OR before + size <= rest
"""


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), width=100)


def op6_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_texts(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *map(number, pii.KINDS),
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.select("doc_id", "text", "lang"))
    picked = docs.select("doc_id", langid.held_out("doc_id", 3, 1).alias("held_out"), "text")
    return langid.identify(picked, model).select("doc_id", "held_out", "lang_pred", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_packing": op1_packing, "op2_simhash": op2_simhash, "op3_toxicity": op3_toxicity, "op4_mixing": op4_mixing, "op5_suffix": op5_suffix, "op6_webp": op6_webp, "op7_pii": op7_pii, "op8_neighbours": op8_neighbours, "op9_html": op9_html, "op10_language": op10_language}


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": OP4_SQL}
