"""From raw documents to token ids, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. ``run`` writes every stage's result as Parquet to the
shared checkpoint folder and reads it back as the next stage's ``docs``. All
stages but the last return the columns of their input; extra columns pass
through whatever their names are. Scratch tables of a stage go when its
result is written, that result when the next one is; the last belongs to the
application.

1. language_id: documents without a letter, or whose best language has a
   posterior below one half, go.
2. near_duplicates: of each group of documents linked by five-word shingles
   at similarity 0.8 or more, the one with the smallest id stays (of its rows
   one; rows that share an id go only as copies; rows without an id stay).
3. secrets: fixed-pattern and high-entropy strings are replaced; n_chars
   follows the text.
4. mixing: sources are mixed to weights 1, 2, 3, ... repeating; a document
   appears as often as the mix takes its words, rounded to whole documents
   (one without a word has nothing to take and does not appear).
5. bpe: (doc_id, n_tokens, ids, decoded_sha256); ids are little-endian
   unsigned 32-bit integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratal.llm.bpe import bpe_decode, bpe_encode
from stratal.llm.langid import UNKNOWN, identify_languages, train_on
from stratal.llm.mixing import mix
from stratal.llm.near_text import drop_near_duplicates
from stratal.llm.queries import _tokenizer
from stratal.llm.secrets import redact_secrets
from stratal.session import remove_path, scratch_path, scratch_scope

MIN_POSTERIOR = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select("doc_id", "text", F.struct("*").alias("row"))
    scored = identify_languages(rows, train_on(docs), keep=["row"])
    return scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_POSTERIOR)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, shingle=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else clean


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = F.xxhash64("doc_id", "source", "text")
    taken = mix(docs.select(key.alias("key"), "text", "source"), id_col="key")
    # equal rows share what is taken of them
    copies = (taken.groupBy("key").agg(F.sum("taken").alias("t"), F.sum("size").alias("s"))
              .select("key", F.round(F.col("t") / F.nullif(F.col("s"), F.lit(0))).cast("int").alias("copies")).where("copies > 0"))
    rows = docs.select(key.alias("key"), F.struct("*").alias("row")).join(copies, "key")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = _tokenizer("word_bpe_49k.json")
    decoded = bpe_decode(bpe_encode(docs, path), path)
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing),
          ("bpe", bpe)]

#: SQL cannot express the sketches, the entropy windows or the tokenizer; the
#: pipeline is tested against a brute-force version (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark, f"pipeline-run-{name}"):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
