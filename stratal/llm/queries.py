"""The registered queries of the operators: each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratal.llm import toxicity
from stratal.llm.bpe import bpe_decode, bpe_encode
from stratal.llm.huffman import token_round_trip
from stratal.llm.langid import held_out, identify_languages, train_on
from stratal.llm.licenses import scan_licenses
from stratal.llm.mixing import mix
from stratal.llm.near_text import near_duplicate_texts
from stratal.llm.near_vector import near_duplicate_vectors
from stratal.llm.secrets import scan_secrets
from stratal.llm.spelling import count_words, spelling_variants
from stratal.llm.vector_codes import books_text, compress_vectors
from stratal.llm.voronoi import top_k
from stratal.llm.warc import assemble_captures, read_records, write_captures
from stratal.session import materialize, scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    """The place of a public tokenizer file (the operators take any path)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    write_captures(_table(spark, sf_dir, "pages"), path)
    # parsed once; the result needs what was computed from the bodies, not the bodies
    records = read_records(spark, path).withColumn("body", F.lit(None).cast("binary"))
    captures = assemble_captures(materialize(records, "warc-records"))
    page = F.element_at(F.col("metadata"), 1)["page_id"]
    r = F.col("response")
    rows = materialize(captures.select(
        "capture_id", page.alias("page_id"), r["payload_bytes"].alias("payload_bytes"), r["digest"].alias("payload_digest"),
        r["kind"].alias("record_type"), r["refers_to"].alias("target")), "warc-captures")
    first = rows.select(F.col("capture_id").alias("target"), F.col("page_id").alias("refers_to"))
    return rows.join(first, "target", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_secrets(spark, sf_dir):
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    base = ["assign", "access", "hex"]

    def digest_text(kinds):
        spans = F.col("spans") if kinds is None else F.filter("spans", lambda s: s["kind"].isin(*kinds))
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in base],
                        F.sha2(digest_text(base), 256).alias("base_sha256"), digest_text(None).alias("spans"))


def op3_token_files(spark, sf_dir):
    read = token_round_trip(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"),
                            scratch_path(spark, "token-files"))
    return read.select(F.col("id").alias("doc_id"), "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op4_near_text(spark, sf_dir):
    return near_duplicate_texts(_table(spark, sf_dir, "documents"), shingle=3, percent=85, bands=36, rows=7)


def op5_bpe(spark, sf_dir):
    path = _tokenizer("word_bpe_49k.json")
    decoded = bpe_decode(bpe_encode(_table(spark, sf_dir, "documents"), path), path)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op6_language(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    scored = identify_languages(docs, train_on(docs))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_licenses(spark, sf_dir):
    """(doc_id, license, start, end, missing, extra): one row per notice."""
    found = scan_licenses(_table(spark, sf_dir, "documents"))
    hit = found.select("doc_id", F.explode("licenses").alias("h"))
    return hit.select("doc_id", *[F.col(f"h.{c}").alias(c) for c in ("license", "start", "end", "missing", "extra")])


def op8_near_vector(spark, sf_dir):
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op9_top_k(spark, sf_dir):
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op10_mix(spark, sf_dir):
    return mix(_table(spark, sf_dir, "documents"))


def op11_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(docs, toxicity.train_on(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_windows", "n_gaining", "gain")


def op12_vector_codes(spark, sf_dir):
    coded, books = compress_vectors(_table(spark, sf_dir, "embeddings"))
    digits = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.select("vec_id", digits.alias("code"), "error", "label_error",
                        F.sha2(F.lit(books_text(books)), 256).alias("codebooks_sha256"))


def op13_spelling(spark, sf_dir):
    return spelling_variants(count_words(_table(spark, sf_dir, "documents"), thin=97))


QUERIES = {f.__name__: f for f in (op1_warc, op2_secrets, op3_token_files, op4_near_text, op5_bpe, op6_language,
                                   op7_licenses, op8_near_vector, op9_top_k, op10_mix, op11_toxicity,
                                   op12_vector_codes, op13_spelling)}
