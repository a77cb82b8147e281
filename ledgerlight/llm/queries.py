"""One query per operator: the operator applied to its whole table, reduced to the digest columns.

Every query reads whole tables and whole texts; parameters are the operators'
defaults.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import (convnet, host_rules, langid, line_dedup, merkle, minhash, mixing, packing, secret_scan, substring_dedup,
               vector_dedup, warc, whitening)
from .catalog import corpus_query
from .common import id_crc32, shared_path
from .oracles import OP2, OP3, OP4, OP6, OP9, OP11, OP12

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@corpus_query("op1_language_id")
def op1(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", id_crc32("doc_id") % 3 == 1)
    model = langid.fit(docs.where("not held_out"))
    found = docs.select("doc_id", "held_out", langid.label_languages(model, "text").alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
                        F.size("found.spans").alias("n_spans"))


@corpus_query("op2_host_rules", OP2)
def op2(spark, sf_dir):
    judged = host_rules.judge(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


@corpus_query("op3_fair_mix", OP3)
def op3(spark, sf_dir):
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@corpus_query("op4_sorted_projections", OP4)
def op4(spark, sf_dir):
    return vector_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


@corpus_query("op5_fuzzy_lines")
def op5(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, n_dropped="n_dropped")


@corpus_query("op6_sketch_dedup", OP6)
def op6(spark, sf_dir):
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=2).drop("text_hash", "leads")


@corpus_query("op7_byte_convnet")
def op7(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", (id_crc32("doc_id") % 5 == 0).alias("held_out"))
    labels = read_table(spark, sf_dir, "labels").where(id_crc32("doc_id") % 5 != 0)
    net = convnet.fit(docs.where("not held_out"), labels, label="quality")
    scored = docs.select("doc_id", "held_out", convnet.quality_score(net, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= convnet.THRESHOLD).cast("int"))


@corpus_query("op8_secret_scan")
def op8(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", secret_scan.secret_spans("text").alias("found"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                    x["end"].cast("string"))), ",")

    def of(kind):
        return F.filter("found", lambda x: x["kind"] == kind)

    base = F.filter("found", lambda x: x["kind"].isin(*secret_scan.BASE_KINDS))
    return docs.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}")
          for k in secret_scan.BASE_KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


@corpus_query("op9_warc", OP9)
def op9(spark, sf_dir):
    path = shared_path(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@corpus_query("op10_vector_best_fit")
def op10(spark, sf_dir):
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@corpus_query("op11_merkle_manifest", OP11)
def op11(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    columns = [F.col(c) for c in merkle.COLUMNS]
    lowered = [F.translate(c, UPPER, UPPER.lower()) if name == "text" else c for name, c in zip(merkle.COLUMNS, columns)]
    seen = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_hash(*lowered))
    rows = merkle.prove(docs, merkle.leaf_hash(*columns), carry={"seen": seen})
    out = rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"),
                      merkle.fold(F.coalesce("seen", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


@corpus_query("op12_substring_dedup", OP12)
def op12(spark, sf_dir):
    cut = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return cut.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


@corpus_query("op13_chebyshev_whitening")
def op13(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))
