"""Registered queries of the operators: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import (clustering, codes, decontaminate, exact_dedup, langid, lm, pii, quality, records, secret_scan,
                         sentencepiece, simhash, url_filter)
from barlake.llm.shared import fold_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontaminate(spark, sf_dir):
    """One row per document: words inside any 10-word benchmark window."""
    marked = decontaminate.mark_contaminated(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items",
                         F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                         "contaminated")


@query
def op2_exact_dedup(spark, sf_dir):
    """One row per document: which copy stays and how many there are."""
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


@query
def op8_simhash_near_dedup(spark, sf_dir):
    """One row per document: 64-bit fingerprint and smallest document reachable over links of 3 bits."""
    group = simhash.near_groups(table(spark, sf_dir, "documents"))
    return group.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("first.id").alias("component_id"))


@query
def op3_language_id(spark, sf_dir):
    """One row per document: predicted language; every fifth document by hash is held out of learning."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of("doc_id", 5) == 0
    profiles = langid.learn(docs, ~held_out)
    return langid.identify(docs.withColumn("held_out", held_out), profiles, carry=("held_out",))


@query
def op4_token_records(spark, sf_dir):
    """One row per document, read back from the record files: where its ids start, how many, their crc32."""
    manifest = records.write_records(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return records.read_records(spark, manifest)


@query
def op5_secret_scan(spark, sf_dir):
    """One row per document: candidates, secrets the forest accepts, and their spans."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("secrets", lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", "n_candidates", F.size("secrets").cast("bigint").alias("n_secrets"),
                        spans.alias("spans"))


@query
def op6_sentencepiece(spark, sf_dir):
    """One row per document: ids of its whole text, decoded again and compared with the reference library."""
    return sentencepiece.encode_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


@query
def op9_quality(spark, sf_dir):
    """One row per document: calibrated views, their combination and the decision."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model).select("doc_id", *quality.SCORES)


@query
def op7_lm_score(spark, sf_dir):
    """One row per document: base and interpolated log10 probability; every tenth by hash is held out."""
    return lm.score_documents(table(spark, sf_dir, "documents"), fold_of("doc_id", 10) == 0)


@query
def op10_pii(spark, sf_dir):
    """One row per document: base spans by kind, their digest, and all spans."""
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts,
                        F.sha2(pii.span_text(base).cast("binary"), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"))


@query
def op11_centroids(spark, sf_dir):
    """One row per usable vector: its cluster, exact squared distance and the cluster's sums."""
    found, clusters = clustering.cluster(table(spark, sf_dir, "embeddings"))
    return clustering.with_cluster_facts(found, clusters).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query
def op12_vector_codes(spark, sf_dir):
    """One row per usable vector: its code, squared error, and the error summed over its label."""
    done = codes.compress(table(spark, sf_dir, "embeddings"), carry=("label",))
    digest = hashlib.sha256(done.codebook_text().encode()).hexdigest()
    return codes.with_group_error(done.rows, "carry0").select(
        F.col("id").alias("vec_id"), codes.code_text(F.col("code")).alias("code"), "error",
        F.col("group_error").alias("label_error"), F.lit(digest).alias("codebooks_sha256"))


@query
def op13_url_filter(spark, sf_dir):
    """One row per page: host, path, the domain rule that decides and the verdict."""
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.default_rules())
