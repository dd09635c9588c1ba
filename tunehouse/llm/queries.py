"""The named queries of the operators, with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunehouse.llm import (
    embedding_dedup,
    filter_audit,
    licenses,
    merkle,
    mixing,
    packing,
    pii,
    quality_crf,
    rule_ledger,
    secret_scan,
    simhash,
    warc,
    wavelet,
)
from tunehouse.llm.common import landed, read
from tunehouse.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[build.__name__] = build
    return build


@query
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, taken as files of a directory tree."""
    files = licenses.document_files(read(spark, sf_dir, "documents"))
    return licenses.license_scan(files).withColumnRenamed("key", "doc_id")


ORACLES["op1_licenses"] = licenses.LICENSE_SQL


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, 2 bits."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, max_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents from a conditional random field over their lines."""
    return quality_crf.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op4_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules of all documents in a stored ledger, judged by the current policy, with the rules' ablations."""
    ledger = landed(rule_ledger.build_ledger(read(spark, sf_dir, "documents")), "rule-ledger")[0]
    judged = rule_ledger.with_ablations(rule_ledger.judged(ledger), ledger)
    return judged.select("doc_id", *rule_ledger.MEASURES[:5], "base_failed", "kept", "fail_bits", "n_only")


ORACLES["op4_rule_ledger"] = rule_ledger.JUDGED_SQL


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 5, 2, 1 in turn, 3 epochs at most."""
    return mixing.mix(read(spark, sf_dir, "documents"))


ORACLES["op5_mixing"] = mixing.MIX_SQL


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives, read back and assembled, revisits resolved."""
    path = scratch_path(spark, "warc")
    warc.write_captures(read(spark, sf_dir, "pages"), path, min_bytes=0)
    records = landed(warc.read_records(spark, path, payloads=False), "warc-records")[0]
    return warc.resolved(warc.assemble(records))


ORACLES["op6_warc"] = warc.CAPTURES_SQL


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return secret_scan.digest(secret_scan.scan(read(spark, sf_dir, "documents")))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all embeddings of a label, cosine 0.93 or more."""
    return embedding_dedup.vector_links(read(spark, sf_dir, "embeddings"))


@query
def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by surrogates, by the key of the session."""
    return pii.surrogate_texts(read(spark, sf_dir, "documents"), pii.session_key(spark))


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions of five filters over all documents, per language, in all orders."""
    return filter_audit.interaction_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


ORACLES["op11_filter_audit"] = filter_audit.AUDIT_SQL


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, each with its proof checked, a seventh of them tampered with."""
    return merkle.document_manifest(read(spark, sf_dir, "documents"))


ORACLES["op12_merkle_manifest"] = merkle.MANIFEST_SQL


@query
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids written to wavelet-matrix shards and read back."""
    path = scratch_path(spark, "shards")
    docs = read(spark, sf_dir, "documents")
    wavelet.write_shards(docs, path)
    found = wavelet.read_documents(spark, path, docs.schema["doc_id"].dataType.simpleString())
    return found.withColumnRenamed("id", "doc_id")
