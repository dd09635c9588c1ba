"""No text may kill a task or keep it for long: all queries on texts of extremes, each within a time limit."""

import threading
import time

import pytest

import corpus_pipeline
from llm.awkward_texts import long_texts
from tunehouse.llm import filter_audit, licenses, merkle, mixing, packing, pii, quality_crf, rule_ledger, secret_scan, simhash, wavelet
from tunehouse.session import scratch_path

SECONDS = 120


@pytest.fixture(scope="module")
def texts():
    return long_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    path = scratch_path(spark, "long-texts")
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts.values())]
    rows += [(1000 + i, f"plain text number {i} of the table, with some words.\nAnd a second line.", "en", "s0", 10) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.repartition(8).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(1020)], "doc_id bigint, quality int, toxic int")


def within(spark, seconds, work):
    """The result of ``work``, whose jobs are cancelled after the limit."""
    timer = threading.Timer(seconds, spark.sparkContext.cancelAllJobs)
    timer.start()
    started = time.time()
    try:
        return work()
    finally:
        timer.cancel()
        assert time.time() - started < seconds


OPERATORS = {
    "op1": lambda d, labels: licenses.license_scan(licenses.document_files(d)),
    "op2": lambda d, labels: simhash.near_duplicates(d, words=3, max_bits=2),
    "op3": lambda d, labels: quality_crf.classify(d, labels),
    "op4": lambda d, labels: rule_ledger.judged(rule_ledger.build_ledger(d)),
    "op5": lambda d, labels: mixing.mix(d),
    "op7": lambda d, labels: pii.surrogate_texts(d),
    "op8": lambda d, labels: secret_scan.digest(secret_scan.scan(d)),
    "op9": lambda d, labels: packing.pack(d),
    "op11": lambda d, labels: filter_audit.mask_cells(filter_audit.failures(d), labels),
    "op12": lambda d, labels: merkle.document_manifest(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operator_survives(spark, docs, labels, name):
    count = within(spark, SECONDS, lambda: len(OPERATORS[name](docs, labels).collect()))
    assert count >= docs.count() if name != "op11" else count > 0


def test_op13_survives(spark, docs):
    def work():
        path = scratch_path(spark, "shards")
        wavelet.write_shards(docs, path)
        return wavelet.read_documents(spark, path).count()

    assert within(spark, SECONDS, work) == docs.count()


def test_pipeline_stages_survive(spark, docs):
    def work():
        kept = docs
        for _, stage in corpus_pipeline.STAGES[1:]:
            kept = stage(spark, kept, None)
        return kept.count()

    assert within(spark, 3 * SECONDS, work) > 0


def test_ids_of_long_texts_are_the_tokenizers_own(texts):
    path = packing.default_tokenizer()
    tokenizer = packing._tokenizer(path)
    for name in ("blanks", "breaks", "tabs", "unicode", "digits"):
        assert packing.token_ids([texts[name]], path)[0].tolist() == tokenizer.encode(texts[name], add_special_tokens=False).ids
