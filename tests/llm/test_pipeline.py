"""The pipeline's stages against the operators' plain versions, each on its own input."""

import re
from collections import defaultdict

import pytest

import corpus_pipeline as pipeline
from tunehouse.llm import packing, quality_crf, simhash


@pytest.fixture(scope="module")
def inputs(spark, small):
    """What each stage gets and gives, in order."""
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        given = docs
        docs = stage(spark, given, small).cache()
        out.append((name, given.collect(), docs.collect(), docs.dtypes))
    return out


def test_stages_and_columns(inputs, spark, small):
    assert [n for n, *_ in inputs] == ["quality_classifier", "simhash_near_dedup", "pii_surrogates", "mixing", "packing"]
    kinds = spark.read.parquet(f"{small}/documents.parquet").dtypes
    assert all(d == kinds for *_, d in inputs[:-1])


def test_quality_drops_what_it_rejects(inputs, spark, small, con):
    _, given, got, _ = inputs[0]
    predicted = quality_crf.classify(spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet"))
    good = {r["doc_id"] for r in predicted.where("predicted = 1").collect()}
    assert {r["doc_id"] for r in got} == good and len(good) < len(given)
    clean = {k for (k,) in con.execute("select doc_id from labels where quality = 1").fetchall()}
    assert len(clean & good) >= 0.98 * len(clean)


def test_one_of_each_group_stays(inputs):
    _, given, got, _ = inputs[1]
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in given}
    kept = {r["doc_id"] for r in got}
    assert len(kept) == len(got) and kept < set(prints)
    parent = {k: k for k in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert kept == {find(k) for k in prints}


def test_personal_data_goes(inputs):
    _, given, got, _ = inputs[2]
    texts = {r["doc_id"]: r["text"] for r in got}
    assert len(texts) == len(given)
    for r in given:
        for mail in re.findall(r"[\w.]+@[\w.]+\w", r["text"]):
            assert mail not in texts[r["doc_id"]]


def test_mix_meets_its_targets(inputs):
    _, given, got, _ = inputs[3]
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in rows)
    by_source = defaultdict(list)
    for r in given:
        by_source[r["source"]].append(r)
    taken = defaultdict(list)
    for r in got:
        taken[r["source"]].append(r)
    for source in by_source:
        assert words(taken[source]) <= 3 * words(by_source[source])
    assert abs(words(got) - words(given)) <= len(by_source)
    originals = {r["doc_id"]: r["text"] for r in given}
    assert all(originals[r["doc_id"]].startswith(r["text"]) for r in got)


def test_packing_holds_every_token(inputs):
    _, given, got, _ = inputs[4]
    path = packing.default_tokenizer()
    ids = packing.token_ids([r["text"] for r in given], path)
    assert sum(r["length"] for r in got) == sum(len(x) + 1 for x in ids)
    tokens = defaultdict(int)
    for r in got:
        tokens[r["sequence_id"]] += r["length"]
    assert max(tokens.values()) <= 2048
    waste = sum(0 if n & (n - 1) == 0 else 2048 - n for n in tokens.values())
    assert waste < 0.03 * sum(tokens.values())  # of a few documents per task


def test_run_gives_the_last_stage(inputs, spark, small):
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])
    packed = pipeline.run(spark, small).collect()
    assert sum(r["length"] for r in packed) == sum(r["length"] for r in inputs[-1][2])
    assert {key(r)[0] for r in packed} == {key(r)[0] for r in inputs[-1][2]}


@pytest.mark.parametrize("stage", [s for _, s in pipeline.STAGES], ids=[n for n, _ in pipeline.STAGES])
def test_empty_documents(spark, small, stage):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    assert stage(spark, docs, small).count() == 0


def test_awkward_documents(spark, small, awkward):
    docs = awkward
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.dtypes == awkward.dtypes, name
        out.collect()
    assert sum(r["length"] for r in pipeline.STAGES[-1][1](spark, docs, small).collect()) > 0
