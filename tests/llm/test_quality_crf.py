import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from tunehouse.llm import quality_crf as Q


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 4, 2])
    good, move = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    chains = Q.Chains(lengths)
    p, moves, z = chains.marginals(good[chains.source], move)
    want_p, want_moves, want_z, at = [], np.zeros((2, 2)), 0.0, 0
    for n in lengths:
        scores = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            steps = sum(move[a, b] for a, b in zip(labels, labels[1:], strict=False))
            scores[labels] = np.exp(steps + sum(good[at + i] for i, y in enumerate(labels) if y))
        total = sum(scores.values())
        want_z += np.log(total)
        want_p += [sum(s for y, s in scores.items() if y[i]) / total for i in range(n)]
        for y, s in scores.items():
            for a, b in zip(y, y[1:], strict=False):
                want_moves[a, b] += s / total
        at += n
    got = np.empty(lengths.sum())
    got[chains.source] = p
    assert np.allclose(got, want_p) and np.allclose(moves, want_moves) and np.isclose(z, want_z)


def test_features_of_awkward_texts(awkward_rows):
    for _, text, _ in awkward_rows:
        own, size = Q.line_features(text)
        assert own.shape == (len(size), Q.N_OWN) and np.isfinite(own).all() and len(size) >= 1
    assert len(Q.line_features("a\n\n b \n")[1]) == 2


def test_constant_label_gives_the_share():
    own, size = Q.line_features("a b")
    assert np.allclose(Q.fit([own], [size], np.array([1])).score(["x", None]), 0.9999, atol=1e-3)
    assert np.allclose(Q.fit([], [], np.array([])).score(["x"]), 0.5)


def test_held_out_accuracy(spark, con):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = {r["doc_id"]: r for r in Q.classify(docs, labels).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in scored.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in scored.values())
    held = [(r["quality"], scored[r["doc_id"]]["predicted"]) for r in labels.collect() if scored[r["doc_id"]]["held_out"]]
    assert sum(a == b for a, b in held) / len(held) >= 0.97


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.train(docs, labels), Q.train(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and a.slope == b.slope


def test_score_depends_on_the_text_alone(spark, awkward, nothing):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = Q.train(docs, labels)
    rows = Q.with_scores(awkward, model).select("row.doc_id", "row.text", "score").collect()
    assert len(rows) == awkward.count()
    assert np.allclose([r["score"] for r in rows], [model.score([r["text"]])[0] for r in rows])
    kept = Q.with_scores(nothing, model)
    assert kept.count() == 0
    good = Q.keep_good(awkward, labels)
    assert good.dtypes == awkward.dtypes and Q.classify(awkward, labels).count() == awkward.count()


def test_no_usable_labels(spark, awkward):
    labels = spark.createDataFrame([(None, 1), (7, None), (8, 5)], "doc_id bigint, quality int")
    assert {r["score"] for r in Q.classify(awkward, labels).collect()} == {0.5}


def test_lines_of_one_document_get_different_labels(spark):
    """Good prose with a junk block in the middle: the block's lines are bad, the others good; documents of one kind keep one."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = Q.train(docs, labels)
    held = docs.join(labels, "doc_id").where(Q.held_out(F.col("doc_id"))).select("text", "quality").collect()
    lines = lambda r: [x for x in r["text"].split("\n") if x.strip()]
    good = [lines(r) for r in held if r["quality"] == 1 and len(lines(r)) >= 4][:12]
    junk = [lines(r) for r in held if r["quality"] == 0][:12]
    assert len(good) >= 5 and len(junk) >= 5
    found = right = 0
    for g, j in zip(good, itertools.cycle(junk)):
        block = (j * 4)[:4]
        middle = len(g) // 2
        own = Q.line_features("\n".join(g[:middle] + block + g[middle:]))[0]
        p = model.line_marginals([own])
        bad = np.zeros(len(own), bool)
        bad[middle : middle + 4] = True
        found += 1
        right += (p[bad] < 0.5).mean() >= 0.75 and (p[~bad] >= 0.5).mean() >= 0.75
    assert right / found >= 0.8, right / found
    rows = Q.classify(docs, labels).select("n_lines", "n_bad_lines").collect()
    assert all(0 <= r["n_bad_lines"] <= r["n_lines"] and r["n_lines"] >= 1 for r in rows)
