import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
from tunehouse.llm import filter_audit as A


def plain_masks(rows):
    """rows: (doc_id, text, part) -> (part, mask) of each, straight from the definitions."""
    firsts = {}
    for key, text, _ in rows:
        if key is not None:
            firsts[text or ""] = min(key, firsts.get(text or "", key))
    out = []
    for key, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [
            len(words) < 100,
            100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            bool(re.search(r"[#$%&*|]", text)),
            key is not None and firsts[text] < key,
        ]
        out.append((part or "", sum(1 << i for i, f in enumerate(fails) if f)))
    return out


def plain_audit(marked):
    """marked: (part, mask, good, toxic) per document -> the audit, document by document."""
    out = {}
    for part in {m[0] for m in marked}:
        docs = [m[1:] for m in marked if m[0] == part]
        total = Counter()
        for order in permutations(range(5)):
            done = 0
            for step, f in enumerate(order, 1):
                bit = 1 << f
                here = [d for d in docs if not d[0] & done]
                gone = [d for d in here if d[0] & bit]
                total[f] += len(gone)
                out[part, "".join("ABCDE"[i] for i in order), step] = [
                    len(here) - len(gone),
                    len(gone),
                    sum(1 for d in docs if d[0] & bit) - len(gone),
                    sum(1 for d in docs if d[0] == bit),
                    sum(d[1] for d in gone),
                    sum(d[2] for d in gone),
                ]
                done |= bit
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total["ABCDE".index(order[step - 1])])
    return out


COLUMNS = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def as_dict(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in df.collect()}


def test_masks_of_awkward_rows(awkward, awkward_rows):
    found = Counter((r["part"], r["mask"]) for r in A.failures(awkward, part_col="source").collect())
    assert found == Counter(plain_masks(awkward_rows))


def test_random_texts_fail_what_they_should():
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice("ab cAé #|\n\x0b \x1c日") for _ in range(rng.choice([0, 3, 40, 600])))
        assert A.text_failures(text.encode()) == plain_masks([(None, text, "")])[0][1]


def test_audit_equals_documents_one_by_one(spark, awkward, awkward_rows):
    labels = [(2, 1, 0), (4, 0, 1), (7, 1, None), (7, 0, 1), (8, 1, 1), (None, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = awkward.drop("lang").withColumnRenamed("source", "lang")
    found = as_dict(A.interaction_audit(docs, frame))
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    rows = [(k, t, s) for k, t, s in awkward_rows]
    marked = [(p, m, k in good, k in toxic) for (p, m), (k, _, _) in zip(plain_masks(rows), rows, strict=True)]
    assert found == plain_audit(marked)
    assert len(found) == 600 * len({p for p, *_ in marked})


def test_walk_equals_every_subset():
    rng = np.random.default_rng(1)
    masks = np.arange(32)
    counts = rng.integers(0, 50, (32, 3))
    walk = list(A.gray_walk(masks, counts, 5))
    assert sorted(s for s, _ in walk) == list(range(32))
    for (a, _), (b, _) in zip(walk, walk[1:], strict=False):
        assert (a ^ b).bit_count() == 1
    for subset, kept in walk:
        assert kept.tolist() == counts[(masks & subset) == 0].sum(axis=0).tolist()


def test_copies_of_a_hot_text(spark):
    texts = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) as text", "'x' as lang")
    found = A.failures(texts).groupBy("mask").count().collect()
    assert {r["mask"]: r["count"] for r in found} == {1: 2001, 1 | 16: 999}


def test_nothing(spark, nothing):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert A.interaction_audit(nothing.withColumnRenamed("source", "lang"), labels).count() == 0


def test_shapley_adds_up(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    rows = A.interaction_audit(docs, labels).where("filter_order = 'ABCDE'").collect()
    for part in {r["part"] for r in rows}:
        mine = {r["step"]: r for r in rows if r["part"] == part}
        start = mine[1]["kept"] + mine[1]["removed"]
        assert sum(r["shapley"] for r in mine.values()) == 120 * (start - mine[5]["kept"])


