import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tunehouse.llm import merkle as M


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves, arity):
    """Root, and per leaf its path of (slot, siblings) up to the root."""
    paths = [[] for _ in leaves]
    level, owners = list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        up, groups = [], []
        for a in range(0, len(level), arity):
            run = level[a : a + arity]
            for slot in range(len(run)):
                for leaf in owners[a + slot]:
                    paths[leaf].append((slot, run[:slot] + run[slot + 1 :]))
            up.append(h(*run))
            groups.append([x for o in owners[a : a + arity] for x in o])
        level, owners = up, groups
    return level[0], paths


def plain_fold(leaf, path):
    for slot, others in path:
        leaf = h(*others[:slot], leaf, *others[slot:])
    return leaf


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_manifest(rows, arity=2):
    """rows: (doc_id, text, lang, source, n_chars); one tuple of results per row."""

    def leaf(r, more=0):
        n = None if r[4] is None else r[4] + more
        return h(enc(r[0]), enc(r[3]), enc(r[2]), enc(n), enc(r[1]))

    parts = {}
    for r in rows:
        parts.setdefault(r[2], []).append(r)
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {}
    for p in names:
        mine = sorted(parts[p], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[p] = (mine, *plain_tree([leaf(r) for r in mine], arity))
    root, above = plain_tree([trees[p][1] for p in names], arity)
    out = []
    for p, upper in zip(names, above, strict=True):
        mine, subroot, paths = trees[p]
        for r, path in zip(mine, paths, strict=True):
            proof = h(*[x for _, others in path + upper for x in others])
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            end = plain_fold(leaf(r, 1) if changed else leaf(r), path + upper)
            out.append((r[0], leaf(r), subroot, root, proof, end, end == root))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def test_awkward_rows(spark, awkward, awkward_rows):
    docs = awkward.drop("lang").withColumn("lang", F.col("source"))
    rows = [(k, t, s, s, None if t is None else len(t)) for k, t, s in awkward_rows]
    assert found(M.document_manifest(docs)) == Counter(plain_manifest(rows))


@pytest.mark.parametrize("sizes", [[1], [2], [3], [1, 1], [1, 2, 3], [4, 5, 1, 1, 7], [16, 17, 15]])
def test_shapes(spark, sizes):
    rows = [(100 * p + i, f"text {i}", f"l{p}" if p else None, "s", i) for p, n in enumerate(sizes) for i in range(n)]
    assert found(M.document_manifest(frame(spark, rows))) == Counter(plain_manifest(rows))


@pytest.mark.parametrize("arity", [3, 4])
def test_wider_runs(spark, arity):
    rows = [(i, f"text {i}", "abcd"[i % 4] if i < 40 else "z", "s", i) for i in range(53)]
    made = M.manifest(M.document_leaves(frame(spark, rows)), arity)
    got = M.verified(made, arity=arity).collect()
    want = {r[0]: r for r in plain_manifest(rows, arity)}
    assert len(got) == 53
    for r in got:
        _, leaf, subroot, root, proof, end, ok = want[r["id"]]
        assert (r["hash"].hex(), r["subroot"].hex(), r["root"].hex()) == (leaf, subroot, root)
        assert (r["proof_sha256"], r["folded_root"], r["verified"]) == (proof, end, ok)


def test_languages_in_byte_order(spark):
    langs = [None, "", "Z", "a", "é", "～", "\U0001f600", "ab", "aé"]
    rows = [(i, "t", lang, None, None) for i, lang in enumerate(langs)]
    assert found(M.document_manifest(frame(spark, rows))) == Counter(plain_manifest(rows))


def test_repeated_rows_and_ids(spark):
    rows = [(7, "same", "a", "s", 4)] * 5 + [(7, "other", "a", "s", 5), (8, "same", "a", "s", 4), (None, "x", "a", "s", 1), (None, "x", "a", "s", 1)]
    assert found(M.document_manifest(frame(spark, rows))) == Counter(plain_manifest(rows))


def test_tampering_is_noticed_and_only_that(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = M.document_manifest(docs).collect()
    assert len(rows) == docs.count()
    assert len({r["root"] for r in rows}) == 1
    changed = {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0}
    assert changed and {r["doc_id"] for r in rows if not r["verified"]} == changed


def test_largest_numbers(spark):
    big = 2**63 - 1
    key = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 0)
    rows = [(key, "t", "a", "s", big), (big, "t", "a", "s", -1), (-1, "", "a", "s", 0)]
    assert found(M.document_manifest(frame(spark, rows))) == Counter(plain_manifest(rows))


def test_nothing(nothing):
    assert M.document_manifest(nothing.withColumn("lang", F.col("source"))).count() == 0


def test_depth():
    assert [M.depth_of(n) for n in (0, 1, 2, 3, 4, 5, 8, 9)] == [0, 0, 1, 2, 2, 3, 3, 4]
    assert [M.depth_of(n, 3) for n in (1, 3, 4, 9, 10)] == [0, 1, 2, 2, 3]
