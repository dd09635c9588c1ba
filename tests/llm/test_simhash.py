import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tunehouse.llm import simhash


def plain_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    ones = [0] * 64
    for gram in grams:
        h = xxhash.xxh64_intdigest(gram.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def plain_components(prints, bits):
    parent = {k: k for k in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in prints}


def signed(x):
    return int(np.uint64(x).astype(np.int64))


def test_fingerprints(awkward_rows):
    for _, text, _ in awkward_rows:
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert simhash.fingerprint("A b C") == simhash.fingerprint("a\vb  c") != 0
    assert simhash.fingerprint("É a b") != simhash.fingerprint("é a b")  # only A-Z is lowered


def test_long_texts_are_counted_in_chunks(monkeypatch):
    text = " ".join(str(i % 37) for i in range(500))
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4])
def test_links_equal_brute_force(spark, bits):
    rng = np.random.default_rng(bits)
    base = [int(x) for x in rng.integers(0, 2**64, 6, dtype=np.uint64)] + [0, 2**64 - 1, 2**63]
    prints = set(base)
    for x in base:
        for _ in range(25):
            y = x
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                y ^= 1 << int(b)
            prints.add(y)
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp bigint")
    got = {(r["u"], r["v"]) for r in simhash.link_fingerprints(df, bits).collect()}
    values = sorted(signed(x) for x in prints)
    want = {(a, b) for a in values for b in values if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
    assert got == want


def test_near_copies_make_linear_output(spark):
    """A group of near copies gives each link once or twice, not once per shared cell."""
    x = 0x0123456789ABCDEF
    prints = [x ^ (1 << b) for b in range(64)] + [x]
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    assert simhash.link_fingerprints(df, 2).count() <= 2 * 65 * 64 // 2


def test_whole_table_equals_brute_force(spark, con, small):
    docs = dict(con.execute("select doc_id, text from documents").fetchall())
    prints = {k: plain_fingerprint(t) for k, t in docs.items()}
    want = plain_components(prints, 2)
    got = simhash.near_duplicates(spark.read.parquet(f"{small}/documents.parquet")).collect()
    assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in got} == {k: (prints[k], want[k]) for k in docs}


def test_awkward_rows(awkward, awkward_rows, nothing):
    got = simhash.near_duplicates(awkward).collect()
    assert sorted((r["doc_id"] or 0, int(r["fingerprint"], 16)) for r in got) == sorted((k or 0, plain_fingerprint(t)) for k, t, _ in awkward_rows)
    by_id = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert by_id[1] == by_id[2] == by_id[3] == 1  # no word: all linked
    assert by_id[7] == by_id[8] == 7 and by_id[6] == 6
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {1, 7}
    assert simhash.near_duplicates(nothing).count() == 0


def test_only_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id bigint, text string")
    assert [r["component_id"] for r in simhash.near_duplicates(docs).collect()] == [None, None]


def test_keep_one(awkward, nothing):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns and kept.dtypes == awkward.dtypes
    rows = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in rows if x is not None) == [1, 4, 5, 6, 7, 9, 10, 11, 12] or sorted(x for x in rows if x) == [1, 4, 5, 6, 7, 10, 11, 12]
    assert rows.count(None) == 0  # copies of rows with an id
    assert simhash.keep_one(nothing).count() == 0


def test_repeated_rows_of_the_kept_id(spark):
    docs = spark.createDataFrame([(1, "b c d"), (1, "b c d"), (2, "b c d")], "doc_id bigint, text string")
    assert [tuple(r) for r in simhash.keep_one(docs).collect()] == [(1, "b c d")]


def test_no_pairs_join_without_key(spark, small):
    prints = spark.range(100).select(F.xxhash64("id").alias("fp"))
    plan = simhash.link_fingerprints(prints)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_exactly_one_row_of_each_group_stays(spark):
    """Whatever the ids: two texts of one id are two rows, and rows without id are duplicates like others."""
    a, b = "alpha beta gamma delta epsilon zeta eta theta", "totally different words stand here in this other text"
    rows = [(1, a), (1, b), (2, a), (None, a), (None, b), (None, "one more text that nobody else in here has written"), (None, None), (7, None), (1, a)]
    kept = simhash.keep_one(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id int, text string, n int")).collect()
    assert sorted(((r["doc_id"] or 0, r["text"] or "") for r in kept)) == sorted([(1, a), (1, b), (0, rows[5][1]), (7, "")])
