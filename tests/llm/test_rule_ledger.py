import re
from collections import Counter

import pytest

from tunehouse.llm import rule_ledger as R


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(lines),
        text.count("!"),
        len(re.findall("[A-Z]", text)),
    )


def test_measures(awkward_rows, con):
    texts = [t for _, t, _ in awkward_rows] + [t for (t,) in con.execute("select text from documents").fetchall()]
    texts += ["a b c d e a b c d e", "a a a a a a", "a b c d e", "a b c d e f a b c d e", "x | y # z\n\n|\n|"]
    for text in texts:
        assert R.measure(text) == plain(text)


@pytest.fixture(scope="module")
def ledger(spark, awkward):
    return R.build_ledger(awkward)


def test_ledger_of_awkward_rows(ledger, awkward_rows, nothing):
    rows = ledger.collect()
    assert len(rows) == len(awkward_rows)
    want = sorted(((k or 0, *plain(t)) for k, t, _ in awkward_rows))
    assert sorted((r["doc_id"] or 0, *(r[m] for m in R.MEASURES)) for r in rows) == want
    assert all(r["fail_bits"] & 1 for r in rows if r["n_words"] < 10)
    assert R.judged(R.build_ledger(nothing)).count() == 0


def test_policies_and_ablations(ledger):
    rows = [r.asDict() for r in ledger.collect()]
    for r in rows:
        fails = {n for n, (_, rule) in R.RULES.items() if eval(rule, {}, r)}
        assert r["fail_bits"] == sum(1 << R.RULES[n][0] for n in fails)
    for policy, rules in R.POLICIES.items():
        kept = {r["doc_id"] for r in ledger.where(R.passes(policy)).collect()}
        assert kept == {r["doc_id"] for r in rows if not r["fail_bits"] & R.mask(policy)}
        found = {r["rule"]: r for r in R.ablations(ledger).where(f"policy = '{policy}'").collect()}
        assert set(found) == set(rules)
        for rule in rules:
            bit = 1 << R.RULES[rule][0]
            assert found[rule]["n_docs"] == len(rows)
            assert found[rule]["n_failing"] == sum(bool(r["fail_bits"] & bit) for r in rows)
            assert found[rule]["n_only"] == sum(r["fail_bits"] & R.mask(policy) == bit for r in rows)


def test_rules_in_common(ledger):
    one = R.rules_in_common(ledger.selectExpr("1 as g", "*"), "g").first()
    bits = [r["fail_bits"] for r in ledger.where(~R.passes()).collect()]
    some = every = bits[0]
    for b in bits:
        some, every = some | b, every & b
    assert (one["n_rejected"], one["some"], one["all"]) == (len(bits), some, every)


def test_junk_fails_and_prose_passes(spark, con):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = R.judged(R.build_ledger(docs)).join(labels, "doc_id").collect()
    assert not any(r["kept"] for r in judged if r["quality"] == 0)
    assert all(r["kept"] for r in judged if r["quality"] == 1 and not r["base_failed"])


def test_bits_are_unique():
    bits = [b for b, _ in R.RULES.values()]
    assert len(set(bits)) == len(bits)


def test_rows_know_what_leaving_their_rule_out_brings_back(ledger):
    rows = R.with_ablations(R.judged(ledger), ledger).collect()
    mask = R.mask(R.CURRENT)
    single = Counter(r["fail_bits"] & mask for r in rows if (r["fail_bits"] & mask).bit_count() == 1)
    assert len(rows) == ledger.count() and single
    for r in rows:
        assert r["n_only"] == single.get(r["fail_bits"] & mask)
