import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tunehouse.llm import packing as P


def padding(n, length):
    return 0 if n & (n - 1) == 0 else length - n


def plain_best(at, cost, length):
    """Least cost over all pairs of places."""
    best = [0.0] + [float("inf")] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            n = at[j] - at[i]
            if n <= length:
                short = P.SHORT_PENALTY if n & (n - 1) == 0 and n < length else 0
                waste = min(length - n, short) if n & (n - 1) == 0 else length - n
                best[j] = min(best[j], best[i] + waste + cost[j])
    return best[-1]


@pytest.mark.parametrize("seed", range(8))
def test_cuts_cost_least(seed):
    rng = random.Random(seed)
    length = rng.choice([16, 32, 64])
    at = [0]
    for _ in range(120):
        at.append(at[-1] + rng.randint(1, length if seed % 2 else 5))
    cost = [0.0] + [rng.choice([0.0, 1.0, 5.0]) for _ in at[1:]]
    cuts = P.best_cuts(at, cost, length)
    assert cuts[0] == 0 and cuts[-1] == at[-1]
    total = 0.0
    for a, b in zip(cuts, cuts[1:], strict=False):
        n = b - a
        assert 0 < n <= length
        total += min(length - n, P.SHORT_PENALTY) if n & (n - 1) == 0 else length - n
        total += cost[at.index(b)]
    assert total == pytest.approx(plain_best(at, cost, length))


def test_ids_are_the_tokenizers_own(awkward_rows):
    path = P.default_tokenizer()
    tokenizer = P._tokenizer(path)
    rng = random.Random(0)
    chars = [chr(c) for c in range(1, 0x250)] + list(" \n\t'st.") * 40
    texts = ["".join(rng.choice(chars) for _ in range(40)) for _ in range(500)]
    texts += [t for _, t, _ in awkward_rows] + ["a <|endoftext|> b", "日本語 текст ₀  x", "ṣ̣ é"]
    for text, ids in zip(texts, P.token_ids(texts, path), strict=True):
        assert ids.tolist() == (tokenizer.encode(text, add_special_tokens=False).ids if text else [])


def check(pieces, docs, length=2048):
    """pieces: rows of pack; docs: (id, ids with the closing id). Every id lies in one piece; sequences have no gap."""
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= length
    want = defaultdict(list)
    for key, ids in docs:
        want[key, len(ids)].append(ids)
    assert set(by_doc) == set(want)
    for key, texts in want.items():
        got = sorted((p["start"], p["length"], p["ids_crc32"]) for p in by_doc[key])
        if len(texts) == 1:
            at = 0
            for start, n, crc in got:
                assert start == at and crc == zlib.crc32(texts[0][start : start + n].astype("<u4").tobytes())
                at += n
            assert at == key[1]
        else:
            assert sum(n for _, n, _ in got) == len(texts) * key[1]
    return {s: sum(n for _, n in parts) for s, parts in sequences.items()}


def with_end(text, path):
    return np.append(P.token_ids([text], path)[0], np.uint32(P.END_ID))


@pytest.mark.parametrize("block", [1, 3000, 1 << 19])
def test_awkward_rows(spark, awkward, awkward_rows, nothing, block):
    path = P.default_tokenizer()
    pieces = P.pack(awkward, block=block).collect()
    check(pieces, [(k, with_end(t, path)) for k, t, _ in awkward_rows])
    assert P.pack(nothing).count() == 0


def test_little_padding(spark, con):
    rows = con.execute("select doc_id, text from documents").fetchall()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    path = P.default_tokenizer()
    sizes = check(P.pack(docs).collect(), [(k, with_end(t, path)) for k, t in rows])
    assert sum(padding(n, 2048) for n in sizes.values()) < 0.02 * sum(sizes.values())


def test_order_is_kept(spark):
    docs = spark.createDataFrame([(i, "some words here. " * (i % 9)) for i in range(200)], "doc_id int, text string").coalesce(1)
    pieces = sorted(P.pack(docs, block=1 << 30).collect(), key=lambda p: (p["sequence_id"], p["offset"]))
    assert [p["doc_id"] for p in pieces] == sorted(p["doc_id"] for p in pieces)
    places = [(p["doc_id"], p["start"]) for p in pieces]
    assert places == sorted(places)


def test_text_without_sentence_is_cut_all_the_same(spark):
    docs = spark.createDataFrame([(1, "word " * 30_000)], "doc_id int, text string")
    sizes = check(P.pack(docs).collect(), [(1, with_end("word " * 30_000, P.default_tokenizer()))])
    assert sum(padding(n, 2048) for n in sizes.values()) < 0.05 * sum(sizes.values())


def test_short_runs_waste_little(spark, con):
    """Tasks of five documents each, so that ends of runs matter: they are cut into powers of two."""
    rows = con.execute("select doc_id, text from documents").fetchall()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(40)
    path = P.default_tokenizer()
    sizes = check(P.pack(docs).collect(), [(k, with_end(t, path)) for k, t in rows])
    assert sum(padding(n, 2048) for n in sizes.values()) < 0.03 * sum(sizes.values())


def plain_filled(at, cost, length, fill):
    """Least cost over all cuts whatever, without the powers of two."""
    own = dict(zip(at, cost, strict=True))
    best = [0.0] + [float("inf")] * at[-1]
    for j in range(1, at[-1] + 1):
        best[j] = own.get(j, fill) + min(best[i] + length - (j - i) for i in range(max(0, j - length), j))
    return best[-1]


@pytest.mark.parametrize("seed", range(12))
def test_filled_up_cuts_cost_least(seed, monkeypatch):
    """No cut elsewhere is better than those at places and at the ends of full sequences."""
    rng = random.Random(seed)
    length = 63
    monkeypatch.setattr(P, "SHORT_PENALTY", 1000.0)  # powers of two are never worth it
    at = [0]
    for _ in range(60):
        at.append(at[-1] + rng.randint(1, [5, 30, 63, 200][seed % 4]))
    cost = [0.0] + [rng.choice([0.0, 1.0]) for _ in at[1:]]
    cuts = P.best_cuts(at, cost, length, 4.0)
    own = dict(zip(at, cost, strict=True))
    assert cuts[0] == 0 and cuts[-1] == at[-1] and all(0 < b - a <= length for a, b in zip(cuts, cuts[1:], strict=False))
    total = sum(length - (b - a) + own.get(b, 4.0) for a, b in zip(cuts, cuts[1:], strict=False))
    assert total == pytest.approx(plain_filled(at, cost, length, 4.0))


@pytest.mark.parametrize("most", [1_400, 2_000, 2_040])
def test_documents_without_sentence_ends_waste_little(most):
    rng = random.Random(most)
    docs = [np.append(np.full(rng.randint(700, most), 1000, np.uint32), np.uint32(P.END_ID)) for _ in range(200)]
    kinds = np.zeros(2000, np.int8)
    sizes = defaultdict(int)
    for _, _, count, _, sequence, _ in P.pack_run(docs, (kinds, {})):
        sizes[sequence] += count
    assert sum(sizes.values()) == sum(map(len, docs)) and max(sizes.values()) <= 2048
    assert sum(padding(n, 2048) for n in sizes.values()) < 0.01 * sum(sizes.values())


@pytest.mark.parametrize("text", ["日本語の文です。次の文", "यह वाक्य है। अगला", "really？ no", "Ça va… oui", "هل هذا؟ نعم", "one. two", "これ！それ"])
def test_sentence_ends_of_other_scripts(text):
    path = P.default_tokenizer()
    mark = next(i for i, c in enumerate(text) if c.encode() in P.STOPS)
    ids = P.token_ids([text], path)[0]
    places = P.sentence_places(ids, P._sentence_ends(path))
    tokenizer = P._tokenizer(path)
    assert [tokenizer.decode(ids[:p].tolist()) for p in places] == [text[: mark + 1]]
