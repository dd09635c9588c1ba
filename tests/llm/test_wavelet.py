import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tunehouse.llm import wavelet as W
from tunehouse.session import scratch_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(W.default_tokenizer())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_librarys_own(library, awkward_rows, con):
    rng = random.Random(0)
    chars = [chr(c) for c in range(1, 0x300) if not 0xD800 <= c < 0xE000]
    texts = ["".join(rng.choice(chars) for _ in range(30)) for _ in range(400)]
    plain = [c for c in chars if c.isspace() or not W._OTHER.search(c)]
    texts += ["".join(rng.choice(plain + list(" 'sStTdD\n\t2") * 20) for _ in range(60)) for _ in range(600)]
    texts += [f"a{c}b {c} {c}{c} x'{c}" for c in chars]
    texts += [t or "" for _, t, _ in awkward_rows] + [t for (t,) in con.execute("select text from documents").fetchall()]
    texts += ["a <|endoftext|> b", "<|STARTOFTEXT|>", "it's IT'S we'Ve 'S", "İstanbul", "é", "日本語 текст", "a b c\x1cd\x85e"]
    encode = W.Encoder(W.default_tokenizer()).encode
    for at in range(0, len(texts), 50):
        for text, ids in zip(texts[at : at + 50], encode([t.encode() for t in texts[at : at + 50]]), strict=True):
            assert ids.tolist() == ids_of(library, text), repr(text[:80])


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(W, "KNOWN_WORDS", 3)
    encoder = W.Encoder(W.default_tokenizer())
    encoder.chunks = W.ChunkTable(16)
    for text in ["one two three four five", "two six", "one six seven x" + "y" * 200, "eight one two", "", "a b c d e f g one"] * 3:
        assert encoder.encode([text.encode()])[0].tolist() == ids_of(library, text)


def test_table_of_chunks_keeps_what_it_is_told():
    rng = np.random.default_rng(2)
    table = W.ChunkTable(1 << 12)
    hashes = np.unique(rng.integers(1, 1 << 62, 1500).astype(np.uint64) << np.uint64(2))  # only every fourth slot to begin with
    ids = [rng.integers(0, 9, rng.integers(0, 5)).astype("<u4").tobytes() for _ in hashes]
    for at in range(0, len(hashes), 400):
        assert (table.find(hashes[at:]) == -1).all()
        table.name(hashes[at : at + 400], table.add(ids[at : at + 400]))
    entries = table.find(rng.permutation(np.concatenate([hashes, hashes])))
    assert sorted(entries.tolist()) == sorted([*range(len(hashes))] * 2)
    got, ends = table.ids(table.find(hashes))
    assert [got[a:b].astype("<u4").tobytes() for a, b in zip(ends, ends[1:], strict=False)] == ids


def test_pieces_of_texts():
    texts = [b"", b"ab cd ef gh", b"x" * 30, b" ", b"a\tb\nc" * 10, b""]
    for size in (1, 3, 8, 1000):
        joined = [b""] * len(texts)
        for numbers, parts in W.in_pieces(texts, size):
            for n, part in zip(numbers, parts, strict=True):
                assert not joined[n] or joined[n][-1:].isspace()
                joined[n] += part
        assert joined == texts


def image(ids, lengths=None):
    lengths = [len(ids)] if lengths is None else lengths
    docs = pa.RecordBatch.from_arrays([pa.array(range(len(lengths)), pa.int64()), pa.array(lengths, pa.int64())], names=["id", "n_tokens"])
    return W.shard_image(np.array(ids, "<u4"), docs, task=0, shard=0, before=0)


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (7, 2), (100, 1), (5000, 300), (70_000, 49_408), (W.BLOCK_BITS, 7), (2 * W.BLOCK_BITS, 70_000)])
def test_access_count_and_lookup(n, top):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(min(1.0, 8 / top), n), top).astype(np.uint32) if n % 2 else rng.integers(0, top, n).astype(np.uint32)
    shard = W.Shard(image(ids) + b"\n")
    assert shard.tokens().tolist() == ids.tolist()
    for place in {0, n - 1, *rng.integers(0, max(n, 1), 40).tolist()} if n else ():
        assert shard.access(place) == ids[place]
    with pytest.raises(IndexError):
        shard.access(n)
    for token in {0, 1, top, 2**31, *rng.choice(ids, 10).tolist()} if n else {0, 1}:
        places = np.flatnonzero(ids == token)
        assert shard.count(token) == len(places)
        assert shard.places(token).tolist() == places.tolist()
        a, b = sorted(rng.integers(0, n + 1, 2).tolist())
        assert shard.count(token, a, b) == ((places >= a) & (places < b)).sum()
        for k in {0, len(places) - 1, len(places) // 2} if len(places) else ():
            assert shard.locate(token, k) == places[k]
        with pytest.raises(IndexError):
            shard.locate(token, len(places))


def test_a_look_up_unpacks_few_blocks():
    ids = np.random.default_rng(0).integers(0, 49_408, 20 * W.BLOCK_BITS).astype(np.uint32)
    shard = W.Shard(image(ids))
    shard.access(12_345)
    assert len(shard._open) <= 2 * shard.levels
    shard.count(7)
    assert len(shard._open) <= 4 * shard.levels


def test_damaged_files_are_noticed():
    whole = image(range(1000))
    for broken in (whole[:-10], b"x" + whole):
        with pytest.raises(ValueError):
            W.Shard(broken)


def test_repetitive_ids_are_compressed():
    assert len(image([5, 9] * 200_000)) < 100_000


def plain_rows(library, rows):
    """(doc_id, start, n_tokens, crc) with rows of one id in any order, as (doc_id, n_tokens, crc) and the starts."""
    coded = [(k, ids_of(library, t) + [W.END_ID]) for k, t in rows]
    return Counter((k, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for k, i in coded), sum(len(i) for _, i in coded)


@pytest.mark.parametrize("shard_tokens", [1, 500, W.SHARD_TOKENS])
def test_round_trip_of_awkward_rows(spark, awkward, awkward_rows, library, shard_tokens):
    path = scratch_path(spark, "shards")
    W.write_shards(awkward, path, shard_tokens=shard_tokens)
    found = sorted((tuple(r) for r in W.read_documents(spark, path).collect()), key=lambda r: r[1])
    want, total = plain_rows(library, [(k, t) for k, t, _ in awkward_rows])
    assert Counter((k, n, crc) for k, _, n, crc in found) == want
    ends = 0
    for _, start, n, _ in found:
        assert start == ends
        ends += n
    assert ends == total
    keys = [k for k, *_ in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    files = W.shard_files(spark, path).count()
    assert files == len(awkward_rows) if shard_tokens == 1 else files >= 1


def test_whole_table(spark, small, con, library):
    path = scratch_path(spark, "shards")
    W.write_shards(spark.read.parquet(f"{small}/documents.parquet"), path, shard_tokens=5000)
    found = {r["id"]: r for r in W.read_documents(spark, path, with_ids=True).collect()}
    start = 0
    counts, places = Counter(), Counter()
    for key, text in con.execute("select doc_id, text from documents order by doc_id").fetchall():
        ids = [*ids_of(library, text), W.END_ID]
        row = found.pop(key)
        assert (row["start"], row["n_tokens"], row["ids"]) == (start, len(ids), ids)
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
        counts.update(ids)
        places.update((t, key, i) for i, t in enumerate(ids) if t in (1, 267, 518))
    assert not found
    wanted = [1, 267, 518, 49_405]
    assert {r["token"]: r["n"] for r in W.token_counts(spark, path, wanted).collect()} == {t: counts[t] for t in wanted}
    assert Counter(tuple(r) for r in W.occurrences(spark, path, wanted).collect()) == places


def test_one_id_with_all_rows_is_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would else be one task's
    path = scratch_path(spark, "shards")
    W.write_shards(spark.range(4000).selectExpr("7L as doc_id", "concat('word ', id % 50) as text"), path, shard_tokens=1000)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = W.read_documents(spark, path).collect()
    assert len(rows) == 4000 and len({r["start"] for r in rows}) == 4000
    tasks = {W.Shard(r["content"]).about["task"] for r in W.shard_files(spark, path).collect()}
    assert len(tasks) > 1


def test_nothing(spark, nothing):
    path = scratch_path(spark, "shards")
    W.write_shards(nothing, path)
    assert W.read_documents(spark, path).count() == 0
    assert W.token_counts(spark, path, [1]).count() == 0
