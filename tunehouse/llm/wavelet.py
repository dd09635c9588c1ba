"""Token ids in one compressed file per shard: a wavelet matrix that is read token by token, counted or searched."""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunehouse.llm.common import landed

END_ID = 1  # closes each document
SHARD_TOKENS = 1 << 20  # a shard ends with the document that reaches this
BLOCK_BITS = 1 << 15  # bits of a plane that are compressed, and so read, at a time
MAGIC = b"TKWM0001"
KNOWN_WORDS = 600_000  # words whose ids a worker remembers
CHUNK_SLOTS = 1 << 22  # places for chunks between white space, half of which are used
LONG_CHUNK = 64  # bytes from which a chunk is not remembered
ENCODED_BYTES = 1 << 19  # bytes of text that are encoded at a time
ROWS = 256  # texts that are unpacked at a time
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SPACES = re.compile(rb"[\x20\x09-\x0D]")
_FACTORS = np.random.default_rng(13).integers(0, 1 << 64, LONG_CHUNK + 1, np.uint64) | np.uint64(1)
MARK = "1"  # a digit is a word and a token of its own, so no other word has its id
# characters that lower-casing and composition treat one by one and that the vocabulary's pattern splits as below
_OTHER = re.compile("[^!-~\xa1-įı-ſ]")
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼½¾]|[^\\s0-9a-zªµºß-öø-ſ²³¹¼½¾]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@lru_cache(maxsize=1)
def _symbols() -> list[str]:
    """Byte-level vocabularies write a printable byte as its character and the others as characters from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def as_symbols(word: str) -> str:
    """A word as the vocabulary spells it: one character for each byte."""
    symbols = _symbols()
    return "".join([symbols[b] for b in word.encode()])


class ChunkTable:
    """Ids by the hash of a chunk, for whole arrays of hashes at a time: open addressing with linear probing."""

    def __init__(self, slots: int = CHUNK_SLOTS):
        self.keys = np.zeros(slots, np.uint64)  # 0: free
        self.index = np.zeros(slots, np.int32)
        self.begin = np.zeros(1024, np.int64)
        self.length = np.zeros(1024, np.int64)
        self.pool = np.zeros(4096, np.uint32)
        self.clear()

    def clear(self) -> None:
        self.keys[:] = 0
        self.entries = self.used = 0

    def full(self) -> bool:
        return 2 * self.entries > len(self.keys) or self.used > 2 * len(self.keys)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where there is none."""
        found = np.full(len(hashes), -1, np.int64)
        place = (hashes & np.uint64(len(self.keys) - 1)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            key = self.keys[place[left]]
            hit = key == hashes[left]
            found[left[hit]] = self.index[place[left[hit]]]
            left = left[~hit & (key != 0)]
            place[left] = (place[left] + 1) % len(self.keys)
        return found

    def add(self, ids: list[bytes]) -> np.ndarray:
        """New entries for ids (little-endian 32-bit); they have no hash yet."""
        new = np.arange(self.entries, self.entries + len(ids))
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        self.begin, self.length = (_grown(x, self.entries + len(ids)) for x in (self.begin, self.length))
        self.pool = _grown(self.pool, self.used + int(sizes.sum()))
        self.begin[new] = self.used + np.cumsum(sizes) - sizes
        self.length[new] = sizes
        self.pool[self.used : self.used + sizes.sum()] = np.frombuffer(b"".join(ids), "<u4")
        self.entries += len(ids)
        self.used += int(sizes.sum())
        return new

    def name(self, hashes: np.ndarray, entries: np.ndarray) -> None:
        """Find entries by their hashes, all different, from now on."""
        place = (hashes & np.uint64(len(self.keys) - 1)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.keys[place[left]] == 0]
            self.keys[place[free]] = hashes[free]  # of several for one slot the last one gets it
            won = free[self.keys[place[free]] == hashes[free]]
            self.index[place[won]] = entries[won]
            left = left[self.keys[place[left]] != hashes[left]]
            place[left] = (place[left] + 1) % len(self.keys)

    def ids(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries' ids, end to end, and where those of each begin, the end included."""
        sizes = self.length[entries]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.pool[np.repeat(self.begin[entries] - ends[:-1], sizes) + np.arange(ends[-1])], ends


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


class Encoder:
    """Ids of whole texts by the tokenizers library, which is asked once for each word.

    The vocabulary drops white space and encodes what lies between piece by piece, so the ids of a text are those of its
    chunks between ASCII white space, and these are remembered by a hash of 64 bits with random factors. A new chunk of letters up
    to U+017F is split into words here, and the unknown words go to the library together; chunks with other characters or a
    special token's string go to it whole. What takes too much memory is forgotten all at once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # the same vocabulary without the steps that splitting has done, and without a memory of its own
        bare = models.BPE(vocab=model["vocab"], merges=pairs, end_of_word_suffix=model["end_of_word_suffix"], cache_capacity=0)
        self.single = Tokenizer(bare)
        self.single.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.mark = self.single.encode(MARK).ids
        self.chunks = ChunkTable()
        self.words: dict[str, bytes] = {}

    def _learn_words(self, words: list[str]) -> None:
        """Many words in one call: a single character, which is a token of its own, stands after each."""
        long = [w for w in words if len(w) > 1]
        spelt = [w if w.isascii() else as_symbols(w) for w in long]
        ids = np.array(self.single.encode_batch_fast([f" {MARK} ".join([*spelt, ""])], add_special_tokens=False)[0].ids, "<u4")
        raw, ends = ids.tobytes(), np.flatnonzero(ids == self.mark[0])
        if len(ends) != len(long):
            raise ValueError("the vocabulary has its mark in longer words")
        begin = 0
        for word, end in zip(long, (4 * ends).tolist(), strict=True):
            self.words[word] = raw[begin:end]
            begin = end + 4
        for word in words:
            if len(word) == 1:
                self.words[word] = np.array(self.single.encode(as_symbols(word), add_special_tokens=False).ids, "<u4").tobytes()

    def chunk_ids(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks without white space."""
        split: list[list[str] | None] = []
        for chunk in chunks:
            text = chunk.decode("utf-8", "replace")
            if chunk.isalpha():  # ASCII letters only: one word
                split.append([text.lower()])
            else:
                plain = not _OTHER.search(text) and not ("<" in text and any(s in text for s in self.special))
                split.append(_WORDS.findall(text.lower()) if plain else None)
        known = self.words
        unknown = {w for words in split if words for w in words if w not in known}
        if unknown:
            self._learn_words(list(unknown))
        out = []
        for chunk, words in zip(chunks, split, strict=True):
            if words is None:
                text = chunk.decode("utf-8", "replace")
                out.append(np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                out.append(known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words]))
        return out

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids per text (UTF-8)."""
        if self.chunks.full():
            self.chunks.clear()
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()
        raw = b"\n".join([b"", *texts, b""])
        data = np.frombuffer(raw, np.uint8)
        inside = ~_IS_SPACE[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # every text is surrounded by breaks
        start, size = edges[::2], edges[1::2] - edges[::2]
        if not len(start):
            return [np.zeros(0, np.uint32) for _ in texts]
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        factors = _FACTORS[np.minimum(place, LONG_CHUNK)]
        hashes = np.add.reduceat((data[inside].astype(np.uint64) + np.uint64(1)) * factors, first)
        hashes ^= hashes >> np.uint64(29)
        hashes[hashes == 0] = 1
        short = size <= LONG_CHUNK
        entries = np.where(short, self.chunks.find(hashes), -1)
        missing = np.flatnonzero(short & (entries < 0))
        if len(missing):
            new, where, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            at = missing[where]
            added = self.chunks.add(self.chunk_ids([raw[a:b] for a, b in zip(start[at].tolist(), (start + size)[at].tolist(), strict=True)]))
            self.chunks.name(new, added)
            entries[missing] = added[back]
        large = np.flatnonzero(~short)
        if len(large):
            entries[large] = self.chunks.add(self.chunk_ids([raw[start[i] : start[i] + size[i]] for i in large.tolist()]))
        ids, ends = self.chunks.ids(entries)
        lengths = np.array([len(t) + 1 for t in texts])
        begins = 1 + np.cumsum(lengths) - lengths
        cuts = ends[np.searchsorted(start, np.append(begins, len(raw)))]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def in_pieces(texts: list[bytes], size: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """Numbers and parts of texts, some ``size`` bytes at a time; a longer text is cut at white space, so that its parts' ids
    are its own in a row."""
    numbers: list[int] = []
    parts: list[bytes] = []
    held = 0
    for number, text in enumerate(texts):
        at = 0
        while at < len(text) or (at == 0 and not text):
            end = len(text)
            if end - at > size:
                gap = _SPACES.search(text, at + size)
                end = gap.end() if gap else end
            numbers.append(number)
            parts.append(text[at:end])
            held += end - at
            at = max(end, 1)
            if held >= size:
                yield numbers, parts
                numbers, parts, held = [], [], 0
    if parts:
        yield numbers, parts


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def planes_of(ids: np.ndarray, levels: int) -> Iterator[np.ndarray]:
    """Bit-planes from the highest bit on, as booleans; after each the ids are dealt anew, zeros first, in their order."""
    for level in range(levels - 1, -1, -1):
        bits = (ids & ids.dtype.type(1 << level)) != 0
        yield bits
        ids = np.concatenate([ids[~bits], ids[bits]])


def shard_image(ids: np.ndarray, docs: pa.RecordBatch, **about: int) -> bytes:
    """One file: magic, length of the file, a header in JSON, the documents' table, the planes' compressed blocks.

    The header holds per plane its zeros, and per block of ``BLOCK_BITS`` bits the ones before it and its place.
    """
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    ids = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(docs)
    parts, place, planes = [sink.getvalue().to_pybytes()], 0, []
    place = len(parts[0])
    press = zstandard.ZstdCompressor(level=1)
    for bits in planes_of(ids, levels):
        ones, places = [], []
        raw = np.packbits(bits, bitorder="little").tobytes()
        for start in range(0, len(bits), BLOCK_BITS):
            block = raw[start // 8 : (start + BLOCK_BITS) // 8]
            small = press.compress(block)
            parts.append(small if len(small) < len(block) else block)
            ones.append(int(np.count_nonzero(bits[start : start + BLOCK_BITS])))
            places.append(place)
            place += len(parts[-1])
        before = np.concatenate([[0], np.cumsum(ones)]).astype(int).tolist()
        planes.append({"zeros": len(bits) - before[-1], "ones_before": before, "places": [*places, place]})
    header = json.dumps({**about, "n_tokens": len(ids), "n_docs": docs.num_rows, "docs": len(parts[0]), "planes": planes}).encode()
    size = len(MAGIC) + 16 + len(header) + place
    return b"".join([MAGIC, struct.pack("<QQ", size, len(header)), header, *parts])


class Shard:
    """A shard's file; blocks are unpacked as they are asked for."""

    def __init__(self, image: bytes):
        if image[: len(MAGIC)] != MAGIC:
            raise ValueError("not a shard of token ids")
        size, length = struct.unpack_from("<QQ", image, len(MAGIC))
        if len(image) < size:
            raise ValueError(f"a shard of {size} bytes has only {len(image)}")
        start = len(MAGIC) + 16
        self.about = json.loads(image[start : start + length])
        self.body = memoryview(image)[start + length : size]
        self.planes = self.about["planes"]
        self.levels = len(self.planes)
        self.n = self.about["n_tokens"]
        self._open: dict[tuple[int, int], np.ndarray] = {}

    def documents(self) -> pa.Table:
        return pa.ipc.open_stream(self.body[: self.about["docs"]]).read_all()

    def _block(self, level: int, block: int) -> np.ndarray:
        """Bits of one block, as 0 and 1."""
        if (level, block) not in self._open:
            a, b = self.planes[level]["places"][block : block + 2]
            count = min(BLOCK_BITS, self.n - block * BLOCK_BITS)
            raw = self.body[a:b]
            if len(raw) < (count + 7) // 8:
                raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=BLOCK_BITS // 8)
            self._open[level, block] = np.unpackbits(np.frombuffer(raw, np.uint8), count=count, bitorder="little")
        return self._open[level, block]

    def _plane(self, level: int) -> np.ndarray:
        found = [self._block(level, b) for b in range(len(self.planes[level]["places"]) - 1)]
        return np.concatenate(found).astype(bool) if found else np.zeros(0, bool)

    def ones(self, level: int, place: int) -> int:
        """Rank: ones of a plane before a place."""
        block, rest = divmod(place, BLOCK_BITS)
        before = self.planes[level]["ones_before"][block]
        return before + (int(np.count_nonzero(self._block(level, block)[:rest])) if rest else 0)

    def select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        before = np.array(self.planes[level]["ones_before"])
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK_BITS, self.n) - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        return block * BLOCK_BITS + int(np.flatnonzero(self._block(level, block) == bit)[k - before[block]])

    def access(self, place: int) -> int:
        """The token at a place."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        token = 0
        for level in range(self.levels):
            ones = self.ones(level, place)
            bit = int(self._block(level, place // BLOCK_BITS)[place % BLOCK_BITS])
            place = self.planes[level]["zeros"] + ones if bit else place - ones
            token = token << 1 | bit
        return token

    def _interval(self, token: int, start: int, stop: int) -> tuple[int, int]:
        """Where the occurrences of a token among the places [start, stop) lie after the last plane."""
        if token >> self.levels:
            return 0, 0
        for level in range(self.levels):
            a, b = self.ones(level, start), self.ones(level, stop)
            if token >> (self.levels - 1 - level) & 1:
                start, stop = self.planes[level]["zeros"] + a, self.planes[level]["zeros"] + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of a token among the places [start, stop)."""
        a, b = self._interval(token, start, self.n if stop is None else stop)
        return b - a

    def locate(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of a token."""
        first, last = self._interval(token, 0, self.n)
        if not 0 <= k < last - first:
            raise IndexError(k)
        place = first + k
        for level in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - level) & 1
            place = self.select(level, bit, place - self.planes[level]["zeros"] if bit else place)
        return place

    def places(self, token: int) -> np.ndarray:
        """All places of a token, ascending: the planes are climbed for all of them at once."""
        first, last = self._interval(token, 0, self.n)
        places = np.arange(first, last)
        for level in range(self.levels - 1, -1, -1):
            if not len(places):
                break
            bit = token >> (self.levels - 1 - level) & 1
            places = np.flatnonzero(self._plane(level) == bit)[places - (self.planes[level]["zeros"] if bit else 0)]
        return places

    def tokens(self) -> np.ndarray:
        """All tokens: the dealing of the planes undone from the last to the first."""
        ids = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            bits = self._plane(level)
            zeros = self.planes[level]["zeros"]
            back = np.empty_like(ids)
            back[~bits] = ids[:zeros]
            back[bits] = ids[zeros:] | ids.dtype.type(1 << (self.levels - 1 - level))
            ids = back
        return ids


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode every whole text, append the closing id and write the ids by ascending id (NULL first), a file per shard.

    Rows are dealt by range of (id, hash of the text), equal ones by a running number, so that a hot id has many tasks; a task
    cuts a shard at the end of the document that fills it. So memory is bounded by a shard and the largest document. NULL
    and empty texts are the closing id alone; repeated rows each have their place, texts of one id by their hash; other columns
    are not read; no rows give no file. Files are named by Spark's writer and carry task and place in their header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer or default_tokenizer()).encode
        task, number, before = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        keys: list = []
        held = 0
        end = np.array([END_ID], np.uint32)

        def close(key, found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            nonlocal held
            keys.append(key)
            ids.append(np.concatenate([*found, end]))
            held += len(ids[-1])
            if held >= shard_tokens:
                yield image()

        def image() -> pa.RecordBatch:
            nonlocal ids, keys, held, number, before
            table = pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array([len(x) for x in ids], pa.int64())], names=["id", "n_tokens"])
            made = shard_image(np.concatenate(ids), table, task=task, shard=number, before=before)
            number, before = number + 1, before + held
            ids, keys, held = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["image"])

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for at in range(0, batch.num_rows, ROWS):  # a batch is not unpacked at once
                some = batch.slice(at, ROWS)
                texts = [t or b"" for t in some.column(1).to_pylist()]
                own = some.column(0).to_pylist()
                open_text: list[np.ndarray] = []
                last = -1
                for numbers, parts in in_pieces(texts, ENCODED_BYTES):
                    for row, found in zip(numbers, encode(parts), strict=True):
                        if row != last and last >= 0:
                            yield from close(own[last], open_text)
                            open_text = []
                        open_text.append(found)
                        last = row
                if last >= 0:
                    yield from close(own[last], open_text)
        if keys:
            yield image()

    text = F.col(f"`{text_col}`").cast("string")
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.xxhash64(text).alias("mark"), F.monotonically_increasing_id().alias("tie"))
    order = [F.asc_nulls_first("id"), F.asc("mark"), F.asc("tie")]
    dealt = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("id", F.col("text").cast("binary"))
    images = dealt.mapInArrow(run, "image binary").select(F.col("image").cast("string").alias("value"))
    images.write.option("maxRecordsPerFile", 1).text(path)


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """(content) per file."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def read_documents(spark: SparkSession, path: str, id_type: str = "bigint", with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document out of the files, and its ``ids`` if wanted.

    ``start`` counts the ids of all documents before it: those before it in its task, by the header, and those of the
    tasks before, of which there is one row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                shard = Shard(content.as_py())
                table = shard.documents()
                ids = shard.tokens()
                raw = memoryview(ids.astype("<u4").tobytes())
                counts = table.column("n_tokens").to_numpy()
                ends = np.cumsum(counts)
                begins = ends - counts
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                arrays = [
                    table.column("id").combine_chunks(),
                    pa.array(np.full(len(counts), shard.about["task"], np.int64)),
                    pa.array(begins + shard.about["before"]),
                    pa.array(counts),
                    pa.array(crcs, pa.int64()),
                ]
                if with_ids:
                    arrays.append(pa.array([ids[a:b].astype(np.int64) for a, b in zip(begins, ends, strict=True)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"id {id_type}, task bigint, place bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    names = [f.split()[0] for f in schema.split(", ")]
    rows = landed(shard_files(spark, path).mapInArrow(run, schema), "shard-documents")[0]
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("task").agg(F.sum("n_tokens").alias("n"))
    # one row per task of the writing sort
    first = sizes.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    return rows.join(F.broadcast(first), "task").select(
        "id", (F.col("first") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])
    )


def token_counts(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, n): occurrences in all files, read from the planes' ranks without the tokens being unpacked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                shard = Shard(content.as_py())
                counts = pa.array([shard.count(t) for t in tokens], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), counts], names=["token", "n"])

    each = shard_files(spark, path).mapInArrow(run, "token bigint, n bigint")
    return each.groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(spark: SparkSession, path: str, tokens: list[int], id_type: str = "bigint") -> DataFrame:
    """(token, id, place): every occurrence in all files, as the place (from 0) in its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                shard = Shard(content.as_py())
                table = shard.documents()
                ends = np.cumsum(table.column("n_tokens").to_numpy())
                for token in tokens:
                    places = shard.places(token)
                    doc = np.searchsorted(ends, places, side="right")
                    begins = np.concatenate([[0], ends[:-1]])[doc]
                    ids = table.column("id").combine_chunks().take(pa.array(doc))
                    arrays = [pa.array(np.full(len(places), token, np.int64)), ids, pa.array(places - begins, pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["token", "id", "place"])

    return shard_files(spark, path).mapInArrow(run, f"token bigint, id {id_type}, place bigint")
