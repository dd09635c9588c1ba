"""Pack documents into sequences of tokens in their order, cutting where it costs least."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LENGTH = 2048
END_ID = 1  # closes each document
BLOCK = 1 << 18  # tokens after which a run of documents is packed and let go
SENTENCE_PENALTY = 1.0  # padding tokens that a cut at a sentence's end is worth
FORCED_PENALTY = 16.0  # the same for a cut inside a sentence
SHORT_PENALTY = 4.0  # the same for a sequence that is not filled up, as its length is a power of two
BEYOND = re.compile("[^\x00-\u024f]")
SPACES = re.compile(r"\s+")
LONG_SPACE = 100_000  # the faster encoder gives up on much longer runs of white space
# fixed values: full stops, question and exclamation marks and line breaks of the world's scripts, and what may close a sentence after them
STOPS = tuple(c.encode() for c in ".!?\n。．！？｡।॥؟۔։።፧။།។៕‼⁇⁈⁉…\u2028\u2029")
CLOSERS = tuple(c.encode() for c in "\"”’»」』）】")
NO_END, END, PERHAPS = 0, 1, 2  # a token of the last kind ends a sentence if those before it begin the mark
PIECES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def _fast(path: str):
    """The same vocabulary in a faster encoder, and the special tokens it does not know."""
    import public_tokenizers
    import tiktoken

    pieces, special = _vocabulary(path)
    as_byte = _bytes_by_char()
    ranks = {bytes(as_byte[c] for c in piece): i for piece, i in pieces.items() if piece not in special}
    return tiktoken.Encoding("pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), special


def _vocabulary(path: str) -> tuple[dict[str, int], list[str]]:
    """Pieces and their ids, the special ones included, and the special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return spec["model"]["vocab"] | added, list(added)


def _bytes_by_char() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as its character and the others as characters from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def _sentence_ends(path: str) -> tuple[np.ndarray, dict[int, bytes]]:
    """Per token id: its text ends a sentence or a line, or may be the rest of a mark of several bytes; and the bytes of
    the tokens that can be part of such a mark."""
    pieces, special = _vocabulary(path)
    as_byte = _bytes_by_char()
    kinds = np.full(max(pieces.values()) + 1, NO_END, np.int8)
    parts: dict[int, bytes] = {}
    rests = {stop[k:] for stop in STOPS for k in range(1, len(stop))}
    begins = tuple({stop[:k] for stop in STOPS for k in range(1, len(stop))})
    for piece, i in pieces.items():
        if piece in special:
            continue
        raw = bytes(as_byte[c] for c in piece)
        bare = raw
        while bare.endswith(CLOSERS):
            bare = bare[: -next(len(c) for c in CLOSERS if bare.endswith(c))]
        if bare.endswith(STOPS):
            kinds[i] = END
        elif raw in rests:
            kinds[i] = PERHAPS
        if raw in rests or raw.endswith(begins):
            parts[i] = raw
    return kinds, parts


def sentence_places(ids: np.ndarray, ends: tuple[np.ndarray, dict[int, bytes]]) -> np.ndarray:
    """Places after tokens that end a sentence, ascending; a mark may lie in up to as many tokens as it has bytes."""
    kinds, parts = ends
    kind = kinds[ids]
    found = kind == END
    for i in np.flatnonzero(kind == PERHAPS).tolist():
        found[i] = b"".join(parts.get(t, b"") for t in ids[max(0, i - 2) : i + 1].tolist()).endswith(STOPS)
    return np.flatnonzero(found) + 1


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def has_long_space(text: str) -> bool:
    return len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in SPACES.finditer(text))


def token_ids(texts: list[str | None], path: str) -> list[np.ndarray]:
    """Ids of each whole text without special tokens added; none for NULL and empty texts.

    Texts of characters below U+0250 without the string of a special token and without a very long run of white space go
    through the faster encoder, which gives the same ids there; all others through the tokenizer itself.
    """
    fast, special = _fast(path)
    out: list[np.ndarray] = []
    for text in texts:
        if not text:
            ids = []
        elif (text.isascii() or not BEYOND.search(text)) and not any(s in text for s in special) and not has_long_space(text):
            ids = fast.encode_ordinary(text)
        else:
            ids = _tokenizer(path).encode(text, add_special_tokens=False).ids
        out.append(np.array(ids, np.uint32))
    return out


def cut_points(ids: np.ndarray, ends: tuple[np.ndarray, dict[int, bytes]], doc_ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a run of tokens may be cut, ascending, 0 and the end included, and the penalty of each.

    Cuts at a document's end are free. Forced ones are put where two places lie further apart than a sequence, and
    before the end; the search itself adds those that fill a sequence up.
    """
    total = len(ids)
    places = sentence_places(ids, ends)
    places = np.setdiff1d(places, np.concatenate([doc_ends, doc_ends - 1]))
    at = np.concatenate([[0], doc_ends, places])
    cost = np.concatenate([np.zeros(len(doc_ends) + 1), np.full(len(places), SENTENCE_PENALTY)])
    wide = np.sort(at)
    gaps = np.flatnonzero(np.diff(wide) > length)
    inside = [np.arange(wide[i] + length // 8, wide[i + 1], length // 8) for i in gaps]
    # the run's last tokens hardly fill a sequence, but may make a few whose lengths are powers of two
    powers = 1 << np.arange(length.bit_length())
    tail = total - np.concatenate([powers, np.add.outer(powers, powers).ravel()])
    more = np.setdiff1d(np.concatenate([*inside, tail[tail > 0]]), at)
    at = np.concatenate([at, more])
    cost = np.concatenate([cost, np.full(len(more), FORCED_PENALTY)])
    order = np.argsort(at, kind="stable")
    at, cost = at[order], cost[order]
    assert at[0] == 0 and at[-1] == total
    return at, cost


def best_cuts(at: list[int], cost: list[float], length: int, fill: float | None = None) -> list[int]:
    """Cuts of least padding and penalty from the first place to the last, as places, ascending.

    A sequence of n tokens is padded to ``length``, except where n is a power of two, which costs a little. Let
    f[j] be the least cost up to place j. Then f[j] = cost[j] + min(f[i] + length - (at[j] - at[i])) over the
    places i within ``length`` before j, so the least f[i] + at[i] of a sliding window is wanted: a queue of
    ascending values holds it at its head, and each place enters and leaves it once. The powers of two are looked
    up besides; those below a 64th of ``length`` only for the last ``length`` tokens, where they can spare much padding.

    With ``fill``, a sequence may also be filled up from any place, filled-up ones included, at that penalty. A cut
    elsewhere could be moved on to such a place, and only the queue's head can be worth it: where head i leaves the
    queue, place at[i] + ``length`` is added, unless the next place is at least as good for all that follows.
    """
    place, best, source = [at[0]], [0.0], [0]
    number = [-1] * (at[-1] + 1)  # place -> its index
    number[at[0]] = 0
    powers = [1 << k for k in range(length.bit_length()) if 1 << k < length]
    large = [p for p in powers if 64 * p >= length]
    tail = at[-1] - length
    queue, values, head = [0], [0.0], 0
    for here, penalty in zip(at[1:], cost[1:], strict=True):
        low = here - length
        if place[queue[head]] < low:
            if fill is not None:
                stays = head + 1
                while stays < len(queue) and place[queue[stays]] < low:
                    stays += 1
                enough = values[stays] + penalty - fill if stays < len(queue) else float("inf")
            while place[queue[head]] < low:
                i, value = queue[head], values[head]
                head += 1
                if fill is None or value >= enough or number[place[i] + length] >= 0:
                    continue
                value += fill + length
                while len(queue) > head and values[-1] >= value:
                    queue.pop()
                    values.pop()
                number[place[i] + length] = len(place)
                queue.append(len(place))
                values.append(value)
                place.append(place[i] + length)
                best.append(best[i] + fill)
                source.append(i)
        i = queue[head]
        short, via = values[head] + length - here - SHORT_PENALTY, i
        for p in powers if here > tail else large:
            k = number[here - p] if here >= p else -1
            if k >= 0 and best[k] < short:
                short, via = best[k], k
        least = short + SHORT_PENALTY + penalty
        number[here] = len(place)
        value = least + here
        while len(queue) > head and values[-1] >= value:
            queue.pop()
            values.pop()
        queue.append(len(place))
        values.append(value)
        place.append(here)
        best.append(least)
        source.append(via)
    cuts, j = [], len(place) - 1
    while j:
        cuts.append(place[j])
        j = source[j]
    return [0, *reversed(cuts)]


def pack_run(docs: list[np.ndarray], ends: tuple[np.ndarray, dict[int, bytes]], length: int = LENGTH) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Pieces (document, start, length, crc32 of the ids, sequence, offset) of a run of documents, in order.

    ``docs`` are ids with the closing id. No piece crosses a document, no sequence is longer than ``length``.
    """
    ids = np.concatenate(docs)
    doc_ends = np.cumsum([len(d) for d in docs])
    at, cost = cut_points(ids, ends, doc_ends, length)
    cuts = np.array(best_cuts(at.tolist(), cost.tolist(), length, FORCED_PENALTY))
    edges = np.unique(np.concatenate([cuts, doc_ends]))
    starts, stops = edges[:-1], edges[1:]
    doc = np.searchsorted(doc_ends, starts, side="right")
    sequence = np.searchsorted(cuts, starts, side="right") - 1
    doc_starts = np.concatenate([[0], doc_ends[:-1]])
    raw = memoryview(ids.astype("<u4").tobytes())
    for a, b, d, s in zip(starts.tolist(), stops.tolist(), doc.tolist(), sequence.tolist(), strict=True):
        yield d, a - int(doc_starts[d]), b - a, zlib.crc32(raw[4 * a : 4 * b]), s, a - int(cuts[s])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The documents of a task are packed in their order, block by block (``block`` tokens, and then the rest of the document);
    a block ends with a document, and a sequence never spans two blocks, so memory is bounded by a block and the
    largest document. There is no shuffle: sequence ids are unique as task number and count. NULL and empty texts
    are the closing id alone; repeated rows and NULL ids are packed like any other; other columns are not read.
    """
    kind = docs.schema[id_col].dataType
    path = tokenizer
    schema = T.StructType([T.StructField("id", kind), *T._parse_datatype_string(PIECES).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        where = path or default_tokenizer()
        ends = _sentence_ends(where)
        first = TaskContext.get().partitionId() << 40
        held: list[np.ndarray] = []
        keys: list = []
        size, done = 0, 0
        id_type = None

        def packed() -> pa.RecordBatch:
            nonlocal done
            doc, start, count, crc, sequence, offset = (np.array(c, np.int64) for c in zip(*pack_run(held, ends, length), strict=True))
            total = np.array([len(d) for d in held], np.int64)[doc]
            number = first + done + sequence
            done += int(sequence[-1]) + 1
            rows = [pa.array(keys, id_type).take(pa.array(doc))]
            rows += [pa.array(c) for c in (start, count, crc, total, number, offset)]
            return pa.RecordBatch.from_arrays(rows, names=schema.names)

        for batch in batches:
            id_type = batch.column(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(token_ids([text.as_py()], where)[0], np.uint32(END_ID))
                held.append(ids)
                keys.append(key)
                size += len(ids)
                if size >= block:
                    yield packed()
                    held, keys, size = [], [], 0
        if held:
            yield packed()

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)
