"""Document quality from a linear-chain conditional random field over the lines of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunehouse.llm.common import fields, whole_row

SAMPLE_DOCS = 4_000  # labelled documents that the model is fitted on, at most
SAMPLE_LINES = 300  # longer labelled documents are not taken into that sample
THRESHOLD = 0.3
BAD_SHARE = 0.5  # of a document with label 0 at least this share of its lines is taken to be bad
SPLICED = 0.5  # of the good documents of the sample this share gets a block of a bad one
CERTAIN = 30.0  # the score of a line whose label is known
SEED = 11
TOGETHER = 256  # texts scored at a time
TOGETHER_LINES = 1 << 15  # and their lines

CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "#*$%&|<>", "!", "|", "0123456789", ".,;:?")
IN_CLASS = np.zeros((len(CLASSES), 256), np.float32)
for _row, _chars in enumerate(CLASSES):
    IN_CLASS[_row, [ord(c) for c in _chars]] = 1
N_OWN = 14
N_FEATURES = 3 * N_OWN + 3


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x 14 features, bytes per line) of the lines that hold a word; a text without words is one empty line."""
    lines = [x for x in (text or "").encode("utf-8", "surrogatepass").split(b"\n") if x.strip()]
    if not lines:
        return np.zeros((1, N_OWN), np.float32), np.ones(1, np.float32)
    n = len(lines)
    own = np.zeros((n, N_OWN), np.float32)
    size = np.fromiter(map(len, lines), np.int64, n)
    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
    raw = np.frombuffer(b"".join(lines), np.uint8)
    upper, lower, symbols, bangs, pipes, digits, stops = (np.add.reduceat(x[raw], starts) for x in IN_CLASS)
    words, unique, short, dup, ends, starts_upper = (np.zeros(n, np.float32) for _ in range(6))
    seen: set[bytes] = set()
    for i, line in enumerate(lines):
        parts = line.split()
        words[i], unique[i] = len(parts), len(set(parts))
        short[i] = sum([len(p) < 4 for p in parts])
        dup[i] = line in seen
        seen.add(line)
        ends[i] = line.rstrip()[-1:] in b".!?"
        starts_upper[i] = line.lstrip()[:1].isupper()
    own[:, 0] = np.log1p(size) / 6
    own[:, 1] = np.log1p(words) / 4
    own[:, 2] = upper / (upper + lower + 1)
    own[:, 3] = symbols / size
    own[:, 4] = 1 - unique / words
    own[:, 5] = np.minimum(1, bangs / words)
    own[:, 6] = np.minimum(1, pipes / words)
    own[:, 7] = np.minimum(3, size / words / 10)
    own[:, 8] = short / words
    own[:, 9] = ends
    own[:, 10] = digits / size
    own[:, 11] = starts_upper
    own[:, 12] = dup
    own[:, 13] = np.minimum(1, stops / words)
    return own, size.astype(np.float32)


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """A line's own features, those of the line before and after, first and last line, and a constant."""
    zero = np.zeros((1, N_OWN), np.float32)
    edge = np.zeros((len(own), 3), np.float32)
    edge[0, 0] = edge[-1, 1] = 1
    edge[:, 2] = 1
    return np.concatenate([own, np.concatenate([zero, own[:-1]]), np.concatenate([own[1:], zero]), edge], axis=1)


class Chains:
    """Many lines' sequences, laid out step by step, the longest first, so that one step handles all sequences."""

    def __init__(self, lengths: np.ndarray) -> None:
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths[order[0]])
        self.active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
        self.first = np.concatenate(([0], np.cumsum(self.active)))
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))[order]
        # the place in the document-by-document layout of each place in the step-by-step one
        self.source = np.concatenate([starts[:a] + t for t, a in enumerate(self.active)])

    def step(self, t: int) -> slice:
        return slice(self.first[t], self.first[t + 1])

    def marginals(self, good: np.ndarray, move: np.ndarray, moves: bool = True) -> tuple[np.ndarray, np.ndarray, float]:
        """Forward-backward: P(good) per line, expected moves (2 x 2, if wanted), and the log of the normaliser.

        good: the score of label good per line (bad has 0), step by step; move: the scores of moves.
        """
        emit = np.stack([np.zeros_like(good), good], axis=1)
        ahead, back = np.empty_like(emit), np.zeros_like(emit)
        for t, n in enumerate(self.active):
            now = self.step(t)
            ahead[now] = emit[now]
            if t:
                prior = ahead[self.first[t - 1] : self.first[t - 1] + n]
                ahead[now] += np.logaddexp(prior[:, :1] + move[0], prior[:, 1:] + move[1])
        expected = np.zeros((2, 2))
        for t in range(len(self.active) - 1, 0, -1):
            n, now = self.active[t], self.step(t)
            before = slice(self.first[t - 1], self.first[t - 1] + n)
            onward = emit[now] + back[now]
            back[before] = np.logaddexp(move[:, 0] + onward[:, :1], move[:, 1] + onward[:, 1:])
            if moves:
                z = np.logaddexp(*(ahead[now] + back[now]).T)
                pair = ahead[before][:, :, None] + move + onward[:, None, :] - z[:, None, None]
                expected += np.exp(pair).sum(axis=0)
        both = ahead + back
        p = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
        return p, expected, float(np.logaddexp(*both[self.step(0)].T).sum())


@dataclass
class Model:
    """Weights of the features and moves, and the logistic scale of a document's mean marginal."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    move: np.ndarray
    slope: float
    shift: float

    def line_marginals(self, own: list[np.ndarray]) -> np.ndarray:
        """P(good) of every line, document by document."""
        lengths = np.array([len(x) for x in own])
        chains = Chains(lengths)
        x = (np.concatenate([with_neighbours(o) for o in own]) - self.mean) / self.scale
        p = np.empty(len(x))
        p[chains.source] = chains.marginals((x @ self.weights)[chains.source], self.move, moves=False)[0]
        return p

    def mean_marginals(self, own: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
        """Length-weighted mean over a document's lines of P(good), per document."""
        return self._means(self.line_marginals(own), own, sizes)[0]

    @staticmethod
    def _means(p: np.ndarray, own: list[np.ndarray], sizes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(x) for x in own])
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        size = np.concatenate(sizes)
        return np.add.reduceat(p * size, starts) / np.add.reduceat(size, starts), lengths, np.add.reduceat((p < 0.5).astype(np.int64), starts)

    def judge(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score from 0 to 1, lines, bad lines) of each text; as many texts are held as matrices at a time as have
        ``TOGETHER`` texts or ``TOGETHER_LINES`` lines."""
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        own: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        lines = 0
        for i, text in enumerate(texts):
            features, size = line_features(text)
            own.append(features)
            sizes.append(size)
            lines += len(features)
            if len(own) == TOGETHER or lines >= TOGETHER_LINES or i == len(texts) - 1:
                mean, n, bad = self._means(self.line_marginals(own), own, sizes)
                parts.append((self.scaled(mean), n, bad))
                own, sizes, lines = [], [], 0
        return tuple(np.concatenate(column) for column in zip(*parts, strict=True))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Quality from 0 to 1 of each text."""
        return self.judge(texts)[0]

    def scaled(self, mean: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit(mean) + self.shift, -500, 500)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _climb(start: np.ndarray, slope_of, rounds: int, rate: float) -> np.ndarray:
    """Adam, full batch."""
    at, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for k in range(1, rounds + 1):
        g = slope_of(at)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        at += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return at


def spliced(own: list[np.ndarray], labels: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The documents, and beside them good ones with a run of lines of a bad one inside: (features, labels of lines).

    So the model sees where good and bad lines meet. A line of a document with label 1 is good (1); one that comes from a document with
    label 0 is hidden (-1).
    """
    draw = np.random.default_rng(SEED)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    rows, marks = list(own), [np.full(len(x), 1 if y else -1) for x, y in zip(own, labels, strict=True)]
    for i in draw.permutation(good)[: int(len(good) * SPLICED)]:
        other = own[draw.choice(bad)]
        length = int(draw.integers(1, min(len(other), 8) + 1))
        start, at = int(draw.integers(0, len(other) - length + 1)), int(draw.integers(0, len(own[i]) + 1))
        rows.append(np.concatenate([own[i][:at], other[start : start + length], own[i][at:]]))
        marks.append(np.concatenate([np.full(at, 1), np.full(length, -1), np.full(len(own[i]) - at, 1)]))
    return rows, marks


def fit(own: list[np.ndarray], sizes: list[np.ndarray], labels: np.ndarray, penalty: float = 2.0) -> Model:
    """Maximum likelihood with an L2 penalty over hidden line labels.

    Lines of good documents are good. Lines of bad ones are hidden: their labels are expected under the model itself (EM),
    with one multiplier per chain that rises until at least ``BAD_SHARE`` of its hidden lines are bad. Each step climbs
    the difference between the expectations with and without that knowledge. Without documents of both labels the score
    is the share of label 1 for every text, 0.5 without any document.
    """
    plain = Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), np.zeros((2, 2)), 0.0, 0.0)
    if len(set(labels.tolist())) < 2:
        plain.shift = 0.0 if not len(labels) else float(logit(np.array([labels.mean()]))[0])
        return plain
    rows, marks = spliced(own, labels)
    lengths = np.array([len(x) for x in rows])
    chains = Chains(lengths)
    x = np.concatenate([with_neighbours(o) for o in rows])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    mean[-1], scale[-1] = 0, 1
    x = ((x - mean) / scale)[chains.source]
    chain = np.repeat(np.arange(len(rows)), lengths)[chains.source]
    hidden = np.concatenate(marks)[chains.source] < 0
    n_hidden = np.bincount(chain, hidden, len(rows))
    share = labels.mean()
    n = len(rows)
    tilt = np.zeros(n)  # the multipliers

    def slope_of(at: np.ndarray) -> np.ndarray:
        w, move = at[:N_FEATURES], at[N_FEATURES:].reshape(2, 2)
        good = x @ w
        p, moves, _ = chains.marginals(good, move)
        q, known_moves, _ = chains.marginals(np.where(hidden, good - tilt[chain], CERTAIN), move)
        lack = BAD_SHARE - np.bincount(chain, (1 - q) * hidden, n) / np.maximum(n_hidden, 1)
        tilt[:] = np.clip(tilt + lack * (n_hidden > 0), 0, CERTAIN)
        return np.concatenate([x.T @ (q - p), (known_moves - moves).ravel()]) / n - penalty * at / n

    at = _climb(np.zeros(N_FEATURES + 4), slope_of, 150, 0.1)
    model = Model(mean, scale, at[:N_FEATURES], at[N_FEATURES:].reshape(2, 2), 1.0, 0.0)
    m = logit(model.mean_marginals(own, sizes))

    def scale_slope(ab: np.ndarray) -> np.ndarray:
        e = labels - 1 / (1 + np.exp(-np.clip(ab[0] * m + ab[1], -500, 500)))
        return np.array([(e * m).mean(), e.mean()]) - 1e-3 * ab

    model.slope, model.shift = map(float, _climb(np.array([1.0, logit(np.array([share]))[0]]), scale_slope, 400, 0.05))
    model.slope = max(model.slope, 1e-3)  # a higher mean never scores lower
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text leaves 0 modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> Model:
    """Fit on at most ``sample_docs`` labelled rows that are not held out: those of the smallest hash of doc_id.

    Sampled documents of more than ``sample_lines`` lines are passed over. The lines' features are computed by
    tasks; only they reach the driver (at most sample_docs x sample_lines x 14 floats).
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    hashed = F.xxhash64("doc_id")
    picked = known.select("doc_id", F.col("quality").cast("int").alias("quality")).orderBy(hashed, "doc_id", "quality").limit(sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, (text, quality) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                own, size = line_features(text)
                if len(own) <= sample_lines:
                    rows.append((batch.column(0)[i].as_py(), quality, own.tobytes(), size.tobytes()))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("id", "quality", "own", "size"), r, strict=True)) for r in rows],
                pa.schema([("id", pa.int64()), ("quality", pa.int32()), ("own", pa.binary()), ("size", pa.binary())]),
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "quality")
    rows = sample.mapInArrow(run, "id bigint, quality int, own binary, size binary").collect()
    rows.sort(key=lambda r: (r["id"], r["quality"], bytes(r["own"])))  # the same model whatever the order of tasks
    own = [np.frombuffer(r["own"], np.float32).reshape(-1, N_OWN) for r in rows]
    return fit(own, [np.frombuffer(r["size"], np.float32) for r in rows], np.array([r["quality"] for r in rows]))


def with_scores(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, score, n_lines, n_bad_lines) per row of ``docs``: all its columns as a struct, the score from 0 to 1, the
    lines with a word, and those of them that are likelier bad.

    NULL, empty and blank texts are one empty line. Texts are scored whole; nothing but the text is looked at.
    """
    packed = docs.select(whole_row(docs).alias("row"))
    counts = [T.StructField(c, T.LongType()) for c in ("n_lines", "n_bad_lines")]
    schema = T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType()), *counts])
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field(place)
            found = [model.judge(texts.slice(at, TOGETHER).to_pylist()) for at in range(0, len(texts), TOGETHER)]
            found = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0)] * 3
            kinds = (pa.float64(), pa.int64(), pa.int64())
            columns = [pa.array(c, kind) for c, kind in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return packed.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 from a score of 0.3 on), n_lines and n_bad_lines; a NULL id is
    not held out."""
    scored = with_scores(docs.select("doc_id", "text"), train(docs, labels))
    key = F.col("row.doc_id")
    return scored.select(
        key.alias("doc_id"),
        held_out(key).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_lines",
        "n_bad_lines",
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with the same columns."""
    return with_scores(docs, train(docs, labels)).where(F.col("score") >= THRESHOLD).select(*fields(docs, "row"))
