"""Near-duplicate vectors by randomly rotated binary codes with stored correction factors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunehouse.llm.common import landed
from tunehouse.llm.components import connected_components

THRESHOLD = 0.93
TABLES, BITS = 48, 16  # two vectors meet if they share the 16 code bits of any of 48 tables
CONFIDENCE = 5.0  # standard errors that an estimate may be too low before its pair is let go
BLOCK = 512  # rows of a bucket that are compared with as many others at once
SMALL = 32  # buckets up to this size are compared together, pair by pair
CHUNK = 200_000  # pairs compared exactly at a time
SEED = 7


@lru_cache(maxsize=8)
def rotations(dim: int, bits: int) -> np.ndarray:
    """Rows of random orthogonal matrices, stacked: at least ``bits`` of them, and one whole matrix."""
    rng = np.random.default_rng([SEED, dim])
    count = max(1, -(-bits // dim))
    return np.concatenate([np.linalg.qr(rng.standard_normal((dim, dim)))[0].T for _ in range(count)])


def unit(raw: list[bytes], dtype: str) -> np.ndarray:
    """Vectors of one dimension, each of length 1, in double precision."""
    x = np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def encode(x: np.ndarray, tables: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table codes n x tables, sign bits of the first rotation packed, correction factors) of unit vectors.

    A vector's code is the corner of the rotated cube nearest to it; its correction factor is the inner product of the two.
    """
    dim = x.shape[1]
    turned = x @ rotations(dim, tables * bits).T
    keys = (turned[:, : tables * bits] > 0).reshape(len(x), tables, bits) @ (1 << np.arange(bits)).astype(np.int64)
    first = turned[:, :dim]
    return keys.astype(np.uint32), np.packbits(first > 0, axis=1), np.abs(first).sum(axis=1) / np.sqrt(dim)


class Rows:
    """Rows of one dimension as matrices; ``pairs`` finds the links between some of them."""

    def __init__(self, x: np.ndarray, keys: np.ndarray, signs: np.ndarray, factor: np.ndarray, table: np.ndarray, threshold: float) -> None:
        self.x, self.keys, self.factor, self.table, self.threshold = x, keys, factor, table, threshold
        dim = x.shape[1]
        self.corner = (2.0 * np.unpackbits(signs, axis=1, count=dim) - 1) / np.sqrt(dim)
        self.turned = x @ rotations(dim, keys.shape[1])[:dim].T if dim else x
        spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / np.sqrt(max(dim - 1, 1e-9))
        self.least = threshold - CONFIDENCE * spread * np.sqrt(1 - threshold**2) - 1e-9

    def linked(self, i: np.ndarray, j: np.ndarray, check: bool = True) -> np.ndarray:
        """Which of the pairs (i, j) have a cosine of the threshold or more, and meet in no earlier table than this.

        <corner, turned> / factor estimates the cosine without bias; its error has a known spread. Only pairs whose estimate is not too far
        below the threshold are computed exactly, in double precision.
        """
        near = np.arange(len(i))
        if check:
            near = near[np.einsum("ij,ij->i", self.corner[i], self.turned[j]) / self.factor[i] >= self.least[i]]
            near = near[(self.keys[i[near]] == self.keys[j[near]]).argmax(axis=1) == self.table[i[near]]]
        exact = np.einsum("ij,ij->i", self.x[i[near]], self.x[j[near]]) >= self.threshold
        return near[exact]

    def small(self, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links within many small groups of consecutive rows."""
        row = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
        last = np.repeat(start + size, size)
        for shift in range(1, int(size.max())):
            i = row[row + shift < last]
            for at in range(0, len(i), CHUNK):
                a, b = i[at : at + CHUNK], i[at : at + CHUNK] + shift
                hit = self.linked(a, b)
                yield a[hit], b[hit]

    def tile(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links between the rows ``a`` and ``b`` of one bucket, or within ``a`` if both are the same."""
        table = int(self.table[a[0]])
        near = (self.corner[a] @ self.turned[b].T) / self.factor[a][:, None] >= self.least[a][:, None]
        if a is b:
            near = np.triu(near, 1)
        for t in range(table):
            near &= self.keys[a, t][:, None] != self.keys[b, t][None, :]
            if not near.any():
                return
        i, j = np.nonzero(near)
        for at in range(0, len(i), CHUNK):
            u, v = a[i[at : at + CHUNK]], b[j[at : at + CHUNK]]
            hit = self.linked(u, v, check=False)
            yield u[hit], v[hit]


def joined(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows reaches over the links (i, j)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            return label


def valid_vectors(vectors: DataFrame, vector_col: str, dtype: str) -> DataFrame:
    """(row columns, raw): raw has the bytes of a vector that can be compared, NULL for every other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for v in batch.column(2):
                x = None if not v.is_valid else v.values.to_numpy(zero_copy_only=False).astype(dtype)
                good = x is not None and len(x) and np.isfinite(x).all() and x.any()
                raw.append(x.tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["id", "label", "raw"])

    slim = vectors.select("id", "label", vector_col)
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    return slim.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, raw binary")


def vector_links(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    bits: int = BITS,
) -> DataFrame:
    """Per row: id, n_links, component_id, kept.

    Rows are compared if their labels are equal and not NULL and their vectors have the same dimension; a vector
    that is NULL, empty, zero or holds a NULL, NaN or infinity links with nothing. Equal vectors of a label are one
    class from the start, so copies are never paired. Classes meet in buckets of equal code bits; a pair at the
    threshold meets with a probability of 0.998 with the default tables (more when nearer), so recall is high but not certain.
    No bucket is capped: a bucket of more than 512 rows is dealt into blocks, and each pair of blocks is a
    group of its own, so the largest task does not grow with a bucket. A pair that meets in many tables counts in the
    first. Pairs are never written: a group gives counts, and links enough to join its components. All links of a
    cluster of k different vectors still have to be counted, which takes k x k / 2 comparisons spread over tasks.

    component_id is the smallest id reachable (NULL ids are passed over; NULL where all are); kept tells whether that is the row's own.
    """
    spark = vectors.sparkSession
    element = vectors.schema[vector_col].dataType.elementType
    dtype = "<f4" if isinstance(element, T.FloatType) else "<f8"
    cast = "array<float>" if dtype == "<f4" else "array<double>"
    slim = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast(cast).alias("v"))
    own = landed(valid_vectors(slim, "v", dtype), "vectors")[0]
    usable = F.col("raw").isNotNull() & F.col("label").isNotNull()
    classes = own.where(usable).groupBy("label", "raw").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    classes = landed(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")[0]
    width = np.dtype(dtype).itemsize

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            out: list[list] = [[], [], []]
            place: list[int] = []
            for dim in sorted({len(r) for r in raw}):
                at = [i for i, r in enumerate(raw) if len(r) == dim]
                keys, signs, factor = encode(unit([raw[i] for i in at], dtype), tables, bits)
                place += at
                out[0] += [k.tobytes() for k in keys]
                out[1] += [s.tobytes() for s in signs]
                out[2] += factor.tolist()
            types = (pa.binary(), pa.binary(), pa.float64())
            columns = [c.take(pa.array(place, pa.int64())) for c in batch.columns]
            columns += [pa.array(o, t) for o, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "keys", "signs", "factor"])

    kind = own.schema["label"].dataType.simpleString()
    schema = f"cls bigint, raw binary, label {kind}, n bigint, keys binary, signs binary, factor double"
    codes = landed(classes.select("cls", "raw", "label", "n").mapInArrow(coded, schema), "vector-codes")[0]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).astype(np.int64)
            rows = np.repeat(np.arange(batch.num_rows), tables)
            table = np.tile(np.arange(tables, dtype=np.int32), batch.num_rows)
            columns = [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))]
            columns += [batch.column(3).take(pa.array(rows)), pa.array(table), pa.array(keys)]
            yield pa.RecordBatch.from_arrays(columns, names=["cls", "label", "dim", "table", "code"])

    dims = codes.select("cls", "label", "keys", (F.octet_length("raw") / width).cast("int").alias("dim"))
    buckets = dims.mapInArrow(spread, f"cls bigint, label {kind}, dim int, table int, code bigint")
    bucket = ["label", "dim", "table", "code"]
    shared = buckets.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1")
    met = buckets.join(shared, bucket).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    met = met.withColumn("block", F.pmod(F.xxhash64("cls", "table"), F.col("blocks")).cast("int"))
    dealt = met.select("cls", *bucket, "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")
    group = [*bucket, "low", "high"]
    full = dealt.join(codes.select("cls", "raw", "n", "keys", "signs", "factor"), "cls")
    # hashed into one number first, as a hot label alone must not decide where its buckets go
    placed = full.repartition(F.xxhash64(*group)).sortWithinPartitions("dim", *group)
    order = [*group, "block", "cls", "n", "raw", "keys", "signs", "factor"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            cut = _last_group(held, group)
            if cut:
                yield _compare(held.slice(0, cut), dtype, threshold)
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield _compare(held, dtype, threshold)

    found = landed(placed.select(*order).mapInArrow(compare, "u bigint, v bigint, n bigint"), "vector-links")[0]
    counts = found.where("n > 0").groupBy(F.col("u").alias("cls")).agg(F.sum("n").alias("linked"))
    components = connected_components(found.where("v is not null").select("u", "v"))
    members = classes.join(components, classes["cls"] == components["node"]).select("cls", "component", "least")
    smallest = members.groupBy("component").agg(F.min("least").alias("smallest"))
    reach = members.join(smallest, "component").select("cls", F.lit(True).alias("joined"), "smallest")
    per_class = classes.join(counts, "cls", "left").join(reach, "cls", "left").select(
        "label",
        "raw",
        (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.when(F.col("joined"), F.col("smallest")).otherwise(F.col("least")).alias("component_id"),
    )
    per_class = landed(per_class, "vector-components")[0]  # a plain join next: a hot vector can be split
    alone = own.where(~usable).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    rows = own.where(usable).join(per_class, ["label", "raw"]).select("id", "n_links", "component_id").unionByName(alone)
    return rows.select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _group_starts(table: pa.Table, group: list[str]) -> np.ndarray:
    """First rows of the groups of a sorted table."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in group:
        column = np.array(table[name].to_pylist(), object) if pa.types.is_string(table[name].type) else table[name].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _last_group(table: pa.Table, group: list[str]) -> int:
    return int(_group_starts(table, group)[-1]) if table.num_rows else 0


def _compare(table: pa.Table, dtype: str, threshold: float) -> pa.RecordBatch:
    """(u, v, NULL) links that join the components of the groups, and (u, NULL, n) numbers of linked vectors."""
    cls, weight = table["cls"].to_numpy(), table["n"].to_numpy()
    add = np.zeros(len(cls), np.int64)
    links: list[tuple[np.ndarray, np.ndarray]] = []
    dims = table["dim"].to_numpy()
    for dim in np.unique(dims):  # rows are sorted by dimension first
        low, high = np.searchsorted(dims, [dim, dim + 1])
        part = table.slice(low, high - low)
        starts = _group_starts(part, ["label", "table", "code", "low", "high"])
        sizes = np.diff(np.append(starts, part.num_rows))
        keys = np.frombuffer(b"".join(part["keys"].to_pylist()), np.uint32).reshape(part.num_rows, -1)
        signs = np.frombuffer(b"".join(part["signs"].to_pylist()), np.uint8).reshape(part.num_rows, -1)
        rows = Rows(unit(part["raw"].to_pylist(), dtype), keys, signs, part["factor"].to_numpy(), part["table"].to_numpy(), threshold)
        one = part["low"].to_numpy()[starts] == part["high"].to_numpy()[starts]
        small = one & (sizes <= SMALL)
        if small.any():
            links += [(i + low, j + low) for i, j in rows.small(starts[small], sizes[small])]
        block, lows = part["block"].to_numpy(), part["low"].to_numpy()
        for k in np.flatnonzero(~small):
            at = np.arange(starts[k], starts[k] + sizes[k])
            first = at if one[k] else at[block[at] == lows[at]]
            second = at if one[k] else at[block[at] != lows[at]]
            if len(first) and len(second):
                links += [(i + low, j + low) for i, j in rows.tile(first, first if one[k] else second)]
    i = np.concatenate([x for x, _ in links] or [np.zeros(0, np.int64)])
    j = np.concatenate([y for _, y in links] or [np.zeros(0, np.int64)])
    np.add.at(add, i, weight[j])
    np.add.at(add, j, weight[i])
    label = joined(len(cls), i, j)
    hung, some = np.flatnonzero(label != np.arange(len(cls))), np.flatnonzero(add)
    u = np.concatenate([cls[hung], cls[some]])
    v = pa.array(np.concatenate([cls[label[hung]], np.zeros(len(some), np.int64)]), mask=np.arange(len(u)) >= len(hung))
    n = np.concatenate([np.zeros(len(hung), np.int64), add[some]])
    return pa.RecordBatch.from_arrays([pa.array(u), v, pa.array(n)], names=["u", "v", "n"])
