"""A Merkle tree over a table as a manifest: leaves, levels, proofs, and leaves checked against the root."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunehouse.llm.common import landed
from tunehouse.operators.ranking import with_global_position

ARITY = 2
TOGETHER = 4  # levels that one plan hands paths down
DIGEST = 32  # bytes; 64 characters in hex


def field(value: Column) -> Column:
    """A value as its number of UTF-8 bytes, ':' and itself; '-' for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*inputs: Column) -> Column:
    """SHA-256 of the inputs, concatenated, as bytes."""
    return F.unhex(F.sha2(F.concat(*inputs), 8 * DIGEST))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def _run_length(idx: Column, n: Column, arity: int) -> Column:
    """Nodes in the run of a node; the last run of a level may be shorter."""
    return F.least(F.lit(arity), n - (idx - idx % arity))


def level_with_siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """(g, idx, n, hash, …) of one level, with ``left`` and ``right``: hashes of the run's other nodes, joined end to end.

    The table is joined with itself on the computed index of the sibling: idx XOR 1 for pairs, else the slots 1, 2, …
    further on in the run, round its end. Keys are unique, so no task gets more than its share.
    """
    out = nodes.withColumn("slot", F.col("idx") % arity)
    slim = nodes.select("g", "idx", F.col("hash").alias("other"))
    names = []
    for offset in range(1, arity):
        if arity == 2:
            shifted = F.col("idx").bitwiseXOR(F.lit(1))
        else:
            slot = F.col("idx") % arity
            shifted = F.col("idx") - slot + (slot + arity - offset) % arity  # whose sibling at ``offset`` this node is
        names.append(f"at_{offset}")
        moved = slim.select("g", shifted.alias("idx"), F.col("other").alias(names[-1]))
        out = out.join(moved, ["g", "idx"], "left")
    none = F.lit("").cast("binary")

    def joined(wraps: bool) -> Column:
        # a sibling past the run's end is one of the slots at its beginning, and so left of the node
        parts = [
            F.when((F.col("slot") + o >= arity) == F.lit(wraps), F.coalesce(F.col(n), none)).otherwise(none)
            for o, n in enumerate(names, 1)
        ]
        return F.concat(none, *parts)

    return out.select(*nodes.columns, "slot", joined(True).alias("left"), joined(False).alias("right"))


def build_levels(leaves: DataFrame, depth: int, arity: int = ARITY) -> list[DataFrame]:
    """The levels of all trees, from the leaves (g, idx, n, hash and any more) upwards, each with its siblings.

    ``n`` is the number of nodes of the tree at that level. The rows in slot zero emit the parents; a tree with one node
    has reached its root and stays out of the next level. Each level is written, so that a lost executor costs one level.
    """
    levels = [landed(level_with_siblings(leaves, arity), "level")[0]]
    for _ in range(depth):
        below = levels[-1].where("slot = 0 and n > 1")
        parents = below.select(
            "g",
            F.expr(f"idx div {arity}").alias("idx"),
            F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            digest(hexed(F.col("hash")), hexed(F.col("right"))).alias("hash"),
        )
        levels.append(landed(level_with_siblings(parents, arity), "level")[0])
    return levels


def depth_of(n: int, arity: int = ARITY) -> int:
    """Levels above the leaves of a tree with ``n`` leaves."""
    depth = 0
    while n > 1:
        n, depth = -(-n // arity), depth + 1
    return depth


def roots(levels: list[DataFrame]) -> DataFrame:
    """(g, hash) of every tree."""
    found = [level.where("n = 1").select("g", "hash") for level in levels]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def with_paths(levels: list[DataFrame], arity: int = ARITY) -> DataFrame:
    """The leaves with ``path``: the siblings on the way to the root, level by level, left to right, end to end.

    From the top down, each node adds its siblings to its parent's path, so the work is about twice that of the leaves alone.
    Every few levels the paths are written, so that no plan joins more than ``TOGETHER`` levels.
    """
    path = None
    for number in range(len(levels) - 1, -1, -1):
        level = levels[number]
        own = F.concat("left", "right")
        if path is None:
            here = level.withColumn("path", own)
        else:
            above = path.select("g", F.col("idx").alias("up"), F.col("path").alias("rest"))
            joined = level.withColumn("up", F.expr(f"idx div {arity}")).join(above, ["g", "up"], "left")
            here = joined.withColumn("path", F.concat(own, F.coalesce("rest", F.lit("").cast("binary")))).drop("up", "rest")
        path = here if number == 0 else here.select("g", "idx", "path")
        if number and number % TOGETHER == 0:
            path = landed(path, "paths")[0]
    return path.drop("slot", "left", "right")


def folded(leaf: Column, idx: Column, n: Column, path: Column, depth: int, arity: int = ARITY) -> Column:
    """The root (hex) that follows from a leaf (hex), its index among ``n`` and its path (hex)."""

    def step(state: Column, _: Column) -> Column:
        i, m, at = state["i"], state["m"], state["at"]
        slot = i % arity
        others = _run_length(i, m, arity) - 1
        width = 2 * DIGEST
        inputs = F.concat(
            F.substring(path, at, (slot * width).cast("int")),
            state["h"],
            F.substring(path, at + (slot * width).cast("int"), ((others - slot) * width).cast("int")),
        )
        up = F.struct(
            F.sha2(inputs, 8 * DIGEST).alias("h"),
            F.call_function("div", i, F.lit(arity)).alias("i"),
            F.call_function("div", m + (arity - 1), F.lit(arity)).alias("m"),
            (at + (others * width).cast("int")).cast("int").alias("at"),
        )
        return F.when(m > 1, up).otherwise(state)

    start = F.struct(leaf.alias("h"), idx.cast("bigint").alias("i"), n.cast("bigint").alias("m"), F.lit(1).alias("at"))
    if not depth:
        return leaf
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), start, step)["h"]


def numbered(leaves: DataFrame) -> DataFrame:
    """(part, id, …) -> (…, g, idx, n): the part's number (NULL first), the leaf's place in it by id, the part's size.

    Rows are numbered by a range-partitioned sort; equal rows are told apart by a running number, so that a hot id is
    spread too. No part has to fit in a task.
    """
    order = [F.asc_nulls_first("part"), F.asc_nulls_first("id"), F.asc("hash"), F.asc("tie")]
    placed = with_global_position(leaves.withColumn("tie", F.monotonically_increasing_id()), *order).drop("tie")
    sizes = placed.groupBy("part").agg(F.min("position").alias("first"), F.count("*").alias("n"))
    parts = with_global_position(landed(sizes, "parts")[0], F.asc("first"), name="g")
    parts = landed(parts.withColumnRenamed("part", "its"), "parts")[0]
    return (
        placed.join(parts, F.col("part").eqNullSafe(F.col("its")))
        .withColumn("idx", F.col("position") - F.col("first"))
        .drop("its", "first", "position")
    )


class Manifest(NamedTuple):
    """``tree``: the leaves with g, idx, n, path, subroot, n_parts, upper_path and root (digests and paths as bytes)."""

    tree: DataFrame
    depth: int  # levels above the leaves of the largest part
    upper_depth: int  # levels above the subroots


def manifest(leaves: DataFrame, arity: int = ARITY) -> Manifest:
    """(part, id, hash, …) -> a tree per part over its leaves by id (equal ids by hash), and one over the subroots.

    Subroots are ordered by part, NULL first. No leaves give no rows.
    """
    rows = landed(numbered(leaves), "leaves")[0]
    largest, n_parts = rows.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max("g") + 1, F.lit(0))).first()
    levels = build_levels(rows, depth_of(largest, arity), arity)
    upper = roots(levels).select(
        F.lit(0).cast("bigint").alias("g"), F.col("g").alias("idx"), F.lit(n_parts).cast("bigint").alias("n"), "hash"
    )
    upper_levels = build_levels(upper, depth_of(n_parts, arity), arity)
    root = roots(upper_levels).select(F.col("g").alias("whole"), F.col("hash").alias("root"))
    tops = with_paths(upper_levels, arity).select(
        F.col("g").alias("whole"),
        F.col("idx").alias("g"),
        F.col("hash").alias("subroot"),
        F.col("path").alias("upper_path"),
        F.col("n").alias("n_parts"),
    )
    tops = landed(tops.join(root, "whole").drop("whole"), "tops")[0]
    return Manifest(with_paths(levels, arity).join(tops, "g"), depth_of(largest, arity), depth_of(n_parts, arity))


def verified(made: Manifest, claimed: str = "claimed", arity: int = ARITY) -> DataFrame:
    """The tree with proof_sha256, folded_root (from the ``claimed`` leaf, or the leaf itself where that is NULL) and verified."""
    tree = made.tree
    leaf = hexed(F.coalesce(F.col(claimed), F.col("hash")))
    subroot = folded(leaf, F.col("idx"), F.col("n"), hexed(F.col("path")), made.depth, arity)
    tree = tree.withColumn("folded_subroot", subroot)
    root = folded(F.col("folded_subroot"), F.col("g"), F.col("n_parts"), hexed(F.col("upper_path")), made.upper_depth, arity)
    proof = F.sha2(hexed(F.concat("path", "upper_path")), 8 * DIGEST)
    tree = tree.withColumn("proof_sha256", proof).withColumn("folded_root", root)
    return tree.withColumn("verified", F.col("folded_root") == hexed(F.col("root")))


def document_leaves(docs: DataFrame) -> DataFrame:
    """(part, id, hash, claimed) of documents; ``claimed`` is the leaf with n_chars one higher, where 7 divides the id's crc32.

    NULLs hash as '-', so a NULL n_chars stays as it is; a NULL id is never tampered with.
    """
    others = [field(F.col(c)) for c in ("doc_id", "source", "lang")]
    n_chars = F.col("n_chars").cast("decimal(20,0)")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return docs.select(
        F.col("lang").cast("string").alias("part"),
        F.col("doc_id").alias("id"),
        digest(*others, field(n_chars), field(F.col("text"))).alias("hash"),
        F.when(chosen, digest(*others, field(n_chars + 1), field(F.col("text")))).alias("claimed"),
    )


def document_manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per document."""
    rows = verified(manifest(document_leaves(docs)))
    return rows.select(
        F.col("id").alias("doc_id"),
        hexed(F.col("hash")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"),
        "proof_sha256",
        "folded_root",
        "verified",
    )


#: DuckDB; CRC-32 by its polynomial, bit by bit.
MANIFEST_SQL = r"""
with recursive d as (
  select doc_id, lang,
         list_reduce(list_transform([cast(doc_id as varchar), source, lang],
           lambda v: coalesce(strlen(v) || ':' || v, '-')), lambda a, b: a || b) as head,
         n_chars, coalesce(strlen(text) || ':' || text, '-') as body from documents),
c as (select *, xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint,
              list_transform(string_split(cast(doc_id as varchar), ''), lambda x: ascii(x)::bigint)),
              lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                lambda r, i: xor(r >> 1, 3988292384 * (r & 1))))) as crc from d),
h as (select doc_id, lang, sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || body) as leaf,
             case when crc % 7 = 0
                  then sha256(head || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || body) end as claimed
      from c),
p as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx,
             count(*) over (partition by lang) as n,
             dense_rank() over (order by encode(lang) nulls first) - 1 as g from h),
t(l, g, i, n, x) as (
  select 0, g, idx, n, leaf from p
  union all
  select l + 1, g, i // 2, any_value((n + 1) // 2), sha256(string_agg(x, '' order by i)) from t where n > 1 group by l, g, i // 2),
s as (select g, x as subroot from t where n = 1),
u(l, i, n, x) as (
  select 0, g, (select count(*) from s), subroot from s
  union all
  select l + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(x, '' order by i)) from u where n > 1 group by l, i // 2),
k as (select p.*, s.subroot, (select x from u where n = 1) as root from p join s using (g)),
w as (select k.g, k.idx, 0 as tree, t.l, t.x from k join t on t.g = k.g and t.i = xor(k.idx >> t.l::int, 1) and t.n > 1
      union all
      select k.g, k.idx, 1, u.l, u.x from k join u on u.i = xor(k.g >> u.l::int, 1) and u.n > 1),
q as (select g, idx, sha256(string_agg(x, '' order by tree, l)) as proof from w group by g, idx),
a as (select g, idx, 0 as l, coalesce(claimed, leaf) as x, n from k
      union all
      select a.g, a.idx, a.l + 1,
             case when t.x is null then sha256(a.x)
                  when (a.idx >> a.l) % 2 = 0 then sha256(a.x || t.x) else sha256(t.x || a.x) end, (a.n + 1) // 2
      from a left join t on t.g = a.g and t.l = a.l and t.i = xor(a.idx >> a.l, 1) where a.n > 1),
b as (select g, idx, 0 as l, x, (select count(*) from s) as n from a where n = 1
      union all
      select b.g, b.idx, b.l + 1,
             case when u.x is null then sha256(b.x)
                  when (b.g >> b.l) % 2 = 0 then sha256(b.x || u.x) else sha256(u.x || b.x) end, (b.n + 1) // 2
      from b left join u on u.l = b.l and u.i = xor(b.g >> b.l, 1) where b.n > 1)
select k.doc_id, k.leaf, k.subroot, k.root, coalesce(q.proof, sha256('')) as proof_sha256, b.x as folded_root,
       b.x = k.root as verified
from k join b on b.g = k.g and b.idx = k.idx and b.n = 1 left join q on q.g = k.g and q.idx = k.idx
"""
