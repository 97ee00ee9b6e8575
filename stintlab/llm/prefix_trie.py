"""Counts over the trie of conversation prefixes, through node tables under minimal perfect hashes.

A prefix is named by 128 bits: the xor of a hash of (depth, role, text) of its turns. That needs no
order within a task, so even one giant conversation is named in blocks, and the name of the parent is
the own one without the last turn.

Prefixes with many rows below them (the upper part) are told by one aggregate. What hangs below is
cut into whole subtrees of bounded size, which are dealt to shards. A shard gives every distinct name
a slot by a minimal perfect hash that keeps the names and is checked against them, scatters counts
into flat arrays, and accumulates them through an array of parent slots, the deepest first. The upper
part takes over the sums of the subtrees and adds them up along its paths by doubling.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlab.config import SCALE, Scale
from stintlab.llm.common import ship_package, stage
from stintlab.operators.joins import sized
from stintlab.operators.ordered import blocked_running, per_group, ranked, spread_rank

# 64-bit values by which the second half of a name differs from the first.
_SECOND = 0x5851F42D4C957F2D
_NO_ENDS = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class TrieRules:
    """Sizes; results do not depend on them."""

    # Rows of a shard on average, and at most of one subtree that a shard gets.
    subtree_rows: int = 4096
    # Bytes of ids in one piece of the list that a node's hash is made of.
    piece_bytes: int = 1 << 16


RULES = TrieRules()


def slim_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, 120 bits of the SHA-256 of role and text, and bytes of the text.

    A null role or text is an empty one. Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    content = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return (
        conversations.filter(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                content.alias("content"), F.octet_length(text).cast("long").alias("n_bytes"))
        .select("conv_id", "turn", F.conv(F.substring("content", 1, 15), 16, 10).cast("long").alias("d1"),
                F.conv(F.substring("content", 16, 15), 16, 10).cast("long").alias("d2"), "n_bytes")
    )


def _head_size(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % 9


def share_heads(turns: DataFrame, scale: Scale = SCALE) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on a shared beginning: (their turns, their ids).

    Let h be the crc32 of the decimal conv_id, modulo 9. Conversation c gets the first h turns of
    conversation c - c % 5 (all it has, if fewer) and then its own from the (h+1)-th on. % keeps the
    sign of c. Turns with one number (null comes first) follow each other by their content's hash.
    """
    placed = stage(ranked(turns, ["conv_id"], ["turn", "d1", "d2"], "place", scale))
    ids = placed.filter("place = 1").select("conv_id")
    own = placed.filter(F.col("place") > _head_size(F.col("conv_id")))
    base = F.col("base")
    heads = (
        placed.filter((F.col("place") <= 8) & (F.col("conv_id") % 5 == 0)).withColumnRenamed("conv_id", "base")
        .withColumn("conv_id", F.explode(F.sequence(base - 4, base + 4)))
        .filter((F.col("conv_id") - F.col("conv_id") % 5 == base) & (F.col("place") <= _head_size(F.col("conv_id"))))
        .join(ids, "conv_id", "left_semi")
    )
    columns = ["d1", "d2", "n_bytes"]
    rebuilt = heads.select("conv_id", F.col("place").alias("turn"), *columns).unionByName(
        own.select("conv_id", (F.col("place") + 8).alias("turn"), *columns)
    )
    return rebuilt, ids


def _turn_name(half: int) -> Column:
    if half == 1:
        return F.xxhash64("depth", "d1", "d2")
    return F.xxhash64(F.lit(_SECOND), "d2", "depth", "d1")


def _paths_plain(turns: DataFrame) -> DataFrame:
    order = Window.partitionBy("conv_id").orderBy("turn", "d1", "d2")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    placed = turns.withColumn("depth", F.row_number().over(order).cast("long"))
    return placed.withColumns(
        {
            "k1": F.bit_xor(_turn_name(1)).over(so_far), "k2": F.bit_xor(_turn_name(2)).over(so_far),
            "size": F.count("*").over(Window.partitionBy("conv_id")),
        }
    )


def _paths_blocked(turns: DataFrame, scale: Scale) -> DataFrame:
    placed = spread_rank(turns, ["conv_id"], ["turn", "d1", "d2"], "depth", scale)
    named = blocked_running(
        placed, ["conv_id"], "depth", {"k1": ("xor", _turn_name(1)), "k2": ("xor", _turn_name(2))}, scale
    )
    sizes = placed.groupBy("conv_id").agg(F.count("*").alias("size"))
    return named.join(sizes, "conv_id").select(*turns.columns, "depth", "k1", "k2", "size")


def prefix_paths(turns: DataFrame, scale: Scale = SCALE) -> DataFrame:
    """Every turn as the end of a prefix: its depth, name (k1, k2) and the parent's name (p1, p2)."""
    named = per_group(turns, ["conv_id"], _paths_plain, lambda hot: _paths_blocked(hot, scale), scale)
    return named.select(
        "conv_id", "depth", "size", "d1", "d2", "n_bytes", "k1", "k2",
        F.col("k1").bitwiseXOR(_turn_name(1)).alias("p1"), F.col("k2").bitwiseXOR(_turn_name(2)).alias("p2"),
    )


class SlotTable:
    """A minimal perfect hash over distinct 128-bit names, kept with the names to check against.

    Names are thrown at a row of places; those that land alone get them, the others go on to the next,
    smaller row. The slot is the number of taken places before. Every name is checked to have its own.
    """

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.rows: list[tuple[int, np.ndarray, np.ndarray]] = []
        left, before, shift = np.arange(len(k1)), 0, 0
        while len(left):
            width = 1 << max(1, math.ceil(math.log2(2 * len(left))))
            at = self._place(k1[left], k2[left], shift, width)
            taken = np.bincount(at, minlength=width) == 1
            self.rows.append((shift, taken, before + np.cumsum(taken) - 1))
            before += int(taken.sum())
            left, shift = left[~taken[at]], shift + 1
            if shift > 200:
                raise ValueError("two equal names cannot have two slots")
        self.names = np.zeros((2, len(k1)), np.int64)
        own = self._slots(k1, k2)
        if len(np.unique(own)) != len(k1) or (own < 0).any():
            raise AssertionError("names share a slot")
        self.names[0, own], self.names[1, own] = k1, k2

    @staticmethod
    def _place(k1: np.ndarray, k2: np.ndarray, shift: int, width: int) -> np.ndarray:
        one, two = (np.uint64((2 * shift + 1) * c % 2**64) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
        mixed = k1.view(np.uint64) * one + (k2.view(np.uint64) ^ one) * (two ^ np.uint64(shift << 33))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * two
        return (mixed >> np.uint64(64 - int(math.log2(width)))).astype(np.int64)

    def _slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        out = np.full(len(k1), -1)
        left = np.arange(len(k1))
        for shift, taken, number in self.rows:
            at = self._place(k1[left], k2[left], shift, len(taken))
            hit = taken[at]
            out[left[hit]] = number[at[hit]]
            left = left[~hit]
        return out

    def find(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Slots of names; -1 for those that are not in the table."""
        out = self._slots(k1, k2)
        known = out >= 0
        own = out[known]
        out[known] = np.where((self.names[0, own] == k1[known]) & (self.names[1, own] == k2[known]), own, -1)
        return out


def _hash_of_ids(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


_NODES = (
    "k1 long, k2 long, p1 long, p2 long, conv_id long, depth long, parent_conv_id long, n_convs long,"
    " n_children long, n_leaves long, saved_tokens long, ends_sha256 string, top boolean"
)


def _shard_nodes(rows: pa.Table) -> pa.Table:
    """Nodes of the whole subtrees that the rows of a shard make up."""
    c = {n: rows.column(n).to_numpy() for n in rows.column_names}
    names = np.unique(np.stack([c["k1"], c["k2"]], axis=1), axis=0)
    table = SlotTable(np.ascontiguousarray(names[:, 0]), np.ascontiguousarray(names[:, 1]))
    slot, n = table.find(c["k1"], c["k2"]), len(names)
    node = {}
    for name in ("depth", "p1", "p2", "d1", "d2", "n_bytes"):
        node[name] = np.zeros(n, np.int64)
        node[name][slot] = c[name]
        if (node[name][slot] != c[name]).any():
            raise ValueError("two different prefixes have one name")
    n_convs = np.bincount(slot, minlength=n)
    conv = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(conv, slot, c["conv_id"])
    parent = table.find(node["p1"], node["p2"])
    n_children = np.bincount(parent[parent >= 0], minlength=n)
    leaves, saved = (n_children == 0).astype(np.int64), (n_convs - 1) * node["n_bytes"]
    deepest_first = np.argsort(-node["depth"], kind="stable")
    levels = np.split(deepest_first, np.flatnonzero(np.diff(node["depth"][deepest_first])) + 1)
    for level in levels:
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    ends = np.full(n, _NO_ENDS, object)
    last = np.flatnonzero(c["depth"] == c["size"])
    last = last[np.lexsort((c["conv_id"][last], slot[last]))]
    for part in np.split(last, np.flatnonzero(np.diff(slot[last])) + 1):
        if len(part):
            ends[slot[part[0]]] = _hash_of_ids(c["conv_id"][part])
    parents = pa.array(conv[np.maximum(parent, 0)], mask=parent < 0)
    return pa.table(
        {
            "k1": table.names[0], "k2": table.names[1], "p1": node["p1"], "p2": node["p2"], "conv_id": conv,
            "depth": node["depth"], "parent_conv_id": parents, "n_convs": n_convs.astype(np.int64),
            "n_children": n_children.astype(np.int64), "n_leaves": leaves, "saved_tokens": saved,
            "ends_sha256": pa.array(ends.tolist(), pa.string()), "top": parent < 0,
        }
    )


def upper_nodes(paths: DataFrame, rules: TrieRules = RULES) -> DataFrame:
    """Prefixes with more rows at and below them than a shard should get, the root aside."""
    below = F.sum(F.col("size") - F.col("depth") + 1)
    fixed = ["depth", "p1", "p2", "d1", "d2", "n_bytes"]
    found = paths.groupBy("k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), below.alias("below"),
        F.min(F.struct(*fixed)).alias("low"), F.max(F.struct(*fixed)).alias("high"),
    ).filter(F.col("below") > rules.subtree_rows)
    low = F.col("low")
    same = F.when(low == F.col("high"), low["depth"]).otherwise(
        F.raise_error(F.lit("two different prefixes have one name")).cast("long")
    )
    return found.select(
        "k1", "k2", low["p1"].alias("p1"), low["p2"].alias("p2"), "conv_id", same.alias("depth"), "n_convs",
        low["n_bytes"].alias("n_bytes"),
    )


def lower_nodes(paths: DataFrame, upper: DataFrame, rules: TrieRules = RULES, scale: Scale = SCALE) -> DataFrame:
    """Nodes below the upper part, shard by shard.

    A conversation has at most subtree_rows rows here, all in the subtree its first one is the top of.
    """
    shards = max(1, math.ceil(paths.count() / rules.subtree_rows))
    lower = paths.join(sized(upper.select("k1", "k2"), scale), ["k1", "k2"], "left_anti")
    path = Window.partitionBy("conv_id").orderBy("depth")
    top = F.first(F.xxhash64("k1", "k2")).over(path)
    dealt = lower.withColumn("shard", F.pmod(top, F.lit(shards)))
    columns = ["conv_id", "depth", "size", "k1", "k2", "p1", "p2", "d1", "d2", "n_bytes"]
    return dealt.select("shard", *columns).groupBy("shard").applyInArrow(_shard_nodes, _NODES)


def hash_of_ends(ends: DataFrame, rules: TrieRules = RULES) -> DataFrame:
    """SHA-256 of the ids per (k1, k2), joined by commas in numerical order, for groups of any size.

    Ids are laid out by a range shuffle and joined into pieces of text in parallel; a group's hash is
    then fed from few pieces, one at a time.
    """
    ends = stage(ends)
    parts = max(1, math.ceil(ends.count() / rules.subtree_rows))
    laid = ends.repartitionByRange(parts, "k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")

    def pieces(batches):
        for batch in batches:
            k1, k2, ids = (batch.column(i).to_numpy() for i in range(3))
            borders = np.flatnonzero((np.diff(k1) != 0) | (np.diff(k2) != 0)) + 1
            most = max(1, rules.piece_bytes // 20)
            starts = [s for a, b in zip([0, *borders], [*borders, len(ids)]) for s in range(a, b, most)]
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, [*starts[1:], len(ids)])]
            at = np.array(starts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[at]), pa.array(k2[at]), pa.array(ids[at]), pa.array(texts, pa.string())],
                names=["k1", "k2", "first_id", "ids"],
            )

    def hashes(batches):
        key, running = None, None

        def done():
            return pa.RecordBatch.from_pylist([{"k1": key[0], "k2": key[1], "ends_sha256": running.hexdigest()}])

        for batch in batches:
            for k1, k2, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if (k1, k2) == key:
                    running.update(b"," + ids.encode())
                    continue
                if key:
                    yield done()
                key, running = (k1, k2), hashlib.sha256(ids.encode())
        if key:
            yield done()

    joined = laid.select("k1", "k2", "conv_id").mapInArrow(pieces, "k1 long, k2 long, first_id long, ids string")
    in_order = joined.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first_id")
    return in_order.mapInArrow(hashes, "k1 long, k2 long, ends_sha256 string")


def _subtree_sums(nodes: DataFrame, deepest: int) -> DataFrame:
    """Sums of leaves and saved over each node's subtree, doubling the distance covered in each round.

    Rows that reached the root have no further way to go, so its name is never a key of the join.
    """
    at_root = (F.col("a1") == 0) & (F.col("a2") == 0)
    reached = nodes.withColumns({"a1": F.col("p1"), "a2": F.col("p2")})
    for _ in range(math.ceil(math.log2(deepest + 1))):
        given = reached.filter(F.col("a1").isNotNull()).groupBy(F.col("a1").alias("k1"), F.col("a2").alias("k2")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
        )
        ways = reached.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"),
                              F.col("a1").alias("b1"), F.col("a2").alias("b2")).filter(~at_root)
        onward = reached.withColumns({"a1": F.when(~at_root, F.col("a1")), "a2": F.when(~at_root, F.col("a2"))})
        onward = onward.join(ways, ["a1", "a2"], "left").drop("a1", "a2").withColumnsRenamed({"b1": "a1", "b2": "a2"})
        reached = stage(
            onward.join(given, ["k1", "k2"], "left").withColumns(
                {
                    "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
                    "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0)),
                }
            ).drop("more_leaves", "more_saved")
        )
    return reached.drop("a1", "a2")


_OUT = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def prefix_trie(
    turns: DataFrame, members: DataFrame, rules: TrieRules = RULES, scale: Scale = SCALE
) -> DataFrame:
    """One row per distinct prefix of the conversations, the empty one included.

    turns has conv_id, turn, d1, d2, n_bytes (slim_turns); members has the conv_id of every conversation
    once, so one without turns counts as a member of the root. Gives the smallest member, the depth, the
    parent's smallest member (null for the root), members, children, childless nodes below (or the node
    itself), saved_tokens (bytes of the last text times members but one, summed over the subtree), and the
    SHA-256 of the ids of the conversations that end there. Turns with one number follow each other by
    their content's hash. Without members the result is empty.
    """
    ship_package(turns.sparkSession)
    paths = stage(prefix_paths(turns, scale))
    upper = stage(upper_nodes(paths, rules))
    lower = stage(lower_nodes(paths, upper, rules, scale))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(
        zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), "conv_id", zero.alias("depth"),
        "n_convs", zero.alias("n_bytes"),
    )
    top = root.unionByName(upper)
    children = (
        lower.filter("top").select("p1", "p2", "n_leaves", "saved_tokens")
        .unionByName(upper.select("p1", "p2", zero.alias("n_leaves"), zero.alias("saved_tokens")))
        .groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        .agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
             F.sum("saved_tokens").alias("saved_tokens"))
    )
    n_children = F.coalesce("n_children", zero)
    own = stage(
        top.join(children, ["k1", "k2"], "left").select(
            *top.columns, n_children.alias("n_children"),
            F.when(n_children == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
            (F.coalesce("saved_tokens", zero) + (F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
        )
    )
    deepest = own.agg(F.max("depth")).first()[0] or 0
    summed = _subtree_sums(own, deepest)
    last = paths.filter("depth = size").select("k1", "k2", "conv_id")
    of_upper = last.join(sized(upper.select("k1", "k2"), scale), ["k1", "k2"], "left_semi")
    turnless = members.join(paths.filter("depth = 1").select("conv_id"), "conv_id", "left_anti")
    hashes = hash_of_ends(
        of_upper.unionByName(turnless.select(zero.alias("k1"), zero.alias("k2"), "conv_id")), rules
    )
    known = sized(own.filter("depth > 0").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                                                 F.col("conv_id").alias("known_parent")), scale)
    of_root = own.filter("depth = 0").agg(F.min("conv_id")).scalar()

    def with_parent(nodes: DataFrame) -> DataFrame:
        """The parent's smallest member; children of the root are told by their depth and meet no join."""
        inner = F.col("depth") > 1
        keyed = nodes.withColumns({"p1": F.when(inner, F.col("p1")), "p2": F.when(inner, F.col("p2"))})
        parent = F.when(F.col("depth") == 1, of_root).otherwise(F.col("known_parent"))
        return keyed.join(known, ["p1", "p2"], "left").withColumn("parent_conv_id", parent).select(*_OUT)

    above = summed.join(hashes, ["k1", "k2"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
    inside = lower.filter("NOT top").select(*_OUT)
    return with_parent(above).unionByName(with_parent(lower.filter("top").drop("parent_conv_id"))).unionByName(inside)


# crc32 bit by bit: each byte enters with seven empty steps after it.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
  lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"""

SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
digested AS (
  SELECT conv_id, turn, strlen(text) AS n_bytes, sha256(strlen(role)::VARCHAR || ':' || role || text) AS d FROM turns),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS place FROM digested),
members AS (SELECT DISTINCT conv_id, {_CRC} % 9 AS h FROM placed),
rebuilt AS (
  SELECT m.conv_id, p.place AS seq, p.d, p.n_bytes FROM members m
  JOIN placed p ON p.conv_id = m.conv_id - m.conv_id % 5 AND p.place <= m.h
  UNION ALL
  SELECT m.conv_id, p.place + 8, p.d, p.n_bytes FROM members m JOIN placed p ON p.conv_id = m.conv_id AND p.place > m.h),
deep AS (
  SELECT conv_id, row_number() OVER w AS depth, count(*) OVER (PARTITION BY conv_id) AS size, n_bytes,
         string_agg(d, ',') OVER (w ROWS UNBOUNDED PRECEDING) AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY seq)),
sizes AS (SELECT m.conv_id, coalesce(max(d.size), 0) AS size FROM members m LEFT JOIN deep d USING (conv_id) GROUP BY m.conv_id),
paths AS (
  SELECT conv_id, depth, size, n_bytes, sha256(path) AS k FROM deep
  UNION ALL SELECT conv_id, 0, size, 0, '' FROM sizes),
nodes AS (
  SELECT k, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs, min(n_bytes) AS n_bytes,
         sha256(coalesce(string_agg(CASE WHEN depth = size THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM paths GROUP BY k),
up AS (
  SELECT n.k, p.k AS parent_k FROM nodes n LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT parent_k AS k, count(*) AS n FROM up WHERE parent_k IS NOT NULL GROUP BY parent_k),
totals AS (
  SELECT a.k, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.n_bytes) AS saved_tokens
  FROM nodes n LEFT JOIN children c ON c.k = n.k JOIN paths a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.k)
SELECT n.conv_id, n.depth, pn.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN up u ON u.k = n.k LEFT JOIN nodes pn ON pn.k = u.parent_k LEFT JOIN children c ON c.k = n.k
JOIN totals t ON t.k = n.k
"""
