"""Links between texts whose sets of word n-grams have a Jaccard similarity of 0.75 or more.

Universe-partition pigeonhole. Sets fall into bands of size. In a band, shingles are hashed into m
segments; two sets that link differ in at most `d` shingles, so at least m - d of their segment
subsets are equal. Of a set's m subset signatures all but the d + 1 cheapest may therefore be left
out, as long as all sets order signatures alike; cost is how often a signature was seen in a sample,
which changes the work but never the result. In the lowest band a set is one segment, indexed with
its one-deletion neighbourhood. A set close to the upper end of its band is indexed in the next
band too, where larger partners are.

Documents with the same set are one node from the start. Nodes that share a signature are first
compared with the smallest of them only, and members of large groups with a few more hubs; what these comparisons link is one component. Just those members of a group that are then still in
different components are compared pair by pair, in blocks. Before whole texts meet, each pair has to pass an exact bound: a sketch holds the parity of
the number of shingles in each of some cells, and two sets differ in at least as many shingles as
their sketches do in bits. What passes is compared by whole sets.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import column_slices, give_back, hash_share, row_key, ship_package, stage
from stintlab.llm.components import connected_components

_B = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class JoinRules:
    """Similarity is links_at / 100. sample_docs: documents the costs are estimated on, by hash."""

    words: int = 5
    links_at: int = 75
    sample_docs: int = 8000
    # A signature seen so often in the sample has a cost of its own; others cost the same.
    costly_from: int = 3
    # Signatures handled in a task, members of a block, and members of open groups in a task.
    bucket_entries: int = 1_000_000
    block: int = 2000
    cell_rows: int = 20_000
    # Members of open groups from this size on are compared with so many more hubs before pairs are formed;
    # smaller groups gain nothing by it. Results depend on neither.
    hub_from: int = 50
    hubs: int = 8
    # Cells of a sketch for each shingle, up to a power of two, and most cells.
    sketch_cells: int = 2
    most_cells: int = 1 << 16
    # Up to this size a set is one segment with its one-deletion neighbourhood.
    whole_below: int = 6
    first_band: int = 16


# --- sets -----------------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the n-grams of each text's words, A-Z lowered.

    A text of fewer words has its whole sequence as one; without words or text the set is empty.
    """
    from xxhash import xxh64_intdigest

    lists = [t.encode().lower().split() if t else [] for t in texts]
    flat = [w for ws in lists for w in ws]
    coded = pa.array(flat, pa.binary()).dictionary_encode()
    distinct = np.array([xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    hashes = distinct[np.asarray(coded.indices)] if flat else distinct
    with np.errstate(over="ignore"):
        n = max(0, len(hashes) - words + 1)
        rolling = np.zeros(n, dtype=np.uint64)
        for i in range(words):
            rolling = rolling * _B + hashes[i : i + n]
        rolling = _mix(rolling)
        out, at = [], 0
        for ws in lists:
            if len(ws) >= words:
                out.append(np.unique(rolling[at : at + len(ws) - words + 1]))
            elif ws:
                whole = np.uint64(len(ws))
                for h in hashes[at : at + len(ws)]:
                    whole = whole * _B + h
                out.append(_mix(np.array([whole])))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            at += len(ws)
    return out


def node_of(shingles: np.ndarray) -> int:
    """64 bits for a set; documents with the same set are one node."""
    from xxhash import xxh3_64_intdigest

    return int(np.uint64(xxh3_64_intdigest(shingles.tobytes(), seed=len(shingles))).view(np.int64))


def sketch_of(shingles: np.ndarray, rules: JoinRules) -> bytes:
    """Parity of the shingles in each cell, one bit a cell."""
    cells = max(64, min(rules.most_cells, 1 << (rules.sketch_cells * max(1, len(shingles)) - 1).bit_length()))
    odd = np.bincount((shingles % np.uint64(cells)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _folded(sketch: int, cells: int, to: int) -> int:
    while cells > to:
        cells //= 2
        sketch = (sketch >> cells) ^ (sketch & ((1 << cells) - 1))
    return sketch


def least_different(a: bytes, b: bytes) -> int:
    """Two sets differ in at least so many shingles as their sketches in bits, folded to the same cells."""
    cells = 8 * min(len(a), len(b))
    x, y = (_folded(int.from_bytes(s, "little"), 8 * len(s), cells) for s in (a, b))
    return (x ^ y).bit_count()


def _may_differ(na, nb, rules: JoinRules):
    """Most shingles in which linked sets of these sizes differ."""
    return (na + nb) * (100 - rules.links_at) // (100 + rules.links_at)


# --- signatures -----------------------------------------------------------------------------


def band_of(size: int, rules: JoinRules) -> int:
    if size < rules.whole_below:
        return 0
    return 1 if size < rules.first_band else 2 + int(math.log2(size / rules.first_band))


def band_end(band: int, rules: JoinRules) -> int:
    return rules.whole_below if band == 0 else rules.first_band << (band - 1)


def most_different(size: int, rules: JoinRules) -> int:
    """Largest number of shingles in which a set and a partner it links with differ."""
    return _may_differ(size, size * 100 // rules.links_at, rules)


def _band_signatures(shingles: np.ndarray, band: int, cost, rules: JoinRules) -> np.ndarray:
    salt = np.uint64(band + 1) * _B
    if band == 0:
        whole = np.add.reduce(_mix(shingles))
        return _mix(np.concatenate([[whole], whole - _mix(shingles)]) + salt)
    m = rules.first_band if band == 1 else band_end(band, rules) // 2
    segment = (shingles >> np.uint64(20)) % np.uint64(m)
    sums = np.zeros(m, dtype=np.uint64)
    np.add.at(sums, segment.astype(np.int64), _mix(shingles))
    signatures = _mix(sums + _mix(np.arange(m, dtype=np.uint64) + salt))
    spent = cost(signatures)
    # An empty segment is like many others'.
    filled = np.zeros(m, dtype=bool)
    filled[segment.astype(np.int64)] = True
    spent[~filled] = np.iinfo(np.int64).max
    order = np.lexsort((signatures, spent))
    return signatures[order[: most_different(len(shingles), rules) + 1]]


def signatures_of(shingles: np.ndarray, cost, rules: JoinRules) -> np.ndarray:
    """Those under which a set is indexed: its own band's and, if a partner may be there, the next one's."""
    size = len(shingles)
    if not size:
        return shingles
    with np.errstate(over="ignore"):
        band = band_of(size, rules)
        out = [_band_signatures(shingles, band, cost, rules)]
        if size * 100 >= rules.links_at * band_end(band, rules):
            out.append(_band_signatures(shingles, band + 1, cost, rules))
    return np.concatenate(out)


class Costs:
    """How often signatures were seen in the sample; 0 for those below costly_from."""

    def __init__(self, signatures: np.ndarray, times: np.ndarray):
        order = np.argsort(signatures)
        self.signatures, self.times = signatures[order], times[order]

    def __call__(self, signatures: np.ndarray) -> np.ndarray:
        if not len(self.signatures):
            return np.zeros(len(signatures), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.signatures, signatures), len(self.signatures) - 1)
        return np.where(self.signatures[at] == signatures, self.times[at], 0)


def _every_signature(shingles: np.ndarray, rules: JoinRules) -> np.ndarray:
    """All of a set's subset signatures, for counting."""
    seen: list[np.ndarray] = []

    def note(signatures: np.ndarray) -> np.ndarray:
        seen.append(signatures)
        return np.zeros(len(signatures), dtype=np.int64)

    signatures_of(shingles, note, rules)
    return np.concatenate(seen) if seen else np.zeros(0, dtype=np.uint64)


def _estimate_costs(docs: DataFrame, n: int, rules: JoinRules) -> Costs:
    share = min(1.0, rules.sample_docs / max(1, n))

    def count(batches):
        for part in column_slices(batches, "text"):
            found = [_every_signature(s, rules) for s in shingle_sets(part.column("text").to_pylist(), rules.words)]
            together = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
            values, times = np.unique(together, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(times)], names=["signature", "n"])

    drawn = docs.filter(hash_share(F.col("doc_id"), 4) < share).select("text")
    often = (
        drawn.mapInArrow(count, "signature long, n long").groupBy("signature").agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= rules.costly_from).toPandas()
    )
    return Costs(often["signature"].to_numpy(dtype=np.int64).view(np.uint64), often["n"].to_numpy(dtype=np.int64))


# --- candidates -----------------------------------------------------------------------------


def _index(shared, buckets: int, rules: JoinRules):
    """Signatures of each node, packed by bucket: 32 bits of the signature and the node."""

    def run(batches):
        give_back()
        costs: Costs = shared.value
        done: set[int] = set()
        for part in column_slices(batches, "text"):
            keys, nodes, sizes = [], [], []
            for shingles in shingle_sets(part.column("text").to_pylist(), rules.words):
                node = node_of(shingles)
                if not len(shingles) or node in done:
                    continue
                if len(done) > 200_000:
                    done.clear()
                done.add(node)
                own = signatures_of(shingles, costs, rules)
                keys.append(own)
                nodes.append(node)
                sizes.append(len(own))
            if not keys:
                continue
            key, node = np.concatenate(keys), np.repeat(np.array(nodes, dtype=np.int64), sizes)
            bucket = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            short, node, bucket = key[order].astype("<u4"), node[order].astype("<i8"), bucket[order]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[edges[:-1]], pa.int32()),
                 pa.array([short[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
                 pa.array([node[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary())],
                names=["bucket", "keys", "nodes"],
            )

    return run


_GROUPS = "members array<long>"


def _group(table: pa.Table) -> pa.Table:
    """Members of every signature two nodes or more share, each set of members once."""
    key = np.frombuffer(b"".join(table["keys"].to_pylist()), dtype="<u4")
    node = np.frombuffer(b"".join(table["nodes"].to_pylist()), dtype="<i8")
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node = key[fresh], node[fresh]
    edges = np.flatnonzero(np.diff(key.astype(np.int64), prepend=-1, append=1 << 40))
    lengths = np.diff(edges)
    pairs = np.flatnonzero(lengths == 2)
    twos = pd.DataFrame({"a": node[edges[pairs]], "b": node[edges[pairs] + 1]}).drop_duplicates()
    larger = {node[edges[i] : edges[i + 1]].tobytes() for i in np.flatnonzero(lengths > 2)}
    lists = [np.frombuffer(x, dtype="<i8") for x in larger]
    flat = np.concatenate([twos.to_numpy().ravel(), *lists]).astype(np.int64)
    sizes = np.concatenate([np.full(len(twos), 2), [len(x) for x in lists]]).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.table({"members": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))})


# --- comparison -----------------------------------------------------------------------------


def _texts_of(docs: DataFrame, wanted: DataFrame, rules: JoinRules) -> DataFrame:
    """node, text of the documents in wanted (doc_id), and of few others.

    The wanted ids are marked in a bitmap of bounded size, so that texts are not shuffled to find
    them. What the bitmap lets through by chance is no harm: pairs are joined by node.
    """
    n = wanted.count()
    bits = 1 << max(15, min(28, math.ceil(math.log2(max(2, 16 * n)))))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    parts = (
        # Spark's bitmaps number bits from 1.
        wanted.select((place + 1).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap")).collect()
    )
    marks = np.zeros(bits // 8, dtype=np.uint8)
    for r in parts:
        at = (r["bucket"] - 1) * 4096
        own = np.frombuffer(bytes(r["bitmap"]), dtype=np.uint8)[: bits // 8 - at]
        marks[at : at + len(own)] = own
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        own = shared.value
        for batch in batches:
            p = batch.column("p").to_numpy(zero_copy_only=False)
            kept = batch.filter(pa.array((own[p >> 3] >> (p & 7).astype(np.uint8)) & 1 > 0))
            for part in column_slices(iter([kept]), "text") if kept.num_rows else ():
                nodes = [node_of(s) for s in shingle_sets(part.column("text").to_pylist(), rules.words)]
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), part.column("text")], names=["node", "text"])

    return docs.select(place.alias("p"), "text").mapInArrow(run, "node long, text string")


def _possible(pairs: DataFrame, nodes: DataFrame, rules: JoinRules) -> DataFrame:
    """a, b, ra, rb: pairs of nodes whose sizes and sketches allow a link, with their documents."""
    left, right = (nodes.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n_shingles", "rep", "sketch")]) for x in "ab")
    near = 100 * F.least("n_shingles_a", "n_shingles_b") >= rules.links_at * F.greatest("n_shingles_a", "n_shingles_b")

    def run(batches):
        for part in batches:
            columns = (part.column(c).to_pylist() for c in ("n_shingles_a", "n_shingles_b", "sketch_a", "sketch_b"))
            keep = [least_different(x, y) <= _may_differ(na, nb, rules) for na, nb, x, y in zip(*columns)]
            yield part.select(["a", "b", "rep_a", "rep_b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").filter(near).mapInArrow(run, "a long, b long, rep_a long, rep_b long")


def _compare(possible: DataFrame, docs: DataFrame, rules: JoinRules) -> DataFrame:
    """a, b, both, either: sizes of intersection and union of each pair's whole sets."""
    wanted = stage(possible)
    ids = wanted.select(F.explode(F.array("rep_a", "rep_b")).alias("doc_id")).distinct()
    texts = stage(_texts_of(docs, ids, rules))
    of_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    of_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = wanted.select("a", "b").join(of_b, "b").join(of_a, "a").select("a", "b", "text_a", "text_b")

    def run(batches):
        give_back()
        last, kept = None, None
        for part in column_slices(batches, "text_b"):
            ids = part.column("a").to_pylist()
            texts, shared = part.column("text_a").to_pylist(), []
            others = shingle_sets(part.column("text_b").to_pylist(), rules.words)
            sizes = []
            for a, text, other in zip(ids, texts, others):
                if a != last:
                    last, kept = a, shingle_sets([text], rules.words)[0]
                both = len(np.intersect1d(kept, other, assume_unique=True))
                shared.append(both)
                sizes.append(len(kept) + len(other) - both)
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), pa.array(shared, pa.int64()), pa.array(sizes, pa.int64())],
                names=["a", "b", "both", "either"],
            )

    return stage(joined.mapInArrow(run, "a long, b long, both long, either long"))


class _Sketches:
    """Sketches of many rows by their number of cells, and folded to half of it."""

    def __init__(self, sketches: list[bytes]):
        self.cells = np.array([8 * len(x) for x in sketches])
        self.rows, self.own, self.half = np.zeros(len(sketches), np.int64), {}, {}
        for cells in np.unique(self.cells):
            at = np.flatnonzero(self.cells == cells)
            self.rows[at] = np.arange(len(at))
            words = np.frombuffer(b"".join(sketches[i] for i in at), dtype="<u8").reshape(len(at), -1)
            self.own[cells] = words
            if words.shape[1] > 1:
                self.half[cells // 2] = words[:, : words.shape[1] // 2] ^ words[:, words.shape[1] // 2 :]

    def different(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For rows a and b, a of no more cells than b and of half as many at least."""
        out = np.zeros(len(a), dtype=np.int64)
        for cells in np.unique(self.cells[a]):
            for table, other in ((self.own, cells), (self.half, cells * 2)):
                at = np.flatnonzero((self.cells[a] == cells) & (self.cells[b] == other))
                for some in np.array_split(at, max(1, len(at) * int(cells) >> 26)) if len(at) else ():
                    x, y = self.own[cells][self.rows[a[some]]], table[cells][self.rows[b[some]]]
                    out[some] = np.bitwise_count(x ^ y).sum(axis=1)
        return out


def _open_pairs(rules: JoinRules):
    """Pairs of members of one group, in different components, whose sizes and sketches allow a link."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([(c, "ascending") for c in ("group", "first", "second", "n_shingles", "node")])
        group, first, second, side, sizes, labels, ids, reps = (
            np.asarray(table[c]) for c in ("group", "first", "second", "side", "n_shingles", "label", "node", "rep")
        )
        sketches = _Sketches(table["sketch"].to_pylist())
        fresh = np.ones(len(ids) + 1, dtype=bool)
        fresh[1:-1] = (np.diff(group) != 0) | (np.diff(first) != 0) | (np.diff(second) != 0)
        edges = np.flatnonzero(fresh)
        end = np.repeat(edges[1:], np.diff(edges))
        found, i, k = [], np.arange(len(ids)), 1
        while len(i):
            # Sizes rise within a group: once a partner is too large, so are all after it.
            i = i[i + k < end[i]]
            i = i[100 * sizes[i] >= rules.links_at * sizes[i + k]]
            j = i + k
            want = (labels[i] != labels[j]) & ((first[i] == second[i]) | (side[i] != side[j]))
            a, b = i[want], j[want]
            near = sketches.different(a, b) <= _may_differ(sizes[a], sizes[b], rules)
            found.append(np.stack([a[near], b[near]]))
            k += 1
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        swap = ids[a] > ids[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        return pa.table({"a": ids[a], "b": ids[b], "rep_a": reps[a], "rep_b": reps[b]})

    return run


def _members(groups: DataFrame) -> DataFrame:
    """group, node, n: members of groups of three or more, and how many there are."""
    return stage(
        groups.filter(F.size("members") > 2)
        .select(F.xxhash64("members").alias("group"), F.size("members").alias("n"), F.explode("members").alias("node"))
    )


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with the component each is in by now."""
    return stage(
        members.join(labels.select("node", F.col("label").alias("own")), "node", "left")
        .withColumn("label", F.coalesce("own", "node")).drop("own")
    )


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their labels, of groups whose members are in several components."""
    labelled = _labelled(members, labels)
    several = stage(
        labelled.groupBy("group").agg(F.min("label").alias("l"), F.max("label").alias("m")).filter("l <> m").select("group")
    )
    return stage(labelled.join(several, "group"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after one step along new links: nodes with one label stay connected, no more is needed here."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = labels.unionByName(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label")))
    of_a, of_b = (known.select(F.col("node").alias(x), F.col("label").alias("l" + x)) for x in "ab")
    down = (
        links.join(of_a, "a").join(of_b, "b").filter("la <> lb")
        .groupBy(F.greatest("la", "lb").alias("label")).agg(F.min(F.least("la", "lb")).alias("to"))
    )
    return stage(known.join(down, "label", "left").select("node", F.coalesce("to", "label").alias("label")))


def _hub_pairs(members: DataFrame, labels: DataFrame, hubs: int) -> DataFrame:
    """a, b: each member of an open group with the group's hubs whose components are others.

    Each hub is the first in an order of its own over all nodes, so groups with much the same
    members have the same hubs. A node's equal lists of hubs are one before they are taken apart, and
    hubs of its own component are left out before rows multiply.
    """
    labelled = _labelled(members, labels)
    firsts = [F.min(F.struct(F.xxhash64(F.lit(i), F.col("node")).alias("turn"), "node", "label")) for i in range(hubs)]
    # One aggregate tells which groups are open and chooses their hubs.
    chosen = stage(
        labelled.groupBy("group").agg(F.min("label").alias("l"), F.max("label").alias("m"), F.array(*firsts).alias("hubs"))
        .filter("l <> m").select("group", F.transform("hubs", lambda h: F.struct(h["node"].alias("node"), h["label"].alias("label"))).alias("hubs"))
    )
    others = F.transform(F.filter("hubs", lambda h: h["label"] != F.col("label")), lambda h: h["node"])
    met = labelled.join(chosen, "group").select("node", F.array_distinct(others).alias("others"))
    pairs = met.filter(F.size("others") > 0).distinct().select("node", F.explode("others").alias("hub"))
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _remaining(opened: DataFrame, compared: DataFrame, nodes: DataFrame, rules: JoinRules) -> DataFrame:
    """Possible pairs in a common group whose components still differ."""
    still = opened.withColumn("blocks", F.ceil(F.col("n") / rules.block).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    many = max(1, math.ceil(opened.count() / rules.cell_rows))
    # A cell holds pairs of blocks of groups, the block with the smaller number first.
    cells = still.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "group", F.least("block", "with").alias("first"), F.greatest("block", "with").alias("second"),
        F.when(F.col("block") <= F.col("with"), 0).otherwise(1).alias("side"), "node", "label",
    )
    dealt = (
        cells.join(nodes.select("node", "n_shingles", "rep", "sketch"), "node")
        .withColumn("cell", F.pmod(F.xxhash64("group", "first", "second"), F.lit(many)))
    )
    return (
        dealt.groupBy("cell").applyInArrow(_open_pairs(rules), "a long, b long, rep_a long, rep_b long")
        .distinct().join(compared.select("a", "b"), ["a", "b"], "left_anti")
    )


# --- the join -------------------------------------------------------------------------------


def _classes(docs: DataFrame, rules: JoinRules) -> DataFrame:
    """row, the row_key of doc_id and text, and the columns of similarity_classes."""
    spark = docs.sparkSession
    ship_package(spark)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("row"), "text")

    def measure(batches):
        give_back()
        for part in column_slices(batches, "text"):
            sets = shingle_sets(part.column("text").to_pylist(), rules.words)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) for s in sets], pa.int64()),
                 pa.array([sketch_of(s, rules) for s in sets], pa.binary())],
                names=["row", "doc_id", "n_shingles", "node", "sketch"],
            )

    sets = stage(narrow.mapInArrow(measure, "row long, doc_id long, n_shingles long, node long, sketch binary"))
    known = narrow.filter(F.col("doc_id").isNotNull())
    real = sets.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    nodes = stage(real.groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch")))
    n, shingles = nodes.agg(F.count("*"), F.sum("n_shingles")).first()

    shared = spark.sparkContext.broadcast(_estimate_costs(known, sets.count(), rules))
    buckets = max(1, math.ceil((shingles or 0) / 2 / rules.bucket_entries))
    indexed = known.select("text").mapInArrow(_index(shared, buckets, rules), "bucket int, keys binary, nodes binary")
    groups = stage(indexed.groupBy("bucket").applyInArrow(_group, _GROUPS))
    groups = stage(groups.distinct())

    hub = F.element_at("members", 1)
    stars = groups.select(hub.alias("a"), F.explode(F.slice("members", 2, F.size("members"))).alias("b")).distinct()
    linked = 100 * F.col("both") >= rules.links_at * F.col("either")

    compared = _compare(_possible(stars, nodes, rules), known, rules)
    labels = stage(connected_components(compared.filter(linked).select("a", "b")))
    members = _members(groups)
    large = members.filter(F.col("n") >= rules.hub_from)
    pairs = _hub_pairs(large, labels, rules.hubs).join(compared.select("a", "b"), ["a", "b"], "left_anti")
    more = _compare(_possible(pairs, nodes, rules), known, rules)
    labels = _merged(labels, more.filter(linked).select("a", "b"))
    compared = compared.unionByName(more)
    also = _compare(_remaining(_open(members, labels), compared, nodes, rules), known, rules)
    links = stage(compared.unionByName(also).filter(linked).select("a", "b").distinct())
    labels = stage(connected_components(links))

    degrees = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    of_node = (
        nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    )
    least = of_node.groupBy("label").agg(F.min("rep").alias("component"))
    named = of_node.join(least, "label").join(degrees, "node", "left").select("node", "component", "n_links")
    linkable = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    keyed = sets.withColumn("key", F.when(linkable, F.col("node")))
    return keyed.join(named, keyed["key"] == named["node"], "left").select(
        "row", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def similarity_classes(docs: DataFrame, rules: JoinRules = JoinRules()) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for every row of docs.

    Needs doc_id and text; other columns are left out. component_id is the smallest doc_id reachable
    by links, the document's own included; n_links the number of other sets found to link with it
    directly, of those compared. Documents with an empty set, and those without an id, are linked
    with nothing. Rows with equal doc_id are one document if their sets are equal.
    """
    return _classes(docs, rules).drop("row")


def keep_one_of_each(docs: DataFrame, rules: JoinRules = JoinRules()) -> DataFrame:
    """Rows of docs without those linked, over any number of links, to a document with a smaller id.

    Rows equal in doc_id and text are one document and one of them stays; rows without an id stay.
    Rows of one doc_id with other texts are judged each by its own text.
    """
    found = stage(_classes(docs, rules))
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("row").alias("_gone_row")).distinct()
    kept = docs.join(gone, row_key("doc_id", "text") == F.col("_gone_row"), "left_anti").select(*docs.columns)
    often = found.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    if often.isEmpty():
        return kept
    once = kept.join(often, "doc_id", "left_anti").select(*docs.columns)
    return once.unionByName(kept.join(often, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"]))
