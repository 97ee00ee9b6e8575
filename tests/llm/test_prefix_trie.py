import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from stintlab.config import SCALE
from stintlab.llm import prefix_trie
from stintlab.llm.prefix_trie import SlotTable, TrieRules

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    """The nodes of the rebuilt conversations, counted prefix by prefix."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, mark, (role, text)))
    own = {c: [t[3] for t in sorted(turns, key=lambda t: t[:3])] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in sorted(rebuilt.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own_members in members.items():
        gain = (len(own_members) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += gain
    out = []
    for node, own_members in members.items():
        ends = ",".join(str(c) for c in own_members if len(rebuilt[c]) == len(node))
        out.append((
            own_members[0], len(node), members[node[:-1]][0] if node else None, len(own_members), children[node],
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def trie(spark, rows, rules=prefix_trie.RULES, scale=SCALE, extra=False):
    table = spark.createDataFrame(rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        table = table.withColumns({c: F.lit(3) for c in ("k1", "depth", "place", "size", "base", "d1", "n_bytes", "top")})
    turns, ids = prefix_trie.share_heads(prefix_trie.slim_turns(table), scale)
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(turns, ids, rules, scale).collect()), key=repr)


@pytest.fixture(scope="module")
def conversations(rng):
    rows = []
    for c in range(-12, 160):
        if rng.random() < 0.1:
            continue
        copied = rng.randrange(4)
        for turn in range(rng.randint(1, 12)):
            text = f"same {turn} {copied}" if rng.random() < 0.9 else f"own {rng.randrange(99)} é"
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", text))
    rng.shuffle(rows)
    return rows


AWKWARD = [
    (0, None, "user", "null turn first"), (0, 1, None, "x"), (0, 1, "", "x"), (0, 1, "a", "tie"), (0, 2, "user", None),
    (3, 0, "user", "x"), (3, 0, "user", "x"), (3, 0, "user", "x"), (None, 0, "user", "no conversation"), (7, None, None, None),
    (7, None, None, None), (-3, 0, "ab", "c"), (-4, 0, "a", "bc"), (10, 5, "user", "y" * 50_000), (11, 5, "user", "日本語"),
]


def test_awkward_rows(spark):
    assert trie(spark, AWKWARD, extra=True) == plain_trie(AWKWARD)
    assert trie(spark, []) == []


def test_counts_equal_those_of_every_prefix(spark, conversations):
    assert trie(spark, conversations) == plain_trie(conversations)


def test_upper_part_and_many_shards(spark, conversations):
    want = plain_trie(conversations)
    for rows in (1, 30):
        assert trie(spark, conversations, TrieRules(subtree_rows=rows, piece_bytes=60)) == want


def test_one_giant_conversation_in_blocks(spark, tight):
    rows = [(1, t, "user", f"turn {t % 3}") for t in range(300)] + [(5, t, "user", f"turn {t % 3}") for t in range(250)]
    rows += [(c, 0, "user", "turn 0") for c in range(20, 60)]
    assert trie(spark, rows, TrieRules(subtree_rows=40), tight) == plain_trie(rows)


def test_many_copies_end_at_one_node(spark):
    rows = [(c, t, "user", f"copy {t}") for c in range(0, 4000, 5) for t in range(9)]
    assert trie(spark, rows, TrieRules(subtree_rows=100, piece_bytes=400)) == plain_trie(rows)


def test_slots_are_minimal_and_checked():
    draw = np.random.default_rng(3)
    k1, k2 = draw.integers(-(2**63), 2**63 - 1, (2, 20_000))
    k1[5000:] = 17  # names that differ in one half only
    table = SlotTable(k1, k2)
    assert sorted(table.find(k1, k2).tolist()) == list(range(20_000))
    other = np.arange(1000, dtype=np.int64)
    assert (table.find(other, other) == -1).all()
    with pytest.raises(ValueError):
        SlotTable(np.zeros(2, np.int64), np.zeros(2, np.int64))


def test_equal_names_of_different_prefixes_are_found_out():
    import pyarrow as pa

    same = {n: [1, 1] for n in ("depth", "size", "k1", "k2", "p1", "p2", "d1", "d2", "n_bytes")}
    good = pa.table({"conv_id": [1, 2], **same})
    assert prefix_trie._shard_nodes(good).num_rows == 1
    with pytest.raises(ValueError):
        prefix_trie._shard_nodes(pa.table({"conv_id": [1, 2], **same, "d2": [1, 9]}))
