import hashlib
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from stintlab.llm import periodic_runs
from tests.llm.tables import ODD_ROWS, docs, with_extra_columns

DATA = "/root/testdata/sf0.01"


def plain_runs(words):
    """Every stretch of every period, extended word by word; of one stretch the smallest period."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_runs_equal_those_of_every_period(rng):
    seen = 0
    for _ in range(1500):
        n, words = rng.randint(0, 70), []
        while len(words) < n:
            unit = [rng.randrange(3) for _ in range(rng.randint(1, 6))]
            words += unit * rng.randint(1, 9)
        got = [(s, e - s, q) for s, e, q in periodic_runs.runs_of(np.array(words, np.int64))]
        assert got == plain_runs(words)
        seen += len(got)
    assert seen > 1000


@pytest.mark.parametrize("words, period", [
    ([0] * 200_000, 1), (([0] * 300 + [1]) * 700, 301), (list(range(5000)) * 40, 5000), (([7] * 50 + list(range(60))) * 900, 110),
])
def test_long_documents_take_no_quadratic_time(words, period):
    import time

    start = time.perf_counter()
    found = periodic_runs.runs_of(np.array(words, np.int64))
    assert time.perf_counter() - start < 20 and (0, len(words), period) in found


def test_common_lengths_follow_suffix_order(rng):
    words = np.array([rng.randrange(2) for _ in range(400)])
    order, common = periodic_runs.suffix_clusters(words)
    suffixes = [words[i:].tolist() for i in order]
    for (a, b), length, i in zip(zip(suffixes, suffixes[1:]), common[1:], range(len(common))):
        true = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert length == (true if true >= 5 else 0)
        if length:
            assert a < b


def test_no_run_crosses_documents(spark):
    table = docs(spark, [(1, "a b a b a b"), (2, "a b a b a b a b"), (3, "a b"), (4, "a b")])
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic_runs.find_runs(table.coalesce(1)).collect()}
    assert got == {1: [], 2: [(0, 8, 2)], 3: [], 4: []}


def test_awkward_rows(spark):
    blanks = [(10, "x\x0bx\x0cx\rx\tx\nx x"), (11, "x\x85x\xa0x x x x x"), (12, "ü 日 " * 9), (-3, "q " * 7 + "r")]
    rows = [(r[0], r[1]) for r in ODD_ROWS] + blanks
    table = with_extra_columns(docs(spark, rows))
    got = rows_of(periodic_runs.digest(periodic_runs.find_runs(periodic_runs.loop_tails(table))))
    assert got == sorted((plain_row(i, t) for i, t in rows), key=repr)
    assert periodic_runs.find_runs(periodic_runs.loop_tails(table.limit(0))).count() == 0


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(r["text"] or "") < 12_000]
    want = {r["doc_id"]: plain_row(r["doc_id"], r["text"]) for r in rows}
    got = {r["doc_id"]: tuple(r) for r in entry.queries()["op13_periodic_runs"](spark, DATA).collect()}
    assert {i: got[i] for i in want} == want and sum(w[1] for w in want.values()) > 20
