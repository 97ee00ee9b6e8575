from collections import Counter, defaultdict

import numpy as np
import pytest

from stintlab.llm.jaccard_join import JoinRules, keep_one_of_each, similarity_classes
from tests.llm.tables import ODD_ROWS, docs, with_extra_columns


def plainly(texts):
    """Size of each set and smallest id reachable, over all pairs that share a shingle."""
    sets, holders, root = {}, defaultdict(list), {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, text in texts.items():
        w = (text or "").encode().lower().split()
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets[i] = own
        shared = Counter(j for s in own for j in holders[s])
        for s in own:
            holders[s].append(i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in texts}


def changed(rng, words, vocabulary, times):
    out = list(words)
    for _ in range(times):
        k, how = rng.randrange(len(out)), rng.random()
        if how < 0.4:
            out[k] = rng.choice(vocabulary)
        elif how < 0.7:
            out.insert(k, rng.choice(vocabulary))
        elif len(out) > 1:
            out.pop(k)
    return out


@pytest.fixture(scope="module")
def texts(rng):
    """Near copies of all sizes, one large group of them, and a passage that many texts share."""
    words = [f"w{i}" for i in range(200)]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    out = []
    for _ in range(100):
        base = some(rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 18, 22, 30, 40, 60, 80, 120, 200]))
        out += [changed(rng, base, words, rng.randint(0, max(1, len(base) // 14))) for _ in range(rng.choice([1, 2, 3, 8]))]
    hub, passage = some(100), some(60)
    out += [changed(rng, hub, words, rng.randint(0, 6)) for _ in range(80)]
    out += [some(rng.randint(0, 40)) + passage + some(rng.randint(0, 40)) for _ in range(60)]
    return {i: " ".join(w) for i, w in enumerate(out)} | {-5: None, -4: "", -3: " \n", -2: " ".join(hub), -1: "W1 w2\tW3"}


# Limits so low that blocks, several buckets and costs from a small sample are all used.
@pytest.mark.parametrize("rules", [JoinRules(), JoinRules(block=15, bucket_entries=500, cell_rows=50, sample_docs=40, hub_from=5, hubs=2)], ids=["plain", "tight"])
def test_classes_equal_all_pairs(spark, texts, rules):
    got = similarity_classes(docs(spark, list(texts.items())), rules)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == plainly(texts)


def test_costs_never_change_the_result(spark, texts):
    few = dict(list(texts.items())[::3])
    for n in (0, 1000):
        got = similarity_classes(docs(spark, list(few.items())), JoinRules(sample_docs=n, costly_from=1)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plainly(few)


def test_sketches_never_exclude_a_link(rng):
    from stintlab.llm.jaccard_join import _Sketches, least_different, sketch_of

    rules, draw = JoinRules(most_cells=1024), np.random.default_rng(2)
    sets = []
    for n in (1, 5, 40, 200, 900, 3000):
        own = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
        sets += [own, own[: max(1, n * 9 // 10)], np.unique(np.append(own[n // 8 :], draw.integers(0, 1 << 63, n // 6, dtype=np.uint64)))]
    sketches = [sketch_of(s, rules) for s in sets]
    many = _Sketches(sketches)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            bound, real = least_different(sketches[i], sketches[j]), len(np.setxor1d(x, y))
            assert bound <= real and bound % 2 == real % 2
            if len(sketches[i]) in (len(sketches[j]), len(sketches[j]) // 2):
                assert many.different(np.array([i]), np.array([j]))[0] == bound


def test_threshold_is_met_exactly(spark):
    """15 of 20 shingles shared is a link, 14 of 19 is none."""
    words = [f"x{i}" for i in range(40)]
    a, b, c = words[:19], words[:19] + words[20:25], words[1:19] + words[30:35]
    got = {r["doc_id"]: r["component_id"] for r in similarity_classes(docs(spark, [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))])).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_one_of_each_stays_and_clean_texts_too(spark, texts):
    table = with_extra_columns(docs(spark, list(texts.items())))
    kept = keep_one_of_each(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in plainly(texts).items() if i == c)


def test_awkward_rows_and_empty_table(spark):
    table = with_extra_columns(docs(spark, ODD_ROWS))
    got = similarity_classes(table).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == sorted((r[0] or 0, r[0] or 0) for r in ODD_ROWS)
    assert sorted((r["doc_id"] or 0) for r in keep_one_of_each(table).collect()) == [0, 1, 2, 3, 4, 5, 6]
    assert similarity_classes(table.limit(0)).count() == 0


def test_texts_of_one_id_are_judged_each_by_itself(spark):
    copied, clean = " ".join(f"c{i}" for i in range(30)), " ".join(f"d{i}" for i in range(30))
    table = with_extra_columns(docs(spark, [(1, copied), (5, copied + " end"), (5, clean), (6, clean + " end")]))
    assert sorted((r["doc_id"], r["text"]) for r in keep_one_of_each(table).collect()) == [(1, copied), (5, clean)]
