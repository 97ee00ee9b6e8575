from stintlab.llm.components import connected_components


def plainly(links):
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {(i, find(i)) for i in root}


def test_chains_stars_and_loops(spark, rng):
    chain = [(i, i + 1) for i in range(100)]
    star = [(1000, 1000 + i) for i in range(1, 60)] + [(1050, 1050)]
    mixed = [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)]
    for links in (chain, star, mixed, chain[::-1] + star + mixed, [(5, 5)], []):
        table = spark.createDataFrame(links, "a long, b long")
        assert {tuple(r) for r in connected_components(table).collect()} == plainly(links)
