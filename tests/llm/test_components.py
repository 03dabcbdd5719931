import random

from ruleforge.llm.components import connected_components


def test_against_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(60)] + [(7, 7), (None, 3), (3, None)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
