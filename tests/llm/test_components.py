import random

from tunehouse.llm.components import connected_components


def plain(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in list(parent)}


def check(spark, pairs):
    df = spark.createDataFrame(pairs, "u bigint, v bigint")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == plain([(a, b) for a, b in pairs if a is not None and b is not None and a != b])


def test_shapes(spark):
    rng = random.Random(1)
    path = [(i, i + 1) for i in range(60)]
    names = rng.sample(range(100, 10_000), 61)
    shuffled = [(names[a], names[b]) for a, b in path]
    star = [(-5, i) for i in range(20_000, 20_200)]
    noise = [(None, 3), (4, None), (7, 7), (2, 1), (1, 2), (1, 2)]
    check(spark, [*path, *shuffled, *star, *noise])


def test_random_graph(spark):
    rng = random.Random(2)
    check(spark, [(rng.randrange(400) - 200, rng.randrange(400) - 200) for _ in range(230)])


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
