import random

from rasmlens.llm.components import components


def plain(links):
    first = {}

    def top(x):
        first.setdefault(x, x)
        while first[x] != x:
            x = first[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((top(a), top(b)))
            first[high] = low
    return {x: top(x) for x in list(first)}


def found(spark, links):
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(rows) == len({r["node"] for r in rows})
    return {r["node"]: r["root"] for r in rows}


def test_random_graphs_a_chain_and_a_hub(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(-5, k) for k in range(2000, 2040)] + [(7, 7), (3, 4), (4, 3), (3, 4)]
    rng.shuffle(links)
    assert found(spark, links) == plain(links)


def test_no_links(spark):
    assert found(spark, []) == {} and found(spark, [(1, 1)]) == {}
