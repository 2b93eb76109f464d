import random

import pytest

from chronolake.llm import common


def brute_force(edges):
    root = {x: x for e in edges if e[0] != e[1] for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def graphs():
    rng = random.Random(5)
    ids = rng.sample(range(-(1 << 61), 1 << 61), 300)
    path = rng.sample(ids, 200)
    return {
        "none": [],
        "loops": [(1, 1), (2, 2)],
        "path": list(zip(path, path[1:])),
        "hub": [(ids[0], x) for x in ids[1:]] + [(x, ids[0]) for x in ids[1:50]],
        "mixed": [tuple(rng.sample(ids, 2)) for _ in range(140)] * 2,
        "clique": [(a, b) for a in range(25) for b in range(25)],
    }


@pytest.mark.parametrize("part", [1 << 18, 40])
@pytest.mark.parametrize("name", list(graphs()))
def test_components_against_brute_force(spark, monkeypatch, name, part):
    monkeypatch.setattr(common, "TREE_LINKS", part)
    edges = graphs()[name]
    rows = common.components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()
    assert len(rows) == len({r["node"] for r in rows})
    assert {r["node"]: r["component"] for r in rows} == brute_force(edges)
