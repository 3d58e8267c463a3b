"""Components against a plain model."""

import random

from quire.llm.graph import connected_components


def test_components_of_chains_stars_and_strangers(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(35)]
    edges += [(5, 4), (7, 7), (-8, 300), (300, -8)]
    r.shuffle(edges)
    label = {v: v for e in edges if e[0] != e[1] for v in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {x["id"]: x["component"] for x in got} == label and len(got) == len(label)


def test_components_of_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
