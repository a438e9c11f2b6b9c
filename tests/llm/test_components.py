"""Connected components and what finished queries leave."""

import random

from claimscreen.llm import components as module
from claimscreen.llm.common import release


def test_stars_need_no_round(spark, monkeypatch):
    monkeypatch.setattr(module, "_star", lambda pairs: 1 / 0)
    got = module.components(spark.createDataFrame([(1, 5), (7, 1), (5, 1), (2, 3), (4, 4)], "a long, b long"))
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 2), (3, 2), (5, 1), (7, 1)]
    assert module.components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_components_by_brute_force(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(70)] + [(i, i + 1) for i in range(100, 117)] + [(200, 203), (203, 201), (202, 200)]
    least = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in least:
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    assert dict(map(tuple, module.components(spark.createDataFrame(edges, "a long, b long")).collect())) == least


def test_release_collects_the_drivers_garbage(spark):
    beans = [b for b in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()]
    before = sum(b.getCollectionCount() for b in beans)
    release(spark)
    assert sum(b.getCollectionCount() for b in beans) > before
