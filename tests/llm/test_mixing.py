import re
from collections import defaultdict

import numpy as np

from claimscreen.llm import mixing
from tests.llm import fixtures as fx

GAP = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    low, high = 0.0, 1e12
    goal = min(share, cap) * sum(sizes.values())
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(cap * sizes[s], mid * w[s]) for s in names) < goal else (low, mid)
    return {s: min(cap * sizes[s], high * w[s]) for s in names}


def check(df):
    rows = mixing.mix(df, shards=8, block=4).collect()
    want = fx.ordered((r["doc_id"], r["source"], len(GAP.findall(r["text"] or ""))) for r in df.select("doc_id", "source", "text").collect())
    assert fx.ordered((r["doc_id"], r["source"], r["size"]) for r in rows) == want
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    goals = brute_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - goals[r["source"]]) < 1e-3
    for s in sizes:
        assert abs(taken[s] - goals[s]) <= 0.5 + 1e-3
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(df.repartition(3), shards=8, block=4).collect()))


def test_documents(spark):
    check(fx.documents(spark))


def test_awkward(spark):
    check(fx.awkward(spark))


def test_empty(spark):
    assert mixing.mix(fx.empty(spark)).collect() == []


def test_split_is_exact():
    held = np.array([5, 0, 100, 3, 7, 1000, 1], dtype=np.int64)
    for q in (0, 1, 500, 1115, 1116):
        parts = mixing.split_quota(held, q, 3)
        assert parts.sum() == q and (parts <= held).all() and (parts >= 0).all()
    big = np.array([10**13, 3 * 10**13, 5], dtype=np.int64)
    parts = mixing.split_quota(big, 2 * 10**13, 3)
    assert parts.sum() == 2 * 10**13 and abs(parts[0] / parts[1] - 1 / 3) < 0.01


def test_split_is_proportional():
    got = sum(mixing.split_quota(np.array([10, 20, 70]), 50, s) for s in range(400)) / 400
    assert np.allclose(got, [5, 10, 35], atol=0.5)


def test_blocks_are_disjoint():
    sizes = np.array([3, 0, 10, 7, 1], dtype=np.int64)
    for q in range(22):
        taken = mixing.draw_blocks(sizes, np.array([4, 3, 2, 9, 1]), q, 4, 1)
        assert taken.sum() == q and (taken <= sizes).all()
