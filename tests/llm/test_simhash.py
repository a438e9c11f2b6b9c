from collections import defaultdict

import xxhash

from claimscreen.llm import simhash
from claimscreen.llm.components import components
from tests.llm import fixtures as fx


def brute_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute(rows, max_bits=2):
    prints = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        members[find(i)].append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in members.items()}
    return fx.ordered((d, f"{prints[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows))


def check(df, max_bits=2):
    got = fx.ordered(tuple(r) for r in simhash.near_duplicates(df, max_bits).collect())
    assert got == brute(fx.pairs(df), max_bits)


def test_documents(spark):
    check(fx.documents(spark))


def test_odd_radius(spark):
    check(fx.documents(spark).limit(60), 3)


def test_awkward(spark):
    check(fx.awkward(spark))
    kept = simhash.keep_one(fx.awkward(spark))
    assert kept.columns == fx.awkward(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 in ids and 2 not in ids and None in ids


def test_empty(spark):
    assert simhash.near_duplicates(fx.empty(spark)).collect() == []


def test_close_fingerprints_chain(spark):
    fps = spark.createDataFrame([(x,) for x in (0, 3, 15, 63, 255, -1, -4, 1 << 40)], "fp bigint")
    got = {r["node"]: r["component"] for r in components(simhash.links(fps, 2)).collect()}
    assert got == {0: 0, 3: 0, 15: 0, 63: 0, 255: 0, -1: -4, -4: -4} | ({1 << 40: 0} if (1 << 40).bit_count() <= 2 else {})


def test_components_long_chain(spark):
    chain = spark.range(0, 500).selectExpr("id as a", "id + 1 as b")
    assert {r["component"] for r in components(chain).collect()} == {0}
    assert components(chain.limit(0)).count() == 0
