"""The near-duplicate stage against brute-force Jaccard similarity."""

import random
from collections import defaultdict

from claimscreen.llm import simhash
from tests.llm import fixtures as fx


def shingles(text, n=5):
    words = text.lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def brute_kept(rows, similarity=0.8):
    """The smallest id of each component of all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append(d)
    return sorted(min(g) for g in groups.values())


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(r["doc_id"] for r in simhash.keep_one(df, similarity=0.8, verify=5).collect())
    assert got == brute_kept(rows)
    return got


def swapped(base, places):
    words = list(base)
    for i in places:
        words[i], words[i + 1] = words[i + 1], words[i]
    return " ".join(words)


def test_hub(spark):
    """Variants of one fingerprint, alike to the base and not to each other; more of them than one round compares."""
    rng = random.Random(1)
    rows = []
    for k in range(2):
        base = [f"{k}w{rng.randrange(10**9)}" for _ in range(200)]
        texts = [" ".join(base)] + [swapped(base, rng.sample(range(0, 198, 8), 3)) for _ in range(90 if k else 30)]
        rows += [(1000 * k + i, t) for i, t in enumerate(texts)]
    assert check(spark, rows) == [0, 1000]


def test_any_edits(spark):
    """Words replaced, inserted and left out, over the range of similarities: far more bits of a SimHash than two."""
    rng = random.Random(2)
    rows = []
    for k in range(40):
        base = [f"{k}w{rng.randrange(10**9)}" for _ in range(rng.choice([6, 30, 150, 400]))]
        for i in range(5):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 25))):
                at = rng.randrange(len(words))
                words[at : at + rng.choice([0, 1, 1])] = [f"new{rng.randrange(10**9)}"] * rng.choice([0, 1, 1])
            rows.append((10 * k + i, " ".join(words)))
    check(spark, rows + [(10**6 + i, t) for i, t in enumerate(["", "one two", "One  two", "one two three"])])


def test_documents(spark):
    check(spark, [(d, t) for d, t in fx.pairs(fx.documents(spark)) if d is not None])


def test_crowd_is_compared_with_its_centre(spark, monkeypatch):
    """Variants that are alike to one text only, which is not the first of them: few pairs are compared, all are found."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**9)}" for _ in range(150)]
    texts = [" ".join(base)]
    for _ in range(240):
        words = list(base)
        for at in rng.sample(range(5, 145, 5), 3):
            words[at] = f"new{rng.randrange(10**9)}"
        texts.append(" ".join(words))
    compared, alike = [], simhash.alike
    monkeypatch.setattr(simhash, "alike", lambda pairs, *rest: compared.append(pairs.distinct().count()) or alike(pairs, *rest))
    assert check(spark, list(enumerate(texts))) == [0]
    assert sum(compared) <= 5 * len(texts)
