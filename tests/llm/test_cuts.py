"""Window and suffix-array dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from claimscreen.llm import repeats, windows
from tests.llm import fixtures as fx


def brute_windows(rows, n):
    docs = [(d, t.encode().split()) for d, t in rows]
    first = {}
    for d, w in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i : i + n]), d)
    out = []
    for d, w in docs:
        gone = {i + k for i in range(len(w) - n + 1) if first[tuple(w[i : i + n])] != d for k in range(n)}
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return fx.ordered(out)


def brute_repeats(rows, n):
    texts = [(d, t.encode()) for d, t in rows]
    seen = Counter(t[i : i + n] for _, t in texts for i in range(len(t) - n + 1))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] > 1:
                gone[i : i + n] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return fx.ordered(out)


def got(df, *cols):
    return fx.ordered(tuple(r) for r in df.select(*cols).collect())


def test_windows(spark):
    for df in (fx.documents(spark), fx.awkward(spark)):
        out = windows.remove_repeated_windows(df, texts=True)
        assert got(out, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_windows(fx.pairs(df), 13)
    assert windows.remove_repeated_windows(fx.empty(spark)).collect() == []


@pytest.mark.parametrize("crowd", [256, 1])
def test_repeats(spark, crowd):
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    df = fx.documents(spark)
    assert got(repeats.remove_repeats(df, crowd=crowd), *cols) == brute_repeats(fx.pairs(df), 400)
    df = fx.awkward(spark).filter("doc_id is null or doc_id <> 9")
    assert got(repeats.remove_repeats(df, length=100, crowd=crowd), *cols) == brute_repeats(fx.pairs(df), 100)


def test_repeats_of_cut_passages(spark):
    """Documents that end at different places of a passage, so that contexts share long and very long prefixes."""
    rng = random.Random(5)
    texts = []
    for alphabet in ("abcdefghij klm", "ab", "ab\u00e9\0 ") * 20:
        word = lambda n: "".join(rng.choice(alphabet) for _ in range(n))  # noqa: B023, E731
        base = word(rng.randrange(500, 1500))
        for _ in range(10):
            start = rng.randrange(len(base) // 3)
            texts.append(word(rng.randrange(20)) + base[start : rng.randrange(start, len(base) + 1)] + word(rng.randrange(20)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(repeats.remove_repeats(df), *cols) == brute_repeats(fx.pairs(df), 400)


def test_repeats_empty(spark):
    assert repeats.remove_repeats(fx.empty(spark)).collect() == []


def test_maximal_repeats_have_all_occurrences():
    rng = np.random.default_rng(1)
    piece = bytes(rng.integers(97, 123, 60).astype(np.uint8))
    bodies = [bytes(rng.integers(97, 123, 50).astype(np.uint8)) + piece + bytes(rng.integers(97, 123, 50).astype(np.uint8)) for _ in range(4)]
    groups, edges = repeats.repeats_in(bodies, 40)
    best = max(groups, key=lambda g: len(g[1]))
    assert best[0] >= 60 and sorted(best[1].tolist()) == [int(e) + 50 for e in edges[:-1]]
