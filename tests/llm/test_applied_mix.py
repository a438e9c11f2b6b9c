"""The mix as applied to texts: what is drawn is what comes out."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from claimscreen.llm import mixing

GAP = re.compile(r"[^\x20\x09-\x0D]+")


def test_ranges_are_the_blocks():
    """Against a word-by-word version of the draw."""
    rng = np.random.default_rng(3)
    for block in (1, 4, 64):
        sizes, keys = rng.integers(0, 90, 12), rng.integers(-9, 9, 12)
        order = sorted(range(12), key=lambda i: (keys[i], i))
        words = [(d, k) for d in order for k in range(sizes[d])]
        n = -(-len(words) // block)
        line = [w for p in np.random.default_rng([5, n]).permutation(n) for w in words[p * block : (p + 1) * block]]
        for quota in range(0, len(words) + 1, 7):
            docs, lo, hi = mixing.draw_ranges(sizes, keys, quota, block, 5)
            got = [(d, k) for d, a, b in zip(docs, lo, hi) for k in range(a, b)]
            assert sorted(got) == sorted(line[:quota]) and len(set(got)) == len(got)


@pytest.mark.parametrize("copies", [1, 3])
def test_texts_are_what_is_drawn(spark, copies):
    rng = random.Random(4)
    rows = []
    for d in range(30):
        words = [f"d{d}w{i}" for i in range(rng.choice([1, 40, 300]))]
        text = "".join(w + rng.choice([" ", " ", "\n", "\t "]) for w in words)
        rows += [(d, text, "ab"[d % 2], len(text))] * (copies if d % 5 == 0 else 1)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars int")
    drawn = mixing.mix(df, shards=4, block=8, ranges=True).collect()
    texts = {r[0]: r[1] for r in rows}
    want, by_doc = Counter(), defaultdict(int)
    for r in drawn:
        words, part = GAP.findall(texts[r["doc_id"]]), sum(b - a for a, b in zip(r["starts"], r["stops"]))
        for _ in range((r["taken"] - part) // max(1, r["size"])):
            want.update(words)
        for a, b in zip(r["starts"], r["stops"]):
            want.update(words[a:b])
        by_doc[r["doc_id"]] += r["taken"]
    out = mixing.apply_mix(df, shards=4, block=8).collect()
    assert Counter(w for r in out for w in GAP.findall(r["text"])) == want and sum(want.values()) == sum(by_doc.values())
    parts = [r for r in out if r["text"] != texts[r["doc_id"]]]
    assert any(not texts[r["doc_id"]].startswith(r["text"].split("\n")[0]) for r in parts)
    pairs = lambda t: set(zip(GAP.findall(t), re.findall(r"[\x20\x09-\x0D]+", t)))
    for r in out:
        assert r["n_chars"] == len(r["text"]) and all(p in pairs(texts[r["doc_id"]]) or p[1] == "\n" for p in pairs(r["text"]))
