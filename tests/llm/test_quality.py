import re
from collections import Counter

from claimscreen.llm import quality
from claimscreen.llm.quality import QualityLimits
from tests.llm import fixtures as fx

GAP = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = GAP.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    marked = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if GAP.search(x)]
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked), n < 20 or 100 * len(marked) > 30 * n


def normal(line):
    return re.sub(r"\s+", " ", re.sub(r"\d+", "0", line.lower()), flags=re.ASCII).strip(" ")


def brute(rows, limits):
    """rows: (doc_id, text, source)."""
    texts = {}
    for _, t, s in rows:
        texts.setdefault(s, set()).add(t)
    bad = {}
    for s, own in texts.items():
        n = Counter(x for t in own for x in {normal(y) for y in t.split("\n")} if len(x.split(" ")) >= limits.min_line_words)
        bad[s] = {x for x, c in n.items() if c > limits.line_docs and c > limits.line_share * len(own)}
    out = []
    for d, t, s in rows:
        b = base(t)
        lost = sum(len(x.split(" ")) for x in map(normal, t.split("\n")) if x in bad[s])
        out.append((d, *b, not b[-1] and lost <= limits.max_lost_share * b[0], lost))
    return fx.ordered(out)


def check(df, limits):
    got = fx.ordered(tuple(r) for r in quality.quality(df, limits).drop("host", "key").collect())
    assert got == brute([(r["doc_id"], r["text"] or "", r["source"]) for r in df.select("doc_id", "text", "source").collect()], limits)


def test_documents(spark):
    check(fx.documents(spark), QualityLimits())
    check(fx.documents(spark).selectExpr("doc_id", "text", "'one' as source"), QualityLimits(line_docs=1, line_share=0.0, max_lost_share=0.2))


def test_awkward(spark):
    check(fx.awkward(spark), QualityLimits(line_docs=1, line_share=0.1, max_lost_share=0.05))


def test_empty(spark):
    assert quality.quality(fx.empty(spark)).count() == 0
    assert quality.keep_good(fx.empty(spark)).count() == 0


def test_keep_and_strip(spark):
    shared = "a line that every document of this host has"
    letters = lambda n: "".join("abcdefghij"[int(c)] for c in str(n))
    body = lambda i: " ".join(f"{letters(i)}z{letters(k)}" for k in range(30))
    rows = [(i, f"{body(i)}\n{shared}" if i else "\n".join([shared] * 3), "en", "a") for i in range(40)]
    df = spark.createDataFrame(rows, fx.SCHEMA).selectExpr("*", "1 as key", "2 as host")
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(1, 40))
    stripped = {r["doc_id"]: r["text"] for r in quality.strip_lines(df).collect()}
    assert stripped[5] == body(5) and stripped[0] == ""
