"""The pipeline's quality stage: documents rejected and lines removed."""

import corpus_pipeline


def test_frequent_lines_are_removed(spark):
    name = lambda n: "".join("abcdefghij"[int(c)] for c in str(n))  # noqa: E731 -- digits are alike to the rules
    words = lambda d: " ".join(f"{name(d)}x{name(i)}" for i in range(30))
    line = "share this page with all your friends"
    rows = [(d, f"{words(d)}\n{line}", "a", 7) for d in range(40)] + [(100 + d, f"{words(100 + d)}\n{line}", "b", 7) for d in range(5)] + [(200, line, "a", 7), (201, None, "a", 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars int")
    out = corpus_pipeline.quality_stage(spark, docs, "")
    assert out.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    want = {d: (words(d), len(words(d))) for d in range(40)} | {100 + d: (f"{words(100 + d)}\n{line}", 7) for d in range(5)}
    assert got == want
