"""Token counts, decontamination, line dedup, toxicity and the pipeline."""

import random
import time
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimscreen.llm import decontaminate, lines, tokencount, toxicity
from tests.llm import fixtures as fx

BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def brute_counts(text, sections, rule):
    encoding, lengths = tokencount.encoder(BPE, public_tokenizers.PATTERN)
    owner = []
    for i, ch in enumerate(text):
        own = [k for k, (s, e) in enumerate(sections) if s <= i < e]
        owner += [own[-1] if own else -1] * len(ch.encode())
    counts, at = {}, 0
    for token in encoding.encode_ordinary(text):
        own = owner[at : at + int(lengths[token])]
        at += int(lengths[token])
        to = own[0] if rule == "first" else max(dict.fromkeys(own), key=lambda k: (own.count(k), -own.index(k)))
        counts[to] = counts.get(to, 0) + 1
    return counts


@pytest.mark.parametrize("rule", ["most", "first"])
def test_token_counts(rule):
    encoding, lengths = tokencount.encoder(BPE, public_tokenizers.PATTERN)
    rng = random.Random(3)
    for text in ["", "one two\n\n three  \n", "naïve 中文 \U0001f600\U0001f600 words and words " * 4]:
        cuts = sorted(rng.sample(range(len(text) + 1), min(5, len(text))))
        sections = list(zip(cuts, cuts[1:]))[::1]
        rows = tokencount.attribute(text, [(k, s, e) for k, (s, e) in enumerate(sections)], encoding.encode_ordinary(text), lengths, rule)
        got = {-1 if r[0] is None else r[0]: r[3] for r in rows if r[3]}
        assert got == brute_counts(text, sections, rule)


def test_token_counts_of_lines(spark):
    encoding, _ = tokencount.encoder(BPE, public_tokenizers.PATTERN)
    df = fx.awkward(spark)
    rows = tokencount.token_counts(df, BPE, public_tokenizers.PATTERN).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max("doc_tokens").alias("m")).collect()
    want = {}
    for d, t in fx.pairs(df):
        want[d] = want.get(d, 0) + len(encoding.encode_ordinary(t))
    assert {r["doc_id"]: r["n"] for r in rows} == want
    table = spark.createDataFrame([(7, 0, 0, 5), (7, 1, 5, 10_000)], "doc_id bigint, section int, start bigint, end bigint")
    joined = tokencount.with_sections(fx.awkward(spark).select("doc_id", "text"), table)
    assert tokencount.token_counts(joined, BPE, public_tokenizers.PATTERN).filter("doc_id = 7 and section is not null").count() == 2
    assert tokencount.token_counts(df.limit(0), BPE, public_tokenizers.PATTERN).collect() == []


def test_many_lines():
    """A section for each of 100,000 lines, in time that follows their number."""
    encoding, lengths = tokencount.encoder(BPE, public_tokenizers.PATTERN)
    text, start = "a line\n" * 100_000, time.time()
    spans = tokencount.line_spans(text)
    rows = tokencount.attribute(text, spans, encoding.encode_ordinary(text), lengths, "most")
    assert len(spans) == 100_001 and len(rows) == 100_001 and sum(r[3] for r in rows) == len(encoding.encode_ordinary(text)) and time.time() - start < 20


def test_masks_hit_any_two_substitutions():
    for i in range(13):
        for j in range(13):
            assert any(all(o + k not in (i, j) for k, c in enumerate(m) if c == "1") for m in decontaminate.MASKS for o in range(13 - len(m) + 1))


def test_decontaminate(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    item = [word() for _ in range(30)]
    other = lambda n: [word() for _ in range(n)]
    changed = [w if i % 7 else word() for i, w in enumerate(item)]
    texts = {1: other(50), 2: [*other(9), *item, *other(9)], 3: [*other(9), *changed, *other(5)], 4: [*other(9), *item[:9], *other(20)], 5: item[:11]}
    docs = spark.createDataFrame([*[(d, " ".join(t).title() + ".", "x") for d, t in texts.items()], (6, None, "x"), (None, " ".join(item), "x")], "doc_id bigint, text string, key string")
    bench = spark.createDataFrame([(10, " ".join(item)), (11, "too short"), (12, None)], "item_id bigint, text string")
    got = decontaminate.overlaps(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in got) == [(0, 10), (2, 10), (3, 10), (5, 10)]
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 6]
    assert decontaminate.overlaps(docs, bench.limit(0)).count() == 0 and decontaminate.overlaps(docs.limit(0), bench).count() == 0


def test_lines(spark):
    rng = random.Random(2)
    body = [" ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(40)) for _ in range(30)]
    near = body[0].replace(body[0].split()[3], "zzzzz")
    docs = spark.createDataFrame([(1, f"{body[0]}\n{body[1]}\nshort one", "k"), (2, f"{body[2]}\n{body[1].upper()}\nshort one", "k"), (3, near, "k"), (4, None, "k"), (5, "", "k"), (None, body[5], "k"), (6, body[5], "k")], "doc_id bigint, text string, key string")
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in lines.line_counts(docs).collect()}
    assert got == {1: (3, 0), 2: (3, 2), 3: (1, 1), 4: (1, 0), 5: (1, 0), None: (1, 0), 6: (1, 1)}
    out = lines.dedup_lines(docs)
    assert out.columns == docs.columns and {r["doc_id"]: r["text"] for r in out.collect()}[2] == body[2]
    assert lines.line_counts(docs.limit(0)).collect() == []


def test_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels)
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert len(rows) == docs.count()
    for d, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    pairs = [(rows[r["doc_id"]]["score"], r["toxic"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    bad, good = ([s for s, t in pairs if t == k] for k in (1, 0))
    assert sum((x > y) + (x == y) / 2 for x in bad for y in good) / (len(bad) * len(good)) > 0.7
    assert toxicity.score(fx.awkward(spark), model).count() == fx.awkward(spark).count()
    bare = toxicity.fit(docs, labels.limit(0))
    assert bare.scores == (0.0,) and toxicity.score(fx.empty(spark), bare).collect() == []


def test_pipeline(spark):
    docs = fx.documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, fx.SF)
        assert kept.columns == docs.columns and 0 < kept.count() <= 2 * docs.count()
        docs = kept
    assert corpus_pipeline.run(spark, fx.SF).count() > 0
