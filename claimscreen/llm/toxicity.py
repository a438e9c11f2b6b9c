"""Toxicity by compression distance with two zstandard dictionaries.

A window (a word of the text, by default) is compressed twice: against a
dictionary of toxic text and against one of ordinary text. It counts as toxic
where the toxic dictionary brings it to at most `most` bytes and to at least
`margin` fewer than the ordinary one. The score is the calibrated share of toxic
documents among those with as many toxic windows.

zstandard spends 3 bytes and more on a match, too many to tell short words from
spelled-out ones, so text is widened first: each byte stands as four, by a fixed
table. A word of the dictionary is then one match, any other is several.

Dictionaries from zstandard's own trainer were tried and separate the classes less
well (see the README), as toxic documents differ from others in a few words only.

Training reads labelled rows outside of the held-out fold only, and of these at
most max_rows, those of the smallest hashed ids: a bounded sample, stored once. One
half makes the dictionaries: the toxic one of the passages (words) that occur in
toxic documents `ratio` times as often as in others, the ordinary one of the most
frequent words of others, dict_bytes of text each. The other half calibrates most,
margin and the scores. Words are counted distributed; at most dict_bytes of words a
class and a histogram come to the driver. Scoring reads every whole text once and
shuffles nothing.

Nulls: a null text scores as an empty one; rows with null labels are not used; a
null id is in no fold and not held out. Without labels of both kinds every score
is the share of toxic labels (0 without labels). Repeated rows score the same, and
an id with several labels is toxic if one is. Extra columns are not read, whatever
their names; no documents give no rows. Texts of any length are scored whole.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscreen.llm.common import WORD_GAP, ship_code, stored

EDGES = ".,;:!?\"'()[]|"
GRID = tuple((most, margin) for most in range(9, 19) for margin in (1, 2, 3, 4, 6, 8))
TOP = 40


@dataclass(frozen=True)
class Model:
    toxic: tuple[str, ...]
    ordinary: tuple[str, ...]
    most: int
    margin: int
    scores: tuple[float, ...]  # by number of toxic windows; the last stands for more


def widening(width: int = 4, seed: int = 5) -> list[bytes]:
    rng = random.Random(seed)
    return [bytes(rng.randrange(256) for _ in range(width)) for _ in range(256)]


CODES = widening()


def widened(data: bytes) -> bytes:
    return b"".join([CODES[c] for c in data])


def compressor(words: tuple[str, ...]) -> zstandard.ZstdCompressor:
    """The best words last, where matches are nearest."""
    content = widened((" " + " ".join(reversed(words)) + " ").encode())
    settings = zstandard.ZstdCompressionParameters.from_level(9, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False, min_match=5)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)


@lru_cache(maxsize=4)
def measurer(toxic: tuple[str, ...], ordinary: tuple[str, ...], keep: int = 500_000):
    """Text to one (toxic bytes, ordinary bytes) row a window. Lengths of recent words are kept."""
    a, b = compressor(toxic), compressor(ordinary)
    known: dict[bytes, tuple[int, int]] = {}
    edges = EDGES.encode()

    def measure(text: str) -> np.ndarray:
        out = []
        for piece in text.lower().encode().split():
            pair = known.get(piece)
            if pair is None:
                window = widened(b" " + piece.strip(edges) + b" ")
                pair = len(a.compress(window)), len(b.compress(window))
                if len(known) >= keep:
                    known.clear()
                known[piece] = pair
            out.append(pair)
        return np.array(out, dtype=np.int32).reshape(-1, 2)

    return measure


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def words(text: Column) -> Column:
    inner = "".join("\\" + c for c in EDGES)
    cut = F.transform(F.split(F.lower(text), WORD_GAP), lambda w: F.regexp_replace(w, f"^[{inner}]+|[{inner}]+$", ""))
    return F.array_distinct(F.filter(cut, lambda w: F.length(w) > 2))


def chosen(counts: DataFrame, order: list[Column], dict_bytes: int) -> tuple[str, ...]:
    """The first words by order, up to dict_bytes of text; each takes 4 bytes at least."""
    out, size = [], 0
    for r in counts.orderBy(*order).limit(dict_bytes // 4).collect():
        size += len(r["word"].encode()) + 1
        if size > dict_bytes:
            break
        out.append(r["word"])
    return tuple(out)


def fit(docs: DataFrame, labels: DataFrame, dict_bytes: int = 16_384, ratio: float = 15.0, least: int = 3, max_rows: int = 20_000) -> Model:
    """Dictionaries from one half of the labelled rows, thresholds and scores from the other."""
    ship_code(docs.sparkSession)
    marks = labels.filter("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("l_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.filter(~held_out(F.col("l_id"))).groupBy("l_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.orderBy(F.xxhash64(F.lit("sample"), "l_id"), "l_id").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(marks), F.col("doc_id") == F.col("l_id"))  # max_rows ids at most
    rows = stored(rows.select("doc_id", "text", "toxic", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).alias("half")), "labelled")
    first, second = rows.filter("half = 0"), rows.filter("half = 1")
    size = {r["toxic"]: r["n"] for r in first.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_other = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_other:
        share = rows.agg(F.avg("toxic").alias("s")).first()["s"]
        return Model((), (), 0, 0, (float(share or 0.0),))
    counts = first.select("toxic", F.explode(words(F.col("text"))).alias("word")).groupBy("word").agg(F.sum("toxic").alias("t"), F.count_if(F.col("toxic") == 0).alias("o"))
    marked = counts.filter((F.col("t") >= least) & (F.col("t") / n_toxic >= ratio * (F.col("o") + 0.5) / n_other) & (F.length("word") < 64))
    toxic = chosen(marked, [F.desc("t"), F.col("word")], dict_bytes)
    ordinary = chosen(counts.filter((F.col("o") > 0) & (F.length("word") < 64)), [F.desc("o"), F.col("word")], dict_bytes)

    @F.pandas_udf("array<int>")
    def windows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        measure = measurer(toxic, ordinary)
        for texts in batches:
            yield pd.Series([[int(((m[:, 0] <= c) & (m[:, 1] - m[:, 0] >= d)).sum()) for c, d in GRID] for m in map(measure, texts)])

    each = second.select("toxic", F.posexplode(windows("text")).alias("g", "k"))
    table = each.groupBy("g", F.least("k", F.lit(TOP)).alias("k"), "toxic").agg(F.count("*").alias("n"))
    found = np.zeros((len(GRID), TOP + 1, 2), dtype=np.float64)
    for r in table.collect():  # at most grid x (TOP + 1) x 2 rows
        found[r["g"], r["k"], r["toxic"]] = r["n"]
    best = max(range(len(GRID)), key=lambda g: (separation(found[g]), -g))
    return Model(toxic, ordinary, *GRID[best], calibrated(found[best]))


def separation(table: np.ndarray) -> float:
    """Chance that a toxic document has more toxic windows than another one."""
    n, t = table[:, 0], table[:, 1]
    below = np.concatenate([[0], np.cumsum(n)[:-1]])
    return float((t * (below + n / 2)).sum() / max(1.0, n.sum() * t.sum()))


def calibrated(table: np.ndarray) -> tuple[float, ...]:
    """Share of toxic documents by number of windows, smoothed and made to rise by pooling neighbours that fall."""
    prior = table[:, 1].sum() / max(1.0, table.sum())
    blocks: list[list[float]] = []
    for other, toxic in table:
        blocks.append([toxic + prior, toxic + other + 1.0, 1])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            t, n, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t, blocks[-1][1] + n, blocks[-1][2] + k]
    return tuple(float(t / n) for t, n, k in blocks for _ in range(int(k)))


def score(docs: DataFrame, model: Model, cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic_windows of every row."""
    ship_code(docs.sparkSession)
    toxic, ordinary, most, margin = model.toxic, model.ordinary, model.most, model.margin

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        measure = measurer(toxic, ordinary) if toxic else None
        for texts in batches:
            yield pd.Series([int(((m[:, 0] <= most) & (m[:, 1] - m[:, 0] >= margin)).sum()) if measure else 0 for m in (map(measure, texts) if measure else texts)], dtype="int32")

    rows = docs.select("doc_id", count(F.coalesce("text", F.lit(""))).alias("k"))
    known = F.array(*map(F.lit, model.scores))
    rows = rows.withColumn("score", F.get(known, F.least("k", F.lit(len(model.scores) - 1))))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), F.col("k").alias("n_toxic_windows"))
