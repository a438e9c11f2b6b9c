"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Whole passes over a source are taken by every document. The rest of a target is
drawn without replacement: a tree of hypergeometric draws splits the source's
quota of words among output shards, in proportion to the words each shard holds,
and every shard takes its quota from permuted, disjoint blocks of its own
documents. Only word totals per source and shard meet on one machine; their
number is set by sources times shards, not by documents.
"""

from __future__ import annotations

import math
from decimal import Decimal, localcontext

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscreen.llm.common import WORD_GAP, carried, ship_code, stored

WEIGHTS = (3, 1, 2)
HALF_LN_TAU = Decimal("0.91893853320467274178032973640561763986139747363778")
#: Documents of a shard, on average, at least which its one task can hold many times over.
SHARD_DOCS = 1_000_000


def word_count(text: Column) -> Column:
    """Runs of non-space; null has none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{WORD_GAP}|{WORD_GAP}$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WORD_GAP))).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, target for every source of (source, size).

    Sources by code point, null last, weigh as in weights, repeating. Filling
    up: target = min(cap * size, level * weight), with the level at which the
    targets sum to share of all sizes (or to all caps, if those are less).
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    per = per.withColumn("w", F.get(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights)).cast("double"))
    per = per.withColumn("most", cap * F.col("source_size"))
    by_level = Window.orderBy(F.col("most") / F.col("w"), F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    # The first source that does not reach its cap at the level of those from it on fixes the level; later ones give lower levels.
    level = F.greatest(left, F.lit(0.0)) / F.sum("w").over(after)
    per = per.withColumn("level", F.when(level * F.col("w") <= F.col("most"), level))
    per = per.withColumn("level", F.max("level").over(everything))
    filled = F.least(F.col("most"), F.coalesce(F.col("level") * F.col("w"), F.col("most")))
    return per.select("source", "source_size", filled.alias("target"))


EXACT = 10**9  # the generator's range


def log_factorial(n: int) -> Decimal:
    """ln n! to more places than any quota has digits: Stirling's series beyond small n."""
    if n < 256:
        return Decimal(math.factorial(n)).ln()
    x = Decimal(n)
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7) + 1 / (1188 * x**9)
    return (x + Decimal("0.5")) * x.ln() - x + HALF_LN_TAU + series


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Draws of good among n from good + bad, of the exact law at any size.

    Beyond the generator's range by ratio of uniforms: points under the law's
    square root, seen from its mode, are drawn from a box that holds them all.
    """
    total = good + bad
    if not n or not good or not bad or n == total:
        return n if not bad else good if n == total else 0
    if total < EXACT:
        return int(rng.hypergeometric(good, bad, n))
    low, high = max(0, n - bad), min(good, n)
    mean = n * (good / total)
    spread = math.sqrt(mean * (bad / total) * ((total - n) / (total - 1)) + 0.5)
    mode = min(max((n + 1) * (good + 1) // (total + 2), low), high)
    with localcontext() as context:
        context.prec = 60
        weight = lambda k: -sum(map(log_factorial, (k, good - k, n - k, bad - n + k)))
        top = weight(mode)
        while True:
            u, v = 1 - rng.random(), rng.random()
            # Stadlober's box: sqrt(8 / e) spreads wide, and a little more for whole numbers.
            k = mode + math.floor(0.5 + mean - math.floor(mean) + (v - 0.5) / u * (math.sqrt(8 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)))
            if low <= k <= high and 2 * math.log(u) <= float(weight(k) - top):
                return k


def split_quota(held: np.ndarray, quota: int, seed: int) -> np.ndarray:
    """Quota of each shard: halve the shards, draw the left half's part, go on in both halves."""
    out = np.zeros(len(held), dtype=np.int64)
    sums = np.concatenate([[0], np.cumsum(held)])
    todo = [(0, len(held), int(quota), 1)]
    while todo:
        lo, hi, q, node = todo.pop()
        if hi - lo == 1:
            out[lo] = q
        elif q:
            mid = (lo + hi) // 2
            left, right = int(sums[mid] - sums[lo]), int(sums[hi] - sums[mid])
            x = hypergeometric(np.random.default_rng([seed, node & (2**63 - 1)]), left, right, q)
            todo += [(lo, mid, x, 2 * node), (mid, hi, q - x, 2 * node + 1)]
    return out


def draw_ranges(sizes: np.ndarray, keys: np.ndarray, quota: int, block: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and end of each range of words taken, in each document's order: documents in permuted order are cut into blocks, permuted blocks are taken up to the quota, the last in part."""
    total = int(sizes.sum())
    if quota <= 0 or not total:
        return (np.zeros(0, dtype=np.int64),) * 3
    order = np.lexsort((np.arange(len(keys)), keys))
    ends = np.cumsum(sizes[order])
    n = -(-total // block)
    picked = np.random.default_rng([seed, n]).permutation(n)
    lengths = np.minimum((picked + 1) * block, total) - picked * block
    reached = np.cumsum(lengths)
    last = int(np.searchsorted(reached, quota))
    picked, lengths = picked[: last + 1], lengths[: last + 1].copy()
    lengths[-1] -= max(0, int(reached[last]) - quota)
    by_start = np.argsort(picked, kind="stable")
    starts = picked[by_start] * block
    stops = starts + lengths[by_start]
    # Blocks that touch are one range; ranges are cut where documents end.
    fresh = np.concatenate([[True], starts[1:] != stops[:-1]])
    starts, stops = starts[fresh], stops[np.concatenate([fresh[1:], [True]])]
    begins = ends - sizes[order]
    low, high = np.searchsorted(ends, starts, side="right"), np.searchsorted(begins, stops, side="left")
    n = high - low
    which = np.repeat(np.arange(len(starts)), n)
    doc = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + low[which]
    lo, hi = np.maximum(starts[which], begins[doc]), np.minimum(stops[which], ends[doc])
    some = hi > lo
    doc, lo, hi = doc[some], lo[some], hi[some]
    return order[doc], lo - begins[doc], hi - begins[doc]


def draw_blocks(sizes: np.ndarray, keys: np.ndarray, quota: int, block: int, seed: int) -> np.ndarray:
    """Words taken of each document: the lengths of its ranges."""
    taken = np.zeros(len(sizes), dtype=np.int64)
    docs, lo, hi = draw_ranges(sizes, keys, quota, block, seed)
    np.add.at(taken, docs, hi - lo)
    return taken


def row_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id").cast("bigint"), "text")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, shards: int | None = None, block: int = 64, seed: int = 7, ranges: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, shard, rank, key; with ranges also starts and stops, the words of the part of a time: rank orders a shard's documents after its local shuffle, key is row_key(seed).

    shards: output shards; by default 256, or as many as keep SHARD_DOCS documents
    in each. Nulls: a null text has size 0 and is taken 0 times, null sources form
    the last source, null ids hash as such. Repeated rows are separate documents.
    Taken words of a source sum to its rounded target. With fewer sources than
    weights the first weights are used; no documents give no rows. Extra columns
    are not read, whatever their names. Texts of any length are counted whole.
    """
    ship_code(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), row_key(seed).alias("key"))
    rows = stored(rows, "sizes")
    shards = shards or max(256, -(-rows.count() // SHARD_DOCS))
    rows = rows.withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))
    goals = stored(targets(rows, weights, share, cap), "targets")
    held = rows.groupBy("source", "shard").agg(F.sum("size").alias("held"))
    held = held.join(goals, held["source"].eqNullSafe(goals["source"])).select(held["source"], "shard", "held", "source_size", "target")

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        """One source: at most a row for each shard."""
        pdf = pdf.sort_values("shard")
        size, goal = int(pdf["source_size"].iloc[0]), round(float(pdf["target"].iloc[0]))
        passes, rest = divmod(goal, size) if size else (0, 0)
        name = pdf["source"].iloc[0]
        own = int.from_bytes(str(name).encode("utf-8", "surrogatepass")[:64], "big") + (name is None)
        parts = split_quota(pdf["held"].to_numpy(np.int64), rest, (seed * 1_000_003 + own) % 2**63)
        return pdf.assign(passes=passes, quota=parts)[["source", "shard", "source_size", "target", "passes", "quota"]]

    schema = "source string, shard int, source_size bigint, target double, passes bigint, quota bigint"
    quotas = stored(held.groupBy("source").applyInPandas(plan, schema), "quotas")
    side = quotas.select(F.col("source").alias("s2"), F.col("shard").alias("h2"), "source_size", "target", "passes", "quota")
    # pandas has no whole numbers with nulls: ids travel as a number and a mark.
    rows = rows.select("source", "size", "key", "shard", F.coalesce("doc_id", F.lit(0)).alias("number"), F.col("doc_id").isNotNull().alias("named"))
    full = rows.join(side, (rows["shard"] == side["h2"]) & rows["source"].eqNullSafe(side["s2"])).drop("s2", "h2")

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        """One shard, all its sources."""
        pdf = pdf.sort_values(["key", "number", "size"], kind="stable").reset_index(drop=True)
        shard = int(pdf["shard"].iloc[0])
        sizes, keys = pdf["size"].to_numpy(np.int64), pdf["key"].to_numpy(np.int64)
        taken = pdf["passes"].to_numpy(np.int64) * sizes
        starts, stops = ([[] for _ in sizes] for _ in range(2))
        codes, names = pd.factorize(pdf["source"], use_na_sentinel=False)
        for i in range(len(names)):
            at = np.flatnonzero(codes == i)
            drawn = draw_ranges(sizes[at], keys[at], int(pdf["quota"].iloc[at[0]]), block, (seed * 31 + shard) * 65_537 + int(sizes[at].sum()) % 65_537)
            np.add.at(taken, at[drawn[0]], drawn[2] - drawn[1])
            if ranges:
                for d, lo, hi in zip(at[drawn[0]].tolist(), drawn[1].tolist(), drawn[2].tolist()):
                    starts[d].append(lo)
                    stops[d].append(hi)
        rank = np.random.default_rng([seed, shard]).permutation(len(pdf))
        pdf = pdf.assign(taken=taken, rank=rank)
        return (pdf.assign(starts=starts, stops=stops) if ranges else pdf)[names_out]

    schema = "number bigint, named boolean, source string, size bigint, source_size bigint, target double, taken bigint, shard int, rank bigint, key bigint" + (", starts array<bigint>, stops array<bigint>" if ranges else "")
    names_out = [c.split()[0] for c in schema.split(", ")]
    out = full.groupBy("shard").applyInPandas(draw, schema)
    return out.select(F.when(F.col("named"), F.col("number")).alias("doc_id"), *names_out[2:])


def apply_mix(docs: DataFrame, seed: int = 7, **options) -> DataFrame:
    """docs as the mix takes them: a row for each whole time, and one with the words drawn for a part of a time.

    A part has exactly the ranges of words the mix draws, as they stand in the
    text, each range on a line of its own, and its length in n_chars if docs has
    that. Rows of one id, text and source are told apart by number, so each
    has a draw of its own.
    """
    own = mix(docs, seed=seed, ranges=True, **options).filter("taken > 0")
    drawn = F.struct("rank", F.expr("taken div size").alias("times"), "starts", "stops", (F.col("taken") % F.col("size")).alias("rest"))
    own = own.groupBy(F.xxhash64("key", "source").alias("k2")).agg(F.array_sort(F.collect_list(drawn)).alias("every"))
    key = F.xxhash64(row_key(seed), docs["source"].cast("string"))
    rows = carried(docs, k=key)
    rows = rows.withColumn("i", F.row_number().over(Window.partitionBy("k").orderBy("k")))
    rows = rows.join(own, F.col("k") == F.col("k2")).withColumn("d", F.get("every", F.col("i") - 1)).filter("d is not null")
    parts = F.expr("array_append(array_repeat(false, cast(d.times as int)), true)")
    rows = rows.select("row", "d", F.explode(parts).alias("part")).filter(~F.col("part") | (F.col("d.rest") > 0))
    # Each word with the white space behind it.
    words = F.regexp_extract_all("row.text", F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), F.lit(1))
    cut = lambda w: F.zip_with("d.starts", "d.stops", lambda lo, hi: F.regexp_replace(F.array_join(F.slice(w, (lo + 1).cast("int"), (hi - lo).cast("int")), ""), WORD_GAP + "$", ""))
    rows = rows.withColumn("cut", F.when(F.col("part"), F.get(F.transform(F.array(words), lambda w: F.array_join(cut(w), "\n")), F.lit(0))))
    new = {"text": F.col("cut"), "n_chars": F.length("cut").cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    return rows.select(*[F.when(F.col("part"), new[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])
