"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A seed is the hash of the words at a mask's marked places; the other places may
differ. The default masks together hit every run of 13 words in which 2 or fewer
differ, wherever they are. Seeds of documents that occur in the benchmark are
verified around the hit: some run of `window` words that holds the hit must agree
in at least `agree` words, place by place. Items of fewer than `agree` but at least
`least_words` words are looked for whole, by a mask without gaps of their length.

The benchmark's seeds reach the scan as a bitmap, whose size follows their number
up to a bound; what passes it is joined on the seed, by a plan that follows the
measured sizes.

Words are lower-cased runs of letters and digits. Places beyond either end count
as different. Items of fewer than least_words words never match: they would meet
clean documents by chance. Null texts have no words; null ids are reported as
null. Repeated rows are reported once. Texts are named by two 64-bit hashes. Extra
columns are not read, whatever their names; an empty table on either side gives no
rows. Texts of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscreen.llm.common import carried, fixed_bits, held, in_bitmap, literal_bitmap, stored

MASKS = ("11101011", "110100111")
WINDOW, AGREE, LEAST_WORDS = 13, 11, 5
#: Beyond some 500,000 benchmark words the bitmap lets most seeds through, and the join does the work.
MOST_BITS = 1 << 20


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(mask: str, number: int) -> Column:
    """Seeds of the array __h under a mask."""
    places = ", ".join(f"__h[i + {k}]" for k, c in enumerate(mask) if c == "1")
    return F.expr(f"if(size(__h) < {len(mask)}, cast(array() as array<bigint>), transform(sequence(0, size(__h) - {len(mask)}), i -> xxhash64({number}, {places})))")


def around(position: str, mask: str, window: int) -> str:
    """SQL: the words in reach of runs that hold the hit; null beyond the ends."""
    reach = window - len(mask)
    return f"transform(sequence({position} - {reach}, {position} + {window - 1}), k -> get(__h, k))"


def text_keys() -> tuple[Column, Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64(text).alias("key"), F.xxhash64(F.lit(1), text).alias("key2")


def seed_rows(texts: DataFrame, ids: list[str], masks: list[tuple[int, str, int]], keep: str = "true") -> DataFrame:
    """ids, mask, seed, position, words around it, for each seed of __h that keep (SQL over `seed`) lets through. masks: number, places, window."""
    out = None
    for number, mask, window in masks:
        rows = held(texts, {"__s": seeds(mask, number)})
        test = keep.replace("seed", "__s[i]")
        rows = held(rows, {"__at": F.expr(f"if(size(__s) = 0, cast(array() as array<int>), filter(sequence(0, size(__s) - 1), i -> {test}))")})
        rows = rows.select(*ids, "__h", "__s", F.explode("__at").alias("position"))
        rows = rows.select(*ids, F.lit(number).alias("mask"), F.expr("__s[position]").alias("seed"), "position", F.expr(around("position", mask, window)).alias("words"))
        out = rows if out is None else out.unionByName(rows)
    return out


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, window: int = WINDOW, agree: int = AGREE, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, key, key2 (the text's hashes), item_id, first_word, n_hits, best: verified overlaps by document and item."""
    items = held(benchmark.select("item_id", F.col("text").alias("__t")), {"__h": word_hashes(F.col("__t"))})
    size = F.size("__h")
    short = sorted(r["n"] for r in items.filter((size >= least_words) & (size < agree)).select(size.alias("n")).distinct().collect())  # below agree
    long_masks = [(k, m, window) for k, m in enumerate(masks)]
    short_masks = [(len(masks) + n, "1" * n, n) for n in short]
    wanted = seed_rows(items.filter(size >= agree), ["item_id"], long_masks)
    for m in short_masks:
        wanted = wanted.unionByName(seed_rows(items.filter(size == m[2]), ["item_id"], [m]))
    wanted = stored(wanted.distinct(), "seeds")
    bits = fixed_bits(wanted.count(), 128, most=MOST_BITS)
    bitmap = literal_bitmap(wanted, "seed", bits)
    texts = docs.select("doc_id", *text_keys(), F.col("text").alias("__t"))
    texts = held(texts, {"__h": word_hashes(F.col("__t"))}).drop("__t")
    found = seed_rows(texts, ["doc_id", "key", "key2"], long_masks + short_masks, in_bitmap(bitmap, "seed", bits))
    item = wanted.select("item_id", F.col("seed").alias("s2"), F.col("mask").alias("m2"), F.col("words").alias("w2"))
    both = found.join(item, (found["seed"] == item["s2"]) & (found["mask"] == item["m2"]))
    same = F.zip_with("words", "w2", lambda a, b: F.when(a == b, F.lit(1)).otherwise(F.lit(0)))
    widths = "case mask " + " ".join(f"when {k} then {w}" for k, _, w in long_masks + short_masks) + " end"
    both = held(both.select("doc_id", "key", "key2", "item_id", "position", "mask", "words", "w2"), {"same": same, "w": F.expr(widths)})
    runs = F.expr("transform(sequence(0, size(same) - w), o -> aggregate(slice(same, o + 1, w), 0, (t, x) -> t + x))")
    both = both.withColumn("best", F.array_max(runs)).filter(F.col("best") >= F.least(F.lit(agree), F.col("w")))
    out = both.groupBy("doc_id", "key", "key2", "item_id").agg(F.min("position").cast("bigint").alias("first_word"), F.count("*").alias("n_hits"), F.max("best").cast("bigint").alias("best"))
    return out.select("doc_id", "key", "key2", "item_id", "first_word", "n_hits", "best")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of docs without a verified overlap, with all their columns. The verdict belongs to the text, so it needs no id."""
    bad = overlaps(docs, benchmark, **options).select(F.col("key").alias("bad"), F.col("key2").alias("bad2")).distinct()
    key, key2 = text_keys()
    rows = carried(docs, key=key, key2=key2)
    return rows.join(bad, (F.col("key") == F.col("bad")) & (F.col("key2") == F.col("bad2")), "left_anti").select("row.*")
