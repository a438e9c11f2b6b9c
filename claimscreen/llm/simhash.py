"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most r bits apart share a point within ceil(r / 2) bits of
both. Every distinct fingerprint emits all points of that ball; fingerprints
meeting on a point are verified and linked, and linked ones form components.

Null texts count as empty and have fingerprint zero; null ids are the smallest
of their component only when alone in it. Repeated rows share a fingerprint.

The pipeline's stage (keep_one) has a contract in Jaccard similarity, which no
SimHash distance decides: SimHash balls give its first links, prefixes of shingle
sets the rest. Texts are named there by a 64-bit hash.

Ties: of equal ids or texts no row is preferred. Extra columns are not read by
near_duplicates and carried along by keep_one, whatever their names. No documents
give no rows. Texts of any length are taken whole, their shingles in portions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from claimscreen.llm.common import carried, forget, held, id_and_text, in_bitmap, one_row_bitmap, partitions, possibly_among, release, ship_code, stored, trimmed, words_of
from claimscreen.llm.components import components

SEED = 42
CHUNK = 1 << 16
#: Cells of a set's bitmap, by which unlike pairs are told apart before whole sets are compared.
CELLS = 4096
#: Cells of the small bitmap that is compared before it: a cell is set where an odd number of elements falls.
PARITY = 512
#: Shingles in this many of the texts sampled, one in SAMPLE, come last in the order of a set.
COMMON, SAMPLE = 4, 16
#: Groups of more texts are compared in rounds: of those left apart, one in so many is compared with all others.
CROWD, RATES = 64, (64, 8, 1)


def fingerprint(text: str, shingle: int = 3, seed: int = SEED) -> int:
    """Bit i is set when over half of the shingles' XXH64 have it."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, n, CHUNK):
        some = words[start : min(start + CHUNK, n) + shingle - 1]
        parts = zip(*[some[k:] for k in range(shingle)]) if len(some) >= shingle else [some]
        h = np.fromiter((xxh64_intdigest(b" ".join(p), seed) for p in parts), dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = SEED) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), key (the text's hash). Only texts go to Python."""

    ship_code(docs.sparkSession)
    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from trimmed(pd.Series(np.array([fingerprint(t, shingle, seed) for t in texts], dtype=np.uint64).view(np.int64)) for texts in batches)

    return id_and_text(docs).select("doc_id", of("text").alias("fp"), F.xxhash64("text").alias("key"))


def ball(radius: int) -> list[int]:
    """Masks of up to radius bits, as signed longs."""
    sets = (c for k in range(radius + 1) for c in combinations(range(64), k))
    return [int(np.array(sum(1 << i for i in c), dtype=np.uint64).view(np.int64)) for c in sets]


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """a, b: verified links that connect all distinct fingerprints at most max_bits apart.

    A point is met by at most as many fingerprints as its ball has points, so
    groups are bounded by construction. Where the ball's radius is half an even
    max_bits, all that meet are within reach of each other and a star from the
    smallest stands for all pairs; else pairs are verified one by one.
    """
    # Few bytes here, many rows below: the fingerprints are dealt out again before they multiply.
    n, masks = partitions(fps.sparkSession), F.array(*map(F.lit, ball((max_bits + 1) // 2)))
    dealt = fps.select("fp").distinct().repartition(n, "fp").select("fp", F.posexplode(masks).alias("at", "mask"))
    # A point and the mask's number travel; the fingerprint follows from them.
    coded = dealt.select(F.col("fp").bitwiseXOR(F.col("mask")).alias("point"), F.col("at").cast("tinyint").alias("at") if max_bits <= 2 else "at")
    points = lambda rows: rows.select("point", F.col("point").bitwiseXOR(F.get(masks, F.col("at").cast("int"))).alias("fp"))
    met = points(coded.repartition(n, "point")).groupBy("point").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")
    met = stored(met, "met")
    pairs = met.filter("n = 2").select("a", "b")
    more = stored(met.filter("n > 2").select(F.col("point").alias("p"), "a"), "more")
    crowded = points(possibly_among(coded, "point", more, "p"))
    rest = crowded.join(more, F.col("point") == F.col("p"))
    if max_bits % 2 == 0:
        rest = rest.select("a", F.col("fp").alias("b"))
    else:
        others = crowded.join(more, F.col("point") == F.col("p")).select(F.col("p").alias("p2"), F.col("fp").alias("b"))
        rest = rest.join(others, (F.col("p") == F.col("p2")) & (F.col("fp") < F.col("b"))).select(F.col("fp").alias("a"), "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return pairs.unionByName(rest).filter(near & (F.col("a") != F.col("b"))).distinct()


def near_duplicates(docs: DataFrame, max_bits: int = 2, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id linked directly or through others."""
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    joined = components(links(fps, max_bits)).withColumnRenamed("node", "fp")
    each = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    each = each.join(joined, "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    heads = each.groupBy("root").agg(F.min("least").alias("component_id"))
    named = each.join(heads, "root").select(F.col("fp").alias("named"), "component_id")
    out = fps.join(named, F.col("fp") == F.col("named"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """key, set: hashes of the distinct word shingles of each distinct text (the whole sequence where it is shorter)."""
    rows = held(id_and_text(docs).select(F.xxhash64("text").alias("key"), "text").dropDuplicates(["key"]), {"__h": F.transform(words_of(F.lower("text")), lambda w: F.xxhash64(w))})
    runs = F.expr(f"transform(sequence(0, greatest(size(__h) - {shingle}, 0)), i -> xxhash64({', '.join(f'get(__h, i + {k})' for k in range(shingle))}))")
    return held(rows.select("key", "__h"), {"set": F.array_distinct(runs)}).select("key", "set")


def sketches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    yield from trimmed(map(sketch, batches))


def sketch(sets: pd.Series) -> pd.Series:
    """Two bitmaps, of PARITY and of CELLS cells. Sets differ in at least as many elements as either bitmaps do in cells."""
    out = []
    for own in sets:
        own = np.asarray(own, dtype=np.int64)
        odd = (np.bincount((own >> 20) & (PARITY - 1), minlength=PARITY) & 1).astype(np.uint8)
        cells = np.zeros(CELLS, dtype=np.uint8)
        cells[own & (CELLS - 1)] = 1
        out.append(np.packbits(np.concatenate([odd, cells]), bitorder="little").view("<i8"))
    return pd.Series(out)


def common_bitmap(elements: DataFrame, bits: int) -> DataFrame:
    """One row, __bitmap: which elements e occur often in `elements`, a sample of them.

    Often is COMMON times, or as many times as leaves an eighth of the bits: the
    number of elements that rank as common is bounded, whatever the table holds.
    """
    counts = stored(elements.groupBy("e").agg(F.count("*").alias("c")).filter(F.col("c") >= COMMON), "counts")
    powers = counts.groupBy(F.floor(F.log2("c")).cast("int").alias("p")).agg(F.count("*").alias("n")).collect()  # 64 rows at most
    left, least = bits // 8, COMMON
    for r in sorted(powers, key=lambda r: -r["p"]):
        left -= r["n"]
        if left < 0:
            least = max(COMMON, 2 << r["p"])
            break
    out = one_row_bitmap(counts.filter(F.col("c") >= least), "e", bits)
    forget(counts)
    return out


def rare_first(sets: DataFrame, some: DataFrame, bits: int = 1 << 20) -> DataFrame:
    """sets with each `set` in one order for all, in which elements that are common in `some`, a sample of them, come last.

    Which ones are common is kept in a bitmap of fixed size. The order decides
    how many sets meet, not which pairs are found.
    """
    rows = sets.withColumnRenamed("set", "__s").join(F.broadcast(common_bitmap(some.select(F.explode("set").alias("e")), bits)))
    signed = F.expr(f"transform(__s, e -> if({in_bitmap('__bitmap', 'e', bits)}, e & {2**63 - 1}L, e | shiftleft(1L, 63)))")
    return held(rows, {"set": F.array_distinct(F.sort_array(signed))}).drop("__s", "__bitmap")


def prefix(share: float) -> Column:
    """The first of a `set`: of two sets in one order with that share of either in common, both have one of them."""
    n = F.size("set")
    return F.slice("set", F.lit(1), n - F.ceil(F.lit(share) * n - 1e-9).cast("int") + 1)


def ordered_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """key, set, n, odd, sketch: shingle_sets with common shingles last, their sizes and bitmaps."""
    ship_code(docs.sparkSession)
    some = shingle_sets(docs.filter(F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(SAMPLE)) == 0), shingle)
    rows = rare_first(shingle_sets(docs, shingle), some)
    release(docs.sparkSession)
    rows = rows.select("key", "set", F.size("set").alias("n"), F.pandas_udf(sketches, "array<bigint>")("set").alias("s"))
    return stored(rows.select("key", "set", "n", F.slice("s", 1, PARITY // 64).alias("odd"), F.slice("s", PARITY // 64 + 1, CELLS // 64).alias("sketch")), "sets")


def both_sides(pairs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """The stored pairs (a, b) with columns of the rows with those keys, as <column>_a and <column>_b. Of rows(key, ...), only those in pairs travel."""
    nodes = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    own = possibly_among(rows.select("key", *columns), "key", nodes, "node")
    for side in "ab":
        one = own.select(F.col("key").alias(f"k{side}"), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(one, F.col(side) == F.col(f"k{side}")).drop(f"k{side}")
    return pairs


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of keys whose sets have a Jaccard similarity of `similarity` or more. Whole sets travel only where bitmaps do not rule the pair out."""
    small = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "pairs")
    # Of na + nb - 2 * common elements in one set only, at least the differing cells; similarity bounds them.
    for bitmap in ("odd", "sketch"):
        differing = F.aggregate(F.zip_with(f"{bitmap}_a", f"{bitmap}_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)
        both = both_sides(small, sets, "n", bitmap)
        before, small = small, stored(both.filter(differing * (1 + similarity) <= (1 - similarity) * (F.col("n_a") + F.col("n_b")) + 1e-6).select("a", "b"), "close")
        forget(before)
    both = both_sides(small, sets, "set")
    both = held(both, {"c": F.size(F.array_intersect("set_a", "set_b")), "t": F.size("set_a") + F.size("set_b")})
    out = stored(both.filter(F.col("c") >= similarity * (F.col("t") - F.col("c")) - 1e-9).select("a", "b"), "alike")
    forget(small)
    release(out.sparkSession)
    return out


def linked(met: DataFrame, compare: Callable[[DataFrame], DataFrame], similarity: float, known: DataFrame | None = None) -> DataFrame:
    """node, component of the keys in met(g, key, n): the same as if all pairs of a g were compared.

    met may also have `at`, the place of g among the n elements of the key's set in
    one order for all. A pair need only meet on its first common element: all that
    it has in common comes from there on, so pairs, and members for whom even the
    smallest partner of their g is too large, are ruled out by what is left of
    their sets. First all are compared with the key of their g that has it first,
    of equal ones the smallest: the fewest elements of its own come before, which
    makes it the likeliest centre of a crowd. Where a g's members
    are in several components after that, those outside of its largest one are
    compared with all members of other components: in small groups all at once,
    in crowded ones first a few, as they may join the rest. In the last round
    none is left out. compare gives the links among pairs (a, b); sizes n that
    differ by more than the similarity are ruled out. known: links found before,
    whose components need no comparing within.
    """
    # Most elements occur once: those are counted away before keys travel.
    several = stored(met.groupBy(F.col("g").alias("g2")).agg(F.count("*").alias("m")).filter("m > 1").select("g2"), "several")
    placed = "at" in met.columns
    rows = stored(possibly_among(met if placed else met.withColumn("at", F.lit(0)), "g", several, "g2"), "met")
    # Sets of x and y elements are similar where that many are common, so a g at places p and q must leave as many.
    enough = lambda left, x, y: left >= similarity / (1 + similarity) * (x + y) - 1e-6 if placed else F.lit(True)
    sizes = lambda x, y, p, q: (F.least(x, y) >= similarity * F.greatest(x, y) - 1e-9) & enough(F.least(x - p, y - q), x, y)
    least = rows.groupBy(F.col("g").alias("g2")).agg(F.min("n").alias("least"))
    able = enough(F.col("n") - F.col("at"), F.col("n"), F.greatest(F.col("least"), similarity * F.col("n")))
    rows, before = stored(rows.join(least, F.col("g") == F.col("g2")).filter(able).select("g", "key", "n", "at"), "able"), rows
    forget(before)
    heads = rows.groupBy(F.col("g").alias("g2")).agg(F.min(F.struct("at", "key", "n")).alias("head"), F.count("*").alias("m")).filter("m > 1")
    crowds = every = stored(rows.join(heads, F.col("g") == F.col("g2")).select("g", "key", "n", "at", "head", "m"), "crowds")
    first = crowds.filter(sizes(F.col("n"), F.col("head.n"), F.col("at"), F.col("head.at"))).select(F.col("head.key").alias("a"), F.col("key").alias("b"))
    if known is None:
        links = compare(first)
    else:
        together = components(known)
        for side in "ab":
            first = first.join(together.select(F.col("node").alias(f"n{side}"), F.col("component").alias(f"c{side}")), F.col(side) == F.col(f"n{side}"), "left")
        links = stored(known.unionByName(compare(first.filter(~F.coalesce(F.col("ca") == F.col("cb"), F.lit(False))).select("a", "b"))), "links")
    joined = components(links)
    forget(several, rows)
    crowds, left = every.filter("m > 2").select("g", "key", "n", "at", "m"), [every]
    for i, rate in enumerate(RATES):
        rows = crowds.join(joined, crowds["key"] == joined["node"], "left").select("g", "key", "n", "at", "m", F.coalesce("component", "key").alias("c"))
        parts = rows.groupBy("g", "c").agg(F.count("*").alias("k")).groupBy("g").agg(F.max(F.struct("k", "c")).alias("main"), F.count("*").alias("parts"))
        parts = parts.filter("parts > 1").select(F.col("g").alias("g2"), F.col("main.c").alias("main"))
        rows = stored(rows.join(parts, F.col("g") == F.col("g2")).drop("g2"), "apart")
        left.append(rows)
        if rows.isEmpty():
            break
        turn = F.pmod("key", F.lit(rate)) == 0
        first = rows.filter((F.col("c") != F.col("main")) & (((F.col("m") <= CROWD) | turn) if i == 0 else turn))
        first = first.select(F.col("g").alias("g2"), F.col("key").alias("a"), F.col("c").alias("c2"), F.col("n").alias("n2"), F.col("at").alias("at2"))
        pairs = rows.join(first, (F.col("g") == F.col("g2")) & (F.col("c") != F.col("c2")) & sizes(F.col("n"), F.col("n2"), F.col("at"), F.col("at2"))).select("a", F.col("key").alias("b"))
        links = stored(links.unionByName(compare(pairs)), "links")
        left += [links, joined]
        joined = components(links)
        crowds = rows.filter(F.col("m") > CROWD).select("g", "key", "n", "at", "m")
    forget(*left)
    return joined


def simhash_links(docs: DataFrame, sets: DataFrame, similarity: float, shingle: int, max_bits: int = 2) -> DataFrame:
    """a, b: links among distinct texts whose SimHashes are equal or meet in a ball, verified on their sets. A text is compared with the first of each fingerprint in reach."""
    fps = stored(fingerprints(docs, shingle).select("fp", "key").distinct(), "fingerprints")
    heads = stored(fps.groupBy(F.col("fp").alias("hfp")).agg(F.min("key").alias("head")), "heads")
    own = fps.join(heads, F.col("fp") == F.col("hfp")).select(F.col("head").alias("a"), F.col("key").alias("b"))
    near = links(heads.select(F.col("hfp").alias("fp")), max_bits)
    for side in "ab":
        near = near.join(heads.select(F.col("hfp").alias(f"f{side}"), F.col("head").alias(f"k{side}")), F.col(side) == F.col(f"f{side}"))
    out = alike(own.unionByName(near.select(F.col("ka").alias("a"), F.col("kb").alias("b"))), sets, similarity)
    forget(fps, heads)
    return out


def verified_groups(docs: DataFrame, similarity: float = 0.8, verify: int = 5) -> DataFrame:
    """key, component: distinct texts that are linked, by their hashes.

    Texts are linked when their sets of `verify`-word shingles have a Jaccard
    similarity of `similarity` or more. SimHash balls, as in near_duplicates, give
    the first links; no distance of them decides that similarity, so others are
    missed. Similar sets have ceil(similarity * n) of either one's n shingles in
    common, so in one order for all sets they share one of the first
    n - ceil(similarity * n) + 1: texts that share one of those and are not linked
    yet are the other candidates, and no pair is missed.
    """
    sets = ordered_sets(docs, verify)
    met = sets.select("key", "n", F.posexplode(prefix(similarity)).alias("at", "g"))
    known = simhash_links(docs, sets, similarity, verify)
    found = linked(met, lambda pairs: alike(pairs, sets, similarity), similarity, known)
    forget(sets, known)
    return found.select(F.col("node").alias("key"), "component")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """Rows of docs that are the first of their group by doc_id, with all their columns.

    Rows of the same text are one group without further ado. Rows without an id
    stay, as do rows that repeat the first one's id.
    """
    groups = verified_groups(docs, **options)
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    rows = carried(docs, id=docs["doc_id"].cast("bigint"), key=key)
    named = rows.select("id", "key").join(groups.withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left").withColumn("g", F.coalesce("component", "key"))
    heads = named.groupBy("g").agg(F.min("id").alias("head")).select("head").distinct()
    kept = rows.join(heads, F.col("id") == F.col("head"), "left_semi")
    return kept.unionByName(rows.filter(F.col("id").isNull())).select("row.*")
