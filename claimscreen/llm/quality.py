"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules look at one document. The method then hashes normalised lines, counts
the distinct documents of a host that hold each line, removes lines above the
limit and rejects documents that lose too much by it.

Distinct documents are distinct texts: exact copies of one document are a matter
of deduplication and do not turn its lines into boilerplate. Nulls: a null text
has no words and fails the base rules; null hosts form one host; null ids are
carried along. Repeated rows get the same verdict, an empty table gives no rows,
and columns other than doc_id, text and source are not looked at, whatever their
names. Texts and lines of any length are taken whole. Lines and texts are named by
64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscreen.llm.common import carried, held, stored, words_of

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class QualityLimits:
    """min_words, repeat_window (a power of two) and repeat_percent: the base rules.

    A line is removed where more than max(line_docs, line_share of the host's
    documents) hold it; lines of fewer than min_line_words never are. A document
    is rejected when more than max_lost_share of its words are in removed lines.
    """

    min_words: int = 20
    repeat_window: int = 8
    repeat_percent: int = 30
    line_docs: int = 10
    line_share: float = 0.02
    min_line_words: int = 3
    max_lost_share: float = 0.50


def repeated_starts(h: Column) -> Column:
    """Sorted positions of the values that occur twice or more; nothing is sorted unless some do."""
    none = F.array().cast("array<int>")
    ranked = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    n = F.size(h)
    pairs = F.zip_with(F.slice(ranked, F.lit(1), n - 1), F.slice(ranked, F.lit(2), n - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(none))
    return F.when(n > F.size(F.array_distinct(h)), F.array_sort(F.array_distinct(F.flatten(pairs)))).otherwise(none)


def covered(starts: Column, window: int) -> Column:
    """Positions covered by windows at the sorted starts."""
    following = F.slice(starts, F.lit(2), F.greatest(F.size(starts), F.lit(1)))
    gaps = F.zip_with(starts, following, lambda a, b: F.least(F.lit(window), F.coalesce(b - a, F.lit(window))))
    return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def base_rules(rows: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    """rows(..., text) with the base columns added and the text dropped."""
    t = F.coalesce(F.col("text"), F.lit(""))
    length_without = lambda drop: F.length(F.translate(t, drop, "")).cast("bigint")
    own = list(rows.columns)
    out = held(
        rows,
        {
            "__words": words_of(t),
            "word_chars": length_without(BLANKS),
            "n_symbols": F.length(t) - length_without(SYMBOLS),
            "__lines": F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0),
        },
    )
    counts = {"n_words": F.size("__words").cast("bigint"), "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint")}
    out = held(out, counts | {"__h1": F.transform("__words", lambda w: F.xxhash64(w))}).drop("text", "__words", "__lines")
    width = 1
    while width < limits.repeat_window:
        # A hash of each run of words, from two runs of half its length; the last ones are short and cut off below.
        h = F.col(f"__h{width}")
        out = held(out, {f"__h{2 * width}": F.zip_with(h, F.slice(h, F.lit(width + 1), F.greatest(F.size(h), F.lit(1))), lambda a, b: F.xxhash64(a, b))})
        width *= 2
    out = held(out, {"__h": F.slice(F.col(f"__h{width}"), F.lit(1), F.greatest(F.col("n_words").cast("int") - width + 1, F.lit(0)))})
    out = held(out, {"__starts": repeated_starts(F.col("__h"))})
    out = held(out, {"n_repeat_words": covered(F.col("__starts"), limits.repeat_window)})
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select(*[c for c in own if c != "text"], *base, failed.alias("base_failed"))


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, runs of white space as one blank."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\p{Nd}+", "0"), r"\s+", " "))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, host, key (of the text), text: the columns in use, under names of their own."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").alias("doc_id"), F.col("source").cast("string").alias("host"), F.xxhash64(text).alias("key"), text.alias("text"))


def line_table(rows: DataFrame, limits: QualityLimits) -> DataFrame:
    """host, key, h, n: a row for each line, with its hash and number of words."""
    lines = rows.select("host", "key", F.explode(F.split("text", "\n")).alias("raw"))
    lines = held(lines, {"line": normalised(F.col("raw"))})
    return lines.select("host", "key", F.xxhash64("line").alias("h"), F.size(F.split("line", " ")).cast("bigint").alias("n")).filter(F.col("n") >= limits.min_line_words)


def frequent_lines(rows: DataFrame, limits: QualityLimits) -> DataFrame:
    """host, h, n_docs of the lines above the limit. Counts are combined before they are shuffled."""
    per_doc = line_table(rows, limits).select("host", "h", "key").distinct()
    counts = per_doc.groupBy("host", "h").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") > limits.line_docs)
    hosts = rows.select(F.col("host").alias("h2"), "key").distinct().groupBy("h2").agg(F.count("*").alias("host_docs"))
    over = counts.join(hosts, counts["host"].eqNullSafe(hosts["h2"])).filter(F.col("n_docs") > limits.line_share * F.col("host_docs"))
    return over.select("host", "h", "n_docs")


def hits(rows: DataFrame, limits: QualityLimits) -> DataFrame:
    """The rows of line_table whose line is above the limit."""
    bad = frequent_lines(rows, limits).select(F.col("host").alias("h2"), F.col("h").alias("bad"))
    lines = line_table(rows, limits)
    return lines.join(bad, lines["host"].eqNullSafe(bad["h2"]) & (lines["h"] == bad["bad"])).select("host", "key", "h", "n")


def quality(docs: DataFrame, limits: QualityLimits = QualityLimits(), found: DataFrame | None = None) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost_words."""
    rows = keyed(docs)
    copies = rows.groupBy(F.col("host").alias("ch"), F.col("key").alias("ck")).agg(F.count("*").alias("copies"))
    lost = (hits(rows, limits) if found is None else found).groupBy("host", "key").agg(F.sum("n").alias("lost"))
    lost = lost.join(copies, lost["host"].eqNullSafe(copies["ch"]) & (lost["key"] == copies["ck"]))
    lost = lost.select("ch", "ck", (F.col("lost") / F.col("copies")).cast("bigint").alias("lost_words"))
    base = base_rules(rows, limits)
    out = base.join(lost, base["host"].eqNullSafe(lost["ch"]) & (base["key"] == lost["ck"]), "left")
    lost_words = F.coalesce("lost_words", F.lit(0))
    kept = ~F.col("base_failed") & (lost_words <= limits.max_lost_share * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), lost_words.alias("lost_words"), "host", "key")


def named_rows(docs: DataFrame) -> DataFrame:
    return carried(docs, host=docs["source"].cast("string"), key=F.xxhash64(F.coalesce(docs["text"], F.lit(""))))


def good_keys(docs: DataFrame, limits: QualityLimits, found: DataFrame | None) -> DataFrame:
    return quality(docs, limits, found).filter("kept").select(F.col("host").alias("h2"), F.col("key").alias("k2")).distinct()


def cut_keys(found: DataFrame) -> DataFrame:
    return found.groupBy(F.col("host").alias("ch"), F.col("key").alias("ck")).agg(F.collect_set("h").alias("cut"))


def without_cut(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows (as named_rows names them, with cut) as docs has them, without the lines of cut, and their new length in n_chars if docs has that."""
    rest = F.array_join(F.filter(F.split("row.text", "\n"), lambda x: ~F.array_contains("cut", F.xxhash64(normalised(x)))), "\n")
    out = rows.withColumn("rest", F.when(F.col("cut").isNotNull(), rest))
    new = {"text": F.col("rest"), "n_chars": F.length("rest").cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    return out.select(*[F.when(F.col("rest").isNotNull(), new[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


def keep_good(docs: DataFrame, limits: QualityLimits = QualityLimits(), found: DataFrame | None = None) -> DataFrame:
    """Rows of docs that pass, with all their columns. The verdict belongs to host and text, so it needs no id."""
    return named_rows(docs).join(good_keys(docs, limits, found), F.col("host").eqNullSafe(F.col("h2")) & (F.col("key") == F.col("k2")), "left_semi").select("row.*")


def clean(docs: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    """Rows of docs that pass, without the removed lines. Verdict and lines are of docs as they come; whole rows travel once."""
    found = stored(hits(keyed(docs), limits), "hits")
    cut = cut_keys(found)
    good = good_keys(docs, limits, found).join(cut, F.col("h2").eqNullSafe(F.col("ch")) & (F.col("k2") == F.col("ck")), "left").select("h2", "k2", "cut")
    return without_cut(named_rows(docs).join(good, F.col("host").eqNullSafe(F.col("h2")) & (F.col("key") == F.col("k2"))), docs)


def strip_lines(docs: DataFrame, limits: QualityLimits = QualityLimits(), found: DataFrame | None = None) -> DataFrame:
    """docs with the removed lines taken out of text; all other columns as they were."""
    cut = cut_keys(hits(keyed(docs), limits) if found is None else found)
    return without_cut(named_rows(docs).join(cut, F.col("host").eqNullSafe(F.col("ch")) & (F.col("key") == F.col("ck")), "left"), docs)
