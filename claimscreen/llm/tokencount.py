"""Token counts by offset-mapped attribution.

A document is encoded once, as a whole. Its tokens' spans are joined to its
sections as intervals, and a token that crosses a boundary goes to one section by
rule: the one that holds most of its bytes, the earlier of equal ones ("most"), or
the one that holds its first byte ("first").

Sections are character spans, given by a column or a table. They are taken in
order of their start; where they overlap, a byte belongs to the last one started.
Tokens outside of all sections are reported under a null section. Nulls: a null
text is empty, a null list has no sections, bounds are clipped to the text.
Repeated rows are separate documents; a null id is reported as null. Extra columns
are not read, whatever their names; no documents give no rows. Texts of any length
are encoded whole, and their sections found in time that follows the length.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscreen.llm.common import ship_code

RULES = ("most", "first")
SECTIONS = "array<struct<section:int,start:bigint,end:bigint>>"
COUNTS = "array<struct<section:int,start:bigint,end:bigint,n_tokens:bigint,n_crossing:bigint>>"


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    """A byte-level encoding and the number of bytes of each of its tokens."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def line_spans(text: str) -> list[tuple[int, int, int]]:
    """(number, start, end) of each line, its \\n included, in one pass."""
    ends = list(accumulate(len(x) + 1 for x in text.split("\n")))
    return list(zip(range(len(ends)), [0, *ends[:-1]], ends))


def with_sections(docs: DataFrame, table: DataFrame) -> DataFrame:
    """docs with a `sections` column from table(doc_id, section, start, end)."""
    listed = table.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_list(F.struct("section", "start", "end")).cast(SECTIONS).alias("sections"))
    return docs.join(listed, docs["doc_id"] == listed["__id"], "left").drop("__id")


def attribute(text: str, sections: list[tuple[int, int, int]], ids: list[int], lengths: np.ndarray, rule: str) -> list[tuple]:
    """(section, start, end, tokens, crossing tokens) in order of start, and a last null section if tokens are outside of all."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    # Byte offset of each character, then of each section's edge.
    chars = np.concatenate([np.flatnonzero((raw & 0xC0) != 0x80), [len(raw)]])
    order = sorted(sections, key=lambda s: (s[1], s[2], s[0]))
    starts = chars[np.clip([s for _, s, _ in order], 0, len(chars) - 1)] if order else np.zeros(0, np.int64)
    ends = np.maximum(starts, chars[np.clip([e for _, _, e in order], 0, len(chars) - 1)]) if order else np.zeros(0, np.int64)
    stops = np.cumsum(lengths[np.array(ids, dtype=np.int64)]) if len(ids) else np.zeros(0, np.int64)
    begins = stops - lengths[np.array(ids, dtype=np.int64)] if len(ids) else stops

    def holder(at: np.ndarray) -> np.ndarray:
        """The last section started at or before a byte, or -1 where that one has ended."""
        i = np.searchsorted(starts, at, side="right") - 1
        return np.where((i >= 0) & (at < np.concatenate([ends, [0]])[i]), i, -1)

    first, last = holder(begins), holder(stops - 1)
    goes = first.copy()
    # A token crosses if its ends differ, or if a whole section or gap begins inside it.
    cuts = np.unique(np.concatenate([starts, ends]))
    crossing = (first != last) | (np.searchsorted(cuts, stops, side="left") > np.searchsorted(cuts, begins, side="right"))
    crossing &= (first >= 0) | (last >= 0) | (np.searchsorted(cuts, stops, side="left") > np.searchsorted(cuts, begins, side="right"))
    if rule == "most":
        for t in np.flatnonzero(crossing).tolist():
            owners = holder(np.arange(begins[t], stops[t]))
            kinds, at, n = np.unique(owners, return_index=True, return_counts=True)
            goes[t] = max(zip(n.tolist(), (-at).tolist(), kinds.tolist(), strict=True))[2]
    n = np.bincount(goes + 1, minlength=len(order) + 1)
    c = np.bincount(goes[crossing] + 1, minlength=len(order) + 1)
    out = [(int(i), int(s), int(e), int(n[k + 1]), int(c[k + 1])) for k, (i, s, e) in enumerate(order)]
    return out + ([(None, None, None, int(n[0]), int(c[0]))] if n[0] else [])


def token_counts(docs: DataFrame, tokenizer: str, pattern: str, rule: str = "most") -> DataFrame:
    """doc_id, section, start, end, n_tokens, n_crossing, doc_tokens; docs has doc_id, text and sections, or without these each line is a section, numbered from 0."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ship_code(docs.sparkSession)
    fields = ("section", "start", "end", "n_tokens", "n_crossing")
    listed = "sections" in docs.columns

    @F.pandas_udf(COUNTS)
    def count(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        encoding, lengths = encoder(tokenizer, pattern)
        for texts, sections in batches:
            out = []
            for text, own in zip(texts, sections, strict=True):
                spans = line_spans(text) if not listed else [(s["section"], s["start"], s["end"]) for s in ([] if own is None else own)]
                rows = attribute(text, spans, encoding.encode_ordinary(text), lengths, rule)
                out.append([dict(zip(fields, r, strict=True)) for r in rows])
            yield pd.Series(out)

    own = F.col("sections").cast(SECTIONS) if listed else F.lit(None).cast(SECTIONS)
    rows = docs.select(F.col("doc_id").alias("doc_id"), count(F.coalesce("text", F.lit("")), own).alias("counts"))
    total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda acc, x: acc + x["n_tokens"])
    return rows.select("doc_id", total.alias("doc_tokens"), F.explode("counts").alias("c")).select("doc_id", "c.*", "doc_tokens")
