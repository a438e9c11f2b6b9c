"""Substring dedup: Rabin-Karp hashes of fixed-length word windows, counted in Spark.

A window of a document is removed when its word sequence also starts in a
document with a smaller doc_id; removed windows merge into maximal intervals.

Passes (see passes.py):

1. Each window has a minimizer: of the runs of `part` words in it, the one with
   the smallest hash. Equal windows have equal minimizers, so a window whose
   minimizer occurs in one row only cannot repeat. They change only every few
   words, and 40 bits of their hashes do, as strays only cost time.
2. The Rabin-Karp hashes (96 bits) of the windows left are counted: for each hash
   of each batch, does another batch hold it in a document with a smaller id?
3. Removed windows are merged and the rest of the words put together.

Null texts have no words. A null id is smaller than all others. Rows that repeat
an id do not remove each other's windows; a row repeated with its text gets the
same result again. Extra columns are not read; no documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from xxhash import xxh3_64_intdigest

from claimscreen.llm.common import partitions
from claimscreen.llm.passes import (
    NO_ID, answer, ask, ask_again, bins_of, by_bin, conclude, dealt, minimizer_starts, packed, rabin_karp, rows_of, unpacked,
)

SECOND_BASE = 0xC2B2AE3D27D4EB4F
FIELDS = "n int, hashes binary, more binary, owners binary"


class Batch:
    """A batch's documents as word hashes, one array with a slice for each."""

    def __init__(self, docs: list[tuple[int, str]], window: int, part: int, n_bins: int) -> None:
        self.window, self.n_bins = window, n_bins
        self.numbers = np.array([d for d, _ in docs], dtype=np.int64)
        starts, mins, firsts, seconds, owners = [], [], [], [], []
        for i, (_, text) in enumerate(docs):
            words = text.encode().split()
            if len(words) < window:
                continue
            values = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
            h = rabin_karp(values, part)
            mins.append(h[minimizer_starts(h, window - part + 1)])
            firsts.append(rabin_karp(values, window))
            seconds.append(rabin_karp(values, window, SECOND_BASE) >> np.uint64(32))
            starts.append(np.arange(len(mins[-1])))
            owners.append(np.full(len(mins[-1]), i))
        empty = [np.zeros(0, np.uint64)]
        self.mins, self.first, self.second = (np.concatenate(x or empty) for x in (mins, firsts, seconds))
        self.starts, self.owners = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (starts, owners))

    def minimizers(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct minimizers, and whether two documents hold them."""
        change = np.concatenate([[True], (self.mins[1:] != self.mins[:-1]) | (self.owners[1:] != self.owners[:-1])]) if len(self.mins) else np.zeros(0, bool)
        h, o = self.mins[change], self.owners[change]
        order = np.lexsort((o, h))
        h, o = h[order], o[order]
        head = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
        at = np.flatnonzero(head)
        several = np.maximum.reduceat(o, at) != np.minimum.reduceat(o, at) if len(h) else np.zeros(0, bool)
        return h[head], several

    def keep(self, answers: dict[tuple[int, int], bytes]) -> None:
        """Only windows with a minimizer that repeats."""
        h, _ = self.minimizers()
        some = [h[at][bits(answers[0, b], len(at))] for b, at in by_bin(bins_of(h, self.n_bins)) if (0, b) in answers]
        known = np.sort(np.concatenate(some)) if some else np.zeros(0, np.uint64)
        place = np.searchsorted(known, self.mins)
        found = known[np.minimum(place, max(0, len(known) - 1))] == self.mins if len(known) else np.zeros(len(self.mins), bool)
        self.first, self.second, self.starts, self.owners = (x[found] for x in (self.first, self.second, self.starts, self.owners))

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct window hashes (two parts), the smallest id that holds each, and each window's place among them."""
        ids = self.numbers[self.owners]
        order = np.lexsort((ids, self.second, self.first))
        a, b = self.first[order], self.second[order]
        head = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
        places = np.empty(len(order), dtype=np.int64)
        places[order] = np.cumsum(head) - 1
        return a[head], b[head], ids[order][head], places


def bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8))[:n].astype(bool)


def ask_minimizers(docs: list, window: int, part: int, n_bins: int) -> Iterator[tuple[int, int, dict]]:
    h, several = Batch(docs, window, part, n_bins).minimizers()
    for b, at in by_bin(bins_of(h, n_bins)):
        cut = np.ascontiguousarray((h[at] & np.uint64(0xFFFFFFFFFF)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
        yield 0, b, {"n": len(at), "hashes": cut.tobytes(), "more": np.packbits(several[at]).tobytes(), "owners": b""}


def ask_windows(docs: list, answers: dict, window: int, part: int, n_bins: int) -> Iterator[tuple[int, int, dict]]:
    batch = Batch(docs, window, part, n_bins)
    batch.keep(answers)
    first, second, least, _ = batch.windows()
    for b, at in by_bin(bins_of(first, n_bins)):
        yield 1, b, {"n": len(at), "hashes": first[at].astype("<u8").tobytes(), "more": second[at].astype("<u4").tobytes(), "owners": packed(least[at].astype("<i8"))}


def answer_bin(kind: int, table: pa.Table) -> list[bytes]:
    """Kind 0: does the minimizer occur in another row of documents? Kind 1: does a smaller id hold the window?"""
    sizes = table["n"].to_pylist()
    if kind == 0:
        raw = np.frombuffer(b"".join(table["hashes"].to_pylist()), np.uint8).reshape(-1, 5)
        h = np.zeros((len(raw), 8), np.uint8)
        h[:, :5] = raw
        _, place, counts = np.unique(h.view("<u8").ravel(), return_inverse=True, return_counts=True)
        several = np.concatenate([bits(d, n) for d, n in zip(table["more"].to_pylist(), sizes, strict=True)])
        yes = (counts[place] > 1) | several
    else:
        a = np.frombuffer(b"".join(table["hashes"].to_pylist()), "<u8")
        b = np.frombuffer(b"".join(table["more"].to_pylist()), "<u4")
        own = np.concatenate([unpacked(d, "<i8") for d in table["owners"].to_pylist()])
        order = np.lexsort((own, b, a))
        x, y = a[order], b[order]
        head = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        least = own[order][head][np.cumsum(head) - 1]
        yes = np.empty(len(a), bool)
        yes[order] = least < own[order]
    return [np.packbits(yes[s]).tobytes() if yes[s].any() else b"" for s in rows_of(sizes)]


def merged(starts: np.ndarray, window: int) -> np.ndarray:
    """Sorted starts of removed windows to maximal (start, end) rows."""
    if not len(starts):
        return np.zeros((0, 2), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(starts) > window) + 1
    first, last = np.concatenate([[0], cuts]), np.concatenate([cuts - 1, [len(starts) - 1]])
    return np.stack([starts[first], starts[last] + window], axis=1)


def cut_documents(docs: list, answers: dict, window: int, part: int, n_bins: int, texts: bool) -> Iterator[dict]:
    batch = Batch(docs, window, part, n_bins)
    batch.keep(answers)
    first, _, least, places = batch.windows()
    elsewhere = np.zeros(len(first), bool)
    for b, at in by_bin(bins_of(first, n_bins)):
        if (1, b) in answers:
            elsewhere[at] = bits(answers[1, b], len(at))
    gone = elsewhere[places] | (batch.numbers[batch.owners] > least[places])
    owners, starts = batch.owners[gone], batch.starts[gone]
    edges = np.searchsorted(owners, np.arange(len(docs) + 1))
    for i, (number, text) in enumerate(docs):
        words = text.encode().split()
        spans = merged(starts[edges[i] : edges[i + 1]], window)
        kept, at = [], 0
        for s, e in spans.tolist():
            kept += words[at:s]
            at = e
        rest = b" ".join(kept + words[at:])
        row = {"doc_id": None if number == NO_ID else number, "n_words": len(words), "n_removed": int((spans[:, 1] - spans[:, 0]).sum()), "kept_sha256": hashlib.sha256(rest).hexdigest()}
        yield row | {"span_starts": spans[:, 0].tolist(), "span_ends": spans[:, 1].tolist()} | ({"kept_text": rest.decode()} if texts else {})


def remove_repeated_windows(docs: DataFrame, window: int = 13, part: int = 6, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, span_starts, span_ends (in words), and kept_text if texts."""
    n_bins = partitions(docs.sparkSession)
    batches = dealt(docs)
    one = answer(ask(batches, lambda d: ask_minimizers(d, window, part, n_bins), FIELDS), answer_bin)
    two = answer(ask_again(batches, one, lambda d, a: ask_windows(d, a, window, part, n_bins), FIELDS), answer_bin)
    fields = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, span_starts array<bigint>, span_ends array<bigint>" + ", kept_text string" * texts
    return conclude(batches, one.unionByName(two), lambda d, a: cut_documents(d, a, window, part, n_bins, texts), fields)
