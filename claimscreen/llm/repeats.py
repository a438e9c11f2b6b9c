"""Suffix-array dedup: maximal repeats of at least `length` bytes, over a whole corpus.

Every string of `length` bytes has a minimizer, the 32-byte gram in it with the
smallest hash, so equal strings share it. The strings of a document that share an
occurrence of a minimizer form a context (their union); each string belongs to
one context. Passes over batches of documents (see passes.py):

1. Contexts are counted by (minimizer, digest). A context that occurs twice is
   repeated as a whole. Contexts of a minimizer that has others are sent on, one
   for each digest; the rest is silent.
2. Sent contexts meet in bins. There an enhanced suffix array (order and common
   prefixes of neighbours) is scanned with a stack into the tree of its common-
   prefix intervals; intervals whose occurrences are preceded by different bytes
   are the maximal repeats, with all their occurrences. A minimizer with more
   than `crowd` distinct contexts (the edge of a passage that many documents
   share) is not gathered: its strings are hashed one by one and counted, folded
   by batch, so that no task's load follows a hot passage.
3. Removed bytes are merged into runs and cut.

Strings are compared on the input, never across documents; the same document
counts, overlaps count. Null texts are empty. Ids play no part, so null and
repeated ids need no care; a repeated row is a second document, so all of a text
of `length` bytes or more goes. Extra columns are not read; no rows give no rows.
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
    NO_ID, answer, ask, ask_again, bins_of, by_bin, conclude, dealt, minimizer_starts, rabin_karp, rows_of,
)

GRAM = 32
CROWD = 256
#: Closes each context in a bin's concatenation: a byte that UTF-8 does not have.
END = b"\xff"
FIELDS = "n int, hashes binary, digests binary, bodies binary"
SILENT, SEND, COUNT = 0, 1, 2


class Contexts:
    """All contexts of a batch: owner, first byte, end, minimizer's hash, digest."""

    def __init__(self, docs: list[tuple[int, str]], length: int) -> None:
        self.texts = [t.encode() for _, t in docs]
        owner, start, end, mark, digest = [], [], [], [], []
        for i, raw in enumerate(self.texts):
            if len(raw) < length:
                continue
            h = rabin_karp(np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1), GRAM)
            at = minimizer_starts(h, length - GRAM + 1)
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            last = np.concatenate([first[1:], [len(at)]]) - 1 + length
            owner.append(np.full(len(first), i))
            start.append(first)
            end.append(last)
            mark.append(h[at[first]])
            # The digest covers the minimizer's place in the context too.
            digest.append(np.fromiter((xxh3_64_intdigest(raw[s:e], p) for s, e, p in zip(first.tolist(), last.tolist(), (at[first] - first).tolist(), strict=True)), np.uint64, len(first)))
        whole, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        self.owner, self.start, self.end = (np.concatenate(x or whole) for x in (owner, start, end))
        self.mark, self.digest = (np.concatenate(x or hashes) for x in (mark, digest))

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First of the contexts of each (mark, digest), whether there are several, and each context's place among them."""
        order = np.lexsort((np.arange(len(self.mark)), self.digest, self.mark))
        m, d = self.mark[order], self.digest[order]
        head = np.concatenate([[True], (m[1:] != m[:-1]) | (d[1:] != d[:-1])]) if len(m) else np.zeros(0, bool)
        places = np.empty(len(order), np.int64)
        places[order] = np.cumsum(head) - 1
        return order[head], np.bincount(places, minlength=int(head.sum())) > 1, places

    def body(self, i: int) -> bytes:
        return self.texts[self.owner[i]][self.start[i] : self.end[i]]


def ask_contexts(docs: list, length: int, n_bins: int) -> Iterator[tuple[int, int, dict]]:
    c = Contexts(docs, length)
    first, several, _ = c.distinct()
    for b, at in by_bin(bins_of(c.mark[first], n_bins)):
        i = first[at]
        yield 0, b, {"n": len(at), "hashes": c.mark[i].astype("<u8").tobytes(), "digests": c.digest[i].astype("<u8").tobytes(), "bodies": np.packbits(several[at]).tobytes()}


def verdicts(table: pa.Table, crowd: int) -> list[bytes]:
    """A byte for each context: 4 if it occurs twice, plus what its batch is to do with it."""
    sizes = table["n"].to_pylist()
    m = np.frombuffer(b"".join(table["hashes"].to_pylist()), "<u8")
    d = np.frombuffer(b"".join(table["digests"].to_pylist()), "<u8")
    several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8))[:n] for x, n in zip(table["bodies"].to_pylist(), sizes, strict=True)]).astype(np.int64)
    order = np.lexsort((np.arange(len(m)), d, m))
    x, y = m[order], d[order]
    head = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
    kind = np.cumsum(head) - 1
    twice = np.bincount(kind, weights=1 + several[order])[kind] > 1
    group = np.cumsum(np.concatenate([[True], x[1:] != x[:-1]])) - 1
    distinct = np.bincount(group, weights=head)[group]
    # Where every context occurs twice there is nothing left to compare.
    open_ = np.bincount(group, weights=~twice)[group] > 0
    act = np.where(head & open_ & (distinct > 1), np.where(distinct > crowd, COUNT, SEND), SILENT)
    out = np.empty(len(m), np.uint8)
    out[order] = act + 4 * twice
    return [out[s].tobytes() if out[s].any() else b"" for s in rows_of(sizes)]


def told(c: Contexts, answers: dict, n_bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct contexts' firsts, verdicts, and each context's place among them."""
    first, _, places = c.distinct()
    out = np.zeros(len(first), np.uint8)
    for b, at in by_bin(bins_of(c.mark[first], n_bins)):
        if (0, b) in answers:
            out[at] = np.frombuffer(answers[0, b], np.uint8)
    return first, out, places


def crowded(c: Contexts, first: np.ndarray, says: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Sorted distinct string hashes (two parts) of the contexts to be counted string by string."""
    which = [int(i) for i in first[(says & 3) == COUNT]]
    a, b = [], []
    for i in which:
        values = np.frombuffer(c.body(i), np.uint8).astype(np.uint64) + np.uint64(1)
        a.append(rabin_karp(values, length))
        b.append(rabin_karp(values, length, 0xC2B2AE3D27D4EB4F))
    return (np.concatenate(a), np.concatenate(b), which) if which else (np.zeros(0, np.uint64), np.zeros(0, np.uint64), [])


def folded(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Firsts of the distinct pairs in sorted order, whether several, each pair's place."""
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    head = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]) if len(x) else np.zeros(0, bool)
    places = np.empty(len(order), np.int64)
    places[order] = np.cumsum(head) - 1
    return order[head], np.bincount(places, minlength=int(head.sum())) > 1, places


def ask_strings(docs: list, answers: dict, length: int, n_bins: int) -> Iterator[tuple[int, int, dict]]:
    c = Contexts(docs, length)
    first, says, _ = told(c, answers, n_bins)
    send = first[(says & 3) == SEND]
    for b, at in by_bin(bins_of(c.mark[send], n_bins)):
        bodies = [c.body(i) for i in send[at]]
        yield 1, b, {"n": len(at), "hashes": c.mark[send[at]].astype("<u8").tobytes(), "digests": np.array([len(x) for x in bodies], "<u4").tobytes(), "bodies": b"".join(bodies)}
    a, d, _ = crowded(c, first, says, length)
    heads, several, _ = folded(a, d)
    for b, at in by_bin(bins_of(a[heads], n_bins)):
        yield 2, b, {"n": len(at), "hashes": a[heads[at]].astype("<u8").tobytes(), "digests": d[heads[at]].astype("<u8").tobytes(), "bodies": np.packbits(several[at]).tobytes()}


def ranks_of(pairs: np.ndarray) -> np.ndarray:
    """Dense ranks of uint64 values."""
    order = np.argsort(pairs)
    ranked = pairs[order]
    out = np.empty(len(pairs), np.int32)
    out[order] = np.cumsum(np.concatenate([[False], ranked[1:] != ranked[:-1]]), dtype=np.int32)
    return out


def suffix_array(data: np.ndarray, starts: np.ndarray, limits: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The given starts ordered by at least `depth` bytes from each on, and the common prefix of neighbours.

    limits: end of the context of each start, where data has END; common prefixes
    end there. depth reaches that end from every start: else suffixes that are cut
    off would stand between longer ones with a longer common prefix. Ranks of
    prefixes double in length; comparing them from long to short gives the common
    prefixes of all neighbours at once.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    eight = np.zeros(n, np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k : k + n]
    levels, width = [(8, ranks_of(eight))], 8
    while width < depth:
        r = levels[-1][1]
        ahead = np.concatenate([r[width:] + 1, np.zeros(min(width, n), np.int32)])[:n]
        levels.append((2 * width, ranks_of((r.astype(np.uint64) << np.uint64(32)) | ahead.astype(np.uint64))))
        width *= 2
    order = np.lexsort((starts, levels[-1][1][starts]))
    sa, ends = starts[order], limits[order]
    x, y = sa[:-1], sa[1:]
    most = np.minimum(ends[:-1] - x, ends[1:] - y)
    common = np.zeros(len(x), np.int64)
    tops = [levels[-1]] * 2 + levels[::-1]
    for width, r in tops:
        px, py = np.minimum(x + common, n - 1), np.minimum(y + common, n - 1)
        same = (r[px] == r[py]) & (common + width <= most + 8)
        common += np.where(same, width, 0)
    px, py = np.minimum(x + common, n - 1), np.minimum(y + common, n - 1)
    differ = eight[px] ^ eight[py]
    for k in range(8):
        equal = (differ >> np.uint64(56 - 8 * k)) & np.uint64(0xFF) == 0
        differ = np.where(equal, differ, np.uint64(0xFFFFFFFFFFFFFFFF))
        common += equal
    return sa, np.minimum(common, most)


def maximal_repeats(sa: np.ndarray, common: np.ndarray, before: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, all occurrences) of each maximal repeat of at least `least` bytes.

    A stack scan over the common prefixes opens an interval where they grow and
    closes it where they fall; closing, an interval hands its left bytes on to
    the one around it. before: the byte in front of each suffix, or -1 where a
    context begins, which differs from everything. An interval with one left
    byte throughout is part of a longer repeat and is passed over.
    """
    high = common >= least
    edges = np.flatnonzero(np.diff(np.concatenate([[False], high, [False]]).astype(np.int8)))
    for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        run, left = common[lo:hi].tolist(), before[lo : hi + 1].tolist()
        stack: list[list] = []  # length, first suffix, left byte of all or None if they differ
        for i, lcp in enumerate([*run, 0]):
            begin, byte = i, left[i]
            while stack and stack[-1][0] > lcp:
                length, begin, own = stack.pop()
                own = own if own == byte and byte != -1 else None
                if own is None:
                    yield length, sa[lo + begin : lo + i + 1]
                byte = own if own is not None else -1
            if lcp >= least:
                if stack and stack[-1][0] == lcp:
                    stack[-1][2] = stack[-1][2] if stack[-1][2] == byte and byte != -1 else None
                else:
                    stack.append([lcp, begin, byte if byte != -1 else None])


def repeats_in(bodies: list[bytes], length: int) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """The maximal repeats among contexts, as places in their concatenation with END after each, and where each begins (at last, where another would)."""
    sizes = np.array([len(x) for x in bodies], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes + 1)])
    data = np.frombuffer(b"".join(x + END for x in bodies), np.uint8)
    counts = sizes - length + 1
    starts = np.repeat(edges[:-1], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    sa, common = suffix_array(data, starts, np.repeat(edges[1:] - 1, counts), int(sizes.max()))
    before = np.where(np.isin(sa, edges), -1, data[np.maximum(sa - 1, 0)].astype(np.int64))
    return list(maximal_repeats(sa, common, before, length)), edges


def answer_strings(kind: int, table: pa.Table, length: int) -> list[bytes]:
    """Kind 1: for each context sent, (context, start, end) of its repeated bytes. Kind 2: which strings occur twice."""
    sizes = table["n"].to_pylist()
    if kind == 2:
        a = np.frombuffer(b"".join(table["hashes"].to_pylist()), "<u8")
        b = np.frombuffer(b"".join(table["digests"].to_pylist()), "<u8")
        several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8))[:n] for x, n in zip(table["bodies"].to_pylist(), sizes, strict=True)])
        _, often, places = folded(a, b)
        yes = often[places] | several.astype(bool)
        return [np.packbits(yes[s]).tobytes() if yes[s].any() else b"" for s in rows_of(sizes)]
    bodies: list[bytes] = []
    for lengths, raw in zip(table["digests"].to_pylist(), table["bodies"].to_pylist(), strict=True):
        cuts = np.concatenate([[0], np.cumsum(np.frombuffer(lengths, "<u4"), dtype=np.int64)]).tolist()
        bodies += [raw[s:e] for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
    marks = np.frombuffer(b"".join(table["hashes"].to_pylist()), "<u8")
    out: list[list[np.ndarray]] = [[] for _ in sizes]
    home = np.repeat(np.arange(len(sizes)), sizes)
    offset = np.concatenate([[0], np.cumsum(sizes)])
    for some in portions(marks, [len(x) for x in bodies]):
        rows = runs_in([bodies[i] for i in some], length)
        at = some[rows[:, 0]]
        rows[:, 0] = at - offset[home[at]]
        order = np.argsort(home[at], kind="stable")
        rows, homes = rows[order], home[at][order]
        for h in np.unique(homes).tolist():
            out[h].append(rows[homes == h])
    return [np.concatenate(x).astype("<i4").tobytes() if x else b"" for x in out]


def portions(marks: np.ndarray, sizes: list[int], most: int = 1 << 20) -> Iterator[np.ndarray]:
    """Contexts by minimizer, whole groups together, about `most` bytes at a time: strings of other minimizers are never equal."""
    order = np.argsort(marks, kind="stable")
    start, total = 0, 0
    for k, i in enumerate(order.tolist()):
        if total >= most and marks[i] != marks[order[k - 1]]:
            yield order[start:k]
            start, total = k, 0
        total += sizes[i]
    if start < len(order):
        yield order[start:]


def runs_in(bodies: list[bytes], length: int) -> np.ndarray:
    """(context, start, end) of the bytes that maximal repeats cover."""
    groups, edges = repeats_in(bodies, length)
    change = np.zeros(int(edges[-1]) + 1, np.int64)
    for n, places in groups:
        change[places] += 1  # the places of a group are distinct
        change[places + n] -= 1
    gone = np.cumsum(change)[:-1] > 0  # never at an END, so runs stay within a context
    starts = np.flatnonzero(gone & np.concatenate([[True], ~gone[:-1]]))
    ends = np.flatnonzero(gone & np.concatenate([~gone[1:], [True]])) + 1
    which = np.searchsorted(edges, starts, side="right") - 1
    return np.stack([which, starts - edges[which], ends - edges[which]], axis=1)


def removed_spans(c: Contexts, answers: dict, length: int, n_bins: int) -> list[np.ndarray]:
    """Merged (start, end) rows of the removed bytes of each document."""
    first, says, places = told(c, answers, n_bins)
    parts: dict[int, list[tuple[int, int]]] = {}  # by distinct context
    send = np.flatnonzero((says & 3) == SEND)
    for b, at in by_bin(bins_of(c.mark[first[send]], n_bins)):
        for i, s, e in np.frombuffer(answers.get((1, b), b""), "<i4").reshape(-1, 3).tolist():
            parts.setdefault(int(send[at[i]]), []).append((s, e))
    a, d, which = crowded(c, first, says, length)
    heads, _, at_head = folded(a, d)
    often = np.zeros(len(heads), bool)
    for b, at in by_bin(bins_of(a[heads], n_bins)):
        if (2, b) in answers:
            often[at] = np.unpackbits(np.frombuffer(answers[2, b], np.uint8))[: len(at)]
    often = often[at_head]
    done = 0
    for i in which:
        n = int(c.end[i] - c.start[i]) - length + 1
        for s in np.flatnonzero(often[done : done + n]).tolist():
            parts.setdefault(int(places[i]), []).append((s, s + length))
        done += n
    spans: list[list[tuple[int, int]]] = [[] for _ in c.texts]
    whole = (says & 4) > 0
    for o, s, e, p in zip(c.owner.tolist(), c.start.tolist(), c.end.tolist(), places.tolist(), strict=True):
        if whole[p]:
            spans[o].append((s, e))
        elif p in parts:
            spans[o] += [(s + x, s + y) for x, y in parts[p]]
    return [joined(np.array(sorted(x), np.int64).reshape(-1, 2)) for x in spans]


def joined(spans: np.ndarray) -> np.ndarray:
    """Sorted spans with touching ones made one."""
    if not len(spans):
        return spans
    reach = np.maximum.accumulate(spans[:, 1])
    head = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    at = np.flatnonzero(head)
    return np.stack([spans[at, 0], np.maximum.reduceat(spans[:, 1], at)], axis=1)


def cut_documents(docs: list, answers: dict, length: int, n_bins: int, texts: bool) -> Iterator[dict]:
    c = Contexts(docs, length)
    for (number, _), raw, spans in zip(docs, c.texts, removed_spans(c, answers, length, n_bins), strict=True):
        kept, at = [], 0
        for s, e in spans.tolist():
            kept.append(raw[at:s])
            at = e
        rest = b"".join([*kept, raw[at:]])
        row = {"doc_id": None if number == NO_ID else number, "n_bytes": len(raw), "n_removed": len(raw) - len(rest), "n_spans": len(spans), "kept_sha256": hashlib.sha256(rest).hexdigest()}
        yield row | {"span_starts": spans[:, 0].tolist(), "span_ends": spans[:, 1].tolist()} | ({"kept_text": rest.decode("utf-8", "replace")} if texts else {})


def remove_repeats(docs: DataFrame, length: int = 400, crowd: int = CROWD, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, span_starts, span_ends (in bytes), and kept_text if texts (bytes of characters cut in half become replacement marks)."""
    n_bins = partitions(docs.sparkSession)
    batches = dealt(docs)
    one = answer(ask(batches, lambda d: ask_contexts(d, length, n_bins), FIELDS), lambda _, t: verdicts(t, crowd))
    two = answer(ask_again(batches, one, lambda d, a: ask_strings(d, a, length, n_bins), FIELDS), lambda k, t: answer_strings(k, t, length))
    fields = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, span_starts array<bigint>, span_ends array<bigint>" + ", kept_text string" * texts
    return conclude(batches, one.unionByName(two), lambda d, a: cut_documents(d, a, length, n_bins, texts), fields)
