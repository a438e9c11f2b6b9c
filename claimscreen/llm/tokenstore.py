"""Token ids in binary shards with minimal perfect hash indexes.

A store is a folder with two Parquet tables written by Spark, so any file system
Spark can write to will do, and lost executors are the writer's business:

- shards(part, seq, n_docs, n_ids, data): data is one shard, laid out below
- routes(slot, data): for each slot of hashed keys, an index from key to shard

A shard holds documents in ascending doc_id order, as little-endian fields:
magic, id width, counts; the keys; the documents' starts; the key index; then
the raw ids, 2 bytes each while the vocabulary allows, else 4. An index maps n
keys to 0..n-1 without gaps by levels of bit arrays (a key settles on the first
level where no other key shares its bit), and stores a fingerprint and a value
for each, so an absent key is told from a present one in constant time.

Null texts are empty documents. Null and repeated doc_ids are stored and read by
scans; the index holds the first document of each id. Rows of one id are in the
order of their texts' hashes. No documents give a store without shards. Extra
columns are not read, whatever their names. Texts of any length are encoded whole,
and one document is never cut between shards.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimscreen.llm.common import id_and_text, partitions, ship_code, trimmed

MAGIC = b"CSTK0001"
NO_KEY = -(2**63)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of int64 keys."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


class PerfectIndex:
    """A minimal perfect hash over distinct int64 keys with 32-bit fingerprints and int64 values in its slots."""

    FINGERPRINT_SEED = 1_000

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray, values: np.ndarray) -> None:
        self.levels, self.prints, self.values = levels, prints, values
        self.ranks = []
        total = 0
        for bits in levels:
            counts = np.cumsum(np.bitwise_count(bits), dtype=np.int64)
            self.ranks.append(total + counts - np.bitwise_count(bits))
            total += int(counts[-1]) if len(counts) else 0

    @classmethod
    def build(cls, keys: np.ndarray, values: np.ndarray, gamma: float = 2.0) -> PerfectIndex:
        levels, left = [], keys.astype(np.int64)
        while len(left):
            cells = -(-int(len(left) * gamma + 64) // 64)
            at = mixed(left, len(levels)) % np.uint64(cells * 64)
            spots, counts = np.unique(at, return_counts=True)
            alone = spots[counts == 1]
            bits = np.zeros(cells, dtype=np.uint64)
            np.bitwise_or.at(bits, (alone >> np.uint64(6)).astype(np.int64), np.uint64(1) << (alone & np.uint64(63)))
            levels.append(bits)
            left = left[~np.isin(at, alone)]
            if len(levels) > 200:
                raise ValueError("keys are not distinct")
        index = cls(levels, np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64))
        slots = index.slots(keys)
        index.prints[slots] = index.fingerprint(keys)
        index.values[slots] = values
        return index

    def fingerprint(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys, self.FINGERPRINT_SEED) >> np.uint64(32)).astype(np.uint32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; -1 for keys that no level holds."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = mixed(keys[left], level) % np.uint64(len(bits) * 64)
            cell, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            here = (bits[cell] >> bit) & np.uint64(1) == 1
            lower = bits[cell] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[here]] = (ranks[cell] + np.bitwise_count(lower))[here]
            left = left[~here]
        return out

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys; -1 where the fingerprint says the key is not in the index."""
        keys = np.asarray(keys, dtype=np.int64)
        if not len(self.values):
            return np.full(len(keys), -1, dtype=np.int64)
        s = self.slots(keys)
        known = (s >= 0) & (self.prints[np.maximum(s, 0)] == self.fingerprint(keys))
        return np.where(known, self.values[np.maximum(s, 0)], -1)

    def dump(self) -> bytes:
        head = struct.pack("<II", len(self.levels), len(self.values)) + struct.pack(f"<{len(self.levels)}I", *map(len, self.levels))
        return head + b"".join(b.astype("<u8").tobytes() for b in self.levels) + self.values.astype("<i8").tobytes() + self.prints.astype("<u4").tobytes()

    @classmethod
    def load(cls, data: bytes, at: int = 0) -> PerfectIndex:
        n_levels, n = struct.unpack_from("<II", data, at)
        sizes = struct.unpack_from(f"<{n_levels}I", data, at + 8)
        at += 8 + 4 * n_levels
        levels = []
        for size in sizes:
            levels.append(np.frombuffer(data, "<u8", size, at))
            at += 8 * size
        values = np.frombuffer(data, "<i8", n, at)
        return cls(levels, np.frombuffer(data, "<u4", n, at + 8 * n), values)


def pack_shard(keys: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """One shard of documents in their order."""
    n = len(keys)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
    first: dict[int, int] = {}
    for i, k in enumerate(keys):
        if k is not None:
            first.setdefault(k, i)
    index = PerfectIndex.build(np.fromiter(first.keys(), np.int64, len(first)), np.fromiter(first.values(), np.int64, len(first))).dump()
    named = np.array([k is not None for k in keys], dtype=np.uint8)
    head = struct.pack("<8sIIQI", MAGIC, width, n, int(starts[-1]), len(index))
    plain = np.array([NO_KEY if k is None else k for k in keys], dtype="<i8")
    return b"".join([head, plain.tobytes(), named.tobytes(), starts.astype("<i8").tobytes(), index, *[x.astype(f"<u{width}").tobytes() for x in ids]])


class Shard:
    """A shard as read back."""

    def __init__(self, data: bytes) -> None:
        magic, self.width, self.n, n_ids, index_bytes = struct.unpack_from("<8sIIQI", data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize("<8sIIQI")
        self.keys = np.frombuffer(data, "<i8", self.n, at)
        self.named = np.frombuffer(data, np.uint8, self.n, at + 8 * self.n).astype(bool)
        at += 9 * self.n
        self.starts = np.frombuffer(data, "<i8", self.n + 1, at)
        at += 8 * (self.n + 1)
        self.index = PerfectIndex.load(data, at)
        self.payload = np.frombuffer(data, f"<u{self.width}", n_ids, at + index_bytes)

    def ids(self, i: int) -> np.ndarray:
        return self.payload[self.starts[i] : self.starts[i + 1]]

    def get(self, key: int) -> np.ndarray | None:
        """Ids of a document by its key, in constant time."""
        i = int(self.index.get(np.array([key]))[0])
        return None if i < 0 or self.keys[i] != key else self.ids(i)


def cuts_at_blanks(tokenizer, path: str) -> bool:
    """Whether a text's ids are those of its pieces between ASCII blanks, in turn.

    So it is where the first step before the model drops white space and keeps
    nothing that holds any; a few joined pieces put that to the test. Of any other
    tokenizer (one that marks blanks, say) whole texts are encoded.
    """
    with open(path, encoding="utf-8") as f:
        step = json.load(f).get("pre_tokenizer") or {}
    step = (step.get("pretokenizers") or [{}])[0] if step.get("type") == "Sequence" else step
    dropping = step.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer") or (step.get("type") == "Split" and step.get("behavior") == "Removed" and step.get("invert"))
    pieces = ["a", "Word", "12", "'s", "...", "\u00e9", "e\u0301", "\u0301", "#a-b", "\u4e2d\u6587"]
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    return dropping and all(ids(f"{x}{blank}{y}") == ids(x) + ids(y) and ids(f"{blank}{x}{blank}") == ids(x) for blank in " \t\n\x0b\x0c\r" for x in pieces for y in pieces)


#: Pieces whose ids a worker keeps: some 120 MB.
KEEP = 600_000
#: Words, digits and the rest apart: of a tokenizer that cuts so after lower-casing, ASCII pieces fall into shorter ones that recur more often.
WORDS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Pieces for which that holds by the pattern: no apostrophe, and no < that may begin a special token.
PLAIN = r"^[!-&(-;=-~]+$"


def cuts_at_letters(tokenizer, path: str) -> bool:
    """Whether a PLAIN piece's ids are those of its runs of letters and of other characters in lower case, in turn."""
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    normal, step = config.get("normalizer") or {}, config.get("pre_tokenizer") or {}
    kinds = [x.get("type") for x in (normal.get("normalizers") or [] if normal.get("type") == "Sequence" else [normal])]
    step = (step.get("pretokenizers") or [{}])[0] if step.get("type") == "Sequence" else step
    known = "Lowercase" in kinds and set(kinds) <= {"NFC", "Replace", "Lowercase"} and (step.get("pattern") or {}).get("Regex") == WORDS_APART
    special = all(t["content"].startswith("<") for t in config.get("added_tokens") or [])
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    probes = ["Word,", "(A1b22)", "x...Y", "e.g.", "#Tag_3", "-a--B-", "$5.00", "HANT,!!", "a|>b", '"Q"']
    alone = lambda text: [t.id for t in tokenizer.model.tokenize(text)]
    known = known and all(ids(x) == alone(x) for x in ("a", "the", "internationally", "zqxjkvb"))
    return known and special and all(ids(x) == [i for c in runs_apart(pa.array([x]))[0].as_py() for i in ids(c)] for x in probes)


def runs_apart(pieces: pa.Array) -> pa.Array:
    """A list for each piece: the runs of a PLAIN one in lower case, any other piece alone."""
    spaced = pc.ascii_trim_whitespace(pc.replace_substring_regex(pc.ascii_lower(pieces), r"([a-z]+)", r" \1 "))
    return pc.ascii_split_whitespace(pc.if_else(pc.match_substring_regex(pieces, PLAIN), spaced, pieces))


class Pieces:
    """Ids of pieces of text, each encoded once and kept in one array; all are dropped at `keep` pieces.

    New pieces are encoded many at a time, with a blank between them; ids are told
    apart by their place in that text. model: the tokenizer's, where it takes words
    of a to z as they are, without what comes before it.
    """

    TOGETHER = 256

    def __init__(self, tokenizer, keep: int = KEEP, model=None) -> None:
        self.tokenizer, self.keep, self.model = tokenizer, keep, model
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.lengths, self.pool = (np.zeros(0, np.int32) for _ in range(3))

    def of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First place in the pool, and length, of each distinct piece."""
        if len(self.place) > self.keep:
            self.clear()
        if new := [p for p in pieces if p not in self.place]:
            words, rest = [], new
            if self.model is not None:
                words = [p for p in new if p.isascii() and p.isalpha() and p.islower()]
                rest = [p for p in new if not (p.isascii() and p.isalpha() and p.islower())]
                new = words + rest
            found = [[t.id for t in self.model.tokenize(p)] for p in words]
            lengths = [np.fromiter(map(len, found), np.int64, len(found))]
            ids = [np.fromiter((i for x in found for i in x), np.int32, int(lengths[0].sum()))]
            for i in range(0, len(rest), self.TOGETHER):
                some = rest[i : i + self.TOGETHER]
                found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
                sizes = np.fromiter(map(len, some), np.int64, len(some)) + 1
                owner = np.searchsorted(np.cumsum(sizes) - sizes, np.array([x for x, _ in found.offsets], np.int64), side="right") - 1
                ids.append(np.array(found.ids, np.int32))
                lengths.append(np.bincount(owner, minlength=len(some)))
            lengths = np.concatenate(lengths)
            self.starts = np.concatenate([self.starts, (len(self.pool) + np.cumsum(lengths) - lengths).astype(np.int32)])
            self.lengths, self.pool = np.concatenate([self.lengths, lengths.astype(np.int32)]), np.concatenate([self.pool, *ids])
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        at = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        return self.starts[at].astype(np.int64), self.lengths[at].astype(np.int64)


def gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pool's runs number `at`, one after the other, and where each ends."""
    lengths = lengths[at]
    ends = np.cumsum(lengths)
    # From each place to the next one, the pool is read on; where a run begins, from its start.
    return pool[np.repeat(starts[at] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)], ends


@lru_cache(maxsize=4)
def encoder(path: str, keep: int = KEEP) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Whole texts to their ids, one after the other, and the number of ids of each."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def whole(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.int64, int(counts.sum())), counts

    if not cuts_at_blanks(tokenizer, path):
        return whole
    apart = cuts_at_letters(tokenizer, path)
    known = Pieces(tokenizer, keep, tokenizer.model if apart else None)

    def of(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and the first place in it and the length of each distinct piece."""
        if not apart:
            starts, lengths = known.of(pieces.to_pylist())
            return known.pool, starts, lengths
        parts = runs_apart(pieces)
        coded = parts.flatten().dictionary_encode()
        starts, lengths = known.of(coded.dictionary.to_pylist())
        pool, ends = gathered(known.pool, starts, lengths, coded.indices.to_numpy(zero_copy_only=False))
        edges = np.concatenate([[0], ends])[np.asarray(parts.offsets) - parts.offsets[0].as_py()]
        return pool, edges[:-1], np.diff(edges)

    def by_pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = cut.flatten().dictionary_encode()
        ids, ends = gathered(*of(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False))
        edges = np.concatenate([[0], ends])[np.asarray(cut.offsets) - cut.offsets[0].as_py()]
        return ids, np.diff(edges)

    return by_pieces


def portions(texts: pa.Array, most: int = 4 << 20) -> Iterator[pa.Array]:
    """Slices of about `most` bytes, one text at least."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield texts.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(texts):
        yield texts.slice(start)


def id_width(path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, shard_bytes: int = 2 << 20) -> None:
    """Encode docs (doc_id, text) into a store at path, in ascending order of doc_id, nulls first."""
    ship_code(docs.sparkSession)
    spark = docs.sparkSession
    width = id_width(tokenizer)
    fields = "part int, seq int, n_docs bigint, n_ids bigint, keys array<bigint>, data binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype=f"<u{width}")
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        size = 0

        def shard() -> pa.RecordBatch:
            row = {"part": [part], "seq": [seq], "n_docs": [len(keys)], "n_ids": [sum(map(len, ids))], "keys": [keys], "data": [pack_shard(keys, ids, width)]}
            return pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("keys", pa.list_(pa.int64())), ("data", pa.binary())]))

        for batch in batches:
            names, row = batch.column(0).to_pylist(), 0
            for texts in portions(batch.column(1)):
                flat, counts = run(texts)
                flat, edges = flat.astype(end.dtype), np.concatenate([[0], np.cumsum(counts)]).tolist()
                for lo, hi in zip(edges[:-1], edges[1:]):
                    keys.append(names[row])
                    ids.append(np.concatenate([flat[lo:hi], end]))
                    size += width * (hi - lo + 1)
                    row += 1
                    if size >= shard_bytes:
                        yield shard()
                        keys, ids, size, seq = [], [], 0, seq + 1
        if keys:
            yield shard()

    rows = id_and_text(docs)
    # The text's hash splits ranges of one repeated id and fixes the order of its rows.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    placed = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    placed.mapInArrow(lambda batches: trimmed(encode(batches)), fields).write.mode("overwrite").parquet(f"{path}/shards")
    write_routes(spark, path)


def write_routes(spark: SparkSession, path: str, keys_per_slot: int = 200_000) -> None:
    """Indexes from hashed keys to (part, seq). The number of slots follows the number of documents."""
    shards = spark.read.parquet(f"{path}/shards")
    n_docs = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n")).first()["n"]
    slots = max(partitions(spark), -(-n_docs // keys_per_slot))
    each = shards.select("part", "seq", F.explode("keys").alias("doc_id")).filter("doc_id is not null")
    each = each.groupBy("doc_id").agg(F.min(F.struct("part", "seq")).alias("s"))
    each = each.select("doc_id", (F.shiftleft(F.col("s.part").cast("bigint"), 32) + F.col("s.seq")).alias("place"), F.pmod(F.xxhash64("doc_id"), F.lit(slots)).alias("slot"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        data = PerfectIndex.build(pdf["doc_id"].to_numpy(np.int64), pdf["place"].to_numpy(np.int64)).dump()
        return pd.DataFrame({"slot": [int(pdf["slot"].iloc[0])], "slots": [slots], "data": [data]})

    each.groupBy("slot").applyInPandas(build, "slot bigint, slots bigint, data binary").write.mode("overwrite").parquet(f"{path}/routes")


def lookup(spark: SparkSession, path: str, ids: list[int]) -> dict[int, np.ndarray]:
    """Token ids of a few documents by key: one route slot and one shard are read for each, and nothing is scanned within them."""
    routes = spark.read.parquet(f"{path}/routes")
    if (head := routes.select("slots").first()) is None or not ids:
        return {}
    wanted = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(head["slots"])).alias("slot"))
    slot_of = {r["doc_id"]: r["slot"] for r in wanted.collect()}
    found = {r["slot"]: PerfectIndex.load(r["data"]) for r in routes.filter(F.col("slot").isin(list(set(slot_of.values())))).collect()}
    places = {i: int(found[s].get(np.array([i]))[0]) for i, s in slot_of.items() if s in found}
    need = {p for p in places.values() if p >= 0}
    if not need:
        return {}
    at = F.shiftleft(F.col("part").cast("bigint"), 32) + F.col("seq")
    parts = list({p >> 32 for p in need})
    shards = spark.read.parquet(f"{path}/shards").filter(F.col("part").isin(parts) & at.isin(list(need))).select(at.alias("place"), "data")
    opened = {r["place"]: Shard(r["data"]) for r in shards.collect()}
    out = {i: opened[p].get(i) for i, p in places.items() if p in opened}
    return {i: x for i, x in out.items() if x is not None}


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, fetched through each shard's index where it holds the document."""
    ship_code(spark)
    shards = spark.read.parquet(f"{path}/shards")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                shard = Shard(data)
                at = np.where(shard.named, shard.index.get(shard.keys), -1)
                # The index holds the first document of an id; the others follow it in order.
                own = np.where((at >= 0) & (shard.keys[np.maximum(at, 0)] == shard.keys), at, np.arange(shard.n))
                repeated = np.concatenate([[False], (shard.keys[1:] == shard.keys[:-1]) & shard.named[1:]])
                own = np.where(repeated | ~shard.named, np.arange(shard.n), own)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part] * shard.n, pa.int32()),
                        "seq": pa.array([seq] * shard.n, pa.int32()),
                        "doc_id": pa.array(shard.keys, pa.int64(), mask=~shard.named),
                        "at": pa.array(shard.starts[own], pa.int64()),
                        "n_tokens": pa.array(shard.starts[own + 1] - shard.starts[own], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(shard.ids(i).astype("<u4").tobytes()) for i in own], pa.int64()),
                    }
                )

    each = shards.select("part", "seq", "data").mapInArrow(lambda batches: trimmed(digest(batches)), "part int, seq int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint")
    sizes = shards.select("part", "seq", "n_ids")
    parts = sizes.groupBy(F.col("part").alias("p")).agg(F.sum("n_ids").alias("all"))
    before = F.coalesce(F.sum("all").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.withColumn("w", within).join(parts.withColumn("b", before), F.col("part") == F.col("p"))
    bases = bases.select(F.col("part").alias("p"), F.col("seq").alias("s"), (F.col("w") + F.col("b")).alias("base"))
    out = each.join(bases, (each["part"] == bases["p"]) & (each["seq"] == bases["s"]))
    return out.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
