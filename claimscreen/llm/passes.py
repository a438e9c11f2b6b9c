"""Several passes over documents that ask questions about the whole corpus.

Documents are dealt once into batches, kept as a table bucketed by batch. A pass
sends folded hashes of a batch to bins; a bin answers each batch, and answers
come back to the batch for the next pass. Only answers are shuffled for that: the
texts stay where their bucket is. Folding means that a hash leaves a batch once,
however many of its documents hold it, so a bin meets a hot hash at most once a
batch. Batches and bins follow spark.sql.shuffle.partitions, as the cluster sets
it for its input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscreen.llm.common import id_and_text, partitions, ship_code

NO_ID = -(2**63)
ANSWER = "batch bigint, kind int, bin int, data binary"


def dealt(docs: DataFrame) -> DataFrame:
    """batch, number (NO_ID for a null id), text of every row, bucketed by batch. Rows of one id and text share a batch.

    There are as many batches as shuffle partitions, named so that each has a
    bucket of its own. The table stays in the session's catalog.
    """
    spark = docs.sparkSession
    ship_code(spark)
    n = partitions(spark)
    name = F.pmod(F.hash("id"), F.lit(n))
    names = {r["b"]: r["v"] for r in spark.range(0, 40 * n, 1, 1).groupBy(name.alias("b")).agg(F.min("id").alias("v")).collect()}
    listed = F.split(F.lit(",".join(str(names.get(b, b)) for b in range(n))), ",").cast("array<bigint>")
    batch = F.get(listed, F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))
    rows = id_and_text(docs).select(batch.alias("batch"), F.coalesce("doc_id", F.lit(NO_ID)).alias("number"), "text")
    table = f"claimscreen_batches_{uuid.uuid4().hex}"
    rows.repartition(n, "batch").write.format("parquet").bucketBy(n, "batch").saveAsTable(table)
    return spark.table(table)


def in_order(table: pa.Table) -> list[tuple[int, str]]:
    """A batch's documents in an order that does not depend on how they arrive."""
    return sorted(zip(table["number"].to_pylist(), table["text"].to_pylist(), strict=True))


def ask(batches: DataFrame, f: Callable[[list[tuple[int, str]]], Iterator[tuple[int, int, dict]]], fields: str) -> DataFrame:
    """batch, kind, bin and the fields of every (kind, bin, values) that f yields for a batch."""
    schema = to_arrow(fields)

    def run(table: pa.Table) -> pa.Table:
        return to_table(int(table["batch"][0].as_py()), f(in_order(table)), schema)

    return batches.groupBy("batch").applyInArrow(run, f"batch bigint, kind int, bin int, {fields}")


def ask_again(batches: DataFrame, answers: DataFrame, f: Callable, fields: str) -> DataFrame:
    """The same with f(documents, answers); answers maps (kind, bin) to data."""
    schema = to_arrow(fields)

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return to_table(0, iter(()), schema)
        return to_table(int(table["batch"][0].as_py()), f(in_order(table), answers_of(told)), schema)

    return batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(run, f"batch bigint, kind int, bin int, {fields}")


def conclude(batches: DataFrame, answers: DataFrame, f: Callable[[list[tuple[int, str]], dict], Iterator[dict]], fields: str) -> DataFrame:
    """Rows of f(documents, answers)."""
    schema = to_arrow(fields)

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(list(f(in_order(table), answers_of(told))) if table.num_rows else [], schema)

    return batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(run, fields)


def answer(asked: DataFrame, f: Callable[[int, pa.Table], list[bytes]]) -> DataFrame:
    """What f(kind, rows of a bin) says to each row's batch; empty answers are not sent."""
    schema = to_arrow(ANSWER)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("batch")
        kind, at = int(table["kind"][0].as_py()), int(table["bin"][0].as_py())
        told = [(b, d) for b, d in zip(table["batch"].to_pylist(), f(kind, table), strict=True) if d]
        return pa.Table.from_pydict({"batch": [b for b, _ in told], "kind": [kind] * len(told), "bin": [at] * len(told), "data": [d for _, d in told]}, schema)

    return asked.groupBy("kind", "bin").applyInArrow(run, ANSWER)


def answers_of(told: pa.Table) -> dict[tuple[int, int], bytes]:
    return {(k, b): d for k, b, d in zip(told["kind"].to_pylist(), told["bin"].to_pylist(), told["data"].to_pylist(), strict=True)}


def to_arrow(fields: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in fields.split(", "))])


def to_table(batch: int, rows: Iterator[tuple[int, int, dict]], schema: pa.Schema) -> pa.Table:
    rows = list(rows)
    first = {"batch": pa.array([batch] * len(rows), pa.int64()), "kind": pa.array([k for k, _, _ in rows], pa.int32()), "bin": pa.array([b for _, b, _ in rows], pa.int32())}
    return pa.table(first | {f.name: pa.array([v[f.name] for _, _, v in rows], f.type) for f in schema})


def packed(values: np.ndarray) -> bytes:
    """Bytes of equal weight next to each other: high bytes of small numbers compress away."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes() if len(values) else b""


def unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel() if data else np.zeros(0, kind)


def bins_of(h: np.ndarray, n_bins: int) -> np.ndarray:
    return (h >> np.uint64(33)) % np.uint64(n_bins)


def by_bin(bins: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bin with the positions that fall into it, in their order."""
    order = np.argsort(bins, kind="stable")
    cuts = np.flatnonzero(np.diff(bins[order])) + 1
    for at in np.split(order, cuts) if len(order) else []:
        yield int(bins[at[0]]), at


def rows_of(lengths: list[int]) -> Iterator[slice]:
    start = 0
    for n in lengths:
        yield slice(start, start + n)
        start += n


def finish(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial's value over all 64 bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def rabin_karp(values: np.ndarray, window: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Polynomial hash of every run of window values (uint64), built from runs of powers of two."""
    n = len(values) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out, done, run, width = None, 0, values, 1
        left = window
        while left:
            if left & 1:
                piece = run[done : done + n]
                out = piece.copy() if out is None else out * np.uint64(pow(base, width, 2**64)) + piece
                done += width
            left >>= 1
            if left:
                run = run[: len(run) - width] * np.uint64(pow(base, width, 2**64)) + run[width:]
                width *= 2
    return finish(out)


def minimizer_starts(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of width hashes, the place of the smallest (by its upper half; the leftmost of equal ones)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    run = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    done = 1
    while done * 2 <= width:
        run = np.minimum(run[:-done], run[done:])
        done *= 2
    if done < width:
        run = np.minimum(run[:n], run[width - done : width - done + n])
    return (run[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
