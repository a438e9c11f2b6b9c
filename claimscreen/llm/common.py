"""What the corpus operators share: shared storage, word rules, bounded bitmaps, document keys."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but ASCII white space; bytes.split() cuts at the same six characters.
WORD_GAP = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; a temporary one only where one machine is the cluster, as in tests."""
    if root := spark.conf.get("spark.checkpoint.dir", None):
        return root.rstrip("/")
    if not spark.sparkContext.getCheckpointDir():
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="claimscreen-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/claimscreen-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read again: a replicated cut of the lineage with known size."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete the folders of stored tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_path).getParent()
        path.getFileSystem(df.sparkSession._jsc.sc().hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Give up what finished queries have left: Spark deletes their shuffle files and broadcasts when the driver collects its garbage.

    In a row of many short queries it would collect late, as its heap grows first.
    """
    gc.collect()
    spark._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once a session: their Python need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_claimscreen_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="claimscreen-code-")) / "claimscreen_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._claimscreen_shipped = True


def trimmed(results: Iterator) -> Iterator:
    """The results as they come; before each is asked for, memory that earlier batches have freed goes back to the system, as workers outlive their tasks."""
    import pyarrow as pa

    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    for x in results:
        yield x
        del x
        pa.default_memory_pool().release_unused()
        if trim:
            trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty) alone, so further columns cannot clash with an operator's own."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def row_key() -> Column:
    """Names a document row together with doc_id: rows that repeat an id with another text stay apart."""
    return F.xxhash64("doc_id", "text")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def held(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns that are computed once a row.

    A generator of one row makes them: the optimizer copies the expressions of an
    ordinary projection into every later use, filters and lambdas included.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def fixed_bits(n: int, per_item: int = 16, least: int = 1 << 16, most: int = 1 << 26) -> int:
    """Bits of a bitmap for n hashes: a power of two, so that few others pass, between bounds (8 MB at most)."""
    return min(most, max(least, 1 << max(0, n * per_item - 1).bit_length()))


def one_row_bitmap(hashes: DataFrame, column: str, bits: int) -> DataFrame:
    """One row, __bitmap: an array of bits / 64 longs with the bits set that the hashes' low bits name. bits: a power of two, 64 at least."""
    spark = hashes.sparkSession
    at = F.col(column).bitwiseAND(bits - 1)
    filled = hashes.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("set"))
    dense = spark.range(0, bits // 64, 1, 1).join(filled, F.col("id") == F.col("cell"), "left").select("id", F.coalesce("set", F.lit(0).cast("bigint")).alias("set"))
    return stored(dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "set"))), lambda x: x["set"]).alias("__bitmap")), "bitmap")


def literal_bitmap(hashes: DataFrame, column: str, bits: int) -> str:
    """SQL of the same array as a literal, which lambdas read without a copy a row. It is part of the plan's text: bits must be few."""
    at = F.col(column).bitwiseAND(bits - 1)
    filled = hashes.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("set"))
    cells = [0] * (bits // 64)
    for r in filled.collect():  # bits / 64 rows at most
        cells[r["cell"]] = r["set"]
    return f"cast(split('{','.join(map(str, cells))}', ',') as array<bigint>)"


def in_bitmap(bitmap: str, value: str, bits: int) -> str:
    """SQL: whether the bit of value is set."""
    return f"getbit(element_at({bitmap}, cast(shiftright({value} & {bits - 1}L, 6) + 1 as int)), cast({value} & 63L as int)) = 1"


def possibly_among(rows: DataFrame, value: str, hashes: DataFrame, column: str) -> DataFrame:
    """rows whose value, or one of whose values if it is an array, may be one of the hashes: a filter before a join, so that only likely partners are shuffled.

    hashes: a stored table. One row with a bitmap is broadcast, whose size follows
    their number up to fixed_bits' bound. Where they are too many for that to hold
    anything back, rows are returned as they are and the join does all the work.
    """
    n = hashes.count()
    bits = fixed_bits(n)
    if n > 2 * bits:
        return rows
    test = in_bitmap("__bitmap", "v", bits)
    kept = f"exists({value}, v -> {test})" if rows.schema[value].dataType.typeName() == "array" else in_bitmap("__bitmap", value, bits)
    # A semi join: an inner one would copy the bitmap into every row that passes.
    return rows.join(F.broadcast(one_row_bitmap(hashes, column, bits)), F.expr(kept), "left_semi")


def carried(docs: DataFrame, **columns: Column) -> DataFrame:
    """row (all columns of docs) and further columns: whatever docs calls its own, names cannot clash. select("row.*") gives docs back."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])
