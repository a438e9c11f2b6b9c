"""Claims from a star schema of orders and line items; also where the planted copies come from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscreen.operators.grouped import packed, shared, small_value, unpacked


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Whole numbers of a row and the bits they travel in, by the longs that hold them.
LONGS = [
    {"l_orderkey": 35, "l_shipdate": 16, "l_linenumber": 4, "kind": 3, "c_nationkey": 5},
    {"l_suppkey": 29, "price": 29, "s_nationkey": 5},
    {"l_partkey": 30, "o_custkey": 31, "copy": 2},
]
#: How the kinds of line items make cents of a price: (price * TIMES + PLUS) div BY * AGAIN.
TIMES, PLUS, BY, AGAIN = (5, 1, 3, 1, 1), (50, 500000, 50, 200, 50), (100, 1000000, 100, 400, 100), (1, 10000, 1, 1, 1)
#: Letters of the copies of a line item.
COPIES = ["A", "B", "C"]


def claims_from_star(spark: SparkSession, sf_dir: str, *, placed: bool = False) -> DataFrame:
    """One claim a line item (suffix -A), exact copies (-B) and near copies (-C). Amounts are computed in whole cents.

    Rows travel as packed whole numbers; texts are made where they arrive. placed:
    dealt by __at (see `place`), in one shuffle that all readers of the result share.
    """
    t = lambda name: table(spark, sf_dir, name)
    kind = (
        F.when((F.col("l_quantity") == 50) & (F.col("l_discount") >= 0.09), 0)
        .when(F.col("l_returnflag") == "R", 1)
        .when(F.col("l_suppkey") % 10 == 3, 2)
        .when(F.col("l_suppkey") % 10 == 4, 3)
        .otherwise(4)
    )
    rows = t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.unix_date(F.to_date("l_shipdate")).alias("l_shipdate"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price"), kind.alias("kind"),
    )
    # Orders meet their customers first: the many line items are shuffled once less.
    customers = t("customer").select("c_custkey", F.col("c_nationkey").alias("c_nation"))
    orders = t("orders").select("o_orderkey", F.col("o_custkey").alias("custkey")).join(customers, F.col("custkey") == F.col("c_custkey")).drop("c_custkey")
    small = packed(rows, LONGS)
    rows = unpacked(small.join(orders, small_value(small, LONGS, "l_orderkey") == F.col("o_orderkey")), LONGS, rows.columns, "custkey", "c_nation")
    rows = rows.withColumnsRenamed({"custkey": "o_custkey", "c_nation": "c_nationkey"})
    small = packed(rows, LONGS)
    rows = unpacked(small.join(t("part").select("p_partkey", "p_brand"), small_value(small, LONGS, "l_partkey") == F.col("p_partkey")), LONGS, rows.columns, "p_brand")
    small = packed(rows, LONGS, "p_brand")
    suppliers = t("supplier").select("s_suppkey", F.col("s_nationkey").alias("s_nation"))
    rows = unpacked(small.join(suppliers, small_value(small, LONGS, "l_suppkey") == F.col("s_suppkey")), LONGS, rows.columns, "p_brand", "s_nation")
    rows = rows.withColumnRenamed("s_nation", "s_nationkey")
    copies = F.array_compact(F.array(F.lit(0), F.when(F.col("l_orderkey") % 50 == 0, F.lit(1)), F.when(F.col("l_orderkey") % 40 == 0, F.lit(2))))
    rows = rows.withColumn("copy", F.explode(copies))
    names, rows = rows.columns, packed(rows, LONGS, "p_brand")
    value = lambda name: small_value(rows, LONGS, name)
    provider = value("l_suppkey").cast("string")
    day = F.date_add(F.date_from_unix_date(value("l_shipdate").cast("int")), F.when(value("copy") == 2, 7).otherwise(0))
    if placed:
        rows = shared(rows.repartition(F.xxhash64(provider, day)), rows.columns)
    at = [F.xxhash64(provider, day).alias("__at")] if placed else []
    rows = unpacked(rows, LONGS, names, "p_brand", provider.alias("provider_id"), day.alias("service_date"), *at)
    for who, nation in (("patient", "c_nationkey"), ("provider", "s_nationkey")):
        place = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias(f"{who}_nation"), F.col("r_name").alias(f"{who}_region"))
        rows = rows.join(F.broadcast(place), F.col(nation) == F.col(f"{who}_nation"))
    # Each number occurs once in the amount, as filters and branches copy it.
    one_of = lambda values: F.element_at(F.lit(list(values)), F.col("kind").cast("int") + 1)
    whole = lambda a, b: F.call_function("div", a, b)
    cents = whole(F.col("price") * one_of(TIMES) + one_of(PLUS), one_of(BY)) * one_of(AGAIN)
    near = F.col("copy") == 2
    cents = whole(cents * F.when(near, 105).otherwise(1) + F.when(near, 50).otherwise(0), F.when(near, 100).otherwise(1))
    shipped = F.date_format(F.date_from_unix_date(F.col("l_shipdate").cast("int")), "yyyyMMdd")
    base_id = F.format_string("%010d-%d-%08d-%06d-%s-%d", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shipped, "price")
    letter = F.element_at(F.array(*[F.lit(x) for x in COPIES]), F.col("copy").cast("int") + 1)
    places = [(base + F.col(nation) * step).alias(f"{who}_{name}") for who, nation in (("patient", "c_nationkey"), ("provider", "s_nationkey")) for name, base, step in (("lat", F.lit(20.0), 1), ("lon", F.lit(-120.0), 2))]
    return rows.select(
        F.concat_ws("-", base_id, letter).alias("claim_id"),
        F.col("o_custkey").cast("string").alias("patient_id"),
        "provider_id",
        F.col("p_brand").alias("procedure_code"),
        "service_date",
        (cents.cast("decimal(12,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(10,2)").alias("charge_amount"),
        F.when(F.col("l_suppkey") % 10 == 7, F.lit("OUT")).otherwise(F.col("patient_region")).alias("patient_state"),
        F.col("provider_region").alias("provider_state"),
        *places,
        *["__at"] * placed,
    )


def bundles(spark: SparkSession) -> DataFrame:
    """Fixed pairs of procedure codes billed together."""
    return spark.sql("SELECT * FROM VALUES ('X1', 'Brand#11', 'Brand#12'), ('X2', 'Brand#21', 'Brand#33'), ('X3', 'Brand#45', 'Brand#11') AS t(bundled_code, unbundled_code_1, unbundled_code_2)")
