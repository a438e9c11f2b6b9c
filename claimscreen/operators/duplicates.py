"""Exact and near duplicates of claims."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscreen.config import ScreenConfig
from claimscreen.functions.scalar import charge_similarity, flag

#: Days, in windows of near duplicates, of a span in which claims are looked at for neighbours, and of a cell in which they are joined.
SPAN, CELL = 12, 4
KEY = ["patient_id", "provider_id", "procedure_code", "service_date", "charge_amount"]


def exact_duplicates(claims: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """All but the lowest claim id of rows that agree in the five key columns.

    Rows are grouped by the columns, so NULLs match each other and ids holding
    the separator cannot collide; duplicate_key is for display. within: columns
    that follow from the key and by which rows already lie together.
    """
    by_id = Window.partitionBy(*within, *KEY).orderBy("claim_id")
    out = claims.withColumns(
        {
            "duplicate_key": F.concat_ws("|", *[F.col(c).cast("string") for c in KEY]),
            "duplicate_rank": F.row_number().over(by_id),
            "first_claim_in_group": F.first("claim_id").over(by_id),
        }
    )
    extra = F.col("duplicate_rank") > 1
    return out.withColumns({"is_exact_duplicate": extra, "exact_duplicate_of": F.when(extra, F.col("first_claim_in_group"))})


def compared_by(cfg: ScreenConfig) -> list[str]:
    """What near duplicates have in common."""
    whole = cfg.nonnegative_charges and cfg.duplicate_similarity_threshold > cfg.charge_weight
    return ["patient_id", "provider_id", *["procedure_code"] * whole]


def patient_marks(claims: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """provider_id, service_date, patient_id, procedure_code, often, near: claims of a patient's day over the limit (often)
    and claims with another one in their window of near duplicates (near), each once; others are left out.

    Short rows without ids or amounts are dealt by patient and span of days. Days near the
    edge of a span are in the next one too, where only others look at them.
    """
    reach = max(1, cfg.duplicate_time_window_days)
    day, span = F.unix_date("service_date"), SPAN * reach
    home = F.floor(day / span)
    rows = claims.select("provider_id", "service_date", "patient_id", "procedure_code")
    beside = [F.coalesce(F.floor((day + d) / span) - home, F.lit(0)).cast("int") for d in (-reach, reach)]
    rows = rows.withColumn("__edge", F.explode(F.array_distinct(F.array(F.lit(0), *beside))))
    rows = rows.repartition("patient_id", home + F.col("__edge")).withColumns({"__span": home + F.col("__edge"), "__home": F.col("__edge") == 0})
    by_day = Window.partitionBy("patient_id", "__span", "service_date")
    in_time = Window.partitionBy("patient_id", "__span", *compared_by(cfg)[1:]).orderBy("service_date")
    rows = rows.withColumn("often", F.count_if("__home").over(by_day) > cfg.max_claims_per_patient_per_day)
    close = (day - F.lag(day).over(in_time) <= reach) | (F.lead(day).over(in_time) - day <= reach)
    known = [F.col(c).isNotNull() for c in compared_by(cfg)]
    rows = rows.withColumn("near", flag(reduce(Column.__and__, known, close))).filter("__home and (often or near)")
    # A claim's rows lie together, by patient and span, already.
    marks = rows.groupBy("patient_id", "__span", "provider_id", "service_date", "procedure_code").agg(F.max("often").alias("often"), F.max("near").alias("near"))
    return marks.drop("__span")


def near_matches(claims: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """The key columns, near_duplicate_of, similarity_score: the best lower-id partner of the first claim of each exact group.

    A score depends on the key columns alone and its ties go to the lower id, so
    no claim but the first of a group can be a best partner: only those are
    compared. Claims without a neighbour in their span of days, and away from its
    edges, have no partner and are left out after one shuffle. For the rest the
    date band is part of the join key: days fall into cells, and the lower-id
    side is placed in each cell that its window touches, so a hot (patient,
    provider) pair spreads over its dates. The best partner is a map-side
    combined minimum; score ties go to the lower id.
    """
    reach = max(1, cfg.duplicate_time_window_days)
    day = F.unix_date("service_date")
    group = compared_by(cfg)
    span = SPAN * reach
    rows = claims.select("claim_id", *KEY, F.floor(day / span).alias("__span"))
    rows = rows.dropna(subset=[*group, "__span"]).repartition(*group, "__span")
    heads = rows.groupBy(*KEY, "__span").agg(F.min("claim_id").alias("__id"))
    heads = heads.withColumn("__n", F.count("*").over(Window.partitionBy(*group, "__span")))
    place = F.pmod(day, F.lit(span))
    heads = heads.filter((F.col("__n") > 1) | (place < reach) | (place >= span - reach))
    width = CELL * reach
    left = heads.select(F.col("__id").alias("l_id"), *[F.col(c).alias(f"l_{c}") for c in KEY], day.alias("l_day"), F.floor(day / width).alias("l_cell"))
    touched = F.explode(F.sequence(F.floor((day - reach) / width), F.floor((day + reach) / width)))
    right = heads.select(F.col("__id").alias("r_id"), *[F.col(c).alias(f"r_{c}") for c in KEY if c != "service_date"], day.alias("r_day"), touched.alias("r_cell"))
    on = [left[f"l_{c}"] == right[f"r_{c}"] for c in group]
    on += [left["l_cell"] == right["r_cell"], left["l_id"] > right["r_id"], F.abs(left["l_day"] - right["r_day"]) <= cfg.duplicate_time_window_days]
    same = (F.col("l_procedure_code") == F.col("r_procedure_code")).cast("double")
    close = charge_similarity(F.col("l_charge_amount"), F.col("r_charge_amount"), absolute=cfg.absolute_charge_similarity)
    score = F.round(cfg.procedure_weight * same + cfg.charge_weight * close, 9)
    keys = [f"l_{c}" for c in KEY]
    pairs = left.join(right, on).select(*keys, "l_id", "r_id", score.alias("score")).filter(F.col("score") >= cfg.duplicate_similarity_threshold)
    best = pairs.groupBy(*keys, "l_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "r_id")).alias("b"))
    return best.select(*[F.col(k).alias(c) for k, c in zip(keys, KEY, strict=True)], F.col("b.r_id").alias("near_duplicate_of"), (-F.col("b.s")).alias("similarity_score"))


def with_near_matches(marked: DataFrame, best: DataFrame) -> DataFrame:
    """Rows of exact_duplicates plus the best near match of each group's first claim.

    They are joined by the key columns, under which the rows already lie together,
    so they are not shuffled again.
    """
    best = best.select(*[F.col(c).alias(f"__{c}") for c in KEY], "near_duplicate_of", "similarity_score")
    on = [marked[c] == best[f"__{c}"] for c in KEY]
    out = marked.join(best, [*on, marked["duplicate_rank"] == 1, marked["claim_id"].isNotNull()], "left")
    return out.select(*[marked[c] for c in marked.columns], "near_duplicate_of", "similarity_score", F.col("near_duplicate_of").isNotNull().alias("is_near_duplicate"))


def near_duplicates(marked: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Rows of exact_duplicates plus the best near match. Claim ids are taken to be unique."""
    return with_near_matches(marked, near_matches(marked, cfg))


def summary(near: Column) -> dict[str, Column]:
    """is_duplicate, duplicate_of from the columns of both kinds."""
    return {"is_duplicate": F.col("is_exact_duplicate") | near, "duplicate_of": F.coalesce("exact_duplicate_of", "near_duplicate_of")}


def find_duplicates(claims: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    out = near_duplicates(exact_duplicates(claims), cfg)
    return out.withColumns(summary(F.col("is_near_duplicate")))
