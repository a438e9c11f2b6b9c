"""The whole screening plan: rules, statistics, duplicates, score. No driver action on the way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimscreen.config import ScreenConfig
from claimscreen.functions.scalar import flag, leading_digit
from claimscreen.operators import billing, duplicates, first_digit, geographic, outliers, score
from claimscreen.operators.grouped import at_place, shared, where_placed
from claimscreen.schema import require_columns

Rule = Callable[[DataFrame, ScreenConfig], DataFrame]


class ClaimScreen:
    """Screens claims. Further rules can be registered; they run after the built-in ones."""

    def __init__(self, config: ScreenConfig | None = None) -> None:
        self.config = config or ScreenConfig()
        self.extra_rules: list[Rule] = []

    def register(self, rule: Rule) -> Rule:
        self.extra_rules.append(rule)
        return rule

    def apply_rules(self, claims: DataFrame) -> DataFrame:
        return self.group_rules(self.row_rules(claims))

    def row_rules(self, claims: DataFrame) -> DataFrame:
        """The rules that look at one row."""
        return geographic.state_mismatch(geographic.distance(claims, self.config))

    def group_rules(self, claims: DataFrame) -> DataFrame:
        """The rules over a patient's or a provider's claims, and the registered ones."""
        cfg = self.config
        out = billing.patient_frequency(claims, cfg)
        out = billing.daily_procedure_limit(out, cfg)
        out = billing.provider_habits(out, cfg)
        for rule in self.extra_rules:
            out = rule(out, cfg)
        return out

    def apply_statistics(self, claims: DataFrame, column: str = "charge_amount", source: DataFrame | None = None) -> DataFrame:
        """The three table-wide checks from two rows of statistics over the source.

        The rows are broadcast, not scalar subqueries, which would not share the
        source's shuffles with the rest of the plan.
        """
        cfg = self.config
        source = (source or claims).select(column)
        stats = outliers.zscore_stats(column) | outliers.iqr_stats(column, cfg.quantile_accuracy)
        digits = first_digit.over_represented(source, column, cfg.first_digit_threshold).toDF("__digits")
        out = claims.crossJoin(F.broadcast(source.agg(*[c.alias(n) for n, c in stats.items()]))).crossJoin(F.broadcast(digits))
        return out.select(
            *claims.columns,
            outliers.zscore_flag(column, cfg.outlier_zscore_threshold).alias("charge_zscore_outlier"),
            outliers.iqr_flag(column, cfg.outlier_iqr_multiplier).alias("charge_iqr_outlier"),
            flag(F.array_contains("__digits", leading_digit(F.col(column)))).alias("benfords_anomaly"),
        )

    def detect_duplicates(self, claims: DataFrame, source: DataFrame | None = None) -> DataFrame:
        """The pair search reads the six columns it needs from the source, not the annotated plan."""
        source = claims if source is None else source
        out = duplicates.with_near_matches(duplicates.exact_duplicates(claims), duplicates.near_matches(source, self.config))
        return out.withColumns({"is_duplicate": F.col("is_exact_duplicate") | F.col("is_near_duplicate"), "duplicate_of": F.coalesce("exact_duplicate_of", "near_duplicate_of")})

    def flags_where_placed(self, rows: DataFrame) -> DataFrame:
        """The group rules' flags and the duplicates of rows that lie by place(), which whole rows do not leave.

        What is found elsewhere comes back as short rows for the few claims it
        concerns: patients' days and neighbours in time, providers' habits, near matches.
        """
        cfg = self.config
        daily = Window.partitionBy("__at", "provider_id", "service_date")
        out = rows.withColumn("daily_procedure_limit_exceeded", F.count("*").over(daily) > cfg.max_daily_procedures_per_provider)
        out = duplicates.exact_duplicates(out, within=["__at"])
        marks = duplicates.patient_marks(rows, cfg)
        near = where_placed(rows, marks.filter("near"), ["provider_id", "service_date", "patient_id", "procedure_code"], [], "left_semi")
        best = duplicates.near_matches(near, cfg)
        out = where_placed(out, marks, ["provider_id", "service_date", "patient_id", "procedure_code"], ["often"])
        out = where_placed(out, billing.habitual(rows, cfg), ["provider_id", "service_date"], ["weekend_habit", "round_habit"])
        out = where_placed(out, best, duplicates.KEY, ["near_duplicate_of", "similarity_score"], also=(F.col("duplicate_rank") == 1) & F.col("claim_id").isNotNull())
        weekend, rounded = billing.is_weekend(), billing.is_round(100)
        return out.withColumns(
            {
                "patient_frequency_exceeded": flag(F.col("often")),
                "weekend_billing_flag": flag(weekend & F.col("weekend_habit")),
                "round_amount_flag": flag(rounded & F.col("round_habit")),
                **duplicates.summary(F.col("near_duplicate_of").isNotNull()),
            }
        )

    def detect(self, claims: DataFrame, *, placed: bool = False) -> DataFrame:
        """Registered rules may read any column of the built-in ones, so with them every one is made.

        placed: the claims have a column __at, are dealt by it and shared by all branches (see `place`, `shared`).
        """
        require_columns(claims)
        rows = self.row_rules(claims)
        names = ["claim_id", *duplicates.KEY, "distance_exceeded", "state_mismatch"]
        if not self.extra_rules:
            rows = rows.select(*names, "__at") if placed else at_place(rows.select(*names)).repartition("__at")
            rows = rows if placed else shared(rows, rows.columns)
            return score.score_claims(self.apply_statistics(self.flags_where_placed(rows), source=rows), self.config)
        rows = shared(rows.drop(*["__at"] * placed).repartition("patient_id", "service_date"), names)
        out = self.apply_statistics(self.group_rules(rows), source=rows)
        return score.score_claims(self.detect_duplicates(out, rows), self.config)
