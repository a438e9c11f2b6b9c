"""The screening operators as queries over the star schema, each with SQL for a second engine.

Parameters are chosen so that every flag fires at the small scales; amounts
leave as whole cents and doubles are rounded, so both engines agree exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscreen.config import ScreenConfig
from claimscreen.operators import billing, duplicates, first_digit, geographic, outliers
from claimscreen.plans import reports
from claimscreen.plans.screening import ClaimScreen
from claimscreen.sources.star_schema import bundles, claims_from_star

CFG = ScreenConfig(max_daily_procedures_per_provider=2, max_claims_per_patient_per_day=1, same_day_locations=1, nonnegative_charges=True)
#: Digits 8 and 9 are over-represented at this threshold.
DIGIT_THRESHOLD = 0.04


def cents(name: str = "charge_amount", alias: str = "charge_cents") -> str:
    return f"cast({name} * 100 as bigint) as {alias}"


def big(name: str) -> str:
    return f"cast({name} as bigint) as {name}"


def r6(name: str) -> str:
    return f"round(cast({name} as double), 6) as {name}"


def joined(name: str) -> str:
    return f"concat_ws(',', {name}) as {name}"


def scored(spark: SparkSession, d: str) -> DataFrame:
    return ClaimScreen(CFG).detect(claims_from_star(spark, d, placed=True), placed=True)


def scored_rows(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).selectExpr(
        "claim_id", "patient_id", "provider_id", cents(), r6("fraud_score"), joined("fraud_reasons"),
        joined("rule_violations"), joined("statistical_flags"), "is_duplicate", "duplicate_of",
    )


def on_claims(f: Callable[[DataFrame], DataFrame], *cols: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: f(claims_from_star(spark, d)).selectExpr(*cols)


def saved_report(name: str, *cols: str, **values: str) -> Callable[[SparkSession, str], DataFrame]:
    """A saved SQL report over the scored claims, with detection dates spread over four weeks."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        view = f"claimscreen_scored_{name}"
        scored(spark, d).withColumn("detection_date", F.expr("date_add(date'2024-01-01', cast(cast(provider_id as bigint) % 28 as int))")).createOrReplaceTempView(view)
        return reports.run_sql(spark, name, view, **values).selectExpr(*cols)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    provider_ratio = lambda c: outliers.provider_outliers(c, cfg=CFG)
    z = lambda c, by=None: outliers.zscore_outliers(c, "charge_amount", "charge_zscore_outlier", by, CFG)
    iqr = lambda c, by=None: outliers.iqr_outliers(c, "charge_amount", "charge_iqr_outlier", by, CFG)
    report_cols = ["first_digit", "count", "total", "observed_frequency", "expected_frequency", "deviation", "deviation_percentage"]
    report = [big("first_digit"), "count", "total", *[r6(c) for c in report_cols[3:]]]
    return {
        "claims": on_claims(lambda c: c, "claim_id", "patient_id", "provider_id", "procedure_code", "cast(service_date as string) as service_date", cents(), "patient_state", "provider_state"),
        "daily_procedure_limit": on_claims(lambda c: billing.daily_procedure_limit(c, CFG), "claim_id", "daily_procedure_count", "daily_procedure_limit_exceeded"),
        "patient_frequency": on_claims(lambda c: billing.patient_frequency(c, CFG), "claim_id", "patient_daily_claims", "patient_frequency_exceeded"),
        "weekend_billing": on_claims(lambda c: billing.weekend_billing(c, CFG), "claim_id", big("day_of_week"), "is_weekend", r6("provider_weekend_ratio"), "weekend_billing_flag"),
        "round_amounts": on_claims(lambda c: billing.round_amounts(c, CFG), "claim_id", "is_round_hundred", "is_round_fifty", r6("provider_round_ratio"), "round_amount_flag"),
        "unbundling": lambda spark, d: billing.unbundling(claims_from_star(spark, d), bundles(spark)).selectExpr("claim_id", joined("procedures_same_day"), "bundled_code", "unbundling_flag"),
        "unbundling_flags": lambda spark, d: billing.unbundling(claims_from_star(spark, d), bundles(spark), fan_out=False).selectExpr("claim_id", "unbundling_flag"),
        "distance": on_claims(lambda c: geographic.distance(c, CFG), "claim_id", r6("distance_miles"), "distance_exceeded"),
        "haversine": on_claims(lambda c: geographic.distance(c, CFG).groupBy("patient_lat", "patient_lon", "provider_lat", "provider_lon").agg(F.max("distance_miles").alias("distance_miles")), "patient_lat", "patient_lon", "provider_lat", "provider_lon", r6("distance_miles")),
        "state_mismatch": on_claims(geographic.state_mismatch, "claim_id", "state_mismatch"),
        "geo_clustering": on_claims(lambda c: geographic.clustering(c, CFG), "claim_id", big("unique_patient_states"), "total_patients", "geographic_clustering_flag"),
        "same_day_locations": on_claims(lambda c: geographic.impossible_travel(c, CFG), "claim_id", big("num_providers_same_day"), "array_join(sort_array(transform(provider_locations, p -> cast(cast(p.lat as int) as string))), ',') as latitudes", "impossible_travel_flag"),
        "zscore_global": on_claims(z, "claim_id", "charge_zscore_outlier"),
        "zscore_by_procedure": on_claims(lambda c: outliers.procedure_outliers(c, cfg=CFG), "claim_id", "procedure_charge_outlier"),
        "zscore_by_provider": on_claims(lambda c: z(c, ["provider_id"]), "claim_id", "charge_zscore_outlier"),
        "iqr_global": on_claims(iqr, "claim_id", "charge_iqr_outlier"),
        "iqr_by_procedure": on_claims(lambda c: iqr(c, ["procedure_code"]), "claim_id", "charge_iqr_outlier"),
        "provider_ratio": on_claims(provider_ratio, "claim_id", r6("provider_avg_charge"), r6("charge_deviation_ratio"), "provider_billing_outlier"),
        "temporal_spike": on_claims(lambda c: outliers.temporal_spikes(c, cfg=CFG), "claim_id", "temporal_spike_flag"),
        "first_digit_global": on_claims(lambda c: first_digit.analyze(c, threshold=DIGIT_THRESHOLD), "claim_id", "benfords_anomaly"),
        "first_digit_by_provider": on_claims(lambda c: first_digit.analyze(c, group_by="provider_id"), "claim_id", "benfords_anomaly"),
        "first_digit_report": on_claims(first_digit.distribution_report, *report),
        "first_digit_report_by_provider": on_claims(lambda c: first_digit.distribution_report(c, group_by="provider_id"), "provider_id", *report),
        "exact_duplicates": on_claims(duplicates.exact_duplicates, "claim_id", "duplicate_key", big("duplicate_rank"), "first_claim_in_group", "is_exact_duplicate", "exact_duplicate_of"),
        "near_duplicates": on_claims(lambda c: duplicates.near_duplicates(duplicates.exact_duplicates(c), CFG), "claim_id", "near_duplicate_of", r6("similarity_score"), "is_near_duplicate"),
        "duplicates_combined": on_claims(lambda c: duplicates.find_duplicates(c, CFG), "claim_id", "is_duplicate", "duplicate_of"),
        "rule_flags": on_claims(lambda c: ClaimScreen(CFG).apply_rules(c), "claim_id", "daily_procedure_limit_exceeded", "patient_frequency_exceeded", "weekend_billing_flag", "round_amount_flag", "distance_exceeded", "state_mismatch"),
        "statistical_flags": on_claims(lambda c: ClaimScreen(CFG).apply_statistics(c), "claim_id", "charge_zscore_outlier", "charge_iqr_outlier", "benfords_anomaly"),
        "scored_claims": scored_rows,
        "risk_summary": lambda spark, d: reports.risk_summary(scored(spark, d)).selectExpr("total_claims", "high_risk", "medium_risk", "low_risk", *[r6(c) for c in ("mean_score", "stddev_score", "min_score", "max_score")]),
        "risky_providers_cli": lambda spark, d: reports.risky_providers(scored(spark, d)).selectExpr("provider_id", "flagged_claims", r6("avg_score"), cents("total_charges", "total_cents")),
        "high_risk_providers": lambda spark, d: reports.high_risk_providers(scored(spark, d)).selectExpr("provider_id", "flagged_claims", r6("avg_fraud_score"), cents("total_charges", "total_cents")),
        "duplicate_listing": lambda spark, d: reports.duplicate_listing(scored(spark, d)).selectExpr("claim_id", "duplicate_of", cents()),
        "sql_high_risk_providers": saved_report("high_risk_providers", "provider_id", "flagged_claims", r6("avg_fraud_score"), cents("total_charges", "total_cents")),
        "sql_duplicate_listing": saved_report("duplicate_listing", "claim_id", "duplicate_of", cents()),
        "sql_flags_by_rule": saved_report("flags_by_rule", "rule", "count", cents("total_amount", "total_cents")),
        "sql_recent_high_risk": saved_report("recent_high_risk", "claim_id", "provider_id", r6("fraud_score"), joined("fraud_reasons"), since="2024-01-15"),
        "flags_by_rule": lambda spark, d: reports.flags_by_rule(scored(spark, d)).selectExpr("rule", "count", cents("total_amount", "total_cents")),
    }


_CLAIMS = """
WITH base AS (
  SELECT l.*, o.o_custkey, p.p_brand, cr.r_name AS c_region, sr.r_name AS s_region, c.c_nationkey, s.s_nationkey,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS p100
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation cn ON c.c_nationkey = cn.n_nationkey JOIN region cr ON cn.n_regionkey = cr.r_regionkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation sn ON s.s_nationkey = sn.n_nationkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey
), priced AS (
  SELECT *, CASE WHEN l_quantity = 50 AND l_discount >= 0.09 THEN (p100 * 5 + 50) // 100
                 WHEN l_returnflag = 'R' THEN ((p100 + 500000) // 1000000) * 10000
                 WHEN l_suppkey % 10 = 3 THEN (p100 * 3 + 50) // 100
                 WHEN l_suppkey % 10 = 4 THEN (p100 + 200) // 400
                 ELSE (p100 + 50) // 100 END AS cents0
  FROM base
), copied AS (
  SELECT *, 'A' AS copy FROM priced UNION ALL SELECT *, 'B' FROM priced WHERE l_orderkey % 50 = 0 UNION ALL SELECT *, 'C' FROM priced WHERE l_orderkey % 40 = 0
), claims AS (
  SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '-' || CAST(l_linenumber AS VARCHAR) || '-' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') || '-' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0')
           || '-' || strftime(l_shipdate, '%Y%m%d') || '-' || CAST(p100 AS VARCHAR) || '-' || copy AS claim_id,
         CAST(o_custkey AS VARCHAR) AS patient_id, CAST(l_suppkey AS VARCHAR) AS provider_id, p_brand AS procedure_code,
         CAST(l_shipdate AS DATE) + CAST(CASE WHEN copy = 'C' THEN 7 ELSE 0 END AS INTEGER) AS service_date,
         CAST(CASE WHEN copy = 'C' THEN (cents0 * 105 + 50) // 100 ELSE cents0 END AS BIGINT) AS cents,
         CASE WHEN l_suppkey % 10 = 7 THEN 'OUT' ELSE c_region END AS patient_state, s_region AS provider_state,
         20.0 + c_nationkey AS patient_lat, -120.0 + 2 * c_nationkey AS patient_lon, 20.0 + s_nationkey AS provider_lat, -120.0 + 2 * s_nationkey AS provider_lon
  FROM copied
)"""

_DIGIT = "CASE WHEN cents >= 100 THEN CAST(substr(CAST(cents // 100 AS VARCHAR), 1, 1) AS BIGINT) END"
_EXPECTED = "(VALUES (1, 0.301), (2, 0.176), (3, 0.125), (4, 0.097), (5, 0.079), (6, 0.067), (7, 0.058), (8, 0.051), (9, 0.046)) AS e(d, share)"
_MILES = (
    "2 * 3959.0 * asin(least(1.0, sqrt(pow(sin((radians(provider_lat) - radians(patient_lat)) / 2), 2)"
    " + cos(radians(patient_lat)) * cos(radians(provider_lat)) * pow(sin((radians(provider_lon) - radians(patient_lon)) / 2), 2))))"
)

_RULES = f"""
, days AS (
  SELECT *, count(*) OVER (PARTITION BY provider_id, service_date) > 2 AS f1, count(*) OVER (PARTITION BY patient_id, service_date) > 1 AS f2,
         dayofweek(service_date) IN (0, 6) AS weekend, (cents % 10000 = 0 AND cents > 0) AS hundred, {_MILES} > 500 AS f5, patient_state <> provider_state AS f6
  FROM claims
), rules AS (
  SELECT *, weekend AND avg(CASE WHEN weekend THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY provider_id) > 0.30 AS f3,
         hundred AND avg(CASE WHEN hundred THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY provider_id) > 0.20 AS f4
  FROM days
)"""


def _stats(source: str) -> str:
    return f"""
, shares AS (
  SELECT d, count(*) * 1.0 / sum(count(*)) OVER () AS share FROM (SELECT {_DIGIT} AS d FROM claims) WHERE d IS NOT NULL GROUP BY d
), over AS (SELECT s.d FROM shares s JOIN {_EXPECTED} ON s.d = e.d WHERE s.share - e.share > 0.15
), overall AS (
  SELECT avg(cents / 100.0) AS m, stddev_samp(cents / 100.0) AS sd, quantile_disc(cents / 100.0, 0.25) AS q1, quantile_disc(cents / 100.0, 0.75) AS q3 FROM claims
), stats AS (
  SELECT r.*, abs((cents / 100.0 - m) / sd) > 3 AS g1, cents / 100.0 < q1 - 1.5 * (q3 - q1) OR cents / 100.0 > q3 + 1.5 * (q3 - q1) AS g2,
         coalesce({_DIGIT} IN (SELECT d FROM over), false) AS g3
  FROM {source} r CROSS JOIN overall
)"""


_DUPES = """
, marked AS (
  SELECT *, row_number() OVER (PARTITION BY patient_id, provider_id, procedure_code, service_date, cents ORDER BY claim_id) AS rk,
         min(claim_id) OVER (PARTITION BY patient_id, provider_id, procedure_code, service_date, cents) AS first_id
  FROM claims
), pairs AS (
  SELECT l.claim_id, r.claim_id AS other,
         round(0.6 * CASE WHEN l.procedure_code = r.procedure_code THEN 1.0 ELSE 0.0 END + 0.4 * (1.0 - abs(l.cents / 100.0 - r.cents / 100.0) / nullif(greatest(l.cents / 100.0, r.cents / 100.0), 0)), 9) AS score
  FROM marked l JOIN marked r ON l.patient_id = r.patient_id AND l.provider_id = r.provider_id AND l.claim_id > r.claim_id
       AND abs(date_diff('day', l.service_date, r.service_date)) <= 30
  WHERE l.rk = 1
), best AS (
  SELECT claim_id, other, score FROM (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY score DESC, other) AS n FROM pairs WHERE score >= 0.9) WHERE n = 1
), dupes AS (
  SELECT m.claim_id, m.rk, m.first_id, b.other, b.score, (m.rk > 1 OR b.other IS NOT NULL) AS is_duplicate, CASE WHEN m.rk > 1 THEN m.first_id ELSE b.other END AS duplicate_of
  FROM marked m LEFT JOIN best b ON m.claim_id = b.claim_id
)"""

_NAMES = {
    "f1": "daily_procedure_limit_exceeded", "f2": "patient_frequency_exceeded", "f3": "weekend_billing_flag", "f4": "round_amount_flag", "f5": "distance_exceeded", "f6": "state_mismatch",
    "g1": "charge_zscore_outlier", "g2": "charge_iqr_outlier", "g3": "benfords_anomaly",
}


def _list(letter: str) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {k} THEN '{v}' END" for k, v in _NAMES.items() if k[0] in letter) + ")"


def _count(letter: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {k} THEN 1 ELSE 0 END" for k in _NAMES if k[0] == letter) + ")"


_SCORED = (
    _CLAIMS + _RULES + _stats("rules") + _DUPES + f"""
, scored AS (
  SELECT s.*, d.is_duplicate, d.duplicate_of, {_list("fg")} AS reasons, {_list("f")} AS violations, {_list("g")} AS statistical,
         {_count("f")} / 6.0 * 0.3 + {_count("g")} / 3.0 * 0.25 + CASE WHEN d.is_duplicate THEN 1.0 ELSE 0.0 END * 0.45 AS score
  FROM stats s JOIN dupes d ON s.claim_id = d.claim_id
)"""
)


def _report(key: str) -> str:
    k, part = (f"{key}, ", f"PARTITION BY {key}") if key else ("", "")
    return f"""{_CLAIMS}, counts AS (SELECT {k}d, count(*) AS n FROM (SELECT {k}{_DIGIT} AS d FROM claims) WHERE d IS NOT NULL GROUP BY {k}d
), observed AS (SELECT {k}d, n, CAST(sum(n) OVER ({part}) AS BIGINT) AS total FROM counts
), rounded AS (SELECT {k}o.d, n, total, round(CAST(n AS DOUBLE) / total, 4) AS f, CAST(share AS DOUBLE) AS share FROM observed o JOIN {_EXPECTED} ON o.d = e.d
), gaps AS (SELECT *, round(f - share, 4) AS dev FROM rounded)
SELECT {k}d AS first_digit, n AS count, total, round(f, 6) AS observed_frequency, round(share, 6) AS expected_frequency, round(dev, 6) AS deviation, round(dev / share * 100, 2) AS deviation_percentage FROM gaps"""


_BUNDLES = "(VALUES ('X1', 'Brand#11', 'Brand#12'), ('X2', 'Brand#21', 'Brand#33'), ('X3', 'Brand#45', 'Brand#11')) AS b(code, u1, u2)"
_SAME_DAY = "codes AS (SELECT patient_id, service_date, provider_id, list_sort(list(DISTINCT procedure_code)) AS same_day FROM claims GROUP BY patient_id, service_date, provider_id)"


def _micros(a: str, b: str) -> str:
    """The quotient of two whole numbers, a in millionths, rounded half up in whole numbers."""
    return f"CAST((2 * ({a}) + ({b})) // (2 * ({b})) AS DOUBLE) / 1000000"


def oracle_sql() -> dict[str, str]:
    grouped_z = lambda k: f"{_CLAIMS}, g AS (SELECT {k} AS k, avg(cents / 100.0) AS m, stddev_samp(cents / 100.0) AS sd FROM claims GROUP BY {k})"
    z = "coalesce(CASE WHEN sd > 0 THEN abs((cents / 100.0 - m) / sd) > 3 ELSE false END, false)"
    iqr = "cents / 100.0 < q1 - 1.5 * (q3 - q1) OR cents / 100.0 > q3 + 1.5 * (q3 - q1)"
    quartiles = "quantile_disc(cents / 100.0, 0.25) AS q1, quantile_disc(cents / 100.0, 0.75) AS q3"
    pico = "sum(CAST(round(score * 1000000000000) AS HUGEINT))"
    providers = lambda score, limit, name: f"""{_SCORED}
SELECT provider_id, count(*) AS flagged_claims, {_micros(pico, "count(*) * 1000000")} AS {name}, CAST(sum(cents) AS BIGINT) AS total_cents
FROM scored WHERE score > {score} GROUP BY provider_id ORDER BY round(CAST({pico} AS DOUBLE) / 1000000000000 / count(*), 9) DESC, provider_id LIMIT {limit}"""  # noqa: E731
    found = {
        "claims": f"{_CLAIMS} SELECT claim_id, patient_id, provider_id, procedure_code, CAST(service_date AS VARCHAR) AS service_date, cents AS charge_cents, patient_state, provider_state FROM claims",
        "daily_procedure_limit": f"{_CLAIMS} SELECT claim_id, count(*) OVER (PARTITION BY provider_id, service_date) AS daily_procedure_count, count(*) OVER (PARTITION BY provider_id, service_date) > 2 AS daily_procedure_limit_exceeded FROM claims",
        "patient_frequency": f"{_CLAIMS} SELECT claim_id, count(*) OVER (PARTITION BY patient_id, service_date) AS patient_daily_claims, count(*) OVER (PARTITION BY patient_id, service_date) > 1 AS patient_frequency_exceeded FROM claims",
        "weekend_billing": f"{_CLAIMS}{_RULES} SELECT claim_id, CAST(dayofweek(service_date) + 1 AS BIGINT) AS day_of_week, weekend AS is_weekend, round(CAST(avg(CASE WHEN weekend THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY provider_id) AS DOUBLE), 6) AS provider_weekend_ratio, f3 AS weekend_billing_flag FROM rules",
        "round_amounts": f"{_CLAIMS}{_RULES} SELECT claim_id, hundred AS is_round_hundred, (cents % 5000 = 0 AND cents > 0) AS is_round_fifty, round(CAST(avg(CASE WHEN hundred THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY provider_id) AS DOUBLE), 6) AS provider_round_ratio, f4 AS round_amount_flag FROM rules",
        "unbundling": f"{_CLAIMS}, {_SAME_DAY} SELECT c.claim_id, array_to_string(k.same_day, ',') AS procedures_same_day, b.code AS bundled_code, b.code IS NOT NULL AS unbundling_flag FROM claims c JOIN codes k ON c.patient_id = k.patient_id AND c.service_date = k.service_date AND c.provider_id = k.provider_id LEFT JOIN {_BUNDLES} ON list_contains(k.same_day, b.u1) AND list_contains(k.same_day, b.u2)",
        "unbundling_flags": f"{_CLAIMS}, {_SAME_DAY} SELECT c.claim_id, EXISTS (SELECT 1 FROM {_BUNDLES} WHERE list_contains(k.same_day, b.u1) AND list_contains(k.same_day, b.u2)) AS unbundling_flag FROM claims c JOIN codes k ON c.patient_id = k.patient_id AND c.service_date = k.service_date AND c.provider_id = k.provider_id",
        "distance": f"{_CLAIMS} SELECT claim_id, round({_MILES}, 6) AS distance_miles, {_MILES} > 500 AS distance_exceeded FROM claims",
        "haversine": f"{_CLAIMS} SELECT DISTINCT CAST(patient_lat AS DOUBLE) AS patient_lat, CAST(patient_lon AS DOUBLE) AS patient_lon, CAST(provider_lat AS DOUBLE) AS provider_lat, CAST(provider_lon AS DOUBLE) AS provider_lon, round({_MILES}, 6) AS distance_miles FROM claims",
        "state_mismatch": f"{_CLAIMS} SELECT claim_id, patient_state <> provider_state AS state_mismatch FROM claims",
        "geo_clustering": f"{_CLAIMS}, g AS (SELECT provider_id AS k, count(DISTINCT patient_state) AS states, count(patient_id) AS n FROM claims GROUP BY provider_id) SELECT claim_id, states AS unique_patient_states, n AS total_patients, (n > 100 AND states = 1 AND patient_state <> provider_state) AS geographic_clustering_flag FROM claims JOIN g ON provider_id = k",
        "same_day_locations": f"{_CLAIMS}, g AS (SELECT patient_id AS k, service_date AS s, count(*) AS n, string_agg(CAST(CAST(provider_lat AS INTEGER) AS VARCHAR), ',' ORDER BY provider_lat) AS lats FROM claims GROUP BY patient_id, service_date) SELECT claim_id, n AS num_providers_same_day, lats AS latitudes, n > 1 AS impossible_travel_flag FROM claims JOIN g ON patient_id = k AND service_date = s",
        "zscore_global": f"{_CLAIMS}{_stats('claims')} SELECT claim_id, g1 AS charge_zscore_outlier FROM stats",
        "zscore_by_procedure": f"{grouped_z('procedure_code')} SELECT claim_id, {z} AS procedure_charge_outlier FROM claims JOIN g ON procedure_code = k",
        "zscore_by_provider": f"{grouped_z('provider_id')} SELECT claim_id, {z} AS charge_zscore_outlier FROM claims JOIN g ON provider_id = k",
        "iqr_global": f"{_CLAIMS}, g AS (SELECT {quartiles} FROM claims) SELECT claim_id, {iqr} AS charge_iqr_outlier FROM claims CROSS JOIN g",
        "iqr_by_procedure": f"{_CLAIMS}, g AS (SELECT procedure_code AS k, {quartiles} FROM claims GROUP BY procedure_code) SELECT claim_id, {iqr} AS charge_iqr_outlier FROM claims JOIN g ON procedure_code = k",
        "provider_ratio": f"""{_CLAIMS}
, own AS (SELECT provider_id AS k1, procedure_code AS k2, CAST(sum(cents) AS HUGEINT) AS s, count(*) AS n FROM claims GROUP BY provider_id, procedure_code
), market AS (SELECT procedure_code AS k3, CAST(sum(cents) AS HUGEINT) AS t, count(*) AS m FROM claims GROUP BY procedure_code
), ratio AS (SELECT k1, k2, {_micros("s * 10000", "n")} AS a, CASE WHEN t > 0 THEN {_micros("s * m * 1000000", "t * n")} ELSE 1.0 END AS r, t > 0 AND (s * m > 2 * t * n OR 2 * s * m < t * n) AS hit
  FROM own JOIN market ON k2 = k3)
SELECT claim_id, a AS provider_avg_charge, r AS charge_deviation_ratio, hit AS provider_billing_outlier FROM claims JOIN ratio ON provider_id = k1 AND procedure_code = k2""",
        "temporal_spike": f"{_CLAIMS}, h AS (SELECT claim_id, cents / 100.0 AS x, avg(cents / 100.0) OVER (PARTITION BY provider_id ORDER BY year(service_date), weekofyear(service_date), service_date, claim_id ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS a FROM claims) SELECT claim_id, coalesce(a > 0 AND x > 3 * a, false) AS temporal_spike_flag FROM h",
        "first_digit_global": f"{_CLAIMS}, shares AS (SELECT d, count(*) * 1.0 / sum(count(*)) OVER () AS share FROM (SELECT {_DIGIT} AS d FROM claims) WHERE d IS NOT NULL GROUP BY d), over AS (SELECT s.d FROM shares s JOIN {_EXPECTED} ON s.d = e.d WHERE s.share - e.share > {DIGIT_THRESHOLD}) SELECT claim_id, coalesce({_DIGIT} IN (SELECT d FROM over), false) AS benfords_anomaly FROM claims",
        "first_digit_by_provider": f"{_CLAIMS}, counts AS (SELECT provider_id AS k, d, count(*) AS n FROM (SELECT provider_id, {_DIGIT} AS d FROM claims) WHERE d IS NOT NULL GROUP BY provider_id, d), g AS (SELECT k, max(abs(f - share)) > 0.15 AS bad FROM (SELECT k, d, n * 1.0 / sum(n) OVER (PARTITION BY k) AS f FROM counts) c JOIN {_EXPECTED} ON c.d = e.d GROUP BY k) SELECT claim_id, coalesce(bad, false) AS benfords_anomaly FROM claims LEFT JOIN g ON provider_id = k",
        "first_digit_report": _report(""),
        "first_digit_report_by_provider": _report("provider_id"),
        "exact_duplicates": f"{_CLAIMS}{_DUPES} SELECT claim_id, patient_id || '|' || provider_id || '|' || procedure_code || '|' || CAST(service_date AS VARCHAR) || '|' || CAST(CAST(cents / 100.0 AS DECIMAL(10,2)) AS VARCHAR) AS duplicate_key, rk AS duplicate_rank, first_id AS first_claim_in_group, rk > 1 AS is_exact_duplicate, CASE WHEN rk > 1 THEN first_id END AS exact_duplicate_of FROM marked",
        "near_duplicates": f"{_CLAIMS}{_DUPES} SELECT claim_id, other AS near_duplicate_of, round(CAST(score AS DOUBLE), 6) AS similarity_score, other IS NOT NULL AS is_near_duplicate FROM dupes",
        "duplicates_combined": f"{_CLAIMS}{_DUPES} SELECT claim_id, is_duplicate, duplicate_of FROM dupes",
        "rule_flags": f"{_CLAIMS}{_RULES} SELECT claim_id, {', '.join(f'{k} AS {v}' for k, v in _NAMES.items() if k[0] == 'f')} FROM rules",
        "statistical_flags": f"{_CLAIMS}{_stats('claims')} SELECT claim_id, {', '.join(f'{k} AS {v}' for k, v in _NAMES.items() if k[0] == 'g')} FROM stats",
        "scored_claims": f"{_SCORED} SELECT claim_id, patient_id, provider_id, cents AS charge_cents, round(CAST(score AS DOUBLE), 6) AS fraud_score, reasons AS fraud_reasons, violations AS rule_violations, statistical AS statistical_flags, is_duplicate, duplicate_of FROM scored",
        "risk_summary": f"{_SCORED} SELECT count(*) AS total_claims, count(*) FILTER (WHERE round(score, 9) > 0.7) AS high_risk, count(*) FILTER (WHERE round(score, 9) > 0.3 AND round(score, 9) <= 0.7) AS medium_risk, count(*) FILTER (WHERE round(score, 9) <= 0.3) AS low_risk, round(avg(score), 6) AS mean_score, round(stddev_samp(score), 6) AS stddev_score, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score FROM scored",
        "risky_providers_cli": providers(0.5, 20, "avg_score"),
        "high_risk_providers": providers(0.7, 100, "avg_fraud_score"),
        "duplicate_listing": f"{_SCORED} SELECT claim_id, duplicate_of, cents AS charge_cents FROM scored WHERE is_duplicate",
        "flags_by_rule": f"{_SCORED} SELECT rule, count(*) AS count, CAST(sum(cents) AS BIGINT) AS total_cents FROM (SELECT unnest(string_split(violations, ',')) AS rule, cents FROM scored WHERE violations <> '') GROUP BY rule",
    }
    found |= {f"sql_{name}": found[name] for name in ("high_risk_providers", "duplicate_listing", "flags_by_rule")}
    return found | {
        "sql_recent_high_risk": f"""{_SCORED}
SELECT claim_id, provider_id, round(CAST(score AS DOUBLE), 6) AS fraud_score, reasons AS fraud_reasons FROM scored
WHERE score > 0.7 AND CAST(provider_id AS BIGINT) % 28 >= 14 ORDER BY round(score, 9) DESC, claim_id LIMIT 50"""
    }
