"""Operators on small tables: missing inputs, nulls, zero and negative charges, ties; and the commands around them."""

import datetime as dt
import random
import re
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from claimscreen import ClaimScreen, ScreenConfig, cli, job, queries
from claimscreen.operators import billing, duplicates, first_digit, geographic, outliers
from claimscreen.operators.grouped import packed, unpacked
from claimscreen.plans import reports
from claimscreen.schema import CLAIM_SCHEMA, duplicate_ids, quality_report
from claimscreen.sources import generate, io
from claimscreen.sources.star_schema import claims_from_star
from claimscreen.streaming.incremental import screen_new_files
from tests.oracle import assert_same

SCHEMA = "claim_id string, patient_id string, provider_id string, procedure_code string, service_date date, charge_amount decimal(10,2), patient_state string, provider_state string"
PLACES = SCHEMA + ", patient_lat double, patient_lon double, provider_lat double, provider_lon double"


def claim(n, patient="P", provider="D", code="99213", day="2024-03-05", charge="100.37", home="CA", office="CA"):
    return (f"C{n:04d}", patient, provider, code, dt.date.fromisoformat(day) if day else None, Decimal(charge) if charge is not None else None, home, office)


def flags(df, name):
    return {r["claim_id"]: r[name] for r in df.collect()}


def test_limits_and_nulls(spark):
    rows = [claim(i, patient=f"P{i}") for i in range(4)] + [claim(9, patient=None, provider=None, day=None, charge=None, home=None, office=None)]
    df = spark.createDataFrame(rows, SCHEMA)
    cfg = ScreenConfig(max_daily_procedures_per_provider=3)
    assert flags(billing.daily_procedure_limit(df, cfg), "daily_procedure_limit_exceeded") == {"C0000": True, "C0001": True, "C0002": True, "C0003": True, "C0009": False}
    assert not any(flags(billing.daily_procedure_limit(df, ScreenConfig(max_daily_procedures_per_provider=4)), "daily_procedure_limit_exceeded").values())
    assert not any(flags(billing.patient_frequency(df, cfg), "patient_frequency_exceeded").values())
    scored = ClaimScreen(cfg).detect(df).collect()
    assert len(scored) == 5 and all(r["fraud_score"] is not None and r["is_duplicate"] is not None for r in scored)
    assert ClaimScreen().detect(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        ClaimScreen().detect(df.drop("charge_amount"))


def test_weekends_and_round_amounts(spark):
    days = ["2024-03-02", "2024-03-03", "2024-03-09", "2024-03-05"]  # the last is a Tuesday
    df = spark.createDataFrame([claim(i, day=d, charge=c) for i, (d, c) in enumerate(zip(days, ["100", "200", "0", "-300"]))], SCHEMA)
    assert flags(billing.weekend_billing(df), "weekend_billing_flag") == {"C0000": True, "C0001": True, "C0002": True, "C0003": False}
    got = flags(billing.round_amounts(df), "is_round_hundred")
    assert got["C0000"] and got["C0001"] and not got["C0002"]


def test_places(spark):
    plain = spark.createDataFrame([claim(0), claim(1, home="NY"), claim(2, home=None), claim(3, office=None)], SCHEMA)
    assert flags(geographic.state_mismatch(plain), "state_mismatch") == {"C0000": False, "C0001": True, "C0002": False, "C0003": False}
    assert not any(flags(geographic.state_mismatch(plain.drop("patient_state", "provider_state")), "state_mismatch").values())
    assert not any(flags(geographic.distance(plain), "distance_exceeded").values())
    assert not any(flags(geographic.impossible_travel(plain), "impossible_travel_flag").values())
    where = [(34.05, -118.25, 34.05, -118.24), (34.05, -118.25, 40.71, -74.0), (None, None, 40.71, -74.0)]
    df = spark.createDataFrame([(*claim(i), *w) for i, w in enumerate(where)], PLACES)
    got = {r["claim_id"]: (r["distance_miles"], r["distance_exceeded"]) for r in geographic.distance(df, ScreenConfig(max_provider_patient_distance_miles=100)).collect()}
    assert not got["C0000"][1] and got["C0001"][1] and got["C0001"][0] > 2000 and not got["C0002"][1]


def test_outliers(spark):
    charges = ["95", "98", "100", "102", "104", "110", "97", "101", "99", "5000"]
    df = spark.createDataFrame([claim(i, charge=c) for i, c in enumerate(charges)] + [claim(10, charge=None)], SCHEMA)
    z = flags(outliers.zscore_outliers(df, "charge_amount", "o", cfg=ScreenConfig(outlier_zscore_threshold=2)), "o")
    assert [k for k, v in z.items() if v] == ["C0009"] and z["C0010"] is False
    assert [k for k, v in flags(outliers.iqr_outliers(df, "charge_amount", "o"), "o").items() if v] == ["C0009"]
    same = spark.createDataFrame([claim(i) for i in range(4)], SCHEMA)
    assert not any(flags(outliers.zscore_outliers(same, "charge_amount", "o"), "o").values())
    free = outliers.provider_outliers(spark.createDataFrame([claim(0, charge="0"), claim(1, provider="E", charge="0")], SCHEMA))
    assert {r["charge_deviation_ratio"] for r in free.collect()} == {1.0}
    peers = [claim(i, provider=f"D{i % 3}", charge=("100", "300", "30")[i % 3]) for i in range(12)]
    got = outliers.provider_outliers(spark.createDataFrame(peers, SCHEMA))
    assert {r["provider_id"] for r in got.filter("provider_billing_outlier").collect()} == {"D1", "D2"} - ({"D1"} if 300 * 3 <= 430 * 2 else set())
    weeks = [claim(i, day=f"2024-03-{4 + 7 * i:02d}" if i < 4 else f"2024-04-{7 * (i - 3) - 6:02d}", charge="100") for i in range(5)]
    spikes = flags(outliers.temporal_spikes(spark.createDataFrame([*weeks, claim(9, day="2024-04-15", charge="500")], SCHEMA)), "temporal_spike_flag")
    assert [k for k, v in spikes.items() if v] == ["C0009"]


def test_first_digits(spark):
    df = spark.createDataFrame([claim(i, charge=f"5{i:02d}") for i in range(50)] + [claim(100 + i, charge=f"1{i}") for i in range(10)] + [claim(200, charge="-5"), claim(201, charge="0"), claim(202, charge="0.50"), claim(203, charge=None)], SCHEMA)
    got = flags(first_digit.analyze(df), "benfords_anomaly")
    assert all(got[f"C{i:04d}"] for i in range(50)) and not got["C0100"] and not got["C0201"] and not got["C0203"] and len(got) == 64
    assert not any(flags(first_digit.analyze(df, threshold=0.99), "benfords_anomaly").values())
    assert not any(flags(first_digit.analyze(df, group_by="provider_id", threshold=0.99), "benfords_anomaly").values())
    assert {"first_digit", "observed_frequency", "expected_frequency"} <= set(first_digit.distribution_report(df).columns)


def test_duplicates(spark):
    rows = [claim(1), claim(2), claim(3), claim(4, charge="105", day="2024-03-06"), claim(5, day="2024-05-30", charge="104"), claim(6, provider=None), claim(7, provider=None), claim(8, code="X", charge="0"), claim(9, code="X", charge="0", day="2024-03-07")]
    df = spark.createDataFrame(rows, SCHEMA)
    exact = {r["claim_id"]: r["exact_duplicate_of"] for r in duplicates.exact_duplicates(df).collect()}
    assert {k: v for k, v in exact.items() if v} == {"C0002": "C0001", "C0003": "C0001", "C0007": "C0006"}
    found = {r["claim_id"]: r["duplicate_of"] for r in duplicates.find_duplicates(df).filter("is_duplicate").collect()}
    assert found["C0004"] == "C0001"  # of equal scores the lower id
    assert "C0005" not in found and "C0001" not in found and "C0009" not in found
    assert [r["claim_id"] for r in duplicate_ids(df.unionByName(df.limit(1))).collect()] == ["C0001"]
    assert quality_report(df).first()["zero_charges"] == 2


def test_scores_at_the_edges_of_bands(spark):
    df = spark.createDataFrame([(f"C{i}", "D", s, Decimal("1.00")) for i, s in enumerate([0.3, 0.30001, 0.7, 0.70001])], "claim_id string, provider_id string, fraud_score double, charge_amount decimal(10,2)")
    r = reports.risk_summary(df).first()
    assert (r["low_risk"], r["medium_risk"], r["high_risk"]) == (1, 2, 1)
    assert reports.risk_summary(df.limit(0)).first()["total_claims"] == 0
    assert [(r["flagged_claims"], round(r["avg_score"], 6)) for r in reports.risky_providers(df).collect()] == [(2, 0.700005)]


def test_formats(spark, tmp_path):
    df = generate.generate_claims(spark, 200, 0.2, num_providers=5, seed=3)
    assert df.schema == CLAIM_SCHEMA or df.columns == CLAIM_SCHEMA.fieldNames()
    assert df.count() >= 200 and generate.generate_claims(spark, 200, 0.2, num_providers=5, seed=3, partitions=3).exceptAll(df).count() == 0
    assert set(generate.generate_claim(spark, is_fraudulent=True)) == set(CLAIM_SCHEMA.fieldNames()) and len(generate.generate_id("CLM")) == 13
    for fmt in ("csv", "json", "parquet"):
        io.write_results(df, f"{tmp_path}/in-{fmt}", fmt)
        back = io.read_claims(spark, f"{tmp_path}/in-{fmt}", fmt)
        assert back.select(*df.columns).exceptAll(df).count() == 0 and back.count() == df.count()
        with pytest.raises(ValueError):
            io.read_claims(spark, f"{tmp_path}/in-{fmt}", "xml")
    with pytest.raises(ValueError):
        io.write_results(df, f"{tmp_path}/x", "xml")


def test_partitions_and_tables(spark, tmp_path):
    out = f"{tmp_path}/flagged"
    day = lambda d, n: ClaimScreen().detect(spark.createDataFrame([claim(i, patient=f"P{i}") for i in range(n)], SCHEMA)).withColumn("detection_date", F.lit(d).cast("date"))
    io.write_partitioned(day("2024-01-01", 3), out)
    io.write_partitioned(day("2024-01-02", 2), out)
    io.write_partitioned(day("2024-01-02", 1), out)
    assert {str(r["detection_date"]): r["count"] for r in spark.read.parquet(out).groupBy("detection_date").count().collect()} == {"2024-01-01": 3, "2024-01-02": 1}
    (tmp_path / "claims").mkdir()
    io.create_tables(spark, "screened", f"{tmp_path}/claims", out)
    assert spark.table("screened.flagged_claims").count() == 4
    assert reports.run_sql(spark, "recent_high_risk", "screened.flagged_claims", since="2024-01-02").count() == 0
    io.drop_partition(spark, "screened.flagged_claims", "2024-01-01")
    assert spark.table("screened.flagged_claims").count() == 1
    spark.sql("DROP DATABASE screened CASCADE")


def test_commands(spark, tmp_path, capsys):
    assert cli.main(["generate-sample", "-o", f"{tmp_path}/claims", "-n", "300", "--fraud-rate", "0.1"], spark) == 0
    for fmt in ("csv", "parquet"):
        if fmt == "parquet":
            io.read_claims(spark, f"{tmp_path}/claims", "csv").write.parquet(f"{tmp_path}/claims-parquet")
        source = f"{tmp_path}/claims" + ("-parquet" if fmt == "parquet" else "")
        assert cli.main(["run", "-i", source, "-o", f"{tmp_path}/scored-{fmt}", "-f", fmt], spark) == 0
        for report in ("summary", "providers", "benfords"):
            assert cli.main(["analyze", "-r", f"{tmp_path}/scored-{fmt}", "--report", report, "-f", fmt], spark) == 0
    assert "total_claims" in capsys.readouterr().out
    assert cli.main([], spark) == 1 and cli.main(["run", "-i", f"{tmp_path}/none", "-o", f"{tmp_path}/x"], spark) == 1
    assert job.main(["--input", f"{tmp_path}/claims", "--output", f"{tmp_path}/flagged"], spark) == 0
    assert "detection_date" in spark.read.parquet(f"{tmp_path}/flagged").columns
    assert job.main(["--input", f"{tmp_path}/none", "--output", f"{tmp_path}/y"], spark) == 1


def test_arriving_files(spark, tmp_path):
    for k in range(2):
        generate.generate_claims(spark, 50, seed=k).coalesce(1).write.mode("append").option("header", True).csv(f"{tmp_path}/arriving")
    for _ in range(2):  # the second run finds nothing new
        screen_new_files(spark, f"{tmp_path}/arriving", f"{tmp_path}/out", f"{tmp_path}/seen").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() >= 100


def test_settings():
    cfg = ScreenConfig(max_daily_procedures_per_provider=7)
    assert (cfg.max_daily_procedures_per_provider, cfg.weight_rule_violation, cfg.weight_statistical_anomaly, cfg.weight_duplicate, cfg.duplicate_time_window_days) == (7, 0.3, 0.25, 0.45, 30)


def test_extra_rules(spark):
    screen = ClaimScreen()
    screen.register(lambda df, cfg: df.withColumn("mine", F.lit(True)))
    assert "mine" in screen.apply_rules(spark.createDataFrame([claim(0)], SCHEMA)).columns


def test_source_is_computed_once(spark):
    """All branches of the scoring plan read one shuffle of the claims."""
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    source = spark.createDataFrame([claim(i) for i in range(40)], SCHEMA).repartition(3).mapInArrow(counted, SCHEMA)
    assert len(ClaimScreen().detect(source).collect()) == 40 and rows.value == 40


@pytest.mark.parametrize("nonnegative", [False, True])
def test_near_duplicates_by_brute_force(spark, nonnegative):
    """Dates over years, exact copies, zero charges and missing values: the best lower-id partner of each first claim."""
    rng = random.Random(3)
    days = [str(dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(-800, 800))) for _ in range(40)] + [None]
    rows = [claim(i, rng.choice("pqq"), rng.choice("xy"), rng.choice("AB"), rng.choice(days), rng.choice(["0", "100", "104", "109.5", "150", None])) for i in range(300)]
    rows += [claim(300 + i, None, "x", "A", days[0], "100") for i in range(4)] + [claim(310 + i, "p", "x", None, days[0], "100") for i in range(4)]
    rows += [(f"D{r[0]}", *r[1:]) for r in rows[::7]]
    first, want = {}, {}
    for r in rows:
        first[r[1:6]] = min(first.get(r[1:6], r[0]), r[0])
    for a in rows:
        best = []
        for b in rows:
            if None in (*a[1:6], *b[1:6]) or first[a[1:6]] != a[0] or a[0] <= b[0] or a[1:3] != b[1:3] or abs((a[4] - b[4]).days) > 30 or not max(a[5], b[5]):
                continue
            score = round(0.6 * (a[3] == b[3]) + 0.4 * (1 - float(abs(a[5] - b[5])) / float(max(a[5], b[5]))), 9)
            best += [(-score, b[0])] if score >= 0.9 else []
        want[a[0]] = min(best)[1] if best else None
    got = duplicates.near_duplicates(duplicates.exact_duplicates(spark.createDataFrame(rows, SCHEMA)), ScreenConfig(nonnegative_charges=nonnegative))
    assert flags(got, "near_duplicate_of") == want and sum(v is not None for v in want.values()) > 10


def test_scoring_shuffles_whole_claims_once(spark):
    df = spark.createDataFrame([claim(i) for i in range(4)], SCHEMA)
    plan = ClaimScreen().detect(df)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    whole = re.findall(r"\) Exchange\nInput \[\d+\]: \[(?=[^]]*\bclaim_id#)(?=[^]]*\bstate_mismatch#)[^]]*\]\nArguments: hashpartitioning\((\w+)#", plan)
    assert set(whole) == {"__at"}


@pytest.mark.parametrize("nonnegative", [False, True])
def test_scores_by_the_single_operators(spark, nonnegative):
    """Missing values in every column, crowded days, copies and dates over years: the scoring plan's flags against each operator alone."""
    rng = random.Random(5)
    days = [str(dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(-900, 900))) for _ in range(60)] + [None]
    pick = lambda i: claim(i, rng.choice(["p", "q", "r", "", None]), rng.choice(["x", "y", "", None]), rng.choice(["A", "B", None]), rng.choice(days), rng.choice(["0", "-100", "100", "104", "200", "150.5", None]), *rng.choices(["CA", "NV", None], k=2))
    rows = [pick(i) for i in range(600)]
    rows += [(f"D{r[0]}", *r[1:]) for r in rows[::9]]
    df = spark.createDataFrame(rows, SCHEMA)
    cfg = ScreenConfig(max_daily_procedures_per_provider=3, max_claims_per_patient_per_day=2, weekend_ratio=0.28, round_ratio=0.3, nonnegative_charges=nonnegative)
    got = {r["claim_id"]: (set(r["rule_violations"]), r["is_duplicate"], r["duplicate_of"]) for r in ClaimScreen(cfg).detect(df).collect()}
    want = {r[0]: set() for r in rows}
    alone = {
        "daily_procedure_limit_exceeded": billing.daily_procedure_limit(df, cfg), "patient_frequency_exceeded": billing.patient_frequency(df, cfg),
        "weekend_billing_flag": billing.weekend_billing(df, cfg), "round_amount_flag": billing.round_amounts(df, cfg), "state_mismatch": geographic.state_mismatch(df),
    }
    for name, one in alone.items():
        raised = {k for k, v in flags(one, name).items() if v}
        assert 10 < len(raised) < len(rows), name
        for k in raised:
            want[k].add(name)
    copies = {r["claim_id"]: (r["is_duplicate"], r["duplicate_of"]) for r in duplicates.find_duplicates(df, cfg).collect()}
    assert got == {k: (v, *copies[k]) for k, v in want.items()} and len(got) == len(rows)
    assert sum(v is not None for _, v in copies.values()) > 60


def test_packed_numbers_come_back(spark):
    """Numbers that fill their bits, need one more, are negative or missing."""
    values = [(a, b) for a in (0, 1, 7, 8, -1, None, 2**62) for b in (0, 2**31 - 1, 2**31, -(2**40), None)]
    rows = spark.createDataFrame([(str(i), *v) for i, v in enumerate(values)], "k string, a bigint, b bigint")
    longs = [{"a": 3, "absent": 5}, {"b": 31}]
    small = packed(rows, longs, "k")
    assert small.columns == ["__small0", "__small1", "__wide", "k"]
    assert {int(r["k"]): (r["a"], r["b"]) for r in unpacked(small, longs, rows.columns, "k").collect()} == dict(enumerate(values))
    assert small.filter("__wide is null").count() == 3 * 2


def test_star_claims_travel_packed(spark):
    """Texts of claims are made after the shuffles: the scoring plan over the star schema moves no whole claims."""
    plan = queries.scored(spark, "/root/testdata/sf0.001")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^]]*)\]\nArguments: hashpartitioning\((\w+)", plan)
    whole = [(names, by) for names, by in moved if "__wide#" in names and by.startswith("xxhash64")]
    assert whole and not any("claim_id#" in names and "state_mismatch#" in names for names, _ in moved)
    assert not any("l_shipdate#" in names or "__at#" in names and "claim_id#" in names for names, _ in moved)


def test_star_claims_with_odd_keys(spark, tmp_path):
    """Keys and prices beyond their bits, a missing date and a negative price, against the SQL."""
    con = duckdb.connect()
    star = "/root/testdata/sf0.001"
    for t in ("nation", "region", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE TABLE {t} AS SELECT * FROM '{star}/{t}.parquet'")
    for t, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        con.execute(f"UPDATE {t} SET {key} = {key} + {2**33} WHERE {key} % 3 = 0")
    for t, key in (("part", "p_partkey"), ("lineitem", "l_partkey")):
        con.execute(f"UPDATE {t} SET {key} = {key} + {2**26} WHERE {key} % 5 = 0")
    con.execute("UPDATE lineitem SET l_extendedprice = -l_extendedprice WHERE l_linenumber = 2")
    con.execute("UPDATE lineitem SET l_extendedprice = l_extendedprice * 100 WHERE l_linenumber = 3")
    for t in ("nation", "region", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT PARQUET)")
    plain, placed = (claims_from_star(spark, str(tmp_path), placed=p) for p in (False, True))
    assert plain.exceptAll(placed.drop("__at")).count() == 0 and placed.filter(F.col("__at") != F.xxhash64("provider_id", "service_date")).count() == 0
    assert plain.count() == placed.count() > 6000
    sql = f"{queries._CLAIMS} SELECT claim_id, patient_id, provider_id, procedure_code, CAST(service_date AS VARCHAR) AS service_date, cents, patient_state, provider_state FROM claims WHERE cents > 0"
    got = plain.filter("charge_amount > 0").selectExpr("claim_id", "patient_id", "provider_id", "procedure_code", "cast(service_date as string) as service_date", "cast(charge_amount * 100 as bigint) as cents", "patient_state", "provider_state")
    assert_same(got, sql, str(tmp_path))


def test_marks_travel_short(spark):
    """What is found elsewhere comes back by place without carrying it, and marks are not dealt out to be made unique."""
    df = spark.createDataFrame([claim(i) for i in range(4)], SCHEMA)
    plan = ClaimScreen().detect(df)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^]]*)\]\nArguments: hashpartitioning", plan)
    assert not any("__at#" in names and "state_mismatch#" not in names for names in moved)
    assert not any("max#" in names for names in moved)
