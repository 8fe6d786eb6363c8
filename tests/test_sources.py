"""Reading by column name, failures that show, stored tables, checkpoints and layout."""

import glob
import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from civicflow import schema as S
from civicflow.operators import cleaning as C
from civicflow.operators import diagnostics as D
from civicflow.plans import model as M
from civicflow.plans import performance as P
from civicflow.plans.catalog import SPARK
from civicflow.sources import read_clean, read_raw, requests_ev, requests_ord
from civicflow.sources.tickets import ExportError, export_results, load_table, write_table


@pytest.fixture(scope="module")
def clean(spark):
    return C.clean_pipeline(requests_ev(spark, SF_SMALL))


def test_csv_columns_are_matched_by_name(spark, clean, tmp_path):
    shuffled = clean.select(*sorted(clean.columns))
    path = write_table(shuffled, str(tmp_path / "c"), fmt="csv")
    back = read_clean(spark, path, fmt="csv")
    assert back.columns == shuffled.columns
    kinds = {f.name: f.dataType for f in S.CLEAN.fields}
    assert all(f.dataType == kinds[f.name] for f in back.schema.fields)
    assert sorted(back.select("unique_key", "borough", "created_date").collect()) == \
        sorted(clean.select("unique_key", "borough", "created_date").collect())


def test_unknown_and_missing_columns_raise(spark, clean, tmp_path):
    odd = write_table(clean.withColumn("surprise", F.lit(1)), str(tmp_path / "odd"), fmt="csv")
    with pytest.raises(ValueError, match="surprise"):
        read_clean(spark, odd, fmt="csv")
    for fmt in ("csv", "parquet"):
        short = write_table(clean.drop("unique_key"), str(tmp_path / f"short_{fmt}"), fmt=fmt)
        with pytest.raises(ValueError, match="unique_key"):
            read_clean(spark, short, fmt=fmt)


def test_glob_paths(spark, tmp_path):
    raw = requests_ev(spark, SF_SMALL)
    for i in (1, 2):
        write_table(raw, str(tmp_path / f"part{i}"))
    assert read_raw(spark, str(tmp_path / "part*")).count() == 2 * raw.count()


def test_export_writes_the_rest_and_raises(spark, tmp_path):
    good = spark.range(3)
    bad = spark.range(3).select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    with pytest.raises(ExportError) as e:
        export_results({"bad": bad, "none": None, "good": good}, str(tmp_path))
    assert set(e.value.failed) == {"bad", "none"} and list(e.value.written) == ["good"]
    assert spark.read.option("header", True).csv(f"{tmp_path}/sql_results_good").count() == 3


def test_a_failing_query_fails_the_sql_job(spark, clean, tmp_path, monkeypatch):
    from civicflow.jobs import sql_job
    path = write_table(clean, str(tmp_path / "clean"))

    def broken(df):
        raise KeyError("no such column")
    monkeypatch.setitem(P.QUERIES, "moving_average", broken)
    with pytest.raises(P.QueryError) as e:
        sql_job(spark, path, str(tmp_path / "out"))
    assert list(e.value.failed) == ["moving_average"] and len(e.value.results) == 5
    assert len(glob.glob(f"{tmp_path}/out/sql_results_*")) == 5


def test_queries_after_q7_scan_parquet(spark):
    SPARK["Q7_run_all_values"](spark, SF_SMALL).collect()
    plan = SPARK["A5_hour_histogram_ev"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "InMemoryTableScan" not in plan and "InMemoryRelation" not in plan


def test_q7_keeps_the_windows(spark):
    plan = SPARK["Q7_run_all_values"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "lag(" in plan and "row_number(" in plan


def test_durable_table(spark, clean, tmp_path):
    back = load_table(spark, clean, "tickets_durable", durable=True, location=str(tmp_path / "t"))
    assert back.count() == clean.count() and glob.glob(f"{tmp_path}/t/load-*/*.parquet")
    spark.sql("DROP TABLE tickets_durable")


def test_clean_write_has_few_files(spark, tmp_path):
    clean = C.clean_pipeline(requests_ord(spark, SF_SMALL)).repartition(8)
    path = write_table(clean, str(tmp_path / "w"), partition_by=["created_year", "created_month"])
    folders = clean.select("created_year", "created_month").distinct().count()
    assert len(glob.glob(f"{path}/*/*/*.parquet")) <= 2 * folders
    assert read_clean(spark, path).count() == clean.count()


def test_label_codes_scan_once(spark, clean, tmp_path):
    path = write_table(clean, str(tmp_path / "m"))
    df = M.label_codes(M.prepare(read_clean(spark, path)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan parquet") == 1


def test_lenient_dates_keep_the_wall_clock(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2023-03-12 02:30:00",), ("bad",)], "created_date string")
        got = [r.t for r in C.parse_dates(df, strict=False).select(F.col("created_date").cast("string").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2023-03-12 02:30:00", None]


def test_recommendation_compares_the_rate_as_shown(spark):
    """6,996 of 10,000 closed is 69.96 %, shown and compared as 70.0 %."""
    def rules(closed):
        df = spark.range(10_000).select(
            F.lit("Queens").alias("borough"), F.lit("x").alias("complaint_category"), F.lit(1.0).alias("response_time_days"),
            F.when(F.col("id") < closed, "Closed").otherwise("Open").alias("status"))
        return [r.rule_id for r in D.recommendations(df).collect()]
    assert "borough_focus" not in rules(6996) and "borough_focus" in rules(6994)


def test_default_rules_in_both_languages(spark):
    df = spark.createDataFrame([("Heat/Hot Water", "Saturday"), ("Aquecimento/Água Quente", "Domingo"), ("Rodent", "Monday")],
                               "complaint_type string, created_weekday string") \
        .withColumns({"created_month": F.lit(12), "created_hour": F.lit(7)})
    got = [(r.is_priority, r.is_weekend, r.quarter) for r in M.supply_missing_features(df).collect()]
    assert got == [(True, True, 4), (True, True, 4), (False, False, 4)]


def test_tiny_test_share_still_gives_rows(spark, clean):
    n = clean.count()
    big = clean.select("unique_key").crossJoin(spark.range(20)).select((F.col("unique_key") * 20 + F.col("id")).alias("unique_key"))
    share = M.with_split(big, 0.004).filter("is_test").count() / (20 * n)
    assert 0.002 < share < 0.006


def test_stream_checkpoints_follow_the_output(spark, tmp_path):
    from civicflow.session import shared_path
    from civicflow.streaming.tickets_stream import clean_stream, write_clean_stream
    raw = requests_ev(spark, SF_SMALL)
    full = raw.select(*[F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in S.RAW.fields])
    src = write_table(full, str(tmp_path / "src"))
    counts = []
    for out in ("a", "b"):
        write_clean_stream(clean_stream(spark, src), str(tmp_path / out)).awaitTermination()
        counts.append(spark.read.parquet(str(tmp_path / out)).count())
    assert counts[0] == counts[1] > 0
    assert shared_path(spark, "x")


def test_dictionaries_are_the_pinned_values():
    """A later typo in a fixed value cannot pass: digests of the tables as they were compared."""
    assert S.PRIORITY_TYPES == ["Aquecimento/Água Quente", "Sistema de Água", "Condições Insalubres"]
    assert S.CLOSED_STATUSES == ["Closed", "Fechado"]
    assert S.RESOLUTION_BUCKETS == [(1, "24h"), (2, "48h"), (7, "7d"), (30, "30d")]
    assert (S.PEAK_HOURS, S.YEAR_END_MONTHS) == ([8, 9, 10, 17, 18, 19], [11, 12])
    assert S.BOROUGH_ZIP_DEFAULTS == {"MANHATTAN": 10001, "BROOKLYN": 11201, "QUEENS": 11101, "BRONX": 10451, "STATEN ISLAND": 10301}
    assert S.STATUS_TRANSLATION == {"Open": "Aberto", "Closed": "Fechado", "In Progress": "Em Andamento", "Pending": "Pendente"}
    tables = [S.BOROUGH_TRANSLATION, S.COMPLAINT_TYPE_TRANSLATION, S.WEEKDAY_TRANSLATION, S.CATEGORY_MAPPING]
    assert hashlib.sha256(repr(tables).encode()).hexdigest() == PINNED


PINNED = "1697fb65bb7bfd44c71c292c2b950f5583edef22a0036e08a231485454efc36f"
