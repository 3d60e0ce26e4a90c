"""Independence of session settings, and where intermediate data goes."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from livegauge import storage
from livegauge.functions import clock
from tests.conftest import SMALL, at
from tests.oracle import connect, difference

TIMED = [
    "age_minutes",
    "bucket_10min",
    "date_arith",
    "diff_backfill",
    "freshness_flag",
    "interval_arith",
    "latest_batch",
    "rolling_lookback",
    "snapshot_diff",
    "stream_bucket_max",
    "trunc_hour",
]


@pytest.fixture(params=["America/New_York", "Asia/Kathmandu"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name", TIMED)
def test_results_do_not_depend_on_the_zone(spark, zone, name):
    result = contract.queries()[name](spark, SMALL)
    assert difference(result, connect(SMALL), contract.oracle_sql()[name]) is None


def test_instants_are_utc_in_any_zone(spark, zone):
    # 02:37 did not exist that day in New York.
    ts = F.lit("2024-03-10 02:37:12.5").cast("timestamp_ntz")
    instant = clock.as_instant(ts)
    row = spark.range(1).select(
        F.unix_micros(instant).alias("micros"), (clock.from_instant(instant) == ts).alias("same")
    ).first()
    assert row.micros == 1_710_038_232_500_000 and row.same


def test_intermediate_data_goes_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert storage.shared_dir(spark) == shared
    assert storage.new_path(spark, "x").startswith(f"{shared}/livegauge/x-")


class _Cluster:
    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:  # noqa: N801
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(_Cluster)


@pytest.mark.parametrize("width", [1, 5, 10, 30, 60, 1440])
def test_buckets_follow_the_hour_formula(spark, width):
    times = [at("30 00:00:00"), at("30 23:59:59"), at("15 13:09:59"), at("15 13:10:00")]
    rows = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    for ts, start in rows.select("ts", clock.bucket_start(F.col("ts"), width)).collect():
        minutes = (ts.hour * 60 + ts.minute) // width * width
        assert start == ts.replace(hour=minutes // 60, minute=minutes % 60, second=0)
