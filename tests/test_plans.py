"""What the physical plans must and must not contain."""

import re

import pytest

from livegauge.operators.lookback import calendar_lookback, rolling_lookback
from livegauge.plans.baseline import baseline_stats
from livegauge.plans.report import report_rows
from livegauge.plans.snapshot import diff_backfill, snapshot_diff
from livegauge.schemas import DIFFS, OBSERVATIONS
from livegauge.sinks.tables import append_batch
from livegauge.sources.tables import read_batches
from queries import QUERIES, inputs
from tests.conftest import SMALL

AS_OF = "2024-01-31 00:00:00"


def plan(df, mode="formatted"):
    execution = df._jdf.queryExecution()
    return execution.explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def scans(df):
    """(pushed filters, partition filters, columns read) of every scan."""
    text = plan(df)
    return [
        (
            "".join(re.findall(r"PushedFilters: (.*)", block)),
            "".join(re.findall(r"PartitionFilters: (.*)", block)),
            "".join(re.findall(r"ReadSchema: struct<(.*)>", block)),
        )
        for block in re.split(r"\n\n+", text)
        if "ReadSchema" in block
    ]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    append_batch(inputs.observations(spark, SMALL), f"{path}/observations", OBSERVATIONS, 0)
    append_batch(inputs.diffs(spark, SMALL), f"{path}/diffs", DIFFS, 0)
    return (
        read_batches(spark, f"{path}/observations", OBSERVATIONS),
        read_batches(spark, f"{path}/diffs", DIFFS),
    )


LAZY = sorted(set(QUERIES) - {"append_roundtrip", "report_log", "stream_bucket_max", "stream_snapshot_diff"})


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_and_only_aggregates_in_one_task(spark, name):
    df = QUERIES[name](spark, SMALL)
    text = plan(df, "extended")
    for word in ("PythonUDF", "ArrowEval", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert word not in text
    lines = plan(df, "simple").splitlines()
    for place, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert re.search(r"Aggregate|TakeOrdered|Limit", lines[place + 1]), lines[place : place + 3]


@pytest.mark.parametrize("name", ["filter_positive", "observations_from_json", "union_platforms"])
def test_replies_are_parsed_once(spark, name):
    text = plan(QUERIES[name](spark, SMALL), "simple")
    assert len(re.findall(r"from_json\(|JsonToStructs", text)) == 1


@pytest.mark.parametrize("name", ["last_token_value", "parse_count"])
def test_counts_do_not_search_the_markup(spark, name):
    text = plan(QUERIES[name](spark, SMALL), "simple")
    assert "regexp_extract_all" not in text


def test_lookbacks_prune_dates_and_push_times(stored):
    observations, _ = stored
    for df in (calendar_lookback(observations, AS_OF), rolling_lookback(observations, AS_OF)):
        ((pushed, partitions, _),) = scans(df)
        assert "GreaterThanOrEqual(datetime" in pushed and "LessThanOrEqual(datetime" in pushed
        assert "obs_date" in partitions


def test_snapshot_scans_are_limited_to_the_two_buckets(stored):
    observations, _ = stored
    read = scans(snapshot_diff(observations, AS_OF))
    assert all("obs_date" in partitions for _, partitions, _ in read)
    wide = [pushed for pushed, _, columns in read if "name" in columns]
    narrow = {columns for _, _, columns in read if "name" not in columns}
    assert len(wide) == 2 and all("GreaterThanOrEqual(datetime,ScalarSubquery" in p for p in wide)
    assert any("LessThan(datetime,ScalarSubquery" in p for p in wide)
    assert narrow <= {"datetime:timestamp_ntz", ""}


def test_report_reads_two_dates_of_the_differences(stored):
    _, diffs = stored
    rows = report_rows(diffs, AS_OF)
    assert all("obs_date" in partitions for _, partitions, _ in scans(rows))


def test_statistics_shuffle_names_not_history(stored, spark):
    observations, _ = stored
    text = plan(baseline_stats(observations, inputs.channels(spark, SMALL), AS_OF))
    before_shuffle = text.split("Exchange")[0]
    assert "Join" in before_shuffle  # the tree lists the join above the aggregate it reads
    assert "partial_count" in text and "partial_avg" in text and "partial_var_pop" in text
    history_joins = re.findall(r"Join.*\n(?:.*\n)*?Output.*datetime", text.split("== Physical")[0])
    assert not history_joins


def test_backfill_reuses_its_aggregate_and_ranks_only_buckets(spark):
    df = diff_backfill(inputs.observations(spark, SMALL), inputs.DAILY)
    df.collect()
    final = plan(df, "simple").split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 1
    assert final.count("SinglePartition") == 1
    below = final[final.index("SinglePartition"):].split("FileScan")[0]
    assert "keys=[bucket" in below and "name" not in below
