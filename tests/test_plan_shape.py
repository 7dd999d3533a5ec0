"""Physical plans: what reaches the scan, what is shuffled, what must not appear."""

import pytest

import __spark_entry__ as contract

QUERIES = contract.queries()
# Queries that write files when called; their plans start from those files.
STORED = ("source_", "sink_", "daily_store", "season_state", "sheet_headers", "published_parts", "unit_quarantine")
WRITING = {n for n in QUERIES if n.startswith(STORED)}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"]


def plan(spark, data, name):
    return QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_cross_join_and_no_python(spark, data, name):
    text = plan(spark, data, name)
    assert not [f for f in FORBIDDEN if f in text]


def scans(text):
    return text.count("FileScan")


def exchanges(text):
    return text.count("Exchange ")


@pytest.mark.parametrize(
    "name, most",
    [
        ("daily_sum", 1),
        ("flow_balance", 1),
        ("seasonal_envelope", 2),
        ("pivot_years", 2),
        ("storage_report", 2),
        ("gas_balance_report", 2),
        ("gas_balance_by_operator", 2),
        ("weekly_generation_report", 3),
        ("weekly_envelope_15min", 2),
        ("month_vs_average", 2),
        ("page_links", 0),
        ("position_to_timestamp", 0),
    ],
)
def test_one_scan_and_few_shuffles(spark, data, name, most):
    text = plan(spark, data, name)
    assert scans(text) == 1
    assert exchanges(text) <= most


@pytest.mark.parametrize(
    "name, columns",
    [
        ("storage_report", ["o_totalprice", "o_orderdate", "o_orderpriority"]),
        ("gas_balance_report", ["l_quantity", "l_returnflag", "l_shipdate"]),
        ("weekly_generation_report", ["l_linenumber", "l_quantity", "l_shipdate"]),
        ("month_vs_average", ["l_linenumber", "l_extendedprice", "l_shipdate"]),
    ],
)
def test_only_used_columns_are_read(spark, data, name, columns):
    text = plan(spark, data, name)
    scan = text[text.index("FileScan parquet ["):].split("]")[0]
    assert sorted(c.split("#")[0] for c in scan.split("[")[1].split(",")) == sorted(columns)


@pytest.mark.parametrize(
    "name, bound",
    [
        ("seasonal_envelope", "LessThan(o_orderdate"),
        ("monthly_mean_of_sums", "LessThan(o_orderdate"),
        ("consumption_tables", "GreaterThanOrEqual(o_orderdate"),
        ("flow_balance", "In(l_returnflag"),
    ],
)
def test_bounds_reach_the_scan(spark, data, name, bound):
    df = QUERIES[name](spark, data)
    formatted = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert bound in formatted


@pytest.mark.parametrize("name", ["rolling_median_15min", "difference_15min", "weeks_filled_in_blocks"])
def test_long_series_are_cut_into_blocks(spark, data, name):
    """Values stand in windows of one block; only ranks of block ends and counts of blocks have other windows."""
    text = plan(spark, data, name)
    lines = [line for line in text.splitlines() if "Window [" in line]
    over_rows = [line for line in lines if "row_number" not in line and "collect_list" not in line]
    assert "WindowGroupLimit" in text and over_rows
    assert all("windowspecdefinition(" in line and "_block#" in line.split("windowspecdefinition(")[1] for line in over_rows)


def test_aggregates_start_before_the_shuffle(spark, data):
    for name in ("daily_sum", "flow_balance", "seasonal_envelope", "unit_check", "latest_value"):
        text = plan(spark, data, name)
        below = text[text.rindex("Exchange "):]
        assert "partial_" in below


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["country", "date_datawrapper"]
    assert df.count() > 0
