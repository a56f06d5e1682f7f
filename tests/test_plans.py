"""Physical-plan properties that matter at scale, checked on every registered query."""

import pytest

from ringfence.plans import registry
from ringfence.operators.detect import detect
from ringfence.sources import fixtures as fx
from ringfence.sources.tables import Tables

from paths import SF_SMALL

# Queries that write and re-read storage (or run streams) when called.
IO = {"s01", "s02", "k05_k10", "k07_s08", "k08", "k09", "k02_s09", "t01_t04", "t06", "t08_s05", "t08_s06", "t05", "t07_stream", "k03", "t09", "t10_l01",
      "t10_l02", "t10_l03"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("qid", sorted(set(registry.queries()) - IO - {"x15"}))
def test_no_cartesian_and_no_global_window(spark, qid):
    plan = _plan(registry.queries()[qid](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Window [" in line and "WindowGroupLimit" not in line:
            below = lines[i + 1:i + 6]
            for j, b in enumerate(below):
                if "Exchange SinglePartition" in b:
                    # allowed only over a grouped aggregate (e.g. one row per time
                    # bucket for a global sequence), never over raw rows
                    feeding = "\n".join(below[j + 1:j + 3])
                    assert "HashAggregate(keys=[" in feeding, f"{qid}: window over raw rows in one partition"


def test_detector_is_one_scan_without_shuffle(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df = detect(fx.cdr(Tables(spark, SF_SMALL)), "cdr")
    plan = _plan(df)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("FileScan parquet") == 1
    assert "Exchange" not in plan
    # only the five lineitem columns the projection uses are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," \
           "l_shipdate:timestamp_ntz>" in plan


def test_top_caller_lists_are_built_after_pre_aggregation(spark):
    plan = _plan(registry.queries()["q04"](spark, SF_SMALL))
    collect_at = plan.index("collect_list")
    # below the list aggregate there is a (caller, type) count aggregate
    assert "functions=[count(1)]" in plan[collect_at:]
