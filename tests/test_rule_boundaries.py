"""Every relaxed rule on rows sitting on, just below and just above each of its
thresholds (plus zeros and NULLs): Spark's detector vs the SQL predicates on DuckDB."""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import types as T

from ringfence.operators.detect import detect
from ringfence.operators.rules import PROFILES, RULES_BY_ID
from ringfence.plans.q_core import RULE_SQL
from ringfence.sources.schemas import stream_schema

STREAMS = sorted({RULES_BY_ID[r].stream for r in RULE_SQL if RULES_BY_ID[r].stream != "billing"})


def _thresholds(stream):
    vals = set()
    for rid, (form, params) in PROFILES["relaxed"].items():
        if RULES_BY_ID[rid].stream != stream:
            continue
        for v in params.values():
            if isinstance(v, (int, float)) and not isinstance(v, bool):
                vals.add(float(v))
    return sorted(vals)


def _rows(stream, n=1500, seed=11):
    rnd = random.Random(seed)
    schema = stream_schema(stream)
    th = _thresholds(stream)
    rows = []
    for i in range(n):
        row = {"customer_id": f"c{i}"}
        for f in schema.fields:
            if f.name in ("customer_id", "event_ts"):
                continue
            pick = rnd.random()
            if pick < 0.08:
                v = None
            elif pick < 0.16:
                v = 0.0
            else:
                base = rnd.choice(th)
                v = base + rnd.choice([-1.0, -0.01, 0.0, 0.01, 1.0]) * (1 if base else 1)
                v = max(v, -500.0)
            if v is not None and isinstance(f.dataType, T.IntegerType):
                v = int(round(v))
            row[f.name] = v
        row["event_ts"] = dt.datetime(2024, 1, 1, rnd.randint(0, 23), 0, 0)
        rows.append(row)
    return schema, rows


@pytest.mark.parametrize("stream", STREAMS)
def test_rules_on_threshold_grid_match_sql(spark, stream):
    schema, rows = _rows(stream)
    sdf = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)
    got = sorted((r.call_id, r.rule_id) for r in detect(sdf, stream).select("call_id", "rule_id").collect())

    pdf = pd.DataFrame(rows)
    for f in schema.fields:
        if isinstance(f.dataType, T.IntegerType):
            pdf[f.name] = pdf[f.name].astype("Int64")
    con = duckdb.connect()
    con.register(stream, pdf)
    exp = []
    for rid, (view, _recv, _val, pred) in RULE_SQL.items():
        if view != stream:
            continue
        exp += [(cid, rid) for (cid,) in con.execute(f"SELECT customer_id FROM {stream} WHERE {pred}").fetchall()]
    assert got == sorted(exp)
    assert len(got) > 0
