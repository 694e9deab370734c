"""Skew handling: with AQE forced to treat partitions as skewed, joins are
split (``skew=true`` in the final plan) and results still equal the oracle."""

from __future__ import annotations

import pytest

from conftest import SF_ORACLE
from oracle_compare import compare, duck
from tabsmith.plans.catalog import QUERIES
from tabsmith.plans.oracle import ORACLE

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in FORCED}
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", ["select_bom", "customer_master", "bom_components"])
def test_split_joins_keep_results(skewed, key):
    df = QUERIES[key](skewed, SF_ORACLE)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    r = compare(skewed, SF_ORACLE, key, QUERIES[key], ORACLE[key], duck(SF_ORACLE))
    assert r["columns_match"] and r["values_match"], r
