"""Results stay whole when one key holds a third of all rows.

The smallest data set is copied with one copy, patron, branch and host taking a
third of the rows; broadcasts are off and every shuffle partition counts as
skewed, so the split paths really run.
"""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from tests.test_oracle import plain

HOT = {
    "lineitem": "* REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END AS l_partkey, "
                "CASE WHEN l_orderkey % 3 = 1 THEN 0 ELSE l_suppkey END AS l_suppkey)",
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 8 ELSE o_custkey END AS o_custkey)",
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id)",
}
SPLIT_EVERYTHING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
}
NAMES = [
    "left_items_circs", "transactions_alltime", "agg_holds_count", "agg_orders", "lending_multi_left", "range_after_arrival",
    "sample_delta", "rpt_count_circulations_by_patron_permission_group", "rpt_circulation_statistics_by_patron_address",
    "rpt_size_of_collection_report", "rpt_new_purchase_alerts_report", "rpt_new_popular_titles_on_hold", "rpt_list_titles_used_in_house", "missing_log_warn",
]


@pytest.fixture(scope="module")
def hot(spark, folder, tmp_path_factory):
    target = tmp_path_factory.mktemp("hot")
    duck = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        duck.execute(f"COPY (SELECT {HOT.get(name, '*')} FROM '{path}') TO '{target}/{name}.parquet' (FORMAT parquet)")
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{target}/{name}.parquet'")
    before = {key: spark.conf.get(key, None) for key in SPLIT_EVERYTHING}
    for key, value in SPLIT_EVERYTHING.items():
        spark.conf.set(key, value)
    yield duck, str(target)
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_lose_nothing(spark, hot, name):
    duck, folder = hot
    df = entry_module.queries()[name](spark, folder)
    result = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert plain(df.collect(), df.columns) == plain(result.fetchall(), columns)
