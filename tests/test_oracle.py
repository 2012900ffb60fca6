"""Registered queries against their oracle SQL at the smallest scale.

All of them with SHELFSTREAM_ALL=1, otherwise one of each family.
"""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from shelfstream.workload import registered

CHOSEN = [
    "src_relational", "left_items_circs", "sink_items_csv", "sink_dat_file", "transactions_union", "transactions_alltime", "transactions_alltime_corrected", "agg_holds_count",
    "join_holds_resolve", "agg_orders", "lending_multi_left", "branch_file", "upsert_bibs", "chq_item_rows", "chq_bib_rows",
    "koha_bibs", "koha_agg_circs", "koha_transactions_alltime", "koha_transactions_alltime_corrected", "src_log_text", "agg_hold_copy_ratio", "cpu_shares", "date_parts",
    "stream_service_health", "stream_window_alert", "trace_related_lines", "rpt_list_patrons_with_open_transactions",
    "rpt_size_of_collection_report", "sink_bibs_csv", "sink_holds_alltime_csv", "run_audit", "agg_circs_incremental", "naco_normalize", "rpt_new_purchase_alerts_report", "rpt_new_popular_titles_on_hold", "missing_log_warn", "rpt_list_titles_used_in_house", "rpt_hourly_checkins",
]
NAMES = list(registered()) if os.environ.get("SHELFSTREAM_ALL") else CHOSEN


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(registered()) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, folder, name):
    df = entry_module.queries()[name](spark, folder)
    result = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.collect(), df.columns) == plain(result.fetchall(), columns)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
