"""Relational sources: parquet folders and partitioned JDBC reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Column types of the supplied parquet tables.  A declared schema saves the
# footer-reading job of schema inference and keeps timestamps zone-free.
BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def read_parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read
    if name in BASE_SCHEMAS:
        reader = reader.schema(BASE_SCHEMAS[name])
    return reader.parquet(f"{folder}/{name}.parquet")


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower_bound: int,
    upper_bound: int,
    num_partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Range-partitioned read of a PostgreSQL or MySQL table.

    Every executor opens its own bounded range, filters and column lists are
    pushed to the database, and rows are streamed in batches.
    """
    return spark.read.jdbc(
        url=url,
        table=table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties={"fetchsize": "10000", **(properties or {})},
    )


class TableSet:
    """Contract tables as attributes, each read on first use by ``reader(name)``."""

    def __init__(self, reader: Callable[[str], DataFrame]):
        self._reader = reader
        self._tables: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._tables:
            self._tables[name] = self._reader(name)
        return self._tables[name]
