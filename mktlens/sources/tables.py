"""Table access for the driver's parquet folders.

Each table is read lazily with ``spark.read.parquet``; Catalyst prunes the
columns each plan uses and pushes filters into the scan, so readers never
select columns themselves.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# The columns of the tables that the plans read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its declared schema (no footer is read to infer it)."""
    reader = spark.read.schema(StructType.fromDDL(SCHEMAS[name])) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy attribute access to the driver tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            df = read_table(self.spark, self.sf_dir, name)
            self.__dict__[name] = df
            return df
        raise AttributeError(name)

    @cached_property
    def names(self) -> tuple[str, ...]:
        return tuple(DRIVER_TABLES)
