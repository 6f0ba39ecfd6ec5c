"""Driver tables: one parquet file (or folder) per table under a scale-factor dir.

Only the scan is declared here; Catalyst prunes the columns each query uses
and pushes its filters into the parquet reader (``ReadSchema`` /
``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise KeyError(f"unknown driver table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Lazy access to the driver tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def __getitem__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)
