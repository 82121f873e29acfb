"""Lazy access to the input tables of one scale-factor directory."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """``Tables(spark, dir).orders`` reads ``{dir}/orders.parquet``.

    Reads are lazy and declare nothing but the path: Catalyst prunes the
    columns and pushes filters to the parquet scan per query.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def region(self) -> DataFrame: return self.read("region")

    @cached_property
    def nation(self) -> DataFrame: return self.read("nation")

    @cached_property
    def customer(self) -> DataFrame: return self.read("customer")

    @cached_property
    def supplier(self) -> DataFrame: return self.read("supplier")

    @cached_property
    def part(self) -> DataFrame: return self.read("part")

    @cached_property
    def orders(self) -> DataFrame: return self.read("orders")

    @cached_property
    def lineitem(self) -> DataFrame: return self.read("lineitem")

    @cached_property
    def events(self) -> DataFrame: return self.read("events")
