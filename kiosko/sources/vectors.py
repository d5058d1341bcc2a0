"""A store of vectors by article: insert-ignore in batches, exact search by cosine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiosko.operators.network import similar
from kiosko.sources.tables import Table, _type

SCHEMA = _type("vec_id bigint, origin string, text string, embedding array<float>")


class VectorStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.table = Table(spark, folder, SCHEMA, date=None)

    def insert(self, rows: DataFrame) -> None:
        """Adds rows of new ``origin``; null embeddings are left out."""
        self.table.append_new(rows.where("embedding is not null and origin is not null"), "origin")

    def missing(self, rows: DataFrame) -> DataFrame:
        """Rows (id) that have no vector yet."""
        return rows.join(self.table.read().select(F.col("origin").alias("id")), "id", "left_anti")

    def search(self, queries: DataFrame, threshold: float = 0.6) -> DataFrame:
        return similar(queries, self.table.read(), threshold)
