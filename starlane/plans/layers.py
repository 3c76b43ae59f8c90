"""Layered storage: one folder per layer (staging, intermediate, dimensions,
facts, marts, seeds), as the reference keeps one schema per layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("staging", "intermediate", "dimensions", "facts", "marts", "seeds")


@dataclass(frozen=True)
class Layout:
    root: str

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def write(self, df: DataFrame, layer: str, name: str, partition_by: str | None = None) -> str:
        """Full refresh of one table (overwrite)."""
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            w = w.partitionBy(partition_by)
        path = self.path(layer, name)
        w.parquet(path)
        return path

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        return spark.read.parquet(self.path(layer, name))


def register_view(df: DataFrame, layer: str, name: str) -> str:
    """A lazy view layer: a temp view named ``{layer}__{name}``."""
    view = f"{layer}__{name}"
    df.createOrReplaceTempView(view)
    return view
