"""Lazy access to the parquet tables and the domain frames of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowgauge.schemas import RAW
from flowgauge.sources.domain import FRAMES, SparkText


class Tables:
    """``t.orders`` is a parquet table, ``t.deploys`` a domain frame. Nothing is read before an action."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._seen: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in RAW and name not in FRAMES):
            raise AttributeError(name)
        if name not in self._seen:
            self._seen[name] = self._build(name)
        return self._seen[name]

    def _build(self, name: str) -> DataFrame:
        if name in RAW:
            return self.spark.read.schema(RAW[name]).parquet(f"{self.folder}/{name}.parquet")
        spec = FRAMES[name]
        return self.spark.sql(spec.text(SparkText()), **{n: getattr(self, n) for n in spec.needs})
