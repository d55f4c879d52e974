"""Health log: which target ran when, with the rows of each batch in a folder of their own.

A batch's rows are written by overwrite, also when the batch is replayed, so every batch that ran has them exactly once.
``compact`` folds the folders of finished batches into one, without the ids that are due to be purged; the log says
which batches it holds, so a crash on the way neither loses nor doubles a row.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.retention import purge_health
from .versions import VersionLog

HEALTH_DDL = "target string, last_run timestamp"


class HealthLog:
    def __init__(self, spark: SparkSession, root: str, checkpoint_every: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = VersionLog(spark, self.root, checkpoint_every)

    def _state(self) -> dict:
        return self.log.load({"version": 0, "base": None, "folded": {}}, lambda state, entry: state | entry)

    def record(self, names: list[str], instant: Column, batch_id: int, stream: str = "") -> None:
        rows = self.spark.createDataFrame([(n,) for n in names], "target string").withColumn("last_run", instant.cast("timestamp"))
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/rows/p_stream={stream or 'none'}/p_batch={batch_id}")

    def publish(self, df: DataFrame, batch_id: int = 0) -> None:
        """Replace the whole log."""
        self._write(df.select("target", "last_run"), self._state(), {})

    def read(self) -> DataFrame:
        state = self._state()
        parts = [self.spark.read.schema(HEALTH_DDL).parquet(state["base"])] if state["base"] else []
        try:
            rows = self.spark.read.schema(f"{HEALTH_DDL}, p_stream string, p_batch long").parquet(f"{self.root}/rows")
            for stream, batch in state["folded"].items():  # a few streams
                rows = rows.where((F.col("p_stream") != stream) | (F.col("p_batch") > batch))
            parts.append(rows.select("target", "last_run"))
        except AnalysisException:  # no batch yet
            pass
        if not parts:
            return self.spark.createDataFrame([], HEALTH_DDL)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def compact(self, as_of: Column | None = None, days: int = 15) -> None:
        """Fold all batches into the base, without the ids whose last run is ``days`` days ago."""
        state = self._state()
        try:
            seen = self.spark.read.schema(f"{HEALTH_DDL}, p_stream string, p_batch long").parquet(f"{self.root}/rows")
            folded = {r["p_stream"]: r["b"] for r in seen.groupBy("p_stream").agg(F.max("p_batch").alias("b")).collect()}
        except AnalysisException:
            folded = {}
        self._write(purge_health(self.read(), "target", "last_run", as_of, days), state, folded)

    def _write(self, df: DataFrame, state: dict, folded: dict) -> None:
        version = state["version"] + 1
        path = f"{self.root}/base/v={version}"
        df.write.mode("overwrite").parquet(path)
        entry = {"version": version, "base": path, "folded": state["folded"] | folded}
        self.log.append(entry)
        self.log.keep(entry)
        for stream, batch in folded.items():
            for name in self.log.files.names(f"../rows/p_stream={stream}"):
                if name.startswith("p_batch=") and int(name[8:]) <= batch:
                    self.log.files.remove(f"../rows/p_stream={stream}/{name}")
