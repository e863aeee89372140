"""Layer tables as run-stamped Parquet folders: `<root>/<layer>/run=<id>`.

Every run writes whole tables into new folders. A table is the newest folder that has the marker `_PUBLISHED`, which is
put there only after the write and its checks: a failed write, or one whose check failed, never replaces what readers
see, and a rerun starts from what earlier stages published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TRANSACTIONS = "raw/financial_transactions"
RAW_FX = "raw/fx_rate"
REPEATED_RATES = "raw/repeated_rates"
JUDGED = "bronze/judged_transactions"
BRONZE = "bronze/financial_transactions"
QUARANTINE = "bronze/quarantine_log"
SILVER = "silver/loan_accounts"
GOLD = "gold/monthly_credit_risk_report"
REPORT_SUMS = "gold/report_sums"
RUN_LOG = "gold/pipeline_run_log"
LAYERS = [RAW_TRANSACTIONS, RAW_FX, JUDGED, BRONZE, QUARANTINE, SILVER, GOLD, REPORT_SUMS]
_MARKER = "_PUBLISHED"


class Tables:
    """Tables of one root folder, written under one run id. Run ids must grow with time in text order (UTC)."""

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), run_id

    def _file_system(self, path: str):
        location = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return location, location.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def path(self, table: str) -> str:
        return f"{self.root}/{table}/run={self.run_id}"

    def newest(self, table: str) -> str | None:
        """Folder of the newest published write, this run's or an earlier one's."""
        location, system = self._file_system(f"{self.root}/{table}")
        if not system.exists(location):
            return None
        done = [s.getPath() for s in system.listStatus(location) if s.getPath().getName().startswith("run=")
                and system.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), _MARKER))]
        return max((p.toString() for p in done), default=None)

    def write(self, table: str, df: DataFrame, partition_by: list[str] | None = None, publish: bool = True) -> DataFrame:
        """Store a whole table, even an empty one, and give it back as stored; `publish=False` if checks follow."""
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        # A partitioned write leaves no file at all for an empty table, so the schema is passed to the reader.
        writer.parquet(self.path(table))
        if publish:
            self.publish(table)
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def publish(self, table: str) -> None:
        """Make this run's write of a table the newest."""
        location, system = self._file_system(f"{self.path(table)}/{_MARKER}")
        system.create(location, True).close()

    def drop(self, table: str) -> None:
        """Delete this run's write of a table that later stages do not read."""
        location, system = self._file_system(self.path(table))
        system.delete(location, True)

    def retain(self, keep: int) -> None:
        """Delete all but the newest `keep` published writes of each table, and older unpublished ones."""
        for table in LAYERS:
            location, system = self._file_system(f"{self.root}/{table}")
            if not system.exists(location):
                continue
            runs = sorted((s.getPath() for s in system.listStatus(location) if s.getPath().getName().startswith("run=")),
                          key=lambda p: p.getName(), reverse=True)
            marker = self.spark._jvm.org.apache.hadoop.fs.Path
            published = [p for p in runs if system.exists(marker(p, _MARKER))]
            if len(published) >= keep:
                for p in runs:
                    if p.getName() < published[keep - 1].getName():
                        system.delete(p, True)

    def read(self, table: str) -> DataFrame:
        folder = self.newest(table)
        if folder is None:
            raise FileNotFoundError(f"{self.root}/{table} has no published write")
        return self.spark.read.parquet(folder)
