"""Staging and predictions kept as Parquet tables, and the same over JDBC."""

from __future__ import annotations

import re
import threading
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from stridecast.operators.layout import persisted
from stridecast.plans.promotion import (
    HOT,
    PREDICTION_KEY,
    gathered_of_files,
    latest_rows_gathered,
    month_counts,
    promote_rows,
    repeats_by_month,
    valid_rows,
)
from stridecast.plans.scoring import accepted, quarantine
from stridecast.schema import PREDICTION_COLUMNS, SCORED_SCHEMA
from stridecast.scratch import empty_frame, written
from stridecast.sources import jdbc
from stridecast.sources.ledger import Ledger, newest

PREDICTION_SCHEMA = T.StructType([SCORED_SCHEMA[c] for c in PREDICTION_COLUMNS])
_ATTEMPT = ("stream_id", "epoch_id", "attempt")
_ATTEMPT_FIELDS = [T.StructField("stream_id", T.StringType()), T.StructField("epoch_id", T.IntegerType()), T.StructField("attempt", T.StringType())]
# A row names a month and the versions (with commas between) that hold it, or an attempt that was taken in.
_MANIFEST_SCHEMA = T.StructType([T.StructField("period", T.StringType()), T.StructField("version", T.StringType()), *_ATTEMPT_FIELDS])

# Message ids are digits of hashes, no two alike: half of what other codecs make of them. The first level
# takes least time and room for them, a dictionary only time.
_FILES = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary#message_id": "false"}
#: Staged files are in the order of their dates; of short pages few are read beside those of a range of dates.
_STAGED_FILES = _FILES | {"parquet.page.row.count.limit": "8000"}
#: A month in so many versions is written anew by the next promotion that touches it.
MANY_VERSIONS = 8
#: Promotions of one store by threads of this driver take turns; with other drivers the manifest decides.
_TURNS: dict = defaultdict(threading.RLock)


def _last_commits(rows: DataFrame) -> DataFrame:
    """The last committed attempt of each batch."""
    return newest(rows, ("stream_id", "epoch_id"), "attempt")


def _last_versions(rows: DataFrame) -> DataFrame:
    """The newest versions of each month, and all attempts taken in."""
    months = newest(rows.where("period IS NOT NULL"), ("period",), "version")
    return months.unionByName(rows.where("attempt IS NOT NULL"), allowMissingColumns=True)


class FileStore:
    """``staging/stream_id=…/epoch_id=…/attempt=…/is_valid=…`` plus predictions kept in monthly versions.

    Batch numbers mean something only within a stream (a checkpoint and a model).
    Every write of a batch is an attempt of its own, which counts from the moment
    it is committed; the last one committed replaces earlier ones. Promotion takes
    in the committed attempts that no manifest row names yet. Under a name of its own it
    writes their rows beside the versions of months in which no key repeats, and rewrites the
    other months they touch; then it appends to the
    manifest, and until then readers see the old versions whole. Promotions by threads of one driver
    take turns. Of those that run at once in several drivers the first to append wins, and the others begin again on what it left.

    Commits and manifest are ledgers with a snapshot every ``every`` entries, so reading
    them takes a bounded number of files after any number of batches and promotions.
    """

    def __init__(self, spark: SparkSession, root: str, every: int = 100):
        self.spark = spark
        self.root = root
        self.staging = f"{root}/staging"
        self.data = f"{root}/predictions"
        self.commits = Ledger(spark, f"{root}/commits", T.StructType(_ATTEMPT_FIELDS), _last_commits, every)
        self.manifest = Ledger(spark, f"{root}/manifest", _MANIFEST_SCHEMA, _last_versions, every)

    def write_batch(self, scored: DataFrame, batch_id: int, stream_id: str = "batch") -> None:
        attempt = self._write_attempt(scored, batch_id, stream_id)
        self.commits.append([{"stream_id": stream_id, "epoch_id": batch_id, "attempt": attempt}])

    def _write_attempt(self, scored: DataFrame, batch_id: int, stream_id: str) -> str:
        if not re.fullmatch("[A-Za-z0-9_.-]+", stream_id):
            raise ValueError(f"stream id {stream_id!r} must be letters, digits, '_', '.' and '-'")
        attempt = uuid.uuid4().hex
        folder = self._folder(stream_id, batch_id, attempt)
        rows = scored.drop("epoch_id", "stream_id").sortWithinPartitions("is_valid", "date")
        rows.write.partitionBy("is_valid").options(**_STAGED_FILES).parquet(folder)
        return attempt

    def _folder(self, stream_id: str, epoch_id: int, attempt: str) -> str:
        return f"{self.staging}/stream_id={stream_id}/epoch_id={epoch_id}/attempt={attempt}"

    def _table(self, folder: str, schema: T.StructType) -> DataFrame:
        """A table that may not have been written yet; any other failure is raised."""
        try:
            return self.spark.read.schema(schema).parquet(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty_frame(self.spark, schema)

    def _committed(self) -> DataFrame:
        return _last_commits(self.commits.rows()).drop("turn")

    def staged(self) -> DataFrame:
        """All committed rows; filters on ``stream_id``, ``epoch_id`` and ``is_valid`` prune folders."""
        schema = T.StructType([*SCORED_SCHEMA.fields, T.StructField("attempt", T.StringType())])
        rows = self._table(self.staging, schema)
        return rows.join(self._committed(), list(_ATTEMPT), "left_semi").select(*SCORED_SCHEMA.fieldNames())

    def quarantined(self) -> DataFrame:
        return quarantine(self.staged())

    def _versions(self, manifest: DataFrame) -> dict[str, str]:
        """Newest versions per month: one driver row for each month of data."""
        months = newest(manifest.where("period IS NOT NULL"), ("period",), "version")
        return {r["period"]: r["version"] for r in months.collect()}

    def _read_months(self, versions: dict[str, str]) -> DataFrame:
        folders = [f"{self.data}/version={v}/period={p}" for p, vs in sorted(versions.items()) for v in vs.split(",")]
        if not folders:
            return empty_frame(self.spark, PREDICTION_SCHEMA)
        return self.spark.read.schema(PREDICTION_SCHEMA).parquet(*folders)

    def predictions(self, months=None) -> DataFrame:
        """Current predictions, optionally only of the given ``yyyy-MM`` months."""
        return self._predictions(self.manifest.rows(), months)

    def _predictions(self, manifest: DataFrame, months=None) -> DataFrame:
        versions = self._versions(manifest)
        if months is not None:
            versions = {p: v for p, v in versions.items() if p in set(months)}
        return self._read_months(versions)

    def promote(self, keys=PREDICTION_KEY) -> int:
        """Take in the batches committed since the last promotion; returns the months changed.

        Only their folders and the months they touch are read. One driver row for each new batch and touched month.
        """
        with _TURNS[self.root]:
            while True:
                manifest, turn = self.manifest.state()
                taken = manifest.where("attempt IS NOT NULL")
                pending = self._committed().join(taken, list(_ATTEMPT), "left_anti").select(*_ATTEMPT).collect()
                if not pending:
                    return 0
                months = self._merge(pending, manifest, keys)
                entries = [{"period": m, "version": versions} for m, versions in months.items()]
                entries += [r.asDict() for r in pending]
                if self.manifest.append(entries, after=turn):
                    return len(months)

    def _merge(self, pending, manifest: DataFrame, keys) -> dict[str, str]:
        """Write a new version of the pending rows; nobody sees it yet. Gives the versions of each month they touch."""
        folders = [self._folder(*r) for r in pending]
        rows = self.spark.read.schema(SCORED_SCHEMA).option("basePath", self.staging).parquet(*folders)
        fresh = accepted(rows)
        period = F.coalesce(F.date_format("date", "yyyy-MM"), F.lit("none"))
        month = F.coalesce(F.year("date") * 12 + F.month("date"), F.lit(-1))
        counts = month_counts(fresh, period, month)
        numbers = {(r["period"], r["month"]) for r in counts}
        if not numbers:
            return {}
        months, version = sorted({p for p, _ in numbers}), uuid.uuid4().hex
        held = {p: v for p, v in self._versions(manifest).items() if p in set(months)}
        beside = valid_rows(fresh, self._read_months(held))
        repeated = written(repeats_by_month(beside, month, keys), "repeated")
        is_apart = (F.col("n") > HOT) | (F.col("lo") != F.col("hi"))
        spans = repeated.groupBy("lo", "hi").agg(F.count("*").alias("n"), F.count_if(is_apart).alias("n_apart")).collect()
        again = {p for p, m in numbers if any(s["lo"] <= m <= s["hi"] for s in spans)}
        again |= {p for p, v in held.items() if v.count(",") + 1 >= MANY_VERSIONS}
        added = [m for m in months if m not in again]
        frames = []
        if added:
            rows = fresh.withColumn("period", period)
            frames.append(gathered_of_files(rows.where(F.col("period").isin(added)) if again else rows, "period", [r for r in counts if r["period"] in added], keys))
        if again:
            beside = valid_rows(fresh.where(period.isin(sorted(again))), self._read_months({p: v for p, v in held.items() if p in again}))
            n, n_apart = sum(s["n"] for s in spans), sum(s["n_apart"] for s in spans)
            frames += latest_rows_gathered(beside.withColumn("period", period), repeated, n, n_apart, "period", keys)
        for frame in frames:
            frame.write.mode("append").partitionBy("period").options(**_FILES).parquet(f"{self.data}/version={version}")
        return {m: version if m in again or m not in held else f"{held[m]},{version}" for m in months}


class JdbcStore:
    """The same steps against database tables. Refused rows go to a file folder.

    The staging table is append-only, because the JDBC writer cannot upsert; a
    repeated batch carries the same message ids and promotion removes its duplicates.
    """

    def __init__(self, spark: SparkSession, cfg: jdbc.JdbcConfig, quarantine_folder: str):
        self.spark = spark
        self.cfg = cfg
        self.quarantine_folder = quarantine_folder

    def write_batch(self, scored: DataFrame, batch_id: int, stream_id: str = "batch") -> None:
        with persisted(scored) as rows:
            jdbc.write_staging(accepted(rows), self.cfg)
            folder = f"{self.quarantine_folder}/stream={stream_id}/batch={batch_id}"
            quarantine(rows).write.mode("overwrite").parquet(folder)

    def promote(self, keys=PREDICTION_KEY, split_by=None) -> None:
        """Refill the predictions table.

        ``split_by`` reads both tables over several connections, see
        :func:`stridecast.sources.jdbc.table_options`.
        """
        options = jdbc.table_options(self.cfg, self.cfg.staging_table, split_by)
        staging = self.spark.read.format("jdbc").options(**options).load()
        current = jdbc.read_predictions(self.spark, self.cfg, split_by)
        # Written first: the target table is emptied while it is being replaced.
        jdbc.replace_predictions(written(promote_rows(staging, current, keys), "promoted"), self.cfg)
