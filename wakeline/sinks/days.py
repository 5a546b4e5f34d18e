"""The telemetry lake by day: open days by micro-batch, closed days clustered by mission.

``open/day=D/batch_id=N`` takes what arrives; a micro-batch touches the folders of the days it holds, mostly one. A closed
day is rewritten once as ``closed/day=D/upto=N``: its rows of all batches up to N in files of equal size, cut by sampled
bounds of (mission, arrival), so that a mission is found by the files' and row groups' statistics, and a hot one fills files
of its own. What arrives for a closed day later stays open until the day is rewritten again. Readers take the newest
rewriting of a day and the open batches behind it; both kinds of folder appear at once and are never changed, so a reader
sees each row once, whatever else runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from wakeline.operators.aggregates import count_into
from wakeline.operators.skew import ROWS_PER_SLICE, spread_for_write
from wakeline.schemas import LONG, TELEMETRY

#: Day of rows whose time cannot be read.
NO_DAY = "none"
_ROWS = T.StructType([*TELEMETRY.fields, T.StructField("seq", LONG)])


def day_of(timestamp: Column) -> Column:
    day = F.substring(timestamp, 1, 10)
    return F.when(day.try_cast("date").isNotNull() & day.rlike(r"^\d{4}-\d\d-\d\d$"), day).otherwise(NO_DAY)


@dataclass(frozen=True)
class DayLake:
    spark: SparkSession
    path: str

    def write(self, parsed: DataFrame, batch_id: int, rows_per_file: int = ROWS_PER_SLICE, counter: Observation | None = None) -> None:
        """Add a micro-batch; one that is written again replaces its own rows."""
        rows = parsed.select(*_ROWS.names).withColumns({"day": day_of(F.col("timestamp")), "batch_id": F.lit(batch_id).cast("bigint")})
        spread = spread_for_write(rows, "day", F.struct("mission_id", "seq"), rows_per_file).sortWithinPartitions("day", "mission_id", "seq")
        self._put(count_into(spread, counter), "open", "batch_id")

    def read(self, mission_id: str | None = None, days: list[str] | None = None) -> DataFrame:
        """All rows, or those of a mission (found by statistics) or of some days."""
        closed = self.closed()
        paths = [f"{self.path}/closed/day={d}/upto={n}" for d, n in closed.items()]
        paths += [f"{self.path}/open/day={d}/batch_id={n}" for d, n in self._listed("open", "batch_id") if n > closed.get(d, -1)]
        if days is not None:
            paths = [p for p in paths if p.split("/day=")[1].split("/")[0] in days]
        if not paths:
            return self.spark.createDataFrame([], _ROWS)
        rows = self.spark.read.schema(_ROWS).parquet(*sorted(paths))
        return rows if mission_id is None else rows.where(F.col("mission_id") == mission_id)

    def closed(self) -> dict[str, int]:
        """Rewritten days with the last batch they hold."""
        newest: dict[str, int] = {}
        for day, upto in self._listed("closed", "upto"):
            newest[day] = max(upto, newest.get(day, upto))
        return newest

    def compact(self, before: str, upto: int, rows_per_file: int = ROWS_PER_SLICE) -> list[str]:
        """Rewrite the days before ``before`` that have open batches up to ``upto``; returns them.

        ``upto`` is a batch that the stream has committed. A run repeated after a loss writes the same folders again.
        Folders that an earlier run has replaced are deleted first: readers had a whole run's time to let go of them.
        """
        self._tidy()
        closed = self.closed()
        fresh = {d for d, n in self._listed("open", "batch_id") if d < before and closed.get(d, -1) < n <= upto}
        if not fresh:
            return []
        paths = [f"{self.path}/closed/day={d}/upto={n}" for d, n in closed.items() if d in fresh]
        paths += [f"{self.path}/open/day={d}/batch_id={n}" for d, n in self._listed("open", "batch_id") if d in fresh and closed.get(d, -1) < n <= upto]
        rows = self.spark.read.schema(_ROWS).parquet(*sorted(paths)).withColumn("day", day_of(F.col("timestamp")))
        files = max(1, -(-rows.count() // rows_per_file))
        placed = rows.withColumn("upto", F.lit(upto).cast("bigint"))
        placed = placed.repartitionByRange(files, "day", "mission_id", "seq").sortWithinPartitions("day", "mission_id", "seq")
        self._put(placed, "closed", "upto")
        return sorted(fresh)

    def _put(self, rows: DataFrame, kind: str, by: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", by).parquet(f"{self.path}/{kind}")

    def _tidy(self) -> None:
        closed = self.closed()
        old = [f"closed/day={d}/upto={n}" for d, n in self._listed("closed", "upto") if n < closed[d]]
        old += [f"open/day={d}/batch_id={n}" for d, n in self._listed("open", "batch_id") if n <= closed.get(d, -1)]
        for name in old:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _listed(self, kind: str, by: str) -> list[tuple[str, int]]:
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/day=*/{by}=*")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        names = [(s.getPath().getParent().getName(), s.getPath().getName()) for s in found]
        return [(day.split("=", 1)[1], int(name.split("=", 1)[1])) for day, name in names]
