"""One settlement, one commit: what a run wrote counts once its marker is there.

Bills and zone rows of a run lie in folders of their own, ``sim_day=D/commit=FOLDER``, so no
run touches what another one wrote, nor what a failed attempt of its own did. A row per
settled day in the commit table, written as one file after everything else, makes the run
visible; until then readers see the run before. The newest commit of a day wins, also if it
emptied the day.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

COMMIT = "commit"
COMMITS = (
    "sim_day date, run_id string, folder string, bills bigint, zones bigint, committed_at timestamp"
)
#: Which count of a commit says whether a table has rows of the day.
COUNTED = {"batch_household_bill": "bills", "batch_zone_daily": "zones"}


def new_folder(run_id: str) -> str:
    """A partition value for an attempt of the run, never read as a number or a date."""
    return f"r_{run_id}_{uuid.uuid4().hex[:12]}"


def write_run(rows: DataFrame, path: str, folder: str, sort_by: tuple[str, ...] = ()) -> None:
    """Write rows of any number of days under the folder; writing again replaces them.

    Rows are rebalanced by day: large days are split, small ones do not become one file per
    task.
    """
    out = rows.withColumn(COMMIT, F.lit(folder)).hint("rebalance", "sim_day")
    if sort_by:
        out = out.sortWithinPartitions("sim_day", *sort_by)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("sim_day", COMMIT)
        .parquet(path)
    )


def staged(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """What an attempt has written to a table, committed or not."""
    return spark.read.parquet(path).filter(F.col(COMMIT) == folder).drop(COMMIT)


def commit(
    spark: SparkSession, path: str, run_id: str, folder: str, days: list[date], **counts: DataFrame
) -> None:
    """Make the run visible for all of ``days``; ``bills`` and ``zones`` are its rows.

    The marker is one file with one row per day, which appears whole or not at all. Counts
    come from the written files.
    """
    stamp = datetime.now(timezone.utc)
    marker = spark.createDataFrame(
        [(d, run_id, folder, stamp) for d in days],
        "sim_day date, run_id string, folder string, committed_at timestamp",
    )
    for name, rows in counts.items():
        n = rows.groupBy("sim_day").agg(F.count(F.lit(1)).alias(name))
        marker = marker.join(n, "sim_day", "left").fillna(0, [name])
    fields = [c.split()[0] for c in COMMITS.split(", ")]
    marker.select(*fields).coalesce(1).write.mode("append").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """All commits; none before the first."""
    return spark.read.schema(COMMITS).parquet(path) if _exists(spark, path) else spark.createDataFrame([], COMMITS)


def newest(all_commits: DataFrame) -> DataFrame:
    """The commit that counts for each day."""
    last = F.max(F.struct("committed_at", "run_id", "folder", "bills", "zones")).alias("last")
    return all_commits.groupBy("sim_day").agg(last).select("sim_day", "last.*")


def committed(spark: SparkSession, path: str, commit_path: str) -> DataFrame:
    """The rows of a table that count, ``path`` ending in the table's name.

    Commits are few (one row a day), so the planner sends them to the scan, which then
    reads the folders of the newest runs only.
    """
    count = COUNTED[path.rstrip("/").rsplit("/", 1)[-1]]
    live = newest(commits(spark, commit_path)).filter(F.col(count) > 0).select(
        F.col("sim_day").alias("day"), "folder"
    )
    rows = spark.read.parquet(path)
    same = (rows["sim_day"] == F.col("day")) & (rows[COMMIT] == F.col("folder"))
    return rows.join(live, same, "left_semi").drop(COMMIT)


def committed_checks(checks: DataFrame, all_commits: DataFrame) -> DataFrame:
    """Check rows of the runs that count for their day; a failed run's are left out."""
    live = newest(all_commits).select("sim_day", "run_id")
    return checks.join(live, ["sim_day", "run_id"], "left_semi")


def billed_days(all_commits: DataFrame) -> DataFrame:
    """Days with at least one bill, from the commits alone."""
    return newest(all_commits).filter("bills > 0").select(F.col("sim_day").alias("sim_date"))


def remove_superseded(spark: SparkSession, commit_path: str, paths: list[str], days: list[date]) -> int:
    """Delete the folders of commits that a newer one replaced, and return their number.

    Folders without a commit may belong to a run that is still at work and stay.
    """
    known = commits(spark, commit_path).filter(F.col("sim_day").isin(days))
    newer = newest(known).select("sim_day", F.col("folder").alias("wins"))
    old = known.join(newer, "sim_day").filter("folder <> wins").select("sim_day", "folder").distinct()
    removed = 0
    for r in old.collect():  # one row per replaced day and attempt
        for path in paths:
            where = f"{path.rstrip('/')}/sim_day={r['sim_day'].isoformat()}/{COMMIT}={r['folder']}"
            folder = spark._jvm.org.apache.hadoop.fs.Path(where)
            removed += folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return removed
