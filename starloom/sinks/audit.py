"""Write, audit, publish: rows are counted by the write that stages them, checked, and only then become visible."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.plans import quality
from starloom.sinks.loads import load, read_as, table_exists
from starloom.sources.staging import REJECTED


@dataclass(frozen=True)
class Staged:
    """Rows written out of sight, and what was counted in the same pass."""

    rows: DataFrame
    path: str
    counted: dict[str, int]


def stage(
    df: DataFrame, path: str, measures: dict[str, Column] | None = None, partition_by: list[str] | None = None
) -> Staged:
    """Write ``df`` to ``path``, in place of what lies there, and count ``measures`` and ``rows`` on the way.

    The counting stands after the shuffle, in the tasks that write: each of these counts once, however
    often the ones before it are repeated.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    seen = Observation()
    values = [value.cast("bigint").alias(name) for name, value in (measures or {}).items()]
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *values).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return Staged(read_as(df, path), path, dict(seen.get))


def stage_lines(parsed: DataFrame, path: str, rejects: str, what: str, most_rejected: float) -> DataFrame:
    """One pass over lines of ``staging.marked``: the good ones staged and returned, the bad ones kept at ``rejects``.

    Raises, with nothing but the rejects to be seen, when more than the share ``most_rejected`` is bad.
    """
    bad = F.col(REJECTED).isNotNull()
    split = parsed.withColumn("rejected", bad)
    staged = stage(split, path, {"bad": F.count_if(bad)}, ["rejected"])
    load(staged.rows.where("rejected").select(F.col(REJECTED).alias("text")), rejects, "overwrite")
    rows, found = staged.counted["rows"], staged.counted["bad"]
    if found > most_rejected * rows:
        raise quality.QualityError(f"{what}: {found} of {rows} lines rejected, at most {most_rejected:.2%} may be")
    return staged.rows.where("NOT rejected").drop("rejected", REJECTED)


def null_counts(columns: list[str]) -> dict[str, Column]:
    return {f"{c} null": quality.null_count(c) for c in columns}


def key_checks(staged: dict[str, Staged], keys: dict[str, list[str]]) -> list[tuple[str, int, int]]:
    """No NULL in the keys of the staged rows; needs ``null_counts`` of them. No table is read."""
    return [(f"{t}.{c} has no null", staged[t].counted[f"{c} null"], 0) for t, columns in keys.items() for c in columns]


def row_checks(spark: SparkSession, staged: dict[str, Staged], tables: list[str], root: str | None) -> list[tuple]:
    """Each table has rows: staged ones or, only looked for without these, visible ones below ``root`` that stay."""

    def filled(name: str) -> int:
        if staged[name].counted["rows"] or not root or not table_exists(spark, f"{root}/{name}"):
            return int(staged[name].counted["rows"] > 0)
        return int(not read_as(staged[name].rows, f"{root}/{name}").isEmpty())

    return [(f"{name} has rows", filled(name), 1) for name in tables]


def publish(staged: Staged, path: str, partition_by: list[str] | None = None) -> None:
    """Append the staged rows to the visible table; its commit moves the files in when all are written."""
    load(staged.rows, path, "append", partition_by)


def swap(spark: SparkSession, staged: Staged, path: str) -> None:
    """Put the staged table in place of the visible one by two renames.

    A run killed between them leaves the old table beside its place; ``recover`` puts it back.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(conf)
    recover(spark, path)
    if fs.exists(at(path)) and not fs.rename(at(path), at(f"{path}__old")):
        raise OSError(f"could not move {path}")
    if not fs.rename(at(staged.path), at(path)):
        raise OSError(f"could not move {staged.path}")
    fs.delete(at(f"{path}__old"), True)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap of ``path`` that was killed half-way."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    here, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}__old"))
    fs = here.getFileSystem(conf)
    if fs.exists(old):
        if fs.exists(here):
            fs.delete(old, True)
        else:
            fs.rename(old, here)
