"""Materialisations.

* ``write_table``       — S6 full refresh (overwrite), with S10 clustering.
* ``insert_overwrite``  — S9: replace only the ``report_date`` partitions present
                          in the result (dynamic partition overwrite).
* ``merge_upsert``      — S7/S8: keyed upsert on plain parquet: matched rows take
                          the new values of the listed columns only, the others
                          keep their first value; new keys are inserted.  Only
                          files that hold a key of the updates are rewritten.
* ``merge_upsert_partitions`` — the same on a date-partitioned table, reading and
                          replacing only the partitions the new rows touch.
* ``register_view``     — S15: a temp view over a DataFrame.

``merge_upsert`` writes the new files beside the target (``_merge/<table>`` in its
parent folder), with the names of the files they replace; one folder rename makes them
ready, and then they are moved in and the replaced files removed.
``merge_upsert_partitions`` stages the merged partitions under the session's shared
checkpoint folder and overwrites the target's from there, with a pending record
until the copy has finished.  If a run dies in between, ``recover_pending`` completes the
publish, which every upsert (and every run, before it reads the target) calls first.
The target is never overwritten while it is being read.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quayside.operators import relops as R
from quayside.session import checkpoint_dir
from quayside.sources.declared import SchemaError, check


def _clustered(df: DataFrame, cluster_by: Sequence[str] | None, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Range-partition and sort rows by the clustering columns so each file
    covers a narrow key range and parquet min/max statistics prune well.

    A deterministic row hash is the last range key: a clustering value that
    holds a large share of the rows is split over several tasks (and files)
    instead of landing in one, and a retried task sees the same partitioning.
    """
    if not cluster_by:
        return df
    keys = [*(partition_by or []), *cluster_by]
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.repartitionByRange(*[F.col(k) for k in keys], spread).sortWithinPartitions(*keys)


def _as_is(df: DataFrame) -> DataFrame:
    return df


def write_table(df: DataFrame, path: str, cluster_by: Sequence[str] | None = None, fmt: str = "parquet",
                watch: Callable[[DataFrame], DataFrame] = _as_is) -> None:
    """``materialized='table'`` — replace the target.  ``watch`` sees the rows as they are written."""
    watch(_clustered(df, cluster_by)).write.mode("overwrite").format(fmt).save(path)


def insert_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ("report_date",),
                     cluster_by: Sequence[str] | None = None, fmt: str = "parquet",
                     watch: Callable[[DataFrame], DataFrame] = _as_is) -> None:
    """Only partitions present in ``df`` are replaced; the others survive.  ``watch`` as for ``write_table``."""
    (watch(_clustered(df, cluster_by, partition_by)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).format(fmt).save(path))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``; None only where there is no such path."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system it lies in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def one_row_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key, chosen by a full order over the columns (values before
    NULLs, the greatest first), so the choice does not depend on partitioning."""
    order = [F.col(c).desc_nulls_last() for c in df.columns if c not in key]
    return R.pick_first(df, list(key), order)


def staged_updates(spark: SparkSession, updates: DataFrame, key: Sequence[str], fmt: str = "parquet") -> tuple[DataFrame, str]:
    """``updates`` without exact repeats, written to a stage folder; an error where two
    different rows share a key, for a merge cannot take both."""
    stage = os.path.join(checkpoint_dir(spark), "quayside-merge", uuid.uuid4().hex)
    updates.distinct().write.format(fmt).save(stage)
    staged = spark.read.format(fmt).load(stage)
    _refuse_shared_keys(staged, key)
    return staged, stage


def _refuse_shared_keys(rows: DataFrame, key: Sequence[str]) -> None:
    twice = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"different rows share the merge key: {twice[0].asDict()}")


def merged(target: DataFrame | None, updates: DataFrame, key: Sequence[str],
           update_columns: Sequence[str], group_key: Sequence[str] = (), groups: DataFrame | None = None) -> DataFrame:
    """S7/S8 as a full outer join on the key.

    matched      → listed columns from ``updates``, the rest from ``target``
    updates only → the new row
    target only  → unchanged; with ``group_key``, gone where ``groups`` (by default ``updates``) has its group
    """
    key = list(key)
    if target is None:
        return updates
    cols = target.columns
    upd = set(update_columns) - set(key)
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in cols], F.lit(True).alias("t__hit"))
    s = updates.select(*[F.col(c).alias(f"s__{c}") for c in cols], F.lit(True).alias("s__hit"))
    cond = [t[f"t__{k}"].eqNullSafe(s[f"s__{k}"]) for k in key]
    j = t.join(s, cond, "full_outer")
    if group_key:
        named = updates if groups is None else groups
        groups = named.select(*[F.col(k).alias(f"g__{k}") for k in group_key]).distinct().withColumn("g__hit", F.lit(True))
        j = j.join(groups, [F.col(f"t__{k}").eqNullSafe(F.col(f"g__{k}")) for k in group_key], "left") \
            .where(F.col("s__hit").isNotNull() | F.col("g__hit").isNull())
    matched = F.col("t__hit") & F.col("s__hit")
    out = []
    for c in cols:
        tc, sc = F.col(f"t__{c}"), F.col(f"s__{c}")
        if c in key:
            out.append(F.coalesce(tc, sc).alias(c))
        elif c in upd:
            out.append(F.when(matched | F.col("t__hit").isNull(), sc).otherwise(tc).alias(c))
        else:
            out.append(F.when(F.col("t__hit").isNull(), sc).otherwise(tc).alias(c))
    return j.select(*out)


_PENDING_SCHEMA = "stage string, partition_by string, cluster_by string, fmt string"


def _pending_path(spark: SparkSession, path: str) -> str:
    return os.path.join(checkpoint_dir(spark), "quayside-merge", "pending", hashlib.md5(path.encode()).hexdigest())


def _publish(spark: SparkSession, stage: str, path: str, partition_by: Sequence[str], cluster_by: Sequence[str],
             fmt: str) -> None:
    """Copy a staged merge result onto the target.  A pending record names the
    stage until the copy has finished, so a run that died half-way through
    the copy (after the old files were removed) is completed by the next one."""
    record = _pending_path(spark, path)
    spark.createDataFrame([(stage, ",".join(partition_by), ",".join(cluster_by), fmt)], _PENDING_SCHEMA).write.mode("overwrite").parquet(record)
    staged = spark.read.format(fmt).load(stage)
    if partition_by:
        insert_overwrite(staged, path, partition_by=list(partition_by), cluster_by=cluster_by, fmt=fmt)
    else:
        write_table(staged, path, cluster_by=cluster_by, fmt=fmt)
    spark.createDataFrame([], _PENDING_SCHEMA).write.mode("overwrite").parquet(record)
    delete_path(spark, stage)


def _beside(path: str) -> str:
    """Where merges of the table at ``path`` put their files: the same file system, and hidden from readers of the parent folder."""
    parent, name = os.path.split(path.rstrip("/"))
    return os.path.join(parent, "_merge", name)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _publish_files(spark: SparkSession, stage: str, path: str, replaced: DataFrame) -> None:
    """Make the staged files ready, with the names (``file``) of those they replace, and publish them."""
    replaced.select("file").coalesce(1).write.parquet(f"{stage}/replaced")
    ready, fs = _fs(spark, f"{_beside(path)}/ready")
    if not fs.rename(_fs(spark, stage)[0], ready):
        raise OSError(f"{stage} could not be renamed")
    _finish_files(spark, path)


def _finish_files(spark: SparkSession, path: str) -> bool:
    """Move files that are ready into the table at ``path`` and remove the replaced ones; True if there were any.
    Each step leaves alone what an earlier, interrupted try has done."""
    ready, fs = _fs(spark, f"{_beside(path)}/ready")
    if not fs.exists(ready):
        return False
    replaced = [r.file for r in spark.read.parquet(f"{ready}/replaced").collect()]  # names of files, as a listing gives them
    target, _ = _fs(spark, path)
    fs.mkdirs(target)
    for f in fs.listStatus(_fs(spark, f"{ready}/data")[0]):
        name = f.getPath().getName()
        if not name.startswith("_") and not fs.rename(f.getPath(), _fs(spark, f"{path}/{name}")[0]):
            raise OSError(f"{f.getPath()} could not be moved to {path}")
    for name in replaced:
        fs.delete(_fs(spark, f"{path}/{name}")[0], False)
    fs.delete(ready, True)
    spark.catalog.refreshByPath(path)
    return True


def recover_pending(spark: SparkSession, path: str) -> bool:
    """Finish an interrupted publish of ``path``; True if there was one."""
    if _finish_files(spark, path):
        return True
    rec = read_table(spark, _pending_path(spark, path))
    row = rec.first() if rec is not None else None  # at most one row
    if row is None:
        return False
    named = [[c for c in x.split(",") if c] for x in (row.partition_by, row.cluster_by)]
    _publish(spark, row.stage, path, *named, row.fmt)
    return True


def touched_files(target: DataFrame, updates: DataFrame, key: Sequence[str], cluster_by: Sequence[str] = ()) -> DataFrame:
    """``file``: the names of the target's files that hold a key of ``updates``.  Only the key columns are read,
    and, where the table is clustered by a key column, only row groups within the updates' range of it."""
    rows = target.select(*key, F.col("_metadata.file_name").alias("file"))
    if cluster_by and cluster_by[0] in key:
        c = cluster_by[0]
        span = updates.agg(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(F.when(F.col(c).isNull(), 1)).alias("nulls")).first()  # one row
        if span.lo is not None:
            within = F.col(c).between(F.lit(span.lo), F.lit(span.hi))
            rows = rows.where(within | F.col(c).isNull() if span.nulls else within)
    keys = updates.select(*[F.col(k).alias(f"k__{k}") for k in key]).distinct()
    return rows.join(keys, [F.col(k).eqNullSafe(F.col(f"k__{k}")) for k in key], "left_semi").select("file").distinct()


def _same_columns(target: DataFrame, updates: DataFrame, path: str) -> None:
    """Refuse a table that lacks columns of the updates, or has them with other types."""
    missing = [c for c in updates.columns if c not in target.columns]
    if missing:
        raise SchemaError(f"the table at {path} was written without the columns {missing}; write it anew")
    check(f"the table at {path}", target.schema, updates.schema)


def merge_upsert(spark: SparkSession, updates: DataFrame, path: str, key: Sequence[str],
                 update_columns: Sequence[str], cluster_by: Sequence[str] = (), fmt: str = "parquet",
                 group_key: Sequence[str] = (), groups: DataFrame | None = None) -> DataFrame:
    """Apply ``updates`` to the table at ``path`` and return the new table.

    ``groups`` are the groups to replace, where more than those of the updates: rows of a group without updates are removed.
    The first run writes the updates once and moves them in.  Later runs find the files that hold a key of the updates (with
    ``group_key``, a group of theirs), merge the rows of these files alone and replace them; other files stay as they are."""
    recover_pending(spark, path)
    target = read_table(spark, path, fmt)
    stage = os.path.join(_beside(path), uuid.uuid4().hex)
    no_files = spark.createDataFrame([], "file string")
    if target is None:
        _clustered(updates.distinct(), cluster_by).write.format(fmt).save(f"{stage}/data")
        try:
            _refuse_shared_keys(spark.read.format(fmt).load(f"{stage}/data"), key)
        except ValueError:
            delete_path(spark, stage)
            raise
        _publish_files(spark, stage, path, no_files)
        return spark.read.format(fmt).load(path)
    _same_columns(target, updates, path)
    new, new_stage = staged_updates(spark, updates, key, fmt)
    groups = new if groups is None or not group_key else groups.select(*group_key).unionByName(new.select(*group_key))
    files = [r.file for r in touched_files(target, groups, list(group_key) or list(key), cluster_by).collect()]  # as a listing gives them
    if files:
        rows = spark.read.format(fmt).schema(target.schema).load([f"{path}/{f}" for f in files])
    else:
        rows = target.limit(0)
    result = merged(rows, new, key, update_columns, group_key, groups)
    _clustered(result, cluster_by).write.format(fmt).save(f"{stage}/data")
    _publish_files(spark, stage, path, spark.createDataFrame([(f,) for f in files], "file string") if files else no_files)
    delete_path(spark, new_stage)
    return spark.read.format(fmt).load(path)


def merge_upsert_partitions(spark: SparkSession, updates: DataFrame, path: str, key: Sequence[str],
                            update_columns: Sequence[str], partition_by: Sequence[str],
                            cluster_by: Sequence[str] = (), fmt: str = "parquet") -> DataFrame:
    """S7 on a table partitioned by ``partition_by``: only partitions that receive
    new rows are read, merged and replaced (dynamic partition overwrite).

    Requires the partition columns to be determined by the key (e.g. the
    report date is part of the metric key), so a key never moves between
    partitions.  The touched partitions are selected with a semi join on the
    partition values of ``updates``; the target scan is pruned to them.
    """
    recover_pending(spark, path)
    new, new_stage = staged_updates(spark, updates, key, fmt)
    target = read_table(spark, path, fmt)
    if target is None:
        insert_overwrite(new, path, partition_by=partition_by, cluster_by=cluster_by, fmt=fmt)
    else:
        _same_columns(target, new, path)
        current = target.join(new.select(*partition_by).distinct(), list(partition_by), "left_semi")
        result = merged(current, new.select(*target.columns), key, update_columns)
        stage = os.path.join(checkpoint_dir(spark), "quayside-merge", uuid.uuid4().hex)
        result.select(*target.columns).write.format(fmt).save(stage)
        _publish(spark, stage, path, partition_by, cluster_by, fmt)
    delete_path(spark, new_stage)
    return spark.read.format(fmt).load(path)


def ci_limit(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in grain order, in CI runs only; for tables that are replaced
    as a whole, never for merges or partition overwrites."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n) if n else df


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``materialized='view'``."""
    df.createOrReplaceTempView(name)
    return df
