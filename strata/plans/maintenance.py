"""Table upkeep: publish-by-swap, compaction, upsert, backfill, increments,
readiness, inventory, freshness and retention.

Rewriting a table in place (read a path, overwrite the same path) deletes
the data it is reading. Every rewrite here writes a new folder first,
checks the rows, then swaps folders (compaction: files); a failed check leaves the old
table untouched. A swap is two renames; if a run ends between them, ``recover``
restores the old version. On object stores readers should go through a
catalog location switch instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import as_date, in_date_range
from .writers import write_table


class PublishError(Exception):
    pass


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def swap(spark: SparkSession, path: str, staging: str) -> None:
    """Move ``staging`` into ``path``; the previous content is removed last."""
    fs, p = _fs(spark, path)
    _, s = _fs(spark, staging)
    jvm = spark.sparkContext._jvm
    backup = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + f".__old_{uuid.uuid4().hex[:8]}")
    had_old = fs.exists(p)
    if had_old and not fs.rename(p, backup):
        raise PublishError(f"could not move {path} aside")
    if not fs.rename(s, p):
        if had_old:
            fs.rename(backup, p)
        raise PublishError(f"could not move {staging} to {path}")
    if had_old:
        fs.delete(backup, True)


def list_tables(spark: SparkSession, root: str) -> list[str]:
    """Names of the table folders directly under ``root`` (hidden/staging ones skipped)."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(n for n in names if not n.startswith((".", "_")) and ".__" not in n)


def publish_swap(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                 **write_opts) -> int:
    """Write ``df`` to a new folder, verify its row count, swap it in. Returns rows."""
    staging = path.rstrip("/") + f".__staging_{uuid.uuid4().hex[:8]}"
    obs = Observation("publish")
    write_table(df, staging, partition_by, observation=obs, **write_opts)
    written = int(obs.get["rows"])
    read_back = spark.read.parquet(staging).count()
    if read_back != written:
        _fs(spark, staging)[0].delete(_fs(spark, staging)[1], True)
        raise PublishError(f"row check failed for {path}: wrote {written}, read {read_back}")
    swap(spark, path, staging)
    return written


# Files under this share of the target size are worth merging.
SMALL_SHARE = 0.75
TARGET_BYTES = 256 << 20
FILES_AT_ONCE = 50_000  # files that one rewrite reads; a table with more takes several rounds


def list_files(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """(table_name, file_path, path, bytes, modified) of every data file, also files without rows.

    Only listings are read (in Spark tasks once there are many folders), no
    file is opened. A table without a folder, or an empty one, has no rows here.
    """
    out = spark.createDataFrame([], "table_name string, file_path string, path string, bytes long, modified timestamp")
    for name, path in tables.items():
        if not path_exists(spark, path):
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        out = out.unionByName(files.select(F.lit(name).alias("table_name"), F.col("_metadata.file_path").alias("file_path"), "path",
                                           F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")))
    return out


def compaction_plan(files: DataFrame, target_bytes: int) -> DataFrame:
    """Files to rewrite (folder, file_path, path, bytes, bin): bins of small files of one folder, filled in order of path
    up to the target size. A bin of one file is left alone, so is a file of ``SMALL_SHARE`` of the target or more."""
    small = files.where(F.col("bytes") < int(target_bytes * SMALL_SHARE)).withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]+$", 1))
    before = F.sum("bytes").over(Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
    binned = small.withColumn("bin", F.floor(F.coalesce(before, F.lit(0)) / target_bytes))
    mates = F.count(F.lit(1)).over(Window.partitionBy("folder", "bin"))
    return binned.withColumn("mates", mates).where("mates > 1").select("folder", "file_path", "path", "bytes", "bin")


def _contents(df: DataFrame, columns: Sequence[str]) -> tuple[int, object]:
    """Row count and an order-free sum of row hashes."""
    row = F.xxhash64(F.to_json(F.struct(*columns))) if columns else F.lit(0)
    got = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)"))).first()
    return got[0], got[1]


def compact(spark: SparkSession, path: str, partition_by: Sequence[str] | None = None,
            target_files: int | None = None, cluster_by: Sequence[str] | None = None,
            max_records_per_file: int | None = None, target_bytes: int = TARGET_BYTES) -> dict:
    """Merge small files of each partition folder into files of about ``target_bytes`` (M1/M2).

    Only files that are in a bin with others are read and rewritten; a second
    run finds none. A heavy partition has several bins, so no task writes more
    than one file of the target size. Folders keep their names, no partition
    value is parsed. ``target_files`` sets the target by the table's size instead.
    ``partition_by`` is not needed any more and kept for callers that name it.

    New files are written to a hidden folder of the table, their rows are held
    against the old ones (count and sum of row hashes), and a journal of the
    moves is written. Then old files move to the hidden folder and new ones to their
    place. A run that ends in between is finished by ``finish_compaction``, which
    every compaction calls first.
    """
    finish_compaction(spark, path)
    done = {"rows": 0, "files_rewritten": 0}
    before = files = list_files(spark, {"t": path})
    n_before, size = before.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    if target_files:
        target_bytes = max(1, -(-(size or 0) // target_files))
    while True:
        chosen = compaction_plan(files, target_bytes).orderBy("folder", "bin", "path").limit(FILES_AT_ONCE + 1).collect()
        if len(chosen) > FILES_AT_ONCE:  # whole bins only
            last = (chosen[-1]["folder"], chosen[-1]["bin"])
            chosen = [r for r in chosen if (r["folder"], r["bin"]) != last] or chosen
        if not chosen:
            break
        done["rows"] += _rewrite(spark, path, chosen, cluster_by, max_records_per_file)
        done["files_rewritten"] += len(chosen)
        if len(chosen) < FILES_AT_ONCE // 2:
            break
        files = list_files(spark, {"t": path})
    return done | {"files_before": n_before, "files_after": list_files(spark, {"t": path}).count()}


def _rewrite(spark: SparkSession, path: str, chosen: list, cluster_by: Sequence[str] | None, max_records: int | None) -> int:
    """Rewrite the chosen files, one new file per bin; returns their rows."""
    bins = {key: i for i, key in enumerate(dict.fromkeys((r["folder"], r["bin"]) for r in chosen))}
    work = f"{path.rstrip('/')}/_compact-{uuid.uuid4().hex[:8]}"
    plan = spark.createDataFrame([(r["file_path"], bins[r["folder"], r["bin"]]) for r in chosen], "__file string, __bin int")
    old = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(*[r["path"] for r in chosen])
    columns = old.columns
    placed = old.select("*", F.col("_metadata.file_path").alias("__file")).join(plan, "__file").drop("__file")
    placed = placed.repartitionById(len(bins), F.col("__bin"))
    if cluster_by:
        placed = placed.sortWithinPartitions(*[c for c in cluster_by if c in columns])
    write_table(placed, f"{work}/new", ["__bin"], max_records_per_file=max_records)
    new = spark.read.schema(old.schema).option("recursiveFileLookup", "true").parquet(f"{work}/new")
    rows, digest = _contents(old, columns)
    if _contents(new, columns) != (rows, digest):
        remove_path(spark, work)
        raise PublishError(f"compaction of {path} changed the rows of {len(chosen)} files")
    folders = [""] * len(bins)
    for (folder, _), i in bins.items():
        folders[i] = folder
    written = list_files(spark, {"t": f"{work}/new"}).select("path").collect()
    moves = [(r["path"], f"{work}/old/{i}") for i, r in enumerate(chosen)]
    moves += [(r["path"], f"{folders[int(r['path'].split('/__bin=')[1].split('/')[0])]}/{r['path'].rsplit('/', 1)[1]}") for r in written]
    move_files(spark, path, work, moves)
    return rows


def move_files(spark: SparkSession, path: str, work: str, moves: Sequence[tuple[str, str]]) -> None:
    """Carry out moves of files in their order, from a journal in ``work``, a ``_compact-`` folder of the table, which is removed then."""
    steps = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(moves)], "step int, source string, target string")
    steps.coalesce(1).write.mode("overwrite").parquet(f"{work}/journal")
    finish_compaction(spark, path)


def finish_compaction(spark: SparkSession, path: str) -> int:
    """Carry out the moves of journals that a compaction left; unfinished rewrites without one are removed. Returns the moves made."""
    fs, p = _fs(spark, path)
    made = 0
    if not fs.exists(p) or not fs.isDirectory(p):
        return made
    jvm = spark.sparkContext._jvm
    for work in [str(st.getPath()) for st in fs.listStatus(p) if st.getPath().getName().startswith("_compact-")]:
        if path_exists(spark, f"{work}/journal/_SUCCESS"):
            fs.mkdirs(_fs(spark, f"{work}/old")[1])
            steps = spark.read.schema("step int, source string, target string").parquet(f"{work}/journal").orderBy("step").collect()
            for r in steps:  # a step that is done has no source any more
                source, target = (jvm.org.apache.hadoop.fs.Path(r[c]) for c in ("source", "target"))
                if fs.exists(source):
                    fs.mkdirs(target.getParent())
                    if not fs.rename(source, target):
                        raise PublishError(f"could not move {r['source']} to {r['target']}")
                    made += 1
        remove_path(spark, work)
    return made


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Match on keys → the source row replaces the target row; no match → insert.

    ``target ⋉̸ source ∪ source``: one anti join on the keys, no MERGE needed.
    """
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source)


def date_slice(df: DataFrame, ts_col: str, start: date | str = "1900-01-01",
               end: date | str = "9999-12-30") -> DataFrame:
    """Rows whose time falls on start..end, both dates inclusive.

    Written as ts >= start AND ts < end + 1 day, so Parquet min/max stats and
    partition pruning apply and no per-row date conversion is needed."""
    return df.filter(in_date_range(ts_col, start, end, df.schema[ts_col].dataType))


def incremental_slice(df: DataFrame, col: str, low, high) -> DataFrame:
    """High-water-mark increment: low < col <= high."""
    c = F.col(col)
    dtype = df.schema[col].dataType
    return df.filter((c > F.lit(str(low)).cast(dtype)) & (c <= F.lit(str(high)).cast(dtype)))


def in_partitions(df: DataFrame, columns: Sequence[str], partitions: Sequence) -> Column:
    """A row's partition is one of ``partitions`` (rows or tuples of values), as literals, so that scans are pruned to them."""
    cond = F.lit(False)
    for values in partitions:
        one = F.lit(True)
        for c, v in zip(columns, values):
            one = one & (df[c].isNull() if v is None else df[c] == F.lit(v))
        cond = cond | one
    return cond


def replace_rows(spark: SparkSession, new: DataFrame, path: str, partition_by: Sequence[str],
                 stale: DataFrame | None = None, keys: Sequence[str] = (), inside: Column | None = None) -> None:
    """Replace some rows of a table by ``new``; every other row stays.

    Replaced are the rows whose ``keys`` are in ``stale`` and those for which
    ``inside`` holds. Only partitions that lose or gain rows are rewritten: their
    remaining rows are joined to the new ones in a staging folder, which then
    overwrites exactly these partitions. A partition left without rows is
    removed. So a slice that covers part of a partition, or a row that moves to
    another one, neither loses nor doubles anything.

    What is read of the old table: the touched partitions whole; to find them,
    the columns of ``inside`` (a date range is pushed to the scan) and, with
    ``stale``, the keys. Their list, at most one entry per partition, is a
    literal of the plan, so nothing else is scanned. A run that ends while it
    overwrites is finished by ``finish_replace``, which the next one calls first.
    """
    parts = list(partition_by)
    finish_replace(spark, path, parts)
    staging = path.rstrip("/") + f".__replace_{uuid.uuid4().hex[:8]}"
    if not path_exists(spark, path):
        write_table(new, path, parts)
        return
    old = spark.read.parquet(path).select(*new.columns)
    touched = new.select(*parts)
    if inside is not None:
        touched = touched.union(old.filter(inside).select(*parts))
    if stale is not None:
        stale = stale.select(*keys).distinct()
        touched = touched.union(old.select(*keys, *parts).join(stale, list(keys), "left_semi").select(*parts))
    touched = [tuple(r) for r in touched.distinct().collect()]  # at most one row per partition
    kept = old.filter(in_partitions(old, parts, touched))
    if inside is not None:
        kept = kept.filter(~F.coalesce(inside, F.lit(False)))
    if stale is not None:
        kept = kept.join(stale, list(keys), "left_anti").select(*new.columns)
    write_table(new.unionByName(kept), f"{staging}/rows", parts)
    write_table(spark.createDataFrame(touched, new.select(*parts).schema), f"{staging}/touched")
    _publish_replaced(spark, path, staging, new.schema, parts)


def _publish_replaced(spark: SparkSession, path: str, staging: str, schema, parts: Sequence[str]) -> None:
    rows = spark.read.schema(schema).parquet(f"{staging}/rows")
    touched = spark.read.schema(rows.select(*parts).schema).parquet(f"{staging}/touched")
    write_table(rows, path, parts, mode="overwrite", dynamic=True)
    left = rows.select(*parts).distinct()
    delete_partitions(spark, path, touched.join(left, _null_safe(touched, left, parts), "left_anti"), parts)
    remove_path(spark, staging)


def finish_replace(spark: SparkSession, path: str, partition_by: Sequence[str]) -> int:
    """Overwrite again what an interrupted ``replace_rows`` had staged whole; what was staged in part is removed.

    Overwriting the same partitions by the same rows twice changes nothing."""
    fs, pattern = _fs(spark, path.rstrip("/") + ".__replace_*")
    done = 0
    for st in fs.globStatus(pattern) or []:
        staging = str(st.getPath())
        if path_exists(spark, f"{staging}/touched/_SUCCESS"):
            schema = spark.read.parquet(path).schema  # partition columns come last here, as in the staged folders
            _publish_replaced(spark, path, staging, schema, list(partition_by))
            done += 1
        else:
            remove_path(spark, staging)
    return done


def _null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def backfill(df: DataFrame, out_path: str, ts_col: str, start, end, partition_by: Sequence[str],
             transform=None, keys: Sequence[str] = ()) -> None:
    """Re-run a transform for a date range and replace the rows of that range (M7).

    Rows of the range give way to the new rows, with ``keys`` also older copies
    of the new rows elsewhere; all others keep their place, also in
    partitions that the range covers in part.
    """
    part = date_slice(df, ts_col, start, end)
    inside = in_date_range(ts_col, start, end, df.schema[ts_col].dataType)
    if transform is not None:
        part = transform(part)
    replace_rows(df.sparkSession, part, out_path, partition_by, part if keys else None, keys, inside)


def recover(spark: SparkSession, path: str) -> bool:
    """Put a table back that an interrupted ``swap`` left moved aside; True if it did.

    Between the two renames of a swap the folder is missing. A leftover of that
    moment is the last published version; a missing folder alone is no sign
    of a first load.
    """
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    found = fs.globStatus(_fs(spark, path.rstrip("/") + ".__old_*")[1])
    if not found:
        return False
    latest = max(found, key=lambda st: st.getModificationTime())
    if not fs.rename(latest.getPath(), p):
        raise PublishError(f"could not restore {path}")
    return True


def file_stats(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """(table_name, file_path, bytes, modified, rows) of every data file, files without rows included.

    Rows come from the files' footers: the scan reads no column (its ReadSchema is empty), only row group counts."""
    counts = None
    for name, path in tables.items():
        if not path_exists(spark, path):
            continue
        # one declared column that is never read: nothing is inferred, so a folder of empty files will do
        scan = spark.read.schema("__unread int").option("recursiveFileLookup", "true").parquet(path)
        own = scan.select(F.lit(name).alias("table_name"), F.col("_metadata.file_path").alias("file_path")) \
            .groupBy("table_name", "file_path").agg(F.count(F.lit(1)).alias("rows"))
        counts = own if counts is None else counts.unionByName(own)
    files = list_files(spark, tables).drop("path")
    if counts is None:
        return files.withColumn("rows", F.lit(0).cast("long"))
    return files.join(counts, ["table_name", "file_path"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def _for_all(spark: SparkSession, tables: Mapping[str, str], found: DataFrame, zero: Sequence[str]) -> DataFrame:
    """``found`` (a row per table) with a row for every declared table; ``zero`` columns are 0 where there was none."""
    names = spark.createDataFrame([(n,) for n in tables], "table_name string")
    out = names.join(found, "table_name", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero})


def inventory(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Files, bytes and rows per table (M4); tables without files are there with zeros."""
    found = file_stats(spark, tables).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    return _for_all(spark, tables, found, ["n_files", "bytes", "rows"])


def freshness(spark: SparkSession, tables: Mapping[str, str], as_of: datetime | str) -> DataFrame:
    """Per table: files and mean / max age in seconds of its files at ``as_of`` (M6, V4); from listings alone.

    A table without files has no age."""
    ref = F.lit(str(as_of)).cast("timestamp")
    age = (F.unix_micros(ref) - F.unix_micros(F.col("modified"))) / 1_000_000
    found = list_files(spark, tables).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_files"), F.avg(age).alias("mean_age_seconds"),
        F.max(age).alias("max_age_seconds"))
    return _for_all(spark, tables, found, ["n_files"])


def readiness(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Per source: files, rows, ready (≥ 1 file), missing sources and files without rows included (M3)."""
    out = inventory(spark, tables).select("table_name", "n_files", "rows")
    return out.withColumn("ready", F.col("n_files") > 0)


def expired_partitions(df: DataFrame, partition_cols: Sequence[str], date_expr: Column, retention_days: int,
                       as_of: date | str) -> DataFrame:
    """Partitions whose date is older than ``as_of − retention_days`` (M8).

    Returns every partition with its row count and an ``expired`` flag; the
    caller deletes the expired folders."""
    cutoff = F.date_sub(as_date(as_of), retention_days)
    return df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("n_rows"), F.min(date_expr).alias("__d")) \
        .withColumn("expired", F.col("__d") < cutoff).drop("__d")


def expired_folders(spark: SparkSession, table_path: str, partition_cols: Sequence[str], retention_days: int,
                    as_of: date | str) -> DataFrame:
    """Partition folders by date (year, month, day among the partition columns) with an ``expired`` flag (M8).

    One row per folder: its partition values as they are written in its name,
    its files, and whether its date lies before ``as_of - retention_days``. Only
    listings are read. Folders without a date (NULL) never expire.
    """
    files = list_files(spark, {"t": table_path})
    values = [F.regexp_extract("path", rf"/{c}=([^/]+)/", 1).alias(c) for c in partition_cols]
    per = files.select(*values).groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("n_files"))
    day = F.try_make_timestamp(*[F.col(c).try_cast("int") for c in ("year", "month", "day")], F.lit(0), F.lit(0), F.lit(0)).cast("date")
    cutoff = F.date_sub(as_date(as_of), retention_days)
    return per.withColumn("expired", F.coalesce(day < cutoff, F.lit(False)))


def delete_partitions(spark: SparkSession, table_path: str, partitions: DataFrame,
                      partition_cols: Sequence[str]) -> list[str]:
    """Remove the partition folders listed in ``partitions`` (M8 applied).

    ``partitions`` holds one row per partition (for example
    ``expired_partitions(...).filter("expired")``), so the list that reaches
    the driver is bounded by the partition count, not by the data. Only
    folders named exactly ``col=value/...`` under ``table_path`` are removed.
    """
    fs, _ = _fs(spark, table_path)
    jvm = spark.sparkContext._jvm
    removed = []
    for row in partitions.select(*partition_cols).distinct().collect():
        rel = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else row[c]}" for c in partition_cols)
        p = jvm.org.apache.hadoop.fs.Path(f"{table_path.rstrip('/')}/{rel}")
        if fs.exists(p) and fs.delete(p, True):
            removed.append(rel)
    return sorted(removed)
