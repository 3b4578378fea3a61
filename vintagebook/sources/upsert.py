"""Hash-gated upsert (MERGE semantics) and partition-scoped table writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from ..session import checkpointed


def upsert_hash_gated(target: DataFrame, source: DataFrame, keys: Sequence[str],
                      hash_col: str = "row_hash", check_unique: bool = False) -> DataFrame:
    """The table after ``MERGE ... WHEN MATCHED AND (t.hash IS NULL OR t.hash <> s.hash)
    THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *``.

    One full outer join on ``keys``: the source row wins when the key is new
    or its hash changed (or the target hash is NULL); otherwise the target
    row is kept, target-only rows included.  Columns follow the target.
    ``check_unique`` fails on duplicate source keys, as MERGE would.
    """
    keys = list(keys)
    if check_unique:
        dup = source.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
        if dup:
            raise ValueError("source has duplicate keys; MERGE would fail")
    cols = target.columns
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_s_hit"))
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t_hit"))
    cond = None
    for k in keys:
        e = F.col(f"_t_{k}") == F.col(f"_s_{k}")
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full_outer")
    take_source = F.col("_s_hit").isNotNull() & (
        F.col("_t_hit").isNull() | F.col(f"_t_{hash_col}").isNull()
        | (F.col(f"_t_{hash_col}") != F.col(f"_s_{hash_col}")))
    return j.select(*[F.when(take_source, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c)
                      for c in cols])


def upsert_changes(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   hash_col: str = "row_hash") -> DataFrame:
    """Only the source rows a hash-gated MERGE would write (inserts + updates)."""
    t = target.select(*keys, F.col(hash_col).alias("_t_hash"))
    j = source.join(t, list(keys), "left")
    return (j.filter(F.col("_t_hash").isNull() | (F.col("_t_hash") != F.col(hash_col)))
            .drop("_t_hash"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Full overwrite, or dynamic partition overwrite when ``partition_by`` is set:
    only the partitions present in ``df`` are replaced."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.save(path)


def merge_into_path(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                    hash_col: str = "row_hash", partition_by: Sequence[str] = (),
                    fmt: str = "parquet") -> DataFrame:
    """Apply a hash-gated upsert to the table stored at ``path``.

    Delta tables use the engine's MERGE.  Plain parquet cannot be rewritten
    while it is read, so the merged rows of the touched partitions are first
    materialised with ``checkpoint()`` (the shared ``spark.checkpoint.dir``,
    survives executor loss) and then written back with dynamic partition
    overwrite.  Touched are the partitions of the source rows and those that
    hold one of their keys, so a row that moves to another partition leaves its
    old one (which is written again without it; an old partition that becomes
    empty is deleted by a full rewrite of the table).  Duplicate source keys fail, as in MERGE.
    Returns the merged rows of the touched partitions.
    """
    from ..session import ensure_checkpoint_dir
    if fmt == "delta":  # pragma: no cover - needs the Delta jar
        from delta.tables import DeltaTable  # type: ignore
        cond = " AND ".join(f"t.{k} = s.{k}" for k in keys)
        (DeltaTable.forPath(spark, path).alias("t").merge(source.alias("s"), cond)
         .whenMatchedUpdateAll(condition=f"t.{hash_col} IS NULL OR t.{hash_col} <> s.{hash_col}")
         .whenNotMatchedInsertAll().execute())
        return spark.read.format("delta").load(path)
    ensure_checkpoint_dir(spark)
    target = read_existing(spark, path, source.schema, fmt)
    if target is None:  # no table yet: the first write creates it
        write_table(source, path, fmt, partition_by)
        return source
    source = source.select(*target.columns)
    if not partition_by:
        merged = checkpointed(upsert_hash_gated(target, source, keys, hash_col, check_unique=True))
        write_table(merged, path, fmt)
        return merged
    held = target.join(source.select(*keys), list(keys), "left_semi").select(*partition_by)
    touched = checkpointed(source.select(*partition_by).unionByName(held).distinct())
    old = target.join(touched, list(partition_by), "left_semi")
    merged = checkpointed(upsert_hash_gated(old, source, keys, hash_col, check_unique=True))
    emptied = touched.join(merged.select(*partition_by).distinct(), list(partition_by), "left_anti")
    if emptied.isEmpty():
        write_table(merged, path, fmt, partition_by)
    else:  # dynamic overwrite cannot empty a partition
        rest = checkpointed(target.join(touched, list(partition_by), "left_anti").unionByName(merged))
        rest.write.format(fmt).mode("overwrite").partitionBy(*partition_by).option(
            "partitionOverwriteMode", "static").save(path)
    return merged


def read_existing(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path`` read with a known schema, or None when the path
    does not exist.  The explicit schema also covers zero-row partitioned
    tables, whose folder holds no data file to infer a schema from."""
    try:
        df = spark.read.schema(schema).format(fmt).load(path)
        df.inputFiles()  # lists the folder: fails when it does not exist
        return df
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def ensure_table_like(spark: SparkSession, df: DataFrame, path: str,
                      partition_by: Sequence[str] = (), fmt: str = "parquet") -> bool:
    """Create an empty table with ``df``'s schema at ``path`` unless one exists.

    Returns True when the table was created."""
    if read_existing(spark, path, df.schema, fmt) is not None:
        return False
    w = df.limit(0).write.format(fmt).mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return True
