"""Writers.  Every write is one distributed commit of one DataFrame.

A table that is being read is never overwritten: replacement DataFrames go to a
new path, and readers are pointed at it (`publish`).  Tables in ranges of their
key (`write_parted`) replace the ranges that a change touches, from a finished copy.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkValueError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordferry.operators.changes import duplicate_keys
from recordferry.operators.counted import DIGEST, ROWS, Steps, content_of, seen_content
from recordferry.sources.tables import CSV_OPTIONS, encode_lines


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's `spark.checkpoint.dir`.

    Only a local session without that setting, as in tests, gets a temporary
    folder; a cluster must name a shared one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise PySparkValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="recordferry-")


def staged(df: DataFrame, folder: str) -> DataFrame:
    """Materialize a frame that several jobs read, in `folder`, which the flow that made it removes at its end.

    A written table survives the loss of executors; an unmaterialized slice
    would be computed once per reader.
    """
    spark = df.sparkSession
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with the columns and types of a declared table, in its order."""
    absent = [f.name for f in schema.fields if f.name not in df.columns]
    extra = [c for c in df.columns if c not in schema.names]
    if absent or extra:
        raise PySparkValueError(f"absent columns {absent}, undeclared columns {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def check(table: DataFrame, required: list[str], unique: list[str] | None = None) -> None:
    """Raise unless the required columns are filled and the key is unique."""
    if required:
        nulls = table.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in required]).first()
        broken = [name for name in required if nulls[name]]
        if broken:
            raise PySparkValueError(f"NULL in the required columns {broken}")
    if unique and not duplicate_keys(table, unique).isEmpty():
        raise PySparkValueError(f"{unique} is not unique")


def write_table(df: DataFrame, path: str, schema: T.StructType | None = None, unique: list[str] | None = None,
                partition_by: tuple[str, ...] = ()) -> str:
    """Write a new version of the table `path`, check it, and return the folder to read it from.

    NOT NULL and uniqueness are tested on the written version, so the job behind `df` runs once.  Earlier versions
    are left alone: if a test fails, this raises, and whoever reads the version before goes on reading it.
    """
    out = df if schema is None else fitted(df, schema)
    version = f"{path.rstrip('/')}/version={uuid.uuid4().hex}"
    out.write.mode("errorifexists").partitionBy(*partition_by).parquet(version)
    required = [] if schema is None else [f.name for f in schema.fields if not f.nullable]
    if required or unique:
        check(df.sparkSession.read.parquet(version), required, unique)
    return version


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove what a flow wrote for its own use, through the file system that the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def append_table(df: DataFrame, path: str, columns: list[str]) -> int:
    """Append the named columns; columns of the table that they lack become NULL.

    Returns how many rows were written, counted while they were.
    """
    spark = df.sparkSession
    table = spark.read.parquet(path).schema
    unknown = [c for c in columns if c not in table.names]
    if unknown:
        raise PySparkValueError(f"columns not in the table: {unknown}")
    values = [(F.col(f.name) if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name)
              for f in table.fields]
    steps = Steps()
    steps.see(df.select(*values), "appended").write.mode("append").parquet(path)
    return steps.counts()["appended"]


# ---- bucketed staging ------------------------------------------------------------------

def bucketed(df: DataFrame, folder: str, key: str, buckets: int) -> DataFrame:
    """Stage a frame that several jobs join, count or test by `key`: bucketed and sorted by it, under `folder`.

    Joins and aggregates by the key of frames staged with as many buckets need no shuffle.  The table is known to the
    session alone; `drop_bucketed` forgets it, the flow removes the folder.  Choose as many buckets as make one bucket
    fit a task; rows of one key, NULL included, share a bucket.
    """
    name = f"staged_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.mode("errorifexists").bucketBy(buckets, key).sortBy(key)
     .option("path", f"{folder}/{name}").saveAsTable(name))
    return df.sparkSession.table(name)


def drop_bucketed(spark: SparkSession) -> None:
    """Forget the staged tables of this session; their files stay until their folder is removed."""
    for table in spark.catalog.listTables(pattern="staged_*"):
        spark.sql(f"drop table if exists {table.name}")


# ---- published tables ------------------------------------------------------------------
# A published table is a folder of versions and one small pointer file that names the version to read.  A version is
# never changed; publishing replaces the pointer in one rename, so readers see the old table or the new one, whole.

POINTER = "_current"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Make `version`, a folder under `path`, the one that `current` gives."""
    if not version.startswith(f"{path.rstrip('/')}/"):
        raise PySparkValueError(f"{version} does not lie under {path}")
    name = version.removeprefix(f"{path.rstrip('/')}/")
    draft, files = _file_system(spark, f"{path}/{POINTER}-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(name, "utf-8"))
    finally:
        out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(options, 1)
    how[0] = options.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    context.rename(files.makeQualified(draft), files.makeQualified(_file_system(spark, f"{path}/{POINTER}")[0]), how)


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the published version; None if nothing was published."""
    pointer, files = _file_system(spark, f"{path}/{POINTER}")
    if not files.exists(pointer):
        return None
    opened = files.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()
    return f"{path.rstrip('/')}/{name}"


def read_published(spark: SparkSession, path: str) -> DataFrame:
    version = current(spark, path)
    if version is None:
        raise PySparkValueError(f"nothing is published under {path}")
    return spark.read.parquet(version)


def promote_table(spark: SparkSession, source_path: str, target_path: str) -> DataFrame:
    """Copy a whole table to another environment, publish the copy if it is whole, and report both row counts.

    Rows and a digest of their content are taken from the source while it is copied, and from the copy before it is
    published.  If they differ, or the copy fails, this raises, and the table that was published before stays.
    """
    source, seen = seen_content(spark.read.parquet(source_path))
    version = write_table(source, target_path)
    rows, digest = seen.get[ROWS], int(seen.get[DIGEST] or 0)
    copied, copied_digest = content_of(spark.read.parquet(version))
    if (rows, digest) != (copied, copied_digest):
        raise PySparkValueError(f"the copy of {source_path} is not whole: {copied} of {rows} rows, or other content")
    publish(spark, target_path, version)
    return spark.range(1).select(F.lit(rows).cast("bigint").alias("source_rows"), F.lit(copied).cast("bigint").alias("promoted_rows"))


# ---- tables in ranges of the key's hash ------------------------------------------------
# Rows lie in 2^bits partition folders by the first bits of their key's hash.  A change reads the folders that its keys
# fall into and replaces those; all others keep their files.

PART = "key_part"


def part_of(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits).cast("int")


def write_parted(df: DataFrame, path: str, key: str, bits: int = 8) -> None:
    """Write `df` in ranges of the hash of `key`.  The table remembers key and bits in its schema."""
    if not 1 <= bits <= 16 or PART in df.columns:
        raise PySparkValueError(f"bits from 1 to 16 and no column {PART}")
    marked = df.select(*[F.col(c).alias(c, metadata={"part_bits": bits}) if c == key else F.col(c) for c in df.columns])
    # one task per range, or more where a range is large
    marked.withColumn(PART, part_of(F.col(key), bits)).hint("rebalance", PART).write.mode("errorifexists").partitionBy(PART).parquet(path)


def parted_key(spark: SparkSession, path: str) -> tuple[str, int, T.StructType]:
    schema = spark.read.parquet(path).schema
    marked = [f for f in schema.fields if "part_bits" in f.metadata]
    if len(marked) != 1:
        raise PySparkValueError(f"{path} was not written by write_parted")
    return marked[0].name, marked[0].metadata["part_bits"], schema


def read_parted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)


def rewrite_parts(spark: SparkSession, path: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame], folder: str,
                  ) -> list[int]:
    """Replace the ranges into which `keys` fall by `change` of their rows; returns these ranges.

    `keys` has the table's key column and names every key that the change touches, new ones included.  What the ranges
    become is written to `folder` first and copied from there, so a run that fails while it replaces can be
    repeated from that copy; keep `folder` until this returns.  A range that the change empties is removed.  A change
    that leaves the ranges' keys raises before anything is replaced.
    """
    key, bits, schema = parted_key(spark, path)
    parts = sorted(r[PART] for r in keys.select(part_of(F.col(key).cast(schema[key].dataType), bits).alias(PART)).distinct().collect())
    if not parts:
        return []
    table = spark.read.parquet(path)
    new = change(table.where(F.col(PART).isin(parts)).drop(PART)).select(*[c for c in table.columns if c != PART])
    marked = new.select(*[F.col(c).alias(c, metadata={"part_bits": bits}) if c == key else F.col(c) for c in new.columns])
    ready = staged(marked.withColumn(PART, part_of(F.col(key), bits)).hint("rebalance", PART), folder)
    filled = {r[PART] for r in ready.select(PART).distinct().collect()}
    if not filled <= set(parts):
        raise PySparkValueError(f"the change has keys of other ranges: {sorted(filled - set(parts))[:5]}")
    if filled:
        ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    for part in sorted(set(parts) - filled):
        remove_folder(spark, f"{path}/{PART}={part}")
    return parts


def write_csv(df: DataFrame, path: str) -> None:
    """CSV of one line per row: characters that break lines are coded (`tables.LINE_CODES`), outer blanks are kept."""
    coded = df.withColumns({f.name: encode_lines(F.col(f.name)) for f in df.schema.fields
                            if isinstance(f.dataType, T.StringType)})
    coded.write.mode("overwrite").options(**CSV_OPTIONS, quoteAll="true").csv(path)


# ---- fixed values: declared staging tables -----------------------------------------
IMAGE_RESULT_SCHEMA = T.StructType([
    T.StructField("lease_id", T.LongType(), True),
    T.StructField("record_id", T.StringType(), True),
    T.StructField("state_county", T.StringType(), False),
    T.StructField("package_id", T.StringType(), True),
    T.StructField("source_path", T.StringType(), False),
    T.StructField("destination_path", T.StringType(), False),
    T.StructField("page_count", T.IntegerType(), False),
    T.StructField("file_size", T.LongType(), False),
    T.StructField("status", T.StringType(), False),
])
IMAGE_REGISTRY_SCHEMA = T.StructType([
    T.StructField("recordID", T.StringType(), False),
    T.StructField("s3FilePath", T.StringType(), False),
    T.StructField("pageCount", T.IntegerType(), True),
    T.StructField("fileSizeBytes", T.LongType(), True),
    T.StructField("_ModifiedDateTime", T.TimestampNTZType(), True),
    T.StructField("_ModifiedBy", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
])
# -------------------------------------------------------------------------------------
