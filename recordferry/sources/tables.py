"""Readers: parquet, catalog tables, JDBC, CSV and object listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordferry.functions.text import blank_to_null


def parquet_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def remote_table(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
                 partitions: int, **options: str) -> DataFrame:
    """A table of another database, read in ranges of a numeric key.

    Filters and columns are pushed to the database; stage the result with
    `sinks.write_table` where several jobs read it.
    """
    return (spark.read.format("jdbc")
            .options(url=url, dbtable=table, partitionColumn=partition_column, lowerBound=str(lower),
                     upperBound=str(upper), numPartitions=str(partitions), pushDownPredicate="true", **options)
            .load())


def fixed_width_text(df: DataFrame) -> DataFrame:
    """Right-trim all text columns: blank-padded columns carry filler."""
    return df.withColumns({f.name: F.rtrim(f.name) for f in df.schema.fields
                           if isinstance(f.dataType, T.StringType)})


# ---- fixed values: columns of the parsed legal-text file --------------------------
PARSED_LEGAL_SCHEMA = ("landDescriptionID string, Survey string, Subdivision string, Lot string, Block string, "
                       "Section string, Township string, Range string, Quartercall string, NewCityBlock string")
# ------------------------------------------------------------------------------------
CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": "\\", "multiLine": "false",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# How `sinks.write_csv` writes characters that would break a line, so that a row is one line and files stay splittable.
LINE_CODES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "\\0"))


def encode_lines(text: Column) -> Column:
    for plain, code in LINE_CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def decode_lines(text: Column) -> Column:
    """Inverse of `encode_lines`; encoded text holds no NUL, so NUL may stand for a backslash meanwhile."""
    text = F.replace(text, F.lit("\\\\"), F.lit("\0"))
    for plain, code in LINE_CODES[1:3]:
        text = F.replace(text, F.lit(code), F.lit(plain))
    # A coded NUL is still backslash and 0 here; it must outlive the step that frees the stand-in.
    parts = F.transform(F.split(text, r"\\0", -1), lambda p: F.replace(p, F.lit("\0"), F.lit("\\")))
    return F.array_join(parts, "\0")


def csv_table(spark: SparkSession, path: str, schema: str, multi_line: bool = False, encoded: bool = True) -> DataFrame:
    """CSV with backslash escapes and an explicit schema; blanks become NULL, outer blanks stay.

    A line that does not fit the schema stops the job.  `encoded` reads files of `sinks.write_csv`; foreign files are
    read with `encoded=False`, and with `multi_line` if they break lines inside quotes, but then a file is one task.
    """
    options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower(), "mode": "FAILFAST"}
    df = spark.read.options(**options).schema(schema).csv(path)
    decode = decode_lines if encoded else (lambda c: c)
    return df.withColumns({f.name: blank_to_null(decode(F.col(f.name))) for f in df.schema.fields
                           if isinstance(f.dataType, T.StringType)})


REJECTED, FROM_FILE = "_rejected", "_file"


def csv_checked(spark: SparkSession, path: str, schema: str, encoded: bool = True, options: dict[str, str] = CSV_OPTIONS) -> DataFrame:
    """All lines of a CSV: those that fit the schema as `csv_table` gives them, and beside them those that do not.

    A line with too many or too few fields, or a value that its column's type cannot hold, has its text in
    `_rejected` and its file in `_file`; its other columns are NULL.  Write the result once (`sinks.staged`) and part
    it with `accepted` and `rejected`, so that the files are parsed once.  A line break inside quotes parts a line.
    """
    declared = T.StructType.fromDDL(schema)
    df = (spark.read.options(**{**options, "mode": "PERMISSIVE"}, columnNameOfCorruptRecord=REJECTED)
          .schema(T.StructType([*declared.fields, T.StructField(REJECTED, T.StringType())])).csv(path)
          .withColumn(FROM_FILE, F.col("_metadata.file_path")))
    fits = F.col(REJECTED).isNull()
    decode = decode_lines if encoded else (lambda c: c)
    values = [F.when(fits, blank_to_null(decode(F.col(f.name))) if isinstance(f.dataType, T.StringType) else F.col(f.name))
              .alias(f.name) for f in declared.fields]
    return df.select(*values, REJECTED, F.when(~fits, F.col(FROM_FILE)).alias(FROM_FILE))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REJECTED).isNull()).drop(REJECTED, FROM_FILE)


def rejected(checked: DataFrame) -> DataFrame:
    """file and line of each line that did not fit."""
    return checked.where(F.col(REJECTED).isNotNull()).select(F.col(FROM_FILE).alias("file"), F.col(REJECTED).alias("line"))


def object_listing(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Keys and sizes of stored files under `root`; the contents are not read.

    For small roots: the file index lists all objects on the driver first.  For large ones read an inventory that the
    store writes itself (`object_inventory`).  Page counts are not in a listing: join them from a catalogue, or add
    them with `images.map_rows`.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", glob).load(root).select("path", "length"))
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(root)
    qualified = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(place).toString()
    # The root as written is a literal prefix of every path; paths hold names as they are, so nothing is decoded.
    start = len(qualified.rstrip("/")) + 2
    return listed.select(F.col("path").substr(start, 2**31 - 1).alias("object_key"), F.col("length").alias("size_bytes"))


def object_walk(spark: SparkSession, root: str) -> DataFrame:
    """object_key and size_bytes of all files under `root`, however many: folders are listed by tasks, level by level.

    Each round lists the folders that the round before found, spread over tasks, and writes what it finds to the
    shared folder; the driver sees the number of folders only.  Keys start below `root`.  `root` is a URI or a path
    that all executors reach through Arrow's file systems.  Rounds are as many as the tree is deep.
    """
    from recordferry.sources import sinks

    uri = root if "://" in root or root.startswith("file:") else f"file://{root}"
    work, rounds = sinks.shared_folder(spark), []

    def listed(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            rows = []
            store, base = fs.FileSystem.from_uri(uri)
            for folder in batch["folder"].to_pylist():
                place = f"{base.rstrip('/')}/{folder}".rstrip("/")
                for entry in store.get_file_info(fs.FileSelector(place)):
                    key = entry.path[len(base.rstrip("/")) + 1:]
                    rows.append((key, entry.size, entry.type == fs.FileType.Directory))
            keys, sizes, folders = list(zip(*rows)) or ([], [], [])
            yield pa.record_batch({"object_key": pa.array(keys, pa.string()), "size_bytes": pa.array(sizes, pa.int64()),
                                   "is_folder": pa.array(folders, pa.bool_())})

    folders = spark.range(1).select(F.lit("").alias("folder"))
    while True:
        found = sinks.staged(folders.mapInArrow(listed, "object_key string, size_bytes bigint, is_folder boolean"), work)
        rounds.append(found)
        below = found.where("is_folder")
        n = below.count()
        if not n:
            break
        folders = below.select(F.col("object_key").alias("folder")).repartition(min(n, 2000), "folder")
    return reduce(DataFrame.unionByName, rounds).where("not is_folder").select("object_key", "size_bytes")


def object_inventory(spark: SparkSession, path: str, key: str = "object_key", size: str = "size_bytes",
                     pages: str | None = None) -> DataFrame:
    """The same from a Parquet inventory, read in parallel, with page counts if it has them."""
    counted = F.lit(None) if pages is None else F.col(pages)
    return spark.read.parquet(path).select(F.col(key).alias("object_key"), F.col(size).cast("bigint").alias("size_bytes"),
                                           counted.cast("int").alias("page_count"))
