"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hydrolake.functions import fixed
from hydrolake.functions._base import col, extract, let
from hydrolake.functions.dates import cell_date
from hydrolake.operators.merge import path_exists, touched_partitions
from hydrolake.session import scratch_path

REGISTRY_SCHEMA = T.StructType(
    [T.StructField(n, T.ArrayType(T.StringType()) if n == "cron" else
                   T.IntegerType() if n == "minimum_capture_opportunities" else
                   T.DoubleType() if n.endswith("_hours") else T.StringType())
     for n in fixed.REGISTRY_REQUIRED])


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   recursive: bool = False) -> DataFrame:
    """Dated CSV snapshots as text columns plus ``snapshot_date`` from the file name.

    With a schema columns are matched by place and headers are checked against it.
    Without one every column stays text, and files may differ in their columns,
    which then meet by name; a file is one row while it is read, so give a schema
    for files too large for that.
    """
    if schema:
        reader = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
                  .option("recursiveFileLookup", recursive))
        df = reader.schema(schema).option("enforceSchema", False).csv(path)
    else:
        df = _by_header(spark, path, recursive)
    parts = F.split(F.col("_metadata.file_path" if schema else "__path"), "/")
    # files written by Spark have no dates of their own, their folders do
    name = F.when(F.element_at(parts, -1).startswith("part-"), F.element_at(parts, -2)) \
        .otherwise(F.element_at(parts, -1))
    month = F.concat(extract(name, r"(20\d{2}-\d{2})\D*$"), F.lit("-01"))
    day = F.coalesce(cell_date(name), month)
    rest = [c for c in df.columns if c != "__path"]
    return df.select(*[F.col(f"`{c}`") for c in rest], F.try_to_date(day).alias("snapshot_date"))


#: A CSV record that may hold quoted line ends, and a field after its comma.
_RECORD, _FIELD = r'(?:[^"\r\n]++|"[^"]*+")++', r',((?:[^",]++|"[^"]*+")*+)'


def csv_fields(record: Column | str) -> Column:
    """The fields of a CSV record as an array: quotes undone, empty fields null, quoted empty ones ''."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), col(record)), F.lit(_FIELD), F.lit(1))

    def plain(f: Column) -> Column:
        inner = F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))
        return F.when(f.startswith('"') & f.endswith('"') & (F.length(f) > 1), inner).when(f != "", f)

    return F.transform(raw, plain)


def csv_rows(text: Column | str) -> Column:
    """A whole CSV file as an array of ``(header, fields)``, one per record behind the first.

    Blank lines are no records; a file with a header alone gives one row with null fields. Unnamed
    columns are called by their place, repeated names get their place added.
    """
    body = F.regexp_replace(col(text), r"^\ufeff", "")
    records = F.regexp_extract_all(body, F.lit(_RECORD), F.lit(0))

    def named(header: Column) -> Column:
        known = F.transform(header, lambda h, i: F.coalesce(h, F.concat(F.lit("_c"), i)))
        return let(known, lambda names: F.transform(names, lambda n, i: F.when(
            F.size(F.filter(names, lambda m: F.lower(m) == F.lower(n))) > 1, F.concat(n, i)).otherwise(n)))

    def rows(r: Column) -> Column:
        def with_header(header: Column) -> Column:
            behind = F.transform(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), lambda x: F.struct(
                header.alias("header"), csv_fields(x).alias("fields")))
            alone = F.array(F.struct(header.alias("header"), F.lit(None).cast("array<string>").alias("fields")))
            return F.when(F.size(r) > 1, behind).otherwise(alone)

        return F.when(F.size(r) > 0, let(named(csv_fields(F.get(r, F.lit(0)))), with_header))

    return let(records, rows)


def _by_header(spark: SparkSession, path: str, recursive: bool) -> DataFrame:
    """Every record under its own file's header; columns of all files meet by name.

    Each file is read once, as one row, and its records carry its header along, so neither paths
    nor records meet on the driver or in a shuffle. Records are written to the shared folder; the
    distinct headers, read from there, name the columns.
    """
    whole = spark.read.option("recursiveFileLookup", recursive).text(path, wholetext=True)
    records = whole.select(F.col("_metadata.file_path").alias("path"), F.inline(csv_rows("value")))
    held = scratch_path(spark, "snapshots")
    records.write.parquet(held)
    records = spark.read.schema(records.schema).parquet(held)
    headers = sorted(r.header for r in records.select("header").distinct().collect())
    names = list(dict.fromkeys(n for h in headers for n in h))
    return records.where("fields IS NOT NULL").select(
        *[F.get("fields", F.array_position("header", F.lit(n)).cast("int") - 1).alias(n) for n in names], F.col("path").alias("__path"))


def write_snapshots(df: DataFrame, path: str, date_col: str = "date",
                    partition: tuple[str, ...] = ()) -> None:
    """One partition per observation date; only dates in the batch are replaced.

    The rebalance hint gathers a date's rows into few files and splits a date
    that is too large for one task.
    """
    by = [*partition, date_col]
    (df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def payload_rows(text: Column | str, element: T.StructType | str) -> Column:
    """Array of typed records from a list, an object wrapping one list, or one object."""
    text = F.trim(col(text))
    kind = T.StructType.fromDDL(element) if isinstance(element, str) else element
    inner = kind.simpleString()
    array_type = f"array<{inner}>"
    as_list = F.when(text.startswith("["), F.from_json(text, array_type))
    fields = F.when(text.startswith("{"), F.from_json(text, "map<string,string>"))
    # an object with a field of the record is a record, whatever lists it holds
    own = F.arrays_overlap(F.map_keys(fields), F.array(*[F.lit(n) for n in kind.names]))
    wrapped = F.when(~own, F.get(F.filter(F.map_values(fields), lambda v: v.startswith("[")), F.lit(0)))
    as_wrapped = F.from_json(wrapped, array_type)
    as_object = F.when(text.startswith("{"), F.array(F.from_json(text, inner)))
    return F.coalesce(as_list, as_wrapped, as_object)


def read_payloads(spark: SparkSession, path: str, element: T.StructType | str, partition: list[str] | None = None) -> DataFrame:
    """S3: raw JSON files (plain or gzip) to typed rows with the file they came from
    and the ``partition`` columns of its folder."""
    files = spark.read.text(path, wholetext=True)
    return (files.select(*(partition or []), F.col("_metadata.file_name").alias("file_name"),
                         F.inline(payload_rows("value", element))))


_RUN_TIME_KEYS = ("finished_at", "finished_at_utc", "started_at", "ran_at_utc", "run_time",
                  "retrieved_at_utc", "started_at_utc", "generated_at")
_ROW_KEYS = ("row_count", "rows_parsed", "rows", "rows_added", "dams_parsed", "values_parsed",
             "readings", "station_count", "accumulated_rows", "inventory_total")


_LOG_SCHEMA = T.StructType([T.StructField(k, T.StringType()) for k in (
    *_RUN_TIME_KEYS, *_ROW_KEYS, "status", "source", "fatal_error", "broken")]
    + [T.StructField("errors", T.ArrayType(T.StringType()))])


def run_log_fields(text: Column | str) -> Column:
    """Canonical struct of one run log; the spellings differ from source to source.

    The log is parsed once against all known keys; objects stay text.
    """
    parsed = F.from_json(col(text), _LOG_SCHEMA, {"columnNameOfCorruptRecord": "broken"})

    def canonical(log: Column) -> Column:
        def first_of(keys: tuple[str, ...]) -> Column:
            return F.coalesce(*[log[k] for k in keys])

        stamp = F.regexp_replace(F.trim(first_of(_RUN_TIME_KEYS)), r"Z$", "+00:00")
        compact = F.regexp_replace(stamp, r"T(\d{2})(\d{2})(\d{2})\+", "T$1:$2:$3+")
        instant = let(compact, lambda t: F.coalesce(
            *[F.try_to_timestamp(t, F.lit(f)) for f in fixed.DATE_FORMATS_ISO]))
        readable = log["broken"].isNull() & log.isNotNull()
        return F.struct(
            F.when(readable & ~log["source"].startswith("{"), log["source"]).alias("source"),
            F.when(readable, instant).alias("run_ts"),
            F.when(readable, F.coalesce(log["status"], F.lit("?"))).otherwise("unreadable").alias("status"),
            F.when(readable, first_of(_ROW_KEYS).try_cast("bigint")).alias("rows"),
            F.when(readable, F.coalesce(log["fatal_error"], F.get(log["errors"], F.lit(0)))).alias("error"))

    return let(parsed, canonical)


def read_run_logs(spark: SparkSession, glob: str) -> DataFrame:
    """Run logs to ``source, run_ts, status, rows, error, run_file``.

    Read as text, because the logs do not share a schema; a log that is no JSON
    counts as ``unreadable``. A missing source name is taken from the folder.
    """
    files = spark.read.text(glob, wholetext=True)
    logs = files.select(F.col("_metadata.file_path").alias("__p"), F.inline(F.array(run_log_fields("value"))))
    folder = extract("__p", r"([^/]+/[^/]+)/run_logs/[^/]+$")
    return logs.select(F.coalesce("source", folder).alias("source"), "run_ts", "status", "rows", "error",
                       F.element_at(F.split("__p", "/"), -1).alias("run_file"))


def read_pages(spark: SparkSession, path: str, boundary: str | None = None) -> DataFrame:
    """Raw HTML or text files as ``url`` (file path), ``fetched_at``, ``html``.

    A file is one page. ``boundary``: text that ends each page in archives that hold many; a page
    then takes no file of its own to be opened and listed, and a large archive is read by several tasks.
    """
    files = spark.read.text(path, lineSep=boundary) if boundary else spark.read.text(path, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("url"),
        F.col("_metadata.file_modification_time").alias("fetched_at"), F.col("value").alias("html"))


def inventory(binary: DataFrame, content: str = "content", path: str = "path",
              retrieved_at: str = "modificationTime") -> DataFrame:
    """``file, size_bytes, sha256, retrieved_at`` of landed files (``binaryFile`` rows)."""
    return binary.select(F.element_at(F.split(path, "/"), -1).alias("file"),
                         F.octet_length(content).cast("bigint").alias("size_bytes"),
                         F.sha2(content, 256).alias("sha256"), F.col(retrieved_at).alias("retrieved_at"))


def registry_rows(df: DataFrame, text: str) -> DataFrame:
    """Registry JSON to one row per source."""
    wrapped = T.StructType([T.StructField("sources", T.ArrayType(REGISTRY_SCHEMA))])
    return df.select(F.explode(F.from_json(text, wrapped)["sources"]).alias("s")).select("s.*")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The source registry, one row per source."""
    return registry_rows(spark.read.text(path, wholetext=True), "value")


def write_long(df: DataFrame, path: str, date_col: str = "date") -> None:
    """Long observations split by year; only dates in the batch are replaced.

    The other dates of a year stay: a daily run brings one day, not its year. Only
    the years that the batch touches are read and rewritten.
    """
    spark, new = df.sparkSession, df.withColumn("year", F.year(date_col)).persist()  # read for its bounds, years, days and rows
    try:
        rows = new
        if path_exists(spark, path):
            held = touched_partitions(spark.read.schema(new.schema).parquet(path), new, "year")
            brought = new.select(F.col(date_col).alias("__d")).distinct()
            kept = held.join(brought, F.col(date_col).eqNullSafe(F.col("__d")), "left_anti")
            rows = kept.select(new.columns).unionByName(new)
        (rows.hint("rebalance", F.col("year")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year").parquet(path))
    finally:
        new.unpersist()


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table whose smallest, largest and number of values come from file footers.

    Aggregates of whole columns, or per partition of the table, then read no data pages: A6, Q7 and
    the newest day of a table that S2 or S8 partitioned. It opens the table with Spark's second
    parquet reader, the one that aggregates are pushed to, and switches the push-down on.
    """
    name, conf = "spark.sql.sources.useV1SourceList", spark.conf
    before = conf.get(name)
    conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        conf.set(name, ",".join(s for s in before.split(",") if s != "parquet"))
        return spark.read.parquet(path)
    finally:
        conf.set(name, before)


def lookup_rows(df: DataFrame, key: str) -> DataFrame:
    """Trim all text cells and drop rows without an id."""
    text = [c for c, t in df.dtypes if t == "string"]
    trimmed = df.select(*[F.trim(c).alias(c) if c in text else F.col(c) for c in df.columns])
    probe = F.trim(F.col(key).cast("string"))
    return trimmed.where(F.coalesce(~probe.isin(*fixed.MARKERS_NULL_WORDS), F.lit(False)))


def read_lookup(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A hand-kept look-up table, keyed by id; blank ids are dropped."""
    return lookup_rows(spark.read.option("header", True).csv(path), key)
