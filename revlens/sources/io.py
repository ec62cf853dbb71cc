"""Sources and sinks: JSON, Parquet and CSV scans; table, CSV and model sinks.

Scans take an explicit schema where the format allows, so no inference job
reads the data twice. Sinks write partitioned output; a single-file CSV is
only offered for results whose size is bounded by a parameter (top-k lists,
topic words), and it refuses anything larger.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import shared_dir


# Bytes of a scan split (the default of spark.sql.files.maxPartitionBytes).
SPLIT_BYTES = 128 << 20


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines. With ``schema`` there is no inference pass over the files."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, record) of every line of text that is not blank."""
    t = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("record"))
    return t.where(F.trim("record") != "")


def parse_records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """``lines`` (file, record) with the record parsed by ``schema`` (struct r) and
    the reason why it cannot be used, null for a good one: ``not JSON``, or ``wrong
    type`` where a value does not fit its column. Nothing is left out."""
    whole = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = lines.select("file", "record", F.from_json("record", whole, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("_r"))
    readable = F.try_parse_json("record")
    reason = F.when(readable.isNull() | ~F.startswith(F.ltrim("record"), F.lit("{")), "not JSON").when(
        F.col("_r").isNull() | F.col("_r._bad").isNotNull(), "wrong type")
    good = F.struct(*[F.col("_r")[f.name].alias(f.name) for f in schema.fields])
    return parsed.select("file", "record", good.alias("r"), reason.alias("reason"))


def read_json_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame, dict]:
    """JSON lines as (good records, quarantine (file, record, reason), counts).

    The lines are parsed and written once, parted into good and bad; both results
    read that table. ``counts``: lines, good, quarantined; good and quarantined
    make up the lines (else the read is refused)."""
    lines = read_lines(spark, path)
    seen = Observation("lines-" + uuid.uuid4().hex)
    parsed = parse_records(lines, schema).withColumn("ok", F.col("reason").isNull())
    parsed = parsed.withColumn("record", F.when(~F.col("ok"), F.col("record"))).observe(seen, F.count(F.lit(1)).alias("n"))
    path = shared_dir(spark, f"cut/records-{uuid.uuid4().hex}")
    parsed.write.partitionBy("ok").parquet(path)
    _cuts.append(path)
    whole = T.StructType([T.StructField("file", T.StringType()), T.StructField("record", T.StringType()),
                          T.StructField("r", schema), T.StructField("reason", T.StringType()),
                          T.StructField("ok", T.BooleanType())])
    table = spark.read.schema(whole).parquet(path)
    good, bad = table.where("ok").select("r.*"), table.where("NOT ok").select("file", "record", "reason")
    counts = {"lines": seen.get["n"], "good": good.count(), "quarantined": bad.count()}
    held = counts["good"] + counts["quarantined"]
    if held != counts["lines"]:  # a task that ran twice is observed twice
        counts["lines"] = lines.count()
    if held != counts["lines"]:
        raise OSError(f"{path}: {counts} do not add up")
    return good, bad, counts


def read_parquet(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    """Parquet scan. With ``spread``, an input of fewer bytes than one scan
    split per core is dealt round-robin over the cores before the row-level
    work that follows; larger inputs split by themselves. Sizes come from the
    file listing. Column pruning and filter pushdown pass through the exchange."""
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) if spread else 0
    return df.repartition(cores) if spread and size < cores * SPLIT_BYTES else df


def read_csv_strings(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with a header row; every column stays a string (casts happen in operators)."""
    r = spark.read.option("header", True)
    if columns is not None:
        r = r.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return r.csv(path)


def strip_header(df: DataFrame) -> DataFrame:
    """Remove blanks around every column name (lookup CSVs pad their headers)."""
    return df.toDF(*[c.strip() for c in df.columns])


FILE_FORMATS = ("parquet", "orc", "json", "csv", "text")


def write_table(df: DataFrame, dest: str, fmt: str = "parquet", mode: str = "overwrite",
                options: dict | None = None, partition_by: list[str] | None = None) -> None:
    """Warehouse sink. Parquet by default; any format with a Spark data source
    (a warehouse connector on the classpath, for instance) goes through
    ``df.write.format``. Overwriting a folder is staged (:func:`write_staged`)."""
    if mode == "overwrite" and fmt in FILE_FORMATS:
        write_staged(df, dest, fmt, options, partition_by)
        return
    w = df.write.format(fmt).mode(mode)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt in FILE_FORMATS:
        w.save(dest)
    else:
        w.option("table", dest).save()


def _fs(spark: SparkSession, path: str):
    """Hadoop path of ``path`` and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _rename(spark: SparkSession, old: str, new: str) -> None:
    a, fs = _fs(spark, old)
    if not fs.rename(a, _fs(spark, new)[0]):
        raise OSError(f"cannot rename {old} to {new}")


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def _drop(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def recover_table(spark: SparkSession, dest: str) -> None:
    """Finish or undo a replacement that was cut off: without a table its former
    one comes back; beside a complete new one the former one goes."""
    old = dest.rstrip("/") + "._old"
    if _exists(spark, old):
        if _exists(spark, dest):
            _drop(spark, old)
        else:
            _rename(spark, old, dest)


def write_staged(df: DataFrame, dest: str, fmt: str = "parquet", options: dict | None = None,
                 partition_by: list[str] | None = None, check=None) -> int:
    """Replace the table in folder ``dest`` as a whole; returns its number of rows.

    The rows go to a folder of their own beside it. Read back, they must have as
    many rows as were written (counted in the same pass) and, where the format
    keeps them, the same columns and types; ``check(table)`` may raise as well. Only
    then is the old folder set aside and the new one renamed into its place. A job
    that dies leaves the old table or the new one, never a mixture and never
    neither: :func:`recover_table`, which runs first here, brings back a table that
    was set aside. ``df`` may read the old table.
    """
    spark = df.sparkSession
    dest = dest.rstrip("/")
    staging, old = f"{dest}._new-{uuid.uuid4().hex}", dest + "._old"
    recover_table(spark, dest)
    seen = Observation("staged-" + uuid.uuid4().hex)
    w = df.observe(seen, F.count(F.lit(1)).alias("n")).write.format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.save(staging)
        n = seen.get["n"]
        if fmt in ("parquet", "orc"):
            back = spark.read.format(fmt).load(staging) if n else None
            if back is not None:
                want = {f.name: f.dataType for f in df.schema if f.name not in (partition_by or [])}
                got = {f.name: f.dataType for f in back.schema if f.name in want}
                held = back.count()
                # a task that ran twice is observed twice: then the rows are counted
                if [k for k in want if got.get(k) != want[k]] or held != n and held != df.count():
                    raise OSError(f"{staging} does not hold what was written to it")
                n = held
        if check is not None:
            check(spark.read.format(fmt).options(**(options or {})).load(staging))
    except BaseException:
        _drop(spark, staging)
        raise
    if _exists(spark, dest):
        _rename(spark, dest, old)
    _rename(spark, staging, dest)
    _drop(spark, old)
    return n


def input_key(spark: SparkSession, paths: list[str], *params) -> str:
    """Name for what is derived from some inputs: a digest of their files' names,
    sizes and times and of the parameters. Changed inputs have another name."""
    found = [repr(params)]
    for path in paths:
        p, fs = _fs(spark, path)
        for f in (fs.listStatus(p) if fs.exists(p) else []):
            found.append(f"{path}|{f.getPath().getName()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.sha256("\n".join(found).encode()).hexdigest()[:32]


def stored(spark: SparkSession, name: str, paths: list[str], *params) -> tuple[str, bool]:
    """Folder in the shared folder for what ``name`` derives from inputs and
    parameters, and whether it is there already. Nothing is kept in the session."""
    path = shared_dir(spark, f"derived/{name}-{input_key(spark, paths, *params)}")
    recover_table(spark, path)
    return path, _exists(spark, path)


def write_csv(df: DataFrame, dest: str, mode: str = "overwrite") -> None:
    """One CSV part per partition, with header."""
    df.write.mode(mode).option("header", True).csv(dest)


def write_small_csv(df: DataFrame, dest: str, max_rows: int = 100_000, mode: str = "overwrite") -> None:
    """Single-file CSV for a result whose row count is bounded by a parameter.

    ``coalesce(1)`` funnels every row through one task, so the bound is
    checked first with a limited count; larger results use :func:`write_csv`.
    """
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"{n}+ rows is too many for a single-file CSV; use write_csv")
    df.coalesce(1).write.mode(mode).option("header", True).csv(dest)


def save_model(model, path: str) -> None:
    """Save a fitted pipeline, staged like a table."""
    spark = SparkSession.active()
    staging = f"{path}._new-{uuid.uuid4().hex}"
    model.write().save(staging)
    recover_table(spark, path)
    if _exists(spark, path):
        _rename(spark, path, path.rstrip("/") + "._old")
    _rename(spark, staging, path)
    _drop(spark, path.rstrip("/") + "._old")


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


_cuts: list[str] = []


def persist_cut(df: DataFrame, spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    A lost executor then costs a re-read of this table, not a recomputation of
    everything before it. The folder comes from ``spark.checkpoint.dir``; it is
    deleted by :func:`release_cuts`. With ``schema`` the table is read as such.
    """
    path = shared_dir(spark, f"cut/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _cuts.append(path)
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def cut_folders() -> list[str]:
    """Cut folders of this process that are not released."""
    return list(_cuts)


def release_cuts(spark: SparkSession, since: int = 0) -> None:
    """Delete the cut folders made after the first ``since`` ones. To be called
    when nothing that reads them is needed any more, at the end of a job."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while len(_cuts) > since:
        path = jvm.org.apache.hadoop.fs.Path(_cuts.pop())
        path.getFileSystem(conf).delete(path, True)
