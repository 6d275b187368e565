"""Shaping and writing the results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from hushline.operators.audit import audit_string
from hushline.operators.redaction import transcript_json
from hushline.rules import DEFAULT_RULES, Rules

OUTPUT_COLUMNS = (
    "file_date", "transaction_id", "transaction_identifier",
    "transcription_redacted", "redacted_entity", "load_dt",
)


def output_rows(redacted: DataFrame, rules: Rules = DEFAULT_RULES, load_dt: Column | None = None) -> DataFrame:
    """The six target columns (A7). A transcript which could not be read stays null."""
    return redacted.select(
        "file_date",
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.col("transaction_identifier").cast("string").alias("transaction_identifier"),
        transcript_json(F.col("redacted")).alias("transcription_redacted"),
        F.coalesce(audit_string(F.col("redacted"), rules), F.lit("")).alias("redacted_entity"),
        (F.current_timestamp() if load_dt is None else load_dt).alias("load_dt"),
    )


def content_digest(columns: list[str]) -> Column:
    """One digest for all values of a row, nulls and microseconds included."""
    moment = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    options = {"ignoreNullFields": "false", "timestampFormat": moment + "XXX", "timestampNTZFormat": moment}
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), options), 256)


def not_loaded(rows: DataFrame, loaded: DataFrame, ignore: tuple[str, ...] = ("load_dt",), partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The rows which ``loaded`` does not hold yet, so that a load can be repeated (A10).

    A row is there if all its values are, but for those of the columns to ignore (the time
    of the load); a null equals a null. Rows that are equal among themselves all stay. With
    ``partition_by`` only partitions of ``loaded`` from the least to the greatest value of the
    rows are read; digests alone are compared, and a row which comes very often is split by
    the skew join.
    """
    compared = sorted(set(rows.columns) - set(ignore))
    for c in partition_by:
        # Scalar subqueries, which choose the partitions when the scan starts.
        least, most = (rows.agg(f(c)).scalar() for f in (F.min, F.max))
        loaded = loaded.where(F.col(c).isNull() | ((F.col(c) >= least) & (F.col(c) <= most)))
    digest = "_digest"
    while digest in rows.columns:
        digest += "_"
    there = loaded.select(content_digest(compared).alias(digest)).distinct()
    return rows.withColumn(digest, content_digest(compared)).join(there, digest, "left_anti").drop(digest)


def _loaded(spark: SparkSession, target: str, format: str, options: dict[str, str], like: DataFrame) -> DataFrame | None:
    """What the target holds; None if there is none yet. A JDBC table has to be there."""
    if format == "table":
        return spark.table(target) if spark.catalog.tableExists(target) else None
    reader = spark.read.format(format).options(**options)
    if format == "jdbc":
        return reader.option("dbtable", target).load()
    try:
        return reader.schema(like.schema).load(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_rows(
    rows: DataFrame,
    target: str,
    *,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_by: tuple[str, ...] = (),
    only_touched_partitions: bool = False,
    batch_size: int | None = None,
    options: dict[str, str] | None = None,
    skip_loaded: bool = False,
    ignore: tuple[str, ...] = ("load_dt",),
) -> int:
    """Write and return the number of rows, counted on the way.

    Replacing the target is one overwrite, so a rerun cannot leave rows twice; with
    ``only_touched_partitions`` only partitions with new rows are replaced.
    ``format='table'`` writes to a table of the session catalogue and creates it if
    needed; a table which is there keeps its schema, partitioning and rights, and rows
    go into it by column name. ``batch_size`` is rows per insert for JDBC, rows per file otherwise.
    ``skip_loaded`` appends only what is ``not_loaded``: the same load once more adds nothing.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    if skip_loaded:
        if mode != "append":
            raise ValueError("skip_loaded is for mode append")
        loaded = _loaded(rows.sparkSession, target, format, options or {}, rows)
        if loaded is not None:
            rows = not_loaded(rows, loaded, ignore, partition_by)
    seen = Observation("rows written")
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode).options(**(options or {}))
    if format == "jdbc":
        if mode == "overwrite":
            writer = writer.option("truncate", "true")
        if batch_size:
            writer = writer.option("batchsize", batch_size)
        writer.format("jdbc").option("dbtable", target).save()
        return seen.get["rows"]
    if batch_size:
        writer = writer.option("maxRecordsPerFile", batch_size)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_touched_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if format == "table":
        if mode == "overwrite" and rows.sparkSession.catalog.tableExists(target):
            _replace_rows(counted, target, batch_size, only_touched_partitions)
        else:
            writer.saveAsTable(target)
    else:
        writer.format(format).save(target)
    return seen.get["rows"]


def _replace_rows(rows: DataFrame, target: str, batch_size: int | None, only_touched_partitions: bool) -> None:
    """Put the rows in place of those of a table, or of the partitions they fall into."""
    session = rows.sparkSession
    columns = session.table(target).columns
    if set(columns) != set(rows.columns):
        raise ValueError(f"{target} has columns {sorted(columns)}, the rows have {sorted(rows.columns)}")
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = session.conf.get(setting)
    writer = rows.select(*columns).write
    if batch_size:
        writer = writer.option("maxRecordsPerFile", batch_size)
    session.conf.set(setting, "dynamic" if only_touched_partitions else "static")
    try:
        writer.insertInto(target, overwrite=True)
    finally:
        session.conf.set(setting, before)
