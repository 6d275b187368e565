"""The job: read, parse, redact, shape, write, all from one configuration."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from hushline.operators.lookups import Model, gazetteer_detections, model_detections, name_table
from hushline.operators.redaction import redact_transcripts
from hushline.rules import DEFAULT_RULES, Rules
from hushline.sources.sinks import output_rows, write_rows
from hushline.sources.transcripts import (
    DEFAULT_FIELDS, STATUSES, explode_turns, parse_transcripts, quarantined, read_transcripts,
)


class JobError(ValueError):
    """The job configuration is incomplete."""


@dataclass(frozen=True)
class Job:
    """Where to read, which rows, where to write."""

    source: str
    target: str
    source_format: str = "table"
    target_format: str = "table"
    fields: tuple[str, ...] = DEFAULT_FIELDS
    condition: str = "1=1"
    limit: int | None = None
    batch_size: int | None = None
    mode: str = "overwrite"
    partition_by: tuple[str, ...] = ()
    only_touched_partitions: bool = False
    #: In mode append: rows which the target holds already, but for the time of the load, are not written again.
    skip_loaded: bool = False
    #: Source column names, by role.
    columns: dict[str, str] = field(default_factory=dict)
    #: Target column names, by role; a role left out keeps its own name.
    target_columns: dict[str, str] = field(default_factory=dict)
    #: A table of names to look up in every turn, and its column; none by default.
    names: str | None = None
    names_column: str = "name"
    source_options: dict[str, str] = field(default_factory=dict)
    target_options: dict[str, str] = field(default_factory=dict)

    def column(self, role: str, default: str) -> str:
        return self.columns.get(role, default)

    @classmethod
    def from_file(cls, path: str, **overrides) -> "Job":
        """Read the ``tables`` and ``processing`` parts of a job's JSON file."""
        with open(path, encoding="utf-8") as f:
            doc = json.load(f)
        try:
            tables, processing = doc["tables"], doc["processing"]
            data = doc.get("dataset", {})

            def full(side: str, table: str) -> str:
                return f"{data[side]}.{table}" if data.get(side) else table

            values = {
                "source": full("input", tables["source"]["name"]),
                "target": full("output", tables["target"]["name"]),
                "fields": tuple(processing["selected_fields"]),
                "condition": processing.get("condition", "1=1"),
                "limit": processing.get("limit"),
                "batch_size": processing.get("batch_size"),
                "mode": processing.get("mode", "overwrite"),
                "skip_loaded": processing.get("skip_loaded", False),
                "columns": dict(tables["source"].get("columns", {})),
                "target_columns": dict(tables["target"].get("columns", {})),
                "names": (tables.get("names") or {}).get("name"),
                "names_column": (tables.get("names") or {}).get("column", "name"),
            }
        except KeyError as e:
            raise JobError(f"{path}: {e} is missing") from e
        values.update(overrides)
        return cls(**values)


def read_and_parse(spark: SparkSession, job: Job) -> DataFrame:
    rows = read_transcripts(
        spark, job.source, job.source_format, job.source_options,
        fields=job.fields, condition=job.condition, limit=job.limit,
    )
    named = {
        "transaction_id": job.column("transaction_id", "transaction_id"),
        "transaction_identifier": job.column("transaction_identifier", "transaction_identifier"),
        "file_date": job.column("transcription_file_dt", "file_date"),
        "transcription": job.column("input_transcript", "transcription"),
    }
    missing = [c for c in named.values() if c not in rows.columns]
    if missing:
        raise JobError(f"{job.source} has no columns {missing}")
    return parse_transcripts(rows.select(*[F.col(c).alias(n) for n, c in named.items()]))


def transcript_lookups(
    parsed: DataFrame, key: str, rules: Rules, names: DataFrame | None = None, model: Callable[[], Model] | None = None,
) -> DataFrame | None:
    """Spans of a name table and of a user's model in every turn; None without either."""
    turns = explode_turns(parsed, key)
    found = []
    if names is not None:
        found.append(gazetteer_detections(turns, names, key, rules=rules))
    if model is not None:
        found.append(model_detections(turns, model, key))
    return reduce(DataFrame.unionByName, found) if found else None


def redact_with_lookups(
    parsed: DataFrame, rules: Rules = DEFAULT_RULES, names: DataFrame | None = None,
    model: Callable[[], Model] | None = None, text: str = "transcription",
) -> DataFrame:
    """``redact_transcripts`` with a name table (of ``name_table``) and a model.

    What they find depends on the text alone, so rows are matched to it by a digest of
    the text: rows without an id, or with the same one, cannot be mixed up.
    """
    keyed = parsed.withColumn("_digest", F.md5(F.col(text)))
    found = transcript_lookups(keyed, "_digest", rules, names, model)
    if found is None:
        return redact_transcripts(parsed, rules)
    return redact_transcripts(keyed, rules, found, ("_digest",)).drop("_digest")


def _redacted(
    spark: SparkSession, job: Job, rules: Rules, model: Callable[[], Model] | None,
) -> DataFrame:
    names = name_table(spark.table(job.names), job.names_column) if job.names else None
    return redact_with_lookups(read_and_parse(spark, job), rules, names, model)


def _shaped(redacted: DataFrame, job: Job, rules: Rules) -> DataFrame:
    rows = output_rows(redacted, rules)
    return rows.withColumnsRenamed({n: to for n, to in job.target_columns.items() if n in rows.columns and n != to})


def redacted_output(
    spark: SparkSession, job: Job, rules: Rules = DEFAULT_RULES, model: Callable[[], Model] | None = None,
) -> DataFrame:
    """The rows the job writes. One stage from scan to write, unless a row cap or lookups are set."""
    return _shaped(_redacted(spark, job, rules, model), job, rules)


def observed_counts(redacted: DataFrame, seen: Observation, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The same rows; whatever reads them counts them by status, and their spans by entity, on the way.

    The counts are columns ``status <name>``, ``entity <name>`` and ``entities`` (spans of any entity).
    """
    entities = F.flatten(F.transform("redacted", lambda e: F.transform(e["spans"], lambda s: s["entity"])))
    spans = lambda found: F.coalesce(F.sum(F.coalesce(found, F.lit(0))), F.lit(0))
    # Most entities are not in a transcript, and one compiled test tells so; only others are counted out.
    of_entity = lambda e: F.when(F.array_contains("_entities", e), F.size(F.filter("_entities", lambda x: x == e)))
    return redacted.withColumn("_entities", entities).observe(
        seen,
        *[F.count_if(F.col("status") == s).alias(f"status {s}") for s in STATUSES],
        *[spans(of_entity(e)).alias(f"entity {e}") for e in sorted(rules.placeholders)],
        spans(F.when(F.col("_entities").isNotNull(), F.size("_entities"))).alias("entities"),
    ).drop("_entities")


def run_job(
    spark: SparkSession, job: Job, rules: Rules = DEFAULT_RULES, quarantine_target: str | None = None,
    model: Callable[[], Model] | None = None, counts: dict[str, int] | None = None,
) -> int:
    """Run the job; returns the number of rows written.

    With ``quarantine_target`` the ids of unreadable transcripts are written as well. They
    are found by their status alone; the second scan parses, but redacts nothing, and is
    left out where ``counts`` show that all were read. ``counts`` is filled with what
    ``observed_counts`` saw during the write. Not with ``skip_loaded``, which reads rows
    more than once.
    """
    if counts is not None and job.skip_loaded:
        raise JobError("counts on the way are those of one pass; skip_loaded takes more")
    redacted, seen = _redacted(spark, job, rules, model), Observation("what the job saw")
    if counts is not None:
        redacted = observed_counts(redacted, seen, rules)
    written = write_rows(
        _shaped(redacted, job, rules), job.target, format=job.target_format, mode=job.mode,
        partition_by=job.partition_by, only_touched_partitions=job.only_touched_partitions,
        batch_size=job.batch_size, options=job.target_options,
        skip_loaded=job.skip_loaded, ignore=(job.target_columns.get("load_dt", "load_dt"),),
    )
    if counts is not None:
        counts.update(seen.get)
    if quarantine_target is not None:
        unread = quarantined(read_and_parse(spark, job), "transaction_id", "transaction_identifier", "file_date")
        if counts is not None and counts["status ok"] == written:
            unread = unread.where(F.lit(False))
        write_rows(unread, quarantine_target, format=job.target_format, mode=job.mode)
    return written
