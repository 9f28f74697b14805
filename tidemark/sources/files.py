"""Landing-file readers with audit columns, and the quarantine of malformed records."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.schemas import INGESTED_AT

CORRUPT = "_corrupt_record"
REASON = "_reject_reason"


def add_audit_columns(df: DataFrame, source_system: str, batch_id: str | None = None) -> DataFrame:
    """Load time, source file, source system and, if given, the batch.  Works on batch and stream reads."""
    audit = {
        INGESTED_AT: F.current_timestamp(),
        "_source_file": F.col("_metadata.file_path"),
        "_source_system": F.lit(source_system),
    }
    if batch_id is not None:
        audit["_batch_id"] = F.lit(batch_id)
    return df.withColumns(audit)


def ingest_csv(
    spark: SparkSession,
    path: str,
    table: str,
    schema: StructType | None = None,
    batch_id: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header.  Give the schema: inferring it reads the files twice.

    ``multi_line`` allows line breaks inside quoted fields; such a file cannot be split, so one task reads it.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return add_audit_columns(reader.csv(path), f"csv/{table}", batch_id)


def ingest_json(
    spark: SparkSession,
    path: str,
    table: str,
    schema: StructType | None = None,
    batch_id: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """JSON documents or arrays, one per file; ``multi_line=False`` reads one record per line and splits files."""
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return add_audit_columns(reader.json(path), f"json/{table}", batch_id)


def ingest_parquet(spark: SparkSession, path: str, table: str, batch_id: str | None = None) -> DataFrame:
    return add_audit_columns(spark.read.parquet(path), f"parquet/{table}", batch_id)


@dataclass(frozen=True)
class Checked:
    """Records that satisfy the contract, and the rest with the reason."""

    valid: DataFrame
    rejected: DataFrame


def text_fields(schema: StructType) -> StructType:
    """The contract's columns as text, and the whole record where it has the wrong number of fields."""
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields]).add(CORRUPT, StringType(), True)


def judgement(schema: StructType) -> tuple[Column, dict[str, Column]]:
    """Why a record read as ``text_fields`` is rejected, null for a valid one; and the typed columns of valid records."""
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    unreadable = [F.col(name).isNotNull() & value.isNull() for name, value in typed.items()]
    reason = F.when(reduce(or_, unreadable, F.col(CORRUPT).isNotNull()), F.lit("malformed record"))
    for field in schema.fields:
        if not field.nullable:
            reason = reason.when(F.col(field.name).isNull(), F.lit(f"missing {field.name}"))
    return reason, typed


def judge_csv(
    spark: SparkSession, path: str, table: str, schema: StructType, batch_id: str | None = None, multi_line: bool = False, **options: object
) -> tuple[DataFrame, dict[str, Column]]:
    """Fields as text with audit columns and ``_reject_reason``; and the typed columns of valid records.

    A record is rejected when it has the wrong number of fields, when a field is no value of its type, or when
    a column the contract calls non-null is empty (file readers report every column as nullable).  Fields are
    read as text and cast here: the reader itself only parses the columns a query asks for, so what it calls
    malformed would depend on the query.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"').option("multiLine", multi_line)
    raw = reader.option("columnNameOfCorruptRecord", CORRUPT).options(**options).schema(text_fields(schema)).csv(path)
    reason, typed = judgement(schema)
    return add_audit_columns(raw, f"csv/{table}", batch_id).withColumn(REASON, reason), typed


def ingest_csv_checked(
    spark: SparkSession, path: str, table: str, schema: StructType, batch_id: str | None = None, multi_line: bool = False
) -> Checked:
    """Split a CSV into usable and rejected records (see ``judge_csv``)."""
    judged, typed = judge_csv(spark, path, table, schema, batch_id, multi_line)
    return Checked(
        valid=judged.filter(F.col(REASON).isNull()).drop(CORRUPT, REASON).withColumns(typed),
        rejected=judged.filter(F.col(REASON).isNotNull()),
    )
