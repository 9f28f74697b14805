"""Fields of JSON text as typed columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def typed_fields(rows: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """The rows with one column per field (a name at the top of the document, with its type), ``fault`` and ``bad_<column>``.

    The text is parsed once, to a variant.  Text that is no document, or in which a field is missing or of another
    type, is kept in ``bad_<column>`` with the first fault; the other fields are still read.  A null text has no fault.
    """
    parsed = rows.withColumn("_document", F.try_parse_json(column))
    values = {n: F.try_variant_get("_document", f"$.{n}", kind) for n, kind in fields.items()}
    fault = F.when(F.col("_document").isNull(), F.lit("no document"))
    for name in fields:
        fault = fault.when(F.col(name).isNull(), F.lit(f"{name} is no number" if fields[name] in ("bigint", "double") else f"{name} is missing"))
    found = parsed.withColumns(values).withColumn("fault", F.when(F.col(column).isNotNull(), fault))
    return found.withColumn(f"bad_{column}", F.when(F.col("fault").isNotNull(), F.col(column))).drop("_document")
