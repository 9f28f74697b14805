"""Frames one registered query works on, and the landing files it may need."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.raw_views import RawTables
from tidemark.plans import silver, staging
from tidemark.schemas import SOURCES
from tidemark.sources.scratch import materialise, scratch_path


class Tables:
    """Raw, silver and staging frames over one data folder; all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        # The raw views turn zone-less timestamps into instants, so the zone must be the layers' zone.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self._raw = RawTables(spark, folder)

    def given(self, name: str) -> DataFrame:
        return self._raw.given(name)

    def raw(self, name: str) -> DataFrame:
        return self._raw[name]

    def silver(self, name: str) -> DataFrame:
        return silver.BUILDERS[name](self.raw(name))

    def stored(self, name: str, *columns: str) -> DataFrame:
        """A silver table (or some of its columns) written once, for queries that read it more than once."""
        table = self.silver(name)
        return materialise(table.select(*columns) if columns else table, f"silver-{name}")[0]

    def reduced(self, name: str) -> DataFrame:
        return silver.BUILDERS[name](self.raw(name), **silver.REDUCED_OPTIONS[name])

    def staging(self, name: str) -> DataFrame:
        return getattr(staging, f"stg_{name}")(self.raw(name))

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    @cached_property
    def silver_set(self) -> dict[str, DataFrame]:
        return {t: self.silver(t) for t in SOURCES}

    def contract(self, name: str) -> DataFrame:
        """Raw rows in the columns of the source contract; columns the view leaves out are null."""
        raw = self.raw(name)
        columns = [
            (F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SOURCES[name].schema.fields
        ]
        return raw.select(*columns)


def land_csv(df: DataFrame, path: str, mode: str = "error", packed: bool = False) -> None:
    """Write CSV landing files that read back unchanged; ``packed`` ones are gzipped, fast rather than small, and hold a million rows at most."""
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    if packed:
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 1_000_000)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
