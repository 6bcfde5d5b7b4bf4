"""Record sources: anything that gives records to prepare, by one interface.

A source is an object with ``load(spark, fields)``. It gives a DataFrame with

* ``bibcode`` string: the record's key; null is set aside later with a reason;
* ``year`` int: the block a record belongs to;
* ``source_pos`` int and ``seq`` bigint: the place of the file or table, and of the record
  in it. Together they give the order in which repeated texts are first seen, so a pair
  must not repeat;
* one string column per requested field; null where a record has none.

Sources register under a scheme, so that a job can name them: ``load_records(spark,
"years:/data/papers?years=2015:2020", ["title"])``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Protocol
from urllib.parse import parse_qsl

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.sources import files

# Fixed columns of every source and their types.
PLACE = {"bibcode": "string", "year": "int", "source_pos": "int", "seq": "bigint"}


class RecordSource(Protocol):
    def load(self, spark: SparkSession, fields: Sequence[str]) -> DataFrame:
        """Records with the columns named above."""


Factory = Callable[..., RecordSource]
_sources: dict[str, Factory] = {}


def register_source(scheme: str, factory: Factory) -> None:
    """Use ``factory(path, **options)`` for sources called ``scheme:path?option=value``."""
    _sources[scheme] = factory


def open_source(uri: str) -> RecordSource:
    scheme, found, rest = uri.partition(":")
    if not found or scheme not in _sources:
        raise ValueError(f"unsupported source: {uri}; known schemes: {', '.join(sorted(_sources))}")
    path, _, options = rest.partition("?")
    return _sources[scheme](path, **dict(parse_qsl(options)))


def load_records(spark: SparkSession, source: str | RecordSource, fields: Sequence[str]) -> DataFrame:
    """The records of a source, its columns checked and in order; further columns leave.

    A column that is missing is an error that names it; other types are cast, and a value
    that can't be cast is an error when it is read.
    """
    source = open_source(source) if isinstance(source, str) else source
    fields = list(dict.fromkeys(fields))
    if clash := set(fields) & set(PLACE) - {"bibcode", "year"}:
        raise ValueError(f"fields named like the place of a record: {', '.join(sorted(clash))}")
    records = source.load(spark, fields)
    if missing := [c for c in [*PLACE, *fields] if c not in records.columns]:
        raise ValueError(f"{type(source).__name__} gave no column {', '.join(missing)}")
    texts = [F.col(f"`{field}`").cast("string").alias(field) for field in fields if field not in PLACE]
    return records.select(*[F.col(c).cast(kind).alias(c) for c, kind in PLACE.items()], *texts)


class YearFiles:
    """Yearly JSON files of a folder: ``years:/folder?years=2015:2020``; all years by default."""

    def __init__(self, folder: str, years: str = ""):
        self.folder, self.years = folder, years

    def load(self, spark: SparkSession, fields: Sequence[str]) -> DataFrame:
        if self.years:
            years = files.parse_years(self.years)
        else:
            found = files.discover_years(files.list_files(spark, self.folder))
            years = [row["year"] for row in found.collect()]  # one row per year
        records, _ = files.load_years(spark, self.folder, years, ["bibcode", *fields])
        return files.project_fields(records, fields, blank_falsy=True)


class TableRecords:
    """A table Spark can read: ``table:/path?key=doc_id&order=doc_id&year=year&format=parquet``.

    ``order`` is a whole number that is unique within a year; ``year`` may be a column or a number.
    """

    def __init__(self, path: str, key: str = "bibcode", order: str = "seq", year: str = "year", format: str = "parquet"):
        self.path, self.key, self.order, self.year, self.format = path, key, order, year, format

    def load(self, spark: SparkSession, fields: Sequence[str]) -> DataFrame:
        rows = spark.read.format(self.format).load(self.path)
        year = F.lit(int(self.year)) if self.year.isdigit() else F.col(self.year)
        placed = {"_key": F.col(self.key), "_year": year, "_order": F.col(self.order)}
        rows = rows.select(*fields, *[column.alias(name) for name, column in placed.items()])
        # years follow one another, so a year's place among the sources is the year itself
        return rows.select(
            *[f for f in fields if f not in PLACE], F.col("_key").alias("bibcode"), F.col("_year").alias("year"),
            F.col("_year").alias("source_pos"), F.col("_order").alias("seq"),
        )


register_source("years", YearFiles)
register_source("table", TableRecords)
