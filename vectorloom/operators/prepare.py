"""Building the text to embed, and setting aside the records that cannot be used."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectorloom.operators.positions import BUCKET_WIDTH, BUCKETS_PER_BLOCK

MISSING_KEY = "missing bibcode"
NO_CONTENT = "no content"

# ``arrival`` packs the position of the source and the position in it into one BIGINT,
# so that "first seen" is a hash-aggregated minimum.
SEQ_BITS = 46


@dataclass(frozen=True)
class PrepareSettings:
    """``truncate`` counts characters of the joined text; 0 keeps whole texts."""

    fields: tuple[str, ...]
    prefix: str = ""
    suffix: str = ""
    delimiter: str = "\n\n"
    lowercase: bool = True
    truncate: int = 0

    def _digest(self, *parts: object) -> str:
        return hashlib.sha256("".join(str(part) for part in parts).encode()).hexdigest()[:16]

    @property
    def fields_hash(self) -> str:
        return self._digest(
            list(self.fields), self.prefix, self.suffix, self.delimiter, self.lowercase, self.truncate
        )

    @property
    def prompt_hash(self) -> str:
        return self._digest(self.prefix, self.suffix, self.delimiter)


def arrival(source_pos: Column | str = "source_pos", seq: Column | str = "seq") -> Column:
    pos = F.col(source_pos) if isinstance(source_pos, str) else source_pos
    seq = F.col(seq) if isinstance(seq, str) else seq
    packed = F.shiftleft(pos.cast("bigint"), SEQ_BITS) + seq.cast("bigint")
    in_range = seq.between(0, (1 << SEQ_BITS) - 1) & pos.between(0, (1 << (63 - SEQ_BITS)) - 1)
    return F.when(in_range, packed).otherwise(F.raise_error(F.lit("source_pos or seq is out of range")))


def _filled(field: str) -> Column:
    return F.when(F.col(field) != "", F.col(field))


def prepared_text(settings: PrepareSettings) -> Column:
    """Prefix, fields and suffix joined; null where no field has content of its own."""
    values = [F.lower(_filled(f)) if settings.lowercase else _filled(f) for f in settings.fields]
    affixes = [affix for affix in (settings.prefix, settings.suffix) if affix]
    own = F.lit(False)
    for field, value in zip(settings.fields, values):
        # without affixes the untouched field decides, which keeps the check cheap
        own = own | (F.coalesce(~value.isin(*affixes), F.lit(False)) if affixes else _filled(field).isNotNull())
    parts = [F.lit(settings.prefix)] if settings.prefix else []
    parts += values
    parts += [F.lit(settings.suffix)] if settings.suffix else []
    text = F.concat_ws(settings.delimiter, *parts)
    if settings.truncate > 0:
        text = F.substring(text, 1, settings.truncate)
    return F.when(own, text)


def tag_prepared(records: DataFrame, settings: PrepareSettings) -> DataFrame:
    """All records with ``text`` and, for the unusable ones, a ``reason``."""
    text = prepared_text(settings)
    reason = F.when(F.col("bibcode").isNull(), MISSING_KEY).when(F.col("text").isNull(), NO_CONTENT)
    return records.withColumn("text", text).withColumn("reason", reason)


def prepare(records: DataFrame, settings: PrepareSettings) -> DataFrame:
    tagged = tag_prepared(records, settings)
    return tagged.where(F.col("reason").isNull()).select(
        "bibcode", "text", "year", "seq", arrival().alias("arrival")
    )


def rejects(records: DataFrame, settings: PrepareSettings) -> DataFrame:
    tagged = tag_prepared(records, settings)
    return tagged.where(F.col("reason").isNotNull()).select("bibcode", "reason", "year", "seq")


def select_fields(records: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Only the requested columns; rows with none of them filled leave."""
    wanted = list(dict.fromkeys(["bibcode", *fields]))
    return records.select(*wanted).where(F.coalesce(*[F.col(f) for f in fields]).isNotNull())


def limit_records(prepared: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records in arrival order, exactly; nothing is sorted or moved.

    Records are counted per bucket of arrivals, and the bucket the limit falls into is
    found from sums in two levels. Only that bucket's arrivals are ordered to find the
    last one that stays, whatever ``n`` is. Equal arrivals stay or go together by ``bibcode``.
    """
    cut = arrival_cut(prepared, n)
    if cut is None:
        return prepared if n > 0 else prepared.limit(0)
    last, rest = cut
    tied = prepared.where(F.col("arrival") == last).orderBy("bibcode").limit(rest)
    return prepared.where(F.col("arrival") < last).unionByName(tied)


def arrival_cut(prepared: DataFrame, n: int) -> tuple[int, int] | None:
    """The arrival of the ``n``-th record and how many records of that arrival are among the first ``n``.

    None if there are fewer records, or ``n`` is 0.
    """
    if n <= 0:
        return None
    bucket = F.expr(f"arrival div {BUCKET_WIDTH}").alias("bucket")
    counts = prepared.groupBy(bucket).agg(F.count("*").alias("rows"))
    counts = counts.withColumn("block", F.expr(f"bucket div {BUCKETS_PER_BLOCK}"))
    blocks = counts.groupBy("block").agg(F.sum("rows").alias("rows"))
    block = _holding(blocks, "block", n)
    if block is None:
        return None
    number, before = block
    bucket_number, before = _holding(counts.where(F.col("block") == number), "bucket", n, before)
    inside = prepared.where(bucket.eqNullSafe(F.lit(bucket_number))).groupBy("arrival").agg(F.count("*").alias("rows"))
    last, before = _holding(inside, "arrival", n, before)
    return last, n - before


def _holding(counts: DataFrame, order: str, n: int, before: int = 0) -> tuple[int, int] | None:
    """The entry that holds the ``n``-th row, and how many rows come before it."""
    total = F.sum("rows").over(W.orderBy(order).rowsBetween(W.unboundedPreceding, 0)) + F.lit(before)
    found = counts.select(order, "rows", total.alias("total")).where(F.col("total") >= n).orderBy(order).first()
    return None if found is None else (found[order], found["total"] - found["rows"])
