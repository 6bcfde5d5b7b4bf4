"""A stored term index: texts are split once, searches read the postings of their terms.

Three tables, each in parts by run: ``postings`` (term, key, occurrences, words of the
field), ``terms`` (documents holding a term) and ``figures`` (documents and words per
field). All figures add up over runs, so appending a run is the same as building anew.

Postings lie in folders by the hash of the term; within them a file holds a range of
(term, key), so a term in most documents is many files and a search opens only files
whose range can hold its terms.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorloom.functions import text as X
from vectorloom.functions import vectors as V
from vectorloom.functions.batches import released, slices
from vectorloom.operators import hybrid as H
from vectorloom.operators.search import arrow_type
from vectorloom.session import path_exists, ship_package

BUCKETS = 64
POSTINGS = "key {key}, term string, tf int, length int, field string, run bigint, bucket int"
TERMS = "field string, term string, df bigint, run bigint, bucket int"
FIGURES = "field string, docs bigint, words bigint, key_type string, run bigint"


def count_terms(docs: DataFrame, key: str, field: str) -> DataFrame:
    """``key, term, tf, length``: one row per distinct term of a text; texts without a term give none."""
    ship_package(docs.sparkSession)
    words = docs.select(F.col(key).alias("key"), X.words(field).alias("words")).where("key IS NOT NULL")
    kind = words.schema["key"].dataType
    schema = T.StructType().add("key", kind).add("term", "string").add("tf", T.IntegerType()).add("length", T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lists = batch.column("words")
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            coded = lists.flatten().dictionary_encode()
            row = np.repeat(np.arange(batch.num_rows), lengths)
            places = len(coded.dictionary)
            pairs, tf = np.unique(row * max(places, 1) + coded.indices.to_numpy(), return_counts=True)
            row, code = pairs // max(places, 1), pairs % max(places, 1)
            columns = [
                batch.column("key").take(pa.array(row)).cast(arrow_type(kind)),
                coded.dictionary.take(pa.array(code)).cast(pa.string()),
                pa.array(tf.astype(np.int32)),
                pa.array(lengths[row].astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "term", "tf", "length"])

    return words.mapInArrow(lambda batches: released(run(batches)), schema)


class TermIndex:
    """Postings of some text fields in a folder.

    ``buckets`` is fixed when the folder is made. A record is indexed by one run; a key
    that several rows carry is scored as one document. Rows without a key are left out.
    """

    def __init__(self, spark: SparkSession, path: str, fields: Sequence[str] = ("text",), key: str = "bibcode", buckets: int = BUCKETS):
        self.spark, self.path, self.fields, self.key, self.buckets = spark, path.rstrip("/"), tuple(fields), key, buckets

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def append(self, docs: DataFrame, run: int) -> None:
        """Index the rows of a run; repeated, it replaces what an earlier attempt left."""
        parts = [count_terms(docs, self.key, field).withColumn("field", F.lit(field)) for field in self.fields]
        postings = parts[0]
        for part in parts[1:]:
            postings = postings.unionByName(part)
        postings = postings.withColumn("bucket", self._bucket(F.col("term")))
        order = ["bucket", "field", "term", "key"]
        postings = postings.repartitionByRange(*order).sortWithinPartitions(*order)
        written = f"{self.path}/postings/run={run}"
        postings.write.mode("overwrite").partitionBy("bucket").parquet(written)

        kind = docs.schema[self.key].dataType.simpleString()
        stored = self.spark.read.schema(POSTINGS.format(key=kind)).parquet(written)
        terms = stored.groupBy("bucket", "field", "term").agg(F.count("*").alias("df"))
        terms = terms.repartitionByRange("bucket", "field", "term").sortWithinPartitions("bucket", "field", "term")
        terms.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/terms/run={run}")
        words = stored.groupBy("field", "key").agg(F.max("length").alias("length"))
        words = words.groupBy("field").agg(F.sum("length").alias("words"))
        listed = self.spark.createDataFrame([(field,) for field in self.fields], "field string")
        count = docs.where(F.col(self.key).isNotNull()).agg(F.count_distinct(self.key).alias("docs"))
        figures = listed.join(words, "field", "left").join(F.broadcast(count)).select(
            "field", "docs", F.coalesce("words", F.lit(0)).cast("bigint").alias("words"), F.lit(kind).alias("key_type")
        )
        figures.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/figures/run={run}")

    def _read(self, table: str, schema: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/{table}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")

    @property
    def figures(self) -> DataFrame:
        return self._read("figures", FIGURES)

    @property
    def postings(self) -> DataFrame:
        # the type of the key is that of the indexed rows; a file always holds it, also where no text had a term
        kinds = self.figures.select("key_type").limit(1).collect()
        return self._read("postings", POSTINGS.format(key=kinds[0][0] if kinds else "string"))

    @property
    def terms(self) -> DataFrame:
        return self._read("terms", TERMS)

    def _of(self, table: DataFrame, terms: Sequence[str], fields: Sequence[str]) -> DataFrame:
        """Rows of some terms: their folders, and the row groups whose range holds them."""
        folders = F.col("bucket").isin(*[self._bucket(F.lit(term)) for term in terms])
        return table.where(folders & F.col("term").isin(*terms) & F.col("field").isin(*fields))

    def weights(self, terms: Sequence[str], fields: Sequence[str]) -> DataFrame:
        """``field, term, idf, mean``: at most one row per term and field."""
        held = self._of(self.terms, terms, fields).groupBy("field", "term").agg(F.sum("df").alias("df"))
        figures = self.figures.groupBy("field").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words"))
        idf = F.log1p((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        return held.join(figures, "field").select(
            "field", "term", idf.alias("idf"), (F.col("words") / F.col("docs")).alias("mean")
        )

    def scores(self, query: str, fields: Sequence[str] | None = None, out: str = "keyword") -> DataFrame:
        """``key, out``: BM25 of the query summed over the fields, of the documents that hold a term."""
        fields, terms = tuple(fields or self.fields), H.query_terms(query)
        if unknown := set(fields) - set(self.fields):
            raise ValueError(f"fields that are not indexed: {', '.join(sorted(unknown))}")
        if not terms:
            empty = T.StructType([self.postings.schema["key"]]).add(out, "double")
            return self.spark.createDataFrame([], empty).withColumnRenamed("key", self.key)
        weighed = self._of(self.postings, terms, fields).join(F.broadcast(self.weights(terms, fields)), ["field", "term"])
        share = F.coalesce(F.col("length") / F.nullif(F.col("mean"), F.lit(0.0)), F.lit(1.0))
        gain = F.col("idf") * F.col("tf") * (H.K1 + 1) / (F.col("tf") + H.K1 * (1 - H.B + H.B * share))
        total = F.round(F.sum(gain), V.SCORE_DECIMALS).alias(out)
        return weighed.groupBy(F.col("key").alias(self.key)).agg(total)

    def search(self, query: str, k: int = 10, fields: Sequence[str] | None = None) -> DataFrame:
        """The ``k`` best documents: ``rank, key, score``; ties go to the lower key."""
        return H.ranked(self.scores(query, fields, "score"), k, self.key).select("rank", self.key, "score")
