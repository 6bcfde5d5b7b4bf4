"""Queries on records, prepared texts and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from vectorloom.functions import json_values as J
from vectorloom.functions import text as X
from vectorloom.operators import catalog as C
from vectorloom.operators import dedup as D
from vectorloom.operators import embed as E
from vectorloom.operators import prepare as P
from vectorloom.operators import stats as A
from vectorloom.plans import tables as B
from vectorloom.plans.oracle_parts import DOCS, HASHED, STRIP, VECS
from vectorloom.plans.registry import query
from vectorloom.sources import files as R
from vectorloom.sources.custom import load_records

# ---------------------------------------------------------------- JSON records


def _lines(spark, sf_dir, broken=False):
    """Documents as JSON lines; with ``broken`` the German ones lack their last brace."""
    docs = B.records(spark, sf_dir)
    value = F.to_json(F.struct("bibcode", "title", "abstract", "lang"))
    if broken:
        value = F.when(F.col("lang") == "de", F.substring(value, 1, F.length(value) - 1)).otherwise(value)
    return docs.select(value.alias("value"), F.lit("documents").alias("path"), "seq", "year", "source_pos")


@query("parse_jsonl", f"WITH {DOCS} SELECT bibcode, title, abstract, seq FROM docs WHERE lang <> 'de'")
def parse_jsonl(spark, sf_dir):
    records = R.valid_records(R.parse_lines(_lines(spark, sf_dir, broken=True)))
    return R.project_fields(records, ["title", "abstract"]).select("bibcode", "title", "abstract", "seq")


@query("corrupt_lines", f"WITH {DOCS} SELECT seq, path FROM (SELECT seq, 'documents' AS path, lang FROM docs) WHERE lang = 'de'")
def corrupt_lines(spark, sf_dir):
    return R.corrupt_lines(R.parse_lines(_lines(spark, sf_dir, broken=True))).select("seq", "path")


@query("count_records", "SELECT 'documents' AS path, count(*) AS records FROM documents")
def count_records(spark, sf_dir):
    return R.count_records(_lines(spark, sf_dir))


@query("project_fields", f"WITH {DOCS} SELECT bibcode, title, lang FROM docs")
def project_fields(spark, sf_dir):
    records = R.valid_records(R.parse_lines(_lines(spark, sf_dir)))
    return R.project_fields(records, ["title", "lang"]).select("bibcode", "title", "lang")


@query("json_props", "SELECT event_id AS seq, json_extract_string(props, '$.k') AS k FROM events")
def json_props(spark, sf_dir):
    """The JSON column of ``events`` read as records."""
    events = B.table(spark, sf_dir, "events")
    lines = events.select(F.col("props").alias("value"), F.col("event_id").alias("seq"))
    return R.project_fields(R.valid_records(R.parse_lines(lines)), ["k"]).select("seq", "k")


@query(
    "drop_empty_records",
    f"""WITH {DOCS} SELECT seq, CASE WHEN lang = 'en' THEN title END AS title,
        CASE WHEN lang = 'fr' THEN abstract END AS abstract FROM docs WHERE lang IN ('en', 'fr')""",
)
def drop_empty_records(spark, sf_dir):
    docs = B.records(spark, sf_dir)
    value = F.to_json(
        F.struct(
            F.when(F.col("lang") == "en", F.col("title")).alias("title"),
            F.when(F.col("lang") == "fr", F.col("abstract")).alias("abstract"),
        )
    )
    records = R.valid_records(R.parse_lines(docs.select(value.alias("value"), "seq")))
    return R.project_fields(records, ["title", "abstract"]).select("seq", "title", "abstract")


@query(
    "truthy_fields",
    """SELECT d.doc_id AS seq, coalesce(quality, 0) <> 0 AS quality, coalesce(toxic, 0) = 1 AS toxic,
              coalesce(quality, 0) <> 0 AS zero_text, coalesce(quality, 0) = 1 AS lang,
              coalesce(toxic, 0) = 1 AS listed, coalesce(toxic, 0) = 1 AS nested
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def truthy_fields(spark, sf_dir):
    docs = B.table(spark, sf_dir, "documents").select("doc_id", "lang")
    rows = docs.join(B.table(spark, sf_dir, "labels"), "doc_id", "left")
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    value = F.to_json(
        F.struct(
            "quality",
            toxic.alias("toxic"),
            F.when(good, "0").alias("zero_text"),
            F.when(good, F.col("lang")).otherwise("").alias("lang"),
            F.when(toxic, F.array("lang")).otherwise(F.array().cast("array<string>")).alias("listed"),
            F.when(toxic, F.create_map("lang", "lang")).otherwise(F.create_map().cast("map<string,string>")).alias("nested"),
        )
    )
    parsed = R.parse_lines(rows.select(value.alias("value"), F.col("doc_id").alias("seq")))
    names = ["quality", "toxic", "zero_text", "lang", "listed", "nested"]
    return parsed.select("seq", *[J.is_truthy(F.col("record"), name).alias(name) for name in names])


@query(
    "preview",
    f"""WITH {DOCS} SELECT bibcode, title, CASE WHEN length(abstract) > 200 THEN substr(abstract, 1, 200) || '...'
        ELSE abstract END AS abstract, year, seq FROM docs ORDER BY year, seq LIMIT 5""",
)
def preview(spark, sf_dir):
    return R.preview(B.records(spark, sf_dir), ["title", "abstract"])


@query("select_fields", f"WITH {DOCS} SELECT bibcode, title FROM docs")
def select_fields(spark, sf_dir):
    return P.select_fields(B.records(spark, sf_dir), ["title"])


@query("select_years", f"WITH {DOCS} SELECT bibcode, year FROM docs WHERE year BETWEEN 2002 AND 2005 OR year IN (2008, 2009)")
def select_years(spark, sf_dir):
    chosen = R.year_filter("2002:2005") | R.year_filter("2008,2009")
    return B.records(spark, sf_dir).where(chosen).select("bibcode", "year")


@query("limit_records", f"WITH {DOCS} SELECT bibcode, year FROM docs ORDER BY arrival LIMIT 150")
def limit_records(spark, sf_dir):
    return P.limit_records(B.prepared(spark, sf_dir), 150).select("bibcode", "year")


@query(
    "limit_records_large",
    f"""WITH {DOCS} SELECT bibcode, year FROM docs QUALIFY row_number() OVER (ORDER BY arrival)
        <= (SELECT count(*) * 9 // 10 FROM docs)""",
)
def limit_records_large(spark, sf_dir):
    """Nine tenths of all records: the cut lies in a late year."""
    prepared = B.prepared(spark, sf_dir)
    return P.limit_records(prepared, prepared.count() * 9 // 10).select("bibcode", "year")


@query("year_range", f"WITH {DOCS} SELECT count(DISTINCT year) AS years, min(year) AS first_year, max(year) AS last_year FROM docs")
def year_range(spark, sf_dir):
    return A.year_range(B.records(spark, sf_dir))


@query(
    "table_source",
    """SELECT CAST(doc_id AS VARCHAR) AS bibcode, 2000::INTEGER AS year, 2000::INTEGER AS source_pos, doc_id AS seq, text, lang
       FROM documents""",
)
def table_source(spark, sf_dir):
    """The documents through the interface of record sources."""
    uri = f"table:{sf_dir}/documents.parquet?key=doc_id&order=doc_id&year=2000"
    return load_records(spark, uri, ["text", "lang"])


# ---------------------------------------------------------------- prepared text


@query(
    "prepare_text",
    f"""WITH {DOCS} SELECT bibcode, 'Paper: ' || '|' || lower(title) || '|' || lower(abstract) || '|' || ' [END]' AS text,
        year FROM docs""",
)
def prepare_text(spark, sf_dir):
    settings = P.PrepareSettings(fields=("title", "abstract"), prefix="Paper: ", suffix=" [END]", delimiter="|")
    return B.prepared(spark, sf_dir, settings).select("bibcode", "text", "year")


@query("truncate_text", f"WITH {DOCS} SELECT bibcode, substr(title || chr(10) || chr(10) || abstract, 1, 300) AS text FROM docs")
def truncate_text(spark, sf_dir):
    settings = P.PrepareSettings(fields=("title", "abstract"), lowercase=False, truncate=300)
    return B.prepared(spark, sf_dir, settings).select("bibcode", "text")


def _gappy(spark, sf_dir):
    """Records in which Spanish ones lack the key and German ones lack both fields."""
    docs = B.records(spark, sf_dir)
    german = F.col("lang") == "de"
    return docs.select(
        F.when(F.col("lang") != "es", F.col("bibcode")).alias("bibcode"),
        F.when(german, F.lit("")).otherwise(F.col("title")).alias("title"),
        F.when(~german, F.col("abstract")).alias("abstract"),
        "lang",
        "year",
        "source_pos",
        "seq",
    )


@query("reject_missing_key", f"WITH {DOCS} SELECT seq, year, 'missing bibcode' AS reason FROM docs WHERE lang = 'es'")
def reject_missing_key(spark, sf_dir):
    rejected = P.rejects(_gappy(spark, sf_dir), P.PrepareSettings(fields=("lang",)))
    return rejected.select("seq", "year", "reason")


@query("reject_no_content", f"WITH {DOCS} SELECT bibcode, year, 'no content' AS reason FROM docs WHERE lang IN ('en', 'fr')")
def reject_no_content(spark, sf_dir):
    """A field that only repeats the prefix or suffix is no content."""
    settings = P.PrepareSettings(fields=("lang",), prefix="en", suffix="fr")
    return P.rejects(B.records(spark, sf_dir), settings).select("bibcode", "year", "reason")


@query(
    "prepare_rejects",
    f"""WITH {DOCS} SELECT CASE WHEN lang = 'de' THEN bibcode END AS bibcode, seq,
        CASE lang WHEN 'es' THEN 'missing bibcode' ELSE 'no content' END AS reason FROM docs WHERE lang IN ('de', 'es')""",
)
def prepare_rejects(spark, sf_dir):
    return P.rejects(_gappy(spark, sf_dir), B.SETTINGS).select("bibcode", "seq", "reason")


@query("text_hash_raw", f"WITH {DOCS} SELECT bibcode, sha256(abstract) AS text_hash FROM docs")
def text_hash_raw(spark, sf_dir):
    return B.records(spark, sf_dir).select("bibcode", X.raw_text_hash("abstract").alias("text_hash"))


@query("text_hash_norm", f"WITH {DOCS} SELECT bibcode, sha256(lower(trim(abstract, {STRIP}))) AS text_hash FROM docs")
def text_hash_norm(spark, sf_dir):
    return B.records(spark, sf_dir).select("bibcode", X.normalised_text_hash("abstract").alias("text_hash"))


@query(
    "config_fingerprint",
    f"""WITH {DOCS} SELECT bibcode,
        substr(sha256('[''title'', ''abstract'']' || chr(10) || chr(10) || 'True0'), 1, 16) AS fields_hash,
        substr(sha256(chr(10) || chr(10)), 1, 16) AS prompt_hash FROM docs""",
)
def config_fingerprint(spark, sf_dir):
    return B.prepared(spark, sf_dir, B.SETTINGS).select(
        "bibcode",
        F.lit(B.SETTINGS.fields_hash).alias("fields_hash"),
        F.lit(B.SETTINGS.prompt_hash).alias("prompt_hash"),
    )


@query("affix_text", "SELECT item_id, 'query: ' || text || ' ?' AS text FROM benchmark")
def affix_text(spark, sf_dir):
    return B.table(spark, sf_dir, "benchmark").select("item_id", X.affix("text", "query: ", " ?").alias("text"))


@query("token_estimate", "SELECT doc_id, CAST(length(text) // 4 AS BIGINT) AS tokens FROM documents")
def token_estimate(spark, sf_dir):
    return B.table(spark, sf_dir, "documents").select("doc_id", X.token_estimate("text").alias("tokens"))


_URI = """SELECT doc_id, CASE lang WHEN 'en' THEN 'hf://org/' || source WHEN 'fr' THEN 'openai://' || source
  WHEN 'de' THEN 'gguf://models/' || source || '.gguf' ELSE source || ':v1/' || lang END AS uri FROM documents"""


def _uris(spark, sf_dir):
    lang, source = F.col("lang"), F.col("source")
    uri = (
        F.when(lang == "en", F.concat(F.lit("hf://org/"), source))
        .when(lang == "fr", F.concat(F.lit("openai://"), source))
        .when(lang == "de", F.concat(F.lit("gguf://models/"), source, F.lit(".gguf")))
        .otherwise(F.concat(source, F.lit(":v1/"), lang))
    )
    return B.table(spark, sf_dir, "documents").select("doc_id", uri.alias("uri"))


@query(
    "model_uri_parts",
    f"""SELECT doc_id, CASE WHEN uri LIKE 'openai://%' THEN 'openai' WHEN uri LIKE 'hf://%' THEN 'huggingface'
        WHEN uri LIKE 'gguf://%' THEN 'llamacpp' ELSE 'unknown' END AS model_type,
        regexp_replace(uri, '^[a-z]+://', '') AS model_name FROM ({_URI})""",
)
def model_uri_parts(spark, sf_dir):
    return _uris(spark, sf_dir).select(
        "doc_id", X.model_type("uri").alias("model_type"), X.model_name("uri").alias("model_name")
    )


@query(
    "model_safe_name",
    f"""SELECT doc_id, replace(replace(uri, '/', '_'), ':', '_') AS safe_name,
        regexp_extract(uri, '[^/]*$') AS short_name FROM ({_URI})""",
)
def model_safe_name(spark, sf_dir):
    return _uris(spark, sf_dir).select(
        "doc_id", X.model_safe_name("uri").alias("safe_name"), X.model_short_name("uri").alias("short_name")
    )


@query(
    "split_texts",
    f"""SELECT conv_id, turn, trim(line, {STRIP}) AS line, count(*) AS n
        FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations)
        WHERE trim(line, {STRIP}) <> '' GROUP BY ALL""",
)
def split_texts(spark, sf_dir):
    turns = B.table(spark, sf_dir, "conversations")
    lines = turns.select("conv_id", "turn", F.explode(X.non_blank_lines("text")).alias("line"))
    return lines.groupBy("conv_id", "turn", "line").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- duplicates


@query(
    "dedup_first_seen",
    f"""WITH {HASHED} SELECT h.bibcode, h.year, text_hash, first_seen_bibcode, first_seen_year,
        h.arrival <> f.arrival AS is_duplicate FROM hashed h JOIN firsts f USING (text_hash)""",
)
def dedup_first_seen(spark, sf_dir):
    tagged = D.annotate(B.hashed(spark, sf_dir))
    return tagged.select("bibcode", "year", "text_hash", "first_seen_bibcode", "first_seen_year", "is_duplicate")


@query(
    "dedup_duplicates",
    f"""WITH {HASHED} SELECT h.bibcode, h.year, text_hash, first_seen_year, first_seen_bibcode
        FROM hashed h JOIN firsts f USING (text_hash) WHERE h.arrival <> f.arrival""",
)
def dedup_duplicates(spark, sf_dir):
    return D.duplicates(B.hashed(spark, sf_dir))


@query(
    "dedup_within_year",
    f"""WITH {HASHED} SELECT bibcode, year, text_hash,
        first_value(bibcode) OVER w AS first_seen_bibcode, row_number() OVER w > 1 AS is_duplicate
        FROM hashed WINDOW w AS (PARTITION BY text_hash, year ORDER BY arrival)""",
)
def dedup_within_year(spark, sf_dir):
    tagged = D.annotate(B.hashed(spark, sf_dir), cross_year=False)
    return tagged.select("bibcode", "year", "text_hash", "first_seen_bibcode", "is_duplicate")


@query(
    "dedup_unique",
    f"""WITH {HASHED} SELECT bibcode, year, text FROM hashed SEMI JOIN firsts USING (arrival)
        WHERE text_hash NOT IN (SELECT sha256(lower(trim(text, {STRIP}))) FROM benchmark)""",
)
def dedup_unique(spark, sf_dir):
    """First arrivals whose text is not among the benchmark texts already stored."""
    store = D.with_hash(B.table(spark, sf_dir, "benchmark")).select("text_hash").distinct()
    return D.unique_rows(B.hashed(spark, sf_dir), store).select("bibcode", "year", "text")


@query(
    "dup_lookup",
    f"""WITH {HASHED} SELECT bibcode, year, text_hash, first_seen_bibcode, first_seen_year
        FROM hashed JOIN firsts USING (text_hash)""",
)
def dup_lookup(spark, sf_dir):
    rows = B.hashed(spark, sf_dir)
    found = D.find_in_store(rows.drop("text"), D.first_seen(rows))
    return found.select("bibcode", "year", "text_hash", "first_seen_bibcode", "first_seen_year")


@query("dedup_store_stats", f"WITH {HASHED} SELECT count(*) AS unique_hashes FROM firsts")
def dedup_store_stats(spark, sf_dir):
    return D.store_stats(D.first_seen(B.hashed(spark, sf_dir)))


@query(
    "resume_skip",
    f"""WITH {DOCS}, {VECS} SELECT bibcode, year FROM docs
        WHERE year NOT IN (SELECT year + 5 FROM vecs)""",
)
def resume_skip(spark, sf_dir):
    """Records of the years no finished block covers."""
    done = C.manifests(B.vectors(spark, sf_dir).withColumn("year", F.col("year") + 5))
    records = B.records(spark, sf_dir).withColumn("model", F.lit(B.TABLE_MODEL))
    return C.resume_filter(records, done).select("bibcode", "year")


# ---------------------------------------------------------------- runs


@query(
    "batch_plan",
    f"""WITH {DOCS}, lens AS (SELECT year, count(*) AS records, CAST(sum(length(abstract)) // count(*) AS BIGINT) AS avg_length
        FROM docs GROUP BY year)
        SELECT year, records, avg_length,
               least(8192 // greatest(avg_length // 4, 1), 50) AS api_batch,
               CASE WHEN avg_length // 4 > 512 THEN 8 WHEN avg_length // 4 > 256 THEN 16 ELSE 256 END::BIGINT AS gpu_batch,
               CASE WHEN avg_length // 4 > 1024 THEN 2 WHEN avg_length // 4 > 512 THEN 4 ELSE 8 END::BIGINT AS cpu_batch
        FROM lens""",
)
def batch_plan(spark, sf_dir):
    return E.batch_plan(B.prepared(spark, sf_dir))


def _statuses(spark, sf_dir):
    """One status per record: Spanish ones are rejected, repeats are duplicates."""
    tagged = P.tag_prepared(_gappy(spark, sf_dir), P.PrepareSettings(fields=("abstract", "title")))
    usable = D.with_hash(tagged.where("reason IS NULL").withColumn("arrival", P.arrival()))
    kept = D.annotate(usable.select("bibcode", "text", "text_hash", "year", "arrival"))
    status = F.when(F.col("is_duplicate"), "duplicate").otherwise("ok")
    left = tagged.where("reason IS NOT NULL").select("year", F.lit("rejected").alias("status"))
    return kept.select("year", status.alias("status")).unionByName(left).withColumn("batch_no", F.lit(None).cast("int"))


_STATUSES = f"""{DOCS}, usable AS (
  SELECT year, row_number() OVER (PARTITION BY sha256(lower(trim(abstract, {STRIP}) || chr(10) || chr(10) || title))
         ORDER BY arrival) AS copy FROM docs WHERE lang NOT IN ('es', 'de')),
statuses AS (
  SELECT year, CASE WHEN copy = 1 THEN 'ok' ELSE 'duplicate' END AS status FROM usable
  UNION ALL SELECT year, 'rejected' FROM docs WHERE lang IN ('es', 'de'))"""


@query(
    "run_counters",
    f"""WITH {_STATUSES} SELECT count(*) AS loaded_records, count(*) FILTER (status <> 'rejected') AS total_records,
        count(*) FILTER (status = 'ok') AS processed_records, count(*) FILTER (status = 'rejected') AS skipped_records,
        0::BIGINT AS failed_records, count(*) FILTER (status = 'duplicate') AS duplicate_records,
        count(*) FILTER (status = 'ok' AND year % 3 = 0) AS total_batches FROM statuses""",
)
def run_counters(spark, sf_dir):
    """A model call has its number on the first of its records; here those of every third year."""
    call = F.when((F.col("status") == "ok") & (F.col("year") % 3 == 0), F.col("year"))
    return A.run_counters(_statuses(spark, sf_dir).withColumn("batch_no", call))


@query(
    "processing_summary",
    f"""WITH {_STATUSES}, c AS (SELECT count(*) FILTER (status = 'ok') AS p, count(*) FILTER (status = 'rejected') AS s,
        min(year) AS y1, max(year) AS y2 FROM statuses)
        SELECT p AS total_papers_processed, s AS total_papers_skipped, printf('%.2f%%', round(100.0 * p / (p + s), 2)) AS success_rate,
        greatest(CAST(ceil(p / 250) AS BIGINT), 1) AS chunks_created, y1 || '-' || y2 AS year_range,
        (SELECT string_agg(year::VARCHAR, ',' ORDER BY year) FROM (SELECT DISTINCT year FROM statuses)) AS years_processed FROM c""",
)
def processing_summary(spark, sf_dir):
    summary = A.processing_summary(_statuses(spark, sf_dir), chunk_size=250)
    return summary.withColumn("years_processed", F.array_join(F.col("years_processed").cast("array<string>"), ","))
