"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.catalog import inputs as i
from gleanery.functions.vectors import cosine, vector_as_strings
from gleanery.operators.answers import DOCS_TYPE, analysis_text, retrieved_docs, with_payload
from gleanery.operators.chunking import explode_chunks, silver_chunks
from gleanery.operators.embedding import embed, gold_vectors
from gleanery.operators.ivf import IvfIndex
from gleanery.operators.mart import daily_mart, latest_first, mart_of_states
from gleanery.operators.known_ids import clashes
from gleanery.operators.quality import Suite, audit, gold_suite, mart_suite, response_suite, silver_suite, unique_check
from gleanery.operators.requests import accept_requests, reject_requests
from gleanery.operators.search import SearchLimits, knn, knn_lsh
from gleanery.operators.telemetry import completion_tokens, cost_usd, latency_ms, prompt_tokens
from gleanery.plans.document_index import document_table, ingest_documents
from gleanery.plans.file_changes import CHUNKS, FileTables, carry_changes
from gleanery.plans.medallion import (
    BRONZE,
    GOLD,
    INDEX,
    MART,
    SILVER,
    TELEMETRY,
    IngestSettings,
    bronze_suite,
    ingest_bronze,
    nightly,
    rebuild_mart,
)
from gleanery.plans.question_answering import answer_from_chunks, answer_requests, chunk_hits
from gleanery.plans.usage_log import REJECTED_TELEMETRY, log_answers, timed, timed_records
from gleanery.session import spread_small, work_dir
from gleanery.sinks.buckets import BucketedTable
from gleanery.sinks.tables import TableStore, changed_rows, upsert
from gleanery.sources.documents import accept_documents, reject_documents
from gleanery.sources.text_files import bronze_rows, scan_text_files
from gleanery.streaming.ingest import ingest_new_files
from gleanery.streaming.mart import append_closed_days, mart_table
from gleanery.streaming.outcomes import LATE_TELEMETRY, REPLAYED_TELEMETRY, joined_with_times, route_responses
from gleanery.streaming.telemetry import log_responses, write_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EMBEDDINGS_DIM = 64  # dimensions of the driver's embeddings table


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the type in which results are compared."""
    decimals = {f.name: F.col(f.name).cast("double") for f in df.schema if f.dataType.typeName() == "decimal"}
    return df.withColumns(decimals) if decimals else df


# --- sources, chunks, vectors -------------------------------------------------------------------


@query
def bronze_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = i.table(spark, sf_dir, "documents")
    return bronze_rows(_as_files(rows), i.RUN_TS).select("file_path", "raw_text", "is_valid_utf8", "content_hash")


def _as_files(documents: DataFrame) -> DataFrame:
    return documents.select(
        i.file_path().alias("path"),
        F.lit(i.RUN_TS).cast("timestamp").alias("modificationTime"),
        F.col("text").cast("binary").alias("content"),
    )


@query
def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "raw-files")
    i.export_text_files(spark, sf_dir, path)
    rows = bronze_rows(scan_text_files(spark, path), i.RUN_TS)
    lang = F.regexp_extract("file_path", "/lang=([^/]+)/", 1)
    source = F.regexp_extract("file_path", "/source=([^/]+)/", 1)
    return rows.select(lang.alias("lang"), source.alias("source"), "raw_text", "is_valid_utf8")


@query
def documents_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accept_documents(_partial_documents(spark, sf_dir))


@query
def documents_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_documents(_partial_documents(spark, sf_dir)).select("id", "category", "reason")


def _partial_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents some of which lack their id, category or content."""
    rows = i.table(spark, sf_dir, "documents")
    return rows.select(
        F.when(F.col("lang") != "de", F.col("doc_id").cast("string")).alias("id"),
        F.when(F.col("lang") != "fr", F.col("text")).alias("content"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("category"),
    )


@query
def chunk_sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_chunks(i.table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


@query
def chunk_custom_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_chunks(i.table(spark, sf_dir, "documents").select("doc_id", "text"), "text", size=200, overlap=120)


@query
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_chunks(i.bronze(spark, sf_dir)).select("chunk_id", "file_path", "chunk_pos")


@query
def embed_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = spread_small(i.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    cells = embed(texts, "text", "vector").select("doc_id", F.posexplode("vector").alias("bucket", "weight"))
    return cells.where("weight != 0").withColumn("weight", F.col("weight").cast("int"))


@query
def vector_to_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The string form, read back: a float survives the round trip."""
    vectors = i.table(spark, sf_dir, "embeddings").select("vec_id", vector_as_strings(F.col("embedding")).alias("strings"))
    parts = vectors.select("vec_id", F.posexplode("strings").alias("pos", "text"))
    return parts.select("vec_id", "pos", F.col("text").cast("float").cast("double").alias("value"))


# --- search and answers -------------------------------------------------------------------------


@query
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector against the one numbered after it."""
    vectors = i.table(spark, sf_dir, "embeddings")
    first = vectors.select("vec_id", F.col("embedding").alias("a"))
    second = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    pairs = first.join(second, "vec_id")
    return pairs.select("vec_id", F.round(cosine(F.col("a"), F.col("b")), 6).alias("similarity"))


@query
def knn_top2(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = knn(i.query_vectors(spark, sf_dir), i.corpus_vectors(spark, sf_dir), 2, EMBEDDINGS_DIM)
    return hits.withColumn("score", F.round("score", 4))


@query
def knn_top2_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hits where the queries are too many to be sent at once: blocks of 256, with floors from 256 rows."""
    limits = SearchLimits(broadcast_bytes=256 * 4 * EMBEDDINGS_DIM, floor_rows=256)
    hits = knn(i.query_vectors(spark, sf_dir), i.corpus_vectors(spark, sf_dir), 2, EMBEDDINGS_DIM, limits)
    return hits.withColumn("score", F.round("score", 4))


@query
def knn_ivf_top2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors indexed in cells, stored, loaded and searched."""
    path = work_dir(spark, "ivf")
    IvfIndex.build(i.corpus_vectors(spark, sf_dir), path, EMBEDDINGS_DIM, k=2)
    hits = IvfIndex.load(spark, path).search(i.query_vectors(spark, sf_dir), 2)
    return hits.withColumn("score", F.round("score", 4))


@query
def knn_lsh_top2(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = knn_lsh(i.query_vectors(spark, sf_dir), i.corpus_vectors(spark, sf_dir), 2, EMBEDDINGS_DIM, tables=16, bits=4)
    return hits.withColumn("score", F.round("score", 4))


@query
def knn_top3_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = chunk_hits(i.questions(spark, sf_dir), _gold(spark, sf_dir))
    return hits.select("query_id", "rank", F.col("id").alias("chunk_id"), "file_path", "chunk_text", "score")


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_vectors(silver_chunks(i.bronze(spark, sf_dir)))


def _document_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector hits with string ids, so that documents of the same number are their payload."""
    hits = knn(i.query_vectors(spark, sf_dir), i.corpus_vectors(spark, sf_dir), 2, EMBEDDINGS_DIM)
    return hits.withColumn("id", F.col("id").cast("string"))


@query
def retrieved_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = with_payload(_document_hits(spark, sf_dir), i.documents(spark, sf_dir))
    return hits.select("query_id", "rank", "id", "content", "category", "score")


@query
def analyst_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = retrieved_docs(_document_hits(spark, sf_dir), i.documents(spark, sf_dir))
    text = F.concat(F.lit("vector "), F.col("query_id").cast("string"))
    return docs.select("query_id", analysis_text(text, F.col("retrieved_docs")).alias("analysis_output"))


@query
def rag_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = answer_from_chunks(i.requests(spark, sf_dir), _gold(spark, sf_dir))
    return answers.select(
        "request_id",
        F.size("retrieved_chunks").alias("chunk_count"),
        F.array_join("source_documents", ",").alias("source_documents"),
        "final_answer",
    )


@query
def query_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = i.requests(spark, sf_dir)
    accepted = accept_requests(rows).withColumn("reason", F.lit(None).cast("string"))
    return accepted.unionByName(reject_requests(rows)).select("request_id", F.length("query").alias("n_chars"), "reason")


@query
def batch_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = answer_requests(i.requests(spark, sf_dir), i.documents(spark, sf_dir))
    docs = F.col("retrieved_docs")
    return responses.select(
        "request_id",
        "query",
        "retrieval_step",
        "current_step",
        F.array_join(F.transform(docs, lambda d: d["id"]), ",").alias("doc_ids"),
        F.array_join(F.transform(docs, lambda d: d["category"]), ",").alias("categories"),
        F.get(docs, F.lit(0))["score"].alias("best_score"),
        "analysis_output",
        "error",
    )


# --- telemetry and mart -------------------------------------------------------------------------


@query
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = i.exchanges(spark, sf_dir)
    prompt, completion = prompt_tokens(F.col("query")), completion_tokens(F.col("analysis_output"))
    return rows.select(
        "request_id",
        prompt.alias("prompt_tokens"),
        completion.alias("completion_tokens"),
        (prompt + completion).alias("total_tokens"),
    )


@query
def cost_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_estimate(spark, sf_dir)
    cost = cost_usd(F.col("prompt_tokens"), F.col("completion_tokens"))
    return as_doubles(rows.select("request_id", cost.alias("total_cost_usd")))


@query
def latency_from_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that start at the event time and last as many milliseconds as the event's value."""
    events = i.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("started"), "value")
    ended = F.timestamp_micros(F.unix_micros("started") + F.round(F.col("value") * 1000).cast("bigint"))
    return events.select("event_id", latency_ms(F.col("started"), ended).alias("execution_time_ms"))


def _answer_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = answer_requests(i.requests(spark, sf_dir), i.documents(spark, sf_dir))
    return timed_records(responses, i.timings(spark, sf_dir))


@query
def telemetry_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _answer_telemetry(spark, sf_dir)
    return as_doubles(records).withColumn("execution_timestamp", F.unix_micros("execution_timestamp"))


@query
def mart_from_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(latest_first(daily_mart(_answer_telemetry(spark, sf_dir))))


@query
def mart_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question and answer turns logged as responses, in two batches and a stream, merged, and the mart of the stored records."""
    base = work_dir(spark, "log")
    store = TableStore(spark, f"{base}/tables")
    no_docs = F.array().cast(DOCS_TYPE).alias("retrieved_docs")
    responses = i.exchanges(spark, sf_dir).select("*", no_docs, F.lit(None).cast("string").alias("error"))
    part, times = F.pmod(F.hash("request_id"), F.lit(3)), i.timings(spark, sf_dir)
    for number in range(2):
        log_answers(store, responses.where(part == number), times)
    streamed = timed(responses.where(part == 2), times)
    streamed.write.parquet(f"{base}/streamed")
    arriving = spark.readStream.schema(streamed.schema).parquet(f"{base}/streamed")
    log_responses(arriving, store, f"{base}/checkpoint").awaitTermination()
    store.compact(TELEMETRY, "request_id")
    rebuild_mart(store)
    return as_doubles(latest_first(store.read(MART)))


@query
def mart_agent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(latest_first(daily_mart(i.event_telemetry(spark, sf_dir))))


# --- quality ------------------------------------------------------------------------------------


@query
def dq_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(silver_chunks(i.bronze(spark, sf_dir)), silver_suite())


@query
def dq_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = i.table(spark, sf_dir, "embeddings")
    gold = vectors.select(F.col("vec_id").cast("string").alias("chunk_id"), F.col("embedding").alias("embedding_vector"))
    return audit(gold, gold_suite(EMBEDDINGS_DIM))


@query
def dq_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(daily_mart(i.event_telemetry(spark, sf_dir)), mart_suite())


@query
def dq_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(answer_requests(i.requests(spark, sf_dir), i.documents(spark, sf_dir)), response_suite())


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_check(i.table(spark, sf_dir, "documents"), "text")


@query
def dq_unique_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that clash with published ones: Spanish documents come in under the number after their own, which may be taken."""
    rows = i.table(spark, sf_dir, "documents")
    published = rows.where("NOT lang <=> 'es'").select("doc_id")
    new = rows.where("lang <=> 'es'").select((F.col("doc_id") + 1).alias("doc_id"))
    return clashes(new, published, "doc_id")


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks that fail: copies of a text, and chunks longer than a bound below their size."""
    rows = i.bronze(spark, sf_dir)
    bronze = Suite("bronze", bronze_suite().rules, unique=["raw_text"], schema=rows.schema)
    return audit(rows, bronze).unionByName(audit(silver_chunks(rows), silver_suite(chunk_size=400)))


# --- table upkeep -------------------------------------------------------------------------------


@query
def vector_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors, upserted with all vectors moved up by their label, which makes some keys collide."""
    vectors = i.table(spark, sf_dir, "embeddings")
    payload = F.struct(F.col("label").alias("category")).alias("payload")
    content_hash = F.md5(F.col("label").cast("string")).alias("content_hash")
    current = vectors.select(
        F.col("vec_id").alias("doc_id"), F.lit(-1).cast("bigint").alias("written"), "embedding", payload, content_hash
    )
    incoming = vectors.select(
        (F.col("vec_id") + F.col("label")).alias("doc_id"), F.col("vec_id").alias("written"), "embedding", payload, content_hash
    )
    merged = upsert(current, incoming, "doc_id", "written")
    first_value = F.get("embedding", F.lit(0)).cast("double").alias("first_value")
    return merged.select("doc_id", "written", F.col("payload.category").alias("category"), first_value)


@query
def document_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents handed over, then again with some of them changed or incomplete."""
    store = TableStore(spark, work_dir(spark, "tables"))
    ingest_documents(store, i.documents(spark, sf_dir), run_ts=i.RUN_TS, buckets=16)
    changed = _partial_documents(spark, sf_dir).withColumn("content", F.concat("content", F.lit(" (revised)")))
    ingest_documents(store, changed, run_ts=i.RUN_TS + timedelta(days=1), buckets=16)
    points = document_table(store, 16).read()
    content_hash, dim = F.md5("payload.content").alias("content_hash"), F.size("embedding_vector").alias("dim")
    return points.select("doc_id", "payload.category", content_hash, dim)


@query
def index_sync_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against an index that lacks the German ones and holds other French ones."""
    rows = i.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    source = rows.select("doc_id", "lang", F.md5("text").alias("content_hash"))
    held = F.when(F.col("lang") == "fr", F.concat(F.col("text"), F.lit("."))).otherwise(F.col("text"))
    index = rows.where("NOT lang <=> 'de'").select("doc_id", F.md5(held).alias("content_hash"))
    return changed_rows(source, index, "doc_id").select("doc_id", "lang", "content_hash")


@query
def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents appended in four parts by language, then merged into one version."""
    store = TableStore(spark, work_dir(spark, "tables"))
    rows = i.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    for part in range(4):
        store.append(rows.where(F.pmod(F.hash("lang"), F.lit(4)) == part), "documents", version=f"part-{part}")
    store.compact("documents", "doc_id")
    return store.read("documents").select("doc_id", "lang", F.md5("text").alias("content_hash"))


@query
def sink_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second version brings a column that the first one lacks."""
    store = TableStore(spark, work_dir(spark, "tables"))
    rows = i.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    store.append(rows.where("lang <=> 'en'").drop("n_chars"), "documents", version="first")
    store.append(rows.where("NOT lang <=> 'en'"), "documents", version="second")
    return store.read("documents")


@query
def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = TableStore(spark, work_dir(spark, "tables"))
    bronze = bronze_rows(_as_files(i.table(spark, sf_dir, "documents")), i.RUN_TS)
    report = ingest_bronze(store, bronze, IngestSettings(), "first")
    row = [(report.status, report.message, report.rows[BRONZE], report.rows[SILVER], report.rows[GOLD])]
    return spark.createDataFrame(row, "status string, message string, bronze bigint, silver bigint, gold bigint")


@query
def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files, and again after German ones were deleted, French ones replaced, Spanish ones cut and English ones of some sources extended."""
    tables = FileTables(spark, work_dir(spark, "files"), buckets=16)
    for states in (i.file_states(spark, sf_dir), i.file_states(spark, sf_dir, changed=True)):
        listing = states.select("path", "modificationTime", F.octet_length("content").cast("bigint").alias("length"))
        carry_changes(tables, listing, lambda paths, states=states: states.join(paths, F.col("path") == F.col("file_path"), "left_semi"), run_ts=i.RUN_TS)
    return tables.read(CHUNKS).select("file_path", "chunk_pos", "chunk_text")


@query
def nightly_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two nights over the same files: the second finds nothing new and leaves the tables as they are."""
    base = work_dir(spark, "nightly")
    i.export_text_files(spark, sf_dir, f"{base}/raw")
    store = TableStore(spark, f"{base}/tables")
    store.append(i.event_telemetry(spark, sf_dir), TELEMETRY)
    first = nightly(store, f"{base}/raw", run_ts=i.RUN_TS)
    second = nightly(store, f"{base}/raw", run_ts=i.RUN_TS)
    tables = [BRONZE, SILVER, GOLD, INDEX, MART]
    counts = [store.read(t).agg(F.lit(t).alias("table"), F.count("*").alias("rows")) for t in tables]
    held = counts[0]
    for count in counts[1:]:
        held = held.unionByName(count)
    written = [(t, first.rows[t], second.rows[t]) for t in tables]
    return held.join(spark.createDataFrame(written, "table string, first_night bigint, second_night bigint"), "table")


# --- streams ------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = i.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query
def stream_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive newest first, a third of the time after the other, one micro-batch for each; nothing is too late."""
    store = _logged_in_thirds(spark, sf_dir, work_dir(spark, "stream"))
    records = store.read(TELEMETRY)
    return as_doubles(records.drop("run_date")).withColumn("execution_timestamp", F.unix_micros("execution_timestamp"))


def _logged_in_thirds(spark: SparkSession, sf_dir: str, base: str, mart: BucketedTable | None = None) -> TableStore:
    events = i.table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.coalesce(F.min(micros), F.lit(0)), F.coalesce(F.max(micros), F.lit(0))).first()
    third = F.floor((micros - F.lit(low)) * 3 / F.lit(high - low + 1))
    store = TableStore(spark, f"{base}/tables")
    for number in (2, 1, 0):
        events.where(F.coalesce(third, F.lit(0)) == number).write.mode("append").parquet(f"{base}/events")
        arriving = spark.readStream.schema(events.schema).parquet(f"{base}/events")
        log_responses(i.event_responses(arriving), store, f"{base}/checkpoint", mart=mart).awaitTermination()
    return store


@query
def stream_daily_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart kept up with each micro-batch by merging the states of its records into their days."""
    base = work_dir(spark, "stream")
    mart = mart_table(TableStore(spark, f"{base}/tables"))
    _logged_in_thirds(spark, sf_dir, base, mart)
    return as_doubles(mart_of_states(mart.read()))


@query
def stream_closed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode over the logged records: a day comes out when the watermark, one day behind the newest record, has passed its end."""
    base = work_dir(spark, "stream")
    store = TableStore(spark, f"{base}/tables")
    log_responses(i.event_responses(_event_stream(spark, sf_dir)), store, f"{base}/checkpoint").awaitTermination()
    schema = store.read(TELEMETRY).schema
    records = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{store.root}/{TELEMETRY}")
    append_closed_days(records, f"{base}/closed", f"{base}/closed-checkpoint").awaitTermination()
    return as_doubles(spark.read.parquet(f"{base}/closed"))


@query
def stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive up to 90 minutes after their time, every tenth twice: what was accepted, came late, came again or has no time."""
    base = work_dir(spark, "stream")
    store = TableStore(spark, f"{base}/tables")
    number = F.col("event_id")
    copies = F.explode(F.sequence(F.lit(0), F.when(number % 10 == 0, 1).otherwise(0)))
    events = _event_stream(spark, sf_dir).withColumn("copy", copies)
    minutes = (number % 7 * 15 + F.col("copy")).cast("int")
    delays = events.select("event_id", "ts", "value", "event_type", "props", minutes.alias("minutes"))
    responses = i.event_responses(delays, "minutes")
    arrived = F.coalesce("executed_at", F.lit(i.RUN_TS)) + F.make_dt_interval(mins=F.col("minutes"))
    route_responses(responses, store, f"{base}/checkpoint", arrived=arrived).awaitTermination()
    tables = {TELEMETRY: "accepted", LATE_TELEMETRY: "late", REPLAYED_TELEMETRY: "replay", REJECTED_TELEMETRY: "rejected"}
    shape = "request_id string, outcome string, execution_timestamp bigint, completion_tokens bigint"
    found = spark.createDataFrame([], shape)
    for name, outcome in tables.items():
        if (rows := store.read(name)) is not None:
            found = found.unionByName(rows.select("request_id", F.lit(outcome).alias("outcome"), F.unix_micros("execution_timestamp").alias("execution_timestamp"), "completion_tokens"))
    return found


@query
def stream_joined_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as responses and, for all but every fifth, their times, both as streams; a closing pair behind the newest lets the watermarks pass."""
    base = work_dir(spark, "stream")
    events = i.table(spark, sf_dir, "events").where("ts IS NOT NULL")
    responses = i.event_responses(events).withColumnRenamed("executed_at", "answered_at").drop("execution_time_ms")
    times = events.where("event_id % 5 <> 0").select(
        F.col("event_id").cast("string").alias("request_id"),
        (F.col("ts").cast("timestamp") - F.expr("INTERVAL '30' SECOND")).alias("executed_at"),
        F.col("value").alias("execution_time_ms"),
    )
    newest = events.agg(F.coalesce(F.max("ts"), F.lit(i.RUN_TS)).cast("timestamp").alias("newest"))
    for extra in (False, True):
        for side, rows, time in (("responses", responses, "answered_at"), ("times", times, "executed_at")):
            closing = newest.select(F.lit("closing").alias("request_id"), (F.col("newest") + F.expr(f"INTERVAL '{2 if side == 'times' else 1}' DAY")).alias(time))
            (rows.limit(0).unionByName(closing, allowMissingColumns=True) if extra else rows).write.mode("append").parquet(f"{base}/{side}")
        sides = [spark.readStream.schema(rows.schema).parquet(f"{base}/{side}") for side, rows in (("responses", responses), ("times", times))]
        write_files(joined_with_times(*sides), f"{base}/joined", f"{base}/checkpoint").awaitTermination()
    joined = spark.read.parquet(f"{base}/joined").where("request_id <> 'closing'")
    return as_doubles(joined).withColumn("execution_timestamp", F.unix_micros("execution_timestamp"))


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files ingested as a stream; a second run over the same folder adds nothing."""
    base = work_dir(spark, "stream")
    i.export_text_files(spark, sf_dir, f"{base}/raw")
    store = TableStore(spark, f"{base}/tables")
    for _ in range(2):
        ingest_new_files(store, f"{base}/raw", f"{base}/checkpoint", run_ts=i.RUN_TS).awaitTermination()
    return store.read(SILVER).select("chunk_pos", "chunk_text")
