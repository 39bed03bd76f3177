"""A searchable table of documents handed over as records."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators.embedding import EmbedderFactory, embed_or_fault
from gleanery.operators.quality import index_suite, response_suite
from gleanery.operators.requests import reject_requests
from gleanery.operators.search import DEFAULT_LIMITS, Searcher, SearchLimits, knn
from gleanery.plans.medallion import IngestSettings, RunReport
from gleanery.plans.question_answering import DOCS_PER_QUERY, answer_requests
from gleanery.session import materialize, spread_small
from gleanery.sinks.buckets import BUCKETS, UPSERT, BucketedTable
from gleanery.sinks.tables import TableStore, latest_per_key
from gleanery.sources.documents import accept_documents, reject_documents

DOCUMENT_VECTORS = "document_vectors"
REJECTED_DOCUMENTS = "rejected_documents"
RESPONSES = "responses"
REJECTED_REQUESTS = "rejected_requests"
POINTS = "doc_id string, payload struct<content:string,category:string>, embedding_vector array<float>"


def document_points(documents: DataFrame, run_ts: datetime, factory: EmbedderFactory | None = None) -> DataFrame:
    """doc_id, payload, content_hash, written_at, embedding_vector, refused of documents(id, content, category); ``refused`` is why the
    embedder gave no vector.

    Copies of an id are reduced to one row before any of them is embedded.
    """
    accepted = accept_documents(documents).select(
        F.col("id").alias("doc_id"),
        F.struct("content", "category").alias("payload"),
        F.md5(F.concat_ws("|", "category", "content")).alias("content_hash"),
        F.lit(run_ts).cast("timestamp").alias("written_at"),
    )
    single = spread_small(latest_per_key(accepted, "doc_id", "written_at"), "doc_id")
    return embed_or_fault(single, "payload.content", "embedding_vector", "refused", factory)


def document_table(store: TableStore, buckets: int = BUCKETS) -> BucketedTable:
    """The points of all documents by id, in folders of key hashes. ``buckets`` is set once for a store."""
    schema = f"{POINTS}, content_hash string, written_at timestamp"
    return BucketedTable(store.spark, f"{store.root}/{DOCUMENT_VECTORS}", T.StructType.fromDDL(schema), "doc_id", buckets=buckets)


def ingest_documents(
    store: TableStore,
    documents: DataFrame,
    settings: IngestSettings = IngestSettings(),
    run_ts: datetime | None = None,
    version: str | None = None,
    buckets: int = BUCKETS,
) -> RunReport:
    """Embed documents and upsert them by id; rows without content, and those that the embedder refuses, are set aside with the reason.

    Only the folders that the ids fall into are rewritten. A call that is repeated under the same ``version`` name ends in the same
    points and sets nothing aside twice.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    points = materialize(document_points(documents, run_ts, settings.embedder), "points")
    sound = points.where("refused IS NULL").drop("refused").withColumn("change", F.lit(UPSERT))
    written = document_table(store, buckets).apply(sound, index_suite(settings.dim, "doc_id"), ["written_at"], written=True)
    refused = points.where("refused IS NOT NULL").select(F.col("doc_id").alias("id"), "payload.content", "payload.category", F.col("refused").alias("reason"))
    rejects = reject_documents(documents.select("id", "content", "category")).unionByName(refused)
    rejected = store.append(rejects, REJECTED_DOCUMENTS, version)
    return RunReport(rows={DOCUMENT_VECTORS: written[UPSERT], REJECTED_DOCUMENTS: rejected})


def answer_from_index(
    store: TableStore,
    requests: DataFrame,
    settings: IngestSettings = IngestSettings(),
    k: int = DOCS_PER_QUERY,
    limits: SearchLimits = DEFAULT_LIMITS,
    search: Searcher = knn,
) -> DataFrame:
    """``answer_requests`` over the stored vectors; the corpus is not embedded again. Without an index, or with one of
    another dimension, every request carries that as its error."""
    table, fault = document_table(store), None
    points = table.read()
    if not table.exists():
        fault = "the document index does not exist"
    else:
        # A change is taken over only if all its vectors are of one length.
        held = points.select(F.size("embedding_vector").alias("dim")).first()
        if held and held["dim"] != settings.dim:
            fault = f"the document index has {held['dim']} dimensions, not {settings.dim}"
    documents = points.select(F.col("doc_id").alias("id"), "payload.content", "payload.category")
    vectors = points.select(F.col("doc_id").alias("id"), F.col("embedding_vector").alias("vector"))
    return answer_requests(requests, documents, vectors, settings.embedder, k, settings.dim, limits, fault, search)


def publish_answers(store: TableStore, requests: DataFrame, settings: IngestSettings = IngestSettings(), version: str | None = None, search: Searcher = knn) -> RunReport:
    """Answer requests(request_id, query) from the index and publish the responses, if all of them keep the response contract; requests without
    a character are set aside with the reason. A call that is repeated under the same ``version`` name adds nothing."""
    answers = answer_from_index(store, requests, settings, search=search)
    report = RunReport()
    report.rows[RESPONSES] = store.append(answers, RESPONSES, version, response_suite())
    report.rows[REJECTED_REQUESTS] = store.append(reject_requests(requests), REJECTED_REQUESTS, version)
    return report
