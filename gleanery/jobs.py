"""Entry points for spark-submit: ``python -m gleanery.jobs nightly --root <folder> [path]``.

``nightly`` runs the whole chain, ``ingest-new`` takes new files only, as a stream; ``ingest-changed`` brings chunks, vectors and index to the present state of the
files; ``ingest-documents`` upserts documents and ``answer`` answers requests, both from JSON lines.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from gleanery.plans.document_index import ingest_documents, publish_answers
from gleanery.plans.file_changes import FileTables, ingest_changed_files
from gleanery.plans.medallion import RunReport, nightly
from gleanery.session import build_session
from gleanery.sinks.tables import TableStore
from gleanery.sources.documents import read_documents
from gleanery.streaming.ingest import ingest_new_files

DEFAULT_SOURCE = "raw_docs"


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gleanery.jobs", description=__doc__)
    parser.add_argument("job", choices=["nightly", "ingest-new", "ingest-changed", "ingest-documents", "answer"], help="what to run")
    parser.add_argument("path", nargs="?", default=DEFAULT_SOURCE, help="folder of raw .txt files, or of JSON lines")
    parser.add_argument("--root", required=True, help="folder of the published tables")
    parser.add_argument("--format", default="parquet", help="table format")
    return parser.parse_intermixed_args(arguments)


def run(store: TableStore, job: str, path: str) -> RunReport | None:
    """Run a job to its end. ``ingest-new`` has no report."""
    if job == "nightly":
        return nightly(store, path)
    if job == "ingest-changed":
        return ingest_changed_files(FileTables(store.spark, f"{store.root}/files"), path)
    if job == "ingest-documents":
        return ingest_documents(store, read_documents(store.spark, path))
    if job == "answer":
        return publish_answers(store, store.spark.read.schema("request_id STRING, query STRING").json(path))
    ingest_new_files(store, path, f"{store.root}/_ingest_checkpoint").awaitTermination()
    return None


def main(arguments: Sequence[str] | None = None) -> None:
    options = parse(arguments)
    report = run(TableStore(build_session("gleanery"), options.root, options.format), options.job, options.path)
    if report:
        print(report.status, dict(report.rows))


if __name__ == "__main__":
    main()
