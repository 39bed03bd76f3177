"""The registered queries as SQL over the driver's tables, built from named parts."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Blank characters as str.split() sees them.
_WORD = r"[^\s\p{Z}\x0b\x1c-\x1f\x85]+"

_REQUESTS = """SELECT conv_id || '-' || turn AS request_id, text AS query FROM conversations
    UNION ALL SELECT conv_id || '-' || turn || '-blank', ' ' FROM conversations WHERE role = 'system'
    UNION ALL SELECT conv_id || '-' || turn || '-empty', '' FROM conversations WHERE role = 'assistant'"""
_DISTINCT_QUESTIONS = "SELECT DISTINCT text AS id, text FROM conversations"
_DOCUMENT_TEXTS = "SELECT doc_id::VARCHAR AS id, text FROM documents"


def _chunks(table: str = "documents", text: str = "text", size: int = 500, step: int = 450) -> str:
    return f"""SELECT *, substring({text}, (chunk_pos * {step} + 1)::BIGINT, {size}) AS chunk_text
    FROM (SELECT *, unnest(range(0, (length({text}) + {step - 1}) // {step})) AS chunk_pos FROM {table})"""


_CHUNK_IDS = f"""SELECT md5(concat_ws('|', source || '/' || doc_id, chunk_pos, md5(chunk_text))) AS chunk_id,
    source || '/' || doc_id AS file_path, chunk_pos::INT AS chunk_pos, chunk_text FROM ({_chunks()})"""
_CHUNK_TEXTS = f"SELECT chunk_id AS id, chunk_text AS text FROM ({_CHUNK_IDS})"


def _cells(texts: str) -> str:
    """(id, bucket, weight) of the hashed vectors of (id, text)."""
    return f"""SELECT id, bucket, sum(sign)::INT AS weight FROM (
        SELECT id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 384 AS bucket,
            CASE WHEN ('0x' || substr(md5(w), 9, 2))::BIGINT < 128 THEN 1 ELSE -1 END AS sign
        FROM (SELECT id, unnest(regexp_extract_all(lower(text), '{_WORD}')) AS w FROM ({texts})))
    GROUP BY id, bucket HAVING sum(sign) != 0"""


def _hashed_hits(texts: str, k: int) -> str:
    """WITH parts that end in hits(query, id, score, rank) for the distinct questions."""
    return f"""q AS MATERIALIZED ({_cells(_DISTINCT_QUESTIONS)}), c AS MATERIALIZED ({_cells(texts)}),
    qn AS (SELECT id, sqrt(sum(weight * weight)::DOUBLE) AS n FROM q GROUP BY id),
    cn AS (SELECT id, sqrt(sum(weight * weight)::DOUBLE) AS n FROM c GROUP BY id),
    dots AS (SELECT q.id AS qid, c.id AS cid, sum(q.weight * c.weight)::DOUBLE AS dot
        FROM q JOIN c ON q.bucket = c.bucket GROUP BY ALL),
    scored AS (SELECT qid AS query, cid AS id, dot / (qn.n * cn.n) AS score
        FROM dots JOIN qn ON qn.id = qid JOIN cn ON cn.id = cid),
    hits AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank
        FROM scored) WHERE rank <= {k})"""


_VECTOR_HITS = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
    SELECT a.vec_id AS query_id, b.vec_id AS id,
        list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score
    FROM embeddings a, embeddings b)) WHERE rank <= 2"""

# --- sources, chunks, vectors

ORACLES["bronze_projection"] = """SELECT source || '/' || doc_id AS file_path, text AS raw_text, true AS is_valid_utf8,
    md5(text) AS content_hash FROM documents"""
ORACLES["bronze_scan"] = "SELECT lang, source, text || chr(10) AS raw_text, true AS is_valid_utf8 FROM documents"
ORACLES["documents_source"] = """SELECT CASE WHEN lang = 'de' THEN 'doc_' || md5(text) ELSE doc_id::VARCHAR END AS id,
    text AS content, CASE WHEN lang = 'en' THEN 'general' ELSE lang END AS category FROM documents WHERE lang != 'fr'"""
ORACLES["documents_rejects"] = """SELECT doc_id::VARCHAR AS id, lang AS category, 'content is missing' AS reason
    FROM documents WHERE lang = 'fr'"""
ORACLES["chunk_sliding_window"] = f"SELECT doc_id, chunk_pos::INT AS chunk_pos, chunk_text FROM ({_chunks()})"
ORACLES["chunk_custom_window"] = (
    f"SELECT doc_id, chunk_pos::INT AS chunk_pos, chunk_text FROM ({_chunks(size=200, step=80)})"
)
ORACLES["chunk_ids"] = f"SELECT chunk_id, file_path, chunk_pos FROM ({_CHUNK_IDS})"
ORACLES["embed_hashing"] = f"""SELECT id AS doc_id, bucket::INT AS bucket, weight
    FROM ({_cells("SELECT doc_id AS id, text FROM documents")})"""
ORACLES["vector_to_strings"] = """SELECT vec_id, (generate_subscripts(embedding, 1) - 1)::INT AS pos,
    unnest(embedding)::DOUBLE AS value FROM embeddings"""

# --- search and answers

ORACLES["cosine_pairs"] = """SELECT a.vec_id,
    round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
ORACLES["knn_top2"] = f"SELECT query_id, id, round(score, 4) AS score, rank::INT AS rank FROM ({_VECTOR_HITS})"
ORACLES["knn_top2_blocks"] = ORACLES["knn_top2"]
ORACLES["knn_top3_chunks"] = f"""WITH chunks AS ({_CHUNK_IDS}), {_hashed_hits("SELECT chunk_id AS id, chunk_text AS text FROM chunks", 3)}
SELECT md5(query) AS query_id, rank::INT AS rank, chunk_id, file_path, chunk_text, round(score, 4) AS score
FROM hits JOIN chunks ON chunk_id = id"""
ORACLES["retrieved_documents"] = f"""SELECT query_id, rank::INT AS rank, id::VARCHAR AS id, text AS content,
    lang AS category, round(score, 4) AS score FROM ({_VECTOR_HITS}) LEFT JOIN documents ON doc_id = id"""
ORACLES["analyst_summary"] = f"""SELECT query_id, 'Analysis for ''vector ' || query_id || ''': Evaluated ' || count(*)
    || ' document(s). Key Insights: ' || coalesce(string_agg(text, ' | ' ORDER BY rank), '') AS analysis_output
    FROM ({_VECTOR_HITS}) LEFT JOIN documents ON doc_id = id GROUP BY query_id"""
ORACLES["rag_answer"] = f"""WITH chunks AS ({_CHUNK_IDS}), {_hashed_hits("SELECT chunk_id AS id, chunk_text AS text FROM chunks", 3)},
    found AS (SELECT query, count(*) AS n, string_agg(chunk_text, chr(10) || '---' || chr(10) ORDER BY rank) AS context,
        list_sort(list_distinct(list(file_path))) AS sources
        FROM hits JOIN chunks ON chunk_id = id GROUP BY query)
SELECT request_id, coalesce(n, 0)::INT AS chunk_count, coalesce(array_to_string(sources, ','), '') AS source_documents,
    CASE WHEN n IS NULL THEN 'I could not find relevant documentation to answer your request.'
    ELSE 'Based on enterprise documentation:' || chr(10) || substring(context, 1, 300) || '...' || chr(10) || chr(10)
        || '[Sources: ' || array_to_string(sources, ', ') || ']' END AS final_answer
FROM ({_REQUESTS}) r LEFT JOIN found USING (query) WHERE r.query != ''"""
ORACLES["query_validation"] = f"""SELECT request_id, length(query)::INT AS n_chars,
    CASE WHEN query = '' THEN 'query must have at least 1 character' END AS reason FROM ({_REQUESTS})"""

_RESPONSES = f"""{_hashed_hits(_DOCUMENT_TEXTS, 2)},
    found AS (SELECT query, count(*) AS n, string_agg(id, ',' ORDER BY rank) AS doc_ids,
        string_agg(lang, ',' ORDER BY rank) AS categories, round(max(score), 4) AS best_score,
        string_agg(text, ' | ' ORDER BY rank) AS insights
        FROM hits JOIN documents ON doc_id::VARCHAR = id GROUP BY query),
    responses AS (SELECT request_id, query,
        CASE WHEN trim(query) = '' THEN 'retrieval_failed' ELSE 'retrieval_completed' END AS retrieval_step,
        'analyst_completed' AS current_step, coalesce(n, 0) AS n, coalesce(doc_ids, '') AS doc_ids,
        coalesce(categories, '') AS categories, best_score,
        CASE WHEN n IS NULL THEN 'No relevant documents found to perform analysis.'
            ELSE 'Analysis for ''' || query || ''': Evaluated ' || n || ' document(s). Key Insights: ' || insights
            END AS analysis_output,
        CASE WHEN trim(query) = '' THEN 'Empty query provided to Retrieval Agent.' END AS error
        FROM ({_REQUESTS}) LEFT JOIN found USING (query) WHERE query != '')"""
ORACLES["batch_query"] = f"WITH {_RESPONSES} SELECT * EXCLUDE (n) FROM responses"

# --- telemetry and mart


def _tokens(text: str) -> str:
    return f"(len(regexp_extract_all({text}, '{_WORD}')) * 4)::BIGINT"


_EXCHANGES = """SELECT u.conv_id || '-' || u.turn AS request_id, u.text AS query, a.text AS analysis_output
    FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user'"""
_TOKENS = f"""SELECT request_id, {_tokens("query")} AS prompt_tokens,
    {_tokens("coalesce(analysis_output, 'None')")} AS completion_tokens FROM ({_EXCHANGES})"""
_COST = "round(prompt_tokens * 0.000005::DECIMAL(12,6) + completion_tokens * 0.000015::DECIMAL(12,6), 6)::DECIMAL(18,6)"
ORACLES["token_estimate"] = f"SELECT *, prompt_tokens + completion_tokens AS total_tokens FROM ({_TOKENS})"
ORACLES["cost_estimate"] = f"SELECT request_id, ({_COST})::DOUBLE AS total_cost_usd FROM ({_TOKENS})"
ORACLES["latency_from_times"] = """SELECT event_id, round(round(value * 1000)::BIGINT / 1000, 2)::DOUBLE AS execution_time_ms
    FROM events"""

# The event that a turn takes its times from.
_EVENT_OF = """event_id = (split_part(request_id, '-', 1)::BIGINT * 7919 + split_part(request_id, '-', 2)::BIGINT * 104729)
    % (SELECT count(*) FROM events)"""
_ANSWER_TELEMETRY = f"""{_RESPONSES}, telemetry AS (SELECT *, prompt_tokens + completion_tokens AS total_tokens, {_COST} AS total_cost_usd
    FROM (SELECT request_id, ts AS execution_timestamp, query AS user_query, value AS execution_time_ms,
        n::INT AS retrieved_docs_count, {_tokens("query")} AS prompt_tokens, {_tokens("analysis_output")} AS completion_tokens,
        CASE WHEN error IS NULL THEN 200 ELSE 500 END AS status_code, error AS error_message,
        best_score AS vector_similarity_score
        FROM responses LEFT JOIN events ON {_EVENT_OF}))"""
_MART = """, flagged AS (SELECT CAST(execution_timestamp AS DATE) AS run_date, status_code IS DISTINCT FROM 200 AND status_code IS NOT NULL AS failed, * FROM telemetry)
SELECT run_date, count(request_id) AS total_agent_queries, count(*) FILTER (failed) AS error_count,
    round(100.0 * count(*) FILTER (failed) / nullif(count(request_id), 0), 2)::DOUBLE AS error_rate_percentage,
    round(max(execution_time_ms), 2) AS max_latency_ms, ((2 * sum(round(execution_time_ms * 10000)::BIGINT) + 100 * count(execution_time_ms)) // nullif(200 * count(execution_time_ms), 0))::DOUBLE
        / 100 AS avg_latency_ms,
    CAST(floor((2 * sum(round(vector_similarity_score * 10000)::BIGINT) + count(vector_similarity_score))::DOUBLE
        / nullif(2 * count(vector_similarity_score), 0)) AS DOUBLE) / 10000 AS avg_cosine_similarity, round(sum(total_cost_usd), 4)::DOUBLE AS total_spend_usd,
    sum(completion_tokens)::BIGINT AS total_completion_tokens, sum(prompt_tokens)::BIGINT AS total_prompt_tokens,
    sum(completion_tokens + prompt_tokens)::BIGINT AS grand_total_tokens
    FROM flagged GROUP BY ALL"""
ORACLES["telemetry_derive"] = f"""WITH {_ANSWER_TELEMETRY}
SELECT * REPLACE (epoch_us(execution_timestamp) AS execution_timestamp, total_cost_usd::DOUBLE AS total_cost_usd) FROM telemetry"""
ORACLES["mart_from_answers"] = f"WITH {_ANSWER_TELEMETRY} {_MART}"
_EVENT_TELEMETRY = """SELECT event_id AS request_id, ts AS execution_timestamp, value AS execution_time_ms,
    k / 100 AS vector_similarity_score, k AS prompt_tokens, k * 2 AS completion_tokens,
    (k * 0.000035::DECIMAL(12,6))::DECIMAL(18,6) AS total_cost_usd,
    CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code
    FROM (SELECT *, (props::JSON ->> '$.k')::BIGINT AS k FROM events)"""
ORACLES["mart_agent_runs"] = f"WITH telemetry AS ({_EVENT_TELEMETRY}) {_MART}"

ORACLES["mart_from_log"] = f"""WITH telemetry AS (SELECT *, {_COST} AS total_cost_usd FROM (
    SELECT request_id, ts AS execution_timestamp, value AS execution_time_ms, NULL::DOUBLE AS vector_similarity_score,
    prompt_tokens, completion_tokens, 200 AS status_code
    FROM ({_TOKENS}) JOIN events ON {_EVENT_OF})) {_MART}"""

# --- quality


def _check(suite: str, check: str, column: str, broken: str, table: str) -> str:
    return f"""SELECT '{suite}' AS suite, '{check}' AS "check", '{column}' AS "column",
    count(CASE WHEN {broken} THEN 1 END) AS failed, count(*) AS total, count(CASE WHEN {broken} THEN 1 END) = 0 AS passed
    FROM ({table})"""


def _unique(suite: str, column: str, table: str) -> str:
    return f"""SELECT '{suite}' AS suite, 'unique' AS "check", '{column}' AS "column",
    coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS failed, coalesce(sum(n), 0)::BIGINT AS total, failed = 0 AS passed
    FROM (SELECT {column}, count(*) AS n FROM ({table}) WHERE {column} IS NOT NULL GROUP BY {column})"""


def _union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def _silver_checks(size: int) -> str:
    return _union(
        _check("silver", "not_null", "chunk_text", "chunk_text IS NULL", _CHUNK_IDS),
        _check("silver", "not_null", "file_path", "file_path IS NULL", _CHUNK_IDS),
        _check("silver", "not_empty", "chunk_text", "length(chunk_text) = 0", _CHUNK_IDS),
        _check("silver", "max_length", "chunk_text", f"length(chunk_text) > {size}", _CHUNK_IDS),
        _unique("silver", "chunk_id", _CHUNK_IDS),
    )


_BRONZE = "SELECT source || '/' || doc_id AS file_path, text AS raw_text FROM documents"
_EVENT_MART = f"WITH telemetry AS ({_EVENT_TELEMETRY}) {_MART}"
ORACLES["dq_silver"] = _silver_checks(500)
ORACLES["dq_gold"] = _union(
    _check("gold", "not_null", "embedding_vector", "embedding IS NULL", "FROM embeddings"),
    _check("gold", "not_null", "chunk_id", "vec_id IS NULL", "FROM embeddings"),
    _check("gold", "dimension", "embedding_vector", "len(embedding) != 64", "FROM embeddings"),
    _check(
        "gold", "finite", "embedding_vector",
        "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0", "FROM embeddings",
    ),
)
ORACLES["dq_mart"] = _union(
    *(_check("mart", "not_null", c, f"{c} IS NULL", _EVENT_MART) for c in ("run_date", "total_agent_queries", "total_spend_usd")),
    _unique("mart", "run_date", _EVENT_MART),
)
_ANSWERED = f"SELECT * FROM ({_REQUESTS}) WHERE query != ''"
ORACLES["dq_responses"] = _union(
    _check("response", "not_null", "query", "query IS NULL", _ANSWERED),
    _check("response", "not_null", "current_step", "false", _ANSWERED),
    _check("response", "not_null", "retrieved_docs", "false", _ANSWERED),
    _check("response", "complete", "retrieved_docs", "false", _ANSWERED),
    _unique("response", "request_id", _ANSWERED),
)
ORACLES["dq_unique"] = f"""SELECT "check", "column", failed, total FROM ({_unique("-", "text", "FROM documents")})"""
ORACLES["dq_unique_new"] = """WITH new AS (SELECT doc_id + 1 AS doc_id FROM documents WHERE lang = 'es')
SELECT doc_id, count(*) AS new_rows, any_value(held) AS published_rows FROM new JOIN
    (SELECT doc_id, count(*) AS held FROM documents WHERE lang IS DISTINCT FROM 'es' GROUP BY doc_id) USING (doc_id) GROUP BY doc_id"""
ORACLES["dq_report"] = _union(
    _check("bronze", "not_null", "file_path", "file_path IS NULL", _BRONZE),
    _check("bronze", "not_null", "raw_text", "raw_text IS NULL", _BRONZE),
    _unique("bronze", "raw_text", _BRONZE),
    "SELECT 'bronze', 'schema', '*', 0, 3, true",
    _silver_checks(400),
)

# --- table upkeep

ORACLES["vector_upsert"] = """WITH winners AS (
    SELECT doc_id, written, label, embedding FROM (SELECT *, vec_id + label AS doc_id, vec_id AS written,
        row_number() OVER (PARTITION BY vec_id + label ORDER BY vec_id DESC) AS place FROM embeddings) WHERE place = 1)
SELECT doc_id, written, label AS category, embedding[1]::DOUBLE AS first_value FROM winners
UNION ALL
SELECT vec_id, -1, label, embedding[1]::DOUBLE FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM winners)"""
# The second hand-over: German ids come from the content, French content is missing.
_SECOND = """SELECT CASE WHEN lang = 'de' THEN 'doc_' || md5(text || ' (revised)') ELSE doc_id::VARCHAR END AS doc_id,
    CASE WHEN lang = 'en' THEN 'general' ELSE lang END AS category, md5(text || ' (revised)') AS content_hash
    FROM documents WHERE lang != 'fr'"""
ORACLES["document_index"] = f"""WITH second AS (SELECT DISTINCT * FROM ({_SECOND}))
SELECT doc_id, category, content_hash, 384 AS dim FROM second
UNION ALL SELECT doc_id::VARCHAR, lang, md5(text), 384 FROM documents WHERE doc_id::VARCHAR NOT IN (SELECT doc_id FROM second)"""
ORACLES["index_sync_delta"] = """SELECT doc_id, lang, md5(text) AS content_hash FROM documents WHERE lang IN ('de', 'fr')"""
ORACLES["compaction"] = "SELECT doc_id, lang, md5(text) AS content_hash FROM documents"
ORACLES["sink_schema_evolution"] = """SELECT doc_id, lang, CASE WHEN lang IS DISTINCT FROM 'en' THEN n_chars END AS n_chars FROM documents"""
ORACLES["ingest_metrics"] = f"""WITH c AS (SELECT count(*) AS n FROM ({_chunks()})), d AS (SELECT count(*) AS n FROM documents)
SELECT 'success' AS status, 'Ingested ' || d.n || ' documents as ' || c.n || ' vectors.' AS message,
    d.n AS bronze, c.n AS silver, c.n AS gold FROM c, d"""

_CHANGED = """(SELECT source || '/' || doc_id AS file_path, CASE WHEN lang = 'fr' THEN reverse(text)
    WHEN lang = 'es' THEN substring(text, 1, ceil(length(text) / 2)::BIGINT)
    WHEN lang = 'en' AND length(text) % 2 = 0 THEN text || ' ' || text ELSE text END AS text
    FROM documents WHERE lang IS DISTINCT FROM 'de')"""
ORACLES["changed_files"] = f"SELECT file_path, chunk_pos::INT AS chunk_pos, chunk_text FROM ({_chunks(_CHANGED)})"

# Exported files end in a line feed.
_FILES = "(SELECT text || chr(10) AS text FROM documents)"
ORACLES["nightly_run"] = f"""WITH c AS (SELECT count(*) AS n FROM ({_chunks(_FILES)})),
    m AS (SELECT count(DISTINCT ts::DATE) AS n FROM events)
SELECT 'bronze_raw_documents' AS "table", count(*) AS "rows", count(*) AS first_night, 0 AS second_night FROM documents
UNION ALL SELECT 'silver_cleaned_chunks', n, n, 0 FROM c
UNION ALL SELECT 'gold_vector_embeddings', n, n, 0 FROM c
UNION ALL SELECT 'vector_index', n, n, 0 FROM c
UNION ALL SELECT 'fct_agent_runs', n, n, n FROM m"""

# --- streams

_STREAMED = f"""SELECT *, prompt_tokens + completion_tokens AS total_tokens, {_COST} AS total_cost_usd FROM (
    SELECT event_id::VARCHAR AS request_id, ts AS execution_timestamp, event_type AS user_query, value AS execution_time_ms,
    0 AS retrieved_docs_count, {_tokens("event_type")} AS prompt_tokens,
    {_tokens("CASE WHEN event_type = 'error' THEN 'None' ELSE props END")} AS completion_tokens,
    CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code,
    CASE WHEN event_type = 'error' THEN 'event reported an error' END AS error_message,
    NULL::DOUBLE AS vector_similarity_score FROM events)"""
ORACLES["stream_telemetry"] = f"""SELECT * REPLACE (epoch_us(execution_timestamp) AS execution_timestamp,
    total_cost_usd::DOUBLE AS total_cost_usd) FROM ({_STREAMED})"""
ORACLES["stream_daily_mart"] = f"WITH telemetry AS ({_STREAMED}) {_MART}"
ORACLES["stream_closed_days"] = f"""SELECT * FROM (WITH telemetry AS ({_STREAMED}) {_MART})
    WHERE run_date + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)"""
_ARRIVING = f"""SELECT t.*, copy, t.request_id::BIGINT % 7 * 15 + copy AS minutes FROM ({_STREAMED}) t, (VALUES (0), (1)) copies(copy)
    WHERE copy = 0 OR t.request_id::BIGINT % 10 = 0"""
ORACLES["stream_outcomes"] = f"""SELECT request_id, CASE WHEN execution_timestamp IS NULL THEN 'rejected' WHEN minutes > 60 THEN 'late'
    WHEN copy = 1 THEN 'replay' ELSE 'accepted' END AS outcome, epoch_us(execution_timestamp) AS execution_timestamp, completion_tokens FROM ({_ARRIVING})"""
ORACLES["stream_joined_times"] = f"""SELECT * EXCLUDE (matched) REPLACE (CASE WHEN matched THEN epoch_us(execution_timestamp) - 30000000 END AS execution_timestamp,
    CASE WHEN matched THEN execution_time_ms END AS execution_time_ms, total_cost_usd::DOUBLE AS total_cost_usd)
    FROM (SELECT *, request_id::BIGINT % 5 <> 0 AS matched FROM ({_STREAMED}) WHERE execution_timestamp IS NOT NULL)"""
ORACLES["stream_ingest"] = f"SELECT chunk_pos::INT AS chunk_pos, chunk_text FROM ({_chunks(_FILES)})"
