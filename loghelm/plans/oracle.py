"""The same queries in DuckDB SQL, written from the rules and not from the
Spark code: plain windows, joins and percentiles over the whole tables. Only the
free wording of the reports is taken from there; phrases, severities and pattern
ids are stated here once more."""

from __future__ import annotations

from loghelm.operators.incidents import (
    DEFAULT_ACTIONS,
    DEFAULT_EXPLANATION,
    OTHER_ACTIONS,
    OTHER_EXPLANATION,
    RULES,
)
from loghelm.plans.log_view import VIEW_AXES, VIEW_DIM, VIEW_OFFSET, VIEW_TREES

HDFS = r"^(\d{6})\s+(\d{6})\s+(\d+)\s+([A-Z]+)\s+([\w.$]+):\s+(.*)$"
STANDARD = r"^(\d{4}-\d{2}-\d{2}[T\s]\d{2}:\d{2}:\d{2}(?:\.\d+)?Z?)\s+\[([A-Z]+)\]\s+\[([\w.\-]+)\]:\s+(.*)$"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sanitize(text: str) -> str:
    out = text
    for pattern, mark in (
        (r"blk_[-0-9]+", "<BLOCK>"),
        (r"/(?:\d{1,3}\.){3}\d{1,3}(?::\d+)?", "<IP>"),
        (r"0x[0-9a-fA-F]+", "<HEX>"),
        (r"\b\d+\b", "<NUM>"),
        (r"^\s+|\s+$", ""),
    ):
        out = f"regexp_replace({out}, '{pattern}', '{mark}', 'g')"
    return out


def parsed(source: str, keep: str, ingest: str) -> str:
    """Parsing of (`value`, ...) rows as two query steps."""
    return f"""
    SELECT *, CASE WHEN regexp_matches(raw_text, '{HDFS}') THEN 'hdfs'
        WHEN regexp_matches(raw_text, '{STANDARD}') THEN 'standard' ELSE 'raw' END AS format
    FROM (SELECT {keep}, regexp_replace(value, '^\\s+|\\s+$', '', 'g') AS raw_text, {ingest} AS ingest FROM {source})
    """


def fields(source: str) -> str:
    def pick(h: int, s: int, other: str) -> str:
        return (
            f"CASE format WHEN 'hdfs' THEN regexp_extract(raw_text, '{HDFS}', {h}) "
            f"WHEN 'standard' THEN regexp_extract(raw_text, '{STANDARD}', {s}) ELSE {other} END"
        )

    iso = "'%Y-%m-%dT%H:%M:%S+00:00'"
    micros = "strftime(ingest, '%Y-%m-%dT%H:%M:%S.%f+00:00')"
    hdfs_ts = (
        f"strftime(try_strptime('20' || regexp_extract(raw_text, '{HDFS}', 1) || "
        f"regexp_extract(raw_text, '{HDFS}', 2), '%Y%m%d%H%M%S'), {iso})"
    )
    return f"""
    SELECT *, {sanitize('message')} AS template, nullif(regexp_extract(message, 'blk_[-0-9]+'), '') AS block_id
    FROM (SELECT *,
        CASE format WHEN 'hdfs' THEN coalesce({hdfs_ts}, {micros})
            WHEN 'standard' THEN regexp_extract(raw_text, '{STANDARD}', 1) ELSE {micros} END AS "timestamp",
        {pick(4, 2, "'INFO'")} AS level, {pick(5, 3, "'unknown'")} AS source, {pick(6, 4, "raw_text")} AS message
        FROM {source})
    """


LOG = """log AS (
    SELECT event_id AS line_no, ts, 'host-' || (user_id % 20) AS stream, CASE event_type
    WHEN 'view' THEN strftime(ts, '%y%m%d %H%M%S') || ' ' || (user_id + 1) ||
        ' INFO dfs.FSNamesystem: BLOCK* NameSystem.allocateBlock: /user/part-' || k || ' blk_' || (user_id * 7919)
    WHEN 'click' THEN strftime(ts, '%y%m%d %H%M%S') || ' ' || (user_id + 1) ||
        ' INFO dfs.DataNode$DataXceiver: Receiving block blk_' || (user_id * 7919) || ' src: /10.250.' ||
        (user_id % 256) || '.' || (event_id % 256) || ':' || (event_id % 9000 + 50010) || ' dest: /10.251.' ||
        (user_id % 200) || '.' || k || ':50010'
    WHEN 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || ' [ERROR] [svc-' || (user_id % 7) || ']: ' ||
        CASE cents % 5 WHEN 0 THEN 'java.lang.OutOfMemoryError: Java heap space allocating ' || cents || ' bytes'
        WHEN 1 THEN 'HikariPool-1 - no connection, request timed out after ' || cents || ' ms'
        WHEN 2 THEN 'java.lang.NullPointerException in handler status=500 item ' || k
        WHEN 3 THEN 'Deadlock found when trying to get lock, attempt ' || k
        ELSE 'Upstream connection timeout after ' || cents || ' ms' END
    WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || ' [INFO] [svc-' || (user_id % 7) ||
        ']: Payment processed order ' || event_id || ' status=200 duration=' || k || 'ms'
    ELSE 'session 0x' || format('{:x}', event_id) || ' user ' || user_id || ' signed up from 10.0.' ||
        (user_id % 256) || '.' || k || ' in ' || k || 'ms' END AS value
    FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents, regexp_extract(props, '([0-9]+)', 1) AS k FROM events)
)"""
PARSED = f"""{LOG},
shaped AS ({parsed('log', 'line_no, ts, stream', 'ts')}),
lines AS (SELECT *, line_no AS pos, 'log_' || lpad(line_no::VARCHAR, 7, '0') AS log_id FROM ({fields('shaped')}))"""

LABELS = """audited AS (
    SELECT 'blk_' || (user_id * 7919) AS block_id, event_id,
        CASE WHEN value >= 120 THEN 'Anomaly' WHEN value >= 50 THEN 'Normal' ELSE 'Unverified' END AS label
    FROM events WHERE event_type = 'purchase' AND value >= 40),
labels_of AS (
    SELECT block_id, label FROM audited QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY event_id DESC) = 1),
labelled AS (
    SELECT l.*, coalesce(b.label, 'Unknown') AS label_text,
        CASE b.label WHEN 'Anomaly' THEN 1 WHEN 'Normal' THEN 0 ELSE -1 END AS label
    FROM lines l LEFT JOIN labels_of b USING (block_id))"""

DOC_LINES = """doc_lines AS (
    SELECT *, row_number() OVER (PARTITION BY file ORDER BY line_no) - 1 AS pos FROM (
        SELECT doc_id AS file, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line_no,
            unnest(string_split(text, chr(10))) AS value FROM documents)
    WHERE regexp_matches(value, '\\S'))"""


def _bin(dim: int) -> str:
    word = lambda i: f"('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT"
    out = f"{word(0)} % {dim}"
    for i in (1, 2, 3):
        out = f"(({out}) * 4294967296 + {word(i)}) % {dim}"
    return out


VECTORS = f"""counts AS (SELECT template, min(format) AS format, count(*)::BIGINT AS n FROM lines GROUP BY template),
hits AS (
    SELECT template, {_bin(VIEW_DIM)} AS bin,
        CASE WHEN ('0x' || substr(h, 32, 1))::BIGINT % 2 = 1 THEN 1 ELSE -1 END AS sign
    FROM (SELECT template, md5(token) AS h FROM
        (SELECT template, unnest(string_split_regex(lower(template), '\\s+')) AS token FROM counts) WHERE token <> '')),
sums AS (SELECT template, bin, sum(sign)::DOUBLE AS s FROM hits GROUP BY template, bin),
norms AS (SELECT template, sqrt(sum(s * s))::FLOAT AS norm FROM sums GROUP BY template),
units AS (
    SELECT template, bin, CASE WHEN norm > 0 THEN (s::FLOAT / norm)::FLOAT::DOUBLE ELSE 0 END AS value
    FROM sums JOIN norms USING (template)),
dense AS (
    SELECT c.template AS key, c.format AS grp, c.n, i, coalesce(u.value, 0) AS v
    FROM counts c CROSS JOIN range({VIEW_DIM}) r(i) LEFT JOIN units u ON u.template = c.template AND u.bin = i)"""
EMBEDDINGS = """dense AS (
    SELECT vec_id AS key, label AS grp, 1::BIGINT AS n, i - 1 AS i, embedding[i]::DOUBLE AS v
    FROM embeddings CROSS JOIN range(1, 65) r(i))"""


def _path(n: int) -> str:
    if n <= 1:
        return "0.0"
    return "1.0" if n == 2 else f"(2.0 * (ln({n - 1}.0) + 0.5772156649015329) - 2.0 * {n - 1}.0 / {n}.0)"


def _tree(nodes, node: int = 0) -> str:
    _, feature, cut, left, right, rows, depth = nodes[node]
    if feature < 0:
        return f"{depth} + {_path(rows)}"
    return f"CASE WHEN f{feature} <= {cut} THEN {_tree(nodes, left)} ELSE {_tree(nodes, right)} END"


_FEATURES = sorted({n[1] for t in VIEW_TREES for n in t if n[1] >= 0})
SCORES = f"""means AS (SELECT i, sum(v * n) / sum(n) AS m FROM dense GROUP BY i),
centers AS (SELECT grp, i, sum(v * n) / sum(n) AS c FROM dense GROUP BY grp, i),
km AS (
    SELECT key, sqrt(min(d)) AS kmeans FROM (
        SELECT d.key, c.grp, sum((d.v - c.c) * (d.v - c.c)) AS d FROM dense d JOIN centers c USING (i) GROUP BY d.key, c.grp)
    GROUP BY key),
ae AS (
    SELECT key, sum(CASE WHEN i >= {VIEW_AXES} THEN (v - m) * (v - m) ELSE 0 END) / {VIEW_DIM} AS autoencoder
    FROM dense JOIN means USING (i) GROUP BY key),
picked AS (
    SELECT key, any_value(n) AS n, {', '.join(f'max(CASE WHEN i = {f} THEN v END) AS f{f}' for f in _FEATURES)}
    FROM dense GROUP BY key),
forest AS (
    SELECT key, n, pow(2, -(({_tree(VIEW_TREES[0])}) + ({_tree(VIEW_TREES[1])})) / 2 / {_path(256)}) AS isolation
    FROM picked),
scores AS (
    SELECT key, n, isolation, round(isolation - {VIEW_OFFSET}, 10) AS isolation_forest, round(kmeans, 10) AS kmeans,
        round(autoencoder, 10) AS autoencoder
    FROM forest JOIN km USING (key) JOIN ae USING (key)),
long AS (UNPIVOT (SELECT key, n, isolation_forest, kmeans, autoencoder FROM scores)
    ON isolation_forest, kmeans, autoencoder INTO NAME model VALUE score),
params AS (
    SELECT model, quantile_cont(score, 0.95) AS threshold, min(score) AS s_min, max(score) AS s_max
    FROM (SELECT model, score, unnest(range(n)) FROM long) GROUP BY model),
ranges AS (
    SELECT *, least(1, greatest(0, (threshold - s_min) / (s_max - s_min + 1e-8))) AS norm_threshold FROM params),
judged AS (
    SELECT key, sum((score >= threshold)::INT)::INT AS votes,
        max(least(1, greatest(0, (score - s_min) / (s_max - s_min + 1e-8)))) AS top,
        max(score) AS top_raw
    FROM long JOIN ranges USING (model) GROUP BY key),
decided AS (
    SELECT key, votes, top_raw, round(top, 4) AS anomaly_score, votes >= 2 AS is_anomaly,
        (SELECT round(avg(norm_threshold), 4) FROM ranges) AS threshold_used
    FROM judged)"""
LINE_SCORES = f"{PARSED},\n{VECTORS},\n{SCORES},\nfound AS (SELECT l.*, d.* EXCLUDE (key) FROM lines l JOIN decided d ON d.key = l.template)"
VECTOR_SCORES = f"{EMBEDDINGS},\n{SCORES}"
VEC_ID = "'log_' || lpad(key::VARCHAR, 7, '0')"

AROUND = "string_agg(raw_text, chr(10)) OVER (ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"


# What the lower-cased context `ctx` has to hold, rule by rule.
PHRASES = (
    "contains(ctx, 'outofmemoryerror') OR contains(ctx, 'heap space')",
    "contains(ctx, 'hikaripool') OR contains(ctx, 'connection timeout') OR contains(ctx, 'pool exhausted')",
    "contains(ctx, 'nullpointerexception') OR contains(ctx, 'status=500') OR contains(ctx, 'circuit breaker')",
    "contains(ctx, 'allocateblock') OR contains(ctx, 'dfs') OR contains(ctx, 'block')",
)
SEVERITY = f"""CASE WHEN {PHRASES[0]} THEN 'critical' WHEN {PHRASES[1]} THEN 'high' WHEN {PHRASES[2]} THEN 'high'
    WHEN {PHRASES[3]} THEN 'medium' ELSE 'medium' END"""
PATTERN = f"""CASE WHEN {PHRASES[0]} THEN 'Known Pattern: JVM_HEAP_EXHAUSTION_ERR'
    WHEN {PHRASES[1]} THEN 'Known Pattern: DB_CONNECTION_POOL_STARVATION'
    WHEN {PHRASES[2]} THEN 'Known Pattern: UNHANDLED_RUNTIME_EXCEPTION'
    WHEN {PHRASES[3]} THEN 'Known Pattern: HDFS_BLOCK_ALLOCATION_DEVIATION' END"""


def rule_case(result) -> str:
    """CASE that gives each rule its wording."""
    arms = " ".join(f"WHEN {phrases} THEN {result(rule)}" for phrases, rule in zip(PHRASES, RULES, strict=True))
    return f"CASE {arms} ELSE {result(None)} END"


N_ACTIONS = rule_case(lambda r: str(len(r.actions if r else OTHER_ACTIONS)))
ACTIONS = rule_case(lambda r: quoted("\n".join(r.actions if r else OTHER_ACTIONS)))


def explanation(score: str) -> str:
    other = f"{quoted(OTHER_EXPLANATION)} || printf('%.4f', {score}) || '.'"
    return rule_case(lambda r: quoted(r.explanation) if r else other)


CONTEXTS = f"ctxs AS (SELECT *, {AROUND} AS context FROM lines), lowered AS (SELECT *, lower(replace(context, chr(10), ' ')) AS ctx FROM ctxs)"
VERDICTS = """verdicts AS (
    SELECT event_id, CASE event_type WHEN 'purchase' THEN 'confirmed' ELSE 'dismissed' END AS verdict
    FROM events WHERE event_type IN ('purchase', 'error'))"""
VERDICT_COUNTS = """SELECT count(*)::BIGINT AS total, count(*) FILTER (verdict = 'confirmed')::BIGINT AS confirmed,
    count(*) FILTER (verdict = 'dismissed')::BIGINT AS dismissed FROM verdicts"""
SAMPLE = f"""{PARSED},
{LABELS},
sample AS (SELECT line_no, value, nullif(regexp_extract(value, 'blk_[-0-9]+'), '') AS block_id FROM log WHERE line_no < 2500),
blocks AS (
    SELECT s.block_id, coalesce(any_value(b.label), 'Unknown') AS label, count(*)::BIGINT AS n
    FROM sample s LEFT JOIN labels_of b USING (block_id) WHERE s.block_id IS NOT NULL GROUP BY s.block_id)"""
WORDS = "outofmemory|hikaripool|nullpointer|panic|deadlock|timeout|critical"
SHOWN = "outofmemory|hikaripool|nullpointer|panic|deadlock|error|critical"
SAMPLES = """samples AS (
    SELECT user_id AS host, ts, least(value, 100.0) AS cpu_percent, regexp_extract(props, '([0-9]+)', 1)::DOUBLE AS memory_percent
    FROM events WHERE event_type = 'view'),
faults AS (SELECT user_id AS host, ts, 'log_' || lpad(event_id::VARCHAR, 7, '0') AS log_id FROM events WHERE event_type = 'error')"""
LIVE = f"""{LINE_SCORES},
watched AS (
    SELECT *, row_number() OVER (PARTITION BY stream ORDER BY line_no) - 1 AS place,
        votes >= 2 OR regexp_matches(lower(raw_text), '{WORDS}') AS is_alert,
        string_agg(raw_text, chr(10)) OVER (PARTITION BY stream ORDER BY line_no ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS context
    FROM found),
alerts AS (SELECT 'live_' || stream || '_' || place AS log_id, stream, place, round(top_raw, 4) AS anomaly_score,
    0.5::DOUBLE AS threshold_used, context FROM watched WHERE is_alert)"""
LIVE_COLUMNS = "log_id, stream, anomaly_score, threshold_used, context"


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def decision(model: str) -> str:
    return with_(
        VECTOR_SCORES,
        f"""SELECT {VEC_ID} AS log_id, votes, l.score >= r.threshold AS is_anomaly,
        round(least(1, greatest(0, (l.score - s_min) / (s_max - s_min + 1e-8))), 4) AS anomaly_score,
        round(norm_threshold, 4) AS threshold_used
        FROM decided JOIN long l USING (key) JOIN ranges r USING (model) WHERE model = '{model}'""",
    )


PARAM_SELECT = """SELECT model, round(threshold, 6) AS threshold, round(norm_threshold, 6) AS norm_threshold,
    round(s_min, 6) AS s_min, round(s_max, 6) AS s_max FROM ranges"""

SQL = {
    "template_report": with_(
        PARSED, "SELECT template, level, source, format, count(*)::BIGINT AS n FROM lines GROUP BY ALL"
    ),
    "parsed_fields": with_(
        PARSED, 'SELECT log_id, "timestamp", level, source, raw_text, message, template, block_id, format FROM lines'
    ),
    "document_line_templates": with_(
        f"{DOC_LINES}, shaped AS ({parsed('doc_lines', 'file, line_no, pos', 'TIMESTAMP \'2024-01-01\'')}), lines AS ({fields('shaped')})",
        "SELECT file, line_no, pos, format, level, source, block_id, md5(template) AS template_md5 FROM lines",
    ),
    "sanitized_documents": f"""SELECT doc_id, length(t)::BIGINT AS chars, md5(t) AS text_md5
        FROM (SELECT doc_id, {sanitize('text')} AS t FROM documents)""",
    "unique_template_count": with_(PARSED, "SELECT count(DISTINCT template)::BIGINT AS unique_templates FROM lines"),
    "numbered_text_lines": with_(LOG, "SELECT line_no, line_no AS pos, value FROM log"),
    "indexed_text_lines": with_(LOG, "SELECT line_no + (line_no + 1) // 3 AS line_no, line_no AS pos, value FROM log"),
    "first_indexed_lines": with_(
        LOG, "SELECT line_no + (line_no + 1) // 3 AS line_no, line_no AS pos, value FROM log WHERE line_no + (line_no + 1) // 3 < 1000"
    ),
    "first_raw_lines": with_(DOC_LINES, "SELECT file, line_no, pos, md5(value) AS value_md5 FROM doc_lines WHERE line_no < 25"),
    "first_records": with_(DOC_LINES, "SELECT file, line_no, pos, md5(value) AS value_md5 FROM doc_lines WHERE pos < 25"),
    "block_label_map": with_(f"{PARSED}, {LABELS}", "SELECT block_id, label FROM labels_of"),
    "labelled_lines": with_(f"{PARSED}, {LABELS}", "SELECT log_id, block_id, label_text, label FROM labelled"),
    "preprocessing_summary": with_(
        f"{PARSED}, {LABELS}, {VECTORS}",
        """SELECT count(*)::BIGINT AS total_records, (SELECT count(DISTINCT i) FROM dense)::INT AS embedding_dim,
        count(*) FILTER (label = 0)::BIGINT AS normal_records, count(*) FILTER (label = 1)::BIGINT AS anomaly_records,
        count(*) FILTER (label = -1)::BIGINT AS unknown_records FROM labelled""",
    ),
    "label_class_balance": with_(
        f"{PARSED}, {LABELS}",
        """SELECT count(*)::BIGINT AS total, count(*) FILTER (label = 0)::BIGINT AS normal,
        count(*) FILTER (label = 1)::BIGINT AS anomaly, count(*) FILTER (label = 0) * 100.0::DOUBLE / count(*) AS normal_percent,
        count(*) FILTER (label = 1) * 100.0::DOUBLE / count(*) AS anomaly_percent FROM labelled""",
    ),
    "sampled_lines": with_(SAMPLE, "SELECT line_no, value FROM sample"),
    "sampled_block_labels": with_(SAMPLE, "SELECT block_id, label FROM blocks"),
    "sample_summary": with_(
        SAMPLE,
        """SELECT (SELECT count(*) FROM sample)::BIGINT AS sampled_lines, sum(n) FILTER (label = 'Normal')::BIGINT AS normal_lines,
        sum(n) FILTER (label = 'Anomaly')::BIGINT AS anomaly_lines,
        sum(n) FILTER (label NOT IN ('Normal', 'Anomaly'))::BIGINT AS unknown_lines, count(*)::BIGINT AS unique_blocks FROM blocks""",
    ),
    "hashed_template_vectors": with_(
        f"{PARSED}, {VECTORS}",
        "SELECT template, n, bin::INT AS bin, round(value, 6) AS value FROM units JOIN counts USING (template) WHERE value <> 0",
    ),
    "record_contract": with_(
        f"{PARSED}, {VECTORS}, weight AS (SELECT template, sum(abs(value)) AS w FROM units GROUP BY template)",
        f"""SELECT log_id, "timestamp", raw_text, source, (line_no % 100)::DOUBLE AS cpu_percent, {VIEW_DIM}::INT AS dim,
        round(w, 4) AS abs_sum FROM lines JOIN weight USING (template)""",
    ),
    "parsed_embeddings": """SELECT 'log_' || lpad(vec_id::VARCHAR, 7, '0') AS log_id, label NOT IN (3, 4) AS fits,
        CASE WHEN label IN (3, 4) THEN 0 ELSE 64 END::INT AS dim,
        CASE WHEN label IN (3, 4) THEN 0.0 ELSE round(list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))), 4) END::DOUBLE AS abs_sum
        FROM embeddings""",
    "rejected_vectors": with_(
        VECTOR_SCORES,
        f"""SELECT {VEC_ID} AS log_id, e.label NOT IN (3, 4, 5) AS fits,
        CASE WHEN e.label NOT IN (3, 4, 5) THEN round(kmeans, 6) END AS distance
        FROM scores JOIN embeddings e ON e.vec_id = key""",
    ),
    "queue_score_text": "SELECT event_id, printf('%.2f', event_id % 1001 / 1000::DOUBLE) AS score FROM events",
    "csv_records": """SELECT 'log_' || lpad(vec_id::VARCHAR, 7, '0') AS log_id,
        'say "log_' || lpad(vec_id::VARCHAR, 7, '0') || '", twice' AS raw_text, 64::INT AS dim,
        round(list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))), 4) AS abs_sum FROM embeddings""",
    "evaluation_matrix": with_(
        f"{PARSED}, {LABELS}",
        f"SELECT log_id, coalesce(block_id, '') AS block_id, label, {VIEW_DIM}::INT AS dim FROM labelled",
    ),
    "nearest_centroid_distance": with_(VECTOR_SCORES, f"SELECT {VEC_ID} AS log_id, round(kmeans, 6) AS distance FROM scores"),
    "reconstruction_errors": with_(VECTOR_SCORES, f"SELECT {VEC_ID} AS log_id, round(autoencoder, 7) AS error FROM scores"),
    "forest_scores": with_(VECTOR_SCORES, f"SELECT {VEC_ID} AS log_id, round(isolation, 6) AS score FROM scores"),
    "score_thresholds": with_(VECTOR_SCORES, PARAM_SELECT),
    "line_score_thresholds": with_(LINE_SCORES, PARAM_SELECT),
    "value_percentile": "SELECT count(*)::BIGINT AS n, round(quantile_cont(value, 0.95), 6) AS p95 FROM events",
    "ensemble_decisions": with_(
        VECTOR_SCORES,
        f"""SELECT {VEC_ID} AS log_id, votes, is_anomaly, anomaly_score,
        threshold_used FROM decided""",
    ),
    "forest_decisions": decision("isolation_forest"),
    "kmeans_decisions": decision("kmeans"),
    "autoencoder_decisions": decision("autoencoder"),
    "detected_lines": with_(
        LINE_SCORES,
        f"""SELECT log_id, anomaly_score, is_anomaly, threshold_used,
        {AROUND} AS context FROM found""",
    ),
    "detected_lines_salted": with_(
        LINE_SCORES, "SELECT log_id, votes, is_anomaly, anomaly_score FROM found"
    ),
    "context_windows": with_(
        PARSED,
        f"""SELECT log_id, {AROUND} AS context, least(pos, 2)::INT AS root_index, true AS root_is_line FROM lines""",
    ),
    "legacy_root_index": with_(
        DOC_LINES,
        """SELECT file, pos, n::INT AS n, (n // 2)::INT AS root_index FROM (SELECT file, pos,
        count(*) OVER (PARTITION BY file ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS n FROM doc_lines)""",
    ),
    "anomaly_contexts": with_(
        LINE_SCORES, f"SELECT log_id, context FROM (SELECT log_id, is_anomaly, {AROUND} AS context FROM found) WHERE is_anomaly"
    ),
    "trailing_turns": """SELECT conv_id, turn, md5(string_agg(text, chr(10)) OVER (
        PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) AS context_md5 FROM conversations""",
    "recent_lines": with_(
        PARSED,
        f"""SELECT line_no, raw_text, regexp_matches(lower(raw_text), '{SHOWN}') AS is_highlighted
        FROM lines ORDER BY line_no DESC LIMIT 8""",
    ),
    "keyword_alerts": with_(
        PARSED,
        f"""SELECT * FROM (SELECT log_id, regexp_matches(lower(raw_text), '{WORDS}') AS is_alert,
        regexp_matches(lower(raw_text), '{SHOWN}') AS is_highlighted FROM lines) WHERE is_alert OR is_highlighted""",
    ),
    "incident_queue": with_(
        LINE_SCORES,
        """SELECT log_id AS incident_id, printf('%.2f', anomaly_score) AS score, '2/3 Models' AS consensus
        FROM found WHERE is_anomaly ORDER BY anomaly_score DESC, pos""",
    ),
    "queue_search": with_(LINE_SCORES, "SELECT log_id FROM found WHERE is_anomaly AND lower(log_id) LIKE '%log\\_00001%' ESCAPE '\\'"),
    "top_incidents": with_(
        VECTOR_SCORES,
        f"""SELECT (row_number() OVER (ORDER BY anomaly_score DESC, key))::INT AS rank, {VEC_ID} AS log_id,
        anomaly_score FROM decided WHERE is_anomaly QUALIFY rank <= 3""",
    ),
    "key_figures": with_(
        f"{LINE_SCORES}, {VERDICTS}",
        f"""SELECT count(*)::BIGINT AS ingested, count(*) FILTER (is_anomaly)::BIGINT AS flagged,
        round(count(*) FILTER (is_anomaly) * 100.0::DOUBLE / count(*), 4) AS deviation_percent,
        any_value(total) AS total, any_value(confirmed) AS confirmed, any_value(dismissed) AS dismissed
        FROM found, ({VERDICT_COUNTS})""",
    ),
    "anomaly_rate": with_(LINE_SCORES, "SELECT round(avg(is_anomaly::INT), 6) AS anomaly_rate FROM found"),
    "detector_quality": with_(
        f"""{LINE_SCORES}, {LABELS},
        truth AS (SELECT template, label FROM labelled WHERE label >= 0),
        voted AS (SELECT model, t.label, l.score, (l.score >= r.threshold)::INT AS hit
            FROM truth t JOIN long l ON l.key = t.template JOIN ranges r USING (model)
            UNION ALL SELECT 'ensemble', t.label, s.isolation_forest, (d.votes >= 2)::INT
            FROM truth t JOIN scores s ON s.key = t.template JOIN decided d ON d.key = t.template),
        cells AS (SELECT model, count(*) FILTER (label = 0 AND hit = 0)::BIGINT AS tn, count(*) FILTER (label = 0 AND hit = 1)::BIGINT AS fp,
            count(*) FILTER (label = 1 AND hit = 0)::BIGINT AS fn, count(*) FILTER (label = 1 AND hit = 1)::BIGINT AS tp
            FROM voted GROUP BY model),
        ranked AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
            + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0::DOUBLE AS r FROM voted),
        auc AS (SELECT model, sum(r) FILTER (label = 1) AS rs, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q
            FROM ranked GROUP BY model)""",
        """SELECT CASE model WHEN 'isolation_forest' THEN 'Isolation Forest (Baseline)' WHEN 'autoencoder' THEN 'Autoencoder (PCA)'
            WHEN 'kmeans' THEN 'K-Means Clustering' ELSE 'Ensemble (Majority Vote)' END AS name, tn, fp, fn, tp,
        round(CASE WHEN tp + fp = 0 THEN 0 ELSE 100.0::DOUBLE * tp / (tp + fp) END, 6)::DOUBLE AS precision,
        round(CASE WHEN tp + fn = 0 THEN 0 ELSE 100.0::DOUBLE * tp / (tp + fn) END, 6)::DOUBLE AS recall,
        round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 200.0::DOUBLE * tp / (2 * tp + fp + fn) END, 6)::DOUBLE AS f1,
        round(100.0::DOUBLE * (tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
        round(CASE WHEN p = 0 OR q = 0 THEN 0 ELSE 100.0::DOUBLE * (rs - p * (p + 1) / 2.0::DOUBLE) / (p * q) END, 6)::DOUBLE AS auc
        FROM cells JOIN auc USING (model)""",
    ),
    "document_length_auc": """WITH rows AS (
        SELECT quality, 'length' AS model, n_chars::DOUBLE AS score FROM documents JOIN labels USING (doc_id)
        UNION ALL SELECT quality, 'toxic', toxic::DOUBLE FROM documents JOIN labels USING (doc_id)),
        ranked AS (SELECT model, quality, rank() OVER (PARTITION BY model ORDER BY score)
            + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0::DOUBLE AS r FROM rows)
        SELECT model, round(100.0::DOUBLE * (sum(r) FILTER (quality = 1) - count(*) FILTER (quality = 1) * (count(*) FILTER (quality = 1) + 1) / 2.0::DOUBLE)
            / (count(*) FILTER (quality = 1) * count(*) FILTER (quality = 0)), 6) AS auc FROM ranked GROUP BY model""",
    "rule_reports": with_(
        f"{PARSED}, {CONTEXTS}",
        f"""SELECT log_id, {SEVERITY} AS severity, {explanation('line_no / 7.0::DOUBLE')} AS explanation,
        ({N_ACTIONS})::INT AS n_actions, {PATTERN} AS known_pattern FROM lowered""",
    ),
    "anomaly_reports": with_(
        f"{LINE_SCORES}, seen AS (SELECT *, lower(replace({AROUND}, chr(10), ' ')) AS ctx FROM found)",
        f"SELECT log_id, {SEVERITY} AS severity, {PATTERN} AS known_pattern FROM seen WHERE is_anomaly ORDER BY pos LIMIT 40",
    ),
    "answered_reports": with_(
        f"""{PARSED}, {CONTEXTS}, replies AS (
            SELECT *, 'log_' || lpad(doc_id::VARCHAR, 7, '0') AS log_id,
                CASE WHEN lang IN ('en', 'fr') THEN 'full' WHEN lang = 'de' THEN 'bare' WHEN n_chars > 1000 THEN 'list' ELSE 'none' END AS kind,
                CASE WHEN n_chars > 5000 THEN 'critical' WHEN n_chars > 2000 THEN 'high' WHEN n_chars > 500 THEN 'medium' ELSE 'low' END AS said
            FROM documents)""",
        f"""SELECT l.log_id, CASE kind WHEN 'full' THEN said WHEN 'bare' THEN said WHEN 'none' THEN 'medium' ELSE {SEVERITY} END AS severity,
        md5(CASE WHEN kind = 'full' AND r.text <> '' THEN regexp_replace(r.text, '^\\s+|\\s+$', '', 'g')
            WHEN kind IN ('full', 'bare', 'none') THEN {quoted(DEFAULT_EXPLANATION)} ELSE {explanation('0.5')} END) AS explanation_md5,
        CASE kind WHEN 'full' THEN lang || chr(10) || r.source WHEN 'bare' THEN r.source
            WHEN 'none' THEN {quoted(chr(10).join(DEFAULT_ACTIONS))} ELSE {ACTIONS} END AS actions,
        CASE WHEN kind IN ('full', 'bare', 'none') THEN NULL ELSE {PATTERN} END AS known_pattern
        FROM lowered l LEFT JOIN replies r USING (log_id)""",
    ),
    "stored_reports": with_(
        f"{LINE_SCORES}, seen AS (SELECT *, lower(replace({AROUND}, chr(10), ' ')) AS ctx FROM found)",
        f"SELECT log_id, {SEVERITY} AS severity FROM seen WHERE is_anomaly",
    ),
    "analysis_prompts": with_(
        f"{PARSED}, {CONTEXTS}",
        """SELECT log_id, concat_ws(chr(10), 'Incident to assess: ' || log_id,
        'Flagged by detector vote, deviation score ' || printf('%.4f', line_no / 7.0::DOUBLE),
        CASE WHEN format <> 'raw' THEN 'Host at that time: CPU=' || (line_no % 100) || '.5%, RAM=N/A%' END,
        'Log lines in order:', '  ' || replace(context, chr(10), chr(10) || '  '),
        'Name the cause, the severity (critical, high, medium, low) and concrete actions as the required JSON.') AS prompt FROM lowered""",
    ),
    "accepted_feedback": """SELECT 'log_' || event_id AS log_id,
        CASE event_type WHEN 'purchase' THEN 'confirmed' ELSE 'dismissed' END AS administrator_verdict,
        CASE event_type WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') ELSE '2024-02-01T00:00:00.000000+00:00' END AS "timestamp"
        FROM events WHERE event_type IN ('purchase', 'error')""",
    "verdict_counts": with_(VERDICTS, VERDICT_COUNTS),
    "feedback_log_counts": with_(
        VERDICTS,
        f"SELECT total + confirmed AS total, confirmed * 2 AS confirmed, dismissed FROM ({VERDICT_COUNTS})",
    ),
    "adapted_threshold": with_(
        VERDICTS,
        f"SELECT *, round(greatest(0.1, least(0.95, 0.5 + (dismissed - confirmed) * 0.001)), 4)::DOUBLE AS threshold FROM ({VERDICT_COUNTS})",
    ),
    "replayed_threshold": "WITH RECURSIVE " + VERDICTS + """,
        steps AS (SELECT row_number() OVER (ORDER BY event_id) AS i,
            sum(CASE verdict WHEN 'dismissed' THEN 1 ELSE -1 END) OVER (ORDER BY event_id)::BIGINT AS net FROM verdicts),
        walk AS (SELECT 0::BIGINT AS i, 5000::BIGINT AS cutoff
            UNION ALL SELECT s.i, greatest(1000, least(9500, w.cutoff + s.net))::BIGINT FROM walk w JOIN steps s ON s.i = w.i + 1)
        SELECT max(i)::BIGINT AS total, arg_max(cutoff, i) / 10000.0::DOUBLE AS threshold FROM walk""",
    "persisted_cutoff": with_(
        VERDICTS,
        f"""SELECT 'contamination' AS key, 0.05::DOUBLE AS value UNION ALL
        SELECT 'consensus_cutoff', round(greatest(0.1, least(0.95, once + net)), 4)::DOUBLE FROM (
            SELECT net, round(greatest(0.1, least(0.95, 0.5 + net)), 4) AS once
            FROM (SELECT (dismissed - confirmed) * 0.001 AS net FROM ({VERDICT_COUNTS})))""",
    ),
    "metrics_at_incident": with_(
        SAMPLES,
        "SELECT f.log_id, f.host, s.cpu_percent, s.memory_percent FROM faults f ASOF LEFT JOIN samples s ON f.host = s.host AND f.ts >= s.ts",
    ),
    "streamed_metrics_at_incident": with_(
        SAMPLES,
        "SELECT f.log_id, f.host, s.cpu_percent, s.memory_percent FROM faults f ASOF LEFT JOIN samples s ON f.host = s.host AND f.ts >= s.ts",
    ),
    "latest_host_metrics": with_(
        SAMPLES,
        """SELECT f.log_id, f.host, s.cpu_percent, s.memory_percent FROM faults f LEFT JOIN (
        SELECT * FROM samples QUALIFY row_number() OVER (PARTITION BY host ORDER BY ts DESC) = 1) s USING (host)""",
    ),
    "live_alerts": with_(LIVE, f"SELECT {LIVE_COLUMNS} FROM alerts"),
    "live_first_alerts": with_(
        LIVE, f"SELECT {LIVE_COLUMNS} FROM alerts QUALIFY row_number() OVER (PARTITION BY stream ORDER BY place) = 1"
    ),
    "live_verdict_counts": with_(VERDICTS, VERDICT_COUNTS),
}
SQL["labelled_lines_salted"] = SQL["labelled_lines"]
SQL["fallback_decisions"] = with_(
    f"""{VECTOR_SCORES}, spans AS (
        SELECT r.model, r.threshold, min(l.score) AS lo, max(l.score) AS hi FROM ranges r JOIN long l USING (model) GROUP BY ALL),
    cut AS (SELECT round(avg(CASE WHEN hi - lo < 1e-8 THEN 0.5 ELSE least(1, greatest(0, (threshold - lo) / (hi - lo))) END), 4) AS mean FROM spans)""",
    f"""SELECT {VEC_ID} AS log_id, votes, is_anomaly, anomaly_score, (SELECT mean FROM cut) AS threshold_used FROM decided""",
)
SQL["stored_models"] = SQL["score_thresholds"]
SQL["jsonl_text_vectors"] = """SELECT 'log_' || lpad(vec_id::VARCHAR, 7, '0') AS log_id, len(embedding)::INT AS dim,
    round(list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))), 4) AS abs_sum FROM embeddings"""
SQL["loaded_records"] = """SELECT 'log_' || lpad(vec_id::VARCHAR, 7, '0') AS log_id, 'from csv' AS raw_text,
    len(embedding)::INT AS dim FROM embeddings"""
SQL["two_log_batch_limit"] = with_(LINE_SCORES, "SELECT log_id FROM found WHERE is_anomaly ORDER BY line_no % 2, line_no LIMIT 40")
SQL["prompt_table"] = with_(
    f"{LINE_SCORES}, seen AS (SELECT *, {AROUND} AS context FROM found)",
    """SELECT log_id, true AS asks_for_fields, concat_ws(chr(10), 'Incident to assess: ' || log_id,
    'Flagged by detector vote, deviation score ' || printf('%.4f', anomaly_score),
    'Log lines in order:', '  ' || replace(context, chr(10), chr(10) || '  '),
    'Name the cause, the severity (critical, high, medium, low) and concrete actions as the required JSON.') AS prompt
    FROM seen WHERE is_anomaly""",
)
SQL["scored_events"] = with_(
    LINE_SCORES,
    f"""SELECT line_no, votes, round(top_raw, 6) AS live_score, votes >= 2 OR regexp_matches(lower(raw_text), '{WORDS}') AS is_alert,
    regexp_matches(lower(raw_text), '{SHOWN}') AS is_highlighted FROM found""",
)
SQL["live_text_alerts"] = SQL["live_alerts"]
SQL["growing_file_alerts"] = SQL["live_alerts"]
SQL["live_threshold"] = SQL["replayed_threshold"]
SQL["live_trigger_counts"] = """SELECT ceil(count(DISTINCT user_id % 20) / 8)::BIGINT AS polls,
    count(*)::BIGINT AS lines, true AS timed FROM events"""
SQL["live_alert_reports"] = with_(
    f"""{LIVE}, {SAMPLES}, newest AS (SELECT 'host-' || (host % 20) AS stream, cpu_percent, memory_percent FROM samples
        QUALIFY row_number() OVER (PARTITION BY host % 20 ORDER BY ts DESC, cpu_percent DESC, memory_percent DESC) = 1),
    ruled AS (SELECT *, lower(replace(context, chr(10), ' ')) AS ctx FROM alerts)""",
    f"""SELECT log_id, {SEVERITY} AS severity, {explanation('anomaly_score')} AS explanation, cpu_percent, memory_percent
    FROM ruled LEFT JOIN newest USING (stream)""",
)
SQL["forest_invariants"] = """SELECT tree::INT AS tree, n AS root_rows, n AS leaf_rows, 0::BIGINT AS broken_splits, true AS depth_kept
    FROM range(100) t(tree), (SELECT least(256, count(*))::BIGINT AS n FROM embeddings)"""
SQL["center_invariants"] = """SELECT 10::BIGINT AS n_centers, count(*)::BIGINT AS n_members, true AS centers_are_means FROM embeddings"""
SQL["axis_invariants"] = with_(
    EMBEDDINGS,
    """SELECT 'mean' AS what, i::INT AS i, abs(round(avg(v), 5)) AS value FROM dense GROUP BY i
    UNION ALL SELECT 'skew', 0, 0.0
    UNION ALL SELECT 'variance', 0, round(sum(var), 5) FROM (SELECT i, var_pop(v) AS var FROM dense GROUP BY i)""",
)
SQL["detection_invariants"] = """SELECT unnest(['isolation_forest', 'kmeans', 'autoencoder']) AS model, n AS n_lines,
    true AS flags_a_twentieth, true AS threshold_is_percentile, true AS forest_at_zero FROM (SELECT count(*)::BIGINT AS n FROM events)"""
