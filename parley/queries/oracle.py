"""DuckDB SQL for the registered queries, written from the semantics and not from the Spark plans."""

from __future__ import annotations

from parley.functions.text import SPACE
from parley.schemas import DEFAULT_SYSTEM_PROMPT, IGNORE_LABEL, MAX_SEQ_LENGTH

SYSTEM = DEFAULT_SYSTEM_PROMPT.replace("'", "''")
S = SPACE
NOT_WORD = r"[^\p{L}\p{N}_]"
# RE2 has no look-around, so a match takes its border characters along and puts
# them back; a second pass finds a match that shared a border with the first.
EMAIL = rf"(^|{NOT_WORD})([A-Za-z0-9_][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}})($|{NOT_WORD})"
SEP = f"[{S}.-]?"
PHONE_IN = rf"(^|[^\p{{Nd}}])((?:\+?91{SEP})?[6-9]\p{{Nd}}{{9}})($|[^\p{{Nd}}])"
PHONE = (
    rf"(^|[^\p{{Nd}}])((?:\+?\p{{Nd}}{{1,3}}{SEP})?(?:\?\(?\p{{Nd}}{{3}}\)?{SEP})?"
    rf"\p{{Nd}}{{3}}{SEP}\p{{Nd}}{{4}})($|[^\p{{Nd}}])"
)


def twice(c: str, pattern: str, token: str) -> str:
    once = f"regexp_replace({c}, '{pattern}', '\\1[{token}]\\3', 'g')"
    return f"regexp_replace({once}, '{pattern}', '\\1[{token}]\\3', 'g')"


def mask(c: str) -> str:
    return twice(twice(twice(c, EMAIL, "EMAIL"), PHONE_IN, "PHONE"), PHONE, "PHONE")


def named(c: str) -> str:
    """Names found in the field itself: all of five letters, so they go in the order they stand."""
    found = f"regexp_extract_all({c}, '([A-Z][a-z]{{4}}) ', 1)"
    first = f"list_transform(list_sort(list_distinct(list_transform({found}, lambda n: {{'i': list_position({found}, n), 'n': n}}))), lambda s: s.n)"
    return f"list_reduce(list_prepend({c}, {first}), lambda acc, n: replace(acc, n, '[NAME]'))"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{S}]+|[{S}]+$', '', 'g')"


def chat(user: str, assistant: str) -> str:
    return (
        f"[{{'role': 'system', 'content': '{SYSTEM}'}}, {{'role': 'user', 'content': {user}}}, "
        f"{{'role': 'assistant', 'content': {assistant}}}]"
    )


PAIRS = """pairs AS (
  SELECT u.conv_id || ':' || u.turn AS mongo_id, u.conv_id AS batch_num, u.turn AS record_index,
         u.text AS "user", coalesce(a.text, '') AS assistant
  FROM conversations u
  LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""
RECORDS = (
    PAIRS
    + """, records AS (
  SELECT * FROM pairs
  UNION ALL SELECT 'd' || doc_id, -1, doc_id, text, lang || ' ' || source FROM documents)"""
)
REASON = (
    f"CASE WHEN {strip('\"user\"')} = '' THEN 'Empty user content after PII clean' "
    f"WHEN {strip('assistant')} = '' THEN 'Empty assistant content after PII clean' END"
)
CHECKED = (
    RECORDS
    + f""", masked AS (
  SELECT mongo_id, batch_num, record_index, "user" AS raw_user, assistant AS raw_assistant,
         {mask('"user"')} AS "user", {mask('assistant')} AS assistant FROM records),
checked AS (SELECT *, {REASON} AS reason, {chat('"user"', 'assistant')} AS conversations FROM masked)"""
)
TRANSFORMED = (
    CHECKED
    + f""", transformed AS (
  SELECT mongo_id, 'processed' AS topic, batch_num || ':' || record_index AS key,
         to_json({{'source_mongo_id': mongo_id, 'batch_num': batch_num, 'record_index': record_index,
                  'conversations': conversations, 'metadata': {{'system_prompt': '{SYSTEM}'}}}})::VARCHAR AS value
  FROM checked WHERE reason IS NULL
  UNION ALL
  SELECT mongo_id, 'dead_letters', NULL,
         to_json({{'mongo_id': mongo_id, 'batch_num': batch_num, 'record_index': record_index, 'user': raw_user,
                  'assistant': raw_assistant, '_dlq_reason': 'Quality check failed: ' || reason}})::VARCHAR
  FROM checked WHERE reason IS NOT NULL)"""
)
RANKED = (
    RECORDS
    + """, ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || mongo_id)) - 1 AS r, count(*) OVER () AS n FROM records),
splits AS (
  SELECT *, CASE WHEN r < floor(0.70::DOUBLE * n) THEN 'train' WHEN r < floor(0.85::DOUBLE * n) THEN 'val'
                 ELSE 'test' END AS split FROM ranked)"""
)
LEADS = """leads AS (
  SELECT o_orderkey::VARCHAR AS _id,
         CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '4-NOT SPECIFIED' THEN NULL
              ELSE 'customer ' || o_custkey || ' asks at ' || o_orderpriority END AS conversation,
         CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'P' THEN 'processing' ELSE 'completed' END AS inference_status,
         o_orderkey::VARCHAR || '-' || substr(md5('42:' || o_orderkey), 1, 8) AS rid,
         o_orderstatus = 'P' AS sent,
         CASE o_orderstatus WHEN 'F' THEN 'processed' ELSE 'pending' END AS etl_status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'run_0' END AS training_run_id,
         o_orderstatus, o_orderpriority
  FROM orders)"""
RESULTS = (
    LEADS
    + """, results AS (
  SELECT *,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'answer ' || _id WHEN '2-HIGH' THEN 'answer ' || _id
              WHEN '3-MEDIUM' THEN '{"other":' || _id || '}' WHEN '4-NOT SPECIFIED' THEN ''
              ELSE '{"raw_output":"answer ' || _id || ' is not json"}' END AS result,
         CASE o_orderpriority WHEN '1-URGENT' THEN '[{"generated_text":"answer ' || _id || '"}]'
              WHEN '2-HIGH' THEN '{"generated_text":"answer ' || _id || '"}'
              WHEN '3-MEDIUM' THEN '{"other":' || _id || '}' WHEN '4-NOT SPECIFIED' THEN '[]'
              ELSE '{"raw_output":"answer ' || _id || ' is not json"}' END AS raw
  FROM leads)"""
)
LABELS = """label_rows AS (
  SELECT o_custkey AS batch_num, o_orderkey AS record_index,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'buy' WHEN '2-HIGH' THEN 'rent' WHEN '3-MEDIUM' THEN 'invest'
              WHEN '4-NOT SPECIFIED' THEN 'browse' ELSE 'drop' END AS intent,
         o_orderstatus AS st, o_orderpriority = '5-LOW' AS is_drop,
         floor(o_totalprice / 4500)::INTEGER AS score,
         'city_' || (o_orderkey % 50) AS locality,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'N/A' ELSE 'brand_' || (o_orderkey % 6) END AS brand
  FROM orders)"""
LOSSES = """losses AS (
  SELECT 'run_' || user_id AS run_id, value::DECIMAL(10,2) * 0.05::DECIMAL(3,2) AS loss,
         (props ->> '$.k')::INTEGER AS tokens FROM events)"""
EVALS = (
    LOSSES
    + """, sums AS (
  SELECT run_id, sum(loss * tokens)::DOUBLE AS l, sum(tokens)::BIGINT AS total_tokens FROM losses GROUP BY 1),
evals AS (
  SELECT run_id, total_tokens, CASE WHEN total_tokens > 0 THEN l / total_tokens ELSE 'inf'::DOUBLE END AS avg_loss FROM sums),
graded AS (
  SELECT *, exp(avg_loss) AS perplexity,
         CASE WHEN avg_loss < 0.5 THEN 'excellent' WHEN avg_loss < 1.5 THEN 'good' ELSE 'needs_improvement' END AS quality_tier
  FROM evals)"""
)
REPLIES = """replies AS (
  SELECT doc_id, CASE WHEN lang = 'en' THEN
           '```json' || chr(10) || to_json({'doc_id': doc_id, 'lang': lang, 'source': source, 'n_chars': n_chars})::VARCHAR
           || chr(10) || text || chr(10) || '```' ELSE text END AS raw FROM documents)"""
REPLY_LINES = (
    REPLIES
    + f""", parts AS (
  SELECT doc_id, regexp_split_to_array({strip("regexp_replace(raw, '(?i)```[a-z]*\\n?', '', 'g')")},
         '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\x{{2028}}\\x{{2029}}]') AS l FROM replies),
numbered AS (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS lineno FROM parts),
reply_lines AS (
  SELECT doc_id, lineno::INTEGER AS lineno, regexp_replace({strip('x')}, '^\\x{{feff}}+', '') AS line FROM numbered),
checked_lines AS (SELECT *, json_valid(line) AS ok FROM reply_lines WHERE line <> '')"""
)
TOKENS = f"""tokens AS (
  SELECT doc_id, list_transform(regexp_extract_all(text, '[^{S}]+'), lambda x: length(x)::INTEGER) AS ids FROM documents),
samples AS (
  SELECT doc_id, ids, ids[1:{MAX_SEQ_LENGTH}] AS input_ids,
         list_transform(ids[1:{MAX_SEQ_LENGTH}], lambda x, i: CASE WHEN i <= len(ids) // 3 THEN {IGNORE_LABEL} ELSE x END) AS labels
  FROM tokens)"""
LINE_REASONS = """verified AS (
  SELECT 'turns' AS kind, u.conv_id AS a, u.turn AS b,
         CASE WHEN p.role IS NULL OR n.role IS NULL THEN 'not a list of 3 items'
              WHEN p.role <> 'system' THEN 'roles mismatch' END AS reason
  FROM conversations u
  LEFT JOIN conversations p ON p.conv_id = u.conv_id AND p.turn = u.turn - 1
  LEFT JOIN conversations n ON n.conv_id = u.conv_id AND n.turn = u.turn + 1 AND n.role = 'assistant'
  WHERE u.role = 'user'
  UNION ALL SELECT 'props', event_id, 0, 'missing conversations' FROM events
  UNION ALL SELECT 'prose', doc_id, 0, CASE WHEN json_valid(text) THEN 'missing conversations' ELSE 'invalid json' END
  FROM documents)"""
UPSERT = """old AS (SELECT doc_id, quality, toxic FROM labels),
new AS (SELECT doc_id, CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS quality, 0 AS toxic FROM documents),
sides AS (
  SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, o.quality AS oq, o.toxic AS ot, n.quality AS nq, n.toxic AS nt,
         o.doc_id IS NOT NULL AS has_old, n.doc_id IS NOT NULL AS has_new
  FROM old o FULL JOIN new n ON o.doc_id = n.doc_id)"""
PER_BATCH = (
    PAIRS
    + """, per_batch AS (
  SELECT c.batch_num, count(p.batch_num) AS n_records
  FROM (SELECT DISTINCT conv_id AS batch_num FROM conversations) c
  LEFT JOIN (SELECT * FROM pairs WHERE assistant <> '') p USING (batch_num) GROUP BY 1)"""
)
STORE_DOCS = (
    RECORDS
    + """, docs AS (
  SELECT *, CASE WHEN assistant = '' THEN 'in_progress' ELSE 'pending' END AS etl_status FROM records)"""
)

STAMP = "'%Y-%m-%d %H:%M:%S'"
DAY = "2024-02-01 00:00:00"


def percentile(p: float) -> str:
    return f"list_sort(list(value))[greatest(ceil({p}::DOUBLE * count(*)), 1)::BIGINT]::DOUBLE"


ORACLE: dict[str, str] = {
    "mask_pii": f"SELECT doc_id, {mask('text')} AS masked FROM documents",
    "mask_names": """
SELECT conv_id, turn,
       list_reduce(list_prepend(text, list_transform(
           list_sort(list_transform(names, lambda n, i: {'l': -length(n), 'i': i, 'n': n})), lambda s: s.n)),
           lambda acc, n: replace(acc, n, '[NAME]')) AS masked
FROM (SELECT conv_id, turn, text, list_transform(
        list_sort(list_distinct(list_transform(found, lambda n: {'i': list_position(found, n), 'n': n}))), lambda s: s.n) AS names
      FROM (SELECT *, regexp_extract_all(text, '[A-Z][a-z]{2,}') AS found FROM conversations))""",
    "clean_records": f"""WITH {RECORDS}
SELECT mongo_id, batch_num, record_index, {mask('"user"')} AS "user", {mask('assistant')} AS assistant FROM records""",
    "normalize_ws": f"SELECT doc_id, trim(regexp_replace(text, '[{S}]+', ' ', 'g'), ' ') AS normalized FROM documents",
    "token_estimate": f"""
SELECT doc_id, (len(regexp_extract_all(text, '[^{S}]+')) * 4 // 3)::BIGINT AS tokens FROM documents""",
    "batch_number": """
SELECT doc_id, CASE WHEN lang IN ('fr', 'de') THEN 0 ELSE doc_id END::BIGINT AS batch_num FROM documents""",
    "upsert_latest": """
SELECT c_custkey AS user_id, -1::BIGINT AS event_id, 'customer' AS event_type FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)
UNION ALL
SELECT user_id, max(event_id), arg_max(event_type, event_id) FROM events GROUP BY 1""",
    "insert_first": """
SELECT o_orderkey AS l_orderkey, 0 AS l_linenumber, 0 AS l_partkey, 0 AS l_suppkey FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem)
WHERE r = 1 AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "batch_number_large": """
SELECT o_orderkey, TRY_CAST(o_orderkey::HUGEINT * 4000000007 * CASE WHEN o_orderkey % 5 = 0 THEN 1000000000 ELSE 1 END AS BIGINT) AS batch_num
FROM orders""",
    "clean_records_names": f"""WITH {RECORDS}, masked AS (
  SELECT mongo_id, {mask('"user"')} AS u, {mask('assistant')} AS a FROM records)
SELECT mongo_id, {named('u')} AS "user", {named('a')} AS assistant FROM masked""",
    "dispatch": f"""WITH {LEADS}, outcome AS (
  SELECT *, inference_status = 'pending' AS tried, inference_status = 'pending' AND _id LIKE '%3' AS bad FROM leads)
SELECT _id, CASE WHEN bad THEN 'error' WHEN tried THEN 'processing' ELSE inference_status END AS inference_status,
       CASE WHEN tried AND NOT bad THEN 'r-' || _id WHEN sent THEN rid END AS sagemaker_request_id,
       CASE WHEN tried AND NOT bad THEN 'out/' || _id END AS sagemaker_output_s3,
       CASE WHEN bad THEN 'throttled' END AS inference_error,
       CASE WHEN tried AND NOT bad THEN '2024-02-01 00:00:00' END AS triggered_at,
       CASE WHEN bad THEN '2024-02-01 00:00:00' END AS error_at FROM outcome""",
    "etl_run": f"""WITH {STORE_DOCS}, waiting AS (
  SELECT *, {REASON} AS reason FROM (SELECT * FROM docs WHERE etl_status = 'pending'))
SELECT count(*) AS published, count(*) FILTER (reason IS NULL) AS transformed, count(reason) AS failed, count(reason) AS dlq,
       count(*) FILTER (reason IS NULL) AS loaded, count(*) FILTER (reason IS NULL) AS inserted, 0::BIGINT AS skipped, '1' AS run
FROM waiting
UNION ALL SELECT 0, 0, 0, 0, 0, 0, 0, '2'""",
    "csv_dataset": "SELECT o_orderkey, o_orderpriority, o_custkey AS customer FROM orders",
    "chat_jsonl": f"""WITH {RECORDS}
SELECT to_json({{'conversations': {chat('"user"', 'assistant')}}})::VARCHAR AS line FROM records""",
    "hashed_lines": "SELECT md5(url) AS line_hash, url AS line FROM pages",
    "split_sink": f"""WITH {RANKED}
SELECT split, to_json({{'conversations': {chat('"user"', 'assistant')}}})::VARCHAR AS line FROM splits""",
    "batch_sink": "SELECT conv_id AS batch_num, turn AS record_index, role FROM conversations",
    "training_run": f"""WITH {LEADS}
SELECT 'run_1' AS _id, 'triggered' AS status, count(*) AS record_count, false AS deployed, '{DAY}' AS triggered_at
FROM leads WHERE etl_status = 'processed' AND training_run_id IS NULL HAVING count(*) >= 1""",
    "result_request_id": """
-- The key ends in "%20+" (two blanks once decoded), the id and a suffix that is stripped.
WITH names AS (
  SELECT page_id, list_last(string_split(url || '  ' || page_id, '/')) AS tail FROM pages
  WHERE NOT contains(url, '/fr/'))
SELECT page_id, url_decode(tail) AS request_id FROM names""",
    "defaults": """
SELECT conv_id AS batch_num, turn AS record_index,
       CASE role WHEN 'user' THEN text WHEN 'assistant' THEN '' END AS "user",
       CASE role WHEN 'user' THEN '' ELSE text END AS assistant FROM conversations""",
    "chat_format": f"""WITH {RECORDS}
SELECT mongo_id, to_json({{'conversations': {chat('"user"', 'assistant')}}})::VARCHAR AS line FROM records""",
    "render_template": f"""WITH {RECORDS}
SELECT mongo_id,
       '<|begin_of_text|>' || '<|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || '{SYSTEM}' || '<|eot_id|>'
       || '<|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || {strip('"user"')} || '<|eot_id|>'
       || '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) || {strip('assistant')} || '<|eot_id|>'
       || '<|eot_id|>' AS llama3,
       '<|im_start|>system' || chr(10) || '{SYSTEM}' || '<|im_end|>' || chr(10)
       || '<|im_start|>user' || chr(10) || "user" || '<|im_end|>' || chr(10)
       || '<|im_start|>assistant' || chr(10) || assistant || '<|im_end|>' || chr(10) || '<|im_end|>' AS chatml
FROM records""",
    "validate_chat": f"WITH {RECORDS} SELECT mongo_id, {REASON} AS reason FROM records",
    "result_text": f"WITH {RESULTS} SELECT _id, result FROM results",
    "parse_reply_lines": f"WITH {REPLY_LINES} SELECT doc_id, lineno, line, ok FROM checked_lines",
    "parse_reply_warnings": f"""WITH {REPLY_LINES}
SELECT doc_id, lineno, substr(line, 1, 80) AS excerpt FROM checked_lines WHERE NOT ok""",
    "parse_reply_rejects": f"""WITH {REPLY_LINES}
SELECT doc_id, raw FROM replies WHERE doc_id NOT IN (SELECT doc_id FROM checked_lines WHERE ok)""",
    "verify_jsonl": f"WITH {LINE_REASONS} SELECT kind, a, b, reason FROM verified",
    "verify_summary": f"""WITH {LINE_REASONS}
SELECT count(*) AS inspected, count(reason) AS malformed,
       CASE WHEN count(reason) = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM verified""",
    "label_audit": f"""WITH {LABELS}
SELECT batch_num, record_index,
       CASE WHEN is_drop AND st = 'P' THEN 'json' ELSE array_to_string(list_filter([
         CASE WHEN intent = 'drop' THEN 'intent' END,
         CASE WHEN is_drop AND st = 'O' THEN 'missing_key' END,
         CASE WHEN NOT is_drop AND st = 'P' THEN 'next_action' END,
         CASE WHEN score > 100 OR score < 0 THEN 'score' END,
         CASE WHEN st = 'F' THEN 'urgency' END], lambda x: x IS NOT NULL), ',') END AS violations
FROM label_rows""",
    "batch_audit": f"""WITH {LABELS},
kept AS (
  SELECT batch_num, bad, CASE WHEN NOT bad THEN intent END AS intent, CASE WHEN NOT bad THEN score END AS score,
         CASE WHEN NOT bad THEN brand END AS brand, CASE WHEN NOT bad THEN locality END AS locality, is_drop AND NOT bad AS is_drop
  FROM (SELECT *, is_drop AND st = 'P' AS bad FROM label_rows)),
brands AS (SELECT batch_num, max(c) AS m FROM (SELECT batch_num, brand, count(*) AS c FROM kept WHERE brand <> 'N/A' GROUP BY 1, 2) GROUP BY 1),
cities AS (SELECT batch_num, max(c) AS m FROM (SELECT batch_num, locality, count(*) AS c FROM kept WHERE NOT bad GROUP BY 1, 2) GROUP BY 1),
checks AS (
  SELECT k.batch_num, count(*) AS n, count(*) = 30 AS size_ok,
         count(*) FILTER (intent = 'buy') = 10 AND count(*) FILTER (intent = 'rent') = 6
         AND count(*) FILTER (intent = 'invest') = 6 AND count(*) FILTER (intent = 'browse') = 5
         AND count(*) FILTER (intent = 'drop') = 3 AS intent_mix_ok,
         count(*) FILTER (score BETWEEN 85 AND 100) > 0 AND count(*) FILTER (score BETWEEN 65 AND 84) > 0
         AND count(*) FILTER (score BETWEEN 40 AND 64) > 0 AND count(*) FILTER (score BETWEEN 15 AND 39) > 0
         AND count(*) FILTER (score BETWEEN 5 AND 14) > 0 AND count(*) FILTER (score BETWEEN 0 AND 4) > 0 AS score_tiers_ok,
         coalesce(any_value(b.m), 0) <= 6 AS brand_limit_ok, coalesce(any_value(c.m), 0) <= 1 AS locality_unique_ok,
         count(*) FILTER (is_drop AND NOT (score <= 4 AND brand = 'N/A')) = 0 AS drops_ok,
         count(*) FILTER (bad) = 0 AS readable_ok
  FROM kept k LEFT JOIN brands b USING (batch_num) LEFT JOIN cities c USING (batch_num) GROUP BY 1)
SELECT *, size_ok AND intent_mix_ok AND score_tiers_ok AND brand_limit_ok AND locality_unique_ok AND drops_ok AND readable_ok AS passed
FROM checks""",
    "clean_summary": f"""WITH {PER_BATCH}
SELECT count(*) AS batches, sum(n_records)::BIGINT AS total_scrubbed, count(*) FILTER (n_records = 0) AS failed_batches
FROM per_batch""",
    "failed_batches": f"WITH {PER_BATCH} SELECT batch_num FROM per_batch WHERE n_records = 0",
    "generation_summary": """
SELECT count(*) AS attempted, count(l.doc_id) AS successful_records, count(*) - count(l.doc_id) AS failed_batches
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "generation_worklist": """
SELECT b AS batch_num, 'Generate batch number: ' || b AS prompt
FROM (SELECT unnest(range(1, (SELECT max(doc_id) FROM documents) + 1)) AS b)
WHERE b NOT IN (SELECT doc_id FROM labels)""",
    "unified_index": """
SELECT row_number() OVER (ORDER BY printf('batch_%03d.json', conv_id), turn) - 1 AS global_index,
       conv_id AS batch_num, turn AS record_index, conv_id AS source_batch, turn AS batch_index,
       CASE role WHEN 'user' THEN text WHEN 'assistant' THEN '' END AS "user",
       CASE role WHEN 'user' THEN '' ELSE text END AS assistant,
       CASE role WHEN 'user' THEN to_json({'user': text}) WHEN 'assistant' THEN to_json({'assistant': text})
            ELSE to_json({'user': NULL::VARCHAR, 'assistant': text}) END::VARCHAR AS raw_record,
       'pending' AS etl_status
FROM conversations""",
    "split_assign": f"""WITH {RANKED}
SELECT mongo_id, split, to_json({{'conversations': {chat(mask('"user"'), mask('assistant'))}}})::VARCHAR AS line FROM splits""",
    "split_counts": f"WITH {RANKED} SELECT split, count(*) AS n FROM splits GROUP BY 1",
    "holdout_split": """
SELECT o_orderkey, CASE WHEN r < floor(0.9::DOUBLE * n) THEN 'train' ELSE 'test' END AS split
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || o_orderkey)) - 1 AS r, count(*) OVER () AS n FROM orders)""",
    "global_rank": "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS rank FROM events",
    "run_meta": f"""WITH {RANKED}
SELECT 'run_20240201' AS run_id, 'datasets/run_20240201/' AS dataset_prefix,
       count(*) FILTER (split = 'train') AS train_count, count(*) FILTER (split = 'val') AS val_count,
       '2024-02-01T00:00:00' AS created_at FROM splits""",
    "upsert_raw": f"""WITH {PAIRS}
SELECT batch_num, record_index, "user", assistant, 'pair' AS raw_record, 'pending' AS etl_status FROM pairs
UNION ALL
SELECT conv_id, turn, text, '', role, 'done' FROM conversations WHERE role <> 'user'""",
    "load_insert_absent": """
SELECT doc_id AS source_id, 'stored' AS payload FROM labels
UNION ALL SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "bulk_upsert_stats": f"""WITH {UPSERT}
SELECT count(*) FILTER (NOT has_old) AS inserted,
       count(*) FILTER (has_old AND has_new AND (oq IS DISTINCT FROM nq OR ot IS DISTINCT FROM nt)) AS updated,
       count(*) FILTER (has_old AND has_new AND oq IS NOT DISTINCT FROM nq AND ot IS NOT DISTINCT FROM nt) AS skipped,
       0::BIGINT AS failed FROM sides""",
    "bulk_upsert_overwrite": f"""WITH {UPSERT}
SELECT doc_id, CASE WHEN has_new THEN nq ELSE oq END AS quality, CASE WHEN has_new THEN nt ELSE ot END AS toxic FROM sides""",
    "bulk_upsert_keep": f"""WITH {UPSERT}
SELECT doc_id, CASE WHEN has_old THEN oq ELSE nq END AS quality, CASE WHEN has_old THEN ot ELSE nt END AS toxic FROM sides""",
    "bulk_upsert_keep_stats": f"""WITH {UPSERT}
SELECT count(*) FILTER (NOT has_old) AS inserted, 0::BIGINT AS updated,
       count(*) FILTER (has_old AND has_new) AS skipped, 0::BIGINT AS failed FROM sides""",
    "status_transition": """
SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'done' ELSE 'in_progress' END AS etl_status
FROM documents""",
    "status_log": """
SELECT c_custkey AS doc_id, coalesce(s.status, 'pending') AS etl_status FROM customer
LEFT JOIN (SELECT user_id, arg_max(event_type, {'ts': ts, 'id': event_id}) AS status FROM events GROUP BY 1) s ON user_id = c_custkey""",
    "run_report": f"""WITH {EVALS}
SELECT g.run_id, avg_loss::DECIMAL(18,4)::VARCHAR AS val_loss, perplexity::DECIMAL(18,4)::VARCHAR AS perplexity,
       quality_tier, total_tokens::VARCHAR AS record_count, coalesce(c_name, 'n/a') AS model_s3_prefix,
       coalesce(s_name, 'n/a') AS model_package_arn, coalesce(n_name, 'n/a') AS endpoint_name,
       CASE WHEN n_name IS NULL THEN 'n/a' ELSE 'deployed' END AS deployment_status
FROM graded g LEFT JOIN customer ON 'run_' || c_custkey = run_id
LEFT JOIN supplier ON 'run_' || s_suppkey = run_id LEFT JOIN nation ON 'run_' || n_nationkey = run_id""",
    "extract_pending": f"""WITH {STORE_DOCS}
SELECT 'raw' AS topic, batch_num || ':' || record_index AS key,
       to_json({{'mongo_id': mongo_id, 'batch_num': batch_num, 'record_index': record_index, 'user': "user",
                'assistant': assistant}})::VARCHAR AS value
FROM docs WHERE etl_status = 'pending'""",
    "filter_doc": f"""WITH {STORE_DOCS}
SELECT mongo_id AS doc_id, batch_num, record_index, etl_status FROM docs
WHERE etl_status = 'pending' AND batch_num >= 5 AND batch_num < 60""",
    "etl_transform": f"WITH {TRANSFORMED} SELECT topic, key, value FROM transformed",
    "stream_transform": f"WITH {TRANSFORMED} SELECT topic, key, value FROM transformed",
    "dead_letters": f"WITH {TRANSFORMED} SELECT value FROM transformed WHERE topic = 'dead_letters'",
    "stream_load": f"""WITH {CHECKED}
SELECT mongo_id AS source_id, 'done' AS etl_status, batch_num, record_index,
       to_json({{'conversations': conversations}})::VARCHAR AS line FROM checked WHERE reason IS NULL""",
    "etl_stats": f"""WITH {CHECKED}, held AS (SELECT 'd' || doc_id AS id FROM labels)
SELECT count(*) AS published, count(*) FILTER (reason IS NULL) AS transformed, count(reason) AS failed, count(reason) AS dlq,
       count(*) FILTER (reason IS NULL) AS loaded,
       count(*) FILTER (reason IS NULL AND mongo_id NOT IN (SELECT id FROM held)) AS inserted,
       count(*) FILTER (reason IS NULL AND mongo_id IN (SELECT id FROM held)) AS skipped FROM checked""",
    "pending_leads": f"""WITH {LEADS}
SELECT _id, conversation FROM leads WHERE inference_status = 'pending' ORDER BY _id LIMIT 50""",
    "inference_payloads": f"""WITH {LEADS}
SELECT _id, rid AS request_id,
       '{{"inputs":"' || conversation || '","parameters":{{"max_new_tokens":512,"temperature":0.1,"do_sample":true}}}}' AS payload,
       to_json({{'messages': [{{'role': 'system', 'content': '{SYSTEM}'}},
                {{'role': 'user', 'content': 'Lead conversation:' || chr(10) || conversation}}]}})::VARCHAR AS messages
FROM leads WHERE inference_status = 'pending' AND conversation <> ''""",
    "result_ingest": f"""WITH {RESULTS}
SELECT _id, CASE WHEN sent THEN 'completed' ELSE inference_status END AS inference_status,
       CASE WHEN sent THEN result END AS inference_result, CASE WHEN sent THEN raw END AS inference_raw_output,
       CASE WHEN sent THEN '{DAY}' END AS completed_at FROM results""",
    "result_ingest_stats": f"""WITH {RESULTS}
SELECT count(*) FILTER (sent) AS processed, count(*) FILTER (o_orderstatus = 'O') AS not_found,
       count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority = '5-LOW') AS errors FROM results""",
    "eligible_count": f"""WITH {LEADS}
SELECT count(*) AS eligible_records FROM leads WHERE etl_status = 'processed' AND training_run_id IS NULL""",
    "trigger_gate": f"""WITH {LEADS}
SELECT CASE WHEN count(*) >= 1000 THEN 'triggered' ELSE 'skipped' END AS status,
       CASE WHEN count(*) < 1000 THEN 'below_threshold' END AS reason, count(*) AS eligible_records,
       1000::BIGINT AS threshold FROM leads WHERE etl_status = 'processed' AND training_run_id IS NULL""",
    "mark_queued": f"""WITH {LEADS}, marked AS (
  SELECT *, etl_status = 'processed' AND training_run_id IS NULL AS hit FROM leads)
SELECT _id, CASE WHEN hit THEN 'queued_for_training' ELSE etl_status END AS etl_status,
       CASE WHEN hit THEN 'run_1' ELSE training_run_id END AS training_run_id,
       CASE WHEN hit THEN '{DAY}' END AS queued_at FROM marked""",
    "eval_metrics": f"""WITH {EVALS}
SELECT run_id, avg_loss, round(perplexity, 6) AS perplexity, total_tokens, quality_tier FROM graded""",
    "quality_gate": f"""WITH {EVALS}, gated AS (
  SELECT run_id, CASE WHEN perplexity > 8.0 THEN 'perplexity' WHEN avg_loss > 2.0 THEN 'val_loss'
                      WHEN quality_tier = 'needs_improvement' THEN 'quality_tier' END AS reason FROM graded)
SELECT run_id, reason IS NULL AS passed, reason FROM gated""",
    "prompt_mask": f"""WITH {TOKENS}
SELECT doc_id, len(input_ids)::INTEGER AS n, len(list_filter(labels, lambda x: x <> {IGNORE_LABEL}))::BIGINT AS supervised,
       array_to_string(labels, ' ') AS labels FROM samples""",
    "collate_pad": f"""WITH {TOKENS},
batches AS (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 2 AS batch_id FROM samples),
sized AS (SELECT *, len(input_ids) AS k, max(len(input_ids)) OVER (PARTITION BY batch_id) AS n FROM batches)
SELECT doc_id, batch_id, n::INTEGER AS n,
       md5(array_to_string(list_concat(input_ids, list_transform(range(n - k), lambda x: 0)), ' ')) AS input_ids,
       md5(array_to_string(list_concat(labels, list_transform(range(n - k), lambda x: {IGNORE_LABEL})), ' ')) AS labels,
       md5(array_to_string(list_concat(list_transform(range(k), lambda x: 1), list_transform(range(n - k), lambda x: 0)), ' ')) AS attention_mask
FROM sized""",
    "pack_sequences": f"""WITH {TOKENS},
sharded AS (
  SELECT doc_id, ids, md5('42:' || doc_id) AS h, (('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT % 64)::INTEGER AS shard
  FROM tokens WHERE len(ids) > 0),
placed AS (
  SELECT *, coalesce(sum(len(ids)) OVER (PARTITION BY shard ORDER BY h, doc_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sharded),
flat AS (SELECT shard, start + generate_subscripts(ids, 1) - 1 AS p, unnest(ids) AS id FROM placed)
SELECT shard, (p // {MAX_SEQ_LENGTH})::BIGINT AS chunk, count(*)::INTEGER AS n, md5(string_agg(id, ' ' ORDER BY p)) AS input_ids
FROM flat GROUP BY 1, 2""",
    "metric_windows": f"""
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), {STAMP}) AS window_start, event_type,
       sum(value::DECIMAL(10,2))::DOUBLE AS sum, sum(value::DECIMAL(10,2))::DOUBLE / count(*) AS avg,
       {percentile(0.5)} AS p50, {percentile(0.99)} AS p99
FROM events GROUP BY 1, 2""",
    "metric_windows_daily": f"""
SELECT strftime(date_trunc('day', ts), {STAMP}) AS window_start, sum(value::DECIMAL(10,2))::DOUBLE AS sum,
       count(*) AS count FROM events GROUP BY 1""",
    "alarm_state": f"""
WITH series AS (SELECT event_type, time_bucket(INTERVAL 15 MINUTE, ts) AS w, count(*)::DOUBLE AS s FROM events GROUP BY 1, 2),
spine AS (SELECT event_type, unnest(generate_series(min(w), max(w), INTERVAL 15 MINUTE)) AS w FROM series GROUP BY 1),
filled AS (SELECT event_type, w, s, coalesce(s >= 3, false) AS breach FROM spine LEFT JOIN series USING (event_type, w))
SELECT event_type, strftime(w, {STAMP}) AS window_start, s AS sum,
       CASE WHEN breach AND lag(breach, 1, false) OVER (PARTITION BY event_type ORDER BY w) THEN 'ALARM' ELSE 'OK' END AS state
FROM filled""",
    "budget_alert": """
WITH daily AS (
  SELECT ts::DATE AS d, sum(value::DECIMAL(10,2) * 0.001::DECIMAL(4,3)) AS s FROM events GROUP BY 1),
running AS (SELECT d, sum(s) OVER (PARTITION BY date_trunc('month', d) ORDER BY d)::DOUBLE AS spend_to_date FROM daily)
SELECT date_trunc('month', d)::DATE::VARCHAR AS month, d::VARCHAR AS day, spend_to_date, spend_to_date > 40 AS alert FROM running""",
}

# The same results by way of stored tables and arriving files.
ORACLE |= {
    "stored_upsert": ORACLE["bulk_upsert_overwrite"],
    "stored_upsert_stats": f"""WITH {UPSERT}
SELECT 0::INT AS run, count(*) AS inserted, 0::BIGINT AS updated, 0::BIGINT AS skipped, 0::BIGINT AS failed FROM labels
UNION ALL
SELECT 1, count(*) FILTER (NOT has_old), count(*) FILTER (has_old AND has_new AND (oq, ot) IS DISTINCT FROM (nq, nt)),
       count(*) FILTER (has_old AND has_new AND (oq, ot) IS NOT DISTINCT FROM (nq, nt)), 0 FROM sides
UNION ALL
SELECT 2, 0, 0, count(*), 0 FROM documents""",
    "stored_replace": ORACLE["upsert_raw"],
    "stored_status": ORACLE["status_transition"],
    "result_arrival": ORACLE["result_ingest"],
}

_WRAPPED = r"regexp_replace({}, '([\p{{L}}\p{{N}}_]+)', chr(1) || '\1' || chr(2), 'g')"
_RUN = r"[\p{L}\p{N}_]+"
# Words are set in marks, so that a pattern of names in marks can only meet whole words.
ORACLE["mask_listed_names"] = ORACLE["mask_joined_names"] = f"""
WITH doc_words AS (SELECT doc_id, regexp_extract_all(text, '{_RUN}') AS w FROM documents),
item_words AS (SELECT regexp_extract_all(text, '{_RUN}') AS w FROM benchmark),
names AS (
  SELECT DISTINCT name FROM (
    SELECT unnest(regexp_extract_all(text, '[A-Z][a-z]+')) AS name FROM documents
    UNION ALL SELECT w[i] || ' ' || w[i + 1] FROM item_words, range(1, len(w)) t(i))),
runs AS (
  SELECT doc_id, unnest(w) AS run FROM doc_words
  UNION SELECT doc_id, w[i] || ' ' || w[i + 1] FROM doc_words, range(1, len(w)) t(i)),
found AS (
  SELECT doc_id, string_agg({_WRAPPED.format("run")}, '|' ORDER BY length(run) DESC, run) AS pattern
  FROM runs WHERE run IN (SELECT name FROM names) GROUP BY doc_id)
SELECT doc_id, CASE WHEN pattern IS NULL THEN text
  ELSE translate(regexp_replace({_WRAPPED.format("text")}, pattern, '[NAME]', 'g'), chr(1) || chr(2), '') END AS text
FROM documents LEFT JOIN found USING (doc_id)"""
ORACLE["numbered_lines"] = "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) AS lineno FROM orders"
