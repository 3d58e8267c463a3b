"""DuckDB SQL for each catalog query (the correctness oracle).

Written independently of the Spark code, against the raw driver tables.
DuckDB's ``\\s`` and ``trim`` are ASCII-only, so Python-style stripping is
spelled with the same explicit character class the library uses.
"""

from __future__ import annotations

# Python str.isspace characters as an RE2 class (see quire.functions.text).
_WS = (r"[\t\n\x{0B}\x{0C}\r\x{1C}\x{1D}\x{1E}\x{1F} \x{85}\x{A0}\x{1680}"
       r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
_ERR = r"^Error(?:$|:| during (?:processing|fact check):| \([^)]*\):)"
_LABEL = r"^\s*(?:\d+[.)]\s*)?\(?([A-E])(?:[).:]|\s*$)"
_FATAL = (r"(?:^|[^0-9])(?:400|401|403|404|422)(?:[^0-9]|$)|authentication|permission|not found|"
          r"invalid request")
_RETRY = (r"(?:^|[^0-9])(?:429|5[0-9][0-9])(?:[^0-9]|$)|rate limit|server error|connection error|"
          r"unavailable|timeout|timed out")


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{_WS}+|{_WS}+$', '', 'g')"


def echo(text: str) -> str:
    """Reply of the offline prefix responder for an already stripped text."""
    return f"('A: ' || left({text}, 20) || ' #' || left(md5({text}), 8))"


def is_err(e: str) -> str:
    return f"coalesce(regexp_matches({e}, '{_ERR}'), false)"


Q = ("q AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS qid, conv_id, turn, "
     "text AS question FROM conversations WHERE role = 'user')")
A = ("a AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn - 1 AS VARCHAR) AS qid, "
     "arg_max(text, turn) AS answer FROM conversations WHERE role = 'assistant' GROUP BY 1)")
S = ("s AS (SELECT conv_id, arg_min(text, turn) AS question_prompt FROM conversations "
     "WHERE role = 'system' GROUP BY 1)")
EV = ("ev AS (SELECT event_id, user_id AS qid, CASE WHEN event_type = 'error' THEN 'Error' "
      "ELSE event_type END AS prediction FROM events)")
RUNS = (EV + ", o AS (SELECT qid, arg_max(prediction, event_id) AS p, min(event_id) AS fs FROM ev "
        "WHERE event_id % 2 = 0 GROUP BY 1), r AS (SELECT qid, arg_max(prediction, event_id) AS p, "
        "min(event_id) AS fs FROM ev WHERE event_id % 2 = 1 GROUP BY 1)")
CHUNKS = (f"c AS (SELECT doc_id, list_filter(list_transform(string_split(text, '.'), "
          f"lambda x: {strip('x')}), lambda x: x <> '') AS ch FROM documents)")
STATUS = ("CASE WHEN event_type = 'error' THEN CASE event_id % 5 WHEN 0 THEN 'Error' "
          "WHEN 1 THEN 'Error:RateLimit' WHEN 2 THEN 'Error: No response from step 2' "
          "WHEN 3 THEN 'Error during processing: timeout' ELSE 'Error (run A): failed' END "
          "WHEN event_type = 'view' THEN 'Errors in the clip' ELSE event_type END")
MESSAGE = ("CASE event_type WHEN 'click' THEN 'HTTP 429 Too Many Requests' "
           "WHEN 'error' THEN 'Server error: 503 Service Unavailable' "
           "WHEN 'purchase' THEN '403 Permission denied' "
           "WHEN 'signup' THEN 'Connection error while reading' "
           "ELSE 'Unexpected token in reply' END")
RETRY_CLASS = (f"CASE WHEN m IS NULL THEN NULL WHEN regexp_matches(lower(m), '{_FATAL}') THEN 'fatal' "
               f"WHEN regexp_matches(lower(m), '{_RETRY}') THEN 'retryable' ELSE 'other' END")
PARSE_DEFAULT_CTX = "Error: Failed to parse response"
PARSE_DEFAULT_EXPL = "Could not decode or extract valid fields from the model output."
VOTE_BASE = (
    "per AS (SELECT user_id AS qid, event_type AS label, count(*) AS votes, min(event_id) AS first_pos "
    "FROM events GROUP BY 1, 2), "
    "st AS (SELECT qid, sum(votes) AS n_candidates, count(*) AS n_labels, "
    "max(votes) FILTER (WHERE label <> 'error') AS top FROM per GROUP BY 1), "
    "nt AS (SELECT per.qid, count(*) FILTER (WHERE per.label <> 'error' AND per.votes = st.top) AS n_top "
    "FROM per JOIN st USING (qid) GROUP BY 1), "
    "best AS (SELECT qid, label, votes FROM (SELECT *, row_number() OVER (PARTITION BY qid "
    "ORDER BY votes DESC, first_pos ASC) AS rn FROM per WHERE label <> 'error') WHERE rn = 1)")


def _cache_sql(select: str) -> str:
    return (
        "WITH early AS (SELECT event_type, user_id, event_id, CASE WHEN event_type = 'error' "
        "THEN 'Error' ELSE props END AS answer FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'), "
        f"cache AS (SELECT event_type, user_id, arg_max(answer, event_id) AS answer FROM early "
        f"WHERE NOT {is_err('answer')} GROUP BY 1, 2), "
        "req AS (SELECT event_id, event_type, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00') "
        + select)


SQL = {
    "unanswered": f"WITH {Q}, {A} SELECT q.* FROM q WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.qid = q.qid)",
    "semi_retry": (
        "WITH o AS (SELECT user_id, arg_max(event_type, event_id) AS last FROM events "
        "WHERE event_id % 2 = 0 GROUP BY 1) SELECT event_id, user_id, event_type, value FROM events "
        "WHERE user_id IN (SELECT user_id FROM o WHERE last = 'error')"),
    "error_ids": (
        f"WITH e AS (SELECT user_id AS qid, event_id, {STATUS} AS status FROM events) "
        f"SELECT qid, count(*) AS n_errors, count(*) FILTER (WHERE status = 'Error') AS n_exact, "
        f"min(event_id) AS first_error_seq FROM e WHERE {is_err('status')} GROUP BY 1"),
    "latest_prediction": (
        "SELECT user_id AS qid, arg_max(event_type, event_id) AS prediction, min(event_id) AS first_seq, "
        "count(*) AS n_entries FROM events GROUP BY 1"),
    "retry_overlay": (
        f"WITH {RUNS} SELECT o.qid, CASE WHEN r.qid IS NOT NULL AND {is_err('o.p')} AND NOT {is_err('r.p')} "
        f"THEN r.p ELSE o.p END AS prediction, CASE WHEN r.qid IS NOT NULL AND {is_err('o.p')} AND "
        f"NOT {is_err('r.p')} THEN 'retry' ELSE 'original' END AS source, o.fs AS first_seq "
        f"FROM o LEFT JOIN r ON o.qid = r.qid"),
    "retry_overlay_outer": (
        "WITH e AS (SELECT event_id, user_id AS qid, CASE WHEN event_type = 'error' THEN 'Error: failed' "
        "ELSE event_type END AS v FROM events), "
        "f AS (SELECT user_id AS qid FROM events GROUP BY 1 HAVING arg_min(event_type, event_id) <> 'error'), "
        "o AS (SELECT qid, arg_max(v, event_id) AS p, min(event_id) AS fs FROM e WHERE event_id % 2 = 0 "
        "AND qid IN (SELECT qid FROM f) GROUP BY 1), "
        "r AS (SELECT qid, arg_max(v, event_id) AS p, min(event_id) AS fs FROM e WHERE event_id % 2 = 1 GROUP BY 1) "
        "SELECT coalesce(o.qid, r.qid) AS qid, "
        "CASE WHEN o.qid IS NULL THEN r.p WHEN r.qid IS NOT NULL AND starts_with(o.p, 'Error:') "
        "AND NOT starts_with(r.p, 'Error:') THEN r.p ELSE o.p END AS prediction, "
        "CASE WHEN o.qid IS NULL THEN 'retry_only' WHEN r.qid IS NOT NULL AND starts_with(o.p, 'Error:') "
        "AND NOT starts_with(r.p, 'Error:') THEN 'retry' ELSE 'original' END AS source, "
        "coalesce(o.fs, r.fs) AS first_seq FROM o FULL JOIN r ON o.qid = r.qid"),
    "overlay_counts": (
        f"WITH {RUNS}, j AS (SELECT o.qid AS oq, o.p AS op, r.qid AS rq, r.p AS rp FROM o FULL JOIN r "
        f"ON o.qid = r.qid) SELECT count(*) FILTER (WHERE oq IS NOT NULL) AS n_original, "
        f"count(*) FILTER (WHERE rq IS NOT NULL) AS n_retry, "
        f"count(*) FILTER (WHERE oq IS NOT NULL AND {is_err('op')}) AS n_original_errors, "
        f"count(*) FILTER (WHERE oq IS NOT NULL AND {is_err('op')} AND rq IS NOT NULL AND NOT {is_err('rp')}) "
        f"AS n_updated, count(*) FILTER (WHERE oq IS NOT NULL AND {is_err('op')} AND NOT "
        f"(rq IS NOT NULL AND NOT {is_err('rp')})) AS n_still_failing, "
        f"count(*) FILTER (WHERE oq IS NULL AND rq IS NOT NULL) AS n_retry_only FROM j"),
    "complete_results": (
        f"WITH {Q}, {A} SELECT q.qid, CASE WHEN a.qid IS NULL THEN 'Error: missing result' ELSE a.answer END "
        f"AS answer, a.qid IS NULL AS is_filled FROM q LEFT JOIN a ON a.qid = q.qid"),
    "enrich_left": (
        "SELECT d.doc_id, d.lang, d.source, d.n_chars, CASE WHEN l.doc_id IS NOT NULL THEN l.quality "
        "ELSE CAST(d.n_chars > 500 AS INTEGER) END AS quality, l.toxic FROM documents d "
        "LEFT JOIN labels l ON l.doc_id = d.doc_id"),
    "snapshot_inner": (
        "SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d "
        "JOIN labels l ON l.doc_id = d.doc_id"),
    "prepare_answer_input": (
        f"WITH {Q}, {A}, {S} SELECT q.qid, coalesce(a.answer, q.question) AS corrected_question, "
        f"s.question_prompt AS context, s.question_prompt IS NULL AS missing_context FROM q "
        f"LEFT JOIN a ON a.qid = q.qid LEFT JOIN s ON s.conv_id = q.conv_id"),
    "reorder_to_input": (
        f"WITH {Q}, {A} SELECT q.qid, q.conv_id, row_number() OVER (PARTITION BY q.conv_id ORDER BY q.turn) - 1 "
        f"AS pos, a.answer AS pred FROM q LEFT JOIN a ON a.qid = q.qid"),
    "submission_rows": (
        f"WITH {Q}, {A} SELECT q.qid, coalesce({strip('a.answer')}, '') AS pred FROM q "
        f"LEFT JOIN a ON a.qid = q.qid"),
    "combine_question_prompt": (
        f"WITH {Q}, {S} SELECT q.qid, CASE WHEN s.question_prompt IS NOT NULL AND "
        f"{strip('s.question_prompt')} <> '' THEN coalesce({strip('q.question')}, '') || chr(10) || "
        f"{strip('s.question_prompt')} ELSE coalesce({strip('q.question')}, '') END AS combined "
        f"FROM q LEFT JOIN s ON s.conv_id = q.conv_id"),
    "question_fallback": (
        f"WITH {Q}, {S} SELECT coalesce(q.qid, 'UNKNOWN_QID') AS qid, "
        f"coalesce(s.question_prompt, q.question) AS question, split_part(q.qid, '-', 1) AS media_id, "
        f"CASE WHEN s.question_prompt IS NOT NULL THEN 'prompt' ELSE 'question' END AS prompt_source "
        f"FROM q LEFT JOIN s ON s.conv_id = q.conv_id"),
    "context_chunks": (
        f"WITH {CHUNKS} SELECT doc_id, CAST(unnest(range(len(ch))) AS INTEGER) AS pos, "
        "unnest(ch) AS chunk FROM c"),
    "bullet_context": (
        f"WITH {CHUNKS}, b AS (SELECT doc_id, array_to_string(list_transform(ch, lambda x: '- ' || x), chr(10)) "
        f"AS b FROM c) SELECT doc_id, CAST(length(b) AS INTEGER) AS bullet_len, md5(b) AS bullet_md5 FROM b"),
    "clean_rewrite": (
        "WITH b AS (SELECT item_id, CASE item_id % 4 WHEN 0 THEN 'REWRITTEN question: \"' || text || '\"' "
        "WHEN 1 THEN 'Rewritten Question:' || chr(10) || text || chr(10) WHEN 2 THEN '\"' || text || '\"' "
        f"ELSE '  ' || text END AS reply FROM benchmark), s AS (SELECT item_id, {strip('reply')} AS r FROM b) "
        "SELECT item_id, CASE WHEN lower(left(r, 19)) = 'rewritten question:' THEN "
        "regexp_replace(substr(r, 20), '^[ \"\\n]+|[ \"\\n]+$', '', 'g') ELSE r END AS cleaned FROM s"),
    "rewrite_or_fallback": (
        "WITH b AS (SELECT item_id, text AS question, CASE item_id % 4 WHEN 0 THEN lower(text) WHEN 1 THEN '' "
        "WHEN 2 THEN 'Rewritten question: ' || text || ' Why?' ELSE text END AS reply FROM benchmark), "
        f"s AS (SELECT item_id, question, {strip('reply')} AS r FROM b), "
        "w AS (SELECT item_id, question, CASE WHEN lower(left(r, 19)) = 'rewritten question:' THEN "
        "regexp_replace(substr(r, 20), '^[ \"\\n]+|[ \"\\n]+$', '', 'g') ELSE r END AS rw FROM s), "
        "t AS (SELECT item_id, question, rw, CASE WHEN rw IS NULL OR rw = '' THEN 'empty' "
        "WHEN lower(rw) = lower(question) THEN 'unchanged' ELSE 'changed' END AS rewrite_status FROM w) "
        "SELECT item_id, CASE WHEN rewrite_status = 'changed' THEN rw ELSE question END AS final_question, "
        "rewrite_status FROM t"),
    "rewrite_summary": None,  # filled below from rewrite_or_fallback
    "parse_reply": (
        "WITH e AS (SELECT event_id, '{\"context\": \"' || event_type || '\", \"is_contextual\": ' || "
        "CASE WHEN event_type = 'purchase' THEN 'true' ELSE 'false' END || ', \"explanation\": \"user ' || "
        "CAST(user_id AS VARCHAR) || '\"' AS base, "
        "CASE WHEN event_type = 'purchase' THEN 'true' ELSE 'false' END AS flag FROM events), "
        "r AS (SELECT event_id, CASE event_id % 6 "
        "WHEN 0 THEN base || ', \"corrected_question\": \"q' || CAST(event_id AS VARCHAR) || '\"}' "
        "WHEN 1 THEN '```json' || chr(10) || base || '}' || chr(10) || '```' "
        "WHEN 2 THEN '```' || chr(10) || replace(base, '\": ' || flag, '\": \"' || flag || '\"') || '}```' "
        "WHEN 3 THEN base WHEN 4 THEN '{\"context\": null, \"is_contextual\": 1}' ELSE '' END AS reply FROM e), "
        f"s0 AS (SELECT event_id, reply, {strip('reply')} AS s FROM r), "
        f"s1 AS (SELECT event_id, reply, CASE WHEN starts_with(s, '```json') THEN {strip('substr(s, 8)')} "
        f"ELSE s END AS s FROM s0), "
        f"s2 AS (SELECT event_id, reply, CASE WHEN starts_with(s, '```') THEN {strip('substr(s, 4)')} "
        f"ELSE s END AS s FROM s1), "
        "s3 AS (SELECT event_id, reply, CASE WHEN ends_with(s, '```') THEN left(s, length(s) - 3) ELSE s END "
        "AS s FROM s2), "
        "k0 AS (SELECT event_id, s, coalesce(s <> '' AND json_valid(s), false) AS v FROM s3), "
        "k1 AS (SELECT event_id, CASE WHEN v THEN s END AS s FROM k0), "
        "k AS (SELECT event_id, s, coalesce(json_type(s) = 'OBJECT', false) AS ok FROM k1) "
        f"SELECT event_id, CASE WHEN ok THEN coalesce(json_extract_string(s, '$.context'), '{PARSE_DEFAULT_CTX}') "
        f"ELSE '{PARSE_DEFAULT_CTX}' END AS context, "
        "CASE WHEN ok AND json_type(s, '$.is_contextual') = 'BOOLEAN' THEN "
        "CAST(json_extract(s, '$.is_contextual') AS BOOLEAN) ELSE false END AS is_contextual, "
        f"CASE WHEN ok THEN coalesce(json_extract_string(s, '$.explanation'), '{PARSE_DEFAULT_EXPL}') "
        f"ELSE '{PARSE_DEFAULT_EXPL}' END AS explanation, "
        "CASE WHEN ok THEN json_extract_string(s, '$.corrected_question') END AS corrected_question FROM k"),
    "parse_verdict": (
        "WITH r AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{\"is_supported\": ' || "
        "CASE WHEN event_type IN ('click', 'purchase') THEN 'true' ELSE 'false' END || "
        "', \"explanation\": \"seen ' || event_type || '\"}' WHEN 1 THEN '{\"is_supported\": \"true\"}' "
        "WHEN 2 THEN '{\"explanation\": \"only ' || event_type || '\"}' ELSE ' not json ' || event_type END "
        f"AS reply FROM events), s AS (SELECT event_id, {strip('reply')} AS s FROM r), "
        "k0 AS (SELECT event_id, s, CASE WHEN json_valid(s) THEN s END AS js FROM s), "
        "k AS (SELECT event_id, s, js, coalesce(json_type(js) = 'OBJECT', false) AS ok FROM k0) "
        "SELECT event_id, CASE WHEN ok AND json_type(js, '$.is_supported') = 'BOOLEAN' THEN "
        "CAST(json_extract(js, '$.is_supported') AS BOOLEAN) ELSE false END AS is_supported, "
        "CASE WHEN ok THEN coalesce(json_extract_string(js, '$.explanation'), 'No explanation provided.') "
        "ELSE 'Error during fact check: Failed to parse JSON from model. Raw reply:' || chr(10) || s END "
        "AS explanation FROM k"),
    "reply_status": (
        "WITH r AS (SELECT event_id, CASE WHEN event_type = 'signup' THEN '   ' WHEN event_type = 'error' "
        "THEN NULL ELSE ' answer ' || event_type || ' ' END AS reply, CASE WHEN event_type = 'error' THEN "
        "'RuntimeError: ' || repeat(props, 10) END AS err FROM events) "
        "SELECT event_id, CASE WHEN err IS NOT NULL THEN 'Error during processing: ' || left(err, 100) "
        f"WHEN nullif({strip('reply')}, '') IS NULL THEN 'Error: No response from best-answer selection (Step 2).' "
        f"ELSE {strip('reply')} END AS status FROM r"),
    "retry_class": f"SELECT event_id, {RETRY_CLASS} AS retry_class FROM (SELECT event_id, {MESSAGE} AS m FROM events)",
    "validate_rows": (
        "WITH r AS (SELECT doc_id, CASE WHEN doc_id % 7 <> 3 THEN source END AS q, CASE doc_id % 7 "
        "WHEN 4 THEN NULL WHEN 5 THEN ' . .' ELSE text END AS c FROM documents) "
        "SELECT doc_id, CASE WHEN q IS NULL THEN 'missing_question' WHEN c IS NULL THEN 'null_context' "
        "WHEN len(list_filter(string_split(c, '.'), "
        f"lambda x: {strip('x')} <> '')) = 0 THEN 'no_chunks' END AS skip_reason FROM r"),
    "group_questions": (
        f"WITH {Q} SELECT conv_id, count(*) AS n_questions, min(turn) AS first_pos, max(turn) AS last_pos, "
        f"arg_min(qid, turn) AS first_qid FROM q GROUP BY 1"),
    "video_batches": (
        f"WITH {Q}, g AS (SELECT conv_id, count(*) AS n_questions, min(turn) AS first_pos, max(turn) AS last_pos, "
        f"arg_min(qid, turn) AS first_qid FROM q GROUP BY 1), "
        f"o AS (SELECT *, row_number() OVER (ORDER BY first_pos, conv_id) - 1 AS group_order FROM g), "
        f"b AS (SELECT *, CAST(group_order // 7 AS BIGINT) AS batch_idx FROM o) "
        f"SELECT *, count(*) OVER (PARTITION BY batch_idx) AS n_in_batch FROM b"),
    "filter_group": "SELECT conv_id, turn, role, text FROM conversations WHERE conv_id = 7",
    "candidate_rows": (
        "WITH r AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), "
        "lambda x, i: CASE (i - 1) % 4 WHEN 0 THEN '1. ' || x WHEN 1 THEN 'A) ' || x "
        "WHEN 2 THEN '(B) ' || x ELSE x END), chr(10)) AS reply FROM documents), "
        "l AS (SELECT doc_id, unnest(string_split(reply, chr(10))) AS line, "
        "unnest(range(len(string_split(reply, chr(10))))) AS pos FROM r) "
        "SELECT doc_id, CAST(pos AS INTEGER) AS pos, line AS text, "
        f"nullif(regexp_extract(line, '{_LABEL}', 1), '') AS label FROM l WHERE {strip('line')} <> ''"),
    "answer_format": (
        "WITH e AS (SELECT event_id, value >= 25 AS mc, CASE event_type WHEN 'click' THEN 'A' WHEN 'purchase' "
        "THEN 'B' WHEN 'signup' THEN 'C' WHEN 'view' THEN 'D' ELSE 'E' END AS l FROM events), "
        "a AS (SELECT event_id, coalesce(mc, false) AS mc, CASE event_id % 3 WHEN 0 THEN l WHEN 1 THEN l || '.' "
        "ELSE 'The answer is ' || l END AS ans FROM e) "
        f"SELECT event_id, mc AS checked, CASE WHEN mc THEN coalesce(regexp_matches({strip('ans')}, '^[A-E]$'), "
        f"false) END AS valid, CASE WHEN mc THEN nullif(regexp_extract({strip('ans')}, '{_LABEL}', 1), '') END "
        f"AS normalized FROM a"),
    "media_lookup": (
        "WITH p AS (SELECT split_part(url, '/', 3) AS host, page_id, url FROM pages), "
        "f AS (SELECT host, min(page_id) AS first_page_id, arg_min(url, page_id) AS first_url, "
        "count(*) AS n_pages FROM p GROUP BY 1), m AS (SELECT DISTINCT host FROM p WHERE ends_with(url, '.html')) "
        "SELECT f.host, f.first_page_id, f.first_url, f.n_pages, m.host IS NOT NULL AS has_media, "
        "CASE WHEN m.host IS NOT NULL THEN 'media/' || f.host || '.mp4' END AS media_path "
        "FROM f LEFT JOIN m ON m.host = f.host"),
    "candidate_vote": (
        f"WITH {VOTE_BASE} SELECT st.qid, best.label AS winner, coalesce(best.votes, 0) AS votes, "
        "st.n_candidates, st.n_labels, round(coalesce(best.votes, 0) / st.n_candidates, 6) AS share, "
        "nt.n_top, st.n_labels = 1 AS all_same, CASE WHEN best.qid IS NULL THEN 'all_none' "
        "WHEN nt.n_top > 1 THEN 'tie' ELSE 'ok' END AS status FROM st JOIN nt ON nt.qid = st.qid "
        "LEFT JOIN best ON best.qid = st.qid"),
    "vote_status": (
        f"WITH {VOTE_BASE} SELECT st.qid, CASE WHEN nt.n_top > 1 THEN 'error' ELSE best.label END AS winner, "
        "CASE WHEN best.qid IS NULL THEN 'all_none' WHEN nt.n_top > 1 THEN 'tie' ELSE 'ok' END AS status, "
        "st.n_labels = 1 AS all_same FROM st JOIN nt ON nt.qid = st.qid LEFT JOIN best ON best.qid = st.qid"),
    "accuracy": (
        "WITH j AS (SELECT CAST(d.n_chars > 500 AS INTEGER) AS pred, l.quality FROM documents d "
        "JOIN labels l ON l.doc_id = d.doc_id) SELECT count(*) AS n, "
        "count(*) FILTER (WHERE coalesce(pred = quality, false)) AS n_correct, "
        "round(count(*) FILTER (WHERE coalesce(pred = quality, false)) / count(*), 6) AS accuracy FROM j"),
    "accuracy_by_group": (
        "WITH j AS (SELECT d.lang, d.source, CAST(d.n_chars > 500 AS INTEGER) AS pred, l.quality FROM documents d "
        "JOIN labels l ON l.doc_id = d.doc_id) SELECT CASE WHEN grouping(lang) = 0 THEN 'lang' "
        "WHEN grouping(source) = 0 THEN 'source' ELSE 'total' END AS dimension, "
        "CASE WHEN grouping(lang) = 0 THEN lang WHEN grouping(source) = 0 THEN source END AS value, "
        "count(*) AS n, count(*) FILTER (WHERE coalesce(pred = quality, false)) AS n_correct, "
        "round(count(*) FILTER (WHERE coalesce(pred = quality, false)) / count(*), 6) AS accuracy "
        "FROM j GROUP BY GROUPING SETS ((lang), (source), ())"),
    "compare_runs": (
        f"WITH {RUNS}, j AS (SELECT o.qid AS a, o.p AS ap, r.qid AS b, r.p AS bp FROM o FULL JOIN r "
        f"ON o.qid = r.qid) SELECT CASE WHEN b IS NULL THEN 'only_a' WHEN a IS NULL THEN 'only_b' "
        f"WHEN {is_err('ap')} AND {is_err('bp')} THEN 'both_error' WHEN {is_err('ap')} THEN 'a_error' "
        f"WHEN {is_err('bp')} THEN 'b_error' WHEN ap IS NOT DISTINCT FROM bp THEN 'agree' ELSE 'changed' END "
        f"AS outcome, count(*) AS n FROM j GROUP BY 1"),
    "progress": (
        f"WITH {Q}, {A}, j AS (SELECT q.conv_id, a.qid IS NOT NULL AS done FROM q LEFT JOIN "
        f"(SELECT DISTINCT qid FROM a) a ON a.qid = q.qid) SELECT conv_id, count(*) AS total, "
        f"count(*) FILTER (WHERE done) AS answered, "
        f"round(count(*) FILTER (WHERE done) / count(*), 6) AS ratio FROM j GROUP BY ROLLUP (conv_id)"),
    "run_metrics": (
        "WITH m AS (SELECT event_type AS step, count(*) AS n_calls, round(sum(value), 6) AS total_s, "
        "round(avg(value), 6) AS avg_s, round(max(value), 6) AS max_s FROM events GROUP BY 1) "
        "SELECT *, CAST(floor(total_s / 60) AS BIGINT) AS total_min, "
        "CAST(floor(total_s - 60 * floor(total_s / 60)) AS BIGINT) AS total_sec FROM m"),
    "cache_hits": _cache_sql(
        "SELECT req.event_id, req.event_type, req.user_id, cache.answer FROM req JOIN cache "
        "ON cache.event_type = req.event_type AND cache.user_id = req.user_id"),
    "cache_misses": _cache_sql(
        "SELECT DISTINCT req.event_type, req.user_id FROM req WHERE NOT EXISTS (SELECT 1 FROM cache "
        "WHERE cache.event_type = req.event_type AND cache.user_id = req.user_id)"),
    "repeat_passes": f"WITH {Q} SELECT q.qid, CAST(p.range AS BIGINT) AS pass_idx FROM q CROSS JOIN range(3) p",
    "append_log": (
        f"WITH {EV}, l AS (SELECT qid, 'original' AS run FROM ev WHERE event_id % 2 = 0 UNION ALL "
        f"SELECT qid, 'retry' AS run FROM ev WHERE event_id % 2 = 1) SELECT qid, "
        f"count(*) FILTER (WHERE run = 'original') AS n_original, count(*) FILTER (WHERE run = 'retry') "
        f"AS n_retry, count(*) AS n_total FROM l GROUP BY 1"),
    "backoff_schedule": (
        f"WITH e AS (SELECT event_id, {MESSAGE} AS m FROM events), c AS (SELECT event_id, "
        f"CASE WHEN event_id % 2 = 0 THEN 5.0 ELSE 2.0 END AS initial_s FROM e WHERE ({RETRY_CLASS}) = 'retryable') "
        f"SELECT event_id, CAST(a.range AS BIGINT) AS attempt, CAST(initial_s * pow(2.0, a.range) AS DOUBLE) "
        f"AS delay_s FROM c CROSS JOIN range(3) a"),
    "preview_text": "SELECT doc_id, left(text, 150) || '...' AS preview FROM documents",
    "infer_replay": (
        f"WITH {Q} SELECT qid, {echo(strip('question'))} AS reply, CAST(NULL AS VARCHAR) AS error, "
        f"1 AS attempts FROM q"),
    "answer_run": (
        f"WITH {Q} SELECT qid, conv_id, turn, {echo(strip('question'))} AS pred FROM q"),
    "interrupted_run": (
        f"WITH {Q} SELECT qid, {echo(strip('question'))} AS prediction, CAST(1 AS BIGINT) AS n_logged FROM q"),
    "stream_resume": (
        f"WITH {Q}, t AS (SELECT *, length({strip('question')}) % 4 = 0 AND turn <> 0 AS lost FROM q) "
        f"SELECT qid, CASE WHEN NOT lost THEN {echo(strip('question'))} END AS reply, "
        "CASE WHEN lost THEN 'RuntimeError: 403 permission denied' END AS error, "
        f"CAST(CASE WHEN length({strip('question')}) % 4 = 0 AND turn = 0 THEN 2 ELSE 1 END AS BIGINT) AS asked "
        "FROM t"),
    "infer_attempts": (
        f"WITH {Q} SELECT qid, {echo(strip('question'))} AS reply, CAST(NULL AS VARCHAR) AS error, "
        f"CASE WHEN unicode(left(md5({strip('question')}), 1)) % 2 = 0 THEN 2 ELSE 1 END AS attempts FROM q"),
    "three_rounds": (
        f"WITH {Q}, t AS (SELECT qid, {strip('question')} AS s FROM q), "
        "r AS (SELECT *, CASE WHEN length(s) % 2 <> 0 THEN 0 WHEN length(s) % 4 <> 0 THEN 1 ELSE 2 END "
        "AS round_no FROM t) SELECT qid, substr('ABC', round_no + 1, 1) || substr("
        f"{echo('s')}, 2) AS prediction, round_no FROM r"),
    "compacted_log": (
        f"WITH {Q}, t AS (SELECT qid, {strip('question')} AS s FROM q), "
        "r AS (SELECT *, CASE WHEN length(s) % 2 <> 0 THEN 0 WHEN length(s) % 4 <> 0 THEN 1 ELSE 2 END "
        "AS round_no FROM t) SELECT qid, substr('ABC', round_no + 1, 1) || substr("
        f"{echo('s')}, 2) AS prediction, round_no, "
        "CAST(CASE round_no WHEN 0 THEN 1 ELSE 2 END AS BIGINT) AS n_kept FROM r"),
    "error_structs": (
        f"WITH e AS (SELECT event_id, {MESSAGE} AS m, event_id % 5 AS k FROM events) "
        "SELECT event_id, CASE k WHEN 0 THEN 'Error: Processing failed after retries' "
        "WHEN 1 THEN 'Error: Task failed during concurrent execution' "
        "WHEN 2 THEN 'Error: Batch processing failed' WHEN 3 THEN 'Error' "
        f"ELSE '{PARSE_DEFAULT_CTX}' END AS context, false AS is_contextual, "
        "CASE k WHEN 0 THEN 'Failed after 3 retries. Last error: ' || m "
        "WHEN 1 THEN 'Result was missing after asyncio.gather, likely due to an unhandled exception.' "
        "WHEN 2 THEN 'Error during batch processing: ' || m WHEN 3 THEN 'Error during processing: ' || m "
        f"ELSE '{PARSE_DEFAULT_EXPL}' END AS explanation, true AS failed FROM e"),
    "media_answers": (
        f"WITH {Q}, t AS (SELECT qid, conv_id, {strip('question')} AS s FROM q) "
        "SELECT qid, CASE WHEN conv_id % 2 = 0 THEN 'file ' || conv_id ELSE 'https://v/' || conv_id END "
        "|| ': ' || left(md5(s), 8) AS reply, CAST(NULL AS VARCHAR) AS error FROM t"),
    "media_tree": (
        "SELECT lang, source, CAST(sum(coalesce(strlen(text), 0) + 1) AS BIGINT) AS total_bytes "
        "FROM documents GROUP BY 1, 2"),
    "json_array_items": (
        "SELECT CASE WHEN role <> 'assistant' THEN conv_id || '-' || turn END AS qid, "
        "text AS question, CASE WHEN role = 'user' THEN CAST(turn AS BIGINT) END AS turn, "
        "CASE role WHEN 'user' THEN NULL WHEN 'assistant' THEN 'not an object' "
        "ELSE 'wrong type' END AS reject FROM conversations"),
    "json_tables": f"WITH {Q}, {A} SELECT q.qid, q.question, a.answer FROM q LEFT JOIN a ON a.qid = q.qid",
    "run_log": (
        f"WITH {Q}, t AS (SELECT length({strip('question')}) AS n FROM q), "
        "r AS (SELECT 0 AS run_id FROM t UNION ALL SELECT 1 FROM t WHERE n % 2 = 0 "
        "UNION ALL SELECT 2 FROM t WHERE n % 4 = 0) "
        "SELECT run_id, count(*) AS n_calls, count(*) AS n_attempts FROM r GROUP BY 1"),
    "clamped_candidates": (
        "SELECT event_id, least(greatest(coalesce(CASE WHEN event_type <> 'view' THEN user_id - 20 END, 8), 1), 32) "
        "AS n FROM events"),
    "group_keys": "SELECT page_id, url AS group_key FROM pages",
    "index_in_group": (
        f"WITH {Q} SELECT qid, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx_in_group FROM q"),
    "nan_values": "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events",
    "open_vote": (
        "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, "
        "unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents), "
        f"c AS (SELECT doc_id, pos, coalesce(nullif(regexp_extract(line, '{_LABEL}', 1), ''), nullif(lower("
        + strip(r"regexp_replace(line, '^\s*\d+[.)]\s*', '')") +
        f"), '')) AS label FROM l WHERE {strip('line')} <> ''), "
        "per AS (SELECT doc_id, label, count(*) AS votes, min(pos) AS first_pos FROM c "
        "WHERE label IS NOT NULL GROUP BY ALL), "
        "best AS (SELECT doc_id, label, votes FROM (SELECT *, row_number() OVER (PARTITION BY doc_id "
        "ORDER BY votes DESC, first_pos, label DESC) AS rn FROM per WHERE label <> 'E') WHERE rn = 1), "
        "st AS (SELECT doc_id, CAST(sum(votes) AS BIGINT) AS n_candidates, count(*) AS n_labels FROM per "
        "GROUP BY 1) SELECT st.doc_id, md5(best.label) AS winner_md5, coalesce(best.votes, 0) AS votes, "
        "n_candidates, n_labels FROM st LEFT JOIN best ON best.doc_id = st.doc_id"),
    "multiple_choice": (
        "WITH r AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), "
        "lambda x, i: CASE (i - 1) % 4 WHEN 0 THEN '1. ' || x WHEN 1 THEN 'A) ' || x "
        "WHEN 2 THEN '(B) ' || x ELSE x END), chr(10)) AS reply FROM documents) "
        "SELECT doc_id, len(list_filter(string_split(coalesce(reply, ''), chr(10)), "
        f"lambda x: regexp_extract(x, '{_LABEL}', 1) <> '')) >= 2 AS is_mc FROM r"),
}

SQL["rewrite_summary"] = (
    "WITH x AS (" + SQL["rewrite_or_fallback"] + ") SELECT count(*) AS n_total, "
    "count(*) FILTER (WHERE rewrite_status = 'changed') AS n_changed, "
    "count(*) FILTER (WHERE rewrite_status = 'unchanged') AS n_unchanged, "
    "count(*) FILTER (WHERE rewrite_status = 'empty') AS n_empty, "
    "count(*) FILTER (WHERE rewrite_status <> 'changed') AS n_failed FROM x")


def _lit(text: str) -> str:
    """A SQL expression for a Python string (newlines as chr(10))."""
    parts = text.split("\n")
    pieces = []
    for i, p in enumerate(parts):
        if p:
            pieces.append("'" + p.replace("'", "''") + "'")
        if i < len(parts) - 1:
            pieces.append("chr(10)")
    return " || ".join(pieces) if pieces else "''"


def template_sql(template: str, **slots: str) -> str:
    """The template as one SQL concatenation, slots replaced by expressions."""
    import string

    out = []
    for literal, field, _, _ in string.Formatter().parse(template):
        if literal:
            out.append(_lit(literal))
        if field is not None:
            out.append(f"coalesce(CAST({slots[field]} AS VARCHAR), '')")
    return "(" + " || ".join(out) + ")"


#: Character i (from 0) of a prompt digest as a number; the prompt of a model that
#: refuses for good; and what the call's failure says.
def _at(digest: str, i: int) -> str:
    return f"unicode(substr({digest}, {i + 1}, 1))"


REFUSED = "RuntimeError: 403 permission denied"
VOTE = (
    "per AS (SELECT qid, label, count(*) AS votes, min(pos) AS first_pos FROM c GROUP BY 1, 2), "
    "st AS (SELECT qid, sum(votes) AS n_candidates, max(votes) FILTER (WHERE label <> 'E') AS top "
    "FROM per GROUP BY 1), "
    "nt AS (SELECT per.qid, count(*) FILTER (WHERE per.label <> 'E' AND per.votes = st.top) AS n_top "
    "FROM per JOIN st ON st.qid = per.qid GROUP BY 1), "
    "best AS (SELECT qid, label, votes FROM (SELECT *, row_number() OVER (PARTITION BY qid "
    "ORDER BY votes DESC, first_pos ASC) AS rn FROM per WHERE label <> 'E') WHERE rn = 1) "
    "SELECT st.qid, best.label AS winner, coalesce(best.votes, 0) AS votes, st.n_candidates, "
    "CASE WHEN best.qid IS NULL THEN 'all_none' WHEN nt.n_top > 1 THEN 'tie' ELSE 'ok' END AS status "
    "FROM st JOIN nt ON nt.qid = st.qid LEFT JOIN best ON best.qid = st.qid")


def _letter(digest: str, i: int) -> str:
    return f"substr('ABCDE', CAST({_at(digest, i)} % 5 AS INTEGER) + 1, 1)"


def _context_sql(d: str) -> str:
    """Columns of the parsed context reply to a prompt of digest ``d``."""
    return (f"'seen ' || repeat({d} || ' ', 5) || {d} AS context, {_at(d, 1)} % 2 = 0 AS is_contextual, "
            "'len ' || CAST(length(prompt) AS VARCHAR) AS explanation")


def _rewrite_sql(items: str, failing: bool) -> str:
    """Rewrites of ``items`` (a CTE i with qid, qs, context)."""
    from quire.functions.prompts import REWRITE_TEMPLATE

    bullets = "array_to_string(list_transform(ch, lambda x: '- ' || x), chr(10))"
    rw = template_sql(REWRITE_TEMPLATE, context=bullets, question="qs")
    refused = f"{_at('dg', 2)} % 4 = 0" if failing else "false"
    cleaned = ("CASE WHEN lower(left(r, 19)) = 'rewritten question:' THEN "
               "regexp_replace(substr(r, 20), '^[ \"\\n]+|[ \"\\n]+$', '', 'g') ELSE r END")
    return (
        f"{items}, ch AS (SELECT *, list_filter(list_transform(string_split(context, '.'), "
        f"lambda x: {strip('x')}), lambda x: x <> '') AS ch FROM i), "
        "v AS (SELECT *, CASE WHEN qs IS NULL THEN 'missing_question' WHEN context IS NULL THEN "
        "'null_context' WHEN len(ch) = 0 THEN 'no_chunks' END AS skip_reason FROM ch), "
        f"p AS (SELECT *, md5({rw}) AS dg FROM v WHERE skip_reason IS NULL), "
        f"r AS (SELECT *, {refused} AS refused, CASE {_at('dg', 0)} % 3 WHEN 0 THEN 'Rewritten question: \"' "
        "|| qs || ' (in the clip ' || left(dg, 8) || ')\"' WHEN 1 THEN lower(qs) ELSE '' END AS reply FROM p), "
        f"c AS (SELECT *, CASE WHEN NOT refused THEN {strip('reply')} END AS r FROM r), "
        f"d AS (SELECT *, {cleaned} AS rr FROM c), "
        "s AS (SELECT *, CASE WHEN rr IS NULL OR rr = '' THEN 'empty' WHEN lower(rr) = lower(qs) "
        "THEN 'unchanged' ELSE 'changed' END AS st FROM d), "
        "rewritten AS (SELECT qid, CAST(NULL AS VARCHAR) AS skip_reason, array_to_string(ch, '|') AS context, "
        "CASE WHEN st = 'changed' THEN rr ELSE qs END AS final_question, "
        "CASE WHEN refused THEN 'error' ELSE st END AS rewrite_status, "
        f"CASE WHEN refused THEN '{REFUSED}' END AS error FROM s "
        "UNION ALL SELECT qid, skip_reason, array_to_string(ch, '|') AS context, qs AS final_question, "
        "'skipped' AS rewrite_status, CAST(NULL AS VARCHAR) AS error FROM v WHERE skip_reason IS NOT NULL)")


def _run_sql():
    from quire.functions.prompts import (AGGREGATE_TEMPLATE, ANSWER_TEMPLATE, CANDIDATES_TEMPLATE,
                                         CONTEXT_TEMPLATE, FACT_CHECK_TEMPLATE)

    qs = strip("q.question")
    cand = template_sql(CANDIDATES_TEMPLATE, question=qs, n="4")
    two_step = (
        f"WITH {Q}, p AS (SELECT qid, md5({cand}) AS dg FROM q), "
        "c AS (SELECT qid, t.i AS pos, substr('ABCDE', CAST(unicode(substr(dg, CAST(t.i + 1 AS BIGINT), 1)) "
        "% 5 AS INTEGER) + 1, 1) AS label FROM p CROSS JOIN (SELECT range AS i FROM range(4)) t), " + VOTE)
    lines = " || chr(10) || ".join(f"'{i + 1}. ' || {_letter('dg', i)}" for i in range(4))
    agg = template_sql(AGGREGATE_TEMPLATE, question="qs", candidates="thoughts", n="4")

    def model(refused: str) -> str:
        return (
            f"WITH {Q}, p AS (SELECT qid, {qs} AS qs, md5({cand}) AS dg FROM q), "
            f"t AS (SELECT qid, qs, dg, {lines} AS thoughts, {refused} AS refused FROM p), "
            f"g AS (SELECT *, md5({agg}) AS ag FROM t) "
            f"SELECT qid, CASE WHEN refused THEN 'Error during processing: {REFUSED}' ELSE "
            f"substr('ABCDE', CAST(unicode(substr(dg, CAST({_at('ag', 0)} % 4 + 1 AS BIGINT), 1)) % 5 AS "
            "INTEGER) + 1, 1) END AS answer, CASE WHEN NOT refused THEN thoughts END AS thoughts FROM g")

    ctx = template_sql(CONTEXT_TEMPLATE, question=qs)
    seen = f"x AS (SELECT *, md5(prompt) AS dg FROM (SELECT q.*, {ctx} AS prompt FROM q))"
    context = (f"WITH {Q}, {seen} SELECT qid, conv_id, turn, {_context_sql('dg')}, "
               "CAST(NULL AS VARCHAR) AS corrected_question FROM x")
    lost = f"{_at('dg', 2)} % 4 = 0"
    context_failures = (
        f"WITH {Q}, {seen}, y AS (SELECT *, {_context_sql('dg')}, {lost} AS lost FROM x) "
        "SELECT qid, conv_id, turn, CASE WHEN lost THEN 'Error: Processing failed after retries' "
        "ELSE context END AS context, NOT lost AND is_contextual AS is_contextual, "
        "CASE WHEN lost THEN 'Failed after 2 retries. Last error: RuntimeError: 529 overloaded' "
        "ELSE explanation END AS explanation FROM y")
    batch_failures = (
        f"WITH {Q}, {seen}, g AS (SELECT conv_id, row_number() OVER (ORDER BY min(turn), conv_id) - 1 AS rn, "
        "count(*) OVER () AS n FROM q GROUP BY conv_id), "
        f"y AS (SELECT x.*, {_context_sql('dg')}, rn // CAST(ceil(n / 6.0) AS BIGINT) = 2 AS died "
        "FROM x JOIN g ON g.conv_id = x.conv_id) "
        "SELECT qid, conv_id, turn, CASE WHEN died THEN 'Error: Batch processing failed' ELSE context END "
        "AS context, NOT died AND is_contextual AS is_contextual, CASE WHEN died THEN "
        "'Error during batch processing: RuntimeError: the model client cannot start' ELSE explanation END "
        "AS explanation FROM y")
    retry_old_run = (
        f"WITH {Q}, {seen} SELECT qid, conv_id, turn, {_context_sql('dg')}, {lost} AS asked_again FROM x")
    fc = template_sql(FACT_CHECK_TEMPLATE, question=qs, answer=strip("a.answer"))

    def fact(refused: str) -> str:
        return (
            f"WITH {Q}, {A}, p AS (SELECT q.qid, md5({fc}) AS dg FROM q JOIN a ON a.qid = q.qid), "
            f"f AS (SELECT *, {refused} AS refused, {_at('dg', 0)} % 5 = 0 AS vague FROM p) "
            f"SELECT qid, NOT refused AND NOT vague AND {_at('dg', 1)} % 2 = 0 AS is_supported, "
            f"CASE WHEN refused THEN 'Error during fact check: {REFUSED}' WHEN vague THEN "
            "'Error during fact check: Failed to parse JSON from model. Raw reply:' || chr(10) "
            "|| 'I think so.' ELSE 'checked ' || dg END AS explanation FROM f")

    answered = f"i AS (SELECT q.qid, {qs} AS qs, a.answer AS context FROM q LEFT JOIN a ON a.qid = q.qid)"

    def rewrite(failing: bool) -> str:
        return f"WITH {Q}, {A}, " + _rewrite_sql(answered, failing) + " SELECT * FROM rewritten"

    rewrite_resume = (
        f"WITH {Q}, {A}, " + _rewrite_sql(answered, False) +
        " SELECT r.qid, 'https://v/' || conv_id AS youtube_url, CAST(conv_id AS VARCHAR) AS video_id, "
        f"{qs} AS question, skip_reason, r.context, final_question AS corrected_question, rewrite_status, error "
        "FROM rewritten r JOIN q ON q.qid = r.qid")
    combined = (f"CASE WHEN s.question_prompt IS NOT NULL AND {strip('s.question_prompt')} <> '' THEN "
                f"coalesce({qs}, '') || chr(10) || {strip('s.question_prompt')} ELSE coalesce({qs}, '') END")
    snapshot = (
        f"WITH {Q}, {S}, p AS (SELECT q.qid, {combined} AS question_with_prompt, {ctx} AS prompt "
        "FROM q LEFT JOIN s ON s.conv_id = q.conv_id), x AS (SELECT *, md5(prompt) AS dg FROM p) "
        f"SELECT qid, question_with_prompt, {_context_sql('dg')} FROM x")
    one_group = (
        f"WITH {Q}, {seen} SELECT qid, left(context, 150) || '...' AS preview FROM "
        f"(SELECT qid, conv_id, {_context_sql('dg')} FROM x) WHERE conv_id = 7")
    one = template_sql(CANDIDATES_TEMPLATE, question=qs, n="1")
    compare = (
        f"WITH two AS ({two_step}), {Q}, "
        f"one AS (SELECT qid, {_letter('dg', 0)} AS p FROM (SELECT q.qid, md5({one}) AS dg FROM q)), "
        "j AS (SELECT one.qid AS a, one.p AS ap, two.qid AS b, two.winner AS bp FROM one "
        "FULL JOIN two ON two.qid = one.qid) "
        f"SELECT CASE WHEN b IS NULL THEN 'only_a' WHEN a IS NULL THEN 'only_b' "
        f"WHEN {is_err('ap')} AND {is_err('bp')} THEN 'both_error' WHEN {is_err('ap')} THEN 'a_error' "
        f"WHEN {is_err('bp')} THEN 'b_error' WHEN ap IS NOT DISTINCT FROM bp THEN 'agree' ELSE 'changed' END "
        "AS outcome, count(*) AS n FROM j GROUP BY 1")
    final = template_sql(ANSWER_TEMPLATE, context="z.context", question=strip("w.final_question"))
    three = (
        f"WITH {Q}, {seen}, z AS (SELECT qid, question, {_context_sql('dg')} FROM x), "
        + _rewrite_sql(f"i AS (SELECT qid, {strip('question')} AS qs, context FROM z)", False) +
        f", w AS (SELECT qid, final_question FROM rewritten), "
        f"o AS (SELECT z.qid, {final} AS s FROM z JOIN w ON w.qid = z.qid) "
        f"SELECT qid, {strip(echo(strip('s')))} AS pred FROM o")
    return {"two_step_answer": two_step, "two_step_model": model("false"),
            "two_step_failures": model(lost), "context_run": context,
            "context_failures": context_failures, "batch_failures": batch_failures,
            "retry_old_run": retry_old_run, "rewrite_resume": rewrite_resume, "fact_check_run": fact("false"),
            "fact_check_failures": fact(lost), "rewrite_run": rewrite(False),
            "rewrite_failures": rewrite(True), "snapshot_run": snapshot,
            "one_group_check": one_group, "compare_modes": compare, "three_step_run": three}


SQL.update(_run_sql())


def _prompt_sql() -> str:
    from quire.functions.prompts import CANDIDATES_TEMPLATE

    p = template_sql(CANDIDATES_TEMPLATE, question=strip("question"), n="8")
    return (f"WITH {Q}, p AS (SELECT qid, {p} AS p FROM q) SELECT qid, "
            "CAST(length(p) AS INTEGER) AS prompt_len, md5(p) AS prompt_md5 FROM p")


SQL["render_prompt"] = _prompt_sql()




def _context_prompts_sql() -> str:
    from quire.functions.prompts import ANSWER_TEMPLATE, CONTEXT_TEMPLATE, VALIDATION_TEMPLATE

    kinds = {"context": CONTEXT_TEMPLATE, "validation": VALIDATION_TEMPLATE, "answer": ANSWER_TEMPLATE}
    parts = [f"SELECT qid, '{k}' AS kind, {template_sql(t, question='qs', context='answer')} AS prompt "
             "FROM t" for k, t in kinds.items()]
    return (f"WITH {Q}, {A}, t AS (SELECT q.qid, {strip('q.question')} AS qs, a.answer FROM q JOIN a "
            f"ON a.qid = q.qid), p AS ({' UNION ALL '.join(parts)}) "
            "SELECT qid, kind, length(prompt) AS prompt_len, md5(prompt) AS prompt_md5 FROM p")


SQL["context_prompts"] = _context_prompts_sql()
SQL["csv_blocks"] = (f"WITH {Q} SELECT qid, question, "
                     "row_number() OVER (ORDER BY conv_id, turn) - 1 AS place FROM q")
SQL["csv_roundtrip"] = f"WITH {Q} SELECT qid, question FROM q"
SQL["replay_recorded"] = (
    f"WITH {Q}, {A} SELECT q.qid, a.answer AS reply, CASE WHEN a.qid IS NULL THEN "
    "'Error: No recorded reply' END AS error, 1 AS attempts FROM q LEFT JOIN a ON a.qid = q.qid")



SQL["checkpoint_marks"] = (
    "WITH r AS (SELECT event_id AS seq, row_number() OVER (ORDER BY event_id) AS running_count "
    "FROM events) SELECT seq, running_count, running_count % 50 = 0 AS is_checkpoint FROM r")

SQL["repeat_vote"] = (
    f"WITH {Q}, c AS (SELECT q.qid, t.i AS pos, substr('ABCDE', CAST(unicode(left(md5({strip('q.question')} "
    "|| chr(10) || '(pass ' || CAST(t.i AS VARCHAR) || ')'), 1)) % 5 AS INTEGER) + 1, 1) AS label "
    "FROM q CROSS JOIN (SELECT range AS i FROM range(3)) t), "
    "per AS (SELECT qid, label, count(*) AS votes, min(pos) AS first_pos FROM c GROUP BY 1, 2), "
    "st AS (SELECT qid, sum(votes) AS n_candidates, max(votes) FILTER (WHERE label <> 'E') AS top "
    "FROM per GROUP BY 1), "
    "nt AS (SELECT per.qid, count(*) FILTER (WHERE per.label <> 'E' AND per.votes = st.top) AS n_top "
    "FROM per JOIN st ON st.qid = per.qid GROUP BY 1), "
    "best AS (SELECT qid, label, votes FROM (SELECT *, row_number() OVER (PARTITION BY qid "
    "ORDER BY votes DESC, first_pos ASC) AS rn FROM per WHERE label <> 'E') WHERE rn = 1) "
    "SELECT st.qid, best.label AS winner, coalesce(best.votes, 0) AS votes, st.n_candidates, "
    "CASE WHEN best.qid IS NULL THEN 'all_none' WHEN nt.n_top > 1 THEN 'tie' ELSE 'ok' END AS status "
    "FROM st JOIN nt ON nt.qid = st.qid LEFT JOIN best ON best.qid = st.qid")
