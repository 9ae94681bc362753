"""SQL counterparts of the registered queries, for the checking engine.

They share constants and input variants with the Spark queries but state every
rule on their own, and reach deduplication by a different route: unrolled rounds
over all (document, bucket) pairs, without collapsing copies first.
"""

from siftloom import constants as C
from siftloom.catalog import inputs, sql
from siftloom.functions.minhash import PRIME, Banding, permutations
from siftloom.sources.registry import DEFAULT_SOURCES

ORACLE: dict[str, str] = {}


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes} {body}"


def _q(name: str, ctes: str, body: str) -> None:
    ORACLE[name] = _with(ctes, body) if ctes else body


# --- text -------------------------------------------------------------------

_q("clean_documents", f"{inputs.RAW_DOCUMENTS}, c AS (SELECT pos, {sql.clean('text')} AS text "
   "FROM raw_documents)", "SELECT pos, text, length(text) AS n_chars FROM c")

_q("clean_steps", inputs.RAW_DOCUMENTS, rf"""
SELECT pos, md5(regexp_replace(text, '\r\n?', chr(10), 'g')) AS newlines,
  md5(regexp_replace(text, '[{sql.WS_NO_LF}]+(\n|\z)', '\1', 'g')) AS trailing,
  md5(regexp_replace(text, '\n{{3,}}', chr(10) || chr(10), 'g')) AS collapsed,
  md5(regexp_replace(text, '\n{{2,}}', chr(10), 'g')) AS collapsed_to_one,
  md5(text) AS valid FROM raw_documents""")

_q("clean_samples", inputs.SAMPLES, f"""
SELECT pos, {sql.lower_strip('language')} AS language, {sql.lower_strip('license')} AS license,
  {sql.clean('instruction')} AS instruction, {sql.clean('input')} AS input,
  {sql.clean('output')} AS output FROM samples""")


# --- filters ----------------------------------------------------------------

_FLAGS = sql.quality("text")
_FLAG_COLUMNS = ", ".join(f"{expr} AS {name}" for name, expr in _FLAGS.items())
_FLAGGED = f"{inputs.RAW_DOCUMENTS}, flagged AS (SELECT pos, text, {_FLAG_COLUMNS} FROM raw_documents)"

_q("quality_flags", _FLAGGED, """
SELECT pos, autogenerated, suspicious, minified, repetitive, text = '' AS empty,
  contains(text, chr(0)) AS has_binary FROM flagged""")

_q("quality_filtered", _FLAGGED, """
SELECT pos, length(text) AS n_chars FROM flagged
WHERE text <> '' AND NOT contains(text, chr(0))
  AND NOT (autogenerated OR suspicious OR minified OR repetitive)""")

_q("quality_filtered_lenient", _FLAGGED,
   "SELECT pos FROM flagged WHERE NOT (suspicious OR repetitive)")

_q("language_filter", inputs.SAMPLES + f""", n AS (
SELECT pos, {sql.filter_language('language')} AS language FROM samples)""",
   f"SELECT pos, language, language IN ({sql.names(C.SUPPORTED_LANGUAGES)}) AS allowed FROM n")

_q("license_filter", inputs.SAMPLES + f""", n AS (
SELECT pos, {sql.normalize_license('license')} AS license FROM samples)""",
   f"SELECT pos, license, license IN ({sql.names(C.ALLOWED_LICENSES)}) AS allowed FROM n")

_SAMPLE_FLAGS = sql.quality("output")
_DECISION = f"""judged AS MATERIALIZED (
SELECT *, CASE WHEN output = '' THEN {sql.quote(C.REASON_EMPTY)}
  WHEN contains(output, chr(0)) THEN {sql.quote(C.REASON_BINARY)}
  WHEN language NOT IN ({sql.names(C.SUPPORTED_LANGUAGES)}) THEN {sql.quote(C.REASON_LANGUAGE)}
  WHEN license NOT IN ({sql.names(C.ALLOWED_LICENSES)}) THEN {sql.quote(C.REASON_LICENSE)}
  WHEN {' OR '.join(_SAMPLE_FLAGS.values())} THEN {sql.quote(C.REASON_QUALITY)} END AS filter_reason
FROM counted), content AS MATERIALIZED (
SELECT *, [e FOR e IN [
  CASE WHEN {sql.strip('instruction')} = '' THEN 'Instruction empty' END,
  CASE WHEN {sql.strip('output')} = '' THEN 'Output empty' END,
  CASE WHEN token_count > {C.MAX_TOKENS} THEN 'Too many tokens (' || token_count || ')' END,
  CASE WHEN token_count < {C.MIN_TOKENS} THEN 'Too few tokens (' || token_count || ')' END]
  IF e IS NOT NULL] AS errors FROM judged), decided AS MATERIALIZED (
SELECT *, CASE WHEN filter_reason IS NULL THEN errors ELSE [filter_reason] END AS reasons
FROM content)"""
_DECIDED = f"{inputs.NAMED}, {_DECISION}"

_q("reject_reasons", _DECIDED, """
SELECT pos, reasons[1] AS first_reject_reason, array_to_string(reasons, '; ') AS reasons,
  len(reasons) AS n_reasons FROM decided""")

_q("accepted_samples", _DECIDED, """
SELECT pos, dataset, language, license, md5(output) AS output_md5, token_count
FROM decided WHERE len(reasons) = 0""")

_q("reject_report", _DECIDED + r""", listed AS (
SELECT regexp_replace(unnest(reasons), ' \([0-9]+\)$', '') AS reason FROM decided),
grouped AS (SELECT reason, count(*) AS n FROM listed GROUP BY reason)""", """
SELECT reason, n, round(n * 100.0 / (SELECT sum(n) FROM grouped), 6) AS percent
FROM grouped ORDER BY n DESC, reason""")

_q("decision_counts", _DECIDED, """
SELECT count(*) FILTER (len(reasons) = 0) AS accepted,
  count(*) FILTER (len(reasons) > 0) AS rejected,
  CAST(coalesce(sum(len(reasons)), 0) AS BIGINT) AS recorded FROM decided""")


# --- tokens -----------------------------------------------------------------

_TOKENS = " + ".join(sql.tokens(f) for f in ("instruction", "input", "output"))
_q("token_counts", inputs.SAMPLES + f""", t AS (
SELECT pos, {sql.tokens('output')} AS output_tokens, {_TOKENS} AS sample_tokens FROM samples)""",
   f"""SELECT pos, output_tokens, sample_tokens, sample_tokens <= {C.MAX_TOKENS} AS within_limit,
  sample_tokens <= 500 AS within_500 FROM t""")

_OWN_TOKENS = " + ".join(f"len(regexp_extract_all({n}, '[^ \\t\\n\\r]+'))"
                         for n in ("instruction", "input", "output"))
_OWN_NAMED = inputs.NAMED.replace(_TOKENS, _OWN_TOKENS)
_q("token_counts_own", f"{_OWN_NAMED}, {_DECISION}", f"""
SELECT pos, CASE WHEN filter_reason IS NULL THEN token_count END AS token_count, token_count <= 100 AS within_100
FROM judged""")

_q("token_truncate", inputs.RAW_DOCUMENTS, rf"""
SELECT pos, array_to_string(list_slice(
  regexp_extract_all(text, '[ \t\n\x0b\f\r]*(?:{sql.TOKEN})'), 1, 200), '') AS text
FROM raw_documents""")


# --- validation -------------------------------------------------------------

_q("validation_errors", _DECIDED,
   "SELECT pos, array_to_string(errors, '; ') AS errors, len(errors) = 0 AS is_valid FROM decided")

_REQUIRED = ("id", "dataset", "language", "license", "instruction", "output")
_SCHEMA_ERRORS = ", ".join(
    [f"CASE WHEN {sql.strip(f)} = '' THEN 'Field ''{f}'' must be non-empty string' END"
     for f in _REQUIRED]
    + [f"CASE WHEN language NOT IN ({sql.names(C.SUPPORTED_LANGUAGES)}) "
       "THEN 'Language ''' || language || ''' not in supported list' END",
       f"CASE WHEN license IN ({sql.names(C.UNSPECIFIED_LICENSES)}) "
       "THEN 'License should be specified if available' END",
       f"CASE WHEN {sql.strip('output')} = '' THEN 'Output cannot be empty' END"])
_q("schema_validation", inputs.NAMED + f""", e AS (
SELECT pos, [x FOR x IN [{_SCHEMA_ERRORS}] IF x IS NOT NULL] AS errors FROM named)""",
   "SELECT pos, array_to_string(errors, '; ') AS errors, len(errors) = 0 AS is_valid FROM e")

_FIELD_ERRORS = ", ".join(
    f"CASE WHEN {sql.strip(f)} = '' THEN 'Field ''{f}'' is empty' END" for f in _REQUIRED)
_VALIDATED = inputs.NAMED + f""", fields AS (
SELECT *, [x FOR x IN [{_FIELD_ERRORS}] IF x IS NOT NULL] AS field_errors FROM counted),
validated AS MATERIALIZED (
SELECT pos, CASE WHEN len(field_errors) > 0 THEN field_errors
    WHEN token_count > {C.MAX_TOKENS}
    THEN ['Sample exceeds max tokens (' || token_count || ' > {C.MAX_TOKENS})'] ELSE [] END AS errors,
  CASE WHEN len(field_errors) > 0 THEN [] ELSE [x FOR x IN [
    CASE WHEN language NOT IN ({sql.names(C.SUPPORTED_LANGUAGES)}, 'unknown')
      THEN 'Language ''' || language || ''' not in supported list' END,
    CASE WHEN token_count < {C.MIN_TOKENS}
      THEN 'Sample is very short (' || token_count || ' tokens, min {C.MIN_TOKENS})' END]
    IF x IS NOT NULL] END AS warnings FROM fields)"""

_q("detailed_validation", _VALIDATED, """
SELECT pos, array_to_string(errors, '; ') AS errors, array_to_string(warnings, '; ') AS warnings,
  len(errors) = 0 AS is_valid FROM validated""")

_q("validation_top_messages", _VALIDATED, """
SELECT pos, coalesce(errors[1], '') AS errors, coalesce(warnings[1], '') AS warnings
FROM validated""")

_q("validation_summary", _VALIDATED, """
SELECT count(*) AS total, count(*) FILTER (len(errors) = 0) AS valid,
  count(*) FILTER (len(errors) > 0) AS invalid,
  round(count(*) FILTER (len(errors) = 0) * 100.0 / count(*), 6) AS valid_percent FROM validated""")

_q("validation_messages", _VALIDATED + """, listed AS (
SELECT pos, unnest(range(len(errors))) AS error_no, unnest(errors) AS error FROM validated)""", """
SELECT pos, error_no, 'Sample ' || pos || ': ' || error AS message FROM listed
ORDER BY pos, error_no LIMIT 20""")

_q("validation_stats", _VALIDATED + """, listed AS (
SELECT 'error' AS kind, unnest(errors) AS message FROM validated UNION ALL
SELECT 'warning', unnest(warnings) FROM validated)""", """
SELECT kind, split_part(message, ':', 1) AS type, count(*) AS n FROM listed GROUP BY ALL""")


# --- language detection -----------------------------------------------------

_q("detect_extension", inputs.FILE_URL,
   f"SELECT pos, {sql.extension('filename')} AS language FROM file_url")

_q("detect_shebang", inputs.CODED, f"SELECT pos, {sql.shebang('code')} AS language FROM coded")

_q("detect_keywords", f"{inputs.CODED}, {inputs.FILE_URL}, texts AS ("
   "SELECT pos, code FROM coded UNION ALL SELECT -1 - pos, html FROM file_url), "
   + sql.keyword_ctes("texts", "pos", "code"),
   "SELECT pos, keyword_language AS language FROM best")

_DETECTED = f"{inputs.CODED}, {sql.keyword_ctes('coded', 'pos', 'code')}"
_q("detect_language", _DETECTED,
   f"SELECT pos, {sql.detected('code', 'filename', 'hint')} AS language "
   "FROM coded JOIN best USING (pos)")

_q("normalize_language", inputs.SAMPLES, f"""
SELECT pos, {sql.normalize_language('language')} AS language,
  {sql.difficulty('difficulty')} AS difficulty FROM samples""")


# --- sources and adapters ---------------------------------------------------

def _first_solution(text: str, key: str) -> str:
    return (f"CASE {key} % 7 WHEN 1 THEN '# ' || {sql.strip(text)} WHEN 6 THEN NULL "
            f"ELSE {sql.strip(text)} END")


_q("first_solution_of", "", f"""
SELECT item_id, {_first_solution('text', 'item_id')} AS solution FROM benchmark""")

_TASK = ("CASE WHEN pos % 19 = 4 THEN '' ELSE 'Task of ' || source END")
_SOURCE = f"""{inputs.CODED}, tasks AS MATERIALIZED (
SELECT pos, source, {_TASK} AS task, code FROM coded)"""


def _adapter(name: str, ctes: str, source: str, where: str, **columns: str) -> None:
    spelled = {"id": "CAST(pos AS VARCHAR)", "dataset": sql.quote(name), "input": "''",
               "tests": "''", "difficulty": "'unknown'", "metadata": "''", **columns}
    select = ", ".join(f"{expr} AS {column}" for column, expr in spelled.items())
    _q(f"adapter_{name}", ctes, f"SELECT {select} FROM {source} WHERE {where}")


_adapter("mbpp", _SOURCE, "tasks", f"task <> '' AND {sql.strip('code')} <> ''",
         language="'python'", license="'cc-by-4.0'", instruction="task",
         output=sql.strip("code"), difficulty="'easy'",
         tests="CASE pos % 3 WHEN 0 THEN '' WHEN 1 THEN 'assert|assert a' "
               "ELSE 'assert|assert a;assert|assert b' END",
         metadata="'test_count=' || (pos % 3)")

_SOLVED = f"""{_SOURCE}, solved AS MATERIALIZED (
SELECT * REPLACE ({_first_solution('code', 'pos')} AS code) FROM tasks),
{sql.keyword_ctes("solved", "pos", "code")}, found AS (
SELECT s.*, {sql.detected('code')} AS found_language FROM solved s JOIN best USING (pos))"""
_OR_PYTHON = "CASE found_language WHEN 'unknown' THEN 'python' ELSE found_language END"
_DIFFICULTY = sql.difficulty(sql.pick(inputs.DIFFICULTIES, f"pos % {len(inputs.DIFFICULTIES)}"))
_N_IO = "CASE WHEN pos % 3 = 0 THEN 0 ELSE least(pos % 5, 3) END"

_adapter("apps", _SOLVED, "found", "task <> '' AND coalesce(code, '') <> ''",
         language=_OR_PYTHON, license="'mit'", instruction=sql.quote(C.SOLVE_INSTRUCTION),
         input=f"task || CASE WHEN pos % 2 = 0 THEN {sql.quote(C.STARTER_HEADING)} "
               "|| 'def start():' ELSE '' END",
         output="code", difficulty=_DIFFICULTY,
         tests=f"array_to_string(list_slice(['io|1|a', 'io|2|b', 'io|3|c'], 1, {_N_IO}), ';')",
         metadata="'has_starter=' || CASE WHEN pos % 2 = 0 THEN 'true' ELSE 'false' END "
                  f"|| ';test_count=' || ({_N_IO})")

_adapter("humaneval", _SOURCE, "tasks", f"task <> '' AND {sql.strip('code')} <> ''",
         id="'HumanEval/' || pos", language="'python'", license="'mit'",
         instruction=sql.quote(C.SPECIFICATION_INSTRUCTION), input="task",
         output=sql.strip("code"), difficulty="'medium'",
         metadata="'entry_point=f' || pos || ';source=openai;tests=' || "
                  "CASE WHEN pos % 2 = 0 THEN 'check(f)' ELSE '' END")

_STRIPPED = f"""{_SOURCE}, stripped AS MATERIALIZED (
SELECT * REPLACE ({sql.strip('code')} AS code) FROM tasks),
{sql.keyword_ctes("stripped", "pos", "code")}, found AS (
SELECT s.*, {sql.detected('code')} AS found_language FROM stripped s JOIN best USING (pos))"""

_CONTEXT = "CASE WHEN pos % 2 = 0 THEN 'context' ELSE '' END"
_adapter("codealpaca", _STRIPPED, "found", "task <> '' AND code <> ''",
         id=f"md5(task || chr(31) || {_CONTEXT} || chr(31) || code)",
         language="found_language", license="'cc-by-4.0'", instruction="task",
         input=_CONTEXT, output="code")

_adapter("evolcode", _STRIPPED, "found", "task <> '' AND code <> ''",
         id="CASE WHEN pos % 2 = 0 THEN 'e' || pos "
            "ELSE md5(task || chr(31) || chr(31) || code) END",
         language=_OR_PYTHON, license="'cc-by-nc-sa-4.0'", instruction="task", output="code")

_adapter("taco", _SOLVED, "found", "task <> '' AND coalesce(code, '') <> ''",
         language=_OR_PYTHON, license="'apache-2.0'", instruction=sql.quote(C.SOLVE_INSTRUCTION),
         input="task", output="code", difficulty=_DIFFICULTY,
         tests="CASE WHEN pos % 2 = 0 THEN 'assert|t1;assert|t2' ELSE '' END",
         metadata="'test_count=' || CASE WHEN pos % 2 = 0 THEN 2 ELSE 0 END")

_q("row_adapter", "", f"""
SELECT CAST(item_id AS VARCHAR) AS id, 'benchmark' AS dataset, 'unknown' AS language,
  'mit' AS license, ({sql.words('text')})[1] AS instruction, '' AS input,
  {sql.strip('text')} AS output, '' AS tests, 'unknown' AS difficulty,
  'n_chars=' || length(text) AS metadata FROM benchmark WHERE {sql.strip('text')} <> ''""")

_IDS = [s.id for s in DEFAULT_SOURCES]


def _default(field: str) -> str:
    values = {s.id: getattr(s, field) for s in DEFAULT_SOURCES if getattr(s, field)}
    default = sql.case_of("dataset", values, "NULL")
    return (f"CASE WHEN {sql.lower_strip(field)} IN ({sql.names(C.UNKNOWN_METADATA_VALUES)}) "
            f"THEN coalesce({default}, {field}) ELSE {field} END AS {field}")


_q("metadata_backfill", inputs.SAMPLES + f""", s AS (
SELECT pos, {sql.pick([*_IDS, 'other'], f"pos % {len(_IDS) + 1}")} AS dataset, language, license
FROM samples)""", f"SELECT pos, dataset, {_default('language')}, {_default('license')} FROM s")

_CHOSEN = [s for s in DEFAULT_SOURCES if s.id in ("mbpp", "apps", "taco")]
_q("source_selection", inputs.GIVEN + f", s AS (SELECT doc_id AS pos, "
   f"{sql.pick(_IDS, f'doc_id % {len(_IDS)}')} AS id FROM given)", f"""
SELECT pos, id, {sql.case_of('id', {s.id: s.hf_name for s in _CHOSEN}, 'NULL')} AS hf_name,
  'train' AS split, false AS streaming, id AS adapter
FROM s WHERE id IN ({sql.names([s.id for s in _CHOSEN])})""")

_TURNS = """turns AS MATERIALIZED (
SELECT u.conv_id, u.turn, u.text AS instruction, a.text AS output FROM conversations u
JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant')"""

_UNION = f"""{_SOURCE}, {_TURNS}, parts AS MATERIALIZED (
SELECT 'mbpp' AS dataset, 0 AS dataset_ord, CAST(pos AS VARCHAR) AS id, 'cc-by-4.0' AS license,
  task AS instruction, {sql.strip('code')} AS code FROM tasks
UNION ALL SELECT 'codealpaca', 1, CAST(conv_id * 1000 + turn AS VARCHAR), 'cc-by-4.0',
  {sql.strip('instruction')}, {sql.strip('output')} FROM turns
UNION ALL SELECT 'evolcode', 2, CAST(item_id AS VARCHAR), 'cc-by-nc-sa-4.0', 'Continue.',
  {sql.strip('text')} FROM benchmark), keyed AS MATERIALIZED (
SELECT dataset_ord * 72057594037927936 + CAST(id AS BIGINT) AS pos, * FROM parts WHERE instruction <> '' AND code <> ''),
{sql.keyword_ctes("keyed", "pos", "code")}, found AS (
SELECT k.*, {sql.detected('code')} AS found_language FROM keyed k JOIN best USING (pos)),
merged AS MATERIALIZED (
SELECT pos, dataset, dataset_ord, id, CASE dataset WHEN 'mbpp' THEN 'python'
  WHEN 'evolcode' THEN CASE found_language WHEN 'unknown' THEN 'python' ELSE found_language END
  ELSE found_language END AS language, license, instruction, '' AS input, code AS output
FROM found)"""
_q("union_sources", _UNION, """
SELECT dataset, dataset_ord, id, language, license, md5(instruction) AS instruction_md5,
  md5(output) AS output_md5 FROM merged""")

_q("source_validity", "", """
SELECT field, type, CASE field WHEN 'test_list' THEN (SELECT count(*) FROM documents
  WHERE doc_id % 5 <> 2) ELSE (SELECT count(*) FROM documents) END AS n_rows FROM (VALUES
  ('task_id', 'int'), ('text', 'string'), ('code', 'string'), ('test_list', 'array<string>'))
  AS v(field, type)""")


# --- pairs and export forms -------------------------------------------------

_PAIRS = f"""{_TURNS}, pairs AS MATERIALIZED (
SELECT conv_id * 1000 + turn AS pos, conv_id || '-' || turn AS id,
  {sql.strip('instruction')} AS instruction,
  CASE WHEN turn % 4 = 0 THEN 'context' ELSE '' END AS input,
  {sql.strip('output')} AS output FROM turns)"""

_q("sft_pairs", _PAIRS, """
SELECT pos, id, 'conversations' AS dataset, 'python' AS language, 'mit' AS license, instruction,
  input, output, '' AS tests, 'unknown' AS difficulty, '' AS metadata FROM pairs""")

_q("instruction_export", _PAIRS, "SELECT id, instruction, input, output FROM pairs")

_USER = "instruction || CASE WHEN input <> '' THEN chr(10) || chr(10) || input ELSE '' END"
_q("chat_export", _PAIRS, f"""
SELECT id, 'user' AS role_0, {_USER} AS content_0, 'assistant' AS role_1, output AS content_1
FROM pairs""")

_q("json_rows", _PAIRS, "SELECT id, 'python' AS language, md5(output) AS output_md5 FROM pairs")


# --- deduplication ----------------------------------------------------------

_BANDING = Banding()


def _signatures(source: str, key: str, text: str, banding: Banding = _BANDING) -> str:
    """CTEs up to `bands(pos, band, band_key)`."""
    pairs = permutations(banding.num_perm, banding.seed)
    minima = ", ".join(f"coalesce(min(({a} * h + {b}) % {PRIME}), {PRIME}) AS m{i}"
                       for i, (a, b) in enumerate(pairs))
    signature = "concat_ws(',', " + ", ".join(f"m{i}" for i in range(banding.num_perm)) + ")"
    keys = ", ".join(
        f"md5(concat_ws(',', {band}, " + ", ".join(
            f"m{i}" for i in range(band * banding.rows, (band + 1) * banding.rows)) + "))"
        for band in range(banding.bands))
    return f"""source_words AS (
SELECT {key} AS pos, unnest(list_distinct({sql.words(text)})) AS w FROM {source}),
word_hashes AS (SELECT pos, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {PRIME} AS h
FROM source_words),
minima AS MATERIALIZED (SELECT {source}.{key} AS pos, {minima} FROM {source}
LEFT JOIN word_hashes ON {source}.{key} = word_hashes.pos GROUP BY {source}.{key}),
signatures AS (SELECT pos, {signature} AS signature FROM minima),
bands AS MATERIALIZED (SELECT pos, unnest(range({banding.bands})) AS band,
  unnest([{keys}]) AS band_key FROM minima)"""


def _rounds(count: int = 8) -> str:
    """CTE `kept(pos)`; an undecided rest shows up as position -1."""
    ctes = ["u0 AS MATERIALIZED (SELECT pos, band, band_key FROM bands)"]
    for r in range(count):
        ctes += [
            f"lead{r} AS (SELECT band, band_key, min(pos) AS lead FROM u{r} GROUP BY ALL)",
            f"win{r} AS MATERIALIZED (SELECT pos FROM u{r} JOIN lead{r} USING (band, band_key) "
            "GROUP BY pos HAVING bool_and(pos = lead))",
            f"closed{r} AS (SELECT DISTINCT band, band_key FROM u{r} SEMI JOIN win{r} USING (pos))",
            f"out{r} AS (SELECT DISTINCT pos FROM u{r} SEMI JOIN closed{r} USING (band, band_key))",
            f"u{r + 1} AS MATERIALIZED (SELECT * FROM u{r} ANTI JOIN out{r} USING (pos))",
        ]
    kept = " UNION ALL ".join(f"SELECT pos FROM win{r}" for r in range(count))
    ctes.append(f"kept AS MATERIALIZED ({kept} UNION ALL "
                f"SELECT -1 FROM u{count} HAVING count(*) > 0)")
    return ", ".join(ctes)


_DOC_BANDS = _signatures("documents", "doc_id", "text")
_q("minhash_signature", _DOC_BANDS, "SELECT pos AS doc_id, signature FROM signatures")
_q("lsh_bands", _DOC_BANDS, "SELECT pos AS doc_id, band, band_key FROM bands")
_q("bucket_sizes", _DOC_BANDS,
   "SELECT band_key, count(*) AS n FROM bands GROUP BY band_key HAVING count(*) > 1")

_KEPT = f"{_DOC_BANDS}, {_rounds()}"
_KEPT_ROWS = """
SELECT pos AS doc_id, source, md5(text) AS text_md5
FROM kept LEFT JOIN documents ON doc_id = pos"""
_q("near_dedup", _KEPT, _KEPT_ROWS)
_q("stream_dedup", _KEPT, _KEPT_ROWS)
_q("dedup_chain", """starts AS (SELECT doc_id, CASE WHEN lag(n_chars) OVER w % 300 <> 7 AND lag(doc_id) OVER w = doc_id - 1
    THEN NULL ELSE doc_id END AS start FROM documents WINDOW w AS (ORDER BY doc_id)),
places AS (SELECT doc_id, doc_id - max(start) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS place FROM starts)""",
   "SELECT doc_id, 1 AS copies FROM places WHERE place % 2 = 0")
_q("dedup_counts", _KEPT + """, c AS (
SELECT (SELECT count(*) FROM documents) AS processed, (SELECT count(*) FROM kept) AS unique_n)""",
   """SELECT processed, unique_n AS "unique", processed - unique_n AS removed,
  round((processed - unique_n) * 100.0 / processed, 6) AS duplicate_percentage FROM c""")


# --- statistics -------------------------------------------------------------

_CORPUS = f"""{inputs.NAMED}, corpus AS MATERIALIZED (
SELECT * REPLACE ({sql.difficulty('difficulty')} AS difficulty) FROM counted)"""

_q("run_stats", _CORPUS, """
SELECT count(*) AS samples, CAST(sum(token_count) AS BIGINT) AS tokens,
  round(avg(token_count), 6) AS average_tokens, max(token_count) AS longest,
  min(token_count) AS shortest FROM corpus""")

_LENGTHS = ", ".join(f"round(avg(length({n})), 6) AS average_{n}_length"
                     for n in ("instruction", "output", "input"))
_q("corpus_stats", _CORPUS, f"""
SELECT count(*) AS total_samples, round(avg(token_count), 6) AS average_tokens,
  min(token_count) AS min_tokens, max(token_count) AS max_tokens, {_LENGTHS},
  CAST(sum(n_tests) AS BIGINT) AS samples_with_tests,
  count(*) FILTER ({sql.strip('instruction')} = '') AS empty_instruction,
  count(*) FILTER ({sql.strip('output')} = '') AS empty_output FROM corpus""")

_DIMENSIONS = ("dataset", "language", "license", "difficulty")
_BY_DIMENSION = " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {d} AS value, count(*) AS n FROM corpus GROUP BY {d}"
    for d in _DIMENSIONS)
_q("stats_by_dimension", _CORPUS, _BY_DIMENSION)
_q("stats_per_dataset", _CORPUS, " UNION ALL ".join(
    f"SELECT dataset, '{d}' AS dimension, {d} AS value, count(*) AS n FROM corpus "
    f"GROUP BY dataset, {d}" for d in ("language", "license")))
_q("sources_ranked", _CORPUS, """
SELECT 'dataset' AS dimension, dataset AS value, count(*) AS n FROM corpus GROUP BY dataset
ORDER BY n DESC, value""")
_q("top_languages", _CORPUS, """
SELECT language, count(*) AS n,
  round(count(*) * 100.0 / (SELECT count(*) FROM corpus), 6) AS percent
FROM corpus GROUP BY language ORDER BY n DESC, language LIMIT 10""")

_MAPS = ", ".join(
    f"(SELECT string_agg(value || '=' || n, ';' ORDER BY value) FROM d WHERE dimension = '{d}') "
    f"AS {name}" for d, name in zip(_DIMENSIONS, (
        "samples_per_dataset", "language_distribution", "license_distribution",
        "difficulty_distribution")))
_q("summary_record", f"""{_CORPUS}, d AS ({_BY_DIMENSION}),
{_signatures("corpus", "pos", "output")}, {_rounds()}""", f"""
SELECT count(*) AS total_samples, {_MAPS}, round(avg(token_count), 6) AS average_tokens,
  min(token_count) AS min_tokens, max(token_count) AS max_tokens, {_LENGTHS},
  CAST(sum(n_tests) AS BIGINT) AS samples_with_tests,
  round((count(*) - (SELECT count(*) FROM kept)) * 100.0 / count(*), 6) AS duplicate_percentage,
  'instruction=' || count(*) FILTER ({sql.strip('instruction')} = '') || ';output='
  || count(*) FILTER ({sql.strip('output')} = '') AS empty_fields FROM corpus""")


# --- split, shuffle, head, resume -------------------------------------------

def _split(fraction: float, dataset: str, key: str) -> str:
    draw = (f"CAST('0x' || substr(md5('{C.SEED}' || chr(31) || {dataset} || chr(31) || {key}), "
            "1, 8) AS BIGINT)")
    return f"CASE WHEN {draw} < {int(fraction * (1 << 32))} THEN 'validation' ELSE 'train' END"


_DOC_SPLIT = _split(C.VALIDATION_FRACTION, "source", "CAST(doc_id AS VARCHAR)")
_q("train_val_split", inputs.GIVEN, f"SELECT doc_id AS pos, {_DOC_SPLIT} AS split FROM given")
_q("split_counts", inputs.GIVEN,
   f"SELECT {_DOC_SPLIT} AS split, count(*) AS n FROM given GROUP BY 1")

_SHUFFLE_KEY = f"md5('{C.SEED}' || chr(31) || doc_id)"
_q("shuffle_order", "", f"""
SELECT doc_id, source, row_number() OVER (ORDER BY {_SHUFFLE_KEY}, doc_id) AS shuffle_rank
FROM documents""")
_q("shuffled_corpus", "", f"""
SELECT doc_id, md5(text) AS text_md5 FROM documents ORDER BY {_SHUFFLE_KEY}, doc_id""")
_q("head_samples", inputs.SAMPLES, "SELECT pos, dataset, output FROM samples ORDER BY pos LIMIT 10")
_q("resume_anti", inputs.GIVEN, f"""
SELECT doc_id AS pos, source AS dataset, CAST(doc_id AS VARCHAR) AS id FROM given
WHERE {_split(0.5, "source", "CAST(doc_id AS VARCHAR)")} = 'validation'""")


# --- sinks ------------------------------------------------------------------

_WRITTEN = """
SELECT pos, id, dataset, language, license, instruction, input, output, difficulty FROM samples"""
for _name in ("roundtrip_jsonl", "roundtrip_jsonl_gzip_append", "roundtrip_parquet"):
    _q(_name, inputs.SAMPLES, _WRITTEN)

_PAIR_SPLIT = _split(C.VALIDATION_FRACTION, "'conversations'", "id")
_q("own_exporter", inputs.SAMPLES, "SELECT id, md5(output) AS output_md5 FROM samples")
_q("split_output", _PAIRS, f"""
SELECT {_PAIR_SPLIT} AS split, md5({_USER}) AS user_md5, md5(output) AS assistant_md5 FROM pairs""")
_q("export_info", inputs.GIVEN, """
SELECT format, count(*) AS samples, compression, true AS has_files FROM given,
  (VALUES ('parquet', 'snappy'), ('parquet', 'zstd'), ('jsonl', 'gzip')) e(format, compression)
GROUP BY format, compression""")


# --- streaming --------------------------------------------------------------

_q("stream_clean", f"""s AS (SELECT doc_id AS pos, {sql.clean('text')} AS text FROM documents),
f AS (SELECT pos, text, {_FLAG_COLUMNS} FROM s)""", """
SELECT pos, text FROM f WHERE text <> '' AND NOT contains(text, chr(0))
  AND NOT (autogenerated OR suspicious OR minified OR repetitive)""")


# --- whole jobs -------------------------------------------------------------

_KEPT_OF_ACCEPTED = f"""accepted AS MATERIALIZED (
SELECT * FROM decided WHERE len(reasons) = 0),
{_signatures("accepted", "pos", "output")}, {_rounds()}"""
_q("deduplicated_corpus", f"{_DECIDED}, {_KEPT_OF_ACCEPTED}", """
SELECT pos, dataset, language, license, md5(output) AS output_md5, token_count
FROM kept LEFT JOIN accepted USING (pos)""")

_RUN = f"{_UNION}, {inputs.named('merged')}, {_DECISION}, {_KEPT_OF_ACCEPTED}"
for _name in ("full_run", "full_run_resumed"):
    _q(_name, _RUN, f"""
SELECT {_split(C.VALIDATION_FRACTION, "dataset", "id")} AS split,
  md5(instruction) AS instruction_md5, md5(output) AS output_md5
FROM kept LEFT JOIN accepted USING (pos)""")

_FIGURES = [
    ("**Total Samples**", "format('{:,}', count(*))"),
    ("**Duplicate Percentage**", "format('{:.2f}%', (any_value(total) - count(*)) * 100.0 / any_value(total))"),
    ("**Average Tokens**", "format('{:.0f}', avg(token_count))"),
    ("Min", "min(token_count)"), ("Max", "max(token_count)"), ("Average", "format('{:.0f}', avg(token_count))"),
    *[(f"Avg {n.capitalize()}", f"format('{{:.0f}}', avg(length({n}))) || ' chars'")
      for n in ("instruction", "input", "output")],
    ("Samples with Tests", "format('{:,}', count(*) FILTER (dataset = 'mbpp' AND CAST(id AS BIGINT) % 5 <> 2))"),
    ("Empty Instructions", "count(*) FILTER (instruction = '')"),
    ("Empty Outputs", "count(*) FILTER (output = '')")]
_q("run_report", f"""{_RUN}, corpus AS MATERIALIZED (
SELECT *, (SELECT count(*) FROM accepted) AS total FROM kept LEFT JOIN accepted USING (pos))""",
   " UNION ALL ".join(f"SELECT '- {name}: ' || {value} AS line FROM corpus" for name, value in _FIGURES))
