"""SQL for the queries that SQL can express; the others have brute-force tests."""

from siftloom.llm.mixing import LEVELS, Mix
from siftloom.llm.quality_rules import MEASURES, Rules

WORD = r"[^\x20\x09-\x0D]+"

#: Words of every text, and the runs of ``width`` words with the place of their first.
_WORDS = f"""d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT doc_id, lang, source, t, regexp_extract_all(t, '{WORD}') AS ws FROM d)"""


def _runs(width: int) -> str:
    return f"""runs AS MATERIALIZED (SELECT doc_id, i, array_to_string(ws[i:i + {width - 1}], ' ') AS g
FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {width - 2})) AS i FROM w WHERE len(ws) >= {width}))"""


SUBSTRINGS = f"""WITH {_WORDS}, {_runs(13)},
seen AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM runs)
  WHERE first < doc_id),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, i + k AS i FROM seen, range(0, 13) r(k)),
edges AS (SELECT doc_id, count(*) AS n_spans FROM gone g WHERE NOT EXISTS (
  SELECT 1 FROM gone o WHERE o.doc_id = g.doc_id AND o.i = g.i - 1) GROUP BY doc_id),
placed AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS text, count(*) AS n
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i WHERE g.i IS NULL GROUP BY p.doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(k.n, 0) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256, coalesce(e.n_spans, 0) AS n_spans
FROM w LEFT JOIN kept k USING (doc_id) LEFT JOIN edges e USING (doc_id)"""


def _quantiles(name: str, keys: str) -> str:
    step = 1 + Rules().accuracy
    value = f"CASE WHEN bucket = 0 THEN 0.0 ELSE pow({step}, bucket - 1) / 1000 END"
    return f"""{name} AS (SELECT {keys}, max(total) AS n_rows,
  min(CASE WHEN below >= total * 0.1 THEN v END) AS low,
  min(CASE WHEN below >= total * 0.5 THEN v END) AS middle,
  min(CASE WHEN below >= total * 0.9 THEN v END) AS high
FROM (SELECT {keys}, {value} AS v, sum(n) OVER (PARTITION BY {keys} ORDER BY bucket) AS below,
    sum(n) OVER (PARTITION BY {keys}) AS total
  FROM (SELECT {keys}, bucket, count(*) AS n FROM valued GROUP BY {keys}, bucket)) GROUP BY {keys})"""


def _quality() -> str:
    rules = Rules()
    ratios = ("word_chars / n_words", "n_symbols / n_words", "n_dup_lines / n_lines",
              "n_repeat_words / n_words")
    values = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{m}' AS measure, {s}::DOUBLE AS slack, CAST({r} AS DOUBLE) AS value "
        "FROM measured WHERE NOT base_failed" for m, s, r in zip(MEASURES, rules.slack, ratios))
    step = f"ln({1 + rules.accuracy}::DOUBLE)"
    return f"""WITH {_WORDS}, {_runs(5)},
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM runs)
  WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 5) r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
counted AS (SELECT w.doc_id, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(l.n, 0) AS n_lines,
    coalesce(l.dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)),
measured AS MATERIALIZED (SELECT *, n_words < {rules.least_words}
  OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed FROM counted),
valued AS MATERIALIZED (SELECT *, CASE WHEN value <= 0 THEN 0 WHEN value <= 0.001 THEN 1
  ELSE CAST(ceil(ln(value * 1000) / {step}) AS INTEGER) + 1 END AS bucket FROM ({values})),
{_quantiles("fine", "lang, source, measure")}, {_quantiles("wide", "lang, measure")},
{_quantiles("every", "measure")},
used AS (SELECT v.doc_id, v.value, v.slack,
    CASE WHEN f.n_rows >= {rules.least_rows} THEN f.low WHEN x.n_rows >= {rules.least_rows} THEN x.low ELSE e.low END AS low,
    CASE WHEN f.n_rows >= {rules.least_rows} THEN f.middle WHEN x.n_rows >= {rules.least_rows} THEN x.middle ELSE e.middle END AS middle,
    CASE WHEN f.n_rows >= {rules.least_rows} THEN f.high WHEN x.n_rows >= {rules.least_rows} THEN x.high ELSE e.high END AS high
  FROM valued v JOIN fine f ON f.lang = v.lang AND f.source = v.source AND f.measure = v.measure
  JOIN wide x ON x.lang = v.lang AND x.measure = v.measure JOIN every e ON e.measure = v.measure),
outside AS (SELECT DISTINCT doc_id FROM used WHERE value < low - slack - {rules.reach} * (middle - low)
  OR value > high + slack + {rules.reach} * (high - middle))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM outside) AS kept FROM measured"""


NEAR_CLASSES = f"""WITH RECURSIVE {_WORDS}, {_runs(5)},
grams AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM runs UNION
  SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
near AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b
  ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
edges AS MATERIALIZED (SELECT a, b FROM near JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE near.n >= 0.8 * (x.n + y.n - near.n)
  UNION SELECT a.doc_id, b.doc_id FROM d a JOIN d b ON a.t = b.t AND a.doc_id < b.doc_id),
both_ways AS MATERIALIZED (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reached AS (SELECT doc_id AS a, doc_id AS b FROM d UNION
  SELECT r.a, e.b FROM reached r JOIN both_ways e ON e.a = r.b)
SELECT a AS doc_id, min(b) AS class_id, min(b) = a AS kept FROM reached GROUP BY a"""

def _mixing() -> str:
    mix = Mix()
    ctes, parent = [], "SELECT least(sum(tokens) * {0}, sum(tokens) * {1}) AS budget FROM leaves".format(
        mix.share, mix.epochs)
    for depth, own in enumerate(LEVELS):
        keys = list(LEVELS[:depth])
        join = " AND ".join(f"c.{k} = p.{k}" for k in keys) or "true"
        window = f"PARTITION BY {', '.join(keys)} " if keys else ""
        names = ", ".join([*keys, own])
        weight = "CASE " + own + " " + " ".join(
            f"WHEN '{n}' THEN {w}::DOUBLE" for n, w in mix.weights.get(own, {"": 1.0}).items()) + " ELSE 1.0 END"
        before = f"OVER ({window}ORDER BY q, {own} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        ctes.append(f"""{own}_rows AS (SELECT {', '.join('c.' + k for k in [*keys, own])}, capacity, w, capacity / w AS q, budget
  FROM (SELECT {names}, sum(tokens) * {mix.epochs} AS capacity, {weight}::DOUBLE AS w FROM leaves GROUP BY {names}) c
  JOIN ({parent}) p ON {join}),
{own}_levels AS (SELECT *, (budget - coalesce(sum(capacity) {before}, 0))
  / (sum(w) OVER ({window}) - coalesce(sum(w) {before}, 0)) AS level FROM {own}_rows),
{own}_budgets AS (SELECT {names}, CASE WHEN cut IS NULL THEN capacity::DOUBLE ELSE w * cut END AS budget FROM (
  SELECT *, first_value(CASE WHEN NOT q <= level THEN level END IGNORE NULLS) OVER ({window}ORDER BY q, {own}
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cut FROM {own}_levels))""")
        parent = f"SELECT * FROM {own}_budgets"
    return f"""WITH {_WORDS},
tokened AS MATERIALIZED (SELECT doc_id, CASE WHEN regexp_extract(source, '([0-9]+)$', 1) = '' THEN 'other'
    ELSE ['web', 'code', 'books'][CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 3 + 1] END AS domain,
  lang, source, len(ws) AS tokens FROM w),
leaves AS MATERIALIZED (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM tokened GROUP BY ALL),
{', '.join(ctes)},
budgets AS (SELECT l.domain, l.lang, l.source, l.tokens AS total,
    least(floor(b.budget + 1e-6), l.tokens * {mix.epochs})::BIGINT AS budget
  FROM leaves l JOIN source_budgets b USING (domain, lang, source)),
placed AS (SELECT t.*, CASE WHEN total > 0 THEN budget // total ELSE 0 END AS full_epochs, budget, total
  FROM tokened t JOIN budgets USING (domain, lang, source))
SELECT doc_id, domain, lang, source, tokens AS n_tokens, full_epochs + CASE WHEN sum(tokens) OVER (
    PARTITION BY domain, lang, source ORDER BY md5('{mix.seed}:' || full_epochs || ':' || doc_id)
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= budget - full_epochs * total THEN 1 ELSE 0 END AS copies
FROM placed"""


SQL = {"op3_mixing": _mixing(), "op1_substring_dedup": SUBSTRINGS, "op8_quality_rules": _quality(),
       "op10_minhash_near_dedup": NEAR_CLASSES}
