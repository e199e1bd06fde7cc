"""DuckDB SQL for the queries that SQL can express, written from their
contracts: brute force over whole tables, without the operators' methods."""

from __future__ import annotations

from flowlab.llm import quality_rules as rules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"
_SPACE = r"[\x20\x09-\x0D]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _ascii_lower(expr: str) -> str:
    return f"translate({expr}, '{_UPPER}', '{_LOWER}')"


def _only(expr: str, chars: str) -> str:
    """How many characters of the class ``chars`` the text has."""
    return f"length(regexp_replace({expr}, {_quoted('[^' + chars + ']')}, '', 'g'))"


def chat_sql(echo: str) -> str:
    """Turns, loss text and lengths from the table itself; a control string's
    mark and a backslash take one more character each."""
    added = {"text": "coalesce(text, '')", "role": "coalesce(role, '')"}
    escaped = {c: f"length({c}) + {_only(c, '<[' + chr(92) * 2)}" for c in added}
    return f"""
WITH turns AS (
  SELECT conv_id, turn, {added['role']} AS role, {added['text']} AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {_quoted(echo)} UNION ALL SELECT -1, 1, 'assistant', {_quoted(echo)}),
placed AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM turns),
judged AS (
  SELECT *, CASE WHEN place = 1 THEN role IN ('system', 'user')
                 ELSE (before, role) IN (('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) END AS fits
  FROM placed),
loss AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS trained FROM judged)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(sum(length(trained)) AS BIGINT) AS loss_chars,
       sha256(string_agg(trained, '' ORDER BY place)) AS loss_sha256,
       CAST(sum(8 + {escaped['role']} + {_only('role', chr(92) + 'n')} + 1 + {escaped['text']} + 8) AS BIGINT) AS formatted_chars,
       bool_and(fits) AS in_order
FROM loss GROUP BY conv_id"""


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


JACCARD_SQL = rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS node, doc_id,
         regexp_extract_all({_ascii_lower("coalesce(text, '')")}, {_quoted(_WORD)}) AS words FROM documents),
sets AS (
  SELECT node, unnest(list_distinct([array_to_string(words[i:i + 3], ' ') FOR i IN range(1, greatest(len(words) - 2, 2))])) AS shingle
  FROM docs WHERE len(words) > 0),
sizes AS (SELECT node, count(*) AS n FROM sets GROUP BY node),
common AS (
  SELECT x.node AS a, y.node AS b, count(*) AS shared FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.node <> y.node
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes s ON s.node = a JOIN sizes t ON t.node = b
  WHERE 100 * shared >= 85 * (s.n + t.n - shared)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(d.doc_id) AS other FROM reach JOIN docs d ON d.node = b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, other) AS component_id
FROM docs LEFT JOIN sizes USING (node) LEFT JOIN least ON least.a = docs.node"""


def rules_sql() -> str:
    phrases = " OR ".join(f"contains(lower(line), {_quoted(p)})" for p in rules.BOILERPLATE)
    symbols, navigation = rules.SYMBOLS, rules.NAVIGATION
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS node, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_quoted(_WORD)}) AS words FROM documents),
base AS (
  SELECT node, doc_id, len(words) AS n_words, length(regexp_replace(text, {_quoted(_SPACE)}, '', 'g')) AS word_chars,
         {_only('text', symbols)} AS n_symbols FROM docs),
lines AS (SELECT node, unnest(string_split(text, chr(10))) AS line FROM docs),
counted AS (
  SELECT node, line, len(regexp_extract_all(line, {_quoted(_WORD)})) AS own,
         length(regexp_replace(line, {_quoted(_SPACE)}, '', 'g')) AS chars FROM lines),
judged AS (
  SELECT node, line, chars,
         (own >= {rules.LONG_LINE} AND NOT regexp_matches(line, {_quoted(rules.END_MARK)}))
         OR 10 * {_only('line', symbols)} > chars OR {_only('line', navigation)} > 1
         OR ({_only('line', 'A-Z')} >= 20 AND {_only('line', 'A-Z')} > 2 * {_only('line', 'a-z')})
         OR {phrases} AS fails
  FROM counted WHERE own > 0),
by_line AS (
  SELECT node, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(chars) FILTER (fails), 0) AS lost_chars
  FROM judged GROUP BY node),
windows AS (
  SELECT node, i, array_to_string(words[i:i + {rules.WINDOW - 1}], ' ') AS w
  FROM (SELECT node, words, unnest(range(1, len(words) - {rules.WINDOW - 2})) AS i FROM docs WHERE len(words) >= {rules.WINDOW})),
twice AS (SELECT node, i FROM windows QUALIFY count(*) OVER (PARTITION BY node, w) > 1),
repeats AS (
  SELECT node, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT node, unnest(range(i, i + {rules.WINDOW})) AS place FROM twice) GROUP BY node),
measured AS (
  SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(coalesce(lost_chars, 0) AS BIGINT) AS lost_chars
  FROM base LEFT JOIN by_line USING (node) LEFT JOIN repeats USING (node)),
decided AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PCT} * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND 100 * lost_chars <= {rules.MAX_LOST_PCT} * word_chars AS kept FROM decided"""


def url_sql(url_rules, listed_hosts: str) -> str:
    longest = sorted(url_rules, key=lambda r: -len(r.host + r.path))

    def first(result) -> str:
        cases = [f"WHEN (host = {_quoted(r.host)} OR ends_with(host, {_quoted('.' + r.host)})) AND starts_with(path, {_quoted(r.path)}) "
                 f"THEN {_quoted(result(r))}" for r in longest]
        return "CASE " + " ".join(cases) + " END"
    parts = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"
    return rf"""
WITH cut AS (
  SELECT page_id, coalesce(url, '') AS u, {_ascii_lower(f"regexp_extract(coalesce(url, ''), {parts}, 1)")} AS host,
         regexp_extract(coalesce(url, ''), {parts}, 2) AS path FROM pages),
queried AS (
  SELECT *, regexp_replace(regexp_replace(regexp_extract(u, '(?s)^[^?#]*[?]([^#]*)', 1), '(^|&)utm_[^&]*', '', 'g'), '^&', '') AS query
  FROM cut),
canonical AS (
  SELECT *, CASE WHEN contains(u, '://') THEN
      regexp_replace(regexp_replace(host, '^www[.]', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
      || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS canon FROM queried),
listed AS (SELECT DISTINCT canon FROM canonical WHERE canon IS NOT NULL AND regexp_matches(host, {_quoted(listed_hosts)})),
ruled AS (SELECT page_id, host, path, canon, {first(lambda r: r.host + r.path)} AS rule, {first(lambda r: r.verdict)} AS said FROM canonical)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled"""
