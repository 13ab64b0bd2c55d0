"""What SQL can express of the operators' results, for DuckDB."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 3), ' ') || '|' || least(len(ws), 4) AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
cand AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM cand JOIN sz p ON p.doc_id = x JOIN sz q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)
), both_ways AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON b.x = r.y),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(sz.n, 0) AS BIGINT) AS n_shingles, comp.c AS component_id
FROM documents d LEFT JOIN sz ON sz.doc_id = d.doc_id JOIN comp ON comp.x = d.doc_id
"""

OP2 = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
iw AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(list_slice(ws, i, i + least(len(ws), 10) - 1), ' ') AS p
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM iw WHERE len(ws) > 0)
), ks AS (SELECT DISTINCT k FROM win),
pos AS (
  SELECT doc_id, k, i, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS p
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM dw, ks WHERE len(ws) >= k)
), occ AS (SELECT DISTINCT pos.doc_id, pos.i, pos.k, win.item_id FROM pos JOIN win ON win.k = pos.k AND win.p = pos.p),
hit AS (SELECT doc_id, count(DISTINCT w) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS w FROM occ) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY 1)
SELECT dw.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(its.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(its.s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit ON hit.doc_id = dw.doc_id LEFT JOIN its ON its.doc_id = dw.doc_id
"""

OP4 = r"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), r(h, q, a) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT page_id, host, path, h || q AS rule, a, row_number() OVER (PARTITION BY page_id ORDER BY length(h || q) DESC) AS k
  FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)
)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.a, 'allow') AS verdict FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.k = 1
"""

OP5 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), e AS (
  SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '#', '&#35;') AS body,
    replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '#', '&#35;'), ':', '&#58;') AS head FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(head) + 2 + length(body) + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""



def _op8() -> str:
    from tidemark.llm.quality_rules import STOP_WORDS

    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8)
), r AS (
  SELECT doc_id, count(DISTINCT w) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS w FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g) WHERE c > 1) GROUP BY 1
), m AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(ws, lambda x: list_contains([{stop}], x))) AS st
  FROM d LEFT JOIN r ON r.doc_id = d.doc_id
), b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, greatest(n_words, 1) AS k FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / k BETWEEN {{low_mean}} AND {{high_mean}} AND n_symbols / k <= {{symbols}} AND st / k >= {{stops}} AND n_dup_lines / greatest(n_lines, 1) <= {{lines}} AS kept
FROM b
"""


def op8() -> str:
    from tidemark.llm.quality_rules import RULES

    of = {r.measure: r for r in RULES}
    text = _op8()
    for name, value in {"low_mean": of["mean_word_chars"].low, "high_mean": of["mean_word_chars"].high, "symbols": of["symbol_ratio"].high, "stops": of["stop_ratio"].low, "lines": of["dup_line_ratio"].high}.items():
        text = text.replace("{" + name + "}", str(value))
    return text


ORACLE_SQL = {"op1_ngram_jaccard_join": OP1, "op2_benchmark_decontamination": OP2, "op4_url_filters": OP4, "op5_chat_formatting": OP5, "op8_quality_rules": op8()}
