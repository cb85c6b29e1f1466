"""The queries of :mod:`quirework.plans.reference` as SQL for DuckDB."""

from __future__ import annotations

from quirework.functions.dates import TERMS
from quirework.operators.boundaries import FLAT, TREE_IF_STRUCTURED
from quirework.operators.recovery import COVERS, DATE_TITLES

PG = "pg AS (SELECT DISTINCT page_id, bundle_id, page, page_type, is_document_start, document_title, printed_label, running_header, first_continues, status, ink_ratio, cross_references, contract_documents_list, call_key FROM pages)"
BL = "bl AS (SELECT DISTINCT block_key, bundle_id, page, idx, block_id, kind, number, title, text, legibility, source, call_key FROM blocks)"
CL = "cl AS (SELECT DISTINCT * EXCLUDE (loaded_at) FROM clauses)"


def clean(x: str) -> str:
    return f"""trim(regexp_replace(translate(coalesce({x}, ''), '‐‑‒–—―−‘’“”', '-------''''""'), '\\s+', ' ', 'g'))"""


def roman(r: str) -> str:
    v = lambda i: f"CASE substr({r}, {i}, 1) WHEN 'i' THEN 1 WHEN 'v' THEN 5 WHEN 'x' THEN 10 WHEN 'l' THEN 50 WHEN 'c' THEN 100 WHEN 'd' THEN 500 WHEN 'm' THEN 1000 END"
    total = f"list_sum(list_transform(range(1, length({r}) + 1), lambda i: CASE WHEN ({v('i')}) < coalesce(list_max(list_transform(range(i + 1, length({r}) + 1), lambda j: {v('j')})), 0) THEN -({v('i')}) ELSE ({v('i')}) END))"
    return f"CASE WHEN regexp_matches({r}, '^[ivxlcdm]+$') AND {total} BETWEEN 1 AND 399 THEN ({total})::int END"


def label(c: str) -> tuple[str, str]:
    """Prefix and value of a printed label."""
    s = f"lower({clean(c)})"
    r = roman(f"regexp_extract({s}, '^[-–\\s]*([ivxlc]+)[-–\\s.]*$', 1)")
    w = r"^([a-z][a-z/ ]*?)\s*[-/ ]\s*(\d+)$"
    prefix = f"CASE WHEN regexp_matches({s}, 'page\\s*\\d+') THEN '' WHEN ({r}) IS NOT NULL THEN 'roman' WHEN regexp_matches({s}, '{w}') THEN trim(regexp_extract({s}, '{w}', 1)) WHEN regexp_matches({s}, '\\d') THEN left(regexp_replace({s}, '[\\d\\s\\-–.of]+', '', 'g'), 10) END"
    value = f"CASE WHEN regexp_matches({s}, 'page\\s*\\d+') THEN regexp_extract({s}, 'page\\s*(\\d+)', 1)::int WHEN ({r}) IS NOT NULL THEN ({r}) WHEN regexp_matches({s}, '{w}') THEN regexp_extract({s}, '{w}', 2)::int WHEN regexp_matches({s}, '\\d') THEN regexp_extract({s}, '(\\d+)', 1)::int END"
    return prefix, value


def index(t: str) -> str:
    return f"CASE WHEN regexp_matches({t}, '^\\d+$') THEN regexp_replace({t}, '^0+(\\d)', '\\1') WHEN ({roman(t)}) IS NOT NULL AND (length({t}) > 1 OR {t} IN ('i', 'v', 'x')) THEN ({roman(t)})::varchar ELSE {t} END"


_ATT = r"\b(annexure|annex|appendix|schedule|exhibit|attachment|enclosure|form)\b\s*[-.:]?\s*(?:no\.?\s*)?([a-z0-9]{1,6})\b"
KEY = f"""SELECT *, CASE WHEN k0 = '' OR (k0 = 'form' AND i0 IN ('of', 'for')) THEN NULL WHEN k0 = 'annex' THEN 'annexure' ELSE k0 END AS kind, CASE WHEN k0 = '' OR (k0 = 'form' AND i0 IN ('of', 'for')) THEN NULL ELSE {index('i0')} END AS idx
 FROM (SELECT *, regexp_extract(low, '{_ATT}', 1) AS k0, regexp_extract(low, '{_ATT}', 2) AS i0 FROM (SELECT *, lower({clean('ref')}) AS low FROM (%s)))"""

_MARK = r"^(annexure|annex|appendix|schedule|exhibit|attachment|form|format|enclosure|part)(?:ure|ures|s)?\b\s*[-.:]?\s*(?:no\.?\s*)?([a-z0-9]+)\b"
MARKER = f"""SELECT * EXCLUDE (m, low, fixed, k0, i0, rest, paren, num),
  CASE WHEN m = '' THEN NULL WHEN k0 <> '' THEN CASE k0 WHEN 'annex' THEN 'annexure' WHEN 'format' THEN 'form' ELSE k0 END || ':' || {index('i0')} WHEN paren <> '' THEN '(' || paren || ')' WHEN regexp_matches(fixed, '^\\d+(\\.\\d+)*$') THEN num WHEN rest <> '' THEN rest END AS key
FROM (SELECT *, CASE WHEN regexp_matches(rest, '^\\(?\\s*([a-z]{{1,4}}|\\d{{1,3}})\\s*\\)$') THEN regexp_extract(rest, '^\\(?\\s*([a-z]{{1,4}}|\\d{{1,3}})\\s*\\)$', 1) WHEN regexp_matches(rest, '^\\(\\s*([a-z]{{1,4}}|\\d{{1,3}})\\s*\\)?$') THEN regexp_extract(rest, '^\\(\\s*([a-z]{{1,4}}|\\d{{1,3}})\\s*\\)?$', 1) ELSE regexp_extract(rest, '^([a-z])$', 1) END AS paren,
    regexp_replace(regexp_replace(fixed, '(\\d)\\.0$', '\\1'), '(^|\\.)0+(\\d)', '\\1\\2', 'g') AS num
  FROM (SELECT *, CASE WHEN regexp_extract(low, '{_MARK}', 2) IN ('of', 'for', 'to') THEN '' ELSE regexp_extract(low, '{_MARK}', 1) END AS k0, regexp_extract(low, '{_MARK}', 2) AS i0,
      regexp_replace(regexp_replace(CASE WHEN regexp_matches(low, '^(?:article|clause|section|chapter|sub-clause|para|paragraph|rule)\\s*[-.:]?\\s*(?:no\\.?\\s*)?(.+)$') THEN trim(regexp_extract(low, '^(?:article|clause|section|chapter|sub-clause|para|paragraph|rule)\\s*[-.:]?\\s*(?:no\\.?\\s*)?(.+)$', 1)) ELSE low END, '\\s*\\.\\s*', '.', 'g'), '^[. ]+|[. ]+$', '', 'g') AS rest
    FROM (SELECT *, regexp_replace(lower(m), '^[ :–-]+|[ :–-]+$', '', 'g') AS low, CASE WHEN regexp_matches(f0, '\\d') AND length(regexp_replace(f0, '[\\d.]', '', 'g')) <= greatest(1, length(f0) // 3) THEN translate(f0, 'lI|OoS', '111005') ELSE f0 END AS fixed
      FROM (SELECT *, regexp_replace(regexp_replace(m, '^[ :–.)-]+|[ :–.)-]+$', '', 'g'), '\\s+', '', 'g') AS f0 FROM (SELECT *, {clean('marker')} AS m FROM (%s))))))"""

_P0, _V0 = label("printed_label")
PREV = f"""{PG}, lab AS (SELECT *, {_P0} AS lp, {_V0} AS lv FROM pg),
prev AS (SELECT *, last_value(CASE WHEN status NOT IN ('blank', 'failed') THEN {{'page': page, 'lp': lp, 'lv': lv, 'hdr': running_header, 'pt': page_type}} END IGNORE NULLS) OVER (PARTITION BY bundle_id, run ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
  FROM (SELECT *, page - row_number() OVER (PARTITION BY bundle_id ORDER BY page) AS run FROM lab))"""
_HC = f"lower({clean('running_header')})"
_HP = f"lower({clean('p.hdr')})"
STARTS = f"""{PREV}, st AS (SELECT bundle_id, page AS start_page, page_type AS doc_type, coalesce(document_title, '[' || replace(page_type, '_', ' ') || ']') AS title,
    concat_ws(', ', CASE WHEN is_document_start THEN 'title' END, CASE WHEN reset THEN 'label reset' END, CASE WHEN change THEN 'header change' END) AS evidence, is_document_start, cont
  FROM (SELECT *, coalesce(lv = 1, false) AND NOT coalesce(p.lp = lp AND lv = p.lv + 1, false) AS reset, coalesce(p.lp = lp AND lv = p.lv + 1, false) AS cont, {_HC} <> '' AND {_HP} <> '' AND {_HC} <> {_HP} AS change, page = min(page) OVER (PARTITION BY bundle_id) AS first FROM prev)
  WHERE status <> 'blank' AND (first OR is_document_start OR reset OR change)),
seg AS (SELECT s.bundle_id, format('D{{:02d}}', row_number() OVER w) AS segment_id, doc_type, start_page, coalesce(lead(start_page) OVER w - 1, last) AS end_page FROM st s JOIN (SELECT bundle_id, max(page) AS last FROM pg GROUP BY 1) USING (bundle_id) WINDOW w AS (PARTITION BY bundle_id ORDER BY start_page))"""
OK_JSON = "outc AS (SELECT *, CASE WHEN finish_reason = 'MAX_TOKENS' THEN 'truncated' WHEN finish_reason IN ('SAFETY', 'RECITATION', 'OTHER') THEN 'blocked' WHEN response_json IS NULL OR trim(response_json) = '' THEN 'empty' WHEN json_valid(response_json) THEN 'ok' ELSE 'invalid' END AS outcome FROM (SELECT DISTINCT ON (cache_key) * FROM replay WHERE cache_key IS NOT NULL ORDER BY cache_key, called_at DESC, response_json))"
_MONTHS = "'jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'"
_MN = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_LIT = rf"(?i)(\b\d{{1,2}}(?:st|nd|rd|th)?\s+{_MN}\.?,?\s+\d{{4}}\b|\b{_MN}\.?\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{4}}\b|\b\d{{1,2}}[/\-.]\d{{1,2}}[/\-.]\d{{2,4}}\b|\b\d{{4}}-\d{{2}}-\d{{2}}\b)"
_SHINGLE = f"""{BL}, body AS (SELECT bundle_id, page, string_agg(text, chr(10) ORDER BY idx, text) AS t FROM bl WHERE kind NOT IN ('header', 'footer', 'page_number', 'stamp_or_seal', 'signature_block') AND text IS NOT NULL GROUP BY 1, 2),
w AS (SELECT bundle_id, page, list_filter(string_split(trim(regexp_replace(regexp_replace(regexp_replace(lower({clean('t')}), '\\[illegible\\]', ' ', 'g'), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s.()-]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM body),
g AS (SELECT DISTINCT bundle_id, page, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM w WHERE len(w) >= 5),
n AS (SELECT bundle_id, page, count(*) AS n FROM g GROUP BY 1, 2)"""

_LEAD = r"(?i)^\s*((?:article|clause|section|chapter|part|annexure|appendix|schedule|form)\s*[-.:]?\s*[\w.]+|\(?[a-z]{1,4}\)|\(?\d{1,3}\)|\d+(?:\s*\.\s*\d+)*\.?|[a-z]\.)"
_NUM = f"num AS (SELECT b.*, g.segment_id, g.doc_type FROM bl b JOIN seg g ON g.bundle_id = b.bundle_id AND b.page BETWEEN g.start_page AND g.end_page WHERE kind IN ('heading', 'clause'))"
_LEVELS = f"""{STARTS}, {BL}, {_NUM}, keyed AS ({MARKER % f"SELECT bundle_id, segment_id, page, idx, kind, coalesce(number, CASE WHEN regexp_extract({clean('text')}, '{_LEAD}', 1) <> '' THEN trim(regexp_extract({clean('text')}, '{_LEAD}', 1)) END) AS marker FROM num"}),
own AS (SELECT *, CASE WHEN regexp_matches(key, '^\\d+(\\.\\d+)*$') THEN greatest(1, least(length(key) - length(replace(key, '.', '')) + 1, 5)) WHEN kind = 'heading' THEN 1 END AS own FROM keyed),
runs AS (SELECT *, count(own) OVER (PARTITION BY bundle_id, segment_id ORDER BY page, idx ROWS UNBOUNDED PRECEDING) AS run FROM own),
lv AS (SELECT *, least(coalesce(first_value(own) OVER w, 1) + row_number() OVER w - CASE WHEN first_value(own) OVER w IS NOT NULL THEN 1 ELSE 0 END, 5)::int AS wanted FROM runs WINDOW w AS (PARTITION BY bundle_id, segment_id, run ORDER BY page, idx ROWS UNBOUNDED PRECEDING)),
p0 AS (SELECT *, row_number() OVER (PARTITION BY bundle_id, segment_id ORDER BY page, idx)::int AS pos FROM lv)"""
_LAST = lambda c, k, cond="level = {k}": f"last_value(CASE WHEN {cond.format(k=k)} THEN {c} END IGNORE NULLS) OVER (PARTITION BY bundle_id, segment_id ORDER BY pos ROWS UNBOUNDED PRECEDING)"
_OPEN = lambda k: f"last_value(CASE WHEN wanted <= {k} THEN pos END IGNORE NULLS) OVER (PARTITION BY bundle_id, segment_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_Q = lambda c, n: f"left(replace({clean(c)}, chr(34), chr(39)), {n})"

_TREE = f"""{_LEVELS}, p1 AS (SELECT *, (pos + least(0, min(greatest(1, wanted) - pos) OVER (PARTITION BY bundle_id, segment_id ORDER BY pos ROWS UNBOUNDED PRECEDING)))::int AS level FROM p0),
 nodes AS (SELECT p1.*, b.title, b.number, b.text, trim(concat_ws(' ', b.number, CASE WHEN coalesce(b.title, '') <> '' THEN b.title WHEN length(b.text) > 70 THEN left(b.text, 70) || '...' ELSE b.text END)) AS label FROM p1 JOIN bl b USING (bundle_id, page, idx)),
 spans AS (SELECT n.bundle_id, n.segment_id, n.pos, n.level, n.label, n.page, coalesce((SELECT min(m.pos) FROM nodes m WHERE m.bundle_id = n.bundle_id AND m.segment_id = n.segment_id AND m.pos > n.pos AND m.level <= n.level), 1000000000) AS stop FROM nodes n)"""
_NORM = lambda t: f"trim(regexp_replace(regexp_replace(regexp_replace(lower({clean(t)}), '\\[illegible\\]', ' ', 'g'), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s.()-]', ' ', 'g'), '\\s+', ' ', 'g'))"
_HINT = f"""CASE WHEN key IS NULL THEN '-' WHEN regexp_matches(key, '^\\d+(\\.\\d+)*$') THEN 'dotted-' || (length(key) - length(replace(key, '.', '')) + 1)::varchar WHEN key LIKE '(%' AND regexp_matches(inn, '^\\d+$') THEN 'paren-number' WHEN key LIKE '(%' AND ({roman('inn')}) IS NOT NULL AND (length(inn) > 1 OR inn IN ('i', 'v', 'x')) THEN 'roman-or-alpha'
   WHEN key LIKE '(%' THEN 'alpha' WHEN contains(key, ':') THEN split_part(key, ':', 1) ELSE 'named' END"""
_ANCHORS = f"""a0 AS ({MARKER % "SELECT bundle_id, segment_id AS division_id, number AS marker, coalesce(title, '') AS title, page FROM num WHERE kind = 'clause' AND number IS NOT NULL"}),
 a1 AS (SELECT bundle_id, division_id, key, min(page) AS page, arg_min(marker, (page, marker)) AS marker FROM a0 GROUP BY 1, 2, 3)"""
_BEGINS = lambda t, p: f"list_transform(range(1, len(regexp_extract_all({t}, '{p}')) + 1), lambda i: 1 + list_sum(list_transform(string_split_regex({t}, '{p}')[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(regexp_extract_all({t}, '{p}')[1:i - 1], lambda x: length(x))), 0))"
_TERMS = TERMS.replace("'", "''")
_NEAR = lambda t: f"list_sum(list_transform({_BEGINS(t, _TERMS)}, lambda a: len(list_filter({_BEGINS(t, _LIT)}, lambda b: abs(a - b) <= 200))))::int"

_FLAT = ", ".join(f"'{x}'" for x in FLAT)
_SOME = ", ".join(f"'{x}'" for x in TREE_IF_STRUCTURED)
_LINE1 = lambda c: clean(f"string_split_regex(trim({c}), '\\r\\n|[\\n\\r]')[1]")

ORACLES = {
    "review_pages": f"""WITH {STARTS}, {BL}, r AS (SELECT v.bundle_id, v.page, v.p.page AS against_page, s.start_page IS NOT NULL AS listed, coalesce(v.first_continues, false) AS goes, v.page <> min(v.page) OVER (PARTITION BY v.bundle_id) AND (s.start_page IS NOT NULL OR (v.status = 'ok' AND v.is_document_start)) AS pick FROM prev v LEFT JOIN st s ON s.bundle_id = v.bundle_id AND s.start_page = v.page),
 k AS (SELECT *, row_number() OVER (PARTITION BY bundle_id ORDER BY page) AS rank FROM r WHERE pick), c AS (SELECT * FROM k WHERE rank <= 120)
 SELECT bundle_id, 'warning' AS severity, 'illegible_heading' AS code, legibility || ' heading: ' || left(coalesce(text, ''), 80) AS message, page::varchar AS pages FROM bl WHERE kind IN ('heading', 'clause') AND legibility <> 'clear'
 UNION ALL SELECT bundle_id, 'error', 'page_unreadable', 'page ' || page || ' could not be read', page::varchar FROM pg WHERE status = 'failed'
 UNION ALL SELECT bundle_id, 'warning', 'boundary_checks_capped', count(*) || ' boundaries to check, 120 were', '' FROM k GROUP BY bundle_id HAVING count(*) > 120
 UNION ALL SELECT bundle_id, 'info', 'no_contract_documents_list', 'no page lists the documents of the contract', '' FROM pg GROUP BY bundle_id HAVING max(coalesce(len(contract_documents_list), 0)) = 0
 UNION ALL SELECT bundle_id, 'info', 'boundary_removed', 'page ' || page || ' continues page ' || coalesce(against_page::varchar, '-'), page::varchar FROM c WHERE listed AND goes
 UNION ALL SELECT bundle_id, 'info', 'boundary_added', 'page ' || page || ' starts a document', page::varchar FROM c WHERE NOT listed AND NOT goes AND against_page IS NOT NULL
 UNION ALL SELECT bundle_id, 'warning', 'boundary_unclear', 'no page before page ' || page, page::varchar FROM c WHERE NOT goes AND against_page IS NULL""",
    "unduplicated_segments": f"WITH {STARTS}, {_SHINGLE}, dup AS (SELECT count(*) AS n FROM g a JOIN g b ON a.bundle_id = b.bundle_id AND a.g = b.g AND a.page < b.page JOIN n x ON x.bundle_id = a.bundle_id AND x.page = a.page JOIN n y ON y.bundle_id = b.bundle_id AND y.page = b.page WHERE y.n >= 30 GROUP BY a.bundle_id, a.page, b.page, x.n, y.n HAVING count(*) / (x.n + y.n - count(*)) >= 0.9) SELECT bundle_id, segment_id, doc_type, start_page, end_page FROM seg WHERE (SELECT count(*) FROM dup) = 0",
    "tree_needed": f"WITH {STARTS}, {BL}, {_NUM}, n AS (SELECT bundle_id, segment_id, count(*) AS n FROM num GROUP BY 1, 2) SELECT bundle_id, segment_id, coalesce(n, 0) AS n_candidates, CASE WHEN doc_type IN ({_FLAT}) THEN false WHEN doc_type IN ({_SOME}) THEN coalesce(n, 0) >= 2 ELSE coalesce(n, 0) >= 1 END AS needed FROM seg LEFT JOIN n USING (bundle_id, segment_id)",
    "outlines": f"WITH {_TREE} SELECT bundle_id, segment_id, string_agg(repeat('  ', level - 1) || label, chr(10) ORDER BY pos) AS outline FROM spans WHERE level <= 2 GROUP BY 1, 2",
    "heading_titles": f"""WITH {CL}, a AS (SELECT clause_id, title, {clean('marker')} AS m, {_LINE1("coalesce(text, '')")} AS l FROM cl), b AS (SELECT *, CASE WHEN m <> '' AND starts_with(lower(l), lower(m)) THEN regexp_replace(substr(l, length(m) + 1), '^[ .:)-]+', '') ELSE l END AS x FROM a),
 c AS (SELECT *, CASE WHEN regexp_extract(x, '^(.*?[.:;])\\s', 1) = '' THEN x ELSE regexp_extract(x, '^(.*?[.:;])\\s', 1) END AS h FROM b), e AS (SELECT *, trim(CASE WHEN length(h) <= 90 THEN h ELSE left(x, 90) END) AS t, {clean('title')} AS ct FROM c)
 SELECT clause_id, CASE WHEN t <> '' THEN t END AS from_text, CASE WHEN length(trim(regexp_extract(ct, '(?is)^(.*?\\S)\\s*section\\s*-?\\s*\\d', 1))) >= 10 THEN trim(regexp_extract(ct, '(?is)^(.*?\\S)\\s*section\\s*-?\\s*\\d', 1)) ELSE ct END AS title FROM e""",
    "tree_chunks": f"""WITH {STARTS}, {BL}, {_NUM}, p AS (SELECT bundle_id, segment_id, row_number() OVER w::int AS pos, greatest(count(*) FILTER (number IS NULL) OVER (PARTITION BY bundle_id, segment_id ORDER BY page, idx ROWS UNBOUNDED PRECEDING) - 1, 0) // 4 AS chunk FROM num WINDOW w AS (PARTITION BY bundle_id, segment_id ORDER BY page, idx))
 SELECT bundle_id, segment_id, pos, chunk::int AS chunk, greatest(1, min(pos) OVER (PARTITION BY bundle_id, segment_id, chunk) - 2)::int AS context_from FROM p""",
    "boundary_verdicts": f"""WITH {STARTS}, r AS (SELECT v.bundle_id, v.page, v.p.page AS against_page, v.first_continues, v.page <> min(v.page) OVER (PARTITION BY v.bundle_id) AND (s.start_page IS NOT NULL OR (v.status = 'ok' AND v.is_document_start)) AS pick FROM prev v LEFT JOIN st s ON s.bundle_id = v.bundle_id AND s.start_page = v.page),
 k AS (SELECT *, row_number() OVER (PARTITION BY bundle_id ORDER BY page) AS rank FROM r WHERE pick), v AS (SELECT bundle_id, page AS start_page, CASE WHEN first_continues THEN 'continuation' WHEN against_page IS NULL THEN 'unclear' ELSE 'new_document' END AS verdict FROM k WHERE rank <= 120)
 SELECT bundle_id, start_page, doc_type, verdict = 'new_document' AS boundary_verified FROM st LEFT JOIN v USING (bundle_id, start_page) WHERE verdict IS NULL OR verdict <> 'continuation'
 UNION ALL SELECT v.bundle_id, v.start_page, page_type, true FROM v JOIN pg ON pg.bundle_id = v.bundle_id AND pg.page = v.start_page WHERE verdict = 'new_document' AND NOT EXISTS (SELECT 1 FROM st WHERE st.bundle_id = v.bundle_id AND st.start_page = v.start_page)""",
    "toc_fold": f"""WITH RECURSIVE {STARTS}, g AS (SELECT seg.bundle_id, upper(doc_type) AS t, lower({clean('running_header')}) AS h, start_page, end_page, row_number() OVER (PARTITION BY seg.bundle_id ORDER BY start_page) AS i FROM seg JOIN pg ON pg.bundle_id = seg.bundle_id AND pg.page = start_page),
 f AS (SELECT bundle_id, i, 1 AS grp, t AS kept, h AS head, false AS folds FROM g WHERE i = 1 UNION ALL
  SELECT bundle_id, i, CASE WHEN yes THEN grp ELSE grp + 1 END, CASE WHEN yes THEN kept ELSE t END, CASE WHEN yes THEN head ELSE h END, yes FROM (
   SELECT g.bundle_id, g.i, f.grp, f.kept, f.head, g.t, g.h, g.t = 'SCHEDULE' AND f.kept IN ('GENERAL_CONDITIONS', 'SPECIAL_CONDITIONS', 'TECHNICAL_SPECIFICATION', 'ANNEXURE') AND NOT (g.h <> '' AND f.head <> '' AND NOT contains(g.h, f.head) AND NOT contains(f.head, g.h)) AS yes FROM f JOIN g ON g.bundle_id = f.bundle_id AND g.i = f.i + 1))
 SELECT bundle_id, format('DIV-{{:02d}}', grp::bigint) AS division_id, arg_min(t, i) AS division_type, min(start_page) AS start_page, max(end_page) AS end_page, sum(folds::int)::bigint AS n_folded FROM f JOIN g USING (bundle_id, i) GROUP BY bundle_id, grp""",
    "unit_ranges": f"""WITH {STARTS}, {BL}, {_NUM}, {_ANCHORS}, a2 AS (SELECT *, regexp_matches(key, '^\\(?\\d+\\)?$') AS plain FROM a1), a3 AS (SELECT * FROM (SELECT *, max(plain::int) OVER (PARTITION BY bundle_id, division_id) AS any_plain FROM a2) WHERE plain OR any_plain = 0),
 d AS (SELECT bundle_id, segment_id AS division_id, start_page, end_page FROM seg), u AS (SELECT a.bundle_id, a.division_id, 'clause' AS kind, marker, page AS page_start, CASE WHEN nx IS NULL THEN end_page ELSE greatest(page, nx - 1) END AS page_end, coalesce(nx = page, false) AS shares_start_page
   FROM (SELECT *, lead(page) OVER (PARTITION BY bundle_id, division_id ORDER BY page, key) AS nx FROM a3) a JOIN d USING (bundle_id, division_id)),
 l AS (SELECT d.*, (SELECT min(page) FROM a3 WHERE a3.bundle_id = d.bundle_id AND a3.division_id = d.division_id) AS first FROM d),
 x AS (SELECT * FROM u UNION ALL SELECT bundle_id, division_id, 'preamble', NULL, start_page, first - 1, false FROM l WHERE first > start_page UNION ALL SELECT bundle_id, division_id, 'whole', NULL, start_page, end_page, false FROM l WHERE first IS NULL)
 SELECT bundle_id, division_id, division_id || format('-U{{:02d}}', row_number() OVER (PARTITION BY bundle_id, division_id ORDER BY page_start, marker NULLS FIRST)) AS unit_id, kind, marker, page_start, page_end, shares_start_page FROM x""",
    "template_coverage": f"""WITH {STARTS}, {BL}, {_NUM}, k0 AS ({MARKER % "SELECT bundle_id || '/' || segment_id AS segment_key, doc_type, number AS marker, coalesce(title, text) AS body FROM num"}), k AS (SELECT segment_key, doc_type, coalesce(key, '') || '|' || left({_NORM('body')}, 60) AS key FROM k0 WHERE body IS NOT NULL),
 g AS (SELECT segment_key, doc_type, list_sort(list(DISTINCT key)) AS keys FROM k GROUP BY 1, 2), t AS (SELECT DISTINCT doc_type, doc_type || '_' || left(sha256(to_json(keys)::varchar), 16) AS template_id, unnest(keys) AS key FROM g WHERE len(keys) >= 15),
 c AS (SELECT * FROM k WHERE length(key) > 1), n AS (SELECT segment_key, count(*) AS n FROM c GROUP BY 1), h AS (SELECT segment_key, template_id, count(*) AS hits FROM c JOIN t USING (doc_type, key) GROUP BY 1, 2)
 SELECT segment_key, template_id, hits / n AS coverage, hits / n >= 0.9 AS reused FROM (SELECT *, row_number() OVER (PARTITION BY segment_key ORDER BY hits DESC, template_id) AS r FROM h) JOIN n USING (segment_key) WHERE r = 1""",
    "page_end_rollup": f"""WITH {_TREE}, o AS (SELECT bundle_id, segment_id, owner_pos AS pos, max(page) AS last FROM (SELECT b.*, g.segment_id, sum((kind IN ('heading', 'clause'))::int) OVER (PARTITION BY b.bundle_id, segment_id ORDER BY b.page, idx ROWS UNBOUNDED PRECEDING) AS owner_pos FROM bl b JOIN seg g ON g.bundle_id = b.bundle_id AND b.page BETWEEN g.start_page AND g.end_page WHERE kind IN ('clause', 'paragraph', 'recital', 'table', 'heading', 'handwritten')) GROUP BY 1, 2, 3)
 SELECT s.bundle_id, s.segment_id, s.pos, max(o.last) AS page_end FROM spans s JOIN o ON o.bundle_id = s.bundle_id AND o.segment_id = s.segment_id AND o.pos >= s.pos AND o.pos < s.stop GROUP BY 1, 2, 3""",
    "full_texts": f"""WITH {_TREE}, t AS (SELECT bundle_id, segment_id, pos, CASE WHEN kind = 'heading' THEN {clean('text')} ELSE coalesce(text, '') END AS t FROM nodes)
 SELECT s.bundle_id, s.segment_id, s.pos, md5(coalesce(string_agg(t, chr(10) || chr(10) ORDER BY t.pos) FILTER (t <> ''), '')) AS digest FROM spans s JOIN t ON t.bundle_id = s.bundle_id AND t.segment_id = s.segment_id AND t.pos >= s.pos AND t.pos < s.stop GROUP BY 1, 2, 3""",
    "path_titles": f"""WITH {_TREE} SELECT s.bundle_id, s.segment_id, s.pos, string_agg(a.label, ' > ' ORDER BY a.level) AS path_titles FROM spans s JOIN spans a ON a.bundle_id = s.bundle_id AND a.segment_id = s.segment_id AND s.pos >= a.pos AND s.pos < a.stop GROUP BY 1, 2, 3""",
    "toc_lines": f"""WITH {_TREE} SELECT bundle_id, segment_id, string_agg(repeat('  ', level - 1) || '- ' || label || ' (p. ' || page::varchar || ')', chr(10) ORDER BY pos) AS toc FROM spans WHERE level <= 3 GROUP BY 1, 2""",
    "candidate_lines": f"""WITH {STARTS}, {BL}, {_NUM}, k AS ({MARKER % f"SELECT block_key, block_id, page, kind, number, text, coalesce(number, CASE WHEN kind = 'clause' AND regexp_extract({clean('text')}, '{_LEAD}', 1) <> '' THEN trim(regexp_extract({clean('text')}, '{_LEAD}', 1)) END) AS marker FROM num"}), x AS (SELECT *, CASE WHEN key LIKE '(%' THEN key[2:-2] END AS inn FROM k)
 SELECT block_key, concat_ws(' | ', block_id, 'p' || page::varchar, kind, CASE WHEN {clean('number')} <> '' THEN {clean('number')} ELSE '-' END, left(replace({clean('text')}, '|', '/'), 160), {_HINT}) AS line FROM x""",
    "date_candidates": f"WITH {CL}, h AS (SELECT clause_id, {_NEAR('text')} AS hits FROM cl WHERE regexp_matches(text, '{_TERMS}') AND regexp_matches(text, '{_LIT}')) SELECT * FROM h WHERE hits > 0",
    "date_sources": f"""WITH {STARTS}, {CL}, c AS (SELECT DISTINCT bundle_id, unnest(range(start_page, end_page + 1))::int AS page FROM seg WHERE upper(doc_type) IN ({', '.join(f"'{x}'" for x in COVERS)})),
 u AS (SELECT bundle_id, clause_id AS unit_id, page_start, text, {' OR '.join(f"contains(lower(concat_ws(' ', title, marker)), '{w}')" for w in DATE_TITLES)} AS hint FROM cl WHERE trim(coalesce(text, '')) <> '' AND NOT EXISTS (SELECT 1 FROM c WHERE c.bundle_id = cl.bundle_id AND c.page = cl.page_start)),
 h AS (SELECT *, CASE WHEN regexp_matches(text, '{_TERMS}') AND regexp_matches(text, '{_LIT}') THEN {_NEAR('text')} ELSE 0 END AS hits FROM u) SELECT bundle_id, unit_id, page_start, (hits + CASE WHEN hint THEN 2 ELSE 0 END)::int AS score FROM h WHERE hint OR hits > 0""",
    "follow_markers": f"""WITH {CL}, c AS ({MARKER % "SELECT contract_id::varchar || '/' || division_id AS division_id, clause_id::varchar AS unit_id, regexp_extract(marker, '^\\s*(\\d+)\\.?\\s*$', 1) AS plain, page_start, page_end, seq, marker FROM cl"}),
 o AS (SELECT division_id, plain, min(unit_id) AS u, min(page_start) AS s, max(page_end) AS e FROM c WHERE plain <> '' GROUP BY 1, 2 HAVING count(*) = 1), b AS (SELECT c.division_id, c.unit_id, c.seq, c.page_start AS page, regexp_extract(coalesce(key, ''), '^(\\d+)(?:\\.\\d+)+$', 1) AS head FROM c),
 m AS (SELECT b.*, CASE WHEN head = '' THEN NULL WHEN o.u IS NOT NULL AND page BETWEEN s - 2 AND e + 2 THEN o.u ELSE unit_id END AS stated FROM b LEFT JOIN o ON o.division_id = b.division_id AND o.plain = b.head)
 SELECT unit_id <> coalesce(last_value(stated IGNORE NULLS) OVER (PARTITION BY division_id ORDER BY seq, unit_id ROWS UNBOUNDED PRECEDING), unit_id) AS moved FROM m""".replace("SELECT unit_id <> coalesce", "SELECT moved, count(*) AS n FROM (SELECT unit_id <> coalesce") + ") GROUP BY 1",
    "tree_paths": f"""WITH {_LEVELS}, p1 AS (SELECT *, (pos + least(0, min(greatest(1, wanted) - pos) OVER (PARTITION BY bundle_id, segment_id ORDER BY pos ROWS UNBOUNDED PRECEDING)))::int AS level FROM p0),
 p2 AS (SELECT *, CASE level {' '.join(f"WHEN {k} THEN {_LAST('pos', k - 1)}" for k in range(2, 6))} END AS parent_pos FROM p1), p3 AS (SELECT *, row_number() OVER (PARTITION BY bundle_id, segment_id, parent_pos ORDER BY pos)::int AS ordinal FROM p2)
 SELECT bundle_id, segment_id, pos, wanted, level, parent_pos, ordinal, concat_ws('.', {', '.join(f"CASE WHEN level >= {k} THEN {_LAST('ordinal', k)} END" for k in range(1, 6))}) AS path FROM p3""",
    "sibling_groups": f"""WITH {_LEVELS} SELECT bundle_id, segment_id, pos, wanted AS level, coalesce((CASE wanted {' '.join(f"WHEN {k} THEN {_OPEN(k - 1)}" for k in range(2, 6))} END)::varchar, 'root') || '@' || wanted AS group_key FROM p0""",
    "anchor_collect": f"""WITH {STARTS}, {BL}, {_NUM}, a AS ({MARKER % "SELECT bundle_id, segment_id AS division_id, number AS marker, coalesce(title, '') AS title, page FROM num WHERE kind = 'clause' AND number IS NOT NULL"}), b AS (SELECT *, 'clause:' || key AS anchor_key, {clean('title')} AS t FROM a)
 SELECT bundle_id, division_id, anchor_key, min(page) AS page, arg_max(t, (length(t), t)) AS title, count(DISTINCT page) > 1 AS ambiguous FROM b GROUP BY 1, 2, 3""",
    "division_map": f"""WITH {PG}, i AS (SELECT DISTINCT ON (bundle_id, page) bundle_id, page, page_type AS division_type, document_title AS title, running_header, first_continues AS mid, page_type = 'stamp_paper' AS cover FROM pg WHERE is_document_start AND document_title IS NOT NULL ORDER BY bundle_id, page, length({clean('document_title')}) DESC, page_id),
 t AS (SELECT bundle_id, max(page) AS total FROM pg GROUP BY 1), r AS (SELECT * FROM i UNION ALL SELECT bundle_id, 1, 'RECITALS', 'Front matter', NULL, false, false FROM t WHERE bundle_id NOT IN (SELECT bundle_id FROM i WHERE page = 1))
 SELECT bundle_id, format('DIV-{{:02d}}', row_number() OVER w) AS division_id, division_type, {clean('title')} AS title, running_header, page AS start_page, coalesce(lead(page) OVER w - 1, total) AS end_page, row_number() OVER w::int AS position,
  concat_ws(',', CASE WHEN mid THEN 'mid_page_start' END, CASE WHEN cover THEN 'cover_sheet' END, CASE WHEN lead(division_type) OVER w = division_type AND lead(page) OVER w - page <= 2 THEN 'possible_overlap_split' END) AS flags FROM r JOIN t USING (bundle_id) WINDOW w AS (PARTITION BY bundle_id ORDER BY page)""",
    "card_lines": f"""WITH {PG}, {BL}, b AS (SELECT bundle_id, page, arg_min(text, idx) AS first, left(coalesce(string_agg({_Q('text', 50)}, '; ' ORDER BY idx) FILTER (kind IN ('heading', 'clause')), ''), 260) AS heads FROM bl WHERE kind NOT IN ('header', 'footer', 'page_number') AND text IS NOT NULL GROUP BY 1, 2)
 SELECT page_id, CASE WHEN status = 'blank' THEN '[p' || page || '] BLANK' WHEN status = 'failed' THEN '[p' || page || '] UNREADABLE' ELSE '[p' || page || '] type=' || page_type || ' start=' || CASE WHEN is_document_start THEN 'Y' ELSE 'N' END || ' label="' || {_Q('printed_label', 20)} || '" hdr="' || {_Q('running_header', 50)} || '" cont=' || CASE WHEN first_continues THEN 'Y' ELSE 'N' END
   || ' title="' || {_Q('document_title', 90)} || '" first="' || {_Q('first', 90)} || '" heads=' || coalesce(heads, '') || ' refs=' || coalesce(array_to_string(list_transform(cross_references[1:5], lambda x: {_Q('x', 40)}), ', '), '') END AS card FROM pg LEFT JOIN b USING (bundle_id, page)""",
    "page_contexts": f"""WITH {CL}, x AS (SELECT bundle_id, page_start, clause_id::varchar AS unit_id, concat_ws(' ', kind, marker, CASE WHEN title IS NOT NULL THEN chr(39) || left({clean('title')}, 60) || chr(39) END) AS line, unnest(range(page_start, page_end + 1))::int AS page FROM cl WHERE page_end >= page_start) SELECT bundle_id, page, string_agg(line, '; ' ORDER BY page_start, unit_id) AS hint FROM x GROUP BY 1, 2""",
    "page_windows": f"WITH {PG}, b AS (SELECT bundle_id, min(page) AS a, max(page) AS z FROM pg GROUP BY 1) SELECT bundle_id, i::int AS window_no, (a + i * 14)::int AS lo, least(a + i * 14 + 14, z)::int AS hi FROM (SELECT *, unnest(range(0, CASE WHEN z - a + 1 <= 15 THEN 1 ELSE ceil((z - a + 1 - 15) / 14)::int + 1 END)) AS i FROM b)",
    "segmentation_windows": f"WITH {PG}, b AS (SELECT bundle_id, min(page) AS first, max(page) AS last FROM pg GROUP BY 1), s AS (SELECT bundle_id, first, last, unnest(CASE WHEN last - first + 1 <= 220 THEN [first] ELSE list_filter(range(first, last + 1, 200), lambda x: x <= last - 20 OR x = first) END) AS lo FROM b) SELECT bundle_id, first, last, lo::int AS lo, (CASE WHEN last - first + 1 <= 220 THEN last ELSE least(last, lo + 219) END)::int AS hi FROM s",
    "prev_content_page": f"WITH {PREV} SELECT bundle_id, page, p.page AS prev_page, p.pt AS prev_page_type FROM prev",
    "heuristic_starts": f"WITH {STARTS} SELECT bundle_id, start_page, doc_type, title, evidence FROM st",
    "segment_ranges": f"WITH {STARTS} SELECT bundle_id, segment_id, doc_type, start_page, end_page FROM seg",
    "blank_start_shift": f"""WITH {PG}, a AS (SELECT *, (SELECT min(q.page) FROM pg q WHERE q.bundle_id = p.bundle_id AND q.page > p.page AND q.status <> 'blank') AS nxt, min(page) OVER (PARTITION BY bundle_id) AS first FROM pg p), s AS (SELECT * FROM a WHERE is_document_start OR status = 'blank'),
 k AS (SELECT bundle_id, page AS start_page, page_type FROM s WHERE status <> 'blank' OR page = first), m AS (SELECT DISTINCT ON (bundle_id, nxt) bundle_id, nxt AS start_page, page_type FROM s WHERE status = 'blank' AND page <> first AND nxt IS NOT NULL ORDER BY bundle_id, nxt, page)
 SELECT * FROM k UNION ALL SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.bundle_id = m.bundle_id AND k.start_page = m.start_page)""",
    "boundary_checks": f"""WITH {STARTS}, r AS (SELECT v.bundle_id, v.page, v.p.page AS against_page, s.start_page IS NOT NULL AS listed, v.page <> min(v.page) OVER (PARTITION BY v.bundle_id) AND ((s.start_page IS NOT NULL) OR (v.status = 'ok' AND v.is_document_start)) AS pick FROM prev v LEFT JOIN st s ON s.bundle_id = v.bundle_id AND s.start_page = v.page)
 SELECT bundle_id, page, against_page, listed, row_number() OVER (PARTITION BY bundle_id ORDER BY page)::int AS rank, row_number() OVER (PARTITION BY bundle_id ORDER BY page) <= 120 AS checked FROM r WHERE pick""",
    "page_to_clause": f"WITH {PG}, {CL} SELECT page_id, count(*) AS n_clauses, min(clause_id) AS first_clause FROM pg JOIN cl ON cl.bundle_id = pg.bundle_id AND pg.page BETWEEN page_start AND page_end GROUP BY 1",
    "leaf_levels": f"WITH {CL}, n AS (SELECT contract_id, division_id, sum((kind = 'section')::int) AS s, sum((kind = 'clause')::int) AS c FROM cl GROUP BY 1, 2) SELECT contract_id, division_id, CASE WHEN s >= 2 AND s >= c THEN 'section' WHEN c > 0 THEN 'clause' WHEN s > 0 THEN 'section' ELSE 'whole' END AS level FROM n",
    "label_continuity": f"""WITH {STARTS}, l AS (SELECT g.bundle_id, g.segment_id, b.page, lp, lv FROM lab b JOIN seg g ON g.bundle_id = b.bundle_id AND b.page BETWEEN g.start_page AND g.end_page WHERE lp IS NOT NULL AND b.status NOT IN ('blank', 'failed')), x AS (SELECT *, lag(lp) OVER w AS pp, lag(lv) OVER w AS pv, lag(page) OVER w AS ppg FROM l WINDOW w AS (PARTITION BY bundle_id, segment_id ORDER BY page))
 SELECT bundle_id, segment_id, page, pv AS prev_value, lv AS value, CASE WHEN lv < pv THEN 'label_backwards' ELSE 'label_jump' END AS code FROM x WHERE pp = lp AND (lv < pv OR (lv > pv + page - ppg AND lv > pv + 1))""",
    "label_keys": f"SELECT DISTINCT printed_label, {_P0} AS prefix, {_V0} AS value FROM pages",
    "attachment_keys": f"SELECT DISTINCT ref AS reference, kind, idx FROM ({KEY % 'SELECT DISTINCT unnest(cross_references) AS ref FROM pages'})",
    "attachment_series_gap": f"WITH k AS (SELECT DISTINCT bundle_id, kind, idx::int AS idx FROM ({KEY % 'SELECT DISTINCT bundle_id, marker AS ref FROM clauses'}) WHERE regexp_matches(idx, '^[0-9]+$')), x AS (SELECT *, lag(idx) OVER (PARTITION BY bundle_id, kind ORDER BY idx) AS prev_idx FROM k) SELECT bundle_id, kind, prev_idx, idx FROM x WHERE idx - prev_idx BETWEEN 2 AND 5",
    "reference_findings": f"""WITH r AS (SELECT DISTINCT bundle_id, page, kind, idx FROM ({KEY % 'SELECT bundle_id, page, unnest(cross_references) AS ref FROM pages'}) WHERE kind IS NOT NULL), f AS (SELECT DISTINCT bundle_id, page, kind, idx FROM ({KEY % 'SELECT bundle_id, page_start AS page, marker AS ref FROM clauses'}) WHERE kind IS NOT NULL)
 SELECT bundle_id, kind, idx, 'reference_not_found' AS code, array_to_string(list_sort(list(DISTINCT page))[1:8], ',') AS pages FROM r ANTI JOIN f USING (bundle_id, kind, idx) GROUP BY 1, 2, 3 UNION ALL SELECT bundle_id, kind, idx, 'attachment_not_referenced', array_to_string(list_sort(list(DISTINCT page))[1:3], ',') FROM f ANTI JOIN r USING (bundle_id, kind, idx) GROUP BY 1, 2, 3""",
    "sibling_gaps": f"""WITH {CL}, k AS (SELECT * FROM ({MARKER % "SELECT contract_id, division_id, seq, clause_id, marker FROM cl WHERE kind = 'clause'"})), x AS (SELECT *, lag(key) OVER w AS pk, lag(marker) OVER w AS pm FROM k WINDOW w AS (PARTITION BY contract_id, division_id ORDER BY seq, clause_id)),
 y AS (SELECT *, regexp_extract(key, '^(.*\\.)?\\d+$', 1) AS h, regexp_extract(pk, '^(.*\\.)?\\d+$', 1) AS ph, regexp_extract(key, '(\\d+)$', 1)::int AS b, regexp_extract(pk, '(\\d+)$', 1)::int AS a FROM x WHERE regexp_matches(key, '^\\d+(\\.\\d+)*$') AND regexp_matches(pk, '^\\d+(\\.\\d+)*$'))
 SELECT contract_id, division_id, pm AS prev_marker, h || unnest(range(a + 1, b))::varchar AS missing, marker AS next_marker FROM y WHERE h = ph AND b - a > 1 AND b - a <= 5""",
    "owner_sizes": f"""WITH {STARTS}, {BL}, o AS (SELECT b.*, g.segment_id, sum((kind IN ('heading', 'clause'))::int) OVER (PARTITION BY b.bundle_id, segment_id ORDER BY b.page, idx ROWS UNBOUNDED PRECEDING) AS owner_pos FROM bl b JOIN seg g ON g.bundle_id = b.bundle_id AND b.page BETWEEN g.start_page AND g.end_page WHERE kind IN ('clause', 'paragraph', 'recital', 'table', 'heading', 'handwritten'))
 SELECT bundle_id, segment_id, owner_pos::int AS owner_pos, count(*) AS n_blocks, max(page) AS last_page FROM o GROUP BY 1, 2, 3""",
    "worst_legibility": f"WITH {BL} SELECT bundle_id, page, ['clear', 'partial', 'illegible'][max(CASE legibility WHEN 'partial' THEN 2 WHEN 'illegible' THEN 3 ELSE 1 END)] AS legibility FROM bl GROUP BY 1, 2",
    "page_status": f"WITH {PG} SELECT status, page_type, count(*) AS n FROM pg GROUP BY 1, 2",
    "run_status": f"WITH {PG}, {CL}, p AS (SELECT bundle_id, count(*) AS n_pages, sum((status = 'failed')::int)::bigint AS n_failed FROM pg GROUP BY 1), c AS (SELECT bundle_id, count(*) AS n FROM cl GROUP BY 1) SELECT bundle_id, n_pages, n_failed, coalesce(n, 0) AS n_clauses, CASE WHEN n_failed > 0 AND coalesce(n, 0) = 0 THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS status FROM p LEFT JOIN c USING (bundle_id)",
    "cost_rollup": """WITH c AS (SELECT DISTINCT ON (cache_key) * FROM replay WHERE cache_key IS NOT NULL ORDER BY cache_key, called_at DESC, response_json), p(model, i, o) AS (VALUES ('reader-a', 0.50, 3.00), ('reader-b', 0.25, 1.50), ('reader-lite', 0.25, 1.50), ('reader-alt', 2.00, 12.00))
 SELECT model, task, count(*) AS n_calls, sum(coalesce(input_tokens, 0))::bigint AS input_tokens, sum(coalesce(output_tokens, 0) + coalesce(thinking_tokens, 0))::bigint AS output_tokens, round(sum(coalesce(input_tokens, 0) / 1e6 * coalesce(i, 0)::double + (coalesce(output_tokens, 0) + coalesce(thinking_tokens, 0)) / 1e6 * coalesce(o, 0)::double), 4) AS usd FROM c LEFT JOIN p USING (model) GROUP BY 1, 2""",
    "ladder_first_success": f"""WITH {PG}, {OK_JSON}, a AS (SELECT bundle_id, page, cache_key, CASE task WHEN 'page_read' THEN 0 WHEN 'page_read_half' THEN 1 ELSE 2 END AS rung, outcome FROM pg JOIN outc ON call_key = cache_key), b AS (SELECT *, row_number() OVER (PARTITION BY bundle_id, page ORDER BY rung, cache_key)::int AS n_attempts FROM a)
 SELECT bundle_id, page, cache_key, rung, n_attempts FROM (SELECT *, row_number() OVER (PARTITION BY bundle_id, page ORDER BY n_attempts) AS r FROM b WHERE outcome = 'ok') WHERE r = 1""",
    "text_budget": f"WITH {CL}, x AS (SELECT bundle_id, clause_id, sum(length(text)) OVER (PARTITION BY bundle_id ORDER BY page_start, clause_id ROWS UNBOUNDED PRECEDING)::bigint AS running FROM cl WHERE text IS NOT NULL) SELECT * FROM x WHERE running <= 90000",
    "clause_projection": f"WITH {CL} SELECT clause_id, contract_id, {clean('marker')} AS marker, {clean('text')} <> '' AND length({clean('text')}) <= 80 AND len(string_split({clean('text')}, ' ')) <= 10 AS heading_only, length(text)::int AS n_chars FROM cl WHERE kind <> 'preamble' AND NOT (kind = 'whole' AND coalesce(page_start, 1) > 5) AND trim(coalesce(text, '')) <> ''",
    "date_merge": """WITH r AS (SELECT docket, strftime(decided_on, '%Y-%m-%d') AS v, CASE WHEN decided_on IS NULL THEN NULL WHEN source = 'court_portal' THEN 3 WHEN source = 'law_reports' THEN 2 ELSE 0 END AS k FROM documents WHERE docket IS NOT NULL), t AS (SELECT *, max(k) OVER (PARTITION BY docket) AS top FROM r),
 g AS (SELECT docket, min(v) AS lo, count(DISTINCT v) AS n, max(top) AS top, count(DISTINCT CASE WHEN k = top THEN v END) AS nt, min(CASE WHEN k = top THEN v END) AS tv FROM t GROUP BY 1)
 SELECT docket, CASE WHEN n > 1 AND top > 0 AND nt = 1 THEN tv ELSE lo END AS iso_value, n AS n_values, CASE WHEN n = 0 THEN 'no value' WHEN n = 1 THEN 'single value' WHEN top > 0 AND nt = 1 THEN 'precedence' ELSE 'conflict' END AS note FROM g""",
    "snippet_dates": rf"""WITH x AS (SELECT doc_id, strftime(decided_on, '%Y-%m-%d') AS iso_value, regexp_extract(text, '{_LIT}', 1) AS x FROM documents), y AS (SELECT *, CASE WHEN regexp_matches(x, '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN try_strptime(x, '%Y-%m-%d') WHEN regexp_matches(x, '^\d{{1,2}}[/\-.]\d{{1,2}}[/\-.]\d{{4}}$') THEN try_strptime(regexp_replace(x, '[/.]', '-', 'g'), '%d-%m-%Y')
   WHEN x <> '' THEN try_strptime(regexp_extract(x, '(\d{{4}})\s*$', 1) || '-' || list_position([{_MONTHS}], left(lower(regexp_extract(x, '(?i)({_MN})', 1)), 3))::varchar || '-' || regexp_extract(x, '\b(\d{{1,2}})(?:st|nd|rd|th)?\b', 1), '%Y-%m-%d') END AS t FROM x)
 SELECT doc_id, iso_value, CASE WHEN year(t) BETWEEN 1990 AND 2100 THEN strftime(t, '%Y-%m-%d') END AS parsed, iso_value = CASE WHEN year(t) BETWEEN 1990 AND 2100 THEN strftime(t, '%Y-%m-%d') END AS agrees FROM y""",
    "pick_parties": """WITH p AS (SELECT DISTINCT party_id, contract_id, bundle_id, side, name, CASE WHEN party_role IN ('Employer', 'Contractor') THEN 3 ELSE 2 END AS k FROM parties), n AS (SELECT * FROM p WHERE name IS NOT NULL AND name <> ''),
 s AS (SELECT bundle_id, contract_id, max(k) * 10 + CASE WHEN count(DISTINCT CASE WHEN side IN ('CLIENT', 'CONTRACTOR') THEN side END) = 2 THEN 2 ELSE count(*) END AS score FROM n GROUP BY 1, 2), b AS (SELECT DISTINCT ON (bundle_id) bundle_id, contract_id FROM s ORDER BY bundle_id, score DESC, contract_id)
 SELECT DISTINCT ON (bundle_id, side) bundle_id, side, party_id, name FROM n JOIN b USING (bundle_id, contract_id) WHERE side IN ('CLIENT', 'CONTRACTOR') ORDER BY bundle_id, side, party_id""",
    "coverage_violations": f"""WITH {CL}, c AS (SELECT DISTINCT bundle_id, contract_id, division_id, unit_id, page_start, page_end FROM cl), s AS (SELECT bundle_id, contract_id, division_id, least(min(page_start), min(page_end)) AS lo, greatest(max(page_start), max(page_end)) AS hi FROM c GROUP BY 1, 2, 3),
 x AS (SELECT c.*, lo, hi, coalesce(lag(page_end) OVER w + 1, lo) AS e, lead(page_start) OVER w AS nx FROM c JOIN s USING (bundle_id, contract_id, division_id) WINDOW w AS (PARTITION BY bundle_id, contract_id, division_id ORDER BY page_start, page_end))
 SELECT bundle_id, contract_id, division_id, count(*) AS n_violations FROM x WHERE NOT (page_start = e OR (page_start = e - 1 AND e <> lo)) OR page_end < page_start OR (nx IS NULL AND page_end <> hi) GROUP BY 1, 2, 3""",
    "marker_keys": f"""WITH k AS ({MARKER % "SELECT DISTINCT marker FROM clauses"}), x AS (SELECT *, CASE WHEN key LIKE '(%' THEN key[2:-2] END AS inn FROM k)
 SELECT marker, key, CASE WHEN key IS NULL THEN '-' WHEN regexp_matches(key, '^\\d+(\\.\\d+)*$') THEN 'dotted-' || (length(key) - length(replace(key, '.', '')) + 1)::varchar WHEN key LIKE '(%' AND regexp_matches(inn, '^\\d+$') THEN 'paren-number' WHEN key LIKE '(%' AND ({roman('inn')}) IS NOT NULL AND (length(inn) > 1 OR inn IN ('i', 'v', 'x')) THEN 'roman-or-alpha'
   WHEN key LIKE '(%' THEN 'alpha' WHEN contains(key, ':') THEN split_part(key, ':', 1) ELSE 'named' END AS hint FROM x""",
    "call_outcomes": f"WITH {OK_JSON} SELECT task, outcome, count(*) AS n, sum(CASE WHEN outcome = 'ok' THEN coalesce(try_cast(json_extract_string(response_json, '$.blocks') AS int), 0) ELSE 0 END)::bigint AS n_blocks FROM outc GROUP BY 1, 2",
    "best_start_per_page": f"""WITH {PG}, b AS (SELECT bundle_id, min(page) AS first, max(page) AS last FROM pg GROUP BY 1), s AS (SELECT bundle_id, first, last, unnest(CASE WHEN last - first + 1 <= 220 THEN [first] ELSE list_filter(range(first, last + 1, 200), lambda x: x <= last - 20 OR x = first) END) AS lo FROM b), w AS (SELECT *, CASE WHEN last - first + 1 <= 220 THEN last ELSE least(last, lo + 219) END AS hi FROM s),
 p AS (SELECT pg.bundle_id, page AS start_page, CASE WHEN first_continues THEN 0.6 ELSE 0.95 END::double AS confidence, lo::int AS window_lo, page_id AS ord FROM pg JOIN w USING (bundle_id) WHERE is_document_start AND page BETWEEN lo AND hi AND NOT (lo <> first AND page < lo + 10) AND NOT (hi <> last AND page > hi - 10))
 SELECT DISTINCT ON (bundle_id, start_page) bundle_id, start_page, confidence, window_lo, ord FROM p ORDER BY bundle_id, start_page, confidence DESC, window_lo, ord""",
    "degenerate_texts": """WITH l AS (SELECT doc_id, i, trim(x) AS x FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE length(trim(x)) > 8), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - row_number() OVER (PARTITION BY doc_id, x ORDER BY i) AS g FROM l), b AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, x, g, count(*) AS n FROM r GROUP BY 1, 2, 3) WHERE n >= 6)
 SELECT doc_id IN (SELECT doc_id FROM b) AS degenerate, count(*) AS n FROM documents GROUP BY 1""",
    "display_names": r"""WITH p AS (SELECT trim(regexp_replace(regexp_replace(regexp_replace(lower(name), '\(.*?\)', ' ', 'g'), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')) AS name_key, trim(name) AS n FROM parties WHERE name IS NOT NULL), x AS (SELECT *, regexp_replace(n, '[^A-Za-z]', '', 'g') <> '' AND n = upper(n) AS up FROM p WHERE name_key <> '' AND n <> '')
 SELECT name_key, CASE WHEN up AND length(n) > 5 THEN (SELECT string_agg(upper(left(w, 1)) || substr(w, 2), ' ' ORDER BY i) FROM (SELECT unnest(string_split(lower(n), ' ')) AS w, generate_subscripts(string_split(lower(n), ' '), 1) AS i)) ELSE n END AS display_name
 FROM (SELECT *, row_number() OVER (PARTITION BY name_key ORDER BY up::int, regexp_matches(n, '[()]'), len(list_filter(regexp_split_to_array(n, '\s+'), lambda w: regexp_matches(w, '^[a-z]'))), length(n), n) AS r FROM x) WHERE r = 1""".replace("\\\\", "\\"),
    "page_diagnosis": f"""WITH {PG}, {OK_JSON}, n AS (SELECT bundle_id, page, count(DISTINCT block_key) AS n FROM blocks GROUP BY 1, 2), x AS (SELECT *, coalesce(n.n, 0) AS nb FROM pg LEFT JOIN n USING (bundle_id, page) LEFT JOIN outc ON call_key = cache_key)
 SELECT CASE WHEN ink_ratio < 0.0003 THEN 'blank' WHEN outcome IN ('truncated', 'blocked', 'invalid', 'empty') THEN outcome WHEN nb = 0 AND ink_ratio > 0.0012 THEN 'empty_for_inked' ELSE 'ok' END AS diagnosis, count(*) AS n FROM x GROUP BY 1""",
    "plain_texts": f"""WITH {STARTS}, {BL}, b AS (SELECT bl.bundle_id, g.segment_id, bl.page, bl.idx, trim(coalesce(text, '')) AS p, coalesce(row_number() OVER (PARTITION BY bl.bundle_id, bl.page ORDER BY idx) = 1 AND first_continues, false) AS cont FROM bl JOIN pg ON pg.bundle_id = bl.bundle_id AND pg.page = bl.page JOIN seg g ON g.bundle_id = bl.bundle_id AND bl.page BETWEEN g.start_page AND g.end_page WHERE kind IN ('clause', 'paragraph', 'recital')),
 x AS (SELECT *, lag(p) OVER w AS before FROM b WHERE p <> '' WINDOW w AS (PARTITION BY bundle_id, segment_id ORDER BY page, idx)), j AS (SELECT *, CASE WHEN before IS NULL THEN '' WHEN NOT cont THEN chr(10) || chr(10) WHEN regexp_matches(before, '[A-Za-z]-$') AND regexp_matches(p, '^[a-z]') THEN '' ELSE ' ' END AS j FROM x),
 c AS (SELECT *, j || CASE WHEN lead(j) OVER (PARTITION BY bundle_id, segment_id ORDER BY page, idx) = '' AND regexp_matches(p, '[A-Za-z]-$') THEN p[:-2] ELSE p END AS c FROM j) SELECT bundle_id, segment_id, length(string_agg(c, '' ORDER BY page, idx))::int AS n_chars, md5(string_agg(c, '' ORDER BY page, idx)) AS digest FROM c GROUP BY 1, 2""",
    "duplicate_page_pairs": f"""WITH {_SHINGLE}, j AS (SELECT a.bundle_id, a.page AS earlier, b.page AS later, count(*) AS c FROM g a JOIN g b ON a.bundle_id = b.bundle_id AND a.g = b.g AND a.page < b.page GROUP BY 1, 2, 3)
 SELECT j.bundle_id, earlier, later, c / (x.n + y.n - c) AS jaccard FROM j JOIN n x ON x.bundle_id = j.bundle_id AND x.page = earlier JOIN n y ON y.bundle_id = j.bundle_id AND y.page = later WHERE y.n >= 30 AND x.n / y.n > 0.7 AND x.n / y.n < 1.43 AND c / (x.n + y.n - c) >= 0.9""",
}
