"""SQL (DuckDB) for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from windrow.llm import chat, decontaminate, quality, secrets
from windrow.llm.queries import MARKED_TURNS, URL_RULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _quality() -> str:
    rules = quality.Rules()
    blank = r"[\x20\x09-\x0D]+"
    common = ", ".join(f"len(list_filter(w, lambda x: x = {_quoted(word)}))" for word in quality.COMMON_WORDS)
    n_common, n_classes = len(quality.COMMON_WORDS) + 1, 6

    def mean(values: str, n: int) -> str:
        return "[" + ", ".join(f"avg({values}[{i + 1}])" for i in range(n)) + "]"

    def distance(p: str, q: str) -> str:
        term = (
            "(CASE WHEN {p}[i] > 0 THEN {p}[i] * log2(2 * {p}[i] / ({p}[i] + {q}[i])) ELSE 0 END"
            " + CASE WHEN {q}[i] > 0 THEN {q}[i] * log2(2 * {q}[i] / ({p}[i] + {q}[i])) ELSE 0 END) / 2"
        ).format(p=p, q=q)
        return f"sqrt(greatest(0.0, list_sum(list_transform(range(1, len({p}) + 1), lambda i: {term}))))"

    return f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '{blank}'), lambda x: x <> '') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS times
  FROM (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d))),
repeated AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS j FROM windows WHERE times > 1)
  GROUP BY doc_id),
f AS (
  SELECT d.doc_id, lang, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
           - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words,
         len(regexp_extract_all(text, '[a-z]')) AS lower_case, len(regexp_extract_all(text, '[A-Z]')) AS upper_case,
         len(regexp_extract_all(text, '[0-9]')) AS digits, len(regexp_extract_all(text, '[^\\x00-\\x7F]')) AS non_ascii,
         [{common}] AS found
  FROM d LEFT JOIN repeated r ON r.doc_id = d.doc_id),
g AS (
  SELECT *, list_transform([lower_case, upper_case, digits, n_symbols,
                            word_chars - lower_case - upper_case - digits - n_symbols - non_ascii, non_ascii], lambda x: x / word_chars) AS p,
         list_transform(list_append(found, n_words - list_sum(found)::BIGINT), lambda x: x / n_words) AS v
  FROM f),
long_enough AS (SELECT * FROM g WHERE word_chars >= {rules.min_chars} AND n_words >= {rules.min_judged_words}),
means AS (
  SELECT lang, {mean("p", n_classes)} AS rp, {mean("v", n_common)} AS rv
  FROM long_enough GROUP BY lang HAVING count(*) >= {rules.min_documents}),
first AS (SELECT lang, p, v, {distance("p", "rp")} + {distance("v", "rv")} AS d FROM long_enough JOIN means USING (lang)),
near AS (SELECT * FROM first JOIN (SELECT lang, avg(d) AS middle FROM first GROUP BY lang) USING (lang) WHERE d <= middle + {quality.ROUNDING}),
refs AS (SELECT lang, {mean("p", n_classes)} AS rp, {mean("v", n_common)} AS rv FROM near GROUP BY lang),
judged AS (
  SELECT g.*, CASE WHEN word_chars >= {rules.min_chars} AND rp IS NOT NULL THEN {distance("p", "rp")} END AS dp,
         CASE WHEN n_words >= {rules.min_judged_words} AND rv IS NOT NULL THEN {distance("v", "rv")} END AS dv,
         n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeated_percent} * n_words AS base_failed
  FROM g LEFT JOIN refs USING (lang))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(dp > {rules.max_class_distance}, false)
         AND NOT coalesce(dp + dv > {rules.max_total_distance} + {rules.short_allowance} / sqrt(greatest(n_words, 1)), false) AS kept
FROM judged
"""


def _decontaminate() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{word}')"
    size = decontaminate.WINDOW
    return f"""
WITH i AS (SELECT item_id, w, least(len(w), {size}) AS k FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[j:j + k - 1], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS j FROM i)),
d AS (SELECT doc_id, {words} AS w FROM documents),
places AS (
  SELECT doc_id, k, j, array_to_string(w[j:j + k - 1], ' ') AS t
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM d, (SELECT DISTINCT k FROM i))),
hits AS (SELECT doc_id, j, p.k, item_id FROM places p JOIN windows USING (k, t)),
h AS (SELECT doc_id, count(DISTINCT m) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + k)) AS m FROM hits) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def _urls() -> str:
    rules = ", ".join("(" + ", ".join(map(_quoted, r)) + ")" for r in URL_RULES)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rule_host, rule_path, decision) AS (VALUES {rules}),
fits AS (SELECT page_id, rule_host || rule_path AS rule, decision,
                row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS n
         FROM h JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT h.page_id, host, path, rule, coalesce(decision, 'allow') AS verdict
FROM h LEFT JOIN fits ON fits.page_id = h.page_id AND n = 1
"""


def _secrets() -> str:
    patterns = [secrets.ASSIGN, secrets.ACCESS, secrets.HEX, *(p for _, p in secrets.EXTRA_RULES)]
    found = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS kind, '{name}' AS name, regexp_extract_all(text, {_quoted(p)}) AS m,"
        f" list_transform(string_split_regex(text, {_quoted(p)}), lambda x: length(x)) AS gap FROM d"
        for i, (name, p) in enumerate(zip(secrets.KINDS, patterns))
    )
    joined = "coalesce(string_agg(name || ':' || a || ':' || b, ',' ORDER BY a, kind){}, '')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({found}),
each AS (SELECT doc_id, kind, name, m, gap, unnest(range(1, len(m) + 1)) AS i FROM found WHERE len(m) > 0),
spans AS (
  SELECT doc_id, kind, name, (list_sum(gap[1:i]) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS a,
         (list_sum(gap[1:i]) + list_sum(list_transform(m[1:i], lambda x: length(x))))::BIGINT AS b
  FROM each WHERE kind <> 0 OR length(regexp_extract(m[i], {_quoted(secrets.ASSIGN)}, 2)) >= {secrets.MIN_VALUE}),
sums AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         {joined.format(" FILTER (kind < 3)")} AS base, {joined.format("")} AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN sums ON sums.doc_id = d.doc_id
"""


def _chat() -> str:
    turns = ", ".join(f"({conv}, {turn}, '{role}', '{text}')" for conv, turn, role, text in MARKED_TURNS)
    escaped = "regexp_replace(replace({}, '\\', '\\\\'), '<(/?turn>|part/>)', '\\\\l\\1', 'g')"
    marks = len(chat.OPEN) + 1 + len(chat.CLOSE)
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {turns}) t(conv_id, turn, role, text)),
placed AS (
  SELECT *, role IS DISTINCT FROM lag(role) OVER w AS opens FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sized AS (
  SELECT *, length({escaped.format("text")}) + CASE WHEN opens THEN {marks} + length(replace({escaped.format("role")}, chr(10), '\\n')) ELSE {len(chat.PART)} END AS chars
  FROM placed)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


ORACLES = {
    "op2_quality_rules": _quality(),
    "op4_decontaminate": _decontaminate(),
    "op7_url_filter": _urls(),
    "op9_secrets": _secrets(),
    "op11_chat_format": _chat(),
}
