"""DuckDB SQL of the operators that SQL can express on the small tables."""

from __future__ import annotations

import math

from tallyforge.llm import rules

_WORDS = "list_filter(string_split_regex({t}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
_SHARES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "capital_share": ("capitals", "word_chars"),
    "exclamations_per_word": ("exclamations", "n_words"),
    "mean_word_chars": ("word_chars", "n_words"),
}


def _rules() -> str:
    level = math.log(rules.ERROR / (len(rules.STRATA) + 1))
    share = lambda r: f"CAST({_SHARES[r][0]} AS DOUBLE) / greatest({_SHARES[r][1]}, 1)"
    first = lambda r, cuts: f"CASE {' '.join(f'WHEN {share(r)} > {c} THEN {i}' for i, c in enumerate(cuts))} ELSE {rules.STEPS} END"
    strata = ", ".join(f"('{s}')" for s in (*rules.STRATA, rules.POOL))
    return f"""WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
 w AS (SELECT *, {_WORDS.replace("{t}", "text")} AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
 g AS (SELECT doc_id, i, ws[i : i + 4] AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
 twice AS (SELECT doc_id, win FROM g GROUP BY 1, 2 HAVING count(*) > 1),
 covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT g.doc_id, unnest(range(g.i, g.i + 5)) AS p FROM g JOIN twice t ON g.doc_id = t.doc_id AND g.win = t.win) GROUP BY 1),
 f0 AS (SELECT w.doc_id, CASE WHEN lang IN ({", ".join(f"'{s}'" for s in rules.STRATA)}) THEN lang ELSE '{rules.POOL}' END AS stratum, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines, coalesce(c.n, 0) AS n_repeat_words,
  length(text) - length(regexp_replace(text, '\\p{{Lu}}', '', 'g')) AS capitals, length(text) - length(replace(text, '!', '')) AS exclamations FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id),
 f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, least({", ".join(first(r, c) for r, c in rules.RULES.items())}) AS step FROM f0),
 good AS (SELECT f.* FROM f JOIN (SELECT doc_id FROM labels GROUP BY 1 HAVING min(quality) = 1) l USING (doc_id) WHERE NOT base_failed),
 own AS (SELECT s.stratum, count(g.doc_id) AS n, CASE WHEN count(g.doc_id) >= {rules.fewest(rules.RISK, rules.ERROR)} THEN s.stratum ELSE '{rules.POOL}' END AS pool FROM (VALUES {strata}) s(stratum) LEFT JOIN good g ON g.stratum = s.stratum GROUP BY 1),
 k AS (SELECT pool, i, count(g.doc_id) AS n, count(*) FILTER (WHERE step <= i) AS k FROM own LEFT JOIN good g ON g.stratum = own.stratum CROSS JOIN range({rules.STEPS}) t(i) GROUP BY 1, 2),
 safe AS (SELECT pool, max(i) AS cut FROM k WHERE k <= n * {rules.RISK} AND ln(list_sum([exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln({rules.RISK}) + (n - x) * ln(1 - {rules.RISK})) for x in range(0, k + 1)])) <= {level} GROUP BY 1)
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR coalesce(step <= cut, false)) AS kept FROM f LEFT JOIN own USING (stratum) LEFT JOIN safe USING (pool)"""


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NEAR = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.replace("{t}", f"translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}')")} AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN ws ELSE ws[i : i + 4] END AS sh FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1), c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 75 * (x.n + y.n - m)),
 r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
 SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)"""

_TAILS = "(\\|(?:im_start|im_end|im_sep|endoftext)\\|>|/?s>|/?INST\\]|</?SYS>>)"
_CHAT = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
 e AS (SELECT *, regexp_replace(text, '([<\\[])(\\\\*){_TAILS}', '\\1\\\\\\2\\3', 'g') AS esc, lag(role) OVER w AS before, lead(role) OVER w AS after FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
 SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(length(esc) + CASE WHEN before = role THEN 10 ELSE 13 + length(role) END + CASE WHEN after = role THEN 0 ELSE 11 END) AS BIGINT) AS formatted_chars FROM e GROUP BY 1"""

_WARC = """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), h AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS holder, strlen(html) >= 1000 AS large FROM p)
 SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest, CASE WHEN large AND holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN large AND holder <> page_id THEN holder END AS refers_to FROM h"""


def oracle_sql() -> dict[str, str]:
    return {"op4_minhash": _NEAR, "op6_warc": _WARC, "op8_chat": _CHAT, "op10_quality_rules": _rules()}
