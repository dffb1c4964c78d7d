"""DuckDB SQL for the operators that SQL can express, written from their definitions."""

from __future__ import annotations

from . import license_scan, line_dedup, quality_rules, sharding, url_filter

_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UP, _LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def quality_rules_sql() -> str:
    stops = ", ".join(map(_quoted, quality_rules.STOP_WORDS))
    stats = {
        "mean_word_chars": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"), "stop_word_ratio": ("n_stop_words", "n_words"),
        "dup_line_ratio": ("n_dup_lines", "n_lines"),
    }
    per = {k: f"(CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} ELSE 0 END)" for k, (a, b) in stats.items()}
    ok = " AND ".join([f"{per[r.name]} >= {r.low}" for r in quality_rules.RULES if r.low is not None] + [f"{per[r.name]} <= {r.high}" for r in quality_rules.RULES if r.high is not None])
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS word, generate_subscripts(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'), 1) AS i FROM d),
g AS (SELECT doc_id, i, word || chr(32) || lead(word, 1) OVER o || chr(32) || lead(word, 2) OVER o AS gram FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g WHERE gram IS NOT NULL),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) v(k) WHERE n > 1 GROUP BY doc_id),
wc AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (WHERE lower(word) IN ({stops})) AS n_stop_words FROM w GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
lc AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln WHERE trim(line, {_WS}) <> '' GROUP BY doc_id),
s AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_stop_words, 0) AS n_stop_words
      FROM d LEFT JOIN wc USING (doc_id) LEFT JOIN lc USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND {ok} AS kept FROM b"""


def dropped_lines_sql(docs: str) -> str:
    """CTE text: ``kept_lines`` (doc_id, pos, line, gone) of the table or CTE ``docs``."""
    return f"""
ln AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM {docs}),
k AS (SELECT *, translate(trim(line, {_WS}), {_UP}, {_LOW}) AS key FROM ln),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
kept_lines AS (SELECT k.doc_id, pos, line, last IS NOT NULL AND k.doc_id < last AS gone FROM k LEFT JOIN c USING (key))"""


def line_dedup_sql() -> str:
    return f"""
WITH {dropped_lines_sql("documents")}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM kept_lines GROUP BY doc_id"""


def license_scan_sql() -> str:
    t = license_scan.THRESHOLD
    rows = ", ".join(f"({_quoted(a)}, {k}, {_quoted(x)})" for a, k, x, _ in license_scan.template_sizes(license_scan.TEMPLATES))

    def grams(source: str, keys: str, text: str) -> str:
        words = f"regexp_extract_all(translate({text}, {_UP}, {_LOW}), '[a-z0-9]+')"
        return f"SELECT {keys}, list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || chr(32) || w[i + 1])) AS g FROM (SELECT {keys}, {words} AS w FROM {source}) WHERE len(w) > 1"

    return f"""
WITH tpl(license, k, template) AS (VALUES {rows}),
tg AS ({grams("tpl", "license, k", "template")}),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS unit FROM documents WHERE text IS NOT NULL),
pa AS (SELECT doc_id, unnest(string_split_regex(text, '\\n[\\x20\\x09-\\x0D]*\\n')) AS unit FROM documents WHERE text IS NOT NULL),
u AS (SELECT row_number() OVER () AS uid, * FROM (SELECT * FROM ln UNION ALL SELECT * FROM pa WHERE contains(trim(unit, chr(10)), chr(10)))),
ug AS ({grams("u", "uid, doc_id, unit", "unit")}),
small AS (SELECT * FROM ug WHERE len(g) <= (SELECT max(floor(len(g) * (2 - {t}) / {t})) FROM tg)),
m AS (SELECT uid, doc_id, unit, license, 2.0::DOUBLE * len(list_intersect(small.g, tg.g)) / (len(small.g) + len(tg.g)) AS dice
      FROM small, tg)
SELECT doc_id, license, count(DISTINCT uid) AS n_units, max(dice) AS dice, min(unit) AS unit FROM m WHERE dice >= {t} GROUP BY doc_id, license"""


def url_filter_sql() -> str:
    rules = ", ".join(f"({_quoted(r.host)}, {_quoted(r.path)}, {_quoted(r.verdict)})" for r in url_filter.RULES)
    toks = f"list_distinct(list_filter(regexp_split_to_array(translate(regexp_replace(coalesce(url, ''), '^.*?://', ''), {_UP}, {_LOW}), '[^a-z0-9]+'), lambda t: regexp_matches(t, '[a-z]')))"
    return f"""
WITH RECURSIVE p AS (SELECT row_number() OVER () AS pid, page_id, url, instr(url, '://') AS sep FROM pages),
h AS (SELECT pid, page_id, url, CASE WHEN sep > 0 THEN translate(regexp_extract(substr(url, sep + 3), '^[^/?#]*', 0), {_UP}, {_LOW}) ELSE '' END AS host,
        CASE WHEN sep > 0 THEN regexp_extract(substr(url, sep + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path, {toks} AS toks FROM p),
r(rhost, rpath, said) AS (VALUES {rules}),
fit AS (SELECT pid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(said, length(rhost || rpath)) AS said
        FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY pid),
lab AS (SELECT doc_id, coalesce(min(quality) = 0, false) OR coalesce(max(toxic) = 1, false) AS bad FROM labels GROUP BY doc_id),
tr AS (SELECT pid, toks, bad FROM h JOIN lab ON doc_id = TRY_CAST(nullif(regexp_extract(path, '/(\\d{{1,18}})', 1), '') AS BIGINT) WHERE url IS NOT NULL),
lim AS (SELECT greatest(1, ceil({url_filter.MIN_SUPPORT} * count(*) - 1e-9)) AS need FROM tr),
grown(s, hits, freq) AS (
  SELECT [t], count(*) FILTER (WHERE bad), count(*) FROM (SELECT bad, unnest(toks) AS t FROM tr) GROUP BY t HAVING count(*) FILTER (WHERE bad) >= (SELECT need FROM lim)
  UNION ALL
  SELECT list_append(s, t), count(*) FILTER (WHERE bad), count(*)
  FROM (SELECT grown.s, tr.bad, unnest(list_filter(tr.toks, lambda x: x > grown.s[-1])) AS t FROM grown JOIN tr ON list_has_all(tr.toks, grown.s) WHERE grown.hits::DOUBLE / grown.freq < {url_filter.MIN_CONFIDENCE})
  GROUP BY s, t HAVING count(*) FILTER (WHERE bad) >= (SELECT need FROM lim)),
sets AS (SELECT s FROM grown WHERE hits::DOUBLE / freq >= {url_filter.MIN_CONFIDENCE}),
mined AS (SELECT s FROM sets a WHERE NOT EXISTS (SELECT 1 FROM sets b WHERE len(b.s) < len(a.s) AND list_has_all(a.s, b.s))),
hit AS (SELECT pid, min(array_to_string(s, ' ')) AS mined_rule FROM h JOIN mined ON list_has_all(toks, s) WHERE url IS NOT NULL GROUP BY pid)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN mined_rule IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, mined_rule
FROM h LEFT JOIN fit USING (pid) LEFT JOIN hit USING (pid)"""


def sharding_sql() -> str:
    names = [f"shard-{k:04d}" for k in range(sharding.SHARDS)]
    table = sharding.lookup_table(names, sharding.SLOTS)
    shards = ", ".join(str(k) for k in table)
    return f"""
WITH t AS (SELECT unnest([{shards}]) AS k, unnest(range({sharding.SLOTS})) AS slot),
d AS (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {sharding.SLOTS})::INT AS slot FROM documents)
SELECT doc_id, d.slot::INT AS slot, 'shard-' || lpad(k::VARCHAR, 4, '0') AS shard FROM d JOIN t USING (slot)"""
