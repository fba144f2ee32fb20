"""Checking SQL for the operators that SQL can express."""

from __future__ import annotations

from placewell.llm import licenses, url_filters


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _licence_sql() -> str:
    """Sentences by regular expressions, then one step per rule that uses up what it matches."""
    known = sorted((s, name) for name, found in licenses.SENTENCES.items() for s in found)
    names = ", ".join(f"{_text(s)}: {_text(n)}" for s, n in known)
    steps, last = [], "s0"
    for k, (name, ids) in enumerate(licenses.patterns(), 1):
        steps.append(
            f"s{k} AS (SELECT doc_id, ids, replace(runs, {_text(ids)}, ',;,') AS runs, "
            f"CASE WHEN contains(runs, {_text(ids)}) AND NOT list_contains(found, {_text(name)}) "
            f"THEN list_append(found, {_text(name)}) ELSE found END AS found FROM {last})")
        last = f"s{k}"
    plain = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
    ends = "string_split(regexp_replace({0}, '([.!?;:])[ \\t]+', '\\1' || chr(10), 'g'), chr(10))"
    is_known = "m[" + plain + "] IS NOT NULL"
    return f"""
WITH known AS (SELECT MAP {{{names}}} AS m),
lines AS (
  SELECT doc_id, unnest(string_split_regex(coalesce(text, ''), '\\r\\n|[\\n\\r]')) AS line,
         generate_subscripts(string_split_regex(coalesce(text, ''), '\\r\\n|[\\n\\r]'), 1) AS turn FROM documents),
bare AS (SELECT doc_id, turn, regexp_replace(line, {_text(licenses.MARKS)}, '') AS line FROM lines),
cut AS (SELECT *, {ends.format('line')} AS p FROM bare),
whole AS (
  SELECT doc_id, string_agg(
    CASE WHEN {is_known.format('p[1]')} THEN chr(10) ELSE '' END || line ||
    CASE WHEN trim(line, ' ') = '' OR {is_known.format('p[-1]')} THEN chr(10) ELSE ' ' END, '' ORDER BY turn) AS text
  FROM cut, known GROUP BY doc_id),
pieces AS (SELECT doc_id, {ends.format('text')} AS p FROM whole),
sentences AS (SELECT doc_id, 1 AS turn, unnest(p) AS s, generate_subscripts(p, 1) AS step FROM pieces),
named AS (
  SELECT doc_id, turn, step,
         coalesce(m[trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))], ';') AS name
  FROM sentences, known WHERE regexp_matches(s, '[A-Za-z0-9]')
    AND NOT regexp_matches({plain.format('s')}, {_text(licenses.ITEM)})),
folded AS (
  SELECT doc_id, ',' || string_agg(name, ',' ORDER BY turn, step) || ',' AS joined FROM named
  WHERE doc_id IN (SELECT doc_id FROM named WHERE name <> ';') GROUP BY doc_id),
runs AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(joined, '(,;)+,', ',;,', 'g'),
         '^,;,', ','), ',;,$', ',') AS runs FROM folded),
s0 AS (SELECT doc_id, runs AS ids, runs, CAST([] AS VARCHAR[]) AS found FROM runs),
{", ".join(steps)}
SELECT d.doc_id, coalesce(trim(ids, ','), '') AS sentence_ids,
  CAST(coalesce(len(list_filter(string_split(trim(ids, ','), ','), lambda x: x <> '' AND x <> ';')), 0) AS BIGINT) AS n_sentences,
  coalesce(array_to_string(found, ','), '') AS licences
FROM documents d LEFT JOIN {last} USING (doc_id)"""


def _rule_sql(host: str, path: str) -> str:
    """The longest fitting rule as action and rule, joined by a blank."""
    order = sorted(url_filters.RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow"))
    tests = " ".join(
        f"WHEN ({host} = {_text(h)} OR ends_with({host}, {_text('.' + h)})) AND starts_with({path}, {_text(p)}) "
        f"THEN {_text(action + ' ' + h + p)}" for action, h, p in order)
    return f"CASE {tests} END"


def _url_sql() -> str:
    host = r"lower(regexp_extract({0}, '(?s)^.*?://([^/?#]*)([^?#]*)', 1))"
    path = r"regexp_extract({0}, '(?s)^.*?://([^/?#]*)([^?#]*)', 2)"
    seen = f"regexp_replace(html, {_text(url_filters.UNSEEN)}, ' ', 'g')"
    target = "list_transform(regexp_extract_all(" + seen + ", '{0}'), lambda x: regexp_extract(x, '(?i)\\b{1}\\s*=\\s*[\"'']?([^\"''\\s>]+)', 1))"
    link = target.format(r"(?i)<link\b[^>]*\brel\s*=\s*[\"'']?canonical\b[^>]*>", "href")
    refresh = target.format(r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"'']?refresh\b[^>]*>", "url")
    site = f"regexp_extract({{0}}, {_text(url_filters.SITE)})"
    case = f"translate({site}, '{url_filters.UPPER}', '{url_filters.LOWER}')"
    ports = r"regexp_replace(regexp_replace({0}, '^(http://[^:]*):80$', '\1'), '^(https://[^:]*):443$', '\1')"
    node = "(" + ports.format(case) + f" || substr(regexp_replace({{0}}, '(?s)#.*$', ''), length({site}) + 1))"
    return rf"""
WITH RECURSIVE parts AS (
  SELECT page_id, coalesce({host.format('url')}, '') AS host, coalesce({path.format('url')}, '') AS path,
         {node.format('url')} AS node FROM pages),
targets AS (
  SELECT {node.format('url')} AS src, unnest(list_concat({link}, {refresh})) AS t FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
edges AS (
  SELECT DISTINCT src, {node.format('t')} AS dst FROM targets WHERE regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://')),
both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
reach(node, other) AS (
  SELECT src, dst FROM both_ways UNION SELECT r.node, b.dst FROM reach r JOIN both_ways b ON r.other = b.src),
decided AS (
  SELECT node, {_rule_sql(host.format('other'), path.format('other'))} AS found FROM reach),
tainted AS (
  SELECT node FROM decided GROUP BY node
  HAVING bool_or(coalesce(starts_with(found, 'block'), false)) AND NOT bool_or(coalesce(starts_with(found, 'allow'), false))),
judged AS (SELECT *, {_rule_sql('host', 'path')} AS found FROM parts)
SELECT page_id, host, path, split_part(found, ' ', 2) AS rule,
  CASE WHEN found IS NOT NULL THEN split_part(found, ' ', 1)
       WHEN node IN (SELECT node FROM tainted) THEN 'block' ELSE 'allow' END AS verdict
FROM judged"""


ORACLE = {"op2_license_scan": _licence_sql(), "op9_url_filters": _url_sql()}
