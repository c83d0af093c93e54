"""ANSI-style SQL with the same results as the registered queries.

Written independently of the Spark jobs: recursive or unrolled common table
expressions where those use loops, brute-force joins where those use blocking,
and windows where those use aggregates. Text in the corpus is ASCII, so plain
``\\w`` and ``\\s`` serve here.
"""

from __future__ import annotations

import re

from threadline.config import STAGES, TABLES
from threadline.corpus import CATALOG_TABLES, CLASS_RULES, CODE_FILES, RUN_LOG

_NAME_LIST = r"([\w.]+(?:\s+[\w.]+)*)\s*;"


def _matches(code: str, pattern: str) -> str:
    return f"regexp_extract_all({code}, '{pattern}', 1)"


def _listed(code: str, keyword: str) -> str:
    found = _matches(code, rf"(?im)^\s*{keyword}\s+{_NAME_LIST}")
    return f"flatten(list_transform({found}, lambda s: regexp_split_to_array(s, '\\s+')))"


def _names(tokens: str) -> str:
    cleaned = f"list_transform({tokens}, lambda t: lower(rtrim(t, '.')))"
    return f"list_sort(list_distinct(list_filter({cleaned}, lambda n: n <> '')))"


def _lowered(found: str) -> str:
    return f"list_sort(list_distinct(list_transform({found}, lambda m: lower(m))))"


def inputs_of(code: str) -> str:
    return _names(f"list_concat({_listed(code, 'set')}, {_listed(code, 'merge')})")


def outputs_of(code: str) -> str:
    out = _matches(code, r"(?i)\bout\s*=\s*([\w.]+)")
    data = _matches(code, r"(?i)\bdata\s*=\s*([\w.]+)")
    return _names(f"list_concat({_listed(code, 'data')}, list_concat({out}, {data}))")


def macros_of(code: str) -> str:
    return _lowered(_matches(code, r"(?i)%(\w+)\s*\("))


def includes_of(code: str) -> str:
    return f"list_sort(list_distinct({_matches(code, _INCLUDE)}))"


_INCLUDE = "(?i)%include\\s+[\"'']([^\"'']+)[\"'']"


def procs_of(code: str) -> str:
    return _lowered(_matches(code, r"(?im)^\s*proc\s+(\w+)"))


EXTRACTED = {
    "input_datasets": inputs_of,
    "output_datasets": outputs_of,
    "macro_calls": macros_of,
    "include_files": includes_of,
    "proc_types": procs_of,
}

_ARRAYS = ",\n  ".join(f"{make('code')} AS {name}" for name, make in EXTRACTED.items())
_JOINED = ", ".join(f"array_to_string({name}, '|') AS {name}" for name in EXTRACTED)

CTES = {
    "code_files": CODE_FILES,
    "run_log": RUN_LOG,
    "class_rules": CLASS_RULES,
    "catalog_tables": CATALOG_TABLES,
    "raw": f"""SELECT file_path, regexp_extract(file_path, '[^/]*$') AS file_name, contains(code, '&') AS has_dynamic_deps,
  {_ARRAYS} FROM code_files""",
}

# -- macro statements: a machine that reads each program statement by statement --
#
# A stack of texts: the program, an include it reads (only its definitions count)
# or the body of a macro it calls. A step takes the text up to the next statement
# with a meaning of its own, replaces references by the values known there, and
# acts on the statement. Includes that are being read already are skipped.

_EVENT = r"(?is)^(.*?)(%let\s+\w+\s*=[^;]*;|%macro\s.*?%mend[^;]*;?|%include\s+[\"''][^\"'']+[\"'']|%\w+\s*\([^()]*\))"
_MACRO = r"(?is)%macro\s+(\w+)\s*(?:\(([^)]*)\))?[^;]*;(.*?)%mend"


def _subst(text: str, env: str, masked: str = "[]") -> str:
    part = (
        f"CASE WHEN {env}[lower(regexp_extract(p, '^\\w+'))] IS NOT NULL AND NOT list_contains({masked}, lower(regexp_extract(p, '^\\w+'))) "
        f"THEN {env}[lower(regexp_extract(p, '^\\w+'))] || regexp_replace(regexp_replace(p, '^\\w+', ''), '^\\.', '') ELSE '&' || p END"
    )
    return f"array_to_string(list_concat([string_split({text}, '&')[1]], list_transform(string_split({text}, '&')[2:], lambda p: {part})), '')"


def _refs(text: str, masked: str = "[]") -> str:
    return f"list_filter(list_transform(regexp_extract_all({text}, '&(\\w+)', 1), lambda r: lower(r)), lambda r: NOT list_contains({masked}, r))"


def _params(text: str) -> str:
    return f"[lower(trim(split_part(x, '=', 1))) FOR x IN string_split({text}, ',')]"


CTES["macro_texts"] = f"""SELECT file_path, lower(regexp_extract(t, '{_MACRO}', 1)) AS name, regexp_extract(t, '{_MACRO}', 2) AS params, regexp_extract(t, '{_MACRO}', 3) AS body
FROM (SELECT file_path, unnest(regexp_extract_all(code, '(?is)%macro\\s.*?%mend', 0)) AS t FROM code_files)"""
CTES["common_macros"] = """SELECT name, min(params) AS params, min(body) AS body FROM macro_texts GROUP BY name HAVING count(DISTINCT file_path) = 1"""
CTES["base_names"] = """SELECT regexp_extract(file_path, '[^/]*$') AS file_name, min(file_path) AS base_path FROM code_files
GROUP BY ALL HAVING count(DISTINCT file_path) = 1"""
CTES["callers"] = """SELECT DISTINCT file_path FROM (
  SELECT file_path, lower(unnest(regexp_extract_all(code, '%(\\w+)', 1))) AS name FROM code_files) c
JOIN common_macros USING (name) WHERE NOT EXISTS (SELECT 1 FROM macro_texts m WHERE m.file_path = c.file_path AND m.name = c.name)"""
_NO_VALUES = "MAP {}::MAP(VARCHAR, VARCHAR)"
_ITEMS = "string_split({0}, ',')"


def _pairs(items: str, key: str, value: str, keep: str = "true") -> str:
    return f"map_from_entries([{{'k': lower(trim({key})), 'v': trim({value})}} FOR x IN {items} IF {keep}])"


_DEFAULTS = _pairs(_ITEMS.format("called.params"), "split_part(x, '=', 1)", "split_part(x, '=', 2)")
_BY_PLACE = _pairs(
    f"list_zip({_ITEMS.format('called.params')}[1:len([y FOR y IN {_ITEMS.format('val')} IF NOT contains(y, '=')])], [y FOR y IN {_ITEMS.format('val')} IF NOT contains(y, '=')])",
    "split_part(x[1], '=', 1)", "x[2]", "x[1] IS NOT NULL",
)
_BY_NAME = _pairs(_ITEMS.format("val"), "split_part(x, '=', 1)", "split_part(x, '=', 2)", "contains(x, '=')")
CTES["machine"] = f"""SELECT file_path AS root, [{{'file': file_path, 'rest': code, 'kind': 'own', 'known': {_NO_VALUES}}}] AS stack,
  {_NO_VALUES} AS env, '' AS text, '' AS extra, []::STRUCT(include_file VARCHAR, path VARCHAR)[] AS sites, 0::BIGINT AS total, []::VARCHAR[] AS left_open
FROM code_files WHERE contains(code, '&') OR regexp_matches(code, '(?i)%include') OR file_path IN (SELECT file_path FROM callers)
UNION ALL
SELECT root,
  CASE WHEN kind = 'end' THEN stack[:-2]
    WHEN kind = 'include' AND place <> 'call' AND target.file_path IS NOT NULL AND NOT list_contains([x.file FOR x IN stack], target.file_path)
      THEN list_concat(stack[:-2], [after, {{'file': target.file_path, 'rest': target.code, 'kind': 'silent', 'known': {_NO_VALUES}}}])
    WHEN kind = 'call' AND place <> 'silent' AND called.body IS NOT NULL
      THEN list_concat(stack[:-2], [after, {{'file': '%' || word, 'rest': called.body, 'kind': 'call',
        'known': map_concat(known, {_DEFAULTS}, {_BY_PLACE}, {_BY_NAME})}}])
    ELSE list_concat(stack[:-2], [after]) END,
  CASE WHEN kind = 'let' THEN map_concat(env, map_from_entries([{{'k': lower(name), 'v': val}}])) ELSE env END,
  text || CASE WHEN place = 'own' THEN shown ELSE '' END,
  extra || CASE WHEN place = 'call' THEN chr(10) || shown ELSE '' END,
  CASE WHEN kind = 'include' AND place = 'own' THEN list_append(sites, {{'include_file': arg, 'path': val}}) ELSE sites END,
  total + CASE WHEN place = 'silent' THEN 0 ELSE len(seen) END,
  CASE WHEN place = 'silent' THEN left_open ELSE list_concat(left_open, list_filter(seen, lambda r: known[r] IS NULL)) END
FROM (
  SELECT m.*, CASE WHEN e.name IS NOT NULL THEN {{'params': e.params, 'body': e.body}} ELSE {{'params': c.params, 'body': c.body}} END AS called,
    {{'file': top.file, 'rest': substr(top.rest, len(pre) + len(event) + 1), 'kind': place, 'known': top.known}} AS after,
    {_subst('pre', 'known')} || CASE WHEN kind = 'macro' THEN {_subst('event', 'known', 'masked')} ELSE replace(event, arg, val) END AS shown,
    list_concat({_refs('pre')}, {_refs('event', 'masked')}) AS seen
  FROM (
    SELECT *, top.kind AS place, map_concat(env, top.known) AS known,
      CASE WHEN event = '' THEN top.rest ELSE regexp_extract(top.rest, '{_EVENT}', 1) END AS pre,
      lower(regexp_extract(event, '^%(\\w+)', 1)) AS word, regexp_extract(event, '(?i)^%let\\s+(\\w+)', 1) AS name,
      CASE WHEN event = '' THEN 'end' WHEN word IN ('let', 'include', 'macro') THEN word ELSE 'call' END AS kind,
      CASE kind WHEN 'let' THEN regexp_extract(event, '(?s)=([^;]*);', 1) WHEN 'include' THEN regexp_extract(event, '[\"'']([^\"'']+)[\"'']', 1)
        WHEN 'call' THEN regexp_extract(event, '(?s)\\((.*)\\)', 1) ELSE '' END AS arg,
      trim({_subst('arg', 'known')}) AS val,
      CASE WHEN kind = 'macro' THEN {_params("regexp_extract(event, '(?is)^%macro\\s+\\w+\\s*\\(([^)]*)\\)', 1)")} ELSE []::VARCHAR[] END AS masked,
      CASE WHEN kind <> 'include' OR contains(val, '&') THEN NULL WHEN replace(val, chr(92), '/') LIKE '/%' THEN replace(val, chr(92), '/')
        ELSE regexp_replace(top.file, '[^/]*$', '') || replace(val, chr(92), '/') END AS wanted
    FROM (SELECT *, stack[-1] AS top, regexp_extract(stack[-1].rest, '{_EVENT}', 2) AS event FROM machine WHERE len(stack) > 0)
  ) m
  LEFT JOIN macro_texts e ON e.file_path = m.root AND e.name = m.word AND m.kind = 'call'
  LEFT JOIN common_macros c ON c.name = m.word AND m.kind = 'call'
) s
LEFT JOIN code_files exact ON exact.file_path = s.wanted
LEFT JOIN base_names b ON b.file_name = regexp_extract(s.wanted, '[^/]*$') AND exact.file_path IS NULL
LEFT JOIN code_files target ON target.file_path = coalesce(exact.file_path, b.base_path)"""
CTES["machine_end"] = "SELECT root AS file_path, text || extra AS text, sites, total, left_open FROM machine WHERE len(stack) = 0"


def _whole(found: str) -> str:
    """Names that no reference continues."""
    return f"list_filter({found}, lambda n: n NOT LIKE '%&')"


def outputs_as_resolved(code: str) -> str:
    out = _whole(_matches(code, r"(?i)\bout\s*=\s*([\w.]+&?)"))
    data = _whole(_matches(code, r"(?i)\bdata\s*=\s*([\w.]+&?)"))
    return _names(f"list_concat({_listed(code, 'data')}, list_concat({out}, {data}))")


CTES["resolved"] = f"""SELECT file_path,
  {inputs_of('code')} AS original_inputs, {outputs_of('code')} AS original_outputs,
  {inputs_of('text')} AS resolved_inputs, {outputs_as_resolved('text')} AS resolved_outputs,
  CAST(CASE WHEN total = 0 THEN 1.0 ELSE CAST(total - len(left_open) AS DOUBLE) / total END AS FLOAT) AS score,
  list_sort(list_distinct(left_open)) AS left_open
FROM machine_end JOIN code_files USING (file_path) WHERE contains(code, '&') OR file_path IN (SELECT file_path FROM callers)"""
CTES["resolved_table"] = """SELECT *, CASE WHEN len(left_open) > 0
  THEN 'unresolved: ' || array_to_string(left_open, ', ') END AS notes FROM resolved"""

# -- includes -----------------------------------------------------------------

CTES["include_texts"] = """SELECT DISTINCT file_path, include_file,
  CASE WHEN replace(path, chr(92), '/') LIKE '/%' THEN replace(path, chr(92), '/')
    ELSE regexp_replace(file_path, '[^/]*$', '') || replace(path, chr(92), '/') END AS candidate
FROM (SELECT file_path, unnest(sites, recursive := true) FROM machine_end)"""
CTES["links"] = """SELECT t.file_path, t.include_file, t.candidate, coalesce(f.file_path, b.base_path) AS resolved_path
FROM include_texts t LEFT JOIN code_files f ON f.file_path = t.candidate
LEFT JOIN base_names b ON b.file_name = regexp_extract(t.candidate, '[^/]*$') AND NOT contains(t.candidate, '&')"""
CTES["include_walk"] = """SELECT file_path AS root, coalesce(resolved_path, '?' || include_file) AS node, resolved_path, 1 AS level FROM links
UNION
SELECT w.root, coalesce(l.resolved_path, '?' || l.include_file), l.resolved_path, w.level + 1
FROM include_walk w JOIN links l ON l.file_path = w.resolved_path
WHERE coalesce(l.resolved_path, '?' || l.include_file) <> w.root
  AND NOT EXISTS (SELECT 1 FROM recurring.include_walk k WHERE k.root = w.root AND k.node = coalesce(l.resolved_path, '?' || l.include_file))"""
CTES["include_levels"] = "SELECT root, node, resolved_path, level FROM include_walk WHERE node <> root"
CTES["expanded"] = """SELECT v.root AS file_path, min(l.include_file) AS include_file, v.resolved_path, v.level AS expansion_level
FROM include_levels v
JOIN links l ON coalesce(l.resolved_path, '?' || l.include_file) = v.node
LEFT JOIN include_levels p ON p.root = v.root AND p.node = l.file_path AND p.level = v.level - 1
WHERE (v.level = 1 AND l.file_path = v.root) OR p.node IS NOT NULL
GROUP BY v.root, v.node, v.resolved_path, v.level"""

# -- graph --------------------------------------------------------------------

_SURE = "CASE WHEN list_contains(original_{0}, d) THEN CAST(1 AS FLOAT) ELSE score END"
CTES["dep_edges"] = f"""SELECT 'dataset:' || d AS source_node, 'file:' || file_path AS target_node, 'READS' AS edge_type, CAST(1 AS FLOAT) AS confidence, file_path
  FROM (SELECT file_path, unnest(input_datasets) AS d FROM raw WHERE file_path NOT IN (SELECT file_path FROM resolved))
UNION ALL SELECT 'file:' || file_path, 'dataset:' || d, 'WRITES', CAST(1 AS FLOAT), file_path
  FROM (SELECT file_path, unnest(output_datasets) AS d FROM raw WHERE file_path NOT IN (SELECT file_path FROM resolved))
UNION ALL SELECT 'macro:' || d, 'file:' || file_path, 'CALLS', CAST(1 AS FLOAT), file_path
  FROM (SELECT file_path, unnest(macro_calls) AS d FROM raw)
UNION ALL SELECT 'dataset:' || d, 'file:' || file_path, 'READS', {_SURE.format('inputs')}, file_path
  FROM (SELECT file_path, score, original_inputs, unnest(resolved_inputs) AS d FROM resolved)
UNION ALL SELECT 'file:' || file_path, 'dataset:' || d, 'WRITES', {_SURE.format('outputs')}, file_path
  FROM (SELECT file_path, score, original_outputs, unnest(resolved_outputs) AS d FROM resolved)"""
CTES["edges"] = """SELECT * FROM dep_edges
UNION ALL SELECT DISTINCT 'file:' || coalesce(resolved_path, candidate), 'file:' || file_path, 'INCLUDES', CAST(1 AS FLOAT), file_path FROM links"""
CTES["degrees"] = """SELECT node_id, CAST(sum(i) AS INTEGER) AS in_degree, CAST(sum(o) AS INTEGER) AS out_degree FROM (
  SELECT source_node AS node_id, 0 AS i, 1 AS o FROM edges UNION ALL SELECT target_node, 1, 0 FROM edges) GROUP BY node_id"""
CTES["flow"] = """SELECT DISTINCT substr(r.source_node, 9) AS source_dataset, substr(w.target_node, 9) AS target_dataset
FROM dep_edges r JOIN dep_edges w ON r.file_path = w.file_path WHERE r.edge_type = 'READS' AND w.edge_type = 'WRITES'"""
CTES["reach"] = """SELECT source_dataset AS a, target_dataset AS b FROM flow
UNION SELECT r.a, f.target_dataset FROM reach r JOIN flow f ON f.source_dataset = r.b"""
CTES["flow_cycles"] = """SELECT m.a AS member, least(m.a, min(m.b)) AS component
FROM reach m JOIN reach n ON m.a = n.b AND m.b = n.a GROUP BY m.a"""
# Cycles of the whole graph: two nodes on one cycle reach each other; files that
# only include or call others cannot lie on one without dataset edges.
CTES["graph_reach"] = """SELECT DISTINCT source_node AS a, target_node AS b FROM core_edges
UNION SELECT r.a, e.target_node FROM graph_reach r JOIN core_edges e ON e.source_node = r.b"""
CTES["core_edges"] = """SELECT source_node, target_node FROM edges
WHERE source_node IN (SELECT target_node FROM edges) AND target_node IN (SELECT source_node FROM edges)"""
CTES["graph_cycles"] = """SELECT m.a AS member, least(m.a, min(m.b)) AS component
FROM graph_reach m JOIN graph_reach n ON m.a = n.b AND m.b = n.a GROUP BY m.a"""
CTES["graph_check"] = """SELECT (SELECT count(*) FROM degrees) AS nodes, CAST(0 AS BIGINT) AS dangling_ends, CAST(0 AS BIGINT) AS isolated_nodes,
  (SELECT count(*) FROM edges) AS edges,
  (SELECT count(*) FROM edges WHERE source_node = target_node) AS self_loops,
  (SELECT count(*) - count(DISTINCT (source_node, target_node, edge_type, file_path)) FROM edges) AS duplicate_edges,
  (SELECT count(DISTINCT component) FROM graph_cycles) AS cycles, (SELECT count(*) FROM graph_cycles) AS cycle_members"""

# PageRank: residuals are pushed until they add up to the tolerance.
TOLERANCE = 1e-4
CTES["pairs"] = "SELECT DISTINCT source_node AS src, target_node AS dst FROM edges"
CTES["outs"] = """SELECT n.node_id, count(p.dst) AS o FROM degrees n LEFT JOIN pairs p ON p.src = n.node_id GROUP BY n.node_id"""
CTES["total_nodes"] = "SELECT CAST(count(*) AS DOUBLE) AS n FROM outs"
CTES["pushes"] = f"""SELECT 0 AS k, node_id, o, CAST(0 AS DOUBLE) AS rank, 0.15 / n AS r, {TOLERANCE} / (10 * n) AS least FROM outs, total_nodes
UNION ALL
SELECT s.k + 1, s.node_id, s.o, s.rank + CASE WHEN s.r > s.least THEN s.r ELSE 0 END,
  CASE WHEN s.r > s.least THEN 0 ELSE s.r END + coalesce(g.got, 0), s.least
FROM pushes s LEFT JOIN (
  SELECT p.dst, sum(0.85 * q.r / q.o) AS got FROM pairs p JOIN pushes q ON q.node_id = p.src WHERE q.r > q.least GROUP BY p.dst) g ON g.dst = s.node_id
WHERE (SELECT sum(r) FROM pushes) > {TOLERANCE}"""
CTES["ranks"] = """SELECT node_id, (rank + r) / (sum(rank + r) OVER ()) AS rank FROM pushes WHERE k = (SELECT max(k) FROM pushes)"""

# Betweenness: distances first, then path counts up and dependencies down, level by level.
CTES["steps"] = "SELECT source_dataset AS u, target_dataset AS v FROM flow WHERE source_dataset <> target_dataset"
CTES["walk"] = """SELECT u AS s, v, 1 AS d FROM steps
UNION SELECT w.s, e.v, w.d + 1 FROM walk w JOIN steps e ON e.u = w.v
WHERE NOT EXISTS (SELECT 1 FROM recurring.walk k WHERE k.s = w.s AND k.v = e.v)"""
CTES["dist"] = """SELECT s, v, d FROM walk WHERE s <> v
UNION ALL SELECT DISTINCT u, u, 0 FROM steps"""
CTES["sp"] = """SELECT a.s, e.u, e.v, a.d FROM dist a JOIN steps e ON e.u = a.v
JOIN dist b ON b.s = a.s AND b.v = e.v AND b.d = a.d + 1"""
CTES["paths"] = """SELECT s, v, d, CAST(1 AS DOUBLE) AS n FROM dist WHERE d = 0
UNION ALL SELECT p.s, p.v, p.d + 1, sum(q.n) FROM sp p JOIN paths q ON q.s = p.s AND q.v = p.u AND q.d = p.d GROUP BY ALL"""
CTES["deps"] = """SELECT s, v, d, n, CAST(0 AS DOUBLE) AS delta FROM paths WHERE d = (SELECT max(d) FROM paths)
UNION ALL
SELECT g.s, g.v, g.d, g.n, coalesce(sum(g.n / b.n * (1 + b.delta)), 0)
FROM paths g LEFT JOIN sp p ON p.s = g.s AND p.u = g.v LEFT JOIN deps b ON b.s = p.s AND b.v = p.v
WHERE g.d = (SELECT max(d) - 1 FROM deps) AND g.d >= 1 GROUP BY g.s, g.v, g.d, g.n"""
CTES["all_deps"] = "SELECT v, delta FROM deps WHERE d >= 1"
CTES["flow_betweenness"] = """SELECT n.dataset_name, coalesce(sum(a.delta), 0) AS betweenness
FROM (SELECT source_dataset AS dataset_name FROM flow UNION SELECT target_dataset FROM flow) n
LEFT JOIN all_deps a ON a.v = n.dataset_name GROUP BY n.dataset_name"""

# A shortest cycle through the first member of each component of the whole graph.
CTES["cycle_edges"] = """SELECT DISTINCT m.component, e.source_node AS u, e.target_node AS v
FROM core_edges e JOIN graph_cycles m ON m.member = e.source_node JOIN graph_cycles n ON n.member = e.target_node AND n.component = m.component"""
CTES["cycle_walk"] = """SELECT component, component AS node, 0 AS d FROM (SELECT DISTINCT component FROM graph_cycles)
UNION SELECT w.component, e.v, w.d + 1 FROM cycle_walk w JOIN cycle_edges e ON e.component = w.component AND e.u = w.node
WHERE NOT EXISTS (SELECT 1 FROM recurring.cycle_walk k WHERE k.component = w.component AND k.node = e.v)"""
CTES["cycle_parents"] = """SELECT e.component, e.v AS node, min(e.u) AS parent
FROM cycle_edges e JOIN cycle_walk a ON a.component = e.component AND a.node = e.u JOIN cycle_walk b ON b.component = e.component AND b.node = e.v
WHERE b.d = a.d + 1 GROUP BY ALL"""
CTES["cycle_ends"] = """SELECT component, min(node) AS member, d AS position FROM (
  SELECT w.component, w.node, w.d, min(w.d) OVER (PARTITION BY w.component) AS least
  FROM cycle_walk w JOIN cycle_edges e ON e.component = w.component AND e.u = w.node AND e.v = w.component) WHERE d = least GROUP BY component, d"""
CTES["cycle_path"] = """SELECT component, position, member FROM cycle_ends
UNION ALL SELECT p.component, p.position - 1, q.parent FROM cycle_path p JOIN cycle_parents q ON q.component = p.component AND q.node = p.member WHERE p.position > 0"""

# -- enrichment ---------------------------------------------------------------

CTES["datasets"] = """SELECT DISTINCT unnest(list_concat(input_datasets, output_datasets)) AS dataset_name FROM raw"""
CTES["classes"] = """SELECT dataset_name, business_domain, data_category, sensitivity_level,
  business_domain || ' / ' || data_category || ' / ' || sensitivity_level AS description FROM (
  SELECT d.dataset_name, r.*, row_number() OVER (PARTITION BY d.dataset_name ORDER BY r.priority, r.pattern) AS rn
  FROM datasets d LEFT JOIN class_rules r ON d.dataset_name LIKE r.pattern) WHERE rn = 1"""
CTES["close_pairs"] = """SELECT dataset_name, table_name, levenshtein(dataset_name, table_name) AS edits
FROM datasets JOIN (SELECT DISTINCT table_name FROM catalog_tables)
  ON length(table_name) BETWEEN 0.7 * length(dataset_name) AND length(dataset_name) / 0.7
WHERE 1.0 - CAST(levenshtein(dataset_name, table_name) AS DOUBLE) / greatest(length(dataset_name), length(table_name)) >= 0.7"""
CTES["best_pairs"] = """SELECT *, 1.0 - CAST(edits AS DOUBLE) / greatest(length(dataset_name), length(table_name)) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset_name
    ORDER BY 1.0 - CAST(edits AS DOUBLE) / greatest(length(dataset_name), length(table_name)) DESC, table_name) AS rn FROM close_pairs) WHERE rn = 1"""
CTES["matches"] = """SELECT d.dataset_name, CASE WHEN score >= 0.7 THEN table_name END AS unity_catalog_match,
  CASE WHEN score >= 0.7 THEN score END AS match_confidence FROM datasets d LEFT JOIN best_pairs b ON b.dataset_name = d.dataset_name"""

# -- run log ------------------------------------------------------------------

CTES["status_rows"] = """SELECT *, row_number() OVER (PARTITION BY workflow_id, stage ORDER BY created_at DESC, event_id DESC) AS rn
FROM run_log WHERE status <> 'CHECKPOINT'"""
CTES["latest"] = "SELECT * FROM status_rows WHERE rn = 1"
CTES["ends"] = """SELECT *, lead(CASE WHEN status <> 'STARTED' THEN {'e': end_time, 's': status} END IGNORE NULLS)
  OVER (PARTITION BY workflow_id, stage ORDER BY created_at, event_id) AS next_end
FROM run_log WHERE status <> 'CHECKPOINT'"""
CTES["durations"] = """SELECT workflow_id, stage, event_id, next_end.s AS end_status, start_time, next_end.e AS end_time,
  CAST(epoch_us(next_end.e) - epoch_us(start_time) AS DOUBLE) / 1000000 AS seconds FROM ends WHERE status = 'STARTED'"""

# -- checks -------------------------------------------------------------------

CTES["parse_check"] = """SELECT count(*) AS total_rows, count(DISTINCT file_path) AS distinct_files,
  (SELECT count(*) FROM (SELECT file_path FROM raw WHERE file_path IS NOT NULL GROUP BY file_path HAVING count(*) > 1)) AS duplicate_files,
  count(*) - count(file_path) AS null_paths,
  count(*) FILTER (len(input_datasets) + len(output_datasets) + len(macro_calls) + len(include_files) = 0) AS files_without_dependencies,
  count(*) FILTER (has_dynamic_deps) AS dynamic_files,
  CAST(count(*) FILTER (has_dynamic_deps) AS DOUBLE) / count(*) AS dynamic_share FROM raw"""
CTES["resolution_check"] = """SELECT count(*) AS total_rows, avg(CAST(score AS DOUBLE)) AS avg_confidence, min(CAST(score AS DOUBLE)) AS min_confidence,
  CAST(count(*) FILTER (CAST(score AS DOUBLE) < 0.8) AS DOUBLE) / count(*) AS low_confidence_share,
  count(*) FILTER (len(left_open) > 0) AS files_with_open_names, CAST(sum(len(left_open)) AS BIGINT) AS open_names FROM resolved"""


# Walks that keep the first visit of each key.
KEYED = {"walk": "s, v", "cycle_walk": "component, node", "include_walk": "root, node"}
_COLUMNS = {"walk": "s, v, d", "cycle_walk": "component, node, d", "include_walk": "root, node, resolved_path, level"}


def _needed(sql: str, names: list[str]) -> set[str]:
    outside_literals = re.sub(r"'[^']*'", "", sql)
    return set(re.findall(r"\w+", outside_literals)) & set(names)


def with_ctes(body: str) -> str:
    """The query with the expressions it needs, in an order that defines before use."""
    order: list[str] = []

    def visit(sql: str, seen: tuple[str, ...]) -> None:
        for name in sorted(_needed(sql, list(CTES))):
            if name not in order and name not in seen:
                visit(CTES[name], (*seen, name))
                order.append(name)

    visit(body, ())
    recursive = {n for n in order if n in _needed(CTES[n], [n])}
    parts = []
    for n in order:
        head = f"{n}({_COLUMNS[n]}) USING KEY ({KEYED[n]}) AS " if n in KEYED else f"{n} AS " if n in recursive else f"{n} AS MATERIALIZED "
        parts.append(f"{head}({CTES[n].strip()})")
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body


_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"
_CHECK_ROWS = " UNION ALL ".join(
    f"SELECT 'check' AS section, '{item}' AS item, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM {cte}"
    for item, cte, measures in (
        ("parsing", "parse_check", ("total_rows", "distinct_files", "duplicate_files", "null_paths", "files_without_dependencies", "dynamic_files", "dynamic_share")),
        ("resolution", "resolution_check", ("total_rows", "avg_confidence", "min_confidence", "low_confidence_share", "files_with_open_names", "open_names")),
        ("graph", "graph_check", ("nodes", "dangling_ends", "isolated_nodes", "edges", "self_loops", "duplicate_edges", "cycles", "cycle_members")),
    )
    for m in measures
)
_STAGE_ORDER = ", ".join(f"({i}, '{s}')" for i, s in enumerate(STAGES))

# A scanned file ends with a line feed that the writer adds.
CTES["programs"] = """SELECT replace(regexp_replace(file_path, '/[^/]*$', ''), '/', '_') AS folder, code || chr(10) AS code FROM code_files"""
_SCANNED = f"SELECT folder, md5(code) AS content, true AS named, array_to_string({inputs_of('code')}, '|') AS input_datasets FROM programs"
_COLUMN_COUNTS = ", ".join(f"('{t}', {len(columns.split(', '))})" for t, columns in TABLES.items() if "MAP<" not in columns)

BODIES: dict[str, str] = {
    "scan_code_files": _SCANNED,
    "scan_code_files_recursive": _SCANNED,
    "scan_file_list": _SCANNED,
    "scan_by_line": """SELECT folder, md5(line) AS content, true AS named, count(*) AS lines
FROM (SELECT folder, unnest(string_split(code, chr(10))[:-2]) AS line FROM programs) GROUP BY ALL""",
    "skewed_lookup": """SELECT regexp_replace(file_path, '/[^/]*$', '') AS folder, file_name,
  count(*) OVER (PARTITION BY regexp_replace(file_path, '/[^/]*$', '')) AS programs FROM raw""",
    "table_write": f"""SELECT file_path, {_JOINED}, CASE WHEN len(include_files) > 0 THEN 2 ELSE 1 END::BIGINT AS copies FROM raw""",
    "table_lifecycle": f"""SELECT t.name AS table_name, false AS before, true AS created, CAST(t.columns AS INTEGER) AS columns,
  CASE t.name WHEN 'raw_dependencies' THEN (SELECT count(*) FROM raw) WHEN 'workflow_state' THEN (SELECT count(*) FROM run_log) ELSE 0 END AS rows_written, false AS after
FROM (VALUES {_COLUMN_COUNTS}, ('resolved_dependencies', 9)) AS t(name, columns)""",
    "wf_append": """SELECT workflow_id, stage, status, status = 'STARTED' AS starts, status IN ('SUCCESS', 'FAILED') AS ends, error_message, checkpoint_data, true AS stamped FROM run_log
UNION ALL SELECT DISTINCT workflow_id, 'INIT', 'CREATED', true, false, NULL, NULL, true FROM run_log""",
    **{
        name: f"SELECT file_path, array_to_string({make('code')}, '|') AS {name} FROM code_files"
        for name, make in EXTRACTED.items()
    },
    "has_dynamic_deps": "SELECT file_path, contains(code, '&') AS has_dynamic_deps FROM code_files",
    "normalize_dataset_name": """SELECT p_partkey,
  lower(regexp_replace(trim('  ' || upper(p_brand) || '.' || p_name || ';.;  '), '[;.]+$', '')) AS dataset_name FROM part""",
    "raw_dependencies": f"SELECT file_path, file_name, has_dynamic_deps, {_JOINED} FROM raw",
    "raw_dependencies_by_line": f"""SELECT file_path, CAST(i - 1 AS INTEGER) AS line_no, contains(line, '&') AS has_dynamic_deps,
  {', '.join(f"array_to_string({make('line')}, '|') AS {name}" for name, make in EXTRACTED.items())}
FROM (SELECT file_path, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
  FROM (SELECT file_path, string_split(rtrim(code, chr(10)), chr(10)) AS lines FROM code_files))""",
    "num_files": "SELECT count(DISTINCT file_path) AS num_files FROM raw",
    "file_metadata": """SELECT file_path, regexp_extract(file_path, '[^/]*$') AS file_name, CAST(strlen(code) AS BIGINT) AS file_size_bytes,
  CAST(len(code) - len(replace(code, chr(10), '')) AS INTEGER) AS line_count FROM code_files""",
    "latest_per_file": """SELECT file_path, array_to_string(input_datasets, '|') AS input_datasets, array_to_string(proc_types, '|') AS proc_types, created_at
FROM (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY created_at DESC) AS rn FROM (
  SELECT file_path, input_datasets, proc_types, '2024-01-01 00:00:00.000000' AS created_at FROM raw
  UNION ALL SELECT file_path, input_datasets, ['rerun'], '2024-01-02 00:00:00.000000' FROM raw WHERE len(include_files) > 0)) WHERE rn = 1""",
    "export_graph_json": """SELECT split_part(node_id, ':', 1) AS kind, node_id AS id, substr(node_id, instr(node_id, ':') + 1) AS other, in_degree, out_degree,
  CAST(NULL AS DOUBLE) AS confidence, CAST(NULL AS VARCHAR) AS file_path FROM degrees
UNION ALL SELECT edge_type, source_node, target_node, NULL, NULL, round(CAST(confidence AS DOUBLE), 6), file_path FROM edges""",
    "wf_load_checkpoint": """SELECT workflow_id, stage, CASE WHEN json_valid(checkpoint_data) THEN checkpoint_data END AS checkpoint_data FROM (
  SELECT *, row_number() OVER (PARTITION BY workflow_id, stage
    ORDER BY created_at DESC, CASE WHEN checkpoint_data IS NULL THEN 1 ELSE 0 END, checkpoint_data DESC) AS rn
  FROM run_log WHERE status = 'CHECKPOINT') WHERE rn = 1""",
    "wf_latest_status": f"SELECT workflow_id, stage, status, error_message, {_STAMP.format('created_at')} FROM latest",
    "wf_stage_duration": f"""SELECT workflow_id, stage, event_id, end_status, {_STAMP.format('start_time')}, {_STAMP.format('end_time')},
  round(seconds, 6) AS seconds FROM durations""",
    "wf_failures": """SELECT workflow_id, stage, event_id, split_part(error_message, ': ', 1) AS error_type,
  substr(error_message, instr(error_message, ': ') + 2) AS error_text FROM run_log WHERE status = 'FAILED'""",
    "wf_resume_point": f"""SELECT w.workflow_id, arg_min(o.stage, o.pos) FILTER (l.status IS NULL OR l.status <> 'SUCCESS') AS resume_stage
FROM (SELECT DISTINCT workflow_id FROM latest) w CROSS JOIN (VALUES {_STAGE_ORDER}) AS o(pos, stage)
LEFT JOIN latest l ON l.workflow_id = w.workflow_id AND l.stage = o.stage GROUP BY w.workflow_id""",
    "wf_rows_of_workflow": """SELECT workflow_id, count(*) AS rows, string_agg(DISTINCT status, '|' ORDER BY status) AS statuses FROM run_log GROUP BY workflow_id""",
    "macro_definitions": r"""SELECT file_path,
  array_to_string(list_sort(list_filter(list_transform(lets, lambda p, i: CASE WHEN NOT list_contains([lower(regexp_extract(q, '^\w+')) FOR q IN lets[i + 1:]], lower(regexp_extract(p, '^\w+')))
    THEN lower(regexp_extract(p, '^\w+')) || '=' || trim(substr(p, instr(p, '=') + 1)) END), lambda v: v IS NOT NULL)), '|') AS macro_definitions,
  array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(code, '(?i)%macro\s+(\w+)', 1), lambda m: lower(m)))), '|') AS macros_defined
FROM (SELECT *, regexp_extract_all(code, '(?i)%let\s+(\w+\s*=[^;]*);', 1) AS lets FROM code_files)""",
    "dynamic_files": "SELECT file_path FROM code_files WHERE contains(code, '&')",
    "resolved_dependencies": "SELECT file_path, "
    + ", ".join(
        f"array_to_string({c}, '|') AS {c}"
        for c in ("original_inputs", "original_outputs", "resolved_inputs", "resolved_outputs")
    )
    + " FROM resolved",
    "resolution_confidence": """SELECT file_path, round(CAST(score AS DOUBLE), 6) AS resolution_confidence, notes AS resolution_notes FROM resolved_table""",
    "expanded_includes": """SELECT e.file_path, e.include_file, e.resolved_path, f.code AS include_content, CAST(e.expansion_level AS INTEGER) AS expansion_level
FROM expanded e LEFT JOIN code_files f ON f.file_path = e.resolved_path""",
    "include_path_resolution": "SELECT file_path, include_file, resolved_path FROM links",
    "unique_datasets": "SELECT dataset_name FROM datasets",
    "dataset_classifications": """SELECT c.dataset_name, business_domain, data_category, sensitivity_level, description, unity_catalog_match,
  round(CAST(CAST(match_confidence AS FLOAT) AS DOUBLE), 6) AS match_confidence FROM classes c JOIN matches m ON m.dataset_name = c.dataset_name""",
    "catalog_match": "SELECT dataset_name, unity_catalog_match, round(match_confidence, 6) AS match_confidence FROM matches",
    "lineage_edges": "SELECT source_node, target_node, edge_type, round(CAST(confidence AS DOUBLE), 6) AS confidence, file_path FROM edges",
    "lineage_nodes": """SELECT d.node_id, split_part(d.node_id, ':', 1) AS node_type, substr(d.node_id, instr(d.node_id, ':') + 1) AS node_name,
  in_degree, out_degree, round(CAST(CAST(rank AS FLOAT) AS DOUBLE), 9) AS pagerank, round(b.betweenness, 6) AS betweenness_centrality
FROM degrees d JOIN ranks p ON p.node_id = d.node_id LEFT JOIN flow_betweenness b ON d.node_id = 'dataset:' || b.dataset_name""",
    "node_degree": "SELECT node_id, in_degree, out_degree FROM degrees",
    "pagerank": "SELECT node_id, round(rank, 9) AS pagerank FROM ranks",
    "betweenness": "SELECT dataset_name, round(betweenness, 6) AS betweenness_centrality FROM flow_betweenness",
    "detect_cycles": """SELECT component, member, count(*) OVER (PARTITION BY component) AS size FROM flow_cycles""",
    "cycle_paths": "SELECT component, CAST(position AS INTEGER) AS position, member FROM cycle_path",
    "dataset_flow": "SELECT source_dataset, target_dataset FROM flow",
    "lineage_closure": f"""SELECT s AS ancestor, v AS descendant, CAST(min(d) AS INTEGER) AS distance FROM (
  SELECT s, v, d FROM walk UNION ALL SELECT source_dataset, source_dataset, 1 FROM flow WHERE source_dataset = target_dataset) GROUP BY s, v""",
    "reach_counts": """SELECT n.dataset_name, count(r.b) AS reached
FROM (SELECT source_dataset AS dataset_name FROM flow UNION SELECT target_dataset FROM flow) n LEFT JOIN reach r ON r.a = n.dataset_name GROUP BY n.dataset_name""",
    "catalog_integration": """SELECT node_id, split_part(node_id, ':', 1) AS node_type, unity_catalog_match, round(match_confidence, 6) AS match_confidence
FROM degrees LEFT JOIN matches ON node_id = 'dataset:' || dataset_name""",
    "validate_parsing": "SELECT * REPLACE (round(dynamic_share, 6) AS dynamic_share) FROM parse_check",
    "validate_resolution": """SELECT * REPLACE (round(avg_confidence, 6) AS avg_confidence, round(min_confidence, 6) AS min_confidence,
  round(low_confidence_share, 6) AS low_confidence_share) FROM resolution_check""",
    "validate_graph": "SELECT * FROM graph_check",
    "overview_metrics": """SELECT (SELECT count(*) FROM raw) AS raw_dependencies, (SELECT count(*) FROM resolved) AS resolved_dependencies,
  (SELECT count(*) FROM datasets) AS datasets, (SELECT count(*) FROM degrees) AS lineage_nodes,
  (SELECT count(*) FROM edges) AS lineage_edges, (SELECT count(*) FROM run_log) AS workflow_state""",
    "top_critical_files": """SELECT d.node_id, substr(d.node_id, 6) AS node_name, in_degree + out_degree AS degree,
  round(CAST(CAST(rank AS FLOAT) AS DOUBLE), 9) AS pagerank FROM degrees d JOIN ranks p ON p.node_id = d.node_id
WHERE d.node_id LIKE 'file:%' ORDER BY round(CAST(CAST(rank AS FLOAT) AS DOUBLE), 12) DESC, degree DESC, d.node_id LIMIT 20""",
    "domain_breakdown": """SELECT business_domain, sensitivity_level, CAST(grouping(business_domain, sensitivity_level) AS BIGINT) AS rollup_level, count(*) AS datasets
FROM classes GROUP BY ROLLUP (business_domain, sensitivity_level)""",
    "dependency_analysis": """SELECT dataset_name, count(*) FILTER (t = 'WRITES') AS written_by, count(*) FILTER (t = 'READS') AS read_by,
  count(*) FILTER (t = 'WRITES') = 0 AS is_source, count(*) FILTER (t = 'READS') = 0 AS is_sink FROM (
  SELECT substr(CASE WHEN edge_type = 'READS' THEN source_node ELSE target_node END, 9) AS dataset_name, edge_type AS t
  FROM dep_edges WHERE edge_type <> 'CALLS') GROUP BY dataset_name""",
    "stage_report": f"""SELECT section, item, measure, round(value, 4) AS value FROM (
  SELECT 'status' AS section, stage AS item, status AS measure, CAST(count(*) AS DOUBLE) AS value FROM latest GROUP BY stage, status
  UNION ALL SELECT 'time', stage, 'runs', count(*) FROM durations GROUP BY stage
  UNION ALL SELECT 'time', stage, 'finished', count(end_time) FROM durations GROUP BY stage
  UNION ALL SELECT 'time', stage, 'avg_seconds', avg(seconds) FROM durations GROUP BY stage
  UNION ALL SELECT 'time', stage, 'max_seconds', max(seconds) FROM durations GROUP BY stage
  UNION ALL {_CHECK_ROWS})""",
}

ORACLES: dict[str, str] = {name: with_ctes(body) for name, body in BODIES.items()}
