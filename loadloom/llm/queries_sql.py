"""DuckDB SQL that must give the rows of the queries, where SQL can say it."""

from .quality_rules import BASE, CAPITALS, RULES, STOP_WORDS, SYMBOLS

_KEY = (
    "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))


def _count(chars: str) -> str:
    return f"len(text) - len(translate(text, '{chars}', ''))"


def _passes(rule) -> str:
    low = [f"{rule.measure} >= {rule.least}"] if rule.least is not None else []
    high = [f"{rule.measure} <= {rule.most}"] if rule.most is not None else []
    return "(" + " AND ".join(low + high) + ")"


ORACLES = {
    "op5_quality_rules": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
runs AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
repeats AS (SELECT doc_id, i FROM runs QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM repeats, range(0, 3) r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: len(trim(x, {_SPACES})) > 0) AS l FROM d),
counts AS (
  SELECT d.doc_id, len(w) AS n_words, len(translate(text, {_SPACES}, '')) AS word_chars, {_count(SYMBOLS)} AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(list_intersect(w, [{_STOP}])) AS n_stop_words,
    {_count(CAPITALS)} AS n_capitals, {_count('!')} AS n_exclamations, len(l) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(ltrim(x), '^[-*•]'))) AS bullets,
    len(list_filter(l, lambda x: regexp_matches(rtrim(x), '(\\.\\.\\.|…)$'))) AS ellipses
  FROM d JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
measures AS (
  SELECT *, n_repeat_words / greatest(n_words, 1) AS repeat_share, word_chars / greatest(n_words, 1) AS mean_word_chars,
    n_symbols / greatest(n_words, 1) AS symbols_per_word, n_exclamations / greatest(n_words, 1) AS exclamations_per_word,
    n_capitals / greatest(word_chars, 1) AS capital_share, n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
    bullets / greatest(n_lines, 1) AS bullet_line_share, ellipses / greatest(n_lines, 1) AS ellipsis_line_share FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, NOT ({' AND '.join(map(_passes, BASE))}) AS base_failed,
  {' AND '.join(map(_passes, (*BASE, *RULES)))} AS kept FROM measures""",
    "op7_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, range(0, 20) r(k)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
judged AS (SELECT words.doc_id, word, words.i, gone.i IS NOT NULL AS removed FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i)
SELECT d.doc_id, count(word) AS n_words, count(*) FILTER (WHERE removed) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT removed), '')) AS kept_sha256
FROM d LEFT JOIN judged ON judged.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op9_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT doc_id, pos, line, {_KEY} AS line_key FROM lines),
shared AS (
  SELECT line_key, min(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 10
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT k.doc_id, k.pos, k.line, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN shared s USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op8_url_filter": """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw_host,
         regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut),
named AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
found AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM named)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM found""",
    "op12_fill_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents),
h AS (SELECT *, len(u) AS n, [('0x' || substr(hex, 8 * k + 1, 8))::BIGINT FOR k IN range(4)] AS h FROM d),
c AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
              WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p""",
    "op13_prefix_trie": r"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT conv_id, turns, xor(4294967295::BIGINT, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))) % 4 AS h FROM own, crc),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:h], []), c.turns[h + 1:]) AS seq
  FROM h c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
prefixes AS (
  SELECT conv_id, d, len(seq) = d AS ends, coalesce(len(regexp_extract_all(seq[d].x, '[^\x20\x09-\x0D]+')), 0) AS words, seq[1:d] AS prefix
  FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)),
named AS (SELECT conv_id, d, ends, words, min(conv_id) OVER (PARTITION BY d, prefix) AS m FROM prefixes),
nodes AS (
  SELECT m, d, count(*) AS n, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM named GROUP BY m, d),
edges AS (SELECT v.m, v.d, p.m AS pm FROM nodes v JOIN named p ON p.conv_id = v.m AND p.d = v.d - 1),
children AS (SELECT pm AS m, d - 1 AS d, count(*) AS n FROM edges GROUP BY ALL),
below AS (
  SELECT u.m, u.d, sum((v.n - 1) * v.words)::BIGINT AS saved_tokens, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves
  FROM nodes v JOIN named u ON u.conv_id = v.m AND u.d <= v.d LEFT JOIN children c ON c.m = v.m AND c.d = v.d GROUP BY u.m, u.d)
SELECT v.m AS conv_id, v.d AS depth, e.pm AS parent_conv_id, v.n AS n_convs, coalesce(c.n, 0) AS n_children, b.n_leaves, b.saved_tokens, v.ends_sha256
FROM nodes v JOIN below b USING (m, d) LEFT JOIN edges e USING (m, d) LEFT JOIN children c USING (m, d)""",
}
