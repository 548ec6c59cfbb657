"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tripline.llm import line_rules as rules
from tripline.llm.common import UPPER

_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP8 = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS l, list_slice(w, s, s + least(10, len(w)) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s
        FROM items WHERE len(w) > 0)),
grams AS (
  SELECT rid, s, l, list_slice(w, s, s + l - 1) AS g
  FROM (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS s
        FROM docs, (SELECT DISTINCT l FROM windows) WHERE len(w) >= l)),
hits AS (SELECT rid, s, l, item_id FROM grams JOIN windows USING (l, g)),
places AS (SELECT rid, count(DISTINCT p) AS n_hit
           FROM (SELECT rid, unnest(range(s, s + l)) AS p FROM hits) GROUP BY rid),
named AS (SELECT rid, list_sort(list(DISTINCT item_id::varchar)) AS items FROM hits GROUP BY rid)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit,
       coalesce(len(items), 0)::bigint AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN places USING (rid) LEFT JOIN named USING (rid)
"""

_SPLIT = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_BARE = r"regexp_replace({0}, '[\x20\x09-\x0D]', '', 'g')"
_SIGNS = r"[#*$%&|<>!=~^_{{}}\[\]\\]"
_LINE_FAILS = rf"""(
  (NOT regexp_matches(l, '[.!?…。]["''”’»)\]]*[\x20\x09-\x0D]*\z')
   AND length(l) - length(regexp_replace(l, '[.!?…。]', '', 'g')) < {rules.INNER_ENDS})
  OR length(l) - length(regexp_replace(l, '{_SIGNS.format()}', '', 'g'))
     > {rules.SIGN_SHARE}::double * length(l)
  OR (length(l) - length(regexp_replace(l, '[|»·›•]', '', 'g')) >= {rules.MIN_SEPARATORS}
      AND length(l) - length(regexp_replace(l, '[|»·›•]', '', 'g'))
          >= {rules.SEPARATOR_SHARE}::double * len({_SPLIT.format('l')}))
  OR (regexp_matches(lower(l), '{"|".join(rules.PHRASES)}')
      AND len({_SPLIT.format('l')}) <= {rules.BOILERPLATE_WORDS}))"""

OP9 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         {_SPLIT.format("coalesce(text, '')")} AS w,
         string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
grams AS (
  SELECT rid, s, list_slice(w, s, s + 4) AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS s FROM docs WHERE len(w) >= 5)),
twice AS (SELECT rid, s FROM (SELECT rid, s, count(*) OVER (PARTITION BY rid, g) AS n FROM grams)
          WHERE n > 1),
repeated AS (SELECT rid, count(DISTINCT p) AS n
             FROM (SELECT rid, unnest(range(s, s + 5)) AS p FROM twice) GROUP BY rid),
counted AS (
  SELECT doc_id, len(w)::bigint AS n_words, length({_BARE.format('t')})::bigint AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint AS n_symbols,
         len(list_filter(lines, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))) AS n,
         len(list_distinct(list_filter(lines, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))))
           AS n_once,
         coalesce(repeated.n, 0)::bigint AS n_repeat_words,
         coalesce(list_sum(list_transform(list_filter(lines, lambda l: NOT {_LINE_FAILS}),
           lambda l: length({_BARE.format('l')}))), 0)::bigint AS kept_chars
  FROM docs LEFT JOIN repeated USING (rid)),
judged AS (SELECT *, n_words < {rules.MIN_WORDS}
             OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
           FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, (n - n_once)::bigint AS n_dup_lines, n_repeat_words,
       base_failed, NOT base_failed AND kept_chars >= {1 - rules.MAX_LOSS}::double * word_chars
         AS kept, kept_chars
FROM judged
"""

_CRC32 = """xor(list_reduce([4294967295::bigint] || flatten(list_transform(
  string_split(conv_id::varchar, ''), lambda ch: [ascii(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END),
  4294967295)"""

OP12 = rf"""
WITH own AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), said := coalesce(text, ''))
                       ORDER BY turn NULLS FIRST) AS seq
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (SELECT conv_id, seq, conv_id - conv_id % 20 AS head, {_CRC32} % 4 AS h FROM own),
whole AS (
  SELECT headed.conv_id, list_concat(list_slice(coalesce(own.seq, []), 1, h),
                                     list_slice(headed.seq, h + 1, len(headed.seq))) AS seq
  FROM headed LEFT JOIN own ON own.conv_id = head),
starts AS (SELECT conv_id, d, list_slice(seq, 1, d) AS node, len(seq) = d AS ended
           FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM whole)),
nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (ended), '') AS ends
  FROM starts GROUP BY node, d),
kids AS (SELECT list_slice(node, 1, d - 1) AS node, d - 1 AS d, count(*) AS n_children
         FROM nodes WHERE d > 0 GROUP BY ALL),
valued AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN nodes.d = 0 THEN 0 ELSE
    (n_convs - 1) * len({_SPLIT.format('nodes.node[-1].said')}) END AS saved
  FROM nodes LEFT JOIN kids ON kids.d = nodes.d AND kids.node = nodes.node),
above AS (
  SELECT list_slice(node, 1, up) AS node, up, sum((n_children = 0)::bigint) AS n_leaves,
         sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM valued) GROUP BY ALL)
SELECT v.conv_id, v.d::bigint AS depth, parent.conv_id AS parent_conv_id, v.n_convs::bigint AS n_convs,
       v.n_children::bigint AS n_children, n_leaves::bigint AS n_leaves,
       saved_tokens::bigint AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN above ON above.up = v.d AND above.node = v.node
LEFT JOIN nodes parent ON parent.d = v.d - 1 AND parent.node = list_slice(v.node, 1, v.d - 1)
"""

OP13 = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang,
                     coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
groups AS (SELECT DISTINCT lang, source FROM docs),
terms AS (SELECT rid, lang, source, unnest(regexp_extract_all(
            translate(t, '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM terms GROUP BY ALL
         HAVING count(DISTINCT rid) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_sum FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM terms GROUP BY ALL),
grid AS (SELECT lang, source, term, lang_n, coalesce(n, 0) AS n
         FROM groups JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::hugeint * (n + 2))
           // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
         1 + (1000000000::hugeint * (lang_n + 2)) // (lang_sum + 2 * v) AS q
  FROM grid JOIN langs USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)
             AS r FROM rows)
SELECT lang, source, part, item, value::bigint AS value, r::integer AS rank
FROM ranked WHERE part = 'pair' OR r <= 10
"""

ORACLE = {"op8_decontamination": OP8, "op9_line_rules": OP9, "op12_prefix_trie": OP12,
          "op13_divergence": OP13}
