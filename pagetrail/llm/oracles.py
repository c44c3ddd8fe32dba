"""DuckDB SQL of the queries that SQL can express, over the same whole tables."""

from __future__ import annotations

from pagetrail.llm import licences

JACCARD_JOIN = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id,
         CASE WHEN len(w) >= 3 THEN list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))
              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM split),
classes AS (SELECT s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT rep, len(s) AS n, unnest(s) AS shingle FROM classes),
links AS (
  SELECT a.rep AS x, b.rep AS y FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.rep <> b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT rep, rep AS other FROM classes UNION SELECT reach.rep, links.y FROM reach JOIN links ON links.x = reach.other),
component AS (SELECT rep, min(other) AS component_id FROM reach GROUP BY rep),
degree AS (SELECT x AS rep, count(*) AS n_links FROM links GROUP BY x)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(n_links, 0) AS n_links
FROM sets LEFT JOIN classes ON classes.s = sets.s LEFT JOIN component USING (rep) LEFT JOIN degree USING (rep)"""


def _rendered(turns: str) -> str:
    return f"list_transform({turns}, lambda x: x.head || x.body || chr(10))"


def _mask(turns: str) -> str:
    before = f"coalesce(list_sum(list_transform({turns}[1:i - 1], lambda x: length(x.head) + length(x.body) + 1)), 0) + length({turns}[i].head)"
    span = f"CASE WHEN {turns}[i].learnt THEN CAST({before} AS BIGINT) || '-' || CAST({before} + length({turns}[i].body) AS BIGINT) END"
    return f"coalesce(array_to_string(list_filter(list_transform(range(1, len({turns}) + 1), lambda i: {span}), lambda s: s IS NOT NULL), ','), '')"


CHAT_FORMATTING = f"""
WITH conversation AS (
  SELECT conv_id, list({{'head': '<|im_start|>' || coalesce(role, 'user') || chr(10),
                        'body': replace(coalesce(text, ''), '<|', '<' || chr(8203) || '|') || '<|im_end|>',
                        'learnt': coalesce(role = 'assistant', false)}}
                       ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
spoken AS (SELECT *, list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].learnt)) AS last FROM conversation),
answer AS (SELECT conv_id, coalesce(lead(turns[last].body) OVER (ORDER BY conv_id), first(turns[last].body) OVER (ORDER BY conv_id)) AS reply
           FROM spoken WHERE last IS NOT NULL),
both_sides AS (
  SELECT conv_id AS pair_id, turns AS a,
         CASE WHEN last IS NULL THEN []
              ELSE turns[1:last - 1] || [{{'head': turns[last].head, 'body': reply, 'learnt': true}}] || turns[last + 1:] END AS b
  FROM spoken LEFT JOIN answer USING (conv_id)),
prefix AS (SELECT *, len(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[1:i] = b[1:i])) AS n FROM both_sides),
cut AS (SELECT pair_id, n, a[1:n] AS shared, a[n + 1:] AS a, b[n + 1:] AS b FROM prefix)
SELECT pair_id, coalesce(array_to_string({_rendered('shared')}, ''), '') AS prompt, CAST(n AS INTEGER) AS prompt_turns,
       coalesce(array_to_string({_rendered('a')}, ''), '') AS chosen, {_mask('a')} AS chosen_mask,
       coalesce(array_to_string({_rendered('b')}, ''), '') AS rejected, {_mask('b')} AS rejected_mask
FROM cut"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATES = ", ".join(
    f"({_quoted(name)}, [{', '.join(map(_quoted, licences.bigrams(text)))}])" for name, texts in sorted(licences.TEMPLATES.items()) for text in texts
)

LICENCE_SCAN = rf"""
WITH template(licence, b) AS (VALUES {_TEMPLATES}),
cut AS (SELECT doc_id, text, string_split_regex(text, '\r\n|\r|\n') AS lines,
               string_split_regex(text, '(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)\s*') AS paragraphs
        FROM documents WHERE text IS NOT NULL),
numbered AS (
  SELECT doc_id, 'line' AS unit, unnest(range(1, len(lines) + 1)) AS unit_no, unnest(lines) AS part FROM cut
  UNION ALL SELECT doc_id, 'paragraph', unnest(range(1, len(paragraphs) + 1)), unnest(paragraphs) FROM cut
  UNION ALL SELECT doc_id, 'text', 1, text FROM cut WHERE len(paragraphs) > 1),
worded AS (
  SELECT doc_id, unit, unit_no, regexp_extract_all(lower(part), '[\p{{L}}\p{{N}}]+') AS w
  FROM numbered WHERE unit <> 'paragraph' OR regexp_matches(part, '[\r\n]')),
units AS (
  SELECT doc_id, unit, unit_no, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS own
  FROM worded WHERE len(w) > 1),
scored AS (
  SELECT doc_id, unit, unit_no, licence, 2.0 * len(list_intersect(own, b)) / (len(own) + len(b)) AS dice
  FROM units JOIN template ON len(own) BETWEEN len(b) * 2 / 3.0 - 0.01 AND len(b) * 1.5 + 0.01)
SELECT doc_id, unit, CAST(unit_no AS INTEGER) AS unit_no, min(licence) AS licence, max(dice) AS dice
FROM (SELECT *, max(dice) OVER (PARTITION BY doc_id, unit, unit_no) AS top FROM scored WHERE dice >= 0.8) WHERE dice = top
GROUP BY doc_id, unit, unit_no"""

#: Payloads of 1,000 bytes or more refer to the largest id among equal ones.
WARC = """
WITH page AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
sized AS (SELECT page_id, payload, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes FROM page),
newest AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS last_id FROM sized)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to
FROM newest"""

ORACLES = {
    "op4_licence_scan": LICENCE_SCAN,
    "op6_chat_formatting": CHAT_FORMATTING,
    "op7_ngram_jaccard_join": JACCARD_JOIN,
    "op13_warc": WARC,
}
