"""DuckDB SQL that the registered queries must equal."""

from __future__ import annotations

_OP1 = r"""
WITH RECURSIVE split AS (
  SELECT doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                     lambda w: w <> '') AS words
  FROM documents
),
shingled AS (
  SELECT doc_id,
         list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN [words[1]]
                            ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS s
  FROM split
),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM shingled),
items AS (SELECT DISTINCT doc_id, unnest(s) AS x FROM shingled),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
           FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
          WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT DISTINCT a AS node, a AS seen FROM both_ways
          UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.seen),
least AS (SELECT node, min(seen) AS label FROM reach GROUP BY node)
SELECT s.doc_id, s.n AS n_shingles, coalesce(l.label, s.doc_id) AS component_id,
       s.doc_id = coalesce(l.label, s.doc_id) AS kept
FROM sizes s LEFT JOIN least l ON l.node = s.doc_id
"""

_OP7 = r"""
WITH flat AS (
  SELECT doc_id, row_number() OVER () AS nr,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS flat
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER same AS keep_id,
       count(*) OVER (PARTITION BY flat) AS group_size,
       row_number() OVER same = 1 AS kept,
       sha256(flat) AS text_sha256
FROM flat
WINDOW same AS (PARTITION BY flat ORDER BY doc_id NULLS LAST, nr)
"""

_OP9_CLASSES = (
    ("body", r"[\p{Ll} ]"),
    ("upper", r"[\p{Lu}\p{Lt}]"),
    ("symbol", r"[#*$%&|<>]"),
    ("digit", r"\p{Nd}"),
    ("stop", r"[.,]"),
    ("breaks", r"[\x09-\x0D]"),
    ("mark", r"\p{P}"),
)


def _op9() -> str:
    """Base counts by list functions, distances by joins of small distributions."""
    steps, left = [], "text"
    for name, pattern in _OP9_CLASSES:
        steps.append(f"length({left}) - length(regexp_replace({left}, '{pattern}', '', 'g')) AS {name}")
        left = f"regexp_replace({left}, '{pattern}', '', 'g')"
    steps.append(f"length({left}) AS other")
    names = [name for name, _ in _OP9_CLASSES] + ["other"]
    unpivot = ", ".join(names)
    js = "(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS nr, doc_id, lang, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT nr, doc_id, lang, text,
         list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
),
windows AS (
  SELECT nr, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT nr, words, unnest(range(1, len(words) - 1)) AS i FROM split)
),
starts AS (SELECT nr, i FROM windows QUALIFY count(*) OVER (PARTITION BY nr, a, b, c) > 1),
repeats AS (
  SELECT nr, count(DISTINCT i + d) AS n FROM starts CROSS JOIN (VALUES (0), (1), (2)) AS v(d) GROUP BY nr
),
chars AS (SELECT nr, lang, {', '.join(steps)} FROM docs),
long_chars AS (SELECT nr, lang, class, n FROM chars UNPIVOT (n FOR class IN ({unpivot}))),
all_words AS (SELECT nr, lang, unnest(words) AS word FROM split),
langs AS (
  SELECT lang, count(*) AS total FROM all_words WHERE lang IS NOT NULL GROUP BY lang HAVING count(*) >= 2000
  UNION ALL SELECT NULL, count(*) FROM all_words
),
ref_chars AS (
  SELECT l.lang, c.class, sum(c.n) / sum(sum(c.n)) OVER (PARTITION BY l.lang) AS q
  FROM langs l JOIN long_chars c ON l.lang IS NULL OR l.lang = c.lang GROUP BY l.lang, c.class
),
ref_counts AS (
  SELECT l.lang, w.word, count(*) AS n, any_value(l.total) AS total
  FROM langs l JOIN all_words w ON l.lang IS NULL OR l.lang = w.lang
  WHERE length(w.word) <= 6 GROUP BY l.lang, w.word
),
ref_words AS (
  SELECT lang, word, n / total AS q FROM ref_counts
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 32
),
own AS (
  SELECT s.nr, l.lang AS ref, len(s.words) AS n_words, length(s.text) AS n_chars
  FROM split s LEFT JOIN langs l ON l.lang = s.lang
),
class_distance AS (
  SELECT o.nr, sqrt(greatest(0, sum({js}))) AS d
  FROM (SELECT o.nr, c.n / o.n_chars AS p, r.q
        FROM own o JOIN long_chars c USING (nr)
        JOIN ref_chars r ON r.lang IS NOT DISTINCT FROM o.ref AND r.class = c.class WHERE o.n_words >= 50) o
  GROUP BY o.nr
),
hits AS (SELECT nr, word, count(*) AS n FROM all_words WHERE length(word) <= 6 GROUP BY nr, word),
bins AS (
  SELECT o.nr, coalesce(h.n, 0) / o.n_words AS p, r.q
  FROM own o JOIN ref_words r ON r.lang IS NOT DISTINCT FROM o.ref
  LEFT JOIN hits h ON h.nr = o.nr AND h.word = r.word WHERE o.n_words >= 50
),
with_rest AS (
  SELECT nr, p, q FROM bins UNION ALL SELECT nr, 1 - sum(p), 1 - sum(q) FROM bins GROUP BY nr
),
word_distance AS (SELECT nr, sqrt(greatest(0, sum({js}))) AS d FROM with_rest GROUP BY nr),
counted AS (
  SELECT s.doc_id, CAST(len(s.words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(s.words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(length(s.text) - length(regexp_replace(s.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(s.lines) - len(list_distinct(s.lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         c.d AS class_distance, w.d AS word_distance
  FROM split s LEFT JOIN repeats r USING (nr) LEFT JOIN class_distance c USING (nr) LEFT JOIN word_distance w USING (nr)
),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance,
       NOT base_failed
       AND coalesce(class_distance, 0) <= 0.28 + 2.0 / greatest(n_words, 1)
       AND coalesce(word_distance, 0) <= 0.42 + 2.0 / greatest(n_words, 1) AS kept
FROM based
"""


_OP5 = r"""
WITH cut AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
),
rules(verdict, rule) AS (
  VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'), ('allow', 'com/fr/'), ('block', 'com/de/')
),
ruled AS (
  SELECT page_id, host, path,
         (SELECT max_by(struct_pack(rule := r.rule, verdict := r.verdict), length(r.rule)) FROM rules r
          WHERE (host = split_part(r.rule, '/', 1) OR ends_with(host, '.' || split_part(r.rule, '/', 1)))
            AND starts_with(path, substr(r.rule, strpos(r.rule, '/')))) AS found,
         list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s:
           CASE WHEN regexp_matches(s, '[0-9]') AND (length(s) >= 16 OR regexp_matches(s, '[0-9][^0-9]+[0-9]+[^0-9]+[0-9]'))
                THEN '*' ELSE regexp_replace(s, '[0-9]+', '0', 'g') END) AS shaped
  FROM parts
),
pages_of AS (
  SELECT page_id, host, path, found.rule AS rule, found.verdict AS verdict, shaped AS segments
  FROM ruled
),
paths AS (
  SELECT host, segments, count(*) AS pages, count(verdict) AS n,
         count(*) FILTER (WHERE verdict = 'block') AS blocked
  FROM pages_of GROUP BY host, segments
),
levels AS (
  SELECT host, segments, pages, level, segments[1:level - 1] AS above, segments[level] AS segment
  FROM (SELECT *, unnest(range(1, len(segments) + 1)) AS level FROM paths)
),
wild AS (
  SELECT host, level, above FROM
    (SELECT host, level, above, segment, sum(pages) AS pages FROM levels GROUP BY host, level, above, segment)
  GROUP BY host, level, above HAVING count(*) > 20 AND sum(pages) < 3.0 * count(*)
),
shown AS (
  SELECT l.host, l.segments, list(CASE WHEN w.host IS NOT NULL THEN '*' ELSE l.segment END ORDER BY l.level) AS template
  FROM levels l LEFT JOIN wild w ON w.host = l.host AND w.level = l.level AND w.above = l.above
  GROUP BY l.host, l.segments
),
named AS (
  SELECT p.host, p.segments, coalesce(s.template, []) AS template, p.n, p.blocked
  FROM paths p LEFT JOIN shown s ON s.host = p.host AND s.segments = p.segments
),
own AS (
  SELECT host, template, template[1:len(template) - 1] AS above, sum(n) AS n, sum(blocked) AS blocked
  FROM named GROUP BY host, template
),
nodes AS (SELECT *, sum(n) OVER w AS node_n, sum(blocked) OVER w AS node_b FROM own WINDOW w AS (PARTITION BY host, above)),
compared AS (
  SELECT *, coalesce(abs(blocked / nullif(n, 0) - node_b / nullif(node_n, 0))
                     <= 1.96 * sqrt((node_b / node_n) * (1 - node_b / node_n) / nullif(n, 0)), true) AS alike
  FROM nodes
),
merged AS (
  SELECT host, template, n, blocked,
         CASE WHEN alike THEN sum(n) FILTER (WHERE alike) OVER w ELSE n END AS m_n,
         CASE WHEN alike THEN sum(blocked) FILTER (WHERE alike) OVER w ELSE blocked END AS m_b
  FROM compared WINDOW w AS (PARTITION BY host, above)
),
everywhere AS (SELECT template, sum(n) AS n, sum(blocked) AS b FROM merged GROUP BY template),
overall AS (SELECT (coalesce(sum(blocked), 0) + 1) / (coalesce(sum(n), 0) + 2) AS share FROM merged),
shares AS (
  SELECT m.host, m.template, (m.m_b + 4.0 * ((e.b + 4.0 * o.share) / (e.n + 4.0))) / (m.m_n + 4.0) AS share
  FROM merged m JOIN everywhere e USING (template) CROSS JOIN overall o
)
SELECT p.page_id, p.host, p.path, p.rule, '/' || array_to_string(n.template, '/') AS template,
       round(s.share, 6) AS share,
       coalesce(p.verdict, CASE WHEN s.share >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM pages_of p JOIN named n ON n.host = p.host AND n.segments = p.segments
JOIN shares s ON s.host = n.host AND s.template = n.template
"""


_OP11 = r"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
measured AS (
  SELECT *, length('<|im_start|><|im_sep|><|im_end|>') + length(role) + length(text)
            + len(regexp_extract_all(role, '[<\[]\\*(\||/?s>|/?INST\])'))
            + len(regexp_extract_all(text, '[<\[]\\*(\||/?s>|/?INST\])')) AS long
  FROM told
),
placed AS (
  SELECT *, row_number() OVER in_order AS nr, count(*) OVER (PARTITION BY conv_id) AS turns, sum(long) OVER in_order AS so_far
  FROM measured
  WINDOW in_order AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nr)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nr) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(so_far) FILTER (WHERE role = 'assistant' OR nr = turns) AS BIGINT) AS formatted_chars,
       count(*) FILTER (WHERE role = 'assistant' OR nr = turns) AS n_examples
FROM placed GROUP BY conv_id
"""

_OP13 = r"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS nr,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda c: coalesce(isfinite(c), false))), true)
),
pairs AS (
  SELECT a.nr AS anchor, a.vec_id AS anchor_id, b.nr, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.nr <> b.nr
),
positives AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id NULLS LAST, nr) <= 5
),
negatives AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.nr ORDER BY n.score DESC, n.id NULLS LAST, n.nr) AS place
  FROM positives p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same
   AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= 3
"""


def statements() -> dict[str, str]:
    return {
        "op1_near_dedup": _OP1,
        "op5_url_filter": _OP5,
        "op7_exact_dedup": _OP7,
        "op9_quality_rules": _op9(),
        "op11_chat_examples": _OP11,
        "op13_hard_negatives": _OP13,
    }
