"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from reviewlab.llm import chunks, credentials, decontaminate, phrases, quality, urls
from reviewlab.llm.common import A_TO_Z

RULE_SCORES = {
    "symbols": "least(100 * n_symbols // greatest(n_words, 1), 100)",
    "capitals": "least(100 * n_capitals // greatest(word_chars, 1), 100)",
    "dup_lines": "least(100 * n_dup_lines // greatest(n_lines, 1), 100)",
    "repeats": "least(100 * n_repeat_words // greatest(n_words, 1), 100)",
}

OP5 = f"""
WITH split AS (
  SELECT doc_id, lang, coalesce(text, '') AS body,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i : i + 7], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM split)
), doubled AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM doubled) GROUP BY doc_id
), features AS (
  SELECT s.doc_id, lang,
    CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(body, '[^A-ZÀ-ÖØ-Þ]+', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN covered c USING (doc_id)
), known AS (
  SELECT doc_id, min(quality) > 0 AS good FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), scored AS (
  {" UNION ALL ".join(
      f"SELECT doc_id, lang AS stratum, '{r}' AS rule, CAST({s} AS INT) AS score FROM features"
      for r, s in RULE_SCORES.items())}
), counts AS (
  SELECT stratum, rule, score, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad
  FROM scored JOIN known USING (doc_id) GROUP BY ALL
), tried AS (
  SELECT stratum, rule, score AS cutoff,
    CAST(sum(good) OVER (PARTITION BY stratum, rule) AS BIGINT) AS n,
    CAST(sum(good) OVER up AS BIGINT) AS k, CAST(sum(bad) OVER up AS BIGINT) AS caught
  FROM counts WINDOW up AS (PARTITION BY stratum, rule ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
), bounded AS (
  SELECT *, list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END
        - lgamma(n - i + 1) + i * ln({quality.RISK / 4}) + (n - i) * ln(1 - {quality.RISK / 4})))) AS cdf
  FROM tried WHERE cutoff > 0 AND n > 0 AND k <= {quality.RISK / 4} * n
), chosen AS (
  SELECT stratum, rule, cutoff FROM bounded
  WHERE cdf <= {quality.LEVEL} / (4 * 100 * (SELECT count(DISTINCT coalesce(stratum, '')) FROM counts))
    AND caught - {quality.PRICE} * k > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule
    ORDER BY caught - {quality.PRICE} * k DESC, cutoff DESC) = 1
), rejected AS (
  SELECT DISTINCT s.doc_id FROM scored s JOIN chosen c
    ON s.stratum IS NOT DISTINCT FROM c.stratum AND s.rule = c.rule AND s.score >= c.cutoff
)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND r.doc_id IS NULL AS kept
FROM features f LEFT JOIN rejected r USING (doc_id)
"""


def tree_levels() -> str:
    """One pair of tables per level of the path tree, and the finished tree."""
    parts = []
    for level in range(urls.DEPTH):
        here = f"t{level}"
        parts.append(f"""
b{level} AS (
  SELECT host, template, segment,
    n >= {urls.MIN_URLS} AND n * 100 >= sum(n) OVER p * {urls.MIN_PERCENT}
    AND (bad * (sum(labelled) OVER p - labelled) - (sum(bad) OVER p - bad) * labelled)
      * (bad * (sum(labelled) OVER p - labelled) - (sum(bad) OVER p - bad) * labelled)
      * sum(labelled) OVER p
      > {urls.Z_SQUARE}::DOUBLE * labelled * (sum(labelled) OVER p - labelled) * sum(bad) OVER p
        * (sum(labelled) OVER p - sum(bad) OVER p) AS literal
  FROM (SELECT host, template, segments[{level + 1}] AS segment, sum(n)::DOUBLE AS n,
      sum(labelled)::DOUBLE AS labelled, sum(bad)::DOUBLE AS bad
    FROM {here} WHERE len(segments) > {level} GROUP BY ALL)
  WINDOW p AS (PARTITION BY host, template)
), t{level + 1} AS (
  SELECT a.host, shape, segments, n, labelled, bad, CASE WHEN len(segments) > {level}
    THEN a.template || '/' || CASE WHEN literal THEN segment ELSE '*' END
    ELSE a.template END AS template
  FROM {here} a LEFT JOIN b{level} b
    ON a.host = b.host AND a.template = b.template AND segments[{level + 1}] = segment
)""")
    return ",".join(parts)


def rule_cases(result: str) -> str:
    """The longest fitting rule: 'name' or 'verdict'."""
    ordered = sorted(urls.RULES, key=lambda r: (len(r[1] + r[2]), r), reverse=True)
    cases = " ".join(
        f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') "
        f"THEN '{host + path if result == 'name' else said}'"
        for said, host, path in ordered
    )
    return f"CASE {cases} END"


OP1 = f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{urls.PARTS}', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '{urls.PARTS}', 2) AS path
  FROM pages
), shaped AS (
  SELECT *, regexp_replace(array_to_string(list_filter(string_split(path, '/'),
      lambda s: s <> ''), '/'), '[0-9]+', '#', 'g') AS shape,
    try_cast(regexp_extract(path, '([0-9]{{1,18}})(?:\\.[a-z]+)?/?$', 1) AS BIGINT) AS doc_id,
    {rule_cases("name")} AS rule, {rule_cases("verdict")} AS said
  FROM parts
), known AS (
  SELECT page_id, max(quality = 0 OR toxic = 1) AS bad
  FROM shaped JOIN labels USING (doc_id) WHERE page_id IS NOT NULL GROUP BY page_id
), t0 AS (
  SELECT host, shape, list_filter(string_split(shape, '/'), lambda s: s <> '') AS segments,
    count(*) AS n, count(bad) AS labelled, count(*) FILTER (bad) AS bad, '' AS template
  FROM shaped LEFT JOIN known USING (page_id) GROUP BY host, shape
),{tree_levels()}, tree AS (
  SELECT * REPLACE (template || CASE WHEN len(segments) > {urls.DEPTH} THEN '/**' ELSE '' END
    AS template) FROM t{urls.DEPTH}
), overall AS (
  SELECT sum(bad)::DOUBLE / greatest(sum(labelled)::DOUBLE, 1) AS share FROM tree
), hosts AS (
  SELECT host, sum(labelled)::DOUBLE AS labelled, sum(bad)::DOUBLE AS bad FROM tree GROUP BY host
), templates AS (
  SELECT host, template, sum(labelled)::DOUBLE AS labelled, sum(bad)::DOUBLE AS bad
  FROM tree GROUP BY host, template
), judged AS (
  SELECT t.host, template, t.labelled::BIGINT AS n_labels, round((t.bad + {urls.SMOOTHING}::DOUBLE *
      ((h.bad + {urls.SMOOTHING}::DOUBLE * share) / (h.labelled + {urls.SMOOTHING}::DOUBLE)))
      / (t.labelled + {urls.SMOOTHING}::DOUBLE), 6) AS purity
  FROM templates t JOIN hosts h USING (host), overall
)
SELECT page_id, s.host, path, rule,
  coalesce(said, CASE WHEN n_labels >= {urls.MIN_LABELS}
    AND purity >= {urls.MIN_PURITY} THEN 'block' ELSE 'allow' END) AS verdict,
  t.template, n_labels, purity
FROM shaped s JOIN tree t ON s.host = t.host AND s.shape = t.shape
JOIN judged j ON t.host = j.host AND t.template = j.template
"""

OP3 = f"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM lines
), rolled AS (
  SELECT *, (h + {chunks.WEIGHT} * coalesce(lag(h) OVER d, 0)) % {chunks.DIVISOR} AS r
  FROM hashed WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), cut AS (
  SELECT *, r = 0 AND coalesce(lag(r) OVER d, 1) <> 0 OR length(line) >= {chunks.LONG_LINE}
    OR coalesce(length(lead(line) OVER d) >= {chunks.LONG_LINE}, false) AS ends
  FROM rolled WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM cut
), bodies AS (
  SELECT doc_id, chunk, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body
  FROM numbered GROUP BY doc_id, chunk
), judged AS (
  SELECT *, n = 1 AND length(body) < {chunks.LONG_LINE} OR NOT regexp_matches(body, '[^\x20\x09-\x0D]') OR
    row_number() OVER (PARTITION BY body ORDER BY doc_id, chunk) = 1 AS stays FROM bodies
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN
    coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (stays), '') END AS text,
  coalesce(sum(n), 0)::BIGINT AS n_lines,
  coalesce(sum(n) FILTER (NOT stays), 0)::BIGINT AS n_removed_lines,
  count(j.chunk) AS n_chunks, count(*) FILTER (NOT stays) AS n_removed_chunks
FROM documents d LEFT JOIN judged j USING (doc_id) GROUP BY d.doc_id, d.text
"""


def matches_of(kind: str, pattern: str) -> str:
    """Rows (doc_id, kind, start, finish, match) of one pattern."""
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, '{kind}' AS kind, match,
    sum(length(piece) + length(match)) OVER d - length(match) AS start,
    sum(length(piece) + length(match)) OVER d AS finish
  FROM (SELECT doc_id, unnest(m) AS match, unnest(p[1:len(m)]) AS piece,
      generate_subscripts(m, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(body, '{quoted}') AS m,
        regexp_split_to_array(body, '{quoted}') AS p FROM bodies))
  WINDOW d AS (PARTITION BY doc_id ORDER BY i)"""


ASSIGNED = credentials.ASSIGN.replace("'", "''")

OP4 = f"""
WITH bodies AS (
  SELECT doc_id, coalesce(text, '') AS body, coalesce(source, '') AS owner FROM documents
), base AS (
  SELECT * FROM ({matches_of("assign", credentials.ASSIGN)})
  WHERE length(regexp_extract(match, '{ASSIGNED}', 2)) >= {credentials.MIN_ASSIGNED}
  UNION ALL {matches_of("access", credentials.ACCESS)}
  UNION ALL {matches_of("hex", credentials.HEX)}
), opaque AS (
  SELECT * FROM ({matches_of("opaque", credentials.OPAQUE)}) o
  WHERE regexp_matches(match, '[0-9]') AND regexp_matches(match, '[A-Za-z]') AND NOT EXISTS (
    SELECT 1 FROM base b WHERE b.doc_id = o.doc_id AND b.start < o.finish AND o.start < b.finish)
), candidates AS (
  SELECT f.*, owner, CASE WHEN kind = 'assign' THEN regexp_extract(match, '{ASSIGNED}', 2)
    ELSE match END AS value
  FROM (SELECT * FROM base UNION ALL SELECT * FROM opaque) f JOIN bodies USING (doc_id)
), spread AS (
  SELECT value, count(DISTINCT owner) <= {credentials.MAX_OWNERS} AS live
  FROM candidates GROUP BY value
), judged AS (
  SELECT c.*, live, kind || ':' || start::BIGINT || ':' || finish::BIGINT AS name,
    CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 WHEN 'hex' THEN 2 ELSE 3 END AS place
  FROM candidates c JOIN spread USING (value)
)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
  count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(name, ',' ORDER BY start, place) FILTER (kind <> 'opaque'), ''))
    AS base_sha256,
  coalesce(string_agg(name, ',' ORDER BY start, place) FILTER (kind <> 'opaque' OR live), '')
    AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example
FROM documents d LEFT JOIN judged j USING (doc_id) GROUP BY d.doc_id
"""

OP6 = """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 2], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM split
    WHERE len(words) > 0)
), sizes AS (
  SELECT d.doc_id, count(s) AS n FROM documents d LEFT JOIN shingles USING (doc_id)
  GROUP BY d.doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id, doc_id AS to_id FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.to_id = links.a
)
SELECT doc_id, any_value(n) AS n_shingles, min(to_id) AS component_id,
  doc_id = min(to_id) AS kept
FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id
"""

# The test pages mark their article, whose blocks are h1 and p; entities are the five of XML.
OP8 = """
WITH blocks AS (
  SELECT page_id, url, regexp_split_to_array(regexp_replace(
      regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1),
      '<br>', ' ', 'g'), '</?(?:p|h1)>') AS parts
  FROM pages
), plain AS (
  SELECT page_id, url, list_filter(list_transform(parts, lambda b: trim(regexp_replace(
      replace(replace(replace(replace(replace(replace(regexp_replace(b, '<[^>]*>', '', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&#39;', chr(39)),
        '&amp;', '&'), '\\s+', ' ', 'g'))), lambda b: b <> '') AS texts
  FROM blocks
)
SELECT page_id, url, array_to_string(texts, chr(10) || chr(10)) AS text,
  length(array_to_string(texts, chr(10) || chr(10)))::BIGINT AS n_chars
FROM plain
"""


def sql_terms(text: str) -> str:
    """A text's words in lower case without punctuation."""
    return (
        f"list_filter(list_transform(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), "
        "lambda w: regexp_replace(lower(w), '[^\\p{L}\\p{N}_]+', '', 'g')), lambda w: w <> '')"
    )


OP10 = f"""
WITH sentences AS (
  SELECT item_id, list_filter(string_split(regexp_replace(trim(text), '([.!?])\\s+',
      '\\1' || chr(1), 'g'), chr(1)), lambda s: regexp_matches(s, '[\\p{{L}}\\p{{N}}_]')) AS s
  FROM benchmark WHERE text IS NOT NULL
), halves AS (
  SELECT item_id, 'question' AS half,
    {sql_terms("array_to_string(CASE WHEN len(s) > 1 THEN s[:-2] ELSE s END, ' ')")} AS w
  FROM sentences WHERE len(s) > 0
  UNION ALL SELECT item_id, 'answer', {sql_terms("s[-1]")} FROM sentences WHERE len(s) > 0
), wanted AS (
  SELECT DISTINCT item_id, half, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i
    FROM (SELECT *, least({decontaminate.GRAM}, len(w)) AS n FROM halves))
), totals AS (
  SELECT item_id, half, count(*) AS total FROM wanted GROUP BY ALL
), words AS (
  SELECT doc_id, {sql_terms("coalesce(text, '')")} AS w FROM documents
), held AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + n - 1], ' ') AS gram, n
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM words, range(1, {decontaminate.GRAM} + 1) AS g(n))
), found AS (
  SELECT doc_id, item_id, half FROM held JOIN wanted USING (gram, n) JOIN totals USING (item_id, half)
  GROUP BY doc_id, item_id, half, total HAVING count(*) >= {decontaminate.MIN_OVERLAP} * total
)
SELECT doc_id, item_id FROM found GROUP BY ALL HAVING count(*) = 2
"""

OP11 = f"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, list_filter(string_split_regex(p, '[ \\t]+'), lambda x: x <> '') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(string_split_regex(translate(coalesce(text, ''), '{A_TO_Z}', '{A_TO_Z.lower()}'),
        '[.,;:!?\\x0A-\\x0D]')) AS p
    FROM documents)
), ones AS (
  SELECT lang, w, count(*) AS f FROM (SELECT lang, unnest(w) AS w FROM pieces) GROUP BY ALL
), sizes AS (
  SELECT lang, sum(f) AS n FROM ones GROUP BY ALL
), twos AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM pieces) GROUP BY ALL
), threes AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM pieces) GROUP BY ALL
  HAVING count(*) >= {phrases.LEAST}
), pairs AS (
  SELECT t.lang, w1 || ' ' || w2 AS phrase, w1, w2, t.f AS a, x.f AS l, y.f AS r,
    ({phrases.UNIT}::HUGEINT * t.f * t.f) // (x.f::HUGEINT * y.f) AS score
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.w = w1 JOIN ones y ON y.lang = t.lang AND y.w = w2
  WHERE t.f >= {phrases.LEAST}
), cuts AS (
  SELECT t.lang, t.w1, t.w2, t.w3, t.f AS a,
    x.f AS l1, yz.f AS r1, ({phrases.UNIT}::HUGEINT * t.f * t.f) // (x.f::HUGEINT * yz.f) AS s1,
    xy.f AS l2, z.f AS r2, ({phrases.UNIT}::HUGEINT * t.f * t.f) // (xy.f::HUGEINT * z.f) AS s2
  FROM threes t
  JOIN ones x ON x.lang = t.lang AND x.w = t.w1
  JOIN ones z ON z.lang = t.lang AND z.w = t.w3
  JOIN twos xy ON xy.lang = t.lang AND xy.w1 = t.w1 AND xy.w2 = t.w2
  JOIN twos yz ON yz.lang = t.lang AND yz.w1 = t.w2 AND yz.w2 = t.w3
), inside AS (
  SELECT lang, w1, w2, max(f) AS most FROM (
    SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2, w3, f FROM threes) GROUP BY ALL
), candidates AS (
  SELECT lang, phrase, a, l, r, score FROM pairs LEFT JOIN inside USING (lang, w1, w2)
  WHERE most IS NULL OR 100 * most < {phrases.ABSORBED} * a
  UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3, a,
    CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
  FROM cuts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM candidates
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= {phrases.KEEP}
"""

ORACLE = {
    "op1_path_templates": OP1,
    "op3_line_chunks": OP3,
    "op4_secret_owners": OP4,
    "op5_risk_thresholds": OP5,
    "op6_setsketch": OP6,
    "op8_wrapper_induction": OP8,
    "op10_bm25_wand": OP10,
    "op11_phrase_growth": OP11,
}
