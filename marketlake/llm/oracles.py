"""DuckDB twins of the queries that SQL can express.

Those of op2 and op6 compare all pairs, for the sizes at which they are run.  Not here: op1 (mutual
information over rewritten texts), op5 (a tokenizer), op9 (a fitted model) and the pipeline; tests compare them
with brute force.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_MIX = rf"""
WITH docs AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '{_WORD}')), 0) AS BIGINT) AS size FROM documents
), per_source AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
         (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM docs GROUP BY source
), shares AS (
  SELECT a.source, a.source_size, a.weight,
         (SELECT SUM(source_size) FROM per_source)
           - COALESCE(SUM(3 * a.source_size) OVER (ORDER BY a.source_size / a.weight, a.source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         SUM(a.weight) OVER (ORDER BY a.source_size / a.weight, a.source NULLS LAST
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight
  FROM per_source a
), stopped AS (
  SELECT *, left_over * weight > 3 * source_size * left_weight AS stops FROM shares
), free AS (
  SELECT (SELECT SUM(source_size) FROM per_source) - COALESCE(SUM(3 * source_size) FILTER (WHERE stops), 0) AS words,
         SUM(weight) FILTER (WHERE NOT stops) AS weights
  FROM stopped
), targets AS (
  SELECT source, source_size,
         CASE WHEN stops THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(words AS DOUBLE) * CAST(weight AS DOUBLE) / CAST(weights AS DOUBLE) END AS target
  FROM stopped, free
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         SUM(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix-1:' || COALESCE(CAST(d.doc_id AS VARCHAR), '')), d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), budgets AS (
  SELECT *, CAST(FLOOR(target) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(FLOOR(target) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM placed
)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + GREATEST(0, LEAST(size, budget - epochs * source_size - start)) AS BIGINT) AS taken
FROM budgets
"""

_LINES = r"""
WITH texts AS (
  SELECT page_id, CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1) <> ''
                       THEN lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1)) END AS host,
         regexp_replace(regexp_replace(html,
           '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->', chr(10), 'g'),
           '\s*<[^>]*>\s*', chr(10), 'g') AS text
  FROM pages
), numbered AS (SELECT *, ROW_NUMBER() OVER () AS page FROM texts
), lines AS (
  SELECT page, host, raw, no, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line
  FROM (SELECT page, host, unnest(string_split(COALESCE(text, ''), chr(10))) AS raw,
               generate_subscripts(string_split(COALESCE(text, ''), chr(10)), 1) AS no FROM numbered)
), totals AS (SELECT host, COUNT(*) AS pages FROM numbered GROUP BY host
), often AS (
  SELECT l.host, l.line FROM (SELECT host, line, COUNT(DISTINCT page) AS n FROM lines WHERE line <> '' GROUP BY ALL) l
  JOIN totals t ON l.host IS NOT DISTINCT FROM t.host WHERE n >= 3 AND n > CAST(0.2 AS DOUBLE) * pages
), marked AS (
  SELECT l.*, o.line IS NOT NULL AS gone FROM lines l
  LEFT JOIN often o ON l.line = o.line AND l.host IS NOT DISTINCT FROM o.host
)
SELECT n.page_id, n.host, c.n_lines, c.n_dropped,
       CASE WHEN n.text IS NOT NULL THEN sha256(COALESCE(c.kept, '')) END AS kept_sha256
FROM numbered n JOIN (
  SELECT page, COUNT(*) FILTER (WHERE line <> '') AS n_lines, COUNT(*) FILTER (WHERE gone) AS n_dropped,
         string_agg(raw, chr(10) ORDER BY no) FILTER (WHERE NOT gone) AS kept
  FROM marked GROUP BY page) c USING (page)
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_QUALITY = rf"""
WITH docs AS (
  SELECT ROW_NUMBER() OVER () AS r, doc_id, source, COALESCE(text, '') AS text,
         regexp_extract_all(COALESCE(text, ''), '{_WORD}') AS ws FROM documents
), lines AS (
  SELECT r, source, array_to_string(ws, ' ') AS content, unnest(string_split(text, chr(10))) AS line FROM docs
), filled AS (
  SELECT *, len(regexp_extract_all(line, '{_WORD}')) AS n,
         array_to_string(regexp_extract_all(lower(line), '{_WORD}'), ' ') AS key
  FROM lines WHERE regexp_matches(line, '{_WORD}')
), hosts AS (SELECT source, COUNT(DISTINCT array_to_string(ws, ' ')) AS docs FROM docs GROUP BY source
), over AS (
  SELECT f.source, f.key FROM (SELECT source, key, COUNT(DISTINCT content) AS n FROM filled GROUP BY ALL) f
  JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source
  WHERE f.n >= 20 AND f.n > CAST(0.2 AS DOUBLE) * h.docs
), by_line AS (
  SELECT r, COUNT(*) - COUNT(DISTINCT line) AS n_dup_lines, COALESCE(SUM(n) FILTER (WHERE over.key IS NOT NULL), 0) AS gone
  FROM filled LEFT JOIN over ON filled.key = over.key AND filled.source IS NOT DISTINCT FROM over.source GROUP BY r
), windows AS (
  SELECT r, unnest(range(1, len(ws) - 1)) AS p, unnest([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)]) AS three
  FROM docs
), twice AS (SELECT r, p FROM (SELECT *, COUNT(*) OVER (PARTITION BY r, three) AS n FROM windows) WHERE n > 1
), covered AS (SELECT r, COUNT(DISTINCT p + d) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY r
), base AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(COALESCE(list_sum([length(w) FOR w IN ws]), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(COALESCE(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(COALESCE(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(COALESCE(gone, 0) AS BIGINT) AS n_line_words
  FROM docs LEFT JOIN by_line USING (r) LEFT JOIN covered c USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND n_words - n_line_words >= CAST(0.3 AS DOUBLE) * n_words AS kept
FROM base
"""

_JACCARD = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), {_AZ}), '{_WORD}') AS ws FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(list_slice(ws, i, i + 4), ' ') FOR i IN range(1, len(ws) - 3)]
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
  FROM docs
), sizes AS (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS n FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common c JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c.n >= 75 * (a.n + b.n - c.n)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(doc_id, other) AS (
  SELECT DISTINCT x, x FROM both_ways UNION SELECT reach.doc_id, y FROM reach JOIN both_ways ON x = other
)
SELECT d.doc_id, COALESCE(n, 0) AS n_shingles, COALESCE(least, d.doc_id) AS component_id
FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT doc_id, MIN(other) AS least FROM reach GROUP BY doc_id) USING (doc_id)
"""

_SUBSTRING = rf"""
WITH docs AS (
  SELECT ROW_NUMBER() OVER () AS r, doc_id, regexp_extract_all(COALESCE(text, ''), '{_WORD}') AS ws FROM documents
), windows AS (
  SELECT r, doc_id, unnest(range(1, len(ws) - 18)) AS s,
         unnest([array_to_string(list_slice(ws, i, i + 19), ' ') FOR i IN range(1, len(ws) - 18)]) AS text
  FROM docs
), later AS (SELECT r, s FROM (SELECT r, s, RANK() OVER (PARTITION BY text ORDER BY doc_id, s) AS no FROM windows) WHERE no > 1
), gone AS (SELECT DISTINCT r, unnest(range(s, s + 20)) AS p FROM later
), placed AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM docs
), rest AS (
  SELECT r, COUNT(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY placed.p) FILTER (WHERE gone.p IS NULL) AS kept
  FROM placed LEFT JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, COALESCE(n_removed, 0) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256
FROM docs LEFT JOIN rest USING (r)
"""


def _license() -> str:
    from .license_scan import PHRASES, TEMPLATES

    templates = ", ".join(f"({n}, '{label}', {sorted(set(text.split()))!r})" for n, (label, text) in enumerate(TEMPLATES))
    hits = " UNION ALL ".join(
        f"SELECT r, i - 1 AS place, '{label}' AS label FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM docs) "
        f"WHERE list_slice(ws, i, i + {len(p.split()) - 1}) = {p.split()!r}" for p, label in PHRASES)
    token = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH docs AS (
  SELECT ROW_NUMBER() OVER () AS r, doc_id, COALESCE(text, '') AS text,
         regexp_extract_all(translate(COALESCE(text, ''), {_AZ}), '{token}') AS ws FROM documents
), hits AS ({hits}
), base AS (SELECT r, COUNT(*) AS n, MIN(place) AS first_word, MAX(place) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM hits GROUP BY r
), templates(no, label, words) AS (VALUES {templates}
), lines AS (
  SELECT r, ROW_NUMBER() OVER () AS line, regexp_extract_all(translate(x, {_AZ}), '{token}') AS ws
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM docs)
), matched AS (
  SELECT r, label, len(list_intersect(ws, words)) / CAST(len(words) AS DOUBLE) AS score,
         len(words) = MAX(len(words)) OVER (PARTITION BY line) AS longest
  FROM lines, templates WHERE len(list_intersect(ws, words)) >= ceil(0.9 * len(words))
), method AS (SELECT r, MAX(score) AS score, list(DISTINCT label) FILTER (WHERE longest) AS labels FROM matched GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, COALESCE(b.n, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, COALESCE(array_to_string(b.labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(COALESCE(b.labels, []), COALESCE(m.labels, [])))), ',') AS labels,
       CASE WHEN b.n > 0 THEN CAST(1 AS DOUBLE) ELSE COALESCE(m.score, CAST(0 AS DOUBLE)) END AS score
FROM docs LEFT JOIN base b USING (r) LEFT JOIN method m USING (r)
"""


_NEAR = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding]) AND list_bool_or([x <> 0 FOR x IN embedding])
), pairs AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id < b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), both_ways AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs
), reach(vec_id, other) AS (SELECT DISTINCT x, x FROM both_ways UNION SELECT reach.vec_id, y FROM reach JOIN both_ways ON x = other
)
SELECT v.vec_id, COALESCE(l.n, 0) AS n_links, COALESCE(c.least, v.vec_id) AS component_id,
       COALESCE(c.least, v.vec_id) = v.vec_id AS kept
FROM embeddings v LEFT JOIN (SELECT x, COUNT(*) AS n FROM both_ways GROUP BY x) l ON v.vec_id = l.x
LEFT JOIN (SELECT vec_id, MIN(other) AS least FROM reach GROUP BY vec_id) c ON v.vec_id = c.vec_id
"""


_SEARCH = rf"""
WITH docs AS (
  SELECT ROW_NUMBER() OVER () AS r, doc_id, regexp_extract_all(translate(COALESCE(text, ''), {_AZ}), '{_TERM}') AS ws FROM documents
), totals AS (SELECT COUNT(*) AS n, CAST(SUM(len(ws)) AS BIGINT) AS l FROM docs WHERE len(ws) > 0
), items AS (SELECT ROW_NUMBER() OVER () AS q, item_id, regexp_extract_all(translate(COALESCE(text, ''), {_AZ}), '{_TERM}') AS ws FROM benchmark
), asked AS (SELECT DISTINCT q, item_id, unnest(ws) AS term FROM items
), occurrences AS (
  SELECT r, term, COUNT(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM docs) SEMI JOIN asked USING (term) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, COUNT(*) AS df FROM occurrences GROUP BY term), totals
), scored AS (
  SELECT q, item_id, doc_id, r, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(ws) * n) // l)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN occurrences USING (term) JOIN docs USING (r), totals GROUP BY ALL
), ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY q ORDER BY score DESC, doc_id, r) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def _clusters(rounds: int = 10) -> str:
    whole = "CAST(floor(CAST(1024 AS DOUBLE) * CAST(x AS DOUBLE)) AS BIGINT)"
    steps = [f"""kept AS MATERIALIZED (
  SELECT ROW_NUMBER() OVER () AS r, vec_id, [{whole} FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
)""", """c0 AS MATERIALIZED (
  SELECT no - 1 AS cluster, v FROM (SELECT v, ROW_NUMBER() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) AS no FROM kept) WHERE no <= 8
)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, MIN({{'d': d, 'cluster': cluster}}) AS near FROM (
    SELECT r, cluster, CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(k.v, c.v)]) AS BIGINT) AS d FROM kept k, c{i} c) GROUP BY r
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT cluster, COALESCE(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY place) AS v FROM (
      SELECT cluster, place, CAST(SUM(x) AS BIGINT) AS s, COUNT(*) AS n FROM (
        SELECT near.cluster AS cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i} JOIN kept USING (r)) GROUP BY ALL)
    GROUP BY cluster) m USING (cluster)
)""")
    return "WITH " + ", ".join(steps) + f"""
SELECT k.vec_id, CAST(near.cluster AS INTEGER) AS cluster, near.d AS distance,
       CAST(SUM(near.d) OVER (PARTITION BY near.cluster) AS BIGINT) AS cluster_inertia, CAST(SUM(near.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept k USING (r) JOIN c{rounds} c ON c.cluster = near.cluster
"""


ORACLE: dict[str, str] = {"op2_neardup": _NEAR, "op3_mixing": _MIX, "op4_quality": _QUALITY, "op6_jaccard": _JACCARD, "op7_line_dedup": _LINES,
                          "op8_substring": _SUBSTRING, "op10_license": _license(), "op11_ranked_search": _SEARCH,
                          "op12_clustering": _clusters()}
