"""DuckDB SQL for the operators that SQL can state, formulated on its own: brute force over rows, pairs and cutoffs."""

QUALITY = r"""
WITH RECURSIVE texts AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT doc_id, lang, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
grams AS (
  SELECT doc_id, i, list_slice(words, i, i + 2) AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) >= 2),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice CROSS JOIN (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id),
base AS (
  SELECT s.doc_id, lang, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '[^!]', '', 'g')) AS bangs, len(lines) AS n_lines
  FROM split s LEFT JOIN repeated r ON r.doc_id = s.doc_id),
metrics AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_symbols / greatest(n_words, 1) AS symbol_ratio, bangs / greatest(n_words, 1) AS bang_ratio,
         n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio, word_chars / greatest(n_words, 1) AS mean_word_chars
  FROM base),
known AS (SELECT doc_id, min(quality) >= 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
joint AS (  -- a joint cutoff: a cutoff per rule, or none (infinity), the strictest first
  SELECT i, j, k, l, symbol[i] AS c1, bang[j] AS c2, dup[k] AS c3, long_words[l] AS c4
  FROM (SELECT [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0, 2.0, 'infinity'::DOUBLE] AS symbol,
               [0.05, 0.1, 0.2, 0.3, 0.5, 1.0, 1.5, 'infinity'::DOUBLE] AS bang,
               [0.1, 0.2, 0.3, 0.4, 0.5, 0.7, 'infinity'::DOUBLE] AS dup,
               [8.0, 10.0, 12.0, 15.0, 20.0, 30.0, 'infinity'::DOUBLE] AS long_words),
       range(1, 10) AS a(i), range(1, 9) AS b(j), range(1, 8) AS c(k), range(1, 8) AS d(l)),
path AS (  -- round n of the fixed path tightens each rule by one cutoff, in the order of the rules
  SELECT DISTINCT greatest(9 - n, 1) AS i, greatest(8 - n + (q < 2)::INT, 1) AS j,
         greatest(7 - n + (q < 3)::INT, 1) AS k, greatest(7 - n + (q < 4)::INT, 1) AS l
  FROM range(1, 9) AS r(n), range(1, 5) AS t(q)),
apart AS (SELECT max(n) AS width FROM (SELECT count(*) AS n FROM joint GROUP BY i + j + k + l)),
judged AS (SELECT metrics.*, good FROM metrics JOIN known USING (doc_id)),
strata AS (
  SELECT lang, count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad FROM judged GROUP BY lang
  HAVING pow(1 - 0.05, n_good) <= 0.05 / 2),
tried AS (
  SELECT s.lang, n_good, n_bad, i, j, k, l, c1, c2, c3, c4, count(*) FILTER (good) AS k_good, count(*) FILTER (NOT good) AS k_bad
  FROM strata s JOIN judged m ON m.lang IS NOT DISTINCT FROM s.lang
  JOIN joint ON symbol_ratio > c1 OR bang_ratio > c2 OR dup_line_ratio > c3 OR mean_word_chars > c4
  GROUP BY ALL),
tails AS (  -- probability of so few false rejections, were the rate 0.05
  SELECT n_good, k_good, sum(exp(lgamma(n_good + 1) - lgamma(x + 1) - lgamma(n_good - x + 1)
                                 + x * ln(0.05) + (n_good - x) * ln(1 - 0.05))) AS p
  FROM (SELECT n_good, k_good, unnest(range(0, k_good + 1)) AS x FROM (SELECT DISTINCT n_good, k_good FROM tried))
  GROUP BY n_good, k_good),
chosen AS (
  SELECT t.lang, c1, c2, c3, c4, k_bad / greatest(n_bad, 1) - 10 * k_good / greatest(n_good, 1) AS gain
  FROM tried t JOIN tails USING (n_good, k_good) LEFT JOIN path h ON (h.i, h.j, h.k, h.l) = (t.i, t.j, t.k, t.l)
  WHERE p <= 0.05 / 2 / (SELECT count(*) FROM strata) / (CASE WHEN h.i IS NULL THEN (SELECT width FROM apart) ELSE 1 END)
  QUALIFY gain > 0 AND row_number() OVER (
    PARTITION BY t.lang ORDER BY gain DESC, t.i + t.j + t.k + t.l DESC, t.i DESC, t.j DESC, t.k DESC, t.l DESC) = 1),
rejected AS (
  SELECT DISTINCT doc_id FROM metrics m JOIN chosen c ON m.lang IS NOT DISTINCT FROM c.lang
  WHERE symbol_ratio > c1 OR bang_ratio > c2 OR dup_line_ratio > c3 OR mean_word_chars > c4)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r.doc_id IS NULL AS kept, symbol_ratio, bang_ratio, dup_line_ratio, mean_word_chars
FROM metrics m LEFT JOIN rejected r ON r.doc_id = m.doc_id
"""

VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN lowest ON a = vec_id
"""

URLS = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(verdict, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/'))
SELECT page_id, host, path, h || p AS rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) = 1
"""

MIX = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
copies AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, source, size) - 1) // 1024 AS part FROM docs),
keyed AS (
  SELECT doc_id, source, size, md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), size::VARCHAR, part::VARCHAR)) AS key FROM copies),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS most,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM docs GROUP BY source),
everything AS (SELECT sum(source_size)::BIGINT AS words FROM sources),
-- with the sources under a bound of words per weight at their most, the level of the others
levels AS (
  SELECT b.most / b.weight AS bound, words - coalesce(sum(s.most) FILTER (s.most / s.weight < b.most / b.weight), 0) AS free,
         sum(s.weight) FILTER (s.most / s.weight >= b.most / b.weight) AS weights
  FROM sources b, sources s, everything GROUP BY b.most / b.weight, words),
settled AS (SELECT * FROM levels WHERE free / weights <= bound ORDER BY bound LIMIT 1),
budgets AS (
  SELECT source, source_size, CASE WHEN most / weight < bound THEN most::DOUBLE
                                   ELSE (weight * free)::BIGINT::DOUBLE / weights::DOUBLE END AS target FROM sources, settled),
placed AS (
  SELECT k.*, source_size, target, floor(target + 0.5)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
             + least(greatest(budget % source_size - before, 0), size) END)::BIGINT AS taken
FROM placed
"""

ORACLES = {"op2_quality_rules": QUALITY, "op6_lattice_near_dedup": VECTORS, "op9_url_filters": URLS, "op11_source_mixing": MIX}
