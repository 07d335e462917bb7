"""SQL counterparts of the queries that SQL can express, written naively: all windows, all pairs, all paths."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex({text}, '[\x09-\x0D\x20]+'), lambda w: w <> '')"

_COMPONENTS = """reach(a, b) AS (
  SELECT id, id FROM rows UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), classes AS (SELECT a AS id, min(b) AS class FROM reach GROUP BY 1
), degrees AS (SELECT a AS id, count(*) AS n FROM links GROUP BY 1)"""

JACCARD = f"""WITH RECURSIVE split AS (
  SELECT doc_id AS id, {_WORDS.format(text="lower(coalesce(text, ''))")} AS words FROM documents
), rows AS (SELECT id FROM split
), placed AS (
  SELECT id, words, least(5, len(words)) AS n, unnest(range(1, len(words) - least(5, len(words)) + 2)) AS i FROM split WHERE len(words) > 0
), grams AS (SELECT DISTINCT id, array_to_string(words[i:i + n - 1], ' ') AS gram FROM placed
), sizes AS (SELECT id, count(*) AS n FROM grams GROUP BY 1
), common AS (
  SELECT x.id AS a, y.id AS b, count(*) AS c FROM grams x JOIN grams y ON x.gram = y.gram AND x.id <> y.id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE 5 * c >= 4 * (x.n + y.n - c)
), {_COMPONENTS}
SELECT id AS doc_id, class AS class_id, coalesce(n, 0) AS n_links, id = class AS kept
FROM classes LEFT JOIN degrees USING (id)"""

VECTORS = f"""WITH RECURSIVE rows AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), fit AS (SELECT id, v FROM rows WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.id AS a, y.id AS b FROM fit x JOIN fit y
  ON x.id <> y.id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.95
), {_COMPONENTS}
SELECT id AS vec_id, coalesce(n, 0) AS n_links, class AS component_id, id = class AS kept
FROM classes LEFT JOIN degrees USING (id)"""

SUBSTRINGS = f"""WITH split AS (
  SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS words FROM documents
), placed AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM split
), windows AS (
  SELECT doc_id, p, n, string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS key FROM placed
), ranked AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY key ORDER BY doc_id, p) AS nth FROM windows WHERE p <= n - 19
), removed AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM ranked WHERE nth > 1
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM placed ANTI JOIN removed USING (doc_id, p) GROUP BY 1
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)"""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES = f"""WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), placed AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS p FROM split
), keyed AS (SELECT doc_id, line, p, trim({_LOWER.format(text="line")}, {_BLANKS}) AS key FROM placed
), common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY 1 HAVING count(DISTINCT doc_id) >= 10
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS text
  FROM keyed ANTI JOIN common USING (key) GROUP BY 1
)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_dropped,
  sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)"""

COLLOCATIONS = f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format(text="coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), runs AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
), totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM runs GROUP BY 1
), sized AS (SELECT lang, w, unnest(range(1, 6)) AS k FROM runs WHERE len(w) > 0
), placed AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized WHERE k <= len(w)
), frequent AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM placed GROUP BY 1, 2, 3 HAVING count(*) >= 100
), split AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM frequent WHERE k > 1
), starts AS (SELECT lang, k, w, a, unnest(range(1, k + 1)) AS i FROM split
), spans AS (SELECT lang, k, w, a, i, unnest(range(i, k + 1)) AS j FROM starts
), inside AS (
  SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(a) AS longer FROM spans WHERE j - i + 1 < k GROUP BY 1, 2
), kept AS (
  SELECT split.* FROM split LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
), cuts AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS cut FROM kept
), scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cut, l.f AS l, r.f AS r, n,
    (CAST(1000 AS HUGEINT) * a * n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM cuts JOIN frequent l ON l.lang = cuts.lang AND l.phrase = array_to_string(w[1:cut], ' ')
  JOIN frequent r ON r.lang = cuts.lang AND r.phrase = array_to_string(w[cut + 1:], ' ') JOIN totals ON totals.lang = cuts.lang
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE nth = 1
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""

ORACLES = {
    "op8_lsh_forest_join": JACCARD, "op9_p_stable_near_duplicates": VECTORS, "op10_suffix_tree_dedup": SUBSTRINGS,
    "op11_line_bitmaps": LINES, "op13_tiled_collocations": COLLOCATIONS,
}
