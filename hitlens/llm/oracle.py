"""DuckDB SQL of the operators that SQL can express, computed from the given tables alone."""

DECONTAMINATE = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS size FROM items WHERE len(w) > 0),
phrases AS (
  SELECT item, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM phrases))),
hits AS (
  SELECT doc_id, size, i, item FROM places JOIN phrases USING (size, phrase)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

PASSAGES = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs)),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) AS place FROM windows)
  WHERE place > 1),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS places FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later)
  GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS words
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs) t
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT doc_id, unnest(places) AS p FROM gone) g
                    WHERE g.doc_id = t.doc_id AND g.p = t.p)
  GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM docs LEFT JOIN gone ON gone.doc_id = docs.doc_id LEFT JOIN kept ON kept.doc_id = docs.doc_id
"""


def _secret_spans(kind: str, rank: int, pattern: str, keep: str = "true", beyond: str = "0") -> str:
    """Matches of one pattern with positions: lengths of the gaps between them and of the matches add up.

    ``beyond``: how many characters a match has read past its end.
    """
    return rf"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank, start, start + lens[i] - {beyond} AS stop FROM (
    SELECT *, CAST(coalesce(list_sum(gaps[1:i]), 0) + coalesce(list_sum(lens[1:i - 1]), 0) AS BIGINT) AS start FROM (
      SELECT doc_id, hits, list_transform(hits, lambda x: length(x)) AS lens,
             list_transform(string_split_regex(t, '{pattern}'), lambda x: length(x)) AS gaps,
             unnest(range(1, len(hits) + 1)) AS i
      FROM (SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS hits FROM docs)))
  WHERE {keep}"""


# fixed values: the contract's three kinds, then the four that the scan adds
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
# a private key from its BEGIN line: header lines, then all up to the END line, or else the runs of base64; a short run
# at the end needs a blank, a quote, a dash or the end of the text behind it, which DuckDB can only test by reading it
_BETWEEN = r"""[\s\x0B\\"''>|,*#]"""
_RUNS = rf"(?:{_BETWEEN}*[A-Za-z0-9+/]{{16,}}={{0,2}})+"
_KEY = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
        rf"(?:{_BETWEEN}+[A-Za-z][A-Za-z0-9-]*:\x20?[^\s\x0B\\]*)*"
        r"""(?:[A-Za-z0-9+/=\s\x0B\\"''>|,*#]*-----END [A-Z ]*PRIVATE KEY-----"""
        rf"|{_RUNS}{_BETWEEN}+[A-Za-z0-9+/]+={{0,2}}(\z|[\s\x0B\\\"''>|,*#-])"
        rf"|{_RUNS}|)")
_PAST_KEY = f"length(regexp_extract(hits[i], '{_KEY}', 1))"
_SECRET_KINDS = (
    ("assign", _ASSIGN, f"length(regexp_extract(hits[i], '{_ASSIGN}', 2)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "lens[i] >= 20"),
    ("hex", "[0-9a-f]+", "lens[i] >= 24"),
    ("pem", _KEY, "true", _PAST_KEY),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", "true"),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", "true"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", "true"),
)

SECRETS = (
    "WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),\nspans AS ("
    + " UNION ALL ".join(_secret_spans(k, n, *rest) for n, (k, *rest) in enumerate(_SECRET_KINDS)) + r"""),
joined AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS every
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM docs LEFT JOIN joined USING (doc_id)
""")

# fixed values: words 20, repeats 30 %, window 8; risk and error 5 %, four rules, cutoffs in per cent
QUALITY = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
windows AS (
  SELECT doc_id, list(i) AS places
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM docs)
  GROUP BY doc_id, array_to_string(w[i:i + 7], ' ') HAVING count(*) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS p FROM (SELECT doc_id, unnest(places) AS i FROM windows))
  GROUP BY doc_id),
stats AS (
  SELECT docs.doc_id, stratum, t, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, len(regexp_extract_all(t, '\p{Lu}')) AS n_upper,
         len(regexp_extract_all(t, '\p{L}')) AS n_letters
  FROM docs LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
rates AS (
  SELECT doc_id, stratum, t, unnest([
    {'rule': 'symbols', 'top': n_symbols, 'bottom': word_chars}, {'rule': 'upper', 'top': n_upper, 'bottom': n_letters},
    {'rule': 'dup_lines', 'top': n_dup_lines, 'bottom': n_lines},
    {'rule': 'repeats', 'top': n_repeat_words, 'bottom': n_words}], recursive := true) FROM stats),
marks AS (
  SELECT doc_id, max(CAST(quality AS INTEGER)) > 0 AS good FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
texts AS (SELECT DISTINCT stratum, t, good, rule, top, bottom FROM rates JOIN marks USING (doc_id)),
grid AS (SELECT unnest([90, 80, 70, 60, 50, 40, 35, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4, 3, 2, 1]) AS cutoff),
counts AS (
  SELECT stratum, rule, cutoff, count(*) FILTER (good) AS n,
         count(*) FILTER (good AND 100 * top > cutoff * bottom) AS k,
         count(*) FILTER (NOT good AND 100 * top > cutoff * bottom) AS caught
  FROM texts, grid GROUP BY stratum, rule, cutoff),
tails AS (
  SELECT *, CASE WHEN k >= n THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp(
              lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.05 / 4) + (n - i) * ln(1 - 0.05 / 4)))) END AS p,
         (SELECT count(DISTINCT stratum) FROM texts WHERE good) AS strata FROM counts),
certified AS (
  SELECT *, bool_and(p <= 0.05 / (4 * strata)) OVER (PARTITION BY stratum, rule ORDER BY cutoff DESC) AS ok
  FROM tails WHERE strata > 0),
chosen AS (
  SELECT stratum, rule, cutoff FROM (
    SELECT *, row_number() OVER (PARTITION BY stratum, rule ORDER BY caught DESC, cutoff DESC) AS place
    FROM certified WHERE ok AND caught > 0) WHERE place = 1),
failed AS (
  SELECT DISTINCT doc_id FROM rates JOIN chosen USING (stratum, rule) WHERE 100 * top > cutoff * bottom)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND doc_id NOT IN (SELECT doc_id FROM failed) AS kept
FROM stats
"""

HARD_NEGATIVES = """
WITH points AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM points a JOIN points b ON a.id % 100 = 0 AND a.id <> b.id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM scored WHERE same)
  WHERE place <= 5)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, positive_id, s.id AS negative_id, positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS place
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
WHERE place <= 5
"""
