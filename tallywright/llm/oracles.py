r"""What registered corpus queries give, as DuckDB SQL.

The others cannot be written in SQL in full (token ids, 64-bit hashes that DuckDB lacks, fitted
weights, span arithmetic over several patterns); tests hold them against plain results.
"""

_WORD = r"[^\x20\x09-\x0D]"
_BLANK = r"[\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_QUALITY = f"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANK}'), lambda x: x <> '') AS w
    FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (
    SELECT doc_id, i FROM windows
    QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
repeated AS (
    SELECT doc_id, count(DISTINCT j) AS n
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id),
lines AS (
    SELECT doc_id, source, line,
           len(list_filter(regexp_split_to_array(line, '{_BLANK}'), lambda x: x <> '')) AS words,
           left(md5(regexp_replace(trim(regexp_replace({_LOWER.format('line')}, '{_BLANK}', ' ', 'g')),
                                   '[0-9]+', '0', 'g')), 16) AS h
    FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '{_WORD}')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
held AS (SELECT doc_id, source, h, sum(words) AS words FROM lines GROUP BY ALL),
family AS (
    SELECT *, string_agg(h, '' ORDER BY h) OVER (PARTITION BY doc_id) AS family FROM held),
frequent AS (
    SELECT source, h FROM family GROUP BY source, h HAVING count(DISTINCT family) > 20),
gone AS (
    SELECT f.doc_id, sum(f.words) AS n FROM family f
    JOIN frequent q ON f.h = q.h AND f.source IS NOT DISTINCT FROM q.source GROUP BY f.doc_id),
m AS (
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
           CAST(coalesce(gone.n, 0) AS BIGINT) AS n_boilerplate_words
    FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN repeated USING (doc_id)
    LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND 2 * (n_words - n_boilerplate_words) >= n_words AS kept
FROM m"""

# Rules only: the pages of these tables hold no canonical links or redirects.
_URLS = f"""
WITH u AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3)
                         ELSE '' END AS rest
    FROM pages),
p AS (
    SELECT page_id, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM u),
r AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR ends_with(host, '.example.org'))
             AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR ends_with(host, '.example.org'))
             AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
        END AS rule
    FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
            ELSE 'allow' END AS verdict
FROM r"""

_TOKENS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '')"

_CONTAINED = f"""
WITH dw AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
bw AS (SELECT item_id, {_TOKENS} AS w FROM benchmark),
bs AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
       FROM (SELECT item_id, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i
             FROM bw WHERE len(w) > 0)),
ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
             FROM dw, (SELECT DISTINCT k FROM bs) WHERE len(w) >= k)),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_held,
       round(count(*) / n_shingles, 6) AS containment
FROM ds JOIN bs USING (k, s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= 0.8 * n_shingles - 1e-9"""

_NEGATIVES = """
WITH v AS (
    SELECT vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
near AS (
    SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS n
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
     AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM near WHERE n <= 5"""

ORACLES: dict[str, str] = {
    "op6_quality_rules": _QUALITY,
    "op8_url_filter": _URLS,
    "op9_decontamination": _CONTAINED,
    "op11_hard_negatives": _NEGATIVES,
}
