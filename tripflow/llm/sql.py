"""DuckDB SQL with the rows of the queries that SQL can express.

The others are left to tests next to brute force: training, tokenizers and double sums that depend
on the order of rows have no SQL whose values would agree to the last bit.
"""

from __future__ import annotations

from .quality import COMMON_WORDS

_SPACE = r"[\x20\x09-\x0D]"
_WORDS = rf"list_filter(string_split_regex(%s, '{_SPACE}+'), lambda x: x <> '')"
_TEXT = "coalesce(text, '')"

WARC = """WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
stored AS (SELECT html, max(page_id) AS winner FROM p WHERE payload_bytes >= 1000 GROUP BY html)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN winner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN winner <> page_id THEN winner END AS refers_to
FROM p LEFT JOIN stored ON p.html = stored.html"""

PASSAGES = f"""WITH d AS (SELECT doc_id, {_WORDS % _TEXT} AS w FROM documents),
runs AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS run
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS n
                                 FROM runs) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(0, 20)) AS place FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d),
left_over AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS kept
              FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)"""

_LOWER = (f"translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

NEAR_DUPLICATES = f"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS % _LOWER} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 2], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS s FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
           FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION
    SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON r.other = l.a),
parts AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM parts LEFT JOIN sizes USING (doc_id)"""

NEAR_VECTORS = """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reached(vec_id, other) AS (SELECT vec_id, vec_id FROM v UNION
    SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a),
parts AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM parts LEFT JOIN counts USING (vec_id)"""


def _listed(lang: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in COMMON_WORDS[lang].split()) + "]"


_COUNT = "length(t) - length(regexp_replace(t, '%s', '', 'g'))"
_SYMBOLS = "[#*$%&|<>]"

_DISTANCE = """sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0))"""

RULES = rf"""WITH d AS (SELECT doc_id, CASE WHEN lang IN ({', '.join(f"'{x}'" for x in COMMON_WORDS)})
           THEN lang ELSE '*' END AS lang, {_TEXT} AS t, {_WORDS % _TEXT} AS w FROM documents),
windows AS (SELECT doc_id, s, array_to_string(w[s:s + 2], ' ') AS k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS s FROM d WHERE len(w) >= 3)),
covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, s + unnest(range(0, 3)) AS place FROM (
        SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS times FROM windows) WHERE times > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
counts AS (SELECT doc_id, lang, w, len(w) AS n_words, length(t) - ({_COUNT % _SPACE}) AS word_chars,
    {_COUNT % _SYMBOLS} AS n_symbols, {_COUNT % _SPACE} AS spaces, {_COUNT % '[\\p{Lu}]'} AS upper,
    {_COUNT % '[\\p{Nd}]'} AS digits, ({_COUNT % '[\\p{P}]'}) - ({_COUNT % '[#*%&]'}) AS marks,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
    FROM d JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [upper, digits, n_symbols, marks, spaces, word_chars - upper - digits - n_symbols - marks] AS chars,
    CASE lang {' '.join(f"WHEN '{x}' THEN {_listed(x)}" for x in COMMON_WORDS)} END AS listed FROM counts),
words AS (SELECT *, list_transform(listed, lambda k: len(list_filter(w, lambda x: x = k))) AS found FROM judged),
bars AS (SELECT doc_id, lang, base_failed, n_words, 'chars' AS kind, unnest(range(1, 7)) AS i, unnest(chars) AS v
         FROM words UNION ALL
    SELECT doc_id, lang, base_failed, n_words, 'words', unnest(range(1, 22)),
           unnest(list_append(found, n_words - CAST(list_sum(found) AS BIGINT))) FROM words WHERE lang <> '*'),
totals AS (SELECT lang, sum(n_words) AS n FROM words WHERE NOT base_failed AND lang <> '*' GROUP BY lang UNION ALL
    SELECT '*', sum(n_words) FROM words WHERE NOT base_failed),
rbars AS (SELECT doc_id, lang AS ref, base_failed, kind, i, v FROM bars WHERE lang <> '*' UNION ALL
    SELECT doc_id, '*', base_failed, kind, i, v FROM bars WHERE kind = 'chars'),
all_refs AS (SELECT ref, kind, i, CAST(sum(v) AS DOUBLE) AS v FROM rbars WHERE NOT base_failed GROUP BY 1, 2, 3),
all_shares AS (SELECT b.doc_id, ref, kind,
           b.v / nullif(sum(b.v) OVER (PARTITION BY b.doc_id, ref, kind), 0) AS p,
           r.v / sum(r.v) OVER (PARTITION BY b.doc_id, ref, kind) AS q
    FROM rbars b JOIN all_refs r USING (ref, kind, i) WHERE NOT b.base_failed),
all_distances AS (SELECT doc_id, ref, kind, {_DISTANCE} AS distance FROM all_shares GROUP BY 1, 2, 3),
middle AS (SELECT ref, kind, quantile_disc(distance, 0.5) AS m FROM all_distances GROUP BY 1, 2),
refs AS (SELECT ref, kind, i, CAST(sum(v) AS DOUBLE) AS v FROM rbars
    JOIN all_distances USING (doc_id, ref, kind) JOIN middle USING (ref, kind)
    WHERE NOT base_failed AND distance <= m GROUP BY 1, 2, 3),
shares AS (SELECT b.doc_id, b.kind, b.v / nullif(sum(b.v) OVER (PARTITION BY b.doc_id, b.kind), 0) AS p,
           r.v / sum(r.v) OVER (PARTITION BY b.doc_id, b.kind) AS q
    FROM bars b JOIN refs r ON b.lang = r.ref AND b.kind = r.kind AND b.i = r.i
    JOIN totals ON totals.lang = b.lang AND totals.n >= 1000),
distances AS (SELECT doc_id, kind, {_DISTANCE} AS distance FROM shares GROUP BY 1, 2)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND (word_chars < 200 OR coalesce(c.distance, 0) <= 0.18)
           AND (n_words < 100 OR coalesce(x.distance, 0) <= 0.3) AS kept
FROM words LEFT JOIN distances c USING (doc_id)
LEFT JOIN distances x ON x.doc_id = words.doc_id AND x.kind = 'words'
WHERE c.kind IS NULL OR c.kind = 'chars'"""


def _assigned(step: int) -> str:
    return f"""a{step} AS (SELECT vec_id, cluster, distance FROM (
    SELECT vec_id, cluster, sum((v.x - c.x) * (v.x - c.x)) AS distance
    FROM v JOIN c{step} c USING (d) GROUP BY vec_id, cluster)
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)"""


def _moved(step: int) -> str:
    return f"""c{step + 1} AS (SELECT c.cluster, c.d, coalesce(m.x, c.x) AS x FROM c{step} c LEFT JOIN (
    SELECT cluster, d, (s - ((s % n) + n) % n) // n AS x FROM (
        SELECT cluster, d, sum(x) AS s, count(*) AS n FROM v JOIN a{step} USING (vec_id) GROUP BY cluster, d)) m
    ON c.cluster = m.cluster AND c.d = m.d)"""


_ROUNDS = 3

CENTROIDS = f"""WITH kept AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda e: CAST(floor(64 * e) AS BIGINT)) AS e
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
v AS (SELECT vec_id, unnest(e) AS x, unnest(range(64)) AS d FROM kept),
first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM kept
          QUALIFY cluster < 16),
c0 AS (SELECT cluster, d, x FROM v JOIN first USING (vec_id)),
{", ".join(f"{_assigned(s)}, {_moved(s)}" for s in range(_ROUNDS))}, {_assigned(_ROUNDS)},
parts AS (SELECT cluster, sum(distance) AS cluster_inertia FROM a{_ROUNDS} GROUP BY cluster),
digests AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256
            FROM c{_ROUNDS} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(cluster_inertia AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(distance) FROM a{_ROUNDS}) AS BIGINT) AS inertia, centroid_sha256
FROM a{_ROUNDS} JOIN parts USING (cluster) JOIN digests USING (cluster)"""
