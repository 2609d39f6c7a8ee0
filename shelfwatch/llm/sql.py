"""DuckDB SQL of the contract queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9 = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s
    FROM worded
), classes AS (
    SELECT min(doc_id) AS c, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)
), items AS (
    SELECT c, n, unnest(s) AS item FROM classes
), links AS (
    SELECT a.c AS a, b.c AS b FROM items a JOIN items b ON a.item = b.item AND a.c < b.c
        AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
    GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), both_ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
    SELECT c, c AS r FROM classes UNION SELECT reach.c, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a
), smallest AS (
    SELECT c, min(r) AS component_id FROM reach GROUP BY c
)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(smallest.component_id, sets.doc_id) AS component_id
FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s LEFT JOIN smallest ON smallest.c = classes.c
"""

OP8 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
    SELECT *, regexp_replace(role, '([\\#<:])', '\\\1', 'g') AS r, regexp_replace(text, '([\\#<])', '\\\1', 'g') AS t FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, r, t)) AS loss_sha256,
    CAST(sum(length(r) + length(t) + 15) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


_HREF = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["'']?([^"''\s>]+)"""


def _ranks(name: str, start: str, source: str, target: str, rounds: int) -> str:
    """One step of personalised PageRank after another, as common tables."""
    steps = [
        f"{name}_p AS (SELECT {source} AS s, {target} AS t, weight / sum(weight) OVER (PARTITION BY {source}) AS p FROM links)",
        f"{name}_0 AS (SELECT host, {start} / nullif(sum({start}) OVER (), 0) AS seed, {start} / nullif(sum({start}) OVER (), 0) AS rank FROM hosts)",
    ]
    for k in range(1, rounds + 1):
        steps.append(
            f"{name}_{k} AS (SELECT h.host, any_value(h.seed) AS seed, 0.85 * coalesce(sum(r.rank * e.p), 0) + 0.15 * any_value(h.seed) AS rank "
            f"FROM {name}_{k - 1} h LEFT JOIN {name}_p e ON e.t = h.host LEFT JOIN {name}_{k - 1} r ON r.host = e.s GROUP BY h.host)"
        )
    steps.append(f"{name}_all AS (SELECT host, rank / nullif(sum(rank) OVER (), 0) AS rank FROM {name}_{rounds})")
    return ",\n".join(f"{x.split(' AS ', 1)[0]} AS MATERIALIZED {x.split(' AS ', 1)[1]}" for x in steps)


OP5 = rf"""
WITH rests AS (
    SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS MATERIALIZED (
    SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests
), ruled AS MATERIALIZED (
    SELECT page_id, host, path,
        CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
             WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
             WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
             WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
    FROM parts
), fixed AS (
    SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS fixed FROM ruled
), found AS (
    SELECT host, regexp_extract_all(html, '{_HREF}', 1) AS l FROM parts WHERE host <> ''
), each AS (
    SELECT host, 1 / len(l) AS share, unnest(l) AS link FROM found WHERE len(l) > 0
), ends AS (
    SELECT host AS source, share, CASE WHEN link LIKE '//%' THEN 'http:' || link ELSE link END AS link FROM each
), links AS MATERIALIZED (
    SELECT source, target, sum(share) AS weight FROM (
        SELECT source, share, CASE
            WHEN regexp_matches(link, '(?i)^https?://') THEN lower(regexp_extract(link, '://([^/?#]*)', 1))
            WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN '' ELSE source END AS target FROM ends
    ) WHERE target <> '' GROUP BY ALL
), seeds AS (
    SELECT host, avg(CASE WHEN fixed = 'allow' THEN 1.0 ELSE 0.0 END) AS good, avg(CASE WHEN fixed = 'block' THEN 1.0 ELSE 0.0 END) AS bad
    FROM fixed WHERE host <> '' GROUP BY host
), hosts AS MATERIALIZED (
    SELECT * FROM seeds UNION ALL SELECT DISTINCT target, 0.0::DOUBLE, 0.0::DOUBLE FROM links WHERE target NOT IN (SELECT host FROM seeds)
), {_ranks("t", "good", "source", "target", 8)},
{_ranks("d", "bad", "target", "source", 8)}
SELECT page_id, host, path, rule, coalesce(fixed, CASE WHEN coalesce(d.rank, 0) > coalesce(t.rank, 0) + 1e-12 THEN 'block' ELSE 'allow' END) AS verdict
FROM fixed LEFT JOIN t_all t USING (host) LEFT JOIN d_all d USING (host)
"""


OP1 = """
WITH RECURSIVE parts AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), valid AS (
    SELECT vec_id, v FROM parts WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
    SELECT vec_id, vec_id AS r FROM parts UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.r = links.a
), smallest AS (
    SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id
), degrees AS (
    SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM smallest LEFT JOIN degrees USING (vec_id)
"""


def _kmeans(clusters: int, rounds: int, size: int, scale: int, seed: int) -> str:
    """Rounds of assignment and floored means, one common table after another."""
    nearest = (
        "list_min(list_transform(range(1, len(c) + 1), lambda k: {'d': list_sum(list_transform(range(1, " + str(size + 1) + "), "
        "lambda i: (v[i] - c[k][i]) * (v[i] - c[k][i])))::BIGINT, 'k': (k - 1)::INTEGER}))"
    )
    steps = [
        f"x AS (SELECT vec_id, list_transform(embedding, lambda e: e::DOUBLE) AS v FROM embeddings WHERE len(embedding) = {size})",
        f"points AS MATERIALIZED (SELECT vec_id, list_transform(v, lambda e: floor({scale} * e)::BIGINT) AS v FROM x "
        "WHERE len(list_filter(v, lambda e: e IS NULL OR NOT isfinite(e))) = 0)",
        f"c_0 AS MATERIALIZED (SELECT list(v ORDER BY h, v) AS c FROM (SELECT v, sha256('{seed}:' || vec_id) AS h FROM points "
        f"ORDER BY h NULLS LAST, v LIMIT {clusters}))",
    ]
    for k in range(rounds + 1):
        steps.append(f"a_{k} AS MATERIALIZED (SELECT vec_id, v, {nearest} AS a FROM points, c_{k})")
        if k < rounds:
            steps += [
                f"s_{k} AS (SELECT k, i, sum(e)::BIGINT AS s, count(*) AS n FROM (SELECT a.k AS k, unnest(range(1, {size + 1})) AS i, unnest(v) AS e FROM a_{k}) GROUP BY k, i)",
                f"m_{k} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM s_{k} GROUP BY k)",
                f"c_{k + 1} AS MATERIALIZED (SELECT list(coalesce(m, old) ORDER BY o.k) AS c FROM (SELECT unnest(range(len(c))) AS k, unnest(c) AS old FROM c_{k}) o LEFT JOIN m_{k} USING (k))",
            ]
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT vec_id, a.k AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia, "
        f"sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c[a.k + 1], ',')) AS centroid_sha256 FROM a_{rounds}, c_{rounds}"
    )


OP12 = _kmeans(8, 10, 64, 1024, 3)

# Checksums: a byte goes through the table of the usual reversed polynomial.
OP13 = rf"""
WITH RECURSIVE steps AS (
    SELECT b, b AS x, 0 AS k FROM range(256) t(b) UNION ALL SELECT b, xor(x >> 1, 3988292384 * (x & 1)), k + 1 FROM steps WHERE k < 8
), crc AS MATERIALIZED (
    SELECT list(x ORDER BY b) AS t FROM steps WHERE k = 8
), worded AS (
    SELECT doc_id, true AS own, list_transform(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w) AS w FROM documents
    UNION ALL SELECT item_id, false, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), runs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, own, len(w) AS words, w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS f FROM worded
), each AS MATERIALIZED (
    SELECT r, own, unnest(f) AS feature FROM runs
), bytes AS (
    SELECT feature, list_transform(regexp_extract_all(hex(encode(feature)), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM (SELECT DISTINCT feature FROM each)
), cells AS MATERIALIZED (
    SELECT feature, xor(list_reduce([4294967295::BIGINT] || b, lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1])), 4294967295) % 10000 AS cell FROM bytes, crc
), counts AS (
    SELECT cell, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM each JOIN cells USING (feature) GROUP BY cell
), totals AS (
    SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM counts
), gains AS (
    SELECT cell, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM counts, totals
), weights AS (
    SELECT r, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight FROM each JOIN cells USING (feature) JOIN gains USING (cell) WHERE own GROUP BY r
), scored AS (
    SELECT doc_id, words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM runs LEFT JOIN weights USING (r) WHERE own
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY words >= 20) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM ranked
"""
