"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

SUBSTRINGS = r"""
WITH d AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w
    FROM documents
), places AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, w, len(w) AS n FROM d
), windows AS (
    SELECT doc_id, i, array_to_string(w[i + 1 : i + 13], ' ') AS g FROM places WHERE i + 13 <= n
), earlier AS (
    SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS first FROM windows) WHERE doc_id > first
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM earlier
), left_over AS (
    SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS kept, count(*) AS n
    FROM places p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(l.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(l.kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over l ON d.doc_id = l.doc_id
"""

DECONTAMINATION = r"""
WITH d AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
    FROM documents
), b AS (
    SELECT item_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
    FROM benchmark
), items AS (
    SELECT item_id, least(13, len(w)) AS k, unnest(range(len(w) - least(13, len(w)) + 1)) AS i, w FROM b WHERE len(w) > 0
), wanted AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i + 1 : i + k], ' ') AS g FROM items
), places AS (
    SELECT doc_id, unnest(range(len(w))) AS i, w, len(w) AS n FROM d
), windows AS (
    SELECT doc_id, i, k, array_to_string(w[i + 1 : i + k], ' ') AS g
    FROM places CROSS JOIN (SELECT DISTINCT k FROM wanted) WHERE i + k <= n
), met AS (
    SELECT doc_id, i, k, item_id FROM windows JOIN wanted USING (k, g)
), hit AS (
    SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM met) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM met) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
       sha256(coalesce(named.items, '')) AS items_sha256, coalesce(hit.n > 0 AND 20 * hit.n >= len(d.w), false) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
"""

#: The given pages have no redirects or canonical links, so the verdict without a rule is the default.
URL_FILTERS = r"""
WITH parts AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), rules(name, verdict) AS (
    VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')
), split AS (
    SELECT name, verdict, name[: position('/' IN name) - 1] AS host, name[position('/' IN name) :] AS path FROM rules
)
SELECT p.page_id, p.host, p.path, arg_max(r.name, len(r.name)) AS rule,
       coalesce(arg_max(r.verdict, len(r.name)), 'allow') AS verdict
FROM parts p LEFT JOIN split r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
GROUP BY p.page_id, p.host, p.path
"""

WARC = r"""
WITH p AS (
    SELECT page_id, html, md5(coalesce(html, '')) AS digest, page_id * 3600 + (1 + page_id % 5) * 86400 AS asked,
           'day ' || page_id AS day,
           lower(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1)) AS host, regexp_extract(url, '^(?s:.*?)://[^/?#]*([^#]*)', 1) AS rest
    FROM pages
), k AS (
    SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(host, ':(80|443)?$', '')
               || regexp_replace(regexp_replace(rest, '/\?', '?'), '/$', ''), '\?(utm_[^&]*&?)+', '?'), '(&utm_[^&]*)+', '', 'g'), '[?&]$', '') AS key
    FROM p
), responses AS (
    SELECT key, page_id * 3600 AS at, page_id * 3 AS id, digest, day, html FROM k WHERE html IS NOT NULL AND host <> ''
), revisits AS (
    SELECT page_id * 3 + 1 AS record_id, asked AS at, * FROM k
    UNION ALL SELECT page_id * 3 + 2, page_id - 10000000, * FROM k WHERE page_id % 13 = 0
), linked AS (
    SELECT v.*, r.id AS response_id, r.digest AS r_digest, r.day AS r_day, r.html AS r_html,
           CASE WHEN v.page_id % 11 = 0 THEN false
                WHEN v.page_id % 5 = 0 THEN v.day = r.day
                WHEN v.page_id % 7 = 0 THEN false
                ELSE v.digest = r.digest END AS same,
           CASE WHEN v.page_id % 11 <> 0 AND v.page_id % 5 <> 0
                THEN if(v.page_id % 3 = 0, 'W/', '') || '"' || v.digest || '"' ELSE '"' || r.digest || '"' END AS etag
    FROM revisits v ASOF LEFT JOIN responses r ON v.key = r.key AND v.at * 10000000 + v.record_id > r.at * 10000000 + r.id
)
SELECT record_id, response_id,
       CASE WHEN response_id IS NULL THEN 'missing' WHEN same THEN 'resolved' ELSE 'changed' END AS outcome,
       CASE WHEN response_id IS NOT NULL AND same THEN concat_ws(chr(10), 'content-length: ' || strlen(r_html), 'content-type: text/html',
            'date: asked ' || asked, 'etag: ' || etag, 'expires: soon', 'last-modified: ' || r_day) END AS headers,
       CASE WHEN response_id IS NOT NULL AND same THEN md5(r_html) END AS payload_md5
FROM linked
"""

FILTER_AUDIT = r"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), judged AS (
    SELECT doc_id, part, [
        len(w) < 50,
        100 * len(list_distinct(w)) < 65 * len(w),
        100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t),
        regexp_matches(t, '[#$%&*|]'),
        coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)
    ] AS bad
    FROM words
), marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), counted AS (
    SELECT part, bad, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
    FROM judged LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters AS (
    SELECT unnest(range(1, 6)) AS k
), orders AS (
    SELECT [a.k, b.k, c.k, d.k, e.k] AS o
    FROM letters a JOIN letters b ON b.k <> a.k JOIN letters c ON c.k NOT IN (a.k, b.k) JOIN letters d ON d.k NOT IN (a.k, b.k, c.k)
    JOIN letters e ON e.k NOT IN (a.k, b.k, c.k, d.k)
), run AS (
    SELECT part, o, bad, good, toxic, n, coalesce(list_position([bad[x] FOR x IN o], true), 6) AS gone
    FROM counted, orders
), steps AS (
    SELECT part, o, step, o[step] AS f, sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN gone < step AND bad[o[step]] THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN bad[o[step]] AND len([x FOR x IN bad IF x]) = 1 THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN gone = step THEN n * good ELSE 0 END) AS good_lost,
           sum(CASE WHEN gone = step THEN n * toxic ELSE 0 END) AS toxic_lost
    FROM run, (SELECT unnest(range(1, 6)) AS step) GROUP BY ALL
)
SELECT part, array_to_string([substr('ABCDE', x, 1) FOR x IN o], '') AS filter_order, step::INT AS step, substr('ABCDE', f, 1) AS "filter",
       kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM steps
"""


def mixing(block: int = 64, shard_slots: int = 8192, seed: int = 13) -> str:
    """The mix in SQL: the same draws and permutations, its targets from running sums over all sources at once."""
    from ordermill.llm.mixing import PRIME, ROUNDS, SPREAD, number_of

    steps, previous = [], "slots"
    for r in range(ROUNDS):
        key, a, b = (number_of(f"{seed}:{name}:{r}") for name in "kab")
        pair = f"((xor({key}, (sid * 4 + epoch) * {SPREAD}) & {(1 << 62) - 1}) % greatest(full_blocks, 1) + full_blocks - x) % greatest(full_blocks, 1)"
        bit = f"((greatest(x, y) % {PRIME}) * {a % PRIME} + {b % PRIME}) % {PRIME} % 2 = 1"
        steps.append(
            f"round{r} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN place < full_blocks AND {bit} THEN y ELSE x END AS x) FROM (SELECT * EXCLUDE (y), {pair} AS y FROM {previous}))"
        )
        previous = f"round{r}"
    return rf"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, row_number() OVER () AS r
    FROM documents
), numbered AS (
    SELECT source, sum(size)::BIGINT AS size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM sized GROUP BY source
), weighted AS (
    SELECT *, [5, 2, 1][sid % 3 + 1]::BIGINT AS weight, sum(size) OVER ()::BIGINT AS total FROM numbered
), filling AS (
    SELECT *, 3 * total - 2 * coalesce(sum(2 * size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_words,
           sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight, row_number() OVER o AS place
    FROM weighted WINDOW o AS (ORDER BY 10 * size // weight, sid)
), turning AS (
    SELECT open_words, open_weight, place FROM filling WHERE weight * open_words < 4 * size * open_weight ORDER BY place LIMIT 1
), aimed AS (
    SELECT f.*, CASE WHEN t.place IS NULL OR f.place < t.place THEN (2 * size)::DOUBLE
                     ELSE (weight * t.open_words)::BIGINT::DOUBLE / (2 * t.open_weight)::BIGINT::DOUBLE END AS target
    FROM filling f LEFT JOIN turning t ON true
), needed AS (
    SELECT sid, source, size, target, floor(target + 0.5)::BIGINT AS wanted, size // {block} AS full_blocks, (size + {block - 1}) // {block} AS blocks FROM aimed
), quotas AS (
    SELECT *, CASE WHEN size > 0 THEN wanted % size ELSE 0 END AS rest FROM needed
), sources AS (
    SELECT *, (CASE WHEN size > 0 THEN wanted // size ELSE 0 END) * blocks + (rest + {block - 1}) // {block} AS quota,
           CASE WHEN rest > 0 THEN (rest - 1) % {block} + 1 END AS last_words
    FROM quotas
), ranged AS (
    SELECT *, (sum(quota) OVER (ORDER BY sid))::BIGINT AS high FROM sources
), slot_ids AS (
    SELECT unnest(range((SELECT coalesce(max(high), 0) FROM ranged))) AS id
), drawn AS (
    SELECT id // {shard_slots} AS shard, sid, count(*) AS n
    FROM (SELECT id, ('0x' || substr(md5('{seed}:' || id), 1, 15))::BIGINT % (SELECT max(high) FROM ranged) AS draw FROM slot_ids)
    JOIN ranged ON draw >= high - quota AND draw < high GROUP BY ALL
), placed_draws AS (
    SELECT sid, (sum(n) OVER (PARTITION BY sid ORDER BY shard))::BIGINT - n AS first_slot, n FROM drawn
), listed AS (
    SELECT sid, unnest(range(first_slot, first_slot + n)) AS slot FROM placed_draws
), drawn_totals AS (
    SELECT r.sid, r.quota, coalesce(sum(n), 0)::BIGINT AS got FROM ranged r LEFT JOIN drawn d USING (sid) WHERE r.quota > 0 GROUP BY ALL
), excess AS (
    SELECT row_number() OVER (ORDER BY sid, slot) AS k FROM listed JOIN ranged USING (sid) WHERE slot >= quota
), lacking AS (
    SELECT sid, slot, row_number() OVER (ORDER BY sid, slot) AS k FROM (SELECT sid, unnest(range(got, quota)) AS slot FROM drawn_totals WHERE got < quota)
), final_slots AS (
    SELECT l.sid, l.slot FROM listed l JOIN ranged r USING (sid) WHERE l.slot < r.quota
    UNION ALL SELECT l.sid, l.slot FROM excess JOIN lacking l USING (k)
), slots AS (
    SELECT f.sid, r.full_blocks, slot // r.blocks AS epoch, slot % r.blocks AS place, slot % r.blocks AS x, 0::BIGINT AS y,
           CASE WHEN slot = r.quota - 1 THEN r.last_words END AS part
    FROM final_slots f JOIN ranged r USING (sid)
), {", ".join(steps)}, draws AS (
    SELECT sid, x AS block, count(*) FILTER (part IS NULL) AS times, coalesce(max(part), 0) AS part FROM {previous} GROUP BY ALL
), ordered AS (
    SELECT d.*, s.sid, s.size AS source_size, s.target,
           (sum(d.size) OVER (PARTITION BY s.sid ORDER BY doc_id NULLS FIRST, d.size, r))::BIGINT - d.size AS begin_at
    FROM sized d JOIN ranged s ON d.source IS NOT DISTINCT FROM s.source
), pieces AS (
    SELECT r, sid, begin_at, size, unnest(range(begin_at // {block}, (begin_at + size - 1) // {block} + 1)) AS block FROM ordered WHERE size > 0
), cut AS (
    SELECT *, greatest(begin_at, block * {block}) - block * {block} AS offset_in, least(begin_at + size, (block + 1) * {block}) - greatest(begin_at, block * {block}) AS words
    FROM pieces
), sums AS (
    SELECT r, sum(words * times + least(words, greatest(part - offset_in, 0)))::BIGINT AS taken FROM cut JOIN draws USING (sid, block) GROUP BY r
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM ordered LEFT JOIN sums USING (r)
"""
