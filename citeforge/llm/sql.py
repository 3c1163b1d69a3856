"""DuckDB SQL for the results of the queries that SQL can express."""

from __future__ import annotations

from .mixing import BLOCK, FAN, REPEATS, SEED, SHARD_DOCS
from .secret_scan import RULES

MIX = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, coalesce('a' || source, 'b') AS source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(concat_ws(':', '{SEED}', doc_id, text)), 1, 15))::BIGINT AS h
  FROM {{documents}}
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs, (row_number() OVER (ORDER BY source) - 1) % 3 + 1 AS w FROM sized GROUP BY source
), sorted AS (
  SELECT *, {REPEATS} * source_size AS cap, row_number() OVER (ORDER BY {REPEATS} * source_size / w, source) AS k FROM sources
), rests AS (
  SELECT a.source, a.source_size, a.n_docs, a.w, a.cap, a.k,
    (SELECT sum(source_size) FROM sorted) - coalesce((SELECT sum(cap) FROM sorted b WHERE b.k < a.k), 0) AS rest, (SELECT sum(w) FROM sorted b WHERE b.k >= a.k) AS w_rest
  FROM sorted a
), stop AS (
  SELECT * FROM rests WHERE rest * w <= cap * w_rest ORDER BY k LIMIT 1
), filled AS (
  SELECT r.source, r.source_size, r.n_docs, CASE WHEN r.k < s.k THEN r.cap::DOUBLE ELSE r.w::DOUBLE * s.rest::DOUBLE / s.w_rest::DOUBLE END AS target FROM rests r CROSS JOIN stop s
), seats AS (
  SELECT round(sum(target) / {BLOCK})::BIGINT AS m FROM filled
), won AS (
  SELECT source FROM (SELECT source, row_number() OVER (ORDER BY target / (2 * s + 1) DESC, source) AS r
    FROM filled, (SELECT unnest(range((SELECT m FROM seats))) AS s) WHERE target > 0 AND s <= target / {BLOCK} + 2) WHERE r <= (SELECT m FROM seats)
), plan AS (
  SELECT f.*, (SELECT count(*) FROM won WHERE won.source = f.source) AS source_quota, ceil(n_docs / {SHARD_DOCS})::BIGINT AS n_shards FROM filled f
), dealt AS (
  SELECT d.doc_id, d.size, d.h, p.*, d.h % p.n_shards AS shard FROM sized d JOIN plan p ON d.source = p.source
), per_shard AS (
  SELECT source, shard, shard // {FAN} AS grp, sum(size)::BIGINT AS shard_size, max(source_quota) AS source_quota, greatest(1, ceil(sum(size) / {BLOCK}))::BIGINT AS blocks,
    CASE WHEN sum(size) > 0 THEN {REPEATS} * ceil(sum(size) / {BLOCK}) ELSE 0 END::BIGINT AS most
  FROM dealt GROUP BY source, shard
), grps AS (
  SELECT source, grp, sum(shard_size) AS grp_size, max(source_quota) AS source_quota, sum(most)::BIGINT AS most FROM per_shard GROUP BY source, grp
), grp_ranked AS (
  SELECT source, grp, source_quota, row_number() OVER (PARTITION BY source ORDER BY grp_size::DOUBLE / (2 * s + 1) DESC, grp, s) AS r
  FROM (SELECT *, unnest(range(least(source_quota, most))) AS s FROM grps WHERE grp_size > 0)
), grp_quota AS (
  SELECT source, grp, count(*) FILTER (WHERE r <= source_quota) AS grp_quota FROM grp_ranked GROUP BY source, grp
), ranked AS (
  SELECT source, shard, grp_quota, row_number() OVER (PARTITION BY source, grp ORDER BY shard_size::DOUBLE / (2 * s + 1) DESC, shard, s) AS r
  FROM (SELECT p.*, g.grp_quota, unnest(range(least(g.grp_quota, p.most))) AS s FROM per_shard p JOIN grp_quota g ON p.source = g.source AND p.grp = g.grp WHERE shard_size > 0)
), shard_quota AS (
  SELECT source, shard, count(*) FILTER (WHERE r <= grp_quota) AS quota FROM ranked GROUP BY source, shard
), quotas AS (
  SELECT p.source, p.shard, p.shard_size, p.blocks, coalesce(q.quota, 0) AS quota FROM per_shard p LEFT JOIN shard_quota q ON q.source = p.source AND q.shard = p.shard
), laid AS (
  SELECT d.doc_id, d.size, d.source_size, d.target, q.blocks, q.quota // q.blocks AS whole, q.quota % q.blocks AS more,
    ('0x' || substr(md5('{SEED}:' || d.source || ':' || d.shard), 1, 15))::BIGINT % q.blocks AS phase,
    sum(d.size) OVER (PARTITION BY d.source, d.shard ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING)::BIGINT AS e
  FROM dealt d JOIN quotas q ON d.source = q.source AND d.shard = q.shard
), extra AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE list_sum(list_transform(range((e - size) // {BLOCK}, (e - 1) // {BLOCK} + 1),
    lambda i: CASE WHEN (i * more + phase) % blocks < more THEN least(e, (i + 1) * {BLOCK}) - greatest(e - size, i * {BLOCK}) ELSE 0 END)) END AS x FROM laid
)
SELECT doc_id, size, source_size, target, (size * whole + x)::BIGINT AS taken FROM extra
"""

WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
HITS = f"""
WITH d AS (SELECT doc_id, coalesce({WORDS}, []) AS ws FROM {{documents}}),
b AS (SELECT item_id::VARCHAR AS item, {WORDS} AS ws FROM benchmark WHERE text IS NOT NULL),
windows AS (SELECT DISTINCT item, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS g
  FROM (SELECT item, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
found AS (SELECT x.doc_id, x.i, x.n, w.item FROM
  (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lengths WHERE len(ws) >= n)) x
  JOIN windows w ON x.g = w.g AND x.n = w.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


TOPK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
asked AS (SELECT vec_id, min(x) AS x FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score FROM asked q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 5
"""

WARC = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
f AS (SELECT h, min(page_id) AS response FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, url, n AS payload_bytes, sha256(p.h) AS payload_digest, CASE WHEN f.response < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.response < page_id THEN f.response END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h
"""


def secrets() -> str:
    """Matches and the gaps between them, unnested and summed up."""
    q = lambda s: s.replace("'", "''")
    each = " UNION ALL ".join(
        f"SELECT doc_id, '{r.kind}' AS kind, {i} AS nth, {r.least} AS least, string_split_regex(t, '{q(r.regex)}') AS gaps, regexp_extract_all(t, '{q(r.regex)}') AS ms, regexp_extract_all(t, '{q(r.regex)}', {r.group}) AS gs FROM d"
        for i, r in enumerate(RULES)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM @documents),
each AS ({each}),
one AS (SELECT doc_id, kind, nth, least, i, len(gaps[i]) AS gap, len(ms[i]) AS size, len(gs[i]) AS measured FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM each)),
placed AS (SELECT *, sum(gap + size) OVER (PARTITION BY doc_id, kind ORDER BY i)::BIGINT AS e FROM one),
kept AS (SELECT doc_id, kind, nth, e - size AS s, kind || ':' || (e - size) || ':' || e AS item FROM placed WHERE measured >= least),
sums AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  string_agg(item, ',' ORDER BY s, nth) FILTER (WHERE nth < 3) AS base, string_agg(item, ',' ORDER BY s, nth) AS spans FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN sums USING (doc_id)
"""


NEAR = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws FROM @documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ')) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
same AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM same JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
low AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c, d.doc_id) AS component_id, coalesce(c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = d.doc_id
"""


PHRASES = r"""
WITH words AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 30
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), cuts AS (
  SELECT lang, k, phrase, a, c, array_to_string(w[:c], ' ') AS one, array_to_string(w[c + 1:], ' ') AS two FROM candidates, (SELECT unnest([1, 2, 3]) AS c) WHERE c < k
), scores AS (
  SELECT x.lang, x.phrase, x.a, x.c, p.n AS l, q.n AS r, (2000000::HUGEINT * x.a // (p.n + q.n))::BIGINT AS score
  FROM cuts x JOIN f p ON p.lang = x.lang AND p.phrase = x.one AND p.k = x.c JOIN f q ON q.lang = x.lang AND q.phrase = x.two AND q.k = x.k - x.c
), best AS (
  SELECT lang, phrase, a, arg_min(l, row(score, c)) AS l, arg_min(r, row(score, c)) AS r, min(score) AS score FROM scores GROUP BY lang, phrase, a
), inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM candidates, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS m) WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.longer IS NULL OR 100 * i.longer < 80 * b.a
)
SELECT lang, rank, phrase, a, l, r, t.n, score FROM ranked JOIN totals t USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_near_dup": NEAR.replace("@documents", "documents"), "op2_secret_scan": secrets().replace("@documents", "documents"), "op3_exact_topk": TOPK, "op7_warc": WARC, "op6_source_mixing": MIX.format(documents="documents"), "op8_decontaminate": HITS.format(documents="documents"), "op12_collocations": PHRASES}
