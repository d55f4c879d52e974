"""DuckDB SQL for the queries that SQL can express, on the whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

TOP_K = rf"""
WITH bag AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS words
  FROM documents),
stats AS (SELECT count(*) AS n, sum(len(words)) / count(*) AS mean FROM bag),
tf AS (SELECT rid, doc_id, len, w, count(*) AS tf FROM (SELECT rid, doc_id, len(words) AS len, unnest(words) AS w FROM bag) GROUP BY ALL),
idf AS (SELECT w, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, stats GROUP BY w, n),
q AS (SELECT DISTINCT doc_id AS query_id, w FROM tf WHERE doc_id % 50 = 0),
s AS (
  SELECT query_id, rid, doc_id,
         round(sum(idf * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / mean))), 6) AS score
  FROM q JOIN idf USING (w) JOIN tf USING (w), stats GROUP BY query_id, rid, doc_id)
SELECT query_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s) WHERE rank <= 10
"""

VECTOR_LINKS = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

MIX = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('17|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS draw
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
tot AS (SELECT sum(source_size)::DOUBLE * 1.5::DOUBLE AS total, sum(w)::DOUBLE AS w FROM src),
level(r, lam) AS (
  SELECT 0, total / w FROM tot
  UNION ALL
  SELECT r + 1, coalesce(
    (any_value(total) - sum(CASE WHEN 2 * source_size < lam * src.w THEN 2.0::DOUBLE * source_size ELSE 0 END))
      / nullif(sum(CASE WHEN 2 * source_size < lam * src.w THEN 0 ELSE src.w END)::DOUBLE, 0), lam)
  FROM level, src, tot WHERE r < 64 GROUP BY r, lam),
t AS (
  SELECT source, source_size, n_docs, least(2.0::DOUBLE * source_size, lam * w) AS target
  FROM src, (SELECT lam FROM level ORDER BY r DESC LIMIT 1)),
f AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
         CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0 END AS frac,
         ceil(n_docs / 8192.0)::BIGINT AS slots
  FROM t),
x AS (SELECT d.doc_id, d.size, draw, f.*, ('0x' || substr(draw, 1, 8))::BIGINT % slots AS slot FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
y AS (SELECT *, row_number() OVER (PARTITION BY source, slot ORDER BY size DESC, draw) AS place FROM x),
z AS (
  SELECT y.*, k, floor(place * frac + (k + 0.5::DOUBLE) / 32.0::DOUBLE) - floor((place - 1) * frac + (k + 0.5::DOUBLE) / 32.0::DOUBLE) AS extra
  FROM y, range(32) AS offsets(k)),
miss AS (SELECT source, slot, k, abs(sum(extra * size) - any_value(frac) * sum(size)) AS miss FROM z GROUP BY ALL),
pick AS (SELECT source, slot, k FROM miss QUALIFY row_number() OVER (PARTITION BY source, slot ORDER BY miss, k) = 1),
e0 AS (
  SELECT z.doc_id, z.size, z.source, z.source_size, z.target, z.slot, z.place, z.whole, z.extra,
         z.frac * sum(z.size) OVER (PARTITION BY z.source, z.slot) - sum(z.extra * z.size) OVER (PARTITION BY z.source, z.slot) AS rest
  FROM z JOIN pick ON z.source IS NOT DISTINCT FROM pick.source AND z.slot = pick.slot AND z.k = pick.k),
FILL_STEPS
SELECT doc_id, size, source_size, target, ((whole + extra) * size)::BIGINT AS taken FROM eFILLS
"""


def mix_sql() -> str:
    """The mix with its rounds of filling."""
    from .mixing import FILLS

    steps = []
    for n in range(FILLS):
        steps.append(f"""
m{n + 1} AS (
  SELECT *, CASE WHEN rest < 0 THEN -1 ELSE 1 END AS turn,
         size > 0 AND abs(abs(rest) - size) < abs(rest) AND extra = CASE WHEN rest < 0 THEN 1 ELSE 0 END AS helps
  FROM e{n}),
o{n + 1} AS (
  SELECT *, helps AND row_number() OVER (PARTITION BY source, slot ORDER BY CASE WHEN helps THEN abs(abs(rest) - size) END NULLS LAST, place) = 1 AS chosen FROM m{n + 1}),
e{n + 1} AS (
  SELECT doc_id, size, source, source_size, target, slot, place, whole, extra + CASE WHEN chosen THEN turn ELSE 0 END AS extra,
         rest - turn * coalesce(max(CASE WHEN chosen THEN size END) OVER (PARTITION BY source, slot), 0) AS rest
  FROM o{n + 1})""")
    return MIX.replace("FILL_STEPS", ",".join(steps).strip()).replace("eFILLS", f"e{FILLS}")


def license_sql() -> str:
    """The scan of op10 with its templates as a table of values."""
    from .licenses import CUES, FILE_NAMES, TEMPLATES, WINDOW_WORDS

    quote = lambda x: "'" + x.replace("'", "''") + "'"
    notices = ", ".join(f"({k}, {quote(name)}, {quote(text)})" for k, (name, text) in enumerate((n, t) for n, texts in TEMPLATES.items() for t in texts))
    word = r"'[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*'"
    cue = r"'(?i)(?:^|[^\p{L}])(?:" + "|".join(CUES) + r")(?:[^\p{L}]|$)'"
    names = ", ".join(map(quote, FILE_NAMES))
    return rf"""
WITH template(k, license, notice) AS (VALUES {notices}),
tw AS (SELECT k, license, w, count(*) AS n FROM (SELECT k, license, unnest(regexp_extract_all(lower(notice), {word})) AS w FROM template) GROUP BY ALL),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, text, floor(doc_id / 20)::BIGINT AS n, source || '/d' || floor(floor(doc_id / 20) / 50)::BIGINT AS up FROM documents),
files AS (
  SELECT rid, doc_id, text, CASE WHEN n % 50 = 0 THEN up || '/LICENSE' WHEN n % 5 = 0 THEN up || '/e' || (floor(n / 10)::BIGINT % 5) || '/LICENSE.' || n
         ELSE up || '/e' || (floor(n / 10)::BIGINT % 5) || '/file' || n END AS path FROM docs),
df AS (
  SELECT w, count(*) AS df FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), {word}))) AS w FROM documents)
  WHERE w IN (SELECT w FROM tw) GROUP BY w),
total AS (SELECT count(*) AS t FROM documents),
idf AS (SELECT DISTINCT tw.w, ln((t + 1) / (coalesce(df, 0) + 1)) + 1 AS idf FROM total, tw LEFT JOIN df USING (w)),
vec AS (SELECT k, license, w, n * idf / sqrt(sum((n * idf) * (n * idf)) OVER (PARTITION BY k)) AS v FROM tw JOIN idf USING (w)),
held AS (SELECT text, row_number() OVER () AS tid FROM (SELECT DISTINCT text FROM files WHERE regexp_matches(text, {cue}))),
cut AS (SELECT tid, string_split_regex(text, '\r?\n|\r') AS parts FROM held),
part AS (SELECT tid, p, regexp_extract_all(lower(parts[p]), {word}) AS words, regexp_matches(parts[p], {cue})::INT AS cued FROM cut, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS p)),
line AS (
  SELECT tid, row_number() OVER per_text AS i, words, cued, sum(len(words)) OVER per_text AS upto, sum(cued) OVER per_text AS cues
  FROM part WHERE len(words) > 0 WINDOW per_text AS (PARTITION BY tid ORDER BY p)),
run AS (
  SELECT a.tid, a.i AS s, b.i AS e FROM line a JOIN line b ON a.tid = b.tid AND b.i >= a.i
    AND (b.i = a.i OR b.upto - a.upto + len(a.words) <= {WINDOW_WORDS}) AND b.cues > a.cues - a.cued
  UNION SELECT tid, 1, max(i) FROM line GROUP BY tid),
uw AS (SELECT tid, s, e, w, count(*) AS tf FROM (SELECT run.tid, s, e, unnest(words) AS w FROM run JOIN line ON line.tid = run.tid AND i BETWEEN s AND e) GROUP BY ALL),
weighed AS (SELECT tid, s, e, uw.w, tf * coalesce(idf, ln(t + 1) + 1) AS x FROM total, uw LEFT JOIN idf USING (w)),
norm AS (SELECT tid, s, e, sqrt(sum(x * x)) AS norm FROM weighed GROUP BY ALL),
dots AS (SELECT tid, s, e, license, sum(x * v) AS dot FROM weighed JOIN vec USING (w) GROUP BY tid, s, e, k, license),
score AS (SELECT text, license, max(round(dot / norm, 9)) AS score FROM dots JOIN norm USING (tid, s, e) JOIN held USING (tid) GROUP BY text, license),
own AS (SELECT text, license AS own_license, score FROM score WHERE score >= 0.75 QUALIFY row_number() OVER (PARTITION BY text ORDER BY score DESC, license) = 1),
found AS (SELECT rid, doc_id, path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, own_license, score FROM files LEFT JOIN own USING (text)),
given AS (
  SELECT dir, own_license AS dir_license FROM found
  WHERE own_license IS NOT NULL AND lower(regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\.[^.]*$', '')) IN ({names})
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, own_license) = 1),
near AS (
  SELECT rid, given.dir AS near_dir, dir_license FROM found JOIN given ON found.dir = given.dir OR starts_with(found.dir, given.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(given.dir) DESC) = 1)
SELECT doc_id, path, own_license, score, coalesce(own_license, dir_license) AS license,
       CASE WHEN own_license IS NULL THEN near_dir END AS inherited_from
FROM found LEFT JOIN near USING (rid)
"""

DOCUMENT_TRIE = rf"""
WITH bag AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
stats AS (SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM bag WHERE len(words) > 0),
tf AS (SELECT rid, doc_id, n, w, count(*) AS tf FROM (SELECT rid, doc_id, len(words) AS n, unnest(words) AS w FROM bag) GROUP BY ALL),
weight AS (SELECT w, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM tf, stats GROUP BY w, n_docs),
item AS (
  SELECT DISTINCT iid, item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT *, row_number() OVER () AS iid FROM benchmark)),
s AS (
  SELECT iid, item_id, rid, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM item JOIN weight USING (w) JOIN tf USING (w), stats GROUP BY iid, item_id, rid, doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= 50
"""

REPEATS = """
WITH bytes AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes, hex(encode(coalesce(text, ''))) AS hx FROM documents),
piece AS (SELECT rid, doc_id, p * 500 AS base, substr(hx, p * 1000 + 1, 1098) AS part FROM bytes, LATERAL (SELECT unnest(range(n_bytes // 500 + 1)) AS p)),
string AS (
  SELECT rid, doc_id, base + i AS i, sha256(substr(part, 2 * i + 1, 100)) AS s
  FROM piece, LATERAL (SELECT unnest(range(least(500, len(part) // 2 - 49))) AS i)),
first AS (SELECT s, min(doc_id) AS doc FROM string GROUP BY s),
again AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM string JOIN first USING (s) WHERE doc_id > doc),
span AS (
  SELECT rid, min(i) AS a, max(i) + 50 AS b
  FROM (SELECT rid, i, sum(CASE WHEN i <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY i) AS k FROM again) GROUP BY rid, k),
gap AS (SELECT *, lead(a) OVER (PARTITION BY rid ORDER BY a) AS next FROM span),
cut AS (
  SELECT rid, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed,
         substr(any_value(hx), 1, 2 * min(a)) || string_agg(substr(hx, 2 * b + 1, 2 * (coalesce(next, n_bytes) - b)), '' ORDER BY a) AS rest
  FROM gap JOIN bytes USING (rid) GROUP BY rid)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, hx))) AS kept_sha256
FROM bytes LEFT JOIN cut USING (rid)
"""


def manifest_sql() -> str:
    """Whole levels as lists; a path's siblings with ``F`` (first), ``S`` (second) or ``-`` (none) in front of each digest."""

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"

    up = "list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))"
    sibling = "CASE WHEN {r} >> level & 1 = 1 THEN 'F' || nodes[{r} >> level] WHEN ({r} >> level) + 2 <= len(nodes) THEN 'S' || nodes[({r} >> level) + 2] ELSE '-' END"
    return f"""
WITH RECURSIVE
crc AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) AS h
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
leaves AS (
  SELECT doc_id, lang, {leaf("n_chars")} AS leaf,
         CASE WHEN coalesce(h, 0) % 7 = 0 THEN {leaf("(n_chars + 1)")} ELSE {leaf("n_chars")} END AS given
  FROM documents LEFT JOIN crc USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM leaves),
tree(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY r) FROM placed GROUP BY lang
  UNION ALL SELECT lang, level + 1, {up} FROM tree WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS q FROM tree WHERE len(nodes) = 1),
top(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY q) FROM subroots
  UNION ALL SELECT level + 1, {up} FROM top WHERE len(nodes) > 1),
low AS (
  SELECT placed.lang, r, list({sibling.format(r="r")} ORDER BY level) FILTER (WHERE len(nodes) > 1) AS steps
  FROM placed JOIN tree ON placed.lang IS NOT DISTINCT FROM tree.lang GROUP BY placed.lang, r),
high AS (SELECT q, list({sibling.format(r="q")} ORDER BY level) FILTER (WHERE len(nodes) > 1) AS steps FROM subroots, top GROUP BY q),
path AS (
  SELECT doc_id, leaf, given, subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root,
         list_concat(coalesce(low.steps, []), coalesce(high.steps, [])) AS steps
  FROM placed JOIN low ON placed.lang IS NOT DISTINCT FROM low.lang AND placed.r = low.r
  JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang JOIN high USING (q)),
folded AS (
  SELECT *, list_reduce(list_prepend(given, steps), lambda a, s: CASE s[1] WHEN 'F' THEN sha256(s[2:] || a) WHEN 'S' THEN sha256(a || s[2:]) ELSE sha256(a) END) AS folded_root
  FROM path)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded
"""


def all_sql() -> dict[str, str]:
    return {"op2_block_max_wand": TOP_K, "op5_spherical_kmeans": VECTOR_LINKS, "op9_mix_sources": mix_sql(), "op10_license_scan": license_sql(), "op11_interval_manifest": manifest_sql(), "op12_document_trie": DOCUMENT_TRIE, "op13_previous_factors": REPEATS}
