"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

HOST_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), base AS (
  SELECT rid, doc_id, source, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, ws
  FROM w
), lines AS (
  SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d
), dups AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), grams AS (
  SELECT rid, unnest(generate_series(1, len(ws) - 2)) AS i, ws FROM base WHERE len(ws) > 2
), keyed AS (
  SELECT rid, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM grams
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM keyed) WHERE n > 1
), rep AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, i + unnest([0, 1, 2]) AS j FROM twice) GROUP BY rid
), m AS (
  SELECT base.rid, doc_id, source, n_words, word_chars, n_symbols,
    coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN dups USING (rid) LEFT JOIN rep USING (rid)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), g AS (
  SELECT *, base_failed OR 100 * n_symbols > 8 * word_chars OR 100 * n_dup_lines > 10 * n_words AS any_failed
  FROM f
), h AS (
  SELECT source, count(*)::DOUBLE AS n, (count(*) FILTER (any_failed))::DOUBLE AS k FROM g GROUP BY source
), s AS (
  SELECT sum(n) AS total, sum(k) / sum(n) AS mean, sum(n * n) AS squares, sum(k * k / n) AS between_,
    count(*)::DOUBLE AS hosts FROM h
), p AS (
  SELECT mean, (between_ - total * mean * mean - mean * (1 - mean) * (hosts - 1))
    / nullif(mean * (1 - mean) * (total - squares / total - hosts + 1), 0) AS within_ FROM s
), q AS (
  SELECT mean, greatest(2.0, least(1000.0,
    CASE WHEN within_ <= 0 THEN 1000.0 ELSE coalesce((1 - within_) / within_, 1000.0) END)) AS weight FROM p
), v AS (
  SELECT source, CASE WHEN (k + mean * weight) / (n + weight) >= 0.5 THEN 'reject'
    WHEN (k + mean * weight) / (n + weight) >= 0.02 THEN 'watch' ELSE 'trust' END AS host_verdict
  FROM h, q
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_verdict <> 'reject' AND NOT (host_verdict = 'watch' AND any_failed) AS kept,
  host_verdict
FROM g JOIN v ON g.source IS NOT DISTINCT FROM v.source
"""

DECONTAMINATE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), pats AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS m,
    array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS pat
  FROM (SELECT item_id, ws, unnest(generate_series(1, len(ws) - least(10, len(ws)) + 1)) AS i FROM b WHERE len(ws) > 0)
), wins AS (
  SELECT rid, m, i, array_to_string(ws[i : i + m - 1], ' ') AS pat FROM (
    SELECT rid, ws, m, unnest(generate_series(1, len(ws) - m + 1)) AS i
    FROM d, (SELECT DISTINCT m FROM pats) WHERE len(ws) >= m)
), hit AS (
  SELECT rid, i, wins.m, item_id FROM wins JOIN pats ON wins.pat = pats.pat AND wins.m = pats.m
), covered AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(generate_series(i, i + m - 1)) AS j FROM hit)
  GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hit) GROUP BY rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit,
  coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
  covered.n IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)
"""

LINE_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents
), i AS (
  SELECT rid, source, ls, unnest(generate_series(1, len(ls))) AS i FROM d WHERE text IS NOT NULL
), l AS (
  SELECT rid, source, i, ls[i] AS line FROM i
), gone AS (
  SELECT line FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line
  HAVING count(DISTINCT coalesce('=' || source, 'null')) >= 10
), c AS (
  SELECT rid, count(*) AS n_lines, count(gone.line) AS n_removed,
    coalesce(string_agg(l.line, chr(10) ORDER BY i) FILTER (gone.line IS NULL), '') AS clean
  FROM l LEFT JOIN gone ON l.line = gone.line GROUP BY rid
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  md5(clean) AS clean_md5
FROM d LEFT JOIN c USING (rid)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS ws FROM documents
), sh AS (
  SELECT DISTINCT rid, doc_id, array_to_string(ws[i : i + least(5, len(ws)) - 1], ' ') AS s FROM (
    SELECT rid, doc_id, ws, unnest(generate_series(1, len(ws) - least(5, len(ws)) + 1)) AS i FROM d WHERE len(ws) > 0)
), n AS (
  SELECT rid, doc_id, count(*) AS n FROM sh GROUP BY rid, doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM (
    SELECT p.rid AS r1, q.rid AS r2, count(*) AS m FROM sh p JOIN sh q ON p.s = q.s AND p.rid <> q.rid GROUP BY 1, 2)
  JOIN n x ON x.rid = r1 JOIN n y ON y.rid = r2 WHERE 100 * m >= 75 * (x.n + y.n - m)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (rid) LEFT JOIN c ON c.doc_id = d.doc_id
"""

# DuckDB has no CRC-32, so the checksum is the polynomial division written out as table steps.
SHARDS = r"""
WITH RECURSIVE tab(i, v, k) AS (
  SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM tab WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM tab WHERE k = 8
), d AS (
  SELECT row_number() OVER () AS place, doc_id, encode(coalesce(text, '')) AS b FROM documents
), sums AS (
  SELECT place, doc_id, octet_length(b) + 16 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(octet_length(b)), lambda i: ('0x' || substr(hex(b), 2 * i::INT + 1, 2))::BIGINT)),
      lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM d, crc
), o AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size, place) AS upto, sum(size) OVER () AS total FROM sums
), s AS (
  SELECT *, (40 * (2 * upto - size) // (2 * total))::INT AS shard FROM o
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY upto) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
FROM s
"""

CANONICAL = r"""
SELECT *, CASE WHEN strpos(url, '://') > 0 THEN
    regexp_replace(regexp_replace(host, '^(www|m)\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_replace(path, '\.html?$', ''), '/+$', '')
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canon
FROM (
  SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^(utm_[a-z]+|ref|fbclid|gclid)='))) AS params
  FROM (
    SELECT *, coalesce(translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
      coalesce(regexp_extract(rest, '(?s)^[^/?#]*(/[^?#]*)', 1), '') AS path
    FROM (SELECT page_id, url, html,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages)))
"""

REVISITS = rf"""
WITH p AS (SELECT *, row_number() OVER () AS rid FROM ({CANONICAL})), c AS (
  SELECT rid, page_id, html, regexp_replace(canon, '(?s)/[0-9]+.*$', '') AS section, coalesce(regexp_matches(url, '[?#]'), false) AS again,
    octet_length(encode(html)) % 3 AS version FROM p
), t AS (
  SELECT *, '"' || md5(section || ':' || version) || '"' AS tag FROM c
), s AS (
  SELECT *, CASE WHEN again AND section IS NOT NULL AND page_id IS NOT NULL THEN
      last_value(CASE WHEN NOT again AND page_id IS NOT NULL THEN rid END IGNORE NULLS) OVER (
        PARTITION BY section ORDER BY page_id NULLS FIRST, NOT again, rid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS response FROM t
), j AS (
  SELECT s.page_id, s.again, r.page_id AS response_id, 'date: ' || s.page_id AS date, s.tag, s.html, r.html AS rhtml,
    CASE WHEN NOT s.again THEN 'full' WHEN s.response IS NULL THEN 'orphan'
      WHEN s.tag = r.tag THEN 'resolved' ELSE 'mismatch' END AS verdict
  FROM s LEFT JOIN t r ON r.rid = s.response
)
SELECT page_id, CASE WHEN again THEN 'revisit' ELSE 'response' END AS kind,
  CASE WHEN again THEN response_id ELSE page_id END AS response_id, verdict,
  CASE verdict WHEN 'full' THEN concat_ws(chr(10), 'content-type: text/html', date, 'etag: ' || tag)
    WHEN 'resolved' THEN concat_ws(chr(10), 'content-type: text/html', date, 'etag: W/' || tag)
    ELSE concat_ws(chr(10), 'content-length: 0', date, 'etag: W/' || tag) END AS headers,
  CASE verdict WHEN 'full' THEN octet_length(encode(html)) WHEN 'resolved' THEN octet_length(encode(rhtml)) END::BIGINT AS body_bytes
FROM j
"""

# Raking by a recursion that fits the three marginals in turn; then the cells that are kept whole, by
# tokens for each unit of weight, and the scale for the others.
RAKING = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || source, 'null') AS source, coalesce('=' || lang, 'null') AS lang, text,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n,
    len(string_split(text, chr(10))) AS lines FROM documents
), m AS (
  SELECT *, CASE WHEN text IS NULL OR n = 0 THEN 'none' WHEN n < 60 THEN 'note' WHEN n < 12 * lines THEN 'list'
    WHEN n >= 1000 THEN 'long' ELSE 'prose' END AS topic FROM d
), cells AS (
  SELECT source, lang, topic, sum(n)::DOUBLE AS t FROM m WHERE n > 0 GROUP BY ALL
), sw AS (
  SELECT source, pow(sum(t), 0.5) / sum(pow(sum(t), 0.5)) OVER () AS share FROM cells GROUP BY source
), lw AS (
  SELECT lang, pow(sum(t), 0.7) / sum(pow(sum(t), 0.7)) OVER () AS share FROM cells GROUP BY lang
), tw AS (
  SELECT topic, pow(sum(t), 0.5) / sum(pow(sum(t), 0.5)) OVER () AS share FROM cells GROUP BY topic
), start AS (
  SELECT source, lang, topic, t, t / sum(t) OVER () AS w, sw.share AS s, lw.share AS l, tw.share AS o
  FROM cells JOIN sw USING (source) JOIN lw USING (lang) JOIN tw USING (topic)
), r AS (
  SELECT 0 AS k, *, 1e300::DOUBLE AS off FROM start
  UNION ALL
  SELECT k + 1, source, lang, topic, t, w * o / has, s, l, o, max(greatest(off, abs(has / o - 1))) OVER () FROM (
    SELECT k, source, lang, topic, t, w, s, l, o, off, sum(w) OVER (PARTITION BY topic) AS has FROM (
      SELECT k, source, lang, topic, t, w * l / has AS w, s, l, o, greatest(off, abs(has / l - 1)) AS off FROM (
        SELECT k, source, lang, topic, t, w, s, l, o, off, sum(w) OVER (PARTITION BY lang) AS has FROM (
          SELECT k, source, lang, topic, t, w * s / has AS w, s, l, o, abs(has / s - 1) AS off FROM (
            SELECT *, sum(w) OVER (PARTITION BY source) AS has FROM r WHERE k < 10000 AND off > 1e-10)))))
), f AS (
  SELECT *, row_number() OVER (ORDER BY t / w, source, lang, topic) AS place FROM r WHERE k = (SELECT max(k) FROM r)
), g AS (
  SELECT *, (0.5 * sum(t) OVER () - coalesce(sum(t) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale FROM f
), h AS (
  SELECT scale FROM g WHERE scale * w <= t ORDER BY place LIMIT 1
), p AS (
  SELECT source, lang, topic, least(1.0, (SELECT scale FROM h) * w / t) AS probability FROM g
)
SELECT doc_id, n::BIGINT AS n_tokens, topic, round(CASE WHEN n = 0 THEN 1.0 ELSE probability END, 6) AS probability,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0
    < CASE WHEN n = 0 THEN 1.0 ELSE probability END AS sampled,
  round(coalesce((SELECT max(off) FROM f), 0.0), 6) AS marginal_error
FROM m LEFT JOIN p USING (source, lang, topic)
"""

URL_FILTER = rf"""
WITH p AS ({CANONICAL}), listed AS (
  SELECT DISTINCT canon FROM p WHERE canon IS NOT NULL
    AND try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})', 1), '') AS BIGINT)
      IN (SELECT doc_id FROM labels WHERE toxic = 1)
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
    coalesce(canon IN (SELECT canon FROM listed), false) AS listed
  FROM p
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM r
"""

# The table of the CRC-32 polynomial, and the unsigned checksum of a blob by it.
CRC_TABLE = """
tab(i, v, k) AS (
  SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM tab WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM tab WHERE k = 8
)"""


def crc32(blob: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(octet_length({blob})), lambda i: ('0x' || substr(hex({blob}), 2 * i::INT + 1, 2))::BIGINT)),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295)"""


# Near words: of one length and alike but for one place, or one is the other less one place.
SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE}, r AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{7,}}')) AS run FROM documents
), g AS (
  SELECT id, run, count(*) AS n FROM r GROUP BY id, run
), e AS (
  SELECT run, n, encode(id || ':' || run) AS b FROM g
), h AS (
  SELECT run, n, {crc32("b")} AS h FROM e, crc
), w AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word,
    n FROM h
), v AS (
  SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), p AS (
  SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM v
), d AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM p
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM d a JOIN d b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, d.n, v.word, v.n FROM d JOIN v ON v.word = d.less
  UNION SELECT v.word, v.n, d.word, d.n FROM d JOIN v ON v.word = d.less
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS best, max(other_n) AS best_n FROM near GROUP BY word
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 10 * v.n THEN best END AS form,
    CASE WHEN best_n >= 10 * v.n THEN best_n END::BIGINT AS form_n FROM v LEFT JOIN best ON v.word = best.word
), way(word, root, k) AS (
  SELECT word, word, 0 FROM f UNION ALL SELECT way.word, f.form, k + 1 FROM way JOIN f ON f.word = way.root WHERE f.form IS NOT NULL
), ends AS (
  SELECT word, arg_max(root, k) AS root FROM way GROUP BY word
)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN ends ON ends.word = f.word
"""


def edit(cost: str, letter: str, text: str, after: str) -> str:
    """A way that begins with an edit: its cost in twelve digits and its audit in one key, and its text."""
    return (
        f"struct_pack(k := lpad((substr({after}.k, 1, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || '{letter}' "
        f"|| substr({after}.k, 13), t := {text} || {after}.t)"
    )


def cheaper(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


UNREACHED = "struct_pack(k := '000900000000', t := '')"
NEW_USER, NEW_ASSISTANT = "(chr(10) || 'user:')", "(chr(10) || 'assistant:')"


def row_edits(state: str) -> str:
    """The cheapest way of a state that begins with an edit of the row."""
    next_, name = ("ha", "assistant") if state == "hu" else ("hu", "user")
    ways = {"h0": {"s": "hs", "u": "hu"}, "hs": {"u": "hu"}, "hu": {"a": "ha"}, "ha": {"u": "hu"}}[state]
    keep = " ".join(
        f"WHEN ini = '{i}' AND NOT gone THEN " + edit("more", "K", "(chr(10) || role || ':' || text)", to) for i, to in ways.items()
    )
    delete = edit("4", "D", "''", state)
    rerole = f"CASE WHEN NOT gone THEN {edit('3 + more', 'R', f'(chr(10) || {chr(39)}{name}:{chr(39)} || text)', next_)} ELSE {UNREACHED} END"
    return cheaper(delete, rerole, f"CASE {keep} ELSE {UNREACHED} END")


def inserted(next_: str, text: str) -> str:
    return edit("3", "I", text, next_)


# From the last row to the first: the cheapest way to the end from each of four states.
CONVERSATIONS = rf"""
WITH RECURSIVE {CRC_TABLE}, c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS b FROM conversations
), kind AS (
  SELECT conv_id, turn, role, text, {crc32("b")} % 20 AS kind FROM c, crc
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 0 THEN []::INT[] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM kind
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), md5(text), copy) AS i FROM damaged
), faults AS (
  SELECT conv_id, i, turn, role, text, substr(role, 1, 1) AS ini, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut FROM placed
), f AS (
  SELECT conv_id, i, turn, role, text, ini, blank, NOT blank AND again AS duplicate, NOT blank AND NOT again AND cut AS truncated,
    blank OR again AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS more,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair, i > 1 AS has_pair FROM faults
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (has_pair AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY conv_id
), ends AS (
  SELECT struct_pack(k := '000000000000', t := '') AS done, struct_pack(k := '000000000003I', t := {NEW_ASSISTANT}) AS hu,
    struct_pack(k := '000000000006II', t := {NEW_USER} || {NEW_ASSISTANT}) AS hs
), way(conv_id, i, h0, hs, hu, ha) AS (
  SELECT conv_id, n, done, hs, hu, done FROM sums, ends
  UNION ALL
  SELECT conv_id, i, {cheaper("g0", inserted("u", NEW_USER))}, {cheaper("gs", inserted("u", NEW_USER))}, u, a FROM (
    SELECT *, {cheaper("gu", inserted("ga", NEW_ASSISTANT))} AS u, {cheaper("ga", inserted("gu", NEW_USER))} AS a FROM (
      SELECT way.conv_id, way.i - 1 AS i, {row_edits("h0")} AS g0, {row_edits("hs")} AS gs, {row_edits("hu")} AS gu,
        {row_edits("ha")} AS ga FROM way JOIN f ON f.conv_id IS NOT DISTINCT FROM way.conv_id AND f.i = way.i))
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(substr(h0.k, 1, 12)::BIGINT, 0) AS cost, coalesce(substr(h0.k, 13), '') AS audit,
  sha256(coalesce(substr(h0.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN way ON way.conv_id IS NOT DISTINCT FROM o.conv_id AND way.i = 0
"""

SQL = {
    "op1_host_rules": HOST_RULES,
    "op2_decontaminate": DECONTAMINATE,
    "op3_line_dedup": LINE_DEDUP,
    "op4_setsketch": NEAR_DUPLICATES,
    "op6_revisits": REVISITS,
    "op8_shards": SHARDS,
    "op9_raking": RAKING,
    "op10_url_filter": URL_FILTER,
    "op11_spelling": SPELLING,
    "op12_conversations": CONVERSATIONS,
}
