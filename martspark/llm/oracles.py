"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

from . import license_join as J

MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source
), l AS (
  SELECT *, 2 * source_size AS most, row_number() OVER o AS nth,
         (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
          - coalesce(CAST(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
         / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM s WINDOW o AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST)
), t AS (
  SELECT source, source_size,
         least(CAST(most AS DOUBLE), (SELECT arg_min(level, nth) FROM l WHERE level * weight <= most) * weight) AS target
  FROM l
), r AS (
  SELECT d.*, t.source_size, t.target,
         row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS nth,
         CAST('0x' || substr(md5('mix' || coalesce('=' || d.source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u,
         CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0.0::DOUBLE END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(u + rate * nth) - floor(u + rate * (nth - 1))) AS BIGINT) AS taken
FROM r
"""

LINE_RULES = r"""
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d
), five AS (
  SELECT doc_id, pos, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS five
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), twice AS (
  SELECT doc_id, pos, five IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, five) > 1 AS twice FROM five
), hit AS (
  SELECT doc_id, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM twice
), rep AS (
  SELECT doc_id, count(*) FILTER (WHERE hit) AS n FROM hit GROUP BY doc_id
), raw_lines AS (
  SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM d
), l AS (
  SELECT doc_id, host, line, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS norm,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l GROUP BY doc_id
), above AS (      -- distinct documents: distinct texts
  SELECT l.host, norm FROM l JOIN (SELECT doc_id, md5(text) AS own FROM d) USING (doc_id) GROUP BY l.host, norm HAVING count(DISTINCT own) > 20
), gone AS (
  SELECT l.doc_id, sum(n) AS n FROM l JOIN above ON l.norm = above.norm AND l.host IS NOT DISTINCT FROM above.host GROUP BY l.doc_id
), r AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(words) - coalesce(gone.n, 0) AS BIGINT) AS words_left
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND words_left >= 0.3::DOUBLE * n_words AS kept
FROM r
"""

REPEATS = r"""
WITH h AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), piece AS (      -- 100 windows each
  SELECT doc_id, p, substr(hx, 2 * p + 1, 398) AS px, least(100, n - 99 - p) AS many FROM (SELECT *, unnest(range(0, n - 99, 100)) AS p FROM h WHERE n >= 100)
), win AS (
  SELECT doc_id, p + k AS s, md5_number(substr(px, 2 * k + 1, 200)) AS g FROM (SELECT *, unnest(range(0, many)) AS k FROM piece)
), seen AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS nth FROM win
), again AS (
  SELECT doc_id, s, coalesce(s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) > 100, true) AS new FROM seen WHERE nth > 1
), island AS (
  SELECT doc_id, s, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM again
), span AS (
  SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM island GROUP BY doc_id, k
), edge AS (
  SELECT h.doc_id, coalesce(lag(b) OVER (PARTITION BY h.doc_id ORDER BY a), 0) AS p, a AS q FROM span JOIN h USING (doc_id)
  UNION ALL SELECT h.doc_id, coalesce((SELECT max(b) FROM span WHERE span.doc_id = h.doc_id), 0), h.n FROM h
), kept AS (
  SELECT edge.doc_id, string_agg(substr(hx, 2 * p + 1, 2 * (q - p)), '' ORDER BY p) AS kept FROM edge JOIN h USING (doc_id) GROUP BY edge.doc_id
)
SELECT h.doc_id, CAST(h.n AS BIGINT) AS n_bytes, CAST(h.n - length(kept) / 2 AS BIGINT) AS n_removed,
       CAST((SELECT count(*) FROM span WHERE span.doc_id = h.doc_id) AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM h JOIN kept USING (doc_id)
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v(conv_id, turn, role, text)
), s AS (
  SELECT *, row_number() OVER o - 1 AS pos, coalesce(lag(role) OVER o, 'start') AS prev,
         14 + length(role) + length(text) + len(regexp_extract_all(role, '[\\#:<]')) + len(regexp_extract_all(text, '[\\#:<]')) AS chars
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), g AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
         CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
         sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY pos)) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars,
         min(pos) FILTER (WHERE (prev, role) NOT IN (('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user'))) AS bad_turn,
         arg_max(role, pos) AS ending
  FROM s GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
       CASE WHEN bad_turn IS NOT NULL THEN 'order' WHEN ending = 'assistant' THEN 'ok' ELSE 'open' END AS verdict, bad_turn
FROM g
"""

COLLOCATIONS = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents
), p AS (
  SELECT doc, lang, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS nth FROM d
), s AS (
  SELECT doc, lang, nth, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
), w AS (
  SELECT doc, lang, nth, unnest(words) AS w1, generate_subscripts(words, 1) AS pos FROM s
), ahead AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY doc, nth ORDER BY pos)
), one AS (SELECT lang, w1, count(*) AS f FROM ahead GROUP BY ALL
), two AS (SELECT lang, w1, w2, count(*) AS a FROM ahead WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), three AS (SELECT lang, w1, w2, w3, count(*) AS a FROM ahead WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang
), longer AS (
  SELECT lang, w1, w2, max(a) AS most FROM (SELECT lang, w1, w2, a FROM three UNION ALL SELECT lang, w2, w3, a FROM three) GROUP BY ALL
), cut AS (
  SELECT lang, w1 || ' ' || w2 AS phrase, a, x.f AS l, y.f AS r, 1 AS k
  FROM two JOIN one x USING (lang, w1) JOIN one y ON y.lang = two.lang AND y.w1 = two.w2 LEFT JOIN longer USING (lang, w1, w2)
  WHERE most IS NULL OR 100 * most < 50 * a
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, x.f, y.a, 1 FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, x.a, y.f, 2 FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w1 = t.w3
), scored AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cut
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def vector_codes() -> str:
    """For vectors of 64 components: 16 parts of four."""
    four = lambda f: ", ".join(f(c) for c in "abcd")
    way = " + ".join(f"(x.{c} - k.{c}) * (x.{c} - k.{c})" for c in "abcd")

    def near(n: int) -> str:
        return (f"n{n} AS (SELECT r, part, min(({way}) * 64 + k.entry) AS found FROM x JOIN k{n} k USING (part) GROUP BY ALL)")

    def mean(n: int) -> str:
        floor = four(lambda c: f"(sum({c}) - ((sum({c}) % count(*)) + count(*)) % count(*)) // count(*) AS {c}")
        return (f"m{n} AS (SELECT part, found % 64 AS entry, {floor} FROM x JOIN n{n} USING (r, part) GROUP BY ALL), "
                f"k{n + 1} AS (SELECT part, entry, {four(lambda c: f'CAST(coalesce(m.{c}, k.{c}) AS BIGINT) AS {c}')} FROM k{n} k LEFT JOIN m{n} m USING (part, entry))")

    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
), x AS (
  SELECT r, part, {four(lambda c: f"CAST(floor(256 * CAST(embedding[4 * part + {1 + 'abcd'.index(c)}] AS DOUBLE)) AS BIGINT) AS {c}")}
  FROM (SELECT r, embedding, unnest(range(16)) AS part FROM v)
), k0 AS (SELECT part, r AS entry, a, b, c, d FROM x WHERE r < 64), {near(0)}, {mean(0)}, {near(1)}, {mean(1)}, {near(2)}, e AS (
  SELECT r, string_agg(printf('%02x', CAST(found % 64 AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(found // 64) AS BIGINT) AS error FROM n2 GROUP BY r
), b AS (
  SELECT sha256(string_agg(a || ',' || b || ',' || c || ',' || d, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM k2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM e JOIN v USING (r) CROSS JOIN b
"""


def licenses() -> str:
    values = lambda rows: ", ".join("(" + ", ".join(repr(x) for x in r) + ")" for r in rows)
    tokens = [(i, label, w) for i, (label, t, _) in enumerate(J.TEMPLATES) for w in sorted(set(t.split()))]
    need = [(i, len(set(t.split())), -(-round(len(set(t.split())) * J.THRESHOLD * 1000) // 1000)) for i, (_, t, _) in enumerate(J.TEMPLATES)]
    anchors = [(i, *(a.split() + [""] * 3)[:3], len(a.split())) for i, (_, _, a) in enumerate(J.TEMPLATES)]
    ladder = " ".join(
        "WHEN " + " AND ".join(f"{'word' if k == 0 else f'w{k}'} = '{w}'" for k, w in enumerate(p.split())) + f" THEN '{label}'" for p, label in J.PHRASES)
    return rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), w AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos, len(words) AS n FROM d
), ahead AS (
  SELECT *, lead(word, 1) OVER o AS w1, lead(word, 2) OVER o AS w2 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), base AS (
  SELECT doc_id, pos, CASE {ladder} END AS label FROM ahead
), t(id, label, token) AS (VALUES {values(tokens)}
), size(id, n, need) AS (VALUES {values(need)}
), anchor(id, a0, a1, a2, k) AS (VALUES {values(anchors)}
), stands AS (
  SELECT doc_id, id, pos, k FROM ahead JOIN anchor ON word = a0 AND (k < 2 OR w1 = a1) AND (k < 3 OR w2 = a2)
), block AS (
  SELECT DISTINCT doc_id, unnest([greatest(pos // {J.STRIDE} - 1, 0), least(pos // {J.STRIDE}, greatest(1, (n + {J.STRIDE - 1}) // {J.STRIDE} - 1) - 1)]) AS block, word FROM w
), shared AS (
  SELECT doc_id, block, id, label, count(DISTINCT word) AS has FROM block JOIN t ON word = token GROUP BY ALL
), found AS (
  SELECT doc_id, label, CAST(has AS DOUBLE) / CAST(n AS DOUBLE) AS share FROM shared s JOIN size USING (id)
  WHERE has >= need AND EXISTS (SELECT 1 FROM stands a WHERE a.doc_id = s.doc_id AND a.id = s.id AND a.pos >= {J.STRIDE} * s.block AND a.pos + a.k <= {J.STRIDE} * (s.block + 2))
), every AS (
  SELECT doc_id, label, 1.0::DOUBLE AS share, pos FROM base WHERE label IS NOT NULL UNION ALL SELECT doc_id, label, share, NULL FROM found
), mine AS (
  SELECT doc_id, count(pos) AS n_base, min(pos) AS first_word, max(pos) AS last_word, max(share) AS score,
         coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE pos IS NOT NULL), '') AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM every GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN mine USING (doc_id)
"""
