"""DuckDB SQL for those training-data queries that SQL can express."""

from __future__ import annotations

from corpusmill.llm import quality

_SPACE = r"[\x20\x09-\x0D]"


def exact_dedup() -> str:
    return f"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '{_SPACE}+', '', 'g')) AS sha FROM documents),
k AS (SELECT doc_id, sha, first_value(doc_id) OVER (PARTITION BY sha ORDER BY chars DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY sha) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha AS text_sha256 FROM k"""


def _base32(hex40: str) -> str:
    """SHA-1 hex digits as base32: 160 bits, read five at a time."""
    nibbles = "".join(f"{i:04b}" for i in range(16))
    bits = f"array_to_string(list_transform(string_split({hex40}, ''), lambda c: substr('{nibbles}', 4 * strpos('0123456789abcdef', c) - 3, 4)), '')"
    value = " + ".join(f"{16 >> k} * CAST(substr(bits, 5 * i + {k + 1}, 1) AS INTEGER)" for k in range(5))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return f"(SELECT string_agg(substr('{letters}', {value} + 1, 1), '' ORDER BY i) FROM (SELECT {bits} AS bits), unnest(range(0, 32)) AS r(i))"


def warc() -> str:
    return f"""WITH p AS (SELECT page_id, regexp_replace(url, '[\\r\\n]', '%0A', 'g') AS url, coalesce(html, '') AS body FROM pages),
s AS (SELECT page_id, url, strlen(body) AS payload_bytes, sha1(body) AS sha FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS origin FROM s),
b AS (SELECT sha, {_base32('sha')} AS payload_digest FROM (SELECT DISTINCT sha FROM s))
SELECT page_id, url, payload_bytes, payload_digest, CASE WHEN page_id = origin THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> origin THEN origin END AS refers_to
FROM f JOIN b USING (sha)"""


def _passes() -> str:
    parts = []
    for r in quality.RULES:
        bounds = [f"{r.measure} >= {r.low}"] * (r.low is not None) + [f"{r.measure} <= {r.high}"] * (r.high is not None)
        parts.append(f"(n_words < {r.from_words} OR ({' AND '.join(bounds)}))")
    return " AND ".join(parts)


def quality_rules(min_words: int = 20, max_repeat_percent: int = 30) -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))
    size = quality.WINDOW
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
x AS (SELECT *, list_filter(regexp_split_to_array(t, '{_SPACE}+'), lambda w: w <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
v AS (SELECT r, i, array_to_string(w[i : i + {size - 1}], ' ') AS v FROM x, unnest(range(1, len(w) - {size - 2})) AS u(i)),
h AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, v) AS c FROM v) WHERE c > 1),
g AS (SELECT r, sum(n)::BIGINT AS n_repeat_words FROM
    (SELECT r, least({size}, i - coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), i - {size})) AS n FROM h) GROUP BY r),
c AS (SELECT doc_id, t, w, l, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words FROM x LEFT JOIN g USING (r)),
m AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    word_chars::DOUBLE / greatest(n_words, 1) AS mean_word_chars, n_symbols::DOUBLE / greatest(n_words, 1) AS symbols_per_word,
    n_dup_lines::DOUBLE / greatest(len(l), 1) AS dup_line_ratio,
    length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g'))::DOUBLE / greatest(length(t), 1) AS upper_ratio,
    len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}')))::DOUBLE / greatest(n_words, 1) AS words_with_letter,
    len(list_filter(w, lambda x: lower(x) IN ({stop})))::DOUBLE / greatest(n_words, 1) AS stop_word_ratio,
    len(list_filter(l, lambda x: regexp_matches(x, '\\p{{P}}{_SPACE}*$')))::DOUBLE / greatest(len(l), 1) AS ended_lines,
    n_words < {min_words} OR n_repeat_words * 100 > n_words * {max_repeat_percent} AS base_failed FROM c)
SELECT *, NOT base_failed AND {_passes()} AS kept FROM m"""


# The CRC-32 table (reflected polynomial), and the CRC of ASCII text ``x``.
_CRC_TABLE = """crc_step AS (SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)),
crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS steps FROM crc_step)"""


def _crc32(x: str) -> str:
    codes = f"list_transform(range(1, length({x}) + 1), lambda i: ord(substr({x}, i, 1))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"


_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def merkle(levels: int = 9, group_levels: int = 5) -> str:
    """Whole trees, level by level: room for 8 ** levels documents of a language."""
    part = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR))::VARCHAR || ':' || CAST({x} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    hit = "3 * (crc // 3) = crc"
    out = f"""WITH {_CRC_TABLE},
b AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS key, {leaf('text')} AS leaf, {leaf(_AZ.format('text'))} AS changed,
    {_crc32("coalesce(CAST(doc_id AS VARCHAR), '')")} AS crc FROM documents, crc),
r AS MATERIALIZED (SELECT doc_id, key, leaf, CASE WHEN {hit} THEN changed ELSE leaf END AS changed, row_number() OVER () AS id,
    row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY key) AS n FROM b),
a0 AS (SELECT key, pos, n, leaf AS h FROM r), f0 AS (SELECT id, key, pos, changed AS cur, '' AS siblings FROM r)"""

    def climb(tree: str, walk: str, top: int) -> str:
        parts = []
        for k in range(top):
            parts.append(f"""{tree}{k + 1} AS MATERIALIZED (SELECT key, pos // 8 AS pos, (any_value(n) + 7) // 8 AS n,
    CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h FROM {tree}{k} GROUP BY key, pos // 8),
{walk}{k + 1} AS MATERIALIZED (SELECT f.id, f.key, f.pos // 8 AS pos,
    CASE WHEN any_value(a.n) > 1 THEN sha256(string_agg(CASE WHEN a.pos = f.pos THEN f.cur ELSE a.h END, '' ORDER BY a.pos)) ELSE f.cur END AS cur,
    f.siblings || coalesce(string_agg(a.h, '' ORDER BY a.pos) FILTER (a.pos <> f.pos), '') AS siblings
    FROM {walk}{k} f JOIN {tree}{k} a ON a.key = f.key AND a.pos // 8 = f.pos // 8 GROUP BY f.id, f.key, f.pos, f.cur, f.siblings)""")
        return ",\n".join(parts)

    return f"""{out},
{climb('a', 'f', levels)},
s AS (SELECT key, h AS subroot, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM a{levels}),
c0 AS (SELECT 0 AS key, pos, n, subroot AS h FROM s),
g0 AS (SELECT f.id, 0 AS key, s.pos, f.cur, f.siblings FROM f{levels} f JOIN s ON s.key = f.key),
{climb('c', 'g', group_levels)}
SELECT r.doc_id, r.leaf, s.subroot, c.h AS root, sha256(g.siblings) AS proof_sha256, g.cur AS folded_root, g.cur = c.h AS verified
FROM r JOIN s ON s.key = r.key JOIN g{group_levels} g ON g.id = r.id JOIN c{group_levels} c ON c.key = 0"""


def conversation_repair() -> str:
    """The cheapest, ASCII-least audit per state, row by row; then the repaired rows."""
    give, kept = (2, 2, 3, 2), {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    steps, ends = [], []
    for start in range(4):
        q = start
        for inserts in range(3):
            audit = "I" * inserts
            steps.append((start, "D", "", q, 3 * inserts + 4, audit + "D"))
            steps.append((start, "R", "", give[q], 3 * inserts + 3, audit + "R"))
            steps += [(start, "K", x, target, 3 * inserts, audit + "K") for (state, x), target in kept.items() if state == q]
            if q in (0, 3):
                ends.append((start, 3 * inserts, audit))
            q = give[q]
    rows = lambda values: ", ".join(str(v) for v in values)
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    name = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    return f"""WITH RECURSIVE {_CRC_TABLE},
x AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32(name)} % 20 AS fate FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
    FROM x WHERE fate <> 0),
o AS (SELECT CASE WHEN conv_id IS NULL THEN '' ELSE '=' || conv_id END AS ck, turn, role, text, substr(role, 1, 1) AS initial, rtrim(text, {blanks}) AS shown,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
k AS (SELECT *, shown = '' AS blank, shown <> '' AND row_number() OVER (PARTITION BY ck, role, text ORDER BY i) > 1 AS again,
    lag(initial) OVER (PARTITION BY ck ORDER BY i) AS before FROM o),
r AS MATERIALIZED (SELECT *, NOT blank AND NOT again AND right(shown, 1) NOT IN ('.', '!', '?') AS cut FROM k),
steps(q1, edit, initial, q2, c, a) AS (VALUES {rows(steps)}), ends(q1, c, a) AS (VALUES {rows(ends)}),
dp AS (SELECT DISTINCT ck, 0::BIGINT AS i, 0 AS q, 0::BIGINT AS cost, '' AS audit FROM r
    UNION ALL SELECT ck, i, q, cost, audit FROM (
      SELECT p.ck, r.i, e.q2 AS q, p.cost + e.c + CASE WHEN r.cut AND e.edit <> 'D' THEN 3 ELSE 0 END AS cost, p.audit || e.a AS audit,
        row_number() OVER (PARTITION BY p.ck, e.q2 ORDER BY p.cost + e.c + CASE WHEN r.cut AND e.edit <> 'D' THEN 3 ELSE 0 END, p.audit || e.a) AS nth
      FROM dp p JOIN r ON r.ck = p.ck AND r.i = p.i + 1
      JOIN steps e ON e.q1 = p.q AND (e.edit = 'D' OR (NOT r.blank AND NOT r.again AND (e.edit = 'R' OR e.initial = r.initial)))) WHERE nth = 1),
w AS (SELECT ck, cost, audit FROM (SELECT dp.ck, dp.cost + ends.c AS cost, dp.audit || ends.a AS audit, row_number() OVER (PARTITION BY dp.ck ORDER BY dp.cost + ends.c, dp.audit || ends.a) AS nth
    FROM dp JOIN (SELECT ck, max(i) AS i FROM r GROUP BY ck) l ON l.ck = dp.ck AND l.i = dp.i JOIN ends ON ends.q1 = dp.q) WHERE nth = 1),
e AS (SELECT ck, p, substr(audit, p, 1) AS edit, length(replace(substr(audit, 1, p), 'I', '')) AS i FROM (SELECT ck, audit, unnest(range(1, length(audit) + 1)) AS p FROM w)),
m AS (SELECT e.ck, e.p, e.edit, r.role, r.initial, CASE WHEN e.edit = 'I' THEN '' ELSE r.text END AS text, row_number() OVER (PARTITION BY e.ck ORDER BY e.p) AS nth
    FROM e LEFT JOIN r ON r.ck = e.ck AND r.i = e.i AND e.edit <> 'I' WHERE e.edit <> 'D'),
z AS (SELECT ck, coalesce(max(CASE WHEN nth = 1 AND edit = 'K' AND initial = 's' THEN 1 END), 0) AS led FROM m GROUP BY ck),
t AS (SELECT m.ck, string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS whole FROM m JOIN z ON z.ck = m.ck GROUP BY m.ck),
f AS (SELECT ck, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY ck),
n AS (SELECT DISTINCT conv_id, CASE WHEN conv_id IS NULL THEN '' ELSE '=' || conv_id END AS ck FROM conversations)
SELECT n.conv_id, coalesce(f.gaps, 0)::BIGINT AS gaps, coalesce(f.blank, 0)::BIGINT AS blank, coalesce(f.duplicate, 0)::BIGINT AS duplicate, coalesce(f.truncated, 0)::BIGINT AS truncated,
    coalesce(f.illegal, 0)::BIGINT AS illegal, coalesce(w.cost, 0)::BIGINT AS cost, coalesce(w.audit, '') AS audit, sha256(coalesce(t.whole, '')) AS repaired_sha256
FROM n LEFT JOIN f ON f.ck = n.ck LEFT JOIN w ON w.ck = n.ck LEFT JOIN t ON t.ck = n.ck"""
