"""DuckDB spellings of the shared contracts, for the oracle SQL."""

from __future__ import annotations


def tok(x: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"


def shash(x: str) -> str:
    return f"('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 15))::BIGINT"


K1, B = 1.2, 0.75


def bm25_ctes(field_rows: str, query_terms: str) -> str:
    """CTEs ending in ``scores(query_id, doc_id, score)``.

    field_rows: SELECT doc_id, w, text   (one row per document field)
    query_terms: SELECT query_id, term[, qw]  (distinct per query)
    """
    return f"""
fr AS ({field_rows}),
dl AS (SELECT doc_id, sum(w * len({tok('text')}))::DOUBLE AS dl FROM fr GROUP BY doc_id),
st AS (SELECT count(*) AS n, sum(dl) / count(*) AS avgdl FROM dl),
pt AS (SELECT doc_id, w, unnest({tok('text')}) AS term FROM fr),
p AS (SELECT doc_id, term, sum(w)::DOUBLE AS tf FROM pt GROUP BY doc_id, term),
dfs AS (SELECT term, count(*) AS df FROM p GROUP BY term),
qt AS ({query_terms}),
scores AS (
  SELECT qt.query_id, p.doc_id,
         round(sum(qt.qw * ln(1 + (st.n - dfs.df + 0.5) / (dfs.df + 0.5)) * p.tf * {K1 + 1}
                   / (p.tf + {K1} * ({1 - B} + {B} * dl.dl / st.avgdl))), 6) AS score
  FROM qt JOIN p ON qt.term = p.term JOIN dfs ON dfs.term = p.term JOIN dl ON dl.doc_id = p.doc_id CROSS JOIN st
  GROUP BY qt.query_id, p.doc_id
)"""


def distinct_terms(table: str, id_expr: str, text: str, extra_where: str = "") -> str:
    return (
        f"SELECT DISTINCT query_id, term, 1.0 AS qw FROM (SELECT {id_expr} AS query_id, unnest({tok(text)}) AS term "
        f"FROM {table} {extra_where})"
    )


def top_k(scores: str, k: int, key: str = "query_id", score: str = "score", tie: str = "doc_id", cols: str = "query_id, doc_id, rank, score") -> str:
    return (
        f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {score} DESC, {tie}) AS rank "
        f"FROM {scores}) WHERE rank <= {k}"
    )


def sentences(x: str) -> str:
    return (
        rf"list_filter(list_transform(regexp_split_to_array(regexp_replace({x}, '([.!?])\s+', '\1' || chr(10), 'g'), '\n+'), "
        rf"lambda s: trim(s)), lambda s: s <> '')"
    )


def unescape(x: str) -> str:
    for a, b in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")]:
        x = f"replace({x}, '{a}', '{b}')"
    return x


def squash(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"
HREF_RE = r'(?i)href="([^"]*)"'


def page_docs(table: str = "pages") -> str:
    """SELECT doc_id, title, body, links FROM pages, as html_to_corpus does."""
    body = "html"
    for pat in [r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->", TITLE_RE, r"<[^>]*>"]:
        body = f"regexp_replace({body}, '{pat}', ' ', 'g')"
    return (
        f"SELECT page_id AS doc_id, {squash(unescape(f'regexp_extract(html, {chr(39)}{TITLE_RE}{chr(39)}, 1)'))} AS title, "
        f"{squash(unescape(body))} AS body, regexp_extract_all(html, '{HREF_RE}', 1) AS links FROM {table}"
    )


def nb_ctes(train: str, score: str, tok_fn=None) -> str:
    """CTEs ending in ``sc(row_id, label, score)`` and ``pr(row_id, label, score, prob)``.

    train: SELECT row_id, label, text ; score: SELECT row_id, text.
    tok_fn turns the text column into a token list (default: the shared tokens)."""
    tk = tok_fn or tok
    return f"""
tr AS ({train}), te AS ({score}),
tt AS (SELECT row_id, label, unnest({tk('text')}) AS term FROM tr),
tc AS (SELECT label, term, count(*)::DOUBLE AS n FROM tt GROUP BY label, term),
tl AS (SELECT row_id, label, count(*)::DOUBLE AS len FROM tt GROUP BY row_id, label),
cc AS (SELECT tr.label, count(*)::DOUBLE AS docs, coalesce(sum(tl.len), 0)::DOUBLE AS len FROM tr LEFT JOIN tl ON tl.row_id = tr.row_id AND tl.label = tr.label GROUP BY tr.label),
vv AS (SELECT count(DISTINCT term)::DOUBLE AS v FROM tc),
nn AS (SELECT sum(docs) AS n FROM cc),
st AS (SELECT row_id, term, count(*)::DOUBLE AS cnt FROM (SELECT row_id, unnest({tk('text')}) AS term FROM te) GROUP BY row_id, term),
kn AS (SELECT * FROM st WHERE term IN (SELECT term FROM tc)),
ll AS (SELECT row_id, sum(cnt) AS L FROM kn GROUP BY row_id),
base AS (SELECT r.row_id, cc.label, ln(cc.docs / nn.n) - coalesce(ll.L, 0) * ln(cc.len + vv.v) AS s
         FROM (SELECT DISTINCT row_id FROM te) r LEFT JOIN ll ON ll.row_id = r.row_id CROSS JOIN cc CROSS JOIN vv CROSS JOIN nn),
bonus AS (SELECT kn.row_id, tc.label, sum(kn.cnt * ln(tc.n + 1)) AS b FROM kn JOIN tc ON tc.term = kn.term GROUP BY kn.row_id, tc.label),
sc AS (SELECT base.row_id, base.label, round(s + coalesce(b, 0), 4) AS score FROM base LEFT JOIN bonus ON bonus.row_id = base.row_id AND bonus.label = base.label),
mx AS (SELECT *, max(score) OVER (PARTITION BY row_id) AS m FROM sc),
pr AS (SELECT row_id, label, score, round(exp(score - m) / sum(exp(score - m)) OVER (PARTITION BY row_id), 6) AS prob FROM mx)"""


def nb_top(k: int) -> str:
    return (
        "SELECT row_id, label, score, prob, rank FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, label) AS rank FROM pr) "
        f"WHERE rank <= {k}"
    )


def bucket(seed, col: str) -> str:
    return f"({shash(chr(39) + str(seed) + ':' + chr(39) + ' || CAST(' + col + ' AS VARCHAR)')} % 1000000)"


def luhn(m: str) -> str:
    rev = f"reverse(regexp_replace({m}, '[^0-9]', '', 'g'))"
    d = f"CAST(substring({rev}, i + 1, 1) AS INTEGER)"
    return (
        f"(length({rev}) BETWEEN 13 AND 19 AND coalesce(list_sum(list_transform(range(length({rev})), lambda i: "
        f"CASE WHEN i % 2 = 1 THEN (CASE WHEN {d} * 2 > 9 THEN {d} * 2 - 9 ELSE {d} * 2 END) ELSE {d} END)), 0) % 10 = 0)"
    )


def mod97(m: str) -> str:
    s = f"upper(replace({m}, ' ', ''))"
    r = f"(substring({s}, 5, 100) || substring({s}, 1, 4))"
    exp = (
        f"array_to_string(list_transform(string_split({r}, ''), lambda ch: CASE WHEN regexp_matches(ch, '[0-9]') THEN ch "
        f"ELSE CAST(ascii(ch) - 55 AS VARCHAR) END), '')"
    )
    return f"(list_reduce(list_transform(string_split({exp}, ''), lambda ch: CAST(ch AS BIGINT)), lambda acc, x: (acc * 10 + x) % 97, 0::BIGINT) = 1)"


def pii_chain(source: str, keep: str = "doc_id") -> str:
    """CTEs ending in pm({keep}, f0..f{n-1}, masked) following corpusmill.functions.pii.RULES."""
    from corpusmill.functions.pii import RULES

    ctes = [f"pc0 AS (SELECT {keep}, text AS t0 FROM ({source}))"]
    for i, (kind, pat, check) in enumerate(RULES):
        sp = pat.replace("'", "''")
        found = every = f"regexp_extract_all(t{i}, '{sp}', 0)"
        if check:
            fn = luhn if check == "luhn" else mod97
            found = f"list_filter({found}, lambda m: {fn('m')})"
        ctes.append(f"pf{i} AS (SELECT *, {found} AS f{i} FROM pc{i})")
        if check:
            put = f"list_append(list_transform({every}, lambda m: CASE WHEN {fn('m')} THEN '[{kind}]' ELSE m END), '')"
            nxt = f"array_to_string(list_transform(list_zip(regexp_split_to_array(t{i}, '{sp}'), {put}), lambda z: z[1] || z[2]), '')"
        else:
            nxt = f"regexp_replace(t{i}, '{sp}', '[{kind}]', 'g')"
        ctes.append(f"pc{i + 1} AS (SELECT * EXCLUDE (t{i}), {nxt} AS t{i + 1} FROM pf{i})")
    n = len(RULES)
    ctes.append(f"pm AS (SELECT * EXCLUDE (t{n}), t{n} AS masked FROM pc{n})")
    return ",\n".join(ctes)
