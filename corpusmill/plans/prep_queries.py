"""Corpus preparation (P1-P13) and sources (S1-S4, S8-S10) on the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusmill.functions.text import tokens
from corpusmill.operators import prep
from corpusmill.operators.ordered import dense_ids
from corpusmill.plans import sql as q
from corpusmill.plans.registry import load, register
from corpusmill.session import ensure_checkpoint_dir
from corpusmill.sources import corpus as sc
from corpusmill.sources import files, html

NL = "chr(10)"


@register("normalise_documents", f"SELECT doc_id, translate(lower(text), ',' || chr(10) || chr(13), '   ') AS text FROM documents")
def normalise_documents(spark, sf):
    return prep.normalise(load(spark, sf, "documents").select("doc_id", "text"), ["text"])


@register("dense_ids_documents", "SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) - 1 AS dense_id FROM documents")
def dense_ids_documents(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "source")
    return prep.dense_ids(d, ["source", "doc_id"], "dense_id").select("doc_id", "dense_id")


def _bucket_sql(seed, col):
    return f"({q.shash(f'{chr(39)}{seed}:{chr(39)} || CAST({col} AS VARCHAR)')} % 1000000)"


@register("sample_orders", f"SELECT o_orderkey FROM orders WHERE {_bucket_sql(7, 'o_orderkey')} < 100000")
def sample_orders(spark, sf):
    return prep.sample_rows(load(spark, sf, "orders"), 0.1, "o_orderkey", seed=7).select("o_orderkey")


@register(
    "sample_first_documents",
    f"SELECT doc_id FROM documents ORDER BY {q.shash(chr(39) + '3:' + chr(39) + ' || CAST(doc_id AS VARCHAR)')}, doc_id LIMIT 100",
)
def sample_first_documents(spark, sf):
    return prep.sample_first(load(spark, sf, "documents").select("doc_id"), 100, "doc_id", seed=3)


@register(
    "split_labels",
    f"SELECT doc_id, CASE WHEN {_bucket_sql(11, 'doc_id')} < 800000 THEN 'train' ELSE 'test' END AS part FROM labels",
)
def split_labels(spark, sf):
    return prep.split_rows(load(spark, sf, "labels"), {"train": 0.8, "test": 0.2}, "doc_id", seed=11).select("doc_id", "part")


@register(
    "split_labels_positional",
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < round(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS part
       FROM labels""",
)
def split_labels_positional(spark, sf):
    return prep.split_positional(load(spark, sf, "labels").select("doc_id"), ["doc_id"], {"train": 0.8, "test": 0.2})


@register(
    "keep_top_orders",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def keep_top_orders(spark, sf):
    o = load(spark, sf, "orders")
    return prep.keep_top(o, 100, [F.col("o_totalprice").desc(), "o_orderkey"], F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_totalprice"
    )


CHUNK_SQL = f"""WITH s AS (SELECT doc_id, {q.sentences('text')} AS sents FROM documents)
SELECT doc_id, c::BIGINT AS chunk_no, array_to_string(sents[c*5+1 : c*5+5], ' ') AS text
FROM (SELECT doc_id, sents, unnest(range(0, CAST(ceil(len(sents) / 5.0) AS BIGINT))) AS c FROM s)"""


@register("chunk_documents", CHUNK_SQL)
def chunk_documents(spark, sf):
    return prep.chunk_text(load(spark, sf, "documents"), 5)


@register("distinct_texts", "SELECT md5(text) AS text_md5, min(doc_id) AS doc_id FROM documents GROUP BY md5(text)")
def distinct_texts(spark, sf):
    return prep.distinct_texts(load(spark, sf, "documents"))


@register(
    "dedup_insert",
    f"""WITH e AS (SELECT * FROM documents WHERE {q.shash('doc_id')} % 2 = 0),
            i AS (SELECT * FROM documents WHERE {q.shash('doc_id')} % 2 = 1)
        SELECT min(doc_id) AS doc_id FROM i WHERE md5(text) NOT IN (SELECT md5(text) FROM e) GROUP BY md5(text)""",
)
def dedup_insert(spark, sf):
    d = load(spark, sf, "documents")
    h = F.pmod(prep.stable_hash(F.col("doc_id")), F.lit(2))
    return prep.dedup_insert(d.filter(h == 0), d.filter(h == 1)).select("doc_id")


@register(
    "source_fingerprints",
    f"""SELECT source, count(*) AS n_rows,
               bit_xor({q.shash("concat_ws(chr(1), coalesce(CAST(doc_id AS VARCHAR), chr(2)), coalesce(text, chr(2)))")}) AS hash_xor,
               CAST(sum({q.shash("concat_ws(chr(1), coalesce(CAST(doc_id AS VARCHAR), chr(2)), coalesce(text, chr(2)))")}) AS VARCHAR) AS hash_sum
        FROM documents GROUP BY source""",
)
def source_fingerprints(spark, sf):
    return prep.fingerprint(load(spark, sf, "documents"), ["doc_id", "text"], group=["source"])


@register("shard_documents", f"SELECT doc_id, {q.shash('doc_id')} % 4 AS shard FROM documents")
def shard_documents(spark, sf):
    return prep.shard(load(spark, sf, "documents").select("doc_id"), 4).select("doc_id", F.col("shard").cast("bigint"))


def _noisy_sql():
    h = q.shash("CAST(doc_id AS VARCHAR) || ':' || CAST(copy AS VARCHAR)")
    return f"""WITH pd AS ({q.page_docs()}),
b AS (SELECT doc_id, title AS source, c AS copy FROM pd, (SELECT unnest(range(0, 2)) AS c)),
h AS (SELECT *, length(source) AS L, ({h} % greatest(length(source), 1)) + 1 AS pos, ({h} >> 20) % 3 AS op FROM b)
SELECT doc_id, copy::BIGINT AS copy, source,
  CASE WHEN L < 2 THEN source
       WHEN op = 0 THEN substring(source, 1, pos - 1) || substring(source, pos + 1)
       WHEN op = 1 AND pos < L THEN substring(source, 1, pos - 1) || substring(source, pos + 1, 1) || substring(source, pos, 1) || substring(source, pos + 2)
       ELSE substring(source, 1, pos - 1) || substring(source, pos, 1) || substring(source, pos, 1) || substring(source, pos + 1) END AS noisy
FROM h"""


@register("noisy_titles", _noisy_sql())
def noisy_titles(spark, sf):
    pd = html.html_to_corpus(load(spark, sf, "pages"))
    return prep.noisy_queries(pd, "title", "doc_id", copies=2)


@register(
    "cold_start_pages",
    f"""WITH pd AS ({q.page_docs()}),
w AS (SELECT doc_id, {q.tok('body')} AS t FROM pd)
SELECT doc_id, 'strong' AS kind, 0::BIGINT AS piece, array_to_string({q.tok('title')}, ' ') AS query FROM pd
WHERE array_to_string({q.tok('title')}, ' ') <> ''
UNION ALL
SELECT doc_id, 'weak' AS kind, i::BIGINT AS piece, array_to_string(t[i*8+1 : i*8+8], ' ') AS query
FROM (SELECT doc_id, t, unnest(range(0, CAST(ceil(len(t) / 8.0) AS BIGINT))) AS i FROM w)""",
)
def cold_start_pages(spark, sf):
    pd = html.html_to_corpus(load(spark, sf, "pages"))
    return prep.cold_start_pairs(pd, "doc_id", "title", "body", 8)


LM_SQL = f"""WITH c AS (SELECT conv_id, turn, role, text,
       lag(text, 2) OVER (PARTITION BY conv_id ORDER BY turn) AS t2,
       lag(text, 1) OVER (PARTITION BY conv_id ORDER BY turn) AS t1 FROM conversations),
x AS (SELECT conv_id, turn, coalesce({q.tok('t2')}, []) AS c, coalesce({q.tok('t1')}, []) AS p, {q.tok('text')} AS y
      FROM c WHERE role = 'assistant')
SELECT conv_id, turn, len(c) + len(p) + len(y) AS n_tokens,
       array_to_string(list_concat(list_concat(c, p), y), ' ') AS tokens_text,
       repeat('0', len(c) + len(p)) || repeat('1', len(y)) AS labels
FROM x"""


@register("lm_examples", LM_SQL)
def lm_examples(spark, sf):
    e = prep.lm_examples(load(spark, sf, "conversations"))
    return e.select(
        "conv_id", "turn", F.size("tokens").cast("bigint").alias("n_tokens"),
        F.array_join("tokens", " ").alias("tokens_text"),
        F.array_join(F.transform("labels", lambda x: x.cast("string")), "").alias("labels"),
    )


PACK_SQL = f"""WITH e AS (SELECT conv_id, turn, {q.tok('text')} AS toks FROM conversations),
o AS (SELECT *, coalesce(sum(len(toks)) OVER (ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM e),
t AS (SELECT off, unnest(toks) AS token, unnest(range(len(toks))) AS p FROM o)
SELECT 0::BIGINT AS shard, ((off + p) // 2048)::BIGINT AS block, count(*) AS n_tokens,
       string_agg(token, ' ' ORDER BY off + p) AS text FROM t GROUP BY 2"""


@register("pack_conversations", PACK_SQL)
def pack_conversations(spark, sf):
    e = load(spark, sf, "conversations").select("conv_id", "turn", tokens("text").alias("tokens"))
    p = prep.pack_tokens(e, 2048, 1)
    return p.select(F.col("shard").cast("bigint"), "block", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", " ").alias("text"))


# ---- sources -------------------------------------------------------------

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@register("csv_round_trip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_round_trip(spark, sf):
    path = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    files.write_table(load(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars"), path)
    return files.read_corpus_csv(spark, path, DOC_SCHEMA)


@register(
    "bind_roles_part",
    "SELECT p_partkey AS doc_id, p_name AS strong, concat_ws(' ', p_brand, p_type) AS weak, p_size, p_retailprice FROM part",
)
def bind_roles_part(spark, sf):
    b = sc.bind_roles(load(spark, sf, "part"), "p_partkey", ["p_name"], ["p_brand", "p_type"], ["p_size", "p_retailprice"])
    return b.select("doc_id", "strong", "weak", "ref.p_size", "ref.p_retailprice")


@register(
    "corpus_from_conversation_lines",
    f"""SELECT source, c::BIGINT AS chunk_no, lines[c + 1] AS text FROM (
          SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS source, string_split(text, {NL}) AS lines,
                 unnest(range(len(string_split(text, {NL})))) AS c FROM conversations)""",
)
def corpus_from_conversation_lines(spark, sf):
    c = load(spark, sf, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("name"),
        F.split("text", "\n").alias("texts"),
    )
    return sc.corpus_from_texts(c, "name", "texts")


@register(
    "qrels_from_lineitem",
    """SELECT query, TRY_CAST(trim(x) AS BIGINT) AS doc_id FROM (
         SELECT l_returnflag || l_linestatus AS query,
                unnest(string_split(concat_ws(':', l_orderkey, l_partkey, l_suppkey, 'x'), ':')) AS x FROM lineitem)
       WHERE TRY_CAST(trim(x) AS BIGINT) IS NOT NULL""",
)
def qrels_from_lineitem(spark, sf):
    li = load(spark, sf, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("q"),
        F.concat_ws(":", "l_orderkey", "l_partkey", "l_suppkey", F.lit("x")).alias("ids"),
    )
    return sc.read_qrels(li, "q", "ids", ":")


@register(
    "html_corpus",
    f"SELECT doc_id, title, body, len(links)::BIGINT AS n_links, array_to_string(links, ' ') AS links FROM ({q.page_docs()})",
)
def html_corpus(spark, sf):
    d = html.html_to_corpus(load(spark, sf, "pages"))
    return d.select("doc_id", "title", "body", F.size("links").cast("bigint").alias("n_links"), F.array_join("links", " ").alias("links"))


@register(
    "bind_roles_pages",
    f"SELECT p.doc_id, p.title AS strong, p.body AS weak, g.url FROM ({q.page_docs()}) p JOIN pages g ON g.page_id = p.doc_id",
)
def bind_roles_pages(spark, sf):
    pages = load(spark, sf, "pages")
    d = html.html_to_corpus(pages).join(pages.select(F.col("page_id").alias("doc_id"), "url"), "doc_id")
    return sc.bind_roles(d, "doc_id", "title", "body", ["url"]).select("doc_id", "strong", "weak", "ref.url")


def _edges_sql():
    href = "href"
    res = (
        f"CASE WHEN regexp_matches(lower({href}), '^[a-z]+://') THEN {href} "
        f"WHEN starts_with({href}, '/') THEN regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) || {href} "
        f"ELSE regexp_extract(url, '^([^?#]*/)', 1) || {href} END"
    )
    return f"""SELECT DISTINCT l.src, p.page_id AS dst FROM
      (SELECT page_id AS src, {res} AS u FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '{q.HREF_RE}', 1)) AS href FROM pages)) l
      JOIN pages p ON p.url = l.u"""


@register(
    "link_reach_pages",
    f"""WITH RECURSIVE e AS ({_edges_sql()}),
r(start, page_id, depth) AS (
  SELECT page_id, page_id, 0 FROM pages
  UNION
  SELECT r.start, e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.page_id WHERE r.depth < 2)
SELECT start, page_id, min(depth)::BIGINT AS depth FROM r GROUP BY start, page_id""",
)
def link_reach_pages(spark, sf):
    pages = load(spark, sf, "pages")
    return html.link_reach(pages, pages.select(F.col("page_id").alias("start")), 2)


# A stored link table made from the pages' urls: within a language folder every page links to the next number
# and to the one five places on.
_FOLDER, _NUMBER = r"^[a-z]+://[^/]+/([a-z]+)/", r"^[a-z]+://[^/]+/[a-z]+/([0-9]+)"
PATH_LINKS_SQL = f"""SELECT src, unnest([one, five]) AS dst FROM (
  SELECT page_id AS src, lead(page_id, 1) OVER w AS one, lead(page_id, 5) OVER w AS five FROM pages
  WINDOW w AS (PARTITION BY regexp_extract(url, '{_FOLDER}', 1) ORDER BY coalesce(TRY_CAST(regexp_extract(url, '{_NUMBER}', 1) AS BIGINT), -1), page_id))"""


@register(
    "link_reach_paths",
    f"""WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM ({PATH_LINKS_SQL}) WHERE dst IS NOT NULL),
r(start, page_id, depth) AS (
  SELECT page_id, page_id, 0 FROM pages
  UNION
  SELECT r.start, e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.page_id WHERE r.depth < 3)
SELECT start, page_id, min(depth)::BIGINT AS depth FROM r GROUP BY start, page_id""",
)
def link_reach_paths(spark, sf):
    """S9 over stored links that resolve, three steps from every page."""
    pages = load(spark, sf, "pages")
    numbered = pages.select(
        "page_id", F.regexp_extract("url", _FOLDER, 1).alias("folder"),
        F.coalesce(F.expr(f"try_cast(regexp_extract(url, r'{_NUMBER}', 1) AS BIGINT)"), F.lit(-1)).alias("number"),
    )
    # places within a folder from dense numbers, so that a folder of any size is no single window
    placed = dense_ids(numbered, ["folder", "number", "page_id"], "place")
    other = placed.select("folder", F.col("page_id").alias("dst"), "place")
    steps = placed.select(F.col("page_id").alias("src"), "folder", F.explode(F.array(F.col("place") + 1, F.col("place") + 5)).alias("place"))
    return html.link_reach(pages, pages.select(F.col("page_id").alias("start")), 3, steps.join(other, ["folder", "place"]).select("src", "dst"))


@register(
    "union_sources",
    f"""SELECT 0::BIGINT AS source_id, doc_id, text FROM documents
        UNION ALL SELECT 1::BIGINT, item_id, text FROM benchmark
        UNION ALL SELECT 2::BIGINT, doc_id, title FROM ({q.page_docs()})""",
)
def union_sources(spark, sf):
    pd = html.html_to_corpus(load(spark, sf, "pages")).select("doc_id", F.col("title").alias("text"))
    bm = load(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return sc.union_sources([load(spark, sf, "documents"), bm, pd])


# ---- S5, S6: write derived files, read them back ---------------------------------------------

@register(
    "examples_jsonl_round_trip",
    """SELECT prompt, context, target FROM (
         SELECT role, text AS target, lag(text, 1) OVER w AS prompt, lag(text, 2) OVER w AS context
         FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'assistant'""",
)
def examples_jsonl_round_trip(spark, sf):
    """Prompt / context / target lines built from the conversations, written as
    JSON lines and read back with the declared schema (bad lines set aside)."""
    from corpusmill.operators.ordered import last_k_before

    c = load(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    h = last_k_before(c, "conv_id", ["turn"], 2, "text", out="_prev")
    ex = h.filter(F.col("role") == "assistant").select(
        F.when(F.size("_prev") >= 1, F.element_at("_prev", -1)).alias("prompt"),
        F.when(F.size("_prev") == 2, F.col("_prev")[0]).alias("context"),
        F.col("text").alias("target"),
    )
    path = f"{ensure_checkpoint_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    ex.write.json(path)
    good, _bad = files.read_examples_jsonl(spark, path)
    return good


@register("read_lines_documents", f"SELECT unnest(string_split(text, {NL})) AS line FROM documents")
def read_lines_documents(spark, sf):
    """Documents written as plain text, read back one row per line."""
    path = f"{ensure_checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    load(spark, sf, "documents").select("text").write.text(path)
    return files.read_lines(spark, path).select("line")


@register(
    "json_records_lookup",
    f"""SELECT p.doc_id, p.title, g.url FROM ({q.page_docs()}) p JOIN pages g ON g.page_id = p.doc_id""",
)
def json_records_lookup(spark, sf):
    """Page urls stored as JSON arrays keyed by page id, read back and used
    as a lookup (join by key) for the page documents."""
    path = f"{ensure_checkpoint_dir(spark)}/records-{uuid.uuid4().hex}"
    files.write_json_records(load(spark, sf, "pages").select("page_id", "url"), path, "page_id")
    recs = files.read_json_records(spark, path, "page_id", "page_id long, url string")
    docs = html.html_to_corpus(load(spark, sf, "pages")).select("doc_id", "title")
    return docs.join(recs.select(F.col("key").alias("doc_id"), "url"), "doc_id")
