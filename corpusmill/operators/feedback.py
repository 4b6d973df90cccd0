"""Teaching the search from feedback, and answer-prompt assembly."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import stable_hash, tokens
from corpusmill.operators.index import Index, query_terms, score_pairs, top_k_terms
from corpusmill.operators.topk import top_k_by_score
from corpusmill.session import bounded_broadcast

# Ours: the reference leaves these strengths open.
UPVOTE_WEIGHT = 10.0
LEARNED_FIELD_WEIGHT = 1.0

# Fixed value: the answer prompt, with the best texts joined by blank lines.
PROMPT_TEMPLATE = "Answer the following question in about 50 words using the context given: \nQuestion : {query} \nContext: {context}"


def query_key(text) -> F.Column:
    """Normalised text used to recognise the same query again: its tokens joined by spaces."""
    return F.array_join(tokens(text), " ")


def associate(qterms: DataFrame, pairs: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """A query holding every word of a pair's source gains the target's words.

    Containment is a count join: (query, pair) matches when the number of shared
    source words equals the source's size.  Returns the expanded (query_id, term)."""
    p = pairs.select(stable_hash(F.concat_ws("\u0001", F.col(source), F.col(target))).alias("pair_id"), source, target)
    src = p.select("pair_id", F.explode(F.array_distinct(tokens(source))).alias("term"))
    size = src.groupBy("pair_id").agg(F.count(F.lit(1)).alias("_n"))
    tgt = p.select("pair_id", F.explode(F.array_distinct(tokens(target))).alias("term"))
    hit = (
        qterms.join(bounded_broadcast(src), "term")
        .groupBy("query_id", "pair_id")
        .agg(F.count(F.lit(1)).alias("_m"))
        .join(bounded_broadcast(size), "pair_id")
        .filter(F.col("_m") == F.col("_n"))
    )
    added = hit.join(bounded_broadcast(tgt), "pair_id").select("query_id", "term")
    return qterms.select("query_id", "term").unionByName(added).distinct()


def search_terms(index: Index, qterms: DataFrame, k: int) -> DataFrame:
    return top_k_terms(index, qterms, k)


def upvote_table(pairs: DataFrame, text: str = "query", doc: str = "doc_id", weight: float = UPVOTE_WEIGHT) -> DataFrame:
    """(key, doc_id, boost): each upvote of a (text, document) adds ``weight``."""
    return pairs.groupBy(query_key(text).alias("key"), F.col(doc).cast("bigint").alias("doc_id")).agg(
        (F.count(F.lit(1)) * F.lit(weight)).alias("boost")
    )


def search_with_upvotes(index: Index, queries: DataFrame, boosts: DataFrame, k: int) -> DataFrame:
    """BM25 plus boosts, which are never negative.  A document without a boost
    that is among the best k with boosts is so without them, so the bounded top k and
    the boosted pairs, scored by themselves, are all that can win; an upvoted document
    may match no query word."""
    qterms = query_terms(queries)
    plain = top_k_terms(index, qterms, k).select("query_id", "doc_id", "score")
    qb = queries.select(F.col("query_id").cast("bigint").alias("query_id"), query_key("text").alias("key")).join(
        bounded_broadcast(boosts), "key"
    ).select("query_id", "doc_id", "boost")
    boosted = qb.join(score_pairs(index, qterms, qb), ["query_id", "doc_id"], "left").select(
        "query_id", "doc_id", F.round(F.coalesce("score", F.lit(0.0)) + F.col("boost"), 6).alias("score")
    )
    merged = boosted.unionByName(plain.join(qb, ["query_id", "doc_id"], "left_anti"))
    return top_k_by_score(merged, "query_id", "score", "doc_id", k).select("query_id", "doc_id", "rank", "score")


def learn_from_qrels(index: Index, qrels: DataFrame, query: str = "query", doc: str = "doc_id", weight: float = LEARNED_FIELD_WEIGHT) -> Index:
    """Query words become a learned field of their document (Rocchio 1971).

    The result equals an index built with that extra field.  Postings of documents
    without feedback pass as they are; those of the others are regrouped with the learned
    words, and a term's document frequency grows by the documents that have it new.
    Feedback for unknown documents is ignored."""
    known = qrels.select(F.coalesce(F.col(query), F.lit("")).alias("_q"), F.col(doc).cast("bigint").alias("doc_id")).join(
        index.doc_len.select("doc_id"), "doc_id", "left_semi"
    )
    learned_tf = (
        known.select("doc_id", F.explode_outer(tokens("_q")).alias("term"))
        .filter(F.col("term").isNotNull())
        .select("doc_id", "term", F.lit(float(weight)).alias("tf"))
    )
    learned_len = known.groupBy("doc_id").agg(F.sum(F.size(tokens("_q")) * F.lit(weight)).alias("_add")).persist(StorageLevel.MEMORY_AND_DISK)
    taught = bounded_broadcast(learned_len.select("doc_id"))
    doc_len = index.doc_len.join(bounded_broadcast(learned_len), "doc_id", "left").select(
        "doc_id", (F.col("dl") + F.coalesce("_add", F.lit(0.0))).alias("dl")
    )
    old = index.postings.join(taught, "doc_id", "left_semi").select("doc_id", "term", "tf", F.lit(True).alias("_had"))
    both = old.unionByName(learned_tf.withColumn("_had", F.lit(False))).groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"), F.max("_had").alias("_had"))
    # the old lengths come from the postings; a document without any had no token
    was = index.postings.join(taught, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("dl").alias("dl"))
    lengths = learned_len.join(was, "doc_id", "left").select("doc_id", (F.coalesce("dl", F.lit(0.0)) + F.col("_add")).alias("dl"))
    touched = both.join(bounded_broadcast(lengths), "doc_id").select("doc_id", "term", "tf", "dl", "_had").persist(StorageLevel.MEMORY_AND_DISK)
    postings = index.postings.join(taught, "doc_id", "left_anti").select("doc_id", "term", "tf", "dl").unionByName(touched.drop("_had"))
    new = touched.where("not _had").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    stats = index.term_stats.unionByName(new).groupBy("term").agg(F.sum("df").cast("bigint").alias("df")).persist(StorageLevel.MEMORY_AND_DISK)
    add = learned_len.agg(F.sum("_add")).first()[0] or 0.0
    return Index(postings, doc_len, stats, index.n_docs, index.total_len + float(add))


def rag_context(hits: DataFrame, texts: DataFrame, queries: DataFrame, n: int = 3, text_col: str = "text") -> DataFrame:
    """The best n texts of each query, joined by blank lines, in the prompt.

    Each group holds at most n rows (rank <= n), so the ordered collect is bounded."""
    best = hits.filter(F.col("rank") <= n).join(texts.select("doc_id", F.col(text_col).alias("_t")), "doc_id")
    ctx = best.groupBy("query_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "_t"))), lambda s: s["_t"]), "\n\n").alias("context")
    )
    q = queries.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("text").alias("question"))
    prompt = F.format_string(
        PROMPT_TEMPLATE.replace("{query}", "%s").replace("{context}", "%s"), F.col("question"), F.coalesce("context", F.lit(""))
    )
    return q.join(ctx, "query_id", "left").select("query_id", prompt.alias("prompt"))
