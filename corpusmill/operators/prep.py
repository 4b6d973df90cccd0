"""Corpus preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import normalise_text, once, run_of, stable_hash, tokens
from corpusmill.operators.ordered import dense_ids as _dense_ids
from corpusmill.operators.ordered import running_totals

HASH_SPACE = 1_000_000  # sampling / splitting resolution


def normalise(df: DataFrame, cols) -> DataFrame:
    """Lower-case, commas and line breaks to spaces."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.select(*[normalise_text(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def dense_ids(df: DataFrame, order, id_col: str = "id") -> DataFrame:
    """Ids 0..n-1 in the stated order (no single-partition window)."""
    return _dense_ids(df, order, id_col)


def hash_bucket(id_col, seed: int = 0, space: int = HASH_SPACE) -> Column:
    return F.pmod(stable_hash(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))), F.lit(space))


def sample_rows(df: DataFrame, frac: float, id_col: str, seed: int = 0) -> DataFrame:
    """Reproducible fraction, decided per row by a stable hash of (seed, id)."""
    return df.filter(hash_bucket(id_col, seed) < F.lit(int(round(frac * HASH_SPACE))))


def sample_first(df: DataFrame, n: int, id_col: str, seed: int = 0) -> DataFrame:
    """The first n rows of a seeded shuffle (a top-n by hash: TakeOrderedAndProject)."""
    h = stable_hash(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", id_col).limit(n).drop("_h")


def split_rows(df: DataFrame, cuts: dict[str, float], id_col: str, seed: int = 0, part_col: str = "part") -> DataFrame:
    """Hashed split; ``cuts`` maps part name to share (shares sum to 1)."""
    b = hash_bucket(id_col, seed)
    expr, acc = None, 0.0
    items = list(cuts.items())
    for i, (name, share) in enumerate(items):
        acc += share
        cond = b < F.lit(int(round(acc * HASH_SPACE))) if i < len(items) - 1 else F.lit(True)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(part_col, expr)


def split_positional(df: DataFrame, order, cuts: dict[str, float], part_col: str = "part") -> DataFrame:
    """Positional split on P2 ids (first share of the order, then the next...)."""
    n = df.count()
    with_id = _dense_ids(df, order, "_rowpos")
    expr, acc = None, 0.0
    items = list(cuts.items())
    for i, (name, share) in enumerate(items):
        acc += share
        cond = F.col("_rowpos") < F.lit(int(round(acc * n))) if i < len(items) - 1 else F.lit(True)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return with_id.withColumn(part_col, expr).drop("_rowpos")


def keep_top(df: DataFrame, n: int, by, where: Column | None = None) -> DataFrame:
    """P5: the n most popular qualifying rows (``by`` is a list of sort columns)."""
    if where is not None:
        df = df.filter(where)
    return df.orderBy(*by).limit(n)


def sentences(text) -> Column:
    """Sentence list: a terminator followed by white space ends a sentence, so
    does a line break; pieces are trimmed and empty ones dropped."""
    marked = F.regexp_replace(F.col(text) if isinstance(text, str) else text, r"([.!?])\s+", "$1\n")
    return F.filter(F.transform(F.split(marked, r"\n+"), lambda s: F.trim(s)), lambda s: s != F.lit(""))


def chunk_text(df: DataFrame, per_chunk: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Consecutive groups of ``per_chunk`` sentences, numbered from 0.

    Done with array functions inside each row: no shuffle, no collect."""

    def chunks(s):
        n = F.ceil(F.size(s) / F.lit(float(per_chunk))).cast("int")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda c: run_of(s, c * per_chunk, per_chunk)))

    # posexplode_outer + null filter: plain posexplode adds a size filter that cuts every text twice
    out = df.select(F.col(id_col), F.posexplode_outer(once(sentences(text_col), chunks)).alias("chunk_no", "text"))
    return out.where("chunk_no is not null").withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


def text_key(text_col: str = "text") -> Column:
    return F.md5(F.col(text_col))


def distinct_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """P7 step: the smallest id of each distinct text (partial min before the shuffle)."""
    return df.groupBy(text_key(text_col).alias("text_md5")).agg(F.min(id_col).alias(id_col))


def dedup_insert(existing: DataFrame, incoming: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Incoming rows whose text is new, one (smallest id) per repeated text."""
    seen = existing.select(text_key(text_col).alias("text_md5")).distinct()
    first = distinct_texts(incoming, id_col, text_col).join(seen, "text_md5", "left_anti").select(id_col)
    return incoming.join(first, id_col, "left_semi")


def fingerprint(df: DataFrame, cols, group=None) -> DataFrame:
    """Order-free content hash: count, xor and decimal sum of row hashes."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    row = stable_hash(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols]))
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.bit_xor(row).alias("hash_xor"),
        F.sum(row.cast("decimal(38,0)")).cast("string").alias("hash_sum"),
    ]
    return df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)


def shard(df: DataFrame, n: int, id_col: str = "doc_id", shard_col: str = "shard") -> DataFrame:
    """Stable shard number, then co-locate each shard."""
    return df.withColumn(shard_col, F.pmod(stable_hash(F.col(id_col)), F.lit(n))).repartition(n, shard_col)


def noisy_queries(df: DataFrame, text_col: str, id_col: str, copies: int = 2) -> DataFrame:
    """P10: misspelt copies: per (row, copy) a stable hash picks a position and one
    of drop / swap-with-next / double the character."""
    c = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    base = df.select(F.col(id_col), F.col(text_col).alias("source"), c)
    h = stable_hash(F.concat(F.col(id_col).cast("string"), F.lit(":"), F.col("copy").cast("string")))
    L = F.length("source")
    pos = F.pmod(h, F.greatest(L, F.lit(1))) + 1
    op = F.pmod(F.shiftright(h, 20), F.lit(3))
    s = F.col("source")
    before = F.substr(s, F.lit(1), pos - 1)
    at = F.substr(s, pos, F.lit(1))
    nxt = F.substr(s, pos + 1, F.lit(1))
    after1 = F.substr(s, pos + 1)
    after2 = F.substr(s, pos + 2)
    noisy = (
        F.when(L < 2, s)
        .when(op == 0, F.concat(before, after1))
        .when((op == 1) & (pos < L), F.concat(before, nxt, at, after2))
        .otherwise(F.concat(before, at, at, after1))
    )
    return base.select(id_col, F.col("copy").cast("bigint").alias("copy"), "source", noisy.alias("noisy"))


def cold_start_pairs(corpus: DataFrame, id_col: str, strong: str | None, weak: str | None, phrase_len: int = 8) -> DataFrame:
    """Pseudo (query, id) pairs: the whole strong text, and consecutive
    ``phrase_len``-token phrases of the weak text (all of them)."""
    parts = []
    if strong:
        parts.append(
            corpus.select(F.col(id_col).alias("doc_id"), F.lit("strong").alias("kind"), F.lit(0).cast("bigint").alias("piece"),
                          F.array_join(tokens(strong), " ").alias("query"))
            .filter(F.col("query") != "")
        )
    if weak:
        def phrases(t):
            n = F.ceil(F.size(t) / F.lit(float(phrase_len))).cast("int")
            return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: run_of(t, i * phrase_len, phrase_len)))

        # posexplode_outer + null filter: plain posexplode adds a size filter that cuts every text twice
        parts.append(
            corpus.select(F.col(id_col).alias("doc_id"), F.lit("weak").alias("kind"), F.posexplode_outer(once(tokens(weak), phrases)).alias("piece", "query"))
            .where("piece is not null")
            .withColumn("piece", F.col("piece").cast("bigint"))
            .select("doc_id", "kind", "piece", "query")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def lm_examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target_role: str = "assistant",
                n_before: int = 2) -> DataFrame:
    """For every target-role turn: the tokens of the ``n_before`` turns before it,
    oldest first, then its own; labels 1 only on target tokens.

    The earlier turns come from the chunked look-back (``last_k_before``), so one very
    long conversation is still split into bounded groups."""
    from corpusmill.operators.ordered import last_k_before

    h = last_k_before(turns.select(conv, turn, role, text), conv, [turn], n_before, text, out="_prev").filter(F.col(role) == target_role)
    t = h.select(conv, turn, F.flatten(F.transform("_prev", lambda x: tokens(F.coalesce(x, F.lit(""))))).alias("c"), tokens(text).alias("y"))
    labels = F.concat(F.transform("c", lambda _: F.lit(0)), F.transform("y", lambda _: F.lit(1)))
    return t.select(conv, turn, F.concat("c", "y").alias("tokens"), labels.alias("labels"))


def pack_tokens(examples: DataFrame, width: int = 2048, n_shards: int = 1, key=("conv_id", "turn"), tokens_col: str = "tokens") -> DataFrame:
    """Concatenate token streams in key order within each shard and cut them
    into blocks of ``width`` tokens.

    Offsets are distributed running totals (no window over a whole shard).  An
    example is cut at the block borders inside it, so one row a slice is shuffled, not
    one a token, and each block joins slices of at most ``width`` tokens."""
    key = list(key)
    sized = examples.select(
        F.pmod(stable_hash(F.col(key[0])), F.lit(n_shards)).alias("shard"), *key, tokens_col,
        F.size(tokens_col).cast("bigint").alias("_len"),
    )
    off = running_totals(sized, ["shard", *key], ["_len"])
    start = off.groupBy("shard").agg(F.min("_len_before").alias("_s0"))
    off = off.join(F.broadcast(start), "shard").withColumn("_off", F.col("_len_before") - F.col("_s0"))
    last = F.floor((F.col("_off") + F.col("_len") - 1) / F.lit(width))
    cut = off.where("_len > 0").select("shard", "_off", "_len", tokens_col, F.explode(F.sequence(F.floor(F.col("_off") / F.lit(width)), last)).alias("block"))
    begin = F.greatest(F.col("block") * width - F.col("_off"), F.lit(0))
    end = F.least((F.col("block") + 1) * width - F.col("_off"), F.col("_len"))
    part = F.slice(F.col(tokens_col), (begin + 1).cast("int"), (end - begin).cast("int"))
    slices = cut.select("shard", F.col("block").cast("bigint").alias("block"), F.struct((F.col("_off") + begin).alias("_g"), part.alias("part")).alias("s"))
    return slices.groupBy("shard", "block").agg(F.flatten(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["part"])).alias("tokens"))
