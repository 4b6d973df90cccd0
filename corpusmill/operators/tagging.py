"""N1-N7, F10 support: personal data, token tags and sentence statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.pii import CHECKS, RULES
from corpusmill.functions.text import run_of
from corpusmill.operators.prep import sentences
import numpy as np
import pandas as pd
from pyspark import StorageLevel

from corpusmill.session import bounded_broadcast


WORD = r"[\p{L}\p{N}_]"


def _as_find(kind: str):
    def f(v):
        return F.struct(F.lit(kind).alias("kind"), v.alias("value"))

    return f


def _mask_chain(df: DataFrame, text_col: str) -> DataFrame:
    """Apply the rules in order as one projection per rule: adds ``_f{i}``
    (finds of rule i) and ``_masked`` (text after all rules).  Separate
    projections keep each step's text computed once (Spark does not collapse
    projections that would repeat an expensive expression)."""
    cur = "_t0"
    df = df.withColumn(cur, F.col(text_col))
    for i, (kind, pat, check) in enumerate(RULES):
        found = F.regexp_extract_all(F.col(cur), F.lit(pat), 0)
        if check:
            # the text between the matches, with each match put back or masked in its place
            matches = F.transform(found, lambda m: F.struct(m.alias("m"), CHECKS[check](m).alias("ok")))  # noqa: B023
            df = df.withColumn("_matches", matches).withColumn(f"_f{i}", F.transform(F.filter("_matches", lambda x: x["ok"]), lambda x: x["m"]))
            put = F.transform("_matches", lambda x: F.when(x["ok"], F.lit(f"[{kind}]")).otherwise(x["m"]))  # noqa: B023
            nxt = F.when(F.size("_matches") == 0, F.col(cur)).otherwise(F.array_join(F.zip_with(F.split(F.col(cur), pat, -1), F.concat(put, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), ""))
        else:
            df = df.withColumn(f"_f{i}", found)
            nxt = F.when(F.size(f"_f{i}") == 0, F.col(cur)).otherwise(F.regexp_replace(F.col(cur), pat, f"[{kind}]"))
        df = df.withColumn(f"_t{i + 1}", nxt).drop(cur, "_matches")
        cur = f"_t{i + 1}"
    return df.withColumnRenamed(cur, "_masked")


def detect_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gazetteer: DataFrame | None = None) -> DataFrame:
    """(id, kind, value) for every find; pattern kinds in rule order, then
    locations from a gazetteer (names of any number of words, whole words with one
    space between them)."""
    m = _mask_chain(df.select(id_col, text_col), text_col)
    arr = F.concat(*[F.transform(F.col(f"_f{i}"), _as_find(kind)) for i, (kind, _, _) in enumerate(RULES)])
    # explode_outer + null filter: plain explode adds a size filter that runs all rules twice
    if gazetteer is None:
        return m.select(F.col(id_col), F.explode_outer(arr).alias("f")).where("f is not null").select(id_col, "f.kind", "f.value")
    runs = F.transform(_runs("_masked"), lambda r: F.struct(F.lit(None).cast("string").alias("kind"), r.alias("value")))
    items = m.select(F.col(id_col), F.explode_outer(F.concat(arr, runs)).alias("f")).where("f is not null").select(id_col, "f.kind", "f.value")
    return _named(items, id_col, gazetteer, "LOCATION")


def _runs(text_col: str) -> Column:
    """The runs of words with one space between them."""
    return F.split(F.col(text_col), r"[^\p{L}\p{N}_ ]+| {2,}", -1)


def _named(items: DataFrame, id_col: str, gazetteer: DataFrame, kind: str) -> DataFrame:
    """(id, kind, value) of ``items``: those with a kind as they are, the others, runs of
    words, by the names in them.  Word groups up to the longest name's number of words are
    joined with the names."""
    names = gazetteer.select(F.col(gazetteer.columns[0]).alias("value")).distinct()
    longest = names.agg(F.max(F.size(F.split("value", " ")))).first()[0] or 1
    run = items.select(F.col(id_col), "kind", "value", F.split(F.trim("value"), " ").alias("w"))
    groups = [
        F.transform(F.sequence(F.lit(0), F.size("w") - n), lambda i: run_of(F.col("w"), i, n))  # noqa: B023
        if n > 1 else F.col("w")
        for n in range(1, longest + 1)
    ]
    some = [F.when(F.size("w") >= n, g).otherwise(F.array().cast("array<string>")) for n, g in enumerate(groups, 1)]
    values = F.when(F.col("kind").isNotNull(), F.array("value")).otherwise(F.concat(*some))
    words = run.select(F.col(id_col), "kind", F.explode_outer(values).alias("value"))
    found = words.join(bounded_broadcast(names.withColumn("_name", F.lit(True))), "value", "left").where("kind is not null or _name")
    return found.select(id_col, F.coalesce("kind", F.lit(kind)).alias("kind"), "value")


def gazetteer_finds(df: DataFrame, id_col: str, text_col: str, gazetteer: DataFrame, kind: str = "LOCATION") -> DataFrame:
    """(id, kind, value) per occurrence of a name."""
    items = df.select(F.col(id_col), F.lit(None).cast("string").alias("kind"), F.explode_outer(_runs(text_col)).alias("value"))
    return _named(items, id_col, gazetteer, kind)


def _mask_places(df: DataFrame, id_col: str, text_col: str, gazetteer: DataFrame) -> DataFrame:
    """Masks the names that ``gazetteer_finds`` found in each text, longest first."""
    found = gazetteer_finds(df.select(id_col, text_col), id_col, text_col, gazetteer)
    per_row = found.groupBy(F.col(id_col).alias("_id")).agg(F.sort_array(F.collect_set(F.struct(F.length("value").alias("n"), "value")), asc=False).alias("_v"))
    out = df.join(per_row, df[id_col].eqNullSafe(per_row["_id"]), "left")
    pattern = F.concat(
        F.lit(f"(?<!{WORD})(?:"), F.array_join(F.transform("_v", lambda x: F.concat(F.lit("\\Q"), x["value"], F.lit("\\E"))), "|"), F.lit(f")(?!{WORD})")
    )
    masked = F.when(F.col("_v").isNull(), F.col(text_col)).otherwise(F.regexp_replace(F.col(text_col), pattern, F.lit("[LOCATION]")))
    return out.withColumn(text_col, masked).drop("_id", "_v")


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gazetteer: DataFrame | None = None) -> DataFrame:
    """Replace each pattern find with [KIND], in the rule order, then the
    gazetteer's names, where one is given, with [LOCATION]."""
    m = _mask_chain(df, text_col)
    if gazetteer is not None:
        m = _mask_places(m, id_col, "_masked", gazetteer)
    return m.withColumn(text_col, F.col("_masked")).drop("_masked", *[f"_f{i}" for i in range(len(RULES))])


# ---- token tagger (N3-N6) -------------------------------------------------------------

def shape(tok: Column) -> Column:
    """Word shape: upper -> X, lower -> x, digit -> d, runs collapsed."""
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(tok, r"\p{Lu}", "X"), r"\p{Ll}", "x"), r"[0-9]", "d")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "X+", "X"), "x+", "x"), "d+", "d")


@dataclass(frozen=True)
class TaggerModel:
    word_tag: DataFrame  # (token, tag, n)
    shape_tag: DataFrame  # (shape, tag, n)
    trans: DataFrame  # (prev_tag, tag, n)
    tag_counts: DataFrame  # (tag, n)


def _persisted(*tables: DataFrame) -> TaggerModel:
    """Model tables are read by several steps of ``tag``; keep them (memory, spilling to disk)."""
    return TaggerModel(*[t.persist(StorageLevel.MEMORY_AND_DISK) for t in tables])


def fit_tagger(tagged: DataFrame, id_col: str = "row_id", weight: float = 1.0) -> TaggerModel:
    """Counts of (word, tag), (shape, tag), (previous tag, tag) from aligned rows
    (id, pos, token, tag).  The rows are read once: they are counted by token, tag and
    previous tag, and lower case and shapes are worked out for these counts.  The previous
    tag is a column ``prev_tag`` where the rows have one; else it comes from a window over
    the row's own tokens."""
    if "prev_tag" in tagged.columns:
        prev_tag = F.col("prev_tag")
    else:
        before = Window.partitionBy(id_col).orderBy("pos")
        prev_tag = F.when(F.lag("pos").over(before) == F.col("pos") - 1, F.lag("tag").over(before))
    t = tagged.select("token", "tag", F.coalesce(prev_tag, F.lit("<s>")).alias("prev_tag"))
    seen = t.groupBy("token", "tag", "prev_tag").agg(F.count(F.lit(1)).alias("c")).persist(StorageLevel.MEMORY_AND_DISK)
    n = (F.sum("c") * F.lit(weight)).alias("n")
    return _persisted(
        seen.groupBy(F.lower("token").alias("token"), "tag").agg(n),
        seen.groupBy(shape(F.col("token")).alias("shape"), "tag").agg(n),
        seen.groupBy("prev_tag", "tag").agg(n),
        seen.groupBy("tag").agg(n),
    )


def fine_tune_tagger(model: TaggerModel, tagged: DataFrame, id_col: str = "row_id", weight: float = 1.0) -> TaggerModel:
    """Add new rows (possibly with new tags) to a trained tagger's counts."""
    new = fit_tagger(tagged, id_col, weight)

    def add(a, b, keys):
        return a.unionByName(b).groupBy(*keys).agg(F.sum("n").alias("n"))

    return _persisted(
        add(model.word_tag, new.word_tag, ["token", "tag"]),
        add(model.shape_tag, new.shape_tag, ["shape", "tag"]),
        add(model.trans, new.trans, ["prev_tag", "tag"]),
        add(model.tag_counts, new.tag_counts, ["tag"]),
    )


def tag(model: TaggerModel, tokens_df: DataFrame, top_k_tags: int = 1, id_col: str = "row_id", places: int = 4) -> DataFrame:
    """Ranked tags per token (id, pos, token) -> (row_id, pos, tag, score, rank).

    score(tag) = ln P(tag) + ln((n(word, tag) + 1) / (n(tag) + |words|)) + ln((n(shape, tag) + 1) / (n(tag) + |shapes|)),
    i.e. word evidence with the shape as back-off; rounded, ties by tag.
    Each token is joined once to its word's tag counts (a map bounded by the
    tag set); shape counts are few and broadcast after a size check; all tags
    are scored and ranked inside the token row (no window, no shuffle by row)."""
    tags = model.tag_counts.orderBy("tag").collect()  # one row per tag: bounded by the tag set
    total = float(sum(r["n"] for r in tags))
    vw = float(model.word_tag.select("token").distinct().count())
    vs = float(model.shape_tag.select("shape").distinct().count())
    t = tokens_df.select(F.col(id_col).alias("row_id"), "pos", F.lower("token").alias("token"), shape(F.col("token")).alias("shape"))
    if top_k_tags == 1 and tags:
        return _best_tag(model, t, tags, total, vw, vs, places)
    wmap = model.word_tag.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("tag", "n"))).alias("wm"))
    smap = model.shape_tag.groupBy("shape").agg(F.map_from_entries(F.collect_list(F.struct("tag", "n"))).alias("sm"))
    t = t.join(bounded_broadcast(wmap), "token", "left").join(bounded_broadcast(smap), "shape", "left")

    def tag_score(r):
        tn = float(r["n"])
        nw = F.coalesce(F.col("wm")[F.lit(r["tag"])], F.lit(0.0))
        ns = F.coalesce(F.col("sm")[F.lit(r["tag"])], F.lit(0.0))
        sc = F.lit(float(np.log(tn / total))) + F.log((nw + 1) / F.lit(tn + vw)) + F.log((ns + 1) / F.lit(tn + vs))
        return F.struct(F.round(-sc, places).alias("neg"), F.lit(r["tag"]).alias("tag"))

    ranked = F.slice(F.array_sort(F.array(*[tag_score(r) for r in tags])), 1, top_k_tags)
    out = t.select("row_id", "pos", F.posexplode(ranked).alias("i", "c"))
    return out.select("row_id", "pos", F.col("c.tag").alias("tag"), (-F.col("c.neg")).alias("score"), (F.col("i") + 1).cast("bigint").alias("rank"))


def _best_tag(model: TaggerModel, t: DataFrame, tags: list, total: float, vw: float, vs: float, places: int) -> DataFrame:
    """The best tag of every token: the greatest score names it (ties: the first one)."""
    t = _tag_scores(model, t, tags, total, vw, vs, places)
    scores = [F.col(f"_c{j}") for j in range(len(tags))]
    t = t.withColumn("score", F.greatest(*scores) if len(scores) > 1 else scores[0])
    name = F.coalesce(*[F.when(s == F.col("score"), F.lit(r["tag"])) for s, r in zip(scores, tags)])
    return t.select("row_id", "pos", name.alias("tag"), "score", F.lit(1).cast("bigint").alias("rank"))


def _tag_scores(model: TaggerModel, t: DataFrame, tags: list, total: float, vw: float, vs: float, places: int) -> DataFrame:
    """row_id, pos and every tag's score in plain columns ``_c0`` on: a word and a shape
    bring one double a tag."""

    def wide(table: DataFrame, key: str, size: float, name: str) -> DataFrame:
        n = lambda r: F.coalesce(F.max(F.when(F.col("tag") == r["tag"], F.col("n"))), F.lit(0.0))
        return table.groupBy(key).agg(*[F.log((n(r) + 1) / F.lit(float(r["n"]) + size)).alias(f"_{name}{j}") for j, r in enumerate(tags)])

    t = t.join(bounded_broadcast(wide(model.word_tag, "token", vw, "w")), "token", "left").join(bounded_broadcast(wide(model.shape_tag, "shape", vs, "s")), "shape", "left")
    unseen = lambda c, r, size: F.coalesce(F.col(c), F.log(F.lit(1.0) / F.lit(float(r["n"]) + size)))
    return t.select("row_id", "pos", *[
        F.round(F.lit(float(np.log(float(r["n"]) / total))) + unseen(f"_w{j}", r, vw) + unseen(f"_s{j}", r, vs), places).alias(f"_c{j}") for j, r in enumerate(tags)
    ])


def tagged_sentences(sents: DataFrame, model: TaggerModel, keys: list[str], text_col: str = "sentence") -> DataFrame:
    """The keys and ``tags``: each sentence's tokens (runs of non-blanks) with their best
    tag, space-joined; a sentence's tokens are one group, bounded by the sentence."""
    words = F.filter(F.split(text_col, r"\s+"), lambda x: x != "")
    toks = sents.select(F.struct(*keys).alias("row_id"), F.posexplode(words).alias("pos", "token"))
    best = tag(model, toks)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "tag"))), lambda x: x["tag"]), " ")
    return best.groupBy("row_id").agg(joined.alias("tags")).select(*[F.col(f"row_id.{k}").alias(k) for k in keys], "tags")


def _token_tags(tokens_df: DataFrame, model: TaggerModel) -> tuple[DataFrame, DataFrame]:
    """(token, tag) and (shape, tag): the best tag of a word that the model does not know, by
    its shape, and the tokens whose best tag is another one.  Both are persisted."""
    tags = model.tag_counts.orderBy("tag").collect()  # one row per tag: bounded by the tag set
    vw, vs = (float(d.distinct().count()) for d in (model.word_tag.select("token"), model.shape_tag.select("shape")))
    best = lambda t: _best_tag(model, t, tags, float(sum(r["n"] for r in tags)), vw, vs, 4)
    t = tokens_df.select(F.col("token").alias("row_id"), F.lit(0).alias("pos"), F.lower("token").alias("token"), shape(F.col("token")).alias("shape")).persist(StorageLevel.MEMORY_AND_DISK)
    unknown = t.select("shape").distinct().select(F.col("shape").alias("row_id"), F.lit(0).alias("pos"), F.lit(None).cast("string").alias("token"), "shape")
    by_shape = best(unknown).select(F.col("row_id").alias("shape"), F.col("tag").alias("_usual")).persist(StorageLevel.MEMORY_AND_DISK)
    found = best(t).select(F.col("row_id").alias("token"), "tag").withColumn("shape", shape(F.col("token")))
    others = found.join(bounded_broadcast(by_shape), "shape").where("tag <> _usual").select("token", "tag").persist(StorageLevel.MEMORY_AND_DISK)
    others.count()
    t.unpersist()
    return others, by_shape


def with_tags(sents: DataFrame, model: TaggerModel, keys: list[str], text_col: str, carry: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """``carry`` and ``tags`` of every sentence (told by ``keys``), as ``tagged_sentences`` has
    them, and the tables to release.  Tags are worked out once a distinct token; tokens meet
    them by broadcast where these are few, so that sentences dealt by one of the keys are put
    together again without a shuffle.  Only a sentence's first token carries the columns."""
    words = F.filter(F.split(text_col, r"\s+"), lambda x: x != "")
    others, by_shape = _token_tags(sents.select(F.explode(words).alias("token")).distinct(), model)
    toks = sents.select(*keys, F.struct(*carry).alias("_whole"), F.posexplode_outer(words).alias("pos", "token"))
    toks = toks.withColumn("_whole", F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("_whole")))
    toks = toks.withColumn("shape", shape(F.col("token"))).join(bounded_broadcast(others), "token", "left").join(bounded_broadcast(by_shape), "shape", "left")
    tag_at = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("tag", "_usual").alias("tag")))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(tag_at)), lambda x: x["tag"]), " ")
    whole = toks.groupBy(*keys).agg(joined.alias("tags"), F.first("_whole", ignorenulls=True).alias("_whole"))
    return whole.select("_whole.*", "tags"), [others, by_shape]


def bio_spans(tagged: DataFrame, id_col: str = "row_id") -> DataFrame:
    """B-/I- tags to (id, kind, start, end) spans: gaps and islands with
    lag and a running sum of span starts per row."""
    w = Window.partitionBy(id_col).orderBy("pos")
    t = tagged.select(id_col, "pos", "tag", F.lag("tag").over(w).alias("_prev"))
    kind = F.regexp_replace("tag", "^[BI]-", "")
    prev_kind = F.regexp_replace(F.coalesce("_prev", F.lit("O")), "^[BI]-", "")
    starts = (F.col("tag") != "O") & (F.col("tag").startswith("B-") | (prev_kind != kind) | (F.coalesce("_prev", F.lit("O")) == "O"))
    t = t.withColumn("_start", starts.cast("int")).withColumn("_span", F.sum("_start").over(w))
    return (
        t.filter(F.col("tag") != "O")
        .groupBy(id_col, "_span")
        .agg(F.first(kind).alias("kind"), F.min("pos").alias("start"), F.max("pos").alias("end"))
        .drop("_span")
    )


def sentence_rows(df: DataFrame, id_col: str | list[str] = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sentence with its number."""
    return df.select(*([id_col] if isinstance(id_col, str) else id_col), F.posexplode(sentences(text_col)).alias("sent_no", "sentence")).withColumn(
        "sent_no", F.col("sent_no").cast("bigint")
    )


# Lines of a file that are numbered together.
LINES = 1 << 12


def sentences_of_lines(lines: DataFrame, place: list[str], text_col: str = "text") -> tuple[DataFrame, list[str], list[DataFrame]]:
    """N7 for files that come by lines: the sentences of every whole file (the first of ``place``)
    with their numbers in it; the columns that tell a sentence, by the first of which the rows
    are dealt; and the tables to release.  ``place``: the file, then what orders its splits; the
    lines of a split come in order.

    A line break ends a sentence, so lines are cut by themselves; only white space at a line's
    start belongs to the end of the sentence before, where the file's last character
    before it that is no white space ends one.  Runs of LINES lines know that within
    themselves, a row for each run carries it and the number of sentences on."""
    keys = ["_run", *place]
    t = lines.withColumn("_at", F.monotonically_increasing_id()).withColumn("_run", F.shiftright("_at", LINES.bit_length() - 1)).repartition("_run")
    before = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("_ends", F.when(F.col(text_col).rlike(r"\S"), F.col(text_col).rlike(r"[.!?]\s*\z")))
    t = t.withColumn("_after", F.last("_ends", ignorenulls=True).over(before))
    led = F.regexp_replace(text_col, r"\A\s+", "")
    t = t.withColumn("_s", sentences(F.when(F.coalesce("_after", F.lit(False)), led).otherwise(F.col(text_col))))
    # the lines up to the first that is not blank, had the run before ended a sentence
    t = t.withColumn("_led", F.when(F.col("_after").isNull() & F.col(text_col).rlike(r"\A\s"), sentences(led)))
    t = t.withColumn("_n", F.size("_s")).withColumn("_nled", F.size(F.coalesce("_led", "_s")))
    t = t.select(*keys, "_at", "_ends", "_s", "_led", "_n", "_nled", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_n", "_nled")])
    kept = t = t.persist(StorageLevel.MEMORY_AND_DISK)  # the numbers of lines are those of one reading
    runs = t.groupBy(*keys).agg(F.max_by("_ends", F.when(F.col("_ends").isNotNull(), F.col("_at"))).alias("_ends"), F.sum("_n").alias("_n"), F.sum("_nled").alias("_nled"))
    earlier = Window.partitionBy(place[0]).orderBy(*place[1:], "_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_on", F.coalesce(F.last("_ends", ignorenulls=True).over(earlier), F.lit(False)))
    runs = runs.withColumn("_first", F.coalesce(F.sum(F.when(F.col("_on"), F.col("_nled")).otherwise(F.col("_n"))).over(earlier), F.lit(0))).select(*keys, "_on", "_first")
    t = t.join(bounded_broadcast(runs), keys)
    t = t.withColumn("_first", F.col("_first") + F.when(F.col("_on"), F.col("_nled_before")).otherwise(F.col("_n_before")))
    cut = F.when(F.col("_on") & F.col("_led").isNotNull(), F.col("_led")).otherwise(F.col("_s"))
    out = t.select("_run", "_at", place[0], "_first", F.posexplode(cut).alias("_i", "sentence"))
    return out.select("_run", "_at", "_i", place[0], (F.col("_first") + F.col("_i")).cast("bigint").alias("sent_no"), "sentence"), ["_run", "_at", "_i"], [kept]


def extraction_stats(df: DataFrame, file_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents and sentences per file."""
    return df.select(file_col, id_col, F.size(sentences(text_col)).alias("_n")).groupBy(file_col).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("_n").cast("bigint").alias("n_sentences")
    )


def decode(model: TaggerModel, tokens_df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """N4 sequence decode: Viterbi over emission scores (those of ``tag``, one row a
    token) plus add-one transition log-probabilities from N3's (previous tag,
    tag) counts.  One group per row (its tokens: bounded by the row), decoded
    in numpy by ``applyInPandas``.  Returns (row_id, pos, tag)."""
    counts = model.tag_counts.orderBy("tag").collect()
    tags = [r["tag"] for r in counts]
    n = len(tags)
    idx = {t: i for i, t in enumerate(tags)}
    trans = np.ones((n + 1, n))  # row n = sentence start
    for r in model.trans.collect():  # at most (tags + 1) x tags rows
        if r["tag"] in idx:
            trans[idx.get(r["prev_tag"], n), idx[r["tag"]]] += r["n"]
    log_t = np.log(trans / trans.sum(axis=1, keepdims=True))
    vw, vs = (float(d.distinct().count()) for d in (model.word_tag.select("token"), model.shape_tag.select("shape")))
    t = tokens_df.select(F.col(id_col).alias("row_id"), "pos", F.lower("token").alias("token"), shape(F.col("token")).alias("shape"))
    scores = _tag_scores(model, t, counts, float(sum(r["n"] for r in counts)), vw, vs, 4)
    em = scores.select("row_id", "pos", F.array(*[F.col(f"_c{j}") for j in range(n)]).alias("em"))

    def viterbi(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        e = np.stack(pdf["em"].to_numpy())
        best = log_t[n] + e[0]
        back = np.zeros((len(e), n), dtype=np.int64)
        for i in range(1, len(e)):
            cand = best[:, None] + log_t[:n]
            back[i] = cand.argmax(axis=0)
            best = cand.max(axis=0) + e[i]
        path = [int(best.argmax())]
        for i in range(len(e) - 1, 0, -1):
            path.append(int(back[i][path[-1]]))
        path.reverse()
        return pd.DataFrame({"row_id": pdf["row_id"].to_numpy(), "pos": pdf["pos"].to_numpy(), "tag": [tags[j] for j in path]})

    return em.groupBy("row_id").applyInPandas(viterbi, "row_id long, pos long, tag string")
