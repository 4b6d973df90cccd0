"""M1-M9: count-based classifiers (multinomial Naive Bayes, McCallum and Nigam
1998) and an MLlib logistic regression.

A model is a set of count tables, so training is one group-by, fine-tuning and
batch training merge by (weighted) addition, and data-parallel training is the
partial + final aggregate Spark already runs.

Scoring contract (add-one smoothing over the training vocabulary V):
  score(d, c) = ln(n_docs_c / n_docs) + sum_t cnt(d,t) * ln((n(c,t) + 1) / (len_c + |V|))
for the tokens t of d that are in V, rounded to 4 places; top class by score
desc then class asc.  Rewritten as
  ln prior_c - L_d * ln(len_c + |V|) + sum_{t: n(c,t) > 0} cnt(d,t) * ln(n(c,t) + 1)
so only (class, term) pairs that occurred are joined.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import char_grams, tokens, word_ngrams
from corpusmill.operators import class_grid, prep
from corpusmill.operators.features import Categorical, Date, FeatureSpec, Numerical, Text, date_parts, numerical
from corpusmill.session import bounded_broadcast, ensure_checkpoint_dir

# Up to so many classes are scored inside the row, more of them in blocks of rows and
# classes (``class_grid``): the same answers by another plan.
IN_ROW_CLASSES = 64


@dataclass(frozen=True)
class CountModel:
    term_counts: DataFrame  # (label string, term string, n double)
    class_counts: DataFrame  # (label string, docs double, len double)

    def persist(self) -> "CountModel":
        """Keep the count tables (memory, spilling to disk): scoring reads them several times."""
        return CountModel(self.term_counts.persist(StorageLevel.MEMORY_AND_DISK), self.class_counts.persist(StorageLevel.MEMORY_AND_DISK))


def doc_terms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (
        df.select(F.col(id_col).alias("row_id"), F.explode_outer(tokens(text_col)).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("row_id", "term")
        .agg(F.count(F.lit(1)).cast("double").alias("cnt"))
    )


def fit_terms(rows: DataFrame, label_col: str = "label", weight: float = 1.0) -> CountModel:
    """Train from (row_id, label, term, cnt) rows plus one (row_id, label) per row."""
    tc = rows.groupBy(F.col(label_col).cast("string").alias("label"), "term").agg((F.sum("cnt") * weight).alias("n"))
    per_row = rows.groupBy("row_id", F.col(label_col).cast("string").alias("label")).agg(F.sum("cnt").alias("_len"))
    cc = per_row.groupBy("label").agg((F.count(F.lit(1)) * weight).cast("double").alias("docs"), (F.sum("_len") * weight).alias("len"))
    return CountModel(tc, cc)


def _fit(terms: DataFrame, lab: DataFrame, weight: float) -> CountModel:
    tc = terms.join(lab, "row_id").groupBy("label", "term").agg((F.sum("cnt") * weight).alias("n"))
    lens = terms.groupBy("row_id").agg(F.sum("cnt").alias("_len"))
    cc = lab.join(lens, "row_id", "left").groupBy("label").agg(
        (F.count(F.lit(1)) * weight).cast("double").alias("docs"), (F.coalesce(F.sum("_len"), F.lit(0.0)) * weight).alias("len")
    )
    return CountModel(tc, cc).persist()


def _fit_rows(rows: DataFrame, term_rows: DataFrame, weight: float) -> CountModel:
    """Counts from (label) rows and (label, term) rows of the same table: no join
    back to the label, one pass over the terms (class lengths are sums of the
    term counts)."""
    w = F.lit(weight)
    tc = term_rows.groupBy("label", "term").agg((F.count(F.lit(1)) * w).cast("double").alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    docs = rows.groupBy("label").agg((F.count(F.lit(1)) * w).cast("double").alias("docs"))
    lens = tc.groupBy("label").agg(F.sum("n").alias("len"))
    cc = docs.join(lens, "label", "left").select("label", "docs", F.coalesce("len", F.lit(0.0)).alias("len"))
    return CountModel(tc, cc.persist(StorageLevel.MEMORY_AND_DISK))


def fit_text(df: DataFrame, id_col: str, text_col: str, label_col: str, weight: float = 1.0) -> CountModel:
    """M1: term counts per class.  Rows without any token still count as documents."""
    lab = F.col(label_col).cast("string").alias("label")
    rows = df.select(lab)
    term_rows = df.select(lab, F.explode_outer(tokens(text_col)).alias("term")).filter(F.col("term").isNotNull())
    return _fit_rows(rows, term_rows, weight)


def merge(a: CountModel, b: CountModel, weight: float = 1.0) -> CountModel:
    """M5: add ``weight`` times b's counts to a's."""
    tc = a.term_counts.unionByName(b.term_counts.withColumn("n", F.col("n") * weight)).groupBy("label", "term").agg(F.sum("n").alias("n"))
    cc = (
        a.class_counts.unionByName(b.class_counts.withColumn("docs", F.col("docs") * weight).withColumn("len", F.col("len") * weight))
        .groupBy("label")
        .agg(F.sum("docs").alias("docs"), F.sum("len").alias("len"))
    )
    return CountModel(tc, cc)


def fine_tune(model: CountModel, df: DataFrame, id_col: str, text_col: str, label_col: str, weight: float = 1.0) -> CountModel:
    """M5: start from trained counts, add new rows with a weight."""
    return merge(model, fit_text(df, id_col, text_col, label_col), weight)


def fit_in_batches(batches: list[DataFrame], id_col: str, text_col: str, label_col: str) -> CountModel:
    """M7: fold of M5 over bounded batches; equals one fit over their union."""
    models = [fit_text(b, id_col, text_col, label_col) for b in batches]
    return reduce(lambda a, b: merge(a, b), models)


def _classes(model: CountModel) -> DataFrame:
    """label, prior, norm of every class."""
    v_size = model.term_counts.filter(F.col("n") > 0).select("term").distinct().count()
    n_docs = model.class_counts.agg(F.sum("docs")).first()[0] or 0.0
    return model.class_counts.select(
        "label", F.log(F.col("docs") / F.lit(float(n_docs))).alias("prior"), F.log(F.col("len") + F.lit(float(v_size))).alias("norm")
    )


def _scoring_tables(model: CountModel) -> tuple[list, DataFrame]:
    """The classes, at most IN_ROW_CLASSES, and (term, m): per-class ln(n + 1) of each term."""
    tc = model.term_counts.filter(F.col("n") > 0)
    classes = _classes(model).orderBy("label").collect()
    return classes, tc.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct("label", F.log(F.col("n") + 1)))).alias("m"))


def _in_blocks(model: CountModel, terms: DataFrame, rows: DataFrame, k: int, places: int) -> DataFrame:
    weights = model.term_counts.filter(F.col("n") > 0).select("label", "term", F.log(F.col("n") + 1).alias("w"))
    known = terms.join(weights.select("term").distinct(), "term", "left_semi").select("row_id", "term", "cnt").persist(StorageLevel.MEMORY_AND_DISK)
    # a row may be listed twice, and its terms once: it is scored once
    rows = rows.select("row_id").distinct().join(known.groupBy("row_id").agg(F.sum("cnt").alias("L")), "row_id", "left").select("row_id", F.coalesce("L", F.lit(0.0)).alias("L"))
    sizes = {"classes": model.class_counts.count(), "weights": weights.count(), "rows": rows.count(), "terms": known.count()}
    return class_grid.rank_classes(_classes(model), weights, rows, known, sizes, k, places)


def predict_terms(model: CountModel, terms: DataFrame, rows: DataFrame, k: int = 1, places: int = 4) -> DataFrame:
    """M2 on (row_id, term, cnt): (row_id, label, score, prob, rank) for the top k classes.

    One shuffle: each known term carries its per-class ln(n + 1) (a map bounded
    by the class count, joined from the model; broadcast after a size check),
    every row gathers its own terms with one ``groupBy(row_id)`` (a row's terms
    are bounded by the row), and all classes are scored, normalised and ranked
    inside the row.  More than IN_ROW_CLASSES classes are scored in blocks.
    ``rows`` lists every row to score (rows without a known term get the prior)."""
    if model.class_counts.limit(IN_ROW_CLASSES + 1).count() > IN_ROW_CLASSES:
        return _in_blocks(model, terms, rows, k, places)
    classes, weights = _scoring_tables(model)
    known = terms.join(bounded_broadcast(weights), "term").select("row_id", "cnt", "m")
    empty = rows.select("row_id", F.lit(None).cast("double").alias("cnt"), F.lit(None).cast(weights.schema["m"].dataType).alias("m"))
    per_row = known.unionByName(empty).groupBy("row_id").agg(
        F.coalesce(F.sum("cnt"), F.lit(0.0)).alias("L"),
        F.filter(F.collect_list(F.struct("cnt", "m")), lambda x: x["m"].isNotNull()).alias("ev"),
    )

    return _rank_classes(per_row, ["row_id"], classes, k, places)


def _rank_classes(per_row: DataFrame, keep: list[str], classes: list, k: int, places: int = 4) -> DataFrame:
    """Scores, normalises and ranks the classes inside each row, from its number of
    known terms ``L`` and its evidence ``ev`` (cnt, m)."""

    def class_score(c):
        bonus = F.aggregate("ev", F.lit(0.0), lambda acc, x: acc + x["cnt"] * F.coalesce(x["m"][F.lit(c["label"])], F.lit(0.0)))
        s = F.lit(float(c["prior"])) - F.col("L") * F.lit(float(c["norm"])) + bonus
        return F.struct(F.lit(c["label"]).alias("label"), F.round(s, places).alias("score"))

    scored = per_row.select(*keep, F.array(*[class_score(c) for c in classes]).alias("s"))
    mx = F.array_max(F.transform("s", lambda x: x["score"]))
    scored = scored.select(*keep, "s", mx.alias("mx")).select(
        *keep, "s", F.aggregate("s", F.lit(0.0), lambda acc, x: acc + F.exp(x["score"] - F.col("mx"))).alias("z"), "mx"
    )
    ranked = F.slice(
        F.array_sort(F.transform("s", lambda x: F.struct((-x["score"]).alias("neg"), x["label"].alias("label"), x["score"].alias("score")))), 1, k
    )
    out = scored.select(*keep, "mx", "z", F.posexplode(ranked).alias("pos", "c"))
    return out.select(
        *keep, F.col("c.label").alias("label"), F.col("c.score").alias("score"),
        F.round(F.exp(F.col("c.score") - F.col("mx")) / F.col("z"), 6).alias("prob"), (F.col("pos") + 1).cast("bigint").alias("rank"),
    )


def predict(model: CountModel, df: DataFrame, id_col: str, text_col: str, k: int = 1) -> DataFrame:
    """M2: scores and class names for a batch; no label column needed."""
    return predict_terms(model, doc_terms(df, id_col, text_col), df.select(F.col(id_col).alias("row_id")), k)


def predicted(model: CountModel, df: DataFrame, text_col: str, name: str = "prediction") -> DataFrame:
    """The rows of ``df`` with their best class as one more column, a struct of
    label and score.  Any columns, repeated rows and null texts are kept; rows go by their
    number in a checkpoint, and the model's tables stay distributed whatever their size."""
    ensure_checkpoint_dir(df.sparkSession)
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_own"), F.col(text_col).alias("_text"), F.monotonically_increasing_id().alias("_row")).checkpoint()
    best = predict(model, own, "_row", "_text", 1).select(F.col("row_id").alias("_row"), F.struct("label", "score").alias("_best"))
    return own.join(best, "_row").select("_own.*", F.col("_best").alias(name))


# ---- M4: tabular rows as "column=value" tokens ------------------------------------

def _tabular_terms(feature_cols: dict) -> list:
    """``feature_cols`` maps a name to a Column already binned / coded."""
    return [F.concat(F.lit(f"{n}="), F.coalesce(c.cast("string"), F.lit("?"))) for n, c in feature_cols.items()]


def fit_tabular(df: DataFrame, feature_cols: dict, label_col: str) -> CountModel:
    """M4: count-based model on binned numbers and categories (label kept in the row)."""
    arr = F.array(*_tabular_terms(feature_cols))
    lab = F.col(label_col).cast("string").alias("label")
    return _fit_rows(df.select(lab), df.select(lab, F.explode(arr).alias("term")), 1.0)


def predict_tabular(model: CountModel, df: DataFrame, keep: list[str], feature_cols: dict, k: int = 1) -> DataFrame:
    """Top k classes of every row, with its columns ``keep``.  Each feature looks its
    weights up in the model's table and the row adds them: rows need no id, and
    equal rows are scored each by itself.  More than IN_ROW_CLASSES classes are scored
    in blocks, rows by their number in a checkpoint."""
    if model.class_counts.limit(IN_ROW_CLASSES + 1).count() > IN_ROW_CLASSES:
        ensure_checkpoint_dir(df.sparkSession)
        own = df.select(*keep, F.array(*_tabular_terms(feature_cols)).alias("_terms"), F.monotonically_increasing_id().alias("row_id")).checkpoint()
        terms = own.select("row_id", F.explode("_terms").alias("term"), F.lit(1.0).alias("cnt"))
        return own.join(_in_blocks(model, terms, own, k, 4), "row_id").drop("row_id", "_terms")
    if k > 1:
        classes, weights = _scoring_tables(model)
        weights = bounded_broadcast(weights.persist(StorageLevel.MEMORY_AND_DISK))
        rows, found = df.select(*keep, *[t.alias(f"_t{i}") for i, t in enumerate(_tabular_terms(feature_cols))]), []
        for i in range(len(feature_cols)):
            rows = rows.join(weights.select(F.col("term").alias(f"_t{i}"), F.col("m").alias(f"_m{i}")), f"_t{i}", "left")
            found.append(F.struct(F.lit(1.0).alias("cnt"), F.col(f"_m{i}").alias("m")))
        rows = rows.select(*keep, F.filter(F.array(*found), lambda x: x["m"].isNotNull()).alias("ev"))
        return _rank_classes(rows.withColumn("L", F.size("ev").cast("double")), keep, classes, k)
    return _best_class(model, df, keep, _tabular_terms(feature_cols))


def _best_class(model: CountModel, df: DataFrame, keep: list[str], terms: list, places: int = 4) -> DataFrame:
    """The best class of every row, all in plain columns: a term's weights are one double
    a class, the row adds them up, and the greatest score names the class."""
    classes = _classes(model).orderBy("label").collect()  # at most IN_ROW_CLASSES
    met = model.term_counts.filter(F.col("n") > 0)
    wide = met.groupBy("term").agg(*[F.coalesce(F.max(F.when(F.col("label") == c["label"], F.log(F.col("n") + 1))), F.lit(0.0)).alias(f"w{j}") for j, c in enumerate(classes)])
    wide = bounded_broadcast(wide.persist(StorageLevel.MEMORY_AND_DISK))
    rows = df.select(*keep, *[t.alias(f"_t{i}") for i, t in enumerate(terms)])
    for i in range(len(terms)):
        rows = rows.join(wide.select(F.col("term").alias(f"_t{i}"), *[F.col(f"w{j}").alias(f"_w{i}_{j}") for j in range(len(classes))]), f"_t{i}", "left")
    known = sum((F.when(F.col(f"_w{i}_0").isNotNull(), 1.0).otherwise(0.0) for i in range(len(terms))), F.lit(0.0))
    rows = rows.withColumn("_L", known)
    score = lambda j, c: F.round(
        F.lit(float(c["prior"])) - F.col("_L") * F.lit(float(c["norm"])) + sum((F.coalesce(F.col(f"_w{i}_{j}"), F.lit(0.0)) for i in range(len(terms))), F.lit(0.0)), places
    )
    rows = rows.select(*keep, *[score(j, c).alias(f"_s{j}") for j, c in enumerate(classes)])
    scores = [F.col(f"_s{j}") for j in range(len(classes))]
    rows = rows.withColumn("_mx", F.greatest(*scores) if len(scores) > 1 else scores[0])
    label = F.coalesce(*[F.when(s == F.col("_mx"), F.lit(c["label"])) for s, c in zip(scores, classes)])  # ties: the first label
    z = sum((F.exp(s - F.col("_mx")) for s in scores), F.lit(0.0))
    return rows.select(*keep, label.alias("label"), F.col("_mx").alias("score"), F.round(F.lit(1.0) / z, 6).alias("prob"), F.lit(1).cast("bigint").alias("rank"))


# ---- M9: several labels per row, one-against-rest ---------------------------------

def fit_multilabel(df: DataFrame, id_col: str, text_col: str, labels_col: str) -> tuple[CountModel, CountModel]:
    """M9: per label, counts over the rows carrying it, plus counts over all rows
    (the rest of a label is all minus label)."""
    terms = doc_terms(df, id_col, text_col)
    lab = df.select(F.col(id_col).alias("row_id"), F.explode(F.array_distinct(labels_col)).alias("label"))
    pos = _fit(terms, lab, 1.0)
    everything = fit_text(df.select(id_col, text_col, F.lit("*").alias("label")), id_col, text_col, "label")
    return pos, everything


def predict_multilabel(fitted, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row_id, label, score): log-odds of label against not-label, 4 places."""
    pos, everything = fitted
    all_terms = everything.term_counts.select("term", F.col("n").alias("n_all"))
    tot = everything.class_counts.first()
    n_all, len_all = float(tot["docs"]), float(tot["len"])
    v = float(all_terms.count())
    terms = doc_terms(df, id_col, text_col)
    known = terms.join(all_terms, "term")
    length = known.groupBy("row_id").agg(F.sum("cnt").alias("L"))
    classes = pos.class_counts.select(
        "label",
        (F.log(F.col("docs")) - F.log(F.lit(n_all) - F.col("docs"))).alias("prior"),
        (F.log(F.lit(len_all) - F.col("len") + F.lit(v)) - F.log(F.col("len") + F.lit(v))).alias("norm"),
    )
    # every row gets every label: the result is that large
    listed = F.explode(classes.agg(F.collect_list(F.struct("label", "prior", "norm"))).scalar()).alias("_c")
    missed = known.groupBy("row_id").agg(F.sum(F.col("cnt") * F.log(F.col("n_all") + 1)).alias("missed"))
    base = (
        df.select(F.col(id_col).alias("row_id")).join(length, "row_id", "left").join(missed, "row_id", "left")
        .select("row_id", "L", "missed", listed)
        .select(
            "row_id", F.col("_c.label").alias("label"),
            (F.col("_c.prior") + F.coalesce(F.col("L"), F.lit(0.0)) * F.col("_c.norm") - F.coalesce("missed", F.lit(0.0))).alias("s"),
        )
    )
    # a term that a label has not met adds -ln(n_all + 1), summed above; only terms that it has met are joined
    met = known.join(pos.term_counts.filter(F.col("n") > 0), "term")
    bonus = met.groupBy("row_id", "label").agg(
        F.sum(F.col("cnt") * (F.log(F.col("n") + 1) - F.log(F.col("n_all") - F.col("n") + 1) + F.log(F.col("n_all") + 1))).alias("b")
    )
    return base.join(bonus, ["row_id", "label"], "left").select(
        "row_id", "label", F.round(F.col("s") + F.coalesce("b", F.lit(0.0)), 4).alias("score")
    )


# ---- M6: text to id -----------------------------------------------------------------

def cold_start(corpus: DataFrame, id_col: str, strong: str | None, weak: str | None, phrase_len: int = 8) -> CountModel:
    """M6: learns text to id from an unlabelled catalogue: the pseudo queries of P11 (the
    strong text, phrases of the weak one) train a count model with the id as class.
    ``predict`` then gives the best ids for any text, whatever the size of the catalogue."""
    pairs = prep.cold_start_pairs(corpus, id_col, strong, weak, phrase_len)
    return fit_text(pairs, "doc_id", "query", "doc_id")


# ---- M3: MLlib logistic regression --------------------------------------------------

def fit_linear(df: DataFrame, feature_cols: list[str], label_col: str, max_iter: int = 50):
    """M3: iterative classifier on numeric feature columns (treeAggregate inside MLlib)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    pipe = Pipeline(
        stages=[
            VectorAssembler(inputCols=feature_cols, outputCol="_raw", handleInvalid="keep"),
            StandardScaler(inputCol="_raw", outputCol="features"),
            LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter, regParam=0.0),
        ]
    )
    return pipe.fit(df.withColumn(label_col, F.col(label_col).cast("double")))


def predict_linear(model, df: DataFrame, id_col: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    return out.select(F.col(id_col), F.round(vector_to_array("probability")[1], 6).alias("p1"), F.col("prediction").cast("bigint").alias("pred"))


# ---- M3 on mixed columns --------------------------------------------------------------

def _design(df: DataFrame, spec: FeatureSpec) -> tuple[DataFrame, list[str], list[str], list[str]]:
    """The declared columns as inputs of a design row: scaled numbers, category strings
    and token lists.  A number stands as itself (F2, clipped to its range) and as its bin;
    a missing value is a category of its own."""
    spec.check_columns(df)
    numbers, names, lists, out = [], [], [], []
    for c, kind in spec.types.items():
        if c == spec.target:
            continue
        text = F.col(c).cast("string")
        if isinstance(kind, Numerical):
            scaled, bin_ = numerical(F.col(c).cast("string").try_cast("double"), *kind.range, kind.bins)
            out += [F.coalesce(scaled, F.lit(0.0)).alias(f"_{c}_x"), F.coalesce(bin_.cast("string"), F.lit("?")).alias(f"_{c}_bin")]
            numbers.append(f"_{c}_x")
            names.append(f"_{c}_bin")
        elif isinstance(kind, Date):
            day = text.try_cast("date")
            for part in date_parts(day):
                name = f"_{c}_{len(out)}"
                out.append(F.coalesce(part.cast("string"), F.lit("?")).alias(name))
                names.append(name)
        elif isinstance(kind, Text):
            t = tokens(F.coalesce(text, F.lit("")))
            grams = t if kind.word_n <= 1 else F.concat(t, word_ngrams(t, kind.word_n))
            if kind.char_k > 0:
                grams = F.concat(grams, F.flatten(F.transform(t, lambda x: char_grams(x, kind.char_k))))  # noqa: B023 - used at once
            out.append(grams.alias(f"_{c}_t"))
            lists.append(f"_{c}_t")
        elif isinstance(kind, Categorical) and kind.delimiter:
            out.append(F.coalesce(F.split(text, re.escape(kind.delimiter)), F.array().cast("array<string>")).alias(f"_{c}_t"))
            lists.append(f"_{c}_t")
        else:
            out.append(F.coalesce(text, F.lit("?")).alias(f"_{c}_c"))
            names.append(f"_{c}_c")
    return df.select("*", *out), numbers, names, lists


@dataclass(frozen=True)
class MixedModel:
    spec: FeatureSpec
    pipeline: object  # the fitted MLlib pipeline


def fit_mixed(df: DataFrame, spec: FeatureSpec, width: int = 1 << 16, crosses: list[tuple[str, str]] = (), max_iter: int = 50, reg: float = 1e-4) -> MixedModel:
    """M3 on mixed columns: an iterative classifier over sparse hashed rows.

    Numbers, categories, dates, delimited values, texts and the listed ``crosses`` of two
    columns (F9) are hashed into ``width`` places a group of columns (F7), all inside the
    JVM; the fit sums gradients over the partitions.  The target is 0 or 1; rows without it
    are left out.

    The assembler names every place of the vector in its column's metadata, which each task
    of each iteration would carry; the fit reads the vectors without it from a checkpoint."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import FeatureHasher, HashingTF, VectorAssembler

    rows, numbers, names, lists = _design(_crossed(df, crosses), _with_crosses(spec, crosses))
    stages, parts = [], []
    if numbers or names:
        stages.append(FeatureHasher(inputCols=numbers + names, outputCol="_hashed", numFeatures=width, categoricalCols=names))
        parts.append("_hashed")
    for c in lists:
        stages.append(HashingTF(inputCol=c, outputCol=f"{c}_v", numFeatures=width, binary=True))
        parts.append(f"{c}_v")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    ensure_checkpoint_dir(df.sparkSession)
    rows = rows.withColumn("_label", F.col(spec.target).cast("double")).where("_label is not null").select("_label", *numbers, *names, *lists)
    vectors = PipelineModel(stages).transform(rows).select("_label", F.col("features").alias("features", metadata={})).checkpoint()
    fitted = LogisticRegression(featuresCol="features", labelCol="_label", maxIter=max_iter, regParam=reg, standardization=False).fit(vectors)
    return MixedModel(_with_crosses(spec, crosses), (tuple(crosses), PipelineModel([*stages, fitted])))


def _crossed(df: DataFrame, crosses) -> DataFrame:
    return df.select("*", *[F.concat_ws("|", F.col(a).cast("string"), F.col(b).cast("string")).alias(f"{a}__{b}") for a, b in crosses])


def _with_crosses(spec: FeatureSpec, crosses) -> FeatureSpec:
    return FeatureSpec({**spec.types, **{f"{a}__{b}": Categorical() for a, b in crosses}}, spec.target)


def predict_mixed(model: MixedModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with p1, the probability of class 1, and pred.  The target
    need not be there."""
    from pyspark.ml.functions import vector_to_array

    crosses, fitted = model.pipeline
    rows, numbers, names, lists = _design(_crossed(df, crosses), FeatureSpec({c: t for c, t in model.spec.types.items() if c != model.spec.target}))
    found = fitted.transform(rows.select(*[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)], *numbers, *names, *lists))
    return found.select(
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], F.round(vector_to_array("probability")[1], 6).alias("p1"), F.col("prediction").cast("bigint").alias("pred")
    )
