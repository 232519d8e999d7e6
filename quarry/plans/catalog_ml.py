"""Registered queries: encoding, splits, ensembles and metrics (K1-K8,
K15-K23, SQL-checked) and model jobs (K9-K14, K18, K24-K26, rows-only)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as K
from ..operators import models as M
from ..operators import evaluate as V
from ..operators.clean import apply_fill, fit_median_fill
from .fixtures import SCORED_CTE, dirty_orders, scored_labels
from .registry import register, table
from .sqlgen import with_dirty

R = 6


@register("label_encode", """
SELECT p_partkey, p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type_code FROM part""")
def label_encode(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    return K.label_encode(p, "p_type")


@register("label_encode_unseen", """
WITH v AS (SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS code
           FROM (SELECT DISTINCT p_type FROM part WHERE p_type <> 'ECONOMY'))
SELECT p_partkey, p_type, coalesce(code, -1) AS p_type_code FROM part LEFT JOIN v USING (p_type)""")
def label_encode_unseen(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    vocab = K.fit_label_encoder(p.where(F.col("p_type") != "ECONOMY"), "p_type")
    return K.apply_label_encoder(p, "p_type", vocab, unseen=-1)


@register("shared_label_encode", """
WITH v AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code FROM (
  SELECT CAST(c_nationkey AS VARCHAR) AS value FROM customer UNION SELECT CAST(s_nationkey AS VARCHAR) FROM supplier))
SELECT 'customer' AS src, c_custkey AS id, code AS nation_code FROM customer JOIN v ON CAST(c_nationkey AS VARCHAR) = value
UNION ALL
SELECT 'supplier', s_suppkey, code FROM supplier JOIN v ON CAST(s_nationkey AS VARCHAR) = value""")
def shared_label_encode(spark, sf):
    """One vocabulary over the union of both tables' values."""
    c = table(spark, sf, "customer").select(F.lit("customer").alias("src"), F.col("c_custkey").alias("id"),
                                            F.col("c_nationkey").cast("string").alias("nation"))
    s = table(spark, sf, "supplier").select(F.lit("supplier").alias("src"), F.col("s_suppkey").alias("id"),
                                            F.col("s_nationkey").cast("string").alias("nation"))
    both = c.unionByName(s)
    vocab = K.fit_label_encoder(both, "nation")
    return K.apply_label_encoder(both, "nation", vocab, "nation_code").select("src", "id", "nation_code")


_SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@register("standard_scale", f"""
WITH s AS (SELECT {", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in _SCALE_COLS)}
           FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')
SELECT l_orderkey, l_linenumber, {", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _SCALE_COLS)}
FROM lineitem, s""")
def standard_scale(spark, sf):
    """K4: fitted on earlier shipments, applied to all (population std)."""
    li = table(spark, sf, "lineitem")
    params = K.fit_standard_scaler(li.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")),
                                   _SCALE_COLS)
    out = K.apply_standard_scaler(li.select("l_orderkey", "l_linenumber", *_SCALE_COLS), params)
    return out.select("l_orderkey", "l_linenumber", *[F.round(c, R).alias(c) for c in _SCALE_COLS])


@register("fit_apply_median", with_dirty("""
, m AS (SELECT median(amount) AS m_amount, median(age) AS m_age FROM dirty WHERE date_text < '1998-01-01')
SELECT id, coalesce(amount, m_amount) AS amount, coalesce(age, CAST(round_even(m_age, 0) AS INTEGER)) AS age
FROM dirty, m"""))
def fit_apply_median(spark, sf):
    """K5: medians fitted on the earlier rows, applied to every row."""
    d = dirty_orders(table(spark, sf, "orders")).select("id", "amount", "age", "date_text")
    values = fit_median_fill(d.where(F.col("date_text") < "1998-01-01"), ["amount", "age"])
    return apply_fill(d, values).select("id", "amount", "age")


@register("stratified_split", """
SELECT doc_id, quality, CAST(r - 1 < round(n * 0.2) AS INTEGER) AS is_test FROM (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR))) AS r,
         count(*) OVER (PARTITION BY quality) AS n FROM labels)""")
def stratified_split(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return K.stratified_split(lab, "quality", "doc_id", 0.2)


@register("fold_assign", """
SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR))) - 1) % 5
       AS INTEGER) AS fold FROM labels""")
def fold_assign(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return K.fold_assign(lab, "quality", "doc_id", 5)


_MEMBERS_SQL = """members AS (SELECT doc_id, quality, score AS p1, (doc_id * 31 % 100) / 100.0 AS p2,
  (doc_id * 17 % 100) / 100.0 AS p3 FROM scored)"""


def _members(spark, sf):
    s = scored_labels(table(spark, sf, "labels"))
    return s.select("doc_id", "quality", F.col("score").alias("p1"),
                    ((F.col("doc_id") * 31) % 100 / 100.0).alias("p2"),
                    ((F.col("doc_id") * 17) % 100 / 100.0).alias("p3"))


@register("soft_vote", f"""
WITH {SCORED_CTE}, {_MEMBERS_SQL}
SELECT doc_id, round(p1 * 0.5 + p2 * 0.3 + p3 * 0.2, 6) AS prob, CAST(p1 * 0.5 + p2 * 0.3 + p3 * 0.2 > 0.5 AS INTEGER) AS pred,
       round(p1 * (1.0 / 3) + p2 * (1.0 / 3) + p3 * (1.0 / 3), 6) AS prob_mean
FROM members""")
def soft_vote(spark, sf):
    """Weighted and equal-weight soft votes over member scores."""
    m = _members(spark, sf)
    ps = [F.col("p1"), F.col("p2"), F.col("p3")]
    prob = V.soft_vote(ps, [0.5, 0.3, 0.2])
    return m.select("doc_id", F.round(prob, R).alias("prob"), (prob > 0.5).cast("int").alias("pred"),
                    F.round(V.soft_vote(ps), R).alias("prob_mean"))


@register("hard_vote", f"""
WITH {SCORED_CTE}, {_MEMBERS_SQL}
SELECT doc_id, CAST(CAST(p1 > 0.5 AS INTEGER) + CAST(p2 > 0.5 AS INTEGER) + CAST(p3 > 0.5 AS INTEGER) >= 2 AS INTEGER) AS pred
FROM members""")
def hard_vote(spark, sf):
    m = _members(spark, sf)
    return m.select("doc_id", V.hard_vote([(F.col(p) > 0.5).cast("int") for p in ("p1", "p2", "p3")]).alias("pred"))


@register("accuracy", f"WITH {SCORED_CTE} SELECT round(avg(CAST(quality = prediction AS DOUBLE)), 6) AS accuracy FROM scored")
def accuracy(spark, sf):
    a = V.accuracy(scored_labels(table(spark, sf, "labels")), "quality", "prediction")
    return a.select(F.round("accuracy", R).alias("accuracy"))


@register("roc_auc", f"""
WITH {SCORED_CTE}, r AS (SELECT quality, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS ar
                         FROM scored)
SELECT round((sum(ar) FILTER (WHERE quality = 1) - count(*) FILTER (WHERE quality = 1) * (count(*) FILTER (WHERE quality = 1) + 1) / 2.0)
             / (count(*) FILTER (WHERE quality = 1) * count(*) FILTER (WHERE quality <> 1)), 6) AS auc FROM r""")
def roc_auc(spark, sf):
    a = V.roc_auc(scored_labels(table(spark, sf, "labels")), "quality", "score")
    return a.select(F.round("auc", R).alias("auc"))


@register("roc_curve", f"""
WITH {SCORED_CTE}, t AS (SELECT score, count(*) FILTER (WHERE quality = 1) AS pos, count(*) FILTER (WHERE quality <> 1) AS neg
                         FROM scored GROUP BY score)
SELECT score AS threshold,
       round(sum(pos) OVER (ORDER BY score DESC) / sum(pos) OVER (), 6) AS tpr,
       round(sum(neg) OVER (ORDER BY score DESC) / sum(neg) OVER (), 6) AS fpr FROM t""")
def roc_curve(spark, sf):
    c = V.roc_curve(scored_labels(table(spark, sf, "labels")), "quality", "score")
    return c.select("threshold", F.round("tpr", R).alias("tpr"), F.round("fpr", R).alias("fpr"))


@register("confusion", f"""
WITH {SCORED_CTE}, g AS (SELECT a.label, b.prediction FROM (SELECT unnest([0, 1]) AS label) a, (SELECT unnest([0, 1]) AS prediction) b)
SELECT g.label, g.prediction, count(s.doc_id) AS n FROM g LEFT JOIN scored s ON s.quality = g.label AND s.prediction = g.prediction
GROUP BY g.label, g.prediction""")
def confusion(spark, sf):
    return V.confusion(scored_labels(table(spark, sf, "labels")), "quality", "prediction")


@register("rmse", f"""
WITH {SCORED_CTE} SELECT round(sqrt(avg(pow(score - quality, 2))), 6) AS rmse,
  round(sqrt(avg(pow(ln(1 + score) - ln(1 + quality), 2))), 6) AS rmsle FROM scored""")
def rmse(spark, sf):
    r = V.rmse(scored_labels(table(spark, sf, "labels")), "quality", "score")
    return r.select(F.round("rmse", R).alias("rmse"), F.round("rmsle", R).alias("rmsle"))


# Leave-one-out distance-weighted KNN (k=15, Euclidean) over embeddings.
# The oracle is brute force: every pair, ranked by (distance, id).
KNN_SQL = """
WITH p AS (
  SELECT q.vec_id, q.label, c.vec_id AS did, c.label AS dlabel,
         sqrt(list_sum(list_transform(list_zip(q.embedding, c.embedding),
              lambda t: (t[1]::DOUBLE - t[2]::DOUBLE) * (t[1]::DOUBLE - t[2]::DOUBLE)))) AS d
  FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id
  WHERE q.embedding IS NOT NULL AND c.embedding IS NOT NULL),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, did) AS rn FROM p) WHERE rn <= 15),
z AS (SELECT vec_id, min(d) = 0 AS has0 FROM k GROUP BY vec_id),
w AS (SELECT k.vec_id, k.label, k.dlabel,
             sum(CASE WHEN z.has0 THEN CAST(k.d = 0 AS DOUBLE) ELSE 1.0 / k.d END) AS wt
      FROM k JOIN z USING (vec_id) GROUP BY k.vec_id, k.label, k.dlabel)
SELECT vec_id, label, dlabel AS pred FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY wt DESC, dlabel) AS rn FROM w) WHERE rn = 1"""


@register("ann_recall", """
SELECT count(*) AS indexed, count(*) FILTER (vec_id % 100 = 0) AS queries, 15 * count(*) FILTER (vec_id % 100 = 0) AS neighbours,
       TRUE AS ranks_follow_distance, TRUE AS recall_at_least_90 FROM embeddings""")
def ann_recall(spark, sf):
    """Every row in the index; the neighbours of all rows whose id is
    divisible by 100, held against the exact way."""
    from ..operators import ann
    from ..session import reliable_checkpoint
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    queries = e.where(F.col("vec_id") % 100 == 0)
    quantiser = ann.fit_quantiser(e, "vec_id", "embedding")
    index = reliable_checkpoint(ann.build_index(e, "vec_id", "embedding", quantiser))
    found = reliable_checkpoint(ann.search(queries, e, "vec_id", "embedding", quantiser, index=index))
    share = ann.recall(found, ann.exact_search(queries, e, "vec_id", "embedding"))
    later = found.select("query", (F.col("rank") - 1).alias("rank"), F.col("distance").alias("next"))
    order = found.join(later, ["query", "rank"]).agg(F.coalesce(F.bool_and(F.col("distance") <= F.col("next")), F.lit(True)).alias("ranks_follow_distance"))
    counts = found.agg(F.count_distinct("query").alias("queries"), F.count(F.lit(1)).alias("neighbours"),
                       F.coalesce(F.bool_and(F.col("query") != F.col("id")), F.lit(True)).alias("others"))
    one = index.agg(F.count_distinct("_id").alias("indexed"))
    for part in (counts, order, share):  # a row each
        one = one.join(F.broadcast(part))
    return one.select("indexed", "queries", "neighbours", (F.col("ranks_follow_distance") & F.col("others")).alias("ranks_follow_distance"),
                      (F.col("recall") >= 0.9).alias("recall_at_least_90"))


@register("ann_search")
def ann_search(spark, sf):
    """The 15 approximate neighbours of every row whose id is divisible
    by 100 among all rows."""
    from ..operators import ann
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    quantiser = ann.fit_quantiser(e, "vec_id", "embedding")
    return ann.search(e.where(F.col("vec_id") % 100 == 0), e, "vec_id", "embedding", quantiser)


@register("knn_classify", KNN_SQL)
def knn_classify(spark, sf):
    from ..operators.neighbors import knn_classify as knn
    return knn(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", k=15)


@register("knn_accuracy", f"""
WITH r AS ({KNN_SQL})
SELECT count(*) AS n, round(avg(CAST(label = pred AS DOUBLE)), 6) AS accuracy FROM r""")
def knn_accuracy(spark, sf):
    r = knn_classify(spark, sf)
    return r.agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.avg((F.col("label") == F.col("pred")).cast("double")), R).alias("accuracy"))


# ---------------------------------------------------------------------------
# Model jobs (rows-only checks): document quality from text statistics.

_DOC_NUM = ["log_chars", "n_words", "n_lines", "digit_ratio", "upper_ratio", "punct_ratio", "avg_word_len"]
_DOC_CAT = ["lang", "source"]


def doc_features(spark, sf, labelled=True):
    """Text statistics per document (whole texts, built-in functions), with
    the quality label; ``labelled=False`` keeps documents without one."""
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    # joined first (only these texts are read through) and dealt by id: a file of
    # few row groups would leave them to few tasks
    d = table(spark, sf, "documents").join(lab, "doc_id", "inner" if labelled else "left").repartition("doc_id")
    n = F.greatest(F.length("text"), F.lit(1))
    words = F.size(F.split(F.trim("text"), r"\s+"))
    return d.select(
        "doc_id", "lang", "source",
        F.log1p(F.col("n_chars").cast("double")).alias("log_chars"),
        words.cast("double").alias("n_words"),
        (F.regexp_count("text", F.lit("\n")) + 1).cast("double").alias("n_lines"),
        (F.regexp_count("text", F.lit("[0-9]")) / n).alias("digit_ratio"),
        (F.regexp_count("text", F.lit("[A-Z]")) / n).alias("upper_ratio"),
        (F.regexp_count("text", F.lit("[^A-Za-z0-9\\s]")) / n).alias("punct_ratio"),
        (F.length(F.regexp_replace("text", r"\s+", "")) / F.greatest(words, F.lit(1))).alias("avg_word_len"), "label")


def _split_folds(spark, sf):
    """Hold-out split and folds, frozen once (every fit re-reads the
    checkpoint instead of re-deriving features from the texts)."""
    from ..session import reliable_checkpoint, right_size
    # written first: the range sampling of the split reads its input twice
    f = reliable_checkpoint(doc_features(spark, sf))
    s = K.stratified_split(f, "label", "doc_id", 0.2)
    both = K.fold_assign(s, "label", "doc_id", 5)
    both = right_size(reliable_checkpoint(both))
    return both.where("is_test = 0"), both.where("is_test = 1")


def _stages():
    return M.feature_stages(_DOC_CAT, _DOC_NUM)


@register("ml_logreg")
def ml_logreg(spark, sf):
    """L2 and L1 logistic regression over a small C grid, CV by folds."""
    train, _ = _split_folds(spark, sf)
    grid = [{"regParam": 0.1, "elasticNetParam": 0.0}, {"regParam": 0.01, "elasticNetParam": 0.0},
            {"regParam": 0.01, "elasticNetParam": 1.0}]
    return M.grid_search(spark, _stages(), "logreg", grid, train)


@register("ml_rf")
def ml_rf(spark, sf):
    """Random forest, hold-out accuracy and predictions."""
    train, test = _split_folds(spark, sf)
    m = M.fit_pipeline(_stages(), M.classifier("rf"), train)
    pred = m.transform(test)
    acc = M.evaluator("accuracy").evaluate(pred)
    return pred.select("doc_id", F.col("prediction").cast("int").alias("prediction"),
                       F.lit(acc).alias("holdout_accuracy"))


@register("ml_feature_importance")
def ml_feature_importance(spark, sf):
    """Ranked random-forest importances."""
    train, _ = _split_folds(spark, sf)
    m = M.fit_pipeline(_stages(), M.classifier("rf"), train)
    return M.feature_importances(m, [f"{c}_idx" for c in _DOC_CAT] + _DOC_NUM, spark)


@register("ml_gbt")
def ml_gbt(spark, sf):
    """Gradient-boosted trees, per-fold CV accuracy."""
    train, _ = _split_folds(spark, sf)
    return M.cv_scores(spark, _stages(), M.classifier("gbt"), train)


@register("ml_svc")
def ml_svc(spark, sf):
    """Linear SVM stand-in for the kernel SVC member."""
    train, test = _split_folds(spark, sf)
    m = M.fit_pipeline(_stages(), M.classifier("svc"), train)
    return M.positive_probability(m.transform(test), "p1").select("doc_id", "prediction", "p1")


@register("ml_cv")
def ml_cv(spark, sf):
    """CV summary per model family, best first (top 2 kept)."""
    train, _ = _split_folds(spark, sf)
    out = None
    scores = M.cv_scores_by(spark, _stages(), {kind: M.classifier(kind) for kind in ("logreg", "rf", "svc")}, train)
    for kind in scores:
        s = M.cv_summary(scores[kind])
        s = s.select(F.lit(kind).alias("model"), "cv_mean", "cv_2std")
        out = s if out is None else out.unionByName(s)
    return out.orderBy(F.desc("cv_mean"), "model").limit(2)


@register("ml_stacking")
def ml_stacking(spark, sf):
    """Out-of-fold stacking over all five folds with a logistic
    meta-learner and a forest fitted again on all training rows."""
    train, test = _split_folds(spark, sf)
    members = {"logreg": M.classifier("logreg"), "rf": M.classifier("rf")}
    return M.oof_stacking(spark, _stages(), members, train, test, "doc_id", refit=M.classifier("rf"))


@register("ml_soft_ensemble")
def ml_soft_ensemble(spark, sf):
    """K15/K17 with fitted members: soft vote of member probabilities by id."""
    from ..operators.evaluate import soft_vote
    train, test = _split_folds(spark, sf)
    probs = None
    for kind in ("logreg", "rf", "gbt"):
        m = M.fit_pipeline(_stages(), M.classifier(kind), train)
        p = M.positive_probability(m.transform(test), kind).select("doc_id", kind)
        probs = p if probs is None else probs.join(p, "doc_id")
    prob = soft_vote([F.col("logreg"), F.col("rf"), F.col("gbt")], [0.3, 0.4, 0.3])
    return probs.select("doc_id", prob.alias("prob"), (prob > 0.5).cast("int").alias("prediction"))


@register("ml_score")
def ml_score(spark, sf):
    """Persist the fitted pipeline, reload it, batch-score all documents."""
    from pyspark.ml import PipelineModel
    from ..session import scratch_path
    train, _ = _split_folds(spark, sf)
    m = M.fit_pipeline(_stages(), M.classifier("logreg"), train)
    path = scratch_path(spark, "model")
    m.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    everything = doc_features(spark, sf, labelled=False).drop("label")
    scored = M.positive_probability(loaded.transform(everything), "p1").select(
        "doc_id", F.col("prediction").cast("int").alias("prediction"), "p1")
    # The prediction table as CSV with a header, read back.
    from ..sources.sinks import write_by_suffix
    out = scratch_path(spark, "predictions") + ".csv"
    write_by_suffix(scored, out)
    return spark.read.option("header", True).schema(scored.schema).csv(out)


@register("ml_regression")
def ml_regression(spark, sf):
    """Ridge, lasso, elastic net and two boosted forests on log
    price, averaged, expm1 back; the members' predictions are kept."""
    li = table(spark, sf, "lineitem")
    part = table(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size", "p_type")
    from ..session import reliable_checkpoint
    # (l_orderkey, l_linenumber) is not unique in the data: a frozen row id.
    d = (li.join(part, li.l_partkey == part.p_partkey)
         .select(F.monotonically_increasing_id().alias("_row_id"), "l_quantity", "l_discount",
                 "l_tax", "p_retailprice", F.col("p_size").cast("double").alias("p_size"), "p_type",
                 F.log1p("l_extendedprice").alias("y"), "l_extendedprice", "l_shipdate"))
    from ..session import right_size
    d = right_size(reliable_checkpoint(d))
    train = d.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    test = d.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    stages = M.feature_stages(["p_type"], ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"])
    members = [("linear", {"regParam": 0.1, "elasticNetParam": 0.0}), ("linear", {"regParam": 0.001, "elasticNetParam": 1.0}),
               ("linear", {"regParam": 0.01, "elasticNetParam": 0.5}), ("gbt", {"maxIter": 30}), ("gbt", {"maxIter": 30, "maxDepth": 3})]
    used = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size", "p_type", "y"]
    # written once: the error and the rows returned do not score the lines again
    j = reliable_checkpoint(M.regression_average(stages, train.select(*used), test, "y", members, keep=("y", "l_extendedprice")))
    rmsle = j.agg(F.sqrt(F.avg(F.pow(F.col("log_prediction") - F.col("y"), 2)))).first()[0]
    return j.select("_row_id", *[f"p{i}" for i in range(len(members))], "prediction", "l_extendedprice", F.lit(rmsle).alias("rmsle"))


@register("boosted_facts", """
SELECT (SELECT count(*) FROM documents JOIN labels USING (doc_id)) AS scored, (SELECT count(*) FROM part WHERE p_partkey % 5 = 0) AS priced,
       TRUE AS probabilities_in_range, TRUE AS importances_sum_to_one, TRUE AS beats_the_mean, TRUE AS beats_the_majority, 50 AS trees""")
def boosted_facts(spark, sf):
    """Second-order boosting; a classifier of document quality, scored on
    all labelled documents and held against the majority on the hold-out, and
    a regressor of part prices, held against the mean on every fifth part."""
    from ..operators.boosting import fit_boosted
    train, test = _split_folds(spark, sf)
    quality = fit_boosted(train, _DOC_NUM, "label")
    done = train.unionByName(test).select("label", "is_test", quality.column().alias("p"))
    held, hit = F.col("is_test") == 1, ((F.col("p") >= 0.5).cast("int") == F.col("label")).cast("int")
    share = F.avg(F.when(held, F.col("label")))
    scored = done.agg(F.count(F.lit(1)).alias("scored"), F.min(F.col("p").between(0, 1)).alias("probabilities_in_range"),
                      (F.avg(F.when(held, hit)) > F.greatest(share, 1 - share)).alias("beats_the_majority"))
    part = table(spark, sf, "part").select("p_partkey", "p_size", (F.col("p_partkey") % 1000).alias("k"), F.floor(F.col("p_partkey") / 10).alias("d"), "p_retailprice")
    fifth = F.col("p_partkey") % 5 == 0
    price = fit_boosted(part.where(~fifth), ["k", "d", "p_size"], "p_retailprice", "squared")
    y = F.col("p_retailprice")
    priced = part.where(fifth).select(y, price.column().alias("p")).agg(
        F.count(F.lit(1)).alias("priced"), (F.avg(F.pow(F.col("p") - y, 2)) < 0.1 * F.var_pop(y)).alias("beats_the_mean"))
    sums = [m.importances(spark).agg(F.sum("importance")).first()[0] for m in (quality, price)]
    return scored.join(F.broadcast(priced)).select(  # one row each
        "scored", "priced", "probabilities_in_range", F.lit(all(abs(s - 1) < 1e-9 for s in sums)).alias("importances_sum_to_one"),
        "beats_the_mean", "beats_the_majority", F.lit(price.table(spark).count()).cast("int").alias("trees"))


@register("ml_tabular_job")
def ml_tabular_job(spark, sf):
    """The model scripts end to end (features, fills, encoding, CV members,
    weighted soft vote) on orders x customers; prediction table written as
    CSV and read back (B9)."""
    from ..session import scratch_path
    from ..sources.sinks import write_by_suffix
    from .tabular_job import run
    pred = run(spark, table(spark, sf, "orders"), table(spark, sf, "customer"), "1999-01-01")
    out = scratch_path(spark, "order-predictions") + ".csv"
    write_by_suffix(pred.select("o_orderkey", "prediction"), out)
    return spark.read.option("header", True).schema("o_orderkey bigint, prediction int").csv(out)


# ---------------------------------------------------------------------------
# Facts about the model jobs that SQL can state: row counts, ids, ranges.

@register("ml_score_facts", """
SELECT count(*) AS n, count(DISTINCT doc_id) AS ids, sum(doc_id)::BIGINT AS id_sum, TRUE AS in_range, TRUE AS agrees FROM documents""")
def ml_score_facts(spark, sf):
    """Every document is scored once; the prediction follows the probability."""
    r = ml_score(spark, sf)
    return r.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids"), F.sum("doc_id").alias("id_sum"),
                 F.min(F.col("p1").between(0, 1)).alias("in_range"),
                 F.min((F.col("p1") > 0.5).cast("int") == F.col("prediction")).alias("agrees"))


@register("ml_stacking_facts", """
SELECT count(*) AS labelled, TRUE AS whole, TRUE AS mean_of_three FROM documents JOIN labels USING (doc_id)""")
def ml_stacking_facts(spark, sf):
    """Every training row has out-of-fold probabilities, test and
    training rows are all labelled rows, and the score is the mean of three."""
    r = ml_stacking(spark, sf)
    mean = ((F.col("logreg") + F.col("rf")) / 2 + F.col("meta") + F.col("refit")) / 3
    return r.agg((F.count(F.lit(1)) + F.max("train_rows")).alias("labelled"), F.min(F.col("oof_rows") == F.col("train_rows")).alias("whole"),
                 F.min(F.abs(mean - F.col("final")) < 1e-9).alias("mean_of_three"))


@register("ml_regression_facts", """
SELECT count(*) AS n, round(sum(l_extendedprice), 2) AS price_sum, TRUE AS mean_of_members, TRUE AS rmsle_agrees
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_shipdate >= TIMESTAMP '1998-01-01'""")
def ml_regression_facts(spark, sf):
    """Every later line is predicted; the prediction is the members'
    mean; the stated error is that of the rows."""
    r = ml_regression(spark, sf)
    mean = F.expm1(sum(F.col(f"p{i}") for i in range(5)) / 5)
    return r.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price_sum"),
                 F.min(F.abs(mean - F.col("prediction")) <= 1e-6 * F.abs("prediction")).alias("mean_of_members"),
                 (F.abs(F.max("rmsle") - F.sqrt(F.avg(F.pow(F.log1p("prediction") - F.log1p("l_extendedprice"), 2)))) < 1e-6)
                 .alias("rmsle_agrees"))


@register("ml_kernel_svc_facts", """
SELECT count(*) AS scored, sum(CAST((2 * l_quantity - 51) ** 2 * 10 + (round(100 * l_discount) - 5) ** 2 * 833 < 15827 AS INTEGER))::BIGINT AS inside,
       TRUE AS beats_the_majority, TRUE AS beats_the_linear FROM lineitem WHERE l_orderkey % 5 = 0""")
def ml_kernel_svc_facts(spark, sf):
    """Which lines lie inside an ellipse of quantity and discount, by a
    linear machine and by one on Fourier features; every fifth order is held
    out.  No line separates the classes, so only the kernel machine can."""
    from ..session import reliable_checkpoint
    q, d = 2 * F.col("l_quantity") - 51, F.round(100 * F.col("l_discount")) - 5
    rows = reliable_checkpoint(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", (q * q * 10 + d * d * 833 < 15827).cast("double").alias("label")))
    train, test = rows.where("l_orderkey % 5 <> 0"), rows.where("l_orderkey % 5 = 0")
    out = test
    for kind in ("svc", "rbf_svc"):
        m = M.fit_pipeline(M.feature_stages([], ["l_quantity", "l_discount"]), M.classifier(kind), train)
        hit = (F.col("prediction") == F.col("label")).cast("int").alias(kind)
        out = m.transform(out).select("label", *[c for c in ("l_quantity", "l_discount", "svc") if c in out.columns], hit)
    share = F.avg("label")
    return out.agg(F.count(F.lit(1)).alias("scored"), F.sum("label").cast("long").alias("inside"),
                   (F.avg("rbf_svc") > F.greatest(share, 1 - share) + 0.1).alias("beats_the_majority"),
                   (F.avg("rbf_svc") > F.avg("svc") + 0.1).alias("beats_the_linear"))


@register("ml_members_facts", """
WITH l AS (SELECT doc_id, quality FROM documents JOIN labels USING (doc_id)),
t AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR))) AS r, count(*) OVER (PARTITION BY quality) AS n FROM l),
h AS (SELECT * FROM t WHERE r - 1 < round(n * 0.2))
SELECT model, count(*) AS n, sum(doc_id)::BIGINT AS id_sum, sum(quality)::BIGINT AS positives, TRUE AS in_range, TRUE AS beats_the_majority
FROM h, (SELECT unnest(['logreg', 'rf', 'svc', 'rbf_svc']) AS model) GROUP BY model""")
def ml_members_facts(spark, sf):
    """Each member scores exactly the hold-out rows of the
    stratified split, with probabilities, and beats the larger class's share."""
    train, test = _split_folds(spark, sf)
    out = None
    for kind in ("logreg", "rf", "svc", "rbf_svc"):
        pred = M.positive_probability(M.fit_pipeline(_stages(), M.classifier(kind), train).transform(test), "p1")
        share = F.avg("label")
        facts = pred.agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("id_sum"), F.sum("label").cast("long").alias("positives"),
                         F.min(F.col("p1").between(0, 1)).alias("in_range"),
                         (F.avg((F.col("prediction") == F.col("label")).cast("int")) > F.greatest(share, 1 - share)).alias("beats_the_majority"))
        facts = facts.withColumn("model", F.lit(kind))
        out = facts if out is None else out.unionByName(facts)
    return out


_FOLDS_SQL = """l AS (SELECT doc_id, quality FROM documents JOIN labels USING (doc_id)),
t AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR))) AS r, count(*) OVER (PARTITION BY quality) AS n FROM l)"""


@register("ml_cv_facts", f"""
WITH {_FOLDS_SQL}
SELECT model, ((r - 1) % 5)::INTEGER AS fold, count(*) AS n, sum(doc_id)::BIGINT AS id_sum, sum(quality)::BIGINT AS positives,
       TRUE AS whole_hits, TRUE AS beats_the_majority
FROM t, (SELECT unnest(['logreg', 'rf', 'svc']) AS model) WHERE r - 1 >= round(n * 0.2) GROUP BY ALL""")
def ml_cv_facts(spark, sf):
    """The folds are disjoint and cover the training rows; a fold's
    accuracy is a whole number of hits among exactly its rows; the mean over
    the folds beats the larger class's share."""
    train, _ = _split_folds(spark, sf)
    share = train.agg(F.avg("label")).first()[0]
    sizes = train.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("id_sum"),
                                      F.sum("label").cast("long").alias("positives"))
    out = None
    for kind, scores in M.cv_scores_by(spark, _stages(), {kind: M.classifier(kind) for kind in ("logreg", "rf", "svc")}, train).items():
        mean = M.cv_summary(scores).first()["cv_mean"]
        hits = F.col("score") * F.col("n")
        rows = scores.join(sizes, "fold").select(
            F.lit(kind).alias("model"), "fold", "n", "id_sum", "positives",
            (F.col("score").between(0, 1) & (F.abs(hits - F.round(hits)) < 1e-6)).alias("whole_hits"),
            F.lit(mean > max(share, 1 - share)).alias("beats_the_majority"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("ml_importance_facts", """
SELECT unnest(['avg_word_len', 'digit_ratio', 'lang', 'log_chars', 'n_lines', 'n_words', 'noise', 'punct_ratio', 'source', 'upper_ratio']) AS feature,
       TRUE AS in_range, TRUE AS sums_to_one, TRUE AS noise_is_not_first""")
def ml_importance_facts(spark, sf):
    """Every feature has an importance, they add up to one, and a
    feature that is a hash of the id is not the most important one."""
    train, _ = _split_folds(spark, sf)
    train = train.withColumn("noise", F.pmod(F.xxhash64("doc_id"), F.lit(1000)).cast("double"))
    numeric = _DOC_NUM + ["noise"]
    m = M.fit_pipeline(M.feature_stages(_DOC_CAT, numeric), M.classifier("rf"), train)
    rows = M.feature_importances(m, _DOC_CAT + numeric, spark)  # a row a feature
    total, first = rows.agg(F.sum("importance"), F.max_by("feature", "importance")).first()
    return rows.select("feature", F.col("importance").between(0, 1).alias("in_range"),
                       F.lit(abs(total - 1) < 1e-9).alias("sums_to_one"), F.lit(first != "noise").alias("noise_is_not_first"))


@register("ml_vote_facts", f"""
WITH {_FOLDS_SQL}
SELECT count(*) AS n, sum(doc_id)::BIGINT AS id_sum, sum(quality)::BIGINT AS positives, TRUE AS in_range, TRUE AS agrees,
       count(*) AS predicted, TRUE AS beats_the_majority FROM t WHERE r - 1 < round(n * 0.2)""")
def ml_vote_facts(spark, sf):
    """The fitted members' soft vote covers exactly the hold-out,
    its label follows the probability, and the prediction counts add up."""
    from ..operators.aggregates import value_counts
    from ..session import reliable_checkpoint
    votes = reliable_checkpoint(ml_soft_ensemble(spark, sf))
    truth = table(spark, sf, "labels").select("doc_id", "quality")
    predicted = value_counts(votes, "prediction").agg(F.sum("count")).first()[0]
    share, hit = F.avg("quality"), F.avg((F.col("prediction") == F.col("quality")).cast("int"))
    return votes.join(truth, "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("id_sum"), F.sum("quality").cast("long").alias("positives"),
        F.min(F.col("prob").between(0, 1)).alias("in_range"), F.min((F.col("prob") > 0.5).cast("int") == F.col("prediction")).alias("agrees"),
        F.lit(predicted).cast("long").alias("predicted"), (hit > F.greatest(share, 1 - share)).alias("beats_the_majority"))


@register("ml_tabular_facts", """
SELECT count(*) AS n, count(DISTINCT o_orderkey) AS ids, sum(o_orderkey)::BIGINT AS id_sum, TRUE AS zero_or_one
FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")
def ml_tabular_facts(spark, sf):
    """The end-to-end job predicts every order from the cutoff on, once."""
    return ml_tabular_job(spark, sf).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("ids"), F.sum("o_orderkey").alias("id_sum"),
        F.min(F.col("prediction").isin(0, 1)).alias("zero_or_one"))


@register("knn_impute_multi", """
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 37 <> 0 THEN p_size::DOUBLE END AS a,
                  CASE WHEN p_partkey % 41 <> 0 THEN p_retailprice END AS b,
                  CASE WHEN p_partkey % 43 <> 0 THEN regexp_extract(p_brand, '([0-9]+)', 1)::DOUBLE END AS c FROM part),
g AS (SELECT r.p_partkey AS id, d.p_partkey AS did, d.a, d.b, d.c, r.a IS NULL AS fa, r.b IS NULL AS fb, r.c IS NULL AS fc,
             sqrt(3 / nullif((r.a IS NOT NULL AND d.a IS NOT NULL)::INT + (r.b IS NOT NULL AND d.b IS NOT NULL)::INT
                             + (r.c IS NOT NULL AND d.c IS NOT NULL)::INT, 0)
                  * (coalesce((r.a - d.a) * (r.a - d.a), 0) + coalesce((r.b - d.b) * (r.b - d.b), 0)
                     + coalesce((r.c - d.c) * (r.c - d.c), 0))) AS far
      FROM t r, t d WHERE r.a IS NULL OR r.b IS NULL OR r.c IS NULL),
n AS (SELECT id, 'a' AS f, a AS y, far, did FROM g WHERE fa AND a IS NOT NULL AND far IS NOT NULL
      UNION ALL SELECT id, 'b', b, far, did FROM g WHERE fb AND b IS NOT NULL AND far IS NOT NULL
      UNION ALL SELECT id, 'c', c, far, did FROM g WHERE fc AND c IS NOT NULL AND far IS NOT NULL),
m AS (SELECT id, f, avg(y) AS y FROM (SELECT *, row_number() OVER (PARTITION BY id, f ORDER BY far, did) AS r FROM n) WHERE r <= 5 GROUP BY id, f)
SELECT p_partkey, round(coalesce(a, (SELECT y FROM m WHERE id = p_partkey AND f = 'a'), (SELECT avg(a) FROM t)), 6) AS p_size,
       round(coalesce(b, (SELECT y FROM m WHERE id = p_partkey AND f = 'b'), (SELECT avg(b) FROM t)), 6) AS p_retailprice,
       round(coalesce(c, (SELECT y FROM m WHERE id = p_partkey AND f = 'c'), (SELECT avg(c) FROM t)), 6) AS brand_no
FROM t""")
def knn_impute_multi(spark, sf):
    """Three features, each missing in some rows, filled at once."""
    from ..operators.knn import knn_impute
    p = table(spark, sf, "part")
    gap = lambda c, m: F.when(F.col("p_partkey") % m != 0, c.cast("double"))
    t = p.select("p_partkey", gap(F.col("p_size"), 37).alias("p_size"), gap(F.col("p_retailprice"), 41).alias("p_retailprice"),
                 gap(F.regexp_extract("p_brand", "([0-9]+)", 1), 43).alias("brand_no"))
    out = knn_impute(t, ["p_size", "p_retailprice", "brand_no"], "p_partkey", k=5, block_rows=500)
    return out.select("p_partkey", *[F.round(c, R).alias(c) for c in ("p_size", "p_retailprice", "brand_no")])
