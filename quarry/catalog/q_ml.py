"""k-NN, evaluation metrics, UDF surface and models."""

from pyspark.sql import functions as F

from quarry.catalog.present import stable_round
from quarry.catalog.registry import query, t
from quarry.catalog.sqlfrag import stable_round as sr
from quarry.operators import neighbors
from quarry.operators.ranking import split_flag

SPLIT = "substr(md5('9' || CAST(vec_id AS VARCHAR)), 1, 8) < '33333333'"
KNN_SQL = f"""WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE {SPLIT}),
p AS (SELECT vec_id, embedding, label FROM embeddings WHERE NOT ({SPLIT})),
d AS (SELECT q.vec_id AS qid, p.vec_id AS pid, p.label, sqrt(list_reduce(list_transform(list_zip(q.embedding, p.embedding),
  lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) * (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE))), lambda a, b: a + b)) AS dist FROM q, p),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, pid) AS rn FROM d)"""


def _split(spark, d):
    e = t(spark, d, "embeddings")
    f = split_flag("vec_id", 0.2, seed="9")
    return e.filter(f), e.filter(~f)


@query("join_knn", KNN_SQL + f"\nSELECT qid, CAST(rn AS INTEGER) AS rank, pid, {sr('dist', 6)} AS dist FROM r WHERE rn <= 5")
def join_knn(spark, d):
    q, p = _split(spark, d)
    nn = neighbors.knn(q.withColumnRenamed("vec_id", "qid"), p.withColumnRenamed("vec_id", "pid"), 5, "qid", "pid", "embedding")
    return nn.select("qid", "rank", "pid", stable_round("dist", 6).alias("dist"))


@query("ml_knn", KNN_SQL + """,
top AS (SELECT qid, label, dist FROM r WHERE rn <= 10),
z AS (SELECT qid, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) AS hz FROM top GROUP BY qid),
s AS (SELECT top.qid, label, sum(CASE WHEN hz = 1 THEN CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / dist END) AS score
      FROM top JOIN z ON top.qid = z.qid GROUP BY top.qid, label)
SELECT qid, arg_max(label, (score, -label)) AS pred FROM s GROUP BY qid""")
def ml_knn(spark, d):
    q, p = _split(spark, d)
    nn = neighbors.knn(q.withColumnRenamed("vec_id", "qid"), p.withColumnRenamed("vec_id", "pid"), 10, "qid", "pid", "embedding")
    v = neighbors.knn_vote(nn, p.withColumnRenamed("vec_id", "pid"), "qid", "pid", "label")
    return v.select("qid", "pred")


# ------------------------------------------------------------------ models and evaluation

import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier  # noqa: E402
from pyspark.ml.evaluation import BinaryClassificationEvaluator  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.ml.tuning import ParamGridBuilder  # noqa: E402
from pyspark.sql import types as T  # noqa: E402
from pyspark import StorageLevel  # noqa: E402

from quarry.functions.text import count_word  # noqa: E402
from quarry.operators import aggs, evaluate, logistic, ml, staged_trees  # noqa: E402
from quarry.operators.windows import fold_contiguous, fold_stratified  # noqa: E402

DOC_FEATS = ["n_chars", "n_the", "is_en"]


def _docs(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "n_chars", "lang", count_word("text", "the").alias("n_the"),
                                           (F.col("lang") == "en").cast("int").alias("is_en"))
    j = docs.join(t(spark, d, "labels"), "doc_id")
    # reused by every fit of a model search: kept in executor memory (spilling to disk)
    return ml.assemble(j, DOC_FEATS).withColumn("quality", F.col("quality").cast("double")).persist(StorageLevel.MEMORY_AND_DISK)


def _claims(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                                        F.ln(F.col("l_extendedprice") + 200).alias("y"))
    li = li.withColumn("is_valid", split_flag("l_orderkey", 0.2, seed="4"))
    return ml.assemble(li, ["l_quantity", "l_discount", "l_tax", "l_linenumber"])


def _emb(spark, d):
    e = t(spark, d, "embeddings").withColumn("label", F.col("label").cast("double"))
    return ml.assemble(e, ["embedding"])


@query("ml_boost_reg")
def ml_boost_reg(spark, d):
    """Rows-only: boosted regression trees with early stopping on a validation flag."""
    c = _claims(spark, d)
    m = ml.boost_regressor(c, "y", rounds=10, depth=3, rate=0.3, validation="is_valid")
    return m.transform(c).select("l_orderkey", "l_linenumber", "prediction")


@query("ml_boost_custom")
def ml_boost_custom(spark, d):
    """Rows-only: Newton boosting on the fair loss (user gradient and hessian), 5 rounds."""
    c = _claims(spark, d)
    trees, base, _ = ml.boost_custom(c, "y", rounds=5, depth=3, rate=0.3, checkpoint_every=5)
    return ml.predict_custom(trees, base, c, rate=0.3).select("l_orderkey", "l_linenumber", "prediction")


@query("ml_boost_clf")
def ml_boost_clf(spark, d):
    """Rows-only: boosted binary classifier of document quality."""
    docs = _docs(spark, d)
    m = ml.boost_classifier(docs, "quality", rounds=10, depth=3)
    return m.transform(docs).select("doc_id", "prediction", vector_to_array("probability")[1].alias("p1"))


@query("ml_boost_multi")
def ml_boost_multi(spark, d):
    """Rows-only: one-vs-rest boosted trees over 10 classes, then the 3 best class names per row."""
    from quarry.operators.ranking import top_k_names
    e = _emb(spark, d)
    m = ml.multiclass_boost(e, "label", rounds=5, depth=3)
    s = m.transform(e).select("vec_id", vector_to_array("rawPrediction").alias("scores"))
    return s.select("vec_id", top_k_names("scores", [f"class_{i}" for i in range(10)], 3).alias("top3"))


@query("ml_logreg")
def ml_logreg(spark, d):
    """Rows-only: logistic regression coefficients."""
    m = ml.logistic(_docs(spark, d), "quality", reg=0.01)
    return ml.coefficient_table(m, DOC_FEATS, spark)


@query("ml_coef_rank")
def ml_coef_rank(spark, d):
    """Rows-only: L1 logistic coefficients ranked by magnitude."""
    m = ml.logistic(_docs(spark, d), "quality", reg=0.01, l1=1.0)
    return ml.coefficient_table(m, DOC_FEATS, spark).select("feature", "coef")


@query("ml_logreg_cv")
def ml_logreg_cv(spark, d):
    """Rows-only: 100 penalties, L2 and L1, over 10 stratified folds: 2,200 models in some 20 scans. The
    penalties are 1 / (c n) for c from 10^-4 to 10^4."""
    docs = fold_stratified(_docs(spark, d), "quality", "doc_id", 10, seed="3", out="fold").withColumn("x", vector_to_array("features"))
    n = docs.count()
    penalties = [(1.0 / (max(n, 1) * 10 ** (-4 + 8 * i / 99)), l1) for l1 in (0.0, 1.0) for i in range(100)]
    return logistic.grid_table(docs, "fold", "quality", "x", penalties)


@query("ml_grid_cv")
def ml_grid_cv(spark, d):
    """Rows-only: forest grid over features-per-split with a fold column (stratified folds)."""
    docs = fold_stratified(_docs(spark, d), "quality", "doc_id", 3, seed="2", out="fold")
    rf = RandomForestClassifier(labelCol="quality", featuresCol="features", numTrees=10, seed=0)
    grid = ParamGridBuilder().addGrid(rf.featureSubsetStrategy, ["sqrt", "all"]).build()
    table, _ = ml.grid_cv(rf, grid, BinaryClassificationEvaluator(labelCol="quality"), docs, fold_col="fold")
    return table


@query("ml_linear_svc")
def ml_linear_svc(spark, d):
    """Rows-only: linear SVC predictions."""
    docs = _docs(spark, d)
    return ml.linear_svc(docs, "quality", reg=0.01).transform(docs).select("doc_id", "prediction")


@query("ml_rbf_svc")
def ml_rbf_svc(spark, d):
    """Rows-only: RBF-kernel SVC by random Fourier features, balanced weights, Platt probabilities."""
    e = _emb(spark, d).withColumn("label", (F.col("label") < 5).cast("double"))
    apply = ml.rbf_svc(e, "label", dims=64, gamma=0.5)
    return apply(e).select("vec_id", "p1")


@query("ml_forest")
def ml_forest(spark, d):
    """Rows-only: random forest with balanced class weights."""
    docs = ml.class_weights(_docs(spark, d), "quality", "w")
    m = ml.forest(docs, "quality", trees=20, depth=5, weight="w")
    return m.transform(docs).select("doc_id", "prediction")


@query("ml_naive_bayes")
def ml_naive_bayes(spark, d):
    """Rows-only: Gaussian naive Bayes over 10 classes."""
    e = _emb(spark, d)
    return ml.naive_bayes(e, "label").transform(e).select("vec_id", "prediction")


@query("ml_mlp_top")
def ml_mlp_top(spark, d):
    """Rows-only: dense softmax layers on feature vectors."""
    e = _emb(spark, d)
    return ml.mlp(e, "label", 64, 10, hidden=(32,), iters=30).transform(e).select("vec_id", "prediction")


@query("ml_class_weight", """WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
SELECT l.doc_id, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * c.n), 6) AS w FROM labels l JOIN c ON l.quality = c.quality""")
def ml_class_weight(spark, d):
    w = ml.class_weights(t(spark, d, "labels").select("doc_id", "quality"), "quality", "w")
    return w.select("doc_id", F.round("w", 6).alias("w"))


@query("ml_compare")
def ml_compare(spark, d):
    """Rows-only: several classifiers (including the extra candidates) with train and
    hold-out accuracy."""
    docs = _docs(spark, d)
    f = split_flag("doc_id", 0.25, seed="1")
    models = {"logistic": LogisticRegression(), "forest": RandomForestClassifier(numTrees=10, seed=0),
              "boosted": GBTClassifier(maxIter=5, seed=0)}
    return ml.compare(models, docs.filter(~f), docs.filter(f), "quality")


@query("ml_base_unused")
def ml_base_unused(spark, d):
    """Rows-only: the candidate learners kept outside the ensemble -- AdaBoost (weighted-tree
    loop), a forest with all features per split, boosted trees -- fitted and scored on a hold-out."""
    docs = _docs(spark, d)
    f = split_flag("doc_id", 0.25, seed="1")
    train, valid = docs.filter(~f), docs.filter(f)
    ada = ml.adaboost(train, "quality", rounds=3, depth=2, checkpoint_every=0)
    rows = []
    for name, scored in [("adaboost_train", ml.adaboost_predict(ada, train)), ("adaboost_valid", ml.adaboost_predict(ada, valid))]:
        rows.append(scored.agg(F.lit(name).alias("model"), F.avg((F.col("prediction") == F.col("quality")).cast("double")).alias("accuracy")))
    others = ml.compare({"forest_all": RandomForestClassifier(numTrees=10, featureSubsetStrategy="all", seed=0),
                         "boosted": GBTClassifier(maxIter=5, seed=0)}, train, valid, "quality")
    out = rows[0].unionByName(rows[1])
    return out.unionByName(others.select(F.concat("model", F.lit("_valid")).alias("model"), F.col("valid_accuracy").alias("accuracy")))


def _fold_average(spark, d):
    """3 contiguous folds; the defaults of the operators, as in the reference: up to 2,000 rounds of depth 8 at a
    rate of 0.03, stopped by a patience of 50. Errors are of the values, not of their logarithms."""
    c = _claims(spark, d)
    train = fold_contiguous(c.filter(~F.col("is_valid")).select("l_orderkey", "l_linenumber", "y", "features"), ["l_orderkey", "l_linenumber"], 3)
    test = c.filter("is_valid")
    return staged_trees.fold_average(train, test, "fold", "y", lambda tr, rounds: ml.boost_regressor(tr, "y", rounds=rounds), unscale=np.exp, ceiling=2000)


@query("ml_fold_average")
def ml_fold_average(spark, d):
    """Rows-only: a boosted model per fold, cut at its best round; test predictions averaged."""
    rows, report = _fold_average(spark, d)
    mean = report.first()
    return rows.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"), (F.col("prediction") - 200).alias("prediction"), F.size("fold_predictions").alias("folds"),
                       F.lit(mean["mean_error"]).alias("mean_error"), F.lit(mean["mean_best_round"]).alias("mean_best_round"))


@query("ml_fold_report")
def ml_fold_report(spark, d):
    """Rows-only: a row a fold with its best round, its error there and the means over the folds."""
    return _fold_average(spark, d)[1]


CURVE_SQL = """WITH e AS (SELECT CAST(user_id AS INTEGER) AS fold, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS round, value AS error FROM events),
a AS (SELECT *, min(error) OVER (PARTITION BY fold ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM e),
b AS (SELECT *, max(CASE WHEN low IS NULL OR error < low THEN round END) OVER (PARTITION BY fold ORDER BY round) AS pos FROM a),
s AS (SELECT fold, min(round) AS stop FROM b WHERE round - pos >= 5 GROUP BY fold),
r AS (SELECT b.fold, max(pos) AS best_round, min(error) AS error, max(round) AS stopped_at FROM b LEFT JOIN s ON b.fold = s.fold WHERE stop IS NULL OR round <= stop GROUP BY b.fold)"""


@query("ml_best_round", CURVE_SQL + f"""
SELECT fold, best_round, {sr('error', 6)} AS error, stopped_at, {sr('(SELECT avg(error) FROM r)', 4)} AS mean_error, CAST(floor((SELECT avg(best_round) FROM r)) AS INTEGER) AS mean_best_round FROM r""")
def ml_best_round(spark, d):
    """Best rounds by a patience of 5 on given error curves (one a user), and their report."""
    from pyspark.sql import Window
    e = t(spark, d, "events")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    curves = e.select(F.col("user_id").cast("int").alias("fold"), n.alias("round"), F.col("value").alias("error"))
    r = staged_trees.fold_report(staged_trees.best_rounds(curves, 5))
    return r.select("fold", "best_round", stable_round("error", 6).alias("error"), "stopped_at", stable_round("mean_error", 4).alias("mean_error"), "mean_best_round")


@query("ml_average_folds", f"""WITH p AS (SELECT l_orderkey, f, ln(l_extendedprice + 200 * f) + l_quantity / (f + 1.0) AS p FROM lineitem, range(0, 3) r(f))
SELECT l_orderkey AS key, {sr('avg(p)', 5)} AS prediction, count(*) AS folds FROM p GROUP BY l_orderkey""")
def ml_average_folds(spark, d):
    """Averages over the folds of given predictions."""
    f = F.explode(F.array(*[F.lit(i) for i in range(3)]))
    p = t(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity", f.alias("fold"))
    p = p.withColumn("p", F.ln(F.col("l_extendedprice") + 200 * F.col("fold")) + F.col("l_quantity") / (F.col("fold") + 1.0))
    a = staged_trees.average_folds(p.withColumnRenamed("l_orderkey", "key"), "key", "fold", "p")
    return a.select("key", stable_round("prediction", 5).alias("prediction"), "folds")


@query("ml_stack")
def ml_stack(spark, d):
    """Rows-only: two base models over 3 folds stacked by a logistic model; labelled documents are
    the training rows, a quarter of them held out as test rows; mean Gini of the stacker over 10 folds."""
    docs = _docs(spark, d)
    held = split_flag("doc_id", 0.25, seed="6")
    train = fold_stratified(docs.filter(~held), "quality", "doc_id", 3, seed="5", out="fold")
    bases = {"lr": LogisticRegression(regParam=0.01), "rf": RandomForestClassifier(numTrees=10, seed=0)}
    rows, ginis = ml.stack(train, "quality", "doc_id", "fold", bases, test=docs.filter(held))
    mean = ginis.agg(F.avg("gini")).first()[0]
    return rows.select("part", F.col("key").alias("doc_id"), "quality", "lr", "rf", "p_stack", F.lit(mean).cast("double").alias("stacker_gini"))


@query("ml_stack_assembly", f"""WITH s AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 4 = 0 THEN 'test' ELSE 'train' END AS part, f, m,
  CASE WHEN m = 'a' THEN o_totalprice / 1000000 + f * 0.01 ELSE (o_orderkey % 97) / 97.0 + f * 0.02 END AS p
  FROM orders, range(0, 3) r(f), (VALUES ('a'), ('b')) v(m) WHERE o_orderkey % 4 = 0 OR o_orderkey % 3 = f)
SELECT part, key, {sr("avg(CASE WHEN m = 'a' THEN p END)", 6)} AS a, {sr("avg(CASE WHEN m = 'b' THEN p END)", 6)} AS b FROM s GROUP BY part, key""")
def ml_stack_assembly(spark, d):
    """The level-two table of given scores: out-of-fold for training rows, fold means for test rows."""
    o = t(spark, d, "orders").select("o_orderkey", "o_totalprice", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("fold"))
    o = o.select("*", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("model")).where("o_orderkey % 4 = 0 OR o_orderkey % 3 = fold")
    p = F.when(F.col("model") == "a", F.col("o_totalprice") / 1000000 + F.col("fold") * 0.01).otherwise((F.col("o_orderkey") % 97) / 97.0 + F.col("fold") * 0.02)
    s = o.select(F.when(F.col("o_orderkey") % 4 == 0, "test").otherwise("train").alias("part"), F.col("o_orderkey").alias("key"), "model", "fold", p.alias("p"))
    return ml.assemble_scores(s, ["a", "b"]).select("part", "key", stable_round("a", 6).alias("a"), stable_round("b", 6).alias("b"))


@query("ml_segmented")
def ml_segmented(spark, d):
    """Rows-only: a logistic model per language, all fitted together, predictions recombined."""
    docs = _docs(spark, d).withColumn("x", vector_to_array("features"))
    models = logistic.segmented(docs, "lang", "quality", "x", reg=0.1)
    return logistic.predict(docs, models, "lang", "x").select("doc_id", "lang", (F.col("p1") > 0.5).cast("double").alias("prediction"))


@query("ml_segmented_many")
def ml_segmented_many(spark, d):
    """Rows-only: a model per part (2,000 at sf0.01) of whether its line was returned; no loop over the parts."""
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.array("l_quantity", "l_discount", "l_tax").alias("x"),
                                        (F.col("l_returnflag") == "R").cast("double").alias("y"))
    models = logistic.segmented(li, "l_partkey", "y", "x", reg=0.1)
    return logistic.predict(li, models, "l_partkey", "x").select("l_orderkey", "l_linenumber", "l_partkey", F.round("p1", 6).alias("p1"))


@query("ml_features_vote", """WITH m AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS v FROM embeddings, range(1, 65) r(i) GROUP BY label, i),
a AS (SELECT label, arg_max(i, (v, -i)) - 1 AS idx FROM m GROUP BY label)
SELECT a.label, CAST(a.idx AS INTEGER) AS idx, n.n_name FROM a LEFT JOIN nation n ON n.n_nationkey = a.idx""")
def ml_features_vote(spark, d):
    from quarry.functions.numeric import argmax
    e = t(spark, d, "embeddings")
    mv = aggs.vector_mean(e, ["label"], "embedding", "mv").select("label", argmax("mv").cast("int").alias("idx"))
    return mv.join(t(spark, d, "nation").select(F.col("n_nationkey").alias("idx"), "n_name"), "idx", "left")


@query("ev_mae", f"""SELECT {sr('avg(abs((exp(ln(l_extendedprice + 200)) - 200) - (exp(ln(l_quantity * 1000 + 200)) - 200)))', 4)} AS mae FROM lineitem""")
def ev_mae(spark, d):
    li = t(spark, d, "lineitem").select(F.ln(F.col("l_extendedprice") + 200).alias("y"), F.ln(F.col("l_quantity") * 1000 + 200).alias("p"))
    return evaluate.mae(li, "y", "p", inverse=lambda c: F.exp(c) - 200).select(stable_round("mae", 4).alias("mae"))


@query("ev_report", """WITH pr AS (SELECT quality AS y, toxic AS p FROM labels),
c AS (SELECT DISTINCT y AS cls FROM pr UNION SELECT DISTINCT p FROM pr),
s AS (SELECT c.cls, (SELECT count(*) FROM pr WHERE y = c.cls AND p = c.cls) AS tp, (SELECT count(*) FROM pr WHERE y = c.cls) AS support,
  (SELECT count(*) FROM pr WHERE p = c.cls) AS predicted FROM c)
SELECT cls, round(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END, 6) AS precision, round(CASE WHEN support > 0 THEN tp / support ELSE 0 END, 6) AS recall,
  round(CASE WHEN tp > 0 THEN 2.0 * tp / (predicted + support) ELSE 0 END, 6) AS f1, support FROM s""")
def ev_report(spark, d):
    r = evaluate.class_report(t(spark, d, "labels"), "quality", "toxic")
    return r.select("cls", *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1"]], "support")


@query("ev_accuracy_loss", f"""WITH j AS (SELECT l.quality AS y, CASE WHEN d.n_chars > 2000 THEN 1 ELSE 0 END AS p,
  1.0 / (1.0 + exp(-(d.n_chars - 2000) / 1000.0)) AS q FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT {sr('avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END)', 6)} AS accuracy,
  {sr('avg(-(y * ln(least(greatest(q, 1e-15), 1 - 1e-15)) + (1 - y) * ln(1 - least(greatest(q, 1e-15), 1 - 1e-15))))', 6)} AS logloss FROM j""")
def ev_accuracy_loss(spark, d):
    j = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id").select(
        F.col("quality").alias("y"), (F.col("n_chars") > 2000).cast("int").alias("p"),
        (1.0 / (1.0 + F.exp(-(F.col("n_chars") - 2000) / 1000.0))).alias("q"))
    r = evaluate.accuracy_logloss(j, "y", "p", "q")
    return r.select(stable_round("accuracy", 6).alias("accuracy"), stable_round("logloss", 6).alias("logloss"))


@query("ev_recall", "SELECT round(sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) / sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END), 6) AS recall FROM labels")
def ev_recall(spark, d):
    return evaluate.recall(t(spark, d, "labels"), "quality", "toxic").select(F.round("recall", 6).alias("recall"))


@query("ev_map_k", f"""WITH r AS (SELECT vec_id, label, list_transform(list_slice(list_reverse_sort(list_transform(embedding, lambda x, i: {{'v': x, 'ni': -i}})), 1, 7),
  lambda s: -s.ni - 1) AS top FROM embeddings),
a AS (SELECT vec_id, coalesce(1.0 / list_position(top, label), 0.0) AS ap FROM r)
SELECT {sr('avg(ap)', 6)} AS map_at_7 FROM a""")
def ev_map_k(spark, d):
    from quarry.functions.numeric import top_k_indices
    e = t(spark, d, "embeddings").select(F.array("label").alias("actual"), top_k_indices("embedding", 7).alias("pred"))
    return evaluate.map_at_k(e, "actual", "pred", 7).select(stable_round("map_at_7", 6).alias("map_at_7"))


@query("ev_gini", """WITH j AS (SELECT doc_id, CAST(quality AS BIGINT) AS y, CAST(toxic AS DOUBLE) AS p FROM labels),
w AS (SELECT y, coalesce(sum(1 - y) OVER (ORDER BY p DESC, doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS na FROM j),
g AS (SELECT 1 - 2.0 * sum(y * na) / (sum(y) * (count(*) - sum(y))) AS gini FROM w),
wy AS (SELECT y, coalesce(sum(1 - y) OVER (ORDER BY y DESC, doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS na FROM j),
gy AS (SELECT 1 - 2.0 * sum(y * na) / (sum(y) * (count(*) - sum(y))) AS gini FROM wy)
SELECT round(g.gini / gy.gini, 6) AS gini_norm, round(g.gini, 6) AS gini FROM g, gy""")
def ev_gini(spark, d):
    lab = t(spark, d, "labels").select("doc_id", F.col("quality").cast("long").alias("y"), F.col("toxic").cast("double").alias("p"))
    r = evaluate.gini_score(lab, "y", "p", "doc_id")
    return r.select(F.round("gini_norm", 6).alias("gini_norm"), F.round("gini", 6).alias("gini"))


@F.pandas_udf(T.DecimalType(38, 0))
def _encode_letters(s: pd.Series) -> pd.Series:
    """Per-value Python helper (Arrow batches): letters -> base-26 number."""
    from decimal import Decimal

    def enc(v):
        if v is None:
            return None
        r = 0
        for ch in v:
            r = r * 26 + (ord(ch) - 64)
        return Decimal(r)
    return s.map(enc)


@query("udf_scalar", "SELECT p_partkey, CAST(list_reduce(list_transform(string_split(p_brand, ''), lambda x: CAST(ascii(x) - 64 AS HUGEINT)), lambda a, x: a * 26 + x) AS DECIMAL(38,0)) AS code FROM part")
def udf_scalar(spark, d):
    return t(spark, d, "part").select("p_partkey", _encode_letters("p_brand").alias("code"))


@F.pandas_udf(T.DoubleType())
def _pop_skew(v: pd.Series) -> float:
    x = v.dropna().to_numpy(dtype=float)
    if len(x) == 0:
        return float("nan")
    m2 = ((x - x.mean()) ** 2).mean()
    return float(((x - x.mean()) ** 3).mean() / m2 ** 1.5) if m2 > 0 else float("nan")


@query("udf_agg", f"""WITH m AS (SELECT c_mktsegment, avg(c_acctbal) AS mu FROM customer GROUP BY 1)
SELECT c.c_mktsegment, {sr('avg(power(c_acctbal - mu, 3)) / power(avg(power(c_acctbal - mu, 2)), 1.5)', 6)} AS skew
FROM customer c JOIN m ON c.c_mktsegment = m.c_mktsegment GROUP BY 1""")
def udf_agg(spark, d):
    r = t(spark, d, "customer").groupBy("c_mktsegment").agg(_pop_skew("c_acctbal").alias("skew"))
    return r.select("c_mktsegment", stable_round("skew", 6).alias("skew"))


@query("udf_table", """SELECT item_id, CAST(pos - 1 AS INTEGER) AS pos, word FROM (
  SELECT item_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS pos FROM (SELECT item_id, string_split(text, ' ') AS w FROM benchmark))""")
def udf_table(spark, d):
    b = t(spark, d, "benchmark").select("item_id", F.split("text", " ").alias("w"))
    return b.select("item_id", F.posexplode("w").alias("pos", "word")).withColumn("pos", F.col("pos").cast("int"))


@query("udf_callbacks")
def udf_callbacks(spark, d):
    """Rows-only: a user metric (normalised Gini evaluator) scoring a fitted model."""
    docs = _docs(spark, d)
    m = ml.logistic(docs, "quality", reg=0.01)
    g = ml.GiniEvaluator(labelCol="quality", rawPredictionCol="probability").evaluate(m.transform(docs))
    return spark.createDataFrame([(float(g),)], "gini_norm double")


