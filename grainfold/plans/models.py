"""Model queries: training, tuning, prediction, clusters, topics."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from grainfold.functions import arrays, text as t
from grainfold.operators import cluster, encode, evaluate, learn, split, terms, textmodel
from grainfold.plans.registry import query, r
from grainfold.session import settle
from grainfold.sources.readers import read_table

SPLIT = {"train": 70, "valid": 15, "test": 15}


def _vectors(spark, sf):
    """Embeddings as unit vectors with their label and part."""
    rows = read_table(spark, sf, "embeddings")
    unit = array_to_vector(arrays.l2_normalize(F.col("embedding")))
    rows = rows.select("vec_id", F.col("label").cast("double").alias("label"), unit.alias("features"))
    return split.hash_split(rows, "vec_id", SPLIT)


LANG_WEIGHTS = {"en": 1, "fr": 10, "de": 10, "es": 1}


def _texts(spark, sf):
    """Documents with a language label and the part."""
    return split.hash_split(read_table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id", SPLIT)


def _prices(spark, sf):
    """Order price with calendar and category features, and the part."""
    orders = read_table(spark, sf, "orders")
    day = F.col("o_orderdate")
    rows = orders.select(
        "o_orderkey", F.col("o_totalprice").alias("label"), F.year(day).alias("year"), F.month(day).alias("month"),
        F.weekday(day).alias("weekday"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
    )
    rows = encode.category_codes(rows, ["priority", "status"]).drop("priority", "status")
    rows = encode.assemble(rows, ["o_orderkey", "label"])
    return split.hash_split(rows.select("o_orderkey", "label", "features"), "o_orderkey", SPLIT)


PRICE_FEATURES = ["year", "month", "weekday", "priority_code", "status_code"]


def _buyers(spark, sf):
    """Events with a 0/1 label (value above 50) and numeric features, one per event."""
    rows = read_table(spark, sf, "events").select(
        "event_id", (F.col("value") > 50).cast("double").alias("label"),
        F.hour("ts").alias("hour"), F.weekday("ts").alias("weekday"), F.from_json("props", "k int")["k"].alias("k"),
        (F.col("value") % 10).alias("tail"), (F.col("event_type") == "purchase").cast("int").alias("bought"),
    )
    rows = encode.assemble(rows, ["event_id", "label"])
    return split.hash_split(rows.select("event_id", "label", "features"), "event_id", SPLIT)


def _parts(rows):
    return tuple(rows.where(F.col("part") == p).drop("part") for p in ("train", "valid", "test"))


@query()
def svm_binary(spark, sf):
    train, valid, _ = _parts(encode.class_weight(_buyers(spark, sf), "label", {1.0: 30, 0.0: 1}))
    model = learn.linear_svm("weight").fit(train)
    return evaluate.classification_report(model.transform(valid), "label", "prediction")


@query()
def text_svm(spark, sf):
    train, _, test = _parts(_texts(spark, sf))
    model = textmodel.fit_text_svm(train, "doc_id", "text", "lang", LANG_WEIGHTS, min_df=5)
    scored = test.join(textmodel.predict_text(model, test, "doc_id", "text"), "doc_id")
    return evaluate.classification_report(scored, "lang", "prediction")


_TRAIN = "CAST('0x' || substr(md5(doc_id::VARCHAR), 1, 8) AS BIGINT) % 100 < 70"


@query(f"""SELECT 'alpha=' || a || ', epochs=' || e || ', ngrams=' || g || ', use_idf=' || i AS params, n AS rows, round(top / n, 6) AS majority, TRUE AS better
FROM (SELECT unnest(['0.01', '0.001']) AS a), (SELECT unnest(['5', '10', '15']) AS e), (SELECT unnest(['1', '2']) AS g), (SELECT unnest(['True', 'False']) AS i),
  (SELECT sum(c)::BIGINT AS n, max(c) AS top FROM (SELECT lang, count(*) AS c FROM documents WHERE lang IS NOT NULL AND {_TRAIN} GROUP BY lang))""")
def text_grid_search(spark, sf):
    """All combinations, and whether each is right more often than the most frequent class would be."""
    train = _parts(_texts(spark, sf))[0].where("lang IS NOT NULL")
    found = textmodel.text_grid_search(train, "doc_id", "text", "lang", LANG_WEIGHTS, min_df=5)
    share = train.groupBy("lang").count().agg(F.max("count")).first()[0] / F.col("rows")
    return found.select("params", "rows", r(share, 6).alias("majority"), (F.col("metric") > share).alias("better"))


@query()
def rf_regress(spark, sf):
    train, valid, _ = _parts(_prices(spark, sf))
    model = learn.forest_regressor(trees=50).fit(train)
    return evaluate.regression_report(model.transform(valid), "label", "prediction")


@query()
def rf_classify(spark, sf):
    train, valid, _ = _parts(_vectors(spark, sf))
    model = learn.forest_classifier(trees=50).fit(train)
    return evaluate.classification_report(model.transform(valid), "label", "prediction")


@query()
def gbt_classify(spark, sf):
    train, valid, _ = _parts(_buyers(spark, sf))
    model = learn.boosted_classifier(trees=10, depth=4).fit(train)
    scored = model.transform(valid).withColumn("p", vector_to_array("probability")[1])
    loss, auc = evaluate.log_loss(scored, "label", "p"), evaluate.roc_auc(scored, "label", "p")
    return loss.withColumn("auc", auc.select("auc").scalar())


@query()
def gbt_regress(spark, sf):
    train, valid, _ = _parts(_prices(spark, sf))
    model = learn.boosted_regressor(trees=10, depth=4).fit(train)
    return evaluate.regression_report(model.transform(valid), "label", "prediction")


@query()
def mlp_classify(spark, sf):
    train, valid, _ = _parts(_vectors(spark, sf))
    size = train.select("features").first()[0].size
    classes = int(train.agg(F.max("label")).first()[0]) + 1
    model = learn.dense_classifier(size, classes, max_iter=30).fit(train)
    return evaluate.classification_report(model.transform(valid), "label", "prediction")


@query()
def grid_search(spark, sf):
    rows = split.hash_fold(_vectors(spark, sf), "vec_id", 3)
    train = rows.where("part = 'train'").select("label", "features", "fold")
    forest = learn.forest_classifier(trees=10)
    grid = learn.random_grid(learn.full_grid(forest, {"numTrees": [5, 10], "maxDepth": [2, 4], "featureSubsetStrategy": ["sqrt", "all"]}), 3, seed=1)
    judge = MulticlassClassificationEvaluator(metricName="logLoss")
    return learn.tuning_table(learn.tune(forest, grid, judge, 3, "fold").fit(train), spark)


@query()
def tree_sweep(spark, sf):
    train, _, test = _parts(_prices(spark, sf))
    score = lambda scored: evaluate.regression_report(scored, "label", "prediction").select("mse", "rmse")
    return learn.tree_count_sweep(lambda n: learn.forest_regressor(trees=n), [10, 20, 50, 100, 150], train, test, score)


@query()
def cross_predict(spark, sf):
    rows = split.modulo_fold(_buyers(spark, sf), "event_id", 3).select("event_id", "label", "features", "fold")
    out = learn.out_of_fold(learn.forest_classifier(trees=10, max_depth=4), rows, "fold", 3)
    return out.select("event_id", "fold", "label", "prediction")


@query()
def feature_importance(spark, sf):
    train, _, _ = _parts(_prices(spark, sf))
    model = learn.forest_regressor(trees=30).fit(train)
    return evaluate.importance_table(model, PRICE_FEATURES, spark)


@query()
def predict_output(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    labels = read_table(spark, sf, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    known = docs.join(labels, "doc_id")
    counts, n_docs = terms.term_counts(docs, "doc_id", "text"), known.count()
    seen = terms.term_counts(known, "doc_id", "text")
    index = terms.term_index(terms.vocabulary(seen, F.lit(n_docs), min_df=5))
    rows = docs.join(terms.sparse_rows(counts, index, "doc_id", n_docs), "doc_id", "left")
    rows = settle(terms.sparse_vectors(rows.select("doc_id", "idx", "val"), index.count()).join(labels, "doc_id", "left"))
    model = learn.forest_classifier(trees=20).fit(rows.where("label IS NOT NULL"))
    return learn.predict_output(model, rows.where("label IS NULL").drop("label"), "doc_id", probability=True)


# ---- clusters and topics

@query()
def pca_k(spark, sf):
    reduced, k = cluster.pca_reduce(_vectors(spark, sf).drop("part"), share=0.9)
    return reduced.select("vec_id", F.lit(k).alias("k"), "reduced")


@query()
def kmeans_sweep(spark, sf):
    return cluster.kmeans_sweep(_vectors(spark, sf).select("features"))


@query()
def spectral_cluster(spark, sf):
    rows = read_table(spark, sf, "embeddings").select("vec_id", arrays.l2_normalize(F.col("embedding")).alias("x"))
    return cluster.spectral_sweep(rows, "vec_id", "x")


@query()
def pic_cluster(spark, sf):
    rows = read_table(spark, sf, "embeddings").select("vec_id", arrays.l2_normalize(F.col("embedding")).alias("x"))
    return cluster.pic_clusters(rows, "vec_id", "x", k=5)


def _counts(spark, sf, size=1000):
    """Term-count vectors of the documents and the vocabulary behind them."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    docs = docs.withColumn("tokens", terms.token_array(F.col("text"), t.LETTERS)).drop("text")
    model = Pipeline(stages=terms.vectorizer("tokens", min_df=5, max_df=0.8, max_features=size, use_idf=False)).fit(docs)
    return settle(model.transform(docs).select("doc_id", "features")), model.stages[0].vocabulary


@query()
def topic_terms(spark, sf):
    rows, vocabulary = _counts(spark, sf)
    return cluster.topic_terms(cluster.lda_topics(rows, k=50), vocabulary, 20)


@query()
def lda_sweep(spark, sf):
    rows, _ = _counts(spark, sf)
    return cluster.lda_sweep(rows, ks=[5, 10, 20])


@query()
def nmf_topics(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    weights = terms.tfidf(docs, "doc_id", "text", t.LETTERS, min_df=5, max_df=0.8, max_features=1000)
    vocabulary = sorted(r[0] for r in weights.select("term").distinct().collect())
    rows = cluster.sparse_rows(weights, "doc_id", "term", "tfidf", vocabulary)
    factors, _ = cluster.nmf_topics(rows, len(vocabulary))
    return cluster.factor_terms(factors, vocabulary, 20, spark)
