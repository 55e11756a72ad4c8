"""Feature transformers, models, evaluation and tuning from spark.ml on the test tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, classification as C, clustering as K, evaluation as E, feature as X, fpm, recommendation, regression as R, stat, tuning
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.contract import sqltext as q
from kindred.contract.registry import query
from kindred.functions.stopwords import ENGLISH
from kindred.operators import graph, topics, vocabulary
from kindred.operators.nearest_products import recommend_for_all_users
from kindred.session import ROWS_PER_TASK, bounded, materialise
from kindred.sources.articles import table

KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
KEY_SQL = "l_orderkey, l_linenumber, l_partkey"


def lines(spark: SparkSession, sf_dir: str, kept: bool = False) -> DataFrame:
    """Lineitem with ``features`` = quantity, discount, tax. For models that keep the rows of a task in memory, a partition has a bounded number of them."""
    parts = X.VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features")
    rows = table(spark, sf_dir, "lineitem")
    return parts.transform(bounded(rows) if kept else rows)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with a two-class label."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", array_to_vector("embedding").alias("features"), (F.col("label") < 5).cast("double").alias("label"), F.col("label").cast("double").alias("digit")
    )


def tokens(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """All rows of a table; a null text is an empty one."""
    texts = table(spark, sf_dir, name).withColumn("text", F.coalesce("text", F.lit("")))
    return X.Tokenizer(inputCol="text", outputCol="tokens").transform(texts)


def cells(df: DataFrame, column: str, n: int, keys=KEYS) -> DataFrame:
    values = vector_to_array(F.col(column))
    return df.select(*keys, *[F.round(F.get(values, F.lit(i)), 6).alias(f"v{i}") for i in range(n)])


_SPARSE = "v struct<type:int,size:int,indices:array<int>,values:array<double>>"


def nonzero(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """``keep``, ``slot`` and ``value`` of every entry of a sparse vector that is stored."""
    stored = F.from_json(F.to_json(F.struct(F.col(column).alias("v"))), _SPARSE)["v"]
    pairs = F.zip_with(stored["indices"], stored["values"], lambda i, v: F.struct(i.alias("slot"), v.alias("value")))
    return df.select(*keep, F.inline(pairs))


# features with a closed form


@query(f"SELECT {KEY_SQL}, CAST(l_discount > 0.05 AS DOUBLE) AS flag FROM lineitem".replace("CAST(l_discount > 0.05 AS DOUBLE)", "CASE WHEN l_discount > 0.05 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"))
def ml_binarizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = X.Binarizer(threshold=0.05, inputCol="l_discount", outputCol="flag")
    return t.transform(table(spark, sf_dir, "lineitem")).select(*KEYS, "flag")


@query(f"SELECT {KEY_SQL}, (CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 25 THEN 1 WHEN l_quantity < 40 THEN 2 ELSE 3 END)::DOUBLE AS bucket FROM lineitem")
def ml_bucketizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = X.Bucketizer(splits=[-float("inf"), 10, 25, 40, float("inf")], inputCol="l_quantity", outputCol="bucket")
    return t.transform(table(spark, sf_dir, "lineitem")).select(*KEYS, "bucket")


@query(f"SELECT {KEY_SQL}, l_quantity AS v0, l_discount AS v1, l_tax AS v2 FROM lineitem")
def ml_vector_assembler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(lines(spark, sf_dir), "features", 3)


@query(f"SELECT {KEY_SQL}, l_tax AS v0, l_quantity AS v1 FROM lineitem")
def ml_vector_slicer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(X.VectorSlicer(inputCol="features", outputCol="out", indices=[2, 0]).transform(lines(spark, sf_dir)), "out", 2)


@query(f"SELECT {KEY_SQL}, round(l_quantity * 2, 6) AS v0, round(l_discount * 0.5, 6) AS v1, round(l_tax * 10, 6) AS v2 FROM lineitem")
def ml_elementwise_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = X.ElementwiseProduct(scalingVec=Vectors.dense(2.0, 0.5, 10.0), inputCol="features", outputCol="out")
    return cells(t.transform(lines(spark, sf_dir)), "out", 3)


def _fitted(spark: SparkSession, sf_dir: str, estimator) -> DataFrame:
    df = lines(spark, sf_dir)
    return cells(estimator.fit(df).transform(df), "out", 3)


def _each(expr: str) -> str:
    cols = ("l_quantity", "l_discount", "l_tax")
    return f"SELECT {KEY_SQL}, " + ", ".join(f"round({expr.format(c=c)}, 6) AS v{i}" for i, c in enumerate(cols)) + " FROM lineitem"


@query(_each("{c} / (SELECT max(abs({c})) FROM lineitem)"))
def ml_max_abs_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir, X.MaxAbsScaler(inputCol="features", outputCol="out"))


@query(_each("({c} - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) FROM lineitem)"))
def ml_min_max_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir, X.MinMaxScaler(inputCol="features", outputCol="out"))


@query(_each("({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_samp({c}) FROM lineitem)"))
def ml_standard_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir, X.StandardScaler(inputCol="features", outputCol="out", withMean=True))


@query(_each("{c} / sqrt(l_quantity * l_quantity + l_discount * l_discount + l_tax * l_tax)"))
def ml_normalizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(X.Normalizer(inputCol="features", outputCol="out").transform(lines(spark, sf_dir)), "out", 3)


@query(
    f"SELECT {KEY_SQL}, round(l_quantity, 6) AS v0, round(l_quantity * l_quantity, 6) AS v1, round(l_discount, 6) AS v2, round(l_quantity * l_discount, 6) AS v3, round(l_discount * l_discount, 6) AS v4 FROM lineitem"
)
def ml_polynomial_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = X.VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="two").transform(table(spark, sf_dir, "lineitem"))
    return cells(X.PolynomialExpansion(degree=2, inputCol="two", outputCol="out").transform(two), "out", 5)


@query("SELECT d.doc_id, round(coalesce(l.quality, (SELECT avg(quality) FROM labels)), 6) AS q FROM documents d LEFT JOIN labels l USING (doc_id)")
def ml_imputer(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", F.col("quality").cast("double").alias("quality"))
    return X.Imputer(inputCols=["quality"], outputCols=["q"]).fit(d).transform(d).select("doc_id", F.round("q", 6).alias("q"))


_INDEXED = "(SELECT c_mktsegment AS s, (row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1)::DOUBLE AS i FROM customer GROUP BY 1)"


@query(f"SELECT c_custkey, i FROM customer JOIN {_INDEXED} ON s = c_mktsegment")
def ml_string_indexer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return X.StringIndexer(inputCol="c_mktsegment", outputCol="i").fit(c).transform(c).select("c_custkey", "i")


@query("SELECT c_custkey, c_mktsegment AS back FROM customer")
def ml_index_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    model = X.StringIndexer(inputCol="c_mktsegment", outputCol="i").fit(c)
    return X.IndexToString(inputCol="i", outputCol="back", labels=model.labels).transform(model.transform(c)).select("c_custkey", "back")


@query("SELECT c_custkey, " + ", ".join(f"(CASE WHEN i = {k} THEN 1 ELSE 0 END)::DOUBLE AS v{k}" for k in range(4)) + f" FROM customer JOIN {_INDEXED} ON s = c_mktsegment")
def ml_one_hot_encoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    c = X.StringIndexer(inputCol="c_mktsegment", outputCol="i").fit(c).transform(c)
    return cells(X.OneHotEncoder(inputCols=["i"], outputCols=["out"]).fit(c).transform(c), "out", 4, ["c_custkey"])


_SPLIT = r"regexp_split_to_array(lower(coalesce(text, '')), '\s')"


@query(f"SELECT doc_id, len({_SPLIT}) AS n FROM documents")
def ml_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens(spark, sf_dir).select("doc_id", F.size("tokens").cast("long").alias("n"))


@query("SELECT doc_id, len(regexp_extract_all(lower(text), '[a-z0-9_]+', 0)) AS n FROM documents")
def ml_regex_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = X.RegexTokenizer(inputCol="text", outputCol="tokens", pattern="[a-z0-9_]+", gaps=False)
    return t.transform(table(spark, sf_dir, "documents")).select("doc_id", F.size("tokens").cast("long").alias("n"))


@query(f"SELECT doc_id, len(list_filter({_SPLIT}, lambda w: w NOT IN {q.STOP})) AS n FROM documents")
def ml_stop_words_remover(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = X.StopWordsRemover(inputCol="tokens", outputCol="kept", stopWords=ENGLISH)
    return t.transform(tokens(spark, sf_dir)).select("doc_id", F.size("kept").cast("long").alias("n"))


@query(
    f"SELECT gram, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM (SELECT {_SPLIT} AS w FROM documents)) GROUP BY 1"
)
def ml_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    grams = X.NGram(n=2, inputCol="tokens", outputCol="grams").transform(tokens(spark, sf_dir))
    return grams.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


@query("SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 4) AS mean FROM part GROUP BY 1")
def ml_sql_transformer(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = X.SQLTransformer(statement="SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 4) AS mean FROM __THIS__ GROUP BY 1")
    return t.transform(table(spark, sf_dir, "part"))


@query("SELECT count(*) AS n, round(avg(l_quantity), 6) AS m0, round(avg(l_discount), 6) AS m1, round(var_samp(l_quantity), 6) AS s0, round(var_samp(l_discount), 6) AS s1 FROM lineitem")
def ml_summarizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lines(spark, sf_dir).select(stat.Summarizer.metrics("mean", "variance", "count").summary(F.col("features")).alias("s"))
    mean, variance = vector_to_array(F.col("s.mean")), vector_to_array(F.col("s.variance"))
    return s.select(F.col("s.count").alias("n"), *[F.round(F.get(a, F.lit(i)), 6).alias(f"{n}{i}") for n, a in (("m", mean), ("s", variance)) for i in range(2)])


@query("SELECT round(corr(l_quantity, l_discount), 6) AS qd, round(corr(l_quantity, l_tax), 6) AS qt, round(corr(l_discount, l_tax), 6) AS dt FROM lineitem")
def ml_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = stat.Correlation.corr(lines(spark, sf_dir), "features").first()[0].toArray()
    return spark.createDataFrame([(round(float(m[0, 1]), 6), round(float(m[0, 2]), 6), round(float(m[1, 2]), 6))], "qd double, qt double, dt double")


@query("SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem")
def ml_linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = X.VectorAssembler(inputCols=["l_quantity"], outputCol="q").transform(table(spark, sf_dir, "lineitem"))
    m = R.LinearRegression(featuresCol="q", labelCol="l_extendedprice", solver="normal").fit(df)
    return spark.createDataFrame([(round(float(m.coefficients[0]), 3), round(float(m.intercept), 2), round(float(m.summary.r2), 6))], "slope double, intercept double, r2 double")


@query(
    "WITH c AS (SELECT l_returnflag AS a, l_linenumber AS b, count(*) AS o FROM lineitem GROUP BY 1, 2), e AS (SELECT *, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e FROM c) "
    "SELECT round(sum(power(o - e, 2) / e), 5) AS statistic, CAST((count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS INT) AS freedom FROM e"
)
def ml_chi_square_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    li = X.StringIndexer(inputCol="l_returnflag", outputCol="y").fit(li).transform(li)
    li = X.VectorAssembler(inputCols=["l_linenumber"], outputCol="x").transform(li)
    r = stat.ChiSquareTest.test(li, "x", "y").first()
    return spark.createDataFrame([(round(float(r.statistics[0]), 5), int(r.degreesOfFreedom[0]))], "statistic double, freedom int")


_WAVE = "SELECT vec_id, i AS k, round(sqrt(2.0 / n) * s * CASE WHEN i = 0 THEN sqrt(0.5) ELSE 1 END, 5) AS value"


@query(
    "WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS j, len(embedding) AS n FROM embeddings), k AS (SELECT DISTINCT j AS i, n FROM v) "
    f"{_WAVE} FROM (SELECT vec_id, i, n, sum(x * cos(pi() * (j + 0.5) * i / n)) AS s FROM v JOIN k USING (n) GROUP BY 1, 2, 3)"
)
def ml_dct(spark: SparkSession, sf_dir: str) -> DataFrame:
    waves = X.DCT(inputCol="features", outputCol="out").transform(vectors(spark, sf_dir))
    return waves.select("vec_id", F.posexplode(vector_to_array("out")).alias("k", "value")).select("vec_id", F.col("k").cast("long").alias("k"), F.round("value", 5).alias("value"))


@query(f"SELECT {KEY_SQL}, l_quantity AS v0, l_discount AS v1, l_tax AS v2 FROM lineitem")
def ml_vector_size_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(X.VectorSizeHint(inputCol="features", size=3, handleInvalid="skip").transform(lines(spark, sf_dir)), "features", 3)


@query(f"SELECT {KEY_SQL}, l_quantity AS v0, (dense_rank() OVER (ORDER BY l_discount) - 1)::DOUBLE AS v1, (dense_rank() OVER (ORDER BY l_tax) - 1)::DOUBLE AS v2 FROM lineitem")
def ml_vector_indexer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of at most twelve values become their places; the quantity has fifty and stays."""
    return _fitted(spark, sf_dir, X.VectorIndexer(maxCategories=12, inputCol="features", outputCol="out"))


_FLAGS = "(SELECT l_returnflag AS s, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS i FROM lineitem GROUP BY 1)"


@query(f"SELECT {KEY_SQL}, l_quantity AS v0, CASE WHEN i = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v1, CASE WHEN i = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v2 FROM lineitem JOIN {_FLAGS} ON s = l_returnflag")
def ml_rformula(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir, X.RFormula(formula="l_extendedprice ~ l_quantity + l_returnflag", featuresCol="out", labelCol="y"))


# features checked by their rows


def _rows(name: str, build) -> None:
    build.__name__ = name
    query()(build)


def _transformed(estimator, source=lines, keep=KEYS, column: str = "out"):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = source(spark, sf_dir)
        model = estimator().fit(df) if hasattr(estimator(), "fit") else estimator()
        out = model.transform(df)
        value = F.col(column) if dict(out.dtypes)[column] != "vector" else F.array_join(F.transform(vector_to_array(F.col(column)), lambda v: F.round(v, 5).cast("string")), ",")
        return out.select(*keep, value.alias("out"))

    return build


VEC = ["vec_id"]
_rows("ml_pca", _transformed(lambda: X.PCA(k=3, inputCol="features", outputCol="out"), vectors, VEC))
_rows("ml_quantile_discretizer", _transformed(lambda: X.QuantileDiscretizer(numBuckets=4, inputCol="l_extendedprice", outputCol="out")))
_rows("ml_chisq_selector", _transformed(lambda: X.ChiSqSelector(numTopFeatures=1, featuresCol="features", outputCol="out", labelCol="l_linenumber")))


@query()
def ml_feature_hasher(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = X.FeatureHasher(inputCols=["p_brand", "p_type", "p_size"], outputCol="out").transform(table(spark, sf_dir, "part"))
    return nonzero(hashed, "out", "p_partkey")


@query()
def ml_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    tf = X.HashingTF(inputCol="tokens", outputCol="tf").transform(tokens(spark, sf_dir))
    weighted = X.IDF(inputCol="tf", outputCol="w").fit(tf).transform(tf)
    return nonzero(weighted, "w", "doc_id").withColumn("value", F.round("value", 5))


_COUNTED = (
    f"w AS (SELECT doc_id, unnest({_SPLIT}) AS word FROM documents), total AS (SELECT count(*) AS m FROM documents), "
    "d AS (SELECT word, df, row_number() OVER (ORDER BY df DESC, word) - 1 AS slot FROM (SELECT word, count(DISTINCT doc_id) AS df FROM w GROUP BY 1)), "
    "c AS (SELECT doc_id, word, slot, count(*)::DOUBLE AS n, any_value(df) AS df FROM w JOIN d USING (word) GROUP BY ALL)"
)


def _counted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Words of all documents, and the dictionary of all words."""
    rows = vocabulary.word_rows(tokens(spark, sf_dir), "doc_id", F.col("tokens"))
    return rows, vocabulary.dictionary(rows)


@query(f"WITH {_COUNTED} SELECT doc_id, word, slot, n AS value FROM c")
def ml_count_vectorizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vocabulary.sparse_rows(*_counted(spark, sf_dir), "doc_id")
    return found.select("doc_id", "word", "slot", F.col("n").cast("double").alias("value"))


@query(f"WITH {_COUNTED} SELECT doc_id, word, round(n * ln((m + 1) / (df + 1)), 5) AS value FROM c, total")
def ml_idf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vocabulary.idf_weights(*_counted(spark, sf_dir), "doc_id", table(spark, sf_dir, "documents").count())
    return found.select("doc_id", "word", F.round("value", 5).alias("value"))


@query()
def ml_word2vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = tokens(spark, sf_dir)
    model = X.Word2Vec(vectorSize=8, minCount=5, maxIter=1, seed=1, inputCol="tokens", outputCol="out").fit(df)
    return cells(model.transform(df), "out", 8, ["doc_id"])


def _binary(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return X.HashingTF(inputCol="tokens", outputCol="features", binary=True).transform(tokens(spark, sf_dir, name))


@query()
def ml_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query articles against documents, by approximate Jaccard distance."""
    docs, queries = _binary(spark, sf_dir, "documents"), _binary(spark, sf_dir, "benchmark")
    model = X.MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=8, seed=3).fit(docs)
    found = model.approxSimilarityJoin(queries, docs, 0.8, "distance")
    return found.select(F.col("datasetA.item_id").alias("query_id"), F.col("datasetB.doc_id").alias("doc_id"), F.round("distance", 6).alias("distance"))


@query()
def ml_lsh_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = vectors(spark, sf_dir)
    model = X.BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=0.5, numHashTables=4, seed=3).fit(df)
    key = df.orderBy("vec_id").first().features
    return model.approxNearestNeighbors(df, key, 10).select("vec_id", F.round("distCol", 6).alias("distance"))


@query()
def ml_ks_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = stat.KolmogorovSmirnovTest.test(table(spark, sf_dir, "events"), "value", "norm", 50.0, 50.0).first()
    return spark.createDataFrame([(float(r.statistic), float(r.pValue))], "statistic double, p double")


# models


def _predicts(estimator, source, label: str = "label", regression: bool = False):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = source(spark, sf_dir)
        out = estimator().fit(df).transform(df)
        if regression:
            gap = F.col("prediction") - F.col(label)
            return out.agg(F.count("*").alias("n"), F.round(F.sqrt(F.avg(gap * gap)), 3).alias("rmse"))
        return out.groupBy(F.col(label).alias("label"), "prediction").agg(F.count("*").alias("n"))

    return build


def _positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector(F.transform("embedding", lambda v: F.abs(v).cast("double"))).alias("features"), (F.col("label") < 5).cast("double").alias("label"))


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir, kept=True).withColumn("label", F.col("l_extendedprice")).withColumn("censor", F.lit(1.0))


for _name, _make in {
    "ml_linear_svc": lambda: C.LinearSVC(maxIter=10),
    "ml_logreg": lambda: C.LogisticRegression(maxIter=20, regParam=0.01),
    "ml_decision_tree_classifier": lambda: C.DecisionTreeClassifier(maxDepth=4, seed=1),
    "ml_random_forest_classifier": lambda: C.RandomForestClassifier(numTrees=10, maxDepth=4, seed=1),
    "ml_gbt_classifier": lambda: C.GBTClassifier(maxIter=5, maxDepth=3, seed=1),
    "ml_perceptron": lambda: C.MultilayerPerceptronClassifier(layers=[64, 8, 2], maxIter=20, seed=1),
}.items():
    _rows(_name, _predicts(_make, vectors))
_rows("ml_naive_bayes", _predicts(lambda: C.NaiveBayes(), _positive))
_rows("ml_one_vs_rest", _predicts(lambda: C.OneVsRest(classifier=C.LogisticRegression(maxIter=5), labelCol="digit"), vectors, "digit"))
for _name, _make in {
    "ml_isotonic": lambda: R.IsotonicRegression(featureIndex=0),
    "ml_decision_tree_regressor": lambda: R.DecisionTreeRegressor(maxDepth=4, seed=1),
    "ml_random_forest_regressor": lambda: R.RandomForestRegressor(numTrees=5, maxDepth=4, seed=1),
    "ml_gbt_regressor": lambda: R.GBTRegressor(maxIter=3, maxDepth=3, seed=1),
    "ml_aft_survival": lambda: R.AFTSurvivalRegression(maxIter=10),
    "ml_glm": lambda: R.GeneralizedLinearRegression(family="gamma", link="log", maxIter=5),
}.items():
    _rows(_name, _predicts(_make, _priced, regression=True))


def _clustered(estimator, source=vectors):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = source(spark, sf_dir)
        return estimator().fit(df).transform(df).groupBy("prediction").agg(F.count("*").alias("n"))

    return build


_rows("ml_kmeans", _clustered(lambda: K.KMeans(k=5, seed=1, maxIter=10)))
_rows("ml_bisecting_kmeans", _clustered(lambda: K.BisectingKMeans(k=4, seed=1, maxIter=5)))
_rows("ml_gaussian_mixture", _clustered(lambda: K.GaussianMixture(k=2, seed=1, maxIter=5), lambda spark, sf_dir: lines(spark, sf_dir, kept=True)))


@query()
def ml_lda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of all documents over all words; no table of the words is in the driver."""
    rows, words = _counted(spark, sf_dir)
    terms = topics.best_words(*topics.word_topics(rows, words, "doc_id", k=4, iterations=3, seed=1), 5).join(words, "slot")
    return terms.groupBy("topic").agg(F.array_join(F.array_sort(F.collect_list(F.struct("place", "word")))["word"], ",").alias("terms"))


@query()
def ml_power_iteration(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    links = li.groupBy((F.col("l_partkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst")).agg(F.sum("l_quantity").alias("weight"))
    if li.count() > ROWS_PER_TASK:  # Spark's own keeps the graph of each round in the executors
        found = graph.power_iteration_clusters(materialise(links), 3, 5)
    else:
        found = K.PowerIterationClustering(k=3, maxIter=5, weightCol="weight").assignClusters(links)
    return found.groupBy("cluster").agg(F.count("*").alias("n"))


@query()
def ml_als(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    ratings = o.join(li, o.o_orderkey == li.l_orderkey).groupBy("o_custkey", "l_suppkey").agg(F.sum("l_quantity").alias("rating"))
    model = recommendation.ALS(rank=4, maxIter=3, userCol="o_custkey", itemCol="l_suppkey", ratingCol="rating", coldStartStrategy="drop", seed=1).fit(ratings)
    best = recommend_for_all_users(model, 3).select("o_custkey", F.explode("recommendations").alias("r"))
    return best.select("o_custkey", "r.l_suppkey", F.round("r.rating", 3).alias("rating"))


def _baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return li.join(part, li.l_partkey == part.p_partkey).groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("items"))


@query(
    "WITH b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS i FROM lineitem JOIN part ON p_partkey = l_partkey), t AS (SELECT count(DISTINCT o) AS n FROM b) "
    "SELECT items, freq FROM (SELECT i AS items, count(*) AS freq FROM b GROUP BY 1 UNION ALL SELECT x.i || ',' || y.i, count(*) FROM b x JOIN b y ON x.o = y.o AND x.i < y.i GROUP BY 1 "
    "UNION ALL SELECT x.i || ',' || y.i || ',' || z.i, count(*) FROM b x JOIN b y ON x.o = y.o AND x.i < y.i JOIN b z ON z.o = y.o AND y.i < z.i GROUP BY 1), t WHERE freq >= ceil(0.015 * n)"
)
def ml_fpgrowth(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fpm.FPGrowth(itemsCol="items", minSupport=0.015, minConfidence=0.1).fit(_baskets(spark, sf_dir))
    return model.freqItemsets.select(F.array_join(F.sort_array("items"), ",").alias("items"), "freq")


@query()
def ml_prefixspan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands of an order in the order of its lines; an order has a handful of lines, which bounds the patterns."""
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "p_brand")
    orders = li.join(part, li.l_partkey == part.p_partkey).groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    sequences = orders.select(F.transform("lines", lambda x: F.array(x["p_brand"])).alias("sequence"))
    longest = sequences.agg(F.max(F.size("sequence"))).first()[0] or 1
    found = fpm.PrefixSpan(minSupport=0.03, maxPatternLength=longest).findFrequentSequentialPatterns(sequences)
    return found.select(F.array_join(F.flatten("sequence"), ">").alias("sequence"), "freq")


# evaluation and tuning


@query()
def ml_evaluators(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = vectors(spark, sf_dir)
    out = C.LogisticRegression(maxIter=10).fit(df).transform(df)
    priced = _priced(spark, sf_dir)
    fitted = R.LinearRegression(maxIter=5).fit(priced).transform(priced)
    clustered = K.KMeans(k=3, seed=1).fit(df).transform(df)
    rows = [
        ("area under curve", E.BinaryClassificationEvaluator().evaluate(out)), ("accuracy", E.MulticlassClassificationEvaluator(metricName="accuracy").evaluate(out)),
        ("rmse", E.RegressionEvaluator().evaluate(fitted)), ("silhouette", E.ClusteringEvaluator().evaluate(clustered)),
    ]
    return spark.createDataFrame([(n, round(float(v), 4)) for n, v in rows], "metric string, value double")


def _grid(model):
    return tuning.ParamGridBuilder().addGrid(model.regParam, [0.0, 0.1]).build()


@query()
def ml_cross_validator(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = C.LogisticRegression(maxIter=5)
    cv = tuning.CrossValidator(estimator=model, estimatorParamMaps=_grid(model), evaluator=E.BinaryClassificationEvaluator(), numFolds=2, seed=1)
    metrics = cv.fit(vectors(spark, sf_dir)).avgMetrics
    return spark.createDataFrame([(i, round(float(m), 4)) for i, m in enumerate(metrics)], "candidate int, metric double")


@query()
def ml_train_validation_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = C.LogisticRegression(maxIter=5)
    split = tuning.TrainValidationSplit(estimator=model, estimatorParamMaps=_grid(model), evaluator=E.BinaryClassificationEvaluator(), seed=1)
    metrics = split.fit(vectors(spark, sf_dir)).validationMetrics
    return spark.createDataFrame([(i, round(float(m), 4)) for i, m in enumerate(metrics)], "candidate int, metric double")


@query()
def ml_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of a text from its words, as one pipeline."""
    df = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").withColumn("label", F.col("quality").cast("double"))
    stages = [
        X.Tokenizer(inputCol="text", outputCol="tokens"), X.HashingTF(inputCol="tokens", outputCol="features"), C.LogisticRegression(maxIter=5, regParam=0.1)
    ]
    out = Pipeline(stages=stages).fit(df).transform(df)
    return out.groupBy("label", "prediction").agg(F.count("*").alias("n"))
