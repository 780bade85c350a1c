"""Text classifier with calibrated confidence.

``kind="svm"`` (the default): every term of the training texts has a weight of its
own, and all classes and folds are fitted in the same passes (``linear_margins``).
Confidence: Platt scaling per class on out-of-fold margins (k folds of the training
set), by Newton steps over sums grouped by class, then normalised to sum 1; ``conf``
is the largest probability, as the original reports it.

``kind="gbt"`` (M15) and ``kind="logreg"`` use ``pyspark.ml`` on hashed features:
cleaned uni+bigram terms -> hashed counts (``HashingTF``) -> smoothed IDF with the +1
term (Spark's ``IDF`` omits it, so the fitted vector is shifted and applied with
``ElementwiseProduct``) -> L2 ``Normalizer``.  The confidence of the boosted trees is a
softmax over the class margins, uncalibrated like the original boosted model's
probabilities.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest
from pyspark.ml.feature import ElementwiseProduct, HashingTF, IDF, Normalizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.text import terms
from tillwise.operators import linear_margins as LM
from tillwise.operators.tfidf import text_tasks

# Feature slots of the pyspark.ml kinds: every term counts in the slot it hashes to.  Tree split search
# scales with the number of features, so the boosted model has fewer slots.
SLOTS = 1 << 18
BYTES_PER_TASK = 8 << 20
GBT_SLOTS = 1 << 12
GBT_TREES = 100
# Each level of a tree shuffles sums of all slots and bins for every task, so the boosted model has no more
# tasks than cores until one has this much text.  Spark holds four bytes a slot and text for each class being
# fitted; classes are fitted together as long as that stays below GBT_HELD.
GBT_BYTES_PER_TASK = 128 << 20
GBT_HELD = 4 << 30


def split_holdout(df: DataFrame, id_col: str, test_percent: int = 20, seed: int = 42) -> DataFrame:
    """Deterministic 80/20 split by a seeded hash of the id (column ``is_test``)."""
    return df.withColumn("is_test", F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(100)) < test_percent)


def fit_features(train: DataFrame, text_col: str = "text", slots: int = SLOTS) -> PipelineModel:
    """Fitted term counts + smoothed IDF (+1) + L2 normalisation."""
    with_terms = train.withColumn("_terms", terms(F.col(text_col)))
    cv = HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=slots)
    idf = IDF(inputCol="_tf", outputCol="_unused").fit(cv.transform(with_terms))
    # slots that no training text fills weigh nothing: unseen terms drop out
    weights = np.where(np.array(idf.docFreq) > 0, idf.idf.toArray() + 1.0, 0.0)
    smooth = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="_tf",
                                outputCol="_tfidf")
    norm = Normalizer(inputCol="_tfidf", outputCol="features", p=2.0)
    return PipelineModel(stages=[cv, smooth, norm])


def transform_features(model: PipelineModel, df: DataFrame, text_col: str = "text") -> DataFrame:
    return model.transform(df.withColumn("_terms", terms(F.col(text_col)))).drop("_terms", "_tf", "_tfidf")


def fit_tasks(size: int, kind: str, cores: int) -> int:
    """Tasks of a training pass over texts of ``size`` bytes."""
    # an optimiser step adds up a gradient of all slots for each task, so tasks get texts by the megabyte
    tasks = 1 + size // BYTES_PER_TASK
    return min(tasks, cores * (1 + size // (cores * GBT_BYTES_PER_TASK))) if kind == "gbt" else tasks


def classes_at_once(rows: int) -> int:
    """How many one-vs-rest boosted models of ``rows`` texts are fitted together."""
    return max(1, min(4, GBT_HELD // max(rows * GBT_SLOTS * 4, 1)))


def _classifier(kind: str, rows: int):
    if kind == "gbt":
        # Boosted trees per class (GBTClassifier is binary-only), 100 trees of depth 3 as the original
        gbt = GBTClassifier(featuresCol="features", labelCol="label_idx", maxIter=GBT_TREES, maxDepth=3,
                            stepSize=0.1, seed=42)
        return OneVsRest(classifier=gbt, featuresCol="features", labelCol="label_idx", parallelism=classes_at_once(rows))
    return LogisticRegression(featuresCol="features", labelCol="label_idx", family="multinomial",
                              maxIter=50, regParam=1e-3)


def train_classifier(train: DataFrame, id_col: str, label_col: str, kind: str = "gbt"):
    """Fit label index, hashed features and a ``pyspark.ml`` classifier."""
    indexer = StringIndexer(inputCol=label_col, outputCol="label_idx", stringOrderType="alphabetAsc",
                            handleInvalid="keep").fit(train)
    feats = fit_features(train, slots=GBT_SLOTS if kind == "gbt" else SLOTS)
    size, rows = train.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    tasks = fit_tasks(size or 0, kind, train.sparkSession.sparkContext.defaultParallelism)
    data = indexer.transform(transform_features(feats, train.repartition(tasks))).cache()
    clf = _classifier(kind, rows).fit(data)
    data.unpersist()
    return indexer, feats, clf, "softmax" if kind == "gbt" else None


def score(models, df: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, label, pred, conf, correct) of a ``pyspark.ml`` classifier."""
    indexer, feats, clf, how = models
    data = indexer.transform(transform_features(feats, df))
    names = F.array(*[F.lit(x) for x in indexer.labels])
    if how is None:
        conf = F.array_max(vector_to_array("probability"))
        out = clf.transform(data).select(id_col, label_col, F.col("prediction").cast("int").alias("_p"), conf.alias("conf"))
    else:  # softmax over the one-vs-rest margins, row by row
        scored = clf.transform(data).withColumn("_r", vector_to_array("rawPrediction"))
        top = F.array_max("_r")
        denom = F.aggregate(F.transform("_r", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, b: a + b)
        out = scored.select(id_col, label_col, F.col("prediction").cast("int").alias("_p"),
                            (F.lit(1.0) / denom).alias("conf"))
    return out.select(id_col, F.col(label_col).alias("label"), names[F.col("_p")].alias("pred"), "conf",
                      (F.col(label_col) == names[F.col("_p")]).cast("int").alias("correct"))


class LinearTexts:
    """M13 + M14 on (id, text, label, is_test): trained on the rest, ready to score the test rows.

    Rows with a null label do not train; a text without known terms is scored by the bias alone.
    """

    def __init__(self, docs: DataFrame, id_col: str, label_col: str, folds: int = 5):
        spark = docs.sparkSession
        picked = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(label_col).alias("label"), "is_test",
                             F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(folds)).cast("int").alias("fold"), terms(F.coalesce("text", F.lit(""))).alias("terms"))
        texts = LM.saved(picked.where("is_test or label is not null"), "texts")
        tasks = text_tasks(docs)
        dealt = texts.select("row", "is_test", "terms").repartition(tasks, "row")
        tf = LM.saved(dealt.select("row", "is_test", F.explode("terms").alias("term")).groupBy("row", "is_test", "term").agg(F.count("*").alias("tf")), "text-terms")
        train = texts.where("not is_test")
        #: Class names in alphabetical order; their place is the class number.
        self.labels = [r[0] for r in train.select("label").distinct().orderBy("label").collect()]
        if not self.labels:
            raise ValueError("no labelled training text")
        index = spark.createDataFrame(list(enumerate(self.labels)), T.StructType([T.StructField("y", T.IntegerType()), train.schema["label"]]))
        rows = texts.drop("terms").join(F.broadcast(index), "label", "left")
        self.vocabulary = LM.Vocabulary(tf.where("not is_test"), train.count())
        x = LM.saved(rows.join(self.vocabulary.vectors(rows, tf, tasks), "row").withColumn("y", F.coalesce("y", F.lit(-1))), "text-vectors")
        self.test = x.where("is_test")
        self.model = LM.Margins(x.where("not is_test").select("row", "ts", "xs", "y", "fold"), len(self.labels), folds)
        self.weights = LM.saved(self.model.weights, "svm-weights")
        held_out = self.model.out_of_fold.select("cls", "margin", (F.col("y") == F.col("cls")).cast("double").alias("target"))
        self.platt = LM.platt(LM.saved(held_out, "platt-margins"))

    def scored(self, id_col: str) -> DataFrame:
        """(id, label, pred, conf, correct) of the test rows."""
        margins = LM.score(self.test, self.weights).join(F.broadcast(self.platt), "cls")
        own = F.struct("margin", (-F.col("cls")).alias("cls"), (1 / (1 + F.exp(F.col("a") * F.col("margin") + F.col("b")))).alias("q"))
        best = margins.groupBy("row").agg(F.max(own).alias("top"), F.max(own["q"]).alias("most"), F.sum(own["q"]).alias("total"))
        pred = F.element_at(F.array(*[F.lit(x) for x in self.labels]), 1 - F.col("top.cls"))
        return self.test.join(best, "row").select(F.col("id").alias(id_col), "label", pred.alias("pred"), (F.col("most") / F.col("total")).alias("conf"), (F.col("label") == pred).cast("int").alias("correct"))


def accuracy(scored: DataFrame) -> DataFrame:
    """Share of correct predictions."""
    return scored.agg(F.avg("correct").alias("accuracy"), F.count(F.lit(1)).alias("n"))


def classify_texts(labelled: DataFrame, id_col: str, text_col: str, label_col: str,
                   kind: str = "svm", test_percent: int = 20) -> DataFrame:
    """S4 + M13-M16 on any labelled text table: hash split, train on the rest, score the held-out rows."""
    docs = split_holdout(labelled.select(id_col, F.col(text_col).alias("text"), label_col), id_col, test_percent)
    if kind == "svm":
        return LinearTexts(docs, id_col, label_col).scored(id_col)
    train, test = docs.where(~F.col("is_test")), docs.where(F.col("is_test"))
    return score(train_classifier(train, id_col, label_col, kind=kind), test, id_col, label_col)
