"""The edge to ``pyspark.ml``: sparse vectors per document, built row by row without a shuffle."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vectorizer(words: list[str], idf: list[float] | None = None) -> PipelineModel:
    """Turns a ``tokens`` column into a ``features`` vector of tf, or of tf * idf.

    ``words`` is the dictionary in position order, at most f of them.
    """
    count = CountVectorizerModel.from_vocabulary(list(words), inputCol="tokens", outputCol="counts")
    tf = Normalizer(p=1.0, inputCol="counts", outputCol="features" if idf is None else "tf")
    if idf is None:
        return PipelineModel([count, tf])
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="tf", outputCol="features")
    return PipelineModel([count, tf, scale])


def fit_lbfgs(data: DataFrame, iterations: int = 100, l2: float = 0.0):
    """Logistic regression without intercept, unpenalised unless ``l2`` is given. ``data`` holds label and features."""
    return LogisticRegression(
        maxIter=iterations, regParam=l2, fitIntercept=False, tol=1e-9 if l2 else 1e-6
    ).fit(data)


def logistic_gradient(data: DataFrame, model, l2: float) -> float:
    """The largest part of the gradient of the objective at the model's weights.

    The objective is mean log loss + l2 / 2 |w|^2, both in features scaled to unit deviation.
    """
    told = model.transform(data).select(
        (F.element_at(vector_to_array("probability"), 2) - F.col("label")).alias("error"), "features"
    )
    parts = told.select(F.posexplode(vector_to_array("features")).alias("pos", "x"), "error").filter("x != 0")
    n = data.count()
    sums = parts.groupBy("pos").agg((F.sum(F.col("x") * F.col("error")) / n).alias("g")).toArrow()
    spread = data.select(Summarizer.std(data["features"])).first()[0].toArray()
    gradient = l2 * spread * model.coefficients.toArray()
    pos, moved = sums["pos"].to_numpy(), spread[sums["pos"].to_numpy()] > 0
    gradient[pos[moved]] += sums["g"].to_numpy()[moved] / spread[pos[moved]]
    return float(abs(gradient).max())


def fit_linear_svc(data: DataFrame, iterations: int = 200, weight: str | None = None):
    """Linear SVM with the packaged optimizer, optionally with a weight column."""
    svc = LinearSVC(maxIter=iterations, regParam=0.01, fitIntercept=False)
    return (svc.setWeightCol(weight) if weight else svc).fit(data)


def fit_naive_bayes(data: DataFrame, smoothing: float = 1.0):
    """Packaged multinomial naive Bayes; features must not be negative."""
    return NaiveBayes(smoothing=smoothing, modelType="multinomial").fit(data)
