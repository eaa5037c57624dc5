"""Model jobs on DataFrames.

Fitting and scoring are MLlib jobs; the driver only loops over folds / grid points (bounded
metadata) and submits one distributed fit per iteration.  Rows are identified by key: out-of-fold
predictions are the union of the per-fold scorings, never a positional concatenation.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import FMRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tabwright.operators.metrics import kappa_quadratic


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Feature blocks joined by key are assembled into one vector column."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def oof_predict(train: DataFrame, test: DataFrame | None, estimator_fn: Callable[[], Estimator], key: str,
                fold_col: str = "fold", prediction: str = "prediction",
                first_fold_bound: Callable[[DataFrame], bool] | None = None, fit_rows: dict | None = None, keep: Sequence[str] = ()):
    """Out-of-fold predictions ``(key, fold, pred)`` (each row scored by the model that did not
    see its fold) plus, when ``test`` is given, test predictions from a refit on all training rows.

    C6: ``first_fold_bound(scored_fold_0) → bool``; when it returns False the remaining folds are
    not submitted (early abandon) and ``None`` is returned for the out-of-fold table.
    fit_rows: per fold the rows to fit on instead of the other folds' (``other_folds``); keep: columns to keep."""
    folds = sorted(fit_rows) if fit_rows else [r[0] for r in train.select(fold_col).distinct().orderBy(fold_col).collect()]  # k values
    parts = []
    for i, f in enumerate(folds):
        model = estimator_fn().fit(fit_rows[f] if fit_rows else train.where(F.col(fold_col) != f))
        scored = model.transform(train.where(F.col(fold_col) == f)).select(
            key, fold_col, *keep, F.col(prediction).alias("pred"))
        if i == 0 and first_fold_bound is not None and not first_fold_bound(scored):
            return None, None
        parts.append(scored)
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    test_pred = None
    if test is not None:
        full = estimator_fn().fit(train)
        test_pred = full.transform(test).select(key, F.col(prediction).alias("pred"))
    return oof, test_pred


def _products(x: np.ndarray) -> np.ndarray:
    """A row's constant, features and products of two different features: what a factorisation machine is linear in."""
    i, j = np.triu_indices(x.shape[1], 1)
    return np.hstack([np.ones((len(x), 1)), x, x[:, i] * x[:, j]])


def fit_fm(train: DataFrame, features: str, label: str, steps: int = 100, factors: int = 8, seed: int = 7, rate: float = 1.0,
           tol: float = 1e-6) -> tuple[float, np.ndarray, np.ndarray]:
    """(intercept, linear, factors) of the model that ``FMRegressor`` fits, with the rows read once.

    A prediction is linear in the products P of a row (1, x_i, x_i x_j), with weights that the parameters give, so the squared
    loss and its gradient over all rows follow from the sums P P' and P z.  Spark takes these in one pass, a partial sum a
    partition; AdamW then does the steps of ``FMRegressor`` (same start, rates and end) on them, whatever the rows.
    Rows meet the driver only as a square matrix of d (d + 1) / 2 + 1 products: for tens of features d, not for thousands."""
    x = train.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("z"))
    start = FMRegressor(featuresCol=features, labelCol=label, factorSize=factors, seed=seed, maxIter=0).fit(train.limit(1))
    v, w, b = start.factors.toArray().astype(float), start.linear.toArray().astype(float), float(start.intercept)
    d = len(w)
    i, j = np.triu_indices(d, 1)

    def sums(batches):
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                p = _products(np.asarray(batch.column(0).flatten().to_numpy()).reshape(batch.num_rows, d))
                p = np.hstack([p, batch.column(1).to_numpy(zero_copy_only=False)[:, None]])
                total = total + p.T @ p
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "s"])

    got = {r["at"]: r["s"] for r in x.mapInArrow(sums, "at long, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()}
    side = d * (d + 1) // 2 + 2
    g = np.array([got[n] for n in range(side * side)]).reshape(side, side)
    if not np.isfinite(g).all():
        raise ValueError("features and labels must be finite")
    n, gram, right = g[0, 0], g[:-1, :-1], g[:-1, -1]
    first, second, old = (np.zeros(v.size + d + 1) for _ in range(3))
    for t in range(1, steps + 1):
        pull = 2.0 / n * (gram @ np.concatenate([[b], w, (v @ v.T)[i, j]]) - right)  # of the mean loss, by the weights of P
        pair = np.zeros((d, d))
        pair[i, j] = pair[j, i] = pull[1 + d:]
        grad = np.concatenate([(pair @ v).ravel(), pull[1:1 + d], pull[:1]])
        now = np.concatenate([v.ravel(), w, [b]])
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad ** 2
        now = now - rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
        v, w, b = now[:v.size].reshape(v.shape), now[v.size:-1], float(now[-1])
        if t > 1 and np.linalg.norm(old - now) < tol * max(np.linalg.norm(now), 1.0):
            break
        old = now
    return b, w, v


def predict_fm(rows: DataFrame, features: str, model: tuple[float, np.ndarray, np.ndarray], out: str = "prediction") -> DataFrame:
    """``rows`` and the model's prediction."""
    b, w, v = model
    both, total = v @ v.T, F.lit(b)
    at = [F.get("_x", F.lit(i)) for i in range(len(w))]
    for i in range(len(w)):
        rest = F.lit(float(w[i]))
        for j in range(i + 1, len(w)):
            rest = rest + F.lit(float(both[i, j])) * at[j]
        total = total + at[i] * rest
    return rows.withColumn("_x", vector_to_array(features)).withColumn(out, total).drop("_x")


def params_record(params: dict) -> tuple[str, str]:
    """Parameter record as JSON (sorted keys) and its md5."""
    js = json.dumps(params, sort_keys=True)
    return js, hashlib.md5(js.encode()).hexdigest()


def few_rows(moments: np.ndarray) -> np.ndarray:
    """As many rows (x, y) as the matrix of moments of (1, x, y) has, with the same mean, variance and products.

    The matrix is R'R; a reflection gives all rows of R the same constant, by which they are divided."""
    scale = np.sqrt(np.maximum(np.diag(moments), 0.0))
    scale[scale == 0] = 1.0
    values, vectors = np.linalg.eigh(moments / np.outer(scale, scale))
    r = np.sqrt(np.maximum(values, 0.0))[:, None] * vectors.T
    to = np.full(len(r), np.linalg.norm(r[:, 0]) / np.sqrt(len(r)))
    u = r[:, 0] - to
    if u @ u > 0:
        r = r - 2.0 * np.outer(u, u @ r) / (u @ u)
    return (r * scale / (to[0] * scale[0]))[:, 1:]


def other_folds(train: DataFrame, features: str, label: str, fold_col: str = "fold") -> dict | None:
    """Per fold a few rows that a least-squares fit cannot tell from the rows of all other folds, with ``train`` read once.

    The squared loss, its penalties and the scaling of a linear model see the rows only through the sums of the products of
    (1, x, y).  Spark takes these by fold, a partial sum a partition; the driver gets a matrix of d + 2 a fold, for tens of
    features d, not for thousands.  None where that does not hold: sums that are not finite, less than two folds, or columns
    that are (nearly) linear in the others, where a fit hangs on the rounding."""
    x = train.select(F.col(fold_col).alias("f"), vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))

    def sums(batches):
        total = {}
        for batch in batches:
            f = batch.column(0).to_numpy(zero_copy_only=False)
            p = np.hstack([np.ones((len(f), 1)), np.asarray(batch.column(1).flatten()).reshape(len(f), -1), batch.column(2).to_numpy(zero_copy_only=False)[:, None]])
            for k in np.unique(f):
                total[k] = total.get(k, 0.0) + p[f == k].T @ p[f == k]
        for k, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, k, np.int64)), pa.array(np.arange(m.size)), pa.array(m.ravel())], names=["f", "at", "s"])

    if x.where("f IS NULL OR x IS NULL OR y IS NULL").limit(1).count():
        return None
    found: dict = {}
    for r in x.select(F.col("f").cast("long").alias("f"), "x", "y").mapInArrow(sums, "f long, at long, s double").groupBy("f", "at").agg(F.sum("s").alias("s")).collect():
        found.setdefault(r["f"], {})[r["at"]] = r["s"]
    if len(found) < 2:
        return None
    each = {f: np.array([m[i] for i in range(len(m))]).reshape(int(np.sqrt(len(m))), -1) for f, m in found.items()}
    total, out = sum(each.values()), {}
    for f, m in each.items():
        rest = total - m
        mean, n = rest[0] / rest[0, 0], rest[0, 0]
        spread = rest[1:, 1:] / n - np.outer(mean[1:], mean[1:])
        sd = np.sqrt(np.maximum(np.diag(spread), 0.0))
        if not np.isfinite(rest).all() or (sd <= 1e-6 * np.abs(mean[1:])).any() or np.linalg.eigvalsh((spread / np.outer(sd, sd))[:-1, :-1]).min() < 1e-6:
            return None
        rows = [(Vectors.dense(r[:-1]), float(r[-1])) for r in few_rows(rest)]
        out[f] = train.sparkSession.createDataFrame(rows, StructType([StructField(features, VectorUDT()), StructField(label, DoubleType())])).coalesce(1)
    return out


def evaluate_grid(train: DataFrame, make: Callable[[dict], Estimator], grid: Sequence[dict], key: str,
                  score_fn: Callable[[DataFrame], float], feat: str, model_name: str, fit_rows: dict | None = None,
                  keep: Sequence[str] = ()) -> list[tuple]:
    """One trial per grid point — CV out-of-fold predictions scored by ``score_fn``.
    A grid point that the estimator or its fit rejects is recorded with status ``failed``, the first
    line of the error and no score (never zero predictions); any other error ends the job."""
    rows = []
    for i, p in enumerate(grid):
        js, h = params_record(p)
        try:
            oof, _ = oof_predict(train, None, lambda p=p: make(p), key, fit_rows=fit_rows, keep=keep)
        except (TypeError, IllegalArgumentException, Py4JJavaError) as e:  # a rejected parameter or a failed fit is data
            rows.append((i, feat, model_name, js, h, None, "failed", str(e).splitlines()[0][:500]))
            continue
        rows.append((i, feat, model_name, js, h, float(score_fn(oof)), "ok", None))
    return rows


TRIALS_SCHEMA = "trial_id int, feat string, model string, params_json string, params_md5 string, " \
                "score double, status string, error string"


class QWKEvaluator(Evaluator):
    """Quadratic weighted kappa as an MLlib evaluator (larger is better)."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self.labelCol, self.predictionCol = labelCol, predictionCol

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(kappa_quadratic(dataset, self.labelCol, self.predictionCol).first()[0])

    def isLargerBetter(self) -> bool:
        return True


class ElementTransform(Transformer, HasFeaturesCol, HasPredictionCol):
    """Element transformer applying a column expression builder ``fn(col) -> Column``."""

    def __init__(self, inputCol: str, outputCol: str, fn):
        super().__init__()
        self.inputCol, self.outputCol, self.fn = inputCol, outputCol, fn

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.outputCol, self.fn(F.col(self.inputCol)))


class GroupCenteredRanker(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """L9/X4 re-aimed: pairwise *squared-loss* linear ranking without forming pairs.

    For the pairs of one group, Σ_{i<j} ((y_i − y_j) − w·(x_i − x_j))² equals
    n_g · Σ_i ((y_i − ȳ_g) − w·(x_i − x̄_g))², so the all-pairs objective is a least-squares fit on
    group-centred rows weighted by the group size.  Scores are ``x·w`` (no intercept)."""

    def __init__(self, group: str, feature_cols: Sequence[str], label: str, regParam: float = 0.0):
        super().__init__()
        self.group, self.cols, self.label, self.reg = group, list(feature_cols), label, regParam

    def _fit(self, dataset: DataFrame) -> "LinearScoreModel":
        from pyspark.ml.regression import LinearRegression
        cols = [*self.cols, self.label]
        # per-group means as a partial+final aggregate joined back (a huge group is never one task)
        means = dataset.groupBy(self.group).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                                                F.count(F.lit(1)).cast("double").alias("_n"))
        centred = dataset.join(means, self.group).select(
            self.group, *[(F.col(c) - F.col(f"_m_{c}")).alias(c) for c in cols], "_n")
        lr = LinearRegression(featuresCol="_f", labelCol=self.label, weightCol="_n", fitIntercept=False,
                              regParam=self.reg)
        m = lr.fit(assemble(centred, self.cols, "_f"))
        return LinearScoreModel(self.cols, [float(x) for x in m.coefficients])


class LinearScoreModel(Model):
    def __init__(self, cols: Sequence[str], weights: Sequence[float]):
        super().__init__()
        self.cols, self.weights = list(cols), list(weights)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        score = sum((F.col(c) * w for c, w in zip(self.cols, self.weights)), F.lit(0.0))
        return dataset.withColumn("prediction", score)


def experiment_registry(spark, feature_sets: Sequence[str], spaces: dict[str, dict[str, tuple]]):
    """The experiment registry as two small tables — ``experiments(feat, model)`` for every
    feature set × model, and ``param_space(model, name, kind, lo, hi, step)`` (D17).  Built from
    the configuration lists with ``explode`` (configuration, not data; not a registered query)."""
    models = sorted(spaces)
    exp = spark.range(1).select(F.explode(F.array(*[F.lit(f) for f in feature_sets])).alias("feat")).withColumn(
        "model", F.explode(F.array(*[F.lit(m) for m in models])))
    rows = [(m, name, kind, float(lo), float(hi), float(step))
            for m in models for name, (kind, lo, hi, step) in sorted(spaces[m].items())]
    space = spark.createDataFrame(rows, "model string, name string, kind string, lo double, hi double, step double")
    return exp, space


def grid_points(space_rows: Sequence[tuple]) -> list[dict]:
    """Every grid point of a ``param_space`` (rows of one model: name, kind, lo, hi, step)."""
    import itertools
    axes = []
    for name, kind, lo, hi, step in space_rows:
        n = int(round((hi - lo) / step)) + 1 if step else 1
        vals = [lo + i * step for i in range(n)]
        axes.append([(name, int(v) if kind == "int" else round(v, 10)) for v in vals])
    return [dict(p) for p in itertools.product(*axes)]
