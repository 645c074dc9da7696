"""Churn models: weighted logistic regression, boosted trees, scoring, cross-
validated AUC and coefficients (M9-M13, M18, M19, S4 helpers).

Every fitted model is a ``PipelineModel`` of built-in stages, so it saves and
loads with Spark's own writer:

    SQLTransformer   encoding (+ standardisation with the training means and
                     population standard deviations, as literals)
    VectorAssembler  ordered feature names -> ``features``
    estimator        LogisticRegression or GBTClassifier

The scaler is fitted on training rows only (one aggregation); the encoders
from ``encode.FeatureSpec`` were fitted on bounded level lists.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators import boosting, encode, metrics, split
from churnlens.schema import GBTConfig, LogisticConfig
from churnlens.session import materialize

Z = "__z"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(float(v))


def encoding_sql(spec: encode.FeatureSpec, scaler: encode.StandardScalerModel | None) -> str:
    """One SELECT that adds encoded (and optionally standardised) columns."""
    exprs = [f"CAST(({_ident(c)} <=> 'Yes') AS INT) AS {_ident(c + '_enc')}" for c in spec.flag_columns]
    exprs += [f"CAST(({_ident(c)} <=> {_lit(v)}) AS INT) AS {_ident(c + '_enc')}"
              for c, v in spec.equal_pairs]
    exprs += [f"CAST(({_ident(c)} <=> {_lit(lv)}) AS INT) AS {_ident(f'{p}_{lv}')}"
              for c, p, levels in spec.onehot.specs for lv in levels]
    sql = "SELECT *, " + ", ".join(exprs) + " FROM __THIS__" if exprs else "SELECT * FROM __THIS__"
    if scaler is None:
        return sql
    scaled = []
    for c, mean, std in scaler.stats:
        x = f"(CAST({_ident(c)} AS DOUBLE) - {_lit(mean)})"
        scaled.append(f"{x} / {_lit(std)} AS {_ident(c + Z)}" if std > 0
                      else f"{x} * 0.0 AS {_ident(c + Z)}")
    return f"SELECT *, {', '.join(scaled)} FROM ({sql})"


@dataclass
class ChurnModel:
    kind: str
    pipeline: PipelineModel
    names: tuple[str, ...]
    label: str
    margin_scale: float = 2.0  # Spark's trees add up to half the log-odds

    @property
    def estimator(self):
        return self.pipeline.stages[-1]

    def score(self, df: DataFrame, prob: str = "prob", prediction: str = "prediction") -> DataFrame:
        """Class at 0.5 and P(churn)."""
        out = self.pipeline.transform(df)
        keep = [c for c in df.columns]
        return out.select(*keep, vector_to_array(F.col("probability"))[1].alias(prob),
                          F.col("prediction").cast("int").alias(prediction))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)


def load_model(path: str, kind: str, names, label: str) -> ChurnModel:
    return ChurnModel(kind, PipelineModel.load(path), tuple(names), label)


def _encoded(df: DataFrame, spec: encode.FeatureSpec) -> DataFrame:
    return spec.transform(df)


def detached(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The same fitted pipeline, written to and read back from the checkpoint folder.

    A freshly fitted ``LogisticRegressionModel`` keeps its training summary,
    which references the SparkSession; the prediction UDF serialises the whole
    model, so scoring fails ("Task not serializable") once the session has
    used an ``Observation``.  A reloaded model has no summary, and the saved
    copy survives a lost driver or executor.
    """
    from churnlens.session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def fit_logistic(train: DataFrame, spec: encode.FeatureSpec, label: str,
                 cfg: LogisticConfig = LogisticConfig()) -> ChurnModel:
    """Balanced-weight logistic regression on standardised features.

    scikit-learn minimises ``C * sum(w * loss) + ||b||^2 / 2``; Spark minimises
    ``sum(w * loss) / sum(w) + regParam * ||b||^2 / 2``; hence
    ``regParam = 1 / (C * sum(w))``, with Spark's own standardisation off
    because features are already standardised.  A very large C (1e9 in the
    reference's baseline) gives a vanishing but faithful penalty.
    """
    weighted = split.with_weights(train, label, "balanced")
    scaler = encode.fit_standard_scaler(_encoded(train, spec), list(spec.names))
    sum_w = float(weighted.agg(F.sum("weight")).first()[0])
    reg = 1.0 / (cfg.c * sum_w)
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight",
                            regParam=reg, elasticNetParam=0.0, standardization=False,
                            maxIter=cfg.max_iter, tol=cfg.tol, family="binomial")
    pipe = Pipeline(stages=[
        SQLTransformer(statement=encoding_sql(spec, scaler)),
        VectorAssembler(inputCols=[n + Z for n in spec.names], outputCol="features",
                        handleInvalid="error"),
        lr])
    fitted = detached(pipe.fit(weighted), train.sparkSession)
    return ChurnModel("logistic", fitted, spec.names, label)


def fit_gbt(train: DataFrame, spec: encode.FeatureSpec, label: str,
            cfg: GBTConfig = GBTConfig()) -> ChurnModel:
    """Gradient-boosted trees with positive weight = negatives / positives.

    Spark's GBT is first-order with per-node feature sampling, so equal
    parameters do not give the reference's model; parity is by metric band.
    Checkpoints every 10 trees into the session's checkpoint folder.
    """
    weighted = split.with_weights(train, label, "pos")
    gbt = GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight",
                        maxIter=cfg.max_iter, maxDepth=cfg.max_depth, stepSize=cfg.step_size,
                        subsamplingRate=cfg.subsampling_rate,
                        featureSubsetStrategy=cfg.feature_subset, seed=cfg.seed,
                        checkpointInterval=10, cacheNodeIds=False)
    pipe = Pipeline(stages=[
        SQLTransformer(statement=encoding_sql(spec, None)),
        VectorAssembler(inputCols=list(spec.names), outputCol="features", handleInvalid="error"),
        gbt])
    return ChurnModel("gbt", pipe.fit(weighted), spec.names, label)


def fit_boosted(train: DataFrame, spec: encode.FeatureSpec, label: str,
                cfg: GBTConfig = GBTConfig()) -> boosting.BoostedModel:
    """Second-order boosted trees with positive weight = negatives / positives."""
    return boosting.fit_boosted(train, feature_pipeline(spec), spec.names, label, cfg)[0]


def feature_pipeline(spec: encode.FeatureSpec) -> PipelineModel:
    """The encoding of raw columns into feature columns, as a pipeline that can be stored."""
    return PipelineModel(stages=[SQLTransformer(statement=encoding_sql(spec, None))])


def coefficients(model: ChurnModel) -> DataFrame:
    """``(feature, coefficient)`` on the standardised scale, plus the intercept."""
    lr = model.estimator
    spark = SparkSession.getActiveSession()
    rows = [(n, float(c)) for n, c in zip(model.names, lr.coefficients.toArray())]
    rows.append(("(intercept)", float(lr.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def cv_auc(train: DataFrame, spec: encode.FeatureSpec, label: str, key: str, fits,
           n_folds: int = 5, seed: int = 42, parallelism: int = 15) -> DataFrame:
    """Exact AUC per model and stratified fold, refitting the pipeline each time.

    ``fits`` maps a model name to ``fit(train_rows, spec, label) -> ChurnModel``.
    Folds of all models run through one pool, on folds stored once.  Output
    ``(model, fold, auc)``; ``cv_summary`` has mean and deviation.  The area is
    null for a fold that lacks a class.
    """
    folded = materialize(split.assign_folds(train, label, key, n_folds, seed), "folds")

    def run(task):
        name, f = task
        m = fits[name](folded.where(F.col("fold") != f).drop("fold"), spec, label)
        held = m.score(folded.where(F.col("fold") == f).drop("fold"))
        return name, f, metrics.roc_auc(held, label, "prob").first()["auc"]

    tasks = [(name, f) for name in fits for f in range(n_folds)]
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(tasks)))) as pool:
        rows = list(pool.map(run, tasks))
    return train.sparkSession.createDataFrame(rows, "model string, fold int, auc double")


def cv_summary(folds: DataFrame) -> DataFrame:
    """``(model, n_folds, auc_mean, auc_std)``: mean and population deviation over the folds."""
    return folds.groupBy("model").agg(F.count("auc").alias("n_folds"), F.avg("auc").alias("auc_mean"),
                                      F.stddev_pop("auc").alias("auc_std"))


def gbt_trees(model: ChurnModel, scratch_dir: str):
    """Node arrays of every tree.

    Those of Spark's trees are read back from the saved model: it is written to ``scratch_dir`` (the shared checkpoint folder)
    and its node table (trees x nodes rows, bounded by the model size) is
    collected.
    """
    import numpy as np

    from churnlens.operators.treeshap import Tree

    if isinstance(model, boosting.BoostedModel):
        return model.trees.for_shap()
    cached = getattr(model, "_trees", None)
    if cached is not None:
        return cached
    gbt = model.estimator
    path = f"{scratch_dir.rstrip('/')}/gbt-{uuid.uuid4().hex}"
    gbt.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.impurityStats",
        "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
        "nodeData.split.leftCategoriesOrThreshold").collect()
    weights = list(gbt.treeWeights)
    by_tree: dict[int, list] = {}
    for r in nodes:
        by_tree.setdefault(r["treeID"], []).append(r)
    trees = []
    for t in sorted(by_tree):
        rs = sorted(by_tree[t], key=lambda r: r["id"])
        idx = {r["id"]: i for i, r in enumerate(rs)}
        n = len(rs)
        left = np.full(n, -1, dtype=np.int64)
        right = np.full(n, -1, dtype=np.int64)
        feat = np.full(n, -1, dtype=np.int64)
        thr = np.zeros(n)
        val = np.zeros(n)
        cov = np.zeros(n)
        for i, r in enumerate(rs):
            val[i] = r["prediction"]
            cov[i] = r["impurityStats"][0]
            if r["leftChild"] >= 0:
                left[i] = idx[r["leftChild"]]
                right[i] = idx[r["rightChild"]]
                feat[i] = r["featureIndex"]
                thr[i] = r["leftCategoriesOrThreshold"][0]
        root = idx[min(idx)] if 0 not in idx else idx[0]
        assert root == 0, "root must be the first node"
        trees.append(Tree(left, right, feat, thr, val, cov, float(weights[t])))
    model._trees = trees
    return trees


def shap_values(model: ChurnModel, df: DataFrame, key: str, scratch_dir: str,
                out: str = "shap", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per-row log-odds contributions of a tree model.

    Output: ``df``'s key, ``keep`` and feature columns plus ``shap
    ARRAY<DOUBLE>`` aligned with ``model.names`` and ``base`` (expected
    log-odds).  Runs as
    ``mapInPandas`` on Arrow batches with the broadcast node arrays.
    """
    import numpy as np
    import pandas as pd
    from pyspark import cloudpickle

    from churnlens.operators import treeshap

    # Executors need not have this package installed: the TreeSHAP code
    # travels with the task closure, the trees as plain arrays.
    cloudpickle.register_pickle_by_value(treeshap)
    trees = gbt_trees(model, scratch_dir)
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(
        [(t.left, t.right, t.feature, t.threshold, t.value, t.cover, t.weight) for t in trees])
    names, scale = list(model.names), model.margin_scale
    enc = model.pipeline.stages[0].transform(df).select(
        key, *keep, *[F.col(_ident(n)).cast("double").alias(n) for n in names])
    tree_cls, ensemble_shap = treeshap.Tree, treeshap.ensemble_shap

    def explain(batches):
        ts = [tree_cls(*parts) for parts in bc.value]
        for pdf in batches:
            x = pdf[names].to_numpy(dtype=np.float64)
            phi, base = ensemble_shap(ts, x, scale)
            res = pd.DataFrame({c: pdf[c] for c in (key, *keep)})
            res[out] = list(phi)
            res["base"] = base
            yield pd.concat([pdf[names].reset_index(drop=True), res.reset_index(drop=True)], axis=1)

    schema = (", ".join(f"{_ident(n)} double" for n in names)
              + "".join(f", {_ident(c)} {dict(enc.dtypes)[c]}" for c in (key, *keep))
              + f", {_ident(out)} array<double>, base double")
    return enc.mapInPandas(explain, schema)
