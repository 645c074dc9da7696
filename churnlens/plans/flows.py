"""End-to-end flows: segmentation (E1), logistic churn model (E2), boosted
trees with explanations (E3).

Each flow stores its working table once in the shared folder, because every fit
reads it many times.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators import boosting, clean, encode, explain, folds, metrics, models, segment, split
from churnlens.operators.blocks import loaded
from churnlens.schema import (GBTConfig, LogisticConfig, SegmentConfig, SplitConfig,
                              SubscriberColumns)
from churnlens.session import ensure_checkpoint_dir, materialize
from churnlens.sources import steps
from churnlens.sources.model_store import read_model, save_model


@dataclass
class SegmentationResult:
    sweep: DataFrame
    segmented: DataFrame        # input rows + segment_id (stored)
    profile: DataFrame
    personas: DataFrame
    points: DataFrame           # key, segment_id, pc1, pc2
    shares: DataFrame           # component, share of the variance
    fit: segment.SegmentFit
    model: PipelineModel        # input rows -> segment_id, for new customers


def segmentation(df: DataFrame, cols: SubscriberColumns, cfg: SegmentConfig = SegmentConfig(),
                 k: int | None = None) -> SegmentationResult:
    """Encode, standardise (population std), sweep k, attach canonical ids, project, profile.

    With ``k`` given the sweep is left out and its table has one row.  The
    fitted steps are one pipeline (encoding with the scaler's constants,
    assembly, nearest centre, canonical ids), which ``save_segments`` stores.
    """
    spec = encode.fit_cluster_features(df, cols)
    scaler = encode.fit_standard_scaler(spec.transform(df), list(spec.names))
    steps = [SQLTransformer(statement=models.encoding_sql(spec, scaler)),
             VectorAssembler(inputCols=[n + models.Z for n in spec.names], outputCol="features", handleInvalid="error")]
    encoder = PipelineModel(stages=steps)
    feats = materialize(encoder.transform(df), "segment-features")
    if k is None:
        sweep, best = segment.sweep_k(feats, cfg.k_values, cfg.n_init, cfg.seed, cfg.max_iter, cfg.tol)
    else:
        sweep, best = segment.sweep_k(feats, (k,), cfg.n_init, cfg.seed, cfg.max_iter, cfg.tol)
    nearest = SQLTransformer(statement=f"SELECT *, {best.sql([n + models.Z for n in spec.names])} AS cluster FROM __THIS__")
    clustered = materialize(nearest.transform(feats).select(*df.columns, "features", "cluster"), "segment-clusters")
    ids = {r["cluster"]: r["segment_id"] for r in segment.canonical_order(clustered, "cluster", cols.label).collect()}
    case = " ".join(f"WHEN {c} THEN {i}" for c, i in sorted(ids.items()))  # k entries
    naming = SQLTransformer(statement=f"SELECT *, CAST(CASE cluster {case} END AS INT) AS segment_id FROM __THIS__")
    named = naming.transform(clustered)
    segmented = named.select(*df.columns, "segment_id")
    points, shares = segment.project_2d(named, "features", cols.key, ["segment_id"])
    shares = df.sparkSession.createDataFrame([(i + 1, x) for i, x in enumerate(shares)], "component int, share double")
    prof = segment.profile_segments(segmented, "segment_id", cols.tenure, cols.monthly, cols.total,
                                    cols.senior, cols.label)
    return SegmentationResult(sweep, segmented, prof, segment.assign_personas(prof), points, shares, best,
                              PipelineModel(stages=[*steps, nearest, naming]))


def save_segments(result: SegmentationResult, path: str) -> None:
    """Store the segmentation pipeline: scaler, k-means centres and segment names."""
    result.model.write().overwrite().save(path)


def assign_stored_segments(df: DataFrame, path: str) -> DataFrame:
    """Put (new) customers into stored segments: ``df`` + segment_id."""
    return PipelineModel.load(path).transform(df).select(*df.columns, "segment_id")


@dataclass
class ModelRun:
    spec: encode.FeatureSpec
    data: DataFrame             # input rows + is_test (stored)
    train: DataFrame
    test: DataFrame


def prepare(df: DataFrame, cols: SubscriberColumns, cfg: SplitConfig = SplitConfig()) -> ModelRun:
    spec = encode.fit_model_features(df, cols)
    data = materialize(split.stratified_split(df, cols.label, cols.key, cfg.test_fraction, cfg.seed), "model-data")
    return ModelRun(spec, data, data.where("is_test = 0").drop("is_test"),
                    data.where("is_test = 1").drop("is_test"))


def logistic_models(run: ModelRun, cols: SubscriberColumns):
    """Model A (no penalty) and model B (L2, C=0.1), both balanced."""
    a = models.fit_logistic(run.train, run.spec, cols.label, LogisticConfig(c=1e9))
    b = models.fit_logistic(run.train, run.spec, cols.label, LogisticConfig(c=0.1))
    return a, b


def scored_test(model: models.ChurnModel, run: ModelRun, cols: SubscriberColumns) -> DataFrame:
    return model.score(run.test).select(cols.key, cols.label, "prob", "prediction")


def gbt_model(run: ModelRun, cols: SubscriberColumns, cfg: GBTConfig = GBTConfig()) -> boosting.BoostedModel:
    return models.fit_boosted(run.train, run.spec, cols.label, cfg)


def gbt_explanations(model: boosting.BoostedModel, run: ModelRun, cols: SubscriberColumns) -> DataFrame:
    """Long ``(key, feature, value, shap)`` for every test row (M21, M23 input).

    Stored, so importance, cloud and checks read one computation.
    """
    ckpt = ensure_checkpoint_dir(run.data.sparkSession)
    sv = models.shap_values(model, run.test, cols.key, ckpt)
    return materialize(explain.to_long(sv, cols.key, list(model.names)), "contributions")


@dataclass
class CrossValidation:
    folds: DataFrame                # model, fold, auc
    scores: DataFrame               # model, fold, label, score of every training row (stored)
    trees: boosting.BoostedModel    # fitted on all training rows in the same scans


def cross_validate(run: ModelRun, cols: SubscriberColumns, gbt_cfg: GBTConfig = GBTConfig(),
                   split_cfg: SplitConfig = SplitConfig()) -> CrossValidation:
    """Both logistic models and the trees on stratified folds of the training rows.

    One stored table of blocks serves the Newton steps of all logistic fits and
    the histogram scans of all trees, those of the final model included.
    """
    n = split_cfg.n_folds
    folded = materialize(split.assign_folds(run.train, cols.label, cols.key, n, split_cfg.seed), "folds")
    pipeline, names = models.feature_pipeline(run.spec), run.spec.names
    encoded = pipeline.transform(folded)
    table = boosting.training_blocks(encoded, names, cols.label, "fold")
    blocks = loaded(table)
    try:
        fits = folds.fit_logistic_folds(blocks, {"baseline": 1e9, "ridge": LogisticConfig().c}, n)
        trees = boosting.fit_trees(blocks, boosting.fit_bins(encoded, names, gbt_cfg.bins), n, gbt_cfg)
    finally:
        blocks.unpersist()
    scores = folds.held_out_scores(table, fits | {("gbt", f): t for f, t in enumerate(trees[1:])})
    return CrossValidation(folds.fold_auc(scores), scores, boosting.BoostedModel(pipeline, names, cols.label, trees[0]))


def scored_by(run: ModelRun, cols: SubscriberColumns, **fitted: models.ChurnModel | boosting.BoostedModel) -> DataFrame:
    """Test rows scored by several models: key, label, prob_<name>, pred_<name>."""
    df, out = run.test, []
    for name, m in fitted.items():
        df = m.score(df, f"prob_{name}", f"pred_{name}")
        out += [f"prob_{name}", f"pred_{name}"]
    return df.select(cols.key, cols.label, *out)


def model_columns(*names: str) -> dict[str, tuple[str, str]]:
    """The (prediction, score) columns that ``scored_by`` gives each model."""
    return {n: (f"pred_{n}", f"prob_{n}") for n in names}


def compare(lin: models.ChurnModel, trees: boosting.BoostedModel, run: ModelRun,
            cols: SubscriberColumns) -> DataFrame:
    scored = scored_by(run, cols, logistic=lin, gbt=trees)
    table = metrics.metric_tables(scored, cols.label, model_columns("logistic", "gbt"))
    return metrics.compare_models(table, "logistic", "gbt")


def segment_risk(model: models.ChurnModel, segmented: DataFrame, cols: SubscriberColumns,
                 segment_col: str = "segment_id") -> DataFrame:
    """Actual vs predicted churn per segment on the segmented table."""
    scored = model.score(segmented)
    return metrics.calibration_by(scored, segment_col, cols.label, "prob")


def explain_examples(model: boosting.BoostedModel, run: ModelRun, cols: SubscriberColumns,
                     k: int = 12) -> DataFrame:
    """T6's two customers, picked on the scored rows; only they are explained."""
    ckpt = ensure_checkpoint_dir(run.data.sparkSession)
    two = explain.example_rows(model.score(run.test), cols.key, "prob")
    sv = models.shap_values(model, two, cols.key, ckpt, keep=("prob", "kind"))
    return sv.select(cols.key, "kind", "prob", explain.top_in_row(list(model.names), "shap", k).alias("top"))


def coefficient_table(model: models.ChurnModel, top: int = 20) -> DataFrame:
    coefs = models.coefficients(model).where(F.col("feature") != "(intercept)")
    return explain.top_abs(coefs, "coefficient", top, tie="feature")


# --- stored steps: a later run starts from what is there ----------------------

def store_segmentation(result: SegmentationResult, root: str, source: str) -> str:
    """Segmented table, sweep and the segmentation pipeline as one step."""
    spark = result.segmented.sparkSession
    return steps.write_step(spark, root, "segmentation", source, {"segmented": result.segmented, "sweep": result.sweep},
                            {"pipeline": lambda path: save_segments(result, path)})


def store_models(run: ModelRun, fitted: dict[str, models.ChurnModel | boosting.BoostedModel], root: str, source: str) -> str:
    """The split table and the fitted models as one step."""
    return steps.write_step(run.data.sparkSession, root, "models", source, {"data": run.data},
                            {n: (lambda path, m=m: save_model(m, path)) for n, m in fitted.items()})


def resume_models(spark, root: str, source: str | None = None):
    """``(split table, {name: model})`` of a stored models step; None if it is not there."""
    step = steps.read_step(spark, root, "models", source)
    if step is None:
        return None
    return step.tables["data"], {n: read_model(f"{step.path}/artefacts/{n}") for n in step.artefacts}


def resume_segmented(spark, root: str, cols: SubscriberColumns, source: str | None = None) -> DataFrame | None:
    """The stored segmented table, its total coerced and rows without one dropped (S2); None if it is not there."""
    step = steps.read_step(spark, root, "segmentation", source)
    if step is None:
        return None
    return clean.drop_missing(clean.coerce_numeric(step.tables["segmented"], cols.total), [cols.total], "resumed")[0]


def resumed_risk(spark, root: str, cols: SubscriberColumns, model: str = "logistic",
                 source: str | None = None) -> DataFrame | None:
    """Risk per segment from stored segments and a stored model; skipped (None, a warning) if either is absent."""
    found, segmented = resume_models(spark, root, source), resume_segmented(spark, root, cols, source)
    if found is None or segmented is None or model not in found[1]:
        return None
    return segment_risk(found[1][model], segmented, cols)


def resumed_comparison(spark, root: str, cols: SubscriberColumns, source: str | None = None) -> DataFrame | None:
    """Stored logistic model against the stored trees on the stored test rows; skipped if a model is absent."""
    found = resume_models(spark, root, source)
    if found is None or not {"logistic", "gbt"} <= set(found[1]):
        return None
    test = found[0].where("is_test = 1")
    columns, scored = model_columns("logistic", "gbt"), test
    for name in columns:
        scored = found[1][name].score(scored, f"prob_{name}", f"pred_{name}")
    return metrics.compare_models(metrics.metric_tables(scored, cols.label, columns), "logistic", "gbt")
