"""Risk models (MLlib pipelines and boosted trees of this package), and their registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.operators.boosting import BoostedModel, Boosting
from velora.sources.objects import ObjectStore

FEATURES = ("trips", "dist_km", "instant_ret", "fail_150d", "days_since_fail", "days_since_last_rent", "trend_ratio")
HISTORY = 50


class BoostedCandidate:
    """The boosted trees as a candidate like the pipelines: ``fit`` gives the model."""

    def __init__(self, features: Sequence[str], params: Boosting):
        self.features, self.params = list(features), params

    def fit(self, df: DataFrame) -> BoostedModel:
        return self.params.fit(df, self.features)


def candidates(features: Sequence[str] = FEATURES, seed: int = 42, **boosting) -> dict[str, Pipeline | BoostedCandidate]:
    """Logistic regression on scaled features, MLlib's boosted trees, and leaf-wise boosted trees (``boosting`` sets their
    parameters), which take NULL as a value of its own."""
    raw = VectorAssembler(inputCols=list(features), outputCol="raw", handleInvalid="keep")
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True)
    return {
        "logreg": Pipeline(stages=[raw, scaler, LogisticRegression(featuresCol="scaled", labelCol="label", maxIter=200)]),
        "gbt": Pipeline(stages=[raw, GBTClassifier(featuresCol="raw", labelCol="label", maxIter=60, maxDepth=4, seed=seed)]),
        "boosted": BoostedCandidate(features, Boosting(**({"seed": seed} | boosting))),
    }


def score(model: PipelineModel | BoostedModel | str, df: DataFrame) -> DataFrame:
    """``score``: the positive class's probability; the rule scores by trips."""
    if model == "rule_trips":
        return df.withColumn("score", F.col("trips").cast("double"))
    if isinstance(model, BoostedModel):
        return model.score(df)
    out = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    return out.select(*df.columns, "score")


def risk_scores(scored: DataFrame) -> DataFrame:
    """Percent with three decimals, halves to even."""
    return scored.withColumn("risk_score", F.bround(F.col("score") * 100, 3))


def importances(model: PipelineModel | BoostedModel, features: Sequence[str] = FEATURES) -> dict[str, float]:
    if isinstance(model, BoostedModel):
        return model.importances()
    last = model.stages[-1]
    values = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    return dict(zip(features, values.toArray().tolist(), strict=True))


class Registry:
    """The champion pointer with a capped history, beside the saved models."""

    def __init__(self, store: ObjectStore):
        self.store = store

    def champion(self) -> dict | None:
        return self.store.get_json("champion.json")

    def register(self, version: str, model: PipelineModel | BoostedModel | None, metrics: dict, features: Sequence[str] = FEATURES) -> None:
        if isinstance(model, BoostedModel):
            self.store.put_text(f"models/{version}.boosted.json", model.to_json())
        elif model is not None:
            model.write().overwrite().save(f"{self.store.root}/models/{version}")
        self.store.put_json(f"models/{version}.metrics.json", {"version": version, "metrics": metrics, "features": list(features)})

    def promote(self, version: str) -> None:
        doc, old = self.store.get_json(f"models/{version}.metrics.json"), self.champion()
        if doc is None:
            raise ValueError(f"version {version} is not registered")
        history = ([{k: v for k, v in old.items() if k != "history"}] + old.get("history", []))[:HISTORY] if old else []
        self.store.put_json("champion.json", doc | {"history": history})

    def load(self, version: str) -> PipelineModel | BoostedModel:
        boosted = self.store.get_text(f"models/{version}.boosted.json")
        if boosted is not None:
            return BoostedModel.from_json(boosted)
        return PipelineModel.load(f"{self.store.root}/models/{version}")
