"""The full model: features of E23, weighted forest, stored scores (M1-M4)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators import encoding, modeling, treetable
from creditloom.operators.cleaning import apply_fill, fit_median
from creditloom.plans import master
from creditloom.plans.blocks import KEY
from creditloom.plans.fixtures import view
from creditloom.shared import shared_folder


@dataclass(frozen=True)
class StoredForest:
    """A trained model with its held-out scores, all below one shared folder."""

    spark: SparkSession
    path: str
    columns: tuple[str, ...]
    params: modeling.ForestParams

    @property
    def model(self) -> RandomForestClassificationModel:
        return RandomForestClassificationModel.load(f"{self.path}/model")

    @property
    def nodes(self) -> DataFrame:
        return treetable.node_table(self.spark, f"{self.path}/model")

    @property
    def scored(self) -> DataFrame:
        """``key, target, label, p, prediction, values`` of the held-out rows."""
        return self.spark.read.parquet(f"{self.path}/scored")


def train(features: DataFrame, folder: str, params: modeling.ForestParams = modeling.ForestParams(), fraction: float = 0.8) -> StoredForest:
    """Split, weigh, fit and score once; queries read what is stored.

    Medians that fill nulls and the class weights come from the training rows.
    """
    spark = features.sparkSession
    path = f"{folder.rstrip('/')}/forest-{uuid.uuid4().hex}"
    cols = modeling.feature_columns(features)
    rows = features.select(KEY, "target", F.col("target").cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in cols])
    # both sides are read below, one several times; the features behind them are made once
    rows.write.parquet(f"{path}/rows")
    fit_rows, test = encoding.hash_split(spark.read.parquet(f"{path}/rows"), KEY, fraction, method="md5")
    medians = fit_median(fit_rows, cols)
    weights = encoding.fit_class_weights(fit_rows)

    def vectors(df: DataFrame) -> DataFrame:
        return modeling.assemble(apply_fill(df, medians), cols, "zero")

    weighted = encoding.class_weights(vectors(fit_rows), "label", weights)
    model = modeling.fit_forest(weighted, params, weight="class_weight", key=KEY)
    treetable.save_forest(model, f"{path}/model")
    p = F.get(vector_to_array("probability"), F.lit(1)).alias("p")
    scored = model.transform(vectors(test)).select(KEY, "target", "label", p, "prediction", vector_to_array("features").alias("values"))
    scored.write.parquet(f"{path}/scored")
    return StoredForest(spark, path, tuple(cols), params)


#: Models of this session by data folder, so that several reports share one.
_stored: dict[tuple[str, str], StoredForest] = {}


def forget() -> None:
    """Train again when next asked; what is stored stays."""
    _stored.clear()


def forest_of(spark: SparkSession, sf_dir: str, params: modeling.ForestParams = modeling.ForestParams()) -> StoredForest:
    """The full model of the tables in a folder, trained once per session."""
    at = (spark.sparkContext.applicationId, f"{sf_dir}:{params}")
    if at not in _stored:
        features = master.model_features(
            view(spark, sf_dir, "fx_application"), view(spark, sf_dir, "fx_previous"), view(spark, sf_dir, "fx_installments"),
            categories=["name_client_type", "name_contract_status"],
        )
        _stored[at] = train(features, shared_folder(spark), params)
    return _stored[at]
