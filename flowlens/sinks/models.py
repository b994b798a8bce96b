"""Fitted models beside the results of their run.

A model is saved to a folder of its own and then named by the manifest of its run, by the value it was fitted for, so
readers never see half of one and a rerun replaces it.  A later job loads the newest model (or
that of one run) and labels new rows with it, without fitting again.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from flowlens.sinks.manifests import Manifests


class ModelStore:
    """The models at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.manifests = spark, Manifests(spark, path)

    def save(self, model: PipelineModel | None, value: str, run_id: int) -> None:
        """Keep ``model`` as that of (value, run); None: the run has no model for the value."""
        folder = f"{self.manifests.new_attempt()}/model"
        if model is not None:
            model.write().save(f"{self.manifests.path}/{folder}")

        def change(content: dict) -> dict:
            kept = {k: v for k, v in content["kinds"].items() if k != value}
            return {"kinds": kept if model is None else kept | {value: {"folder": folder}}}

        self.manifests.update(f"RUN_ID={run_id}", change)

    def load(self, value: str, run_id: int | str = "latest") -> PipelineModel:
        """The model of (value, run); ``"latest"``: of the newest run that has one for the value."""
        runs = sorted((int(r.split("=")[1]) for r in self.manifests.runs()), reverse=True)
        for run in runs if run_id == "latest" else [int(run_id)]:
            kinds = self.manifests.newest(f"RUN_ID={run}")[1]["kinds"]
            if value in kinds:
                return PipelineModel.load(f"{self.manifests.path}/{kinds[value]['folder']}")
        raise ValueError(f"no model for {value!r} at {self.manifests.path} (run {run_id})")
