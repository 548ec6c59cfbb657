"""The whole batch job: clean, rank zones, train, evaluate, write the artefacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripline.functions.keys import content_key
from tripline.operators import bands, clean, evaluate, hotspots, model, sampling
from tripline.sources.files import literal_rows, write_records
from tripline.sources.schemas import AUDIT, FEATURES, LABEL, SAMPLES
from tripline.sources.session import remove, settle, work_folder


def run(spark: SparkSession, trips: DataFrame, key: str, out: str,
        zones: DataFrame | None = None, trees: int = model.TREES, depth: int = model.DEPTH,
        seed: int = 42, work: str | None = None) -> dict[str, str]:
    """Run over all of ``trips`` and return artefact -> path.

    The raw table is read once: the audit counts in the pass that cleans. Clean
    trips, training rows and predictions are read several times, so each is
    written once to ``work`` (else a folder in shared storage), which goes at
    the end. The split is by content: copies of a trip stay on one side.
    """
    work = work or work_folder(spark)
    paths = {name: f"{out}/{name}" for name in (
        "audit", "hotspots", "model", "metrics", "samples", "feature_importance",
        "actual_vs_predicted_line", "actual_vs_predicted_scatter")}
    try:
        rows, audit = clean.clean_observed(trips, key)
        cleaned = settle(rows, "clean", work)
        counts = tuple(audit.get[name] for name in AUDIT.fieldNames())
        write_records(literal_rows(spark, [counts], AUDIT), paths["audit"])

        ranking = (hotspots.hotspots_raw(cleaned) if zones is None
                   else hotspots.hotspots(cleaned, zones))
        write_records(ranking, paths["hotspots"])

        keyed = cleaned.withColumn("content", content_key(*FEATURES, LABEL))
        train, test = sampling.train_test_split(keyed, "content")
        fitted = model.fit(model.training_table(train, key, folder=work), trees, depth, seed)
        model.save(fitted, paths["model"])

        predictions = settle(
            model.predict(fitted, test).select(key, *FEATURES, LABEL, "prediction"),
            "predictions", work)
        write_records(evaluate.metrics_record(evaluate.regression_metrics(predictions)),
                      paths["metrics"])
        samples = bands.banded_samples(evaluate.with_abs_error(predictions), key)
        write_records(samples.orderBy("band", "rn").select(*SAMPLES.fieldNames()).coalesce(1),
                      paths["samples"])
        write_records(model.feature_importances(spark, fitted), paths["feature_importance"])
        write_records(evaluate.chart_line(predictions, key), paths["actual_vs_predicted_line"])
        write_records(evaluate.chart_scatter(predictions, key),
                      paths["actual_vs_predicted_scatter"])
    finally:
        remove(spark, work)
    return paths
