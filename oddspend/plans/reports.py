"""The reports of a run, as written tables."""

from pyspark.sql import DataFrame

from oddspend.operators import evaluate as A, profile as V
from oddspend.plans import scoring as P
from oddspend.sources import writers


def write_reports(folder: str, raw: DataFrame, models: dict, test_rows: DataFrame) -> dict[str, str]:
    """Writes profile, metrics, curves, timings and recommendation as JSON and the
    comparison table as CSV; returns the path of each. Scores are computed once."""
    scores, timings = P.long_scores(models, test_rows)
    table = A.model_table(A.evaluate_models(scores, timings))
    found = {
        "validation": V.report(raw), "training_times": P.training_report(models, raw.sparkSession), "metrics": table,
        "roc_curve": A.roc_curve(scores), "pr_curve": A.pr_curve(scores), "recommendation": A.recommend(table),
    }
    paths = {name: writers.write_json(df, f"{folder}/{name}.json") for name, df in found.items()}
    return paths | {"model_comparison": writers.write_csv(table, f"{folder}/model_comparison.csv")}
