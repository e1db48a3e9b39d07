"""Writing tables, scored rows and small reports as distributed folders."""

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def scored_path(source: str, model: str) -> str:
    """Default output name of scored rows: <source stem>_<model>_scored.csv."""
    folder, _, name = source.rstrip("/").rpartition("/")
    stem = name.rsplit(".", 1)[0] if "." in name else name
    return f"{folder + '/' if folder else ''}{stem}_{model}_scored.csv"
