"""Reading transaction tables: batch CSV / Parquet and a CSV stream."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from oddspend import schema as S
from oddspend.functions.sampling import head_rows, sample_users


def read_csv(spark: SparkSession, path: str, sample_frac: float | None = None, nrows: int | None = None,
             seed: int = 42, corrupt: bool = False) -> DataFrame:
    """The 15 declared columns in order plus row_id (position in the scan).

    sample_frac keeps whole histories of that share of users; nrows keeps the
    first rows. A missing path, a missing column or an empty table raises; new rows
    may come without the label, which is null then. corrupt keeps, for lines that do
    not fit the schema, the line in _corrupt_record."""
    try:
        head = spark.read.option("header", True).csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(path) from e
        raise
    absent = [c for c in S.RAW_COLUMNS if c not in head.columns and c != S.LABEL_RAW]
    if absent:
        raise S.SchemaValidationError(f"missing columns: {absent}")
    kinds = {f.name: f.dataType for f in S.RAW_SCHEMA}
    typed = ", ".join(f"`{c}` {kinds[c].simpleString() if c in kinds else 'string'}" for c in head.columns)
    record = "_corrupt_record"
    reader = spark.read.schema(typed + f", {record} string" * corrupt).option("header", True)
    df = reader.option("columnNameOfCorruptRecord", record).csv(path)
    if S.LABEL_RAW not in head.columns:
        df = df.withColumn(S.LABEL_RAW, F.lit(None).cast("string"))
    df = df.select(*[F.col(f"`{c}`") for c in S.RAW_COLUMNS], *[record] * corrupt).withColumn(S.ROW_ID, F.monotonically_increasing_id())
    if df.isEmpty():
        raise ValueError(f"no rows in {path}")
    if sample_frac is not None and sample_frac < 1:
        df = sample_users(df, S.USER, sample_frac, seed)
    return df if nrows is None else head_rows(df, nrows, S.ROW_ID)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(path) from e
        raise


def stream_csv(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """Raw rows of CSV files arriving in a folder, a few files per micro-batch."""
    return spark.readStream.schema(S.RAW_SCHEMA).option("header", True).option(
        "maxFilesPerTrigger", files_per_trigger).csv(folder)
