"""Readers, writers and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskweft.sources.contract import FEATURES, LABEL, MIN_FEATURES, MIN_ROWS, ROW_ID

FORMATS = ("parquet", "csv", "json", "orc")
# Accepted spellings of the two classes.
POSITIVE = ("1", "true", "yes")
NEGATIVE = ("0", "false", "no")


def risk_schema(label_type: str = "int") -> T.StructType:
    """Explicit schema of the wide risk table, so that reading text needs no inference pass."""
    integers = {f"X{i}" for i in range(2, 12)}
    return T.StructType([
        T.StructField(ROW_ID, T.LongType()),
        *[T.StructField(c, T.IntegerType() if c in integers else T.DoubleType()) for c in FEATURES],
        T.StructField(LABEL, T.StringType() if label_type == "string" else T.IntegerType()),
    ])


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None) -> DataFrame:
    """Read a table and turn NaN into null, so that missing has one form."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.load(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def binary_label(label: Column, dtype: T.DataType) -> Column:
    """0/1 from booleans, numbers (truncated towards 0) or text; null where it cannot be mapped."""
    if isinstance(dtype, T.BooleanType):
        return label.cast("int")
    if isinstance(dtype, T.NumericType):
        return label.try_cast("int")
    text = F.lower(F.trim(label.cast("string")))
    return F.when(text.isin(*POSITIVE), 1).when(text.isin(*NEGATIVE), 0)


def normalize_label(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Replace the label by 0/1 after one validating aggregate."""
    value = binary_label(F.col(label), df.schema[label].dataType)
    missing = F.col(label).isNull()
    if isinstance(df.schema[label].dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(label)
    checks = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("missing"), F.count_if(~missing & value.isNull()).alias("unmapped"),
        F.min(value).alias("low"), F.max(value).alias("high"), F.count_if(~value.isin(0, 1)).alias("other"),
    ).first()
    if checks["n"] == checks["missing"]:
        raise ValueError("label cannot be empty")
    if checks["missing"]:
        raise ValueError("label contains missing values")
    if checks["unmapped"]:
        raise ValueError("label must be binary and explicitly mappable to 0/1")
    if checks["other"] or (checks["low"], checks["high"]) != (0, 1):
        raise ValueError(f"label must be binary 0/1, got values from {checks['low']} to {checks['high']}")
    return df.withColumn(label, value)


def load_risk_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None, label: str = LABEL,
    key: str = ROW_ID, min_rows: int = MIN_ROWS, min_features: int = MIN_FEATURES,
) -> DataFrame:
    """Features and label in one table: size and label are checked, the label becomes 0/1."""
    df = read_table(spark, path, fmt, schema)
    if label not in df.columns:
        raise ValueError(f"label column {label!r} not found")
    features = [c for c in df.columns if c not in (label, key)]
    if len(features) < min_features:
        raise ValueError(f"unexpectedly small feature set: {len(features)} features")
    rows = df.count()
    if rows < min_rows:
        raise ValueError(f"unexpectedly small dataset: {rows} rows")
    return normalize_label(df, label)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def json_ready(df: DataFrame) -> DataFrame:
    """NaN and infinities to null, the only spelling JSON has for them."""
    out = []
    for f in df.schema.fields:
        col = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            col = F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)
        out.append(col.alias(f.name))
    return df.select(*out)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row; null fields are written, not dropped."""
    ready = json_ready(df)
    ready.select(F.to_json(F.struct(*ready.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.text(path).select(F.from_json("value", schema).alias("r")).select("r.*")


def with_parameters(df: DataFrame, column: str = "hyperparameters") -> DataFrame:
    """Parse a JSON text column of parameters into a map."""
    return df.withColumn(column, F.from_json(column, "map<string,string>"))


def prediction_table(df: DataFrame, threshold: float, key: str = ROW_ID, label: str = "label", score: str = "score") -> DataFrame:
    return df.select(
        F.col(key).alias("row_identifier"), F.col(label).cast("int").alias("y_true"), F.col(score).alias("probability_default_1"),
        F.lit(float(threshold)).alias("frozen_threshold"), (F.col(score) >= F.lit(float(threshold))).cast("int").alias("y_pred"),
    )


def write_manifest(df: DataFrame, path: str, key: str = ROW_ID, split: str = "split") -> None:
    """Keys of the train and validation rows; test is what is left."""
    df.where(F.col(split).isin("train", "validation")).select(key, split).write.mode("overwrite").partitionBy(split).parquet(path)


def read_manifest(spark: SparkSession, path: str, key: str = ROW_ID) -> DataFrame:
    return spark.read.schema(f"{key} bigint, split string").parquet(path).select(key, "split")


def apply_manifest(df: DataFrame, manifest: DataFrame, key: str = ROW_ID) -> DataFrame:
    """Add the split of every row; rows the manifest does not name are test rows."""
    return df.join(manifest, key, "left").withColumn("split", F.coalesce("split", F.lit("test")))


def manifest_differences(df: DataFrame, manifest: DataFrame, key: str = ROW_ID, split: str = "split") -> DataFrame:
    """One row: memberships missing on either side, keys named more than once, and the split sizes.

    One full join on the key shows all of it.
    """
    actual = df.select(key, F.col(split).alias("actual"))
    named = manifest.groupBy(key).agg(F.min("split").alias("low"), F.max("split").alias("high"), F.count(F.lit(1)).alias("times"))
    both = actual.join(named, key, "full")
    expected = F.col("low").isNotNull() & F.col("actual").isNotNull()
    return both.agg(
        F.count_if(F.col("low").isNotNull() & ~F.col("actual").eqNullSafe(F.col("low"))).alias("manifest_only"),
        F.count_if(F.col("actual").isin("train", "validation") & F.col("low").isNull()).alias("table_only"),
        F.count_if((F.col("times") > 1) | (F.col("low") != F.col("high"))).alias("overlaps"),
        F.count_if(expected & (F.col("actual") == "train")).alias("train_rows"),
        F.count_if(expected & (F.col("actual") == "validation")).alias("validation_rows"),
        F.count_if(F.col("low").isNull() & (F.col("actual") == "test")).alias("test_rows"),
    )


def check_manifest(df: DataFrame, manifest: DataFrame, key: str = ROW_ID, split: str = "split") -> dict[str, int]:
    row = manifest_differences(df, manifest, key, split).first().asDict()
    if row["overlaps"]:
        raise ValueError("splits of the manifest overlap")
    if row["manifest_only"] or row["table_only"]:
        raise ValueError("manifest and table disagree on split membership")
    return {k: row[k] for k in ("train_rows", "validation_rows", "test_rows")}


class FoldStore:
    """Finished folds on shared storage: a fold is one partition directory, written once.

    The rows of a fold become visible together when its write commits, so a job
    that dies in between leaves only whole folds behind and resumes after them.
    """

    COLUMNS = f"{ROW_ID} bigint, label int, score double, auc double, f1_binary double, elapsed_seconds double, fold int"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fold_path(self, fold: int) -> str:
        return f"{self.path}/fold={fold}"

    def finished(self) -> set[int]:
        """Folds whose write has committed: their folders hold the commit's marker. No rows are read."""
        jvm = self.spark._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path}/fold=*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).globStatus(pattern)
        return {int(status.getPath().getParent().getName().removeprefix("fold=")) for status in found or ()}

    def save(self, fold: int, df: DataFrame) -> None:
        df.drop("fold").write.mode("overwrite").parquet(self._fold_path(fold))

    def load(self) -> DataFrame:
        return self.spark.read.schema(self.COLUMNS).parquet(self.path)
