"""CSV sources and sinks for labelled samples, predictions and confusion
matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def labelled_schema(n_features: int, label_first: bool = True,
                    feature_type: T.DataType = T.DoubleType(),
                    label_type: T.DataType = T.IntegerType()) -> T.StructType:
    """Headerless sample layout ``_c0.._cN``: label first or last."""
    n = n_features + 1
    label_pos = 0 if label_first else n_features
    return T.StructType([T.StructField(f"_c{i}", label_type if i == label_pos else feature_type, True)
                         for i in range(n)])


def read_labelled_csv(spark: SparkSession, path: str, n_features: int | None = None,
                      label_first: bool = True, label_col: str = "label",
                      features_col: str = "features", keep: Sequence[str] = (),
                      label_type: T.DataType = T.IntegerType()) -> DataFrame:
    """Headerless labelled samples -> ``label, features`` (MLlib vector).

    The schema is explicit (no inference pass); without ``n_features`` the
    width is taken from the first line. A missing or non-numeric feature stops
    the job with the file that holds it.
    """
    if n_features is None:
        line = spark.read.text(path).first()
        n_features = (line["value"].count(",") if line else 0)
    raw = spark.read.option("header", False).schema(labelled_schema(n_features, label_first, label_type=label_type)).csv(path)
    cols = raw.columns
    label = cols[0] if label_first else cols[n_features]
    feats = F.array(*(cols[1:] if label_first else cols[:n_features]))
    bad = F.raise_error(F.concat(F.lit("sample with a missing or non-numeric feature in "), F.input_file_name()))
    checked = F.when(F.exists(feats, lambda x: x.isNull()), bad.cast("array<double>")).otherwise(feats)
    return raw.select(*[F.col(k) for k in keep], F.col(label).alias(label_col), array_to_vector(checked).alias(features_col))


def write_labelled_csv(df: DataFrame, label: str, features: str, path: str, label_first: bool = True,
                       n_features: int | None = None) -> None:
    """Write ``label`` + array ``features`` as headerless CSV (one column per
    feature, empty where an array is shorter). Without ``n_features`` the
    longest array sets the width, at the price of a pass over the rows."""
    n = n_features if n_features is not None else (df.agg(F.max(F.size(features))).first()[0] or 0)
    fcols = [F.get(F.col(features), i).alias(f"f{i}") for i in range(n)]
    cols = [F.col(label)] + fcols if label_first else fcols + [F.col(label)]
    df.select(*cols).write.mode("overwrite").option("header", False).csv(path)


def write_predictions(pred: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """All predictions as CSV with a header row (distributed write, no
    driver collect)."""
    out = pred.orderBy(*order) if order else pred
    out.write.mode("overwrite").option("header", True).csv(path)


def write_confusion_csv(wide: DataFrame, path: str, row_col: str = "predicted") -> None:
    """Write the wide matrix as one CSV file: a header, the predicted class
    first in every row, rows in class order. The matrix has one row per class,
    so one writer task is bounded."""
    (wide.orderBy(F.col(row_col).asc_nulls_last()).coalesce(1).select(row_col, *[c for c in wide.columns if c != row_col])
     .write.mode("overwrite").option("header", True).csv(path))


def read_confusion_csv(spark: SparkSession, path: str, prefix: str = "actual_", row_col: str = "predicted",
                       col_col: str = "actual") -> DataFrame:
    """A matrix of ``write_confusion_csv`` -> long form ``predicted, actual, n``.
    Rows and columns are known by their labels, so files may be several and
    rows in any order."""
    raw = spark.read.option("header", True).csv(path)
    cells = [F.struct(F.lit(None if c == f"{prefix}null" else int(c[len(prefix):])).cast("int").alias("a"), F.col(c).alias("v"))
             for c in raw.columns if c.startswith(prefix)]
    long = raw.select(_whole(F.col(row_col)).cast("int").alias(row_col), F.explode(F.array(*cells)).alias("c"))
    return long.select(row_col, F.col("c.a").alias(col_col), _whole(F.col("c.v")).alias("n"))


def read_plain_confusion_csv(spark: SparkSession, path: str, n_classes: int, row_col: str = "predicted",
                             col_col: str = "actual") -> DataFrame:
    """Headerless N x N matrix without labels, as other programs store it ->
    long form, counts floored to bigint. Rows are known by their place alone,
    so more than one file is refused, and so is a matrix that is not N rows."""
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(n_classes)])
    raw = spark.read.schema(schema).option("header", False).csv(path)
    if len(files := raw.inputFiles()) > 1:
        raise ValueError(f"a matrix without row labels must be one file, not {len(files)}")
    # N rows: few enough to be numbered in one task; one row more tells that there are more.
    ordered = raw.limit(n_classes + 1).coalesce(1).withColumn("_line", F.monotonically_increasing_id())
    rows = ordered.select((F.row_number().over(Window.orderBy("_line")) - 1).cast("int").alias(row_col), *raw.columns)
    if (n := rows.count()) != n_classes:
        raise ValueError(f"a {n_classes} x {n_classes} matrix has {n_classes} rows, not {'more' if n > n_classes else n}")
    long = rows.select(row_col, F.posexplode(F.array(*raw.columns)).alias("_pos", "_v"))
    return long.select(row_col, F.col("_pos").cast("int").alias(col_col), _whole(F.col("_v")).alias("n"))


def _whole(text: Column) -> Column:
    return F.floor(text.cast("double")).cast("bigint")
