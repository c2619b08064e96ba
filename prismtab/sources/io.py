"""Scans, sources and sinks (A-01..A-10).

Inputs are read with explicit schemas (no inference), column selections are
pushed into the scan by Catalyst, and every writer refuses to overwrite
unless asked.  Outputs are keyed by id: nothing depends on row order.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.constants import CLASSES, ID_COL, LABEL_COL
from prismtab.functions.proba import block_columns, detect_prefix, normalize
from prismtab.operators.checks import ContractError, check_class_domain, check_complete, require_columns

# fixed values: the observation schema of the workflow's input files
OBS_FIELDS = [
    ("id", T.LongType()), ("alpha", T.DoubleType()), ("delta", T.DoubleType()), ("u", T.DoubleType()),
    ("g", T.DoubleType()), ("r", T.DoubleType()), ("i", T.DoubleType()), ("z", T.DoubleType()),
    ("redshift", T.DoubleType()), ("spectral_type", T.StringType()), ("galaxy_population", T.StringType()),
]
TRAIN_SCHEMA = T.StructType([T.StructField(n, t) for n, t in OBS_FIELDS] + [T.StructField("class", T.StringType())])
TEST_SCHEMA = T.StructType([T.StructField(n, t) for n, t in OBS_FIELDS])
PRED_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("class", T.StringType())])


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of the store that the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in any store that Spark reads."""
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path (none if it does not exist)."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists.  Of several callers one gets True."""
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p.getParent())
    try:
        if fs.getScheme() == "file":  # the local file system of Hadoop looks first and creates then
            jvm, attributes = spark._jvm, spark.sparkContext._gateway.new_array(spark._jvm.java.nio.file.attribute.FileAttribute, 0)
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(p.toUri().getPath()).toPath(), attributes)
        else:
            fs.create(p, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def _is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def _join(directory: str, name: str) -> str:
    return f"{directory.rstrip('/')}/{name}"


def _read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    if path.endswith(".parquet") or not path.endswith(".csv") and _is_folder(spark, path):
        df = spark.read.parquet(path)
        return df if schema is None else df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields
                                                      if f.name in df.columns])
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_inputs(spark: SparkSession, directory: str, fmt: str = "csv"):
    """A-01: the three-file contract train / test / sample_submission; a
    missing file is an error."""
    names = {"train": TRAIN_SCHEMA, "test": TEST_SCHEMA, "sample_submission": PRED_SCHEMA}
    out = []
    for name, schema in names.items():
        path = _join(directory, f"{name}.{fmt}")
        if not path_exists(spark, path):
            raise FileNotFoundError(f"Missing input file: {path}")
        out.append(_read(spark, path, schema))
    return tuple(out)


def validate_inputs(train: DataFrame, test: DataFrame, sample: DataFrame, target: str = LABEL_COL,
                    id_col: str = ID_COL) -> dict:
    """A-02: target and id present; test and sample row counts equal (one
    aggregate each)."""
    require_columns(train, [id_col, target], "train")
    require_columns(test, [id_col], "test")
    require_columns(sample, [id_col], "sample")
    n_test, n_sample = test.count(), sample.count()
    if n_test != n_sample:
        raise ContractError(f"test has {n_test} rows but sample submission has {n_sample}")
    return {"test_rows": n_test, "sample_rows": n_sample}


def read_columns(spark: SparkSession, path: str, cols) -> DataFrame:
    """A-03: column-pruned read (list or predicate over column names); the
    projection reaches the scan (``ReadSchema``)."""
    df = _read(spark, path)
    keep = [c for c in df.columns if (cols(c) if callable(cols) else c in set(cols))]
    return df.select(*keep)


def read_oof_run(spark: SparkSession, run_dir: str, fmt: str = "parquet"):
    """A-04: (train, test, scores) of one OOF run; missing scores → empty typed frame."""
    train = _read(spark, _join(run_dir, f"oof_train.{fmt}"))
    test = _read(spark, _join(run_dir, f"oof_test.{fmt}"))
    sp = _join(run_dir, f"scores.{fmt}")
    scores = _read(spark, sp) if path_exists(spark, sp) else spark.createDataFrame([], SCORES_SCHEMA)
    return train, test, scores


SCORES_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType()), T.StructField("model_type", T.StringType()),
    T.StructField("feature_set", T.StringType()), T.StructField("seed", T.IntegerType()),
    T.StructField("fold", T.StringType()), T.StructField("accuracy", T.DoubleType()),
    T.StructField("balanced_accuracy", T.DoubleType()), T.StructField("log_loss", T.DoubleType()),
    T.StructField("fit_predict_seconds", T.DoubleType()), T.StructField("best_iteration", T.IntegerType()),
])


def prediction_table(df: DataFrame, pred_col: str, id_col: str = ID_COL, label_col: str = LABEL_COL,
                     classes=CLASSES, check: bool = True) -> DataFrame:
    """A-05: select id + label renamed to ``pred_col``; unknown classes → error."""
    require_columns(df, [id_col, label_col], "prediction")
    out = df.select(F.col(id_col), F.col(label_col).cast("string").alias(pred_col))
    return check_class_domain(out, pred_col, classes) if check else out


def optional_frame(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    """A-06: an optional input: absent → empty frame of the given schema."""
    if path and path_exists(spark, path):
        return _read(spark, path, schema)
    return spark.createDataFrame([], schema)


def load_proba(df: DataFrame, prefix: str = "auto", out_prefix: str = "stack_p", classes=CLASSES,
               id_col: str = ID_COL) -> DataFrame:
    """A-07: pick one probability block (auto-detected when exactly one
    prefix covers all classes) → normalised ``<out_prefix>_<CLASS>`` columns."""
    p = detect_prefix(df.columns, classes, prefix)
    cols = block_columns(p, classes)
    require_columns(df, cols, "probability table")
    normed = normalize(cols)
    keep = [c for c in (id_col, LABEL_COL) if c in df.columns]
    return df.select(*keep, *[x.alias(f"{out_prefix}_{c}") for x, c in zip(normed, classes)])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                partition_by=None) -> None:
    """A-08/A-09: probability / score / audit tables; never silently overwrite."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def write_experiments(df: DataFrame, path: str, experiment: str = "experiment", fmt: str = "parquet") -> None:
    """A-08: probability tables below one folder, a partition per experiment.

    Only the partitions of the experiments in ``df`` are replaced; others stay.  A rerun of one experiment is one write."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(experiment).format(fmt).save(path)


#: buckets of a stored prediction table
BUCKETS = 64


def store_bucketed(df: DataFrame, path: str, key: str = ID_COL, buckets: int = BUCKETS) -> DataFrame:
    """D-04: ``df`` stored below ``path`` in ``buckets`` files by ``key``, each sorted by it.

    Tables of equal key and number of buckets join without an exchange.  The session's catalog knows the
    table by a name of its own; the files are an ordinary Parquet folder."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    spread = df.repartition(buckets, key)  # a file per bucket
    spread.write.option("path", path).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
    return spark.table(name)


def submission(sample: DataFrame, pred: DataFrame, id_col: str = ID_COL, label_col: str = LABEL_COL,
               check: bool = True) -> DataFrame:
    """A-10: keyed submission: the sample's ids left-joined with predictions;
    any id without a prediction is an error (checked with one aggregate)."""
    out = sample.select(id_col).join(pred.select(id_col, label_col), id_col, "left")
    return check_complete(out, [label_col], "submission") if check else out


def write_sorted(df: DataFrame, path: str, key: str = ID_COL, fmt: str = "csv", mode: str = "errorifexists",
                 partitions: int | None = None) -> None:
    """G-08: export ordered by ``key`` without a single-task sort: range
    partitioning gives ordered, non-overlapping files, each sorted inside."""
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    out = df.repartitionByRange(n, key).sortWithinPartitions(key)
    write_table(out, path, fmt, mode)
