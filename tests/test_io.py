"""File sources and sinks (A-01, A-02, A-04, A-06, A-08/A-09, A-10, G-08)."""

import glob
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from prismtab.operators.checks import ContractError
from prismtab.sources import io as IO


def _write_inputs(d, n_test=3, n_sample=3):
    cols = ["id", "alpha", "delta", "u", "g", "r", "i", "z", "redshift", "spectral_type", "galaxy_population"]
    row = [1, 10.0, 5.0, 20.0, 19.0, 18.5, 18.0, 17.5, 0.1, "M", "Blue_Cloud"]
    pd.DataFrame([row + ["STAR"], [2] + row[1:] + ["QSO"]], columns=cols + ["class"]).to_csv(
        os.path.join(d, "train.csv"), index=False)
    pd.DataFrame([[10 + k] + row[1:] for k in range(n_test)], columns=cols).to_csv(
        os.path.join(d, "test.csv"), index=False)
    pd.DataFrame({"id": [10 + k for k in range(n_sample)], "class": ["GALAXY"] * n_sample}).to_csv(
        os.path.join(d, "sample_submission.csv"), index=False)


def test_read_and_validate_inputs(spark):
    d = tempfile.mkdtemp(prefix="prismtab-io-")
    _write_inputs(d)
    train, test, sample = IO.read_inputs(spark, d)
    assert dict(train.dtypes)["id"] == "bigint" and dict(train.dtypes)["redshift"] == "double"
    assert IO.validate_inputs(train, test, sample) == {"test_rows": 3, "sample_rows": 3}


def test_missing_input_and_row_mismatch(spark):
    d = tempfile.mkdtemp(prefix="prismtab-io-")
    with pytest.raises(FileNotFoundError):
        IO.read_inputs(spark, d)
    _write_inputs(d, n_test=3, n_sample=2)
    train, test, sample = IO.read_inputs(spark, d)
    with pytest.raises(ContractError):
        IO.validate_inputs(train, test, sample)


def test_writers_refuse_overwrite_and_oof_run_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="prismtab-io-")
    df = spark.createDataFrame([(1, "STAR", 0.2, 0.1, 0.7)], "id long, class string, m__GALAXY double, "
                                                            "m__QSO double, m__STAR double")
    IO.write_table(df, os.path.join(d, "oof_train.parquet"))
    IO.write_table(df.drop("class"), os.path.join(d, "oof_test.parquet"))
    with pytest.raises(Exception):
        IO.write_table(df, os.path.join(d, "oof_train.parquet"))
    tr, te, scores = IO.read_oof_run(spark, d)
    assert tr.count() == 1 and te.count() == 1 and scores.count() == 0 and "log_loss" in scores.columns
    p = IO.load_proba(tr).first()
    assert p["stack_p_STAR"] == pytest.approx(0.7)


def test_optional_frame_and_keyed_submission(spark):
    empty = IO.optional_frame(spark, "/nonexistent/path.csv", IO.PRED_SCHEMA)
    assert empty.count() == 0 and empty.columns == ["id", "class"]
    sample = spark.createDataFrame([(1,), (2,)], "id long")
    pred = spark.createDataFrame([(1, "STAR")], "id long, class string")
    with pytest.raises(ContractError):
        IO.submission(sample, pred)
    ok = IO.submission(sample, pred.union(spark.createDataFrame([(2, "QSO")], "id long, class string")))
    assert ok.count() == 2


def test_write_sorted_files_are_ordered(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="prismtab-io-"), "out")
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("id"), F.lit("GALAXY").alias("class"))
    IO.write_sorted(df, d, partitions=4)
    files = sorted(glob.glob(os.path.join(d, "part-*.csv")))
    ids = [i for f in files for i in pd.read_csv(f)["id"].tolist()]
    assert ids == sorted(ids) and len(ids) == 1000
