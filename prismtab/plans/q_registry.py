"""Registered audit / registry / source queries (E-23..E-25, L-04..L-06, H-05,
A-05, A-07, A-10) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from prismtab.operators import registry as RG
from prismtab.operators.metrics import prediction_metrics
from prismtab.plans.catalog import register, rounded
from prismtab.plans.common import MODELS, PREDS_SQL, predictions, with_views
from prismtab.sources import io as IO
from prismtab.sources.fixtures import load_obs, load_pro, read_table

LI_KEYS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"]


# ---------------------------------------------------------------- E-23
@register("e23_distinct_profile", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT CAST({c} AS VARCHAR)) AS n_distinct,
  (count({c}) = 0 OR (count({c}) = count(*) AND min(CAST({c} AS VARCHAR)) = max(CAST({c} AS VARCHAR)))) AS is_constant
FROM lineitem""" for c in LI_KEYS))
def q_distinct_profile(spark, sf_dir):
    return RG.distinct_profile(read_table(spark, sf_dir, "lineitem"), LI_KEYS)


# ---------------------------------------------------------------- E-24
AUDIT_SQL = """WITH t AS (SELECT l_orderkey AS id, l_returnflag AS class FROM lineitem),
d AS (SELECT coalesce(class, '<NA>') AS k, count(*) AS c FROM t GROUP BY 1)
SELECT count(*) AS row_count, CAST(sum(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS id_null_count,
  count(DISTINCT id) AS unique_id_count,
  CAST(count(*) - count(DISTINCT id) - sum(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_id_count,
  CAST(sum(CASE WHEN class IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS target_null_count,
  (SELECT '{' || string_agg('"' || k || '": ' || CAST(c AS VARCHAR), ', ' ORDER BY k) || '}' FROM d) AS class_distribution,
  (SELECT string_agg(k, '|' ORDER BY k) FROM d) AS predicted_classes
FROM t"""


@register("e24_output_audit", AUDIT_SQL)
def q_output_audit(spark, sf_dir):
    """Audit of a table with duplicate ids (lineitem order keys)."""
    li = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"),
                                                      F.col("l_returnflag").alias("class"))
    return RG.output_audit(li)


# ---------------------------------------------------------------- E-25
@register("e25_content_digest", """SELECT count(*) AS row_count,
  CAST(CAST(sum(CAST(('0x' || substr(md5(concat_ws('|', coalesce(CAST(l_orderkey AS VARCHAR), '\\N'),
    coalesce(CAST(l_linenumber AS VARCHAR), '\\N'), coalesce(l_returnflag, '\\N'), coalesce(l_linestatus, '\\N'))),
    1, 15)) AS BIGINT)) AS DECIMAL(38, 0)) AS VARCHAR) AS content_digest
FROM lineitem""")
def q_digest(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    d = RG.table_digest(li, ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"])
    return d.select("row_count", F.col("content_digest").cast("string").alias("content_digest"))


# ---------------------------------------------------------------- L-04 / L-05 / L-06
def _registry_frame(spark, sf_dir, models=MODELS, note="new"):
    """One registry row per model's test prediction table: audit (E-24),
    digest (E-25) and train metrics as a map (primary metric, L-06)."""
    train = predictions(spark, sf_dir, "train")
    test = predictions(spark, sf_dir, "test")
    rows = None
    for m in models:
        pred = test.select("id", F.col(f"pred_{m}").alias("class"))
        audit = RG.output_audit(pred)
        met = prediction_metrics(train, "class", f"pred_{m}", absent="zero").select(
            F.create_map(F.lit("accuracy"), F.col("accuracy"), F.lit("balanced_accuracy"),
                         F.col("balanced_accuracy")).alias("metrics"))
        from prismtab.operators.search import attach_scalars

        r = attach_scalars(audit, met).withColumns({
            "submission_relpath": F.lit(f"predictions/{m}_test"), "model_name": F.lit(m),
            "submission_type": F.lit("argmax"), "notes": F.lit(note)})
        rows = r if rows is None else rows.unionByName(r)
    return RG.registry_rows(rows)


REG_COLS = ["submission_relpath", "model_name", "row_count", "duplicate_id_count", "id_null_count",
            "target_null_count", "predicted_classes", "class_distribution", "primary_metric_name",
            "primary_metric_value"]


def _reg_sql(m: str, note: str | None = None) -> str:
    extra = f", '{note}' AS notes" if note else ""
    return f"""SELECT 'predictions/{m}_test' AS submission_relpath, '{m}' AS model_name, count(*) AS row_count,
  CAST(count(*) - count(DISTINCT id) AS BIGINT) AS duplicate_id_count, CAST(0 AS BIGINT) AS id_null_count,
  CAST(0 AS BIGINT) AS target_null_count,
  (SELECT string_agg(k, '|' ORDER BY k) FROM (SELECT DISTINCT pred_{m} AS k FROM preds WHERE split = 'test'))
    AS predicted_classes,
  (SELECT '{{' || string_agg('"' || k || '": ' || CAST(c AS VARCHAR), ', ' ORDER BY k) || '}}'
   FROM (SELECT pred_{m} AS k, count(*) AS c FROM preds WHERE split = 'test' GROUP BY 1)) AS class_distribution,
  'accuracy' AS primary_metric_name,
  (SELECT round(avg(CASE WHEN pred_{m} = class THEN 1e0 ELSE 0e0 END), 6) FROM preds WHERE split = 'train')
    AS primary_metric_value{extra}
FROM preds WHERE split = 'test'"""


def _flat_sql(m: str) -> str:
    return f"""SELECT *, primary_metric_value AS json_accuracy, (SELECT round(avg(r), 6) FROM (SELECT avg(CASE WHEN pred_{m} = class THEN 1e0 ELSE 0e0 END) AS r
  FROM preds WHERE split = 'train' GROUP BY class)) AS json_balanced_accuracy, 'accuracy|balanced_accuracy' AS json_keys, '{{}}' AS params_json, true AS is_registered
FROM ({_reg_sql(m)})"""


@register("l05_registry_rows", with_views(PREDS_SQL) + "\nUNION ALL\n".join(_flat_sql(m) for m in MODELS))
def q_registry_rows(spark, sf_dir):
    """The flat rows, with the JSON columns read back (keys in order, values) and whether there is a time."""
    keys = F.array_join(F.json_object_keys("metrics_json"), "|")
    values = [F.get_json_object("metrics_json", f"$.{k}").cast("double").alias(f"json_{k}") for k in ("accuracy", "balanced_accuracy")]
    flat = _registry_frame(spark, sf_dir)
    return rounded(flat.select(*REG_COLS, *values, keys.alias("json_keys"), "params_json", F.col("registered_at").isNotNull().alias("is_registered")))


# ---------------------------------------------------------------- H-05
@register("h05_registry_upsert", with_views(PREDS_SQL) + "\nUNION ALL\n".join(
    [_reg_sql("m1", "old"), _reg_sql("m2", "new"), _reg_sql("m3", "new")]))
def q_registry_upsert(spark, sf_dir):
    old = _registry_frame(spark, sf_dir, ["m1", "m2"], "old")
    new = _registry_frame(spark, sf_dir, ["m2", "m3"], "new")
    return rounded(RG.upsert(old, new).select(*REG_COLS, "notes"))


# ---------------------------------------------------------------- A-05 / A-07 / A-10
@register("a05_read_prediction", with_views(PREDS_SQL) + "SELECT id, pred_m2 AS pred FROM preds WHERE split = 'test'")
def q_read_prediction(spark, sf_dir):
    test = predictions(spark, sf_dir, "test").select("id", F.col("pred_m2").alias("class"))
    return IO.prediction_table(test, "pred")


A07_DEN = "(greatest(m2__GALAXY, 1e-12) + greatest(m2__QSO, 1e-12) + greatest(m2__STAR, 1e-12))"


@register("a07_load_proba", with_views() + "SELECT id, class, " + ", ".join(
    f"round(greatest(m2__{c}, 1e-12) / {A07_DEN}, 6) AS stack_p_{c}" for c in ("GALAXY", "QSO", "STAR"))
    + " FROM pro")
def q_load_proba(spark, sf_dir):
    pro = load_pro(spark, sf_dir).drop("split")
    return rounded(IO.load_proba(pro, prefix="m2"))


@register("a10_keyed_submission", with_views(PREDS_SQL) + """SELECT o.id, p.pred_m3 AS class
FROM obs o LEFT JOIN preds p USING (id) WHERE o.split = 'test'""")
def q_submission(spark, sf_dir):
    sample = load_obs(spark, sf_dir).where(F.col("split") == "test").select("id")
    pred = predictions(spark, sf_dir, "test").select("id", F.col("pred_m3").alias("class"))
    return IO.submission(sample, pred)



# ---------------------------------------------------------------- A-11
def shared_path(spark, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    import uuid

    from prismtab.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("a11_registry_quarantine", """WITH l AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN 'blank' WHEN c_custkey % 7 = 0 THEN 'no json'
    WHEN c_custkey % 5 = 0 THEN 'wrong type' ELSE 'record' END AS kind, c_acctbal AS b FROM customer)
SELECT kind, count(*) AS n, round(CAST(sum(CASE WHEN kind = 'record' THEN b END) AS DOUBLE), 2) AS balance FROM l WHERE kind <> 'blank' GROUP BY kind""")
def q_registry_quarantine(spark, sf_dir):
    """A registry file with blank lines, cut lines and values of a wrong type, written from customers and read back."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    metrics = F.map_from_arrays(F.array(F.lit("balance")), F.array(F.col("c_acctbal").cast("double")))
    whole = F.to_json(F.struct(F.concat(F.lit("sub/"), k).alias("submission_relpath"), metrics.alias("metrics")))
    wrong = F.to_json(F.struct(k.cast("string").alias("submission_relpath"), F.lit("none").alias("metrics")))
    line = F.when(k % 11 == 0, "  ").when(k % 7 == 0, F.expr("substring(line, 1, length(line) - 3)")).when(k % 5 == 0, wrong).otherwise(F.col("line"))
    path = shared_path(spark, "registry-lines")
    c.withColumn("line", whole).select(line.alias("value")).write.text(path)
    good, bad = RG.quarantined(spark, path)
    records = good.agg(F.lit("record").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum(F.element_at("metrics", "balance")).alias("balance"))
    held = bad.groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("balance"))
    return records.unionByName(held).withColumn("balance", F.round("balance", 2))


# ---------------------------------------------------------------- A-08
@register("a08_experiment_partitions", with_views(PREDS_SQL) + """SELECT 'm1' AS experiment, count(*) AS n, sum(id) AS ids FROM preds WHERE split = 'train'
UNION ALL SELECT 'm2', count(*), sum(id) FROM preds WHERE split = 'test' UNION ALL SELECT 'm3', count(*), sum(id) FROM preds""".replace("sum(id)", "CAST(sum(id) AS BIGINT)"))
def q_experiment_partitions(spark, sf_dir):
    """Two experiments written, one written anew and one added: the first stays as it was."""
    p = predictions(spark, sf_dir, None)
    path = shared_path(spark, "experiments")
    one = lambda rows, m: rows.select("id", F.col(f"pred_{m}").alias("class"), F.lit(m).alias("experiment"))
    IO.write_experiments(one(p.where("split = 'train'"), "m1").unionByName(one(p.where("split = 'train'"), "m2")), path)
    IO.write_experiments(one(p.where("split = 'test'"), "m2").unionByName(one(p, "m3")), path)
    return spark.read.parquet(path).groupBy("experiment").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


# ---------------------------------------------------------------- D-04
@register("d04_stored_predictions_join", with_views(PREDS_SQL) + """SELECT a.id, a.pred_m1 AS base_pred, b.pred_m2 AS other_pred, a.pred_m1 <> b.pred_m2 AS differs
FROM preds a JOIN preds b ON a.id = b.id AND b.id % 3 <> 0""")
def q_stored_join(spark, sf_dir):
    """Two prediction tables, stored in buckets in the shared folder and joined there without an exchange."""
    p = predictions(spark, sf_dir, None)
    a = IO.store_bucketed(p.select("id", F.col("pred_m1").alias("base_pred")), shared_path(spark, "base"), buckets=8)
    b = IO.store_bucketed(p.where("id % 3 <> 0").select("id", F.col("pred_m2").alias("other_pred")), shared_path(spark, "other"), buckets=8)
    return a.hint("merge").join(b, "id").withColumn("differs", F.col("base_pred") != F.col("other_pred"))


# ---------------------------------------------------------------- L-04
@register("l04_stored_registry", with_views(PREDS_SQL) + "\nUNION ALL\n".join([_reg_sql("m1", "old"), _reg_sql("m2", "new"), _reg_sql("m3", "new")]))
def q_stored_registry(spark, sf_dir):
    """The upsert of H-05 through a stored table: two versions, the newest read back."""
    path = shared_path(spark, "registry")
    RG.upsert_registry_table(spark, path, _registry_frame(spark, sf_dir, ["m1", "m2"], "old"))
    stored = RG.upsert_registry_table(spark, path, _registry_frame(spark, sf_dir, ["m2", "m3"], "new"))
    return rounded(stored.select(*REG_COLS, "notes"))
