"""Output audit, fingerprints and the prediction registry (E-23..E-25,
L-04..L-06, A-11, H-05).

The registry is a table (Parquet/JSON) with one row per registered
prediction table, keyed by its path; registering is an upsert.  Audits are
single aggregates over the prediction table, so they scale with it.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NA_LABEL = "<NA>"
PRIMARY_METRIC_ORDER = ["accuracy", "balanced_accuracy", "log_loss", "score"]


# ---------------------------------------------------------------- E-23
def distinct_profile(df: DataFrame, cols=None, approx: bool = False) -> DataFrame:
    """E-23: per column distinct count and constant flag (min <=> max and
    either no NULLs or only NULLs), one aggregate over unpivoted columns."""
    cols = cols or df.columns
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("_v")) for c in cols])
    long = df.select(F.inline(arr))
    cd = F.approx_count_distinct("_v") if approx else F.count_distinct("_v")
    g = long.groupBy("column").agg(
        cd.cast("bigint").alias("n_distinct"),
        F.min("_v").alias("_mn"), F.max("_v").alias("_mx"),
        F.sum(F.when(F.col("_v").isNull(), 1).otherwise(0)).alias("_nn"), F.count(F.lit(1)).alias("_n"))
    const = (F.col("_nn") == F.col("_n")) | ((F.col("_nn") == 0) & F.col("_mn").eqNullSafe(F.col("_mx")))
    return g.select("column", "n_distinct", const.alias("is_constant"))


# ---------------------------------------------------------------- E-24
def json_counts(key: Column, value: Column) -> Column:
    """Aggregate → JSON object text with keys sorted, formatted like Python's
    ``json.dumps(..., sort_keys=True)`` (``{"a": 1, "b": 2}``)."""
    entries = F.array_sort(F.collect_list(F.struct(key.alias("k"), value.alias("v"))))
    return F.concat(F.lit("{"), F.array_join(F.transform(
        entries, lambda e: F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(e["k"], r"\\", r"\\\\"), '"', r'\\"'),
                                    F.lit('": '), e["v"].cast("string"))), ", "), F.lit("}"))


def output_audit(df: DataFrame, id_col: str = "id", label_col: str = "class") -> DataFrame:
    """E-24: rows, null ids, unique ids, duplicates (= rows - unique - nulls),
    null targets, class distribution (JSON, sorted keys, NULL as '<NA>') and
    the sorted class list joined by '|'.

    Distinct ids are counted by a grouped aggregate on id (distributed); the
    class distribution is built from the (small) per-class counts."""
    n = df.agg(F.count(F.lit(1)).alias("row_count"),
               F.sum(F.when(F.col(id_col).isNull(), 1).otherwise(0)).cast("bigint").alias("id_null_count"),
               F.sum(F.when(F.col(label_col).isNull(), 1).otherwise(0)).cast("bigint").alias("target_null_count"))
    uniq = df.where(F.col(id_col).isNotNull()).select(id_col).distinct().agg(
        F.count(F.lit(1)).alias("unique_id_count"))
    lab = F.coalesce(F.col(label_col).cast("string"), F.lit(NA_LABEL))
    counts = df.groupBy(lab.alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
    dist = counts.agg(
        json_counts(F.col("_k"), F.col("_c")).alias("class_distribution"),
        F.array_join(F.array_sort(F.collect_list("_k")), "|").alias("predicted_classes"))
    from prismtab.operators.search import attach_scalars

    out = attach_scalars(attach_scalars(n, uniq), dist)
    return out.select(
        "row_count", "id_null_count", "unique_id_count",
        (F.col("row_count") - F.col("unique_id_count") - F.col("id_null_count")).alias("duplicate_id_count"),
        "target_null_count", "class_distribution", "predicted_classes")


# ---------------------------------------------------------------- E-25
def table_digest(df: DataFrame, cols=None) -> DataFrame:
    """E-25 (re-aimed): order-free content fingerprint = row count and the sum
    of a 60-bit prefix of md5 over each row's '|'-joined values (as decimal,
    no overflow).  Equal tables give equal digests regardless of partitioning."""
    cols = cols or df.columns
    row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols])
    h = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(h).cast("decimal(38,0)").alias("content_digest"))


def file_digest(spark, path: str) -> DataFrame:
    """Per-file SHA-256 of the bytes (``binaryFile`` source)."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2(F.col("content"), 256).alias("sha256"))


# ---------------------------------------------------------------- L-06
def primary_metric(metrics: Column, order=PRIMARY_METRIC_ORDER) -> tuple[Column, Column]:
    """L-06: first present of accuracy, balanced_accuracy, log_loss, score;
    else the first key of the map.  ``metrics`` is map<string,double>."""
    name = None
    for k in order:
        cond = F.map_contains_key(metrics, F.lit(k))
        name = F.when(cond, F.lit(k)) if name is None else name.when(cond, F.lit(k))
    name = name.otherwise(F.get(F.map_keys(metrics), 0))
    return name, F.element_at(metrics, name)


def json_of_map(m: Column) -> Column:
    """JSON text of a map with keys sorted (``to_json`` of a key-sorted map)."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


# ---------------------------------------------------------------- L-04 / L-05
def registry_rows(audits: DataFrame, key: str = "submission_relpath") -> DataFrame:
    """L-05: flat registry row from audit + context + metrics/params columns.

    ``audits`` carries: key, E-24 audit columns, optional ``content_digest``,
    ``model_name``, ``submission_type``, ``metrics`` map<string,double>,
    ``params`` map<string,string>, ``notes``."""
    name, value = primary_metric(F.col("metrics"))
    out = audits.withColumns({
        "registered_at": F.current_timestamp(),
        "primary_metric_name": name,
        "primary_metric_value": value,
        "metrics_json": json_of_map(F.col("metrics")),
        "params_json": json_of_map(F.col("params")) if "params" in audits.columns else F.lit("{}"),
    })
    return out


def upsert(registry: DataFrame, new: DataFrame, key: str = "submission_relpath") -> DataFrame:
    """H-05: keyed upsert keeping the newest record per key (anti join + union)."""
    kept = registry.join(new.select(key), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def latest_per_key(df: DataFrame, key: str, ts: str = "registered_at") -> DataFrame:
    """H-05 alternative for an append-only log: the newest row per key
    (``max_by`` aggregate; no window over a whole key)."""
    other = [c for c in df.columns if c != key]
    s = F.max_by(F.struct(*other), F.col(ts))
    return df.groupBy(key).agg(s.alias("_r")).select(key, "_r.*")


# ---------------------------------------------------------------- A-11
REGISTRY_SCHEMA = T.StructType([
    T.StructField("submission_relpath", T.StringType()),
    T.StructField("registered_at", T.StringType()),
    T.StructField("summary", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("notes", T.StringType()),
])


def read_registry_jsonl(spark, path: str, schema: T.StructType = REGISTRY_SCHEMA) -> DataFrame:
    """A-11: JSONL registry; blank and malformed lines are skipped."""
    return quarantined(spark, path, schema)[0]


def quarantined(spark, path: str, schema: T.StructType = REGISTRY_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """A-11: (records, quarantine) of a JSONL file or folder.

    The quarantine has a row per line that is no record of the schema: file, line (its text) and reason
    (``no json``, ``wrong type``).  Blank lines are neither.  Both are lazy and read the lines once each."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    held = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = lines.withColumn("_r", F.from_json("value", held, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    good = F.col("_r").isNotNull() & F.col("_r._corrupt").isNull()
    records = parsed.where(good).select(*[F.col(f"_r.`{f.name}`").alias(f.name) for f in schema.fields])
    is_object = F.try_parse_json("value").isNotNull() & F.trim("value").startswith("{")
    bad = parsed.where(~good).select("file", F.col("value").alias("line"), F.when(is_object, F.lit("wrong type")).otherwise(F.lit("no json")).alias("reason"))
    return records, bad


def write_registry(df: DataFrame, path: str, fmt: str = "json") -> None:
    """A-11: rewrite the registry table (after an upsert)."""
    df.write.mode("overwrite").format(fmt).save(path)


# ---------------------------------------------------------------- L-04
def register_prediction(pred: DataFrame, relpath: str, model_name: str | None = None,
                        submission_type: str | None = None, metrics: dict | None = None,
                        params: dict | None = None, notes: str | None = None, id_col: str = "id",
                        label_col: str = "class") -> DataFrame:
    """L-04: one registry row for a prediction table: E-24 audit, E-25 digest,
    context, metrics (map<string,double>) and params (map<string,string>),
    flattened by :func:`registry_rows`."""
    from prismtab.operators.search import attach_scalars

    audit = output_audit(pred, id_col, label_col)
    digest = table_digest(pred.select(id_col, label_col)).select("content_digest")
    row = attach_scalars(audit, digest)

    def lit_map(d, typ):
        if not d:
            return F.create_map().cast(f"map<string,{typ}>")
        return F.create_map(*[x for k, v in sorted(d.items()) for x in (F.lit(str(k)), F.lit(v).cast(typ))])

    row = row.withColumns({
        "submission_relpath": F.lit(relpath),
        "model_name": F.lit(model_name).cast("string"),
        "submission_type": F.lit(submission_type).cast("string"),
        "notes": F.lit(notes).cast("string"),
        "metrics": lit_map(metrics, "double"),
        "params": lit_map({k: str(v) for k, v in (params or {}).items()}, "string"),
    })
    return registry_rows(row)


def _registry_versions(spark, path: str) -> list[str]:
    """Complete versions of a stored registry, oldest first."""
    from prismtab.sources.io import child_folders, path_exists

    names = [n for n in child_folders(spark, path) if re.fullmatch(r"version=\d+", n)]
    return [n for n in sorted(names, key=lambda n: int(n[8:])) if path_exists(spark, f"{path}/{n}/_SUCCESS")]


def read_registry_table(spark, path: str) -> DataFrame | None:
    """The stored registry (its newest complete version, or a plain Parquet table); None if there is none."""
    from prismtab.sources.io import path_exists

    versions = _registry_versions(spark, path)
    if versions:
        return spark.read.parquet(f"{path}/{versions[-1]}")
    return spark.read.parquet(path) if path_exists(spark, f"{path}/_SUCCESS") else None


#: how long a claimed version may take to complete before others pass over it, and how often they look
CLAIM_SECONDS, LOOK_SECONDS = 600.0, 0.2


class LostRace(RuntimeError):
    """No version could be claimed."""


def upsert_registry_table(spark, path: str, new_rows: DataFrame, key: str = "submission_relpath", attempts: int = 100,
                          claim_seconds: float = CLAIM_SECONDS) -> DataFrame:
    """L-04 / H-05: keyed upsert into a stored registry table, in any store, by any number of writers.

    A writer claims the number after the newest version by creating a file (below ``<path>.claims``) that must not exist yet, and
    merges only if that version is still the newest once the claim is its own.  Otherwise it waits for the other writer's
    version and merges anew with that; a claim that does not complete within ``claim_seconds`` is passed over.
    The merged table is a new version beside the one it was read from and counts once it is complete, so a
    failed write loses nothing.  The version before it is kept, older ones go."""
    from prismtab.sources.io import create_new, delete_folder

    new_rows = new_rows.drop("metrics", "params")
    path = path.rstrip("/")
    skipped = 0  # claims after the newest version whose writers are taken to be gone
    waited = time.monotonic()
    for _ in range(attempts):
        versions = _registry_versions(spark, path)
        newest = int(versions[-1][8:]) if versions else 0
        number = newest + 1 + skipped
        if not create_new(spark, f"{path}.claims/{number}"):
            while not (found := _registry_versions(spark, path)) or int(found[-1][8:]) <= newest:
                if time.monotonic() - waited > claim_seconds:
                    skipped += 1
                    waited = time.monotonic()
                    break
                time.sleep(LOOK_SECONDS)
            else:
                skipped, waited = 0, time.monotonic()
            continue
        if _registry_versions(spark, path) != versions:
            delete_folder(spark, f"{path}.claims/{number}")
            continue
        stored = read_registry_table(spark, path)
        merged = new_rows if stored is None else upsert(stored, new_rows, key)
        merged.write.mode("overwrite").parquet(f"{path}/version={number}")
        for old in versions[:-1]:
            delete_folder(spark, f"{path}/{old}")
            delete_folder(spark, f"{path}.claims/{int(old[8:])}")
        return spark.read.parquet(f"{path}/version={number}")
    raise LostRace(f"no version of {path} could be claimed in {attempts} attempts")
