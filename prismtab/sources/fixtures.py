"""Stand-in observation and probability tables derived from the test tables.

``obs`` is one row per ``orders`` row (``o_orderkey`` is unique) carrying the
observation schema (id, class, two categoricals, alpha/delta, five
magnitudes, redshift, split).  ``pro`` adds three synthetic models'
probabilities.  Both are pure projections of ``orders``: they scale with it,
need no shuffle and prune every unused column at the scan.

Only integer arithmetic and double literals are used so that any SQL engine
reproduces the values exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prismtab.constants import CLASSES

# --- fixed values: synthetic model parameters (m, a, b) per model ----------
PRO_MODELS = {"m1": (60, 11, 5), "m2": (45, 17, 31), "m3": (52, 12, 9)}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _scaled(k: Column, c: Column, a: int, b: int, mod: int, base: float, div: float) -> Column:
    return F.lit(base) + ((k * a + c * b) % mod) / F.lit(div)


def obs_from_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    c = F.col("o_custkey")
    status = F.col("o_orderstatus")
    prio = F.col("o_orderpriority")
    return orders.select(
        k.alias("id"),
        F.when(status == "F", "GALAXY").when(status == "O", "QSO").otherwise("STAR").alias("class"),
        F.when(prio == "1-URGENT", "M")
        .when(prio == "2-HIGH", "A/F")
        .when(prio == "3-MEDIUM", "G/K")
        .when(prio == "4-NOT SPECIFIED", "O/B")
        .alias("spectral_type"),
        F.when(c % 2 == 0, "Blue_Cloud").otherwise("Red_Sequence").alias("galaxy_population"),
        (((k * 37) % 36000) / F.lit(1e2)).alias("alpha"),
        (((c * 53) % 11000) / F.lit(1e2) - F.lit(2e1)).alias("delta"),
        (((k * 7 + c * 13) % 2000) / F.lit(1e3) - F.lit(1e-2)).alias("redshift"),
        _scaled(k, c, 31, 17, 700, 1.62e1, 1e2).alias("u"),
        _scaled(k, c, 29, 11, 500, 1.60e1, 1e2).alias("g"),
        _scaled(k, c, 23, 7, 400, 1.58e1, 1e2).alias("r"),
        _scaled(k, c, 19, 5, 350, 1.56e1, 1e2).alias("i"),
        _scaled(k, c, 41, 3, 300, 1.55e1, 1e2).alias("z"),
        F.when(k % 5 == 0, "test").otherwise("train").alias("split"),
    )


def load_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_from_orders(read_table(spark, sf_dir, "orders"))


def _weight(idc: Column, cls: Column, m: int, a: int, b: int, target: str) -> Column:
    return F.lit(1) + (idc * a + b) % 97 + F.when(cls == target, F.lit(m)).otherwise(F.lit(0))


def pro_from_obs(obs: DataFrame) -> DataFrame:
    idc = F.col("id")
    cls = F.col("class")
    cols = [idc, cls, F.col("split")]
    for name, (m, a, b) in PRO_MODELS.items():
        ws = [_weight(idc, cls, m, a + 7 * j, b + 13 * j, c) for j, c in enumerate(CLASSES)]
        total = (ws[0] + ws[1] + ws[2]) * F.lit(1e0)
        cols += [(w / total).alias(f"{name}__{c}") for w, c in zip(ws, CLASSES)]
    return obs.select(*cols)


def load_pro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pro_from_obs(load_obs(spark, sf_dir))


# ---- SQL text of the same views (for the DuckDB oracle) --------------------

OBS_SQL = """
obs AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderstatus = 'F' THEN 'GALAXY' WHEN o_orderstatus = 'O' THEN 'QSO' ELSE 'STAR' END AS class,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'M' WHEN '2-HIGH' THEN 'A/F' WHEN '3-MEDIUM' THEN 'G/K'
         WHEN '4-NOT SPECIFIED' THEN 'O/B' ELSE NULL END AS spectral_type,
    CASE WHEN o_custkey % 2 = 0 THEN 'Blue_Cloud' ELSE 'Red_Sequence' END AS galaxy_population,
    ((o_orderkey*37) % 36000)/1e2 AS alpha,
    ((o_custkey*53) % 11000)/1e2 - 2e1 AS delta,
    ((o_orderkey*7 + o_custkey*13) % 2000)/1e3 - 1e-2 AS redshift,
    1.62e1 + ((o_orderkey*31 + o_custkey*17) % 700)/1e2 AS u,
    1.60e1 + ((o_orderkey*29 + o_custkey*11) % 500)/1e2 AS g,
    1.58e1 + ((o_orderkey*23 + o_custkey*7) % 400)/1e2 AS r,
    1.56e1 + ((o_orderkey*19 + o_custkey*5) % 350)/1e2 AS i,
    1.55e1 + ((o_orderkey*41 + o_custkey*3) % 300)/1e2 AS z,
    CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split
  FROM orders
)"""


def _pro_sql() -> str:
    parts = ["id", "class", "split"]
    for name, (m, a, b) in PRO_MODELS.items():
        ws = [
            f"(1 + (id*{a + 7 * j} + {b + 13 * j}) % 97 + CASE WHEN class = '{c}' THEN {m} ELSE 0 END)"
            for j, c in enumerate(CLASSES)
        ]
        tot = f"(({ws[0]} + {ws[1]} + {ws[2]})*1e0)"
        parts += [f"{w} / {tot} AS {name}__{c}" for w, c in zip(ws, CLASSES)]
    return "pro AS (\n  SELECT " + ",\n    ".join(parts) + "\n  FROM obs\n)"


PRO_SQL = _pro_sql()
