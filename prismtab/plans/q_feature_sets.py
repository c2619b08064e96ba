"""B-39: all nine named feature sets over ``obs``, every column of each, with SQL put together from the blocks' formulas."""

from __future__ import annotations

from pyspark.sql import functions as F

from prismtab.functions.features import build_feature_sets
from prismtab.operators import groupkeys as GK
from prismtab.plans.catalog import register, rounded
from prismtab.plans.common import with_views
from prismtab.plans.q_features import B01_COLS, B05_COLS, B11_COLS, B15_COLS, B17_COLS, FB_SQL, _r
from prismtab.sources.fixtures import load_obs

#: searched columns (K-13) and group aggregates (E-12) that the wide sets take in
GENERATED = ["round__redshift__1", "digit__u__1"]
GROUPS = [(["spectral_type"], "redshift", "mean"), (["galaxy_population"], "u", "count"), (["spectral_type", "galaxy_population"], "g", "std")]

RAW_COLS = ["class", "split", "spectral_type", "galaxy_population"] + [_r(f"fb.{c}", f"fb.{c}").replace(f"AS fb.{c}", f"AS {c}") for c in
                                                                     ("alpha", "delta", "redshift", "u", "g", "r", "i", "z")]
GENERATED_COLS = [
    "round(CAST(CAST(round_even(redshift * 1e1, 0) / 1e1 + 0e0 AS FLOAT) AS DOUBLE), 6) + 0e0 AS round__redshift__1",
    "CAST(floor(round(abs(u) * 1e1, 6)) % 10 AS SMALLINT) AS digit__u__1",
]
# what each group feature reads from its joined fit (f0..f2) or, for a key that the training rows lack, from all rows
GROUP_COLS = [
    _r('"gb__spectral_type__redshift__mean"', "coalesce(f0.v, (SELECT avg(redshift) FROM obs WHERE split = 'train'))"),
    _r('"gb__galaxy_population__u__count"', "coalesce(f1.v, 0e0)"),
    _r('"gb__spectral_type|galaxy_population__g__std"', "coalesce(f2.v, (SELECT stddev_samp(g) FROM obs WHERE split = 'train'))"),
]
GROUP_FITS = """f0 AS (SELECT spectral_type, avg(redshift) AS v FROM obs WHERE split = 'train' GROUP BY ALL),
f1 AS (SELECT galaxy_population, CAST(count(u) AS DOUBLE) AS v FROM obs WHERE split = 'train' GROUP BY ALL),
f2 AS (SELECT spectral_type, galaxy_population, stddev_samp(g) AS v FROM obs WHERE split = 'train' GROUP BY ALL)"""
GROUP_JOINS = """
LEFT JOIN f0 ON fb.spectral_type IS NOT DISTINCT FROM f0.spectral_type
LEFT JOIN f1 ON fb.galaxy_population IS NOT DISTINCT FROM f1.galaxy_population
LEFT JOIN f2 ON fb.spectral_type IS NOT DISTINCT FROM f2.spectral_type AND fb.galaxy_population IS NOT DISTINCT FROM f2.galaxy_population"""

BASELINE = RAW_COLS + B01_COLS
EXTRA = BASELINE + B17_COLS
TARGETED = EXTRA + B05_COLS + B11_COLS
SETS = {
    "raw": RAW_COLS,
    "baseline": BASELINE,
    "extra": EXTRA,
    "targeted": TARGETED,
    "local_guard": TARGETED + B15_COLS,
    "autofe": BASELINE + GENERATED_COLS,
    "groupagg": BASELINE + GROUP_COLS,
    "wide": EXTRA + GENERATED_COLS + GROUP_COLS,
    "targeted_wide": TARGETED + GENERATED_COLS + GROUP_COLS,
}


def set_sql(name: str) -> str:
    cols = SETS[name]
    if GROUP_COLS[0] not in cols:
        return with_views(FB_SQL) + "SELECT id, " + ",\n  ".join(cols) + "\nFROM fb"
    # the fits share column names with fb: its own columns first, the groups' values beside them
    own = [c for c in cols if c not in GROUP_COLS]
    return (with_views(FB_SQL, GROUP_FITS, "own AS (SELECT id, " + ", ".join(own) + " FROM fb)",
                       "grouped AS (SELECT fb.id, " + ", ".join(GROUP_COLS) + " FROM fb" + GROUP_JOINS + ")")
            + "SELECT own.*, grouped.* EXCLUDE (id) FROM own JOIN grouped USING (id)")


def _query(name: str):
    @register(f"b39_set_{name}", set_sql(name))
    def q_set(spark, sf_dir):
        obs = load_obs(spark, sf_dir)
        train, test = (obs.where(F.col("split") == s) for s in ("train", "test"))
        (framed,), made = GK.key_columns([obs], GENERATED)
        generated = framed.select("id", *[made[c].alias(c) for c in GENERATED])
        groups = GK.group_aggregate_features(train, test, GROUPS)
        first, second = build_feature_sets(train, test, generated, groups)[name]
        return rounded(first.unionByName(second))

    return q_set


for _name in SETS:
    _query(_name)
