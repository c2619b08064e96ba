"""Ensemble strategies over the probability blocks of a suite (K-02, B-31) and their scoreboard."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismtab.constants import CLASSES
from prismtab.functions.proba import weighted_average
from prismtab.operators.metrics import scoreboard
from prismtab.operators.search import order_cols


def ensemble_tables(frame: DataFrame, blocks: dict[str, list[str]], strategies: dict[str, dict[str, float]], keep: list[str], classes=CLASSES) -> DataFrame:
    """``keep`` and, for each strategy, ``ens__<strategy>__<class>``: the weighted mean of the blocks that the
    frame has (weight 1 where the strategy names none), renormalised.  All strategies in one projection."""
    made = [p.alias(f"ens__{name}__{c}") for name, weights in strategies.items() for p, c in zip(weighted_average(frame, blocks, weights), classes)]
    return frame.select(*keep, *made)


def run_ensembles(train: DataFrame, test: DataFrame | None, blocks: dict[str, list[str]], strategies: dict[str, dict[str, float]],
                  label: str = "class", id_col: str = "id", classes=CLASSES) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(train table, test table, scoreboard) of the strategies.

    The scoreboard has strategy, accuracy, balanced_accuracy, log_loss and weights (JSON, one weight
    per experiment), by accuracy and balanced accuracy, then name; it is one aggregate over the training rows."""
    wide = ensemble_tables(train, blocks, strategies, [id_col, label], classes)
    other = None if test is None else ensemble_tables(test, blocks, strategies, [id_col], classes)
    scores = scoreboard(wide, label, {name: [f"ens__{name}__{c}" for c in classes] for name in strategies})
    used = {name: json.dumps({b: float(weights.get(b, 1.0)) for b in blocks}, sort_keys=True) for name, weights in strategies.items()}
    notes = F.create_map(*[x for name, text in used.items() for x in (F.lit(name), F.lit(text))])
    board = scores.select(F.col("model").alias("strategy"), "accuracy", "balanced_accuracy", "log_loss", F.element_at(notes, F.col("model")).alias("weights"))
    order = order_cols([("accuracy", "desc"), ("balanced_accuracy", "desc"), ("strategy", "asc")], board)
    return wide, other, board.orderBy(*order)
