"""K4 by successive halving: every trial starts on a small budget, the better half goes on with twice as much.

All live trials of a rung write their scores into one table; one grouped average precision
(``pr_auc_by``) ranks them, instead of one evaluation per trial. Scores come from the models'
column expressions. The trials' trees grow together in shared passes (``tree_fits``), and a rung adds its
rounds to the trees of the rung before; category codes, which split by sets, are fitted one by one by ``fit_tree``.
"""

from __future__ import annotations

import itertools
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.operators.compiled import ZERO_IF_MISSING, CompiledTrees
from ringwatch.operators.metrics import pr_auc_by
from ringwatch.operators.models import PARITY_FEATURES, _assert_no_labels, fit_tree, materialised
from ringwatch.operators.tree_fits import TreeFits
from ringwatch.sources.tracking import log_runs

#: Trials of a sweep, and the boosting rounds that the live trials of a rung get.
TREE_SETTINGS, RUNGS = 20, (3, 6, 12)
TREE_CHOICES = {"max_depth": (3, 4, 5, 6), "step_size": (0.05, 0.1, 0.2), "subsampling": (0.7, 1.0)}


def draw_settings(n: int = TREE_SETTINGS, seed: int = 42, choices: dict = TREE_CHOICES) -> list[dict]:
    """A seeded sample of different settings; all of them if there are no more than ``n``."""
    every = [dict(zip(choices, values)) for values in itertools.product(*choices.values())]
    return random.Random(seed).sample(every, min(n, len(every)))


def halving_tree_sweep(train: DataFrame, valid: DataFrame, path: str, seed: int = 42, features=PARITY_FEATURES,
                       settings: list[dict] | None = None, rungs: tuple[int, ...] = RUNGS, at_once: int = 4) -> list[dict]:
    """Trials from best to worst: those of the last rung by average precision on ``valid``, then those that left earlier.

    ``path`` gets ``scores/rung=R`` (trial, txn_id, y, score) and ``runs``, one logged run per trial (A6)
    with the rung it reached and its average precision there. Ties go to the earlier trial. ``at_once`` trials are
    scored side by side; each writes a folder of its own."""
    settings = draw_settings(seed=seed) if settings is None else settings
    if not settings:
        return []
    _assert_no_labels(features)
    needed = list(dict.fromkeys(["txn_id", "is_laundering", *[f.removesuffix("_code") for f in features], *ZERO_IF_MISSING]))
    train, valid = (df.select(*[c for c in needed if c in df.columns]) for df in (train, valid))
    valid = materialised(valid)
    codes = any(f.endswith("_code") for f in features)
    fits = None if codes else TreeFits(train, features, settings, seed)
    train = materialised(train) if codes else train
    live, ranked = list(range(len(settings))), []
    for r, rounds in enumerate(rungs):
        at = f"{path}/scores/rung={r}"
        if fits:
            fits.grow(live, rounds)

        def fit(trial: int) -> None:
            model = fits.model(trial) if fits else CompiledTrees.of(fit_tree(train, features, seed, max_iter=rounds, **settings[trial]))
            model.score(valid).select("txn_id", F.col("is_laundering").cast("int").alias("y"), "score").write.parquet(f"{at}/trial={trial}")

        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(fit, live))
        value = {x.trial: x.pr_auc for x in pr_auc_by(valid.sparkSession.read.parquet(at), "trial").collect()}  # a row per trial
        order = sorted(live, key=lambda t: (-value[t], t))
        live = order[:-(-len(order) // 2)] if r + 1 < len(rungs) else []
        left = [t for t in order if t not in live]
        log_runs(valid.sparkSession, f"{path}/runs", "tree_halving",
                 [({"trial": t, "rung": r, "max_iter": rounds, **settings[t]}, {"pr_auc": float(value[t])}, {"kind": "sweep"}) for t in left])
        ranked = [{"trial": t, "rung": r, "max_iter": rounds, **settings[t], "pr_auc": float(value[t])} for t in left] + ranked
    if fits:
        fits.close()
    return ranked
