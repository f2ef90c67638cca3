"""Tests fit quick models; the registered queries fit the published ones."""

from tillroll.operators import models
from tillroll.operators.ensemble import EnsembleSpec
from tillroll.plans import learning


def quick_learners(n_rows: int) -> dict:
    return {
        "logistic": models.logistic(n_rows, max_iter=20),
        "forest": models.forest(trees=20, depth=6),
        "net": models.Network("net", (16,), steps=30, drop_inputs=0.2, drop_units=0.2, rate=0.02),
        "boosted": models.Boosted(rounds=6, depth=3, step=0.3, features=1.0),
        "extra_trees": models.ExtraTrees(trees=20, depth=6),
        "adaboost": models.RealAdaBoost(rounds=6, depth=4),
        "final_net": models.Network("final_net", (8,), steps=5),
    }


learning.SPEC = EnsembleSpec.quick
learning.LEARNERS = quick_learners
