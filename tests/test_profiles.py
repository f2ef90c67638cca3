"""The registered runs of the whole ensemble fit the published set."""

import subprocess
import sys
from pathlib import Path

import pytest

from tillroll.plans import learning, registry

SF = "/root/testdata/sf0.001"


class Asked(Exception):
    pass


def test_published_unless_replaced():
    code = (
        "from tillroll.plans import learning; from tillroll.operators.ensemble import EnsembleSpec; "
        "assert learning.SPEC is EnsembleSpec.published and learning.LEARNERS is learning.published_learners"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, check=True)


@pytest.mark.parametrize("name", ["level2_matrix", "level2_predict", "visit_class_probs", "visit_submission"])
def test_queries_ask_for_the_spec(spark, name, monkeypatch):
    def asked(n_rows):
        raise Asked(n_rows)

    monkeypatch.setattr(learning, "SPEC", asked)
    with pytest.raises(Asked):
        registry.QUERIES[name](spark, SF)
