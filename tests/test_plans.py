"""Physical-plan guards for every query of the warehouse (see PLANS.md)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from marketlens.plans.registry import ORACLE, QUERIES  # noqa: E402
from plan_report import explain, summarise  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_nested_loop_or_python(spark, name):
    s = summarise(explain(QUERIES[name](spark, SF)))
    assert s["nested_loop"] == 0
    assert s["python"] == 0
