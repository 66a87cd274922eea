"""The native operators stay within DataFrame functions, also in the tables they write on the way."""

import re
from functools import partial

import pytest
from lendlake.llm import mixing, sharding
from lendlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op6_sharding", "op8_mixing"])
def test_native_operators_have_no_python_and_no_cross_products(spark, monkeypatch, name):
    """The plan of the result and of every table that is written on the way."""
    plans = []

    def seen(df, *args, written):
        plans.append(physical(df))
        return written(df, *args)

    for module in (sharding, mixing):
        if hasattr(module, "written"):
            monkeypatch.setattr(module, "written", partial(seen, written=module.written))
    plans.append(physical(QUERIES[name](spark, SF_DIR)))
    assert not re.search("Python|Pandas|MapInArrow|Cartesian|BroadcastNestedLoop", "\n".join(plans))
