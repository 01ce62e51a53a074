"""What the physical plans must and must not contain."""

import ast
import re
from pathlib import Path

import pytest

from oracle import TESTDATA
from rows import plan_of
from storeflow import catalog
from storeflow.plans.views import Retail

FOLDER = str(TESTDATA / "sf0.001")
PACKAGE = Path(catalog.__file__).parent


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if not n.startswith("stream_")))
def test_no_cross_join_no_python_no_single_task(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, FOLDER))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEval"):
        assert banned not in plan
    # Only values of a whole table (one row per task) may come together in one task.
    singles = [line for line in plan.splitlines() if "SinglePartition" in line]
    if name not in ("revenue_share", "spend_share", "max_time_key", "null_violations"):
        assert singles == []


@pytest.mark.parametrize("name", ["units_by_product", "revenue_by_product", "top5_products"])
def test_product_reports_read_three_columns(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, FOLDER))
    read = re.findall(r"ReadSchema: struct<(l_[^>]*)>", plan)
    assert read and all(r.count(":") == 3 for r in read)
    assert "EqualTo(l_linestatus,O)" in plan


def test_facts_are_summed_before_the_dimension_joins(spark):
    plan = plan_of(catalog.QUERIES["units_by_product"](spark, FOLDER), "simple")
    join, first_sum = plan.index("Join"), plan.rindex("partial_sum(quantity")
    assert join < first_sum  # the plan is printed from the result down


def test_top_n_keeps_n_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan_of(catalog.QUERIES["top5_products"](spark, FOLDER))


@pytest.mark.parametrize("name", ["current_inventory", "current_inventory_ties"])
def test_latest_rows_are_cut_before_the_shuffle(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, FOLDER), "simple")
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


def test_empty_inventory_costs_no_join(spark):
    r = Retail(spark, FOLDER)
    plan = plan_of(catalog._opening_stock(r))
    assert "Join" not in plan and "PushedFilters: [IsNotNull(l_linestatus), IsNotNull(l_shipdate)" in plan


def calls(tree) -> set[str]:
    return {n.func.attr for n in ast.walk(tree) if isinstance(n, ast.Call) and isinstance(n.func, ast.Attribute)}


def test_no_driver_side_rows_in_the_package():
    """Rows reach the driver only as per-stream batch numbers.  (The optional text operators have their own bounds.)"""
    allowed = {"store.py": {"collect"}}
    for file in PACKAGE.rglob("*.py"):
        if file.parent.name == "llm":
            continue
        used = calls(ast.parse(file.read_text()))
        found = used & {"collect", "toPandas", "toLocalIterator", "localCheckpoint", "crossJoin", "rdd"}
        assert found <= allowed.get(file.name, set()), file


def test_messages_are_decoded_once(spark):
    plan = plan_of(catalog.QUERIES["purchase_lines"](spark, FOLDER), "simple")
    assert plan.count("from_json(") == 1
