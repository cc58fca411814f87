"""Averages of an order's lines are added in the order of the stored rows, whatever files and tasks these lie in."""

from datetime import datetime

import pandas as pd
import pytest

from riskloom.plans import queries
from riskloom.sources.apps import load_apps

#: Discounts of every order in stored order; added in any other grouping they give 0.6 / 3.
DISCOUNTS = (0.1, 0.2, 0.3)


@pytest.fixture(params=["one file", "one a line"], scope="module")
def folder(request, tmp_path_factory):
    """Twenty orders; those of even number have a single line of their average."""
    out = tmp_path_factory.mktemp("star")
    orders = range(1, 21)
    tables = {
        "region": {"r_regionkey": [0], "r_name": ["ASIA"]},
        "nation": {"n_nationkey": [0], "n_regionkey": [0]},
        "customer": {"c_custkey": [1], "c_nationkey": [0], "c_acctbal": [10.0], "c_mktsegment": ["BUILDING"]},
        "orders": {"o_orderkey": list(orders), "o_custkey": 1, "o_totalprice": [25000.0 * i for i in orders], "o_orderdate": [datetime(1996, 1, i) for i in orders], "o_orderpriority": "1-URGENT"},
    }
    for name, columns in tables.items():
        pd.DataFrame(columns).astype({c: "datetime64[us]" for c in columns if c == "o_orderdate"}).to_parquet(out / f"{name}.parquet")
    lines = [pd.DataFrame({"l_orderkey": [i for i in orders if i % 2 or not n], "l_quantity": 1.0}) for n in range(3)]
    for n, part in enumerate(lines):
        part["l_discount"] = [DISCOUNTS[n] if i % 2 else (0.1 + 0.2 + 0.3) / 3 for i in part["l_orderkey"]]
    if request.param == "one file":
        pd.concat(lines).to_parquet(out / "lineitem.parquet", row_group_size=7)
    else:
        (out / "lineitem.parquet").mkdir()
        for n, part in enumerate(lines):
            # the last file is the largest, so that Spark reads it first
            part.assign(l_comment=[f"{i}" * 50 * n for i in range(len(part))]).to_parquet(out / "lineitem.parquet" / f"part-{n}.parquet")
    return str(out)


def test_lines_are_added_in_stored_order(spark, folder):
    apps = load_apps(spark, folder)
    assert {r["avg_disc"] for r in apps.collect()} == {(0.1 + 0.2 + 0.3) / 3} and (0.1 + 0.2 + 0.3) / 3 != 0.6 / 3
    assert {r["app_id"]: r["n_items"] for r in apps.collect()} == {i: 3 if i % 2 else 1 for i in range(1, 21)}


def test_data_quality_counts_no_other_average(spark, folder):
    assert {r["unique_count"] for r in queries.queries()["data_quality"](spark, folder).where("feature = 'avg_disc'").collect()} == {1}


def test_a_constant_average_is_not_eligible(spark, folder):
    assert "avg_disc" not in {r["feature"] for r in queries.queries()["eligible_features"](spark, folder).collect()}


def test_equal_averages_share_a_bin(spark, folder):
    assert [r["total"] for r in queries.queries()["woe_bin_report"](spark, folder).where("feature = 'avg_disc'").collect()] == [20]
