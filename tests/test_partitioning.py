"""Tasks follow the size of the stored inputs; results do not."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest

from clientbook.operators import partitioning
from clientbook.plans import registry
from clientbook.sources.star_schema import COLUMNS
from tests.conftest import CFG
from tests.test_scale import final_plan


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A small star schema; some lines have no part, some orders no customer, some keys come twice."""
    folder, draw = str(tmp_path_factory.mktemp("star")), random.Random(7)
    last = dt.datetime.combine(CFG.snapshot_date, dt.time())
    orders = [
        (i % 1900, draw.choice([None, *range(60)]), last - dt.timedelta(days=draw.randint(-5, 500)), draw.choice(["1-URGENT", "5-LOW", None]))
        for i in range(2000)
    ]
    lines = [
        (draw.randint(0, 1950), draw.choice([None, *range(30)]), i % 7, draw.randint(100, 90000) / 100, draw.randint(0, 10) / 100, "N")
        for i in range(6000)
    ]
    tables = {
        "region": [(0, "EAST")],
        "nation": [(i, f"N{i}", 0) for i in range(5)],
        "customer": [(i, f"C{i}", i % 5, "FURNITURE") for i in range(55)],
        "part": [(i, f"KIND{i % 6}") for i in range(28)],
        "orders": orders,
        "lineitem": lines,
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, COLUMNS[name]).write.parquet(f"{folder}/{name}.parquet")
    return folder


def spread(spark, stored, monkeypatch, task_bytes):
    """Rows of the trend query, and the partition counts of the plan's shuffles by order and by customer."""
    monkeypatch.setattr(partitioning, "TASK_BYTES", task_bytes)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.queries()["health_trend_6m"](spark, stored)
        rows, text = sorted(map(str, df.collect())), final_plan(df)
        counts = [
            {int(n) for n in re.findall(rf"hashpartitioning\({key}#\d+L?, (\d+)\), REPARTITION_BY_NUM", text)}
            for key in ("[lo]_orderkey", "customer_id")
        ]
        return rows, *counts
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_trend_is_cut_by_the_size_of_its_input(spark, stored, monkeypatch):
    rows, orders, customers = spread(spark, stored, monkeypatch, partitioning.TASK_BYTES)
    assert len(rows) == 55 and orders == customers == set()  # small: left to the planner
    again, some_orders, some_customers = spread(spark, stored, monkeypatch, 8000)
    finer, more_orders, more_customers = spread(spark, stored, monkeypatch, 4000)
    assert rows == again == finer
    for some, more in ((some_orders, more_orders), (some_customers, more_customers)):
        assert len(some) == len(more) == 1 and 2 * min(some) - 1 <= min(more) <= 2 * min(some)


def test_small_or_unknown_sizes_are_left_to_spark(spark):
    size = partitioning.TASK_BYTES
    assert partitioning.tasks_for(None, 4) is partitioning.tasks_for(0, 4) is partitioning.tasks_for(4 * size, 4) is None
    assert partitioning.tasks_for(4 * size + 1, 4) == 5 and partitioning.tasks_for(1000 * size, 4) == 1000
    made = spark.sparkContext.parallelize([(1,)]).toDF("n int")
    assert partitioning.stored_bytes(made) is None
    assert partitioning.by_key(made, None, "n").count() == 1
