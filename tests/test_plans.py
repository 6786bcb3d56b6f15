"""Plan guards: the physical plans keep the shape the design relies on."""

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seatcast.operators import alerts  # noqa: E402
from seatcast.plans import registry  # noqa: E402
from seatcast.plans import params as P  # noqa: E402
from seatcast.session import ensure_checkpoint_dir, write_scratch  # noqa: E402
from seatcast.sources import adapter, store  # noqa: E402
from seatcast.sources.rules import rules_frame  # noqa: E402

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_no_pair_joins_or_python_in_plans(spark, key):
    text = plan_text(registry.queries()[key](spark, SF))
    assert not [f for f in FORBIDDEN if f in text], text


def test_adapter_aggregates_events_before_the_shuffle(spark):
    text = plan_text(adapter.snapshots(spark, SF))
    first_exchange = text.index("Exchange hashpartitioning(user_id")
    partial = text.index("partial_min")
    assert partial > first_exchange      # printed below it, i.e. it runs before it
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" \
        in text or "ReadSchema: struct<user_id:bigint,ts:timestamp_ntz" in text


def test_newest_day_is_a_partition_filter_on_the_store(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="plan-store-"), "s")
    store.upsert_days(adapter.snapshots(spark, SF), path)
    day = store.newest_day(spark, path)
    assert day == adapter.newest_day(spark, SF)
    df = alerts.latest_snapshot(store.read_store(spark, path), day).select("event_id")
    text = plan_text(df)
    assert "PartitionFilters: [isnotnull(snapshot_date" in text and str(day) in text
    assert df.count() > 0


def test_alert_plans_read_the_events_once(spark):
    # the newest day's rows are written once; what follows reads them
    raw = adapter.snapshots(spark, SF)
    today = write_scratch(alerts.latest_snapshot(raw, adapter.newest_day(spark, SF)), "day")
    hits = alerts.price_alerts(today, rules_frame(spark, P.RULES))
    assert "events.parquet" not in plan_text(hits)
    assert plan_text(alerts.latest_anomalies(raw, today)).count("events.parquet") == 1


def test_no_private_folder_off_a_local_master():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
