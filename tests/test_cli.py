"""The command line runs the jobs in the active session."""

import json
import os
import tempfile

from seatcast.__main__ import main
from seatcast.sources import store


def test_ingest_check_alerts_and_rules(spark, capsys):
    base = tempfile.mkdtemp(prefix="cli-")
    d = os.path.join(base, "landing", "snapshot_date=2024-01-01", "city=Oslo")
    os.makedirs(d)
    page = {"page": {"number": 0, "totalPages": 1}, "_embedded": {"events": [
        {"id": "e1", "name": "Show", "priceRanges": [{"min": 10.0, "max": 20.0}],
         "_embedded": {"attractions": [{"name": "Band"}]}}]}}
    with open(os.path.join(d, "p0.json"), "w") as f:
        f.write(json.dumps(page) + "\n")
    rules = os.path.join(base, "alerts.json")
    with open(rules, "w") as f:
        json.dump([{"target_price": 15.0, "created_at": "2024-01-01 10:00:00",
                    "triggered": False, "artist_name": "band"}], f)
    st = os.path.join(base, "store")
    assert main(["ingest", "--landing", os.path.join(base, "landing"), "--store", st,
                 "--state", os.path.join(base, "ingest-state")]) == 0
    assert [r.event_id for r in store.read_store(spark, st).collect()] == ["e1"]
    assert main(["check-alerts", "--store", st, "--rules", rules, "--dry-run",
                 "--as-of", "2024-01-01 09:00:00"]) == 0
    # the same from kept state, after streaming into another store
    kept, other = os.path.join(base, "state"), os.path.join(base, "other")
    assert main(["stream", "--landing", os.path.join(base, "landing"), "--store", other,
                 "--work", os.path.join(base, "work"), "--state", kept]) == 0
    assert main(["check-alerts", "--store", other, "--rules", rules, "--dry-run",
                 "--as-of", "2024-01-01 09:00:00", "--state", kept]) == 0
    marts = os.path.join(base, "marts")
    assert main(["build-marts", "--store", other, "--out", marts, "--state", kept]) == 0
    assert spark.read.parquet(f"{marts}/price_curves").count() == 0  # its event has no date
    assert main(["rules", "--rules", rules]) == 0
    out = capsys.readouterr().out
    assert out.count("Price Alert: 1 ticket(s) hit your target!") == 2
    assert "Current price: $10 (target: $15)" in out.replace("\\n", "\n")
    assert "band" in out and "active" in out
    assert not os.path.exists(os.path.join(base, "v2"))       # dry run saves nothing
