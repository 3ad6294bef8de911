"""The command line: batch run, then list / look up campaigns."""

import json
import os
import tempfile

from adsieve.__main__ import main
from adsieve.sources import fixtures as FX
from paths import SF001


def test_cli_batch_and_lookup(spark, capsys):
    root = tempfile.mkdtemp(prefix="adsieve-cli-", dir="/tmp")
    FX.kafka_messages(spark, SF001).write.parquet(os.path.join(root, "msgs"))
    out = os.path.join(root, "out")
    assert main(["batch", "--messages", os.path.join(root, "msgs"), "--out", out, "--batch-id", "1",
                 "--ip-window", "21600", "--ip-threshold", "5"]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["statuses"]["accepted"] > 0
    assert main(["campaigns", "--out", out, "--id", "cmp-3", "--json"]) == 0
    body = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert body["data"]["campaign_id"] == "cmp-3"
    assert main(["campaigns", "--out", out, "--id", "nope", "--json"]) == 1
    assert main(["campaigns", "--out", out, "--id", "", "--json"]) == 2
    assert main(["campaigns", "--out", out, "--json"]) == 0
    listing = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["data"]
    hours = [r["hour_bucket"] for r in listing]
    assert hours == sorted(hours, reverse=True) and all(h.endswith(":00:00Z") for h in hours)
    assert main(["campaigns", "--out", out, "--write", os.path.join(root, "listing")]) == 0
    written = spark.read.json(os.path.join(root, "listing"))
    assert written.count() == len(listing)
    # before the first batch the list is null
    capsys.readouterr()
    assert main(["campaigns", "--out", os.path.join(root, "none"), "--json"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["data"] is None
