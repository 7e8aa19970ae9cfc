"""The command-line jobs, configured only through environment variables."""

import json
import os
import subprocess
import sys

from conftest import ROOT


def _run(args, env, timeout=600):
    out = subprocess.run([sys.executable, "-m", "lakelens.cli", *args], cwd=ROOT, env=env, capture_output=True,
                         text=True, timeout=timeout)
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_batch_ingest_and_lake_maintain_from_env(spark, scratch):
    watch = os.path.join(scratch, "incoming")
    os.makedirs(watch)
    for name, data in {"a.jpg": b"one", "b.png": b"two", "c.gif": b"one", "d.txt": b"no"}.items():
        with open(os.path.join(watch, name), "wb") as fh:
            fh.write(data)
    env = dict(os.environ, WATCH_PATH=watch, LAKELENS_TOPIC_ROOT=f"{scratch}/topics",
               LAKELENS_OBJECT_ROOT=f"{scratch}/objects", LAKELENS_METADATA_TABLE=f"{scratch}/t1",
               LAKELENS_DEAD_LETTER_TABLE=f"{scratch}/dlq")
    counters = _run(["batch-ingest", "--checkpoint", f"{scratch}/ck", "--as-of", "2000-01-01"], env)
    assert counters["produced"] == 3 and counters["inserted"] == 2
    again = _run(["batch-ingest", "--checkpoint", f"{scratch}/ck", "--as-of", "2000-01-01"], env)
    assert again["produced"] == 0 and again["inserted"] == 0

    from lakelens.sinks import tables
    from lakelens.sources import fixtures as fx
    from conftest import SF_SMALL
    lake = f"{scratch}/lake"
    tables.commit_lake(spark, fx.lake_change_log(spark, SF_SMALL), lake)
    out = _run(["lake-maintain", "--table", lake, "--out", f"{scratch}/lake2", "--as-of", "2024-02-10 00:00:00",
                "--max-records-per-file", "100"], env)
    assert out["expired_before"] == "2024-02-03 00:00:00"
    rewritten = spark.read.parquet(f"{scratch}/lake2")
    assert rewritten.count() < spark.read.parquet(lake).count()
