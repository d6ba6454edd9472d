"""What steps leave in the driver is given back, between rounds too."""

import re
from pathlib import Path

from pageloom import session
from pageloom.operators import graph


def private_mb(spark):
    pid = spark.sparkContext._jvm.java.lang.ProcessHandle.current().pid()
    return int(re.search(r"Pss_Anon:\s+(\d+)", Path(f"/proc/{pid}/smaps_rollup").read_text())[1]) / 1024


def test_settle_gives_native_memory_back(spark):
    jvm = spark.sparkContext._jvm
    made = [jvm.java.util.zip.Deflater() for _ in range(1500)]  # some 260 KB of malloc each
    for x in made:
        x.setInput(b"a" * 100)
        x.finish()
        x.deflate(bytearray(100))
    for k, x in enumerate(made):
        if k % 25:
            x.end()
    before = private_mb(spark)
    session.settle(spark)
    after = private_mb(spark)
    for x in made:
        x.end()
    assert after < before - 100


def test_rounds_of_components_settle(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(graph, "settle", calls.append)
    edges = spark.range(300).selectExpr("id AS src", "id + 1 AS dst")
    got = graph.connected_components(edges).toPandas()
    assert len(got) == 301 and (got["component"] == 0).all()
    assert calls
