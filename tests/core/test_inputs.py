"""Hit files of every state: read as one scan, judged by their footers."""

import os

from siltwave import schemas
from siltwave.plans import jobs
from siltwave.sources import inputs

SCHEMA = "eventId bigint, channel int, amplitude double, trunc_left boolean, trunc_right boolean, significance double"


def table(spark, rows, columns=SCHEMA):
    return spark.createDataFrame(rows, columns).coalesce(1)


def folder(spark, base):
    """One file of each kind: path by kind."""
    hit = [(1, 2, 3.0, True, None, 4.0), (2, 3, 4.0, False, True, None)]
    kinds = {
        "current": table(spark, hit), "old": table(spark, [r[:3] for r in hit], "eventId bigint, channel int, amplitude double"),
        "partly": table(spark, [(5, 6, 7.0, True)], "eventId bigint, channel int, amplitude double, trunc_left boolean"),
        "narrow": table(spark, [(7, 8, 2.0)], "eventId int, channel smallint, amplitude float"), "foreign": table(spark, [(1, "x")], "a int, b string"),
        "typed": table(spark, [(1, "two", 3.0)], "eventId bigint, channel string, amplitude double"), "none": table(spark, []),
    }
    out = {}
    for kind, df in kinds.items():
        df.write.parquet(f"{base}/{kind}")
        out[kind] = next(f"{base}/{kind}/{f}" for f in os.listdir(f"{base}/{kind}") if f.endswith(".parquet"))
    with open(out["current"], "rb") as f:
        content = f.read()
    for kind, data in {"broken": b"PAR1 not a table", "cut": content[:-40], "empty": b""}.items():
        out[kind] = f"{base}/{kind}.parquet"
        with open(out[kind], "wb") as f:
            f.write(data)
    return out | {"missing": f"{base}/missing.parquet"}


def test_health_and_union(spark, tmp_path):
    paths = folder(spark, str(tmp_path))
    listed = spark.createDataFrame([(p, i) for i, p in enumerate(paths.values())] + [("file:" + paths["old"], 40), (None, 1)], "path string, feu int")
    found = inputs.health(listed, SCHEMA)
    got = {(r.path, r.feu): (r.readable, r.usable, r.rows, r.old) for r in found.collect()}
    want = {"current": (True, True, 2, False), "old": (True, True, 2, True), "partly": (True, True, 1, True), "narrow": (True, True, 1, True), "foreign": (True, False, 1, None), "typed": (True, False, 1, None), "none": (True, True, 0, False)}
    bad = (False, False, None, None)
    assert got == {(p, i): want.get(k, bad) for i, (k, p) in enumerate(paths.items())} | {("file:" + paths["old"], 40): want["old"], (None, 1): bad}
    rows = sorted(map(tuple, inputs.read_inputs(spark, found, SCHEMA).drop("path").select("eventId", "channel", "amplitude", "trunc_left", "trunc_right", "significance", "feu").collect()), key=str)
    old = [(1, 2, 3.0, False, False, -1.0), (2, 3, 4.0, False, False, -1.0)]
    assert rows == sorted([(1, 2, 3.0, True, None, 4.0, 0), (2, 3, 4.0, False, True, None, 0), *[(*r, k) for r in old for k in (1, 40)], (5, 6, 7.0, True, False, -1.0, 2), (7, 8, 2.0, False, False, -1.0, 3)], key=str)


def test_the_plan_does_not_grow_with_the_files(spark, tmp_path):
    def scans(n):
        base = f"{tmp_path}/n{n}"
        spark.range(n).selectExpr("id k", "id eventId", "cast(id as int) channel", "double(id) amplitude").repartition("k").write.partitionBy("k").parquet(base)
        listed = spark.createDataFrame([(f"{d}/{f}", int(d.rpartition("=")[2])) for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")], "path string, feu int")
        out = inputs.read_inputs(spark, inputs.health(listed, SCHEMA), SCHEMA)
        assert out.count() == n and listed.count() == n
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Relation"), plan.count("\n")

    assert scans(3) == scans(40)


def test_no_usable_file_gives_no_rows(spark, tmp_path):
    found = inputs.health(spark.createDataFrame([(f"{tmp_path}/nothing", 1)], "path string, feu int"), SCHEMA)
    assert inputs.read_inputs(spark, found, SCHEMA).count() == 0
    assert inputs.health(spark.createDataFrame([], "path string, feu int"), SCHEMA).count() == 0


def test_files_to_clusters(spark, tmp_path):
    rows = [("r", "s", 1, 3, 1, 1, 10, c, 0, *[1.0] * 12, False, False, False) for c in (0, 1, 5)]
    spark.createDataFrame(rows, schemas.HITS).coalesce(1).write.parquet(f"{tmp_path}/good")
    good = next(f"{tmp_path}/good/{f}" for f in os.listdir(f"{tmp_path}/good") if f.endswith(".parquet"))
    (tmp_path / "bad.parquet").write_bytes(b"nothing")
    strips = spark.createDataFrame([(k, 0, k, "x", float(k), 0.0) for k in range(8)], "line_no long, connector int, connectorChannel int, axis string, x double, y double")
    clusters, found = jobs.files_to_clusters(spark.createDataFrame([(good, 3), (f"{tmp_path}/bad.parquet", 4)], "path string, feu int"), strips, ["path", "entry"])
    assert sorted((r.cluster_id, r.n_hits) for r in clusters.collect()) == [(0, 2), (1, 1)]
    assert sorted((r.feu, r.usable) for r in found.collect()) == [(3, True), (4, False)]
