"""Rules with keys that small tables hide: units, entries of one event id, folders and files."""

from pyspark.sql import functions as F

from siltwave.operators import catalog, qa
from siltwave.plans import registry
from siltwave.sources import files

SF = "/root/testdata/sf0.001"


def test_hits_take_the_first_entry_of_their_event_and_the_pedestal_of_their_unit(spark):
    hits = spark.createDataFrame([(1, 7, 3), (2, 7, 3), (1, 7, 4), (1, 8, 3), (1, 9, 3)], "feu int, eventId long, channel int")
    lists = "feu int, eventId long, entry long, ftst int, channel array<int>, sample array<int>, amplitude array<int>"
    events = spark.createDataFrame([(1, 7, 5, 2, [3, 9, 3], [0, 0, 1], [10, 11, 12]), (1, 7, 6, 0, [3, 4], [0, 0], [90, 91]), (2, 7, 5, 1, [3], [4], [20]), (1, 8, 7, 0, None, None, None)], lists)
    peds = spark.createDataFrame([(1, 3, 100.0, 5.0), (2, 3, 200.0, 6.0)], "feu int, channel int, mean double, rms double")
    out = qa.with_waveforms(hits, events, peds, ["feu", "eventId"], ["feu"])
    got = {(r.feu, r.eventId, r.channel): (r.entry, r.ftst, [tuple(x) for x in r.wf or []], r.mean, r.rms) for r in out.collect()}
    assert got == {
        (1, 7, 3): (5, 2, [(0, 10), (1, 12)], 100.0, 5.0), (2, 7, 3): (5, 1, [(4, 20)], 200.0, 6.0),
        (1, 7, 4): (5, 2, [], 0.0, 1.0), (1, 8, 3): (7, 0, [], 100.0, 5.0),  # channel 4 has samples in a later entry only; event 9 isn't there
    }


def test_bucketed_tables_join_without_a_shuffle(spark):
    hits, events, peds = registry.q8_tables(spark, SF)
    hits, events = files.write_bucketed(hits, ["feu", "event"], 8), files.write_bucketed(events, ["feu", "event"], 8, ("entry",))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = qa.with_waveforms(hits, events, peds.limit(0), ["feu", "event"], ["feu"])
        met = hits.join(events.groupBy("feu", "event").agg(F.min("entry").alias("entry")), ["feu", "event"])
        assert met.count() > 0 and out.count() == met.count()
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pedestal_folders(spark):
    df = spark.createDataFrame([("same", "x"), ("abs", "x"), ("find", " run_7\n"), ("find", None), ("find", " "), ("other", "x")], "c string, n string")
    out = [r[0] for r in df.select(catalog.pedestal_folder(F.col("c"), F.lit("/d"), F.lit("/p/"), F.col("n"))).collect()]
    assert out == ["/d", "/p/", "/p/run_7/pedestals", None, "/p/pedestals", None]


def test_unions_stay_in_their_folder(spark):
    names = ["/r1/a_datrun_001_03.x", "/r1/a_datrun_001_04.x", "/r2/a_datrun_001_03.x", "/r1/a_datrun_001_01.x", "/r1/b_datrun_001_04.x", "/r1/unnumbered.x"]
    out = catalog.combined_groups(catalog.catalogue(spark.createDataFrame([(n,) for n in names], "path string")))
    got = {(r.folder, r.file_num): (r.paths, r.combined) for r in out.collect()}
    assert got == {("/r1", 1): ([names[0], names[4]], "a_datrun_001_feu-combined.x"), ("/r2", 1): ([names[2]], "a_datrun_001_feu-combined.x")}


def test_periods_are_those_of_each_file(spark):
    rows = spark.createDataFrame([("a", 0), ("a", 5), ("b", 3), ("c", None)], "file string, ftst int")
    assert sorted(map(tuple, qa.sample_period(rows, ["file"]).collect())) == [("a", 5, 60), ("b", 3, 40), ("c", 0, 10)]
