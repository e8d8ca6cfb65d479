"""Frame files cut anywhere give the frames of the whole file."""

import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from siltwave.plans import adapters, registry
from siltwave.sources import files, frames

KINDS = [0x0000, 0x1000, 0x2000, 0x3000, 0x4000, 0x5000, 0x6000, 0x6400, 0x7000, 0x7800]


def random_words(rng, n):
    """Runs of words of one kind, short and long; headers of both modes, and payload that looks like anything."""
    out = []
    while len(out) < n:
        kind = rng.choice(KINDS)
        out += [kind | rng.randrange(0x400) | rng.choice([0, 0x8000]) for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 8, 64]))]
    return np.array(out[:n], ">u2").tobytes()


def tidy(frame):
    return {k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in frame.items() if k != "cut"}


def by_ranges(content, chunk, ahead):
    size, state, number, out = len(content), frames.OUTSIDE, 0, []
    for at in range(0, size // 2 * 2, chunk):
        stop = min(at + chunk, size // 2 * 2)
        after, begun = frames.Machine(content[at:stop]).map()
        own = [tidy(f) for f in frames.frames_of_range(lambda i, j: content[i:j], at, stop, size, state, ahead)]
        assert len(own) == begun[state]
        out += own
        state, number = after[state], number + begun[state]
    return out


@pytest.mark.parametrize("seed", range(12))
def test_any_cut_gives_the_frames_of_the_whole(seed):
    rng = random.Random(seed)
    content = random_words(rng, rng.randrange(2, 900)) + rng.choice([b"", b"\x60"])
    whole = [tidy(f) for f in files.decode_words(content)]
    for chunk in (2, 4, 6, 10, 34, 130, 1000, 10_000):
        assert by_ranges(content, chunk, rng.choice([2, 8, 64])) == whole


def test_maps_are_those_of_each_state():
    rng = random.Random(1)
    for _ in range(50):
        machine = frames.Machine(random_words(rng, rng.randrange(0, 60)))
        after, begun = machine.map()
        for state in range(frames.STATES):
            first, last = machine.run(state)
            assert (after[state], begun[state]) == (last, len(first))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("frames"))
    made = adapters.encoded_frames(spark, "/root/testdata/sf0.001").withColumn("path", F.format_string("run/f_%03d_%02d.fdf", "file_num", "feu"))
    assert frames.write_frame_files(made, base).count() == made.count()
    rng = random.Random(4)
    for k, n in ((900, 50_000), (901, 0), (902, 1)):
        with open(f"{base}/run/odd_{k}_09.fdf", "wb") as f:
            f.write(random_words(rng, n))
    with open(f"{base}/run/unnumbered.fdf", "wb") as f:
        f.write(random_words(rng, 300) + b"\x60")
    with open(f"{base}/run/notes.txt", "w") as f:
        f.write("no frames")
    return base


def table(df):
    return sorted((tuple(r.asDict().values()) for r in df.withColumn("path", F.regexp_replace("path", "^file:/*", "/")).collect()), key=repr)


@pytest.mark.parametrize("chunk", [62, 4096, 8 << 20])
def test_decoded_ranges_equal_decoded_files(spark, folder, chunk):
    base = folder if chunk > 62 else f"{folder}/run/f_000_00.fdf"
    whole = table(files.decode(files.read_frames(spark, [base] if chunk <= 62 else [f"{base}/run"])))
    assert table(frames.decode_files(spark, base, chunk)) == whole and len(whole) > 100


def test_one_file_spreads_over_ranges(spark, folder):
    own = frames.read_chunks(spark, folder, 1024).filter("file_num = 900")
    assert own.rdd.getNumPartitions() == own.count() == 98
    assert own.agg(F.sum(F.col("stop") - F.col("start"))).first()[0] == 100_000


def test_filters_decide_which_files_are_opened(spark, folder, tmp_path):
    base = str(tmp_path)
    for k in range(6):
        with open(f"{base}/x_{k:03d}_{k % 3:02d}.fdf", "wb") as f:
            f.write(b"\x60\x00" * (k + 1))
    chunks = frames.read_chunks(spark, base, content=True)
    assert [(r.feu, len(r.content)) for r in chunks.filter("feu = 1").orderBy("file_num").collect()] == [(1, 4), (1, 10)]
    assert chunks.filter("file_num in (0, 4) and size > 3").count() == 1
    reader = frames.FrameFilesReader({"path": base})
    left = list(reader.pushFilters([frames.EqualTo(("feu",), 2), frames.EqualTo(("size",), 3)]))
    assert [f.attribute for f in left] == [("size",)] and [r[1] for p in reader.partitions() for r in p.rows] == [2, 5]
    os.chmod(f"{base}/x_000_00.fdf", 0)  # only root could open it; the plan doesn't try
    assert chunks.filter("feu = 2").count() == 2
    assert frames.read_chunks(spark, base, content=True, pattern="none").count() == 0


@pytest.mark.parametrize("name", ["d7_frames_by_ranges", "s1_frame_source"])
def test_more_files_than_three_digits_count(spark, tmp_path, name):
    con = duckdb.connect()
    con.execute(f"copy (select * replace (event_id % 250 + 500 * [998, 1000, 1003, 72000][1 + event_id // 250] as event_id) from '/root/testdata/sf0.001/events.parquet' where event_id < 1000) to '{tmp_path}/events.parquet'")
    con.execute(f"create view events as from '{tmp_path}/events.parquet'")
    found = con.execute(registry.ORACLES[name])
    names = [d[0] for d in found.description]
    want = found.fetchall()
    assert sorted(map(tuple, registry.QUERIES[name](spark, str(tmp_path)).select(*names).collect())) == sorted(want) and max(r[0] for r in want) > 999


def test_short_ranges_share_tasks(spark, folder, tmp_path):
    with open(f"{tmp_path}/x_001_02.fdf", "wb") as f:
        f.write(random_words(random.Random(2), 500_000))
    with open(f"{tmp_path}/x_002_02.fdf", "wb") as f:
        f.write(random_words(random.Random(3), 77) + b"\x60")
    reader = frames.FrameFilesReader({"path": str(tmp_path), "chunkbytes": "64", "content": "false"})
    parts = reader.partitions()
    assert 90 < len(parts) <= 101  # of 15,628 ranges
    ranges = [r for p in parts for r in reader.read(p)]
    assert [r[3:6] for r in ranges if r[1] == 1] == [(k, 64 * k, min(64 * k + 64, 1_000_000)) for k in range(15_625)]
    assert [r[3:] for r in ranges if r[1] == 2] == [(0, 0, 64, 155), (1, 64, 128, 155), (2, 128, 154, 155)]
    decoded = frames.decode_files(spark, f"{folder}/run", 4096)
    assert decoded.rdd.getNumPartitions() == frames.read_chunks(spark, f"{folder}/run", 4096).rdd.getNumPartitions() > 20


@pytest.mark.parametrize("most", [1, 300, 1 << 18])
def test_frames_of_a_range_in_groups(most):
    content = random_words(random.Random(11), 5000)
    whole = [tidy(f) for f in files.decode_words(content)]
    groups = list(frames.columns_of_range(lambda i, j: content[i:j], 0, 10_000, len(content), frames.OUTSIDE, most=most))
    assert (len(groups) > 5) == (most < 1 << 18)
    for c in ("event_id", "timestamp", "sample_id", "ftst", "zs", "eoe", "bad_blocks"):
        assert np.concatenate([g[c] for g in groups]).tolist() == [f[c] for f in whole]
    for c in ("channel", "amplitude"):
        assert np.concatenate([g[c] for g in groups]).tolist() == sum((f[c] for f in whole), [])
    assert np.concatenate([g["n_data"] for g in groups]).tolist() == [len(f["channel"]) for f in whole]
