"""Frame files in byte ranges: a data source for them, and decoding that cuts a file anywhere.

A file is a string of 16-bit words that only make sense in order, since payload can look like a header. But what the order
decides is small: before each word the reader is in one of nine states. So each range of a file is first read from every state
at once (runs of words of one class move all states together, and most fall together after a few words), which gives a map
from the state before the range to the state after it, with the frames that begin in between. The maps of a file are composed
in order; then every range knows its state and the number of its first frame, and is decoded by itself, reading on past its
end until its last frame is complete.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from .files import FRAMES, Words, field_of, file_system

NUMBERED = re.compile(r"^.*_(\d{3})_(\d{2})", re.S)  # the last such place in a path: file number and unit
CHUNKS = "path string, file_num int, feu int, chunk int, start bigint, stop bigint, size bigint"
#: Before a word: outside frames, in a header (sparse or dense frame), in a sparse frame at or within a pair, in a dense frame outside
#: blocks, in the words that open a block, in the words of a block, and before the word that follows a trailer.
OUTSIDE, HEAD_SPARSE, HEAD_DENSE, SPARSE, PAIR, DENSE, OPENING, BLOCK, SKIP = range(9)
STATES = 9
PARTITION = 8 << 20  # bytes of the ranges that a task reads, however short these are


def read_range(path: str, start: int, stop: int) -> bytes:
    fs, inner = file_system(path)
    with fs.open_input_file(inner) as f:
        f.seek(start)
        return f.read(stop - start)


def list_frame_files(path: str, pattern: str = r"\.fdf$") -> list[tuple[str, int]]:
    """Files below a folder, or the file itself, with their sizes; those without a word are left out."""
    fs, inner = file_system(path)
    info = fs.get_file_info(inner)
    found = [info] if info.type == arrow_fs.FileType.File else fs.get_file_info(arrow_fs.FileSelector(inner, recursive=True))
    scheme = path.partition("://")[0] + "://" if "://" in path and not path.startswith("file:") else ""
    return sorted((scheme + x.path, x.size) for x in found if x.type == arrow_fs.FileType.File and x.size >= 2 and re.search(pattern, x.path))


class Range(InputPartition):
    def __init__(self, rows: list[tuple]):
        self.rows = rows


class FrameFilesReader(DataSourceReader):
    """Ranges of the files that the filters on file number, unit and path leave; a range is a row, with or without its bytes."""

    def __init__(self, options: dict):
        self.path, self.pattern = options["path"], options.get("pattern", r"\.fdf$")
        self.chunk = max(2, int(options.get("chunkbytes", 8 << 20)) // 2 * 2)
        self.content = str(options.get("content", "true")).lower() == "true"
        self.wanted: list[tuple[int, set]] = []

    def pushFilters(self, filters):
        places = {("path",): 0, ("file_num",): 1, ("feu",): 2}
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute in places:
                self.wanted.append((places[f.attribute], set(f.value) if isinstance(f, In) else {f.value}))
            else:
                yield f

    def partitions(self):
        """Ranges share a partition until it has a hundredth of all bytes, 8 MB at most; a row is a stretch of ranges of one file."""
        wanted, out, held, filled = [], [], [], 0
        for path, size in list_frame_files(self.path, self.pattern):
            m = NUMBERED.match(path)
            own = (path, *(map(int, m.groups()) if m else (None, None)))
            if all(own[k] in values for k, values in self.wanted):
                wanted.append((*own, size))
        enough = max(self.chunk, min(PARTITION, sum(size // 2 * 2 for *_, size in wanted) // 100))
        for *own, size in wanted:
            at, end = 0, size // 2 * 2
            while at < end:
                stop = min(end, at + -(-(enough - filled) // self.chunk) * self.chunk)
                held.append((*own, at, stop, size))
                filled, at = filled + stop - at, stop
                if filled >= enough:
                    out.append(Range(held))
                    held, filled = [], 0
        return out + [Range(held)] * bool(held)

    def read(self, partition):
        for *own, first, end, size in partition.rows if partition else []:  # without any file Spark asks for one partition all the same
            for at in range(first, end, self.chunk):
                row = (*own, at // self.chunk, at, min(at + self.chunk, end), size)
                yield (*row, read_range(row[0], row[4], row[5])) if self.content else row


class FrameFiles(DataSource):
    """``spark.read.format("frame_files").option("chunkBytes", n).load(folder)``: see ``FrameFilesReader``."""

    @classmethod
    def name(cls) -> str:
        return "frame_files"

    def schema(self) -> str:
        return CHUNKS + (", content binary" if str(self.options.get("content", "true")).lower() == "true" else "")

    def reader(self, schema) -> DataSourceReader:
        return FrameFilesReader(dict(self.options))


def read_chunks(spark: SparkSession, path: str, chunk_bytes: int = 8 << 20, content: bool = False, pattern: str = r"\.fdf$") -> DataFrame:
    """Ranges of all frame files below ``path``; filters on ``file_num``, ``feu`` and ``path`` decide which files are opened."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FrameFiles)
    return spark.read.format("frame_files").option("chunkBytes", chunk_bytes).option("content", str(content).lower()).option("pattern", pattern).load(path)


def write_frame_files(files: DataFrame, base: str) -> DataFrame:
    """Write ``content`` of each row to ``path`` below ``base``, in tasks; a task that runs again writes the same file anew.

    Returns the paths that were written.
    """

    def run(batches):
        fs, inner = file_system(base)
        for b in batches:
            out = []
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                to = f"{inner}/{path.lstrip('/')}"
                fs.create_dir(os.path.dirname(to), recursive=True)
                with fs.open_output_stream(f"{to}.{os.getpid()}.part") as f:
                    f.write(content or b"")
                fs.move(f"{to}.{os.getpid()}.part", to)
                out.append(to)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["path"])

    return files.select("path", "content").mapInArrow(run, "path string")


class Machine:
    """The reader's state over runs of words: where frames begin, and the state after the last word."""

    def __init__(self, content: bytes):
        self.words = words = Words(content)
        self.stops = words.ends.tolist()
        self.kinds = words.kind[words.ends - 1].tolist() if len(words.w) else []
        self.sparse = field_of(words.w, "zs").astype(bool)

    def step(self, state: int, at: int, stop: int, kind: int):
        """From ``state`` over the words ``at`` to ``stop`` of one kind: the state after them, and the frame's first word if one begins."""
        if state in (SKIP, PAIR):
            state, at = OUTSIDE if state == SKIP else SPARSE, at + 1
            if at == stop:
                return state, None
        if kind == Words.HEAD:
            if state in (HEAD_SPARSE, HEAD_DENSE):
                return state, None
            return HEAD_SPARSE if self.sparse[at] else HEAD_DENSE, at
        if state == OUTSIDE:
            return state, None
        if kind == Words.TRAILER:
            return SKIP if stop - at == 1 else OUTSIDE, None
        if state in (HEAD_SPARSE, SPARSE):
            return PAIR if kind == Words.DATA and (stop - at) % 2 else SPARSE, None
        if kind == Words.OPENS:
            return OPENING, None
        return BLOCK if kind == Words.DATA and state in (OPENING, BLOCK) else DENSE, None

    def run(self, state: int):
        """Through all words from one state: the frames' first words, and the state at the end."""
        begun, at = [], 0
        for stop, kind in zip(self.stops, self.kinds):
            state, first = self.step(state, at, stop, kind)
            if first is not None:
                begun.append(first)
            at = stop
        return begun, state

    def map(self) -> tuple[list[int], list[int]]:
        """For every state before the first word the state after the last one, and how many frames begin in between."""
        now, of, counts = list(range(STATES)), list(range(STATES)), [0] * STATES  # now: distinct states; of: which of them each entry is in
        extra, at = [0] * STATES, 0
        for stop, kind in zip(self.stops, self.kinds):
            moved, begun = zip(*(self.step(s, at, stop, kind) for s in now))
            extra = [n + (b is not None) for n, b in zip(extra, begun)]
            if len(set(moved)) < len(moved):
                place = {s: k for k, s in enumerate(dict.fromkeys(moved))}
                for e in range(STATES):
                    counts[e] += extra[of[e]]
                    of[e] = place[moved[of[e]]]
                moved, extra = list(place), [0] * len(place)
            now, at = list(moved), stop
        return [now[of[e]] for e in range(STATES)], [counts[e] + extra[of[e]] for e in range(STATES)]


def chunk_maps(chunks: DataFrame) -> DataFrame:
    """``path, chunk, start, stop, size, file_num, feu, after, begun``: the map of each range, which reads its bytes itself."""

    def run(batches):
        for b in batches:
            maps = [Machine(read_range(p, i, j)).map() for p, i, j in zip(*(b.column(c).to_pylist() for c in ("path", "start", "stop")))]
            lists = [pa.array([m[k] for m in maps], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *lists], [*b.schema.names, "after", "begun"])

    return chunks.select(*[c.split(" ")[0] for c in CHUNKS.split(", ")]).mapInArrow(run, f"{CHUNKS}, after array<int>, begun array<int>")


def entry_states(maps: DataFrame) -> DataFrame:
    """``maps`` with ``state`` before each range and ``first_frame``, the number of frames before it; one small list for each file.

    A file's list has a row of nine pairs for each range, so a file of a terabyte in ranges of 8 MB has some 10 MB here.
    """
    row = F.struct("chunk", "start", "stop", "after", "begun")
    files = maps.groupBy("path", "file_num", "feu", "size").agg(F.sort_array(F.collect_list(row)).alias("c"))
    none = F.array().cast("array<struct<state:int,first_frame:bigint>>")
    start = F.struct(F.lit(OUTSIDE).alias("state"), F.lit(0).cast("long").alias("frames"), none.alias("seen"))

    def onwards(s, c):
        here = F.struct(s.state.alias("state"), s.frames.alias("first_frame"))
        return F.struct(c.after[s.state].alias("state"), (s.frames + c.begun[s.state]).cast("long").alias("frames"), F.concat(s.seen, F.array(here)).alias("seen"))

    seen = F.aggregate("c", start, onwards, lambda s: s.seen)
    rows = files.withColumn("z", F.explode(F.arrays_zip(F.col("c"), seen.alias("seen"))))
    return rows.select("path", "file_num", "feu", F.col("z.c.chunk").alias("chunk"), F.col("z.c.start").alias("start"), F.col("z.c.stop").alias("stop"), "size", F.col("z.seen.state").alias("state"), F.col("z.seen.first_frame").alias("first_frame"))


def first_frame(machine: Machine, state: int, n: int) -> int | None:
    """The first word, of the first ``n``, at which a frame begins, with the reader in ``state`` before them."""
    at = 0
    for stop, kind in zip(machine.stops, machine.kinds):
        state, first = machine.step(state, at, stop, kind)
        if first is not None or at >= n:
            return first if first is not None and first < n else None
        at = stop
    return None


class Outline:
    """Where the frames that begin at word ``at`` (a frame's first) up to word ``n`` lie in the words, by the rules of ``decode_words``.

    One step for each run of words of a class; the words themselves are taken out for many frames at once, by ``columns``.
    """

    def __init__(self, machine: Machine, at: int, n: int):
        self.words = words = machine.words
        stops, kinds, sparse, total = machine.stops, machine.kinds, machine.sparse.tobytes(), len(words.w)
        first, head, trailer, bad = [], [], [], []  # of each frame: first word, words of its header run, its trailer (-1: none), bad blocks
        frame, begin, count, chip = [], [], [], []  # of each run of data: its frame, first word, values, and chip (-1: pairs of words)
        r, inside, zs = int(np.searchsorted(words.ends, at, side="right")), False, False
        while r < len(stops):
            stop, kind = stops[r], kinds[r]
            r += 1
            if at >= stop:  # taken as the second word of a pair, or after a trailer
                continue
            if kind == Words.HEAD:
                inside = at < n
                if not inside:
                    break
                zs = sparse[at]
                first.append(at)
                head.append(stop - at)
                trailer.append(-1)
                bad.append(0)
                at = stop
            elif not inside:
                if at >= n:
                    break
                at = stop
            elif kind == Words.TRAILER:
                trailer[-1], inside = at, False
                at = max(stop, at + 2)
            elif zs and kind == Words.DATA:  # the second word of a pair is taken whatever its class
                pairs = (stop - at + (stop < total)) // 2
                frame.append(len(first) - 1)
                begin.append(at)
                count.append(pairs)
                chip.append(-1)
                at = max(stop, at + 2 * pairs)
            elif not zs and kind == Words.OPENS:
                frame.append(len(first) - 1)
                chip.append(int(field_of(int(words.w[at + 3]), "chip_raw")) if stop - at >= 4 else 0)
                begin.append(stop)
                at = stop
                if r < len(stops) and kinds[r] == Words.DATA:
                    at = stops[r]
                    r += 1
                count.append(at - stop)
                bad[-1] += at - stop != 64
            else:
                at = stop
        self.cut = inside  # the words ended before the last frame did
        self.first, self.head, self.trailer, self.bad = (np.array(x, np.int64) for x in (first, head, trailer, bad))
        self.frame, self.begin, self.count, self.chip = (np.array(x, np.int64) for x in (frame, begin, count, chip))
        self.n_data = np.bincount(self.frame, self.count, len(first)).astype(np.int64)

    def columns(self, k: int, stop: int) -> dict[str, np.ndarray]:
        """The fields of the frames ``k`` to ``stop`` as ``decode_words`` has them; channels and amplitudes one after another."""
        w, at = self.words.w, self.first[k:stop, None] + np.arange(8)
        h = np.where(np.arange(8) < self.head[k:stop, None], w[np.minimum(at, len(w) - 1)], 0).astype(np.int64)
        part, ends = field_of(h, "event_part"), self.trailer[k:stop]
        i, j = np.searchsorted(self.frame, [k, stop])
        count, chip = self.count[i:j], np.repeat(self.chip[i:j], self.count[i:j])
        within, pairs = np.arange(len(chip)) - np.repeat(np.cumsum(count) - count, count), chip < 0
        place = np.repeat(self.begin[i:j], count) + within * (1 + pairs)
        word = w[place]
        return {
            "event_id": part[:, 1] + (part[:, 4] << 12), "timestamp": part[:, 2] + (part[:, 5] << 12) + (part[:, 6] << 24) + ((h[:, 7] & 0xFF) << 36),
            "sample_id": ((h[:, 0] & 0x800) >> 3) + field_of(h[:, 3], "sample_id"), "ftst": (h[:, 3] & 7).astype(np.int32), "zs": field_of(h[:, 0], "zs").astype(bool),
            "eoe": (ends >= 0) & (field_of(w[ends], "end_of_event") > 0), "bad_blocks": self.bad[k:stop].astype(np.int32), "n_data": self.n_data[k:stop],
            "channel": np.where(pairs, field_of(word, "chip_zs").astype(np.int32) * 64 + field_of(word, "channel"), chip * 64 + within).astype(np.int32),
            "amplitude": field_of(w[place + pairs], "adc").astype(np.int32),
        }


def columns_of_range(read, start: int, stop: int, size: int, state: int, ahead: int = 1 << 16, most: int = 1 << 18):
    """The frames that begin in a range, whose reader is in ``state`` before it, as ``Outline.columns`` of some ``most`` values each.

    ``read(start, stop)`` gives bytes of the file. The last frame may end beyond the range, so as much more is read as it takes.
    """
    end = size // 2 * 2
    while True:
        upto, n = min(end, stop + ahead), (stop - start) // 2
        machine = Machine(read(start, upto))
        at = first_frame(machine, state, n)
        if at is None:
            return
        found = Outline(machine, at, n)
        again = found.cut and upto < end
        whole = len(found.first) - again
        groups = (np.cumsum(found.n_data[:whole] + 64) - 1) // most
        for own in np.split(np.arange(whole), np.flatnonzero(np.diff(groups)) + 1):
            if len(own):
                yield found.columns(int(own[0]), int(own[-1]) + 1)
        if not again:
            return
        start, state, ahead = start + 2 * int(found.first[-1]), OUTSIDE, 4 * ahead


def frames_of_range(read, start: int, stop: int, size: int, state: int, ahead: int = 1 << 16):
    """``columns_of_range`` as one dictionary for each frame, as ``decode_words`` has them."""
    for own in columns_of_range(read, start, stop, size, state, ahead):
        plain, at = {c: v.tolist() for c, v in own.items() if c not in ("channel", "amplitude", "n_data")}, np.cumsum(own["n_data"])
        for k, (n, upto) in enumerate(zip(own["n_data"].tolist(), at.tolist())):
            yield {c: v[k] for c, v in plain.items()} | {c: own[c][upto - n : upto] for c in ("channel", "amplitude")}


def decode_ranges(placed: DataFrame) -> DataFrame:
    """All frames of the files, as ``files.decode`` gives them, each range by itself; from ranges with ``state`` and ``first_frame``."""
    names = [c.split(" ")[0] for c in CHUNKS.split(", ")]
    kinds = {"file_num": pa.int32(), "feu": pa.int32()}

    def batch(r: dict, first: int, own: dict) -> pa.RecordBatch:
        n, stops = len(own["n_data"]), pa.array(np.append(0, np.cumsum(own["n_data"])).astype(np.int32))
        columns = {c: pa.repeat(pa.scalar(r[c], kinds.get(c, pa.string())), n) for c in ("path", "file_num", "feu")} | {"frame_idx": pa.array(first + np.arange(n))}
        columns |= {c: pa.ListArray.from_arrays(stops, pa.array(v)) if c in ("channel", "amplitude") else pa.array(v) for c, v in own.items()}
        return pa.RecordBatch.from_arrays([columns[c.split(" ")[0]] for c in FRAMES.split(", ")], [c.split(" ")[0] for c in FRAMES.split(", ")])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for r in b.to_pylist():
                first = r["first_frame"]
                for own in columns_of_range(lambda i, j, p=r["path"]: read_range(p, i, j), r["start"], r["stop"], r["size"], r["state"], min(1 << 16, r["stop"] - r["start"])):
                    held.append(batch(r, first, own))
                    first, size = first + len(own["n_data"]), size + 64 * len(own["n_data"]) + len(own["channel"])
                    if size >= 1 << 20:  # short ranges leave together
                        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                        held, size = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return placed.select(*names, "state", "first_frame").mapInArrow(run, FRAMES)


def decode_files(spark: SparkSession, path: str, chunk_bytes: int = 8 << 20, only=None) -> DataFrame:
    """Frames of all files below a folder, each file cut into ranges; ``only`` is a condition on file number, unit or path."""
    chunks = read_chunks(spark, path, chunk_bytes)
    chunks = chunks if only is None else chunks.filter(only)
    tasks = max(chunks.rdd.getNumPartitions(), 1)  # as many as read the ranges: by their few bytes they would all come to a task or two
    return decode_ranges(entry_states(chunk_maps(chunks)).repartition(tasks, F.col("path"), F.col("chunk")))
