"""Near-duplicates by SimHash, with pigeonring filtering of candidates.

A 64-bit fingerprint is a ring of four 16-bit segments. If two fingerprints differ in at most 3 bits, some segment
starts a chain whose first 1, 2, 3 and 4 segments differ in at most 3/4, 6/4, 9/4 and 12/4 bits: that is 0, 1, 2 and 3.
So the first segment is equal and the second differs in one bit at most, hence one of its two bytes is equal. Equal
segment, place and byte make the key under which fingerprints meet (24 bits, eight keys each); the later steps of the
chain and then the whole Hamming distance are checked on what meets.

For up to 7 bits the ring has eight 8-bit segments with budgets 0, 1, 2, ...: the first is equal, and of the four
half-bytes of the next two, either the first two are equal or one of each two (16 bits, forty keys each).

Copies are collapsed to distinct fingerprints first. What meets under one key isn't written out as pairs: a bucket gives
a spanning forest of its links, found block by block, and buckets over ``block`` rows are dealt out as pairs of blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import materialise, pieces, texts

SMALL = 512  # buckets up to this size are worked on together, larger ones one by one


def ring_plan(most: int) -> tuple[int, list[tuple[int, int]]]:
    """The number of segments for ``most`` bits, and for each key where its chain starts and the bits that it holds."""
    if most > 7:
        raise ValueError("the keys hold for up to 7 differing bits")
    segments = 4 if most < 4 else 8
    width = 64 // segments
    # pieces of the segments after the first, of which a key takes one, or two
    after = [(16,), (24,)] if segments == 4 else [(8, 12), (8, 16), (8, 20), (12, 16), (12, 20)]
    piece = width // 2
    plan = []
    for i in range(segments):
        for places in after:
            mask = sum(((1 << piece) - 1) << p for p in places) | (1 << width) - 1
            turned = (mask << width * i | mask << width * i >> 64) & (1 << 64) - 1
            plan.append((i, turned))
    return segments, plan


def fingerprint(text: str, size: int = 3, seed: int = 42) -> int:
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) < size:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        joined, digest = b" ".join(words), xxhash.xxh64_intdigest
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], stops[:-1] + 1])
        hashes = [digest(joined[i:j], seed) for i, j in zip(starts[: len(words) - size + 1].tolist(), stops[size - 1 :].tolist())]
    n, ones = len(hashes), np.zeros(64, np.int64)
    bits = np.array(hashes, "<u8").view(np.uint8).reshape(n, 8)
    for k in range(0, n, 1 << 16):
        ones += np.unpackbits(bits[k : k + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_key: Column | None = None, size: int = 3) -> DataFrame:
    """``doc_id, fp`` (a signed long) of ``size``-word shingles for every whole text; null or wordless texts have fp 0.

    ``row_key``, a long, is carried along under that name. Repeated rows repeat; other columns aren't read.
    """

    def run(batches):
        for b in pieces(batches):
            fp = np.array([fingerprint(x, size) for x in texts(b)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fp)], [*b.schema.names[1:], "fp"])

    key = [] if row_key is None else [row_key.cast("long").alias("row_key")]
    picked = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"), *key)
    return picked.mapInArrow(run, "doc_id long, " + "row_key long, " * len(key) + "fp long")


def ring_keys(nodes: DataFrame, most: int = 3, fp: str = "fp") -> DataFrame:
    """One row for each key of a fingerprint: ``k``, which key of the plan, and ``v``, the bits that it holds."""
    signed = [m - (1 << 64) if m >> 63 else m for _, m in ring_plan(most)[1]]
    keys = F.array(*[F.struct(F.lit(k).cast("int").alias("k"), F.col(fp).bitwiseAND(F.lit(m).cast("long")).alias("v")) for k, m in enumerate(signed)])
    return nodes.withColumn("key", F.explode(keys)).select(*nodes.columns, "key.k", "key.v")


def _distance(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)


def _chained(place, differ: np.ndarray, most: int) -> np.ndarray:
    """Which differences stay within the budgets of the chain from segment ``place`` (one or an array), then in all bits."""
    segments = ring_plan(most)[0]
    width, alive = 64 // segments, np.arange(len(differ))
    ones, spent = np.uint64((1 << width) - 1), np.zeros(len(differ), np.int16)
    for step in range(segments - 1):
        at = place if np.ndim(place) == 0 else place[alive]
        shift = (width * ((np.asarray(at) + step) % segments)).astype(np.uint64)
        spent = spent + _distance((differ[alive] >> shift) & ones)
        ok = spent * segments <= (step + 1) * most
        alive, spent = alive[ok], spent[ok]
    return alive[_distance(differ[alive]) <= most]


def forest(place: int, fps: np.ndarray, most: int = 3) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one bucket, as index pairs.

    Each visited fingerprint is held against those not reached yet, so a dense group costs little more than one pass.
    """
    fps, edges = fps.view(np.uint64), []
    rest = np.arange(len(fps))
    while len(rest) > 1:
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            i = front.pop()
            near = _chained(place, fps[i] ^ fps[rest], most)
            if len(near):
                found = rest[near].tolist()
                edges += [(i, j) for j in found]
                front += found
                rest = np.delete(rest, near)
    return edges


def bucket_links(places: np.ndarray, stops: np.ndarray, fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within buckets (``places``: where each one's chain starts) as places in ``fps``; a dense or large bucket
    gives a spanning forest, the others what links in them."""
    starts = np.concatenate([[0], stops[:-1]])
    sizes = stops - starts
    left, right = [], []

    def wood(k: int) -> None:
        edges = np.array(forest(int(places[k]), fps[starts[k] : stops[k]], most), np.int64).reshape(-1, 2) + starts[k]
        left.append(edges[:, 0]), right.append(edges[:, 1])

    for k in np.flatnonzero(sizes > SMALL).tolist():
        wood(k)
    small = np.flatnonzero(sizes <= SMALL)
    upto = np.cumsum(sizes[small] * (sizes[small] - 1) // 2)
    for part in np.split(small, np.searchsorted(upto, np.arange(1 << 18, upto[-1] if len(upto) else 0, 1 << 18))):
        if not len(part):
            continue
        own = np.repeat(part, sizes[part])
        place = np.arange(len(own)) - np.repeat(np.cumsum(sizes[part]) - sizes[part], sizes[part])  # in its bucket
        one = np.repeat(starts[own] + place, place)
        bucket = np.repeat(own, place)
        other = starts[bucket] + np.arange(len(one)) - np.repeat(np.cumsum(place) - place, place)
        near = _chained(places[bucket], fps[one] ^ fps[other], most)
        crowd = np.bincount(bucket[near], minlength=len(sizes)) > 4 * sizes
        near = near[~crowd[bucket[near]]]
        left.append(one[near]), right.append(other[near])
        for k in part[crowd[part]].tolist():
            wood(k)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(none + left), np.concatenate(none + right)


def links(nodes: DataFrame, most: int = 3, block: int = 4096) -> DataFrame:
    """``a, b``: enough links between distinct fingerprints to join every pair within ``most`` bits into one component.

    ``nodes`` has ``node`` (long) and ``fp``, one row for each distinct fingerprint; neither is null. Fingerprints of one
    bucket are dealt into blocks, so a bucket of any size fits. No nodes give no links.
    """
    chain = np.array([i for i, _ in ring_plan(most)[1]])
    keys = ring_keys(nodes, most)
    sizes = keys.groupBy("k", "v").count().filter(F.col("count") > 1)
    hot = sizes.filter(F.col("count") > block).select("k", "v", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    rows = keys.join(hot, ["k", "v"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("k", "v", "node", "fp", own.alias("own"), other)
    rows = rows.select("k", "v", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "node", "fp")
    groups = rows.groupBy("k", "v", "p", "q").agg(F.collect_list("node").alias("nodes"), F.collect_list("fp").alias("fps"))
    groups = groups.filter(F.size("nodes") > 1).select("k", "nodes", "fps")

    def run(batches):
        for b in batches:
            node, fp = b.column("nodes"), b.column("fps")
            stops = fp.offsets.to_numpy().astype(np.int64)
            ids, fps = (np.asarray(c.values.to_numpy(zero_copy_only=False))[stops[0] : stops[-1]] for c in (node, fp))
            if not b.num_rows:
                continue
            a, c = bucket_links(chain[b.column("k").to_numpy()], stops[1:] - stops[0], np.ascontiguousarray(fps, np.int64).view(np.uint64), most)
            yield pa.RecordBatch.from_arrays([pa.array(ids[a].astype(np.int64)), pa.array(ids[c].astype(np.int64))], ["a", "b"])

    return groups.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component``: the smallest node reachable from each node that has an edge.

    Alternating large-star and small-star steps; each step is a grouped minimum, so a node with a great many
    neighbours is reduced map-side. Every second step is written to the shared folder, which cuts the lineage. Repeated
    edges and edges from a node to itself change nothing; no edges give no rows.
    """
    lo, hi = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    now = materialise(edges.select(lo, hi).filter("a <> b").distinct())
    before = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b")
        large = large.distinct()
        small = large.groupBy("b").agg(F.min("a").alias("m"))
        star = large.join(small, "b").select(F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b"))
        now = materialise(star.filter("a <> b").distinct())
        if before is not None and before.count() == now.count() and not before.exceptAll(now).take(1):
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return now.groupBy("b").agg(F.min("a").alias("component")).withColumnRenamed("b", "node")


def near_duplicates(docs: DataFrame, most: int = 3, block: int = 4096, id_col: str = "doc_id", text_col: str = "text", row_key: Column | None = None, size: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every document, and ``row_key`` where one is given.

    Links join fingerprints of ``size``-word shingles at ``most`` (up to 7) or fewer differing bits; ``component_id`` is the smallest doc_id reachable.
    Null, empty and wordless texts have fingerprint 0 and link like any other. A null doc_id takes part under no name:
    its row is returned with the component of its fingerprint, null where only null ids share it. Repeated rows repeat;
    texts with one id share a component where that id is the smallest of both. Other columns may have any name.
    """
    own = materialise(fingerprints(docs, id_col, text_col, row_key, size))
    nodes = materialise(own.groupBy("fp").agg(F.min("doc_id").alias("node")).filter("node is not null"))
    found = components(links(nodes, most, block))
    known = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return own.join(known, "fp", "left").select("doc_id", hexed, "component_id", *(["row_key"] if row_key is not None else []))
