"""Exact removal of repeated substrings by the names of sampled places; not a suffix sort.

A suffix array by difference cover sorts the suffixes at sampled offsets, names them, recurses on the names and merges
the rest. Only its cover is taken up here, since sorting two thirds of all offsets goes beyond the disk that a job may
take: two equal stretches of ``length`` bytes must hold an equally placed sample. By default the cover is chosen by content (in
every stretch the ``gram``-byte string with the least hash), with a third of the samples of a cover by offsets.

1. Each sample is named by its gram and by its context, that is all bytes that a repeated stretch around it can have.
   Samples are sorted by (gram, context, document); those whose context stands in an earlier document are covered whole.
2. Where one gram has several contexts, their first holders are named again by the two longer strings of which any
   shared stretch has one; names held by one document alone drop out.
3. The stretches around those left, the remaining suffixes, are named, and each name's first document keeps it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import materialise, pieces, texts

PIECE = 2 << 20
#: A difference cover: every difference modulo the period is one between two of its members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)


class Names:
    """64-bit names of substrings of a buffer, by a polynomial over random byte values, scrambled."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, most: int):
        rng = np.random.Generator(np.random.PCG64(20))
        self.value = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.power = np.cumprod(np.full(most + 1, self.BASE, np.uint64)) * np.uint64(pow(self.BASE, -1, 1 << 64))
        self.back = np.cumprod(np.full(most + 1, pow(self.BASE, -1, 1 << 64), np.uint64)) * np.uint64(self.BASE)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.power[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        h = (sums[starts + size] - sums[starts]) * self.back[starts]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h


_NAMES: dict[int, Names] = {}


def names(most: int) -> Names:
    size = max(PIECE * 2, 1 << (most - 1).bit_length())
    if size not in _NAMES:
        _NAMES.clear()
        _NAMES[size] = Names(size)
    return _NAMES[size]


def stretches(batch: pa.RecordBatch, length: int, side: int):
    """Groups of document parts of about PIECE bytes: id, offset of the part, its bytes, first and last window.

    A long document comes in overlapping parts; each has all bytes that its windows' contexts reach.
    """
    held, size = [], 0
    for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
        data = text.encode("utf-8")
        if doc is None or len(data) < length:
            continue
        for first in range(0, len(data) - length + 1, PIECE):
            last = min(first + PIECE, len(data) - length + 1)
            lo, hi = max(0, first - side), min(len(data), last + 2 * length)
            held.append((doc, lo, data[lo:hi], first - lo, last - lo, len(data)))
            size += hi - lo
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def samples(parts: list, length: int, gram: int, cover: str = "content"):
    """Grams, contexts, part numbers and offsets within the part of the samples of some parts."""
    span = length - gram + 1
    sizes = np.array([len(p[2]) for p in parts])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    own = names(len(data))
    sums = own.sums(data)
    h = own.of(sums, np.arange(len(data) - gram + 1), gram)
    if cover == "difference":
        places = [np.arange(p[3], min(p[4] - 1 + length - gram, len(p[2]) - gram) + 1) for p in parts]
        at = np.concatenate([x[np.isin((x + p[1]) % PERIOD, COVER)] + b for x, p, b in zip(places, parts, begin)])
        return located(parts, own, sums, h, at, begin, length, gram)
    order = (h >> np.uint64(30) << np.uint64(30)) | np.arange(len(h), dtype=np.uint64)
    least, reach = order, 1
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    n = len(h) - span + 1
    least = np.minimum(least[:n], least[span - reach : span - reach + n])
    window = np.zeros(n + 1, np.int32)
    np.add.at(window, begin[:-1] + np.array([p[3] for p in parts]), 1)
    np.add.at(window, np.minimum(begin[:-1] + np.array([p[4] for p in parts]), n), -1)
    at = np.unique(least[np.cumsum(window[:n]) > 0] & np.uint64((1 << 30) - 1)).astype(np.int64)
    return located(parts, own, sums, h, at, begin, length, gram)


def located(parts: list, own: Names, sums: np.ndarray, h: np.ndarray, at: np.ndarray, begin: np.ndarray, length: int, gram: int):
    """What ``samples`` gives for the samples at these places of all parts' bytes."""
    side, sizes = length - gram, np.diff(begin)
    part = np.searchsorted(begin, at, "right") - 1
    inside = at - begin[part]
    whole = (inside >= side) & (inside + length <= sizes[part])
    context = np.zeros(len(at), np.uint64)
    context[whole] = own.of(sums, at[whole] - side, side + length)
    for i in np.flatnonzero(~whole).tolist():  # the context ends with its document
        j = int(inside[i])
        data_i = parts[part[i]][2]
        left, right = min(side, j), min(length, len(data_i) - j)
        context[i] = xxhash.xxh64_intdigest(data_i[j - left : j + right], 1000 * left + right)
    return h[at].view(np.int64), context.view(np.int64), part, inside


def scan(docs: DataFrame, length: int, gram: int, cover: str = "content") -> DataFrame:
    """``h, c, doc, pos``, a row for each sample; pos is -1 - pos where an earlier document of the same part is found
    to have the same gram and context, so that a hot string is reduced before the shuffle."""

    def run(batches):
        for batch in pieces(batches):
            for parts in stretches(batch, length, length - gram):
                h, c, part, inside = samples(parts, length, gram, cover)
                doc = np.array([p[0] for p in parts], np.int64)[part]
                pos = inside + np.array([p[1] for p in parts], np.int64)[part]
                o = np.lexsort((pos, doc, c, h))
                h, c, doc, pos = h[o], c[o], doc[o], pos[o]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
                first = doc[new][np.cumsum(new) - 1]
                known = doc > first
                spread = np.where(known, (doc * 31 + pos) * 0x9E3779B1, h)
                yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array(np.where(known, 0, c)), pa.array(doc), pa.array(np.where(known, -1 - pos, pos))], ["h", "c", "doc", "pos"])

    picked = docs.select(F.col("doc_id"), F.col("text"))
    return picked.mapInArrow(run, "h long, c long, doc long, pos long")


def decide(batches):
    """From rows sorted by (h, c, doc): samples that an earlier document covers, and the first holders of each context
    of a gram with several. What is carried between batches is one gram's first holder."""
    last_h = last_c = low = None
    contexts, waiting = 0, []
    out_schema = ["doc", "pos", "covered"]

    def rows(doc, pos, covered):
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(pos, pa.int64()), pa.array(covered, pa.bool_())], out_schema)

    for b in batches:
        h, c, doc, pos = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        n = len(h)
        if not n:
            continue
        new_h, new_c = np.ones(n, bool), np.ones(n, bool)
        new_h[1:] = h[1:] != h[:-1]
        new_h[0] = last_h is None or h[0] != last_h
        new_c[1:] = c[1:] != c[:-1]
        new_c[0] = last_c is None or c[0] != last_c
        new_c |= new_h
        run = np.cumsum(new_c)  # 0: goes on with the carried context
        lows = np.concatenate([[low if low is not None else 0], doc[new_c]])
        covered = doc > lows[run]
        group = np.cumsum(new_h)  # 0: goes on with the carried gram
        count = np.bincount(group, new_c, minlength=group[-1] + 1).astype(np.int64)
        count[0] += contexts
        several = count[group] > 1
        done = pos < 0
        take = done | covered | several
        if waiting and (group[0] == 0 and count[0] > 1):
            yield rows(*map(list, zip(*waiting)), [False] * len(waiting))
            waiting = []
        if group[-1] > 0:
            waiting = []
        if count[group[-1]] == 1:  # not decided yet
            tail = np.flatnonzero((group == group[-1]) & ~covered & ~done)
            waiting += list(zip(doc[tail].tolist(), pos[tail].tolist()))
        yield rows(doc[take], np.where(done, -1 - pos, pos)[take], (covered | done)[take])
        last_h, last_c, low, contexts = h[-1], c[-1], lows[-1], int(count[group[-1]])


def by_document(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc").agg(F.collect_list("pos").alias("at"))


def remove_repeats(docs: DataFrame, length: int = 50, gram: int = 20, id_col: str = "doc_id", text_col: str = "text", cover: str = "content") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) for every document.

    A byte goes if a ``length``-byte string over it also starts in a document with a smaller id. Null and empty texts
    have no bytes; texts shorter than ``length`` lose none. Rows with a null id neither lose nor take bytes; repeated
    rows (same id and text) count as one document and each is returned. ``cover`` "difference" samples by a difference
    cover of the offsets instead, with the same result and three times the samples; it needs ``length - gram`` of 30 or
    more.
    """
    if cover == "difference" and length - gram < PERIOD - 1:
        raise ValueError("the cover needs stretches of its period beside the gram")
    half, side = (length - gram) // 2, length - gram
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    first = materialise(scan(own, length, gram, cover).repartition("h").sortWithinPartitions("h", "c", "doc").mapInArrow(decide, "doc long, pos long, covered boolean"))

    def renamed(batches):
        for b in pieces(batches):
            out: dict[str, list] = {k: [] for k in ("key", "doc", "pos", "ctx")}
            for doc, text, at in zip(b.column("doc").to_pylist(), texts(b), b.column("at").to_pylist()):
                data = text.encode("utf-8")
                for a in set(at):
                    if a >= half:
                        out["key"].append(xxhash.xxh64_intdigest(data[a - half : a + gram], 1) - (1 << 63))
                        out["ctx"].append(data[max(0, a - side) : a - half + length])
                        out["pos"].append(max(0, a - side)), out["doc"].append(doc)
                    if a + length - half <= len(data):
                        lo = max(0, a - half + 1)
                        out["key"].append(xxhash.xxh64_intdigest(data[a : a + length - half], 2) - (1 << 63))
                        out["ctx"].append(data[lo : a + length])
                        out["pos"].append(lo), out["doc"].append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(out["key"], pa.int64()), pa.array(out["doc"], pa.int64()), pa.array(out["pos"], pa.int64()), pa.array(out["ctx"], pa.binary())], ["key", "doc", "pos", "ctx"])

    def windows(batches):
        for b in batches:
            name, doc, pos = [], [], []
            digest = xxhash.xxh64_intdigest
            for d, p, ctx in zip(b.column("doc").to_pylist(), b.column("pos").to_pylist(), b.column("ctx").to_pylist()):
                for k in range(len(ctx) - length + 1):
                    name.append(digest(ctx[k : k + length], 3) - (1 << 63))
                    doc.append(d)
                    pos.append(p + k)
            yield pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), pa.array(doc, pa.int64()), pa.array(pos, pa.int64())], ["name", "doc", "pos"])

    holders = by_document(first.filter("not covered"))
    held = holders.join(own, holders.doc == own.doc_id).select("doc", "text", "at")
    again = held.mapInArrow(renamed, "key long, doc long, pos long, ctx binary")
    by_key = W.partitionBy("key")
    shared = again.withColumn("lo", F.min("doc").over(by_key)).withColumn("hi", F.max("doc").over(by_key)).filter("lo < hi")
    # what came before, the texts' own shuffle included, is done with once this is written
    shared = materialise(shared.select("doc", "pos", "ctx"))
    named = shared.mapInArrow(windows, "name long, doc long, pos long")
    later = named.withColumn("lo", F.min("doc").over(W.partitionBy("name"))).filter("doc > lo").select("doc", "pos")
    later = materialise(later.distinct())

    spans = by_document(first.filter("covered").select("doc", "pos").unionByName(later.select("doc", (-1 - F.col("pos")).alias("pos"))))

    def cut(batches):
        for b in pieces(batches, 4 << 20):
            out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept")}
            for text, at in zip(texts(b), b.column("at").to_pylist()):
                data = text.encode("utf-8")
                n = len(data)
                gone, runs = np.zeros(0, bool), 0
                if at:
                    a = np.unique(np.array(at, np.int64))
                    whole, single = a[a >= 0], -1 - a[a < 0]
                    starts, stops = np.maximum(0, whole - side), np.minimum(n, whole + length)
                    ok = stops - starts >= length
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, np.concatenate([starts[ok], single]), 1)
                    np.add.at(edge, np.concatenate([stops[ok], single + length]), -1)
                    gone = np.cumsum(edge[:n]) > 0
                    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if runs else data
                for k, v in (("n_bytes", n), ("n_removed", n - len(kept)), ("n_spans", runs), ("kept", kept)):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")], pa.array(out["kept"], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return own.join(spans, own.doc_id == spans.doc, "left").select("doc_id", "text", "at").mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")

