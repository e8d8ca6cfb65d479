"""How filters of documents interact: what each removes, alone and in every order, by source.

Four filters look at one text, the fifth (E) asks whether a document with a smaller id has the same text. For that a
counting Bloom filter of all texts is made first: each task counts the cells of its own texts, up to two, cells are added
up by segment, and a text with a cell that only one document touches is unique. Only the texts that are left, possible
repeats, are shuffled whole, for the exact smallest id of each. The five answers of a document make a mask; masks are
counted by source, and all orders are read off those counts.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialise, pieces, texts

FILTERS = "ABCDE"
UPPER, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
HASHES, SEGMENT = 4, 1 << 16  # cells that a text touches, all in one segment of so many
CELLS_PER_TEXT, MOST_CELLS = 16, 1 << 28


def own_mask(text: str) -> int:
    """Bits 0 to 3: which of A to D the text fails."""
    raw = text.encode("utf-8")
    words = raw.split()  # splits bytes at 0x20 and 0x09 to 0x0D only
    few = len(words) < 200
    same = 100 * len(set(words)) < 50 * len(words)
    loud = 100 * (len(raw) - len(raw.translate(None, UPPER))) > 2 * len(text)
    return few | same << 1 | loud << 2 | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3


def flags(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``doc_id, part, h, mask`` of every whole text: its 64-bit hash and which of A to D it fails. Repeated rows repeat."""

    def run(batches):
        for b in pieces(batches):
            own = texts(b)
            h = np.fromiter((xxhash.xxh64_intdigest(x.encode("utf-8"), 42) for x in own), np.uint64, len(own))
            mask = np.fromiter(map(own_mask, own), np.int32, len(own))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(h.view(np.int64)), pa.array(mask)], ["doc_id", "part", "h", "mask"])

    part = F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")
    picked = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("doc_id"), part)
    return picked.mapInArrow(run, "doc_id long, part string, h long, mask int")


def places(h: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each hash and its ``HASHES`` cells there, one column each, every column with cells of its own."""
    h = h.view(np.uint64)
    mixed, share = (h ^ h >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15), SEGMENT // HASHES
    cells = np.stack([i * share + (mixed >> np.uint64(16 * i) & np.uint64(share - 1)).astype(np.int64) for i in range(HASHES)], axis=1)
    return (h % np.uint64(segments)).astype(np.int64), cells


def sketch(hashes: DataFrame, n: int, most_cells: int = MOST_CELLS) -> tuple[int, dict[int, bytes]]:
    """The merged filter of the column ``h``: how many segments it has, and of each the bitmap of cells that more than one row touches.

    ``n``, the number of rows, sets its size up to ``most_cells`` (the bitmaps have an eighth of that in bytes, which
    bounds what is sent to the driver and to the executors). Beyond, it clears fewer texts and stays right.
    A task sends a cell once, with a count of one or two, however many rows touch it.
    """
    segments = max(1, min(most_cells, CELLS_PER_TEXT * n) // SEGMENT)

    def count(batches):
        for b in batches:
            h, k = np.unique(b.column("h").to_numpy(), return_counts=True)
            segment, cells = places(h, segments)
            flat, at = np.unique((segment[:, None] * SEGMENT + cells).ravel(), return_inverse=True)
            own = np.minimum(np.bincount(at.ravel(), np.repeat(np.minimum(k, 2), HASHES)), 2).astype(np.int64)
            stops = np.flatnonzero(np.diff(flat // SEGMENT, append=-1)) + 1
            code = ((flat % SEGMENT) * 2 + own - 1).astype("<u4")
            starts = np.concatenate([[0], stops[:-1]])
            if len(flat):
                yield pa.RecordBatch.from_arrays([pa.array(flat[starts] // SEGMENT), pa.array([code[i:j].tobytes() for i, j in zip(starts, stops)], pa.binary())], ["segment", "cells"])

    def merge(batches):
        for b in batches:
            out = []
            for sketches in b.column("sketches"):
                total = np.zeros(SEGMENT, np.int64)
                for x in sketches.values:
                    code = np.frombuffer(x.as_buffer(), "<u4")
                    total[code // 2] += code % 2 + 1  # the cells of one sketch differ
                out.append(np.packbits(total > 1, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("segment"), pa.array(out, pa.binary())], ["segment", "twice"])

    parts = hashes.select("h").mapInArrow(count, "segment long, cells binary")
    merged = parts.groupBy("segment").agg(F.collect_list("cells").alias("sketches")).mapInArrow(merge, "segment long, twice binary")
    return segments, {r.segment: bytes(r.twice) for r in merged.collect()}


def may_repeat(h: np.ndarray, segments: int, twice: dict[int, bytes]) -> np.ndarray:
    """Which hashes have only cells that more than one row touches; no repeated text is missed."""
    segment, cells = places(h, segments)
    out = np.ones(len(h), bool)
    for s in np.unique(segment).tolist():
        at = np.flatnonzero(segment == s)
        bits = np.frombuffer(twice.get(s) or bytes(SEGMENT // 8), np.uint8)
        out[at] = ((bits[cells[at] >> 3] >> (cells[at] & 7).astype(np.uint8)) & 1).all(axis=1)
    return out


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", most_cells: int = MOST_CELLS) -> DataFrame:
    """``doc_id, part, mask`` for every document: bits 0 to 4 say which of A to E it fails.

    Null texts are empty, null parts the empty string. A null id is nobody's smaller id and fails E never; rows that repeat
    an id with the same text fail E only if a smaller id has that text. No documents give no rows.
    """
    spark = docs.sparkSession
    own = materialise(flags(docs, id_col, text_col, part_col))
    segments, twice = sketch(own, own.count(), most_cells)
    sent = spark.sparkContext.broadcast(twice)

    def marked(batches):
        for b in batches:
            open_ = may_repeat(b.column("h").to_numpy(), segments, sent.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(open_)], [*b.schema.names, "open"])

    def repeats(batches):
        for b in pieces(batches):
            h = np.fromiter((xxhash.xxh64_intdigest(x.encode("utf-8"), 42) for x in texts(b)), np.uint64, b.num_rows).view(np.int64)
            keep = np.flatnonzero(may_repeat(h, segments, sent.value))
            yield pa.RecordBatch.from_arrays([pa.array(h), b.column("doc_id"), b.column("text")], ["h", "doc_id", "text"]).take(pa.array(keep))

    picked = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("doc_id")).filter("doc_id is not null")
    least = picked.mapInArrow(repeats, "h long, doc_id long, text string").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.min("h").alias("h"))
    first = least.select("doc_id", "h").distinct().withColumn("first", F.lit(True))
    out = own.mapInArrow(marked, "doc_id long, part string, h long, mask int, open boolean").join(first, ["doc_id", "h"], "left")
    late = F.col("open") & F.col("doc_id").isNotNull() & F.col("first").isNull()
    return out.select("doc_id", "part", F.col("mask").bitwiseOR(F.when(late, 16).otherwise(0)).alias("mask"))


def mask_counts(found: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask`` with the documents of each: ``n``, those of good quality and toxic ones. Labels of one id count once."""
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    count = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c)
    return found.join(known, "doc_id", "left").groupBy("part", "mask").agg(F.count("*").alias("n"), count("good"), count("toxic"))


def orders(counts: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step, from the additive counts of masks.

    What a filter removes depends only on which filters came before it: 80 cases, to which the 600 steps are joined.
    """
    spark = counts.sparkSession
    cases = [(i, before) for i in range(5) for before in range(32) if not before >> i & 1]
    case = F.explode(F.array(*[F.struct(F.lit(i).alias("own"), F.lit(1 << i).alias("bit"), F.lit(before).alias("before")) for i, before in cases])).alias("c")
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) > 0, F.col("mask").bitwiseAND(F.col("before")) > 0
    rows = counts.select("part", "mask", "n", "good", "toxic", case).select("part", "mask", "n", "good", "toxic", "c.*")
    total = lambda cond, c="n": F.sum(F.when(cond, F.col(c)).otherwise(0)).alias
    sums = rows.groupBy("part", "own", "before").agg(
        total(~fails & ~gone)("kept"), total(fails & ~gone)("removed"), total(fails & gone)("redundant"), total(F.col("mask") == F.col("bit"))("unique_fails"),
        total(fails & ~gone, "good")("good_lost"), total(fails & ~gone, "toxic")("toxic_lost"),
    )
    ways = {k: v for k, v in enumerate((24, 6, 4, 6, 24))}  # orders of the filters before and after, by how many come before
    share = F.element_at(F.create_map(*[F.lit(x) for kv in ways.items() for x in kv]), F.bit_count("before"))
    shapley = sums.groupBy("part", "own").agg(F.sum(F.col("removed") * share).alias("shapley"))
    steps = [("".join(p), k + 1, FILTERS.index(x), sum(1 << FILTERS.index(y) for y in p[:k])) for p in permutations(FILTERS) for k, x in enumerate(p)]
    plan = spark.createDataFrame(steps, "filter_order string, step int, own int, before int")  # 600 rows at any size
    out = sums.join(shapley, ["part", "own"]).join(F.broadcast(plan), ["own", "before"])
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """The whole audit; see ``masks`` and ``orders``."""
    return orders(materialise(mask_counts(masks(docs, **kw), labels)))
