"""Token ids as Parquet list columns, in document order, with encodings and row groups under control.

Ids take a dictionary page while their vocabulary of a column chunk fits, else delta-packed blocks (format version 2);
row groups and pages are small enough that the page index lets a reader fetch one document's ids, or its metadata
alone, without the rest of the file.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import lean_memory, pieces
from .bpe import Remembered, WordEncoder, byte_alphabet, join_cuts

FILE_SCHEMA = "part int, doc_id long, local_start long, n_tokens long, ids array<int>"


class LibraryCuts:
    """The library's ids of texts, by their cuts, which no token crosses; the packed ids of cuts are remembered.

    A new cut of plain small letters, digits and signs is split into pre-tokens here, and the library's model alone
    encodes them. Other new cuts go to the whole library, one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.model, self.chars = self.lib.model, dict(enumerate(byte_alphabet()))
        self.memo = Remembered(self.learn, most=350_000)

    def learn(self, cuts: list[bytes]) -> list[bytes]:
        tokenize, chars, is_small, split = self.model.tokenize, self.chars, WordEncoder.is_small, WordEncoder.split
        ids, stops = [], []
        for raw in cuts:
            text = raw.decode("utf-8")
            if text.isalpha() and text.isascii() and text.islower():
                ids += [t.id for t in tokenize(text)]
            elif not is_small(text) or "<|" in text:
                ids += self.lib.encode(text, add_special_tokens=False).ids
            else:
                for part in (text,) if text.isalpha() else split(text):
                    symbols = part if part.isascii() else part.encode("utf-8").decode("latin-1").translate(chars)
                    ids += [t.id for t in tokenize(symbols)]
            stops.append(4 * len(ids))
        packed, at, out = np.asarray(ids, "<u4").tobytes(), 0, []
        for stop in stops:
            out.append(packed[at:stop])
            at = stop
        return out

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's ids end."""
        return join_cuts(texts, self.memo)


@functools.lru_cache(maxsize=2)
def library_cuts(path: str) -> LibraryCuts:
    lean_memory()
    return LibraryCuts(path)


def write_token_files(
    docs: DataFrame, tokenizer: str, out: str, end_id: int = 2, parts: int | None = None,
    row_group_bytes: int = 16 << 20, page_bytes: int = 256 << 10, dictionary_bytes: int = 512 << 10,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode every whole text, append ``end_id``, and write the ids under ``out`` in ascending id order.

    Range partitions follow the id, so file k holds smaller ids than file k + 1 and no task holds more than its range.
    A null or empty text is ``end_id`` alone; null ids come first; rows with equal ids are ordered by their text.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        cuts = library_cuts(tokenizer)
        for b in pieces(batches, 4 << 20):
            ids, ends = cuts.encode(b.column("text"))
            n = np.diff(ends, prepend=0) + 1
            flat = np.insert(ids, ends, end_id).view("<i4")
            stops = np.concatenate([[0], np.cumsum(n)])
            lists = pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, np.int32)), b.column("doc_id"), pa.array(at + stops[:-1]), pa.array(n), lists],
                ["part", "doc_id", "local_start", "n_tokens", "ids"],
            )
            at += int(stops[-1])

    ordered = picked.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    (
        ordered.mapInArrow(run, FILE_SCHEMA)
        .write.option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.dictionary.page.size", dictionary_bytes)
        .option("parquet.enable.dictionary", "true")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("compression", "zstd")
        .parquet(out)
    )


def read_token_files(spark, out: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``; ``start`` counts the ids of all documents before it.

    The offset of a file is a running sum over one total per file; reading metadata alone leaves the ids unread. Null ids come first,
    rows of one id in the order in which they were written; an empty table gives no rows.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(out)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    base = totals.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))
    # one row for each range partition of the writer, a number that the writer was given
    return files.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def id_checksums(tokens: DataFrame) -> DataFrame:
    """``ids_crc32`` of each row's ids as little-endian 32-bit numbers, beside doc_id, start and n_tokens; one row for each row, 0 for no ids."""

    def run(batches):
        for b in batches:
            ids = b.column("ids")
            flat, stops = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[i:j]) for i, j in zip(stops[:-1], stops[1:])]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", "start", "n_tokens")] + [pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


