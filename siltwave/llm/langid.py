"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of hashed 2- and 3-byte grams of its lower-case letters, scaled to length one. Each
language has a few centroids, found by spherical k-means on a bounded sample of labelled texts. A text gets the language
of the centroid with the greatest cosine; too great a distance rejects it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import numbered, pieces, texts

#: Bytes of ASCII that aren't letters count as one space.
_LETTERS = bytes(b if b > 127 or 97 <= b <= 122 else 32 for b in range(256))


#: Tasks for each language among which the first ranking of the sample is dealt.
RANKERS = 64


@dataclass(frozen=True)
class Model:
    langs: list[str]  # of each centroid
    centroids: np.ndarray  # features x centroids
    idf: np.ndarray
    reject: np.ndarray  # smallest cosine that each centroid accepts


def grams(text: str, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed gram numbers of a text and how often each occurs."""
    raw = np.frombuffer(b" " + b" ".join(text.lower().encode("utf-8").translate(_LETTERS).split()) + b" ", np.uint8).astype(np.uint32)
    counts = np.zeros(features, np.int64)
    shift = np.uint32(32 - int(features).bit_length() + 1)
    for k in range(0, len(raw), 1 << 20):
        part = raw[k : k + (1 << 20) + 2]
        two = (part[:-1] << np.uint32(8)) | part[1:]
        three = ((two[:-1] << np.uint32(8)) | part[2:]) ^ np.uint32(0x5BD1E995)
        for g in (two[: 1 << 20], three[: 1 << 20]):
            counts += np.bincount((g * np.uint32(2654435761)) >> shift, minlength=features)
    at = np.flatnonzero(counts)
    return at.astype(np.int32), counts[at]


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(counts)) * idf[at]
    return v / (np.sqrt(v @ v) or 1.0)


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from evenly spread first centres; returns centroids and each row's best cosine."""
    k = min(k, len(vectors))
    centres = vectors[np.linspace(0, len(vectors) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = (vectors @ centres.T).argmax(1)
        for c in range(k):
            if (own == c).any():
                mean = vectors[own == c].sum(0)
                centres[c] = mean / (np.linalg.norm(mean) or 1.0)
    return centres, vectors @ centres.T


def fit(
    docs: DataFrame, per_lang: int = 300, centroids: int = 4, features: int = 1 << 13, slack: float = 0.45, tail: float = 0.005,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Model | None:
    """Learn from at most ``per_lang`` texts of each language, those whose id has the smallest hash.

    Documents whose crc32 of the id, as text, is a multiple of 5 are held out; so are null labels, and texts without a
    letter teach nothing; rows with an equal id and label teach once, by their smallest text. What comes to the driver
    is one sparse vector of at most ``features`` entries for each sampled text. None without any labelled text.
    ``slack`` times the ``tail`` quantile of the sampled texts' own best cosines is the rejection limit of all centroids,
    so no single odd text sets it.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    base = base.filter("doc_id is not null and text is not null and lang is not null").filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    # first among the rows of some read partitions, so that the last ranking of a language has a bounded number of rows
    ids = base.select("doc_id", "lang", (F.spark_partition_id() % RANKERS).alias("ranker"))
    for keys in (["lang", "ranker"], ["lang"]):
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id"))
        ids = ids.withColumn("rank", rank).filter(F.col("rank") <= per_lang).drop("rank")
    picked = base.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id")  # per_lang ids for each language at most
    picked = picked.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def run(batches):
        for b in pieces(batches):
            rows = [(x, *grams(t, features)) for x, t in zip(b.column("lang").to_pylist(), texts(b)) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1].tolist() for r in rows], pa.list_(pa.int32())), pa.array([r[2].tolist() for r in rows], pa.list_(pa.int64()))], ["lang", "at", "n"])

    rows = picked.mapInArrow(run, "lang string, at array<int>, n array<bigint>").collect()  # per_lang rows a language at most
    rows.sort(key=lambda r: (r.lang, xxhash.xxh64_intdigest(np.array([r.at, r.n], "<i8").tobytes()), r.at, r.n))
    if not rows:
        return None
    found = np.zeros(features)
    for r in rows:
        found[r.at] += 1
    idf = np.log((1 + len(rows)) / (1 + found)) + 1
    langs, columns, own_best = [], [], []
    for lang in sorted({r.lang for r in rows}):
        own = [r for r in rows if r.lang == lang]
        dense = np.zeros((len(own), features), np.float32)
        for i, r in enumerate(own):
            dense[i, r.at] = weighted(np.array(r.at), np.array(r.n), idf)
        centres, cosines = cluster(dense, centroids)
        own_best.append(cosines.max(1))
        langs += [lang] * len(centres)
        columns += list(centres)
    limit = slack * float(np.quantile(np.concatenate(own_best), tail))
    return Model(langs, np.ascontiguousarray(np.array(columns, np.float32).T), idf, np.full(len(langs), limit))


def verdicts(own: list[str], model: Model | None) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and rejection of each text."""
    lang, score, out = [], [], []
    for t in own:
        if model is None or not has_letter(t):
            lang.append("und")
            score.append(0.0)
            out.append(True)
            continue
        at, n = grams(t, len(model.idf))
        cosines = weighted(at, n, model.idf) @ model.centroids[at]
        best = int(cosines.argmax())
        lang.append(model.langs[best])
        score.append(float(min(1.0, max(0.0, cosines[best]))))
        out.append(bool(cosines[best] < model.reject[best]))
    return lang, score, out


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every whole text, from nothing but the text.

    Null texts and texts without a letter are ``und`` with score 0 and rejected, and so is everything without a model.
    Repeated rows repeat; other columns are not read.
    """

    def run(batches):
        for b in pieces(batches):
            lang, score, out = verdicts(texts(b), model)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(out, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows, all columns as they are, whatever their names, whose text ``predict`` doesn't reject.

    Null texts and texts without a letter go; repeated rows stay or go together.
    """
    plain, schema = numbered(docs)
    name = f"c{docs.columns.index(text_col)}"

    def run(batches):
        for b in pieces(batches, name=name):
            out = verdicts(texts(b, name), model)[2]
            yield b.filter(pa.array([not x for x in out], pa.bool_()))

    return plain.mapInArrow(run, schema).toDF(*docs.columns)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0
