"""Token counts with a shortcut for whole tokens.

Before any text is read, every vocabulary string is put through the merges; those that come back as one token are
proved to count one wherever they are a whole pre-token. Only the other pre-tokens are merged.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import pieces, texts
from .bpe import Remembered, byte_alphabet, lock_step, special_split

#: The pre-token pattern of byte-level vocabularies.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: A blank before white space or at the end, or the sign that marks cuts: texts with one are cut by the pattern below.
_CARE = re.compile(r" (?:\s|\Z)|\x00")


class TokenCounter:
    """Counts by cuts: a blank that is followed by something else than white space always begins a pre-token."""

    CUT = "\x00"

    def __init__(self, path: str):
        self.machine = lock_step(path)
        self.table = self.machine.table
        self.find, self.coarse = regex.compile(BYTE_PATTERN).findall, regex.compile(r" ?\S+|\s+(?!\S)|\s+").findall
        self.special = special_split(self.table.specials)
        self.proved = self._proved_texts()
        self.is_word = re.compile(rb" ?[A-Za-z]+").fullmatch
        self.memo = Remembered(self.learn)

    def _proved_texts(self) -> set[bytes]:
        """Pre-tokens, as UTF-8, that are proved to be one token."""
        back = {c: b for b, c in enumerate(byte_alphabet())}
        out = set()
        for token in self.table.proved:
            raw = bytes(map(back.__getitem__, token))
            try:
                text = raw.decode("utf-8")
            except UnicodeDecodeError:
                continue  # part of a character: never a whole pre-token
            if self.find(text) == [text]:
                out.add(raw)
        return out

    def learn(self, cuts: list[bytes]) -> list[int]:
        """Tokens of each cut: 1 for each pre-token with a proof; the rest are merged together."""
        counts, words, owner = [], [], []
        for k, raw in enumerate(cuts):
            if raw in self.proved or self.special and raw.decode("utf-8") in self.table.specials:
                counts.append(1)
                continue
            own = (raw,) if self.is_word(raw) else [x.encode("utf-8") for x in self.find(raw.decode("utf-8"))]
            rest = [x for x in own if x not in self.proved]
            counts.append(len(own) - len(rest))
            words += rest
            owner += [k] * len(rest)
        _, sizes = self.machine.encode(words)
        return (np.asarray(counts, np.int64) + np.bincount(np.asarray(owner, np.int64), sizes, len(cuts)).astype(np.int64)).tolist()

    def marked(self, text: str) -> str | None:
        """The text with a mark between cuts; None where it holds the mark itself."""
        if self.special and "<" in text and any(x in text for x in self.table.specials):
            parts = self.special.split(text)
        elif not _CARE.search(text):
            return text.replace(" ", self.CUT + " ")
        else:
            parts = [text]
        if self.CUT in text:
            return None
        return self.CUT.join(y for x in parts for y in ([x] if x in self.table.specials else self.coarse(x)))

    def counts(self, texts: list[str]) -> np.ndarray:
        marked = list(map(self.marked, texts))
        split = pc.split_pattern(pa.array([x or "" for x in marked], pa.large_string()), self.CUT)
        coded = pc.dictionary_encode(split.values.cast(pa.large_binary()))
        each = np.asarray([0, *self.memo.values(coded.dictionary.to_pylist())], np.int64)[1 + coded.indices.to_numpy().astype(np.int64)]
        upto, stops = np.concatenate([[0], np.cumsum(each)]), split.offsets.to_numpy()
        out = upto[stops[1:]] - upto[stops[:-1]]
        for k in (k for k, x in enumerate(marked) if x is None):
            parts = self.special.split(texts[k]) if self.special else [texts[k]]
            out[k] = sum(self.learn([y.encode("utf-8") for x in parts for y in ([x] if x in self.table.specials else self.coarse(x))]))
        return out


@functools.lru_cache(maxsize=2)
def token_counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every whole text.

    A null or empty text has no bytes and no tokens; a null id stays null; repeated rows give repeated rows; other
    columns are not read.
    """

    def run(batches):
        counter = token_counter(path)
        for b in pieces(batches):
            own = texts(b)
            n = counter.counts(own)
            size = [len(x.encode("utf-8")) for x in own]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = picked.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
