"""Documents whose sets of word n-grams have a Jaccard similarity of 0.9 or more, as components.

Equal sets are one set. Each set is put in one order of tokens, rare ones first, and its prefix goes into index lists: two
sets that link share a token there. What sets have to do with each other saves work twice:

- Answers: a set's best guide (the set that comes first in most of its lists) is checked first. What a guide is linked to
  answers for the set as well, so afterwards a list only yields pairs that no chain of links has joined yet; a dense group
  costs one check for each member.
- Lists: entries of one length and position form a block. A bound on the overlap, from length and position, holds for whole
  blocks; those that can't reach it are skipped unread.

Pairs that are left are held to a bound from parity bits of both sets, and those that pass are compared in full. Tokens and sets are known by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import lean_memory, materialise, pieces
from .simhash import components

FREQUENT, MOST_FREQUENT = 16, 1 << 19  # tokens in so many sets go last; so many of them are told to the tasks
NEED_BITS = 1 << 24  # of the bitmap that says whose sets the pairs need
COUNTED, BRIEF = 1 << 22, 512  # tokens that are counted together; parity bits that go into index lists
WINDOW, LONG_WORD = 1 << 20, 1 << 10  # bytes that are hashed together; longer words are hashed one by one
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LETTERS = np.random.default_rng(42).integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
LETTERS[ord("A") : ord("Z") + 1] = LETTERS[ord("a") : ord("z") + 1]  # A-Z count as a-z
STEP = 0x9E3779B97F4A7C15
POWERS, INVERSE = (np.cumprod(np.array([1] + [x] * (WINDOW + LONG_WORD), np.uint64)) for x in (STEP, pow(STEP, -1, 1 << 64)))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each word, given by its bytes: sums of letters times powers of their place, a window of bytes at a time."""
    out = np.empty(len(starts), np.uint64)
    short = stops - starts < LONG_WORD
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(starts, base + WINDOW))
        sums = np.zeros(min(int(stops[j - 1]) - base, WINDOW + LONG_WORD) + 1, np.uint64)
        np.cumsum(LETTERS[data[base : base + len(sums) - 1]] * POWERS[: len(sums) - 1], out=sums[1:])
        lo, hi = starts[i:j] - base, np.minimum(stops[i:j] - base, len(sums) - 1)
        out[i:j] = (sums[hi] - sums[lo]) * INVERSE[lo]
        i = j
    for k in np.flatnonzero(~short).tolist():
        out[k] = xxhash.xxh64_intdigest(data[starts[k] : stops[k]].tobytes().lower(), 42)
    return mixed(out + (stops - starts).astype(np.uint64))


def token_sets(column: pa.Array, size: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``size``-word shingles of each text as sorted hashes, one after the other, and where each text's begin.

    With fewer words a text has its whole sequence as one, without words (or as null) none.
    """
    column = column.cast(pa.large_string())
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if column.null_count:  # a null may keep bytes
        column = column.fill_null("")
        edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, np.uint8)[edges[0] : edges[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    edges = edges - edges[0]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~SPACES[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[edges] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    stops = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    h = word_hashes(data, starts, stops)
    first = np.searchsorted(starts, edges)  # each text's first word
    words = np.diff(first)
    n = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    begin = np.concatenate([[0], np.cumsum(n)])
    flat = np.full(begin[-1], size, np.uint64)
    at = np.repeat(first[:-1] - begin[:-1], n) + np.arange(begin[-1])
    whole = np.repeat(words >= size, n)
    for k in range(size):
        flat[whole] = mixed(flat[whole] + h[at[whole] + k])
    for k in np.flatnonzero((words > 0) & (words < size)).tolist():
        x = np.array([words[k]], np.uint64)
        for w in h[first[k] : first[k + 1]]:
            x = mixed(x + w)
        flat[begin[k]] = x[0]
    for i, j in zip(begin[:-1].tolist(), begin[1:].tolist()):
        flat[i:j].sort()
    fresh = np.ones(len(flat), bool)
    fresh[1:] = flat[1:] != flat[:-1]
    fresh[begin[:-1][n > 0]] = True
    return flat[fresh], np.concatenate([[0], np.cumsum(fresh)])[begin]


def set_name(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes(), 42)


def parity(tokens: np.ndarray, bits: int = 0) -> bytes:
    """For each bit place whether an odd number of tokens falls there; as many bits as tokens, from 64 to 4096, if not told.

    Two of them differ in no more bits than their sets differ in tokens; halves laid over each other give the shorter form.
    """
    bits = bits or min(4096, max(64, 1 << max(0, len(tokens) - 1).bit_length()))
    odd = np.bincount((tokens >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def parity_distance(x: bytes, y: bytes) -> int:
    """A lower bound on how many tokens are in one of two sets only."""
    x, y = (np.frombuffer(z, np.uint64) for z in ((x, y) if len(x) <= len(y) else (y, x)))
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def prefix_length(n: int, percent: int = 90) -> int:
    """Two sets that link share one of the first so many tokens of either."""
    return n - (percent * n + 99) // 100 + 1


class Order:
    """Rare tokens by hash, then frequent ones by how frequent they are; any fixed order gives the same links."""

    def __init__(self, frequent: np.ndarray, rank: np.ndarray):
        self.frequent, self.rank, self.seen = frequent, rank, np.zeros(1 << 22, bool)
        self.seen[frequent >> np.uint64(42)] = True

    def ranks(self, tokens: np.ndarray) -> np.ndarray:
        """0 for a rare token."""
        out = np.zeros(len(tokens), np.int64)
        maybe = np.flatnonzero(self.seen[tokens >> np.uint64(42)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.frequent, tokens[maybe]), len(self.frequent) - 1)
            found = self.frequent[at] == tokens[maybe]
            out[maybe[found]] = self.rank[at[found]]
        return out


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"))


def frequent_tokens(docs: DataFrame, size: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens, sorted, and how often each was counted: where a token repeats among ``COUNTED``."""

    def counts(tokens: list):
        token, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *tokens]), return_counts=True)
        keep = n > 1
        return pa.RecordBatch.from_arrays([pa.array(token[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], ["token", "n"])

    def run(batches):
        lean_memory()
        held, size_held = [], 0
        for b in pieces(batches, 2 << 20):
            held.append(token_sets(b.column("text"), size)[0])
            size_held += len(held[-1])
            if size_held > COUNTED:
                yield counts(held)
                held, size_held = [], 0
        yield counts(held)

    counted = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counted = materialise(counted.filter(F.col("n") >= FREQUENT).withColumn("size", F.floor(F.log2("n") * 8)))
    least, told = 1 << 10, 0  # all tokens of a size are told or none, so no task sorts those of all others
    for r in sorted(counted.groupBy("size").count().collect(), reverse=True):
        told += r["count"]
        least = r["size"] if told <= MOST_FREQUENT else least
    rows = counted.filter(F.col("size") >= least).select("token", "n").toArrow()
    token, n = (rows.column(c).to_numpy() for c in ("token", "n"))
    order = np.argsort(token.view(np.uint64))
    return token.view(np.uint64)[order], n[order]


def set_rows(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, s, n, prefix, bits, brief``: name and size of each document's set, the first tokens, of which it must share one
    with a partner, and its parity bits, at length and as ``BRIEF`` bits."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent_tokens(docs, size))

    def run(batches):
        lean_memory()
        order = Order(*sent.value)
        for b in pieces(batches, 2 << 20):
            flat, at = token_sets(b.column("text"), size)
            rank = order.ranks(flat)
            names, prefix, bits, brief = [], [np.zeros(0, np.uint64)], [], []
            for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
                own, often = flat[i:j], np.flatnonzero(rank[i:j])
                names.append(set_name(own)), bits.append(parity(own)), brief.append(parity(own, BRIEF))
                most = prefix_length(j - i, percent) if j > i else 0
                if len(often):
                    rare = own[rank[i:j] == 0]
                    own = rare if len(rare) >= most else np.concatenate([rare, own[often[np.argsort(rank[i:j][often], kind="stable")]]])
                prefix.append(own[:most])
            stops = pa.array(np.cumsum([len(x) for x in prefix], dtype=np.int32))
            lists = pa.ListArray.from_arrays(stops, pa.array(np.concatenate(prefix).view(np.int64)))
            name = np.array(names, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(name), pa.array(np.diff(at).astype(np.int64)), lists, pa.array(bits, pa.binary()), pa.array(brief, pa.binary())], ["doc_id", "s", "n", "prefix", "bits", "brief"])

    return docs.mapInArrow(run, "doc_id long, s long, n long, prefix array<long>, bits binary, brief binary")


def may_link(n, pos, other_n, other_pos, percent: int):
    """A bound on what two sets with a common first token at these positions can share, as a condition on columns."""
    low = percent * (n + other_n)  # the overlap needs 100 + percent of it at least
    return (100 * F.least(n, other_n) >= percent * F.greatest(n, other_n)) & ((100 + percent) * F.least(n - pos, other_n - other_pos) >= low)


def guides(posts: DataFrame, percent: int) -> DataFrame:
    """``a, b``: each set with the one that comes first in most of its lists, where their bounds allow a link."""
    first = posts.groupBy("token").agg(F.min_by("s", F.struct("pos", "n", "s")).alias("guide"), F.min(F.struct("pos", "n")).alias("g"))
    pairs = posts.join(first, "token").filter("s <> guide").filter(may_link(F.col("n"), F.col("pos"), F.col("g.n"), F.col("g.pos"), percent))
    votes = pairs.groupBy("s", "guide").count()
    return votes.groupBy("s").agg(F.max_by("guide", F.struct("count", "guide")).alias("b")).withColumnRenamed("s", "a")


def list_pairs(s: np.ndarray, n: np.ndarray, pos: np.ndarray, label: np.ndarray, other: np.ndarray, brief: np.ndarray, percent: int):
    """Pairs of one index list that differ in label and may link, by bounds from lengths, positions and brief parity bits.

    ``other`` marks the second of two parts of a list that are held against each other (all False: one part against itself).
    """
    order = np.lexsort((pos, n))
    s, n, pos, label, other, brief = s[order], n[order], pos[order], label[order], other[order], brief[order]
    starts = np.flatnonzero(np.concatenate([[True], (n[1:] != n[:-1]) | (pos[1:] != pos[:-1])]))
    stops = np.append(starts[1:], len(n))
    bn, cap = n[starts], ((100 + percent) * (n[starts] - pos[starts])) // percent - n[starts]  # the longest partner that the bound allows
    split, out = other.any(), []
    upto = np.searchsorted(bn, np.minimum(cap, bn * 100 // percent), side="right")
    for k in range(len(bn)):
        blocks = np.flatnonzero(cap[k : upto[k]] >= bn[k]) + k
        if not len(blocks):
            continue
        mine = np.arange(starts[k], stops[k])
        theirs = np.concatenate([np.arange(starts[q], stops[q]) for q in blocks])
        for i in mine.tolist():
            near = theirs[(theirs > i) & (label[theirs] != label[i])]
            if split:
                near = near[other[near] != other[i]]
            both = n[i] + n[near]
            near = near[np.bitwise_count(brief[near] ^ brief[i]).sum(axis=1) <= both + 2 * (-percent * both // (100 + percent))]
            if len(near):
                out.append(np.stack([np.full(len(near), s[i]), s[near]]))
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)


def open_pairs(posts: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, block: int = 2048) -> DataFrame:
    """``a, b``: pairs of sets of different labels that share a token early enough. Lists over ``block`` entries are dealt out as
    pairs of parts; a list whose sets all have one label isn't read."""
    rows = posts.join(labels.withColumnRenamed("node", "s"), "s", "left").withColumn("label", F.coalesce("component", "s")).drop("component")
    mixed_ = rows.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")).filter("lo <> hi")
    parts = F.ceil(F.col("size") / block).cast("int")
    rows = rows.join(mixed_.select("token", parts.alias("parts")), "token").join(sets.select("s", "brief"), "s")
    own = F.pmod(F.xxhash64("s"), F.col("parts")).cast("int")
    rows = rows.select("token", "s", "n", "pos", "label", "brief", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with"))
    rows = rows.select("token", F.least("own", "with").alias("p"), F.greatest("own", "with").alias("q"), "s", "n", "pos", "label", "own", "brief")
    lists = rows.groupBy("token", "p", "q").agg(*[F.collect_list(c).alias(c) for c in ("s", "n", "pos", "label", "own", "brief")]).drop("token")

    def run(batches):
        for b in batches:
            stops = b.column("s").offsets.to_numpy()
            s, n, pos, label, own = (b.column(c).values.to_numpy(zero_copy_only=False) for c in ("s", "n", "pos", "label", "own"))
            brief = np.frombuffer(b"".join(b.column("brief").values.to_pylist()), np.uint64).reshape(-1, BRIEF // 64)
            p, q = b.column("p").to_numpy(), b.column("q").to_numpy()
            found = [np.zeros((2, 0), np.int64)]
            for k, (i, j) in enumerate(zip(stops[:-1], stops[1:])):
                found.append(list_pairs(s[i:j], n[i:j], pos[i:j], label[i:j], (own[i:j] == q[k]) & (p[k] != q[k]), brief[i:j], percent))
            a, c = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, c)), pa.array(np.maximum(a, c))], ["a", "b"])

    return lists.mapInArrow(run, "a long, b long").distinct()


def near_enough(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose parity bits allow a link; ``sets`` has ``s, n, bits``, once for each set."""

    def run(batches):
        for b in batches:
            keep = []
            for n, x, y in zip(b.column("n").to_pylist(), b.column("x").to_pylist(), b.column("y").to_pylist()):
                keep.append(parity_distance(x, y) <= n + 2 * (-percent * n // (100 + percent)))  # what both have, less twice the least overlap
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("s").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x"))
    y = sets.select(F.col("s").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", (F.col("na") + F.col("nb")).alias("n"), "x", "y")
    return both.mapInArrow(run, "a long, b long")


def linked(docs: DataFrame, own: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs of sets whose similarity is high enough: by parity bits first, then by all their tokens.

    Sets of the pairs that are left are made again from the text of one document each. A bitmap of fixed size says which
    documents these may be, so that the others are passed over unread; rows without an id are all read.
    """
    sets = own.filter("n > 0").groupBy("s").agg(F.min("doc_id").alias("doc_id"), F.any_value("n").alias("n"), F.any_value("bits").alias("bits"))
    close = materialise(near_enough(pairs, sets, percent))
    ends = close.select(F.explode(F.array("a", "b")).alias("s")).distinct()
    holders = own.join(ends, "s", "left_semi").groupBy("s").agg(F.min("doc_id").alias("doc_id"))
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(NEED_BITS))
    cells = holders.filter("doc_id is not null").select(F.floor(cell / 4096).alias("at"), (cell % 4096).cast("int").alias("bit")).groupBy("at").agg(F.collect_set("bit").alias("bits"))
    need = np.zeros(NEED_BITS, bool)
    for r in cells.toArrow().to_batches():
        lists = r.column("bits")
        need[np.repeat(r.column("at").to_numpy() * 4096, lists.value_lengths().to_numpy()) + lists.flatten().to_numpy()] = True
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(need, bitorder="little").tobytes())

    def run(batches):
        lean_memory()
        bits = np.frombuffer(sent.value, np.uint8)
        for b in pieces(batches):
            at = b.column("cell").fill_null(0).to_numpy()
            wanted = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool) | b.column("cell").is_null().to_numpy(zero_copy_only=False)
            flat, stops = token_sets(b.column("text").filter(pa.array(wanted)), size)
            out = {set_name(flat[i:j]): flat[i:j].tobytes() for i, j in zip(stops[:-1].tolist(), stops[1:].tolist()) if j > i}
            name = np.array(list(out), np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(list(out.values()), pa.binary())], ["s", "tokens"])

    rows = docs.select("text", F.when(F.col("doc_id").isNotNull(), cell).alias("cell"))
    tokens = rows.mapInArrow(run, "s long, tokens binary").join(ends, "s", "left_semi").groupBy("s").agg(F.any_value("tokens").alias("tokens"))

    def compare(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    tokens = materialise(tokens)
    full = close.join(tokens.select(F.col("s").alias("a"), F.col("tokens").alias("x")), "a").join(tokens.select(F.col("s").alias("b"), F.col("tokens").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 90, block: int = 2048) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document.

    Two documents link when 100 times what their sets share is at least ``percent`` times what both have; ``component_id`` is the
    smallest doc_id reachable. Texts without words (and null ones) have an empty set and link with nothing. A null doc_id is
    the smallest of nothing: its row links others and has their component, null where only null ids are linked. Repeated rows
    and equal texts share a component. No documents give no rows.
    """
    docs = _picked(docs, id_col, text_col)
    own = materialise(set_rows(docs, size, percent))
    prefixes = own.filter("n > 0").select("s", "n", "prefix").dropDuplicates(["s"])
    sets = own.filter("n > 0").groupBy("s").agg(F.any_value("brief").alias("brief"))
    every = prefixes.select("s", "n", F.posexplode("prefix").alias("pos", "token"))
    every = every.select("token", "s", F.col("n"), F.col("pos").cast("long").alias("pos"))
    common = every.groupBy("token").count().filter("count > 1").select("token")
    posts = materialise(every.join(common, "token", "left_semi"))
    first = materialise(linked(docs, own, guides(posts, percent), size, percent))
    labels = materialise(components(first))
    rest = materialise(open_pairs(posts, labels, sets, percent, block))
    labels = components(first.unionByName(linked(docs, own, rest, size, percent)))
    named = own.join(labels.withColumnRenamed("node", "s"), "s", "left").select("doc_id", "n", F.coalesce("component", "s").alias("c"))
    least = named.filter("n > 0").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    out = named.filter("n > 0").join(least, "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(named.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
