"""Prefixes that conversations share, as an adaptive radix tree over turn ids.

A turn becomes an id of ``WIDTH`` bytes, big-endian: 16 of the MD5 of role and text, 4 with the code points of the text. A
conversation is the string of its ids. Distinct strings are dealt out by range; a task takes its sorted strings chunk by
chunk, puts each chunk into a radix tree with path compression, and emits a node wherever a depth of the tree, or of a
compressed path in it, is a whole number of turns. All figures of a node are sums or minima over chunks, but for what two
neighbouring chunks both count; that is the path which the last string of the one shares with the first of the other, and
a few rows for each such seam take it back. So only the nodes on seams are grouped; all others are complete where they arise.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import materialise

WIDTH = 20
ROOT, NO_ENDS = hashlib.md5(b"").digest(), hashlib.sha256(b"").hexdigest()
ROWS = "slot int, depth int, node binary, parent binary, least long, parent_least long, n long, kids long, leaves long, saved long, sha string, open boolean, first binary, last binary"
KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
ROW_TYPES = [(c.split(" ")[0], KINDS[c.split(" ")[1]]) for c in ROWS.split(", ")]


class Few:
    """Up to 4, then up to 16 branches: sorted bytes beside their nodes."""

    __slots__ = ("keys", "nodes", "room")

    def __init__(self, room: int = 4):
        self.keys, self.nodes, self.room = bytearray(), [], room

    def get(self, byte: int):
        i = bisect_left(self.keys, byte)
        return self.nodes[i] if i < len(self.keys) and self.keys[i] == byte else None

    def put(self, byte: int, node) -> None:
        i = bisect_left(self.keys, byte)
        if i < len(self.keys) and self.keys[i] == byte:
            self.nodes[i] = node
        else:
            self.keys.insert(i, byte)
            self.nodes.insert(i, node)

    def full(self) -> bool:
        return len(self.nodes) == self.room

    def items(self):
        return list(zip(self.keys, self.nodes))

    def grown(self):
        return moved(self, Few(16) if self.room == 4 else Indexed())


class Indexed:
    """Up to 48 branches: a place for every byte that points into a list of nodes."""

    __slots__ = ("at", "nodes")

    def __init__(self):
        self.at, self.nodes = bytearray(256), []

    def get(self, byte: int):
        return self.nodes[self.at[byte] - 1] if self.at[byte] else None

    def put(self, byte: int, node) -> None:
        if self.at[byte]:
            self.nodes[self.at[byte] - 1] = node
        else:
            self.nodes.append(node)
            self.at[byte] = len(self.nodes)

    def full(self) -> bool:
        return len(self.nodes) == 48

    def items(self):
        return [(b, self.nodes[i - 1]) for b, i in enumerate(self.at) if i]

    def grown(self):
        return moved(self, Direct())


class Direct:
    """Up to 256 branches: a node for every byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node) -> None:
        self.nodes[byte] = node

    def full(self) -> bool:
        return False

    def items(self):
        return [(b, x) for b, x in enumerate(self.nodes) if x is not None]


def moved(old, new):
    for byte, node in old.items():
        new.put(byte, node)
    return new


def shared(a: bytes, b: bytes) -> int:
    """How many leading bytes are equal."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    return lo


class Node:
    __slots__ = ("path", "value", "kids")

    def __init__(self, path: bytes, value=None):
        self.path, self.value, self.kids = path, value, Few()

    def branch(self, byte: int, node: Node) -> None:
        if self.kids.full() and self.kids.get(byte) is None:
            self.kids = self.kids.grown()
        self.kids.put(byte, node)


class RadixTree:
    """An adaptive radix tree; a string may be the prefix of another."""

    def __init__(self):
        self.root = Node(b"")

    def put(self, key: bytes, value) -> None:
        node, at, above, byte = self.root, 0, None, 0
        while True:
            m = shared(node.path, key[at : at + len(node.path)])
            if m < len(node.path):  # the key leaves within the compressed path
                upper = Node(node.path[:m])
                upper.branch(node.path[m], node)
                node.path = node.path[m + 1 :]
                if above is None:
                    self.root = upper
                else:
                    above.branch(byte, upper)
                node = upper
            at += m
            if at == len(key):
                node.value = value
                return
            above, byte = node, key[at]
            node = above.kids.get(byte)
            if node is None:
                above.branch(byte, Node(key[at + 1 :], value))
                return
            at += 1


def aligned_nodes(tree: RadixTree, keys: list[bytes], counts: list[int], least: list[int], width: int = WIDTH):
    """Nodes at whole turns, children before parents: ``[depth, lo, hi, n, least, kids, leaves, saved, ends, parent]``.

    Values of the tree are places in ``keys``; lo and hi are the first and last string below, ``ends`` the one that ends there.
    """
    out, done = [], []  # done: sums of finished subtrees, popped by the node above
    todo = [(tree.root, -1, len(tree.root.path), None)]
    while todo:
        node, above, end, kids = todo.pop()
        if kids is None:
            kids = node.kids.items()
            todo.append((node, above, end, len(kids)))
            todo += [(x, end, end + 1 + len(x.path), None) for _, x in reversed(kids)]
            continue
        below = done[len(done) - kids :]
        del done[len(done) - kids :]
        i = node.value
        lo, hi, n, low, leaves, saved, tops = (i, i, counts[i], least[i], 0, 0, []) if i is not None else (below[0][0], 0, 0, None, 0, 0, [])
        for b in below:
            hi, n, leaves, saved = b[1], n + b[2], leaves + b[4], saved + b[5]
            low = b[3] if low is None or b[3] < low else low
            tops = tops + b[6] if tops else b[6]
        for d in range(end // width, above // width, -1):
            leaves = leaves if tops else 1
            if d:
                saved += (n - 1) * int.from_bytes(keys[lo][d * width - 4 : d * width])
            for t in tops:
                out[t][9] = len(out)
            out.append([d, lo, hi, n, low, len(tops), leaves, saved, i if d * width == end else None, None])
            tops = [len(out) - 1]
        done.append((lo, hi, n, low, leaves, saved, tops))
    return out


def chained(keys: list[bytes], width: int = WIDTH):
    """For each sorted string the depth that it shares with the one before, and the names of its further prefixes."""
    stack, before, out = [ROOT], b"", []
    for k, key in enumerate(keys):
        same = shared(before, key) // width if k else -1
        del stack[same + 1 :]
        fresh = [] if k else [ROOT]
        if not k:
            same, stack = -1, [ROOT]
        for d in range(len(stack), len(key) // width + 1):
            stack.append(hashlib.md5(stack[-1] + key[(d - 1) * width : d * width]).digest())
            fresh.append(stack[-1])
        out.append((same, fresh))
        before = key
    return out


def seam(last: bytes, first: bytes, width: int = WIDTH):
    """What two neighbouring chunks both count, as rows to add: the shared path was begun in the first of them."""
    depth = shared(last, first) // width
    name, names = ROOT, [ROOT]
    for d in range(depth):
        name = hashlib.md5(name + first[d * width : (d + 1) * width]).digest()
        names.append(name)
    twice = 0
    for d in range(depth, -1, -1):
        twice += int.from_bytes(first[d * width - 4 : d * width]) if d else 0
        yield {"depth": d, "node": names[d], "n": 0, "kids": -(d < depth), "leaves": -(len(last) == depth * width), "saved": twice, "open": True, "parent": names[d - 1] if d else None}


def batch_of(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in ROW_TYPES], [c for c, _ in ROW_TYPES])


def chunk_rows(chunk, before: bytes | None, after: bytes | None) -> list[dict]:
    """The nodes of one chunk of distinct sorted strings; ``before`` and ``after`` are its neighbours, None where unknown."""
    keys, counts, least, shas = (list(x) for x in zip(*chunk))
    tree = RadixTree()
    for i, key in enumerate(keys):
        tree.put(key, i)
    head = len(keys[0]) if before is None else shared(before, keys[0])
    tail = len(keys[-1]) if after is None else shared(keys[-1], after)
    found, names = aligned_nodes(tree, keys, counts, least), chained(keys)
    opened = [lo == 0 and d * WIDTH <= head or hi == len(keys) - 1 and d * WIDTH <= tail for d, lo, hi, *_ in found]
    name = [names[lo][1][d - names[lo][0] - 1] for d, lo, *_ in found]
    rows = []
    for k, (d, _, _, n, low, kids, leaves, saved, ends, up) in enumerate(found):
        known = None if up is None or opened[up] else found[up][4]
        rows.append({"depth": d, "node": name[k], "parent": None if up is None else name[up], "least": low, "parent_least": known, "n": n, "kids": kids, "leaves": leaves, "saved": saved, "sha": None if ends is None else shas[ends], "open": opened[k]})
    if before is not None:
        rows += seam(before, keys[0])
    return rows


def entries(batches):
    """``slot, (string, count, smallest id, SHA-256 of its ids)`` from sorted parts of the strings' id lists."""
    held = None
    for b in batches:
        slots, keys, counts, least, lists = (b.column(c) for c in ("slot", "key", "n", "least", "ids"))
        for i in range(b.num_rows):
            key, n, ids = keys[i].as_py(), counts[i].as_py(), lists[i].as_py().encode()
            if held and held[1] == key:
                held[2] += n
                held[4].update(b"," + ids)
                continue
            if held:
                yield held[0], (*held[1:4], held[4].hexdigest())
            held = [slots[i].as_py(), key, n, least[i].as_py(), hashlib.sha256(ids)]
    if held:
        yield held[0], (*held[1:4], held[4].hexdigest())


def trie_nodes(keys: DataFrame, chunk: int = 8_000, chunk_bytes: int = 4 << 20, span: int = 1 << 16) -> DataFrame:
    """All nodes of the trie over ``conv_id, key`` (a string of turn ids, maybe empty), one row each:

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Null ids are left out; an id that comes twice counts twice. The ids of equal conversations pass through a task in
    parts of up to ``span``; a chunk holds up to ``chunk`` strings or ``chunk_bytes``, and a single string whole. No rows give no nodes.
    """
    ids = F.sort_array(F.collect_list("conv_id"))
    parts = keys.filter("conv_id is not null").groupBy("key", F.floor(F.col("conv_id") / span).alias("bucket")).agg(ids.alias("ids"))
    joined = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    parts = parts.select("key", "bucket", F.size("ids").cast("long").alias("n"), F.col("ids")[0].alias("least"), joined.alias("ids"))
    ranged = parts.repartitionByRange("key").sortWithinPartitions("key", "bucket").select(F.spark_partition_id().alias("slot"), "key", "n", "least", "ids")

    def build(batches):
        held, size, before, first, slot, last = [], 0, None, None, None, None
        for slot, e in entries(batches):
            if held and (len(held) >= chunk or size >= chunk_bytes):
                yield batch_of(chunk_rows(held, before, e[0]))
                before, held, size = held[-1][0], [], 0
            first = e[0] if first is None else first
            held.append(e)
            size, last = size + len(e[0]), e[0]
        if held:
            yield batch_of([*chunk_rows(held, before, None), {"slot": slot, "depth": -1, "first": first, "last": last, "open": False}])

    rows = materialise(ranged.mapInArrow(build, ROWS))

    def seams(batches):
        for b in batches:
            for last, first in zip(b.column("last").to_pylist(), b.column("next").to_pylist()):
                if first is not None:
                    yield batch_of(list(seam(last, first)))

    ends = rows.filter("depth = -1").select("last", F.lead("first").over(W.orderBy("slot")).alias("next"))  # one row a task
    opened = rows.filter("open").unionByName(ends.mapInArrow(seams, ROWS))
    total = lambda c: F.sum(c).alias(c)
    merged = materialise(opened.groupBy("node").agg(F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.min("least").alias("least"), total("n"), total("kids"), total("leaves"), total("saved"), F.max("sha").alias("sha")))
    columns = ["depth", "parent", "least", "n", "kids", "leaves", "saved", "sha"]
    inner = rows.filter("depth >= 0 and not open")
    loose = inner.filter("parent_least is null").select(*columns).unionByName(merged.select(*columns))
    loose = loose.join(merged.select(F.col("node").alias("parent"), F.col("least").alias("parent_least")), "parent", "left")
    out = inner.filter("parent_least is not null").select(*columns, "parent_least").unionByName(loose.select(*columns, "parent_least"))
    return out.select(
        F.col("least").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent_least").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def turn_ids(conversations: DataFrame) -> DataFrame:
    """``conv_id, ids``: each conversation's turn ids as hexadecimal, by turn (null first), turns of one number by id.

    Null roles and texts are empty; rows without a conv_id belong to no conversation. A conversation is held in one row.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turn = F.struct(F.col("turn"), F.concat(F.upper(name), F.lpad(F.hex(F.length(text).cast("long")), 8, "0")).alias("id"))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).getField("id").alias("ids"))


def rebuilt(own: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """``conv_id, ids``: the first h turns of the group's first conversation, then each one's own after its first h.

    h is the CRC-32 of the decimal id modulo ``most``; a group without its first conversation gives no turns.
    """
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = own.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("ids", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    rows = own.select("conv_id", "ids", base.alias("base"), h.alias("h")).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    return rows.select("conv_id", F.concat(head, F.slice("ids", F.col("h") + 1, F.size("ids"))).alias("ids"))


def as_keys(conversations: DataFrame) -> DataFrame:
    """``conv_id, key`` from ``conv_id, ids``."""
    return conversations.select("conv_id", F.unhex(F.array_join("ids", "")).alias("key"))
