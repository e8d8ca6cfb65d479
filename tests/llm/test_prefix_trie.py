"""The prefix trie against all prefixes of every conversation."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from siltwave.llm import prefix_trie as T

SCHEMA = "conv_id long, turn int, role string, text string, key string, ids int, node string"


def tree_by_loop(rebuilt):
    members, ends, kids, parent = defaultdict(list), defaultdict(list), defaultdict(set), {}
    for c, turns in rebuilt:
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                kids[turns[: d - 1]].add(turns[:d])
                parent[turns[:d]] = turns[: d - 1]
        ends[turns].append(c)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        own = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += own
            leaves[p[:d]] += not kids[p]
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return Counter((min(m), len(p), min(members[parent[p]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], sha(p)) for p, m in members.items())


def by_turn(rows):
    out = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            role, text = r[2] or "", r[3] or ""
            name = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            out[r[0]].append(((r[1] is not None, r[1] or 0, name, len(text)), (role, text)))
    return {c: tuple(t for _, t in sorted(x)) for c, x in out.items()}


def rebuilt_by_loop(own):
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        yield c, own.get(c - c % 100, ())[:h] + turns[h:]


def rows():
    rng = random.Random(5)
    words = ["", "a", "b", "hello there", "é" * 40, None]
    out = [(c, t, rng.choice(["user", "bot", None]), rng.choice(words), "k", 1, "n") for c in range(420) for t in range(rng.randrange(1, 7))]
    out += [(1000 + c, t, "user", f"turn {t}", "k", 1, "n") for c in range(150) for t in range(3)]  # many equal ones
    out += [(2000 + c, t, "user", f"{t} {c % 70}", "k", 1, "n") for c in range(300) for t in range(2)]  # over 48 branches
    out += [(5000, t, "bot", "x" * (t % 9), "k", 1, "n") for t in range(700)] + [(5000, 3, "bot", "again", "k", 1, "n"), (5001, None, "bot", "first", "k", 1, "n"), (5001, 0, "user", "y" * 100_000, "k", 1, "n")]
    return out + [(None, 1, "user", "nobody's", "k", 1, "n"), (400 + 7, None, None, None, "k", 1, "n")]


def collected(df):
    return Counter(tuple(r)[:8] for r in df.collect())


@pytest.mark.parametrize("chunk", [1, 7, 8000])
def test_nodes_equal_the_loop(spark, chunk):
    own = T.turn_ids(spark.createDataFrame(rows(), SCHEMA).repartition(6))
    out = T.trie_nodes(T.as_keys(T.rebuilt(own)), chunk=chunk, span=64)
    assert collected(out) == tree_by_loop(rebuilt_by_loop(by_turn(rows())))


def test_conversations_as_they_are(spark):
    out = T.trie_nodes(T.as_keys(T.turn_ids(spark.createDataFrame(rows(), SCHEMA))), chunk=100)
    assert collected(out) == tree_by_loop(by_turn(rows()).items())


def test_turnless_conversations_are_members_of_the_root(spark):
    keys = spark.createDataFrame([(5, b""), (3, b""), (9, b"\1" * 40), (7, b"\1" * 20)], "conv_id long, key binary")
    out = {r.depth: (r.conv_id, r.n_convs, r.n_children, r.n_leaves, r.ends_sha256) for r in T.trie_nodes(keys).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert out == {0: (3, 4, 1, 1, sha("3,5")), 1: (7, 2, 1, 1, sha("7")), 2: (9, 1, 0, 1, sha("9"))}
    assert [tuple(r)[3:6] for r in T.trie_nodes(keys.filter("key = X''")).collect()] == [(2, 0, 1)]


def test_no_conversations_give_no_nodes(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.trie_nodes(T.as_keys(T.rebuilt(T.turn_ids(empty)))).count() == 0


@pytest.mark.parametrize("alphabet", [3, 17, 60, 256])
def test_the_tree_grows_through_its_layouts(alphabet):
    rng = random.Random(alphabet)
    keys = sorted({bytes(rng.randrange(alphabet) for _ in range(rng.choice([0, 2, 4, 6]))) for _ in range(4000)})
    tree = T.RadixTree()
    for i in rng.sample(range(len(keys)), len(keys)):
        tree.put(keys[i], i)
    found = T.aligned_nodes(tree, keys, [1] * len(keys), list(range(len(keys))), width=2)
    want = Counter(k[:d] for k in keys for d in range(0, len(k) + 1, 2))
    assert {keys[lo][: d * 2]: n for d, lo, _, n, *_ in found} == want
    kinds = {3: T.Few, 17: T.Indexed, 60: T.Direct, 256: T.Direct}
    assert type(tree.root.kids) is kinds[alphabet] and (alphabet != 3 or tree.root.kids.room == 4)


def test_the_query_returns_the_whole_table(spark):
    from siltwave.llm import queries

    table = [tuple(r.values()) for r in pq.read_table("/root/testdata/sf0.001/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    out = queries.op11_conversation_prefix_trie(spark, "/root/testdata/sf0.001")
    assert collected(out) == tree_by_loop(rebuilt_by_loop(by_turn(table)))
    assert out.dtypes == [(c, "string" if c == "ends_sha256" else "bigint") for c in out.columns]
