"""The n-gram Jaccard join against all pairs of sets."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from siltwave.llm import jaccard_join as J

SCHEMA = "doc_id long, text string, token string, s int, n int, prefix string, component long"


def set_of(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def components_by_loop(rows, percent=90):
    sets = [set_of(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    lists = defaultdict(list)
    for i, x in enumerate(sets):
        for w in x:
            lists[w].append(i)
    seen = {frozenset((i, j)) for m in lists.values() for k, i in enumerate(m) for j in m[:k]}
    for pair in seen:
        i, j = sorted(pair)
        both = len(sets[i] & sets[j])
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            up[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(((doc, len(sets[i]), least.get(top(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=str)


def table():
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(400)}"
    base = [word() for _ in range(150)]
    texts = [None, "", " \n", "a", "A", "a b", "a b", "a b c", "x " * 3000, "X " * 2999]
    for k in range(120):  # near copies at every distance, some of copies of copies
        w = list(base) if k % 3 else texts[-1].split()
        w = w if len(w) > 100 else list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = word() if rng.random() < 0.7 else f"fresh{rng.random()}"
        texts.append(" ".join(w))
    passage = " ".join(word() for _ in range(60))
    texts += [passage + " " + " ".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(60)] + [passage, passage + " tail", passage.upper()]
    chain = [word() for _ in range(200)]
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = chain[3:] + [word() for _ in range(2)]
    long = [f"z{rng.randrange(90_000)}" for _ in range(60_000)]
    texts += [" ".join(long), " ".join(long[:-900]), " ".join(long[9000:])]
    return [(i, t) for i, t in enumerate(texts)] + [(None, texts[20]), (7, texts[21]), (7, texts[21]), (None, " ".join(base[:149]))]


@pytest.mark.parametrize("block", [2048, 16])
def test_components_equal_all_pairs(spark, block):
    docs = spark.createDataFrame([(*r, "t", 1, 1, "p", 5) for r in table()], SCHEMA).repartition(6)
    out = sorted(map(tuple, J.jaccard_components(docs, block=block).collect()), key=str)
    assert out == components_by_loop(table())


def test_lower_similarity_and_hash_order(spark, monkeypatch):
    monkeypatch.setattr(J, "FREQUENT", 1 << 40)  # no token is known to be frequent: the same links by another order
    docs = spark.createDataFrame([(*r, "t", 1, 1, "p", 5) for r in table()], SCHEMA).repartition(3)
    assert sorted(map(tuple, J.jaccard_components(docs, percent=70).collect()), key=str) == components_by_loop(table(), 70)


def test_a_dense_group_is_answered_by_its_guides(spark):
    """1,500 near copies of one text, all linked: after the guides' answers no pair is left."""
    rng = random.Random(1)
    base = [f"b{i}" for i in range(300)]
    rows = [(i, " ".join(base[: (k := rng.randrange(300))] + [f"own{i}"] + base[k + 1 :]), "t", 1, 1, "p", 5) for i in range(1500)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    own = J.materialise(J.set_rows(J._picked(docs, "doc_id", "text"), 3, 90))
    posts = J.materialise(own.select("s", "n", J.F.posexplode("prefix").alias("pos", "token")).select("token", "s", "n", J.F.col("pos").cast("long").alias("pos")))
    pairs = J.guides(posts, 90)
    assert pairs.count() <= 1500
    labels = J.components(J.linked(J._picked(docs, "doc_id", "text"), own, pairs, 3, 90))
    assert labels.select("component").distinct().count() <= 3 and labels.count() >= 1490
    assert J.open_pairs(posts, labels, own.select("s", "brief"), 90).count() < 20_000
    assert J.jaccard_components(docs).select("component_id").distinct().count() == 1


def test_skipped_blocks_hold_no_pair_that_may_link():
    rng = np.random.default_rng(3)
    for _ in range(30):
        k = 60
        n = rng.integers(10, 60, k)
        pos = rng.integers(0, 6, k)
        s, label, other = np.arange(k), rng.integers(0, 8, k), rng.integers(0, 2, k).astype(bool)
        for part in (other, np.zeros(k, bool)):
            want = {(i, j) for i in range(k) for j in range(i) if label[i] != label[j] and (not part.any() or part[i] != part[j])
                    and 100 * min(n[i], n[j]) >= 90 * max(n[i], n[j]) and 190 * min(n[i] - pos[i], n[j] - pos[j]) >= 90 * (n[i] + n[j])}
            assert {(max(p), min(p)) for p in J.list_pairs(s, n, pos, label, part, np.zeros((k, 8), np.uint64), 90).T.tolist()} == want


def test_token_sets_equal_the_loop():
    rng = random.Random(2)
    texts = [t for _, t in table()] + ["\x0b a\x1cb  É é A", "x" * 3000 + " y", "y " + "X" * 3000, "w " * 40_000 + "z" * 1023 + " " + "z" * 1024 + " end"]
    texts += ["".join(rng.choice("aAbé \n\t") for _ in range(rng.randrange(60))) for _ in range(300)]
    column = J.pa.array(["left out", *texts])[1:]
    flat, at = J.token_sets(column)
    own, seen = [flat[i:j].tolist() for i, j in zip(at[:-1], at[1:])], {}
    for x, text in zip(own, texts):
        want = set_of(text)
        assert len(x) == len(want) == len(set(x)) and x == sorted(x)
        assert seen.setdefault(want, x) == x
    assert len({tuple(x) for x in seen.values()}) == len(seen)
    for k in range(1, len(texts)):
        assert len(set(own[k]) & set(own[k - 1])) == len(set_of(texts[k]) & set_of(texts[k - 1]))


def test_parity_bits_never_overstate_the_difference():
    rng = np.random.default_rng(8)
    for _ in range(300):
        both = rng.integers(0, 1 << 63, rng.integers(0, 900)).astype(np.uint64)
        x, y = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, rng.integers(1, 400)).astype(np.uint64)])) for _ in range(2))
        assert J.parity_distance(J.parity(x), J.parity(y)) <= len(np.setxor1d(x, y))


def test_no_documents_give_no_rows(spark):
    assert J.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_query_returns_the_whole_table(spark):
    from siltwave.llm import queries

    rows = [tuple(r.values()) for r in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    out = queries.op12_ngram_jaccard_join(spark, "/root/testdata/sf0.01")
    assert sorted(map(tuple, out.collect()), key=str) == components_by_loop(rows)
