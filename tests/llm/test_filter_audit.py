"""The filter audit against loops over every document and order."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from siltwave.llm import filter_audit

SCHEMA = "doc_id long, text string, source string, h int, mask string, part string"


def rows():
    long = " ".join(f"word{i}" for i in range(230))
    texts = [None, "", "", "a", "A B C", long, long, long, long + " #", "same " * 300, "same " * 300, "X" * 9000, "x y " * 4000, "\x0b\x0c a b ÀÉ É", long.upper()]
    out = [(i, t, ["a", "b", None, ""][i % 4], 1, "m", "p") for i, t in enumerate(texts)]
    out += [(100 + i, long, "hot", 1, "m", "p") for i in range(60)] + [(None, long, "a", 1, "m", "p")] * 2 + [(3, "a", "b", 1, "m", "p"), (3, "other", "b", 1, "m", "p"), (2, "a", "b", 1, "m", "p")]
    return out + [(500 + i, f"{long} {i // 2}", "c", 1, "m", "p") for i in range(400)]


LABELS = [(5, 1, 0), (6, 1, 1), (6, 0, 0), (9, None, 1), (10, 0, 1), (101, 1, 0), (None, 1, 1), (9999, 1, 1)]


def masks_by_loop(table):
    least = {}
    for i, t, *_ in table:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, source, *_ in table:
        x, w = t or "", re.findall(r"[^\x20\x09-\x0D]+", t or "")
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", x)) > 2 * len(x), bool(re.search(r"[#$%&*|]", x)), i is not None and least[x] < i]
        out.append((i, source or "", sum(f << k for k, f in enumerate(fails))))
    return out


@pytest.fixture(scope="module")
def found(spark):
    return filter_audit.masks(spark.createDataFrame(rows(), SCHEMA).repartition(7))


def test_masks_equal_the_loop(found):
    assert Counter(map(tuple, found.collect())) == Counter(masks_by_loop(rows()))


@pytest.mark.parametrize("cells", [1, 1 << 17])
def test_a_crowded_sketch_clears_less_and_loses_nothing(spark, cells):
    docs = spark.createDataFrame([(i, f"text {i // 3}", "s", 1, "m", "p") for i in range(30_000)], SCHEMA).repartition(5)
    out = filter_audit.masks(docs, most_cells=cells)
    assert {r.doc_id for r in out.filter("mask >= 16").collect()} == {i for i in range(30_000) if i % 3}


def test_the_sketch_clears_most_unique_texts(spark):
    own = filter_audit.flags(spark.createDataFrame([(i, f"text {min(i, 19_000)}", "s", 1, "m", "p") for i in range(20_000)], SCHEMA).repartition(5))
    segments, twice = filter_audit.sketch(own, 20_000)
    h = np.array([r.h for r in own.filter("doc_id < 19000").collect()])
    same = np.array([r.h for r in own.filter("doc_id >= 19000").collect()])
    assert filter_audit.may_repeat(same, segments, twice).all()
    assert filter_audit.may_repeat(h, segments, twice).mean() < 0.02


def test_all_orders_equal_the_loop(spark, found):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.orders(filter_audit.mask_counts(found, labels)).collect()}
    good, toxic = {i for i, q, _ in LABELS if q == 1}, {i for i, _, t in LABELS if t == 1}
    by, shapley, want = defaultdict(list), Counter(), {}
    for i, part, mask in masks_by_loop(rows()):
        by[part].append((i, mask))
    for part, own in by.items():
        for p in permutations("ABCDE"):
            left = own
            for step, x in enumerate(p, 1):
                bit, before = 1 << "ABCDE".index(x), sum(1 << "ABCDE".index(y) for y in p[: step - 1])
                lost = [(i, m) for i, m in left if m & bit]
                left = [(i, m) for i, m in left if not m & bit]
                again = sum(1 for _, m in own if m & bit and m & before)
                only = sum(1 for _, m in own if m == bit)
                want[part, "".join(p), step] = (len(left), len(lost), again, only, sum(i in good for i, _ in lost if i is not None), sum(i in toxic for i, _ in lost if i is not None))
                shapley[part, x] += len(lost)
    assert got == {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in want.items()}


def test_no_documents_give_no_rows(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
