"""Each operator against a brute-force version on one small table: copies, near copies, nulls, empty and long texts."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from siltwave.llm import bpe, langid, media, mixing, pii, quality, queries, simhash, suffix_dedup, token_count, token_files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, h int, key string, at string"


def table():
    rows = [tuple(r.values()) for r in pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()]
    rng = random.Random(3)
    base = " ".join(rng.choice("alpha beta gamma delta rho tau omega kappa".split()) + str(rng.randrange(90)) for _ in range(120))
    extra = [None, "", " \n\t", "a", "a b", "x" * 5000, "ab " * 3000, base, base, base + " tail", base[:400], "é" * 60, "1 2 3", "<|endoftext|> A <|startoftext|>"]
    extra += [base.replace("alpha", f"alpha{i}", 1) for i in range(12)]
    extra += ["line one\nline one\n\nline one\r\n#$% <b>|", "mail me: jo.doe@ex.org, 10.0.0.300 10.1.2.3 4111 1111 1111 1111 +1 (555) 123-4567"]
    rows += [(1000 + i, t, None if i % 3 else "en", None if i % 4 == 0 else "hot", None) for i, t in enumerate(extra)]
    rows += [rows[5], (None, base, "en", "hot", 3), (None, None, None, None, None)]
    return [(*r, "fp", 1, "key", "at") for r in rows]


ROWS = table()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ordered(rows):
    return sorted(rows, key=repr)


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def test_simhash(docs, empty):
    def plain(text):
        w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in words(text)]
        if not w:
            return 0
        sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [(r[0], plain(r[1])) for r in ROWS]
    distinct = sorted({f for _, f in fps})
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for d, f in fps:
        if d is not None:
            least[find(f)] = min(d, least[find(f)] if least[find(f)] is not None else d)
    want = [(d, f"{f:016x}", least[find(f)]) for d, f in fps]
    for block in (4096, 3):  # the second deals every bucket out as pairs of blocks
        got = simhash.near_duplicates(docs, block=block)
        assert ordered(map(tuple, got.collect())) == ordered(want)
    assert simhash.near_duplicates(empty).count() == 0
    wide = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(docs, most=7, size=5).filter("doc_id is not null").collect()}
    own = [(d, f) for d, f in wide]
    parent = {x: x for x in own}
    for i, a in enumerate(own):
        for b in own[i + 1 :]:
            if (int(a[1], 16) ^ int(b[1], 16)).bit_count() <= 7 or a[0] == b[0]:
                parent[find(a)] = find(b)
    least = {}
    for x in own:
        least[find(x)] = min(x[0], least.get(find(x), x[0]))
    assert wide == {x: least[find(x)] for x in own}


@pytest.mark.parametrize("most", [3, 7])
def test_simhash_keys_meet_for_all_close_pairs(spark, most, monkeypatch):
    rng = random.Random(1)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), rng.randrange(1, most + 1)):
            b ^= 1 << k
        pairs += [a, b]
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(pairs)], "node long, fp long")
    for block in (4096, 2):
        got = {frozenset(r) for r in simhash.links(nodes, most, block).collect()}
        assert got == {frozenset((2 * i, 2 * i + 1)) for i in range(300)}
    _, plan = simhash.ring_plan(most)
    assert all(any((a ^ b) & m == 0 for _, m in plan) for a, b in zip(pairs[::2], pairs[1::2]))


def test_simhash_buckets_of_every_size():
    """Dense and large buckets give a forest that joins what all pairs would."""
    rng = np.random.default_rng(2)
    for most in (3, 7):
        for n in (2, 40, 700):
            seeds = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
            fps = np.unique(np.concatenate([s ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)) for s in seeds]))
            rng.shuffle(fps)
            for place in range(simhash.ring_plan(most)[0]):
                chained = lambda x: len(simhash._chained(place, np.array([x]), most)) > 0
                groups = list(range(len(fps)))

                def find(x):
                    while groups[x] != x:
                        x = groups[x]
                    return x

                a, b = simhash.bucket_links(np.array([place]), np.array([len(fps)]), fps, most)
                assert all(chained(fps[i] ^ fps[j]) for i, j in zip(a[:50], b[:50])) and len(a) <= 4 * len(fps)
                for i, j in zip(a.tolist(), b.tolist()):
                    groups[find(i)] = find(j)
                for i in range(0, len(fps), max(1, len(fps) // 40)):
                    near = simhash._chained(place, fps[i] ^ fps, most)
                    assert {find(int(j)) for j in near} == ({find(i)} if len(near) else set())


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7)]
    parent = list(range(500))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in range(500))


def brute_quality(text):
    w, out = words(text), {}
    out["n_words"], out["word_chars"] = len(w), sum(map(len, w))
    out["n_symbols"] = len(re.findall(r"[#*$%&|<>]", text or ""))
    lines = [x for x in (text or "").split("\n") if words(x)]
    out["n_dup_lines"] = len(lines) - len(set(lines))
    c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if c[tuple(w[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    out["n_repeat_words"] = len(hit)
    out["base_failed"] = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return out, len(lines) + 4


def test_quality(docs, empty):
    got = quality.quality_rules(docs, prior=20).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert ordered((r.doc_id, *[r[n] for n in names]) for r in got) == ordered((r[0], *[brute_quality(r[1])[0][n] for n in names]) for r in ROWS)

    def top(v):
        if v < 64:
            return v
        e = v.bit_length() - 1
        return ((v >> (e - 5)) + 1 << (e - 5)) - 1

    def rates(text):
        q, lines = brute_quality(text)
        per = lambda n, of, unit: n * unit // of if of else 0
        shares = per(q["n_symbols"], q["word_chars"], 10**6), per(q["n_dup_lines"], lines, 10**6), per(q["n_repeat_words"], q["n_words"], 10**6), per(q["word_chars"], q["n_words"], 1000)
        return q["base_failed"], shares, (q["word_chars"], q["n_words"] * 1000 // max(1, lines - 4), q["n_words"])

    measured = [(r[2], r[3], *rates(r[1])) for r in ROWS]
    good = [m for m in measured if not m[2]]

    def limits(own, by_lang):
        fine = 1 << 20
        lean = lambda k, e: math.floor((k + e * 20 / len(good)) * 20 / (len(by_lang) + 20) * fine)

        def quantile(value, percent, some=False):
            counts = [Counter(top(value(m)) for m in rows if not some or value(m) > 0) for rows in (own, by_lang, good)]
            w = {v: counts[0][v] * fine + lean(counts[1][v], counts[2][v]) for v in counts[2]}
            upto = 0
            for v in sorted(w):
                upto += w[v]
                if upto * 100 >= sum(w.values()) * percent:
                    return v
            return None

        chars, line_words, n_words = (max(1.0, quantile(lambda m, j=j: m[4][j], 50)) for j in range(3))
        out = []
        for k, (event, size) in enumerate(((1, chars), (1, n_words * 1000 / line_words + 4), (16, n_words))):
            one = event * 1e6 / size
            a, b, c = (quantile(lambda m, k=k: m[3][k], p, True) for p in (10, 25, 75))
            out.append(0 if a is None else math.floor(one * (c + (c - b) * 3) / max(a, one)))
        high, mid = (quantile(lambda m: m[3][3], p) for p in (90, 50))
        return [*out, high + (high - mid) * 8]

    kept = []
    for (lang, source, failed, rate, _), row in zip(measured, ROWS):
        own = [m for m in good if m[0] == lang and m[1] == source]
        by_lang = [m for m in good if m[0] == lang]
        kept.append((row[0], not failed and all(a <= b for a, b in zip(rate, limits(own, by_lang)))))
    assert ordered((r.doc_id, r.kept) for r in got) == ordered(kept)
    assert quality.quality_rules(empty).count() == 0


def test_quality_limits_adapt(spark):
    """Limits follow language and source, and part the labelled texts."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = quality.quality_rules(docs).join(docs.select("doc_id", "lang", "source"), "doc_id").cache()
    limits = got.select("lang", "source", *[f"limit_{m}" for m in quality.MEASURES]).distinct().toPandas()
    groups = limits.groupby(["lang", "source"]).ngroups
    for m in quality.MEASURES:
        counts = limits[f"limit_{m}"].value_counts()
        assert len(counts) >= 4 and limits.groupby("lang")[f"limit_{m}"].median().nunique() > 1, m
        assert counts.iloc[0] < 0.4 * groups, (m, counts.head())
    rows = got.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").filter("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in rows}
    assert kept[1] > 0.995 and kept[0] < 0.05
    signs = quality.thresholds(quality.blended(quality.sketches(quality.measures(docs).withColumn("base_failed", F.lit(False))), 10)).select("limit_symbols").distinct().count()
    assert signs > 20  # a smaller prior lets groups differ more


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    want = [(r[0], len((r[1] or "").encode()), n := len(lib.encode(r[1] or "", add_special_tokens=False).ids), n > 512) for r in ROWS]
    assert ordered(map(tuple, token_count.token_counts(docs, path).collect())) == ordered(want)
    assert token_count.token_counts(empty, path).count() == 0


def test_suffix_dedup(docs, empty, spark, monkeypatch):
    def brute(rows):
        first = {}
        for d, t in sorted((r[0], r[1] or "") for r in rows if r[0] is not None):
            data = t.encode()
            for i in range(len(data) - 49):
                first.setdefault(data[i : i + 50], d)
        out = []
        for r in rows:
            data = (r[1] or "").encode()
            gone = [False] * len(data)
            for i in range(len(data) - 49):
                if r[0] is not None and first[data[i : i + 50]] < r[0]:
                    gone[i : i + 50] = [True] * 50
            kept = bytes(b for b, g in zip(data, gone) if not g)
            spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
            out.append((r[0], len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
        return out

    def run(d, cover="content"):
        return ordered((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in suffix_dedup.remove_repeats(d, cover=cover).collect())

    assert run(docs) == run(docs, "difference") == ordered(brute(ROWS))
    p = suffix_dedup.PERIOD
    assert {(a - b) % p for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(p))
    rng = random.Random(9)
    small = []
    for i in range(120):  # few letters: partial matches of every length, at edges and inside
        t = "".join(rng.choice("ab") for _ in range(rng.randrange(30, 90)))
        if small:
            other = rng.choice(small)[1]
            a = rng.randrange(len(other))
            t = t[: rng.randrange(60)] + other[a : a + rng.randrange(40, 80)] + t[: rng.randrange(30)]
        small.append((i, t))
    rng.shuffle(small)
    few = spark.createDataFrame(small, "doc_id long, text string").repartition(4)
    assert run(few) == run(few, "difference") == ordered(brute(small))
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_parts_of_long_texts(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    import pyarrow as pa

    rng = random.Random(2)
    text = "".join(rng.choice("abcd") for _ in range(7000))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})
    found = {}
    for parts in suffix_dedup.stretches(batch, 50, 30):
        h, c, part, inside = suffix_dedup.samples(parts, 50, 20)
        for x, y, k, i in zip(h.tolist(), c.tolist(), part.tolist(), inside.tolist()):
            assert found.setdefault(parts[k][1] + i, (x, y)) == (x, y)  # seen from both sides of a border
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 20)
    (parts,) = suffix_dedup.stretches(batch, 50, 30)
    h, c, part, inside = suffix_dedup.samples(parts, 50, 20)
    assert found == dict(zip(inside.tolist(), zip(h.tolist(), c.tolist())))


def test_token_files(docs, empty, spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    token_files.write_token_files(docs, path, str(tmp_path / "t"), parts=4)
    got = token_files.id_checksums(token_files.read_token_files(spark, str(tmp_path / "t"))).collect()
    start, want = 0, []
    for r in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(lib.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert ordered(map(tuple, got)) == ordered(want)
    one = pq.ParquetFile(next((tmp_path / "t").glob("part-*.parquet"))).metadata.row_group(0).column(4)
    assert any("DICTIONARY" in e or "DELTA" in e for e in one.encodings) and one.has_column_index and one.has_offset_index
    light = token_files.read_token_files(spark, str(tmp_path / "t")).select("doc_id", "n_tokens")
    assert "ids" not in light._jdf.queryExecution().executedPlan().toString().split("ReadSchema:")[-1].split(">")[0]
    r = want[len(want) // 2]
    one = token_files.read_token_files(spark, str(tmp_path / "t")).filter(F.col("doc_id") == r[0])
    assert f"EqualTo(doc_id,{r[0]})" in one._jdf.queryExecution().executedPlan().toString().replace(" ", "") and r[2] in {x.n_tokens for x in one.collect()}
    token_files.write_token_files(empty, path, str(tmp_path / "e"), parts=2)
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_library_cuts():
    """Cuts that the model alone encodes give what the library gives for them, and so do all others."""
    cuts = token_files.LibraryCuts(public_tokenizers.path("word_bpe_49k.json"))
    alphabet = [chr(i) for i in range(33, 127)] + list("àÿ÷×éßµªʼ\u0301\x01ΣİǅЖ中") + ["<|endoftext|>", "'re", "<|"]
    rng = np.random.default_rng(7)
    new = {"".join(rng.choice(alphabet, n)) for n in rng.integers(1, 7, 3000)}
    new = sorted(new)
    got = cuts.learn([x.encode() for x in new])
    assert [x for x, ids in zip(new, got) if ids != np.asarray(cuts.lib.encode(x, add_special_tokens=False).ids, "<u4").tobytes()] == []


def test_mixing(docs, empty, spark):
    got = mixing.mix(docs, repetition=2.0, block_tokens=500).collect()
    n = {}
    for r in ROWS:
        n[r[3]] = n.get(r[3], 0) + len(words(r[1]))
    total = sum(n.values())

    def most(t):
        z = sum((v / total) ** t for v in n.values())
        return max((v / total) ** t / z * total / v for v in n.values())

    lo, hi = 0.0, 1.0
    if most(0.0) > 2.0:
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if most(mid) <= 2.0 else (mid, hi)
    else:
        hi = 0.0
    z = sum((v / total) ** hi for v in n.values())
    for source in n:
        weight = (n[source] / total) ** hi / z
        own = [r for r in got if r.source == source]
        taken = sum(r.n_tokens * r.copies for r in own)
        assert abs(own[0].weight - weight) < 1e-6
        together = Counter()  # repeated rows tie in the permutation and go together
        for r in own:
            together[r.doc_id] += r.n_tokens
        assert abs(taken - weight * total) <= max(together.values()) + 1
        assert {r.copies for r in own if r.n_tokens} <= {int(weight * total / n[source]), int(weight * total / n[source]) + 1}
    assert len(got) == len(ROWS) and ordered(r.doc_id for r in got) == ordered(r[0] for r in ROWS)
    sources = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 100)], "source string, tokens long")
    t = mixing.solve_exponent(sources, 1110, entropy=0.9)
    w = np.array([1000, 10, 100]) ** t
    w /= w.sum()
    assert abs(-(w * np.log(w)).sum() / np.log(3) - 0.9) < 1e-6
    assert mixing.mix(empty).count() == 0


def test_language(docs, empty, spark):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.predict(real, langid.fit(real, per_lang=60)).join(real.select("doc_id", "lang"), "doc_id").filter(langid.held_out()).collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.97
    assert sum(r.rejected for r in got) / len(got) < 0.02
    rows = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert len(rows) == len({r[0] for r in ROWS})
    for r in ROWS:
        if r[0] is not None and not any(c.isalpha() for c in r[1] or ""):
            assert rows[r[0]].lang_pred == "und" and rows[r[0]].score == 0.0 and rows[r[0]].rejected
        elif r[0] is not None:
            assert rows[r[0]].lang_pred != "und" and 0 <= rows[r[0]].score <= 1
    assert langid.fit(empty) is None and langid.predict(empty, None).count() == 0
    for left_out in ("de", "fr"):  # a language that was not learned is rejected
        model = langid.fit(real.filter(F.col("lang") != left_out), per_lang=60)
        got = langid.predict(real, model).join(real.select("doc_id", "lang", "text"), "doc_id").filter("text is not null").groupBy((F.col("lang") == left_out).alias("new")).agg(F.avg(F.col("rejected").cast("int")).alias("out")).collect()
        shares = {r.new: r.out for r in got}
        assert shares[True] > 0.8 and shares[False] < 0.02, (left_out, shares)
    noise = spark.createDataFrame([(1, "zqxj kqvw " * 50)], "doc_id long, text string")
    assert langid.predict(noise, langid.fit(real, per_lang=60)).first().rejected


def test_language_is_that_of_the_nearest_centroid(docs, spark):
    """A plain loop over words and dictionaries, with the fitted centroids."""
    model = langid.fit(docs)
    size = len(model.idf)

    def plain(text):
        letters = "".join(c if ord(c) > 127 or "a" <= c <= "z" else " " for c in text.lower())
        raw = (" " + " ".join(x for x in letters.split(" ") if x) + " ").encode()
        c = Counter()
        for i in range(len(raw) - 1):
            c[(int.from_bytes(raw[i : i + 2]) * 2654435761 % 2**32) * size >> 32] += 1
            if i < len(raw) - 2:
                c[((int.from_bytes(raw[i : i + 3]) ^ 0x5BD1E995) * 2654435761 % 2**32) * size >> 32] += 1
        v = {k: (1 + math.log(n)) * model.idf[k] for k, n in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        cosines = [sum(x * float(model.centroids[k, j]) for k, x in v.items()) / norm for j in range(len(model.langs))]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        return model.langs[best], cosines[best], cosines[best] < model.reject[best]

    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    checked = 0
    for doc, text, *_ in ROWS[::3]:
        if doc is not None and any(c.isalpha() for c in text or "") and len(text) < 3000:
            lang, score, rejected = plain(text)
            assert (got[doc].lang_pred, got[doc].rejected) == (lang, rejected) and got[doc].score == pytest.approx(score, abs=1e-5)
            checked += 1
    assert checked > 40


def test_media(docs, empty):
    seen = {r.doc_id: r for r in media.inspect(media.store(docs), with_payload=True).collect()}
    for r in ROWS:
        data = (r[1] or "").encode()
        padded = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        if r[0] is None:
            continue
        got = seen[r[0]]
        assert (got.n_bytes, got.payload_bytes, got.payload_sha256) == (len(data), len(padded), hashlib.sha256(padded).hexdigest())
        assert got.tail_crc32 == zlib.crc32(padded[-64:]) and got.error is None and got.codec == "raw "
        assert got.duration_ms == len(padded) // 8 and got.n_samples == len(padded) // 64
        stored = media.wrap(padded)
        assert (got.media_bytes, got.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        for k, span in enumerate(got.key_ranges.split(",")):
            a, b = map(int, span.split("-"))
            assert stored[a:b] == padded[1024 * k : 1024 * k + 64]
    broken = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.encode(F.lit("not a container"), "utf-8")).alias("media"), F.lit("mine").alias("codec"))
    assert all(r.codec is None and r.error for r in media.inspect(broken).collect())
    assert media.inspect(media.store(empty)).count() == 0


def naive_spans(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def resized(data: bytes, kind: bytes, new: bytes) -> bytes:
    """A container with the box of the sample table replaced; sizes and chunk offsets follow."""
    at = data.index(kind) - 4
    old = int.from_bytes(data[at : at + 4])
    out = bytearray(data[:at] + new + data[at + old :])
    grown = len(new) - old
    for name in (b"moov", b"trak", b"mdia", b"minf", b"stbl"):
        k = out.index(name) - 4
        out[k : k + 4] = (int.from_bytes(out[k : k + 4]) + grown).to_bytes(4)
    k = out.index(b"stco") + 4
    for c in range(int.from_bytes(out[k + 4 : k + 8])):
        j = k + 8 + 4 * c
        out[j : j + 4] = (int.from_bytes(out[j : j + 4]) + grown).to_bytes(4)
    return bytes(out)


def test_media_compact_sizes_and_fragments():
    own = bytes(range(256)) * 9
    plain = media.wrap(own)
    n = len(own) // 64
    want = media.described(plain)
    for bits, table in ((8, bytes([64] * n)), (16, b"\0\x40" * n)):
        packed = resized(plain, b"stsz", media.full(b"stz2", bytes(3) + bytes([bits]), n.to_bytes(4), table))
        got = media.described(packed)
        assert got["error"] is None and got["n_samples"] == n and media.payload(packed, got["track"]) == own
    quarter = resized(plain, b"stsz", media.full(b"stz2", bytes(3) + b"\x04", n.to_bytes(4), b"\x55" * (n // 2)))
    assert media.described(quarter)["track"]["sizes"].tolist() == [5] * n and want["n_samples"] == n
    # two fragments of 3 and 2 samples behind an empty sample table; the second run of the first follows the first run
    head = media.wrap(bytes(64))
    empty = head
    for kind in (b"stsz", b"stco", b"stsc", b"stts", b"stss"):
        empty = resized(empty, kind, media.full(kind, bytes(8 if kind == b"stsz" else 4)))
    empty = empty[: empty.index(b"mdat") - 4]
    trex = media.box(b"mvex", media.full(b"trex", *(x.to_bytes(4) for x in (1, 1, 100, 7, 0x10000))))
    k = empty.index(b"moov") - 4
    empty = bytearray(empty)
    empty[k : k + 4] = (int.from_bytes(empty[k : k + 4]) + len(trex)).to_bytes(4)
    movie = bytes(empty) + trex

    def fragment(sizes, offset):
        one = media.full(b"trun", len(sizes).to_bytes(4), offset.to_bytes(4), (0).to_bytes(4), *(x.to_bytes(4) for x in sizes), flags=0x205)
        two = media.full(b"trun", (1).to_bytes(4))
        return media.box(b"moof", media.full(b"mfhd", (1).to_bytes(4)), media.box(b"traf", media.full(b"tfhd", (1).to_bytes(4), flags=0x20000), one, two))

    data = b""
    parts = (([5, 6], b"abcdeABCDEF-------"), ([9], b"123456789!!!!!!!"))
    for sizes, body in parts:
        size = len(fragment(sizes, 0))
        data += fragment(sizes, size + 8) + media.box(b"mdat", body)
    got = media.described(movie + data)
    assert got["error"] is None and got["track"]["sizes"].tolist() == [5, 6, 7, 9, 7] and got["track"]["keys"].tolist() == [0, 3]
    assert media.payload(movie + data, got["track"]) == b"".join(b for _, b in parts) and got["duration_ms"] == 1000 * 500 // 8000


def test_media_broken_containers_give_an_error():
    own = media.wrap(bytes(range(256)) * 9)
    full = media.full
    deep = b""
    for _ in range(1200):
        deep = media.box(b"moov", deep)
    most = (2**32 - 1).to_bytes(4)
    cases = [deep, resized(own, b"stsz", full(b"free", bytes(4))), resized(own, b"stsz", full(b"stsz", (64).to_bytes(4), most)), resized(own, b"stsz", full(b"stsz", (0).to_bytes(4), most))]
    cases += [resized(own, b"stss", full(b"stss", (1).to_bytes(4), (0).to_bytes(4))), resized(own, b"stsz", full(b"stsz", (1).to_bytes(4), (60).to_bytes(4)))]
    cases += [resized(own, b"stsc", full(b"stsc", (1).to_bytes(4), (2).to_bytes(4), most, (1).to_bytes(4)))]
    got = [media.described(x) for x in cases]
    assert all(g["error"] and g["n_samples"] == 0 for g in got)
    assert media.described(resized(own, b"stsc", full(b"stsc", (1).to_bytes(4), (1).to_bytes(4), most, (1).to_bytes(4))))["n_samples"] == 36
    rng = random.Random(6)
    for _ in range(2000):
        data = bytearray(own)
        for _ in range(rng.randrange(1, 6)):
            at = rng.randrange(len(data) if rng.random() < 0.1 else 620)
            data[at] = rng.choice((0, 1, 255, rng.randrange(256)))
        data = bytes(data[: rng.randrange(len(data))] if rng.random() < 0.2 else data)
        got = media.described(data)
        assert len(media.payload(data, got["track"])) <= len(data) * max(1, got["n_samples"])


def test_media_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a", bytearray(media.wrap(bytes(64))), "x", "y", 2)], "doc_id long, media_value string, media binary, `media_` string, `a.b` string, codec int")
    (row,) = media.inspect(df).collect()
    assert row.media_value == "a" and row.media_ == "x" and row["a.b"] == "y" and row.codec == "raw "
    texts = spark.createDataFrame([("x", 1, "write to jo@ex.org in english please", "en", 2)], "`a.b` string, doc_id long, text string, lang string, c0 int")
    (row,) = pii.mask_column(texts).collect()
    assert row["a.b"] == "x" and row.text == "write to [EMAIL] in english please" and row.c0 == 2
    (row,) = langid.keep_accepted(texts, langid.fit(texts.withColumn("doc_id", F.lit(1)))).collect()
    assert row["a.b"] == "x" and row.lang == "en"


def test_pii(docs, empty):
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice("ab1239.@+- ()%_é") for _ in range(rng.randrange(1, 60)))
        assert pii.plain_spans(text) == naive_spans(text), text
    for r in pii.find_pii(docs).collect():
        if r.doc_id is not None:
            text = next(x[1] for x in ROWS if x[0] == r.doc_id) or ""
            assert [tuple(s) for s in r.base] == naive_spans(text)
            assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))
    assert pii.find_pii(empty, mask=True).count() == 0


@pytest.mark.parametrize(
    "text, span",
    [
        ("write to jo.doe [at] example (dot) org today", "email:9:38"),
        ("write to jo at example dot org today", "email:9:30"),
        ("write to jо@exаmple.org", "email:9:23"),
        ("call +one five five five one two three four five six seven now", None),
        ("card four one one one 1111 1111 one one one one.", None),
        ("ip １０.1.2.3!", "ip:3:11"),
        ("meet me at the dot of noon", ""),
        ("one two three go", ""),
        ("jane at example.com", "email:0:19"),
        ("please write to jane at example.com soon", "email:16:35"),
        ("look at example.com", ""),
        ("jo@example[.]com", "email:0:16"),
        ("192[.]168[.]1[.]1", "ip:0:17"),
        ("192 dot 168 dot 1 dot 1", "ip:0:23"),
        ("ten dot zero dot zero dot one", "ip:0:29"),
        ("one hundred and ninety two dot one six eight dot one dot one", "ip:0:60"),
        ("plus four nine one seven zero one two three four five six seven", "phone:0:63"),
        ("john dot smith at example dot com", "email:0:33"),
        ("jane at example dot museum", "email:0:26"),
        ("jane arroba ejemplo punto es", "email:0:28"),
        ("jean point dupont arobase exemple point fr", "email:0:42"),
        ("jo at beispiel punkt de", "email:0:23"),
        ("ruf plus vier neun eins sieben null eins zwei drei vier fünf an", "phone:4:60"),
        ("tarjeta " + "cuatro" + " uno" * 15, "card:8:74"),
        ("look at that point of view", ""),
        ("arrive at gate point zero", ""),
        ("two plus 2 makes four", ""),
        ("un deux trois", ""),
    ],
)
def test_pii_disguises(text, span):
    spans = ",".join(f"{k}:{a}:{b}" for k, a, b in pii.all_spans(text)[1])
    assert spans == span if span is not None else spans != ""


def test_pii_disguises_next_to_base_matches():
    """A disguise anywhere in an address, also where the rest of it reads as a shorter address."""
    address, twins = "john.smith@mail.example.com", {v: k for k, v in pii.LOOK_ALIKES.items()}
    whole = [("j", "\u200bj"), *[(c, twins[c]) for c in "johnismealxcp" if c in twins]]
    texts = [f"to {address[:k]}{new}{address[k + 1 :]}, now" for old, new in whole for k, c in enumerate(address) if c == old]
    for k, c in enumerate(address):
        if c in ".@":
            texts += [f"to {address[:k]}{a}{'dot' if c == '.' else 'at'}{b}{address[k + 1 :]}, now" for a, b in ("[]", ("(", ")"), (" [ ", " ] "))]
    assert len(texts) > 25
    for text in texts:
        base, spans = pii.all_spans(text)
        assert set(base) <= set(spans) and len(spans) == len(set(spans))
        start = 4 if "\u200b" in text else 3
        assert ("email", start, len(text) - 5) in spans, text
        assert pii.masked(text, spans) == text[:start] + "[EMAIL], now"
    assert pii.all_spans("to john@example.com, jоe")[1] == [("email", 3, 19)]


@pytest.mark.parametrize(
    "text, found",
    [
        ("to jo.doe at example.com, now", "email:jo.doe at example.com"),
        ("to jo at gmail.com, now", "email:jo at gmail.com"),
        ("to jo at example dot dev, now", "email:jo at example dot dev"),
        ("to jo at example dot ai now", "email:jo at example dot ai"),
        ("to jo at example dot mx.", "email:jo at example dot mx"),
        ("to jo at mail.example dot com", "email:jo at mail.example dot com"),
        ("to jo at example dot co dot za, now", "email:jo at example dot co dot za"),
        ("to jo dot doe at example dot com", "email:jo dot doe at example dot com"),
        ("to jo dot doe@example dot museum", "email:jo dot doe@example dot museum"),
        ("call +1 five five 5 1 two three 4 5 6 7 now", "phone:+1 five five 5 1 two three 4 5 6 7"),
        ("call +one (555) one two 3-4567", "phone:+one (555) one two 3-4567"),
        ("card 4111 1111 1111 111 one", "card:4111 1111 1111 111 one"),
        ("at 10.0.0.seven!", "ip:10.0.0.seven"),
        ("look at example.com and at v1.2 of it", ""),
        ("look at the dot com boom, at each dot product, at polka dot dresses", ""),
        ("we met at 5.30 at St.Louis, one of 12 people at Foo.bar(), Bar.err at com.foo.Main(x)", ""),
        ("issues with mail at gmail.com or sign in at outlook.com/inbox", ""),
        ("in 2010 one of 5 two-room flats, 3 one-way streets", ""),
    ],
)
def test_pii_worded(text, found):
    base, spans = pii.all_spans(text)
    assert [f"{k}:{text[a:b]}" for k, a, b in spans if (k, a, b) not in base] == ([found] if found else []), spans
    assert set(base) <= set(spans)


def test_pii_worded_takes_linear_time():
    for piece in ("a dot ", "x at ", "x at dot ", "one 1 ", "five ", "a@b dot ", "x at a.b ", "1 (", "a.", "\u0430", "uno ", "one hundred ", "x arroba ", "punto ", "a punto b arroba ", "plus ", "plus one ", "[.]", "[ ", "   ", "1 dot ", "[ . ", "a(at)"):
        start = time.perf_counter()
        pii.all_spans(piece * 40_000)
        assert time.perf_counter() - start < 8, piece


def test_bpe(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    want = []
    for r in ROWS:
        ids = lib.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False)))
    got = bpe.decode_documents(bpe.encode_documents(docs, path), path)
    assert ordered((r.doc_id, bytes(r.ids), r.decoded) for r in got.collect()) == ordered(want)
    assert bpe.decode_documents(bpe.encode_documents(empty, path), path).count() == 0
    both = bpe.round_trip(docs, path).collect()
    assert ordered((r.doc_id, bytes(r.ids), r.decoded) for r in both) == ordered(want)
    readable = bpe.decode_documents(bpe.encode_documents(docs, path), path, readable=True)
    assert ordered((r.doc_id, r.readable) for r in both) == ordered((r.doc_id, r.decoded) for r in readable.collect())


def test_bpe_streams_in_constant_memory():
    table = bpe.merge_table(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(8)
    for size in (1, 5, 40, table.lookahead + 1, 3000):
        for _ in range(4):
            word = "".join(rng.choice("abcdehinorst") for _ in range(size))
            parts = table.symbols(word)
            assert list(table.stream(parts)) == table.merge(parts)
            ids, counts = bpe.lock_step(public_tokenizers.path("word_bpe_49k.json")).encode([word.encode()])
            assert [table.strings[i] for i in ids.tolist()] == table.merge(parts) and counts.tolist() == [len(ids)]
    fed, given = 0, 0

    def feed():
        nonlocal fed
        for _ in range(40_000):
            fed += 1
            yield rng.choice("abcdehinorst")

    for token in table.stream(feed()):
        given += len(token)
        assert fed - given <= 4 * table.lookahead
    text = "Größe naïve wörld"
    machine = bpe.TextDecoder(table)
    ids, _ = bpe.word_encoder(public_tokenizers.path("word_bpe_49k.json")).encode([text])
    assert "".join(machine.push(ids[i : i + 1]) for i in range(len(ids))) + machine.finish() == text.lower() + " "
    joined = bpe.JoinDecoder(table)
    assert bpe.decoded(joined, ids, block=2) == bpe.decoded(joined, ids)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_every_code_point_encodes_as_in_the_library(name):
    """Between a letter and a sign, so that letters, numbers, signs and white space are told apart."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    lib, own = Tokenizer.from_file(path), [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(own), 90_000):
        part = ["".join(f"a{c}!1" for c in own[i : min(i + 30, at + 90_000)]) for i in range(at, min(at + 90_000, len(own)), 30)]
        want = [x.ids for x in lib.encode_batch_fast(part, add_special_tokens=False)]
        if name.startswith("byte"):
            assert token_count.token_counter(path).counts(part).tolist() == list(map(len, want))
        else:
            ids, ends = bpe.word_encoder(path).encode(part)
            assert ids.tolist() == [i for x in want for i in x] and ends.tolist() == np.cumsum(list(map(len, want))).tolist()


def test_random_texts_encode_as_in_the_library():
    """Signs, control characters, white space of all kinds and letters around lone and clustered full stops."""
    from tokenizers import Tokenizer

    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(5)
    pool = [*range(0x180)] + [32, 44, 46, 10] * 40 + [*range(0x300, 0x340), *range(0x3A0, 0x3D0)] + [0x1C, 0x85, 0xA0, 0x2028, 0x3000, 0xD55C]
    made = ["".join(chr(rng.choice(pool)) for _ in range(rng.randrange(60))) for _ in range(20_000)] + ["<|endoftext|>x<|startoftext|> <|end", " 's 'T 'RE it's", ". , .,", "a.\nb", ""]
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch_fast(made, add_special_tokens=False)]
    for encoder in (bpe.word_encoder(path), token_files.library_cuts(path)):
        ids, ends = encoder.encode(made)
        assert ids.tolist() == [i for x in want for i in x] and ends.tolist() == np.cumsum(list(map(len, want))).tolist()


def test_lock_step_gives_what_one_at_a_time_gives():
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path, rng = public_tokenizers.path(name), random.Random(4)
        machine, table = bpe.lock_step(path), bpe.merge_table(path)
        made = ["".join(rng.choice("aehinorstßé 中1!") for _ in range(rng.choice((0, 1, 2, 7, 30, 200)))) for _ in range(300)]
        ids, counts = machine.encode([x.encode() for x in made])
        assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [table.ids(x) for x in made]
        assert machine.encode([])[0].tolist() == []


def test_pipeline(docs, empty, spark, tmp_path):
    import corpus_pipeline as cp

    source = spark.createDataFrame(ROWS, SCHEMA).unionByName(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("doc_id", F.col("doc_id") + 5000), allowMissingColumns=True)
    for df, name in ((source, "full"), (empty, "none")):
        df.write.parquet(str(tmp_path / name / "documents.parquet"))
    assert cp.run(spark, str(tmp_path / "none")).count() == 0
    steps, now = [], source
    for name, stage in cp.STAGES:
        now = stage(spark, now, str(tmp_path / "full"))
        if name != cp.STAGES[-1][0]:
            assert now.columns == cp.COLUMNS
        now = spark.createDataFrame(now.collect(), now.schema)
        steps.append(now)
    first, unique, clean, mixed, ids = [s.collect() for s in steps]
    assert 0.9 * source.filter("text is not null").count() < len(first)
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(steps[0], most=cp.NEAR_BITS, size=cp.NEAR_WORDS).collect()}
    assert sorted(r.doc_id for r in unique if r.doc_id is not None) == sorted({d for d, c in groups.items() if d is not None and d == c})
    texts = {r.doc_id: r.text for r in unique}
    assert all(r.text == pii.masked(texts[r.doc_id], pii.all_spans(texts[r.doc_id])[1]) for r in clean if r.doc_id is not None)
    copies = {r.doc_id: r.copies for r in mixing.mix(steps[2].filter("doc_id is not null")).collect()}
    assert Counter(r.doc_id for r in mixed if r.doc_id is not None) == Counter({d: c for d, c in copies.items() if c})
    assert ordered((r.doc_id, r.n_tokens) for r in ids) == ordered((r.doc_id, len(bpe.word_encoder(cp.WORD_BPE).encode([r.text or ""])[0])) for r in mixed)


def test_every_query_gives_its_contract(spark):
    """The queries' own columns over a whole small table, from the texts by plain means."""
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    out = {n: {r.doc_id: r for r in f(spark, sf).collect()} for n, f in queries.QUERIES.items() if n[:5] in ("op3_t", "op4_s", "op5_t", "op7_l", "op8_m", "op9_p", "op10_")}
    assert all(rows.keys() == docs.keys() for rows in out.values())
    sha = lambda x: hashlib.sha256(x).hexdigest()
    word, byte = (Tokenizer.from_file(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    starts, start = {}, 0
    first: dict[bytes, int] = {}
    for d in sorted(docs):
        raw = docs[d].encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i : i + 50], d)
    for d in sorted(docs):
        text, raw = docs[d], docs[d].encode()
        ids = word.encode(text, add_special_tokens=False).ids
        r = out["op3_token_counts"][d]
        n = len(byte.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(raw), n, n > 512)
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < d:
                gone[i : i + 50] = True
        r = out["op4_suffix_dedup"][d]
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(raw), int(gone.sum()), spans, sha(np.frombuffer(raw, np.uint8)[~gone].tobytes()))
        with_end = np.array(ids + [2], "<u4")
        r = out["op5_token_files"][d]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(with_end), zlib.crc32(with_end.tobytes()))
        start += len(with_end)
        r = out["op7_language_id"][d]
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1
        padded = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        r = out["op8_media_columns"][d]
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_sha256) == (len(padded), sha(padded), zlib.crc32(padded[-64:]), sha(media.wrap(padded))) and r.feature.startswith("raw |")
        r = out["op9_pii"][d]
        base = naive_spans(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()) and r.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in pii.all_spans(text)[1])
        r = out["op10_bpe_round_trip"][d]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(word.decode(ids, skip_special_tokens=False).encode()))


def test_rows_of_one_id_with_other_texts_stay(spark):
    import corpus_pipeline as cp

    talk = lambda what: " ".join(f"{what}{i} runs along the {what} number {i * 7}" for i in range(40))
    data = [(1, talk("river"), "en", "a", 1), (1, talk("mountain"), "en", "a", 1), (2, talk("river"), "en", "b", 1), (1, talk("river"), "en", "a", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    assert ordered(map(tuple, cp.drop_near_duplicates(spark, docs, "").collect())) == ordered([data[0], data[1], data[4]])


def test_very_long_texts_and_clashing_names(spark):
    """20 MB in one text, and columns with the names that the operators use inside."""
    long = ("the quick brown fox jumps over 13 lazy dogs, again and again; " * 340_000)[: 20 << 20]
    names = "rank ranker media_value doc pos node ids part row_key cut".split()
    docs = spark.createDataFrame([(1, long, *names), (2, "short text here", *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = {r.doc_id: r for r in bpe.round_trip(docs, path).collect()}
    unit, _ = bpe.word_encoder(path).encode(["the quick brown fox jumps over 13 lazy dogs, again and again; "])
    assert bytes(rows[1].ids).startswith(unit.tobytes() * 1000) and rows[1].readable.startswith("the quick brown fox")
    assert {r.doc_id: r.n_bytes for r in token_count.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()} == {1: 20 << 20, 2: 15}
    assert {r.doc_id: r.payload_bytes for r in media.inspect(media.store(docs), with_payload=True).collect()} == {1: 20 << 20, 2: 64}
    assert simhash.near_duplicates(docs).count() == pii.find_pii(docs).count() == 2
    assert {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(docs).select("doc_id", "n_removed").collect()} == {1: 0, 2: 0}


def test_queries_are_registered():
    assert {f"op{n}_" for n in range(1, 11)} == {q.split("_")[0] + "_" for q in queries.QUERIES if q != "pipeline"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    con.execute("create view documents as from '/root/testdata/sf0.001/documents.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert sorted(got.columns) == sorted(want.columns)
    assert ordered(map(tuple, got.select(*want.columns).collect())) == ordered(want.fetchall())
