"""Exact substring operators and SimHash against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from plantwise.llm import repeats, simhash, substring_dedup, suffix_dedup
from plantwise.llm.common import Stages


def brute(docs, length, words):
    texts = [(t or "").encode() for _, t in docs]
    texts = [t.split() if words else t for t in texts]
    key = (lambda x, i: tuple(x[i:i + length])) if words else (lambda x, i: x[i:i + length])
    seen = Counter(key(x, i) for x in texts for i in range(len(x) - length + 1))
    out = []
    for (d, _), x in zip(docs, texts):
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - length + 1):
            if seen[key(x, i)] > 1:
                gone[i:i + length] = True
        if words:
            kept = b" ".join(w for w, g in zip(x, gone) if not g)
            out.append((d, len(x), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
        else:
            kept = bytes(np.frombuffer(x, np.uint8)[~gone])
            runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
            out.append((d, len(x), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def mixed_docs(seed, n=40):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    pool = [[r.choice(vocab) for _ in range(r.randint(5, 200))] for _ in range(8)]
    docs = []
    for i in range(n):
        t = []
        for _ in range(r.randint(0, 4)):
            p = r.choice(pool)
            a = r.randint(0, len(p))
            q = list(p[a:a + r.randint(1, 120)])
            if q and r.random() < 0.6:
                q[r.randrange(len(q))] = r.choice(vocab)
            t += q + [r.choice(vocab) for _ in range(r.randint(0, 6))]
        docs.append((r.choice([i, i, None]), r.choice([" ", "  ", "\n"]).join(t)))
    docs += [(900, "a " * 400), (901, "a b " * 60), (902, None), (903, ""), docs[0], docs[0]]
    return docs


@pytest.mark.parametrize("length", [35, 8, 3])
def test_words_against_brute_force(spark, length):
    docs = mixed_docs(length)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted([tuple(r) for r in substring_dedup.substring_dedup(df, length).collect()], key=str)
    assert got == brute(docs, length, True) and sum(r[2] for r in got) > 0


@pytest.mark.parametrize("length", [400, 50, 9])
def test_bytes_against_brute_force(spark, length):
    docs = mixed_docs(length + 1)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted([tuple(r) for r in suffix_dedup.suffix_dedup(df, length).collect()], key=str)
    assert got == brute(docs, length, False) and sum(r[2] for r in got) > 0


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = sorted([tuple(r) for r in substring_dedup.substring_dedup(odd_docs).collect()], key=str)
    assert got == brute(rows, 35, True)
    got = sorted([tuple(r) for r in suffix_dedup.suffix_dedup(odd_docs).collect()], key=str)
    assert got == brute(rows, 400, False)
    assert substring_dedup.substring_dedup(no_docs).count() == 0
    assert suffix_dedup.suffix_dedup(no_docs).count() == 0


def test_kept_words_and_whole_characters(spark):
    text = "é" * 300
    df = spark.createDataFrame([(1, "x" + text, "a"), (2, "yz" + text, "b"), (3, None, "c")], "doc_id long, text string, other string")
    out = {r.doc_id: r for r in suffix_dedup.without_repeats(df, 400).collect()}
    assert (out[1].text, out[2].text, out[3].text) == ("x", "yz", None) and out[1].other == "a"
    kept = substring_dedup.substring_dedup(spark.createDataFrame([(1, "a b c d e"), (2, "x b c d y")], "doc_id long, text string"), 3, with_text=True)
    assert {r.doc_id: r.kept for r in kept.collect()} == {1: "a e", 2: "x y"}


def test_unit_limits():
    with pytest.raises(ValueError):
        repeats.Unit(True, 10, 4, 5)
    for words in (True, False):
        for n in range(2, 60):
            u = repeats.for_length(words, n)
            assert 2 * u.span + u.gram <= n + 1


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(codes, bits):
    label = np.arange(len(codes))
    a, b = np.nonzero(np.triu(np.bitwise_count(codes[:, None] ^ codes[None]) <= bits, 1))
    return simhash._roots(label, a, b)


def test_fingerprints_and_groups(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text")
    extra = [(100 + i, t) for i, t in enumerate(["A b c d e f g h i j k l m n o p"] * 2 + ["A b c d e f g h i j k l m n o Q", "zz top", "ZZ TOP", "İSTANBUL É"])]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = docs.collect()
    fp = [plain_fingerprint(r.text) for r in rows]
    label = plain_components(np.array(fp, np.uint64), 4)
    want = []
    for r, f, k in zip(rows, fp, label):
        ids = [x.doc_id for x, j in zip(rows, label) if j == k and x.doc_id is not None]
        want.append((r.doc_id, f"{f:016x}", min(ids) if ids else None))
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_groups(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert simhash.simhash_groups(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len(set(label[: odd_docs.count()].tolist()))


@pytest.mark.parametrize("n,bits", [(1, 60), (17, 6), (300, 8), (1500, 12), (800, 62)])
def test_gray_index(n, bits):
    codes = np.unique(np.random.default_rng(n).integers(0, 2 ** bits, n, dtype=np.uint64) * np.uint64(3))
    index = simhash.GrayIndex(codes)
    assert (index.components(4) == plain_components(index.codes, 4)).all()


def test_large_buckets_link_alike(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    codes = np.unique(np.concatenate([base, base ^ np.uint64(15), base[:9] ^ np.uint64(31), base[:5] ^ np.uint64(3 << 40)]))
    st = Stages(spark, "test-buckets")
    fps = st.write(spark.createDataFrame([(int(x),) for x in codes.view(np.int64)], "fp long"), "f")
    a = {r.node: r.root for r in simhash.fingerprint_components(fps, st).collect()}
    b = {r.node: r.root for r in simhash.fingerprint_components(fps, Stages(spark, "test-buckets"), bucket_size=1).collect()}
    assert a == b and a
