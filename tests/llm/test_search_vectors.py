"""Ranked search, embedding dedup and centroid clustering against brute force."""

import hashlib
import math
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from plantwise.llm import centroid_clustering as cc
from plantwise.llm import embedding_dedup as ed
from plantwise.llm import ranked_search as rs

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, top):
    """(item, rank, score) rows and, per item, the documents with a score."""
    terms = [plain_terms(t) for _, t in docs]
    n_docs, n_terms = sum(1 for t in terms if t), sum(map(len, terms))
    counts = [Counter(t) for t in terms]
    df = Counter(w for c in counts for w in c)
    out = []
    for item, text in items:
        scored = []
        for (d, _), ts, c in zip(docs, terms, counts):
            m = 75 + (25 * len(ts) * n_docs) // max(1, n_terms)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 12 * m)) for w in plain_terms(text) if c[w])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored)[:top])]
    return out


def some_docs(seed, n=300):
    r = random.Random(seed)
    vocab = [f"W{i}" for i in range(60)] + ["É", "日本語", "a-b", "x_y", "ñ1"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    docs = [(r.choice([i, i, i, None]), r.choice([" ", ".", "\n", "\t-"]).join(r.choices(vocab, weights, k=r.choice([0, 1, 5, 40, 300])))) for i in range(n)]
    docs += [(900, None), (901, ""), (902, "..."), (903, "long" * 40 + " w1"), (904, "w3 " * 400_000 + "tail")]
    return docs + [docs[3], docs[3], docs[7]]


@pytest.mark.parametrize("top,block", [(20, 1 << 16), (3, 12)])
def test_search_against_brute_force(spark, top, block):
    docs = some_docs(top)
    items = [(1, "w1 W2 w3 w4 w4 unseen"), (2, "w2 w3 w4 w50"), (3, "w1 w2 w3 w4"), (4, None), (5, "?!"), (6, "É 日本語 a-b x_y"), (6, "É 日本語 a-b x_y"),
             (None, "w60 w59 w3 w4 w1"), (8, "long" * 40), (9, "tail w58")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, _item string, score int").repartition(5)
    it = spark.createDataFrame([(*x, 3) for x in items], "item_id long, text string, doc_id int").repartition(3)
    got = [tuple(r) for r in rs.ranked_search(df, it, top, block_terms=block).collect()]
    want = plain_search(docs, items, top)
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 20


def test_search_on_empty_tables(spark, no_docs, odd_docs):
    it = spark.createDataFrame([(1, "w1 w2"), (2, None)], "item_id long, text string")
    assert rs.ranked_search(no_docs, it).count() == 0
    assert rs.ranked_search(odd_docs, it.limit(0)).count() == 0
    got = rs.ranked_search(odd_docs, it)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted([tuple(r) for r in got.collect()], key=str) == sorted(plain_search(rows, [(1, "w1 w2")], 20), key=str)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]


def test_shared_sets_are_mined_once():
    common = [(f"c{i}".encode(), 1) for i in range(10)]
    items = [(k, common + [(f"own{k}".encode(), 2), (b"half", 1 + k % 2)]) for k in range(6)]
    plan = rs.plan_block(items)
    assert len(set(plan.kind[[plan.vocab[t] for t, _ in common]])) == 1  # one class, one accumulator
    assert plan.nodes < sum(len(t) for _, t in items)
    flat = rs.plan_block([(k, [(f"t{j}".encode(), 1) for j in range(8) if j <= 3 or j == k]) for k in range(4, 8)])
    for k, (row, nodes) in enumerate(flat.items):
        atoms = []
        todo = list(nodes)
        while todo:
            v = todo.pop()
            todo += list(flat.pairs[v - len(flat.atoms)]) if v >= len(flat.atoms) else []
            atoms += [flat.atoms[v]] if v < len(flat.atoms) else []
        assert len(atoms) == len(set(atoms)) == 2  # the shared class and its own


# ------------------------------------------------------------- embeddings

def plain_links(rows, threshold):
    """n_links, component ids of (id, vector, label) rows."""
    good = [lab is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    n, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                    n[i] += 1
                    n[j] += 1
                    parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        k = find(i)
        least[k] = min((x for x in (least.get(k), r[0]) if x is not None), default=None)
    return [(r[0], n[i], least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(rows)]


def near(rng, v, cosine):
    side = rng.standard_normal(len(v))
    side -= side @ v * v / (v @ v)
    return cosine * v / np.linalg.norm(v) + math.sqrt(1 - cosine**2) * side / np.linalg.norm(side)


def some_vectors(seed, n=240, dim=64, hot=80):
    rng = np.random.default_rng(seed)
    base = [rng.standard_normal(dim) for _ in range(n)]
    rows = [(v / np.linalg.norm(v), int(rng.integers(3))) for v in base]
    rows += [(near(rng, rows[i][0], c), rows[i][1]) for i in range(60) for c in (0.935, 0.97, 0.9)]
    rows += [(near(rng, rows[0][0], c) * 3, rows[0][1]) for c in rng.uniform(0.95, 0.9999, hot)]
    rows = [([float(np.float32(x)) for x in v], lab) for v, lab in rows]
    rows += [rows[0]] * 4 + [([x * 2 for x in rows[1][0]], rows[1][1])]
    odd = [(None, 0), ([], 0), ([0.0] * dim, 0), ([float("nan")] + [1.0] * (dim - 1), 0), ([float("inf")] + [1.0] * (dim - 1), 0), ([None] + [1.0] * (dim - 1), 0),
           (rows[0][0], None), ([1.0, 0.0], 0), ([2.0, 0.0], 0), ([-1.0, 0.0], 0)]
    rows += odd
    ids = [int(x) for x in rng.permutation(len(rows))]
    out = [(i, v, lab) for i, (v, lab) in zip(ids, rows)]
    return out + [(None, rows[2][0], rows[2][1]), (None, None, None), out[5], out[5]]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", 5, [1.0]) for r in rows], "vec_id long, embedding array<float>, label int, node string, cell int, vec array<float>").repartition(4)


@pytest.mark.parametrize("cell_rows,tile_rows", [(2048, 16384), (6, 16384), (100_000, 30)])
def test_embeddings_against_brute_force(spark, cell_rows, tile_rows):
    """One cell a label; a fine grid; every cell too large for one task."""
    rows = some_vectors(cell_rows)
    got = sorted([tuple(r) for r in ed.embedding_dedup(frame(spark, rows), cell_rows=cell_rows, tile_rows=tile_rows, chunk=16).collect()], key=str)
    want = sorted(plain_links(rows, 0.93), key=str)
    if cell_rows != 6:
        assert got == want
    assert [r[0] for r in got] == [r[0] for r in want]
    total, seen = sum(r[1] for r in want), sum(r[1] for r in got)
    assert 0.9 * total <= seen <= total
    unlinked = [r for r in want if r[1] == 0]
    assert set(unlinked) <= set(got)


@pytest.mark.parametrize("block_bytes,tile_rows", [(1 << 14, 16384), (1 << 12, 5)])
def test_embeddings_in_many_files(spark, monkeypatch, block_bytes, tile_rows):
    """Labels and cells over several files, members around leaders, few visits
    held at a time: the links of one file."""
    monkeypatch.setattr(ed, "VISITS", 500)
    for cell_rows in (100_000, 20):
        rows = some_vectors(block_bytes, hot=150)
        df = frame(spark, rows)
        got, whole = (sorted([tuple(r) for r in ed.embedding_dedup(df, cell_rows=cell_rows, **x).collect()], key=str) for x in (dict(block_bytes=block_bytes, tile_rows=tile_rows, chunk=16), {}))
        assert got == whole
        if cell_rows == 100_000:
            assert got == sorted(plain_links(rows, 0.93), key=str)


def test_embeddings_on_disk(spark, monkeypatch):
    """What a run writes and shuffles at a time stays in proportion to its
    vectors, however many cells each of them visits."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((6000, 64)).astype(np.float32)
    x[:500] = x[0] + 0.02 * rng.standard_normal((500, 64))
    df = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>, label int")
    written, write = {}, ed.Stages.write

    def watched(self, table, name):
        out = write(self, table, name)
        path = self.path(name).removeprefix("file:")
        written[name] = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs)
        return out

    monkeypatch.setattr(ed.Stages, "write", watched)
    got = {r.vec_id: r for r in ed.embedding_dedup(df, cell_rows=16, tile_rows=512).collect()}
    assert got[0].n_links >= 245 and got[0].component_id == 0 and not got[2].kept
    assert sum(written.values()) < 2.5 * x.nbytes, written


def test_embeddings_of_many_labels(spark):
    """Labels of one to three vectors, and one over several files."""
    rng = np.random.default_rng(11)
    rows = [(i, v, int(rng.integers(150)) if i < 200 else 77) for i, v in enumerate(rng.standard_normal((400, 8)).tolist())]
    rows += [(1000 + k, near(rng, np.array(v), 0.99).tolist(), lab) for k, (_, v, lab) in enumerate(rows[::2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long").repartition(3)
    got = sorted(tuple(r) for r in ed.embedding_dedup(df, block_bytes=1 << 12).collect())
    assert got == sorted(plain_links(rows, 0.93)) and sum(r[1] for r in got) >= 400


def test_index_recall(spark):
    """Pairs just above the threshold, on a grid of 400 cells."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.stack([near(rng, v, c) for v, c in zip(x, rng.uniform(0.931, 0.99, len(x)))])
    index = ed.MultiIndex(x[:2000], 20, 0.93)
    met = {}
    for name, side in (("x", x), ("y", y)):
        row, cell, home = index.visits(side)
        met[name] = [set() for _ in side]
        for r, c in zip(row.tolist(), cell.tolist()):
            met[name][r].add(c)
        met[name + "home"] = cell[home][np.argsort(row[home])]
    ok = [max(a, b) in p and max(a, b) in q for a, b, p, q in zip(met["xhome"].tolist(), met["yhome"].tolist(), met["x"], met["y"])]
    assert sum(ok) / len(ok) >= 0.99
    assert np.mean([len(p) for p in met["x"]]) < 300  # fewer than all cells


def test_embeddings_of_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert ed.embedding_dedup(none).count() == 0
    bad = spark.createDataFrame([(1, None, 1), (2, [0.0], None)], "vec_id long, embedding array<float>, label int")
    assert sorted(tuple(r) for r in ed.embedding_dedup(bad).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


# ------------------------------------------------------------- clustering

def plain_clusters(rows, k, rounds, dims, seed=3):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((x for x in kept if x[0] is not None), key=lambda x: (hashlib.sha256(f"{seed}:{x[0]}".encode()).hexdigest(), x[1]))
    cen = [list(x[1]) for x in order[:k]] or [list(x) for x in sorted(x[1] for x in kept)[:1]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cen)) for _, x in kept]

    for _ in range(rounds):
        at = assign()
        for j in range(len(cen)):
            own = [x for (_, x), (_, c) in zip(kept, at) if c == j]
            if own:
                cen[j] = [sum(col) // len(own) for col in zip(*own)]
    at = assign()
    per = Counter()
    for d, c in at:
        per[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cen]
    return [(i, c, d, per[c], sum(per.values()), sha[c]) for (i, _), (d, c) in zip(kept, at)]


@pytest.mark.parametrize("n,k,rounds,dims", [(200, 8, 10, 64), (40, 5, 3, 3), (3, 8, 10, 4)])
def test_clusters_against_brute_force(spark, n, k, rounds, dims):
    rng = np.random.default_rng(n)
    rows = [(int(i), [float(np.float32(x)) for x in rng.standard_normal(dims) * (1000 if i % 9 == 0 else 0.2)]) for i in rng.permutation(n)]
    rows += [(900, None), (901, [1.0] * (dims + 1)), (902, [None] * dims), (903, [float("nan")] * dims), (904, [float("inf")] * dims), (905, [])]
    rows += [rows[0], rows[0], (None, rows[1][1])]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<float>, cluster int, ints string").repartition(3)
    got = [tuple(r) for r in cc.centroid_clustering(df, k, rounds, dims).collect()]
    assert sorted(got, key=str) == sorted(plain_clusters(rows, k, rounds, dims), key=str)


def test_clusters_at_the_edges(spark):
    form = "vec_id long, embedding array<double>"
    assert cc.centroid_clustering(spark.createDataFrame([], form)).count() == 0
    rows = [(None, [0.5, 1.0]), (None, [2.0, 3.0])]
    got = [tuple(r) for r in cc.centroid_clustering(spark.createDataFrame(rows, form), dims=2).collect()]
    assert sorted(got, key=str) == sorted(plain_clusters(rows, 8, 10, 2), key=str)
    with pytest.raises(ArithmeticError):
        cc.centroid_clustering(spark.createDataFrame([(1, [1e30, 0.0])], form), dims=2)


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_embedding_dedup", "op13_centroid_clustering"])
def test_queries_match_sql(spark, name):
    from plantwise.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    a = queries.QUERIES[name](spark, sf).toPandas()
    b = con.execute(queries.ORACLE[name]).fetch_df()[list(a.columns)]
    key = list(a.columns)
    assert a.sort_values(key).astype(str).values.tolist() == b.sort_values(key).astype(str).values.tolist()
