"""Rules, classifier, decontamination, archives, the pipeline and the SQL twins."""

import math
import hashlib
import os
import random
import sys

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from plantwise.llm import host_rules, queries, warc, winnowing
from plantwise.llm.common import Stages
from plantwise.llm.site_quality import combine, site_quality

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))
from oracle_check import rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_all_are_registered():
    names = set(E.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, duck, name):
    a = rows_of(queries.QUERIES[name](spark, SF).toPandas())
    b = rows_of(duck.execute(queries.ORACLE[name]).fetch_df())
    assert a == b


def sql_rows(sql, **frames):
    con = duckdb.connect()
    for name, table in frames.items():
        con.register(name, table)
    return rows_of(con.execute(sql).fetch_df())


def test_host_rules_odd_rows(odd_docs, no_docs):
    from pyspark.sql import functions as F

    out = host_rules.quality_rules(odd_docs).withColumn("host_rate", F.floor(F.col("host_rate") * 1e6 + 0.5) / 1e6)
    docs = odd_docs.select("doc_id", "text", "source").toArrow()
    assert rows_of(out.toPandas()) == sql_rows(host_rules.ORACLE, documents=docs)
    kept = host_rules.keep_by_rules(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == out.filter("kept").count()
    extra = [f"`{c}`" for c in odd_docs.columns[5:]]
    kept = host_rules.keep_by_rules(odd_docs, max_host_rate=2.0)
    assert len(extra) > 40 and kept.count() and kept.select(*extra).distinct().collect() == [("k",) * len(extra)]  # values of helpers' names stay
    assert host_rules.quality_rules(no_docs).count() == 0


def test_bad_hosts_fall_and_sparse_hosts_are_shrunk(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, good + f" {i}", "fine") for i in range(60)] + [(100 + i, "short", "junk") for i in range(59)] + [(200, good, "junk"), (300, "short", "rare"), (301, good, "rare")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in host_rules.quality_rules(df).collect()}
    assert kept[5] and not kept[100] and not kept[200] and kept[301]
    assert host_rules.beta_prior(0, 0, 0, 0) == (0.5, 0.5)


def test_contamination_odd_rows(spark, odd_docs, no_docs):
    items = [(1, " ".join(f"w{i}" for i in range(5, 25))), (2, "one"), (None, "x7 word8 x8"), (3, None), (4, ""), (2, "W0 w1"), (10, "one")]
    bench = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, _row int")
    out = winnowing.contamination(odd_docs, bench)
    want = sql_rows(winnowing.ORACLE, documents=odd_docs.select("doc_id", "text").toArrow(), benchmark=bench.select("item_id", "text").toArrow())
    got = rows_of(out.toPandas())
    assert [tuple(float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x for x in r) for r in got[1]] == \
        [tuple(float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x for x in r) for r in want[1]]
    assert winnowing.contamination(no_docs, bench).count() == 0
    assert winnowing.contamination(odd_docs, bench.limit(0)).filter("contaminated").count() == 0
    kept = winnowing.drop_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == out.filter("NOT contaminated").count()


def test_archives(spark, tmpdir_path):
    big, other = "é" * 600, "x" * 1000
    rows = [(1, "http://a", big), (2, None, big), (3, "http://c\r\nX-Page-Id: 9", big), (3, "http://c", big), (4, "u", None), (5, "u", ""), (None, "u", other), (6, "u", other), (7, "u", "x" * 999), (8, "u", "x" * 999)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    got = warc.warc_round_trip(pages, f"{tmpdir_path}/w")
    res = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in got.collect())
    assert res == sorted([("1", 1200, "revisit", 3), ("2", 1200, "revisit", 3), ("3", 1200, "response", None), ("3", 1200, "response", None),
                          ("4", 0, "response", None), ("5", 0, "response", None), ("None", 1000, "revisit", 6), ("6", 1000, "response", None),
                          ("7", 999, "response", None), ("8", 999, "response", None)])
    assert warc.warc_round_trip(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        list(warc.parse_records(b"not gzip"[:0] + __import__("gzip").compress(b"WARC/1.1\r\ncontent-length: 5\r\n\r\nabc\r\n\r\n")))


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = site_quality(docs, labels.filter("doc_id % 4 <> 0"))
    held = out.join(labels.filter("doc_id % 4 = 0"), "doc_id").toPandas()
    assert out.count() == docs.count()
    assert ((held.p_good >= 0.5) == (held.quality == 1)).mean() >= 0.9
    clean = held[(held.quality == 1) & (held.toxic == 0)]
    assert clean.kept.mean() >= 0.95


def test_classifier_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (6, 1, 0), (7, 1, 1), (None, 1, 0), (8, None, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    assert site_quality(odd_docs, labels).count() == odd_docs.count()
    bare = site_quality(odd_docs, labels.limit(0)).collect()
    assert len(bare) == odd_docs.count() and all(r.e_good == 0 for r in bare)
    assert site_quality(no_docs, labels).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        empty = stage(spark, docs.limit(0), SF)
        assert empty.columns == docs.columns and empty.count() == 0, name
    packed = corpus_pipeline.run(spark, SF)
    ids = {r.doc_id for r in packed.select("doc_id").collect()}
    rules = {r.doc_id for r in host_rules.quality_rules(docs).filter("kept").collect()}
    assert ids and ids <= rules


def test_pipeline_on_odd_rows(spark, odd_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd_docs, SF)
        assert out.columns == odd_docs.columns and out.count() <= odd_docs.count(), name


def passage_docs(seed=4):
    """Documents with planted passages of 36 to 60 short words that stand in two
    of them, some spaced otherwise, and documents without."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyzé", k=r.randint(1, 3)))
    docs, planted = [], []
    for k in range(12):
        passage = [word() for _ in range(r.choice([36, 51, 55, 60]))]
        for n in range(2):
            own = [[word() + str(k * 2 + n) for _ in range(r.randint(5, 90))] for _ in range(2)]
            gap = r.choice([" ", "  ", "\n", "\t "])
            docs.append((2 * k + n, " ".join(own[0]) + "\n" + gap.join(passage) + " " + "  ".join(own[1]) + r.choice(["", "\n"]), own[0] + own[1]))
            planted.append(passage)
    clean = [(100 + k, "  ".join(word() + f"c{k}" for _ in range(80))) for k in range(8)]
    return docs, clean


def test_repeated_passages_of_short_words_go(spark, no_docs):
    docs, clean = passage_docs()
    rows = [(d, t, "en", "s", len(t)) for d, t, _ in docs] + [(d, t, "en", "s", len(t)) for d, t in clean] + [(200, None, None, None, None), (201, "", "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = {r.doc_id: r for r in corpus_pipeline.repeated_passages(spark, df, SF).collect()}
    assert min(len(t.encode()) for _, t, _ in docs) < 400 and len(out) == len(rows)
    for d, text, own in docs:
        assert out[d].text.split() == own and out[d].n_chars == len(out[d].text)
        assert out[d].text.startswith(text[: text.index("\n") + 1])  # own spacing stays
    for d, text in clean:
        assert out[d].text == text
    assert out[200].text is None and out[201].text == ""
    assert corpus_pipeline.repeated_passages(spark, no_docs, SF).count() == 0


def test_archives_are_read_in_linear_time():
    """4 KB pages: eight times the archive takes about eight times as long."""
    import time
    import zlib

    def member(k):
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        text = hashlib.sha512(str(k).encode()).hexdigest() * 32
        return z.compress(warc.make_record(k, f"http://h/{k}", text.encode(), "0" * 40, None, "2020-01-01T00:00:00Z")) + z.flush()

    small = b"".join(member(k) for k in range(500))
    times = []
    for data, n in ((small, 500), (small * 8, 4000)):
        t = time.perf_counter()
        pages = [int(head["x-page-id"]) for head, _ in warc.parse_records(data)]
        times.append(time.perf_counter() - t)
        assert pages == [k % 500 for k in range(n)]
    assert times[1] < 30 * times[0]
    with pytest.raises(ValueError):
        list(warc.parse_records(small[:-3]))


def test_site_priors_against_brute_force(spark):
    """Given evidence, every document's prior is counted anew from all others:
    one-document sites, null hosts and paths, repeated rows and a hot host."""
    rng = np.random.default_rng(5)
    rows = [(i, *site, float(e), float(t)) for i, (site, e, t) in enumerate(zip(
        [("hot", "p%d" % (i % 3)) for i in range(60)] + [(None, None)] * 4 + [("hot", None)] * 3 + [("h%d" % i, "only") for i in range(12)] + [("h1", "more")] * 5,
        rng.normal(1, 2, 84), rng.normal(-2, 1.5, 84)))]
    rows += [rows[0], (None, "hot", "p0", 0.5, 0.5)]
    rates = [0.7, 0.1]
    scored = spark.createDataFrame(rows, "doc_id long, host string, path string, e_good double, e_toxic double").repartition(3)
    got = combine(scored, rates, Stages(spark, "test-combine")).collect()

    def odds(x):
        return 1 / (1 + math.exp(-x))

    def prior(groups):
        n = sum(map(len, groups))
        m = sum(map(sum, groups)) / n
        within = m * (1 - m)
        between = max(0.0, sum(sum(g) ** 2 / len(g) for g in groups) / n - m * m - within * (len(groups) - 1) / n)
        strength = min(1e4, max(1.0, within / between - 1)) if between > 0 else 1e4
        return strength * m, strength * (1 - m)

    want = {}
    for name, at, rate in (("good", 3, rates[0]), ("toxic", 4, rates[1])):
        own = [odds(r[at] + math.log(rate / (1 - rate))) for r in rows]
        hosts, paths = {}, {}
        for r, p in zip(rows, own):
            hosts.setdefault(r[1], []).append(p)
            paths.setdefault(r[1:3], []).append(p)
        (a, b), (c, d) = prior(list(hosts.values())), prior(list(paths.values()))
        for k, r in enumerate(rows):
            others = [(x, p) for j, (x, p) in enumerate(zip(rows, own)) if j != k]
            h = [p for x, p in others if x[1] == r[1]]
            q = [p for x, p in others if x[1:3] == r[1:3]]
            host = (sum(h) + a) / (len(h) + a + b)
            path = (sum(q) + (c + d) * host) / (len(q) + c + d)
            want.setdefault(k, {})[name] = odds(r[at] + math.log(path / (1 - path)))
    key = lambda d, e, g, t: (str(d), round(e, 9), round(g, 9), round(t, 9))
    assert sorted(key(r.doc_id, r.e_good, r.p_good, r.p_toxic) for r in got) == sorted(key(rows[k][0], rows[k][3], w["good"], w["toxic"]) for k, w in want.items())
