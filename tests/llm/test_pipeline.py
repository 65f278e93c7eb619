"""The whole pipeline against a plain twin of all its stages."""

import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from test_dedup import plain_components, plain_fingerprint

import corpus_pipeline
from plantwise.llm import host_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LATIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def planted(docs, items, seed=11):
    """Rows beside ``docs``: exact copies, near copies, passages of 51 to 70
    words that documents share, some spaced otherwise, contaminated documents, a
    host of junk and clean documents."""
    r = random.Random(seed)
    own = lambda n, tag: [f"{tag}x{r.randrange(10 ** 6)}" for _ in range(n)]
    texts, kind = [], []

    def add(text, what, source="planted"):
        texts.append((10_000 + len(texts), text, "en", source, len(text)))
        kind.append(what)

    for k in range(3):
        text = " ".join(own(120, f"e{k}"))
        for _ in range(4):
            add(text, "copy")
        words = own(400, f"n{k}")
        add(" ".join(words), "near")
        words[200] = "other"
        add(" ".join(words).upper(), "near")
        passage = own(51 + 9 * k, "p")
        for gap in (" ", "\n", "  "):
            add(" ".join(own(70, "a")) + " " + gap.join(passage) + "\t" + " ".join(own(60, "b")), "passage")
        add(" ".join([*own(60, "c"), *re.findall(WORD, items[k])[:40], *own(20, "d")]), "contaminated")
        add(" ".join(own(90 + k, "f")), "clean")
        add(" \n" + "  ".join(own(5000 * (k == 0) + 80, "g")) + "\n", "clean")
        add("too short", "junk", "junk")
        add("same words here " * 40, "junk", "junk")
    add("", "junk", "junk")
    return docs + texts, dict(zip((t[0] for t in texts), kind))


def plain_rules(docs):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", docs)
    kept = {d for d, k in con.execute(f"SELECT doc_id, kept FROM ({host_rules.ORACLE})").fetchall() if k}
    return [d for d in docs if d[0] in kept]


def plain_near(docs):
    codes = np.array([plain_fingerprint(d[1]) for d in docs], np.uint64)
    least = {}
    for d, group in zip(docs, plain_components(codes, 4).tolist()):
        least[group] = min(d[0], least.get(group, d[0]))
    return [d for d in docs if d[0] in set(least.values())]


def plain_passages(docs, length=corpus_pipeline.PASSAGE_WORDS):
    places = [list(WORD.finditer(d[1])) for d in docs]
    words = [[m.group() for m in p] for p in places]
    seen = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for d, at, w in zip(docs, places, words):
        gone = {j for i in range(len(w) - length + 1) if seen[tuple(w[i:i + length])] > 1 for j in range(i, i + length)}
        ends = [m.start() for m in at[1:]] + [len(d[1])]   # a word goes with the white space after it
        text = d[1][:at[0].start()] if at else d[1]
        text += "".join(d[1][m.start():end] for j, (m, end) in enumerate(zip(at, ends)) if j not in gone)
        out.append((d[0], text))
    return out


def plain_clean(docs, items, width=13):
    lower = lambda t: LATIN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for words in map(lower, items):
        n = min(width, len(words))
        if n:
            windows.setdefault(n, set()).update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for d in docs:
        words = lower(d[1])
        hit = {j for n, known in windows.items() for i in range(len(words) - n + 1) if tuple(words[i:i + n]) in known for j in range(i, i + n)}
        if not hit or 20 * len(hit) < len(words):
            out.append(d)
    return out


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("corpus"))
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()]
    docs, kind = planted(docs, items)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(os.path.join(base, "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(os.path.join(base, "benchmark.parquet"))
    return base, docs, items, kind


def test_run_equals_plain_stages(spark, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    base, docs, items, kind = corpus
    rules = plain_rules(docs)
    alone = plain_near(rules)
    cut = plain_passages(alone)
    kept = plain_clean(cut, items)
    ids_of = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    want = []
    for d, text in kept:
        ids = ids_of.encode(text, add_special_tokens=False).ids + [1]
        want += [(d, p, a, len(ids[a:a + 4096]), zlib.crc32(np.array(ids[a:a + 4096], "<u4").tobytes())) for p, a in enumerate(range(0, len(ids), 4096))]
    rows = corpus_pipeline.run(spark, base).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)

    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 4096
    bins = []
    for n in sorted((r.length for r in rows), reverse=True):   # best fit, longest first
        room = [i for i, left in enumerate(bins) if left >= n]
        if room:
            bins[min(room, key=bins.__getitem__)] -= n
        else:
            bins.append(4096 - n)
    assert -(-sum(filled.values()) // 4096) <= len(filled) <= len(bins)

    by = lambda what: {d for d, k in kind.items() if k == what}
    out = {r.doc_id for r in rows}
    texts = dict(cut)
    assert len(out & by("copy")) == 3 and not out & by("junk") and not out & by("contaminated") and by("clean") <= out
    assert {d[0] for d in alone} & by("near") < by("near")
    whole = {d[0]: d[1] for d in docs}
    assert all("p" not in {w[0] for w in texts[d].split()} for d in by("passage") & out) and by("passage") <= out
    assert all(texts[d] == whole[d] for d in by("clean"))
