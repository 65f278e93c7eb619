"""Encoders, token files, counts and packing against the libraries."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plantwise.llm import encoding, packing, simple8b, token_files
from plantwise.llm.common import Stages
from plantwise.llm.encoding import Encoder, vocabulary
from plantwise.llm.token_counts import token_counts

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]
PARTS = ["a", "b", " ", "  ", "\n", "'s", "é", "́", "　", "<|endoftext|>", "<s>", "1", "23", "!", "\t", "▁", "中", "Σ", "\x1c", "\xa0", "X" * 210, " ", "İ", "\x00", "\x01"]


@pytest.mark.parametrize("name", FILES)
def test_encoder_equals_library(name):
    r = random.Random(1)
    texts = ["".join(r.choices(PARTS, k=r.randint(0, 14))) for _ in range(5000)] + ["word " * 3000, "x" * 5000]
    enc = Encoder(vocabulary(name))
    assert enc.unsafe is not None
    whole = [list(x) for x in enc.call(texts)]
    assert [x.tolist() for x in enc.encode(texts)] == whole
    assert enc.count(texts).tolist() == [len(x) for x in whole]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70000), st.integers(0, 2 ** 64 - 1)), max_size=900))
def test_simple8b_round_trip(values):
    v = np.array(values, np.uint64)
    words, first = simple8b.pack(v)
    assert (simple8b.unpack(words, len(v)) == v).all()
    for k in range(len(first) - 1):  # every block can be read alone
        n = min(simple8b.BLOCK, len(v) - k * simple8b.BLOCK)
        part = simple8b.unpack(words[int(first[k]):int(first[k + 1])], n)
        assert (part == v[k * simple8b.BLOCK:k * simple8b.BLOCK + n]).all()


def test_shard_detects_damage():
    data = token_files.dump_shard([1, None], [np.array([5, 6], np.uint32), np.zeros(0, np.uint32)])
    ids, null, size, all_ids = token_files.load_shard(data)
    assert ids.tolist() == [1, 0] and null.tolist() == [False, True] and size.tolist() == [2, 0] and all_ids.tolist() == [5, 6]
    with pytest.raises(ValueError):
        token_files.load_shard(data[:20] + b"\xff" + data[21:])


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, odd_docs, no_docs, tmpdir_path):
    enc = Encoder(vocabulary("byte_bpe_50k.json"))
    rows = sorted(((r.doc_id, r.text or "") for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0]))
    want = sorted((str(d), len(x) + 1, crc(list(x) + [2])) for (d, _), x in zip(rows, enc.call([t for _, t in rows])))
    got = token_files.token_files(odd_docs, folder=f"{tmpdir_path}/ids").collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == (np.cumsum([r.n_tokens for r in got]) - [r.n_tokens for r in got]).tolist()
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids) and got[0].doc_id is None
    assert token_files.token_files(no_docs).count() == 0


def test_repeated_rows_are_spread_over_ranges(spark, tmpdir_path):
    """Rows that no key tells apart, a third and more of all, don't make one task;
    starts run on over ranges of several shards each."""
    same = [(None, "the same text again and again")] * 400 + [(i, f"text {i}") for i in range(200)]
    df = spark.createDataFrame(same, "doc_id long, text string").repartition(5)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        shards = Stages(spark, "spread").write(token_files.write_token_files(df, f"{tmpdir_path}/spread", shard_ids=50), "manifest")
        rows = shards.collect()
        per_range = {}
        for r in rows:
            per_range[r.shard // 100_000] = per_range.get(r.shard // 100_000, 0) + r.n_docs
        assert sum(per_range.values()) == 600 and len(rows) > len(per_range) > 3 and max(per_range.values()) < 300
        got = sorted(token_files.read_token_files(spark, f"{tmpdir_path}/spread", shards).collect(), key=lambda r: r.start)
    finally:
        spark.conf.set(name, before)
    assert [r.start for r in got] == (np.cumsum([r.n_tokens for r in got]) - [r.n_tokens for r in got]).tolist()
    assert [r.doc_id for r in got] == [None] * 400 + list(range(200))


def test_manifest_has_few_files(spark, monkeypatch):
    """Encoding tasks make no file of the manifest each."""
    files = []

    class Seen(Stages):
        def write(self, df, name):
            out = super().write(df, name)
            files.extend(out.inputFiles())
            return out

    monkeypatch.setattr(token_files, "Stages", Seen)
    df = spark.range(300).selectExpr("id AS doc_id", "concat('text ', id) AS text").repartition(5)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        got = sorted(token_files.token_files(df).collect(), key=lambda r: r.start)
    finally:
        spark.conf.set(name, before)
    assert [r.doc_id for r in got] == list(range(300)) and 0 < len(files) <= 2


def test_token_counts(odd_docs, no_docs):
    enc = Encoder(vocabulary("piece_bpe_32k.model"))
    want = sorted((str(r.doc_id), len((r.text or "").encode()), len(enc.call([r.text or ""])[0])) for r in odd_docs.collect())
    got = token_counts(odd_docs, limit=100).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got) and token_counts(no_docs).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64])
def test_templates_hold_every_piece(size):
    rng = np.random.default_rng(size)
    hist = np.bincount(rng.integers(1, size + 1, 500), minlength=size + 1)
    got = np.zeros(size + 1, int)
    bins = 0
    for contents, number in packing.plan_templates(hist, size):
        assert number > 0 and sum(c * m for c, m in contents.items()) <= size
        bins += number
        for c, m in contents.items():
            got[c] += m * number
    need = -(-int((hist * np.arange(size + 1)).sum()) // size)
    assert (got == hist).all() and need <= bins <= 1.1 * need + 2


def test_packing(spark, odd_docs, no_docs):
    enc = Encoder(vocabulary("word_bpe_49k.json"))
    want = []
    for r in odd_docs.collect():
        ids = list(enc.call([r.text or ""])[0]) + [1]
        want += [(str(r.doc_id), p, a, len(ids[a:a + 512]), crc(ids[a:a + 512])) for p, a in enumerate(range(0, len(ids), 512))]
    packed = packing.pack(odd_docs, limit=512, with_ids=True)
    got = packed.collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    for s in {r.sequence_id for r in got}:
        at = 0
        for r in sorted((r for r in got if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 512
    seqs = {r.sequence_id: r.ids for r in packing.packed_sequences(packed).collect()}
    assert all(seqs[r.sequence_id][r.offset:r.offset + r.length] == r.ids for r in got)
    assert packing.pack(no_docs).count() == 0


def test_packing_leaves_a_small_memo_behind(spark):
    """The workers live on after packing, with few of the words they have seen."""
    docs = spark.range(400).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 1500), i -> concat('w', id * 1500 + i))) AS text").repartition(4)
    assert packing.pack(docs).agg(F.sum("length")).first()[0] > 400 * 1500

    def kept(batches):
        for batch in batches:
            have = [len(e.memo) + len(e.before) for e in encoding._KEPT.values()]
            yield pa.RecordBatch.from_arrays([pa.array([len(have)]), pa.array([sum(have)])], names=["encoders", "pieces"])

    found = spark.range(0, 400, 1, 8).mapInArrow(kept, "encoders long, pieces long").agg(F.max("encoders"), F.max("pieces")).first()
    assert found[0] == 1 and found[1] <= encoding.KEPT_PIECES


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("kept", [0, 700, 10**6])
def test_encoder_after_forgetting(name, kept, monkeypatch):
    monkeypatch.setattr(encoding, "MEMO_PIECES", 2000)
    monkeypatch.setattr(encoding, "KEPT_PIECES", kept)
    texts = [" ".join(f"word{k * j} Other{j}, x" for j in range(60)) for k in range(120)]
    enc = Encoder(vocabulary(name))
    for _ in range(3):
        assert [x.tolist() for k in range(0, 120, 20) for x in enc.encode(texts[k:k + 20])] == [list(x) for x in enc.call(texts)]
        enc.forget()
        assert len(enc.memo) <= kept and not enc.before
        assert len(enc.start) == len(enc.size) == len(enc.memo) and enc.used == len(enc.pool) == enc.size.sum()


def test_templates_fill_sequences():
    lengths = np.minimum(4096, 1 + np.random.default_rng(3).exponential(900, 20000).astype(int))
    hist = np.bincount(lengths, minlength=4097)
    got, bins = np.zeros(4097, np.int64), 0
    for contents, number in packing.plan_templates(hist, 4096):
        assert number > 0 and sum(c * m for c, m in contents.items()) <= 4096
        bins += number
        for c, m in contents.items():
            got[c] += m * number
    assert (got == hist).all() and bins == -(-int(lengths.sum()) // 4096)


@pytest.mark.parametrize("words, in_one", [(0, 4096), (1364, 3), (818, 5)])
def test_packing_equal_lengths(spark, words, in_one):
    docs = spark.range(4 * in_one + 1).selectExpr("id AS doc_id", f"repeat('a ', {words}) AS text")
    docs = docs.withColumn("text", F.expr("trim(text)"))
    got = packing.pack(docs).collect()
    assert {r.length for r in got} == {words + 1} and len(got) == 4 * in_one + 1
    assert len({r.sequence_id for r in got}) == 5


def test_packing_spreads_repeated_rows(spark, monkeypatch):
    """Rows that are alike in id and text are ranked in many groups."""
    docs = spark.range(4000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'same text' AS text")
    salted, groups = packing._salted, []

    def seen(pieces, salts):
        out = salted(pieces, salts)
        groups.extend(r["count"] for r in out.groupBy("_size", "_salt").count().collect())
        return out

    monkeypatch.setattr(packing, "RANK_GROUP", 100)
    monkeypatch.setattr(packing, "_salted", seen)
    got = packing.pack(docs).collect()
    assert sum(groups) == 4000 and max(groups) < 200
    assert len({(r.sequence_id, r.offset) for r in got}) == 4000
