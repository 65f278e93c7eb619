"""Benchmark decontamination (operator 8) by winnowing.

The least k-gram hash of every run of ``window - k + 1`` k-grams is kept, so two
texts that share ``window`` words keep the same k-gram there.  Kept k-grams are
the join keys between documents and benchmark; each carries the hashes of the
windows for which it was kept, and a hit extends to those that occur on both
sides.  Items shorter than a window are one window of their own length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwise.llm.common import Stages, byte_slices, keyed_texts, whole_rows
from plantwise.llm.wordhash import Windows, hash_words, selected, window_starts

WINDOW = 13
GRAM = 5
#: log2 of the bits of the filter through which documents' fingerprints pass
#: before the join; a fixed size, whatever the benchmark's.
FILTER_BITS = 24

#: Bytes to words: A-Z in lower case, letters, digits and all beyond ASCII kept, the rest separates.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, words of each text)."""
    parts = [t.translate(_FOLD).split() for t in texts]
    count = np.fromiter(map(len, parts), np.int64, len(parts))
    return hash_words([w for p in parts for w in p]), count


def window_keys(h: np.ndarray, count: np.ndarray, window: int, gram: int):
    """(text, first word in it, fingerprint, window hash) of every window."""
    starts, owner = window_starts(count, window)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return owner, starts, none, none
    w = Windows(h)
    places = np.arange(len(h) - gram + 1)
    g = w.of(places, places + gram)
    kept = selected(g, starts, window - gram + 1)
    return owner, starts - (np.cumsum(count) - count)[owner], g[kept], Windows(h, second=True).of(starts, starts + window)


def _benchmark_keys(items: DataFrame, window: int, gram: int, id_col: str, text_col: str) -> DataFrame:
    """``size, fp, win, item`` of every distinct window of an item."""
    src = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1):
                h, count = words_of(part.column(1).cast(pa.binary()).to_pylist())
                owner, _, fp, win = window_keys(h, count, window, gram)
                size = np.full(len(fp), window, np.int64)
                short = np.flatnonzero((count > 0) & (count < window))
                first = (np.cumsum(count) - count)[short]
                whole = Windows(h).of(first, first + count[short])
                again = Windows(h, second=True).of(first, first + count[short])
                owner, size = np.r_[owner, short], np.r_[size, count[short]]
                fp, win = np.r_[fp, whole], np.r_[win, again]
                yield pa.RecordBatch.from_arrays([pa.array(size), pa.array(fp.view(np.int64)), pa.array(win.view(np.int64)), part.column(0).take(pa.array(owner))],
                                                 names=["size", "fp", "win", "item"])

    return src.mapInArrow(run, "size long, fp long, win long, item string").distinct()


def _filter(keys: DataFrame) -> np.ndarray:
    """Bit set of the fingerprints' low ``FILTER_BITS`` bits, as bytes."""
    slot = F.col("fp").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = (keys.groupBy(F.shiftright(slot, 5).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, CAST(fp & 31 AS INT)))").alias("b")).collect())  # at most 2^(FILTER_BITS - 5) rows
    bits = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for w, b in words:
        bits[w] = b
    return bits.astype("<u4").view(np.uint8)


def _candidates(docs: DataFrame, bits: np.ndarray, short: list[int], window: int, gram: int, id_col: str, text_col: str) -> DataFrame:
    """``_id, _key, n_words, cand`` of every document; ``cand``: its distinct windows
    whose fingerprint passes the filter, with their first words."""
    src = keyed_texts(docs, id_col, text_col)
    table = docs.sparkSession.sparkContext.broadcast(bits)
    cand = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("size", "fp", "win")] + [T.StructField("starts", T.ArrayType(T.IntegerType()))]))
    schema = T.StructType([T.StructField("_id", src.schema["_id"].dataType), T.StructField("_key", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("cand", cand)])
    arrow = pa.list_(pa.struct([("size", pa.int64()), ("fp", pa.int64()), ("win", pa.int64()), ("starts", pa.list_(pa.int32()))]))

    def run(batches):
        bit = table.value
        low = np.uint64((1 << FILTER_BITS) - 1)

        def passed(fp):
            slot = (fp & low).astype(np.int64)
            return np.flatnonzero((bit[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)

        for batch in batches:
            for part in byte_slices(batch, 2):
                h, count = words_of(part.column(2).cast(pa.binary()).to_pylist())
                found = [{} for _ in range(len(count))]
                first = np.cumsum(count) - count
                for size in [window, *short]:
                    if size == window:
                        owner, start, fp, win = window_keys(h, count, window, gram)
                        k = passed(fp)
                        owner, start, fp, win = owner[k], start[k], fp[k], win[k]
                    else:
                        at, owner = window_starts(count, size)
                        fp = Windows(h).of(at, at + size)
                        k = passed(fp)
                        at, owner, fp = at[k], owner[k], fp[k]
                        start, win = at - first[owner], Windows(h, second=True).of(at, at + size)
                    for o, s, f, w in zip(owner.tolist(), start.tolist(), fp.view(np.int64).tolist(), win.view(np.int64).tolist()):
                        found[o].setdefault((size, f, w), []).append(s)
                rows = [[{"size": a, "fp": b, "win": c, "starts": s} for (a, b, c), s in x.items()] for x in found]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(count), pa.array(rows, arrow)], names=["_id", "_key", "n_words", "cand"])

    return src.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", one_in: int = 20,
                  with_key: bool = False) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every
    document: words inside an occurrence of a benchmark window, items with
    occurring windows, and whether at least one word in ``one_in`` is hit.

    Texts are read once and not shuffled.  Documents' fingerprints pass a bit
    filter of fixed size made from the benchmark's, so nearly only true hits
    are joined; a fuller filter lets more through and changes no result.
    Windows are equal if two independent 64-bit hashes of them are.

    Null texts have no words; null item ids count as one item named ``null``;
    items without words hit nothing; repeated documents are kept each, and
    repeated item ids count once; empty tables give no rows or no hits; other
    columns are ignored.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "decontamination")
    keys = stages.write(_benchmark_keys(benchmark, window, gram, item_col, item_text_col), "benchmark")
    short = sorted(r[0] for r in keys.select("size").distinct().collect() if r[0] != window)  # fewer than `window`
    marked = _candidates(docs, _filter(keys), short, window, gram, id_col, text_col)
    marked = stages.write(marked.withColumn("_row", F.monotonically_increasing_id()), "candidates")
    cand = marked.select("_row", F.explode("cand").alias("c")).select("_row", "c.*")
    hits = cand.join(keys, ["size", "fp", "win"])
    per_doc = hits.groupBy("_row").agg(F.collect_set(F.struct("size", "starts")).alias("spans"), F.collect_set("item").alias("items"))
    words = F.flatten(F.transform("spans", lambda x: F.flatten(F.transform(x["starts"], lambda s: F.sequence(s, s + x["size"].cast("int") - 1)))))
    per_doc = per_doc.select(F.col("_row").alias("_of"), F.size(F.array_distinct(words)).cast("long").alias("n"), "items")
    out = marked.select("_row", "_id", "_key", "n_words").join(per_doc, F.col("_row") == F.col("_of"), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n", F.lit(0).cast("long"))
    return out.select(F.col("_id").alias("doc_id"), *(["_key"] if with_key else []), "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
                      ((n_hit > 0) & (one_in * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, all columns, that aren't contaminated.

    Null and empty texts have no words and stay; rows repeated with a
    contaminated one go with it; null ids are kept; empty tables, of documents
    or of items, change nothing.  Rows travel as one value, so no column name
    clashes with a helper.
    """
    bad = contamination(docs, benchmark, id_col=id_col, text_col=text_col, with_key=True).filter("contaminated")
    stages = Stages(docs.sparkSession, "decontamination")
    bad = stages.write(bad.select(F.col("doc_id").alias("_bid"), F.col("_key").alias("_bkey")).distinct(), "contaminated")
    doc = F.col("_doc")
    key = F.xxhash64(F.coalesce(doc.getField(text_col), F.lit("")))
    return whole_rows(docs).join(bad, doc.getField(id_col).eqNullSafe(F.col("_bid")) & (key == F.col("_bkey")), "left_anti").select("_doc.*")


#: The same rows by DuckDB, window by window.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower_az(text), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(lower_az(text), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
bi AS (SELECT item, ws, least(len(ws), {WINDOW}) AS m FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item, m, array_to_string(ws[i:i + m - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(ws) - m + 2)) AS i FROM bi)),
dw AS (SELECT r, i, m, array_to_string(ws[i:i + m - 1], ' ') AS win FROM (
         SELECT r, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d JOIN (SELECT DISTINCT m FROM bw) ON len(ws) >= m)),
hit AS (SELECT r, i, dw.m AS m, item FROM dw JOIN bw ON dw.win = bw.win AND dw.m = bw.m),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hit) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(coalesce(ws, []))::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN n ON d.r = n.r LEFT JOIN it ON d.r = it.r
""".replace("lower_az(text)", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
