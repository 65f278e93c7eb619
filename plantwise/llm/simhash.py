"""SimHash near-dedup (operator 3) by a Gray-order hierarchical index.

Fingerprints at most ``max_bits`` apart agree on at least ``SEGMENTS -
max_bits`` of their segments, so each pair of that many segments is a table in
which every link has a common bucket.  Inside a bucket the fingerprints stand
in Gray order, where neighbours differ in few bits; blocks of them become nodes
that hold the bits all members share, blocks of nodes upper nodes.  Pairs of
nodes are followed from the top, the differences on shared bits add up on the
way, and a pair beyond ``max_bits`` is dropped with everything below it.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwise.llm.common import Stages, byte_slices, ranges, whole_rows
from plantwise.llm.components import connected_components

#: Members of an index node.
FANOUT = 16
#: Fingerprints of a bucket that one task indexes; larger buckets are linked
#: through midpoints instead, which has no cost by pairs.
BUCKET = 30_000
#: Node pairs compared in one array step.
STEP_PAIRS = 1 << 18


def _spread() -> np.ndarray:
    """Byte -> 64-bit word with its bit k in byte k."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view(np.uint64).ravel()


_SPREAD = _spread()


def shingle_hashes(text: bytes, size: int, seed: int) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1:].tolist())]


def fingerprints_of(texts: list[bytes], size: int = 4, seed: int = 42) -> np.ndarray:
    """64-bit SimHash of each text: a bit is set if it is in over half the hashes."""
    per = [shingle_hashes(t, size, seed) for t in texts]
    count = np.array([len(x) for x in per], np.int64)
    out = np.zeros(len(per), np.uint64)
    some = np.flatnonzero(count)
    if not len(some):
        return out
    h = np.fromiter((x for p in per for x in p), np.uint64, int(count.sum()))
    lanes = _SPREAD[h.astype("<u8").view(np.uint8).reshape(-1, 8)]
    # Byte lanes hold sums of up to 255 hashes; longer texts are summed in parts.
    parts = -(-count[some] // 255)
    first = np.cumsum(count[some]) - count[some]
    cuts = np.repeat(first, parts) + 255 * ranges(np.zeros(len(parts)), parts)
    sums = np.add.reduceat(lanes, cuts, axis=0).view(np.uint8).reshape(len(cuts), 64).astype(np.int64)
    sums = np.add.reduceat(sums, np.cumsum(parts) - parts, axis=0)
    bits = (2 * sums > count[some][:, None]).astype(np.uint8)
    out[some] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, size: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long) of every document."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, 1 << 20):
                fp = fingerprints_of(part.column(1).cast(pa.binary()).to_pylist(), size, seed)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return src.mapInArrow(run, T.StructType([T.StructField("doc_id", src.schema["doc_id"].dataType), T.StructField("fp", T.LongType())]))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code in the binary reflected Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _differ(a, b, mask=None):
    x = a ^ b
    return np.bitwise_count(x if mask is None else x & mask)


def _roots(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b, all pointing at the least member."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


class GrayIndex:
    """Nodes over fingerprints in Gray order; ``levels[0]`` are the leaves'
    blocks: pattern and mask of the bits that all members share."""

    def __init__(self, codes: np.ndarray, fanout: int = FANOUT):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        self.fanout = fanout
        pattern, mask = self.codes, np.full(len(codes), ~np.uint64(0))
        self.levels = []
        while len(pattern) > 1 or not self.levels:
            cuts = np.arange(0, len(pattern), fanout)
            lead = np.repeat(pattern[cuts], np.diff(np.r_[cuts, len(pattern)]))
            mask = np.bitwise_and.reduceat(mask & ~(pattern ^ lead), cuts)
            pattern = pattern[cuts] & mask
            self.levels.append((pattern, mask))

    def _children(self, i, j, below):
        """Pairs of members of the node pairs (i, j), each unordered pair once."""
        f = self.fanout
        ni, nj = (np.minimum(f, below - x * f) for x in (i, j))
        a = np.repeat(i * f, ni * nj) + ranges(np.zeros(len(i)), ni * nj) // np.repeat(nj, ni * nj)
        b = np.repeat(j * f, ni * nj) + ranges(np.zeros(len(i)), ni * nj) % np.repeat(nj, ni * nj)
        keep = a <= b
        return a[keep], b[keep], np.repeat(np.arange(len(i)), ni * nj)[keep]

    def components(self, max_bits: int) -> np.ndarray:
        """Least place of each code's component under links of at most
        ``max_bits`` differing bits.  Node pairs whose members are all in one
        component already have nothing to add and are dropped too."""
        label = np.arange(len(self.codes))
        pattern, mask = self.levels[-1]
        todo = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            level, i, j, seen = todo.pop()
            if len(i) > STEP_PAIRS // self.fanout**2:
                cut = STEP_PAIRS // self.fanout**2
                todo.append((level, i[cut:], j[cut:], seen[cut:]))
                i, j, seen = i[:cut], j[:cut], seen[:cut]
            if level <= 1:
                span = self.fanout ** (level + 1)
                low = np.minimum.reduceat(label, np.arange(0, len(label), span))
                high = np.maximum.reduceat(label, np.arange(0, len(label), span))
                open_ = ~((low[i] == high[i]) & (low[j] == high[j]) & (low[i] == low[j]))
                i, j, seen = i[open_], j[open_], seen[open_]
                if not len(i):
                    continue
            pattern, mask = self.levels[level]
            common = (mask[i] & mask[j])
            if level == 0:
                a, b, of = self._children(i, j, len(self.codes))
                apart = seen[of] + _differ(self.codes[a], self.codes[b], ~common[of])
                hit = (apart <= max_bits) & (a < b)
                if hit.any():
                    label = _roots(label, a[hit], b[hit])
            else:
                pattern, mask = self.levels[level - 1]
                a, b, of = self._children(i, j, len(pattern))
                apart = seen[of] + _differ(pattern[a], pattern[b], mask[a] & mask[b] & ~common[of])
                hit = apart <= max_bits
                todo.append((level - 1, a[hit], b[hit], apart[hit]))
        return label


def _segments(number: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``number`` nearly equal segments of 64 bits."""
    cuts = [64 * k // number for k in range(number + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _tables(max_bits: int):
    segments = _segments(max_bits + 2)
    return [(segments[a], segments[b]) for a, b in combinations(range(len(segments)), 2)]


def _bucketed(fps: DataFrame, max_bits: int) -> DataFrame:
    """``bucket, fp``: a row in each table."""
    rows = []
    for t, ((a, wa), (b, wb)) in enumerate(_tables(max_bits)):
        part = lambda low, w: F.shiftrightunsigned(F.col("fp"), low).bitwiseAND(F.lit((1 << w) - 1))
        rows.append(F.shiftleft(F.shiftleft(part(a, wa), wb).bitwiseOR(part(b, wb)), 8).bitwiseOR(F.lit(t)))
    return fps.select(F.explode(F.array(*rows)).alias("bucket"), "fp")


def _bucket_links(batches, max_bits):
    """Links inside each bucket of a partition sorted by bucket."""
    def links(bucket, fp):
        cut = np.flatnonzero(np.diff(bucket)) + 1
        first, n = np.r_[0, cut], np.diff(np.r_[0, cut, len(bucket)])
        a, b = [], []
        few = (n > 1) & (n <= FANOUT)
        at = ranges(first[few], n[few])
        owner = np.repeat(np.arange(int(few.sum())), n[few])
        for d in range(1, FANOUT):  # small buckets: neighbours d apart, all at once
            if len(at) <= d:
                break
            k = np.flatnonzero((owner[d:] == owner[:-d]) & (_differ(fp[at[d:]], fp[at[:-d]]) <= max_bits))
            a.append(fp[at[k]])
            b.append(fp[at[k + d]])
        for s, m in zip(first[n > FANOUT].tolist(), n[n > FANOUT].tolist()):
            index = GrayIndex(fp[s:s + m])
            label = index.components(max_bits)
            k = np.flatnonzero(label != np.arange(m))
            a.append(index.codes[k])
            b.append(index.codes[label[k]])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (a, b))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    held = None
    for batch in batches:
        bucket = batch.column(0).to_numpy(zero_copy_only=False)
        fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if held is not None:
            bucket, fp = np.concatenate([held[0], bucket]), np.concatenate([held[1], fp])
        last = int(np.searchsorted(bucket, bucket[-1])) if len(bucket) else 0
        if last:
            yield links(bucket[:last], fp[:last])
        held = bucket[last:], fp[last:]
    if held is not None and len(held[0]):
        yield links(*held)


def _midpoint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links of fingerprints that share a code at most half of ``max_bits``
    from each: two codes are ``max_bits`` apart or less exactly if they share
    one.  A row a code and flip set, combined before the shuffle."""
    flips = [0] + [sum(1 << k for k in c) for n in range(1, max_bits // 2 + 1) for c in combinations(range(64), n)]
    flips = np.array(flips, np.uint64).view(np.int64).tolist()
    odd = max_bits % 2  # one side may be one bit further away
    near = fps.select("fp", F.explode(F.array(*map(F.lit, flips))).alias("x")).select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("z"))
    if odd:
        raise ValueError("midpoints need an even number of bits")
    star = near.groupBy("z").agg(F.min("fp").alias("b"))
    return near.join(star, "z").filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def fingerprint_components(fps: DataFrame, stages: Stages, max_bits: int = 4, bucket_size: int = BUCKET) -> DataFrame:
    """``node, root`` of distinct fingerprints (column ``fp``, a written table)
    that have a link at most ``max_bits`` bits apart."""
    rows = stages.write(_bucketed(fps, max_bits), "buckets")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = stages.write(sizes, "sizes")
    shared = rows.join(sizes.filter(F.col("n") <= bucket_size), "bucket").select("bucket", "fp")
    shared = shared.repartition("bucket").sortWithinPartitions("bucket")
    links = shared.mapInArrow(lambda it: _bucket_links(it, max_bits), "a long, b long")
    large = sizes.filter(F.col("n") > bucket_size)
    if not large.isEmpty():
        crowded = stages.write(rows.join(large, "bucket").select("fp").distinct(), "crowded")
        links = links.union(_midpoint_links(crowded, max_bits))
    roots = connected_components(links, stages)
    stages.drop("buckets", "sizes", "crowded")
    return roots


def simhash_groups(docs: DataFrame, size: int = 4, max_bits: int = 4, seed: int = 42,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document: fingerprints
    link at ``max_bits`` or fewer differing bits, and a component is named by
    its least document id.

    Texts are read once and never shuffled.  Equal fingerprints are one node,
    whatever their number, so copies cost nothing in the index; buckets are
    bounded per task, larger ones go through midpoints; links of a bucket are a
    spanning forest, not its pairs.  Null or empty texts have fingerprint zero
    and link like any other; null ids don't name a component unless all its ids
    are null; repeated rows are kept; an empty table gives no rows; other
    columns are ignored.
    """
    stages = Stages(docs.sparkSession, "simhash")
    marked = stages.write(fingerprints(docs, size, seed, id_col, text_col), "fingerprints")
    fps = stages.write(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = fingerprint_components(fps.select("fp"), stages, max_bits)
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stages.write(rooted.join(names, "root").select("fp", "component_id"), "named")
    stages.drop("distinct", "roots")
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, all columns, with one document of each group of near
    duplicates: that with the least id (null ids last), of rows repeated with it
    any one.

    Null and empty texts have fingerprint zero and are one group with all that
    are near it; an empty table stays empty.  Rows travel as one value, so no
    column name clashes with a helper.
    """
    def marks(doc_id, text):
        text = F.coalesce(text, F.lit(""))
        return [F.xxhash64(doc_id, text).alias("_a"), F.xxhash64(F.lit("__pw"), text, doc_id).alias("_b")]

    stages = Stages(docs.sparkSession, "simhash")
    own_id, own_text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    src = docs.select(F.struct(own_id.cast("string").alias("id"), own_id.isNull().alias("none"), *marks(own_id, own_text)).alias("row"), own_text.alias("text"))
    marked = stages.write(fingerprints(src, size, id_col="row"), "fingerprints")
    fps = stages.write(marked.select("fp").distinct(), "distinct")
    roots = fingerprint_components(fps, stages, max_bits)
    kind = docs.schema[id_col].dataType
    order = F.struct(F.col("doc_id.none").alias("none"), F.col("doc_id.id").cast(kind).alias("id"), F.col("doc_id._a").alias("a"), F.col("doc_id._b").alias("b"))
    least = marked.groupBy("fp").agg(F.min(order).alias("least"))  # combined before any join: copies cost one row a task
    chosen = (least.join(roots, least["fp"] == roots["node"], "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("least").alias("least"))
              .select(F.col("least.a").alias("_ca"), F.col("least.b").alias("_cb")))
    chosen = stages.write(chosen, "chosen")
    stages.drop("fingerprints", "distinct", "roots")
    doc = F.col("_doc")
    rows = whole_rows(docs).select("_doc", *marks(doc.getField(id_col), doc.getField(text_col)))
    kept = rows.join(chosen, (F.col("_a") == F.col("_ca")) & (F.col("_b") == F.col("_cb")), "left_semi")
    nth = F.row_number().over(W.partitionBy("_a", "_b").orderBy("_a"))
    return kept.withColumn("_n", nth).filter("_n = 1").select("_doc.*")
