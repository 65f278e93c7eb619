"""Best-fit packing (operator 10): patterns of few documents fitted to the
length histogram by non-negative least squares, residuals packed best-fit.

Only the histogram of piece lengths (at most ``limit`` numbers, whatever the
corpus) reaches the driver.  Patterns are named by length classes, sequences
are planned in exact lengths.  The plan made there is a list of templates,
bounded by the numbers of patterns and lengths; pieces find their places by a
distributed rank within their length.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwise.llm.common import Stages, byte_slices, keyed_texts
from plantwise.llm.encoding import STEP_BYTES, encoder, vocabulary

#: Length classes that patterns are enumerated over at most.
CLASSES = 512
#: Pieces ranked together in one task, about.
RANK_GROUP = 50_000


def token_pieces(docs: DataFrame, vocab: str, end_id: int | None, limit: int,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``_id, _key, piece, start, length, ids_crc32`` (and ``ids``) of every
    piece; only documents over ``limit`` ids are cut.  Little of a worker's
    memo of words outlives its task."""
    src = keyed_texts(docs, id_col, text_col)
    fields = [T.StructField("_id", src.schema["_id"].dataType), T.StructField("_key", T.LongType())]
    fields += [T.StructField(c, T.LongType()) for c in ("piece", "start", "length", "ids_crc32")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    def cut(batches):
        enc = encoder(vocabulary(vocab))
        end = np.array([] if end_id is None else [end_id], np.uint32)
        try:
            for batch in batches:
                for part in byte_slices(batch, 2, STEP_BYTES):
                    rows, cols, kept = [], [[], [], [], []], []
                    for k, ids in enumerate(enc.encode(part.column(2).to_pylist())):
                        ids = np.append(ids, end).astype("<u4")
                        for p, a in enumerate(range(0, len(ids), limit)):
                            piece = ids[a:a + limit]
                            rows.append(k)
                            for c, v in zip(cols, (p, a, len(piece), zlib.crc32(piece))):
                                c.append(v)
                            if with_ids:
                                kept.append(piece.tolist())
                    at = pa.array(rows, pa.int64())
                    out = [part.column(0).take(at), part.column(1).take(at), *(pa.array(c, pa.int64()) for c in cols)]
                    if with_ids:
                        out.append(pa.array(kept, pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields])
        finally:
            enc.forget()  # the worker may be idle for stages

    return src.mapInArrow(cut, T.StructType(fields))


def patterns(size: int) -> np.ndarray:
    """All multisets of one to three classes that sum to ``size``; 0 pads."""
    out = [(size, 0, 0)]
    for a in range(1, size // 2 + 1):
        out.append((size - a, a, 0))
    for a in range(1, size // 3 + 1):
        b = np.arange(a, (size - a) // 2 + 1)
        out += list(zip((size - a - b).tolist(), b.tolist(), [a] * len(b)))
    return np.array(out, np.int64)


def fit_counts(pats: np.ndarray, hist: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative repeat counts whose pieces come closest to the histogram
    (``hist[c]`` pieces of class c; long classes weigh more), by accelerated
    projected gradient steps; a pattern touches three classes, so no matrix is
    formed."""
    n = len(hist)
    weight = (np.arange(n) / max(1, n - 1)) ** 2
    weight[0] = 0.0

    def used(x):
        return np.bincount(pats.ravel(), weights=np.repeat(x, 3), minlength=n)

    def back(r):
        return (weight * r)[pats].sum(axis=1)

    v = np.ones(len(pats))
    for _ in range(30):
        v = back(used(v))
        v /= np.linalg.norm(v) or 1.0
    step = 1.0 / max(1e-9, 1.05 * np.linalg.norm(back(used(v))))
    x = y = np.zeros(len(pats))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - step * back(used(y) - hist))
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / s * (new - x)
        if np.dot(y - new, new - x) < 0 and t > 100:
            s, y = 1.0, new
        x, t = new, s
    return x


def _fitted(hist: np.ndarray, left: np.ndarray, size: int) -> list[tuple[dict[int, int], int]]:
    """Sequences made of patterns of up to three length classes; their pieces
    are taken from ``left``.  Classes only name the patterns: the pieces are of
    exact lengths, the shortest of a pattern the longest that still fits."""
    quantum = -(-size // CLASSES)
    n = size // quantum
    of = np.minimum(-(-np.arange(size + 1) // quantum), n)
    by_class = np.bincount(of, weights=hist, minlength=n + 1)
    pats = patterns(n)
    pats = pats[((by_class[pats] > 0) | (pats == 0)).all(axis=1)]
    if not len(pats):
        return []
    at = list(range(size + 1))  # longest length up to this one that may have pieces left

    def longest(r: int, taken: Counter) -> int:
        while r > 0 and left[r] <= taken[r]:
            if left[r] > 0:  # all in this very sequence
                r -= 1
                continue
            below = at[r - 1] if at[r] == r else at[r]
            at[r] = below
            r = below
        return r

    tops = [min(c * quantum, size) if c < n else size for c in range(n + 1)]
    x = fit_counts(pats, by_class)
    out: list[tuple[dict[int, int], int]] = []
    for k in np.argsort(-x, kind="stable"):
        want = int(round(x[k]))
        if want < 1:
            break
        classes = [int(c) for c in pats[k] if c]
        while want > 0:
            need: Counter = Counter()
            space = size
            for j, c in enumerate(classes):
                last = j + 1 == len(classes)
                r = longest(min(space, size if last else tops[c]), need)
                if r <= tops[c - 1]:
                    break
                need[r] += 1
                space -= r
            else:
                number = min([want, *(int(left[r]) // m for r, m in need.items())])
                out.append((dict(need), number))
                for r, m in need.items():
                    left[r] -= m * number
                want -= number
                continue
            break
    return out


def _best_fit(left: np.ndarray, size: int, open_: list[tuple[dict[int, int], int]]) -> list[tuple[dict[int, int], int]]:
    """Best fit in decreasing order of exact lengths, into the space left in
    ``open_`` sequences and new ones, many equal pieces and bins a step."""
    room: list[list[list]] = [[] for _ in range(size + 1)]  # by space left: [contents, bins]
    for contents, number in open_:
        room[size - sum(r * m for r, m in contents.items())].append([contents, number])
    for c in range(size, 0, -1):
        n, r = int(left[c]), c
        while n > 0:
            while r <= size and not room[r]:
                r += 1
            if r > size:  # new bins
                for k, bins in ((size // c, n // (size // c)), (n % (size // c), 1)):
                    if k and bins:
                        room[size - k * c].append([{c: k}, bins])
                break
            contents, bins = room[r].pop()
            k = r // c
            full = min(bins, n // k)
            rest = n - full * k if full < bins and n - full * k < k else 0
            for add, number in ((k, full), (rest, 1)):
                if add and number:
                    room[r - add * c].append([{**contents, c: contents.get(c, 0) + add}, number])
                    bins -= number
                    n -= add * number
            if bins:
                room[r].append([contents, bins])
    return [(c, b) for at in room for c, b in at]


def plan_templates(hist: np.ndarray, size: int) -> list[tuple[dict[int, int], int]]:
    """(pieces of each length in a sequence, number of such sequences) that
    together hold every piece of the length histogram: patterns and best fit
    for the rest, or best fit alone where that takes fewer sequences."""
    hist = hist.astype(np.int64)
    left = hist.copy()
    fitted = _fitted(hist, left, size)
    plans = [_best_fit(left, size, fitted), _best_fit(hist, size, [])]
    return min(plans, key=lambda plan: sum(number for _, number in plan))


def _places(templates):
    """Arrays by (length, first rank): sequence and slot of a length's pieces."""
    rows, used, base = [], Counter(), 0
    for contents, number in templates:
        slot = 0
        for c in sorted(contents, reverse=True):
            m = contents[c]
            rows.append((c, used[c], base, m, slot))
            used[c] += m * number
            slot += m
        base += number
    rows.sort()
    return [np.array(col, np.int64) for col in zip(*rows)]


def _salted(pieces: DataFrame, salts: int) -> DataFrame:
    """``_size`` and ``_salt``, the groups that pieces are ranked in."""
    return pieces.withColumn("_size", F.col("length")).withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)))


def pack(docs: DataFrame, vocab: str = "word_bpe_49k.json", end_id: int | None = 1, limit: int = 4096,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset`` (and ``ids``); every sequence holds at most ``limit``
    ids without gaps.

    Patterns of up to three of ``CLASSES`` length classes that fill a sequence
    are fitted to the class histogram, their counts rounded and filled with
    pieces of exact lengths; what is left is packed best-fit decreasing by exact
    length, also into the space that patterns leave.  Best fit alone is planned
    too and the plan of fewer sequences is used.  A piece's rank in its length,
    taken in groups salted by the row number of the written pieces so that a
    length with any share of the pieces, repeated rows too, is spread over many
    tasks, names its sequence; offsets are running sums within a sequence.

    Null texts are empty (a piece of the end id alone); null ids are kept;
    repeated rows are packed each; a document without any id has no piece; an
    empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "packing")
    pieces = token_pieces(docs, vocab, end_id, limit, id_col, text_col, with_ids).withColumn("_row", F.monotonically_increasing_id())
    pieces = stages.write(pieces, "pieces")
    hist = np.zeros(limit + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most `limit` rows
        hist[length] = n
    total = int(hist.sum())
    out_cols = [F.col("_id").alias("doc_id"), F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32"]
    if not total:
        return pieces.select(*out_cols, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *(["ids"] if with_ids else []))
    size, first, base, mult, slot = _places(plan_templates(hist, limit))
    salts = max(1, total // RANK_GROUP)
    ranked = _salted(pieces, salts)
    groups = ranked.groupBy("_size", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("_size").orderBy("_salt")) - F.col("_n")  # `salts` rows a length
    groups = groups.select("_size", "_salt", before.alias("_before"))
    in_group = W.partitionBy("_size", "_salt").orderBy("_row")
    ranked = (ranked.withColumn("_rank", F.row_number().over(in_group).cast("long") - 1)
              .join(groups, ["_size", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_before", "_salt"))
    ranked = ranked.select("_size", "_rank", *pieces.columns)
    schema = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("_slot", T.LongType()), *pieces.schema.fields])
    key = size * (total + 1) + first

    def place(batches):
        for b in batches:
            c, r = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            at = np.searchsorted(key, c * (total + 1) + r, side="right") - 1
            k = r - first[at]
            yield pa.RecordBatch.from_arrays([pa.array(base[at] + k // mult[at]), pa.array(slot[at] + k % mult[at]), *b.columns[2:]],
                                             names=schema.names)

    in_sequence = W.partitionBy("sequence_id").orderBy("_slot")
    offset = F.sum("length").over(in_sequence) - F.col("length")
    return ranked.mapInArrow(place, schema).select(*out_cols, "sequence_id", offset.alias("offset"), *(["ids"] if with_ids else []))


def packed_sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from the rows of :func:`pack` with ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most `limit` ids
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
