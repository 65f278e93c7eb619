"""Finding all windows of a fixed length that occur more than once.

Shared by the two substring operators, for words and for bytes.  With one row a
window the work would be many times the corpus, so windows are handled in
groups that every occurrence of a window forms alike:

* **Anchors.**  Of every ``span`` consecutive k-grams of a document the least
  (by hash, the rightmost of equals) is an anchor.  Which k-grams are anchors
  inside a window is decided by the window's own tokens, but for those that
  only spans across its ends choose.
* **Edges.**  The stretch from one anchor to the end of the next one's k-gram.
  From the first to the last anchor that a window itself chooses, all
  occurrences of the window have the same edges, and at least one
  (``2 * span + gram <= length + 1``).  So a window repeats only if these edges
  do.
* **Segments.**  The consecutive windows whose first own anchor is the same.
  All contain the anchor's *core*, the ``length - span + 1`` tokens from it on;
  together they are the segment's *reach*.  A reach that occurs twice settles
  all its windows; a core that occurs once rules them out; what remains, near
  the ends of repeated passages, is settled window by window.

Every step is a count by hash, combined before its shuffle, written, and joined
back to the places it came from, so a passage in any share of the documents is
an ordinary skewed join key that adaptive execution splits (it can't split a
join whose other side is still an aggregate over the same partitions).  Reaches and windows are compared by two independent 64-bit
hashes.  Positions are tokens of one document.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwise.llm.common import Stages, byte_slices, ranges
from plantwise.llm.wordhash import Windows, hash_words

#: Bits of a packed (hash, place) pair that hold the place: tokens of texts handled at once.
_PLACE = 28
_LOW = np.uint64((1 << _PLACE) - 1)

#: Tokens and their hashes of one text, and the text of kept tokens.
_BYTE_HASH = hash_words([bytes([b]) for b in range(256)])



@dataclass(frozen=True)
class Unit:
    """What a token is, and the window's length, k-gram and span in tokens."""

    words: bool
    length: int
    gram: int
    span: int

    def __post_init__(self):
        if self.gram < 1 or self.span < 1 or 2 * self.span + self.gram > self.length + 1:
            raise ValueError("2 * span + gram must not exceed length + 1")

    @property
    def step(self) -> int:
        """Bytes of text whose tokens a task holds as arrays at a time."""
        return 1 << 20 if self.words else 1 << 19

    def hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(token hashes of all texts, tokens of each)."""
        if self.words:
            parts = [t.split() for t in texts]
            count = np.fromiter(map(len, parts), np.int64, len(parts))
            return hash_words([w for p in parts for w in p]), count
        count = np.fromiter(map(len, texts), np.int64, len(texts))
        return _BYTE_HASH[np.frombuffer(b"".join(texts), np.uint8)], count


def for_length(words: bool, length: int) -> Unit:
    """Anchors as rare as the guarantee allows for words; for bytes a span that
    balances anchors against windows settled one by one."""
    gram = max(1, min(4 if words else 16, length // 8))
    span = max(1, (length + 1 - gram) // 2)
    return Unit(words, length, gram, span if words else min(span, 80))


class Places:
    """Anchors and segments of the documents of one slice."""

    def __init__(self, unit: Unit, texts: list[bytes]):
        self.unit = unit
        self.h, self.count = unit.hashes(texts)
        if len(self.h) >> _PLACE:
            raise ValueError(f"a text of over {1 << _PLACE} tokens")
        self.first = np.cumsum(self.count) - self.count
        self.one, self._two = Windows(self.h), None
        self.long = np.flatnonzero(self.count >= unit.length)
        if len(self.long):
            g = self.one.every(unit.gram)
            key = (g & ~_LOW) | (_LOW - np.arange(len(g), dtype=np.uint64))
            have = 1
            while have < unit.span:
                step = min(have, unit.span - have)
                key = np.minimum(key[: len(key) - step], key[step:])
                have += step
            self.own = (_LOW - (key & _LOW)).astype(np.int64)

    @property
    def two(self) -> Windows:
        if self._two is None:
            self._two = Windows(self.h, second=True)
        return self._two

    def chosen(self, d: int) -> np.ndarray:
        """For every span of document d its anchor."""
        u, o = self.unit, self.first[d]
        return self.own[o:o + self.count[d] - u.gram - u.span + 2] - o

    def anchors(self, d: int) -> np.ndarray:
        own = self.chosen(d)
        return own[np.r_[True, own[1:] != own[:-1]]]

    def edges(self, d: int) -> np.ndarray:
        p = self.anchors(d) + self.first[d]
        return self.one.of(p[:-1], p[1:] + self.unit.gram)

    def segments(self, d: int, repeated: np.ndarray, through: np.ndarray | None):
        """(first and last window, anchor) of the segments that may repeat, and
        of those the mask that paths settle.  ``repeated``: flags of the edges;
        ``through``: flags of the joints that don't branch."""
        u = self.unit
        own = self.chosen(d)
        p = own[np.r_[True, own[1:] != own[:-1]]]
        n = int(self.count[d]) - u.length + 1
        a = own[:n]
        s = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        t = np.r_[s[1:], n] - 1
        at = a[s]
        stop = _next(~repeated)
        x = np.searchsorted(p, at)
        y = np.searchsorted(p, own[s + u.length - u.gram - u.span + 1])
        may = stop[x] >= y
        s, t, at = s[may], t[may], at[may]
        if through is None:
            return s, t, at, np.zeros(len(s), bool)
        x = np.searchsorted(p, s, side="right") - 1  # the edges that hold the whole reach
        y = np.searchsorted(p, t + u.length - u.gram)
        inside = (x >= 0) & (y < len(p))
        x, y = np.maximum(x, 0), np.minimum(y, len(p) - 1)
        last = np.maximum(y - 1, x)
        return s, t, at, inside & (stop[x] >= y) & (_next(~through)[x] >= last)


def _next(bad: np.ndarray) -> np.ndarray:
    """For each place (and one past the end) the first bad place from it on."""
    n = len(bad)
    at = np.where(bad, np.arange(n), n)
    return np.r_[np.minimum.accumulate(at[::-1])[::-1], n]


def _lists(values: list[np.ndarray], kind) -> tuple[pa.Array, pa.Array]:
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat, kind)


def _each(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.binary()).to_pylist()


def _id_field(docs: DataFrame):
    return T.StructField("_id", docs.schema["_id"].dataType)


_LONGS = T.ArrayType(T.LongType())


def _edges(docs: DataFrame, unit: Unit) -> DataFrame:
    """``_id, _key, edges`` of the documents that have a window."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 2, unit.step):
                places = Places(unit, _each(part.column(2)))
                rows = pa.array(places.long)
                off, flat = _lists([places.edges(d) for d in places.long], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), pa.ListArray.from_arrays(off, flat)],
                                                 names=["_id", "_key", "edges"])

    return docs.mapInArrow(run, T.StructType([_id_field(docs), T.StructField("_key", T.LongType()), T.StructField("edges", _LONGS)]))


def _repeated_edges(held: DataFrame, stages: Stages, paths: bool) -> DataFrame:
    """``_id, _key, at`` (places of the repeated edges in order; with ``paths``
    also ``through``: those after which no occurrence goes another way).

    The edges form a De Bruijn graph over anchors: an edge leads on from its
    end node to every edge that follows it somewhere.  A joint of two edges
    does not branch if the first is always followed by the second and the
    second always preceded by the first.
    """
    flat = held.select("_row", F.posexplode("edges").alias("at", "edge"))
    if paths:
        # Ends of documents count as a way of their own (0).
        none = F.array(F.lit(0).cast("long"))
        after = F.concat(F.slice("edges", 2, F.greatest(F.size("edges") - 1, F.lit(0))), none)
        before = F.concat(none, F.slice("edges", 1, F.greatest(F.size("edges") - 1, F.lit(0))))
        ways = F.arrays_zip(F.col("edges").alias("edge"), after.alias("after"), before.alias("before"))
        ways = held.select(F.explode(ways).alias("x")).select("x.*").toDF("edge", "after", "before")
        seen = ways.groupBy("edge").agg(F.count(F.lit(1)).alias("n"), F.min("after").alias("a1"), F.max("after").alias("a2"),
                                        F.min("before").alias("b1"), F.max("before").alias("b2")).filter("n > 1")
        # A joint is straight if its first edge has one way out and its second one way in.
        ways = seen.select("edge", F.when((F.col("a1") == F.col("a2")) & (F.col("a1") != 0), F.col("a1")).alias("next"), (F.col("b1") == F.col("b2")).alias("one_in"))
        ways = stages.write(ways, "ways")
        into = ways.filter("one_in").select(F.col("edge").alias("next"), F.lit(True).alias("joined"))
        graph = ways.join(into, "next", "left").select("edge", F.coalesce("joined", F.lit(False)).alias("through"))
    else:
        graph = flat.groupBy("edge").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("edge", F.lit(False).alias("through"))
        graph = stages.write(graph, "ways")
    found = flat.join(graph, "edge")
    # A place and its flag in one number: at * 2 + through.
    per = found.groupBy("_row").agg(F.collect_list(F.col("at") * 2 + F.col("through").cast("int")).alias("at"))
    return held.select("_row", "_id", "_key").join(per, "_row").select("_id", "_key", "at")


_SEG = pa.struct([(c, pa.int64()) for c in ("h1", "h2", "core", "s", "t")] + [("path", pa.bool_())])
_SEGS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("h1", "h2", "core", "s", "t")] + [T.StructField("path", T.BooleanType())]))


def _segments(docs: DataFrame, unit: Unit, paths: bool) -> DataFrame:
    """From ``_id, _key, _text, at``: the same with ``segs`` instead of ``at``;
    ``path`` marks a segment that a path settles."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 2, unit.step):
                places = Places(unit, _each(part.column(2)))
                marks, cols, sizes = part.column(3).to_pylist(), [[] for _ in range(6)], np.zeros(part.num_rows, np.int64)
                for d in range(part.num_rows):
                    m = len(places.anchors(d)) - 1
                    at = np.array(marks[d], np.int64)
                    repeated, through = np.zeros(m, bool), np.zeros(m, bool)
                    repeated[at >> 1] = True
                    through[at[(at & 1) == 1] >> 1] = True
                    s, t, a, settled = places.segments(d, repeated, through if paths else None)
                    o = places.first[d]
                    core = places.one.of(a + o, a + o + unit.length - unit.span + 1).view(np.int64)
                    ends = o + t + unit.length
                    h1, h2 = places.one.of(o + s, ends).view(np.int64), places.two.of(o + s, ends).view(np.int64)
                    for c, v in zip(cols, (h1, h2, core, s, t, settled)):
                        c.append(v)
                    sizes[d] = len(s)
                flat = [pa.array(np.concatenate(c)) for c in cols]
                segs = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.StructArray.from_arrays(flat, fields=list(_SEG)))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], segs], names=["_id", "_key", "_text", "segs"])

    schema = T.StructType([_id_field(docs), T.StructField("_key", T.LongType()), T.StructField("_text", T.StringType()), T.StructField("segs", _SEGS)])
    return docs.mapInArrow(run, schema)


def _windows(docs: DataFrame, unit: Unit) -> DataFrame:
    """``h1, h2, _row, i, alone`` of every window of the segments ``todo`` of
    ``_row, _text, todo``."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, unit.step):
                places = Places(unit, _each(part.column(1)))
                todo = part.column(2)
                s, t, alone = (todo.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(3))
                per = np.diff(todo.offsets.to_numpy())
                n = t - s + 1
                i = ranges(s, n)
                doc = np.repeat(np.repeat(np.arange(part.num_rows), per), n)
                at = i + places.first[doc]
                h1, h2 = places.one.of(at, at + unit.length), places.two.of(at, at + unit.length)
                yield pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), part.column(0).take(pa.array(doc)),
                                                  pa.array(i, pa.int32()), pa.array(np.repeat(alone, n))], names=["h1", "h2", "_row", "i", "alone"])

    return docs.mapInArrow(run, "h1 long, h2 long, _row long, i int, alone boolean")


def repeated_spans(docs: DataFrame, unit: Unit, stages: Stages, paths: bool = False) -> DataFrame:
    """``_id, _key, spans`` (first token and end of stretches of windows that
    repeat, in any order, overlapping) of the documents of
    :func:`~plantwise.llm.common.keyed_texts` that have any."""
    held = stages.write(_edges(docs, unit).withColumn("_row", F.monotonically_increasing_id()), "edges")
    marks = stages.write(_repeated_edges(held, stages, paths), "marks").groupBy("_id", "_key").agg(F.first("at").alias("at"))
    # The texts that may have repeats, read again once for their segments.
    m = marks.select(F.col("_id").alias("_mid"), F.col("_key").alias("_mkey"), "at")
    some = docs.join(m, docs["_id"].eqNullSafe(m["_mid"]) & (docs["_key"] == m["_mkey"])).select("_id", "_key", "_text", "at")
    cut = stages.write(_segments(some, unit, paths).withColumn("_row", F.monotonically_increasing_id()), "segments")
    stages.drop("edges", "marks", "ways")
    segs = cut.select("_row", F.explode("segs").alias("g")).select("_row", "g.*")
    # Most significant digit first: distinct reaches by core, with one place of each.
    reach = segs.groupBy("core", "h1", "h2").agg((F.count(F.lit(1)) == 1).alias("alone"), F.min(F.struct("_row", "s", "t")).alias("one"))
    reach = stages.write(reach, "reaches")
    sure = segs.filter(~F.col("path")).join(reach.filter(~F.col("alone")).select("core", "h1", "h2"), ["core", "h1", "h2"])
    sure = segs.filter("path").select("_row", "s", "t").union(sure.select("_row", "s", "t"))
    known = stages.write(sure.groupBy("_row").agg(F.collect_list(F.struct("s", "t")).alias("sure")), "known")
    # A reach that occurs once may share windows with other reaches of its core.
    mixed = reach.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.max("alone").alias("some")).filter("n > 1 AND some").select("core")
    mixed = stages.write(mixed, "mixed")
    todo = reach.join(mixed, "core").select("one.*", "alone").groupBy(F.col("_row").alias("_of")).agg(F.collect_list(F.struct("s", "t", "alone")).alias("todo"))
    todo = cut.select("_row", "_text").join(todo, F.col("_row") == F.col("_of")).select("_row", "_text", "todo")
    wins = stages.write(_windows(todo, unit), "windows")
    again = stages.write(wins.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2"), "again")
    found = wins.filter("alone").join(again, ["h1", "h2"]).groupBy("_row").agg(F.collect_list("i").alias("i"))
    found = stages.write(found, "found")
    stages.drop("windows", "reaches", "mixed", "again")
    length = unit.length
    near = lambda x: F.struct(x["s"].cast("int").alias("a"), (x["t"] + length).cast("int").alias("b"))
    one = lambda x: F.struct(x.cast("int").alias("a"), (x + length).cast("int").alias("b"))
    none = F.array().cast("array<struct<a:int,b:int>>")
    both = known.select("_row", "sure").join(found, "_row", "full_outer")
    spans = both.select("_row", F.concat(F.coalesce(F.transform("sure", near), none), F.coalesce(F.transform("i", one), none)).alias("spans")).filter(F.size("spans") > 0)
    spans = cut.select("_row", "_id", "_key").join(spans, "_row")
    spans = stages.write(spans.groupBy("_id", "_key").agg(F.first("spans").alias("spans")), "spans")
    stages.drop("segments", "known", "found")
    return spans


def merged(spans: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs (first, end) of a document's spans."""
    if not spans:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = np.array([x["a"] for x in spans], np.int64)
    b = np.array([x["b"] for x in spans], np.int64)
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.r_[True, a[1:] > b[:-1]]
    return a[new], b[np.r_[new[1:], True]]


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the column ``spans`` (null: none)."""
    s = spans.select(F.col("_id").alias("_sid"), F.col("_key").alias("_skey"), "spans")
    return docs.join(s, docs["_id"].eqNullSafe(s["_sid"]) & (docs["_key"] == s["_skey"]), "left").drop("_sid", "_skey")


def map_texts(docs: DataFrame, row: Callable[[bytes, np.ndarray, np.ndarray], tuple], fields: list[T.StructField]) -> DataFrame:
    """``doc_id`` and what ``row(text, firsts, ends)`` gives, for each row of
    ``_id, _text, spans``."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, 1 << 20):
                out = [row(t, *merged(s)) for t, s in zip(_each(part.column(1)), part.column(2).to_pylist())]
                cols = [pa.array(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], names=["doc_id", *(f.name for f in fields)])

    src = docs.select("_id", "_text", "spans")
    return src.mapInArrow(run, T.StructType([T.StructField("doc_id", docs.schema["_id"].dataType), *fields]))


