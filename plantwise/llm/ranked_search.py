"""Ranked lexical search (operator 11) by multi-query common-subexpression evaluation.

A score is a sum over an item's terms, so items that share a set of terms share
the partial sum.  For a block of items the shared sets are mined once:

* terms that stand in the same items equally often are one **class**;
* classes, ordered by the number of items that hold them, are paired wherever
  the same two are neighbours in two or more items, again and again.  The pairs
  form a **query-sharing DAG**: a node is the sum of two others, an item the sum
  of the nodes that are left of it.

Documents are read once a block: a task writes a document's length and its
counts of the block's terms.  From that table come the corpus statistics and
then the scores: for a run of documents a task materialises the accumulator of
every class and node once, adds up the items from them and hands on the best of
each item.  The best are merged in two grouped steps.  Only rows already among a
task's best are ever shuffled.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwise.llm.common import Stages, byte_slices

TOP = 20
#: Distinct terms, summed over items, of a block (or one item): what the driver
#: plans and tasks receive at a time.
BLOCK_TERMS = 1 << 16
#: Numbers in the accumulators that a task holds at a time.
CELLS = 1 << 22
#: Bytes of text split into words at a time.
STEP = 1 << 20
#: Terms beyond this many bytes are known by a 128-bit hash.
LONG_TERM = 64
#: Tasks that merge one item's best before the last step.
SALTS = 32

#: A-Z to lower case; all that can't be in a term to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_runs(text: bytes):
    """The terms of a text, in lists from about ``STEP`` bytes each."""
    folded = text.translate(_FOLD)
    if len(folded) <= STEP:
        yield folded.split()
        return
    a = 0
    while a < len(folded):
        b = folded.find(b" ", a + STEP) if len(folded) - a > STEP else -1
        b = len(folded) if b < 0 else b
        yield folded[a:b].split()
        a = b


def named(term: bytes) -> bytes:
    return term if len(term) <= LONG_TERM else b" " + xxhash.xxh3_128_digest(term)


@dataclass
class Plan:
    """Terms, classes and the sharing DAG of a block of items.

    ``vocab``: term -> number; ``kind``: the class of each term; ``atoms``:
    (class, multiplicity) of the first nodes; ``pairs``: the two nodes that each
    further node sums; ``items``: (row number, nodes) of each item.
    """

    vocab: dict[bytes, int] = field(default_factory=dict)
    kind: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    atoms: list[tuple[int, int]] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    items: list[tuple[int, list[int]]] = field(default_factory=list)

    @property
    def nodes(self) -> int:
        return len(self.atoms) + len(self.pairs)


def plan_block(items: list[tuple[int, list[tuple[bytes, int]]]]) -> Plan:
    """Mines the shared term sets of ``(row number, [(term, times)])``."""
    plan = Plan()
    held: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    for k, (_, terms) in enumerate(items):
        for t, times in terms:
            held[t].append((k, times))
    classes: dict[tuple, int] = {}
    kind = []
    for t, at in held.items():
        plan.vocab[t] = len(kind)
        kind.append(classes.setdefault(tuple(at), len(classes)))
    plan.kind = np.array(kind, np.int64)
    atoms: dict[tuple[int, int], int] = {}
    use: list[list[int]] = [[] for _ in items]
    support = []
    for at, c in classes.items():
        for k, times in at:
            a = atoms.setdefault((c, times), len(atoms))
            if a == len(support):
                support.append(0)
            support[a] += 1
            use[k].append(a)
    plan.atoms = list(atoms)
    rows = [sorted(u, key=lambda a: (-support[a], a)) for u in use]
    while True:
        seen = Counter(p for r in rows for p in zip(r, r[1:]))
        if not seen or max(seen.values()) < 2:
            break
        node: dict[tuple[int, int], int] = {}
        for k, r in enumerate(rows):
            out, i = [], 0
            while i < len(r):
                here = seen[r[i], r[i + 1]] if i + 1 < len(r) else 0
                after = seen[r[i + 1], r[i + 2]] if i + 2 < len(r) else 0
                if here >= 2 and here >= after:
                    pair = (r[i], r[i + 1])
                    if pair not in node:
                        node[pair] = plan.nodes
                        plan.pairs.append(pair)
                    out.append(node[pair])
                    i += 2
                else:
                    out.append(r[i])
                    i += 1
            rows[k] = out
    plan.items = [(row, r) for (row, _), r in zip(items, rows)]
    return plan


def item_terms(items: DataFrame, limit: int) -> DataFrame:
    """``_item, terms, times, block`` of every row of ``_item, text`` that has a
    term.  A block is rows that follow each other, of together at most ``limit``
    terms, or one row."""

    def run(batches):
        block, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in byte_slices(batch, 1, STEP):
                out = []
                for row, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    count: Counter[bytes] = Counter()
                    for run_ in term_runs(text):
                        count.update(map(named, run_))
                    if count:
                        if filled and filled + len(count) > limit:
                            block, filled = block + 1, 0
                        filled += len(count)
                        out.append((row, list(count), list(count.values()), block))
                cols = list(zip(*out)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.int64()))], names=["_item", "terms", "times", "block"])

    return items.mapInArrow(run, "_item long, terms array<binary>, times array<long>, block long")


def postings(docs: DataFrame, vocab: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tf`` of every row of ``doc_id, text``: all its terms,
    and which of ``vocab`` it has how often."""
    size = max(1, len(vocab))
    hashed = any(t[:1] == b" " for t in vocab)

    def numbers(text):
        """(terms of the text, numbers of those in the vocabulary)."""
        n, found = 0, []
        for words in term_runs(text):
            n += len(words)
            words = map(named, words) if hashed else words
            at = np.fromiter(map(vocab.get, words, repeat(-1)), np.int64)
            found.append(at[at >= 0])
        return n, np.concatenate(found) if found else np.zeros(0, np.int64)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, STEP):
                got = [numbers(t) for t in part.column(1).cast(pa.binary()).to_pylist()]
                n = np.array([x[0] for x in got], np.int64)
                own = np.repeat(np.arange(len(got)), [len(x[1]) for x in got])
                key, tf = np.unique(own * size + np.concatenate([x[1] for x in got]), return_counts=True)
                off = pa.array(np.r_[0, np.cumsum(np.bincount(key // size, minlength=len(got)))], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.ListArray.from_arrays(off, pa.array(key % size, pa.int32())),
                                                  pa.ListArray.from_arrays(off, pa.array(tf, pa.int32()))], names=["doc_id", "n", "terms", "tf"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(run, schema)


def item_scores(plan: Plan, kinds: int, term: np.ndarray, own: np.ndarray, part: np.ndarray, docs: int):
    """(item number, scores of ``docs`` documents) of each item that any of them
    scores on, from the entries (term, document, contribution)."""
    flat = np.zeros(kinds * docs, np.int64)
    np.add.at(flat, plan.kind[term] * docs + own, part)
    flat = flat.reshape(kinds, docs)
    live = np.zeros(kinds, bool)
    live[plan.kind[term]] = True
    acc: list[np.ndarray | None] = [(flat[c] if times == 1 else flat[c] * times) if live[c] else None for c, times in plan.atoms]
    for x, y in plan.pairs:
        a, b = acc[x], acc[y]
        acc.append(b if a is None else a if b is None else a + b)
    for k, (_, nodes) in enumerate(plan.items):
        some = [acc[v] for v in nodes if acc[v] is not None]
        if some:
            yield k, some[0] if len(some) == 1 else np.add.reduce(some)


def best_of_runs(rows: DataFrame, plan: Plan, weight: np.ndarray, count: int, length: int, top: int) -> DataFrame:
    """``_item, doc_id, score``: for each item the documents that are among the
    ``top`` of a run of rows and may be among the ``top`` of their task."""
    kinds = int(plan.kind.max()) + 1 if len(plan.kind) else 0
    step = int(np.clip(CELLS // max(1, kinds + plan.nodes), 64, 4096))
    names = np.array([row for row, _ in plan.items], np.int64)

    def run(batches):
        floor = np.zeros((len(names), top), np.int64)  # the best scores so far, ascending
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                # Places in a run follow the ids, so the first of equal scores has the least id.
                part = part.take(pc.sort_indices(part.column(0), null_placement="at_end"))
                per = pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
                own = np.repeat(np.arange(part.num_rows), per)
                term, tf = (part.column(k).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3))
                n = part.column(1).to_numpy(zero_copy_only=False)
                m = 75 + (25 * n * count) // length
                value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[own]))
                items, places, scores = [], [], []
                for k, s in item_scores(plan, kinds, term, own, value, part.num_rows):
                    at = np.flatnonzero(s >= max(1, floor[k, 0]))
                    if not len(at):
                        continue
                    at = at[np.argsort(-s[at], kind="stable")[:top]]
                    got = s[at]
                    floor[k] = np.sort(np.r_[floor[k], got])[-top:]
                    items.append(np.full(len(at), names[k]))
                    places.append(at)
                    scores.append(got)
                if items:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(items)), part.column(0).take(pa.array(np.concatenate(places))), pa.array(np.concatenate(scores))],
                                                     names=["_item", "doc_id", "score"])

    schema = T.StructType([T.StructField("_item", T.LongType()), rows.schema["doc_id"], T.StructField("score", T.LongType())])
    return rows.mapInArrow(run, schema)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of every item
    with a score above 0, equal scores by ascending id (null ids last).

    Null and empty texts have no terms; such items have no rows, such documents
    don't count among the corpus's.  Repeated documents are ranked each for
    itself, repeated items get their rows each; an empty table gives no rows;
    other columns are ignored.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "ranked-search")
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    asked = items.select(F.monotonically_increasing_id().alias("_item"), F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    asked = stages.write(asked, "items")
    # As few tasks as give full blocks: every block is a pass over the documents.
    letters = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    terms = stages.write(item_terms(asked.select("_item", "text").coalesce(1 + letters // (4 * block_terms)), block_terms), "terms")
    found = []
    for k, block in enumerate(sorted(terms.agg(F.collect_set("block")).first()[0])):
        rows = sorted(terms.filter(F.col("block") == block).collect(), key=lambda x: x._item)
        plan = plan_block([(x._item, [(bytes(t), n) for t, n in zip(x.terms, x.times)]) for x in rows])
        counted = stages.write(postings(src, plan.vocab), f"postings-{k}")
        stats = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        df = np.zeros(len(plan.vocab), np.int64)
        for x in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
            df[x.t] = x.df
        weight = np.array([math.floor(1000 * math.log((2 * stats.docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        some = counted.filter(F.size("terms") > 0)
        best = best_of_runs(some, plan, weight, stats.docs, stats.terms or 1, top)
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        best = best.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        best = best.withColumn("_n", F.row_number().over(Window.partitionBy("_item", "_salt").orderBy(*order))).filter(F.col("_n") <= top)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("_item").orderBy(*order))).filter(F.col("rank") <= top)
        found.append(stages.write(best.select("_item", "rank", "doc_id", "score"), f"best-{k}"))
        stages.drop(f"postings-{k}")
    if not found:
        empty = T.StructType([T.StructField("_item", T.LongType()), T.StructField("rank", T.IntegerType()), src.schema["doc_id"], T.StructField("score", T.LongType())])
        found = [spark.createDataFrame([], empty)]
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out.join(asked.select("_item", "item_id"), "_item").select("item_id", "rank", "doc_id", "score")


#: The same rows by DuckDB.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM benchmark),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
q AS (SELECT q, t, count(*) AS times FROM (SELECT q, unnest(ts) AS t FROM b) GROUP BY q, t),
p AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
w AS (SELECT t, floor(1000 * ln((2 * max(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY t),
c AS (SELECT p.r, p.t, w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.ts)::BIGINT * n_docs) // n_terms))) AS c FROM p JOIN w USING (t) JOIN d USING (r), s),
x AS (SELECT q.q, c.r, sum(q.times * c.c)::BIGINT AS score FROM q JOIN c USING (t) GROUP BY q.q, c.r),
o AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM x JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o JOIN b USING (q) WHERE rank <= {TOP}
"""
