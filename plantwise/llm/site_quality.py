"""Quality classifier (operator 5): document evidence combined with host and
path posteriors by hierarchical empirical Bayes.

Two questions are asked of a document: is it good, and is it toxic.  Evidence
is a logistic regression over words and shape marks (shares of symbols,
capitals, repeated words and so on), less the corpus' log-odds.  Sites enter as priors: the
corpus' rate is shrunk into each host's, the host's into each of its paths',
by beta priors whose strength comes from the variance between hosts and
between paths; a site with few documents keeps nearly the rate above it.  A
document's prior is its path's rate without the document itself, so its evidence
counts once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwise.llm.common import Stages, byte_slices
from plantwise.llm.host_rules import beta_prior
from plantwise.llm.wordhash import hash_words

#: Labelled rows that the regression is fitted on at most (the first in the
#: order of a hash of their ids).
FIT_ROWS = 20_000
#: Features that the model holds at most (the most significant ones), how many
#: standard errors a feature's log-odds ratio must be from zero, and in how many
#: sampled documents it must be.
MODEL_FEATURES = 50_000
MIN_Z = 3.5
MIN_DOCS = 4

#: Decision: least probability of good, and the probability of toxic from which
#: a document goes (missing a toxic one is held to cost more than losing a clean one).
MIN_GOOD = 0.5
MAX_TOXIC = 0.3

_EDGE = b".,;:!?\"'()[]{}<>|#$%&*-_"
_SYMBOL = bytes(c for c in range(128) if chr(c) in "#*$%&|<>!@^~=+\\{}")


def features(text: bytes) -> np.ndarray:
    """Distinct feature hashes of a text: its words without case and outer
    punctuation, and shape marks."""
    words = text.lower().split()
    n, size = len(words), max(1, len(text))
    kinds = {w.strip(_EDGE) for w in words}
    kinds.discard(b"")
    letters = size - len(text.translate(None, b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    capitals = size - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    symbols = size - len(text.translate(None, _SYMBOL))
    lines = [x for x in text.split(b"\n") if x.strip()]
    shape = {
        b"words": min(12, n.bit_length()),
        b"symbols": min(9, int(100 * symbols / size)),
        b"capitals": int(10 * capitals / max(1, letters)),
        b"kinds": int(10 * len(kinds) / max(1, n)),
        b"length": min(15, size // max(1, n)),
        b"lines": int(5 * len(set(lines)) / max(1, len(lines))),
    }
    return hash_words(sorted(kinds) + [b"\0%s:%d" % x for x in sorted(shape.items())])


def _labelled(labels: DataFrame, rows: int, id_col: str) -> dict:
    """Document id -> (good, toxic) of a bounded sample; labels with nulls say nothing."""
    use = labels.select(F.col(id_col).cast("long").alias("d"), F.col("quality").cast("int").alias("q"), F.col("toxic").cast("int").alias("x")).dropna()
    use = use.groupBy("d").agg(F.min("q").alias("q"), F.max("x").alias("x"))
    return {r.d: (r.q, r.x) for r in use.orderBy(F.xxhash64("d"), "d").limit(rows).collect()}


def _fit_rows(texts: DataFrame, labelled: dict) -> DataFrame:
    """``q, x, f``: labels and features of the sampled documents, whose ids (at
    most ``fit_rows``) travel to the scan."""
    sample = texts.sparkSession.createDataFrame([(d, *y) for d, y in labelled.items()], "d long, q int, x int")
    rows = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("d")).select("q", "x", "text")

    def run(batches):
        for batch in batches:
            f = [features(t).view(np.int64) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            off = pa.array(np.r_[0, np.cumsum([len(x) for x in f])], pa.int32())
            flat = pa.array(np.concatenate(f) if f else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.ListArray.from_arrays(off, flat)], names=["q", "x", "f"])

    return rows.mapInArrow(run, "q int, x int, f array<bigint>")


def _select(rows: DataFrame) -> np.ndarray:
    """Sorted features whose presence tells one of the labels apart."""
    q, x = F.col("q"), F.col("x")
    totals = rows.agg(F.sum(q), F.sum(1 - q), F.sum(x), F.sum(1 - x)).first()
    good, bad, toxic, clean = (float(v or 0) for v in totals)
    counts = rows.select("q", "x", F.explode("f").alias("f")).groupBy("f").agg(
        F.sum(q).alias("good"), F.sum(1 - q).alias("bad"), F.sum(x).alias("toxic"), F.sum(1 - x).alias("clean"))

    def z(a, b, na, nb):
        w = F.log((F.col(a) + 0.5) / (na + 1)) - F.log((F.col(b) + 0.5) / (nb + 1))
        return F.abs(w) / F.sqrt(1 / (F.col(a) + 0.5) + 1 / (F.col(b) + 0.5))

    held = counts.filter(F.col("good") + F.col("bad") >= MIN_DOCS).select("f", F.greatest(z("good", "bad", good, bad), z("toxic", "clean", toxic, clean)).alias("z"))
    best = held.filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "f").limit(MODEL_FEATURES).collect()
    return np.sort(np.array([r.f for r in best], np.int64).view(np.uint64))


def _places(f: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Places in the sorted model features of those that a document has."""
    if not len(f):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(f, x), len(f) - 1)
    return at[f[at] == x]


def _design(rows: DataFrame, f: np.ndarray):
    """Labels and model features of the bounded sample, on the driver."""
    model = rows.sparkSession.sparkContext.broadcast(f)

    def run(batches):
        for batch in batches:
            at = [_places(model.value, np.array(v, np.int64).view(np.uint64)) for v in batch.column(2).to_pylist()]
            off = pa.array(np.r_[0, np.cumsum([len(v) for v in at])], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.ListArray.from_arrays(off, pa.array(np.concatenate(at), pa.int32()))], names=["q", "x", "at"])

    got = rows.mapInArrow(run, "q int, x int, at array<int>").toArrow()
    lists = got.column("at").combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    return got.column("q").to_numpy(), got.column("x").to_numpy(), np.repeat(np.arange(len(size)), size), lists.flatten().to_numpy()


def fit_logistic(row: np.ndarray, col: np.ndarray, y: np.ndarray, n_features: int, ridge: float = 0.1, steps: int = 200) -> np.ndarray:
    """Weights and, last, intercept of a ridge logistic regression on binary
    features (pairs row, col), by accelerated steps whose lengths bound the
    curvature feature by feature."""
    n = len(y)
    row, col = np.r_[row, np.arange(n)], np.r_[col, np.full(n, n_features)]
    per_row = np.bincount(row, minlength=n)
    curve = 0.25 * np.bincount(col, weights=per_row[row].astype(float), minlength=n_features + 1)
    pull = np.r_[np.full(n_features, ridge), 1e-3]
    w = v = np.zeros(n_features + 1)
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=v[col], minlength=n), -30, 30)))
        new = v - (np.bincount(col, weights=(p - y)[row], minlength=n_features + 1) + pull * v) / (curve + pull)
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if np.dot(v - new, new - w) > 0:
            s = 1.0
        v = new + ((t - 1) / s if s > 1 else 0.0) * (new - w)
        w, t = new, s
    return w


def _evidence(texts: DataFrame, f: np.ndarray, w: np.ndarray, base: np.ndarray) -> DataFrame:
    """The rows' other columns with ``e_good`` and ``e_toxic``."""
    model = texts.sparkSession.sparkContext.broadcast((f, w, base))  # MODEL_FEATURES rows at most

    def run(batches):
        f, w, base = model.value
        for batch in batches:
            for part in byte_slices(batch, 1, 1 << 18):
                out = np.tile(base, (part.num_rows, 1))
                for k, t in enumerate(part.column(1).cast(pa.binary()).to_pylist()):
                    out[k] += w[_places(f, features(t))].sum(axis=0)
                yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[2:], pa.array(out[:, 0]), pa.array(out[:, 1])],
                                                 names=["doc_id", "host", "path", "e_good", "e_toxic"])

    fields = [texts.schema[c] for c in ("doc_id", "host", "path")]
    return texts.mapInArrow(run, T.StructType([*fields, T.StructField("e_good", T.DoubleType()), T.StructField("e_toxic", T.DoubleType())]))


def _logit(p):
    return F.log(p / (1 - p))


def _odds(x):
    return 1 / (1 + F.exp(-F.least(F.greatest(x, F.lit(-30.0)), F.lit(30.0))))


def site_posteriors(scored: DataFrame, column: str) -> DataFrame:
    """``host, path, host_rate, path_rate, left``: the posteriors from rows of
    ``host, path`` and the probability ``column``, by grouped sums, paths first
    and hosts from paths; ``left`` holds the sums and priors from which
    :func:`without_own` takes one document out again."""
    p = F.col(column)
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("pn"), F.sum(p).alias("pk"))
    hosts = paths.groupBy("host").agg(F.sum("pn").alias("hn"), F.sum("pk").alias("hk"))
    sums = hosts.agg(F.count(F.lit(1)).cast("double"), F.sum("hn"), F.sum("hk"), F.sum(F.col("hk") * F.col("hk") / F.col("hn"))).first()
    a, b = beta_prior(*(float(x or 0) for x in sums))
    sums = paths.agg(F.count(F.lit(1)).cast("double"), F.sum("pn"), F.sum("pk"), F.sum(F.col("pk") * F.col("pk") / F.col("pn"))).first()
    c, d = beta_prior(*(float(x or 0) for x in sums))
    hosts = hosts.select(F.col("host").alias("_h"), "hn", "hk", ((F.col("hk") + a) / (F.col("hn") + a + b)).alias("host_rate"))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
    left = F.struct("hn", "hk", "pn", "pk", F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c + d).alias("s"))
    return both.select("host", "path", "host_rate", ((F.col("pk") + (c + d) * F.col("host_rate")) / (F.col("pn") + c + d)).alias("path_rate"), left.alias("left"))


def without_own(left: str, own: str):
    """The path's posterior as it is without one of its documents, whose own
    probability is ``own``: a document must not vouch for itself."""
    x = lambda name: F.col(f"{left}.{name}")
    rest = lambda k: F.greatest(x(k) - F.col(own), F.lit(0.0))
    host = (rest("hk") + x("a")) / (x("hn") - 1 + x("a") + x("b"))
    return (rest("pk") + x("s") * host) / (x("pn") - 1 + x("s"))


def combine(scored: DataFrame, rates: list[float], stages: Stages) -> DataFrame:
    """``doc_id, e_good, e_toxic, host_rate, path_rate, toxic_rate, p_good,
    p_toxic`` from a written table ``doc_id, host, path, e_good, e_toxic`` of
    evidence (log-odds beyond the corpus ``rates`` of good and toxic).

    Sites are estimated from the probabilities that evidence and corpus rate
    give each document; the prior that a document's evidence is then added to
    is its path's posterior without that document.
    """
    first = scored
    for e, p, r in (("e_good", "_g", rates[0]), ("e_toxic", "_x", rates[1])):
        first = first.withColumn(p, _odds(F.col(e) + float(np.log(r / (1 - r)))))
    good = site_posteriors(first, "_g").select(F.col("host").alias("_h"), F.col("path").alias("_p"), "host_rate", "path_rate", F.col("left").alias("_good"))
    toxic = site_posteriors(first, "_x").select(F.col("host").alias("_h2"), F.col("path").alias("_p2"), F.col("path_rate").alias("toxic_rate"), F.col("left").alias("_toxic"))
    sites = good.join(toxic, F.col("_h").eqNullSafe(F.col("_h2")) & F.col("_p").eqNullSafe(F.col("_p2"))).drop("_h2", "_p2")
    sites = stages.write(sites, "sites")
    out = first.join(sites, F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")))
    out = out.withColumn("p_good", _odds(F.col("e_good") + _logit(without_own("_good", "_g"))))
    out = out.withColumn("p_toxic", _odds(F.col("e_toxic") + _logit(without_own("_toxic", "_x"))))
    return out.select("doc_id", "e_good", "e_toxic", "host_rate", "path_rate", "toxic_rate", "p_good", "p_toxic")


def site_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang",
                 label_id_col: str = "doc_id", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, e_good, e_toxic, host_rate, path_rate, toxic_rate, p_good,
    p_toxic, kept`` of every document; it is kept if it is good with at least
    ``MIN_GOOD`` and toxic with less than ``MAX_TOXIC`` probability.

    Two scans of the texts, neither shuffled: one takes the features of the
    labelled sample (its ids travel to the scan), one scores all documents.
    Sites are aggregated from the scores of *all* documents; a hot host costs a
    row a task.

    Null texts are empty; null hosts and paths are sites of their own; null ids
    are scored but never labelled; of repeated labels the least quality and the
    largest toxicity count; labels with nulls, or none at all, leave evidence
    zero and rates at one half; repeated rows are kept; an empty table gives no
    rows; other columns are ignored.  Ids are whole numbers; other types are an
    error.
    """
    stages = Stages(docs.sparkSession, "site-quality")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"))
    labelled = _labelled(labels, fit_rows, label_id_col)
    f, w, base, rates = np.zeros(0, np.uint64), np.zeros((0, 2)), np.zeros(2), [0.5, 0.5]
    rows = stages.write(_fit_rows(texts.select("doc_id", "text"), labelled), "sample") if labelled else None
    if rows is not None and not rows.isEmpty():
        f = _select(rows)
        q, x, row, col = _design(rows, f)
        rates = [(float(y.sum()) + 0.5) / (len(y) + 1) for y in (q, x)]
        fits = [fit_logistic(row, col, y, len(f)) for y in (q, x)]
        w = np.stack([v[:-1] for v in fits], axis=1)
        # Evidence is what the text says beyond the corpus rate.
        base = np.array([v[-1] - np.log(r / (1 - r)) for v, r in zip(fits, rates)])
    scored = stages.write(_evidence(texts, f, w, base), "evidence")
    out = combine(scored, rates, stages)
    stages.drop("sample")
    return out.withColumn("kept", (F.col("p_good") >= MIN_GOOD) & (F.col("p_toxic") < MAX_TOXIC))
