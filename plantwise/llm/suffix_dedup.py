"""Suffix dedup (operator 2) by hash grouping over anchors, in place of a
depth-limited radix sort: no suffix is ordered.

Groups are formed in passes and only to the depth of the threshold: first by
the stretch from an anchor to the next (see :mod:`plantwise.llm.repeats`, shared
with operator 1), then by the bytes that all windows of the anchor share, last
by the whole reach of its windows, then by single windows near the ends of
repeats.  What is alone in its group leaves after each pass, so later passes
shuffle only what may repeat; groups of two or more at full depth are exactly
the repeated windows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwise.llm.common import Stages, keyed_texts, whole_rows
from plantwise.llm.repeats import for_length, map_texts, merged, repeated_spans, with_spans

THRESHOLD = 400
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def repeated_bytes(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, _key, _text, spans``: every document with its repeated stretches
    as byte places."""
    stages = Stages(docs.sparkSession, "suffix-dedup")
    texts = keyed_texts(docs, id_col, text_col)
    return with_spans(texts, repeated_spans(texts, for_length(False, threshold), stages))


def without(text: bytes, first: np.ndarray, end: np.ndarray) -> bytes:
    if not len(first):
        return text
    cut = np.r_[0, np.stack([first, end], axis=1).ravel(), len(text)].tolist()
    return b"".join(text[a:b] for a, b in zip(cut[::2], cut[1::2]))


def suffix_dedup(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every
    document, without the bytes covered by a string of ``threshold`` bytes that
    also starts anywhere else; ``n_spans`` counts maximal removed runs.

    Strings are judged on the input and don't cross documents.  Null texts are
    empty; repeated rows are separate occurrences; null ids are kept; an empty
    table gives no rows; other columns are ignored.
    """
    fields = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType())]

    def row(text, first, end):
        return len(text), int((end - first).sum()), len(first), hashlib.sha256(without(text, first, end)).hexdigest()

    return map_texts(repeated_bytes(docs, threshold, id_col, text_col), row, fields)


def _byte_cuts(raw: bytes, first: np.ndarray, end: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Token spans of a text as byte spans that split no character."""
    if words:  # from the first byte of a word to that of the next word kept
        starts = np.array([m.start() for m in _WORD.finditer(raw)] + [len(raw)], np.int64)
        return starts[first], starts[end]
    lead = np.r_[(np.frombuffer(raw, np.uint8) & 0xC0) != 0x80, True]  # where characters begin
    begins = np.flatnonzero(lead)
    first = begins[np.searchsorted(begins, first)]
    end = begins[np.searchsorted(begins, end, side="right") - 1]
    some = end > first
    return first[some], end[some]


def without_repeats(docs: DataFrame, threshold: int = THRESHOLD, words: bool = False, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The input rows, all columns, without the tokens covered by a run of
    ``threshold`` tokens that also starts anywhere else.

    Tokens are bytes or, with ``words``, words between ASCII white space, which
    also finds passages whose copies are spaced otherwise.  Of bytes, a
    character goes only if all of its bytes do; words go with the white space
    after them; what stays keeps its own spacing.  ``length_col``, if there, is
    the new length in characters.  Null texts stay null, and a text that is
    wholly repeated becomes empty; repeated rows lose what they share; null ids
    are kept; an empty table stays empty.  Rows travel as one value, so no
    column name clashes with a helper.
    """
    stages = Stages(docs.sparkSession, "suffix-dedup")
    texts = keyed_texts(docs, id_col, text_col)
    spans = repeated_spans(texts, for_length(words, threshold), stages)
    spans = spans.select(F.col("_id").alias("_sid"), F.col("_key").alias("_skey"), F.col("spans").alias("_spans"))
    doc = F.col("_doc")
    own_key = F.xxhash64(F.coalesce(doc.getField(text_col), F.lit("")))
    rows = whole_rows(docs)
    joined = rows.join(spans, doc.getField(id_col).eqNullSafe(F.col("_sid")) & (own_key == F.col("_skey")), "left")

    @F.pandas_udf(T.StringType())
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(text, spans):
            if t is not None and s is not None and len(s):
                raw = t.encode()
                t = without(raw, *_byte_cuts(raw, *merged(list(s)), words)).decode()
            out.append(t)
        return pd.Series(out)

    old = doc.getField(text_col)
    joined = joined.withColumn("_new", F.when(F.col("_spans").isNull(), old).otherwise(cut(old, F.col("_spans"))))

    def column(c):
        if c == text_col:
            return F.col("_new").alias(c)
        own = doc.getField(c)
        if c != length_col:
            return own.alias(c)
        return F.when(F.col("_spans").isNull(), own).otherwise(F.length("_new")).cast(docs.schema[c].dataType).alias(c)

    return joined.select(*[column(c) for c in docs.columns])


#: The same rows of :func:`suffix_dedup` by DuckDB, window by window on the bytes' hex text.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT r, i, md5_number(substr(x, 2 * i + 1, {2 * THRESHOLD})) AS win
      FROM (SELECT r, x, unnest(range(0, length(x) // 2 - {THRESHOLD - 1})) AS i FROM d WHERE length(x) >= {2 * THRESHOLD})),
rep AS (SELECT r, i FROM w WHERE win IN (SELECT win FROM w GROUP BY win HAVING count(*) > 1)),
step AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= {THRESHOLD} THEN 0 ELSE 1 END AS fresh FROM rep),
run AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS k FROM step),
span AS (SELECT r, k, min(i) AS a, max(i) + {THRESHOLD} AS b FROM run GROUP BY r, k),
gap AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS f, a AS t FROM span
        UNION ALL SELECT span.r, max(b), any_value(length(x) // 2) FROM span JOIN d ON d.r = span.r GROUP BY span.r),
kept AS (SELECT gap.r, string_agg(substr(x, 2 * f + 1, 2 * (t - f)), '' ORDER BY f) AS x FROM gap JOIN d ON d.r = gap.r GROUP BY gap.r),
cnt AS (SELECT r, sum(b - a) AS n, count(*) AS spans FROM span GROUP BY r)
SELECT doc_id, (length(d.x) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
FROM d LEFT JOIN cnt ON cnt.r = d.r LEFT JOIN kept ON kept.r = d.r
"""
