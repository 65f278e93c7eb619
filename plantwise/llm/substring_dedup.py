"""Substring dedup (operator 1) by De Bruijn compaction.

Token k-mers that documents share are found in a De Bruijn graph whose nodes
are anchors and whose edges are the word stretches between them (see
:mod:`plantwise.llm.repeats`).  Repeated paths that don't branch are compacted:
joints with one way out and one way in are found by joins, and a whole path
settles its windows at once.  Across branches, source coordinates (document and
place) verify the long repeated spans.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plantwise.llm.common import Stages, keyed_texts
from plantwise.llm.repeats import for_length, map_texts, repeated_spans, with_spans

WINDOW = 35


def repeated_words(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, _key, _text, spans``: every document with its repeated stretches
    as word places."""
    stages = Stages(docs.sparkSession, "substring-dedup")
    texts = keyed_texts(docs, id_col, text_col)
    return with_spans(texts, repeated_spans(texts, for_length(True, window), stages, paths=True))


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and ``kept``) of every
    document, without the words covered by a window of ``window`` words that
    also starts anywhere else.

    All windows are judged on the input.  Texts are split at ASCII white
    space; null and empty texts have no words; texts shorter than a window lose
    nothing; repeated rows are separate occurrences, so all their windows
    repeat; null ids are kept; an empty table gives no rows; other columns are
    ignored.
    """
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    if with_text:
        fields.append(T.StructField("kept", T.StringType()))

    def row(text, first, end):
        words = text.split()
        n = len(words)
        if len(first):
            gone = int((end - first).sum())
            cut = np.r_[0, np.stack([first, end], axis=1).ravel(), n].tolist()
            words = [w for a, b in zip(cut[::2], cut[1::2]) for w in words[a:b]]
        else:
            gone = 0
        kept = b" ".join(words)
        out = (n, gone, hashlib.sha256(kept).hexdigest())
        return (*out, kept.decode()) if with_text else out

    return map_texts(repeated_words(docs, window, id_col, text_col), row, fields)


#: The same rows by DuckDB, window by window.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT r, i, sha256(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS win FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d WHERE len(ws) >= {WINDOW})),
rep AS (SELECT r, i FROM w WHERE win IN (SELECT win FROM w GROUP BY win HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM rep)),
words AS (SELECT r, p, ws[p] AS word FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS p FROM d)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (r, p) GROUP BY r),
cnt AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN cnt USING (r) LEFT JOIN kept USING (r)
"""
