"""Token counts (operator 6): lengths only, from batches balanced by bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwise.llm.common import byte_slices
from plantwise.llm.encoding import encoder, vocabulary


def token_counts(docs: DataFrame, vocab: str = "piece_bpe_32k.model", limit: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 20) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    An Arrow function returns one length per text; the ids never leave the
    task.  A task cuts its Arrow batches into slices of about ``batch_bytes``
    bytes, whatever the number of rows, and texts are split at safe boundaries
    (see :mod:`plantwise.llm.encoding`), so a very long text costs no more
    memory than many short ones.  One scan, no shuffle.

    Null texts count as empty (0 tokens), null ids are kept, repeated rows give
    repeated rows, an empty table an empty result; other columns are ignored.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField("doc_id", src.schema["doc_id"].dataType),
                           T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def lengths(batches):
        enc = encoder(vocabulary(vocab))
        for batch in batches:
            for part in byte_slices(batch, 1, batch_bytes):
                text = part.column(1)
                size = pc.binary_length(text).cast(pa.int64())
                n = enc.count(text.to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), size, pa.array(np.asarray(n, np.int64))],
                                                 names=["doc_id", "n_bytes", "n_tokens"])

    return src.mapInArrow(lengths, schema).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
