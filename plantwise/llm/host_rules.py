"""Quality rules (operator 7): rule failures aggregated by host, shrunk by an
empirical beta prior, and host verdicts joined back to the documents.

Built-in functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantwise.llm.common import Stages, whole_rows

#: Thresholds of the document rules and of a host's verdict.
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_SYMBOL_PCT = 10
MAX_DUP_LINE_PCT = 30
MAX_HOST_RATE = 0.5

_SPACE = r"[\x20\x09-\x0D]+"


def rule_counts(df: DataFrame, text: Column) -> DataFrame:
    """Adds ``_n_words, _word_chars, _n_symbols, _n_lines, _n_dup_lines,
    _n_repeat_words`` of a text.

    Words in repeated 3-word windows: windows become 64-bit hashes with their
    places; only texts in which a hash repeats sort them, and the places beside
    an equal neighbour cover three words each.  A document is handled inside
    one row, so nothing is shuffled and work is n log n in its words.
    """
    df = df.withColumn("_t", F.coalesce(text, F.lit("")))
    df = df.withColumn("_w", F.array_remove(F.split("_t", _SPACE), ""))
    df = df.withColumn("_n_words", F.size("_w").cast("long"))
    lines = F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_lines", lines)
    df = df.withColumn("_n_symbols", (F.size(F.split("_t", r"[#*$%&|<>]", -1)) - 1).cast("long"))
    df = df.withColumn("_word_chars", F.length(F.array_join("_w", "")).cast("long"))
    df = df.withColumn("_n_lines", F.size("_lines").cast("long"))
    df = df.withColumn("_n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    none = F.array().cast("array<int>")
    df = df.withColumn("_i", F.when(F.col("_n_words") >= 3, F.sequence(F.lit(0), F.col("_n_words").cast("int") - 3)).otherwise(none))
    df = df.withColumn("_h", F.transform("_i", lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))))
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    df = df.withColumn("_s", F.when(twice, F.sort_array(F.arrays_zip("_h", "_i"))))
    same = lambda x, y: F.coalesce(x["_h"] == y["_h"], F.lit(False))
    beside = F.filter("_s", lambda x, i: same(x, F.get("_s", i - 1)) | same(x, F.get("_s", i + 1)))
    df = df.withColumn("_p", F.transform(beside, lambda x: x["_i"]))
    covered = F.concat("_p", F.transform("_p", lambda p: p + 1), F.transform("_p", lambda p: p + 2))
    df = df.withColumn("_n_repeat_words", F.coalesce(F.size(F.array_distinct(covered)), F.lit(0)).cast("long"))
    df = df.withColumn("_n_repeat_words", F.when(F.col("_p").isNull(), F.lit(0)).otherwise(F.col("_n_repeat_words")).cast("long"))
    return df.drop("_t", "_w", "_lines", "_i", "_h", "_s", "_p")


def base_failed() -> Column:
    return (F.col("_n_words") < MIN_WORDS) | (100 * F.col("_n_repeat_words") > MAX_REPEAT_PCT * F.col("_n_words"))


def any_failed() -> Column:
    """A document counts against its host if it fails the base or has too many
    symbols or repeated lines."""
    return (base_failed() | (100 * F.col("_n_symbols") > MAX_SYMBOL_PCT * F.col("_word_chars"))
            | (100 * F.col("_n_dup_lines") > MAX_DUP_LINE_PCT * F.col("_n_lines")))


def host_verdicts(digest: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``_host, host_docs, host_failed, host_rate, host_ok`` from rows of
    ``_host, _failed``.

    Hosts' failure counts are taken as binomial with beta-distributed rates.
    Mean and strength of the prior come from all hosts by moments (the
    variance between hosts beyond what sampling explains); a host with few
    documents is pulled to the corpus rate, a large one keeps its own.
    """
    hosts = digest.groupBy("_host").agg(F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("_failed").cast("long")).alias("host_failed"))
    n, k = F.col("host_docs").cast("double"), F.col("host_failed").cast("double")
    sums = hosts.agg(F.count(F.lit(1)).cast("double"), F.sum(n), F.sum(k), F.sum(k * k / n)).first()
    prior = beta_prior(*(float(x or 0) for x in sums))
    rate = (k + prior[0]) / (n + prior[0] + prior[1])
    return hosts.withColumn("host_rate", rate).withColumn("host_ok", rate <= max_rate)


def beta_prior(hosts: float, n: float, k: float, kk_n: float) -> tuple[float, float]:
    """(alpha, beta) from the number of hosts and the sums of n, k and k*k/n."""
    if n == 0:
        return 0.5, 0.5
    m = k / n
    within = m * (1 - m)
    between = max(0.0, (kk_n / n - m * m) - within * (hosts - 1) / n)
    strength = min(1e4, max(1.0, within / between - 1)) if between > 0 else 1e4
    return strength * m, strength * (1 - m)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, host_rate, kept`` of every document.

    One scan of the texts writes a digest of a few numbers a document; hosts
    are counted from it with map-side sums (a hot host costs a row a task), and
    the verdicts, one row a host, are joined back to the digest.

    Null texts have no words and fail the base; null hosts form one host; null
    ids and repeated rows are kept as rows; an empty table gives no rows; other
    columns are ignored.
    """
    stages = Stages(docs.sparkSession, "quality-rules")
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("_host"), F.col(text_col).alias("_text"))
    digest = rule_counts(src, F.col("_text")).drop("_text").withColumn("base_failed", base_failed()).withColumn("_failed", any_failed())
    digest = stages.write(digest, "digest")
    verdicts = host_verdicts(digest, max_host_rate).withColumnRenamed("_host", "_of")
    out = digest.join(verdicts, digest["_host"].eqNullSafe(verdicts["_of"]))
    return out.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_word_chars").alias("word_chars"), F.col("_n_symbols").alias("n_symbols"),
                      F.col("_n_dup_lines").alias("n_dup_lines"), F.col("_n_repeat_words").alias("n_repeat_words"), "base_failed",
                      "host_rate", (~F.col("base_failed") & F.col("host_ok")).alias("kept"))


def keep_by_rules(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The input rows, all columns, that pass the base rules and whose host
    passes.  The texts are read twice and never shuffled for the host verdict
    unless the rejected hosts are too many for a size-checked broadcast.

    Null and empty texts fail the base and go; null hosts form one host; null
    ids and repeated rows are judged like any row; an empty table stays empty.
    Rows travel as one value, so no column name clashes with a helper.
    """
    stages = Stages(docs.sparkSession, "quality-rules")
    src = docs.select(F.col(f"`{host_col}`").alias("_host"), F.col(f"`{text_col}`").alias("_text"))
    digest = rule_counts(src, F.col("_text")).drop("_text").withColumn("_failed", any_failed())
    verdicts = host_verdicts(stages.write(digest, "digest"), max_host_rate)
    rejected = stages.write(verdicts.filter(~F.col("host_ok")).select(F.col("_host").alias("_bad")), "rejected")
    stages.drop("digest")
    # The row number keeps the optimizer from moving the filter below the counts,
    # where it would repeat their expressions inside each other.
    counted = rule_counts(whole_rows(docs), F.col("_doc").getField(text_col)).withColumn("_at", F.monotonically_increasing_id())
    kept = counted.filter(~base_failed() & (F.col("_at") >= 0)).select("_doc")
    return kept.join(rejected, F.col("_doc").getField(host_col).eqNullSafe(F.col("_bad")), "left_anti").select("_doc.*")


#: The same rows by DuckDB; the constants are those above.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
tri AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS n FROM tri) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + j) AS c FROM hit, (VALUES (0), (1), (2)) AS o(j) GROUP BY r),
b AS (SELECT w.r, doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN rep ON w.r = rep.r),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM b),
g AS (SELECT *, base_failed OR 100 * n_symbols > {MAX_SYMBOL_PCT} * word_chars OR 100 * n_dup_lines > {MAX_DUP_LINE_PCT} * n_lines AS failed FROM f),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS k FROM g GROUP BY source),
s AS (SELECT count(*)::DOUBLE AS hosts, sum(n) AS n, sum(k) / sum(n) AS m, sum(k * k / n) / sum(n) AS q FROM h),
p AS (SELECT m, greatest(0, q - m * m - m * (1 - m) * (hosts - 1) / n) AS between_hosts, m * (1 - m) AS within_host FROM s),
a AS (SELECT m, CASE WHEN between_hosts > 0 THEN least(1e4, greatest(1, within_host / between_hosts - 1)) ELSE 1e4 END AS st FROM p),
v AS (SELECT source, (k + st * m) / (n + st) AS rate FROM h, a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       floor(rate * 1e6 + 0.5) / 1e6 AS host_rate, NOT base_failed AND rate <= {MAX_HOST_RATE} AS kept
FROM g JOIN v ON g.source IS NOT DISTINCT FROM v.source
"""
