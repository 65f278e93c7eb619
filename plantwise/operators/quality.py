"""Data-quality rule suite: rules registry, one-row results, report.

Each rule returns a one-row DataFrame in the ``qa.results`` shape
``(rule_id, ok, message, meta, run_ts)`` built by :func:`qa_assert`.  Rules
never scan a fact row by row on the driver: they aggregate the facts per key
first (tables bounded by the key domains -- calendar days, sites, lines,
products), join those to the dimensions and fold the result to one row.

Offending-key lists hold *distinct* keys in sorted order (nulls first), so
their size is bounded by the key domain rather than by fact rows; the row
counts stay in the message.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantwise.functions.dates import day_lag, month_lag
from plantwise.functions.jsonx import json_object, key_text, percent_text
from plantwise.functions.scalars import one_row
from plantwise.operators import kpi as K
from plantwise.operators.star import Star

# Rule metadata (rule_id, description, severity, expectation),
# as registered by the source rule scripts.
RULES = [
    ("R1_COUNTS", "Tabelas possuem linhas (>0)", "ERROR", "count > 0"),
    ("R2A_FRESHNESS_COSTS", "Custos atualizados (mensal)", "WARN", "lag<=1 mês"),
    ("R2B_FRESHNESS_MANU", "Manufatura atualizada (diário)", "WARN", "lag<=3 dias"),
    ("R2C_FRESHNESS_ENERGY", "Energia atualizada (diário)", "WARN", "lag<=3 dias"),
    ("R3_DIM_KEYS_NOT_NULL", "Chaves de dimensões não nulas", "ERROR", "sem nulos"),
    ("R4_DIM_DUPLICATES", "Duplicatas nas dimensões", "ERROR", "chaves exclusivas"),
    ("R5_DOMAIN_COSTS", "Domínio custos/fx_rate", "ERROR", "valores válidos"),
    ("R6_DOMAIN_MANU", "Domínio manufatura", "ERROR", "valores válidos"),
    ("R7_DOMAIN_ENERGY", "Domínio energia", "ERROR", "valores válidos"),
    ("R8_FK_COSTS", "FK fact_costs → dim_date, dim_site", "ERROR", "date_key, site_code válidos"),
    ("R9_FK_MANU", "FK fact_manufacturing → dims", "ERROR", "todas FKs válidas"),
    ("R10_FK_ENERGY", "FK fact_energy → dims", "ERROR", "todas FKs válidas"),
    ("R11_RECON_COST_VS_PROD", "Custo total proporcional à produção", "WARN", "|Δ|/média <= 5%"),
    ("R12_RECON_COST_VS_ENERGY", "Custo total coerente com consumo energético", "WARN",
     "|Δ|/média <= 5%"),
    ("R13_KPI_VALID_RANGE", "KPIs em faixas válidas", "ERROR", "sem negativos/absurdos"),
]
# Thresholds of the rules.
MAX_MONTH_LAG = 1
MAX_DAY_LAG = 3
RECON_TOLERANCE = 0.05
KPI_MAX = 1e7
FX_MAX_ABS = 1
# Message texts of the rule results ("<name>=<count>" parts are
# joined with "; ").
MSG_SEPARATOR = "; "
MSG_MONTH_LAG = " month(s) lag"
MSG_DAY_LAG = " day(s) lag"
MSG_NULL_KEYS = ["nulls(dim_site.site_code)=", "nulls(dim_line.site_code)=",
                 "nulls(dim_line.line_code)=", "nulls(dim_product.product_code)="]
MSG_DUPLICATES = ["dup_site=", "dup_line=", "dup_prod="]
MSG_INVALID_ROWS = "rows_invalid="
RECON_MESSAGE = "Máx. desvio relativo = "
MSG_KPI_RANGE = "KPIs fora de faixa = "

RESULT_SCHEMA = "rule_id string, ok boolean, message string, meta string, run_ts timestamp"


def rules_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        RULES, "rule_id string, description string, severity string, expectation string")


def qa_assert(frame: DataFrame, rule_id: str, ok: Column, message: Column,
              meta: Column | None = None) -> DataFrame:
    """One ``qa.results`` row from a one-row frame (casts, ``[]`` default meta)."""
    meta = F.lit(None).cast("string") if meta is None else meta
    return frame.select(F.lit(rule_id).alias("rule_id"), ok.cast("boolean").alias("ok"),
                        message.cast("string").alias("message"),
                        F.coalesce(meta.cast("string"), F.lit("[]")).alias("meta"),
                        F.current_timestamp().alias("run_ts"))


def _one_row(frames: list[DataFrame]) -> DataFrame:
    """One row from several one-row aggregates (scalar subqueries)."""
    return one_row(frames[0].sparkSession, frames)


def _txt(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _joined(labels: list[str], cols: list[str]) -> Column:
    """``label1<v1>; label2<v2>; ...``."""
    parts = []
    for i, (lab, c) in enumerate(zip(labels, cols)):
        parts += ([MSG_SEPARATOR] if i else []) + [lab, _s(c)]
    return _txt(*parts)


def _sorted_keys(key: Column, include: Column) -> Column:
    """Aggregate: sorted distinct keys (nulls first) of rows where ``include``;
    null when there are none."""
    k = key.cast("string")
    vals = F.sort_array(F.collect_set(F.when(include, k)))
    has_null = F.max(F.when(include & k.isNull(), F.lit(1)).otherwise(F.lit(0))) == 1
    arr = F.when(has_null, F.concat(F.array(F.lit(None).cast("string")), vals)).otherwise(vals)
    return F.when(F.size(arr) > 0, arr)


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (_dt.date, str)):
        return F.lit(str(as_of)).cast("date")
    return as_of


# --------------------------------------------------------------- structure

def rule_counts(star: Star) -> DataFrame:
    names = ["dim_date", "dim_site", "dim_line", "dim_product",
             "fact_costs", "fact_manufacturing", "fact_energy"]
    row = _one_row([getattr(star, n).agg(F.count(F.lit(1)).alias(n)) for n in names])
    ok = reduce(lambda a, b: a & b, [F.col(n) > 0 for n in names])
    parts = []
    for i, n in enumerate(names):
        parts += ([MSG_SEPARATOR] if i else []) + [f"{n}=", _s(n)]
    return qa_assert(row, "R1_COUNTS", ok, _txt(*parts))


def _max_date(fact: DataFrame, dd: DataFrame) -> DataFrame:
    keys = fact.select("date_key").distinct()           # calendar-bounded
    return keys.join(dd.select("date_key", "date"), "date_key").agg(F.max("date").alias("max_date"))


def rule_freshness(star: Star, which: str, as_of=None) -> DataFrame:
    rid, fact, unit = {
        "costs": ("R2A_FRESHNESS_COSTS", star.fact_costs, "month"),
        "manufacturing": ("R2B_FRESHNESS_MANU", star.fact_manufacturing, "day"),
        "energy": ("R2C_FRESHNESS_ENERGY", star.fact_energy, "day"),
    }[which]
    mx = _max_date(fact, star.dim_date)
    today = _as_of(as_of)
    if unit == "month":
        lag, limit, label = month_lag("max_date", today), MAX_MONTH_LAG, MSG_MONTH_LAG
    else:
        lag, limit, label = day_lag("max_date", today), MAX_DAY_LAG, MSG_DAY_LAG
    return qa_assert(mx, rid, lag <= limit, _txt(lag.cast("string"), label),
                     json_object(max_date=F.col("max_date")))


# ---------------------------------------------------------------- dimensions

def rule_dim_keys_not_null(star: Star) -> DataFrame:
    s = star.dim_site.agg(F.count_if(F.col("site_code").isNull()).alias("a"))
    ln = star.dim_line.agg(F.count_if(F.col("site_code").isNull()).alias("b"),
                           F.count_if(F.col("line_code").isNull()).alias("c"),
                           F.count_if(F.col("site_code").isNull() | F.col("line_code").isNull())
                           .alias("e"))
    p = star.dim_product.agg(F.count_if(F.col("product_code").isNull()).alias("d"))
    row = _one_row([s, ln, p])
    ok = (F.col("a") == 0) & (F.col("e") == 0) & (F.col("d") == 0)
    msg = _joined(MSG_NULL_KEYS, ["a", "b", "c", "d"])
    return qa_assert(row, "R3_DIM_KEYS_NOT_NULL", ok, msg)


def _dups(dim: DataFrame, keys: list[str], key_expr: Column, name: str) -> DataFrame:
    d = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c")).where(F.col("__c") > 1) \
        .select(key_expr.alias("__k"))
    return d.agg(F.count(F.lit(1)).alias(f"n_{name}"),
                 _sorted_keys(F.col("__k"), F.lit(True)).alias(name))


def rule_dim_duplicates(star: Star) -> DataFrame:
    row = _one_row([
        _dups(star.dim_site, ["site_code"], F.col("site_code"), "dup_site"),
        _dups(star.dim_line, ["site_code", "line_code"], key_text("site_code", "line_code"),
              "dup_line"),
        _dups(star.dim_product, ["product_code"], F.col("product_code"), "dup_prod"),
    ])
    ok = (F.col("n_dup_site") == 0) & (F.col("n_dup_line") == 0) & (F.col("n_dup_prod") == 0)
    msg = _joined(MSG_DUPLICATES, ["n_dup_site", "n_dup_line", "n_dup_prod"])
    meta = json_object(dup_site=F.col("dup_site"), dup_line=F.col("dup_line"),
                       dup_prod=F.col("dup_prod"))
    return qa_assert(row, "R4_DIM_DUPLICATES", ok, msg, meta)


# -------------------------------------------------------------------- domains

def _neg(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)) < 0


def costs_invalid(fc: DataFrame) -> Column:
    return _neg("amount_br") | _neg("amount_fx") | (F.coalesce(F.col("fx_rate"), F.lit(0)) <= 0)


def manufacturing_invalid(fm: DataFrame) -> Column:
    return (_neg("units_ok") | _neg("units_rework") | _neg("scrap_units") | _neg("takt_time_s")
            | (F.col("oee") < 0) | (F.col("oee") > 1))


def energy_invalid(fe: DataFrame) -> Column:
    return _neg("kwh_day") | _neg("kw_demand_peak_day") | _neg("kvarh_day")


def _domain(fact: DataFrame, pred: Column, rid: str) -> DataFrame:
    row = fact.agg(F.count_if(pred).alias("c"))
    return qa_assert(row, rid, F.col("c") == 0, _txt(MSG_INVALID_ROWS, _s("c")))


def rule_domain_costs(star: Star) -> DataFrame:
    return _domain(star.fact_costs, costs_invalid(star.fact_costs), "R5_DOMAIN_COSTS")


def rule_domain_manufacturing(star: Star) -> DataFrame:
    return _domain(star.fact_manufacturing, manufacturing_invalid(star.fact_manufacturing),
                   "R6_DOMAIN_MANU")


def rule_domain_energy(star: Star) -> DataFrame:
    return _domain(star.fact_energy, energy_invalid(star.fact_energy), "R7_DOMAIN_ENERGY")


# -------------------------------------------------------- referential integrity

def orphans(fact: DataFrame, dim: DataFrame, keys: list[str], key_expr: Column,
            count_name: str, list_name: str) -> DataFrame:
    """Fact rows whose key has no dimension row (a null key never matches).

    The fact is first reduced to one row per key, so the join with the
    dimension moves key-domain-sized data whatever the fact volume.
    """
    per_key = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    hit = dim.select(*keys).distinct().withColumn("__hit", F.lit(True))
    j = per_key.join(hit, keys, "left").withColumn("__orphan", F.col("__hit").isNull())
    return j.agg(
        F.coalesce(F.sum(F.when(F.col("__orphan"), F.col("__rows"))), F.lit(0)).alias(count_name),
        _sorted_keys(key_expr, F.col("__orphan")).alias(list_name))


def _fk_rule(star: Star, fact: DataFrame, checks: list[tuple], rid: str) -> DataFrame:
    frames, names = [], []
    dims = {"date": (star.dim_date, ["date_key"], F.col("date_key").cast("string"), "bad_date_keys"),
            "site": (star.dim_site, ["site_code"], F.col("site_code"), "bad_sites"),
            "line": (star.dim_line, ["site_code", "line_code"],
                     key_text("site_code", "line_code"), "bad_lines"),
            "prod": (star.dim_product, ["product_code"], F.col("product_code"), "bad_products")}
    for key in checks:
        dim, keys, expr, lname = dims[key]
        cname = "missing_" + key
        frames.append(orphans(fact, dim, keys, expr, cname, lname))
        names.append((cname, lname))
    row = _one_row(frames)
    ok = reduce(lambda a, b: a & b, [F.col(c) == 0 for c, _ in names])
    parts = []
    for i, (c, _) in enumerate(names):
        parts += ([MSG_SEPARATOR] if i else []) + [f"{c}=", _s(c)]
    meta_fields = {}
    for _, lname in names:
        col = F.col(lname)
        if lname == "bad_date_keys":   # date keys are integers in the JSON list
            col = F.transform(col, lambda x: x.cast("int"))
        meta_fields[lname] = col
    return qa_assert(row, rid, ok, _txt(*parts), json_object(**meta_fields))


def rule_fk_costs(star: Star) -> DataFrame:
    return _fk_rule(star, star.fact_costs, ["date", "site"], "R8_FK_COSTS")


def rule_fk_manufacturing(star: Star) -> DataFrame:
    return _fk_rule(star, star.fact_manufacturing, ["date", "site", "line", "prod"], "R9_FK_MANU")


def rule_fk_energy(star: Star) -> DataFrame:
    return _fk_rule(star, star.fact_energy, ["date", "site", "line"], "R10_FK_ENERGY")


def offenders(star: Star) -> DataFrame:
    """``rule_id, list_name, k, n_rows``: every duplicate dimension key (R4) and
    every orphan key of the facts (R8-R10) as a row of its own, however many
    there are; ``n_rows``: fact rows behind an orphan, 1 for a duplicate."""
    fc, fm, fe = star.fact_costs, star.fact_manufacturing, star.fact_energy
    key = {"date": (star.dim_date, ["date_key"], F.col("date_key"), "bad_date_keys", None),
           "site": (star.dim_site, ["site_code"], F.col("site_code"), "bad_sites", "dup_site"),
           "line": (star.dim_line, ["site_code", "line_code"], key_text("site_code", "line_code"),
                    "bad_lines", "dup_line"),
           "prod": (star.dim_product, ["product_code"], F.col("product_code"), "bad_products", "dup_prod")}
    parts = []
    for dim, cols, text, _, name in key.values():
        if name:
            twice = dim.groupBy(*cols).agg(F.count(F.lit(1)).alias("__c")).where("__c > 1")
            parts.append(twice.select(F.lit("R4_DIM_DUPLICATES").alias("rule_id"), F.lit(name).alias("list_name"),
                                      text.cast("string").alias("k"), F.lit(1).cast("long").alias("n_rows")))
    for rid, fact, keys in (("R8_FK_COSTS", fc, ["date", "site"]), ("R9_FK_MANU", fm, ["date", "site", "line", "prod"]),
                            ("R10_FK_ENERGY", fe, ["date", "site", "line"])):
        for which in keys:
            dim, cols, text, name, _ = key[which]
            per_key = fact.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
            alone = per_key.join(dim.select(*cols).distinct(), cols, "left_anti")
            parts.append(alone.select(F.lit(rid).alias("rule_id"), F.lit(name).alias("list_name"),
                                      text.cast("string").alias("k"), "n_rows"))
    every = reduce(lambda a, b: a.unionByName(b), parts)
    return every.groupBy("rule_id", "list_name", "k").agg(F.sum("n_rows").alias("n_rows"))


# -------------------------------------------------------------- reconciliation

def recon_offenders(star: Star, tol: float = RECON_TOLERANCE) -> DataFrame:
    """``rule_id, y, m, site_code, rel_diff``: every month and site beyond the
    tolerance of R11 and R12 as a row of its own (the report lists them in a cell)."""
    parts = []
    for rid, other, value, total in (("R11_RECON_COST_VS_PROD", star.fact_manufacturing, "units_ok", "total_units"),
                                     ("R12_RECON_COST_VS_ENERGY", star.fact_energy, "kwh_day", "total_kwh")):
        dev = K.recon_deviation(K.recon_base(star.fact_costs, other, value, star.calendar(), total), total)
        parts.append(dev.where(F.col("rel_diff") > tol).select(F.lit(rid).alias("rule_id"), "y", "m", "site_code", "rel_diff"))
    return parts[0].unionByName(parts[1])


def _recon_row(dev: DataFrame, tol: float) -> DataFrame:
    off = F.struct("y", "m", "site_code", "rel_diff")
    return dev.agg(F.max("rel_diff").alias("mx"), F.sort_array(F.collect_list(F.when(F.col("rel_diff") > tol, off))).alias("off"))


def _recon_meta(off: Column, meta_digits: int | None) -> Column:
    def shape(x):
        r = x["rel_diff"]
        if meta_digits is not None:
            r = F.floor(r * float(10 ** meta_digits) + 0.5001) / float(10 ** meta_digits)
        return F.struct(x["site_code"].alias("site_code"), r.alias("rel_diff"))

    return F.to_json(F.transform(off, shape), {"ignoreNullFields": "false"})


def _recon_rule(dev: DataFrame, rid: str, tol: float, meta_digits: int | None) -> DataFrame:
    msg = _txt(RECON_MESSAGE, percent_text("mx"))
    return qa_assert(_recon_row(dev, tol), rid, F.col("mx") <= tol, msg, _recon_meta(F.col("off"), meta_digits))


def rule_recon_cost_vs_production(star: Star, tol: float = RECON_TOLERANCE,
                                  meta_digits: int | None = None) -> DataFrame:
    base = K.recon_base(star.fact_costs, star.fact_manufacturing, "units_ok", star.calendar(),
                        "total_units")
    return _recon_rule(K.recon_deviation(base, "total_units"), "R11_RECON_COST_VS_PROD", tol,
                       meta_digits)


def rule_recon_cost_vs_energy(star: Star, tol: float = RECON_TOLERANCE,
                              meta_digits: int | None = None) -> DataFrame:
    base = K.recon_base(star.fact_costs, star.fact_energy, "kwh_day", star.calendar(), "total_kwh")
    return _recon_rule(K.recon_deviation(base, "total_kwh"), "R12_RECON_COST_VS_ENERGY", tol,
                       meta_digits)


def kpis(star: Star) -> dict[str, DataFrame]:
    return {
        "kpi_cost_per_unit": K.kpi_cost_per_unit(star.fact_costs, star.fact_manufacturing,
                                                 star.calendar()),
        "kpi_energy_per_unit": K.kpi_energy_per_unit(star.fact_energy, star.fact_manufacturing,
                                                     star.calendar()),
        "kpi_fx_effect": K.kpi_fx_effect(star.fact_costs),
    }


def rule_kpi_range(star: Star, kpi_frames: dict[str, DataFrame] | None = None) -> DataFrame:
    k = kpi_frames or kpis(star)
    c = k["kpi_cost_per_unit"].agg(F.count_if((F.col("cost_per_unit") < 0)
                                              | (F.col("cost_per_unit") > KPI_MAX)).alias("c1"))
    e = k["kpi_energy_per_unit"].agg(F.count_if((F.col("kwh_per_unit") < 0)
                                                | (F.col("kwh_per_unit") > KPI_MAX)).alias("c2"))
    f = k["kpi_fx_effect"].agg(F.count_if(F.abs("fx_effect_ratio") > FX_MAX_ABS).alias("c3"))
    row = _one_row([c, e, f]).select((F.col("c1") + F.col("c2") + F.col("c3")).alias("c"))
    return qa_assert(row, "R13_KPI_VALID_RANGE", F.col("c") == 0,
                     _txt(MSG_KPI_RANGE, _s("c")))


# ------------------------------------------------------------------ the suite

def run_rules(star: Star, as_of=None, meta_digits: int | None = None,
              kpi_frames: dict[str, DataFrame] | None = None) -> DataFrame:
    """All rules R1..R13 (15 rows) in registration order."""
    parts = [
        rule_counts(star),
        rule_freshness(star, "costs", as_of), rule_freshness(star, "manufacturing", as_of),
        rule_freshness(star, "energy", as_of),
        rule_dim_keys_not_null(star), rule_dim_duplicates(star),
        rule_domain_costs(star), rule_domain_manufacturing(star), rule_domain_energy(star),
        rule_fk_costs(star), rule_fk_manufacturing(star), rule_fk_energy(star),
        rule_recon_cost_vs_production(star, meta_digits=meta_digits),
        rule_recon_cost_vs_energy(star, meta_digits=meta_digits),
        rule_kpi_range(star, kpi_frames),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def report(rules: DataFrame, results: DataFrame) -> DataFrame:
    """rules LEFT JOIN results, newest first (the exported QA report)."""
    return (rules.join(results, "rule_id", "left")
            .select("rule_id", "description", "severity", "ok", "message", "meta", "run_ts")
            .orderBy(F.desc_nulls_last("run_ts"), "rule_id"))


def latest_results(results: DataFrame) -> DataFrame:
    """Keep only each rule's newest row (results are appended per run; of runs
    with equal stamps the one with the greater run id)."""
    order = ["run_ts"] + (["run_id"] if "run_id" in results.columns else [])
    newest = results.groupBy("rule_id").agg(F.max(F.struct(*order)).alias("__newest"))
    return (results.join(newest, "rule_id")
            .where(F.struct(*order).eqNullSafe(F.col("__newest"))).drop("__newest"))


def errors_view(results: DataFrame, rules: DataFrame, prefixes=("R8", "R9", "R10")) -> DataFrame:
    """results JOIN rules, optionally only some rule families, newest first,
    severity descending (the dashboard's integrity listing)."""
    j = results.join(rules, "rule_id")
    if prefixes:
        j = j.where(reduce(lambda a, b: a | b,
                           [F.col("rule_id").startswith(p + "_") for p in prefixes]))
    return j.orderBy(F.desc("run_ts"), F.desc("severity"))


def scoreboard(results: DataFrame) -> DataFrame:
    """Rules run, passed and failed (a null verdict counts in neither)."""
    return results.agg(F.count(F.lit(1)).alias("rules_run"),
                       F.count_if(F.col("ok")).alias("rules_ok"),
                       F.count_if(~F.col("ok")).alias("rules_not_ok"))


def failed_errors(results: DataFrame, rules: DataFrame) -> DataFrame:
    """ERROR-severity rules that did not pass (input to a fail-the-run gate)."""
    return results.join(rules, "rule_id").where(
        (F.col("severity") == "ERROR") & ~F.coalesce(F.col("ok"), F.lit(False)))


def energy_silver_check(df: DataFrame) -> DataFrame:
    """ETL-time check on silver energy: kwh present and non-negative.
    One-row frame ``(kwh_nulls, kwh_negative, success)``."""
    if "kwh" not in df.columns:
        return df.sparkSession.range(1).select(F.lit(0).alias("kwh_nulls"),
                                               F.lit(0).alias("kwh_negative"),
                                               F.lit(True).alias("success"))
    return df.agg(F.count_if(F.col("kwh").isNull()).alias("kwh_nulls"),
                  F.count_if(F.col("kwh") < 0).alias("kwh_negative")) \
        .withColumn("success", (F.col("kwh_nulls") == 0) & (F.col("kwh_negative") == 0))


# ------------------------------------------------- one-scan suite over key tables

# The kinds of keys that each fact is reduced to.
KEY_SETS = {"pair": ["date_key", "site_code"], "line": ["site_code", "line_code"], "prod": ["product_code"]}
_SETS_OF = {"costs": ["pair"], "manufacturing": ["pair", "line", "prod"], "energy": ["pair", "line"]}


def _reduced(fact: DataFrame, kinds: list[str], *aggs: Column) -> DataFrame:
    """``kind``, the key columns and ``aggs`` of every key of each kind: one scan,
    one shuffle of at most a row a key and task."""
    cols = list(dict.fromkeys(c for k in kinds for c in KEY_SETS[k]))
    # A key of the fact may be null, so the kind is told by the columns left out.
    left_out = {k: sum(1 << i for i, c in enumerate(reversed(cols)) if c not in KEY_SETS[k]) for k in kinds}
    kind = reduce(lambda x, k: x.when(F.col("__id") == left_out[k], k), kinds, F)
    out = fact.groupingSets([[F.col(c) for c in KEY_SETS[k]] for k in kinds], *[F.col(c) for c in cols])
    return out.agg(F.grouping_id().alias("__id"), *aggs).withColumn("kind", kind).drop("__id")


def fact_key_tables(star: Star, materialized: bool = True) -> dict[str, DataFrame]:
    """Each fact reduced once to the keys of its kinds (:data:`KEY_SETS`) with the
    row count ``n``, the invalid-row count ``bad`` and the sums the rules need.

    Every rule, dimension and KPI of the suite is derived from these tables,
    so a run scans each fact exactly once.  Their rows are the *sum* of the
    kinds' domains (days x sites, lines, products); no rule asks for a
    combination of all columns, of which there are about as many as fact rows.
    They are materialised so later stages never re-read the facts.
    """
    from plantwise.functions.materialize import materialize_all
    one = F.count(F.lit(1)).alias("n")
    fc, fm, fe = star.fact_costs, star.fact_manufacturing, star.fact_energy
    out = {
        "costs": _reduced(
            fc, _SETS_OF["costs"], one, F.count_if(costs_invalid(fc)).alias("bad"), F.sum("amount_br").alias("s"),
            F.sum(F.col("amount_br").cast("double") - F.col("amount_fx") * F.col("fx_rate"))
            .alias("s_fx")),
        "manufacturing": _reduced(
            fm, _SETS_OF["manufacturing"], one, F.count_if(manufacturing_invalid(fm)).alias("bad"), F.sum("units_ok").alias("s")),
        "energy": _reduced(
            fe, _SETS_OF["energy"], one, F.count_if(energy_invalid(fe)).alias("bad"), F.sum("kwh_day").alias("s")),
    }
    if materialized:
        out = materialize_all(out)
    return out


def of_kind(keys: dict[str, DataFrame], kind: str) -> dict[str, DataFrame]:
    """The rows of one kind of each key table that has it."""
    return {name: df.where(F.col("kind") == kind).drop("kind") for name, df in keys.items() if kind in _SETS_OF[name]}


def dims_from_keys(keys: dict[str, DataFrame]) -> Star:
    """The four dimensions from the key tables (same rows as from the facts);
    facts are left as the key tables themselves."""
    from plantwise.operators import star as S
    c, m, e = (of_kind(keys, "pair")[name] for name in _FACTS)
    lines = of_kind(keys, "line")
    return Star(keys["costs"], keys["manufacturing"], keys["energy"], S.dim_site(c, m, e), S.dim_line(lines["manufacturing"], lines["energy"]),
                S.dim_product(of_kind(keys, "prod")["manufacturing"]), S.dim_date(c, m, e), derived=True)


def _results(row: DataFrame, rules: list[tuple]) -> DataFrame:
    """One ``qa.results`` row a rule ``(rule_id, ok, message, meta)`` from one
    row that holds what all of them need."""
    one = [F.struct(F.lit(rid).alias("rule_id"), ok.cast("boolean").alias("ok"), message.cast("string").alias("message"),
                    (F.lit("[]") if meta is None else F.coalesce(meta.cast("string"), F.lit("[]"))).alias("meta"))
           for rid, ok, message, meta in rules]
    return row.select(F.explode(F.array(*one)).alias("r")).select("r.*", F.current_timestamp().alias("run_ts"))


_FACTS = {"costs": "c", "manufacturing": "m", "energy": "e"}
_OF_KIND = {"pair": ["date", "site"], "line": ["line"], "prod": ["prod"]}
_WHICH = {"costs": ["date", "site"], "manufacturing": ["date", "site", "line", "prod"], "energy": ["date", "site", "line"]}
_KEY_OF = {"date": ["date_key"], "site": ["site_code"], "line": ["site_code", "line_code"], "prod": ["product_code"]}


def key_ledger(keys: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """``which, k1, k2``: every key that a fact or a dimension holds, tagged with
    its kind, with the dimension rows ``dim_n`` (of dates also ``day``) and, per
    fact, rows ``n_*`` and invalid rows ``bad_*`` behind it.

    Facts and dimensions meet in one grouped union, so every table is read once
    and one shuffle answers what the rules ask of any of them.
    """
    none = F.lit(None)

    def tagged(which):
        cols = [F.col(c).cast("string") for c in _KEY_OF[which]] + [none.cast("string")]
        return F.struct(F.lit(which).alias("which"), cols[0].alias("k1"), cols[1].alias("k2"))

    def wide(df, dim_n, day, **own):
        cells = [own.get(f"{x}_{t}", F.lit(0).cast("long")).alias(f"{x}_{t}") for x in ("n", "bad") for t in _FACTS.values()]
        return df.select("g.*", dim_n.cast("long").alias("dim_n"), day.cast("date").alias("day"), *cells)

    parts = []
    for name, t in _FACTS.items():
        tags = reduce(lambda x, k: x.when(F.col("kind") == k, F.array(*[tagged(w) for w in _OF_KIND[k]])), _SETS_OF[name], F)
        f = keys[name].select(F.explode(tags).alias("g"), "n", "bad")
        parts.append(wide(f, F.lit(0), none, **{f"n_{t}": F.col("n"), f"bad_{t}": F.col("bad")}))
    for which, dim in dims.items():
        day = [F.col("date").alias("day")] if which == "date" else []
        parts.append(wide(dim.select(tagged(which).alias("g"), *day), F.lit(1), F.col("day") if day else none))
    both = reduce(lambda a, b: a.unionByName(b), parts)
    sums = [c for c in both.columns if c not in ("which", "k1", "k2", "day")]
    return both.groupBy("which", "k1", "k2").agg(F.max("day").alias("day"), *[F.sum(c).alias(c) for c in sums])


def _ledger_row(ledger: DataFrame) -> DataFrame:
    """What R1 to R10 need, as one row."""
    of = lambda which: F.col("which") == which
    total = lambda cond, c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0).cast("long"))
    broken = F.col("k1").isNull() | (of("line") & F.col("k2").isNull())
    orphan = (F.col("dim_n") == 0) | broken
    text = F.when(of("line"), key_text("k1", "k2")).otherwise(F.col("k1"))
    out = [total(of(w), "dim_n").alias(f"rows_{w}") for w in _KEY_OF]
    for t in _FACTS.values():
        held = F.col(f"n_{t}") > 0
        out += [total(of("date"), f"n_{t}").alias(f"rows_{t}"), total(of("date"), f"bad_{t}").alias(f"bad_{t}"),
                F.max(F.when(of("date") & held & ~orphan, F.col("day"))).alias(f"newest_{t}")]
    for name, t in _FACTS.items():
        for w in _WHICH[name]:
            bad = of(w) & orphan & (F.col(f"n_{t}") > 0)
            out += [total(bad, f"n_{t}").alias(f"missing_{t}_{w}"), _sorted_keys(text, bad).alias(f"keys_{t}_{w}")]
    for w in ("site", "line", "prod"):
        twice = of(w) & (F.col("dim_n") > 1)
        out += [F.count_if(twice).alias(f"twice_{w}"), _sorted_keys(text, twice).alias(f"twice_keys_{w}"),
                total(of(w) & F.col("k1").isNull(), "dim_n").alias(f"null1_{w}"),
                total(of(w) & F.col("k2").isNull(), "dim_n").alias(f"null2_{w}"), total(of(w) & broken, "dim_n").alias(f"broken_{w}")]
    return ledger.agg(*out)


def pair_sums(keys: dict[str, DataFrame]) -> DataFrame:
    """Per (date_key, site): sum and row count of each fact and the FX sum, from
    one grouped union of the key tables; what a fact lacks is null."""
    parts = []
    pair = of_kind(keys, "pair")
    for name, t in _FACTS.items():
        cols = [F.col("s").alias(f"s_{t}"), F.col("n").alias(f"n_{t}"), *([F.col("s_fx")] if t == "c" else [])]
        parts.append(pair[name].select("date_key", "site_code", *cols))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.groupBy("date_key", "site_code").agg(*[F.sum(c).alias(c) for c in both.columns[2:]])


def _fanned(pairs: DataFrame, dd: DataFrame) -> DataFrame:
    """The fan-out pair sums of cost and units (``cm``), cost and energy (``ce``)
    and energy and units (``em``) per (date_key, site) of the calendar."""
    j = pairs.join(dd.select("date_key", "y", "m"), "date_key")
    out = []
    for a, b in ("cm", "ce", "em"):
        here = F.col(f"n_{a}") > 0
        other = lambda c: F.when(F.col("site_code").isNotNull(), F.col(c))  # noqa: E731  a null site matches nothing
        n, v = other(f"n_{b}"), other(f"s_{b}")
        out += [F.when(here, F.col(f"s_{a}") * F.greatest(F.coalesce(n, F.lit(0)), F.lit(1))).alias(f"{a}{b}_l"),
                F.when(here, F.col(f"n_{a}") * v).alias(f"{a}{b}_r")]
    return j.select("date_key", "y", "m", "site_code", *out)


def run_suite(star: Star, as_of=None, meta_digits: int | None = None,
              materialized: bool = True, keys: dict[str, DataFrame] | None = None) -> DataFrame:
    """The 15 results of R1..R13 with one scan per fact (see
    :func:`fact_key_tables`); same rows as :func:`run_rules`.

    The facts are judged against the star's own dimensions and calendar; only
    a star whose dimensions were derived from its facts (``build_star``) has
    them rebuilt from the key tables, which gives the same rows.  ``keys``: the
    star's :func:`fact_key_tables`, where they are there already."""
    from plantwise.functions.materialize import materialize, materialize_all
    keys = keys or fact_key_tables(star, materialized)
    ks = dims_from_keys(keys) if star.derived else star
    dims = {"date": ks.dim_date, "site": ks.dim_site, "line": ks.dim_line, "prod": ks.dim_product}
    pairs = pair_sums(keys)
    if materialized:   # independent of each other: concurrent jobs
        small = materialize_all({**dims, "pairs": pairs})
        pairs = small.pop("pairs")
        dims = small
    fanned = _fanned(pairs, dims["date"])
    months = fanned.groupBy("y", "m", "site_code").agg(*[F.sum(c).cast("double").alias(c) for c in ("cm_l", "cm_r", "ce_l", "ce_r")])
    if materialized:
        months = materialize(months, "months")

    frames = [_ledger_row(key_ledger(keys, dims))]
    for p, total in (("cm", "total_units"), ("ce", "total_kwh")):
        base = months.select("y", "m", "site_code", F.col(f"{p}_l").alias("total_cost_brl"), F.col(f"{p}_r").alias(total)).where(F.col(total) > 0)
        frames.append(_recon_row(K.recon_deviation(base, total), RECON_TOLERANCE).select(F.col("mx").alias(f"mx_{p}"), F.col("off").alias(f"off_{p}")))
    far = lambda a, b: (K._dratio(a, b) < 0) | (K._dratio(a, b) > KPI_MAX)
    frames.append(fanned.agg(F.count_if(far("cm_l", "cm_r")).alias("far_c"), F.count_if(far("em_l", "em_r")).alias("far_e")))
    frames.append(pairs.where("n_c > 0").agg(F.count_if(F.abs(K._dratio("s_fx", "s_c")) > FX_MAX_ABS).alias("far_f")))
    # One row of all of them: a union and a first value a column, since each field
    # taken from a scalar subquery would plan that subquery anew.
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    row = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])
    if materialized:
        row = materialize(row, "suite")

    none = lambda *names: reduce(lambda a, b: a & b, [F.col(n) == 0 for n in names])
    counts = {"dim_date": "rows_date", "dim_site": "rows_site", "dim_line": "rows_line", "dim_product": "rows_prod",
              "fact_costs": "rows_c", "fact_manufacturing": "rows_m", "fact_energy": "rows_e"}
    rules = [("R1_COUNTS", reduce(lambda a, b: a & b, [F.col(c) > 0 for c in counts.values()]),
              _joined([f"{n}=" for n in counts], list(counts.values())), None)]
    today = _as_of(as_of)
    for rid, t, lag_of, limit, label in (("R2A_FRESHNESS_COSTS", "c", month_lag, MAX_MONTH_LAG, MSG_MONTH_LAG),
                                         ("R2B_FRESHNESS_MANU", "m", day_lag, MAX_DAY_LAG, MSG_DAY_LAG),
                                         ("R2C_FRESHNESS_ENERGY", "e", day_lag, MAX_DAY_LAG, MSG_DAY_LAG)):
        lag = lag_of(f"newest_{t}", today)
        rules.append((rid, lag <= limit, _txt(lag.cast("string"), label), json_object(max_date=F.col(f"newest_{t}"))))
    rules.append(("R3_DIM_KEYS_NOT_NULL", none("null1_site", "broken_line", "null1_prod"),
                  _joined(MSG_NULL_KEYS, ["null1_site", "null1_line", "null2_line", "null1_prod"]), None))
    rules.append(("R4_DIM_DUPLICATES", none("twice_site", "twice_line", "twice_prod"), _joined(MSG_DUPLICATES, ["twice_site", "twice_line", "twice_prod"]),
                  json_object(dup_site=F.col("twice_keys_site"), dup_line=F.col("twice_keys_line"), dup_prod=F.col("twice_keys_prod"))))
    for rid, t in (("R5_DOMAIN_COSTS", "c"), ("R6_DOMAIN_MANU", "m"), ("R7_DOMAIN_ENERGY", "e")):
        rules.append((rid, none(f"bad_{t}"), _txt(MSG_INVALID_ROWS, _s(f"bad_{t}")), None))
    lists = {"date": "bad_date_keys", "site": "bad_sites", "line": "bad_lines", "prod": "bad_products"}
    for rid, name in (("R8_FK_COSTS", "costs"), ("R9_FK_MANU", "manufacturing"), ("R10_FK_ENERGY", "energy")):
        t, which = _FACTS[name], _WHICH[name]
        found = {lists[w]: F.transform(F.col(f"keys_{t}_{w}"), lambda x: x.cast("int")) if w == "date" else F.col(f"keys_{t}_{w}") for w in which}
        rules.append((rid, none(*[f"missing_{t}_{w}" for w in which]), _joined([f"missing_{w}=" for w in which], [f"missing_{t}_{w}" for w in which]),
                      json_object(**found)))
    for rid, p in (("R11_RECON_COST_VS_PROD", "cm"), ("R12_RECON_COST_VS_ENERGY", "ce")):
        rules.append((rid, F.col(f"mx_{p}") <= RECON_TOLERANCE, _txt(RECON_MESSAGE, percent_text(f"mx_{p}")), _recon_meta(F.col(f"off_{p}"), meta_digits)))
    far_all = F.col("far_c") + F.col("far_e") + F.col("far_f")
    rules.append(("R13_KPI_VALID_RANGE", far_all == 0, _txt(MSG_KPI_RANGE, far_all.cast("string")), None))
    return _results(row, rules)
