"""Registry of checked queries: a Spark query and its DuckDB oracle SQL.

Every query reads the given tables (through the fixtures) over whole tables.
Doubles are rounded to 6 decimals on both sides so float summation order
cannot break the value hash.  Keys name the operator; SURVEY ids are in the
docstrings and in the README.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from classbench.functions import scalar as S
from classbench.operators import compare, curves, encode, importance, inspect, metrics, profile, split
from classbench.session import new_scratch_path, written
from classbench.sources import fixtures as FX
from classbench.sources import io
from classbench.sources.fixtures import with_fixtures as W
from classbench.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    """Round every floating column to 6 decimals (oracle comparisons)."""
    return df.select(*[F.round(F.col(f"`{f.name}`").cast("double"), 6).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


F1_COLS = ["id", "priority", "status", "segment", "nation", "balance", "total", "Churn"]
F1_TYPES = {"id": "bigint", "priority": "string", "status": "string", "segment": "string",
            "nation": "int", "balance": "double", "total": "double", "Churn": "boolean"}
LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax"]


def _union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- sources

@query("csv_scan", W("""SELECT id, priority, status, segment, nation, round(balance, 6) AS balance,
       round(total, 6) AS total, Churn FROM f1""", "f1"))
def q_csv_scan(spark, sf):
    """F1 written as CSV with a header to the scratch folder, read back with a schema."""
    path = new_scratch_path(spark, "csv_scan")
    FX.orders_churn(spark, sf).write.option("header", True).csv(path)
    schema = ", ".join(f"`{c}` {F1_TYPES[c]}" for c in F1_COLS)
    return r6(io.read_csv(spark, path, schema=schema))


_PIX = ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS pixel_{i}" for i in range(64))


@query("image_table", f"SELECT vec_id AS id, {_PIX}, label AS target FROM embeddings")
def q_image_table(spark, sf):
    """S2 + P8-P10: 8x8 images reshaped, flattened back and expanded to pixel_i columns."""
    e = FX.vectors(spark, sf)
    flat = S.flatten_image(S.reshape_square("embedding", 64))
    return r6(e.select(F.col("vec_id").alias("id"), flat.alias("px"), F.col("label").alias("target"))
              .select("id", *S.expand_array("px", 64), "target"))


@query("report_sink", W(_union_sql([
    "SELECT 'n_rows' AS field, CAST(count(*) AS VARCHAR) AS Value FROM f1",
    "SELECT 'n_features' AS field, '7' AS Value",
    "SELECT 'n_positive' AS field, CAST(sum(CAST(Churn AS INTEGER)) AS VARCHAR) AS Value FROM f1",
    "SELECT 'positive_rate' AS field, printf('%.4f', round(sum(CAST(Churn AS INTEGER)) * 100.0 / count(*), 4)) AS Value FROM f1",
]), "f1"))
def q_report_sink(spark, sf):
    """One-row summary transposed to (field, Value) text and written as CSV."""
    f1 = FX.orders_churn(spark, sf)
    one = f1.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("Churn").cast("int")).alias("n_pos"))
    summary = one.select(
        F.col("n_rows").cast("string").alias("n_rows"), F.lit("7").alias("n_features"),
        F.col("n_pos").cast("string").alias("n_positive"),
        S.fmt_fixed(F.col("n_pos") * 100.0 / F.col("n_rows"), 4).alias("positive_rate"))
    return io.report_sink(summary, new_scratch_path(spark, "report"))


# ---------------------------------------------------------------- profiling

@query("shape", W("SELECT count(*) AS n_rows, 8 AS n_columns FROM f1", "f1"))
def q_shape(spark, sf):
    """A1."""
    return profile.shape(FX.orders_churn(spark, sf))


@query("schema_profile", W(_union_sql([
    f"SELECT {i} AS position, '{c}' AS name, '{F1_TYPES[c]}' AS dtype, count({c}) AS non_null FROM f1"
    for i, c in enumerate(F1_COLS)]), "f1"))
def q_schema_profile(spark, sf):
    """A2."""
    return profile.schema_profile(FX.orders_churn(spark, sf))


@query("missing_total", W("SELECT CAST(" + " + ".join(f"count_if({c} IS NULL)" for c in F1_COLS)
                          + " AS BIGINT) AS missing FROM f1", "f1"))
def q_missing_total(spark, sf):
    """A3."""
    return profile.missing_total(FX.orders_churn(spark, sf))


_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("missing_by_column", _union_sql([
    f"SELECT {i} AS position, '{c}' AS name, CAST(count_if({c} IS NULL) AS BIGINT) AS missing FROM lineitem"
    for i, c in enumerate(_LI_COLS)]))
def q_missing_by_column(spark, sf):
    """A4 on lineitem (profiling only)."""
    return profile.missing_by_column(table(spark, sf, "lineitem"))


@query("value_counts", W("SELECT segment AS value, count(*) AS count FROM f1 "
                         "WHERE segment IS NOT NULL GROUP BY segment", "f1"))
def q_value_counts(spark, sf):
    """A5."""
    return profile.value_counts(FX.orders_churn(spark, sf), "segment")


@query("value_counts_sorted", W("SELECT priority AS value, count(*) AS count FROM f1 "
                                "WHERE priority IS NOT NULL GROUP BY priority", "f1"))
def q_value_counts_sorted(spark, sf):
    """A6."""
    return profile.value_counts(FX.orders_churn(spark, sf), "priority", order="value")


@query("class_share", W("""SELECT Churn AS value, count(*) AS count,
       round(CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE), 1) AS percent
FROM f1 WHERE Churn IS NOT NULL GROUP BY Churn""", "f1"))
def q_class_share(spark, sf):
    """A7."""
    return profile.class_share(FX.orders_churn(spark, sf), "Churn")


@query("positive_rate", W("SELECT round(CAST(sum(CAST(Churn AS INTEGER)) AS DOUBLE) * 100.0 / count(*), 6) "
                          "AS positive_rate FROM f1", "f1"))
def q_positive_rate(spark, sf):
    """A8."""
    return r6(profile.positive_rate(FX.orders_churn(spark, sf), "Churn"))


@query("distinct_classes", "SELECT count(DISTINCT label) AS n_classes FROM embeddings")
def q_distinct_classes(spark, sf):
    """A9."""
    return profile.distinct_classes(FX.vectors(spark, sf), "label")


def _describe_sql(tbl: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS name, count({x}) AS count, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, "
            f"round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS q50, "
            f"round(quantile_cont({x}, 0.75), 6) AS q75, round(max({x}), 6) AS max FROM {tbl}")
    return _union_sql(parts)


@query("describe", _describe_sql("lineitem", LINEITEM_NUMERIC))
def q_describe(spark, sf):
    """A10 on lineitem's numeric columns: exact quantiles by range narrowing."""
    return r6(profile.describe(table(spark, sf, "lineitem"), LINEITEM_NUMERIC))


def _hist_sql(src: str, col: str, bins: int, group: str | None = None) -> str:
    gsel = f"{group}, " if group else ""
    grid = (f"SELECT DISTINCT {group}, CAST(unnest(range(1, {bins + 1})) AS INTEGER) AS bin FROM {src}"
            if group else f"SELECT CAST(range AS INTEGER) AS bin FROM range(1, {bins + 1})")
    using = f"{group}, bin" if group else "bin"
    return f"""WITH e AS (SELECT min(CAST({col} AS DOUBLE)) AS lo0, max(CAST({col} AS DOUBLE)) AS hi0 FROM {src}),
b AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM e),
c AS (SELECT {gsel}least({bins}, CAST(floor((CAST({col} AS DOUBLE) - lo) / (hi - lo) * {bins}) AS INTEGER) + 1) AS bin,
             count(*) AS n
      FROM {src}, b WHERE {col} IS NOT NULL GROUP BY ALL),
g AS ({grid})
SELECT {gsel}g.bin, round(lo + (g.bin - 1) * ((hi - lo) / {bins}), 6) AS lo,
       round(lo + g.bin * ((hi - lo) / {bins}), 6) AS hi, coalesce(n, 0) AS count
FROM g CROSS JOIN b LEFT JOIN c USING ({using})"""


@query("histogram", W(_hist_sql("f1", "total", 30), "f1"))
def q_histogram(spark, sf):
    """30 equal-width bins of the order total, empty bins kept."""
    return r6(profile.histogram(FX.orders_churn(spark, sf), "total", 30))


@query("histogram_by_class", W(_hist_sql("f1", "total", 20, "Churn"), "f1"))
def q_histogram_by_class(spark, sf):
    """Per-class histogram on shared edges."""
    return r6(profile.histogram(FX.orders_churn(spark, sf), "total", 20, group="Churn"))


# ---------------------------------------------------------------- scalar functions

@query("feature_columns", W("SELECT id, priority, status, segment, nation, round(balance, 6) AS balance, "
                            "round(total, 6) AS total FROM f1", "f1"))
def q_feature_columns(spark, sf):
    """Drop the target."""
    return r6(FX.orders_churn(spark, sf).drop("Churn"))


@query("target_lookup", W("""SELECT id, CAST(Churn AS INTEGER) AS bool_code,
       CASE WHEN status = 'P' THEN NULL WHEN Churn THEN 1 ELSE 0 END AS text_code FROM f1""", "f1"))
def q_target_lookup(spark, sf):
    """P2 + P3: boolean target to 0/1; text target by lookup, unknown text to null."""
    from pyspark.sql.types import StringType
    f1 = FX.orders_churn(spark, sf)
    text = (F.when(F.col("status") == "P", F.lit("yes")).when(F.col("Churn"), F.lit("True"))
            .otherwise(F.lit("False")))
    return f1.select("id", S.bool_to_int("Churn").alias("bool_code"),
                     S.target_to_int(text, StringType()).alias("text_code"))


@query("array_functions", """SELECT vec_id AS id,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) / 255.0)), 6) AS scaled_sum,
       round(list_max(list_transform(embedding, lambda x: CAST(x AS DOUBLE) / 255.0)), 6) AS scaled_max,
       label AS hot_position, CAST(1.0 AS DOUBLE) AS hot_sum,
       CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax
FROM embeddings""")
def q_array_functions(spark, sf):
    """P7 (x/255), P11 (one-hot), P12 (argmax, first wins)."""
    e = FX.vectors(spark, sf)
    scaled = S.scale_pixels("embedding")
    hot = S.one_hot("label", 10)
    return r6(e.select(
        F.col("vec_id").alias("id"),
        F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x).alias("scaled_sum"),
        F.array_max(scaled).alias("scaled_max"),
        (F.array_position(hot, 1.0) - 1).cast("int").alias("hot_position"),
        F.aggregate(hot, F.lit(0.0), lambda a, x: a + x).alias("hot_sum"),
        S.argmax("embedding").alias("argmax")))


@query("threshold_confidence", W("""SELECT id, CAST(score > 0.5 AS INTEGER) AS predicted,
       round(abs(score - 0.5) + 0.5, 6) AS confidence,
       CAST(label = CAST(score > 0.5 AS INTEGER) AS INTEGER) AS correct FROM f4""", "f4"))
def q_threshold_confidence(spark, sf):
    """P13 (p > 0.5), P14 (binary confidence), P15 (correct flag)."""
    f4 = FX.scored(spark, sf)
    pred = S.threshold("score")
    return r6(f4.select("id", pred.alias("predicted"), S.confidence_binary("score").alias("confidence"),
                        S.correct_flag("label", pred).alias("correct")))


@query("number_formats", W("""SELECT id, round(total / 7, 4) AS total_r4,
       printf('%.3f', round(total / 7, 3)) AS total_txt,
       printf('%.1f%%', round(total / 5000, 1)) AS pct_txt,
       format('{:,}', CAST(floor(total) AS BIGINT)) AS grouped, upper(segment) AS upper_segment
FROM f1""", "f1"))
def q_number_formats(spark, sf):
    """P16 (round 4) and P17 (fixed, percent, grouped text; upper case)."""
    f1 = FX.orders_churn(spark, sf)
    return r6(f1.select("id", S.round4(F.col("total") / 7).alias("total_r4"),
                        S.fmt_fixed(F.col("total") / 7, 3).alias("total_txt"),
                        S.fmt_percent(F.col("total") / 5000, 1).alias("pct_txt"),
                        S.fmt_grouped(F.floor("total")).alias("grouped"),
                        S.upper_name("segment").alias("upper_segment")))


# ---------------------------------------------------------------- encoding

_CATS = ["priority", "status", "segment"]


@query("label_encode", W("SELECT id, " + ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY coalesce(CAST({c} AS VARCHAR), 'nan')) - 1 AS INTEGER) AS {c}"
    for c in _CATS) + ", Churn FROM f1", "f1"))
def q_label_encode(spark, sf):
    """E1 + E2: alphabetical codes from 0, nulls as the category 'nan'."""
    f1 = FX.orders_churn(spark, sf).select("id", *_CATS, "Churn")
    return encode.fit_label_encoding(f1, _CATS).transform(f1)


@query("encoder_dictionary", W(_union_sql([
    f"SELECT DISTINCT '{c}' AS name, {c} AS value, "
    f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS BIGINT) AS code FROM f1" for c in _CATS]), "f1"))
def q_encoder_dictionary(spark, sf):
    """(name, value, code) dictionary of the fitted encoding."""
    f1 = FX.orders_churn(spark, sf)
    return encode.fit_label_encoding(f1, _CATS).dictionary(spark)


@query("target_encode", W("SELECT id, CAST(dense_rank() OVER (ORDER BY status) - 1 AS INTEGER) AS status "
                          "FROM f1", "f1"))
def q_target_encode(spark, sf):
    """A text target gets label codes."""
    f1 = FX.orders_churn(spark, sf).select("id", "status")
    out, _ = encode.encode_target(f1, "status")
    return out


@query("standard_scale", W("""SELECT id,
       round((balance - avg(balance) OVER ()) / stddev_pop(balance) OVER (), 6) AS balance,
       round((total - avg(total) OVER ()) / stddev_pop(total) OVER (), 6) AS total FROM f1""", "f1"))
def q_standard_scale(spark, sf):
    """(x - mean) / population std, fitted with one aggregate."""
    f1 = FX.orders_churn(spark, sf).select("id", "balance", "total")
    return r6(encode.fit_population_scaler(f1, ["balance", "total"]).transform(f1))


@query("decision_mesh", W("""WITH b AS (SELECT min(e0) - 1 AS x0, max(e0) + 1 AS x1,
                            min(e1) - 1 AS y0, max(e1) + 1 AS y1 FROM f3),
n AS (SELECT x0, y0, CAST(ceil((x1 - x0) / 0.02) AS BIGINT) AS nx,
             CAST(ceil((y1 - y0) / 0.02) AS BIGINT) AS ny FROM b)
SELECT ix, iy, round(x0 + ix * 0.02, 6) AS x, round(y0 + iy * 0.02, 6) AS y
FROM n, (SELECT unnest(range(nx)) AS ix FROM n) a, (SELECT unnest(range(ny)) AS iy FROM n) c""", "f3"))
def q_decision_mesh(spark, sf):
    """Mesh over min-1..max+1 of two features, step 0.02."""
    from classbench.operators.projection import mesh_grid
    return r6(mesh_grid(FX.ring(spark, sf), "e0", "e1", 0.02).select("ix", "iy", "x", "y"))


# ---------------------------------------------------------------- splits

def _rank_sql(salt: str = "", src: str = "f1", label: str = "Churn") -> str:
    return (f"row_number() OVER (PARTITION BY {label} ORDER BY md5('42|{salt}' || CAST(id AS VARCHAR)), id)")


@query("split_stratified", W(f"""SELECT id, Churn,
       CASE WHEN rn <= floor(CAST(nc AS DOUBLE) * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
FROM (SELECT id, Churn, {_rank_sql()} AS rn, count(*) OVER (PARTITION BY Churn) AS nc FROM f1)""", "f1"))
def q_split_stratified(spark, sf):
    """L1: exact stratified 80/20 split, seed 42."""
    f1 = FX.orders_churn(spark, sf).select("id", "Churn")
    return split.stratified_split(f1, "id", "Churn", 0.2, 42)


@query("split_three_way", W(f"""WITH a AS (SELECT id, Churn, {_rank_sql()} AS rn,
                  count(*) OVER (PARTITION BY Churn) AS nc FROM f1),
t AS (SELECT id, Churn, rn <= floor(CAST(nc AS DOUBLE) * 0.2 + 0.5) AS is_test FROM a),
r AS (SELECT id, Churn, {_rank_sql('val|')} AS rn, count(*) OVER (PARTITION BY Churn) AS nc
      FROM t WHERE NOT is_test)
SELECT id, Churn, CASE WHEN rn <= floor(CAST(nc AS DOUBLE) * 0.25 + 0.5) THEN 'validation' ELSE 'train' END AS split
FROM r
UNION ALL SELECT id, Churn, 'test' AS split FROM t WHERE is_test""", "f1"))
def q_split_three_way(spark, sf):
    """L2: test 20 %, then validation 20 % of all (0.25 of the rest), both stratified."""
    f1 = FX.orders_churn(spark, sf).select("id", "Churn")
    return split.three_way_split(f1, "id", "Churn", 0.2, 0.2, 42)


@query("kfold_shuffled", W(f"SELECT id, Churn, CAST(({_rank_sql()} - 1) % 5 AS INTEGER) AS fold FROM f1", "f1"))
def q_kfold_shuffled(spark, sf):
    """L3: stratified shuffled 5-fold."""
    f1 = FX.orders_churn(spark, sf).select("id", "Churn")
    return split.stratified_kfold(f1, "id", "Churn", 5, 42, shuffle=True)


@query("kfold_ordered", W("""SELECT id, Churn, CAST(floor((rn - 1) * 5 / nc) AS INTEGER) AS fold
FROM (SELECT id, Churn, row_number() OVER (PARTITION BY Churn ORDER BY id) AS rn,
             count(*) OVER (PARTITION BY Churn) AS nc FROM f1)""", "f1"))
def q_kfold_ordered(spark, sf):
    """L4: stratified unshuffled 5-fold (contiguous by id inside each class)."""
    f1 = FX.orders_churn(spark, sf).select("id", "Churn")
    return split.stratified_kfold(f1, "id", "Churn", 5, shuffle=False)


@query("tail_holdout", W("""SELECT id, Churn,
       CASE WHEN rn > floor(CAST(n AS DOUBLE) * 0.8) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT id, Churn, row_number() OVER (ORDER BY id) AS rn, count(*) OVER () AS n FROM f1)""", "f1"))
def q_tail_holdout(spark, sf):
    """Last 20 % of rows by id is the validation part."""
    f1 = FX.orders_churn(spark, sf).select("id", "Churn")
    return split.tail_holdout(f1, "id", 0.2)


@query("head_rows", W("SELECT id, priority, status, segment, nation, round(balance, 6) AS balance, "
                      "round(total, 6) AS total, Churn FROM f1 ORDER BY id LIMIT 5", "f1"))
def q_head_rows(spark, sf):
    """First 5 rows by id (the limit is the feature)."""
    return r6(split.head(FX.orders_churn(spark, sf), 5, "id"))


# ---------------------------------------------------------------- metrics

def _cm_sql(src: str) -> str:
    return f"""WITH c AS (SELECT label AS actual, prediction AS predicted, count(*) AS n FROM {src} GROUP BY ALL),
k AS (SELECT DISTINCT c FROM (SELECT label AS c FROM {src} UNION SELECT prediction FROM {src}) WHERE c IS NOT NULL)
SELECT a.c AS actual, b.c AS predicted, coalesce(n, 0) AS count
FROM k a CROSS JOIN k b LEFT JOIN c ON c.actual = a.c AND c.predicted = b.c"""


@query("confusion_binary", W(_cm_sql("f4"), "f4"))
def q_confusion_binary(spark, sf):
    """V1 on the binary scored table."""
    return metrics.confusion_matrix(FX.scored(spark, sf))


@query("confusion_multiclass", W(_cm_sql("f4m"), "f4m"))
def q_confusion_multiclass(spark, sf):
    """V1 on the 10-class table, zeros kept."""
    return metrics.confusion_matrix(FX.scored_multiclass(spark, sf))


@query("binary_metrics", W("""WITH s AS (SELECT count(*) AS n, count_if(label = prediction) AS ok,
       count_if(label = 1 AND prediction = 1) AS tp, count_if(label <> 1 AND prediction = 1) AS fp,
       count_if(label = 1 AND prediction <> 1) AS fn FROM f4)
SELECT round(CAST(ok AS DOUBLE) / n, 6) AS accuracy,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM s""", "f4"))
def q_binary_metrics(spark, sf):
    """V2 + V3: accuracy, precision, recall, F1 of class 1."""
    return r6(metrics.binary_metrics(FX.scored(spark, sf)))


def _per_class_sql(src: str) -> str:
    return f"""k AS (SELECT DISTINCT c FROM (SELECT label AS c FROM {src} UNION SELECT prediction FROM {src}) WHERE c IS NOT NULL),
s AS (SELECT k.c,
        (SELECT count(*) FROM {src} WHERE label = k.c AND prediction = k.c) AS tp,
        (SELECT count(*) FROM {src} WHERE label = k.c) AS support,
        (SELECT count(*) FROM {src} WHERE prediction = k.c) AS predicted FROM k),
pc AS (SELECT c, tp, support, coalesce(CAST(tp AS DOUBLE) / nullif(predicted, 0), 0) AS precision,
              coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0) AS recall,
              coalesce(CAST(2 * tp AS DOUBLE) / nullif(predicted + support, 0), 0) AS f1 FROM s)"""


@query("weighted_metrics", W("WITH " + _per_class_sql("f4m") + """
SELECT round(sum(precision * support) / sum(support), 6) AS precision,
       round(sum(recall * support) / sum(support), 6) AS recall,
       round(sum(f1 * support) / sum(support), 6) AS f1 FROM pc""", "f4m"))
def q_weighted_metrics(spark, sf):
    """V4: support-weighted precision, recall, F1 (10 classes)."""
    return r6(metrics.weighted_metrics(FX.scored_multiclass(spark, sf)))


def _report_sql(src: str) -> str:
    return "WITH " + _per_class_sql(src) + """
SELECT CAST(dense_rank() OVER (ORDER BY c) AS INTEGER) AS row_order, CAST(c AS VARCHAR) AS "row",
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM pc
UNION ALL SELECT 1000001, 'accuracy', NULL, NULL, round(CAST(sum(tp) AS DOUBLE) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 1000002, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 1000003, 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM pc"""


@query("classification_report", W(_report_sql("f4m"), "f4m"))
def q_classification_report(spark, sf):
    """V5 on the 10-class table."""
    return r6(metrics.classification_report(FX.scored_multiclass(spark, sf)))


@query("classification_report_binary", W(_report_sql("f4"), "f4"))
def q_classification_report_binary(spark, sf):
    """V5 on the binary table."""
    return r6(metrics.classification_report(FX.scored(spark, sf)))


def _running_sql(src: str, groups: list[str], p: str = "") -> str:
    """CTEs {p}s (per distinct score) and {p}rc (running tp/fp with totals)."""
    g = ", ".join(groups)
    gsel = f"{g}, " if groups else ""
    part = f"PARTITION BY {g} " if groups else ""
    return f"""{p}s AS (SELECT {gsel}CAST(score AS DOUBLE) AS score,
              CAST(count_if(label = 1) AS DOUBLE) AS pos, CAST(count_if(label <> 1) AS DOUBLE) AS neg
       FROM {src} WHERE score IS NOT NULL GROUP BY ALL),
{p}rc AS (SELECT {gsel}score, pos, neg,
              sum(pos) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
              sum(neg) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
              sum(pos) OVER ({part.strip()}) AS P, sum(neg) OVER ({part.strip()}) AS N FROM {p}s)"""


@query("roc_auc", W("WITH " + _running_sql("f4", []) + """
SELECT round(sum(neg * (tp - pos / 2.0)) / nullif(max(P) * max(N), 0), 6) AS roc_auc FROM rc""", "f4"))
def q_roc_auc(spark, sf):
    """V6: ROC-AUC with ties."""
    return r6(curves.roc_auc(FX.scored(spark, sf)))


@query("roc_curve", W("WITH " + _running_sql("f4", []) + """
SELECT score AS threshold, round(fp / nullif(N, 0), 6) AS fpr, round(tp / nullif(P, 0), 6) AS tpr FROM rc
UNION ALL SELECT CAST('infinity' AS DOUBLE), 0.0, 0.0""", "f4"))
def q_roc_curve(spark, sf):
    """V7: one point per distinct score plus (inf, 0, 0)."""
    return r6(curves.roc_curve(FX.scored(spark, sf)))


@query("pr_curve", W("WITH " + _running_sql("f4", []) + """
SELECT score AS threshold, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(CASE WHEN P = 0 THEN 1.0 ELSE tp / P END, 6) AS recall FROM rc
UNION ALL SELECT NULL, 1.0, 0.0""", "f4"))
def q_pr_curve(spark, sf):
    """V8: one point per distinct score plus (null, precision 1, recall 0)."""
    return r6(curves.pr_curve(FX.scored(spark, sf)))


@query("roc_by_model", W("WITH " + _running_sql("f5", ["model"]) + """
SELECT model, score AS threshold, round(fp / nullif(N, 0), 6) AS fpr, round(tp / nullif(P, 0), 6) AS tpr FROM rc
UNION ALL SELECT DISTINCT model, CAST('infinity' AS DOUBLE), 0.0, 0.0 FROM f5""", "f5"))
def q_roc_by_model(spark, sf):
    """V9: ROC curves of several models side by side."""
    return r6(curves.roc_curve(FX.scored_models(spark, sf), groups=["model"]))


@query("auc_by_model", W("WITH " + _running_sql("f5", ["model"]) + """
SELECT model, round(sum(neg * (tp - pos / 2.0)) / nullif(max(P) * max(N), 0), 6) AS roc_auc
FROM rc GROUP BY model""", "f5"))
def q_auc_by_model(spark, sf):
    """V9: AUC per model."""
    return r6(curves.roc_auc(FX.scored_models(spark, sf), groups=["model"]))


@query("loss_accuracy", """WITH p AS (SELECT label, list_transform(embedding[1:10], lambda x: exp(CAST(x AS DOUBLE))) AS ex
                FROM embeddings),
q AS (SELECT label, list_transform(ex, lambda v: v / list_sum(ex)) AS pr FROM p)
SELECT round(avg(-ln(least(greatest(pr[label + 1], 1e-7), 1 - 1e-7))), 6) AS loss,
       round(avg(CAST(list_position(pr, list_max(pr)) - 1 = label AS DOUBLE)), 6) AS accuracy FROM q""")
def q_loss_accuracy(spark, sf):
    """Cross-entropy and accuracy of softmax(first 10 elements) against the label."""
    e = FX.vectors(spark, sf).select("label", S.softmax(F.slice("embedding", 1, 10)).alias("p"))
    return r6(metrics.loss_accuracy(e, "label", "p"))


# ---------------------------------------------------------------- inspection

@query("probability_histogram", W(_hist_sql("f4", "score", 30, "label"), "f4"))
def q_probability_histogram(spark, sf):
    """Score distribution per true class on shared edges."""
    return r6(inspect.probability_distribution(FX.scored(spark, sf), "label", "score", 30))


_FC = ("fc AS (SELECT id, label, prediction, abs(score - 0.5) + 0.5 AS confidence, "
       "CAST(label = prediction AS INTEGER) AS correct FROM f4)")


@query("confidence_histogram", W("WITH " + _FC + ",\n" + _hist_sql("fc", "confidence", 20, "correct")[5:], "f4"))
def q_confidence_histogram(spark, sf):
    """Confidence distribution split by correct / incorrect."""
    d = inspect.with_confidence(FX.scored(spark, sf))
    return r6(inspect.confidence_distribution(d, 20))


@query("confidence_extremes", W("WITH " + _FC + """
(SELECT 'least' AS kind, id, label, prediction, round(confidence, 6) AS confidence FROM fc
 ORDER BY confidence, id LIMIT 5)
UNION ALL
(SELECT 'most' AS kind, id, label, prediction, round(confidence, 6) AS confidence FROM fc
 ORDER BY confidence DESC, id LIMIT 5)""", "f4"))
def q_confidence_extremes(spark, sf):
    """K3: five least and five most confident predictions (top-k is the feature)."""
    d = inspect.with_confidence(FX.scored(spark, sf))
    return r6(inspect.extremes(d, "confidence", "id", 5))


@query("samples_per_class", """SELECT vec_id, label, sample FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS sample FROM embeddings
  WHERE label IN (SELECT DISTINCT label FROM embeddings ORDER BY label LIMIT 10))
WHERE sample <= 2""")
def q_samples_per_class(spark, sf):
    """K4: first two rows of each of the first ten classes."""
    d = inspect.first_per_class(FX.vectors(spark, sf), "label", "vec_id", 2, 10)
    return d.select("vec_id", "label", F.col("sample").cast("long").alias("sample"))


# ---------------------------------------------------------------- ordered weights (K1, K2, K5, K6)

_SHARES = ("w AS (SELECT nation, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM f1) AS share "
           "FROM f1 GROUP BY nation)")


def _nation_shares(spark, sf) -> DataFrame:
    """Share of F1 rows per nation: a data-derived (item, weight) table summing to 1."""
    from pyspark.sql import Window
    c = FX.orders_churn(spark, sf).groupBy("nation").agg(F.count(F.lit(1)).alias("n"))
    return c.select("nation", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


@query("weight_ranking", W("WITH " + _SHARES + """
SELECT nation, round(share, 6) AS share, row_number() OVER (ORDER BY share DESC, nation) AS position,
       round(sum(share) OVER (ORDER BY share DESC, nation ROWS UNBOUNDED PRECEDING), 6) AS cumulative FROM w""", "f1"))
def q_weight_ranking(spark, sf):
    """K1 + K5: descending order, position and cumulative share."""
    r = importance.ranked(_nation_shares(spark, sf), "nation", "share")
    return r6(r.withColumn("position", F.col("position").cast("long")))


@query("weight_top10", W("WITH " + _SHARES + """
SELECT nation, round(share, 6) AS share FROM w ORDER BY share DESC, nation LIMIT 10""", "f1"))
def q_weight_top10(spark, sf):
    """K2: top 10 by weight (the limit is the feature)."""
    return r6(importance.top_k(_nation_shares(spark, sf), 10, "nation", "share"))


@query("weights_needed", W("WITH " + _SHARES + """,
r AS (SELECT row_number() OVER (ORDER BY share DESC, nation) AS position,
             sum(share) OVER (ORDER BY share DESC, nation ROWS UNBOUNDED PRECEDING) / sum(share) OVER () AS cum FROM w)
SELECT CAST(0.8 AS DOUBLE) AS threshold, CAST(min(position) FILTER (WHERE cum >= 0.8) AS BIGINT) AS n_items FROM r
UNION ALL
SELECT CAST(0.9 AS DOUBLE), CAST(min(position) FILTER (WHERE cum >= 0.9) AS BIGINT) FROM r""", "f1"))
def q_weights_needed(spark, sf):
    """K6: items needed to reach 80 % and 90 % of the total weight."""
    d = importance.needed_for(_nation_shares(spark, sf), (0.8, 0.9), "nation", "share")
    return d.withColumn("n_items", F.col("n_items").cast("long"))


# ---------------------------------------------------------------- folds and comparison

_FOLDS_SQL = ("folds AS (SELECT id, CAST((row_number() OVER (PARTITION BY Churn ORDER BY "
              "md5('42|' || CAST(id AS VARCHAR)), id) - 1) % 10 AS INTEGER) AS fold FROM f1),\n"
              "ff AS (SELECT f5.*, folds.fold FROM f5 JOIN folds USING (id))")


def _fold_metrics_sql() -> str:
    return _FOLDS_SQL + ",\n" + _running_sql("ff", ["model", "fold"]) + """,
cnt AS (SELECT model, fold, count(*) AS n, count_if(label = prediction) AS ok,
               count_if(label = 1 AND prediction = 1) AS tp, count_if(label <> 1 AND prediction = 1) AS fp,
               count_if(label = 1 AND prediction <> 1) AS fn FROM ff GROUP BY ALL),
fm AS (
  SELECT model, fold, 'accuracy' AS metric, CAST(ok AS DOUBLE) / n AS value FROM cnt
  UNION ALL SELECT model, fold, 'precision', coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) FROM cnt
  UNION ALL SELECT model, fold, 'recall', coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) FROM cnt
  UNION ALL SELECT model, fold, 'f1', coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) FROM cnt
  UNION ALL SELECT model, fold, 'roc_auc', sum(neg * (tp - pos / 2.0)) / nullif(max(P) * max(N), 0)
            FROM rc GROUP BY model, fold)"""


def _fold_metrics(spark, sf) -> DataFrame:
    # folds ranked inside (model, label): the same folds as ranking F1 by class, with no join back
    scored = FX.scored_models(spark, sf).withColumn(
        "_stratum", F.concat_ws("|", F.col("model"), F.col("label").cast("string")))
    folded = split.stratified_kfold(scored, "id", "_stratum", 10, 42).drop("_stratum")
    return metrics.grouped_binary_metrics(folded, ["model", "fold"], score="score")


@query("fold_metrics", W("WITH " + _fold_metrics_sql() + """
SELECT model, fold, metric, round(value, 6) AS value FROM fm""", "f5"))
def q_fold_metrics(spark, sf):
    """T4 (scoring part): 5 metrics per model and stratified fold, one aggregate + AUC."""
    return r6(_fold_metrics(spark, sf))


@query("fold_summary", W("WITH " + _fold_metrics_sql() + """
SELECT model, metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
       round(min(value), 6) AS min, round(max(value), 6) AS max, count(value) AS folds,
       round(avg(value) - 2 * stddev_pop(value), 6) AS lo, round(avg(value) + 2 * stddev_pop(value), 6) AS hi
FROM fm GROUP BY model, metric""", "f5"))
def q_fold_summary(spark, sf):
    """T5: mean, population std, min, max, +/- 2 std per (model, metric)."""
    return r6(compare.fold_summary(_fold_metrics(spark, sf), value="value"))


@query("fold_box", W("WITH " + _fold_metrics_sql() + """,
q AS (SELECT model, metric, count(value) AS n, quantile_cont(value, 0.25) AS q1,
             quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM fm GROUP BY ALL),
j AS (SELECT fm.model, fm.metric, value, n, q1, median, q3,
             value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) AS inside
      FROM fm JOIN q USING (model, metric))
SELECT model, metric, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(value) FILTER (WHERE inside), 6) AS whisker_lo,
       round(max(value) FILTER (WHERE inside), 6) AS whisker_hi,
       CAST(count_if(NOT inside) AS BIGINT) AS n_outliers
FROM j GROUP BY model, metric, n, q1, median, q3""", "f5"))
def q_fold_box(spark, sf):
    """Box-plot summary of fold scores per (model, metric)."""
    return r6(profile.box_summary(_fold_metrics(spark, sf), "value", ["model", "metric"]))


def _model_metrics_sql(p: str = "") -> str:
    return _running_sql("f5", ["model"], p) + f""",
{p}cnt AS (SELECT model, count(*) AS n, count_if(label = prediction) AS ok,
               count_if(label = 1 AND prediction = 1) AS tp, count_if(label <> 1 AND prediction = 1) AS fp,
               count_if(label = 1 AND prediction <> 1) AS fn FROM f5 GROUP BY ALL),
{p}auc AS (SELECT model, sum(neg * (tp - pos / 2.0)) / nullif(max(P) * max(N), 0) AS roc_auc
           FROM {p}rc GROUP BY model),
{p}cmp AS (SELECT {p}cnt.model, CAST(ok AS DOUBLE) / n AS accuracy,
               coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
               coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
               coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1, roc_auc
        FROM {p}cnt JOIN {p}auc USING (model))"""


def _comparison(spark, sf) -> DataFrame:
    long = metrics.grouped_binary_metrics(FX.scored_models(spark, sf), ["model"], score="score")
    return compare.comparison_table(long)


@query("model_comparison", W("WITH " + _model_metrics_sql() + """
SELECT model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, round(roc_auc, 6) AS roc_auc FROM cmp""", "f5"))
def q_model_comparison(spark, sf):
    """One row per model, one column per metric."""
    return r6(_comparison(spark, sf))


@query("best_model", W("WITH " + _model_metrics_sql() + """
SELECT model, round(f1, 6) AS f1 FROM cmp ORDER BY f1 DESC, model LIMIT 1""", "f5"))
def q_best_model(spark, sf):
    """K7: best model by F1 (first on ties)."""
    return r6(compare.best_row(_comparison(spark, sf), "f1", "model").select("model", "f1"))


@query("comparison_transposed", W("WITH " + _model_metrics_sql() + """,
l AS (UNPIVOT cmp ON accuracy, precision, recall, f1, roc_auc INTO NAME field VALUE v)
SELECT field, round(max(v) FILTER (WHERE model = 'price'), 6) AS price,
       round(max(v) FILTER (WHERE model = 'balance'), 6) AS balance FROM l GROUP BY field""", "f5"))
def q_comparison_transposed(spark, sf):
    """The comparison table transposed (metrics as rows, models as columns)."""
    t = compare.transpose(_comparison(spark, sf), "model", list(compare.METRICS), ["price", "balance"])
    return r6(t)


@query("union_train_test", W(f"""WITH r AS (SELECT id, Churn, {_rank_sql()} AS rn,
                  count(*) OVER (PARTITION BY Churn) AS nc FROM f1)
SELECT id, Churn, 'train' AS part FROM r WHERE rn > floor(CAST(nc AS DOUBLE) * 0.2 + 0.5)
UNION ALL SELECT id, Churn, 'test' AS part FROM r WHERE rn <= floor(CAST(nc AS DOUBLE) * 0.2 + 0.5)""", "f1"))
def q_union_train_test(spark, sf):
    """Train and test parts unioned back by name."""
    train, test = split.train_test(FX.orders_churn(spark, sf).select("id", "Churn"), "id", "Churn")
    return compare.union_all(train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test")))


@query("support_vectors", W("""SELECT label, count(*) AS n_support FROM f4
WHERE (CASE WHEN label = 1 THEN 1.0 ELSE -1.0 END) * ((score - 0.5) * 4) <= 1.0 + 0.001
GROUP BY label""", "f4"))
def q_support_vectors(spark, sf):
    """M8: margin rows per class for decision values f = 4 (score - 0.5)."""
    from classbench.models.svm import support_vector_stats
    d = FX.scored(spark, sf).withColumn("decision", (F.col("score") - 0.5) * 4)
    return support_vector_stats(d, "label", "decision", 1e-3)


# ---------------------------------------------------------------- models (no SQL form: rows-only checks)

def _release(result: DataFrame, *inputs: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Materialise a small result (bounded by folds x metrics) and release cached inputs."""
    rows = result.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError("result too large to materialise")
    out = result.sparkSession.createDataFrame(rows, result.schema)
    for d in inputs:
        d.unpersist()
    return out


def _sized(df: DataFrame) -> DataFrame:
    """Persist a frame that several fits will read."""
    return df.persist()


@query("forest_test_metrics")
def q_forest_test_metrics(spark, sf):
    """M1 + M17 + V2-V6: default forest (100 trees, grown fully) on the exact 80/20 split, test metrics."""
    from classbench.plans.forest_run import flagship_metrics
    return flagship_metrics(spark, sf)


@query("forest_importance")
def q_forest_importance(spark, sf):
    """I1 + I2: importance table of the default forest of the training part, ranked with cumulative share."""
    from classbench.models.forest import forest
    from classbench.plans.forest_run import prepare_churn
    data, names = prepare_churn(spark, sf)
    train = _sized(split.train_test(data, "id", "label")[0])
    model = forest().grow(train)
    train.unpersist()
    return importance.ranked(importance.importance_table(spark, names, model.importances(spark)))


def _folded_train(spark, sf, k: int) -> DataFrame:
    """Training part of the churn table with ``k`` stratified folds."""
    from classbench.plans.forest_run import prepare_churn
    train, _ = split.train_test(prepare_churn(spark, sf)[0], "id", "label")
    return split.stratified_kfold(train, "id", "label", k, 42)


#: Fits that run at a time from driver threads in the tuning queries.
PARALLEL_FITS = 8


@query("forest_cv_scores")
def q_forest_cv_scores(spark, sf):
    """T4: 10-fold stratified CV of the default forest; five metrics per fold from one aggregate."""
    from classbench.models.forest import forest, score
    from classbench.plans.tuning import cv_scores
    folded = _folded_train(spark, sf, 10)
    scores = cv_scores(forest, folded, 10, model_name="forest", score_fn=score, parallelism=PARALLEL_FITS)
    return _release(scores)


@query("forest_grid_search")
def q_forest_grid_search(spark, sf):
    """The app's whole default grid (16 points) over five folds, F1 of class 1, the best point marked."""
    from classbench.plans.tuning import forest_grid
    folded = _folded_train(spark, sf, 5)
    table = forest_grid(folded, 5, parallelism=PARALLEL_FITS)
    return table


@query("forest_tree_count_curve")
def q_forest_tree_count_curve(spark, sf):
    """F1 on train and validation parts of five folds for 50 to 300 trees, prefixes of one forest a fold."""
    from classbench.plans.tuning import tree_count_curve
    folded = _folded_train(spark, sf, 5)
    out = tree_count_curve(folded, 5, parallelism=PARALLEL_FITS)
    return out


@query("forest_learning_curve")
def q_forest_learning_curve(spark, sf):
    """Ten nested exact prefixes per fold of five; train and validation accuracy."""
    from classbench.models.forest import forest, score
    from classbench.plans.tuning import learning_curve
    folded = written(_folded_train(spark, sf, 5), "folded")  # ranked in two passes
    out = learning_curve(forest, folded, 5, score_fn=score, parallelism=PARALLEL_FITS)
    return out


@query("forest_validation_curve")
def q_forest_validation_curve(spark, sf):
    """F1 on train and validation parts of five folds over the depths of the reference's range."""
    from classbench.models.forest import forest, score
    from classbench.plans.tuning import VALIDATION_RANGES, validation_curve
    folded = _folded_train(spark, sf, 5)
    out = validation_curve(lambda max_depth: forest(max_depth=max_depth), "max_depth", VALIDATION_RANGES["max_depth"],
                           folded, 5, score_fn=score, parallelism=PARALLEL_FITS)
    return out


@query("svm_comparison")
def q_svm_comparison(spark, sf):
    """M3-M7 + T8: the four kernels (Nystroem where not linear), Platt-calibrated, compared on F1."""
    from classbench.models.svm import KERNELS
    from classbench.plans.svm_run import run_svm_analysis
    return run_svm_analysis(spark, sf, kernels=KERNELS).tables["comparison"]


def _register_svm_grid(kernel: str):
    @query(f"svm_grid_{kernel}")
    def q(spark, sf):
        from classbench.plans.svm_run import svm_grid
        return svm_grid(spark, sf, kernel)
    q.__doc__ = f"T1-T3: the {kernel} kernel's whole grid over five folds, F1 of class 1, the best point marked."


for _k in ("linear", "rbf", "poly", "sigmoid"):
    _register_svm_grid(_k)


@query("svm_tuned_comparison")
def q_svm_tuned_comparison(spark, sf):
    """T1-T3 + T8: all four kernels tuned on their grids, refitted, compared on the test part with training seconds."""
    from classbench.plans.svm_run import run_tuned_svm
    return run_tuned_svm(spark, sf).tables["comparison"]


@query("svm_best_params")
def q_svm_best_params(spark, sf):
    """Best (parameter, value) of every kernel's grid with its mean F1."""
    from classbench.plans.svm_run import prepare_scaled, tuned_svms
    return tuned_svms(prepare_scaled(spark, sf)[0])[1]


@query("svm_cv_scores")
def q_svm_cv_scores(spark, sf):
    """T4: ten folds, five metrics, four kernels at their defaults."""
    from classbench.plans.svm_run import svm_cv_scores
    return svm_cv_scores(spark, sf)


@query("svm_support_vectors")
def q_svm_support_vectors(spark, sf):
    """M8: support vectors per class, total and intercept of fitted models of all kernels."""
    from classbench.plans.svm_run import svm_support_vectors
    return svm_support_vectors(spark, sf)


@query("svm_ring")
def q_svm_ring(spark, sf):
    """M3 vs M4 on the ring (F3): the kernel map must separate what a line cannot."""
    from classbench.models.svm import fit_kernel_svm
    from classbench.plans.svm_run import evaluate, prepare_ring
    train, test = prepare_ring(spark, sf)
    lin = fit_kernel_svm(train, "linear", C=1.0)
    rbf = fit_kernel_svm(train, "rbf", C=10.0)
    return compare.comparison_table(compare.union_all(evaluate(lin, test, "linear"),
                                                      evaluate(rbf, test, "rbf")))


@query("pca_projection")
def q_pca_projection(spark, sf):
    """Centred 2-component PCA of the scaled churn features, with the share of variance each explains and their sum."""
    from classbench.operators.projection import pca_2d
    from classbench.plans.svm_run import prepare_scaled
    train, _, _ = prepare_scaled(spark, sf)
    projected, ratio, total = pca_2d(train)
    return projected.select("id", "label", "pc_1", "pc_2", F.lit(ratio[0]).alias("explained_1"),
                            F.lit(ratio[1]).alias("explained_2"), F.lit(total).alias("explained"))


@query("network_history")
def q_network_history(spark, sf):
    """M9 + M11-M15: 'simple' preset on scaled churn features; per-epoch history."""
    from classbench.plans.network_run import prepare_network, train_network
    train, validation, _ = prepare_network(spark, sf)
    model = train_network(train, validation, 2, "simple")
    return model.history_frame(spark)


@query("network_image_metrics")
def q_network_image_metrics(spark, sf):
    """M10 + V10 + V4: configurable network on the 8x8 image table (10 classes)."""
    from classbench.plans.network_run import evaluate_network, prepare_images, train_network
    train, validation, test = prepare_images(spark, sf)
    model = train_network(train, validation, 10, preset=None, hidden=[64, 32], batch_size=32)
    return evaluate_network(model, test)


# ---------------------------------------------------------------- reports

@query("detailed_report", W("WITH " + _fold_metrics_sql() + ",\n" + _model_metrics_sql("m_") + """,
tl AS (UNPIVOT m_cmp ON accuracy, precision, recall, f1, roc_auc INTO NAME metric VALUE value),
fsum AS (SELECT model, metric, avg(value) AS mean, stddev_pop(value) AS std FROM fm GROUP BY model, metric)
SELECT 'test' AS section, model, metric, round(value, 6) AS value FROM tl
UNION ALL SELECT 'cv_mean', model, metric, round(mean, 6) FROM fsum
UNION ALL SELECT 'cv_std', model, metric, round(std, 6) FROM fsum
UNION ALL (SELECT 'best_f1', model, metric, round(value, 6) FROM tl WHERE metric = 'f1'
           ORDER BY value DESC, model LIMIT 1)
UNION ALL (SELECT 'best_roc_auc', model, metric, round(value, 6) FROM tl WHERE metric = 'roc_auc'
           ORDER BY value DESC, model LIMIT 1)
UNION ALL (SELECT 'best_accuracy', model, metric, round(value, 6) FROM tl WHERE metric = 'accuracy'
           ORDER BY value DESC, model LIMIT 1)""", "f5"))
def q_detailed_report(spark, sf):
    """R2: test table, CV mean/std table and best model by F1, ROC-AUC, accuracy."""
    from classbench.plans.reports import detailed_report
    test_long = metrics.grouped_binary_metrics(FX.scored_models(spark, sf), ["model"], score="score")
    return r6(detailed_report(test_long, _fold_metrics(spark, sf)))


@query("forest_summary_report")
def q_forest_summary_report(spark, sf):
    """R1 + S5: forest summary (type, trees, depth, test metrics, rows, features) as CSV."""
    from classbench.models.forest import forest, score
    from classbench.plans.forest_run import _metric_rows, prepare_churn
    from classbench.plans.reports import model_summary
    data, names = prepare_churn(spark, sf)
    parts = split.stratified_split(data, "id", "label", 0.2, 42)
    parts = parts.persist()
    train, test = parts.where("split = 'train'"), parts.where("split = 'test'")
    est = forest()
    model = est.grow(train)
    info = {"model": "RandomForest", "n_trees": est.getNumTrees(), "max_depth": est.getMaxDepth(), "n_train": train.count(),
            "n_test": test.count(), "n_features": len(names)}
    return model_summary(_metric_rows(score(model, test)), info, new_scratch_path(spark, "summary"))


@query("svm_decision_surface")
def q_svm_decision_surface(spark, sf):
    """E7 + E8 + M4: scaled churn features projected to 2 components, an RBF model
    with default parameters fitted there, and the mesh scored (class and probability)."""
    from classbench.models.svm import fit_kernel_svm
    from classbench.operators.projection import decision_surface, pca_2d
    from classbench.plans.svm_run import prepare_scaled
    from classbench.operators.encode import assemble
    train, _, _ = prepare_scaled(spark, sf)
    projected, _, _ = pca_2d(train)
    two = assemble(projected.select("id", "label", "pc_1", "pc_2"), ["pc_1", "pc_2"])
    two = _sized(two)
    model = fit_kernel_svm(two, "rbf", C=1.0)
    return decision_surface(model, two, "pc_1", "pc_2", step=0.02)


@query("network_complex_history")
def q_network_complex_history(spark, sf):
    """M9 'complex' preset (batch normalisation, dropout 0.4-0.2) trained on Spark; history."""
    from classbench.plans.network_run import prepare_network, train_network
    train, validation, _ = prepare_network(spark, sf)
    model = train_network(train, validation, 2, "complex")
    return model.history_frame(spark)
