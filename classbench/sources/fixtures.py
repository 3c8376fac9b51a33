"""Fixtures F1-F5 built from the given tables (see FIXTURES.md).

Every fixture is a lazy DataFrame derived from the given tables, so its size
grows with the scale factor.  The same definitions are written as SQL in
``FIXTURE_SQL`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from classbench.sources.tables import table

# Fixed values (must stay equal to FIXTURES.md): the planted churn rule, the
# ring cut and the score scale.
CHURN_RULE = ("(c_acctbal < 0 AND o_orderpriority <> '5-LOW') OR "
              "(o_totalprice > 400000 AND c_mktsegment IN ('BUILDING', 'MACHINERY'))")
RING_CUT = 0.0219
# Scores are round(x / 500000, 2) written as round(x / 5000) / 100: the same
# value, but free of decimal-vs-binary rounding differences between engines.
PRICE_SCORE = "round(o_totalprice / 5000) / 100"
BALANCE_SCORE = "round((10000 - c_acctbal) / 110) / 100"


def orders_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to customer, with the planted ``Churn`` label.

    The join is an equi-join on the customer key; Spark picks sort-merge or,
    when AQE measures the customer side under the broadcast threshold at run
    time, a broadcast hash join.  No broadcast is forced: ``customer`` grows
    with the data.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("o_totalprice").alias("total"),
        F.expr(CHURN_RULE).alias("Churn"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as supplied (vec_id, embedding array<float>, label)."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """two features and a ring label no linear model can separate."""
    e = table(spark, sf_dir, "embeddings")
    e0 = F.col("embedding")[0].cast("double")
    e1 = F.col("embedding")[1].cast("double")
    return e.select(
        F.col("vec_id").alias("id"), e0.alias("e0"), e1.alias("e1"),
        ((e0 * e0 + e1 * e1) > F.lit(RING_CUT)).cast("int").alias("label"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model-free scored table (id, label, score, prediction)."""
    f1 = orders_churn(spark, sf_dir)
    score = F.round(F.col("total") / 5000) / 100
    return f1.select(
        "id", F.col("Churn").cast("int").alias("label"), score.alias("score"),
        (score > 0.5).cast("int").alias("prediction"))


def scored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """two model-free scorers over F1, long form (model, id, label, score, prediction).

    ``price`` is the F4 score; ``balance`` scores low account balances high.
    They stand in for fitted models wherever an operator compares models.
    """
    f1 = orders_churn(spark, sf_dir)
    price = F.round(F.col("total") / 5000) / 100
    balance = F.round((10000 - F.col("balance")) / 110) / 100
    scores = F.array(
        F.struct(F.lit("price").alias("model"), price.alias("score")),
        F.struct(F.lit("balance").alias("model"), balance.alias("score")))
    return (f1.select("id", F.col("Churn").cast("int").alias("label"),
                      F.explode(scores).alias("s"))
            .select("s.model", "id", "label", "s.score",
                    (F.col("s.score") > 0.5).cast("int").alias("prediction")))


def scored_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 multiclass form: prediction = 0-based argmax of the first 10 elements."""
    e = vectors(spark, sf_dir)
    head = F.slice("embedding", 1, 10)
    return e.select(
        F.col("vec_id").alias("id"), "label",
        (F.array_position(head, F.array_max(head)) - 1).cast("int").alias("prediction"))


# SQL forms of the fixtures, for the DuckDB oracle (same rules, same names).
FIXTURE_SQL = {
    "f1": f"""SELECT o.o_orderkey AS id, o.o_orderpriority AS priority,
               o.o_orderstatus AS status, c.c_mktsegment AS segment,
               c.c_nationkey AS nation, c.c_acctbal AS balance, o.o_totalprice AS total,
               ({CHURN_RULE}) AS Churn
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "f3": f"""SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS e0,
               CAST(embedding[2] AS DOUBLE) AS e1,
               CAST((CAST(embedding[1] AS DOUBLE) * CAST(embedding[1] AS DOUBLE)
                     + CAST(embedding[2] AS DOUBLE) * CAST(embedding[2] AS DOUBLE))
                    > {RING_CUT} AS INTEGER) AS label
        FROM embeddings""",
    "f4": f"""SELECT id, CAST(Churn AS INTEGER) AS label, round(total / 5000) / 100 AS score,
               CAST(round(total / 5000) / 100 > 0.5 AS INTEGER) AS prediction
        FROM f1""",
    "f5": """SELECT 'price' AS model, id, CAST(Churn AS INTEGER) AS label,
               round(total / 5000) / 100 AS score,
               CAST(round(total / 5000) / 100 > 0.5 AS INTEGER) AS prediction FROM f1
        UNION ALL
        SELECT 'balance' AS model, id, CAST(Churn AS INTEGER) AS label,
               round((10000 - balance) / 110) / 100 AS score,
               CAST(round((10000 - balance) / 110) / 100 > 0.5 AS INTEGER) AS prediction FROM f1""",
    "f4m": """SELECT vec_id AS id, label,
               CAST(list_position(embedding[1:10], list_max(embedding[1:10])) - 1 AS INTEGER)
                 AS prediction
        FROM embeddings""",
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the fixture CTEs it uses (f4/f5 need f1)."""
    need = list(names)
    if any(n in ("f4", "f5") for n in need) and "f1" not in need:
        need.insert(0, "f1")
    order = ["f1", "f3", "f4", "f5", "f4m"]
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]})" for n in order if n in need)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
