"""Joins, panels, aggregates, ordering and evaluation over the given tables.

Blocks here are customers (or parts of their key), years come from order and ship
dates, and scores are arithmetic on keys, so every curve has an exact answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockrisk.functions import fields as C
from blockrisk.functions import geometry as G
from blockrisk.ml import split as M
from blockrisk.operators import aggregates as A
from blockrisk.operators import panel as P
from blockrisk.operators import ranking as R
from blockrisk.plans import evaluation, risk
from blockrisk.sources import census, files
from blockrisk.workload import geography as GEO
from blockrisk.workload import tables as T
from blockrisk.workload.registry import query

FIRST, LAST = T.FIRST_YEAR, T.LAST_YEAR

# --- order counts per customer and year: a small panel ---

ORDER_SQL = """
    o AS (SELECT o_custkey AS block, year(o_orderdate) AS yr,
                 CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS urgent,
                 CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS closed, o_totalprice FROM orders),
    c AS (SELECT block, yr, count(*) AS n, sum(urgent) AS urgent, sum(closed) AS closed
          FROM o GROUP BY 1, 2),
    b AS (SELECT c_custkey AS block FROM customer)"""


def orders(spark, d) -> DataFrame:
    return T.read(spark, d, "orders").select(
        F.col("o_custkey").alias("block"), F.year("o_orderdate").alias("yr"),
        C.equals_flag("o_orderpriority", "1-URGENT").alias("urgent"),
        C.equals_flag("o_orderstatus", "F").alias("closed"), "o_totalprice", "o_orderkey",
    )


def order_counts(spark, d) -> DataFrame:
    return orders(spark, d).groupBy("block", "yr").agg(
        F.count(F.lit(1)).alias("n"), F.sum("urgent").alias("urgent"), F.sum("closed").alias("closed")
    )


def customers(spark, d) -> DataFrame:
    return T.read(spark, d, "customer").select(F.col("c_custkey").alias("block"))


@query("count_per_block_year", "block i, yr i, n i", f"WITH {ORDER_SQL} SELECT block, yr, n FROM c")
def _(spark, d):
    return A.count_per(orders(spark, d), ["block", "yr"], "n")


@query("sum_flags", "block i, yr i, urgent i, closed i", f"WITH {ORDER_SQL} SELECT * FROM c")
def _(spark, d):
    return A.sum_per(orders(spark, d), ["block", "yr"], ["urgent", "closed"])


@query("mean_per_block_year", "block i, yr i, o_totalprice a", f"""
    WITH {ORDER_SQL} SELECT block, yr, avg(o_totalprice) AS o_totalprice FROM o GROUP BY 1, 2""")
def _(spark, d):
    return A.mean_per(orders(spark, d), ["block", "yr"], ["o_totalprice"])


@query("minmaxstd", "l_partkey i, min i, max i, sd f, n i", """
    SELECT l_partkey, min(y) AS min, max(y) AS max, stddev_samp(y) AS sd, count(y) AS n
    FROM (SELECT l_partkey, year(l_shipdate) AS y FROM lineitem) GROUP BY 1""")
def _(spark, d):
    rows = T.read(spark, d, "lineitem").select("l_partkey", F.year("l_shipdate").alias("y"))
    return A.spread_stats(rows, ["l_partkey"], "y")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_SHARE = "count(*) FILTER (o_orderpriority IN ({})) / CAST(count(o_orderpriority) AS DOUBLE)"


@query("pivot_shares", "o_custkey i, yr i, " + ", ".join(f"{p} f" for p in PRIORITIES), f"""
    SELECT o_custkey, year(o_orderdate) AS yr,
           {', '.join(_SHARE.format(f"'{p}'") + f' AS "{p}"' for p in PRIORITIES)}
    FROM orders GROUP BY 1, 2""")
def _(spark, d):
    rows = T.read(spark, d, "orders").withColumn("yr", F.year("o_orderdate"))
    return A.pivot_shares(rows, ["o_custkey", "yr"], "o_orderpriority", PRIORITIES)


@query("merge_rare", "o_custkey i, 1-URGENT f, 2-HIGH f, other f", f"""
    SELECT o_custkey, {_SHARE.format("'1-URGENT'")} AS "1-URGENT", {_SHARE.format("'2-HIGH'")} AS "2-HIGH",
           {_SHARE.format("'3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'")} AS other FROM orders GROUP BY 1""")
def _(spark, d):
    return A.pivot_shares(
        T.read(spark, d, "orders"), ["o_custkey"], "o_orderpriority", PRIORITIES, {"other": PRIORITIES[2:]}
    )


@query("left_fill_zero", "block i, yr i, n i", f"""
    WITH {ORDER_SQL} SELECT b.block, y.y AS yr, coalesce(c.n, 0) AS n
    FROM b CROSS JOIN generate_series({FIRST}, {LAST}) y(y)
    LEFT JOIN c ON c.block = b.block AND c.yr = y.y""")
def _(spark, d):
    spine = P.year_spine(customers(spark, d), FIRST, LAST, "yr")
    return P.left_fill(spine, order_counts(spark, d).select("block", "yr", "n"), ["block", "yr"])


@query("year_spine", "block i, yr i", f"""
    SELECT c_custkey AS block, y.y AS yr FROM customer, generate_series({FIRST}, {LAST}) y(y)""")
def _(spark, d):
    return P.year_spine(customers(spark, d), FIRST, LAST, "yr")


@query("observed_year_spine", "block i, yr i", """
    SELECT c_custkey AS block, y.yr FROM customer, (SELECT DISTINCT year(o_orderdate) AS yr FROM orders) y""")
def _(spark, d):
    return P.observed_year_spine(customers(spark, d), orders(spark, d), "yr")


@query("target_shift", "block i, yr i, n i, next_n i", f"""
    WITH {ORDER_SQL} SELECT a.block, a.yr, a.n, x.n AS next_n
    FROM c a LEFT JOIN c x ON x.block = a.block AND x.yr = a.yr + 1""")
def _(spark, d):
    counts = order_counts(spark, d).select("block", "yr", "n")
    paired = P.pair_with_next_year(counts, {"n": "next_n"}, ["block", "yr"])
    return paired.filter(F.col("n").isNotNull())


@query("target_join", "block i, yr i, next_urgent i", f"""
    WITH {ORDER_SQL} SELECT b.block, y.y AS yr, x.urgent AS next_urgent
    FROM b CROSS JOIN generate_series({FIRST}, {LAST}) y(y)
    LEFT JOIN c x ON x.block = b.block AND x.yr = y.y + 1""")
def _(spark, d):
    spine = P.year_spine(customers(spark, d), FIRST, LAST, "yr")
    shifted = P.shift_to_target(order_counts(spark, d), {"urgent": "next_urgent"}, ["block", "yr"])
    return spine.join(shifted, ["block", "yr"], "left")


@query("outer_merge", "block i, n i, pieces i", f"""
    WITH {ORDER_SQL}, p AS (SELECT l_partkey AS block, count(*) AS pieces FROM lineitem GROUP BY 1),
      t AS (SELECT block, sum(n) AS n FROM c GROUP BY 1)
    SELECT coalesce(t.block, p.block) AS block, n, pieces FROM t FULL JOIN p ON p.block = t.block""")
def _(spark, d):
    pieces = A.count_per(T.read(spark, d, "lineitem").withColumnRenamed("l_partkey", "block"), ["block"], "pieces")
    return P.outer_merge(A.count_per(orders(spark, d), ["block"], "n"), pieces, ["block"])


@query("inner_merge", "block i, n i, c_mktsegment s", f"""
    WITH {ORDER_SQL} SELECT t.block, t.n, u.c_mktsegment
    FROM (SELECT block, sum(n) AS n FROM c GROUP BY 1) t JOIN customer u ON u.c_custkey = t.block""")
def _(spark, d):
    people = T.read(spark, d, "customer").select(F.col("c_custkey").alias("block"), "c_mktsegment")
    return P.inner_merge(A.count_per(orders(spark, d), ["block"], "n"), people, ["block"])


@query("natural_join", "block i, yr i, n i, total m", f"""
    WITH {ORDER_SQL} SELECT c.block, c.yr, c.n, t.total FROM c NATURAL JOIN
      (SELECT block, yr, sum(o_totalprice) AS total FROM o GROUP BY 1, 2) t""")
def _(spark, d):
    totals = orders(spark, d).groupBy("block", "yr").agg(F.sum("o_totalprice").alias("total"))
    return P.natural_join(order_counts(spark, d), totals)


@query("join_renamed", "c_custkey i, n i", """
    SELECT c_custkey, n FROM customer LEFT JOIN
      (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def _(spark, d):
    counts = A.count_per(T.read(spark, d, "orders"), ["o_custkey"], "n")
    return P.join_renamed(T.read(spark, d, "customer").select("c_custkey"), counts, "c_custkey", "o_custkey")


@query("semi_join", "l_returnflag s, n i", """
    SELECT l_returnflag, count(*) AS n FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25) GROUP BY 1""")
def _(spark, d):
    wanted = T.read(spark, d, "part").filter(F.col("p_size") > 25)
    keys = wanted.select(F.col("p_partkey").alias("l_partkey"))
    return A.count_per(P.semi_join(T.read(spark, d, "lineitem"), keys, "l_partkey"), ["l_returnflag"], "n")


@query("join_chain", "block i, yr i, n i, urgent i, price a, segment s", f"""
    WITH {ORDER_SQL} SELECT b.block, y.y AS yr, coalesce(c.n, 0) AS n, coalesce(c.urgent, 0) AS urgent,
           p.price, u.c_mktsegment AS segment
    FROM b CROSS JOIN generate_series({FIRST}, {LAST}) y(y)
    LEFT JOIN c ON c.block = b.block AND c.yr = y.y
    LEFT JOIN (SELECT block, yr, avg(o_totalprice) AS price FROM o GROUP BY 1, 2) p
      ON p.block = b.block AND p.yr = y.y
    JOIN customer u ON u.c_custkey = b.block""")
def _(spark, d):
    base = T.read(spark, d, "customer").select(
        F.col("c_custkey").alias("block"), F.col("c_mktsegment").alias("segment")
    )
    prices = orders(spark, d).groupBy("block", "yr").agg(F.avg("o_totalprice").alias("price"))
    counts = order_counts(spark, d).drop("closed")
    spine = P.year_spine(base, FIRST, LAST, "yr")
    return P.join_chain(spine, [(counts, True), (prices, False)], ["block", "yr"])


@query("train_holdout_agg", "block i, urgent_train i, closed_train i, urgent_holdout i, closed_holdout i", f"""
    WITH {ORDER_SQL} SELECT block,
      sum(CASE WHEN yr < 2000 THEN urgent ELSE 0 END) AS urgent_train,
      sum(CASE WHEN yr < 2000 THEN closed ELSE 0 END) AS closed_train,
      sum(CASE WHEN yr = 2000 THEN urgent ELSE 0 END) AS urgent_holdout,
      sum(CASE WHEN yr = 2000 THEN closed ELSE 0 END) AS closed_holdout FROM o GROUP BY 1""")
def _(spark, d):
    measures = {"urgent": F.col("urgent"), "closed": F.col("closed")}
    return A.train_holdout(orders(spark, d), ["block"], "yr", 2000, measures)


@query("null_profile", "GISJOIN i, JOIE001 i, block_num i, resunits i", f"""
    SELECT a.*, b.* FROM
      (SELECT count(*) FILTER ("TRACT" IS NULL) AS "GISJOIN", count(*) FILTER ("JOIE001" IS NULL) AS "JOIE001"
       FROM ({T.table_sql('tracts')})) a,
      (SELECT count(*) FILTER (block_num IS NULL) AS block_num, count(*) FILTER (resunits IS NULL) AS resunits
       FROM ({T.table_sql('landuse')})) b""")
def _(spark, d):
    tracts = A.null_profile(T.logical(spark, d, "tracts").select(F.col("TRACT").alias("GISJOIN"), "JOIE001"))
    parcels = A.null_profile(T.logical(spark, d, "landuse").select("block_num", "resunits"))
    one = parcels.agg(F.struct(F.max("block_num").alias("a"), F.max("resunits").alias("b")).alias("s")).scalar()
    return tracts.withColumn("_s", one).select(
        "GISJOIN", "JOIE001", F.col("_s.a").alias("block_num"), F.col("_s.b").alias("resunits")
    )


@query("count_profile", "Closed Roll Year i, Use Code i, the_geom i, Lot Area i", f"""
    SELECT "Closed Roll Year", count("Use Code") AS "Use Code", count(the_geom) AS the_geom,
           count("Lot Area") AS "Lot Area" FROM ({T.table_sql('property')}) GROUP BY 1""")
def _(spark, d):
    rows = T.logical(spark, d, "property").select("Closed Roll Year", "Use Code", "the_geom", "Lot Area")
    return A.count_profile(rows, ["Closed Roll Year"])


@query("global_totals", "total m, largest m, rows i", """
    SELECT sum(l_quantity) AS total, max(l_extendedprice) AS largest, count(*) AS rows FROM lineitem""")
def _(spark, d):
    return T.read(spark, d, "lineitem").agg(
        F.sum("l_quantity").alias("total"), F.max("l_extendedprice").alias("largest"),
        F.count(F.lit(1)).alias("rows"),
    )


@query("distinct_values", "p_brand s, p_type s", "SELECT DISTINCT p_brand, p_type FROM part")
def _(spark, d):
    return T.read(spark, d, "part").select("p_brand", "p_type").distinct()


_YEARLY = f"""{ORDER_SQL}, s AS (SELECT yr, sum(urgent) AS urgent, sum(closed) AS closed FROM o
              WHERE yr < (SELECT max(yr) FROM o) GROUP BY 1)"""


@query("describe_yearly",
       "column s, count i, mean f, std f, min f, q25 f, q50 f, q75 f, max f",
       f"WITH {_YEARLY} " + " UNION ALL ".join(
           f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
               min({c}) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
               quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM s""" for c in ("urgent", "closed")))
def _(spark, d):
    return A.describe_yearly(orders(spark, d), "yr", ["urgent", "closed"])


@query("mean_of_yearly_sums", "urgent f, closed f", f"""
    WITH {_YEARLY} SELECT avg(urgent) AS urgent, avg(closed) AS closed FROM s""")
def _(spark, d):
    return A.mean_of_yearly_sums(orders(spark, d), "yr", ["urgent", "closed"])


@query("drop_last_year", "yr i, urgent i, closed i", f"WITH {_YEARLY} SELECT * FROM s")
def _(spark, d):
    return A.yearly_sums(orders(spark, d), "yr", ["urgent", "closed"])


def _bins(table: str, x: str, bins: int, by: str | None = None) -> str:
    key, keys = (f"{by}, ", f"g.{by} = h.{by} AND ") if by else ("", "")
    groups = f"(SELECT DISTINCT {by} FROM {table}) g, " if by else ""
    shown = f"g.{by}, " if by else ""
    return f"""
        WITH e AS (SELECT min({x}) AS low, max({x}) AS high FROM {table}),
          h AS (SELECT {key}CAST(least(floor(({x} - e.low) / ((e.high - e.low) / {bins})), {bins - 1}) AS BIGINT) AS bin,
                       count(*) AS n FROM {table}, e GROUP BY ALL)
        SELECT {shown}i.bin, e.low + i.bin * ((e.high - e.low) / {bins}) AS low,
               CASE WHEN i.bin = {bins - 1} THEN e.high
                    ELSE e.low + (i.bin + 1) * ((e.high - e.low) / {bins}) END AS high,
               coalesce(h.n, 0) AS n
        FROM e, {groups}generate_series(0, {bins - 1}) i(bin) LEFT JOIN h ON {keys}h.bin = i.bin"""


@query("histogram", "bin i, low m, high m, n i", _bins("lineitem", "l_extendedprice", 100))
def _(spark, d):
    return R.histogram(T.read(spark, d, "lineitem"), "l_extendedprice", 100)


@query("score_hist_compare", "o_orderpriority s, bin i, low m, high m, n i",
       _bins("orders", "o_totalprice", 100, "o_orderpriority"))
def _(spark, d):
    return evaluation.compare_distributions(T.read(spark, d, "orders"), "o_totalprice", ["o_orderpriority"])


# --- null policy ---

_POLICY = f"""
    t AS (SELECT "TRACT", s_n, "JOIE001" AS a, CASE WHEN s_n % 3 <> 0 THEN "JTIE001" END AS b,
                 CASE WHEN s_n % 4 <> 0 THEN "J4TM001" END AS s
          FROM (SELECT *, CAST(substr("TRACT", 2) AS BIGINT) AS s_n FROM ({T.table_sql('tracts')})))"""


def _policy_rows(spark, d):
    n = F.substring("TRACT", 2, 20).cast("long")
    return T.logical(spark, d, "tracts").select(
        "TRACT", n.alias("s_n"), F.col("JOIE001").alias("a"),
        F.when(n % 3 != 0, F.col("JTIE001")).alias("b"), F.when(n % 4 != 0, F.col("J4TM001")).alias("s"),
    )


@query("null_policy", "TRACT s, a f, b f, s f", f"""
    WITH {_POLICY} SELECT "TRACT", coalesce(a, (SELECT avg(a) FROM t)) AS a,
        coalesce(b, (SELECT avg(b) FROM t)) AS b, coalesce(s, 1) AS s FROM t""")
def _(spark, d):
    return A.fill_nulls(_policy_rows(spark, d), {"s": 1.0}, keep=["s_n"])


@query("null_policy_train_only", "TRACT s, a f, b f, s f", f"""
    WITH {_POLICY} SELECT "TRACT", coalesce(a, (SELECT avg(a) FROM t WHERE s_n % 2 = 0)) AS a,
        b, coalesce(s, 1) AS s FROM t""")
def _(spark, d):
    return A.fill_nulls(
        _policy_rows(spark, d), {"s": 1.0}, keep=["s_n", "b"], fit_on=F.col("s_n") % 2 == 0
    )


# --- order, thresholds, top-k ---

OUTCOME_SQL = f"""{ORDER_SQL},
    r AS (SELECT b.block, (b.block * 37 % 1009) / 100.9 AS score,
                 coalesce(sum(o.closed) FILTER (o.yr = 1999), 0) AS previous,
                 coalesce(sum(o.closed) FILTER (o.yr = 2000), 0) AS target
          FROM b LEFT JOIN o ON o.block = b.block GROUP BY 1, 2)"""
N = 60


def outcomes(spark, d) -> DataFrame:
    """One scored row per block: the count of a year and of the year after."""
    sums = orders(spark, d).groupBy("block").agg(
        F.sum(F.when(F.col("yr") == 1999, F.col("closed")).otherwise(0)).alias("previous"),
        F.sum(F.when(F.col("yr") == 2000, F.col("closed")).otherwise(0)).alias("target"),
    )
    base = customers(spark, d).withColumn("score", F.col("block") * 37 % 1009 / F.lit(100.9))
    return P.left_fill(base, sums, ["block"])


@query("nth_threshold", "threshold f", f"""
    WITH {OUTCOME_SQL} SELECT score AS threshold FROM r ORDER BY score DESC LIMIT 1 OFFSET {N}""")
def _(spark, d):
    return R.nth_largest_threshold(outcomes(spark, d), "score", N)


_FLAGGED = f"""{OUTCOME_SQL}, f AS (SELECT *, CASE WHEN score >
    (SELECT score FROM r ORDER BY score DESC LIMIT 1 OFFSET {N}) THEN 1 ELSE 0 END AS highrisk FROM r)"""


@query("high_risk_flag", "block i, score f, highrisk i", f"WITH {_FLAGGED} SELECT * FROM f")
def _(spark, d):
    return R.flag_above_threshold(outcomes(spark, d), "score", N)


@query("top_k", "block i, score f", f"WITH {OUTCOME_SQL} SELECT * FROM r ORDER BY score DESC, block LIMIT {N}")
def _(spark, d):
    return R.top_k(outcomes(spark, d), "score", N, "block")


@query("marginal_block", "block i, score f, previous i, target i", f"""
    WITH {OUTCOME_SQL} SELECT * FROM r ORDER BY score DESC, block LIMIT 1 OFFSET {N - 1}""")
def _(spark, d):
    return R.marginal_row(outcomes(spark, d), "score", N, "block")


@query("row_number_id", "c_name s, BLOCKID i", """
    SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS BLOCKID FROM customer""")
def _(spark, d):
    return risk.with_block_id(T.read(spark, d, "customer").select("c_name"), "c_name")


@query("cumulative_counts", "o_totalprice m, before i, total i", """
    SELECT o_totalprice, sum(n) OVER (ORDER BY o_totalprice) - n AS before, sum(n) OVER () AS total
    FROM (SELECT o_totalprice, count(*) AS n FROM orders GROUP BY 1)""")
def _(spark, d):
    counts = A.count_per(T.read(spark, d, "orders"), ["o_totalprice"], "n")
    ranked = R.running_totals(counts, ["o_totalprice"], {"n": F.col("n")})
    return ranked.select("o_totalprice", F.col("n_before").alias("before"), F.col("n_total").alias("total"))


@query("hit_rate_at_n", "model f, previous f, random f", f"""
    WITH {OUTCOME_SQL},
      m AS (SELECT * FROM r ORDER BY score DESC, block LIMIT {N}),
      p AS (SELECT * FROM r ORDER BY previous DESC, block LIMIT {N})
    SELECT (SELECT count(*) FILTER (target > 0) / {N}.0 FROM m) AS model,
           (SELECT count(*) FILTER (target > 0) / {N}.0 FROM p) AS previous,
           (SELECT avg(CASE WHEN target > 0 THEN 1.0 ELSE 0.0 END) FROM r) AS random""")
def _(spark, d):
    return risk.hit_rate_at_n(outcomes(spark, d), N, "target", "previous", key="block")


@query("capture_rate_at_n", "model f, previous f, random f", f"""
    WITH {OUTCOME_SQL},
      m AS (SELECT * FROM r ORDER BY score DESC, block LIMIT {N}),
      p AS (SELECT * FROM r ORDER BY previous DESC, block LIMIT {N})
    SELECT (SELECT sum(target) FROM m) / CAST((SELECT sum(target) FROM r) AS DOUBLE) AS model,
           (SELECT sum(target) FROM p) / CAST((SELECT sum(target) FROM r) AS DOUBLE) AS previous,
           (SELECT {N}.0 / count(*) FROM r) AS random""")
def _(spark, d):
    return risk.capture_rate_at_n(outcomes(spark, d), N, "target", "previous", key="block")


_BREAKS = " UNION ALL ".join(
    f"SELECT {i} AS break, quantile_cont(o_totalprice, {q}) AS v FROM orders"
    for i, q in enumerate(risk.LEGEND_QUANTILES.values())
)


@query("legend_breaks", "break i, value f", f"""
    SELECT break, round_even(v / pow(10, floor(log10(v))), 0) * pow(10, floor(log10(v))) AS value
    FROM ({_BREAKS})""")
def _(spark, d):
    return risk.legend_breaks(T.read(spark, d, "orders"), "o_totalprice")


# --- curves and metrics ---

SCORED_SQL = """
    x AS (SELECT o_orderkey, (o_orderkey * 37 % 1009) / 1009.0 AS score,
                 CASE WHEN o_orderkey * 91 % 1009 < o_orderkey * 37 % 1009 THEN 1 ELSE 0 END AS label,
                 o_totalprice FROM orders)"""


def _curve(score: str) -> str:
    """Per distinct score: tp and fp at or above it, and the totals."""
    return f"""{SCORED_SQL},
        g AS (SELECT {score} AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM x GROUP BY 1),
        k AS (SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
                     sum(pos) OVER () AS p, sum(neg) OVER () AS n
              FROM g WINDOW w AS (ORDER BY threshold DESC))"""


_ROC = """SELECT threshold, fp / CAST(n AS DOUBLE) AS fpr, tp / CAST(p AS DOUBLE) AS tpr FROM k
          UNION ALL SELECT max(threshold) + 1, 0.0, 0.0 FROM k"""
_AUC = """SELECT sum(neg * (tp - pos + pos / 2.0)) / (max(p) * CAST(max(n) AS DOUBLE)) AS auc FROM k"""


def scored(spark, d, by_price: bool = False) -> DataFrame:
    key = F.col("o_orderkey")
    score = F.col("o_totalprice") if by_price else key * 37 % 1009 / F.lit(1009.0)
    label = F.when(key * 91 % 1009 < key * 37 % 1009, 1).otherwise(0)
    return T.read(spark, d, "orders").select("o_orderkey", score.alias("score"), label.alias("label"))


@query("roc_curve", "threshold f, fpr f, tpr f", f"WITH {_curve('score')} {_ROC}")
def _(spark, d):
    return evaluation.roc_curve(scored(spark, d))


@query("roc_auc", "auc f", f"WITH {_curve('score')} {_AUC}")
def _(spark, d):
    return evaluation.roc_auc(scored(spark, d))


@query("pr_curve", "threshold f, precision f, recall f", f"""
    WITH {_curve('score')}
    SELECT threshold, tp / CAST(tp + fp AS DOUBLE) AS precision, tp / CAST(p AS DOUBLE) AS recall
    FROM k WHERE tp < p OR pos > 0 UNION ALL SELECT NULL, 1.0, 0.0""")
def _(spark, d):
    return evaluation.precision_recall_curve(scored(spark, d))


@query("threshold_metrics", "recall f, precision f, f1 f", f"""
    WITH {SCORED_SQL}, m AS (SELECT count(*) FILTER (score > 0.5 AND label = 1) AS tp,
        count(*) FILTER (score > 0.5 AND label = 0) AS fp, count(*) FILTER (score <= 0.5 AND label = 1) AS fn FROM x)
    SELECT tp / CAST(tp + fn AS DOUBLE) AS recall, tp / CAST(tp + fp AS DOUBLE) AS precision,
           2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) AS f1 FROM m""")
def _(spark, d):
    return evaluation.threshold_metrics(scored(spark, d))


@query("model_compare_curves", "model s, threshold f, fpr f, tpr f, auc f", f"""
    SELECT 'residue' AS model, * FROM (WITH {_curve('score')} SELECT q.*, (SELECT auc FROM ({_AUC})) AS auc FROM ({_ROC}) q)
    UNION ALL
    SELECT 'price', * FROM (WITH {_curve('o_totalprice')} SELECT q.*, (SELECT auc FROM ({_AUC})) FROM ({_ROC}) q)""")
def _(spark, d):
    return evaluation.compare_models(
        {"residue": scored(spark, d), "price": scored(spark, d, by_price=True)}
    )


@query("class_weights", "label i, n i, weight f", f"""
    WITH {SCORED_SQL} SELECT label, count(*) AS n, (SELECT count(*) FROM x) / (2.0 * count(*)) AS weight
    FROM x GROUP BY 1""")
def _(spark, d):
    return M.class_weights(scored(spark, d))


@query("stratified_folds", "o_orderkey i, label i, fold i", f"""
    WITH {SCORED_SQL} SELECT o_orderkey, label,
        ntile(5) OVER (PARTITION BY label ORDER BY o_orderkey) - 1 AS fold FROM x""")
def _(spark, d):
    return M.stratified_folds(scored(spark, d), "o_orderkey")


@query("hash_split", "o_orderkey i, is_test i", """
    SELECT o_orderkey, CASE WHEN left(md5(CAST(o_orderkey AS VARCHAR)), 8) < '4ccccccc'
                            THEN 1 ELSE 0 END AS is_test FROM orders""")
def _(spark, d):
    return M.hash_split(T.read(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@query("year_split", "block i, yr i, split s, label i", f"""
    WITH {ORDER_SQL} SELECT block, yr, CASE WHEN yr = 2000 THEN 'future' WHEN yr = 1999 THEN 'holdout'
           ELSE 'train' END AS split, CASE WHEN urgent >= 1 THEN 1 ELSE 0 END AS label
    FROM c WHERE yr <= 2000""")
def _(spark, d):
    return M.year_split(order_counts(spark, d), "urgent", 2000, "yr")


# --- risk products ---

_RISK_SQL = f"""
    score AS (SELECT "GISJOIN", c_custkey * 37 % 1009 / 100.9 AS score FROM
              (SELECT {T.TABLES['census_blocks'][1]['GISJOIN']} AS "GISJOIN", c_custkey FROM customer)),
    risk AS (SELECT *, CASE WHEN score > (SELECT score FROM score ORDER BY 1 DESC LIMIT 1 OFFSET {N})
                            THEN 1 ELSE 0 END AS highrisk FROM score)"""


def risk_table(spark, d) -> DataFrame:
    block = F.expr(T.TABLES["census_blocks"][1]["GISJOIN"])
    scores = T.read(spark, d, "customer").select(
        block.alias("GISJOIN"), (F.col("c_custkey") * 37 % 1009 / F.lit(100.9)).alias("score")
    )
    return risk.risk_map(scores, T.blocks(spark, d), N)


@query("risk_map", "GISJOIN s, score f, highrisk i, edges i", f"""
    WITH {_RISK_SQL}, e AS (SELECT block, count(*) AS edges FROM ({T.edges_sql()}) GROUP BY 1)
    SELECT r.*, e.edges FROM risk r JOIN e ON e.block = r."GISJOIN" """)
def _(spark, d):
    table = risk_table(spark, d)
    return table.withColumn("edges", F.size(F.expr(G.edges_of("rings"))))


@query("risk_at_locations", "event_id i, GISJOIN s, score f, highrisk i", f"""
    {GEO._SITES}, {_RISK_SQL}
    SELECT s.event_id, r."GISJOIN", r.score, r.highrisk FROM sites_p s
    LEFT JOIN hits h ON h.event_id = s.event_id LEFT JOIN risk r ON r."GISJOIN" = h."GISJOIN"
    WHERE s.px > -122.53 AND s.px < -122.35 AND s.py > 37.7 AND s.py < 37.84""")
def _(spark, d):
    return risk.risk_at_locations(T.logical(spark, d, "sites"), risk_table(spark, d), "event_id")


@query("geojson_features", "GISJOIN s, score f", f"""
    WITH {_RISK_SQL} SELECT "GISJOIN", score FROM risk WHERE highrisk = 1""")
def _(spark, d):
    """The high-risk layer as JSON features, read back."""
    layer = files.geojson_features(
        risk_table(spark, d).filter(F.col("highrisk") == 1), ["GISJOIN", "score"]
    )
    parsed = F.from_json("value", "properties struct<GISJOIN: string, score: double>")
    return layer.select(parsed.alias("f")).select("f.properties.*")


@query("fire_points", "Year i, n i, EF i, SF i, VF i", f"""
    WITH p AS ({GEO.POINTS_SQL['fires']}) SELECT "Year", count(*) AS n, sum("External_fire") AS "EF",
        sum("Structure_fire") AS "SF", sum("Vehicle_fire") AS "VF" FROM p GROUP BY 1""")
def _(spark, d):
    return risk.fire_points(GEO.points(spark, d, "fires")).groupBy("Year").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("EF", "SF", "VF")]
    )


@query("fire_overlay", "Lat f, Lon f", f"""
    WITH p AS ({GEO.POINTS_SQL['fires']}) SELECT py AS "Lat", px AS "Lon" FROM p
    WHERE "Year" = 2000 AND "External_fire" = 1""")
def _(spark, d):
    return risk.fire_overlay(GEO.points(spark, d, "fires"), "external", 2000)


@query("feature_map", "GISYEARJOI s, H7X001 i, parts i", f"""
    SELECT p."GISJOIN" || '2010' AS "GISYEARJOI", p."H7X001", CASE WHEN b.shape = 3 THEN 2 ELSE 1 END AS parts
    FROM ({GEO.CENSUS_SQL}) p JOIN ({T.table_sql('census_blocks')}) b ON b."GISJOIN" = p."GISJOIN" """)
def _(spark, d):
    years = census.census_per_block_year(
        T.logical(spark, d, "census_population"), T.logical(spark, d, "census_tenure")
    ).withColumn("GISYEARJOIN", C.block_year_key("GISJOIN", P.YEAR))
    shapes = P.year_spine(T.blocks(spark, d).select("GISJOIN", "rings"), 2010, 2010)  # the year shown
    shapes = shapes.select(C.block_year_key("GISJOIN", P.YEAR).alias("GISYEARJOI"), "rings")
    joined = risk.feature_map(years, shapes, "H7X001", 2010)
    return joined.withColumn("parts", F.size("rings"))
