"""Queries on lines, customer features, labels and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens import config
from custlens.operators import cleaning, customers, eda, encoding, simple_models
from custlens.operators.splits import train_test
from custlens.plans.registry import register
from custlens.runtime import materialize
from custlens.sources import retail
from custlens.sources import starschema as star

CUTOFF, SNAPSHOT, WINDOW = star.CUTOFF, star.SNAPSHOT, star.WINDOW_DAYS

RAW_SQL = """
raw AS (
  SELECT concat(CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END, o_orderkey) AS "Invoice",
         CAST(l_partkey AS VARCHAR) AS "StockCode", p_name AS "Description", p_type, p_brand,
         l_quantity AS "Quantity", o_orderdate AS "InvoiceDate", l_extendedprice / l_quantity AS "Price",
         CAST(o_custkey AS DOUBLE) AS "Customer ID", n_name AS "Country"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey)"""

CLEAN_SQL = RAW_SQL + """,
valid AS (
  SELECT * EXCLUDE ("Customer ID"), CAST("Customer ID" AS BIGINT) AS "CustomerID" FROM raw
  WHERE NOT starts_with("Invoice", 'C') AND "Quantity" > 0 AND "Price" > 0 AND "Customer ID" IS NOT NULL),
bounds AS (
  SELECT quantile_cont("Quantity", 0.01) AS ql, quantile_cont("Quantity", 0.99) AS qh,
         quantile_cont("Price", 0.01) AS pl, quantile_cont("Price", 0.99) AS ph FROM valid),
clean AS (
  SELECT "Invoice", trim("StockCode") AS "StockCode", trim("Description") AS "Description", p_type, p_brand,
         least(greatest("Quantity", ql), qh) AS "Quantity", "InvoiceDate", least(greatest("Price", pl), ph) AS "Price",
         "CustomerID", trim("Country") AS "Country",
         least(greatest("Quantity", ql), qh) * least(greatest("Price", pl), ph) AS "TotalAmount"
  FROM valid, bounds WHERE "InvoiceDate" IS NOT NULL)"""


def features_sql(source: str, snapshot: str, prefix: str = "") -> str:
    """CTEs ending in {prefix}features, from lines in `source`."""
    p = prefix
    return f"""
{p}inv AS (
  SELECT "CustomerID", "Invoice", max("InvoiceDate") AS last, sum("TotalAmount") AS value, sum("Quantity") AS items
  FROM {source} GROUP BY ALL),
{p}per AS (
  SELECT "CustomerID", CAST(floor(date_diff('microsecond', max(last), TIMESTAMP '{snapshot}') / 86400000000.0) AS INTEGER) AS "Recency",
         count(*) AS "Frequency", sum(value) AS "Monetary", avg(value) AS avg_basket_value, avg(items) AS avg_basket_size
  FROM {p}inv GROUP BY ALL),
{p}variety AS (SELECT "CustomerID", count(DISTINCT "StockCode") AS unique_products FROM {source} GROUP BY ALL),
{p}land AS (
  SELECT "CustomerID", "Country" AS "DominantCountry" FROM (
    SELECT "CustomerID", "Country", row_number() OVER (PARTITION BY "CustomerID" ORDER BY count(*) DESC, "Country") AS r
    FROM {source} GROUP BY "CustomerID", "Country") WHERE r = 1),
{p}features AS (SELECT * FROM {p}per JOIN {p}variety USING ("CustomerID") JOIN {p}land USING ("CustomerID"))"""


FULL_SQL = CLEAN_SQL + "," + features_sql("clean", "2001-08-02", "full_")
PRE_SQL = CLEAN_SQL + """,
history AS (SELECT * FROM clean WHERE "InvoiceDate" < TIMESTAMP '2001-01-01'),""" + features_sql("history", "2001-01-01")
LABEL_SQL = """
labelled AS (
  SELECT "CustomerID", CAST(1 - max(CASE WHEN "InvoiceDate" >= TIMESTAMP '2001-01-01' THEN 1 ELSE 0 END) AS INTEGER) AS churn
  FROM clean WHERE "InvoiceDate" < TIMESTAMP '2001-01-01' + INTERVAL 180 DAY
  GROUP BY ALL HAVING min("InvoiceDate") < TIMESTAMP '2001-01-01')"""
FRAME_SQL = PRE_SQL + "," + LABEL_SQL + """,
frame AS (
  SELECT "CustomerID", "Recency", "Frequency", "Monetary", avg_basket_value, avg_basket_size, unique_products,
         "DominantCountry", churn
  FROM features JOIN labelled USING ("CustomerID"))"""

MONEY = {"Monetary": 4, "avg_basket_value": 4, "avg_basket_size": 6}
FEATURES = '"CustomerID", "Recency", "Frequency", "Monetary", avg_basket_value, avg_basket_size, unique_products, "DominantCountry"'


def clip_bounds(spark: SparkSession, d: str) -> dict:
    """Bounds need only quantity, price, invoice and id, so they are fitted on lines without the item joins."""
    return cleaning.winsor_bounds(star.raw_lines(spark, d, described=False))


def clean_lines(spark: SparkSession, d: str, item: str = "l_partkey", bounds: dict | None = None) -> DataFrame:
    return cleaning.clean(star.raw_lines(spark, d, item), bounds=bounds or clip_bounds(spark, d))


def basket_lines(spark: SparkSession, d: str, item: str) -> DataFrame:
    """Clean lines for basket work, which reads no quantity or price: clipping is left out."""
    return cleaning.clean(star.raw_lines(spark, d, item), q=None)


def typed_lines(spark: SparkSession, d: str, lines: DataFrame) -> DataFrame:
    """Invoice, part type as code, and description of each clean line, whose code is its part's key: the lines are not joined anew."""
    part = star.table(spark, d, "part")
    if star.repeats(part, "p_partkey"):  # the lines are repeated by this join already
        return basket_lines(spark, d, "p_type").select("Invoice", "StockCode", "Description")
    named = part.select(F.col("p_partkey").cast("string").alias("_part"), *[F.trim(F.col(c).cast("string")).alias(n) for c, n in (("p_type", "StockCode"), ("p_name", "Description"))])
    return lines.select("Invoice", F.col("StockCode").alias("_part")).join(named, "_part", "left").drop("_part")


def feature_lines(spark: SparkSession, d: str) -> DataFrame:
    """Clean lines without item texts. The joined lines are written once, for the clip bounds, both branches of the features, and the labels."""
    valid = materialize(cleaning.keep_valid(star.raw_lines(spark, d, texts=False)))
    # lines that a join repeats have no part in the bounds
    bounds = clip_bounds(spark, d) if star.repeated_lines(spark, d) else cleaning.bounds_of(valid)
    return cleaning.finish(valid, bounds)


def full_features(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    return customers.customer_features(feature_lines(spark, d) if lines is None else lines, SNAPSHOT)


def pre_features(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    return customers.pre_cutoff_features(feature_lines(spark, d) if lines is None else lines, CUTOFF)


def dated_lines(spark: SparkSession, d: str) -> DataFrame:
    """Customer and date of each valid line, without the item joins: enough where it does not matter how often a line counts."""
    valid = cleaning.keep_valid(star.raw_lines(spark, d, described=False))
    return valid.select("CustomerID", cleaning.invoice_time(valid).alias("InvoiceDate"))


def labels(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    """Labels read only ids and dates, and the first and last line decide, so unclipped and unjoined lines do."""
    return customers.churn_labels(dated_lines(spark, d) if lines is None else lines, CUTOFF, WINDOW)


def frame(spark: SparkSession, d: str) -> DataFrame:
    lines = feature_lines(spark, d)
    return customers.supervised_frame(pre_features(spark, d, lines), labels(spark, d, lines))


def stored_frame(spark: SparkSession, d: str) -> DataFrame:
    """The supervised frame as a stage table, for jobs that read it many times."""
    return materialize(frame(spark, d))


def given_segments(spark: SparkSession, d: str) -> DataFrame:
    """Market segments numbered alphabetically stand for fitted segments where values are checked."""
    customer = star.table(spark, d, "customer")
    names = [r[0] for r in customer.select("c_mktsegment").distinct().orderBy("c_mktsegment").collect()]
    cluster = F.array_position(F.lit(names), F.col("c_mktsegment")).cast("int") - 1
    return customer.select(F.col("c_custkey").alias("CustomerID"), cluster.alias("cluster"))


SEGMENT_SQL = """
segments AS (SELECT c_custkey AS "CustomerID", CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS cluster FROM customer)"""

LINE_COLUMNS = '"Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "CustomerID", "Country", "TotalAmount"'


@register("clean_lines", f"WITH {CLEAN_SQL} SELECT {LINE_COLUMNS} FROM clean", {"Price": 8, "TotalAmount": 6})
def _(spark, d):
    return clean_lines(spark, d)


@register("clean_lines_fit_before_cutoff", "WITH " + CLEAN_SQL.replace("AS ph FROM valid)", "AS ph FROM valid WHERE \"InvoiceDate\" < TIMESTAMP '2001-01-01')") + f" SELECT {LINE_COLUMNS} FROM clean", {"Price": 8, "TotalAmount": 6})
def _(spark, d):
    return cleaning.clean(star.raw_lines(spark, d), fit_before=CUTOFF)


@register("raw_union", f"""
WITH {RAW_SQL} SELECT CAST(year("InvoiceDate") AS INTEGER) AS year, count(*) AS n_lines, sum("Quantity") AS units FROM raw GROUP BY ALL""", {"units": 3})
def _(spark, d):
    raw = star.raw_lines(spark, d)
    older = raw.filter(F.col("InvoiceDate") < customers.moment(CUTOFF))
    newer = raw.filter(F.coalesce(F.col("InvoiceDate") >= customers.moment(CUTOFF), F.lit(True)))  # undated lines too
    both = retail.union_parts(retail.trim_names(older), retail.trim_names(newer))
    return both.groupBy(F.year("InvoiceDate").alias("year")).agg(F.count("*").alias("n_lines"), F.sum("Quantity").alias("units"))


@register("cleaning_audit", f"""
WITH {RAW_SQL}, f AS (
  SELECT *, "Customer ID" IS NULL AS no_id, starts_with("Invoice", 'C') AS cancelled, NOT ("Quantity" > 0 AND "Price" > 0) AS bad FROM raw)
SELECT count(*) AS n_raw, avg(CAST(no_id AS INTEGER)) AS missing_id_share, avg(CAST(cancelled AS INTEGER)) AS cancelled_share,
       avg(CAST(bad AS INTEGER)) AS non_positive_share,
       sum(CASE WHEN no_id THEN "Quantity" ELSE 0.0 END) / sum("Quantity") AS missing_id_unit_share,
       sum(CASE WHEN no_id THEN "Quantity" * "Price" ELSE 0.0 END) / sum("Quantity" * "Price") AS missing_id_revenue_share,
       avg(CAST(no_id OR cancelled OR bad AS INTEGER)) AS removed_share
FROM f""", dict.fromkeys(["missing_id_share", "cancelled_share", "non_positive_share", "missing_id_unit_share", "missing_id_revenue_share", "removed_share"], 9))
def _(spark, d):
    return cleaning.cleaning_audit(star.raw_lines(spark, d))


@register("raw_vs_clean", f"""
WITH {CLEAN_SQL}
SELECT 'raw' AS stage, count(*) AS n_lines, count(DISTINCT "Customer ID") AS n_customers, count(DISTINCT "Invoice") AS n_invoices,
       count(DISTINCT "StockCode") AS n_codes, count(DISTINCT "Country") AS n_countries FROM raw
UNION ALL
SELECT 'clean', count(*), count(DISTINCT "CustomerID"), count(DISTINCT "Invoice"), count(DISTINCT "StockCode"), count(DISTINCT "Country") FROM clean""")
def _(spark, d):
    return cleaning.raw_vs_clean(star.raw_lines(spark, d), basket_lines(spark, d, "l_partkey"))


@register("null_counts", f"WITH {RAW_SQL}" + " UNION ALL ".join(
    f""" SELECT '{c}' AS column_name, count(*) - count("{c}") AS n_null FROM raw""" for c in
    ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]))
def _(spark, d):
    return cleaning.null_counts(star.raw_lines(spark, d))


@register("feature_summary", f"WITH {FULL_SQL}" + " UNION ALL ".join(
    f""" SELECT '{c}' AS feature, count("{c}") AS n, avg("{c}") AS mean, stddev_samp("{c}") AS std, CAST(min("{c}") AS DOUBLE) AS min,
      quantile_cont(CAST("{c}" AS DOUBLE), 0.25) AS q25, quantile_cont(CAST("{c}" AS DOUBLE), 0.5) AS q50, quantile_cont(CAST("{c}" AS DOUBLE), 0.75) AS q75,
      CAST(max("{c}") AS DOUBLE) AS max FROM full_features""" for c in config.NUMERIC), dict.fromkeys(["mean", "std", "min", "q25", "q50", "q75", "max"], 4))
def _(spark, d):
    return cleaning.describe(full_features(spark, d), config.NUMERIC)


@register("rfm_full_history", f"""WITH {FULL_SQL} SELECT "CustomerID", "Recency", "Frequency", "Monetary" FROM full_per""", {"Monetary": 3})
def _(spark, d):
    return customers.rfm(clean_lines(spark, d), SNAPSHOT)


@register("rfm_events", """
SELECT user_id AS "CustomerID", CAST(floor(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01') / 86400000000.0) AS INTEGER) AS "Recency",
       count(DISTINCT event_id) AS "Frequency", sum(value) AS "Monetary"
FROM events WHERE event_type = 'purchase' GROUP BY user_id""", {"Monetary": 4})
def _(spark, d):
    from datetime import datetime

    return customers.rfm(star.event_lines(spark, d), datetime(2024, 2, 1))


@register("basket_behavior", f"""WITH {FULL_SQL} SELECT "CustomerID", avg_basket_value, avg_basket_size FROM full_per""", {"avg_basket_value": 4, "avg_basket_size": 6})
def _(spark, d):
    return customers.basket_behaviour(clean_lines(spark, d))


@register("product_variety", f"WITH {FULL_SQL} SELECT * FROM full_variety")
def _(spark, d):
    return customers.product_variety(basket_lines(spark, d, "l_partkey"))


@register("dominant_country", f"WITH {FULL_SQL} SELECT * FROM full_land")
def _(spark, d):
    return customers.dominant_country(basket_lines(spark, d, "l_partkey"))


@register("customer_features", f"WITH {FULL_SQL} SELECT {FEATURES} FROM full_features", MONEY)
def _(spark, d):
    return full_features(spark, d)


@register("pre_cutoff_features", f"WITH {PRE_SQL} SELECT {FEATURES} FROM features", MONEY)
def _(spark, d):
    return pre_features(spark, d)


@register("churn_labels", f"WITH {CLEAN_SQL},{LABEL_SQL} SELECT * FROM labelled")
def _(spark, d):
    return labels(spark, d)


@register("supervised_frame", f"WITH {FRAME_SQL} SELECT * FROM frame", MONEY)
def _(spark, d):
    return frame(spark, d)


MATRIX_SQL = FULL_SQL + """,
logged AS (SELECT "CustomerID", CAST("Recency" AS DOUBLE) AS r, ln(1 + "Frequency") AS f, ln(1 + "Monetary") AS m FROM full_features),
matrix AS (
  SELECT "CustomerID", (r - avg(r) OVER ()) / stddev_pop(r) OVER () AS "Recency", (f - avg(f) OVER ()) / stddev_pop(f) OVER () AS "Frequency",
         (m - avg(m) OVER ()) / stddev_pop(m) OVER () AS "Monetary" FROM logged)"""
SCALED = {"Recency": 8, "Frequency": 8, "Monetary": 8}


@register("log1p_features", f"""WITH {FULL_SQL} SELECT "CustomerID", "Recency", ln(1 + "Frequency") AS "Frequency", ln(1 + "Monetary") AS "Monetary" FROM full_features""", {"Frequency": 9, "Monetary": 9})
def _(spark, d):
    return encoding.log1p_columns(full_features(spark, d).select("CustomerID", *config.RFM))


@register("log_scaled_matrix", f"WITH {MATRIX_SQL} SELECT * FROM matrix", SCALED)
def _(spark, d):
    return encoding.clustering_matrix(full_features(spark, d))


ENCODED_COLUMNS = ["Frequency", "Monetary", "avg_basket_value", "avg_basket_size", "unique_products", "Recency"]
SPLIT_SQL = FRAME_SQL + """,
hashed AS (SELECT *, substr(md5(concat('42|', "CustomerID")), 1, 15) AS h FROM frame),
ordered AS (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY h, "CustomerID") AS r, count(*) OVER (PARTITION BY churn) AS n FROM hashed),
split AS (SELECT *, r <= floor(0.8 * n + 1e-9) AS is_train FROM ordered)"""
ENCODED_SQL = SPLIT_SQL + """,
tr AS (SELECT * FROM split WHERE is_train),
st AS (SELECT avg(ln(1 + "Frequency")) mf, stddev_pop(ln(1 + "Frequency")) sf, avg(ln(1 + "Monetary")) mm, stddev_pop(ln(1 + "Monetary")) sm,
  avg(ln(1 + avg_basket_value)) mv, stddev_pop(ln(1 + avg_basket_value)) sv, avg(ln(1 + avg_basket_size)) mb, stddev_pop(ln(1 + avg_basket_size)) sb,
  avg(ln(1 + unique_products)) mu, stddev_pop(ln(1 + unique_products)) su, avg("Recency") mr, stddev_pop("Recency") sr, count(*) AS n FROM tr),
kept AS (SELECT "DominantCountry" AS c FROM tr GROUP BY 1 HAVING count(*) >= 0.05 * (SELECT n FROM st)),
rare AS (SELECT count(*) > 0 AS any_rare FROM tr WHERE "DominantCountry" NOT IN (SELECT c FROM kept)),
encoded AS (
  SELECT "CustomerID", is_train, (ln(1 + "Frequency") - mf) / sf AS "Frequency", (ln(1 + "Monetary") - mm) / sm AS "Monetary",
    (ln(1 + avg_basket_value) - mv) / sv AS avg_basket_value, (ln(1 + avg_basket_size) - mb) / sb AS avg_basket_size,
    (ln(1 + unique_products) - mu) / su AS unique_products, ("Recency" - mr) / sr AS "Recency",
    CASE WHEN "DominantCountry" IN (SELECT c FROM kept) THEN "DominantCountry" WHEN (SELECT any_rare FROM rare) THEN 'infrequent' END AS country_slot
  FROM split, st)"""


def split_frame(spark, d) -> DataFrame:
    return train_test(stored_frame(spark, d), seed=config.SEED)


@register("encoded_features", f'WITH {ENCODED_SQL} SELECT "CustomerID", "Frequency", "Monetary", avg_basket_value, avg_basket_size, unique_products, "Recency", country_slot FROM encoded', dict.fromkeys(ENCODED_COLUMNS, 8))
def _(spark, d):
    """The one-hot slots are read back as the name of the slot that is 1, so the columns do not depend on the data."""
    split = split_frame(spark, d)
    model = encoding.ChurnEncoder(rareShare=0.05).fit(split.filter("is_train"))
    wide = model.columns_frame(split, "CustomerID")
    slots = [s for s in model.slots if s.startswith(config.COUNTRY)]
    name = F.coalesce(*[F.when(F.col(s) == 1, s.removeprefix(config.COUNTRY + "_")) for s in slots])
    return wide.select("CustomerID", *ENCODED_COLUMNS, name.alias("country_slot"))


@register("topk_country_dummies", f"""
WITH {FRAME_SQL}, top AS (SELECT "DominantCountry" AS c, row_number() OVER (ORDER BY count(*) DESC, "DominantCountry") AS r FROM frame GROUP BY 1 QUALIFY r <= 5)
SELECT "CustomerID", CAST("Recency" AS DOUBLE) AS "Recency", ln(1 + "Frequency") AS "Frequency", ln(1 + "Monetary") AS "Monetary",
       avg_basket_value, avg_basket_size, CAST(unique_products AS DOUBLE) AS unique_products,
       coalesce((SELECT c FROM top WHERE c = "DominantCountry"), 'Other') AS country, churn FROM frame""",
          {"Frequency": 8, "Monetary": 8, "avg_basket_value": 4, "avg_basket_size": 6})
def _(spark, d):
    lines = feature_lines(spark, d)
    wide = encoding.topk_country_dummies(pre_features(spark, d, lines), labels(spark, d, lines))
    dummies = [c for c in wide.columns if c.startswith("country_")]
    name = F.coalesce(*[F.when(F.col(c) == 1, c.removeprefix("country_")) for c in dummies])
    return wide.select("CustomerID", *config.NUMERIC, name.alias("country"), "churn")


AUC_SQL = """SELECT sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS "AUC" FROM (
  SELECT score, sum(label) AS pos, sum(1 - label) AS neg, sum(sum(1 - label)) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - sum(1 - label) AS below
  FROM {scored} GROUP BY score)"""


@register("leakage_probe_auc", f"""
WITH {FRAME_SQL}, {features_sql("clean", "2001-08-02", "full_").lstrip()},
a AS (SELECT churn AS label, f."Recency" AS score FROM full_features f JOIN labelled USING ("CustomerID")),
b AS (SELECT churn AS label, "Recency" AS score FROM frame)
SELECT 'full_history' AS basis, "AUC" FROM ({AUC_SQL.format(scored='a')}) UNION ALL SELECT 'pre_cutoff', "AUC" FROM ({AUC_SQL.format(scored='b')})""", {"AUC": 9})
def _(spark, d):
    lines = feature_lines(spark, d)
    return simple_models.leakage_probe(customers.customer_features(lines, SNAPSHOT), pre_features(spark, d, lines), labels(spark, d, lines))


@register("monthly_revenue", f"""WITH {CLEAN_SQL} SELECT CAST(date_trunc('month', "InvoiceDate") AS DATE) AS month, sum("TotalAmount") AS revenue FROM clean GROUP BY 1""", {"revenue": 2})
def _(spark, d):
    return eda.monthly_revenue(clean_lines(spark, d))


@register("top_products", f"""WITH {CLEAN_SQL} SELECT "StockCode", sum("TotalAmount") AS revenue FROM clean GROUP BY 1 ORDER BY revenue DESC, "StockCode" LIMIT 10""", {"revenue": 3})
def _(spark, d):
    return eda.top_products(clean_lines(spark, d))


@register("top_export_countries", f"""WITH {CLEAN_SQL} SELECT "Country", sum("TotalAmount") AS revenue FROM clean WHERE "Country" <> 'NATION_0' GROUP BY 1 ORDER BY revenue DESC, "Country" LIMIT 10""", {"revenue": 2})
def _(spark, d):
    return eda.top_export_countries(clean_lines(spark, d), home="NATION_0")


PARETO_SQL = CLEAN_SQL + """,
rev AS (SELECT "CustomerID", sum("TotalAmount") AS revenue FROM clean GROUP BY 1),
curve AS (
  SELECT "CustomerID", revenue, row_number() OVER w AS position, CAST(row_number() OVER w - 1 AS DOUBLE) / (count(*) OVER () - 1) AS customer_share,
         sum(revenue) OVER (w ROWS UNBOUNDED PRECEDING) / sum(revenue) OVER () AS revenue_share, count(*) OVER () AS n
  FROM rev WINDOW w AS (ORDER BY revenue DESC, "CustomerID"))"""


@register("pareto_curve", f'WITH {PARETO_SQL} SELECT "CustomerID", revenue, position, customer_share, revenue_share FROM curve', {"revenue": 3, "customer_share": 9, "revenue_share": 9})
def _(spark, d):
    return eda.pareto_curve(clean_lines(spark, d))


@register("pareto_top20", f"WITH {PARETO_SQL} SELECT revenue_share FROM curve WHERE position = CAST(floor(0.2 * n) AS BIGINT) + 1", {"revenue_share": 9})
def _(spark, d):
    return eda.pareto_share(clean_lines(spark, d))


def _histogram_sql(feature: str, value: str, source: str, bins: int) -> str:
    return f"""SELECT '{feature}' AS feature, CAST(least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INTEGER) AS bin,
      lo + CAST(least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INTEGER) * ((hi - lo) / {bins}) AS left_edge, count(*) AS n
      FROM (SELECT CAST({value} AS DOUBLE) AS v FROM {source}), (SELECT CAST(min({value}) AS DOUBLE) AS lo, CAST(max({value}) AS DOUBLE) AS hi FROM {source}) GROUP BY ALL"""


@register("amount_histogram", f"WITH {CLEAN_SQL} " + " UNION ALL ".join(_histogram_sql(c, f'"{c}"', "clean", 60) for c in ["Quantity", "Price", "TotalAmount"]), {"left_edge": 3})
def _(spark, d):
    return eda.histogram(clean_lines(spark, d), ["Quantity", "Price", "TotalAmount"], 60)


@register("rfm_histogram", f"WITH {FULL_SQL} " + " UNION ALL ".join(
    _histogram_sql(c, v, "full_features", 40) for c, v in [("Recency", '"Recency"'), ("Frequency", 'ln(1 + "Frequency")'), ("Monetary", 'ln(1 + "Monetary")')]), {"left_edge": 6})
def _(spark, d):
    return eda.histogram(full_features(spark, d), config.RFM, 40, log=("Frequency", "Monetary"))


@register("segment_product_share", f"""
WITH {CLEAN_SQL},{SEGMENT_SQL}, sold AS (SELECT cluster, "StockCode", sum("Quantity") AS units FROM clean JOIN segments USING ("CustomerID") GROUP BY ALL),
top AS (SELECT "StockCode" FROM sold GROUP BY 1 ORDER BY sum(units) DESC, "StockCode" LIMIT 15),
grid AS (SELECT c.cluster, t."StockCode", coalesce(s.units, 0) AS units FROM (SELECT DISTINCT cluster FROM sold WHERE "StockCode" IN (SELECT "StockCode" FROM top)) c
         CROSS JOIN top t LEFT JOIN sold s ON s.cluster = c.cluster AND s."StockCode" = t."StockCode")
SELECT cluster, "StockCode", units / sum(units) OVER (PARTITION BY cluster) AS share FROM grid""", {"share": 9})
def _(spark, d):
    return eda.segment_product_share(clean_lines(spark, d), given_segments(spark, d))
