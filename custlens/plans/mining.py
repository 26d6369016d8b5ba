"""Queries on baskets and rules. Items are part types where rules must exist, brands where popularity must filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.operators import baskets, eda, rules
from custlens.plans.lines import CLEAN_SQL, SEGMENT_SQL, basket_lines, given_segments, typed_lines
from custlens.plans.registry import register
from custlens.runtime import materialize

SUPPORT, CONFIDENCE, LIFT = 0.02, 0.1, 0.7
POPULAR = (0.11, 50)

# Baskets as bit masks over the (few) part types; every mask is tried, so the SQL is independent of level-wise mining.
MASK_SQL = CLEAN_SQL + """,
item AS (SELECT it, CAST(dense_rank() OVER (ORDER BY it) - 1 AS INTEGER) AS i FROM (SELECT DISTINCT p_type AS it FROM clean)),
masked AS (
  SELECT grp, "Invoice", CAST(sum(CAST(1 AS BIGINT) << i) AS BIGINT) AS m
  FROM (SELECT DISTINCT {grp} AS grp, "Invoice", p_type AS it FROM {source}) JOIN item USING (it) GROUP BY ALL),
total AS (SELECT grp, count(*) AS n_baskets FROM masked GROUP BY 1),
mask AS (SELECT unnest(range(1, CAST(1 AS BIGINT) << (SELECT count(*)::INTEGER FROM item))) AS mask),
freq AS (
  SELECT masked.grp, mask, count(*) AS freq, any_value(n_baskets) AS n_baskets FROM masked JOIN mask ON (m & mask) = mask
  JOIN total ON total.grp = masked.grp GROUP BY masked.grp, mask HAVING count(*) >= 0.02 * any_value(n_baskets)),
name AS (SELECT mask, string_agg(it, '|' ORDER BY it) AS items FROM mask JOIN item ON (mask >> i) & 1 = 1 GROUP BY mask),
rule0 AS (
  SELECT f.grp, a.mask AS am, c.mask AS cm, a.freq / a.n_baskets AS antecedent_support, c.freq / c.n_baskets AS consequent_support,
         f.freq / f.n_baskets AS support
  FROM freq f JOIN freq a ON a.grp = f.grp AND (a.mask & f.mask) = a.mask AND a.mask <> f.mask JOIN freq c ON c.grp = f.grp AND c.mask = f.mask - a.mask),
rule AS (
  SELECT *, confidence / consequent_support AS lift FROM (SELECT *, support / antecedent_support AS confidence FROM rule0)
  WHERE confidence >= 0.1 AND confidence / consequent_support >= 0.7),
measured AS (
  SELECT r.grp, a.items AS antecedents, c.items AS consequents, antecedent_support, consequent_support, support, confidence, lift,
    CAST(1.0 AS DOUBLE) AS representativity, support - antecedent_support * consequent_support AS leverage,
    CASE WHEN confidence >= 1 THEN CAST('infinity' AS DOUBLE) ELSE (1 - consequent_support) / (1 - confidence) END AS conviction,
    CASE WHEN greatest(support * (1 - antecedent_support), antecedent_support * (consequent_support - support)) = 0 THEN 0.0
      ELSE (support - antecedent_support * consequent_support) / greatest(support * (1 - antecedent_support), antecedent_support * (consequent_support - support)) END AS zhangs_metric,
    support / (antecedent_support + consequent_support - support) AS jaccard,
    (confidence - consequent_support) / (1 - consequent_support) AS certainty,
    (support / antecedent_support + support / consequent_support) / 2 AS kulczynski
  FROM rule r JOIN name a ON a.mask = am JOIN name c ON c.mask = cm),
best AS (SELECT * FROM measured QUALIFY row_number() OVER (PARTITION BY grp, consequents ORDER BY lift DESC, confidence DESC, support DESC, antecedents, consequents) = 1)"""
ALL_SQL = MASK_SQL.replace("{grp}", "0").replace("{source}", "clean")
BY_SEGMENT_SQL = MASK_SQL.replace("{grp}", "cluster").replace("{source}", 'clean JOIN segments USING ("CustomerID")')
BY_SEGMENT_SQL = BY_SEGMENT_SQL.replace("\nitem AS", SEGMENT_SQL + ",\nitem AS")
ORDER = "lift DESC, confidence DESC, support DESC, antecedents, consequents"
SHARES = dict.fromkeys(["antecedent_support", "consequent_support", "support", "confidence", "lift"], 9)
MEASURES = {**SHARES, **dict.fromkeys(["representativity", "leverage", "conviction", "zhangs_metric", "jaccard", "certainty", "kulczynski"], 9)}
DESCRIBE_SQL = """,
described AS (SELECT code, "Description" FROM (
  SELECT p_type AS code, "Description", row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, "Description") AS r FROM clean GROUP BY 1, 2) WHERE r = 1)"""


def names_sql(side: str) -> str:
    return f"""(SELECT string_agg(nm, ', ' ORDER BY nm) FROM (SELECT DISTINCT left(coalesce("Description", c), 40) AS nm FROM (SELECT unnest(string_split({side}, '|')) AS c) LEFT JOIN described ON code = c))"""


def type_baskets(spark, d) -> DataFrame:
    return baskets.long_baskets(basket_lines(spark, d, "p_type"))


def mined_rules(spark, d, lines: DataFrame | None = None) -> DataFrame:
    long = type_baskets(spark, d) if lines is None else baskets.long_baskets(lines)
    return rules.association_rules(baskets.apriori(materialize(long), SUPPORT), CONFIDENCE, LIFT)


def described_rules(spark, d, lines: DataFrame | None = None) -> DataFrame:
    """The best rules with the descriptions of their items, both from one written table of basket lines; stored clean `lines` with part keys as codes save joining them."""
    typed = basket_lines(spark, d, "p_type").select("Invoice", "StockCode", "Description") if lines is None else typed_lines(spark, d, lines)
    typed = materialize(typed)
    return rules.describe_rules(rules.top_rules(rules.prune(mined_rules(spark, d, typed))), rules.code_descriptions(typed))


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Item lists as text, for comparison with SQL."""
    return df.withColumns({c: F.array_join(c, "|") for c in columns})


@register("popular_items", f"""
WITH {CLEAN_SQL}, c AS (SELECT p_brand AS "StockCode", count(DISTINCT "Invoice") AS n_invoices FROM clean GROUP BY 1)
SELECT * FROM c WHERE n_invoices >= greatest(50, floor(0.11 * (SELECT count(DISTINCT "Invoice") FROM clean)))""")
def _(spark, d):
    return baskets.popular_items(basket_lines(spark, d, "p_brand"), *POPULAR)


@register("popular_lines", f"""
WITH {CLEAN_SQL}, c AS (SELECT p_brand AS "StockCode", count(DISTINCT "Invoice") AS n_invoices FROM clean GROUP BY 1),
p AS (SELECT * FROM c WHERE n_invoices >= greatest(50, floor(0.11 * (SELECT count(DISTINCT "Invoice") FROM clean))))
SELECT p_brand AS "StockCode", count(*) AS n_lines, count(DISTINCT "Invoice") AS n_invoices FROM clean WHERE p_brand IN (SELECT "StockCode" FROM p) GROUP BY 1""")
def _(spark, d):
    lines = basket_lines(spark, d, "p_brand")
    kept = baskets.keep_popular(lines, baskets.popular_items(lines, *POPULAR))
    return kept.groupBy("StockCode").agg(F.count("*").alias("n_lines"), F.count_distinct("Invoice").alias("n_invoices"))


@register("baskets", f"""WITH {CLEAN_SQL} SELECT "Invoice", string_agg(it, '|' ORDER BY it) AS items FROM (SELECT DISTINCT "Invoice", p_type AS it FROM clean) GROUP BY 1""")
def _(spark, d):
    return as_text(baskets.baskets(basket_lines(spark, d, "p_type")), "items")


@register("baskets_long", f"""WITH {CLEAN_SQL} SELECT DISTINCT 0 AS grp, "Invoice", p_type AS item FROM clean""")
def _(spark, d):
    return type_baskets(spark, d)


@register("baskets_wide", f"""
WITH {CLEAN_SQL} SELECT "Invoice", list_sort(list(DISTINCT p_type))[1] AS first_item, count(DISTINCT p_type) AS n_items FROM clean GROUP BY 1""")
def _(spark, d):
    """The sparse one-hot form, decoded again: the item of the first slot, and the number of slots."""
    long = materialize(type_baskets(spark, d))
    index = materialize(baskets.item_index(long))
    coded = baskets.encode(long, index).select("Invoice", F.element_at("slots", 1).alias("slot"), F.size("slots").cast("bigint").alias("n_items"))
    return coded.join(index, "slot").select("Invoice", F.col("item").alias("first_item"), "n_items")


ITEMSETS = f"WITH {ALL_SQL} SELECT items, freq, n_baskets, freq / n_baskets AS support FROM freq JOIN name USING (mask)"


@register("itemsets_apriori", ITEMSETS, {"support": 9})
def _(spark, d):
    return as_text(baskets.apriori(materialize(type_baskets(spark, d)), SUPPORT), "items").drop("grp")


@register("itemsets_fpgrowth", ITEMSETS, {"support": 9})
def _(spark, d):
    return as_text(baskets.fpgrowth(materialize(type_baskets(spark, d)), SUPPORT), "items").drop("grp")


@register("rules_all_measures", f"WITH {ALL_SQL} SELECT * EXCLUDE (grp) FROM measured", MEASURES)
def _(spark, d):
    return as_text(mined_rules(spark, d), "antecedents", "consequents").drop("grp")


@register("rules_pruned", f"WITH {ALL_SQL} SELECT antecedents, consequents, support, confidence, lift FROM best", {k: 9 for k in ("support", "confidence", "lift")})
def _(spark, d):
    pruned = rules.prune(mined_rules(spark, d))
    return as_text(pruned, "antecedents", "consequents").select("antecedents", "consequents", "support", "confidence", "lift")


@register("rules_top", f"WITH {ALL_SQL} SELECT antecedents, consequents, support, confidence, lift FROM best ORDER BY {ORDER} LIMIT 30", {k: 9 for k in ("support", "confidence", "lift")})
def _(spark, d):
    top = rules.top_rules(rules.prune(mined_rules(spark, d)))
    return as_text(top, "antecedents", "consequents").select("antecedents", "consequents", "support", "confidence", "lift")


@register("code_descriptions", f"WITH {CLEAN_SQL}{DESCRIBE_SQL} SELECT * FROM described")
def _(spark, d):
    return rules.code_descriptions(basket_lines(spark, d, "p_type"))


@register("rule_descriptions", f"""
WITH {ALL_SQL}{DESCRIBE_SQL} SELECT antecedents, consequents, {names_sql('antecedents')} AS antecedents_desc, {names_sql('consequents')} AS consequents_desc, lift FROM best""", {"lift": 9})
def _(spark, d):
    lines = basket_lines(spark, d, "p_type")
    named = rules.describe_rules(rules.prune(mined_rules(spark, d)), rules.code_descriptions(lines))
    return as_text(named, "antecedents", "consequents").select("antecedents", "consequents", "antecedents_desc", "consequents_desc", "lift")


@register("rule_graph_edges", f"""
WITH {ALL_SQL} SELECT replace(antecedents, '|', ', ') AS source, replace(consequents, '|', ', ') AS target, lift FROM best ORDER BY {ORDER} LIMIT 20""", {"lift": 9})
def _(spark, d):
    return eda.rule_edges(rules.prune(mined_rules(spark, d)))


def _by_segment(spark, d, min_invoices: int = 50, lift: float = LIFT):
    return rules.segment_rules(basket_lines(spark, d, "p_type"), given_segments(spark, d), SUPPORT, CONFIDENCE, lift, min_invoices)


@register("segment_rules", f"""
WITH {BY_SEGMENT_SQL} SELECT grp AS cluster, antecedents, consequents, support, confidence, lift FROM best
QUALIFY row_number() OVER (PARTITION BY grp ORDER BY {ORDER}) <= 10""", {k: 9 for k in ("support", "confidence", "lift")})
def _(spark, d):
    found, _ = _by_segment(spark, d)
    return as_text(found, "antecedents", "consequents").select("cluster", "antecedents", "consequents", "support", "confidence", "lift")


@register("segment_rule_status", f"""
WITH {BY_SEGMENT_SQL}, r AS (SELECT grp, least(10, count(*)) AS n_rules FROM best GROUP BY 1), big AS (SELECT max(n_baskets) AS n FROM total)
SELECT grp AS cluster, n_baskets, CASE WHEN n_baskets < n THEN 0 ELSE n_rules END AS n_rules,
       CASE WHEN n_baskets < n THEN concat('too few invoices: ', n_baskets, ' of ', n) END AS skip_reason FROM total JOIN r USING (grp), big""")
def _(spark, d):
    """The floor is set to the largest segment's invoices, so every other segment shows its reason."""
    lines, segments = basket_lines(spark, d, "p_type"), given_segments(spark, d)
    sizes = lines.join(segments, "CustomerID").groupBy("cluster").agg(F.count_distinct("Invoice").alias("n"))
    floor = sizes.agg(F.max("n")).first()[0]
    return _by_segment(spark, d, floor)[1]


@register("segment_rule_status_strict", f"""
WITH {BY_SEGMENT_SQL}, r AS (SELECT grp, count(*) AS n FROM best WHERE lift >= 1000 GROUP BY 1)
SELECT total.grp AS cluster, n_baskets, CAST(CASE WHEN r.n IS NULL THEN 0 ELSE least(10, r.n) END AS BIGINT) AS n_rules,
       CASE WHEN n_baskets < 50 THEN concat('too few invoices: ', n_baskets, ' of 50') WHEN r.n IS NULL THEN 'nothing reaches support 0.02 and lift 1000.0' END AS skip_reason
FROM total LEFT JOIN r ON r.grp = total.grp""")
def _(spark, d):
    """A lift that no rule reaches: segments with enough invoices show why they have no rules."""
    return _by_segment(spark, d, lift=1000.0)[1]


@register("miner_comparison", f"""
WITH {ALL_SQL} SELECT a AS algorithm, (SELECT count(*) FROM freq) AS n_itemsets, (SELECT count(*) FROM rule) AS n_rules, CAST(0 AS BIGINT) AS n_differences
FROM (VALUES ('apriori'), ('fpgrowth')) AS t(a)""")
def _(spark, d):
    return rules.compare_miners(materialize(type_baskets(spark, d)), SUPPORT, CONFIDENCE, LIFT).drop("runtime_s")


def _every_set(item: str, fraction: float, floor: int, support: float) -> str:
    """All sets of the baskets' popular items, by bit masks over each basket's own items: no limit on their length."""
    return f"""{CLEAN_SQL}, line AS (SELECT DISTINCT "Invoice", {item} AS item FROM clean WHERE "Invoice" IS NOT NULL AND {item} IS NOT NULL),
popular AS (SELECT item FROM line GROUP BY 1 HAVING count(*) >= greatest({floor}, floor({fraction} * (SELECT count(DISTINCT "Invoice") FROM line)))),
basket AS (SELECT "Invoice", list(item ORDER BY item) AS b FROM line WHERE item IN (SELECT item FROM popular) GROUP BY 1),
total AS (SELECT count(*) AS n_baskets FROM basket),
mask AS (SELECT b, unnest(range(1, CAST(1 AS BIGINT) << CAST(len(b) AS INTEGER))) AS m FROM basket),
freq AS (
  SELECT list_filter(b, lambda x, i: (m >> CAST(i - 1 AS INTEGER)) & 1 = 1) AS s, count(*) AS freq, any_value(n_baskets) AS n_baskets FROM mask, total GROUP BY 1
  HAVING count(*) >= ceil({support} * any_value(n_baskets) - 1e-9))"""


def _filtered(spark, d, item: str, fraction: float, floor: int) -> DataFrame:
    lines = materialize(basket_lines(spark, d, item).select("Invoice", "StockCode"))
    return materialize(baskets.long_baskets(baskets.keep_popular(lines, baskets.popular_items(lines, fraction, floor))))


@register("itemsets_after_filter", f"""
WITH {_every_set('"StockCode"', 0.002, 2, 0.0001)} SELECT array_to_string(s, '|') AS items, freq, n_baskets, freq / n_baskets AS support FROM freq""", {"support": 9})
def _(spark, d):
    """All frequent sets of the whole part catalogue: parts in too few invoices go first, and supports refer to the baskets that are left."""
    return as_text(baskets.apriori(_filtered(spark, d, "l_partkey", 0.002, 2), 0.0001), "items").drop("grp")


BRANDS = (0.11, 50, 0.002)


@register("itemsets_of_popular_brands", f"""
WITH {_every_set("p_brand", *BRANDS)} SELECT array_to_string(s, '|') AS items, freq, n_baskets, freq / n_baskets AS support FROM freq""", {"support": 9})
def _(spark, d):
    return as_text(baskets.fpgrowth(_filtered(spark, d, "p_brand", *BRANDS[:2]), BRANDS[2]), "items").drop("grp")


@register("rules_after_filter", f"""
WITH {_every_set("p_brand", *BRANDS)},
part AS (SELECT s, freq, n_baskets, unnest(range(1, (CAST(1 AS BIGINT) << CAST(len(s) AS INTEGER)) - 1)) AS m FROM freq WHERE len(s) > 1),
split AS (
  SELECT list_filter(s, lambda x, i: (m >> CAST(i - 1 AS INTEGER)) & 1 = 1) AS a, list_filter(s, lambda x, i: (m >> CAST(i - 1 AS INTEGER)) & 1 = 0) AS c, freq / n_baskets AS support FROM part),
measured AS (
  SELECT a, c, split.support, fa.freq / fa.n_baskets AS antecedent_support, fc.freq / fc.n_baskets AS consequent_support FROM split JOIN freq fa ON fa.s = a JOIN freq fc ON fc.s = c)
SELECT array_to_string(a, '|') AS antecedents, array_to_string(c, '|') AS consequents, support, support / antecedent_support AS confidence, support / antecedent_support / consequent_support AS lift
FROM measured WHERE support / antecedent_support >= {CONFIDENCE} AND support / antecedent_support / consequent_support >= {LIFT}""", dict.fromkeys(["support", "confidence", "lift"], 9))
def _(spark, d):
    """Filter, then FP-Growth, then rules: the denominator of every support are the baskets after the filter."""
    found = rules.association_rules(materialize(baskets.fpgrowth(_filtered(spark, d, "p_brand", *BRANDS[:2]), BRANDS[2])), CONFIDENCE, LIFT)
    return as_text(found, "antecedents", "consequents").select("antecedents", "consequents", "support", "confidence", "lift")
