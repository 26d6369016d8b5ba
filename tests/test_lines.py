import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from custlens.functions.ordering import global_rank
from custlens.functions.quantiles import exact_quantiles
from custlens.operators import cleaning, customers, eda, encoding
from custlens.sources import retail

CUTOFF = datetime(2011, 9, 1)


def test_clean_golden(raw):
    """Quantities 1 1 2 3 4 10 have the bounds 1 and 9.7, prices 3 3.5 11 12 38 40 the bounds 3.025 and 39.9."""
    got = {(r["Invoice"], r["StockCode"]): (r["Quantity"], r["Price"], r["TotalAmount"]) for r in cleaning.clean(raw).collect()}
    want = {
        ("5001", "G-10"): (2, 39.9, 79.8), ("5001", "G-22"): (9.7, 3.025, 29.3425), ("5002", "G-22"): (4, 3.5, 14),
        ("5003", "G-31"): (1, 12, 12), ("5004", "G-10"): (1, 38, 38), ("5005", "G-31"): (3, 11, 33),
    }
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v)


def test_clean_coerces_text(spark):
    rows = [
        ("1", "A", " Spade ", "2", "2011-01-01 10:00:00", "1.5", "41.0", " Chile "),
        ("2", "A", None, "2", "2011-01-01", "1.5", "41", "Chile"),
        ("3", "A", "x", "2", "not a date", "1.5", "41", "Chile"),
        ("4", "A", "x", "2", "2011-01-01", "1.5", "abc", "Chile"),
        ("c5", "A", "x", "2", "2011-01-01", "1.5", "41", "Chile"),
        ("C6", "A", "x", "2", "2011-01-01", "1.5", "41", "Chile"),
    ]
    raw = spark.createDataFrame(rows, "Invoice string, StockCode string, Description string, Quantity string, InvoiceDate string, Price string, `Customer ID` string, Country string")
    got = {r["Invoice"]: r for r in cleaning.clean(raw, q=None).collect()}
    assert set(got) == {"1", "2", "c5"}
    assert got["1"]["Description"] == "Spade" and got["1"]["Country"] == "Chile" and got["1"]["CustomerID"] == 41
    assert got["2"]["Description"] is None


def test_features_and_labels_golden(raw):
    lines = cleaning.clean(raw)
    got = {r["CustomerID"]: r for r in customers.pre_cutoff_features(lines, CUTOFF).collect()}
    assert set(got) == {301, 302}
    a, b = got[301], got[302]
    assert (a["Recency"], a["Frequency"], a["unique_products"], a["DominantCountry"]) == (19, 1, 2, "Norway")
    assert (a["Monetary"], a["avg_basket_value"], a["avg_basket_size"]) == pytest.approx((109.1425, 109.1425, 11.7))
    assert (b["Recency"], b["Frequency"], b["unique_products"], b["DominantCountry"]) == (0, 2, 2, "Italy")
    assert (b["Monetary"], b["avg_basket_value"], b["avg_basket_size"]) == pytest.approx((26, 13, 2.5))
    labels = {r["CustomerID"]: r["churn"] for r in customers.churn_labels(lines, CUTOFF, 90).collect()}
    assert labels == {301: 0, 302: 1}


def test_window_borders_and_time_of_day(spark):
    cut = CUTOFF
    rows = [(1, "a", cut - timedelta(hours=11, minutes=10)), (1, "b", cut), (2, "c", cut - timedelta(days=3)), (2, "d", cut + timedelta(days=90)), (3, "e", cut)]
    lines = spark.createDataFrame(rows, "CustomerID bigint, Invoice string, InvoiceDate timestamp_ntz").withColumns(
        {"StockCode": F.lit("x"), "Country": F.lit("y"), "Quantity": F.lit(1.0), "TotalAmount": F.lit(1.0)})
    assert {r["CustomerID"]: r["churn"] for r in customers.churn_labels(lines, cut, 90).collect()} == {1: 0, 2: 1}
    assert {r["CustomerID"]: r["Recency"] for r in customers.pre_cutoff_features(lines, cut).collect()} == {1: 0, 2: 3}
    with pytest.raises(ValueError):
        customers.pre_cutoff_features(lines, datetime(2000, 1, 1), check=True)


def test_country_tie_is_alphabetical(spark):
    rows = [(1, "b"), (1, "a"), (2, "b"), (2, "b"), (2, "a"), (3, None), (3, "z")]
    got = customers.dominant_country(spark.createDataFrame(rows, "CustomerID int, Country string")).collect()
    assert {r[0]: r[1] for r in got} == {1: "a", 2: "b", 3: "z"}


def test_quantiles_match_interpolation(spark):
    rng = random.Random(1)
    hot = [7.0] * 400 + [rng.gauss(0, 50) for _ in range(799)]
    few = [1.0, 2.0, 5.0, 9.0]
    df = spark.createDataFrame([(v, few[i] if i < 4 else None) for i, v in enumerate(hot)], "a double, b double").repartition(5)
    qs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = exact_quantiles(df, {"a": qs, "b": qs}, accuracy=50)
    import numpy as np

    assert got["a"] == pytest.approx(list(np.quantile(hot, qs)))
    assert got["b"] == pytest.approx(list(np.quantile(few, qs)))
    assert exact_quantiles(df.filter("a > 1e9"), {"a": [0.5]}) == {"a": [None]}


def test_global_rank_with_hot_value(spark):
    rng = random.Random(2)
    values = [(i, 5.0 if i % 3 == 0 else round(rng.random(), 3)) for i in range(3000)]
    df = spark.createDataFrame(values, "id int, v double").repartition(7)
    got = global_rank(df, [F.desc("v"), F.asc("id")], "r", {"upto": "v"}).orderBy("r").collect()
    want = sorted(values, key=lambda t: (-t[1], t[0]))
    assert [(r["id"], r["v"]) for r in got] == want and [r["r"] for r in got] == list(range(1, 3001))
    total = 0.0
    for r in got:
        total += r["v"]
        assert r["upto"] == pytest.approx(total)


def test_encoder_folds_rare_and_unseen(supervised):
    train = supervised.filter("DominantCountry <> 'Malta'")
    model = encoding.ChurnEncoder(rareShare=0.08).fit(train)
    assert model.slots[-1] == "DominantCountry_infrequent"
    coded = model.columns_frame(supervised, "DominantCountry").filter("DominantCountry = 'Malta'").collect()
    assert coded and all(r["DominantCountry_infrequent"] == 1.0 for r in coded)
    no_rare = encoding.ChurnEncoder(rareShare=0.0).fit(train)
    unseen = no_rare.columns_frame(supervised, "DominantCountry").filter("DominantCountry = 'Malta'").first().asDict()
    assert sum(v for k, v in unseen.items() if k.startswith("DominantCountry_")) == 0.0
    assert len(encoding.ChurnEncoder(columns=["Recency", "Frequency", "Monetary"]).fit(train).slots) == 3
    stats = model.columns_frame(train).agg(F.avg("Monetary"), F.stddev_pop("Monetary")).first()
    assert stats[0] == pytest.approx(0, abs=1e-9) and stats[1] == pytest.approx(1)


def test_missing_column_raises(supervised):
    with pytest.raises(KeyError):
        customers.supervised_frame(supervised.drop("churn", "Recency"), supervised.select("CustomerID", "churn"))


def test_reports(raw):
    lines = cleaning.clean(raw)
    curve = eda.pareto_curve(lines).orderBy("position").collect()
    assert [r["CustomerID"] for r in curve] == [301, 303, 302] and curve[-1]["revenue_share"] == pytest.approx(1)
    assert {r["stage"]: r["n_lines"] for r in cleaning.raw_vs_clean(raw, lines).collect()} == {"raw": 10, "clean": 6}
    audit = cleaning.cleaning_audit(raw).first()
    assert audit["missing_id_share"] == pytest.approx(1 / 10) and audit["removed_share"] == pytest.approx(4 / 10)
    assert {r[0]: r[1] for r in cleaning.null_counts(raw).collect()}["Customer ID"] == 1


def test_sources_round_trip(spark, raw, tmp_path):
    lines = cleaning.clean(raw)
    retail.write_clean(lines, f"{tmp_path}/clean")
    back = retail.read_clean(spark, f"{tmp_path}/clean")
    assert sorted(map(repr, back.select(lines.columns).collect())) == sorted(map(repr, lines.collect()))
    early = retail.read_clean(spark, f"{tmp_path}/clean", before=CUTOFF)
    assert {r["Invoice"] for r in early.collect()} == {"5001", "5002", "5003"}
    part = raw.withColumnRenamed("Country", " Country ")
    for name, df in (("a.csv", part.filter("Invoice < '5003'")), ("b.csv", part.filter("Invoice >= '5003'"))):
        df.write.option("header", True).csv(f"{tmp_path}/{name}")
    loaded = retail.load_raw(spark, f"{tmp_path}/a.csv", f"{tmp_path}/b.csv")
    assert loaded.columns == raw.columns and loaded.count() == 10
    assert {r["Invoice"] for r in cleaning.clean(loaded).collect()} == {"5001", "5002", "5003", "5004", "5005"}
    with pytest.raises(Exception):
        retail.load_raw(spark, f"{tmp_path}/absent.csv")


def _star(spark, folder, parts):
    rows = {
        "nation": ([(1, "Chile")], "n_nationkey int, n_name string"),
        "supplier": ([(7, 1)], "s_suppkey bigint, s_nationkey int"),
        "part": (parts, "p_partkey bigint, p_name string, p_type string, p_brand string"),
        "orders": ([(i, 5, datetime(2000, i, 3)) for i in (1, 2, 3)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"),
        "lineitem": ([(1, 9, 7, 2.0, 10.0, "N"), (1, 8, 7, 4.0, 12.0, "N"), (2, 8, 7, 1.0, 4.0, "N"), (3, 9, 7, 1.0, 5.0, "R")],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_returnflag string"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("copies", [1, 2])
def test_features_and_labels_read_the_joined_lines_once(spark, tmp_path, copies):
    """Features do not join the raw tables once per branch; a part key that repeats still repeats its lines."""
    from custlens.plans import lines as plans

    folder = str(tmp_path)
    _star(spark, folder, [(9, "pen", "t", "b")] * copies + [(8, "ink", "t", "b")])
    features = plans.pre_features(spark, folder)
    assert not any("lineitem" in f or "orders" in f for f in features.inputFiles())
    whole = customers.pre_cutoff_features(plans.clean_lines(spark, folder), plans.CUTOFF)
    assert features.collect() == whole.collect()
    assert features.first()["avg_basket_size"] == pytest.approx((2 * copies + 4 + 1) / 2, abs=0.1)
    assert not any("supplier" in f or "part.parquet" in f for f in plans.labels(spark, folder).inputFiles())
    assert plans.labels(spark, folder).collect() == customers.churn_labels(plans.basket_lines(spark, folder, "l_partkey"), plans.CUTOFF, plans.WINDOW).collect()


@pytest.mark.parametrize("copies", [1, 2])
def test_baskets_of_the_decision_flow_read_the_joined_lines(spark, tmp_path, copies):
    """Rules of the decision table take their baskets from the written lines: orders are joined once."""
    from custlens.plans import lines as plans

    folder = str(tmp_path)
    _star(spark, folder, [(9, "pen ", "t", "b")] * copies + [(8, " ink", "u", "b")])
    typed = plans.typed_lines(spark, folder, plans.feature_lines(spark, folder))
    assert (copies > 1) == any("orders" in f for f in typed.inputFiles())
    whole = plans.basket_lines(spark, folder, "p_type").select("Invoice", "StockCode", "Description")
    assert sorted(typed.collect()) == sorted(whole.collect())
