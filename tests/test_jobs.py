"""Jobs from files to files, with models saved in between, on small made-up shops."""

import dataclasses
import datetime as dt
import os

import numpy as np
import pytest
from demandspark.operators import features, model
from demandspark.plans import jobs
from demandspark.schema import MONTHS, SALES, Params
from demandspark.sources import sales as files
from demandspark.sources.scratch import keep
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

P = Params(clusters=4, cutoff="2021-07-01", tree_depth=3, tree_rounds=3, min_sku_units=1, max_lag=4, important_licenses=("LB",), labels=("taza", "lampara"), synonyms={"taza": "vaso"}, title_companies=("north_co",))


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("shop")
    r, rows = np.random.default_rng(0), []
    for k in range(24):
        for m in range(24):
            for shop in ("Amazon", "Mercado Libre", "Other"):
                units = float(r.poisson(5 + k % 5 + 3 * np.sin(m / 2)))
                rows.append((str(k), "Taza azul" if k % 2 else "Lámpara", f"s{k % 3}", "LA" if k % 4 else "LB", shop, MONTHS[m % 12].upper(), 2020 + m // 12, units, units * (10 + k), 4.0))
    spark.createDataFrame(rows, SALES).write.parquet(f"{at}/sales")
    spark.createDataFrame(rows, SALES).coalesce(1).write.option("header", True).csv(f"{at}/sales_csv")
    (at / "interest.csv").write_text("license," + ",".join(f"m{i:02d}" for i in range(12)) + "\nLA," + ",".join(map(str, range(1, 13))) + "\nLB," + ",".join(["2"] * 12) + "\n")
    (at / "titles.csv").write_bytes("license,run_time,imdb_rating,next release,production_company,release_date,budget,news_articles,opening_weekend,title_tatus,title_type\nLA,120 min,7.5/10,soon,North Co.,3/5/19,10,2,n/a,released,película\nLB,90 min,6/10,,North Co.,3/5/20,20,3,5,released,movie\n".encode("latin-1"))
    return at


def test_readers(spark, inputs):
    a, b = files.read_sales(spark, f"{inputs}/sales"), files.read_sales(spark, f"{inputs}/sales_csv", "csv")
    assert a.schema == b.schema and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert [f.dataType.simpleString() for f in files.read_interest(spark, f"{inputs}/interest.csv").schema] == ["string"] + ["double"] * 12
    titles = {r.license: r for r in files.read_titles(spark, f"{inputs}/titles.csv").collect()}
    assert titles["LA"].title_type == "película" and titles["LA"].opening_weekend is None and titles["LB"].opening_weekend == 5.0


def test_from_files_to_forecasts(spark, inputs):
    jobs.run_preprocess(spark, f"{inputs}/sales", f"{inputs}/panel", P)
    panel = files.read_stage(spark, f"{inputs}/panel")
    assert {r.level for r in panel.select("level").distinct().collect()} == {"bottom", "cluster", "license"}
    assert panel.where("level = 'bottom'").select("platform").distinct().count() == 2
    by_level = {r.level: r.units for r in panel.groupBy("level").agg(F.sum("units").alias("units")).collect()}
    assert by_level["bottom"] == by_level["cluster"] == by_level["license"] > 0
    jobs.run_features(spark, f"{inputs}/panel", f"{inputs}/interest.csv", f"{inputs}/titles.csv", f"{inputs}/features", P)
    table = files.read_stage(spark, f"{inputs}/features")
    assert {"lag_1", "sales_roll_3", "moviemeter_trend_6", "north_co", "next_release_dummy", "months_from_release_lb"} <= set(table.columns)
    jobs.run_training(spark, f"{inputs}/features", f"{inputs}/models", P)
    jobs.run_forecast(spark, f"{inputs}/features", f"{inputs}/models", f"{inputs}/forecast", P)
    got = spark.read.option("header", True).option("inferSchema", True).csv(f"{inputs}/forecast")
    assert got.columns == ["series_id", "date", "base", "reconciled", "level"]
    sums = {(r.level, str(r.date)): r.total for r in got.groupBy("level", "date").agg(F.sum("reconciled").alias("total")).collect()}
    days = {d for _, d in sums}
    assert len(days) == 6 and all(sums["bottom", d] == sums["cluster", d] == sums["license", d] >= 0 for d in days)
    # saved models forecast what the ones in memory do
    again = jobs.forecast(table, {n: model.load_level(spark, f"{inputs}/models/{n}") for n in ("bottom", "cluster", "license")}, P)
    assert again.exceptAll(jobs.forecast(table, {n: model.load_level(spark, f"{inputs}/models/{n}") for n in ("bottom", "cluster", "license")}, P)).isEmpty()
    assert again.where("date < '2021-07-01'").isEmpty() and again.where("units is null").isEmpty()


def test_categories_do_not_see_their_own_row(spark):
    rows = spark.createDataFrame([(f"s{i}", dt.date(2020, 1, 1), "a" if i < 40 else f"only{i}", float(i)) for i in range(50)], "series_id string, date date, kind string, units double")
    base = 24.5
    got = model.encode_training(rows, ["kind"], base).collect()
    assert len(got) == 50
    for r in got:
        if r.kind != "a":
            assert (r.kind_mean, r.kind_n) == (base, 0.0)
        else:
            assert r.kind_n < 40 and abs(r.kind_mean - 19.5) < 8
    means = {r.value: r for r in model.category_means(rows, ["kind"], base).collect()}
    assert means["a"].mean == pytest.approx((780 + 5 * base) / 45) and means["only49"].mean == pytest.approx((49 + 5 * base) / 6)
    new = spark.createDataFrame([("zz",)], "kind string")
    assert model.attach(new, ["kind"], model.category_means(rows, ["kind"], base), base).first().kind_mean == base


def stage(spark):
    rows = [(level, f"s{k}", dt.date(2020, 1 + m, 1), float(k * m), m % 2) for level in ("bottom", "license") for k in range(7) for m in range(12)]
    return spark.createDataFrame(rows, "level string, series_id string, date date, units double, sales int").repartition(3)


def test_stage_is_in_order(spark, tmp_path):
    rows = stage(spark)
    files.write_stage(rows, str(tmp_path / "stage"), buckets=5)
    parts = list((tmp_path / "stage").glob("*.parquet"))
    assert 0 < len(parts) <= 5
    where = {}
    for part in parts:
        got = [(r.level, r.series_id, r.date) for r in spark.read.parquet(str(part)).collect()]
        assert got == sorted(got)
        for x in {r[:2] for r in got}:
            assert where.setdefault(x, part) == part
    back = files.read_stage(spark, str(tmp_path / "stage"))
    assert back.schema == rows.schema and back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_stages_are_read_without_exchanges_by_series(spark, tmp_path):
    path = str(tmp_path / "stage")
    files.write_stage(stage(spark), path, buckets=5)
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    for again in (False, True):
        if again:  # as in a later session, which does not know the table
            for t in spark.catalog.listTables():
                if t.name.startswith("stage_"):
                    spark.sql(f"DROP TABLE {t.name}")
        rows = files.read_stage(spark, path)
        timed = features.time_features(features.runs(features.date_parts(rows)))
        assert exchanges(timed) == exchanges(features.lag_features(timed, lags=[1, 2], trends=[("lag_1", "lag_2")])) == 0
        assert exchanges(model.prepare(timed, "2020-06-01", ["level"], "train")) == exchanges(model.prepare(timed, "2020-06-01", ["level"], "inference")) == 0
    # files of another schema, as by a writer that does not know the layout
    for other in (spark.range(3), spark.sql("select 'x' as units")):
        files.write_stage(stage(spark), path, buckets=5)
        other.write.mode("append").parquet(path)
        with pytest.raises(ValueError, match="another schema"):
            files.read_stage(spark, path)
    files.write_stage(stage(spark).withColumn("more", F.lit(1)), path)
    assert "more" in files.read_stage(spark, path).columns


def test_sales_are_bound_by_heading(spark, tmp_path):
    def write(name, *lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return str(tmp_path / name)

    ours = write("a.csv", "year,sku,units,extra,platform,supplier,license,description,month_name,sales,cost", "2020,7,3,zz,X,s,L,d,enero,30,4", "two,8,3,zz,X,s,L,d,enero,30,4", "2021,9,,zz,X,s,L,d,mayo,1e2,n/a")
    theirs = write("b.csv", "Categoría,Costo Alpha,Precio venta,piezas,Año,Mes,Plataforma,Marca,Descripción, SKU ", "L,4,30,3,2020,enero,X,s,d,7")
    want = ("7", "d", "s", "L", "X", "enero", 2020, 3.0, 30.0, 4.0)
    assert [tuple(r) for r in files.read_sales(spark, ours, "csv").collect()] == [want]
    assert [tuple(r) for r in files.read_sales(spark, theirs, "csv").collect()] == [want]
    bad = {r.sku: (r.bad, r.year, r.cost) for r in files.read_sales_checked(spark, ours, "csv")[1].collect()}
    assert bad == {"8": (["year"], "two", "4"), "9": (["cost"], "2021", "n/a")}
    with pytest.raises(ValueError, match="missing.*units"):
        files.read_sales(spark, write("c.csv", "sku,platform,supplier,license,description,month_name,year,sales,cost", "7,X,s,L,d,enero,2020,1,1"), "csv")
    with pytest.raises(ValueError, match="several"):
        files.read_sales(spark, write("d.csv", "sku,Marca,platform,supplier,license,description,month_name,year,sales,cost,units", "7,s,X,s,L,d,enero,2020,1,1,1"), "csv")
    # numbers as text, NaN and an extra column in a Parquet file
    spark.sql("select 'x' as extra, cast('nan' as double) as cost, 30 as sales, '3' as units, 2020L as year, 'enero' as month_name, 'X' as platform, 'L' as license, 's' as supplier, 'd' as description, 7 as sku").write.parquet(f"{tmp_path}/p")
    assert [tuple(r) for r in files.read_sales(spark, f"{tmp_path}/p").collect()] == [(*want[:-1], None)]


def test_jobs_leave_no_tables_and_report_what_they_saw(spark, inputs, tmp_path):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    report = jobs.run_preprocess(spark, f"{inputs}/sales_csv", str(tmp_path / "panel"), P, "csv", str(tmp_path / "rejected"))
    assert set(os.listdir(folder)) == before
    assert report["fit"]["rmse"] > 0 and report["stockouts"]["n_rows"] == report["fit"]["n_rows"] == 24 * 24 * 2
    assert spark.read.parquet(str(tmp_path / "rejected")).count() == 0


def test_forecasts_weighed_by_error_variances(spark, inputs, tmp_path):
    p = dataclasses.replace(P, reconciliation="wls_var")
    jobs.run_forecast(spark, f"{inputs}/features", f"{inputs}/models", str(tmp_path / "forecast"), p)
    got = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "forecast"))
    sums = {(r.level, str(r.date)): r.total for r in got.groupBy("level", "date").agg(F.sum("reconciled").alias("total")).collect()}
    assert all(sums["bottom", d] == sums["cluster", d] == sums["license", d] >= 0 for _, d in sums)
    seen = jobs.error_variances({n: model.load_level(spark, f"{inputs}/models/{n}") for n in ("bottom", "cluster", "license")})
    assert {r.level for r in seen.where("variance >= 0").collect()} == {"bottom", "cluster", "license"}


def test_large_categories_are_looked_up_alike(spark, monkeypatch):
    rows = spark.createDataFrame([(f"s{i}", dt.date(2020, 1, 1), f"k{i % 9}", "b" if i % 2 else None, float(i)) for i in range(90)], "series_id string, date date, kind string, other string, units double")
    want = sorted(map(tuple, model.encode_training(rows, ["kind", "other"], 1.0).collect()), key=str)
    plan = model.encode_training(rows, ["kind", "other"], 1.0)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2
    monkeypatch.setattr(model, "MOST_VALUES", 3)
    assert sorted(map(tuple, model.encode_training(rows, ["kind", "other"], 1.0).collect()), key=str) == want


def test_jobs_take_other_levels(spark, inputs, tmp_path):
    """One level, and levels that do not nest."""
    p = dataclasses.replace(P, levels=("product",), tree_rounds=1, max_lag=2)
    jobs.run_preprocess(spark, f"{inputs}/sales", str(tmp_path / "panel"), p)
    table = jobs.build_features(files.read_stage(spark, str(tmp_path / "panel")), files.read_interest(spark, f"{inputs}/interest.csv"), files.read_titles(spark, f"{inputs}/titles.csv"), p)
    assert {r.level for r in table.select("level").distinct().collect()} == {"bottom", "product"}
    base = keep(jobs.forecast(table, jobs.train(table, p), p), "base")
    got = jobs.reconcile_forecasts(base, p)
    sums = {(r.level, r.date): r.total for r in got.groupBy("level", "date").agg(F.sum("reconciled").alias("total")).collect()}
    assert {lv for lv, _ in sums} == {"bottom", "product"} and all(sums["bottom", d] == sums["product", d] for _, d in sums)
    crossed = base.withColumn("shop", F.when(F.col("level") == "bottom", F.substring_index("series_id", "_", -1)))
    with pytest.raises(ValueError, match="not a tree"):
        jobs.reconcile_forecasts(crossed, dataclasses.replace(p, levels=("product", "shop")))


def test_training_encodes_once_and_holds_what_varies(spark):
    """Columns of one value are left out of the bins, which changes no tree; passes over the rows read them as written."""
    r = np.random.default_rng(3)
    rows = [("bottom", f"s{i % 9}", dt.date(2020, 1 + i // 9, 1), "ab"[i % 2], float(r.poisson(3 + i % 5)), float(i % 7), 4.0, None, 1) for i in range(108)]
    df = spark.createDataFrame(rows, "level string, series_id string, date date, kind string, units double, x double, same double, none double, count long")
    got = model.train_level(df, "bottom", ("date", "units", "series_id", "level"), ("kind",), depth=3, rounds=3)
    assert got.variances.inputFiles() and all("/encoded-" in f for f in got.variances.inputFiles())
    assembler, varied, tree = got.model.stages
    names = [assembler.getInputCols()[k] for k in varied.selectedFeatures]
    assert {"x_v", "kind_mean_v"} <= set(names) and not {"same_v", "none_v", "none_null", "count_v"} & set(names)
    data, inputs = model.numbers(model.encode_training(df, ["kind"], got.base), ["x", "same", "none", "count", "kind_mean", "kind_n"])
    assert inputs == assembler.getInputCols()
    whole = GBTRegressor(featuresCol="_inputs", labelCol="units", maxDepth=3, stepSize=0.05, maxIter=3, seed=0).fit(assembler.transform(data))
    want = {(x.series_id, x.date): x.prediction for x in whole.transform(assembler.transform(data)).collect()}
    assert {(x.series_id, x.date): x.prediction for x in got.model.transform(data).collect()} == pytest.approx(want)
    one = model.train_level(df.limit(1), "bottom", ("date", "units", "series_id", "level"), ("kind",), depth=3, rounds=3)
    assert one.model.transform(model.numbers(model.encode_training(df.limit(1), ["kind"], one.base), ["x", "same", "none", "count", "kind_mean", "kind_n"])[0]).first().prediction == one.base
