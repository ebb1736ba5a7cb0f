import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise.operators import serve
from pickwise.operators.combine import combine, first_per_key
from pickwise.operators.regret import scenario_table
from pickwise.sources import ingest
from pickwise.sources.tables import costs_schema, plants_schema, read_selection_inputs


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def schema(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


def test_bad_cells_become_missing_and_are_listed(spark):
    folder = tempfile.mkdtemp(prefix="pw-in-")
    path = write(folder, "plants.csv", "Plant ID,Region,Plant Type,PF1,Extra,PF2\n"
                 "P1,NA,Gas,1.5,x,2\nP2,EU,Coal,n/a,x, 3 \nP3,EU,Wind,NaN,x,\nP4,,Gas,1e3,x,12 MW\n")
    got = ingest.ingest_table(spark, path, plants_schema(2))
    rows = {r["Plant ID"]: r for r in got.clean.collect()}
    assert [f.name for f in got.clean.schema][:-1] == [f.name for f in plants_schema(2)]
    assert rows["P1"].Region == "NA" and rows["P1"].PF1 == 1.5 and rows["P1"].PF2 == 2.0     # by name, not by place
    assert rows["P2"].PF1 is None and rows["P2"].PF2 == 3.0
    assert rows["P3"].PF1 is None and rows["P3"].PF2 is None
    assert rows["P4"].Region is None and rows["P4"].PF1 == 1000.0 and rows["P4"].PF2 is None
    bad = sorted((r.column, r.raw, os.path.basename(r.file)) for r in got.rejects.collect())
    assert bad == [("PF1", "n/a", "plants.csv"), ("PF2", "12 MW", "plants.csv")]
    report = {(r.table_name, r.column): r.n_rejected for r in ingest.reject_report({"plants": got.rejects}).collect()}
    assert report == {("plants", "PF1"): 1, ("plants", "PF2"): 1}


def test_malformed_lines_are_kept_and_listed(spark):
    folder = tempfile.mkdtemp(prefix="pw-in-")
    path = write(folder, "costs.csv", "Demand ID,Plant ID,Cost_USD_per_MWh\nD1,P1,10\nD2,P2\nD3,P3,30,40\nD4,P4,forty\n")
    got = ingest.ingest_table(spark, path, costs_schema())
    assert {r["Demand ID"]: r["Cost_USD_per_MWh"] for r in got.clean.collect()} == {"D1": 10.0, "D2": None, "D3": 30.0, "D4": None}
    bad = sorted(((r.column or "line"), r.raw) for r in got.rejects.collect())
    assert bad == [("Cost_USD_per_MWh", "forty"), ("line", "D2,P2"), ("line", "D3,P3,30,40")]


def test_integer_and_date_columns(spark):
    text = spark.createDataFrame([("1", "7", "2024-01-31"), ("2", "7.5", "soon"), ("3", None, ""), ("x", "8", None)], "k string, n string, d string")
    done = ingest.coerce(text, schema(("k", T.StringType()), ("n", T.LongType()), ("d", T.DateType()), ("absent", T.DoubleType())))
    clean, bad = ingest.split_rejects(done, "k")
    assert {r.k: (r.n, str(r.d), r.absent) for r in clean.collect()}["1"] == (7, "2024-01-31", None)
    assert [(r.k, r.column, r.raw) for r in bad.collect()] == [("2", "d", "soon")]


def test_order_over_several_files_and_blocks(spark):
    folder = tempfile.mkdtemp(prefix="pw-in-")
    os.mkdir(os.path.join(folder, "t"))
    lines = [f"P{i % 40},x,EU,{i},{i % 7}" for i in range(3000)]
    for k in range(3):
        write(os.path.join(folder, "t"), f"part-{k}.csv", "Plant ID,Plant Type,Region,PF1,PF2\n" + "\n".join(lines[k * 1000:(k + 1) * 1000]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")       # many blocks per file
    try:
        got = ingest.ingest_table(spark, f"{folder}/t", plants_schema(2))
        assert got.clean.select(f"{ingest.ORD}.block").distinct().count() > 2
        assert [r.PF1 for r in got.clean.orderBy(ingest.ORD).collect()] == [float(i) for i in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    first = first_per_key(got.clean.repartition(7), "Plant ID", ["PF1"], ingest.ORD)
    assert {r["Plant ID"]: r.PF1 for r in first.collect()} == {f"P{i}": float(i) for i in range(40)}
    parquet = f"{folder}/p"
    got.clean.drop(ingest.ORD).orderBy(F.desc("PF1")).coalesce(1).write.parquet(parquet)
    ordered = ingest.scan_with_order(spark, parquet).repartition(5)
    assert {r["Plant ID"]: r.PF1 for r in first_per_key(ordered, "Plant ID", ["PF1"], ingest.ORD).collect()}["P39"] == 2999.0
    with pytest.raises(ValueError):
        ingest.scan_with_order(spark, f"{folder}/t", "csv")
    with pytest.raises(ValueError):
        ingest.ingest_table(spark, f"{folder}/t", plants_schema(2), "orc")


def test_first_row_wins_in_scenarios_and_serving(spark):
    rows = [(1, "b", 5.0, 2.0, 0), (1, "a", 5.0, 2.0, 1), (2, "a", 1.0, None, 0), (2, "c", 4.0, 9.0, 2), (2, "b", 1.0, 9.0, 1)]
    scored = spark.createDataFrame(rows, "Demand_ID long, Plant_ID string, Cost double, prediction double, ord int").repartition(3)
    first = {r.Demand_ID: r for r in scenario_table(scored, order="ord").collect()}
    assert first[1].Model_Selected_Plant == "b" and first[1].Oracle_Selected_Plant == "b"
    assert first[2].Model_Selected_Plant == "b" and first[2].Oracle_Selected_Plant == "a" and first[2].Selection_Error == 0.0
    assert {r.Demand_ID: r.Model_Selected_Plant for r in scenario_table(scored).collect()}[1] == "a"
    plants = spark.createDataFrame([("b", 0, 1.0), ("a", 1, 1.0), ("c", 2, 7.0)], "plant_id string, ord int, PF1 double")
    demands = spark.createDataFrame([(1, 0.5)], "demand_id long, DF1 double")
    w = {"DF1": 1.0, "PF1": 1.0}
    assert serve.best_plant_linear(demands, plants, 0.0, w, ["DF1"], ["PF1"], plant_order="ord").first().selected_plant == "b"
    assert serve.best_plant_linear(demands, plants, 0.0, w, ["DF1"], ["PF1"]).first().selected_plant == "a"


def test_run_survives_bad_cells(spark):
    folder = tempfile.mkdtemp(prefix="pw-in-")
    d = write(folder, "demand.csv", "Demand ID,DF1\nD1,1\nD2,two\nD1,9\n")
    p = write(folder, "plants.csv", "Plant ID,Plant Type,Region,PF1\nP1,Gas,NA,1\nP2,Gas,EU,?\n")
    c = write(folder, "costs.csv", "Demand ID,Plant ID,Cost_USD_per_MWh\nD1,P1,10\nD1,P2,20\nD2,P1,-\n")
    demand, plants, costs = read_selection_inputs(spark, d, p, c, n_demand_features=1, n_plant_features=1, on_bad="reject")
    out = combine(demand.clean, plants.clean, costs.clean, ["DF1"], ["PF1"], "Demand ID", "Plant ID", "Cost_USD_per_MWh",
                  demand_order=ingest.ORD, plant_order=ingest.ORD).collect()
    assert [(r.Demand_ID, r.Plant_ID, r.DF1, r.Cost) for r in out] == [("D1", "P1", 1.0, 10.0)]
    report = ingest.reject_report({"demand": demand.rejects, "plants": plants.rejects, "costs": costs.rejects})
    assert sorted((r.table_name, r.column, r.n_rejected) for r in report.collect()) == [
        ("costs", "Cost_USD_per_MWh", 1), ("demand", "DF1", 1), ("plants", "PF1", 1)]
