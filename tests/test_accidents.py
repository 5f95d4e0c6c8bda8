"""The whole study on small made-up files with the columns of the public ones."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from rowlens.functions.columns import AGE_BOUNDS
from rowlens.plans import accidents, study
from rowlens.plans.accident_codes import LABELS

STUDY = accidents.ROAD_ACCIDENTS


def _value(rng, column, dtype, key):
    if column == "Accident_Index":
        return key
    if column == "Date":
        return "31/02/2005" if rng.random() < 0.02 else f"{rng.randint(1, 28):02d}/{rng.randint(1, 12):02d}/2005"
    if column == "Time":
        return "" if rng.random() < 0.02 else f"{rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}"
    if column in LABELS:
        may_miss = column in (*STUDY.complete, *STUDY.constant_fills, *STUDY.band_fills)
        return "-1" if may_miss and rng.random() < 0.01 else rng.choice(list(LABELS[column]))
    if column.startswith("Age_of"):
        return rng.choice([-1, *range(2, 90)])
    if dtype == "double":
        return rng.choice([-1.0, "", *(round(rng.uniform(-5, 60), 4) for _ in range(40))])
    if column in ("Speed_limit", "Number_of_Vehicles", "Number_of_Casualties"):
        return rng.randint(1, 7) * 10
    return "" if column.startswith("Location") and rng.random() < 0.02 else rng.randint(1, 9)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("accidents")
    rng = random.Random(11)
    rows = {"Accidents": [], "Casualties": [], "Vehicles": []}
    fields = {"Accidents": accidents.ACCIDENTS, "Casualties": accidents.CASUALTIES, "Vehicles": accidents.VEHICLES}
    for number in range(220):
        sizes = {"Accidents": 1, "Casualties": rng.randint(0, 3), "Vehicles": rng.randint(0, 3)}
        for table, size in sizes.items():
            for copy in range(size):
                row = {}
                for f in accidents.schema(fields[table]):
                    row[f.name] = _value(rng, f.name, f.dataType.typeName(), f"A{number}")
                for reference in ("Vehicle_Reference", "Casualty_Reference"):
                    if reference in row:
                        row[reference] = copy + 1
                rows[table].append(row)
    for table, content in rows.items():
        # The order of the columns in a file does not matter.
        names = sorted(content[0])
        with open(folder / f"{table}.csv", "w", newline="") as out:
            writer = csv.DictWriter(out, names)
            writer.writeheader()
            writer.writerows(content)
    return folder, rows


def _missing(v):
    return v in ("", "-1", -1)


def _expected(rows):
    """The cleaned pairs by a plain loop: (key, casualty, vehicle) with the driver's age."""
    found = {}
    for a in rows["Accidents"]:
        if any(a[c] == "" for c in STUDY.located_by) or a["Date"].startswith("31/02") or a["Time"] == "":
            continue
        for c in (c for c in rows["Casualties"] if c["Accident_Index"] == a["Accident_Index"]):
            for v in (v for v in rows["Vehicles"] if v["Accident_Index"] == a["Accident_Index"]):
                row = {**c, **v, **a}
                if not any(_missing(row[k]) for k in STUDY.complete if k != "Date"):
                    key = (a["Accident_Index"], c["Casualty_Reference"], v["Vehicle_Reference"])
                    found[key] = {**row, "age": None if _missing(v["Age_of_Driver"]) else v["Age_of_Driver"]}
    return found


def test_preparation_against_a_loop(spark, raw):
    folder, rows = raw
    parent, children = accidents.read_tables(spark, str(folder))
    cleaned = study.clean_rows(STUDY, study.join_tables(STUDY, parent, children))
    filled = study.fill_rows(STUDY, cleaned)
    out = {(r.Accident_Index, r.Casualty_Reference, r.Vehicle_Reference): r for r in filled.collect()}
    expected = _expected(rows)
    assert len(expected) > 100 and out.keys() == expected.keys()
    ages = [e["age"] for e in expected.values() if e["age"] is not None]
    mean = sum(ages) / len(ages)
    band_of_mean = str(1 + sum(mean >= bound for bound in AGE_BOUNDS))
    for key, e in expected.items():
        row = out[key]
        assert row.Age_of_Driver == (int(mean) if e["age"] is None else e["age"])
        assert row.Age_Band_of_Driver == (band_of_mean if _missing(e["Age_Band_of_Driver"]) else e["Age_Band_of_Driver"])
        assert row.Weather_Conditions == ("9" if _missing(e["Weather_Conditions"]) else e["Weather_Conditions"])
        assert row.Accident_Severity_Binary == (0 if e["Accident_Severity"] == "1" else 1)
        assert row.Junction_Control is not None and row.Date > 1_100_000_000
        assert row["Vehicle_Location-Restricted_Lane"] == str(e["Vehicle_Location-Restricted_Lane"])
    assert "Local_Authority_District" in filled.columns and "Time" not in filled.columns


def test_roles_match_the_model_input():
    features = study.feature_columns(STUDY)
    assert len(features) == 29 and features[:3] == ["Number_of_Vehicles", "Number_of_Casualties", "Speed_limit"]
    assert len(STUDY.nominal) == 38 and len(LABELS) == 35 and len(STUDY.pruned) == 23


def test_whole_study(spark, raw):
    folder, _ = raw
    parent, children = accidents.read_tables(spark, str(folder))
    prepared = study.prepare(STUDY, parent, children)
    severities = {r.Accident_Severity: r["count"] for r in prepared.groupBy("Accident_Severity").count().collect()}
    assert severities["1"] > 10 * severities.get("2", 0)
    # Without sampling there are enough rows of both labels to learn from.
    from dataclasses import replace

    whole = replace(STUDY, strata=None)
    results = study.run(whole, parent, children, kinds=("decision_tree", "naive_bayes"))
    assert results["describe"].count() == 4 and results["covariance"].count() == 6
    ranking = results["gain_ratio"].collect()
    assert len(ranking) == 30 and ranking[0].attribute == "Accident_Severity_Binary" and ranking[0].gain_ratio == 1.0
    assert results["correlation"].count() == 900
    categories = results["categories"]
    assert categories.select("attribute").distinct().count() == 35
    assert categories.filter("attribute = 'Vehicle_Type' AND value = 'motorcycle'").count() == 1
    total = results["prepared"].count()
    assert categories.groupBy("attribute").agg(F.sum("n").alias("n")).filter(F.col("n") != total).isEmpty()
    fatal = results["Age_of_Driver by Accident_Severity 1"]
    assert fatal.count() == 20
    distances = [r.distance for r in results["outliers"].collect()]
    assert len(distances) == 20 and distances == sorted(distances, reverse=True)
    models = {r.model: r for r in results["models"].collect()}
    assert set(models) == {"decision_tree", "naive_bayes"}
    for row in models.values():
        assert row.tp + row.fn + row.fp + row.tn > 0 and 0 <= row.auc <= 1


def test_numeric_outliers_and_either_positive_class(spark, raw):
    folder, _ = raw
    parent, children = accidents.read_tables(spark, str(folder))
    from dataclasses import replace

    whole = replace(STUDY, strata=None)
    vectors = study.vectorize(whole, study.index_rows(whole, study.prepare(whole, parent, children)))
    assert study.find_outliers(whole, vectors, only_numeric=True).count() == 20
    one = study.evaluate_models(whole, vectors, ["naive_bayes"], positive=1).first()
    zero = study.evaluate_models(whole, vectors, ["naive_bayes"], positive=0).first()
    assert (one.tp, one.fn, one.fp, one.tn) == (zero.tn, zero.fp, zero.fn, zero.tp)
    assert one.auc == pytest.approx(zero.auc)
    both = study.evaluate_models(whole, vectors, ["decision_tree", "naive_bayes"], by_kind={"naive_bayes": {"smoothing": 2.0}}, maxDepth=2)
    assert [r.model for r in both.select("model").collect()] == ["decision_tree", "naive_bayes"]
    with pytest.raises(TypeError):
        study.evaluate_models(whole, vectors, ["naive_bayes"], maxDepth=2)
