import os

import pytest
from pyspark.sql.types import StructType

from rowlens.session import new_folder, owned_tables, shared_dir
from rowlens.sources.files import infer_schema, misfits, scan_csv, scan_parquet, stage, type_counts, write_csv, write_parquet


def test_csv_binds_by_name_and_keeps_declared_types(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.write_text("b,clock,a (x)\n1,17:42,2.5\nbad,,\n")
    schema = StructType().add("a (x)", "double").add("b", "integer").add("clock", "string")
    rows = scan_csv(spark, str(folder), schema).collect()
    assert [tuple(r) for r in rows] == [(2.5, 1, "17:42"), (None, None, None)]


def test_csv_and_parquet_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "i int, s string")
    write_csv(df.repartition(2), str(tmp_path / "c"))
    assert sorted(map(tuple, scan_csv(spark, str(tmp_path / "c"), df.schema).collect())) == [(1, "x"), (2, None)]
    write_parquet(df, str(tmp_path / "p"))
    assert scan_parquet(spark, str(tmp_path / "p")).exceptAll(df).isEmpty()


def test_stage_uses_a_new_folder_below_the_shared_one(spark):
    df = spark.range(1000)
    staged = stage(df, "numbers", ["id"])
    assert staged.exceptAll(df).isEmpty() and staged.count() == 1000
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(spark, "x").startswith(shared_dir(spark).rstrip("/"))


def test_csv_with_another_order_of_columns_raises(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two.csv").write_text("b,a\n3,30\n")
    schema = StructType().add("a", "long").add("b", "long")
    with pytest.raises(Exception, match="header"):
        scan_csv(spark, str(tmp_path), schema).collect()


def test_types_are_the_narrowest_that_all_values_fit(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b,c,d,e,f,g,h (x)\n1,2147483648,1,2020-01-31,17:42,,true,2015\n 2,3,1e3,2020-01-31 10:20,08:00,,FALSE,2016\n")
    (tmp_path / "two.csv").write_text("a,b,c,d,e,f,g,h (x)\n+3,-4,.5,2020-02-01T00:00:01.5Z,x,,true,\n")
    found = {r["column"]: r for r in type_counts(spark, str(tmp_path)).collect()}
    types = {c: r.type for c, r in found.items()}
    assert types == {"a": "integer", "b": "bigint", "c": "double", "d": "timestamp", "e": "string", "f": "string", "g": "boolean", "h (x)": "integer"}
    assert (found["h (x)"].n, found["h (x)"].n_null, found["b"].n_integer, found["d"].n_date) == (3, 1, 2, 1)
    rows = scan_csv(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in rows.schema] == ["int", "bigint", "double", "timestamp", "string", "string", "boolean", "int"]
    assert sorted(r.a for r in rows.collect()) == [1, 2, 3] and infer_schema(spark, str(tmp_path))[1].name == "b"
    told = misfits(spark, str(tmp_path), StructType().add("b", "integer").add("h (x)", "date").add("e", "string")).collect()
    assert {(r["column"], r.type, r.n, r.n_null, r.n_misfit) for r in told} == {("b", "int", 3, 0, 1), ("h (x)", "date", 3, 1, 0), ("e", "string", 3, 0, 0)}


def test_a_file_without_rows_has_text_columns(spark, tmp_path):
    (tmp_path / "none.csv").write_text("a,b\n")
    assert type_counts(spark, str(tmp_path)).count() == 0
    assert scan_csv(spark, str(tmp_path)).schema.simpleString() == "struct<a:string,b:string>"


def test_an_owner_removes_its_tables_also_after_an_error(spark):
    def folders():
        return set(os.listdir(f"{shared_dir(spark).removeprefix('file:').rstrip('/')}/rowlens"))

    outside = stage(spark.range(3), "outside")
    before = folders()
    with owned_tables(spark) as paths:
        assert stage(spark.range(5), "inside").count() == 5 and len(paths) == 1 and len(folders() - before) == 1
        with owned_tables(spark):
            stage(spark.range(5), "deeper")
            assert len(folders() - before) == 2
        assert len(folders() - before) == 1
    assert folders() == before
    with pytest.raises(RuntimeError), owned_tables(spark):
        stage(spark.range(5), "lost")
        raise RuntimeError
    assert folders() == before and outside.count() == 3
