import datetime
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starfold import clean, read_csv, read_dictionary, read_optional, write_csv, write_table
from starfold.rules import RAW_FIELDS
from starfold.sources import current_version, publish_version, schema_rows, scratch_dir, stage, to_pandas, version_paths

FIELDS = [("A", "string"), ("N", "int"), ("X", "double")]


def file(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_binds_by_header_name(spark, tmp_path, rows):
    path = file(tmp_path, "a.csv", "X,EXTRA,n,A\n1.5,zz,7,hello\nbad,zz,x,\n")
    assert rows(read_csv(spark, path, FIELDS)) == sorted([("hello", 7, 1.5), (None, None, None)], key=repr)
    assert read_csv(spark, path, FIELDS).columns == ["A", "N", "X"]


def test_missing_column_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="X"):
        read_csv(spark, file(tmp_path, "b.csv", "A,N\n1,2\n"), FIELDS)


def test_files_with_different_headers_fail(spark, tmp_path):
    a = file(tmp_path, "c.csv", "A,N,X\nq,1,2.0\n")
    b = file(tmp_path, "d.csv", "X,A,N\n2.0,q,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, [a, b], FIELDS).collect()


def test_collision_header_with_extra_columns_in_between(spark, tmp_path):
    names = [n for n, _ in RAW_FIELDS]
    header = names[:7] + ["ON STREET NAME", "CROSS STREET NAME"] + names[7:] + ["VEHICLE TYPE CODE 3"]
    values = [
        "09/11/2021", "2:39", " BROOKLYN ", "", "40.66", "-73.95", '"(40.66, -73.95)"', "5 AVENUE", "MAIN", "2", "0",
        "0", "0", "0", "0", "2", "0", "Unspecified", "", "Sedan", "", "Van",
    ]
    path = file(tmp_path, "e.csv", ",".join(header) + "\n" + ",".join(values) + "\n")
    row = clean(read_csv(spark, path)).first()
    assert row["persons_injured"] == 2 and row["borough"] == "BROOKLYN" and row["zip_code"] is None
    assert row["crash_date"] == datetime.date(2021, 9, 11) and row["vehicle_type_code_1"] == "Sedan"


def test_csv_keeps_outer_spaces(spark, tmp_path, rows):
    df = spark.createDataFrame([(" a ", 1, 0.5), (None, None, None)], "A string, N int, X double")
    write_csv(df, str(tmp_path / "out"))
    assert rows(read_csv(spark, str(tmp_path / "out"), FIELDS)) == rows(df)


def test_dictionary_with_cells_over_several_lines(spark, tmp_path, rows):
    text = (
        "resources.name,resources.schema.fields.name,resources.schema.fields.var_class,"
        "resources.schema.fields.description\n"
        'T,YEAR,99,"Year.\nSecond line, with ""quotes"""\nT,MONTH,99,Month\n'
    )
    got = rows(read_dictionary(spark, file(tmp_path, "dict.csv", text)))
    assert got == [("T", "MONTH", "99", "Month"), ("T", "YEAR", "99", 'Year.\nSecond line, with "quotes"')]


def test_optional_table(spark, tmp_path):
    assert read_optional(spark, str(tmp_path / "nothing")) is None
    assert write_table(spark.range(3), str(tmp_path / "t")).count() == 3
    assert read_optional(spark, str(tmp_path / "t")).count() == 3
    empty = tmp_path / "no_schema"
    empty.mkdir()
    with pytest.raises(AnalysisException):
        read_optional(spark, str(empty))


def test_stage_uses_the_shared_folder(spark):
    staged = stage(spark.range(5), "x")
    assert all(scratch_dir(spark) in f for f in staged.inputFiles())
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_shared_folder_unset():
    def fake(master):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)

    made = scratch_dir(fake("local[2]"))
    assert scratch_dir(fake("local[2]")) == made
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(fake("yarn"))


def test_bounded_collect(spark):
    assert len(to_pandas(spark.range(100), 7)) == 7


def test_bounded_collect_is_determined_at_a_tie(spark):
    rows = spark.createDataFrame([(i % 2, i, None if i == 5 else i * 10) for i in range(8)], "a int, `b.c` int, a1 int")
    for parts in (1, 5):
        got = to_pandas(rows.repartition(parts), 3, [F.desc("a")])
        assert got["b.c"].tolist() == [1, 3, 5]
    assert to_pandas(rows, 0, ["a"]).empty and len(to_pandas(rows, 99, ["a"])) == 8


def test_schema_as_rows(spark):
    df = spark.createDataFrame([(1, [2.0], {"k": "v"})], "a int, `b c` array<double>, m map<string,string>")
    assert [tuple(r) for r in schema_rows(df).orderBy("position").collect()] == [
        (1, "a", "int", True), (2, "b c", "array<double>", True), (3, "m", "map<string,string>", True),
    ]


def test_versions(spark, tmp_path):
    root = str(tmp_path)
    assert current_version(spark, root) is None
    assert publish_version(spark, root, {"tables": {"t": {"path": "a"}}}) == 1
    (tmp_path / "_versions" / "000000000002.claim").touch()  # a writer that died, or is slow
    assert publish_version(spark, root, {"tables": {"t": {"path": "b"}}}) == 3
    (tmp_path / "_versions" / "_half").write_text('{"tables": ')
    assert version_paths(current_version(spark, root)) == {"t": "b"}
