from shelfstream import schemas
from shelfstream.sources import files, json_text, records


def test_delimited_takes_names_from_the_schema(spark, tmp_path, rows):
    path = tmp_path / "users.csv"
    path.write_text('"User-ID";"Location";"Age"\n"1";"a, b, c";"18"\n2;d;NULL\n3;"e;f";\n')
    got = rows(files.read_delimited(spark, str(path), schemas.READER))
    assert got == [("1", "a, b, c", "18"), ("2", "d", "NULL"), ("3", "e;f", None)]


def test_inferred_keeps_named_columns_as_text(spark, tmp_path):
    path = tmp_path / "books.csv"
    path.write_text("ISBN;Year\n0012;1999\n0450;2001\n")
    plain = files.read_inferred(spark, str(path), sep=";")
    assert dict(plain.dtypes) == {"ISBN": "int", "Year": "int"}
    kept = files.read_inferred(spark, str(path), sep=";", text_columns=("ISBN",))
    assert [tuple(r) for r in kept.collect()] == [("0012", 1999), ("0450", 2001)]


def test_triplets_keep_lines_that_do_not_fit(spark, tmp_path, rows):
    path = tmp_path / "triplets.txt"
    path.write_text("1,2,3.5\n4,044X,1\n5,6,7\n")
    got = rows(files.read_triplets(spark, str(path)).cache())
    assert (1, 2, 3.5, None) in got and (5, 6, 7.0, None) in got
    (bad,) = [r for r in got if r[3]]
    assert bad == (4, None, 1.0, "4,044X,1")


def test_quoted_export_reads_back(spark, tmp_path, rows):
    names = records.from_records(
        spark, [(0, 'An "x"', "Li, B"), (7, "C", None)], schemas.NAME
    )
    for one_file in (True, False):
        path = str(tmp_path / f"out{one_file}")
        files.write_quoted(names, path, one_file)
        text = [r.value for r in spark.read.text(path).collect()]
        assert '"id","firstname","lastname"' in text
        assert '"0","An ""x""","Li, B"' in text
        back = spark.read.csv(path, header=True, escape='"')
        assert rows(back) == [("0", 'An "x"', "Li, B"), ("7", "C", None)]
    assert len(list((tmp_path / "outTrue").glob("part-*"))) == 1


def test_records_with_nested_list(spark):
    student = (12, "2011", [("C1", "Spring"), ("C2", "Fall")], "Ann")
    df = records.from_records(spark, [student], schemas.STUDENT)
    assert df.first().courses_registered[1].sem == "Fall"


def test_inferred_json_schema(spark, rows):
    texts = spark.createDataFrame(
        [('{"b":1,"a":"x","o":{"q":[1,2.5]},"z z":null}',),
         ('{"b":1.5,"a":3,"c":true,"e":{},"OBJECT":1}',), ("bad",), (None,)], "value string",
    )
    schema = json_text.infer_fields(texts)
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert kinds == {
        "OBJECT": "bigint", "a": "string", "b": "double", "c": "boolean", "e": "string",
        "o": "struct<q:array<double>>", "z z": "string",
    }
    got = json_text.read_json_column(texts.limit(2), schema=schema).select("a", "b").collect()
    assert sorted(tuple(r) for r in got) == [("3", 1.5), ("x", 1.0)]


def test_inference_of_nothing(spark):
    empty = spark.createDataFrame([], "value string")
    assert json_text.infer_fields(empty).fields == []
