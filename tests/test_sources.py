from __future__ import annotations

import pickle
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from clearwell.plans.datasets import EXTERNAL_NUTRI
from clearwell.sources import scan, sinks, tables

CSV = 'Code,Size,Note\nAL,1,"said ""hi"", left"\nAK,x,NA\nAZ,,\n'


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(CSV)
    return str(path)


def test_typed_csv_nulls_bad_cells_and_keeps_quotes(spark, csv):
    rows = scan.read_csv(spark, csv, T.StructType.fromDDL("Code STRING, Size INT, Note STRING")).collect()
    assert [tuple(r) for r in rows] == [
        ("AL", 1, 'said "hi", left'), ("AK", None, "NA"), ("AZ", None, None),
    ]


def test_bad_cells_may_be_refused(spark, csv):
    strict = scan.read_csv(spark, csv, T.StructType.fromDDL("Code STRING, Size INT, Note STRING"), bad_cells_as_null=False)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        strict.collect()


def test_text_inferred_and_pandas_like_csv(spark, csv):
    assert {t for _, t in scan.read_csv(spark, csv).dtypes} == {"string"}
    inferred = scan.read_csv(spark, csv, infer=True)
    assert dict(inferred.dtypes)["Code"] == "string"
    assert [r.Note for r in scan.read_csv_like_pandas(spark, csv).collect()] == ['said "hi", left', None, None]
    typed = scan.read_csv_like_pandas(spark, csv, T.StructType.fromDDL("Note STRING, Size INT"))
    assert [tuple(r) for r in typed.collect()] == [('said "hi", left', 1), (None, None), (None, None)]


def test_a_code_that_looks_like_a_time_stays_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text("TopicID\nT2\n")
    schema = T.StructType.fromDDL("TopicID STRING")
    assert scan.read_csv(spark, str(tmp_path / "t.csv"), schema).first()[0] == "T2"


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "m.csv").write_text('a,b\n"x\ny",1\n')
    rows = scan.read_csv(spark, str(tmp_path / "m.csv"), multiline=True).collect()
    assert [tuple(r) for r in rows] == [("x\ny", "1")]


def test_a_file_with_another_column_order_is_refused(spark, tmp_path):
    (tmp_path / "part-0.csv").write_text("a,b\n1,2\n")
    (tmp_path / "part-1.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception):
        scan.read_csv(spark, str(tmp_path), T.StructType.fromDDL("a INT, b INT")).collect()


def test_parts_of_folders_are_combined_by_name(spark, tmp_path, rows):
    for name, body in {"x": "a,b\n1,2\n", "y": "b,c\n3,4\n"}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.csv").write_text(body)
        (tmp_path / name / "ignored.txt").write_text("zzz\n")
    parts = scan.read_parts(spark, [str(tmp_path / "x"), str(tmp_path / "y")])
    assert parts.columns == ["a", "b", "c"]
    assert rows(parts) == sorted([("1", "2", None), (None, "3", "4")], key=repr)


def test_list_inputs(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text("x\n")
    (tmp_path / "sub" / "b.csv").write_text("xy\n")
    (tmp_path / "c.parquet").write_text("zz")
    found = scan.list_inputs(spark, str(tmp_path), ".csv")
    assert sorted((r.path.rsplit("/", 1)[1], r.length) for r in found.collect()) == [("a.csv", 2), ("b.csv", 3)]
    with pytest.raises(FileNotFoundError):
        scan.list_inputs(spark, str(tmp_path), ".orc")


def test_missing_input_raises_or_is_skipped(spark, tmp_path):
    absent = str(tmp_path / "absent.csv")
    with pytest.raises(FileNotFoundError, match="absent.csv"):
        scan.read_if_present(lambda: scan.read_csv(spark, absent), absent)
    assert scan.read_if_present(lambda: scan.read_csv(spark, absent), absent, required=False) is None


def test_landing_counts_rows_per_file(spark, tmp_path, rows):
    land = tmp_path / "land"
    land.mkdir()
    (land / "one.csv").write_text("Age(years),b c\n1,2\n3,4\n")
    (land / "two.csv").write_text("Age(years),b c\n5,6\n")
    counts = scan.ingest_landing(spark, {"ages": str(land)}, str(tmp_path / "bronze"))
    assert rows(counts) == [("ages", "one.csv", 2), ("ages", "two.csv", 1)]
    bronze = tables.read_table(spark, str(tmp_path / "bronze" / "ages"))
    assert bronze.columns == ["Ageyears", "b_c", "source_file"]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_write_and_verify(spark, tmp_path, fmt):
    df = spark.range(100).selectExpr("id", "concat('a,\"', id) AS t")
    report = sinks.write_and_verify(df, str(tmp_path / "out"), fmt).first()
    assert tuple(report) == (100, 100, 2, 2, True)


def test_csv_round_trip_keeps_quotes_separators_and_nulls(spark, tmp_path, rows):
    df = spark.createDataFrame([('a "q", b', 1), (None, 2), ("back\\slash", 3), ("  blanks\t ", 4)], "t string, n int")
    path = sinks.write_csv(df, str(tmp_path / "c"))
    assert rows(scan.read_csv(spark, path, df.schema)) == rows(df)


def test_overwriting_replaces_rows(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.write_parquet(spark.range(10), path, max_rows_per_file=4)
    sinks.write_parquet(spark.range(3), path)
    assert scan.read_parquet(spark, path).count() == 3


def test_external_table_over_csv_nulls_invalid_cells(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "a.csv").write_text('YearStart,Note\n2011,"x, y"\nbad,z\n')
    declared = T.StructType.fromDDL("YearStart INT, Note STRING")
    table = tables.external_table(
        spark, "external_csv_test", str(tmp_path / "e"), declared, "csv", {"header": "true", "quote": '"'}
    )
    assert sorted((tuple(r) for r in table.collect()), key=repr) == [(2011, "x, y"), (None, "z")]
    assert len(EXTERNAL_NUTRI) == 26


def test_truncate_and_load_replaces_and_conforms(spark, tmp_path):
    declared = T.StructType.fromDDL("b INT, a VARCHAR(5), row_num INT NOT NULL")
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("x", "1", 1), ("y", "2", 2)], "a string, b string, row_num int")
    tables.truncate_and_load(first, "truncate_test", path, declared)
    second = first.filter("a = 'y'")
    loaded = tables.truncate_and_load(second, "truncate_test", path, declared)
    assert loaded.columns == ["b", "a", "row_num"]
    assert [tuple(r) for r in loaded.collect()] == [(2, "y", 2)]
    with pytest.raises(Exception, match="row_num must not be null"):
        tables.truncate_and_load(second.withColumn("row_num", F.lit(None)), "truncate_test", path, declared)


def test_named_table_and_view(spark, tmp_path):
    tables.ensure_database(spark, "default")
    saved = tables.save_named_table(spark.range(4), "named_test", str(tmp_path / "n"))
    assert saved.count() == 4
    saved = tables.save_named_table(spark.range(2), "named_test", str(tmp_path / "n"))
    assert saved.count() == 2
    sinks.register_view(saved, "named_view")
    assert spark.sql("SELECT count(*) FROM named_view").first()[0] == 2


def test_preview_shows_rows(spark, capsys):
    df = spark.range(9)
    assert sinks.preview(df) is df
    assert "only showing top 5 rows" in capsys.readouterr().out


class Recorder:
    """Stands in for a DataFrame whose JDBC writer must not connect anywhere."""

    def __init__(self):
        self.calls = []
        self.tasks = None
        self.write = self

    def repartition(self, tasks):
        self.tasks = tasks
        return self

    def jdbc(self, url, table, mode, properties):
        self.calls.append((url, table, mode, properties))


def test_relational_load_replaces_in_batches_over_a_bounded_number_of_connections():
    df = Recorder()
    sinks.load_relational(df, "jdbc:postgresql://host/db", "staging.heart", {"user": "u"}, connections=4)
    assert df.calls == [
        ("jdbc:postgresql://host/db", "staging.heart", "overwrite",
         {"batchsize": "5000", "numPartitions": "4", "user": "u"})
    ]
    assert df.tasks == 4


def test_file_to_table_map_skips_missing_files(spark, csv, tmp_path):
    loaded = []
    names = sinks.load_files(
        spark,
        {csv: "here", str(tmp_path / "none.csv"): "not_here"},
        lambda df, table: loaded.append((table, df.count())),
    )
    assert names == ["here"] and loaded == [("here", 3)]


def test_items_are_sent_in_batches_of_25_with_decimals(spark, tmp_path):
    folder = str(tmp_path)

    def put_batch(items):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "wb") as out:
            pickle.dump(items, out)

    items = spark.range(0, 60, 1, 1).selectExpr("to_json(struct(id AS k, id + 0.5D AS v)) AS item")
    assert sinks.write_items(items, put_batch) == 60
    batches = [pickle.loads(f.read_bytes()) for f in tmp_path.iterdir()]
    assert sorted(len(b) for b in batches) == [10, 25, 25]
    sent = {i["k"]: i["v"] for b in batches for i in b}
    assert sent[3] == Decimal("3.5") and len(sent) == 60
    assert sinks.write_items(items.limit(0), put_batch) == 0


def test_parts_of_one_folder_are_read_by_their_own_header(spark, tmp_path):
    files = {
        "part-0.csv": "a,b\n1,x\n2,y\n",
        "part-1.csv": "b,a\nz,3\n",
        "part-2.csv": '"the, note",a\n"q ""1""",4\n',
        "part-3.csv": "a,b\n",
        "part-4 %25.csv": "a,b\n5,v\n",
        "part-5.csv": "",
        "other.csv": "a,b\n9,w\n",
    }
    for name, content in files.items():
        (tmp_path / name).write_text(content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    index = scan.header_index(spark, str(tmp_path), "part-*.csv")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert {names: len(found) for names, found in index.items()} == {("a", "b"): 3, ("b", "a"): 1, ("the, note", "a"): 1}
    typed = scan.read_parts(spark, str(tmp_path), T.StructType.fromDDL("a INT, b STRING, c DOUBLE"))
    assert typed.columns == ["a", "b", "c", "the, note"] and typed.schema["a"].dataType == T.IntegerType()
    assert sorted(map(tuple, typed.collect())) == [
        (1, "x", None, None), (2, "y", None, None), (3, "z", None, None), (4, None, None, 'q "1"'), (5, "v", None, None)
    ]
    with pytest.raises(FileNotFoundError):
        scan.read_parts(spark, str(tmp_path), pattern="none-*.csv")


def test_only_the_beginning_of_a_file_is_read_for_its_header(spark, tmp_path):
    # Far beyond what a task hands over at once; a bad line at the end is not met.
    (tmp_path / "part-0.csv").write_text("a,b\n" + "1,2\n" * 500_000)
    assert list(scan.header_index(spark, str(tmp_path)).values())[0][0].endswith("part-0.csv")
    assert scan.read_parts(spark, str(tmp_path)).count() == 500_000


def test_a_load_that_does_not_fit_fails_and_leaves_the_table(spark, tmp_path):
    declared = T.StructType.fromDDL("n INT, t VARCHAR(3) NOT NULL")
    path = str(tmp_path / "t")
    good = spark.createDataFrame([("1", "a"), (None, "b")], "n string, t string")
    assert tables.truncate_and_load(good, "strict_load_test", path, declared).count() == 2
    for bad in (("12x", "c"), ("1", "long"), ("1", None), ("99999999999", "c")):
        with pytest.raises(Exception, match="n: no int|longer|null"):
            tables.truncate_and_load(spark.createDataFrame([bad], good.schema), "strict_load_test", path, declared)
        assert spark.table("strict_load_test").count() == 2


def test_rejects_keep_their_cells_and_say_why(spark, tmp_path):
    declared = T.StructType.fromDDL("n INT, t VARCHAR(3) NOT NULL")
    rows = [("1", "a", 1), ("12x", "long", 2), ("7", None, 3), ("x", None, 4), (None, "ok", 5)]
    df = spark.createDataFrame(rows, "n string, t string, id int")
    loaded = tables.truncate_and_load(df, "reject_load_test", str(tmp_path / "t"), declared, str(tmp_path / "rejects"))
    assert sorted(map(tuple, loaded.collect()), key=repr) == [(1, "a"), (None, "ok")]
    rejects = {r.id: (r.n, r.t, r.reason) for r in spark.read.parquet(str(tmp_path / "rejects")).collect()}
    assert rejects == {
        2: ("12x", "long", "n: no int; t: text longer than 3"),
        3: ("7", None, "t: must not be null"),
        4: ("x", None, "n: no int; t: must not be null"),
    }
    with pytest.raises(ValueError, match="reason"):
        tables.truncate_and_load(df.withColumnRenamed("id", "reason"), "reject_load_test", str(tmp_path / "t"), declared, "x")
