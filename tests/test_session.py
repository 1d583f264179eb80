from __future__ import annotations

from clearwell import session


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Session:
    def __init__(self, **settings):
        self.conf = Conf({k.replace("_", "."): v for k, v in settings.items()})


def test_the_named_folder_is_used():
    assert session.shared_folder(Session(spark_checkpoint_dir="hdfs://x/ck/")) == "hdfs://x/ck"


def test_without_a_named_folder_the_warehouse_is_used():
    found = session.shared_folder(Session(spark_sql_warehouse_dir="hdfs://x/warehouse/"))
    assert found == "hdfs://x/warehouse/.staging"


def test_new_folders_differ(spark):
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")


def test_a_staged_table_no_longer_depends_on_its_plan(spark, plan_of):
    staged = session.stage(spark.range(5).selectExpr("id * 2 AS v"), "test")
    assert sorted(r.v for r in staged.collect()) == [0, 2, 4, 6, 8]
    assert "Range" not in plan_of(staged)


def exists(spark, df):
    path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_staged_data_are_removed_by_their_owner(spark):
    outside = session.stage(spark.range(3), "outside")
    with session.staging(spark):
        inside, gone = (session.stage(spark.range(3), "inside") for _ in range(2))
        session.discard(gone)
        assert inside.count() == 3 and not exists(spark, gone)
    assert not exists(spark, inside) and exists(spark, outside)
    session.discard(outside)
    assert not exists(spark, outside)
