from __future__ import annotations

import os

from pyspark.sql import types as T

from clearwell.streaming.landing import land_new_files


def test_only_new_files_are_landed(spark, tmp_path):
    landing, bronze, progress = (str(tmp_path / n) for n in ("landing", "bronze", "progress"))
    (tmp_path / "landing").mkdir()
    schema = T.StructType.fromDDL("a INT, b STRING")
    (tmp_path / "landing" / "one.csv").write_text('a,b\n1,"x, y"\n2,z\n')
    land_new_files(spark, landing, schema, bronze, progress)
    (tmp_path / "landing" / "two.csv").write_text("a,b\n3,w\n")
    land_new_files(spark, landing, schema, bronze, progress)
    land_new_files(spark, landing, schema, bronze, progress)
    (tmp_path / "landing" / "late.csv").write_text("a,b\n4,v\n")
    os.utime(tmp_path / "landing" / "late.csv", (86_400 * 365, 86_400 * 365))
    land_new_files(spark, landing, schema, bronze, progress)
    rows = spark.read.parquet(bronze).collect()
    assert sorted(tuple(r) for r in rows) == [
        (1, "x, y", "one.csv"), (2, "z", "one.csv"), (3, "w", "two.csv"),
        (4, "v", "late.csv"),
    ]
