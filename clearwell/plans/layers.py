"""Bronze, silver and gold tables, and runners over several datasets."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from clearwell.operators.columns import col, storable_names
from clearwell.plans.curate import curate
from clearwell.session import exists
from clearwell.sources.scan import read_csv, read_if_present
from clearwell.sources.sinks import register_view
from clearwell.sources.tables import read_table, write_table


class Layers:
    """The three layers of a set of datasets below one root folder.

    Each step reads the table of the step before. A run with a name keeps a ledger of the layers it has written, below
    ``ledger``; if it fails, the next run of that name goes on where it stopped.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self._filled: dict[str, dict[str, int]] = {}

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, self.path(layer, name), self.fmt)

    def bronze(self, name: str, raw: DataFrame) -> DataFrame:
        """Raw rows under names that the table format accepts.

        The write itself counts the values of every column, which spares the next layer a scan.
        """
        named = storable_names(raw)
        if named.columns:
            counted = Observation()
            # Observed under plain names: a column may be called anything.
            counts = [F.count(col(c)).alias(f"c{i}") for i, c in enumerate(named.columns)]
            write_table(named.observe(counted, *counts), self.path("bronze", name), self.fmt)
            self._filled[name] = {c: counted.get[f"c{i}"] for i, c in enumerate(named.columns)}
        else:
            write_table(named, self.path("bronze", name), self.fmt)
        return self.read("bronze", name)

    def empty_columns(self, name: str) -> list[str] | None:
        """Columns of the bronze table without a value; None if the write was not seen."""
        if name not in self._filled:
            return None
        return [c for c, n in self._filled[name].items() if n == 0]

    def silver(self, name: str, clean: Callable[..., DataFrame] = curate) -> DataFrame:
        """Curated rows, also registered as the view ``silver_<name>``.

        A ``clean`` with a parameter ``empty`` is told which columns hold no value.
        """
        known = {"empty": self.empty_columns(name)} if "empty" in inspect.signature(clean).parameters else {}
        write_table(clean(self.read("bronze", name), **known), self.path("silver", name), self.fmt)
        return self._registered(name)

    def _registered(self, name: str) -> DataFrame:
        silver = self.read("silver", name)
        register_view(silver, f"silver_{name}")
        return silver

    def gold(self, name: str) -> DataFrame:
        """The published copy of the silver table, on a path of its own."""
        write_table(self.read("silver", name), self.path("gold", name), self.fmt)
        return self.read("gold", name)

    def _commit(self, run: str, layer: str, name: str) -> None:
        """Note that this run has written a layer: one row, with what later layers want to know."""
        counts = self._filled.get(name, {})
        entry = self.spark.createDataFrame([(layer, name, counts)], "layer string, name string, filled map<string,bigint>")
        entry.coalesce(1).write.mode("overwrite").json(f"{self.root}/ledger/{run}/{name}/{layer}")

    def _committed(self, run: str, layer: str, name: str) -> bool:
        path = f"{self.root}/ledger/{run}/{name}/{layer}"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            return False
        entry = self.spark.read.schema("layer string, name string, filled map<string,bigint>").json(path).first()
        if entry.filled:
            self._filled[name] = dict(entry.filled)
        return True

    def run(
        self,
        sources: Mapping[str, DataFrame],
        clean: Callable[..., DataFrame] = curate,
        name: str | None = None,
    ) -> dict[str, DataFrame]:
        """All layers of all sources.

        Layers that a run of this ``name`` has written before are not written again. A run without a name, or with a
        new one, writes all of them.
        """
        published = {}
        for dataset, raw in sources.items():
            steps = {
                "bronze": lambda: self.bronze(dataset, raw),
                "silver": lambda: self.silver(dataset, clean),
                "gold": lambda: self.gold(dataset),
            }
            for layer, step in steps.items():
                if name is not None and self._committed(name, layer, dataset):
                    if layer == "silver":
                        self._registered(dataset)
                    continue
                step()
                if name is not None:
                    self._commit(name, layer, dataset)
            published[dataset] = self.read("gold", dataset)
        return published


def run_datasets(
    spark: SparkSession,
    sources: Mapping[str, str],
    clean: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame, str], object],
    read: Callable[[SparkSession, str], DataFrame] = read_csv,
    required: bool = True,
) -> list[str]:
    """Read, clean and write every source; the map leads from input path to output path.

    The loop runs on the driver over a handful of datasets; all the work inside it is distributed.
    """
    written = []
    for path, out in sources.items():
        df = read_if_present(lambda: read(spark, path), path, required)
        if df is not None:
            write(clean(df), out)
            written.append(out)
    return written
