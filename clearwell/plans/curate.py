"""The row-dropping cleaner: curated rows of one country's states, ranked per location."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from clearwell.functions import numbers, text
from clearwell.operators import columns as cols, ranking, rows
from clearwell.session import stage
from clearwell.sources.tables import write_table

# The codes that are not states, the columns without use, the spellings of a unit.
EXCLUDED_LOCATIONS = ("PR", "GU", "VI", "AS", "MP", "US")
FOOTNOTE_COLUMNS = ("data_value_footnote", "data_value_footnote_symbol")
UNIT_SPELLINGS = {
    "per 100,000": "cases per 100,000",
    "  cases per 100,000": "cases per 100,000",
    "cases per 1,000,000": "cases per 1,000,000",
    "cases per 1,000": "cases per 1,000",
    "per 100,000 population": "cases per 100,000",
}


class UnreadableMetrics(ValueError):
    """Some rows have a metric that is no number."""


def curate(
    df: DataFrame,
    location: str = "location_abbr",
    metric: str = "data_value",
    unit: str = "data_value_unit",
    ties: Sequence[str] = (),
    empty: Iterable[str] | None = None,
    quarantine: str | None = None,
) -> DataFrame:
    """Drop empty columns, rename, filter locations, trim, deduplicate, unify units, drop rows
    without a metric and number the rows of each location by descending metric.

    Copies are removed after trimming. Without a metric column the rows are not ranked. ``empty`` names the columns
    without a value where they are known already, such as from the write of the table; otherwise one aggregate finds them.

    A metric held as text is read as a number before ranking, as text order would put '9' above '10'. Rows with a text
    that is no number, such as '<5', are never lost: they fail the run, or are kept as they are in the table
    ``quarantine``. Texts that stand for missing, such as 'NA', are missing.
    """
    kept = cols.snake_names(cols.drop_null_columns(df) if empty is None else cols.drop_present(df, empty))
    states = rows.exclude_codes(kept, location, EXCLUDED_LOCATIONS)
    clean = states.transform(cols.drop_present, FOOTNOTE_COLUMNS).transform(cols.trim_text)
    clean = rows.dedupe(clean)
    if unit in clean.columns:
        clean = rows.replace_values(clean, unit, UNIT_SPELLINGS)
    if metric not in clean.columns:
        return clean
    if isinstance(clean.schema[metric].dataType, T.StringType):
        clean = _readable(clean, metric, quarantine)
    else:
        # Ranking looks at its input more than once: the rows are joined and merged only here.
        clean = stage(rows.drop_missing(clean, [metric]), "curated-rows")
    # Rows are distinct but for those that differed only in the spelling of the unit.
    return ranking.rank_by_value(clean, location, metric, ties, distinct=True)


def _readable(clean: DataFrame, metric: str, quarantine: str | None) -> DataFrame:
    """Rows with the metric as a number; those whose text is none are counted as they are staged."""
    given = text.null_if_token(cols.col(metric))
    number = numbers.parse_double(given)
    seen = Observation()
    checked = clean.withColumn("__number", number).withColumn("__unreadable", given.isNotNull() & number.isNull())
    checked = checked.filter(given.isNotNull())
    staged = stage(checked.observe(seen, F.count_if("__unreadable").alias("n")), "curated-rows")
    unreadable = seen.get["n"]
    if unreadable and quarantine is None:
        raise UnreadableMetrics(f"{unreadable} rows have a {metric} that is no number; name a quarantine to keep them")
    if quarantine is not None:
        write_table(staged.filter("__unreadable").drop("__number", "__unreadable"), quarantine)
    readable = staged.filter("NOT __unreadable").withColumn(metric, F.col("__number"))
    return readable.drop("__number", "__unreadable")
