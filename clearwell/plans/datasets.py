"""The three public-health datasets: raw and target schemas, and their check suites."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, types as T

from clearwell.functions.text import snake_name
from clearwell.operators import checks as ck
from clearwell.operators.columns import with_interval_flag

_INT, _FLOAT, _DOUBLE, _TEXT = T.IntegerType(), T.FloatType(), T.DoubleType(), T.StringType()

# The columns of the raw files.
RAW_CHRONIC = T.StructType(
    [
        T.StructField("YearStart", _INT),
        T.StructField("YearEnd", _INT),
        T.StructField("LocationAbbr", _TEXT),
        T.StructField("LocationDesc", _TEXT),
        T.StructField("DataSource", _TEXT),
        T.StructField("Topic", _TEXT),
        T.StructField("Question", _TEXT),
        T.StructField("Response", _TEXT),
        T.StructField("DataValueUnit", _TEXT),
        T.StructField("DataValueType", _TEXT),
        T.StructField("DataValue", _DOUBLE),
        T.StructField("DataValueAlt", _DOUBLE),
        T.StructField("DataValueFootnoteSymbol", _TEXT),
        T.StructField("DataValueFootnote", _TEXT),
        T.StructField("LowConfidenceLimit", _DOUBLE),
        T.StructField("HighConfidenceLimit", _DOUBLE),
        T.StructField("StratificationCategory1", _TEXT),
        T.StructField("Stratification1", _TEXT),
        T.StructField("StratificationCategory2", _TEXT),
        T.StructField("Stratification2", _TEXT),
        T.StructField("StratificationCategory3", _TEXT),
        T.StructField("Stratification3", _TEXT),
        T.StructField("Geolocation", _TEXT),
        T.StructField("LocationID", _INT),
        T.StructField("TopicID", _TEXT),
        T.StructField("QuestionID", _TEXT),
        T.StructField("ResponseID", _TEXT),
        T.StructField("DataValueTypeID", _TEXT),
        T.StructField("StratificationCategoryID1", _TEXT),
        T.StructField("StratificationID1", _TEXT),
        T.StructField("StratificationCategoryID2", _TEXT),
        T.StructField("StratificationID2", _TEXT),
        T.StructField("StratificationCategoryID3", _TEXT),
        T.StructField("StratificationID3", _TEXT),
    ]
)
RAW_HEART = T.StructType(
    [
        T.StructField("Year", _INT),
        T.StructField("LocationAbbr", _TEXT),
        T.StructField("LocationDesc", _TEXT),
        T.StructField("GeographicLevel", _TEXT),
        T.StructField("DataSource", _TEXT),
        T.StructField("Class", _TEXT),
        T.StructField("Topic", _TEXT),
        T.StructField("Data_Value", _DOUBLE),
        T.StructField("Data_Value_Unit", _TEXT),
        T.StructField("Data_Value_Type", _TEXT),
        T.StructField("Data_Value_Footnote_Symbol", _TEXT),
        T.StructField("Data_Value_Footnote", _TEXT),
        T.StructField("StratificationCategory1", _TEXT),
        T.StructField("Stratification1", _TEXT),
        T.StructField("StratificationCategory2", _TEXT),
        T.StructField("Stratification2", _TEXT),
        T.StructField("TopicID", _TEXT),
        T.StructField("LocationID", _INT),
        T.StructField("Y_lat", _DOUBLE),
        T.StructField("X_lon", _DOUBLE),
        T.StructField("Georeference", _TEXT),
    ]
)
RAW_NUTRI = T.StructType(
    [
        T.StructField("YearStart", _INT),
        T.StructField("YearEnd", _INT),
        T.StructField("LocationAbbr", _TEXT),
        T.StructField("LocationDesc", _TEXT),
        T.StructField("Datasource", _TEXT),
        T.StructField("Class", _TEXT),
        T.StructField("Topic", _TEXT),
        T.StructField("Question", _TEXT),
        T.StructField("Data_Value_Unit", _TEXT),
        T.StructField("Data_Value_Type", _TEXT),
        T.StructField("Data_Value", _DOUBLE),
        T.StructField("Data_Value_Alt", _DOUBLE),
        T.StructField("Data_Value_Footnote_Symbol", _TEXT),
        T.StructField("Data_Value_Footnote", _TEXT),
        T.StructField("Low_Confidence_Limit", _DOUBLE),
        T.StructField("High_Confidence_Limit", _DOUBLE),
        T.StructField("Sample_Size", _INT),
        T.StructField("Total", _TEXT),
        T.StructField("Age(years)", _TEXT),
        T.StructField("Education", _TEXT),
        T.StructField("Sex", _TEXT),
        T.StructField("Income", _TEXT),
        T.StructField("Race/Ethnicity", _TEXT),
        T.StructField("GeoLocation", _TEXT),
        T.StructField("ClassID", _TEXT),
        T.StructField("TopicID", _TEXT),
        T.StructField("QuestionID", _TEXT),
        T.StructField("DataValueTypeID", _TEXT),
        T.StructField("LocationID", _INT),
        T.StructField("StratificationCategory1", _TEXT),
        T.StructField("Stratification1", _TEXT),
        T.StructField("StratificationCategoryId1", _TEXT),
        T.StructField("StratificationID1", _TEXT),
    ]
)

# The columns of the target tables. The topic of a heart row is a code such as T2,
# which a type-guessing reader takes for a time of day; here it is declared as text.
WAREHOUSE_CHRONIC = T.StructType(
    [
        T.StructField("year_start", _INT),
        T.StructField("year_end", _INT),
        T.StructField("location_abbr", T.VarcharType(10)),
        T.StructField("location_desc", T.VarcharType(255)),
        T.StructField("data_source", T.VarcharType(255)),
        T.StructField("topic", T.VarcharType(255)),
        T.StructField("question", T.VarcharType(500)),
        T.StructField("data_value_unit", T.VarcharType(100)),
        T.StructField("data_value_type", T.VarcharType(100)),
        T.StructField("data_value", _DOUBLE),
        T.StructField("data_value_alt", _DOUBLE),
        T.StructField("low_confidence_limit", _DOUBLE),
        T.StructField("high_confidence_limit", _DOUBLE),
        T.StructField("stratification_category1", T.VarcharType(100)),
        T.StructField("stratification1", T.VarcharType(100)),
        T.StructField("geolocation", T.VarcharType(200)),
        T.StructField("location_id", _INT),
        T.StructField("topic_id", T.VarcharType(50)),
        T.StructField("question_id", T.VarcharType(50)),
        T.StructField("data_value_type_id", T.VarcharType(50)),
        T.StructField("stratification_category_id1", T.VarcharType(50)),
        T.StructField("stratification_id1", T.VarcharType(50)),
        T.StructField("row_num", _INT, nullable=False),
    ]
)
WAREHOUSE_HEART = T.StructType(
    [
        T.StructField("year", _INT),
        T.StructField("location_abbr", T.VarcharType(10)),
        T.StructField("location_desc", T.VarcharType(255)),
        T.StructField("geographic_level", T.VarcharType(100)),
        T.StructField("data_source", T.VarcharType(255)),
        T.StructField("class", T.VarcharType(255)),
        T.StructField("topic", T.VarcharType(255)),
        T.StructField("data_value", _DOUBLE),
        T.StructField("data_value_unit", T.VarcharType(50)),
        T.StructField("data_value_type", T.VarcharType(100)),
        T.StructField("stratification_category1", T.VarcharType(100)),
        T.StructField("stratification1", T.VarcharType(100)),
        T.StructField("stratification_category2", T.VarcharType(100)),
        T.StructField("stratification2", T.VarcharType(100)),
        T.StructField("topic_id", T.VarcharType(50)),
        T.StructField("location_id", _INT),
        T.StructField("y_lat", _DOUBLE),
        T.StructField("x_lon", _DOUBLE),
        T.StructField("georeference", T.VarcharType(100)),
        T.StructField("row_num", _INT, nullable=False),
    ]
)
EXTERNAL_NUTRI = T.StructType(
    [
        T.StructField("YearStart", _INT),
        T.StructField("YearEnd", _INT),
        T.StructField("LocationAbbr", _TEXT),
        T.StructField("LocationDesc", _TEXT),
        T.StructField("Datasource", _TEXT),
        T.StructField("Class", _TEXT),
        T.StructField("Question", _TEXT),
        T.StructField("Data_Value_Type", _TEXT),
        T.StructField("Data_Value", _FLOAT),
        T.StructField("Data_Value_Alt", _FLOAT),
        T.StructField("Low_Confidence_Limit", _FLOAT),
        T.StructField("High_Confidence_Limit", _FLOAT),
        T.StructField("Sample_Size", _INT),
        T.StructField("Total", _TEXT),
        T.StructField("Age_Range", _TEXT),
        T.StructField("Education", _TEXT),
        T.StructField("Income_Range", _TEXT),
        T.StructField("Race_Ethnicity", _TEXT),
        T.StructField("GeoLocation", _TEXT),
        T.StructField("ClassID", _TEXT),
        T.StructField("TopicID", _TEXT),
        T.StructField("QuestionID", _TEXT),
        T.StructField("DataValueTypeID", _TEXT),
        T.StructField("LocationID", _TEXT),
        T.StructField("StratificationCategory1", _TEXT),
        T.StructField("Stratification1", _TEXT),
    ]
)


def external_schema(warehouse: T.StructType) -> T.StructType:
    """The same columns without lengths and NOT NULL, as an external table declares them."""
    plain = [
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType)
        for f in warehouse
    ]
    return T.StructType(plain)


# Codes of states, territories and the national total that a cleaned table may hold.
LOCATION_CODES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DC", "DE", "FL", "GA", "HI", "ID", "IL", "IN",
    "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH",
    "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT",
    "VT", "VA", "WA", "WV", "WI", "WY", "US", "PR", "GU", "AI", "VI", "MP",
)

# Fixed value: the condition of a metric outside its confidence interval.
OUTSIDE_INTERVAL = (
    "high_confidence_limit IS NOT NULL AND low_confidence_limit IS NOT NULL "
    "AND data_value IS NOT NULL "
    "AND (high_confidence_limit < data_value OR low_confidence_limit > data_value)"
)
# The zero-filling cleaner turns an unknown interval into 0 to 0.
INTERVAL_KNOWN = "(high_confidence_limit != 0 OR low_confidence_limit != 0)"


def batch_suite(df: DataFrame, last_year: int = 2024) -> tuple[DataFrame, list[ck.Check]]:
    """The one suite for any cleaned batch, and the batch with the interval flag it needs.

    Value checks are added for the columns the batch has. The column count includes the flag, so it
    fails for a batch without confidence limits, as do the checks for the six required columns.
    """
    limits = ["low_confidence_limit", "high_confidence_limit"]
    required = ["year_start", "location_abbr", "data_value", *limits, "stratification_value"]
    suite: list[ck.Check] = [ck.RowCountBetween(None, 50_000, 200_000)]
    suite.append(ck.ColumnCount(None, len(df.columns) + 1))
    suite += [ck.ColumnExists(c) for c in required]
    by_column = [
        ck.ValuesBetween("year_start", 2011, last_year),
        ck.ValuesInSet("location_abbr", LOCATION_CODES),
        ck.ValuesMatch("location_abbr", "^[A-Z]{2}$"),
        ck.ValuesBetween("data_value", 0, 86),
        # The drift comparison reads the null rate from this check.
        ck.ValuesNotNull("data_value"),
    ]
    suite += [c for c in by_column if c.applies_to(df)]
    if set(limits) <= set(df.columns):
        df = with_interval_flag(df, *limits)
        suite.append(ck.TrueFlag("low_le_high"))
    return df, suite


@dataclass(frozen=True)
class Dataset:
    """What the pipelines and suites need to know about one dataset."""

    name: str
    raw: T.StructType
    year: str
    # Bounds of the row count: expectation suite, YAML-style rules, layered tables.
    rows_expected: tuple[int, int]
    rows_by_rule: tuple[int, int]
    rows_curated: tuple[int, int]
    # Highest plausible metric; None where there is no upper bound.
    metric_max: float | None
    has_limits: bool
    keys: tuple[str, ...]
    other_years: tuple[str, ...] = ()
    learned: tuple[str, ...] = ()
    # Columns whose values must be among those of the baseline batch.
    categories: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    rule_checks: tuple[ck.Check, ...] = field(default=())

    def expectations(self, df: DataFrame, last_year: int = 2024) -> list[ck.Check]:
        """Suite for a table of the zero-filling cleaner, with the interval flag added to ``df``
        where the dataset has confidence limits. Unlike ``batch_suite`` it asks only for columns the
        dataset has, and bounds the metric from above only where it is a percentage."""
        required = [self.year, "location_abbr", "data_value", "stratification_value"]
        if self.has_limits:
            required += ["low_confidence_limit", "high_confidence_limit", "low_le_high"]
        suite: list[ck.Check] = [ck.RowCountBetween(None, *self.rows_expected)]
        suite.append(ck.ColumnCount(None, len(df.columns)))
        suite += [ck.ColumnExists(c) for c in required]
        suite += [
            ck.ValuesBetween(self.year, 2011, last_year),
            ck.ValuesInSet("location_abbr", LOCATION_CODES),
            ck.ValuesMatch("location_abbr", "^[A-Z]{2}$"),
            ck.ValuesBetween("data_value", 0, self.metric_max),
            # The drift comparison reads the null rate from this check.
            ck.ValuesNotNull("data_value"),
        ]
        if self.has_limits:
            suite.append(ck.TrueFlag("low_le_high"))
        return suite

    def rules(self) -> list[ck.Check]:
        """The rules that are usually kept as YAML."""
        suite: list[ck.Check] = [ck.RowCountRule(None, *self.rows_by_rule)]
        suite += [ck.MissingCountZero(c) for c in self.keys]
        suite += [ck.InvalidCountZero(y, 2011, 2024) for y in (self.year, *self.other_years)]
        suite.append(ck.InvalidCountZero("location_abbr", length=2))
        return suite + list(self.rule_checks)

    def curated_checks(self, df: DataFrame, baseline: DataFrame | None = None) -> list[ck.Check]:
        """Suite for a curated table, with value ranges and categories learned from a baseline batch."""
        # Curation drops empty and footnote columns; a column that is there must hold values.
        wanted = [c for c in (snake_name(f.name) for f in self.raw) if c in df.columns]
        suite: list[ck.Check] = []
        for c in wanted:
            suite += [ck.ColumnExists(c), ck.ValuesNotNull(c)]
        suite.append(ck.RowCountBetween(None, *self.rows_curated))
        if baseline is not None:
            suite += ck.learn_ranges(baseline, self.learned)
            suite += [c for c in ck.learn_categories(baseline, self.categories) if c.applies_to(df)]
        suite += [ck.ValuesUnique(c) for c in self.unique]
        return suite + [ck.ColumnCount(None, len(df.columns))]


# Bounds, keys and rules of each dataset.
CHRONIC = Dataset(
    name="chronic",
    raw=RAW_CHRONIC,
    year="year_start",
    rows_expected=(50_000, 200_000),
    rows_by_rule=(50_000, 500_000),
    rows_curated=(300_000, 310_000),
    metric_max=None,
    has_limits=True,
    keys=("location_abbr", "year_start", "topic_id", "data_value", "question"),
    other_years=("year_end",),
    learned=("data_value", "low_confidence_limit", "high_confidence_limit"),
    categories=("topic",),
    unique=("question_id", "response_id"),
    rule_checks=(
        ck.InvalidCountZero("data_value", 0),
        ck.NoFailedRows("confidence_interval_logic", f"{OUTSIDE_INTERVAL} AND {INTERVAL_KNOWN}"),
    ),
)
HEART = Dataset(
    name="heart",
    raw=RAW_HEART,
    year="year",
    rows_expected=(50_000, 200_000),
    rows_by_rule=(50_000, 200_000),
    rows_curated=(75_000, 80_000),
    metric_max=None,
    has_limits=False,
    keys=("data_value", "topic_id", "location_abbr", "year"),
    learned=("data_value",),
    categories=("class", "topic"),
    unique=("topic_id", "location_id"),
    rule_checks=(ck.InvalidCountZero("data_value", 0),),
)
NUTRI = Dataset(
    name="nutri",
    raw=RAW_NUTRI,
    year="year_start",
    rows_expected=(50_000, 200_000),
    rows_by_rule=(50_000, 200_000),
    rows_curated=(100_000, 110_000),
    metric_max=86,
    has_limits=True,
    keys=("data_value", "location_abbr", "year_start", "class"),
    learned=("data_value", "low_confidence_limit", "high_confidence_limit", "sample_size", "total"),
    categories=("class", "topic"),
    unique=("question_id", "topic_id", "location_id"),
    rule_checks=(
        ck.InvalidCountZero("data_value", 0, 100),
        ck.InvalidCountZero("sample_size", 0),
        ck.NoFailedRows("confidence_interval_logic", OUTSIDE_INTERVAL),
    ),
)
DATASETS = {d.name: d for d in (CHRONIC, HEART, NUTRI)}
