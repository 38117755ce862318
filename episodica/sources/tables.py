"""CSV readers, cleaning of the three source tables, and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.functions import columns as C
from episodica.operators.episodes import keep_persons_with_felony

# Header names of the source files and the names used here.
COMPONENT_COLUMNS = {
    "OFFENDER_NC_DOC_ID_NUMBER": "person_id",
    "COMMITMENT_PREFIX": "episode_id",
    "SENTENCE_COMPONENT_NUMBER": "component_no",
    "PRIMARY_FELONY/MISDEMEANOR_CD.": "severity",
    "SENTENCE_EFFECTIVE(BEGIN)_DATE": "begin_date",
    "COUNTY_OF_CONVICTION_CODE": "county_code",
    "PUNISHMENT_TYPE_CODE": "punishment_code",
    "COMPONENT_DISPOSITION_CODE": "disposition_code",
    "PRIMARY_OFFENSE_CODE": "offense_code",
    "COURT_TYPE_CODE": "court_code",
    "SENTENCING_PENALTY_CLASS_CODE": "penalty_code",
}
STAY_COLUMNS = {
    "INMATE_DOC_NUMBER": "person_id",
    "INMATE_COMMITMENT_PREFIX": "episode_id",
    "INMATE_SENTENCE_COMPONENT": "component_no",
    "ACTUAL_SENTENCE_END_DATE": "actual_end",
    "PROJECTED_RELEASE_DATE_(PRD)": "projected_end",
    "SENTENCE_BEGIN_DATE_(FOR_MAX)": "stay_begin",
}
PERSON_COLUMNS = {
    "OFFENDER_NC_DOC_ID_NUMBER": "person_id",
    "OFFENDER_BIRTH_DATE": "birth_date",
    "OFFENDER_GENDER_CODE": "gender",
    "OFFENDER_RACE_CODE": "race",
    "OFFENDER_SKIN_COMPLEXION_CODE": "skin_complexion",
    "OFFENDER_HAIR_COLOR_CODE": "hair_color",
    "OFFENDER_EYE_COLOR_CODE": "eye_color",
    "OFFENDER_BODY_BUILD_CODE": "body_build",
    "CITY_WHERE_OFFENDER_BORN": "birth_city",
    "NC_COUNTY_WHERE_OFFENDER_BORN": "birth_county",
    "STATE_WHERE_OFFENDER_BORN": "birth_state",
    "COUNTRY_WHERE_OFFENDER_BORN": "birth_country",
    "OFFENDER_CITIZENSHIP_CODE": "citizenship",
    "OFFENDER_ETHNIC_CODE": "ethnic",
    "OFFENDER_PRIMARY_LANGUAGE_CODE": "language",
    "OFFENDER_HEIGHT_(IN_INCHES)": "height",
    "OFFENDER_WEIGHT_(IN_LBS)": "weight",
}
# Codes counted per episode, and codes of a person used as categories.
COUNT_CODES = (
    "county_code", "punishment_code", "disposition_code",
    "offense_code", "court_code", "penalty_code",
)
PERSON_CODES = (
    "gender", "race", "skin_complexion", "hair_color", "eye_color", "body_build",
    "birth_city", "birth_county", "birth_state", "birth_country",
    "citizenship", "ethnic", "language",
)


def read_text_csv(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """Read the listed columns of a CSV file with header as text, under their short names.

    The header line gives the file's column order; no data is scanned for types.
    """
    header = spark.read.csv(path, header=True, inferSchema=False).columns
    missing = [name for name in columns if name not in header]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    raw = spark.read.schema(schema).csv(path, header=True)
    return raw.select([F.col(f"`{src}`").alias(dst) for src, dst in columns.items()])


def read_if_present(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """Read a CSV file with header, or return None when the path does not exist."""
    try:
        return spark.read.csv(path, header=True, **options)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_headerless(spark: SparkSession, path: str, names: Sequence[str], types: Sequence[str]) -> DataFrame:
    """Read a CSV file without header; columns are named by position."""
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, types))
    return spark.read.csv(path, header=False, schema=schema)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns, failing when one of them is absent."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"cannot drop missing columns: {missing}")
    return df.drop(*names)


def select_by_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Keep the given columns and those whose name starts with the prefix."""
    return df.select(*keep, *[c for c in df.columns if c.startswith(prefix) and c not in keep])


def clean_components(
    raw: DataFrame,
    felony: str = "FELON",
    id_recode: Mapping[str, str] | None = None,
    date_formats: tuple[str, ...] = ("yyyy-MM-dd",),
    strict_dates: bool = False,
) -> DataFrame:
    """Typed component rows of every person with at least one felony component.

    An unreadable begin date becomes null, or fails the job where ``strict_dates`` is set.
    """
    begin = F.col("begin_date")
    if strict_dates:
        if len(date_formats) != 1:
            raise ValueError("strict dates have one format")
        parsed = C.parse_date_strict(begin, date_formats[0])
    else:
        parsed = C.parse_date_lenient(begin, date_formats)
    typed = raw.withColumns(
        {
            "person_id": C.person_key(F.col("person_id"), dict(id_recode or {})),
            "component_no": F.col("component_no").cast("int"),
            "begin_date": parsed,
            "is_felony": C.flag_equal(F.col("severity"), felony),
        }
    )
    return keep_persons_with_felony(typed)


def clean_stays(
    raw: DataFrame,
    id_recode: Mapping[str, str] | None = None,
    date_formats: tuple[str, ...] = ("yyyy-MM-dd",),
) -> DataFrame:
    """Typed stay rows with the release date, imputed from the projection where needed."""
    dates = {
        c: C.parse_date_lenient(F.col(c), date_formats)
        for c in ("actual_end", "projected_end", "stay_begin")
        if c in raw.columns
    }
    typed = raw.withColumns(
        {
            "person_id": C.person_key(F.col("person_id"), dict(id_recode or {})),
            "component_no": F.col("component_no").cast("int"),
            **dates,
        }
    )
    return add_release_date(typed)


def add_release_date(stays: DataFrame) -> DataFrame:
    """Add the release date and the flag that marks imputed ones."""
    ends = F.col("actual_end"), F.col("projected_end")
    return stays.withColumns(
        {"release_date": C.release_date(*ends), "release_imputed": C.release_imputed(*ends)}
    )


def clean_persons(
    raw: DataFrame, id_recode: Mapping[str, str] | None = None, date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    """Typed person rows; unreadable numbers and birth dates fail the job."""
    return raw.withColumns(
        {
            "person_id": C.person_key(F.col("person_id"), dict(id_recode or {})),
            "birth_date": C.parse_date_strict(F.col("birth_date"), date_format),
            "height": F.col("height").cast("double"),
            "weight": F.col("weight").cast("double"),
        }
    )


def read_components(spark: SparkSession, path: str, **rules) -> DataFrame:
    """Read and clean the component file."""
    return clean_components(read_text_csv(spark, path, COMPONENT_COLUMNS), **rules)


def read_stays(spark: SparkSession, path: str, **rules) -> DataFrame:
    """Read and clean the stay file."""
    return clean_stays(read_text_csv(spark, path, STAY_COLUMNS), **rules)


def read_persons(spark: SparkSession, path: str, **rules) -> DataFrame:
    """Read and clean the person file."""
    return clean_persons(read_text_csv(spark, path, PERSON_COLUMNS), **rules)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Write a result table; CSV files get a header."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
