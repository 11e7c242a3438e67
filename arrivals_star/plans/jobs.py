"""The two batch jobs: staging (T1-T5, T13) and the star schema."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import group_mean
from ..operators.clean import clean, dedupe_by_key, drop_empty_rows, drop_sparse_columns, require_columns
from ..operators.dims import (DEMOGRAPHICS_NAMES, PORT_NAMES, calendar_dim, city_demographics_dim, port_dim,
                              temperature_dim, transport_mode_dim, visa_dim, write_calendar)
from ..operators.fact import ARRIVALS_REQUIRED, arrivals_fact, arrivals_fact_with_rejects
from ..operators.profile import footer_profile
from ..sources import read_csv, read_quoted_csv, read_small_csv, read_table
from ..sources.replace import current_path
from ..sources.sinks import write_csv, write_parquet

# ---------------------------------------------------------------------------------------------
# Staging keys and the table folder names of the two jobs.
TEMPERATURE_KEYS = ("dt", "City", "Country")
TEMPERATURE_GROUP = ("City", "Country")
DEMOGRAPHICS_KEYS = ("City", "State", "State Code", "Race")
STAGED = {"arrivals": "sas_data", "temperatures": "global_temperatures",
          "demographics": "us-cities-demographics", "ports": "i94_ports", "countries": "i94_countries"}
FINAL = {"fact": "immigration_fact", "calendar": "time_dim", "visa": "visa_dim",
         "mode": "transport_mode_dim", "temperature": "temperature_dim",
         "demographics": "us_city_demographics_dim", "port": "port_dim"}
# The declared columns of the final tables. The fact and the ports may carry more columns from the
# raw tables, and the demographics have one bigint column per race.
FINAL_SCHEMAS = {
    "fact": "id bigint, birth_country_id int, residence_country_id int, port_id string, arrival_date date, "
            "transport_mode_id smallint, arrival_state string, depart_date date, age_in_yrs int, visa smallint, "
            "count int, birth_year int, gender string, airline string, visatype string, stay_days int",
    "calendar": "date date, day int, week int, month int, year int, weekday int, id bigint",
    "visa": "visa_cat_id smallint, visatype string, visa_cat string",
    "mode": "id smallint, mode string",
    "temperature": "city string, country_id string, country string, avg_temperature double",
    "demographics": "city string, state string, state_code string, median_age float, male_population bigint, "
                    "female_population bigint, total_population bigint, number_of_veterans bigint, "
                    "foreign_born bigint, average_household_size float",
    "port": "port_id string, city string, state string"}
OPEN_SCHEMAS = ("fact", "demographics", "port")
# ---------------------------------------------------------------------------------------------


def stage_arrivals(raw: DataFrame, threshold: float = 90.0, dedupe: bool = True,
                   order: Sequence[str] = (), protected: Sequence[str] = ARRIVALS_REQUIRED,
                   profile: DataFrame | None = None) -> DataFrame:
    """Staged arrivals (T1): sparse columns and empty rows dropped, one row per ``cicid``.

    Columns the fact needs are protected from the sparse drop, as the fact's cast would fail on
    them. Rows without an id are different arrivals and all stay: one scan and one aggregate
    serve them and the rows with an id. ``dedupe=False`` keeps duplicate ids as well. A ``profile``
    of the unprotected columns that is there already (``footer_profile``) saves the profile's scan.
    """
    df = drop_empty_rows(drop_sparse_columns(raw, threshold, protected, profile))
    return dedupe_by_key(df, ["cicid"], order, keep_null_keys=True) if dedupe else df


def stage_temperatures(raw: DataFrame, threshold: float = 90.0,
                       protected: Sequence[str] = (*TEMPERATURE_KEYS, "AverageTemperature")) -> DataFrame:
    """Staged temperatures (T2): mean temperature per (City, Country), after dropping rows with no
    temperature and keeping one row per (dt, City, Country).

    Two shuffles, both with map-side reduction: the dedupe keys include the day, so a city with a
    third of all rows still spreads over many reducers, and the grouped mean then moves one
    partial row per city and task.
    """
    df = drop_empty_rows(drop_sparse_columns(raw, threshold, protected))
    df = dedupe_by_key(require_columns(df, ["AverageTemperature"]), TEMPERATURE_KEYS)
    return group_mean(df, TEMPERATURE_GROUP, "AverageTemperature", "average_temperature")


def stage_demographics(raw: DataFrame, threshold: float = 90.0,
                       protected: Sequence[str] = tuple(DEMOGRAPHICS_NAMES)) -> DataFrame:
    """Staged city demographics (T3): the small-table cleaner keyed by city, state and race.

    The columns of the final table are protected from the sparse drop, here and for the other
    small tables, so the final schema does not depend on how full they are.
    """
    return clean(raw, threshold, keys=DEMOGRAPHICS_KEYS, protected=protected)


def stage_ports(raw: DataFrame, threshold: float = 90.0, protected: Sequence[str] = tuple(PORT_NAMES)) -> DataFrame:
    """Staged ports (T4): the small-table cleaner without keys."""
    return clean(raw, threshold, protected=protected)


def stage_countries(raw: DataFrame, threshold: float = 90.0,
                    protected: Sequence[str] = ("Code", "Country")) -> DataFrame:
    """Staged countries (T5): the small-table cleaner without keys."""
    return clean(raw, threshold, protected=protected)


@dataclass(frozen=True)
class RawInputs:
    """Where the raw inputs are. ``arrivals_format`` is any installed reader's format name, or
    ``sas_transport``.

    ``temperatures_quotes`` says how a quote inside a quoted temperature field is written:
    ``backslash`` (Spark's default, as the reference reads the file; a line is a record) or
    ``doubled`` (as most writers do; quoted fields may then hold line breaks, and a large file is
    still read by many tasks).
    """
    arrivals: str
    temperatures: str
    demographics: str
    ports: str
    countries: str
    arrivals_format: str = "parquet"
    temperatures_quotes: str = "backslash"


def _join(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def check_schema(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself if it has the declared columns and types of a final table; else an error.

    Only the tables in ``OPEN_SCHEMAS`` may have other columns besides.
    """
    declared = dict(c.rsplit(" ", 1) for c in FINAL_SCHEMAS[name].split(", "))
    actual = dict(df.dtypes)
    wrong = {c: (t, actual.get(c)) for c, t in declared.items() if actual.get(c) != t}
    more = [] if name in OPEN_SCHEMAS else [c for c in actual if c not in declared]
    if wrong or more:
        raise ValueError(f"{name}: columns (declared, found) {wrong}, columns not declared {more}")
    return df


def together(spark: SparkSession, jobs: dict[str, Callable[[], None]], at_once: int) -> None:
    """Run independent table builds, ``at_once`` at a time: small tables are written while a large one's
    last tasks run. The first error is raised when all have ended."""
    with ThreadPoolExecutor(max(at_once, 1)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs.values()]
    for r in running:
        r.result()


def run_stage(spark: SparkSession, raw: RawInputs, stage_dir: str, threshold: float = 90.0,
              row_counts: dict[str, int] | None = None, at_once: int = 5) -> dict[str, str]:
    """Staging job (T13): build and write the five staged tables, ``at_once`` at a time; returns their paths.

    Each table's row count after cleaning (C3) is recorded by an ``Observation`` during its write,
    without another scan; pass a dict as ``row_counts`` to receive them. The sparse columns of
    Parquet arrivals are told from the files' footers where those know (see ``footer_profile``).
    """
    out = {k: _join(stage_dir, v) for k, v in STAGED.items()}
    if raw.temperatures_quotes not in ("backslash", "doubled"):
        raise ValueError(f"temperatures_quotes is 'backslash' or 'doubled', not {raw.temperatures_quotes!r}")
    profile = None
    if raw.arrivals_format == "parquet":
        needed, path = {c.lower() for c in ARRIVALS_REQUIRED}, current_path(spark, raw.arrivals)
        names = read_table(spark, path).columns
        # before the tables are built, as it changes session settings for a moment
        profile = footer_profile(spark, path, [c for c in names if c.lower() not in needed])

    def temperatures() -> DataFrame:
        if raw.temperatures_quotes == "doubled":
            return read_quoted_csv(spark, raw.temperatures)
        return read_csv(spark, raw.temperatures, escape="\\")

    tables = {
        "arrivals": (lambda: stage_arrivals(read_table(spark, raw.arrivals, raw.arrivals_format), threshold, profile=profile),
                     write_parquet),
        "temperatures": (lambda: stage_temperatures(temperatures(), threshold), write_csv),
        "demographics": (lambda: stage_demographics(read_small_csv(spark, raw.demographics, sep=";"), threshold), write_csv),
        "ports": (lambda: stage_ports(read_small_csv(spark, raw.ports), threshold), write_csv),
        "countries": (lambda: stage_countries(read_small_csv(spark, raw.countries), threshold), write_csv),
    }
    counts: dict[str, int] = {}

    def stage(name: str) -> None:
        build, write = tables[name]
        observed, obs = _observed(build(), f"stage_{name}")
        write(observed, out[name])
        counts[name] = obs.get["rows"]

    together(spark, {name: lambda name=name: stage(name) for name in tables}, at_once)
    if row_counts is not None:
        row_counts.update({name: counts[name] for name in tables})
    return out


def run_final(spark: SparkSession, stage_dir: str, final_dir: str,
              races: Sequence[str] | None = None, keep_rejects: bool = False,
              reject_counts: dict[str, int] | None = None, at_once: int = 6) -> dict[str, str]:
    """Star-schema job (T14): the fact, then six dimensions, ``at_once`` at a time; returns their paths.

    The fact plan runs once: the dimensions read the written fact back, which both cuts the
    lineage (a lost executor re-reads files instead of redoing the dedupe) and lets each
    dimension read only the columns it needs. Every table is checked against its declared schema
    before it is written, and replaces the one before it only when it is complete.

    With ``keep_rejects`` the fact has a last column ``rejects``, the values that its casts lost
    (``rejected_values`` lists them); ``reject_counts`` receives their number per column, counted
    while the fact is written.
    """
    staged = {k: _join(stage_dir, v) for k, v in STAGED.items()}
    out = {k: _join(final_dir, v) for k, v in FINAL.items()}
    # the staged files are in the dialect of write_csv, and values may hold line breaks
    small = {k: read_csv(spark, staged[k], multi_line=True) for k in ("demographics", "ports", "countries")}
    arrivals = read_table(spark, staged["arrivals"])
    if keep_rejects:
        lost = Observation("lost_values")
        write_parquet(check_schema(arrivals_fact_with_rejects(arrivals, observation=lost), "fact"), out["fact"])
        if reject_counts is not None:
            reject_counts.update(lost.get)
    else:
        write_parquet(check_schema(arrivals_fact(arrivals), "fact"), out["fact"])
    fact = read_table(spark, out["fact"])
    together(spark, {
        "calendar": lambda: write_calendar(check_schema(calendar_dim(fact), "calendar"), out["calendar"]),
        "visa": lambda: write_parquet(check_schema(visa_dim(fact), "visa"), out["visa"]),
        "mode": lambda: write_parquet(check_schema(transport_mode_dim(fact), "mode"), out["mode"]),
        "temperature": lambda: write_parquet(check_schema(temperature_dim(
            read_quoted_csv(spark, staged["temperatures"]), small["countries"]), "temperature"),
            out["temperature"]),
        "demographics": lambda: write_parquet(check_schema(city_demographics_dim(
            small["demographics"], races), "demographics"), out["demographics"]),
        "port": lambda: write_parquet(check_schema(port_dim(small["ports"]), "port"), out["port"]),
    }, at_once)
    return out


__all__ = ["TEMPERATURE_KEYS", "DEMOGRAPHICS_KEYS", "STAGED", "FINAL", "FINAL_SCHEMAS",
           "check_schema", "stage_arrivals",
           "stage_temperatures", "stage_demographics", "stage_ports", "stage_countries", "RawInputs",
           "run_stage", "run_final", "together"]
