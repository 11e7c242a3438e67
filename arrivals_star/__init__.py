"""arrivals_star: traveller-arrival records into a star schema, on Spark DataFrames.

Two jobs: ``plans.jobs.run_stage`` (profile and clean five raw inputs) and ``plans.jobs.run_final``
(one fact table and six dimensions). Every step is a ``DataFrame → DataFrame`` function made of
built-in Spark expressions.
"""

from .operators.aggregate import group_mean, stay_report
from .operators.clean import (clean, dedupe_by_key, dedupe_rows, drop_empty_rows,
                              drop_sparse_columns, require_columns)
from .operators.conform import (cast_columns, drop_columns, normalise_names, rename_columns,
                                sas_dates_to_dates, text_to_date_column, with_day_span)
from .operators.dims import (calendar_dim, city_demographics_dim, pivot_sum, port_dim,
                             temperature_dim, temperature_dim_sql, transport_mode_dim, visa_dim)
from .operators.fact import arrivals_fact
from .operators.joins import join_ignore_case
from .operators.profile import missing_profile, sparse_columns
from .plans.jobs import RawInputs, run_final, run_stage

__all__ = ["group_mean", "stay_report", "clean", "dedupe_by_key", "dedupe_rows", "drop_empty_rows",
           "drop_sparse_columns", "require_columns", "cast_columns", "drop_columns",
           "normalise_names", "rename_columns", "sas_dates_to_dates", "text_to_date_column",
           "with_day_span", "calendar_dim", "city_demographics_dim", "pivot_sum", "port_dim",
           "temperature_dim", "temperature_dim_sql", "transport_mode_dim", "visa_dim",
           "arrivals_fact", "join_ignore_case", "missing_profile",
           "sparse_columns", "RawInputs", "run_final", "run_stage"]
