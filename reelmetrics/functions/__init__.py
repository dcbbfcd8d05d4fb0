from .columns import (
    age_bucket,
    as_of_date,
    churn_bucket,
    clip_percent,
    days_between,
    exact_mean,
    free_names,
    month_key,
    percent_of,
    require_exact,
)

__all__ = [
    "age_bucket",
    "as_of_date",
    "churn_bucket",
    "clip_percent",
    "days_between",
    "exact_mean",
    "free_names",
    "month_key",
    "percent_of",
    "require_exact",
]
