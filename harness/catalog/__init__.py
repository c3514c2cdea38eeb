"""All registered queries, by section of the blueprint."""

from harness.catalog import (  # noqa: F401
    aggregates,
    columns,
    incremental,
    joins,
    merged,
    quality,
    reading,
    star,
)
