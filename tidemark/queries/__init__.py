"""Registered queries; importing this package registers all of them."""

from tidemark.queries import (  # noqa: F401
    aggregates,
    columns,
    datetimes,
    joins,
    nested,
    numbers,
    ordering,
    scans,
    sensors,
    sinks,
    shop,
    sketches,
    stocks,
    streams,
    text,
    udfs,
    versions,
    windows,
)
from tidemark.queries.registry import ORACLES, QUERIES  # noqa: F401
