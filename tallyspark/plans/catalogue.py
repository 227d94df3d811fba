"""Every query of the library with its SQL twin, by name."""

from __future__ import annotations

from tallyspark.plans import canonical, checks, datasets, fields, lookups, measure, parts, promises, reconcile, records, relational, release, releases, reports, rollups, sequence, spatial, streams, text  # noqa: F401
from tallyspark.plans.registry import QUERIES, SQL  # noqa: F401
