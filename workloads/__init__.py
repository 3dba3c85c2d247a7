"""Every operator at work on the given tables, with the SQL that checks it."""

from workloads import (  # noqa: F401  (they register their queries)
    catalogs,
    copies,
    diffs,
    guards,
    manifests,
    properties,
    states,
    validations,
)
from workloads.base import ORACLES, QUERIES  # noqa: F401
