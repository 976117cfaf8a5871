"""Named queries over the driver's tables, each with its SQL where SQL can say it."""

from catalog import files, jobs, layouts, ordered, profiles, scans

_MODULES = (scans, files, layouts, ordered, profiles, jobs)

QUERIES = {name: run for m in _MODULES for name, run in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
