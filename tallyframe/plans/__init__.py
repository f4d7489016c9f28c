"""The registry: every query with its SQL twin where there is one."""

from tallyframe.plans import detections, files, latency, learning, series, text

_MODULES = (text, series, latency, detections, learning, files)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
