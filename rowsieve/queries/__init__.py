"""The registered queries, one or more for each operator."""

from rowsieve.queries import evolve, jobs, rules, shape

QUERIES = {**rules.QUERIES, **shape.QUERIES, **jobs.QUERIES, **evolve.QUERIES}
ORACLES = {**rules.ORACLES, **shape.ORACLES, **jobs.ORACLES, **evolve.ORACLES}
