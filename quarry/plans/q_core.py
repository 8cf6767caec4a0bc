"""Queries of the minimum slice."""

from quarry.plans.flagship import FLAGSHIP_SQL, flagship_score

QUERIES = {
    "flagship_score": flagship_score,
}
ORACLE = {
    "flagship_score": FLAGSHIP_SQL,
}
