"""Checking SQL by query name."""

from oracle import faults, loading, marts, quality, reports

SQL = {**marts.SQL, **reports.SQL, **quality.SQL, **loading.SQL, **faults.SQL}
