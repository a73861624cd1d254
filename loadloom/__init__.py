"""Hourly multi-series demand analytics as plain Spark DataFrame functions.

Every public function takes and returns ``DataFrame`` or ``Column`` objects. Rows are
keyed by ``series_id`` and a UTC hour ``ts``; all work is lazy unless the docstring says
the function runs an action.
"""

KEYS = ("series_id",)
TS = "ts"
DEFAULT_TZ = "Europe/Warsaw"
