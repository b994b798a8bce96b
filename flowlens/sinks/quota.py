"""The day's quota of an external service, reserved before it is spent.

Counting the calls already stored (E1) does not see those that another job is about to make.  Here a run
reserves its calls first: a manifest for each day names the runs and how many calls each holds, and it is replaced in one step, so of
two overlapping runs the later one gets what the first has left.  A run that asks again (a rerun after a failure)
keeps what it holds.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from flowlens.functions.time import parse_stamp
from flowlens.sinks.manifests import Manifests


class QuotaBook:
    """The reservations at ``path``."""

    def __init__(self, spark: SparkSession, path: str, daily_quota: int):
        self.manifests, self.daily_quota = Manifests(spark, path), daily_quota

    @staticmethod
    def _day(today) -> str:
        return f"DAY={parse_stamp(today):%Y-%m-%d}"

    def reserved(self, today) -> dict[str, int]:
        """Calls reserved for the day, by run."""
        return self.manifests.newest(self._day(today))[1].get("reserved", {})

    def reserve(self, today, run: str, calls: int) -> int:
        """The calls that ``run`` may make: ``calls`` or what the day has left, the same again if it holds a reservation."""
        def change(content: dict) -> dict | None:
            held = content.get("reserved", {})
            if run in held:
                return None
            free = max(0, self.daily_quota - sum(held.values()))
            return {"kinds": {}, "reserved": held | {run: min(max(0, calls), free)}}

        self.manifests.update(self._day(today), change)
        return self.reserved(today)[run]
