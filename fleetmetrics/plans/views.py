"""The job that keeps the fleet views, and what a dashboard reads of them."""

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmetrics.functions.clock import ntz
from fleetmetrics.operators import fleet, views
from fleetmetrics.operators.merge import latest_metrics
from fleetmetrics.schemas import METRICS
from fleetmetrics.sources.commits import Conflict
from fleetmetrics.sources.store import REFRESH_LOG, VIEWS_LOG, Manifest, TelemetryStore

# Days with changed windows up to which they are named in the scan of the log; of
# more, all between the first and the last are read.
NAMED_DAYS = 200


@dataclass(frozen=True)
class PeriodViews:
    """Newest window and totals of each machine with windows in a period."""

    latest: DataFrame
    totals: DataFrame

    def machine_kpis(self) -> DataFrame:
        return views.machine_kpis(self.latest, self.totals)

    def fleet_kpis(self) -> DataFrame:
        return views.fleet_kpis(self.latest, self.totals)

    def machines_in_alert(self) -> DataFrame:
        return self.latest.filter("TemperatureAlert").select("Machine")


def _latest(store: TelemetryStore, kept: Manifest) -> DataFrame:
    ids = [kept.state["latest"]] if "latest" in kept.state else []
    return store.open("latest", ids).select(*views.LATEST.fieldNames())


def _versions(store: TelemetryStore, refreshed: Manifest, changed: DataFrame) -> DataFrame:
    """The metrics log on the days on which windows have changed."""
    day = "window_date"
    days = sorted(r[day] for r in changed.select(day).distinct().limit(NAMED_DAYS + 1).collect())
    if len(days) > NAMED_DAYS:
        days = list(changed.agg(F.min(day), F.max(day)).first())
        wanted = F.col(day).between(F.lit(days[0]), F.lit(days[-1]))
    else:
        wanted = F.col(day).isin(days)
    first, last = days[0].isoformat(), days[-1].isoformat()
    reaching = tuple(b for b in refreshed.batches if b.first_date <= last and b.last_date >= first)
    return store.open("metrics", reaching).filter(wanted)


def keep_views(store: TelemetryStore) -> tuple[Manifest, Manifest]:
    """Bring the views up to the newest refresh, however many there were since.

    Only what these refreshes wrote, and the days of its windows, are read. Returns the
    manifests of metrics and views that belong together. Another keeper at the same
    time makes one of the two start again.
    """
    while True:
        refreshed, kept = store.manifest(REFRESH_LOG), store.manifest(VIEWS_LOG)
        seen = kept.state.get("seen", 0)
        if seen == refreshed.snapshot:
            return refreshed, kept
        new = tuple(b for b in refreshed.batches if b.origin > seen)
        if seen > refreshed.snapshot:
            continue
        state, added, batch_id = {"seen": refreshed.snapshot}, [], None
        if new:
            changed = store.open("metrics", new)
            batch_id = store.claim(VIEWS_LOG, kept)
            store.write("hours", views.changed_hours(_versions(store, refreshed, changed), changed), batch_id)
            store.write("latest", views.advanced_latest(_latest(store, kept), changed), batch_id)
            found, _ = store.describe("hours", batch_id)
            added = [found] if found else []
            state["latest"] = batch_id
        following = kept.extended(*added, used=batch_id, **state)
        try:
            store.commit(VIEWS_LOG, following)
        except Conflict:
            continue
        if store.compact(VIEWS_LOG, manifest=following):
            following = store.manifest(VIEWS_LOG)
            if following.state["seen"] != refreshed.snapshot:
                continue
        return refreshed, following


def period_views(store: TelemetryStore, local_now: datetime, period_minutes: int | None = None) -> PeriodViews:
    """The views of the windows that start within the period, after any refresh that is new.

    Full hours come from their totals; windows are read for the part of an hour at the
    period's start only.
    """
    refreshed, kept = keep_views(store)
    since = local_now - timedelta(minutes=int(period_minutes or fleet.DEFAULT_PERIOD))
    full = views.first_full_hour(since)
    batches = tuple(b for b in kept.batches if b.last_date >= full.date().isoformat())
    hours = store.open("hours", batches).filter(
        (F.col("hour_date") >= F.lit(full.date())) & (F.col("dtHour") >= ntz(full))
    )
    parts = [views.newest_hours(hours)]
    if since < full:
        day = since.date().isoformat()
        reaching = tuple(b for b in refreshed.batches if b.first_date <= day <= b.last_date)
        edge = store.open("metrics", reaching).filter(
            (F.col("window_date") == F.lit(since.date()))
            & (F.col("dtWindowStart") >= ntz(since))
            & (F.col("dtWindowStart") < ntz(full))
        )
        parts.append(views.hour_totals(latest_metrics(edge).select(*METRICS.fieldNames())))
    latest = _latest(store, kept).filter(F.col("WindowStart") >= ntz(since))
    return PeriodViews(latest, views.machine_totals(*parts))
