"""One month from its source file to a verified release."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.identity import policy
from tripmill.operators import bronze, checks, gold, silver
from tripmill.plans import release, steps
from tripmill.plans.manifest import BRONZE, FAILED, Manifest
from tripmill.sources.files import SourceFile, checksums
from tripmill.sources.schema import BRONZE_TRIPS, BRONZE_ZONES, DAYS, DIM_DATE, DIM_OPERATOR, DIM_ZONE, EVOLVED, FACT, FEE, HOURLY, METRICS, OPERATORS, QUARANTINE, SILVER_TRIPS, ConflictError, ContractError, check_month
from tripmill.sources.store import SnapshotTable
from tripmill.sources.trips import read_month, read_zones


@dataclass(frozen=True)
class MonthRequest:
    year: int
    month: int

    def __post_init__(self) -> None:
        check_month(self.year, self.month)


def backfill_requests(year: int, first_month: int) -> tuple[MonthRequest, ...]:
    """Four months in order, within one year."""
    first = MonthRequest(year, first_month)
    if first.month > 9:
        raise ContractError("a backfill of four months must start no later than September")
    return tuple(MonthRequest(year, first.month + i) for i in range(4))


class Lake:
    """The tables under one root, created where they are missing."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.bronze, self.zones, self.silver, self.quarantine, self.fact = (SnapshotTable(spark, self.root, s).create() for s in (BRONZE_TRIPS, BRONZE_ZONES, SILVER_TRIPS, QUARANTINE, FACT))
        self.days, self.operators, *gold_tables = (SnapshotTable(spark, self.root, s).create() for s in (DAYS, OPERATORS, DIM_DATE, DIM_OPERATOR, DIM_ZONE, HOURLY, METRICS))
        self.gold = {t.spec.name: t for t in gold_tables}
        self.manifest = Manifest(spark, self.root)

    def evolve(self) -> None:
        """Add the nullable fee column to the three tables that have it from its first year on."""
        for spec in EVOLVED:
            SnapshotTable(self.spark, self.root, spec).add_column(*FEE)

    def ensure_zones(self, uri: str) -> None:
        """Load the zone lookup once; a different one is an error."""
        checksum = checksums(self.spark, [uri])[uri][0]
        known = [r[0] for r in self.zones.read().select("_source_checksum").distinct().limit(2).collect()]
        if known:
            if known != [checksum]:
                raise ContractError("the zone lookup has changed")
            return
        zones = read_zones(self.spark, uri)
        profile = bronze.profile_zones(zones).first()
        if not profile.row_count or profile.null_ids or profile.distinct_ids != profile.row_count:
            raise ContractError("the zone lookup needs unique, non-null LocationIDs")
        self.zones.replace(zones.withColumns({"_source_uri": F.lit(uri), "_source_checksum": F.lit(checksum), "_ingested_at": F.current_timestamp()}))

    # the steps

    def ingest(self, source: SourceFile, zones_uri: str) -> str | None:
        """Bronze; returns the snapshot, or none if the month is published already."""
        source.validate()
        if not self.manifest.guard(source):
            return None
        source.verify(self.spark)
        try:
            self.ensure_zones(zones_uri)
            trips = read_month(self.spark, source.uri, source.year)
            rows = bronze.with_source(bronze.with_identity(trips, source.year), source)
            written: list[int] = []

            def check(n: int) -> None:
                written.append(n)
                if not n:
                    raise ContractError("the source has no trips")

            snapshot = self.bronze.replace(rows, check=check, **release.of_month(source, "_source_"))
        except Exception as error:
            self.manifest.record(source, FAILED, stage="bronze", message=str(error))
            raise
        self.manifest.record(source, BRONZE, bronze_count=written[0], bronze_snapshot=snapshot)
        return snapshot

    def refine(self, source: SourceFile) -> tuple[str, str] | None:
        """Silver and quarantine; returns their snapshots, or none if they are published already."""
        if not self.manifest.admit_silver(source):
            return None
        again = None
        try:
            rows = self.bronze.read(places=True, **release.of_month(source, "_source_")).where(F.col("_ingestion_run_id") == source.run_id)
            if not silver.other_policy(rows, policy(source.year)).isEmpty():
                raise ContractError("bronze rows have another identity policy")
            # few narrow rows are kept; what both tables need of a trip follows from its own row and those
            again = silver.repeated(rows).persist(StorageLevel.MEMORY_AND_DISK)
            few = again.count() <= silver.BROADCAST_COPIES
            classified = silver.classify_numbered(silver.renumbered(rows, F.broadcast(again) if few else again), self.zones.read())
            seen = Observation()
            watched = classified.observe(seen, *silver.count_columns())  # counted as silver is written
            counts: dict[str, int] = {}

            def check_silver(n: int) -> None:
                counts.update(seen.get)
                if n != counts["silver_count"] or counts["bronze_count"] != n + counts["quarantine_count"]:
                    raise ContractError(f"bronze is not silver and quarantine: {n} written, {counts}")

            def check_quarantine(n: int) -> None:
                if n != counts["quarantine_count"]:
                    raise ContractError(f"{n} rows in quarantine instead of {counts['quarantine_count']}")

            snapshots = (
                self.silver.replace(silver.silver(watched), check=check_silver, **release.of_month(source, "source_")),
                self.quarantine.replace(silver.quarantine(classified), check=check_quarantine, **release.of_month(source, "_source_")),
            )
        except Exception as error:
            self.manifest.record_silver_failure(source, error)
            raise
        finally:
            if again is not None:
                again.unpersist()
        self.manifest.record_silver(source, counts["silver_count"], counts["quarantine_count"], *snapshots)
        return snapshots

    def build(self, source: SourceFile) -> DataFrame:
        """Merge the month into the fact table, bring gold up to date and run the data tests; returns their results."""
        month = release.of_month(source, "source_")
        rows = self._model("fct_trips", self.silver.read(**month), lambda df: gold.fct_trips(df, source.year, source.month), self.silver)
        self.fact.merge(rows, "row_id")
        self.refresh()
        return checks.all_checks(self.relations())

    def refresh(self) -> None:
        """Make gold of the months that changed in its sources since it was made, each table in one commit.

        The commit notes the sources' snapshots, so a build that stopped is taken up
        where it was; until then, the old table is what is read. Days and operators
        are kept by month, and their dimensions are made of those few rows.
        """
        self._update(self.days, self.silver, lambda rows: rows.select("pickup_date", *_MONTH).distinct())
        self._update(self.operators, self.silver, lambda rows: rows.select("operator_code", *_MONTH).distinct())
        self._update(self.gold["mart_hourly_zone_demand"], self.fact, gold.mart_hourly_zone_demand)
        self._update(self.gold["mart_operator_metrics"], self.fact, gold.mart_operator_metrics)
        for name, table, model in (("dim_date", self.days, gold.dim_date), ("dim_operator", self.operators, gold.dim_operator), ("dim_zone", self.zones, gold.dim_zone)):
            now = _id(table)
            if now and _noted(self.gold[name]) != now:
                self.gold[name].replace(self._model(name, table.read(), model, table), note={"source": now})

    def _update(self, target: SnapshotTable, source: SnapshotTable, model: Callable[[DataFrame], DataFrame]) -> None:
        now, noted = _id(source), _noted(target)
        if now and noted != now:
            months = source.changed_since(noted)
            target.replace_months(self._model(target.spec.name, source.read(months=months), model, source), months, note={"source": now})

    def _model(self, name: str, rows: DataFrame, model: Callable[[DataFrame], DataFrame], source: SnapshotTable) -> DataFrame:
        """What a model makes of its source; refused if it reads any other relation."""
        made = model(rows)
        tables = {t.spec.name: t.root for t in (self.silver, self.fact, self.zones, self.days, self.operators, self.bronze, self.quarantine)}
        gold.check_graph({name: made}, tables, {name: (source.spec.name,)})
        return made

    def relations(self) -> dict[str, DataFrame]:
        """All relations that the data tests look at, as they are stored."""
        return {"bronze_taxi_zones": self.zones.read(), "silver_trips": self.silver.read(), "fct_trips": self.fact.read()} | {n: t.read() for n, t in self.gold.items()}

    def run(self, source: SourceFile, zones_uri: str, retries: int = steps.RETRIES, pause: float = steps.PAUSE, take_over: bool = False) -> dict:
        """All steps in order, each retried by itself; one run at a time under a root.

        A run that stopped by a mishap goes on at the step that failed; one that was
        refused begins with the first step again.
        """
        refusals = (ContractError, release.ReleaseError)
        with steps.alone(self.spark, self.root, source.run_id, take_over):
            journal = steps.Journal(self.spark, self.root, source.run_id)

            def do(name, step, *args):
                result = journal.step(name, lambda: steps.retried(lambda: step(*args), refusals, retries, pause))
                steps.free_shuffles(self.spark)
                return result

            try:
                do("ingest", self.ingest, source, zones_uri)
                do("refine", self.refine, source)
                do("build", lambda: release.archive_checks(self, source, self.build(source)))
                reconciled = do("reconcile", release.reconcile, self, source)
                published = do("publish", release.publish, self, source, reconciled)
                verified = do("verify", release.verify, self, source, published)
            except refusals as error:
                if not isinstance(error, ConflictError):
                    journal.clear()
                raise
            journal.clear()
            return verified


_MONTH = ("source_year", "source_month")


def _id(table: SnapshotTable) -> str | None:
    latest = table.latest()
    return latest and latest["id"]


def _noted(table: SnapshotTable) -> str | None:
    """The snapshot of its source that a table was made of."""
    latest = table.latest()
    return latest and latest["note"].get("source")
