"""Data tests: 9 of uniqueness, 23 of presence, 4 of references, 1 of counts.

All are taken from one pass over each relation. A row is turned into the keys that
its tests ask for: its own in a domain (``dim_zone.zone_id``), the values that refer
to a domain, a mark for each value it lacks, and itself, to be counted. Keys are
counted by (domain, key), partly before they are shuffled, so all but unique keys are
few rows by then; one shuffle serves all tests. A key is then repeated if
its domain has it twice, and a reference is an orphan if its domain does not have it.
Where only some kinds of tests are asked for, nothing is made that those do not read.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.identity import packed

UNIQUE = {
    "bronze_taxi_zones": ["LocationID"],
    "silver_trips": ["row_id"],
    "dim_operator": ["operator_code"],
    "dim_zone": ["zone_id"],
    "dim_date": ["date_key", "calendar_date"],
    "fct_trips": ["row_id"],
    "mart_hourly_zone_demand": ["hourly_zone_key"],
    "mart_operator_metrics": ["operator_month_key"],
}
NOT_NULL = {
    "bronze_taxi_zones": ["LocationID"],
    "silver_trips": ["row_id", "business_trip_key", "identity_policy_version", "pickup_datetime", "dropoff_datetime"],
    "dim_operator": ["operator_code"],
    "dim_zone": ["zone_id"],
    "dim_date": ["date_key", "calendar_date"],
    "fct_trips": ["row_id", "business_trip_key", "identity_policy_version", "operator_code", "pickup_date_key", "pickup_zone_id", "dropoff_zone_id", "passenger_fare", "driver_pay"],
    "mart_hourly_zone_demand": ["hourly_zone_key", "trip_count"],
    "mart_operator_metrics": ["operator_month_key", "trip_count"],
}
REFERENCES = [
    ("fct_trips", "operator_code", "dim_operator", "operator_code"),
    ("fct_trips", "pickup_date_key", "dim_date", "date_key"),
    ("fct_trips", "pickup_zone_id", "dim_zone", "zone_id"),
    ("fct_trips", "dropoff_zone_id", "dim_zone", "zone_id"),
]
COUNTS = "fct_trips_reconciles_to_silver"
#: The relations that the test of counts compares.
COMPARED = ("silver_trips", "fct_trips")


KINDS = ("unique", "not_null", "relationships", "singular")


def tests() -> list[tuple[str, str, str]]:
    """kind, relation and column_name of all tests."""
    found = [("unique", r, c) for r, columns in UNIQUE.items() for c in columns]
    found += [("not_null", r, c) for r, columns in NOT_NULL.items() for c in columns]
    found += [("relationships", r, c) for r, c, _, _ in REFERENCES]
    return [*found, ("singular", "fct_trips", COUNTS)]


#: What a key is to its domain: one of its own, a mark of a missing value or a row, and from here on a reference.
OWN, MARK, REFERENCE = 0, 1, 2


def _reference(relation: str, column: str) -> tuple[str, int]:
    """The domain that a column refers to, and the number of this reference there."""
    domain = next(f"{p}.{k}" for r, c, p, k in REFERENCES if (r, c) == (relation, column))
    same = [(r, c) for r, c, p, k in REFERENCES if f"{p}.{k}" == domain]
    return domain, REFERENCE + same.index((relation, column))


#: Domains of few keys, which rows of other relations refer to.
REFERRED = {f"{p}.{k}" for _, _, p, k in REFERENCES}
#: Numbers of parts that a domain has at most.
PARTS = max(_reference(r, c)[1] for r, c, _, _ in REFERENCES) + 1


def _names(relation: str, kinds: Collection[str] = KINDS) -> list[tuple[str, int, str | None]]:
    """(domain, part, column): what a row of a relation has to say to tests of some kinds; for no column, that it is there."""
    names = [(f"{relation}.{c}", OWN, c) for c in UNIQUE[relation] if "unique" in kinds or ("relationships" in kinds and f"{relation}.{c}" in REFERRED)]
    if "relationships" in kinds:
        names += [(*_reference(r, c), c) for r, c, _, _ in REFERENCES if r == relation]
    if "not_null" in kinds:
        names += [(f"{relation}.{c}", MARK, c) for c in NOT_NULL[relation]]
    return names + ([(f"rows.{relation}", MARK, None)] if "singular" in kinds and relation in COMPARED else [])


#: Domains are numbered, as a number is the smaller part of a key.
DOMAINS = sorted({d for r in UNIQUE for d, *_ in _names(r)})


def keys(df: DataFrame, relation: str, kinds: Collection[str] = KINDS) -> DataFrame:
    """domain, part, key, text: what the rows of a relation have to say to tests of some kinds, in one pass over it.

    A text of hexadecimal digits, as hashes are, is a key of half its bytes in domains
    that nothing refers to; any other stays a text. Neither can be mistaken for another key.
    """

    def item(domain: str, part: int, column: str | None) -> Column:
        text = F.lit("") if part == MARK else F.col(column).cast("string")
        key, text = packed(text) if part == OWN and domain not in REFERRED else (F.lit(None).cast("binary"), text)
        made = F.struct(F.lit(DOMAINS.index(domain)).alias("domain"), F.lit(part).alias("part"), key.alias("key"), text.alias("text"))
        return made if column is None else F.when(F.col(column).isNull() if part == MARK else F.col(column).isNotNull(), made)

    items = [item(*x) for x in _names(relation, kinds)]
    return df.select(F.explode(F.array(*items)).alias("x")).where("x is not null").select("x.*")


def all_checks(relations: dict[str, DataFrame], kinds: Collection[str] = KINDS) -> DataFrame:
    """The 37 tests, or those of some kinds: kind, relation, column_name, failures (bigint)."""
    said = reduce(DataFrame.unionByName, [keys(relations[r], r, kinds) for r in UNIQUE if _names(r, kinds)])
    parts = {p for r in UNIQUE for _, p, _ in _names(r, kinds)}
    by_key = said.groupBy("domain", "key", "text").agg(*(F.count_if(F.col("part") == p).alias(f"n{p}") for p in sorted(parts)))
    made = {OWN: F.count_if(F.col(f"n{OWN}") > 1), MARK: F.sum(f"n{MARK}")}
    made |= {p: F.sum(F.when(F.col(f"n{OWN}") == 0, F.col(f"n{p}")).otherwise(0)) for p in range(REFERENCE, PARTS)}  # orphans
    by_domain = by_key.groupBy("domain").agg(*((made[p] if p in parts else F.lit(0)).cast("bigint").alias(f"n{p}") for p in range(PARTS)))
    counts = F.struct(*(f"n{p}" for p in range(PARTS)))
    found = by_domain.agg(F.map_from_entries(F.collect_list(F.struct("domain", counts))).alias("of"))  # a row for each domain

    def count(domain: str, part: int) -> Column:
        return F.coalesce(F.col("of")[DOMAINS.index(domain)][f"n{part}"], F.lit(0))

    def failures(kind: str, relation: str, column: str) -> Column:
        if kind == "singular":
            return F.when(count(f"rows.{COMPARED[0]}", MARK) != count(f"rows.{COMPARED[1]}", MARK), 1).otherwise(0)
        if kind == "relationships":
            return count(*_reference(relation, column))
        return count(f"{relation}.{column}", OWN if kind == "unique" else MARK)

    rows = [F.struct(F.lit(k).alias("kind"), F.lit(r).alias("relation"), F.lit(c).alias("column_name"), failures(k, r, c).cast("bigint").alias("failures")) for k, r, c in tests() if k in kinds]
    return found.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def same_count(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """silver_count, fact_count, if they differ."""
    a, b = silver.agg(F.count(F.lit(1)).alias("silver_count")), fact.agg(F.count(F.lit(1)).alias("fact_count"))
    return a.crossJoin(b).where("silver_count <> fact_count")  # of two single rows
