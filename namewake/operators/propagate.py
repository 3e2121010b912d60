"""Carry changed dimension names into the plan table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewake.entities import EntitySpec
from namewake.operators.joins import broadcast_limit, fits_broadcast, lookup_join, without_match
from namewake.scratch import Size, measure_all, settle

_KEY, _NAME, _HIT = "__key", "__name", "__hit"


def key_lookup(plan: DataFrame, fk: str, key: int) -> DataFrame:
    """Plan rows of one key; the comparison reaches the scan."""
    return plan.filter(F.col(fk) == key)


def _lookup(latest: DataFrame, key: str, name: str) -> DataFrame:
    return latest.select(F.col(key).alias(_KEY), F.col(name).alias(_NAME))


def matched_rows(
    plan: DataFrame,
    latest: DataFrame,
    spec: EntitySpec,
    columns: Sequence[str] | None = None,
    size: Size | None = None,
) -> DataFrame:
    """Plan rows hit by an update, with the event's name and the plan's own op.

    ``columns`` are further plan columns, by default those the entity keeps.
    """
    keep = spec.keep if columns is None else columns
    wanted = list(dict.fromkeys([spec.plan_id, spec.plan_op, spec.fk, *keep]))
    wanted = [c for c in wanted if c != spec.plan_name]
    hit = lookup_join(
        plan.select(*wanted),
        _lookup(latest, spec.key, spec.name),
        spec.fk,
        _KEY,
        "inner",
        row_id=[spec.plan_id],
        size=size,
    )
    head = [spec.plan_id, spec.plan_op, spec.fk]
    return hit.select(
        *head, F.col(_NAME).alias(spec.plan_name), *(c for c in wanted if c not in head)
    )


def unmatched_updates(
    plan: DataFrame,
    latest: DataFrame,
    fk: str,
    key: str = "key",
    size: Size | None = None,
) -> DataFrame:
    """Updates whose key no plan row carries."""
    return without_match(latest, plan, fk, key, size)


def merge_names(
    plan: DataFrame,
    latest: DataFrame,
    spec: EntitySpec,
    size: Size | None = None,
    base: DataFrame | None = None,
    applies: Column | None = None,
) -> DataFrame:
    """All plan rows, with the name overwritten where an update hits.

    A null name overwrites too, hence the explicit hit flag. ``applies`` narrows
    the hits by a condition on plan columns and further columns of ``latest``.
    """
    extra = [c for c in latest.columns if c not in (spec.key, spec.name)]
    lookup = latest.select(
        F.col(spec.key).alias(_KEY),
        F.col(spec.name).alias(_NAME),
        F.lit(True).alias(_HIT),
        *extra,
    )
    joined = lookup_join(
        plan, lookup, spec.fk, _KEY, "left", row_id=[spec.plan_id], size=size, base=base
    )
    hit = F.col(_HIT) if applies is None else F.col(_HIT) & applies
    old = F.col(spec.plan_name) if spec.plan_name in plan.columns else F.lit(None)
    return joined.withColumn(
        spec.plan_name, F.when(hit, F.col(_NAME)).otherwise(old.cast("string"))
    ).drop(_NAME, _HIT, *extra)


@dataclass(frozen=True)
class Dimension:
    """A lookup table of a star: ``columns`` maps its columns to output names.

    ``dimensions`` are looked up in turn, by foreign keys among its columns.
    """

    rows: DataFrame
    fk: str
    key: str
    columns: dict[str, str]
    dimensions: tuple[Dimension, ...] = ()
    size: Size | None = None

    def with_nested(self) -> list[Dimension]:
        return [self, *(n for d in self.dimensions for n in d.with_nested())]

    def names(self) -> list[str]:
        return [n for d in self.with_nested() for n in d.columns.values()]

    def sized(self, sizes: Iterator[Size]) -> Dimension:
        """The same with sizes, given in the order of ``with_nested``."""
        size = next(sizes)
        return replace(self, size=size, dimensions=tuple(d.sized(sizes) for d in self.dimensions))

    def inner_fk(self, nested: Dimension) -> str:
        return f"__{self.fk}__{nested.fk}"

    def lookup(self) -> DataFrame:
        """Key, named columns and foreign keys, under names of their own."""
        return self.rows.select(
            F.col(self.key).alias(f"__{self.fk}"),
            *(F.col(c).alias(n) for c, n in self.columns.items()),
            *(F.col(d.fk).alias(self.inner_fk(d)) for d in self.dimensions),
        )

    def below(self) -> list[Dimension]:
        """Nested dimensions, with the foreign keys as ``lookup`` names them."""
        return [replace(d, fk=self.inner_fk(d)) for d in self.dimensions]


def star_enrich(
    fact: DataFrame, dimensions: Sequence[Dimension], row_id: Sequence[Column | str]
) -> DataFrame:
    """Add the names of several dimensions at read time.

    Unlike propagation this shows the current name to every row, however late the
    row came. All dimensions are measured together. Those that fit are broadcast,
    nested ones straight onto the fact; one that does not fit gets its nested names
    first and is joined then. Large ones go first, so that columns added by the
    others are not shuffled. ``row_id`` counts only where something does not fit; it
    may name metadata of the fact's files.
    """
    spark = fact.sparkSession
    tables = [d for top in dimensions for d in top.with_nested()]
    measured = measure_all([d.lookup() for d in tables], broadcast_limit(spark))
    sizes = iter(measured)
    dimensions = [d.sized(sizes) for d in dimensions]
    if all(fits_broadcast(spark, size) for size in measured):
        return _enrich(fact, dimensions, row_id)
    told_apart = fact.withColumn("__row", F.xxhash64(*row_id))
    return _enrich(told_apart, dimensions, ["__row"]).drop("__row")


def _enrich(
    fact: DataFrame, dimensions: Sequence[Dimension], row_id: Sequence[Column | str]
) -> DataFrame:
    out, spark = fact, fact.sparkSession
    for d in sorted(dimensions, key=lambda d: d.size.bytes, reverse=True):
        lookup, size, key = d.lookup(), d.size, f"__{d.fk}"
        flat = all(fits_broadcast(spark, n.size) for n in d.with_nested())
        if d.dimensions and not flat:
            lookup = _enrich(lookup, d.below(), [key]).select(key, *d.names())
            if fits_broadcast(spark, size):
                lookup, size = settle(lookup, "dimension")
        out = lookup_join(out, lookup, d.fk, key, row_id=row_id, size=size, base=fact)
        if d.dimensions and flat:
            out = _enrich(out, d.below(), row_id)
    names = [n for d in dimensions for n in d.names()]
    return out.select(*fact.columns, *names)
