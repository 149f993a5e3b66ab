"""Effective-dated ladders from configuration rows.

A ladder is a set of steps per effective date: the label of the highest step
whose (inclusive) lower bound a value reaches.  Rows of facts find the version
of their own date and then the step by binary search in sorted arrays, so a
long history of configuration costs a row a few comparisons and no join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import specs
from .expressions import col_

#: Interval ends are inclusive and given to this unit.
UNIT = Decimal("0.01")


@dataclass(frozen=True)
class Step:
    effective_from: dt.date
    #: None: from the lowest value on
    minimum: Decimal | None
    label: str


def upper_bound(ordered: Column, value: Column, longest: int) -> Column:
    """How many of the sorted values are at most ``value`` (0 for null), by
    binary search.  ``longest`` bounds the length of the array."""
    start = F.struct(F.lit(0).alias("low"), F.size(ordered).alias("high"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        reached = F.coalesce(F.get(ordered, middle) <= value, F.lit(False))
        return F.when(at["low"] >= at["high"], at) \
            .when(reached, F.struct((middle + 1).alias("low"), at["high"].alias("high"))) \
            .otherwise(F.struct(at["low"].alias("low"), middle.alias("high")))

    rounds = F.sequence(F.lit(1), F.lit(max(1, longest.bit_length())))
    return F.aggregate(rounds, start, halve, lambda at: at["low"])


class DatedLadder:
    def __init__(self, steps: Iterable[Step]):
        versions: dict[dt.date, list[Step]] = {}
        for s in steps:
            versions.setdefault(s.effective_from, []).append(s)
        if not versions:
            raise ValueError("a ladder without steps")
        self.dates = sorted(versions)
        self.labels, self.bounds = [], []
        for d in self.dates:
            own = sorted(versions[d], key=lambda s: (s.minimum is not None, s.minimum))
            minima = [s.minimum for s in own[1:]]
            if None in minima or len(set(minima)) < len(minima):
                raise ValueError(f"two steps from the same bound on {d}")
            self.labels.append([s.label for s in own])
            # whatever lies below the second step takes the lowest
            self.bounds.append(minima)

    def at(self, value: str | Column, date: str | Column, null_label: str | None = None) -> Column:
        """The label of each row's value on its date.  A null value takes
        ``null_label``, or the lowest step; a null date, or one before the
        first version, has no label."""
        v, longest = col_(value).cast("decimal(38,8)"), max(map(len, self.bounds))
        dates = F.array(*(F.lit(d) for d in self.dates))
        kind = "array<array<decimal(38,8)>>"
        bounds = F.array(*(F.array(*(F.lit(b).cast("decimal(38,8)") for b in own)).cast(kind[6:-1]) for own in self.bounds))
        labels = F.array(*(F.array(*map(F.lit, own)) for own in self.labels))
        version = upper_bound(dates, col_(date), len(self.dates)) - 1
        found = F.get(F.get(labels, version), upper_bound(F.get(bounds, version), v, longest))
        return found if null_label is None else F.when(version >= 0, F.when(v.isNull(), F.lit(null_label)).otherwise(found))


def check_intervals(rows: Sequence[tuple[dt.date, str, Decimal, Decimal]], unit: Decimal = UNIT) -> None:
    """(effective_from, name, minimum, maximum): raises where the intervals of a
    version overlap, leave a gap, or end before they begin."""
    faults, by_date = [], {}
    for row in rows:
        by_date.setdefault(row[0], []).append(row)
    for d, own in sorted(by_date.items()):
        own.sort(key=lambda r: (r[2], r[3]))
        faults += [f"{d}: {name} ends before it begins" for _, name, low, high in own if high < low]
        for (_, a, _, high), (_, b, low, _) in zip(own, own[1:]):
            if low <= high:
                faults.append(f"{d}: {a} and {b} overlap")
            elif low != high + unit:
                faults.append(f"{d}: gap between {a} and {b}")
    if faults:
        raise ValueError("; ".join(faults))


@dataclass(frozen=True)
class Ladders:
    """The dated configuration of a run; what is None follows the fixed values."""
    bands: DatedLadder | None = None
    high_value: DatedLadder | None = None
    health: DatedLadder | None = None
    thresholds: Mapping[str, DatedLadder] = field(default_factory=dict)


def bands_of(config: DataFrame) -> DatedLadder:
    """Value bands from (effective_from, band_name, minimum_value, maximum_value): a row a band and version."""
    rows = [(r.effective_from, r.band_name, r.minimum_value, r.maximum_value) for r in config.collect()]
    check_intervals(rows)
    return DatedLadder(Step(d, low, name) for d, name, low, _ in rows)


def thresholds_of(config: DataFrame) -> dict[str, DatedLadder]:
    """Status ladders by metric from (effective_from, metric_name, green_threshold, amber_threshold)."""
    steps: dict[str, list[Step]] = {}
    for r in config.collect():
        if not r.green_threshold <= r.amber_threshold:
            raise ValueError(f"{r.effective_from}: {r.metric_name} is amber below green")
        # nothing is amber where both bounds are one
        amber = [Step(r.effective_from, r.green_threshold, "AMBER")] if r.green_threshold < r.amber_threshold else []
        steps.setdefault(r.metric_name, []).extend(
            [Step(r.effective_from, None, "GREEN"), *amber, Step(r.effective_from, r.amber_threshold, "RED")])
    return {name: DatedLadder(own) for name, own in steps.items()}


def health_of(config: DataFrame) -> DatedLadder:
    """Portfolio health from (effective_from, label, minimum_rate), the null minimum being the best."""
    return DatedLadder(Step(r.effective_from, r.minimum_rate, r.label) for r in config.collect())


def high_value_of(config: DataFrame) -> DatedLadder:
    """The high-value flag from (effective_from, minimum_value)."""
    return DatedLadder(s for r in config.collect() for s in (
        Step(r.effective_from, None, "false"), Step(r.effective_from, r.minimum_value, "true")))


def fixed_ladders(effective_from: dt.date) -> Ladders:
    """The fixed configuration values as one version of dated rows."""
    d = effective_from
    lows = [None, *(bound for bound, _ in specs.HEALTH_LADDER)]
    names = [*(label for _, label in specs.HEALTH_LADDER), specs.HEALTH_OTHERWISE]
    return Ladders(
        DatedLadder(Step(d, b.minimum, b.name) for b in specs.VALUE_BANDS),
        DatedLadder([Step(d, None, "false"), Step(d, specs.HIGH_VALUE_MINIMUM, "true")]),
        DatedLadder(Step(d, low, name) for low, name in zip(lows, names)),
        {t.metric: DatedLadder([Step(d, None, "GREEN"), Step(d, t.green, "AMBER"), Step(d, t.amber, "RED")])
         for t in specs.THRESHOLDS})
