"""Joins of feature groups: star joins, feature-set lookups and the dataset builder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import WRITE_TIME, FeatureGroup, parse_features
from tidemark.operators.latest import (
    as_time,
    event_time_range,
    latest,
    rows_as_of_write_time,
    time_literal,
)
from tidemark.operators.pit import pit_recent
from tidemark.skew import Skew
from tidemark.sources.files import write_csv
from tidemark.sources.layout import of_ids


def suffixed(left: Sequence[str], right: Sequence[str], suffix: str = "_{}") -> dict[str, str]:
    """New names for the right side of a join: the second ``a`` becomes ``a_1``, the third ``a_2``."""
    used = {c.lower() for c in left}
    names = {}
    for column in right:
        name, k = column, 0
        while name.lower() in used:
            k += 1
            name = column + suffix.format(k)
        used.add(name.lower())
        names[column] = name
    return names


def join_group(
    left: DataFrame, left_key: str, right: DataFrame, right_key: str, how: str = "inner", suffix: str = "_{}"
) -> DataFrame:
    """Equi join that keeps both key columns and numbers repeated names."""
    names = suffixed(left.columns, right.columns, suffix)
    renamed = right.select(*[F.col(c).alias(n) for c, n in names.items()])
    return left.join(renamed, left[left_key] == renamed[names[right_key]], how)


def star_join(
    facts: DataFrame, dimensions: Sequence[tuple[DataFrame, str, str]], how: str = "inner", suffix: str = "_{}"
) -> DataFrame:
    """Join each (dimension, fact key, dimension key) to the facts; history rows multiply."""
    out = facts
    for df, fact_key, key in dimensions:
        out = join_group(out, fact_key, df, key, how, suffix)
    return out


def latest_star_join(
    facts: tuple[DataFrame, FeatureGroup],
    dimensions: Sequence[tuple[DataFrame, FeatureGroup, str]],
    columns: Sequence[str],
) -> DataFrame:
    """Distinct rows of the newest facts with the newest dimension rows.

    Markers are filtered before ranking here, as the scoring query does.
    """
    df = latest(*facts, ties="all", deleted="before")
    sides = [
        (latest(history, fg, ties="all", deleted="before"), fact_key, fg.record_id)
        for history, fg, fact_key in dimensions
    ]
    return star_join(df, sides).select(*columns).distinct()


def batch_get(current: DataFrame, fg: FeatureGroup, ids: DataFrame) -> DataFrame:
    """Current records of many ids; ids without a record are absent from the result."""
    wanted = ids.select(F.col(ids.columns[0]).alias(fg.record_id)).distinct()
    return current.join(wanted, fg.record_id, "left_semi")


def stored_get(history: DataFrame, fg: FeatureGroup, ids: DataFrame | Sequence[Any]) -> DataFrame:
    """Current records of some ids from a stored history, opening only the files and row groups that may hold them.

    Best on files written by `write_clustered`; null ids and ids without a record are absent from the result.
    """
    return latest(of_ids(history, fg.record_id, ids), fg).select(*fg.names)


def latest_featureset(
    ids: DataFrame,
    features: Sequence[str],
    groups: Mapping[str, FeatureGroup],
    online: Mapping[str, DataFrame],
    suffix: str = "_{}",
) -> DataFrame:
    """One row per row of ``ids`` with current features of several groups, in the order requested.

    Each group is looked up by its own record id column in ``ids``; a missing
    record leaves nulls.
    """
    wanted = parse_features(features, groups)
    out, chosen = ids, []
    used = {c.lower() for c in ids.columns}
    renamed: dict[tuple[str, str], str] = {}
    for fg, feature in wanted:
        name, k = feature, 0
        while name.lower() in used:
            k += 1
            name = feature + suffix.format(k)
        used.add(name.lower())
        renamed[fg.name, feature] = name
        chosen.append(name)
    for fg in dict.fromkeys(fg.name for fg, _ in wanted):
        group = groups[fg]
        columns = [F.col(f).alias(renamed[fg, f]) for g, f in wanted if g.name == fg]
        key = F.col(group.record_id).alias(f"__key_{fg}")
        side = online[fg].select(key, *columns)
        out = out.join(side, F.col(group.record_id) == F.col(f"__key_{fg}"), "left").drop(f"__key_{fg}")
    return out.select(*ids.columns, *chosen)


def basket_vectors(
    baskets: DataFrame,
    customers: DataFrame,
    customer_key: str,
    customer_features: Sequence[str],
    products: DataFrame,
    product_key: str,
    product_features: Sequence[str],
) -> DataFrame:
    """Customer and product features of each basket line as one comma-separated payload."""
    vector = F.concat_ws(
        ",",
        *[F.col(f"c.{f}").cast("string") for f in customer_features],
        *[F.col(f"p.{f}").cast("string") for f in product_features],
    )
    return (
        baskets.alias("b")
        .join(customers.alias("c"), F.col(f"b.{customer_key}") == F.col(f"c.{customer_key}"))
        .join(products.alias("p"), F.col(f"b.{product_key}") == F.col(f"p.{product_key}"))
        .select(f"b.{customer_key}", f"b.{product_key}", vector.alias("payload"))
    )


@dataclass(frozen=True)
class _Target:
    fg: FeatureGroup
    history: DataFrame
    key: str
    columns: tuple[str, ...] | None
    how: str


@dataclass(frozen=True)
class Dataset:
    """Fluent, lazy dataset: nothing runs until the resulting DataFrame is used."""

    base: DataFrame
    record_id: str
    event_time: str | None
    fg: FeatureGroup | None = None
    targets: tuple[_Target, ...] = ()
    start: Any = None
    end: Any = None
    written_by: Any = None
    point_in_time: bool = False
    strict: bool = False
    recent_n: int | None = None
    suffix: str = "_{}"
    skew: Skew | None = Skew()

    def with_feature_group(
        self,
        fg: FeatureGroup,
        history: DataFrame,
        key: str | None = None,
        columns: Sequence[str] | None = None,
        how: str = "inner",
    ) -> Dataset:
        """Join a group on ``base[key] = record id``, with all or some of its features."""
        target = _Target(fg, history, key or self.record_id, tuple(columns) if columns else None, how)
        return replace(self, targets=(*self.targets, target))

    def with_event_time_range(self, start: Any = None, end: Any = None) -> Dataset:
        """Only rows of the base and of every group within the range, ends included."""
        return replace(self, start=start, end=end)

    def as_of(self, written_by: Any) -> Dataset:
        """Only rows written by this instant (write time, not event time)."""
        return replace(self, written_by=written_by)

    def point_in_time_accurate_join(self, strict: bool = False) -> Dataset:
        return replace(self, point_in_time=True, strict=strict)

    def with_number_of_recent_records_by_record_identifier(self, n: int) -> Dataset:
        return replace(self, recent_n=n)

    def to_dataframe(self) -> DataFrame:
        if self.point_in_time and self.event_time is None:
            raise ValueError("a point-in-time join needs the event time column of the base")
        out = self.base
        if self.written_by is not None and WRITE_TIME in out.columns:
            out = rows_as_of_write_time(out, self.written_by)
        if self.event_time is not None:
            if self.start is not None:
                out = out.where(as_time(out, self.event_time) >= time_literal(out, self.event_time, self.start))
            if self.end is not None:
                out = out.where(as_time(out, self.event_time) <= time_literal(out, self.event_time, self.end))
        if self.recent_n is not None and not self.point_in_time and self.fg is not None:
            out = latest(out, self.fg, n=self.recent_n)
        for target in self.targets:
            out = self._join(out, target)
        return out

    def to_csv(self, path: str, header: bool = True) -> None:
        write_csv(self.to_dataframe(), path, header)

    def _join(self, base: DataFrame, target: _Target) -> DataFrame:
        fg, history = target.fg, target.history
        if self.written_by is not None:
            history = rows_as_of_write_time(history, self.written_by)
        history = event_time_range(history, fg, self.start, self.end)
        columns = list(target.columns or fg.names)
        if self.point_in_time:
            names = suffixed(base.columns, columns, self.suffix)
            return pit_recent(
                base, self.event_time, fg, history, columns, n=self.recent_n or 1, spine_key=target.key,
                names=names, strict=self.strict, skew=self.skew, how=target.how,
            )
        if self.recent_n is not None:
            history = latest(history, fg, n=self.recent_n)
        side = history.select(*dict.fromkeys([fg.record_id, *columns]))
        joined = join_group(base, target.key, side, fg.record_id, target.how, self.suffix)
        if fg.record_id not in columns:
            joined = joined.drop(suffixed(base.columns, side.columns, self.suffix)[fg.record_id])
        return joined


def create_dataset(
    base: DataFrame,
    record_id: str | None = None,
    event_time: str | None = None,
    fg: FeatureGroup | None = None,
    **options,
) -> Dataset:
    """Start from a feature group's history (give ``fg``) or from any frame (give its columns)."""
    if fg is not None:
        return Dataset(base, fg.record_id, fg.event_time, fg, **options)
    if record_id is None:
        raise ValueError("a frame as base needs its record id column")
    return Dataset(base, record_id, event_time, **options)
