"""Model matrices: null filling, one-hot encoding, splitting and alignment of snapshots.

An encoder is fitted on the training snapshot and holds only names and levels, so applying it is
one ``select`` without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .. import config
from ..config import DEFAULT_SPEC, SnapshotSpec
from ..functions.expressions import column
from ..functions.hashing import hash_below, seeded_hash
from ..functions.names import ascii_map
from . import ranges
from .validate import require_schema_match

NULL_LEVEL = "0"
OTHER_LEVEL = "other"
RANKING_SLICES = 256


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def fill_missing(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Missing values become 0: number 0, text ``"0"`` and boolean false."""
    def filled(field: T.StructField) -> Column:
        c = column(field.name)
        if field.name in exclude:
            return c
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(c, F.lit(NULL_LEVEL))
        if isinstance(field.dataType, T.BooleanType):
            return F.coalesce(c, F.lit(False))
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        if isinstance(field.dataType, T.NumericType):
            return F.coalesce(c, F.lit(0).cast(field.dataType))
        raise TypeError(f"Column {field.name!r} has unsupported type {field.dataType.simpleString()}.")

    return df.select(*[filled(f).alias(f.name) for f in df.schema])


def _level_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows per ``(variable, level)`` of the text columns, in one pass; NULL is not a level."""
    wide = [column(n) for n in names]
    long = df.select(*wide).unpivot([], wide, "variable", "level").where(F.col("level").isNotNull())
    return long.groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))


def count_levels(df: DataFrame, names: Sequence[str]) -> dict[str, int]:
    """Number of levels of each text column; one row per column reaches the driver."""
    if not names:
        return {}
    found = _level_counts(df, names).groupBy("variable").agg(F.count(F.lit(1)).alias("levels")).collect()
    return {**dict.fromkeys(names, 0), **{r["variable"]: r["levels"] for r in found}}


def discover_levels(
    df: DataFrame,
    names: Sequence[str],
    max_levels: int | None = None,
    overflow: str = "error",
) -> tuple[dict[str, list[str]], frozenset[str]]:
    """Sorted levels of each text column (NULL is not one), and the columns with gathered levels.

    One pass. Every level becomes a column, so all levels reach the driver. ``max_levels`` sets a bound,
    beyond which ``overflow="error"`` raises and ``overflow="other"`` keeps the ``max_levels - 1`` most
    frequent levels of a column and gathers the rest under one level.
    """
    if overflow not in ("error", "other"):
        raise ValueError("overflow must be 'error' or 'other'.")
    if not names:
        return {}, frozenset()
    counts = _level_counts(df, names)
    if max_levels is None:
        found_rows = counts.collect()
    elif overflow == "other":
        # First per slice of the levels, then overall: no task ranks all levels of a wide column.
        ranked = counts.withColumn("slice", F.pmod(F.xxhash64("level"), F.lit(RANKING_SLICES)))
        for groups in (("variable", "slice"), ("variable",)):
            top = Window.partitionBy(*groups).orderBy(F.desc("n"), "level")
            ranked = ranked.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= max_levels + 1)
        found_rows = ranked.select("variable", "level", "n").collect()
    else:
        per_name = counts.groupBy("variable").agg(F.count(F.lit(1)).alias("levels"))
        wide = sorted(r["variable"] for r in per_name.where(F.col("levels") > max_levels).collect())
        if wide:
            raise ValueError(f"More than {max_levels} levels in column(s) {', '.join(wide)}.")
        found_rows = counts.collect()
    found: dict[str, list[tuple[int, str]]] = {n: [] for n in names}
    for row in found_rows:
        found[row["variable"]].append((-row["n"], row["level"]))

    levels, gathered = {}, set()
    for name, rows in found.items():
        if max_levels is not None and len(rows) > max_levels:
            gathered.add(name)
            rows = sorted(rows)[: max_levels - 1]
        levels[name] = sorted({level for _, level in rows} - ({OTHER_LEVEL} if name in gathered else set()))
        if name in gathered:
            levels[name].append(OTHER_LEVEL)
    return levels, frozenset(gathered)


@dataclass(frozen=True)
class Feature:
    """One output column: a source column as it is, or an indicator of one of its levels.

    ``known`` lists the named levels when this is the indicator of all remaining ones.
    """

    name: str
    source: str
    level: str | None = None
    known: tuple[str, ...] | None = None

    def expression(self) -> Column:
        c = column(self.source)
        if self.level is None:
            return c.alias(self.name)
        hit = ~c.isin(*self.known) if self.known is not None else c == F.lit(self.level)
        return F.when(hit, F.lit(1)).otherwise(F.lit(0)).alias(self.name)


@dataclass(frozen=True)
class FeatureEncoder:
    """Fitted encoding: which columns, in which order, from which source levels.

    Names in ``order`` without a feature are constant 0.
    """

    spec: SnapshotSpec
    features: tuple[Feature, ...]
    order: tuple[str, ...]

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        keep: Sequence[str] | None = None,
        spec: SnapshotSpec = DEFAULT_SPEC,
        exclude: Sequence[str] = (),
        max_levels: int | None = None,
        overflow: str = "error",
        names: Mapping[str, str] | None = None,
    ) -> "FeatureEncoder":
        """Learn levels from ``df``.

        ``keep`` holds raw column names (chosen before encoding) or encoded names (chosen after);
        an encoded name this snapshot does not produce becomes a constant 0.
        """
        carried = {*spec.keys, spec.target, *exclude}
        raw = [n for n in df.columns if n not in carried]
        before = bool(keep) and all(n in df.columns for n in keep)
        if before:
            raw = [n for n in keep if n not in carried]
        all_texts = set(text_columns(df))
        texts = [n for n in raw if n in all_texts]
        if keep and not before:
            # A level column starts with its source's name; other text columns need no scan.
            texts = [n for n in texts if any(k.startswith(ascii_map([n], names)[n] + "_") for k in keep)]
        filled = fill_missing(df.select(*[column(n) for n in texts]))
        levels, gathered = discover_levels(filled, texts, max_levels, overflow)

        def indicator(n: str, level: str) -> Feature:
            rest = n in gathered and level == OTHER_LEVEL
            return Feature(f"{n}_{level}", n, level, tuple(levels[n][:-1]) if rest else None)

        plain = [Feature(n, n) for n in raw if n not in all_texts]
        encoded = [indicator(n, level) for n in texts for level in levels[n]]
        renamed = ascii_map([f.name for f in plain + encoded], names)
        features = [Feature(renamed[f.name], f.source, f.level, f.known) for f in plain + encoded]
        if keep and not before:
            by_name = {f.name: f for f in features}
            return cls(spec, tuple(by_name[n] for n in keep if n in by_name), tuple(keep))
        return cls(spec, tuple(features), tuple(f.name for f in features))

    @property
    def names(self) -> list[str]:
        return list(self.order)

    def restricted(self, names: Sequence[str]) -> "FeatureEncoder":
        """Same encoding with these output columns, in this order; unknown names become 0."""
        wanted = set(names)
        return FeatureEncoder(self.spec, tuple(f for f in self.features if f.name in wanted), tuple(names))

    def transform(self, df: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
        """Carried columns (default: keys and, if present, target), then the features in order.

        A feature whose source column the snapshot lacks is 0.
        """
        if carry is None:
            carry = [n for n in (*self.spec.keys, self.spec.target) if n in df.columns]
        features = [f for f in self.features if f.source in df.columns]
        sources = list(dict.fromkeys(f.source for f in features))
        filled = fill_missing(df.select(*[column(n) for n in dict.fromkeys([*carry, *sources])]), exclude=carry)
        built = {f.name: f.expression() for f in features}
        return filled.select(
            *[column(n) for n in carry],
            *[built[n] if n in built else F.lit(0).alias(n) for n in self.order],
        )


def one_hot(df: DataFrame, spec: SnapshotSpec = DEFAULT_SPEC, **options) -> DataFrame:
    """Encode a snapshot by its own levels."""
    return FeatureEncoder.fit(df, spec=spec, **options).transform(df)


def common_features(left: Sequence[str], right: Sequence[str]) -> list[str]:
    """Names in both lists, in the order of the first."""
    also = set(right)
    return [n for n in left if n in also]


def align(df: DataFrame, features: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Exactly the model's columns in the model's order: missing ones as 0, extra ones dropped."""
    present = set(df.columns)
    return df.select(
        *[column(n) for n in carry if n in present],
        *[column(n) if n in present else F.lit(0).alias(n) for n in features],
    )


# -- splitting --------------------------------------------------------------------------------


def is_validation(
    spec: SnapshotSpec = DEFAULT_SPEC,
    share: float = config.VALIDATION_SHARE,
    seed: int = config.SPLIT_SEED,
) -> Column:
    """True for about ``share`` of the customers, the same ones on any partitioning."""
    return seeded_hash(seed, spec.customer_id) < F.lit(hash_below(share))


def split_exact(
    df: DataFrame,
    spec: SnapshotSpec = DEFAULT_SPEC,
    share: float = config.VALIDATION_SHARE,
    seed: int = config.SPLIT_SEED,
) -> DataFrame:
    """Add ``split``: ``val`` for exactly ``ceil(share * rows)`` rows, ``train`` for the others."""
    hashed = df.withColumn("__hash", seeded_hash(seed, spec.customer_id))
    wanted = math.ceil(share * df.count())
    chosen, others = ranges.first_by_hash(hashed, "__hash", wanted)
    return chosen.withColumn("split", F.lit("val")).unionByName(others.withColumn("split", F.lit("train"))).drop("__hash")


@dataclass(frozen=True)
class Prepared:
    """Development data: one frame with ``split`` in train / val / test, and its encoder."""

    data: DataFrame
    encoder: FeatureEncoder

    def part(self, split: str) -> DataFrame:
        return self.data.where(F.col("split") == split)


def prepare_development(
    train: DataFrame,
    test: DataFrame,
    keep: Sequence[str] | None = None,
    spec: SnapshotSpec = DEFAULT_SPEC,
    exact_split: bool = False,
    **options,
) -> Prepared:
    """Encode both snapshots with the training snapshot's levels and split the training rows.

    Only features both snapshots have on their own stay, unless ``keep`` names encoded columns:
    then these stay, and one the data lack is 0.
    """
    require_schema_match(train, test, spec.target)
    encoder = FeatureEncoder.fit(train, keep, spec, **options)
    if not keep or set(keep) <= set(train.columns):
        own = FeatureEncoder.fit(test, keep, spec, **options)
        encoder = encoder.restricted(common_features(encoder.names, own.names))
    carry = [*spec.keys, spec.target]

    def labelled(df: DataFrame, split: Column | None) -> DataFrame:
        tagged = df if split is None else df.withColumn("split", split)
        return encoder.transform(tagged, [*carry, "split"])

    if exact_split:
        train_rows = labelled(split_exact(train, spec), None)
    else:
        train_rows = labelled(train, F.when(is_validation(spec), "val").otherwise("train"))
    return Prepared(train_rows.unionByName(labelled(test, F.lit("test"))), encoder)


def prepare(train: DataFrame, test: DataFrame | None = None, **options) -> Prepared | DataFrame:
    """Development data when a test snapshot is given, else an encoded scoring snapshot."""
    if test is not None:
        return prepare_development(train, test, **options)
    return one_hot(train, **options)
