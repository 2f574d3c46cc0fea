"""Z-order (Morton) codes for two numeric columns, built from plain column expressions.

Each axis is scaled to 16 bits between its minimum and maximum; the code interleaves
the bits, first axis in the even places. Null, NaN and infinite inputs give a null code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXIS_MAX = 0xFFFF

# Shift and mask of each step that doubles the gaps between the bits of a 16-bit number.
SPREAD_STEPS = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _finite(column: str) -> Column:
    # NaN sorts above infinity in Spark, so one comparison drops both
    value = F.col(column).cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def axis_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with a struct ``bounds`` of ``<column>_low`` and ``<column>_high``."""
    fields = []
    for name in columns:
        fields += [
            F.min(_finite(name)).alias(f"{name}_low"),
            F.max(_finite(name)).alias(f"{name}_high"),
        ]
    return df.agg(F.struct(*fields).alias("bounds"))


def _axis(value: Column, low: Column, high: Column) -> Column:
    position = F.floor((value - low) / (high - low) * AXIS_MAX)
    # bounds given by the caller may be narrower than the data; least and greatest skip nulls
    inside = F.greatest(F.lit(0), F.least(F.lit(AXIS_MAX), position))
    return F.when(value.isNotNull(), F.when(high > low, inside).otherwise(F.lit(0))).cast("bigint")


def with_zorder(
    df: DataFrame,
    x: str,
    y: str,
    into: str = "z_order_col",
    bounds: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Add the Z-order code of ``x`` and ``y``.

    Without ``bounds`` the extremes come from a scalar subquery: one extra pass that reads
    two columns and sends one row per task, and no join. Give ``bounds`` as
    (x_low, x_high, y_low, y_high) to skip that pass and to keep loads of later days on
    the same curve.

    The steps are separate projections on purpose: a column used twice in the next step is
    then computed once, where one nested expression would double in size with each step.
    """
    if bounds is None:
        limits = axis_bounds(df, [x, y]).scalar()
    else:
        names = [f"{x}_low", f"{x}_high", f"{y}_low", f"{y}_high"]
        limits = F.struct(*(F.lit(float(b)).alias(n) for b, n in zip(bounds, names)))
    out = df.withColumns({"_limits": limits, "_x": _finite(x), "_y": _finite(y)})
    limit = F.col("_limits")
    out = out.withColumns(
        {
            "_x": _axis(F.col("_x"), limit[f"{x}_low"], limit[f"{x}_high"]),
            "_y": _axis(F.col("_y"), limit[f"{y}_low"], limit[f"{y}_high"]),
        }
    ).drop("_limits")
    for shift, mask in SPREAD_STEPS:
        out = out.withColumns(
            {
                axis: F.col(axis).bitwiseOR(F.shiftleft(axis, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
                for axis in ("_x", "_y")
            }
        )
    return out.withColumn(into, F.col("_x").bitwiseOR(F.shiftleft("_y", 1))).drop("_x", "_y")
