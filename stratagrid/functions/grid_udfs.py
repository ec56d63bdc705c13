"""The grid kernel as Arrow functions of columns, and its registration for SQL.

Points without coordinates, or with coordinates that aren't finite, have no cell; null, and ids that aren't a cell's, have
no centre, outline or neighbours. Such rows give null, and the kernel isn't called on them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import grid

LATLNG = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())])
#: A cell that stands in for what isn't one, so that whole columns of plain numbers reach the kernel.
_ANY = (1 << 59) | ((1 << 45) - 1)


def _numbers(column: pa.Array) -> np.ndarray:
    """Doubles; NaN for null."""
    return np.asarray(column.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=float)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_ANY).to_numpy(zero_copy_only=False).astype(np.int64)


def _masked(array: pa.Array, none: np.ndarray) -> pa.Array:
    return pa.compute.if_else(pa.array(none), pa.scalar(None, array.type), array) if none.any() else array


def _of_cells(cell: pa.Array, f: Callable[[np.ndarray], pa.Array]) -> pa.Array:
    """f of the cells in a column, and null of what isn't a cell. This is told here, not by a Column: bits.is_valid names
    its cell some three hundred times, and Spark makes each a column of the rows that wait for Python if the cell comes
    from an aggregate."""
    ids = _ids(cell)
    good = _valid(ids) & ~np.asarray(cell.is_null())
    return _masked(f(np.where(good, ids, _ANY)), ~good)


def _cells(lat: np.ndarray, lng: np.ndarray, res: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells, and which points have none."""
    good = np.isfinite(lat) & np.isfinite(lng)
    out = np.zeros(len(lat), dtype=np.int64)
    out[good] = grid.latlng_to_cell(lat[good], lng[good], res)
    return out, ~good


def latlng_to_cell(lat: Column, lng: Column, res: int) -> Column:
    """The cell of a point in degrees; null where a coordinate is missing or not finite."""

    @F.arrow_udf(T.LongType())
    def cell(lat: pa.Array, lng: pa.Array) -> pa.Array:
        out, none = _cells(_numbers(lat), _numbers(lng), res)
        return pa.array(out, mask=none)

    return cell(lat, lng)


def latlng_to_cells(lat: Column, lng: Column, resolutions: tuple[int, ...]) -> Column:
    """The cells of a point at several resolutions, each found from the point itself, as an array of (res, h3_cell); null
    where a coordinate is missing or not finite. One transfer to Python serves them all."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def cells(lat: pa.Array, lng: pa.Array) -> pa.Array:
        at = _numbers(lat), _numbers(lng)
        each = [_cells(*at, r) for r in resolutions]
        flat = np.stack([out for out, _ in each], axis=1).ravel()
        starts = np.arange(0, len(flat) + 1, len(resolutions), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(starts, mask=np.r_[each[0][1], False]), pa.array(flat))

    own = cells(lat, lng)
    return F.transform(F.arrays_zip(F.array(*[F.lit(r) for r in resolutions]).alias("res"), own.alias("h3_cell")), lambda x: F.struct(x["res"].alias("res"), x["h3_cell"].alias("h3_cell")))


def _points(lat: np.ndarray, lng: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(lat), pa.array(lng)], names=["lat", "lng"])


@F.arrow_udf(LATLNG)
def _centre(cell: pa.Array) -> pa.Array:
    return _of_cells(cell, lambda ids: _points(*grid.cell_to_latlng(ids)))


@F.arrow_udf(T.ArrayType(LATLNG))
def _outline(cell: pa.Array) -> pa.Array:
    def outlines(ids: np.ndarray) -> pa.Array:
        lat, lng, starts = grid.outlines(ids)
        return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), _points(lat, lng))

    return _of_cells(cell, outlines)


@F.arrow_udf(T.DoubleType())
def _south(cell: pa.Array) -> pa.Array:
    return _of_cells(cell, lambda ids: pa.array(grid.cell_bounds(ids)[0]))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _disk(cell: pa.Array, k: pa.Array) -> pa.Array:
    steps = k.fill_null(0).to_numpy(zero_copy_only=False)

    def disks(ids: np.ndarray) -> pa.Array:
        lists = np.empty(len(ids), dtype=object)
        for n in np.unique(steps):
            m = np.flatnonzero(steps == n)
            held, starts = grid.disks(ids[m], int(n))
            for i, lo, hi in zip(m, starts[:-1], starts[1:], strict=True):
                lists[i] = held[lo:hi]
        counts = np.array([len(x) for x in lists], dtype=np.int64)
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int64), *lists])))

    return _of_cells(cell, disks)


def cell_to_latlng(cell: Column) -> Column:
    """The centre, as (lat, lng) in degrees."""
    return _centre(cell.cast("long"))


def cell_to_boundary(cell: Column) -> Column:
    """The outline, as an array of (lat, lng)."""
    return _outline(cell.cast("long"))


def cell_south(cell: Column) -> Column:
    """The southern extent of a cell's outline in degrees."""
    return _south(cell.cast("long"))


def grid_disk(cell: Column, k: int | Column) -> Column:
    """Cells at most k steps away."""
    steps = F.lit(k) if isinstance(k, int) else k
    return F.when(steps.isNotNull(), _disk(cell.cast("long"), steps.cast("int")))


def _valid(ids: np.ndarray) -> np.ndarray:
    """Whether ids are cells: their mode, base, digits up to the resolution and none below it, and no digit in the sixth
    that a pentagon lacks."""
    res, base = grid.resolution(ids), grid.base_cell(ids)
    good, leading = (ids >> 59 == 1) & (ids >> 56 & 7 == 0) & (base < 122), np.zeros(len(ids), dtype=np.int64)
    for r in range(1, 16):
        digit = ids >> (45 - 3 * r) & 7
        good &= np.where(r <= res, digit < 7, digit == 7)
        leading = np.where((leading == 0) & (r <= res), digit, leading)
    return good & ~(grid.IS_PENTAGON[np.minimum(base, 121)] & (leading == 1))


def register(spark: SparkSession) -> None:
    """Makes the kernel callable from SQL: cell_of(lat, lng, res), cell_centre(cell), cell_outline(cell), cell_disk(cell, k).
    They give null where the functions of columns do, and for a resolution or a number of steps that is missing or out
    of range."""

    @F.arrow_udf(T.LongType())
    def cell_of(lat: pa.Array, lng: pa.Array, res: pa.Array) -> pa.Array:
        at, steps = (_numbers(lat), _numbers(lng)), res.fill_null(-1).to_numpy(zero_copy_only=False)
        out, none = np.zeros(len(steps), dtype=np.int64), np.ones(len(steps), dtype=bool)
        for r in np.unique(steps[(steps >= 0) & (steps <= 15)]):
            m = steps == r
            out[m], none[m] = _cells(at[0][m], at[1][m], int(r))
        return pa.array(out, mask=none)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def cell_disk(cell: pa.Array, k: pa.Array) -> pa.Array:
        steps = k.fill_null(-1).to_numpy(zero_copy_only=False)
        return _masked(_disk.func(cell, pa.array(np.maximum(steps, 0))), steps < 0)

    for name, f in {"cell_of": cell_of, "cell_centre": _centre, "cell_outline": _outline, "cell_disk": cell_disk}.items():
        spark.udf.register(name, f)
