"""Cell-id arithmetic as Column expressions: no UDF, so Catalyst can fold, push down and prune by them.

An id has, from the top: a reserved 0, four bits of mode (1), three reserved, four of resolution, seven of base cell,
and fifteen digits of three bits, those beyond the resolution being 7.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PENTAGON_BASES = (4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117)
MAX_RES = 15


def _bits(cell: Column, low: int, width: int) -> Column:
    return F.shiftright(cell, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def base_cell(cell: Column) -> Column:
    """The resolution-0 ancestor, 0 to 121; the shard key of cell tables."""
    return _bits(cell, 45, 7)


def base_of(cell: int) -> int:
    return (cell >> 45) & 127


def resolution(cell: Column) -> Column:
    return _bits(cell, 52, 4)


def digit(cell: Column, res: int) -> Column:
    return _bits(cell, 45 - 3 * res, 3)


def parent(cell: Column, res: int) -> Column:
    """The ancestor at a coarser resolution."""
    unused = (1 << (45 - 3 * res)) - 1
    return cell.bitwiseAND(F.lit(~((15 << 52) | unused)).cast("long")).bitwiseOR(F.lit((res << 52) | unused).cast("long"))


def is_pentagon(cell: Column, res: int) -> Column:
    """Of cells at a known resolution."""
    zeros = F.lit(True) if res == 0 else _bits(cell, 45 - 3 * res, 3 * res) == 0
    return base_cell(cell).isin(*PENTAGON_BASES) & zeros


def children(cell: Column, from_res: int, res: int) -> Column:
    """All descendants at a finer resolution, in order: seven a level, six of pentagons, which lack digit 1."""
    out = F.array(cell)
    for r in range(from_res + 1, res + 1):
        out = F.flatten(F.transform(out, _below(r)))
    return out


def _below(r: int):
    """A function of a cell of resolution r - 1 that gives its children."""

    def below(p: Column) -> Column:
        one = 45 - 3 * r
        stem = p.bitwiseAND(F.lit(~((15 << 52) | (7 << one))).cast("long")).bitwiseOR(F.lit(r << 52).cast("long"))
        all_ = [stem.bitwiseOR(F.lit(d << one).cast("long")) for d in range(7)]
        return F.when(is_pentagon(p, r - 1), F.array(all_[0], *all_[2:])).otherwise(F.array(*all_))

    return below


def is_valid(cell: Column) -> Column:
    """Whether a number is a cell id."""
    res = resolution(cell)
    good = (_bits(cell, 59, 5) == 1) & (_bits(cell, 56, 3) == 0) & (base_cell(cell) <= 121)
    for r in range(1, MAX_RES + 1):
        d = digit(cell, r)
        good = good & F.when(res >= r, d <= 6).otherwise(d == 7)
    lead = F.coalesce(*[F.when((res >= r) & (digit(cell, r) != 0), digit(cell, r)) for r in range(1, MAX_RES + 1)], F.lit(0).cast("long"))
    return F.coalesce(good & ~(base_cell(cell).isin(*PENTAGON_BASES) & (lead == 1)), F.lit(False))


def to_hex(cell: Column) -> Column:
    return F.lower(F.hex(cell))


def from_hex(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")
