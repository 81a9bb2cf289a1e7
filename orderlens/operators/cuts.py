"""Exact cut points of an order without ordering the rows.

The row at a position is searched in rounds over (code, key), a number and a text that breaks
ties. A round sketches the values that may hold the position, counts exactly how many rows lie
below, at and between two values close to it, and keeps the part that holds it. A code with many
rows is searched on by its key, seven bytes at a time. When few rows are left they are sorted.
All cuts, of several orders too, take part in the same passes; a round reads the rows twice and
shuffles a sketch and some counts per task.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one cut that are sorted in the end.
FEW = 5_000
_ACCURACY = 10_000
#: Sketches hold doubles, so codes and pieces of keys stay within 53 bits.
_CHUNK = 6
_LAST = 2**53


def _chunk(key: str, number: int) -> Column:
    """Bytes of a key as a number that sorts as they do."""
    part = F.hex(F.substring(F.col(key).cast("binary"), number * _CHUNK + 1, _CHUNK))
    return F.conv(F.rpad(part, 2 * _CHUNK, "0"), 16, 10).cast("long")


@dataclass
class _Cut:
    order: str
    need: int  # 1-based among the rows that are left
    rows: int
    fixed: list[int] = field(default_factory=list)  # values found, the code first
    low: int | None = None
    high: int | None = None

    def levels(self, key: str) -> list[Column]:
        return [F.col(self.order), *[_chunk(key, k) for k in range(len(self.fixed))]]

    def left(self, key: str) -> Column:
        """The rows that may be the one searched for."""
        levels = self.levels(key)
        held = F.lit(True)
        for level, value in zip(levels, self.fixed):
            held &= level == F.lit(value)
        if self.low is not None:
            held &= levels[-1] >= F.lit(self.low)
        if self.high is not None:
            held &= levels[-1] <= F.lit(self.high)
        return held

    def narrow(self, low: int, high: int, below: int, at_low: int, between: int, at_high: int) -> None:
        """Keep the part that holds the row; a single value is settled."""
        parts = [
            (below, self.low, low - 1), (at_low, low, low), (between, low + 1, high - 1), (at_high, high, high),
            (self.rows - below - at_low - between - at_high, high + 1, self.high),
        ]
        for rows, least, most in parts:
            if self.need <= rows:
                self.rows, self.low, self.high = rows, least, most
                break
            self.need -= rows
        if self.low is not None and self.low == self.high:
            self.fixed.append(self.low)
            self.low = self.high = None


def _round(df: DataFrame, key: str, cuts: list[_Cut]) -> None:
    sketches = []
    for k, cut in enumerate(cuts):
        spot = (cut.need - 0.5) / cut.rows
        around = [max(0.0, spot - 2 / _ACCURACY), min(1.0, spot + 2 / _ACCURACY)]
        value = F.when(cut.left(key), cut.levels(key)[-1])
        sketches.append(F.percentile_approx(value, around, _ACCURACY).alias(f"s{k}"))
    bounds = df.agg(*sketches).first()
    counts = []
    for k, cut in enumerate(cuts):
        low, high = bounds[k]
        held, value = cut.left(key), cut.levels(key)[-1]
        counts += [
            F.count_if(held & (value < low)), F.count_if(held & (value == low)),
            F.count_if(held & (value > low) & (value < high)),
            F.count_if(held & (value == high)) if high > low else F.lit(0),
        ]
    found = df.agg(*[c.alias(f"c{k}") for k, c in enumerate(counts)]).first()
    for k, cut in enumerate(cuts):
        cut.narrow(*bounds[k], *found[4 * k : 4 * k + 4])


def rows_at(df: DataFrame, positions: Mapping[str, list[int]], key: str, rows: int) -> dict[str, list[tuple]]:
    """(code, key) of the row at each 1-based position, for every order.

    `df` is read several times and must not change; orders are names of bigint columns without
    nulls, and `key` tells all rows apart.
    """
    cuts = {(o, p): _Cut(o, p, rows) for o, at in positions.items() for p in at}
    while True:
        open_ = [c for c in cuts.values() if c.rows > FEW]
        if not open_:
            break
        _round(df, key, open_)
    named = list(cuts)
    marks = F.array(*[F.when(cuts[n].left(key), F.lit(k)) for k, n in enumerate(named)])
    left = df.select(key, *positions, F.explode(F.array_compact(marks)).alias("cut")) if named else None
    held: dict[int, list[tuple]] = {}
    for row in left.collect() if named else []:
        held.setdefault(row["cut"], []).append((row[named[row["cut"]][0]], row[key]))
    by_bytes = lambda r: (r[0], r[1].encode())
    found = {n: sorted(held[k], key=by_bytes)[cuts[n].need - 1] for k, n in enumerate(named)}
    return {o: [found[o, p] for p in at] for o, at in positions.items()}


def _ends(rows: int, tiles: int) -> list[int]:
    """The last position of every tile but the last one."""
    small, larger = divmod(rows, tiles)
    ends = [k * small + min(k, larger) for k in range(1, tiles)]
    return [e for e in ends if 0 < e < rows]


def ntiles(df: DataFrame, orders: Mapping[str, Column], key: str, tiles: int) -> DataFrame:
    """A column with ntile(tiles) for each order, by a bigint (nulls last) and then the text `key`.

    The bigints must be less than 2**53 in size.
    """
    codes = {f"_code_{name}": F.coalesce(code.cast("long"), F.lit(_LAST)) for name, code in orders.items()}
    coded = df.withColumns(codes)
    narrow = coded.select(key, *codes)
    rows = narrow.count()
    cuts = rows_at(narrow, {c: sorted(set(_ends(rows, tiles))) for c in codes}, key, rows)
    ends = _ends(rows, tiles)

    def tile(code: str) -> Column:
        out = F.lit(1)
        at = dict(zip(sorted(set(ends)), cuts[code]))
        for end in ends:
            value, last = at[end]
            behind = (F.col(code) > F.lit(value)) | ((F.col(code) == F.lit(value)) & (F.col(key) > F.lit(last)))
            out = out + behind.cast("int")
        return out

    return coded.withColumns({name: tile(f"_code_{name}") for name in orders}).drop(*codes)
