"""Exact quantiles of whole-number columns by narrowing ranges, level by level.

Rows are reduced to one stored point per value. The driver keeps a few open ranges of values
(at most two per probability) with the number of rows below each. A level is one job that
reads the points once: points inside open ranges are counted in buckets of equal width, running
totals tell which buckets hold the wanted ranks, and the values found there are the next
open ranges. Ranges start at the least and greatest value of a column, so digits that
all values share cost no level.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.sources.files import stored

#: Buckets of an open range in one level: rows of the running totals, whatever the data.
BUCKET_BITS = 14
PLACES = Decimal("0.000001")


@dataclass(frozen=True)
class Range:
    """Values ``low`` to ``high`` of a column, the rows below them, and the ranks wanted there."""

    name: str
    low: int
    high: int
    before: int
    ranks: tuple[int, ...]

    @property
    def shift(self) -> int:
        """Low bits that values of one bucket may differ in."""
        bits = 0
        while (self.high >> bits) - (self.low >> bits) >= 1 << BUCKET_BITS:
            bits += 1
        return bits


def value_points(df: DataFrame, columns: dict[str, str], weight: str = "1", label: str = "points") -> DataFrame:
    """Stored rows (name, v, n): how many rows of ``df`` have value ``v`` in the column called ``name``.

    All columns are reduced in one pass; a row counts ``weight`` times, NULLs do not count.
    """
    cells = ", ".join(f"struct('{name}' as name, cast({column} as bigint) as v)" for name, column in columns.items())
    values = df.selectExpr(f"inline(array({cells}))", f"cast({weight} as bigint) as w").filter("v is not null")
    return stored(values.groupBy("name", "v").agg(F.sum("w").alias("n")), label)


def values_table(points: DataFrame, columns: str, rows: list[tuple]) -> DataFrame:
    """A few rows of names and whole numbers as literals of the plan."""
    texts = (", ".join(f"'{x}'" if isinstance(x, str) else f"{x}L" for x in row) for row in rows)
    lines = ", ".join(f"({text})" for text in texts)
    return points.sparkSession.sql(f"select * from values {lines} as t({columns})")


def refined(points: DataFrame, ranges: list[Range]) -> DataFrame:
    """Rows (id, rank, before, low, high): where each wanted rank lies; ``points`` are read once.

    The two literal tables have at most two rows per probability.
    """
    listed = [(k, r.name, r.low, r.high, r.low >> r.shift, r.shift, r.before) for k, r in enumerate(ranges)]
    table = values_table(points, "id, range_name, low, high, base, bits, before", listed)
    within = (F.col("name") == F.col("range_name")) & F.col("v").between(F.col("low"), F.col("high"))
    near = points.join(F.broadcast(table), within)
    bucket = F.expr("shiftright(v, cast(bits as int)) - base").alias("bucket")
    counts = near.groupBy("id", "before", bucket).agg(
        F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    upto = "before + sum(n) over (partition by id order by bucket)"
    placed = counts.selectExpr("id", "low", "high", f"{upto} - n as before", f"{upto} as upto")
    ranks = values_table(points, "range_id, rank", [(k, rank) for k, r in enumerate(ranges) for rank in r.ranks])
    hit = placed.join(F.broadcast(ranks), (F.col("id") == F.col("range_id")) & F.expr("rank >= before and rank < upto"))
    return hit.select("id", "rank", "before", "low", "high")


def ranked_values(points: DataFrame, ranges: list[Range]) -> dict[tuple[str, int], int]:
    """The value at each wanted rank of each column; one job per level."""
    found = {}
    while ranges:
        narrowed: dict[tuple, list[int]] = {}
        for r in ranges:
            if r.low == r.high:
                found.update({(r.name, rank): r.low for rank in r.ranks})
        ranges = [r for r in ranges if r.low < r.high]
        for row in refined(points, ranges).collect() if ranges else []:
            narrowed.setdefault((ranges[row.id].name, row.low, row.high, row.before), []).append(row["rank"])
        ranges = [Range(*key, tuple(sorted(ranks))) for key, ranks in narrowed.items()]
    return found


def point_quantiles(points: DataFrame, probabilities: dict[str, tuple[float, ...]]) -> DataFrame:
    """Rows (name, probability, value): quantiles of stored points, interpolated linearly between ranks.

    The levels run when this is called; the result is a few literal rows. Columns without
    values give none.
    """
    ends = points.groupBy("name").agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    # The wanted position is p * (total - 1); values are needed at its floor and its ceiling.
    wanted, ranges = [], []
    for row in ends.collect():
        places = [(p, Decimal(str(p)).quantize(PLACES) * (row.n - 1)) for p in probabilities.get(row["name"], ()) if row.n]
        wanted += [(row["name"], p, place) for p, place in places]
        ranks = {int(place) + up for _, place in places for up in (0, int(place != int(place)))}
        if ranks:
            ranges.append(Range(row["name"], row.low, row.high, 0, tuple(sorted(ranks))))
    values = ranked_values(points, ranges)
    lines = []
    for name, p, place in wanted:
        low, rest = values[name, int(place)], place - int(place)
        high = values[name, int(place) + int(rest != 0)]
        lines.append(
            f"('{name}', cast('{p}' as decimal(8,6)), cast('{low}' as decimal(20,0)), "
            f"cast('{high}' as decimal(20,0)), cast('{rest}' as decimal(7,6)))"
        )
    rows = ", ".join(lines) or "('', cast(0 as decimal(8,6)), cast(0 as decimal(20,0)), cast(0 as decimal(20,0)), cast(0 as decimal(7,6)))"
    table = points.sparkSession.sql(f"select * from values {rows} as t(name, probability, low, high, rest)")
    value = "cast(low + rest * (high - low) as decimal(28,6)) as value"
    return table.filter("name <> ''").selectExpr("name", "probability", value)


def exact_quantiles(df: DataFrame, column: str, probabilities: tuple[float, ...], weight: str = "1") -> DataFrame:
    """Rows (probability, value): exact quantiles of one whole-number column of ``df``."""
    points = value_points(df, {"v": column}, weight)
    return point_quantiles(points, {"v": probabilities}).drop("name")
