"""Exact selection by rank without sorting a table: samples, splits, quantiles and thresholds.

The usual ways (a global sort, ``limit``, ``percentile``) send all candidates to one task. Here a table is scanned
twice, whatever its size. The first scan tells where about the wanted rank lies: for values a mergeable quantile
sketch brackets it, for hashes, which are spread evenly, the row count does. The second one counts exactly: rows below
the bracket end up in one group per task, those within it in a group per value. The rank is found among these groups
alone, and what remains is one comparison per row. Should a bracket miss the rank, which the counts show, it is widened.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.functions.portable import hash_hex, known
from martkit.sources.layers import stored

HEX_STEP = 3  # hexadecimal digits looked at per pass: 4096 buckets
SMALL = 5_000  # rows of the last bucket that may be listed
BINS = 2_048  # buckets per pass over numbers
ACCURACY = 10_000  # the sketch misses a rank by at most this part of the rows
DEVIATIONS = 6  # half the width of a bracket of hashes, in standard deviations of the count below a hash


class HashCut(NamedTuple):
    """Place in hash order that separates the first rows from the rest."""

    total: int
    size: int
    hash: str | None
    key: str | None

    def below(self, key: str, seed: int | str) -> Column:
        """Condition for the rows up to the cut."""
        if self.hash is None:
            return F.lit(self.size > 0)
        h = hash_hex(key, seed)
        at_cut = (h == self.hash) & (F.col(key).cast("string") <= F.lit(self.key))
        return (h < self.hash) | at_cut


def _counted(df: DataFrame, key: str) -> tuple[int, int]:
    """Number of rows and of rows with a key, in one scan."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count(F.col(key)).alias("keys")).first()
    return row["n"], row["keys"]


def _digits(share: float) -> str:
    """What hashes are compared with so that this share of them lies below."""
    if share <= 0:
        return ""
    return f"{int(share * 2**52):013x}" if share < 1 else "g"


def hash_cut(df: DataFrame, key: str, seed: int | str, size: Callable[[int], int]) -> HashCut:
    """Find the cut after ``size(total)`` rows in hash order of a unique key, in two scans.

    How many rows lie below a hash is known to within a few standard deviations, so the second scan keeps only a window
    of hashes around the cut, whose rows grow with the root of the table's. A window of more than SMALL rows is stored.
    """
    total, keys = _counted(df, key)
    if keys < total:
        raise ValueError(f"{key} has nulls, so the rows have no order to cut at")
    want = size(total)
    if want <= 0 or want >= total:
        return HashCut(total, max(0, min(want, total)), None, None)
    places = df.select(hash_hex(key, seed).alias("h"), F.col(key).cast("string").alias("k"))
    spread = DEVIATIONS * math.sqrt(want * (total - want) / total) + 16
    while True:
        low, high = _digits((want - spread) / total), _digits((want + spread) / total)
        inside = F.col("h") >= low
        window = places.filter(F.col("h") < high).select(*[F.when(inside, F.col(c)).alias(c) for c in ("h", "k")])
        groups = window.groupBy("h", "k").agg(F.count(F.lit(1)).alias("n"))
        if 2 * spread > SMALL:
            groups = stored(groups, "window")
            below, within = groups.agg(F.sum(F.when(F.col("h").isNull(), F.col("n"))), F.sum(F.when(F.col("h").isNotNull(), F.col("n")))).first()
            below, left = below or 0, want - (below or 0)
            if 0 < left <= (within or 0):
                rows, left = _around(groups.filter("h IS NOT NULL"), left)
                break
        else:
            rows = groups.collect()
            left = want - sum(r["n"] for r in rows if r["h"] is None)
            rows = [r for r in rows if r["h"] is not None]
            if 0 < left <= sum(r["n"] for r in rows):
                break
        spread *= 8
    for row in sorted(rows, key=lambda r: (r["h"], r["k"])):
        if left <= row["n"]:
            break
        left -= row["n"]
    if left < row["n"]:
        raise ValueError(f"{key} is not unique, so the rows have no order to cut at")
    return HashCut(total, want, row["h"], row["k"])


def _around(groups: DataFrame, left: int) -> tuple[list, int]:
    """Of stored groups (h, k, n) the few in whose range the row number ``left`` in hash order is, and its number there."""
    prefix = ""
    while True:
        inside = groups.filter(F.col("h").startswith(prefix)) if prefix else groups
        counts = inside.groupBy(F.substring("h", 1, len(prefix) + HEX_STEP).alias("p"))
        for prefix, rows, listed in sorted(counts.agg(F.sum("n"), F.count(F.lit(1))).collect()):
            if rows >= left:
                break
            left -= rows
        if listed <= SMALL or len(prefix) >= 32:
            return groups.filter(F.col("h").startswith(prefix)).collect(), left


def sample_n(df: DataFrame, n: int, key: str, seed: int | str = 42) -> DataFrame:
    """Exactly n rows chosen by the hash of a unique key; all rows if there are no more than n.

    Two scans at any size: one counts, the next stores the rows below a hash that hardly more than n rows pass, and
    the exact cut is looked for among these. Should fewer than n pass, the rate is doubled.
    """
    total, keys = _counted(df, key)
    if total <= n:
        return df
    if n <= 0:
        return df.limit(0)
    if keys < total:
        raise ValueError(f"{key} has nulls, so the rows have no order to cut at")
    share = (n + DEVIATIONS * math.sqrt(n) + 16) / total
    while share < 1.0:
        few = stored(df.filter(hash_hex(key, seed) < _digits(share)), "sample")
        if few.count() >= n:
            return few.filter(hash_cut(few, key, seed, lambda _: n).below(key, seed))
        share *= 2
    return df.filter(hash_cut(df, key, seed, lambda _: n).below(key, seed))


class Split(NamedTuple):
    """``in_test`` tells the parts apart in one scan of the rows that were split."""

    train: DataFrame
    test: DataFrame
    n_train: int
    n_test: int
    in_test: Column


def split(df: DataFrame, key: str, test_share: float = 0.2, seed: int | str = 42) -> Split:
    """Split into train and test; test has exactly ceil(test_share * rows) rows."""
    cut = hash_cut(df, key, seed, lambda total: math.ceil(test_share * total))
    in_test = cut.below(key, seed)
    return Split(df.filter(~in_test), df.filter(in_test), cut.total - cut.size, cut.size, in_test)


class _Search:
    """What is known so far about one wanted quantile: its rank lies within [low, high]."""

    def __init__(self, low: float, high: float, n: int, q: float):
        place = q * (n - 1)
        self.low, self.high, self.inside, self.after = low, high, n, high
        self.rank, self.share = math.floor(place), place - math.floor(place)

    @property
    def open(self) -> bool:
        return self.low < self.high

    def bracket(self, low: float, high: float, below: int, inside: int, after: float | None) -> bool:
        """Move to [low, high] if the rank is there; ``after`` is the smallest value above it."""
        if not below <= self.rank < below + inside:
            return False
        self.rank -= below
        self.low, self.high, self.inside = low, high, inside
        if after is not None:
            self.after = after
        return True

    def narrow(self, buckets: list) -> None:
        """Move to the bucket that holds the rank; buckets come as (count, low, high) in order."""
        for i, (count, low, high) in enumerate(buckets):
            if self.rank < count:
                break
            self.rank -= count
        if i + 1 < len(buckets):
            self.after = buckets[i + 1][1]
        self.low, self.high, self.inside = low, high, count

    def value(self) -> float:
        following = self.low if self.rank + 1 < self.inside else self.after
        return self.low + (following - self.low) * self.share


def exact_quantiles(df: DataFrame, wanted: dict[str, float]) -> dict[str, float | None]:
    """Quantile of the non-missing values of each column, ``{column: q}``, interpolated linearly, in two scans.

    All columns share the scans. A sketch brackets each rank between two values about 6 / ACCURACY of the rows apart; the
    second scan counts what lies below and groups what lies between by value, so a value that most rows hold is one group.
    Brackets of more than SMALL rows are stored and divided further.
    """
    names = list(wanted)
    floats = df.select(*[known(F.col(c).cast("double")).alias(c) for c in names])
    margin = 3 / ACCURACY
    sketches = []
    for i, (name, q) in enumerate(wanted.items()):
        column, around = F.col(f"`{name}`"), [max(0.0, q - margin), min(1.0, q + margin)]
        ends = F.percentile_approx(column, around, F.lit(ACCURACY))
        sketches.append(F.struct(F.count(column).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"), ends.alias("ends")).alias(f"s{i}"))
    found = dict(zip(names, floats.agg(*sketches).first(), strict=True))
    searches = {c: _Search(s["low"], s["high"], s["n"], wanted[c]) for c, s in found.items() if s["n"]}
    brackets = {c: tuple(found[c]["ends"]) if s.inside > SMALL else (s.low, s.high) for c, s in searches.items() if s.open}
    if brackets:
        values = floats.unpivot([], names, "name", "x").filter(F.col("x").isNotNull())
        _bracketed(values, searches, brackets)
    return {name: searches[name].value() if name in searches else None for name in names}


def _bracketed(values: DataFrame, searches: dict[str, _Search], brackets: dict[str, tuple[float, float]]) -> None:
    """Finish each search within its bracket; where the bracket misses the rank, from all values."""
    side, some = F.lit(None).cast("int"), F.lit(False)
    for name, (low, high) in brackets.items():
        x, mine = F.col("x"), F.col("name") == name
        side = F.when(mine, F.when(x < low, -1).when(x > high, 1).otherwise(0)).otherwise(side)
        some = some | mine
    sided = values.filter(some).withColumn("side", side)
    groups = sided.groupBy("name", "side", F.when(F.col("side") == 0, F.col("x")).alias("x"))
    groups = groups.agg(F.count("side").alias("n"), F.min(F.when(F.col("side") == 1, F.col("x"))).alias("after"))
    large = max(6 / ACCURACY * searches[c].inside if searches[c].inside > SMALL else 0 for c in brackets) > SMALL
    if large:
        groups = stored(groups, "brackets")
        sums = groups.groupBy("name", "side").agg(F.sum("n").alias("n"), F.min("after").alias("after")).collect()
    else:
        listed = groups.collect()
        sums = listed
    missed = {}
    for name, (low, high) in brackets.items():
        mine = [r for r in sums if r["name"] == name]
        n = {side: sum(r["n"] for r in mine if r["side"] == side) for side in (-1, 0)}
        after = next((r["after"] for r in mine if r["side"] == 1), None)
        if not searches[name].bracket(low, high, n[-1], n[0], after):
            missed[name] = searches[name]
        elif not large:
            inside = sorted((r["x"], r["n"]) for r in mine if r["side"] == 0)
            searches[name].narrow([(n, x, x) for x, n in inside])
    if large:
        within = {c: searches[c] for c in brackets if c not in missed}
        _divided(groups.filter("side = 0").select("name", "x", "n"), within)
    _divided(values.withColumn("n", F.lit(1).cast("bigint")), missed)


def _divided(values: DataFrame, searches: dict[str, _Search]) -> None:
    """Narrow searches to one value each, in rows (name, x, n).

    Each pass divides the range left for a column into equal buckets and counts them; no bucket holds both ends of the
    range, so it shrinks until few rows or one value are left. Infinite values are buckets of their own, and a range that
    can't be divided equally is halved, so the number of passes doesn't grow with the number of values.
    """

    def within(some: dict[str, _Search]) -> DataFrame:
        condition = F.lit(False)
        for name, s in some.items():
            condition = condition | ((F.col("name") == name) & F.col("x").between(s.low, s.high))
        return values.filter(condition)

    while large := {c: s for c, s in searches.items() if s.open and s.inside > SMALL}:
        place = F.lit(None).cast("double")
        for name, s in large.items():
            x, width = F.col("x"), (s.high - s.low) / BINS
            if math.isinf(s.low) or math.isinf(s.high):
                offset = F.when(x == -math.inf, 0.0).when(x < math.inf, 1.0).otherwise(2.0)
            elif 0 < width < math.inf:
                offset = F.when(x < s.high, (x - s.low) / width).otherwise(BINS - 1.0)
            else:  # too long or too short for equal buckets
                middle = s.low / 2 + s.high / 2
                middle = middle if s.low < middle < s.high else s.high
                offset = F.when(x < middle, 0.0).otherwise(1.0)
            place = F.when(F.col("name") == name, offset).otherwise(place)
        counts = (
            within(large)
            .groupBy("name", F.least(F.floor(place), F.lit(BINS - 1)).alias("bucket"))
            .agg(F.sum("n").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
            .collect()
        )
        for name, s in large.items():
            mine = sorted((r["bucket"], r["n"], r["low"], r["high"]) for r in counts if r["name"] == name)
            s.narrow([row[1:] for row in mine])
    if small := {c: s for c, s in searches.items() if s.open}:
        listed = within(small).collect()  # at most SMALL values per column
        for name, s in small.items():
            s.narrow([(n, x, x) for x, n in sorted((r["x"], r["n"]) for r in listed if r["name"] == name)])


def exact_quantile(df: DataFrame, column: str, q: float) -> float | None:
    """One quantile; None if the column holds no value."""
    return exact_quantiles(df, {column: q})[column]


def split_points(df: DataFrame, columns: Sequence[str], bins: int) -> tuple[int, dict[str, list[float]]]:
    """Number of rows, and up to ``bins`` - 1 thresholds of each column, from the counts of all its values.

    A column of at most ``bins`` values is cut between any two of them. Otherwise threshold k is before the first value, after
    threshold k - 1, with a middle rank above k / ``bins`` of the rows: MLlib's rule, which it applies to a sample of rows.
    Values are dealt by range and ranked within their part. What reaches the driver are sums of each part, the first
    values of a part, where a threshold may be due from earlier ones, and the values that get a threshold.
    """
    names = list(columns)
    floats = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    values = floats.unpivot([], names, "name", "x").groupBy("name", "x").agg(F.count(F.lit(1)).alias("n"))
    values = stored(values.repartitionByRange("name", "x").withColumn("part", F.spark_partition_id()), "values")
    sums = values.groupBy("name", "part").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("values"), F.max("x").alias("last")).collect()
    rows = {c: sum(r["n"] for r in sums if r["name"] == c) for c in names}
    different = {c: sum(r["values"] for r in sums if r["name"] == c) for c in names}
    total = max(rows.values())
    bins = max(1, min(bins, total))
    starts, below, last = [], dict.fromkeys(names, 0), dict.fromkeys(names)
    for r in sorted(sums, key=lambda r: (r["name"], r["part"])):
        starts.append((r["name"], r["part"], below[r["name"]], last[r["name"]]))
        below[r["name"]] += r["n"]
        last[r["name"]] = r["last"]
    parts = df.sparkSession.createDataFrame(starts, "name string, part int, below bigint, last double")
    place = Window.partitionBy("name", "part").orderBy("x")
    upto = F.col("below") + F.sum("n").over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = values.join(parts, ["name", "part"]).select(
        "name", "part", "x", "n", upto.alias("upto"), F.row_number().over(place).alias("row"), F.coalesce(F.lag("x").over(place), "last").alias("before")
    )
    # Thresholds due by the middle rank of a value, and the fewest that can be placed before it, as each value gets one at most.
    ranked = ranked.withColumn("due", F.expr(f"({bins} * (2 * upto - n) - 1) div {2 * max(1, total)}L"))
    placed = F.min(F.col("due") - F.col("row")).over(place.rowsBetween(Window.unboundedPreceding, -1)) + F.col("row") - 1
    wanted = ranked.withColumn("placed", placed).filter((F.col("row") <= bins) | (F.col("placed") < F.col("due")))
    points: dict[str, list[float]] = {c: [] for c in names}
    for r in sorted(wanted.select("name", "part", "row", "x", "before", "due").collect(), key=lambda r: (r["part"], r["row"])):
        cuts = points[r["name"]]
        if r["before"] is not None and (different[r["name"]] <= bins or len(cuts) < r["due"]):
            cuts.append((r["before"] + r["x"]) / 2)
    return total, {c: sorted({cut for cut in cuts if cut < sys.float_info.max}) for c, cuts in points.items()}
