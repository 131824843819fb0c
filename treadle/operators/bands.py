"""Lookup of numbers in very many bands through an index of their ends.

The ends of all bands, sorted and numbered, cut the line into elementary intervals: the ends themselves
and the gaps between them.  A number finds its interval by going down a static search tree whose nodes are
arrays of ends, with a binary search in each: the top node is a literal, lower ones are joined by node
number.  An interval number then meets the bands that cover it by equality.  So the work grows with the
numbers, the bands and the intervals a band covers (three where bands do not overlap), and not with how
many bands lie close together.

Counts and sums per band need no pairs of numbers and bands: with running sums along the ends, a band's
are those up to its high end less those before its low one.  That work grows with numbers and bands alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DecimalType, IntegralType

from treadle.session import run_folder

#: Ends of a node, and the most of them in the top node, which is part of the plan.
NODE, TOP = 4096, 512


def _steps(size: int) -> Column:
    """Strides of a binary search over up to ``size`` ends."""
    return F.array(*[F.lit(1 << k) for k in reversed(range(max(size, 1).bit_length()))])


def _rank(ends: Column, value: Column, size: int) -> Column:
    """How many of the sorted ``ends`` are not above ``value``."""
    def further(at: Column, stride: Column) -> Column:
        return F.when(F.get(ends, at + stride - 1) <= value, at + stride).otherwise(at)
    return F.when(value.isNotNull() & ends.isNotNull(), F.aggregate(_steps(size), F.lit(0), further))


class BandIndex:
    """An index over the ends of ``bands`` (``low <= number <= high``; a NULL high is open)."""

    def __init__(self, spark: SparkSession, bands: DataFrame, low: str, high: str):
        self.spark = spark
        self.bands = bands.filter(F.col(low).isNotNull()).withColumns({"_low": F.col(low), "_high": F.col(high)})
        points = self.bands.select(F.col("_low").alias("p")).unionByName(self.bands.select(F.col("_high").alias("p")))
        self.ends, self.count = self._numbered(points.filter("p is not null").distinct())
        self.levels: list[DataFrame] = []  # from the leaves up: node, ends
        firsts, n = self.ends, self.count
        while n > TOP:
            folder = run_folder(spark, "band-nodes")
            # a node holds a bounded number of ends
            firsts.groupBy(F.floor(F.col("at") / NODE).alias("node")).agg(
                F.sort_array(F.collect_list("p")).alias("ends")).write.parquet(folder)
            nodes = spark.read.parquet(folder)
            self.levels.append(nodes)
            firsts, n = nodes.select(F.col("node").alias("at"), F.col("ends")[0].alias("p")), -(-n // NODE)
        self.top = [r.p for r in firsts.orderBy("at").collect()]  # at most TOP ends

    def _numbered(self, points: DataFrame) -> tuple[DataFrame, int]:
        """``p`` and its place ``at`` among all, from the counts of range partitions."""
        folder = run_folder(self.spark, "band-ends")
        points.repartitionByRange("p").sortWithinPartitions("p").withColumn("_part", F.spark_partition_id()).withColumn(
            "_at", F.monotonically_increasing_id()).write.parquet(folder)
        stored, starts, n = self.spark.read.parquet(folder), [], 0
        for r in stored.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("first")).orderBy("_part").collect():
            starts.append((r["_part"], n - r["first"]))
            n += r.n
        starts = F.broadcast(self.spark.createDataFrame(starts, "_part int, _start long"))
        return stored.join(starts, "_part").select("p", (F.col("_at") + F.col("_start")).alias("at")), n

    def interval(self, df: DataFrame, value: str, name: str) -> DataFrame:
        """``df`` with the interval of a number: twice the place of an end it equals, or one more in the gap behind it."""
        kind = self.ends.schema["p"].dataType
        top = F.array(*[F.lit(p).cast(kind) for p in self.top]) if self.top else F.lit(None).cast(f"array<{kind.simpleString()}>")
        out = df.withColumn(name, _rank(top, F.col(value), len(self.top)).cast("long") - 1)
        last = F.get(top, F.col(name).cast("int"))
        equal = F.when(F.col(name) >= 0, last == F.col(value))
        for depth, nodes in enumerate(reversed(self.levels)):
            leaf = depth == len(self.levels) - 1
            joined = out.join(nodes.select(F.col("node").alias("_node"), "ends"), F.col(name) == F.col("_node"), "left")
            rank = (_rank(F.col("ends"), F.col(value), NODE) - 1).cast("long")
            # below the first end of all: interval -1
            joined = joined.withColumn("_rank", rank)
            if leaf:
                joined = joined.withColumn("_equal", F.get("ends", F.col("_rank").cast("int")) == F.col(value))
            out = joined.withColumn(name, F.when(F.col(name) < 0, F.col(name)).otherwise(F.col(name) * NODE + F.col("_rank"))).drop(
                "_node", "ends", "_rank")
            equal = F.col("_equal") if leaf else equal
        at = F.col(name) * 2 + F.when(F.coalesce(equal, F.lit(False)), 0).otherwise(1)
        return out.withColumn(name, F.when(F.col(name) >= 0, at)).drop("_equal")

    def _placed(self) -> DataFrame:
        """The bands with the places of their ends; those that end before they start are left out."""
        place = self.ends.select(F.col("p"), F.col("at"))
        rows = self.bands.join(place.select(F.col("p").alias("_low"), F.col("at").alias("_from")), "_low").join(
            place.select(F.col("p").alias("_high"), F.col("at").alias("_to")), "_high", "left")
        return rows.filter(F.col("_high").isNull() | (F.col("_to") >= F.col("_from")))

    def covered(self, take: Mapping[str, str]) -> DataFrame:
        """Each band once per interval it covers."""
        rows = self._placed()
        end = F.when(F.col("_high").isNull(), F.lit(2 * self.count)).otherwise(F.col("_to") * 2)
        return rows.select(F.explode(F.sequence(F.col("_from") * 2, end)).alias("_interval"),
                           *[F.col(c).alias(n) for n, c in take.items()])

    def lookup(self, df: DataFrame, value: str, take: Mapping[str, str]) -> DataFrame:
        """Left join each number to the bands it lies in; ``take`` maps new column names to band columns."""
        placed = self.interval(df, value, "_own")
        return placed.join(self.covered(take), F.col("_own") == F.col("_interval"), "left").drop("_own", "_interval")

    def totals(self, df: DataFrame, value: str, take: Mapping[str, str], count: str, sums: Mapping[str, str]) -> DataFrame:
        """What :meth:`lookup` grouped by ``take`` gives: how many numbers, as ``count``, and sums of columns.

        Bands without numbers have no row; numbers without a band are summed under NULL.  ``sums`` maps
        new names to columns of whole numbers or decimals, as running sums of others are not exact.
        """
        kinds = {}
        for name, c in sums.items():
            kind = df.schema[c].dataType
            if not isinstance(kind, (IntegralType, DecimalType)):
                raise TypeError(f"totals of {c} would not be exact: {kind.simpleString()}")
            wide = f"decimal(38,{kind.scale})" if isinstance(kind, DecimalType) else "decimal(38,0)"
            kinds[name] = (wide, df.select(F.sum(c)).schema[0].dataType)
        parts = {"_n": F.count("*"), **{f"_n{i}": F.count(c) for i, c in enumerate(sums.values())},
                 **{f"_s{i}": F.sum(c).cast(kinds[n][0]) for i, (n, c) in enumerate(sums.items())}}
        spark = self.spark

        def stored(rows: DataFrame, label: str) -> DataFrame:
            folder = run_folder(spark, label)
            rows.write.parquet(folder)
            return spark.read.parquet(folder)

        # equal numbers go down the tree as one
        numbers = self.interval(df.groupBy(value).agg(*[c.alias(m) for m, c in parts.items()]), value, "_own")
        even = F.col("_own") % 2 == 0
        each = stored(numbers.groupBy(F.floor(F.col("_own") / 2).alias("at")).agg(
            *[F.sum(F.when(even, F.col(m))).alias(f"on{m}") for m in parts],
            *[F.sum(F.when(~F.coalesce(even, F.lit(False)), F.col(m))).alias(f"off{m}") for m in parts]), "band-numbers")
        each = each.fillna(0, [c for c in each.columns if c != "at"])
        placed = stored(self._placed().select("_from", "_to", *[F.col(c).alias(f"_t{i}") for i, c in enumerate(take.values())]), "band-places")
        none = {f"{side}{m}": F.lit(0).cast(each.schema[f"{side}{m}"].dataType) for side in ("on", "off") for m in parts}
        steps = {name: placed.filter(F.col(end).isNotNull()).groupBy(F.col(end).alias("at")).agg(F.count("*").alias(name))
                 for name, end in (("_opens", "_from"), ("_shuts", "_to"))}
        line = each.filter("at is not null").withColumns({n: F.lit(0).cast("long") for n in steps})
        for name, rows in steps.items():
            line = line.unionByName(rows.withColumns({**none, **{n: F.lit(0).cast("long") for n in steps if n != name}}))
        columns = [*none, *steps]
        line = stored(line.withColumn("_block", F.floor(F.col("at") / NODE)).repartition("_block").groupBy("_block", "at").agg(
            *[F.sum(c).cast(line.schema[c].dataType).alias(c) for c in columns]), "band-line")
        both = [(F.col(f"on{m}") + F.col(f"off{m}")).cast(each.schema[f"on{m}"].dataType).alias(m) for m in parts]
        line = stored(self._before(line.select("at", *none, *steps, *both), [*parts, *steps], self.count), "band-sums")

        # bands over an end, and over the gap behind it
        over = {"on": F.col("_before_opens") + F.col("_opens") - F.col("_before_shuts")}
        over["off"] = over["on"] - F.col("_shuts")
        bare = line.select(*[reduce(Column.__add__, [F.when(over[side] == 0, F.col(f"{side}{m}")).otherwise(0) for side in over]).alias(m)
                             for m in parts]).unionByName(each.filter("at is null").select(*[F.col(f"off{m}").alias(m) for m in parts]))
        low = line.select(F.col("at").alias("_from"), *[F.col(f"_before{m}").alias(f"low{m}") for m in parts])
        high = line.select(F.col("at").alias("_to"), *[(F.col(f"_before{m}") + F.col(f"on{m}")).alias(f"high{m}") for m in parts])
        end = line.agg(*[F.sum(m).alias(f"end{m}") for m in parts])  # one row, for open bands
        found = placed.join(low, "_from").join(high, "_to", "left").join(F.broadcast(end)).select(
            *[F.col(f"_t{i}").alias(n) for i, n in enumerate(take)],
            *[(F.coalesce(f"high{m}", f"end{m}") - F.col(f"low{m}")).alias(m) for m in parts])
        bare = bare.agg(*[F.sum(m).alias(m) for m in parts]).select(
            *[F.lit(None).cast(found.schema[n].dataType).alias(n) for n in take], *parts)
        out = found.unionByName(bare).filter("_n > 0").groupBy(*take).agg(*[F.sum(m).alias(m) for m in parts])
        return out.select(*take, F.col("_n").cast("long").alias(count), *[
            F.when(F.col(f"_n{i}") > 0, F.col(f"_s{i}")).cast(kinds[n][1]).alias(n) for i, n in enumerate(sums)])

    def _before(self, line: DataFrame, columns: Sequence[str], size: int) -> DataFrame:
        """``line``, a row per place ``at`` below ``size``, with the sums of columns over all places before, as ``_before<column>``."""
        earlier = Window.partitionBy("_block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)  # at most NODE rows
        blocked = line.withColumn("_block", F.floor(F.col("at") / NODE))
        own = blocked.withColumns({f"_before{c}": F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast(line.schema[c].dataType) for c in columns})
        if size <= NODE:
            return own.drop("_block")
        folder = run_folder(self.spark, "band-blocks")
        blocked.groupBy(F.col("_block").alias("at")).agg(*[F.sum(c).cast(line.schema[c].dataType).alias(c) for c in columns]).write.parquet(folder)
        blocks = self._before(self.spark.read.parquet(folder), columns, -(-size // NODE)).select(
            F.col("at").alias("_block"), *[F.col(f"_before{c}").alias(f"_all{c}") for c in columns])
        return own.join(blocks, "_block").withColumns(
            {f"_before{c}": (F.col(f"_before{c}") + F.col(f"_all{c}")).cast(line.schema[c].dataType) for c in columns}).drop(
            "_block", *[f"_all{c}" for c in columns])
