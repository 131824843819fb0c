"""Hierarchy codes: hex text <-> ``/1/2/`` paths, as native column expressions.

Each label is a prefix code followed by one bit, 1 for ``/`` and 0 for ``.``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the code: prefix, payload bits, first number.
#   01   + 2 bits            0 ..    3
#   100  + 2 bits            4 ..    7
#   101  + 3 bits            8 ..   15
#   110  + 2, 1, 3 bits     16 ..   79   (marker bits 0 and 1 between the groups)
#   1110 + 3, 3, 1, 3 bits  80 .. 1103   (marker bits 0, 0 and 1 between the groups)
LABEL = "(01..|100..|101...|110.{8}|1110.{13})(.)"


def bits(hex_text: Column) -> Column:
    """Hex text as a bit string without trailing zeros; byte by byte, so any length works."""
    octets = F.transform(_pieces(hex_text, ".."), lambda o: F.lpad(F.conv(o, 16, 2), 8, "0"))
    return F.rtrim(F.concat_ws("", octets), F.lit("0"))


def _pieces(value: Column, pattern: str) -> Column:
    """All matches in order; the text is evaluated once, however many there are."""
    return F.regexp_extract_all(value, F.lit(pattern), F.lit(0))


def _number(code: Column) -> Column:
    def part(start: int, length: int) -> Column:
        return F.substr(code, F.lit(start), F.lit(length))

    def plus(value: Column, base: int) -> Column:
        return F.conv(value, 2, 10).cast("int") + F.lit(base)

    return (
        F.when(code.startswith("01"), plus(part(3, 2), 0))
        .when(code.startswith("100"), plus(part(4, 2), 4))
        .when(code.startswith("101"), plus(part(4, 3), 8))
        .when(code.startswith("1110"), plus(F.concat(part(5, 3), part(9, 3), part(13, 1), part(15, 3)), 80))
        .otherwise(plus(F.concat(part(4, 2), part(7, 1), part(9, 3)), 16))
    )


def decode(hex_text: Column) -> Column:
    """Hex text to path; NULL and empty text give the root."""
    steps = F.transform(_pieces(bits(hex_text), LABEL), lambda c: F.concat(
        _number(F.substr(c, F.lit(1), F.length(c) - 1)).cast("string"),
        F.when(c.endswith("0"), F.lit(".")).otherwise(F.lit("/")),
    ))
    return F.concat(F.lit("/"), F.concat_ws("", steps))


def encode(labels: Column) -> Column:
    """An array of label numbers (0 .. 1103) to hex text; the reverse of :func:`decode`."""
    def pad(value: Column, width: int) -> Column:
        return F.lpad(F.bin(value), width, "0")

    def code(n: Column) -> Column:
        mid, wide = pad(n - 16, 6), pad(n - 80, 10)
        return F.concat(
            F.when(n < 4, F.concat(F.lit("01"), pad(n, 2)))
            .when(n < 8, F.concat(F.lit("100"), pad(n - 4, 2)))
            .when(n < 16, F.concat(F.lit("101"), pad(n - 8, 3)))
            .when(n < 80, F.concat(F.lit("110"), F.substring(mid, 1, 2), F.lit("0"),
                                   F.substring(mid, 3, 1), F.lit("1"), F.substring(mid, 4, 3)))
            .otherwise(F.concat(F.lit("1110"), F.substring(wide, 1, 3), F.lit("0"), F.substring(wide, 4, 3),
                                F.lit("0"), F.substring(wide, 7, 1), F.lit("1"), F.substring(wide, 8, 3))),
            F.lit("1"),
        )

    stream = F.concat_ws("", F.transform(labels, lambda n: code(n.cast("long"))))
    # seven zeros fill the last byte; what they leave over makes no full byte
    octets = _pieces(F.concat(stream, F.lit("0" * 7)), ".{8}")
    hexes = F.transform(octets, lambda o: F.lpad(F.conv(o, 2, 16), 2, "0"))
    return F.when(F.size(labels) > 0, F.concat_ws("", hexes))


def labels(path: Column) -> Column:
    """``/1/2/`` as an array of its levels."""
    return F.filter(F.split(path, "/"), lambda x: x != "")


def parent(path: Column) -> Column:
    """The path one level up; NULL for the root."""
    return F.when(path != "/", F.regexp_replace(path, "[^/]+/$", ""))


def ancestors(path: Column) -> Column:
    """Paths of every strict ancestor, the root first."""
    levels = F.regexp_count(path, F.lit("/")) - 1
    between = F.when(levels > 1, F.transform(
        F.sequence(F.lit(2), levels),
        lambda n: F.concat(F.call_function("substring_index", path, F.lit("/"), n), F.lit("/")),
    )).otherwise(F.array().cast("array<string>"))
    return F.when(levels > 0, F.concat(F.array(F.lit("/")), between)).otherwise(F.array().cast("array<string>"))


def with_paths(df: DataFrame, code: str, path: str) -> DataFrame:
    """Replace a hex code column by its decoded path."""
    return df.withColumn(path, decode(F.col(code))).drop(code)


def tree(df: DataFrame, path: str) -> DataFrame:
    """Add depth, parent path and the number of rows below each row.

    Every row names its own ancestors (bounded by its depth), the names are counted with
    map-side combine, and one equi-join brings the counts back: no recursion and no pairs.
    """
    below = (
        df.select(F.explode(ancestors(F.col(path))).alias(path))
        .groupBy(path).agg(F.count("*").alias("descendants"))
    )
    return (
        df.join(below, path, "left")
        .withColumn("depth", F.size(labels(F.col(path))))
        .withColumn("parent_path", parent(F.col(path)))
        .withColumn("descendants", F.coalesce("descendants", F.lit(0).cast("long")))
    )
