"""XML text columns: one parse per document, then typed fields."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

from pyspark.sql import Column, functions as F, types as T

OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}


#: Stands for the ampersand of an entity while a document is parsed, so that escaped mark-up stays text.
_MARK = "\ue000"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sealed(document: Column) -> Column:
    """The document with entities out of the parser's sight, CDATA as entities, and comments as empty elements."""
    def escaped(inside: Column) -> Column:
        for sign, name in (("&", "amp"), ("<", "lt"), (">", "gt")):
            inside = F.replace(inside, F.lit(sign), F.lit(f"{_MARK}{name};"))
        return inside

    def opened(piece: Column) -> Column:
        return _let(F.locate("]]>", piece), lambda end: F.when(end > 0, F.concat(
            escaped(F.substring(piece, F.lit(1), end - 1)), F.substring(piece, end + 3, F.length(piece)))).otherwise(piece))

    def sections(text: Column) -> Column:
        parts = F.transform(F.split(text, r"<!\[CDATA\["), lambda p, i: F.when(i == 0, p).otherwise(opened(p)))
        return F.when(F.contains(text, F.lit("<![CDATA[")), F.array_join(parts, "")).otherwise(text)

    comment = r"<!--(?:(?!-->)[\s\S])*-->"

    def comments(text: Column) -> Column:
        bare = F.regexp_replace(text, rf"^(\s*(?:<\?[\s\S]*?\?>)?)(?:\s*{comment})+", "$1")
        bare = F.regexp_replace(bare, rf"(?:\s*{comment})+\s*$", "")
        return F.when(F.contains(text, F.lit("<!--")), F.regexp_replace(bare, comment, "<_c/>")).otherwise(text)

    return F.replace(_let(_let(document, sections), comments), F.lit("&"), F.lit(_MARK))


def _opened(text: Column) -> Column:
    """Text with its entities as the characters they stand for; an unknown one stays as it was written."""
    def number(name: Column) -> Column:
        return F.when(F.lower(F.substring(name, 1, 2)) == "#x", F.conv(F.substring(name, 3, 8), 16, 10)).when(
            F.substring(name, 1, 1) == "#", F.substring(name, 2, 8)).try_cast("int")

    def known(name: Column) -> Column:
        spelt = _let(number(name), lambda n: F.when((n > 0) & (n < 0x110000), F.decode(
            F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0")), "UTF-32")))
        return F.when(name == "lt", "<").when(name == "gt", ">").when(name == "amp", "&").when(name == "quot", '"').when(
            name == "apos", "'").otherwise(spelt)

    def one(piece: Column) -> Column:
        name = F.substring_index(piece, ";", 1)
        return _let(F.when(F.contains(piece, F.lit(";")), known(name)), lambda sign: F.when(
            sign.isNull(), F.concat(F.lit("&"), piece)).otherwise(F.concat(sign, F.substring(piece, F.length(name) + 2, F.length(piece)))))

    whole = F.array_join(F.transform(F.split(text, _MARK), lambda p, i: F.when(i == 0, p).otherwise(one(p))), "")
    return F.when(F.contains(text, F.lit(_MARK)), whole).otherwise(text)


def shred(document: Column, schema: str) -> Column:
    """Parse a document once into a struct of its declared fields; a missing element is NULL.

    A field is the first text node of its element, as ``text()[1]`` is in a path: behind nested elements
    and comments a new node begins, escaped mark-up and CDATA belong to the text.
    """
    def leaves(value: Column, kind: T.StructType) -> list[Column]:
        out = []
        for f in kind:
            own = value.getField(f.name)
            out += leaves(own, f.dataType) if isinstance(f.dataType, T.StructType) else [] if isinstance(
                f.dataType, T.ArrayType) else [own]
        return out

    def rebuilt(value: Column, kind: T.StructType, found: Column, at: Iterator[int]) -> Column:
        fields = []
        for f in kind:
            own = value.getField(f.name)
            if isinstance(f.dataType, T.StructType):
                own = rebuilt(own, f.dataType, found, at)
            elif isinstance(f.dataType, T.ArrayType):
                own = elements(own, f.dataType.elementType)
            else:
                own = F.get(found, F.lit(next(at)))
            fields.append(own.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))

    def elements(value: Column, kind: T.DataType) -> Column:
        return F.transform(value, (lambda e: texts(e, kind)) if isinstance(kind, T.StructType) else _text)

    def texts(value: Column, kind: T.StructType) -> Column:
        """All fields of a struct in one array, so the expression for a text stands once in the plan."""
        own = leaves(value, kind)
        if not own:
            return rebuilt(value, kind, F.lit(None), iter(()))
        return _let(F.transform(F.array(*own), _text), lambda found: rebuilt(value, kind, found, count()))

    return _let(F.from_xml(_sealed(document), schema, OPTIONS), lambda parsed: texts(parsed, T.StructType.fromDDL(schema)))


def _text(inner: Column) -> Column:
    return _let(first_text(inner), _opened)


def first_text(inner: Column) -> Column:
    """The first text node among an element's direct children.

    An element read as a string keeps the mark-up of its children.  Cut before every ``<``, its pieces are a
    tag with the text behind it; one pass over them keeps the depth and the first text at depth zero.
    NULL when there is none.
    """
    def next_(state: Column, piece: Column) -> Column:
        def after(tag: Column) -> Column:
            depth = F.when(F.startswith(tag, F.lit("/")), state["depth"] - 1).when(
                F.endswith(tag, F.lit("/")), state["depth"]).otherwise(state["depth"] + 1)
            text = F.nullif(F.substring(piece, F.length(tag) + 2, F.length(piece)), F.lit(""))
            return _let(depth, lambda d: F.struct(d.alias("depth"), F.coalesce(state["text"], F.when(d == 0, text)).alias("text")))
        return _let(F.substring_index(piece, ">", 1), after)

    def mixed(pieces: Column) -> Column:
        start = F.struct(F.lit(0).alias("depth"), F.nullif(F.get(pieces, F.lit(0)), F.lit("")).alias("text"))
        return F.aggregate(F.slice(pieces, 2, F.size(pieces)), start, next_, lambda s: s["text"])

    return _let(inner, lambda text: F.when(F.contains(text, F.lit("<")), _let(F.split(text, "<"), mixed)).otherwise(
        F.nullif(text, F.lit(""))))


def limited(value: Column, width: int) -> Column:
    return F.substring(value, 1, width)


def day(value: Column) -> Column:
    """A date that may carry a zone suffix, such as ``2000-06-01Z``; NULL for any other text."""
    found = F.regexp_extract(F.trim(value), r"^(\d{4}-\d{2}-\d{2})(?:Z|[+-]\d{2}:\d{2})?$", 1)
    return F.nullif(found, F.lit("")).try_cast("date")


def whole(value: Column) -> Column:
    return F.trim(value).try_cast("int")


def truth(value: Column) -> Column:
    return F.trim(value).try_cast("boolean")
