"""Text structure as higher-order expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.functions.arrays import let, walk


def record(**fields: Column) -> Column:
    """A struct whose field names hold wherever it is used, also inside lambdas."""
    return F.named_struct(*[x for name, value in fields.items() for x in (F.lit(name), value)])


def strip(c: Column) -> Column:
    """Without any Unicode white space at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Every run of Unicode white space as one space."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def is_heading(line: Column) -> Column:
    return F.startswith(strip(line), F.lit("#"))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def split_by_structure(text: Column, chunk_size: int = 800, heading_size: int = 200) -> Column:
    """Chunks of a Markdown text, in order.

    A heading starts a new chunk once the current one is longer than
    heading_size.  Any other line, or a heading before that, is added; if the
    chunk is then longer than chunk_size and the line blank, the chunk ends
    without that line.  Lengths count each line's break.
    """
    none = F.array().cast("array<struct<first:int,end:int,next:int>>")

    def step(s, line):
        # a chunk without lines has size 0
        before = is_heading(line) & (s["size"] > heading_size) & (s["size"] > 0)
        after = ~before & (s["size"] + F.length(line) + 1 > chunk_size) & (strip(line) == "")
        following = F.when(before, s["at"]).otherwise(s["at"] + 1)
        state = record(
            at=s["at"] + 1,
            first=F.when(before | after, following).otherwise(s["first"]),
            size=F.when(before, F.length(line) + 1).when(after, F.lit(0)).otherwise(s["size"] + F.length(line) + 1),
        )
        return state, F.when(before | after, F.array(record(first=s["first"], end=s["at"], next=following))).otherwise(none)

    def joined(lines):
        def whole(cuts):
            rest = F.coalesce(F.get(cuts, F.size(cuts) - 1)["next"], F.lit(0))
            last = F.when(rest < F.size(lines), F.array(record(first=rest, end=F.size(lines), next=F.size(lines)))).otherwise(none)
            return F.transform(F.concat(cuts, last), lambda c: F.array_join(F.slice(lines, c["first"] + 1, c["end"] - c["first"]), "\n"))

        return let(walk(lines, record(at=F.lit(0), first=F.lit(0), size=F.lit(0)), "struct<first:int,end:int,next:int>", step), whole)

    return F.when(text.isNotNull(), let(lines_of(text), joined))


def headings(text: Column) -> Column:
    """array<struct<offset,level,title,path>> of the headings; offset counts code points from 0.

    The level is the number of `#` that the line itself begins with, so an
    indented heading has level 0, clears the path and keeps its `#`.
    """
    kind = "struct<offset:int,level:int,title:string,path:string>"
    start = record(at=F.lit(0), stack=F.array().cast("array<struct<level:int,title:string>>"))

    def step(s, line):
        bare = F.regexp_replace(line, "^#+", "")
        level, title = F.length(line) - F.length(bare), strip(bare)
        stack = F.array_append(F.filter(s["stack"], lambda h: h["level"] < level), record(level=level, title=title))
        path = F.array_join(F.transform(stack, lambda h: h["title"]), " > ")
        found = F.array(record(offset=s["at"], level=level, title=title, path=path))
        state = record(at=s["at"] + F.length(line) + 1, stack=F.when(is_heading(line), stack).otherwise(s["stack"]))
        return state, F.when(is_heading(line), found).otherwise(F.array().cast(f"array<{kind}>"))

    return F.when(text.isNotNull(), walk(lines_of(text), start, kind, step))


def default_title(text: Column) -> Column:
    """The first heading of the first 20 lines, else Unknown."""
    first = F.get(F.filter(F.slice(lines_of(text), 1, 20), is_heading), F.lit(0))
    return F.coalesce(strip(F.regexp_replace(first, "^#+", "")), F.lit("Unknown"))


def path_at(found: Column, position: Column, default: Column) -> Column:
    """As-of lookup: the path of the last heading at or before the position."""
    last = let(position, lambda p: F.try_element_at(F.filter(found, lambda h: h["offset"] <= p), F.lit(-1)))
    return F.coalesce(last["path"], default)


def chunk_position(text: Column, chunk: Column, compat: bool = False) -> Column:
    """Where a chunk's first 50 characters stand in the text, from 0; -1 if nowhere.

    compat=True counts in the text with white space collapsed, which can name a
    heading before the chunk's own.
    """
    if compat:
        return F.instr(collapse(text), collapse(strip(F.left(chunk, F.lit(50))))) - 1
    return F.instr(text, F.left(chunk, F.lit(50))) - 1


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays in double precision; null if one is null, of another length or zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (norm > 0), dot(a, b) / norm)
