"""Zones of a text: lines by kind, blocks of lines of one kind, and zones given as spans of characters."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from commlens.functions.headers import let, text

# The keys that begin a header line, and the separators above quoted headers.
HEADER_LINE = r"(?i)^[> \t]*(from|to|cc|bcc|sent|date|subject|von|an|gesendet|betreff|reply-to|sent by)[ \t]*:"
SEPARATOR = r"(?i)^[> \t]*([-_]{2,}.*(original message|forwarded by|reply separator|nachricht).*|begin forwarded message:.*)$"
QUOTED = r"^[ \t]*>"


def line_zones(c: Column) -> Column:
    """array<string>, a zone for each line: header, body or blank.

    Two zones and a state: a key or a separator begins or continues a header; a line that is indented below a header
    line continues it (a wrapped address list); any other line is body.
    """
    def own(x: Column) -> Column:
        kind = F.when(F.trim(F.regexp_replace(x, QUOTED, "")) == "", " ").when(F.regexp_like(x, F.lit(HEADER_LINE)) | F.regexp_like(x, F.lit(SEPARATOR)), "h")
        return kind.when(F.regexp_like(x, F.lit(r"^[> ]*[ \t]+\S")), "m").otherwise("b")

    # A letter for each line; an m (more) that follows an h, or an m that has just become one, becomes an h: linear in the lines.
    letters = F.array_join(F.transform(F.split(text(c), "\n"), own), "")
    told = F.translate(F.regexp_replace(letters, r"(?:(?<=h)|\G(?!^))m", "h"), "m", "b")
    names = F.create_map(*map(F.lit, ("h", "header", "b", "body", " ", "blank")))
    return F.transform(F.regexp_extract_all(told, F.lit("(.)"), F.lit(0)), lambda k: F.element_at(names, k))


def runs(zones: Column) -> Column:
    """array<struct<kind, first_line, n_lines>>: the maximal runs of one zone, in order (gaps and islands within the row)."""

    def of(z: Column) -> Column:
        starts = F.filter(F.transform(z, lambda _, i: i), lambda i: (i == 0) | (F.get(z, i) != F.get(z, i - 1)))
        return let(starts, lambda s: F.transform(s, lambda a, i: F.struct(F.get(z, a).alias("kind"), a.cast("long").alias("first_line"), (F.coalesce(F.get(s, i + 1), F.size(z)) - a).cast("long").alias("n_lines"))))

    return let(zones, of)


def overlap_zones(c: Column, spans: list[tuple[str, Column, Column]], default: str) -> Column:
    """array<string>: for each line the name of the span (name, first character, end) that it shares most characters with.

    A line includes its line end.  Ties go to the first span in the list; a line that no span touches is ``default``.
    In Arrow batches, as native arrays have no running sum that is linear in the lines.
    """
    names = [name for name, *_ in spans]

    @F.arrow_udf("array<string>")
    def zones(texts: pa.Array, *bounds: pa.Array) -> pa.Array:
        lines = pc.split_pattern(texts, "\n")
        count = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
        size = pc.utf8_length(lines.flatten()).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        row, end = np.cumsum(count) - count, np.cumsum(size)
        end -= np.repeat((end - size)[row], count)
        low, high = ([np.repeat(b.to_numpy(zero_copy_only=False).astype(np.int64), count) for b in bounds[k::2]] for k in (0, 1))
        shared = np.array([np.minimum(end, h) - np.maximum(end - size, lo) for lo, h in zip(low, high, strict=True)])
        best = np.where(shared.max(axis=0) > 0, shared.argmax(axis=0), len(names))
        return pa.ListArray.from_arrays(pa.array(np.append(row, len(size)), pa.int32()), pa.array([*names, default]).take(pa.array(best)))

    return zones(text(c), *[b.cast("long") for _, *ends in spans for b in ends])
