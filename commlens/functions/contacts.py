"""Contact data in signatures, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commlens.functions.cleaning import MAIL
from commlens.functions.headers import let, text, title

# A US number, and the words on its line that tell its kind, in the order in which they are tried.
NUMBER = r"(\(?\b[0-9]{3}\)?(?:-|\.|/| {1,2}| - )?[0-9]{3}(?:-|\.|/| {1,2}| - )?[0-9]{4,5}\b)"
KINDS = {"office": r"(off|ph|tel|dir|voice)", "cell": r"(cell|mobile|mob)", "fax": r"(fax|fx|facs|facsimile|facsim)", "home": r"home"}


def phones(c: Column) -> Column:
    """array<struct<kind, number>>: the first number of each line that has one; the kind by the words of the whole line, else office."""
    found = F.transform(F.split(text(c), "\n"), lambda x: F.struct(x.alias("line"), F.regexp_extract(x, NUMBER, 1).alias("number")))

    def one(x: Column) -> Column:
        kind = F.lit("office")
        for k, p in reversed(KINDS.items()):
            kind = F.when(F.regexp_like(x["line"], F.lit(f"(?i){p}")), k).otherwise(kind)
        return F.struct(kind.alias("kind"), x["number"].alias("number"))

    return F.transform(F.filter(found, lambda x: x["number"] != ""), one)


def phones_of(c: Column, kind: str) -> Column:
    return F.array_distinct(F.transform(F.filter(phones(c), lambda p: p["kind"] == kind), lambda p: p["number"]))


def emails(c: Column) -> Column:
    return F.regexp_extract_all(text(c), F.lit(f"({MAIL})"), F.lit(0))


def aliases(signature: Column, address: Column) -> Column:
    """Signature lines that begin with the local part's first three characters, or (first two lines) end with its last three.

    A line is one of letters, digits, _ and the signs from the blank to the full stop; one with a colon (a number, an address) is none.
    """
    local = F.lower(F.substring_index(text(address), "@", 1))
    lines = F.filter(F.transform(F.split(text(signature), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    hit = F.filter(lines, lambda x, i: F.startswith(F.lower(x), F.substring(local, 1, 3)) | ((i < 2) & F.endswith(F.lower(x), F.right(local, F.lit(3)))))
    return F.when(F.length(local) < 3, F.array().cast("array<string>")).otherwise(F.array_distinct(F.filter(hit, lambda x: F.regexp_like(x, F.lit(r"(?U)^[\w -.]*$")))))


def organisation(address: Column, providers: list[str]) -> Column:
    """The second-to-last label of the domain in title case; null for free-mail providers and what has no domain."""
    label = let(F.split(F.substring_index(text(address), "@", -1), r"\."), lambda x: F.lower(F.when(F.size(x) > 1, F.get(x, F.size(x) - 2))))
    return let(label, lambda x: F.when(F.contains(text(address), F.lit("@")) & ~x.isin(*providers), title(x)))


def signature(body: Column, address: Column, name: Column, last: int = 12) -> Column:
    """struct<body, signature>.  A signature starts at a ``--`` line, or at the first of the ``last`` lines that is a closing or the sender's own name."""
    lines = F.split(text(body), "\n")
    local = F.regexp_replace(F.lower(F.substring_index(text(address), "@", 1)), r"[^a-z]+", "")
    own = F.lower(F.trim(text(name)))
    from_line = F.greatest(F.size(lines) - last, F.lit(1))
    starts = F.transform(lines, lambda x, i: F.when(
        (i >= from_line) & (
            F.regexp_like(x, F.lit(r"^--\s*$")) | F.regexp_like(F.trim(x), F.lit(r"(?i)^(best|regards|best regards|kind regards|sincerely|thanks|thank you|cheers|yours|viele grüße|mfg|cordialement)[,.! ]*$"))
            | ((F.length(F.trim(x)) > 2) & ((F.lower(F.trim(x)) == own) | (F.regexp_replace(F.lower(x), r"[^a-z]+", "") == local)))
        ), i))
    at = F.array_min(starts)
    cut = F.coalesce(at, F.size(lines))
    return F.struct(F.array_join(F.slice(lines, F.lit(1), cut), "\n").alias("body"), F.array_join(F.slice(lines, cut + 1, F.size(lines)), "\n").alias("signature"))
