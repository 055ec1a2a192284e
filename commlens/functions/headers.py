"""Mail headers as native expressions: keys and values, names, addresses, recipients, dates.

Every function maps columns to a column and stays inside code generation; null input counts as the empty string.
Patterns avoid look-around and repeated groups, so texts of any length neither overflow a stack nor backtrack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The header keys that are known, longest first where one begins with another.
KEYS = ["reply-to", "sent by", "sender", "sent", "from", "to", "cc", "bcc", "date", "subject", "von", "gesendet", "an", "betreff"]
# The shapes of dates (the weekday's name is taken off before) and the format of each.
TIME, SECONDS, CLOCK = "[0-9]{1,2}:[0-9]{2}", "[0-9]{1,2}:[0-9]{2}:[0-9]{2}", " [AP]M"
DATE_FORMATS = {
    f"[0-9]{{1,2}} [A-Z][a-z]{{2}} [0-9]{{4}} {SECONDS} [+-][0-9]{{4}}": "d MMM yyyy H:mm:ss Z",
    f"[0-9]{{1,2}} [A-Z][a-z]{{2}} [0-9]{{4}} {SECONDS}": "d MMM yyyy H:mm:ss",
    f"[0-9]{{1,2}} [A-Z][a-z]{{2}} [0-9]{{4}} {TIME}": "d MMM yyyy H:mm",
    f"[A-Z][a-z]+ [0-9]{{1,2}}, [0-9]{{4}} {TIME}{CLOCK}": "MMMM d, yyyy h:mm a",
    f"[A-Z][a-z]+ [0-9]{{1,2}}, [0-9]{{4}} {SECONDS}{CLOCK}": "MMMM d, yyyy h:mm:ss a",
    f"[A-Z][a-z]+ [0-9]{{1,2}}, [0-9]{{4}} {TIME}": "MMMM d, yyyy H:mm",
    f"[0-9]{{1,2}} [A-Z][a-z]+ [0-9]{{4}} {TIME}": "d MMMM yyyy H:mm",
    f"[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}} {SECONDS}{CLOCK}": "M/d/yyyy h:mm:ss a",
    f"[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}} {TIME}{CLOCK}": "M/d/yyyy h:mm a",
    f"[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}} {SECONDS}": "M/d/yyyy H:mm:ss",
    f"[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}} {TIME}": "M/d/yyyy H:mm",
    "[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}": "M/d/yyyy",
    f"[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}} {SECONDS}{CLOCK}": "M/d/yy h:mm:ss a",
    f"[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}} {TIME}{CLOCK}": "M/d/yy h:mm a",
    f"[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}} {TIME}": "M/d/yy H:mm",
    "[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}": "M/d/yy",
    f"[0-9]{{1,2}}[.][0-9]{{1,2}}[.][0-9]{{4}} {SECONDS}": "d.M.yyyy H:mm:ss",
    f"[0-9]{{1,2}}[.][0-9]{{1,2}}[.][0-9]{{4}} {TIME}": "d.M.yyyy H:mm",
    f"[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} {SECONDS}": "yyyy-MM-dd H:mm:ss",
    f"[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T{SECONDS}(Z|[+-][0-9]{{2}}:[0-9]{{2}})": "yyyy-MM-dd'T'H:mm:ssXXX",
    "[0-9]{4}-[0-9]{2}-[0-9]{2}": "yyyy-MM-dd",
}
MARK, GAP = "\x01", "\x02"


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def let(c: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` mentions it; keeps the expression tree small."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def prepared(c: Column) -> Column:
    """A header block on one line: what follows the last run of five dashes, quote marks and asterisks taken off."""
    c = F.regexp_replace(text(c), r"(?s)^.*-----", "")
    c = F.regexp_replace(c, r"(?m)^[> ]+", "")
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\s+", " "), r"\*", ""))


def pairs(c: Column) -> Column:
    """array<struct<key, value>> of a prepared header; what stands before the first key has the key ''."""
    marked = F.regexp_replace(c, rf"(?i)(^|\s)({'|'.join(KEYS)}|x-[a-z-]+|mime-version|content-[a-z-]+|message-id)\s?:", f"{MARK}$2{GAP}")

    def pair(x: Column) -> Column:
        keyed = F.contains(x, F.lit(GAP))
        return F.struct(
            F.when(keyed, F.lower(F.substring_index(x, GAP, 1))).otherwise("").alias("key"),
            F.trim(F.when(keyed, F.substring_index(x, GAP, -1)).otherwise(x)).alias("value"),
        )

    return F.filter(F.transform(F.split(marked, MARK), pair), lambda p: (p["key"] != "") | (p["value"] != ""))


def value(kv: Column, *keys: str) -> Column:
    """The first non-empty value of the keys, in the keys' order, else ''."""

    def of(key: str) -> Column:
        return F.nullif(F.get(F.filter(kv, lambda p: p["key"] == key), F.lit(0))["value"], F.lit(""))

    found = [of(k) for k in keys]
    return F.coalesce(*found, F.lit(""))


def email(c: Column) -> Column:
    """The first address, in lower case, else ''."""
    return F.lower(F.regexp_extract(F.regexp_replace(text(c), r"(?i)mailto:|smtp:|[\[\]<>()\"']", " "), r"[^\s,;:]+@[^\s,;:@]+\.[A-Za-z][A-Za-z]+", 0))


def title(c: Column) -> Column:
    """Title case in which every run of letters is capitalised by itself (o'neil -> O'Neil)."""
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(c), F.lit("([a-z]+|[^a-z]+)"), F.lit(0)), F.initcap), "")


def name(c: Column) -> Column:
    """A person's name: without dates, bracketed parts and addresses; "Last, First" turned; else from a dotted local part."""

    def turned(n: Column) -> Column:
        return F.when(F.contains(n, F.lit(",")), F.array_join(F.reverse(F.split(n, r"\s*,\s*")), " ")).otherwise(n)

    def of(own: Column) -> Column:
        n = F.regexp_replace(own, r"[0-9]{1,2}[/.][0-9]{1,2}[/.][0-9]{2,4}.*$", "")
        n = F.regexp_replace(n, r"\[[^\]]*\]|\([^)]*\)|<[^>]*>", "")
        n = F.regexp_replace(n, r"[^\s\"'<(\[]+@[^\s@]+\.[A-Za-z][A-Za-z]+", "")
        n = F.regexp_replace(n, r"[/@].*$", "")
        n = F.trim(F.regexp_replace(n, r"[\"<>]|mailto:|smtp:", ""))
        local = F.regexp_replace(F.regexp_extract(own, r"([A-Za-z]+\.[A-Za-z.]*[A-Za-z])@", 1), r"\.", " ")
        n = let(let(n, turned), lambda x: F.when(F.trim(x) == "", local).otherwise(x))
        return title(F.trim(F.regexp_replace(F.regexp_replace(n, r"[^A-Za-z0-9 .'-]", ""), r" +", " ")))

    return let(text(c), of)


def recipients(c: Column, kind: str) -> Column:
    """array<struct<name, email, type>>: split at semicolons, or at commas outside quotes where there is none; empty ones go."""

    def of(t: Column) -> Column:
        by_comma = F.array_join(F.transform(F.split(t, '"'), lambda x, i: F.when(i % 2 == 0, F.replace(x, F.lit(","), F.lit(";"))).otherwise(x)), '"')
        parts = F.split(F.when(F.contains(t, F.lit(";")), t).otherwise(by_comma), ";")
        return F.filter(F.transform(parts, lambda x: F.struct(name(x).alias("name"), email(x).alias("email"), F.lit(kind).alias("type"))), lambda p: (p["name"] != "") | (p["email"] != ""))

    return let(text(c), of)


def date(c: Column, not_after: str = "2040-01-01 00:00:00") -> Column:
    """A timestamp in UTC, null where no format fits; two-digit years that would lie after ``not_after`` are of the century before."""
    d = F.regexp_replace(text(c), r"\([^)]*\)", "")
    d = F.regexp_replace(d, r"(?i)^\s*(mon|tues?|wed(nes)?|thu(rs)?|fri|sat(ur)?|sun)(day)?[.,]*\s+", "")
    d = F.trim(F.regexp_replace(F.regexp_replace(d, r"(?i)\s(gmt|utc|z)$", " +0000"), r"\s+", " "))
    d = F.regexp_replace(F.regexp_replace(d, "(?i) am$", " AM"), "(?i) pm$", " PM")

    def read(x: Column) -> Column:
        out = None
        for shape, form in DATE_FORMATS.items():
            hit, own = F.regexp_like(x, F.lit(f"^{shape}$")), F.try_to_timestamp(x, F.lit(form))
            out = F.when(hit, own) if out is None else out.when(hit, own)
        return out

    got = let(d, read)
    return let(got, lambda x: F.when(x > F.lit(not_after).cast("timestamp"), x - F.expr("INTERVAL 100 YEAR")).otherwise(x))


def clamped(c: Column, low: str, high: str) -> Column:
    """struct<date, date_changed>: the date within bounds; a missing one stays missing."""
    a, b = F.lit(low).cast("timestamp"), F.lit(high).cast("timestamp")
    return let(c, lambda x: F.struct(F.when(x < a, a).when(x > b, b).otherwise(x).alias("date"), F.coalesce((x < a) | (x > b), F.lit(False)).alias("date_changed")))


def subject(c: Column, strip_marks: bool = False) -> Column:
    return F.trim(F.regexp_replace(text(c), r"(?i)^(\s*(re|aw|fwd?|wg)\s*:)+", "") if strip_marks else text(c))


def header(c: Column, low: str = "1990-01-01 00:00:00", high: str = "2040-01-01 00:00:00", strip_marks: bool = False) -> Column:
    """The header struct (see ``schema.HEADER``) of a header block; names and addresses by ``header_rows``, the date natively."""
    from commlens.functions.header_rows import parsed

    h = parsed(c, strip_marks)
    when = clamped(date(h["said"]), low, high)
    return F.struct(h["sender"].alias("sender"), h["recipients"].alias("recipients"), when["date"].alias("date"), when["date_changed"].alias("date_changed"), h["subject"].alias("subject"))


def native_header(c: Column, low: str = "1990-01-01 00:00:00", high: str = "2040-01-01 00:00:00", strip_marks: bool = False) -> Column:
    """``header`` as one native expression, by which it is tested."""

    def of(kv: Column) -> Column:
        who = F.coalesce(F.nullif(value(kv, "from", "von"), F.lit("")), F.nullif(value(kv, ""), F.lit("")), value(kv, "sender"))
        inline = F.regexp_extract(value(kv, ""), r"[0-9]{1,2}[/.][0-9]{1,2}[/.][0-9]{2,4}.*$", 0)
        said = F.coalesce(F.nullif(value(kv, "date", "sent", "gesendet"), F.lit("")), inline)
        when = clamped(date(said, high), low, high)
        return F.struct(
            let(who, lambda w: F.struct(name(w).alias("name"), email(w).alias("email"))).alias("sender"),
            F.concat(recipients(value(kv, "to", "an"), "to"), recipients(value(kv, "cc"), "cc"), recipients(value(kv, "bcc"), "bcc")).alias("recipients"),
            when.alias("when"), subject(value(kv, "subject", "betreff"), strip_marks).alias("subject"),
        )

    found = let(pairs(prepared(c)), of)
    return let(found, lambda h: F.struct(h["sender"].alias("sender"), h["recipients"].alias("recipients"), h["when"]["date"].alias("date"), h["when"]["date_changed"].alias("date_changed"), h["subject"].alias("subject")))
