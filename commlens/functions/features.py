"""Feature columns of mails, for classification and clustering; all native."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commlens.functions.cleaning import STOPWORDS
from commlens.functions.headers import let, text

WORD = r"[A-Za-zÀ-ÖØ-öø-ÿ0-9']+"
SENTENCE = r"[.!?]+"


def words(c: Column) -> Column:
    return F.regexp_extract_all(text(c), F.lit(WORD), F.lit(0))


def sentences(c: Column) -> Column:
    return F.filter(F.transform(F.split(text(c), SENTENCE), lambda s: F.trim(s)), lambda s: s != "")


def count_if(a: Column, keep) -> Column:
    return F.size(F.filter(a, keep)).cast("long")


def median(a: Column) -> Column:
    """Median of an array of numbers; 0 of an empty one."""

    def of(s: Column) -> Column:
        n, mid = F.size(s), (F.size(s) / 2).cast("int")
        pair = F.when(n % 2 == 1, F.get(s, mid).cast("double")).otherwise((F.get(s, mid) + F.get(s, mid - 1)) / F.lit(2.0))
        return F.when(n == 0, F.lit(0.0)).otherwise(pair)

    return let(F.array_sort(a), of)


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def recipients(c: Column) -> Column:
    """Addresses of a header field split at semicolons; an empty field counts one."""
    return F.size(F.split(text(c), ";")).cast("long")


def text_features(c: Column) -> dict[str, Column]:
    w, s = words(c), sentences(c)
    n_words, n_sent, n_chars = F.size(w).cast("long"), F.size(s).cast("long"), F.length(text(c)).cast("long")
    longer, longest = count_if(w, lambda x: F.length(x) >= 6), count_if(w, lambda x: F.length(x) > 6)
    ari = F.when((n_words == 0) | (n_sent == 0), F.lit(0.0)).otherwise(4.71 * ratio(n_chars, n_words) + 0.5 * ratio(n_words, n_sent) - 21.43)
    lix = F.when((n_words == 0) | (n_sent == 0), F.lit(0.0)).otherwise(ratio(n_words, n_sent) + 100 * ratio(longest, n_words))
    return {
        "num_sentences": n_sent, "num_words": n_words, "num_chars": n_chars,
        "num_unique_words": F.size(F.array_distinct(F.filter(F.transform(w, F.lower), lambda x: ~x.isin(STOPWORDS)))).cast("long"),
        "median_sentence_length": median(F.transform(s, F.length)), "num_long_words": longer, "ari": ari, "lix": lix,
    }


# What the flags look for, whatever the case of letters.  ``has_css`` needs a brace, which is asked first, as
# its pattern takes long on lines without one.
FLAGS = {
    "is_reply": r"re: ", "is_forward": r"fwd?: ", "has_html_tag": r"<([^\s]+)(\s[^>]*?)?(?<!/)>", "has_css": r"(\#|\.| )[^\n]+\{[^}]+:[^}]+\}",
    "has_unsubscribe": r"(unsubscribe)|(e-?mail.preferences)", "is_noreply": r"(not?-?reply)|(newsletter)|(info)|(notif(i|y)?)", "has_reply_to": r".+",
}
NEEDS = {"has_css": "{", "has_html_tag": "<"}


def flag(c: Column, which: str) -> Column:
    """1 or 0: does a field of a mail (subject, body, whole mail, sender or reply-to address, as the flag is about) hold the pattern?"""
    hit = F.regexp_like(text(c), F.lit("(?i)" + FLAGS[which]))
    return (F.contains(text(c), F.lit(NEEDS[which])) & hit if which in NEEDS else hit).cast("int")


def placeholders(c: Column) -> dict[str, Column]:
    return {f"num_{k.lower()}": F.regexp_count(text(c), F.lit(f"REP_{k}")).cast("long") for k in ("URL", "PHONE", "EMAIL", "NUM")}


def _name_parts(c: Column) -> Column:
    return F.filter(F.split(text(c), r"\s+"), lambda x: x != "")


def names_in_salutation(names: Column, body: Column, part: int) -> Column:
    """Share of the recipients (``names``, split at semicolons) whose first (part 0) or last name (1) stands in the body's first line.

    0 if the body is empty or a recipient has no such part.
    """
    first = F.get(F.split(text(body), r"\r\n|[\n\r\x0B\f]"), F.lit(0))
    own = F.transform(F.split(text(names), ";"), lambda n: F.get(_name_parts(n), F.lit(part)))
    hits = F.aggregate(own, F.lit(0), lambda a, x: a + F.contains(first, x).cast("int"))
    return F.when((text(body) == "") | F.exists(own, lambda x: x.isNull()), F.lit(0.0)).otherwise(ratio(hits, F.size(own)))


def name_in_body(name: Column, body: Column, part: int) -> Column:
    """1 if the sender's first (part 0) or last name (1) stands in the body; 0 also for a sender without such a part."""
    return F.coalesce(F.contains(text(body), F.get(_name_parts(name), F.lit(part))), F.lit(False)).cast("int")


def recipients_amount(to: Column, cc: Column) -> dict[str, Column]:
    """Addresses of both fields, split at commas (an empty field has none), and whether there is just one."""
    n = lambda c: F.when(text(c) == "", F.lit(0)).otherwise(F.size(F.split(c, ",")))
    amount = (n(to) + n(cc)).cast("long")
    return {"recipients_amount": amount, "recipients_is_single": (amount == 1)}


def is_thread(complete: Column, without_headers: Column) -> Column:
    """Did the body shrink when its inline headers were removed?"""
    return F.length(text(complete)) > F.length(text(without_headers))


def time_features(ts: Column) -> dict[str, Column]:
    """weekday 0 = Sunday, 7 = unknown; other unknown parts are -1 and flags 0."""
    day = F.coalesce(F.dayofweek(ts) - 1, F.lit(7))
    hour = F.coalesce(F.hour(ts), F.lit(-1))
    part = lambda c: F.coalesce(c, F.lit(-1))
    out = {
        "weekday": day, "is_weekend": day.isin(0, 6).cast("int"), "is_business_hours": ((hour >= 7) & (hour < 19) & day.between(1, 5)).cast("int"),
        "year": part(F.year(ts) % 100), "month": part(F.month(ts)), "day": part(F.dayofmonth(ts)), "hour": hour,
        "month_part": F.when(F.dayofmonth(ts) <= 3, "beginning").when(F.dayofmonth(ts) <= 27, "middle").when(F.dayofmonth(ts) >= 28, "end"),
    }
    out |= {f"quarter_{q}": (part(F.quarter(ts)) == q).cast("int") for q in range(1, 5)}
    out |= {f"weekday_{d}": (day == d).cast("int") for d in range(7)}
    return out | {f"slot_{h}": ((hour >= h) & (hour < h + 3)).cast("int") for h in range(0, 24, 3)}


def bins(c: Column, name: str, edges: list[int]) -> dict[str, Column]:
    """One-hot bins, each up to and with its edge; the last is open."""
    out, low = {}, None
    for e in [*edges, None]:
        own = (F.lit(True) if low is None else c > low) & (F.lit(True) if e is None else c <= e)
        out[f"{name}_{'over_' + str(low) if e is None else 'to_' + str(e)}"] = F.coalesce(own, F.lit(False)).cast("int")
        low = e
    return out


def domain(address: Column) -> Column:
    return F.when(F.contains(text(address), F.lit("@")), F.substring_index(address, "@", -1)).otherwise("UNKNOWN")


def domains(addresses: Column) -> dict[str, Column]:
    """The different domains, sorted, and the most frequent one (ties: the first in order)."""
    all_ = F.transform(addresses, domain)
    kinds = F.array_sort(F.array_distinct(all_))
    counted = F.transform(kinds, lambda d: F.struct((-F.size(F.filter(all_, lambda x: x == d))).alias("n"), d.alias("d")))
    return {"unique_domains": kinds, "most_frequent_domain": F.array_min(counted)["d"]}


def internal(sender_domain: Column, unique_domains: Column, company: str) -> dict[str, Column]:
    """Is the sender, are all recipients (also none), and so the mail within the company?"""
    s = F.contains(sender_domain, F.lit(company))
    r = F.forall(unique_domains, lambda d: F.contains(d, F.lit(company)))
    return {"sender_internal": s.cast("int"), "recipients_internal": r.cast("int"), "mail_internal": (s & r).cast("int")}


def as_integers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Flags and counts as integers; null stays null."""
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


def as_floats(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def one_hot(df: DataFrame, column: str) -> DataFrame:
    """A 0/1 column ``<column>_<value>`` for each value, in order, instead of the column; null is 0 in all.

    The values (categories, not rows) are gathered with partial aggregation.
    """
    values = sorted(r[0] for r in df.select(F.col(column).cast("string")).where(F.col(column).isNotNull()).distinct().collect())
    return df.withColumns({f"{column}_{v}": F.coalesce(F.col(column).cast("string") == v, F.lit(False)).cast("int") for v in values}).drop(column)


def label_encode(df: DataFrame, column: str) -> DataFrame:
    """The column's values as their numbers in sorted order, from 0; null stays null."""
    values = sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())
    order = F.create_map(*[F.lit(x) for i, v in enumerate(values) for x in (v, i)]) if values else F.create_map()
    return df.withColumn(column, F.try_element_at(order, F.col(column)) if values else F.lit(None).cast("int"))


def drop_containing(df: DataFrame, parts: list[str]) -> DataFrame:
    """Without the columns whose names hold any of ``parts``."""
    return df.drop(*[c for c in df.columns if any(p in c for p in parts)])


def drop_prefixed(df: DataFrame, prefixes: list[str]) -> DataFrame:
    """Without the columns whose names begin with any of ``prefixes`` (as for prediction)."""
    return df.drop(*[c for c in df.columns if c.startswith(tuple(prefixes))])


def append_fields(df: DataFrame, vectors: dict[str, tuple[str, int]]) -> DataFrame:
    """For each prefix a (vector column, size): columns ``<prefix>_0``, ``<prefix>_1``, ... instead of the vector."""
    out = df
    for prefix, (column, size) in vectors.items():
        a = vector_to_array(F.col(column))
        out = out.withColumns({f"{prefix}_{i}": a[i] for i in range(size)}).drop(column)
    return out
