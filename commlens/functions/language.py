"""Language codes by frequent words, and names by capitals; native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commlens.functions.headers import let, text

# Frequent words that tell one language from the others.
WORDS = {
    "de": "der die und den von zu das mit sich des auf für ist nicht ein eine als auch es werden aus bei nach wird".split(),
    "en": "the of and to in that it is was with as on by at from this be are or which you have not".split(),
    "es": "el los las de que y en un una por con del para es como más pero sus le ya".split(),
    "fr": "le les et des est du que dans une pour pas sur qui plus au avec ce il sont nous".split(),
}


def language(c: Column) -> Column:
    """The two-letter code whose words are most frequent (ties: the first in alphabet); ``xx`` if none occurs."""

    def score(w: Column, code: str) -> Column:
        return F.struct((-F.size(F.filter(w, lambda x: x.isin(*WORDS[code])))).alias("n"), F.lit(code).alias("code"))

    best = let(F.split(F.lower(text(c)), r"[^a-zà-öø-ÿ]+"), lambda w: F.least(*[score(w, code) for code in sorted(WORDS)]))
    return let(best, lambda b: F.when(b["n"] == 0, "xx").otherwise(b["code"]))


# Endings and words that tell an entity's class.
PLACES = ["london", "paris", "berlin", "houston", "texas", "germany", "france", "england", "spain", "europe", "asia", "africa", "america", "china", "japan", "india", "new york", "california"]
COMPANY = ["inc", "corp", "ltd", "llc", "gmbh", "ag", "co", "group", "bank", "university"]


def entities(c: Column) -> Column:
    """struct<person, location, organization, miscellaneous>: runs of capitalised words inside a sentence, without repeats, sorted."""
    runs = F.transform(F.regexp_extract_all(text(c), F.lit(r"[A-Z][a-zà-ÿ]+( [A-Z][a-zà-ÿ]+)*"), F.lit(0)), F.lower)
    runs = F.array_sort(F.array_distinct(runs))
    place = lambda x: x.isin(*PLACES)
    firm = lambda x: F.element_at(F.split(x, " "), -1).isin(*COMPANY)
    two = lambda x: F.contains(x, F.lit(" "))
    return F.struct(
        F.filter(runs, lambda x: ~place(x) & ~firm(x) & two(x)).alias("person"), F.filter(runs, place).alias("location"),
        F.filter(runs, lambda x: ~place(x) & firm(x)).alias("organization"), F.filter(runs, lambda x: ~place(x) & ~firm(x) & ~two(x)).alias("miscellaneous"),
    )
