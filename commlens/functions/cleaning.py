"""Cleaning of message texts as native expressions; null counts as the empty string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commlens.functions.headers import text

# Patterns, in the common subset of the regular-expression dialects.
URL = r"(?i)(https?://|www\.)[^\s<>\"]+"
MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(\+?[0-9]{1,2}[ .-]{1,2})?(\([0-9]{3}\)|[0-9]{3})[ ./-]{1,2}[0-9]{3}[ ./-][0-9]{4,5}"
NUMBER = r"[0-9]+([.,][0-9]+)*"
#: What a text must have for a pattern to match at all.
NEEDS = {
    URL: lambda c: F.contains(c, F.lit("://")) | F.contains(F.lower(c), F.lit("www.")),
    MAIL: lambda c: F.contains(c, F.lit("@")),
}
CURRENCY = r"[$€£¥]"
PUNCTUATION = r"[!\"#%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"
NOISE = [
    r"(?im)^[ \t]*-{2,}[ \t]*(original message|forwarded by|forwarded message|reply separator|inline attachment follows)[^\n]*$",
    r"(?im)^[ \t>]*(from|to|cc|bcc|subject|date|sent|sent by|reply-to|importance|von|an|gesendet|betreff)[ \t]*:[^\n]*$",
    r"(?im)^[ \t]*x-[a-z-]+:[^\n]*$",
    r"(?im)^[ \t]*(content-type|content-transfer-encoding|mime-version|message-id):[^\n]*$",
    r"(?im)^[ \t]*on [^\n]* wrote:[ \t]*$",
    r"(?m)^[ \t]*[-_=*]{5,}[ \t]*$",
    r"(?m)^[> ]*>",
]
ATTACHMENT_NOTICES = [
    r"(?i)\(?see attached file:?[^)\n]*\)?",
    r"<<[^<>\n]*\.[A-Za-z0-9]{2,4}>>",
    r"(?m)^[ \t]*- [^\n]*\.[A-Za-z0-9]{2,4}[ \t]*$",
    r"(?i)\[(image|cid:[^\]\n]*|inline image[^\]\n]*)\]",
]
MOBILE = r"(?im)^[-_ \t]*(sent (from|via|by|using) (my |a )?(blackberry|iphone|ipad|android|mobile|wireless|windows phone|samsung)[^\n]*)$"
FOOTERS = [
    r"(?im)^[-_ \t]*(do you yahoo!\?|get your free[^\n]*(email|e-mail|hotmail)[^\n]*|get free email[^\n]*|join the world's largest e-mail service[^\n]*)[^\n]*$",
    r"(?i)(this (e-?mail|message|communication)|the information (contained )?in this (e-?mail|message))[^\n]{0,200}(confidential|privileged|intended)[\s\S]*$",
]
GREETINGS = ["hi", "hello", "hey", "dear", "hallo", "liebe", "lieber", "guten", "good", "morning", "afternoon", "evening", "all", "everyone", "team", "bonjour", "hola"]
CONTRACTIONS = {"won't": "will not", "can't": "cannot", "n't": " not", "'re": " are", "'ve": " have", "'ll": " will", "'m": " am", "'d": " would"}


def drop(c: Column, *patterns: str, by: str = "") -> Column:
    """Patterns that NEEDS names are only run where the text has what they need; what is dropped before adds none of it."""
    c = whole = text(c)
    for p in patterns:
        gone = F.regexp_replace(c, p, by)
        c = F.when(NEEDS[p](whole), gone).otherwise(c) if p in NEEDS else gone
    return c


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def without_headers(c: Column) -> Column:
    return drop(c, *NOISE)


def without_attachment_notices(c: Column) -> Column:
    return drop(c, *ATTACHMENT_NOTICES)


def without_footers(c: Column) -> Column:
    return drop(c, MOBILE, *FOOTERS)


def sent_from_mobile(c: Column) -> Column:
    """true or null, never false."""
    return F.when(F.regexp_like(text(c), F.lit(MOBILE)), F.lit(True))


def strict(c: Column) -> Column:
    """Without links, addresses, phone numbers, numbers, currency and punctuation."""
    return squeezed(drop(c, URL, MAIL, PHONE, NUMBER, CURRENCY, PUNCTUATION, by=" "))


def ascii_only(c: Column) -> Column:
    """Letters with marks become plain ones, contractions are written out, all else beyond ASCII goes."""
    c = F.regexp_replace(F.normalize(text(c), F.lit("NFKD")), r"\p{M}+", "") if hasattr(F, "normalize") else F.translate(text(c), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ", "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY")
    c = F.replace(F.replace(F.replace(c, F.lit("ß"), F.lit("ss")), F.lit("’"), F.lit("'")), F.lit("œ"), F.lit("oe"))
    for short, long in CONTRACTIONS.items():
        c = F.replace(c, F.lit(short), F.lit(long))
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def readable(c: Column) -> Column:
    return ascii_only(without_headers(c))


def phrase_text(c: Column) -> Column:
    return squeezed(F.replace(drop(c, URL, MAIL, PHONE, NUMBER, by=" "), F.lit("|"), F.lit(" ")))


def normalised(c: Column) -> Column:
    """Lower case with placeholders for links, addresses, phone numbers and numbers."""
    c = F.lower(text(c))
    for p, by in ((URL, "REP_URL"), (MAIL, "REP_EMAIL"), (PHONE, "REP_PHONE"), (NUMBER, "REP_NUM")):
        c = F.regexp_replace(c, p, f" {by} ")
    return squeezed(c)


def without_salutation(c: Column) -> Column:
    """Greeting words go from the first line, if there is a second one."""
    c = text(c)
    first = F.substring_index(c, "\n", 1)
    kept = F.array_join(F.filter(F.split(first, " "), lambda w: ~F.lower(F.regexp_replace(w, r"[,!.:]+$", "")).isin(GREETINGS)), " ")
    return F.when(F.contains(c, F.lit("\n")), F.concat(kept, F.substr(c, F.length(first) + 1))).otherwise(c)


# Words without content, for bags of words and phrases.
STOPWORDS = sorted(set("a about after all also am an and any are as at be because been before being below between both but by can could did do does doing down during each few for from further had has have having he her here hers him his how i if in into is it its just me more most my no nor not of off on once only or other our ours out over own same she should so some such than that the their them then there these they this those through to too under until up very was we were what when where which while who whom why will with would you your yours".split()))


#: The one token that stands for all numbers, where they are kept.
NUMBER_TOKEN = "#number"


def bag_of_words(c: Column, names: Column | None = None, numbers: bool = False) -> Column:
    """Lower-case words of three letters and more, without stopwords and parts of the given names; ``numbers``: runs of digits count as one token."""
    words = F.regexp_extract_all(F.lower(drop(c, URL, MAIL, PHONE, by=" ")), F.lit(r"[a-zà-öø-ÿ]+" + ("|[0-9]+" if numbers else "")), F.lit(0))
    if numbers:
        words = F.transform(words, lambda w: F.when(F.substring(w, 1, 1).between("0", "9"), NUMBER_TOKEN).otherwise(w))
    kept = F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(STOPWORDS))  # a hash set
    if names is None:
        return kept
    parts = F.flatten(F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.split(F.lower(n), r"[^a-zà-öø-ÿ]+")))
    return F.filter(kept, lambda w: ~F.array_contains(parts, w))


def lemma(w: Column) -> Column:
    """A small rule stemmer: the shorter of what noun and verb endings leave."""
    noun = F.when(F.length(w) > 4, F.regexp_replace(F.regexp_replace(w, "ies$", "y"), "([^s])s$", "$1")).otherwise(w)
    verb = F.when(F.length(w) > 5, F.regexp_replace(w, "(ing|ed)$", "")).otherwise(w)
    return F.when(F.length(verb) < F.length(noun), verb).otherwise(noun)
