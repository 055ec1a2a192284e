"""The header parser of ``headers`` for whole batches: the same rules and patterns, in Python over Arrow.

The native expressions read an address with some fifteen interpreted patterns; here an address that was met lately is
looked up (``KEPT`` of them, by their text).  Classes are spelled out, so that blanks, letters and line ends are those of Java's patterns.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from commlens.functions.headers import KEYS

KEPT = 1 << 16
_ANY, _END = "[^\n\r\x85\u2028\u2029]", "(?=(?:\r\n|[\n\r\x85\u2028\u2029])?\\Z)"
_QUOTES = re.compile("(?:\\A|(?<=[\n\r\x85\u2028\u2029]))[> ]+")
_BLANKS = re.compile(r"[\t\n\x0b\f\r][ \t\n\x0b\f\r]*| [ \t\n\x0b\f\r]+")
_KEY = re.compile(rf" ({'|'.join(KEYS)}|x-[a-z-]+|mime-version|content-[a-z-]+|message-id)\s?:", re.I | re.A)
_INLINE = re.compile(rf"[0-9]{{1,2}}[/.][0-9]{{1,2}}[/.][0-9]{{2,4}}{_ANY}*{_END}")
_BRACKETS = re.compile(r"\[[^\]]*\]|\([^)]*\)|<[^>]*>")
_ADDRESS = re.compile(r"[^\s\"'<(\[]+@[^\s@]+\.[A-Za-z][A-Za-z]+", re.A)
_REST = re.compile(rf"[/@]{_ANY}*{_END}")
_SIGNS = re.compile(r"[\"<>]|mailto:|smtp:")
_LOCAL = re.compile(r"([A-Za-z]+\.[A-Za-z.]*[A-Za-z])@")
_COMMA = re.compile(r"\s*,\s*", re.A)
_OTHER, _MORE = re.compile(r"[^A-Za-z0-9 .'-]"), re.compile(" +")
_MAIL_SIGNS = re.compile(r"mailto:|smtp:|[\[\]<>()\"']", re.I | re.A)
_MAIL = re.compile(r"[^\s,;:]+@[^\s,;:@]+\.[A-Za-z][A-Za-z]+", re.A)
_MARKS = re.compile(r"^(?:\s*(?:re|aw|fwd?|wg)\s*:)+", re.I | re.A)


def once(udf):
    """The function as one that the optimizer must not repeat: it would run again in the filter that it puts below every ``explode``."""
    return udf.asNondeterministic()


CONTACT = pa.struct([("name", pa.string()), ("email", pa.string())])
PARSED = "struct<sender:struct<name:string,email:string>,recipients:array<struct<name:string,email:string,type:string>>,said:string,subject:string>"


def prepared(t: str) -> str:
    i = t.rfind("-----")
    t = _QUOTES.sub("", t[i + 5 :] if i >= 0 else t)
    return _BLANKS.sub(" ", t).replace("*", "").strip(" ")


def pairs(t: str) -> dict[str, str]:
    """The value of each key where it stands first; what stands before the first key has the key ''."""
    pieces = _KEY.sub("\x01\\1\x02", " " + t).split("\x01")
    pieces[0] = pieces[0].removeprefix(" ")
    out: dict[str, str] = {}
    for x in pieces:
        at = x.find("\x02")
        key, value = (x[:at].lower(), x[x.rfind("\x02") + 1 :]) if at >= 0 else ("", x)
        value = value.strip(" ")
        if key or value:
            out.setdefault(key, value)
    return out


def email(t: str) -> str:
    m = _MAIL.search(_MAIL_SIGNS.sub(" ", t)) if "@" in t else None
    return m[0].lower() if m else ""


def name(t: str) -> str:
    n = _ADDRESS.sub("", _BRACKETS.sub("", _INLINE.sub("", t)))
    n = _SIGNS.sub("", _REST.sub("", n)).strip(" ")
    if "," in n:
        n = " ".join(reversed(_COMMA.split(n)))
    if not n.strip(" "):
        m = _LOCAL.search(t)
        n = m[1].replace(".", " ") if m else ""
    return _MORE.sub(" ", _OTHER.sub("", n)).strip(" ").lower().title()


@lru_cache(KEPT)
def contact(t: str) -> tuple[str, str]:
    return name(t), email(t)


def recipients(t: str) -> list[tuple[str, str]]:
    if ";" not in t and "," in t:
        t = '"'.join(x if i % 2 else x.replace(",", ";") for i, x in enumerate(t.split('"')))
    return [c for c in map(contact, t.split(";")) if c[0] or c[1]]


def _value(kv: dict[str, str], *keys: str) -> str:
    return next((v for v in map(kv.get, keys) if v), "")


def sender(t: bytes | None) -> tuple[str, str]:
    kv = pairs(prepared((t or b"").decode("utf-8", "replace")))
    return contact(_value(kv, "from", "von", "", "sender"))


def _sender(texts: pa.Array) -> pa.Array:
    names, mails = zip(*map(sender, texts.to_pylist())) if len(texts) else ((), ())
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(mails, pa.string())], fields=list(CONTACT))


def sender_of(c: Column) -> Column:
    """struct<name, email>: the sender of a header block, where nothing else of the header is wanted."""
    return once(F.arrow_udf(_sender, "struct<name:string,email:string>"))(c.cast("binary"))


def parsed(c: Column, strip_marks: bool = False) -> Column:
    """A ``PARSED`` struct of a header block; ``said`` is the date as it stands there."""

    def run(texts: pa.Array) -> pa.Array:
        who, said, subjects, at, names, mails, kinds = [], [], [], [0], [], [], []
        for t in texts.to_pylist():
            kv = pairs(prepared((t or b"").decode("utf-8", "replace")))
            who.append(contact(_value(kv, "from", "von", "", "sender")))
            inline = _INLINE.search(kv.get("", ""))
            said.append(_value(kv, "date", "sent", "gesendet") or (inline[0] if inline else ""))
            subject = _value(kv, "subject", "betreff")
            subjects.append((_MARKS.sub("", subject) if strip_marks else subject).strip(" "))
            for kind, keys in (("to", ("to", "an")), ("cc", ("cc",)), ("bcc", ("bcc",))):
                text = _value(kv, *keys)
                for n, m in recipients(text) if text else ():
                    names.append(n)
                    mails.append(m)
                    kinds.append(kind)
            at.append(len(names))
        s = pa.string()
        one = pa.StructArray.from_arrays([pa.array([n for n, _ in who], s), pa.array([m for _, m in who], s)], fields=list(CONTACT))
        each = pa.StructArray.from_arrays([pa.array(names, s), pa.array(mails, s), pa.array(kinds, s)], names=["name", "email", "type"])
        to = pa.ListArray.from_arrays(pa.array(at, pa.int32()), each)
        return pa.StructArray.from_arrays([one, to, pa.array(said, s), pa.array(subjects, s)], names=["sender", "recipients", "said", "subject"])

    return F.arrow_udf(run, PARSED)(c.cast("binary"))
