"""MIME decoding in Arrow batches over the standard library's mail parser; the one place where mails need Python."""

from __future__ import annotations

import email
import re
from collections.abc import Iterator
from email.header import decode_header, make_header
from functools import cache
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from commlens.functions.header_rows import once

DECODED = "struct<header:string,body:string,attachments:array<string>,defects:int>"
# Fixed value: headers whose name begins with one of these are kept.
KEPT_HEADERS = ("from", "to", "reply-to", "cc", "bcc", "subject", "date", "sent", "sent-by")
EMPTY = "[Empty message]"
TAGS = re.compile(r"<[a-zA-Z][^>]*>[\s\S]*</[a-zA-Z][^>]*>")
BREAKS = {"p", "div", "br", "tr", "li", "table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "hr", "title"}


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "head"):
            self.hidden += 1
        elif tag in BREAKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "head"):
            self.hidden = max(0, self.hidden - 1)
        elif tag in BREAKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(re.sub(r"\s+", " ", data))


def html_text(html: str) -> str:
    """Visible text, a line for each block; links, emphasis and images leave only their text."""
    p = _Text()
    p.feed(html)
    p.close()
    lines = [re.sub(r" +", " ", x).strip() for x in "".join(p.out).split("\n")]
    return "\n".join(x for x in lines if x)


def mended(s: str) -> str:
    """UTF-8 that was read as Windows-1252 is read anew, where that is possible for the whole text."""
    if "Ã" in s or "â€" in s or "Â" in s:
        try:
            return s.encode("cp1252").decode("utf-8")
        except UnicodeError:
            return s
    return s


def decoded_part(part) -> str:
    payload = part.get_payload(decode=True) or b""
    charset = part.get_content_charset()
    try:
        s = payload.decode(charset, "replace") if charset else payload.decode("utf-8")
    except (LookupError, UnicodeDecodeError):
        try:
            s = payload.decode("utf-8")
        except UnicodeDecodeError:
            s = payload.decode("latin-1")
    if re.search(r"=[0-9A-F]{2}", s) and "=\n" in s + "\n":
        s = re.sub(r"=\n", "", re.sub(r"(?:=[0-9A-F]{2})+", lambda m: bytes.fromhex(m[0].replace("=", "")).decode("utf-8", "replace"), s))
    return s


def _words(value: str) -> str:
    try:
        return str(make_header(decode_header(value)))
    except (LookupError, ValueError, UnicodeError):
        return value


def decode(raw: str | None) -> tuple[str, str, list[str], int]:
    """(kept headers as lines, first text body, attachment names, parser defects)."""
    m = email.message_from_bytes((raw or "").encode("utf-8", "surrogateescape"))
    header = "".join(f"{k}: {_words(str(v))}\n" for k, v in m.items() if k.lower().startswith(KEPT_HEADERS))
    body, files = None, []
    for part in m.walk():
        name = part.get_filename()
        if name:
            files.append(_words(name))
        elif body is None and part.get_content_type() in ("text/plain", "text/html"):
            s = decoded_part(part)
            body = html_text(s) if TAGS.search(s) else s
    body = mended(body) if body and body.strip() else EMPTY
    return mended(header), body, files, sum(len(p.defects) for p in m.walk())


def _decoded(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([decode(r) for r in raw], columns=["header", "body", "attachments", "defects"])


def decoded(raw) -> Column:
    """A ``DECODED`` struct of a raw mail; null counts as an empty one."""
    return F.pandas_udf(_decoded, DECODED)(raw)


def _text_of_html(html: pd.Series) -> pd.Series:
    return html.map(lambda h: html_text(h) if h else "")


def text_of_html(html) -> Column:
    return F.pandas_udf(_text_of_html, "string")(html)


PARTS = "array<struct<header:string,body:string>>"
# A kind of inline header: what its first line holds, what line must follow within the next two (or None), and what its last line holds.
_SUBJECT = r"(?:subject|betreff)[ \t]*:"
INLINE = [
    (re.compile(first, re.I), after and re.compile(after, re.I), re.compile(last, re.I))
    for first, after, last in (
        (r"^[> \t]*-{2,}[ \t]*(?:forwarded by|original message|ursprüngliche nachricht|nachricht)", None, _SUBJECT),
        (r"^[> \t]*(?:begin )?forwarded message:", None, r"^[> \t]*to[ \t]*:"),
        (r"^[> \t]*[-_]{2,}[ \t]*reply separator", None, r"^[> \t]*date"),
        (r"^[> \t]*[-_]{2,}[ \t]*reply separator", None, _SUBJECT),
        (r"^[> \t]*(?:from|von)[ \t]*:", None, r"^[> \t]*" + _SUBJECT),
        (r"[0-9]{1,2}[/.][0-9]{1,2}[/.][0-9]{2,4}", r"^[> \t]*to[ \t]*:", r"^[> \t]*" + _SUBJECT),
    )
]
# Survey Y1: the kinds whose whole lines are removed, as case and all are given there.
REMOVED = [
    (re.compile(first), after and re.compile(after), re.compile(last))
    for first, after, last in (
        (r"-{3}.*Forwarded by", None, r"Subject:"),
        (r"Begin forwarded message:", None, r"To:"),
        (r"-{3}.*Original Message", None, r"Subject:"),
        (r"_{3}.*Reply Separator", None, r"Date"),
        (r"\d{2}/\d{2}/\d{2,4}\s\d{2}:\d{2}", r"To: ", r"Subject: "),
        (r"From:", None, r"Subject:"),
    )
]


@cache
def _anywhere(first: re.Pattern) -> re.Pattern:
    """Matches somewhere in every text of which ``first`` matches a line."""
    return re.compile(first.pattern, first.flags | re.M)


def inline_headers(text: str, kinds: list, before: int = 0) -> list[tuple[int, int]]:
    """(start, end) of each header, from the start of its first line to the end of its last, however long it is.

    Line by line, with the next last line of each kind known beforehand: linear in the text.  A kind with a line that
    must follow starts ``before`` lines above its first one.
    """
    kinds = [k for k in kinds if _anywhere(k[0]).search(text)]
    if not kinds:
        return []
    lines = text.split("\n")
    nexts: dict[str, list[int]] = {}
    for _, _, last in kinds:
        if last.pattern not in nexts:
            at = nexts[last.pattern] = [len(lines)] * (len(lines) + 1)
            for i in range(len(lines) - 1, -1, -1):
                at[i] = i if last.search(lines[i]) else at[i + 1]
    starts = [0]
    for x in lines:
        starts.append(starts[-1] + len(x) + 1)

    def end(i: int) -> int | None:
        for first, after, last in kinds:
            j = i + before if after else i
            m = first.search(lines[j]) if j < len(lines) else None
            if not m:
                continue
            if after:
                j = next((x for x in (j + 1, j + 2) if x < len(lines) and after.search(lines[x])), None)
                m = j is not None and after.search(lines[j])
                if not m:
                    continue
            e = j if last.search(lines[j], m.end()) else nexts[last.pattern][j + 1]
            if e < len(lines):
                return e
        return None

    out, i = [], 0
    while i < len(lines):
        e = end(i)
        if e is not None:
            out.append((starts[i], starts[e] + len(lines[e])))
            i = e
        i += 1
    return out


def no_inline_headers(text: str | None) -> str:
    """The text without its inline headers (survey Y1)."""
    text, at, out = text or "", 0, []
    for a, b in inline_headers(text, REMOVED, 1):
        out.append(text[at:a])
        at = b
    return "".join([*out, text[at:]])


def _slices(sizes: list[int], most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of rows with about ``most`` bytes, at least one row each."""
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def _no_inline_headers(texts: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    done = [pa.array([no_inline_headers(t) for t in texts[a:b].to_pylist()], pa.string()) for a, b in _slices(sizes)]
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def without_inline_headers(c) -> Column:
    return F.arrow_udf(_no_inline_headers, "string")(c)


def split(header: str | None, body: str | None) -> list[dict]:
    """The protocol header with the text up to the first inline header, then each inline header with the text up to the next."""
    body = body or ""
    found = inline_headers(body, INLINE)
    ends = [a for a, _ in found] + [len(body)]
    out = [{"header": header or "", "body": body[: ends[0]].strip()}]
    for (a, b), end in zip(found, ends[1:]):
        out.append({"header": body[a:b], "body": body[b:end].strip()})
    return out


def _parts(header: pa.Array, body: pa.Array) -> pa.Array:
    at, rows = [0], []
    for h, b in zip(header.to_pylist(), body.to_pylist()):
        rows += split(h, b)
        at.append(len(rows))
    each = pa.StructArray.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in ("header", "body")], names=["header", "body"])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), each)


def parts(header, body) -> Column:
    """The ``PARTS`` of a mail."""
    return once(F.arrow_udf(_parts, PARTS))(header, body)
