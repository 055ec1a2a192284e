"""Headers and decoding on small invented mails in the shapes of FIXTURES.md."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from commlens.functions import cleaning, contacts, headers
from commlens.functions.mime import EMPTY, decode, html_text, split


def parsed(spark, *texts, **how):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, h string")
    return [r.x for r in df.select("i", headers.header(F.col("h"), **how).alias("x")).orderBy("i").collect()]


def test_header_shapes(spark):
    a, b, c, d, e = parsed(
        spark,
        '> -----Original Message-----\n> From: "Doe, Jane [HR]"\n> Sent: Tuesday, March 06, 2001 4:15 PM\n> To: Smith, Bob [IT]; Ray, Al\n>  [OPS]\n> Subject: RE: plans',
        "---- Forwarded by Jane Doe/HOU/ACME on 01/02/2000 10:11 AM -----\nBob Smith@ACME\n12/31/99 09:00 AM\nTo: Jane Doe/HOU/ACME@ACME\ncc: Al Ray/HOU/ACME@ACME \nSubject: Hello",
        "Date: Mon, 14 May 2001 16:39:00 -0700 (PDT)\nFrom: jane.doe@acme.com\nTo: bob.smith@acme.com, ab@acme.com\nSubject: \nX-From: Jane",
        "Von: Jane Doe <jane@x.de>\nGesendet: 01.02.2003 10:00\nAn: Bob <b@x.de>\nBetreff: Hallo",
        None,
    )
    assert (a.sender.name, a.sender.email, a.date, a.subject) == ("Jane Doe", "", dt.datetime(2001, 3, 6, 16, 15), "RE: plans")
    assert [(r.name, r.type) for r in a.recipients] == [("Bob Smith", "to"), ("Al Ray", "to")]
    assert (b.sender.name, b.date) == ("Bob Smith", dt.datetime(1999, 12, 31, 9, 0))
    assert [(r.name, r.type) for r in b.recipients] == [("Jane Doe", "to"), ("Al Ray", "cc")]
    assert (c.sender.name, c.date, c.subject) == ("Jane Doe", dt.datetime(2001, 5, 14, 23, 39), "")
    assert [(r.name, r.email) for r in c.recipients] == [("Bob Smith", "bob.smith@acme.com"), ("", "ab@acme.com")]
    assert (d.sender.email, d.recipients[0].email, d.date, d.subject) == ("jane@x.de", "b@x.de", dt.datetime(2003, 2, 1, 10, 0), "Hallo")
    assert (e.sender.name, e.recipients, e.date, e.subject, e.date_changed) == ("", [], None, "", False)


def test_dates_are_clamped(spark):
    low, high = parsed(spark, "Date: 1 Jan 1970 00:00:00 +0000", "Date: 1 Jan 2030 00:00:00 +0000", low="1995-01-01 00:00:00", high="2005-01-01 00:00:00")
    assert low.date == dt.datetime(1995, 1, 1) and low.date_changed
    assert high.date_changed


def test_title_case(spark):
    r = spark.range(1).select(headers.title(F.lit("o'neil x-ray 3com d.koya")).alias("t")).first()
    assert r.t == "O'Neil X-Ray 3Com D.Koya"


def test_decode():
    raw = "From: =?utf-8?q?J=C3=A9?= <j@x.com>\nTo: b@x.com\nX-Odd: 1\nSubject: s\nContent-Type: multipart/mixed; boundary=b\n\n--b\nContent-Type: text/html; charset=utf-8\n\n<html><body><p>One &amp; <a href='x'>two</a></p><p>three</p></body></html>\n--b\nContent-Type: application/pdf\nContent-Disposition: attachment; filename=a.pdf\nContent-Transfer-Encoding: base64\n\nAAAA\n--b--\n"
    header, body, files, defects = decode(raw)
    assert header == "From: Jé <j@x.com>\nTo: b@x.com\nSubject: s\n" and body == "One & two\nthree" and files == ["a.pdf"] and defects == 0
    assert decode(None)[1] == EMPTY and decode("From: a\n\nItâ€™s")[1] == "It’s"
    assert html_text("<script>x</script><p>a<br>b") == "a\nb"


def test_split():
    body = "Reply.\n\n-----Original Message-----\nFrom: A\nSent: x\nTo: B\nSubject: one\n\nFirst.\n\n---------- Forwarded by C on 1/2/00 -----\nC\nTo: D\nSubject: two\n\nSecond."
    parts = split("H", body)
    assert [p["body"] for p in parts] == ["Reply.", "First.", "Second."] and parts[0]["header"] == "H" and "one" in parts[1]["header"]
    assert split(None, None) == [{"header": "", "body": ""}]
    assert len(split("H", "-----Original Message-----\n" + "x\n" * 30000)) == 1


@pytest.mark.parametrize("line,kinds", [
    ("Ph: (713) 555-1234\nFax: (713) 555-9876", ["office", "fax"]), ("Phone: 713/555-1234\nFax: 713/555-0000\nHome: 713/555-2222", ["office", "fax", "home"]),
    ("(713) 555-1234 (Office)\n(713) 555-1235 (Cell)\n(713) 555-1236 (fax)", ["office", "cell", "fax"]), ("none", []), ("5551234567", ["office"]), ("555 - 123 - 4567 mob", ["cell"]), ("x5551234567", []), ("555123456789", []), ("Voice 555  123  45678", ["office"]),
])
def test_phones(spark, line, kinds):
    got = spark.createDataFrame([(line,)], "s string").select(contacts.phones(F.col("s")).alias("p")).first().p
    assert [p.kind for p in got] == kinds


def test_contacts_and_cleaning(spark):
    one = lambda c: spark.range(1).select(c.alias("c")).first().c
    assert one(contacts.aliases(F.lit("Jane\nJane Doe\nx"), F.lit("jane.doe@x.com"))) == ["Jane", "Jane Doe"]
    assert one(contacts.aliases(F.lit("ab"), F.lit("ab@x.com"))) == []
    assert one(contacts.organisation(F.lit("a@mail.acme.com"), ["gmail"])) == "Acme" and one(contacts.organisation(F.lit("a@gmail.com"), ["gmail"])) is None
    assert one(cleaning.strict(F.lit("Call (713) 555-1234 or see http://a.b/c, a@b.com 42 €!"))) == "Call or see"
    assert one(cleaning.ascii_only(F.lit("Äpfel don't ☃"))) == "Apfel do not "
    assert one(cleaning.without_salutation(F.lit("Dear Bob,\nhi"))) == "Bob,\nhi" and one(cleaning.without_salutation(F.lit("Dear Bob"))) == "Dear Bob"
    assert one(cleaning.sent_from_mobile(F.lit("x\n---\nSent from my BlackBerry"))) is True and one(cleaning.sent_from_mobile(F.lit("x"))) is None
    s = one(contacts.signature(F.lit("Hello\nthere\n--\nJane\n555"), F.lit("jane@x.com"), F.lit("Jane")))
    assert (s.body, s.signature) == ("Hello\nthere", "--\nJane\n555")
    assert one(cleaning.without_headers(F.lit(None).cast("string"))) == ""
