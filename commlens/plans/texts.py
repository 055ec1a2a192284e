"""Queries: cleaning, features, languages, entities, HTML, phrases."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from commlens.functions import cleaning as cl
from commlens.functions import features as ft
from commlens.functions import zones
from commlens.functions.language import COMPANY, PLACES, WORDS, entities, language
from commlens.functions.mime import decoded, text_of_html, without_inline_headers
from commlens.operators import models, phrases
from commlens.operators.topics import term_counts, top_k, with_frequencies
from commlens.plans.mails import table
from commlens.plans.registry import query
from commlens.sources import readers, sinks
from commlens.tables import shared_path, written


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _chain(expr: str, patterns: list[str], by: str = "") -> str:
    """Nested DuckDB replacements; inline flags and quotes are carried over."""
    for p in patterns:
        flags = "g"
        if p.startswith("(?"):
            own, p = p[2 : p.index(")")], p[p.index(")") + 1 :]
            flags += own
        expr = f"regexp_replace({expr}, '{'(?m)' if 'm' in flags else ''}{p.replace(chr(39), chr(39) * 2)}', '{by}', '{flags.replace('m', '')}')"
    return expr


_T = "coalesce(text, '')"
#: A mail around the text: a quoted header with a wrapped address list, an empty line, a quoted line.
_M = "'-----Original Message-----' || chr(10) || 'From: a' || chr(10) || 'To: b,' || chr(10) || '  c,' || chr(10) || '  d' || chr(10) || 'Subject: s' || chr(10) || chr(10) || '> quoted' || chr(10) || '>' || chr(10) || coalesce(text, '')"
_SQUEEZE = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"


@query("p19_without_headers", f"SELECT doc_id, md5({_chain(_T, cl.NOISE)}) AS h FROM documents")
def p19(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(cl.without_headers(F.col("text"))).alias("h"))


@query("p20_strict", f"SELECT doc_id, md5({_SQUEEZE.format(_chain(_T, [cl.URL, cl.MAIL, cl.PHONE, cl.NUMBER, cl.CURRENCY, cl.PUNCTUATION], ' '))}) AS h FROM documents")
def p20(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(cl.strict(F.col("text"))).alias("h"))


@query("p23_attachment_notices", f"SELECT doc_id, md5({_chain(_T, cl.ATTACHMENT_NOTICES)}) AS h FROM documents")
def p23(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(cl.without_attachment_notices(F.col("text"))).alias("h"))


@query("p24_footers", f"SELECT doc_id, md5({_chain(_T, [cl.MOBILE, *cl.FOOTERS])}) AS h, regexp_matches({_T}, '{cl.MOBILE}') AS sent_from_mobile FROM documents")
def p24(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(cl.without_footers(F.col("text"))).alias("h"), F.coalesce(cl.sent_from_mobile(F.col("text")), F.lit(False)).alias("sent_from_mobile"))


@query("p31_phrase_text", f"SELECT doc_id, md5({_SQUEEZE.format('replace(' + _chain(_T, [cl.URL, cl.MAIL, cl.PHONE, cl.NUMBER], ' ') + chr(44) + chr(39) + '|' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ')')}) AS h FROM documents")
def p31(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(cl.phrase_text(F.col("text"))).alias("h"))


def _normal_sql() -> str:
    e = f"lower({_T})"
    for p, by in ((cl.URL, "REP_URL"), (cl.MAIL, "REP_EMAIL"), (cl.PHONE, "REP_PHONE"), (cl.NUMBER, "REP_NUM")):
        e = _chain(e, [p], f" {by} ")
    return _SQUEEZE.format(e)


@query("y3_normalised", f"SELECT doc_id, md5({_normal_sql()}) AS h FROM documents")
def y3(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(cl.normalised(F.col("text"))).alias("h"))


@query("x10_placeholders", f"WITH n AS (SELECT doc_id, {_normal_sql()} AS t FROM documents) SELECT doc_id, {', '.join(f'len(regexp_extract_all(t, {chr(39)}REP_{k}{chr(39)})) AS num_{k.lower()}' for k in ('URL', 'PHONE', 'EMAIL', 'NUM'))} FROM n")
def x10(spark, sf_dir):
    n = _docs(spark, sf_dir).select("doc_id", cl.normalised(F.col("text")).alias("t"))
    return n.select("doc_id", *[v.alias(k) for k, v in ft.placeholders(F.col("t")).items()])


@query("p33_salutation", f"""
WITH t AS (SELECT doc_id, {_T} AS text, split_part({_T}, chr(10), 1) AS first FROM documents)
SELECT doc_id, md5(CASE WHEN contains(text, chr(10)) THEN array_to_string(list_filter(string_split(first, ' '), lambda w: NOT lower(regexp_replace(w, '[,!.:]+$', '')) IN ({', '.join(f"'{g}'" for g in cl.GREETINGS)})), ' ') || text[length(first) + 1:] ELSE text END) AS h FROM t""")
def p33(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(cl.without_salutation(F.col("text"))).alias("h"))


_STOP = "[" + ", ".join(f"'{w}'" for w in cl.STOPWORDS) + "]"


def bag_sql(numbers: bool = False) -> str:
    words = f"regexp_extract_all(lower({_chain(_T, [cl.URL, cl.MAIL, cl.PHONE], ' ')}), '[a-zà-öø-ÿ]+{'|[0-9]+' if numbers else ''}')"
    if numbers:
        words = f"list_transform({words}, lambda w: CASE WHEN regexp_matches(w, '^[0-9]') THEN '#number' ELSE w END)"
    return f"list_filter({words}, lambda w: length(w) > 2 AND NOT list_contains({_STOP}, w))"


_BAG = bag_sql()


@query("p34_bag_of_words", f"SELECT doc_id, w AS word, count(*) AS n FROM (SELECT doc_id, unnest({_BAG}) AS w FROM documents) GROUP BY ALL")
def p34(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", F.explode(cl.bag_of_words(F.col("text"))).alias("word"))
    return rows.groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@query("p35_lemmas", f"""
WITH w AS (SELECT w, count(*) AS n FROM (SELECT unnest({_BAG}) AS w FROM documents) GROUP BY 1),
f AS (SELECT *, CASE WHEN length(w) > 4 THEN regexp_replace(regexp_replace(w, 'ies$', 'y'), '([^s])s$', '\\1') ELSE w END AS noun, CASE WHEN length(w) > 5 THEN regexp_replace(w, '(ing|ed)$', '') ELSE w END AS verb FROM w)
SELECT CASE WHEN length(verb) < length(noun) THEN verb ELSE noun END AS lemma, sum(n)::BIGINT AS n, count(*) AS forms FROM f GROUP BY 1""")
def p35(spark, sf_dir):
    rows = _docs(spark, sf_dir).select(F.explode(cl.bag_of_words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return rows.groupBy(cl.lemma(F.col("word")).alias("lemma")).agg(F.sum("n").alias("n"), F.count("*").alias("forms"))


_LANG = ", ".join(f"len(list_filter(w, lambda x: x IN ({', '.join(repr(x) for x in ws)}))) AS {c}" for c, ws in sorted(WORDS.items()))


@query("p17_language", f"""
WITH w AS (SELECT doc_id, regexp_split_to_array(lower({_T}), '[^a-zà-öø-ÿ]+') AS w FROM documents), n AS (SELECT doc_id, {_LANG} FROM w)
SELECT doc_id, CASE WHEN greatest(de, en, es, fr) = 0 THEN 'xx' WHEN de = greatest(de, en, es, fr) THEN 'de' WHEN en = greatest(de, en, es, fr) THEN 'en' WHEN es = greatest(de, en, es, fr) THEN 'es' ELSE 'fr' END AS lang_found FROM n""")
def p17(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", language(F.col("text")).alias("lang_found"))


_IS_PLACE, _IS_FIRM = (f"x IN ({', '.join(map(repr, PLACES))})", f"string_split(x, ' ')[-1] IN ({', '.join(map(repr, COMPANY))})")


@query("p36_entities", f"""
WITH r AS (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, lower(unnest(regexp_extract_all({_T}, '[A-Z][a-zà-ÿ]+( [A-Z][a-zà-ÿ]+)*'))) AS x FROM documents)),
n AS (SELECT doc_id, count(*) FILTER (NOT {_IS_PLACE} AND NOT {_IS_FIRM} AND contains(x, ' ')) AS person, count(*) FILTER ({_IS_PLACE}) AS location, count(*) FILTER (NOT {_IS_PLACE} AND {_IS_FIRM}) AS organization,
 count(*) FILTER (NOT {_IS_PLACE} AND NOT {_IS_FIRM} AND NOT contains(x, ' ')) AS miscellaneous FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(person, 0)::INT AS person, coalesce(location, 0)::INT AS location, coalesce(organization, 0)::INT AS organization, coalesce(miscellaneous, 0)::INT AS miscellaneous FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id""")
def p36(spark, sf_dir):
    e = _docs(spark, sf_dir).select("doc_id", entities(F.col("text")).alias("e"))
    return e.select("doc_id", *[F.size(f"e.{k}").alias(k) for k in ("person", "location", "organization", "miscellaneous")])


def _ascii_sql() -> str:
    t = f"replace(replace(replace(strip_accents({_T}), 'ß', 'ss'), '’', chr(39)), 'œ', 'oe')"
    for short, long in cl.CONTRACTIONS.items():
        t = f"replace({t}, '{short.replace(chr(39), chr(39) * 2)}', '{long.replace(chr(39), chr(39) * 2)}')"
    return f"WITH t AS (SELECT doc_id, regexp_replace({t}, '[^\\x00-\\x7F]', '', 'g') AS t FROM documents) SELECT doc_id, md5(t) AS h, length(t)::INT AS size FROM t"


@query("p18_ascii", _ascii_sql())
def p18(spark, sf_dir):
    t = _docs(spark, sf_dir).select("doc_id", cl.ascii_only(F.col("text")).alias("t"))
    return t.select("doc_id", F.md5("t").alias("h"), F.length("t").alias("size"))


@query("p3_html_text")
def p3(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text_of_html(F.col("html")).alias("text"))


@query("y1_inline_headers", f"SELECT doc_id, md5({_chain(_T, [r'(?i)-----original message-----[^§]*$'])}) AS h FROM documents")
def y1(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(without_inline_headers(F.col("text"))).alias("h"))


_W = f"regexp_extract_all({_T}, '{ft.WORD.replace(chr(39), chr(39) * 2)}')"
_FEATS = f"""
WITH a AS (SELECT doc_id, {_T} AS text, {_W} AS w, list_filter(list_transform(regexp_split_to_array({_T}, '{ft.SENTENCE}'), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents),
n AS (SELECT doc_id, len(s) AS num_sentences, len(w) AS num_words, length(text) AS num_chars,
  len(list_distinct(list_filter(list_transform(w, lambda x: lower(x)), lambda x: NOT list_contains({_STOP}, x)))) AS num_unique_words,
  coalesce(list_median(list_transform(s, lambda x: length(x)::DOUBLE)), 0.0)::DOUBLE AS median_sentence_length,
  len(list_filter(w, lambda x: length(x) >= 6)) AS num_long_words, len(list_filter(w, lambda x: length(x) > 6)) AS l7 FROM a)
SELECT doc_id, num_sentences, num_words, num_chars, num_unique_words, median_sentence_length, num_long_words,
  CASE WHEN num_words = 0 OR num_sentences = 0 THEN 0.0 ELSE round(4.71::DOUBLE * (num_chars::DOUBLE / num_words) + 0.5::DOUBLE * (num_words::DOUBLE / num_sentences) - 21.43::DOUBLE, 6) END::DOUBLE AS ari,
  CASE WHEN num_words = 0 OR num_sentences = 0 THEN 0.0 ELSE round(num_words::DOUBLE / num_sentences + 100::DOUBLE * (l7::DOUBLE / num_words), 6) END::DOUBLE AS lix FROM n"""


@query("x2_x7_text_features", _FEATS)
def x2(spark, sf_dir):
    f = ft.text_features(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", *[(F.round(c, 6) if k in ("ari", "lix") else c).alias(k) for k, c in f.items()])


# Written from the survey: RE2 has no look-behind, so a tag that does not end in a slash is said with character classes.
@query("x9_flags", f"""
WITH t AS (SELECT doc_id, {_T} AS text, lower({_T}) AS low FROM documents)
SELECT doc_id, contains(low, 're: ')::INT AS is_reply, (contains(low, 'fw: ') OR contains(low, 'fwd: '))::INT AS is_forward,
 regexp_matches(text, '<[^\\s]*[^\\s/]>|<[^\\s]+\\s([^>]*[^>/])?>')::INT AS has_html_tag, regexp_matches(text, '[# .][^\\n]+[{{][^}}]+:[^}}]+[}}]')::INT AS has_css,
 (contains(low, 'unsubscribe') OR regexp_matches(low, 'e-?mail.preferences'))::INT AS has_unsubscribe, regexp_matches(low, 'no-?reply|not-?reply|newsletter|info|notif')::INT AS is_noreply, (length(replace(text, chr(10), '')) > 0)::INT AS has_reply_to FROM t""")
def x9(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", *[ft.flag(F.col("text"), k).alias(k) for k in ft.FLAGS])


@query("x1_recipients", f"SELECT doc_id, len(string_split({_T}, ';')) AS n FROM documents")
def x1(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", ft.recipients(F.col("text")).alias("n"))


@query("x11_x26_time_features", f"""
SELECT event_id, dayofweek(ts)::INT AS weekday, (dayofweek(ts) IN (0, 6))::INT AS is_weekend, (hour(ts) >= 7 AND hour(ts) < 19 AND dayofweek(ts) BETWEEN 1 AND 5)::INT AS is_business_hours,
 (year(ts) % 100)::INT AS year, month(ts)::INT AS month, day(ts)::INT AS day, hour(ts)::INT AS hour, CASE WHEN day(ts) <= 3 THEN 'beginning' WHEN day(ts) <= 27 THEN 'middle' ELSE 'end' END AS month_part,
 {', '.join(f'(quarter(ts) = {q})::INT AS quarter_{q}' for q in range(1, 5))}, {', '.join(f'(dayofweek(ts) = {d})::INT AS weekday_{d}' for d in range(7))}, {', '.join(f'(hour(ts) >= {h} AND hour(ts) < {h + 3})::INT AS slot_{h}' for h in range(0, 24, 3))} FROM events""")
def x11(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", *[c.alias(k) for k, c in ft.time_features(F.col("ts")).items()])


_LEN = f"length({_T})"


@query("x27_x28_bins", f"SELECT doc_id, ({_LEN} <= 10)::INT AS len_to_10, ({_LEN} > 10 AND {_LEN} <= 200)::INT AS len_to_200, ({_LEN} > 200 AND {_LEN} <= 1000)::INT AS len_to_1000, ({_LEN} > 1000)::INT AS len_over_1000 FROM documents")
def x27(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", *[c.alias(k) for k, c in ft.bins(F.length(F.coalesce("text", F.lit(""))), "len", [10, 200, 1000]).items()])


_MAILS = f"regexp_extract_all({_T}, '{cl.MAIL}')"


@query("x16_x18_domains", f"""
WITH d AS (SELECT doc_id, list_transform({_MAILS}, lambda x: string_split(x, '@')[-1]) AS all_ FROM documents),
u AS (SELECT doc_id, all_, list_sort(list_distinct(all_)) AS u FROM d),
m AS (SELECT doc_id, x, count(*) AS n FROM (SELECT doc_id, unnest(all_) AS x FROM d) GROUP BY ALL),
t AS (SELECT doc_id, x FROM m QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, x) = 1)
SELECT u.doc_id, len(u)::INT AS n_domains, t.x AS most_frequent_domain, (len(list_filter(u, lambda x: NOT contains(x, 'example'))) = 0)::INT AS recipients_internal FROM u LEFT JOIN t ON u.doc_id = t.doc_id""")
def x16(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({cl.MAIL})"), F.lit(0)).alias("m"))
    own = ft.domains(F.col("m"))
    d = d.select("doc_id", own["unique_domains"].alias("u"), own["most_frequent_domain"].alias("most_frequent_domain"))
    return d.select("doc_id", F.size("u").alias("n_domains"), "most_frequent_domain", ft.internal(F.lit("x.example"), F.col("u"), "example")["recipients_internal"].alias("recipients_internal"))


@query("x8_names", f"""
WITH t AS (SELECT doc_id, {_T} AS text, string_split({_T}, chr(10))[1] AS first, upper(lang[1]) || lang[2:] AS l, source AS s, regexp_extract({_T}, '[A-Za-z]+') AS w FROM documents)
SELECT doc_id, CASE WHEN text = '' OR w = '' THEN 0.0 ELSE round((contains(first, l)::INT + contains(first, 'The')::INT + contains(first, w)::INT) / 3.0, 6) END::DOUBLE AS first_names,
 CASE WHEN text = '' OR w = '' THEN 0.0 ELSE round((contains(first, s)::INT + contains(first, w)::INT + contains(first, 'en')::INT) / 3.0, 6) END::DOUBLE AS last_names,
 (w <> '' AND contains(text, w))::INT AS sender_first, 0 AS sender_last FROM t""")
def x8(spark, sf_dir):
    w = F.regexp_extract(F.coalesce("text", F.lit("")), "[A-Za-z]+", 0)
    lang = F.concat(F.upper(F.substring("lang", 1, 1)), F.substring("lang", 2, 99))
    names = F.concat_ws(";", F.concat_ws(" ", lang, F.col("source")), F.concat_ws(" ", F.lit("The"), w), F.when(w == "", "").otherwise(F.concat_ws(" ", w, F.lit("en"))))
    share = lambda part: F.round(ft.names_in_salutation(names, F.col("text"), part), 6)
    return _docs(spark, sf_dir).select("doc_id", share(0).alias("first_names"), share(1).alias("last_names"), ft.name_in_body(w, F.col("text"), 0).alias("sender_first"), ft.name_in_body(w, F.col("text"), 1).alias("sender_last"))


@query("x14_x15_y4_encodings", """
SELECT n_nationkey, (n_regionkey = 0)::INT AS n_regionkey_0, (n_regionkey = 1)::INT AS n_regionkey_1, (n_regionkey = 2)::INT AS n_regionkey_2, (n_regionkey = 3)::INT AS n_regionkey_3, (n_regionkey = 4)::INT AS n_regionkey_4,
 (dense_rank() OVER (ORDER BY n_name) - 1)::INT AS n_name, (n_nationkey > 9)::INT AS large, n_nationkey::DOUBLE AS b_0, n_regionkey::DOUBLE AS b_1 FROM nation""")
def x14(spark, sf_dir):
    n = table(spark, sf_dir, "nation").withColumn("large", F.col("n_nationkey") > 9).withColumn("v", array_to_vector(F.array(F.col("n_nationkey").cast("double"), F.col("n_regionkey").cast("double"))))
    n = ft.append_fields(ft.as_integers(n, ["large"]), {"b": ("v", 2)})
    return ft.drop_containing(ft.label_encode(ft.one_hot(n, "n_regionkey"), "n_name"), ["comment"])


@query("x19_x28_x29_recipients", """
WITH n AS (SELECT l_orderkey AS doc_id, count(*) FILTER (l_linenumber <= 3) + count(*) FILTER (l_linenumber > 3) AS recipients_amount FROM lineitem GROUP BY 1)
SELECT doc_id, recipients_amount, (recipients_amount = 1)::INT AS recipients_is_single, (recipients_amount <= 1)::INT AS to_1, (recipients_amount BETWEEN 2 AND 10)::INT AS to_10, (recipients_amount > 10)::INT AS over_10 FROM n""")
def x19(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id"))
    who = lambda keep: F.concat_ws(", ", F.collect_list(F.when(keep, F.col("l_suppkey").cast("string"))))  # noqa: E731  an order's lines
    d = li.agg(who(F.col("l_linenumber") <= 3).alias("to"), who(F.col("l_linenumber") > 3).alias("cc"))
    own = ft.recipients_amount(F.col("to"), F.col("cc"))
    d = ft.as_integers(d.select("doc_id", *[c.alias(k) for k, c in own.items()]), ["recipients_is_single"])
    d = d.select("*", *[c.alias(k) for k, c in ft.bins(F.col("recipients_amount"), "feat_recipients_amount", [1, 10]).items()], F.lit(1).alias("feat_body_length_1"))
    d = d.withColumnsRenamed({f"feat_recipients_amount_{k}": k for k in ("to_1", "to_10", "over_10")})
    return ft.drop_prefixed(d, ["feat_body_length"])


@query("x20_is_thread", f"SELECT doc_id, doc_id % 3 = 0 AND NOT contains({_T}, 'From:') AS email_is_thread FROM documents")
def x20(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    complete = F.when((F.col("doc_id") % 3 == 0) & ~F.contains(text, F.lit("From:")), F.concat(F.lit("Hello\nFrom: a@b.example\nTo: c@d.example\nSubject: old\n"), text)).otherwise(text)
    d = _docs(spark, sf_dir).select("doc_id", complete.alias("body"))
    return d.select("doc_id", ft.is_thread(F.col("body"), without_inline_headers(F.col("body"))).alias("email_is_thread"))


@query("p1_p6_decoded", f"""
SELECT doc_id, md5(CASE WHEN trim(replace(replace({_T}, chr(10), ''), chr(9), '')) = '' THEN '[Empty message]' ELSE {_T} END) AS body, 'Subject: Straße ' || doc_id || chr(10) AS subject,
 CASE doc_id % 2 WHEN 0 THEN 'n' || doc_id || '.bin' END AS attachment, 0 AS defects FROM documents""")
def p1(spark, sf_dir):
    """Whole texts as base64 parts of MIME mails, every other one beside an attachment, decoded again."""
    d, k = _docs(spark, sf_dir), F.col("doc_id").cast("string")
    # No text part is HTML or broken UTF-8 here, so that the body must come back as it was.
    b64 = F.regexp_replace(F.base64(F.coalesce("text", F.lit("")).cast("binary")), "\r", "")
    subject = F.concat(F.lit("Subject: =?utf-8?B?"), F.base64(F.concat(F.lit("Straße "), k).cast("binary")), F.lit("?=\nX-Trace: gone\nMIME-Version: 1.0\n"))
    part = F.concat(F.lit("Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: base64\n\n"), b64, F.lit("\n"))
    both = F.concat(
        F.lit("Content-Type: multipart/mixed; boundary=zzz\n\n--zzz\n"), part, F.lit("--zzz\nContent-Type: application/octet-stream\nContent-Disposition: attachment; filename=n"), k,
        F.lit(".bin\nContent-Transfer-Encoding: base64\n\nAAECAw==\n--zzz--\n"),
    )
    raw = F.concat(subject, F.when(F.col("doc_id") % 2 == 0, both).otherwise(part))
    got = d.select("doc_id", decoded(raw).alias("m"))
    return got.select("doc_id", F.md5("m.body").alias("body"), F.col("m.header").alias("subject"), F.get("m.attachments", F.lit(0)).alias("attachment"), F.col("m.defects").alias("defects"))


@query("s2_s5_json_lines", "SELECT doc_id, md5(coalesce(text, '')) AS h, lang, source, n_chars FROM documents")
def s5(spark, sf_dir):
    """Documents written as JSON lines and read again."""
    at = shared_path(spark, "json-lines")
    sinks.json_lines(_docs(spark, sf_dir), at)
    back = readers.json_lines(spark, at, "doc_id long, text string, lang string, source string, n_chars long")
    return back.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("h"), "lang", "source", "n_chars")


@query("y6_no_nulls", "SELECT doc_id FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL")
def y6(spark, sf_dir):
    return _docs(spark, sf_dir).na.drop(subset=["text", "lang"]).select("doc_id")


@query("y8_long_texts", "SELECT doc_id, n_chars FROM documents WHERE length(text) >= 100")
def y8(spark, sf_dir):
    return _docs(spark, sf_dir).where(F.length("text") >= 100).select("doc_id", "n_chars")


@query("p37_y11_line_blocks", f"""
WITH l AS (SELECT doc_id, generate_subscripts(string_split({_M}, chr(10)), 1) AS i, unnest(string_split({_M}, chr(10))) AS line FROM documents),
k AS (SELECT doc_id, i, CASE WHEN trim(regexp_replace(line, '^[ \\t]*>', '')) = '' THEN 'blank' WHEN regexp_matches(lower(line), '^[> \\t]*(from|to|cc|bcc|sent|date|subject|von|an|gesendet|betreff|reply-to|sent by)[ \\t]*:') THEN 'header'
 WHEN regexp_matches(lower(line), '^[> \\t]*([-_][-_]+.*(original message|forwarded by|reply separator|nachricht)|begin forwarded message:)') THEN 'header' WHEN regexp_matches(line, '^[> ]*[ \\t]+[^ \\t\\n\\f\\r\\v]') THEN 'more' ELSE 'body' END AS own FROM l),
u AS (SELECT *, last_value(CASE WHEN own <> 'more' THEN own END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS above FROM k),
z AS (SELECT doc_id, i, CASE WHEN own <> 'more' THEN own WHEN above = 'header' THEN 'header' ELSE 'body' END AS kind FROM u),
g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, kind ORDER BY i) AS block FROM z)
SELECT doc_id, kind, min(i) - 1 AS first_line, count(*) AS n_lines FROM g GROUP BY doc_id, kind, block""")
def y11(spark, sf_dir):
    mail = F.concat(F.lit("-----Original Message-----\nFrom: a\nTo: b,\n  c,\n  d\nSubject: s\n\n> quoted\n>\n"), F.coalesce("text", F.lit("")))
    blocks = zones.runs(zones.line_zones(mail))
    return _docs(spark, sf_dir).select("doc_id", F.explode(blocks).alias("b")).select("doc_id", "b.kind", "b.first_line", "b.n_lines")


@query("p38_zones", f"""
WITH l AS (SELECT doc_id, unnest(string_split({_T}, chr(10))) AS line, generate_subscripts(string_split({_T}, chr(10)), 1) AS i, length({_T}) AS n FROM documents),
z AS (SELECT doc_id, i, n, length(line) + 1 AS len, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(line) - 1 AS a FROM l),
o AS (SELECT doc_id, i, greatest(0, least(a + len, n // 4) - a) AS h, greatest(0, least(a + len, n // 2) - greatest(a, n // 4)) AS b, greatest(0, least(a + len, n - 20) - greatest(a, n // 2)) AS s FROM z)
SELECT doc_id, i - 1 AS line, CASE WHEN greatest(h, b, s) = 0 THEN 'none' WHEN h = greatest(h, b, s) THEN 'header' WHEN b = greatest(h, b, s) THEN 'body' ELSE 'signature' END AS zone FROM o""")
def p38(spark, sf_dir):
    n = F.length(F.coalesce("text", F.lit("")))
    quarter, half = F.floor(n / 4).cast("int"), F.floor(n / 2).cast("int")
    z = zones.overlap_zones(F.col("text"), [("header", F.lit(0), quarter), ("body", quarter, half), ("signature", half, n - 20)], "none")
    return _docs(spark, sf_dir).select("doc_id", F.posexplode_outer(z).alias("line", "zone")).select("doc_id", F.col("line").cast("long").alias("line"), "zone")


@query("p25_signature", f"""
WITH l AS (SELECT doc_id, unnest(string_split({_T}, chr(10))) AS line, generate_subscripts(string_split({_T}, chr(10)), 1) - 1 AS i, len(string_split({_T}, chr(10))) AS n FROM documents),
c AS (SELECT *, i >= greatest(n - 12, 1) AND (regexp_matches(line, '^--[ \\t\\n\\f\\r\\v]*$') OR regexp_matches(lower(trim(line)), '^(best|regards|best regards|kind regards|sincerely|thanks|thank you|cheers|yours|viele grüße|mfg|cordialement)[,.! ]*$')
  OR (length(trim(line)) > 2 AND (lower(trim(line)) = 'jo doe' OR regexp_replace(lower(line), '[^a-z]+', '', 'g') = 'jo'))) AS starts FROM l),
a AS (SELECT doc_id, any_value(n) AS n, coalesce(min(i) FILTER (starts), any_value(n)) AS cut FROM c GROUP BY 1)
SELECT a.doc_id, (sum(CASE WHEN i < cut THEN length(line) ELSE 0 END) + a.cut - 1)::INT AS body_chars, (sum(CASE WHEN i >= cut THEN length(line) ELSE 0 END) + greatest(a.n - a.cut - 1, 0))::INT AS signature_chars
FROM a JOIN c ON c.doc_id = a.doc_id GROUP BY a.doc_id, a.n, a.cut""")
def p25(spark, sf_dir):
    from commlens.functions.contacts import signature

    s = _docs(spark, sf_dir).select("doc_id", signature(F.col("text"), F.lit("jo@example.com"), F.lit("Jo Doe")).alias("s"))
    return s.select("doc_id", F.length("s.body").alias("body_chars"), F.length("s.signature").alias("signature_chars"))


_BIGRAMS = f"""
WITH w AS (SELECT doc_id, {_BAG} AS w FROM documents), b AS (SELECT doc_id, w[i] || ' ' || w[i + 1] AS phrase FROM w, unnest(range(1, len(w))) t(i)),
n AS (SELECT doc_id, phrase, count(*) AS n FROM b GROUP BY ALL), s AS (SELECT phrase, round(avg(n), 6)::DOUBLE AS score, count(*) AS chunks FROM n GROUP BY 1)"""


@query("a7_phrase_scores", f"{_BIGRAMS} SELECT * FROM s")
def a7(spark, sf_dir):
    w = _docs(spark, sf_dir).select("doc_id", cl.bag_of_words(F.col("text")).alias("w"))
    grams = F.transform(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get("w", i + 1)))
    n = term_counts(w.select("doc_id", grams.alias("w")), "doc_id", F.col("w")).withColumnRenamed("term", "phrase")
    return phrases.mean_scores(n, F.col("phrase"), F.col("n")).withColumn("score", F.round("score", 6))


@query("k2_k3_top_phrases", f"{_BIGRAMS} SELECT * FROM s ORDER BY chunks DESC, score DESC, phrase LIMIT 100")
def k2(spark, sf_dir):
    return a7(spark, sf_dir).orderBy(F.desc("chunks"), F.desc("score"), "phrase").limit(100)


@query("p32_j4_tagged", f"{_BIGRAMS}, top AS (SELECT phrase FROM s ORDER BY chunks DESC, score DESC, phrase LIMIT 20) SELECT doc_id, top.phrase FROM documents, top WHERE contains(lower(text), top.phrase)")
def p32(spark, sf_dir):
    top = [(r["phrase"], float(r["score"])) for r in a7(spark, sf_dir).orderBy(F.desc("chunks"), F.desc("score"), "phrase").limit(20).collect()]  # a top-k report
    t = phrases.tagged(_docs(spark, sf_dir), top, F.lower("text"))
    return t.select("doc_id", F.explode("keyphrases").alias("k")).select("doc_id", "k.phrase")


@query("m1_keyphrases")
def m1(spark, sf_dir):
    """Graph-ranked phrases of every chunk, then means over chunks."""
    c = phrases.chunk_phrases(_docs(spark, sf_dir), "doc_id", "text")
    return phrases.mean_scores(c, F.col("phrase"), F.col("score"))


@query("k4_top_terms", f"""
WITH w AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest({_BAG}) AS w FROM documents) GROUP BY ALL),
df AS (SELECT w, count(*) AS d FROM w GROUP BY 1), s AS (SELECT doc_id, w AS term, round(n * ln(((SELECT count(*) FROM documents) + 1.0) / (d + 1)), 6)::DOUBLE AS weight FROM w JOIN df USING (w))
SELECT doc_id, term, weight, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term)::INT AS rank FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) <= 20""")
def k4(spark, sf_dir):
    d = _docs(spark, sf_dir)
    w = written(term_counts(d, "doc_id", cl.bag_of_words(F.col("text"))), "terms")
    df = written(w.groupBy("term").agg(F.count("*").alias("d")), "frequencies")  # written, so that a frequent term's rows can be split
    total = d.agg(F.count("*").alias("total"))
    s = with_frequencies(w, df).join(F.broadcast(total)).select("doc_id", "term", F.round(F.col("n") * F.log((F.col("total") + 1.0) / (F.col("d") + 1)), 6).alias("weight"))  # one row
    return top_k(s, ["doc_id"], [F.desc("weight"), F.col("term")], 20)


@query("a12_folder_means", "SELECT source, lang, count(*) AS n, round(avg(n_chars), 6)::DOUBLE AS n_chars, round(avg(length(text)), 6)::DOUBLE AS size FROM documents GROUP BY ALL")
def a12(spark, sf_dir):
    d = _docs(spark, sf_dir).withColumn("size", F.length("text"))
    m = models.folder_means(d, ["source", "lang"], ["n_chars", "size"])
    return m.select("source", "lang", "n", F.round("n_chars", 6).alias("n_chars"), F.round("size", 6).alias("size"))


@query("a12_folder_chunks", """
WITH r AS (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY md5('1-' || doc_id), doc_id) - 1 AS k, count(*) OVER (PARTITION BY source) // 20 AS chunks FROM documents),
c AS (SELECT source, n_chars, CASE WHEN chunks = 0 THEN 0 ELSE least(k // 20, chunks - 1) + 1 END::INT AS folder_chunk FROM r)
SELECT source, folder_chunk, count(*) AS n, round(avg(n_chars), 6)::DOUBLE AS n_chars FROM c GROUP BY ALL""")
def a12c(spark, sf_dir):
    m = models.folder_means(models.folder_chunks(_docs(spark, sf_dir).select("doc_id", "source", "n_chars"), "source", "doc_id", 20), ["source", "folder_chunk"], ["n_chars"])
    return m.select("source", "folder_chunk", "n", F.round("n_chars", 6).alias("n_chars"))
