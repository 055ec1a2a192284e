"""Queries: headers, threads, duplicates, persons, edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from commlens.functions import contacts, header_rows, headers
from commlens.operators import edges, persons, threads
from commlens.plans.mails import MESSAGES_SQL, PEOPLE_SQL, customers, messages, order_mails, suppliers, table
from commlens.plans.registry import query

_LINES = """
lines AS (SELECT l_orderkey, l_linenumber, name, email FROM lineitem JOIN snames ON l_suppkey = key),
mail AS (SELECT o_orderkey AS doc_id, name, email, o_orderdate AS date, o_orderpriority FROM orders JOIN cnames ON o_custkey = key WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))"""


def _parsed(spark, sf_dir):
    return order_mails(spark, sf_dir).select("doc_id", headers.header(F.col("header_text"), strip_marks=True).alias("header"), "body")


@query("p7_p16_header", f"WITH {PEOPLE_SQL}, {_LINES} SELECT doc_id, name AS sender_name, email AS sender_email, date, false AS date_changed, 'order ' || o_orderpriority AS subject FROM mail")
def p16(spark, sf_dir):
    h = _parsed(spark, sf_dir)
    return h.select("doc_id", F.col("header.sender.name").alias("sender_name"), F.col("header.sender.email").alias("sender_email"), "header.date", "header.date_changed", "header.subject")


@query("p12_recipients", f"""WITH {PEOPLE_SQL}, {_LINES}
SELECT l_orderkey AS doc_id, l.name, l.email, CASE WHEN l_linenumber <= 3 THEN 'to' ELSE 'cc' END AS type, count(*) AS n FROM lines l JOIN mail ON doc_id = l_orderkey GROUP BY ALL""")
def p12(spark, sf_dir):
    r = _parsed(spark, sf_dir).select("doc_id", F.explode_outer("header.recipients").alias("r")).where("r IS NOT NULL")  # a plain explode would parse twice, once in a filter below it
    return r.groupBy("doc_id", F.col("r.name").alias("name"), F.col("r.email").alias("email"), F.col("r.type").alias("type")).agg(F.count("*").alias("n"))


@query("p14_clamped_dates", """
SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-10' THEN TIMESTAMP '2024-01-10' WHEN ts > TIMESTAMP '2024-01-20' THEN TIMESTAMP '2024-01-20' ELSE ts END AS date,
 coalesce(ts < TIMESTAMP '2024-01-10' OR ts > TIMESTAMP '2024-01-20', false) AS date_changed FROM events""")
def p14(spark, sf_dir):
    c = headers.clamped(F.col("ts"), "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    return table(spark, sf_dir, "events").select("event_id", c.alias("c")).select("event_id", "c.date", "c.date_changed")


# Written from the survey, not from the operator's patterns: three and three and four or five digits, marks between them or none.
_PHONE = r"\(?\b\d\d\d\)?(-|\.|/|  | | - )?\d\d\d(-|\.|/|  | | - )?\d\d\d\d\d?\b"


@query("p26_phones", f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
p AS (SELECT doc_id, lower(line) AS line, regexp_extract(line, '{_PHONE}') AS number FROM l WHERE regexp_matches(line, '{_PHONE}'))
SELECT doc_id, CASE WHEN regexp_matches(line, 'off|ph|tel|dir|voice') THEN 'office' WHEN regexp_matches(line, 'cell|mob') THEN 'cell' WHEN regexp_matches(line, 'fax|fx|facs') THEN 'fax' WHEN contains(line, 'home') THEN 'home' ELSE 'office' END AS kind,
 number, count(*) AS n FROM p GROUP BY ALL""")
def p26(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(contacts.phones(F.col("text"))).alias("p"))
    return rows.groupBy("doc_id", F.col("p.kind").alias("kind"), F.col("p.number").alias("number")).agg(F.count("*").alias("n"))


@query("p27_emails", f"SELECT doc_id, email, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{contacts.MAIL}')) AS email FROM documents) GROUP BY ALL")
def p27(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(contacts.emails(F.col("text"))).alias("email")).groupBy("doc_id", "email").agg(F.count("*").alias("n"))


@query("p28_aliases", f"WITH {PEOPLE_SQL} SELECT key, nation AS alias FROM snames WHERE length('s' || key) >= 3")
def p28(spark, sf_dir):
    s = suppliers(spark, sf_dir).select("key", F.lower("last").alias("n"), "email")
    local = F.substring_index("email", "@", 1)
    sig = F.concat(F.lit("Regards\n\nOffice: 555-123-4567\n"), F.substring(local, 1, 3), F.lit(" "), F.col("n"))
    rows = s.select("key", F.explode(contacts.aliases(sig, F.col("email"))).alias("alias"))
    return rows.select("key", F.regexp_replace("alias", "^[^ ]* ", "").alias("alias"))


@query("p29_writes_to", f"WITH {PEOPLE_SQL}, {_LINES} SELECT DISTINCT l_orderkey AS doc_id, lines.email FROM lines JOIN mail ON doc_id = l_orderkey")
def p29(spark, sf_dir):
    return _parsed(spark, sf_dir).select("doc_id", F.explode_outer(F.array_distinct(F.transform("header.recipients", lambda r: r["email"]))).alias("email")).where("email IS NOT NULL")


@query("p30_organisation", f"""
WITH d AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{contacts.MAIL}')) AS email FROM documents), l AS (SELECT email, string_split(string_split(email, '@')[2], '.') AS labels FROM d),
o AS (SELECT email, lower(labels[-2]) AS org FROM l WHERE len(labels) > 1)
SELECT upper(org[1]) || org[2:] AS organisation, count(*) AS n FROM o WHERE org NOT IN ('gmail', 'yahoo') GROUP BY 1""")
def p30(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.explode(contacts.emails(F.col("text"))).alias("email")).distinct()
    return rows.select(contacts.organisation(F.col("email"), ["gmail", "yahoo"]).alias("organisation")).where("organisation IS NOT NULL").groupBy("organisation").agg(F.count("*").alias("n"))


_FIRST_LINE = "coalesce(nullif(split_part(text, chr(10), 1), ''), '')"


@query("a1_longest_of_each", f"""
WITH k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, {_FIRST_LINE} ORDER BY length(text) DESC, doc_id) AS r FROM documents)
SELECT doc_id, lang, source, n_chars FROM k WHERE r = 1""")
def a1(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    first = F.coalesce(F.substring_index("text", "\n", 1), F.lit(""))
    own = d.select("doc_id", "lang", "source", "n_chars", first.alias("first"), F.length("text").alias("size"))
    return threads.longest_of_each(own, [F.col("lang"), F.col("source"), F.col("first")], F.col("size"), F.col("doc_id")).select("doc_id", "lang", "source", "n_chars")


@query("a2_content_id", "SELECT md5(concat_ws(chr(31), coalesce(lang, ''), coalesce(source, ''), coalesce(text, ''))) AS content_id, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1")
def a2(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.groupBy(threads.content_id(F.col("lang"), F.col("source"), F.col("text")).alias("content_id")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query("w1_thread_links", """
SELECT conv_id, turn, lag(conv_id || '_' || turn) OVER w AS successor, lead(conv_id || '_' || turn) OVER w AS predecessor FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def w1(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return threads.thread_links(c, "conv_id", "turn", F.concat_ws("_", "conv_id", "turn")).select("conv_id", "turn", "successor", "predecessor")


@query("w2_part_ids", """
WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS part, generate_subscripts(string_split(text, chr(10) || chr(10)), 1) - 1 AS i, len(string_split(text, chr(10) || chr(10))) AS n FROM documents)
SELECT doc_id, CASE WHEN n > 1 THEN doc_id || '_part_' || i || '_of_' || n ELSE doc_id::VARCHAR END AS part_id, length(part)::INT AS size FROM p""")
def w2(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.split("text", "\n\n").alias("p"))
    rows = d.select("doc_id", F.size("p").alias("n"), F.posexplode("p").alias("i", "part"))
    return rows.select("doc_id", F.when(F.col("n") > 1, F.concat_ws("_", "doc_id", F.lit("part"), "i", F.lit("of"), "n")).otherwise(F.col("doc_id").cast("string")).alias("part_id"), F.length("part").alias("size"))


def _quoted(spark, sf_dir):
    """Each order's mail as one that quotes itself."""
    m = order_mails(spark, sf_dir)
    own = F.regexp_replace("header_text", "(?s)^-+[^\n]*\n", "")
    quoted = F.concat(F.lit("An answer.\n\n-----Original Message-----\n"), own, F.lit("\n\n"), F.col("body"))
    return m.select(F.col("doc_id").cast("string").alias("doc_id"), F.lit("").alias("path"), F.array().cast("array<string>").alias("attachments"), own.alias("header_text"), quoted.alias("body"))


@query("t1_split_mails", f"WITH {PEOPLE_SQL}, {_LINES} SELECT doc_id, p AS pos, CASE p WHEN 0 THEN doc_id || '_part_0_of_2' ELSE doc_id || '_part_1_of_2' END AS part_id, email AS sender_email FROM mail, (VALUES (0), (1)) v(p)")
def t1(spark, sf_dir):
    parts = threads.split_mails(_quoted(spark, sf_dir)).select(F.col("doc_id").alias("part_id"), header_rows.sender_of(F.col("header_text"))["email"].alias("sender_email"))
    ids = F.regexp_extract("part_id", "^([0-9]+)_part_([0-9]+)_of", 1).cast("long"), F.regexp_extract("part_id", "^([0-9]+)_part_([0-9]+)_of", 2).cast("int")
    return parts.select(ids[0].alias("doc_id"), ids[1].alias("pos"), "part_id", "sender_email")


@query("t2_connected_threads", f"WITH {PEOPLE_SQL}, {_LINES} SELECT doc_id, p AS pos, doc_id || '_part_' || p || '_of_2' AS part_id, CASE p WHEN 1 THEN doc_id || '_part_0_of_2' END AS successor, CASE p WHEN 0 THEN doc_id || '_part_1_of_2' END AS predecessor, email AS sender_email FROM mail, (VALUES (0), (1)) v(p)")
def t2(spark, sf_dir):
    whole = threads.split_mails(_quoted(spark, sf_dir), connected=True)
    rows = whole.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode("parts").alias("pos", "p"))
    return rows.select("doc_id", "pos", F.col("p.doc_id").alias("part_id"), "p.successor", "p.predecessor", header_rows.sender_of(F.col("p.header_text"))["email"].alias("sender_email"))


@query("a3_merged_contacts", f"""WITH {PEOPLE_SQL}, {_LINES},
m AS (SELECT doc_id, name, email, '(555) 123-' || lpad((doc_id % 10000)::VARCHAR, 4, '0') AS office, '555.' || (100 + doc_id % 7) || '.1234' AS fax, 'x' || doc_id % 5 || '@home.example.net' AS own FROM mail),
w AS (SELECT mail.email, list_sort(list(DISTINCT l.email)) AS writes_to FROM lines l JOIN mail ON doc_id = l_orderkey GROUP BY 1)
SELECT m.email, any_value(name) AS name, count(*) AS source_count, len(list(DISTINCT office))::INT AS n_office, list_sort(list(DISTINCT office))[1] AS first_office, array_to_string(list_sort(list(DISTINCT fax)), ' ') AS fax,
 array_to_string(list_sort(list(DISTINCT own)), ' ') AS own, len(list(DISTINCT office || fax || own))::INT AS n_signatures, any_value(len(writes_to))::INT AS n_writes_to, any_value(array_to_string(writes_to, ' ')) AS writes_to FROM m JOIN w ON w.email = m.email GROUP BY 1""")
def a3_contacts(spark, sf_dir):
    k = F.col("doc_id")
    sig = F.concat(F.lit("Office: (555) 123-"), F.lpad((k % 10000).cast("string"), 4, "0"), F.lit("\nFax 555."), (100 + k % 7).cast("string"), F.lit(".1234\nx"), (k % 5).cast("string"), F.lit("@home.example.net"))
    mails = _parsed(spark, sf_dir).select(sig.alias("signature"), F.col("header.sender.email").alias("sender_email_address"), F.col("header.sender.name").alias("sender_name"), F.col("header.recipients").alias("recipients"))
    p = persons.merged_contacts(persons.contacts(mails))
    return p.select(
        F.col("email_addresses")[0].alias("email"), F.map_keys("identifying_names")[0].alias("name"), "source_count", F.size("phone_numbers_office").alias("n_office"), F.col("phone_numbers_office")[0].alias("first_office"),
        F.array_join("phone_numbers_fax", " ").alias("fax"), F.array_join("email_addresses_from_signature", " ").alias("own"), F.size("signatures").alias("n_signatures"), F.size("writes_to").alias("n_writes_to"), F.array_join("writes_to", " ").alias("writes_to"),
    )


_RECORDS = f"""
WITH {PEOPLE_SQL}, {_LINES}, rec AS (SELECT name, email, doc_id FROM mail UNION ALL SELECT l.name, l.email, doc_id FROM lines l JOIN mail ON doc_id = l_orderkey)"""


@query("t3_records", f"{_RECORDS} SELECT email, count(*) AS n FROM rec GROUP BY 1")
def t3(spark, sf_dir):
    return persons.records(_parsed(spark, sf_dir)).groupBy("email").agg(F.count("*").alias("n"))


@query("a3_a5_persons_by_address", f"""{_RECORDS},
w AS (SELECT mail.email, count(DISTINCT l.email) AS writes_to FROM lines l JOIN mail ON doc_id = l_orderkey GROUP BY 1)
SELECT rec.email, max(rec.name) AS identifying_name, count(*) AS source_count, coalesce(max(writes_to), 0)::INT AS n_writes_to, 'Example' AS organisation FROM rec LEFT JOIN w ON w.email = rec.email GROUP BY 1""")
def a3(spark, sf_dir):
    p = persons.by_address(persons.records(_parsed(spark, sf_dir)), ["gmail"])
    return p.select(F.get("email_addresses", F.lit(0)).alias("email"), "identifying_name", "source_count", F.size("writes_to").alias("n_writes_to"), "organisation")


@query("a4_a6_persons_by_name", f"""{_RECORDS}
SELECT name AS identifying_name, count(DISTINCT email)::INT AS n_addresses, count(*) AS source_count, list_sort(list(DISTINCT email))[1] AS first_address FROM rec GROUP BY 1""")
def a6(spark, sf_dir):
    p = persons.by_name(persons.by_address(persons.records(_parsed(spark, sf_dir)), ["gmail"]))
    name = persons.fallback_name(F.col("identifying_name"), F.col("aliases"), F.col("email_addresses"))
    return p.select(name.alias("identifying_name"), F.size("email_addresses").alias("n_addresses"), "source_count", F.get("email_addresses", F.lit(0)).alias("first_address"))


@query("a14_source_counts", f"{_RECORDS}, n AS (SELECT email, count(*) AS source_count FROM rec GROUP BY 1) SELECT source_count, count(*) AS persons FROM n GROUP BY 1")
def a14(spark, sf_dir):
    return persons.by_address(persons.records(_parsed(spark, sf_dir)), []).groupBy("source_count").agg(F.count("*").alias("persons"))


@query("j1_lookup", f"""
WITH {PEOPLE_SQL}, byname AS (SELECT name, min(email) AS email FROM cnames GROUP BY 1), byalias AS (SELECT nation, min(email) AS email FROM cnames GROUP BY 1)
SELECT e.event_id, coalesce(a.email, b.email, c.email, '') AS person FROM events e
LEFT JOIN cnames a ON e.user_id % 3 = 0 AND a.key = e.user_id
LEFT JOIN byname b ON e.user_id % 3 = 1 AND b.name = (SELECT name FROM cnames WHERE key = e.user_id)
LEFT JOIN byalias c ON e.user_id % 3 = 2 AND c.nation = (SELECT nation FROM cnames WHERE key = e.user_id)""")
def j1(spark, sf_dir):
    c = customers(spark, sf_dir)
    people = c.select("key", F.concat_ws(" ", "first", "last").alias("name"), F.lower("last").alias("alias"), "email")
    table_ = persons.lookup(people, [("email", F.array("email")), ("name", F.array("name")), ("alias", F.array("alias"))], "email", "email")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id").join(people, F.col("user_id") == F.col("key"), "left")
    k = F.col("user_id") % 3
    keys = [F.when(k == 0, F.col("email")), F.when(k == 1, F.col("name")), F.when(k == 2, F.col("alias"))]
    return persons.resolved(ev.drop("email_"), table_, keys, "person").select("event_id", "person")


@query("s10_edge_rows", f"WITH {MESSAGES_SQL} SELECT src, dst, mail_id, coalesce(epoch_us(t) / 1e6, 0.0)::DOUBLE AS t FROM msg")
def s10(spark, sf_dir):
    m = messages(spark, sf_dir)
    return edges.matched(edges.prepared(m, F.col("src"), F.array("dst"), F.col("t"), F.col("mail_id")))


@query("s11_a11_edges", f"WITH {MESSAGES_SQL} SELECT src, dst, count(*) AS volume, min(mail_id) AS first_mail, sum(epoch_us(t) / 1000000)::BIGINT AS time_sum FROM msg WHERE src IN (SELECT 'c' || c_custkey FROM customer UNION ALL SELECT 's' || s_suppkey FROM supplier) GROUP BY 1, 2")
def a11(spark, sf_dir):
    nodes = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node")).unionAll(table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))))
    m = edges.prepared(messages(spark, sf_dir), F.col("src"), F.array("dst"), F.col("t"), F.col("mail_id"))
    e = edges.edges(edges.matched(m, nodes))
    return e.select("src", "dst", "volume", F.array_min("mail_list").alias("first_mail"), F.aggregate("time_list", F.lit(0.0), lambda a, x: a + x).cast("long").alias("time_sum"))


@query("f5_f6_edges_filtered", f"WITH {MESSAGES_SQL} SELECT src, dst, count(*) AS volume FROM msg WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY 1, 2 HAVING count(*) > 1")
def f5(spark, sf_dir):
    return edges.without_loops(edges.weights(messages(spark, sf_dir).where("src <> '' AND dst <> ''"))).where("volume > 1")


@query("g17_undirected", f"WITH {MESSAGES_SQL} SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM msg WHERE src <> dst")
def g17(spark, sf_dir):
    return edges.undirected(messages(spark, sf_dir))


@query("u1_u3_sets", """
SELECT doc_id, 'both' AS part FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'unlabelled' FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)""")
def u1(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")  # noqa: E741
    return d.intersect(l).withColumn("part", F.lit("both")).unionByName(d.subtract(l).withColumn("part", F.lit("unlabelled")))


@query("f2_f7_lists", f"""
WITH m AS (SELECT doc_id, list_filter(regexp_extract_all(text, '{contacts.MAIL}'), lambda x: x <> '') AS mails FROM documents)
SELECT doc_id, len(mails) > 0 AS has_address, len(mails)::INT AS n FROM m WHERE mails IS NOT NULL""")
def f2(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", persons.without_empties(contacts.emails(F.col("text"))).alias("mails"))
    return d.select("doc_id", (F.size("mails") > 0).alias("has_address"), F.size("mails").alias("n"))
