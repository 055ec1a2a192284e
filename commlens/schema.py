"""Explicit schemas of the data model."""

from __future__ import annotations

CONTACT = "struct<name:string,email:string>"
RECIPIENT = "struct<name:string,email:string,type:string>"
HEADER = f"struct<sender:{CONTACT},recipients:array<{RECIPIENT}>,date:timestamp,date_changed:boolean,subject:string>"
RAW = "doc_id string, path string, raw string"
MAIL = f"{RAW}, attachments array<string>, header {HEADER}, body string, predecessor string, successor string"
PERSON = (
    "email_addresses array<string>, identifying_name string, names map<string,bigint>, source_count bigint, organisation string, aliases array<string>, "
    "aliases_from_signature array<string>, email_addresses_from_signature array<string>, phone_numbers_office array<string>, phone_numbers_cell array<string>, "
    "phone_numbers_fax array<string>, phone_numbers_home array<string>, writes_to array<string>, signatures array<string>"
)
EDGE = "src string, dst string, volume bigint, mail_list array<string>, time_list array<double>"
TOPIC = "doc_id string, topic_id int, topic_rank int, topic_conf double, terms array<struct<term:string,weight:double>>"
