import json
import os

import pytest

from paperweave.sources import alert_html, mail_json, mime, store
from paperweave.streaming import ingest


def test_jsonl_import(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    lines = ["﻿" + json.dumps({"mail_uid": "m1", "subject": "New results"}), "{bad json", json.dumps({"message_id": "x", "body_text": "hello"}), "", "[1]", json.dumps({"mail_uid": "m1", "subject": "again"})]
    p.write_text("\n".join(lines), encoding="utf-8")
    v = mail_json.validate(mail_json.read_lines(spark, str(p)))
    assert [(r.line_no, r.state) for r in v.orderBy("line_no").collect()] == [(1, "valid"), (2, "invalid"), (3, "valid"), (4, "blank"), (5, "invalid"), (6, "valid")]
    assert [r.line_no for r in mail_json.quarantine(v).orderBy("line_no").collect()] == [2, 5]
    assert mail_json.line_report(v) == {"total": 6, "blank": 1, "valid": 3, "invalid": 2, "invalid_lines": [2, 5]}
    with pytest.raises(ValueError):
        mail_json.line_report(v, strict=True)
    assert tuple(mail_json.import_counts(v, spark.createDataFrame([("m1",)], "mail_uid string")).head()) == (3, 1, 1, 1)
    got = {r.mail_uid: (r.line_no, r.alert_reason) for r in mail_json.mails(v).collect()}
    assert got.pop("m1") == (1, "subject_hint_match") and len(got) == 1 and next(iter(got)).startswith("local_")


def test_json_documents_and_siblings(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"records": [{"mail_uid": "1"}, {"mail_uid": "2"}]}))
    (tmp_path / "b.json").write_text(json.dumps({"mail_uid": "3"}))
    assert [r.record.mail_uid for r in mail_json.read_document(spark, str(tmp_path / "a.json")).collect()] == ["1", "2"]
    assert [r.record.mail_uid for r in mail_json.read_document(spark, str(tmp_path / "b.json")).collect()] == ["3"]
    (tmp_path / "x.jsonl").write_text("")
    (tmp_path / "x_reconciled.jsonl").write_text("")
    assert mail_json.input_path(spark, str(tmp_path / "x.jsonl")).endswith("x_reconciled.jsonl")


def test_messages(spark, tmp_path):
    (tmp_path / "m.eml").write_bytes(b"Message-ID: <a@b>\r\nSubject: S\r\nFrom: x@y\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary=q\r\n\r\n--q\r\nContent-Type: text/plain\r\n\r\nhello\r\n--q\r\nContent-Type: text/html\r\n\r\n<p>hi</p>\r\n--q\r\nContent-Type: text/plain\r\nContent-Disposition: attachment\r\n\r\nno\r\n--q--\r\n")
    r = mime.read_messages(spark, str(tmp_path)).head()
    assert (r.message_id, r.subject, r.body_text.strip(), r.body_html.strip()) == ("<a@b>", "S", "hello", "<p>hi</p>")


def test_alert_html(spark):
    html = '<h3><a href="https://scholar.google.com/scholar_url?url=https%3A%2F%2Fexample.org%2Fpaper1&hl=en">[PDF] A long enough paper title here</a></h3><div>Author A, Author B - Journal of Tests, 2026</div><p><b>x<br><a href="https://e.org/2">A long enough PAPER title here</a><p><a href="mailto:x">Another long enough title of a mail</a><a href="https://e.org/3">short</a>'
    df = spark.createDataFrame([("m", html), ("n", None), ("o", "")], "mail_uid string, body_html string")
    got = alert_html.candidates(df).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.raw_title, r.target_url, r.resource_type_hint, r.raw_authors, r.venue_guess, r.year_guess, r.candidate_index_in_mail) == ("A long enough paper title here", "https://example.org/paper1", "pdf", "Author A, Author B", "Journal of Tests", "2026", 1)


def test_store_and_stream(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "store"))
    a = spark.createDataFrame([(1, "a", 1)], "k int, v string, o int")
    s.add("t", a, ["k"], "o")
    s.add("t", spark.createDataFrame([(1, "z", 1), (2, "b", 1)], "k int, v string, o int"), ["k"], "o")
    s.put("t", spark.createDataFrame([(2, "c", 2)], "k int, v string, o int"), ["k"], "o")
    assert sorted((r.k, r.v) for r in s.read("t").collect()) == [(1, "a"), (2, "c")]
    assert store.markdown(s.read("t").orderBy("k").select("k", "v")).splitlines()[2:] == ["| 1 | a |", "| 2 | c |"]
    folder = tmp_path / "in"
    os.makedirs(folder)
    for i in range(2):
        (folder / f"{i}.jsonl").write_text("\n".join(json.dumps({"mail_uid": u, "subject": "x", "internal_date": "1"}) for u in ("a", f"b{i}")) + "\n{bad")
        q = ingest.into_store(ingest.mail_stream(spark, str(folder)), s, "mails", str(tmp_path / "cp"))
        q.awaitTermination()
    assert sorted(r.mail_uid for r in s.read("mails").collect()) == ["a", "b0", "b1"]
