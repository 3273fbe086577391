"""Secret scans against plain regular expressions."""

from __future__ import annotations

import hashlib
import re

from riskmill.llm import secrets
from riskmill.llm.queries import QUERIES, SQL

KINDS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}


def slow_base(text: str) -> list[tuple]:
    found = []
    for order, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        found += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return sorted(found)


ODD = [
    "token=token: abcdef123", 'a 😀 "API_KEY" : "abc.def=" x', "Password:abcde", "pAssWd = abcdef\ttoken=", "AKIA" + "A" * 15, "xAKIA" + "Z9" * 9,
    "AKIAAKIA" + "B" * 30, "f" * 23, "g" + "0f" * 12 + "g", "secret==abc", "apikey='", "token :\n abcdefgh", "tokentoken=secret=abcdef",
    "-----BEGIN RSA PRIVATE KEY----- x", "ghp_" + "a1" * 20, "xoxb-1234567890-x", "eyJ" + "a" * 10 + ".eyJ" + "b" * 10 + "." + "c" * 10, "é" * 50 + "secret: 0123456789abcdef01234567",
    "", None, "SECRET=\"abcdefgh\" password = 'AKIA" + "Q" * 20 + "'",
]


def documents(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, ODD[1], "y"), (1, ODD[0], "z")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, kinds string"), rows


def test_odd_texts(spark):
    docs, rows = documents(spark)
    out = secrets.secret_report(docs).collect()
    wanted = []
    for i, text, _ in rows:
        base = slow_base(text)
        count = lambda kind: sum(s[3] == kind for s in base)  # noqa: E731, B023
        joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in base)
        wanted.append((i, count("assign"), count("access"), count("hex"), hashlib.sha256(joined.encode()).hexdigest()))
    assert sorted((tuple(r)[:5] for r in out), key=repr) == sorted(wanted, key=repr)
    spans = {r.doc_id: r.spans for r in out}
    assert spans[13].startswith("private_key:0:") and spans[14] == "git_token:0:44,hex:4:44" and spans[15] == "chat_token:0:17"
    assert spans[16].startswith("web_token:0:")
    assert secrets.secret_report(docs.limit(0)).count() == 0


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]{24,}") == secrets.ANYTHING
    assert secrets.trigram_query("ab?c") == secrets.ANYTHING
    assert secrets.trigram_query("abcd(x|y)") == {frozenset({"abc", "bcd", "cdx"}), frozenset({"abc", "bcd", "cdy"})}
    assert secrets.trigram_query("abc.*Def") == {frozenset({"abc", "def"})}
    for rule in secrets.RULES:
        for text in filter(None, ODD):
            if re.search(rule.pattern, text):
                assert any(all(t in text.lower() for t in clause) for clause in secrets.trigram_query(rule.pattern))


def test_redaction(spark):
    docs, rows = documents(spark)
    out = secrets.redact_secrets(docs).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"doc_id", "text", "kinds"}
    text = {(r.doc_id, r.kinds): r.text for r in out}
    assert text[20, "x"] == "[secret]\" [secret]'" and text[18, "x"] == "" and text[19, "x"] is None
    for r in out:
        assert not slow_base(r.text or "")


def test_query_equals_sql(spark, small):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{small}/documents.parquet'")
    cursor = con.execute(SQL["op10_secret_scans"])
    names = [d[0] for d in cursor.description]
    got = QUERIES["op10_secret_scans"](spark, small).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cursor.fetchall())


def test_redaction_keeps_clashing_columns(spark):
    rows = [(1, "password = hunter22 here", "a", "b", "c", 1), (None, None, "d", None, "f", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _id string, _clean string, slot0 string, n_chars int")
    got = sorted(secrets.redact_secrets(docs).collect(), key=lambda r: r.slot0)
    assert [(r._id, r._clean, r.slot0) for r in got] == [("a", "b", "c"), ("d", None, "f")]
    assert "hunter22" not in got[0].text and got[0].n_chars == len(got[0].text) and got[1].text is None


def test_redaction_deals_texts_out_once(spark):
    import os

    docs, _ = documents(spark)
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    out = secrets.redact_secrets(docs)
    assert set(os.listdir(folder)) == before  # no table of spans that the texts are joined with again
    tree = out._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join LeftOuter" in line for line in tree.splitlines()) == 1
