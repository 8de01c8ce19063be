"""Credentials of several parts, with short secrets and endpoints of any scheme."""

import pytest

from guestlens.llm import secrets
from tests.llm.fixtures import documents

FAR = " filler" * 60
ENDPOINTS = [
    "https://db.host", "postgres://db.host:5432", "postgres://app:pw@db.host:5432", "mongodb://db.host", "amqp://mq_1.host",
    "jdbc:oracle:thin:@db.host:1521", "jdbc:mysql://db.host", "ssh alice@db.host", "host=db.example.com", "HOST: db.example.com:99",
    "10.0.0.1", "redis://[::1]:6379",
]


def reported(spark, texts):
    scan = secrets.scanned(documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]))
    rows = scan.select("doc.doc_id", "doc.text", "base", "spans", secrets.redacted(scan.doc.text, scan.spans).alias("out")).collect()
    return {r.doc_id: r for r in rows}


def test_short_secrets_and_any_endpoint_complete_a_credential(spark):
    found = reported(spark, [f"see user=admin password=hunter2 at {e} now" for e in ENDPOINTS])
    for i, endpoint in enumerate(ENDPOINTS):
        kinds = [secrets.KINDS[s.kind] for s in found[i].spans]
        assert kinds == ["user", "short", "endpoint"] and found[i].base == [], endpoint
        assert found[i].out.startswith("see [REDACTED] [REDACTED] at "), endpoint
        assert "db." not in found[i].out and "mq_1" not in found[i].out and "10.0" not in found[i].out, endpoint


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("password=hunter2", []),
        ("postgres://db.host", []),
        ("user=admin password=hunter2", []),
        ("password=hunter2 postgres://db.host", []),
        (f"user=admin{FAR} password=hunter2{FAR} postgres://db.host", []),
        ("user=admin password=hi https://db.host", []),
        ("user=admin password=correcthorsebattery amqp://mq", ["user", "assign", "endpoint"]),
    ],
)
def test_parts_alone_or_apart_are_not_reported(spark, text, kinds):
    assert [secrets.KINDS[s.kind] for s in reported(spark, [text])[0].spans] == kinds
