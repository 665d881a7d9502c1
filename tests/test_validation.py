"""Record rules: the edge cases of JSON strictness, presence and numbers."""

from __future__ import annotations

import base64
import json

import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tradelake.operators.messages import fault_messages, faults, sent_previews
from tradelake.operators.validation import decode_envelope, mark, route, validate
from tradelake.sources.trades import parse_raw

GOOD = {
    "transaction_ts": 1704067200,
    "symbol": "A",
    "price": 1.5,
    "amount": 2.0,
    "dollar_amount": 3.0,
    "type": "buy",
    "trans_id": 7,
}


def changed(**fields) -> str:
    return json.dumps({**GOOD, **fields})


def without(*names) -> str:
    return json.dumps({k: v for k, v in GOOD.items() if k not in names})


def raw(name: str, literal: str) -> str:
    """A good record with one value given as JSON text."""
    return changed(**{name: "@@"}).replace('"@@"', literal)


MISSING = "Missing required field: "
TYPE = "Invalid type: "
SIGN = "price and amount must be positive"
JSON = "Invalid JSON"
NOT_OBJECT = MISSING + "transaction_ts"

CASES = {
    "good": (changed(), None),
    "blanks inside": (json.dumps(GOOD, indent=2), None),
    "blanks around": (" \t\u00a0" + changed() + "\u2003\r\n", None),
    "empty": ("", JSON),
    "plain text": (GOOD["symbol"], JSON),
    "cut off": (changed()[:-1], JSON),
    "trailing text": (changed() + " trailing", JSON),
    "trailing brace": (changed() + "}", JSON),
    "two objects": (changed() + changed(), JSON),
    "bracket closed from inside": (changed() + "] {}", JSON),
    "bracket and comma": (changed() + ",2] {}", JSON),
    "trailing comma": (changed()[:-1] + ",}", JSON),
    "leading zero": (raw("amount", "01"), JSON),
    "single quotes": (changed().replace('"', "'"), JSON),
    "single quoted text": ("'text'", JSON),
    "not a number literal": (raw("price", "NaN"), JSON),
    "bad escape": (raw("symbol", '"\\q"'), JSON),
    "bad extra field": (changed()[:-1] + ', "x": tru}', JSON),
    "array": ("[1, 2]", NOT_OBJECT),
    "number": ("5", NOT_OBJECT),
    "null": ("null", NOT_OBJECT),
    "text": ('"text"', NOT_OBJECT),
    "true": ("true", NOT_OBJECT),
    "no fields": ("{}", NOT_OBJECT),
    "first missing wins": (without("type", "price"), MISSING + "price"),
    "missing before type": (json.dumps({**json.loads(without("trans_id")), "price": "x"}), MISSING + "trans_id"),
    "wrong case": (changed().replace('"price"', '"Price"'), MISSING + "price"),
    "null symbol": (changed(symbol=None), None),
    "null type": (changed(type=None), None),
    "null price": (changed(price=None), TYPE + "price"),
    "null time": (changed(transaction_ts=None), TYPE + "transaction_ts"),
    "text price": (changed(price=GOOD["symbol"]), TYPE + "price"),
    "number text price": (changed(price="1.5"), TYPE + "price"),
    "number text amount": (changed(amount="2"), TYPE + "amount"),
    "number text dollars": (changed(dollar_amount=" 12.5 "), None),
    "exponent text dollars": (changed(dollar_amount="1e3"), None),
    "nan text dollars": (changed(dollar_amount="nan"), None),
    "signed nan text dollars": (changed(dollar_amount="-NaN"), None),
    "inf text dollars": (changed(dollar_amount="-Infinity"), None),
    "suffix text dollars": (changed(dollar_amount="1d"), TYPE + "dollar_amount"),
    "number text id": (changed(trans_id=" 12 "), None),
    "signed text id": (changed(trans_id="+12"), None),
    "fraction text id": (changed(trans_id="1.5"), TYPE + "trans_id"),
    "grouped text id": (changed(trans_id="1_000"), TYPE + "trans_id"),
    "empty text id": (changed(trans_id=""), TYPE + "trans_id"),
    "fraction id": (changed(trans_id=1.7), None),
    "boolean id": (changed(trans_id=True), None),
    "boolean price": (changed(price=True), None),
    "false price": (changed(price=False), SIGN),
    "id beyond 64 bits": (changed(trans_id=10**20), TYPE + "trans_id"),
    "infinite price": (raw("price", "1e400"), None),
    "infinite id": (raw("trans_id", "1e400"), TYPE + "trans_id"),
    "object price": (changed(price={"a": 1}), TYPE + "price"),
    "array id": (changed(trans_id=[1]), TYPE + "trans_id"),
    "first type wins": (changed(trans_id="x", amount="y"), TYPE + "amount"),
    "type before sign": (changed(price=-1, trans_id="x"), TYPE + "trans_id"),
    "zero price": (changed(price=0), SIGN),
    "negative amount": (changed(amount=-0.5), SIGN),
    "negative dollars": (changed(dollar_amount=-5.0), None),
    "extra fields": (changed(extra={"deep": [1, {"x": "}"}]}), None),
    "brace in text": (changed(symbol="a}b{"), None),
    "last of two prices, good": (changed()[:-1] + ', "price": 2}', None),
    "last of two prices, bad": (changed()[:-1] + ', "price": "x"}', TYPE + "price"),
}


@pytest.fixture(scope="module")
def reasons(spark):
    rows = [(name, text) for name, (text, _) in CASES.items()]
    frame = validate(spark.createDataFrame(rows, "name string, value string"))
    return {row["name"]: row["reason"] for row in frame.collect()}


@pytest.mark.parametrize("name", CASES)
def test_reason(reasons, name):
    assert reasons[name] == CASES[name][1]


def test_typed_values_follow_the_same_rules(spark):
    lines = [changed(trans_id=" 12 ", transaction_ts=1.7, price=True, dollar_amount="1e3", symbol=5)]
    row = parse_raw(spark.createDataFrame([(x,) for x in lines], "value string")).first()
    assert (row.trans_id, row.transaction_ts, row.price, row.dollar_amount) == (12, 1, 1.0, 1000.0)
    assert row.symbol == "5"
    spaced = spark.createDataFrame([("\u00a0" + changed() + "\u2003",)], "value string")
    assert parse_raw(spaced).first().trans_id == 7


def coded(data: bytes) -> str:
    return base64.b64encode(data).decode()


def test_envelope(spark):
    rows = [
        ("good", coded(b" \t{}\n")),
        ("wide blanks", coded("  x　\x1c".encode())),
        ("bad base64", "@@@"),
        ("bad utf8", coded(b"\xff\xfe")),
        ("empty", ""),
        ("null", None),
    ]
    got = {r.name: r.value for r in decode_envelope(spark.createDataFrame(rows, "name string, data string")).collect()}
    assert got == {"good": "{}", "wide blanks": "x", "bad base64": None, "bad utf8": None, "empty": "", "null": None}


def test_bad_encoding_fails_alone(spark):
    rows = [("@@@",), (coded(b"\xff"),), (coded(changed().encode()),)]
    got = [(r.result, r.reason) for r in mark(spark.createDataFrame(rows, "data string")).collect()]
    assert got == [("ProcessingFailed", "Invalid encoding")] * 2 + [("Ok", None)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=30))
def test_routing_keeps_every_record_unchanged(spark, payloads):
    sent = [coded(p) for p in payloads] + [coded(changed().encode())]
    good, failed = route(spark.createDataFrame([(d,) for d in sent], "data string"))
    got = [r.data for r in good.collect()] + [r.data for r in failed.collect()]
    assert sorted(got) == sorted(sent)
    assert coded(changed().encode()) in [r.data for r in good.collect()]


def test_the_text_is_parsed_once(spark):
    good, _ = route(spark.createDataFrame([("x",)], "data string"))
    plan = plan_of(good.select("data"))
    assert plan.count("from_json(") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_each_fault_breaks_another_rule(spark):
    from datetime import datetime

    sent = fault_messages(spark, 1, datetime(2024, 1, 1))
    reasons = [r.reason for r in validate(sent).orderBy("seq").collect()]
    assert len(faults()) == 15 and len(set(reasons)) == 14 and None not in reasons
    assert max(len(r.payload) for r in sent_previews(sent).collect()) == 80
