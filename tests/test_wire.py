"""Messages: what is read, what is null, and what is rejected."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from helpers import key, messages, order, plan_of, product
from pyspark.sql import functions as F

from tillstream.entities import CUSTOMERS, ENTITIES, ORDERS, PRODUCTS, Entity
from tillstream.functions.wire import (
    REASON,
    accepted,
    decode,
    grade_lenient,
    grade_strict,
    json_message,
    rejected,
)
from tillstream.operators.routing import grade_by_topic, live_messages, records_of

SAMPLE = Entity(
    "sample", "product_id string, price float, stock int, ts timestamp", "product_id"
)


def parsed(spark, text):
    row = decode(messages(spark, "t", [text]), SAMPLE).first()
    return row.product_id, row.price, row.stock, row.ts


def test_full_message_and_unknown_field(spark):
    text = '{"product_id":"a","price":19.99,"stock":3,"ts":"2024-01-02T03:04:05","zz":1}'
    got = parsed(spark, text)
    assert got[0] == "a" and got[2] == 3 and got[3] == datetime(2024, 1, 2, 3, 4, 5)
    assert got[1] == pytest.approx(19.99, abs=1e-6) and got[1] != 19.99  # 32 bits


@pytest.mark.parametrize(
    "text", ['{"product_id":', "not json", "", "null", "[1]", '[{"stock":1},{"stock":2}]', "{}"]
)
def test_unreadable_text_is_one_row_of_nulls(spark, text):
    frame = decode(messages(spark, "t", [text]), SAMPLE)
    assert [tuple(r) for r in frame.collect()] == [(None, None, None, None)]


@pytest.mark.parametrize(
    "field, expected",
    [
        ('"price":"x"', ("a", None, None, None)),
        ('"stock":"x"', ("a", None, None, None)),
        ('"stock":3.0', ("a", None, None, None)),
        ('"stock":3000000000', ("a", None, None, None)),
        ('"ts":"02/01/2024"', ("a", None, None, None)),
        ('"ts":"2024-01-02"', ("a", None, None, datetime(2024, 1, 2))),
        ('"ts":"2024-01-02 03:04:05"', ("a", None, None, datetime(2024, 1, 2, 3, 4, 5))),
        ('"ts":"2024-01-02T03:04:05Z"', ("a", None, None, datetime(2024, 1, 2, 3, 4, 5))),
        (
            '"ts":"2024-01-02T03:04:05.123456"',
            ("a", None, None, datetime(2024, 1, 2, 3, 4, 5, 123456)),
        ),
        ('"ts":1704164645', ("a", None, None, datetime(2024, 1, 2, 3, 4, 5))),
    ],
)
def test_wrong_type_nulls_only_its_field(spark, field, expected):
    assert parsed(spark, '{"product_id":"a",' + field + "}") == expected


def test_number_as_key_is_read_as_text(spark):
    assert parsed(spark, '{"product_id":7}')[0] == "7"


def reasons(frame) -> list:
    return [r[0] for r in frame.orderBy("offset").select(REASON).collect()]


def test_strict_contract(spark):
    missing = product(1)
    del missing["title"]
    values = [
        product(1),
        product(2, title=None),
        "{bad",
        "",
        "null",
        "[1]",
        missing,
        product(3, price="19.99x"),
        product(4, stock="many"),
        product(5, product_id="nope"),
        product(6, product_id=None),
        product(7, product_id="{" + key(7).upper() + "}"),
    ]
    graded = grade_strict(messages(spark, PRODUCTS.topic, values), PRODUCTS)
    assert reasons(graded) == [
        None,
        None,
        "not a JSON object",
        "not a JSON object",
        "not a JSON object",
        "not a JSON object",
        "missing field",
        "wrong type",
        "wrong type",
        "invalid product_id",
        "invalid product_id",
        None,
    ]


def test_lenient_contract_keeps_what_has_a_key(spark):
    values = [
        order(1),
        order(2, quantity="two"),
        order(3, product_id=None),
        order(4, product_id="nope"),
        order(5, order_id=None),
        "{bad",
        {"order_id": key(6)},
    ]
    graded = grade_lenient(messages(spark, ORDERS.topic, values), ORDERS)
    assert reasons(graded) == [
        None,
        None,
        None,
        "invalid product_id",
        "missing order_id",
        "missing order_id",
        None,
    ]
    assert accepted(graded).count() + rejected(graded).count() == len(values)


def test_filter_does_not_parse_twice(spark):
    frame = decode(messages(spark, PRODUCTS.topic, [product(1)]), PRODUCTS).filter("stock > 0")
    assert plan_of(frame).count("from_json") == 1


def test_encoding_keeps_nulls_and_microseconds(spark):
    frame = spark.sql(
        "select cast(null as string) as a, timestamp'2024-01-02 03:04:05.000007' as b, "
        "timestamp_ntz'2024-01-02 03:04:05' as c, date'2024-01-02' as d, 1.5d as e"
    )
    text = frame.select(json_message(frame)).first()[0]
    assert json.loads(text) == {
        "a": None,
        "b": "2024-01-02T03:04:05.000007",
        "c": "2024-01-02T03:04:05",
        "d": "2024-01-02",
        "e": 1.5,
    }


def test_date_text_of_a_customer_becomes_midnight(spark):
    value = {"customer_id": key(1), "signup_date": "2023-05-06"}
    row = decode(messages(spark, CUSTOMERS.topic, [value]), CUSTOMERS).first()
    assert row.signup_date == datetime(2023, 5, 6)


def test_routing_by_topic(spark):
    mixed = (
        messages(spark, PRODUCTS.topic, [product(1), None, "{bad"])
        .unionByName(messages(spark, ORDERS.topic, [order(1), order(2, customer_id=None)]))
        .unionByName(messages(spark, "elsewhere", [product(9)]))
    )
    assert live_messages(mixed).count() == 5
    graded = grade_by_topic(mixed, ENTITIES.values()).cache()
    assert graded.count() == 4
    assert [r.product_id for r in records_of(graded, PRODUCTS).collect()] == [key(1)]
    assert [r.order_id for r in records_of(graded, ORDERS).collect()] == [key(1)]
    assert records_of(graded, CUSTOMERS).count() == 0
    bad = {(r.topic, r.reason) for r in rejected(graded).select("topic", F.col(REASON)).collect()}
    assert bad == {
        (PRODUCTS.topic, "not a JSON object"),
        (ORDERS.topic, "invalid customer_id"),
    }
    graded.unpersist()


@pytest.mark.parametrize(
    "spoil, reason",
    [
        (lambda text: " " + text + "\n", None),
        (lambda text: text + " and more", "not one JSON document"),
        (lambda text: text + "}{", "not one JSON document"),
        (lambda text: text + text, "not one JSON document"),
        (lambda text: text + "," + text, "not one JSON document"),
        (lambda text: text + "] x", "not one JSON document"),
        (lambda text: text.replace('"', "'"), "not one JSON document"),
        (lambda text: text.replace("19.99", "1e999"), "number out of range"),
        (lambda text: text.replace("19.99", "-1e60"), "number out of range"),
        (lambda text: text.replace("19.99", '"Infinity"'), "number out of range"),
    ],
)
def test_what_is_no_single_document_is_refused_on_both_strict_ways(spark, spoil, reason):
    sent = messages(spark, PRODUCTS.topic, [spoil(json.dumps(product(1)))])
    assert reasons(grade_strict(sent, PRODUCTS)) == [reason]
    assert reasons(grade_by_topic(sent, ENTITIES.values())) == [reason]


def test_bytes_that_are_no_text_are_refused(spark):
    sent = messages(spark, PRODUCTS.topic, [product(1)])
    broken = F.concat(F.col("value").substr(1, 30), F.unhex(F.lit("FF")), F.col("value").substr(31, 999))
    sent = sent.withColumn("value", broken)
    assert reasons(grade_strict(sent, PRODUCTS)) == ["not UTF-8 text"]
    assert reasons(grade_by_topic(sent, ENTITIES.values())) == ["not UTF-8 text"]


def test_strict_grading_parses_each_message_once(spark):
    sent = messages(spark, PRODUCTS.topic, [product(1)])
    for frame in (grade_strict(sent, PRODUCTS), grade_by_topic(sent, ENTITIES.values())):
        plan = plan_of(accepted(frame))
        assert plan.count("parseJson") + plan.count("parse_json") == 1 and "from_json" not in plan


def test_the_type_of_a_field_is_asked_for_once(spark):
    frame = messages(spark, ORDERS.topic, [order(1)])
    one, all_of = grade_strict(frame, ORDERS), grade_by_topic(frame, ENTITIES.values())
    for graded, entities in ((one, [ORDERS]), (all_of, ENTITIES.values())):
        asked = plan_of(graded).count("SchemaOfVariant.schemaOfVariant")
        assert asked == sum(len(e.columns) for e in entities)
