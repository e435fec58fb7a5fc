import pytest

from tessellum.operators.rejects import split_records
from tessellum.schema import WORD_COLUMNS

GOOD = "O,I-Liste,de,1,612,792,Font,#000,1,2,3,4,5,6,P,Document;P"
CASES = [
    (GOOD, None),
    (GOOD + "\r", None),
    (GOOD.replace("de", '"a,b"'), None),
    (GOOD.replace("de", '"dit ""x"""'), None),
    (GOOD.replace("de", '"es"t'), "quoting"),
    (GOOD.replace("de", 'e"s'), "quoting"),
    (GOOD.replace("de", '"open'), "quoting"),
    (GOOD.replace("de", '"fin"\r') , "quoting"),
    (GOOD + ",", "columns"),
    ("", "columns"),
    (None, "columns"),
    (GOOD.replace(",1,612", ",0,612"), "value"),
    (GOOD.replace(",1,612", ",-1,612"), "value"),
    (GOOD.replace(",1,612", ",١,612"), "value"),
    (GOOD.replace(",1,2,3,4", ",10,9,3,4"), "value"),
    (GOOD.replace(",1,2,3,4", ",9,10,3,4"), None),
    (GOOD.replace(",1,2,3,4", ",009,10,99999999999999999999999,100000000000000000000000"), "value"),
    (GOOD.replace(",1,2,3,4", ",009,10,9223372036854775806,9223372036854775807"), None),
    (GOOD.replace(",1,2,3,4", ",009,10,9223372036854775806,9223372036854775808"), "value"),
    (GOOD.replace(",1,612", ",2147483648,612"), None),
    (GOOD.replace(",6,P", ",,P"), None),
    (GOOD.replace(",6,P", ",6x,P"), "value"),
    (GOOD.replace("#000", ""), None),
    (GOOD.replace("#000", "#00"), "value"),
    (GOOD.replace("#000", "#00g"), "value"),
    (GOOD.replace("I-Liste", "I-liste"), "value"),
    (GOOD.replace("I-Liste", "I"), None),
    (GOOD.replace("I-Liste", ""), "value"),
    ("I" + GOOD[1:], "value"),
    (GOOD[1:], None),
    (GOOD.replace("de", ""), "value"),
    (GOOD.replace("de", "d�e"), "value"),
    (GOOD.replace("de", '"' + "x," * 100_000 + '"'), None),
    (GOOD.replace("de", '"' + '""' * 100_000), "quoting"),
]


@pytest.fixture(scope="module")
def split(spark):
    rows = [(i, i + 2, raw, "here", "r") for i, (raw, _) in enumerate(CASES)] + [(1000, 1, GOOD, "here", "r"), (1001, None, GOOD, "here", "r"), (0, 2, GOOD, "here", "r")]
    return [x.collect() for x in split_records(spark.createDataFrame(rows, "row_id int, line_no int, raw string, text string, reason string"))]


def test_reasons(split):
    valid, rejected = split
    got = {r["row_id"]: r["reason"] for r in rejected}
    assert got == {i: why for i, (_, why) in enumerate(CASES) if why}
    assert sorted(r["row_id"] for r in valid) == sorted([*[i for i, (_, why) in enumerate(CASES) if not why], 0, 1001])


def test_types(split):
    first = next(r for r in split[0] if r["row_id"] == 2)
    assert first["text"] == "a,b" and first["page"] == 1 and first["tagstack"] == "Document;P"
    assert set(WORD_COLUMNS) <= set(first.asDict())


def test_errors_name_every_rule(spark):
    df = spark.createDataFrame([(1, 2, GOOD.replace("#000", "x").replace("de", ""))], "row_id int, line_no int, raw string")
    errors = split_records(df)[1].collect()[0]["errors"]
    assert {(e["column"], e["reason"]) for e in errors} == {("rgb", "value"), ("text", "value")}


def test_empty(spark):
    valid, rejected = split_records(spark.createDataFrame([], "row_id int, line_no int, raw string"))
    assert valid.count() == rejected.count() == 0
