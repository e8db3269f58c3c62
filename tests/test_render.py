"""Renderers, separators and path names against expected bytes."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidewire.functions import render as R
from tidewire.functions.paths import resolve_path, safe_segment
from tidewire.operators.validate import validate_jsonl
from tidewire.sources.messages import MESSAGE, parse_jsonl

EVENING = datetime.datetime(2024, 7, 9, 18, 30, 5, 250_000, tzinfo=datetime.UTC)
ORDER = ("orders.eu", 3, 7001, bytearray(b"customer 17"), bytearray(b'{"sum": 12}'), {"trace": "9f"}, EVENING, False, "10.1.2.3:9", None)
TOMBSTONE = ("orders.eu", 3, 7002, None, None, {}, None, True, "c", None)
EMPTY_KEY = ("orders.eu", 3, 7003, bytearray(b""), bytearray(b"x"), {}, None, False, "c", None)


def rendered(spark, rows, fmt, **options):
    df = spark.createDataFrame(rows, MESSAGE)
    return [bytes(r[0]) for r in R.render(df, fmt, **options).select("payload").collect()]


def generated(seed, n=40):
    """Message rows with nulls, empty and odd bytes."""
    rng = random.Random(seed)
    some = lambda: rng.choice([None, b"", b"plain", bytes(rng.randrange(256) for _ in range(rng.randrange(9)))])
    for _ in range(n):
        key, value = some(), some()
        stamp = None if rng.random() < 0.3 else datetime.datetime.fromtimestamp(rng.randrange(2_000_000_000_000) / 1000, datetime.UTC)
        yield rng.choice(["", "x.y", "ü/ö"]), rng.randrange(9), rng.randrange(1 << 40), key and bytearray(key) if key else key, value and bytearray(value) if value else value, {}, stamp, value is None, "c", None


def millis(stamp):
    return -1 if stamp is None else round(stamp.timestamp() * 1000)


#: What each verb stands for, of (topic, partition, offset, key, value, headers, timestamp, ...).
MEANING = {
    "o": lambda r: str(r[2]).encode(),
    "S": lambda r: str(len(r[4] or b"")).encode(),
    "t": lambda r: r[0].encode(),
    "K": lambda r: str(-1 if r[3] is None else len(r[3])).encode(),
    "s": lambda r: bytes(r[4] or b""),
    "T": lambda r: str(millis(r[6])).encode(),
    "k": lambda r: bytes(r[3] or b""),
    "p": lambda r: str(r[1]).encode(),
}


@pytest.mark.parametrize("verb", MEANING)
def test_a_verb(spark, verb):
    rows = list(generated(ord(verb)))
    found = rendered(spark, rows, "template", text=f"<%{verb}>")
    assert found == [b"<" + MEANING[verb](r) + b">" for r in rows]


def test_random_templates(spark):
    """Verbs, escapes and plain text in any order, against a reading from left to right."""
    rng, rows = random.Random(6), list(generated(1, 5))
    plain = {"%%": b"%", "\\n": b"\n", "\\r": b"\r", "\\t": b"\t", "\\0": b"\0", "\\\\": b"\\", "\\w": b"\\w", "é": "é".encode(), " x": b" x"}
    for _ in range(12):
        parts = [rng.choice([*plain, *(f"%{v}" for v in MEANING)]) for _ in range(rng.randrange(1, 12))]
        wanted = [b"".join(plain[p] if p in plain else MEANING[p[1]](r) for p in parts) for r in rows]
        assert rendered(spark, rows, "template", text="".join(parts)) == wanted


@pytest.mark.parametrize("end", ["%", "\\"])
def test_half_a_verb_or_escape_at_the_end_is_text(spark, end):
    assert rendered(spark, [ORDER], "template", text=f"%p{end}") == [f"3{end}".encode()]


def test_unknown_verb():
    with pytest.raises(ValueError, match="unknown verb"):
        list(R._pieces("%z"))


def test_jsonl(spark):
    full, bare, empty = rendered(spark, [ORDER, TOMBSTONE, EMPTY_KEY], "jsonl")
    assert full == b'{"topic":"orders.eu","partition":3,"offset":7001,"key":"customer 17","key_encoding":"utf-8","value":"{\\"sum\\": 12}","value_encoding":"utf-8","headers":{"trace":"9f"},"timestamp":"2024-07-09 18:30:05.25 +0000 UTC","client_addr":"10.1.2.3:9"}\n'
    assert bare == b'{"topic":"orders.eu","partition":3,"offset":7002,"value":"","value_encoding":"utf-8","client_addr":"c"}\n'
    assert b'"key":"","key_encoding":"utf-8"' in empty


def test_times_are_utc_in_any_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert b"2024-07-09 18:30:05.25 +0000 UTC" in rendered(spark, [ORDER], "jsonl")[0]
        lines = R.render(spark.createDataFrame([ORDER], MESSAGE), "jsonl").selectExpr("CAST(payload AS STRING) AS line")
        assert parse_jsonl(lines).select(F.unix_millis("timestamp")).first()[0] == 1720549805250
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_jsonl_long_base64_is_one_line(spark):
    row = (*ORDER[:4], bytearray(range(200)), *ORDER[5:])
    assert rendered(spark, [row], "jsonl", value_base64=True)[0].count(b"\n") == 1


@pytest.mark.parametrize(("text", "hex_text", "none", "wanted"), [("\\n", "", False, b"\n"), ("\\r\\n", "", False, b"\r\n"), ("", "00ff", False, b"\0\xff"), ("x", "", True, b""), ("\\q\\", "", False, b"\\q\\")])
def test_separator(text, hex_text, none, wanted):
    assert R.separator(text, hex_text, none) == wanted


@pytest.mark.parametrize("wrong", [{"fmt": "xml"}, {"fmt": "binary", "text": "%s"}, {"fmt": "jsonl", "after": b""}, {"fmt": "template"}])
def test_options_of_another_format(spark, wrong):
    with pytest.raises(ValueError, match="format|take|needs"):
        R.render(spark.createDataFrame([ORDER], MESSAGE), **wrong)


def safe_name(name):
    """The rule in plain Python: the last name of the path once . and .. are taken out."""
    left = []
    for part in name.split("/"):
        if part in ("", "."):
            continue
        if part != "..":
            left.append(part)
        elif left and left[-1] != "..":
            left.pop()
        elif not name.startswith("/"):
            left.append("..")
    return left[-1] if left and left[-1] != ".." else "_"


def test_safe_segment(spark):
    rng = random.Random(4)
    names = {"".join(rng.choice(["/", "/", "..", ".", "q", "é", "\\", ":", " ", "...", "Z9"]) for _ in range(rng.randrange(9))) for _ in range(600)}
    df = spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    found = {r[0]: r[1] for r in df.select("name", safe_segment(F.col("name"))).collect()}
    assert found == {n: safe_name(n) for n in names} and len(set(found.values())) > 60


def test_paths(spark):
    df = spark.range(1)
    path = lambda pattern, topic, txn=None: df.select(resolve_path(pattern, F.lit(topic), None if txn is None else F.lit(txn))).first()[0]
    assert path("{topic}/{txnID}", "../t", "x{topic}") == "t/xt"
    assert [path(p, "t") for p in ("a//b/./../{topic}", "//{topic}", "./{topic}.log", "s3a://x//{topic}")] == ["a/t", "/t", "t.log", "s3a://x//t"]


def test_integers_in_any_form(spark):
    line = lambda n: f'{{"topic":"t","partition":{n},"offset":1,"value":"","value_encoding":"utf-8","client_addr":"c"}}'
    numbers = {"1": [], "1.0": [], "1e0": [], "123456789012345678901234567890": [], "1.5": ["type of partition"], '"1"': ["type of partition"], "null": ["type of partition"]}
    df = spark.createDataFrame([(n, line(n)) for n in numbers], "n string, line string")
    assert {r.n: r.reasons for r in validate_jsonl(df).collect()} == numbers
