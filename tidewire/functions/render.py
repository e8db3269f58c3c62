"""Message renderers: native column expressions from a message row to payload bytes."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "0": "\0", "\\": "\\"}
#: What JSON text escapes beyond the needs of JSON, so that it is safe within HTML and scripts.
HTML_ESCAPES = {"<": "\\u003c", ">": "\\u003e", "&": "\\u0026", "\u2028": "\\u2028", "\u2029": "\\u2029"}


def unescape(text: str) -> str:
    """Backslash escapes of ESCAPES; another one, or one at the end, keeps its backslash."""
    out, at = "", 0
    while at < len(text):
        known = text[at] == "\\" and ESCAPES.get(text[at + 1 : at + 2])
        out += known or text[at]
        at += 2 if known else 1
    return out


def separator(text: str = "\\n", hex_text: str = "", none: bool = False) -> bytes:
    """Bytes after each binary payload: none, or those of the hex text, or those of the escaped text."""
    if none:
        return b""
    return bytes.fromhex(hex_text) if hex_text else unescape(text).encode()


def base64(col: Column) -> Column:
    """Standard base64 in one line."""
    return F.regexp_replace(F.base64(col), "[\r\n]", "")


def binary(after: bytes = b"\n") -> Column:
    return F.concat(F.coalesce(F.col("value"), F.lit(b"")), F.lit(after))


def time_text(stamp: Column) -> Column:
    """As in 2025-01-01 00:00:00.12 +0000 UTC, whatever the session's zone: zeros at the end of the fraction go."""
    stamp = F.to_utc_timestamp(stamp, F.current_timezone())
    fraction = F.regexp_replace(F.date_format(stamp, ".SSSSSS"), r"\.?0+$", "")
    return F.concat(F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"), fraction, F.lit(" +0000 UTC"))


def sorted_map(col: Column) -> Column:
    """The map with its keys in order; null if empty."""
    return F.when(F.size(col) > 0, F.map_from_entries(F.array_sort(F.map_entries(col))))


def jsonl(key_base64: bool = False, value_base64: bool = False) -> Column:
    """A JSON line. A null key goes with its encoding; so do empty headers and an unset time.

    Control characters are escaped with hex digits in upper case, as Spark writes them; another
    writer's lower case is the same JSON in other bytes.
    """

    def text(col: Column, packed: bool) -> Column:
        return base64(col) if packed else F.make_valid_utf8(col.cast("string"))

    name = {True: "base64", False: "utf-8"}
    key = F.col("key")
    record = F.struct(
        "topic",
        "partition",
        "offset",
        text(key, key_base64).alias("key"),
        F.when(key.isNotNull(), F.lit(name[key_base64])).alias("key_encoding"),
        text(F.coalesce("value", F.lit(b"")), value_base64).alias("value"),
        F.lit(name[value_base64]).alias("value_encoding"),
        sorted_map(F.col("headers")).alias("headers"),
        time_text(F.col("timestamp")).alias("timestamp"),
        "client_addr",
    )
    line = F.to_json(record)
    for plain, escaped in HTML_ESCAPES.items():
        line = F.replace(line, F.lit(plain), F.lit(escaped))
    return F.concat(line, F.lit("\n")).cast("binary")


VERBS = {
    "t": lambda: F.col("topic"),
    "k": lambda: F.coalesce("key", F.lit(b"")),
    "s": lambda: F.coalesce("value", F.lit(b"")),
    "p": lambda: F.col("partition").cast("string"),
    "o": lambda: F.col("offset").cast("string"),
    "T": lambda: F.coalesce(F.unix_millis("timestamp"), F.lit(-1)).cast("string"),
    "K": lambda: F.coalesce(F.octet_length("key"), F.lit(-1)).cast("string"),
    "S": lambda: F.coalesce(F.octet_length("value"), F.lit(0)).cast("string"),
    "%": lambda: F.lit("%"),
}


def _pieces(template: str) -> Iterator[Column]:
    at = 0
    while at < len(template):
        two = template[at : at + 2]
        if two[0] == "%" and len(two) == 2:
            if two[1] not in VERBS:
                raise ValueError(f"unknown verb {two} in template {template!r}")
            yield VERBS[two[1]]()
            at += 2
        elif two[0] == "\\" and two[1:] in ESCAPES and len(two) == 2:
            yield F.lit(ESCAPES[two[1]])
            at += 2
        else:
            yield F.lit(two[0])
            at += 1


def template(text: str) -> Column:
    """A message by verbs: %t topic, %k key, %s value, %p partition, %o offset, %T milliseconds or -1, %K key length or -1, %S value length, %% percent."""
    return F.concat(F.lit(b""), *(p.cast("binary") for p in _pieces(text)))


OPTIONS = {"binary": {"after"}, "jsonl": {"key_base64", "value_base64"}, "template": {"text"}}


def render(messages: DataFrame, fmt: str, **options) -> DataFrame:
    """messages with a binary `payload` in format binary, jsonl or template. Options of another format are an error."""
    if fmt not in OPTIONS:
        raise ValueError(f"unknown format {fmt!r}")
    if wrong := set(options) - OPTIONS[fmt]:
        raise ValueError(f"{fmt} does not take {', '.join(sorted(wrong))}")
    if fmt == "template" and not options.get("text"):
        raise ValueError("template needs its text")
    return messages.withColumn("payload", {"binary": binary, "jsonl": jsonl, "template": template}[fmt](**options))


def topic_id(topic: Column) -> Column:
    """A stable 16-byte id: the start of the SHA-256 of the name."""
    return F.substring(F.unhex(F.sha2(topic.cast("binary"), 256)), 1, 16)


def http_request(messages: DataFrame, url: str) -> DataFrame:
    """messages (with a payload) with url, body and http_headers.

    Message headers that differ only in case are one; the value of the last name in order stays.
    """
    entries = F.array_sort(F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>"))))
    named = F.transform(entries, lambda e: F.struct(F.concat(F.lit("x-kafka-header-"), F.lower(e["key"])).alias("key"), e["value"].alias("value")))
    names = F.transform(named, lambda e: e["key"])
    own = F.filter(named, lambda e, k: ~F.array_contains(F.slice(names, k + 2, F.greatest(F.size(names), F.lit(1))), e["key"]))
    fixed = F.create_map(
        F.lit("content-type"), F.lit("application/octet-stream"),
        F.lit("x-kafka-topic"), F.col("topic"),
        F.lit("x-kafka-partition"), F.col("partition").cast("string"),
        F.lit("x-kafka-offset"), F.col("offset").cast("string"),
        F.lit("x-kafka-key"), base64(F.col("key")),
        F.lit("x-kafka-timestamp"), F.unix_millis("timestamp").cast("string"),
        F.lit("x-kafka-client-addr"), F.col("client_addr"),
    )
    fixed = F.map_filter(fixed, lambda _, v: v.isNotNull())
    return messages.withColumns({"url": F.lit(url), "body": F.col("payload"), "http_headers": F.map_concat(fixed, F.map_from_entries(own))})
