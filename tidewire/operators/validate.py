"""Validation of captured JSON lines against their closed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The contract of a line: fields, their types, and those that must be there.
TYPES = {"topic": "STRING", "partition": "BIGINT", "offset": "BIGINT", "key": "STRING", "key_encoding": "STRING", "value": "STRING", "value_encoding": "STRING", "headers": "OBJECT", "timestamp": "STRING", "client_addr": "STRING"}
REQUIRED = ["topic", "partition", "offset", "value", "value_encoding", "client_addr"]
ENCODINGS = ["utf-8", "base64"]
TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"


def validate_jsonl(lines: DataFrame, column: str = "line") -> DataFrame:
    """lines with `reasons`, the sorted ways in which a line breaks the contract; empty if it holds.

    A number is an integer if it has no fraction, however it is written and however large it is.
    A line is parsed once, and the kind of each field is taken once. lines must not have columns
    that begin with `reasons`.
    """
    known, keys = F.col("reasons_line"), F.col("reasons_keys")
    parsed = lines.withColumns({"reasons_line": F.try_parse_json(column), "reasons_keys": F.json_object_keys(column)})
    fields = parsed.withColumn("reasons_fields", F.struct(*(F.try_variant_get(known, f"$.{n}", "variant").alias(n) for n in TYPES)))
    kinds = F.struct(*(F.schema_of_variant(F.col(f"reasons_fields.{n}")).alias(n) for n in TYPES))
    fields = fields.withColumn("reasons_kinds", kinds)

    def kind(name: str) -> Column:
        return F.col(f"reasons_kinds.{name}")

    def field(name: str, as_type: str) -> Column:
        return F.try_variant_get(F.col(f"reasons_fields.{name}"), "$", as_type)

    def fits(name: str, wanted: str) -> Column:
        if wanted == "BIGINT":
            number = field(name, "double")
            return (kind(name) == "BIGINT") | (kind(name).rlike("^(DECIMAL|DOUBLE)") & (number == F.rint(number)))
        return kind(name).startswith("OBJECT") if wanted == "OBJECT" else kind(name) == wanted

    there = {n: F.array_contains(keys, n) for n in TYPES}
    reasons = [F.when(~there[n], F.lit(f"missing {n}")) for n in REQUIRED]
    reasons.append(F.when(F.size(F.array_except(keys, F.array(*map(F.lit, TYPES)))) > 0, F.lit("unknown field")))
    for name, wanted in TYPES.items():
        reasons.append(F.when(there[name] & ~F.coalesce(fits(name, wanted), F.lit(False)), F.lit(f"type of {name}")))
    for name in ("key_encoding", "value_encoding"):
        reasons.append(F.when(there[name] & (kind(name) == "STRING") & ~field(name, "string").isin(ENCODINGS), F.lit(f"{name} unknown")))
    reasons.append(F.when(there["timestamp"] & (kind("timestamp") == "STRING") & ~field("timestamp", "string").rlike(TIME), F.lit("timestamp form")))
    odd = F.exists(F.map_values(field("headers", "map<string,variant>")), lambda x: F.schema_of_variant(x) != "STRING")
    reasons.append(F.when(there["headers"] & kind("headers").startswith("OBJECT") & F.coalesce(odd, F.lit(False)), F.lit("type of a header")))
    found = F.array_sort(F.array_compact(F.array(*reasons)))
    out = fields.withColumn("reasons", F.when(known.isNull() | keys.isNull(), F.array(F.lit("not a JSON object"))).otherwise(found))
    return out.select(*lines.columns, "reasons")
