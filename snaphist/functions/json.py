"""JSON-text helpers. Nested documents stay text; fields are pulled lazily
with ``get_json_object`` (keeps source key order and values, compacts
whitespace); ``parse_fields`` reads several top-level fields in one parse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jpath(doc: Column, path: str) -> Column:
    return F.get_json_object(doc, path)


def parse_fields(doc: Column, fields: dict[str, str], *, strict: bool = True) -> Column:
    """Parse a JSON object once into a struct of the named top-level fields.

    STRING fields keep nested objects/arrays as their compact source text (key
    order and nulls kept, same text as ``get_json_object``), so one parse
    replaces one ``get_json_object`` call per field. ``strict`` fails the job
    on text that is not JSON of this shape; the option also keeps the parse
    whole: without one the optimizer prunes the schema field by field and
    parses the document again for each."""
    schema = ",".join(f"`{k}`:{t}" for k, t in fields.items())
    return F.from_json(doc, f"struct<{schema}>", {"mode": "FAILFAST" if strict else "PERMISSIVE"})


def json_wrap(**parts: Column) -> Column:
    """``{"k1":<text1>,"k2":<text2>}`` from already-serialised JSON texts;
    a NULL part is written as ``null``."""
    pieces: list[Column] = []
    for i, (k, v) in enumerate(parts.items()):
        pieces.append(F.lit(("{" if i == 0 else ",") + f'"{k}":'))
        pieces.append(F.coalesce(v, F.lit("null")))
    pieces.append(F.lit("}"))
    return F.concat(*pieces)
