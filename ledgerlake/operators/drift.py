"""Schema drift of JSON documents (V2): what the documents hold against what
is declared, found by inference and not by a fixed schema.

The schema is inferred over all documents as VARIANT
(``schema_of_variant_agg``, one row); a second pass counts, for each field
that is declared or found, the documents that have, lack or misread it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.bank_rules import _kind, _misread


def inferred(docs: DataFrame, json_col: str = "value") -> T.StructType:
    """The merged schema of all documents that are JSON objects."""
    v = F.try_parse_json(F.col(json_col))
    objects = docs.select(v.alias("v")).where(F.schema_of_variant("v").startswith("OBJECT<"))
    text = objects.agg(F.schema_of_variant_agg("v")).first()[0]
    return T.StructType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", text)[len("STRUCT<"):-1]) if text.startswith("OBJECT<") and text != "OBJECT<>" else T.StructType()


def leaves(schema: T.StructType, prefix: tuple[str, ...] = ()) -> dict[tuple[str, ...], T.DataType]:
    """Type of each field that isn't a struct, by its path."""
    out = {}
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            out |= leaves(f.dataType, (*prefix, f.name))
        else:
            out[(*prefix, f.name)] = f.dataType
    return out


def _value(doc: Column, path: tuple[str, ...]) -> Column:
    """The value at a path; a name with both kinds of quotes can't be addressed."""
    if any("'" in name and '"' in name for name in path):
        return F.lit(None).cast("variant")
    quoted = [f'["{name}"]' if "'" in name else f"['{name}']" for name in path]
    return F.try_variant_get(doc, "$" + "".join(quoted), "variant")


def drift(docs: DataFrame, declared: T.StructType, json_col: str = "value") -> DataFrame:
    """(path, status, declared, found, n_docs), a row for each finding:

    * ``added``: a field that isn't declared; documents that have it;
    * ``missing``: a declared field; documents that lack it (or hold null);
    * ``retyped``: a declared field; documents whose value isn't of its type.

    ``found`` is the type inferred over all documents.  Text that isn't a
    JSON object is counted under the empty path as ``unreadable``."""
    want, have = leaves(declared), leaves(inferred(docs, json_col))
    doc = F.try_parse_json(F.col(json_col))
    is_object = F.coalesce(F.schema_of_variant(doc).startswith("OBJECT<"), F.lit(False))
    findings = [("", "unreadable", None, None, ~is_object)]
    for path in sorted({*want, *have}):
        there = F.coalesce(_value(doc, path).isNotNull() & (_kind(_value(doc, path)) != "VOID"), F.lit(False))
        names = ".".join(path), want[path].simpleString() if path in want else None, have[path].simpleString() if path in have else None
        if path not in want:
            findings.append((names[0], "added", names[1], names[2], there))
            continue
        findings.append((names[0], "missing", names[1], names[2], is_object & ~there))
        if isinstance(want[path], (T.ArrayType, T.MapType, T.StructType)):
            wrong = ~_kind(_value(doc, path)).startswith("ARRAY<" if isinstance(want[path], T.ArrayType) else "OBJECT<")
        else:
            wrong = _misread(_value(doc, path), want[path])
        findings.append((names[0], "retyped", names[1], names[2], there & F.coalesce(wrong, F.lit(False))))
    counts = docs.agg(*[F.count_if(bad).alias(f"__{i}") for i, (*_, bad) in enumerate(findings)])
    rows = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(s).alias("status"), F.lit(d).cast("string").alias("declared"),
                              F.lit(f).cast("string").alias("found"), F.col(f"__{i}").alias("n_docs"))
                     for i, (p, s, d, f, _) in enumerate(findings)])
    return counts.select(F.inline(rows)).where("n_docs > 0")
