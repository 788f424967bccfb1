"""Hashes over canonical JSON."""

from __future__ import annotations

import hashlib
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_json(columns: dict[str, Column], sort: bool = True) -> Column:
    """JSON of named values without spaces, nulls included, keys sorted unless their order is part of a contract."""
    names = sorted(columns) if sort else list(columns)
    return F.to_json(F.struct(*(columns[n].alias(n) for n in names)), {"ignoreNullFields": "false"})


def row_hash(columns: dict[str, Column]) -> Column:
    return F.sha2(canonical_json(columns), 256)


def movement_hash(columns: dict[str, Column]) -> Column:
    """Hash of a movement's fields in the order given, over UTF-16LE bytes; slashes are escaped in its JSON."""
    return F.sha2(F.encode(F.replace(canonical_json(columns, sort=False), F.lit("/"), F.lit("\\/")), "UTF-16LE"), 256)


def is_hex(x: Column, n: int) -> Column:
    return F.coalesce(x.rlike(f"^[0-9a-f]{{{n}}}$"), F.lit(False))


def frame_hash(df: DataFrame, order: str) -> DataFrame:
    """One row (n, hash) that identifies a table: the rows' hashes, keyed by their order column, folded without gathering rows.

    Each row gives 256 bits of (order, row); the sums of their eight words do not depend on
    the order in which tasks finish.
    """
    own = F.sha2(F.to_json(F.struct(F.col(order).alias("_order"), *sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    words = [F.conv(F.substring(own, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)").alias(f"w{i}") for i in range(8)]
    sums = [F.coalesce(F.sum(f"w{i}"), F.lit(0)).cast("decimal(30,0)").cast("string") for i in range(8)]
    folded = df.select(*words).agg(F.count(F.lit(1)).alias("n"), F.concat_ws(",", *sums).alias("s"))
    return folded.select("n", F.sha2(F.concat_ws(",", F.col("n").cast("string"), "s"), 256).alias("hash"))


#: Largest value in the payload of a registry row, in bytes of UTF-16.
VALUE_BYTES = 8000


def is_json(x: Column) -> Column:
    """Is a text a JSON object or array?"""
    return F.coalesce(F.try_parse_json(x).isNotNull() & x.rlike(r"^\s*[\[{]"), F.lit(False))


def payload_error(x: Column) -> Column:
    """What is wrong with a payload: no JSON object or array, or a value in it that is nested or longer than 8,000 bytes; else null."""
    values = F.coalesce(F.map_values(F.from_json(x, "map<string,variant>")), F.from_json(x, "array<variant>"))
    nested = lambda v: F.coalesce(F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"), F.lit(False))
    size = lambda v: F.octet_length(F.encode(F.try_variant_get(v, "$", "string"), "UTF-16LE"))
    # A text with no opening bracket after its first character has nothing nested, and UTF-16 has at most two bytes for each of UTF-8: the values of most payloads need no look.
    rest = F.substring(x, 2, 2**31 - 1)
    brackets, long = F.contains(rest, F.lit("{")) | F.contains(rest, F.lit("[")), F.octet_length(x) * 2 > VALUE_BYTES
    bad = (brackets & F.exists(values, nested)) | (long & F.exists(values, lambda v: F.coalesce(size(v) > VALUE_BYTES, F.lit(False))))
    return F.when(~is_json(x), "FilaJson no es JSON valido.").when(bad, "FilaJson contiene estructuras o columnas demasiado largas.")


def valid_payload(x: Column) -> Column:
    """Is a text a JSON object whose values are flat and of 8,000 bytes at most each?"""
    return payload_error(x).isNull() & x.rlike(r"^\s*\{")


def code_hash(folder: str | Path) -> str:
    """SHA-256 over the names and contents of a package's source files, in order of name."""
    out = hashlib.sha256()
    for path in sorted(Path(folder).rglob("*.py")):
        out.update(path.relative_to(folder).as_posix().encode() + b"\0" + path.read_bytes() + b"\0")
    return out.hexdigest()
