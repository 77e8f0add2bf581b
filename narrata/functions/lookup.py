"""A small table as one foldable value of the plan, looked up by a word within the row.

The rows lie in buckets by a hash of their key (about one to a bucket), so a
lookup reads one short list; nothing is joined or shuffled. The caller checks
the size first (:func:`row_table`) and has another way for larger tables.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: UTF-8 bytes and numbers of a table that travels with the plan.
MAX_BYTES = 16 << 20
#: Bytes counted for a row beside its key.
ROW_BYTES = 40


class RowTable:
    """Values by ``token``; built on the driver from rows whose size has been checked."""

    def __init__(self, rows: list, values: dict[str, str], slots: int):
        table: list[list[dict]] = [[] for _ in range(slots)]
        for r in rows:
            table[r.slot].append({"t": r.token, **{c: r[c] for c in values}})
        fields = ", ".join(["t: string", *(f"{c}: {kind}" for c, kind in values.items())])
        self.slots = slots
        self.table = F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), f"array<array<struct<{fields}>>>")

    def of(self, word: Column) -> Column:
        """The word's row as a struct, or null."""
        slot = F.get(self.table, F.pmod(F.xxhash64(word), F.lit(self.slots)).cast("int"))
        return F.get(F.filter(slot, lambda e: e["t"] == word), F.lit(0))


def row_table(rows: DataFrame, values: list[str], limit: int = MAX_BYTES) -> RowTable | None:
    """The table of distinct, non-null ``token`` with the columns ``values``, or None if it passes ``limit`` bytes."""
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("token")), F.lit(0)).alias("bytes")).first()
    if size.bytes + ROW_BYTES * size.n > limit:
        return None
    slots = 1 << max(4, size.n.bit_length())
    types = dict(rows.dtypes)
    kept = rows.select("token", *values, F.pmod(F.xxhash64("token"), F.lit(slots)).cast("int").alias("slot")).collect()
    return RowTable(kept, {c: types[c] for c in values}, slots)
