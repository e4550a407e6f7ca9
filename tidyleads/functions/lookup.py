"""Fixed tables as hashed literals: one constant array of small maps, indexed by the CRC-32 of
the key, so a lookup costs one hash however many rows the table has (a literal map is
searched from its start).  The table is folded into the plan; there is no join and no shuffle."""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


class HashedTable:
    """``rows``: key -> value (text, number, or a dict with the fields of ``value_type``)."""

    def __init__(self, rows: dict[str, object], value_type: str = "string"):
        self.size = max(1, 2 * len(rows))
        buckets: list[dict] = [{} for _ in range(self.size)]
        for key, value in rows.items():
            buckets[zlib.crc32(key.encode()) % self.size][key] = value
        self._json, self._type = json.dumps(buckets), f"array<map<string,{value_type}>>"

    def get(self, key) -> Column:
        """Value of a key, NULL where the table has none."""
        key = as_col(key)
        at = (F.crc32(key.cast("binary")) % self.size + 1).cast("int")
        bucket = F.element_at(F.from_json(F.lit(self._json), self._type), at)
        return F.try_element_at(bucket, key)
