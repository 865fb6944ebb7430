"""Small tables looked up inside a row, in place of exploding texts, a join and regrouping them; work done once per distinct text.

A held table is one constant: buckets by CRC-32, each a map of about one key, so a lookup costs the same whatever its size.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_ROWS, MOST_CHARS = 20_000, 4_000_000  # of a table that goes with every task; larger ones are joined by shuffle
PLAIN = ("string", "integer", "long")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def held(table: DataFrame, key: str, values: list[str]) -> Callable[[Column], Column] | None:
    """A function from a key to the array of its rows' ``values`` (null if none), or None where the table is too large to be held.

    At most MOST_ROWS + 1 rows reach the driver. Rows without a key are left out, as in a join.
    """
    fields = {f.name: f.dataType for f in table.schema.fields}
    if any(fields[c].typeName() not in PLAIN for c in values) or fields[key].typeName() != "string":
        return None
    rows = table.filter(F.col(key).isNotNull()).select(key, *values).limit(MOST_ROWS + 1).collect()
    if len(rows) > MOST_ROWS or sum(len(x) for r in rows for x in r if isinstance(x, str)) > MOST_CHARS:
        return None
    n = max(len(rows), 1)
    buckets: list[dict[str, list]] = [{} for _ in range(n)]
    for r in rows:
        buckets[zlib.crc32(r[0].encode()) % n].setdefault(r[0], []).append(dict(zip(values, r[1:], strict=True)))
    kind = f"array<map<string,array<struct<{','.join(f'`{c}`:{fields[c].simpleString()}' for c in values)}>>>>"
    whole = F.from_json(F.lit(json.dumps(buckets)), kind)
    return lambda k: F.try_element_at(F.element_at(whole, (F.crc32(k.cast("binary")) % n + 1).cast("int")), k)


def per_text(rows: DataFrame, on: list[str], make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` with the columns that ``make`` adds to their distinct values of ``on``; rows whose values it drops are dropped.

    The join is never a broadcast: estimates of exploded texts are too low for that choice to be left open.
    """
    distinct = rows.select(*on).distinct().select(F.explode(F.array(F.struct(*on))).alias("_row")).select("_row.*")  # a generator: filters on what is made stay above it
    made = make(distinct)
    other = made.select(*[F.col(c).alias(f"__{c}") for c in on], *[c for c in made.columns if c not in on]).hint("merge")
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return rows.join(other, same).drop(*[f"__{c}" for c in on])
