"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to ``2**bits`` levels, the cell's place on the Hilbert
curve orders the rows, and the order is cut into runs. Rows close in all dimensions
come to lie in the same run, so min/max statistics of a shard's files prune on any
of them.

No row leaves its task to find its place: counts by (cell, salt), a table bounded
by ``2**(dims * bits) * salts`` rows and ``salts`` for each large group, give every run its first
rank, and a window over the run the rest. The salt, a hash of the row's group, splits hot
cells; a group with more than a thousandth of the rows is split by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_CELL_BITS = 16


def hilbert_index(cell: Sequence[int], bits: int) -> int:
    """Position on the Hilbert curve of a cell, given its coordinates (Skilling's transform)."""
    x = list(cell)
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, top
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    index = 0
    for bit in range(bits - 1, -1, -1):
        for v in x:
            index = index << 1 | v >> bit & 1
    return index


def curve_position(levels: Sequence[Column], bits: int) -> Column:
    """Hilbert index of quantised levels, looked up in a constant of ``2**(dims * bits)`` entries."""
    dims = len(levels)
    if dims * bits > MAX_CELL_BITS:
        raise ValueError(f"dims * bits is at most {MAX_CELL_BITS}")
    mask = (1 << bits) - 1
    curve = [hilbert_index([i >> bits * (dims - 1 - d) & mask for d in range(dims)], bits) for i in range(1 << dims * bits)]
    cell = F.lit(0)
    for level in levels:
        cell = F.shiftleft(cell, bits).bitwiseOR(level.cast("int").bitwiseAND(mask))
    constant = F.split(F.lit(",".join(map(str, curve))), ",").cast("array<int>")
    return F.element_at(constant, cell + 1)


def by_frequency(df: DataFrame, name: str, bits: int) -> Column:
    """Level of a name: its rank by frequency in ``df`` (ties by name), the last level for all that come later and for null.

    The driver gets the ``2**bits - 1`` most frequent names.
    """
    c, last = F.col(name).cast("string"), (1 << bits) - 1
    top = df.groupBy(c.alias("_name")).agg(F.count("*").alias("_n")).where("_name IS NOT NULL").orderBy(F.col("_n").desc(), "_name").limit(last).collect()
    out = F.lit(last)
    for level, row in enumerate(top):
        out = F.when(c == row["_name"], level).otherwise(out)
    return out


def by_magnitude(c: Column, bits: int) -> Column:
    """Level of a count: its base-2 logarithm, the last level open; null or negative: level 0."""
    return F.least(F.floor(F.log2(F.greatest(F.coalesce(c.cast("double"), F.lit(0.0)), F.lit(0.0)) + 1)), F.lit((1 << bits) - 1)).cast("int")


#: Pieces of a cell that windows order one by one: this many, or one for so many rows of the table.
LEAST_SALTS, ROWS_A_SALT = 256, 1_000_000


def hilbert_shards(
    df: DataFrame,
    levels: Sequence[Column],
    key: str,
    shards: int,
    law: str = "rows",
    size: Column | None = None,
    bits: int = 4,
    salts: int | None = None,
    group: Column | None = None,
) -> DataFrame:
    """``df`` with ``law``, ``shard`` and ``slot``, the row's place in its shard.

    ``law="rows"``: counts of the shards are at most one apart. ``law="bytes"``: a run
    ends where its share of the total of ``size`` is full, so sums are at most one
    row's size off. Rows of one ``group`` (equal values of it; without it, of the key)
    take the cell of the first of them along the curve and neighbouring places there, so
    that only a cut between shards parts them. A null key or group, null levels and
    empty tables are allowed; shards may stay empty where there are fewer rows than
    shards. Columns named like the results are replaced, others come back as they are.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(law)
    weight = F.lit(1).cast("long") if law == "rows" else size.cast("long")
    names = [c for c in df.columns if c.lower() not in ("law", "shard", "slot")]
    rows = df.select(
        F.struct(*names).alias("row"), F.col(key).alias("key"), weight.alias("weight"), curve_position(levels, bits).alias("cell"),
        F.xxhash64(F.col(key) if group is None else group).alias("group"),
    )
    # Groups of more than a thousandth of the rows are few; their rows are split by key, each row of others lies with its group.
    groups = rows.groupBy("group").agg(F.count("*").alias("n"), F.min("cell").alias("first_cell")).where("n > 1")
    total = rows.count()
    salts = salts or max(LEAST_SALTS, total // ROWS_A_SALT)
    groups = groups.select("group", "first_cell", (F.col("n") * 1000 > total).alias("large"))
    salt = F.pmod(F.col("group"), F.lit(salts)).cast("int").alias("salt")
    large = F.coalesce("large", F.lit(False))
    rows = rows.join(groups, "group", "left").select(
        "row", "key", "weight", "group", F.coalesce("first_cell", "cell").alias("cell"), salt, F.when(large, F.col("group")).alias("own"),
        F.when(large, F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")).alias("part"),
    )
    at = ("cell", "salt", "own", "part")
    sums = rows.groupBy(*at).agg(F.sum("weight").alias("w"))
    cells = sums.groupBy("cell").agg(F.sum("w").alias("cw"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = cells.select("cell", F.coalesce(F.sum("cw").over(before), F.lit(0)).alias("cell_start"), F.sum("cw").over(everything).alias("total"))
    inside = Window.partitionBy("cell").orderBy("salt", "own", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.join(cells, "cell").select(*at, "total", (F.col("cell_start") + F.coalesce(F.sum("w").over(inside), F.lit(0))).alias("start"))
    flat = [F.col("row")[c] for c, t in sorted(df.dtypes) if c in names and c != key and not t.startswith(("map", "variant"))]
    tie = ["group", "key", *flat]
    run = Window.partitionBy(*at).orderBy(*tie).rowsBetween(Window.unboundedPreceding, -1)
    same = F.lit(True)
    for c in at:
        same &= F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    placed = rows.alias("a").join(starts.alias("b"), same).select("a.*", "b.total", "b.start")
    placed = placed.withColumn("rank", F.col("start") + F.coalesce(F.sum("weight").over(run), F.lit(0)))
    if law == "rows":
        placed = placed.withColumn("shard", F.expr(f"(rank * {shards}L) div total").cast("int"))
        out = placed.withColumn("slot", (F.col("rank") - F.expr(f"(shard * total + {shards - 1}L) div {shards}L")).cast("long"))
    else:
        # Half of the row's own weight decides, so that a heavy row goes where most of it lies.
        shard = F.least(F.expr(f"((2 * rank + weight) * {shards}L) div (2 * total)"), F.lit(shards - 1)).cast("int")
        out = placed.withColumn("shard", shard)
        first = out.groupBy("shard", *at).agg(F.count("*").alias("n"))
        upto = Window.partitionBy("shard").orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
        first = first.withColumn("slot0", F.coalesce(F.sum("n").over(upto), F.lit(0)))
        here = same & (F.col("a.shard") == F.col("b.shard"))
        own = Window.partitionBy("shard", *at).orderBy("rank", *tie)
        out = out.alias("a").join(first.alias("b"), here).select("a.*", "b.slot0").withColumn("slot", (F.col("slot0") + F.row_number().over(own) - 1).cast("long"))
    out = out.select(*(F.col("row")[c].alias(c) for c in names), "shard", "slot")
    return out.withColumn("law", F.lit(law))


def write_shards(sharded: DataFrame, path: str, shards: int) -> None:
    """A folder of Parquet files a shard, rows by slot. Statistics of its files prune shards by any of the curve's dimensions."""
    sharded.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
