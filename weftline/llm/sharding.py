"""Fixed virtual slots: records hash into thousands of slots, and a versioned map places slots on shards.

A record's slot never changes. Version 1 of the map deals slots to shards in turn; a rebalance loads the last stored
version, reads the bytes of every slot, and stores the next version, in which some slots have another shard. Only the slot table (a parameter's
number of rows, whatever the data's size) reaches the driver. Everything that touches records is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import staging


def slot_of(columns: list[str], n_slots: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n_slots)).cast("int")


def store_map(spark: SparkSession, path: str, version: int, shards: list[int]) -> None:
    """Write one version (vslot, shard) of the map under path; a version is never written twice."""
    table = spark.sql(f"SELECT pos AS vslot, CAST(col AS INT) AS shard FROM (SELECT posexplode(split('{','.join(map(str, shards))}', ',')))")
    table.write.mode("errorifexists").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[int]] | None:
    """A version of the map, the last one by default, and the shard of each slot; None if there is none yet."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return None
    table = spark.read.parquet(path)
    found = version if version is not None else table.agg(F.max("version")).first()[0]
    return found, [r.shard for r in table.where(F.col("version") == found).orderBy("vslot").collect()]


def edit_map(spark: SparkSession, path: str, moves: dict[int, int]) -> int:
    """Store the next version, in which the given slots have the given shards."""
    version, shards = load_map(spark, path)
    store_map(spark, path, version + 1, [moves.get(s, at) for s, at in enumerate(shards)])
    return version + 1


def dealt(n_slots: int, n_shards: int) -> list[int]:
    """The first version: slots dealt to shards in turn."""
    return [s % n_shards for s in range(n_slots)]


def rebalanced(shards: list[int], load: list[int], n_shards: int) -> list[int]:
    """The next version: slots move, or change places, from the heaviest to the lightest shard while that evens them.

    Each step takes the move, or else the exchange, that leaves this pair of shards closest; ends when none helps.
    """
    shards = list(shards)
    total = [0] * n_shards
    held: list[set[int]] = [set() for _ in range(n_shards)]
    for s, at in enumerate(shards):
        total[at] += load[s]
        held[at].add(s)
    for _ in range(8 * len(shards)):
        hi, lo = max(range(n_shards), key=total.__getitem__), min(range(n_shards), key=total.__getitem__)
        gap = total[hi] - total[lo]
        moves = [(abs(gap - 2 * load[s]), s, -1) for s in held[hi] if 0 < load[s] < gap]
        small = sorted((load[s], s) for s in held[lo])
        swaps = []
        if gap > 1 and (not moves or min(moves)[0] > gap // 16):
            for a in held[hi]:
                want = load[a] - gap // 2
                i = _nearest(small, want)
                swaps += [(abs(gap - 2 * (load[a] - w)), a, b) for w, b in small[max(0, i - 1) : i + 1] if 0 < load[a] - w < gap]
        if not (best := min(moves + swaps, default=None)) or best[0] >= gap:
            break
        for s, old, new in ((best[1], hi, lo), (best[2], lo, hi)):
            if s >= 0:
                held[old].remove(s)
                held[new].add(s)
                shards[s] = new
                total[old] -= load[s]
                total[new] += load[s]
    return shards


def _nearest(ordered: list[tuple[int, int]], value: int) -> int:
    from bisect import bisect_left

    return bisect_left(ordered, (value, -1))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = 16, n_slots: int = 4096, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The placed rows, and the map with all its versions.

    path: the folder of the map. Its last version is loaded and rebalanced for these rows; where that moves a slot, the
    next version is stored. Without a map there, version 1 is dealt and stored first. None: a folder of this session.

    Rows: (id, size, text_crc32, vslot, shard, slot): slot is the row's place in its shard, gapless from 0. Shards get
    near equal bytes. The slot of a record comes from its id, size and checksum, so rows that repeat one id spread
    unless they are equal throughout; equal rows share a slot, and a slot is never split. Null text has size 1, as
    has an empty one; a null id is an id like others. Ties of rebalancing go to the smallest slot. Empty table: no rows,
    and the map as it was. Other columns are ignored.
    """
    spark = docs.sparkSession
    path = path or staging.folder(spark, "slot-map")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = staging.put(rows.withColumn("vslot", slot_of(["id", "size", "text_crc32"], n_slots)), "records")
    loads = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()  # n_slots rows at most
    load, count = [0] * n_slots, [0] * n_slots
    for r in loads:
        load[r.vslot], count[r.vslot] = r.bytes, r.n
    if (stored := load_map(spark, path)) is None:
        stored = 1, dealt(n_slots, n_shards)
        store_map(spark, path, *stored)
    version, last = stored
    if len(last) != n_slots or max(last) >= n_shards:
        raise ValueError(f"the map at {path} has {len(last)} slots and {max(last) + 1} shards")
    now = rebalanced(last, load, n_shards)
    if now != last:
        version += 1
        store_map(spark, path, version, now)
    versions = spark.read.parquet(path)
    start, base = [0] * n_shards, []
    for s, at in enumerate(now):
        base.append(start[at])
        start[at] += count[s]
    offsets = spark.sql(f"SELECT pos AS vslot, CAST(col AS BIGINT) AS base FROM (SELECT posexplode(split('{','.join(map(str, base))}', ',')))")
    # n_slots rows, a parameter's number.
    current = versions.where(F.col("version") == version).select("vslot", "shard").join(F.broadcast(offsets), "vslot")
    place = F.row_number().over(Window.partitionBy("vslot").orderBy("id", "text_crc32", "size")) - 1
    placed = rows.withColumn("place", place).join(F.broadcast(current), "vslot")
    return placed.select("id", "size", "text_crc32", "vslot", "shard", (F.col("base") + F.col("place")).alias("slot")), versions


def grown(shards: list[int], n_shards: int) -> list[int]:
    """A version with one more shard, which takes its even part of every old one and gives nothing back."""
    new = list(shards)
    for at in range(n_shards):
        mine = [s for s, x in enumerate(shards) if x == at]
        for s in mine[:: n_shards + 1]:
            new[s] = n_shards
    return new
