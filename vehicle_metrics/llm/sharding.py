"""Byte-balanced shards by Karmarkar-Karp differencing.

Rows with equal texts form a group that stays together. A partial partition
holds, for each of the k shards, a byte total and the groups behind it. The
differencing method starts with one partial partition for each group and
repeatedly combines the two with the largest spread between their fullest and
emptiest part, matching the fullest parts of one with the emptiest of the
other, until one is left.

At scale this runs as a tree: groups are dealt by hash into buckets of bounded
size; each bucket is differenced in a task of its own; the buckets' partial
partitions (k totals each) are differenced again in batches of bounded size,
level by level. Only the totals travel upwards, and the matching of parts to
shards travels down again.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vehicle_metrics.llm.common import HEAVY_SHARE, look_up
from vehicle_metrics.storage import materialize

SHARDS = 24
BUCKET_GROUPS = 4_000  # groups differenced by one task, on average
FAN_IN = 1_000  # partial partitions combined by one task
SLOT_ROWS = 100_000  # rows numbered together within a shard, on average
ROW_BYTES = 8  # added to a text's bytes


def difference(parts: list[list[int]]) -> tuple[list[int], list[np.ndarray]]:
    """Karmarkar-Karp over partial partitions, each a list of k totals.

    Returns the k final totals, ascending, and for each input partition the
    final part that each of its k parts went to. Ties are broken by input
    order, so a repeated task gives the same answer."""
    k = len(parts[0])
    # A node is a leaf (input) or a merge of two nodes; `order` lists, for each sorted part of a node, the part of
    # each child that went into it.
    sums, children = [], []
    heap = []
    for i, totals in enumerate(parts):
        order = sorted(range(k), key=totals.__getitem__)
        sums.append([totals[j] for j in order])
        children.append((None, order, None, None))
        heap.append((sums[i][0] - sums[i][-1], i))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        raw = [x + y for x, y in zip(sums[a], reversed(sums[b]))]
        order = sorted(range(k), key=raw.__getitem__)
        node = len(sums)
        sums.append([raw[j] for j in order])
        children.append((a, order, b, [k - 1 - j for j in order]))
        sums[a] = sums[b] = None
        heapq.heappush(heap, (sums[node][0] - sums[node][-1], node))
    root = heap[0][1]
    # Down again: place[p] is the final part of a node's sorted part p.
    final = [None] * len(parts)
    stack = [(root, list(range(k)))]
    while stack:
        node, place = stack.pop()
        a, left, b, right = children[node]
        if a is None:
            own = np.empty(k, np.int64)
            own[left] = place
            final[node] = own
            continue
        for child, order in ((a, left), (b, right)):
            below = [0] * k
            for p, j in enumerate(order):
                below[j] = place[p]
            stack.append((child, below))
    return sums[root], final


def _level(sizes: DataFrame, n_shards: int, single: bool) -> DataFrame:
    """Difference each bucket of ``sizes`` (bucket, item, totals) and return
    (bucket, item, place, sums): place[p] is where part p of the item goes in
    the bucket's partial partition, whose totals are sums (on every row)."""
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("item", kind="stable")
        parts = [[0] * (n_shards - 1) + [int(t[0])] if single else list(map(int, t)) for t in batch["totals"]]
        sums, final = difference(parts)
        # A single group lies in the last part of its own partition.
        place = [[int(f[-1])] for f in final] if single else [f.tolist() for f in final]
        return pd.DataFrame({"bucket": batch["bucket"], "item": batch["item"], "place": place,
                             "sums": [sums if i == 0 else None for i in range(len(batch))]})

    item = sizes.schema["item"].dataType.simpleString()
    return sizes.groupBy("bucket").applyInPandas(run, f"bucket long, item {item}, place array<long>, sums array<long>")


def assign_groups(groups: DataFrame, n_shards: int = SHARDS, bucket_groups: int = BUCKET_GROUPS,
                  fan_in: int = FAN_IN) -> DataFrame:
    """(item, shard) for groups (item, bytes), balanced in bytes."""
    n = groups.count()
    n_buckets = max(1, -(-n // bucket_groups))
    leaves = groups.select(F.pmod(F.xxhash64("item"), F.lit(n_buckets)).alias("bucket"), "item",
                           F.array("bytes").alias("totals"))
    levels = [materialize(_level(leaves, n_shards, True), "shard_level")]
    while n_buckets > 1:
        tops = levels[-1].where("sums IS NOT NULL").select(F.col("bucket").alias("item"), F.col("sums").alias("totals"))
        n_buckets = -(-n_buckets // fan_in)
        levels.append(materialize(_level(tops.withColumn("bucket", F.col("item") % F.lit(n_buckets)), n_shards, False),
                                  "shard_level"))
    placed = levels[-1].select("bucket", "item", F.col("place"))
    for lower in reversed(levels[:-1]):
        above = placed.selectExpr("item AS bucket", "place AS above")
        placed = lower.select("bucket", "item", "place").join(above, "bucket").select(
            "bucket", "item", F.transform("place", lambda p: F.get(F.col("above"), p.cast("int"))).alias("place"))
    return placed.selectExpr("item", "CAST(place[0] AS INT) AS shard")


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = SHARDS,
          bucket_groups: int = BUCKET_GROUPS, fan_in: int = FAN_IN, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    ``size`` is the text's UTF-8 bytes (NULL: none) plus 8; rows with equal
    texts share a shard (a NULL text is an empty one); ``law`` is ``bytes``;
    slots number a shard's rows from 0 without gaps; ``grown_shard`` is NULL
    under this law. Repeated rows each get a slot; NULL ids are rows like any
    other; an empty table gives an empty result; other columns are not
    carried. A group larger than an even share fills a shard of its own.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("item"),
                       F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows, "shard_rows")
    groups = rows.groupBy("item").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    groups = materialize(groups, "shard_groups")
    homes = materialize(assign_groups(groups.select("item", "bytes"), n_shards, bucket_groups, fan_in), "shard_homes")
    # Groups of a thousandth of the rows or more are at most 1000; their rows find their shard by broadcast.
    large = groups.where(F.col("n") >= max(2, -(-rows.count() // HEAVY_SHARE))).select("item")
    placed = materialize(look_up(rows, large, homes, "item"), "shard_placed")
    return number_slots(placed, n_shards, slot_rows).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def number_slots(placed: DataFrame, n_shards: int, slot_rows: int) -> DataFrame:
    """``placed`` with ``slot``, which numbers the rows of a shard from 0.

    Rows are numbered within chunks of about ``slot_rows``; a chunk starts
    where the counts before it end. The chunk comes from the stored row
    number, so rows that repeat one id and text spread over all chunks.
    """
    n_chunks = max(1, -(-placed.count() // (n_shards * slot_rows)))
    chunked = placed.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(n_chunks)))
    starts = chunked.groupBy("shard", "chunk").agg(F.count("*").alias("n")).withColumn(
        "start", F.sum("n").over(Window.partitionBy("shard").orderBy("chunk").rowsBetween(
            Window.unboundedPreceding, -1))).select("shard", "chunk", F.coalesce("start", F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("text_crc32", "item", "id", "row")) - 1
    return chunked.withColumn("within", within).join(starts, ["shard", "chunk"]).withColumn(
        "slot", (F.col("start") + F.col("within")).cast("long"))
