"""Shards of near-equal bytes by a k-d tree over the metadata of documents.

The tree starts with one node for all shards. A node for several shards is split in two at the weighted median
(by bytes; for an odd number of shards at the fraction of the smaller half) of its widest dimension: language,
source or size. Categories lie at the hash of their name, sizes at their logarithm, all in [0, 1).

* **Ties.** A category may hold most of the data, so a split also goes through one value: rows of the same value
  are in the order of a hash of their text. Rows with equal texts therefore stay together; they also share the
  metadata of one of them.
* **Large groups.** Copies of a text that fill more than ``1 / PARTS`` of a shard cannot lie between two cuts
  without tilting the shards, so these groups, at most ``PARTS`` a shard, are dealt first: the largest one goes to the
  emptiest shard, whole. Only a group larger than a shard is torn, into as few parts as that takes. The leaves of the
  tree then share the other rows in proportion to the room that is left.
* **Distributed medians.** A place in a dimension is one 63-bit number. All nodes of a level are searched
  together: each pass is one aggregate of bytes per node and bin, and the bin with the median is cut again until
  the error is below ``1 / PARTS`` of a shard's bytes, or a bin has one value. The driver sees at most nodes x bins
  rows. Rows are never sorted or moved for that.
* **Slots** number the rows of a shard, in buckets where a shard has many rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import numbered, position, table_of

SHARDS = 40
ROW_BYTES = 16
PARTS = 50
BINS = 1024
DIMENSIONS = ("k_lang", "k_source", "k_size")
LAW = "bytes"


@dataclass
class Node:
    shards: int
    first: int  # the first of its shards
    key: str = ""
    cut: int = 0  # rows below go left
    left: Node | None = None
    right: Node | None = None


def _place(x: Column, tie: Column) -> Column:
    return F.floor(x * float(1 << 31)) * F.lit(1 << 32) + F.floor(tie * float(1 << 32))


def _route(node: Node, numbers: dict[int, int]) -> Column:
    """The number of the lowest node of the tree that a row lies in."""
    if node.left is None:
        return F.lit(numbers[id(node)])
    return F.when(F.col(node.key) < node.cut, _route(node.left, numbers)).otherwise(_route(node.right, numbers))


def _leaves(node: Node) -> list[Node]:
    return [node] if node.left is None else _leaves(node.left) + _leaves(node.right)


def _slim(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
        F.xxhash64(F.col("doc_id")).alias("_k"),
        F.xxhash64(text).alias("_t"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
    )


def homes(groups: list[tuple[tuple, int]], total: int, shards: int) -> dict[tuple, list[int]]:
    """For large groups (key, bytes) the shards of their parts: larger parts first, each to the emptiest shard."""
    parts = []
    for key, size in groups:
        n = max(1, -(-size * shards // max(total, 1)))  # as few as fit a shard
        parts += [(size / n, key)] * n
    load, found = [0.0] * shards, {key: [] for key, _ in groups}
    for size, key in sorted(parts, reverse=True):
        at = min(range(shards), key=lambda i: (load[i], i))
        load[at] += size
        found[key].append(at)
    return found


def room_left(load: list[int], total: int) -> list[float]:
    """The room of every shard that lifts all shards to one level, as far as that is possible."""
    rest, lowest, level = total - sum(load), sorted(load), 0.0
    for n in range(1, len(load) + 1):
        level = (rest + sum(lowest[:n])) / n
        if n == len(load) or level <= lowest[n]:
            break
    return [max(0.0, level - x) for x in load]


def rows_of(docs: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, list[float]]:
    """Per row: id, size, crc, _k and _t (hashes of id and text), ``home`` (the shard of a row of a large group) and
    for the others the place in every dimension; and the room of each shard for these others."""
    slim = table_of(_slim(docs), "metadata")
    total = slim.agg(F.sum("size")).first()[0] or 0
    group = ["_t", "crc", "size"]
    copies = slim.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("lang", "source")).alias("_meta"), F.sum("size").alias("_bytes")
    )
    copies = table_of(copies.filter("_n > 1"), "copies")
    heavy = F.col("_bytes") > total / shards / PARTS
    # At most shards x PARTS groups.
    large = [((r["_t"], r["crc"], r["size"]), r["_bytes"]) for r in copies.filter(heavy).collect()]
    found = homes(sorted(large), total, shards)
    schema = "_t long, crc long, size long, _homes array<int>"
    dealt = docs.sparkSession.createDataFrame([(*key, at) for key, at in found.items()], schema)
    marked = slim.join(F.broadcast(dealt), group, "left")
    part = F.floor(position("_t", "_k") * F.size("_homes")).cast("int")
    home = F.when(F.col("_homes").isNotNull(), F.get("_homes", part))
    apart = marked.filter("_homes IS NOT NULL").withColumn("home", home)
    # The parts of a torn group are as equal as hashes of ids are; what counts is what they really hold.
    held = {r["home"]: r["load"] for r in apart.groupBy("home").agg(F.sum("size").alias("load")).collect()}
    room = room_left([held.get(i, 0) for i in range(shards)], total)
    both = marked.filter("_homes IS NULL").join(copies.filter(~heavy).select(*group, "_meta"), group, "left")
    lang, source, tie = F.coalesce("_meta.lang", "lang"), F.coalesce("_meta.source", "source"), position("_t")
    places = {
        "k_lang": _place(position(F.lit("lang"), lang), tie),
        "k_source": _place(position(F.lit("source"), source), tie),
        "k_size": _place(F.log2("size") / 64.0, tie),
    }
    own = ["id", "size", "crc", "_k", "_t"]
    light = both.select(*own, F.lit(None).cast("int").alias("home"), *[c.alias(k) for k, c in places.items()])
    rest = apart.select(*own, "home", *[F.lit(None).cast("long").alias(k) for k in places])
    return table_of(light.unionByName(rest), "places"), room


def _left_share(node: Node, room: list[float]) -> float:
    own = room[node.first : node.first + node.shards]
    return sum(own[: node.shards // 2]) / sum(own) if sum(own) else node.shards // 2 / node.shards


def grow(rows: DataFrame, room: list[float]) -> Node:
    """The tree with a leaf for every shard; leaves hold bytes in proportion to ``room``."""
    rows, shards = rows.filter("home IS NULL"), len(room)
    root = Node(shards, 0)
    while True:
        open_nodes = [n for n in _leaves(root) if n.shards > 1]
        if not open_nodes:
            return root
        numbers = {id(n): i for i, n in enumerate(_leaves(root))}
        node_of = {numbers[id(n)]: n for n in open_nodes}
        here = rows.withColumn("_node", _route(root, numbers)).filter(F.col("_node").isin(list(node_of)))
        extent = [F.min(k).alias(f"min_{k}") for k in DIMENSIONS] + [F.max(k).alias(f"max_{k}") for k in DIMENSIONS]
        stats = {r["_node"]: r for r in here.groupBy("_node").agg(F.sum("size").alias("w"), *extent).collect()}
        ranges: dict[int, list[int]] = {}  # node -> lowest and highest place, and the bytes below
        for i, node in node_of.items():
            r = stats.get(i)
            # The widest dimension, by its value and not by the hash below it.
            width = {k: (r[f"max_{k}"] >> 32) - (r[f"min_{k}"] >> 32) if r else 0 for k in DIMENSIONS}
            node.key = max(DIMENSIONS, key=lambda k: width[k])
            ranges[i] = [r[f"min_{node.key}"], r[f"max_{node.key}"], 0] if r else [0, 0, 0]
            if r is None or ranges[i][0] == ranges[i][1]:  # no rows, or one place: all go left
                node.cut = ranges[i][1] + 1
        want = {i: stats[i]["w"] * _left_share(n, room) for i, n in node_of.items() if i in stats}
        searching = {i for i, n in node_of.items() if ranges[i][0] < ranges[i][1]}
        while searching:
            cases = None
            for i in sorted(searching):
                low, high, _ = ranges[i]
                step, key = (high - low) // BINS + 1, F.col(node_of[i].key)
                found = F.when(key.between(low, high), F.floor((key - low) / step))
                cases = F.when(F.col("_node") == i, found) if cases is None else cases.when(F.col("_node") == i, found)
            key = F.lit(None)
            for k in DIMENSIONS:
                mine = [i for i in searching if node_of[i].key == k]
                key = F.when(F.col("_node").isin(mine), F.col(k)).otherwise(key) if mine else key
            bins = here.select("_node", "size", cases.cast("int").alias("_bin"), key.alias("_key")).filter("_bin IS NOT NULL")
            seen: dict[int, list] = {}
            for r in bins.groupBy("_node", "_bin").agg(
                F.sum("size").alias("w"), F.min("_key").alias("low"), F.max("_key").alias("high")
            ).collect():
                seen.setdefault(r["_node"], []).append((r["low"], r["high"], r["w"]))
            for i in list(searching):
                below = ranges[i][2]
                for low, high, w in sorted(seen[i]):
                    if below + w >= want[i]:
                        break
                    below += w
                fine = w <= stats[i]["w"] / node_of[i].shards / PARTS / 4
                if low == high or fine:
                    # The nearer side of the last bin; a split leaves something on either side.
                    after = want[i] - below > below + w - want[i] or below == 0
                    node_of[i].cut = high + 1 if after and below + w < stats[i]["w"] else low
                    searching.discard(i)
                else:
                    ranges[i] = [low, high, below]
        for node in open_nodes:
            half = node.shards // 2
            node.left, node.right = Node(half, node.first), Node(node.shards - half, node.first + half)


def _sharded(rows: DataFrame, room: list[float]) -> DataFrame:
    tree = grow(rows, room)
    leaf = _route(tree, {id(n): n.first for n in _leaves(tree)})
    return rows.withColumn("shard", F.coalesce("home", leaf).cast("int"))


def assign(rows: DataFrame, room: list[float]) -> DataFrame:
    """Add shard and slot to the frame of ``rows_of``."""
    placed = _sharded(rows, room).withColumn("_at", position("_k", "_t"))
    return numbered(placed, ["shard"], "_at", ["_k", "_t"], "slot")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (bytes of the text, and 16), text_crc32, law, shard, slot
    (gapless from 0 in each shard), grown_shard (NULL under this law).

    A NULL text is empty, a NULL language or source an empty name. Repeated rows get slots of their own. If all
    documents are one text with one id, they cannot be told apart and share a shard. Only doc_id, text, lang
    and source are read. An empty table gives an empty result.
    """
    return assign(*rows_of(docs, shards)).select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents with their shard and slot. Rows that agree in id and text have neighbouring slots; texts are
    moved once, to meet them."""
    columns = docs.columns
    placed = _sharded(*rows_of(docs, shards))
    placed = placed.groupBy("_k", "_t").agg(F.min("shard").alias("shard"), F.count(F.lit(1)).alias("_n"))
    placed = placed.withColumn("_at", position("_k", "_t"))
    placed = numbered(placed, ["shard"], "_at", ["_k", "_t"], "slot", weight="_n")
    keyed = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    key, text = F.col(f"c{columns.index('doc_id')}"), F.col(f"c{columns.index('text')}")
    keyed = keyed.withColumns({"_k": F.xxhash64(key), "_t": F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))})
    same = Window.partitionBy("_k", "_t").orderBy("_k")
    out = keyed.join(placed.drop("_n", "_at"), ["_k", "_t"])
    out = out.withColumn("slot", F.col("slot") + F.row_number().over(same) - 1).drop("_k", "_t")
    return out.toDF(*columns, *[c if c not in columns else f"shard_{c}" for c in ("shard", "slot")])
