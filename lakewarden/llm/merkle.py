"""A Merkle manifest of a dataset: one digest for all rows, and a proof for each of them.

Rows are leaves of one tree per language, ordered by id; the roots of these trees are the leaves of a last tree, whose
root stands for the dataset. Digests are computed by time-forward processing: a node's label tells its place in the
order of computation, and a priority queue ordered by label holds the digests on their way to parents. A second sweep
in reversed order hands every node the siblings on the path from it to the root, so each leaf ends with its proof.

The queue is external. A tree is cut into blocks of ``FANOUT ** LEVELS`` leaves; a block is a range of labels whose
part of the queue fits in memory. What leaves a block (one digest upward, one path downward) is a row of a table in
the shared folder, which Spark deals to the next blocks. Whatever the size of a language, a task holds one block.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakewarden.llm.common import checkpointed, id_crc, table_of

FANOUT = 8
LEVELS = 3  # of a block: 512 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 3
PATH = "array<struct<left:string,right:string>>"
Path = list[dict[str, str]]


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- one block ------------------------------------------------------------------------------------------------


def upward(leaves: Sequence[str], levels: int | None, fanout: int) -> list[list[str]]:
    """The digests of all nodes of a block, level by level from the leaves, for ``levels`` levels above them; with
    None until one node remains. Children send their digests to the label (level, place) of their parent."""
    rows: list[list[str]] = [list(leaves)]
    queue = [(1, i // fanout, i % fanout, d) for i, d in enumerate(leaves)]
    if levels == 0 or (levels is None and len(leaves) == 1):
        return rows
    heapq.heapify(queue)
    while queue:
        level, place = queue[0][:2]
        parts = []
        while queue and queue[0][:2] == (level, place):
            parts.append(heapq.heappop(queue)[3])
        if level == len(rows):
            rows.append([])
        rows[level].append(digest(*parts))
        last = len(rows[level - 1]) <= fanout if levels is None else level == levels
        if not last:
            heapq.heappush(queue, (level + 1, place // fanout, place % fanout, rows[level][-1]))
    return rows


def downward(rows: list[list[str]], above: Path, fanout: int) -> list[Path]:
    """For each leaf of a block the siblings at every level up to the root, given those above the block."""
    paths = [above]
    for level in range(len(rows) - 2, -1, -1):
        row, lower = rows[level], []
        for i in range(len(row)):
            start = i - i % fanout
            own = {"left": "".join(row[start:i]), "right": "".join(row[i + 1 : start + fanout])}
            lower.append([own, *paths[i // fanout]])
        paths = lower
    return paths


def fold(leaf: str, path: Path) -> str:
    """The root that follows from a leaf and its siblings."""
    for step in path:
        leaf = digest(step["left"], leaf, step["right"])
    return leaf


def proof_digest(path: Path) -> str:
    return digest(*(step[side] for step in path for side in ("left", "right")))


# --- trees of any size ----------------------------------------------------------------------------------------


def place(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``n``, the rows of each tree, and ``pos``, their places from 0 by ``order``.

    Rows are dealt and sorted by ranges, so a tree may span many tasks; a task's share of a tree begins where the
    shares before it end."""
    cut = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    # Kept as dealt: ranges follow from a sample, another one could cut elsewhere.
    laid = checkpointed(cut.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    shares = laid.groupBy("tree", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("tree")).alias("n"),
    )
    at = (F.col("_at") + F.col("_shift")).alias("pos")
    return laid.withColumn("_part", part).join(shares, ["tree", "_part"]).select(*rows.columns, "n", at)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """One row per block: tree, block, n, and its members in order."""
    held = [c for c in rows.columns if c not in ("tree", "n", "pos")]
    members = F.sort_array(F.collect_list(F.struct("pos", *held)))
    blocks = rows.groupBy("tree", F.floor(F.col("pos") / size).alias("block")).agg(
        F.first("n").alias("n"), members.alias("members")
    )
    return table_of(blocks, "merkle-blocks")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _levels(n: int, size: int, levels: int) -> int | None:
    return None if n <= size else levels


def climb(rows: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """From (tree, n, pos, digest, ...): the blocks of each round, from the leaves on, and (tree, digest) of the roots."""
    size, rounds, roots = fanout**levels, [], []
    most = rows.agg(F.max("n")).first()[0] or 0
    while True:
        blocks = _blocks(rows, size)
        rounds.append(blocks)

        def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                top = upward([m["digest"] for m in row["members"]], _levels(row["n"], size, levels), fanout)[-1]
                sent = {"tree": row["tree"], "n": row["n"], "pos": row["block"], "digest": top[0]}
                yield pa.RecordBatch.from_pylist([sent], _SENT)

        slim = blocks.select("tree", "block", "n", F.transform("members", lambda m: F.struct(m["digest"])).alias("members"))
        sent = table_of(slim.mapInArrow(sweep, "tree string, n long, pos long, digest string"), "merkle-digests")
        roots.append(sent.filter(F.col("n") <= size).select("tree", "digest"))
        if most <= size:
            break
        more = sent.filter(F.col("n") > size)
        rows = more.withColumn("n", F.ceil(F.col("n") / size).cast("long"))
        most = -(-most // size)
    out = roots[0]
    for other in roots[1:]:
        out = out.unionByName(other)
    return rounds, out


_SENT = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("pos", pa.int64()), ("digest", pa.string())])


def descend(
    rounds: list[DataFrame], above: DataFrame, schema: str, leaf, fanout: int = FANOUT, levels: int = LEVELS
) -> DataFrame:
    """The reversed sweep. ``above`` has tree, subroot, root and ``path``, the siblings above the tree's root;
    ``leaf(member, path, above row)`` gives the row of a leaf as a dict, of the given schema."""
    size = fanout**levels
    sent = above.withColumn("block", F.lit(0).cast("long"))

    def sweep(last: bool, out: pa.Schema):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                nodes = upward([m["digest"] for m in row["members"]], _levels(row["n"], size, levels), fanout)
                paths = downward(nodes, row["path"], fanout)
                if last:
                    found = [leaf(m, p, row) for m, p in zip(row["members"], paths)]
                else:
                    same = {k: row[k] for k in ("tree", "subroot", "root")}
                    found = [{**same, "path": p, "block": m["pos"]} for m, p in zip(row["members"], paths)]
                yield pa.RecordBatch.from_pylist(found, out)

        return each

    down = f"tree string, subroot string, root string, path {PATH}, block long"
    tops = sent
    for blocks in reversed(rounds):
        last = blocks is rounds[0]
        want = schema if last else down
        # A tree's path from above enters at its one block of the highest round.
        whole = blocks.filter(F.col("n") <= size).join(tops, ["tree", "block"])
        joined = whole if sent is tops else whole.unionByName(blocks.filter(F.col("n") > size).join(sent, ["tree", "block"]))
        sent = joined.mapInArrow(sweep(last, to_arrow_schema(StructType.fromDDL(want))), want)
        if not last:
            sent = table_of(sent, "merkle-paths")
    return sent


# --- documents ------------------------------------------------------------------------------------------------


def encoded(column: Column) -> Column:
    """A value as ``-`` if NULL, else its UTF-8 byte count, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_column(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in fields.values()]).cast("binary"), 256)


def ascii_lower(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def leaves(docs: DataFrame, every: int = TAMPER_EVERY) -> DataFrame:
    """(tree, doc_id, digest, claimed): ``claimed`` is the leaf of the row as a reader finds it. Where ``every``
    divides the crc32 of the id (a NULL id: of nothing), A-Z of the text have become a-z."""
    own = {c: F.col(c) for c in FIELDS}
    tampered = {**own, "text": ascii_lower(F.col("text"))}
    # "-" sorts before "=": NULL comes first, other languages follow by their bytes.
    tree = F.when(F.col("lang").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("lang").cast("string")))
    return docs.select(
        tree.alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_column(own).alias("digest"),
        F.when(id_crc(F.col("doc_id")) % every == 0, leaf_column(tampered)).alias("claimed"),
    ).select("tree", "doc_id", "digest", F.coalesce("claimed", "digest").alias("claimed"))


MANIFEST = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def _proven(member: dict, path: Path, row: dict) -> dict:
    folded = fold(member["claimed"], path)
    return {
        "doc_id": member["doc_id"],
        "leaf": member["digest"],
        "subroot": row["subroot"],
        "root": row["root"],
        "proof_sha256": proof_digest(path),
        "folded_root": folded,
        "verified": folded == row["root"],
        "path": path,
    }


def prove(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: the digests of MANIFEST and ``path``, the siblings of every level from the leaf to
    the root as strings left and right of the node.

    NULL values and empty texts have leaves of their own (``-`` and ``0:``), and a NULL language a tree of its own,
    the first one. NULL ids come first. Rows with one id are ordered by their leaves; repeated rows count each, and
    have equal leaves but proofs of their own. Only FIELDS are read. An empty table gives an empty result.
    """
    fields = docs.select(*FIELDS)
    placed = place(table_of(leaves(fields), "merkle-leaves"), ["doc_id", "digest"])
    rounds, subroots = climb(checkpointed(placed), fanout, levels)
    # The last tree: its leaves are the roots of the languages.
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest")
    top_rounds, roots = climb(checkpointed(place(tops, ["lang"])), fanout, levels)
    start = roots.select(
        "tree", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"), F.array().cast(PATH).alias("path")
    )

    def handed(member: dict, path: Path, row: dict) -> dict:
        return {"tree": member["lang"], "subroot": member["digest"], "root": row["root"], "path": path}

    above = descend(
        top_rounds, start, f"tree string, subroot string, root string, path {PATH}", handed, fanout, levels
    )
    above = table_of(above, "merkle-languages")
    return descend(rounds, above, f"{MANIFEST}, path {PATH}", _proven, fanout, levels)


def manifest(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``prove`` without the paths."""
    return prove(docs, **options).drop("path")
