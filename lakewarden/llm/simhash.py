"""Near-duplicate texts by SimHash and a segment-popcount embedding.

A fingerprint of 64 bits is cut into 32 segments of two bits, and maps to the vector of the numbers of
bits set in them. Two vectors are no farther apart under the Manhattan distance than the fingerprints are
under the Hamming distance, so fingerprints within ``distance`` bits are a range join of the vectors.

* **Grid.** The 32 dimensions form ``distance + 3`` blocks. A pair within the distance differs in at most
  ``distance`` of them, so it agrees on three whole blocks. For each choice of three blocks a cell of the
  grid is the vector cut down to them; each fingerprint lies in one cell per choice, and only members of
  one cell are compared: first the Manhattan distance of the whole vectors, then the exact Hamming distance.
* **Counts as unary codes.** 0, 1, 2 are written 00, 01, 11. Then the Manhattan distance is the number of
  bits that differ, and a vector is one 64-bit number.
* **Groups of copies.** Equal fingerprints are one node. A cell gives links that connect its members, never
  all pairs. A cell with more than ``most`` members is not compared in its task: it is cut again by the exact
  bits of three of six other blocks, and what is still too large by pairs of tiles.
* **Classes** are connected components (alternating large and small stars), cut by checkpoints.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import checkpointed, clean_worker, pieces, table_of, text_bytes

SEED = 42
SHINGLE, DISTANCE = 3, 3
SEGMENT = 2
SHINGLES_AT_ONCE = 1 << 16
LINKS = "a long, b long, cell long, kind int"
LOW = 0x5555555555555555


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bit i is 1 if it is set in over half of the hashes of the word shingles. No words: 0."""
    digest, join = xxhash.xxh64_intdigest, b" ".join
    counts, n, words = np.zeros(64, np.int64), 0, []
    for piece in pieces(text):
        words += piece.lower().split()
        if len(words) >= shingle:
            runs = zip(*(words[i:] for i in range(shingle)))
            n += _add_bits(counts, [digest(join(run), SEED) for run in runs])
            words = words[len(words) - shingle + 1 :]
    if not n and words:
        n = _add_bits(counts, [digest(join(words), SEED)])
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _add_bits(counts: np.ndarray, hashes: list[int]) -> int:
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = np.array(hashes[at : at + SHINGLES_AT_ONCE], np.uint64)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return len(hashes)


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a (signed) long."""

    clean = clean_worker()

    @F.arrow_udf("long")
    def fingerprints(column: pa.Array) -> pa.Array:
        clean()
        got = []
        for at in range(0, len(column), 512):
            got += [fingerprint(t, shingle) for t in text_bytes(column.slice(at, 512))]
        return pa.array(np.array(got, np.uint64).view(np.int64), pa.int64())

    return fingerprints.asNondeterministic()(text)


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def vector_column(fp: Column) -> Column:
    """The numbers of bits set per two-bit segment, as unary codes in one long."""
    high = F.shiftrightunsigned(fp, 1)
    some, both = fp.bitwiseOR(high).bitwiseAND(F.lit(LOW)), fp.bitwiseAND(high).bitwiseAND(F.lit(LOW))
    return some.bitwiseOR(F.shiftleft(both, 1))


def vectors(fp: np.ndarray) -> np.ndarray:
    one, low = np.uint64(1), np.uint64(LOW)
    return ((fp | (fp >> one)) & low) | (((fp & (fp >> one)) & low) << one)


def masks(blocks: int, keep: int, interleaved: bool = False) -> list[int]:
    """For each choice of ``keep`` of the blocks, the bits of their segments."""
    segments = np.arange(64 // SEGMENT)
    parts = [segments[b::blocks] for b in range(blocks)] if interleaved else np.array_split(segments, blocks)
    bits = [sum(3 << (SEGMENT * int(s)) for s in part) for part in parts]
    return [sum(c) for c in itertools.combinations(bits, keep)]


def in_cells(value: Column, choices: list[int], key: list[Column]) -> Column:
    """One hash per choice of blocks: the cells of the grid that a row lies in. Should two cells ever get
    one hash, they are compared together, which finds nothing wrong."""
    cells = [F.xxhash64(*key, F.lit(i), value.bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(choices)]
    return F.explode(F.array(*cells))


def tree(fp: np.ndarray, other: np.ndarray | None, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all members of a large cell that lie within the distance, at most one per
    member. With ``other``, links between the two arrays are found."""
    both = fp if other is None else np.concatenate([fp, other])
    side = np.zeros(len(both), bool) if other is None else np.arange(len(both)) >= len(fp)
    vector, rest, a, b = vectors(both), np.arange(len(both)), [], []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(vector[rest] ^ vector[at]) <= distance
            if other is not None:
                near &= side[rest] != side[at]
            near[near] = np.bitwise_count(both[rest[near]] ^ both[at]) <= distance
            found = rest[near]
            if len(found):
                a.append(np.full(len(found), both[at]))
                b.append(both[found])
                queue += found.tolist()
                rest = rest[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (both[:0], both[:0])


def compare(cell: np.ndarray, fp: np.ndarray, distance: int, small: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the cells of a sorted array of cells."""
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    sizes = np.diff(np.r_[starts, len(cell)])
    rank = np.arange(len(cell)) - np.repeat(starts, sizes)
    size, vector, links = np.repeat(sizes, sizes), vectors(fp), []
    few = size <= small
    for lag in range(1, small):
        i = np.flatnonzero(few & (rank + lag < size))
        if not len(i):
            break
        i = i[np.bitwise_count(vector[i] ^ vector[i + lag]) <= distance]
        i = i[np.bitwise_count(fp[i] ^ fp[i + lag]) <= distance]
        links.append((fp[i], fp[i + lag]))
    for s, n in zip(starts[sizes > small], sizes[sizes > small]):
        links.append(tree(fp[s : s + n], None, distance))
    return np.concatenate([x for x, _ in links] or [fp[:0]]), np.concatenate([y for _, y in links] or [fp[:0]])


def _rows(a: np.ndarray, b: np.ndarray, cell: int | np.ndarray, kind: int) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array(a.view(np.int64)),
            pa.array(b.view(np.int64)),
            pa.array(np.broadcast_to(np.asarray(cell, np.int64), a.shape)),
            pa.array(np.full(a.shape, kind, np.int32)),
        ],
        names=["a", "b", "cell", "kind"],
    )


def _linker(distance: int, most: int):
    """Over rows sorted by cell: links (kind 0), and the members of cells that are too large (kind 1)."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp, large = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                cell = np.concatenate([cell, batch.column(0).to_numpy()])
                fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            if not len(cell):
                continue
            if large is not None:  # the cell goes on
                n = int(np.searchsorted(cell, large, side="right"))
                yield _rows(fp[:n], fp[:n], large, 1)
                cell, fp = cell[n:], fp[n:]
                if not len(cell):
                    continue
            large, last = None, int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            done = len(cell) if batch is None else last
            size = np.diff(np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True]))
            size = np.repeat(size, size)
            ready = np.arange(len(cell)) < done
            over = ready & (size > most)
            yield _rows(fp[over], fp[over], cell[over], 1)
            fine = ready & ~over & (size > 1)
            if fine.any():
                a, b = compare(cell[fine], fp[fine], distance)
                yield _rows(np.minimum(a, b), np.maximum(a, b), 0, 0)
            if batch is not None and len(cell) - last > most:
                large = int(cell[-1])
                yield _rows(fp[last:], fp[last:], large, 1)
                done = len(cell)
            cell, fp = cell[done:], fp[done:]

    return link


def _link_cells(cells: DataFrame, distance: int, most: int) -> DataFrame:
    dealt = cells.select("cell", "fp").repartition("cell").sortWithinPartitions("cell")
    return table_of(dealt.mapInArrow(_linker(distance, most), LINKS), "links")


def _tile_links(rest: DataFrame, distance: int, most: int) -> DataFrame:
    """Cells that are large after both grids: each pair of tiles of a cell is one group."""
    sizes = rest.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("tiles"))
    tiled = rest.join(sizes, "cell").withColumn("tile", F.pmod(F.xxhash64("fp"), "tiles").cast("int"))
    pairs = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "cell", "fp", "tile", F.least("tile", "other").alias("p"), F.greatest("tile", "other").alias("q")
    )

    def link(table: pa.Table) -> pa.Table:
        fp = table["fp"].to_numpy().view(np.uint64)
        p, q, tile = (table[c].to_numpy() for c in ("p", "q", "tile"))
        if p[0] == q[0]:
            a, b = tree(fp, None, distance)
        else:
            a, b = tree(fp[tile == p[0]], fp[tile == q[0]], distance)
        return pa.Table.from_batches([_rows(np.minimum(a, b), np.maximum(a, b), 0, 0)])

    return pairs.groupBy("cell", "p", "q").applyInArrow(link, LINKS)


def links(fps: DataFrame, distance: int = 3, most: int = 4096) -> DataFrame:
    """Pairs (a, b), a below b as unsigned numbers, of distinct fingerprints ``fp``: each pair is within
    the distance, and all fingerprints that are within it are connected by such pairs."""
    choices = masks(distance + 3, 3)
    cells = fps.select("fp", in_cells(vector_column(F.col("fp")), choices, []).alias("cell"))
    first = _link_cells(cells, distance, most)
    found, large = first.filter("kind = 0").select("a", "b"), first.filter("kind = 1")
    if not large.isEmpty():
        bits = masks(distance + 3, 3, interleaved=True)
        cells = large.select(F.col("a").alias("fp"), in_cells(F.col("a"), bits, [F.col("cell")]).alias("cell"))
        second = _link_cells(cells, distance, most)
        found = found.union(second.filter("kind = 0").select("a", "b"))
        rest = second.filter("kind = 1").select(F.col("a").alias("fp"), "cell")
        if not rest.isEmpty():
            found = found.union(_tile_links(rest, distance, most).select("a", "b"))
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that an edge (a, b) names; root is the smallest node of its component."""
    edges = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")))
    before = None
    while True:
        # Large star: neighbours above a node go to the smallest neighbour.
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        lowest = both.groupBy("v").agg(F.least("v", F.min("u")).alias("m"))
        large = both.join(lowest, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        # Small star: a node and its neighbours below it go to the smallest of them.
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        moved = large.join(lowest, "v").filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        edges = checkpointed(moved.union(lowest.select("v", F.col("m").alias("u"))).distinct())
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "u"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(roots)


def classes(ids: DataFrame, distance: int = 3, most: int = 4096) -> DataFrame:
    """From (id, fp): per distinct fp, ``root`` (the class) and ``component_id`` (its smallest id)."""
    nodes = checkpointed(ids.groupBy("fp").agg(F.min("id").alias("least")))
    linked = components(links(nodes, distance, most))
    linked = checkpointed(nodes.join(linked.withColumnRenamed("node", "fp"), "fp"))
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(smallest, "root").select("fp", "root", "component_id")
    return nodes.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")
    )


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint of its shingles of ``shingle`` words (16 hex digits),
    component_id (the smallest id of all texts that can be reached over links of at most ``distance`` differing bits).

    NULL and empty texts have fingerprint zero and are linked like any other. A NULL id takes part, but is
    not the smallest unless its class has no other; repeated rows are repeated in the result. Other
    columns are not read. An empty table gives an empty result.
    """
    ids = docs.select(F.col(id).alias("id"), F.col(text).alias("_text"))
    ids = table_of(ids.select("id", fingerprint_column(F.col("_text"), shingle).alias("fp")), "fingerprints")
    got = ids.join(classes(ids, distance), "fp", "left")
    return got.select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """The rows of ``docs`` with one document of each class: the one with the smallest id (of repeated
    rows with that id, one). A NULL id comes last. Columns stay as they are."""
    columns = docs.columns
    keyed = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    key, body = F.col(f"c{columns.index(id)}"), F.col(f"c{columns.index(text)}")
    keyed = keyed.withColumns({"_k": F.xxhash64(key), "_t": F.xxhash64(body)})
    ids = keyed.select(key.alias("id"), "_k", "_t", fingerprint_column(body, shingle).alias("fp"))
    ids = table_of(ids, "fingerprints")
    first = ids.join(classes(ids, distance), "fp").filter(F.col("id").eqNullSafe(F.col("component_id")))
    chosen = first.groupBy("root").agg(F.min(F.struct("_k", "_t")).alias("_c")).select("_c._k", "_c._t")
    kept = keyed.join(chosen, ["_k", "_t"], "left_semi").dropDuplicates(["_k", "_t"])
    return kept.drop("_k", "_t").toDF(*columns)
