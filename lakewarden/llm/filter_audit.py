"""How five filters interact: what each removes at every place of every order in which they may run.

A text is reduced to its mask, one bit per filter that it fails, and documents are counted by part and mask: at most 32
rows a part, whatever the part holds. From them each part gets a decision diagram: one level per filter, two branches
(passed, failed), equal sub-diagrams shared, weights summed from below. Two neighbouring filters change places by
swapping two levels, which rebuilds only the nodes of those levels, and a chain of 119 such swaps visits all 120
orders. In every order the path of passed branches gives the steps: what hangs off it at a level is removed there.

Whether a text repeats that of a smaller id is decided by the least id of each text, joined back by text and id: no
task holds the copies of a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import clean_worker, pieces, table_of, text_bytes

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT = 80  # percent of the words
MAX_UPPER = 10  # percent of the code points
SIGNS = re.compile(rb"[#$%&*|]")
UPPER = bytes(range(65, 91))
WEIGHTS = ("n", "good", "toxic")


def own_mask(text: bytes, length: int) -> int:
    """The failures of a text by itself, filter A in the lowest bit; ``length`` is its number of code points."""
    words, seen = 0, set()
    for piece in pieces(text):
        some = piece.split()
        words += len(some)
        seen.update(some)
    upper = len(text) - len(text.translate(None, UPPER))
    return (
        (words < MIN_WORDS)
        | (100 * len(seen) < MIN_DISTINCT * words) << 1
        | (100 * upper > MAX_UPPER * length) << 2
        | bool(SIGNS.search(text)) << 3
    )


def mask_column(text):
    clean = clean_worker()

    @F.arrow_udf("int")
    def masks(column: pa.Array) -> pa.Array:
        clean()
        out = []
        for at in range(0, len(column), 256):
            part = column.slice(at, 256)
            out += map(own_mask, text_bytes(part), pc.utf8_length(part).fill_null(0).to_pylist())
        return pa.array(out, pa.int32())

    return masks(text)


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and mask of failures, with those of quality 1 and toxic 1."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.col("doc_id").alias("id"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("body"),
        mask_column(F.col("text")).alias("mask"),
    )
    # Repeated rows are one row with their number, so an id or a text of many rows stays small.
    rows = table_of(rows.groupBy("body", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "masks")
    firsts = rows.filter("id IS NOT NULL").groupBy("body").agg(F.min("id").alias("id"))
    firsts = firsts.withColumn("first", F.lit(True))
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
    marks = marks.agg(F.max(F.col("quality") == 1).alias("_good"), F.max(F.col("toxic") == 1).alias("_toxic"))
    again = F.col("id").isNotNull() & F.col("first").isNull()
    joined = rows.join(firsts, ["body", "id"], "left").join(marks, "id", "left")
    counted = {
        "n": F.col("n"),
        "good": F.when(F.col("_good"), F.col("n")).otherwise(0),
        "toxic": F.when(F.col("_toxic"), F.col("n")).otherwise(0),
    }
    return joined.groupBy("part", F.when(again, F.col("mask") + 16).otherwise(F.col("mask")).alias("mask")).agg(
        *[F.sum(c).cast("long").alias(name) for name, c in counted.items()]
    )


class Diagram:
    """A decision diagram over filters 0 to n - 1 that adds up weights by mask.

    A node is a number; ``nodes[k]`` is (passed, failed, sum), for a leaf (None, None, weight). Equal nodes are one.
    """

    def __init__(self, weights: dict[int, tuple[int, ...]], filters: int):
        self.nodes: list[tuple] = []
        self._known: dict[tuple, int] = {}
        self.order = list(range(filters))
        zero = tuple(0 for _ in next(iter(weights.values()), WEIGHTS))
        level = [self._node(None, None, weights.get(m, zero)) for m in range(1 << filters)]
        # The last filter decides nearest to the leaves, so masks are paired by their highest bit first.
        while len(level) > 1:
            half = len(level) // 2
            level = [self._pair(level[i], level[i + half]) for i in range(half)]
        self.root = level[0]

    def _node(self, passed, failed, total) -> int:
        key = (passed, failed, total)
        if key not in self._known:
            self._known[key] = len(self.nodes)
            self.nodes.append(key)
        return self._known[key]

    def _pair(self, passed: int, failed: int) -> int:
        return self._node(passed, failed, tuple(map(sum, zip(self.nodes[passed][2], self.nodes[failed][2]))))

    def swap(self, level: int) -> None:
        """Let the filters of ``level`` and the next one change places. Sums above stay as they are."""
        done: dict[tuple[int, int], int] = {}

        def rebuilt(node: int, depth: int) -> int:
            if (node, depth) not in done:
                passed, failed, _ = self.nodes[node]
                if depth < level:
                    new = self._pair(rebuilt(passed, depth + 1), rebuilt(failed, depth + 1))
                else:
                    (pp, pf, _), (fp, ff, _) = self.nodes[passed], self.nodes[failed]
                    new = self._pair(self._pair(pp, fp), self._pair(pf, ff))
                done[node, depth] = new
            return done[node, depth]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple, tuple, tuple]]:
        """Along the path of passed branches: (filter, kept, removed, failing this filter alone)."""
        node = self.root
        for f in self.order:
            passed, failed, _ = self.nodes[node]
            alone = failed
            while self.nodes[alone][0] is not None:
                alone = self.nodes[alone][0]
            # Earlier filters were passed on this path, later ones on the branch below.
            yield f, self.nodes[passed][2], self.nodes[failed][2], self.nodes[alone][2]
            node = passed


def adjacent_swaps(n: int) -> Iterator[int]:
    """The levels to swap one after the other, so that all n! orders are visited once each."""
    if n < 2:
        return
    inner, down = adjacent_swaps(n - 1), True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        at = next(inner, None)
        if at is None:
            return
        # The moving filter stands first after a sweep down, so the others are one level lower.
        yield at + 1 if down else at
        down = not down


def audit_part(weights: dict[int, tuple[int, ...]], filters: str = FILTERS) -> list[dict]:
    """The rows of one part, for every order and step."""
    diagram = Diagram(weights, len(filters))
    fails = [sum(w[0] for m, w in weights.items() if m >> f & 1) for f in range(len(filters))]
    rows, shares = [], [0] * len(filters)

    def visit() -> None:
        order = "".join(filters[f] for f in diagram.order)
        for step, (f, kept, removed, alone) in enumerate(diagram.steps(), 1):
            shares[f] += removed[0]
            rows.append({
                "filter_order": order, "step": step, "kept": kept[0], "removed": removed[0],
                "redundant": fails[f] - removed[0], "unique_fails": alone[0], "good_lost": removed[1],
                "toxic_lost": removed[2], "shapley": f,
            })

    visit()
    for level in adjacent_swaps(len(filters)):
        diagram.swap(level)
        visit()
    for row in rows:
        row["shapley"] = shares[row["shapley"]]
    return rows


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT = pa.schema(
    [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *[(c, pa.int64()) for c in COUNTS]]
)


def audit_masks(counts: DataFrame) -> DataFrame:
    """From (part, mask, n, good, toxic): a row per part, order and step."""

    def audit(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        weights = {r["mask"]: tuple(r[w] for w in WEIGHTS) for r in table.to_pylist()}
        return pa.Table.from_pylist([{"part": part, **row} for row in audit_part(weights)], AUDIT)

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
    return counts.groupBy("part").applyInArrow(audit, schema)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (language), order and step: documents kept after the step, removed by it, and so on.

    A NULL text is empty; an empty text has no words and is short, nothing else. A NULL language is the part "". Rows
    with the same id and text do not repeat each other, nor does a row with a NULL id repeat any or count as one that is
    repeated. Of several labels of an id, any 1 counts; NULL labels and ids count for nothing. Texts are told apart by
    their SHA-256. Only doc_id, text and lang are read. An empty table gives no rows.
    """
    return audit_masks(masks(docs, labels))
