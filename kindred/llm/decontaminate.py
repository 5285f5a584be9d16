"""Benchmark decontamination by pigeonhole edit matching.

Every test item with m bytes has an error budget of k = m // 15 edits and is split into k + 1 pieces.
Where an item stands in a text with at most k edits, at least one piece stands there unchanged. One
automaton finds all pieces of a block of items in a text; around the hits, Myers' bit-parallel
algorithm computes the least edit distance of the item to any passage.

Items and texts are compared as bytes with letters A-Z lower-cased and every run of other ASCII
characters than letters and digits turned into one blank. The test items are the query set: they are
read in blocks of bounded size, and each block goes over all texts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kindred.llm.common import text_of

PER_EDIT = 15  # bytes of an item for each edit allowed
BLOCK = 4_000_000  # bytes of items in a block

_PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def plain(text: bytes) -> bytes:
    return b" ".join(text.translate(_PLAIN).split())


def pieces(item: bytes, budget: int) -> Iterator[tuple[int, bytes]]:
    """``budget`` + 1 pieces of about equal length, each with its offset."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return ((a, item[a:b]) for a, b in zip(cuts, cuts[1:]))


def myers(item: bytes, text: bytes, budget: int) -> tuple[int, int] | None:
    """Least edit distance of ``item`` to a passage of ``text`` and where the first such passage ends.

    None when it exceeds ``budget``. One step per byte of text, on integers with a bit per byte of
    the item.
    """
    masks = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, last = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, distance = full, 0, len(item)
    best, end = budget + 1, -1
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        vertical = eq | minus
        across = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (~(across | plus) & full)
        down = plus & across
        if up & last:
            distance += 1
        elif down & last:
            distance -= 1
        if distance < best:
            best, end = distance, j + 1
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | (~(vertical | up) & full)
        minus = up & vertical
    return (best, end) if end >= 0 else None


def standing(item: bytes, text: bytes, low: int, high: int) -> int:
    """End of the first place in text[low:high] where ``item`` stands as whole words, -1 without one."""

    def letter(i):
        return 0 <= i < len(text) and (text[i] >= 128 or chr(text[i]).isalnum())

    at = text.find(item, low, high)
    while at >= 0:
        end = at + len(item)
        if not (letter(at - 1) and letter(at) or letter(end - 1) and letter(end)):
            return end
        at = text.find(item, at + 1, high)
    return -1


class Matcher:
    """Finds the items of a block in plain texts."""

    def __init__(self, items: list[tuple[object, bytes]]):
        import ahocorasick

        self.items = items
        self.budgets = [len(item) // PER_EDIT for _, item in items]
        owners = defaultdict(list)
        for i, (_, item) in enumerate(items):
            for offset, piece in pieces(item, self.budgets[i]):
                owners[piece.decode("latin-1")].append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Per item, the merged stretches of the text in which it may stand."""
        spans = defaultdict(list)
        size = len(text)
        for last, (length, where) in self.automaton.iter(text):
            for i, offset in where:
                budget = self.budgets[i]
                start = last + 1 - length - offset
                spans[i].append((max(0, start - budget), min(size, start + len(self.items[i][1]) + budget)))
        merged = {}
        for i, found in spans.items():
            found.sort()
            out = [list(found[0])]
            for a, b in found[1:]:
                if a <= out[-1][1]:
                    out[-1][1] = max(b, out[-1][1])
                else:
                    out.append([a, b])
            merged[i] = out
        return merged

    def matches(self, text: bytes) -> list[tuple[object, int, int]]:
        """(item id, least distance, end of the first such passage) of every item in the text."""
        out = []
        for i, spans in self.windows(text.decode("latin-1")).items():
            id_, item = self.items[i]
            if self.budgets[i]:
                hits = [(m[0], a + m[1]) for a, b in spans if (m := myers(item, text[a:b], self.budgets[i]))]
            else:
                hits = [(0, end) for a, b in spans if (end := standing(item, text, a, b)) >= 0]
            if hits:
                out.append((id_, *min(hits)))
        return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, bytes]]]:
    rows = benchmark.select(id_col, text_of(text_col).alias("text")).distinct()
    block, size = [], 0
    for id_, text in rows.toLocalIterator():
        item = plain(text.encode())
        if not item:
            continue
        block.append((id_, item))
        size += len(item)
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document and test item that stands in its whole text within the error budget.

    Returns ``doc_id``, ``item_id``, ``distance`` (edits of the best passage) and ``passage_end`` (its
    end in the plain text). Null and blank texts and items match nothing; an item of fewer than 15
    bytes must stand unchanged and as whole words. Ids may have any type. Items with the same id are matched each, repeated ones once; repeated
    documents give repeated rows. An empty table gives an empty result. Other columns are not looked
    at.
    """
    spark = docs.sparkSession
    kinds = [f.dataType.simpleString() for f in (docs.schema[id_col], benchmark.schema[item_col])]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, passage_end int"
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).cast("binary").alias("text"))
    out = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, item_col, text_col):

        def run(batches, block=block):
            matcher = Matcher(block)
            for batch in batches:
                rows, found = [], []
                for row, text in enumerate(batch.column("text")):
                    for match in matcher.matches(plain(text.as_py())):
                        rows.append(row)
                        found.append(match)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows, pa.int32())),
                        pa.array([bytes(m[0]) if isinstance(m[0], bytearray) else m[0] for m in found], item_kind),
                        pa.array([m[1] for m in found], pa.int32()),
                        pa.array([m[2] for m in found], pa.int32()),
                    ],
                    ["doc_id", "item_id", "distance", "passage_end"],
                )

        item_kind = to_arrow_type(benchmark.schema[item_col].dataType)
        out = out.unionByName(texts.mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no test item stands, with all their columns.

    A null or blank text holds no item and stays, null and blank items drop nothing. Rows are judged
    one by one, so repeated rows and ids stay or go alike; without documents there are no rows, without
    items all stay. Columns may have any name.
    """
    out = docs
    for block in _blocks(benchmark, item_col, text_col):
        out = out.where(_free_of(block)(text_of(text_col).cast("binary")))
    return out


def _free_of(block):
    @F.pandas_udf("boolean")
    def free(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(block)
        for texts in parts:
            yield pd.Series([not matcher.matches(plain(t)) for t in texts], dtype=bool)

    return free
