"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters is looked for anywhere in a document with at most
e = floor(rate * m) edits (insertions, deletions, substitutions). The item is
split into e + 1 pieces; e edits leave at least one piece untouched, so every
match holds an exact piece hit. One Aho-Corasick pass over the document finds
the hits of all pieces of all items, and each hit is verified with Myers'
bit-parallel edit distance.

A hit is verified upwards. The pieces are the leaves of a balanced tree; a
node over p pieces may hold p - 1 edits, because if both halves had at least
as many edits as pieces, the node would have p or more. So on the way from the
item down to some untouched piece every node is within its own budget, and a
hit is given up at the first node on its way up that is not. Chance hits end
after a short comparison.

Texts are compared after lower-casing A-Z and turning every run of white
space into one space. An item of fewer than MIN_CHARS characters must also
begin and end where words do, within the same budget: its pieces find the
place, and the substrings there that have such edges are compared with it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from vehicle_metrics.llm.common import fresh, text_blocks

EDIT_RATE = 0.1
MIN_CHARS = 40  # shorter items match only as whole words
BLOCK_CHARS = 4_000_000  # of item text sent to the tasks at a time


def normalise(text: bytes) -> str:
    return b" ".join(text.lower().split()).decode("utf-8", "replace")


def budget(length: int, rate: float) -> int:
    return int(rate * length)


def whole_words(item: str, text: str, start: int, errors: int, reach: int) -> tuple[int, int] | None:
    """The best (distance, end) within ``errors`` of the substrings of
    ``text`` that begin at most ``reach`` from ``start`` and begin and end at
    the edge of a word."""
    best = None
    for a in range(max(0, start - reach), start + reach + 1):
        if a > len(text) or (a and text[a - 1] != " "):
            continue
        row = list(range(len(item) + 1))
        for b in range(a + 1, min(len(text), a + len(item) + errors) + 1):
            new = [row[0] + 1]
            for j, c in enumerate(item, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != text[b - 1])))
            row = new
            if row[-1] <= errors and (b == len(text) or text[b] == " ") and (best is None or (row[-1], b) < best):
                best = row[-1], b
    return best


def cuts(length: int, errors: int) -> list[int]:
    """Ends of errors + 1 consecutive pieces whose lengths are at most one apart."""
    return [i * length // (errors + 1) for i in range(errors + 2)]


def climb(piece: int, pieces: int) -> list[tuple[int, int]]:
    """The ranges of pieces of the tree nodes above a piece, the lowest first."""
    path, a, b = [], 0, pieces
    while b - a > 1:
        path.append((a, b))
        middle = (a + b + 1) // 2
        a, b = (a, middle) if piece < middle else (middle, b)
    return path[::-1]


def char_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(distance, end): the least edit distance between the pattern of ``m``
    characters and any substring of ``text``, and where the first such
    substring ends. One Python integer holds a column of the distance matrix."""
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, now, best, end = full, 0, m, m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & last:
            now += 1
        elif down & last:
            now -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        if now < best:
            best, end = now, at
    return best, end


def matcher(items: list[tuple[int, str]], rate: float, min_chars: int):
    """A function from a normalised text to {item index: (distance, end)} for
    the items it contains within their budgets."""
    import ahocorasick

    budgets = [budget(len(t), rate) for _, t in items]
    ends = [cuts(len(t), e) for (_, t), e in zip(items, budgets)]
    places: dict[str, list[tuple[int, int]]] = {}
    for i, (_, t) in enumerate(items):
        for p, (a, b) in enumerate(zip(ends[i], ends[i][1:])) if t else ():
            places.setdefault(t[a:b], []).append((i, p))
    machine = ahocorasick.Automaton()
    for piece, where in places.items():
        machine.add_word(piece, (len(piece), where))
    if places:
        machine.make_automaton()
    masks: dict[tuple[int, int, int], dict[str, int]] = {}

    def exact(i: int, text: str, at: int) -> bool:
        whole = len(items[i][1]) >= min_chars
        after = at + len(items[i][1])
        return whole or ((at == 0 or text[at - 1] == " ") and (after == len(text) or text[after] == " "))

    def near(i: int, a: int, b: int, text: str, start: int, slack: int) -> tuple[int, int]:
        """The best match of characters a to b of item i around ``start``."""
        if (i, a, b) not in masks:
            masks[i, a, b] = char_masks(items[i][1][a:b])
        begin = max(0, start - slack)
        distance, end = myers(masks[i, a, b], b - a, text[begin:start + b - a + slack])
        return distance, begin + end

    def find(text: str) -> dict[int, tuple[int, int]]:
        found: dict[int, tuple[int, int]] = {}
        tried: dict[int, list[int]] = {}  # where items were verified whole
        for last, (length, where) in machine.iter(text) if places else ():
            at = last + 1 - length
            for i, p in where:
                cut, e, size = ends[i], budgets[i], len(items[i][1])
                start = at - cut[p]
                if e == 0:
                    if exact(i, text, at) and i not in found:
                        found[i] = 0, at + size
                    continue
                # A whole verification reaches 2 e characters to each side, so it covers what starts within e.
                if any(abs(start - s) <= e for s in tried.get(i, ())):
                    continue
                for a, b in climb(p, e + 1)[:-1]:
                    if near(i, cut[a], cut[b], text, start + cut[a], b - a - 1)[0] > b - a - 1:
                        break
                else:
                    tried.setdefault(i, []).append(start)
                    hit = near(i, 0, size, text, start, 2 * e)
                    if size < min_chars:
                        hit = whole_words(items[i][1], text, start, e, 2 * e) or (e + 1, 0)
                    if hit[0] <= e and (i not in found or hit < found[i]):
                        found[i] = hit
        return found

    return find


def item_blocks(benchmark: DataFrame, item_id: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_chars`` characters each, one block
    on the driver at a time; NULL and empty items match nothing."""
    rows = benchmark.select(F.col(item_id).alias("id"), F.col(text_col).cast("string").alias("body")).where(
        "length(trim(body)) > 0").withColumn("row", F.monotonically_increasing_id())
    total = rows.agg(F.sum(F.length("body"))).first()[0] or 0
    n = -(-total // block_chars)
    for i in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "body", "row"), F.lit(n)) == i).orderBy("id", "body")
        block = [(r.id, normalise(r.body.encode())) for r in part.toLocalIterator()]
        if block:
            yield block


def _shared_matcher(spark, block, rate, min_chars):
    shared = spark.sparkContext.broadcast(block)
    return lambda: (shared.value, matcher(shared.value, rate, min_chars))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE,
               min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item, edits, budget, match_end): one row for each document row and
    test item that it contains; ``edits`` is the least distance, ``match_end``
    the character of the normalised text where that match ends.

    The items are a query set: each block of them is sent to the tasks and all
    documents are scanned against it. NULL or empty documents and items match
    nothing; equal items each match; repeated document rows each get rows; an
    item shorter than ``min_chars`` must begin and end at the edge of a word.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    item_type = benchmark.schema[item_id].dataType
    arrow_item = to_arrow_type(item_type)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    fields = StructType([StructField("id", id_type), StructField("item", item_type), StructField("edits", LongType()),
                         StructField("budget", LongType()), StructField("match_end", LongType())])

    def scan(load):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items, find = load()
            for part, texts in text_blocks(batches, "body"):
                hits = [(row, i, edits, end) for row, text in enumerate(texts)
                        for i, (edits, end) in sorted(find(normalise(text)).items())]
                if hits:
                    row, i, edits, end = map(list, zip(*hits))
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(row)), pa.array([items[x][0] for x in i], arrow_item),
                        pa.array(edits, pa.int64()),
                        pa.array([budget(len(items[x][1]), rate) for x in i], pa.int64()),
                        pa.array(end, pa.int64())], names=fields.names)
        return run

    found = None
    for block in item_blocks(benchmark, item_id, item_text, block_chars):
        part = rows.mapInArrow(scan(_shared_matcher(spark, block, rate, min_chars)), fields)
        found = part if found is None else found.unionByName(part)
    found = spark.createDataFrame([], fields) if found is None else found
    taken = {id_col.lower()}
    item_name = item_id if item_id.lower() not in taken else f"{item_id}_"
    return found.withColumnsRenamed({"id": id_col, "item": item_name})


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", rate: float = EDIT_RATE, min_chars: int = MIN_CHARS,
                      block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that contain no test item, with their own columns;
    rows are filtered in place, without a shuffle. NULL and empty documents
    contain none and stay, NULL and empty items match nothing, and repeated
    rows are each judged; an empty table on either side drops nothing."""
    spark, body = docs.sparkSession, fresh(docs, "_body")
    kept = docs.withColumn(body, F.col(text_col).cast("string"))
    for block in item_blocks(benchmark, item_id, item_text, block_chars):
        load = _shared_matcher(spark, block, rate, min_chars)

        def run(batches: Iterable[pa.RecordBatch], load=load) -> Iterator[pa.RecordBatch]:
            _, find = load()
            for part, texts in text_blocks(batches, body):
                yield part.filter(pa.array([not find(normalise(t)) for t in texts], pa.bool_()))

        kept = kept.mapInArrow(run, kept.schema)
    return kept.select(*docs.columns)
