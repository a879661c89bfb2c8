"""Language-model scores by online logistic context mixing.

A text is read as bytes: its words (A-Z lower-cased), each followed by a space,
then one newline. Each byte is eight binary decisions, the path through a
binary tree of 255 nodes. Predictors give a probability for each decision:
hashed contexts of the last 0 to 4 bytes, which reach back to the space before
the word, and the word so far, whose counts are exact. Their log-odds are added
with weights gated by the bit's position and by how much the longest context
and the word so far have seen; a refinement table maps the mixed probability,
for each tree node, to the rate that followed. The product over all decisions
is the probability of the text, so total bits per byte follow. A word's first
byte is predicted from the last two bytes of the word before it instead.

So the cost of a word without its first byte is the same wherever it stands,
and every distinct word of the corpus is worked out once:

* words, and first bytes with the two bytes before them, are counted over all
  rows in one shuffle of what each task has summed, with how often they stand
  in training rows and in those set aside for the weights. The table of words
  grows with the corpus; no word is left out;
* words are dealt by their first bytes and sorted. Neighbours share their
  prefixes, so each prefix and byte that follows it is one edge, met once, with
  the exact counts of the words behind it;
* the counts of hashed contexts are sums over edges into a table of fixed size;
* weights and refinement are learned online: each task goes over its edges in
  order, in small steps, each edge as often as it stands in the rows set aside,
  against the counts of the other training rows. The tasks' weights are averaged
  by the bytes they have read;
* the costs follow from the counts of all training rows. Those of the commonest
  words go to every task, the others reach the rows by a join on the word, so
  every part of a row's score is the same wherever the row lies.
"""

from __future__ import annotations

import gc
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vehicle_metrics.llm.common import heavy_keys, look_up, text_blocks
from vehicle_metrics.storage import materialize

ORDERS = (1, 2, 3, 4)
SLOT_BITS = 22  # slots of the hashed contexts' tree nodes, all orders together
HOME = 4  # words are dealt by their first bytes, this many
GROUP = 500_000  # distinct words of one home, at most; a larger home is dealt by more bytes
LONGER = (8, 16, 32, 64, 128)
FREQUENT = 1 << 17  # words, at most, that every task knows the counts and costs of
FREQUENT_BYTES = 64  # longer words are looked up by a join instead
COUNTED = 1 << 20  # distinct words a counting task holds before it emits them
CHUNK = 1 << 14  # words that a task works on at a time, and the rest of their home
CHUNK_BYTES = 1 << 21  # ... or bytes
WAY = 32  # bytes of the predictions on the way to one byte: 8 from all counts, 8 without the rows set aside
BLOCK = 3 << 19  # bytes of text worked on at a time
STEP = 1 << 12  # edges that weights are learned from at a time
RIDGE = 50.0  # curvature that the first weights stand for
INPUTS = len(ORDERS) + 3  # contexts, none, word, bias
GATES = 8 * 3 * 3
LEVELS = 24  # of the refinement table
PRIOR = 30.0  # decisions that the mixed probability stands for in the refinement table
MIX = np.uint64(0x9E3779B97F4A7C15)
ROOT = np.uint64(0xD6E8FEB86659FD93)
SPACE, LINE = 32, 10


@dataclass(frozen=True)
class Split:
    parts: int = 5
    held_out: int = 1
    weights: int = 4  # the training part that weights are learned from, against the counts of the others


def canonical(text: bytes) -> list[bytes]:
    return text.lower().split()


def stream(words: list[bytes]) -> bytes:
    """A text's bytes after three that stand before it."""
    return b"\n\n " + b"".join(w + b" " for w in words) + b"\n"


def head_events(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) of the bytes that follow a space: the two bytes before
    the space, then the byte itself."""
    at = np.flatnonzero(flat[:-1] == SPACE) + 1
    f = flat.astype(np.int64)
    return at, f[at - 3] << 16 | f[at - 2] << 8 | f[at]


# -- counting -------------------------------------------------------------------

ORDER = ("home", "concat(word, X'20')")  # as the words stand in a text, with the space behind them
COUNTS = "home binary, word binary, head int, seen long, n long, apart long"


def count_corpus(docs: DataFrame, split: Split) -> DataFrame:
    """(home, word, head, seen, n, apart), dealt and sorted by home and word:
    ``seen`` counts a word or head event in all rows, ``n`` in the training
    rows, ``apart`` in those that weights are learned from. Either word is set
    or head. ``docs`` has columns part and body; a NULL part is not learned from."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, heads = [Counter(), Counter(), Counter()], [Counter(), Counter(), Counter()]  # not learned from, learned from, apart

        def emit(counters: list[Counter], is_word: bool) -> Iterator[pa.RecordBatch]:
            keys = list(set().union(*counters))
            sums = [np.fromiter(map(c.__getitem__, keys), np.int64, len(keys)) for c in counters]
            columns = [sum(sums), sums[1] + sums[2], sums[2]]
            none = pa.nulls(len(keys))
            named = ([pa.array([(k + b" ")[:HOME] for k in keys], pa.binary()), pa.array(keys, pa.binary()), none.cast(pa.int32())]
                     if is_word else [pa.array([k.to_bytes(3, "big") for k in keys], pa.binary()), none.cast(pa.binary()),
                                      pa.array(keys, pa.int32())])
            for c in counters:
                c.clear()
            yield pa.RecordBatch.from_arrays([*named, *map(pa.array, columns)], names=["home", "word", "head", "seen", "n", "apart"])

        for part, texts in text_blocks(batches, "body", size=BLOCK):
            which = part.column(part.schema.get_field_index("part")).to_pylist()
            kinds = [0 if p is None or p == split.held_out else 2 if p == split.weights else 1 for p in which]
            for kind in range(3):
                cut = [canonical(t) for t, k in zip(texts, kinds) if k == kind]
                if cut:
                    for w in cut:
                        words[kind].update(w)
                    _, key = head_events(np.frombuffer(b"".join(map(stream, cut)), np.uint8))
                    found, n = np.unique(key, return_counts=True)
                    heads[kind].update(dict(zip(found.tolist(), n.tolist())))
            if sum(map(len, words)) > COUNTED:
                yield from emit(words, True)
        yield from emit(words, True)
        yield from emit(heads, False)

    counted = docs.mapInArrow(run, COUNTS)
    # Each task has summed its own rows, so a word has at most a few rows from each.
    return counted.repartition("home").groupBy("home", "word", "head").agg(
        *[F.sum(c).alias(c) for c in ("seen", "n", "apart")]).sortWithinPartitions(*map(F.expr, ORDER))


def deal(counts: DataFrame, group: int = GROUP) -> DataFrame:
    """``counts`` with longer homes for the words of a home with more than
    ``group`` words, so that their words lie in several tasks; ``above_homes``
    has the exact counts of the prefixes that such homes share. There are at
    most (words / group) homes that are cut."""
    for size in LONGER:
        heavy = counts.where("word IS NOT NULL").groupBy("home").agg(F.count("*").alias("words")).where(F.col("words") > group)
        heavy = materialize(heavy.select("home", F.lit(True).alias("heavy")), "lm_homes")
        if not heavy.limit(1).count():
            break
        longer = F.expr(f"substring(concat(word, X'20'), 1, {size})")
        home = F.when(F.col("heavy") & F.col("word").isNotNull(), longer).otherwise(F.col("home"))
        counts = materialize(counts.join(F.broadcast(heavy), "home", "left").withColumn("home", home).drop("heavy"), "lm_dealt")
    return counts


def above_homes(counts: DataFrame) -> DataFrame:
    """(home, above) for the homes of more than HOME bytes: the predictions on
    the way through the home's own bytes from the byte after HOME on, 16 for
    each, from all counts and from those without the rows set aside. Words of
    other homes share these prefixes, so they are counted over all homes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [(i << 8 | x["grown"][-1], x["grown"], x["n"], x["apart"])
                    for i, found in enumerate(batch.column(0).to_pylist()) for x in found]
            if not held:
                continue
            key, n, apart = (np.array([x[c] for x in held], np.int64) for c in (0, 2, 3))
            paths = np.concatenate([path_predictions(key, n), path_predictions(key, n - apart)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([x[1] for x in held], pa.binary()), pa.array([x.tobytes() for x in paths], pa.binary())],
                                             names=["grown", "paths"])

    homes = counts.where(f"word IS NOT NULL AND length(home) > {HOME}").groupBy("home").agg(F.sum("n").alias("n"), F.sum("apart").alias("apart"))
    steps = materialize(homes, "lm_long_homes").selectExpr("*", f"explode(sequence({HOME}, length(home) - 1)) AS depth").selectExpr(
        "*", "substring(home, 1, depth + 1) AS grown")
    edges = steps.groupBy("grown").agg(F.sum("n").alias("n"), F.sum("apart").alias("apart"))
    # At most 256 bytes follow a prefix.
    beside = edges.groupBy(F.expr("substring(grown, 1, length(grown) - 1)").alias("prefix")).agg(
        F.sort_array(F.collect_list(F.struct("grown", "n", "apart"))).alias("found")).select("found")
    paths = beside.mapInArrow(run, "grown binary, paths binary")
    hubs = materialize(heavy_keys(steps, "grown", steps.count()), "lm_long_hubs")
    met = look_up(steps, hubs, paths, "grown").groupBy("home").agg(F.sort_array(F.collect_list(F.struct("depth", "paths"))).alias("found"))
    return materialize(met.selectExpr("home", "transform(found, x -> x.paths) AS above"), "lm_above")


def by_home(counts: DataFrame, above: DataFrame) -> DataFrame:
    """``counts`` dealt and sorted by home; a home that has a row in ``above``
    gets it before its words, as a row without word and head, its predictions
    one after the other. Nearly all rows have a NULL there, and for a NULL array
    (not for NULL bytes) Arrow's writer goes over the whole batch."""
    joined = above.selectExpr("home", "aggregate(above, X'', (paths, x) -> concat(paths, x)) AS above")
    rows = counts.select("home", "word", "head", "n", "apart").unionByName(joined, allowMissingColumns=True)
    return rows.repartition("home").sortWithinPartitions(*map(F.expr, ORDER))


# -- edges: prefixes and the bytes that follow them --------------------------------

@dataclass
class Edges:
    """The distinct (prefix, next byte) of sorted words, and head events.

    ``context`` holds the last four bytes, the nearest lowest; ``word`` and
    ``depth`` say where the edge was first met (word -1: a head event)."""
    word: np.ndarray
    depth: np.ndarray
    context: np.ndarray
    byte: np.ndarray
    n: np.ndarray
    apart: np.ndarray
    paths: np.ndarray | None  # (edges, 8) packed predictions of the word so far
    paths_before: np.ndarray | None  # the same, from the counts without the rows set aside


def common_prefixes(flat: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each word, how many bytes it shares with the word before; the words
    are sorted, differ, and end with a space."""
    shared = np.zeros(len(start), np.int64)
    active = np.arange(1, len(start))
    d = 0
    while len(active):
        active = active[flat[start[active] + d] == flat[start[active - 1] + d]]
        d += 1
        shared[active] = d
    return shared


def packed(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Predictions from counts: log-odds in 14 bits, amount seen in 2 bits."""
    odds = np.log((one + 0.08) / (zero + 0.08))
    value = np.clip(np.rint(odds * 128), -2047, 2047).astype(np.int64) + 2048
    seen = np.where(zero + one == 0, 0, np.where(zero + one < 4, 1, 2))
    return np.where(seen > 0, value << 2 | seen, 0).astype(np.uint16)


def path_predictions(key: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Packed predictions of the 8 nodes on the way to each byte (rows).
    ``key`` is 256 times the number of the context plus the byte, ascending
    and without repeats; ``n`` are the counts of the bytes after the context."""
    out = np.zeros((len(key), 8), np.uint16)
    for k in range(8):
        node = key >> (8 - k)
        new = np.concatenate([[True], node[1:] != node[:-1]])
        starts, at = np.flatnonzero(new), np.cumsum(new) - 1
        total = np.add.reduceat(n, starts)[at]
        one = np.add.reduceat(n * (key >> (7 - k) & 1), starts)[at]
        out[:, k] = packed(total - one, one)
    return out


def word_edges(words: list[bytes], homes: np.ndarray, n: np.ndarray, apart: np.ndarray, paths: bool = True,
               above: tuple[np.ndarray, np.ndarray] | None = None) -> Edges:
    """The edges of sorted distinct words, but for the first byte, in the order
    in which the words meet them. ``homes`` is the length of each word's home,
    ``above`` (each word's first row, predictions) has its home's own bytes."""
    size = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    flat = np.frombuffer(b"    " + b" ".join(words) + b" ", np.uint8)
    start = 4 + np.cumsum(size) - size
    shared = common_prefixes(flat, start)
    after = np.append(shared[1:], 0)
    first = np.maximum(1, shared)
    count = size - first
    word = np.repeat(np.arange(len(words)), count)
    depth = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count) + first[word]
    at = start[word] + depth
    byte = flat[at].astype(np.int64)
    context = np.zeros(len(word), np.int64)
    for k in range(1, 5):  # the space before the word is the last byte looked at
        context |= np.where(depth - k >= -1, flat[at - k].astype(np.int64), 0) << (8 * (k - 1))
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (n, apart)]
    own_n, own_apart = n[word], apart[word]
    shape = (len(word), 8)
    found = [np.zeros(shape, np.uint16), np.zeros(shape, np.uint16)] if paths else [None, None]

    # Edges that other words may share or stand beside, depth by depth; the others belong to one word alone.
    near = np.flatnonzero(depth <= np.maximum(shared, after)[word])
    near = near[np.argsort(depth[near], kind="stable")]
    cuts = np.flatnonzero(np.diff(depth[near])) + 1
    for e in np.split(near, cuts) if len(near) else ():
        d = depth[e[0]]
        ends = np.append(np.flatnonzero(shared <= d), len(words))
        end = ends[np.searchsorted(ends, word[e], "right")]
        own_n[e], own_apart[e] = (s[end] - s[word[e]] for s in sums)
        if paths:
            ok = e[homes[word[e]] <= d]
            if len(ok):
                key = np.searchsorted(np.flatnonzero(shared < d), word[ok], "right") << 8 | byte[ok]
                found[0][ok] = path_predictions(key, own_n[ok])
                found[1][ok] = path_predictions(key, own_n[ok] - own_apart[ok])
    if paths:
        alone = np.flatnonzero((depth > np.maximum(shared, after)[word]) & (depth >= homes[word]))
        bits = byte[alone, None] >> (7 - np.arange(8)) & 1
        for out, total in ((found[0], own_n[alone]), (found[1], (own_n - own_apart)[alone])):
            out[alone] = packed(total[:, None] * (1 - bits), total[:, None] * bits)
        if above is not None:
            own = np.flatnonzero((depth >= HOME) & (depth < homes[word]))
            at = above[0][word[own]] + depth[own] - HOME
            for out, side in zip(found, (slice(0, 8), slice(8, 16))):
                out[own] = above[1][at, side]
    return Edges(word, depth, context, byte, own_n, own_apart, *found)


def head_edges(head: np.ndarray, n: np.ndarray, apart: np.ndarray, paths: bool = True) -> Edges:
    """First bytes as edges: the context is the space and the two bytes before it."""
    context = SPACE | (head >> 8 & 255) << 8 | (head >> 16) << 16
    none = np.zeros((len(head), 8), np.uint16) if paths else None
    return Edges(np.full(len(head), -1), np.zeros(len(head), np.int64), context, head & 255, n, apart, none, none)


def word_costs(edges: Edges, cost: np.ndarray, shared: np.ndarray, n_words: int) -> np.ndarray:
    """Each word's sum of edge costs: of its own edges, and of those that it
    shares with words before it."""
    total = np.bincount(edges.word, cost, n_words)
    first = np.maximum(1, shared)
    start = np.searchsorted(edges.word, np.arange(n_words))
    left = np.flatnonzero(shared > 1)
    d = 1
    while len(left):
        owners = np.flatnonzero(shared <= d)
        owner = owners[np.searchsorted(owners, left, "right") - 1]
        total[left] += cost[start[owner] + d - first[owner]]
        d += 1
        left = left[shared[left] > d]
    return total


def chunks(batches: Iterable[pa.RecordBatch], whole_homes: bool = True) -> Iterator[tuple]:
    """(words, home lengths, heads, n, apart, above) of consecutive rows, a
    home's words together; words first in n and apart, then heads."""
    held: list[tuple] = []
    size = 0

    def out() -> tuple:
        words = [r for r in held if r[1] is not None]
        heads = [r for r in held if r[2] is not None]
        ways, first, n_ways = [], {}, 0
        for r in held:
            if r[5] is not None:
                first[r[0]] = n_ways
                ways.append(r[5])
                n_ways += len(r[5]) // WAY
        numbers = np.array([(r[3], r[4]) for r in [*words, *heads]], np.int64).reshape(-1, 2)
        return ([r[1] for r in words], np.array([len(r[0]) for r in words], np.int64),
                np.array([r[2] for r in heads], np.int64), numbers[:, 0], numbers[:, 1],
                (np.array([first.get(r[0], 0) for r in words], np.int64), np.frombuffer(b"".join(ways), np.uint16).reshape(-1, 16)))

    for batch in batches:
        get = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()  # noqa: E731, B023
        above = get("above") if "above" in batch.schema.names else repeat(None)
        for row in zip(get("home"), get("word"), get("head"), get("n"), get("apart"), above):
            if (len(held) >= CHUNK or size > CHUNK_BYTES) and (not whole_homes or row[0] != held[-1][0]):
                yield out()
                held, size = [], 0
            held.append(row)
            size += len(row[1] or b"")
    if held:
        yield out()


# -- hashed contexts ---------------------------------------------------------------

def slots(context: np.ndarray, byte: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(order, bit position, slot) of the nodes on the way to each byte."""
    for order in (0, *ORDERS):
        own = (context & ((1 << 8 * order) - 1)).astype(np.uint64) * np.uint64(8) + np.uint64(order)
        h = (own + np.uint64(1)) * MIX
        h ^= h >> np.uint64(29)
        for k in range(8):
            node = (1 << k | byte >> (8 - k)).astype(np.uint64)
            yield order, k, ((h + node * MIX) * ROOT >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def count_grams(counts: DataFrame) -> DataFrame:
    """(gram, n, apart): each context of four bytes and byte after it."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def merged() -> list[tuple[np.ndarray, ...]]:
            gram, n, apart = map(np.concatenate, zip(*held))
            keys, at = np.unique(gram, return_inverse=True)
            return [(keys, *(np.bincount(at, x, len(keys)).astype(np.int64) for x in (n, apart)))]

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["gram", "n", "apart"])

        for words, homes, head, n, apart, _ in chunks(batches, False):
            w = len(words)
            for e in (word_edges(words, homes, n[:w], apart[:w], False) if w else None, head_edges(head, n[w:], apart[w:], False)):
                if e is not None:
                    ok = e.n > 0
                    held.append((e.context[ok] << 8 | e.byte[ok], e.n[ok], e.apart[ok]))
            held = merged()
            if len(held[0][0]) > COUNTED:
                yield emit()
                held = []
        if held:
            yield emit()

    return counts.where("n > 0").mapInArrow(run, "gram long, n long, apart long").groupBy("gram").agg(
        F.sum("n").alias("n"), F.sum("apart").alias("apart"))


def slot_tables(grams: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(packed predictions of all slots from the counts without the rows set
    aside, the same from all counts). The tables have a fixed size."""
    size = 1 << SLOT_BITS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, size))
        for batch in batches:
            gram, n, apart = (batch.column(i).to_numpy() for i in range(3))
            for a in range(0, len(gram), 1 << 16):
                g, x, y = gram[a:a + (1 << 16)], n[a:a + (1 << 16)].astype(float), apart[a:a + (1 << 16)].astype(float)
                byte = g & 255
                for _, k, slot in slots(g >> 8, byte):
                    one = (byte >> (7 - k) & 1) == 1
                    for row, weights in ((0, x * ~one), (1, x * one), (2, y * ~one), (3, y * one)):
                        np.add.at(sums[row], slot, weights)
        at = np.flatnonzero(sums[:2].any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(s[at]) for s in sums)],
                                         names=["slot", "a", "b", "c", "d"])

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, c, d = (batch.column(i).to_numpy() for i in range(1, 5))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed(a - c, b - d).view(np.int16)),
                                              pa.array(packed(a, b).view(np.int16))], names=["slot", "before", "every"])

    # Each task may fill the whole table, so there are few of them, of many grams each.
    tasks = max(1, min(64, grams.count() >> 20))
    sums = grams.coalesce(tasks).mapInArrow(run, "slot int, a double, b double, c double, d double").groupBy("slot").agg(
        *[F.sum(c).alias(c) for c in "abcd"])
    before, every = np.zeros(size, np.uint16), np.zeros(size, np.uint16)
    stored = materialize(sums.mapInArrow(pack, "slot int, before short, every short"), "lm_slots")
    share = 8  # read in parts, 2^19 slots at most each
    for i in range(share):
        found = stored.where(F.shiftright("slot", SLOT_BITS - 3) == i).toArrow()
        at = found["slot"].to_numpy()
        before[at], every[at] = (found[c].to_numpy().view(np.uint16) for c in ("before", "every"))
    return before, every


# -- mixing ---------------------------------------------------------------------

def _squash(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-odds))


def _level(odds: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((odds + 9) * ((LEVELS - 1) / 18)), 0, LEVELS - 1).astype(np.int64)


_VALUES = np.arange(1 << 16)
ODDS = np.where(_VALUES > 0, ((_VALUES >> 2) - 2048) / 128, 0).astype(np.float32)


def predictions(table: np.ndarray, context: np.ndarray, byte: np.ndarray, paths: np.ndarray):
    """For each bit: (inputs, gate, node, bit) arrays over the edges."""
    found = {(order, k): table.take(slot) for order, k, slot in slots(context, byte)}
    for k in range(8):
        inputs = np.empty((INPUTS, len(byte)), np.float32)
        for i, order in enumerate((*ORDERS, 0)):
            inputs[i] = ODDS.take(found[order, k])
        inputs[-2] = ODDS.take(paths[:, k])
        inputs[-1] = 0.3
        gate = k * 9 + (found[ORDERS[-1], k] & 3).astype(np.int64) * 3 + (paths[:, k] & 3)
        yield inputs, gate, (1 << k | byte >> (8 - k)), byte >> (7 - k) & 1


def mix(weights: np.ndarray, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
    return np.clip((np.take(weights, gate, axis=1) * inputs).sum(0), -14, 14)


def first_weights() -> np.ndarray:
    weights = np.full((INPUTS, GATES), 0.3, np.float32)
    weights[-1] = 0.0
    return weights


class Learner:
    """Weights learned online, in small steps over edges in order: each step
    moves a weight by its gradient over the curvature met so far. In the same
    pass the refinement table follows what came after each mixed probability."""

    def __init__(self):
        self.weights = first_weights()
        self.curvature = np.full((INPUTS, GATES), RIDGE)
        self.refine = np.zeros((256 * LEVELS, 2))
        self.bytes = 0.0

    def learn(self, table: np.ndarray, context: np.ndarray, byte: np.ndarray, paths: np.ndarray, times: np.ndarray) -> None:
        for inputs, gate, node, bit in predictions(table, context, byte, paths):
            odds = mix(self.weights, inputs, gate)
            p = _squash(odds.astype(float))
            miss, bend = times * (bit - p), times * p * (1 - p)
            # Inputs pull together, so each one answers for the curvature of the whole step.
            reach = np.abs(inputs).sum(0)
            for i in range(INPUTS):
                self.curvature[i] += np.bincount(gate, bend * np.abs(inputs[i]) * reach, GATES)
                self.weights[i] += (np.bincount(gate, miss * inputs[i], GATES) / self.curvature[i]).astype(np.float32)
            self.refine += np.bincount((node * LEVELS + _level(odds)) * 2 + bit, times, self.refine.size).reshape(-1, 2)
        self.bytes += float(times.sum())


def refinement(sums: np.ndarray) -> np.ndarray:
    """Probabilities by node and level, drawn to the level's own where little was seen."""
    middle = _squash((np.arange(LEVELS) * 18 / (LEVELS - 1) - 9)[None, :].repeat(256, 0)).ravel()
    return ((sums[:, 1] + PRIOR * middle) / (sums.sum(1) + PRIOR)).astype(np.float32)


def learn_weights(counts: DataFrame, above: DataFrame, table) -> tuple[np.ndarray, np.ndarray]:
    """(weights by input and gate, refinement by node and level). The tasks
    send what they have learned, of a fixed size, times the bytes read."""
    n_weights = INPUTS * GATES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner()
        for words, homes, head, n, apart, above in chunks(batches):
            w = len(words)
            for e in (word_edges(words, homes, n[:w], apart[:w], above=above) if w else None, head_edges(head, n[w:], apart[w:])):
                at = np.flatnonzero(e.apart > 0) if e is not None else ()
                for a in range(0, len(at), STEP):
                    s = at[a:a + STEP]
                    learner.learn(table.value, e.context[s], e.byte[s], e.paths_before[s], e.apart[s].astype(float))
        if learner.bytes:
            value = np.concatenate([learner.weights.ravel() * learner.bytes, learner.refine.ravel(), [learner.bytes]])
            at = np.flatnonzero(value)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(value[at])], names=["key", "a"])

    out = np.zeros(n_weights + 512 * LEVELS + 1)
    # A word's edges may have been counted where the word itself does not stand apart, so all rows are read.
    for r in by_home(counts, above).mapInArrow(run, "key long, a double").groupBy("key").agg(F.sum("a").alias("a")).collect():
        out[r.key] = r.a
    weights = (out[:n_weights] / out[-1]).reshape(INPUTS, GATES).astype(np.float32) if out[-1] else first_weights()
    return weights, refinement(out[n_weights:-1].reshape(-1, 2))


def edge_costs(table: np.ndarray, weights: np.ndarray, refined: np.ndarray, context: np.ndarray, byte: np.ndarray,
               paths: np.ndarray) -> np.ndarray:
    """log10 probability of each edge's byte."""
    out = np.empty(len(byte))
    for a in range(0, len(byte), 1 << 15):
        part = slice(a, a + (1 << 15))
        product = np.ones(len(byte[part]))  # of eight probabilities, each above 1e-7
        for inputs, gate, node, bit in predictions(table, context[part], byte[part], paths[part]):
            odds = mix(weights, inputs, gate)
            p = 0.5 * _squash(odds) + 0.5 * refined.take(node * LEVELS + _level(odds))
            product *= np.where(bit == 1, p, 1 - p)
        out[part] = np.log10(product)
    return out


def add_costs(counts: DataFrame, above: DataFrame, table, mixing) -> DataFrame:
    """(word, head, seen, n, cost): log10 probability of each word after its
    first byte, the space behind it included, or of each head event."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, refined = mixing.value
        for words, homes, head, n, apart, above in chunks(batches):
            w = len(words)
            parts = []
            if w:
                e = word_edges(words, homes, n[:w], apart[:w], above=above)
                cost = edge_costs(table.value, weights, refined, e.context, e.byte, e.paths)
                flat, size = np.frombuffer(b" ".join(words) + b" ", np.uint8), np.fromiter((len(x) + 1 for x in words), np.int64, w)
                parts.append(word_costs(e, cost, common_prefixes(flat, np.cumsum(size) - size), w))
            if len(head):
                e = head_edges(head, n[w:], apart[w:])
                parts.append(edge_costs(table.value, weights, refined, e.context, e.byte, e.paths))
            yield pa.RecordBatch.from_arrays(
                [pa.array([*words, *[None] * len(head)], pa.binary()), pa.array([*[None] * w, *head.tolist()], pa.int32()),
                 pa.array(n), pa.array(np.concatenate(parts))], names=["word", "head", "n", "cost"])

    return by_home(counts, above).mapInArrow(run, "word binary, head int, n long, cost double")


def release(spark) -> None:
    """Let Spark's cleaner remove the shuffles of tables that are stored: it
    does so once the driver holds no reference to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def common_from(counts: DataFrame, n: str, most: int) -> Column:
    """A test for the commonest rows, at most ``most``: rows are counted by
    size class, a few hundred rows, and whole classes are taken."""
    size = F.floor(F.log2(n) * 8).cast("int")
    classes = counts.groupBy(size.alias("size")).agg(F.count("*").alias("v")).orderBy(F.desc("size")).collect()
    held, least = 0, 1 << 20
    for r in classes:
        held += r.v
        if held > most or r["size"] is None:
            break
        least = r["size"]
    return F.coalesce(size >= least, F.lit(False))


# -- scoring --------------------------------------------------------------------

def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split: Split = Split(),
          frequent: int = FREQUENT, group: int = GROUP) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte) for every row.

    ``base_score`` is the unigram score: the sum over tokens (words, then one
    end) of log10((c + 0.5) / (N + 0.5 (V + 1))) with exact counts c over the
    training rows; ``score`` is the mixing model's log10 probability of the
    text, ``bits_per_byte`` its cost. NULL and empty texts are one end token.
    A NULL id is neither held out nor learned from; repeated rows each get a
    row and each count in learning; without training rows all counts are zero
    and the model is near uniform. Very long texts are read one at a time; very
    long words are rows of the word table. Other columns are not carried.

    Counts and costs of the at most ``frequent`` commonest training words of at
    most FREQUENT_BYTES bytes go to every task; all other words are looked up
    by a join on the word, so nothing is left out. The weights are learned per
    partition of the word table, so they depend on the number of shuffle
    partitions; given the weights, ``group`` changes no cost.
    """
    spark = docs.sparkSession
    part = F.crc32(F.col(id_col).cast("string").cast("binary")) % split.parts
    rows = docs.select(F.col(id_col).alias("id"), part.cast("int").alias("part"),
                       F.col(text_col).cast("string").alias("body"))
    counts = deal(materialize(count_corpus(rows, split), "lm_counts"), group)
    release(spark)
    # The end is a newline after a space, whatever stands before it; as a token it counts once for each training row.
    ends = counts.where(F.col("head").bitwiseAND(255) == LINE).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    totals = counts.where("word IS NOT NULL AND n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_train, n_distinct = totals.n + ends, totals.v + (ends > 0)
    floor = math.log10(n_train + 0.5 * (n_distinct + 1))

    above = above_homes(counts)
    before, every = slot_tables(materialize(count_grams(counts), "lm_grams"))
    shared = spark.sparkContext.broadcast(before)
    mixing = spark.sparkContext.broadcast(learn_weights(counts, above, shared))
    shared.destroy()
    del before
    table = spark.sparkContext.broadcast(every)
    costs = materialize(add_costs(counts, above, table, mixing), "lm_costs")
    release(spark)
    heads = costs.where("head IS NOT NULL").select("head", "cost").orderBy("head").toArrow()  # at most 2^24, in practice few
    words = costs.where("word IS NOT NULL").select("word", "n", "cost")
    is_common = common_from(words.where("n > 0"), "n", frequent) & (F.length("word") <= FREQUENT_BYTES)
    top = words.where(is_common).toArrow()
    end_base = math.log10(ends + 0.5) - floor
    common = spark.sparkContext.broadcast((
        {w: i for i, w in enumerate(top["word"].to_pylist())}, np.log10(top["n"].to_numpy() + 0.5) - floor, top["cost"].to_numpy(),
        heads["head"].to_numpy().astype(np.int64), heads["cost"].to_numpy()))
    del top, heads

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, base_of, cost_of, head_keys, head_costs = common.value
        for part, texts in text_blocks(batches, "body", size=BLOCK):
            n_tokens, n_bytes, base, sure, total, rest, upto = [], [], [], [], [], [], [0]
            for text in texts:
                w = canonical(text)
                flat = np.frombuffer(stream(w), np.uint8)
                _, key = head_events(flat)
                at = np.fromiter(map(index.get, w, repeat(-1)), np.int64, len(w))
                held = at[at >= 0]
                n_tokens.append(len(w) + 1)
                n_bytes.append(len(flat) - 3)
                base.append(float(base_of[held].sum()) + end_base)
                sure.append(len(held) + int(ends > 0))
                total.append(float(cost_of[held].sum() + head_costs[np.searchsorted(head_keys, key)].sum()))
                if len(held) < len(w):
                    rest += Counter(w[i] for i in np.flatnonzero(at < 0).tolist()).items()
                upto.append(len(rest))
            left = pa.StructArray.from_arrays([pa.array([x for x, _ in rest], pa.binary()),
                                               pa.array([n for _, n in rest], pa.int64())], names=["word", "tf"])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n_tokens, pa.int64()), pa.array(n_bytes, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(sure, pa.int64()), pa.array(total, pa.float64()),
                 pa.ListArray.from_arrays(pa.array(upto, pa.int32()), left)],
                names=["id", "part", "n_tokens", "n_bytes", "base", "sure", "score", "rest"])

    id_type = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"id {id_type}, part int, n_tokens long, n_bytes long, base double, sure long, "
                                  "score double, rest array<struct<word: binary, tf: long>>")
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "lm_scored")
    other = scored.select("row", F.inline("rest")).join(words.where(~is_common), "word").groupBy("row").agg(
        F.sum(F.col("tf") * (F.log10(F.col("n") + 0.5) - F.lit(floor))).alias("base_rest"),
        F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("known_rest"),
        F.sum(F.col("tf") * F.col("cost")).alias("score_rest"))
    held_out = F.coalesce(F.col("part") == split.held_out, F.lit(False))
    total = F.col("score") + F.coalesce("score_rest", F.lit(0.0))
    return scored.drop("rest").join(other, "row", "left").select(
        F.col("id").alias(id_col), held_out.alias("held_out"), "n_tokens",
        (F.col("sure") + F.coalesce("known_rest", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rest", F.lit(0.0))).alias("base_score"), total.alias("score"),
        (-total / F.lit(math.log10(2)) / F.col("n_bytes")).alias("bits_per_byte"))
