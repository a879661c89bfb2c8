"""SimHash near-duplicates found through Golay-code keys.

A fingerprint is 64 bits over word shingles. Pairs at a distance of at most 4
bits are found without comparing all pairs:

* the fingerprint is cut into three segments of 22, 21 and 21 bits; with at
  most 4 differing bits some two segments i and j differ in at most 2 bits
  together: one bit each, or two in one of them;
* a segment, padded to 23 bits, decodes to one codeword of the perfect binary
  (23, 12) Golay code, its ``own``. The ``near`` codewords are those to which
  the segment or any of its one-bit neighbours decodes. Of two segments one
  bit apart, the codeword of one is near for the other; two segments two bits
  apart share a near codeword through the segment between them;
* one bit each: the bit of segment i lies in one half, so the other half is
  equal. Keys (equal half of i, near i, own j) and (equal half of i, own i,
  near j), where the near codewords of i use only bits of the unequal half;
* two bits in one segment: keys (i whole, near j) and (near i, j whole).

Every key has about 34 bits, a fingerprint emits about 80, and any pair within
4 bits meets in at least one. A join on the key and an exact bit count verify.

Only distinct fingerprints are keyed, so exact copies cost nothing. A crowd of
near copies is linked before it is keyed: views of 32 of the 64 bits tie each
fingerprint to the smallest and largest one of its view, and components are
formed. Of the keys, one with two members is settled by the aggregate that
counts them, one whose members all bear the same label is dropped there, and
of the others that aggregate keeps eight extreme members, of which two are
compared with all.
Only keys that still have several labels get their members back; members of
different labels then meet in one of five blocks of the fingerprint, one of
which any two within 4 bits share, so a key's members are not paired with each
other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vehicle_metrics.llm.common import add_columns, fresh, sorted_join
from vehicle_metrics.llm.components import connected_components
from vehicle_metrics.storage import materialize

MAX_BITS = 4  # the key scheme below is complete up to this distance
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, width
#: A key's members are compared at the two ends of the order by ``fp ^ c``, for each of these c.
VIEWPOINTS = (0, 0x3333333333333333, 0x5A5A5A5A5A5A5A5A, 0x0F1E2D3C4B5A6978)
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, generates the (23, 12) code


def fingerprinter(shingle_words: int):
    """A function from UTF-8 texts to their fingerprints (uint64 array).

    Words are runs of non-space characters after lower-casing A-Z; shingles
    are joined by one space, repeats count; a text of fewer words is one
    shingle, a text without words has the fingerprint zero. A bit is set when
    more than half of the shingles' XXH64 values (seed 42) have it."""
    from xxhash import xxh64_intdigest

    def one(text: bytes) -> int:
        words = text.lower().split()
        if not words:
            return 0
        joined, lens = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
        k = min(shingle_words, len(words))
        ends = np.cumsum(lens + 1) - 1
        starts = (ends - lens)[: len(words) - k + 1].tolist()
        ends = ends[k - 1:].tolist()
        counts, n = np.zeros(64, np.int64), len(starts)
        for at in range(0, n, 1 << 15):
            h = np.array([xxh64_intdigest(joined[a:b], 42)
                          for a, b in zip(starts[at:at + (1 << 15)], ends[at:at + (1 << 15)])], "<u8")
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(0, dtype=np.int64)
        return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])

    return lambda texts: np.array([one(t) for t in texts], np.uint64)


def add_fingerprints(docs: DataFrame, out: str, text_col: str = "text", shingle_words: int = 4) -> DataFrame:
    """Every row with its fingerprint as a signed 64-bit column ``out``."""
    def compute():
        of = fingerprinter(shingle_words)
        return lambda texts: [pa.array(of(texts).view(np.int64))]

    return add_columns(docs, text_col, StructType([StructField(out, LongType())]), compute)


def golay_decoder():
    """A vectorised map from 23-bit words to the 12-bit index of the one
    codeword within distance 3."""
    powers = np.empty(23, np.int64)  # x^i mod the generator
    r = 1
    for i in range(23):
        powers[i] = r
        r <<= 1
        if r >> 11:
            r ^= GENERATOR
    low, high = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
    for i in range(12):
        low[(np.arange(1 << 12) >> i & 1) == 1] ^= powers[i]
    for i in range(11):
        high[(np.arange(1 << 11) >> i & 1) == 1] ^= powers[12 + i]
    error = np.zeros(1 << 11, np.int64)  # by syndrome: the only pattern of weight 3 or less
    one = 1 << np.arange(23)
    for i in range(23):
        error[powers[i]] = one[i]
        for j in range(i):
            error[powers[i] ^ powers[j]] = one[i] | one[j]
            for k in range(j):
                error[powers[i] ^ powers[j] ^ powers[k]] = one[i] | one[j] | one[k]

    def decode(words: np.ndarray) -> np.ndarray:
        return (words ^ error[low[words & 4095] ^ high[words >> 12]]) >> 11

    return decode


def key_maker():
    """A function from n fingerprints (uint64) to (row index, key) arrays."""
    decode = golay_decoder()

    def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole, near, own = [], [], []
        for first, width in SEGMENTS:
            whole.append((fps >> np.uint64(first)).astype(np.int64) & ((1 << width) - 1))
            near.append(decode(whole[-1][:, None] ^ np.concatenate([[0], 1 << np.arange(width)])))
            own.append(near[-1][:, :1])
        rows, out = [], []

        def emit(kind: int, key: np.ndarray) -> None:
            key.sort(axis=1)
            first = np.ones(key.shape, bool)
            first[:, 1:] = key[:, 1:] != key[:, :-1]
            rows.append(np.nonzero(first)[0])
            out.append(key[first] | kind << 40)

        for p, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
            half = SEGMENTS[i][1] // 2
            bits = np.arange(SEGMENTS[i][1] + 1)  # column 0 of `near` flips nothing, column b + 1 flips bit b
            for side, (same, unequal) in enumerate((
                    (whole[i] & ((1 << half) - 1), (bits == 0) | (bits > half)), (whole[i] >> half, bits <= half))):
                codes = np.concatenate([near[i][:, unequal] << 12 | own[j], own[i] << 12 | near[j]], axis=1)
                emit(4 * p + side, same[:, None] << 24 | codes)
            emit(4 * p + 2, whole[i][:, None] << 12 | near[j])
            emit(4 * p + 3, whole[j][:, None] << 12 | near[i])
        return np.concatenate(rows), np.concatenate(out)

    return keys


def _keyed(fps: DataFrame, *also: str) -> DataFrame:
    """(key, fp, and the long columns ``also``) for every key of every row."""
    names = ["key", "fp", *also]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = key_maker()
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            for at in range(0, batch.num_rows, 4096):
                part = [c[at:at + 4096] for c in columns]
                rows, key = keys(part[0].view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(c[rows]) for c in part)], names=names)

    # A row of 16 bytes becomes about 80 keys, so rows are dealt to as many tasks as a shuffle has, whatever their bytes.
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fps.select("fp", *also).repartition(tasks, "fp").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _close(a: str, b: str, max_bits: int) -> str:
    return f"bit_count({a} ^ {b}) <= {max_bits}"


def _masks() -> list[int]:
    """The 32-bit views: for each of the bits' 6 index digits, the bits where
    it is 0 and those where it is 1, so any two bits lie apart in some view."""
    return [sum(1 << b for b in range(64) if (b >> digit & 1) == value) for digit in range(6) for value in (0, 1)]


def _signed(mask: int) -> str:
    return f"{mask - (1 << 64) if mask >> 63 else mask}L" if mask != 1 << 63 else "shiftleft(1L, 63)"


def _star(rows: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    """Verified links of each row's ``fp`` to the smallest and the largest one
    with the same keys: at most two for each row, however many share them."""
    ends = rows.groupBy(*keys).agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high")
    met = sorted_join(rows, ends, keys).selectExpr("fp AS src", "explode(array(low, high)) AS dst")
    return met.where("src <> dst AND " + _close("src", "dst", max_bits)).distinct()


def _relabel(rows: DataFrame, components: DataFrame) -> DataFrame:
    """``rows`` (fp, label, ...) with labels replaced by their component."""
    found = components.selectExpr("node AS label", "component")
    return sorted_join(rows, found, "label", "left").withColumn("label", F.coalesce("component", "label")).drop("component")


def fingerprint_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component) for the distinct non-null fingerprints that link to
    another one; ``component`` is the smallest fingerprint reachable."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")
    fps = fps.select("fp").where("fp IS NOT NULL").distinct()

    # Crowds: each fingerprint against two others of each of its 12 views.
    views = ", ".join(f"named_struct('view', {i}, 'bits', fp & {_signed(m)})" for i, m in enumerate(_masks()))
    viewed = fps.selectExpr("fp", f"inline(array({views}))")
    first = connected_components(_star(viewed, ["view", "bits"], max_bits))
    labelled = materialize(sorted_join(fps, first.withColumnRenamed("node", "fp"), "fp", "left")
                           .selectExpr("fp", "coalesce(component, fp) AS label"), "golay_labels")

    # Keys: one label leaves nothing to find, two members are settled here, and of more the extremes are compared.
    extremes = [f"{f}(fp ^ {c}L) ^ {c}L AS m{i}{f}" for i, c in enumerate(VIEWPOINTS) for f in ("min", "max")]
    names = [f"m{i}{f}" for i in range(len(VIEWPOINTS)) for f in ("min", "max")]
    keys = _keyed(labelled, "label").groupBy("key").agg(
        F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"),
        *map(F.expr, extremes)).where("low < high")
    keys = materialize(keys.where("n > 2 OR " + _close("m0min", "m0max", max_bits)).drop("low", "high"), "golay_keys")
    pairs = ", ".join(f"named_struct('src', {x}, 'dst', {y})" for i, x in enumerate(names[:2]) for y in names[i + 1:])
    near = f"filter(array_distinct(array({pairs})), p -> p.src <> p.dst AND {_close('p.src', 'p.dst', max_bits)})"
    met = (keys.where("n = 2").selectExpr("m0min AS src", "m0max AS dst")
           .unionByName(keys.where("n > 2").selectExpr(f"inline({near})")).distinct())
    of = labelled.selectExpr("fp AS dst", "label AS to")
    met = sorted_join(sorted_join(met, labelled.withColumnRenamed("fp", "src"), "src"), of, "dst").selectExpr(
        "label AS src", "to AS dst")
    second = connected_components(met.where("src <> dst").distinct())
    labelled = materialize(_relabel(labelled, second), "golay_labels")

    # What is left: keys of members with several labels, which meet in one of five blocks.
    several = _keyed(labelled, "label").groupBy("key").agg(
        F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("n > 2 AND low < high")
    shared = materialize(sorted_join(_keyed(labelled, "label"), several.select("key"), "key"), "golay_shared")
    late = None
    for i in range(5):
        bits = f"shiftrightunsigned(fp, {13 * i}) & {(1 << min(13, 64 - 13 * i)) - 1}L AS bits"
        one = shared.selectExpr("key", bits, "fp", "label")
        other = shared.selectExpr("key", bits, "fp AS fp_b", "label AS label_b")
        met = (sorted_join(one, other, ["key", "bits"]).where("label < label_b AND " + _close("fp", "fp_b", max_bits))
               .selectExpr("label AS src", "label_b AS dst"))
        late = met if late is None else late.unionByName(met)
    late = late.distinct()
    merged = materialize(_relabel(labelled, connected_components(late)).selectExpr("fp", "label AS component"), "golay_components")
    linked = merged.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    return sorted_join(merged, linked, "component").select("fp", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fingerprint, component_id) for every row.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest
    id reachable over links of at most ``max_bits`` differing bits, its own
    included. NULL and empty texts have the fingerprint zero and link like any
    other. Repeated rows each get a row; a NULL id is ignored by the minimum
    (a component of only NULL ids has a NULL component_id). An empty table
    gives an empty result; other columns are not carried.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    rows = materialize(add_fingerprints(rows, "fp", "body", shingle_words).select("id", "fp"), "fingerprints")
    low = materialize(rows.groupBy("fp").agg(F.min("id").alias("low")), "fingerprint_ids")
    linked = fingerprint_components(low, max_bits)
    merged = sorted_join(low, linked, "fp", "left").selectExpr("fp", "low", "coalesce(component, fp) AS component")
    merged = materialize(merged, "fingerprint_components")
    ids = merged.groupBy("component").agg(F.min("low").alias("component_id"))
    by_fp = sorted_join(merged, ids, "component").select("fp", "component_id")
    return sorted_join(rows, by_fp, "fp").selectExpr(
        f"id AS `{id_col}`", "lower(lpad(hex(fp), 16, '0')) AS fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the row with the smallest id
    (NULL ids last), and of several such rows one of them."""
    fp, row = fresh(docs, "_fp"), fresh(docs, "_row")
    tagged = add_fingerprints(docs.withColumn(row, F.monotonically_increasing_id()), fp, text_col, shingle_words)
    tagged = materialize(tagged, "fingerprinted_docs")
    best = F.min(F.struct(F.col(id_col).isNull(), F.col(id_col).alias("id"), F.col(row).alias("row")))
    low = materialize(tagged.groupBy(F.col(fp).alias("fp")).agg(best.alias("best")), "fingerprint_ids")
    linked = fingerprint_components(low, max_bits)
    keep = (sorted_join(low, linked, "fp", "left").groupBy(F.coalesce("component", "fp").alias("component"))
            .agg(F.min("best").alias("best")).selectExpr(f"best.row AS `{row}`"))
    return sorted_join(tagged, keep, row, "left_semi").select(*docs.columns)
