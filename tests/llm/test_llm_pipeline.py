"""The pipeline against a plain run over a small table."""

import collections
import os
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from vehicle_metrics.llm.queries import vocabulary_path

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
have_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def words_of(text):
    for c in SPACE[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def may_learn(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 != 2


def plain_quality(texts, good):
    """The base rules; with so few good labels no cutoff can be certified."""
    assert 0.99 ** len(good) > 0.05 / 90
    kept = {}
    for i, text in texts.items():
        w = words_of(text)
        tri = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        times = collections.Counter(tri)
        repeated = {k + j for k, x in enumerate(tri) if times[x] > 1 for j in range(3)}
        if len(w) >= 50 and 100 * len(repeated) <= 50 * len(w):
            kept[i] = text
    return kept


def profile(texts, size):
    times = collections.Counter()
    for text in texts:
        s = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        if s.strip():
            times.update(g for n in (1, 2, 3) for k in range(len(s) - n + 1) if (g := s[k:k + n]) != " ")
    return sorted(times, key=lambda g: (-times[g], g))[:size]


def nearness(own, ranks):
    apart = sum(abs(ranks[g] - k) if g in ranks else 400 for k, g in enumerate(own))
    return 1.0 - apart / (400 * len(own))


def plain_language(texts, lang):
    """Rank-order scores; with under a thousand rows the quantiles of the cutoffs are the least and greatest score."""
    by = collections.defaultdict(list)
    for i, text in texts.items():
        if may_learn(i) and lang[i] is not None:
            by[lang[i]].append(text)
    ranks = {x: {g: k for k, g in enumerate(profile(t, 400))} for x, t in sorted(by.items())}
    scores = {i: {x: nearness(own, r) for x, r in ranks.items()} for i, t in texts.items() if (own := profile([t], 300))}
    low, high = {}, {}
    for i, s in scores.items():
        if may_learn(i) and lang[i] is not None:
            low[lang[i]] = min(low.get(lang[i], 1.0), s[lang[i]])
            other = max((v, ) for x, v in s.items() if x != lang[i])[0]
            x = next(x for x, v in s.items() if x != lang[i] and v == other)
            high[x] = max(high.get(x, 0.0), other)
    cut = {x: min(q, (q + high.get(x, q)) / 2) for x, q in low.items()}
    best = {i: max(s, key=s.get) for i, s in scores.items()}
    return {i: texts[i] for i, x in best.items() if scores[i][x] >= cut[x]}


def plain_near_duplicates(texts):
    from xxhash import xxh64_intdigest

    fp = {}
    for i, text in texts.items():
        w = text.encode().lower().split()
        h = [xxh64_intdigest(b" ".join(w[k:k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
        fp[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    left, kept = set(fp), []
    while left:
        group = [min(left)]
        left.remove(group[0])
        kept.append(group[0])
        for a in group:
            near = {b for b in left if (fp[a] ^ fp[b]).bit_count() <= 4}
            left -= near
            group += sorted(near)
    return {i: texts[i] for i in kept}


def test_near_duplicates_send_only_heavy_keys_through_the_driver(spark):
    """Thousands of fingerprints, where a broadcast of more than a thousand rows is an error."""
    texts = {i: made_up(f"short {i}", SYLLABLES["aa"], 8) for i in range(2200)}
    for i in range(2200, 2400, 4):
        base = made_up(f"long {i}", SYLLABLES["bb"], 300)
        texts |= {i: base, i + 1: base, i + 2: base + " wyd", i + 3: base + " xaf vib"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    spark.conf.set("spark.sql.maxBroadcastTableSize", 1_100_000)  # 1,081,344 hold 1024 rows with a long key
    try:
        got = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert sorted(got) == sorted(plain_near_duplicates(texts)) and 2200 < len(got) <= 2350


def edit_distance(item, text):
    """The least number of edits between ``item`` and any part of ``text``, by the whole matrix, row by row."""
    t = np.array([ord(c) for c in text], np.int32)
    at = np.arange(len(t) + 1, dtype=np.int32)
    row = np.zeros(len(t) + 1, np.int32)
    for c in item:
        new = row + 1
        np.minimum(new[1:], row[:-1] + (t != ord(c)), out=new[1:])
        row = np.minimum.accumulate(new - at) + at
    return int(row.min())


def plain(text):
    return " ".join(words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text)))


def plain_decontamination(texts, items):
    items = [x for x in map(plain, items) if x]
    assert all(len(x) >= 40 for x in items)
    return {i: t for i, t in texts.items() if all(edit_distance(x, plain(t)) > len(x) // 10 for x in items)}


@have_data
def test_run_equals_a_plain_run(spark):
    from tokenizers import Tokenizer

    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    texts, lang = {r.doc_id: r.text or "" for r in rows}, {r.doc_id: r.lang for r in rows}
    assert len(texts) == len(rows)
    good = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1]
    items = {r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if r.text}
    left = [texts, plain_quality(texts, good)]
    left.append(plain_language(left[-1], lang))
    left.append(plain_near_duplicates(left[-1]))
    left.append(plain_decontamination(left[-1], items))
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    library = Tokenizer.from_file(str(vocabulary_path()))
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in left[-1].items()}
    assert len(left[0]) > len(left[1]) > len(left[3]) > len(left[4]) > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "language_id", "simhash_near_dedup", "benchmark_decontamination", "bpe"]


def made_up(seed, parts, n):
    """``n`` words of two to four of the syllables ``parts``."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(parts, k=rng.randint(2, 4))) for _ in range(n))


SYLLABLES = {"aa": "ba ke li mo nu sa te ri".split(), "bb": "zok wyd xaf qug vib hjy cyx dwo".split()}
CLASHING = ("id", "body", "key", "fp", "item", "n_words", "kept", "lang_pred", "score", "_fp", "_row", "_body", "_t")


def awkward_tables(spark, folder):
    """Documents with NULLs, repeated rows, ties, a text of a megabyte and columns named like the stages' own."""
    item = made_up("item", SYLLABLES["aa"], 12)
    ids = [i for i in range(1, 100) if may_learn(i)][:14]
    texts = {i: made_up(i, SYLLABLES["aa" if k % 2 else "bb"], 120) for k, i in enumerate(ids)}
    rows = [(i, t, "aa" if k % 2 else "bb") for k, (i, t) in enumerate(texts.items())]
    rows += [rows[0], rows[0]]  # repeated rows
    rows += [(1001, texts[ids[1]], None), (None, texts[ids[2]], None)]  # copies with a larger and with a NULL id
    rows += [(None, made_up("none", SYLLABLES["aa"], 120), None)]  # a text of its own, NULL id
    rows += [(1002, made_up("long", SYLLABLES["aa"], 150_000), None)]  # a very long text
    leak = texts[ids[3]][:200] + " " + item[:20] + "x" + item[20:] + " " + texts[ids[4]][:300]
    rows += [(1003, made_up("around", SYLLABLES["aa"], 60) + " " + leak, None)]
    rows += [(1004, None, "aa"), (1005, "", "aa"), (1006, " \t\n\x0b", None), (1007, "one two " * 100, None),
             (1008, " ".join(map(str, range(100, 220))), None), (None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in CLASHING)
    full = [(i, t, x, None, None, *["?"] * len(CLASHING)) for i, t, x in rows]
    spark.createDataFrame(full, schema).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(ids[0], 1, 0), (ids[0], 0, 1), (None, 1, None), (ids[1], None, 1)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (1, item), (None, ""), (2, None)],
                          "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return ids


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_awkward_rows(spark, scratch, empty):
    from vehicle_metrics.storage import materialize

    ids = awkward_tables(spark, scratch)
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    columns = docs.columns
    if empty:
        docs = docs.where("false")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, scratch), f"awkward_{name}")
        assert docs.columns == columns or name == "bpe"
        left[name] = sorted((r.doc_id for r in docs.select("doc_id").collect()), key=lambda i: (i is None, i or 0))
    if empty:
        assert all(x == [] for x in left.values())
        return
    clean = sorted(ids) + [1002, 1003, None]
    assert left["quality_rules"] == sorted([ids[0], ids[0], *ids]) + [1001, 1002, 1003, 1008, None, None]
    assert left["language_id"] == sorted([ids[0], ids[0], *ids]) + [1001, 1002, 1003, None, None]
    assert left["simhash_near_dedup"] == clean
    assert left["benchmark_decontamination"] == left["bpe"] == [i for i in clean if i != 1003]
