"""The operators against plain versions, on rows with every awkward case."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vehicle_metrics.llm import (
    bpe, cotraining, decontamination, html_content, language_id, lm_mixing, quality_rules, sharding, simhash_golay,
    toxicity,
)
from vehicle_metrics.llm.components import connected_components
from vehicle_metrics.llm.queries import vocabulary_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BANK = {"en": "the of and house green river walks over stone hill with light".split(),
        "de": "der und haus grün fluss geht über stein hügel mit licht nicht".split()}


def prose(lang, n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(BANK[lang]) for _ in range(n))


LONG = prose("en", 4000, 99)
TEXTS = [None, "", " \t\n ", "12 34 ...", "word", "One two\x0bthree four", LONG, LONG, LONG + " end",
         "same line\nsame line\n\nother\nsame line\n", "a b c a b c x a b c", "### $$ %% |a| <b> &amp; " * 30,
         "don't we'll  <|endoftext|> naïve 日本語 🙂🙂 aaaaaaaa\r\n\tx\x1cy\x85z", "A" * 3000]
TEXTS += [prose(lang, n, n * 7 + i) for lang in BANK for i, n in enumerate((5, 30, 60, 80, 120, 300, 60, 90))]
TEXTS += [TEXTS[-1], TEXTS[-2], TEXTS[-1].upper()]
IDS = [*range(100, 100 + len(TEXTS) - 2), None, 101]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars int, id string, body string, fp string, "
          "_row int, score string, part int")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("en" if k % 2 else "de") if k > 15 else None, None if k % 5 == 0 else f"s{k % 3}",
             None if t is None else len(t), "x", "y", "z", 1, "s", 9) for k, (i, t) in enumerate(zip(IDS, TEXTS))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, k % 2, k % 3 == 0 and 1 or 0) for k, i in enumerate(IDS[:20])] + [
        (None, 1, 1), (100, None, None), (101, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def same_rows(got, expected):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


# -- quality rules ---------------------------------------------------------------

def test_measures_equal_a_plain_count(docs, labels):
    expected = []
    for i, t in zip(IDS, TEXTS):
        w = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        tri = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        c = collections.Counter(tri)
        cover = {k + j for k, x in enumerate(tri) if c[x] > 1 for j in range(3)}
        expected.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")),
                         len(lines) - len(set(lines)), len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w)))
    got = quality_rules.assess(docs, labels)
    same_rows(got.drop("n_lines", "n_capitals", "kept").collect(), expected)
    assert got.where("base_failed AND kept").count() == 0
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_certified_cutoffs_use_the_exact_binomial_tail(spark):
    for n, k, p in ((40, 0, 0.01), (900, 2, 0.01), (3000, 12, 0.01)):
        exact = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(quality_rules.binomial_tail(F.lit(k).cast("long"), F.lit(n), p)).first()[0]
        assert got == pytest.approx(exact, rel=1e-9)
    names = {m: m for m in quality_rules.MEASURES}
    clean = "100L AS n_words, 500L AS word_chars, 0L AS n_dup_lines, 0L AS n_repeat_words, 10L AS n_lines, 5L AS n_capitals"
    good = spark.range(2000).selectExpr(*clean.split(", "), "CASE WHEN id = 0 THEN 400L ELSE 0L END AS n_symbols")
    tests = quality_rules.certify(good, names).where("certified AND rule = 'symbols'").collect()
    assert {(r.stratum, r.k) for r in tests} == {("short", 1)} and min(r.cutoff for r in tests) == 0.01
    assert quality_rules.certify(good.limit(100), names).where("certified").count() == 0


def test_kept_documents_are_those_assessed_as_kept(docs, labels, empty):
    kept = quality_rules.assess(docs, labels).where("kept").count()
    got = quality_rules.keep_documents(docs, labels)
    assert got.columns == docs.columns and got.count() == kept > 0
    assert quality_rules.keep_documents(empty, labels).count() == 0
    assert quality_rules.assess(empty, labels.where("false")).count() == 0


# -- language ID -----------------------------------------------------------------

def test_language_of_plain_profiles(docs, empty):
    got = {(r.doc_id, r.held_out, r.lang_pred) for r in language_id.identify(docs).collect()}
    assert {p for i, _, p in got if i in (102, 103)} == {"und"}
    for i, held, p in got:
        if i is not None and i > 115:
            assert held == (zlib.crc32(str(i).encode()) % 4 == 2)
            assert p in BANK
    assert language_id.identify(empty).count() == 0
    unlabelled = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}
    assert language_id.keep_identified(docs).columns == docs.columns


def test_profiles_and_distance_equal_a_plain_version(spark):
    texts = {"en": "Ab ab abc", "de": "xyz! xy"}
    df = spark.createDataFrame([(t, lang) for lang, t in texts.items()], "text string, lang string")
    got = {(r.lang, r.gram): r["rank"] for r in language_id.learn_profiles(df, size=8).collect()}
    code = lambda g: sum(ord(c) << s for c, s in zip(g, (42, 21, 0)))
    plain = {}
    for lang, t in texts.items():
        s = " " + re.sub(r"[^a-z]+", " ", t.lower()).strip() + " "
        grams = collections.Counter(s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i:i + n] != " ")
        for rank, g in enumerate(sorted(grams, key=lambda g: (-grams[g], code(g)))[:8]):
            plain[lang, code(g)] = rank
    assert got == plain


def test_a_language_never_learned_is_rejected(spark):
    bank = {**BANK, "nl": "de het van en huis groene rivier loopt over steen heuvel met licht niet der under".split(),
            "fr": "le et maison vert fleuve marche sur pierre colline avec lumière pas mais une".split()}
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(bank[x]) for _ in range(80)), x if x != "nl" else None)
            for i, x in enumerate(["en", "de", "fr", "nl"] * 60)]
    rows.append((999, " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(80)), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {x.doc_id for x in language_id.keep_identified(docs).collect()}
    assert kept == {i for i, _, x in rows if x is not None}
    # A fixed loose score lets the unlearned language through.
    assert language_id.keep_identified(docs, min_score=0.2).where("lang IS NULL").count() >= 60


# -- BPE -------------------------------------------------------------------------

def test_bpe_equals_the_library(docs, empty):
    from tokenizers import Tokenizer

    path = vocabulary_path()
    library = Tokenizer.from_file(path)
    expected = []
    for i, t in zip(IDS, TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest()))
    same_rows(bpe.round_trip_digests(docs, path).collect(), expected)
    assert bpe.round_trip_digests(empty, path).count() == 0
    back = bpe.decode(bpe.encode(docs.select("doc_id", "text"), path), path)
    assert all(r.decoded == (r.text or "") for r in back.collect())


# -- decontamination ---------------------------------------------------------------

def distance(p, t):
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for j, x in enumerate(p, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != c)))
        row, best = new, min(best, new[-1])
    return best


def test_edit_matches_equal_the_full_distance():
    r = random.Random(4)
    items = [(k, prose("en", 12 + k, k)) for k in range(6)]
    find = decontamination.matcher(items, 0.1, 40)
    for trial in range(60):
        _, item = items[trial % 6]
        budget = decontamination.budget(len(item), 0.1)
        chars = list(item)
        for _ in range(r.choice((0, 1, budget, budget + 1, budget + 3))):
            at, kind = r.randrange(len(chars)), r.random()
            chars[at:at + 1] = [] if kind < 0.3 else [r.choice("abcq ")] if kind < 0.7 else [chars[at], r.choice("xyz")]
        text = prose("de", 12, trial) + " " + "".join(chars) + " " + prose("de", 8, trial + 1)
        found = find(text)
        for k, (_, p) in enumerate(items):
            d = distance(p, text)
            assert (k in found) == (d <= decontamination.budget(len(p), 0.1))
            assert k not in found or found[k][0] == d


def edge_distance(p, t):
    """The least distance to a substring that begins and ends at a word's edge."""
    starts = [i for i in range(len(t) + 1) if i == 0 or t[i - 1] == " "]
    ends = [i for i in range(len(t) + 1) if i == len(t) or t[i] == " "]

    def whole(a, b):
        row = list(range(len(p) + 1))
        for c in t[a:b]:
            new = [row[0] + 1]
            for j, x in enumerate(p, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != c)))
            row = new
        return row[-1]

    return min(whole(a, b) for a in starts for b in ends if b >= a)


def test_short_items_match_with_edits_as_whole_words():
    r = random.Random(9)
    items = [(0, "how many moons does the planet mars have"[:39]), (1, "what is a prime number"), (2, "stone hill"), (3, "hi you")]
    find = decontamination.matcher(items, 0.1, 40)
    assert 0 in find("so " + items[0][1].replace("moons", "moans") + " now")
    assert 2 not in find("a milestone hill") and 2 in find("a stone hill") and 2 in find("a stene hill")
    for trial in range(120):
        _, item = items[trial % 4]
        chars = list(item)
        for _ in range(r.choice((0, 1, 2, 3, 4))):
            at, kind = r.randrange(len(chars)), r.random()
            chars[at:at + 1] = [] if kind < 0.3 else [r.choice("abcq ")] if kind < 0.7 else [chars[at], r.choice("xyz")]
        text = " ".join((r.choice(("well", "w")) + r.choice((" ", "")) + "".join(chars) + r.choice((" ", "x ")) + "indeed").split())
        found = find(text)
        for k, (_, p) in enumerate(items):
            d = edge_distance(p, text)
            assert (k in found) == (d <= decontamination.budget(len(p), 0.1)), (p, text)
            assert k not in found or found[k][0] == d


def test_leaks_and_clean_rows(spark, docs, empty):
    bench = spark.createDataFrame([(7, TEXTS[20]), (8, TEXTS[20]), (9, None), (10, " "), (11, "stone hill qqq")],
                                  "item_id int, text string")
    rows = decontamination.find_leaks(docs, bench)
    own = {r.doc_id for r in rows.collect() if r.item_id == 7}
    assert IDS[20] in own and {r.item_id for r in rows.collect()} == {7, 8}
    clean = decontamination.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count() - len(
        [i for i in IDS if i in own])
    assert decontamination.find_leaks(empty, bench).count() == 0
    assert decontamination.find_leaks(docs, bench.where("false")).count() == 0
    assert decontamination.drop_contaminated(docs, bench.where("false")).count() == docs.count()
    two_blocks = decontamination.find_leaks(docs, bench, block_chars=200)
    same_rows(two_blocks.collect(), [tuple(r) for r in rows.collect()])


# -- SimHash -----------------------------------------------------------------------

def test_golay_keys_meet_for_every_pair_within_four_bits():
    keys = simhash_golay.key_maker()
    r = np.random.default_rng(3)
    x = r.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, 400, dtype=np.uint64)

    def sets(fps):
        out = [set() for _ in fps]
        for i, k in zip(*keys(fps)):
            out[i].add(int(k))
        return out

    for flips in (0, 1, 2, 3, 4):
        y = x.copy()
        for i in range(len(y)):
            for b in r.choice(64, flips, replace=False):
                y[i] ^= np.uint64(1) << np.uint64(b)
        assert all(a & b for a, b in zip(sets(x), sets(y)))


def test_near_duplicates_equal_all_pairs(spark, docs, empty):
    from xxhash import xxh64_intdigest

    fps = []
    for t in TEXTS:
        w = (t or "").encode().lower().split()
        h = [xxh64_intdigest(b" ".join(w[k:k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(fps)))
    for _ in fps:
        for a, b in itertools.combinations(range(len(fps)), 2):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                group[a] = group[b] = min(group[a], group[b])
    low = {g: min((IDS[k] for k in range(len(fps)) if group[k] == g and IDS[k] is not None), default=None)
           for g in group}
    same_rows(simhash_golay.near_duplicates(docs).collect(),
              [(IDS[k], f"{fps[k]:016x}", low[group[k]]) for k in range(len(fps))])
    kept = simhash_golay.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group))
    assert simhash_golay.near_duplicates(empty).count() == 0
    assert simhash_golay.drop_near_duplicates(empty).count() == 0


def test_a_crowd_of_close_fingerprints_is_one_component(spark):
    base = 0x1234567890ABCDEF
    near = [base ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(24), 2)]
    far = [base ^ 0xFF00FF00FF00FF00 & (1 << 62) - 1, base ^ 0x0F0F0F0F0F0F0F]
    df = spark.createDataFrame([(x,) for x in {*near, *far}], "fp long")
    got = {r.fp: r.component for r in simhash_golay.fingerprint_components(df).collect()}
    assert {got[x] for x in near} == {min(near)} and not set(far) & set(got)


def test_components_of_a_chain(spark):
    edges = spark.range(60).selectExpr("id AS src", "id + 1 AS dst").union(spark.sql("SELECT 100L, 101L"))
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert {got[i] for i in range(61)} == {0} and got[101] == 100


def test_rows_joined_for_a_crowd_grow_no_faster_than_the_crowd(spark, monkeypatch):
    """A crowd of near copies around one fingerprint, and twice as many."""
    counted = {}
    real = simhash_golay.materialize

    def recording(df, name):
        out = real(df, name)
        counted[name] = counted.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(simhash_golay, "materialize", recording)
    r, rows = random.Random(5), []
    sizes = (250, 500)
    crowd = set()
    while len(crowd) < sizes[-1]:
        fp = 0x1234_5678_9ABC_DEF0
        for b in r.sample(range(64), r.randint(0, 6)):
            fp ^= 1 << b
        crowd.add(fp)
    crowd = sorted(crowd, key=lambda x: zlib.crc32(str(x).encode()))
    for n in sizes:
        counted.clear()
        fps = crowd[:n]
        df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
        got = {x.fp % (1 << 64): x.component for x in simhash_golay.fingerprint_components(df).collect()}
        label = {x: x for x in fps}
        for _ in range(8):
            for a, b in itertools.combinations(fps, 2):
                if (a ^ b).bit_count() <= 4:
                    label[a] = label[b] = min(label[a], label[b])
        size = collections.Counter(label.values())
        assert set(got) == {x for x in fps if size[label[x]] > 1}
        assert all((got[a] == got[b]) == (label[a] == label[b]) for a, b in itertools.combinations(sorted(got), 2))
        rows.append(counted["golay_shared"] + counted["golay_keys"])
    assert rows[1] <= 2.5 * rows[0] + 500


def test_only_heavy_keys_go_through_the_driver(spark):
    """Thousands of fingerprints, where a broadcast of more than a thousand rows is an error."""
    from xxhash import xxh64_intdigest

    texts = [prose("en", 12, 5000 + i) for i in range(3000)]
    for i in range(40):
        base = prose("de", 400, 9000 + i)
        texts += [base, base, base + " licht", base + " wald am see"]
    fps = np.zeros(len(texts), np.uint64)
    for k, t in enumerate(texts):
        w = t.encode().split()
        h = np.array([xxh64_intdigest(b" ".join(w[j:j + 4]), 42) for j in range(len(w) - 3)], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        fps[k] = np.packbits(2 * bits.sum(0, dtype=int) > len(h), bitorder="little").view("<u8")[0]
    pairs = [(a, b) for a in range(len(fps)) for b in np.flatnonzero(np.bitwise_count(fps[a] ^ fps) <= 4).tolist() if a < b]
    low = list(range(len(fps)))
    for _ in fps:
        before = list(low)
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            break
    assert len(set(fps.tolist())) > 2500 and len(pairs) > 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.conf.set("spark.sql.maxBroadcastTableSize", 1_100_000)  # 1,081,344 hold 1024 rows with a long key
    try:
        got = [tuple(r) for r in simhash_golay.near_duplicates(docs).collect()]
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    same_rows(got, [(k, f"{int(fps[k]):016x}", low[k]) for k in range(len(fps))])


# -- sharding ----------------------------------------------------------------------

def test_differencing_keeps_sums_and_beats_dealing_in_turn():
    r = random.Random(8)
    sizes = [r.randint(1, 1000) for _ in range(200)]
    sums, final = sharding.difference([[0, 0, 0, s] for s in sizes])
    assert sum(sums) == sum(sizes) and max(sums) - min(sums) <= 5
    back = [0] * 4
    for s, f in zip(sizes, final):
        back[f[-1]] += s
    assert back == sums


@pytest.mark.parametrize("bucket,fan", [(4000, 1000), (5, 2)])
def test_shards_keep_groups_and_number_rows(docs, empty, bucket, fan):
    rows = sharding.shard(docs, n_shards=4, bucket_groups=bucket, fan_in=fan, slot_rows=3).collect()
    assert sorted(r.size for r in rows) == sorted(len((t or "").encode()) + 8 for t in TEXTS)
    assert sorted(r.text_crc32 for r in rows) == sorted(zlib.crc32((t or "").encode()) for t in TEXTS)
    homes = collections.defaultdict(set)
    for r in rows:
        homes[r.text_crc32, r.size].add(r.shard)
    assert all(len(h) == 1 for h in homes.values()) and {r.law for r in rows} == {"bytes"}
    for s in range(4):
        mine = sorted(r.slot for r in rows if r.shard == s)
        assert mine == list(range(len(mine)))
    assert sharding.shard(empty, n_shards=4).count() == 0


def test_repeated_rows_spread_over_the_chunks(spark):
    same = [(7, 8, 0, 1, b"x", k) for k in range(900)]
    other = [(k, 9, k, k % 2, str(k).encode(), 1_000 + k) for k in range(100)]
    placed = spark.createDataFrame(same + other, "id long, size long, text_crc32 long, shard int, item binary, row long")
    got = sharding.number_slots(placed, 2, 50).collect()
    for s in (0, 1):
        mine = sorted(r.slot for r in got if r.shard == s)
        assert mine == list(range(len(mine)))
    chunks = collections.Counter(r.chunk for r in got if r.id == 7 and r.size == 8)
    assert len(chunks) == 10 and max(chunks.values()) < 180


# -- LM scoring --------------------------------------------------------------------

def test_base_scores_equal_a_plain_count(docs, empty):
    cut = [(t or "").encode().lower().split() for t in TEXTS]
    train = [i is not None and zlib.crc32(str(i).encode()) % 5 != 1 for i in IDS]
    c = collections.Counter(w for w, ok in zip(cut, train) if ok for w in [*w, None])
    n, v = sum(c.values()), len(c)
    got = lm_mixing.score(docs, frequent=5).collect()
    expected = collections.Counter()
    for i, w in zip(IDS, cut):
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in [*w, None])
        expected[i, len(w) + 1, sum(c[x] > 0 for x in [*w, None]), n, round(base, 6)] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                               for r in got) == expected
    assert all(r.score < 0 for r in got)
    assert lm_mixing.score(empty).count() == 0


def test_every_training_row_is_counted(spark):
    part = lambda i: zlib.crc32(str(i).encode()) % 5
    r = random.Random(12)
    passage, other = (" ".join("".join(r.choice("abcdefghijklmnop") for _ in range(90)) for _ in range(6)) for _ in "ab")
    ids = [i for i in range(400) if part(i) == 4][:12]
    rows = [(i, passage if i in ids else prose("en", 40, i)) for i in range(200)]
    seen, unseen = [i for i in range(1000, 1100) if part(i) == 1][:2]
    docs = spark.createDataFrame([*rows, (seen, passage), (unseen, other)], "doc_id long, text string")
    counts = lm_mixing.count_corpus(docs.selectExpr("cast(crc32(cast(doc_id AS string)) % 5 AS int) AS part", "text AS body"),
                                    lm_mixing.Split()).collect()
    words, heads = collections.Counter(), collections.Counter()
    for i, t in rows:
        if part(i) != 1:
            words.update(t.encode().split())
            body = b"\n\n " + b"".join(w + b" " for w in t.encode().split()) + b"\n"
            heads.update((body[k - 3], body[k - 2], body[k]) for k in range(3, len(body)) if body[k - 1] == 32)
    assert +collections.Counter({c.word: c.n for c in counts if c.word is not None}) == words
    assert +collections.Counter({tuple(c.head.to_bytes(3, "big")): c.n for c in counts if c.head is not None}) == heads
    bits = {r.doc_id: r.bits_per_byte for r in lm_mixing.score(docs).collect()}
    assert bits[seen] < 0.5 * bits[unseen]


def test_scores_do_not_depend_on_what_tasks_hold(docs, monkeypatch):
    monkeypatch.setattr(lm_mixing, "CHUNK", 7)
    scores = [{(r.doc_id, r.n_tokens, round(r.base_score, 6)): r.score for r in lm_mixing.score(docs, frequent=f).collect()}
              for f in (1 << 17, 5)]
    assert scores[0].keys() == scores[1].keys()
    assert all(scores[1][k] == pytest.approx(v, rel=1e-6) for k, v in scores[0].items())


def trie_of(words, n):
    """(prefix -> next byte -> count) of words that end with a space."""
    out = collections.defaultdict(collections.Counter)
    for w, k in zip(words, n):
        for d in range(len(w) + 1):
            out[w[:d]][(w + b" ")[d]] += int(k)
    return out


def path_of(counter, byte):
    for k in range(8):
        below = [sum(v for b, v in counter.items() if b >> (7 - k) == (byte >> (8 - k) << 1 | bit)) for bit in (0, 1)]
        yield int(lm_mixing.packed(np.array([below[0]]), np.array([below[1]]))[0])


def test_edges_are_those_of_the_trie():
    r = random.Random(6)
    for trial in range(30):
        words = sorted({"".join(r.choice("ab\x01") for _ in range(r.randint(1, 9))).encode() + r.choice([b"", b"x" * 30]) for _ in range(40)},
                       key=lambda w: w + b" ")
        n = np.array([r.randint(0, 6) for _ in words])
        apart = np.array([r.randint(0, k) for k in n])
        homes = np.array([len((w + b" ")[:4]) for w in words])
        e = lm_mixing.word_edges(words, homes, n, apart)
        every, before = trie_of(words, n), trie_of(words, n - apart)
        seen = {}
        for j in range(len(e.byte)):
            prefix = words[e.word[j]][:e.depth[j]]
            assert (prefix, e.byte[j]) not in seen
            seen[prefix, e.byte[j]] = j
            assert e.n[j] == every[prefix][e.byte[j]] and e.n[j] - e.apart[j] == before[prefix][e.byte[j]]
            window = (b"\0\0\0 " + prefix)[-4:]
            assert e.context[j] == int.from_bytes(window, "big")
            for paths, trie in ((e.paths, every), (e.paths_before, before)):
                assert paths[j].tolist() == (list(path_of(trie[prefix], e.byte[j])) if len(prefix) >= 4 else [0] * 8)
        assert set(seen) == {(p, b) for p, c in every.items() if p for b in c}
        cost = np.random.default_rng(trial).normal(size=len(e.byte))
        flat, size = np.frombuffer(b" ".join(words) + b" ", np.uint8), np.array([len(w) + 1 for w in words])
        got = lm_mixing.word_costs(e, cost, lm_mixing.common_prefixes(flat, np.cumsum(size) - size), len(words))
        want = [sum(cost[seen[w[:d], (w + b" ")[d]]] for d in range(1, len(w) + 1)) for w in words]
        assert np.allclose(got, want)


def test_byte_probabilities_sum_to_one():
    r = np.random.default_rng(1)
    table = (r.integers(1000, 3000, 1 << lm_mixing.SLOT_BITS) << 2 | r.integers(0, 3, 1 << lm_mixing.SLOT_BITS)).astype(np.uint16)
    weights = r.normal(size=(lm_mixing.INPUTS, lm_mixing.GATES)).astype(np.float32)
    refined = r.uniform(0.1, 0.9, 256 * lm_mixing.LEVELS).astype(np.float32)
    paths = lm_mixing.path_predictions(np.arange(256), r.integers(0, 9, 256))
    cost = lm_mixing.edge_costs(table, weights, refined, np.full(256, 77), np.arange(256), paths)
    assert (10 ** cost).sum() == pytest.approx(1, abs=1e-4)


def test_score_equals_a_plain_mixing_model(spark, monkeypatch):
    """A model worked out byte by byte, from plain counts, with the weights that were learned."""
    monkeypatch.setattr(lm_mixing, "HOME", 4)
    ids, texts = range(60), [prose("en", 12, i) for i in range(60)]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    kept = {}
    real = lm_mixing.learn_weights
    monkeypatch.setattr(lm_mixing, "learn_weights", lambda *a: kept.setdefault("mixing", real(*a)))
    got = {r.doc_id: r.score for r in lm_mixing.score(docs).collect()}
    weights, refined = kept["mixing"]
    train = [t.encode().split() for i, t in zip(ids, texts) if zlib.crc32(str(i).encode()) % 5 != 1]
    trie = trie_of([w for t in train for w in t], [1] * sum(map(len, train)))
    slot = collections.defaultdict(lambda: [0, 0])

    def events(words):
        before = (10, 10)
        for w in [*words, None]:
            body = b"\n" if w is None else w + b" "
            yield 32 | before[1] << 8 | before[0] << 16, body[0], None
            for d in range(1, len(body)):
                yield int.from_bytes((b"\0\0\0 " + body[:d])[-4:], "big"), body[d], body[:d]
            before = ((b" " + w)[-2], w[-1]) if w else None

    def nodes(context, byte):
        return [(o, k, int(s[0])) for o, k, s in lm_mixing.slots(np.array([context]), np.array([byte]))]

    for words in train:
        for context, byte, _ in events(words):
            for _, k, s in nodes(context, byte):
                slot[s][byte >> (7 - k) & 1] += 1
    for i, t in zip(ids, texts):
        total = 0.0
        for context, byte, prefix in events(t.encode().split()):
            path = list(path_of(trie[prefix], byte)) if prefix is not None and len(prefix) >= 4 else [0] * 8
            found = {(o, k): int(lm_mixing.packed(np.array([slot[s][0]]), np.array([slot[s][1]]))[0]) for o, k, s in nodes(context, byte)}
            for k in range(8):
                x = [lm_mixing.ODDS[found[o, k]] for o in (1, 2, 3, 4, 0)] + [lm_mixing.ODDS[path[k]], 0.3]
                gate = k * 9 + (found[4, k] & 3) * 3 + (path[k] & 3)
                odds = max(-14.0, min(14.0, float(sum(a * b for a, b in zip(weights[:, gate], x)))))
                level = min(23, max(0, round((odds + 9) * 23 / 18)))
                p = 0.5 / (1 + math.exp(-odds)) + 0.5 * float(refined[(1 << k | byte >> (8 - k)) * 24 + level])
                total += math.log10(p if byte >> (7 - k) & 1 else 1 - p)
        assert got[i] == pytest.approx(total, rel=2e-3)


def test_a_home_of_many_words_is_dealt_by_more_bytes(spark):
    r = random.Random(8)
    words = ["http://" + "".join(r.choice("abc") for _ in range(8)) for _ in range(300)]
    docs = spark.createDataFrame([(i, " ".join(r.choice(words) for _ in range(30))) for i in range(50)], "doc_id long, text string")
    counts = lm_mixing.count_corpus(docs.selectExpr("1 AS part", "text AS body"), lm_mixing.Split(held_out=9))
    dealt = lm_mixing.deal(counts, 40)
    homes = collections.Counter(x.home for x in dealt.where("word IS NOT NULL").collect())
    assert max(homes.values()) <= 40 and sum(homes.values()) == counts.where("word IS NOT NULL").count()
    plain, split = ({x.doc_id: x for x in lm_mixing.score(docs, group=g).collect()} for g in (500_000, 40))
    assert all(split[i].base_score == pytest.approx(plain[i].base_score) and split[i].score < 0 for i in plain)


def crowded_words():
    """Homes that are cut at several lengths, words that end within a home, and a byte above 127."""
    r = random.Random(11)
    words = ["http://" + "".join(r.choice("ab") for _ in range(r.randint(0, 9))) for _ in range(300)]
    return words + ["http:", "http", "httpé" + "x" * 9, "htt", "other", "others"]


@pytest.mark.parametrize("group", [40, 5])
def test_prefixes_of_cut_homes_have_exact_counts(spark, group):
    r = random.Random(12)
    rows = [(r.choice([0, 1, 4, None]), " ".join(r.choices(crowded_words(), k=20))) for _ in range(40)]
    counts = lm_mixing.count_corpus(spark.createDataFrame(rows, "part int, body string"), lm_mixing.Split())
    dealt = lm_mixing.deal(counts, group)
    table = [x for x in dealt.collect() if x.word is not None]
    every = trie_of([bytes(x.word) for x in table], [x.n for x in table])
    before = trie_of([bytes(x.word) for x in table], [x.n - x.apart for x in table])
    above = {bytes(x.home): x.above for x in lm_mixing.above_homes(dealt).collect()}
    assert set(above) == {bytes(x.home) for x in table if len(x.home) > 4} and len({len(h) for h in above}) > 1
    for home, found in above.items():
        want = [[*path_of(every[home[:d]], home[d]), *path_of(before[home[:d]], home[d])] for d in range(4, len(home))]
        assert [np.frombuffer(x, np.uint16).tolist() for x in found] == want


def test_word_table_reaches_python_without_null_arrays(spark):
    """A NULL array costs Arrow's writer a pass over its batch, so rows without predictions have NULL bytes."""
    rows = spark.createDataFrame([(0, " ".join(crowded_words()))], "part int, body string")
    dealt = lm_mixing.deal(lm_mixing.count_corpus(rows, lm_mixing.Split()), 40)
    above = lm_mixing.above_homes(dealt)
    dealt_out = lm_mixing.by_home(dealt, above)
    assert not [c for c, kind in dealt_out.dtypes if kind.startswith(("array", "map"))]
    want = {bytes(x.home): b"".join(map(bytes, x.above)) for x in above.collect()}
    found = {bytes(x.home): bytes(x.above) for x in dealt_out.where("above IS NOT NULL").collect()}
    assert found == want and all(len(v) == lm_mixing.WAY * (len(h) - lm_mixing.HOME) for h, v in found.items())


def test_scores_do_not_depend_on_cut_homes(spark, monkeypatch):
    r = random.Random(13)
    docs = spark.createDataFrame([(i, " ".join(r.choices(crowded_words(), k=30))) for i in range(60)], "doc_id long, text string")
    of = lambda g: {x.doc_id: x.score for x in lm_mixing.score(docs, group=g, frequent=9).collect()}
    kept = {}
    real = lm_mixing.learn_weights
    monkeypatch.setattr(lm_mixing, "learn_weights", lambda *a: kept.setdefault("mixing", real(*a)))
    plain = of(500_000)
    for group in (40, 5):
        assert of(group) == {i: pytest.approx(x, rel=1e-9) for i, x in plain.items()}
    # Weights learned from cut homes differ by the order in which words are met, at most.
    monkeypatch.setattr(lm_mixing, "learn_weights", real)
    assert of(40) == {i: pytest.approx(x, rel=1e-3) for i, x in plain.items()}


def test_learning_helps(spark):
    docs = spark.createDataFrame([(i, prose("en" if i % 2 else "de", 40, i)) for i in range(300)], "doc_id long, text string")
    bits = [r.bits_per_byte for r in lm_mixing.score(docs).collect() if r.held_out]
    assert len(bits) > 30 and max(bits) < 1.6  # 12 or 13 equally likely words of about five bytes


# -- classifiers -------------------------------------------------------------------

def test_classifiers_without_enough_labels(docs, labels, empty):
    for f in (toxicity.score, cotraining.score):
        got = f(docs, labels).collect()
        assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
        assert f(docs, labels.where("false")).count() == len(TEXTS)
        assert f(empty, labels).count() == 0


def test_classifiers_learn_on_held_out_rows(spark):
    rows, marks = [], []
    for i in range(400):
        bad, junk = i % 4 == 0, i % 5 == 0
        text = prose("en", 60, i) + (" you id1ot, you worthless gromf!" if bad else "")
        rows.append((i, " ".join(w + "###" for w in text.split()) if junk else text, "en", f"s{i % 3}", len(text)))
        marks.append((i, int(not junk), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    toxic = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    held = [r for r in toxic.values() if r.held_out]
    assert len(held) > 60 and sum(r.predicted == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.9
    kept = cotraining.score(docs, labels.where("doc_id % 2 = 0")).collect()
    assert sum(r.kept == (r.doc_id % 5 != 0) for r in kept) / len(kept) > 0.95


def plain_toxicity_features(text, learned):
    """The features by their definitions, each word compared with each other one."""
    words = (text or "").split()
    n = len(words)
    if n == 0:
        return dict.fromkeys(toxicity.FEATURES, 0.0)
    bare = [re.sub(r"^[^\w@$*]+|[^\w@$*]+$", "", w.lower()) for w in words]
    mixed = [re.search(r"[a-zA-Z][0-9@$*!#%]+[a-zA-Z]", w) is not None for w in words]
    spelt = [b.replace("*", "").translate(str.maketrans("013457@$!", "oieastasi")) for b in bare]
    is_in = lambda k, names: bare[k] in names or (mixed[k] and spelt[k] in names)
    seed = [k for k in range(n) if is_in(k, toxicity.INSULTS)]
    own = [k for k in range(n) if is_in(k, learned)]
    hits = [k for k in range(n) if k in seed or k in own]
    you = [k for k in range(n) if bare[k] in toxicity.SECOND_PERSON]
    letters = [c for c in text if c.isalpha()]
    return {
        "seed_density": len(seed) / n, "learned_density": len(own) / n, "lexicon_hits": len(hits),
        "lexicon_distinct": len({bare[k] for k in hits}),
        "near_second_person": sum(any(abs(k - j) <= 5 for j in you) for k in hits) / n,
        "second_person": len(you) / n, "capitals": sum(c.isupper() for c in letters) / max(1, len(letters)),
        "shouted": sum(len(w) > 2 and w.isupper() for w in words) / n,
        "marks": len(re.findall(r"[!?]", text)) / n, "repeated_marks": len(re.findall(r"!!|\?\?", text)) / n,
        "mixed": sum(mixed) / n,
        "spelled": sum(all(len(bare[k + j]) == 1 for j in range(3)) for k in range(n - 2)) / n,
        "words": min(n, 2000), "hit_span": (max(hits) - min(hits)) / n if hits else 0.0}


def test_toxicity_features_equal_a_plain_version(spark):
    rng = random.Random(4)
    bank = "You you, your idiot! ID1OT st*pid stup1d s-o i d i o t GROMF gromf?! gr0mf (hate) walks over !! ?? a B WHY NOT".split()
    texts = [None, "", " \n", "idiot"] + [" ".join(rng.choices(bank, k=rng.randint(1, 60))) for _ in range(80)]
    texts += [" ".join(rng.choices(bank, k=2_500))]
    learned = frozenset({"gromf", "walks"})
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, body string")
    for r in toxicity.add_features(rows, "body", "x", learned).collect():
        assert dict(zip(toxicity.FEATURES, r.x)) == pytest.approx(plain_toxicity_features(texts[r.id], learned)), texts[r.id]


def test_learned_lexicon_equals_a_plain_count(spark):
    rng = random.Random(5)
    texts = [(" ".join(rng.choices(BANK["en"], k=20) + rng.choices(["gromf", "Blat!", "river"], k=2) * bad), float(bad))
             for bad in (0, 1) for _ in range(60 + 60 * (1 - bad))]
    texts += [("only once zzz", 1.0), (None, 0.0), ("", 1.0)]
    seen = [({re.sub(r"\W", "", w.lower()) for w in (t or "").split()}, y) for t, y in texts]
    n_bad = sum(y for _, y in seen)
    want = set()
    for word in set().union(*(s for s, _ in seen)):
        bad = sum(word in s for s, y in seen if y == 1)
        good = sum(word in s for s, y in seen if y == 0)
        if bad >= max(3, 0.01 * n_bad) and bad / n_bad >= 4 * (good + 0.5) / (len(seen) - n_bad + 1):
            want.add(word)
    got = toxicity.learn_lexicon(spark.createDataFrame(texts, "body string, y double").repartition(3))
    assert got == want and {"gromf", "blat"} <= want


def test_one_text_of_each_labelled_id_is_learned_from(spark):
    rows = [(1, "a"), (1, "b"), (1, "b"), (2, "c"), (2, "c"), (3, None), (4, "not labelled"), (None, "d")]
    docs = spark.createDataFrame(rows, "id long, body string").repartition(3)
    picked = spark.createDataFrame([(1, 1.0), (2, 0.0), (3, 0.0), (9, 1.0)], "label_id long, y double")
    got = sorted(map(tuple, toxicity.training_rows(docs, picked).collect()), key=str)
    assert got[0][0] == 1 and got[0][1] in ("a", "b") and got[1:] == [(2, "c", 0.0), (3, None, 0.0)]


def test_exchange_sums_over_every_confident_row(spark):
    rng = np.random.default_rng(3)
    x = {"content": rng.normal(size=(3_000, 3)), "metadata": rng.normal(size=(3_000, 2))}
    y = (x["content"][:, 0] + x["metadata"][:, 0] > 0).astype(float)
    views = {v: cotraining.View(x[v][:200], y[:200]).fit() for v in x}
    teachers = {v: view.raw() for v, view in views.items()}
    df = spark.createDataFrame([(c.tolist(), m.tolist()) for c, m in zip(*x.values())], "content array<double>, metadata array<double>")
    got = cotraining.exchange_sums(df.repartition(5), views, teachers, 0.6)
    for target, teacher in (("content", "metadata"), ("metadata", "content")):
        sure = 1 / (1 + np.exp(-(x[teacher] @ teachers[teacher][:-1] + teachers[teacher][-1])))
        for label, rows in ((1, sure >= 0.6), (0, sure <= 0.4)):
            assert rows.sum() > 500  # more than the cap of old
            z = views[target].standard(x[target][rows])
            p = 1 / (1 + np.exp(-(z @ views[target].beta)))
            n, gradient, curvature = got[target, label]
            assert n == rows.sum()
            assert np.allclose(gradient, z.T @ (label - p)) and np.allclose(curvature, (z * (p * (1 - p))[:, None]).T @ z)


# -- HTML --------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h2>Site</h2></header><nav><ul><li><a href="/x">Menu one</a></li></ul></nav>%s<div class="ad">Buy now</div>
<h1>Head &amp; line</h1><p>One <b>bo</b>ld&nbsp;word<br>and <i>more</i> text here that goes on</p><!-- no <p>x -->
<aside class="x">See also</aside><script>q("<p>")</script><p>Second par with a < b and more words in it
<section id="comments"><p>Reader says hi</p></section>%s<footer>&copy; Site</footer>"""
BODY = "Head & line One bold word and more text here that goes on Second par with a < b and more words in it"


def test_main_text_of_pages(spark):
    marked, plain = PAGE % ("<article>", "</article>"), PAGE % ("<div>", "</div>")
    rows = [(k, f"u{k}", marked) for k in range(20)] + [(50, "u", plain), (51, None, None), (52, "u", ""),
            (52, "u", "<nav>only a menu</nav>"), (None, "u", "<p>just words")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own"))
    got = html_content.extract(pages).collect()
    assert len(got) == 25 and all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id is not None and r.page_id <= 50} == {BODY}
    assert {r.text for r in got if r.page_id in (51, 52)} == {""}
    assert [r.text for r in got if r.page_id is None] == ["just words"]
    assert html_content.extract(pages.where("false")).count() == 0


WORDS = " ".join(f"plain{i} word{i}" for i in range(30))


@pytest.mark.parametrize("page, want", [
    (f'<body><div class="layout has-sidebar"><p>{WORDS}</p><div class="sidebar"><p>side</p></div></div></body>', WORDS),
    (f'<body><div class="content sidebar"><p>{WORDS}</p></div><nav>menu</nav></body>', WORDS),  # holds most words: a wrapper
    (f"<article><p>{WORDS}</p><p class='comment-policy'>Be kind here</p></article>", f"{WORDS} Be kind here"),
    (f'<article><p class="lead notice-free">Lead in text</p><p>{WORDS}</p></article>', f"Lead in text {WORDS}"),
    (f'<article><p>{WORDS}</p><div class="social-science">On people</div></article>', f"{WORDS} On people"),
    (f"<article><p>{WORDS}</p><p title=it's>Alpha beta don't gamma <b>x</b> delta</p><p>more</p></article>",
     f"{WORDS} Alpha beta don't gamma x delta more"),
    (f'<article><p data-a="x > y" title=\'a "b" > c\'>{WORDS}</p></article>', WORDS),
    (f'<article><p>{WORDS}</p><div class="comment-list"><p>I agree</p></div><div class="cookie-notice">We use</div>'
     '<div class="ad-slot">Buy</div><div id="shareButtons">Share</div><div class="advert">Now</div></article>', WORDS),
])
def test_article_text_is_kept_and_boilerplate_goes(page, want):
    weights = html_content.Weights({})
    weights.of = {"<*": -0.1}  # tags weigh little, so the region holds every word that is in the sequence
    assert html_content.main_text(page, weights) == want


def test_weights_are_counted_over_all_pages_and_rare_classes_pooled(spark):
    rows = [(None, f"<main><x{i}>{WORDS}</x{i}></main><y{i}>out side</y{i}>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    every, few = html_content.learn_weights(pages, "html"), html_content.learn_weights(pages, "html", 5)
    assert len(every.of) > 100 and len(few.of) <= 5 + 10
    assert few.score("x39@in", 1) > 0 > few.score("y39@out", 1)
    assert every.score("x39@in", 1) > 0 > every.score("y39@out", 1)


def test_best_region_equals_trying_all():
    r = random.Random(2)
    for _ in range(200):
        s = [r.choice((-3.0, -1.0, 0.0, 1.0, 2.0)) for _ in range(r.randint(0, 12))]
        a, b = html_content.best_region(s)
        assert sum(s[a:b]) == max([0.0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1))])
