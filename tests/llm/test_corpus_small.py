"""The corpus operators against brute force on small rows with nulls, ties, repeats and odd texts."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.llm import exact, mixing, near, packing, quality, sharding, tokens, url_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, name string, turn int, rate_block int"
BASE = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    (0, BASE), (1, BASE.replace("word7", "other")), (2, BASE + " tail"), (3, None), (4, ""), (5, "   \n"), (6, "a b"),
    (7, "a  b "), (8, "ab"), (9, "A B"), (9, "A B"), (None, "a b"), (10, "é ü\tß" * 50), (11, "x" * 50_000),
    (12, "one two three four five"), (13, "one two three four five"), (13, "different text under the same id, of ten words or more"),
    (14, "line\nline\nline\n\n\nother line\n" * 4), (15, "# * $ % word & | < >"), (16, BASE.upper()), (17, "\u2003 \u00a0 x"),
    (18, " ".join(f"w{i}" for i in range(30)) + " <|endoftext|> end"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if n % 3 else None, f"src{n % 2}" if n % 5 else None, n, "n", n, 1) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


# --- exact dedup


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


SORTED_BY = {"hash": exact.hash_of, "nothing": lambda block: F.lit(0).cast("long"), "length": lambda block: F.length(block).cast("long")}


@pytest.mark.parametrize("block, by", [(7, "hash"), (16_384, "hash"), (16_384, "nothing"), (500, "length"), (16_384, "length")])
def test_exact_groups(docs, block, by):
    """Also where all blocks, or all of one length, share what they are sorted by first."""
    groups = defaultdict(list)
    for i, text in TEXTS:
        groups[bare(text)].append((i, len(text or "")))
    want = []
    for body, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], -1 if m[0] is None else m[0]))
        first = True
        for i, n in members:
            kept = (i, n) == keep and first
            first = first and not kept
            want.append((i, n, keep[0], len(members), kept, hashlib.sha256(body.encode()).hexdigest()))
    assert rows_of(exact.document_groups(docs, block, SORTED_BY[by])) == sorted(want, key=repr)


def test_exact_drop_keeps_columns(docs, nothing):
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(bare(row.text) for row in kept.collect()) == Counter({bare(t): 1 for _, t in TEXTS})
    assert exact.document_groups(nothing).count() == 0 and exact.drop_copies(nothing).count() == 0


# --- near dedup


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) or frozenset([tuple(words)])


def brute_components(texts, size):
    sets = [shingles(t, size) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    lowest = {}
    for i, (doc, _) in enumerate(texts):
        r = find(i)
        known = [x for x in (lowest.get(r), doc) if x is not None]
        lowest[r] = min(known) if known else None
    return [(doc, len(sets[i]), lowest[find(i)] if sets[i] else doc) for i, (doc, _) in enumerate(texts)]


@pytest.mark.parametrize("size", [4, 5])
def test_near_groups(docs, size):
    got = near.near_groups(docs, size).select("doc_id", "n_shingles", "component_id")
    assert rows_of(got) == sorted(brute_components(TEXTS, size), key=repr)


def noisy_copies(n, words, edits, seed=3):
    import random

    draw = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(draw.randrange(edits)):
            own[draw.randrange(words)] = f"n{draw.randrange(10**6)}"
        out.append((i, " ".join(own)))
    return out


def test_near_group_of_many_copies_at_the_threshold(spark):
    texts = noisy_copies(250, 120, 9)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = near.near_groups(df, 4).select("doc_id", "n_shingles", "component_id")
    assert rows_of(got) == sorted(brute_components(texts, 4), key=repr)


def test_near_pairs_of_a_large_group_are_few(spark, monkeypatch):
    texts = noisy_copies(400, 120, 9, seed=5)
    verified, all_pairs = [], []
    check, pair = near._verified, near._all_pairs

    def counted(pairs, *others):
        verified.append(pairs.count())
        return check(pairs, *others)

    def seen(live, similarity):
        pairs = pair(live, similarity)
        all_pairs.append((pairs.count(), pairs.distinct().count()))
        return pairs

    df = spark.createDataFrame(texts, "doc_id long, text string")
    monkeypatch.setattr(near, "_verified", counted)
    monkeypatch.setattr(near, "_all_pairs", seen)
    got = near.near_groups(df, 4).select("doc_id", "n_shingles", "component_id")
    assert rows_of(got) == sorted(brute_components(texts, 4), key=repr)
    assert sum(verified[1:]) < 400
    # Without turns all pairs are left to the last step, which gives each of them once, though they share many bands.
    monkeypatch.setattr(near, "TURNS", 0)
    got = near.near_groups(df, 4).select("doc_id", "n_shingles", "component_id")
    assert rows_of(got) == sorted(brute_components(texts, 4), key=repr)
    assert all_pairs[-1][0] == all_pairs[-1][1] > 0


def test_near_drop(docs, nothing, spark):
    kept = near.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = [row.doc_id for row in kept.collect()]
    assert ids.count(13) == 1 and 1 not in ids and 2 not in ids and {0, 3, 4, 5} <= set(ids)
    assert near.near_groups(nothing).count() == 0 and near.drop_near_copies(nothing).count() == 0


def test_sketch_fills_every_coordinate_and_estimates():
    import numpy as np

    items = tokens.mix(np.arange(1, 400, dtype=np.uint64))
    sketch = near.sketches([items[:300], items[60:360], items[:1], items[:0]])
    assert (sketch[:3] != near._NONE).all() and (sketch[3] == near._NONE).all()
    assert abs((sketch[0] == sketch[1]).mean() - 240 / 360) < 0.15


# --- words and quality


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t#$A\x1c\u2003w", max_size=60), min_size=1, max_size=6))
def test_text_stats(texts):
    got = list(zip(*[c.tolist() for c in quality.stats_of([t.encode() for t in texts])]))
    for text, row in zip(texts, got):
        words = WORD.findall(text)
        at = defaultdict(list)
        for i in range(len(words) - 4):
            at[tuple(words[i : i + 5])].append(i)
        covered = {i + j for places in at.values() if len(places) > 1 for i in places for j in range(5)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        assert row == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abcdefghijkl A\n", max_size=80), min_size=1, max_size=5), st.integers(1, 5))
def test_shingle_sets(texts, size):
    got = tokens.shingle_sets([t.encode() for t in texts], size)
    want = [shingles(t, size) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(set(got[i].tolist()) & set(got[j].tolist())) == len(want[i] & want[j])


def test_binomial_proof():
    def tail(k, n, p):
        return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))

    for k, n, p, level in [(0, 100, 0.02, 0.1), (0, 100, 0.02, 0.2), (3, 400, 0.02, 0.05), (9, 400, 0.02, 0.05), (5, 5, 0.5, 0.9)]:
        assert quality.proves(k, n, p, level) == (tail(k, n, p) <= level)
    assert not quality.proves(0, 0, 0.5, 0.9)
    assert quality.proves(0, 200_000, 0.001, 1e-6)


LABELLED = "stratum string, good long, bad long, orders boolean, " + ", ".join(f"{r} double" for r in quality.RULES)


def test_cutoffs_follow_the_labels(spark):
    good = [(f"s{i % 2}", 1, 0, i % 5 == 0, 0.0, 0.0, 0.0, 5.0, -5.0, -50.0) for i in range(700)]
    bad = [(f"s{i % 2}", 0, 1, i % 5 == 0, 0.12, 0.0, 0.0, 5.0, -5.0, -50.0) for i in range(200)]
    few = [("tiny", 1, 0, False, 0.0, 0.0, 0.0, 5.0, -5.0, -50.0), ("tiny", 0, 1, False, 0.3, 0.0, 0.0, 5.0, -5.0, -50.0)]
    none = [(None, 0, 1, False, 0.3, 0.0, 0.0, 5.0, -5.0, -50.0), ("ok", 1, 0, False, 0.3, 0.0, 0.0, 5.0, -5.0, -50.0)]
    df = spark.createDataFrame(good + bad + few + none, LABELLED)
    chosen = {r.stratum: r.cutoffs for r in quality.cutoffs(df).collect()}
    assert set(chosen) == {"s0", "s1"}
    assert all(set(c) == {"symbol_share"} and 0.0 <= c["symbol_share"] < 0.12 for c in chosen.values())
    assert quality.cutoffs(df.limit(0)).count() == 0


def test_rules_together_stay_below_the_risk(spark):
    """300 strata are 300 trials: with two rules that each cost good documents, few choices exceed the risk."""
    trials, level = 300, 0.1
    u = lambda seed: F.rand(seed)
    rows = spark.range(trials * 800).select(
        (F.col("id") % trials).cast("string").alias("stratum"), (u(1) < 0.75).alias("g"), (u(2) < 0.2).alias("orders"), u(3).alias("a"), u(4).alias("b"))
    rows = rows.select("stratum", F.col("g").cast("long").alias("good"), (~F.col("g")).cast("long").alias("bad"), "orders",
                       F.when(F.col("g"), F.col("a") ** 30 * 0.6).otherwise(F.col("a")).alias("symbol_share"),
                       F.when(F.col("g"), F.col("b") ** 30 * 0.6).otherwise(F.col("b")).alias("dup_lines_per_word"),
                       F.lit(0.0).alias("repeat_share"), F.lit(5.0).alias("long_words"), F.lit(-5.0).alias("short_words"), F.lit(-50.0).alias("few_words"))
    from tradewind.session import stored

    chosen = quality.cutoffs(stored(rows), risk=0.02, delta=level * trials, worth=0.0).collect()
    keeps = lambda cut: 1.0 if cut is None else (min(1.0, cut / 0.6)) ** (1 / 30)
    lost = [1 - keeps(r.cutoffs.get("symbol_share")) * keeps(r.cutoffs.get("dup_lines_per_word")) for r in chosen]
    assert len(chosen) > trials / 2 and max(lost) > 0.01
    assert sum(share > 0.02 for share in lost) <= level * trials + 3 * math.sqrt(trials * level)


def test_quality_keeps_columns_and_odd_rows(docs, nothing, spark):
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, None), (None, 0, 0), (15, None, None)], "doc_id long, quality int, toxic int")
    got = quality.judged(docs, labels)
    assert got.columns == [*docs.columns, "quality"] and got.count() == len(TEXTS)
    verdicts = {row.doc_id: row.quality for row in got.collect()}
    assert verdicts[0].kept and not verdicts[3].kept and verdicts[3].n_words == 0 and not verdicts[14].kept
    assert quality.judged(nothing, labels).count() == 0
    assert quality.judged(docs, labels.limit(0)).where("quality.kept").count() > 0


# --- URL rules


RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
URLS = [
    "http://example.com/en/x", "https://WWW.Example.com/en/", "http://a.www.example.com/en/q?x", "http://badexample.com/en/",
    "http://example.com", "http://x.net/es/1#t", "http://x.net/ES/1", "net/es/1", None, "", "://net/es/", "http://net?/es/",
    "a://b://x.net/es/", "http://user@x.net:80/es/", "http://x.net/fr", "http:///en/", "http://é.net/fr/ü", "http://com/en/\n/x",
    "http://" + "a." * 3000 + "net/es/",
]


def brute_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(re.match(r"[^/?#]*", rest)[0]) :])[0]
    fits = [(len(r), r, v) for r, v in RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


@pytest.mark.parametrize("limit", [url_rules.MAX_INDEX_BYTES, 1])
def test_urls(spark, limit):
    pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate(URLS)], "page_id int, url string, rule string")
    rules = spark.createDataFrame(RULES + [(None, "block")], "rule string, verdict string")
    got = url_rules.judge_urls(pages, rules, max_index_bytes=limit).select("page_id", "url_verdict.*")
    assert rows_of(got) == sorted(((i, *brute_url(u)) for i, u in enumerate(URLS)), key=repr)
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0
    assert {r[0] for r in url_rules.judge_urls(pages, rules.limit(0)).select("url_verdict.verdict").collect()} == {"allow"}


def test_digest_collisions_are_confirmed(tmp_path):
    def one(_):
        return 5

    files = [str(tmp_path / "a.npy"), str(tmp_path / "a.json")]
    url_rules.DigestArray.write({"x/": "block", "y/": "allow"}, *files, digest=one)
    assert url_rules.DigestArray(*files).find(["y/", "z/", "x/"], digest=one) == ["allow", None, "block"]


# --- sharding


def brute_shard(doc_id, tree):
    def winner(level, weights):
        def draw(child):
            # Null leaves the seed as it is, as hashing a row does.
            h = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
            h = xxhash.xxh64_intdigest(level.encode(), seed=h)
            h = int_hash(child, h)
            return math.log(((h >> 11) + 0.5) / 2**53) / weights[child]

        return max(weights, key=draw)

    racks = {r: {k: sum(s.values()) for k, s in ks.items()} for r, ks in tree.items()}
    region = winner("region", {r: sum(w.values()) for r, w in racks.items()})
    rack = winner("rack", racks[region])
    return winner("shard", tree[region][rack])


def int_hash(value, seed):
    return xxhash.xxh64_intdigest(struct.pack("<i", value), seed=seed)


def test_sharding(docs, nothing):
    got = sharding.shard_documents(docs, 24).collect()
    tree, grown = sharding.tree_of(24), sharding.tree_of(25)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), brute_shard(i, tree), brute_shard(i, grown)) for i, t in TEXTS)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(nothing, 24).count() == 0


def test_sharding_moves_only_into_changed_subtrees(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")

    def shards(tree):
        return dict(sharding.place(ids, "doc_id", tree).select("doc_id", "shard").collect())

    old, new = shards(sharding.tree_of(24)), shards(sharding.tree_of(25))
    moved = [i for i in old if old[i] != new[i]]
    assert moved and {new[i] for i in moved} == {24} and abs(len(moved) - 20_000 / 25) < 150
    heavier = sharding.tree_of(24)
    heavier[1][2][9] = 3.0  # region 1, rack 2
    after = shards(heavier)
    assert all(8 <= after[i] < 16 for i in old if old[i] != after[i])
    counts = Counter(after.values())
    assert counts[9] > 2 * counts[8]
    heavier[0][0] = {s: 0.0 for s in heavier[0][0]}
    assert not {0, 1, 2, 3} & set(shards(heavier).values())


# --- mixing


def test_mixing(docs, nothing, spark):
    targets = spark.createDataFrame([("src0", 3.0), ("src1", 1.0), ("gone", 1.0)], "source string, weight double")
    got = mixing.replicate(docs, targets, epochs=4.0).collect()
    sizes = defaultdict(int)
    for row in docs.collect():
        sizes[row.source] += len((row.text or "").encode()) + 1
    counts = Counter((r.doc_id, r.text) for r in got)
    want = Counter()
    for row in docs.collect():
        if row.source is None:
            continue
        rate = 4.0 * sum(sizes.values()) * {"src0": 0.75, "src1": 0.25}[row.source] / sizes[row.source]
        key = f"7:{'null' if row.doc_id is None else row.doc_id}"
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52
        k, p, total = 0, math.exp(-rate), math.exp(-rate)
        while total <= u:
            k += 1
            p *= rate / k
            total += p
        want[(row.doc_id, row.text)] += k
    assert counts == +want
    assert mixing.replicate(nothing, targets).count() == 0
    assert mixing.replicate(docs, targets.limit(0)).count() == 0


def test_mixing_with_very_high_rates(spark):
    df = spark.createDataFrame([(i, None, "tiny") for i in range(40)] + [(99, "x" * 200_000, "big")], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("tiny", 1.0), ("big", 1.0)], "source string, weight double")
    got = {r.doc_id: (r.n, r.m) for r in mixing.replicate(df, targets).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("copy_no").alias("m")).collect()}
    counts = [got[i][0] for i in range(40)]
    rate = (200_001 + 40) / 2 / 40
    assert abs(sum(counts) / 40 - rate) < 5 * math.sqrt(rate / 40) and len(set(counts)) > 20
    assert 0.4 * rate < sum((n - rate) ** 2 for n in counts) / 40 < 2 * rate
    assert all(got[i][0] == got[i][1] for i in range(40))


def test_mixing_meets_the_rate(spark):
    df = spark.range(20_000).selectExpr("id doc_id", "'abc' text", "if(id % 3 = 0, 'a', 'b') source", "1 copy_no")
    targets = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, weight double")
    got = mixing.replicate(df, targets)
    assert got.columns == ["doc_id", "text", "source", "copy_no", "_copy_no", "mix_key"]
    counts = Counter(r.source for r in got.select("source").collect())
    assert abs(counts["a"] - 10_000) < 400 and abs(counts["b"] - 10_000) < 400


# --- packing


def test_packing(docs, nothing):
    from tokenizers import Tokenizer

    exact_tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    got = packing.pack(docs, capacity=64).collect()
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(filled) <= -(-sum(r.length for r in got) // 64) + 1
    want = Counter()
    for i, text in TEXTS:
        ids = exact_tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        rest = len(ids) % 64
        cuts = ([0] if rest else []) + list(range(rest, len(ids), 64)) + [len(ids)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(i, n, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b])))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert packing.pack(nothing).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), max_size=8), st.integers(1, 60))
def test_fullest_is_fullest(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
    taken = packing.fullest(counts, room)
    assert sum(length * n for length, n in taken.items()) == max(sums)
    assert all(n <= counts[length] for length, n in taken.items())


def test_plan_uses_every_piece():
    histogram = {1: 1000, 3: 17, 500: 40, 524: 9, 1024: 70, 600: 33, 424: 12, 77: 801}
    used = Counter()
    for times, taken in packing.plan(histogram, 1024):
        assert sum(length * n for length, n in taken.items()) <= 1024
        for length, n in taken.items():
            used[length] += n * times
    assert used == Counter(histogram)
    assert packing.plan({}, 1024) == []
