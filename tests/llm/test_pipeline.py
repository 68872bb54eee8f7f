"""The five stages together, against a version that works on Python lists."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tradewind.llm import packing
from tradewind.llm.queries import MIX_EPOCHS, MIX_EXPONENT, MIX_SEED

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality string, kept_id int, copy_no int"


def passes_base(text):
    words = WORD.findall(text or "")
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words) >= 10 and 100 * len(repeated) <= 20 * len(words)


def no_copies(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")].append(row)
    return [min(group, key=lambda r: (-len(r[1] or ""), -1 if r[0] is None else r[0])) for group in groups.values()]


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def no_near_copies(rows):
    sets, root = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    best = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            best[find(i)] = min(best.get(find(i), row[0]), row[0])
    return [row for i, row in enumerate(rows) if row[0] == best.get(find(i))]


def mixed(rows):
    sizes = Counter()
    for row in rows:
        sizes[row[3]] += len((row[1] or "").encode()) + 1
    total, weights = sum(sizes.values()), sum(s**MIX_EXPONENT for s in sizes.values())
    out = []
    for row in rows:
        rate = MIX_EPOCHS * total * sizes[row[3]] ** MIX_EXPONENT / weights / sizes[row[3]]
        digest = hashlib.md5(f"{MIX_SEED}:{'null' if row[0] is None else row[0]}".encode()).hexdigest()
        draw, k, p, done = int(digest[:13], 16) / 2**52, 0, math.exp(-rate), math.exp(-rate)
        while done <= draw and k < 1000:
            k += 1
            p *= rate / k
            done += p
        out += [row] * k
    return out


def pieces(rows):
    from tokenizers import Tokenizer

    tokenizer, out = Tokenizer.from_file(packing.default_tokenizer()), Counter()
    for row in rows:
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [2]
        rest = len(ids) % 1024
        cuts = ([0] if rest else []) + list(range(rest, len(ids), 1024)) + [len(ids)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out[(row[0], n, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b])))] += 1
    return out


def told(draw, n):
    return " ".join(draw.choice("abcdefgh") + str(draw.randrange(500)) for _ in range(n))


@pytest.fixture(scope="module")
def given():
    draw = random.Random(4)
    rows = [(i, told(draw, draw.choice([5, 9, 10, 40, 200])), "en", draw.choice(["web", "web", "web", "book", None])) for i in range(120)]
    long = told(draw, 60)
    rows += [
        (None, told(draw, 30), None, None), (200, None, "en", "web"), (201, "", "en", "web"), (202, "  \n", None, "web"),
        (203, long, "en", "web"), (204, long + "\n", "en", "web"), (205, long.replace(" ", "  "), "en", "book"), (206, long + " tail", "en", "web"),
        (207, long.upper(), "en", "book"), (208, told(draw, 9) + "\n" + "same five words again here " * 10, "en", "web"),
        (209, told(draw, 20_000), "fr", "web"), (210, "ü" + told(draw, 15), "fr", "tiny"),
    ]
    rows += [rows[0], rows[0], rows[-2]]
    return rows


def write(spark, folder, rows):
    docs = [(i, text, lang, source, len(text or ""), "q", 7, 1) for i, text, lang, source in rows]
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (1, 0, 0), (None, 0, 1), (2, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_together(spark, tmp_path, given):
    write(spark, tmp_path, given)
    rows, docs = given, spark.read.parquet(f"{tmp_path}/documents.parquet")
    steps = [lambda r: [x for x in r if passes_base(x[1])], no_copies, no_near_copies, mixed]
    for n, ((name, stage), brute) in enumerate(zip(corpus_pipeline.STAGES, steps)):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/step{n}")
        before, docs, rows = docs, spark.read.parquet(f"{tmp_path}/step{n}"), brute(rows)
        assert docs.columns == before.columns
        assert Counter((r.doc_id, r.text, r.lang, r.source) for r in docs.collect()) == Counter(rows), name
    assert 50 < len(rows) < len(given)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces(rows)
    filled = defaultdict(list)
    for r in packed:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        parts.sort()
        assert [offset for offset, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 1024
    bins = []
    for length in sorted((r.length for r in packed), reverse=True):
        fits = [k for k, left in enumerate(bins) if left >= length]
        if fits:
            bins[fits[0]] -= length
        else:
            bins.append(1024 - length)
    # On so few pieces, filling each bin as far as it goes can leave long pieces that share badly.
    assert len(filled) <= 1.2 * len(bins)


def test_nothing_to_pack(spark, tmp_path):
    write(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_other_columns(spark, tmp_path):
    """No n_chars, and one more column: stages return what they were given."""
    write(spark, tmp_path, [(1, " ".join(f"w{i}" for i in range(20)), "en", "web")])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").select("text", "source", "doc_id", "lang", "quality")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
