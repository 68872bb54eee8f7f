"""The Merkle manifest against a tree built level by level."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tradewind.llm import manifest, queries

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, rank int, digest string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H(out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, i):
    steps = []
    for nodes in tree[:-1]:
        run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
        steps.append((i % 8, run[: i % 8] + run[i % 8 + 1 :]))
        i //= 8
    return steps


def brute(rows):
    """Result rows for (doc_id, source, lang, n_chars, text) rows."""
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(by_lang, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: levels([m[2] for m in sorted(by_lang[k], key=lambda m: m[:3])]) for k in order}
    top = levels([trees[k][-1][0] for k in order])
    out = []
    for n, k in enumerate(order):
        for i, (_, _, digest, row) in enumerate(sorted(by_lang[k], key=lambda m: m[:3])):
            steps = path(trees[k], i) + path(top, n)
            seen = list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                seen[4] = row[4].translate(LOWER)
            folded = leaf(seen)
            for place, others in steps:
                folded = H([*others[:place], folded, *others[place:]])
            out.append((row[0], digest, trees[k][-1][0], top[-1][0], H(d for _, others in steps for d in others), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def judged(docs):
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    seen = F.when(altered, F.translate("text", capitals, capitals.lower())).otherwise(F.col("text"))
    return manifest.manifest(docs, COLUMNS, {"text": seen})


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, n, "t", 1, "d") for i, s, lang, n, t in rows], SCHEMA).repartition(3)


ODD = [(None, None, None, None, None), (None, "s", "en", 1, "Text"), (1, "s", "en", 3, "Abc"), (1, "s", "en", 3, "Abc"), (1, "s", "en", 4, "abcd"),
       (2, "", "", 0, ""), (3, "ü", "fr", 2, "Éa\n"), (4, "s", "en", 9, None), (5, "s", None, 5, "X" * 100_000), (-7, "s", "en", -1, "ABC"), (9, "s", "zz", 1, "lone")]


@pytest.mark.parametrize("levels_of_a_block", [1, 2, 4])
def test_manifest(spark, monkeypatch, levels_of_a_block):
    monkeypatch.setattr(manifest, "LEVELS", levels_of_a_block)
    monkeypatch.setattr(manifest, "BLOCK", 8**levels_of_a_block)
    rng = random.Random(levels_of_a_block)
    rows = ODD + [(100 + i, f"s{i % 3}", rng.choice(["en"] * 20 + ["de", "fr"]), i, rng.choice(["Mixed", "plain", "", None]) and f"Text {i}") for i in range(700)]
    rows += [(5000 + i, "s", f"l{i:03d}", 1, "A") for i in range(70)]  # more languages than a block of one or two levels holds
    got = judged(frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513])
def test_manifest_of_one_language(spark, n):
    rows = [(i * 3, "s", "en", 1, f"T{i}") for i in range(n)]
    assert sorted((tuple(r) for r in judged(frame(spark, rows)).collect()), key=repr) == brute(rows)


def test_manifest_of_nothing(spark):
    got = judged(frame(spark, []))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and got.count() == 0


def test_manifest_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*COLUMNS).collect()
    got = queries.QUERIES["op13_manifest"](spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute([tuple(r) for r in docs])


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_are_a_layout(levels):
    """Every node has an address of its own, the root the first; halves are contiguous."""
    all_of_them = [a for depth in range(levels) for a in manifest._level(levels, depth).tolist()]
    assert sorted(all_of_them) == list(range(manifest.size_of(levels))) and manifest._level(levels, 0)[0] == 0
    if levels > 1:
        top = levels // 2
        upper = [a for depth in range(top) for a in manifest._level(levels, depth).tolist()]
        assert sorted(upper) == list(range(manifest.size_of(top)))
        below = manifest._level(levels, top)
        assert below.tolist() == [manifest.size_of(top) + k * manifest.size_of(levels - top) for k in range(8**top)]
