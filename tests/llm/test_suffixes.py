"""Suffix arrays and repeated strings against brute force."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewind.llm import suffixes


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(symbols):
    assert suffixes.suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@pytest.mark.parametrize("symbols", [[], [5], [0] * 300, list(range(50)), list(range(50, 0, -1)), [0, 1] * 99, [1, 0] * 99])
def test_suffix_array_of_regular_strings(symbols):
    assert suffixes.suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def brute(rows):
    seen = {}
    for doc, text in rows:
        data = (text or "").encode()
        doc = float("inf") if doc is None else doc
        for i in range(len(data) - 49):
            key = data[i : i + 50]
            seen[key] = min(seen.get(key, float("inf")), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - 49):
            if seen[data[i : i + 50]] < (float("inf") if doc is None else doc):
                gone[i : i + 50] = [True] * 50
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((None if doc == float("inf") else doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    draw = random.Random(seed)
    parts = ["".join(draw.choice("abcdé \n") for _ in range(draw.randrange(20, 140))) for _ in range(8)]
    rows = []
    for i in range(60):
        text = "".join(
            draw.choice(parts) if draw.random() < 0.4 else "".join(draw.choice("abcdefgh ") for _ in range(draw.randrange(60)))
            for _ in range(draw.randrange(7))
        )
        if draw.random() < 0.3 and len(text) > 5:
            at = draw.randrange(len(text))
            text = text[:at] + "#" + text[at + 1 :]
        rows.append((i, text))
    rows += [(i + 60, rows[draw.randrange(60)][1]) for i in range(10)]
    rows += [(70, "x" * 5000), (71, "x" * 49), (72, "x" * 50), (73, "ab" * 400), (74, "ba" * 300), (5, rows[7][1]), (5, rows[5][1]),
             (None, rows[3][1]), (None, parts[0] * 3), (75, None), (76, ""), (77, "\x00\x7f" * 60), (78, "\x00\x7f" * 60), (79, "é" * 30 + "z"), (80, "é" * 30)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, chunk", [(1, 200), (2, 3000), (3, 1 << 20)])
def test_repeated_strings(spark, seed, chunk):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, answers string").repartition(3)
    got = suffixes.repeated_strings(df, chunk).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_no_rows(spark):
    assert suffixes.repeated_strings(spark.createDataFrame([], "doc_id long, text string")).count() == 0
