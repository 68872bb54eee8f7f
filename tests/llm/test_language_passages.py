"""Language identification on held-out rows, and fuzzy passages against planted ones."""

import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.llm import language, passages
from tradewind.session import stored_alone


def spoken(draw, letters, n):
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(2, 8))) for _ in range(n))


def test_language(spark):
    draw = random.Random(1)
    kinds = {"aa": "abcdeé", "bb": "cdefgü", "cc": "efghiñ"}
    rows = [(i, spoken(draw, kinds[k], draw.randrange(3, 60)), k) for i in range(900) for k in [draw.choice(list(kinds))]]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !!", "bb"), (1003, "abc", None), (None, "abcé abcé", "aa"), (7, rows[7][1], rows[7][2])]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = language.predict_all(df, sample=100).collect()
    assert len(got) == len(rows)
    told = {r.doc_id: r for r in got}
    for i, text, _ in rows:
        held = i is None or zlib.crc32(str(i).encode()) % 3 == 1
        assert told[i].held_out == held and 0 <= told[i].score <= 1
        assert (told[i].lang_pred == "und") == (text is None or not any(c.isalpha() for c in text))
    lang = {i: k for i, _, k in rows[:900]}
    tested = [r for r in got if r.held_out and r.doc_id in lang]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in tested]) > 0.97
    assert abs(np.mean([r.score for r in tested]) - np.mean([r.lang_pred == lang[r.doc_id] for r in tested])) < 0.05
    nothing = df.limit(0)
    assert language.predict_all(nothing).count() == 0
    assert {r.lang_pred for r in language.predict_all(df.where("lang is null")).collect()} == {"und"}


def test_scores_of_short_texts_are_honest(spark):
    """Pieces of held-out texts, by size: the mean score is close to the share that is right, and none is certain."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs.where(~language.held_out(docs["doc_id"])))
    draw = random.Random(8)
    kept = [r for r in docs.where(language.held_out(docs["doc_id"])).where("lang is not null and text is not null").select("text", "lang").collect() if len(r.text.split()) > 5]
    for n in (1, 2, 4, 20):
        told, right = [], []
        for r in kept:
            words = r.text.split()
            for _ in range(3):
                start = draw.randrange(max(1, len(words) - n))
                piece = " ".join(words[start : start + n])
                if language.has_letter(piece):
                    lang, score = model.predict(piece)
                    told.append(score)
                    right.append(lang == r.lang)
        assert abs(np.mean(told) - np.mean(right)) < 0.06, n
        assert max(told) < 0.9999
    assert model.predict("a")[1] < 0.9


def test_too_many_languages_are_an_error(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"some text {i}", f"l{i % 3}") for i in range(30)], "doc_id long, text string, lang string")
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError, match="more than 2 languages"):
        language.fit(df)


def test_weights_are_sparse_and_temperature_calibrates():
    draw = np.random.default_rng(3)
    rows = [(np.array([i % 2, 10 + draw.integers(500)]), np.array([0.9, 0.4])) for i in range(400)]
    weights = language.train(rows, np.array([i % 2 for i in range(400)]), 2)
    assert np.count_nonzero(weights) < 2000 and weights[0, 0] > 0 > weights[0, 1]
    labels = draw.integers(2, size=4000)
    sure = np.where(draw.random(4000) < 0.75, labels, 1 - labels)
    scores = np.zeros((4000, 2))
    scores[np.arange(4000), sure] = 6.0
    p = language._softmax(scores / language.temperature(scores, labels)).max(axis=1)
    assert abs(p.mean() - 0.75) < 0.03


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=14))
def test_first_chain_is_best(theirs):
    theirs = np.array(theirs)
    ours = np.arange(len(theirs)) * 3

    def best():
        score = []
        for i in range(len(theirs)):
            before = [score[j] - passages.GAP_COST * (ours[i] - ours[j] + theirs[i] - theirs[j]) for j in range(i) if theirs[j] < theirs[i]]
            score.append(passages.SEED + max([0.0, *before]))
        return max(score)

    chains = passages.chain(ours, theirs, least=1)
    total = passages.SEED * len(chains[0]) - passages.GAP_COST * (np.diff(ours[chains[0]]).sum() + np.diff(theirs[chains[0]]).sum())
    assert total == pytest.approx(best())
    assert sorted(i for c in chains for i in c) == list(range(len(theirs)))
    assert all((np.diff(theirs[c]) > 0).all() for c in chains)


def test_stretches():
    hit = np.array([0] * 30 + [1] * 60 + [0] * 40 + ([1] * 9 + [0]) * 7 + [0] * 20, dtype=bool)
    found = sorted(passages.stretches(hit))
    assert found == [(30, 90), (130, 199)]


def test_stretches_across_a_gap():
    hit = np.array([1] * 30 + [0] * 10 + [1] * 30, dtype=bool)
    assert passages.stretches(hit) == [(0, 70)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), max_size=40), st.sampled_from([0.5, 0.75, 0.8]))
def test_stretches_brute_force(hit, identity):
    def longest(low, high):
        fits = [(j - i, -i) for i in range(low, high) for j in range(i + 6, high + 1)
                if hit[i] and hit[j - 1] and sum(hit[i:j]) * 100 >= round(identity * 100) * (j - i)]
        if not fits:
            return []
        size, begin = max(fits)
        return [*longest(low, -begin), (-begin, size - begin), *longest(size - begin, high)]

    assert sorted(passages.stretches(np.array(hit, dtype=bool), 6, identity)) == longest(0, len(hit))


def planted(seed, n=60):
    draw = random.Random(seed)

    def words(k):
        return [f"w{draw.randrange(10**6)}" for _ in range(k)]

    bank = [words(70) for _ in range(4)]
    rows, truth = [], {}
    for i in range(n):
        body = words(draw.randrange(30, 200))
        if i % 3 == 0:
            which = draw.randrange(4)
            passage = list(bank[which])
            for _ in range(draw.randrange(4)):  # at most 3 of 70 words changed, dropped or added
                at = draw.randrange(len(passage))
                passage[at : at + 1] = draw.choice([["other"], [], [passage[at], "more"]])
            at = draw.randrange(len(body))
            truth[i] = (which, at, at + len(passage))
            body = body[:at] + passage + body[at:]
        rows.append((i, " ".join(body)))
    return rows, truth


@pytest.mark.parametrize("chunk", [500, 1 << 20])
def test_fuzzy_passages(spark, chunk):
    rows, truth = planted(5)
    rows += [(60, rows[1][1].upper()), (61, None), (62, ""), (None, rows[1][1]), (1, rows[1][1]), (63, "same " * 300), (64, "same " * 300)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, number int").repartition(2)
    got = passages.fuzzy_passages(df, chunk).collect()
    assert len(got) == len(rows)
    seen = set()
    for r in sorted((r for r in got if r.doc_id is not None and r.doc_id < 60), key=lambda r: r.doc_id):
        which, begin, end = truth.get(r.doc_id, (None, 0, 0))
        if which in seen:
            covered = {w for p in r.passages for w in range(p.begin, p.end)}
            assert len(covered & set(range(begin, end))) >= 0.85 * (end - begin), r
            assert len(covered) <= end - begin + 6 and all(p.partner < r.doc_id for p in r.passages)
        else:
            assert r.passages == [] and r.n_repeated == 0
        if which is not None:
            seen.add(which)
    by_id = {r.doc_id: r for r in got}
    long_enough = len(rows[1][1].split()) >= 50
    assert (by_id[60].n_repeated == by_id[60].n_words) == long_enough
    assert (by_id[None].n_repeated == by_id[None].n_words) == long_enough
    assert by_id[61].n_words == 0 and by_id[62].passages == []
    assert passages.fuzzy_passages(df.limit(0)).count() == 0


def test_a_mixture_of_earlier_passages_is_found(spark):
    draw = random.Random(2)

    def words(k):
        return [f"w{draw.randrange(10**6)}" for _ in range(k)]

    one, two = words(30), words(30)
    rows = [words(40) + one + words(40), words(40) + two + words(40), words(40) + one + two + words(40), words(20) + one + two + words(60)]
    joint = words(20) + one[:-1] + ["other"] + two + words(60)
    df = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate([*rows, joint])], "doc_id long, text string")
    got = {r.doc_id: r for r in passages.fuzzy_passages(df, 700).collect()}
    assert [got[i].n_repeated for i in range(3)] == [0, 0, 0]
    assert [tuple(p) for p in got[3].passages] == [(20, 80, 2)]
    assert (20, 80, 2) in [tuple(p) for p in got[4].passages]


def test_a_run_of_the_least_length_behind_shorter_ones(spark):
    draw = random.Random(4)
    body = [f"w{draw.randrange(10**6)}" for _ in range(50)]

    def around(part):
        return " ".join(f"x{draw.randrange(10**6)}" for _ in range(30)) + " " + " ".join(part) + " " + " ".join(f"x{draw.randrange(10**6)}" for _ in range(30))

    parts = [body[:49], body[1:], body[:40], body[10:], body, body]
    df = spark.createDataFrame([(i, around(p)) for i, p in enumerate(parts)], "doc_id long, text string")
    got = {r.doc_id: r for r in passages.fuzzy_passages(df).collect()}
    assert (30, 80, 4) in [tuple(p) for p in got[5].passages]


@pytest.mark.parametrize("length, every", [(80, 8), (80, 6), (60, 8), (60, 6)])
def test_recall_of_edited_passages(spark, length, every):
    draw = random.Random(length + every)

    def words(k):
        return [f"w{draw.randrange(10**6)}" for _ in range(k)]

    rows, n = [], 100
    bank = [words(length) for _ in range(n)]
    rows += [(i, words(40) + b + words(40)) for i, b in enumerate(bank)]
    rows += [(n + i, words(60) + [w if j % every != every - 1 else "other" for j, w in enumerate(b)] + words(60)) for i, b in enumerate(bank)]
    df = spark.createDataFrame([(i, " ".join(r)) for i, r in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in passages.fuzzy_passages(df).collect()}
    assert sum(p.partner == i and p.end - p.begin >= length - every for i in range(n) for p in got[n + i].passages) == n


@pytest.mark.parametrize("chunk", [700, 1 << 20])
def test_a_partner_that_is_first_holder_of_no_seed(spark, chunk):
    """A line that many have, then words too far apart for a seed: the partner has them, the line's first holders have not."""
    draw = random.Random(6)

    def words(k):
        return [f"w{draw.randrange(10**6)}" for _ in range(k)]

    line, bodies = words(15), [words(35) for _ in range(3)]
    rows = [words(30) + line + words(60) for _ in range(4)] + [words(30) + line + b + words(30) for b in bodies]
    for b in bodies:
        edited = [w if j % 4 else "other" for j, w in enumerate(b)][:34]
        rows.append(words(20) + line + edited + words(50))
        rows.append(words(20) + edited[:20] + words(50))
    df = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in passages.fuzzy_passages(df, chunk).collect()}
    # 49 words are too few; with the next one they are a passage.
    assert [got[7 + 2 * k].n_repeated for k in range(3)] == [0, 0, 0]
    rows = [r if i < 7 or i % 2 == 0 else [*r[:69], bodies[(i - 7) // 2][34], *r[69:]] for i, r in enumerate(rows)]
    df = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in passages.fuzzy_passages(df, chunk).collect()}
    assert [[tuple(p) for p in got[7 + 2 * k].passages] for k in range(3)] == [[(20, 70, 4 + k)] for k in range(3)]
    assert [got[i].n_repeated for i in range(7)] == [0] * 7 and [got[8 + 2 * k].n_repeated for k in range(3)] == [0] * 3


@pytest.mark.parametrize("seed", range(3))
def test_all_words_of_passages_on_a_diagonal_are_found(spark, seed):
    """Against every diagonal of every pair: stock lines in all texts, bodies that few share and that are edited."""
    draw = random.Random(seed)

    def words(k):
        return [f"w{draw.randrange(5000)}" for _ in range(k)]

    lines, bodies = [words(draw.randrange(6, 25)) for _ in range(3)], [words(60) for _ in range(6)]
    rows = []
    for _ in range(70):
        text = words(draw.randrange(20))
        for _ in range(draw.randrange(1, 3)):
            rate = draw.choice([0.1, 0.2, 0.25, 0.3])
            text += draw.choice(lines) + [w if draw.random() > rate else f"o{draw.randrange(10**6)}" for w in draw.choice(bodies)] + words(draw.randrange(60))
        rows.append(text)
    df = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in passages.fuzzy_passages(df, 4000).collect()}
    lost = wanted = 0
    for i, ours in enumerate(rows):
        true = set()
        for theirs in rows[:i]:
            for shift in range(50 - len(theirs), len(ours) - 49):
                hit = np.array([0 <= k - shift < len(theirs) and w == theirs[k - shift] for k, w in enumerate(ours)])
                if hit.sum() >= 40:
                    total = np.concatenate(([0], np.cumsum(hit)))
                    for size in range(50, 100):
                        for k in np.flatnonzero(10 * (total[size:] - total[:-size]) >= 8 * size):
                            inside = np.flatnonzero(hit[k : k + size]) + k
                            if inside[-1] + 1 - inside[0] >= 50:
                                true.update(range(inside[0], inside[-1] + 1))
        covered = {w for p in got[i].passages for w in range(p.begin, p.end)}
        wanted, lost = wanted + len(true), lost + len(true - covered)
    assert wanted > 500 and lost <= 0.01 * wanted, (lost, wanted)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14), st.sampled_from([1, 20, 1 << 26]))
def test_gap_matches_is_a_longest_common_subsequence(a, b, bits):
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1], size[i + 1][j])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(passages, "_TABLE_BITS", bits)
        matched = passages._gap_matches(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64))
    assert len(set(matched)) == len(matched) == size[-1][-1]
    rest = iter(b)
    assert all(a[i] in rest for i in sorted(matched))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 130), st.integers(0, 10**6), st.floats(0.5, 1)), min_size=1, max_size=6))
def test_possible_rules_out_no_passage(kinds):
    """Possible is what has LENGTH or more words of which the partner has enough; every passage is among that."""
    draw = np.random.default_rng(kinds[0][1])
    text = draw.integers(0, 40, 300).astype(np.uint64)
    partner = passages.Partner.__new__(passages.Partner)
    partner.words = passages.Places(text)
    words, wanted, want, found = [], [], [], []
    for size, seed, share in kinds:
        own = np.random.default_rng(seed)
        start = int(own.integers(0, 300 - size)) if size < 300 else 0
        hit = own.random(size) < share
        words.append(np.where(hit, text[start : start + size], np.uint64(1000)))
        wanted.append(np.arange(size) + start)
        total = np.concatenate(([0], np.cumsum(hit)))
        want.append(any(10 * (total[b] - total[a]) >= 8 * (b - a) for a in range(size) for b in range(a + passages.LENGTH, size + 1)))
        found.append(bool(passages.stretches(hit)))
    got = partner.possible(np.array([len(w) for w in words]), np.concatenate(words), np.concatenate(wanted))
    assert got.tolist() == want and all(g >= f for g, f in zip(got, found))


def test_path_takes_the_best_of_all_paths():
    """Against every ascending choice of runs."""

    def worth(path, ours, theirs, size):
        total = 0.0
        for n, k in enumerate(path):
            if n:
                apart = abs((ours[k] - theirs[k]) - (ours[path[n - 1]] - theirs[path[n - 1]]))
                total -= 0.05 * apart + (apart > 0)
            total += size[k]
        return total

    draw = np.random.default_rng(7)
    for n in (1, 2, 5, 9):
        for _ in range(30):
            ours, theirs, size = np.cumsum(draw.integers(1, 5, n)), draw.integers(0, 12, n), draw.integers(3, 9, n)
            extra = np.zeros(n)
            extra[draw.integers(n)] = 1e6
            path = passages._path(ours, theirs, size, extra)
            assert all(theirs[a] < theirs[b] for a, b in zip(path, path[1:]))
            choices = [[k for k in range(n) if mask >> k & 1] for mask in range(1, 1 << n)]
            rising = [c for c in choices if all(theirs[a] < theirs[b] for a, b in zip(c, c[1:]))]
            assert worth(path, ours, theirs, size + extra) == pytest.approx(max(worth(c, ours, theirs, size + extra) for c in rising), abs=1e-6)


def test_what_storing_shuffled_is_deleted_at_once(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f.name for top in manager.localDirsString() for f in Path(top).glob("*/shuffle_*.data")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, usual = files(), spark.conf.get(name)
    kept = stored_alone(spark.range(1000).withColumn("k", F.col("id") % 7).repartition(3, "k"))
    assert not files() - before and spark.conf.get(name) == usual
    assert kept.groupBy("k").count().count() == 7 and kept.count() == 1000


def test_alignments_together_are_those_of_each_alone():
    """Also with a chain of another text between them, and with stretches of few words."""
    draw = np.random.default_rng(11)
    text = [f"w{k}" for k in draw.integers(0, 60, 400)]
    known = passages.Partner(" ".join(text).encode())
    stretch, a, b = [], [], []
    for n in range(80):
        start, size = int(draw.integers(0, 300)), int(draw.integers(4, 100))
        own = known.hashes[start : start + size].copy()
        at = int(draw.integers(0, size - 3))
        edit = np.flatnonzero(draw.random(size) < 0.2)
        edit = edit[(edit < at) | (edit > at + 3)]
        own[edit] = known.hashes[draw.integers(0, 400, len(edit))] if n % 2 else np.uint64(7)
        if n % 5 == 4:  # words left out before the chain
            own, at = np.concatenate((own[: at // 2], own[at // 2 + at // 4 :])), at - at // 4
        stretch.append(own)
        a.append(np.array([at]))
        b.append(np.array([0 if n % 9 == 8 else start + at + size - len(own)]))
    alone = [passages.align([s], known, [x], [y])[0] for s, x, y in zip(stretch, a, b)]
    together = passages.align(stretch, known, a, b)
    assert [h.tolist() for h in together] == [h.tolist() for h in alone]
    assert sum(h.any() for h in alone) > 60 and not all(h.any() for h in alone)


def test_chains_of_a_pair_send_their_words_once():
    """Lines that both texts repeat: a chain for each pair of places, but each word is sent once and comes back."""
    line = [f"w{k}" for k in range(12)]
    text = " ".join(w for k in range(40) for w in [*line, f"x{k}"]).encode()
    row = next(passages.C.rows_of(passages.C._row(0, [1], [text])))
    words = passages.Words(passages.C.opened(row))
    at = np.repeat(np.arange(10, 30) * 13, 40)
    theirs = np.tile(np.arange(40) * 13, 20)
    sent = passages._groups(words, 0, 5, at - 100, at + 104, np.ones(len(at), dtype=np.int64), at, theirs)
    assert [len(g["heads"]) // 16 for g in sent] == [512, 288]
    assert sum(len(g["words"]) for g in sent) <= 2 * 8 * len(words.hashes)
    back = [c for g in sent for c in passages._opened(g["words"], g["heads"], g["ours"], g["theirs"])]
    assert [begin for begin, *_ in back] == (at - 100).tolist() and [int(b[0]) for *_, b in back] == theirs.tolist()
    for begin, got, a, _ in back:
        assert a.tolist() == [100] and (got == words.hashes[begin : begin + 204] & np.uint64(2**48 - 1)).all()


def test_pairs_of_a_line_that_many_texts_have_stay_numbers():
    """A row for each chunk and bucket, however many pairs, and no object for each of them."""
    draw = random.Random(9)
    line = " ".join(f"w{k}" for k in range(70))
    texts = [f"a{draw.random()} {line} b{draw.random()}".encode() for _ in range(60)]
    words = passages.Words(passages.C.opened(next(passages.C.rows_of(passages.C._row(3, list(range(60)), texts)))))
    keys = passages._seed_keys(words, 1)
    places = passages._rest_places(words, keys, {}, [])
    sent = passages.C.packed(passages._first_alike(places, np.zeros(len(places)))[0].tobytes())
    got = passages._compare(passages.pa.table({"bucket": [0], "chunk": [3], "sent": [sent]})).to_pylist()
    assert [r["chunk"] for r in got] == [3]
    pairs = np.frombuffer(passages.C.unpacked(got[0]["pairs"]), dtype=np.int64).reshape(-1, 3)
    assert {(int(words.owner[a]), p) for a, p, _ in pairs.tolist()} == {(i, k) for i in range(60) for k in range(1, i)}  # the first holder has been tried


def aligned_alone(known, chains):
    found = set()
    for begin, words, a, b in chains:
        (hit,) = passages.align([words], known, [a], [b])
        found.update((begin + x, begin + y) for x, y in passages.stretches(hit))
    return found


def runs_of(draw, kinds, n, most):
    """Runs of one word, here and there with other words between them."""
    text = []
    for _ in range(n):
        text += [f"w{draw.randrange(kinds)}"] * draw.randrange(1, most)
        if draw.random() < 0.3:
            text += [f"x{draw.randrange(10)}" for _ in range(draw.randrange(1, 40))]
    return text


def seeds_of_runs(ours, theirs, around=2 * passages.LENGTH):
    """One group with a chain for each diagonal of two runs of a word, as the third round makes them."""
    words = passages.Words(passages.C.opened(next(passages.C.rows_of(passages.C._row(0, [1], [" ".join(ours).encode()])))))
    pairs = [(x, y) for x in range(len(ours) - 3) for y in range(len(theirs) - 3)
             if len({*ours[x : x + 4], *theirs[y : y + 4]}) == 1 and (not x or not y or ours[x - 1] != theirs[y - 1])]
    if not pairs:
        return None
    at, theirs_at = np.array(pairs).T
    left, right = np.maximum(0, at - around), np.minimum(len(ours), at + passages.SEED + around)
    return passages._groups(words, 0, 5, left, right, np.ones(len(at), dtype=np.int64), at, theirs_at)


@pytest.mark.parametrize("kinds, most", [(40, 90), (6, 90), (3, 60), (200, 130)])
def test_settled_chains_have_the_passages_of_their_alignments(kinds, most):
    draw = random.Random(kinds)
    settled = found = 0
    for _ in range(6):
        ours, theirs = runs_of(draw, kinds, 4, most), runs_of(draw, kinds, 5, most)
        theirs += ["between"] * 3 + ours[: len(ours) // 3]  # also in the same order
        known = passages.Partner(" ".join(theirs).encode())
        for group in seeds_of_runs(ours, theirs) or []:
            arrays = passages._arrays(*(group[c] for c in ("words", "heads", "ours", "theirs")))
            done, spans = passages.settled(known, *arrays)
            assert set(map(tuple, spans.tolist())) == aligned_alone(known, passages._cut(*arrays, done))
            settled, found = settled + done.sum(), found + len(spans)
    assert settled > 50 and found > 0


def test_runs_of_one_word_are_not_aligned_on_every_diagonal():
    """Runs among other words on both sides: 60 + 80 diagonals and no alignment, and the passages are the blocks."""
    ours = [f"a{k}" for k in range(120)] + ["w"] * 60 + [f"b{k}" for k in range(120)]
    theirs = [f"c{k}" for k in range(90)] + ["w"] * 80 + [f"d{k}" for k in range(90)]
    (group,) = seeds_of_runs(ours, theirs)
    arrays = passages._arrays(*(group[c] for c in ("words", "heads", "ours", "theirs")))
    known = passages.Partner(" ".join(theirs).encode())
    done, spans = passages.settled(known, *arrays)
    assert len(done) > 100 and done.all()
    assert set(map(tuple, spans.tolist())) == {(120, 120 + k) for k in range(50, 61)} | {(180 - k, 180) for k in range(50, 61)}
    assert passages._maximal(set(map(tuple, spans.tolist()))) == [(120, 180)]
    assert set(map(tuple, spans.tolist())) == aligned_alone(known, passages._cut(*arrays, np.ones(len(done), dtype=bool)))
    # Another run of the word in the partner: what lies beyond the block can match it.
    more = theirs + ["w"] * 30
    done, _ = passages.settled(passages.Partner(" ".join(more).encode()), *arrays)
    assert not done.all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(1, 20)), max_size=12))
def test_spans_in_others_change_no_cover(spans):
    """As ``_fewest`` takes them, of all spans or of those that are in no other."""

    def fewest(all_spans):
        done = []
        for s in sorted(all_spans):
            if done and s[1] <= done[-1][1]:
                continue
            if done and (s[0] == done[-1][0] or len(done) > 1 and s[0] <= done[-2][1]):
                done[-1] = s
            else:
                done.append(s)
        return done

    spans = {(a, a + n) for a, n in spans}
    assert fewest(passages._maximal(spans)) == fewest(spans)
