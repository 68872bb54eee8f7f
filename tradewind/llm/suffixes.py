"""Repeated strings across documents, from suffix arrays built by linear grouping.

Which 50-byte strings of a document also start in a document with a smaller id? Every window of 50
bytes holds an anchor, the 16-byte string with the smallest hash in it, and equal windows have equal
anchors. So windows can be compared anchor by anchor, wherever they are:

1. Chunks send the hashes of their distinct anchors; what occurs in one document only is left alone.
2. For the others they send the anchor's surroundings (the windows it is the anchor of) once per chunk, with
   the smallest document id there. In a bucket, surroundings of an anchor that are all alike belong
   to the smallest id; those that differ go into one string, whose suffix array brings equal windows
   together, and the smallest id of each run of equal windows counts.
3. Chunks get back, for each kind of surroundings, which windows occur in a smaller document, and
   cover their bytes.

The suffix array is built in two linear phases (see ``suffix_array``) without recursion or renaming.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import chunks as C
from tradewind.llm.tokens import mix
from tradewind.session import stored

LENGTH = 50
GRAM = 16
REACH = LENGTH - GRAM  # bytes on either side of an anchor that its windows reach
AROUND = REACH + LENGTH
BLOCK = 12  # bytes that are one symbol of the sorted text
OUTSIDE = 0xFF  # never a byte of UTF-8
#: Bytes that one suffix array is built over, at least one anchor's; more would only need more memory.
SORT_BYTES = 1 << 19

_LOW48 = np.uint64(2**48 - 1)
_TOP = np.uint64(0xFFFFFFFF00000000)
_BOTTOM = np.uint64(0xFFFFFFFF)
_SALT = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 16


def suffix_array(symbols: list[int]) -> list[int]:
    """The order of all suffixes of ``symbols`` (small non-negative integers).

    First suffixes are grouped by their first symbol. Groups are then processed in descending order. Each
    suffix of a group points to the nearest suffix on its left in a smaller group; those pointed at are
    split off behind the rest of their groups, the more pointers the later. In the end suffixes in a group have the
    same Lyndon prefix. Then one pass in ascending order emits them: behind a placed suffix, the chain of
    pointers from its left neighbour holds just those whose Lyndon prefix ends there.
    """
    text = [s + 1 for s in symbols]
    text.append(0)
    n = len(text)
    heads = [0] * (max(text) + 2)
    for s in text:
        heads[s + 1] += 1
    for s in range(1, len(heads)):
        heads[s] += heads[s - 1]
    start = [heads[s] for s in text]  # where a suffix's group begins
    size = [0] * n
    order, place = [0] * n, [0] * n
    for i, s in enumerate(start):
        k = s + size[s]
        order[k], place[i] = i, k
        size[s] += 1
    smaller = [-1] * n

    end = n
    while end:
        begin = start[order[end - 1]]
        pointers: dict[int, int] = {}
        members = order[begin:end]
        if end - begin > 1:
            members.sort()
        for i in members:
            p = i - 1
            while p >= 0 and start[p] >= begin:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                pointers[p] = pointers.get(p, 0) + 1
        most = max(pointers.values()) if pointers else 0
        for times in range(most, 0, -1):
            moved: dict[int, int] = {}
            for p, count in pointers.items():
                if count == times:
                    s = start[p]
                    left = size[s] - 1
                    last, at = s + left, place[p]
                    other = order[last]
                    order[at], place[other] = other, at
                    order[last], place[p] = p, last
                    size[s] = left
                    moved[s] = moved.get(s, 0) + 1
            for s, count in moved.items():
                new = s + size[s]
                size[new] = count
                if new != s:
                    for p in order[new : new + count]:
                        start[p] = new
        end = begin

    out = [-1] * n
    out[0] = n - 1
    free = list(range(n))
    waiting = [True] * n
    waiting[n - 1] = False
    for i in range(n):
        p = out[i] - 1
        while p >= 0 and waiting[p]:
            s = start[p]
            k = free[s]
            free[s] = k + 1
            out[k] = p
            waiting[p] = False
            p = smaller[p]
    return out[1:]


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from every position on."""
    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    n = len(data) - GRAM + 1
    out = eight[:n] * _SALT
    out += eight[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out


def _anchors_of(data: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window in ``data``, which begins at ``at`` in its chunk, and the gram hashes."""
    grams = _grams(data)
    keys = grams & _TOP
    keys |= np.arange(at, at + len(grams), dtype=np.uint64)
    span = 1
    while span * 2 <= REACH + 1:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    rest = REACH + 1 - span
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) & _BOTTOM, grams


def anchors(chunk: C.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where each window of ``LENGTH`` bytes inside a text starts, and which anchor it has; the anchors and their hashes.

    The anchor has the smallest 32 top bits, the leftmost of equal ones.
    """
    data = chunk.data
    none = np.empty(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(np.uint64)
    # In pieces that fit a core's cache.
    found, hashed = [], []
    for at in range(0, len(data) - LENGTH + 1, _PIECE):
        near, grams = _anchors_of(data[at : at + _PIECE + LENGTH - 1], at)
        found.append(near)
        hashed.append(grams[:_PIECE] if at + _PIECE < len(data) - LENGTH + 1 else grams)
    every, grams = np.concatenate(found).astype(np.int64), np.concatenate(hashed)
    sizes = np.diff(chunk.begins) - 1
    counts = np.maximum(sizes - LENGTH + 1, 0)
    starts = np.repeat(chunk.begins[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
    at = every[starts]
    # Windows are in order of place, and so are their anchors.
    new = np.concatenate(([True], at[1:] != at[:-1])) if len(at) else np.empty(0, dtype=bool)
    places = at[new]
    # Anchors have small hashes; spread them anew.
    return starts, np.cumsum(new) - 1, places, mix(grams[places] + _SALT)


def _owners(chunk: C.Chunk, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(chunk.begins, at, "right") - 1


def _blob_rows(bucket: np.ndarray, buckets: int, make) -> Iterator[tuple[int, bytes]]:
    """(bucket, make(slice)) for each bucket that occurs in the ascending array ``bucket``."""
    bounds = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(bounds)):
        yield int(b), make(slice(bounds[b], bounds[b + 1]))


_SENT = "bucket int, chunk bigint, sent binary"
_SENT_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("sent", pa.binary())])
_ANSWER = "bucket int, chunk bigint, answer binary"
_ANSWER_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("answer", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def _short_keys(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (bucket, low 48 bits) of the hashes, ascending, and the rank of each hash among them."""
    bucket = C.bucket_of(hashes, buckets)
    order = np.lexsort((hashes & _LOW48, bucket))
    b, low = bucket[order], (hashes & _LOW48)[order]
    new = np.concatenate(([True], (b[1:] != b[:-1]) | (low[1:] != low[:-1]))) if len(order) else np.empty(0, dtype=bool)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new) - 1
    return np.stack((b[new], low[new].astype(np.int64))), rank


def _six(low: np.ndarray) -> bytes:
    return np.ascontiguousarray(low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(blob, dtype=np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _send_anchors(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in C.rows_of(batch):
                chunk = C.opened(row)
                *_, hashes = anchors(chunk)
                (bucket, low), _ = _short_keys(hashes, buckets)
                yield _table([(b, chunk.chunk, _six(low[s])) for b, s in _blob_rows(bucket, buckets, lambda s: s)], _SENT_ARROW)

    return send


def _common(table: pa.Table) -> pa.Table:
    """Which keys of each chunk other chunks have too, as bits in the order of the keys."""
    keys = [_from_six(sent) for sent in table.column("sent").to_pylist()]
    every = np.sort(np.concatenate(keys))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    rows = []
    for bucket, chunk, own in zip(table.column("bucket").to_pylist(), table.column("chunk").to_pylist(), keys):
        at = np.minimum(np.searchsorted(twice, own), max(len(twice) - 1, 0))
        flags = twice[at] == own if len(twice) else np.zeros(len(own), dtype=bool)
        if flags.any():
            rows.append((bucket, chunk, np.packbits(flags).tobytes()))
    return pa.Table.from_batches([_table(rows, _ANSWER_ARROW)])


def _surroundings(chunk: C.Chunk, places: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of ``AROUND`` bytes round each anchor; those that no window of the anchor has are ``OUTSIDE``."""
    at = places[:, None] + np.arange(-REACH, LENGTH)[None, :]
    inside = (at >= begins[:, None]) & (at < ends[:, None])
    return np.where(inside, chunk.data[np.clip(at, 0, len(chunk.data) - 1)], np.uint8(OUTSIDE))


def _row_hash(around: np.ndarray) -> np.ndarray:
    width = -(-AROUND // 8) * 8
    wide = np.zeros((len(around), width), dtype=np.uint8)
    wide[:, :AROUND] = around
    total = np.zeros(len(around), dtype=np.uint64)
    for piece in wide.view("<u8").T:
        total = mix(total + piece + _SALT)
    return total


@np.errstate(over="ignore")
def _kinds(chunk: C.Chunk, answers: dict[int, bytes], first_buckets: int) -> tuple:
    """Windows, anchors, and the kinds of surroundings that other documents may share.

    Returns the start of each window, the number of its anchor, the kind of each anchor (-1: not shared), the
    places of the anchors, and per kind: hash, one anchor with its reach, smallest document; kinds are sorted by hash.
    """
    starts, nth, places, hashes = anchors(chunk)
    (bucket, _), rank = _short_keys(hashes, first_buckets)
    owner = _owners(chunk, places)
    shared = np.zeros(bucket.size, dtype=bool)
    bounds = np.searchsorted(bucket, np.arange(first_buckets + 1))
    for b, bits in answers.items():
        low, high = bounds[b], bounds[b + 1]
        shared[low:high] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=high - low).astype(bool)
    # In this chunk: keys that more than one text has.
    least, most = np.full(bucket.size, len(chunk.ids)), np.full(bucket.size, -1)
    np.minimum.at(least, rank, owner)
    np.maximum.at(most, rank, owner)
    use = (shared | (least < most))[rank]
    kind = np.full(len(places), -1, dtype=np.int64)
    if not use.any():
        empty = np.empty(0, dtype=np.int64)
        return starts, nth, kind, places, empty.astype(np.uint64), np.empty((3, 0), dtype=np.int64), empty
    # The bytes that an anchor's windows reach, from the first to the last.
    first = np.flatnonzero(np.concatenate(([True], nth[1:] != nth[:-1])))[use]
    last = np.flatnonzero(np.concatenate((nth[1:] != nth[:-1], [True])))[use]
    reach = np.stack((places[use], starts[first], starts[last] + LENGTH))
    told = np.concatenate([_row_hash(_surroundings(chunk, *reach[:, i : i + 20_000])) for i in range(0, reach.shape[1], 20_000)])
    own = hashes[use]
    order = np.lexsort((told, own))
    new = np.concatenate(([True], (own[order][1:] != own[order][:-1]) | (told[order][1:] != told[order][:-1])))
    numbers = np.empty(len(order), dtype=np.int64)
    numbers[order] = np.cumsum(new) - 1
    kind[use] = numbers
    smallest = np.full(int(new.sum()), C.NO_ID)
    np.minimum.at(smallest, numbers, chunk.ids[owner[use]])
    return starts, nth, kind, places, own[order][new], reach[:, order[new]], smallest


def _kinds_blob(first: int, docs: np.ndarray, around: np.ndarray) -> bytes:
    """Kinds ``first``, ``first`` + 1, ... of a chunk, with the smallest document and the bytes of each."""
    return C.packed(first.to_bytes(8, "little") + docs.astype("<i8").tobytes() + around.tobytes(), level=4)


def _from_kinds_blob(blob: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    held = C.unpacked(blob)
    n = (len(held) - 8) // (8 + AROUND)
    docs = np.frombuffer(held, dtype="<i8", count=n, offset=8)
    around = np.frombuffer(held, dtype=np.uint8, offset=8 + 8 * n).reshape(n, AROUND)
    return int.from_bytes(held[:8], "little"), docs, around


def _send_kinds(first_buckets: int, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in C.rows_of(batch):
                chunk = C.opened(row)
                *_, hashes, reach, smallest = _kinds(chunk, C.answers_of(row), first_buckets)

                def blob(s: slice) -> bytes:
                    return _kinds_blob(int(s.start), smallest[s], _surroundings(chunk, *reach[:, s]))

                yield _table([(b, chunk.chunk, x) for b, x in _blob_rows(C.bucket_of(hashes, buckets), buckets, blob)], _SENT_ARROW)

    return send


def smallest_of_windows(around: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each row of surroundings and each window in it, the smallest document of an equal window.

    Windows that reach outside the text get ``NO_ID``. Equal windows have the same place round their
    anchor. So the sorted text is made of blocks of ``BLOCK`` bytes, counted from the same place in every row:
    a window's whole blocks are a prefix of a suffix, neighbours in the suffix array tell which are equal, and
    the few bytes before and behind the blocks are compared directly.
    """
    n, width = len(around), AROUND // BLOCK
    blocks = np.ascontiguousarray(around).reshape(-1).view(f"V{BLOCK}")
    names = np.unique(blocks.view(f"S{BLOCK}"), return_inverse=True)[1].reshape(n, width) + 1
    text = np.zeros((n, width + 1), dtype=np.int64)
    text[:, :width] = names
    suffixes = np.array(suffix_array(text.ravel().tolist()), dtype=np.int64)
    row, block = np.divmod(suffixes, width + 1)
    by_block = [row[block == k] for k in range(width)]
    inside = around != OUTSIDE
    out = np.full((n, REACH + 1), C.NO_ID)
    for offset in range(REACH + 1):
        first, last = -(-offset // BLOCK), (offset + LENGTH) // BLOCK
        rows = by_block[first]
        rows = rows[inside[rows, offset] & inside[rows, offset + LENGTH - 1]]
        if not len(rows):
            continue
        own = names[rows, first:last]
        run = np.cumsum(np.concatenate(([True], (own[1:] != own[:-1]).any(axis=1))))
        rest = np.zeros((len(rows), 24), dtype=np.uint8)
        head = around[rows, offset : first * BLOCK]
        tail = around[rows, last * BLOCK : offset + LENGTH]
        rest[:, : head.shape[1]] = head
        rest[:, head.shape[1] : head.shape[1] + tail.shape[1]] = tail
        ends = rest.view("<u8")
        order = np.lexsort((*ends.T, run))
        r, e = run[order], ends[order]
        new = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (e[1:] != e[:-1]).any(axis=1))))
        least = np.minimum.reduceat(docs[rows[order]], new)
        out[rows[order], offset] = np.repeat(least, np.diff(np.append(new, len(rows))))
    return out


def _judge_kinds(table: pa.Table) -> pa.Table:
    """For each kind of a chunk, the windows that a smaller document has, as bits."""
    blobs = [_from_kinds_blob(b) for b in table.column("sent").to_pylist()]
    docs, around = np.concatenate([b[1] for b in blobs]), np.concatenate([b[2] for b in blobs])
    gram = np.ascontiguousarray(around[:, REACH : REACH + GRAM]).view("<u8")
    hashes = mix(mix(gram[:, 0] + _SALT) + gram[:, 1])
    told = _row_hash(around)
    order = np.lexsort((told, hashes))
    h, t = hashes[order], told[order]
    new_anchor = np.concatenate(([True], h[1:] != h[:-1]))
    new_kind = new_anchor | np.concatenate(([True], t[1:] != t[:-1]))
    kind = np.cumsum(new_kind) - 1
    anchor = (np.cumsum(new_anchor) - 1)[new_kind]
    firsts = order[new_kind]
    least = np.minimum.reduceat(docs[order], np.flatnonzero(new_kind))
    several = np.bincount(anchor)[anchor] > 1
    found = np.repeat(least[:, None], REACH + 1, axis=1)
    chosen = np.flatnonzero(several)
    # Whole anchors at a time: equal windows have equal anchors.
    cuts = np.flatnonzero(np.concatenate(([True], anchor[chosen][1:] != anchor[chosen][:-1]))) if len(chosen) else []
    group: list[int] = []
    for low, high in zip(cuts, [*cuts[1:], len(chosen)]):
        group += chosen[low:high].tolist()
        if len(group) * AROUND >= SORT_BYTES or high == len(chosen):
            found[group] = smallest_of_windows(around[firsts[group]], least[group])
            group = []
    bits = (1 << np.arange(REACH + 1, dtype=np.uint64))
    masks = np.empty(len(docs), dtype=np.uint64)
    masks[order] = ((found[kind] < docs[order][:, None]) * bits).sum(axis=1, dtype=np.uint64)
    rows, at = [], 0
    for bucket, chunk, (first, own, _) in zip(table.column("bucket").to_pylist(), table.column("chunk").to_pylist(), blobs):
        own, kinds = masks[at : at + len(own)], np.arange(first, first + len(own))
        at += len(own)
        some = own != 0
        if some.any():
            rows.append((bucket, chunk, C.packed(kinds[some].astype("<i4").tobytes() + own[some].astype("<u8").tobytes())))
    return pa.Table.from_batches([_table(rows, _ANSWER_ARROW)])


_RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<begin: bigint, end: bigint>>"
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", _SPANS)])


def _covered(chunk: C.Chunk, row: dict, first_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the chunk's runs of bytes that repeated windows cover."""
    starts, nth, kind, places, hashes, _, smallest = _kinds(chunk, C.answers_of({"answers": row["first"]}), first_buckets)
    masks = np.zeros(max(len(hashes), 1), dtype=np.uint64)
    for answer in C.answers_of(row).values():
        told = C.unpacked(answer)
        n = len(told) // 12
        masks[np.frombuffer(told[: 4 * n], dtype="<i4")] = np.frombuffer(told[4 * n :], dtype="<u8")
    own = kind[nth] if len(nth) else nth
    at = np.flatnonzero(own >= 0)
    starts, nth, own = starts[at], nth[at], own[at]
    # A text after the smallest of its chunk repeats that one's surroundings as a whole.
    ids = chunk.ids[_owners(chunk, starts)]
    bit = (starts - places[nth] + REACH).astype(np.uint64)
    hits = starts[(ids > smallest[own]) | ((masks[own] >> bit) & np.uint64(1)).astype(bool)]
    if not len(hits):
        return hits, hits
    # Windows of one text that overlap or touch make one run; texts are a blank apart.
    owner = _owners(chunk, hits)
    cut = np.flatnonzero((hits[1:] > hits[:-1] + LENGTH) | (owner[1:] != owner[:-1]))
    return hits[np.concatenate(([0], cut + 1))], hits[np.concatenate((cut, [len(hits) - 1]))] + LENGTH


def _remove(first_buckets: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in C.rows_of(batch):
                chunk = C.opened(row)
                begins, ends = _covered(chunk, row, first_buckets)
                bounds = np.searchsorted(begins, chunk.begins)
                out = []
                for i, doc_id in enumerate(chunk.id_list()):
                    low, high = int(chunk.begins[i]), int(chunk.begins[i + 1]) - 1
                    spans = list(zip(begins[bounds[i] : bounds[i + 1]].tolist(), ends[bounds[i] : bounds[i + 1]].tolist()))
                    edges = [low, *[x for span in spans for x in span], high]
                    kept = sha256()
                    for a, b in zip(edges[0::2], edges[1::2]):
                        kept.update(chunk.data[a:b].tobytes())
                    out.append((doc_id, high - low, sum(b - a for a, b in spans), len(spans), kept.hexdigest(),
                                [{"begin": a - low, "end": b - low} for a, b in spans]))
                yield _table(out, _RESULT_ARROW)

    return remove


def repeated_strings(docs: DataFrame, chunk_bytes: int = C.CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller
    id. Spans are the maximal removed runs, in bytes. Texts are UTF-8; null counts as empty, and
    shorter texts lose nothing. Rows with the same id never remove from each other; a null id counts as
    larger than all others. Only ``doc_id`` and ``text`` are read. No rows give no rows.
    """
    table = C.chunked(docs, chunk_bytes)
    first = C.bucket_count(table, 0.34)
    second = C.bucket_count(table, 1.2)
    sent = table.mapInArrow(_send_anchors(first), _SENT)
    common = stored(C.dealt(sent, first).groupBy("bucket").applyInArrow(_common, _ANSWER))
    # Both later passes read the chunks with these answers; the shuffle of the chunks serves both.
    known = C.answered(table, common)
    kinds = known.mapInArrow(_send_kinds(first, second), _SENT)
    judged = C.dealt(kinds, second).groupBy("bucket").applyInArrow(_judge_kinds, _ANSWER)
    final = C.answered(known.withColumnRenamed("answers", "first"), judged)
    return final.mapInArrow(_remove(first), _RESULT)
