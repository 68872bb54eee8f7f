"""Packing token sequences by minimum bin slack.

Documents are tokenised and cut into pieces of at most a sequence's length. Packing depends on
lengths only, and there are at most as many lengths as a sequence has tokens; so the histogram of
lengths is all the planner sees, whatever the size of the corpus. For each bin it takes the longest
length left and finds the fullest feasible combination with a subset-sum over bitsets. A combination
is removed as often as the counts allow before the next one is searched: the same bins one at a time
would give. The plan says which ranks of a length go to which sequences; executors rank the pieces
of a length in blocks and look their place up.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.columns import ranked
from tradewind.session import stored

END_ID = 2
PIECES_TYPE = "array<struct<piece: int, start: bigint, length: bigint, ids_crc32: bigint>>"

# Fixed value: how a byte-level vocabulary splits text before merging.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves, the others from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from a text to its ids, equal to the tokenizer file's own.

    A plain byte-level BPE runs through tiktoken, which merges the same vocabulary about four times as
    fast; other kinds, and texts with a special token's string in them, go through the tokenizer itself.
    """
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and not spec.get("normalizer") and split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space") and split.get("use_regex", True) and not model.get("dropout")
        and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
    )

    def slow(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids

    if not plain:
        return slow
    import tiktoken

    alphabet, special = _byte_alphabet(), [t["content"] for t in spec.get("added_tokens", [])]
    merges = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    quick = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=merges, special_tokens={})

    def fast(text: str) -> list[int]:
        return slow(text) if any(s in text for s in special) else quick.encode_ordinary(text)

    return fast


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: whole sequences, and before them the rest."""
    rest = n % capacity
    starts = ([0] if rest else []) + list(range(rest, n, capacity))
    return [(start, min(rest, n) if rest and start == 0 else capacity) for start in starts]


def pieces(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; the ids end with ``END_ID``."""

    @F.arrow_udf(PIECES_TYPE)
    def cut_up(text: pa.Array) -> pa.Array:
        encode = encoder(tokenizer)
        rows = []
        for value in text:
            ids = np.array([*encode(value.as_py() or ""), END_ID], dtype="<u4")
            rows.append([
                {"piece": i, "start": start, "length": length, "ids_crc32": zlib.crc32(ids[start : start + length].tobytes())}
                for i, (start, length) in enumerate(cut(len(ids), capacity))
            ])
        kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))
        return pa.array(rows, type=kind)

    return docs.select("doc_id", F.explode(cut_up("text")).alias("p")).select("doc_id", "p.*")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How often to take each length so that the sum is as near below ``room`` as can be."""
    keep = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], room // length)
        times = 1
        while left > 0 and not sums >> room & 1:
            times = min(times, left)
            steps.append((length, times, sums))
            sums |= (sums << (length * times)) & keep
            left -= times
            times *= 2
    total, taken = sums.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + times
            total -= length * times
    return taken


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of sequences, how often each length is in one of them), for all pieces."""
    left = {length: count for length, count in histogram.items() if count}
    bins = []
    while left:
        longest = max(left)
        others = {length: count - (length == longest) for length, count in left.items()}
        taken = fullest({length: count for length, count in others.items() if count}, capacity - longest)
        taken[longest] = taken.get(longest, 0) + 1
        times = min(left[length] // n for length, n in taken.items())
        bins.append((times, taken))
        for length, n in taken.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return bins


def _places(bins: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows of length, first rank, pieces in a sequence, first sequence, first offset; sorted."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for times, taken in bins:
        offset = 0
        for length, n in sorted(taken.items(), reverse=True):
            rows.append((length, used.get(length, 0), n, sequence, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text counts as empty and gives one piece of one id. Only documents longer than ``capacity``
    ids are cut. Repeated rows are packed as often as they occur; null ids like others. Only ``doc_id``
    and ``text`` are read. No rows give no rows.
    """
    cut_pieces = stored(pieces(docs, tokenizer or default_tokenizer(), capacity))
    # At most one row for each length up to the capacity.
    histogram = {row[0]: row[1] for row in cut_pieces.groupBy("length").count().collect()}
    table = _places(plan(histogram, capacity))
    lengths = {int(length): (int(np.searchsorted(table[:, 0], length)), int(np.searchsorted(table[:, 0], length, "right"))) for length in histogram}

    @F.pandas_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, turn = length.to_numpy(), rank.to_numpy()
        row = np.zeros(len(size), dtype=np.int64)
        for value in np.unique(size):
            low, high = lengths[int(value)]
            mine = size == value
            row[mine] = low + np.searchsorted(table[low:high, 1], turn[mine], "right") - 1
        _, first, each, sequence, offset = table[row].T
        nth = turn - first
        return pd.DataFrame({"sequence_id": sequence + nth // each, "offset": offset + nth % each * size})

    placed = ranked(cut_pieces, "length", ["doc_id", "piece", "ids_crc32"], "rank")
    return placed.withColumn("place", place("length", "rank")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset"
    )
