import heapq
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from haulage.llm.huffman import Codebook, code_lengths, pack_block, read_tokens, unpack_block, write_tokens
from haulage.llm.shared import Scratch
from samples import SPECIAL
from haulage.llm.tokens import tokenizer_file


def best_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


def limited_cost(counts, longest):
    """By trying all sets of lengths."""
    counts, best = sorted(counts, reverse=True), []

    def go(i, least, room, cost):
        if i == len(counts):
            best.append(cost)
            return
        for n in range(least, longest + 1):
            if room >= 2 ** (longest - n) * 1:
                go(i + 1, n, room - 2 ** (longest - n), cost + n * counts[i])

    go(0, 1, 2**longest, 0)
    return min(best)


@pytest.mark.parametrize("seed", range(10))
def test_lengths_are_optimal(seed):
    pick = np.random.default_rng(seed)
    counts = np.maximum(1, (pick.pareto(0.5, 150) * 5).astype(np.int64))
    lengths = code_lengths(counts, 60)
    assert (counts * lengths).sum() == best_cost(counts.tolist()) and (0.5**lengths).sum() == 1
    few = pick.integers(1, 1000, 7) ** 2
    lengths = code_lengths(few, 4)
    assert lengths.max() <= 4 and (few * lengths).sum() == limited_cost(few.tolist(), 4)
    assert code_lengths(counts, 8).max() <= 8


@pytest.mark.parametrize("size", [1, 2, 3, 500])
def test_blocks_round_trip(size):
    pick = np.random.default_rng(size)
    tokens = pick.zipf(1.2, 5000) % size * 7
    used, counts = np.unique(tokens, return_counts=True)
    book = Codebook(used, code_lengths(counts))
    for n in (1, 255, 256, 257, 5000):
        ids = np.arange(2, dtype="<i8").tobytes()
        data = pack_block(book, ids, b"\0\1", np.array([n, 0], "<u4").tobytes(), tokens[:n])
        got_ids, got_counts, got = unpack_block(book, data)
        assert got_ids.to_pylist() == [0, None] and got_counts.tolist() == [n, 0] and got.tolist() == tokens[:n].tolist()


def test_too_many_tokens_for_the_limit():
    with pytest.raises(ValueError):
        code_lengths(np.ones(5, dtype=np.int64), 2)


def test_files_give_back_every_id(spark, clashing, rows):
    tk = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    rows = rows + [(900 + i, t, "", "", 0) for i, t in enumerate(SPECIAL)]
    rows = rows + [(None, "no id", "", "", 0), (3, "again", "", "", 0), (3, "again", "", "", 0)]
    with Scratch(spark) as tables:
        write_tokens(clashing(rows).repartition(3), tables.folder, block=2000)
        out = sorted(read_tokens(spark, tables.folder).collect(), key=lambda r: r.start)
    expected = sorted((r[0] is not None, r[0] or 0, tk.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows)
    got = [(r.id is not None, r.id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in out]
    assert sorted(got) == expected and [g[:2] for g in got] == sorted(g[:2] for g in got)
    at = 0
    for r in out:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    assert zlib.crc32(out[0].ids) > 0


def test_empty_table(spark, frame):
    with Scratch(spark) as tables:
        write_tokens(frame([]), tables.folder)
        assert read_tokens(spark, tables.folder).count() == 0
