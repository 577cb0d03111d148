import zlib

import numpy as np
from tokenizers import Tokenizer

from haulage.llm.packing import first_fit_decreasing, pack, sequences
from haulage.llm.tokens import tokenizer_file
from samples import SPECIAL


def naive(lengths, size):
    room, bins = [], np.zeros(len(lengths), int)
    for i in np.argsort(-lengths, kind="stable"):
        b = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
        if b == len(room):
            room.append(size)
        room[b] -= lengths[i]
        bins[i] = b
    return bins


def test_tournament_tree_gives_first_fit():
    for seed in range(20):
        pick = np.random.default_rng(seed)
        lengths = pick.integers(1, 101, pick.integers(0, 200))
        bin, offset = first_fit_decreasing(lengths, 100)
        assert bin.tolist() == naive(lengths, 100).tolist()
        for b in set(bin.tolist()):
            own = np.flatnonzero(bin == b)
            own = own[np.argsort(offset[own])]
            assert offset[own].tolist() == (np.cumsum(lengths[own]) - lengths[own]).tolist()


def test_every_id_lies_in_one_piece(clashing, frame, rows):
    rows = rows + [(900 + i, t, "", "", 0) for i, t in enumerate(SPECIAL)]
    tk = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    ids = {r[0]: tk.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in rows}
    placed = pack(clashing(rows)).select("doc.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    out = placed.collect()
    seen, filled = {}, {}
    for r in out:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert len(own) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        seen.setdefault(r.doc_id, []).append((r.start, r.length))
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length, own))
    for id, own in ids.items():
        at = 0
        for start, length in sorted(seen[id]):
            assert start == at
            at += length
        assert at == len(own)
    for parts in filled.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    made = {r.sequence_id: list(r.ids) for r in sequences(frame(rows), placed).collect()}
    for number, parts in filled.items():
        content = [i for _, _, own in sorted(parts) for i in own]
        assert made[number][:len(content)] == content
        full = len(content) & (len(content) - 1) == 0
        assert len(made[number]) == (len(content) if full else 1024)


def test_little_padding_and_small_groups(frame):
    pick = np.random.default_rng(1)
    rows = [(i % 3, "a b " * int(n), "", "", 0) for i, n in enumerate(pick.integers(1, 700, 400))]
    out = pack(frame(rows).repartition(5), group=100).groupBy("sequence_id").sum("length").collect()
    assert len({r.sequence_id >> 32 for r in out}) > 3
    assert sum(r[1] for r in out) > 0.95 * 1024 * len(out)


def test_empty_table(frame):
    assert pack(frame([])).count() == 0
