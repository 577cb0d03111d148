import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from samples import EDGE, SPECIAL
from haulage.llm.tokencounts import Counter, token_counts, vocabulary
from haulage.llm.tokens import Encoder, documents, tokenizer_file

TEXTS = EDGE + ["it's  \n", " \n a b c", "a　 b\x1c c", "tab\there", "<|endoftext|> <s>", "a▁b", "▁", "a\xa0 b  c", "é x"]


@pytest.mark.parametrize("name, spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_give_the_ids_of_whole_texts(name, spaces):
    encoder = Encoder(tokenizer_file(name), spaces)
    pick = random.Random(4)
    texts = TEXTS + SPECIAL + ["".join(pick.choice("ab.' \n\t1\xa0é") for _ in range(30)) for _ in range(300)]
    texts += ["".join(pick.choice(["<|endoftext|>", "<|startoftext|>", " ", "a", ".", "\n", "é", "\t", "<|", "S", ","])
                      for _ in range(12)) for _ in range(3000)]
    column = pa.array(texts)
    whole = encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for part, at in ((column, 0), (column.slice(7, 100), 7), (column.slice(0, 0), 0)):
        got = [x.tolist() for x in documents(encoder, part, 9)]
        assert got == [w.ids + [9] for w in whole[at:at + len(part)]]


def library(pieces):
    least = min(s for _, s in pieces)
    full = [("<unk>", least)] + [(f"<0x{i:02X}>", least) for i in range(256)] + pieces
    tokenizer = Tokenizer(models.Unigram(full, unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always")
    return tokenizer


def test_counts_are_the_librarys(frame, rows):
    file = tokenizer_file("piece_bpe_32k.model")
    pieces = vocabulary(file)
    tokenizer, counter = library(pieces), Counter(pieces)
    assert [counter.text(t) for t in TEXTS] == [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in TEXTS]
    out = {r.doc_id: r.n_tokens for r in token_counts(frame(rows)).select("doc.doc_id", "n_tokens").collect()}
    assert out == {r[0]: len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) for r in rows}


def test_ties_and_unknowns_as_in_the_library():
    pick = random.Random(1)
    for _ in range(200):
        pieces = list({"".join(pick.choice("ab▁c") for _ in range(pick.randint(1, 3))): pick.choice([-1.0, -2.0, -3.0, -1.5])
                       for _ in range(8)}.items())
        counter, tokenizer = Counter(pieces), library(pieces)
        for _ in range(20):
            text = "".join(pick.choice("abcd é") for _ in range(pick.randint(0, 9)))
            assert counter.text(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), (pieces, text)


def test_columns_and_empty_table(frame, clashing, rows):
    out = token_counts(clashing(rows))
    assert out.columns == ["doc", "n_tokens"] and out.count() == len(rows)
    assert token_counts(frame([])).count() == 0
