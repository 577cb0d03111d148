"""Texts that the tests of the training-data operators share."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    pick = random.Random(seed)
    return " ".join(f"x{seed}_{i}" if pick.random() < share else w for i, w in enumerate(text.split(" ")))


# Missing and blank texts, one word, odd white space, other scripts, a very long text.
EDGE = [None, "", "  \n\t ", "word", "Word", "two words", "  a\x0bb \x0c c\r\nd\n\na ", "é ß 日本語 テスト 😀 a b",
        "x" * 5000, "na " * 3000, "#*$%&|<> ##\n##\n##\n a", prose(9, 20000, 50)]

# Strings that the tokenizers take for special tokens, and near misses.
SPECIAL = ["a <|endoftext|> b", "<|startoftext|>a.<|endoftext|>, b", "x<|endoftext|>y  <|endoftext|>", "<|ENDOFTEXT|> a",
           "a  <|endoftext|>\n\n<|startoftext|>  z", "<|end of text|> <|endoftext", "!<|endoftext|>!! é<|endoftext|>é"]
