"""Small corpora for the tests: pseudo-random words, and the odd cases every operator must take."""

from __future__ import annotations

import random

WORDS = ["alpha", "beta", "gamma", "delta", "eins", "zwei", "mot", "où", "ça", "niño", "x", "of", "the"]
ODD = [None, "", " ", "\n\n", "\x00", "a", "é́", "漢字 かな", "🙂" * 5, "word " * 3000, "x" * 20_000, "<|endoftext|>", "a 　b\r\n c"]


def prose(rng: random.Random, words: int, vocabulary: int = 4000) -> str:
    return " ".join(f"{rng.choice(WORDS)}{rng.randrange(vocabulary)}" for _ in range(words))


def edited(rng: random.Random, text: str, edits: int) -> str:
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)
