"""Invented texts for the tests of this folder."""

import random


def words(n, seed, letters="abcdefghijklmnop"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))


def prose(n, seed, known=None):
    """Sentences of invented words, with function words."""
    rng = random.Random(seed)
    known = known or ["the", "of", "and", "to", "in", "is"]
    out = []
    while len(out) < n:
        size = rng.randint(4, 12)
        w = [rng.choice(known) if rng.random() < 0.4 else "".join(rng.choice("aeinorstl") for _ in range(rng.randint(3, 9))) for _ in range(size)]
        w[0], w[-1] = w[0].capitalize(), w[-1] + "."
        out += w
    return " ".join(out[:n])


#: Texts that any operator has to bear.
ODD = [None, "", " ", "\n\t", "a", "é", "word", "\U0001F600" * 50, "x" * 30_000, "ab " * 9_000, "'", " 　", "\x00\x01", "A" * 500 + "\n" * 500]
