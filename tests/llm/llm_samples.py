"""Texts for the tests of this folder."""


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))
