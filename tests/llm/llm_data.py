"""Documents with the awkward cases that every operator must take."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, label string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """Deterministic words that hardly repeat between seeds."""
    return " ".join(f"{WORDS[(seed * 7 + i * i) % 20]}{seed}x{i}" for i in range(n))


def awkward() -> list[tuple]:
    base = prose(1, 60)
    texts = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),  # exact copy
        (3, base + " tail word", "en", "b"),  # near copy
        (3, base + " tail word", "en", "b"),  # repeated row
        (4, None, "en", None),
        (5, "", None, "b"),
        (6, " \t\n\r ", "fr", "c"),
        (7, "one two", "fr", None),
        (8, "ONE two", "fr", "c"),
        (9, "éèê ñandú Straße 東京 \U0001f600 naïve", "de", "c"),
        (10, prose(2, 30000), "de", "a"),  # very long
        (11, "x" * 5000, "de", "a"),  # one long word
        (None, prose(3, 40), "en", "d"),
        (None, base, None, "d"),
        (12, "nul\0byte a\0 a \x1c\x85\xa0 <|endoftext|> it's", "en", "d"),
        (13, "1234 !!! ...", "en", "d"),  # no letter
        (14, prose(4, 40) + " " + prose(1, 30), "en", "e"),  # shares a passage with document 1
    ]
    return [(i, t, g, s, None if t is None else len(t), 99, "x") for i, t, g, s in texts]
