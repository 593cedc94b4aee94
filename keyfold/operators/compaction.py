"""Which pieces of a change log are merged into one.

A log is a row of pieces in the order of their commits: single commits (level 0)
and runs, each made from neighbours of one level. As soon as ``fanout`` pieces of
a level stand together they become one of the next level, so a row of the log is
rewritten at most once per level, and there are about log(commits) levels,
however large the table is. Only pieces with the same columns are merged: in a
merged row every column then comes from the same change.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Piece:
    """A log commit or a run of commits ``lo`` to ``hi``."""

    lo: int
    hi: int
    level: int
    size: int
    columns: frozenset[str]


def stretches(pieces: Sequence[Piece], largest: int) -> Iterator[list[Piece]]:
    """Neighbours of one level and the same columns; pieces of ``largest`` bytes or more stay alone."""
    held: list[Piece] = []
    for piece in sorted(pieces, key=lambda p: p.lo):
        fits = piece.size < largest
        if held and (not fits or (piece.level, piece.columns) != (held[-1].level, held[-1].columns)):
            yield held
            held = []
        if fits:
            held.append(piece)
    if held:
        yield held


def plan_merges(pieces: Sequence[Piece], *, fanout: int = 4, largest: int = 4 << 30) -> list[list[Piece]]:
    """Groups to merge now: ``fanout`` neighbours of a level at a time, the lowest level first.

    A stretch that is shorter waits for more, unless larger pieces on both sides
    keep it from growing: then a higher level would never see it, and it is merged
    as it is. Merges of one level may make the next one possible: ask again.
    """
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    found = list(stretches(pieces, largest))
    groups: list[list[Piece]] = []
    for i, held in enumerate(found):
        groups += [held[a:a + fanout] for a in range(0, len(held) - fanout + 1, fanout)]
        rest = held[len(held) // fanout * fanout:]
        enclosed = 0 < i < len(found) - 1 and min(found[i - 1][-1].level, found[i + 1][0].level) > held[0].level
        if len(rest) > 1 and enclosed:
            groups.append(rest)
    if not groups:
        return []
    lowest = min(g[0].level for g in groups)
    return [g for g in groups if g[0].level == lowest]
