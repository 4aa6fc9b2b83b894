"""Syllables of English words by patterns in a trie, in the way Liang's algorithm places hyphens.

A pattern is letters with digits between them; a point stands for the border of a word. Wherever its
letters occur in a word, each digit is a bid for that place, and the highest bid wins. Here an odd bid
marks the vowel that a syllable is built around, so a word has as many syllables as odd places.
"""

from __future__ import annotations

from collections.abc import Iterable

VOWELS = "aeiouy"
CONSONANTS = "bcdfghjklmnpqrstvwxz"
#: Consonants behind which a final -le, -les or -led is a syllable.
BEFORE_LE = "bcdfgkpstz"

# Every vowel may begin a syllable; the second letter of these pairs does not.
PAIRS = "ai au ay ea ee ei eu ey ie oa oe oi oo ou oy ue ui uy ae"
# Vowels that are no syllable although no pair says so, then pairs that are two.
SINGLE = """
.2ya .2ye .2yi .2yo .2yu q2u g2ua c2ia c2io c2iou g2io s2ia s2io t2ia t2io t2iou x2io pe2op ge2ou
.bus2i g2ue. gh2e. m2etim m2ewh m2eon m2ebod m2eth m2eday h2ouse s2ewh r2efore
"""
DOUBLE = """
qu3a qu3e qu3i qu3o qu3y qu4e. qu4es. .cre3a re3al de3a. re3a. ne3a. .di3et qui3et sci3e cli3e i3er.
i3est. i3ety po3e co3ex co3o o3ing. u3ing. y3ing. ru3in flu3i cru3el .du3el flu3en .fu3el rg3ue.
s1m. .th3e. .b3e. .h3e. .m3e. .w3e. .sh3e. el3ement .c3ement cr3e. tr3e. .rec3ipe o3asis na3ive
h3ero v3ideo di3en eri3en ori3en
"""
# Rules: endings whose e is silent behind a consonant (or y), but not behind those that follow.
SILENT = {
    "2e.": "", "2es.": "cgshxz", "2ed.": "dt", "2ely.": "", "2ement": "", "2eful": "", "2eless": "",
    "2eness": "",
}


def patterns() -> list[str]:
    """All patterns: the fixed ones and those that the rules make."""
    made = [f"1{vowel}" for vowel in VOWELS]
    made += [f"{pair[0]}2{pair[1]}" for pair in PAIRS.split()]
    made += SINGLE.split() + DOUBLE.split()
    for ending, sounded in SILENT.items():
        made += [letter + ending for letter in CONSONANTS + "y" if letter not in sounded]
    for ending in (".", "s.", "d."):
        made += [f"{letter}l3e{ending}" for letter in BEFORE_LE]
    return sorted(set(made))


def parsed(pattern: str) -> tuple[str, tuple[int, ...]]:
    """(letters, bid before each letter and behind the last)."""
    letters, bids = "", [0]
    for char in pattern:
        if char.isdigit():
            bids[-1] = int(char)
        else:
            letters += char
            bids.append(0)
    return letters, tuple(bids)


class Trie:
    """Patterns by their letters."""

    def __init__(self, made: Iterable[str]):
        self.root: dict = {}
        for letters, bids in map(parsed, made):
            node = self.root
            for letter in letters:
                node = node.setdefault(letter, {})
            known = node.get("", (0,) * len(bids))
            node[""] = tuple(map(max, known, bids))

    def bids(self, word: str) -> list[int]:
        """The highest bid before each letter of ``.word.`` and behind the last."""
        line = f".{word}."
        best = [0] * (len(line) + 1)
        for start in range(len(line)):
            node = self.root
            for letter in line[start:]:
                if (node := node.get(letter)) is None:
                    break
                for at, bid in enumerate(node.get("", ()), start):
                    if bid > best[at]:
                        best[at] = bid
        return best

    def syllables(self, word: str) -> int:
        """At least one, as digits and lone consonants are spoken too."""
        return max(1, sum(bid % 2 for bid in self.bids(word)))
