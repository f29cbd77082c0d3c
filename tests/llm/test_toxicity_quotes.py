import pytest

from scorewright.llm.levenshtein import FuzzyLexicon
from scorewright.llm.toxicity import _Words, hits_of


@pytest.mark.parametrize("text, quoted", [
    ("You’re a moron and you don’t know", False),
    ("c’est un moron et l’autre n’a rien", False),
    ("the dogs’ owner is a moron, isn’t he", False),
    ('So "nice" then you moron "really" there', False),
    ("«bien» toi moron «oui»", False),
    ('a 5" moron with 7" shoes', False),
    ('"open\n\nmoron" far away', False),
    ("They wrote “you’re a moron” on it", True),
    ("‘you’re a moron’ stood there", True),
    ("er rief „du moron“ laut", True),
    ("il cria « moron » fort", True),
    ("er rief »moron« laut", True),
    ("sen ”moron” där", True),
    ('("moron")', True),
    ('They wrote "' + "so " * 12 + "moron " + "so " * 12 + 'on" the wall', True),
])
def test_quoted_is_between_matching_marks(text, quoted):
    assert hits_of(text, _Words(FuzzyLexicon(["moron"]))) == [(0, 0, quoted)]
