import pytest

from scorewright.llm.levenshtein import FuzzyLexicon
from scorewright.llm.toxicity import _Words, hits_of, learn_terms


@pytest.mark.parametrize("text", ["the idiot's hat", "you/idiot", "idiot-like talk", "stupid—idiot", "<b>idiot</b>", "i.d.i.o.t", "id-iot", "(idiot)",
                                  "snake_idiot"])
def test_words_are_cut_as_they_are_learned(text):
    assert hits_of(text, _Words(FuzzyLexicon(["idiot"]))) == [(0, 0, False)]


def test_each_part_counts_and_scripts_without_blanks():
    assert hits_of("idiot/moron", _Words(FuzzyLexicon(["moron", "idiot"]))) == [(0, 1, False), (0, 0, False)]
    assert hits_of("你好,笨蛋家伙。再见", _Words(FuzzyLexicon(["笨蛋家伙"]))) == [(0, 0, False)]


def test_rare_and_many_terms_are_learned(spark):
    # 500 insults of 10 toxic texts each among 5,000, below 0.5 % of them; clean texts share the other words
    rows = [(1, f"one{i} two{i} insult{'abcdefghij'[i % 500 // 100]}{i % 500} three{i}") for i in range(5000)]
    rows += [(0, f"one{i} two{i} plain{i % 500} three{i}") for i in range(20_000)]
    # a word of 3 toxic texts and no clean one may be chance
    rows += [(1, f"four{i} chance five{i}") for i in range(3)]
    got = learn_terms(spark.createDataFrame(rows, "y int, t string"))
    assert len(got) == 500 and all(w.startswith("insult") for w in got)
