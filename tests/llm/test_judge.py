"""Scoring by one scan of a span of texts: what is passed over can bear no feature."""

import random
import re
import unicodedata

import numpy as np
import pytest

from tillstream.llm import toxic
from tillstream.llm.toxic import Judge, Language, Model, Sought, plain_form

SIGNS = list("013468!|+(@$*#.,:;?&%)-_\"'~^/\\<>=[]{}\x00") + list("éñßΣςİıª²½€£¡—“…ｇ０が́​")
BLANKS = list(" \n\t\x1c\x85\xa0　")
WORDS = (
    "grobnik grrobnik gr0bn1k grobnikov idiot idiots, (idiot) \"idiot!\" !\"idiot idiiiot i.d.i.o.t "
    "aaa ssnake éclair ñandu ΑΣ hello the a of x no, (it) 'on' 123 -- don't disgusting"
).split() + ["g r o b n i k", "gr ob nik", "i d i o t.", "é c l a", "a a a", "s s n", "中か", "가", "😀"]
NAMES = ["grobnik", "grob~", "idiot", "aaa", "ss", "ñandu", "éclai~", "a", "ab", "中か", "niko"]


def language() -> Language:
    text = " ".join(["grobnik idiot hello the of snake no it on don"] * 20)
    s = toxic._symbols(f" {text} ", toxic.symbols_of())
    code = (s[:-2] * toxic.SYMBOLS + s[1:-1]) * toxic.SYMBOLS + s[2:]
    seen, n = np.unique(code, return_counts=True)
    return Language.fitted(seen, n)


def one_by_one(text: str, model: Model) -> float:
    """The score with every word, and every passage that can hold a feature, decoded."""
    words, found = text.lower().split(), set()
    for word in set(words):
        found.update(plain_form(word, model.language).split())
    marks = "".join("s" if toxic._short(w) else "." for w in words)
    for run in re.finditer("ss+", marks):
        around = words[max(0, run.start() - 1) : run.end() + 1]
        passage = unicodedata.normalize("NFKC", " ".join(around))
        if Sought(model.chance).search(passage) and toxic._WORDY(passage):
            found.update(model.language.restored(passage).split())
    return model.score(found)


def made_up(dice: random.Random) -> str:
    words = []
    for _ in range(dice.randint(0, 14)):
        word = list(dice.choice(WORDS))
        for _ in range(dice.choice([0, 0, 0, 1, 2])):
            word.insert(dice.randint(0, len(word)), dice.choice(SIGNS))
        words.append("".join(word))
    text = dice.choice(BLANKS).join(words)
    return text if dice.random() < 0.8 else text.upper()


@pytest.mark.parametrize("span", [1, 60, 1 << 18])
def test_the_scan_scores_as_one_by_one(monkeypatch, span):
    monkeypatch.setattr(toxic, "SCAN_CHARS", span)
    dice, spoken, judged = random.Random(7), language(), 0
    for size in (0, 1, 2, 3, 5, len(NAMES)):
        model = Model(spoken, {f: dice.uniform(0.2, 0.9) for f in dice.sample(NAMES, size)}, 0.1)
        texts = [made_up(dice) for _ in range(80)]
        expected = [one_by_one(t, model) for t in texts]
        assert Judge(model).scores(texts) == pytest.approx(expected, abs=1e-12)
        judged += sum(score > 0.11 for score in expected)
    assert judged > 50


def test_a_long_text_is_cut_where_no_passage_is(monkeypatch):
    monkeypatch.setattr(toxic, "SCAN_CHARS", 100)
    passage = "a b " * 40
    text = "g r o b n i k disgusting\t" * 9 + passage + "everlasting " + "x" * 300 + " i d"
    pieces = list(toxic._pieces(text))
    assert len(pieces) > 2 and any(f"disgusting\t{passage}everlasting" in p for p in pieces)
    assert all(p.endswith(("disgusting", "everlasting", "x")) for p in pieces[:-1])
    model = Model(language(), {"grobnik": 0.9, "idiot": 0.5}, 0.1)
    assert Judge(model).scores([text, ""]) == pytest.approx([one_by_one(text, model), 0.1])


def test_plain_words_and_passages_are_not_visited(monkeypatch):
    visited = []

    def counted(word, spoken):
        visited.append(word)
        return plain_form(word, spoken)

    monkeypatch.setattr(toxic, "plain_form", counted)
    monkeypatch.setattr(Sought, "search", lambda sought, run: visited.append(run))
    judge = Judge(Model(language(), {"grobnik": 0.9, "idiot": 0.9}, 0.1))
    plain = "The cat (it is) \"on\" a mat, and 222 -- of über them all; so: no. " * 300
    low, high = judge.scores([plain, plain + "without gr0bnik"])
    assert visited == ["gr0bnik"]
    assert low == pytest.approx(0.1) and high > 0.9


def test_kinds_of_code_points():
    kinds, edge = toxic.kinds_of(), toxic._EDGES
    for code in [*range(0x3100), *range(0xAC00, 0xAD00), *range(0xD7A0, 0xD800), 0x1F600, 0x10FFFF]:
        c = chr(code)
        assert bool(kinds[code] & toxic.BLANK) == c.isspace() == (not c.split())
        if not c.isspace():
            assert bool(kinds[code] & toxic.EDGE) == (not edge.sub("", c))
        if kinds[code] & toxic.LETTER:
            assert c.isalpha()
            for before in "aé가":
                assert unicodedata.normalize("NFKC", before + c) == before + c
