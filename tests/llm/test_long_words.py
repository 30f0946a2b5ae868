"""Long words in SentencePiece encoding, against the library and step by step merging."""

import random
import time

import public_tokenizers
import pytest
import sentencepiece

from pricetide.llm import sentencepieces

PATH = public_tokenizers.path(sentencepieces.MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def step_by_step(model, word):
    parts = list(word)
    while True:
        pairs = [(-model.score[model.ids[a + b]], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in model.ids]
        if not pairs:
            return [i for p in parts for i in model._single(p)]
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_merge_against_step_by_step():
    model, dice = sentencepieces.Model(PATH), random.Random(3)
    for _ in range(400):
        letters = dice.choice(["ab", "the andior", "aeiounrst", "äßéñ中x", "aaaaab"])
        word = "▁" + "".join(dice.choice(letters.replace(" ", "▁")) for _ in range(dice.randrange(1, 60)))
        assert model.merge(word) == step_by_step(model, word)
    assert model.merge("") == []


@pytest.mark.parametrize("size", [500, 511, 512, 513, 2000, 20000])
@pytest.mark.parametrize("letters", ["a", "ab", "etaoinshrdlu", "abc中\U0001f600é"])
def test_long_words_against_the_library(library, size, letters):
    model, dice = sentencepieces.Model(PATH), random.Random(size)
    texts = ["".join(dice.choice(letters) for _ in range(size)), "x " + "".join(dice.choice(letters) for _ in range(size)) + "  y"]
    ids, counts = model.encode(texts)
    own = ids.tolist()
    assert own[: counts[0]] == library.encode(texts[0]) and own[counts[0] :] == library.encode(texts[1])
    assert model.decode(ids, counts) == texts


def test_a_word_of_200000_letters():
    model, dice = sentencepieces.Model(PATH), random.Random(1)
    text = "".join(dice.choice("etaoinshrdlu") for _ in range(200000))
    start = time.perf_counter()
    ids, counts = model.encode([text])
    assert time.perf_counter() - start < 30 and counts[0] == len(ids) > 1000
