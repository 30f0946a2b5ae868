"""Pieces of text are encoded many at a time, with the ids that whole texts get."""

import cProfile
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from pricetide.llm import token_files
from tests.llm.test_operators import prose

ALPHABET = "\x01 . ,  \n\t  \x1c\x85ab'sé1_<|>中 \U0001f600"


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch(texts, **options)

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def pieces():
    return token_files.Pieces(public_tokenizers.path(token_files.TOKENIZER), 2)


def ids(tokenizer, texts):
    return [e.ids + [2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_pieces_have_the_ids_of_whole_texts():
    rng, coded = random.Random(6), pieces()
    texts = ["", " ", "a. b, c.d", "x\n y. \n z", "a  b", "<|endoftext|> a b", "a b. " * 400, "\x01. a", "a \x01. b"]
    texts += ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += [prose(rng, 200) for _ in range(20)]
    expected = ids(coded.tokenizer, texts)
    for lo, hi in ((0, 9), (9, 1000), (900, len(texts)), (0, len(texts))):
        found, size = coded.encode(texts[lo:hi])
        assert [x.tolist() for x in np.split(found, np.cumsum(size)[:-1])] == expected[lo:hi]


def test_new_pieces_are_encoded_together():
    rng, coded = random.Random(7), pieces()
    words = ["".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(5000)]
    coded.tokenizer = Counted(coded.tokenizer)
    coded.encode(["start " + " ".join(words), "start " + ", ".join(words) + "."])
    assert coded.tokenizer.texts < 20


def test_bytes_that_the_vocabulary_lacks():
    """Tokens then do not add up to the bytes of the pieces, and the pieces are encoded one by one."""
    coded, texts = pieces(), ["one two three four", "two five"]
    expected = ids(coded.tokenizer, texts)
    coded.width = coded.width + 1
    assert coded.encode(texts)[0].tolist() == [i for e in expected for i in e]


def test_new_pieces_take_no_call_each():
    """Pieces are judged, joined and measured by the block; only the library sees each of them."""
    rng, coded = random.Random(8), pieces()
    text = "start " + " ".join("".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(5000))
    profile = cProfile.Profile()
    profile.runcall(coded.encode, [text])
    assert sum(entry.callcount for entry in profile.getstats()) < 5000


def test_white_space_is_that_of_python():
    signs = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    found = pc.match_substring_regex(pa.array(signs), token_files._SPACE).to_pylist()
    assert [c for c, white in zip(signs, found) if white] == [c for c in signs if re.search(r"\s", c)]
