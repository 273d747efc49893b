"""Words met for the first time are encoded many at a time."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexiform.llm import forced_boundary


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("broken", [False, True])
def test_new_words_are_encoded_together(name, broken):
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        vocabulary = file.read()
    plain = Tokenizer.from_str(vocabulary)
    codec = forced_boundary.FragmentCodec(vocabulary)
    letters = np.array(list("abcdefgXYZ"))
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(letters, rng.integers(1, 14))) for _ in range(900)]
    texts = [
        " ".join(words),
        "\n".join(words[:50]) + "  two  spaces \n\n and　wide, don't <|endoftext|> 3.5 café.",
        " <|startoftext|>abc aB'll été Über naïve; x" + " 中文 " * 3,
        "", " ", " a", "a ",
    ]
    if broken:  # tokens that do not add up to the words: each is encoded alone
        if codec.widths is not None:
            codec.widths = codec.widths + 1
        else:
            codec.closes = ~codec.closes
    codec.tokenizer = Counting(codec.tokenizer)
    expected = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert codec.encode(texts) == expected
    assert (codec.tokenizer.texts < 100) != broken
    codec.tokenizer.texts = 0
    assert codec.encode(texts) == expected  # and remembered
    assert codec.tokenizer.texts < 100


def test_pairs_of_bytes_inside_tokens():
    table = forced_boundary.held_pairs([b"", b"abc", b"d", b"ea"])
    assert {(a, b) for a, b in np.argwhere(table)} == {(97, 98), (98, 99), (101, 97)}
    assert not forced_boundary.held_pairs([b"", b""]).any()
