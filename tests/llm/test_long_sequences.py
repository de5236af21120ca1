"""Token counts of texts without blanks against the library."""

import base64
import random
import time

import public_tokenizers
import pytest
import sentencepiece

from adtally.llm import tokencount

PATH = public_tokenizers.path("piece_bpe_32k.model")
draw = random.Random(11)


@pytest.mark.parametrize("text", [
    base64.b64encode(draw.randbytes(40_000)).decode(), "".join(draw.choices("abcdefghij", k=30_000)), "a" * 20_000,
    "ab" * 9_999 + "a", "".join(draw.choices("aé漢😀\x00", k=8_000)), "=" * 777, "x" * 401,
    "".join(draw.choices(["the", "ing", "tion", "er", "\n"], k=6_000)) + " and more"])
def test_counts_equal_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    known = tokencount.model(PATH)
    began = time.process_time()
    assert int(known.counts(known.pre_tokens(text)).sum()) == len(library.encode(text))
    assert time.process_time() - began < 10


def test_many_sequences_around_the_limit():
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    known = tokencount.model(PATH)
    words = ["▁" + "".join(draw.choices("abcdeorst", k=draw.randrange(380, 430))) for _ in range(60)]
    wanted = [len(library.encode(w[1:])) for w in words]
    assert known.counts(words).tolist() == wanted


def test_a_megabyte_without_blanks():
    known = tokencount.model(PATH)
    text = base64.b64encode(draw.randbytes(750_000)).decode()
    began = time.process_time()
    known.counts(known.pre_tokens(text))
    assert time.process_time() - began < 30
