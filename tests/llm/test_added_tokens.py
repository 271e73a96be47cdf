"""Ids of texts that hold added tokens, against a tokenizer read afresh."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|startoftext|>It's x<|endoftext|>", "A <|ENDOFTEXT|> b", "a <|endoftext b|>", "plain é ½ text", "漢字<|endoftext|>"])
def test_ids_are_those_of_a_plain_call(name, text):
    path = bpe.tokenizer_path(name)
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(bpe.encoder(path).encode(text), "<u4").tolist() == want
