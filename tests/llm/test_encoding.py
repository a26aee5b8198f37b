import random

import numpy as np
import pytest

from assocframe.llm.encoding import TextEncoder, vocabulary

PIECES = [
    "a", "B", " ", "  ", "\n", "\t", "\r", "'", "'s", "'t", "é", "É", "Σ", "ς", "1", "²", "_", "-", "!", " ", " ", "\x1c",
    "\x1f", "\x85", "̀", "ñ", "<|endoftext|>", "<|startoftext|>", "ABC ", "the", "'ll", "中", "​", "ⅷ", "İ", "ß",
    "\x0b", "\x0c", "\x00", "…", "“", "　", " ", "😀", "***", "%%%",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_by_word_is_the_whole_text(name, docs):
    encoder = TextEncoder(vocabulary(name))
    rng = random.Random(11)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(14))) for _ in range(8000)]
    texts += [r["text"] for r in docs.select("text").collect()]
    whole = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, want in zip(texts, whole, strict=True):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want.ids, repr(text)
    assert encoder.encode(None) == encoder.encode("") == b""
