import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from mercato.llm import tokens
from mercato.llm.codec import Codec
from mercato.llm.queries import VOCABULARY
from mercato.llm.tokens import token_counts
from tests.llm.helpers import documents, gathered


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def random_texts(seed, n):
    rng = random.Random(seed)
    odd = [*"abcZ éñüß'stlm.,!?01²½ªº¡ÿ\n\t  漢字\x0b\x1c\x85…", "<|endoftext|>", "'s", "'ll", "  ", " \n", "the "]
    plain = [*"abcZ éñüß'stlm.,!?01\n ", "the ", "don't "]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 40))) for a in (odd, plain) for _ in range(n)]
    return [*texts, "a" * 30_000, " " * 2_000, "ab " * 500, None, "", "<|endoftext|>"]


def test_codec_gives_the_library_s_ids(library):
    texts = random_texts(1, 3_000)
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in Codec(VOCABULARY).encode(texts)] == expected
    assert Codec(VOCABULARY).count(texts) == [len(ids) for ids in expected]


def test_a_full_cache_starts_afresh(library, monkeypatch):
    monkeypatch.setattr("mercato.llm.codec.KEPT_CHARS", 50)
    coder = Codec(VOCABULARY)
    for text in random_texts(2, 20):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == ids


@pytest.mark.parametrize("spans", [2, 1 << 16])
def test_counts_of_awkward_rows(spark, library, monkeypatch, spans):
    """Null key, null, empty, very long and repeated texts; other columns may have any name."""
    monkeypatch.setattr(tokens, "TABLE_SPANS", spans)
    rows = [(i, t) for i, t in enumerate(random_texts(3, 40))]
    rows += [(None, "no key here"), (1, "same row"), (1, "same row"), (9, "word " * 600)]
    found = token_counts(documents(spark, rows, "n_tokens N_BYTES").repartition(3), VOCABULARY)
    counts = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    expected = [(i, len((t or "").encode()), n, n > 512) for (i, t), n in zip(rows, counts)]
    assert gathered(found) == sorted(expected, key=repr)


def test_nothing_to_count(spark):
    assert token_counts(documents(spark, []), VOCABULARY).count() == 0
    assert token_counts(documents(spark, [(1, None)]), VOCABULARY).collect()[0].n_tokens == 0
