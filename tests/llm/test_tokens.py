import os
import random

import pytest

from tabkit.llm import tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary")


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer, models, pre_tokenizers

    v = tokens.read_vocabulary(tokens.VOCABULARY)
    t = Tokenizer(models.Unigram(v, unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=tokens.MARK, prepend_scheme="always", split=True)
    return v, t


def samples():
    r = random.Random(3)
    signs = "aeiouthsn .\n▁é日😀\x01ß$\t"
    out = ["", " ", "  a  b ", "\n", "a\x00\x01b", "日本語のテキスト 😀😀x😀", "<0x0A> <unk>", "▁a▁▁b", "x" * 3000, "\t\ta  ", "�ab"]
    return out + ["".join(r.choice(signs) for _ in range(r.randint(0, 50))) for _ in range(800)]


def test_counts_equal_the_tokenizer(both):
    v, t = both
    texts = samples()
    assert tokens.text_counts(texts, tokens.Counter(v)) == [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_counts_without_byte_pieces():
    from tokenizers import Tokenizer, models, pre_tokenizers

    v = [("<unk>", 0.0), (tokens.MARK, -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), (tokens.MARK + "a", -3.0), ("aba", -3.0)]
    t = Tokenizer(models.Unigram(v, unk_id=0, byte_fallback=False))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=tokens.MARK, prepend_scheme="always", split=True)
    r = random.Random(1)
    texts = ["".join(r.choice("abab zé") for _ in range(r.randint(0, 30))) for _ in range(500)]
    assert tokens.text_counts(texts, tokens.Counter(v)) == [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_operator(spark, both):
    v, t = both
    rows = [(i, s) for i, s in enumerate(samples()[:40])] + [(90, None), (None, "no id"), (3, "twice")]
    df = spark.createDataFrame([(i, s, 1) for i, s in rows], "doc_id long, text string, n_tokens int")
    got = sorted((tuple(r) for r in tokens.token_counts(df).collect()), key=str)
    assert got == sorted(((i, len(t.encode(s or "", add_special_tokens=False).ids) if s else 0, len(s or "")) for i, s in rows), key=str)
    assert tokens.token_counts(df.where("1 = 0")).count() == 0
