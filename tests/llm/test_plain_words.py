"""Plain words go to the model one by one, each of them once."""

import random

import pytest

from plantwise.llm import encoding


@pytest.mark.parametrize("vocab", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_plain_words_by_the_model(vocab, monkeypatch):
    rnd = random.Random(7)
    odd = "aB ñÄß.,!?()<|>'#\n\t09é́Æ µª×İﬁ中ǅ"
    texts = ["".join(rnd.choice(odd) for _ in range(rnd.randint(0, 50))) for _ in range(800)]
    texts += ["<|endoftext|>x", "a<|startoftext|>, b", "x <|endoftext|>. Y", "", "e.g. (this), Über... #1"]
    words = ["".join(rnd.choice("abdeinorstä") for _ in range(6)) + rnd.choice(["", "", ".", ",!"]) for _ in range(4000)]
    texts += [" ".join(rnd.choices(words, k=30)) for _ in range(400)]
    monkeypatch.setattr(encoding, "MEMO_PIECES", 2000)  # memos follow each other
    enc = encoding.Encoder(encoding.vocabulary(vocab))
    got = [ids.tolist() for k in range(0, len(texts), 100) for ids in enc.encode(texts[k:k + 100])]
    assert got == [list(ids) for ids in enc.call(texts)]

    enc = encoding.Encoder(encoding.vocabulary(vocab))
    asked, library, ids = [], [], enc.words.ids
    monkeypatch.setattr(enc.words, "ids", lambda some: asked.extend(some) or ids(some))
    monkeypatch.setattr(enc, "_by_library", lambda some: library.extend(some))
    monkeypatch.setattr(encoding, "MEMO_PIECES", 10**6)
    plain = [f"x {w}" for w in words]
    for k in range(0, len(plain), 500):
        enc.encode(plain[k:k + 500])
    assert not library and len(asked) == len(set(asked))  # "abc" and "abc." ask for "abc" once
    assert len([x for x in asked if x.strip(" ").isalpha()]) == len({w.strip(".,!") for w in words})


@pytest.mark.parametrize("vocab", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_marks_make_no_new_words(vocab):
    """The memo holds a word once, whatever marks follow it."""
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abdeinorstä") for _ in range(7)) for _ in range(500)})
    texts = [f"x {w}{m}" for m in ["", ".", ",", "!?", "***", "..."] for w in words]
    enc = encoding.Encoder(encoding.vocabulary(vocab))
    before = len(enc.memo)
    assert [x.tolist() for k in range(0, len(texts), 700) for x in enc.encode(texts[k:k + 700])] == [list(x) for x in enc.call(texts)]
    assert enc.count(texts).tolist() == [len(x) for x in enc.call(texts)]
    assert len(words) <= len(enc.memo) - before <= len(words) + 5
