"""What an encoder keeps and takes at a time."""

import numpy as np
import pyarrow as pa
import pytest

from tallybrook.llm import tokens
from tallybrook.llm.queries import tokenizer
from tallybrook.llm.tokens import Encoder

FILES = [("word", "word_bpe_49k.json"), ("byte", "byte_bpe_50k.json")]


def whole(store, texts):
    return [store.model.encode(t or "", add_special_tokens=False).ids for t in texts]


def lists(ids, at):
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


@pytest.mark.parametrize("kind,file", FILES)
def test_pieces_met_again_outlive_the_others(kind, file, monkeypatch):
    monkeypatch.setattr(tokens, "LIMIT", 300)
    store, learned = Encoder(tokenizer(file), kind), []
    add = Encoder.add
    monkeypatch.setattr(Encoder, "add", lambda self, pieces, *rest: learned.append((self.thinning, pieces)) or add(self, pieces, *rest))
    thin = Encoder._thin

    def thinned(self):
        self.thinning = True
        thin(self)
        self.thinning = False

    monkeypatch.setattr(Encoder, "_thin", thinned)
    store.thinning = False
    often = " ".join(f"often{k}" for k in range(20))
    for i in range(20):
        texts = [f"z {often} z", None, " ".join(f"once{i}x{k}" for k in range(100)), "a <|b <|endoftext|> c", ""]
        assert lists(*store.encode(pa.array(texts))) == whole(store, texts)
        assert len(store.known) <= 300 + 150
    assert any(thinning for thinning, _ in learned)
    encoded = [p.strip() for thinning, pieces in learned if not thinning for p in pieces]
    assert all(encoded.count(f"often{k}") == 1 for k in range(20))


@pytest.mark.parametrize("kind,file", FILES)
def test_texts_go_through_in_parts(kind, file, monkeypatch):
    monkeypatch.setattr(tokens, "PART_BYTES", 400)
    store, sizes = Encoder(tokenizer(file), kind), []
    part = Encoder._encode_part
    monkeypatch.setattr(Encoder, "_encode_part", lambda self, texts: sizes.append(sum(len((t or "").encode()) for t in texts.to_pylist())) or part(self, texts))
    rng = np.random.default_rng(5)
    texts = [None, "", " \n", "ein Satz.  Zwei, drei vier", "x" * 900] + [" ".join(f"wört{n}." for n in rng.integers(0, 300, 12)) for _ in range(80)] + [None]
    texts = pa.array(["left out", *texts])[1:]
    assert lists(*store.encode(texts)) == whole(store, texts.to_pylist())
    assert len(sizes) > 20 and sorted(sizes)[-2] <= 400
    ids, at = store.encode(texts[:0])
    assert len(ids) == 0 and at.tolist() == [0]
