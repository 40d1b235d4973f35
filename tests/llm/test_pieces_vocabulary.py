"""Segmentation by the real vocabulary: brute force, its own encoder's number of pieces, exact round trips."""

import random

import numpy as np
import pytest

from cueforge.llm import pieces

from .helpers import odd_texts
from .test_operators import brute_paths


@pytest.fixture(scope="module")
def lattice():
    return pieces.load(pieces.model_path())


def test_nbest_of_the_real_vocabulary(lattice):
    rng = random.Random(60)
    bits = ["the", "ing", "a", " ", "re", "ß", "und", "9", "é", "▁", "中", "'s", "ö"]
    for _ in range(150):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 6)))[:11]
        norm = pieces.normalise(text)
        want = brute_paths(lattice, norm)
        got = lattice.nbest(norm, 5)
        assert [s for s, _ in got] == [s for s, _ in want[:5]], text
        assert len({i for _, i in got}) == len(got)
        # the whole text's own A* search finds the same scores
        assert [s for s, _ in lattice.search(norm, 5)] == [s for s, _ in want[:5]]
        assert all(lattice.decode(np.frombuffer(i, "<u4")) == text for _, i in got)


def test_texts_decode_to_themselves(lattice):
    for t in [*odd_texts(), "a▁b", "▁", "▁▁ ▁", " a ▁ ", "▁￾"]:
        t = t or ""
        if len(t) < 60_000:
            assert lattice.decode(np.frombuffer(lattice.nbest(pieces.normalise(t), 1)[0][1], "<u4")) == t


def test_pieces_are_about_as_many_as_the_encoders(lattice):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    texts = [
        "hello world this is a test of the segmentation", "The quick brown fox jumps over the lazy dog and runs into the forest.", "Der Ausschuss hat gestern über die neue Verordnung beraten und sie angenommen.",
        "Le gouvernement a présenté hier un projet de loi sur la protection des données.", "Los estudiantes trabajan todos los días en la biblioteca de la universidad.", "def read(path): return open(path).read()",
    ]
    own, theirs = (sum(len(x) for x in y) for y in ([lattice.nbest(pieces.normalise(t), 1)[0][1][::4] for t in texts], [sp.encode(t) for t in texts]))
    assert 0.85 * theirs <= own <= 1.1 * theirs
    assert len(lattice.nbest(pieces.normalise(texts[0]), 1)[0][1]) // 4 <= len(sp.encode(texts[0])) + 2
