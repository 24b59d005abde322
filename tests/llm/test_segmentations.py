"""Samples against the plain lattice of the whole text: pieces over several spaces, and words of any length."""

import math

import numpy as np
import pytest

from comanda.llm import sampling
from comanda.llm.queries import vocabulary

PATH = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def weights():
    """Log probability by piece and that of a byte, by rank among all pieces of the vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    n = model.vocab_size()
    mass = {i: 1 / (2 - model.get_score(i)) for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    total = sum(mass.values()) + 256 / (n + 2)
    return {model.id_to_piece(i): math.log(m / total) for i, m in mass.items()}, math.log(1 / (n + 2) / total)


def arcs(text, weights):
    """Of every place of the text the pieces from it on, as (characters, log probability)."""
    plain, byte = weights
    marked = "▁" + text.replace("▁", "\0").replace(" ", "▁")
    found = [[(j, plain[marked[i : i + j]]) for j in range(1, 17) if i + j <= len(marked) and marked[i : i + j] in plain] for i in range(len(marked))]
    for at, c, character in zip(found, marked, " " + text, strict=True):
        if c not in plain:
            at.append((1, byte * len(character.encode())))
    return found


def mass(found):
    """Log of all segmentations' mass, and how many they are."""
    logs, ways = [0.0] * (len(found) + 1), [1] * (len(found) + 1)
    for i in range(len(found) - 1, -1, -1):
        values = [x + logs[i + j] for j, x in found[i]]
        logs[i] = max(values) + math.log(sum(math.exp(x - max(values)) for x in values))
        ways[i] = sum(ways[i + j] for j, _ in found[i])
    return logs[0], ways[0]


def keys(n):
    return sampling.mix(np.arange(n, dtype=np.uint64) * sampling.GOLD)


def log_of(ids, weights, v):
    plain, byte = weights
    return sum(byte if int(i) in v.byte_of else plain[v.pieces[i]] for i in ids)


@pytest.mark.parametrize("text", ["a  b", "  ", " ab   c", "▁ x  ▁▁", "the the", " " * 5, "\n  if", "é  ☃\0"])
def test_every_segmentation_comes_once(text, weights):
    v = sampling.vocabulary(PATH)
    all_, ways = mass(arcs(text, weights))
    (got,) = sampling.sample([text], keys(1), ways + 5, v)
    assert len({tuple(s[0]) for s in got}) == len(got) == ways and all(sampling.decode(s[0].tolist(), v) == text for s in got)
    assert sum(math.exp(s[1]) for s in got) == pytest.approx(1)
    assert all(s[1] == pytest.approx(log_of(s[0], weights, v) - all_) for s in got)


@pytest.mark.parametrize("text", ["the  cat" + " " * 40 + "sat", "x" * 600, "a " + "the" * 300 + "  b", "中文é字▁" * 150 + " the end", "=" * 3000, "q" * 255 + "▁" * 3 + " a" * 3, "ab" * 128 + "  " + "ab" * 128])
def test_probabilities_are_of_the_whole_text(text, weights):
    v = sampling.vocabulary(PATH)
    all_, _ = mass(arcs(text, weights))
    for samples in sampling.sample([text, "", text, "the end"], keys(4), 3, v)[::2]:
        assert len({tuple(s[0]) for s in samples}) == 3 and all(sampling.decode(s[0].tolist(), v) == text for s in samples)
        assert all(s[1] == pytest.approx(log_of(s[0], weights, v) - all_) for s in samples)


def test_pieces_cross_spaces_and_the_256th_character():
    v = sampling.vocabulary(PATH)
    for text, place in (("a   the", 3), ("the" * 200, 256), ("x" * 600, 256)):
        over = 0
        for samples in sampling.sample([text] * 200, keys(200), 1, v):
            ends = np.cumsum([len(v.pieces[i]) for i in samples[0][0]])
            over += place not in ends
        assert over > 5


def test_places_of_a_long_word_have_noise_of_their_own(monkeypatch):
    v = sampling.vocabulary(PATH)
    text = "the" * 400 + " " + " ".join(["the" * 2] * 200)
    cuts = sampling.parts(text, v)
    assert max(map(len, cuts)) > 2 * sampling.WORD_CHARS and "".join(cuts) == sampling.MARK + text.replace(" ", sampling.MARK)
    met, uniform = [], sampling.uniform

    def noted(key, word, place, use):
        if use == 2:
            met.extend(zip(word.tolist(), place.tolist(), strict=True))
        return uniform(key, word, place, use)

    monkeypatch.setattr(sampling, "uniform", noted)
    sampling.sample([text], keys(1), 1, v)
    numbers = [(w << 8) + p for w, p in met]
    assert len(set(numbers)) == len(numbers) > 600 and max(p for _, p in met) > 2 * sampling.WORD_CHARS
