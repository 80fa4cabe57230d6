"""Insults with letters put in, in sentences that are clean but for them."""

import random

import numpy as np

from strandline.llm import toxicity

INSULTS = ("trash", "scum", "idiot", "worthless", "clown", "disgusting", "loser", "moron", "pathetic", "stupid")
PLAIN = "the report came out on tuesday and the council read it near the old bridge while children walked along the river with bread".split()


def sentence(rng, word=None):
    words = [rng.choice(PLAIN) for _ in range(12)]
    if word:
        words[rng.randrange(12)] = word
    return " ".join(words)


def test_single_insertions_are_found():
    rng = random.Random(2)
    texts = [sentence(rng, INSULTS[k % len(INSULTS)]) for k in range(400)] + [sentence(rng) for _ in range(1200)]
    model = toxicity.Model.of(texts, np.array([1] * 400 + [0] * 1200))
    assert set(INSULTS) <= set(model.landmarks.words)

    def rate(times):
        return (model.scores([sentence(rng, toxicity.stretched(w, 100 + k, times)) for w in INSULTS for k in range(30)]) >= 0.3).mean()

    assert rate(0) == 1 and rate(1) >= 0.9 and rate(2) >= 0.6
    assert (model.scores([sentence(rng) for _ in range(500)]) >= 0.3).mean() <= 0.02
