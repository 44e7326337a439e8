"""Every window of a text is scored, wherever it starts."""

from __future__ import annotations

import numpy as np

from tallybook.llm import toxicity


def test_a_passage_scores_the_same_wherever_it_stands():
    model = toxicity.Model(np.zeros(toxicity.BUCKETS), -1.0)
    for gap in range(1, toxicity.WINDOW):
        for before in range(20):
            values = np.zeros(60)
            values[[before, before + gap]] = 16.0
            logit, start = model.logit(values)
            assert abs(logit - 1.0) < 1e-12 and start <= before and before + gap < start + toxicity.WINDOW
    assert model.logit(np.ones(5)) == (-1.0 + 5 / 16, 0) and model.logit(np.zeros(0)) == (-1.0, 0)


def test_scores_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(0, 5, toxicity.BUCKETS), -0.5)
    words = ["Aa,", "aa", "(bb)", "--", "cc.", "ddé", "e\u00a0f", "gg!", "h", "ii", "jj", "kk"]
    texts = [None, "", "-- ..", *(" ".join(rng.choice(words, n)) for n in (1, 5, 16, 17, 40, 200))]

    def by_hand(text):
        own = [w for w in (x.strip(toxicity.EDGES) for x in (text or "").lower().split()) if w]
        values = [0.0 if w in own[max(0, i - toxicity.WINDOW + 1) : i] else model.word(w) for i, w in enumerate(own)]
        sums = [sum(values[i : i + toxicity.WINDOW]) for i in range(max(1, len(values) - toxicity.WINDOW + 1))]
        return 1 / (1 + np.exp(-(model.bias + max(sums) / toxicity.WINDOW)))

    got = dict(toxicity.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect())
    assert all(abs(got[i] - by_hand(t)) < 1e-9 for i, t in enumerate(texts))
