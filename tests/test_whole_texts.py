"""Operators of the engine do the whole job: phrases, headers, topics and vectors on small invented texts."""

import math
import random

from commlens import config
from commlens.operators import phrases


def test_phrases_of_the_whole_text():
    far = "heavy turbine " + "the " * 400 + "copper winding " + "the " * 400 + "heavy turbine"
    got = dict(phrases.keyphrases(far))
    assert set(got) == {"heavy turbine", "copper winding"} and abs(sum(got.values()) - 1) < 1e-9
    six = dict(phrases.keyphrases("annual northern regional turbine maintenance contract. " * 2))
    assert "annual northern regional turbine maintenance contract" in six
    rng = random.Random(3)
    many = " the ".join(f"{rng.choice('abcdefgh') * 4}{i} {rng.choice('klmnop') * 4}{i}" for i in range(150))
    assert len(phrases.keyphrases(many)) == 100
    c = config.load()
    assert (c.phrase_window, c.phrase_lengths, c.phrase_count) == (1000, [2, 3, 4, 5, 6], 100)


def test_pairs_of_terms_by_windows():
    rng = random.Random(4)
    for _ in range(60):
        n, k, width = rng.randrange(2, 40), rng.randrange(1, 5), rng.randrange(2, 50)
        w = min(n, width)
        at = sorted({(rng.randrange(n), rng.randrange(k)) for _ in range(rng.randrange(1, 25))})
        sums, number = phrases._together(at, k, n, w)
        want, times = [[0.0] * k for _ in range(k)], [[0] * k for _ in range(k)]
        for s in range(min(n - w + 1, n - 1) + 1):
            for i, p in at:
                for j, q in at:
                    if p != q and s <= i <= s + w and s <= j <= s + w:
                        want[p][q] += math.log(w / max(abs(i - j), 1))
                        times[p][q] += 1
        assert all(abs(sums[p][q] - want[p][q]) < 1e-9 and number[p][q] == times[p][q] for p in range(k) for q in range(k))


def test_all_terms_and_their_components(spark):
    import numpy as np
    from pyspark.ml import Pipeline

    from commlens.operators import models

    rng = random.Random(5)
    rows = [(i, [f"t{rng.randrange(30000)}" for _ in range(500)] + ["red"] * (i % 3) + ["blue"] * (i % 5)) for i in range(120)] + [(120, [])]
    df = spark.createDataFrame(rows, "doc_id int, words array<string>").repartition(3)
    model = Pipeline(stages=models.tfidf("words", "x", 1, 0.99)).fit(df)
    assert set(model.stages[0].vocabulary) == {w for _, ws in rows for w in ws} and len(model.stages[0].vocabulary) > 20000
    small = Pipeline(stages=models.tfidf("words", "x", 5, 0.9)).fit(df)
    size = len(small.stages[0].vocabulary)
    s = models.sparse(small.transform(df), "doc_id", "x").cache()
    pc = models.components(s, size, 2, rounds=500, near=1e-12)
    x = np.zeros((121, size))
    for r in s.collect():
        x[r.doc_id, r.i] = r.x
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(np.var(x @ pc, axis=0, ddof=1), values[:2], rtol=1e-6) and np.allclose(pc.T @ pc, np.eye(2), atol=1e-9)
    assert all(np.allclose(r.pca, x[r.doc_id] @ pc) for r in models.reduced(s, pc, "pca").collect())


def test_each_inline_header_is_removed():
    from commlens.functions.mime import no_inline_headers

    many = "To: " + ",\n ".join(f"person{i}@example.com" for i in range(400)) + "\n"
    for head in (
        "---- Forwarded by A on x ----\nA\n" + many + "Subject: s", "Begin forwarded message:\n> From: A\n" + many.strip().replace("\n", " "), "-----Original Message-----\nFrom: A\n" + many + "Subject: s",
        "____ Reply Separator ____\nAuthor: A\nDate: 1/2/00", "A B\n01/02/2000 10:11 AM\n" + many + "Subject: s", "From: A\n" + many + "Subject: s",
    ):
        assert no_inline_headers(f"One §.\n\n{head}\nTwo §.\n") == "One §.\n\n\nTwo §.\n"
    assert no_inline_headers(None) == "" and no_inline_headers("From: A\nno more") == "From: A\nno more"
    assert no_inline_headers("From: x\n" * 100_000) == "From: x\n" * 100_000


def test_long_headers_are_split():
    from commlens.functions.mime import split

    many = "To: " + ",\n ".join(f"person{i}@example.com" for i in range(400)) + "\n"
    for head in ("-----Original Message-----\nSent: x\n" + many + "Subject: s", "From: A\n" + many + "Subject: s", "A 1/2/2000 10:11\n" + many + "Subject: s", "____ Reply Separator ____\nAuthor: A\nDate: 1/2/00"):
        assert split("H", f"One.\n{head}\n\nTwo.") == [{"header": "H", "body": "One."}, {"header": head, "body": "Two."}]
    assert len(split("H", "From: x\n" * 100_000)) == 1


def test_registered_topic_models(monkeypatch):
    import inspect

    import pytest

    from commlens.operators import topics
    from commlens.plans import topics as plans

    signature, seen = inspect.signature(topics.train), []

    def train(*a, **b):
        got = signature.bind(*a, **b)
        got.apply_defaults()
        seen.append(got.arguments)
        raise InterruptedError

    monkeypatch.setattr(topics, "train", train)
    monkeypatch.setattr(plans, "_bags", lambda *a: None)
    for f in (plans.m2, plans.m4, plans.m3):
        with pytest.raises(InterruptedError):
            f(None, "")
    assert [(x["k"], x["alpha"], x["iterations"]) for x in seen] == [(25, 0.1, 20), (25, 0.1, 20), (100, 0.5, 20)]
