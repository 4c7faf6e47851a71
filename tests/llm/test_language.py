import zlib

import numpy as np

from chatterloom.llm import language as L


def _numeric_gradient(weights, codes, there, truth, name, at, step=1e-2):
    losses = []
    for sign in (1, -1):
        moved = {k: v.copy() for k, v in weights.items()}
        moved[name][at] += sign * step
        losses.append(L._gradients(moved, codes, there, truth)[0])
    return (losses[0] - losses[1]) / (2 * step)


def test_backpropagation_equals_differences():
    rng = np.random.default_rng(1)
    weights = {k: v.astype(np.float64) for k, v in L._initial(3, rng).items()}
    codes = rng.integers(97, 105, (12, 4))
    there = np.ones((12, 4))
    there[8:, 1] = 0
    truth = np.array([0, 1, 2, 1])
    _, grads = L._gradients(weights, codes, there, truth)
    for name, at in [("uf", (3, 2)), ("ub", (10, 5)), ("uf", (20, 1)), ("xf", (2, 99)), ("xb", (18, 100)), ("ab", (9, 0)), ("vf", (1, 3)), ("c", (2, 0))]:
        near = _numeric_gradient(weights, codes, there, truth, name, at)
        assert abs(near - grads[name][at]) < 2e-4 + 0.02 * abs(near), name


def test_every_byte_counts_and_padding_does_not():
    rng = np.random.default_rng(2)
    model = L.Model(["a", "b"], L._initial(2, rng))
    texts = [b"x" * 10, b"abc" * 100, b"q" * 64]
    together = L.document_probabilities(model, texts, block=3)
    alone = np.concatenate([L.document_probabilities(model, [t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)
    assert np.allclose(together.sum(axis=1), 1, atol=1e-4)
    changed = L.document_probabilities(model, [b"abc" * 99 + b"abz"])[0]
    assert not np.allclose(changed, together[1], atol=1e-7)


def test_held_out_accuracy(documents):
    model = L.fit(documents)
    found = L.predict(documents.select("doc_id", "text", "lang"), model).withColumn("held", L.held_out()).collect()
    held = [r for r in found if r.held]
    assert {r.doc_id for r in held} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_edges(spark, edge_docs, no_docs):
    model = L.fit(edge_docs, steps=20)
    found = L.predict(edge_docs, model).collect()
    assert len(found) == edge_docs.count()
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in model.labels) == letters
        assert letters or (r.lang_pred, r.score) == ("und", 0.0)
    assert set(L.predict(edge_docs, model).columns) == {*edge_docs.columns, "lang_pred"}
    empty = L.fit(no_docs)
    assert empty.labels == [] and L.predict(no_docs, empty).collect() == []
    assert {r.lang_pred for r in L.predict(edge_docs, empty).collect()} == {"und"}
