"""Operator 12: scores against plain counts and a plain network, gradients against differences."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from odd_tables import no_documents, odd_documents  # noqa: F401

from gristmill.llm import gated_network, language_model, queries
from gristmill.llm.gated_network import Network, Parameters

COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def plain_counts(rows):
    """Training counts of words, None for the end, and rows (doc_id, held_out, n_tokens, n_known, N, base_score)."""
    counts = Counter()
    for doc_id, text in rows:
        if not is_held_out(doc_id):
            counts.update([*words_of(text), None])
    total, below = sum(counts.values()), math.log10(sum(counts.values()) + len(counts) + 1)
    out = []
    for doc_id, text in rows:
        t = [*words_of(text), None]
        base = sum(math.log10(counts[w] + 1) - below for w in t)
        out.append((doc_id, is_held_out(doc_id), len(t), sum(counts[w] > 0 for w in t), total, base))
    return counts, out


def check_base(found, rows):
    assert found.columns == COLUMNS
    mine = sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2], r[5]))
    expected = sorted(plain_counts(rows)[1], key=lambda r: (r[0] is None, r[0] or 0, r[2], r[5]))
    assert [r[:5] for r in mine] == [r[:5] for r in expected]
    assert all(abs(a[5] - b[5]) <= 1e-9 * max(1, abs(b[5])) for a, b in zip(mine, expected))
    return mine


def gate(x):
    return np.clip(0.5 + x / 4, 0, 1)


def plain_score(p: Parameters, cuts, read):
    """Natural log probability of one document, a step at a time in double precision."""
    p = Parameters(*[np.asarray(v, dtype=float) for v in vars(p).values()])
    n, h, total, before = p.recurrent.shape[0], np.zeros(p.recurrent.shape[0]), 0.0, gated_network.END
    for word in read:
        g = p.gates[before]
        z, r = np.split(gate(g[: 2 * n] + h @ p.recurrent[:, : 2 * n]), 2)
        h = h + z * (np.tanh(g[2 * n :] + (r * h) @ p.recurrent[:, 2 * n :]) - h)
        c = int(np.searchsorted(cuts, word, "right")) - 1
        classes = h @ p.classes + p.class_bias
        total += classes[c] - math.log(np.exp(classes).sum())
        inner = p.words[cuts[c] : cuts[c + 1]] @ h + p.word_bias[cuts[c] : cuts[c + 1]]
        total += inner[word - cuts[c]] - math.log(np.exp(inner).sum())
        before = word
    return total


def some_network(words=30, hidden=5, classes=6, seed=3):
    draw = np.random.default_rng(seed)
    counts = np.sort(draw.integers(1, 200, words))[::-1]
    cuts = gated_network.class_cuts(counts, classes)
    p = gated_network.first_parameters(counts, cuts, hidden, seed)
    return Network(p.like(p.flat() + 0.3 * draw.standard_normal(p.flat().size)), cuts), draw


def test_every_word_is_in_one_class():
    for counts in ([5, 0], [5, 2, 9], list(range(900, 0, -1)), [1] * 50):
        cuts = gated_network.class_cuts(np.array(counts), 7)
        assert cuts[0] == 0 and cuts[-1] == len(counts) and (np.diff(cuts) > 0).all()


def test_documents_side_by_side_score_as_alone():
    network, draw = some_network()
    lengths = [1, 2, 31, 32, 33, 64, 65, 200, 700, 3, 1, 90]
    documents = [np.append(draw.integers(1, 30, n - 1), 0).astype(np.int32) for n in lengths] * 60
    found = network.score(documents)
    for i, mine in enumerate(found):
        if i < len(lengths):
            assert math.isclose(mine, plain_score(network.p, network.cuts, documents[i]), rel_tol=2e-5)
        else:
            assert math.isclose(mine, found[i % len(lengths)], rel_tol=1e-5)


def test_probabilities_add_up():
    network, draw = some_network()
    start = draw.integers(1, 30, 7)
    whole = network.score([start[:6].astype(np.int32)])[0]
    each = network.score([np.append(start[:6], w).astype(np.int32) for w in range(30)])
    assert math.isclose(np.exp(each - whole).sum(), 1, rel_tol=1e-4)


def test_gradients(monkeypatch):
    """One window: the step's gradients against differences of the plain score."""
    network, draw = some_network(words=12, hidden=3, classes=3)
    documents = [np.append(draw.integers(1, 12, n), 0).astype(np.int32) for n in (6, 3, 9, 1)]
    caught = []
    monkeypatch.setattr(Network, "_step", lambda self, slope, memory, rate, tokens: caught.append(slope))
    total = network.train(documents, network.p.like(np.zeros(0)), 0.1)
    flat = network.p.flat().astype(float)

    def loss(values):
        made = Parameters(*[a.astype(float) for a in vars(network.p).values()])
        at = 0
        for name, a in vars(made).items():
            setattr(made, name, values[at : at + a.size].reshape(a.shape))
            at += a.size
        return -sum(plain_score(made, network.cuts, d) for d in documents)

    assert math.isclose(-total, loss(flat), rel_tol=1e-5)
    slope = caught[0].flat()
    for i in draw.choice(flat.size, 60, replace=False):
        step = np.zeros(flat.size)
        step[i] = 1e-5
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-5 - slope[i]) < 1e-3


def test_training_learns_an_order():
    """Words that follow each other in a ring: far better than their shares after one pass."""
    draw = np.random.default_rng(5)
    documents = [np.append((draw.integers(0, 8) + np.arange(40)) % 8 + 2, 0).astype(np.int32) for _ in range(400)]
    counts = np.array([400, 0, *[2000] * 8])
    cuts = gated_network.class_cuts(counts, 3)
    p = gated_network.first_parameters(counts, cuts, 12, 1)
    network = Network(p, cuts)
    before = network.score(documents[:50]).sum()
    for _ in range(30):
        network.train(documents, p.like(np.zeros(0)), 0.1)
    assert network.score(documents[:50]).sum() > before / 3


def test_whole_table(spark, sf_dir, monkeypatch):
    """Base scores against plain counts, with most words joined; the model is better on held-out documents."""
    monkeypatch.setattr(language_model, "HELD", 300)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    mine = check_base(queries.QUERIES["op12_lm_scoring"](spark, sf_dir), rows)
    assert sum(r[6] for r in mine if r[1]) > sum(r[5] for r in mine if r[1])
    assert all(r[6] < 0 for r in mine)


def test_score_is_that_of_a_plain_network(spark, monkeypatch):
    """Rare words by their counts, all others by the network that was trained."""
    draw, kept = np.random.default_rng(2), []
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(draw.choice(words, draw.integers(0, 90), p=np.arange(60, 0, -1) / 1830))) for i in range(60)]
    plain_train = language_model.train

    def train(*arguments):
        kept.append((arguments[1], *plain_train(*arguments)))
        return kept[-1][1:]

    monkeypatch.setattr(language_model, "train", train)
    monkeypatch.setattr(language_model, "HELD", 40)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    mine = check_base(language_model.document_scores(frame, words=20, classes=4, hidden=6), rows)
    (vocabulary, parameters, cuts), (counts, _) = kept[0], plain_counts(rows)
    top = {w.decode(): i + 2 for i, w in enumerate(vocabulary.held[:20])}
    order = sorted((w for w in counts if w is not None), key=lambda w: (-counts[w], w))
    assert list(top) == order[:20]
    rare = sum(counts[w] for w in order[20:]) + len(order[20:]) + 1
    for (doc_id, text), row in zip(rows, mine):
        t = words_of(text)
        logs = plain_score(parameters, cuts, [*(top.get(w, 1) for w in t), 0]) / math.log(10)
        logs += sum(math.log10((counts[w] + 1) / rare) for w in t if w not in top)
        assert row[0] == doc_id and math.isclose(row[6], logs, rel_tol=1e-4, abs_tol=1e-4)


def test_odd_documents(spark, odd_documents):  # noqa: F811
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    mine = check_base(language_model.document_scores(odd_documents), rows)
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in mine)


def test_long_words_and_no_training_documents(spark):
    long = "x" * 5000
    rows = [(1, f"{long} a {long}"), (2, f"b {long}"), (3, "y" * 70), (4, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check_base(language_model.document_scores(frame), rows)
    out = next(i for i in range(100) if is_held_out(i))
    only = [(out, "some words"), (out, "")]
    mine = check_base(language_model.document_scores(spark.createDataFrame(only, "doc_id long, text string")), only)
    assert [r[5] for r in mine] == [0.0, 0.0] and [r[4] for r in mine] == [0, 0]


def test_no_documents(spark, no_documents):  # noqa: F811
    found = language_model.document_scores(no_documents)
    assert found.columns == COLUMNS and found.collect() == []


@pytest.mark.parametrize("doc_id", [0, 7, 123456789012])
def test_held_out_rows(spark, doc_id):
    frame = spark.createDataFrame([(doc_id,)], "doc_id long")
    assert frame.select(language_model.held_out()).first()[0] == is_held_out(doc_id)
