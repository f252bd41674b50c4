"""Chat examples, whitening and hard negatives on hand-made rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import chat, eigen, hard_negatives, whitening

TURNS = "conv_id bigint, turn bigint, role string, text string, conv string, nr int, piece string, example int"
EXTRA = ("c", 1, "p", 2)
VECTORS = "vec_id bigint, embedding array<float>, label int, id string, x int, nr int, cell int"
CONTROL = ["</s>", "<s>", "[INST]", "[/INST]", "<|im_end|>", "<|im_start|>", "<|im_sep|>", "<|endoftext|>"]


def conversations(spark, *rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], TURNS)


def examples(spark, *rows):
    found = chat.replies(chat.examples(conversations(spark, *rows)))
    found = found.withColumn("parsed", chat.parse_turns(F.col("text")))
    return sorted(found.collect(), key=lambda r: (r.conv is None, r.conv, r.example))


def test_each_reply_is_a_target_with_all_turns_before_it(spark):
    told = [("system", "s"), ("user", "u1"), ("assistant", "a1"), ("user", "u2"), ("assistant", "réply 👍"), ("user", "u3")]
    rows = [(1, i, role, text) for i, (role, text) in enumerate(told)]
    random.Random(1).shuffle(rows)
    found = examples(spark, *rows)
    assert [[tuple(t) for t in r.parsed] for r in found] == [told[:3], told[:5], told]
    assert [r.reply for r in found] == ["a1", "réply 👍", None]
    assert [(r.turns, r.is_last) for r in found] == [(3, False), (5, False), (6, True)]
    for r in found[:2]:
        assert r.text[r.loss_start : r.loss_end] == r.reply
        assert r.text[r.loss_end :] == chat.END
    assert found[2].loss_start is None and found[2].loss_end is None


def test_control_strings_are_escaped_and_come_back(spark):
    rng = random.Random(2)
    parts = [*CONTROL, "\\", "\\\\", "<", "[", "|", ">", "s>", "/s>", "INST]", "$1", "\n", "é", "a"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    texts += [c[0] + "\\" * n + c[1:] for c in CONTROL for n in range(4)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("e", chat.escape(F.col("t")))
    for r in df.withColumn("back", chat.unescape(F.col("e"))).collect():
        assert r.back == r.t
        assert not any(c in r.e for c in CONTROL)
        assert r.e == r.t or any(c[0] in r.t for c in CONTROL)


def test_odd_turns(spark):
    long = "w" * 2_000_000
    found = examples(
        spark,
        (1, 0, "assistant", None), (1, 1, "assistant", ""), (1, None, None, "late"),
        (2, 0, "user", "only"),
        (3, 5, "assistant", "b"), (3, 5, "assistant", "a"), (3, 5, "assistant", "a"),
        (4, 0, "<|im_sep|>odd\nrole", long),
        (None, 0, "assistant", "x"),
    )
    by_conv = {}
    for r in found:
        by_conv.setdefault(r.conv, []).append(r)
    assert [r.reply for r in by_conv[1]] == ["", "", None]
    assert [tuple(t) for t in by_conv[1][-1].parsed] == [("assistant", ""), ("assistant", ""), ("", "late")]
    assert [(r.reply, r.is_last) for r in by_conv[2]] == [(None, True)]
    assert [r.reply for r in by_conv[3]] == ["a", "a", "b"]
    assert [tuple(t) for t in by_conv[4][0].parsed] == [("<|im_sep|>odd\nrole", long)]
    assert [r.reply for r in by_conv[None]] == ["x"]
    read = {r.conv: r for r in chat.digests(chat.examples(conversations(spark, (1, 0, "user", None)))).collect()}
    assert (read[1].n_turns, read[1].loss_chars, read[1].n_examples) == (1, 0, 1)
    assert chat.digests(chat.examples(conversations(spark).limit(0))).count() == 0


def test_turns_are_shuffled_once(spark):
    plan = chat.digests(chat.examples(conversations(spark, (1, 0, "user", "x"))))._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning") == 1 and "Python" not in physical


def random_symmetric(rng, values):
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    return (q * values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(9, 1, 40), np.r_[np.full(8, 5.0), np.full(20, 3.0), np.ones(12)], np.ones(40),
        5 - np.arange(40) * 1e-13, 10.0 ** -np.arange(40), np.r_[3.0, 2.0, 1.0, np.zeros(37)], np.array([4.0]), np.array([3.0, -1.0]),
    ],
)
def test_eigenpairs(values):
    a = random_symmetric(np.random.default_rng(3), values)
    found, vectors = eigen.leading_eigenpairs(a, 32)
    expected = np.linalg.eigvalsh(a)[::-1][: len(found)]
    norm = np.abs(values).max()
    assert np.abs(found - expected).max() < 1e-13 * norm
    assert np.abs(a @ vectors.T - vectors.T * found).max() < 1e-13 * norm
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-13


def test_eigenpairs_of_plain_matrices():
    for a in (np.array([[2.0, 1.0], [1.0, 2.0]]), np.diag(np.arange(6.0)), np.zeros((5, 5)), 1e-200 * np.diag([3.0, 1.0])):
        values, vectors = eigen.leading_eigenpairs(a, 4)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:4], rtol=1e-14, atol=0)
        assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-14)


def vectors_table(spark, rows):
    return spark.createDataFrame([(*r, "i", 1, 2, 3) for r in rows], VECTORS)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=5).tolist(), 0) for i in range(40)] + [(None, [1.0] * 5, None)] * 2
    bad = [(90, None, 0), (91, [], 0), (92, [1.0, None, 0.0, 0.0, 0.0], 0), (93, [float("nan")] * 5, 0), (94, [float("-inf")] * 5, 0)]
    found, model, error = whitening.whiten(vectors_table(spark, good + bad))
    rows = found.collect()
    assert sorted((r.id is None, r.id) for r in rows) == sorted((i is None, i) for i, _, _ in good)
    assert all(len(r.whitened) == 5 for r in rows) and error < 1e-9 and model.count == 42
    x = np.array([[int(np.floor(np.float32(c) * 64)) + 10**6 for c in v] for _, v, _ in good], dtype=object)
    expected = ((42 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert sorted(int(r.deviation) for r in rows) == sorted(expected)


def test_whitening_without_spread(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(5)]):
        found, model, error = whitening.whiten(vectors_table(spark, rows))
        assert [(r.deviation, r.whitened) for r in found.collect()] == [(0, [])] * len(rows)
        assert len(model.values) == 0 and error == 0
        assert whitening.by_component(found, model, error).count() == 0
    line = [(i, [float(i), 2.0 * i], 0) for i in range(5)]
    found, model, _ = whitening.whiten(vectors_table(spark, line))
    assert len(model.values) == 1 and len(found.first().whitened) == 1
    with pytest.raises(ValueError, match="length"):
        whitening.whiten(vectors_table(spark, [(1, [1.0], 0), (2, [1.0, 2.0], 0)]))


def test_deviations_beyond_64_bits():
    x = np.array([[10**15, 0], [0, 10**15]])
    found = whitening._deviations(x, 2, [10**15, 10**15])
    assert found == [2 * 10**30, 2 * 10**30]
    assert whitening._exact_sums(np.array([[2**62, -(2**62)]] * 5)) == [5 * 2**62, -5 * 2**62]


def mined(table, **options):
    found = hard_negatives.mine(
        table, F.col("vec_id") % 5 == 0, F.col("label"), options=hard_negatives.Options(**options)
    )
    return sorted(map(tuple, found.collect()), key=repr)


def brute(rows, positives=5, negatives=3):
    good = [r for r in rows if r[1] is not None and r[2] is not None and all(c is not None and np.isfinite(c) for c in r[1])]
    x = [[int(np.floor(np.float64(np.float32(c)) * 256)) for c in r[1]] for r in good]
    out = []
    for a, (anchor_id, _, label) in enumerate(good):
        if anchor_id is None or anchor_id % 5:
            continue
        score = [sum(p * q for p, q in zip(x[a], v)) for v in x]
        order = sorted(range(len(good)), key=lambda i: (-score[i], good[i][0] is None, good[i][0] or 0, i))
        for p in [i for i in order if i != a and good[i][2] == label][:positives]:
            inside = [i for i in order if good[i][2] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            for rank, i in enumerate(inside[:negatives], 1):
                out.append((anchor_id, good[p][0], rank, good[i][0], score[p], score[i]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"rows_per_cell": 9, "anchors_per_cell": 4}, {"rows_per_cell": 1, "most_row_groups": 3}])
def test_mining_odd_rows(spark, options):
    rng = random.Random(5)
    # Small whole numbers make many equal scores; a third of the rows are one vector.
    rows = [(i, [rng.randrange(-2, 4) / 256 for _ in range(4)], rng.randrange(3)) for i in range(90)]
    rows += [(100 + i, [2 / 256, 1 / 256, 0.0, 1 / 256], rng.randrange(3)) for i in range(45)]
    rows += [rows[5], rows[5], rows[10], (None, [3 / 256] * 4, 0), (None, [3 / 256] * 4, 1), (200, [0.0] * 4, 1)]
    rows += [(205, None, 1), (210, [1.0, None, 0.0, 0.0], 1), (215, [float("nan")] * 4, 1), (220, [0.5] * 4, None)]
    assert mined(vectors_table(spark, rows), **options) == brute(rows)


def test_mining_without_rows_or_anchors(spark):
    assert mined(vectors_table(spark, [])) == []
    assert mined(vectors_table(spark, [(1, [1.0], 0), (2, [1.0], 1)])) == []
    assert mined(vectors_table(spark, [(5, [1.0], 0)])) == []
    with pytest.raises(ValueError, match="length"):
        try:
            mined(vectors_table(spark, [(5, [1.0], 0), (6, [1.0, 2.0], 1)]))
        except Exception as e:
            raise ValueError(str(e)) from e


def test_mining_keeps_few_pairs_per_cell(spark):
    """What a cell sends is bounded by its anchors, not by its pairs."""
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], i % 3) for i in range(1000)]
    options = hard_negatives.Options()
    table = hard_negatives.prepared(vectors_table(spark, rows), F.col("vec_id") % 5 == 0, F.col("label")).cache()
    anchors = table.where("is_anchor").withColumn("positives", F.lit(None).cast("array<bigint>"))
    cells = hard_negatives._cells(table, anchors, (1000, 200), options)
    pairs = hard_negatives._pairs(cells, 1, 5, hard_negatives._choose_positives(5))
    assert pairs.count() == 200 * 5
