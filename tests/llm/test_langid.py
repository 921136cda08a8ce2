import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import langid, tasks
from mercato.llm.langid import Network, identify, lanes, recognised, train
from tests.conftest import SF
from tests.llm.helpers import DOCUMENTS, documents


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    network = Network(["a", "b", "c"], seed=3)
    for direction in (network.forward, network.backward):
        for name in ("table", "inputs", "state", "bias"):
            setattr(direction, name, getattr(direction, name).astype(np.float64))
    codes, labels = rng.integers(97, 100, (4, 5)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        chances = network.positions(codes)
        return -np.log(np.take_along_axis(chances, labels[None, None, :].repeat(5, 0), 1)).mean()

    for parameter, gradient in zip(network.parameters(), network.step(codes, labels)):
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in parameter.shape)
            if parameter.shape[0] == 256:
                at = (98, at[1])
            old, step = parameter[at], 1e-2
            parameter[at] = old + step
            above = loss()
            parameter[at] = old - step
            below = loss()
            parameter[at] = old
            assert gradient[at] == pytest.approx((above - below) / (2 * step), abs=2e-3)


def plain_positions(network, data):
    """The distribution at every byte of one text, by one step after the other."""

    def states(direction, order):
        h, width, out = np.zeros(network.hidden), network.hidden, {}
        for t in order:
            x = direction.table[data[t]] @ direction.inputs + direction.bias
            u = h @ direction.state
            z, r = (1 / (1 + np.exp(-(x[i * width : (i + 1) * width] + u[i * width : (i + 1) * width]))) for i in (0, 1))
            n = np.tanh(x[2 * width :] + r * u[2 * width :])
            h = (1 - z) * n + z * h
            out[t] = h
        return out

    ahead = states(network.forward, range(len(data)))
    behind = states(network.backward, range(len(data) - 1, -1, -1))
    scores = np.array([np.concatenate([ahead[t], behind[t]]) @ network.out + network.bias for t in range(len(data))])
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def flat(texts):
    import pyarrow as pa

    return tasks.flat(pa.array(texts, pa.string()))


def test_texts_equal_a_plain_loop(monkeypatch):
    """State crosses word ends; short texts of many lengths go side by side."""
    monkeypatch.setattr(langid, "CHUNK", 3)
    network = train([b"der und ", b"ist die ", b"the and ", b"of that "] * 40, np.array([0, 0, 1, 1] * 40), ["de", "en"])
    texts = ["der und die", "the and", "", None, "x", "12, é! " * 40, "the 漢字", "and of"]
    found = network.probabilities(*flat(texts))
    for text, got in zip(texts, found):
        if text:
            assert got == pytest.approx(plain_positions(network, text.encode()).mean(axis=0), abs=1e-5)
        else:
            assert (got == 0).all()
    assert found[0].argmax() == 0 and found[1].argmax() == 1


def test_long_texts_are_read_side_by_side():
    """With the context before and after them, the lanes' labels are those of the whole text."""
    network = train([b"der und ", b"the and "] * 40, np.array([0, 1] * 40), ["de", "en"])
    text = "und der the and " * 90 + "of"
    got = network.probabilities(*flat([text, "der", text[:700]]))
    for found, whole in zip(got, (text, "der", text[:700])):
        assert found == pytest.approx(plain_positions(network, whole.encode()).mean(axis=0), abs=1e-3)


@pytest.mark.parametrize("lane, context", [(512, 32), (12, 3), (5, 1)])
def test_every_byte_is_labelled_once(monkeypatch, lane, context):
    monkeypatch.setattr(langid, "LANE", lane)
    monkeypatch.setattr(langid, "CONTEXT", context)
    for size in [*range(40), 511, 512, 513, 960, 961, 5_000]:
        _, start, length, first, last = lanes(np.array([0, 7, 7 + size, 7 + size]))
        places = [p for s, a, b in zip(start[start >= 7], first[start >= 7], last[start >= 7]) for p in range(s + a, s + b)]
        assert sorted(places) == list(range(7, 7 + size))
        inner = [(s, n, a, b) for s, n, a, b in zip(start, length, first, last) if s >= 7]
        assert all(n <= lane and a >= 0 and b <= n for _, n, a, b in inner)
        for (s, n, a, b), (after, *_ ) in zip(inner, inner[1:]):
            assert n - b >= context and after > s


def test_every_label_is_learned_from_a_bounded_sample(spark, monkeypatch):
    """Copies of one row do not crowd out others; the sample does not depend on the order of rows."""
    monkeypatch.setattr(langid, "ALL_DOCUMENTS", 60)
    rows = [(i, f"text {i} of label {i % 30} " * 9, f"l{i % 30}", "s", 1) for i in range(3_000)] + [(7, "copy " * 50, "l0", "s", 1)] * 900
    frame = spark.createDataFrame(rows, DOCUMENTS)
    found = langid.training_pieces(frame.repartition(5), "doc_id", "text", "lang")
    assert {lang for lang, _ in found} == {f"l{i}" for i in range(30)}
    assert found == langid.training_pieces(frame.repartition(2), "doc_id", "text", "lang")
    per = [sum(lang == name for lang, _ in found) for name in {lang for lang, _ in found}]
    assert max(per) <= langid.LEAST_DOCUMENTS * langid.PIECES


def test_held_out_documents_are_told(spark):
    documents_ = spark.read.parquet(f"{SF}/documents.parquet")
    found = identify(documents_).join(documents_.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(found) > 20
    assert np.mean([r.lang_pred == r.lang for r in found]) > 0.9
    assert all(0 <= r.score <= 1 for r in found)


def test_awkward_rows(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = [(None, "the words of a text", "en", "s", 1), (-1, None, "en", "s", 1), (-2, "", "en", "s", 1)]
    odd += [(-3, "12 34 !?", "en", "s", 1), (-4, "and then the thing", None, "s", 1), (-5, "漢字", "en", "s", 1)]
    frame = given.unionByName(spark.createDataFrame([*odd, odd[4]], DOCUMENTS)).withColumn("score", F.lit("x"))
    found = identify(frame)
    rows = {r.doc_id: r for r in found.collect()}
    assert found.count() == given.count() + 7
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (-1, -2, -3))
    assert rows[-5].lang_pred != "und" and rows[None].held_out is False
    kept = recognised(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} >= {r.doc_id for r in given.collect()} - {-1, -2, -3}
    assert not {-1, -2, -3} & {r.doc_id for r in kept.collect()}


def test_nothing_to_learn_from(spark):
    assert identify(documents(spark, [])).count() == 0
    unlabelled = documents(spark, [(1, "some text")]).withColumn("lang", F.lit(None).cast("string"))
    assert identify(unlabelled).collect()[0].lang_pred == "und"
