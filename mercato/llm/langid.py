"""Language identification by a bidirectional gated recurrent network over the bytes of texts.

The network reads the byte stream forwards and backwards and labels every position with a distribution
over languages; a document's probabilities are the mean over all its positions.  Long texts are read in
lanes side by side: each starts and ends some bytes beyond the positions it labels, so that both states
know what surrounds them.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm import tasks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The training sample's bounds: documents per language, of all languages together (but for LEAST of
# each), and pieces of a document, evenly spread, with their bytes.
DOCUMENTS = 400
ALL_DOCUMENTS = 16_384
LEAST_DOCUMENTS = 16
PIECES, PIECE_BYTES = 4, 64
HIDDEN = 8
EMBEDDING = 12
# Turns over the sample, and the steps of small samples that take more of them.
EPOCHS, STEPS = 4, 200
BATCH = 128
# Bytes of a lane, and those at its ends that only prepare the states.
LANE, CONTEXT = 512, 32
# Lanes the network reads side by side: their states stay in a core's cache.
CHUNK = 1_024
# Share of the training pieces whose score may lie below what a recognised text needs.
DOUBTFUL = 0.01
UNKNOWN = "und"

_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) + np.float32(0.5) * np.tanh(np.float32(0.5) * x)


@dataclass
class Direction:
    """One gated recurrent unit: gates z, r and candidate n, stacked in this order."""

    table: np.ndarray  # embedding of every byte
    inputs: np.ndarray  # EMBEDDING x 3 HIDDEN
    state: np.ndarray  # HIDDEN x 3 HIDDEN
    bias: np.ndarray  # 3 HIDDEN

    def run(self, codes: np.ndarray, trace: list) -> np.ndarray:
        """States after every position of equally long pieces, (length, pieces, hidden), and what led to them."""
        width = self.state.shape[0]
        known = self.table @ self.inputs + self.bias
        h = np.zeros((len(codes), width), np.float32)
        out = np.empty((*codes.T.shape, width), np.float32)
        for t, step in enumerate(codes.T):
            x, u = known[step], h @ self.state
            gates = _sigmoid(x[:, : 2 * width] + u[:, : 2 * width])
            z, r = gates[:, :width], gates[:, width:]
            n = np.tanh(x[:, 2 * width :] + r * u[:, 2 * width :])
            trace.append((h, z, r, n, u[:, 2 * width :]))
            h = n + z * (h - n)
            out[t] = h
        return out

    def read(self, codes: np.ndarray, live: np.ndarray | None) -> np.ndarray:
        """The same states, (length, hidden, lanes), without a trace.

        Where a lane is not ``live`` its state is zero, as before its first byte.
        """
        width, lanes_ = self.state.shape[0], len(codes)
        half = np.float32(0.5)
        # A gate is half of one and a hyperbolic tangent of half its input; the halves go into the weights.
        scale = np.repeat(np.array([half, half, 1], np.float32), width)
        known = np.ascontiguousarray(((self.table @ self.inputs + self.bias) * scale).T)
        state = np.ascontiguousarray((self.state * scale).T)
        h = np.zeros((width, lanes_), np.float32)
        out = np.empty((codes.shape[1], width, lanes_), np.float32)
        x, u = np.empty((3 * width, lanes_), np.float32), np.empty((3 * width, lanes_), np.float32)
        gates, z, r = x[: 2 * width], x[:width], x[width : 2 * width]
        for t, step in enumerate(np.ascontiguousarray(codes.T)):
            np.matmul(state, h, out=u)
            np.take(known, step, axis=1, out=x, mode="clip")
            gates += u[: 2 * width]
            np.tanh(gates, out=gates)
            gates *= half
            gates += half
            n = r * u[2 * width :]
            n += x[2 * width :]
            np.tanh(n, out=n)
            h = np.subtract(h, n, out=out[t])
            h *= z
            h += n
            if live is not None:
                h *= live[:, t]
        return out

    def learn(self, codes: np.ndarray, trace: list, grads: np.ndarray) -> list[np.ndarray]:
        """Gradients of the four parameters, by going back through time."""
        width = self.state.shape[0]
        state, carried = np.zeros_like(self.state), np.zeros((len(codes), width), np.float32)
        pre = np.empty((*codes.T.shape, 3 * width), np.float32)
        for t in range(codes.shape[1] - 1, -1, -1):
            h, z, r, n, u = trace[t]
            g = grads[t] + carried
            dn = g * (1 - z) * (1 - n * n)
            dz = g * (h - n) * z * (1 - z)
            dr = dn * u * r * (1 - r)
            pre[t] = np.concatenate([dz, dr, dn], axis=1)
            back = np.concatenate([dz, dr, dn * r], axis=1)
            state += h.T @ back
            carried = g * z + back @ self.state.T
        by_byte = np.zeros((256, 3 * width), np.float32)
        np.add.at(by_byte, codes.T.ravel(), pre.reshape(-1, 3 * width))
        return [by_byte @ self.inputs.T, self.table.T @ by_byte, state, by_byte.sum(axis=0)]

    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.inputs, self.state, self.bias]


class Network:
    """Both directions and the labels of every position."""

    def __init__(self, languages: list[str], seed: int = 7) -> None:
        rng = np.random.default_rng(seed)

        def matrix(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0] if shape[0] < 256 else 4)).astype(np.float32)

        self.languages = languages
        # More languages need more to remember.
        self.hidden = HIDDEN * max(1, -(-int(np.ceil(np.sqrt(len(languages)))) // 4))
        # What the score of a recognised text must reach; fitted after training.
        self.least = 0.0
        self.forward, self.backward = (
            Direction(
                matrix(256, EMBEDDING),
                matrix(EMBEDDING, 3 * self.hidden),
                matrix(self.hidden, 3 * self.hidden),
                np.zeros(3 * self.hidden, np.float32),
            )
            for _ in range(2)
        )
        self.out = matrix(2 * self.hidden, len(languages))
        self.bias = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.forward.parameters(), *self.backward.parameters(), self.out, self.bias]

    def _labels(self, states: np.ndarray) -> np.ndarray:
        scores = states @ self.out + self.bias
        scores = np.exp(scores - scores.max(axis=-1, keepdims=True))
        return scores / scores.sum(axis=-1, keepdims=True)

    def positions(self, codes: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
        """Distribution at every position of equally long lanes, (length, languages, lanes)."""
        back = self.backward.read(codes[:, ::-1], None if live is None else live[:, ::-1])[::-1]
        scores = self.out[: self.hidden].T @ self.forward.read(codes, live)
        scores += self.out[self.hidden :].T @ back
        scores += self.bias[:, None]
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def step(self, codes: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy over all positions."""
        ahead: list = []
        behind: list = []
        back = self.backward.run(codes[:, ::-1], behind)[::-1]
        states = np.concatenate([self.forward.run(codes, ahead), back], axis=2)
        wrong = self._labels(states)
        wrong[:, np.arange(len(codes)), labels] -= 1
        wrong /= np.float32(wrong.shape[0] * wrong.shape[1])
        into = wrong @ self.out.T
        first = self.forward.learn(codes, ahead, into[:, :, : self.hidden])
        second = self.backward.learn(codes[:, ::-1], behind, into[::-1, :, self.hidden :])
        out = states.reshape(-1, 2 * self.hidden).T @ wrong.reshape(-1, wrong.shape[2])
        return [*first, *second, out, wrong.sum(axis=(0, 1))]

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean distribution over all positions of every text; zeros for empty ones."""
        sums = np.zeros((len(offsets) - 1, len(self.languages)))
        rows, starts, lengths, first, last = lanes(offsets)
        order = np.argsort(lengths, kind="stable")
        for at in range(0, len(order), CHUNK):
            some = order[at : at + CHUNK]
            size = int(lengths[some].max())
            place = np.arange(size)
            live = place < lengths[some, None]
            codes = data[np.minimum(starts[some, None] + place, len(data) - 1)]
            labels = self.positions(codes, None if live.all() else live)
            counted = (place >= first[some, None]) & (place < last[some, None])
            np.add.at(sums, rows[some], np.einsum("tkn,nt->nk", labels, counted.astype(np.float32)))
        total = sums.sum(axis=1, keepdims=True)
        return np.divide(sums, total, out=np.zeros_like(sums), where=total > 0)


def lanes(offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, length, first and last labelled place) of the lanes that read all texts.

    A text of at most ``LANE`` bytes is one lane; others are read by lanes of that length which overlap
    by twice ``CONTEXT``, the last one pushed back to end with the text.  Every byte is labelled once.
    """
    sizes = np.diff(offsets)
    step = LANE - 2 * CONTEXT
    counts = np.where(sizes > LANE, -(-(sizes - 2 * CONTEXT) // step), np.minimum(sizes, 1))
    rows = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    size = sizes[rows]
    start = np.minimum(number * step, np.maximum(size - LANE, 0))
    first = np.where(number == 0, 0, number * step + CONTEXT)
    last = np.where(number == counts[rows] - 1, size, (number + 1) * step + CONTEXT)
    return rows, offsets[rows] + start, np.minimum(size, LANE), first - start, last - start


def train(pieces: list[bytes], labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """A network fitted by Adam on batches of equally long pieces; the same input gives the same network."""
    network, rng = Network(languages, seed), np.random.default_rng(seed)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    by_length = {int(n): np.flatnonzero(lengths == n) for n in np.unique(lengths)}
    first = [np.zeros_like(p) for p in network.parameters()]
    second = [np.zeros_like(p) for p in network.parameters()]
    turns = 0
    epochs = max(EPOCHS, -(-STEPS // sum(-(-len(rows) // BATCH) for rows in by_length.values())))
    for epoch in range(epochs):
        batches = []
        for rows in by_length.values():
            rows = rng.permutation(rows)
            batches += [rows[i : i + BATCH] for i in range(0, len(rows), BATCH)]
        for at in rng.permutation(len(batches)):
            rows = batches[at]
            codes = np.frombuffer(b"".join([pieces[i] for i in rows]), np.uint8).reshape(len(rows), -1)
            turns += 1
            rate = 0.01 * (1 - epoch / epochs) * np.sqrt(1 - 0.999**turns) / (1 - 0.9**turns)
            for p, g, m, v in zip(network.parameters(), network.step(codes, labels[rows]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    # Half way between knowing nothing and what all but few of the pieces reach.
    own = network.probabilities(*tasks.flat(pa.array(pieces, pa.binary())))[np.arange(len(labels)), labels]
    nothing = 1 / len(languages)
    network.least = (nothing + max(nothing, float(np.quantile(own, DOUBTFUL)))) / 2 if len(languages) > 1 else 0.0
    return network


def held_out(key: str) -> F.Column:
    """Rows that training never sees."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def training_pieces(df: DataFrame, key: str, text: str, label: str) -> list[tuple[str, bytes]]:
    """(language, piece) pairs of a bounded sample of every language's rows.

    The rows with the smallest hashes of key and text are taken, repeated rows once, and in each the
    pieces at evenly spread places.
    """
    hashed = F.xxhash64(F.col(key).cast("string"), F.col(text).cast("string"))
    labelled = df.filter(F.col(label).isNotNull() & F.col(text).isNotNull() & ~held_out(key)).select(
        F.col(label).cast("string").alias("lang"), F.col(text).cast("string").alias("whole"), hashed.alias("hash")
    )
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return []
    most = max(LEAST_DOCUMENTS, min(DOCUMENTS, ALL_DOCUMENTS // len(counts)))
    # Hashes that about four times as many rows have as are wanted: no language's rows meet in one task.
    bounds = [F.when(F.col("lang") == lang, min(1 << 30, (4 * most << 30) // n + 1)) for lang, n in sorted(counts.items())]
    order = Window.partitionBy("lang").orderBy("hash")
    chosen = (
        labelled.filter(F.pmod("hash", F.lit(1 << 30)) < F.coalesce(*bounds))
        .select("lang", "hash")
        .distinct()
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= most)
    )
    hashes = [r["hash"] for r in chosen.collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, found = [], []
            for lang, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = whole.encode()
                count = min(PIECES, -(-len(data) // PIECE_BYTES))
                spread = max(0, len(data) - PIECE_BYTES) / max(1, count - 1)
                found += [data[int(i * spread) : int(i * spread) + PIECE_BYTES] for i in range(count)]
                langs += [lang] * count
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(found, pa.binary())], names=["lang", "piece"]
            )

    rows = labelled.filter(F.col("hash").isin(hashes)).dropDuplicates(["lang", "hash"]).select("lang", "whole")
    return sorted((r["lang"], bytes(r["piece"])) for r in rows.mapInArrow(run, "lang string, piece binary").collect())


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score) of every row.

    The network learns from the text and non-null ``label`` of rows whose crc32(key as text) mod 4 is
    not 2, a bounded sample of them (see ``training_pieces``); predictions read the text alone.  Texts
    that are null or have no letter are ``und`` with score 0.  Without any label to learn from every
    text is ``und``.  Null keys count as not held out; repeated rows are judged alike; an empty table
    gives no rows; columns other than the three are not read.
    """
    judged = _judge(df, [key], key, text, label)
    return judged.select(key, held_out(key).alias("held_out"), "lang_pred", "score")


def recognised(
    df: DataFrame, least: float | None = None, key: str = "doc_id", text: str = "text", label: str = "lang"
) -> DataFrame:
    """The rows of ``df`` whose language is told with a score of at least ``least``, columns unchanged.

    Without ``least`` it is fitted: half way between an even guess and the score that all but
    ``DOUBTFUL`` of the training pieces reach.  Texts that are null or without a letter go; without any
    label to learn from all rows go; repeated rows stay or go alike; an empty table stays empty.
    """
    return _judge(df, df.columns, key, text, label, True, least)


def _judge(
    df: DataFrame,
    columns: list[str],
    key: str,
    text: str,
    label: str,
    only: bool = False,
    least: float | None = None,
) -> DataFrame:
    """``columns`` with lang_pred and score; with ``only`` the recognised rows' columns alone."""
    pairs = training_pieces(df, key, text, label)
    languages = sorted({lang for lang, _ in pairs})
    network = None
    if languages:
        places = {lang: i for i, lang in enumerate(languages)}
        labels = np.array([places[lang] for lang, _ in pairs], dtype=np.int64)
        network = train([piece for _, piece in pairs], labels, languages)
    # Some kilobytes: the parameters do not depend on the data but for the number of languages.
    shared = tasks.Shared(df.sparkSession, network)
    source = "judged text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for part in tasks.slices(batch, batch.num_columns - 1, 1 << 20):
                if net is None:
                    names, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                else:
                    column = part.column(part.num_columns - 1)
                    chances = net.probabilities(*tasks.flat(column))
                    best = chances.argmax(axis=1)
                    lettered = [bool(t) and has_letter(t) for t in column.to_pylist()]
                    names = [net.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
                    scores = np.where(lettered, chances.max(axis=1), 0.0)
                arrays = [part.column(i) for i in range(part.num_columns - 1)]
                if only:
                    floor = net.least if least is None and net is not None else least or 0.0
                    kept_rows = [n != UNKNOWN and s >= floor for n, s in zip(names, scores, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(kept_rows, pa.bool_()))
                    continue
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(names, pa.string()), pa.array(scores)],
                    names=[*columns, "lang_pred", "score"],
                )

    rows = df.select(*[F.col(c) for c in columns], F.col(text).cast("string").alias(source))
    if only:
        return rows.mapInArrow(run, df.select(*columns).schema)
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double")
