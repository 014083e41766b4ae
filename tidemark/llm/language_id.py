"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads texts in pieces of equal length in both directions and gives every byte a distribution over
languages; a document's distribution pools those of all its bytes. It is trained here in numpy by backpropagation
through time, on a bounded sample of labelled pieces. All pieces of a batch are read in lockstep, so long texts
cost what their bytes cost, and memory is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import as_bytes, bound_batches

# Bytes of a piece; hidden units of each direction; pieces read together.
PIECE, HIDDEN, TOGETHER = 64, 8, 2048
# The labelled sample: pieces of each language, one from a text. Training passes, batch and step size.
SAMPLE, EPOCHS, BATCH, RATE = 3000, 8, 128, 0.01
HELD_OUT = 2


def held_out(key: str) -> F.Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): the network's squashing function, in place. Its slope is (1 - |y|) ** 2 at the value y."""
    size = np.abs(x)
    size += 1
    x /= size
    return x


def _open(x: np.ndarray) -> np.ndarray:
    """A gate: the squashing function moved to 0 to 1, in place. Its slope is (1 - |2y - 1|) ** 2 / 2."""
    _squash(x)
    x *= 0.5
    x += 0.5
    return x


class Network:
    """Weights of both directions, f and b, and of the output.

    Each direction has a reset gate r, an update gate u and a candidate c, with inputs by byte and recurrent
    weights. The gates' matrices are apart, so that every operation runs over contiguous memory.
    """

    def __init__(self, labels: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.weights = {}
        for part in ("fr", "fu", "fc", "br", "bu", "bc"):
            self.weights[f"{part}_in"] = rng.normal(0, 0.5, (256, HIDDEN)).astype(np.float32)
            self.weights[f"{part}_old"] = rng.normal(0, 0.4, (HIDDEN, HIDDEN)).astype(np.float32)
        self.weights["out"] = rng.normal(0, 0.4, (2 * HIDDEN, len(labels))).astype(np.float32)
        self.weights["bias"] = np.zeros(len(labels), np.float32)

    def _read(self, side: str, pieces: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States after each byte, in reading order, as (steps, pieces, units); pieces are (steps, pieces)."""
        r_in, r_old, u_in, u_old, c_in, c_old = (self.weights[f"{side}{k}"] for k in ("r_in", "r_old", "u_in", "u_old", "c_in", "c_old"))
        steps, n = pieces.shape
        states = np.empty((steps, n, HIDDEN), r_in.dtype)
        state = np.zeros((n, HIDDEN), r_in.dtype)
        for t in range(steps):
            byte = pieces[t]
            reset = state @ r_old
            reset += r_in.take(byte, axis=0)
            _open(reset)
            update = state @ u_old
            update += u_in.take(byte, axis=0)
            _open(update)
            candidate = (reset * state) @ c_old
            candidate += c_in.take(byte, axis=0)
            _squash(candidate)
            if trace is not None:
                trace.append((state, reset, update, candidate))
            after = np.subtract(state, candidate, out=states[t])
            after *= update
            after += candidate
            state = after
        return states

    def log_probabilities(self, pieces: np.ndarray) -> np.ndarray:
        """Log-distribution over labels at each byte: (labels, steps, pieces)."""
        out = self.weights["out"]
        flat = (-1, HIDDEN)
        scores = self._read("f", pieces).reshape(flat) @ out[:HIDDEN]
        scores += self._read("b", pieces[::-1])[::-1].reshape(flat) @ out[HIDDEN:]
        scores += self.weights["bias"]
        scores = scores.T.copy()
        scores -= np.log(np.exp(scores).sum(axis=0))
        return scores.reshape(-1, *pieces.shape)

    def gradients(self, pieces: np.ndarray, real: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all real bytes, by backpropagation through time."""
        out = self.weights["out"]
        traces: dict[str, list] = {"f": [], "b": []}
        forward = self._read("f", pieces, traces["f"])
        backward = self._read("b", pieces[::-1], traces["b"])[::-1]
        both = np.concatenate([forward, backward], axis=2)
        scores = both @ out + self.weights["bias"]
        scores -= scores.max(axis=2, keepdims=True)
        error = np.exp(scores)
        error /= error.sum(axis=2, keepdims=True)
        error[:, np.arange(len(truth)), truth] -= 1
        error *= (real / real.sum())[:, :, None]
        n_units, n_labels = out.shape
        found = {"out": both.reshape(-1, n_units).T @ error.reshape(-1, n_labels), "bias": error.sum(axis=(0, 1))}
        back = error @ out.T
        for side, read, part in (("f", pieces, back[:, :, :HIDDEN]), ("b", pieces[::-1], back[::-1, :, HIDDEN:])):
            found |= self._through_time(side, read, traces[side], part)
        return found

    def _through_time(self, side: str, pieces: np.ndarray, trace: list, upper: np.ndarray) -> dict[str, np.ndarray]:
        old = {k: self.weights[f"{side}{k}_old"] for k in "ruc"}
        d_old = {k: np.zeros_like(v) for k, v in old.items()}
        d_step = {k: np.empty(upper.shape, upper.dtype) for k in "ruc"}
        carried = np.zeros_like(upper[0])
        for t in range(len(trace) - 1, -1, -1):
            state, reset, update, candidate = trace[t]
            d_state = carried + upper[t]
            d_c = d_state * (1 - update) * (1 - np.abs(candidate)) ** 2
            d_u = d_state * (state - candidate) * (1 - np.abs(2 * update - 1)) ** 2 / 2
            d_product = d_c @ old["c"].T
            d_r = d_product * state * (1 - np.abs(2 * reset - 1)) ** 2 / 2
            d_old["r"] += state.T @ d_r
            d_old["u"] += state.T @ d_u
            d_old["c"] += (reset * state).T @ d_c
            for k, d in (("r", d_r), ("u", d_u), ("c", d_c)):
                d_step[k][t] = d
            carried = d_state * update + d_product * reset + d_r @ old["r"].T + d_u @ old["u"].T
        flat = pieces.ravel()
        found = {f"{side}{k}_old": d for k, d in d_old.items()}
        for k, d in d_step.items():
            found[f"{side}{k}_in"] = np.stack([np.bincount(flat, d[:, :, u].ravel(), 256) for u in range(HIDDEN)], axis=1)
        return found

    def train(self, texts: list[bytes], truth: list[str], seed: int = 7) -> Network:
        """Adam steps over shuffled batches of pieces."""
        rng = np.random.default_rng(seed)
        pieces = np.zeros((len(texts), PIECE), np.uint8)
        real = np.zeros((len(texts), PIECE), np.float32)
        for i, text in enumerate(texts):
            part = text[:PIECE]
            pieces[i, : len(part)] = np.frombuffer(part, np.uint8)
            real[i, : len(part)] = 1
        target = np.array([self.labels.index(x) for x in truth], np.int64)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        n_steps = EPOCHS * -(-len(texts) // BATCH)
        for _ in range(EPOCHS):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                found = self.gradients(pieces[rows].T.astype(np.int64), real[rows].T, target[rows])
                step += 1
                rate = RATE * (1 - 0.9 * step / n_steps)
                for k, g in found.items():
                    g = np.clip(g, -1, 1)
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    mean, spread = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
                    self.weights[k] -= (rate * mean / (np.sqrt(spread) + 1e-8)).astype(np.float32)
        return self

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean log-distribution over all bytes of each text, as a distribution; every byte is read once."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(x) for x in texts], np.int64)
        n_pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), n_pieces)
        begin = np.cumsum(sizes) - sizes
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        start = begin[owner] + nth * PIECE
        total = np.zeros((len(texts), len(self.labels)))
        padded = np.concatenate([data, np.zeros(PIECE, np.uint8)])
        steps = np.arange(PIECE)[:, None]
        for at in range(0, len(owner), TOGETHER):
            own, first = owner[at : at + TOGETHER], start[at : at + TOGETHER]
            place = steps + first
            real = place < (begin + sizes)[own]
            pieces = np.where(real, padded[place], 0)
            scores = self.log_probabilities(pieces)
            scores *= real
            np.add.at(total, own, scores.sum(axis=1).T)
        total /= np.maximum(sizes, 1)[:, None]
        odds = np.exp(total - total.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)


def labelled_sample(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", size: int = SAMPLE
) -> list[tuple[bytes, str]]:
    """At most ``size`` pieces of each language from documents that aren't held out, chosen by a hash.

    A piece begins at a random place of its text, so it may come from anywhere. Texts without a language or without
    any letter give none.
    """
    whole = F.col(text).cast("string")
    chance = F.xxhash64(F.col(key).cast("string"), whole)
    place = 1 + F.pmod(F.xxhash64(chance, F.lit(1)), F.greatest(F.char_length(whole) - PIECE // 2, F.lit(1)))
    usable = docs.where(~held_out(key) & F.col(lang).isNotNull() & whole.isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), chance.alias("chance"), F.substring(whole, place.cast("int"), F.lit(PIECE)).alias("piece")
    )
    usable = usable.where(F.col("piece").rlike(r"\p{L}"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("chance", "piece"))
    rows = usable.withColumn("nth", nth).where(F.col("nth") <= size).select("lang", "piece").collect()
    return sorted((r.piece.encode(), r.lang) for r in rows)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", size: int = SAMPLE) -> Network | None:
    """The network for the languages of docs; None if no text can be learned from."""
    sample = labelled_sample(docs, key, text, lang, size)
    if not sample:
        return None
    return Network(sorted({x for _, x in sample})).train([x for x, _ in sample], [x for _, x in sample])


def predict(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: key, held_out, lang_pred, score (pooled probability of the language).

    A text that is null or has no letter, and any text if nothing could be learned, is ``und`` with score 0.
    Repeated rows and null keys (never held out) give a row each; an empty table gives none.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)
    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    arrow = [to_arrow_type(f.dataType) for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lettered = np.array(batch.column(2).to_pylist(), bool)
            names, scores = np.full(len(lettered), "und", object), np.zeros(len(lettered))
            texts = as_bytes(batch.column(3))
            rows = np.flatnonzero(lettered)
            if model is not None and len(rows):
                pooled = model.pooled([texts[i] for i in rows])
                names[rows] = np.array(model.labels, object)[pooled.argmax(axis=1)]
                scores[rows] = pooled.max(axis=1)
            columns = [pa.array(names, arrow[2]), pa.array(scores, arrow[3])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema.names)

    whole = F.col(text).cast("string")
    source = docs.select(
        F.col(key).alias("key"), held_out(key).alias("held_out"), F.coalesce(whole.rlike(r"\p{L}"), F.lit(False)).alias("lettered"), whole.alias("text")
    )
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)


def identify(docs: DataFrame) -> DataFrame:
    """Train on the labelled documents that aren't held out, and predict all."""
    return predict(docs, train(docs))
