"""Toxicity: a bidirectional gated recurrent network with attention pooling over characters and words, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratelight.llm.common import U64, WORDS_AND_MARKS, Tokens, mix, pieces_of, table, text_bytes, tokens

WINDOW, STRIDE = 32, 24  # words; neighbouring windows share WINDOW - STRIDE
BUCKETS, WIDTH, UNITS = 1 << 13, 12, 12
ROWS_PER_CLASS = 2000  # bound of the labelled sample, for each class
ROUNDS, BATCH, RATE, WORD_DROP = 8, 128, 6e-3, 0.3
HELD_OUT_MOD, HELD_OUT_REST = 5, 0
LETTERS = np.where(WORDS_AND_MARKS == 1, 1, 0).astype(np.uint8)
AT_ONCE, WORDS_AT_ONCE = 1024, 20_000


@dataclass
class Vocabulary:
    """The distinct words of some texts: word bucket, character trigrams (flat, with where a word's begin)."""

    word: np.ndarray
    grams: np.ndarray
    begin: np.ndarray

    def inputs(self, words: np.ndarray, chars: np.ndarray, some: np.ndarray, drop: np.ndarray | None = None):
        """[word embedding; characters' embeddings summed over the root of their number] of the words ``some``."""
        word, n = self.word[some], self.begin[some + 1] - self.begin[some]
        begin = np.concatenate([[0], np.cumsum(n)])
        flat = self.grams[np.repeat(self.begin[some] - begin[:-1], n) + np.arange(begin[-1])]
        scale = (1 / np.sqrt(np.diff(begin))).astype(np.float32)[:, None]
        left = words[word]
        if drop is not None:
            left = left * drop[:, None]
        right = np.add.reduceat(chars[flat], begin[:-1], axis=0) * scale if len(word) else np.zeros((0, WIDTH), np.float32)
        return np.hstack([left, right]), word, flat, begin, scale


def read(texts) -> tuple[Tokens, Vocabulary, np.ndarray]:
    """The texts' words in lower case, their vocabulary, and the index in it of every word."""
    data, bounds = text_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    found = tokens(data, bounds, LETTERS)
    hashes, first, index = np.unique(found.hashes, return_index=True, return_inverse=True)
    kind = LETTERS[data]
    ends = np.searchsorted(np.flatnonzero(kind == 0), found.starts[first]) if len(data) else np.zeros(0, np.int64)
    stops = np.append(np.flatnonzero(kind == 0), len(data))
    start = found.starts[first]
    following = np.append(found.starts, len(data))[first + 1] if len(first) else start
    lengths = np.minimum(stops[ends] if len(first) else start, following) - start
    begin = np.concatenate([[0], np.cumsum(lengths)])
    grams = np.empty(begin[-1], np.int32)
    for i in range(0, len(start), WORDS_AT_ONCE):
        own, local = lengths[i : i + WORDS_AT_ONCE], begin[i : i + WORDS_AT_ONCE + 1] - begin[i]
        here = data[np.repeat(start[i : i + WORDS_AT_ONCE] - local[:-1], own) + np.arange(local[-1])].astype(U64)
        before, after = np.zeros_like(here), np.zeros_like(here)
        before[1:], after[:-1] = here[:-1], here[1:]
        before[local[:-1]] = 0
        after[local[1:] - 1] = 0
        grams[begin[i] : begin[i] + local[-1]] = mix((before << U64(16)) | (here << U64(8)) | after | U64(1 << 40)) >> U64(64 - 13)
    return found, Vocabulary((hashes >> U64(64 - 13)).astype(np.int64), grams, begin), index.astype(np.int32)


def cut(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, first word) of every window: each STRIDE words, the last one flush with the end. Texts without words have none."""
    n = np.where(counts > WINDOW, -(-(counts - WINDOW) // STRIDE) + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), n)
    k = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return text, np.minimum(k * STRIDE, np.maximum(counts[text] - WINDOW, 0))


@dataclass
class Network:
    weights: dict[str, np.ndarray]
    slope: float = 1.0
    offset: float = 0.0

    @staticmethod
    def fresh(seed: int) -> Network:
        rng = np.random.default_rng(seed)
        normal = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        return Network({
            "words": normal(0.1, BUCKETS, WIDTH), "chars": normal(0.1, BUCKETS, WIDTH), "in": normal(0.3, 2 * WIDTH, 6 * UNITS),
            "bias": np.zeros(6 * UNITS, np.float32), "turn": normal(0.3, 2, 3 * UNITS, UNITS), "look": normal(0.1, 2 * UNITS),
            "out": normal(0.3, 2 * UNITS), "out_bias": np.zeros(1, np.float32),
        })

    def gates(self, inputs: np.ndarray) -> np.ndarray:
        """What each word adds to the gates: both directions' reset, update and candidate."""
        return inputs @ self.weights["in"] + self.weights["bias"]

    def gates_of(self, vocabulary: Vocabulary) -> np.ndarray:
        """The gates of every word of a vocabulary."""
        out = np.empty((len(vocabulary.word), 6 * UNITS), np.float32)
        for i in range(0, len(out), WORDS_AT_ONCE):
            some = np.arange(i, min(i + WORDS_AT_ONCE, len(out)))
            out[some] = self.gates(vocabulary.inputs(self.weights["words"], self.weights["chars"], some)[0])
        return out

    def forward(self, gates: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Logits of windows from their words' gates (step, 2, 3 * UNITS, window). ``keep``: also what ``backward`` needs."""
        w, (steps, _, _, n), u = self.weights, gates.shape, UNITS
        states = np.empty((steps, 2, u, n), np.float32)
        state, trail = np.zeros((2, u, n), np.float32), []
        short = bool((lengths < steps).any())
        now = np.empty((2, 3 * u, n), np.float32)
        for t in range(steps):
            now[0], now[1] = gates[t, 0], gates[steps - 1 - t, 1]
            turned = np.matmul(w["turn"], state)
            both = np.tanh((now[:, : 2 * u] + turned[:, : 2 * u]) * np.float32(0.5))
            both *= np.float32(0.5)
            both += np.float32(0.5)
            reset, update = both[:, :u], both[:, u:]
            candidate = np.tanh(now[:, 2 * u :] + reset * turned[:, 2 * u :])
            new = state - candidate
            new *= update
            new += candidate
            if short:  # the backward pass starts in the padding
                new[1] *= (steps - 1 - t) < lengths
            if keep:
                trail.append((state, turned[:, 2 * u :], reset, update, candidate))
            state = new
            states[t, 0], states[steps - 1 - t, 1] = new[0], new[1]
        flat = states.reshape(steps, 2 * u, n)
        glance = np.einsum("tun,u->tn", flat, w["look"], optimize=True)
        if short:
            glance[np.arange(steps)[:, None] >= lengths] = -1e9
        glance = np.exp(glance - glance.max(0))
        glance /= glance.sum(0)
        pooled = np.einsum("tun,tn->un", flat, glance)
        logit = w["out"] @ pooled + w["out_bias"]
        return (logit, (flat, glance, pooled, trail, short)) if keep else logit

    def backward(self, kept, lengths: np.ndarray, slope: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights behind the gates, and of the gates, for the loss's ``slope`` in each logit."""
        w, u = self.weights, UNITS
        flat, glance, pooled, trail, short = kept
        steps, _, n = flat.shape
        d = {"out": pooled @ slope, "out_bias": slope.sum(keepdims=True), "turn": np.zeros_like(w["turn"])}
        d_pooled = w["out"][:, None] * slope
        d_glance = np.einsum("tun,un->tn", flat, d_pooled)
        d_score = glance * (d_glance - (glance * d_glance).sum(0))
        d["look"] = np.einsum("tun,tn->u", flat, d_score)
        d_states = (glance[:, None] * d_pooled + w["look"][:, None] * d_score[:, None]).reshape(steps, 2, u, n)
        d_gates = np.empty((steps, 2, 3 * u, n), np.float32)
        d_state = np.zeros((2, u, n), np.float32)
        back = np.swapaxes(w["turn"], 1, 2)
        for t in reversed(range(steps)):
            before, turned, reset, update, candidate = trail[t]
            d_new = d_state
            d_new[0] += d_states[t, 0]
            d_new[1] += d_states[steps - 1 - t, 1]
            if short:
                d_new[1] *= (steps - 1 - t) < lengths
            d_update = d_new * (before - candidate) * update * (1 - update)
            d_candidate = d_new * (1 - update) * (1 - candidate * candidate)
            d_reset = d_candidate * turned * reset * (1 - reset)
            d_turned = np.concatenate([d_reset, d_update, d_candidate * reset], axis=1)
            d_now = np.concatenate([d_reset, d_update, d_candidate], axis=1)
            d["turn"] += np.matmul(d_turned, np.swapaxes(before, 1, 2))
            d_state = d_new * update + np.matmul(back, d_turned)
            d_gates[t, 0], d_gates[steps - 1 - t, 1] = d_now[0], d_now[1]
        return d, d_gates

    def windows(self, gates: np.ndarray, index: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Logits of windows of a list of words: ``index`` holds each word's row of ``gates``."""
        out = np.empty(len(starts), np.float32)
        order = np.argsort(lengths, kind="stable")
        for i in range(0, len(order), AT_ONCE):
            some = order[i : i + AT_ONCE]
            steps = int(lengths[some].max())
            rows = index[np.minimum(starts[some] + np.arange(steps)[:, None], len(index) - 1)]
            own = gates[rows].reshape(steps, len(some), 2, 3 * UNITS).transpose(0, 2, 3, 1)
            out[some] = self.forward(own, lengths[some])
        return out

    def texts(self, texts) -> np.ndarray:
        """The largest logit among each text's windows; minus infinity for a text without words."""
        found, vocabulary, index = read(texts)
        counts = found.counts()
        text, first = cut(counts)
        top = np.full(len(counts), -np.inf)
        if len(text):
            logits = self.windows(self.gates_of(vocabulary), index, found.bounds[text] + first, np.minimum(counts[text], WINDOW))
            np.maximum.at(top, text, logits)
        return top

    def chance(self, texts) -> np.ndarray:
        """The calibrated probability of each text; 0 for a text without words."""
        top = self.texts(texts)
        return np.where(np.isfinite(top), 1 / (1 + np.exp(-np.clip(self.slope * np.where(np.isfinite(top), top, 0) + self.offset, -60, 60))), 0.0)


def train(texts: list[str], toxic: np.ndarray, seed: int = 7) -> Network:
    """A text is toxic if one of its windows is, but only texts are labelled. So each round takes the window of each text that
    the network finds most toxic, and of the clean ones a random one too; the first round takes random ones of all."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    found, vocabulary, index = read(pa.array(texts, pa.string()))
    counts = found.counts()
    text, first = cut(counts)
    starts, lengths = found.bounds[text] + first, np.minimum(counts[text], WINDOW)
    w = net.weights
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    step = 0
    heads = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.zeros(0, np.int64)
    for round_ in range(ROUNDS):
        lot = rng.random(len(text))
        chosen = [_tops(lot, heads), _tops(rng.random(len(text)), heads)]
        if round_:
            logits = net.windows(net.gates_of(vocabulary), index, starts, lengths)
            top = _tops(logits, heads)
            chosen = [top, chosen[0][~toxic[text[chosen[0]]]]]
        picked = rng.permutation(np.concatenate(chosen))
        for i in range(0, len(picked), BATCH):
            some = picked[i : i + BATCH]
            steps = int(lengths[some].max())
            rows = index[np.minimum(starts[some] + np.arange(steps)[:, None], len(index) - 1)]
            own, place = np.unique(rows, return_inverse=True)
            place = place.reshape(rows.shape)
            drop = (rng.random(len(own)) > WORD_DROP).astype(np.float32)
            inputs, word, flat, begin, scale = vocabulary.inputs(w["words"], w["chars"], own, drop)
            gates = net.gates(inputs)[place].reshape(steps, len(some), 2, 3 * UNITS).transpose(0, 2, 3, 1)
            logit, kept = net.forward(gates, lengths[some], keep=True)
            slope = ((1 / (1 + np.exp(-logit)) - toxic[text[some]]) / len(some)).astype(np.float32)
            d, d_gates = net.backward(kept, lengths[some], slope)
            rows_of = d_gates.transpose(0, 3, 1, 2).reshape(-1, 6 * UNITS)
            order = np.argsort(place.ravel(), kind="stable")
            bounds = np.searchsorted(place.ravel()[order], np.arange(len(own)))
            d_own = np.add.reduceat(rows_of[order], bounds, axis=0)
            d["in"], d["bias"] = inputs.T @ d_own, d_own.sum(0)
            d_in = d_own @ w["in"].T
            d["words"], d["chars"] = np.zeros_like(w["words"]), np.zeros_like(w["chars"])
            np.add.at(d["words"], word, d_in[:, :WIDTH] * drop[:, None])
            np.add.at(d["chars"], flat, np.repeat(d_in[:, WIDTH:] * scale, np.diff(begin), axis=0))
            step += 1
            rate = RATE * (1 - 0.8 * round_ / ROUNDS)
            for k, g in d.items():
                a, b = moment[k]
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                w[k] -= rate * ((a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6) + 1e-3 * w[k]).astype(np.float32)
    if len(text):
        logits = net.windows(net.gates_of(vocabulary), index, starts, lengths)
        top = np.maximum.reduceat(logits, heads)
        net.slope, net.offset = _calibrate(top.astype(np.float64), toxic[text[heads]].astype(np.float64))
    return net


def _tops(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The index of the largest value of each run that starts at ``heads``."""
    if not len(heads):
        return heads
    run = np.zeros(len(values), np.int64)
    run[heads[1:]] = 1
    run = np.cumsum(run)
    order = np.lexsort((values, run))
    return order[np.append(heads[1:], len(values)) - 1]


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic regression, kept finite by a weak pull to (1, 0)."""
    at = np.array([1.0, 0.0])
    z = np.stack([x, np.ones_like(x)])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(at @ z, -30, 30)))
        gradient = z @ (p - y) + 0.1 * (at - [1, 0])
        curve = (z * (p * (1 - p))) @ z.T + 0.1 * np.eye(2)
        at = at - np.linalg.solve(curve, gradient)
        at[0] = max(at[0], 0.05)
    return float(at[0]), float(at[1])


def held_out(mod: int = HELD_OUT_MOD, rest: int = HELD_OUT_REST):
    """Whether crc32 of the id as text leaves ``rest``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % mod == rest


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Network | None:
    """Trains on at most ``rows_per_class`` labelled texts of each class, chosen by a hash of the id; held-out ids are never
    used. None unless both classes have a text. The sample is bounded, so it is trained on where it is gathered."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("toxic") == value).orderBy(*order).limit(rows_per_class)
        chosen = part if chosen is None else chosen.union(part)
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    toxic, texts = rows.toxic.to_numpy().astype(bool), list(rows.text)
    del rows
    if not toxic.any() or toxic.all():
        return None
    return train(texts, toxic)


def score(docs: DataFrame, net: Network | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``score`` and ``predicted``: the probability that a whole text is toxic, over all
    its windows, and 1 if it is 0.5 or more. The names of these two must not be among ``keep``.

    Null texts, texts without a word (a run of letters and digits) and all texts without a network have score 0. Repeated
    rows are scored alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("score", T.DoubleType())])

    def run(batches):
        net = shared.value
        for batch in batches:
            for part in pieces_of(batch, 2 << 20):
                chance = np.zeros(len(part)) if net is None else net.chance(part.column("text"))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(chance)], schema.names)

    return docs.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_gru_attention(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity, learned from the labels that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    net = fit(docs, table(spark, folder, "labels").select("doc_id", "toxic"))
    return score(docs, net, ["doc_id"]).withColumn("held_out", held_out()).select("doc_id", "held_out", "score", "predicted")
