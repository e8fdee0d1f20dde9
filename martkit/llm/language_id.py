"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded
sample of labelled rows. It reads every text whole, in windows of ``WINDOW``
bytes, and labels every byte position; a document's probabilities are the mean
over its positions. The sample is bounded by parameters, everything else runs
inside the tasks that hold the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.common import unused
from martkit.llm.tokens import lowered

WINDOW = 64  # bytes the network reads at a stretch
BLOCK = 4096  # windows computed together
PAD = 0  # no text byte is 0 after the shift below, so it marks the end of a text
MAX_LANGUAGES = 64


class Gru:
    """Weights of one direction; arrays are (units, windows), so every step is contiguous."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        scale = 1 / np.sqrt(hidden)
        self.gates_in = rng.normal(0, 0.3, (2 * hidden, 256)).astype(np.float32)  # a byte's input is one column
        self.gates_on = rng.normal(0, scale, (2 * hidden, hidden)).astype(np.float32)
        self.new_in = rng.normal(0, 0.3, (hidden, 256)).astype(np.float32)
        self.new_on = rng.normal(0, scale, (hidden, hidden)).astype(np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.gates_in, self.gates_on, self.new_in, self.new_on]

    def run(self, steps: np.ndarray, keep: bool = False):
        """States before the first and after every step of (time, window) bytes; with ``keep`` what backward needs."""
        time, windows = steps.shape
        hidden = len(self.new_on)
        states = np.zeros((time + 1, hidden, windows), np.float32)
        kept = []
        for t in range(time):
            before = states[t]
            # sigmoid(x) as (1 + tanh(x / 2)) / 2: one vector function for all gates
            gates = self.gates_on @ before
            gates += np.take(self.gates_in, steps[t], axis=1)
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            update, reset = gates[:hidden], gates[hidden:]
            new = self.new_on @ (reset * before)
            new += np.take(self.new_in, steps[t], axis=1)
            np.tanh(new, out=new)
            np.add(before, update * (new - before), out=states[t + 1])
            if keep:
                kept.append((update, reset, new))
        return states, kept

    def backward(self, steps: np.ndarray, states: np.ndarray, kept, into: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weights from those of all states, last step first."""
        grads = [np.zeros_like(w) for w in self.weights()]
        carry = np.zeros_like(states[0])
        for t in range(len(kept) - 1, -1, -1):
            update, reset, new = kept[t]
            before = states[t]
            here = into[t] + carry
            d_new = here * update * (1 - new * new)
            d_kept = self.new_on.T @ d_new
            d_update = here * (new - before) * update * (1 - update)
            d_reset = d_kept * before * reset * (1 - reset)
            d_gates = np.concatenate([d_update, d_reset])
            np.add.at(grads[0].T, steps[t], d_gates.T)
            grads[1] += d_gates @ before.T
            np.add.at(grads[2].T, steps[t], d_new.T)
            grads[3] += d_new @ (reset * before).T
            carry = here * (1 - update) + d_kept * reset + self.gates_on.T @ d_gates
        return grads


class Network:
    """Forward and backward recurrent layers and one softmax per position."""

    def __init__(self, languages: list[str], hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.back = Gru(rng, hidden), Gru(rng, hidden)
        self.out_ahead = rng.normal(0, 0.3, (len(languages), hidden)).astype(np.float32)
        self.out_back = rng.normal(0, 0.3, (len(languages), hidden)).astype(np.float32)
        self.bias = np.zeros((len(languages), 1), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [*self.ahead.weights(), *self.back.weights(), self.out_ahead, self.out_back, self.bias]

    def _read(self, steps: np.ndarray, keep: bool = False):
        """Both layers and the (time, language, window) probabilities."""
        ahead, back = self.ahead.run(steps, keep), self.back.run(steps[::-1], keep)
        prob = self.out_ahead @ ahead[0][1:]
        prob += self.out_back @ back[0][:0:-1]
        prob += self.bias
        prob -= prob.max(axis=1, keepdims=True)
        np.exp(prob, out=prob)
        prob /= prob.sum(axis=1, keepdims=True)
        return ahead, back, prob

    def probabilities(self, steps: np.ndarray) -> np.ndarray:
        return self._read(steps)[2]

    def gradients(self, steps: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all positions with text, and its gradients."""
        ahead, back, prob = self._read(steps, keep=True)
        weight = (steps != PAD).astype(np.float32)
        weight /= max(1.0, weight.sum())
        windows = np.arange(steps.shape[1])
        loss = -float((np.log(prob[:, labels, windows] + 1e-12) * weight).sum())
        prob[:, labels, windows] -= 1
        d = prob * weight[:, None, :]
        by_ahead, by_back = ahead[0][1:], back[0][:0:-1]
        return loss, [
            *self.ahead.backward(steps, *ahead, self.out_ahead.T @ d),
            *self.back.backward(steps[::-1], *back, (self.out_back.T @ d)[::-1]),
            np.einsum("tlw,thw->lh", d, by_ahead),
            np.einsum("tlw,thw->lh", d, by_back),
            d.sum(axis=(0, 2))[:, None],
        ]


def windows_of(data: bytes) -> np.ndarray:
    """(windows, WINDOW) bytes of a text; byte 0 of the text counts as 1, the end is padded."""
    raw = np.maximum(lowered(data), 1)
    count = max(1, -(-len(raw) // WINDOW))
    out = np.full(count * WINDOW, PAD, np.uint8)
    out[: len(raw)] = raw
    return out.reshape(count, WINDOW)


def train(
    windows: np.ndarray, labels: np.ndarray, languages: list[str], hidden: int = 8, steps: int = 400,
    batch: int = 256, rate: float = 0.03, seed: int = 7,
) -> Network:
    """Network fitted with Adam; the same sample always gives the same weights."""
    net = Network(languages, hidden, seed)
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    per_language = [np.flatnonzero(labels == k) for k in range(len(languages))]
    for step in range(1, steps + 1):
        of = rng.integers(0, len(languages), batch)  # languages alike often, whatever their share
        rows = np.array([rng.choice(per_language[k]) for k in of])
        _, grads = net.gradients(windows[rows].T, of)
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        now = rate * min(1.0, step / 20) * (1 - step / (steps + 1))
        for w, g, m, v in zip(net.weights(), grads, first, second):
            g = g * min(1.0, 1.0 / (size + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, rows_per_language: int = 250, windows_per_row: int = 24, **options) -> Network | None:
    """Network from at most ``rows_per_language`` rows of each language, chosen by hash.

    Rows without a letter are not counted; rows without an id are learned like any
    others. A row is its id, language and text: equal rows take a place each but
    are learned once. With more than ``MAX_LANGUAGES`` languages each has fewer
    rows, so that the sample never exceeds ``rows_per_language * MAX_LANGUAGES``
    rows. Their texts are read whole; ``windows_per_row`` windows of each, evenly
    spaced, are learned. These bounds keep the sample small at every size of the
    table. None if no row has a language, a letter and a place in the sample.
    """
    usable = F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.coalesce(F.rlike("text", F.lit("\\p{L}")), F.lit(False))
    docs = docs.where(usable).select("doc_id", "lang", "text", F.xxhash64("text").alias("mark"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "mark")
    places = docs.drop("text").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rows_per_language)
    # First ranks first, so that the bound takes rows from every language before any language's later ones.
    chosen = places.orderBy("rank", "lang").limit(rows_per_language * MAX_LANGUAGES).alias("c")
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.lang") == F.col("c.lang")) & (F.col("d.mark") == F.col("c.mark"))
    found = docs.alias("d").join(F.broadcast(chosen), same, "left_semi")  # bounded by the limit above
    sample = found.groupBy("doc_id", "lang", "mark").agg(F.min("text").alias("text")).drop("mark")
    each = max(1, windows_per_row)

    def cut(batches):
        for batch in batches:
            ids_, langs, parts = [], [], []
            for i, lang, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
                w = windows_of(text.encode("utf-8"))
                w = w[np.unique(np.linspace(0, len(w) - 1, min(each, len(w))).astype(int))]
                ids_.append(i)
                langs.append(lang)
                parts.append(w.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids_, pa.int64()), pa.array(langs, pa.string()), pa.array(parts, pa.binary())],
                names=["doc_id", "lang", "bytes"],
            )

    rows = sample.mapInArrow(cut, "doc_id bigint, lang string, bytes binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, -1 if r.doc_id is None else r.doc_id, bytes(r.bytes)))
    languages = sorted({r.lang for r in rows})
    parts = [np.frombuffer(bytes(r.bytes), np.uint8).reshape(-1, WINDOW) for r in rows]
    labels = np.concatenate([np.full(len(p), languages.index(r.lang)) for p, r in zip(parts, rows)])
    return train(np.concatenate(parts), labels, languages, **options)


def _score(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Mean probabilities per text and the label counts, over all its positions."""
    cut = [windows_of(t) for t in texts]
    owner = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
    windows = np.concatenate(cut)
    total = np.zeros((len(texts), len(net.languages)))
    labelled = np.zeros((len(texts), len(net.languages)))
    for at in range(0, len(windows), BLOCK):
        steps = np.ascontiguousarray(windows[at : at + BLOCK].T).astype(np.intp)
        prob = net.probabilities(steps)
        text = steps != PAD
        most = prob.max(axis=1)
        for k in range(len(net.languages)):
            np.add.at(total[:, k], owner[at : at + BLOCK], (prob[:, k] * text).sum(axis=0))
            np.add.at(labelled[:, k], owner[at : at + BLOCK], ((prob[:, k] == most) & text).sum(axis=0))
    return total, labelled


def identify(docs: DataFrame, net: Network | None, batch_bytes: int = 4_000_000) -> DataFrame:
    """``docs`` without text, plus lang_pred, score and agreement.

    ``docs`` needs ``text``; any other columns pass through. ``lang_pred`` is the
    language with the highest mean probability over all byte positions of the
    whole text, ``score`` that probability, ``agreement`` the share of positions
    that carry this label on their own. Null texts and texts without a letter
    are ``und`` with score 0, as is every text when nothing could be learned.
    """
    docs = docs.drop("lang_pred", "score", "agreement")
    keep = [c for c in docs.columns if c != "text"]
    (has_letters,) = unused(docs, "letters")
    letters = docs.withColumn(has_letters, F.coalesce(F.rlike("text", F.lit("\\p{L}")), F.lit(False)))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("agreement", "double")

    def answer(texts: list[bytes | None]) -> list[tuple[str, float, float]]:
        out = [("und", 0.0, 0.0)] * len(texts)
        real = [i for i, t in enumerate(texts) if t is not None]
        if net is None or not real:
            return out
        total, labelled = _score(net, [texts[i] for i in real])
        size = np.maximum(1, labelled.sum(axis=1))
        for j, i in enumerate(real):
            best = int(total[j].argmax())
            out[i] = (net.languages[best], min(1.0, float(total[j, best] / size[j])), float(labelled[j, best] / size[j]))
        return out

    def label(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = [
                t.as_py().encode("utf-8") if has.as_py() else None
                for t, has in zip(batch.column("text"), batch.column(has_letters))
            ]
            at = 0
            while at < len(texts):  # long texts make short sub-batches
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or b"") <= batch_bytes):
                    size += len(texts[end] or b"")
                    end += 1
                told = answer(texts[at:end])
                columns = [batch.column(c).slice(at, end - at) for c in keep]
                columns += [pa.array([x[k] for x in told]) for k in range(3)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score", "agreement"])
                at = end

    return letters.mapInArrow(label, schema)


def identify_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, agreement) per row of ``docs`` (doc_id, text, lang).

    Learns from rows with a language that are not held out. Null ids are not
    held out; repeated rows get equal answers. Other columns are ignored; an
    empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string"))
    net = learn(docs)
    told = identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), net)
    return told


def keep_identified(docs: DataFrame, margin: float = 0.4, sure: float = 0.7) -> DataFrame:
    """Rows of ``docs`` in one known language; rows without a ``lang`` get the predicted one.

    Scores lie between 1 / n and 1 among n languages, and 0 and 1 of that way are
    chance and certainty. Rejected are texts without a letter (null and empty ones
    too), texts below ``margin`` of the way (undecided, or in several languages by
    turns), and texts whose stated language is a learned one but not the predicted
    one, if the prediction is at ``sure`` or above. With one language only
    letterless texts go; if nothing could be learned as well.
    """
    net = learn(docs)
    # As one struct, the columns cannot clash with those of the answer.
    rest = docs.select("text", F.struct(*docs.columns).alias("row"))
    if net is None:
        return rest.where(F.rlike("text", F.lit("\\p{L}"))).select("row.*")
    chance = 1 / len(net.languages)
    way = lambda part: F.col("score") >= chance + part * (1 - chance) - 1e-6
    other = F.col("row.lang").isin(net.languages) & (F.col("row.lang") != F.col("lang_pred"))
    told = identify(rest, net).where((F.col("lang_pred") != "und") & way(margin) & ~(F.coalesce(other, F.lit(False)) & way(sure)))
    lang = F.coalesce("row.lang", "lang_pred").alias("lang")
    return told.select(*[lang if c == "lang" else F.col("row").getField(c).alias(c) for c in docs.columns])
