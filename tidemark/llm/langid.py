"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, residue

# Bounds of the training sample: documents per language, in hash order, and windows from each.
DOCS_PER_LANGUAGE = 400
WINDOWS_PER_DOC = 6
# The network reads windows of so many bytes; 256 stands for what is beyond the end of a text.
WINDOW = 96
UNITS = 8
STEPS = 240
BATCH = 128
RATE = 0.01
SEED = 11
# Windows that are read side by side.
SIDE_BY_SIDE = 2048
HELD_OUT = (4, 2)
UNKNOWN = "und"


class Network:
    """Two gated recurrent layers, one in each direction, and a softmax at every position.

    Gates are clipped lines, candidates are clipped too, so a step is a product and a few passes.
    State s, input byte x: z, r = gate(W x + U s); n = clip(Wn x + r * (Un s)); s' = n + z * (s - n).
    """

    def __init__(self, classes: int, units: int = UNITS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.units, self.classes = units, classes
        self.p = {}
        for d in "fb":
            self.p[f"W{d}"] = rng.normal(0, 0.3, (3 * units, 257)).astype(np.float32)
            self.p[f"U{d}"] = rng.normal(0, 0.3, (3 * units, units)).astype(np.float32)
            self.p[f"c{d}"] = np.zeros((3 * units, 1), np.float32)
            self.p[f"c{d}"][:units] = 1.0  # remember at first
        self.p["V"] = rng.normal(0, 0.3, (classes, 2 * units)).astype(np.float32)
        self.p["v"] = np.zeros((classes, 1), np.float32)

    def _direction(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States [T, units, B] of one direction over x [T, B]."""
        h, steps, width = self.units, x.shape[0], x.shape[1]
        table = self.p[f"W{d}"] + self.p[f"c{d}"]
        u = self.p[f"U{d}"]
        out = np.empty((steps, h, width), np.float32)
        state = np.zeros((h, width), np.float32)
        a = np.empty((3 * h, width), np.float32)
        b = np.empty((3 * h, width), np.float32)
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        for t in order:
            np.take(table, x[t], axis=1, out=a, mode="clip")
            np.matmul(u, state, out=b)
            gates = a[: 2 * h]
            gates += b[: 2 * h]
            gates *= 0.25
            gates += 0.5
            np.clip(gates, 0.0, 1.0, out=gates)
            candidate = a[2 * h :]
            candidate += gates[h:] * b[2 * h :]
            if keep is not None:
                raw = candidate.copy()
            np.clip(candidate, -1.0, 1.0, out=candidate)
            following = out[t]
            np.subtract(state, candidate, out=following)
            following *= gates[:h]
            following += candidate
            if keep is not None:
                keep.append((t, state.copy(), gates.copy(), raw, b[2 * h :].copy()))
            state = following
        return out

    def _positions(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        """Class probabilities at every position: [T, classes, B]."""
        h = self.units
        scores = np.matmul(self.p["V"][:, :h], forward)
        scores += np.matmul(self.p["V"][:, h:], backward)
        scores += self.p["v"]
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def label(self, x: np.ndarray) -> np.ndarray:
        return self._positions(self._direction(x, "f", None), self._direction(x, "b", None))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the real positions, and its gradients through time."""
        h = self.units
        kept: dict[str, list] = {"f": [], "b": []}
        states = {d: self._direction(x, d, kept[d]) for d in "fb"}
        prob = self._positions(states["f"], states["b"])
        real = (x < 256).astype(np.float32)
        total = max(1.0, float(real.sum()))
        chosen = np.take_along_axis(prob, y[None, None, :].repeat(len(x), 0), axis=1)[:, 0]
        loss = float(-(np.log(np.maximum(chosen, 1e-9)) * real).sum() / total)
        d_scores = prob.copy()
        np.put_along_axis(d_scores, y[None, None, :].repeat(len(x), 0), chosen[:, None] - 1, axis=1)
        d_scores *= real[:, None] / total
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["V"][:, :h] = np.einsum("tcb,thb->ch", d_scores, states["f"], optimize=True)
        g["V"][:, h:] = np.einsum("tcb,thb->ch", d_scores, states["b"], optimize=True)
        g["v"][:] = d_scores.sum(axis=(0, 2))[:, None]
        for d, part in (("f", self.p["V"][:, :h]), ("b", self.p["V"][:, h:])):
            u = self.p[f"U{d}"]
            d_state = np.zeros((h, x.shape[1]), np.float32)
            for t, before, gates, raw, recurrent in reversed(kept[d]):
                d_state = d_state + part.T @ d_scores[t]
                candidate = np.clip(raw, -1, 1)
                z, r = gates[:h], gates[h:]
                d_candidate = d_state * (1 - z) * (np.abs(raw) < 1)
                d_z = d_state * (before - candidate) * 0.25 * ((z > 0) & (z < 1))
                d_r = d_candidate * recurrent * 0.25 * ((r > 0) & (r < 1))
                d_in = np.concatenate([d_z, d_r, d_candidate])
                d_rec = np.concatenate([d_z, d_r, d_candidate * r])
                np.add.at(g[f"W{d}"].T, x[t], d_in.T)
                g[f"U{d}"] += d_rec @ before.T
                g[f"c{d}"] += d_in.sum(axis=1, keepdims=True)
                d_state = d_state * z + u.T @ d_rec
        return loss, g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = SEED) -> list[float]:
        """Adam over random batches of windows x [N, T] with classes y [N]; returns the losses."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(p) for k, p in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(x), BATCH)
            loss, g = self.gradients(np.ascontiguousarray(x[rows].T), y[rows])
            norm = np.sqrt(sum(float((q * q).sum()) for q in g.values()))
            scale = min(1.0, 1.0 / (norm + 1e-9))
            rate = RATE * (1 - 0.9 * step / steps)
            for k, p in self.p.items():
                q = g[k] * scale
                m[k] = 0.9 * m[k] + 0.1 * q
                v[k] = 0.99 * v[k] + 0.01 * q * q
                p -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
            losses.append(loss)
        return losses


def windows_of(raw: bytes, size: int = WINDOW) -> np.ndarray:
    """A text's bytes in rows of ``size``, the last filled with 256."""
    n = max(1, -(-len(raw) // size))
    out = np.full(n * size, 256, np.int16)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, size)


def pooled(network: Network, texts: list[bytes]) -> np.ndarray:
    """Mean class probabilities over all positions of each whole text."""
    parts = [windows_of(t) for t in texts]
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    owner = np.repeat(np.arange(len(parts)), counts)
    every = np.concatenate(parts)
    sums = np.zeros((len(texts), network.classes))
    for at in range(0, len(every), SIDE_BY_SIDE):
        x = np.ascontiguousarray(every[at : at + SIDE_BY_SIDE].T).astype(np.int64)
        prob = network.label(x)
        if (x == 256).any():
            prob *= (x < 256).astype(np.float32)[:, None]
        np.add.at(sums, owner[at : at + SIDE_BY_SIDE], prob.sum(axis=0, dtype=np.float64).T)
    return sums / np.maximum(1, np.fromiter(map(len, texts), np.int64, len(texts)))[:, None]


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows at places that a hash of the row spreads over the whole text."""
    for batch in batches:
        langs, hashes, out = [], [], []
        for lang, h, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows = windows_of(text.encode("utf-8", "surrogatepass"))
            rng = np.random.default_rng(h & 0x7FFFFFFFFFFFFFFF)
            for i in rng.permutation(len(rows))[:WINDOWS_PER_DOC]:
                langs.append(lang)
                hashes.append(h)
                out.append(rows[i].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(hashes, pa.int64()), pa.array(out, pa.binary())], names=["lang", "h", "window"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        held_out: tuple[int, int] = HELD_OUT) -> tuple[Network | None, list[str]]:
    """A trained network and its languages, from a bounded sample of labelled rows that are not held out.

    About ``DOCS_PER_LANGUAGE`` documents of each language by hash, ``WINDOWS_PER_DOC`` windows of each.
    """
    prepare(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).where(residue(id_col, held_out[0]) != held_out[1])
    rows = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col), F.lit(SEED)).alias("h"), F.col(text_col).alias("text"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return None, []
    # the share of each language that gives a little more than the sample; the rest is cut by hash order
    million = 1_000_000
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(million, int(million * 1.3 * DOCS_PER_LANGUAGE / n) + 1)).otherwise(share)
    near = rows.where(F.pmod("h", F.lit(million)) < share)
    found = near.mapInArrow(_samples, "lang string, h long, window binary").collect()
    languages = sorted(counts)
    x, y = [], []
    for number, lang in enumerate(languages):
        own = sorted((r["h"] % million, r["h"], bytes(r["window"])) for r in found if r["lang"] == lang)
        own = own[: DOCS_PER_LANGUAGE * WINDOWS_PER_DOC]
        x += [np.frombuffer(w, np.int16) for _, _, w in own]
        y += [number] * len(own)
    network = Network(len(languages))
    # languages count alike, however often they occur
    x, y = np.stack(x).astype(np.int64), np.array(y)
    sizes = np.bincount(y, minlength=len(languages))
    even = np.concatenate([np.resize(np.flatnonzero(y == k), sizes.max()) for k in range(len(languages))])
    if len(languages) > 1:
        network.fit(x[even], y[even])
    return network, languages


def _predict(network: Network | None, languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(x or "").encode("utf-8", "surrogatepass") for x in batch.column(2).to_pylist()]
            letters = batch.column(3).to_pylist()
            langs: list[str] = [UNKNOWN] * len(texts)
            scores = np.zeros(len(texts))
            todo = [i for i, yes in enumerate(letters) if yes and network is not None]
            if todo:
                prob = pooled(network, [texts[i] for i in todo])
                best = prob.argmax(axis=1)
                for i, k, row in zip(todo, best.tolist(), prob, strict=True):
                    langs[i] = languages[k]
                    scores[i] = min(1.0, round(float(row[k]), 6))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       held_out: tuple[int, int] = HELD_OUT, model: tuple[Network | None, list[str]] | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    ``model`` is what ``fit`` returns; without one it is fitted on ``docs``.

    The network labels every byte of every text; a document's score is the mean probability of its
    language over all bytes. Null text and text without a letter are `und` with score 0, as is
    everything where no row has a language to learn. Null identifiers hash as the text 'null'; repeated
    rows get the same answer; an empty table gives an empty result; other columns are not read.
    """
    network, languages = model or fit(docs, id_col, text_col, lang_col, held_out)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (residue(id_col, held_out[0]) == held_out[1]).alias("held_out"),
        F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(_predict(network, languages), "doc_id long, held_out boolean, lang_pred string, score double")
