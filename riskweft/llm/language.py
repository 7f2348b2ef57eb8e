"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads one run of letters at a time (ASCII A-Z lower-cased, any byte
beyond ASCII counts as a letter), with a space before and after, forwards and
backwards. At every position the two states give a softmax over the languages;
a document's probabilities are the mean over all its positions. It is trained
by backpropagation through time on a bounded sample of labelled documents:
SAMPLE documents for each language, the ones with the smallest hashes.

A run's labels depend on its bytes only, so a task computes each distinct run of
a batch once and remembers up to REMEMBERED runs; every position of every text
still counts. Runs over RUN_BYTES bytes are cut.

Nulls: a null text, or one without a letter, is `und` with score 0. Rows with a
null lang are predicted but not learned from. Without any labelled row all are
`und`. A null doc_id counts as the empty text when parts are formed. Repeated
rows get equal predictions. Extra columns are ignored.
Memory: a task holds one batch, the driver one sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweft.llm.common import crc_mod
from riskweft.llm.words import _BYTE, _power_tables, mix, pieces, text_bytes

UNKNOWN = "und"
SAMPLE = 96
#: Runs of one sampled document that are trained on at most; the sample is bounded by documents and by this.
SAMPLE_RUNS = 400
HIDDEN = 16
STEPS = 400
BATCH = 512
RATE = 0.02
RUN_BYTES = 48
REMEMBERED = 400_000
#: A document whose best language has a lower mean probability is rejected.
MIN_SCORE = 0.4
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def letter_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The folded bytes of all texts (a space at both ends), starts and lengths of their runs, and the text of each run."""
    folded = b" " + b" ".join(texts).translate(_FOLD) + b" "
    data = np.frombuffer(folded, np.uint8)
    solid = data != 32
    edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts - 1, side="right")
    if len(starts) and (ends - starts).max() > RUN_BYTES:
        cuts = -(-(ends - starts) // RUN_BYTES)
        inner = (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * RUN_BYTES
        stops, text = np.repeat(ends, cuts), np.repeat(text, cuts)
        starts = np.repeat(starts, cuts) + inner
        ends = np.minimum(starts + RUN_BYTES, stops)
    return data, starts, ends - starts, text


def _framed(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Bytes of runs of one length, a space on both sides; time by run."""
    grid = np.full((length + 2, len(starts)), 32, np.uint8)
    grid[1:-1] = data[starts[None, :] + np.arange(length)[:, None]]
    return grid


class Network:
    """Two GRUs over bytes and a softmax at every position. Arrays are time by run by unit."""

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 5):
        r = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = r.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.p[f"u{d}"] = (r.normal(0, 1, (hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.p["w"] = r.normal(0, 0.3, (2 * hidden, classes)).astype(np.float32)
        self.p["c"] = np.zeros(classes, np.float32)

    def _run(self, d: str, grid: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each byte; z and r are one sigmoid, written as a tanh of half the input."""
        h, k = np.zeros((grid.shape[1], self.hidden), np.float32), self.hidden
        x, u, out = self.p["x" + d], self.p["u" + d], np.empty((*grid.shape, self.hidden), np.float32)
        for t in range(len(grid)):
            a, b = x[grid[t]], h @ u
            gates = np.tanh((a[:, : 2 * k] + b[:, : 2 * k]) * 0.5) * 0.5 + 0.5
            z, r = gates[:, :k], gates[:, k:]
            n = np.tanh(a[:, 2 * k :] + r * b[:, 2 * k :])
            if keep is not None:
                keep.append((h, z, r, n, b[:, 2 * k :]))
            h = n + z * (h - n)
            out[t] = h
        return out

    def labels(self, grid: np.ndarray, kept: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities at every position (the framing spaces too), and the states they come from."""
        forward = self._run("f", grid, kept and kept[0])
        backward = self._run("b", grid[::-1], kept and kept[1])[::-1]
        states = np.concatenate([forward, backward], axis=2)
        logits = states @ self.p["w"] + self.p["c"]
        e = np.exp(logits - logits.max(axis=2, keepdims=True))
        return e / e.sum(axis=2, keepdims=True), states

    def _back(self, d: str, grid: np.ndarray, kept: list, grad: np.ndarray, g: dict) -> None:
        u, k = self.p["u" + d], self.hidden
        dx, du, dh = np.zeros((256, 3 * k), np.float32), np.zeros_like(u), np.zeros_like(kept[0][0])
        for t in range(len(grid) - 1, -1, -1):
            h, z, r, n, un = kept[t]
            dh = dh + grad[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            da = np.concatenate([dz, dr, dn], axis=1)
            db = np.concatenate([dz, dr, dn * r], axis=1)
            np.add.at(dx, grid[t], da)
            du += h.T @ db
            dh = dh * z + db @ u.T
        g["x" + d], g["u" + d] = dx, du

    def gradients(self, grid: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        kept: tuple[list, list] = ([], [])
        prob, states = self.labels(grid, kept)
        count = grid.size
        loss = -float(np.log(np.maximum(prob[:, np.arange(len(y)), y], 1e-9)).mean())
        d = prob.copy()
        d[:, np.arange(len(y)), y] -= 1
        d /= count
        flat = d.reshape(-1, d.shape[2])
        g = {"w": states.reshape(-1, states.shape[2]).T @ flat, "c": flat.sum(axis=0)}
        ds = d @ self.p["w"].T
        self._back("f", grid, kept[0], ds[:, :, : self.hidden], g)
        self._back("b", grid[::-1], kept[1], ds[::-1, :, self.hidden :], g)
        return loss, g


def train(runs: list[tuple[bytes, int]], classes: int, steps: int = STEPS, seed: int = 5) -> Network:
    """runs: (letters, class). Each step takes runs of one length, lengths in proportion to their positions, classes evenly."""
    net, r = Network(classes, seed=seed), np.random.default_rng(seed)
    groups: dict[tuple[int, int], list[bytes]] = {}
    for said, y in runs:
        groups.setdefault((len(said), y), []).append(said)
    weight: dict[int, float] = {}
    for (n, _), found in groups.items():
        weight[n] = weight.get(n, 0.0) + (n + 2) * len(found)
    lengths = sorted(weight)
    chance = np.array([weight[n] for n in lengths])
    first, second = {k: np.zeros_like(v) for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}
    totals = np.bincount([y for _, y in runs], minlength=classes).astype(float)
    for step in range(1, steps + 1):
        n = int(r.choice(lengths, p=chance / chance.sum()))
        # Each class has the share of this length that it has among its own runs.
        share = np.array([len(groups.get((n, y), ())) / max(totals[y], 1) for y in range(classes)])
        ys = r.choice(classes, size=max(32, BATCH * 8 // (n + 2)), p=share / share.sum())
        said = [groups[n, y][int(r.integers(len(groups[n, y])))] for y in ys.tolist()]
        grid = np.full((n + 2, len(said)), 32, np.uint8)
        grid[1:-1] = np.frombuffer(b"".join(said), np.uint8).reshape(len(said), n).T
        _, g = net.gradients(grid, ys)
        rate = RATE * min(1.0, step / 20) * (1 - 0.9 * step / steps)
        for k, v in g.items():
            v = np.clip(v, -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            net.p[k] = (net.p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


class Labeller:
    """Sums of the position probabilities of whole texts."""

    def __init__(self, net: Network, classes: int):
        self.net, self.classes = net, classes
        self.known, self.sums = np.zeros(0, np.uint64), np.zeros((0, classes), np.float32)

    def _hashes(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        up, down = _power_tables(len(data))
        total = np.cumsum(_BYTE[data] * up[: len(data)])
        return mix((total[starts + lengths - 1] - total[starts - 1]) * down[starts] + lengths.astype(np.uint64))

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of each text; zeros where there is no letter."""
        data, starts, lengths, text = letter_runs(texts)
        out = np.zeros((len(texts), self.classes))
        if not len(starts):
            return out
        names, at, index = np.unique(self._hashes(data, starts, lengths), return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, names)
        new = np.ones(len(names), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != names[inside]
        sums = np.zeros((len(names), self.classes), np.float32)
        sums[~new] = self.sums[place[~new]]
        fresh = np.flatnonzero(new)
        for n in np.unique(lengths[at[fresh]]).tolist():
            some = fresh[lengths[at[fresh]] == n]
            for first in range(0, len(some), 2048):
                part = some[first : first + 2048]
                sums[part] = self.net.labels(_framed(data, starts[at[part]], n))[0][1:-1].sum(axis=0)
        if len(fresh):
            if len(self.known) + len(fresh) > REMEMBERED:
                self.known, self.sums = names, sums
            else:
                known, every = np.concatenate([self.known, names[new]]), np.concatenate([self.sums, sums[new]])
                order = np.argsort(known)
                self.known, self.sums = known[order], every[order]
        positions = np.bincount(text, weights=lengths, minlength=len(texts))
        for c in range(self.classes):
            out[:, c] = np.bincount(text, weights=sums[index.reshape(-1), c], minlength=len(texts))
        return out / np.maximum(positions, 1)[:, None]


def _has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def learn(docs: DataFrame, per_language: int = SAMPLE) -> tuple[Network | None, list[str]]:
    """The network, and its languages in order. docs: doc_id, text, lang of the rows to learn from."""
    rows = docs.where(F.col("lang").isNotNull() & _has_letter(F.col("text"))).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    place = Window.partitionBy("lang").orderBy("h", "text")
    sample = rows.withColumn("k", F.row_number().over(place)).where(F.col("k") <= per_language).select("lang", "text", "k")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            said = []
            for text in text_bytes(batch.column("text")):
                data, starts, lengths, _ = letter_runs([text])
                # Runs spread evenly over the whole text.
                chosen = np.unique(np.linspace(0, len(starts) - 1, min(len(starts), SAMPLE_RUNS)).astype(int)) if len(starts) else []
                said.append([data[starts[i] : starts[i] + lengths[i]].tobytes() for i in chosen])
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("k"), pa.array(said, pa.list_(pa.binary()))], ["lang", "k", "runs"])

    found = sample.mapInArrow(cut, "lang string, k int, runs array<binary>").collect()  # per_language documents of SAMPLE_RUNS runs for each language
    languages = sorted({r["lang"] for r in found})
    if not languages:
        return None, []
    found.sort(key=lambda r: (r["lang"], r["k"]))
    index = {x: i for i, x in enumerate(languages)}
    return train([(bytes(x), index[r["lang"]]) for r in found for x in r["runs"]], len(languages)), languages


def predict(docs: DataFrame, net: Network | None, languages: list[str], carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """carry columns, lang_pred, score. Only the text is an input."""
    if net is None:
        return docs.select(*carry, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    text = F.col("text").cast("string")
    rows = docs.select(*(F.col(c).alias(f"__{c}") for c in carry), F.when(_has_letter(text), text).alias("__read"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(net, len(languages))
        for batch in pieces(batches, "__read"):
            p = labeller.documents(text_bytes(batch.column("__read")))
            best = p.argmax(axis=1)
            score = np.minimum(p[np.arange(len(p)), best], 1.0)
            named = [languages[b] if s > 0 else UNKNOWN for b, s in zip(best.tolist(), score.tolist())]
            kept = [batch.column(f"__{c}") for c in carry]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(named, pa.string()), pa.array(score)], [*carry, "lang_pred", "score"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(label, f"{kinds}, lang_pred string, score double")


def identify(docs: DataFrame, held_part: int = 1, parts: int = 3) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learns from the rows that are not held out, predicts all."""
    held = crc_mod(F.col("doc_id"), parts) == held_part
    net, languages = learn(docs.where(~held))
    return predict(docs, net, languages).withColumn("held_out", crc_mod(F.col("doc_id"), parts) == held_part)


def keep_known(docs: DataFrame, held_part: int = 1, parts: int = 3, min_score: float = MIN_SCORE) -> DataFrame:
    """docs without those of no language: `und`, or a score under min_score. Learns like identify."""
    net, languages = learn(docs.where(crc_mod(F.col("doc_id"), parts) != held_part))
    found = predict(docs.select(F.struct("*").alias("row"), "text"), net, languages, ("row",))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")
