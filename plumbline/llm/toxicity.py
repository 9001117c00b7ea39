"""Toxicity: a bidirectional gated recurrent network with attention pooling over words, trained in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import extended, small_batches, table, without
from plumbline.llm.licenses import words_of

WINDOW, STRIDE = 32, 16
HIDDEN, EMBED, ATTEND = 8, 8, 8
#: Vectors of hashed byte runs, of three bytes anywhere and of so many bytes at a word's start.
GRAMS, STARTS, START_BYTES = 2048, 8192, (4, 5, 6, 7)
#: Labelled documents the network is fitted on, by label: those with the smallest hash of their id.
SAMPLE_TOXIC, SAMPLE_OTHER = 1000, 2000
#: Words of the sample that get a vector of their own: they stand in so many of its documents at least.
LEAST_DOCS = 3
THRESHOLD = 0.3
HELD_OUT_OF, HELD_OUT = 4, 2
EPOCHS, WARM, BATCH, RATE = 12, 1, 64, 0.01
#: Share of the words whose own vector a step of the fit leaves out, so that character runs and context count too.
LEFT_OUT = 0.3
#: How fast the vectors of byte runs fade when nothing asks for them.
FADING = 0.1
#: Words whose inputs a worker keeps between texts.
CACHE = 200_000
OUT = ["held_out", "score", "predicted"]


def gram_codes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the three-byte runs of all words, a mark at either end, and where each word's begin."""
    raw = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.uint32)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    codes = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * np.uint32(2654435761) >> np.uint32(32 - (GRAMS.bit_length() - 1))
    inside = np.ones(len(codes), bool)
    ends = begins[1:]
    inside[ends - 1] = inside[ends - 2] = False
    return codes[inside].astype(np.int64), begins - 2 * np.arange(len(words))


def start_codes(words: list[bytes]) -> np.ndarray:
    """Hashes of each word's first bytes, (word, length of the run); 0 where the word is shorter."""
    raw = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.uint32)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    codes, running = np.zeros((len(words), len(START_BYTES)), np.int64), np.zeros(len(words), np.uint32)
    for k in range(max(START_BYTES)):
        there = lengths > k
        running[there] = running[there] * np.uint32(16777619) + raw[begins[there] + k]
        if k + 1 in START_BYTES:
            hashed = (running ^ running >> np.uint32(15)) * np.uint32(2654435761) >> np.uint32(7)
            codes[there, START_BYTES.index(k + 1)] = hashed[there] % (STARTS - 1) + 1
    return codes


class Network:
    """Parameters, and the passes over windows of words.

    A word enters by its own vector (zero for unknown words), by the mean vector of its runs of three bytes and by the
    sum of the vectors of its starts. Each direction has gates z, r and candidate n; states of both are pooled by
    attention into one vector, then a logit.
    """

    def __init__(self, vocabulary: list[bytes], seed: int = 3, dtype=np.float32):
        rng = np.random.default_rng(seed)
        h, d = HIDDEN, 3 * EMBED
        shapes = {"own": (len(vocabulary) + 1, EMBED), "gram": (GRAMS, EMBED), "start": (STARTS, EMBED), "into": (2, d, 3 * h), "bias": (2, 3 * h),
                  "again": (2, h, 3 * h), "look": (2 * h, ATTEND), "ask": (ATTEND,), "out": (2 * h,), "base": (1,)}
        scale = {"own": 0.0, "gram": 0.0, "start": 0.0, "into": d**-0.5, "again": h**-0.5, "look": (2 * h) ** -0.5, "ask": ATTEND**-0.5, "out": (2 * h) ** -0.5}
        self.p = {k: (rng.standard_normal(s) * scale.get(k, 0.0)).astype(dtype) for k, s in shapes.items()}
        self.p["start"][0] = 0
        self.rows = {w: i + 1 for i, w in enumerate(vocabulary)}

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """What each word adds to the gates of both directions, (word, direction, 3 x hidden)."""
        codes, begins = gram_codes(words)
        counts = np.diff(np.append(begins, len(codes)))
        gram = np.add.reduceat(self.p["gram"][codes], begins) / counts[:, None].astype(self.p["gram"].dtype)
        own = self.p["own"][[self.rows.get(w, 0) for w in words]]
        x = np.concatenate([own, gram, self.p["start"][start_codes(words)].sum(1)], 1)
        return np.einsum("wd,kdg->wkg", x, self.p["into"], optimize=True) + self.p["bias"]

    def forward(self, added: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows. ``added``: (window, step, direction, gates); ``mask``: which steps hold a word."""
        p, h = self.p, HIDDEN
        n, steps = mask.shape
        states = np.zeros((2, n, steps, h), added.dtype)
        state, kept = np.zeros((2, n, h), added.dtype), []
        for t in range(steps):
            at = (t, steps - 1 - t)
            x = np.stack([added[:, at[0], 0], added[:, at[1], 1]])
            m = np.stack([mask[:, at[0]], mask[:, at[1]]])[..., None]
            u = state @ p["again"]
            gates = 0.5 + 0.5 * np.tanh(0.5 * (x[..., : 2 * h] + u[..., : 2 * h]))
            z, r = gates[..., :h], gates[..., h:]
            cand = np.tanh(x[..., 2 * h :] + r * u[..., 2 * h :])
            new = np.where(m, state + z * (cand - state), state)
            if keep:
                kept.append((state, z, r, cand, u[..., 2 * h :], m))
            state = new
            states[0, :, at[0]], states[1, :, at[1]] = state[0], state[1]
        both = np.concatenate([states[0], states[1]], 2)
        hidden = np.tanh(both @ p["look"])
        score = np.where(mask, hidden @ p["ask"], -1e9)
        weight = np.where(mask, np.exp(score - score.max(1, keepdims=True)), 0)
        weight = weight / np.maximum(weight.sum(1, keepdims=True), 1e-9)
        pooled = (weight[..., None] * both).sum(1)
        logit = pooled @ p["out"] + p["base"][0]
        return (logit, (kept, both, hidden, weight, pooled)) if keep else logit

    def gradients(self, added: np.ndarray, mask: np.ndarray, d_logit: np.ndarray, tape) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters above the words, and of ``added``."""
        p, h = self.p, HIDDEN
        kept, both, hidden, weight, pooled = tape
        g = {"out": pooled.T @ d_logit, "base": np.array([d_logit.sum()])}
        d_pooled = d_logit[:, None] * p["out"]
        d_weight = both @ d_pooled[..., None]
        d_weight = d_weight[..., 0]
        d_score = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
        g["ask"] = np.einsum("nt,ntk->k", d_score, hidden)
        d_hidden = d_score[..., None] * p["ask"] * (1 - hidden**2)
        g["look"] = np.einsum("nts,ntk->sk", both, d_hidden)
        d_both = weight[..., None] * d_pooled[:, None] + d_hidden @ p["look"].T
        steps = mask.shape[1]
        d_added, d_state = np.zeros_like(added), np.zeros_like(kept[0][0])
        g["again"] = np.zeros_like(p["again"])
        for t in range(steps - 1, -1, -1):
            at = (t, steps - 1 - t)
            state, z, r, cand, u_n, m = kept[t]
            d_new = d_state + np.stack([d_both[:, at[0], :h], d_both[:, at[1], h:]])
            d_in = np.where(m, d_new, 0)
            d_cand = d_in * z * (1 - cand**2)
            d_z = d_in * (cand - state) * z * (1 - z)
            d_r = d_cand * u_n * r * (1 - r)
            d_u = np.concatenate([d_z, d_r, d_cand * r], 2)
            d_x = np.concatenate([d_z, d_r, d_cand], 2)
            g["again"] += state.transpose(0, 2, 1) @ d_u
            d_state = np.where(m, d_new * (1 - z), d_new) + d_u @ p["again"].transpose(0, 2, 1)
            d_added[:, at[0], 0], d_added[:, at[1], 1] = d_x[0], d_x[1]
        return g, d_added


def windows(n_words: int) -> list[int]:
    """Where the windows of a text begin; each but the last is full, and each overlaps the next by half."""
    return list(range(0, max(1, n_words - (WINDOW - STRIDE)), STRIDE))


def window_index(counts: list[int], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids by (window, step), the mask of steps that hold a word, and the text of each window."""
    firsts = np.concatenate([[0], np.cumsum(counts)])
    begins = [np.array(windows(c)) for c in counts]
    text = np.repeat(np.arange(len(counts)), [len(b) for b in begins])
    begin = np.concatenate([*begins, np.zeros(0, int)]).astype(np.int64)
    place = begin[:, None] + np.arange(WINDOW)
    mask = place < np.array(counts)[text][:, None] if len(counts) else np.zeros((0, WINDOW), bool)
    flat = np.append(ids, 0)
    return flat[np.where(mask, firsts[text][:, None] + place, len(ids))], mask, text


def train(texts: list[str], toxic: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> Network:
    """Fit on whole texts. A text is as toxic as its most toxic window: after ``WARM`` rounds, in which a window drawn
    from each text stands for it, each round finds every text's highest window and fits those. A word's own vector
    begins with how much more often it stands in toxic texts, shrunk towards no difference."""
    rng = np.random.default_rng(seed)
    split = [words_of(t) for t in texts]
    docs_with: dict[bytes, int] = {}
    toxic_with: dict[bytes, int] = {}
    for words, bad in zip(split, toxic.tolist()):
        for w in set(words):
            docs_with[w] = docs_with.get(w, 0) + 1
            toxic_with[w] = toxic_with.get(w, 0) + bad
    net = Network(sorted(w for w, n in docs_with.items() if n >= LEAST_DOCS), seed)
    prior = 2 * toxic.mean()
    for w, row in net.rows.items():
        odds = (toxic_with[w] + prior) / (docs_with[w] - toxic_with[w] + 2 - prior)
        net.p["own"][row, 0] = np.log(odds * (2 - prior) / prior) / 4
    distinct = sorted(docs_with) or [b""]
    number = {w: i for i, w in enumerate(distinct)}
    ids = np.fromiter((number[w] for words in split for w in words), np.int64)
    index, mask, text = window_index([len(w) for w in split], ids)
    first = np.searchsorted(text, np.arange(len(texts)))
    last = np.searchsorted(text, np.arange(len(texts)), side="right")
    codes, begins = gram_codes(distinct)
    ends = np.append(begins[1:], len(codes))
    own_rows = np.array([net.rows.get(w, 0) for w in distinct])
    starts = start_codes(distinct)
    label = toxic.astype(np.float32)
    m, v, step = {}, {}, 0
    for epoch in range(epochs):
        if epoch < WARM:
            chosen = first + (rng.random(len(texts)) * (last - first)).astype(int)
        else:
            logit = score_windows(net.forward, net.inputs(distinct), index, mask)
            order = np.lexsort((logit, text))
            chosen = order[last - 1]
        rate = RATE * (1 - epoch / epochs) + 1e-4
        shuffled = rng.permutation(len(texts))
        for at in range(0, len(texts), BATCH):
            docs = shuffled[at : at + BATCH]
            rows, used = index[chosen[docs]], mask[chosen[docs]]
            words, where = np.unique(rows, return_inverse=True)
            sizes = ends[words] - begins[words]
            spread = np.repeat(np.arange(len(words)), sizes)
            picked = codes[np.repeat(begins[words] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())]
            gram = np.zeros((len(words), EMBED), np.float32)
            np.add.at(gram, spread, net.p["gram"][picked] / sizes[spread, None].astype(np.float32))
            own = (rng.random((len(words), 1)) >= LEFT_OUT).astype(np.float32)
            x = np.concatenate([net.p["own"][own_rows[words]] * own, gram, net.p["start"][starts[words]].sum(1)], 1)
            added = (np.einsum("wd,kdg->wkg", x, net.p["into"], optimize=True) + net.p["bias"])[where.reshape(rows.shape)]
            logit, tape = net.forward(added, used, True)
            d_logit = ((1 / (1 + np.exp(-logit)) - label[docs]) / len(docs)).astype(np.float32)
            g, d_added = net.gradients(added, used, d_logit, tape)
            d_word = np.zeros((len(words), 2, 3 * HIDDEN), np.float32)
            np.add.at(d_word, where.ravel(), d_added.reshape(-1, 2, 3 * HIDDEN))
            g["bias"], g["into"] = d_word.sum(0), np.einsum("wd,wkg->kdg", x, d_word, optimize=True)
            d_x = np.einsum("wkg,kdg->wd", d_word, net.p["into"], optimize=True)
            g |= {k: np.zeros_like(net.p[k]) for k in ("own", "gram", "start")}
            np.add.at(g["own"], own_rows[words], d_x[:, :EMBED] * own)
            g["own"][0] = 0
            np.add.at(g["gram"], picked, (d_x[:, EMBED : 2 * EMBED] / sizes[:, None])[spread])
            np.add.at(g["start"], starts[words], np.repeat(d_x[:, None, 2 * EMBED :], len(START_BYTES), 1))
            g["start"][0] = 0
            step += 1
            for k, grad in g.items():
                m[k] = 0.9 * m.get(k, 0) + 0.1 * grad
                v[k] = 0.999 * v.get(k, 0) + 0.001 * grad**2
                fading = FADING * rate if k in ("gram", "start") else 0.0
                net.p[k] = ((1 - fading) * net.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def score_windows(forward, inputs: np.ndarray, index: np.ndarray, mask: np.ndarray, at_once: int = 2048) -> np.ndarray:
    parts = [forward(inputs[index[i : i + at_once]], mask[i : i + at_once]) for i in range(0, len(index), at_once)]
    return np.concatenate([*parts, np.zeros(0, inputs.dtype)])


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def train_on(documents: DataFrame, labels: DataFrame) -> Network | None:
    """Fit on labelled documents that aren't held out, a bounded number of either label; None without both labels."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("_llm_id")).agg(F.max("toxic").alias("_llm_toxic"))
    order = [F.xxhash64(F.lit(7), "_llm_id"), F.col("_llm_id")]
    one = known.where("_llm_toxic >= 1").orderBy(*order).limit(SAMPLE_TOXIC)
    other = known.where("_llm_toxic < 1").orderBy(*order).limit(SAMPLE_OTHER)
    texts = documents.select("doc_id", "text").join(F.broadcast(one.unionByName(other)), F.col("doc_id") == F.col("_llm_id"))
    rows = sorted((r["doc_id"], r["text"] or "", r["_llm_toxic"] >= 1) for r in texts.collect())
    toxic = np.array([r[2] for r in rows], bool)
    if not len(rows) or toxic.all() or not toxic.any():
        return None
    return train([r[1] for r in rows], toxic)


def score_documents(documents: DataFrame, net: Network | None) -> DataFrame:
    """Add ``held_out``, ``score`` (0 to 1: the most toxic of all overlapping windows of the whole text) and
    ``predicted`` (1 from a score of ``THRESHOLD`` on).

    Null and empty texts are one window without words: they get the score of the network's base. Without a network
    (no labels of both kinds) all scores are 0. Only the text is an input. Rows are scored one by one: repeated rows
    get equal scores, a null id isn't held out, columns named as the results are replaced.
    """
    rows = without(documents, OUT)

    def run(batches):
        cache: dict[bytes, int] = {}
        inputs = np.zeros((0, 2, 3 * HIDDEN), np.float32)
        for batch in small_batches(batches, "text", 4 << 20):
            if net is None:
                scores = np.zeros(batch.num_rows)
            else:
                split = [words_of(t) for t in batch.column("text").to_pylist()]
                new = set().union(*split).difference(cache)
                if len(cache) + len(new) > CACHE:
                    cache, inputs, new = {}, inputs[:0], set().union(*split)
                if new:
                    fresh = sorted(new)
                    cache.update(zip(fresh, range(len(inputs), len(inputs) + len(fresh))))
                    inputs = np.concatenate([inputs, net.inputs(fresh)])
                ids = np.fromiter((cache[w] for words in split for w in words), np.int64)
                index, mask, text = window_index([len(w) for w in split], ids)
                known = inputs if len(inputs) else np.zeros((1, 2, 3 * HIDDEN), np.float32)
                logit = score_windows(net.forward, known, index, mask)
                best = np.full(batch.num_rows, -np.inf)
                np.maximum.at(best, text, logit)
                scores = 1 / (1 + np.exp(-best.astype(np.float64)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"]
            )

    return rows.mapInArrow(run, extended(rows, "score double, predicted int")).withColumn("held_out", held_out(F.col("doc_id")))


def op8_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(documents, train_on(documents, table(spark, sf_dir, "labels"))).select("doc_id", *OUT)
