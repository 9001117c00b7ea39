"""Quality rules: base counts of a text, and a linear-chain CRF over its lines that tells content from boilerplate."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import BLANKS, extended, per_batch, small_batches, table, text_bytes, without

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words
LEAST_CONTENT = 0.5
#: Documents with labels that the line model is fitted on, chosen by a hash of the id.
SAMPLE_DOCS = 1500
#: Sampled documents are cut into runs of so many lines for the forward and backward passes of the fit only.
FIT_LINES = 64
FEATURES = ["one", "symbols", "bars", "bangs", "upper", "digits", "marks", "length", "word", "again"]
#: Emission weights (boilerplate against content) and transitions used where no labelled documents exist.
PRIOR = {"weights": [-2.0, 30.0, 6.0, 4.0, 4.0, 4.0, 0.0, 0.0, 0.0, 2.0], "change": [[0.5, -0.5], [-0.5, 0.5]], "first": [0.3, -0.3]}
OUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "content_words", "content_share"]


def _classes() -> dict[str, np.ndarray]:
    codes = np.arange(256)
    blank = np.isin(codes, list(BLANKS.encode()))
    return {
        "blank": blank, "symbols": np.isin(codes, list(SYMBOLS)), "bars": codes == ord("|"), "bangs": codes == ord("!"),
        "upper": (codes >= 65) & (codes <= 90), "digits": (codes >= 48) & (codes <= 57), "marks": np.isin(codes, list(b".,;:?")),
        "chars": ~blank & (codes & 0xC0 != 0x80),
    }


CLASSES = _classes()


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, first occurrences included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times, n, end = Counter(windows), 0, 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            n += i + 3 - max(end, i)
            end = i + 3
    return n


def measure(texts) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Base counts per text; for each line with a word its features, its words and the text it is in."""
    raw, offsets = text_bytes(texts)
    n = len(offsets) - 1
    starts_line = np.zeros(len(raw) + 1, bool)
    starts_line[np.flatnonzero(raw == 10) + 1] = True
    starts_line[offsets] = True
    lines = np.flatnonzero(starts_line[: len(raw)])
    bounds = np.append(lines, len(raw))

    def total(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[at])

    blank = CLASSES["blank"][raw]
    word_start = ~blank
    word_start[1:] &= blank[:-1] | starts_line[1 : len(raw)]
    per_line = {k: total(table_[raw], bounds) for k, table_ in CLASSES.items() if k != "blank"}
    words = total(word_start, bounds)
    in_text = np.searchsorted(offsets, lines, side="right") - 1

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(in_text, values, n).astype(np.int64)

    base = {"n_words": per_text(words), "word_chars": per_text(per_line["chars"]), "n_symbols": per_text(per_line["symbols"])}
    n_dup, n_rep, again = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(len(lines), bool)
    first_line = np.searchsorted(lines, offsets)
    whole = raw.tobytes()
    for i in range(n):
        text = whole[offsets[i] : offsets[i + 1]]
        n_rep[i] = repeated_words(text.split())
        seen = set()
        for j, line in enumerate(text.split(b"\n"), first_line[i]):
            if line in seen:
                again[j] = True
            elif line and not line.isspace():
                seen.add(line)
        n_dup[i] = again[first_line[i] : first_line[i + 1]].sum()
    used = words > 0
    chars, count = np.maximum(per_line["chars"], 1)[used], np.maximum(words, 1)[used]
    share = [per_line[k][used] / chars for k in ("symbols", "bars")]
    share += [np.minimum(per_line["bangs"][used] / count, 2), *(per_line[k][used] / chars for k in ("upper", "digits", "marks"))]
    features = np.column_stack([np.ones(used.sum()), *share, np.log1p(count) / 5, chars / count / 10, again[used]])
    return base | {"n_dup_lines": n_dup, "n_repeat_words": n_rep}, features, words[used], in_text[used]


def fails_base(base: dict[str, np.ndarray]) -> np.ndarray:
    return (base["n_words"] < LEAST_WORDS) | (100 * base["n_repeat_words"] > MOST_REPEATED * base["n_words"])


def viterbi(lean: list[float], change: list[list[float]], first: list[float]) -> list[int]:
    """The best path of two states; ``lean`` is what a line gives state 1 over state 0. Ties go to state 0."""
    (t00, t01), (t10, t11) = change
    if not lean:
        return []
    a, b, back = first[0], first[1] + lean[0], []
    for x in lean[1:]:
        a0, b0, a1, b1 = a + t00, b + t10, a + t01, b + t11
        back.append((b0 > a0, b1 > a1))
        a, b = (b0 if b0 > a0 else a0), (b1 if b1 > a1 else a1) + x
    state = int(b > a)
    path = [state]
    for step in reversed(back):
        state = int(step[state])
        path.append(state)
    return path[::-1]


def fit(features: np.ndarray, runs: np.ndarray, poor: np.ndarray, rounds: int = 150, rate: float = 0.1, decay: float = 1e-3) -> dict:
    """Fit the chain by conditional likelihood.

    Labels are of documents, not of lines, so lines are labelled in two steps: a logistic model of lines against their
    document's label, then in a poor document only the lines that model calls poor are boilerplate. ``runs`` numbers
    the runs of lines that belong together. Emissions, transitions and starts are then fitted jointly by Adam.
    """
    if not len(poor) or poor.all() or not poor.any():
        return PRIOR
    scale = np.where(features.std(0) > 0, features.std(0), 1.0)
    features = features / scale
    w = np.zeros(features.shape[1])
    weight = np.where(poor, 0.5 / poor.mean(), 0.5 / (1 - poor.mean()))
    for _ in range(25):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        slope = features.T @ (weight * (p - poor)) / len(poor) + decay * w
        bend = (features * (weight * p * (1 - p))[:, None]).T @ features / len(poor) + decay * np.eye(len(w))
        w -= np.linalg.solve(bend, slope)
    label = (poor & (features @ w > 0)).astype(int)

    order, lengths = np.unique(runs, return_counts=True)
    at = np.arange(len(runs)) - np.repeat(np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    row = np.repeat(np.arange(len(order)), lengths)
    size, steps = len(order), int(lengths.max())
    used = np.zeros((size, steps), bool)
    used[row, at] = True
    gold = np.zeros((size, steps), int)
    gold[row, at] = label
    counts = np.zeros((2, 2))
    both = used[:, 1:]
    np.add.at(counts, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    starts = np.bincount(gold[:, 0], minlength=2).astype(float)

    theta = np.concatenate([w, np.zeros(4), np.zeros(2)])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    k = features.shape[1]
    for step in range(1, rounds + 1):
        change, first = theta[k : k + 4].reshape(2, 2), theta[k + 4 :]
        emit = np.zeros((size, steps, 2))
        emit[row, at, 1] = features @ theta[:k]
        ahead = np.zeros((size, steps, 2))
        ahead[:, 0] = first + emit[:, 0]
        for t in range(1, steps):
            new = np.logaddexp(ahead[:, t - 1, :1] + change[0], ahead[:, t - 1, 1:] + change[1]) + emit[:, t]
            ahead[:, t] = np.where(used[:, t, None], new, ahead[:, t - 1])
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        behind = np.zeros((size, steps, 2))
        pairs = np.zeros((2, 2))
        for t in range(steps - 2, -1, -1):
            later = emit[:, t + 1] + behind[:, t + 1]
            new = np.logaddexp(change[:, 0] + later[:, :1], change[:, 1] + later[:, 1:])
            joint = np.exp(np.clip(ahead[:, t, :, None] + change + later[:, None, :] - total[:, None, None], -60, 0))
            pairs += (joint * used[:, t + 1, None, None]).sum(0)
            behind[:, t] = np.where(used[:, t + 1, None], new, 0)
        marginal = np.exp(np.clip(ahead[..., 1] + behind[..., 1] - total[:, None], -60, 0))
        n = len(label)
        gradient = np.concatenate([
            features.T @ (marginal[row, at] - label), (pairs - counts).ravel(),
            [(1 - marginal[:, 0]).sum() - starts[0], marginal[:, 0].sum() - starts[1]],
        ]) / n + decay * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {"weights": (theta[:k] / scale).tolist(), "change": theta[k : k + 4].reshape(2, 2).tolist(), "first": theta[k + 4 :].tolist()}


def fit_on(documents: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    """Fit on at most ``sample_docs`` labelled documents, those with the smallest hash of their id; whole texts.

    Documents that the base rules reject anyway teach nothing about lines and are left out. Without lines of both
    labels the fixed `PRIOR` is used.
    """
    chosen = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_llm_q"))
    chosen = chosen.orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(sample_docs).withColumnRenamed("doc_id", "_llm_id")
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_llm_id"))

    def lines(batch):
        base, features, _, in_text = measure(batch.column("text"))
        judged = ~fails_base(base)[in_text]
        features, in_text = features[judged], in_text[judged]
        quality = np.array(batch.column("_llm_q").to_pylist(), float)
        ids = np.array(batch.column("doc_id").to_pylist(), np.int64)
        place = np.arange(len(in_text)) - np.searchsorted(in_text, in_text)
        return {"doc_id": ids[in_text], "line": place, "poor": quality[in_text] < 1, "features": list(features)}

    rows = per_batch(texts.select("doc_id", "text", "_llm_q"), lines, "doc_id bigint, line bigint, poor boolean, features array<double>")
    found = rows.orderBy("doc_id", "line").toPandas()
    if found.empty:
        return PRIOR
    places = found["doc_id"].astype(str) + ":" + (found["line"] // FIT_LINES).astype(str)
    runs = (places != places.shift()).cumsum().to_numpy()
    return fit(np.stack(found["features"].to_numpy()), runs, found["poor"].to_numpy(bool))


def judge_quality(documents: DataFrame, model: dict, least_content: float = LEAST_CONTENT) -> DataFrame:
    """Add the base counts, ``base_failed``, ``kept`` and what the line model found (``n_lines``, ``content_words``,
    ``content_share``) to each document.

    Lines with a word are labelled by the best path of the chain; ``content_share`` is the share of words in content
    lines (0 without words). A document is kept if it doesn't fail the base rules and its share is ``least_content`` or
    more. Null and empty texts have no words and fail. Rows are judged one by one: repeated rows get equal verdicts,
    other columns pass unchanged, columns named as the results are replaced, no rows give no rows.
    """
    rows = without(documents, OUT)
    weights, change, first = np.array(model["weights"]), model["change"], model["first"]

    def judge(batches):
        for batch in small_batches(batches, "text"):
            base, features, words, in_text = measure(batch.column("text"))
            lean = (features @ weights).tolist()
            n = batch.num_rows
            cuts = np.searchsorted(in_text, np.arange(n + 1))
            content, lines = np.zeros(n, np.int64), np.diff(cuts)
            for i in range(n):
                path = viterbi(lean[cuts[i] : cuts[i + 1]], change, first)
                content[i] = words[cuts[i] : cuts[i + 1]][np.array(path, int) == 0].sum()
            share = content / np.maximum(base["n_words"], 1)
            failed = fails_base(base)
            out = base | {"base_failed": failed, "kept": ~failed & (share >= least_content), "n_lines": lines.astype(np.int64), "content_words": content, "content_share": share}
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(out[name]) for name in OUT]], names=[*batch.schema.names, *OUT]
            )

    kinds = {"base_failed": "boolean", "kept": "boolean", "content_share": "double"}
    return rows.mapInArrow(judge, extended(rows, ", ".join(f"{name} {kinds.get(name, 'bigint')}" for name in OUT)))


def op1_line_crf(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(documents, fit_on(documents, table(spark, sf_dir, "labels"))).drop("text")
