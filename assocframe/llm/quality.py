"""Quality rules: gradient-boosted trees over document statistics.

Each text gives a handful of statistics.  A model is boosted in numpy on a
bounded sample of labelled documents and flattened into node arrays, with which
tasks score whole batches at once.  On chosen statistics the score may only fall
(or rise) as the statistic grows, so a text never gains by more symbols,
repetition or shouting.

Defined results: a NULL, empty or blank text has no words and fails the base
rule; NULL ids are kept as they are; repeated rows are judged one by one; an
empty table gives an empty result; labels that are NULL, or belong to no
document, teach nothing; with no labels (or one class) the trees accept
everything, so that only the base rule decides.  Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocframe.llm.common import keep_rows, map_rows

#: At most so many labelled documents are used for training (those of the smallest hash).
MAX_LABELLED = 20_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SYMBOLS = b"#*$%&|<>"
_SPACE = np.frombuffer(b" \t\n\r\x0b\x0c", dtype=np.uint8)
_SYMBOL = np.frombuffer(SYMBOLS, dtype=np.uint8)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Model inputs and the direction of the score in each: -1 falls, 1 rises, 0 free.
FEATURES = {
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_word_share": -1,
    "upper_share": -1,
    "exclaim_per_word": -1,
    "digit_share": -1,
    "log_words": 1,
    "mean_word_chars": 0,
    "distinct_word_share": 0,
}


def repeat_words(words: list[bytes]) -> tuple[int, int]:
    """Words that lie in a 3-word window found twice or more, and the number of distinct words."""
    n = len(words)
    seen: dict[bytes, int] = {}
    ids = np.fromiter(map(seen.setdefault, words, range(n)), dtype=np.int64, count=n)
    if n < 4:
        return 0, len(seen)
    # Number adjacent pairs densely first, so that a window's key stays below n * n.
    _, pair = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    hit = np.zeros(n, dtype=bool)
    for k in range(3):
        hit[k : n - 2 + k] |= again
    return int(hit.sum()), len(seen)


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts (in the order of ``BASE``) and the model inputs of one text."""
    raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
    words = raw.split()
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    points = len(raw) - int(count[0x80:0xC0].sum())
    chars = points - int(count[_SPACE].sum())
    symbols = int(count[_SYMBOL].sum())
    lines, seen, copies = 0, set(), 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            copies += line in seen
            seen.add(line)
    repeated, distinct = repeat_words(words)
    n = max(1, len(words))
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    inputs = [
        symbols / n,
        copies / max(1, lines),
        repeated / n,
        upper / max(1, upper + lower),
        int(count[33]) / n,
        int(count[48:58].sum()) / max(1, chars),
        float(np.log1p(len(words))),
        chars / n,
        distinct / n,
    ]
    return [len(words), chars, symbols, copies, repeated], inputs


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


# Trees ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Trees:
    """Boosted trees as flat arrays: node ``i`` sends x[feature] <= threshold to ``left``; leaves point at themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for each row of inputs."""
        rows = np.arange(len(x))[:, None]
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(self.depth):
            over = x[rows, self.feature[node]] > self.threshold[node]
            node = np.where(over, self.right[node], self.left[node])
        return 1 / (1 + np.exp(-(self.start + self.value[node].sum(axis=1))))


def boost(
    x: np.ndarray,
    y: np.ndarray,
    direction: list[int],
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    l2: float = 1.0,
    min_weight: float = 2.0,
) -> Trees:
    """Newton boosting of the logistic loss on binned inputs with monotonic directions."""
    nodes: list[list[float]] = []
    roots: list[int] = []
    good = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 1 - 1e-3
    start = float(np.log(good / (1 - good)))
    if len(y) and 0 < y.mean() < 1:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1)
        margin = np.full(len(y), start)

        def leaf(g: float, h: float, low: float, high: float) -> float:
            return float(np.clip(-g / (h + l2), low, high))

        def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
            g, h = grad[rows], hess[rows]
            sum_g, sum_h = g.sum(), h.sum()
            best = (1e-6, -1, 0, 0.0, 0.0)
            for j, c in enumerate(cuts if level < depth else []):
                if not len(c):
                    continue
                left_g = np.cumsum(np.bincount(binned[rows, j], g, len(c) + 1))[:-1]
                left_h = np.cumsum(np.bincount(binned[rows, j], h, len(c) + 1))[:-1]
                right_g, right_h = sum_g - left_g, sum_h - left_h
                a = np.clip(-left_g / (left_h + l2), low, high)
                b = np.clip(-right_g / (right_h + l2), low, high)
                whole = leaf(sum_g, sum_h, low, high)
                # Loss of a node with value v is g v + (h + l2) v^2 / 2.
                gain = (sum_g * whole + (sum_h + l2) * whole**2 / 2) - (
                    left_g * a + (left_h + l2) * a**2 / 2 + right_g * b + (right_h + l2) * b**2 / 2
                )
                allowed = (left_h >= min_weight) & (right_h >= min_weight) & ((b - a) * direction[j] >= 0)
                gain = np.where(allowed, gain, -np.inf)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), j, k, float(a[k]), float(b[k]))
            me = len(nodes)
            nodes.append([0, np.inf, me, me, rate * leaf(sum_g, sum_h, low, high)])
            _, j, k, a, b = best
            if j >= 0:
                inside = binned[rows, j] <= k
                middle = (a + b) / 2
                bounds = [(low, high), (low, high)]
                if direction[j] > 0:
                    bounds = [(low, middle), (middle, high)]
                elif direction[j] < 0:
                    bounds = [(middle, high), (low, middle)]
                at = grow(rows[inside], level + 1, *bounds[0])
                to = grow(rows[~inside], level + 1, *bounds[1])
                nodes[me] = [j, cuts[j][k], at, to, 0.0]
            else:
                margin[rows] += nodes[me][4]
            return me

        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
    table = np.array(nodes, dtype=np.float64).reshape(-1, 5)
    return Trees(
        *(table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64)),
        *(table[:, 4], np.array(roots, dtype=np.int64), depth, start),
    )


# Spark ----------------------------------------------------------------------------

_INPUTS = "array<double>"


def learn_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Trees:
    """Train on at most ``max_labelled`` labelled documents; only their statistics reach the driver."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_quality")).dropna()
    # About twice the sample passes a cut on the hash, so no task sends the driver more than its share of that.
    share = min(1.0, (2 * max_labelled + 1000) / max(1, known.count()))
    draw = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = known.withColumn("_draw", draw).filter(F.col("_draw") < share)
    chosen = drawn.orderBy("_draw", "_id", "_quality").limit(max_labelled).drop("_draw")
    # The sample has at most max_labelled pairs of numbers, whatever the size of the tables.
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    joined = texts.join(F.broadcast(chosen), "_id").select("_text", "_quality")

    def measure(rows: list[dict]) -> dict[str, list]:
        return {"x": [statistics(r["_text"])[1] for r in rows], "y": [float(r["_quality"] > 0) for r in rows]}

    # Ids that repeat in both tables could multiply the sample, hence the second limit.
    taught = map_rows(joined, measure, f"x {_INPUTS}, y double").limit(4 * max_labelled).toArrow()
    x = np.array(taught["x"].to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    y = np.array(taught["y"].to_pylist(), dtype=np.float64)
    order = np.lexsort((*x.T, y))
    return boost(x[order], y[order], list(FEATURES.values()))


def judge(texts: list[str | None], model: Trees, threshold: float) -> dict[str, list]:
    """Base counts, base_failed, score and verdict of a batch of texts."""
    found = [statistics(t) for t in texts]
    base = np.array([b for b, _ in found], dtype=np.int64).reshape(-1, len(BASE))
    score = model.score(np.array([x for _, x in found], dtype=np.float64).reshape(-1, len(FEATURES)))
    failed = [base_failed(int(b[0]), int(b[4])) for b in base]
    kept = [not f and s >= threshold for f, s in zip(failed, score.tolist(), strict=True)]
    out: dict[str, list] = {name: base[:, k].tolist() for k, name in enumerate(BASE)}
    return out | {"base_failed": failed, "kept": kept, "score": score.tolist()}


def quality_rules(docs: DataFrame, model: Trees, threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the model's score of every document."""

    def run(rows: list[dict]) -> dict[str, list]:
        return {"doc_id": [r["doc_id"] for r in rows]} | judge([r["text"] for r in rows], model, threshold)

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{name} bigint" for name in BASE)
    schema = f"doc_id {kind}, {counts}, base_failed boolean, kept boolean, score double"
    return map_rows(docs.select("doc_id", "text"), run, schema)


def keep_quality(docs: DataFrame, model: Trees, threshold: float = 0.5) -> DataFrame:
    """The documents that pass, with all their columns."""
    return keep_rows(docs, "text", lambda texts: judge(texts, model, threshold)["kept"])
