"""Language identification with a convolutional network over bytes.

The network embeds bytes, applies filters of several widths, pools the largest
response over a window and ends in a softmax.  It is trained in numpy with Adam
on a bounded sample of labelled texts.  To predict, embedding and filters are
folded into one response table of byte pairs, so all filters of widths two to
four cost one table read per byte; this changes no value.  Every byte of every
text lies in a window; a text's probabilities are the mean over its windows,
weighted by their bytes.

Defined results: ``und`` with score 0 for a NULL, an empty or a letterless text,
and for any text if nothing could be learned; a language whose training texts
hold no letter is not learned; rows with NULL or repeated ids are predicted like
any other; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assocframe.llm.common import fold_of, keep_rows, map_rows

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBED = 8
#: About so many texts of a language are used for training; fewer, where languages are so many that all
#: together would pass MAX_TEXTS.  More languages than MAX_LANGUAGES are refused, never left out.
TEXTS_PER_LANGUAGE = 400
MAX_TEXTS = 80_000
MAX_LANGUAGES = 10_000
WINDOWS_PER_TEXT = 8
UNKNOWN = "und"

_STEP = WINDOW - max(WIDTHS) + 1  # windows overlap just enough for no byte group to be lost
_AT_ONCE = 64


@dataclass(frozen=True)
class ByteCnn:
    """``table``: responses to the byte pair at a place (all filters), then to the pair two bytes on (widths 3 and 4)."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of each window; x: (n, WINDOW) bytes."""
        result = np.empty((len(x), len(self.languages)), dtype=np.float32)
        all_filters, narrow = len(WIDTHS) * FILTERS, FILTERS
        for at in range(0, len(x), _AT_ONCE):
            part = np.ascontiguousarray(x[at : at + _AT_ONCE].T)  # places first: sums and maxima run over long rows
            pair = part[:-1].astype(np.int64) << 8 | part[1:]
            found = self.table.take(pair, axis=0, mode="clip")
            here, later = found[..., :all_filters], found[2:, :, all_filters:]
            # Places where wider filters would reach past the window count for width 2 only.
            wide = (here[: WINDOW - 3, :, narrow:] + later[: WINDOW - 3]).max(axis=0)
            pooled = np.concatenate([here[..., :narrow].max(axis=0), wide], axis=1)
            logits = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
            e = np.exp(logits - logits.max(axis=1, keepdims=True))
            result[at : at + _AT_ONCE] = e / e.sum(axis=1, keepdims=True)
        return result

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        for group in _groups(texts):
            cut = [cut_windows(texts[i]) for i in group]
            p = self.windows(np.concatenate([w for w, _ in cut]))
            at = 0
            for i, (w, used) in zip(group, cut, strict=True):
                mean = used @ p[at : at + len(w)] / used.sum()
                at += len(w)
                best = int(mean.argmax())
                names[i], scores[i] = self.languages[best], float(min(1.0, mean[best]))
        return names, scores


def _groups(texts: list[str | None], most: int = 1 << 21) -> list[list[int]]:
    """Places of the texts with a letter, in groups of about so many characters."""
    groups: list[list[int]] = [[]]
    size = 0
    for i, text in enumerate(texts):
        if text is not None and any(map(str.isalpha, text)):
            if size > most:
                groups.append([])
                size = 0
            groups[-1].append(i)
            size += len(text)
    return [g for g in groups if g]


def cut_windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text in lower case, and the number of its bytes in each."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n = max(1, -(-(len(data) - (WINDOW - _STEP)) // _STEP))
    padded = np.zeros((n - 1) * _STEP + WINDOW, dtype=np.uint8)
    padded[: len(data)] = data
    used = np.minimum(WINDOW, len(data) - np.arange(n) * _STEP)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::_STEP], used.astype(np.float32)


# Training -------------------------------------------------------------------------


def sample_windows(text: str, count: int, seed: int) -> list[bytes]:
    """Some windows of a text, half of them cut short so that short texts are known too."""
    data = text.lower().encode("utf-8", "surrogatepass")
    rng = np.random.default_rng(seed)
    found = []
    for k in range(count):
        at = int(rng.integers(0, max(1, len(data) - WINDOW + 1)))
        n = WINDOW if k % 2 else int(8 * 2 ** rng.uniform(0, 4))
        found.append(data[at : at + n].ljust(WINDOW, b"\0"))
    return found


def train(x: np.ndarray, y: np.ndarray, languages: tuple[str, ...], steps: int = 400, batch: int = 96) -> ByteCnn:
    """x: (n, WINDOW) bytes; y: places in ``languages``."""
    if not len(languages) or not len(x):
        return ByteCnn((), np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    rng = np.random.default_rng(7)
    shape = lambda *n: rng.normal(0, 1, n).astype(np.float32)
    p = {"e": shape(256, EMBED) * 0.5, "v": shape(len(WIDTHS) * FILTERS, len(languages)) * 0.1}
    p["c"] = np.zeros(len(languages), dtype=np.float32)
    for w in WIDTHS:
        p[f"w{w}"] = shape(w, EMBED, FILTERS) * (1 / np.sqrt(w * EMBED))
        p[f"b{w}"] = np.zeros(FILTERS, dtype=np.float32)
    first = {k: np.zeros_like(a) for k, a in p.items()}
    second = {k: np.zeros_like(a) for k, a in p.items()}
    by_language = [np.flatnonzero(y == k) for k in range(len(languages))]
    for step in range(1, steps + 1):
        chosen = rng.integers(0, len(languages), batch)  # languages alike, however unlike their numbers of texts
        rows = np.array([by_language[k][rng.integers(0, len(by_language[k]))] for k in chosen])
        xb, yb = x[rows], y[rows]
        best, pooled = {}, []
        for w in WIDTHS:
            places = WINDOW - w + 1 if w == 2 else WINDOW - 3
            total = np.zeros((batch, places, FILTERS), dtype=np.float32)
            for k in range(w):
                total += (p["e"] @ p[f"w{w}"][k]).take(xb[:, k : k + places], axis=0)
            best[w] = total.argmax(axis=1)
            pooled.append(np.take_along_axis(total, best[w][:, None], axis=1)[:, 0] + p[f"b{w}"])
        z = np.concatenate(pooled, axis=1)
        hidden = np.maximum(z, 0)
        logits = hidden @ p["v"] + p["c"]
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        d = e / e.sum(axis=1, keepdims=True)
        d[np.arange(batch), yb] -= 1
        d /= batch
        grad = {k: np.zeros_like(a) for k, a in p.items()}
        grad["v"], grad["c"] = hidden.T @ d, d.sum(axis=0)
        dz = (d @ p["v"].T) * (z > 0)
        for j, w in enumerate(WIDTHS):
            g = dz[:, j * FILTERS : (j + 1) * FILTERS]
            grad[f"b{w}"] = g.sum(axis=0)
            for k in range(w):
                seen = np.take_along_axis(xb, best[w] + k, axis=1)  # the byte each filter answered to
                grad[f"w{w}"][k] = np.einsum("bfe,bf->ef", p["e"][seen], g)
                np.add.at(grad["e"], seen, np.einsum("bf,ef->bfe", g, p[f"w{w}"][k]))
        rate = 0.01 * min(1, 2 * (1 - step / (steps + 1)))
        for k in p:
            first[k] += 0.1 * (grad[k] - first[k])
            second[k] += 0.01 * (grad[k] ** 2 - second[k])
            p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    fold = {w: [p["e"] @ p[f"w{w}"][k] for k in range(w)] for w in WIDTHS}
    first_two = [f[0][:, None] + f[1][None] for f in fold.values()]
    next_two = [np.broadcast_to(fold[3][2][:, None], (256, 256, FILTERS)), fold[4][2][:, None] + fold[4][3][None]]
    table = np.concatenate(first_two + next_two, axis=2).reshape(65536, -1)
    return ByteCnn(languages, table, np.concatenate([p[f"b{w}"] for w in WIDTHS]), p["v"], p["c"])


# Spark ----------------------------------------------------------------------------


def learn_languages(docs: DataFrame, usable: Column | None = None) -> ByteCnn:
    """Train on a sample of the rows of (doc_id, text, lang) that are ``usable``.

    All languages are learned.  The driver receives one count per language and
    windows of 128 bytes, WINDOWS_PER_TEXT of each text, of at most
    2 * MAX_TEXTS texts.  Which rows are in the sample goes by hashes, so reruns
    agree.
    """
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    if usable is not None:
        known = known.filter(usable)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample"), "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    known = known.withColumn("draw", draw)
    figures = known.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min("draw").alias("first"))
    counts = figures.orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return train(np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), ())
    per_language = min(TEXTS_PER_LANGUAGE, MAX_TEXTS // len(counts))
    shares = [(r["lang"], min(1.0, 1.5 * per_language / r["count"]), r["first"]) for r in counts]
    # At most MAX_LANGUAGES rows.
    share = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, share double, first double"))
    is_first = F.col("draw") == F.col("first")  # no language goes without a text
    chosen = known.join(share, "lang").filter((F.col("draw") < F.col("share")) | is_first)
    chosen = chosen.select("text", "lang", "draw", (~is_first).alias("later"))

    def windows(rows: list[dict]) -> dict[str, list]:
        draws = [r["draw"] for r in rows]
        cut = [sample_windows(r["text"], WINDOWS_PER_TEXT, int(d * (1 << 30))) for r, d in zip(rows, draws, strict=True)]
        return {"x": [b"".join(c) for c in cut]} | {k: [r[k] for r in rows] for k in ("lang", "draw", "later")}

    # Rows of equal ids and texts share a draw and count once; the limit holds even if many draws should agree.
    cut = map_rows(chosen, windows, "x binary, lang string, draw double, later boolean").distinct()
    taken = cut.orderBy("later", "draw", "lang", "x").limit(2 * per_language * len(counts)).select("lang", "x")
    # Sorted, so that the model does not depend on the order in which tasks end.
    found = sorted((r["lang"], bytes(r["x"])) for r in taken.collect())
    languages = tuple(sorted({lang for lang, _ in found}))
    place = {lang: k for k, lang in enumerate(languages)}
    x = np.frombuffer(b"".join(b for _, b in found), dtype=np.uint8).reshape(-1, WINDOW)
    y = np.repeat(np.array([place[lang] for lang, _ in found], dtype=np.int64), WINDOWS_PER_TEXT)
    return train(x, y, languages)


def identify(docs: DataFrame, model: ByteCnn, held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; only id and text are read."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    mark = F.lit(False) if held_out is None else held_out
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size, 10 MB

    def run(rows: list[dict]) -> dict[str, list]:
        names, scores = shared.value.predict([r["text"] for r in rows])
        ids, marks = [r["doc_id"] for r in rows], [r["held_out"] for r in rows]
        return {"doc_id": ids, "held_out": marks, "lang_pred": names, "score": scores}

    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    return map_rows(docs.select("doc_id", "text", mark.alias("held_out")), run, schema)


def keep_identified(docs: DataFrame, model: ByteCnn, min_score: float) -> DataFrame:
    """The documents whose language is known with at least ``min_score``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def verdicts(texts: list) -> list[bool]:
        names, scores = shared.value.predict(texts)
        return [n != UNKNOWN and s >= min_score for n, s in zip(names, scores, strict=True)]

    return keep_rows(docs, "text", verdicts)


def held_out_fold(doc_id: str = "doc_id") -> Column:
    return fold_of(doc_id, 4) == 2
