"""Operator 1: language identification by a byte convolutional network.

Bytes (lower-cased text in UTF-8) are embedded, convolved with filters of
several widths, max-pooled over a window and classified by a softmax layer.
Training is plain numpy on labelled windows; prediction cuts a *whole* text
into overlapping windows of fixed length, runs them in batches and averages
the windows' probabilities, weighted by the letters they hold.

The training sample is bounded by ``SampleSize`` (distinct texts per language
by a hash threshold from exact counts, windows per text), so the driver holds a few MB
whatever the table's size. Prediction is a map without a shuffle; the model
travels in the function's closure (about 30 KB).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveflow.llm.columns import free_name

UNKNOWN = "und"


@dataclass(frozen=True)
class SampleSize:
    """Bounds of the training sample: expected distinct texts per language (a
    hash threshold draws them; a language with fewer gives all), windows taken
    per text, languages at most (those with most rows that can be learned from;
    a label beyond them is not learned)."""

    rows_per_lang: int = 1_500
    windows_per_row: int = 4
    langs: int = 200


@dataclass(frozen=True)
class Shape:
    """Size of the network."""

    window: int = 128
    embedding: int = 8
    widths: tuple[int, ...] = (2, 3, 4)
    filters: tuple[int, ...] = (8, 12, 12)


@dataclass
class Model:
    """Trained weights; ``langs`` in code-point order."""

    langs: list[str]
    shape: Shape
    emb: np.ndarray      # 256 x embedding
    conv: np.ndarray     # widest * embedding x all filters; narrower ones end in zeros
    conv_b: np.ndarray
    out: np.ndarray
    out_b: np.ndarray

    @property
    def widest(self) -> int:
        return max(self.shape.widths)

    def columns(self, x: np.ndarray) -> np.ndarray:
        """(windows, positions, widest * embedding) of byte windows."""
        e = self.emb[x]
        n = x.shape[1] - self.widest + 1
        return np.concatenate([e[:, k:k + n] for k in range(self.widest)], axis=2)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(windows, langs) for windows of bytes, in blocks that stay in cache."""
        parts = []
        for k in range(0, len(x), 64):
            z = self.columns(x[k:k + 64])
            m, n, d = z.shape
            h = (z.reshape(m * n, d) @ self.conv).reshape(m, n, -1).max(axis=1)
            parts.append(_softmax(np.maximum(h + self.conv_b, 0) @ self.out + self.out_b))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.langs)), np.float32)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def windows_of(data: bytes, shape: Shape) -> np.ndarray:
    """Overlapping windows that together show every run of the widest filter's
    length; the last one is filled up with zero bytes."""
    size, step = shape.window, shape.window - max(shape.widths) + 1
    n = max(1, -(-(len(data) - size) // step) + 1) if len(data) > size else 1
    buf = np.zeros((n - 1) * step + size, np.uint8)
    buf[:len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.as_strided(buf, (n, size), (step, 1))


def letters_in(x: np.ndarray) -> np.ndarray:
    """Letters (a-z, bytes beyond ASCII) of each window."""
    return (((x >= 97) & (x <= 122)) | (x >= 128)).sum(axis=1)


def train(texts: list[str], langs: list[str], shape: Shape = Shape(), epochs: int = 6,
          batch: int = 128, rate: float = 4e-3, seed: int = 7) -> Model:
    """Trains on labelled snippets, the first window of each. Languages weigh
    the same whatever their share. The same input gives the same model."""
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    x = np.stack([windows_of(_bytes(t)[:shape.window], shape)[0] for t in texts])
    y = np.array([names.index(v) for v in langs])
    widest, d = max(shape.widths), shape.embedding
    mask = np.concatenate([np.repeat((np.arange(widest) < w).astype(np.float32), d)[:, None]
                           .repeat(f, axis=1) for w, f in zip(shape.widths, shape.filters)], axis=1)
    n_f = mask.shape[1]
    p = {"emb": rng.normal(0, 1, (256, d)), "conv": rng.normal(0, 1, mask.shape) * mask / np.sqrt(widest * d / 2),
         "conv_b": np.zeros(n_f), "out": rng.normal(0, 1, (n_f, len(names))) / np.sqrt(n_f),
         "out_b": np.zeros(len(names))}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    mean = {k: np.zeros_like(v) for k, v in p.items()}
    square = {k: np.zeros_like(v) for k, v in p.items()}
    weight = len(y) / (len(names) * np.bincount(y, minlength=len(names)))
    t = 0
    steps = epochs * -(-len(x) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            pick = order[at:at + batch]
            net = Model(names, shape, p["emb"], p["conv"], p["conv_b"], p["out"], p["out_b"])
            xb, yb = x[pick], y[pick]
            z = net.columns(xb)
            m, n, w = z.shape
            conv = (z.reshape(m * n, w) @ p["conv"]).reshape(m, n, n_f)
            top = conv.argmax(axis=1)
            pooled = np.take_along_axis(conv, top[:, None, :], axis=1)[:, 0] + p["conv_b"]
            act = np.maximum(pooled, 0)
            prob = _softmax(act @ p["out"] + p["out_b"])
            prob[np.arange(m), yb] -= 1
            prob *= (weight[yb] / m)[:, None].astype(np.float32)
            g = {"out": act.T @ prob, "out_b": prob.sum(axis=0)}
            back = (prob @ p["out"].T) * (pooled > 0)
            rows = z[np.arange(m)[:, None], top]                      # m x filters x w
            g["conv"] = np.einsum("mf,mfw->wf", back, rows) * mask
            g["conv_b"] = back.sum(axis=0)
            dz = back[:, :, None] * p["conv"].T[None]                 # m x filters x w
            pos = top[:, :, None] + np.arange(widest)                 # byte positions
            seen = xb[np.arange(m)[:, None, None], pos]
            g["emb"] = np.zeros_like(p["emb"])
            np.add.at(g["emb"], seen.ravel(), dz.reshape(-1, d))
            t += 1
            lr = rate * (1 - (t - 1) / steps) + rate / 50
            for k in p:
                mean[k] = 0.9 * mean[k] + 0.1 * g[k]
                square[k] = 0.999 * square[k] + 0.001 * g[k] ** 2
                p[k] -= (lr * (mean[k] / (1 - 0.9 ** t))
                         / (np.sqrt(square[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return Model(names, shape, p["emb"], p["conv"], p["conv_b"], p["out"], p["out_b"])


def training_rows(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  size: SampleSize = SampleSize(), snippet: int = 128) -> list[tuple[str, str]]:
    """A bounded sample of (snippet, language) from labelled rows.

    A row belongs when the hash of its text is below its language's share
    (``rows_per_lang`` / distinct texts of the language, counted exactly by
    their 64-bit hashes, so copies do not shrink the sample); snippets start
    at hashed places all over the text. Rows without a letter teach nothing.
    The result does not depend on how the table is partitioned.
    """
    rows = (docs.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"))
            .where(F.col("l").isNotNull() & F.col("t").rlike(r"\p{L}"))
            .withColumn("h", F.xxhash64("t", "l")))
    # copies are combined before the shuffle: one row for each distinct text and language
    counts = {r["l"]: r["texts"] for r in rows.groupBy("l", "h").agg(F.count("*").alias("n"))
              .groupBy("l").agg(F.sum("n").alias("n"), F.count("*").alias("texts"))
              .orderBy(F.desc("n"), "l").limit(size.langs).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(v) for k, n in sorted(counts.items())
                           for v in (k, min(1.0, size.rows_per_lang / n))])
    picked = rows.where(F.pmod("h", F.lit(1 << 30)) < share[F.col("l")] * float(1 << 30))
    length = F.char_length("t")
    start = [F.pmod(F.xxhash64("h", F.lit(k)), F.greatest(length - snippet + 1, F.lit(1))) + 1
             for k in range(size.windows_per_row)]
    one = F.explode(F.array_distinct(F.array(*[F.substring("t", s.cast("int"), F.lit(snippet)) for s in start])))
    # copies of one text draw the same snippets: distinct ones keep the sample bounded
    got = picked.select(one.alias("s"), "l").distinct().collect()
    return sorted((r["s"], r["l"]) for r in got if any(c.isalpha() for c in r["s"]))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
        size: SampleSize = SampleSize(), shape: Shape = Shape()) -> Model | None:
    """A model of the languages in ``docs``; None when no row is labelled."""
    sample = training_rows(docs, text_col, lang_col, size, shape.window)
    if not sample:
        return None
    return train([s for s, _ in sample], [v for _, v in sample], shape)


def predict_texts(model: Model | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of whole texts."""
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if model is None:
        return langs, scores
    held, owner, held_n = [], [], 0

    total = np.zeros((len(texts), len(model.langs)))
    weight = np.zeros(len(texts))

    def flush() -> None:
        nonlocal held, owner, held_n
        if held:
            x = np.concatenate(held)
            who = np.repeat([o for o, _ in owner], [n for _, n in owner])
            w = letters_in(x) + 1e-3
            np.add.at(total, who, model.probabilities(x) * w[:, None])
            np.add.at(weight, who, w)
        held, owner, held_n = [], [], 0

    known = []
    for i, t in enumerate(texts):
        if not t or not any(map(str.isalpha, t)):
            continue
        known.append(i)
        x = windows_of(_bytes(t), model.shape)
        for k in range(0, len(x), 4096):   # a very long text goes through in parts
            held.append(x[k:k + 4096])
            owner.append((i, len(held[-1])))
            held_n += len(held[-1])
            if held_n >= 2048:
                flush()
    flush()
    for i in known:
        mean = total[i] / weight[i]
        best = int(mean.argmax())
        langs[i], scores[i] = model.langs[best], float(min(1.0, mean[best]))
    return langs, scores


def language(text: str | Column, model: Model | None) -> Column:
    """Struct (lang, score) of each whole text; ``und`` and 0 when the text is
    null or has no letter, or when nothing was learned."""

    @F.arrow_udf("lang string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            langs, scores = [], []
            for k in range(0, len(batch), 512):
                a, b = predict_texts(model, batch.slice(k, 512).to_pylist())
                langs += a
                scores += b
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["lang", "score"])

    return predicted(F.col(text) if isinstance(text, str) else text)


def predict_language(docs: DataFrame, model: Model | None, text_col: str = "text",
                     lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1).

    Columns of those names that ``docs`` already has are replaced; all others
    are kept. Null, empty and letterless texts get ``und`` and 0. Equal texts
    get equal answers; no rows: an empty result.
    """
    own = [F.col(f"`{c}`") for c in docs.columns if c not in (lang_col, score_col)]
    found = free_name(docs, "_language")
    return (docs.select(*own, language(text_col, model).alias(found))
            .select(*own, F.col(f"{found}.lang").alias(lang_col), F.col(f"{found}.score").alias(score_col)))


def held_out(id_col: str = "doc_id") -> Column:
    """True for the rows that are never learned from: crc32 of the id as text
    leaves remainder 1 by 3; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows a model may learn from: not held out, with an id."""
    return docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))
