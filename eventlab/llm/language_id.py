"""Language identification by a small convolutional network over bytes.

A window of bytes passes filters of several widths; each filter keeps its largest response in
the window, and a softmax over the learned languages follows.  A text is cut into windows end
to end and the windows' log-probabilities are averaged by the bytes they hold, so that every
byte counts.  The network is trained in numpy on a bounded sample of labelled documents:
``per_language`` documents of each language, chosen by a hash of their id, and a few windows
of each.  The first layer is kept as tables over byte pairs, so a response is a sum of a few
table rows.

A text that is null or has no letter is ``und`` with score 0.  With no labelled document
every text is ``und``.  Rows are judged one by one, so repeated rows agree; other columns and
the language or source of a row are never inputs of its prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlab.llm.common import in_small_batches, portions, table, utf8

WINDOW, WIDTHS, FILTERS, CODE = 192, (2, 3, 4), 16, 8
PORTION = 256 << 10


def windows_of(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows, zero-padded, with the row and the byte count of each."""
    sizes = np.diff(borders)
    each = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), each)
    nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    begin = borders[row] + nth * WINDOW
    held = np.minimum(WINDOW, borders[row + 1] - begin)
    at = begin[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < held[:, None]
    padded = np.append(data, np.uint8(0))
    return np.where(inside, padded[np.minimum(at, len(data))], np.uint8(0)), row, held


class Network:
    """Byte codes, filters of several widths, the largest response of each, softmax."""

    def __init__(self, languages: list[str], seed: int = 7):
        make = np.random.default_rng(seed)
        self.languages = languages
        self.code = make.normal(0, 0.5, (256, CODE)).astype(np.float32)
        self.code[0] = 0
        self.filters = [make.normal(0, 1 / np.sqrt(w * CODE), (w * CODE, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = make.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.shift = np.zeros(len(languages), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.code, *self.filters, self.bias, self.out, self.shift]

    def step(self, windows: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy over one batch."""
        n, coded = len(windows), self.code[windows]
        seen, arg, pooled = [], [], []
        for w, f in zip(WIDTHS, self.filters):
            view = np.lib.stride_tricks.sliding_window_view(coded, w, axis=1).transpose(0, 1, 3, 2).reshape(n, -1, w * CODE)
            response = view @ f
            best = response.argmax(axis=1)
            seen.append(view), arg.append(best)
            pooled.append(np.take_along_axis(response, best[:, None, :], 1)[:, 0])
        raw = np.concatenate(pooled, axis=1) + self.bias
        hidden = np.maximum(raw, 0)
        chance = softmax(hidden @ self.out + self.shift)
        chance[np.arange(n), wanted] -= 1
        chance /= n
        back = (chance @ self.out.T) * (raw > 0)
        code = np.zeros_like(self.code)
        grads = []
        for k, (w, f) in enumerate(zip(WIDTHS, self.filters)):
            part = back[:, k * FILTERS:(k + 1) * FILTERS]
            patch = np.take_along_axis(seen[k], arg[k][:, :, None], 1)  # the winning patches
            grads.append(np.einsum("nfc,nf->cf", patch, part))
            to_code = np.einsum("nf,cf->nfc", part, f).reshape(n, FILTERS, w, CODE)
            where = windows[np.arange(n)[:, None, None], arg[k][:, :, None] + np.arange(w)]
            np.add.at(code, where, to_code)
        code[0] = 0
        return [code, *grads, back.sum(0), hidden.T @ chance, chance.sum(0)]

    def train(self, windows: np.ndarray, wanted: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 3e-3, seed: int = 11) -> None:
        """Adam over shuffled batches."""
        order = np.random.default_rng(seed)
        first = [np.zeros_like(x) for x in self.weights()]
        second = [np.zeros_like(x) for x in self.weights()]
        turn = 0
        for _ in range(epochs):
            for at in np.array_split(order.permutation(len(windows)), max(1, len(windows) // batch)):
                turn += 1
                for x, g, m, v in zip(self.weights(), self.step(windows[at], wanted[at]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    x -= rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.999 ** turn)) + 1e-8)

    def tables(self) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Per width, the responses of its first byte pair and of the bytes or the pair after it."""
        out = []
        for w, f in zip(WIDTHS, self.filters):
            single = [self.code @ f[k * CODE:(k + 1) * CODE] for k in range(w)]
            pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(1 << 16, FILTERS)
            rest = None if w == 2 else single[2] if w == 3 else pair(single[2], single[3])
            out.append((pair(single[0], single[1]), rest))
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


class Reader:
    """A trained network, ready to judge windows."""

    def __init__(self, network: Network):
        self.languages, self.bias, self.out, self.shift, self.tables = network.languages, network.bias, network.out, network.shift, network.tables()

    def log_chances(self, windows: np.ndarray) -> np.ndarray:
        pairs = windows[:, :-1].astype(np.uint16) << 8 | windows[:, 1:]
        pooled = []
        for (first, rest), w in zip(self.tables, WIDTHS):
            response = first[pairs[:, :WINDOW - w + 1]]
            if w == 3:
                response += rest[windows[:, 2:]]
            elif w == 4:
                response += rest[pairs[:, 2:]]
            pooled.append(response.max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        return np.log(softmax(hidden @ self.out + self.shift) + 1e-9)

    def judge(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language number and score of each row; -1 for a row without bytes."""
        count, total = len(borders) - 1, np.zeros((len(borders) - 1, len(self.languages)))
        for first, last in portions(borders, PORTION):
            for begin in range(borders[first], max(borders[last], borders[first] + 1), 64 * PORTION):  # a very long text in pieces
                end = min(begin + 64 * PORTION, borders[last])
                windows, row, held = windows_of(data[begin:end], np.clip(borders[first:last + 1], begin, end) - begin)
                for at in range(0, len(windows), 512):
                    np.add.at(total, first + row[at:at + 512], self.log_chances(windows[at:at + 512]) * held[at:at + 512, None])
        sizes = np.diff(borders)
        chance = softmax(total / np.maximum(sizes, 1)[:, None])
        return np.where(sizes > 0, chance.argmax(axis=1), -1), chance.max(axis=1) if count else np.zeros(0)


def judged(batches: Iterator[pa.RecordBatch], network: Network | None) -> Iterator[pa.RecordBatch]:
    reader = Reader(network) if network else None
    for batch in batches:
        letters = np.array(batch["_letters"].to_pylist(), bool)
        if reader:
            best, score = reader.judge(*utf8(batch["_judge"]))
        else:
            best, score = np.full(len(letters), -1), np.zeros(len(letters))
        known = letters & (best >= 0)
        names = np.array([*(reader.languages if reader else []), "und"], object)
        rest = [c for c in batch.schema.names if c not in ("_judge", "_letters")]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in rest), pa.array(names[np.where(known, best, -1)], pa.string()),
                                          pa.array(np.where(known, np.clip(score, 0, 1), 0.0))], names=[*rest, "_lang", "_score"])


def held_out(key: str = "doc_id") -> Column:
    """One document in four is kept from training, by its id."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2


def fit(docs: DataFrame, per_language: int = 400, windows_each: int = 8, key: str = "doc_id") -> Network | None:
    """Train on at most ``per_language`` documents of each language and ``windows_each`` windows of each.

    The sample follows the hash of the id; first about twice as many are kept by the share
    that is needed, then the smallest hashes of each language.
    """
    learn = docs.where(F.col("lang").isNotNull() & F.col(key).isNotNull() & ~held_out(key)).withColumn("_h", F.xxhash64(F.lit("sample"), F.col(key)))
    sizes = learn.groupBy("lang").count().withColumn("_share", F.lit(2.0 * per_language + 50) / F.col("count"))
    near = learn.join(F.broadcast(sizes), "lang").where(F.abs(F.col("_h") / F.lit(float(1 << 63))) < F.col("_share"))  # one row per language
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h", key))
    cuts = near.select(key, "lang", "_h", rank.alias("_n")).where(F.col("_n") <= per_language).groupBy("lang").agg(F.max("_h").alias("_cut"), F.first(F.lit(1)).alias("_one"))
    chosen = near.join(F.broadcast(cuts), "lang").where(F.col("_h") <= F.col("_cut"))
    size = F.length("text")
    spots = [F.substring("text", F.greatest(F.lit(1), F.floor(size * F.lit((k + 0.5) / windows_each)) - WINDOW // 2).cast("int"), F.lit(WINDOW)) for k in range(windows_each)]
    pieces = chosen.where("text RLIKE '\\\\p{L}'").select("lang", "_h", key, F.explode(F.array_distinct(F.array(*spots))).alias("piece"))
    rows = sorted(pieces.select("lang", "_h", key, "piece").collect())  # bounded by the two parameters and the languages
    if not rows:
        return None
    names = sorted({r["lang"] for r in rows})
    encoded = [r["piece"].encode()[:WINDOW] for r in rows]
    borders = np.concatenate([[0], np.cumsum([len(x) for x in encoded])])
    windows, row, _ = windows_of(np.frombuffer(b"".join(encoded), np.uint8), borders)
    network = Network(names)
    network.train(windows, np.array([names.index(r["lang"]) for r in rows])[row])
    return network


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with ``_lang`` and ``_score``."""
    rows = docs.select("*", F.col("text").alias("_judge"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return in_small_batches(rows).mapInArrow(partial(judged, network=network), f"{kinds}, _lang string, _score double")


def keep_known(docs: DataFrame, floor: float = 0.3) -> DataFrame:
    """The documents that have a language: those without a letter, or judged below ``floor``, go."""
    out = predict(docs, fit(docs))
    return out.where((F.col("_lang") != "und") & (F.col("_score") >= floor)).select(*docs.columns)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    out = predict(docs.select("doc_id", "text"), fit(docs.select("doc_id", "text", "lang")))
    return out.select("doc_id", held_out().alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))
