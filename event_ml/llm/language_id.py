"""Language identification by a byte convolutional network in numpy.

A text's UTF-8 bytes (A-Z lower-cased) are cut into fixed-length windows, the
last one padded with zeros.  Filters of several widths slide over a window,
each keeps its maximum, and a softmax over the rectified maxima gives the
languages' probabilities.  A text's score is the softmax of its windows' mean
logits, weighted by their bytes, over the whole text.

The network is trained on the driver on a bounded sample: about
``rows_per_language`` rows a language, chosen by a hash of the id, and at most
``windows_per_row`` windows of each, evenly spaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from event_ml.llm.common import kept_in_worker, map_batches, table

WINDOW = 256
WIDTHS = (2, 3, 4)


@dataclass
class Network:
    """``filters[i]``: (width, 256, n) weights of a byte at an offset."""

    languages: list[str]
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def windows_of(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw + b"\0" * (-len(raw) % WINDOW), np.uint8).reshape(-1, WINDOW)


def train(
    windows: np.ndarray, labels: np.ndarray, languages: Sequence[str], filters: int = 16, epochs: int = 4, min_steps: int = 400, batch: int = 64, rate: float = 0.01, seed: int = 7
) -> Network:
    """Adam on the cross-entropy of windows, in ``epochs`` passes or more until
    ``min_steps`` are made; half of a batch's windows are cut to a random
    length, so short texts are learned as well."""
    rng = np.random.default_rng(seed)
    kernels = [rng.normal(0, 0.3, (w, 256, filters)).astype(np.float32) for w in WIDTHS]
    hidden = filters * len(WIDTHS)
    bias = np.zeros(hidden, np.float32)
    out = rng.normal(0, 0.1, (hidden, len(languages))).astype(np.float32)
    out_bias = np.zeros(len(languages), np.float32)
    params = [*kernels, bias, out, out_bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    each = max(1, -(-len(windows) // batch))
    epochs = max(epochs, -(-min_steps // each))
    step, steps = 0, each * epochs
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            x, y = windows[order[at : at + batch]].copy(), labels[order[at : at + batch]]
            cut = np.where(rng.random(len(x)) < 0.5, rng.integers(12, WINDOW, len(x)), WINDOW)
            x[np.arange(WINDOW) >= cut[:, None]] = 0
            n, rows = len(x), np.arange(len(x))
            tops, places = [], []
            for k in kernels:
                span = WINDOW - len(k) + 1
                conv = sum(k[j][x[:, j : j + span]] for j in range(len(k)))
                place = conv.argmax(1)
                places.append(place)
                tops.append(np.take_along_axis(conv, place[:, None, :], 1)[:, 0])
            raw = np.concatenate(tops, 1) + bias
            active = np.maximum(raw, 0)
            logits = active @ out + out_bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[rows, y] -= 1
            p /= n
            back = (p @ out.T) * (raw > 0)
            grads = [np.zeros_like(k) for k in kernels]
            for i, (place, g) in enumerate(zip(places, grads, strict=True)):
                own = back[:, i * filters : (i + 1) * filters]
                column = np.broadcast_to(np.arange(filters), place.shape)
                for j in range(len(g)):
                    np.add.at(g[j], (x[rows[:, None], place + j], column), own)
            grads += [back.sum(0), active.T @ p, p.sum(0)]
            step += 1
            slower = rate * (1 - 0.9 * step / steps)
            for q, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= (slower * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Network(list(languages), kernels, bias, out, out_bias)


class Scorer:
    """A network with its filters as tables of byte pairs, which halve the look-ups."""

    def __init__(self, net: Network):
        self.net = net
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        two, three, four = net.filters
        self.two, self.three, self.four = pair(two[0], two[1]), (pair(three[0], three[1]), three[2]), (pair(four[0], four[1]), pair(four[2], four[3]))

    def logits(self, windows: np.ndarray) -> np.ndarray:
        parts = []
        for at in range(0, len(windows), 128):
            x = windows[at : at + 128]
            p = x[:, :-1].astype(np.int32) << 8 | x[:, 1:]
            tops = [self.two.take(p, 0).max(1)]
            conv = self.three[0].take(p[:, :-1], 0)
            conv += self.three[1].take(x[:, 2:], 0)
            tops.append(conv.max(1))
            conv = self.four[0].take(p[:, :-2], 0)
            conv += self.four[1].take(p[:, 2:], 0)
            tops.append(conv.max(1))
            parts.append(np.maximum(np.concatenate(tops, 1) + self.net.bias, 0) @ self.net.out + self.net.out_bias)
        return np.concatenate(parts)

    def score(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        """The best language and its probability; ``und`` and 0 for a text without letters."""
        found, scores = ["und"] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not known or not self.net.languages:
            return found, scores
        raw = [texts[i].encode("utf-8", "replace").lower() for i in known]
        n = np.array([-(-len(r) // WINDOW) for r in raw])
        starts = np.cumsum(n) - n
        weight = np.full(n.sum(), float(WINDOW))
        weight[starts + n - 1] = [len(r) - (k - 1) * WINDOW for r, k in zip(raw, n, strict=True)]
        windows = np.concatenate([windows_of(r) for r in raw])
        logits = np.add.reduceat(self.logits(windows) * weight[:, None], starts) / np.add.reduceat(weight, starts)[:, None]
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        for i, row in zip(known, p, strict=True):
            found[i], scores[i] = self.net.languages[int(row.argmax())], float(row.max())
        return found, scores


def held_out(id_col: str) -> Column:
    """Whether the id's rows are kept from training (a null id counts as empty)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_language: int = 1000, windows_per_row: int = 4
) -> Network:
    """A network trained on rows that aren't held out and have a text and a language."""
    labelled = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    counts = {r[0]: r[1] for r in labelled.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*")).collect()}
    if not counts:
        return Network([], [np.zeros((w, 256, 1), np.float32) for w in WIDTHS], np.zeros(3), np.zeros((3, 0)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, rows_per_language / n))])
    unit = F.pmod(F.xxhash64(F.lit("language sample"), F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.where(unit < share[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = windows_of(text.encode("utf-8", "replace").lower())
                own = own[np.unique(np.linspace(0, len(own) - 1, windows_per_row).astype(int))]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own)), pa.array([w.tobytes() for w in own], pa.binary())], ["lang", "bytes"])

    # rows that share an id are chosen together, so the bound is kept here as well
    most = 2 * rows_per_language * windows_per_row * len(counts)
    sample = map_batches(chosen, cut, "lang string, bytes binary").orderBy("bytes", "lang").limit(most).toArrow()
    languages = sorted(counts)
    windows = np.frombuffer(b"".join(sample.column("bytes").to_pylist()), np.uint8).reshape(-1, WINDOW)
    labels = np.array([languages.index(x) for x in sample.column("lang").to_pylist()])
    return train(windows, labels, languages)


def predict(docs: DataFrame, net: Network, text_col: str, keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns of every row with lang_pred and score.

    A text that is kept goes to the Python worker once, and the worker lets go
    of what it kept for other operators.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)  # its size is fixed by the number of languages
    kind = ("languages", uuid.uuid4().hex)
    kept = text_col in keep and docs.schema[text_col].dataType == StringType()
    at_text = list(keep).index(text_col) if kept else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept_in_worker(kind, lambda: Scorer(shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lang, score = scorer.score(part.column(at_text).to_pylist())
                columns = [*part.columns[: len(names)], pa.array(lang, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    names = [f"c{i}" for i in range(len(keep))]
    scored = [] if kept else [F.col(text_col).cast("string").alias("scored")]
    taken = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], *scored)
    types = [f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.select(*keep).schema, strict=True)]
    out = map_batches(taken, run, ", ".join([*types, "lang_pred string", "score double"]))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "lang_pred", "score")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; the whole text is read.

    Null texts and texts without a letter are ``und`` with score 0, as are all
    where no row has a language.  Texts of any length are read in windows, which
    count by their length; languages that tie are ordered as they were learned.
    Repeated rows have the same result each; a null id stays null.  Other
    columns, whatever their names, are not read.  An empty table gives no rows.
    """
    net = fit(docs, id_col, text_col, lang_col, **options)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return predict(slim, net, "text", ["doc_id"]).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = 0.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` whose language is recognised (not ``und``), with ``min_score`` at least.

    All columns are kept, whatever their names; repeated rows stay or go together.
    """
    net = fit(docs, id_col, text_col, lang_col, **options)
    inner = docs.toDF(*[f"d{i}" for i in range(len(docs.columns))])
    text = inner.columns[docs.columns.index(text_col)]
    scored = predict(inner, net, text, inner.columns).where((F.col("lang_pred") != "und") & (F.col("score") >= min_score))
    return scored.select(*inner.columns).toDF(*docs.columns)


def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
