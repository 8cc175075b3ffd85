"""Language-model scores by a hashed maximum-entropy model.

The probability of a token given the tokens before it has two factors, a
softmax over classes and the token's share of its class:

    P(token | history) = P(class | history) * (c + 1) / Z(class)

* A word's class follows from its first two bytes; the end has one of its own.
  P(class | history) is a softmax over the sum of weight rows of the active
  features: the word before, the two before, and two skips (the second and the
  third word back), hashed into ``BUCKETS`` rows, and a bias row.
* Within a class the features are the words themselves, for which the
  maximum-entropy solution is their smoothed relative frequency.  Z adds one
  for words that training didn't have, so the probabilities add up to one.

Training goes over all training documents in ``rounds`` parts.  In a round
each task starts from the common weights, makes AdaGrad steps on mini-batches
of its documents, every position of them once, and hands on the rows it moved;
rows are averaged by the number of their updates.  The same pass counts all words of its documents.

Word counts grow with the corpus and are never broadcast.  Scoring sums the
logarithms of frequent words' counts (at most ``frequent`` words, by all
documents' counts, so no other word is hot) in the scoring task, and joins the
other words with their counts in Spark.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from event_ml.llm.common import map_batches, staged, table

CLASSES = 48
END = CLASSES - 1
BUCKETS = 1 << 14
#: Rows of classes that are worked on at a time.
SPAN = 1024
#: Words of so many rows, or of so many bytes of text, are looked up at a time; their tokens are worked on ``FEW`` rows at a time.
PART, PART_BYTES, FEW = 512, 4 << 20, 64
#: Odd multipliers of the feature hashes.
MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def word_class(word: bytes) -> int:
    return zlib.crc32(word[:2]) % END


class Numbered:
    """Words to numbers from 0, in order of appearance."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self._codes = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.numbers)

    def since(self, n: int) -> list[bytes]:
        """The words numbered from ``n`` on."""
        return list(islice(reversed(self.numbers), len(self) - n))[::-1]

    def of(self, docs: list[list[bytes]]) -> np.ndarray:
        """The numbers of all words of ``docs``, one after the other."""
        return np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(docs)), np.int64, sum(map(len, docs)))

    def of_words(self, words: pa.Array) -> np.ndarray:
        """The numbers of ``words``; each distinct one is looked up once."""
        found = words.dictionary_encode()
        own = found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
        return np.fromiter(map(self.numbers.__getitem__, own), np.int64, len(own))[found.indices.to_numpy()]

    def codes(self) -> np.ndarray:
        """The words' classes and 32-bit hashes, by number."""
        new = self.since(len(self._codes))
        if new:
            classes, hashes = (np.array(x, np.int64) for x in ([word_class(w) for w in new], [zlib.crc32(w) for w in new]))
            self._codes = np.append(self._codes, classes << 32 | hashes | 1)
        return self._codes


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after the other, and how many each text has: those of ``words_of``."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = parts.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # blanks at a text's ends leave empty strings
    upto = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return words.filter(some), np.diff(upto[parts.offsets.to_numpy()])


def parts_of(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``PART`` rows at most with ``PART_BYTES`` of text in the column at most, or one row."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PART_BYTES, "right"))
        n = min(PART, max(1, end - at))
        yield batch.slice(at, n)
        at += n


def targets(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, classes, starts): a row of feature buckets and a class for
    every token of ``docs``, ends included, and where each document begins."""
    words = Numbered()
    numbers = words.of(docs)
    return targets_of(words.codes()[numbers], np.array([len(d) for d in docs]))


def targets_of(own_codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``targets`` of documents with so many words each, whose codes follow each other."""
    # three zeros before each document and after the last: no history crosses
    codes = np.zeros(int(lengths.sum()) + 3 * (len(lengths) + 1), np.int64)
    codes[np.arange(len(own_codes)) + 3 * np.repeat(np.arange(1, len(lengths) + 1), lengths)] = own_codes
    # the words, and the zero after a document's last one, which is its end
    ends = np.cumsum(lengths + 3)
    own = codes != 0
    own[ends] = True
    place = np.flatnonzero(own)
    hashes = (codes & 0xFFFFFFFF).view(np.uint64)
    one, two, three = (hashes[3 - i : -i] for i in (1, 2, 3))
    a, b, c, d, e = MULTIPLIERS
    top = np.uint64(64 - BUCKETS.bit_length() + 1)
    mixed = ((one + np.uint64(1)) * a, ((one * b) ^ (two + np.uint64(3))) * c, (two + np.uint64(5)) * d, (three + np.uint64(7)) * e)
    features = np.stack([(m >> top).view(np.int64)[place - 3] for m in mixed])
    classes = np.where(codes[place] == 0, END, codes[place] >> 32)
    return features, classes, np.cumsum(lengths + 1) - (lengths + 1)


def _logits(weights: np.ndarray, features: np.ndarray, out: np.ndarray | None = None, spare: np.ndarray | None = None) -> np.ndarray:
    """The classes' weights, a row a token, less the row's largest where one would leave exp's range."""
    logits = weights.take(features[0], 0, out, "clip")
    for f in features[1:]:
        logits += weights.take(f, 0, spare, "clip")
    logits += weights[BUCKETS]
    if max(logits.max(initial=0), -logits.min(initial=0)) > 80:
        far = np.abs(logits).max(1) > 80  # by row, so equal rows stay equal
        logits[far] -= logits[far].max(1, keepdims=True)
    return logits


def class_scores(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Logarithms of the classes' probabilities, a row a token."""
    logits = _logits(weights, features)
    logits -= np.log(np.exp(logits).sum(1, keepdims=True))
    return logits


def target_scores(weights: np.ndarray, features: np.ndarray, classes: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Logarithms of the probabilities of the tokens' own classes."""
    out = np.empty(len(classes))
    buffers = np.empty((2, min(span, len(classes)), CLASSES), np.float32)
    for at in range(0, len(classes), span):
        own = classes[at : at + span]
        logits = _logits(weights, features[:, at : at + span], *buffers[:, : len(own)])
        picked = logits[np.arange(len(own)), own]
        out[at : at + span] = picked - np.log(np.exp(logits, out=logits).sum(1))
    return out


def _grouped(features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, how often each occurs, frequent ones first; where its tokens begin; all buckets' tokens)."""
    bits = features.size.bit_length()
    keys = (features.ravel() << bits) + np.arange(features.size)
    keys.sort()
    buckets, of = keys >> bits, (keys & ((1 << bits) - 1)) % features.shape[1]
    first = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    counts = np.diff(first, append=len(buckets))
    order = np.argsort(-counts, kind="stable")
    return buckets[first[order]], counts[order], first[order], of


def _summed(miss: np.ndarray, counts: np.ndarray, first: np.ndarray, of: np.ndarray, out: np.ndarray, spare: np.ndarray, most: int = 16) -> None:
    """The tokens' ``miss`` summed for each of some buckets of ``_grouped``, into ``out``."""
    miss.take(of[first], 0, out, "clip")
    # all buckets' second tokens, third tokens, and so on; then the rest of each frequent bucket
    for at in range(1, min(most, int(counts[0]))):
        n = int(np.searchsorted(-counts, -at))
        out[:n] += miss.take(of[first[:n] + at], 0, spare[:n], "clip")
    for i in range(int(np.searchsorted(-counts, -most))):
        out[i] += miss.take(of[first[i] + most : first[i] + counts[i]], 0).sum(0)


class Trainer:
    """AdaGrad on the classes' cross-entropy."""

    def __init__(self, weights: np.ndarray, rate: float, batch: int = 2048, most: int = 8192):
        self.weights, self.rate, self.batch, self.most = weights.copy(), rate, batch, most
        self.squares = np.full(weights.shape, 1e-6, np.float32)
        self.updates = np.zeros(len(weights))
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0
        self.miss = np.empty((most, CLASSES), np.float32)
        self.buffers = np.empty((2, SPAN, CLASSES), np.float32)

    def add(self, features: np.ndarray, classes: np.ndarray) -> None:
        """Take tokens; a step is made from ``batch`` to ``most`` of them."""
        for at in range(0, len(classes), self.most):
            if self.size + len(classes[at : at + self.most]) > self.most:
                self.step()
            self.held.append((features[:, at : at + self.most], classes[at : at + self.most]))
            self.size += len(self.held[-1][1])
            if self.size >= self.batch:
                self.step()

    def step(self) -> None:
        if not self.size:
            return
        features = np.concatenate([f for f, _ in self.held], 1)
        classes = np.concatenate([c for _, c in self.held])
        self.held, self.size = [], 0
        miss, (grad, spare) = self.miss[: len(classes)], self.buffers
        for at in range(0, len(classes), SPAN):  # what is worked on at a time stays in the CPU's cache
            part = miss[at : at + SPAN]
            np.exp(_logits(self.weights, features[:, at : at + SPAN], part, spare[: len(part)]), out=part)
            part *= (-1 / (part @ np.ones(CLASSES, np.float32)))[:, None]
        miss[np.arange(len(classes)), classes] += 1
        buckets, counts, first, of = _grouped(features)
        # only the rows of this batch's features move
        for at in range(0, len(buckets), SPAN):
            rows, some = buckets[at : at + SPAN], counts[at : at + SPAN]
            _summed(miss, some, first[at : at + SPAN], of, grad[: len(rows)], spare)
            self.move(rows, some, grad[: len(rows)], spare[: len(rows)], len(classes))
        self.move(np.array([BUCKETS]), len(classes), miss.sum(0)[None], spare[:1], len(classes))

    def move(self, rows: np.ndarray, counts: np.ndarray | int, grad: np.ndarray, spare: np.ndarray, size: int) -> None:
        grad /= np.float32(size)
        squares = self.squares.take(rows, 0)
        squares += np.multiply(grad, grad, out=spare)
        self.squares[rows] = squares
        grad *= np.float32(self.rate)
        grad /= np.sqrt(squares, out=squares)
        grad += self.weights.take(rows, 0, spare, "clip")
        self.weights[rows] = grad
        self.updates[rows] += counts


LEARNED = "word string, class int, n_train long, n_other long, bucket int, updates double, row array<float>"


def _learned(words: tuple | None = None, rows: tuple | None = None) -> pa.RecordBatch:
    n = len(words[0]) if words else len(rows[0])
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.float32())]
    values = [*(words or [[None] * n] * 4), *(rows or [[None] * n] * 3)]
    return pa.RecordBatch.from_arrays([v.cast(t) if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, types, strict=True)], [c.split()[0] for c in LEARNED.split(", ")])


def learn(docs: DataFrame, weights: np.ndarray, rate: float, stride: int) -> DataFrame:
    """Word counts and moved weight rows of each task over ``docs`` (text, held_out, phase)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # BUCKETS rows, at any input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(shared.value, rate)
        words, counts = Numbered(), np.zeros((2, 0), np.int64)

        def counted() -> pa.RecordBatch:
            return _learned((pa.array(words.since(0), pa.binary()), (words.codes() >> 32).astype(np.int32), *counts))

        for batch in batches:
            for part in parts_of(batch, 0):
                own_words, lengths = split_words(part.column(0))
                held, phases = (np.array(c.to_pylist()) for c in part.columns[1:])
                numbers = words.of_words(own_words)
                other = np.repeat(held, lengths)
                counts = np.pad(counts, ((0, 0), (0, len(words) - counts.shape[1])))
                counts[0] += np.bincount(numbers[~other], minlength=len(words))
                counts[1] += np.bincount(numbers[other], minlength=len(words))
                codes, upto = words.codes()[numbers], np.concatenate([[0], np.cumsum(lengths)])
                for d in range(0, part.num_rows, FEW):
                    here, train = slice(upto[d], upto[min(d + FEW, part.num_rows)]), ~held[d : d + FEW]
                    if not train.any():
                        continue
                    own = lengths[d : d + FEW][train]
                    features, classes, starts = targets_of(codes[here][~other[here]], own)
                    if stride > 1:
                        place = np.arange(len(classes)) - np.repeat(starts, own + 1)
                        taken = place % stride == np.repeat(phases[d : d + FEW][train] % stride, own + 1)
                        features, classes = features[:, taken], classes[taken]
                    trainer.add(features, classes)
                if len(words) > 300_000:
                    yield counted()
                    words.clear()
                    counts = np.zeros((2, 0), np.int64)
        trainer.step()
        if len(words):
            yield counted()
        moved = np.flatnonzero(trainer.updates)
        for at in range(0, len(moved), 4096):
            some = moved[at : at + 4096]
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * CLASSES), pa.array(trainer.weights[some].ravel()))
            yield _learned(rows=(some, trainer.updates[some], rows))

    return map_batches(docs, run, LEARNED)


def averaged(learned: DataFrame, weights: np.ndarray) -> np.ndarray:
    """``weights`` with the rows that tasks moved, averaged by their updates."""
    moved = learned.where("bucket IS NOT NULL").groupBy("bucket")
    total = F.sum("updates")
    rows = moved.agg(F.array(*[(F.sum(F.col("row")[i] * F.col("updates")) / total).cast("float") for i in range(CLASSES)]).alias("row")).toArrow()
    out = weights.copy()
    if rows.num_rows:
        out[rows.column("bucket").to_numpy()] = np.array(rows.column("row").to_pylist(), np.float32)
    return out


def _crc(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def frequent_words(counts: DataFrame, frequent: int) -> DataFrame:
    """The words above a count that at most ``frequent`` words reach."""
    level = F.floor(F.log2("n_all") * 8)
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(level.alias("level")).agg(F.count("*")).collect()), reverse=True)
    total, least = 0, None
    for at, n in sizes:  # a few hundred levels at any input
        total += n
        if total > frequent:
            break
        least = at
    return counts.where(level >= F.lit(least)) if least is not None else counts.where("false")


def score(
    docs: DataFrame,
    rounds: int = 2,
    rate: float = 0.4,
    stride: int = 1,
    frequent: int = 150_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Rows whose id's crc32 leaves 2 modulo 7 are held out: they are scored, but
    neither counted nor trained on.  A null text is empty (its end is its only
    token); a null id counts as an empty one and stays null.  Repeated rows are
    scored alike, each as a row.  Without any training row both scores are
    those of the smoothing alone.  Texts of any length are scored whole.  Other
    columns, whatever their names, are not read.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    held = _crc(id_col) % 7 == 2
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held.alias("held_out"))
    phase = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)).cast("int")
    weights = np.zeros((BUCKETS + 1, CLASSES), np.float32)
    counted = []
    for r in range(rounds):
        part = rows.where(F.pmod(F.xxhash64(F.lit("round"), "doc_id"), F.lit(rounds)) == r)
        learned = staged(learn(part.select("text", "held_out", phase.alias("phase")), weights, rate, stride), "lm-learned")
        weights = averaged(learned, weights)
        counted.append(learned.where("word IS NOT NULL").select("word", "class", "n_train", "n_other"))
    counts = counted[0]
    for more in counted[1:]:
        counts = counts.unionByName(more)
    counts = counts.groupBy("word", "class").agg(F.sum("n_train").alias("n_train"), F.sum(F.col("n_train") + F.col("n_other")).alias("n_all"))
    counts = staged(counts, "lm-counts")

    ends = rows.where(~F.col("held_out")).count()
    shares = np.ones(CLASSES)
    shares[END] = ends + 1
    tokens, kinds = ends, int(ends > 0)
    known = counts.where("n_train > 0").groupBy("class")
    for which, n, k in known.agg(F.sum("n_train"), F.count("*")).collect():  # a row a class
        shares[which] += n + k
        tokens, kinds = tokens + n, kinds + k
    often = frequent_words(counts, frequent).select("word", "n_train").toArrow()
    logs = {w.encode(): math.log10(n + 1) for w, n in zip(often.column(0).to_pylist(), often.column(1).to_pylist(), strict=True)}
    shared = spark.sparkContext.broadcast((weights, np.log10(shares), logs))  # at most ``frequent`` words
    end_log, end_known = math.log10(ends + 1), int(ends > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, share_logs, logs = shared.value
        words, values = Numbered(), np.zeros(0)
        for batch in batches:
            for part in parts_of(batch, 1):
                if len(words) > 300_000:
                    words.clear()
                    values = np.zeros(0)
                own_words, lengths = split_words(part.column(1))
                numbers = words.of_words(own_words)
                values = np.append(values, [logs.get(w, np.nan) for w in words.since(len(values))])
                codes, upto, sums = words.codes()[numbers], np.concatenate([[0], np.cumsum(lengths)]), np.empty(part.num_rows)
                for d in range(0, part.num_rows, FEW):
                    features, classes, starts = targets_of(codes[upto[d] : upto[min(d + FEW, part.num_rows)]], lengths[d : d + FEW])
                    scores = target_scores(weights, features, classes)
                    sums[d : d + FEW] = np.add.reduceat(scores / math.log(10) - share_logs[classes], starts)
                own, doc = values[numbers], np.repeat(np.arange(part.num_rows), lengths)
                missing = np.isnan(own)
                total = lambda x: np.bincount(doc, weights=x, minlength=part.num_rows)
                other = own_words.filter(pa.array(missing)).cast(pa.string())
                ends = np.concatenate([[0], np.cumsum(total(missing))]).astype(np.int32)
                found = [
                    part.column(0),
                    part.column(2),
                    pa.array(lengths + 1, pa.int64()),
                    pa.array(sums),
                    pa.array(total(np.where(missing, 0.0, own)) + end_log),
                    pa.array((total(own > 0) + end_known).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), other),
                ]
                yield pa.RecordBatch.from_arrays(found, names)

    names = ["doc_id", "held_out", "n_tokens", "model_part", "count_part", "known_part", "other"]
    schema = "doc_id long, held_out boolean, n_tokens long, model_part double, count_part double, known_part long, other array<string>"
    scored = map_batches(rows.select("doc_id", "text", "held_out"), run, schema)
    scored = staged(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    # a word that training didn't have adds nothing to either sum
    rare = scored.select("row", F.explode("other").alias("word")).join(counts.where("n_train > 0").select("word", "n_train").hint("merge"), "word")
    rare = rare.groupBy("row").agg(F.sum(F.log10(F.col("n_train") + 1)).alias("logs"), F.count("*").alias("known"))
    whole = scored.drop("other").join(rare, "row", "left")
    logs_sum = F.col("count_part") + F.coalesce("logs", F.lit(0.0))
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("known_part") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (logs_sum - F.col("n_tokens") * math.log10(tokens + kinds + 1)).alias("base_score"), (logs_sum + F.col("model_part")).alias("score"),
    )


def op2_hashed_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
