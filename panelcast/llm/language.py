"""Language identification by a byte convolutional network.

Filters of several widths slide over the UTF-8 bytes of a fixed-length window, each filter keeps
its largest response, and a softmax layer names the language. The network is trained in NumPy, on a
bounded sample of labelled texts or in Spark tasks on all of them, and applied to every window of every
text in Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from panelcast.llm.common import released, slices
from panelcast.session import checked_broadcast, written

UNKNOWN = "und"
#: A language's sample is sought among this many (two to the power) slices of the order of its hashes.
SLICE_BITS = 12
WIDTHS = (2, 3, 4)
WINDOW = 256
STEP = WINDOW - max(WIDTHS) + 1  # windows overlap so that every byte sequence lies whole in one


@dataclass(frozen=True)
class Model:
    """Languages, one table per filter width (width x byte x filter), and the softmax layer."""

    langs: tuple[str, ...]
    filters: tuple[np.ndarray, ...]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def held_out(doc_id="doc_id"):
    """Rows that are never learned from; a null doc_id is among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample_windows(docs: DataFrame, per_lang: int = 400, per_doc: int = 6) -> DataFrame:
    """``(lang, windows)`` of at most ``per_lang`` labelled documents a language.

    Rows are chosen by a hash of ``doc_id`` among those not held out, and ``per_doc`` windows are
    cut from all over each text, so what is collected is bounded by both parameters. Of rows that
    share a ``doc_id`` one is used.
    """
    train = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()
    )
    # slices of the order of hashes, counted: the last one a language needs is put in exact order
    ids = train.select("doc_id", "lang", F.xxhash64("doc_id").alias("hash")).withColumn("slice", F.shiftright("hash", 64 - SLICE_BITS))
    counts = ids.groupBy("lang", "slice").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("lang").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).filter(F.col("before") < per_lang)
    last = needed.groupBy("lang").agg(F.max("slice").alias("last"))
    rank = Window.partitionBy("lang").orderBy("hash", "doc_id")
    chosen = written(
        ids.join(F.broadcast(last), "lang").filter("slice <= last")  # one row a language
        .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= per_lang).select("doc_id").distinct(), "sample"
    )

    @released
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows = []
            for text in batch.column("text").to_pylist():
                data = text.encode()
                room = max(0, len(data) - WINDOW)
                windows.append([data[s : s + WINDOW] for s in sorted({room * i // max(1, per_doc - 1) for i in range(per_doc)})])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(windows, pa.list_(pa.binary()))],
                names=["doc_id", "lang", "windows"],
            )

    kept = train.join(checked_broadcast(chosen), "doc_id").select("doc_id", "lang", "text")
    cut_out = kept.mapInArrow(cut, f"doc_id {dict(docs.dtypes)['doc_id']}, lang string, windows array<binary>")
    return cut_out.groupBy("doc_id").agg(F.min(F.struct("lang", "windows")).alias("_one")).select("doc_id", "_one.*")


def sampled(docs: DataFrame, per_lang: int = 400) -> list[tuple]:
    """``(lang, doc_id, windows)`` of :func:`sample_windows`, in order."""
    return sorted((r.lang, r.doc_id, r.windows) for r in sample_windows(docs, per_lang).collect())


def train(docs: DataFrame, per_lang: int = 400, filters: int = 16, epochs: int = 6, seed: int = 7) -> Model | None:
    """Fit the network on the sampled windows; None if no row is labelled."""
    return train_on(sampled(docs, per_lang), filters, epochs, seed)


def train_on(rows: list[tuple], filters: int = 16, epochs: int = 6, seed: int = 7) -> Model | None:
    langs = tuple(sorted({r[0] for r in rows}))
    if not langs:
        return None
    data = [(bytes(w), langs.index(lang)) for lang, _, windows in rows for w in windows]
    return fit(data, langs, filters, epochs, seed)


def fit(data: list[tuple[bytes, int]], langs: tuple[str, ...], filters: int, epochs: int, seed: int) -> Model:
    """Adam on the cross entropy. Some windows are cut short, so that short texts are learned too."""
    random = np.random.default_rng(seed)
    x = np.zeros((len(data), WINDOW), np.uint8)
    for i, (window, _) in enumerate(data):
        keep = window if random.random() < 0.6 else window[: int(random.integers(6, 100))]
        x[i, : len(keep)] = np.frombuffer(keep, np.uint8)
    y = np.array([label for _, label in data])
    weight = len(y) / (len(langs) * np.bincount(y, minlength=len(langs)).clip(1))  # every language counts alike
    learner = Learner(initial(random, len(langs), filters))
    size = 64
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        order = random.permutation(len(y))
        for start in range(0, len(order), size):
            at = order[start : start + size]
            learner.step(x[at], y[at], weight[y[at]], rate)
    return as_model(langs, learner.params)


def initial(random: np.random.Generator, langs: int, filters: int) -> list[np.ndarray]:
    params = [random.normal(0, 0.1, (w, 256, filters)).astype(np.float32) for w in WIDTHS]
    return params + [np.zeros(len(WIDTHS) * filters, np.float32),
                     random.normal(0, 0.1, (len(WIDTHS) * filters, langs)).astype(np.float32),
                     np.zeros(langs, np.float32)]


def as_model(langs: tuple[str, ...], params: list[np.ndarray]) -> Model:
    n = len(WIDTHS)
    return Model(langs, tuple(params[:n]), params[n], params[n + 1], params[n + 2])


class Learner:
    """Parameters and the moments of Adam, one batch of windows at a time."""

    def __init__(self, params: list[np.ndarray]):
        self.params = params
        self.first = [np.zeros_like(p) for p in params]
        self.second = [np.zeros_like(p) for p in params]
        self.steps = 0

    def step(self, batch: np.ndarray, target: np.ndarray, weight: np.ndarray, rate: float) -> None:
        params, n, filters = self.params, len(WIDTHS), self.params[0].shape[2]
        tops, where = [], []
        for table in params[:n]:
            reach = WINDOW - len(table) + 1
            response = sum(table[j][batch[:, j : j + reach]] for j in range(len(table)))
            place = response.argmax(axis=1)
            where.append(place)
            tops.append(np.take_along_axis(response, place[:, None], 1)[:, 0])
        hidden = np.concatenate(tops, 1) + params[n]
        active = np.maximum(hidden, 0)
        scores = active @ params[n + 1] + params[n + 2]
        probability = np.exp(scores - scores.max(1, keepdims=True))
        probability /= probability.sum(1, keepdims=True)
        slope = probability.copy()
        slope[np.arange(len(batch)), target] -= 1
        slope *= (weight / len(batch))[:, None]
        back = (slope @ params[n + 1].T) * (hidden > 0)
        grads = []
        for k, table in enumerate(params[:n]):
            grad = np.zeros_like(table)
            part = back[:, k * filters : (k + 1) * filters]
            for j in range(len(table)):
                seen = np.take_along_axis(batch, where[k] + j, 1)
                np.add.at(grad[j], (seen, np.arange(filters)), part)
            grads.append(grad)
        grads += [back.sum(0), active.T @ slope, slope.sum(0)]
        self.steps += 1
        for p, g, m, v in zip(params, grads, self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (rate / (1 - 0.9**self.steps)) * m / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)


#: Of this many windows a pass over all rows is cut into rounds, each of which learns from other rows.
MANY_WINDOWS = 60_000
#: How many numbers of the parameters are averaged in one group.
CHUNK = 2048


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Hand whole texts to the workers in shorter batches: both sides hold a few of them at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def labelled(docs: DataFrame) -> DataFrame:
    """All rows that may be learned from."""
    return docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())


def all_windows(data: bytes) -> np.ndarray:
    """windows x ``WINDOW`` bytes, the last one filled up with zeros; every byte is in one at least."""
    count = max(1, -(-(len(data) - WINDOW) // STEP) + 1)
    padded = np.frombuffer(data.ljust(STEP * (count - 1) + WINDOW, b"\0"), np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STEP]


def train_on_all(docs: DataFrame, filters: int = 16, seed: int = 7) -> Model | None:
    """Fit the network on every window of every labelled text that is not held out; None without any.

    Tasks learn from their rows side by side, starting from the same parameters, and the mean of what
    they reach, by windows, starts the next round. A pass over many windows takes three rounds of other
    rows; few windows are learned several times.
    """
    rows = labelled(docs)
    count = F.greatest(F.lit(1), F.ceil((F.octet_length("text") - WINDOW) / STEP) + 1)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(count).alias("n")).collect()}
    langs, total = tuple(sorted(sizes)), sum(sizes.values())
    if not langs:
        return None
    weights = np.array([total / (len(langs) * sizes[name]) for name in langs])  # every language counts alike
    params = initial(np.random.default_rng(seed), len(langs), filters)
    many = total >= MANY_WINDOWS
    rounds = 3 if many else min(6, max(2, -(-12_000 // total)))
    for turn in range(rounds):
        part = rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == turn) if many else rows
        params = learned_side_by_side(part, params, langs, weights, 0.01 * (1 - turn / rounds), (seed, turn))
    return as_model(langs, params)


def learned_side_by_side(rows: DataFrame, params: list[np.ndarray], langs: tuple[str, ...], weights: np.ndarray, rate: float, seed: tuple) -> list[np.ndarray]:
    """The parameters after a round: the mean over tasks, weighted by their windows."""

    @released
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        random, learner, n = np.random.default_rng([*seed, task]), Learner([p.copy() for p in params]), 0
        for whole in batches:
            for batch in slices(whole, 1 << 20):
                cut = [all_windows(t.encode()) for t in batch.column("text").to_pylist()]
                x = np.concatenate(cut)
                y = np.repeat([langs.index(name) for name in batch.column("lang").to_pylist()], [len(c) for c in cut])
                keep = np.where(random.random(len(x)) < 0.6, WINDOW, random.integers(6, 100, len(x)))  # short texts are learned too
                x[np.arange(WINDOW) >= keep[:, None]] = 0
                order = random.permutation(len(y))
                for at in (order[k : k + 64] for k in range(0, len(order), 64)):
                    learner.step(x[at], y[at], weights[y[at]], rate)
                n += len(y)
        if n:
            flat = np.concatenate([p.ravel() for p in learner.params])
            chunks = [flat[k : k + CHUNK].tobytes() for k in range(0, len(flat), CHUNK)]
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array(range(len(chunks)), pa.int32()), "task": pa.array([task] * len(chunks), pa.int32()),
                "n": pa.array([n] * len(chunks), pa.int64()), "numbers": pa.array(chunks, pa.binary())})

    def mean(group: pa.Table) -> pa.Table:
        found = sorted(group.to_pylist(), key=lambda r: r["task"])
        weight = np.array([r["n"] for r in found], np.float64)
        numbers = weight @ np.stack([np.frombuffer(r["numbers"], np.float32) for r in found]) / weight.sum()
        return pa.table({"chunk": group["chunk"][:1], "numbers": pa.array([numbers.astype(np.float32).tobytes()], pa.binary())})

    chunks = rows.select("text", "lang").mapInArrow(learn, "chunk int, task int, n long, numbers binary")
    with short_batches(rows.sparkSession):
        found = chunks.groupBy("chunk").applyInArrow(mean, "chunk int, numbers binary").collect()
    if not found:
        return params
    flat = np.concatenate([np.frombuffer(r["numbers"], np.float32) for r in sorted(found, key=lambda r: r["chunk"])])
    edges = np.cumsum([p.size for p in params])[:-1]
    return [piece.reshape(p.shape).copy() for piece, p in zip(np.split(flat, edges), params, strict=True)]


class Predictor:
    """The network with byte-pair tables, so that a filter of any width needs two look-ups at most."""

    def __init__(self, model: Model):
        self.model = model
        self.tables = []
        for table in model.filters:
            pairs = [(table[j][:, None] + table[j + 1][None]).reshape(65536, -1) for j in range(0, len(table) - 1, 2)]
            if len(table) % 2:
                pairs.append(table[-1])
            self.tables.append([np.ascontiguousarray(p) for p in pairs])

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of each window."""
        wide = x.astype(np.int32)
        pair = wide[:, :-1] * 256 + wide[:, 1:]
        tops = []
        for width, tables in zip(WIDTHS, self.tables, strict=True):
            reach, total = WINDOW - width + 1, None
            for j, table in enumerate(tables):
                source = pair if len(table) == 65536 else wide
                found = table.take(source[:, 2 * j : 2 * j + reach], axis=0, mode="clip")
                total = found if total is None else np.add(total, found, out=total)
            tops.append(total.max(axis=1))
        hidden = np.maximum(np.concatenate(tops, 1) + self.model.bias, 0)
        scores = hidden @ self.model.dense + self.model.dense_bias
        scores = np.exp(scores - scores.max(1, keepdims=True))
        return scores / scores.sum(1, keepdims=True)

    def texts(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text: the mean probability over all its windows."""
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        ready, buffers, starts, filled = [], [], [], 0
        for i, text in enumerate(texts):
            if has_letter(text):
                data = text.encode()
                count = max(1, -(-(len(data) - WINDOW) // STEP) + 1)
                ready.append((i, count))
                starts.append(filled + STEP * np.arange(count))
                room = STEP * (count - 1) + WINDOW
                buffers.append(data + bytes(room - len(data)))
                filled += room
        if not ready:
            return langs, scores
        view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(b"".join(buffers), np.uint8), WINDOW)
        at = np.concatenate(starts)
        found = np.concatenate([self.windows(view[at[k : k + 48]]) for k in range(0, len(at), 48)])
        edges = np.cumsum([0, *(count for _, count in ready)])
        means = np.add.reduceat(found.astype(np.float64), edges[:-1]) / np.diff(edges)[:, None]
        for (i, _), mean in zip(ready, means, strict=True):
            best = int(mean.argmax())
            langs[i], scores[i] = self.model.langs[best], float(min(1.0, mean[best]))
        return langs, scores


def trigrams(text: str) -> np.ndarray:
    """Byte trigrams around each letter of the lower-cased text; other ASCII counts as a space."""
    data = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)
    data = LETTERS[data].astype(np.int32)
    return (data[:-2] << 16 | data[1:-1] << 8 | data[2:])[data[1:-1] != 32]


LETTERS = np.array([b if chr(b).isalpha() or b > 127 else 32 for b in range(256)], np.uint8)


@dataclass(frozen=True)
class Gate:
    """What a text must reach to count as one of the learned languages.

    A softmax over languages can be sure of texts in none of them and torn on texts in several, so
    the share of known trigrams decides: ``sure`` is asked of texts with at least ``score``, and
    ``torn`` of the others.
    """

    known: np.ndarray
    sure: float
    torn: float
    score: float


def calibrated(rows: list[tuple], model: Model) -> Gate:
    """Known trigrams and limits from the sampled windows, none of them held out.

    Shares are those in the windows of all other documents. Of what all but the worst in 200
    documents reach, 0.6 and 0.9 are asked for; half way from their score down to the
    ``1 / languages`` of a blind guess the network counts as torn.
    """
    texts = [" ".join(bytes(w).decode(errors="ignore") for w in windows) for _, _, windows in rows]
    found = [trigrams(t) for t in texts]
    known, documents = np.unique(np.concatenate([np.unique(f) for f in found]), return_counts=True)
    shared = known[documents > 1]
    shares = [np.isin(f, shared).mean() for f in found if len(f)]
    share = float(np.quantile(shares, 0.005)) if shares else 0.0
    floor, score = 1 / len(model.langs), float(np.quantile(Predictor(model).texts(texts)[1], 0.005))
    return Gate(known, 0.6 * share, 0.9 * share, floor + (score - floor) / 2)


#: Shares and scores of documents are counted in steps of one in this many.
GRID = 10_000
#: Trigrams are handed over as bits, this many to a piece.
PIECE = 1 << 12


def known_trigrams(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For every trigram whether one, and whether more than one, of the texts of all rows hold it."""

    @released
    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = np.zeros(1 << 24, np.uint8)  # 0, 1, or 2 for more than one
        for whole in batches:
            for batch in slices(whole, 1 << 20):
                for text in batch.column("text").to_pylist():
                    found = np.unique(trigrams(text))
                    texts[found] = np.minimum(texts[found] + 1, 2)
        texts = texts.reshape(-1, PIECE)
        pieces = np.flatnonzero([t.any() for t in texts])
        bits = [np.packbits(texts[pieces] >= least, axis=1) for least in (1, 2)]
        yield pa.RecordBatch.from_pydict({
            "piece": pa.array(pieces, pa.int32()), "once": pa.array([b.tobytes() for b in bits[0]], pa.binary()),
            "again": pa.array([b.tobytes() for b in bits[1]], pa.binary())})

    def together(group: pa.Table) -> pa.Table:
        once, again = np.zeros(PIECE // 8, np.uint8), np.zeros(PIECE // 8, np.uint8)
        for r in group.to_pylist():
            other = np.frombuffer(r["once"], np.uint8)
            again |= np.frombuffer(r["again"], np.uint8) | (once & other)
            once |= other
        return pa.table({"piece": group["piece"][:1], "once": pa.array([once.tobytes()], pa.binary()), "again": pa.array([again.tobytes()], pa.binary())})

    schema = "piece int, once binary, again binary"
    with short_batches(rows.sparkSession):
        found = rows.select("text").mapInArrow(seen, schema).groupBy("piece").applyInArrow(together, schema).collect()
    tables = np.zeros((2, (1 << 24) // PIECE, PIECE // 8), np.uint8)
    for r in found:
        tables[:, r["piece"]] = np.frombuffer(r["once"], np.uint8), np.frombuffer(r["again"], np.uint8)
    return tables[0].ravel(), tables[1].ravel()


def reached(counts: dict[int, int], missing: float = 0.005) -> float:
    """What all but a share of the counted documents reach."""
    total, below = sum(counts.values()), 0
    for step in sorted(counts):
        below += counts[step]
        if below > missing * total:
            return step / GRID
    return 0.0


def keep_learned(docs: DataFrame, model: Model | None) -> DataFrame:
    """:func:`keep_known` with a gate that all rows the model learned from have set.

    The trigrams of all their texts are known. Every row gets its score and the shares of its trigrams
    that are known and that at least two texts hold, once; limits as in :func:`calibrated`, on whole texts.
    """
    if model is None:
        return keep_known(docs, None, None)
    known, shared = known_trigrams(labelled(docs))
    names = ["_score", "_known", "_shared"]
    while set(names) & set(docs.columns):
        names = ["_" + n for n in names]

    @released
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, scores in predicted_batches(batches, model):
            found = [trigrams(t) if has_letter(t) else None for t in batch.column("text").to_pylist()]
            shares = [[None if f is None else float((t[f >> 3] >> (7 - (f & 7)) & 1).mean()) for f in found] for t in (known, shared)]
            scores = [None if f is None else s for f, s in zip(found, scores, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v, pa.float64()) for v in (scores, *shares))], names=[*batch.schema.names, *names])

    schema = StructType([*docs.schema.fields, *(StructField(n, DoubleType()) for n in names)])
    with short_batches(docs.sparkSession):
        rows = written(docs.mapInArrow(judge, schema), "judged")
    score, known_share, shared_share = map(F.col, names)
    learned = F.col("lang").isNotNull() & ~held_out() & score.isNotNull()
    counts = [
        {r["step"]: r["count"] for r in rows.filter(learned).groupBy(F.floor(c * GRID).alias("step")).count().collect()}
        for c in (score, shared_share)
    ]
    sure, share = map(reached, counts)
    floor = 1 / len(model.langs)
    limit = F.when(score >= floor + (sure - floor) / 2, 0.6 * share).otherwise(0.9 * share)
    return rows.filter(score.isNotNull() & (known_share >= limit)).select(*(F.col(f"`{c}`") for c in docs.columns))


def keep_known(docs: DataFrame, model: Model | None, gate: Gate | None) -> DataFrame:
    """The rows, with all their columns, that have a letter and as many known trigrams as ``gate`` asks for.

    Without a model nothing can be told of texts but that they have a letter.
    """

    @released
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << 24, bool)
        if gate:
            table[gate.known] = True

        def fits(text: str, score: float) -> bool:
            return bool(table[trigrams(text)].mean() >= (gate.sure if score >= gate.score else gate.torn))

        for batch, _, scores in predicted_batches(batches, model):
            texts = batch.column("text").to_pylist()
            mask = [has_letter(t) and (not gate or fits(t, s)) for t, s in zip(texts, scores, strict=True)]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def predicted_batches(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[tuple[pa.RecordBatch, list[str], list[float]]]:
    """Each batch with the language and score of its texts, a bounded number of bytes at a time."""
    predictor = Predictor(model) if model else None
    for whole in batches:
        for batch in slices(whole, 1 << 20):
            texts = batch.column("text").to_pylist()
            if predictor:
                yield batch, *predictor.texts(texts)
            else:
                yield batch, [UNKNOWN] * len(texts), [0.0] * len(texts)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text when
    nothing was labelled. Rows are judged one by one: repeated rows get the same answer, other
    columns are never read.
    """

    @released
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, langs, scores in predicted_batches(batches, model):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )

