"""Toxicity by a convolutional text classifier, trained in numpy.

A word is the mean of hashed embeddings of itself and of its first three,
four and five letters.  Filters over one, two and three neighbouring words,
rectified and max-pooled over the whole text, feed a logistic output.  Max
pooling passes a gradient to one place a filter only, so training touches a
few rows of the embeddings a document.

The model is fitted on all labelled rows outside the held-out fold.  They
are dealt into shards by a hash of their id; in each of some rounds every
shard goes on from the same model (some MB) for some epochs, and what it
changed is averaged: a row of the embeddings over the shards that touched
it, by how often, all else by the shards' rows.  Inputs of a score are the
text's words and nothing else.  Decision thresholds are calibrated by
language on a fifth of the rows, by hash, which isn't trained on: a
language's best threshold is shrunk towards that of all languages by its
number of toxic rows, so a rare language borrows and no number switches.

On executors the filters' products with a word are looked up: they are
computed once for a word (in training: once for a step's word) and kept in a
bounded table, so a document costs some sums of looked-up rows, whatever its
length.

Defined results: null and empty texts are scored like a text of one unknown
word; without labels of both kinds every score is the share of toxic labels
(0 without any) and thresholds are 0.5; a null id is not held out; a
language without labels has the threshold of all; repeated rows are scored
alike; an empty table gives an empty result.  Only the named columns are
read.
"""

from __future__ import annotations

import copy
import re
import zlib
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions import stats
from sievework.llm.labelled import WORD, in_fold, labelled
from sievework.llm.workers import map_batches, map_rows, release, slices
from sievework.plans.shared import materialize

#: Labelled documents of a shard and their characters, on average; rounds after which shards are averaged; rows of the embeddings that are averaged together.
SHARD, SHARD_CHARS, TURNS, PIECE = 4000, 16_000_000, 2, 1024
ROWS, DIM, FILTERS, WIDTHS = 1 << 16, 16, 16, (1, 2, 3)
EPOCHS, BATCH = 6, 32
#: Steps of the filters and the output (Adam) and of the embeddings (Adagrad by row).
RATE, ROW_RATE = 0.01, 0.15
#: Share of the rows that thresholds are calibrated on, and toxic rows that the threshold of all counts for when a language's is shrunk towards it.
CALIBRATION, WEIGHT = 5, 20
#: Words whose products a worker keeps; places of a text that are pooled at once.
REMEMBERED, SPAN = 100_000, 4096
#: Columns of the filters that are too narrow for a first, second and third word.
SKIP = tuple(FILTERS * sum(w <= i for w in WIDTHS) for i in range(max(WIDTHS)))
#: What is no word, outside ASCII, and bytes with all that is no word within ASCII made blank.
ODD, BLANKS = re.compile(r"[^\w\x00-\x7f]+"), bytes(32 if i < 128 and not WORD.match(chr(i)) else i for i in range(256))


def hashed(words: list[str]) -> np.ndarray:
    """Rows of the embeddings of lower-cased words, (n, 4): of themselves and of their first 3, 4 and 5 letters."""
    rows = np.empty((len(words), 4), np.int64)
    for k, letters in enumerate((None, 3, 4, 5)):
        parts = "\n".join([w[:letters] for w in words]).encode("utf-8", "surrogatepass").split(b"\n")  # no word holds a line's end
        start = zlib.crc32(str(letters).encode()) if letters else 0
        rows[:, k] = np.fromiter(map(zlib.crc32, parts, repeat(start)), np.int64, len(parts))[: len(words)]
    return rows % ROWS


def features(word: str) -> tuple[int, int, int, int]:
    """Rows of the embeddings of one lower-cased word."""
    return tuple(hashed([word])[0].tolist())


def words_of(text: str | None) -> list[str]:
    """The matches of ``WORD`` in the lower-cased text."""
    low = (text or "").lower()
    if not low.isascii():  # what is no word parts words, first outside ASCII, then within
        low = ODD.sub(" ", low).encode("utf-8", "surrogatepass").translate(BLANKS).decode("utf-8", "surrogatepass")
        return low.split()
    return low.encode().translate(BLANKS).decode().split()


class Numbers(dict):
    """Numbers of words from 1 on, given as they are asked for."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self) + 1
        return n

    def of(self, words: list[str]) -> np.ndarray:
        return np.array([*map(self.__getitem__, words)], np.int64)

    def since(self, used: int) -> list[str]:
        """The words whose numbers are above ``used``."""
        return [*islice(reversed(self), len(self) - used)][::-1]


def distinct(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different ones of some numbers below ``size``, and where each number is among them."""
    slot, at = np.empty(size, np.int64), np.arange(len(keys))
    slot[keys] = at
    first = keys[slot[keys] == at]
    slot[first] = np.arange(len(first))
    return first, slot[keys]


def add_up(keys: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Different keys (below ``size``) and the sums of their rows of values."""
    unique, inverse = distinct(keys, size)
    cells = (inverse[:, None] * DIM + np.arange(DIM)).ravel()
    return unique, np.bincount(cells, values.ravel(), len(unique) * DIM).reshape(-1, DIM)


class Model:
    """Embeddings, filters and output."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.3, (ROWS, DIM)).astype(np.float32)
        self.filters = [rng.normal(0, (w * DIM) ** -0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32)
        self.base = 0.0
        self.constant: float | None = None
        self.threshold, self.thresholds = 0.5, {}  # of all languages, and by language

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        """The means of some words' embeddings (feature rows), (n, DIM)."""
        total = self.table.take(rows[:, 0], axis=0)
        for k in range(1, rows.shape[1]):
            total += self.table.take(rows[:, k], axis=0)
        return total / rows.shape[1]

    def products(self, vectors: np.ndarray) -> list[np.ndarray]:
        """What words add to the filters at their first, second and third place: (n, FILTERS * filters that wide) each."""
        return [vectors @ np.concatenate([f[i] for f in self.filters[skip // FILTERS :]], axis=1) for i, skip in enumerate(SKIP)]

    def pool(self, products: list[np.ndarray], texts: list[np.ndarray], places: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Max-pooled activations of texts and the places they come from, if asked for: rows of ``products``, two spare ones at the end."""
        best = np.empty((len(texts), FILTERS * len(WIDTHS)), products[0].dtype)
        where, column = np.zeros(best.shape, np.int64), np.arange(best.shape[1])
        for t, at in enumerate(texts):
            n = len(at) - len(SKIP) + 1
            for lo in range(0, n, SPAN):
                hi = min(lo + SPAN, n)
                total = products[0].take(at[lo:hi], axis=0)
                for i, skip in enumerate(SKIP[1:], 1):
                    total[:, skip:] += products[i].take(at[lo + i : hi + i], axis=0)
                if places:
                    place = total.argmax(axis=0)
                    top = total[place, column]
                    more = top > best[t] if lo else slice(None)
                    where[t, more] = lo + place[more]
                else:
                    top = total.max(axis=0)
                best[t] = np.maximum(best[t], top) if lo else top
        return np.maximum(best + np.concatenate(self.bias), 0), where

    def score(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.base, -30, 30)))


def lay_out(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts' word numbers behind each other, with two spare zeros after each text (three for an empty one); where each begins and ends."""
    room = np.array([max(len(x), 1) + len(SKIP) - 1 for x in ids], np.int64)
    ends = np.cumsum(room)
    starts = ends - room
    at = np.zeros(int(room.sum()), np.int64)
    for s, x in zip(starts.tolist(), ids, strict=True):
        at[s : s + len(x)] = x
    return at, starts, ends


def gradients(model: Model, known: np.ndarray, ids: list[np.ndarray], labels: np.ndarray) -> tuple[list[np.ndarray], float, np.ndarray, np.ndarray]:
    """Gradients of the mean log loss of texts (word numbers; ``known`` has the words' feature rows).

    By the filters, their biases and the output; by the base; and the rows of
    the embeddings touched with theirs.
    """
    at, starts, ends = lay_out(ids)
    here, local = distinct(at, len(known))
    vectors = model.vectors(known[here])
    vectors[here == 0] = 0
    pooled, where = model.pool(model.products(vectors), [local[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], places=True)
    where += starts[:, None]
    miss = (model.score(pooled) - labels) / len(labels)
    weights = [*model.filters, *model.bias, model.out]
    grads = [np.zeros_like(w) for w in weights]
    grads[-1][:] = pooled.T @ miss
    back = ((miss[:, None] * model.out[None, :]) * (pooled > 0)).astype(model.table.dtype)
    touched, values = [], []
    for k, f in enumerate(model.filters):
        mine = slice(k * FILTERS, (k + 1) * FILTERS)
        g = back[:, mine]
        grads[len(WIDTHS) + k][:] = g.sum(0)
        for i in range(len(f)):
            word = local[where[:, mine] + i]  # (texts, filters)
            grads[k][i] = np.einsum("bfd,bf->df", vectors[word], g)
            live = (here[word] > 0) & (g != 0)
            touched.append(word[live])
            values.append(g[live][:, None] * f[i].T[np.nonzero(live)[1]] / 4)
    words, total = add_up(np.concatenate(touched), np.concatenate(values), len(here))
    rows, total = add_up(known[here[words]].ravel(), np.repeat(total, 4, axis=0), ROWS)
    return grads, float(miss.sum()), rows, total.astype(model.table.dtype)


def learn(model: Model, labels: np.ndarray, texts: list[str | None], epochs: range, seed: int = 3) -> np.ndarray:
    """Train the model on texts for some of ``EPOCHS``; tells how many steps touched each row of the embeddings."""
    numbers = Numbers()
    ids = [numbers.of(words_of(t)) for t in texts]
    known = np.concatenate([np.zeros((1, 4), np.int64), hashed([*numbers])])
    rng, order = np.random.default_rng((seed, epochs.start)), np.arange(len(texts))
    seen, touched = np.full(ROWS, 1e-8, np.float32), np.zeros(ROWS)  # Adagrad's sums, a row each
    weights = [*model.filters, *model.bias, model.out]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    bias_moment, step = [0.0, 0.0], 0
    for epoch in epochs:
        rng.shuffle(order)
        for lo in range(0, len(order), BATCH):
            part = order[lo : lo + BATCH]
            grads, to_base, unique, total = gradients(model, known, [ids[i] for i in part], labels[part])
            decay = 1 - epoch / EPOCHS
            seen[unique] += (total * total).mean(1)
            touched[unique] += 1
            model.table[unique] -= (ROW_RATE * decay / np.sqrt(seen[unique]))[:, None] * total
            step += 1
            for w, g, (m, v) in zip(weights, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= RATE * decay * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            bias_moment = [0.9 * bias_moment[0] + 0.1 * to_base, 0.99 * bias_moment[1] + 0.01 * to_base * to_base]
            model.base -= RATE * decay * (bias_moment[0] / (1 - 0.9**step)) / ((bias_moment[1] / (1 - 0.99**step)) ** 0.5 + 1e-8)
    return touched


def fit(rows: list[tuple], seed: int = 3) -> Model:
    """Fit a few rows (label, text, lang) at once."""
    model = Model(seed)
    labels = np.array([r[0] for r in rows], np.float64)
    if not len(rows) or labels.min() == labels.max():
        model.constant = float(labels.mean()) if len(rows) else 0.0
        return model
    order = np.random.default_rng(seed).permutation(len(rows))
    held, train = order[: len(rows) // CALIBRATION], order[len(rows) // CALIBRATION :]
    learn(model, labels[train], [rows[i][1] for i in train], range(EPOCHS), seed)
    scorer = Scorer(model)
    scores = np.concatenate([scorer.score([rows[i][1] for i in held[k : k + 64]]) for k in range(0, len(held), 64)] or [np.zeros(0)])
    toxic = labels[held] == 1
    if toxic.any():
        model.threshold = best_threshold(scores, toxic)
        for lang in {rows[i][2] for i in held}:
            mine = np.array([rows[i][2] == lang for i in held])
            if n := int(toxic[mine].sum()):
                model.thresholds[lang] = (n * best_threshold(scores[mine], toxic[mine]) + WEIGHT * model.threshold) / (n + WEIGHT)
    return model


def best_threshold(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The threshold of the best F1, in the middle of the gap it lies in and never under 0.3 or over 0.9."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(scores) + 1) + toxic.sum())
    at = int(np.argmax(f1))
    below = scores[order[at + 1]] if at + 1 < len(scores) else 0.0
    return float(np.clip((scores[order[at]] + below) / 2, 0.3, 0.9))


class Scorer:
    """Scores whole texts; keeps words' products in a bounded table."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self, room: int = 0) -> None:
        """Forget all words; with room for ``room`` of them at least (memory is only used as it is filled)."""
        self.numbers, self.used = Numbers(), 0
        self.products = [np.zeros((max(room, REMEMBERED) + 1, FILTERS * len(WIDTHS) - skip), np.float32) for skip in SKIP]

    def _learn(self, words: list[list[str]]) -> list[np.ndarray]:
        """The words' numbers, which are the rows of their products."""
        ids = [self.numbers.of(ws) for ws in words]
        if len(self.numbers) >= len(self.products[0]):
            self._reset(len({w for ws in words for w in ws}))
            ids = [self.numbers.of(ws) for ws in words]
        new = self.numbers.since(self.used)
        for lo in range(0, len(new), 8192):
            part = new[lo : lo + 8192]
            at = self.used + 1
            for held, made in zip(self.products, self.model.products(self.model.vectors(hashed(part))), strict=True):
                held[at : at + len(part)] = made
            self.used += len(part)
        return ids

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        at, starts, ends = lay_out(self._learn([words_of(t) for t in texts]))
        pooled, _ = self.model.pool(self.products, [at[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
        return self.model.score(pooled)


def _groups(texts: list[str | None], chars: int = 200_000):
    """Slices of a list of texts of about so many characters, one text at least."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


_PIECES = "piece int, fan int, sums binary, weights binary"


def _shard(model: Model, epochs: range, fan: int):
    """For applyInArrow: what a shard changes, weighted, a row a piece of the embeddings and one of all else (piece -1)."""

    def run(rows: pa.Table) -> pa.Table:
        mine = copy.deepcopy(model)
        labels = rows["label"].to_numpy().astype(np.float64)
        shard = rows["shard"][0].as_py()
        order = np.argsort(rows["id"].to_numpy(), kind="stable")  # reruns agree
        texts = rows["text"].to_pylist()
        touched = learn(mine, labels[order], [texts[i] for i in order], epochs, shard)
        n = np.array([float(len(order))])
        out = [(-1, n[0] * (dense(mine) - dense(model)), n)]
        for at in range(0, ROWS, PIECE):
            times = touched[at : at + PIECE]
            if times.any():
                out.append((at // PIECE, times[:, None] * (mine.table[at : at + PIECE].astype(np.float64) - model.table[at : at + PIECE]), times))
        made = pa.table({"piece": pa.array([p for p, _, _ in out], pa.int32()), "fan": pa.array([shard % fan] * len(out), pa.int32()), "sums": [s.tobytes() for _, s, _ in out], "weights": [w.tobytes() for _, _, w in out]})
        release()
        return made

    return run


def _add(rows: pa.Table) -> pa.Table:
    """The sums of a piece's rows, in an order of their own so that reruns agree."""
    held = sorted(zip(rows["sums"].to_pylist(), rows["weights"].to_pylist(), strict=True))
    sums, weights = (sum(np.frombuffer(r[k]) for r in held) for k in (0, 1))
    return pa.table({"piece": rows["piece"][:1], "fan": rows["fan"][:1], "sums": [sums.tobytes()], "weights": [weights.tobytes()]})


def dense(model: Model) -> np.ndarray:
    """Filters, biases, output and base behind each other."""
    return np.concatenate([np.ravel(w).astype(np.float64) for w in (*model.filters, *model.bias, model.out, model.base)])


def _move(model: Model, by: np.ndarray) -> None:
    at = 0
    for w in (*model.filters, *model.bias, model.out):
        w += by[at : at + w.size].reshape(w.shape).astype(w.dtype)
        at += w.size
    model.base += float(by[at])


def _deal(rows: DataFrame, shards: int) -> DataFrame:
    """Rows (id, label, text) with their shard; each of up to 4,096 shards is a partition of its own."""
    shard = F.pmod(F.xxhash64(F.lit("shard"), "id"), F.lit(shards)).cast("int").alias("shard")
    return rows.select("id", "label", "text", shard).repartitionById(min(shards, 4096), F.col("shard"))


def train(docs: DataFrame, labels: DataFrame, text_col="text", lang_col="lang") -> Model:
    """Fit the model on all labelled documents outside the held-out fold (``labels``: doc_id, toxic)."""
    rows = labelled(docs, labels, F.when(F.col("toxic").isin(0, 1), F.col("toxic")), text_col=text_col, extra=(lang_col,)).withColumnRenamed(lang_col, "lang")
    calibrates = F.pmod(F.xxhash64(F.lit("calibration"), "id"), F.lit(CALIBRATION)) == 0
    told = rows.agg(F.count("*").alias("n"), F.sum("label").alias("toxic"), F.sum(F.length("text")).alias("chars")).first()
    model = Model()
    if not told["n"] or told["toxic"] in (0, told["n"]):
        model.constant = told["toxic"] / told["n"] if told["n"] else 0.0
        return model
    shards = max(1, -(-told["n"] // SHARD), -(-told["chars"] // SHARD_CHARS))
    fan, epochs = int(shards**0.5) + 1, EPOCHS // TURNS
    dealt = _deal(rows.where(~calibrates), shards)
    for turn in range(TURNS):
        made = dealt.groupBy("shard").applyInArrow(_shard(model, range(turn * epochs, (turn + 1) * epochs), fan), _PIECES)
        added = made.groupBy("piece", "fan").applyInArrow(_add, _PIECES).groupBy("piece").applyInArrow(_add, _PIECES)
        for piece in added.collect():  # the model's size
            sums, weights = (np.frombuffer(bytes(piece[k])) for k in ("sums", "weights"))
            if piece["piece"] < 0:
                _move(model, sums / weights[0])
            else:
                at = piece["piece"] * PIECE
                model.table[at : at + PIECE] += (sums.reshape(-1, DIM) / np.maximum(weights, 1)[:, None]).astype(np.float32)
    _calibrate(model, rows.where(calibrates))
    return model


def _calibrate(model: Model, rows: DataFrame) -> None:
    """Set the thresholds from rows (label, text, lang) that weren't trained on, by exact running counts."""
    scored = map_batches(rows.select("label", F.col("lang").cast("string").alias("lang"), F.col("text").alias("__text")), _scorer(model), "label int, lang string, __score double")
    scopes = F.explode(F.array(F.struct(F.lit(True).alias("every"), F.lit(None).cast("string").alias("lang")), F.struct(F.lit(False).alias("every"), "lang")))
    counts = scored.select(scopes.alias("scope"), F.col("__score").alias("score"), "label").groupBy("scope", "score").agg(F.sum("label").alias("pos"), F.count("*").alias("n"))
    upto = materialize(stats.cumulate(counts, F.struct("scope", -F.col("score")), {"hits": "pos", "taken": "n"}), "calibration")
    whole = upto.groupBy("scope").agg(F.min(F.col("hits") - F.col("pos")).alias("hits0"), F.min(F.col("taken") - F.col("n")).alias("taken0"), F.sum("pos").alias("toxic")).where("toxic > 0")
    f1 = 2 * (F.col("hits") - F.col("hits0")) / (F.col("taken") - F.col("taken0") + F.col("toxic"))
    best = upto.alias("u").join(F.broadcast(whole.alias("w")), F.col("u.scope").eqNullSafe(F.col("w.scope"))).groupBy("u.scope", "toxic").agg(F.max_by("score", F.struct(f1.alias("f1"), "score")).alias("at"))
    below = upto.alias("u").join(F.broadcast(best.alias("b")), F.col("u.scope").eqNullSafe(F.col("b.scope")), "right")
    found = below.groupBy("b.scope", "toxic", "at").agg(F.coalesce(F.max(F.when(F.col("score") < F.col("at"), F.col("score"))), F.lit(0.0)).alias("below")).select("scope.every", "scope.lang", "toxic", "at", "below").collect()  # a row a language
    middle = lambda r: float(np.clip((r["at"] + r["below"]) / 2, 0.3, 0.9))
    for r in found:
        if r["every"]:
            model.threshold = middle(r)
    for r in found:
        if not r["every"]:
            model.thresholds[r["lang"]] = (r["toxic"] * middle(r) + WEIGHT * model.threshold) / (r["toxic"] + WEIGHT)


def _scorer(model: Model):
    """For mapInArrow: replaces column ``__text`` by its score."""

    def run(batches):
        scorer = Scorer(model)
        for batch in slices(batches):
            texts = batch.column("__text").to_pylist()
            scores = np.concatenate([scorer.score(texts[a:b]) for a, b in _groups(texts)] or [np.zeros(0)])
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(scores, pa.float64())], [*names, "__score"])

    return run


def score(docs: DataFrame, model: Model, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted at 0.5, and rejected at its language's threshold."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("__text"))
    scored = map_batches(narrow, _scorer(model), "doc_id long, lang string, __score double")
    limit = F.lit(model.threshold)
    for lang, value in sorted(model.thresholds.items(), key=lambda x: str(x[0])):
        limit = F.when(F.col("lang").eqNullSafe(F.lit(lang)), F.lit(value)).otherwise(limit)
    return scored.select(
        "doc_id", in_fold(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
        F.when(F.col("__score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"), (F.col("__score") >= limit).alias("rejected"),
    )


def keep_clean(docs: DataFrame, model: Model, text_col="text", lang_col="lang") -> DataFrame:
    """The documents below their language's threshold, in their own columns.

    Null and empty texts are judged like a text of one unknown word, repeated
    rows alike; a null language has the threshold of all; other columns stay
    as they are, whatever their names; an empty table gives an empty one.
    """
    text_at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches):
        scorer = Scorer(model)
        for batch in slices(batches):
            texts, langs = batch.column(text_at).to_pylist(), batch.column(lang_at).to_pylist()
            scores = np.concatenate([scorer.score(texts[a:b]) for a, b in _groups(texts)] or [np.zeros(0)])
            limits = np.array([model.thresholds.get(x, model.threshold) for x in langs])
            yield batch.filter(pa.array(scores < limits))

    return map_rows(docs, run)
