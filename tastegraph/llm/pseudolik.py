"""Document scores by masked pseudo-likelihood of a bidirectional window network.

Each word of a text is predicted from the words on both of its sides, as if it were masked. The network adds up the
embeddings of ``2 * SIDE`` neighbours, each scaled by a vector of its offset, applies tanh, and predicts the word itself by
a hierarchical softmax: the words are the leaves of a binary tree balanced by their corpus frequencies, each inner node
decides from the hidden values for its right or left side, and the chances of all words add up to one. A document's score
is the sum of the conditional log-probabilities of all its words.

* Words are known by their 64-bit hashes. Their counts are taken over all documents (pre-aggregated in each task) and stay
  a table. The words with embeddings and leaves of their own are the most frequent ones, ``PER_POWER`` times the number of
  all words to the power ``POWER``; words of one frequency are in or out together.
* All other words share the leaf "rare" and its embedding. Within that leaf a word has its exact corpus frequency, whatever
  its neighbours; it comes from a join of the rare words of each document with the table of counts. No rare word is frequent
  enough to be a hot key.
* Training reads every document once: documents are dealt to ``ROUNDS`` rounds, in a round each part trains on its own
  documents with numpy from the current network, and the networks are averaged, weighted by words, in a tree of bounded
  fan-in, slice by slice. A part has at least ``WORDS_A_NUMBER`` words for each number of its network, so what the parts
  exchange stays a fixed share of the input.
* Scoring is one pass, a join of rare words and a sum by document.

Edge cases: a null or empty text, or one of blanks, has no words, score 0 and no mean; words beyond the ends of a text are
a padding of their own; equal rows get equal scores; an unknown word has half a count; an empty table gives an empty result;
other columns are ignored. Scores depend on how the input is split into partitions, as the order of training does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.wordhash import Words, in_chunks
from tastegraph.plans.durable import durable

PER_POWER, POWER, LEAST = 12, 0.4, 1024
# Levels of frequency in an octave, in the choice of the most frequent words.
LEVELS = 64
SIDE = 2
WIDTH = 16
ROUNDS = 2
BATCH = 8192
RATE = 0.1
WORDS_A_NUMBER = 4
FAN_IN = 64
SLICE = 1 << 16
# Distinct words that a task holds while it counts.
HELD = 1 << 20
UNKNOWN = 0.5

OFFSETS = [*range(-SIDE, 0), *range(1, SIDE + 1)]


@dataclass
class Tree:
    """A binary tree over leaves in a row; the inner node between leaves ``n - 1`` and ``n`` is ``n``, and 0 is none."""

    root: int
    left: np.ndarray
    right: np.ndarray
    # log of the mass right of a node over that left of it
    odds: np.ndarray

    @classmethod
    def over(cls, mass: np.ndarray) -> Tree:
        before = np.concatenate(([0.0], np.cumsum(mass)))
        children = np.zeros((2, len(mass)), np.int32)
        odds = np.zeros(len(mass), np.float32)
        low, high = np.array([0]), np.array([len(mass)])
        side, parent, root = np.array([0]), np.array([0]), 0
        while True:
            open_ = high - low > 1
            low, high, side, parent = low[open_], high[open_], side[open_], parent[open_]
            if not len(low):
                return cls(root, *children, odds)
            half = (before[low] + before[high]) / 2
            node = np.clip(np.searchsorted(before, half), low + 1, high - 1)
            odds[node] = np.log(before[high] - before[node]) - np.log(before[node] - before[low])
            root = root or int(node[0])
            children[side[parent > 0], parent[parent > 0]] = node[parent > 0]
            low, high = np.concatenate((low, node)), np.concatenate((node, high))
            side, parent = np.repeat([0, 1], len(node)), np.concatenate((node, node))


@dataclass
class Vocabulary:
    """Frequent words by hash, with their numbers in order of frequency; ``rare`` is the number of all others."""

    hashes: np.ndarray
    numbers: np.ndarray
    rare: int
    tree: Tree
    # the mass of all rare words together, an unknown one included
    rare_mass: float

    @classmethod
    def of(cls, hashes: np.ndarray, counts: np.ndarray, rare_words: int, rare_count: int) -> Vocabulary:
        """From the hashes and counts of frequent words, and how many rare ones there are and occur."""
        rare_mass = rare_count + UNKNOWN * (rare_words + 1)
        mass = np.append(counts + UNKNOWN, rare_mass)
        order = np.lexsort((np.append(hashes, np.uint64(0)), -mass))
        numbers = np.empty(len(mass), np.int64)
        numbers[order] = np.arange(len(mass))
        by_hash = np.argsort(hashes)
        return cls(hashes[by_hash], numbers[:-1][by_hash], int(numbers[-1]), Tree.over(mass[order]), rare_mass)

    @property
    def size(self) -> int:
        return len(self.hashes) + 1

    @property
    def pad(self) -> int:
        """The input of places beyond the ends of a text."""
        return self.size

    @property
    def stored(self) -> type:
        return np.uint16 if self.pad < 1 << 16 else np.int32

    def number(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), self.rare)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], self.rare)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their rows of values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys.take(order)
    starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    return keys[starts], np.add.reduceat(values.take(order, axis=0), starts, axis=0)


class Network(dict):
    """The parameters by name; one flat vector when it travels."""

    @staticmethod
    def shapes(size: int) -> dict[str, tuple[int, ...]]:
        return {
            "inputs": (size + 1, WIDTH), "scales": (2 * SIDE, WIDTH), "shift": (WIDTH,),
            "outputs": (size, WIDTH), "levels": (size,),
        }

    @classmethod
    def fresh(cls, vocabulary: Vocabulary) -> Network:
        """Each word has its corpus frequency whatever its neighbours."""
        rng = np.random.default_rng(8)
        out = cls({k: rng.normal(0, 0.1, s).astype(np.float32) for k, s in cls.shapes(vocabulary.size).items()})
        out["scales"] += 1
        out["outputs"][:] = 0
        out["levels"][:] = vocabulary.tree.odds
        return out

    @classmethod
    def unpack(cls, flat: np.ndarray, size: int) -> Network:
        out, at = cls(), 0
        for name, shape in cls.shapes(size).items():
            end = at + int(np.prod(shape))
            out[name] = flat[at:end].reshape(shape).astype(np.float32)
            at = end
        return out

    def pack(self) -> np.ndarray:
        return np.concatenate([self[k].ravel() for k in self.shapes(len(self["levels"]))])

    def hidden(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings of a window of inputs, and the hidden values at its places but the ``SIDE`` first and last."""
        near = self["inputs"].take(window, axis=0)
        size = len(window) - 2 * SIDE
        total = self["shift"] + sum(near[SIDE + o : SIDE + o + size] * s for o, s in zip(OFFSETS, self["scales"], strict=True))
        return near, np.tanh(total)

    def descend(self, tree: Tree, hidden: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """For each level of the tree the rows still on their way, with their hidden values, nodes, scores and turns to the right.

        The words are sorted, so that the rows of one node follow one another.
        """
        rows = np.arange(len(words) if tree.root else 0)
        node = np.full(len(rows), tree.root, np.int32)
        while len(rows):
            outputs = self["outputs"].take(node, axis=0)
            score = np.einsum("ij,ij->i", hidden, outputs) + self["levels"].take(node)
            turn = words >= node
            yield rows, hidden, node, outputs, score, turn
            after = np.where(turn, tree.right.take(node), tree.left.take(node))
            going = np.flatnonzero(after)
            rows, hidden, words, node = rows.take(going), hidden.take(going, axis=0), words.take(going), after.take(going)

    def chances(self, tree: Tree, hidden: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The log-probability of each word given the hidden values at its place."""
        order = np.argsort(words, kind="stable")
        logs = np.zeros(len(words))
        for rows, _, _, _, score, turn in self.descend(tree, hidden.take(order, axis=0), words.take(order)):
            logs[rows] -= np.log1p(np.exp(np.minimum(np.where(turn, -score, score), 60)))
        out = np.empty(len(words))
        out[order] = logs
        return out

    def slopes(self, tree: Tree, window: np.ndarray, pad: int) -> tuple[float, dict[str, tuple[np.ndarray, np.ndarray]]]:
        """The loss (negative log-likelihood of the words inside a window) and the derivatives by rows of the parameters."""
        near, hidden = self.hidden(window)
        place = np.flatnonzero(window[SIDE : len(window) - SIDE] != pad)
        place = place.take(np.argsort(window[SIDE + place], kind="stable"))
        words, own = window[SIDE + place], hidden.take(place, axis=0)
        back = np.zeros_like(own)
        loss, nodes, pulls, shifts = 0.0, [np.zeros(0, np.int32)], [np.zeros((0, WIDTH), own.dtype)], [np.zeros(0, own.dtype)]
        for rows, values, node, outputs, score, turn in self.descend(tree, own, words):
            chance = 1 / (1 + np.exp(np.minimum(-score, 60)))
            wrong = chance - turn
            loss -= float(np.log(np.maximum(1 - np.abs(wrong), 1e-30)).sum())
            back[rows] = back.take(rows, axis=0) + wrong[:, None] * outputs
            starts = np.concatenate(([0], np.flatnonzero(node[1:] != node[:-1]) + 1))
            nodes.append(node.take(starts))
            pulls.append(np.add.reduceat(wrong[:, None] * values, starts, axis=0))
            shifts.append(np.add.reduceat(wrong, starts))
        spread = np.zeros_like(hidden)
        spread[place] = back * (1 - own * own)
        inner = np.zeros_like(near)
        scales = np.empty_like(self["scales"])
        for n, o in enumerate(OFFSETS):
            part = slice(SIDE + o, SIDE + o + len(hidden))
            inner[part] += spread * self["scales"][n]
            scales[n] = (near[part] * spread).sum(0)
        node = np.concatenate(nodes)
        return loss, {
            "inputs": summed(window, inner), "scales": (np.arange(2 * SIDE), scales), "shift": (np.arange(WIDTH), spread.sum(0)),
            "outputs": (node, np.concatenate(pulls)), "levels": (node, np.concatenate(shifts)),
        }


def line_of(texts: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts in a row, ``SIDE`` paddings before each text and after the last; where each text begins."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + SIDE) - sizes
    # numbers of 16 bits are sorted fastest
    line = np.full(int(sizes.sum()) + SIDE * (len(texts) + 1), pad, np.uint16 if pad < 1 << 16 else np.int32)
    for start, text in zip(starts.tolist(), texts, strict=True):
        line[start : start + len(text)] = text
    return line, starts


def windows(line: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(place, window)``: the places of a line, ``BATCH`` at a time, each with the ``SIDE`` inputs around it."""
    for at in range(SIDE, len(line) - SIDE, BATCH):
        yield at, line[at - SIDE : min(at + BATCH, len(line) - SIDE) + SIDE]


def train(network: Network, batches: Iterator[list[np.ndarray]], vocabulary: Vocabulary) -> int:
    """Adagrad over word batches, in place; the number of words seen."""
    squares = {k: np.full(v.shape, 1e-2, np.float32) for k, v in network.items()}
    seen = 0
    for texts in batches:
        line, _ = line_of(texts, vocabulary.pad)
        for _, window in windows(line):
            _, slopes = network.slopes(vocabulary.tree, window, vocabulary.pad)
            for name, (rows, slope) in slopes.items():
                # the mean over the batch, but for rows that few of its words touch
                power = 1.0 if name in ("scales", "shift") else 0.5
                step = (slope / len(window) ** power).astype(np.float32)
                square = squares[name].take(rows, axis=0) + step * step
                squares[name][rows] = square
                network[name][rows] -= RATE * step / np.sqrt(square)
        seen += sum(map(len, texts))
    return seen


def log_likelihoods(network: Network, texts: list[np.ndarray], vocabulary: Vocabulary) -> np.ndarray:
    """The sum over each text's words of their conditional log-probabilities, a rare word as such."""
    line, starts = line_of(texts, vocabulary.pad)
    total = np.zeros(len(line) + 1)
    for at, window in windows(line):
        _, hidden = network.hidden(window)
        place = np.flatnonzero(window[SIDE : len(window) - SIDE] != vocabulary.pad)
        total[at + place + 1] = network.chances(vocabulary.tree, hidden[place], window[SIDE + place])
    total = np.cumsum(total)
    return total[starts + [len(t) for t in texts]] - total[starts] if texts else np.zeros(0)


def counted(docs: DataFrame, text: str) -> DataFrame:
    """``(word, n)``: how often the word of each hash occurs in all documents; a table."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["word", "n"])

        held, size = [], 0
        for batch in batches:
            for chunk in in_chunks(batch.column(0).cast(pa.binary()).to_pylist()):
                held.append(np.unique(Words(chunk).hashes, return_counts=True))
                size += len(held[-1][0])
                if size > 2 * HELD:
                    held = [summed(*map(np.concatenate, zip(*held, strict=True)))]
                    size = len(held[0][0])
                    if size > HELD:
                        yield batch_of(*held[0])
                        held, size = [], 0
        if size:
            yield batch_of(*summed(*map(np.concatenate, zip(*held, strict=True))))

    return durable(docs.select(text).mapInArrow(rows, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))


def vocabulary_of(counts: DataFrame) -> tuple[Vocabulary, int, DataFrame]:
    """The vocabulary, the number of all words, and the counts of the rare ones.

    The driver gets the frequent words only, whose number grows as the power ``POWER`` of the input.
    """
    level = F.floor(F.log2("n") * LEVELS)
    # a row for each of the levels of frequency that occur
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    total = sum(r.n for r in levels)
    room, least = max(LEAST, int(PER_POWER * total**POWER)), 1 << 40
    rare_words, rare_count = sum(r.words for r in levels), total
    for r in sorted(levels, key=lambda r: -r.level):
        room -= r.words
        if room < 0:
            break
        least, rare_words, rare_count = r.level, rare_words - r.words, rare_count - r.n
    frequent = counts.where(level >= least).toPandas()
    hashes = frequent["word"].to_numpy(np.int64).view(np.uint64)
    vocabulary = Vocabulary.of(hashes, frequent["n"].to_numpy(np.float64), rare_words, rare_count)
    return vocabulary, total, counts.where(level < least)


def numbered(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row, doc_id, words, rare)``: the word numbers of each row, the hashes of its rare words; written once, read in each pass."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            at = 0
            for chunk in in_chunks(batch.column(1).cast(pa.binary()).to_pylist()):
                words = Words(chunk)
                numbers = vocabulary.number(words.hashes).astype(vocabulary.stored)
                parts, rare = [], []
                for s, e in zip(words.starts[:-1].tolist(), words.starts[1:].tolist(), strict=True):
                    parts.append(numbers[s:e].tobytes())
                    rare.append(words.hashes[s:e][numbers[s:e] == vocabulary.rare].tobytes())
                ids = batch.column(0).slice(at, len(chunk))
                own = pa.array(np.arange(row, row + len(chunk)))
                columns = [own, ids, pa.array(parts, pa.binary()), pa.array(rare, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "words", "rare"])
                at, row = at + len(chunk), row + len(chunk)

    columns = "row long, doc_id long, words binary, rare binary"
    return durable(docs.select(docs[doc_id].cast("long"), docs[text]).mapInArrow(rows, columns))


def _texts(batch: pa.RecordBatch, stored: type, rows: int = 64) -> Iterator[tuple[int, list[np.ndarray]]]:
    values = batch.column(batch.schema.get_field_index("words")).to_pylist()
    for at in range(0, len(values), rows):
        yield at, [np.frombuffer(v, stored) for v in values[at : at + rows]]


SLICES = "part long, slice long, weight long, flat binary"


def averaged(parts: DataFrame, most: int) -> np.ndarray | None:
    """The mean of rows ``SLICES`` by weight, slices in a row; at most ``FAN_IN`` slices of parts below ``most`` meet in a group."""

    def add(table: pa.Table) -> pa.Table:
        total, weight = 0, 0
        for w, flat in zip(table.column("weight").to_pylist(), table.column("flat").to_pylist(), strict=True):
            total, weight = total + w * np.frombuffer(flat, np.float32).astype(np.float64), weight + w
        flat = (total / weight).astype(np.float32).tobytes()
        first = table.select(["part", "slice"]).slice(0, 1)
        return first.append_column("weight", pa.array([weight], pa.int64())).append_column("flat", pa.array([flat], pa.binary()))

    while True:
        most = -(-most // FAN_IN)
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long")).groupBy("part", "slice").applyInArrow(add, SLICES)
        if most <= 1:
            break
    # the slices of one network
    found = sorted(parts.select("slice", "flat").collect())
    return np.concatenate([np.frombuffer(r.flat, np.float32) for r in found]) if found else None


@dataclass
class Model:
    vocabulary: Vocabulary
    network: Network
    # the counts of rare words
    rare: DataFrame


def fit(words: DataFrame, vocabulary: Vocabulary, total: int, rounds: int = ROUNDS) -> Network:
    """Train on all documents of ``numbered``, which have ``total`` words."""
    network = Network.fresh(vocabulary)
    parts = words.rdd.getNumPartitions()
    parts = max(1, min(parts, total // (WORDS_A_NUMBER * len(network.pack()))))
    for turn in range(rounds):
        own = words.where(F.pmod(F.xxhash64("doc_id", "words"), F.lit(rounds)) == turn).select("words").coalesce(parts)
        trained = durable(own.mapInArrow(trainer(vocabulary, network.pack()), SLICES))
        flat = averaged(trained, parts)
        network = network if flat is None else Network.unpack(flat, vocabulary.size)
    return network


def trainer(vocabulary: Vocabulary, flat: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        network = Network.unpack(flat, vocabulary.size)
        texts = (texts for batch in batches for _, texts in _texts(batch, vocabulary.stored))
        seen = train(network, texts, vocabulary)
        if seen:
            own, part = network.pack(), TaskContext.get().partitionId()
            for n, at in enumerate(range(0, len(own), SLICE)):
                columns = [pa.array([v], pa.int64()) for v in (part, n, seen)]
                columns.append(pa.array([own[at : at + SLICE].tobytes()], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["part", "slice", "weight", "flat"])

    return rows


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """A model of all documents, and the documents as ``numbered`` by it."""
    vocabulary, total, rare = vocabulary_of(counted(docs, text))
    words = numbered(docs, vocabulary, doc_id, text)
    return Model(vocabulary, fit(words, vocabulary, total, rounds), rare), words


def rare_scores(words: DataFrame, model: Model) -> DataFrame:
    """``(row, within)``: the sum of the log frequencies of a row's rare words among all rare words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if value:
                    keys, n = np.unique(np.frombuffer(value, np.int64), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), row)), pa.array(keys), pa.array(n)], names=["row", "word", "times"])

    found = words.select("row", "rare").mapInArrow(rows, "row long, word long, times long").join(model.rare, "word", "left")
    within = F.log((F.coalesce("n", F.lit(0)) + UNKNOWN) / F.lit(model.vocabulary.rare_mass))
    return found.groupBy("row").agg(F.sum(F.col("times") * within).alias("within"))


def scored(words: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, n_words, log_likelihood, mean)`` of each row of ``numbered``; the mean is null without words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.unpack(flat, vocabulary.size)
        for batch in batches:
            for at, texts in _texts(batch, vocabulary.stored):
                sums, sizes = log_likelihoods(network, texts, vocabulary), np.array([len(t) for t in texts])
                own = [batch.column(n).slice(at, len(texts)) for n in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(sizes), pa.array(sums)], names=["row", "doc_id", "n_words", "outer"])

    vocabulary, flat = model.vocabulary, model.network.pack()
    outer = words.select("row", "doc_id", "words").mapInArrow(rows, "row long, doc_id long, n_words long, outer double")
    total = F.col("outer") + F.coalesce("within", F.lit(0.0))
    return outer.join(rare_scores(words, model), "row", "left").select(
        "doc_id", "n_words", total.alias("log_likelihood"), F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean")
    )


def pseudo_likelihood(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Train on the documents and score each of them."""
    model, words = learn(docs, doc_id, text, rounds)
    return scored(words, model)
